"""Filter interaction audit by an incremental stream that retracts what later files correct.

Five filters judge whole texts; the last one, E, drops copies of any smaller doc_id's text.  All files
of a table are processed as available-now micro-batches.  Keyed state holds, for each text, the smallest
doc_id so far with its part and its mask of failed filters.  A row whose text has a smaller id
fails E for good.  When a smaller id arrives, the row that held the text until then gets its earlier mask
retracted from the counters of its part (-1) and comes back with E set (+1).  The sum of all such
changes is, for each part and mask, the number of documents, whatever the order of the files.

Bounded under skew: before the shuffle every task reduces the copies of a text to the smallest id it has
seen, so a hot text travels once per Arrow batch.  State lies in buckets of texts by digest, a few sorted
arrays per bucket that merge in numpy.  Counters of masks are a few rows per part, and the 120 orders
are derived from them, never from documents.  State takes some 40 bytes a text in the store that the
session names (RocksDB keeps it out of the heap, for some 4 MB of disk a partition).

Defined cases: a null text is the empty text, a null lang the empty part, which is one with an empty lang; a row
without doc_id neither makes a copy nor is one; rows that repeat doc_id and text all stand (no smaller doc_id);
a document is good or toxic if any of its rows in the labels says so; unlabelled documents are neither; an empty
table gives an empty result; other columns are ignored.  Texts are told apart by 128 bits of SHA-256.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from meterlake.llm import scratch
from meterlake.llm.shipping import shipped

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
#: Micro-batches a table is read in (its files are dealt evenly), and texts in a bucket of state.
BATCHES = 8
BUCKET_TEXTS = 50_000

_SENT = "bucket int, final boolean, lo long, hi long, doc_id long, part string, flags int, n long"
_CHANGE = "part string, mask int, good int, toxic int, delta long"
_STATE = "lo binary, hi binary, ids binary, codes binary, counts binary, parts string"


def masks(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest (16 bytes) and the mask of failed filters A to D of every row."""
    text = F.coalesce("text", F.lit(""))
    words = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        text.alias("text"),
        F.expr(r"filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), w -> w <> '')").alias("words"),
    )
    counted = words.select(
        "doc_id", "part", "text", F.size("words").alias("n_words"), F.size(F.array_distinct("words")).alias("n_distinct"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("sha"),
    )
    fails = {
        "A": F.col("n_words") < 100,
        "B": 100 * F.col("n_distinct") < 80 * F.col("n_words"),
        "C": 100 * F.length(F.regexp_replace("text", "[^A-Z]+", "")) > 10 * F.length("text"),
        "D": F.col("text").rlike("[#$%&*|]"),
    }
    mask = sum((F.when(c, 1 << FILTERS.index(k)).otherwise(0) for k, c in fails.items()), F.lit(0))
    return counted.select("doc_id", "part", F.unhex(F.substring("sha", 1, 32)).alias("digest"), mask.alias("mask"))


def label_marks(labels: DataFrame) -> DataFrame:
    """One row per labelled doc_id: good and toxic, 0 or 1."""
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    return labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))


def _least(lo: np.ndarray, hi: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by text and id, and for each row of that order the least id of its text."""
    order = np.lexsort((ids, hi, lo))
    a, b, i = lo[order], hi[order], ids[order]
    head = np.ones(len(a), bool)
    head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, i[np.flatnonzero(head)][np.cumsum(head) - 1] if len(a) else i


def _reduce(buckets: int):
    """Per Arrow batch: rows of the least id of each text, and counts of rows whose mask is final.

    ``flags`` is mask * 4 + good * 2 + toxic; counts that are ``final`` belong to no text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.table(batch)
            lo, hi = np.frombuffer(b"".join(t["digest"].to_pylist()), np.int64).reshape(-1, 2).T.copy()
            known = pc.is_valid(t["doc_id"]).to_numpy()
            ids = pc.fill_null(t["doc_id"], 0).to_numpy().copy()
            flags = (t["mask"].to_numpy() * 4 + t["good"].to_numpy() * 2 + t["toxic"].to_numpy()).astype(np.int32)
            at = np.flatnonzero(known)
            order, least = _least(lo[at], hi[at], ids[at])
            copies = at[order[ids[at[order]] > least]]
            flags[copies] |= COPY * 4
            final = ~known
            final[copies] = True
            home = (lo.view(np.uint64) >> np.uint64(16)) % np.uint64(buckets)
            for x in (lo, hi, ids):
                x[final] = 0
            full = pa.table({
                "bucket": np.where(final, flags % buckets, home).astype(np.int32),
                "final": final, "lo": lo, "hi": hi, "doc_id": ids, "part": t["part"], "flags": pa.array(flags),
            })
            packed = full.group_by(full.column_names).aggregate([([], "count_all")]).rename_columns([*full.column_names, "n"])
            yield from packed.combine_chunks().to_batches()

    return run


def _array(blob: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(blob, kind)


def _step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Merge the rows of a micro-batch into a bucket of texts and tell what changes."""
    new = pd.concat(list(frames), ignore_index=True)
    if state.exists:
        held = state.get
        parts = json.loads(held[5])
        old = [_array(x) for x in held[:5]]
    else:
        parts, old = [], [np.zeros(0, np.int64)] * 5
    number = {p: i for i, p in enumerate(parts)}
    for p in pd.unique(new["part"]):
        number.setdefault(p, len(number))
    codes = new["part"].map(number).to_numpy(np.int64) * 128 + new["flags"].to_numpy(np.int64)
    counts = new["n"].to_numpy(np.int64)
    final = new["final"].to_numpy(bool)
    told_code, told_n = [codes[final]], [counts[final]]

    live = new[~final]
    lo = np.concatenate((old[0], live["lo"].to_numpy(np.int64)))
    hi = np.concatenate((old[1], live["hi"].to_numpy(np.int64)))
    ids = np.concatenate((old[2], live["doc_id"].to_numpy(np.int64)))
    code = np.concatenate((old[3], codes[~final]))
    n = np.concatenate((old[4], counts[~final]))
    fresh = np.arange(len(lo)) >= len(old[0])
    order, least = _least(lo, hi, ids)
    lo, hi, ids, code, n, fresh = (x[order] for x in (lo, hi, ids, code, n, fresh))
    copy = ids > least
    told_code += [code[~copy & fresh], code[copy] | COPY * 4, code[copy & ~fresh]]
    told_n += [n[~copy & fresh], n[copy], -n[copy & ~fresh]]

    # Rows of one text and id with the same flags become one.
    stay = np.flatnonzero(~copy)
    by = np.lexsort((code[stay], hi[stay], lo[stay]))
    stay = stay[by]
    head = np.ones(len(stay), bool)
    a, b, c = lo[stay], hi[stay], code[stay]
    head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (c[1:] != c[:-1])
    first = np.flatnonzero(head)
    total = np.add.reduceat(n[stay], first) if len(first) else n[stay]
    kept = stay[first]
    names = list(number)
    state.update((lo[kept].tobytes(), hi[kept].tobytes(), ids[kept].tobytes(), code[kept].tobytes(), total.astype(np.int64).tobytes(), json.dumps(names)))

    told, where = np.unique(np.concatenate(told_code), return_inverse=True)
    delta = np.zeros(len(told), np.int64)
    np.add.at(delta, where, np.concatenate(told_n))
    yield pd.DataFrame({
        "part": [names[i] for i in told // 128], "mask": (told % 128 // 4).astype(np.int32),
        "good": (told // 2 % 2).astype(np.int32), "toxic": (told % 2).astype(np.int32), "delta": delta,
    })


@shipped
def changes(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Every change of a counter that the stream over the Parquet files at ``path`` told, retractions included."""
    table = spark.read.parquet(path)
    names = table.inputFiles()
    files = max(1, len(names))
    folder, _, name = path.rstrip("/").rpartition("/")
    alone = files == 1 and names[0].endswith("/" + name)  # a stream reads folders: this one file of its folder
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), table.count() // BUCKET_TEXTS + 1)
    marks = scratch.write(label_marks(labels), "audit-labels")
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", -(-files // batches))
    stream = stream.option("pathGlobFilter", name).parquet(folder or "/") if alone else stream.parquet(path)
    marked = masks(stream.select("doc_id", "text", "lang")).join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    sent = marked.select("digest", "doc_id", "part", "mask", "good", "toxic").mapInArrow(_reduce(buckets), _SENT)
    told = sent.groupBy("bucket").applyInPandasWithState(_step, _CHANGE, _STATE, "append", GroupStateTimeout.NoTimeout)
    out, progress = scratch.new_path(spark, "audit-changes"), scratch.new_path(spark, "audit-progress")
    run = told.writeStream.format("parquet").option("path", out).option("checkpointLocation", progress).outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(_CHANGE).parquet(out)


def counters(told: DataFrame) -> DataFrame:
    """Documents per part, mask and label."""
    return told.groupBy("part", "mask", "good", "toxic").agg(F.sum("delta").alias("n")).where("n <> 0")


def _bits(letters: Column) -> Column:
    return sum((F.when(F.instr(letters, c) > 0, 1 << i).otherwise(0) for i, c in enumerate(FILTERS)), F.lit(0))


def interactions(counted: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: what its filter removes there, and around it."""
    orders = F.array(*[F.lit("".join(p)) for p in itertools.permutations(FILTERS)])
    placed = counted.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    step, mask = F.col("step"), F.col("mask")
    placed = placed.select(
        "part", "filter_order", "step", "mask", "good", "toxic", "n",
        _bits(F.substring("filter_order", step, F.lit(1))).alias("own"),
        _bits(F.substring("filter_order", F.lit(1), step - 1)).alias("earlier"),
    )
    fails, gone = mask.bitwiseAND(F.col("own")) != 0, mask.bitwiseAND(F.col("earlier")) != 0
    here = fails & ~gone

    def total(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("long")

    # In 120 orders, each of a document's failing filters comes first equally often.
    share = F.col("n") * F.expr("120 div greatest(1, bit_count(mask))")
    return placed.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"), total(here).alias("removed"), total(fails & gone).alias("redundant"),
        total(mask == F.col("own")).alias("unique_fails"), total(here & (F.col("good") == 1)).alias("good_lost"),
        total(here & (F.col("toxic") == 1)).alias("toxic_lost"), F.sum(F.when(fails, share).otherwise(0)).cast("long").alias("shapley"),
    )


def audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The whole report over the Parquet files at ``path``."""
    return interactions(counters(changes(spark, path, labels, batches)))
