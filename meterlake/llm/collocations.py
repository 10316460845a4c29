"""Phrase collocations by a weighted de Bruijn graph of words.

Texts are cut into pieces and pieces into words.  Edges of the graph are the phrases of ``LONGEST`` words
with their counts, each from the node of its first four words to that of its last four.  The count of
a shorter phrase is never taken from text: it is what flows out of its node, the sum over all phrases
that begin with it and have one word more, plus the piece ends at which it stands and nothing follows.
So only edges and ends are aggregated, and the counts of four, three and two words follow level by level.

Two lossless screens come first.  A phrase counted ``least`` times holds only words and pairs of neighbours
counted as often.  Words are counted exactly; pairs are counted by slot of a hash, where a sum is never
too small.  Pieces break at words and pairs below ``least``, whose breaks count as piece ends.  Both screens
are bit tables of fixed size (8 and 16 MB), whatever the data; a table that fills up screens less and changes no result.

A phrase whose whole flow goes through one longer phrase lies on a unary path and is contracted into it:
these are the candidates that a longer one covers (if a longer one has the same count, so has the one with
one word more between them).  ``unary_paths`` follows such paths of edges to their full length by doubling.

Counts are combined in every batch and before every shuffle; keys are whole phrases, so a hot word, pair or
passage is one row a task.  Scores are integer quotients of 38-digit decimals.

Defined cases: a null text has no words; a null lang is ``und``, together with a lang of that name; rows count as
often as they occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm import scratch
from meterlake.llm.shipping import shipped
from meterlake.llm.wordhash import Words, mix, slices

LEAST, LONGEST, RANKED = 100, 5, 2000
BATCH_BYTES = 2 << 20
#: Phrases put together at a time.
PHRASES = 1 << 13
#: Bits of a slot number: words (8 MB of bits) and pairs of neighbours (16 MB).
WORD_BITS, PAIR_BITS = 26, 27
_CHUNK = 15
#: Parts a language is ranked in before the last ranking.
RANK_PARTS = 64

# What separates words, and what ends a piece.
BLANKS = b" \t"
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"

_BREAK = np.zeros(256, bool)
_BREAK[list(PIECE_ENDS)] = True
_APART = _BREAK.copy()
_APART[list(BLANKS)] = True


class Pieces(Words):
    """Lower-cased words of a batch; ``joined[i]``: word i + 1 follows word i in one piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        super().__init__(texts, lower=True, space=_APART)
        coded = langs.fill_null("und").dictionary_encode()
        self.langs = coded.dictionary
        self.lang = coded.indices.to_numpy().astype(np.int64)[self.text_of_word()]
        ends = np.flatnonzero(_BREAK[self.data])
        text, ended = self.text_of_word(), np.searchsorted(ends, self.start)
        self.joined = np.zeros(len(self), bool)
        self.joined[:-1] = (text[1:] == text[:-1]) & (ended[1:] == ended[:-1])

    def keyed(self) -> np.ndarray:
        """Hashes of the words with their language."""
        seeds = np.array([_seed(x) for x in self.langs.to_pylist()], np.uint64)
        return mix(self.hashes() ^ seeds[self.lang]) if len(self) else np.zeros(0, np.uint64)

    def phrases(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """Words first to last of each pair, joined by one space."""
        place = np.concatenate(([0], np.cumsum(self.end - self.start + 1)))
        data = np.full(int(place[-1]), 0x20, np.uint8)
        inner = np.ones(len(data), bool)
        inner[place[1:] - 1] = False
        data[inner] = self.data[~self.space[self.data]]
        a, n = place[first], place[last + 1] - 1 - place[first]
        offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int64)
        found = np.empty(int(offsets[-1]), np.uint8)
        for i in range(0, len(n), PHRASES):  # blocks bound the index of each byte
            j = min(i + PHRASES, len(n))
            at = np.repeat(a[i:j] - offsets[i:j], n[i:j]) + np.arange(offsets[i], offsets[j])
            found[offsets[i] : offsets[j]] = data[at]
        return pa.Array.from_buffers(pa.large_string(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(found)]).cast(pa.string())


def _seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _slot(hashed: np.ndarray, bits: int) -> np.ndarray:
    return (hashed >> np.uint64(64 - bits)).astype(np.int64)


def _pair(keyed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return mix(keyed[at] * np.uint64(0xD1342543DE82EF95) + keyed[at + 1])


def _holds(bits: bytes, hashed: np.ndarray) -> np.ndarray:
    table = np.frombuffer(bits, np.uint8)
    slot = _slot(hashed, len(bits).bit_length() + 2)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def _tally(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value occurs first, and how often."""
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return first, n


def _batches(docs: Iterator[pa.RecordBatch]) -> Iterator[Pieces]:
    for batch in docs:
        for part in slices(batch, "text", BATCH_BYTES):
            pieces = Pieces(part.column("text"), part.column("lang"))
            if len(pieces):
                yield pieces


def _count_words(docs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for p in _batches(docs):
        names = p.names()
        key = p.lang * len(names.dictionary) + names.indices.to_numpy()
        first, n = _tally(key)
        words = names.take(pa.array(first)).dictionary_decode().cast(pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([p.langs.take(pa.array(p.lang[first])), words, pa.array(n)], ["lang", "phrase", "n"])


@shipped
def word_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase (one word), a: its count."""
    sent = docs.select("lang", "text").mapInArrow(_count_words, "lang string, phrase string, n long")
    return scratch.write(sent.groupBy("lang", "phrase").agg(F.sum("n").alias("a")), "collocation-words")


def bit_table(slots: DataFrame, bits: int) -> bytes:
    """One bit per slot number of the column ``slot``; chunks of it are set in Spark, and come here with a fixed total size."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.column("at"):
                mask = np.zeros(1 << _CHUNK, bool)
                mask[row.values.to_numpy()] = True
                out.append(np.packbits(mask, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(out, pa.binary())], ["chunk", "bits"])

    chunk = F.expr(f"slot >> {_CHUNK}").cast("int").alias("chunk")
    at = F.expr(f"slot & {(1 << _CHUNK) - 1}").cast("int").alias("at")
    grouped = slots.select(chunk, at).distinct().groupBy("chunk").agg(F.collect_list("at").alias("at"))  # at most 2**15
    table = bytearray((1 << bits) // 8)
    size = (1 << _CHUNK) // 8
    for row in grouped.mapInArrow(fill, "chunk int, bits binary").toLocalIterator():
        table[row["chunk"] * size : (row["chunk"] + 1) * size] = row["bits"]
    return bytes(table)


def _word_slots(bits: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            p = Pieces(batch.column("phrase"), batch.column("lang"))
            yield pa.RecordBatch.from_arrays([pa.array(_slot(p.keyed(), bits))], ["slot"])

    return run


@shipped
def frequent_pairs(docs: DataFrame, words: DataFrame, least: int = LEAST, bits: tuple[int, int] = (WORD_BITS, PAIR_BITS)) -> tuple[bytes, bytes]:
    """Bit tables of the words counted ``least`` times, and of the slots of pairs counted so often."""
    spark = docs.sparkSession
    common = words.where(F.col("a") >= least).select("lang", "phrase")
    word_bits = bit_table(common.mapInArrow(_word_slots(bits[0]), "slot long"), bits[0])
    sent = spark.sparkContext.broadcast(word_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in _batches(batches):
            keyed = p.keyed()
            common = _holds(sent.value, keyed)
            at = np.flatnonzero(p.joined[:-1] & common[:-1] & common[1:])
            slot, n = np.unique(_slot(_pair(keyed, at), bits[1]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(n)], ["slot", "n"])

    pairs = docs.select("lang", "text").mapInArrow(run, "slot int, n long")
    found = pairs.groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return word_bits, bit_table(found, bits[1])


def _phrase_keys(ids: np.ndarray, start: np.ndarray, words: int) -> np.ndarray:
    """A number for each phrase of that many words, equal for equal phrases only."""
    found = ids[start]
    for k in range(1, words):
        found = np.unique(found << 32 | ids[start + k], return_inverse=True)[1].astype(np.int64)
    return found


@shipped
def edges_and_ends(docs: DataFrame, word_bits: bytes, pair_bits: bytes, longest: int = LONGEST) -> DataFrame:
    """lang, phrase, words, n: all edges (``longest`` words), and what stands before each end of a
    piece, up to one word less."""
    spark = docs.sparkSession
    both = spark.sparkContext.broadcast((word_bits, pair_bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in _batches(batches):
            keyed = p.keyed()
            common = _holds(both.value[0], keyed)
            linked = np.zeros(len(p), bool)
            at = np.flatnonzero(p.joined[:-1] & common[:-1] & common[1:])
            linked[at] = _holds(both.value[1], _pair(keyed, at))
            # Words that are linked to their predecessors: how many in a row.
            before = np.concatenate(([False], linked[:-1]))
            place = np.arange(len(p))
            depth = place - np.maximum.accumulate(np.where(before, 0, place))
            whole = np.flatnonzero(depth >= longest - 1)
            stop = np.flatnonzero((depth > 0) & ~linked)
            first = np.concatenate((whole - longest + 1, stop - np.minimum(depth[stop], longest - 2)))
            last = np.concatenate((whole, stop))
            if not len(first):
                continue
            ids = p.ids()
            size = last - first + 1
            for words in range(2, longest + 1):
                mine = np.flatnonzero(size == words)
                if not len(mine):
                    continue
                key = _phrase_keys(ids, first[mine], words)
                key = np.unique(p.lang[first[mine]] << 40 | key, return_inverse=True)[1]
                head, n = _tally(key)
                a, b = first[mine[head]], last[mine[head]]
                yield pa.RecordBatch.from_arrays([
                    p.langs.take(pa.array(p.lang[a])), p.phrases(a, b), pa.array(np.full(len(a), words, np.int32)), pa.array(n),
                ], ["lang", "phrase", "words", "n"])

    sent = docs.select("lang", "text").mapInArrow(run, "lang string, phrase string, words int, n long")
    return scratch.write(sent.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")), "collocation-edges")


def _head(words) -> Column:
    return F.substring_index("phrase", " ", words)


def _tail(words: int) -> Column:
    return F.substring_index("phrase", " ", -words)


def levels(graph: DataFrame, longest: int = LONGEST) -> dict[int, DataFrame]:
    """lang, phrase, a for each number of words: the flow out of each node and the ends at it."""
    found = {longest: graph.where(F.col("words") == longest).select("lang", "phrase", F.col("n").alias("a"))}
    ends = graph.where(F.col("words") < longest)
    for words in range(longest - 1, 1, -1):
        flow = found[words + 1].select("lang", _head(words).alias("phrase"), "a")
        stop = ends.where(F.col("words") >= words).select("lang", _tail(words).alias("phrase"), F.col("n").alias("a"))
        level = flow.union(stop).groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
        found[words] = scratch.write(level, f"collocation-{words}")
    return found


def contract(counted: dict[int, DataFrame], least: int = LEAST) -> DataFrame:
    """lang, phrase, words, a, covered: phrases counted ``least`` times, and whether all of their flow
    goes through one phrase of one word more."""
    common = {w: df.where(F.col("a") >= least) for w, df in counted.items()}
    rows = None
    for words, df in common.items():
        own = df.select("lang", "phrase", "a", F.lit(None).cast("long").alias("through"))
        if words + 1 in common:
            longer = common[words + 1]
            for part in (_head(words), _tail(words)):
                own = own.union(longer.select("lang", part.alias("phrase"), F.lit(None).cast("long"), F.col("a")))
        level = own.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("through").alias("through"))
        level = level.select("lang", "phrase", F.lit(words).alias("words"), "a", (F.coalesce("through", F.lit(0)) >= F.col("a")).alias("covered"))
        rows = level if rows is None else rows.union(level)
    return scratch.write(rows, "collocation-phrases")


def unary_paths(phrases: DataFrame, longest: int = LONGEST) -> DataFrame:
    """lang, phrase, path_words: the words of the unary path that an edge lies on.

    Two edges are on one path if the whole flow of the node between them comes by the one and leaves by the
    other.  Each edge learns its path's last edge by doubling: the rounds are the logarithm of the longest path.
    A path cannot close, since every piece ends and takes its flow out of the graph.
    """
    edges = phrases.where(F.col("words") == longest)
    node = phrases.where(F.col("words") == longest - 1).select("lang", F.col("phrase").alias("node"), "a")
    into = edges.select("lang", _tail(longest - 1).alias("node"), "a", "phrase")
    out = edges.select("lang", _head(longest - 1).alias("node"), "a", F.col("phrase").alias("next"))
    step = into.join(node, ["lang", "node", "a"]).join(out, ["lang", "node", "a"]).select("lang", "phrase", "next")
    at = edges.select("lang", "phrase").join(step, ["lang", "phrase"], "left")
    # The last edge of a path points at itself.
    at = at.select("lang", "phrase", F.coalesce("next", "phrase").alias("to"), F.when(F.col("next").isNull(), 0).otherwise(1).alias("far"))
    at = scratch.write(at, "collocation-paths")
    while True:
        there = at.select("lang", F.col("phrase").alias("to"), F.col("to").alias("beyond"), F.col("far").alias("more"))
        moved = at.join(there, ["lang", "to"]).select("lang", "phrase", F.col("beyond").alias("to"), (F.col("far") + F.col("more")).alias("far"), "more")
        moved = scratch.write(moved, "collocation-paths")
        if moved.where("more > 0").isEmpty():
            break
        at = moved.drop("more")
    size = at.groupBy("lang", "to").agg((F.max("far") + longest).alias("path_words"))
    return at.join(size, ["lang", "to"]).select("lang", "phrase", "path_words")


#: floor(1000 a n / (l r)) of long columns; 38 digits hold the products.
SCORE = "(cast(a AS decimal(19,0)) * cast(n AS decimal(19,0)) * 1000) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))"


def cut_scores(candidates: DataFrame, counted: DataFrame, totals: DataFrame) -> DataFrame:
    """``candidates`` with n and the lowest score of their cuts, its l and r; ties go to the first cut.

    Both parts of a cut are counted at least as often as the phrase, so they are among ``counted``.
    """
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "words", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("first"), F.expr("substring_index(phrase, ' ', k - words)").alias("rest"),
    )
    part = lambda key, name: counted.select("lang", F.col("phrase").alias(key), F.col("a").alias(name))
    joined = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    best = F.min(F.struct(F.expr(SCORE).alias("score"), "k", "l", "r")).alias("best")
    return joined.groupBy("lang", "phrase", "words", "a", "n").agg(best).select("lang", "phrase", "words", "a", "n", "best.score", "best.l", "best.r")


def ranked(scored: DataFrame, most: int = RANKED) -> DataFrame:
    """The first ``most`` phrases of each lang by score, count and phrase; no task sorts a whole language."""
    by = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("_part")
    near = scored.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*by))).where(F.col("rank") <= most)
    return near.drop("_part").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).where(F.col("rank") <= most)


@shipped
def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, most: int = RANKED, paths: bool = False, bits: tuple[int, int] = (WORD_BITS, PAIR_BITS)) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score; with ``paths`` also path_words: the length of the unary
    path of a phrase of ``longest`` words, else its own."""
    words = word_counts(docs)
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    graph = edges_and_ends(docs, *frequent_pairs(docs, words, least, bits), longest)
    phrases = contract(levels(graph, longest), least)
    counted = words.where(F.col("a") >= least).select("lang", "phrase", "a").union(phrases.select("lang", "phrase", "a"))
    best = ranked(cut_scores(phrases.where("NOT covered"), counted, totals), most)
    found = best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "words")
    if not paths:
        return found.drop("words")
    found = found.join(unary_paths(phrases, longest), ["lang", "phrase"], "left")
    return found.withColumn("path_words", F.coalesce("path_words", "words")).drop("words")
