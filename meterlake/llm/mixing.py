"""Mix sources to target weights: hash-random order, distributed prefix sums, exact cuts.

Documents of a source are put into a random order given by a hash of ``seed`` and doc_id, range
sorted, and running word counts tell where the source's budget ends.  A budget above the source's
size takes whole epochs first; the last, partial epoch is cut inside the document that crosses it.

Defined cases: a null or empty text has size 0 and is taken 0 times; sources are ordered by code
point with null last; rows with equal doc_id keep their own size and are ordered by it; an empty
table gives an empty result; other columns are kept by ``mixed_documents`` and ignored by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm import ordering, scratch

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_EPOCHS) -> DataFrame:
    """Add ``target`` to a table of ``source`` and ``source_size``.

    Sources get ``share`` of all words in proportion to their weights, but stop at ``most`` times
    their size; what they leave is shared again by weight among the rest.  In the order of
    size by weight the full ones are a prefix, so two running sums give the same result at once.
    The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    df = sources.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * most)
    df = df.withColumn("_all", F.sum("source_size").over(everything) * F.lit(float(share)))
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    df = df.withColumn("_level", left / F.sum("_w").over(rest))
    # Full: the level at its turn is at least its capacity by weight.
    df = df.withColumn("_full", F.col("_level") >= F.col("_cap") / F.col("_w"))
    level = F.max(F.when(~F.col("_full"), F.col("_level"))).over(everything)  # the first; later ones are lower
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(F.least(F.col("_cap").cast("double"), level * F.col("_w")))
    return df.select("source", "source_size", target.alias("target"))


def plan(docs: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST_EPOCHS, seed=SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, size, source, source_size, target, taken (words)."""
    narrow = docs.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        F.xxhash64("text").alias("text_key"),
        F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"))).alias("_key"),
    )
    narrow = scratch.write(narrow, "mix-sizes")
    sources = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = scratch.write(source_targets(sources, weights, share, most), "mix-sources")
    order = [F.col("source").asc_nulls_last(), F.col("_key"), F.col("doc_id"), F.col("size"), F.col("text_key")]
    placed = ordering.positions(narrow, order, {"_words": "size"})
    first = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    starts = sources.withColumn("_start", F.coalesce(F.sum("source_size").over(first), F.lit(0)))
    starts = starts.withColumnRenamed("source", "_source")
    # One row per source beside narrow rows; the planner broadcasts it only if it is small.
    out = placed.join(starts, F.col("source").eqNullSafe(F.col("_source")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target")) - epochs * F.col("source_size")
    within = F.greatest(F.lit(0), F.least(F.col("size"), rest - (F.col("_words") - F.col("_start"))))
    return out.select(
        "doc_id",
        "text_key",
        "source",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + within).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: whole copies of each document, and the cut one up to its last taken word.

    Rows keep the columns of ``docs``; ``n_chars`` of a cut text is set anew where there is one.
    Documents of size 0 hold no words and stay once.
    """
    names = docs.columns
    marks = plan(docs, **options).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_tk"), F.col("size").alias("_size"), F.col("taken").alias("_taken")
    )
    marks = scratch.write(marks, "mix-marks")
    # All columns travel in one struct, so that none can clash.
    rows = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_key"), F.col("text").alias("_text"), F.struct("*").alias("_row"))
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_tk"))
    if not marks.groupBy("_id", "_tk").count().where("count > 1").isEmpty():
        # Equal rows may be taken differently at the cut: number them on both sides.
        marks = marks.withColumn("_twin", F.row_number().over(Window.partitionBy("_id", "_tk").orderBy(F.desc("_taken"))))
        rows = rows.withColumn("_no", F.row_number().over(Window.partitionBy("_doc", "_key").orderBy(F.lit(1))))
        same = same & (F.col("_twin") == F.col("_no"))
    joined = rows.join(marks, same).select("_row", "_text", "_size", "_taken")
    whole = F.when(F.col("_size") == 0, F.lit(1)).otherwise(F.floor(F.col("_taken") / F.col("_size"))).cast("int")
    cut = F.when(F.col("_size") == 0, F.lit(0)).otherwise(F.col("_taken") % F.col("_size")).cast("int")
    joined = joined.withColumn("_n", whole).withColumn("_cut", cut)
    joined = joined.withColumn("_part", F.explode(F.expr("IF(_n + IF(_cut > 0, 1, 0) > 0, sequence(1, _n + IF(_cut > 0, 1, 0)), array())")))
    # The words up to the cut, each with what stands before it.
    head = F.array_join(
        F.zip_with(
            F.slice(F.split("_text", WORD), F.lit(1), F.col("_cut")),
            F.slice(F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("_cut")),
            lambda gap, word: F.concat(gap, word),
        ),
        "",
    )
    is_cut = F.col("_part") > F.col("_n")
    joined = joined.withColumn("_new", F.when(is_cut, head).otherwise(F.col("_text")))
    out = {c: F.col(f"_row.`{c}`") for c in names}
    out["text"] = F.col("_new")
    if "n_chars" in names:
        out["n_chars"] = F.when(is_cut, F.length("_new").cast(docs.schema["n_chars"].dataType)).otherwise(out["n_chars"])
    return joined.select(*[v.alias(k) for k, v in out.items()])
