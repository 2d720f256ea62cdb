"""Mixing sources to target weights, with DataFrame operations only.

Every document gets a hash-random key. Within a source, documents are ordered by key
(key ranges are dealt to tasks and sorted there), a distributed prefix sum of word counts runs
over that order, and the source is cut where its budget ends; a budget above the source's
size takes whole epochs first. The prefix sum has three levels (256 coarse ranges,
256 fine ranges in each, rows in a fine range), so no task sees more than a 65,536th of a
source's rows and the totals that are joined back stay small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, stage_table, unpack, word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
_SOURCE = ["no_source", "source"]
_BEFORE = (Window.unboundedPreceding, -1)


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``no_source, source, source_size, target``: what each source gives to the mix.

    Sources in order of code points, null last, take the weights in turn and share the total
    size; no target is above ``max_epochs`` times its source, and what is over goes to the
    others by weight. With sources in order of cap per unit of weight, the level reached after capping
    the first k rises while sources are capped and falls after, so its maximum is the final level.
    The windows here run over one row per source.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(*_SOURCE)) - 1)
    weighted = ranked.select(*_SOURCE, "source_size", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"))
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    order = Window.orderBy(cap / F.col("weight"), *_SOURCE).rowsBetween(*_BEFORE)
    every = Window.partitionBy()
    level = (F.sum(F.col("source_size").cast("double")).over(every) - F.coalesce(F.sum(cap).over(order), F.lit(0.0))) \
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(order), F.lit(0.0)))
    return (weighted.withColumn("level", level).withColumn("level", F.max("level").over(every))
            .select(*_SOURCE, "source_size", F.least(cap, F.col("weight") * F.col("level")).alias("target")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        keep_row: bool = False, seed: int = 0) -> DataFrame:
    """Every row with its part in the mix.

    Columns: ``id, source, size, source_size, target, before`` (words of its source ahead of it
    in the random order), ``epochs`` (whole passes over its source), ``rest`` (words of the source
    the last, partial pass takes), ``taken`` (words taken, repeats counted), and ``row`` (all input columns)
    if asked for. The word budget of a source is its target, rounded.

    A null source is a source of its own, last in order. A null or wordless text has size 0. Rows with equal
    ids are ordered by size; equal rows share their fate up to the cut. An empty table gives an empty result.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    base = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), word_count(F.col(text_col)).alias("size"),
        key.alias("key"), F.substring(key, 1, 2).alias("coarse"), F.substring(key, 3, 2).alias("fine"),
        *([packed(docs).alias("row")] if keep_row else []))
    if not keep_row:  # no texts in it: stored, so that they are counted once; whole rows are dearer to store than to count again
        base = stage_table(base, "mix-rows")

    fine = stage_table(base.groupBy(*_SOURCE, "coarse", "fine").agg(F.sum("size").alias("size")), "mix-ranges")
    coarse = stage_table(fine.groupBy(*_SOURCE, "coarse").agg(F.sum("size").alias("size")), "mix-coarse")
    sources = stage_table(source_targets(coarse.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size"))), "mix-sources")

    def running(by, order):
        return F.coalesce(F.sum("size").over(Window.partitionBy(*by).orderBy(*order).rowsBetween(*_BEFORE)), F.lit(0))

    budget = F.round("target").cast("long")
    of_coarse = coarse.select(*_SOURCE, "coarse", running(_SOURCE, ["coarse"]).alias("coarse_before"))
    of_fine = fine.select(*_SOURCE, "coarse", "fine", running([*_SOURCE, "coarse"], ["fine"]).alias("fine_before"))
    ranges = stage_table(
        of_fine.join(of_coarse, [*_SOURCE, "coarse"]).join(sources, _SOURCE)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
        .select(*_SOURCE, "coarse", "fine", (F.col("coarse_before") + F.col("fine_before")).alias("range_before"), "source_size",
                "target", "epochs", (budget - F.col("epochs") * F.col("source_size")).alias("rest")), "mix-plan")

    where = [*_SOURCE, "coarse", "fine"]
    placed = base.join(ranges, where).withColumn("before", F.col("range_before") + running(where, ["key", "id", "size"]))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return placed.select(
        "id", F.when(~F.col("no_source"), F.col("source")).alias("source"), "size", "source_size", "target", "before", "epochs", "rest",
        (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"), *(["row"] if keep_row else []))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  seed: int = 0) -> DataFrame:
    """The mixed corpus: every input column, each document as often as the mix takes it.

    Documents stay whole: the one at the cut is taken if at least half of it lies before the cut, so a source
    ends within half a document of its budget. Documents beyond a source's budget are left out.
    """
    placed = mix(docs, id_col, text_col, source_col, keep_row=True, seed=seed)
    last = ((F.col("rest") > 0) & (2 * F.col("before") + F.col("size") <= 2 * F.col("rest"))).cast("long")
    copies = (F.col("epochs") + last).cast("int")
    out = placed.where(copies > 0).select("row", F.explode(F.sequence(F.lit(1), copies)).alias("pass"))
    return unpack(out, docs.schema)
