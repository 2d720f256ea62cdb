"""Quality rules with adaptive thresholds, with DataFrame operations only.

Counts of each document become ratios. Per language and source, a mergeable quantile
sketch describes each ratio: counts in buckets of equal relative width (2 %), which add up
exactly whatever the partitioning, so reruns give the same thresholds. A ratio is rejected above
its group's third quartile by more than ``FENCE`` spreads: the group's interquartile range, or the
mean deviation of all documents from their groups' medians where that is wider, so that groups of
one value have a spread too. For ratios with a long tail in good texts the threshold is the ``TAIL`` quantile over
all documents at least. No cutoff is fixed. Groups with few documents fall back on their language's sketch, then on all. The
verdict joins every document with its group's thresholds, and allows for the counting error of its own ratio.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, packed, stage_table, unpack

SPACE = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Relative width of a sketch bucket.
GAMMA = 1.02
FENCE = 3.0
#: Documents a group needs for thresholds of its own.
MIN_GROUP = 50
#: Quantile over all documents below which ratios with a long tail are not rejected.
TAIL = 0.99
#: Ratio -> (numerator, denominator, counts that come at once, whether good texts have a long tail). A text has few
#: lines, and a repeated triple covers six words; 0 allows for no counting error, as a text has hundreds of characters.
RATIOS = {
    "symbol_ratio": ("n_symbols", "word_chars", 0, False),
    "dup_line_ratio": ("n_dup_lines", "n_lines", 1, True),
    "repeat_ratio": ("n_repeat_words", "n_words", 6, True),
    "word_length": ("word_chars", "n_words", 1, False),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def with_counts(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the columns of ``COUNTS`` for its text column, which is dropped. All counts are 0 for null.

    Word triples are compared by a 64-bit hash within one text. Intermediate arrays are as long as the text.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, SPACE), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.rlike(x, F.lit(WORD)))
    rest = [c for c in df.columns if c != text]
    d = df.select(*rest, (F.length(t) - F.length(F.regexp_replace(t, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
                  words.alias("_w"), lines.alias("_l"))
    triples = F.transform(F.slice("_w", 1, F.greatest(F.lit(0), F.size("_w") - 2)),
                          lambda w, i: F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2)))
    d = d.select(*rest, "n_symbols", F.size("_w").cast("long").alias("n_words"), F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                 F.size("_l").cast("long").alias("n_lines"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
                 triples.alias("_h"))
    # only texts with a repeated triple go on: triples sorted by hash, repeats next to each other
    repeated = F.size(F.array_distinct("_h")) < F.size("_h")
    at = F.when(repeated, F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    keep = [*rest, *[c for c in COUNTS if c != "n_repeat_words"]]
    d = d.select(*keep, at.alias("_s"))
    twice = F.filter("_s", lambda x, i: F.coalesce(F.get("_s", i - 1)["h"] == x["h"], F.lit(False))
                     | F.coalesce(F.get("_s", i + 1)["h"] == x["h"], F.lit(False)))
    d = d.select(*keep, F.array_sort(F.transform(twice, lambda x: x["i"])).alias("_p"))
    # a window covers three words, less where the next one begins sooner
    covered = F.aggregate(F.transform("_p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_p", i + 1) - p, F.lit(3)))),
                          F.lit(0), lambda a, x: a + x)
    return d.select(*rest, *[F.coalesce(covered, F.lit(0)).cast("long").alias(c) if c == "n_repeat_words" else F.col(c) for c in COUNTS])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _ratio(name: str) -> Column:
    top, bottom = RATIOS[name][:2]
    return F.when(F.col(bottom) > 0, F.col(top) / F.col(bottom)).otherwise(F.lit(0.0))


def _sure(name: str) -> Column:
    """The ratio less ``FENCE`` standard errors of its count: what is surely there, however short the text."""
    _, bottom, unit, _ = RATIOS[name]
    return _ratio(name) - FENCE * F.sqrt(_ratio(name) * F.lit(float(unit)) / F.greatest(F.col(bottom), F.lit(1)))


def sketches(counted: DataFrame) -> DataFrame:
    """``lang, source, name, bucket, n``: the quantile sketches of every language and source.

    Bucket ``b`` holds values in (GAMMA^(b-1), GAMMA^b], null holds zeros. Sketches of two tables, or of two groups,
    merge by adding counts. Documents that fail the fixed rules don't count.
    """
    value = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), _ratio(n).alias("value")) for n in RATIOS])).alias("v")
    v = counted.where(~base_failed()).select("lang", "source", value)
    bucket = F.when(F.col("v.value") > 0, F.ceil(F.log(F.col("v.value")) / F.lit(log(GAMMA))).cast("int"))
    return v.select("lang", "source", "v.name", bucket.alias("bucket")).groupBy("lang", "source", "name", "bucket").agg(F.count("*").alias("n"))


def _quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """``by, name, total, q1, q2, q3, tail`` from sketches: windows over the buckets of one group, a few hundred rows."""
    group = sketch.groupBy(*by, "name", "bucket").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*by, "name").orderBy(F.col("bucket").asc_nulls_first())
    ranked = group.select(*by, "name", "bucket", F.sum("n").over(order).alias("upto"), F.sum("n").over(Window.partitionBy(*by, "name")).alias("total"))
    at = [F.min(F.when(F.col("upto") >= k * F.col("total"), _edge())).alias(c) for c, k in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75), ("tail", TAIL))]
    return ranked.groupBy(*by, "name").agg(F.max("total").alias("total"), *at)


def _edge() -> Column:
    return F.when(F.col("bucket").isNull(), F.lit(0.0)).otherwise(F.pow(F.lit(GAMMA), F.col("bucket")))


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per language and source with the upper threshold of each ratio.

    A group of fewer than ``MIN_GROUP`` documents uses its language's quartiles, and those of all where
    the language has too few as well. Where all have too few, thresholds are null: nothing can be told from them.
    """
    own, lang, every = _quartiles(sketch, ["lang", "source"]), _quartiles(sketch, ["lang"]), _quartiles(sketch, [])
    middle = own.select(F.col("lang").alias("l"), F.col("source").alias("s"), F.col("name").alias("m"), "q2")
    # the mean deviation is rounded, as the order of a sum of doubles can change its last digits
    apart = sketch.join(middle, sketch.lang.eqNullSafe(F.col("l")) & sketch.source.eqNullSafe(F.col("s")) & (sketch.name == F.col("m"))) \
        .groupBy("name").agg(F.round(F.sum(F.col("n") * F.abs(_edge() - F.col("q2"))) / F.sum("n"), 9).alias("least"))
    lang = lang.select(F.col("lang").alias("l"), "name", *[F.col(c).alias(f"lang_{c}") for c in ("total", "q1", "q3")])
    every = every.join(apart, "name").select("name", "least", "tail", *[F.col(c).alias(f"all_{c}") for c in ("total", "q1", "q3")])
    t = own.drop("tail").join(lang, own.lang.eqNullSafe(F.col("l")) & (own.name == lang.name)).drop(lang.name).join(every, "name")

    def of(q: str) -> Column:
        return F.when(F.col("total") >= MIN_GROUP, F.col(q)).when(F.col("lang_total") >= MIN_GROUP, F.col(f"lang_{q}")) \
            .when(F.col("all_total") >= MIN_GROUP, F.col(f"all_{q}"))

    fence = of("q3") + FENCE * F.greatest(of("q3") - of("q1"), F.col("least"))
    long_tail = F.col("name").isin([n for n in RATIOS if RATIOS[n][3]])
    fence = F.when(long_tail & fence.isNotNull(), F.greatest(fence, F.col("tail"))).otherwise(fence)
    return t.groupBy("lang", "source").agg(*[F.max(F.when(F.col("name") == n, fence)).alias(f"max_{n}") for n in RATIOS])


def judge(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          keep: list[str] | None = None) -> DataFrame:
    """``row`` (the input columns, or those in ``keep``), the counts, ``base_failed`` and ``kept`` for every row.

    A null or wordless text has counts of 0 and fails the fixed rules. A null language or source is a group of its own.
    Repeated rows are judged alike; an empty table gives an empty result. The counted rows
    are written once to the shared folder, so the texts are analysed a single time.
    """
    counted = with_counts(docs.select((F.struct(*keep) if keep else packed(docs)).alias("row"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
                                      F.col(source_col).cast("string").alias("source")), "text")
    counted = stage_table(counted, "quality-counts")
    limits = stage_table(thresholds(stage_table(sketches(counted), "quality-sketches")), "quality-limits")
    limits = limits.select(F.col("lang").alias("l"), F.col("source").alias("s"), *[f"max_{n}" for n in RATIOS])
    joined = counted.join(limits, counted.lang.eqNullSafe(F.col("l")) & counted.source.eqNullSafe(F.col("s")), "left")
    fine = reduce(lambda a, b: a & b, [F.coalesce(_sure(n) <= F.col(f"max_{n}"), F.lit(True)) for n in RATIOS])
    return joined.select("row", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & fine).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    return unpack(judge(docs, text_col, lang_col, source_col).where("kept"), docs.schema)
