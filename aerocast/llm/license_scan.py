"""License scans by diagonal voting, with DataFrame operations only.

All rolling word k-grams of all texts are hashed and joined to the positions that hold them in the license
templates; a hit counts if the words themselves are equal. A hit votes for its diagonal, the word offset between text
and template. Votes are added up per text, template and diagonal. Words put in or left out move the rest of a copy to a
neighbouring diagonal, so diagonals that lie within an eighth of the template's length of each other merge. A merged
span is verified by the share of the template's words that it covers (``MIN_COVER``) and by the words it
stretches over; where the whole does not pass, its diagonals are verified one by one.

A template shorter than ``K`` words is one gram of its own length, so a phrase is found wherever its words
stand one after the other, and its spans never merge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, stage_table
from .license_texts import PHRASES, TEXTS

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a gram.
K = 3
#: Part of a template's words that a span has to cover, and part of a span's words that are to be covered.
MIN_COVER, MIN_DENSITY = 0.8, 0.5
#: A diagonal needs one vote for so many grams of its template (one at least); diagonals within a template's length by this merge.
GRAMS_A_VOTE, SHIFT_PART = 32, 8
SPAN = "array<struct<start:int,end:int,template:int,label:string,base:boolean,coverage:double>>"


def words(text: Column) -> Column:
    """Words in order, A-Z in lower case; none for null."""
    t = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(F.translate(t, ASCII_UPPER, ASCII_LOWER))
    return F.filter(F.split(low, NO_WORD), lambda w: w != "")


def _grams(words_col: str, k: int) -> Column:
    """Hashes of all runs of ``k`` words, by their first word."""
    some = F.slice(words_col, 1, F.greatest(F.lit(0), F.size(words_col) - (k - 1)))
    return F.transform(some, lambda w, i: F.xxhash64(w, *[F.get(words_col, i + j) for j in range(1, k)]))


def template_grams(spark: SparkSession, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]) -> DataFrame:
    """``gram, k, tpos, gram_words, template, label, base, length``: every gram position of the templates.

    The templates are a curated list that the caller holds in memory; those without words are never found.
    """
    rows = [(i, label, i < len(phrases), text) for i, (label, text) in enumerate([*phrases, *templates])]
    t = spark.createDataFrame(rows, "template int, label string, base boolean, text string")
    t = t.select("template", "label", "base", words(F.col("text")).alias("_w"))
    t = t.withColumn("length", F.size("_w")).withColumn("k", F.least(F.lit(K), F.size("_w"))).where("length > 0")
    found = t.select("*", F.posexplode(
        F.when(F.col("k") == 1, _grams("_w", 1)).when(F.col("k") == 2, _grams("_w", 2)).otherwise(_grams("_w", K))).alias("tpos", "gram"))
    return found.select("gram", "k", "tpos", F.slice("_w", F.col("tpos") + 1, F.col("k")).alias("gram_words"), "template", "label", "base", "length")


def hits(docs: DataFrame, grams: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """One row per text (``template`` null) and one per text, template position and equal gram; ``docs`` has ``id, text``.

    ``row`` tells the rows of ``docs`` apart. The result is written once: a row's number and its hits come from one task.
    """
    d = docs.select(F.monotonically_increasing_id().alias("row"), "id", words(F.col("text")).alias("_w"))
    # the first element stands for the text itself; then come the grams of each size
    every = F.concat(F.array(F.lit(None).cast("long")), *[_grams("_w", k) for k in sizes])
    d = d.select("row", "id", "_w", every.alias("_g")).select("row", "id", "_w", F.posexplode("_g").alias("at", "gram"))
    n, start = F.size("_w"), F.lit(1)
    k, pos = F.lit(0), F.lit(-1)
    for size in reversed(sizes):  # the parts of the array, last one first
        begin = start + sum((F.greatest(F.lit(0), n - (s - 1)) for s in sizes if s < size), F.lit(0))
        inside = (F.col("at") >= begin) & (F.col("at") < begin + F.greatest(F.lit(0), n - (size - 1)))
        k, pos = F.when(inside, F.lit(size)).otherwise(k), F.when(inside, F.col("at") - begin).otherwise(pos)
    g = grams.select(F.col("gram").alias("g"), F.col("k").alias("tk"), "tpos", "gram_words", "template")
    # a curated list of templates: its positions are bounded by what the caller holds in memory
    j = d.join(F.broadcast(g), F.col("gram") == F.col("g"), "left").where("at = 0 OR g IS NOT NULL")
    same = (k == F.col("tk")) & (F.slice("_w", pos + 1, F.greatest(k, F.lit(1))) == F.col("gram_words"))
    j = j.where((F.col("at") == 0) | F.coalesce(same, F.lit(False)))
    return stage_table(j.select("row", F.when(F.col("at") == 0, F.col("id")).alias("id"), F.when(F.col("at") == 0, n).alias("n_words"),
                                "template", "tpos", pos.alias("dpos")), "license-hits")


def _covered(at: Column, k: Column) -> Column:
    """Words of the template under the grams at its positions ``at``."""
    p = F.array_sort(F.array_distinct(at))
    return F.aggregate(p, F.struct(F.lit(-1).alias("end"), F.lit(0).alias("n")), lambda a, x: F.struct(
        (x + k).alias("end"), (a["n"] + x + k - F.greatest(x, a["end"])).alias("n")), lambda a: a["n"])


def _spans(found: DataFrame, templates: DataFrame) -> DataFrame:
    """``row, spans`` of the texts that have any, from their hits."""
    t = F.broadcast(templates)  # one row a template
    votes = found.groupBy("row", "template", (F.col("dpos") - F.col("tpos")).alias("diagonal")).agg(
        F.collect_set("tpos").alias("at"), F.min("dpos").alias("first"), F.max("dpos").alias("last"))
    strong = votes.join(t, "template").where(
        F.size("at") >= F.greatest(F.lit(1), F.floor((F.col("length") - F.col("k") + 1) / F.lit(GRAMS_A_VOTE))))
    order = Window.partitionBy("row", "template").orderBy("diagonal")
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > F.floor(F.col("length") / F.lit(SHIFT_PART)), F.lit(True))
    strong = strong.withColumn("far", far).withColumn("merged", F.sum(F.col("far").cast("int")).over(order))
    one = F.struct((F.col("last") + F.col("k")).alias("end"), F.col("first").alias("start"), "at")
    groups = strong.groupBy("row", "template", "merged", "label", "base", "length", "k").agg(F.array_sort(F.collect_list(one)).alias("parts"))
    whole = F.struct(F.array_max(F.transform("parts", lambda p: p["end"])).alias("end"), F.array_min(F.transform("parts", lambda p: p["start"])).alias("start"),
                     F.flatten(F.transform("parts", lambda p: p["at"])).alias("at"))

    def judged(p: Column) -> Column:
        n = _covered(p["at"], F.col("k"))
        fine = (n >= F.lit(MIN_COVER) * F.col("length")) & (n >= F.lit(MIN_DENSITY) * (p["end"] - p["start"]))
        return F.struct(p["start"].alias("start"), p["end"].alias("end"), "template", "label", "base", (n / F.col("length")).alias("coverage"), fine.alias("fine"))

    groups = groups.select("row", judged(whole).alias("whole"), F.transform("parts", judged).alias("parts"))
    fine = F.when(F.col("whole.fine"), F.array("whole")).otherwise(F.filter("parts", lambda p: p["fine"]))
    spans = groups.groupBy("row").agg(F.array_sort(F.flatten(F.collect_list(fine))).alias("spans")).where(F.size("spans") > 0)
    return spans.select("row", F.transform("spans", lambda s: s.dropFields("fine")).cast(SPAN).alias("spans"))


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str]] = tuple(TEXTS),
                   phrases: Sequence[tuple[str, str]] = tuple(PHRASES)) -> DataFrame:
    """``id_col, n_words, spans`` for every row of ``docs``.

    ``spans`` is an array of (start, end, template, label, base, coverage), in that order: places in words from 0, end
    exclusive; ``template`` numbers the phrases, then the templates; ``base`` marks phrases. Of a gram that a template
    holds twice each place votes. A null, empty or wordless text has no words and no spans; repeated rows are scanned
    each on its own, also with equal or null ids; other columns are ignored; an empty table gives an empty result. A text is scanned whole,
    its words and their hashes are held at once. Without templates and phrases nothing is found.
    """
    spark = docs.sparkSession
    grams = template_grams(spark, list(templates), list(phrases))
    sizes = sorted({min(K, r[0]) for r in grams.select("length").distinct().collect()})  # K values at most
    found = hits(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), grams, sizes)
    names = grams.select("template", "label", "base", "length", "k").distinct()
    spans = _spans(found.where("template IS NOT NULL").select("row", "template", "tpos", "dpos"), names)
    rows = found.where("template IS NULL").select("row", "id", "n_words")
    return rows.join(spans, "row", "left").select(F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"),
                                                  F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))
