"""URL filters: curated host and path rules, then a path-template tree per host.

The tree is kept as a table of templates with counts. Segments that are numbers, dates or
identifiers by their form become wildcards at once. Then, depth by depth, the children of a node
become the wildcard ``*`` where the node has many rare children (a variable segment), or where their share of bad pages does not
differ from that of their siblings together (statistically similar branches merge: two proportions, ``EVIDENCE`` labelled pages on
either side). A child that differs stays apart, also in a variable segment, and a wildcard stands for two children at least. A template
is rejected when the share of bad pages among its labelled ones, smoothed towards its host's and the
host's towards all, reaches ``REJECT``, from ``MIN_BAD`` bad pages on. Pages without a label count for neither side:
a branch with too few labels merges only where its node has no bad page.

All passes after the first run over templates with counts, not over pages.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, stage_table

Rule = tuple[str, str, str]  # host, path, verdict

#: A node has a variable segment from so many children on, if they have fewer pages each than RARE on average.
MANY, RARE = 20, 5.0
#: Standard errors by which a branch must differ from its siblings to stay apart, and labelled pages that each side needs to be compared.
APART, EVIDENCE = 2.0, 5
PRIOR = 10.0
REJECT = 0.5
MIN_BAD = 5


def host_of(url: Column) -> Column:
    """Host with A-Z in lower case; empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, ASCII_UPPER, ASCII_LOWER)


def path_of(url: Column) -> Column:
    """Path from the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def by_rules(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls. ``rules`` is a short curated list."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def by_form(path: Column) -> Column:
    """Segments of a path, with numbers, dates and identifiers as wildcards; a file's extension stays."""
    def one(s: Column) -> Column:
        s = F.regexp_replace(s, r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?=\.|$)", "<id>")
        s = F.regexp_replace(s, r"^\d{4}-\d{2}-\d{2}(?=\.|$)", "<date>")
        s = F.regexp_replace(s, r"^\d+(?=\.|$)", "<n>")
        return F.regexp_replace(s, r"(?i)^(?=[a-z]*\d)[0-9a-f]{8,}(?=\.|$)", "<id>")
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), one)


def template_verdicts(pages: DataFrame) -> DataFrame:
    """``host, form, template, bad_share, rejected`` from ``host, form, bad`` (boolean, null without a label) of pages.

    Depths are worked through as long as two templates share a node; below that, no node has a second child.
    """
    t = stage_table(pages.groupBy("host", "form").agg(F.count("*").alias("n"), F.count("bad").alias("n_known"), F.count_if("bad").alias("n_bad"))
                    .withColumn("template", F.col("form")), "url-forms")
    for d in count(1):
        head = F.slice("template", 1, d - 1)
        child = F.get("template", F.lit(d - 1))
        level = t.where(F.size("template") >= d).select(
            "host", head.alias("head"), child.alias("child"), "template", "n", "n_known", "n_bad")
        if level.groupBy("host", "head").agg((F.min("template") < F.max("template")).alias("several")).where("several").isEmpty():
            break
        children = level.groupBy("host", "head", "child").agg(*[F.sum(c).alias(c) for c in ("n", "n_known", "n_bad")])
        children = stage_table(children, "url-children")
        node = children.groupBy("host", "head").agg(F.count("*").alias("width"), F.sum("n").alias("all_n"),
                                                    F.sum("n_known").alias("all_known"), F.sum("n_bad").alias("all_bad"))
        node = stage_table(node, "url-nodes")
        share = F.try_divide("all_bad", "all_known")
        others, others_bad = F.col("all_known") - F.col("n_known"), F.col("all_bad") - F.col("n_bad")
        enough = (F.col("n_known") >= EVIDENCE) & (others >= EVIDENCE)
        error = F.sqrt(share * (1 - share) * (1 / F.col("n_known") + 1 / others))
        apart = F.abs(F.col("n_bad") / F.col("n_known") - others_bad / others)
        differs = F.when(enough, apart > APART * error).otherwise(F.lit(False))
        variable = (F.col("width") >= MANY) & (F.col("all_n") < RARE * F.col("width"))
        similar = (enough & ~differs) | (F.col("all_bad") == 0)
        found = stage_table(children.join(node, ["host", "head"]).select(
            "host", "head", "child", ((F.col("width") > 1) & (variable | similar) & ~differs).alias("merge")), "url-found")
        several = found.where("merge").groupBy("host", "head").agg((F.count("*") > 1).alias("several"))
        merged = stage_table(found.join(several, ["host", "head"], "left").select(
            "host", "head", "child", (F.col("merge") & F.coalesce("several", F.lit(False))).alias("merge")), "url-merged")
        keyed = t.withColumn("head", head).withColumn("child", F.coalesce(child, F.lit("")))
        t = stage_table(keyed.join(merged, ["host", "head", "child"], "left").select(
            "host", "form", "n", "n_known", "n_bad", F.when(F.coalesce("merge", F.lit(False)) & (F.size("template") >= d), F.concat(
                head, F.array(F.lit("*")), F.slice("template", d + 1, F.greatest(F.lit(0), F.size("template") - d))))
            .otherwise(F.col("template")).alias("template")), "url-templates")
    total = stage_table(t.groupBy("host").agg(F.sum("n_known").alias("host_known"), F.sum("n_bad").alias("host_bad")), "url-hosts")
    every = total.agg(F.sum("host_known").alias("every_known"), F.sum("host_bad").alias("every_bad"))
    groups = stage_table(t.groupBy("host", "template").agg(F.sum("n_known").alias("n_known"), F.sum("n_bad").alias("n_bad")), "url-groups")
    prior = F.coalesce(F.try_divide("every_bad", "every_known"), F.lit(0.0))
    of_host = (F.col("host_bad") + PRIOR * prior) / (F.col("host_known") + PRIOR)
    share = (F.col("n_bad") + PRIOR * of_host) / (F.col("n_known") + PRIOR)
    # `every` is a single row of two sums
    judged = stage_table(groups.join(total, "host").join(F.broadcast(every)).select(
        "host", "template", share.alias("bad_share"), ((share >= REJECT) & (F.col("n_bad") >= MIN_BAD)).alias("rejected")), "url-judged")
    return stage_table(t.select("host", "form", "template").join(judged, ["host", "template"])
                       .select("host", "form", "template", "bad_share", "rejected"), "url-verdicts")


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url",
          labels: DataFrame | None = None) -> DataFrame:
    """``id_col, host, path, rule, verdict, template, bad_share`` for every row.

    The verdict is the rule's where one fits, else ``block`` for a rejected template and ``allow`` otherwise.
    Bad pages are those that a rule blocks, and those that ``labels`` (``id_col, bad`` boolean, one row an
    id) marks; good ones are the others that a rule allows or that are labelled false; all others have no label. A null URL or one without ``://`` has empty host and path, and is judged as such.
    Repeated rows are judged alike and count as often; other columns are ignored; an empty table gives an empty result.
    """
    url = F.col("url")
    p = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).select("id", host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = by_rules(F.col("host"), F.col("path"), rules)
    p = p.select("id", "host", "path", rule.alias("rule"), verdict.alias("given"), by_form(F.col("path")).alias("form"))
    bad, known = F.coalesce(F.col("given") == "block", F.lit(False)), F.col("given").isNotNull()
    if labels is not None:
        p = p.join(labels.select(F.col(id_col).alias("id"), F.col("bad").alias("labelled")), "id", "left")
        bad, known = bad | F.coalesce("labelled", F.lit(False)), known | F.col("labelled").isNotNull()
    p = stage_table(p.withColumn("bad", F.when(known, bad)), "url-pages")
    found = template_verdicts(p.select("host", "form", "bad"))
    return p.join(found, ["host", "form"]).select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("given", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "bad_share")
