"""URL filters by hash-prefix join.

A rule is a host and a path. It fits its host and all subdomains if the path of the URL starts with
the rule's. Each URL is expanded into expressions: host suffixes with as many labels as some rule
has, each with the path prefixes as long as some rule's path. Expressions meet rules in an equi-join
on the first 32 bits of their SHA-256; then the full digests are compared, and the longest rule
wins (then the greater text, then block).

Only distinct pairs of host and path are expanded, and expressions are combined before the shuffle,
so a host that a third of all URLs share is joined once. The lists of label counts and path lengths
are bounded: a host has at most 127 labels (longer lists are cut to those some rule has), and paths
of rules are as short as the rule table's longest.

Defined results: a null URL or one without `://` has an empty host and path and fits no rule;
without a fitting rule, rule is null and the verdict is `default`; no rules at all give `default`
everywhere; rules repeated in the table count once; repeated rows each give a row; an empty table
gives an empty result. Extra columns of pages are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ALLOW, BLOCK = "allow", "block"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(expression: Column) -> Column:
    return F.unhex(F.sha2(expression, 256))


def short(full: Column) -> Column:
    """The first 32 bits of a digest, in hex."""
    return F.hex(F.substring(full, 1, 4))


def expressions(urls: DataFrame, label_counts: list[int], path_lengths: list[int]) -> DataFrame:
    """host, path, suffix, prefix: every expression of a URL that some rule could have."""
    labels = F.split("host", r"\.", -1)
    counts = F.filter(F.array(*map(F.lit, label_counts)), lambda k: k <= F.size("labels"))
    lengths = F.filter(F.array(*map(F.lit, path_lengths)), lambda k: k <= F.length("path"))
    return (urls.withColumn("labels", labels)
            .withColumn("k", F.explode(counts)).withColumn("m", F.explode(lengths))
            .select("host", "path",
                    F.array_join(F.slice("labels", F.size("labels") - F.col("k") + 1, F.col("k")),
                                 ".").alias("suffix"),
                    F.substring("path", F.lit(1), F.col("m")).alias("prefix")))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = ALLOW) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict. Rules: host, path, verdict."""
    known = (rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict")
             .dropna().distinct()
             .withColumn("rule", F.concat("host", "path"))
             .withColumn("full", digest(F.concat_ws("\n", "host", "path"))))
    shapes = known.agg(
        F.collect_set(F.size(F.split("host", r"\.", -1))).alias("labels"),
        F.collect_set(F.length("path")).alias("lengths")).first()
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    if not shapes["labels"]:
        return rows.select("*", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    asked = (expressions(rows.select("host", "path").distinct(), sorted(shapes["labels"]),
                         sorted(shapes["lengths"]))
             .withColumn("full", digest(F.concat_ws("\n", "suffix", "prefix")))
             .withColumn("short", short(F.col("full"))))
    # expressions are joined once each; what matches goes back to its URLs
    distinct = asked.select("short", "full").distinct()
    sought = known.select(short(F.col("full")).alias("short"), F.col("full").alias("rule_full"),
                          "rule", "verdict")
    hits = (distinct.join(sought, "short").filter("full = rule_full")
            .select("full", "rule", "verdict"))
    best = F.max(F.struct(F.length("rule").alias("n"), F.col("rule"), F.col("verdict")))
    verdicts = (asked.select("host", "path", "full").join(hits, "full")
                .groupBy("host", "path").agg(best.alias("best")))
    return (rows.join(verdicts, ["host", "path"], "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
