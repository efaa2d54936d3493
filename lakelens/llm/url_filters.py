"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes, confirmed by full digests.

A rule is a host, a path and a verdict. It fits an url when the url's host is the rule's host or a subdomain of it
and the url's path starts with the rule's path. Of the fitting rules the longest (host and path together) wins,
then the one with the longer host, then `block`.

Each url is expanded into host suffixes times path prefixes that end at a slash, no deeper than any rule goes. A rule
is filed under its host and its path up to the last slash. Both sides meet in an equi-join on the first eight hex
digits of SHA-256; the full digest and the rest of the rule's path are compared afterwards. Only distinct (host, path)
pairs are expanded, so an url that makes up a third of all rows is judged once.

Defined results: a null url, or one without `://`, has an empty host and path and gets the default verdict. Rules with
a null host, path or verdict are left out, and a rule's host ignores A-Z case. Repeated rules count once. No rules, or
no rows, give rows without a rule, or no rows. Columns other than the url and those kept are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.llm.columns import ascii_lower

PREFIX_DIGITS = 8


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """A small literal table of (host, path, verdict)."""
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("host", "path", "verdict"), rule)]) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def _suffixes(host: Column, most: int) -> Column:
    """The last one, two, … labels of a host, up to `most`."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), F.least(n, F.lit(most))), lambda j: F.array_join(F.slice(labels, n - j + 1, j), "."))


def _prefixes(path: Column, most: int) -> Column:
    """The empty prefix and those that end at the first, second, … slash, up to `most`."""
    pieces = F.split(path, "/", most + 1)
    upto = F.least(F.size(pieces) - 1, F.lit(most))
    ended = F.transform(F.sequence(F.lit(0), upto), lambda k: F.array_join(F.slice(pieces, 1, k), "/"))
    return F.transform(ended, lambda p, k: F.when(k == 0, F.lit("")).otherwise(F.concat(p, F.lit("/"))))


def judge_urls(
    pages: DataFrame, rules: DataFrame, keep: Iterable[str] = ("page_id",), url: str = "url", default: str = "allow"
) -> DataFrame:
    """One row per row of `pages`: the kept columns, host, path, the winning rule (or null) and the verdict."""
    filed = (
        rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
        .distinct()
        .withColumn("r_key", F.concat("r_host", F.regexp_extract("r_path", r"^(?s:.*)/", 0)))
        .withColumn("r_digest", F.sha2("r_key", 256))
        .withColumn("r_short", F.col("r_digest").substr(1, PREFIX_DIGITS))
    )
    deep = filed.agg(
        F.max(F.size(F.split("r_host", r"\.", -1))).alias("labels"), F.max(F.size(F.split("r_path", "/", -1)) - 1).alias("slashes")
    ).first()
    parted = pages.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    expressions = F.flatten(
        F.transform(
            _suffixes(F.col("host"), deep["labels"] or 1),
            lambda s: F.transform(_prefixes(F.col("path"), deep["slashes"] or 0), lambda p: F.concat(s, p)),
        )
    )
    looked_up = (
        parted.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(expressions).alias("expression"))
        .select("host", "path", F.sha2("expression", 256).alias("digest"))
        .withColumn("short", F.col("digest").substr(1, PREFIX_DIGITS))
    )
    fits = (F.col("digest") == F.col("r_digest")) & F.startswith(F.col("path"), F.col("r_path"))
    order = F.struct(
        F.length(F.concat("r_host", "r_path")).alias("n"),
        F.length("r_host").alias("h"),
        (F.col("r_verdict") == "block").alias("b"),
        F.concat("r_host", "r_path").alias("rule"),
        F.col("r_verdict").alias("verdict"),
    )
    best = (
        looked_up.join(filed, F.col("short") == F.col("r_short"))
        .where(fits)
        .groupBy(F.col("host").alias("b_host"), F.col("path").alias("b_path"))
        .agg(F.max(order).alias("best"))
    )
    joined = parted.join(best, (F.col("host") == F.col("b_host")) & (F.col("path") == F.col("b_path")), "left")
    return joined.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)],
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
