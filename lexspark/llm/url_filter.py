"""URL filters: rules on a host (with its subdomains) and a path prefix.

Each URL is expanded into the host-suffix and path-prefix expressions that the rules can hold;
these meet the rules in an equi-join on a 32-bit hash prefix, and a hit counts once the full
SHA-256 digests agree. Of the rules that fit, the longest decides. Column functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: (verdict, host, path) of the registered query.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def url_host(url: Column) -> Column:
    """Lower-cased host after the first ``://``; empty for null or no ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def hash_prefix(expression: Column) -> Column:
    return F.shiftright(F.xxhash64(expression), 32).cast("int")


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``.

    A rule fits its host and every subdomain if the path starts with the rule's path. The longest
    host+path wins; at a tie ``block`` wins, then the smaller string. Where no rule fits, ``rule`` is
    null and the verdict is ``default``. Null URLs and URLs without ``://`` have an empty host and
    path and fit no rule with a host. Repeated rows and ids are judged row by row. Columns of
    ``pages`` named like the results are replaced. An empty rule table gives ``default`` everywhere.

    Work per row: one expression for each (number of labels, path length) pair that the rules have.
    Distinct URLs are expanded, so a hot URL costs one row; Catalyst broadcasts the rules only below
    spark.sql.autoBroadcastJoinThreshold and shuffles them by hash prefix above it.
    """
    rules = (
        rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.col("path"), F.col("verdict"))
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # "block" > "allow"
        .withColumn("rule", F.concat("host", "path"))
        .select(
            "verdict", "rule", hash_prefix(F.concat_ws("\x00", "host", "path")).alias("prefix"),
            F.sha2(F.concat_ws("\x00", "host", "path"), 256).alias("digest"),
            F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars"),
        )
    )
    # The shapes that rules have: at most (labels in a name) x (path lengths) pairs, however many the rules.
    shapes = [(r.labels, r.chars) for r in rules.select("labels", "chars").distinct().orderBy("labels", "chars").collect()]
    base = pages.drop("host", "path", "rule", "verdict").withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    if not shapes:
        return base.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    labels = F.split("host", r"\.")
    expressions = F.array(*[
        F.when(
            (F.size(labels) >= n) & (F.length("path") >= c),
            F.concat_ws("\x00", F.array_join(F.slice(labels, -n, n) if n else labels, "."), F.substring("path", 1, c)),
        )
        for n, c in shapes
    ])
    hits = (
        base.where(F.col(url).isNotNull()).select(url, "host", "path").distinct()
        .where(F.instr(url, "://") > 0)
        .select(F.col(url).alias("_url"), F.explode(F.array_compact(expressions)).alias("_x"))
        .withColumn("prefix", hash_prefix(F.col("_x")))
        .join(rules, "prefix")
        .where(F.sha2("_x", 256) == F.col("digest"))
        .groupBy("_url")
        .agg(F.max(F.struct(F.length("rule").alias("l"), "verdict", "rule")).alias("best"))
        .select("_url", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    )
    return base.join(hits, F.col(url) == F.col("_url"), "left").drop("_url").withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every url of ``pages``, allow where no rule fits. See ``filter_urls``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, rules_frame(spark)).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH p AS (SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
r(verdict, rh, rp) AS (VALUES ('block','net','/'), ('allow','example.net','/en/'), ('block','example.com','/de/'), ('allow','org','/fr/')),
f AS (SELECT p.*, rh || rp AS rule, r.verdict AS v FROM p LEFT JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, any_value(host) AS host, any_value(path) AS path, arg_max(rule, length(rule)) AS rule,
    coalesce(arg_max(v, length(rule)), 'allow') AS verdict FROM f GROUP BY page_id
"""
