"""Mixing sources to target weights by capped water-filling. DataFrame functions only.

Each source gets a share of the budget in proportion to its weight, but no more than ``most`` times its own
size; what a full source can't take is dealt out again by weight among the others until none is above its
limit. A source's documents are then repeated whole as often as all of them fit, and of the fraction that is
left the documents first in a seeded order are taken once more, up to the one that comes nearest to the target.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._order import numbered
from ._store import Store, table

WORD = r"[^\x20\x09-\x0D]+"
#: Documents in a bucket of the seeded order, about; at most 16^4 buckets for each source.
BUCKET_ROWS = 256


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0))


def fill(sources: DataFrame, budget: float) -> DataFrame:
    """``sources`` (weight, cap, ...) with the column target; the targets' sum is ``budget`` if all caps together allow it.

    A round is one aggregate of two numbers over the sources, however many there are. A source that is
    above its cap stays so in later rounds, as what it can't take only raises the shares of the others.
    """
    used, weights = 0, sources.agg(F.sum("weight")).first()[0]
    while weights:
        share = F.lit(budget - used) * F.col("weight") / F.lit(weights)
        full = share > F.col("cap")
        now = sources.agg(F.sum(F.when(full, F.col("cap")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        if tuple(now) == (used, weights):
            return sources.withColumn("target", F.when(full, F.col("cap").cast("double")).otherwise(share))
        used, weights = now
    return sources.withColumn("target", F.col("cap").cast("double"))


def mix_sources(docs: DataFrame, store: Store, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 0) -> DataFrame:
    """doc_id, source, size, source_size, target, repeats, taken for each row of ``docs``.

    ``weights`` go to the sources by code point (null last), repeating; the budget is ``share`` of all words.
    ``repeats`` is how often the document is in the mix (0 to ``most``), ``taken`` its words in it.
    Null texts have no words; a null doc_id or source is a value of its own. Repeated rows count each for
    itself. The seeded order is by a digest of doc_id and text, so reruns agree whatever the partitions.
    """
    key = F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source"))  # nulls last
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")))).cast("binary"))
    sized = store.save(docs.select("doc_id", key.alias("key"), n_words(F.col("text")).alias("size"), F.substring(digest, 1, 16).alias("h")), "sized")
    sums = sized.groupBy("key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sources = numbered(sums.withColumn("all", F.lit(0)), "all", ["key"], store, "sources")
    cycle = F.array(*map(F.lit, weights))
    sources = sources.withColumns({"weight": F.get(cycle, (F.col("pos") % len(weights)).cast("int")), "cap": most * F.col("source_size")})
    total, rows = sources.agg(F.sum("source_size"), F.sum("rows")).first()
    filled = fill(sources, share * (total or 0))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    facts = filled.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    # The order within a source is cut into buckets by its first digits, so no task sorts a whole source.
    digits = min(4, max(1, math.ceil(math.log(max(rows or 1, 1) / BUCKET_ROWS, 16))))
    sized = sized.withColumn("bucket", F.substring("h", 1, digits))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = sized.groupBy("key", "bucket").agg(F.sum("size").alias("words")).withColumn("ahead", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    buckets = buckets.join(facts.select("key", "source_size", "target", "whole", "rest"), "key").drop("words")
    within = Window.partitionBy("key", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.join(buckets, ["key", "bucket"]).withColumn("before", F.col("ahead") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    again = ((F.col("size") > 0) & (2 * F.col("before") + F.col("size") <= 2 * F.col("rest"))).cast("bigint")
    placed = placed.withColumn("repeats", F.col("whole") + again)
    source = F.when(F.col("key") != "1", F.substring("key", 2, 2**31 - 1))
    return placed.select("doc_id", source.alias("source"), "size", "source_size", "target", "repeats", (F.col("repeats") * F.col("size")).alias("taken"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each of ``documents`` in a mix of 150 % of all words, weights 3, 1, 2 by source, at most 2 epochs; see mix_sources."""
    return mix_sources(table(spark, sf_dir, "documents"), Store(spark)).select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    substr(md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 16) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS cap FROM s),
c AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS used,
    sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS rest,
    1.5::DOUBLE * sum(source_size) OVER ()::BIGINT AS budget FROM w),
f AS (SELECT *, (budget - used) * weight / rest > cap AS full_up FROM c),
l AS (SELECT coalesce(sum(cap) FILTER (full_up), 0)::BIGINT AS used, coalesce(sum(weight) FILTER (NOT full_up), 0)::BIGINT AS rest FROM f),
t AS (SELECT f.source, source_size, CASE WHEN full_up THEN cap::DOUBLE ELSE (budget - l.used) * weight / l.rest END AS target FROM f, l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
p AS (SELECT d.*, source_size, target, whole, target - whole * source_size AS left_over,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
    FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
r AS (SELECT *, whole + CASE WHEN size > 0 AND 2 * ahead + size <= 2 * left_over THEN 1 ELSE 0 END AS repeats FROM p)
SELECT doc_id, size, source_size, target, (repeats * size)::BIGINT AS taken, source, repeats::BIGINT AS repeats FROM r
"""
