"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Every paragraph is hashed to a wide vector; a document's fingerprint is the sum of its paragraphs'
vectors, each lane modulo 2**32. Sums commute, so equal multisets of paragraphs have equal
fingerprints in any order, and a paragraph is inserted or deleted by adding or subtracting its
vector. Eight lanes hold 256 hash bits for equality; 64 more (two to a word, each a count of one
hash bit) make a tug-of-war sketch that estimates the share of common paragraphs.
Column functions only.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._store import partitions, table

#: A paragraph ends at a line break or at the end of a sentence before a space.
PARAGRAPH = r"\n|(?<=[.!?]) "
SEEDS, WORDS = 4, 32
LOW32, PAIR = 0xFFFFFFFF, 0x0000000100000001


def paragraphs(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), PARAGRAPH)


def lane_sums(paragraph: Column, sign: Column | None = None) -> dict[str, Column]:
    """Aggregates that add up the vectors; ``sign`` of -1 deletes. No sum can overflow below 2**31 paragraphs."""
    one = (lambda c: c) if sign is None else (lambda c: c * sign)
    out = {}
    for s in range(SEEDS):
        h = F.xxhash64(paragraph, F.lit(s))
        out[f"e{2 * s}"] = F.sum(one(h.bitwiseAND(F.lit(LOW32))))
        out[f"e{2 * s + 1}"] = F.sum(one(F.shiftrightunsigned(h, 32)))
    for k in range(WORDS):
        out[f"b{k}"] = F.sum(one(F.shiftrightunsigned(F.xxhash64(paragraph, F.lit(0)), k).bitwiseAND(F.lit(PAIR))))
    return out


def pack(n: Column) -> tuple[Column, Column]:
    """(exact lanes modulo 2**32, signed sketch lanes) of the sums; ``n`` paragraphs."""
    exact = F.array(*[F.pmod(F.col(f"e{i}"), F.lit(LOW32 + 1)) for i in range(2 * SEEDS)])
    halves = [F.col(f"b{k}").bitwiseAND(F.lit(LOW32)) for k in range(WORDS)] + [F.shiftrightunsigned(F.col(f"b{k}"), 32) for k in range(WORDS)]
    return exact, F.array(*[(2 * x - n).cast("int") for x in halves])


def hex_lanes(exact: Column) -> Column:
    return F.array_join(F.transform(exact, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(x: str, y: str) -> Column:
    """Estimated cosine of two paragraph multisets, 0 to 1; 1 for equal fingerprints, 0 if one is missing. x, y: column prefixes."""
    dot = lambda a, b: reduce(lambda p, q: p + q, [F.get(a, F.lit(i)).cast("double") * F.get(b, F.lit(i)) for i in range(2 * WORDS)])
    a, b = F.col(f"{x}_sketch"), F.col(f"{y}_sketch")
    norm = F.sqrt(dot(a, a) * dot(b, b))
    cosine = F.when(norm > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(a, b) / norm))).otherwise(0.0)
    return F.when(F.col(f"{x}_exact") == F.col(f"{y}_exact"), 1.0).otherwise(F.coalesce(cosine, F.lit(0.0)))


def fingerprint(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row per ``keys``: n_paragraphs, exact array<bigint>, sketch array<int>, fingerprint hex.

    Rows that share ``keys`` add up to one multiset, which is how a document is fingerprinted from
    parts. Null text counts as empty: one empty paragraph. An empty table gives no rows.
    """
    out = docs.select(*keys, F.explode(paragraphs(F.col(text))).alias("_p")).groupBy(*keys)
    out = out.agg(F.count(F.lit(1)).alias("n_paragraphs"), *[c.alias(k) for k, c in lane_sums(F.col("_p")).items()])
    exact, sketch = pack(F.col("n_paragraphs"))
    return out.select(*keys, "n_paragraphs", exact.alias("exact"), sketch.alias("sketch")).withColumn("fingerprint", hex_lanes(F.col("exact")))


def combine(x: Column, y: Column, sign: int = 1) -> Column:
    """Exact lanes after inserting (sign 1) or deleting (-1) the paragraphs behind ``y``."""
    return F.zip_with(x, y, lambda a, b: F.pmod(a + sign * b, F.lit(LOW32 + 1)))


def _bucket(value: Column, bounds: list[int]) -> Column:
    """How many bounds are below ``value``; bounds sorted. Two short scans find it: first a block, then within it.

    The bounds go into the plan as one constant, so there can be hundreds of thousands of them.
    """
    step = max(1, int(len(bounds) ** 0.5))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    tops, inner = F.from_json(F.lit(json.dumps([b[-1] for b in blocks])), "array<bigint>"), F.from_json(F.lit(json.dumps(blocks)), "array<array<bigint>>")
    k = F.size(F.filter(tops, lambda b: b < value))
    return (k * step + F.size(F.filter(F.coalesce(F.get(inner, k), F.array().cast("array<bigint>")), lambda b: b < value))).cast("int")


def edited_pairs(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows ``bucket, rn, real, doc_id, text, edited`` with the text after half of it is replaced.

    The last floor(n/2) code points give way to as many of the next document, in descending doc_id
    (equal ids: ascending text; after the last comes the first). Ids are cut into buckets at
    quantiles, and each bucket gets a copy of the row that follows its last, so the text is shuffled
    once and no task holds a global order. Rows without a doc_id come last.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("_k", F.coalesce("doc_id", F.lit(-(2**63)).cast("bigint")))
    shares = [i / buckets for i in range(1, buckets)] + [1.0]
    found = docs.agg(F.percentile_approx("_k", shares, 100 * buckets).alias("q"), F.max("_k").alias("top")).first()
    bounds = sorted({*(found.q or []), found.top if found.top is not None else 0})
    # A copy of each bound's first row ends the bucket above; that of the largest ends the bucket of the smallest ids.
    # Among rows with the same id the first is the one with the least text.
    heads = docs.where(F.col("_k").isin(bounds)).groupBy("_k").agg(F.min("text").alias("text"))
    heads = heads.select("_k", "text", F.when(F.col("_k") == bounds[-1], 0).otherwise(_bucket(F.col("_k"), bounds) + 1).alias("bucket"), F.lit(None).cast("bigint").alias("doc_id"), F.lit(False).alias("real"))
    rows = docs.select("_k", "text", _bucket(F.col("_k"), bounds).alias("bucket"), "doc_id", F.lit(True).alias("real")).unionByName(heads)
    order = Window.partitionBy("bucket").orderBy(F.col("real").desc(), F.col("_k").desc(), "text")
    half = F.floor(F.length("text") / 2).cast("int")
    return (
        rows.withColumns({"rn": F.row_number().over(order), "_next": F.lead("text").over(order)})
        .withColumn("edited", F.concat(F.expr("left(text, length(text) - int(floor(length(text) / 2)))"), F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half)))
        .select("bucket", "rn", "real", "doc_id", "text", "edited")
    )


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` and its edited text. See ``edited_pairs``, ``fingerprint`` and ``likeness``."""
    rows = edited_pairs(table(spark, sf_dir, "documents").select("doc_id", "text"), buckets=max(64, 4 * partitions(spark)))
    rows = rows.withColumns({"n_chars": F.length("text").cast("bigint"), "edited_sha256": F.when(F.col("real"), F.sha2("edited", 256))})
    kinds = rows.select(
        "bucket", "rn", "real", "doc_id", "n_chars", "edited_sha256",
        F.posexplode(F.when(F.col("real"), F.array("text", "edited")).otherwise(F.array("text"))).alias("kind", "text"),
    )
    prints = fingerprint(kinds, ["bucket", "rn", "kind", "real", "doc_id", "n_chars", "edited_sha256"])
    order = Window.partitionBy("bucket").orderBy("rn", "kind")
    here = prints.withColumns({
        "own_exact": F.col("exact"), "own_sketch": F.col("sketch"),
        "edit_exact": F.lead("exact", 1).over(order), "edit_sketch": F.lead("sketch", 1).over(order),
        "next_exact": F.lead("exact", 2).over(order), "next_sketch": F.lead("sketch", 2).over(order),
    }).where("kind = 0 and real")
    return here.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", hex_lanes(F.col("edit_exact")).alias("edited_fingerprint"),
        likeness("own", "edit").alias("near_edited"), likeness("own", "next").alias("near_next"), "n_paragraphs",
    )
