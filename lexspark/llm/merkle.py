"""Merkle manifest of a dataset: a digest for every row, a ternary tree for every source, a tree over the sources, proofs.

Leaves are cut into superblocks of 3^6 consecutive leaves of one source, whose tops are the leaves of the
next round, so a tree of any size is a few rounds of bounded groups. Proofs go down the same rounds: at each,
a superblock's nodes and the outer nodes on the way from its top to the root are cogrouped, and one call
finishes the local reduction, joins the proofs and folds them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._order import numbered
from ._store import Store, table

FANOUT = 3
#: Levels of the tree in a superblock.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_OUTER = "key string, block bigint, at array<int>, siblings array<string>, subroot string, root string"
_LEAF = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _h(x: str) -> str:
    return sha256(x.encode()).hexdigest()


def leaf_digest(text: Column) -> Column:
    """sha256 of FIELDS, each as byte count, colon and value, or ``-`` if null; ``text`` stands in for the column text."""
    parts = []
    for name in FIELDS:
        value = (text if name == "text" else F.col(name)).cast("string")
        parts.append(F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def _tops(nodes: DataFrame, levels: int) -> DataFrame:
    """The top of each superblock, as a node of the next round: key, n, pos, digest.

    In a tree of one superblock the reduction stops at one node; otherwise every superblock goes all levels,
    the last one too, so that its top is level with the others.
    """
    size = FANOUT**levels

    def step(a: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / FANOUT).cast("int"))
        return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(a, i * FANOUT + 1, FANOUT), ""), 256))

    blocks = nodes.groupBy("key", F.floor(F.col("pos") / size).alias("pos")).agg(F.first("n").alias("rows"), F.sort_array(F.collect_list(F.struct("pos", "digest")))["digest"].alias("a"))
    top = F.aggregate(F.sequence(F.lit(1), F.lit(levels)), "a", lambda a, _: F.when((F.col("rows") > size) | (F.size(a) > 1), step(a)).otherwise(a))
    return blocks.select("key", F.ceil(F.col("rows") / size).alias("n"), "pos", F.element_at(top, 1).alias("digest"))


def _rounds(nodes: DataFrame, store: Store, levels: int) -> list[DataFrame]:
    """``nodes`` and the tops of each round, up to the one with a single node for each key."""
    out = [nodes]
    while len(out) == 1 or (out[-1].agg(F.max("n")).first()[0] or 1) > 1:
        out.append(store.save(_tops(out[-1], levels), "tops"))
    return out


def _ways(digests: list[str], single: bool, levels: int) -> list[list[tuple[int, str]]]:
    """For each node of a superblock, from the bottom up: its place in its run and the others of the run, as one string."""
    ways: list[list[tuple[int, str]]] = [[] for _ in digests]
    row, width = digests, 1
    for _ in range(levels):
        if single and len(row) == 1:
            break
        runs = [row[i : i + FANOUT] for i in range(0, len(row), FANOUT)]
        for i, way in enumerate(ways):
            run, at = divmod(i // width, FANOUT)
            way.append((at, "".join(runs[run][:at] + runs[run][at + 1 :])))
        row, width = [_h("".join(r)) for r in runs], width * FANOUT
    return ways


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / FANOUT**levels))


def _cogrouped(nodes: DataFrame, outer: DataFrame, levels: int, each, schema: str) -> DataFrame:
    """``each(node row, steps, subroot, root)`` for every node; steps: (place in the run, the run's others), up to the root."""
    size = FANOUT**levels

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left, up = left.sort_values("pos"), next(right.itertuples())
        beyond = list(zip(up.at, up.siblings, strict=True))
        ways = _ways(left["digest"].tolist(), bool(left["n"].iloc[0] <= size), levels)
        rows = (each(row, [*way, *beyond], up.subroot, up.root) for row, way in zip(left.itertuples(index=False), ways, strict=True))
        return pd.DataFrame(rows, columns=[c.strip().split(" ")[0] for c in schema.split(", ")])

    return _blocks(nodes, levels).groupBy("key", "block").cogroup(outer.groupBy("key", "block")).applyInPandas(run, schema)


def _down(rounds: list[DataFrame], outer: DataFrame, levels: int) -> DataFrame:
    """The outer nodes of every superblock of the first round, from those of the last round's tops."""

    def each(row, steps, subroot, root):
        return row.key, row.pos, [at for at, _ in steps], [x for _, x in steps], subroot, root

    for nodes in reversed(rounds[1:-1]):
        outer = _cogrouped(nodes, outer, levels, each, _OUTER)
    return outer


def fold(leaf: str, steps: Iterator[tuple[int, str]]) -> str:
    """The root that a leaf and the others of each run on its way lead to."""
    for at, others in steps:
        leaf = _h(others[: 64 * at] + leaf + others[64 * at :])
    return leaf


def manifest(docs: DataFrame, seen: Column, store: Store, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each row of ``docs`` (FIELDS).

    ``seen`` is the text as it is found when the manifest is checked: folded_root is recomputed from it and
    the manifest's proof, verified tells whether that is the root. Nulls are values of their own, first in
    every order; rows with one doc_id are ordered by their digests; an empty table has no rows and no root.
    """
    key = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("+"), "source"))  # null first, then bytewise
    leaves = docs.select(key.alias("key"), "doc_id", leaf_digest(F.col("text")).alias("digest"), leaf_digest(seen).alias("found"))
    leaves = numbered(leaves, "key", ["doc_id", "digest"], store, "leaves").withColumn("doc_id", F.col("doc_id").cast("string"))
    trees = _rounds(leaves, store, levels)

    # The tree over the sources is built and proved by the same rounds; its leaves are the subroots.
    tops = trees[-1].select(F.lit("").alias("key"), F.col("key").alias("source_key"), "digest")
    tops = numbered(tops, "key", ["source_key"], store, "subroots")
    over = _rounds(tops, store, levels)
    start = over[-1].select("key", F.lit(0).cast("bigint").alias("block"), F.array().cast("array<int>").alias("at"), F.array().cast("array<string>").alias("siblings"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))

    def each(row, steps, _, root):
        return row.source_key, 0, [at for at, _ in steps], [x for _, x in steps], row.digest, root

    outer = store.save(_cogrouped(tops, _down(over, start, levels), levels, each, _OUTER), "outer")

    def prove(row, steps, subroot, root):
        found = fold(row.found, steps)
        return row.doc_id, row.digest, subroot, root, _h("".join(x for _, x in steps)), found, found == root

    out = _cogrouped(leaves, _down(trees, outer, levels), levels, prove, _LEAF)
    return out.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def tampered(docs: DataFrame) -> Column:
    """The text without its line breaks where 2 divides the crc32 of doc_id; a null doc_id leaves it as it is."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of ``documents`` with a proof for every row, checked against texts of which some have lost their line breaks."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    return manifest(docs, tampered(docs), Store(spark))


def _crc32(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a string of ASCII characters."""
    shift = "list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), lambda x, b: {shift}), 4294967295)"


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}) || ':' || {value} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(text if name == "text" else f"{name}::VARCHAR") for name in FIELDS) + ")"


def _tree(name: str, leaves: str) -> str:
    """DuckDB SQL for all levels of the trees over ``leaves``: key, lvl, pos, digest, n (nodes of the level)."""
    return f"""{name} AS (
    SELECT key, 0 AS lvl, pos, digest, n FROM {leaves}
    UNION ALL
    SELECT key, lvl + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM {name} WHERE n > 1 GROUP BY key, lvl, pos // 3, n)"""


ORACLE = f"""
WITH RECURSIVE d AS (SELECT *, coalesce({_crc32("doc_id::VARCHAR")} % 2 = 0, false) AS hit FROM documents),
l AS (SELECT doc_id, coalesce('+' || source, '') AS key, {_leaf("text")} AS digest, {_leaf("CASE WHEN hit THEN replace(text, chr(10), '') ELSE text END")} AS found FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, count(*) OVER (PARTITION BY key) AS n FROM l),
{_tree("t", "p")},
s AS (SELECT key AS source_key, digest, '' AS key, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
{_tree("u", "s")},
r AS (SELECT *, coalesce(string_agg(digest, '') OVER (PARTITION BY top, key, lvl, pos // 3 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS ahead,
    coalesce(string_agg(digest, '') OVER (PARTITION BY top, key, lvl, pos // 3 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS behind
    FROM (SELECT *, false AS top FROM t UNION ALL SELECT *, true FROM u)),
w AS (
    SELECT p.doc_id, p.key, p.pos AS at, p.digest AS leaf, p.found AS folded, p.pos, 0 AS lvl, '' AS proof, false AS top, false AS done FROM p
    UNION ALL
    SELECT w.doc_id, w.key, w.at, w.leaf, CASE WHEN r.n = 1 THEN w.folded ELSE sha256(r.ahead || w.folded || r.behind) END,
        CASE WHEN r.n > 1 THEN w.pos // 3 ELSE coalesce(s.pos, 0) END, CASE WHEN r.n > 1 THEN w.lvl + 1 ELSE 0 END, CASE WHEN r.n = 1 THEN w.proof ELSE w.proof || r.ahead || r.behind END, w.top OR r.n = 1, w.top AND r.n = 1
    FROM w JOIN r ON r.top = w.top AND r.key = CASE WHEN w.top THEN '' ELSE w.key END AND r.lvl = w.lvl AND r.pos = w.pos LEFT JOIN s ON s.source_key = w.key
    WHERE NOT w.done),
root AS (SELECT digest AS root FROM u WHERE n = 1)
SELECT w.doc_id, w.leaf, s.digest AS subroot, root.root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root, w.folded = root.root AS verified
FROM w JOIN s ON s.source_key = w.key, root WHERE w.done
"""
