"""An inner join whose keys may be as uneven as they like: what a hot key's rows make is dealt out over many tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import saved

#: Cells, for each shuffle partition, that an even deal would have.
CELLS = 4


def hot_keys(left: DataFrame, right: DataFrame, keys: list[str], partitions: int) -> DataFrame:
    """``keys``, a, b: into how many parts the left and the right rows of a key are cut, for keys that make more than an even share.

    A key is hot if its pairs, its left or its right rows are more than one part in CELLS * partitions of all; so there are
    at most three times as many hot keys as cells, whatever the data. A hot key's a * b cells have about a share of pairs each.
    """
    side = lambda d, n: d.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    counts = saved(side(left, "l").join(side(right, "r"), keys), "hot").withColumn("pairs", F.col("l") * F.col("r"))
    totals = counts.agg(*[F.coalesce(F.sum(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in ("l", "r", "pairs")]).first()
    share = {c: max(totals[c] / (CELLS * partitions), 1.0) for c in ("l", "r", "pairs")}
    side_of = share["pairs"] ** 0.5
    narrow = lambda c: F.col(c) <= side_of
    whole = F.ceil(F.col("pairs") / share["pairs"])
    a = F.when(narrow("l"), F.lit(1)).when(narrow("r"), whole).otherwise(F.ceil(F.col("l") / side_of))
    b = F.when(narrow("r"), F.lit(1)).when(narrow("l"), whole).otherwise(F.ceil(F.col("r") / side_of))
    hot = counts.where(" or ".join(f"{c} > {share[c]!r}D" for c in share))
    return hot.select(*keys, a.cast("int").alias("_a"), b.cast("int").alias("_b"))


def split_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``left.join(right, keys)`` for equal keys that are not null, each pair once, in cells of bounded size.

    Both sides are saved first, as they are counted and joined. A left row of a hot key goes to one of the key's a parts and meets each of
    its b parts; a right row the other way round. Rows of other keys stay as they are, so without hot keys this is a plain join.
    """
    left, right = saved(left.dropna(subset=keys), "left"), saved(right.dropna(subset=keys), "right")
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left, right, keys, partitions))  # at most 3 * CELLS * partitions rows

    def cells(d: DataFrame, own: str, other: str, part: str, meets: str) -> DataFrame:
        rows = [c for c in d.columns]
        out = d.join(hot, keys, "left")
        at: Column = F.when(F.col(own).isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*rows), F.col(own)).cast("int"))
        every = F.when(F.col(other).isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col(other) - 1))
        return out.select(*rows, at.alias(part), F.explode(every).alias(meets))

    a, b = cells(left, "_a", "_b", "_i", "_j"), cells(right, "_b", "_a", "_j", "_i")
    return a.join(b, [*keys, "_i", "_j"]).drop("_i", "_j")
