"""Places of rows in an order within groups, without one task that holds a group. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._store import Store, partitions


def numbered(rows: DataFrame, group: str, order: list[str], store: Store, name: str) -> DataFrame:
    """``rows`` with pos (0, 1, ... within ``group`` by ``order``) and n (rows of the group), saved.

    Rows are dealt by ranges of (group, order), so a group that holds most rows is many ranges; each range is
    sorted and saved with the places in it, and a group's part of a range starts after its parts in the
    ranges before. Only as many rows as ranges meet in one task. Rows that agree in ``order`` get places in
    any order among themselves; the last sort key lets even those be split.
    """
    keys = [group, *order]
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(partitions(store.spark), *keys, "_tie").sortWithinPartitions(*keys).drop("_tie")
    dealt = store.save(dealt.withColumn("_id", F.monotonically_increasing_id()), f"{name}-dealt")  # range in the upper bits, place in the lower 33
    dealt = dealt.withColumns({"_part": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_id")
    parts = dealt.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumns({"_before": F.coalesce(before, F.lit(0)), "n": F.sum("_rows").over(Window.partitionBy(group))})
    placed = dealt.join(parts.select(group, "_part", "_first", "_before", "n"), [group, "_part"])
    return store.save(placed.withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first")).select(*rows.columns, "pos", "n"), name)
