"""Row numbers within groups without a task that holds a group, and joins that split hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpusloom.session import stage_table

#: Keys that hold more than one row in so many are joined by broadcast: there are fewer of them than that.
SHARE = 1000


def numbered(df: DataFrame, group: list[str], order: list[str], label: str) -> DataFrame:
    """``df`` with ``i``, a row's place in its group from 0 by ``order`` (nulls first), and ``n``, the group's rows.

    Rows are dealt into ranges of (group, order) and sorted there; a row's number
    within its range and the sums of the ranges before give its place. Only a row
    for each range and group is added up, at most one for each range in one
    group. Rows equal in all keys get places in no defined order.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at_", F.monotonically_increasing_id())
    rows = stage_table(dealt, label)
    runs = rows.groupBy(*group, F.shiftright("at_", 33).alias("p_")).agg(F.min("at_").alias("first_"), F.count("*").alias("m_"))
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    before = whole.orderBy("p_").rowsBetween(Window.unboundedPreceding, -1)
    names = [F.col(c).alias(f"g{k}_") for k, c in enumerate(group)]
    runs = stage_table(runs.select(*names, "p_", "first_", F.coalesce(F.sum("m_").over(before), F.lit(0)).alias("skip_"), F.sum("m_").over(whole).alias("n")), f"{label}-runs")
    met = F.shiftright("at_", 33) == F.col("p_")
    for k, c in enumerate(group):
        met = met & F.col(c).eqNullSafe(F.col(f"g{k}_"))
    return rows.join(runs, met).select(*df.columns, (F.col("at_") - F.col("first_") + F.col("skip_")).alias("i"), "n")


def join_hot(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has each of ``keys`` once and in ``weight`` the number of ``rows`` that hold it.

    Keys of over one in ``SHARE`` of the ``total`` rows, fewer than ``SHARE`` by
    that, are broadcast; the others meet in a shuffle. A null key meets nothing
    and is kept by a left join.
    """
    is_hot = F.col(weight) * SHARE > total
    hot, cold = table.filter(is_hot), table.filter(~is_hot)
    rest = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(hot), keys).unionByName(rest.join(cold, keys, how))
