"""Joins of rows to per-group tables that hold up when one group has most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gridtide.session import stored

def lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner", keep: str | None = None) -> DataFrame:
    """Equi-join that treats NULL keys as equal and keeps one copy of the join columns.

    The join columns are compared as one struct, whose NULL fields match each other. `keep` names that
    struct in the result: a window partitioned by it reuses the shuffle of the join.
    """
    if not on:
        return rows.crossJoin(F.broadcast(table))
    left = keep or "_on"
    renamed = table.withColumn("_table_on", F.struct(*on)).drop(*on)
    joined = rows.withColumn(left, F.struct(*on)).join(renamed, F.col(left) == F.col("_table_on"), how).drop("_table_on")
    return joined if keep else joined.drop(left)


def attach(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Add the columns of a one-row-per-group table to every row of the group.

    Without group columns the table has one row. Otherwise it is written once, so that its size in bytes is known:
    one below `spark.sql.autoBroadcastJoinThreshold` is broadcast, a larger one meets the rows in a sort-merge join.
    A group has one row on that side, so adaptive execution splits the rows of a hot group over tasks, however alike
    they are; nothing is copied for groups that are not hot.
    """
    if not on:
        return rows.crossJoin(F.broadcast(table))
    return lookup(rows, stored(table), on, how)
