"""A store of clean series that can be numbered without a shuffle, and of which single months can be replaced.

Rows lie in folders by year and month. Inside, they are dealt to a fixed number of buckets by series and time cell (12.7 days, see
`position`), so whatever needs the rows of a cell together finds them together; a long series is spread over the buckets cell by cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gridtide.operators.position import CELL_BITS, CELL_ROWS, Cells, cell_of, index_series, outline
from gridtide.session import stored

BUCKETS = 64
PARTITIONS = ("year", "month")


def _laid_out(df: DataFrame, keys: Sequence[str], buckets: int, ts: str) -> DataFrame:
    """Rows with their month and cell, one task for each bucket, so that a month has one file for each bucket at most."""
    missing = F.lit(False)
    for k in (*keys, ts):
        missing = missing | F.col(k).isNull()
    cell = F.when(missing, F.raise_error(F.lit("A row of the store needs a time and all its keys.")).cast("long")).otherwise(cell_of(ts, CELL_BITS[0]))
    rows = df.withColumns({"year": F.year(ts), "month": F.month(ts), "cell": cell})
    rest = [c for c in rows.columns if c not in PARTITIONS]
    return rows.select(*rest, *PARTITIONS).repartition(buckets, *keys, "cell").sortWithinPartitions(*PARTITIONS, *keys, "cell", ts)


def write_store(df: DataFrame, name: str, path: str, keys: Sequence[str] = (), buckets: int = BUCKETS, ts: str = "timestamp") -> DataFrame:
    """Write clean series as table `name` at `path`, replacing what is there. Times are unique in a series; keys and times are never NULL.

    Columns `year`, `month` and `cell` are set by the store. An empty table makes an empty store.
    """
    writer = _laid_out(df, keys, buckets, ts).write.format("parquet").mode("overwrite").partitionBy(*PARTITIONS)
    writer.bucketBy(buckets, *keys, "cell").sortBy(*keys, "cell", ts).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def replace_months(df: DataFrame, name: str, keys: Sequence[str] = (), ts: str = "timestamp") -> None:
    """Put these rows in place of all rows of the months that they have; the files of other months are left alone."""
    spark = df.sparkSession
    target = spark.table(name)
    buckets = int(spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()["data_type"])
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        _laid_out(df, keys, buckets, ts).select(*target.columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)


def open_store(spark: SparkSession, name: str, path: str, keys: Sequence[str] = (), buckets: int = BUCKETS, ts: str = "timestamp") -> DataFrame:
    """Make a store that another session wrote known to this one."""
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet PARTITIONED BY ({quoted(PARTITIONS)}) CLUSTERED BY ({quoted([*keys, 'cell'])}) SORTED BY ({quoted([*keys, 'cell', ts])}) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def index_store(store: DataFrame, keys: Sequence[str] = (), ts: str = "timestamp", cell_rows: int = CELL_ROWS) -> DataFrame:
    """`index_series` of a whole store: rows are read bucket by bucket and numbered where they are; only a table of cells is shuffled.

    A store with more than `cell_rows` rows in some cell is numbered by `index_series`, which cuts such cells.
    """
    at = [*keys, "cell"]
    counted = stored(store.groupBy(*at).agg(F.count(F.lit(1)).alias("_rows")), "cells")
    if (counted.agg(F.max("_rows")).first()[0] or 0) > cell_rows:
        return index_series(store.drop(*PARTITIONS, "cell"), keys, ts, cell_rows=cell_rows)
    cells = Cells(counted.select(*keys, F.lit(CELL_BITS[0]).alias("_bits"), F.col("cell").alias("_cell"), "_rows"), (CELL_BITS[0],), ())
    placed = outline(cells, keys, {"_rows": "_start"}, {"_rows": "n"}).table.select(*keys, F.col("_cell").alias("cell"), "_start", "n")
    rows = store.drop(*PARTITIONS).join(placed, at)
    inside = Window.partitionBy(*at).orderBy(ts)
    return rows.withColumn("idx", F.col("_start") + F.row_number().over(inside) - 1).drop("_start", "cell")
