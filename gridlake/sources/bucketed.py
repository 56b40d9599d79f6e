"""Co-located tables (K2/S1): Parquet bucketed by key, so that joins,
aggregates and windows on the key read without a shuffle.

Two tables with the same number of buckets on the same keys meet bucket by
bucket; the shuffle is paid once, when they are written. A bucket is one
task, so ``count`` follows the larger table (128-256 MB a bucket), and a
bucket holds its keys whole: bucket by (meter, month), say, where one meter
alone would outgrow a task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Buckets:
    count: int
    keys: tuple[str, ...] = ("meter_id",)
    sort: tuple[str, ...] = ()


def place(df: DataFrame, buckets: Buckets) -> DataFrame:
    """``df`` with the rows of each bucket in one task. What only needs the
    keys together (a dedupe, say) can follow without a further shuffle."""
    return df.repartition(buckets.count, *buckets.keys)


def write_bucketed(df: DataFrame, name: str, path: str, buckets: Buckets, placed: bool = False) -> DataFrame:
    """Write ``df`` to ``path`` in buckets, one file each, replacing what is
    there, and return it as the catalog's table ``name``. ``placed``: the rows
    come from ``place`` with the same buckets, so they aren't moved again."""
    rows = df if placed else place(df, buckets)
    w = rows.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets.count, *buckets.keys)
    if buckets.sort:
        w = w.sortBy(*buckets.sort)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, schema: StructType, buckets: Buckets) -> DataFrame:
    """Name a folder that ``write_bucketed`` wrote in this session's catalog
    (a catalog that lasts knows it already) and return the table."""
    def listed(columns) -> str:
        return ", ".join(f"`{c}`" for c in columns)

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    order = f" SORTED BY ({listed(buckets.sort)})" if buckets.sort else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({listed(buckets.keys)}){order} INTO {buckets.count} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
