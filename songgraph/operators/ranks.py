"""Numbering rows in order without gathering a group (range partitions).

Rows are range-partitioned by (keys, order), counted per key and partition, and numbered
inside a partition from the rows before it: a key that holds all rows spreads over as
many tasks as there are, and a window only ever sees one key's part of one partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songgraph.session import materialize


def positions(df: DataFrame, keys: list[str], order: list[str], pos: str = "pos") -> DataFrame:
    """``df`` with ``pos``, counting the rows of each key from 0 in ``order`` (ascending).
    Keys must not be null; rows equal in keys and order are numbered in any order, so
    end the order with a unique column."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(parts, *keys, *order)
                         .withColumn("_pid", F.spark_partition_id()), "ranged")
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = (ranged.groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_n"))
                  .withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    inside = Window.partitionBy(*keys, "_pid").orderBy(*order)
    return (ranged.withColumn("_at", F.row_number().over(inside) - 1)
                  .join(offs, [*keys, "_pid"])
                  .select(*df.columns, (F.col("_off") + F.col("_at")).alias(pos)))
