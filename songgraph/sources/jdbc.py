"""Similarity edges from a database table (SRC3).

The original reads the whole table through one connection. Here the read is split
into ranges of a key column that are read in parallel. The similarity table has two
string columns, so the bounds are values of the key itself: one query asks the
database for the first key of each of ``num_partitions`` equal shares, and each
partition reads the keys from one bound to the next. Numbers, strings and dates
are all split this way; rows without a key are in the first partition.
"""

from __future__ import annotations

import datetime
import decimal

from pyspark.sql import DataFrame, SparkSession


def literal(value) -> str:
    """A bound as an SQL literal."""
    if isinstance(value, bool) or value is None:
        raise ValueError(f"not a key to split on: {value!r}")
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        kind = "TIMESTAMP" if isinstance(value, datetime.datetime) else "DATE"
        return f"{kind} '{value}'"
    return "'" + str(value).replace("'", "''") + "'"


def range_predicates(column: str, bounds: list) -> list[str]:
    """Disjoint conditions that together hold for every row, for ascending bounds (the
    first key of each share after the first)."""
    cuts = [literal(b) for b in dict.fromkeys(bounds)]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def bounds_query(table: str, column: str, num_partitions: int) -> str:
    """The first key of each equal share of the table's keys after the first share."""
    return (f"(SELECT share, MIN({column}) AS bound FROM (SELECT {column}, NTILE({int(num_partitions)}) "
            f"OVER (ORDER BY {column}) AS share FROM {table} WHERE {column} IS NOT NULL) s "
            f"WHERE share > 1 GROUP BY share) b")


def read_edges(spark: SparkSession, url: str, table: str = "similarity",
               partition_column: str | None = None, num_partitions: int = 1,
               driver: str | None = None, properties: dict[str, str] | None = None,
               target: str = "target", similar: str = "similar",
               fetch_size: int = 10_000) -> DataFrame:
    """``(target, similar)`` as strings. With ``num_partitions`` above 1 the read is
    split on ``partition_column`` (by default the target); at most ``num_partitions``
    bounds reach the driver."""
    props = {"fetchsize": str(fetch_size), **(properties or {})}
    if driver:
        props["driver"] = driver
    if num_partitions > 1:
        column = partition_column or target
        shares = spark.read.jdbc(url, bounds_query(table, column, num_partitions), properties=props)
        bounds = [r[1] for r in sorted(shares.collect(), key=lambda r: r[0])]
        df = spark.read.jdbc(url, table, predicates=range_predicates(column, bounds), properties=props)
    else:
        df = spark.read.jdbc(url, table, properties=props)
    cols = {c.lower(): c for c in df.columns}
    return df.select(df[cols[target.lower()]].cast("string").alias("target"),
                     df[cols[similar.lower()]].cast("string").alias("similar"))
