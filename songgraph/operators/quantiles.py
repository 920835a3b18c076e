"""Exact order statistics of many groups at once, by narrowing value brackets (AG11).

No group is ever gathered or sorted, small or large, and there is one path for all of
them. A group's bracket is the range of values that still may hold the wanted rank. A
round cuts every open bracket into its two end values and ``BINS`` equal parts between
them, and counts the group's values by part, with the least and the greatest value of
each; counts combine partially before the shuffle, so a group holding a third of all rows
sends at most BINS + 2 rows a task. The part in which the running count reaches the rank
answers it if it holds one value, or if the rank is the part's first or last; otherwise
its least and greatest value are the bracket of the next round, which reads open groups
only. Groups of a few dozen values are answered in the first round, and each further
round excludes all but about 1 / BINS of an evenly spread bracket (and at least its two
ends, so it always ends).

NaN sorts above every number, as in Spark's sort.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from songgraph.session import materialize, scratch

BINS = 64


def _part(x: Column, lo: Column, hi: Column) -> Column:
    """The number of the part that ``x`` falls in: 0 and BINS + 1 are the ends."""
    inside = (x * 0.5 - lo * 0.5) / (hi * 0.5 - lo * 0.5)       # halves: no overflow
    finite = (F.abs(lo) < float("inf")) & (F.abs(hi) < float("inf"))
    return (F.when(x == lo, 0).when(x == hi, BINS + 1)
             .when(finite, 1 + F.least(F.lit(BINS - 1), F.floor(inside * BINS).cast("int")))
             .otherwise(1)).cast("int")


def _round(rows: DataFrame, keys: list[str], x: str) -> DataFrame:
    """One round: per group its part with the rank, as (keys, lo, hi, n, r, two, after):
    ``r`` counts inside the part, ``after`` is the next greater value."""
    parts = rows.groupBy(*keys, _part(F.col(x), F.col("lo"), F.col("hi")).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"),
        F.first("r").alias("r"), F.first("two").alias("two"))
    order = Window.partitionBy(*keys).orderBy("part")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (parts.withColumn("upto", upto).withColumn("after", F.lead("lo").over(order))
                 .where((F.col("r") <= F.col("upto")) & (F.col("r") > F.col("upto") - F.col("n")))
                 .select(*keys, "lo", "hi", "n", (F.col("r") - F.col("upto") + F.col("n")).alias("r"), "two", "after"))


def order_statistics(rows: DataFrame, keys: list[str], x: str,
                     again: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``rows``: (keys..., x, lo, hi, r, two), the values with the least and greatest value
    of their group, the rank wanted from 1 to the group's size, and whether the next one
    is wanted too; read once a round. ``again`` may give a cheaper way to the values
    (keys..., x) of the open groups of a frame (keys...). Returns (keys..., first, second),
    one row a group, ``second`` null unless ``two``. Values and keys must not be null."""
    with scratch(rows.sparkSession) as own:
        done, vals = [], rows
        while True:
            hits = materialize(_round(vals, keys, x), "brackets")
            one = F.col("lo") == F.col("hi")
            first = F.when(one | (F.col("r") == 1), F.col("lo")).when(F.col("r") == F.col("n"), F.col("hi"))
            second = F.when(F.col("r") == F.col("n"), F.col("after")) \
                .when(one | (F.col("r") + 1 == F.col("n")), F.when(one, F.col("lo")).otherwise(F.col("hi")))
            found = hits.select("*", first.alias("first"), F.when(F.col("two"), second).alias("second"))
            closed = F.col("first").isNotNull() & (~F.col("two") | F.col("second").isNotNull())
            done.append(found.where(closed).select(*keys, "first", "second"))
            still = found.where(~closed).select(*keys, "lo", "hi", "r", "two")
            if still.isEmpty():
                return own.keep(reduce(DataFrame.unionByName, done), "order-statistics")
            left = rows if again is None else again(still.select(*keys))
            vals = left.select(*keys, x).join(still, keys) \
                .where((F.col(x) >= F.col("lo")) & (F.col(x) <= F.col("hi")))


def exact_medians(rows: DataFrame, keys: list[str], x: str, out: str = "median",
                  again: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``rows``: (keys..., x, lo, hi, n), the values with their group's least and greatest
    value and size. The median per group, the mean of the middle two for an even size."""
    ranks = rows.select(*keys, x, "lo", "hi", F.floor((F.col("n") + 1) / 2).cast("long").alias("r"),
                        (F.col("n") % 2 == 0).alias("two"))
    got = order_statistics(ranks, keys, x, again)
    return got.select(*keys, F.when(F.col("second").isNull(), F.col("first"))
                      .otherwise((F.col("first") + F.col("second")) / 2.0).alias(out))
