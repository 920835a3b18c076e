"""Serving table of similar artists (the key-value cache, as a table).

The table is long form ``(root, v, degree)``: one row per cached neighbour, so
no root's list is ever gathered into one row or one task. It is written
hash-bucketed by root (a ``bucket`` partition column), so a lookup of one
artist reads one directory; inside a bucket's files the rows are sorted by
``(root, degree, v)``, so Parquet row-group statistics skip most of it.

The JSON value of the original cache (``[[id, degree], ...]`` ordered by
``(degree, id)``) is produced whole, in numbered chunks of a bounded length.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from songgraph.operators.graph import nearest
from songgraph.operators.ranks import positions
from songgraph.session import file_system

N_BUCKETS = 64
CHUNK = 1000        # entries of one JSON chunk
MARKS = "_published"    # folder of the version markers


def write_serving_table(paths: DataFrame, path: str, n_buckets: int = N_BUCKETS, keep: int = 2) -> str:
    """SNK3: publish a new version of the table, which replaces the one before.

    The rows go to a folder of their own, one directory per bucket; when they are all
    there, an empty marker file named after the version is created. Readers take the
    newest marked version, so none ever sees half a table, and a writer that dies leaves
    the old version in place. The ``keep`` newest versions stay (a reader may still be on
    the one before), older ones and unmarked leftovers below them are removed. One
    writer at a time. Returns the version's folder.

    Rows are spread over the write tasks by ``(bucket, second hash of the
    root)`` with ``k`` sub-parts per bucket, ``k`` chosen so that all buckets
    together use as many tasks as the session's shuffle partitions. The
    shuffle is a ``REBALANCE``: AQE coalesces small partitions and splits any
    partition above the advisory size, so a root holding a third of all rows
    is written by many tasks (its rows then span several files of its bucket
    directory, each sorted by ``(root, degree, v)``)."""
    spark = paths.sparkSession
    tasks = max(n_buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    k = max(1, math.ceil(tasks / n_buckets))
    b = F.pmod(F.xxhash64("root"), F.lit(n_buckets)).alias("bucket")
    part = F.pmod(F.xxhash64(F.col("root"), F.lit(7)), F.lit(k)).alias("_part")
    done = versions(spark, path)
    name = f"{(int(done[-1][1:].partition('-')[0]) if done else 0) + 1:010d}-{uuid.uuid4().hex}"
    (paths.select("root", "v", "degree", b, part)
          .hint("rebalance", "bucket", "_part")
          .drop("_part")
          .sortWithinPartitions("root", "degree", "v")
          .write.partitionBy("bucket").parquet(f"{path}/v{name}"))
    marker, fs = file_system(spark, f"{path}/{MARKS}/v{name}")
    fs.mkdirs(marker.getParent())
    fs.create(marker, False).close()
    done = versions(spark, path)
    for old in done[:-keep]:
        fs.delete(file_system(spark, f"{path}/{MARKS}/{old}")[0], False)
    first = done[-keep:][0]
    for version in _names(spark, path):
        if version.startswith("v") and version < first:
            fs.delete(file_system(spark, f"{path}/{version}")[0], True)
    return f"{path}/v{name}"


def _names(spark: SparkSession, path: str) -> list[str]:
    where, fs = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def versions(spark: SparkSession, path: str) -> list[str]:
    """The published versions, oldest first."""
    return [n for n in _names(spark, f"{path}/{MARKS}") if n.startswith("v")]


def read_serving_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest published version. The frame stays on that version, whatever is
    published later, until it has been superseded twice."""
    done = versions(spark, path)
    if not done:
        raise FileNotFoundError(f"no published version under {path}")
    return spark.read.parquet(f"{path}/{done[-1]}")


def lookup(table: DataFrame, artist_id, k: int, n_buckets: int = N_BUCKETS) -> DataFrame:
    """SRC9/SC10: the first ``k`` entries for one artist; an unknown artist
    gives an empty frame. The bucket predicate prunes directories; the id
    is cast to the table's root type first, as the hash depends on the type."""
    key = F.lit(artist_id).cast(table.schema["root"].dataType)
    one = (table.where((F.col("bucket") == F.pmod(F.xxhash64(key), F.lit(n_buckets)))
                       & (F.col("root") == key)))
    return nearest(one.drop("bucket"), k).select("v", "degree", "rank")


def lookup_many(table: DataFrame, asks: DataFrame, k_col: str = "top_k",
                n_buckets: int = N_BUCKETS) -> DataFrame:
    """SRC9 for a table of asks ``(req_id, artist_id, top_k)``: each ask gets
    the first ``top_k`` entries of its artist. Only asked roots are read (joined
    on ``bucket`` too, so directories can be pruned), and each is cut to the
    largest ``top_k`` before the asks join (WindowGroupLimit)."""
    kmax = asks.agg(F.max(k_col)).first()[0] or 0
    key = F.col("artist_id").cast(table.schema["root"].dataType)
    wanted = asks.select(key.alias("root")).distinct() \
        .withColumn("bucket", F.pmod(F.xxhash64("root"), F.lit(n_buckets)).cast(table.schema["bucket"].dataType))
    pre = nearest(table.join(wanted, ["bucket", "root"], "left_semi").select("root", "v", "degree"), int(kmax))
    return (asks.join(pre, asks["artist_id"] == pre["root"])
                .where(F.col("rank") <= F.col(k_col))
                .select("req_id", "v", "degree", "rank"))


def dump(table: DataFrame) -> DataFrame:
    """SRC10/SC14: every cached entry with its key string, the key parsed
    back into the artist id."""
    key = F.concat(F.lit("artist:"), F.col("root").cast("string"), F.lit(":recs"))
    return table.select(key.alias("key"), "v", "degree").select(
        "key", F.split_part("key", F.lit(":"), F.lit(2)).alias("artist"), "v", "degree")


def numbered(paths: DataFrame) -> DataFrame:
    """``(root, v, degree, pos)``, ``pos`` counting a root's entries from 0 in
    ``(degree, id)`` order; a root's list is never in one task."""
    return positions(paths.select("root", "v", "degree"), ["root"], ["degree", "v"])


def recs_json(paths: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """SC12/AG6: per root the whole JSON list ``[[id, degree], ...]`` in
    ``(degree, id)`` order, as ``(key, chunk_no, recs_json)`` with at most
    ``chunk`` entries a row."""
    pairs = F.sort_array(F.collect_list(F.struct(
        F.col("degree").cast("long").alias("d"), F.col("v").alias("i"))))

    def pair_json(x):
        # the id's own JSON form (quoted if a string), then the degree
        id_json = F.regexp_extract(F.to_json(F.array(x["i"])), r"^\[(.*)\]$", 1)
        return F.concat(F.lit("["), id_json, F.lit(","), x["d"].cast("string"), F.lit("]"))
    rows = numbered(paths).withColumn("chunk_no", F.floor(F.col("pos") / chunk).cast("int"))
    return (rows.groupBy("root", "chunk_no").agg(pairs.alias("p"))
               .select(F.concat(F.lit("artist:"), F.col("root").cast("string"),
                                F.lit(":recs")).alias("key"), "chunk_no",
                       F.concat(F.lit("["), F.array_join(F.transform("p", pair_json), ","),
                                F.lit("]")).alias("recs_json")))


def parse_recs(df: DataFrame, col: str = "recs_json", id_type: str = "long",
               chunk: int = CHUNK) -> DataFrame:
    """SC13: decode the JSON chunks back into ``(key, pos, v, degree)`` rows,
    ``pos`` from 1."""
    arr = F.from_json(F.col(col), T.ArrayType(T.ArrayType(T.StringType())))
    return (df.select("key", "chunk_no", F.posexplode(arr).alias("pos", "pair"))
              .select("key", (F.col("chunk_no") * chunk + F.col("pos") + 1).alias("pos"),
                      F.get("pair", 0).cast(id_type).alias("v"),
                      F.get("pair", 1).cast("long").alias("degree")))
