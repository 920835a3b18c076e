"""The song domain over the driver's TPC-H-like tables.

Orders are tracks, customers are artists, consecutive orders link two artists
as similar, line items are the segments of a track, events are
listener requests. Each view is built twice from one definition: as a
DataFrame (what the jobs run) and as SQL text (what the DuckDB oracle runs as
a CTE). Both must stay in step; ``tests/test_oracle.py`` checks them.

The driver's tables hold no nulls, NaN or year-0 sentinels, so the views plant
them deterministically from the key (every 101st track has no year, every
second even one has the sentinel 0, ...). These are value rules, not filters:
every row of every table is kept. A track's loudness follows from the year of its
order (also where the view hides the year), the one signal for the year model.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k(c: str) -> Column:
    return F.col(c)


# --------------------------------------------------------------------------
# tracks: one row per order, no join
# --------------------------------------------------------------------------

def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = _k("o_orderkey")
    return o.select(
        k.alias("song_id"),
        _k("o_custkey").alias("artist_id"),
        F.concat(F.lit("Track#"), k.cast("string")).alias("title"),
        F.when(k % 101 == 0, F.lit(None).cast("int"))
         .when(k % 2 == 0, F.lit(0))
         .otherwise(F.year("o_orderdate")).cast("int").alias("year"),
        (_k("o_totalprice") / 1000.0).alias("duration"),
        F.when(k % 7 == 0, F.lit(float("nan")))
         .when(k % 11 == 0, F.lit(None).cast("double"))
         .otherwise((k % 1000).cast("double") / 1000).alias("song_hotttnesss"),
        (60 + k % 140).cast("double").alias("tempo"),
        (k % 12).cast("int").alias("key"),
        (_k("o_custkey") % 2).cast("int").alias("mode"),
        # louder from year to year, so that a year model has something to learn
        (7 * (F.year("o_orderdate") - 2000) - k % 4).cast("double").alias("loudness"),
        (3 + k % 5).cast("int").alias("time_signature"),
        ((k % 97).cast("double") / 97).alias("key_confidence"),
        ((_k("o_custkey") % 89).cast("double") / 89).alias("mode_confidence"),
    )


SQL_TRACKS = """
SELECT o_orderkey AS song_id, o_custkey AS artist_id,
  concat('Track#', CAST(o_orderkey AS VARCHAR)) AS title,
  CAST(CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 0
       ELSE year(o_orderdate) END AS INTEGER) AS "year",
  o_totalprice / 1000.0 AS duration,
  CASE WHEN o_orderkey % 7 = 0 THEN CAST('NaN' AS DOUBLE)
       WHEN o_orderkey % 11 = 0 THEN CAST(NULL AS DOUBLE)
       ELSE CAST(o_orderkey % 1000 AS DOUBLE) / 1000 END AS song_hotttnesss,
  CAST(60 + o_orderkey % 140 AS DOUBLE) AS tempo,
  CAST(o_orderkey % 12 AS INTEGER) AS "key",
  CAST(o_custkey % 2 AS INTEGER) AS "mode",
  CAST(7 * (year(o_orderdate) - 2000) - o_orderkey % 4 AS DOUBLE) AS loudness,
  CAST(3 + o_orderkey % 5 AS INTEGER) AS time_signature,
  CAST(o_orderkey % 97 AS DOUBLE) / 97 AS key_confidence,
  CAST(o_custkey % 89 AS DOUBLE) / 89 AS mode_confidence
FROM orders
"""


# --------------------------------------------------------------------------
# artists: one row per customer
# --------------------------------------------------------------------------

def artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        _k("c_custkey").alias("artist_id"),
        _k("c_name").alias("artist_name"),
        F.concat(_k("c_mktsegment"), F.lit("-"),
                 _k("c_nationkey").cast("string")).alias("label_name"),
        ((_k("c_acctbal") + 1000.0) / 11000.0).alias("artist_familiarity"),
        (_k("c_nationkey").cast("double") / 25.0).alias("artist_hotttnesss"),
    )


SQL_ARTISTS = """
SELECT c_custkey AS artist_id, c_name AS artist_name,
  concat(c_mktsegment, '-', CAST(c_nationkey AS VARCHAR)) AS label_name,
  (c_acctbal + 1000.0) / 11000.0 AS artist_familiarity,
  CAST(c_nationkey AS DOUBLE) / 25.0 AS artist_hotttnesss
FROM customer
"""


# --------------------------------------------------------------------------
# songs: tracks with their artist (left join: a track never disappears)
# --------------------------------------------------------------------------

def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = tracks(spark, sf_dir)
    a = artists(spark, sf_dir)
    j = t.join(a, "artist_id", "left")
    return j.select(
        "song_id", "artist_id", "title", "artist_name",
        F.when(F.col("song_id") % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("label_name")).alias("release"),
        "year", "duration", "song_hotttnesss", "tempo", "key", "mode",
        "loudness", "time_signature", "key_confidence", "mode_confidence",
        "artist_familiarity", "artist_hotttnesss",
    )


SQL_SONGS = f"""
SELECT t.song_id, t.artist_id, t.title, a.artist_name,
  CASE WHEN t.song_id % 13 = 0 THEN NULL ELSE a.label_name END AS "release",
  t."year", t.duration, t.song_hotttnesss, t.tempo, t."key", t."mode",
  t.loudness, t.time_signature, t.key_confidence, t.mode_confidence,
  a.artist_familiarity, a.artist_hotttnesss
FROM ({SQL_TRACKS}) t LEFT JOIN ({SQL_ARTISTS}) a ON t.artist_id = a.artist_id
"""


# --------------------------------------------------------------------------
# similarity: artists of consecutive orders (directed, as stored)
# --------------------------------------------------------------------------

def similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    a = o.select((F.col("o_orderkey") + 1).alias("next_key"),
                 F.col("o_custkey").alias("target"))
    b = o.select(F.col("o_orderkey").alias("next_key"),
                 F.col("o_custkey").alias("similar"))
    return (a.join(b, "next_key")
             .where(F.col("target") != F.col("similar"))
             .select("target", "similar"))


SQL_SIMILARITY = """
SELECT a.o_custkey AS target, b.o_custkey AS "similar"
FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1
WHERE a.o_custkey <> b.o_custkey
"""


# --------------------------------------------------------------------------
# segments: line items are the segments of their order's track, long form
# (song_id, seg, x0..x11). Every dim is integer-valued, so sums and means are
# exact in both engines; pitches fold the same dims onto 12 semitones.
# --------------------------------------------------------------------------

def _timbre_dims() -> list[Column]:
    l = F.col
    ship = l("l_shipdate")
    return [
        l("l_quantity"),
        F.floor(l("l_extendedprice") / 100.0).cast("double"),
        F.round(l("l_discount") * 100.0),
        F.round(l("l_tax") * 100.0),
        l("l_linenumber").cast("double"),
        ((F.year(ship) - 1990) * 12 + F.month(ship)).cast("double"),
        F.dayofweek(ship).cast("double"),
        F.floor(l("l_partkey") / 100).cast("double"),
        F.floor(l("l_suppkey") / 10).cast("double"),
        F.floor(l("l_extendedprice") * (1 - l("l_discount")) / 100.0).cast("double"),
        l("l_quantity") * F.round(l("l_tax") * 100.0),
        F.when(l("l_returnflag") == "R", 1.0).otherwise(0.0),
    ]


_SQL_TIMBRE_DIMS = [
    "l_quantity",
    "CAST(floor(l_extendedprice / 100.0) AS DOUBLE)",
    "round(l_discount * 100.0)",
    "round(l_tax * 100.0)",
    "CAST(l_linenumber AS DOUBLE)",
    "CAST((year(l_shipdate) - 1990) * 12 + month(l_shipdate) AS DOUBLE)",
    "CAST(dayofweek(l_shipdate) + 1 AS DOUBLE)",   # Spark: Sunday = 1
    "CAST(floor(l_partkey / 100) AS DOUBLE)",
    "CAST(floor(l_suppkey / 10) AS DOUBLE)",
    "CAST(floor(l_extendedprice * (1 - l_discount) / 100.0) AS DOUBLE)",
    "l_quantity * round(l_tax * 100.0)",
    "CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END",
]


def segments(spark: SparkSession, sf_dir: str, kind: str = "timbre") -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    dims = _timbre_dims()
    if kind == "pitches":
        dims = [d % 12.0 for d in dims]
    return li.select(F.col("l_orderkey").alias("song_id"),
                     F.col("l_linenumber").alias("seg"),
                     *[d.alias(f"x{i}") for i, d in enumerate(dims)])


def sql_segments(kind: str = "timbre") -> str:
    dims = _SQL_TIMBRE_DIMS
    if kind == "pitches":
        dims = [f"(({d}) % 12.0)" for d in dims]
    cols = ", ".join(f"{d} AS x{i}" for i, d in enumerate(dims))
    return f"SELECT l_orderkey AS song_id, l_linenumber AS seg, {cols} FROM lineitem"


def embedding_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as segment matrices: each ``label`` is one song, each vector
    as many 12-wide segments as its whole width needs (the last one short)."""
    e = table(spark, sf_dir, "embeddings")
    parts = F.ceil(F.size("embedding") / 12).cast("int")
    cut = e.where(parts > 0).select(
        F.col("label").cast("long").alias("song_id"), "vec_id", "embedding",
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return cut.select("song_id", (F.col("vec_id") * 1000 + F.col("part")).alias("seg"),
                      *[F.get("embedding", F.col("part") * 12 + i).cast("double").alias(f"x{i}")
                        for i in range(12)])


SQL_EMBEDDING_SEGMENTS = (
    "SELECT CAST(label AS BIGINT) AS song_id, vec_id * 1000 + part AS seg, "
    + ", ".join(f"CAST(embedding[part * 12 + {i + 1}] AS DOUBLE) AS x{i}" for i in range(12))
    + " FROM (SELECT label, vec_id, embedding,"
    + " unnest(range(CAST(ceil(len(embedding) / 12.0) AS BIGINT))) AS part FROM embeddings)")


# --------------------------------------------------------------------------
# requests: each event is a listener asking for recommendations. Sign-ups
# name an artist; every other event names the song with the event's number.
# --------------------------------------------------------------------------

def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    signup = F.col("event_type") == "signup"
    return e.select(
        F.col("event_id").alias("req_id"),
        F.when(~signup, F.col("event_id")).alias("song_id"),
        F.when(signup, F.col("user_id")).alias("artist_id"),
        (1 + F.col("event_id") % 10).cast("int").alias("top_k"),
        (1970 + F.col("user_id") % 30).cast("int").alias("birth_year"),
    )


SQL_REQUESTS = """
SELECT event_id AS req_id,
  CASE WHEN event_type <> 'signup' THEN event_id END AS song_id,
  CASE WHEN event_type = 'signup' THEN user_id END AS artist_id,
  CAST(1 + event_id % 10 AS INTEGER) AS top_k,
  CAST(1970 + user_id % 30 AS INTEGER) AS birth_year
FROM events
"""
