"""Ingest and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from songgraph.operators import recommend as R
from songgraph.plans.base import cte, register
from songgraph.plans.recommend_queries import _REC_SQL
from songgraph.plans.graph_queries import run_nearest
from songgraph.operators import graph as G
from songgraph.session import materialize, new_folder, scratch
from songgraph.sources import adapters as A
from songgraph.sources import files as FS
from songgraph.streaming import requests as ST


SONG_COLS = ["song_id", "artist_id", "title", "artist_name", "release", "year", "duration",
             "song_hotttnesss", "tempo", "key", "mode", "loudness", "time_signature",
             "key_confidence", "mode_confidence", "artist_familiarity", "artist_hotttnesss"]


def land(spark, sf_dir, raw: str) -> None:
    """The song table as many small files in nested folders, and beside them a text file
    for every record label, which the scan's suffix takes in and no song reader can read."""
    songs = A.songs(spark, sf_dir)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (songs.withColumn("shelf", F.pmod(F.xxhash64("song_id"), F.lit(2)))
          .repartition(4 * n).write.partitionBy("shelf").parquet(f"{raw}/good"))
    labels = A.artists(spark, sf_dir).select("label_name").distinct() \
        .withColumn("text", F.concat(F.lit("no songs of "), "label_name"))
    labels.repartition("label_name").write.partitionBy("label_name").text(f"{raw}/bad")


SUFFIX = "t"        # of .parquet and .txt: the scan meets both kinds, and skips what it cannot read


@register("compact_songs", cte(songs=A.SQL_SONGS) + "SELECT * FROM songs")
def q_compact_songs(spark, sf_dir):
    """SRC5 SRC6 SRC7 SNK1 SRC1: the song table landed as many small files in
    nested folders among files that are no Parquet, found by a recursive suffix
    scan, packed by size into few Snappy Parquet files without a shuffle, read
    back whole"""
    with scratch(spark) as own:
        raw, out = own.folder("landing"), new_folder(spark, "compacted")
        land(spark, sf_dir, raw)
        FS.compact(spark, raw, out, SUFFIX, schema=A.songs(spark, sf_dir).schema)
        return FS.read_table(spark, out, columns=SONG_COLS)


@register("ingest_rejects", cte(songs=A.SQL_SONGS, artists=A.SQL_ARTISTS) + """
SELECT DISTINCT label_name AS "release", 'no readable rows' AS reason,
       CAST(strlen('no songs of ' || label_name) + 1 AS BIGINT) AS amount
FROM artists
UNION ALL SELECT NULL, 'rows read', count(*) FROM songs""")
def q_ingest_rejects(spark, sf_dir):
    """SRC6: the same landing folder audited file by file: every file that gave no
    rows with its reason and length, and the number of rows read from all the others"""
    with scratch(spark) as own:
        raw = own.folder("landing")
        land(spark, sf_dir, raw)
        files = materialize(FS.audit(spark, raw, SUFFIX, schema=A.songs(spark, sf_dir).schema), "audit")
        bad = FS.rejects(files).select(F.regexp_extract("path", "label_name=([^/]*)/", 1).alias("release"),
                                       "reason", F.col("length").alias("amount"))
        read = files.agg(F.sum("n_rows").alias("amount")).select(
            F.lit(None).cast("string").alias("release"), F.lit("rows read").alias("reason"), "amount")
        return own.keep(bad.unionByName(read), "rejects")


@register("recommend_stream", _REC_SQL)
def q_recommend_stream(spark, sf_dir):
    """RC5 over Structured Streaming: requests land as files, each
    micro-batch is answered by the batch plan; same answer as recommend_batch"""
    req = A.requests(spark, sf_dir)
    tracks = A.tracks(spark, sf_dir)
    with scratch(spark) as own:
        resolved = materialize(R.resolve(req, tracks), "requests")
        roots = resolved.where(F.col("status") == "ok").select(F.col("anchor_artist").alias("root"))
        paths = materialize(run_nearest(spark, sf_dir, lambda sym: roots, R.SIMILAR_N), "paths")
        inbox = own.folder("requests")
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        req.repartition(n, "req_id").write.parquet(inbox)
        out = new_folder(spark, "answers")
        q = ST.serve(spark, inbox, tracks, paths, out, own.folder("stream-ckpt"), artists=A.artists(spark, sf_dir),
                     max_files_per_trigger=max(1, n // 2))
        q.awaitTermination()
        return ST.read_answers(spark, out)
