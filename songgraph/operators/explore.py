"""The six catalogue exploration queries and a column profile.

Every top-k ends on a unique key (``song_id``, or the group key) so that ties
at the cut are broken the same way on every run and in the oracle. Each
``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task keeps
its own k best rows, so only k rows per task cross the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songgraph.functions.scalar import not_nan, sql_year_known


def oldest_songs(songs: DataFrame, k: int = 10) -> DataFrame:
    """TK1, FLT4: the k earliest songs with a known year."""
    return (songs.where(sql_year_known("year"))
                 .orderBy(F.col("year").asc(), F.col("song_id").asc())
                 .limit(k).select("title", "year"))


def newest_songs(songs: DataFrame, k: int = 10) -> DataFrame:
    """TK2, FLT4: the k latest songs with a known year."""
    return (songs.where(sql_year_known("year"))
                 .orderBy(F.col("year").desc(), F.col("song_id").asc())
                 .limit(k).select("title", "year"))


def hottest_shortest(songs: DataFrame, k: int = 10) -> DataFrame:
    """TK3, FLT5: hottest first, then shortest, most energetic, slowest.

    ``energy`` is not part of the song records; it is null unless present.
    """
    if "energy" not in songs.columns:
        songs = songs.withColumn("energy", F.lit(None).cast("double"))
    return (songs.where(not_nan("song_hotttnesss"))
                 .orderBy(F.col("song_hotttnesss").desc(),
                          F.col("duration").asc_nulls_last(),
                          F.col("energy").desc_nulls_last(),
                          F.col("tempo").asc_nulls_last(),
                          F.col("song_id").asc())
                 .limit(k)
                 .select("title", "song_hotttnesss", "duration", "energy", "tempo"))


def biggest_albums(songs: DataFrame, k: int = 10) -> DataFrame:
    """AG2, TK4: releases with the most tracks; ``COUNT(release)`` so the null
    release group counts 0. Partial aggregation runs before the shuffle."""
    return (songs.groupBy("release")
                 .agg(F.count("release").alias("ntrack"))
                 .orderBy(F.col("ntrack").desc(), F.col("release").asc_nulls_last())
                 .limit(k))


def longest_songs(songs: DataFrame, k: int = 10) -> DataFrame:
    """TK2: artists of the k longest songs."""
    return (songs.orderBy(F.col("duration").desc_nulls_last(), F.col("song_id").asc())
                 .limit(k).select("artist_name", "duration"))


def longest_songs_late_join(tracks: DataFrame, artists: DataFrame,
                            k: int = 10) -> DataFrame:
    """TK2 with the artist lookup after the cut: the top-k runs on the track
    table alone and only k rows meet the artist table. Same answer as
    ``longest_songs(tracks LEFT JOIN artists)`` because the join is a left join
    on the artist key, which is unique."""
    top = (tracks.orderBy(F.col("duration").desc_nulls_last(), F.col("song_id").asc())
                 .limit(k).select("song_id", "artist_id", "duration"))
    return (top.join(artists.select("artist_id", "artist_name"), "artist_id", "left")
               .select("artist_name", "duration"))


def missing_year_pct(songs: DataFrame) -> DataFrame:
    """AG1, AG3, SC3, SC6: share of songs whose year is the sentinel 0, in
    percent, 2 digits. A null year counts only in the denominator."""
    pct = F.round(F.count(F.when(F.col("year") == 0, 1)) * 100.0 / F.count(F.lit(1)), 2)
    return songs.agg(pct.cast("double").alias("pct_missing"))


def profile(df: DataFrame) -> DataFrame:
    """SRC8: row count and null / NaN / zero counts of every column, computed
    in ONE aggregation pass, returned one row per column."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    kinds = {}
    for f in df.schema.fields:
        c = F.col(f.name)
        t = f.dataType.typeName()
        numeric = t in ("double", "float", "integer", "long", "short", "byte", "decimal")
        fractional = t in ("double", "float")
        kinds[f.name] = t
        aggs.append(F.count(F.when(c.isNull(), 1)).alias(f"{f.name}__null"))
        aggs.append((F.count(F.when(F.isnan(c), 1)) if fractional
                     else F.lit(0).cast("long")).alias(f"{f.name}__nan"))
        aggs.append((F.count(F.when(c == 0, 1)) if numeric
                     else F.lit(0).cast("long")).alias(f"{f.name}__zero"))
    wide = df.agg(*aggs)
    stack = ", ".join(
        f"'{name}', '{kinds[name]}', `{name}__null`, `{name}__nan`, `{name}__zero`"
        for name in df.columns)
    return wide.selectExpr(
        "__n AS n_rows",
        f"stack({len(df.columns)}, {stack}) AS (column_name, data_type, n_null, n_nan, n_zero)"
    ).select("column_name", "data_type", "n_rows", "n_null", "n_nan", "n_zero")
