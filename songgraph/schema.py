"""Domain schemas: the song table, the similarity edge list, requests.

Every field is nullable, as in the source song records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_D = T.DoubleType()
_I = T.IntegerType()
_S = T.StringType()
_A = T.ArrayType(T.DoubleType())

# The song record layout (field name, type), in record order.
SONG = T.StructType([
    T.StructField("artist_id", _S), T.StructField("artist_7digitalid", _I),
    T.StructField("artist_mbid", _S), T.StructField("artist_playmeid", _I),
    T.StructField("release_7digitalid", _I), T.StructField("track_7digitalid", _I),
    T.StructField("song_id", _S), T.StructField("track_id", _S),
    T.StructField("title", _S), T.StructField("artist_name", _S),
    T.StructField("release", _S), T.StructField("artist_familiarity", _D),
    T.StructField("artist_hotttnesss", _D), T.StructField("song_hotttnesss", _D),
    T.StructField("duration", _D), T.StructField("key", _I),
    T.StructField("tempo", _D), T.StructField("mode", _I),
    T.StructField("loudness", _D), T.StructField("time_signature", _I),
    T.StructField("key_confidence", _D), T.StructField("mode_confidence", _D),
    T.StructField("segments_timbre", _A), T.StructField("segments_pitches", _A),
    T.StructField("timbre_cov", _A), T.StructField("pitch_cov", _A),
    T.StructField("year", _I),
])

# The six statistics per segment dimension, in array order
# (index dim*6 + stat), and the matrix width.
STAT_NAMES = ["mean", "median", "min", "max", "std", "count"]
N_DIMS = 12
N_STATS = N_DIMS * len(STAT_NAMES)          # 72
N_COV = N_DIMS * (N_DIMS + 1) // 2          # 78, upper triangle row-major

# Scalar model inputs of the year regressor, in feature order.
SCALAR_FEATURES = [
    "artist_familiarity", "artist_hotttnesss", "song_hotttnesss",
    "duration", "key", "tempo", "mode", "loudness",
    "time_signature", "key_confidence", "mode_confidence",
]

REQUEST = T.StructType([
    T.StructField("req_id", T.LongType()), T.StructField("song_id", T.LongType()),
    T.StructField("artist_id", T.LongType()), T.StructField("top_k", _I),
    T.StructField("birth_year", _I),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: cast present fields, add absent ones as
    null (e.g. ``energy`` is queried but missing from the song records)."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name).cast(f.dataType) if f.name in have
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])
