"""Song records and the 313-wide feature projection of the year model.

``flatten`` pulls the 144 statistics and 156 covariances out of the four
record arrays in ONE ``select`` (not 300 stacked ``withColumn`` calls), adds
``log_duration`` and ``tempo_norm``, and fills null and NaN with 0 in the
feature columns only (the original columns keep their values).
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from songgraph.functions.scalar import log_duration, tempo_norm
from songgraph.operators import segments as SG
from songgraph.schema import N_COV, N_DIMS, SCALAR_FEATURES, STAT_NAMES
from songgraph.sources import adapters as A

# Array columns of the song record and their feature prefixes.
STAT_ARRAYS = [("segments_timbre", "timbre"), ("segments_pitches", "pitch")]
COV_ARRAYS = [("timbre_cov", "timbre_cov"), ("pitch_cov", "pitch_cov")]

STAT_COLS = [f"{p}_{d}_{s}" for _, p in STAT_ARRAYS for d in range(N_DIMS) for s in STAT_NAMES]
COV_COLS = [f"{p}_{i}" for _, p in COV_ARRAYS for i in range(N_COV)]
SCALAR_COLS = SCALAR_FEATURES + ["log_duration", "tempo_norm"]
FEATURE_COLS = STAT_COLS + COV_COLS + SCALAR_COLS        # 313


def song_records(spark: SparkSession, sf_dir: str, songs: DataFrame | None = None) -> DataFrame:
    """The full song table: songs plus the four segment arrays of each track,
    computed from its line items (timbre and pitches share the rows, so one
    pass makes all four; pitches are the timbre dims folded onto 12 semitones).
    ``songs``: only the records of these songs of the table."""
    songs = A.songs(spark, sf_dir) if songs is None else songs
    # the rows of the songs go to their segments: the arrays never cross the network
    return SG.song_arrays(A.segments(spark, sf_dir, "timbre"),
                          {"x": ("segments_timbre", "timbre_cov"), "p": ("segments_pitches", "pitch_cov")},
                          derived={"p": lambda x: x % 12.0}, songs=songs) \
        .select(*songs.columns, "segments_timbre", "timbre_cov", "segments_pitches", "pitch_cov")


def _fill0(c) -> F.Column:
    c = c.cast("double")
    return F.coalesce(F.nanvl(c, F.lit(0.0)), F.lit(0.0))


def flatten(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """PRJ4 PRJ5 PRJ6 PRJ7 SC7: the 313 feature columns next to ``keep``."""
    feats = []
    for arr, p in STAT_ARRAYS:
        for d in range(N_DIMS):
            for k, s in enumerate(STAT_NAMES):
                feats.append(_fill0(F.get(arr, d * 6 + k)).alias(f"{p}_{d}_{s}"))
    for arr, p in COV_ARRAYS:
        for i in range(N_COV):
            feats.append(_fill0(F.get(arr, i)).alias(f"{p}_{i}"))
    for c in SCALAR_FEATURES:
        src = F.col(c) if c in df.columns else F.lit(None)
        feats.append(_fill0(src).alias(c))
    feats.append(_fill0(log_duration("duration")).alias("log_duration"))
    feats.append(_fill0(tempo_norm("tempo")).alias("tempo_norm"))
    keep = list(df.columns) if keep is None else keep
    keep = [c for c in keep if c not in FEATURE_COLS]
    return df.select(*keep, *feats)


def feature_array(df: DataFrame) -> F.Column:
    """The same 313 values, in the order of ``FEATURE_COLS``, as one array: five short
    expressions whatever the width, so generated code stays small."""
    def cells(arr: str, n: int) -> F.Column:
        return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: _fill0(F.get(arr, i)))

    scalars = [_fill0(F.col(c) if c in df.columns else F.lit(None)) for c in SCALAR_FEATURES]
    scalars += [_fill0(log_duration("duration")), _fill0(tempo_norm("tempo"))]
    return F.concat(*[cells(arr, N_DIMS * len(STAT_NAMES)) for arr, _ in STAT_ARRAYS],
                    *[cells(arr, N_COV) for arr, _ in COV_ARRAYS], F.array(*scalars))


def with_vector(df: DataFrame, name: str = "features") -> DataFrame:
    """ML1: ``df`` with the feature vector of the year model."""
    return df.withColumn(name, array_to_vector(feature_array(df)))


def _totals(width: int):
    """A function over Arrow batches, whose first column has ``width`` values a row: one row a task and
    place, with the place, the rows, and the sum, least and greatest of its values as Spark has them
    (null without any, NaN above every number). Workers get the function itself, so they
    need not have this package."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        n, total, lo, hi = 0, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            n += batch.num_rows
            cells = batch.column(0).flatten()
            values = cells.to_numpy(zero_copy_only=False).reshape(-1, width)
            with np.errstate(all="ignore"):
                if cells.null_count:
                    known = cells.is_valid().to_numpy(zero_copy_only=False).reshape(-1, width)
                    got = [[f(x[k]) if k.any() else None for x, k in zip(values.T, known.T)]
                           for f in (np.sum, np.fmin.reduce, np.max)]
                else:
                    got = [values.sum(0).tolist(), np.fmin.reduce(values, 0).tolist(), values.max(0).tolist()]
                if total is None:
                    total, lo, hi = got
                else:
                    total, lo, hi = ([b if a is None else a if b is None else f(a, b) for a, b in zip(old, new)]
                                     for f, old, new in zip((np.add, np.fmin, np.maximum), (total, lo, hi), got))
        if n:
            cells = [pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, n))]
            cells += [pa.array(v, pa.float64()) for v in (total, lo, hi)]
            yield pa.RecordBatch.from_arrays(cells, ["idx", "n", "s", "lo", "hi"])

    return run


def feature_profile(feats: DataFrame, digits: int = 3) -> DataFrame:
    """One row per feature: count, sum, min, max (a whole-table check of the
    flatten and fill rules), in one pass: each task gives one row a feature."""
    # One column, as Spark weighs every column of a batch at every row. The other one is not read: a
    # ``transform`` keeps the projection out of whole-stage code, whose one method would be
    # too long to be compiled.
    cells = F.array(*[F.col(c).cast("double") for c in FEATURE_COLS])
    apart = F.transform(F.array(F.col(FEATURE_COLS[0])), lambda x: x)
    parts = feats.select(cells.alias("cells"), apart.alias("apart")).mapInArrow(
        _totals(len(FEATURE_COLS)), "idx int, n long, s double, lo double, hi double")
    none = feats.sparkSession.range(len(FEATURE_COLS)).select(       # a table without rows has a profile too
        F.col("id").cast("int").alias("idx"), F.lit(0).cast("long").alias("n"),
        *[F.lit(None).cast("double").alias(c) for c in ("s", "lo", "hi")])
    names = F.array(*[F.lit(c) for c in FEATURE_COLS])
    return parts.unionByName(none).groupBy("idx").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).select(
        "idx", F.get(names, F.col("idx")).alias("feature"), "n",
        (F.round("s", digits) + 0.0).alias("total"),
        (F.round("lo", digits) + 0.0).alias("lo"),
        (F.round("hi", digits) + 0.0).alias("hi"))
