"""Feature and release-year queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from songgraph.functions.scalar import missing_year
from songgraph.operators import features as FT
from songgraph.operators import segments as SG
from songgraph.operators import years as Y
from songgraph.plans.base import cte, register
from songgraph.plans.segment_queries import _SQL_AGG, _cov
from songgraph.schema import N_DIMS, SCALAR_FEATURES, STAT_NAMES
from songgraph.session import new_folder, scratch
from songgraph.sources import adapters as A

# Saved models by application and data folder: one training job, then evaluation and
# imputation jobs that load its model, as separate jobs share a model store.
_SAVED: dict[tuple[str, str], str] = {}


def saved_model(spark, sf_dir) -> str:
    """ML1-ML3 SNK2: where the year model of these songs is saved; trained with the
    original settings (150 trees of depth 8) the first time it is asked for."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _SAVED:
        path = new_folder(spark, "year-model")
        Y.save_model(Y.train(A.songs(spark, sf_dir), records=records(spark, sf_dir)), path)
        _SAVED[at] = path
    return _SAVED[at]


def _records_sql() -> str:
    def stats(src):
        return ", ".join(_SQL_AGG[s].format(x=f"coalesce({src}{i}, 0.0)")
                         for i in range(N_DIMS) for s in STAT_NAMES)

    def covs(src):
        return ", ".join(_cov(i, j).replace(f"x{i}", f"{src}{i}").replace(f"x{j}", f"{src}{j}")
                         for i, j in SG.PAIRS)
    pcols = ", ".join(f"x{i} % 12.0 AS p{i}" for i in range(N_DIMS))
    z72 = "[" + ", ".join(["0.0"] * 72) + "]"
    z78 = "[" + ", ".join(["0.0"] * 78) + "]"
    return cte(songs=A.SQL_SONGS, segs0=A.sql_segments("timbre")) + f""",
segs AS (SELECT *, {pcols} FROM segs0),
wide AS (SELECT song_id, [{stats('x')}] AS st, [{covs('x')}] AS ct,
                [{stats('p')}] AS sp, [{covs('p')}] AS cp FROM segs GROUP BY song_id),
rec AS (SELECT s.*, coalesce(w.st, {z72}) AS segments_timbre, coalesce(w.ct, {z78}) AS timbre_cov,
               coalesce(w.sp, {z72}) AS segments_pitches, coalesce(w.cp, {z78}) AS pitch_cov
        FROM songs s LEFT JOIN wide w ON s.song_id = w.song_id)
"""


def _f(x: str) -> str:
    return f"(CASE WHEN isnan(CAST({x} AS DOUBLE)) THEN 0.0 ELSE coalesce(CAST({x} AS DOUBLE), 0.0) END)"


def _feature_exprs() -> list[str]:
    out = []
    for arr, _ in FT.STAT_ARRAYS:
        for d in range(N_DIMS):
            for k in range(len(STAT_NAMES)):
                out.append(_f(f"{arr}[{d * 6 + k + 1}]"))
    for arr, _ in FT.COV_ARRAYS:
        for i in range(78):
            out.append(_f(f"{arr}[{i + 1}]"))
    for c in SCALAR_FEATURES:
        out.append(_f(f'"{c}"'))
    out.append(_f("ln(duration + 0.001)"))
    out.append(_f("tempo / 200.0"))
    return out


def _profile_sql() -> str:
    items = ", ".join(f"{{'idx': {k}, 'feature': '{name}', 'v': {e}}}"
                      for k, (name, e) in enumerate(zip(FT.FEATURE_COLS, _feature_exprs())))
    return _records_sql() + f""",
cells AS (SELECT unnest([{items}]) AS r FROM rec)
SELECT CAST(r.idx AS INTEGER) AS idx, r.feature AS feature, count(*) AS n,
       round(sum(r.v), 3) + 0.0 AS total, round(min(r.v), 3) + 0.0 AS lo,
       round(max(r.v), 3) + 0.0 AS hi
FROM cells GROUP BY r.idx, r.feature
"""


@register("feature_profile", _profile_sql())
def q_feature_profile(spark, sf_dir):
    """PRJ4 PRJ5 PRJ6 PRJ7 SC1 SC5 SC7 ML1-input: the 313 model features of
    every song (flattened in one select, null/NaN filled), profiled"""
    return FT.feature_profile(FT.flatten(FT.song_records(spark, sf_dir), keep=["song_id"]))


@register("valid_missing_split", cte(tracks=A.SQL_TRACKS) + """
SELECT count(CASE WHEN "year" IS NOT NULL AND "year" <> 0 THEN 1 END) AS n_valid,
       count(CASE WHEN "year" IS NULL OR "year" = 0 THEN 1 END) AS n_missing,
       count(*) AS n_total
FROM tracks""")
def q_valid_missing_split(spark, sf_dir):
    """FLT1 FLT2 FLT9 AG1"""
    return Y.split_counts(A.tracks(spark, sf_dir))


_MEANS = """,
means AS (SELECT artist_id, avg("year") AS m FROM tracks
          WHERE "year" IS NOT NULL AND "year" <> 0 GROUP BY artist_id)
"""


@register("impute_merge", cte(tracks=A.SQL_TRACKS) + _MEANS + """
SELECT song_id, "year" FROM tracks WHERE "year" IS NOT NULL AND "year" <> 0
UNION ALL
SELECT t.song_id, CAST(round(m.m) AS INTEGER) AS "year"
FROM tracks t JOIN means m ON t.artist_id = m.artist_id
WHERE t."year" IS NULL OR t."year" = 0""")
def q_impute_merge(spark, sf_dir):
    """ML5 as merged by the original: AG8 SC2 JN2 PRJ2 PRJ3 ST2 FLT9; the
    prediction is the artist's mean valid year"""
    t = A.tracks(spark, sf_dir)
    merged = Y.merge_predictions(t, Y.artist_mean_predictions(t))
    return merged.select("song_id", "year")


@register("regression_metrics", cte(tracks=A.SQL_TRACKS) + _MEANS + """,
p AS (SELECT CAST(t."year" AS DOUBLE) AS y, m.m AS yhat FROM tracks t
      JOIN means m ON t.artist_id = m.artist_id
      WHERE t."year" IS NOT NULL AND t."year" <> 0 AND t."year" >= 1970)
SELECT count(*) AS n,
       round(sqrt(avg((yhat - y) * (yhat - y))), 6) + 0.0 AS rmse,
       round(1.0 - sum((yhat - y) * (yhat - y)) / (sum(y * y) - sum(y) * sum(y) / count(*)), 6)
         + 0.0 AS r2,
       round(avg(abs(yhat - y)), 6) + 0.0 AS mae
FROM p""")
def q_regression_metrics(spark, sf_dir):
    """AG14 FLT1 FLT3: RMSE, R2, MAE of the artist-mean model on the
    training rows"""
    t = A.tracks(spark, sf_dir)
    rows = Y.training_rows(t).join(Y.artist_mean_predictions(t), "song_id")
    m = Y.metrics(rows, "year", "year_predicted")
    return m.select("n", *[(F.round(c, 6) + 0.0).alias(c) for c in ("rmse", "r2", "mae")])


_BUCKET = "CAST('0x' || substr(md5(CAST(song_id AS VARCHAR) || '-42'), 1, 8) AS BIGINT) % 100"


@register("split_years", cte(tracks=A.SQL_TRACKS) + f"""
SELECT CASE WHEN {_BUCKET} < 80 THEN 'train' ELSE 'test' END AS part, count(*) AS n,
       min("year") AS first_year, max("year") AS last_year, sum(song_id) AS id_sum
FROM tracks WHERE "year" IS NOT NULL AND "year" <> 0 AND "year" >= 1970 GROUP BY 1""")
def q_split_years(spark, sf_dir):
    """SM3 FLT1 FLT3: the training and the held-out rows of the year model"""
    parts = Y.hash_split(Y.training_rows(A.tracks(spark, sf_dir)))
    both = [p.select(F.lit(name).alias("part"), "song_id", "year") for p, name in zip(parts, ("train", "test"))]
    return both[0].unionByName(both[1]).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.sum("song_id").alias("id_sum"))


def records(spark, sf_dir):
    """The records of some songs: arrays are made for rows that are fitted or scored, and
    handed to the model as they come."""
    return lambda songs: FT.song_records(spark, sf_dir, songs)


@register("impute_years", cte(songs=A.SQL_SONGS) + """
SELECT song_id, artist_id, "year" IS NULL OR "year" = 0 AS was_missing,
       CASE WHEN "year" <> 0 THEN "year" END AS known_year, TRUE AS plausible
FROM songs""")
def q_impute_years(spark, sf_dir):
    """ML1-ML5 SM3 SC2 SNK2: the saved GBT year model (150 trees of depth 8) loaded and
    every missing year imputed in place. All rows are kept, known years are as they
    were, every imputed one is at most a year from the one that the loudness tells"""
    with scratch(spark) as own:
        songs = A.songs(spark, sf_dir)
        out = Y.impute(songs, Y.load_model(saved_model(spark, sf_dir)), records(spark, sf_dir))
        before = songs.select("song_id", missing_year("year").alias("was_missing"))
        told = 2000 + F.ceil(F.col("loudness") / 7)
        return own.keep(out.join(before.hint("merge"), "song_id").select(
            "song_id", "artist_id", "was_missing", F.when(~F.col("was_missing"), F.col("year")).alias("known_year"),
            F.coalesce(~F.col("was_missing") | (F.abs(F.col("year") - told) <= 1), F.lit(False)).alias("plausible")),
            "imputed")


@register("evaluate_years", cte(tracks=A.SQL_TRACKS) + f"""
SELECT count(*) AS n, TRUE AS beats_mean, TRUE AS within_a_year FROM tracks
WHERE "year" IS NOT NULL AND "year" <> 0 AND "year" >= 1970 AND {_BUCKET} >= 80""")
def q_evaluate_years(spark, sf_dir):
    """ML6 SM3 AG14: the saved model scored on the held-out 20%: how many rows, whether
    its RMSE beats that of the held-out mean, whether it is below one year"""
    with scratch(spark) as own:
        got = Y.evaluate(Y.load_model(saved_model(spark, sf_dir)), A.songs(spark, sf_dir), records(spark, sf_dir))
        return own.keep(got.select("n", (F.col("r2") > 0).alias("beats_mean"), (F.col("rmse") < 1).alias("within_a_year")),
                        "metrics")


@register("model_roundtrip", cte(songs=A.SQL_SONGS) + """
SELECT song_id, TRUE AS same FROM songs WHERE "year" IS NULL OR "year" = 0""")
def q_model_roundtrip(spark, sf_dir):
    """SNK2 ML4: a model saved, loaded with its manifest checked, saved again and loaded
    again predicts the same year for every song without one"""
    with scratch(spark) as own:
        first = Y.load_model(saved_model(spark, sf_dir))
        again = own.folder("model-copy")
        Y.save_model(first, again)
        missing = A.songs(spark, sf_dir).where(missing_year("year"))
        rows = FT.with_vector(records(spark, sf_dir)(missing)).select("song_id", "features")
        both = Y.load_model(again).setPredictionCol("again").transform(first.transform(rows))
        return own.keep(both.select("song_id", (F.col("prediction") == F.col("again")).alias("same")), "same")
