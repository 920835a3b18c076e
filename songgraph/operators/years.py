"""Release-year model: split, train, evaluate, impute, save (ML1-ML6, FLT1-FLT3,
FLT9, SM3, AG8, AG14, JN2, ST2, SC2, SNK2).

Training and scoring use MLlib's ``GBTRegressor`` on a vector that one expression
builds straight from the four record arrays and the scalar inputs (no 313
columns, whose generated code would exceed the JVM's method limit).
The split is by a hash of the song id that other engines have too, so a row lands
on the same side whatever columns the frame carries. Imputation scores rows in place:
every row and every original column is kept, only a missing year is replaced.

A saved model carries a manifest (feature order, settings, digest, training size);
loading checks it, so a model is never fed features in another order.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songgraph.functions.scalar import missing_year, round_year, valid_year
from songgraph.operators.features import FEATURE_COLS, with_vector
from songgraph.operators.graph import seeded_hash
from songgraph.session import materialize, scratch

# The regressor settings of the original training job.
GBT_DEFAULTS = {"maxIter": 150, "maxDepth": 8, "stepSize": 0.05, "seed": 42}
MIN_TRAIN_YEAR = 1970

# What gives the records (with the four arrays) of some songs, for songs that come without
# them: only rows that are fitted or scored need any.
Records = Callable[[DataFrame], DataFrame]


def split_counts(songs: DataFrame) -> DataFrame:
    """FLT9: sizes of the valid and the missing part in one pass."""
    return songs.agg(F.count(F.when(valid_year("year"), 1)).alias("n_valid"),
                     F.count(F.when(missing_year("year"), 1)).alias("n_missing"),
                     F.count(F.lit(1)).alias("n_total"))


def training_rows(songs: DataFrame) -> DataFrame:
    """FLT1 + FLT3: a known year from 1970 on."""
    return songs.where(valid_year("year") & (F.col("year") >= MIN_TRAIN_YEAR))


def hash_split(df: DataFrame, train_pct: int = 80, seed: int = 42,
               key: str = "song_id") -> tuple[DataFrame, DataFrame]:
    """SM3: the first 8 digits of the seeded hash of the key, modulo 100, below
    ``train_pct`` are training; a row without a key is held out."""
    bucket = _bucket(key, seed, 100)
    return df.where(bucket < train_pct), df.where(F.coalesce(bucket >= train_pct, F.lit(True)))


def _bucket(key: str, seed: int, n: int):
    return F.conv(F.substring(seeded_hash(key, seed), 1, 8), 16, 10).cast("long") % n


# Rows of one fitting partition: boosting runs some 1,400 short jobs over the cached
# vectors, and in each a partition sends the histograms of all open nodes (up to 30 MB), so
# there are no more partitions than tasks run at once, unless they would hold over FIT_MOST
# rows (some 60 MB in the cache, which keeps or drops a partition as a whole).
FIT_PARTITION, FIT_MOST = 5_000, 50_000


def fitting_rows(songs: DataFrame, limit: int | None = None, records: Records | None = None) -> DataFrame:
    """ML1: (song_id, year, features) of the training part, written: all of its rows, or,
    for a caller who asks for a trial fit, about ``limit`` of them by a hash."""
    train_part, _ = hash_split(training_rows(songs))
    if limit is not None:
        share = int(min(1.0, limit / max(1, train_part.count())) * (1 << 20))
        train_part = train_part.where(_bucket("song_id", 7, 1 << 20) < share)
    with scratch(songs.sparkSession) as own:
        if records is not None:         # written: their number tells how to join the segments
            train_part = records(materialize(train_part, "fitting-songs"))
        return own.keep(with_vector(train_part).select("song_id", F.col("year").cast("double").alias("year"), "features"),
                        "fitting-rows")


def fitting_partitions(rows: int, slots: int) -> int:
    return max(1, min(-(-rows // FIT_PARTITION), max(slots, -(-rows // FIT_MOST))))


def train(songs: DataFrame, fit_rows: int | None = None, records: Records | None = None, **gbt) -> GBTRegressionModel:
    """ML1-ML3: fit on the training part of the valid rows, all of it unless a trial fit
    asks for about ``fit_rows``.
    Row lineage is cut by the written vectors, the boosting lineage every ten trees by a
    checkpoint in the shared folder."""
    params = {**GBT_DEFAULTS, "checkpointInterval": 10, "cacheNodeIds": True, **gbt}
    with scratch(songs.sparkSession):
        rows = fitting_rows(songs, fit_rows, records)
        parts = fitting_partitions(rows.count(), songs.sparkSession.sparkContext.defaultParallelism)
        return GBTRegressor(featuresCol="features", labelCol="year", **params).fit(
            rows.select("year", "features").coalesce(parts))


def _manifest(model: GBTRegressionModel) -> dict[str, str]:
    settings = {p: str(model.getOrDefault(p)) for p in ("maxIter", "maxDepth", "stepSize", "seed", "maxBins")}
    trees = hashlib.sha256(model.toDebugString.encode()).hexdigest()
    return {"features": json.dumps(FEATURE_COLS), "settings": json.dumps(settings, sort_keys=True),
            "n_features": str(model.numFeatures), "n_trees": str(model.getNumTrees), "trees_sha256": trees}


def save_model(model: GBTRegressionModel, path: str) -> None:
    """SNK2: the model, then its manifest, written last: a folder without one is not a
    finished model."""
    spark = SparkSession.getActiveSession()
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(k, v) for k, v in _manifest(model).items()], "name string, value string") \
        .coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def load_model(path: str) -> GBTRegressionModel:
    """SNK2: a saved model whose manifest agrees with it and with this feature order."""
    spark = SparkSession.getActiveSession()
    said = {r["name"]: r["value"] for r in spark.read.schema("name string, value string").json(f"{path}/manifest").collect()}
    model = GBTRegressionModel.load(f"{path}/model")
    found = _manifest(model) | {"features": json.dumps(FEATURE_COLS)}
    wrong = sorted(k for k in found if said.get(k) != found[k])
    if wrong:
        raise ValueError(f"the model at {path} does not match its manifest: {', '.join(wrong)}")
    return model


def metrics(pred: DataFrame, label: str = "year", prediction: str = "prediction") -> DataFrame:
    """AG14: RMSE, R2 and MAE as plain aggregates (one pass)."""
    y = F.col(label).cast("double")
    e = F.col(prediction).cast("double") - y
    n = F.count(F.lit(1))
    return pred.agg(
        n.alias("n"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.lit(1.0) - F.sum(e * e) / (F.sum(y * y) - F.sum(y) * F.sum(y) / n)).alias("r2"),
        F.avg(F.abs(e)).alias("mae"))


def held_out(songs: DataFrame) -> DataFrame:
    """The valid rows that no fit reads."""
    return hash_split(training_rows(songs))[1]


def evaluate(model: GBTRegressionModel, songs: DataFrame, records: Records | None = None) -> DataFrame:
    """ML6: score the held-out part with the same features as training."""
    rows = held_out(songs)
    rows = rows if records is None else records(rows)
    return metrics(model.transform(with_vector(rows).select("year", "features")))


def impute(songs: DataFrame, model: GBTRegressionModel, records: Records | None = None) -> DataFrame:
    """ML4 + ML5, the default: missing years (null or 0) get the rounded
    prediction; every row and every original column is kept. Only the missing
    rows are scored, and ``transform`` carries their columns along, so no
    join back is needed (a duplicate or null song id is harmless). Features
    are filled first, so no row is invalid; a prediction that does
    not fit an int leaves the year as it was."""
    cols = [F.col(f"`{c}`") for c in songs.columns if c != "year"]
    valid = songs.where(valid_year("year"))
    missing = songs.where(missing_year("year"))
    scored = model.transform(with_vector(missing if records is None else records(missing)))
    fixed = scored.select(*cols, F.coalesce(round_year(F.col("prediction")), F.col("year")).alias("year"))
    return valid.unionByName(fixed.select(*songs.columns))


def merge_predictions(songs: DataFrame, predictions: DataFrame) -> DataFrame:
    """ML5 as the original merges: one prediction per song id (AG8), rounded
    (SC2), inner-joined back to the missing rows (JN2), renamed (PRJ2/PRJ3),
    unioned by name with the valid rows (ST2). A missing row with a null
    song id has no partner and is lost, as in the original."""
    valid = songs.where(valid_year("year"))
    missing = songs.where(missing_year("year"))
    one = (predictions.groupBy("song_id")
                      .agg(F.min("year_predicted").alias("year_predicted"))
                      .withColumn("year_predicted", round_year(F.col("year_predicted"))))
    fixed = (one.join(missing, "song_id", "inner")
                .drop("year").withColumnRenamed("year_predicted", "year"))
    return valid.unionByName(fixed.select(*songs.columns))


def artist_mean_predictions(songs: DataFrame) -> DataFrame:
    """A transparent baseline model: the mean valid year of the song's artist
    (``year_predicted`` for every song whose artist has one)."""
    means = (songs.where(valid_year("year")).groupBy("artist_id")
                  .agg(F.avg("year").alias("year_predicted")))
    return songs.select("song_id", "artist_id").join(means, "artist_id").drop("artist_id")
