"""Weekly demand forecast twelve weeks ahead: features, baseline, boosted trees, accuracy.

A series has one row per week, so windows over one series are bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfline.functions.numbers import ratio
from shelfline.session import shared_root
from shelfline.sources.tables import append_table, exists

HORIZON = 12
SEASON = 52
SERIES = ("country_code", "category")
LAGS = (HORIZON, HORIZON + 1, HORIZON + 2, HORIZON + 3, SEASON)
# Model inputs.
FEATURES = [
    "lag_12",
    "lag_13",
    "lag_14",
    "lag_15",
    "lag_52",
    "roll4_lag12",
    "promo_lag12",
    "temp_clim_c",
    "sin_woy",
    "cos_woy",
    "woy",
    "country_id",
    "category_id",
]


def last_full_week(demand: DataFrame) -> DataFrame:
    """Monday of the last complete week, one row: the newest week may still be open."""
    return demand.agg(F.date_sub(F.max("week_start"), 7).alias("last_week"))


def forecast_frame(demand: DataFrame, last: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """History up to the last complete week plus ``horizon`` empty weeks per series."""
    history = demand.join(F.broadcast(last), F.col("week_start") <= F.col("last_week"))
    ahead = F.sequence(F.date_add("last_week", 7), F.date_add("last_week", 7 * horizon), F.expr("INTERVAL 7 DAYS"))
    series = history.select(*SERIES, "last_week").distinct()
    future = series.withColumn("week_start", F.explode(ahead))
    columns = ["week_start", *SERIES, "volume_t", "promo_line_share", "temp_mean_c", "last_week"]
    return history.select(*columns).unionByName(future, allowMissingColumns=True)


def climatology(history: DataFrame) -> DataFrame:
    """Mean temperature per country and ISO week."""
    exact = F.sum(F.col("temp_mean_c").cast("decimal(14,4)")).cast("double")
    return history.groupBy("country_code", F.weekofyear("week_start").alias("woy")).agg(
        F.try_divide(exact, F.count("temp_mean_c")).alias("temp_clim_c")
    )


def member_codes(df: DataFrame, column: str, name: str) -> DataFrame:
    """Alphabetical codes from 0; the list of members is short."""
    return df.select(column).distinct().withColumn(name, (F.row_number().over(Window.orderBy(column)) - 1).cast("int"))


def features(frame: DataFrame, horizon: int = HORIZON, train_only_climate: bool = False) -> DataFrame:
    """The features known ``horizon`` weeks ahead, and the role of each row (train, test, future).

    Lags count rows of the series.  Rows without a yearly lag or a full rolling mean are dropped.
    ``train_only_climate`` keeps the test weeks out of the climate average."""
    in_order = Window.partitionBy(*SERIES).orderBy("week_start")
    four = in_order.rowsBetween(-(horizon + 3), -horizon)
    lags = {f"lag_{k}": F.lag("volume_t", k).over(in_order) for k in LAGS}
    lags["roll4_lag12"] = F.when(F.count("volume_t").over(four) == 4, F.avg("volume_t").over(four))
    lags["promo_lag12"] = F.lag("promo_line_share", horizon).over(in_order)
    test_start = F.date_sub("last_week", 7 * (horizon - 1))
    week = F.col("week_start")
    role = F.when(week > F.col("last_week"), "future").when(week >= test_start, "test").otherwise("train")
    angle = 2 * F.pi() * F.col("woy") / 52
    past = frame.filter(week < test_start if train_only_climate else week <= F.col("last_week"))
    coded = frame.withColumns(lags | {"woy": F.weekofyear("week_start"), "role": role})
    coded = (
        coded.join(F.broadcast(climatology(past)), ["country_code", "woy"], "left")
        .join(F.broadcast(member_codes(frame, "country_code", "country_id")), "country_code")
        .join(F.broadcast(member_codes(frame, "category", "category_id")), "category")
        .withColumns({"sin_woy": F.sin(angle), "cos_woy": F.cos(angle)})
    )
    complete = coded.filter("lag_52 IS NOT NULL AND roll4_lag12 IS NOT NULL AND (role <> 'train' OR volume_t IS NOT NULL)")
    return complete.select("week_start", *SERIES, "volume_t", *FEATURES, "role")


ROUNDS, STEP, DEPTH, LEAST_ROWS = 400, 0.05, 5, 20
#: A round must lower the validation error by this share, else boosting ends.
GAIN = 1e-4


def _pipeline(rounds: int, seed: int, validation: str | None = None) -> Pipeline:
    numeric = [f for f in FEATURES if f not in ("country_id", "category_id")]
    ending = {"validationIndicatorCol": validation, "validationTol": GAIN} if validation else {}
    trees = GBTRegressor(
        labelCol="volume_t",
        featuresCol="features",
        predictionCol="forecast_t",
        maxIter=rounds,
        maxDepth=DEPTH,
        stepSize=STEP,
        minInstancesPerNode=LEAST_ROWS,
        maxBins=256,
        seed=seed,
        checkpointInterval=10,
        **ending,
    )
    return Pipeline(
        stages=[
            StringIndexer(inputCol="country_code", outputCol="country_idx", stringOrderType="alphabetAsc", handleInvalid="keep"),
            StringIndexer(inputCol="category", outputCol="category_idx", stringOrderType="alphabetAsc", handleInvalid="keep"),
            VectorAssembler(inputCols=[*numeric, "country_idx", "category_idx"], outputCol="features"),
            trees,
        ]
    )


def with_validation(data: DataFrame, weeks: int = HORIZON) -> DataFrame:
    """Training rows, the last ``weeks`` weeks of them marked as validation."""
    rows = _complete(data.filter("role = 'train'"))
    newest = rows.agg(F.max("week_start").alias("_newest"))
    marked = rows.join(F.broadcast(newest)).withColumn("is_validation", F.col("week_start") > F.date_sub("_newest", 7 * weeks))
    return marked.drop("_newest")


def rounds_needed(data: DataFrame, iterations: int = ROUNDS, seed: int = 2026) -> int:
    """Boosting rounds after which the error on the last training weeks no longer falls; at most ``iterations``."""
    rows = with_validation(data)
    if rows.filter("NOT is_validation").isEmpty():
        return iterations
    return _pipeline(iterations, seed, "is_validation").fit(rows).stages[-1].getNumTrees


def train(data: DataFrame, iterations: int = ROUNDS, seed: int = 2026) -> PipelineModel:
    """One boosted-tree model over all series.  A missing promo share or climate value becomes -1, apart
    from every real value; the member codes are treated as categories.

    The number of rounds is found on the last training weeks, up to ``iterations``; the model is then fitted on all of
    them.  Every tenth round is checkpointed to the shared folder, so lineage stays short."""
    data.sparkSession.sparkContext.setCheckpointDir(shared_root(data.sparkSession))
    return _pipeline(rounds_needed(data, iterations, seed), seed).fit(_complete(data.filter("role = 'train'")))


def _complete(data: DataFrame) -> DataFrame:
    return data.fillna(-1.0, subset=["promo_lag12", "temp_clim_c"])


def forecast_weekly(model: PipelineModel, data: DataFrame, version: str) -> DataFrame:
    """Forecast of test and future weeks next to the seasonal naive baseline."""
    scored = model.transform(_complete(data.filter("role <> 'train'")))
    return scored.select(
        "week_start",
        *SERIES,
        F.col("volume_t").alias("actual_t"),
        F.round("forecast_t", 3).alias("forecast_t"),
        F.col("lag_52").alias("baseline_t"),
        (F.col("role") == "future").alias("is_future"),
        F.lit(version).alias("model_version"),
    )


def rolling_mean(data: DataFrame) -> DataFrame:
    """The mean of the four newest weeks known twelve weeks ahead as forecast, next to the seasonal naive baseline."""
    # four amounts of three digits have an exact mean of five, so the last digit does not depend on the engine
    mean = F.round(F.col("roll4_lag12").cast("decimal(24,6)"), 3).cast("double")
    return seasonal_naive(data.withColumn("_mean", mean), "_mean")


def seasonal_naive(data: DataFrame, forecast: str = "lag_52") -> DataFrame:
    """The same week one year earlier as baseline, and as forecast unless another column is."""
    return data.filter("role <> 'train'").select(
        "week_start",
        *SERIES,
        F.col("volume_t").alias("actual_t"),
        F.col(forecast).alias("forecast_t"),
        F.col("lag_52").alias("baseline_t"),
        (F.col("role") == "future").alias("is_future"),
    )


def error_measures(actual: str = "actual_t", forecast: str = "forecast_t") -> dict[str, Column]:
    """Weighted error, mean percentage error and bias in percent."""
    a, f = (F.col(c).cast("decimal(24,3)") for c in (actual, forecast))
    total = F.sum(a).cast("double")
    relative = F.try_divide(F.abs(F.col(actual) - F.col(forecast)), F.col(actual))
    return {
        "wape_pct": F.round(100 * ratio(F.sum(F.abs(a - f)), total), 2),
        "mape_pct": F.round(100 * F.avg(relative), 2),
        "bias_pct": F.round(100 * ratio(F.sum(f - a), total), 2),
    }


def forecast_accuracy(forecast: DataFrame) -> DataFrame:
    """Error measures of the test weeks by category, by country and in total, in one pass."""
    test = forecast.filter(~F.col("is_future"))
    sets = [[F.col("category")], [F.col("country_code")], []]
    measured = test.groupingSets(sets, F.col("category"), F.col("country_code")).agg(
        F.grouping_id().alias("_gid"), *[m.alias(n) for n, m in error_measures().items()]
    )
    level = F.when(F.col("_gid") == 1, "category").when(F.col("_gid") == 2, "country_code").otherwise("total")
    member = F.when(F.col("_gid") == 1, F.col("category")).when(F.col("_gid") == 2, F.col("country_code")).otherwise("all")
    return measured.select(level.alias("level"), member.alias("member"), "wape_pct", "mape_pct", "bias_pct")


def save_model(model: PipelineModel, root: str, metrics: DataFrame, params: Mapping[str, object]) -> int:
    """Store a model under the next version number with its metrics and parameters; returns the version."""
    spark = metrics.sparkSession
    table = f"{root}/metrics"
    newest = spark.read.parquet(table).agg(F.max("version")).first()[0] if exists(spark, table) else 0
    version = newest + 1
    model.write().save(f"{root}/model/version={version}")
    described = metrics.withColumns(
        {
            "version": F.lit(version),
            "params": F.lit(", ".join(f"{k}={v}" for k, v in sorted(params.items()))),
            "saved_at": F.current_timestamp(),
        }
    )
    append_table(described, table)
    return version


def load_model(root: str, version: int) -> PipelineModel:
    return PipelineModel.load(f"{root}/model/version={version}")
