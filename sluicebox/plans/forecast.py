"""Demand forecast: features, split, model and future rows, all as DataFrames.

Lags and rolling means count rows (days with sales), not calendar days. Two properties are kept on purpose:
the same day's revenue is a feature, and gaps at the start of a series fall back to the mean of the whole
series, later days included.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime, timedelta, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from sluicebox.functions.dates import calendar
from sluicebox.functions.numbers import times_parts
from sluicebox.operators.keys import with_position
from sluicebox.operators.series import block_window, over_series
from sluicebox.plans.gold import product_days
from sluicebox.sources.storage import (
    Staging,
    child_names,
    ensure_checkpoint_folder,
    path_exists,
    read_small_text,
    read_tables,
    staging,
    write_small_text,
)

# Feature order, target and model settings.
FEATURES = (
    "product_id", "category_id", "day_of_week", "month", "week_of_year",
    "lag_1", "lag_7", "rolling_mean_7", "rolling_mean_30", "revenue",
)
TARGET = "units_sold"
TREES, LEAF_ROWS, SEED = 120, 1, 42
TEST_DAYS, HORIZON_DAYS = 14, 7
# Spark allows 30 levels; each level more can double a tree, and all trees are held by every executor and the driver.
MAX_DEPTH = 10
MAX_BINS = 32
# Trees grown together. A cached training row holds a weight and a node for each of them.
GROUP_TREES = 20
# Rows before the current one that features look at, and rows of a series that one task may sort.
HALO, SERIES_ROWS = 30, 1_000_000

# Training rows in this order fall into the same few nodes of a tree one after another, and those stay in the CPU's cache. Revenue
# decides most splits; the others keep rows of equal revenue from meeting in one task.
_ALIKE = ("revenue", "rolling_mean_30", "rolling_mean_7", "lag_1", "product_id")

PREDICTION_COLUMNS = (
    "sales_date", "product_id", "category_id", "predicted_units_sold",
    "lag_1", "rolling_mean_7", "rolling_mean_30",
)


def daily_product_sales(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Units and revenue per (day, product, category), from the product-day sums.

    A product listed twice under one category counts twice, as if joined first. Listings are counted before the join, so the joined
    rows are the result: summing them again would hold every row of a task in two more hash maps.
    """
    categories = products.groupBy("product_id", "category_id").agg(F.count(F.lit(1)).alias("_listed"))
    times = F.coalesce("_listed", F.lit(1))
    return (
        product_days(orders, items)
        .join(categories, "product_id", "left")
        .select(
            "sales_date",
            "product_id",
            "category_id",
            (F.col("units") * times).cast("double").alias("units_sold"),
            times_parts("net", times).rounded().alias("revenue"),
        )
    )


_SERIES_KEY, _SERIES_ORDER = ("product_id",), ("sales_date", "category_id")


def _in_series() -> WindowSpec:
    return Window.partitionBy(*_SERIES_KEY).orderBy(*_SERIES_ORDER)


def lag_of(name: str, rows: int, series: WindowSpec | None = None) -> Column:
    return F.lag(name, rows).over(series or _in_series())


def rolling_mean(name: str, rows: int, series: WindowSpec | None = None) -> Column:
    """Mean of up to ``rows`` rows before the current one."""
    return F.avg(name).over((series or _in_series()).rowsBetween(-rows, -1))


def or_series_mean(value: Column, name: str) -> Column:
    return F.coalesce(value, F.avg(name).over(Window.partitionBy(*_SERIES_KEY)), F.lit(0.0))


def _looking_back(series: WindowSpec) -> dict[str, Column]:
    return {
        "lag_1": lag_of("units_sold", 1, series),
        "lag_7": lag_of("units_sold", 7, series),
        "rolling_mean_7": rolling_mean("units_sold", 7, series),
        "rolling_mean_30": rolling_mean("units_sold", HALO, series),
    }


def add_features(daily: DataFrame, block_rows: int | None = None) -> DataFrame:
    """Calendar, lag and rolling features.

    Without ``block_rows`` all windows share one shuffle by product, and one sort; each series is sorted in one task. With it,
    series are cut into blocks of so many rows, each with the 30 rows before it, and the mean of a series is summed on the map
    side: a series may then hold any share of all rows.
    """
    units = daily.withColumn("units_sold", F.col("units_sold").cast("double"))
    if block_rows is None:
        raw = _looking_back(_in_series())
        filled = {name: or_series_mean(value, "units_sold") for name, value in raw.items()}
    else:
        # dealt anew, so that both sides of the join are shuffled for it and Spark can split a long series there
        means = units.groupBy(*_SERIES_KEY).agg(F.avg("units_sold").alias("_mean")).hint("rebalance")
        units = over_series(units, _SERIES_KEY, _SERIES_ORDER, _looking_back(block_window(_SERIES_KEY)), block_rows, HALO)
        known, hot = units.alias("u"), means.alias("m")
        units = known.join(hot, F.col("u.product_id").eqNullSafe(F.col("m.product_id")), "left").select("u.*", "m._mean")
        filled = {name: F.coalesce(name, "_mean", F.lit(0.0)) for name in _looking_back(_in_series())}
    return units.select(
        "sales_date",
        "product_id",
        F.coalesce("category_id", F.lit(0)).cast("bigint").alias("category_id"),
        "units_sold",
        F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue"),
        *[part.alias(name) for name, part in calendar("sales_date").items()],
        *[value.alias(name) for name, value in filled.items()],
    )


def features_of_stored(daily: DataFrame) -> DataFrame:
    """Features of a stored table of daily sales: in blocks if any series is longer than ``SERIES_ROWS``."""
    longest = daily.groupBy(*_SERIES_KEY).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    return add_features(daily, SERIES_ROWS if (longest or 0) > SERIES_ROWS else None)


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def sales_from_silver(spark: SparkSession, silver_root: str, fmt: str = "parquet") -> DataFrame:
    silver = read_tables(spark, silver_root, ("orders", "order_items", "products"), fmt)
    return daily_product_sales(silver["orders"], silver["order_items"], silver["products"])


def features_from_silver(spark: SparkSession, silver_root: str, fmt: str = "parquet") -> DataFrame:
    return add_features(sales_from_silver(spark, silver_root, fmt))


def stored_features(spark: SparkSession, stage: Staging, silver_root: str, fmt: str = "parquet") -> DataFrame:
    """Sales and features written once, before anything is asked of them: the joins behind them run a single time."""
    daily = stage.store(sales_from_silver(spark, silver_root, fmt), "daily-sales")
    features = stage.store(features_of_stored(daily), "features")
    return require_rows(features, "There are no sales to build features from.")


def time_split(features: DataFrame, test_days: int = TEST_DAYS) -> tuple[DataFrame, DataFrame]:
    """(train, test): the last ``test_days`` days are the test set.

    If that leaves a side empty, the first 80 % of rows in date order train. Their positions are found
    without gathering the rows in one task.
    """
    first, last = features.agg(F.min("sales_date"), F.max("sales_date")).first()
    if first is None:
        raise ValueError("There are no feature rows to split.")
    cutoff = last - timedelta(days=test_days)
    if first <= cutoff < last:
        early = F.col("sales_date") <= F.lit(cutoff)
        return features.filter(early), features.filter(~early)
    ensure_checkpoint_folder(features.sparkSession)
    placed = with_position(features, ["sales_date", "product_id", "category_id"])
    rows = placed.count()
    if rows < 2:
        raise ValueError("Not enough rows for a train and a test set.")
    boundary = max(1, rows * 8 // 10)
    train, test = placed.filter(F.col("position") < boundary), placed.filter(F.col("position") >= boundary)
    return train.drop("position"), test.drop("position")


def feature_vector(df: DataFrame) -> DataFrame:
    return assembler().transform(df)


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="raw_features")


def scaler() -> StandardScaler:
    return StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)


def _grown(rows: DataFrame, trees: int, seed: int, prediction: str, max_depth: int, max_bins: int) -> RandomForestRegressionModel:
    return RandomForestRegressor(
        featuresCol="features",
        labelCol=TARGET,
        predictionCol=prediction,
        numTrees=trees,
        maxDepth=max_depth,
        maxBins=max_bins,
        featureSubsetStrategy="all",
        minInstancesPerNode=LEAF_ROWS,
        cacheNodeIds=True,
        seed=seed,
    ).fit(rows)


def _mean_of_groups(sizes: Mapping[str, int]) -> SQLTransformer:
    """The mean over all trees, from the means of groups of trees."""
    total = " + ".join(f"{size} * {name}" for name, size in sizes.items())
    return SQLTransformer(
        statement=f"SELECT * EXCEPT ({', '.join(sizes)}), ({total}) / {sum(sizes.values())} AS prediction FROM __THIS__"
    )


def fit(
    train: DataFrame, trees: int = TREES, max_depth: int = MAX_DEPTH, max_bins: int = MAX_BINS, group_trees: int = GROUP_TREES
) -> PipelineModel:
    """Scaled random forest; every split may use every feature.

    Each level starts from the nodes the level before has found for the rows, and not from the root. Trees grow in groups, so
    that what a cached row holds does not follow the number of trees; every group draws its own rows. The scaled rows are stored
    once for all groups, in the order of ``_ALIKE``.
    """
    spark = train.sparkSession
    ensure_checkpoint_folder(spark)
    prepared = Pipeline(stages=[assembler(), scaler()]).fit(train)
    sizes = [min(group_trees, trees - first) for first in range(0, trees, group_trees)]
    names = [f"_prediction_{k}" for k in range(len(sizes))] if len(sizes) > 1 else ["prediction"]
    with staging(spark, "fit") as stage:
        ordered = train.repartitionByRange(*_ALIKE).sortWithinPartitions(*_ALIKE)
        rows = stage.store(prepared.transform(ordered).select("features", TARGET), "rows")
        forests = [_grown(rows, size, SEED + k, name, max_depth, max_bins) for k, (size, name) in enumerate(zip(sizes, names))]
    mean = [_mean_of_groups(dict(zip(names, sizes)))] if len(sizes) > 1 else []
    return PipelineModel(stages=[*prepared.stages, *forests, *mean])


def evaluate(predicted: DataFrame, label: str = TARGET, prediction: str = "prediction") -> DataFrame:
    """One row: mae, rmse, r2. r2 is 0 for a single row, and for a constant label unless the fit is perfect."""
    error = F.col(label) - F.col(prediction)
    sums = predicted.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(label).alias("spread"),
    )
    return sums.selectExpr(
        "mae",
        "sqrt(mse) AS rmse",
        "CASE WHEN n <= 1 THEN 0.0D WHEN spread > 0 THEN 1 - mse / spread "
        "WHEN mse = 0 THEN 1.0D ELSE 0.0D END AS r2",
    )


def train_and_evaluate(features: DataFrame, test_days: int = TEST_DAYS, **settings: int) -> tuple[PipelineModel, dict]:
    """Fit on the early days, score on the late ones. Features are computed once and kept while training."""
    features = features.persist()
    try:
        train, test = time_split(features, test_days)
        model = fit(train, **settings)
        metrics = evaluate(model.transform(test)).first().asDict()
        metrics |= {
            "train_rows": train.count(),
            "test_rows": test.count(),
            "max_sales_date": str(features.agg(F.max("sales_date")).first()[0]),
        }
    finally:
        features.unpersist()
    return model, metrics


def latest_category(history: DataFrame) -> DataFrame:
    return history.groupBy("product_id").agg(
        F.max_by("category_id", F.struct("sales_date", "category_id")).alias("category_id")
    )


def history_tail(history: DataFrame, rows: int = 30) -> DataFrame:
    """Per product: its last units (up to 30) and revenues (up to 7), oldest first, and its last category.

    Rows are cut to the last 30 per product before they are shuffled and gathered.
    """
    newest = Window.partitionBy("product_id").orderBy(F.desc("sales_date"), F.desc("category_id"))
    last = F.array_sort(F.collect_list(F.struct("sales_date", "category_id", "units_sold", "revenue")))
    return (
        history.select("sales_date", "product_id", "category_id", "units_sold", "revenue")
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= rows)
        .groupBy("product_id")
        .agg(last.alias("rows"))
        .select(
            "product_id",
            F.element_at("rows", -1)["category_id"].alias("category_id"),
            F.col("rows.units_sold").alias("units"),
            F.slice(F.col("rows.revenue"), F.greatest(F.size("rows") - 6, F.lit(1)), 7).alias("revenues"),
        )
    )


def _tail(values: Column, rows: int) -> Column:
    return F.slice(values, F.greatest(F.size(values) - rows + 1, F.lit(1)), rows)


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v) / F.size(values)


def future_features(history: DataFrame, horizon_days: int = HORIZON_DAYS) -> DataFrame:
    """One row per product and future day, counted from the last day of the whole history.

    Unknown future units count as 0 in later days' lags and means. Future revenue is recursive: each day is
    the mean of the seven values before it, earlier future days included.
    """
    last_day = history.select(F.max("sales_date")).scalar()
    next_revenue = lambda so_far, _: F.concat(so_far, F.array(_mean(_tail(so_far, 7))))
    ahead = F.sequence(F.lit(1), F.lit(horizon_days))
    tails = (
        history_tail(history)
        .withColumn("path", F.aggregate(ahead, F.col("revenues").cast("array<double>"), next_revenue))
        .select("product_id", "category_id", "units", "revenues", "path", F.explode(ahead).alias("day"))
        .withColumn("seen", F.concat("units", F.array_repeat(F.lit(0.0), F.col("day") - 1)))
    )
    seen = F.col("seen")
    return tails.select(
        F.date_add(last_day, F.col("day")).alias("sales_date"),
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("category_id").cast("bigint").alias("category_id"),
        F.lit(0.0).alias("units_sold"),
        F.element_at("path", F.size("revenues") + F.col("day")).alias("revenue"),
        F.element_at(seen, -1).alias("lag_1"),
        F.coalesce(F.try_element_at(seen, F.lit(-7)), _mean(seen)).alias("lag_7"),
        _mean(_tail(seen, 7)).alias("rolling_mean_7"),
        _mean(_tail(seen, 30)).alias("rolling_mean_30"),
    ).withColumns(calendar("sales_date"))


def with_forecast(history: DataFrame, future: DataFrame) -> DataFrame:
    """History followed by forecast rows, on the five series columns."""
    columns = ["sales_date", "product_id", "category_id", "units_sold", "revenue"]
    return history.select(*columns).unionByName(future.select(*columns))


def predict(model: PipelineModel, history: DataFrame, horizon_days: int = HORIZON_DAYS) -> DataFrame:
    """Forecast rows, never below zero."""
    scored = model.transform(future_features(history, horizon_days))
    return scored.withColumn("predicted_units_sold", F.greatest("prediction", F.lit(0.0))).select(*PREDICTION_COLUMNS)


def present_predictions(predictions: DataFrame) -> DataFrame:
    return predictions.orderBy("sales_date", "product_id")


def forecast_for_product(predictions: DataFrame, product_id: int) -> DataFrame:
    return predictions.filter(F.col("product_id") == product_id).orderBy("sales_date")


def forecast_products(predictions: DataFrame) -> DataFrame:
    return predictions.select("product_id").distinct().orderBy("product_id")


def new_version() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")


class ModelStore:
    """Versioned artifacts under one folder, with a small text file naming the latest of each kind."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _mark(self, kind: str, version: str) -> None:
        write_small_text(self.spark, f"{self.root}/{kind}/latest.txt", version)

    def latest(self, kind: str = "model") -> str:
        pointer = f"{self.root}/{kind}/latest.txt"
        if not path_exists(self.spark, pointer):
            raise FileNotFoundError(f"No {kind} has been stored under {self.root}.")
        return read_small_text(self.spark, pointer).strip()

    def save_model(self, model: PipelineModel, metrics: dict, version: str | None = None) -> str:
        version = version or new_version()
        model.write().overwrite().save(f"{self.root}/model/{version}")
        details = {
            "version": version, "features": FEATURES, "target": TARGET,
            "trained_at": datetime.now(timezone.utc).isoformat(), **metrics,
        }
        write_small_text(self.spark, f"{self.root}/metrics/{version}.json", json.dumps(details, default=str, indent=2))
        self._mark("model", version)
        return version

    def load_model(self, version: str | None = None) -> PipelineModel:
        return PipelineModel.load(f"{self.root}/model/{version or self.latest()}")

    def metrics(self, version: str | None = None) -> dict:
        return json.loads(read_small_text(self.spark, f"{self.root}/metrics/{version or self.latest()}.json"))

    def versions(self) -> list[str]:
        return sorted(name for name in child_names(self.spark, f"{self.root}/model") if name != "latest.txt")

    def save_table(self, df: DataFrame, kind: str, version: str | None = None, fmt: str = "csv") -> str:
        """Features or predictions, written once per version; the latest copy is the one pointed to."""
        version = version or new_version()
        df.write.mode("overwrite").option("header", "true").format(fmt).save(f"{self.root}/{kind}/{version}")
        self._mark(kind, version)
        return version

    def load_table(self, kind: str, ddl: str, version: str | None = None, fmt: str = "csv") -> DataFrame:
        path = f"{self.root}/{kind}/{version or self.latest(kind)}"
        return self.spark.read.schema(ddl).option("header", "true").format(fmt).load(path)


def train_from_silver(
    spark: SparkSession,
    silver_root: str,
    store: ModelStore,
    test_days: int = TEST_DAYS,
    fmt: str = "parquet",
    **settings: int,
) -> dict:
    """Train on stored features: the many passes over them start from a table, not from the joins behind it."""
    with staging(spark, "train") as stage:
        features = stored_features(spark, stage, silver_root, fmt)
        model, metrics = train_and_evaluate(features, test_days, **settings)
        version = store.save_model(model, metrics)
    return {"version": version, **metrics}


def predict_from_silver(
    spark: SparkSession,
    silver_root: str,
    store: ModelStore,
    horizon_days: int = HORIZON_DAYS,
    fmt: str = "parquet",
) -> str:
    with staging(spark, "predict") as stage:
        features = stored_features(spark, stage, silver_root, fmt)
        return store.save_table(predict(store.load_model(), features, horizon_days), "predictions")
