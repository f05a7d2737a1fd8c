import json
from datetime import date, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from sluicebox.plans import forecast

FIRST = date(2026, 7, 1)


def daily(spark, units, product=1, category=2, revenue=10.0, start=FIRST, step=1):
    rows = [(start + timedelta(days=i * step), product, category, float(u), revenue) for i, u in enumerate(units)]
    return spark.createDataFrame(
        rows, "sales_date date, product_id bigint, category_id bigint, units_sold double, revenue double"
    )


def in_order(df):
    return df.orderBy("product_id", "sales_date").collect()


def test_lags_and_rolling_means(spark):
    rows = in_order(forecast.add_features(daily(spark, range(1, 9))))
    assert set(forecast.FEATURES) <= set(rows[0].asDict())
    assert rows[1].lag_1 == 1 and rows[7].lag_7 == 1
    assert [r.rolling_mean_7 for r in rows[:3]] == [4.5, 1.0, 1.5]  # the first falls back to the series mean
    assert rows[7].rolling_mean_7 == 4.0 and rows[7].rolling_mean_30 == 4.0
    assert (rows[0].day_of_week, rows[0].month, rows[0].week_of_year) == (2, 7, 27)


def test_lags_count_rows_not_days(spark):
    rows = in_order(forecast.add_features(daily(spark, [5, 6], step=9)))
    assert rows[1].lag_1 == 5


def test_missing_category_and_revenue_become_zero(spark):
    row = forecast.add_features(daily(spark, [1], category=None, revenue=None)).first()
    assert (row.category_id, row.revenue) == (0, 0.0)


def test_no_sales_is_an_error(spark, folder):
    with pytest.raises(ValueError):
        forecast.require_rows(daily(spark, [1]).limit(0), "none")
    with pytest.raises(ValueError):
        forecast.time_split(forecast.add_features(daily(spark, [1]).limit(0)))


def test_split_keeps_the_latest_days_for_test(spark):
    train, test = forecast.time_split(forecast.add_features(daily(spark, range(10))), test_days=2)
    assert (train.count(), test.count()) == (8, 2)
    assert train.agg(F.max("sales_date")).first()[0] < test.agg(F.min("sales_date")).first()[0]


def test_short_history_is_split_by_position(spark):
    history = daily(spark, range(5)).unionByName(daily(spark, range(5), product=2))
    train, test = forecast.time_split(forecast.add_features(history), test_days=14)
    assert (train.count(), test.count()) == (8, 2)
    assert {r.sales_date for r in test.collect()} == {FIRST + timedelta(days=4)}
    with pytest.raises(ValueError):
        forecast.time_split(forecast.add_features(daily(spark, [1])))


@pytest.mark.parametrize(
    "pairs, expected",
    [
        ([(1.0, 2.0), (3.0, 2.0)], (1.0, 1.0, 0.0)),
        ([(1.0, 1.0), (3.0, 3.0)], (0.0, 0.0, 1.0)),
        ([(5.0, 4.0)], (1.0, 1.0, 0.0)),
        ([(5.0, 5.0), (5.0, 5.0)], (0.0, 0.0, 1.0)),
        ([(5.0, 4.0), (5.0, 6.0)], (1.0, 1.0, 0.0)),
    ],
)
def test_error_measures(spark, pairs, expected):
    rows = spark.createDataFrame(pairs, "units_sold double, prediction double")
    assert tuple(forecast.evaluate(rows).first()) == expected


def brute_future(history, horizon):
    """The rules of future rows as a plain loop."""
    last = max(r[0] for r in history)
    out = []
    for product in sorted({r[1] for r in history}):
        series = sorted(r for r in history if r[1] == product)
        units, revenue = [r[3] for r in series], [r[4] for r in series]
        for day in range(1, horizon + 1):
            mean = lambda values: sum(values) / len(values)
            money = mean(revenue[-7:])
            out.append((
                last + timedelta(days=day), product, series[-1][2], money, units[-1],
                units[-7] if len(units) >= 7 else mean(units), mean(units[-7:]), mean(units[-30:]),
            ))
            units.append(0.0)
            revenue.append(money)
    return out


def test_future_rows_match_a_plain_loop(spark):
    history = []
    for product, days in enumerate((1, 2, 6, 7, 8, 29, 30, 31, 45), start=1):
        for d in range(days):
            history.append((FIRST + timedelta(days=d), product, product * 10, float((d * 7 + product) % 13), float(d % 5) + 0.25))
    frame = spark.createDataFrame(
        history, "sales_date date, product_id bigint, category_id bigint, units_sold double, revenue double"
    )
    columns = ["sales_date", "product_id", "category_id", "revenue", "lag_1", "lag_7", "rolling_mean_7", "rolling_mean_30"]
    got = sorted(tuple(r) for r in forecast.future_features(frame, 9).select(*columns).collect())
    expected = sorted(brute_future(history, 9))
    assert len(got) == len(expected) == 81
    for a, b in zip(got, expected):
        assert a[:3] == b[:3] and a[3:] == pytest.approx(b[3:])


def test_every_product_gets_every_day(spark):
    history = daily(spark, [1, 2, 3], 1, 10).unionByName(daily(spark, [2, 3, 4], 2, 20))
    future = forecast.future_features(history, 7)
    assert future.count() == 14 and future.filter("lag_1 IS NULL").count() == 0
    assert sorted(r.product_id for r in forecast.forecast_products(future).collect()) == [1, 2]
    assert forecast.with_forecast(history, future).count() == 20


def test_latest_category(spark):
    history = daily(spark, [1], 1, 10).unionByName(daily(spark, [1], 1, 30, start=FIRST + timedelta(days=1)))
    assert forecast.latest_category(history).first().category_id == 30


def test_train_store_load_predict(spark, folder):
    history = daily(spark, [i % 5 for i in range(40)], 1, 10).unionByName(daily(spark, [i % 3 for i in range(40)], 2, 20))
    features = forecast.add_features(history)
    model, metrics = forecast.train_and_evaluate(features, trees=5, max_depth=3)
    assert (metrics["train_rows"], metrics["test_rows"]) == (52, 28)
    store = forecast.ModelStore(spark, folder)
    with pytest.raises(FileNotFoundError):
        store.load_model()
    store.save_model(model, metrics, "20260101_000000")
    store.save_model(model, metrics, "20260102_000000")
    assert store.latest() == "20260102_000000" and len(store.versions()) == 2
    assert json.loads(json.dumps(store.metrics()))["mae"] == metrics["mae"]
    predictions = forecast.predict(store.load_model(), features)
    assert tuple(predictions.columns) == forecast.PREDICTION_COLUMNS
    assert predictions.count() == 14 and predictions.filter("predicted_units_sold < 0").count() == 0
    store.save_table(predictions, "predictions", "v1")
    ddl = ", ".join(f"{n} {t}" for n, t in predictions.dtypes)
    stored = store.load_table("predictions", ddl)
    one = [r.sales_date for r in forecast.forecast_for_product(stored, 1).collect()]
    assert one == sorted(one) and len(one) == 7


def test_store_feature_table_and_run_from_silver(spark, data, folder):
    from checks.fixtures import Inputs

    silver = Inputs(spark, data).silver()
    for name in ("orders", "order_items", "products"):
        silver[name].write.parquet(f"{folder}/silver/{name}")
    store = forecast.ModelStore(spark, f"{folder}/models")
    result = forecast.train_from_silver(spark, f"{folder}/silver", store, trees=3, max_depth=2)
    version = forecast.predict_from_silver(spark, f"{folder}/silver", store)
    assert result["version"] == store.latest() and store.latest("predictions") == version
    store.save_table(forecast.features_from_silver(spark, f"{folder}/silver"), "features", "v1")
    assert store.latest("features") == "v1"


def test_features_need_no_python_worker(spark):
    plan = forecast.future_features(forecast.add_features(daily(spark, range(9))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_groups_of_trees_are_one_forest(spark, folder):
    features = forecast.add_features(daily(spark, [(i * 7) % 5 for i in range(60)]))
    model = forecast.fit(features, trees=5, max_depth=3, group_trees=2)
    forests = [stage for stage in model.stages if hasattr(stage, "getNumTrees")]
    assert [forest.getNumTrees for forest in forests] == [2, 2, 1] and all(forest.getCacheNodeIds() for forest in forests)
    model.write().overwrite().save(f"{folder}/model")
    rows = PipelineModel.load(f"{folder}/model").transform(features)
    assert not [name for name in rows.columns if name.startswith("_prediction")]
    got = rows.select("features", "prediction").collect()
    for row in got:
        parts = [(forest.getNumTrees, forest.predict(row.features)) for forest in forests]
        assert row.prediction == pytest.approx(sum(n * value for n, value in parts) / 5)
    assert len({round(row.prediction, 9) for row in got}) > 1


def test_groups_of_trees_read_rows_stored_once_in_order(spark, monkeypatch):
    history = daily(spark, [(i * 7) % 5 for i in range(60)]).withColumn("revenue", (F.dayofyear("sales_date") * 37 % 60).cast("double"))
    seen, grown = [], forecast._grown

    def look(rows, *rest):
        files = {}
        for row in rows.select("features", F.input_file_name().alias("file")).collect():
            files.setdefault(row.file, []).append(round(row.features[-1], 9))
        seen.append(files)
        return grown(rows, *rest)

    monkeypatch.setattr(forecast, "_grown", look)
    forecast.fit(forecast.add_features(history), trees=4, max_depth=2, group_trees=2)
    first, second = seen
    assert first == second and "" not in first
    assert sum(map(len, first.values())) == 60 and all(values == sorted(values) for values in first.values())


def test_daily_sales_are_summed_once(spark):
    """A product listed twice counts twice; no second grouping holds the rows of a task again."""
    day = FIRST.isoformat()
    orders = spark.sql(f"SELECT k AS order_id, 'shipped' AS order_status, DATE '{day}' AS order_date FROM VALUES (1L), (2L) AS t(k)")
    items = spark.sql(
        "SELECT * FROM VALUES (1L, 1L, 2L, 5.0D), (2L, 1L, 3L, 2.505D), (2L, 2L, 1L, 1.0D), (2L, 9L, 4L, 8.0D), (2L, NULL, 1L, 3.0D), (1L, 3L, 1L, 2e14D) "
        "AS t(order_id, product_id, quantity, item_total)"
    )
    products = spark.sql("SELECT * FROM VALUES (1L, 7L), (1L, 7L), (1L, 8L), (2L, NULL), (3L, 5L), (3L, 5L), (NULL, 6L) AS t(product_id, category_id)")
    rows = forecast.daily_product_sales(orders, items.selectExpr("*", "1.0D AS unit_price", "0.0D AS discount"), products)
    lines = rows._jdf.queryExecution().executedPlan().toString().splitlines()
    assert sum("HashAggregate" in line and "sales_date" in line for line in lines) == 2  # before and after one shuffle
    got = {(r.product_id, r.category_id): (r.units_sold, r.revenue) for r in rows.collect()}
    assert got == {
        (1, 7): (10.0, 15.01), (1, 8): (5.0, 7.51), (2, None): (1.0, 1.0), (9, None): (4.0, 8.0), (None, None): (1.0, 3.0), (3, 5): (2.0, 4e14),
    }
