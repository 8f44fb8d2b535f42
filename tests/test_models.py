"""Learners on a small table: no missing or negative predictions, better than the mean."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import learners
from shelfcast.queries import REGISTRY

START = dt.date(2000, 1, 1)


@pytest.fixture(scope="module")
def table(spark):
    rows = []
    for s in range(4):
        for i in range(200):
            weekday = i % 7
            value = 5 * s + (10 if weekday >= 5 else 2) + (i * 7 + s) % 3
            rows.append((f"s{s}", START + dt.timedelta(days=i), f"st{s % 2}", s, weekday, int(weekday >= 5), value))
    df = spark.createDataFrame(
        rows, "id string, date date, store_id string, code int, weekday int, weekend int, Value bigint"
    )
    return df.persist()


FITS = {
    "forest": lambda t, c: learners.fit_forest(t, c, trees=8, depth=6, share="0.5"),
    "poisson": learners.fit_poisson,
    "tweedie": learners.fit_tweedie,
}


@pytest.mark.parametrize("name", sorted(FITS))
def test_model_beats_the_mean(table, name):
    cutoff = F.lit(START + dt.timedelta(days=172))
    train, horizon = table.filter(F.col("date") < cutoff), table.filter(F.col("date") >= cutoff)
    columns = learners.feature_columns(train)
    assert columns == ["code", "weekday", "weekend"]
    out = learners.predict(FITS[name](train, columns), horizon.drop("Value"), columns)
    assert out.filter("pred IS NULL OR pred < 0").count() == 0
    assert [r["count"] for r in out.groupBy("id").count().collect()] == [28] * 4
    mean = train.agg(F.avg("Value")).first()[0]
    scored = out.join(horizon.select("id", "date", "Value"), ["id", "date"])
    rmse = lambda p: scored.agg(F.sqrt(F.avg((F.col("Value") - p) ** 2))).first()[0]
    assert rmse(F.col("pred")) < rmse(F.lit(mean))


def deviance(out):
    """Mean Poisson deviance of predictions beside their labels."""
    mean, y = F.greatest("pred", F.lit(1e-9)), F.col("Value")
    return out.agg(F.avg(2 * (F.when(y > 0, y * F.log(y / mean)).otherwise(0) - y + mean))).first()[0]


def test_indicators_fit_codes_better_than_numbers(mart):
    """Poisson model of the season's rows with and without indicators; README has the held-out figures of a larger table."""
    from shelfcast.queries import models

    rows, _, columns = models._label(mart, True)
    hot, plain = models._linear(learners.fit_poisson)(rows, columns), learners.fit_poisson(rows, columns)
    found = [deviance(learners.predict(m, rows, columns).join(rows.select("id", "date", "Value"), ["id", "date"])) for m in (hot, plain)]
    assert found[0] < found[1]


def test_a_code_not_seen_gets_a_prediction(table):
    model = learners.fit_poisson(table, ["code", "weekday"], ["code", "weekday"])
    out = learners.predict(model, table.withColumn("code", F.lit(77)), ["code", "weekday"])
    assert out.count() == table.count() and out.filter("pred IS NULL").count() == 0
    features = model.transform(table.limit(1)).first()["features"]
    assert features.size == 4 + 7 + 2 and len(features.indices) == 2  # sparse, with a place for unseen codes


def test_importances(table):
    columns = ["code", "weekday", "weekend"]
    rows = learners.importances(learners.fit_forest(table, columns, trees=5, depth=4), columns, table).collect()
    assert {r.feature for r in rows} == set(columns) and sum(r.importance for r in rows) == pytest.approx(1.0)


def test_label_table_model_covers_the_horizon(spark, sf_dir):
    out = REGISTRY["glm_poisson_forecast"](spark, sf_dir).persist()
    assert {r["count"] for r in out.groupBy("id").count().collect()} == {28}
    assert out.filter("pred IS NULL OR pred < 0").count() == 0


def test_a_missing_feature_fails_instead_of_losing_a_row(table):
    columns = ["code", "weekday"]
    model = learners.fit_forest(table, columns, trees=2, depth=3)
    with pytest.raises(Exception, match="(?i)null"):
        learners.predict(model, table.withColumn("weekday", F.lit(None).cast("int")), columns).collect()


def test_item_search_does_not_cancel(spark):
    from shelfcast.operators import blend

    values = [1e9 + 0.05 * (i % 7) for i in range(50)]
    bottom = spark.createDataFrame([(f"s{i}", "F1", v) for i, v in enumerate(values)], "id string, key string, value double")
    top = spark.createDataFrame([("F1", 1e9)], "key string, fcast double")
    got = {round(r.mult, 2): r.rmse for r in blend.multiplier_search_by_item(bottom, top).collect()}
    wanted = (sum((v - 1e9) ** 2 for v in values) / 50) ** 0.5
    assert got[1.0] == pytest.approx(wanted, rel=1e-6)


def test_kept_nodes_change_no_tree_and_serve_few_rows_only(table, monkeypatch):
    columns, made = ["code", "weekday", "weekend"], []
    plain = learners.RandomForestRegressor
    monkeypatch.setattr(learners, "RandomForestRegressor", lambda **given: made.append(given["cacheNodeIds"]) or plain(**given))
    kept = learners.fit_forest(table, columns, trees=12, depth=6, share="0.5")
    monkeypatch.setattr(learners, "NODES_KEPT", 12 * table.count() - 1)
    walked = learners.fit_forest(table, columns, trees=12, depth=6, share="0.5")
    assert made == [True, False] and kept.toDebugString.split("\n")[1:] == walked.toDebugString.split("\n")[1:]


@pytest.mark.parametrize("keys", [[], ["store_id", "dept_id"]])
def test_daily_sums_need_no_dense_sales(spark, sf_dir, keys):
    from shelfcast.operators import rollup
    from shelfcast.queries import common
    from shelfcast.sources.retail import Mart

    fresh = Mart(spark, sf_dir)
    got = common.daily_sums(fresh, keys).persist()
    assert got.count() == fresh.span.train_days * max(fresh.series.select(*keys).distinct().count() if keys else 1, 1)
    assert "sales" not in fresh._tables
    wanted = rollup.sum_by(common.dated_sales(fresh), keys)
    assert got.columns == wanted.columns and got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_forests_of_sums_build_no_dense_sales(spark, sf_dir):
    from shelfcast.queries import models
    from shelfcast.sources.retail import Mart

    fresh = Mart(spark, sf_dir)
    models._total(fresh), models._groups(fresh)
    assert "sales" not in fresh._tables


@pytest.mark.parametrize("name", ["gbm_global_forecast", "gbm_per_store_forecast", "gbm_tweedie_forecast", "rf_bottom_forecast", "rf_store_dept_forecast", "topdown_forest"])
def test_model_queries_cover_the_horizon(name, spark, sf_dir):
    out = REGISTRY[name](spark, sf_dir).persist()
    keys = ["store_id", "dept_id"] if name == "rf_store_dept_forecast" else ["id"]
    assert {r["count"] for r in out.groupBy(*keys).count().collect()} == {28}
    assert out.filter("pred < 0").count() == 0


def test_fitted_values_and_importances(spark, sf_dir):
    fitted = REGISTRY["fitted_vs_actual"](spark, sf_dir)
    assert fitted.columns == ["date", "Value", "fcast"] and fitted.filter("fcast IS NULL").count() == 0
    rows = REGISTRY["feature_importance"](spark, sf_dir).collect()
    assert len(rows) > 100 and sum(r.importance for r in rows) == pytest.approx(1.0)
