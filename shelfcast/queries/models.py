"""Model queries, and for each a check that its result is whole and sound."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.columns import HORIZON, LABEL
from shelfcast.operators import boosting, encode, filters, learners, windows
from shelfcast.plans import tables
from shelfcast.queries import common
from shelfcast.queries.common import query
from shelfcast.session import fits, written
from shelfcast.sources.retail import Mart

# Trees of the aggregate series' forests, and of the pooled forest of all series (README has their costs).
FOREST_TREES = 1000
POOLED_TREES = 50
# The held-out error of all three boosted models rises well before so many steps without gain.
PATIENCE = 10
GLOBAL = boosting.Plan(patience=PATIENCE)
PER_STORE = dataclasses.replace(GLOBAL, rate=0.075)
TWEEDIE = boosting.Plan(power=1.1, patience=PATIENCE, depth=10, per_tree=True, min_rows=1, min_hessian=7.0)
GROUP_KEYS = ["store_id", "dept_id"]

# Training rows, horizon rows, feature columns.
Parts = tuple[DataFrame, DataFrame, list[str]]


def _total(mart: Mart) -> Parts:
    """The total series, with every day feature."""
    days = common.aggregate_days_table(mart)
    rolled = mart.table("total-sales", lambda: common.daily_sums(mart, []))
    train = written(tables.aggregate_table(rolled, days, small=mart.small_days), "total-train")
    future = tables.aggregate_future(rolled, days, mart.cutoff, small=mart.small_days)
    name = F.lit("total").alias("id")
    return train.select(name, "*"), future.select(name, "*"), learners.feature_columns(train)


def _groups(mart: Mart) -> Parts:
    """Store and department series with the day's own holidays and sports, no date parts or leads."""
    days = common.aggregate_days_table(mart)
    parts = {"year", "month", "weekday", "monthday", "weekmonth"}
    days = days.select(*[c for c in days.columns if "_Lead_" not in c and c not in parts])
    rolled = mart.table("group-sales", lambda: common.daily_sums(mart, GROUP_KEYS))
    codes = encode.label_encode(mart.series.select(*GROUP_KEYS).distinct(), GROUP_KEYS, suffix="_code")
    codes = F.broadcast(codes) if common.few_groups(mart, GROUP_KEYS) else codes
    train = tables.aggregate_table(rolled, days, GROUP_KEYS, mart.small_days).join(codes, GROUP_KEYS)
    future = tables.aggregate_future(rolled, days, mart.cutoff, GROUP_KEYS, mart.small_days).join(codes, GROUP_KEYS)
    train = written(train, "group-train")
    return train, future, learners.feature_columns(train)


def _series(mart: Mart) -> Parts:
    """The per-series table with the series' codes among its features."""
    train = common.training_table(mart, start=common.TRAIN_START)
    codes = encode.encode_items(mart.series).select(
        "id", *[F.col(c).alias(f"{c}_code") for c in ("item_id", "dept_id", "cat_id", "store_id", "state_id")]
    )
    train = mart.table("series-train", lambda: train.join(codes, "id"))
    future = common.horizon_table(mart).join(codes, "id")
    return train, future, [c for c in learners.feature_columns(train) if c in future.columns]


def _label(mart: Mart, season: bool) -> Parts:
    """Label-encoded rows, cut from one written table.

    The model reads its rows many times, so they are written once. The keys of the
    stores stay beside their codes. The season table has no lags and no day of month.
    """

    def make() -> DataFrame:
        if season:
            table = common.season_label_table(mart).drop("monthday")
        else:
            days = common.label_days_table(mart)
            spine = windows.add_lag_features(common.spine(mart))
            extra = [c for c in spine.columns if c.startswith(("lag_", "rmean_")) and c != "lag_7"]
            table = tables.label_table(spine, days, encode.encode_items(mart.series), mart.small_days, extra)
        return table.withColumnRenamed("store_id", "store_code").join(mart.series.select("id", "store_id"), "id")

    table = mart.table("season-model" if season else "label-model", make)
    return filters.train_rows(table, mart.cutoff), filters.eval_rows(table, mart.cutoff), learners.feature_columns(table)


def _filled(parts: Parts) -> Parts:
    """For learners that take no missing values."""
    train, future, columns = parts
    return train, learners.fill_from_training(future, train, columns), columns


def _last_known(train: DataFrame, mart: Mart, columns: list[str]) -> DataFrame:
    """The last 28 known days with all their features."""
    recent = filters.from_date(train, mart.cutoff - dt.timedelta(days=HORIZON))
    return recent.na.drop(subset=[*columns, LABEL])


def _forecast(mart: Mart, name: str, parts: Parts, fit: Callable[[DataFrame, list[str]], Model], keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """Horizon predictions of a fitted model, written once; the known days' come with them."""

    def make() -> DataFrame:
        train, future, columns = parts
        model = fit(train, columns)
        known = _last_known(train, mart, columns)
        fitted = learners.predict(model, known, columns).join(known.select(*keys, "date", LABEL), [*keys, "date"])
        mean = train.agg(F.avg(LABEL)).first()[0]
        ahead = learners.predict(model, future, columns).withColumn("part", F.lit("horizon"))
        return ahead.unionByName(fitted.withColumns({"part": F.lit("known"), "mean": F.lit(mean)}), allowMissingColumns=True)

    return mart.table(name, make)


def _boosted(mart: Mart, name: str, parts: Parts, plan: boosting.Plan, segment: str | None = None) -> DataFrame:
    """Horizon predictions of boosted trees, and those of the last known days, which only choose the number of trees."""

    def make() -> DataFrame:
        train, future, columns = parts
        held = F.col("date") >= F.lit(mart.cutoff - dt.timedelta(days=HORIZON))
        model = boosting.boost(train, columns, plan, held, segment)
        keys = ["id", "date", "store_id"]
        fitted = boosting.predict(model, train.filter(held), keys, segment).join(train.select("id", "date", LABEL), ["id", "date"])
        mean = train.agg(F.avg(LABEL)).first()[0]
        ahead = boosting.predict(model, future, keys, segment).withColumn("part", F.lit("horizon"))
        return ahead.unionByName(fitted.withColumns({"part": F.lit("known"), "mean": F.lit(mean)}), allowMissingColumns=True)

    return mart.table(name, make)


def _ahead(table: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    rows = table.filter("part = 'horizon'").drop("part", "mean", LABEL)
    return windows.horizon_index(rows, keys=keys)


def _sound(name: str, table: DataFrame, keys: tuple[str, ...] = ("id",)) -> DataFrame:
    """One row: how many series and rows a forecast has, and whether it is whole and sound."""
    ahead, known = F.col("part") == "horizon", F.col("part") == "known"
    off = lambda c: F.sum(F.when(known, (F.col(LABEL) - F.col(c)) * (F.col(LABEL) - F.col(c))))
    per_key = table.groupBy(*keys).agg(
        F.count(F.when(ahead, 1)).alias("n"), F.count(F.when(ahead & F.col("pred").isNull(), 1)).alias("missing"),
        F.count(F.when(ahead & (F.col("pred") < 0), 1)).alias("negative"), off("pred").alias("off_pred"), off("mean").alias("off_mean"),
    )
    return per_key.agg(
        F.count("*").alias("n_ids"), F.sum("n").alias("n_rows"), (F.min("n") == F.max("n")).alias("even_rows"),
        (F.sum("missing") == 0).alias("no_missing"), (F.sum("negative") == 0).alias("none_negative"),
        (F.sum("off_pred") < F.sum("off_mean")).alias("beats_mean"),
    ).withColumn("model", F.lit(name))


def _models(mart: Mart) -> dict[str, Callable[[], DataFrame]]:
    """Each model's written predictions, by query name."""
    forest = lambda share, trees: lambda train, columns: learners.fit_forest(train, columns, trees, share=share)
    groups = forest("0.5", FOREST_TREES)
    return {
        "rf_total_forecast": lambda: _forecast(mart, "rf-total", _total(mart), groups),
        "rf_store_dept_forecast": lambda: _forecast(mart, "rf-groups", _groups(mart), groups, tuple(GROUP_KEYS)),
        "rf_bottom_forecast": lambda: _forecast(mart, "rf-bottom", _series(mart), forest("sqrt", POOLED_TREES)),
        "gbm_global_forecast": lambda: _boosted(mart, "gbm-global", _label(mart, True), GLOBAL),
        "gbm_per_store_forecast": lambda: _boosted(mart, "gbm-stores", _lagged(mart), PER_STORE, "store_id"),
        "gbm_tweedie_forecast": lambda: _boosted(mart, "gbm-tweedie", _lagged(mart), TWEEDIE),
        "glm_poisson_forecast": lambda: _forecast(mart, "glm-poisson", _filled(_label(mart, True)), _linear(learners.fit_poisson)),
        "glm_tweedie_forecast": lambda: _forecast(mart, "glm-tweedie", _filled(_label(mart, True)), _linear(learners.fit_tweedie)),
    }


# Codes without an order. MLlib solves normal equations of at most 4096 columns, so items are
# indicators only up to ``HOT_LIMIT`` of them; beyond that departments stand for them.
HOT_COLUMNS = ["item_id", "dept_id", "cat_id", "store_code", "state_id", "weekday", "weekmonth", "month", "quarter"]
HOT_LIMIT = 2000


def _linear(fit: Callable[..., Model]) -> Callable[[DataFrame, list[str]], Model]:
    def run(train: DataFrame, columns: list[str]) -> Model:
        few = fits(train.select("item_id").distinct(), HOT_LIMIT)
        return fit(train, columns, [c for c in HOT_COLUMNS if c in columns and (few or c != "item_id")])

    return run


def _lagged(mart: Mart) -> Parts:
    """Label-encoded rows with lags: complete rows to learn from, horizon rows as they are."""
    train, future, columns = _label(mart, False)
    return filters.complete_rows(train), future, columns


@query
def rf_total_forecast(mart: Mart) -> DataFrame:
    return _ahead(_models(mart)["rf_total_forecast"]())


@query
def rf_store_dept_forecast(mart: Mart) -> DataFrame:
    return _ahead(_models(mart)["rf_store_dept_forecast"](), tuple(GROUP_KEYS))


@query
def rf_bottom_forecast(mart: Mart) -> DataFrame:
    """One pooled forest with the series' codes among its features."""
    return _ahead(_models(mart)["rf_bottom_forecast"]())


@query
def feature_importance(mart: Mart) -> DataFrame:
    """Impurity importances of the pooled forest, written once."""

    def make() -> DataFrame:
        train, _, columns = _series(mart)
        return learners.importances(learners.fit_forest(train, columns, POOLED_TREES, share="sqrt"), columns, train)

    return mart.table("rf-importance", make)


@query
def gbm_global_forecast(mart: Mart) -> DataFrame:
    """Poisson boosted trees on the season's rows."""
    return _ahead(_models(mart)["gbm_global_forecast"]())


@query
def gbm_per_store_forecast(mart: Mart) -> DataFrame:
    """Poisson boosted trees with lags, one model per store, all stores grown in the same jobs."""
    return _ahead(_models(mart)["gbm_per_store_forecast"]())


@query
def gbm_tweedie_forecast(mart: Mart) -> DataFrame:
    """Deep boosted trees under the Tweedie loss of power 1.1, with lags."""
    return _ahead(_models(mart)["gbm_tweedie_forecast"]())


@query
def glm_poisson_forecast(mart: Mart) -> DataFrame:
    return _ahead(_models(mart)["glm_poisson_forecast"]())


@query
def glm_tweedie_forecast(mart: Mart) -> DataFrame:
    return _ahead(_models(mart)["glm_tweedie_forecast"]())


@query
def fitted_vs_actual(mart: Mart) -> DataFrame:
    """In-sample fit of the total series' forest, written once."""

    def make() -> DataFrame:
        train, _, columns = _total(mart)
        model = learners.fit_forest(train, columns, FOREST_TREES, share="0.5")
        fitted = learners.predict(model, train, columns, "fcast")
        return train.select("date", LABEL).join(fitted.select("date", "fcast"), "date")

    return mart.table("rf-fitted", make)


# -- checks -------------------------------------------------------------------
@query
def check_rf_total(mart: Mart) -> DataFrame:
    return _sound("rf_total_forecast", _models(mart)["rf_total_forecast"]())


@query
def check_rf_store_dept(mart: Mart) -> DataFrame:
    return _sound("rf_store_dept_forecast", _models(mart)["rf_store_dept_forecast"](), tuple(GROUP_KEYS))


@query
def check_rf_bottom(mart: Mart) -> DataFrame:
    return _sound("rf_bottom_forecast", _models(mart)["rf_bottom_forecast"]())


@query
def check_gbm_global(mart: Mart) -> DataFrame:
    return _sound("gbm_global_forecast", _models(mart)["gbm_global_forecast"]())


@query
def check_gbm_per_store(mart: Mart) -> DataFrame:
    return _sound("gbm_per_store_forecast", _models(mart)["gbm_per_store_forecast"]())


@query
def check_gbm_tweedie(mart: Mart) -> DataFrame:
    return _sound("gbm_tweedie_forecast", _models(mart)["gbm_tweedie_forecast"]())


SPLIT_COLUMNS = ["weekday", "monthday", "month", "quarter", "dept_id", "store_code"]


@query
def check_first_split(mart: Mart) -> DataFrame:
    """The first split of a Poisson model by features of few values, whose bins are the values themselves."""
    train, _, _ = _label(mart, False)
    plan = boosting.Plan(rows=1.0, columns=1.0)
    split = boosting.first_split(train, SPLIT_COLUMNS, plan)
    names = F.array(*map(F.lit, SPLIT_COLUMNS))
    return split.select(
        F.get(names, "feature").alias("feature"), "bin", F.col("n").alias("n_rows"), F.round("gain", 2).alias("gain")
    )


@query
def check_feature_importance(mart: Mart) -> DataFrame:
    """One row: whether importances are named once each, none negative, largest first, and add up to one."""
    rows = feature_importance(mart)
    return rows.agg(
        (F.count("*") == F.count_distinct("feature")).alias("named_once"), (F.min("importance") >= 0).alias("none_negative"),
        (F.round(F.sum("importance"), 6) == 1).alias("add_up"), (F.max("importance") > 2 / F.count("*")).alias("some_stand_out"),
    )


@query
def check_fitted_vs_actual(mart: Mart) -> DataFrame:
    """One row: days and their total demand, and whether the fit is nearer to it than its mean."""
    off = F.avg((F.col(LABEL) - F.col("fcast")) * (F.col(LABEL) - F.col("fcast")))
    return fitted_vs_actual(mart).agg(
        F.count("*").alias("n_days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"),
        F.sum(LABEL).cast("bigint").alias("total"), (off < F.var_pop(LABEL)).alias("fits"),
    )


@query
def check_glm_poisson(mart: Mart) -> DataFrame:
    return _sound("glm_poisson_forecast", _models(mart)["glm_poisson_forecast"]())


@query
def check_glm_tweedie(mart: Mart) -> DataFrame:
    return _sound("glm_tweedie_forecast", _models(mart)["glm_tweedie_forecast"]())


@query
def topdown_forest(mart: Mart) -> DataFrame:
    """Store and department forests split to items by their shares, both id forms: a submission's rows."""
    from shelfcast.operators import blend

    groups = _ahead(_models(mart)["rf_store_dept_forecast"](), tuple(GROUP_KEYS))
    groups = groups.select(*GROUP_KEYS, "h", F.col("pred").alias("group_pred"))
    items = common.forecast_rows(mart, "b").join(mart.series.select("id", *GROUP_KEYS), "id")
    split = blend.top_down(items, groups, GROUP_KEYS, common.few_groups(mart, GROUP_KEYS))
    return blend.both_id_forms(split)
