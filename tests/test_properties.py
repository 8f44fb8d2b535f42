"""Properties that hold whatever the data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import filters, joins, reshape, rollup, windows
from shelfcast.plans import tables
from shelfcast.queries import common
from shelfcast.queries.common import REGISTRY
from shelfcast.session import shuffle_partitions
from shelfcast.sources import retail


CUTOFF = dt.date(2001, 10, 8)


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def small_spine(spark):
    """Three series over 120 days, the last 28 unknown."""
    start = CUTOFF - dt.timedelta(days=92)
    days = [start + dt.timedelta(days=i) for i in range(120)]
    rows = [
        (f"i{s}_S_evaluation", d, 2.0 + (i // 7 * (s + 1)) % 5, None if d >= CUTOFF else (i * (s + 3)) % 11)
        for s in range(3)
        for i, d in enumerate(days)
    ]
    return spark.createDataFrame(rows, "id string, date date, sell_price double, Value bigint")


def test_no_order_line_falls_outside_the_calendar(mart, spark, sf_dir):
    sold = mart.cells.agg(F.sum("qty"), F.min("date"), F.max("date")).first()
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").agg(F.sum("l_quantity").cast("bigint")).first()[0]
    assert sold[0] == lines and sold[1] == mart.span.first and sold[2] == mart.span.last


def test_days_outside_todays_range_lose_nothing(spark, sf_dir, tmp_path):
    """The calendar grows with the order lines: a day before the first and one after the last."""
    from shelfcast.sources.retail import Mart

    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    day = F.to_date("l_shipdate")
    first, last = lines.agg(F.min(day), F.max(day)).first()
    kind = lines.schema["l_shipdate"].dataType
    edge = lambda d: lines.limit(1).withColumn("l_shipdate", F.lit(d).cast(kind))
    more = lines.unionByName(edge(first - dt.timedelta(days=1))).unionByName(edge(last + dt.timedelta(days=1)))
    more.write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("part", "supplier", "nation", "region"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    wider = Mart(spark, str(tmp_path))
    assert wider.span.first == first - dt.timedelta(days=1) and wider.span.last == last + dt.timedelta(days=1)
    units = lambda df, c: df.agg(F.sum(c).cast("bigint")).first()[0]
    assert units(wider.sales, "Value") + units(wider.actuals, "Value") == units(more, "l_quantity")
    # The last, partial week has prices for all of its days.
    spine = common.spine(wider)
    assert spine.agg(F.max("date")).first()[0] == wider.span.last
    assert units(spine, "Value") == units(wider.sales, "Value")


def test_recent_history_is_enough_whatever_weeks_are_missing(mart, spark, sf_dir):
    """One series without a price in a week of the last 56 days: the cut must not show."""
    from shelfcast.sources.retail import Mart

    some = mart.prices.orderBy("item_id", "store_id").first()
    week = (mart.span.train_days // 7) - 3
    here = (F.col("item_id") == some.item_id) & (F.col("store_id") == some.store_id)
    gapped = Mart(spark, sf_dir)
    for name in ("cells", "series", "sales", "calendar"):
        gapped._tables[name] = getattr(mart, name)
    gapped._tables["prices"] = mart.prices.filter(~(here & F.col("wm_yr_wk").isin(week, week - 1, week - 5))).cache()
    assert gapped.recent_since < mart.recent_since
    whole = common.two_forecasts(gapped, common.spine(gapped))
    assert rows_of(common.two_forecasts(gapped)) == rows_of(whole)
    assert rows_of(common.two_forecasts(mart)) == rows_of(common.two_forecasts(mart, common.spine(mart)))


def test_easter():
    known = ["1995-04-16", "1996-04-07", "1997-03-30", "1998-04-12", "1999-04-04", "2000-04-23", "2001-04-15", "2038-04-25", "2285-03-22"]
    assert [str(retail.easter(int(d[:4]))) for d in known] == known


def test_horizon_features_do_not_see_horizon_labels(small_spine):
    known = F.col("date") < F.lit(CUTOFF)
    leaked = small_spine.withColumn("Value", F.when(known, F.col("Value")).otherwise(F.lit(999).cast("bigint")))

    def horizon(df):
        out = windows.add_lag_features(df)
        safe = [c for c in out.columns if c.startswith(("lag_28", "lag_60", "rmean_28", "rmean_60"))]
        out = windows.add_shifted_stats(out, consistent=True)
        safe += [c for c in out.columns if c.endswith("_Shift")]
        return rows_of(filters.from_date(out, CUTOFF).select("id", "date", *safe))

    assert horizon(small_spine) == horizon(leaked)


def test_future_statistics_equal_shifted_statistics(small_spine):
    train = filters.train_rows(small_spine, CUTOFF)
    served = filters.from_date(windows.stats_for_horizon(train), CUTOFF)
    trained = windows.add_shifted_stats(small_spine, consistent=True).drop("Value", "sell_price")
    trained = filters.from_date(trained, CUTOFF)
    close = [F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) < 1e-9 for c in served.columns if c.startswith("Roll")]
    both = served.alias("a").join(trained.alias("b"), ["id", "date"])
    assert both.count() == 84 and all(both.filter(~ok).count() == 0 for ok in close)


def test_row_order_does_not_matter(small_spine):
    mixed = small_spine.orderBy(F.rand(7)).repartition(5)
    for fn in (windows.add_lag_features, windows.add_shifted_stats, tables.price_features):
        assert rows_of(fn(small_spine)) == rows_of(fn(mixed))


def test_unpivot_undoes_pivot(mart):
    long = common.forecast_long(mart).select("id", "key", "value")
    assert rows_of(reshape.unpivot_forecast(common.forecast_wide(mart))) == rows_of(long)


def test_every_level_sums_to_the_total(mart):
    levels = rollup.sum_all_levels(common.dated_sales(mart))
    sums = {r.level: r.s for r in levels.groupBy("level").agg(F.sum("Value").alias("s")).collect()}
    assert len(sums) == 6 and len(set(sums.values())) == 1


def test_twenty_eight_rows_per_series(mart):
    counts = common.forecast_rows(mart).groupBy("id").count().select("count").distinct().collect()
    assert [r[0] for r in counts] == [28]


def test_recent_rows_give_the_forecast_of_the_whole_history(mart):
    recent = common.two_forecasts(mart)
    whole = common.two_forecasts(mart, common.spine(mart))
    assert rows_of(recent) == rows_of(whole)


def test_top_down_sums_back_to_the_group(mart, spark, sf_dir):
    keys = ["store_id", "dept_id"]
    parts = REGISTRY["topdown_disaggregate"](spark, sf_dir).join(mart.series.select("id", *keys), "id")
    sums = parts.groupBy(*keys, "h").agg(F.sum("pred").alias("s"), F.count("pred").alias("n"))
    rows = common.rolled_rows(mart, keys)
    groups = common.forecast_rows(mart, "a", rows).join(rows.select("id", *keys).distinct(), "id")
    both = sums.filter("n > 0").join(groups, [*keys, "h"])
    assert both.filter(F.abs(F.col("s") - F.col("pred")) > 1e-3).count() == 0


def test_day_tables_have_one_row_per_day(mart):
    for days in (common.wide_calendar(mart), common.series_days(mart), tables.label_day_table(mart.calendar, common.sports(mart))):
        assert days.count() == days.select("date").distinct().count() == mart.span.days
    states = common.state_days(mart)
    assert states.count() == mart.span.days * len(retail.STATES)


def test_training_and_horizon_tables_share_their_features(mart):
    train, future = common.training_table(mart), common.horizon_table(mart)
    assert set(train.columns) - set(future.columns) == {"Value"}


def test_slope_serving_without_slopes(mart):
    table = common.training_table(mart, slopes=False)
    assert not [c for c in table.columns if "_Lm_" in c]


# -- plans --------------------------------------------------------------------
def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spine_windows_reuse_the_partitioning_by_series(mart, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spine = joins.make_spine(mart.prices, mart.calendar, mart.sales, mart.small_days)
        stats = windows.add_shifted_stats(spine)
        plans = plan_of(stats), plan_of(tables.price_features(stats))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan, sorts in zip(plans, (2, 3)):
        assert plan.count("Exchange hashpartitioning") == 2 and plan.count("SortMergeJoin") == 1
        assert plan.count("- Sort [") == sorts


def test_shuffles_are_sized_by_input():
    assert shuffle_partitions(10**9) == 200 and shuffle_partitions(10**14) == 745_059


def test_merged_partitions_do_not_grow_with_the_input(mart, spark):
    """Partitions of some 8 MB would stay if they were merged by the number of cores alone."""
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        for rows, least in ((1_000_000, 4), (8_000_000, 25)):
            table = spark.range(rows).select(F.xxhash64("id").alias("id")).repartition("id")
            assert table.rdd.getNumPartitions() >= least
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_date_filter_reaches_the_scan(mart):
    plan = plan_of(filters.from_date(mart.cells, dt.date(2001, 1, 1)).select("id", "date", "qty"))
    assert "GreaterThanOrEqual(date,2001-01-01)" in plan and "cents" not in plan


PRICE_QUERIES = [
    "semi_join_series", "filter_date_range", "dynamic_window_price_mean", "promo_hike_flags", "price_lag_diff_change",
    "horizon_index", "union_price_history_future", "state_specific_flags",
]


@pytest.mark.parametrize("name", PRICE_QUERIES)
def test_price_queries_read_no_sales(name, mart, spark, sf_dir):
    sales = {f.rsplit("/", 1)[0] for f in mart.sales.inputFiles()}
    read = {f.rsplit("/", 1)[0] for f in REGISTRY[name](spark, sf_dir).inputFiles()}
    assert read and not read & sales


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cross_joins(name, spark, sf_dir):
    plan = plan_of(REGISTRY[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_unbounded_sides_are_joined_by_shuffle(spark):
    days = spark.range(10).select(F.col("id").alias("date"))
    import shelfcast.operators.joins as module

    limit, module.DAY_LIMIT = module.DAY_LIMIT, 5
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan_of(joins.join_days(days, days))
        module.DAY_LIMIT = 10
        assert "BroadcastHashJoin" in plan_of(joins.join_days(days, days))
    finally:
        module.DAY_LIMIT = limit
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dense_days_are_made_after_the_shuffle(spark, monkeypatch):
    """Only series and cells are shuffled, into as many partitions as the days need; every day has its row."""
    first, last = dt.date(2000, 1, 1), dt.date(2000, 1, 10)
    mart = retail.Mart(spark, "unused")
    mart.__dict__["span"] = retail.Span(first, last)
    names = ", ".join(f"{c} string" for c in retail.SERIES_COLS)
    mart._tables["series"] = spark.createDataFrame([tuple(f"{c}{i}" for c in retail.SERIES_COLS) for i in range(6)], names)
    sold = [("id0", first, 5), ("id3", last, 7), ("id3", dt.date(2000, 2, 1), 9)]
    mart._tables["cells"] = spark.createDataFrame(sold, "id string, date date, qty bigint")
    monkeypatch.setattr(retail, "DENSE_ROWS", 20)
    dense = mart._dense(first, last)
    plan = plan_of(dense)
    assert plan.index("Generate") < plan.index("Exchange") and plan.count("Exchange hashpartitioning(id") == 2
    assert dense.rdd.getNumPartitions() == 3
    rows = {(r["id"], r["d"]): r["Value"] for r in dense.collect()}
    assert len(rows) == dense.count() == 60
    assert {k: v for k, v in rows.items() if v} == {("id0", "d_1"): 5, ("id3", "d_10"): 7}
