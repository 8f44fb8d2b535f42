"""Hand-made tables at the edges of each rule."""

import datetime as dt
import gzip
import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import dates, text, values
from shelfcast.operators import blend, encode, joins, metrics, pricing, reshape, rollup, windows
from shelfcast.sources import files, sinks

DAY = dt.date(2000, 1, 1)


def series(spark, values_, name="s", start=DAY):
    rows = [(name, start + dt.timedelta(days=i), v) for i, v in enumerate(values_)]
    return spark.createDataFrame(rows, "id string, date date, Value bigint")


def by_date(df, column):
    return [row[column] for row in df.orderBy("id", "date").collect()]


def test_short_series_has_no_window(spark):
    out = windows.add_rolling_stats(series(spark, [1, 2, 3, 4, 5]))
    assert all(v is None for c in out.columns if c.startswith("Roll") for v in by_date(out, c))


def test_missing_values_ignored_by_lag_means_but_not_by_complete_windows(spark):
    df = series(spark, [1, None, 3, 4, None, 6, 7, 8])
    lagged = windows.add_rolling_mean_of_lags(df, lags=(1,), windows=(3,))
    assert by_date(lagged, "rmean_1_3") == [None, None, 1.0, 2.0, 3.5, 3.5, 5.0, 6.5]
    full = windows.with_running(df).select("*", windows.rolling_mean(3).alias("m"))
    assert by_date(full, "m") == [None, None, None, None, None, None, None, 7.0]


def test_window_of_only_missing_values_is_missing(spark):
    out = windows.add_rolling_mean_of_lags(series(spark, [None, None, None, 4]), lags=(1,), windows=(2,))
    assert by_date(out, "rmean_1_2") == [None, None, None, None]


def test_flat_series(spark):
    flat = series(spark, [3] * 20)
    stats = windows.add_rolling_stats(flat, windows=(7,))
    last = stats.orderBy(F.desc("date")).first()
    assert (last.Roll_Mean_7, last.Roll_Sd_7, last.Roll_Lm_7) == (3.0, 0.0, 0.0)
    scored = flat.limit(3).withColumn("pred", F.lit(4.0))
    assert metrics.scaled_rmse(flat, scored).first().scaled_rmse is None
    assert all(v is None for v in by_date(metrics.add_minmax(flat, "Value", ["id"], "x"), "x"))


def test_rolling_slope_and_sd_by_hand(spark):
    out = windows.with_running(series(spark, [1, 4, 9, 16])).select(
        "id", "date", windows.rolling_slope(3).alias("slope"), windows.rolling_sd(3).alias("sd")
    )
    assert by_date(out, "slope")[2:] == pytest.approx([4.0, 6.0])
    assert by_date(out, "sd")[2:] == pytest.approx([math.sqrt(49 / 3), math.sqrt(109 / 3)])


def test_shift_equals_lag_of_the_statistic(spark):
    df = series(spark, [i * i % 11 for i in range(90)])
    w = windows.series_window()
    stats = windows.add_rolling_stats(df)
    lagged = stats.select(
        "id", "date", F.lag("Roll_Mean_14", 28).over(w).alias("m"), F.lag("Roll_Sd_7", 28).over(w).alias("s"),
        F.lag("Roll_Lm_14", 14).over(w).alias("l14"), F.lag("Roll_Lm_7", 7).over(w).alias("l7"),
    )
    shifted = windows.add_shifted_stats(df)
    for a, b in (("m", "Roll_Mean_14_Shift"), ("s", "Roll_Sd_7_Shift"), ("l14", "Roll_Lm_14_Shift"), ("l7", "Roll_Lm_7_Shift")):
        left, right = by_date(lagged, a), by_date(shifted, b)
        assert [v is None for v in left] == [v is None for v in right]
        assert [v for v in right if v is not None] == pytest.approx([v for v in left if v is not None])


def test_even_centred_window_reaches_one_row_further_ahead(spark):
    out = windows.add_centred_shifted(series(spark, range(8)), ["id"], n=4, shift=0)
    # Row 1 sees rows 0..3, row 5 sees rows 4..7; rows 0, 6 and 7 are incomplete.
    assert by_date(out, "roll_mean_4") == [1.5, 2.5, 3.5, 4.5, 5.5]


def test_locf(spark):
    out = series(spark, [None, 2, None, None, 5]).withColumn("f", windows.locf("Value"))
    assert by_date(out, "f") == [None, 2, 2, 2, 5]


def test_price_mean_by_hand(spark):
    rows = [("a", DAY + dt.timedelta(days=i), p) for i, p in enumerate([1.0, 2.0, 4.0, 4.1, 3.0])]
    rows += [("b", DAY, 2.0)]
    df = spark.createDataFrame(rows, "id string, date date, sell_price double")
    out = pricing.add_price_mean(df, share=0.3)  # widths 2 and 1
    assert by_date(out, "roll_mean") == pytest.approx([1.0, 1.5, 3.0, 4.05, 3.55, 2.0])
    flags = pricing.add_promo_hike(out)
    assert by_date(flags, "hike") == [0, 1, 1, 0, 0, 0]
    assert by_date(flags, "promo") == [0, 0, 0, 0, 1, 0]


def test_price_mean_matches_brute_force(spark):
    prices = {name: [round(1 + (i * k % 37) / 10, 2) for i in range(n)] for name, n, k in (("a", 400, 7), ("b", 25, 3), ("c", 1, 1))}
    rows = [(s, DAY + dt.timedelta(days=i), p) for s, ps in prices.items() for i, p in enumerate(ps)]
    out = pricing.add_price_mean(spark.createDataFrame(rows, "id string, date date, sell_price double"))
    expected = []
    for s in sorted(prices):
        ps = prices[s]
        k = math.ceil(len(ps) * 0.12)
        expected += [sum(ps[i - k + 1 : i + 1]) / k if i + 1 >= k else ps[i] for i in range(len(ps))]
    assert by_date(out, "roll_mean") == pytest.approx(expected)


def test_missing_price_gives_no_flag(spark):
    df = spark.createDataFrame([("a", DAY, None, None)], "id string, date date, sell_price double, roll_mean double")
    row = pricing.add_promo_hike(df).first()
    assert row.promo is None and row.hike is None


def test_two_events_on_one_day(spark):
    rows = [(DAY, "Easter", "Cultural", "Spring Fair", "Cultural"), (DAY + dt.timedelta(days=1), None, None, None, None)]
    cal = spark.createDataFrame(
        rows, "date date, event_name_1 string, event_type_1 string, event_name_2 string, event_type_2 string"
    )
    names = reshape.event_vocabulary(cal)
    assert names == ["event_Cultural", "event_Easter", "event_SpringFair"]
    known = reshape.one_hot_events(cal, names).collect()
    assert len(known) == 1 and [known[0][n] for n in names] == [1, 1, 1]
    every = reshape.one_hot_events(cal, [*names, "event_NA"], drop_missing=False).orderBy("date").collect()
    assert [row.event_NA for row in every] == [0, 1]
    assert reshape.unpivot_events(cal).count() == 8 and reshape.unpivot_events(cal, drop_missing=True).count() == 4


def test_dirty_dates(spark):
    df = spark.createDataFrame([("6/2/2012",), ("2012-06-02",), ("",), (None,)], "t string")
    got = [row.d for row in df.select(dates.parse_us_date(F.col("t")).alias("d")).collect()]
    assert got == [dt.date(2012, 6, 2), None, None, None]


def test_week_numbers(spark):
    # 2000-01-01 was a Saturday: a week of its own.
    days = {dt.date(2000, 1, 1): (1, 1), dt.date(2000, 1, 2): (2, 1), dt.date(2000, 1, 31): (6, 5), dt.date(2000, 12, 31): (6, 53)}
    df = spark.createDataFrame([(d,) for d in days], "date date")
    got = df.select("date", dates.week_of_month(F.col("date")).alias("m"), dates.week_of_year_simple(F.col("date")).alias("y"))
    assert {r.date: (r.m, r.y) for r in got.collect()} == days


def test_missing_price_week_gives_no_spine_row(spark):
    cal = spark.createDataFrame([(1, DAY, "d_1"), (2, DAY + dt.timedelta(days=7), "d_8")], "wm_yr_wk int, date date, d string")
    prices = spark.createDataFrame([("S", "I", 1, 2.0)], "store_id string, item_id string, wm_yr_wk int, sell_price double")
    demand = spark.createDataFrame([("I_S_evaluation", "I", "S", "d_8", 5)], "id string, item_id string, store_id string, d string, Value bigint")
    rows = joins.make_spine(prices, cal, demand).collect()
    assert [(r.d, r.Value) for r in rows] == [("d_1", None)]


def test_repeated_side_dates_fan_out_unless_distinct(spark):
    days = spark.createDataFrame([(DAY,)], "date date")
    twice = spark.createDataFrame([(DAY, 1), (DAY, 1)], "date date, USO_Sunday int")
    assert joins.sports_on_days(days, twice).count() == 2
    assert joins.sports_on_days(days, twice.distinct()).count() == 1


def test_event_anchored_star_keeps_only_anchor_days(spark):
    cal = spark.createDataFrame([(DAY,), (DAY + dt.timedelta(days=1),)], "date date")
    nba = spark.createDataFrame([(DAY, 1)], "date date, NBA_Finals int")
    mlb = spark.createDataFrame([(DAY, 1), (DAY + dt.timedelta(days=1), 1)], "date date, MLB_AM int")
    rows = joins.sports_on_anchor(cal, nba, mlb).orderBy("date").collect()
    assert [(r.NBA_Finals, r.MLB_AM) for r in rows] == [(1, 1), (0, 0)]


def test_ids(spark):
    df = spark.createDataFrame([("a_evaluation", 1.0), ("b_evaluation", 2.0)], "id string, F1 double")
    both = blend.both_id_forms(df)
    assert both.count() == 4 and both.filter(F.col("id").contains("validation")).count() == 2
    targets = spark.createDataFrame([("a_validation",), ("z_evaluation",)], "id string")
    assert [r.id for r in blend.final_submission(df, targets).collect()] == ["a_validation"]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (2.0,)], "p double")
    assert [r[0] for r in df.select(values.clip_nonnegative(F.col("p"))).collect()] == [0.0, None, 2.0]


def test_text_functions(spark):
    df = spark.createDataFrame([("a/b/x_1.csv.out", "Father's day", "F12")], "p string, e string, k string")
    row = df.select(
        text.path_to_series_id(F.col("p"), 3).alias("third"), text.path_to_series_id(F.col("p")).alias("last"),
        text.path_to_series_id(F.col("p"), 9).alias("none"), text.clean_event(F.col("e")).alias("e"),
        text.clean_event(F.lit(None).cast("string")).alias("na"), text.horizon_number(F.col("k")).alias("n"),
    ).first()
    assert tuple(row) == ("x_1", "x_1", None, "event_Fathersday", "event_NA", 12)


def test_label_codes_ignore_case_and_keep_missing(spark):
    df = spark.createDataFrame([("b",), ("A",), (None,), ("C",), ("a",)], "x string")
    got = {r.x: r.x_code for r in encode.label_encode(df, ["x"], "_code").collect()}
    assert got == {"A": 1, "a": 2, "b": 3, "C": 4, None: None}


@pytest.mark.parametrize("limit, days", [(10_000, True), (10_000, False), (0, False)], ids=["ranked", "dictionary", "ranges"])
def test_label_codes_do_not_depend_on_the_way_they_are_made(spark, limit, days):
    df = spark.range(3000).select(F.concat(F.lit("v"), (F.col("id") * 7919 % 701).cast("string")).alias("x"), (F.col("id") % 13).alias("y"))
    out = encode.label_encode(df, ["x", "y"], "_code", limit=limit, days=days)
    wanted = {v: i + 1 for i, v in enumerate(sorted({f"v{i * 7919 % 701}" for i in range(3000)}))}
    rows = out.collect()
    assert len(rows) == 3000
    assert all(r.x_code == wanted[r.x] and r.y_code == r.y + 1 for r in rows)


def test_prediction_files_round_trip(spark, tmp_path):
    ids = ["Brand#1_MIDDLE EAST_evaluation", "a%b_evaluation"]
    rows = [(i, h, float(h) / 3) for i in ids for h in range(28, 0, -1)]
    sinks.write_predictions(spark.createDataFrame(rows, "id string, h int, pred double"), f"file://{tmp_path}/eval")
    assert sorted(p.name for p in (tmp_path / "eval").iterdir()) == sorted(f"{i}.csv.out" for i in ids)
    got = files.scan_predictions(spark, f"file://{tmp_path}/eval").collect()
    assert sorted((r.id, r.h, r.pred) for r in got) == sorted(rows)


def test_top_down_with_empty_group(spark):
    items = spark.createDataFrame([("a", "S", "D", 1, 0.0), ("b", "S", "E", 1, 3.0), ("c", "S", "E", 1, 1.0)], "id string, store_id string, dept_id string, h int, pred double")
    groups = spark.createDataFrame([("S", "D", 1, 9.0), ("S", "E", 1, 8.0)], "store_id string, dept_id string, h int, group_pred double")
    got = {r.id: r.pred for r in blend.top_down(items, groups).collect()}
    assert got == {"a": None, "b": 6.0, "c": 2.0}


def test_item_search_matches_brute_force(spark):
    bottom = [(f"s{i}", f"F{h}", float(i * h % 7)) for i in range(20) for h in (1, 2, 3)]
    top = {"F1": 3.0, "F2": 4.0, "F3": 2.5}
    got = blend.multiplier_search_by_item(
        spark.createDataFrame(bottom, "id string, key string, value double"),
        spark.createDataFrame(list(top.items()), "key string, fcast double"),
    ).collect()
    assert len(got) == 35
    for row in got:
        wanted = math.sqrt(sum((v - top[k] * row.mult) ** 2 for _, k, v in bottom) / len(bottom))
        assert row.rmse == pytest.approx(wanted)


def test_submission_check_counts(spark):
    template = spark.createDataFrame([("a", 0), ("b", 0)], "id string, F1 int")
    got = spark.createDataFrame([("a", 1), ("a", 1), ("c", 1)], "id string, F1 int")
    row = metrics.submission_check(got, template).first()
    assert (row.columns_match, row.missing_ids, row.extra_ids, row.repeated_ids) == (True, 1, 1, 1)


def test_scaled_rmse_by_hand(spark):
    history = series(spark, [1, 3, 2, 6])  # steps 2, 1, 4
    scored = series(spark, [5, 7], start=DAY + dt.timedelta(days=4)).withColumn("pred", F.lit(4.0))
    wanted = math.sqrt(((1 / (7 / 3)) ** 2 + (3 / (7 / 3)) ** 2) / 2)
    assert metrics.scaled_rmse(history, scored).first().scaled_rmse == round(wanted, 6)


def test_columns_by_pattern_range_and_table(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "weekmonth int, month_1 int, Year int, event_month int")
    assert reshape.columns_like(df, ["MONTH"], exclude=["event"]) == ["weekmonth", "month_1"]
    assert reshape.columns_between(df, "month_1", "Year") == ["month_1", "Year"]
    assert reshape.columns_shared(df, df.select("Year", "weekmonth")) == ["Year", "weekmonth"]


def test_ties_in_top_series_break_by_key(spark):
    stats = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 1.0)], "id string, mean_v double")
    assert [r.id for r in rollup.top_series(stats, 2).collect()] == ["a", "b"]


@pytest.mark.parametrize("file_rows", [50, 1000])
def test_clustered_writes_bound_their_files(spark, tmp_path, file_rows):
    """One key holds most rows; another is missing; no task opens a file per key."""
    rows = [(f"s{i % 7}" if i % 10 == 0 else ("hot" if i % 3 else None), "d", i, float(i)) for i in range(3000)]
    table = spark.createDataFrame(rows, "store_id string, dept_id string, part_of_row int, Value double").repartition(8)
    path = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # it would merge so few rows into one task
    try:
        sinks.write_by(table, path, ["store_id", "dept_id"], header=True, file_rows=file_rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    counts = {r["store_id"]: r["count"] for r in table.groupBy("store_id").count().collect()}
    found = list((tmp_path / "out").rglob("*.csv"))
    assert len(found) <= 2 * sum(-(-n // file_rows) for n in counts.values())
    assert all(len(f.read_text().splitlines()) <= file_rows + 1 for f in found)
    back = spark.read.csv(path, header=True, schema="part_of_row int, Value double, store_id string, dept_id string")
    order = lambda df: sorted((r["part_of_row"], r["store_id"] or "", r["Value"]) for r in df.collect())
    assert order(back) == order(table)
    # The hot key is written by several tasks where it fills several files.
    hot = [f for f in found if "store_id=hot" in str(f)]
    assert len({f.name.split("-")[1] for f in hot}) >= (2 if file_rows == 50 else 1)


def test_exports_take_less_room_than_their_text(mart):
    """The training export and its splits are compressed files that read back whole."""
    from shelfcast.queries import storage

    path, schema = storage._export(mart, "train")
    found = list(Path(path.removeprefix("file://")).rglob("part-*"))
    assert found and all(f.name.endswith(".csv.gz") for f in found)
    rows = [r for f in found for r in gzip.open(f, "rt").read().splitlines()[1:]]
    assert storage._exported(mart, "train").count() == len(rows) > 0
    assert sum(f.stat().st_size for f in found) * 4 < sum(len(r) + 1 for r in rows)
