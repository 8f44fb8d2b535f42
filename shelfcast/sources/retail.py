"""Retail tables (calendar, prices, sales, hierarchy) derived from the star schema.

Every table is written once per session below the shared folder, so the fact is
joined and rolled up a single time however many queries follow.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.columns import DAY_LIMIT, FORECAST_COLS, HORIZON, SERIES_COLS
from shelfcast.functions.text import day_label, series_key, to_validation
from shelfcast.operators.reshape import pivot_days
from shelfcast.session import apply_plan_settings, scratch_path, size_shuffles, small_side, written

# One item is one brand's line of this many consecutive part keys.
PARTS_PER_LINE = 10_000
# Price weeks that hold the horizon and the 56 days before it, wherever weeks begin and end.
RECENT_WEEKS = (HORIZON + 56) // 7 + 2
# Series and days that a task of the dense sales has, on average.
DENSE_ROWS = 250_000


@dataclass(frozen=True)
class Span:
    """The days that the order lines cover. The last ``HORIZON`` days are forecast."""

    first: dt.date
    last: dt.date

    @property
    def cutoff(self) -> dt.date:
        """First day of the horizon."""
        return self.last - dt.timedelta(days=HORIZON - 1)

    @property
    def days(self) -> int:
        return (self.last - self.first).days + 1

    @property
    def train_days(self) -> int:
        return self.days - HORIZON

    @property
    def weeks(self) -> int:
        return -(-self.days // 7)

    @property
    def years(self) -> range:
        return range(self.first.year, self.last.year + 1)

    def number(self, date: Column) -> Column:
        """1 for the first day."""
        return F.datediff(date, F.lit(self.first)) + 1


def easter(year: int) -> dt.date:
    """Easter Sunday: the Sunday after the first church full moon from 21 March on."""
    golden, century = year % 19, year // 100
    moon = (19 * golden + century - century // 4 - (8 * century + 13) // 25 + 15) % 30
    moon -= moon == 29 or (moon == 28 and golden > 10)
    full = dt.date(year, 3, 21) + dt.timedelta(days=moon)
    return full + dt.timedelta(days=7 - (full.weekday() + 1) % 7)


# Event names and types by month and day.
FIXED_EVENTS = [
    (1, 1, "NewYear", "National"),
    (2, 14, "ValentinesDay", "Cultural"),
    (6, 8, "NBAFinalsStart", "Sporting"),
    (6, 19, "NBAFinalsEnd", "Sporting"),
    (7, 4, "IndependenceDay", "National"),
    (10, 31, "Halloween", "Cultural"),
    (12, 25, "Christmas", "National"),
]
EVENT_VOCABULARY = [
    "event_Christmas", "event_Cultural", "event_Easter", "event_Fathersday", "event_Halloween",
    "event_IndependenceDay", "event_NBAFinalsEnd", "event_NBAFinalsStart", "event_National",
    "event_NewYear", "event_Religious", "event_SpringFair", "event_Sporting",
    "event_Thanksgiving", "event_ValentinesDay",
]
RACES = ["Belmont", "Derby", "Preakness"]
STATES = ["AM", "AS", "EM"]


def _events(date: Column, years: Iterable[int]) -> tuple[Column, Column]:
    """Name and type of the day's main event."""
    month, day, weekday = F.month(date), F.dayofmonth(date), F.dayofweek(date)
    rules = [((month == m) & (day == d), name, kind) for m, d, name, kind in FIXED_EVENTS]
    rules += [
        (date.isin([easter(y) for y in years]), "Easter", "Religious"),
        ((month == 6) & (weekday == 1) & day.between(15, 21), "Father's day", "Cultural"),
        ((month == 11) & (weekday == 5) & day.between(22, 28), "Thanksgiving", "National"),
    ]
    name = kind = F.lit(None).cast("string")
    for rule, n, k in rules:
        name = F.when(rule, n).otherwise(name)
        kind = F.when(rule, k).otherwise(kind)
    return name, kind


def _day_rows(spark: SparkSession, span: Span) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(span.first), F.lit(span.last))).alias("date"))


def make_calendar(spark: SparkSession, span: Span) -> DataFrame:
    date = F.col("date")
    number = span.number(date)
    day = F.dayofmonth(date)
    fair = (F.month(date) == 4) & (day == 23)
    name, kind = _events(date, span.years)
    return _day_rows(spark, span).select(
        "date",
        day_label(number).alias("d"),
        (F.floor((number - 1) / 7) + 1).cast("int").alias("wm_yr_wk"),
        F.date_format(date, "EEEE").alias("weekday"),
        F.dayofweek(date).alias("wday"),
        F.month(date).alias("month"),
        F.year(date).alias("year"),
        name.alias("event_name_1"),
        kind.alias("event_type_1"),
        F.when(fair, "SpringFair").alias("event_name_2"),
        F.when(fair, "Cultural").alias("event_type_2"),
        (day <= 10).cast("int").alias("snap_AM"),
        ((day <= 15) & (day % 2 == 1)).cast("int").alias("snap_AS"),
        ((day <= 15) & (day % 3 != 1)).cast("int").alias("snap_EM"),
    )


def make_side_calendars(spark: SparkSession, span: Span) -> dict[str, DataFrame]:
    """The four sports schedules; two of them carry their dates as US text."""
    date = F.col("date")
    days = _day_rows(spark, span)
    month, day, weekday = F.month(date), F.dayofmonth(date), F.dayofweek(date)
    us_text = F.date_format(date, "M/d/yyyy").alias("date")
    race = (
        F.when((month == 5) & (weekday == 7) & (day <= 7), "Derby")
        .when((month == 5) & (weekday == 7) & day.between(15, 21), "Preakness")
        .when((month == 6) & (weekday == 7) & day.between(8, 14), "Belmont")
    )
    number = span.number(date)
    return {
        "nba_finals": days.filter((month == 6) & day.between(8, 19) & (day % 2 == 0)).select(
            "date", F.lit(1).alias("NBA_Finals")
        ),
        "us_open": days.filter((month == 9) & (weekday == 1) & (day <= 14)).select(
            F.lit("US Open").alias("event"), us_text
        ),
        "mlb_games": days.filter(month.between(4, 9)).select(
            "date",
            (number % 2 == 0).cast("int").alias("MLB_AM"),
            (number % 3 == 0).cast("int").alias("MLB_AS"),
            (number % 5 == 0).cast("int").alias("MLB_EM"),
        ),
        "horse_racing": days.select(race.alias("event"), us_text).filter(F.col("event").isNotNull()),
    }


class Mart:
    """Retail tables of one star-schema directory, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._folders: dict[str, str] = {}

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table ``make`` gives, written on first use."""
        if name not in self._tables:
            self._tables[name] = written(make(), name)
        return self._tables[name]

    def folder(self, name: str, write: Callable[[str], None]) -> str:
        """The folder that ``write`` fills, filled on first use."""
        if name not in self._folders:
            path = scratch_path(self.spark, name)
            write(path)
            self._folders[name] = path
        return self._folders[name]

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- days ---------------------------------------------------------------
    @cached_property
    def span(self) -> Span:
        """First and last shipping day: one pass over one column."""
        day = F.to_date("l_shipdate")
        first, last = self._read("lineitem").agg(F.min(day), F.max(day)).first()
        if first is None:
            raise ValueError("no order line has a shipping day")
        return Span(first, last)

    @property
    def cutoff(self) -> dt.date:
        return self.span.cutoff

    @property
    def small_days(self) -> bool:
        """Every day table has one row per day (times the states)."""
        return self.span.days * len(STATES) <= DAY_LIMIT

    @cached_property
    def recent_since(self) -> dt.date:
        """A day from which on every series of the horizon has its last 84 days.

        Prices are weekly, so a series' last ``RECENT_WEEKS`` price weeks hold that many
        days, wherever weeks are missing; the earliest of these weeks over all series that
        reach the horizon is taken.
        """
        newest = F.row_number().over(Window.partitionBy("store_id", "item_id").orderBy(F.col("wm_yr_wk").desc()))
        last_week = F.lit((self.span.train_days // 7) + 1)
        tails = self.prices.select("store_id", "item_id", "wm_yr_wk", newest.alias("n")).filter(F.col("n") <= RECENT_WEEKS)
        tails = tails.groupBy("store_id", "item_id").agg(F.min("wm_yr_wk").alias("first"), F.max("wm_yr_wk").alias("last"))
        week = tails.filter(F.col("last") >= last_week).agg(F.min("first")).first()[0]
        return self.span.first + dt.timedelta(days=7 * ((week or 1) - 1))

    # -- dimensions ---------------------------------------------------------
    @property
    def calendar(self) -> DataFrame:
        return self.table("calendar", lambda: make_calendar(self.spark, self.span).coalesce(1))

    def side(self, name: str) -> DataFrame:
        return make_side_calendars(self.spark, self.span)[name]

    @property
    def series(self) -> DataFrame:
        """One row per product × store that ever sold."""
        return self.table("series", lambda: self.cells.select(*SERIES_COLS).distinct())

    @property
    def template(self) -> DataFrame:
        """The required ids, with the wide zero columns of a submission template."""
        both = self.series.select("id").unionByName(self.series.select(to_validation(F.col("id")).alias("id")))
        return both.select("id", *[F.lit(0).alias(c) for c in FORECAST_COLS])

    # -- facts --------------------------------------------------------------
    def _make_cells(self) -> DataFrame:
        line = F.floor(F.col("p_partkey") / PARTS_PER_LINE).cast("string")
        part = self._read("part").select(
            F.col("p_partkey").alias("l_partkey"), F.concat_ws("_", F.col("p_brand"), line).alias("item_id")
        )
        # Suppliers are joined as scanned, so that Spark decides by their size; the
        # 25 nations follow.
        supplier = self._read("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        store = self._read("region").join(self._read("nation"), F.col("r_regionkey") == F.col("n_regionkey"))
        store = store.select(F.col("n_nationkey").alias("s_nationkey"), F.col("r_name").alias("store_id"))
        lines = self._read("lineitem").select(
            "l_partkey",
            "l_suppkey",
            F.to_date("l_shipdate").alias("date"),
            F.col("l_quantity").cast("bigint").alias("qty"),
            F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        )
        # The rest of the hierarchy follows from item and store, so it stays out of the keys.
        brand = F.regexp_extract("item_id", "#([0-9]+)_", 1).cast("int")
        state = F.when(F.col("store_id") == "AMERICA", "AM").when(F.col("store_id") == "ASIA", "AS").otherwise("EM")
        return (
            lines.join(part, "l_partkey")
            .join(supplier, "l_suppkey")
            .join(small_side(store, 1000), "s_nationkey")
            .groupBy("item_id", "store_id", "date")
            .agg(F.sum("qty").alias("qty"), F.sum("cents").alias("cents"))
            .select(
                series_key("item_id", "store_id", suffix="evaluation").alias("id"),
                "item_id",
                F.concat(F.lit("D"), F.floor((brand - 1) / 5).cast("string")).alias("dept_id"),
                F.concat(F.lit("C"), F.floor((brand - 1) / 10).cast("string")).alias("cat_id"),
                "store_id",
                state.alias("state_id"),
                "date",
                "qty",
                "cents",
            )
        )

    @property
    def cells(self) -> DataFrame:
        """Units and money per series and selling day: one pass over the order lines."""
        return self.table("cells", self._make_cells)

    def _make_prices(self) -> DataFrame:
        week = (F.floor((self.span.number(F.col("date")) - 1) / 7) + 1).cast("int")
        # A week whose quantities cancel out has no price of its own.
        sold = (
            self.cells.withColumn("wm_yr_wk", week)
            .groupBy("id", "wm_yr_wk")
            .agg(F.expr("case when sum(qty) <> 0 then sum(cents) div sum(qty) end").alias("cents"))
        )
        weeks = self.series.select(
            "id", "store_id", "item_id", F.explode(F.sequence(F.lit(1), F.lit(self.span.weeks))).alias("wm_yr_wk")
        )
        carried = F.last("cents", ignorenulls=True).over(
            Window.partitionBy("id").orderBy("wm_yr_wk").rowsBetween(Window.unboundedPreceding, 0)
        )
        return (
            weeks.repartition("id")
            .join(sold.repartition("id"), ["id", "wm_yr_wk"], "left")
            .withColumn("cents", carried)
            .filter(F.col("cents").isNotNull())
            .select("store_id", "item_id", "wm_yr_wk", (F.col("cents") / 100).alias("sell_price"))
        )

    @property
    def prices(self) -> DataFrame:
        """Weekly price per item and store, carried over weeks without a sale."""
        return self.table("prices", self._make_prices)

    def _dense(self, first: dt.date, last: dt.date) -> DataFrame:
        # The days are made where their series has come to, so only series and cells are shuffled. The
        # partitions are as many as the days need: the shuffled bytes tell little of them.
        parts = max(-(-self.series.count() * ((last - first).days + 1) // DENSE_ROWS), 1)
        series = self.series.select(*SERIES_COLS).repartition(parts, "id")
        days = series.select("*", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
        sold = self.cells.filter(F.col("date").between(F.lit(first), F.lit(last))).select("id", "date", "qty")
        return (
            days.join(sold.repartition(parts, "id").hint("merge"), ["id", "date"], "left")
            .select(
                *SERIES_COLS,
                day_label(self.span.number(F.col("date"))).alias("d"),
                F.coalesce("qty", F.lit(0).cast("bigint")).alias("Value"),
            )
        )

    @property
    def sales(self) -> DataFrame:
        """Training sales, long: every series × day before the cutoff, 0 where nothing sold."""
        return self.table("sales", lambda: self._dense(self.span.first, self.cutoff - dt.timedelta(days=1)))

    @property
    def actuals(self) -> DataFrame:
        """What sold on the horizon days; for scoring only."""
        return self.table("actuals", lambda: self._dense(self.cutoff, self.span.last))

    @property
    def sales_wide(self) -> DataFrame:
        """Training sales, one column per day."""
        days = [f"d_{n}" for n in range(1, self.span.train_days + 1)]
        return self.table("sales_wide", lambda: pivot_days(self.sales, SERIES_COLS, days))


_marts: dict[tuple[str, str], Mart] = {}


def open_mart(spark: SparkSession, sf_dir: str) -> Mart:
    """The mart of ``sf_dir`` in this application, shared by all its queries."""
    apply_plan_settings(spark)
    size_shuffles(spark, f"{sf_dir}/lineitem.parquet")
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _marts:
        _marts[key] = Mart(spark, sf_dir)
    return _marts[key]
