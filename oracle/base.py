"""Shared SQL tables of the checks, and the composer that adds those a check names."""

from __future__ import annotations

import re

IDS = "item_id, dept_id, cat_id, store_id, state_id"
# Days that follow from the order lines.
CUTOFF = "(SELECT cutoff FROM span)"
START = "(SELECT first_day FROM span)"
LAST = "(SELECT last_day FROM span)"
TRAIN_START = "DATE '1996-01-01'"
EVENTS = [
    "event_Christmas", "event_Cultural", "event_Easter", "event_Fathersday", "event_Halloween",
    "event_IndependenceDay", "event_NBAFinalsEnd", "event_NBAFinalsStart", "event_National",
    "event_NewYear", "event_Religious", "event_SpringFair", "event_Sporting",
    "event_Thanksgiving", "event_ValentinesDay",
]
RACES = ["Belmont", "Derby", "Preakness"]
STATES = ["AM", "AS", "EM"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
EVENT_COLS = ["event_name_1", "event_type_1", "event_name_2", "event_type_2"]
WEEK_OF_MONTH = "CAST((day(date) + dayofweek(date_trunc('month', date)) - 1) // 7 + 1 AS INTEGER)"
WEEK_OF_YEAR = "CAST((dayofyear(date) - 1) // 7 + 1 AS INTEGER)"


def flag(condition: str, name: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END AS {name}"


DATE_FLAGS = (
    [flag(f"weekday = '{w}'", f"weekday_{w}") for w in WEEKDAYS]
    + [flag(f"{WEEK_OF_MONTH} = {i}", f"weekmonth_{i}") for i in range(1, 7)]
    + [flag(f"month = {i}", f"month_{i}") for i in range(1, 13)]
    + [flag(f"year = {i}", f"year_{i}") for i in range(1995, 2002)]
)
DATE_FLAG_NAMES = (
    [f"weekday_{w}" for w in WEEKDAYS]
    + [f"weekmonth_{i}" for i in range(1, 7)]
    + [f"month_{i}" for i in range(1, 13)]
    + [f"year_{i}" for i in range(1995, 2002)]
)
SPORTS = ["NFL_Sun", "NCAA_Sat", "NBA_Finals", "USO_Sunday", "MLB_AM", "MLB_AS", "MLB_EM", *RACES]
ANCHORED = ["NBA_Finals", "USO_Sunday", "MLB_AM", "MLB_AS", "MLB_EM", "Horse_Race"]


def r6(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0.0 AS {name}"


def each(columns, pattern: str) -> str:
    return ", ".join(pattern.format(c=c) for c in columns)


def leads(columns, steps) -> str:
    return ", ".join(f"lead({c}, {k}) OVER (ORDER BY date) AS {c}_Lead_{k}" for k in steps for c in columns)


def code(column: str) -> str:
    """1-based rank of the distinct values, text without regard to case first."""
    return f"CAST(dense_rank() OVER (ORDER BY lower({column}), {column}) AS INTEGER) AS {column}"


def number_code(column: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY {column}) AS INTEGER) AS {column}"


CTES: dict[str, str] = {
    "span": """
        SELECT min(CAST(l_shipdate AS DATE)) AS first_day, max(CAST(l_shipdate AS DATE)) AS last_day,
               CAST(max(CAST(l_shipdate AS DATE)) - 27 AS DATE) AS cutoff FROM lineitem""",
    "cal": f"""
        SELECT date, n, 'd_' || CAST(n AS VARCHAR) AS d, CAST((n - 1) // 7 + 1 AS INTEGER) AS wm_yr_wk,
            weekday, wday, month, year,
            CASE WHEN month = 1 AND dom = 1 THEN 'NewYear'
                 WHEN month = 2 AND dom = 14 THEN 'ValentinesDay'
                 WHEN date IN (DATE '1995-04-16', DATE '1996-04-07', DATE '1997-03-30', DATE '1998-04-12',
                               DATE '1999-04-04', DATE '2000-04-23', DATE '2001-04-15') THEN 'Easter'
                 WHEN month = 6 AND dom = 8 THEN 'NBAFinalsStart'
                 WHEN month = 6 AND dom = 19 THEN 'NBAFinalsEnd'
                 WHEN month = 6 AND wday = 1 AND dom BETWEEN 15 AND 21 THEN 'Father''s day'
                 WHEN month = 7 AND dom = 4 THEN 'IndependenceDay'
                 WHEN month = 10 AND dom = 31 THEN 'Halloween'
                 WHEN month = 11 AND wday = 5 AND dom BETWEEN 22 AND 28 THEN 'Thanksgiving'
                 WHEN month = 12 AND dom = 25 THEN 'Christmas' END AS event_name_1,
            CASE event_name_1 WHEN 'Easter' THEN 'Religious'
                 WHEN 'NewYear' THEN 'National' WHEN 'IndependenceDay' THEN 'National'
                 WHEN 'Thanksgiving' THEN 'National' WHEN 'Christmas' THEN 'National'
                 WHEN 'ValentinesDay' THEN 'Cultural' WHEN 'Father''s day' THEN 'Cultural'
                 WHEN 'Halloween' THEN 'Cultural'
                 WHEN 'NBAFinalsStart' THEN 'Sporting' WHEN 'NBAFinalsEnd' THEN 'Sporting' END AS event_type_1,
            CASE WHEN month = 4 AND dom = 23 THEN 'SpringFair' END AS event_name_2,
            CASE WHEN month = 4 AND dom = 23 THEN 'Cultural' END AS event_type_2,
            {flag("dom <= 10", "snap_AM")},
            {flag("dom <= 15 AND dom % 2 = 1", "snap_AS")},
            {flag("dom IN (2, 3, 5, 6, 8, 9, 11, 12, 14, 15)", "snap_EM")}
        FROM (SELECT date, CAST(date - {START} AS INTEGER) + 1 AS n, dayname(date) AS weekday,
                     CAST(dayofweek(date) + 1 AS INTEGER) AS wday, CAST(month(date) AS INTEGER) AS month,
                     CAST(year(date) AS INTEGER) AS year, day(date) AS dom
              FROM (SELECT CAST(unnest(generate_series({START}, {LAST}, INTERVAL 1 DAY)) AS DATE) AS date))""",
    "cells": """
        SELECT item_id || '_' || store_id || '_evaluation' AS id, * FROM (
            SELECT item_id, dept_id, cat_id, store_id, state_id, CAST(l_shipdate AS DATE) AS date,
                   CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
                   CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
            FROM lineitem
            JOIN (SELECT p_partkey, p_brand || '_' || CAST(p_partkey // 10000 AS VARCHAR) AS item_id,
                         'D' || CAST((CAST(substr(p_brand, 7) AS INTEGER) - 1) // 5 AS VARCHAR) AS dept_id,
                         'C' || CAST((CAST(substr(p_brand, 7) AS INTEGER) - 1) // 10 AS VARCHAR) AS cat_id
                  FROM part) ON l_partkey = p_partkey
            JOIN (SELECT s_suppkey, r_name AS store_id,
                         CASE r_name WHEN 'AMERICA' THEN 'AM' WHEN 'ASIA' THEN 'AS' ELSE 'EM' END AS state_id
                  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
              ON l_suppkey = s_suppkey
            GROUP BY ALL)""",
    "series": f"SELECT DISTINCT id, {IDS} FROM cells",
    "prices": """
        SELECT id, store_id, item_id, wm_yr_wk, cents / 100.0::DOUBLE AS sell_price FROM (
            SELECT id, store_id, item_id, w.wm_yr_wk,
                   last_value(p.cents IGNORE NULLS) OVER (PARTITION BY id ORDER BY w.wm_yr_wk) AS cents
            FROM (SELECT id, store_id, item_id FROM series) s
            CROSS JOIN (SELECT DISTINCT wm_yr_wk FROM cal) w
            LEFT JOIN (SELECT id, wm_yr_wk, CAST(sum(cents) // sum(qty) AS BIGINT) AS cents
                       FROM cells JOIN cal USING (date) GROUP BY ALL) p USING (id, wm_yr_wk))
        WHERE cents IS NOT NULL""",
    "dense": f"""
        SELECT id, s.item_id, s.dept_id, s.cat_id, s.store_id, s.state_id, c.date, c.d, c.n, c.wm_yr_wk,
               coalesce(q.qty, 0) AS "Value"
        FROM series s CROSS JOIN cal c LEFT JOIN (SELECT id, date, qty FROM cells) q USING (id, date)""",
    "sales": f"SELECT * FROM dense WHERE date < {CUTOFF}",
    "actuals": f"SELECT * FROM dense WHERE date >= {CUTOFF}",
    "spine": f"""
        SELECT dense.*, p.sell_price, CASE WHEN date < {CUTOFF} THEN "Value" END AS v
        FROM dense JOIN prices p USING (id, wm_yr_wk)""",
    "train": f"SELECT * FROM spine WHERE date < {CUTOFF}",
    "total": 'SELECT date, CAST(sum("Value") AS BIGINT) AS total_value FROM sales GROUP BY date',
    "top": 'SELECT date, CAST(sum("Value") AS BIGINT) AS "Value" FROM sales GROUP BY date',
    "store_dept": 'SELECT date, store_id, dept_id, CAST(sum("Value") AS BIGINT) AS "Value" FROM sales GROUP BY ALL',
    # Two forecasts: mean of the 28 days ending 28 days back, and the sales 28 days back.
    "fc": f"""
        SELECT id, date, a, CAST(lag28 AS DOUBLE) AS b, {IDS},
               CAST(date - {CUTOFF} AS INTEGER) + 1 AS h,
               'F' || CAST(date - {CUTOFF} + 1 AS VARCHAR) AS key
        FROM (SELECT *, CASE WHEN rn >= 28 THEN avg(lag28) OVER (PARTITION BY id ORDER BY date ROWS 27 PRECEDING) END AS a
              FROM (SELECT *, lag(v, 28) OVER w AS lag28, row_number() OVER w AS rn FROM spine
                    WINDOW w AS (PARTITION BY id ORDER BY date)))
        WHERE date >= {CUTOFF}""",
    "topfc": f"""
        SELECT h, 'F' || CAST(h AS VARCHAR) AS key, fcast FROM (
            SELECT CAST(date - {CUTOFF} AS INTEGER) + 1 AS h, date,
                   avg(x) OVER (ORDER BY date ROWS BETWEEN 55 PRECEDING AND 28 PRECEDING) AS fcast
            FROM (SELECT date, sum(v) AS x FROM spine GROUP BY date))
        WHERE date >= {CUTOFF}""",
    "mlb": f"""
        SELECT date, {flag("n % 2 = 0", "MLB_AM")}, {flag("n % 3 = 0", "MLB_AS")}, {flag("n % 5 = 0", "MLB_EM")}
        FROM cal WHERE month BETWEEN 4 AND 9""",
    "nba": "SELECT date, 1 AS NBA_Finals FROM cal WHERE month = 6 AND day(date) BETWEEN 8 AND 19 AND day(date) % 2 = 0",
    "uso": "SELECT date, 1 AS USO_Sunday FROM cal WHERE month = 9 AND wday = 1 AND day(date) <= 14",
    "races": """
        SELECT date, CASE WHEN month = 5 AND day(date) <= 7 THEN 'Derby' WHEN month = 5 THEN 'Preakness' ELSE 'Belmont' END AS event
        FROM cal WHERE wday = 7 AND ((month = 5 AND (day(date) <= 7 OR day(date) BETWEEN 15 AND 21))
                                  OR (month = 6 AND day(date) BETWEEN 8 AND 14))""",
    "race_flags": "SELECT date, "
    + each(RACES, "max(CASE WHEN event = '{c}' THEN 1 ELSE 0 END) AS {c}")
    + " FROM races GROUP BY date",
    "star": f"""
        SELECT date, {flag("weekday = 'Sunday' AND (month > 8 OR month < 2)", "NFL_Sun")},
               {flag("weekday = 'Saturday' AND month >= 9", "NCAA_Sat")},
               {each(SPORTS[2:], 'coalesce({c}, 0) AS {c}')}
        FROM cal LEFT JOIN nba USING (date) LEFT JOIN uso USING (date) LEFT JOIN mlb USING (date)
        LEFT JOIN race_flags USING (date)""",
    "anchored": f"""
        SELECT cal.date, {each(ANCHORED, 'CASE WHEN nba.date IS NULL THEN 0 ELSE coalesce({c}, 0) END AS {c}')}
        FROM cal LEFT JOIN nba ON cal.date = nba.date LEFT JOIN uso ON cal.date = uso.date
        LEFT JOIN mlb ON cal.date = mlb.date
        LEFT JOIN (SELECT DISTINCT date, 1 AS Horse_Race FROM races) hr ON cal.date = hr.date""",
    "event_rows": " UNION ALL ".join(f"SELECT date, '{c}' AS key, {c} AS event FROM cal" for c in EVENT_COLS),
    "event_days": """
        SELECT DISTINCT date, 'event_' || regexp_replace(coalesce(event, 'NA'), '[^0-9A-Za-z]', '', 'g') AS event FROM event_rows""",
    "event_flags": "SELECT date, "
    + each([*EVENTS, "event_NA"], "max(CASE WHEN event = '{c}' THEN 1 ELSE 0 END) AS {c}")
    + " FROM event_days GROUP BY date",
    "wide": f"""
        SELECT date, d, wm_yr_wk, weekday, month, snap_AM, snap_AS, snap_EM, {", ".join(DATE_FLAGS)}, {", ".join(EVENTS)}
        FROM cal JOIN event_flags USING (date)""",
    "date_codes": f"""
        SELECT date, {code("weekday")}, {", ".join(number_code(c) for c in ("weekmonth", "monthday", "month", "year", "quarter", "week"))}
        FROM (SELECT date, weekday, {WEEK_OF_MONTH} AS weekmonth, day(date) AS monthday, month, year,
                     quarter(date) AS quarter, {WEEK_OF_YEAR} AS week FROM cal)""",
    "event_codes": f"""
        SELECT date, {", ".join(EVENT_COLS)},
               {", ".join(f"coalesce(lead({c}, {k}) OVER (ORDER BY date), 1) AS {c}_Lead_{k}" for k in (1, 2) for c in EVENT_COLS)}
        FROM (SELECT date, {", ".join(code(c) for c in EVENT_COLS)}
              FROM (SELECT date, {each(EVENT_COLS, "coalesce({c}, 'unknown') AS {c}")} FROM cal))""",
    "item_codes": f"SELECT id, {', '.join(code(c) for c in IDS.split(', '))} FROM series",
    "label_days": f"""
        SELECT date, d, wm_yr_wk, snap_AM, snap_AS, snap_EM, date_codes.* EXCLUDE (date), event_codes.* EXCLUDE (date),
               {", ".join("sp." + c for c in ANCHORED)}, {", ".join(f"sp.{c}_Lead_1" for c in ANCHORED)}
        FROM cal JOIN date_codes USING (date) JOIN event_codes USING (date)
        JOIN (SELECT *, {leads(ANCHORED, (1,))} FROM anchored) sp USING (date)""",
    "state_days": " UNION ALL ".join(
        f"""SELECT date, '{s}' AS state_id, snap_{s} AS snap, m AS "MLB",
            lead(m, 1) OVER (ORDER BY date) AS "MLB_Lead_1", lead(m, 2) OVER (ORDER BY date) AS "MLB_Lead_2"
            FROM (SELECT cal.date, snap_{s}, coalesce(MLB_{s}, 0) AS m FROM cal LEFT JOIN mlb USING (date))"""
        for s in STATES
    ),
}

# Point, lead and lag indicators of the per-series table, in its column order.
POINT = [c for c in EVENTS if "NBAFinals" not in c] + ["NFL_Sun", "NCAA_Sat", "NBA_Finals", "USO_Sunday"] + RACES
SERIES_FLAGS = (
    DATE_FLAG_NAMES
    + POINT
    + [f"{c}_Lead_{k}" for k in (1, 2) for c in POINT]
    + ["event_Thanksgiving_Lag_1", "event_Christmas_Lag_1"]
)
CTES["series_days"] = f"""
    SELECT date, {", ".join(DATE_FLAG_NAMES)}, {", ".join(POINT)}, {leads(POINT, (1, 2))},
           lag(event_Thanksgiving, 1) OVER (ORDER BY date) AS event_Thanksgiving_Lag_1,
           lag(event_Christmas, 1) OVER (ORDER BY date) AS event_Christmas_Lag_1
    FROM wide JOIN star USING (date)"""
CTES["series_days_future"] = CTES["series_days"] + f" WHERE date >= {CUTOFF}"
CTES["state_days_future"] = CTES["state_days"].replace(
    "LEFT JOIN mlb USING (date))", f"LEFT JOIN mlb USING (date) WHERE date >= {CUTOFF})"
)
# The label-encoded day table over the season-filtered calendar.
CTES["cal_season"] = "SELECT * FROM cal WHERE month IN (3, 4, 5, 6) OR year = 2001"
_SEASON = ("date_codes", "event_codes", "anchored", "label_days")
for _name in _SEASON:
    _sql = re.sub(r"\bcal\b", "cal_season", CTES[_name])
    for _other in _SEASON:
        _sql = re.sub(rf"\b{_other}\b", f"{_other}_season", _sql)
    CTES[f"{_name}_season"] = _sql
HOLIDAYS = sorted([*EVENTS, "event_NA"])
CTES["aggregate_days"] = f"""
    SELECT date, snap_AM, snap_AS, snap_EM, {", ".join("e." + c for c in HOLIDAYS)},
           {", ".join(f"e.{c}_Lead_{k}" for k in (1, 2) for c in HOLIDAYS)},
           {", ".join("s." + c for c in SPORTS)}, {", ".join(f"s.{c}_Lead_1" for c in SPORTS)},
           cal.year, cal.month, cal.wday AS weekday, CAST(day(date) AS INTEGER) AS monthday, {WEEK_OF_MONTH} AS weekmonth
    FROM cal JOIN (SELECT *, {leads(HOLIDAYS, (1, 2))} FROM event_flags) e USING (date)
    JOIN (SELECT *, {leads(SPORTS, (1,))} FROM star) s USING (date)"""

PRICE_MEAN = """
    SELECT id, date, {columns}, sell_price,
           CASE WHEN rn >= k THEN sum(cents) OVER (PARTITION BY id ORDER BY date ROWS BETWEEN k - 1 PRECEDING AND CURRENT ROW)
                                  / 100.0::DOUBLE / k ELSE sell_price END AS roll_mean
    FROM (SELECT *, CAST(ceil(n_rows * 0.12::DOUBLE) AS BIGINT) AS k FROM {rows})"""


def price_rows(source: str) -> str:
    """Row number, cents and row count of each series."""
    return f"""
        SELECT *, row_number() OVER w AS rn, CAST(round(sell_price * 100) AS BIGINT) AS cents,
               count(*) OVER (PARTITION BY id) AS n_rows
        FROM {source} WINDOW w AS (PARTITION BY id ORDER BY date)"""


CTES["price_rows"] = price_rows("spine")
CTES["price_rows_train"] = price_rows("train")
CTES["price_mean"] = PRICE_MEAN.format(rows="price_rows", columns='"Value", v')
CTES["price_mean_train"] = PRICE_MEAN.format(rows="price_rows_train", columns='"Value"')
FLAGS = """CASE WHEN (sell_price - roll_mean) / roll_mean <= -0.02::DOUBLE THEN 1 ELSE 0 END AS promo,
           CASE WHEN (sell_price - roll_mean) / roll_mean >= 0.02::DOUBLE THEN 1 ELSE 0 END AS hike"""


def rolling(function: str, n: int, name: str, gate: bool = True) -> str:
    frame = f"(PARTITION BY id ORDER BY date ROWS {n - 1} PRECEDING)"
    stat = f"{function} OVER {frame}"
    return f'CASE WHEN count("Value") OVER {frame} = {n} THEN {stat} END AS {name}'


WINDOWS = (28, 7, 14)
STATS = {"Mean": 'avg("Value")', "Sd": 'stddev_samp("Value")', "Lm": 'regr_slope("Value", rn)'}
ROLLS = ", ".join(rolling(f, n, f"Roll_{s}_{n}") for s, f in STATS.items() for n in WINDOWS)
CTES["rolls"] = f"""
    SELECT *, {ROLLS} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY date) AS rn FROM train)"""
SHIFTS = {("Lm", 14): 14, ("Lm", 7): 7}
CTES["shifted"] = "SELECT *, " + ", ".join(
    f"lag(Roll_{s}_{n}, {SHIFTS.get((s, n), 28)}) OVER (PARTITION BY id ORDER BY date) AS Roll_{s}_{n}_Shift"
    for s in STATS for n in WINDOWS
) + " FROM rolls"
STAT_COLS = [f"Roll_{s}_{n}_Shift" for s in STATS for n in WINDOWS]
CTES["horizon_stats"] = f"""
    SELECT id, CAST(date + 28 AS DATE) AS date, {", ".join(f"Roll_{s}_{n} AS Roll_{s}_{n}_Shift" for s in STATS for n in WINDOWS)}
    FROM (SELECT *, {ROLLS} FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY date) AS rn FROM (
                SELECT id, date, "Value", row_number() OVER (PARTITION BY id ORDER BY date DESC) AS newest FROM train)
            WHERE newest <= 60))
    WHERE {" AND ".join(f"Roll_{s}_{n} IS NOT NULL" for s in STATS for n in WINDOWS)}"""

# Read more than once by most checks that use them.
KEPT = {"span", "cells", "spine", "dense", "price_rows", "price_rows_train", "cal", "wide"}
_WORD = re.compile(r"[a-z_]+")


def _needed(sql: str, found: list[str], open_names: frozenset[str] = frozenset()) -> None:
    for word in _WORD.findall(sql):
        if word in CTES and word not in found and word not in open_names:
            _needed(CTES[word], found, open_names | {word})
            found.append(word)


def compose(body: str) -> str:
    """``body`` behind the shared tables it uses, each defined after those it needs."""
    names: list[str] = []
    _needed(body, names)
    if not names:
        return body
    parts = [f"{n} AS {'MATERIALIZED ' if n in KEPT else ''}({CTES[n].strip()})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
