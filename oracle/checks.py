"""One SQL statement per checked query."""

from __future__ import annotations

from oracle.base import (
    ANCHORED, CUTOFF, DATE_FLAG_NAMES, DATE_FLAGS, EVENT_COLS, EVENTS, FLAGS, HOLIDAYS, IDS, RACES, SERIES_FLAGS,
    SPORTS, STAT_COLS, STATES, STATS, TRAIN_START, WEEK_OF_MONTH, WEEK_OF_YEAR, WINDOWS, code, each, flag, leads, r6,
)

TRAIN_DAYS = 2471
FORECASTS = [f"F{h}" for h in range(1, 29)]
CHECKS: dict[str, str] = {}


def with_total(days: str) -> str:
    return f"SELECT x.*, total_value FROM ({days}) x LEFT JOIN total USING (date)"


def wide(value: str, source: str = "fc", ids: str = "id") -> str:
    """F1..F28 by conditional aggregates."""
    cells = ", ".join(f"round(max(CASE WHEN h = {h} THEN {value} END), 6) + 0.0 AS F{h}" for h in range(1, 29))
    return f"SELECT {ids}, {cells} FROM {source} GROUP BY {ids}"


BOTH_IDS = """(SELECT id, h, a FROM fc UNION ALL
               SELECT replace(id, '_evaluation', '_validation') AS id, h, a FROM fc)"""

# -- sources and sinks --------------------------------------------------------
DAY_LIST = ", ".join(f"l[{n}] AS d_{n}" for n in range(365, TRAIN_DAYS + 1))
CHECKS["scan_calendar"] = with_total(
    f"""SELECT date, d, wm_yr_wk, weekday, wday, month, year, {", ".join(EVENT_COLS)}, snap_AM, snap_AS, snap_EM
        FROM cal WHERE date >= {TRAIN_START}"""
)
CHECKS["scan_prices"] = """
    SELECT store_id, item_id, wm_yr_wk, sell_price, item_id || '_' || store_id AS store_item FROM prices"""
CHECKS["scan_sales_wide"] = f"""
    SELECT id, {IDS}, {DAY_LIST} FROM (SELECT id, {IDS}, list("Value" ORDER BY n) AS l FROM sales GROUP BY ALL)"""
CHECKS["scan_side_calendars"] = with_total(
    "SELECT date, 'NBA_Finals' AS name, 1 AS flag FROM nba UNION ALL SELECT date, 'USO_Sunday', 1 FROM uso"
    " UNION ALL SELECT date, event, 1 FROM races UNION ALL "
    + " UNION ALL ".join(f"SELECT date, 'MLB_{s}', MLB_{s} FROM mlb" for s in STATES)
)
CHECKS["scan_target_ids"] = """
    SELECT id FROM series UNION ALL SELECT replace(id, '_evaluation', '_validation') FROM series"""
CHECKS["scan_prediction_files"] = f"SELECT id, h, {r6('a', 'pred')} FROM fc"
CHECKS["sink_submission_csv"] = wide("b")
CHECKS["write_submission"] = wide("a", BOTH_IDS)
CHECKS["sink_table_csv"] = 'SELECT store_id, item_id, wm_yr_wk, sell_price, date, d, v AS "Value" FROM spine'

# -- reshapes -----------------------------------------------------------------
CHECKS["select_pattern"] = with_total(
    f"""SELECT date, snap_AM, snap_AS, snap_EM, {", ".join(DATE_FLAG_NAMES)},
               {", ".join(c for c in EVENTS if "NBAFinals" not in c)} FROM wide"""
)
CHECKS["label_first_projection"] = f'SELECT "Value", {IDS}, sell_price FROM train'
CHECKS["unpivot_sales"] = 'SELECT id, item_id, store_id, d, "Value" FROM sales'
CHECKS["unpivot_events"] = with_total("SELECT date, key, event FROM event_rows")
CHECKS["unpivot_events_known"] = with_total("SELECT date, key, event FROM event_rows WHERE event IS NOT NULL")
CHECKS["unpivot_forecast"] = f"SELECT id, key, {r6('a', 'value')} FROM fc"
CHECKS["pivot_forecast"] = wide("a")
CHECKS["onehot_events_pivot"] = with_total("SELECT * FROM event_flags")
CHECKS["onehot_events_pivot_known"] = with_total(
    f"""SELECT * EXCLUDE (event_NA) FROM event_flags
        WHERE date IN (SELECT date FROM event_rows WHERE event IS NOT NULL)"""
)
CHECKS["onehot_races_pivot"] = with_total("SELECT * FROM race_flags")
CHECKS["onehot_date_parts"] = with_total(f"SELECT date, {', '.join(DATE_FLAGS)} FROM cal")
CHECKS["calendar_wide_features"] = with_total("SELECT * FROM wide")
CHECKS["first_n_days"] = with_total(f"SELECT d, date FROM cal WHERE date >= {TRAIN_START} AND date < {CUTOFF}")
CHECKS["state_specific_flags"] = """
    SELECT id, date, state_id, snap, "MLB" FROM spine JOIN state_days USING (date, state_id)"""
CHECKS["encode_strings_all"] = f"""
    SELECT date, {code("store_id")}, {code("dept_id")}, "Value" FROM store_dept"""

# -- filters ------------------------------------------------------------------
CHECKS["filter_date_from"] = f"SELECT id, date, qty FROM cells WHERE date >= {TRAIN_START}"
CHECKS["filter_season_or_year"] = """
    SELECT id, date, qty FROM cells WHERE month(date) IN (3, 4, 5, 6) OR year(date) = 2001"""
CHECKS["train_eval_split"] = f"""
    SELECT id, date, sell_price, v AS "Value", CASE WHEN date < {CUTOFF} THEN 'train' ELSE 'eval' END AS part FROM spine"""
LAGS = ", ".join(f"lag(v, {k}) OVER (PARTITION BY id ORDER BY date) AS lag_{k}" for k in (7, 28, 60))
CHECKS["drop_incomplete_rows"] = f"""
    SELECT * FROM (SELECT id, date, v AS "Value", {LAGS} FROM spine)
    WHERE "Value" IS NOT NULL AND lag_7 IS NOT NULL AND lag_28 IS NOT NULL AND lag_60 IS NOT NULL"""
CHECKS["filter_id_match"] = f"SELECT id, key, {r6('a', 'value')} FROM fc"
CHECKS["filter_date_range"] = f"SELECT id, date, sell_price FROM spine WHERE date IN ({CUTOFF}, {CUTOFF} + 1)"

# -- joins --------------------------------------------------------------------
CHECKS["join_price_week_to_day"] = """
    SELECT wm_yr_wk, store_id, item_id, sell_price, date, d FROM prices JOIN cal USING (wm_yr_wk)"""
CHECKS["join_left_demand"] = """
    SELECT p.store_id, p.item_id, c.d, c.date, p.sell_price, s."Value"
    FROM prices p JOIN cal c USING (wm_yr_wk) LEFT JOIN sales s ON s.id = p.id AND s.d = c.d"""
CHECKS["semi_join_price_weeks"] = """
    SELECT store_id, item_id, wm_yr_wk, sell_price FROM prices
    WHERE wm_yr_wk IN (SELECT wm_yr_wk FROM cal WHERE month IN (3, 4, 5, 6) OR year = 2001)"""
CHECKS["semi_join_series"] = f"""
    SELECT id, date, sell_price FROM spine WHERE date >= {CUTOFF}
    AND id IN (SELECT id FROM cells WHERE date = {CUTOFF} - 1)"""
CHECKS["join_sales_calendar"] = """
    SELECT id, s.d AS "Date_label", s."Value", s.date, c.wm_yr_wk, weekday, month FROM sales s JOIN cal c USING (d)"""
PRICED = """
    SELECT s.item_id || '_' || s.store_id AS store_item, s.wm_yr_wk, s.d AS "Date_label", s."Value", s.date, p.sell_price
    FROM sales s {how} JOIN prices p ON p.id = s.id AND p.wm_yr_wk = s.wm_yr_wk"""
CHECKS["join_left_price"] = PRICED.format(how="LEFT")
CHECKS["join_inner_price"] = PRICED.format(how="INNER")
CHECKS["sports_star_calendar_anchored"] = with_total("SELECT * FROM star")
CHECKS["sports_star_event_anchored"] = with_total("SELECT * FROM anchored")
CHECKS["join_calendar_features"] = with_total("SELECT * FROM label_days")
CHECKS["assemble_label_encoded_table"] = f"""
    SELECT s.id, s.date, s.v AS "Value", s.sell_price, label_days.* EXCLUDE (date, d, wm_yr_wk), {", ".join("i." + c for c in IDS.split(", "))}
    FROM spine s JOIN label_days ON s.date = label_days.date JOIN item_codes i ON i.id = s.id"""
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in [*STAT_COLS, "promo"])
CHECKS["assemble_series_model_table"] = f"""
    SELECT s.date, s.state_id, id, s."Value", s.sell_price, promo, hike, {", ".join(r6(c, c) for c in STAT_COLS)},
           item_id, dept_id, cat_id, store_id, sd.* EXCLUDE (date), snap, "MLB", "MLB_Lead_1", "MLB_Lead_2"
    FROM shifted s JOIN (SELECT id, date, {FLAGS} FROM price_mean_train) USING (id, date)
    JOIN series_days sd ON sd.date = s.date
    JOIN state_days st ON st.date = s.date AND st.state_id = s.state_id
    WHERE {COMPLETE} AND s.date >= {TRAIN_START} AND event_Thanksgiving_Lag_1 IS NOT NULL"""
CHECKS["assemble_top_level_table"] = f"""
    SELECT t.date, "Value", {r6("roll_sd_28", "roll_sd_28")}, {r6("roll_mean_28", "roll_mean_28")},
           aggregate_days.* EXCLUDE (date) REPLACE ({", ".join(
               f"coalesce(aggregate_days.{c}, 0) AS {c}"
               for c in [f"{h}_Lead_{k}" for k in (1, 2) for h in HOLIDAYS] + [f"{s}_Lead_1" for s in SPORTS])})
    FROM (SELECT date, "Value", lag(sd, 28) OVER w AS roll_sd_28, lag(m, 28) OVER w AS roll_mean_28
          FROM (SELECT *, CASE WHEN count(*) OVER f = 28 THEN stddev_samp("Value") OVER f END AS sd,
                       CASE WHEN count(*) OVER f = 28 THEN avg("Value") OVER f END AS m
                FROM top WINDOW f AS (ORDER BY date ROWS BETWEEN 13 PRECEDING AND 14 FOLLOWING))
          WINDOW w AS (ORDER BY date)) t
    JOIN aggregate_days ON aggregate_days.date = t.date WHERE roll_sd_28 IS NOT NULL"""
FUTURE_FLAGS = [c for c in SERIES_FLAGS if "_Lead_" in c]
CHECKS["assemble_future_table"] = f"""
    SELECT s.date, s.state_id, id, s.sell_price, promo, hike, sell_price_Lag_1 AS "sell_price_Lag_1",
           {", ".join(r6(c, c) for c in STAT_COLS)}, item_id, dept_id, cat_id, store_id,
           sd.* EXCLUDE (date) REPLACE ({", ".join(f"coalesce(sd.{c}, 0) AS {c}" for c in FUTURE_FLAGS)}),
           snap, "MLB", coalesce("MLB_Lead_1", 0) AS "MLB_Lead_1", coalesce("MLB_Lead_2", 0) AS "MLB_Lead_2",
           0 AS "Zero_Demand"
    FROM (SELECT *, lag(sell_price) OVER (PARTITION BY id ORDER BY date) AS sell_price_Lag_1 FROM spine) s
    JOIN (SELECT id, date, {FLAGS} FROM price_mean) USING (id, date)
    JOIN horizon_stats USING (id, date)
    JOIN series_days sd ON sd.date = s.date
    JOIN state_days st ON st.date = s.date AND st.state_id = s.state_id
    WHERE s.date >= {CUTOFF}"""
# The exports: the two tables without their date, and the horizon's keys.
TRAIN_EXPORT = f'SELECT * EXCLUDE (date) FROM ({CHECKS["assemble_series_model_table"]})'
EVAL_EXPORT = f'SELECT * EXCLUDE (date) FROM ({CHECKS["assemble_future_table"]})'
CHECKS["scan_prefix_union"] = f"SELECT * EXCLUDE (store_id) FROM ({TRAIN_EXPORT})"
CHECKS["sink_by_store"] = CHECKS["sink_by_store_dept"] = TRAIN_EXPORT
CHECKS["sink_train_eval_meta"] = f"""
    SELECT * FROM (
        WITH ahead AS MATERIALIZED ({CHECKS["assemble_future_table"]})
        SELECT 'train' AS part, * FROM ({TRAIN_EXPORT}) UNION ALL BY NAME SELECT 'eval' AS part, * EXCLUDE (date) FROM ahead
        UNION ALL BY NAME SELECT 'eval_meta' AS part, CAST(date AS VARCHAR) AS date, id, store_id FROM ahead)"""
CHECKS["assemble_future_table_sliced"] = (
    CHECKS["assemble_future_table"]
    .replace("JOIN series_days sd", "JOIN series_days_future sd")
    .replace("JOIN state_days st", "JOIN state_days_future st")
    .replace("sell_price_Lag_1 AS", f"CASE WHEN s.date = {CUTOFF} THEN 0.0::DOUBLE ELSE sell_price_Lag_1 END AS")
    .replace("sd.* EXCLUDE (date) REPLACE (", "sd.* EXCLUDE (date) REPLACE ("
             "coalesce(sd.event_Thanksgiving_Lag_1, 0) AS event_Thanksgiving_Lag_1, "
             "coalesce(sd.event_Christmas_Lag_1, 0) AS event_Christmas_Lag_1, ")
)
CHECKS["assemble_season_label_table"] = f"""
    SELECT s.id, s.date, s.v AS "Value", s.sell_price, label_days_season.* EXCLUDE (date, d, wm_yr_wk),
           {", ".join("i." + c for c in IDS.split(", "))}
    FROM spine s JOIN label_days_season ON s.date = label_days_season.date JOIN item_codes i ON i.id = s.id"""
CHECKS["join_restrict_to_target_ids"] = wide("a")
CHECKS["join_two_forecasts"] = f"SELECT id, key, {r6('a', 'value_x')}, {r6('b', 'value_y')} FROM fc"
TOP5 = """SELECT id, min("Value") AS min_v, max("Value") AS max_v, avg("Value") AS mean_v
          FROM sales GROUP BY id ORDER BY mean_v DESC, id LIMIT 5"""
CHECKS["join_top_items"] = f'SELECT id, d, "Value" FROM sales WHERE id IN (SELECT id FROM ({TOP5}))'
CHECKS["join_bottom_up_to_top"] = f"""
    SELECT key, {r6("bu", "bu")}, {r6("fcast", "fcast")}
    FROM (SELECT key, sum(a) AS bu FROM fc GROUP BY key) JOIN topfc USING (key)"""

# -- aggregates ---------------------------------------------------------------
def sum_by(keys: str) -> str:
    return f'SELECT date, {keys}, CAST(sum("Value") AS BIGINT) AS "Value" FROM sales GROUP BY ALL'


CHECKS["agg_by_state"] = sum_by("state_id")
CHECKS["agg_by_store"] = sum_by("store_id")
CHECKS["agg_by_dept"] = sum_by("dept_id")
CHECKS["agg_by_cat"] = sum_by("cat_id")
CHECKS["agg_by_store_dept"] = sum_by("store_id, dept_id")
CHECKS["agg_total"] = 'SELECT date, "Value" FROM top'
LEVELS = {
    "total": (), "state": ("state_id",), "store": ("store_id",), "cat": ("cat_id",), "dept": ("dept_id",),
    "store_dept": ("store_id", "dept_id"),
}
LEVEL_KEYS = ("cat_id", "dept_id", "state_id", "store_id")
CHECKS["agg_hierarchy_grouping_sets"] = " UNION ALL ".join(
    f"SELECT '{name}' AS level, date, "
    + ", ".join(k if k in keys else f"CAST(NULL AS VARCHAR) AS {k}" for k in LEVEL_KEYS)
    + f', CAST(sum("Value") AS BIGINT) AS "Value" FROM sales GROUP BY {", ".join(("date", *keys))}'
    for name, keys in LEVELS.items()
)
CHECKS["item_stats"] = f"""
    SELECT id, min("Value") AS min_v, max("Value") AS max_v, {r6('avg("Value")', "mean_v")} FROM sales GROUP BY id"""
CHECKS["agg_forecast_by_horizon"] = f"SELECT key, {r6('sum(a)', 'bu')} FROM fc GROUP BY key"
CHECKS["distinct_rows"] = "SELECT DISTINCT store_id, date FROM cells"
CHECKS["distinct_keys"] = "SELECT DISTINCT store_id FROM cells"
RANGE = "min(date) AS first_date, max(date) AS last_date, count(*) AS n_rows"
CHECKS["data_range_report"] = f"""
    SELECT 'spine' AS table_name, {RANGE} FROM spine UNION ALL SELECT 'train', {RANGE} FROM train
    UNION ALL SELECT 'future', {RANGE} FROM spine WHERE date >= {CUTOFF} UNION ALL SELECT 'cells', {RANGE} FROM cells"""

# -- metrics ------------------------------------------------------------------
SCORED = 'SELECT fc.id, fc.h, fc.a, fc.b, s."Value" FROM fc JOIN actuals s ON s.id = fc.id AND s.date = fc.date'
CHECKS["metric_rmse"] = " UNION ALL ".join(
    f"""SELECT '{m}' AS model, {r6(f'sqrt(avg(("Value" - {m}) * ("Value" - {m})))', "rmse")} FROM ({SCORED})""" for m in "ab"
)
CHECKS["metric_scaled_rmse"] = f"""
    SELECT id, round(sqrt(avg(power(("Value" - a) / nullif(scale, 0), 2))), 6) AS scaled_rmse
    FROM ({SCORED}) JOIN (SELECT id, avg(step) AS scale FROM (
        SELECT id, abs("Value" - lag("Value") OVER (PARTITION BY id ORDER BY date)) AS step FROM train) GROUP BY id) USING (id)
    GROUP BY id"""
CHECKS["minmax_scale"] = f"""
    SELECT id, date, "Value", CAST("Value" - lo AS DOUBLE) / nullif(hi - lo, 0) AS scaled
    FROM train JOIN (SELECT store_id, min("Value") AS lo, max("Value") AS hi FROM train GROUP BY store_id) USING (store_id)"""
CHECKS["submission_contract_check"] = f"""
    SELECT true AS columns_match, count(*) FILTER (sub.id IS NULL) AS missing_ids,
           count(*) FILTER (tpl.id IS NULL) AS extra_ids, CAST(0 AS BIGINT) AS repeated_ids
    FROM (SELECT DISTINCT id FROM {BOTH_IDS}) sub
    FULL JOIN (SELECT id FROM series UNION ALL SELECT replace(id, '_evaluation', '_validation') FROM series) tpl
      ON sub.id = tpl.id"""

# -- windows ------------------------------------------------------------------
CHECKS["lag_multi"] = f'SELECT id, date, v AS "Value", {LAGS} FROM spine'
CHECKS["rolling_mean_of_lags"] = f"""
    SELECT id, date, {", ".join(r6(
        f"CASE WHEN rn >= {n} THEN avg(lag_{k}) OVER (PARTITION BY id ORDER BY date ROWS {n - 1} PRECEDING) END",
        f"rmean_{k}_{n}") for k in (7, 28, 60) for n in (7, 28, 60))}
    FROM (SELECT id, date, row_number() OVER (PARTITION BY id ORDER BY date) AS rn, {LAGS} FROM spine)"""
for key, stat in (("rolling_mean_right", "Mean"), ("rolling_sd_right", "Sd"), ("rolling_slope_right", "Lm")):
    CHECKS[key] = f"SELECT id, date, {', '.join(r6(f'Roll_{stat}_{n}', f'Roll_{stat}_{n}') for n in WINDOWS)} FROM rolls"
CHECKS["rolling_shifted"] = f"SELECT id, date, {', '.join(r6(c, c) for c in STAT_COLS)} FROM shifted"
CHECKS["rolling_shifted_consistent"] = "SELECT id, date, " + ", ".join(
    r6(f"lag(Roll_{s}_{n}, 28) OVER (PARTITION BY id ORDER BY date)", f"Roll_{s}_{n}_Shift") for s in STATS for n in WINDOWS
) + " FROM rolls"


def centred(source: str, keys: str = "") -> str:
    part = f"PARTITION BY {keys} " if keys else ""
    return f"""SELECT *, CASE WHEN count(*) OVER f = 28 THEN stddev_samp("Value") OVER f END AS sd,
                      CASE WHEN count(*) OVER f = 28 THEN avg("Value") OVER f END AS m
               FROM {source} WINDOW f AS ({part}ORDER BY date ROWS BETWEEN 13 PRECEDING AND 14 FOLLOWING)"""


for key, source, keys in (("", "top", ""), ("_grouped", "store_dept", "store_id, dept_id")):
    part = f"PARTITION BY {keys} " if keys else ""
    cols = f"{keys}, " if keys else ""
    CHECKS[f"rolling_centered_shifted{key}"] = f"""
        SELECT date, {cols}"Value", {r6("sd28", "roll_sd_28")}, {r6("m28", "roll_mean_28")}
        FROM (SELECT *, lag(sd, 28) OVER w AS sd28, lag(m, 28) OVER w AS m28 FROM ({centred(source, keys)})
              WINDOW w AS ({part}ORDER BY date)) WHERE sd28 IS NOT NULL"""
    recent = f"(SELECT * FROM {source} WHERE date >= {CUTOFF} - 59)"
    CHECKS[f"future_rolling_centered{key}"] = f"""
        SELECT CAST(date + 28 AS DATE) AS date, {cols}"Value", {r6("coalesce(sd, 0)", "roll_sd_28")},
               {r6("coalesce(m, 0)", "roll_mean_28")}
        FROM ({centred(recent, keys)}) WHERE date >= {CUTOFF} - 28"""
CHECKS["future_rolling_shift"] = f"SELECT id, date, {', '.join(r6(c, c) for c in STAT_COLS)} FROM horizon_stats"
CHECKS["lead_features"] = with_total(
    f"SELECT date, {leads(HOLIDAYS, (1, 2))}, {leads(SPORTS, (1,))} FROM event_flags JOIN star USING (date)"
)
PADDED = ["NFL_Sun", "NCAA_Sat", "NBA_Finals", "USO_Sunday"]
CHECKS["lead_with_future_pad"] = f"""
    SELECT t.id, t.date, t."Value", {", ".join(f"l.{c}_Lead_{k}" for k in (1, 2) for c in PADDED)}
    FROM train t JOIN (SELECT date, {leads(PADDED, (1, 2))} FROM star) l USING (date)"""
CHECKS["holiday_lag_flags"] = with_total("""
    SELECT date, event_Thanksgiving, event_Christmas,
           lag(event_Thanksgiving) OVER (ORDER BY date) AS "event_Thanksgiving_Lag_1",
           lag(event_Christmas) OVER (ORDER BY date) AS "event_Christmas_Lag_1" FROM wide""")
CHECKS["dynamic_window_price_mean"] = f"SELECT id, date, sell_price, roll_mean FROM price_mean"
CHECKS["promo_hike_flags"] = f"SELECT id, date, sell_price, {FLAGS} FROM price_mean"
CHECKS["price_lag_diff_change"] = f"""
    SELECT id, date, sell_price, before AS "sell_price_Lag_1", sell_price - before AS sell_price_diff,
           (before - sell_price) / nullif(sell_price, 0) AS sell_price_change
    FROM (SELECT id, date, sell_price, lag(sell_price) OVER (PARTITION BY id ORDER BY date) AS before FROM spine)"""
CHECKS["horizon_index"] = f"""
    SELECT id, date, CAST(date - {CUTOFF} AS INTEGER) + 1 AS h FROM spine WHERE date >= {CUTOFF}"""
CHECKS["locf_fill"] = """
    SELECT id, date, "Value", sold, last_value(sold IGNORE NULLS) OVER (PARTITION BY id ORDER BY date) AS filled
    FROM (SELECT id, date, "Value", CASE WHEN "Value" > 0 THEN "Value" END AS sold FROM train)"""
CHECKS["tail_per_series"] = """
    SELECT id, date, "Value" FROM train QUALIFY row_number() OVER (PARTITION BY id ORDER BY date DESC) <= 60"""
CHECKS["apply_per_series"] = """
    SELECT id, date, CAST(date - max(CASE WHEN "Value" > 0 THEN date END) OVER (PARTITION BY id ORDER BY date) AS INTEGER)
           AS days_since FROM train"""

# -- top-k and unions ---------------------------------------------------------
CHECKS["topk_items"] = f"SELECT id, min_v, max_v, {r6('mean_v', 'mean_v')} FROM ({TOP5})"
GRID = "(SELECT unnest(range(96, 131)) / 100.0::DOUBLE AS mult)"
SEARCH = f"""SELECT mult, {r6("sqrt(avg((fcast - bu * mult) * (fcast - bu * mult)))", "rmse")}
    FROM (SELECT key, sum(b) AS bu FROM fc GROUP BY key) JOIN topfc USING (key) CROSS JOIN {GRID} GROUP BY mult"""
CHECKS["best_multiplier"] = f"SELECT * FROM ({SEARCH}) ORDER BY rmse, mult LIMIT 1"
CHECKS["union_validation_evaluation"] = wide("a", BOTH_IDS)
CHECKS["union_segments"] = f"SELECT id, h, {r6('a', 'pred')}, state_id FROM fc"
CHECKS["union_price_history_future"] = "SELECT DISTINCT id, date, sell_price FROM spine"

# -- encodings and scalars ----------------------------------------------------
CHECKS["label_encode_items"] = "SELECT * FROM item_codes"
CHECKS["label_encode_calendar"] = with_total("SELECT * FROM date_codes")
CHECKS["label_encode_events"] = with_total("SELECT * FROM event_codes")
CHECKS["date_parts"] = """
    SELECT id, date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
           CAST(day(date) AS INTEGER) AS monthday, CAST(dayofweek(date) + 1 AS INTEGER) AS weekday,
           CAST(quarter(date) AS INTEGER) AS quarter FROM cells"""
CHECKS["week_of_month"] = f"SELECT id, date, {WEEK_OF_MONTH} AS weekmonth FROM cells"
CHECKS["week_of_year_simple"] = f"SELECT id, date, {WEEK_OF_YEAR} AS week FROM cells"
CHECKS["event_name_clean"] = with_total("""
    SELECT date, key, event, 'event_' || regexp_replace(coalesce(event, 'NA'), '[^0-9A-Za-z]', '', 'g') AS clean
    FROM event_rows""")
CHECKS["series_key"] = """
    SELECT item_id, store_id, date, item_id || '_' || store_id AS store_item,
           item_id || '_' || store_id || '_evaluation' AS id FROM cells"""
CHECKS["path_to_series_id"] = """
    SELECT 'forecasts/eval_inference/' || id || '.csv.out' AS path, id FROM series"""
CHECKS["football_flags"] = with_total('SELECT date, weekday, "NFL_Sun", "NCAA_Sat" FROM star JOIN cal USING (date)')
CHECKS["null_fill_constant"] = f"""
    SELECT id, date, coalesce(lag_7, 0) AS lag_7, coalesce(lag_28, 0) AS lag_28, coalesce(lag_60, 1) AS lag_60
    FROM (SELECT id, date, {LAGS} FROM spine)"""
CHECKS["parse_us_date"] = """
    SELECT id, month(date) || '/' || day(date) || '/' || year(date) AS us_text, CAST(date AS VARCHAR) AS iso_text,
           date AS us_date, CAST(NULL AS VARCHAR) AS iso_date FROM cells"""
CHECKS["horizon_label_parse"] = f"""
    SELECT id, key, h, key AS label, 'd_' || CAST(h + {TRAIN_DAYS} AS VARCHAR) AS d FROM fc"""
CHECKS["shift_date_to_horizon"] = "SELECT id, date, CAST(date + 28 AS DATE) AS shifted FROM cells"
CHECKS["clip_nonnegative"] = f"""
    SELECT id, date, raw, CASE WHEN raw < 0 THEN 0 ELSE raw END AS clipped
    FROM (SELECT id, date, CAST(lag_7 - lag_28 AS DOUBLE) AS raw FROM (SELECT id, date, {LAGS} FROM spine))"""

# -- blends and reconciliation ------------------------------------------------
CHECKS["ensemble_mean"] = wide("(a + b) / 2")
CHECKS["scale_forecast"] = f"""
    SELECT id, key, {r6("a * mult", "value")}, mult
    FROM fc CROSS JOIN (SELECT unnest([0.97::DOUBLE, 0.99::DOUBLE, 1.01::DOUBLE, 1.03::DOUBLE]) AS mult)"""
CHECKS["multiplier_grid_search"] = SEARCH
CHECKS["multiplier_grid_search_items"] = f"""
    SELECT mult, {r6("sqrt(avg((a - fcast * mult) * (a - fcast * mult)))", "rmse")}
    FROM fc JOIN topfc USING (key) CROSS JOIN {GRID} GROUP BY mult"""
CHECKS["topdown_disaggregate"] = f"""
    SELECT id, h, {r6("b / nullif(sum(b) OVER (PARTITION BY store_id, dept_id, h), 0) * group_pred", "pred")}
    FROM fc JOIN (
        SELECT store_id, dept_id, CAST(date - {CUTOFF} AS INTEGER) + 1 AS h, date,
               avg(x) OVER (PARTITION BY store_id, dept_id ORDER BY date ROWS BETWEEN 55 PRECEDING AND 28 PRECEDING) AS group_pred
        FROM (SELECT store_id, dept_id, date, sum(v) AS x FROM spine GROUP BY ALL)) USING (store_id, dept_id, h)"""
CHECKS["flagship_forecast"] = wide("a", BOTH_IDS)

# -- models: what must hold of every forecast ---------------------------------
def sound(model: str, ids: str) -> str:
    return f"""
    SELECT '{model}' AS model, CAST(n AS BIGINT) AS n_ids, CAST(28 * n AS BIGINT) AS n_rows, true AS even_rows,
           true AS no_missing, true AS none_negative, true AS beats_mean
    FROM (SELECT count(*) AS n FROM ({ids}))"""


CHECKS["check_rf_total"] = sound("rf_total_forecast", "SELECT DISTINCT 'total' FROM series")
CHECKS["check_rf_store_dept"] = sound("rf_store_dept_forecast", "SELECT DISTINCT store_id, dept_id FROM series")
for model in ("rf_bottom", "gbm_global", "gbm_per_store", "gbm_tweedie", "glm_poisson", "glm_tweedie"):
    CHECKS[f"check_{model}"] = sound(f"{model}_forecast", "SELECT id FROM series")
CHECKS["check_feature_importance"] = """
    SELECT true AS named_once, true AS none_negative, true AS add_up, true AS some_stand_out"""
CHECKS["check_fitted_vs_actual"] = f"""
    SELECT count(*) AS n_days, min(date) AS first_day, max(date) AS last_day, CAST(sum("Value") AS BIGINT) AS total, true AS fits
    FROM ({CHECKS["assemble_top_level_table"]})"""
# Every split of every feature by value: rows, demand and fitted demand up to the value, and how
# much the Poisson loss falls when both sides take their own mean. Sums are in the learner's unit.
SPLIT_BY = ["weekday", "monthday", "month", "quarter", "dept_id", "store_id"]
POISSON_FALL = "CASE WHEN {b} <= 0 THEN 0 WHEN {a} <= 0 THEN {b} ELSE {a} * ln({a} / {b}) - {a} + {b} END"
FALLS = [POISSON_FALL.format(a=a, b=b) for a, b in (("la", "lb"), ("(ta - la)", "(tb - lb)"), ("ta", "tb"))]
CHECKS["check_first_split"] = f"""
    SELECT * FROM (WITH t AS MATERIALIZED (SELECT * FROM ({CHECKS["assemble_label_encoded_table"]}) WHERE date < {CUTOFF} AND "Value" IS NOT NULL),
    m AS (SELECT round(avg("Value"::DOUBLE) * 1048576) / 1048576 AS b FROM t),
    v AS ({" UNION ALL ".join(f"SELECT {k} AS k, '{c}' AS feature, {c} AS x, count(*) AS n, sum(\"Value\")::DOUBLE AS a FROM t GROUP BY {c}" for k, c in enumerate(SPLIT_BY))}),
    c AS (
        SELECT k, feature, dense_rank() OVER (PARTITION BY k ORDER BY x) AS bin, sum(n) OVER u AS ln_, sum(a) OVER u AS la,
               sum(n) OVER w AS tn, sum(a) OVER w AS ta
        FROM v WINDOW w AS (PARTITION BY k), u AS (PARTITION BY k ORDER BY x)),
    g AS (SELECT *, b * ln_ AS lb, b * tn AS tb FROM c, m WHERE ln_ >= 10 AND tn - ln_ >= 10)
    SELECT CASE WHEN feature = 'store_id' THEN 'store_code' ELSE feature END AS feature, CAST(bin AS INTEGER) AS bin,
           CAST(tn AS BIGINT) AS n_rows, round({FALLS[0]} + {FALLS[1]} - ({FALLS[2]}), 2) AS gain
    FROM g ORDER BY {FALLS[0]} + {FALLS[1]} DESC, k, bin LIMIT 1)"""
