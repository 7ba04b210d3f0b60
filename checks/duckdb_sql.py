"""The checked queries in SQL for DuckDB, written independently of the Spark plans.

Gaps are filled on an explicit calendar grid, holidays come from a generated date table, and
models are spelled out as aggregates. Pieces are common table expressions joined by ``query``.
"""

from __future__ import annotations

FINE, COARSE = 1024, 8

SALES = """sales AS (
  SELECT n.n_name AS state, CAST(o.o_orderdate AS DATE) AS ds,
         CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
         MIN(r.r_name) AS category
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY n.n_name, CAST(o.o_orderdate AS DATE))"""

GAPPY = """gappy AS (
  SELECT state, ds, CASE WHEN day(ds) <> 13 THEN total END AS total, category FROM sales)"""

GRID = """grid AS (
  SELECT state, CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds
  FROM sales GROUP BY state)"""


def snap(x: str, per_unit: int = FINE) -> str:
    return f"round(({x}) * {per_unit}) / {per_unit}"


def dense(source: str = "sales", name: str = "dense") -> str:
    return f"""{name}_marked AS (
  SELECT g.state, g.ds,
    last_value(s.total IGNORE NULLS) OVER back AS lt,
    last_value(CASE WHEN s.total IS NOT NULL THEN s.ds END IGNORE NULLS) OVER back AS ld,
    first_value(s.total IGNORE NULLS) OVER ahead AS rt,
    first_value(CASE WHEN s.total IS NOT NULL THEN s.ds END IGNORE NULLS) OVER ahead AS rd,
    last_value(s.category IGNORE NULLS) OVER back AS category
  FROM grid g LEFT JOIN {source} s ON g.state = s.state AND g.ds = s.ds
  WINDOW back AS (PARTITION BY g.state ORDER BY g.ds
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         ahead AS (PARTITION BY g.state ORDER BY g.ds
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
{name} AS (
  SELECT state, ds,
    CASE WHEN ld IS NULL THEN 0.0::DOUBLE
         WHEN rd IS NULL OR ld = ds THEN lt
         ELSE lt + (rt - lt) * datediff('day', ld, ds) / datediff('day', ld, rd) END AS total,
    category
  FROM {name}_marked)"""


HOLIDAYS = """days AS (
  SELECT CAST(unnest(generate_series(min(ds) - 400, max(ds) + 400, INTERVAL 1 DAY)) AS DATE) AS d
  FROM sales),
fixed_days AS (
  SELECT d FROM days
  WHERE strftime(d, '%m-%d') IN ('01-01', '07-04', '11-11', '12-25')
     OR (strftime(d, '%m-%d') = '06-19' AND year(d) >= 2021)),
monthly AS (
  SELECT d, month(d) AS m, isodow(d) AS wd,
    row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d) AS nth,
    row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d DESC) AS nth_last
  FROM days),
holidays AS (
  SELECT d FROM fixed_days
  UNION SELECT d - 1 FROM fixed_days WHERE isodow(d) = 6
  UNION SELECT d + 1 FROM fixed_days WHERE isodow(d) = 7
  UNION SELECT d FROM monthly WHERE (wd = 1 AND nth = 3 AND m = 1 AND year(d) >= 1986)
     OR (wd = 1 AND nth = 3 AND m = 2) OR (wd = 1 AND nth_last = 1 AND m = 5)
     OR (wd = 1 AND nth = 1 AND m = 9) OR (wd = 1 AND nth = 2 AND m = 10)
     OR (wd = 4 AND nth = 4 AND m = 11))"""

INTEGER_CALENDAR = {
    "day_of_week": "isodow(ds) - 1",
    "month": "month(ds)",
    "day_of_month": "day(ds)",
    "week_of_year": "weekofyear(ds)",
    "year": "year(ds)",
    "is_weekend": "isodow(ds) >= 6",
    "is_holiday": "ds IN (SELECT d FROM holidays)",
}
WAVES = {
    "day_of_week_sin": "sin(2 * pi() * (isodow(ds) - 1) / 7)",
    "day_of_week_cos": "cos(2 * pi() * (isodow(ds) - 1) / 7)",
    "month_sin": "sin(2 * pi() * month(ds) / 12)",
    "month_cos": "cos(2 * pi() * month(ds) / 12)",
}
CALENDAR = ", ".join(
    [f"CAST({sql} AS INTEGER) AS {name}" for name, sql in INTEGER_CALENDAR.items()]
    + [f"round({sql}, 8) AS {name}" for name, sql in WAVES.items()]
)
LAG_NAMES = ["lag_1", "lag_7", "lag_30"]
LAGS = ", ".join(f"lag(total, {k}) OVER w AS lag_{k}" for k in (1, 7, 30))
ROLL_NAMES = [f"rolling_{s}_{k}" for k in (7, 30) for s in ("mean", "std", "min", "max")]
W = "WINDOW w AS (PARTITION BY state ORDER BY ds)"


def rolling(last: str = "CURRENT ROW", shift: int = 0) -> str:
    out = []
    for k in (7, 30):
        frame = (
            "(PARTITION BY state ORDER BY ds "
            f"ROWS BETWEEN {k - 1 + shift} PRECEDING AND {last})"
        )
        out += [
            f"{snap(f'avg(total) OVER {frame}')} AS rolling_mean_{k}",
            f"{snap(f'coalesce(stddev_samp(total) OVER {frame}, 0)')} AS rolling_std_{k}",
            f"min(total) OVER {frame} AS rolling_min_{k}",
            f"max(total) OVER {frame} AS rolling_max_{k}",
        ]
    return ", ".join(out)


FEATURES = f"""features AS (
  SELECT ds, state, total, category, {CALENDAR}, {LAGS}, {rolling()} FROM dense {W})"""
FEATURE_NAMES = [*INTEGER_CALENDAR, *WAVES, *LAG_NAMES, *ROLL_NAMES]

SPLIT = """numbered AS (
  SELECT *, row_number() OVER (PARTITION BY state ORDER BY ds) AS rn,
         count(*) OVER (PARTITION BY state) AS n FROM dense),
cut AS (
  SELECT *, CAST(floor(n * 0.8::DOUBLE) AS BIGINT) AS n_train FROM numbered),
split AS (
  SELECT state, ds, total, category,
    CASE WHEN rn <= n_train THEN 'train' ELSE 'test' END AS split,
    CASE WHEN rn <= CAST(floor(n_train * 0.8::DOUBLE) AS BIGINT) THEN 'base'
         WHEN rn <= n_train THEN 'meta' ELSE 'test' END AS part
  FROM cut),
train AS (SELECT * FROM split WHERE split = 'train'),
test AS (SELECT * FROM split WHERE split = 'test'),
base AS (SELECT * FROM split WHERE part = 'base'),
meta AS (SELECT * FROM split WHERE part = 'meta')"""


def horizon(source: str = "dense", name: str = "future", days: int = 56) -> str:
    return f"""{name} AS (
  SELECT state, CAST(unnest(generate_series(max(ds) + 1, max(ds) + {days}, INTERVAL 1 DAY)) AS DATE)
         AS ds FROM {source} GROUP BY state)"""


def last_value(history: str, targets: str, name: str) -> str:
    return f"""{name} AS (
  SELECT t.state, 'LastValue' AS model, t.ds, greatest(f.last_total, 0.0) AS yhat
  FROM {targets} t JOIN (SELECT state, arg_max(total, ds) AS last_total FROM {history}
                         GROUP BY state) f ON t.state = f.state)"""


def ar1_fit(history: str, name: str) -> str:
    return f"""{name} AS (
  SELECT state, regr_slope(total, previous) AS phi, regr_intercept(total, previous) AS intercept,
         max(ds) AS last_ds, arg_max(total, ds) AS last_total
  FROM (SELECT *, lag(total) OVER (PARTITION BY state ORDER BY ds) AS previous FROM {history})
  GROUP BY state)"""


AR1_PATH = "intercept / (1 - phi) + pow(phi, {h}) * (last_total - intercept / (1 - phi))"


def ar1(history: str, targets: str, name: str) -> str:
    path = AR1_PATH.format(h="datediff('day', last_ds, t.ds)")
    return f"""{ar1_fit(history, f'{name}_fit')},
{name} AS (
  SELECT t.state, 'ARIMA' AS model, t.ds,
    greatest(CASE WHEN abs(phi) < 1 THEN {path} ELSE last_total END, 0.0) AS yhat
  FROM {targets} t JOIN {name}_fit f ON t.state = f.state)"""


def trend_fit(history: str, name: str) -> str:
    return f"""{name}_rows AS (
  SELECT h.state, h.ds, greatest(total, 0.0) AS y, first_ds,
         datediff('day', first_ds, h.ds) AS t
  FROM {history} h JOIN (SELECT state, min(ds) AS first_ds FROM {history} GROUP BY state) b
    ON h.state = b.state),
{name}_line AS (
  SELECT state, min(first_ds) AS first_ds, regr_slope(y, t) AS slope,
         regr_intercept(y, t) AS level FROM {name}_rows GROUP BY state),
{name}_based AS (
  SELECT r.state, r.ds, r.y, isodow(r.ds) - 1 AS wd, month(r.ds) AS m,
         greatest(slope * t + level, 0.0) AS b
  FROM {name}_rows r JOIN {name}_line l ON r.state = l.state),
{name}_wd AS (
  SELECT state, wd, coalesce(avg(CASE WHEN b > 0 THEN y / b END), 1.0) AS wi
  FROM {name}_based GROUP BY state, wd),
{name}_m AS (
  SELECT b.state, m, coalesce(avg(CASE WHEN b * wi > 0 THEN y / (b * wi) END), 1.0) AS mi
  FROM {name}_based b JOIN {name}_wd w ON b.state = w.state AND b.wd = w.wd GROUP BY b.state, m)"""


def trend(history: str, targets: str, name: str) -> str:
    return f"""{trend_fit(history, name + '_t')},
{name} AS (
  SELECT t.state, 'Prophet' AS model, t.ds,
    greatest(greatest(slope * datediff('day', first_ds, t.ds) + level, 0.0)
             * coalesce(wi, 1.0) * coalesce(mi, 1.0), 0.0) AS yhat
  FROM {targets} t JOIN {name}_t_line l ON t.state = l.state
  LEFT JOIN {name}_t_wd w ON t.state = w.state AND isodow(t.ds) - 1 = w.wd
  LEFT JOIN {name}_t_m q ON t.state = q.state AND month(t.ds) = q.m)"""


def two(history: str, targets: str, name: str) -> str:
    return f"""{ar1(history, targets, name + '_a')}, {trend(history, targets, name + '_p')},
{name} AS (SELECT * FROM {name}_a UNION ALL SELECT * FROM {name}_p)"""


def three(history: str, targets: str, name: str) -> str:
    return f"""{two(history, targets, name + '_2')}, {last_value(history, targets, name + '_l')},
{name} AS (SELECT * FROM {name}_2 UNION ALL SELECT * FROM {name}_l)"""


METRICS = """avg(abs(yhat - total)) AS mae,
    sqrt(avg((yhat - total) * (yhat - total))) AS rmse,
    coalesce(avg(CASE WHEN total <> 0 THEN abs((total - yhat) / total) END) * 100,
             CAST('inf' AS DOUBLE)) AS mape"""
ROUNDED = f"{snap('mae', COARSE)} AS mae, {snap('rmse', COARSE)} AS rmse, round(mape, 4) AS mape"


def scores(predictions: str = "pred", actuals: str = "test", name: str = "scores") -> str:
    return f"""{name} AS (
  SELECT p.state, p.model, {METRICS}
  FROM {predictions} p JOIN {actuals} a ON p.state = a.state AND p.ds = a.ds
  GROUP BY p.state, p.model)"""


RANK = """CASE model WHEN 'ARIMA' THEN 1 WHEN 'XGBoost' THEN 2 WHEN 'LSTM' THEN 3
  WHEN 'Prophet' THEN 4 WHEN 'StackedEnsemble' THEN 5 ELSE 0 END"""


def ranked(by: str, name: str = "ranked") -> str:
    return f"""{name} AS (
  SELECT *, row_number() OVER (PARTITION BY state ORDER BY {by}, {RANK}) AS rank FROM scores)"""


def significant(x: str, bits: int = 20) -> str:
    unit = f"pow(2.0::DOUBLE, floor(log2(abs({x}))) - {bits})"
    return f"CASE WHEN {x} = 0 THEN 0.0 ELSE round({x} / {unit}) * {unit} END"


def query(*pieces: str, recursive: bool = False) -> str:
    *ctes, final = pieces
    return f"WITH {'RECURSIVE ' * recursive}{', '.join(ctes)} {final}" if ctes else final


# The same ensemble of stumps, on features in units of the range of their series.
def stump_sum() -> str:
    lag = "(coalesce(ys[-{0}], 0.0) - lo) / width"
    features = {
        "lag_1": lag.format(1), "lag_7": lag.format(7), "lag_30": lag.format(30),
        "rolling_mean_7": "(coalesce(list_avg(ys[-6:]), 0.0) - lo) / width",
        "rolling_min_7": "(coalesce(list_min(ys[-6:]), 0.0) - lo) / width",
        "rolling_max_30": "(coalesce(list_max(ys[-29:]), 0.0) - lo) / width",
        "rolling_std_30": "coalesce(list_stddev_samp(ys[-29:]), 0.0) / width",
        "day_of_week": "isodow(last_ds + step + 1) - 1",
    }
    stumps = (
        (1.0, "lag_7", 0.4137, 0.3, 0.55), (0.5, "rolling_mean_7", 0.5171, -0.1, 0.15),
        (0.5, "day_of_week", 4.0, 0.05, -0.2), (0.25, "lag_1", 0.3919, 0.2, -0.15),
        (0.25, "rolling_std_30", 0.1573, 0.1, -0.1), (0.25, "rolling_min_7", 0.2113, -0.05, 0.1),
        (0.125, "rolling_max_30", 0.8219, 0.3, -0.2), (0.125, "lag_30", 0.4493, -0.25, 0.35),
    )
    return " + ".join(
        f"{w}::DOUBLE * CASE WHEN {features[f]} <= {t} THEN {low} ELSE {high} END" for w, f, t, low, high in stumps
    )


RECURSION = f"""starts AS (
  SELECT state, max(ds) AS last_ds, min(total) AS lo,
    CASE WHEN max(total) = min(total) THEN 1.0 ELSE max(total) - min(total) END AS width,
    (list(total ORDER BY ds))[-30:] AS ys
  FROM dense GROUP BY state),
paths AS (
  SELECT state, last_ds, lo, width, ys, 0 AS step, NULL::DOUBLE AS yhat FROM starts
  UNION ALL
  SELECT state, last_ds, lo, width, list_append(ys, y)[-30:], step + 1, y
  FROM (SELECT *, greatest(({stump_sum()}) * width + lo, 0.0) AS y FROM paths WHERE step < 56))"""


DENSE = (SALES, GRID, dense())
FULL = (*DENSE, HOLIDAYS, FEATURES)
PARTS = (*DENSE, SPLIT)
SCORED = (*PARTS, three("train", "test", "pred"), scores())
PLACES = """places AS (SELECT n_name AS state FROM nation UNION ALL SELECT r_name FROM region)"""
SUMS = ("steps", "oldest", "newest", "step_sum")

# Stacking with two bases: centred cross products, penalty 1, closed 2 x 2 solution.
PAIR = f"""pivoted AS (
  SELECT state, ds, max(CASE WHEN model = 'Prophet' THEN yhat END) AS p,
         max(CASE WHEN model = 'ARIMA' THEN yhat END) AS a FROM on_meta GROUP BY state, ds),
moments AS (
  SELECT v.state, avg(p) AS mp, avg(a) AS ma, avg(total) AS my,
    covar_samp(p, p) * (count(*) - 1) + 1 AS pp, covar_samp(a, a) * (count(*) - 1) + 1 AS aa,
    covar_samp(p, a) * (count(*) - 1) AS pa, covar_samp(p, total) * (count(*) - 1) AS py,
    covar_samp(a, total) * (count(*) - 1) AS ay
  FROM pivoted v JOIN meta t ON v.state = t.state AND v.ds = t.ds
  GROUP BY v.state HAVING count(*) >= 10),
weights AS (
  SELECT state, (py * aa - ay * pa) / (pp * aa - pa * pa) AS wp,
         (ay * pp - py * pa) / (pp * aa - pa * pa) AS wa, mp, ma, my FROM moments),
stack AS (SELECT state, wp, wa, my - wp * mp - wa * ma AS w0 FROM weights)"""

def winners(days: int = 56) -> str:
    return f"""{two('train', 'test', 'pred')}, {scores()}, {ranked('rmse')},
{horizon(days=days)}, {two('dense', 'future', 'ahead')},
ends AS (SELECT state, max(ds) AS last_ds FROM dense GROUP BY state),
winners AS (
  SELECT a.state, a.model AS model_used, a.ds, a.yhat, e.last_ds
  FROM ahead a JOIN ranked r ON a.state = r.state AND a.model = r.model AND r.rank = 1
  JOIN ends e ON a.state = e.state)"""


WINNERS = winners()

# Rows of single orders, several per day.
ORDER_ROWS = """rows AS (
  SELECT n_name AS state, CAST(o_orderdate AS DATE) AS ds,
    CASE WHEN day(o_orderdate) <> 13 THEN o_totalprice END AS total, o_orderpriority AS category
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
grid AS (
  SELECT state, CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds
  FROM rows GROUP BY state),
ends AS (
  SELECT g.state, g.ds,
    arg_min(total, (category, total)) FILTER (total IS NOT NULL) AS first_total,
    arg_max(total, (category, total)) FILTER (total IS NOT NULL) AS last_total,
    max(category) AS category, count(r.state) AS n
  FROM grid g LEFT JOIN rows r ON g.state = r.state AND g.ds = r.ds GROUP BY g.state, g.ds),
known AS (SELECT * FROM ends WHERE last_total IS NOT NULL),
marked AS (
  SELECT e.state, e.ds, e.n, l.ds AS ld, l.last_total AS lt,
    last_value(e.category IGNORE NULLS) OVER (PARTITION BY e.state ORDER BY e.ds) AS category
  FROM ends e ASOF LEFT JOIN known l ON e.state = l.state AND e.ds >= l.ds),
filled AS (
  SELECT m.state, m.ds, m.n, m.category,
    CASE WHEN ld IS NULL THEN 0.0::DOUBLE WHEN r.ds IS NULL OR ld = m.ds THEN lt
         ELSE lt + (r.first_total - lt) * datediff('day', ld, m.ds) / datediff('day', ld, r.ds)
    END AS fill
  FROM marked m ASOF LEFT JOIN known r ON m.state = r.state AND m.ds < r.ds),
kept AS (
  SELECT r.state, r.ds, coalesce(r.total, f.fill) AS total, r.category
  FROM rows r JOIN filled f ON r.state = f.state AND r.ds = f.ds
  UNION ALL SELECT state, ds, fill, category FROM filled WHERE n = 0)"""


def oracle() -> dict[str, str]:
    q: dict[str, str] = {}
    q["sales_daily"] = query(SALES, "SELECT * FROM sales")
    q["profile"] = query(
        SALES,
        """SELECT count(*) AS n_rows, count(DISTINCT state) AS n_states, min(ds) AS first_ds,
        max(ds) AS last_ds, CAST(4 AS INTEGER) AS n_columns FROM sales""",
    )
    q["state_list"] = query(SALES, "SELECT DISTINCT state FROM sales ORDER BY state")
    q["first_states"] = query(SALES, "SELECT DISTINCT state FROM sales ORDER BY state LIMIT 10")
    q["date_bounds"] = query(
        SALES, "SELECT state, min(ds) AS first_ds, max(ds) AS last_ds FROM sales GROUP BY state"
    )
    q["filter_states"] = query(
        SALES, "SELECT * FROM sales WHERE state IN ('NATION_2', 'NATION_7', 'NATION_20')"
    )
    q["sorted_series"] = query(SALES, "SELECT * FROM sales ORDER BY state, ds")
    q["parsed_dates"] = (
        "SELECT event_id, CAST(ts AS DATE) AS ds, CAST(ts AS DATE) AS ds_of_text FROM events"
    )
    q["coerced_numbers"] = """SELECT o_orderkey,
        CASE WHEN o_orderstatus = 'F' THEN TRY_CAST(o_orderpriority AS DOUBLE)
             ELSE o_totalprice END AS price,
        TRY_CAST(left(o_orderpriority, 1) AS DOUBLE) AS code FROM orders"""
    q["conformed_future"] = query(
        *DENSE, horizon(),
        """SELECT f.ds, f.state, CAST(NULL AS DOUBLE) AS total, c.category FROM future f
        JOIN (SELECT state, arg_min(category, ds) AS category FROM dense GROUP BY state) c
        ON f.state = c.state""",
    )
    q["known_states"] = query(
        SALES, PLACES, "SELECT state FROM places WHERE state IN (SELECT state FROM sales)"
    )
    q["unknown_states"] = query(
        SALES, PLACES, "SELECT state FROM places WHERE state NOT IN (SELECT state FROM sales)"
    )
    q["densify"] = query(*DENSE, "SELECT * FROM dense")
    q["densify_nulls"] = query(SALES, GAPPY, GRID, dense("gappy"), "SELECT * FROM dense")
    q["densify_kept_rows"] = query(ORDER_ROWS, "SELECT state, ds, total, category FROM kept")
    kept_window = "(PARTITION BY state ORDER BY ds, category, total"
    kept_rolls = []
    for k in (7, 30):
        frame = f"{kept_window} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
        kept_rolls += [
            f"{snap(f'avg(total) OVER {frame}')} AS rolling_mean_{k}",
            f"{snap(f'coalesce(stddev_samp(total) OVER {frame}, 0)')} AS rolling_std_{k}",
            f"min(total) OVER {frame} AS rolling_min_{k}",
            f"max(total) OVER {frame} AS rolling_max_{k}",
        ]
    q["features_kept_rows"] = query(
        ORDER_ROWS, HOLIDAYS.replace("FROM sales", "FROM rows"),
        f"""SELECT state, ds, category, total, row_number() OVER {kept_window}) AS rn,
        count(*) OVER (PARTITION BY state) AS n_rows, {CALENDAR},
        {', '.join(f'lag(total, {k}) OVER {kept_window}) AS lag_{k}' for k in (1, 7, 30))},
        {', '.join(kept_rolls)} FROM kept""",
    )
    gaps = "grid g LEFT JOIN sales s ON g.state = s.state AND g.ds = s.ds"
    q["spine_gaps"] = query(SALES, GRID, f"SELECT g.state, g.ds, total, category FROM {gaps}")
    q["forward_fill"] = query(
        SALES, GRID,
        f"""SELECT g.state, g.ds, last_value(total IGNORE NULLS) OVER w AS total,
        last_value(category IGNORE NULLS) OVER w AS category FROM {gaps}
        WINDOW w AS (PARTITION BY g.state ORDER BY g.ds)""",
    )
    q["calendar_features"] = query(
        *DENSE, HOLIDAYS, f"SELECT state, ds, {CALENDAR} FROM dense"
    )
    q["holiday_flag"] = query(
        *DENSE, HOLIDAYS,
        """SELECT DISTINCT ds, CAST(ds IN (SELECT d FROM holidays) AS INTEGER) AS is_holiday
        FROM dense""",
    )
    q["lag_features"] = query(*DENSE, f"SELECT state, ds, {LAGS} FROM dense {W}")
    q["rolling_features"] = query(*DENSE, f"SELECT state, ds, {rolling()} FROM dense")
    q["rolling_before"] = query(
        *DENSE, f"SELECT state, ds, {rolling('1 PRECEDING', 1)} FROM dense"
    )
    q["all_features"] = query(*FULL, "SELECT * FROM features")
    complete = " AND ".join(f"{name} IS NOT NULL" for name in FEATURE_NAMES)
    q["training_rows"] = query(*FULL, f"SELECT * FROM features WHERE {complete}")
    q["training_rows_with_target"] = query(
        *FULL, f"SELECT * FROM features WHERE {complete} AND day(ds) <> 13"
    )
    q["filled_features"] = query(
        SALES, GRID,
        f"""lags AS (SELECT g.state, g.ds, {LAGS} FROM {gaps}
        WINDOW w AS (PARTITION BY g.state ORDER BY g.ds))""",
        "SELECT state, ds, "
        + ", ".join(f"coalesce(last_value({n} IGNORE NULLS) OVER w, 0.0) AS {n}" for n in LAG_NAMES)
        + f" FROM lags {W}",
    )
    q["split_sizes"] = query(
        *PARTS,
        """SELECT state, count(*) FILTER (split = 'train') AS train_size,
        count(*) FILTER (split = 'test') AS test_size FROM split GROUP BY state""",
    )
    q["nested_split"] = query(*PARTS, "SELECT state, ds, split, part FROM split")
    short = SALES.replace("sales AS", "all_sales AS") + """, sales AS (SELECT * FROM all_sales
      WHERE NOT (category = 'ASIA' AND ds >= DATE '1995-02-25')
        AND NOT (category = 'AMERICA' AND ds >= DATE '1995-05-10'))"""
    q["min_history"] = query(
        short, SPLIT.replace("FROM dense", "FROM sales"),
        """SELECT state, ds, total, category, split FROM split WHERE state IN (
        SELECT state FROM split WHERE split = 'train' GROUP BY state HAVING count(*) >= 50)""",
    )
    q["tuning_guard"] = query(
        short, GRID, dense(), HOLIDAYS, FEATURES,
        f"""counts AS (SELECT state, count(*) AS n FROM features WHERE {complete} GROUP BY state)""",
        """SELECT state, CAST(l AS INTEGER) AS length, n, n >= 100 AS can_tune,
        n >= l + 10 AS can_fit FROM counts, (VALUES (21), (30)) g(l)""",
    )
    q["regenerated_features"] = q["all_features"]
    q["found_input"] = query(
        SALES,
        "SELECT state, count(*) AS n, min(ds) AS first_ds, max(ds) AS last_ds FROM sales GROUP BY state",
    )
    q["progress_latest"] = query(
        SALES,
        """SELECT state, CASE WHEN min(category) = 'ASIA' THEN 'skipped' ELSE 'ok' END AS status,
        count(*) AS n_rows FROM sales GROUP BY state""",
    )
    q["unsettled_states"] = query(
        SALES,
        """SELECT state, count(*) AS n FROM sales WHERE category = 'AFRICA'
        OR category = 'ASIA' AND state IN ('NATION_2', 'NATION_12') GROUP BY state""",
    )
    scaled = ("total", "lag_1", "lag_30", "day_of_month")
    stats = ", ".join(
        f"CAST(min({n}) AS DOUBLE) AS {n}_min, CASE WHEN max({n}) = min({n}) THEN 1.0 "
        f"ELSE CAST(max({n}) - min({n}) AS DOUBLE) END AS {n}_range"
        for n in scaled
    )
    with_stats = (
        *FULL, SPLIT,
        f"""stats AS (SELECT state, {stats}
        FROM (SELECT state, ds, total, lag_1, lag_30, day_of_month FROM features)
        JOIN (SELECT state, ds FROM train) USING (state, ds) GROUP BY state)""",
    )
    q["minmax_stats"] = query(*with_stats, "SELECT * FROM stats")
    q["minmax_scaled"] = query(
        *with_stats,
        "SELECT state, ds, "
        + ", ".join(f"round(({n} - {n}_min) / {n}_range, 9) AS {n}" for n in scaled)
        + " FROM features JOIN stats USING (state)",
    )
    q["minmax_round_trip"] = query(*DENSE, f"SELECT state, ds, {snap('total')} AS total FROM dense")
    q["lookback_sequences"] = query(
        *DENSE,
        f"""SELECT state, ds, CAST(30 AS INTEGER) AS steps, lag(total, 30) OVER w AS oldest,
        lag(total, 1) OVER w AS newest, {snap('''sum(total) OVER (PARTITION BY state ORDER BY ds
        ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)''')} AS step_sum FROM dense {W}
        QUALIFY row_number() OVER w > 30""",
    )
    past = "(PARTITION BY state ORDER BY ds ROWS BETWEEN {} PRECEDING AND 1 PRECEDING)"
    p30, p14 = past.format(30), past.format(14)
    q["padded_sequences"] = query(
        SALES,
        f"""SELECT state, ds, CAST(count(*) OVER p AS INTEGER) AS known,
        first_value(total) OVER p AS oldest, last_value(total) OVER p AS newest,
        {snap('sum(total) OVER p + (30 - count(*) OVER p) * first_value(total) OVER p')}
        AS step_sum FROM sales WINDOW p AS {p30}""",
    )
    q["held_sequences"] = query(
        *DENSE,
        """tail AS (SELECT state, total, row_number() OVER (PARTITION BY state ORDER BY ds DESC)
        AS back FROM dense),
        ends AS (SELECT state, max(total) FILTER (back = 1) AS newest FROM tail GROUP BY state),
        steps AS (SELECT state, newest, unnest(generate_series(1, 40)) AS step FROM ends)""",
        f"""SELECT s.state, CAST(s.step AS INTEGER) AS step,
        coalesce(max(t.total) FILTER (t.back = 31 - s.step), s.newest) AS oldest, s.newest,
        {snap('''coalesce(sum(t.total) FILTER (t.back <= 31 - s.step), 0)
        + least(s.step - 1, 30) * s.newest''')} AS step_sum
        FROM steps s JOIN tail t ON s.state = t.state AND t.back <= 30
        GROUP BY s.state, s.step, s.newest""",
    )
    q["seasonal_diff"] = query(
        *DENSE,
        f"""SELECT state, ds, (total - lag(total, 1) OVER w)
        - (lag(total, 7) OVER w - lag(total, 8) OVER w) AS diff FROM dense {W}""",
    )
    q["last_value_metrics"] = query(
        *PARTS, last_value("train", "test", "pred"), scores(),
        f"SELECT state, model, {ROUNDED} FROM scores",
    )
    q["mape_zero_mask"] = query(
        *PARTS, last_value("train", "test", "pred"),
        """masked AS (SELECT state, ds, CASE WHEN day(ds) = 13 OR state = 'NATION_4' THEN 0.0
        ELSE total END AS total FROM test)""",
        scores("pred", "masked"),
        f"SELECT state, model, {ROUNDED} FROM scores",
    )
    q["evaluate_models"] = query(*SCORED, f"SELECT state, model, {ROUNDED} FROM scores")
    q["evaluate_missing"] = query(
        *PARTS, ar1("train", "test", "pred"), scores(),
        f"""SELECT state, model, {ROUNDED} FROM scores UNION ALL
        SELECT DISTINCT state, 'LSTM', CAST('inf' AS DOUBLE), CAST('inf' AS DOUBLE),
        CAST('inf' AS DOUBLE) FROM dense""",
    )
    q["evaluate_with_bad_series"] = query(
        *SCORED,
        f"""SELECT state, model, {ROUNDED} FROM scores WHERE state <> 'NATION_3' UNION ALL
        SELECT 'NATION_3', model, CAST('inf' AS DOUBLE), CAST('inf' AS DOUBLE),
        CAST('inf' AS DOUBLE) FROM (VALUES ('ARIMA'), ('Prophet'), ('LastValue')) m(model)""",
    )
    seasonal = """marked AS (SELECT *, row_number() OVER s AS rn,
          avg(abs(total)) OVER (PARTITION BY state) AS unit,
          total - lag(total, 7) OVER s AS w0,
          total - lag(total, 7) OVER s - lag(total, 1) OVER s + lag(total, 8) OVER s AS w1
        FROM train WINDOW s AS (PARTITION BY state ORDER BY ds)),
        diffed AS (SELECT state, ds, rn, 0 AS d, w0 / unit AS w FROM marked
          UNION ALL SELECT state, ds, rn, 1, w1 / unit FROM marked)"""
    q["seasonal_row_counts"] = query(
        *PARTS, seasonal,
        """SELECT state, count(w) AS n, min(ds) AS first_ds, CAST(d AS INTEGER) AS d FROM diffed
        WHERE rn >= 32 GROUP BY state, d""",
    )
    q["seasonal_autocovariances"] = query(
        *PARTS, seasonal,
        """SELECT a.state, CAST(a.d AS INTEGER) AS d, CAST(lag AS INTEGER) AS lag,
        round(sum(a.w * b.w) / any_value(total), 6) AS share
        FROM diffed a, generate_series(1, 14) g(lag), diffed b,
          (SELECT state, d, sum(w * w) AS total FROM diffed GROUP BY state, d) t
        WHERE a.state = b.state AND a.d = b.d AND b.rn = a.rn - lag
          AND t.state = a.state AND t.d = a.d GROUP BY a.state, a.d, lag""",
    )
    q["seasonal_fixed_order"] = query(
        *PARTS, seasonal,
        """lagged AS (SELECT state, rn, w, lag(w, 1) OVER s AS x, lag(w, 7) OVER s AS y,
          lag(w, 8) OVER s AS z FROM diffed WHERE d = 0 WINDOW s AS (PARTITION BY state ORDER BY rn)),
        sums AS (SELECT state, count(*) AS n, sum(x * x) + 1e-6 AS xx, sum(y * y) + 1e-6 AS yy,
          sum(z * z) + 1e-6 AS zz, sum(x * y) AS xy, sum(x * z) AS xz, sum(y * z) AS yz,
          sum(x * w) AS xw, sum(y * w) AS yw, sum(z * w) AS zw
          FROM lagged WHERE rn >= 31 GROUP BY state),
        solved AS (SELECT *, xx * (yy * zz - yz * yz) - xy * (xy * zz - yz * xz)
          + xz * (xy * yz - yy * xz) AS det FROM sums)""",
        """SELECT state, n,
        round((xw * (yy * zz - yz * yz) - xy * (yw * zz - yz * zw) + xz * (yw * yz - yy * zw)) / det, 5)
          AS lag_1,
        round((xx * (yw * zz - yz * zw) - xw * (xy * zz - yz * xz) + xz * (xy * zw - yw * xz)) / det, 5)
          AS lag_7,
        round((xx * (yy * zw - yw * yz) - xy * (xy * zw - yw * xz) + xw * (xy * yz - yy * xz)) / det, 5)
          AS lag_8 FROM solved""",
    )
    for by in ("rmse", "mape"):
        q[f"best_by_{by}"] = query(
            *SCORED, ranked(by),
            f"SELECT state, model AS best_model, {ROUNDED} FROM ranked WHERE rank = 1",
        )
    q["leaderboard"] = query(
        *SCORED, ranked("mape"),
        f"SELECT state, model, {ROUNDED}, CAST(rank AS INTEGER) AS rank FROM ranked",
    )
    q["run_summary"] = query(
        *SCORED, ranked("rmse"),
        """SELECT model AS best_model, count(*) AS n_states FROM ranked WHERE rank = 1
        GROUP BY model""",
    )
    q["model_counts"] = query(
        *PARTS, three("train", "test", "pred"),
        """SELECT state, count(DISTINCT model) AS n_models FROM pred
        WHERE model IN ('XGBoost', 'Prophet', 'ARIMA', 'LSTM') GROUP BY state""",
    )
    q["predictions_aligned"] = query(
        *PARTS, two("train", "test", "pred"),
        f"""SELECT p.state, p.ds, p.model, {snap('yhat', COARSE)} AS yhat, t.total AS actual
        FROM pred p JOIN test t ON p.state = t.state AND p.ds = t.ds""",
    )
    q["last_value_forecast"] = query(
        *DENSE, horizon(), last_value("dense", "future", "pred"), "SELECT * FROM pred"
    )
    q["zero_forecast"] = query(
        *DENSE, horizon(),
        "SELECT state, 'XGBoost' AS model, ds, CAST(0 AS DOUBLE) AS yhat FROM future",
    )
    q["ar1_fit"] = query(
        *PARTS, ar1_fit("train", "fit"),
        f"""SELECT state, round(phi, 9) AS phi, {snap('intercept', COARSE)} AS intercept, last_ds,
        last_total FROM fit""",
    )
    forecast = f"SELECT state, model, ds, {snap('yhat', COARSE)} AS yhat FROM pred"
    q["ar1_forecast"] = query(*PARTS, ar1("train", "test", "pred"), forecast)
    indices = ", ".join(
        [f"round(coalesce((SELECT wi FROM f_wd w WHERE w.state = l.state AND wd = {i}), 1.0), 8)"
         f" AS weekday_{i}" for i in range(7)]
        + [f"round(coalesce((SELECT mi FROM f_m q WHERE q.state = l.state AND m = {i}), 1.0), 8)"
           f" AS month_{i}" for i in range(1, 13)]
    )
    q["trend_season_fit"] = query(
        *PARTS, trend_fit("train", "f"),
        f"""SELECT state, first_ds, round(slope, 6) AS slope, {snap('level', COARSE)} AS level,
        {indices} FROM f_line l""",
    )
    q["trend_season_negative"] = query(
        *PARTS,
        """signed AS (SELECT state, ds, CASE WHEN day(ds) = 5 THEN -total ELSE total END AS total
        FROM train)""",
        trend_fit("signed", "f"),
        f"SELECT state, round(slope, 6) AS slope, {snap('level', COARSE)} AS level FROM f_line",
    )
    q["stackable_states"] = query(
        SALES, "SELECT DISTINCT state FROM sales WHERE category <> 'ASIA'"
    )
    ahead = AR1_PATH.format(h="datediff('day', last_ds, t.ds)")
    q["fallback_chain_engine"] = query(
        *PARTS, ar1_fit("train", "fit"),
        "homes AS (SELECT DISTINCT state, category FROM sales)",
        f"""SELECT t.state, 'ARIMA' AS model, t.ds, {snap(f"""greatest(CASE WHEN h.category <> 'EUROPE'
        AND abs(phi) < 1 THEN {ahead} ELSE last_total END, 0.0)""", COARSE)} AS yhat
        FROM test t JOIN fit f ON t.state = f.state JOIN homes h ON t.state = h.state""",
    )
    q["forecast_coverage"] = query(
        *PARTS,
        """SELECT state, model, count(*) AS n, min(ds) AS first_ds, max(ds) AS last_ds,
        CAST(0 AS BIGINT) AS n_bad FROM test, (VALUES ('ARIMA'), ('Prophet'), ('LSTM')) m(model)
        GROUP BY state, model""",
    )
    q["trend_season_forecast"] = query(*PARTS, trend("train", "test", "pred"), forecast)
    path = AR1_PATH.format(h="step")
    q["fallback_chain"] = query(
        *PARTS, ar1_fit("train", "fit"),
        f"""SELECT state, CAST(step AS INTEGER) AS step, {snap(f'''CASE WHEN abs(phi) < 0.83
        THEN {path} ELSE last_total END''', COARSE)} AS yhat
        FROM (SELECT *, unnest(generate_series(1, 56)) AS step FROM fit)""",
    )
    q["meta_matrix"] = query(
        *PARTS, two("base", "meta", "pred"),
        f"""SELECT state, ds, CAST(NULL AS DOUBLE) AS "XGBoost",
        {snap("max(CASE WHEN model = 'Prophet' THEN yhat END)", COARSE)} AS "Prophet",
        {snap("max(CASE WHEN model = 'ARIMA' THEN yhat END)", COARSE)} AS "ARIMA",
        CAST(NULL AS DOUBLE) AS "LSTM" FROM pred GROUP BY state, ds""",
    )
    q["stack_fit"] = query(
        *PARTS, two("base", "meta", "on_meta"), PAIR,
        f"""SELECT state, {significant('w0')} AS intercept, {significant('wp')} AS "w_Prophet",
        {significant('wa')} AS "w_ARIMA" FROM stack""",
    )
    q["stack_predict"] = query(
        *PARTS, two("base", "meta", "on_meta"), PAIR, two("train", "test", "on_test"),
        f"""SELECT t.state, 'StackedEnsemble' AS model, t.ds,
        round(ln(1 + greatest(max(w0) + max(wp) * max(CASE WHEN model = 'Prophet' THEN yhat END)
        + max(wa) * max(CASE WHEN model = 'ARIMA' THEN yhat END), 0.0)), 6) AS log_yhat
        FROM on_test t JOIN stack s ON t.state = s.state GROUP BY t.state, t.ds""",
    )
    q["ar1_refit"] = query(
        *DENSE, ar1_fit("dense", "fit"),
        f"""SELECT state, last_ds, round(phi, 6) AS phi, {snap('intercept', COARSE)} AS intercept FROM fit""",
    )
    labelled = """labelled AS (
  SELECT state, ds, total, CASE WHEN b = 0 OR rn <= n - 3 * b THEN 0
    ELSE CAST(ceil((rn - (n - 3 * b)) / b) AS INTEGER) END AS segment
  FROM (SELECT *, n // 4 AS b FROM (
    SELECT *, row_number() OVER (PARTITION BY state ORDER BY ds) AS rn,
      count(*) OVER (PARTITION BY state) AS n FROM dense))),
fits AS (
  SELECT state, CAST(fold AS INTEGER) AS fold, regr_slope(total, previous) AS phi,
    regr_intercept(total, previous) AS intercept, max(ds) AS last_ds, arg_max(total, ds) AS last_total
  FROM (SELECT *, lag(total) OVER (PARTITION BY state ORDER BY ds) AS previous FROM labelled) l
  JOIN (VALUES (1), (2), (3)) f(fold) ON segment < fold
  WHERE state IN (SELECT state FROM labelled WHERE segment = 3)
  GROUP BY state, fold)"""
    q["ar1_folds"] = query(
        *DENSE, labelled,
        f"""SELECT state, fold, last_ds, round(phi, 6) AS phi, {snap('intercept', COARSE)} AS intercept FROM fits""",
    )
    ahead = AR1_PATH.format(h="datediff('day', last_ds, ds)")
    q["ar1_fold_scores"] = query(
        *DENSE, labelled,
        f"""SELECT state, fold, {snap('sqrt(avg((yhat - total) * (yhat - total)))', COARSE)} AS rmse
        FROM (SELECT l.state, fold, total,
          greatest(CASE WHEN abs(phi) < 1 THEN {ahead} ELSE last_total END, 0.0) AS yhat
          FROM labelled l JOIN fits f ON l.state = f.state AND l.segment = f.fold)
        GROUP BY state, fold""",
    )
    q["recursive_forecast"] = query(
        *DENSE, RECURSION,
        f"""SELECT state, 'XGBoost' AS model, last_ds + step AS ds, {snap('yhat', COARSE)} AS yhat
        FROM paths WHERE step > 0""",
        recursive=True,
    )
    q["avg_ensemble"] = query(
        *PARTS, two("train", "test", "pred"),
        f"""SELECT state, 'StackedEnsemble' AS model, ds, {snap('avg(yhat)', COARSE)} AS yhat
        FROM pred GROUP BY state, ds""",
    )
    q["clipped"] = query(
        *DENSE,
        f"""SELECT state, ds, CASE WHEN change IS NOT NULL THEN greatest(change, 0.0) END AS rise
        FROM (SELECT state, ds, total - lag(total) OVER w AS change FROM dense {W})""",
    )
    q["horizon_dates"] = query(
        *DENSE, horizon(), "ends AS (SELECT state, max(ds) AS last_ds FROM dense GROUP BY state)",
        """SELECT f.state, f.ds, CAST(datediff('day', last_ds, f.ds) AS INTEGER) AS step,
        strftime(f.ds, '%Y-%m-%dT%H:%M:%S') AS iso, strftime(f.ds, '%Y-%m-%d %H:%M:%S') AS text
        FROM future f JOIN ends e ON f.state = e.state""",
    )
    known_lags = ", ".join(
        f"coalesce(lag(total, {k - 1}) OVER w, total) AS lag_{k}" for k in (1, 7, 30)
    )
    last_known = f"""known AS (
      SELECT state, ds AS last_ds, total AS last_total, category, {known_lags}, {rolling()}
      FROM dense {W} QUALIFY row_number() OVER (PARTITION BY state ORDER BY ds DESC) = 1)"""
    q["last_known"] = query(*DENSE, last_known, "SELECT * FROM known")
    q["last_30_rows"] = query(
        *DENSE,
        """SELECT state, ds, total, CAST(row_number() OVER (PARTITION BY state ORDER BY ds DESC)
        AS INTEGER) AS from_end FROM dense QUALIFY from_end <= 30""",
    )
    q["future_frozen"] = query(
        *DENSE, HOLIDAYS, last_known, horizon(),
        "ahead AS (SELECT f.ds, k.* FROM future f JOIN known k ON f.state = k.state)",
        f"""SELECT ds, state, category, CAST(datediff('day', last_ds, ds) AS INTEGER) AS step,
        {CALENDAR}, {', '.join(LAG_NAMES + ROLL_NAMES)} FROM ahead""",
    )
    q["future_frozen_test"] = query(
        *PARTS, HOLIDAYS, last_known.replace("FROM dense", "FROM train"),
        "ahead AS (SELECT t.ds, k.* EXCLUDE (last_ds) FROM test t JOIN known k ON t.state = k.state)",
        f"""SELECT ds, state, category, {CALENDAR}, {', '.join(LAG_NAMES + ROLL_NAMES)} FROM ahead""",
    )
    carried = ", ".join(
        f"coalesce(last_value({n} IGNORE NULLS) OVER w, 0.0) AS {n}"
        for n in LAG_NAMES + ROLL_NAMES
    )
    q["future_appended"] = query(
        *DENSE, HOLIDAYS, horizon(),
        """both_rows AS (SELECT state, ds, total, category, FALSE AS later FROM dense UNION ALL
        SELECT f.state, f.ds, NULL, c.category, TRUE FROM future f JOIN
        (SELECT state, arg_max(category, ds) AS category FROM dense GROUP BY state) c
        ON f.state = c.state)""",
        f"computed AS (SELECT state, ds, category, later, {LAGS}, {rolling()} FROM both_rows {W})",
        f"SELECT ds, state, category, {CALENDAR}, {carried} FROM computed WHERE later {W}",
    )
    q["appended_rows"] = query(
        *DENSE, horizon(),
        """SELECT state, ds, total, category FROM dense UNION ALL
        SELECT f.state, f.ds, NULL, c.category FROM future f JOIN
        (SELECT state, arg_max(category, ds) AS category FROM dense GROUP BY state) c
        ON f.state = c.state""",
    )
    q["best_forecast"] = query(
        *PARTS, WINNERS,
        f"""SELECT state, model_used, ds, {snap('yhat', COARSE)} AS yhat, last_ds FROM winners""",
    )
    q["forecast_arrays"] = query(
        *PARTS, WINNERS,
        """SELECT state, string_agg(strftime(ds, '%Y-%m-%d %H:%M:%S'), ',' ORDER BY ds) AS dates,
        string_agg(CAST(CAST(round(yhat) AS BIGINT) AS VARCHAR), ',' ORDER BY ds) AS predictions,
        max(model_used) AS model_used,
        strftime(max(last_ds), '%Y-%m-%dT%H:%M:%S') AS last_training_date
        FROM winners GROUP BY state""",
    )
    q["forecasts_unfolded"] = query(
        *PARTS, WINNERS, f"SELECT state, model_used, ds, {snap('yhat', COARSE)} AS yhat FROM winners"
    )
    rounded = f"rounded AS (SELECT state, model, {ROUNDED} FROM scores)"
    chosen = ranked("rmse").replace("FROM scores", "FROM rounded")
    sizes = """sizes AS (SELECT state, count(*) FILTER (split = 'train') AS train_size,
        count(*) FILTER (split = 'test') AS test_size FROM split GROUP BY state)"""
    q["results_document"] = query(
        *SCORED, rounded, chosen, sizes,
        """SELECT r.state, max(CASE WHEN rank = 1 THEN model END) AS best_model,
        string_agg(model, ',' ORDER BY model) AS models, CAST(count(*) AS INTEGER) AS n_models,
        max(CASE WHEN model = 'ARIMA' THEN rmse END) AS arima_rmse,
        max(train_size) AS train_size, max(test_size) AS test_size
        FROM ranked r JOIN sizes s ON r.state = s.state GROUP BY r.state""",
    )
    q["results_flatten"] = query(
        *SCORED, rounded, chosen,
        """SELECT r.state, b.model AS best_model, r.model, r.mae, r.rmse, r.mape
        FROM ranked r JOIN (SELECT state, model FROM ranked WHERE rank = 1) b
        ON r.state = b.state""",
    )
    q["size_backfill"] = query(
        *PARTS, sizes,
        """SELECT state, CASE WHEN train_size > 1910 THEN train_size ELSE 1429 END AS train_size,
        CAST(358 AS BIGINT) AS test_size FROM sizes""",
    )
    q["batch_requests"] = query(
        *PARTS, winners(84),
        """asked AS (SELECT n_name AS state, CASE WHEN n_nationkey % 6 = 1 THEN 12
          WHEN n_nationkey % 11 = 3 THEN 20 WHEN n_nationkey % 12 = 5 THEN -1
          WHEN n_nationkey % 9 = 0 THEN 8 ELSE n_nationkey % 9 END AS weeks
        FROM nation UNION ALL SELECT r_name, 2 FROM region),
        modelled AS (SELECT * FROM winners WHERE model_used = 'Prophet'),
        judged AS (SELECT *, CASE WHEN weeks < 0 THEN 'bad_request'
             WHEN state NOT IN (SELECT state FROM sales) THEN 'no_data'
             WHEN state NOT IN (SELECT state FROM modelled) THEN 'no_model'
             WHEN weeks > 12 THEN 'beyond_horizon' ELSE 'ok' END AS status FROM asked)""",
        f"""SELECT a.state, CAST(weeks AS INTEGER) AS forecast_horizon_weeks, model_used, status,
        strftime(ds, '%Y-%m-%dT%H:%M:%S') AS date,
        {snap('yhat', COARSE)} AS predicted_sales
        FROM judged a LEFT JOIN modelled m ON a.state = m.state AND status = 'ok'
        AND datediff('day', m.last_ds, m.ds) <= 7 * weeks""",
    )
    done = "done AS (SELECT DISTINCT state FROM sales WHERE category IN ('ASIA', 'EUROPE'))"
    q["remaining_states"] = query(
        SALES, done,
        "SELECT DISTINCT state FROM sales WHERE state NOT IN (SELECT state FROM done)",
    )
    q["remaining_sales"] = query(
        SALES, done, "SELECT * FROM sales WHERE state NOT IN (SELECT state FROM done)"
    )
    q["completed_states"] = query(
        SALES, "SELECT DISTINCT state FROM sales WHERE category IN ('ASIA', 'EUROPE', 'AFRICA')"
    )
    q["available_states"] = query(
        SALES, "SELECT DISTINCT state FROM sales WHERE category <> 'ASIA'"
    )
    q["available_count"] = query(
        SALES, "SELECT count(DISTINCT state) AS n_states FROM sales WHERE category <> 'ASIA'"
    )
    q["grid_points"] = query(
        SALES,
        """points AS (SELECT d, s, t, r FROM (VALUES (4), (6), (8)) a(d),
        (VALUES (0.05), (0.1), (0.15)) b(s), (VALUES (100), (200)) c(t),
        (VALUES (0.8), (0.9)) e(r)),
        numbered AS (SELECT *, row_number() OVER (ORDER BY d, s, t, r) - 1 AS i FROM points)""",
        """SELECT state, CAST(i AS INTEGER) AS grid_id, CAST(d AS INTEGER) AS depth,
        CAST(s AS DOUBLE) AS step, CAST(t AS INTEGER) AS trees, CAST(r AS DOUBLE) AS row_share
        FROM (SELECT DISTINCT state FROM sales), numbered""",
    )
    q["best_configuration"] = query(
        *PARTS, last_value("train", "test", "pred"),
        """graded AS (SELECT p.state, i, share, avg(abs(yhat * share - total)) AS score
        FROM pred p JOIN test t ON p.state = t.state AND p.ds = t.ds,
        (VALUES (0, 0.5::DOUBLE), (1, 0.75::DOUBLE), (2, 1.0::DOUBLE), (3, 1.25::DOUBLE)) g(i, share)
        GROUP BY p.state, i, share)""",
        f"""SELECT state, CAST(i AS INTEGER) AS grid_id, share, {snap('score', COARSE)} AS score
        FROM graded QUALIFY row_number() OVER (PARTITION BY state ORDER BY graded.score, i) = 1""",
    )
    q["fitted_length"] = query(
        SALES,
        f"""pasts AS (SELECT state, ds, coalesce(list(total) OVER {p14}, []) AS past FROM sales),
        fitted AS (SELECT state, ds, list_transform(generate_series(1, 10),
          lambda i: CASE WHEN len(past) = 0 THEN 0.0 ELSE past[least(i, len(past))] END) AS f
          FROM pasts)""",
        f"""SELECT state, ds, CAST(len(f) AS INTEGER) AS n, f[1] AS head, f[10] AS tail,
        {snap('list_sum(f)')} AS step_sum FROM fitted""",
    )
    return q
