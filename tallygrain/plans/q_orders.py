"""Order search on series: fits, residual tests and comparisons, on sales, quantity and smoothed series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrain.operators import timeseries as ts
from tallygrain.plans.q_timeseries import FIT, H, KEYS, rounded, series, training
from tallygrain.plans.registry import query
from tallygrain.session import materialize

#: Orders without a moving-average part and one lag at most, whose fits SQL can write as ratios of sums.
AR_ORDERS = ts.default_orders(p=1, d=1, q=0, seasonal=1)
ALPHA = 0.3

# The search over AR_ORDERS. The deepest order consumes 14 months, so all are judged from month 15 on, and the winner is fitted again on what it reaches.
AR_SEARCH = """
    src AS (SELECT market, t, season, y FROM {source}),
    w AS (SELECT market, t, 0 AS d, 0 AS seasonal, y - avg(y) OVER (PARTITION BY market) AS z FROM src
          UNION ALL SELECT market, t, 1, 0, y - lag(y) OVER (PARTITION BY market ORDER BY t) FROM src
          UNION ALL SELECT market, t, 0, 1, y - lag(y, 12) OVER (PARTITION BY market ORDER BY t) FROM src
          UNION ALL SELECT market, t, 1, 1, y - lag(y, 12) OVER o - lag(y) OVER o + lag(y, 13) OVER o FROM src WINDOW o AS (PARTITION BY market ORDER BY t)),
    z AS (SELECT *, lag(z) OVER (PARTITION BY market, d, seasonal ORDER BY t) AS zb FROM w WHERE z IS NOT NULL),
    sums AS (SELECT market, d, seasonal, count(*) FILTER (t > 14) AS n, sum(z * z) FILTER (t > 14) AS zz, sum(z * zb) FILTER (t > 14) AS zx, sum(zb * zb) FILTER (t > 14) AS xx,
                    sum(z * zb) / sum(zb * zb) AS phi FROM z GROUP BY 1, 2, 3),
    tried AS (SELECT market, d, seasonal, p, CASE p WHEN 1 THEN phi ELSE 0 END AS phi, n, zz - CASE p WHEN 1 THEN zx * zx / xx ELSE 0 END AS rss, p + 1 + (d + seasonal = 0)::INT AS k
              FROM sums, (SELECT unnest([0, 1]) AS p)),
    chosen AS (SELECT market, p, d, 0 AS q, seasonal, phi, n * ln(greatest(rss / n, 1e-12)) + 2 * k + 2 * k * (k + 1) / greatest(n - k - 1, 1)::DOUBLE AS aicc FROM tried
               QUALIFY row_number() OVER (PARTITION BY market ORDER BY aicc, p, d, seasonal) = 1),
    steps AS (SELECT c.market, p, d, q, c.seasonal, t, y, z - phi * coalesce(zb, 0) AS e FROM chosen c JOIN z USING (market, d, seasonal) JOIN src USING (market, t) WHERE p = 0 OR zb IS NOT NULL),
    ends AS (SELECT market, max(t) AS n, arg_max(y, t) AS y, avg(y) AS mean FROM src GROUP BY market),
    lasts AS (SELECT c.market, p, c.d, q, c.seasonal, phi, aicc, arg_max(z, t) AS z FROM chosen c JOIN z USING (market, d, seasonal) GROUP BY ALL),
    base AS (SELECT a.market, arg_max(a.y - b.y, a.t) AS y FROM src a JOIN src b ON a.market = b.market AND a.t = b.t + 12 GROUP BY a.market),
    future AS (SELECT l.market, p, d, q, l.seasonal, aicc, n + h AS t,
                 CASE WHEN d = 0 THEN phi ^ h * z ELSE list_sum(list_transform(range(1, h + 1), lambda j: phi ^ j)) * z END
                 + CASE WHEN d = 0 AND l.seasonal = 0 THEN mean WHEN d = 1 AND l.seasonal = 0 THEN ends.y WHEN d = 1 THEN base.y ELSE 0 END
                 + CASE WHEN l.seasonal = 1 THEN back.y ELSE 0 END AS forecast
               FROM lasts l JOIN ends USING (market) JOIN base USING (market), (SELECT unnest(range(1, 7))::INT AS h), src back
               WHERE back.market = l.market AND back.t = n + h - 12)"""
CENTRED = "c AS (SELECT market, t, e - avg(e) OVER (PARTITION BY market) AS e FROM steps)"
KPSS = """
    n AS (SELECT market, count(*) AS n, floor(4 * (count(*) / 100) ^ 0.25)::INT AS lags FROM c GROUP BY market),
    s AS (SELECT market, sum(p ^ 2) AS ss FROM (SELECT market, sum(e) OVER (PARTITION BY market ORDER BY t) AS p FROM c) GROUP BY market),
    g AS (SELECT a.market, b.t - a.t AS k, sum(a.e * b.e) AS g FROM c a JOIN c b ON a.market = b.market AND b.t - a.t BETWEEN 0 AND 12 GROUP BY 1, 2),
    v AS (SELECT market, sum(CASE WHEN k = 0 THEN g WHEN k <= lags THEN 2 * (1 - k / (lags + 1)) * g ELSE 0 END) / any_value(n) AS s2 FROM g JOIN n USING (market) GROUP BY market)"""
TRAIN_ROWS = """train AS (SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY market ORDER BY t DESC) > 6),
    test AS (SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY market ORDER BY t DESC) <= 6)"""
# Sales and quantity per market, as they are and as one-step fits of a smoothed level, as segments of their own.
MEASURES = f"""
    wide AS (SELECT market, month, sum(sales)::DOUBLE AS sales, sum(quantity)::DOUBLE AS quantity FROM monthly GROUP BY 1, 2),
    tall AS (UNPIVOT wide ON sales, quantity INTO NAME measure VALUE y),
    raw AS (SELECT market || ' ' || measure AS market, row_number() OVER (PARTITION BY market, measure ORDER BY month) AS t, month(month)::INT AS season, y FROM tall),
    levels AS (SELECT market, t, season, y, NULL::DOUBLE AS fitted, y AS level FROM raw WHERE t = 1
               UNION ALL SELECT l.market, s.t, s.season, s.y, l.level, l.level + {ALPHA}::DOUBLE * (s.y - l.level) FROM levels l JOIN raw s ON s.market = l.market AND s.t = l.t + 1),
    measures AS (SELECT market, t, season, y FROM raw UNION ALL SELECT market || ' smoothed', t - 1, season, fitted FROM levels WHERE t > 1)"""


def measures(t):
    """The same in Spark, with the segment's whole name as ``market``."""
    months = ts.monthly(t.sales, KEYS, "order_date", {"sales": F.sum("sales").cast("double"), "quantity": F.count("*").cast("double")})
    regular = ts.indexed(ts.fill_calendar(months, KEYS, ["sales", "quantity"]), KEYS)
    pairs = F.array(*[F.struct(F.concat_ws(" ", "market", F.lit(m)).alias("market"), F.col(m).alias("y")) for m in ("sales", "quantity")])
    raw = materialize(regular.select("t", "season", F.inline(pairs)).select("market", F.col("t").cast("bigint").alias("t"), "season", "y"), "measures")
    level = ts.exponential_smoothing(raw, KEYS, "y", [ALPHA]).where("fitted is not null").select("market", "t", "fitted").join(raw.select("market", "t", "season"), ["market", "t"])
    smooth = level.select(F.concat(F.col("market"), F.lit(" smoothed")).alias("market"), (F.col("t") - 1).alias("t"), "season", F.col("fitted").alias("y"))
    return materialize(raw.unionByName(smooth), "measures")


def compared(rows, orders):
    """Holdout errors of the regression, of the order search and of last year's value per segment, the best one marked."""
    marked = materialize(ts.split_last(rows, KEYS, H), "split")
    train, test = marked.where(~F.col("held_out")), marked.where("held_out").select("market", "t", "y")
    regression = ts.trend_season_forecast(train, ts.trend_season_fit(train, KEYS, "y"), KEYS, H).select("market", "t", F.lit("trend_season").alias("model"), F.col("forecast").alias("f"))
    search = ts.arima_search(train, KEYS, "y", orders, h=H).select("market", "t", F.lit("order_search").alias("model"), F.col("forecast").alias("f"))
    naive = marked.select("market", (F.col("t") + 12).alias("t"), F.lit("seasonal_naive").alias("model"), F.col("y").alias("f"))
    predictions = test.join(regression.unionByName(search).unionByName(naive), ["market", "t"])
    return rounded(ts.best_model(ts.accuracy(predictions, ["market", "model"], "y", "f").select("market", "model", "mape"), KEYS), 6)


def comparison_sql(source: str) -> str:
    return TRAIN_ROWS.format(source=source) + "," + FIT.format(source="train") + "," + AR_SEARCH.format(source="train") + f""",
    guess AS (SELECT market, 'trend_season' AS model, test.y, intercept + slope * t AS f FROM test JOIN fit USING (market, season)
              UNION ALL SELECT market, 'order_search', test.y, forecast FROM test JOIN future USING (market, t)
              UNION ALL SELECT s.market, 'seasonal_naive', s.y, o.y FROM test s JOIN {source} o ON o.market = s.market AND o.t = s.t - 12),
    m AS (SELECT market, model, avg(abs(100 * (y - f) / nullif(y, 0))) AS mape FROM guess GROUP BY 1, 2)
---
    SELECT market, model, round(mape, 6) AS mape, mape = min(mape) OVER (PARTITION BY market) AS is_best FROM m"""


@query("ts_ar_search", "+" + AR_SEARCH.format(source="series") + """
---
    SELECT market, p, d, q, seasonal, round(aicc, 3) AS aicc, t::INT AS t, round(forecast, 3) AS forecast FROM future""", ("series",))
def _(t):
    """Order chosen among those without a moving-average part, and forecast, on the full series."""
    return rounded(ts.arima_search(series(t), KEYS, "y", AR_ORDERS, h=H), 3)


@query("ts_ar_residuals", "+" + AR_SEARCH.format(source="series") + """
---
    SELECT market, p, d, q, seasonal, t::INT AS t, round(y - e, 2) + 0.0 AS fitted, round(e, 2) + 0.0 AS e FROM steps""", ("series",))
def _(t):
    return rounded(ts.arima_fitted(series(t), KEYS, "y", AR_ORDERS).select("market", "p", "d", "q", "seasonal", "t", "fitted", "e"), 2)


@query("ts_ar_kpss", "+" + AR_SEARCH.format(source="series") + ",\n" + CENTRED + "," + KPSS + """
---
    SELECT market, n, lags, round(ss / (n::DOUBLE * n * s2), 6) AS statistic, ss / (n::DOUBLE * n * s2) < 0.463 AS stationary FROM n JOIN s USING (market) JOIN v USING (market)""", ("series",))
def _(t):
    """Stationarity of the innovations that the order search leaves."""
    return rounded(ts.kpss(materialize(ts.arima_fitted(series(t), KEYS, "y", AR_ORDERS), "innovations"), KEYS, "e"), 6)


@query("ts_arima_residuals")
def _(t):
    """Fitted values and innovations of the order chosen among all orders, on the training part."""
    return rounded(ts.arima_fitted(training(t)[0], KEYS, "y"), 3)


@query("ts_arima_adf")
def _(t):
    """Unit-root test on the innovations of the order chosen among all orders."""
    return rounded(ts.adf(ts.arima_fitted(training(t)[0], KEYS, "y"), KEYS, "e"), 6)


@query("ts_order_compare", "+" + comparison_sql("series"), ("series",))
def _(t):
    """The order search as a row of the comparison."""
    return compared(series(t).select("market", "t", "season", "y"), AR_ORDERS)


@query("ts_arima_compare")
def _(t):
    """The same with the search over all orders."""
    return compared(series(t).select("market", "t", "season", "y"), None)


@query("ts_measure_compare", "+R" + MEASURES + ",\n    " + comparison_sql("measures"), ("monthly",))
def _(t):
    """The comparison for sales and quantity, as they are and smoothed."""
    return compared(measures(t), AR_ORDERS)
