"""Monthly series queries: all markets in parallel."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrain.operators import quantiles, timeseries as ts
from tallygrain.plans.registry import query
from tallygrain.session import materialize

KEYS = ["market"]
ALPHAS = [0.2, 0.3, 0.56, 0.99]
H = 6


def series(t):
    """Monthly sales per market with index and season; the transactions are reduced to months once."""
    months = ts.monthly(t.sales, KEYS, "order_date", {"y": F.sum("sales").cast("double")})
    regular = ts.indexed(ts.fill_calendar(months, KEYS, ["y"]), KEYS).withColumn("t", F.col("t").cast("bigint"))
    return materialize(regular, "series")


def training(t):
    marked = ts.split_last(series(t), KEYS, H)
    return marked.where(~F.col("held_out")), marked.where(F.col("held_out"))


def rounded(df, digits=4, **special):
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(c, special.get(c, digits)) + F.lit(0.0) for c in doubles})


# Regression of y on t and month dummies, written through within-month deviations.
FIT = """
    d AS (SELECT *, t - avg(t) OVER (PARTITION BY market, season) AS dt, y - avg(y) OVER (PARTITION BY market, season) AS dy,
                 y - avg(y) OVER (PARTITION BY market) AS ty FROM {source}),
    b AS (SELECT market, sum(dt * dy) / sum(dt * dt) AS slope, sum(dy * dy) - sum(dt * dy) ^ 2 / sum(dt * dt) AS rss, sum(ty * ty) AS tss, count(*) AS n,
                 count(DISTINCT season) AS k FROM d GROUP BY market),
    fit AS (SELECT market, season, any_value(slope) AS slope, avg(y) - any_value(slope) * avg(t) AS intercept,
                   any_value(1 - (rss / (n - k - 1)) / (tss / (n - 1))) AS adj_r2 FROM {source} JOIN b USING (market) GROUP BY market, season)"""
TRAIN = """
    train AS (SELECT * FROM series QUALIFY row_number() OVER (PARTITION BY market ORDER BY t DESC) > 6),
    test AS (SELECT * FROM series QUALIFY row_number() OVER (PARTITION BY market ORDER BY t DESC) <= 6)"""
TRAIN_FIT = TRAIN + "," + FIT.format(source="train")
RESIDUALS = TRAIN_FIT + """,
    e AS (SELECT market, t, y - (intercept + slope * t) AS e FROM train JOIN fit USING (market, season)),
    c AS (SELECT market, t, e - avg(e) OVER (PARTITION BY market) AS e FROM e)"""
SES = """
    n AS (SELECT market, max(t) AS n FROM {source} GROUP BY market),
    levels AS (SELECT market, alpha, t, y, NULL::DOUBLE AS fitted, y AS level FROM {source}, (SELECT unnest([0.2, 0.3, 0.56, 0.99])::DOUBLE AS alpha) WHERE t = 1
            UNION ALL SELECT l.market, l.alpha, s.t, s.y, l.level, l.level + l.alpha * (s.y - l.level) FROM levels l JOIN {source} s ON s.market = l.market AND s.t = l.t + 1)"""


def residuals(t):
    train, _ = training(t)
    fit = ts.trend_season_fit(train, KEYS, "y")
    return ts.trend_season_fitted(train, fit, KEYS).withColumn("e", F.col("y") - F.col("fitted"))


@query("ts_monthly", "SELECT market, segment, strftime(month, '%Y-%m') AS month, sales::DOUBLE AS sales, quantity FROM monthly", ("monthly",))
def _(t):
    months = ts.monthly(t.sales, ["market", "segment"], "order_date", {"sales": F.sum("sales").cast("double"), "quantity": F.count("*")})
    filled = ts.fill_calendar(months, ["market", "segment"], ["sales", "quantity"])
    return filled.withColumn("month", F.date_format("month", "yyyy-MM"))


@query("ts_index", "SELECT market, strftime(month, '%Y-%m') AS month, t, season FROM series", ("series",))
def _(t):
    return series(t).select("market", F.date_format("month", "yyyy-MM").alias("month"), "t", "season")


@query("ts_ma_smooth", """+
    m AS (SELECT market, t, max(t) OVER (PARTITION BY market) AS n,
                 CASE WHEN count(*) OVER w = 4 THEN avg(y) OVER w END AS s FROM series WINDOW w AS (PARTITION BY market ORDER BY t ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING)),
    e AS (SELECT market, max(s) FILTER (WHERE t = 5) AS a, max(s) FILTER (WHERE t = 6) AS b, max(s) FILTER (WHERE t = n - 4) AS y, max(s) FILTER (WHERE t = n - 5) AS x
          FROM m GROUP BY market)
---
    SELECT market, t, round(CASE WHEN t <= 4 THEN a - (5 - t) * (b - a) WHEN t > n - 4 THEN y + (t - n + 4) * (y - x) ELSE s END, 4) AS smooth
    FROM m JOIN e USING (market)""", ("series",))
def _(t):
    return rounded(ts.moving_average(series(t), KEYS, "y", 4, fill_edges=True).select("market", "t", "smooth"))


@query("ts_ses", "+R" + SES.format(source="series") + """
---
    SELECT market, alpha, t, round(fitted, 4) AS fitted FROM levels""", ("series",))
def _(t):
    return rounded(ts.exponential_smoothing(series(t), KEYS, "y", ALPHAS).select("market", "alpha", "t", "fitted"))


@query("ts_decompose_mult", """+
    a AS (SELECT *, CASE WHEN count(*) OVER full_year = 13 THEN
              (sum(y) OVER inner_year + 0.5 * lag(y, 6) OVER o + 0.5 * lead(y, 6) OVER o) / 12 END AS trend FROM series
          WINDOW o AS (PARTITION BY market ORDER BY t), full_year AS (PARTITION BY market ORDER BY t ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING),
                 inner_year AS (PARTITION BY market ORDER BY t ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)),
    f AS (SELECT market, season, avg(y / trend) AS m FROM a GROUP BY 1, 2),
    g AS (SELECT market, season, m / avg(m) OVER (PARTITION BY market) AS seasonal FROM f)
---
    SELECT market, t, round(trend, 5) AS trend, round(seasonal, 6) AS seasonal, round(y / (trend * seasonal), 6) AS remainder FROM a JOIN g USING (market, season)""",
    ("series",))
def _(t):
    parts = ts.decompose_multiplicative(series(t), KEYS, "y").select("market", "t", "trend", "seasonal", "remainder")
    return rounded(parts, 6, trend=5)


@query("ts_season_box", "SELECT season, p / 4 AS prob, round(quantile_cont(y, p / 4), 4) AS value FROM series, (SELECT unnest(range(5)) AS p) GROUP BY season, p"
       .replace("quantile_cont(y, p / 4)", "CASE p WHEN 0 THEN quantile_cont(y, 0) WHEN 1 THEN quantile_cont(y, 0.25) WHEN 2 THEN quantile_cont(y, 0.5) "
                "WHEN 3 THEN quantile_cont(y, 0.75) ELSE quantile_cont(y, 1) END"), ("series",))
def _(t):
    return rounded(quantiles.exact_quantiles(series(t), ["y"], [0, 0.25, 0.5, 0.75, 1], ["season"]).select("season", "prob", "value"))


@query("ts_train_test", "SELECT market, t, row_number() OVER (PARTITION BY market ORDER BY t DESC) <= 6 AS held_out FROM series", ("series",))
def _(t):
    return ts.split_last(series(t), KEYS, H).select("market", "t", "held_out")


@query("ts_trend_season_fit", "+" + FIT.format(source="series") + """
---
    SELECT market, season, round(slope, 4) AS slope, round(intercept, 3) AS intercept, round(adj_r2, 6) AS adj_r2 FROM fit""", ("series",))
def _(t):
    return rounded(ts.trend_season_fit(series(t), KEYS, "y"), 4, intercept=3, adj_r2=6)


@query("ts_trend_season_forecast", "+" + FIT.format(source="series") + """,
    last AS (SELECT market, max(t) AS n, arg_max(season, t) AS s FROM series GROUP BY market),
    ahead AS (SELECT market, step, n + step AS t, ((s + step - 1) % 12 + 1)::INT AS season FROM last, (SELECT unnest(range(1, 7))::INT AS step))
---
    SELECT market, step, t, season, round(intercept + slope * t, 3) AS forecast FROM ahead JOIN fit USING (market, season)""", ("series",))
def _(t):
    s = series(t)
    return rounded(ts.trend_season_forecast(s, ts.trend_season_fit(s, KEYS, "y"), KEYS, H), 3)


ERRORS = """avg({e}) AS me, sqrt(avg(({e}) ^ 2)) AS rmse, avg(abs({e})) AS mae, avg(100 * ({e}) / nullif(y, 0)) AS mpe, avg(abs(100 * ({e}) / nullif(y, 0))) AS mape"""


@query("ts_accuracy", "+" + TRAIN_FIT + ",\n    a AS (SELECT market, " + ERRORS.format(e="y - (intercept + slope * t)") + """ FROM test JOIN fit USING (market, season) GROUP BY market)
---
    SELECT market, round(me, 3) AS me, round(rmse, 3) AS rmse, round(mae, 3) AS mae, round(mpe, 6) AS mpe, round(mape, 6) AS mape FROM a""", ("series",))
def _(t):
    train, test = training(t)
    ahead = ts.trend_season_forecast(train, ts.trend_season_fit(train, KEYS, "y"), KEYS, H)
    joined = test.select("market", "t", "y").join(ahead, ["market", "t"])
    return rounded(ts.accuracy(joined, KEYS, "y", "forecast"), 3, mpe=6, mape=6)


@query("ts_acf", "+" + RESIDUALS + """
---
    SELECT a.market, lag::INT AS lag, round(sum(a.e * b.e) / any_value(s.c0), 6) + 0.0 AS acf
    FROM c a CROSS JOIN (SELECT unnest(range(13)) AS lag) JOIN c b ON a.market = b.market AND b.t = a.t + lag
         JOIN (SELECT market, sum(e * e) AS c0 FROM c GROUP BY market) s ON s.market = a.market GROUP BY a.market, lag""", ("series",))
def _(t):
    return rounded(ts.acf(residuals(t), KEYS, "e"), 6)


# Partial autocorrelations as a recursion over coefficient lists.
PACF = """,
    rho AS (SELECT market, list(acf ORDER BY lag) AS rho FROM (
              SELECT a.market, b.t - a.t AS lag, sum(a.e * b.e) / any_value(s.c0) AS acf FROM c a JOIN c b ON a.market = b.market AND b.t - a.t BETWEEN 1 AND 12
              JOIN (SELECT market, sum(e * e) AS c0 FROM c GROUP BY market) s ON s.market = a.market GROUP BY 1, 2) GROUP BY market),
    levels AS (SELECT market, rho, 1 AS lag, [rho[1]] AS phi FROM rho
               UNION ALL SELECT market, rho, lag + 1, list_append(list_transform(range(1, lag + 1), lambda j: phi[j] - v * phi[lag + 1 - j]), v)
               FROM (SELECT *, (rho[lag + 1] - list_dot_product(phi, list_reverse(rho[1:lag]))) / (1 - list_dot_product(phi, rho[1:lag])) AS v
                     FROM levels WHERE lag < 12))"""


@query("ts_pacf", "+R" + RESIDUALS + PACF + """
---
    SELECT market, lag, round(phi[lag], 6) + 0.0 AS pacf FROM levels""", ("series",))
def _(t):
    return rounded(ts.pacf(residuals(t), KEYS, "e"), 6)


@query("ts_arima_search")
def _(t):
    """Order chosen and forecast per market, on the full series."""
    return rounded(ts.arima_search(series(t), KEYS, "y", h=H), 3)


@query("ts_arima_holdout")
def _(t):
    """Errors of the order chosen on the training part against the months held out."""
    train, test = training(t)
    ahead = ts.arima_search(train.select(*KEYS, "t", "y"), KEYS, "y", h=H).select("market", "t", "forecast")
    joined = test.select("market", "t", "y").join(ahead, ["market", "t"])
    return rounded(ts.accuracy(joined, KEYS, "y", "forecast"), 3, mpe=6, mape=6)


@query("ts_residuals", "+" + TRAIN_FIT + """
---
    SELECT market, t, round(y - (intercept + slope * t), 3) + 0.0 AS e FROM train JOIN fit USING (market, season)""", ("series",))
def _(t):
    return rounded(residuals(t).select("market", "t", "e"), 3)


@query("ts_kpss", "+" + RESIDUALS + """,
    n AS (SELECT market, count(*) AS n, floor(4 * (count(*) / 100) ^ 0.25)::INT AS lags FROM c GROUP BY market),
    s AS (SELECT market, sum(p ^ 2) AS ss FROM (SELECT market, sum(e) OVER (PARTITION BY market ORDER BY t) AS p FROM c) GROUP BY market),
    g AS (SELECT a.market, b.t - a.t AS k, sum(a.e * b.e) AS g FROM c a JOIN c b ON a.market = b.market AND b.t - a.t BETWEEN 0 AND 12 GROUP BY 1, 2),
    v AS (SELECT market, sum(CASE WHEN k = 0 THEN g WHEN k <= lags THEN 2 * (1 - k / (lags + 1)) * g ELSE 0 END) / any_value(n) AS s2 FROM g JOIN n USING (market) GROUP BY market)
---
    SELECT market, n, lags, round(ss / (n::DOUBLE * n * s2), 6) AS statistic, ss / (n::DOUBLE * n * s2) < 0.463 AS stationary FROM n JOIN s USING (market) JOIN v USING (market)""",
    ("series",))
def _(t):
    return rounded(ts.kpss(residuals(t), KEYS, "e"), 6)


@query("ts_adf")
def _(t):
    return rounded(ts.adf(residuals(t), KEYS, "e"), 6)


@query("ts_model_compare", "+R" + TRAIN_FIT + "," + SES.format(source="train") + """,
    p AS (SELECT market, 'trend_season' AS model, y, intercept + slope * t AS f FROM test JOIN fit USING (market, season)
          UNION ALL SELECT market, 'ses_' || alpha, test.y, level FROM test JOIN (SELECT market, alpha, arg_max(level, t) AS level FROM levels GROUP BY 1, 2) USING (market)
          UNION ALL SELECT s.market, 'seasonal_naive', s.y, o.y FROM test s JOIN series o ON o.market = s.market AND o.t = s.t - 12),
    m AS (SELECT market, model, avg(abs(100 * (y - f) / nullif(y, 0))) AS mape FROM p GROUP BY 1, 2)
---
    SELECT market, model, round(mape, 6) AS mape, mape = min(mape) OVER (PARTITION BY market) AS is_best FROM m""", ("series",))
def _(t):
    """Holdout MAPE of the regression, of the fixed-weight levels and of last year's value."""
    train, test = training(t)
    actual = test.select("market", "t", "y")
    ahead = ts.trend_season_forecast(train, ts.trend_season_fit(train, KEYS, "y"), KEYS, H)
    regression = actual.join(ahead, ["market", "t"]).select("market", F.lit("trend_season").alias("model"), "y", F.col("forecast").alias("f"))
    smoothed = ts.exponential_smoothing(train, KEYS, "y", ALPHAS)
    last = smoothed.groupBy("market", "alpha").agg(F.max_by(F.struct("y", "fitted"), "t").alias("l"))
    level = last.select("market", F.concat(F.lit("ses_"), F.col("alpha").cast("string")).alias("model"),
                        (F.col("l.fitted") + F.col("alpha") * (F.col("l.y") - F.col("l.fitted"))).alias("f"))
    flat = actual.join(level, "market").select("market", "model", "y", "f")
    earlier = series(t).select("market", (F.col("t") + 12).alias("t"), F.col("y").alias("f"))
    naive = actual.join(earlier, ["market", "t"]).select("market", F.lit("seasonal_naive").alias("model"), "y", "f")
    predictions = regression.unionByName(flat).unionByName(naive)
    errors = ts.accuracy(predictions, ["market", "model"], "y", "f").select("market", "model", "mape")
    return rounded(ts.best_model(errors, KEYS), 6)


@query("win_moving_avg", "SELECT market, t, " + ", ".join(
    f"""round(CASE WHEN count(*) OVER w{w} = {w} THEN avg(y) OVER w{w} END, 4) AS ma{w}""" for w in [3, 4, 5]) + """ FROM series
    WINDOW w3 AS (PARTITION BY market ORDER BY t ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), w4 AS (PARTITION BY market ORDER BY t ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING),
           w5 AS (PARTITION BY market ORDER BY t ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""", ("series",))
def _(t):
    frame = series(t)
    for w in [3, 4, 5]:
        frame = ts.moving_average(frame, KEYS, "y", w, out=f"ma{w}")
    return rounded(frame.select("market", "t", "ma3", "ma4", "ma5"))


@query("win_lag_diff", "SELECT market, t, round(y - lag(y) OVER w, 2) AS back, round(lead(y) OVER w - y, 2) AS ahead FROM series WINDOW w AS (PARTITION BY market ORDER BY t)", ("series",))
def _(t):
    return rounded(ts.step_differences(series(t), KEYS, "y").select("market", "t", "back", "ahead"), 2)
