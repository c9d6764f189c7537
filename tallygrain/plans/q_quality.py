"""Profiling and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrain.operators import profile, quality
from tallygrain.operators.quality import Rule
from tallygrain.plans.registry import query

# Legal domains of the trip attributes.
YEARS = [1996, 1997, 1998, 1999, 2000]
MONTHS = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]
EXTRAS = [0.0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.07, 0.08]
RATE_CODES = [1, 2, 3, 4, 5, 6]
PAYMENTS = [1, 2, 3, 4, 5, 6]
TAXES = [0.0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.07]
SURCHARGES = [0.0, 0.3]
PASSENGERS_MAX = 6


def trip_rules() -> list[Rule]:
    """The rules a trip must keep; a rule is true for a trip in error."""
    c = F.col
    return [
        Rule("pickup_period", quality.outside_period("pickup", YEARS, MONTHS)),
        Rule("dropoff_period", quality.outside_period("dropoff", YEARS, MONTHS)),
        Rule("time_order", c("dropoff") < c("pickup")),
        Rule("passengers", c("passengers") > PASSENGERS_MAX),
        Rule("extra", ~c("extra").isin(EXTRAS)),
        Rule("rate_code", ~c("rate_code").isin(RATE_CODES)),
        Rule("payment", ~c("payment").isin(PAYMENTS)),
        Rule("mta", ~c("mta").isin(TAXES)),
        Rule("cash_tip", (c("payment") == 2) & (c("tip") != 0)),
        Rule("surcharge", ~c("surcharge").isin(SURCHARGES)),
        Rule("total", c("total") <= 0),
        Rule("tolls", c("tolls") < 0),
        Rule("distance", c("distance") <= 0),
        Rule("fare", c("fare") <= 0),
        Rule("tip", c("tip") < 0),
    ]


# The same rules as SQL, in the same order.
RULE_SQL = {
    "pickup_period": "year(pickup) NOT BETWEEN 1996 AND 2000 OR month(pickup) > 11",
    "dropoff_period": "year(dropoff) NOT BETWEEN 1996 AND 2000 OR month(dropoff) > 11",
    "time_order": "dropoff < pickup",
    "passengers": "passengers > 6",
    "extra": "extra NOT IN (0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.07, 0.08)",
    "rate_code": "rate_code NOT IN (1, 2, 3, 4, 5, 6)",
    "payment": "payment NOT IN (1, 2, 3, 4, 5, 6)",
    "mta": "mta NOT IN (0, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.07)",
    "cash_tip": "payment = 2 AND tip <> 0",
    "surcharge": "surcharge NOT IN (0.0, 0.3)",
    "total": "total <= 0",
    "tolls": "tolls < 0",
    "distance": "distance <= 0",
    "fare": "fare <= 0",
    "tip": "tip < 0",
}
ERROR_SQL = "(" + " OR ".join(f"({text})" for text in RULE_SQL.values()) + ")"


@query("dq_error_by_provider", f"SELECT vendor, count(*) AS errors FROM trips WHERE {ERROR_SQL} GROUP BY vendor", ("trips",))
def _(t):
    return quality.errors_by(t.trips, trip_rules(), "vendor").orderBy("vendor")


# --- profiles ------------------------------------------------------------------

CUSTOMER_TYPES = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")]


@query("prof_schema", " UNION ALL ".join(
    f"SELECT {i} AS position, '{n}' AS column_name, '{ty}' AS type, count(*) AS \"rows\", 5 AS columns FROM customer"
    for i, (n, ty) in enumerate(CUSTOMER_TYPES, 1)))
def _(t):
    return profile.schema_frame(t.customer)


def _summary_sql(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS "values", count(*) - count({c}) AS nulls, round(min({c})::DOUBLE, 6) AS low,
        round(quantile_cont({c}::DOUBLE, 0.25), 6) AS q1, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median,
        round(avg({c}), 6) AS mean, round(quantile_cont({c}::DOUBLE, 0.75), 6) AS q3, round(max({c})::DOUBLE, 6) AS high FROM {table}"""
        for c in columns)


@query("prof_summary", _summary_sql("customer", ["c_acctbal", "c_nationkey"]))
def _(t):
    frame = profile.summary(t.customer, ["c_acctbal", "c_nationkey"])
    return frame.withColumns({c: F.round(c, 6) for c in ["low", "q1", "median", "mean", "q3", "high"]})


MONEY = ["fare", "extra", "mta", "surcharge", "tip", "tolls", "total"]


@query("prof_min_max_avg", "SELECT " + ", ".join(
    f"min({c}) AS min_{c}, max({c}) AS max_{c}, round(avg({c}), 6) AS avg_{c}" for c in MONEY if c != "total")
    + ", round(min(total), 6) AS min_total, round(max(total), 6) AS max_total, round(avg(total), 4) AS avg_total FROM trips", ("trips",))
def _(t):
    wide = profile.min_max_avg(t.fares, MONEY)
    return wide.withColumns({"min_total": F.round("min_total", 6), "max_total": F.round("max_total", 6), "avg_total": F.round("avg_total", 4)})


@query("prof_value_counts", "SELECT extra, count(*) AS n FROM trips GROUP BY extra", ("trips",))
def _(t):
    return profile.value_counts(t.fares, "extra").orderBy("extra")


@query("prof_distinct_values", "SELECT DISTINCT rate_code FROM trips", ("trips",))
def _(t):
    return t.fares.select("rate_code").distinct()


@query("prof_filtered_value_counts", "SELECT tip, count(*) AS n FROM trips WHERE payment = 2 AND tip <> 0 GROUP BY tip", ("trips",))
def _(t):
    return profile.value_counts(t.fares.where((F.col("payment") == 2) & (F.col("tip") != 0)), "tip")


FUNDING_COLUMNS = ["round", "company", "round_type", "amount"]


@query("prof_null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count(*) AS \"rows\" FROM funding" for c in FUNDING_COLUMNS), ("funding",))
def _(t):
    return profile.null_counts(t.funding)


@query("prof_null_vs_rows", """
    SELECT count(*) FILTER (WHERE violation_time IS NULL) AS nulls, count(*) AS "rows" FROM tickets""", ("tickets",))
def _(t):
    return t.tickets.agg(F.sum(F.when(F.col("violation_time").isNull(), 1).otherwise(0)).alias("nulls"), F.count("*").alias("rows"))


@query("prof_null_percent", """
    SELECT 'violation_time' AS column_name, count(*) - count(violation_time) AS nulls, count(*) AS "rows",
           round(100.0::DOUBLE * (count(*) - count(violation_time)) / count(*), 4) AS percent FROM tickets""", ("tickets",))
def _(t):
    return profile.null_percent(t.tickets, ["violation_time"])


@query("prof_null_rows_count", "SELECT count(*) AS n FROM funding WHERE amount IS NULL", ("funding",))
def _(t):
    return t.funding.where(F.col("amount").isNull()).agg(F.count("*").alias("n"))


@query("prof_blank_counts", """
    SELECT 'country' AS column_name, count(*) FILTER (WHERE country IS NULL OR country = '') AS blanks FROM companies
    UNION ALL SELECT 'categories', count(*) FILTER (WHERE categories IS NULL OR categories = '') FROM companies""", ("companies",))
def _(t):
    return profile.blank_counts(t.companies, ["country", "categories"])


@query("prof_date_range", "SELECT strftime(min(ts), '%Y-%m-%d') AS first_date, strftime(max(ts), '%Y-%m-%d') AS last_date FROM events")
def _(t):
    return t.events.agg(F.date_format(F.min("ts"), "yyyy-MM-dd").alias("first_date"), F.date_format(F.max("ts"), "yyyy-MM-dd").alias("last_date"))


@query("prof_year_month", "SELECT year(o_orderdate)::INT AS yr, month(o_orderdate)::INT AS mnth, count(*) AS n FROM orders GROUP BY 1, 2")
def _(t):
    return profile.rows_per_month(t.orders, "o_orderdate").orderBy("yr", "mnth")


# --- rules ---------------------------------------------------------------------


@query("dq_period_rule", """
    SELECT count(*) FILTER (WHERE year(pickup) NOT BETWEEN 1996 AND 2000 OR month(pickup) > 11) AS pickup_errors,
           count(*) FILTER (WHERE year(dropoff) NOT BETWEEN 1996 AND 2000 OR month(dropoff) > 11) AS dropoff_errors FROM trips""", ("trips",))
def _(t):
    return t.trips.agg(*[F.count_if(quality.outside_period(c, YEARS, MONTHS)).alias(f"{c}_errors") for c in ["pickup", "dropoff"]])


@query("dq_temporal_order", "SELECT count(*) AS errors FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate")
def _(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.where(F.col("l_shipdate") < F.col("o_orderdate")).agg(F.count("*").alias("errors"))


@query("dq_threshold_rule", "SELECT count(*) AS errors FROM trips WHERE passengers > 6", ("trips",))
def _(t):
    return t.fares.where(F.col("passengers") > PASSENGERS_MAX).agg(F.count("*").alias("errors"))


@query("dq_rule_scorecard", " UNION ALL ".join(
    f"""SELECT vendor, '{n}' AS rule, count(*) FILTER (WHERE {s}) AS violations, count(*) AS "rows",
        round(100.0::DOUBLE * count(*) FILTER (WHERE {s}) / count(*), 4) AS percent FROM trips GROUP BY vendor"""
    for n, s in [*RULE_SQL.items(), ("any", ERROR_SQL)]), ("trips",))
def _(t):
    return quality.scorecard(t.trips, trip_rules(), "vendor")


@query("dq_clean_rows", f"""
    SELECT vendor, count(*) AS n, round(sum(fare::DECIMAL(18,2))::DOUBLE, 2) AS fare FROM trips WHERE NOT {ERROR_SQL} GROUP BY vendor""", ("trips",))
def _(t):
    kept = quality.clean(t.trips, trip_rules())
    return kept.groupBy("vendor").agg(F.count("*").alias("n"), F.sum(F.col("fare").cast("decimal(18,2)")).cast("double").alias("fare"))


@query("dq_reconcile", f"""
    SELECT count(*) AS total, count(*) FILTER (WHERE NOT {ERROR_SQL}) AS clean, count(*) FILTER (WHERE {ERROR_SQL}) AS errors,
           count(*) FILTER (WHERE {ERROR_SQL} IS NULL) AS undecided, count(*) - count(*) FILTER (WHERE NOT {ERROR_SQL}) - count(*) FILTER (WHERE {ERROR_SQL}) - count(*) FILTER (WHERE {ERROR_SQL} IS NULL) AS difference FROM trips""", ("trips",))
def _(t):
    return quality.reconcile(t.trips, trip_rules())


@query("dq_provider_error_rate", f"""+
    rates AS (SELECT vendor, count(*) AS "rows", count(*) FILTER (WHERE {ERROR_SQL}) AS errors,
                     round(100.0::DOUBLE * count(*) FILTER (WHERE {ERROR_SQL}) / count(*), 4) AS error_percent FROM trips GROUP BY vendor)
---
    SELECT *, vendor = (SELECT vendor FROM rates ORDER BY error_percent DESC, vendor DESC LIMIT 1) AS is_worst FROM rates""", ("trips",))
def _(t):
    return quality.error_rate(t.trips, trip_rules(), "vendor")


# --- duplicates and keys -------------------------------------------------------


@query("dq_dedup_full", "SELECT DISTINCT state, code, precinct, make FROM tickets", ("tickets",))
def _(t):
    return t.tickets.select("state", "code", "precinct", "make").dropDuplicates()


@query("dq_dup_count", """
    SELECT (SELECT count(*) FROM tickets) - (SELECT count(*) FROM (SELECT DISTINCT state, code, precinct, make FROM tickets)) AS duplicates""",
    ("tickets",))
def _(t):
    return quality.duplicate_count(t.tickets.select("state", "code", "precinct", "make"))


@query("dq_dedup_key_keep_one", """
    SELECT "user", item, event_id, rating FROM raw_ratings QUALIFY row_number() OVER (PARTITION BY "user", item ORDER BY event_id) = 1""",
    ("raw_ratings",))
def _(t):
    return quality.dedup_keep_one(t.raw_ratings, ["user", "item"], ["event_id"])


@query("dq_dedup_key_drop_all", """
    SELECT "user", item, event_id, rating FROM raw_ratings QUALIFY count(*) OVER (PARTITION BY "user", item) = 1""", ("raw_ratings",))
def _(t):
    return quality.dedup_drop_all(t.raw_ratings, ["user", "item"])


KEYED = {"customer": "c_custkey", "orders": "o_orderkey", "lineitem": "l_orderkey", "documents": "doc_id", "labels": "doc_id"}


@query("dq_key_unique", " UNION ALL ".join(
    f"""SELECT '{table}' AS table_name, (SELECT count(*) FROM {table}) AS "rows", (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table})) AS distinct_keys,
        (SELECT count(*) FROM {table}) = (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table})) AS is_unique""" for table, key in KEYED.items()))
def _(t):
    frames = [quality.key_uniqueness(t.table(table), [key], table) for table, key in KEYED.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


@query("dq_key_diff", "SELECT doc_id AS key FROM documents EXCEPT SELECT vec_id FROM embeddings")
def _(t):
    """Keys that one of two tables lacks."""
    return t.documents.select(F.col("doc_id").alias("key")).subtract(t.embeddings.select("vec_id"))


@query("dq_schema_diff", """
    SELECT table_name, column_name, "rows" FROM (
      SELECT 'documents' AS table_name, unnest(['lang', 'n_chars', 'source', 'text']) AS column_name, count(*) AS "rows" FROM documents
      UNION ALL SELECT 'labels', unnest(['quality', 'toxic']), count(*) FROM labels)""")
def _(t):
    """Columns only one of two tables has, with the rows that carry them."""
    parts = []
    for name, other in [("documents", "labels"), ("labels", "documents")]:
        frame = t.table(name)
        only = [c for c in frame.columns if c not in t.table(other).columns]
        parts.append(frame.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("table_name"), F.explode(F.array(*[F.lit(c) for c in only])).alias("column_name"), "rows"))
    return parts[0].unionByName(parts[1])


# --- NULLs and values ----------------------------------------------------------


@query("dq_drop_all_null_columns", """
    SELECT strftime(c.d, '%Y-%m-%d') AS "day", count(time_in) AS present
    FROM (SELECT unnest(generate_series(date_trunc('month', min(ts)), date_trunc('month', max(ts)) + INTERVAL 1 MONTH - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM events) c
    LEFT JOIN swipes ON strftime(c.d, '%Y-%m-%d') = "day" GROUP BY 1 HAVING count(time_in) > 0""", ("swipes",))
def _(t):
    """Days of the months' calendar on which nobody swiped vanish; in long form a wide column is a group."""
    ends = t.events.agg(F.trunc(F.min("ts"), "month").alias("lo"), F.last_day(F.max("ts")).alias("hi"))
    calendar = ends.select(F.explode(F.sequence("lo", "hi")).alias("day")).select(F.col("day").cast("string").alias("day"))
    return calendar.join(t.swipes, "day", "left").groupBy("day").agg(F.count("time_in").alias("present")).where("present > 0")


@query("dq_row_null_count", """
    SELECT "round", (amount IS NULL)::INT + (nullif(round_type, '5-LOW') IS NULL)::INT AS nulls FROM funding""", ("funding",))
def _(t):
    frame = t.funding.withColumn("round_type", F.nullif(F.col("round_type"), F.lit("5-LOW")))
    return frame.select("round", quality.row_null_count(["amount", "round_type"]).alias("nulls"))


@query("dq_rows_with_null", "SELECT * FROM funding WHERE amount IS NULL", ("funding",))
def _(t):
    return t.funding.where(quality.has_null(t.funding.columns))


@query("dq_drop_any_null", "SELECT * FROM funding WHERE amount IS NOT NULL", ("funding",))
def _(t):
    return t.funding.dropna("any")


@query("dq_drop_constant_columns", """
    SELECT 'o_orderkey' AS column_name, count(DISTINCT o_orderkey) = 1 AS constant FROM orders
    UNION ALL SELECT 'standard_hours', count(DISTINCT 8) = 1 FROM orders
    UNION ALL SELECT 'over18', count(DISTINCT 'Y') = 1 FROM orders
    UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) = 1 FROM orders""")
def _(t):
    frame = t.orders.select("o_orderkey", F.lit(8).alias("standard_hours"), F.lit("Y").alias("over18"), "o_orderstatus")
    return quality.constant_columns(frame)


@query("dq_sentinel_to_mode", """+
    mode AS (SELECT state FROM tickets WHERE state <> '99' GROUP BY state ORDER BY count(*) DESC, state LIMIT 1)
---
    SELECT CASE WHEN state = '99' THEN (SELECT state FROM mode) ELSE state END AS state, count(*) AS n FROM tickets GROUP BY 1""", ("tickets",))
def _(t):
    return profile.value_counts(quality.sentinel_to_mode(t.tickets, "state", "99"), "state")


@query("dq_cap_outliers", """
    SELECT doc_id, CASE WHEN n_chars IS NOT NULL THEN greatest(50.0::DOUBLE, least(3000.0::DOUBLE, n_chars)) END AS n_chars,
           greatest(2.0::DOUBLE, least(12.0::DOUBLE, n_lines)) AS n_lines FROM emp""", ("emp",))
def _(t):
    return quality.cap(t.emp.select("doc_id", "n_chars", "n_lines"), {"n_chars": (50, 3000), "n_lines": (2, 12)})


@query("dq_percentile_grid", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, unnest(range(101))::INT AS step,
        unnest(list_transform(quantile_cont({c}, [p / 100 FOR p IN range(101)]), lambda x: round(x, 6))) AS value FROM {table}"""
    for table, c in [("lineitem", "l_extendedprice"), ("lineitem", "l_quantity")]))
def _(t):
    return quality.percentile_grid(t.lineitem, ["l_extendedprice", "l_quantity"]).withColumn("value", F.round("value", 6))


@query("dq_box_stats", """+
    q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, [0, 0.25, 0.5, 0.75, 1]) AS q FROM lineitem GROUP BY 1)
---
    SELECT l_returnflag, 'l_extendedprice' AS column_name, round(any_value(q)[1], 4) AS low, round(any_value(q)[2], 4) AS q1,
           round(any_value(q)[3], 4) AS median, round(any_value(q)[4], 4) AS q3, round(any_value(q)[5], 4) AS high,
           count(*) FILTER (WHERE l_extendedprice < q[2] - 1.5 * (q[4] - q[2]) OR l_extendedprice > q[4] + 1.5 * (q[4] - q[2])) AS outliers
    FROM lineitem JOIN q USING (l_returnflag) GROUP BY 1""", ("trips",))
def _(t):
    frame = quality.box_stats(t.lineitem, ["l_extendedprice"], ["l_returnflag"])
    return frame.withColumns({c: F.round(c, 4) for c in ["low", "q1", "median", "q3", "high"]})
