"""Projections, filters, reshaping and scalar functions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tallygrain.functions import scalars
from tallygrain.operators import reshape
from tallygrain.plans.q_timeseries import series
from tallygrain.plans.registry import query

DAY = "yyyy-MM-dd"


# --- projections and filters ---------------------------------------------------


@query("proj_select", "SELECT o_totalprice, o_orderkey FROM orders")
def _(t):
    return t.orders.select("o_totalprice", "o_orderkey")


@query("proj_rename", "SELECT c_mktsegment AS segment, c_acctbal AS balance FROM customer")
def _(t):
    return t.customer.select("c_mktsegment", "c_acctbal").withColumnRenamed("c_mktsegment", "segment").withColumnRenamed("c_acctbal", "balance")


@query("proj_normalize_names", "SELECT n_nationkey AS Nation_Key, n_name AS Nation_Name FROM nation")
def _(t):
    return reshape.normalize_names(t.nation.select("n_nationkey", "n_name").toDF(" Nation Key ", "Nation Name?"))


@query("proj_drop", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def _(t):
    return t.orders.drop("o_custkey", "o_orderdate")


@query("proj_derive", """
    SELECT o_orderkey, year(o_orderdate)::INT AS issue_year, month(o_orderdate)::INT AS issue_month, 'M' AS mark, o_orderstatus AS status_copy FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("issue_year"), F.month("o_orderdate").alias("issue_month"),
                           F.lit("M").alias("mark"), F.col("o_orderstatus").alias("status_copy"))


@query("filt_range_date", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders
    WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""")
def _(t):
    """Both days belong to the range, the last one to its end."""
    inside = (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return t.orders.where(inside).select("o_orderkey", F.date_format("o_orderdate", DAY).alias("order_date"))


@query("filt_range_num", """
    SELECT permalink, country, amount FROM master
    WHERE country IN ('NATION_1', 'NATION_2', 'NATION_3') AND round_type = '1-URGENT' AND amount BETWEEN 100000 AND 300000""", ("master",))
def _(t):
    urgent = t.funding.where((F.col("round_type") == "1-URGENT") & F.col("amount").between(100000, 300000))
    chosen = t.companies.where(F.col("country").isin("NATION_1", "NATION_2", "NATION_3"))
    return urgent.join(chosen, F.lower("company") == F.col("permalink")).select("permalink", "country", "amount")


@query("filt_in_or", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') OR o_orderstatus = 'P'")
def _(t):
    return t.orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") | (F.col("o_orderstatus") == "P")).select("o_orderkey")


@query("filt_not_in", "SELECT summons, precinct FROM tickets WHERE precinct NOT IN (0, 19, 14)", ("tickets",))
def _(t):
    return t.tickets.where(~F.col("precinct").isin(0, 19, 14)).select("summons", "precinct")


@query("filt_not_blank", "SELECT permalink, country FROM companies WHERE country <> ''", ("companies",))
def _(t):
    return t.companies.where(F.col("country") != "").select("permalink", "country")


@query("proj_case_bins", """
    SELECT 'tip' AS kind, CASE WHEN tip >= 0 AND tip < 5 THEN 'Bucket_1' WHEN tip >= 5 AND tip < 10 THEN 'Bucket_2' WHEN tip >= 10 AND tip < 15 THEN 'Bucket_3'
           WHEN tip >= 15 AND tip < 20 THEN 'Bucket_4' ELSE 'Bucket_5' END AS bin, count(*) AS n FROM trips GROUP BY 2
    UNION ALL SELECT 'hour', bin, count(*) FROM timed GROUP BY bin""", ("trips", "timed"))
def _(t):
    tips = t.fares.groupBy(scalars.bin_label("tip", scalars.TIP_BINS, "left", "Bucket_5").alias("bin")).agg(F.count("*").alias("n"))
    hours = t.tickets.groupBy(
        scalars.hour_bin(scalars.violation_minute("violation_time")).alias("bin")).agg(F.count("*").alias("n"))
    return tips.select(F.lit("tip").alias("kind"), "bin", "n").unionByName(hours.select(F.lit("hour").alias("kind"), "bin", "n"))


@query("proj_season", """
    SELECT CASE WHEN month(issue_date) IN (12, 1, 2) THEN 'Winter' WHEN month(issue_date) < 6 THEN 'Spring'
           WHEN month(issue_date) < 9 THEN 'Summer' ELSE 'Fall' END AS title_name,
           CASE WHEN month(issue_date) IN (12, 1, 2) THEN 'winter' WHEN month(issue_date) < 6 THEN 'spring'
           WHEN month(issue_date) < 9 THEN 'summer' ELSE 'autumn' END AS lower_name, count(*) AS n
    FROM tickets_year GROUP BY 1, 2""", ("tickets_year",))
def _(t):
    return t.tickets_year.groupBy(
        scalars.season("issue_date").alias("title_name"), scalars.season("issue_date", "lower").alias("lower_name")
    ).agg(F.count("*").alias("n"))


@query("proj_ifelse", "SELECT doc_id, CASE WHEN score >= 0.5 THEN 'Yes' ELSE 'No' END AS answer FROM scored", ("scored",))
def _(t):
    return t.scored.select("doc_id", F.when(F.col("score") >= 0.5, "Yes").otherwise("No").alias("answer"))


@query("proj_recode_levels", """
    SELECT l_linestatus, (l_linestatus <> (SELECT min(l_linestatus) FROM lineitem))::INT AS code, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def _(t):
    return reshape.recode_levels(t.lineitem, "l_linestatus", "code").groupBy("l_linestatus", "code").agg(F.count("*").alias("n"))


# --- reshaping -----------------------------------------------------------------


@query("reshape_wide_to_long", """
    SELECT category, 'Cleantech' AS sector, Cleantech AS flag FROM sector_map UNION ALL SELECT category, 'Media', Media FROM sector_map
    UNION ALL SELECT category, 'Others', Others FROM sector_map""", ("sector_map",))
def _(t):
    return reshape.to_long(t.sector_map, ["category"], "sector", "flag")


@query("reshape_onehot_to_label", "SELECT category, sector FROM sector_long", ("sector_long",))
def _(t):
    return reshape.flags_to_label(t.sector_map, ["category"], "sector").withColumn("category", scalars.repair_category("category"))


@query("reshape_swipes", """
    SELECT employee, "day", strftime(time_in, '%Y-%m-%d %H:%M:%S') AS time_in, strftime(time_out, '%Y-%m-%d %H:%M:%S') AS time_out
    FROM swipes""", ("swipes",))
def _(t):
    """Through the wide form, one column per day of the data, and back."""
    days = reshape.levels_of(t.swipes, "day", limit=10_000)
    stamp = "yyyy-MM-dd HH:mm:ss"
    wide = {c: t.swipes.groupBy("employee").pivot("day", days).agg(F.date_format(F.min(c), stamp)) for c in ["time_in", "time_out"]}
    return reshape.swipe_pairs(wide["time_in"], wide["time_out"], "employee")


@query("reshape_split_first", "SELECT permalink, split_part(categories, '|', 1) AS primary_sector FROM companies", ("companies",))
def _(t):
    return t.companies.select("permalink", F.split("categories", r"\|")[0].alias("primary_sector"))


@query("reshape_cbind", """
    SELECT employee, count(*) AS days, count(*) FILTER (WHERE time_out > time_in) AS paired FROM swipes GROUP BY 1""", ("swipes",))
def _(t):
    """Columns of two frames side by side, matched by key and not by position."""
    days = t.swipes.groupBy("employee").agg(F.count("*").alias("days"))
    paired = t.swipes.groupBy("employee").agg(F.count_if(F.col("time_out") > F.col("time_in")).alias("paired"))
    return days.join(paired, "employee")


SOURCES = sorted(f"src{i}" for i in range(20))


@query("reshape_dummies", "SELECT doc_id, " + ", ".join(
    [f"(lang = '{v}')::INT AS lang_{v}" for v in ["en", "es", "fr"]] + [f"(source = '{v}')::INT AS source_{v}" for v in SOURCES[1:]])
    + " FROM emp", ("emp",))
def _(t):
    return reshape.dummies(t.emp.select("doc_id", "lang", "source"), ["lang", "source"])


# --- scalar functions ----------------------------------------------------------


@query("fn_lower", "SELECT lower(company) AS company, count(*) AS n FROM funding GROUP BY 1", ("funding",))
def _(t):
    return t.funding.groupBy(F.lower("company").alias("company")).agg(F.count("*").alias("n"))


@query("fn_trim_replace", """
    SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, replace(p_name, ' ', '_') AS joined, regexp_replace(p_brand, '#[0-9]', '?', 'g') AS masked FROM part""")
def _(t):
    padded = F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))
    return t.part.select("p_partkey", F.trim(padded).alias("trimmed"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("joined"),
                         F.regexp_replace("p_brand", "#[0-9]", "?").alias("masked"))


@query("fn_repair_category", "SELECT category, lower(replace(replace(category, '0', 'na'), '.na', '.0')) AS repaired FROM sector_map", ("sector_map",))
def _(t):
    return t.sector_map.select("category", scalars.repair_category("category").alias("repaired"))


@query("fn_concat", "SELECT p_partkey, p_brand || '/' || p_type AS pair, concat_ws(',', p_name, p_brand, p_type) AS listed FROM part")
def _(t):
    return t.part.select("p_partkey", F.concat("p_brand", F.lit("/"), "p_type").alias("pair"), F.concat_ws(",", "p_name", "p_brand", "p_type").alias("listed"))


@query("fn_substr", """
    SELECT summons, substr(violation_time, 1, 2) AS hh, substr(violation_time, 3, 2) AS mm, substr(violation_time, 5, 2) AS half FROM tickets""", ("tickets",))
def _(t):
    c = "violation_time"
    return t.tickets.select("summons", F.substring(c, 1, 2).alias("hh"), F.substring(c, 3, 2).alias("mm"), F.substring(c, 5, 2).alias("half"))


@query("fn_left_right_rtrim", """
    SELECT summons, "left"(violation_time, length(violation_time) - 1) AS clock, "right"(rtrim(violation_time || '  '), 1) AS half,
           length(violation_time)::INT AS n FROM tickets""", ("tickets",))
def _(t):
    c = F.col("violation_time")
    return t.tickets.select("summons", F.left(c, F.length(c) - 1).alias("clock"),
                            F.right(F.rtrim(F.concat(c, F.lit("  "))), F.lit(1)).alias("half"), F.length(c).alias("n"))


@query("fn_violation_time", """
    SELECT summons, violation_time, CASE WHEN violation_time IS NOT NULL THEN hour(ts) * 60 + minute(ts) END AS minute_of_day,
           CASE WHEN violation_time IS NOT NULL THEN strftime(ts, '%H:%M') END AS clock FROM tickets""", ("tickets",))
def _(t):
    timed = t.tickets.select("summons", "violation_time", scalars.violation_minute("violation_time").cast("bigint").alias("minute_of_day"))
    return timed.withColumn("clock", scalars.clock("minute_of_day"))


@query("fn_to_date", "SELECT summons, strftime(ts, '%Y-%m-%d') AS issued FROM tickets", ("tickets",))
def _(t):
    return t.tickets.select("summons", F.date_format(scalars.to_date("issue_date", "MM/dd/yyyy"), DAY).alias("issued"))


@query("fn_to_timestamp", "SELECT employee, \"day\", strftime(time_in, '%Y-%m-%d %H:%M:%S') AS time_in FROM swipes", ("swipes",))
def _(t):
    text = F.date_format("time_in", "dd-MM-yyyy HH:mm:ss")
    parsed = F.try_to_timestamp(text, F.lit("dd-MM-yyyy HH:mm:ss"))
    return t.swipes.select("employee", "day", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("time_in"))


@query("fn_date_parts", "SELECT event_id, year(ts)::INT AS y, month(ts)::INT AS m, day(ts)::INT AS d, hour(ts)::INT AS h FROM events")
def _(t):
    return t.events.select("event_id", F.year("ts").alias("y"), F.month("ts").alias("m"), F.day("ts").alias("d"), F.hour("ts").alias("h"))


@query("fn_unix_roundtrip", "SELECT o_orderkey, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m FROM orders")
def _(t):
    """Through epoch seconds and back; the pattern is ignored for timestamps."""
    back = F.from_unixtime(F.unix_timestamp("o_orderdate", "yyyyMM"))
    return t.orders.select("o_orderkey", F.year(back).alias("y"), F.month(back).alias("m"))


@query("fn_month_bucket", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy(F.date_format(F.trunc("o_orderdate", "month"), "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


@query("fn_duration_hours", """
    SELECT employee, "day", round(epoch_us(time_out - time_in) / 3600000000, 2) AS hours FROM swipes""", ("swipes",))
def _(t):
    return t.swipes.select("employee", "day", F.round(scalars.hours_between("time_in", "time_out"), 2).alias("hours"))


@query("fn_speed", """
    SELECT pu_location, do_location, passengers, distance, round(distance / nullif(epoch_us(dropoff - pickup) / 3600000000, 0), 4) AS speed
    FROM trips""", ("trips",))
def _(t):
    return t.trips.select("pu_location", "do_location", "passengers", "distance", F.round(scalars.speed("distance", "pickup", "dropoff"), 4).alias("speed"))


@query("fn_round_arith", """
    SELECT l_orderkey, l_partkey, l_linenumber, round(l_quantity / 7, 4) AS part_of, l_linenumber * 5 AS times, l_partkey % 90 AS rest, -l_quantity AS minus,
           8 - l_quantity AS variance FROM lineitem""")
def _(t):
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", F.round(F.col("l_quantity") / 7, 4).alias("part_of"),
                             (F.col("l_linenumber") * 5).alias("times"), (F.col("l_partkey") % 90).alias("rest"), (-F.col("l_quantity")).alias("minus"),
                             (8 - F.col("l_quantity")).alias("variance"))


@query("fn_cast", """
    SELECT summons, try_cast(substr(violation_time, 1, 2) AS INT) AS hh, try_cast(violation_time AS INT) AS whole, precinct::VARCHAR AS precinct FROM tickets""",
    ("tickets",))
def _(t):
    return t.tickets.select("summons", F.substring("violation_time", 1, 2).try_cast("int").alias("hh"),
                            F.col("violation_time").try_cast("int").alias("whole"), F.col("precinct").cast("string").alias("precinct"))


@query("fn_sin_term", "SELECT market, t, round(sin(2 * pi() * t / 12), 9) + 0.0 AS term FROM series", ("series",))
def _(t):
    return series(t).select("market", "t", (F.round(F.sin(2 * math.pi * F.col("t") / 12), 9) + F.lit(0.0)).alias("term"))


@query("fn_parallel_arrays", r"""
    SELECT page_id, i - 1 AS pos, heads[i] AS head, links[i] AS link FROM (
      SELECT page_id, heads, links, unnest(range(1, greatest(len(heads), len(links)) + 1)) AS i FROM (
        SELECT page_id, regexp_extract_all(html, '(?s)<h[1-6]>(.*?)</h[1-6]>', 1) AS heads, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages))""")
def _(t):
    heads = F.regexp_extract_all("html", F.lit("(?s)<h[1-6]>(.*?)</h[1-6]>"), F.lit(1))
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    zipped = t.pages.select("page_id", F.posexplode(F.arrays_zip(heads.alias("head"), links.alias("link"))).alias("pos", "row"))
    return zipped.select("page_id", F.col("pos").cast("bigint").alias("pos"), "row.head", "row.link")


@query("fn_label_lookup", """
    SELECT employee, max(event_value) FILTER (WHERE event_type = 'click') AS click, max(event_value) FILTER (WHERE event_type = 'view') AS view,
           max(event_value) FILTER (WHERE event_type = 'refund') AS refund
    FROM (SELECT user_id AS employee, event_type, max(value) AS event_value FROM events GROUP BY 1, 2) GROUP BY 1""")
def _(t):
    """Parallel label and value arrays per user, one entry per event type, then values by label."""
    best = t.events.groupBy("user_id", "event_type").agg(F.max("value").alias("v"))
    arrays = best.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("event_type", "v"))).alias("pairs"))
    return arrays.select(F.col("user_id").alias("employee"), *scalars.label_lookup(F.col("pairs.event_type"), F.col("pairs.v"), ["click", "view", "refund"]))
