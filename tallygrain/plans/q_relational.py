"""Joins, aggregates, windows, top-k and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrain.functions import scalars
from tallygrain.operators import ordering, quantiles, relational as rel, reshape
from tallygrain.plans.registry import query
from tallygrain.session import materialize

MONEY = "decimal(18,2)"


def money_sum(c: str):
    return F.sum(F.col(c).cast(MONEY)).cast("double")


def timed_tickets(t):
    return t.tickets.withColumn("bin", scalars.hour_bin(scalars.violation_minute("violation_time")))


def master(t):
    """Funding rounds with their company and its primary sector."""
    first = F.split("categories", r"\|")[0]
    return (
        t.funding.withColumn("permalink", F.lower("company")).drop("company").join(t.companies, "permalink")
        .withColumn("primary_sector", F.lower(F.nullif(first, F.lit(""))))
    )


def sector_labels(t):
    labels = reshape.flags_to_label(t.sector_map, ["category"], "sector").withColumn("category", scalars.repair_category("category"))
    return materialize(labels, "sector-labels")


def sectored(t):
    return rel.left_map(master(t), sector_labels(t), "primary_sector", "category")


# --- joins ---------------------------------------------------------------------


@query("join_inner", "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
def _(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query("join_chain_key", """
    SELECT doc_id, quality, toxic, n_chars, len(regexp_extract_all(text, '[^ \\n]+')) AS words, vectors.label FROM documents JOIN labels USING (doc_id)
    JOIN embeddings vectors ON doc_id = vec_id""")
def _(t):
    """Three tables on one key, which is shuffled once per table."""
    words = F.regexp_count("text", F.lit(r"[^ \n]+")).cast("bigint").alias("words")
    vectors = t.embeddings.select(F.col("vec_id").alias("doc_id"), "label")
    return t.documents.select("doc_id", "n_chars", words).join(t.labels, "doc_id").join(vectors, "doc_id").select("doc_id", "quality", "toxic", "n_chars", "words", "label")


@query("join_left_map", "SELECT round, permalink, primary_sector, sector FROM sectored", ("sectored",))
def _(t):
    return sectored(t).select("round", "permalink", "primary_sector", "sector")


@query("join_agg_back", """
    SELECT round, sector, CASE WHEN sector IS NOT NULL THEN count(*) OVER w END AS investments,
           CASE WHEN sector IS NOT NULL THEN sum(amount::DECIMAL(18,2)) OVER w END::DOUBLE AS invested FROM sectored
    WINDOW w AS (PARTITION BY sector)""", ("sectored",))
def _(t):
    totals = {"investments": F.count("*"), "invested": money_sum("amount")}
    return rel.add_group_totals(sectored(t).select("round", "sector", "amount"), "sector", totals).drop("amount")


@query("join_anti_count", "SELECT count(*) AS n FROM funding WHERE lower(company) NOT IN (SELECT permalink FROM companies WHERE country <> '')", ("funding", "companies"))
def _(t):
    """Funding of companies without a country."""
    return rel.anti_count(t.funding.withColumn("permalink", F.lower("company")), t.companies.where("country != ''"), "permalink", "permalink")


ACTIVE = '''items AS (SELECT item FROM ratings GROUP BY item HAVING count(*) >= 70),
    users AS (SELECT "user" FROM ratings GROUP BY "user" HAVING count(*) >= 45)'''


@query("join_semi_filter", f"""+{ACTIVE}
---
    SELECT "user", item, rating FROM ratings WHERE item IN (SELECT item FROM items) AND "user" IN (SELECT "user" FROM users)""", ("ratings",))
def _(t):
    items = materialize(rel.group_counts(t.ratings, "item").where("n >= 70"), "active-items")
    users = materialize(rel.group_counts(t.ratings, "user").where("n >= 45"), "active-users")
    return t.ratings.join(items, "item", "left_semi").join(users, "user", "left_semi").select("user", "item", "rating")


@query("join_fact_dim_fine", """
    SELECT code, n, fine, n * fine AS amount FROM (SELECT code, count(*) AS n FROM tickets_year GROUP BY code) JOIN fines USING (code)""",
    ("tickets_year", "fines"))
def _(t):
    return rel.group_counts(t.tickets_year, "code").join(t.fines, "code").withColumn("amount", F.col("n") * F.col("fine"))


# --- aggregates ----------------------------------------------------------------


@query("agg_count_by", "SELECT vendor, count(*) AS n FROM trips GROUP BY vendor", ("trips",))
def _(t):
    return rel.group_counts(t.fares, "vendor")


@query("agg_count_nonnull_by", "SELECT violation_time, count(violation_time) AS n FROM tickets GROUP BY violation_time", ("tickets",))
def _(t):
    return t.tickets.groupBy("violation_time").agg(F.count("violation_time").alias("n"))


@query("agg_avg_by", "SELECT month(pickup)::INT AS mnth, round(sum(fare::DECIMAL(18,2))::DOUBLE / count(*), 4) AS fare FROM trips GROUP BY 1", ("trips",))
def _(t):
    return t.trips.groupBy(F.month("pickup").alias("mnth")).agg(F.round(money_sum("fare") / F.count("*"), 4).alias("fare")).orderBy("mnth")


@query("agg_sum_by", "SELECT country, sum(amount::DECIMAL(18,2))::DOUBLE AS raised FROM master WHERE round_type = '1-URGENT' GROUP BY 1 HAVING country <> ''", ("master",))
def _(t):
    urgent = master(t).where(F.col("round_type") == "1-URGENT")
    return urgent.groupBy("country").agg(money_sum("amount").alias("raised")).where("country != ''")


@query("agg_global", """
    SELECT 'FY_' || fiscal_year AS label, count(*) AS n, sum(code)::BIGINT AS codes, round(avg(code), 6) AS mean_code FROM tickets_year GROUP BY 1
    UNION ALL SELECT 'all', count(*), sum(code)::BIGINT, round(avg(code), 6) FROM tickets_year""", ("tickets_year",))
def _(t):
    measures = [F.count("*").alias("n"), F.sum("code").alias("codes"), F.round(F.avg("code"), 6).alias("mean_code")]
    yearly = t.tickets_year.groupBy(F.format_string("FY_%d", "fiscal_year").alias("label")).agg(*measures)
    return yearly.unionByName(t.tickets_year.agg(*measures).select(F.lit("all").alias("label"), "n", "codes", "mean_code"))


@query("agg_distinct_count", """
    SELECT (SELECT count(*) FROM (SELECT DISTINCT lower(company) FROM funding)) AS companies, count(DISTINCT state) AS states FROM tickets""",
    ("funding", "tickets"))
def _(t):
    """Both conventions: distinct rows then count, and a distinct count that ignores NULL."""
    companies = t.funding.select(F.lower("company").alias("c")).distinct().agg(F.count("*")).scalar()
    return t.tickets.agg(F.countDistinct("state").alias("states")).select(companies.alias("companies"), "states")


@query("agg_conditional_share", """
    SELECT count(*) AS n, count(*) FILTER (WHERE passengers = 1) AS solo,
           round(100.0::DOUBLE * count(*) FILTER (WHERE passengers = 1) / count(*), 6) AS solo_percent,
           round(100.0::DOUBLE * count(*) FILTER (WHERE payment = 2) / count(*), 6) AS cash_percent,
           round(100.0::DOUBLE * count(*) FILTER (WHERE extra = 0) / count(*), 6) AS no_extra_percent,
           round(100.0::DOUBLE * count(*) FILTER (WHERE extra <> 0) / count(*), 6) AS extra_percent FROM trips""", ("trips",))
def _(t):
    c = F.col
    return t.fares.agg(
        F.count("*").alias("n"), F.count_if(c("passengers") == 1).alias("solo"), F.round(rel.share(c("passengers") == 1), 6).alias("solo_percent"),
        F.round(rel.share(c("payment") == 2), 6).alias("cash_percent"), F.round(rel.share(c("extra") == 0), 6).alias("no_extra_percent"),
        F.round(rel.share(c("extra") != 0), 6).alias("extra_percent"))


@query("agg_conditional_avg", """+
    s AS (SELECT month(pickup) AS m, day(pickup) AS d, distance / nullif(epoch_us(dropoff - pickup) / 3600000000, 0) AS speed FROM trips)
---
    SELECT round(avg(speed), 4) AS overall, round(avg(speed) FILTER (WHERE m = 11), 4) AS november, round(avg(speed) FILTER (WHERE m = 12), 4) AS december,
           round(avg(speed) FILTER (WHERE m = 12 AND d = 25), 4) AS christmas, round(avg(speed) FILTER (WHERE m = 12 AND d = 31), 4) AS new_year FROM s""",
    ("trips",))
def _(t):
    s = t.trips.select(F.month("pickup").alias("m"), F.day("pickup").alias("d"), scalars.speed("distance", "pickup", "dropoff").alias("speed"))
    december = F.col("m") == 12
    when = {"november": F.col("m") == 11, "december": december, "christmas": december & (F.col("d") == 25), "new_year": december & (F.col("d") == 31)}
    return s.agg(F.round(F.avg("speed"), 4).alias("overall"), *[F.round(F.avg(F.when(w, F.col("speed"))), 4).alias(n) for n, w in when.items()])


@query("agg_bucket_share_wide", "SELECT " + ", ".join(
    f"round(100.0::DOUBLE * count(*) FILTER (WHERE {w}) / count(*), 6) AS bucket{i}_percent" for i, w in enumerate(
        ["tip >= 0 AND tip < 5", "tip >= 5 AND tip < 10", "tip >= 10 AND tip < 15", "tip >= 15 AND tip < 20", "tip < 0 OR tip >= 20"], 1))
    + " FROM trips", ("trips",))
def _(t):
    binned = t.fares.select(scalars.bin_label("tip", scalars.TIP_BINS, "left", "Bucket_5").alias("bucket"))
    return binned.agg(*[F.round(rel.share(F.col("bucket") == f"Bucket_{i}"), 6).alias(f"bucket{i}_percent") for i in range(1, 6)])


@query("agg_percentiles", """
    SELECT round(avg(tip), 6) AS mean, round(quantile_cont(tip, 0.25), 6) AS p25, round(quantile_cont(tip, 0.5), 6) AS p50,
           round(quantile_cont(tip, 0.75), 6) AS p75, true AS approx_close FROM trips WHERE payment <> 2""", ("trips",))
def _(t):
    """Mean with exact percentiles, and whether the one-pass approximation lies next to them."""
    paid = t.fares.where(F.col("payment") != 2)
    exact = quantiles.exact_quantiles(paid, ["tip"], [0.25, 0.5, 0.75]).groupBy().agg(
        *[F.max(F.when(F.col("prob") == p, F.round("value", 6))).alias(f"e{round(100 * p)}") for p in [0.25, 0.5, 0.75]])
    packed = exact.select(F.struct("e25", "e50", "e75")).scalar()
    near = rel.mean_and_percentiles(paid, "tip", [0.25, 0.5, 0.75]).withColumn("exact", packed)
    close = (F.abs(F.col("p25") - F.col("exact.e25")) <= 2.5) & (F.abs(F.col("p50") - F.col("exact.e50")) <= 2.5) & (F.abs(F.col("p75") - F.col("exact.e75")) <= 2.5)
    return near.select(F.round("mean", 6).alias("mean"), F.col("exact.e25").alias("p25"), F.col("exact.e50").alias("p50"), F.col("exact.e75").alias("p75"),
                       close.alias("approx_close"))


@query("agg_corr", """
    SELECT round(corr(passengers, tip), 6) AS correlation, round(avg(tip) FILTER (WHERE passengers = 1), 6) AS solo_tip,
           round(avg(tip) FILTER (WHERE passengers <> 1), 6) AS group_tip FROM trips WHERE payment <> 2""", ("trips",))
def _(t):
    alone = F.col("passengers") == 1
    return t.fares.where(F.col("payment") != 2).agg(
        F.round(F.corr("passengers", "tip"), 6).alias("correlation"), F.round(F.avg(F.when(alone, F.col("tip"))), 6).alias("solo_tip"),
        F.round(F.avg(F.when(~alone, F.col("tip"))), 6).alias("group_tip"))


NUMERIC = ["passengers", "distance", "fare", "extra", "mta", "tip", "total"]


@query("agg_corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS correlation FROM trips" for i, a in enumerate(NUMERIC) for b in NUMERIC[i:]), ("trips",))
def _(t):
    return rel.correlation_matrix(t.fares, NUMERIC).withColumn("correlation", F.round("correlation", 6) + F.lit(0.0))


CV = "round(100 * stddev_samp(profit::DOUBLE) / avg(profit::DOUBLE), 4)"


@query("agg_multi_by", f"""
    SELECT market, segment, strftime(date_trunc('month', order_date), '%Y-%m') AS month, sum(sales)::DOUBLE AS sales, sum(profit)::DOUBLE AS profit,
           count(*) AS quantity, {CV} AS cv FROM sales
    GROUP BY GROUPING SETS ((market), (market, segment), (market, segment, strftime(date_trunc('month', order_date), '%Y-%m')))""", ("sales",))
def _(t):
    """Three grains in one pass; NULL marks a column the grain does not have."""
    dated = t.sales.withColumn("month", F.date_format("order_date", "yyyy-MM")).withColumn("p", F.col("profit").cast("double"))
    market, segment, month = F.col("market"), F.col("segment"), F.col("month")
    return dated.groupingSets([[market], [market, segment], [market, segment, month]], market, segment, month).agg(
        F.sum("sales").cast("double").alias("sales"), F.sum("profit").cast("double").alias("profit"), F.count("*").alias("quantity"),
        F.round(100 * F.stddev_samp("p") / F.avg("p"), 4).alias("cv"))


@query("agg_cv_rank", f"""+
    g AS (SELECT market, segment, sum(profit)::DOUBLE AS profit, {CV} AS cv FROM sales GROUP BY 1, 2)
---
    SELECT *, rank() OVER (ORDER BY profit DESC) AS profit_rank, rank() OVER (ORDER BY cv) AS stability_rank FROM g
    QUALIFY rank() OVER (ORDER BY cv) <= 5""", ("sales",))
def _(t):
    from tallygrain.operators import timeseries as ts

    return ts.stable_segments(t.sales, ["market", "segment"], "profit", 5)


@query("agg_prop_table", "SELECT target, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM emp), 6) AS proportion FROM emp GROUP BY 1", ("emp",))
def _(t):
    total = t.emp.agg(F.count("*")).scalar()
    return rel.group_counts(t.emp, "target").withColumn("proportion", F.round(F.col("n") / total, 6))


@query("agg_crosstab", """
    SELECT lang, count(*) FILTER (WHERE target = 0) AS target_0, count(*) FILTER (WHERE target = 1) AS target_1 FROM emp GROUP BY 1""", ("emp",))
def _(t):
    counts = t.emp.groupBy("lang").pivot("target", [0, 1]).count()
    return counts.select("lang", *[F.coalesce(F.col(str(v)), F.lit(0)).alias(f"target_{v}") for v in [0, 1]])


@query("agg_histogram", "SELECT floor(l_extendedprice / 5000)::INT AS bin, count(*) AS n FROM lineitem GROUP BY 1")
def _(t):
    return rel.histogram(t.lineitem, "l_extendedprice", 0, 5000)


@query("agg_freq_of_freq", """+
    c AS (SELECT item, count(*) AS reviews FROM ratings GROUP BY item)
---
    SELECT reviews, count(*) AS items, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM c), 6) AS ratio FROM c GROUP BY 1""", ("ratings",))
def _(t):
    counts = materialize(rel.group_counts(t.ratings, "item", out="reviews"), "item-counts")
    total = counts.agg(F.count("*")).scalar()
    return rel.group_counts(counts, "reviews", out="items").withColumn("ratio", F.round(100 * F.col("items") / total, 6))


@query("agg_mean_of_counts", """
    SELECT 'item' AS axis, round(avg(n), 6) AS mean_reviews FROM (SELECT count(*) AS n FROM ratings GROUP BY item)
    UNION ALL SELECT 'user', round(avg(n), 6) FROM (SELECT count(*) AS n FROM ratings GROUP BY "user")""", ("ratings",))
def _(t):
    parts = [rel.group_counts(t.ratings, axis).agg(F.round(F.avg("n"), 6).alias("mean_reviews")).select(F.lit(axis).alias("axis"), "mean_reviews")
             for axis in ["item", "user"]]
    return parts[0].unionByName(parts[1])


@query("agg_time_of_day_mode", """+
    c AS (SELECT code, bin, count(*) AS n FROM timed WHERE bin <> 'unknown' GROUP BY 1, 2),
    top AS (SELECT code FROM c GROUP BY code ORDER BY sum(n) DESC, code LIMIT 3)
---
    SELECT code, bin, n, n = max(n) OVER (PARTITION BY code) AS most_common FROM c WHERE code IN (SELECT code FROM top)""", ("timed",))
def _(t):
    """One pass to (code, bin) counts; the three codes come from those counts."""
    counts = materialize(rel.group_counts(timed_tickets(t).where("bin != 'unknown'"), "code", "bin"), "bin-counts")
    totals = counts.groupBy("code").agg(F.sum("n").alias("total"), F.max("n").alias("best"))
    leading = rel.top_k(totals, [], "total", 3, "none", ["code"])
    return counts.join(leading, "code").select("code", "bin", "n", (F.col("n") == F.col("best")).alias("most_common"))


@query("agg_top_revenue_code", """+
    r AS (SELECT code, count(*) * any_value(fine) AS amount FROM tickets_year JOIN fines USING (code) GROUP BY code)
---
    SELECT (SELECT code FROM r ORDER BY amount DESC, code DESC LIMIT 1) AS code, max(amount) AS amount, sum(amount) AS total FROM r""", ("tickets_year", "fines"))
def _(t):
    revenue = rel.group_counts(t.tickets_year, "code").join(t.fines, "code").withColumn("amount", F.col("n") * F.col("fine"))
    return revenue.agg(F.max_by("code", F.struct("amount", "code")).alias("code"), F.max("amount").alias("amount"), F.sum("amount").alias("total"))


# --- windows -------------------------------------------------------------------


@query("win_dense_rank_topk", """+
    b AS (SELECT bin AS grp, code, count(*) AS n FROM timed WHERE bin <> 'unknown' GROUP BY 1, 2),
    s AS (SELECT CASE WHEN month(issue_date) IN (12, 1, 2) THEN 'Winter' WHEN month(issue_date) < 6 THEN 'Spring'
                      WHEN month(issue_date) < 9 THEN 'Summer' ELSE 'Fall' END AS grp, code, count(*) AS n FROM tickets_year GROUP BY 1, 2)
---
    SELECT * FROM (SELECT * FROM b UNION ALL SELECT * FROM s) QUALIFY dense_rank() OVER (PARTITION BY grp ORDER BY n DESC) <= 3""", ("timed", "tickets_year"))
def _(t):
    bins = rel.group_counts(timed_tickets(t).where("bin != 'unknown'").withColumnRenamed("bin", "grp"), "grp", "code")
    seasons = rel.group_counts(t.tickets_year.withColumn("grp", scalars.season("issue_date")), "grp", "code")
    return rel.top_k(bins.unionByName(seasons), ["grp"], "n", 3, "dense")


@query("win_ntile", "SELECT doc_id, score, ntile(10) OVER (ORDER BY score DESC, doc_id)::INT AS tile FROM scored", ("scored",))
def _(t):
    return ordering.ntile(t.scored.select("doc_id", "score"), 10, "score", "doc_id", descending=True)


@query("win_cumsum", """
    SELECT bin, n, sum(n) OVER (ORDER BY bin)::BIGINT AS cum_n, round(100.0::DOUBLE * sum(n) OVER (ORDER BY bin) / sum(n) OVER (), 6) AS cum_percent
    FROM (SELECT floor(o_totalprice / 100)::INT AS bin, count(*) AS n FROM orders GROUP BY 1)""")
def _(t):
    bins = rel.histogram(t.orders, "o_totalprice", 0, 100)
    running = ordering.running_totals(bins, "bin", ["n"])
    return running.select("bin", "n", "cum_n", F.round(100 * F.col("cum_n") / F.col("all_n"), 6).alias("cum_percent"))


@query("win_group_share", """
    SELECT code, season, n, round(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY season), 6) AS season_percent,
           round(100.0::DOUBLE * n / sum(n) OVER (), 6) AS percent
    FROM (SELECT code, quarter(issue_date)::INT AS season, count(*) AS n FROM tickets_year GROUP BY 1, 2)""", ("tickets_year",))
def _(t):
    counts = rel.group_counts(t.tickets_year.withColumn("season", F.quarter("issue_date")), "code", "season")
    total = counts.agg(F.sum("n")).scalar()
    return rel.add_group_totals(counts, "season", {"all_n": F.sum("n")}).select(
        "code", "season", "n", F.round(100 * F.col("n") / F.col("all_n"), 6).alias("season_percent"), F.round(100 * F.col("n") / total, 6).alias("percent"))


# --- order, limits, top-k ------------------------------------------------------


@query("sort_multi", "SELECT code, bin, count(*) AS n FROM timed GROUP BY 1, 2 ORDER BY 1, 2, 3 DESC", ("timed",))
def _(t):
    return rel.group_counts(timed_tickets(t), "code", "bin").orderBy("code", "bin", F.desc("n"))


@query("topk_head", "SELECT code, count(*) AS n FROM tickets GROUP BY 1 ORDER BY n DESC, code LIMIT 5", ("tickets",))
def _(t):
    return rel.top_k(rel.group_counts(t.tickets, "code"), [], "n", 5, "none", ["code"])


@query("topk_ties", """
    SELECT * FROM (SELECT country, sum(amount::DECIMAL(18,2))::DOUBLE AS raised FROM master WHERE round_type = '1-URGENT' AND country <> '' GROUP BY 1)
    QUALIFY rank() OVER (ORDER BY raised DESC) <= 9""", ("master",))
def _(t):
    urgent = master(t).where((F.col("round_type") == "1-URGENT") & (F.col("country") != ""))
    return rel.top_k(urgent.groupBy("country").agg(money_sum("amount").alias("raised")), [], "raised", 9, "rank").orderBy(F.desc("raised"))


@query("topk_group_company", """+
    f AS (SELECT * FROM sectored WHERE country IN ('NATION_1', 'NATION_2', 'NATION_3') AND amount BETWEEN 50000 AND 400000 AND sector IS NOT NULL),
    r AS (SELECT country, sector, row_number() OVER (PARTITION BY country ORDER BY count(*) DESC, sector) AS group_rank FROM f GROUP BY 1, 2)
---
    SELECT country, sector, group_rank, permalink, amount FROM (
      SELECT country, sector, group_rank, permalink, sum(amount::DECIMAL(18,2))::DOUBLE AS amount FROM f JOIN r USING (country, sector)
      WHERE group_rank <= 2 GROUP BY ALL)
    QUALIFY rank() OVER (PARTITION BY country, group_rank ORDER BY amount DESC) = 1""", ("sectored",))
def _(t):
    chosen = sectored(t).where(F.col("country").isin("NATION_1", "NATION_2", "NATION_3") & F.col("amount").between(50000, 400000))
    exact = chosen.withColumn("amount", F.col("amount").cast(MONEY))
    best = rel.top_value_in_ranked_group(exact, "country", "sector", "permalink", "amount", [1, 2])
    return best.withColumns({"amount": F.col("amount").cast("double"), "group_rank": F.col("group_rank").cast("bigint")})


@query("topk_common_codes", """+
    c AS (SELECT precinct, code, count(*) AS n FROM tickets WHERE precinct <> 0 GROUP BY 1, 2),
    p AS (SELECT precinct, sum(n) AS size FROM c GROUP BY 1 ORDER BY size DESC, precinct LIMIT 3),
    l AS (SELECT c.*, size FROM c JOIN p USING (precinct) QUALIFY rank() OVER (PARTITION BY precinct ORDER BY n DESC) <= 5),
    o AS (SELECT code, sum(n)::DOUBLE / (SELECT sum(n) FROM c) AS overall FROM c GROUP BY 1)
---
    SELECT code, count(*) AS in_groups, round(100 * max(n::DOUBLE / size), 4) AS top_share, round(100 * max(overall), 4) AS overall_share,
           count(*) FILTER (WHERE n::DOUBLE / size > 1.2 * overall) AS exceptional_in, count(*) = 3 AS is_common FROM l JOIN o USING (code) GROUP BY code""",
    ("tickets",))
def _(t):
    return rel.common_items(t.tickets, "precinct", "code", 3, 5, exclude=[0])


@query("topk_offset_slice", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey NULLS LAST, o_totalprice OFFSET 10")
def _(t):
    """Rows after the first ten by key and price, without a single-task offset.

    The tenth row comes from a top ten; rows behind it stay, and of rows equal to it as many as the first ten did not take. NULL keys come last.
    """
    rows = t.orders.select("o_orderkey", "o_totalprice")
    pair = F.struct(F.col("o_orderkey").isNull().alias("n"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("p"))
    first = rows.select(pair.alias("r")).orderBy("r").limit(10)
    last = materialize(first.agg(F.max("r").alias("last"), F.array_sort(F.collect_list("r")).alias("all")), "first-rows")
    taken = last.select(F.size(F.filter("all", lambda x: x == F.col("last")))).scalar()
    tenth = last.select("last").scalar()
    behind = rows.where(pair > tenth)
    level = rows.where(pair == tenth).groupBy("o_orderkey", "o_totalprice").agg(F.count("*").alias("n")).withColumn("more", F.col("n") - taken).where("more > 0")
    return behind.unionByName(level.select("o_orderkey", "o_totalprice", F.explode(F.array_repeat(F.lit(1), F.col("more").cast("int"))).alias("one")).drop("one"))


@query("topk_groups_vs_rest", """+
    c AS (SELECT precinct, code, count(*) AS n FROM tickets WHERE precinct <> 0 GROUP BY 1, 2),
    p AS (SELECT precinct FROM c GROUP BY 1 ORDER BY sum(n) DESC, precinct LIMIT 3)
---
    SELECT CASE WHEN precinct IN (SELECT precinct FROM p) THEN precinct::VARCHAR ELSE 'Other' END AS label, code, sum(n)::BIGINT AS n FROM c GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY label ORDER BY sum(n) DESC, code) <= 5""", ("tickets",))
def _(t):
    return rel.groups_vs_rest(t.tickets, "precinct", "code", 3, 5, exclude=[0])


# --- sets ----------------------------------------------------------------------


@query("set_union_all", "SELECT c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier")
def _(t):
    customers = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query("set_difference", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def _(t):
    return t.documents.select("doc_id").subtract(t.labels.select("doc_id"))


@query("set_distinct", "SELECT DISTINCT payment, store_flag FROM trips", ("trips",))
def _(t):
    return t.fares.select("payment", "store_flag").distinct()
