"""Stand-ins that give the test tables the shape of the analysed datasets.

Each stand-in exists twice: as a DataFrame expression in ``Tables`` and as SQL text in ``VIEWS``.
The two are written independently so that a comparison of results checks both.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.session import materialize

RATED_USERS_MIN = 45
RATED_ITEMS_MIN = 70

# The three sectors of the wide category map, by length of the category word modulo 3.
SECTORS = {"Cleantech": 0, "Media": 1, "Others": 2}

# Fine per violation code is a base amount plus a step times the code.
FINE_BASE, FINE_STEP, FINE_CODES = 40, 5, 12


class Tables:
    """The supplied parquet tables of one scale factor and the stand-ins on top of them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)

    # --- trips -----------------------------------------------------------------

    @staticmethod
    def _trip_columns() -> list[Column]:
        """Trip attributes that come from the line item alone."""
        known = F.col("l_partkey") % 97 != 0  # some trips have no payment type: rules on it cannot be decided
        payment = F.when(~known, None).when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).when(F.col("l_returnflag") == "R", 3)
        return [
            F.when(F.col("l_linestatus") == "O", 1).when(F.col("l_linestatus") == "F", 2).alias("vendor"),
            F.col("l_linenumber").alias("passengers"),
            F.col("l_quantity").alias("distance"),
            (F.col("l_suppkey") % 7 + 1).alias("rate_code"),
            F.col("l_linestatus").alias("store_flag"),
            F.col("l_partkey").alias("pu_location"),
            F.col("l_suppkey").alias("do_location"),
            payment.alias("payment"),
            F.col("l_extendedprice").alias("fare"),
            F.col("l_discount").alias("extra"),
            F.col("l_tax").alias("mta"),
            F.when((payment == 2) & (F.col("l_linenumber") != 7), 0.0).otherwise(F.round(F.col("l_discount") * 250, 2)).alias("tip"),
            F.when(F.col("l_partkey") % 101 == 0, -1.0).otherwise(0.0).alias("tolls"),
            F.when(F.col("l_suppkey") % 50 == 0, 1.0).otherwise(0.3).alias("surcharge"),
            (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("total"),
        ]

    @cached_property
    def fares(self) -> DataFrame:
        """Trips without their times: no join needed."""
        return self.lineitem.select(*self._trip_columns())

    @cached_property
    def trips(self) -> DataFrame:
        """Trips with pickup and dropoff time; the order supplies the pickup."""
        minutes = (F.col("l_partkey") % 90 - 2).cast("int")
        return (
            self.lineitem.join(self.orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .select(
                *self._trip_columns(),
                F.col("o_orderdate").alias("pickup"),
                (F.col("o_orderdate") + F.make_dt_interval(mins=minutes)).alias("dropoff"),
            )
        )

    # --- tickets ---------------------------------------------------------------

    @cached_property
    def tickets(self) -> DataFrame:
        code = F.get_json_object("props", "$.k").cast("int") % 12
        hour12 = F.hour("ts") % 12
        clock = F.when(hour12 == 0, F.when(F.col("event_id") % 7 == 0, "00").otherwise("12")).otherwise(F.lpad(hour12.cast("string"), 2, "0"))
        stamp = F.concat(clock, F.lpad(F.minute("ts").cast("string"), 2, "0"), F.when(F.hour("ts") < 12, "A").otherwise("P"))
        return self.events.select(
            F.col("event_id").alias("summons"),
            F.when(F.col("user_id") % 40 == 0, "99").otherwise(F.concat(F.lit("S"), (F.col("user_id") % 40).cast("string"))).alias("state"),
            F.date_format("ts", "MM/dd/yyyy").alias("issue_date"),
            code.alias("code"),
            (F.col("user_id") % 20).alias("precinct"),
            F.when(F.col("event_id") % 163 != 0, stamp).alias("violation_time"),
            F.col("event_type").alias("make"),
        )

    @cached_property
    def tickets_year(self) -> DataFrame:
        return self.lineitem.select(
            (F.col("l_suppkey") % 12).cast("int").alias("code"),
            F.col("l_shipdate").cast("date").alias("issue_date"),
            F.year("l_shipdate").alias("fiscal_year"),
        )

    @cached_property
    def fines(self) -> DataFrame:
        """Average fine per code: a dimension of a fixed number of rows."""
        codes = self.spark.range(FINE_CODES).select(F.col("id").cast("int").alias("code"))
        return codes.withColumn("fine", (F.lit(FINE_BASE) + FINE_STEP * F.col("code")).cast("double"))

    # --- funding ---------------------------------------------------------------

    @cached_property
    def funding(self) -> DataFrame:
        name = F.concat(F.lit("C-"), F.col("o_custkey").cast("string"))
        return self.orders.select(
            F.col("o_orderkey").alias("round"),
            F.when(F.col("o_orderkey") % 2 == 0, name).otherwise(F.lower(name)).alias("company"),
            F.col("o_orderpriority").alias("round_type"),
            F.when(F.col("o_orderkey") % 17 != 0, F.col("o_totalprice")).alias("amount"),
        )

    @cached_property
    def companies(self) -> DataFrame:
        words = F.split("p_name", " ")
        return (
            self.customer.join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.part, F.col("c_custkey") == F.col("p_partkey"), "left")
            .select(
                F.concat(F.lit("c-"), F.col("c_custkey").cast("string")).alias("permalink"),
                F.when(F.col("c_nationkey") == 0, "").otherwise(F.col("n_name")).alias("country"),
                F.concat_ws("|", words[0], words[1]).alias("categories"),
            )
        )

    @cached_property
    def sector_map(self) -> DataFrame:
        """Wide 0/1 flags per category, with two names damaged as in the mapping file."""
        words = self.part.select(F.split("p_name", " ")[0].alias("category")).distinct()
        damaged = self.region.where("r_regionkey < 2").select(
            F.when(F.col("r_regionkey") == 0, "A0lytics").otherwise("enterprise 2.0").alias("category")
        )
        every = words.unionByName(damaged)
        return every.select("category", *[F.when(F.length("category") % 3 == rest, 1).otherwise(0).alias(name) for name, rest in SECTORS.items()])

    # --- ratings ---------------------------------------------------------------

    @cached_property
    def raw_ratings(self) -> DataFrame:
        step = F.least(F.lit(8), F.floor(F.col("value") / 25).cast("int"))
        return self.events.select(
            "event_id",
            F.col("user_id").alias("user"),
            F.get_json_object("props", "$.k").cast("int").alias("item"),
            (1 + step / 2).alias("rating"),
        )

    @cached_property
    def ratings(self) -> DataFrame:
        """One rating per (user, item): the earliest event."""
        return self.raw_ratings.groupBy("user", "item").agg(F.min_by("rating", "event_id").alias("rating"))

    # --- swipes ----------------------------------------------------------------

    @cached_property
    def swipes(self) -> DataFrame:
        return self.events.groupBy(F.col("user_id").alias("employee"), F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
            F.min("ts").alias("time_in"), F.max("ts").alias("time_out")
        )

    # --- employees -------------------------------------------------------------

    @cached_property
    def emp(self) -> DataFrame:
        """Labelled documents as employees; the target is a rare two-level outcome."""
        words = F.regexp_count("text", F.lit(r"[^ \n]+"))
        lines = F.regexp_count("text", F.lit(r"\n")) + 1
        return self.labels.join(self.documents, "doc_id").select(
            "doc_id",
            F.when(F.col("quality") == 0, 1).otherwise(0).alias("target"),
            F.col("n_chars").cast("double").alias("n_chars"),
            words.cast("double").alias("n_words"),
            lines.cast("double").alias("n_lines"),
            "lang",
            "source",
            F.col("toxic").cast("int").alias("toxic"),
        )

    @cached_property
    def scored(self) -> DataFrame:
        """Employees with a stored score in steps of a thousandth, so that ties occur."""
        raw = 1 / (1 + F.exp(F.col("n_lines") / 20 - F.col("n_words") / 300 + F.col("toxic") - 0.5))
        return materialize(self.emp.select("doc_id", "target", F.round(raw, 3).alias("score")), "scores")

    # --- retail ----------------------------------------------------------------

    @cached_property
    def sales(self) -> DataFrame:
        """Sales transactions with market and segment."""
        return (
            self.orders.join(self.customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(self.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("r_name").alias("market"),
                F.col("c_mktsegment").alias("segment"),
                F.col("o_orderdate").cast("date").alias("order_date"),
                F.col("o_totalprice").cast("decimal(18,2)").alias("sales"),
                ((F.col("o_totalprice").cast("decimal(18,2)") - 200000) / 10).cast("decimal(18,3)").alias("profit"),
            )
        )

    # --- reviews ---------------------------------------------------------------

    @cached_property
    def reviews(self) -> DataFrame:
        return self.documents.select(
            "doc_id",
            F.col("text").alias("review"),
            F.when(F.col("doc_id") % 2 == 0, F.col("text")).alias("pros"),
            F.when(F.col("doc_id") % 2 == 1, F.col("text")).alias("cons"),
        )


# SQL counterparts, in dependency order.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "trips": ((), """
        SELECT CASE l_linestatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 END AS vendor,
               l_linenumber AS passengers, l_quantity AS distance, l_suppkey % 7 + 1 AS rate_code,
               l_linestatus AS store_flag, l_partkey AS pu_location, l_suppkey AS do_location,
               CASE WHEN l_partkey % 97 <> 0 THEN CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END END AS payment,
               l_extendedprice AS fare, l_discount AS extra, l_tax AS mta,
               CASE WHEN l_partkey % 97 <> 0 AND l_returnflag = 'N' AND l_linenumber <> 7 THEN 0.0::DOUBLE
                    ELSE round(l_discount * 250, 2) END AS tip,
               CASE WHEN l_partkey % 101 = 0 THEN -1.0::DOUBLE ELSE 0.0::DOUBLE END AS tolls,
               CASE WHEN l_suppkey % 50 = 0 THEN 1.0::DOUBLE ELSE 0.3::DOUBLE END AS surcharge,
               l_extendedprice * (1 + l_tax) AS total,
               o_orderdate AS pickup, o_orderdate + to_minutes(l_partkey % 90 - 2) AS dropoff
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
    "tickets": ((), """
        SELECT event_id AS summons,
               CASE WHEN user_id % 40 = 0 THEN '99' ELSE 'S' || (user_id % 40)::VARCHAR END AS state,
               strftime(ts, '%m/%d/%Y') AS issue_date,
               regexp_extract(props, '[0-9]+')::INT % 12 AS code, user_id % 20 AS precinct,
               CASE WHEN event_id % 163 <> 0 THEN
                 (CASE WHEN hour(ts) % 12 = 0 THEN CASE WHEN event_id % 7 = 0 THEN '00' ELSE '12' END
                       ELSE lpad((hour(ts) % 12)::VARCHAR, 2, '0') END)
                 || strftime(ts, '%M') || CASE WHEN hour(ts) < 12 THEN 'A' ELSE 'P' END END AS violation_time,
               event_type AS make, ts
        FROM events"""),
    "timed": (("tickets",), """
        SELECT *, CASE WHEN violation_time IS NOT NULL THEN hour(ts) END AS hour_of_day,
               CASE WHEN violation_time IS NULL THEN 'unknown' WHEN hour(ts) < 4 THEN '0_3' WHEN hour(ts) < 8 THEN '4_7'
                    WHEN hour(ts) < 12 THEN '8_11' WHEN hour(ts) < 16 THEN '12_15' WHEN hour(ts) < 20 THEN '16_19'
                    ELSE '20_23' END AS bin
        FROM tickets"""),
    "tickets_year": ((), """
        SELECT (l_suppkey % 12)::INT AS code, l_shipdate AS issue_date, year(l_shipdate) AS fiscal_year FROM lineitem"""),
    "fines": ((), "SELECT range::INT AS code, (40 + 5 * range)::DOUBLE AS fine FROM range(12)"),
    "funding": ((), """
        SELECT o_orderkey AS round,
               CASE WHEN o_orderkey % 2 = 0 THEN 'C-' || o_custkey::VARCHAR ELSE 'c-' || o_custkey::VARCHAR END AS company,
               o_orderpriority AS round_type,
               CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS amount
        FROM orders"""),
    "companies": ((), """
        SELECT 'c-' || c_custkey::VARCHAR AS permalink,
               CASE WHEN c_nationkey = 0 THEN '' ELSE n_name END AS country,
               concat_ws('|', split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)) AS categories
        FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON p_partkey = c_custkey"""),
    "sector_map": ((), """
        SELECT category, (length(category) % 3 = 0)::INT AS Cleantech, (length(category) % 3 = 1)::INT AS Media,
               (length(category) % 3 = 2)::INT AS Others
        FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS category FROM part
              UNION ALL SELECT 'A0lytics' UNION ALL SELECT 'enterprise 2.0')"""),
    "sector_long": (("sector_map",), """
        SELECT lower(replace(replace(category, '0', 'na'), '.na', '.0')) AS category, sector
        FROM (SELECT category, 'Cleantech' AS sector FROM sector_map WHERE Cleantech <> 0
              UNION ALL SELECT category, 'Media' FROM sector_map WHERE Media <> 0
              UNION ALL SELECT category, 'Others' FROM sector_map WHERE Others <> 0)"""),
    "master": (("funding", "companies"), """
        SELECT lower(company) AS permalink, round, round_type, amount, country, categories,
               lower(nullif(split_part(categories, '|', 1), '')) AS primary_sector
        FROM funding JOIN companies ON lower(company) = permalink"""),
    "sectored": (("master", "sector_long"), """
        SELECT m.*, s.sector FROM master m LEFT JOIN sector_long s ON m.primary_sector IS NOT DISTINCT FROM s.category"""),
    "raw_ratings": ((), """
        SELECT event_id, user_id AS "user", regexp_extract(props, '[0-9]+')::INT AS item,
               1 + least(8, floor(value / 25)) / 2 AS rating
        FROM events"""),
    "ratings": (("raw_ratings",), """
        SELECT "user", item, arg_min(rating, event_id) AS rating FROM raw_ratings GROUP BY 1, 2"""),
    "swipes": ((), """
        SELECT user_id AS employee, strftime(ts, '%Y-%m-%d') AS "day", min(ts) AS time_in, max(ts) AS time_out
        FROM events GROUP BY 1, 2"""),
    "emp": ((), r"""
        SELECT doc_id, (quality = 0)::INT AS target, n_chars::DOUBLE AS n_chars,
               len(regexp_extract_all(text, '[^ \n]+'))::DOUBLE AS n_words,
               (len(text) - len(replace(text, chr(10), '')) + 1)::DOUBLE AS n_lines, lang, source, toxic
        FROM labels JOIN documents USING (doc_id)"""),
    "scored": (("emp",), """
        SELECT doc_id, target, round(1 / (1 + exp(n_lines / 20 - n_words / 300 + toxic - 0.5)), 3) AS score FROM emp"""),
    "sales": ((), """
        SELECT r_name AS market, c_mktsegment AS segment, o_orderdate::DATE AS order_date,
               o_totalprice::DECIMAL(18,2) AS sales, ((o_totalprice::DECIMAL(18,2) - 200000) * 0.1)::DECIMAL(18,3) AS profit
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey"""),
    "monthly": (("sales",), """
        SELECT c.market, c.segment, c.month, coalesce(a.sales, 0) AS sales, coalesce(a.quantity, 0) AS quantity
        FROM (SELECT market, segment, unnest(generate_series(lo, hi, INTERVAL 1 MONTH))::DATE AS month
              FROM (SELECT DISTINCT market, segment FROM sales),
                   (SELECT date_trunc('month', min(order_date)) AS lo, date_trunc('month', max(order_date)) AS hi FROM sales)) c
        LEFT JOIN (SELECT market, segment, date_trunc('month', order_date)::DATE AS month, sum(sales) AS sales, count(*) AS quantity
                   FROM sales GROUP BY 1, 2, 3) a USING (market, segment, month)"""),
    "series": (("monthly",), """
        SELECT market, row_number() OVER (PARTITION BY market ORDER BY month) AS t, month(month)::INT AS season, month, y
        FROM (SELECT market, month, sum(sales)::DOUBLE AS y FROM monthly GROUP BY 1, 2)"""),
    "reviews": ((), """
        SELECT doc_id, text AS review, CASE WHEN doc_id % 2 = 0 THEN text END AS pros,
               CASE WHEN doc_id % 2 = 1 THEN text END AS cons
        FROM documents"""),
}


def with_views(names: tuple[str, ...], sql: str) -> str:
    """Prefix ``sql`` with the stand-in views it needs; ``sql`` may open its own WITH list by '+'."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for needed in VIEWS[name][0]:
            visit(needed)
        order.append(name)

    for name in names:
        visit(name)
    parts = [f"{name} AS ({VIEWS[name][1].strip()})" for name in order]
    body = sql.strip()
    recursive = ""
    if body.startswith("+R"):
        recursive, body = "RECURSIVE ", "+" + body[2:]
    if body.startswith("+"):
        own, body = body[1:].split("\n---\n", 1)
        parts.append(own.strip())
    return (f"WITH {recursive}" + ",\n".join(parts) + "\n" if parts else "") + body.strip()
