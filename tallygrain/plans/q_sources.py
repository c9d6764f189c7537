"""Readers, writers and catalog queries: whole tables make a round trip through files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallygrain.plans.q_quality import ERROR_SQL, trip_rules
from tallygrain.operators import quality
from tallygrain.plans.registry import query
from tallygrain.session import scratch_path
from tallygrain.sources import catalog, readers, writers


@query("src_delimited_schema", """
    SELECT vendor AS VendorID, strftime(pickup, '%Y-%m') AS pickup_month, count(*) AS n, sum(passengers)::BIGINT AS passengers,
           round(sum(fare::DECIMAL(18,2))::DOUBLE, 2) AS fare, round(avg(tip), 4) AS tip FROM trips GROUP BY 1, 2""", ("trips",))
def _(t):
    """The 17-column trip file: written from the stand-in, read back with the declared schema."""
    sources = ["vendor", "pickup", "dropoff", "passengers", "distance", "rate_code", "store_flag", "pu_location", "do_location",
               "payment", "fare", "extra", "mta", "tip", "tolls", "surcharge", "total"]
    path = scratch_path(t.spark, "trips-csv")
    named = [F.col(s).alias(f.name) for s, f in zip(sources, readers.TRIP_SCHEMA.fields)]
    writers.write_csv(t.trips.select(*named), path)
    trips = readers.read_delimited(t.spark, path, readers.TRIP_SCHEMA)
    return trips.groupBy("VendorID", F.date_format("tpep_pickup_datetime", "yyyy-MM").alias("pickup_month")).agg(
        F.count("*").alias("n"), F.sum("Passenger_count").alias("passengers"),
        F.sum(F.col("Fare_amount").cast("decimal(18,2)")).cast("double").alias("fare"), F.round(F.avg("Tip_amount"), 4).alias("tip"))


@query("src_csv_infer", """
    SELECT o_orderkey::INT AS o_orderkey, o_custkey::INT AS o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""")
def _(t):
    path = scratch_path(t.spark, "orders-csv")
    writers.write_csv(t.orders, path)
    frame = readers.read_delimited(t.spark, path, infer=True)
    return frame.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query("src_csv_plain", "SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    path = scratch_path(t.spark, "customer-csv")
    writers.write_csv(t.customer, path)
    frame = readers.read_delimited(t.spark, path)
    return frame.withColumns({"c_nationkey": F.col("c_nationkey").try_cast("int"), "c_acctbal": F.col("c_acctbal").try_cast("double")})


@query("src_tsv", "SELECT * FROM nation")
def _(t):
    path = scratch_path(t.spark, "nation-tsv")
    writers.write_csv(t.nation, path, sep="\t")
    schema = T.StructType.fromDDL("n_nationkey int, n_name string, n_regionkey int")
    return readers.read_delimited(t.spark, path, schema, sep="\t")


@query("src_csv_latin1", r"""
    SELECT doc_id, lang, regexp_replace(text, '[^\x09\x0A\x0D\x20-\x7E\xA0-\xFF]', '?', 'g') AS text FROM documents""")
def _(t):
    """Accented text through an ISO-8859-1 file; characters outside the encoding are '?' beforehand."""
    path = scratch_path(t.spark, "documents-latin1")
    text = F.regexp_replace("text", r"[^\x09\x0A\x0D\x20-\x7E\xA0-\xFF]", "?")
    # a line break inside a field is stored escaped: files in this encoding then stay splittable by line
    stored = F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    writers.write_csv(t.documents.select("doc_id", "lang", stored.alias("text")), path, encoding="ISO-8859-1")
    schema = T.StructType.fromDDL("doc_id bigint, lang string, text string")
    frame = readers.read_delimited(t.spark, path, schema, encoding="ISO-8859-1")
    mark = F.lit("\u0001")
    back = F.replace(F.replace(F.replace(F.replace(F.col("text"), F.lit("\\\\"), mark), F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")), mark, F.lit("\\"))
    return frame.withColumn("text", back)


@query("src_object_store", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def _(t):
    """The same reader on the path as the cluster names it; object stores and HDFS differ only in the scheme."""
    path = scratch_path(t.spark, "orders-uri")
    writers.write_csv(t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority"), path)
    return readers.read_delimited(t.spark, path, T.StructType.fromDDL("o_orderkey bigint, o_totalprice double, o_orderpriority string"))


@query("src_multi_period", "SELECT year(o_orderdate)::INT AS period, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2")
def _(t):
    """One file set per year, written in one pass, read together with the year as a key of every group."""
    schema = T.StructType.fromDDL("o_orderkey bigint, o_orderstatus string, o_totalprice double")
    path = scratch_path(t.spark, "orders-by-year")
    dated = t.orders.select(*schema.names, F.year("o_orderdate").alias("period"))
    dated.write.partitionBy("period").option("header", True).csv(path)
    tagged = readers.read_partitioned(t.spark, path, schema, "period")
    return tagged.groupBy("period", "o_orderstatus").agg(F.count("*").alias("n"))


@query("src_html_pages", "SELECT page_id, url, md5(html) AS digest, length(html)::INT AS n FROM pages")
def _(t):
    pages = readers.read_pages(t.spark, f"{t.sf_dir}/pages.parquet")
    return pages.select("page_id", "url", F.md5("html").alias("digest"), F.length("html").alias("n"))


@query("cat_temp_view", "SELECT state, count(*) AS n FROM tickets GROUP BY state", ("tickets",))
def _(t):
    catalog.register(t.tickets, "tallygrain_tickets")
    return t.spark.sql("SELECT state, count(*) AS n FROM tallygrain_tickets GROUP BY state")


@query("cat_drop_if_exists", "SELECT count(*) AS n, sum(r_regionkey)::BIGINT AS keys FROM region")
def _(t):
    """Create the table twice: the second creation drops the first."""
    catalog.replace_table(t.nation, "tallygrain_geo", scratch_path(t.spark, "geo"))
    geo = catalog.replace_table(t.region, "tallygrain_geo", scratch_path(t.spark, "geo"))
    return geo.agg(F.count("*").alias("n"), F.sum("r_regionkey").alias("keys"))


@query("sink_orc_partitioned", f"""
    SELECT month(pickup)::INT AS mnth, day(pickup)::INT AS days, count(*) AS n, round(sum(fare::DECIMAL(18,2))::DOUBLE, 2) AS fare
    FROM trips WHERE NOT {ERROR_SQL} GROUP BY 1, 2""", ("trips",))
def _(t):
    """Clean trips into an ORC table partitioned by month and day, read back."""
    path = scratch_path(t.spark, "trips-orc")
    kept = quality.clean(t.trips, trip_rules()).withColumns({"mnth": F.month("pickup"), "days": F.day("pickup")})
    writers.write_partitioned(kept, path, ["mnth", "days"])
    back = t.spark.read.schema(kept.schema).orc(path)
    return back.groupBy("mnth", "days").agg(F.count("*").alias("n"), F.sum(F.col("fare").cast("decimal(18,2)")).cast("double").alias("fare"))


@query("sink_csv_blank_null", "SELECT round, company, round_type, amount FROM funding", ("funding",))
def _(t):
    path = scratch_path(t.spark, "funding-csv")
    writers.write_csv(t.funding, path)
    schema = T.StructType.fromDDL("round bigint, company string, round_type string, amount double")
    return readers.read_delimited(t.spark, path, schema)


@query("sink_csv_indexed", """
    SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS "index", o_orderkey, o_totalprice FROM orders""")
def _(t):
    path = scratch_path(t.spark, "orders-indexed")
    writers.write_csv_indexed(t.orders.select("o_orderkey", "o_totalprice"), path, "o_orderkey")
    return readers.read_delimited(t.spark, path, T.StructType.fromDDL("index bigint, o_orderkey bigint, o_totalprice double"))


@query("scan_preview", "SELECT * FROM customer ORDER BY c_custkey LIMIT 20")
def _(t):
    return t.customer.orderBy("c_custkey").limit(20)
