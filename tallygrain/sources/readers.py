"""Readers for delimited text and pages. Paths may be any URI Spark can open (file, HDFS, object store)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names and types of the delimited trip files.
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("Passenger_count", T.IntegerType()),
        T.StructField("Trip_distance", T.DoubleType()),
        T.StructField("RateCodeID", T.IntegerType()),
        T.StructField("Store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("Payment_type", T.IntegerType()),
        T.StructField("Fare_amount", T.DoubleType()),
        T.StructField("Extra", T.DoubleType()),
        T.StructField("MTA_tax", T.DoubleType()),
        T.StructField("Tip_amount", T.DoubleType()),
        T.StructField("Tolls_amount", T.DoubleType()),
        T.StructField("Improvement_surcharge", T.DoubleType()),
        T.StructField("Total_amount", T.DoubleType()),
    ]
)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
    header: bool = True,
    infer: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Read delimited text.

    With a schema there is one scan; ``infer=True`` costs a second one; otherwise all columns are
    strings. ``multiline`` allows line breaks inside quotes, at the price of unsplittable files.
    """
    reader = (
        spark.read.option("header", header).option("sep", sep).option("encoding", encoding)
        .option("multiLine", multiline).option("escape", '"').option("preferDate", True)
    )
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_periods(spark: SparkSession, paths: dict, schema: T.StructType, label: str) -> DataFrame:
    """Files of one layout, one path per period, tagged with the period and stacked."""
    frames = [read_delimited(spark, path, schema).withColumn(label, F.lit(period)) for period, path in paths.items()]
    return reduce(DataFrame.unionByName, frames)


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType, label: str, kind: T.DataType | None = None) -> DataFrame:
    """Files of one layout below ``<label>=<period>`` folders, in one scan; a filter on the period reads only its folders, and
    rows of no period have NULL."""
    return read_delimited(spark, path, T.StructType([*schema.fields, T.StructField(label, kind or T.IntegerType())]))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Raw review pages stored as a table."""
    return spark.read.parquet(path)
