"""Impressions derived from the event, customer and nation tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.sources.impressions import enrich


def impressions(spark: SparkSession, folder: str) -> DataFrame:
    """One row per event, keyed by ``id``, with the fields of an impression."""
    table = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    joined = (
        table("events")
        .join(table("customer"), F.col("user_id") == F.col("c_custkey"), "left")
        .join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )
    none = F.lit("none")
    return joined.select(
        F.col("event_id").alias("id"),
        (F.col("event_type") == "click").cast("int").alias("click"),
        F.date_format("ts", "yyMMddHH").cast("int").alias("hour"),
        (F.col("event_id") % 7).cast("int").alias("banner_pos"),
        (F.col("user_id") % 5).cast("int").alias("device_type"),
        (F.col("event_id") % 4).cast("int").alias("device_conn_type"),
        F.coalesce("c_mktsegment", none).alias("site_category"),
        F.coalesce("n_name", none).alias("app_category"),
        F.get_json_object("props", "$.k").alias("site_id"),
        F.concat(F.lit("d"), (F.floor("value").cast("int") % 60).cast("string")).alias("site_domain"),
        F.coalesce("c_name", none).alias("app_id"),
        F.concat(F.lit("n"), F.coalesce(F.col("c_nationkey").cast("string"), F.lit("x"))).alias(
            "app_domain"
        ),
        F.col("user_id").cast("string").alias("device_model"),
    )


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich(impressions(spark, folder))
