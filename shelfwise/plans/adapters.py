"""Catalog views over the given star-schema tables.

The tables hold no product catalog. These views derive one row per order (the
catalog), per part (the texts) or per event (the registry), with the flaws the
operators are for: missing countries, prices without a number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.cleaning import bonus_rating
from shelfwise.functions.hashing import hash_normal
from shelfwise.functions.labels import encode_metric_label

# Bonus tables for the keys these tables have.
NATION_BONUS = {"NATION_0": 0.5, "NATION_1": 0.3, "NATION_2": 0.2, "NATION_3": 0.3, "NATION_4": 0.2, "NATION_5": 0.1}
STATUS_BONUS = {"F": 0.2, "O": 0.1, "P": 0.3}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A messy catalog: one row per order."""
    key = F.col("o_orderkey")
    amount = (F.col("o_totalprice") / 20000).cast("decimal(12,2)").cast("string")
    country = F.when(key % 11 == 0, F.lit(None)).when(key % 13 == 0, F.lit("NA")).otherwise(F.col("n_name"))
    price = (
        F.when(key % 17 == 0, F.lit(None)).when(key % 19 == 0, F.lit("call us"))
        .when(key % 23 == 0, F.concat(F.lit("€"), amount))
        .otherwise(F.concat(F.lit("$"), amount, F.lit(" / 75cl")))
    )
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            key.alias("id"), F.col("o_orderpriority").alias("Style"), F.col("c_mktsegment").alias("Grape"),
            F.col("o_orderstatus").alias("Type"), country.alias("Country"), F.col("r_name").alias("Region"),
            price.alias("Price"),
        )
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One describing text per part."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.lower(F.concat("p_name", F.lit(" "), "p_brand", F.lit(" "), "p_type")).alias("text"),
    )


def predictions(prepared: DataFrame) -> DataFrame:
    """Prepared items with a bonus rating and a noisy prediction of it."""
    rated = prepared.withColumn("Rating", bonus_rating(
        F.col("price_numeric"), F.col("Country"), F.col("Type"), F.col("id"),
        country_bonus=NATION_BONUS, type_bonus=STATUS_BONUS,
    ))
    return rated.withColumn("prediction", F.col("Rating") + hash_normal(F.col("id"), "prediction", 0.1))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model registry: one version per event, twenty display names."""
    quality = F.least(F.col("value") / 100, F.lit(1.0))
    ready = F.element_at(
        F.array(F.lit("true"), F.lit("TRUE"), F.lit("false"), F.lit(None)), (F.col("event_id") % 4 + 1).cast("int")
    )
    labels = F.map_filter(F.create_map(
        F.lit("ready-for-promotion"), ready,
        F.lit("eval-status"), F.when(F.col("event_type") == "signup", F.lit("completed")).otherwise(F.col("event_type")),
        F.lit("quality-score"), encode_metric_label(quality),
        F.lit("rmse"), encode_metric_label(F.lit(1.0) - quality),
        F.lit("harness-build-id"), F.col("user_id").cast("string"),
        F.lit("env"), F.lit("prd-test"),
    ), lambda _, v: v.isNotNull())
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("models/"), F.col("event_id").cast("string")).alias("resource_name"),
        F.concat(F.lit("model-"), (F.col("user_id") % 20).cast("string")).alias("display_name"),
        F.col("event_id").alias("version"), F.col("ts").alias("create_time"),
        F.concat(F.lit("store/"), F.col("event_id").cast("string")).alias("uri"), F.lit("image:1").alias("image"),
        labels.alias("labels"),
    )


def request_documents(catalog: DataFrame) -> DataFrame:
    """Request documents from raw items: lists, objects, short lists and broken text."""
    fields = ["price_numeric", "Country", "Region", "Type", "Style", "Grape"]
    row = catalog.withColumn("price_numeric", F.regexp_extract("Price", r"(\d+\.\d+)", 1))
    listed = F.to_json(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]))
    short = F.to_json(F.array(F.col("Country"), F.col("Region")))
    named = F.to_json(F.struct(*fields))
    kind = F.col("id") % 10
    document = (
        F.when(kind == 7, F.concat(F.lit('{"instances":['), named, F.lit("]}")))
        .when(kind == 8, F.concat(F.lit('{"instances":['), short, F.lit("]}")))
        .when(kind == 9, F.lit("not a document"))
        .otherwise(F.concat(F.lit('{"instances":['), listed, F.lit(","), listed, F.lit("]}")))
    )
    return row.select("id", document.alias("value"))
