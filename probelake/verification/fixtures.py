"""Measurement-shaped inputs that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from probelake.functions.paths import base_name
from probelake.session import stage
from probelake.sources.readers import list_objects
from probelake.sources.sinks import copy_objects
from probelake.sources.versions import empty_folder

COUNTRY_OF_EVENT = {"click": "BR", "view": "RU", "purchase": "US", "signup": "DE", "error": "FR"}
COUNTRY_OF_PRIORITY = {
    "1-URGENT": "BR",
    "2-HIGH": "DE",
    "3-MEDIUM": "RU",
    "4-NOT SPECIFIED": "US",
    "5-LOW": "FR",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped(column: str, mapping: dict[str, str]) -> Column:
    value = None
    for key, result in mapping.items():
        value = (F if value is None else value).when(F.col(column) == key, result)
    return value


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels; most have none, so the label columns are mostly NULL."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id", "left")


def object_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One object per order: date folders by month, country by priority, size by price.

    A table, like every listing, not an expression that each use of the path would work out again.
    """
    month = F.date_format(F.trunc("o_orderdate", "MM"), "yyyy-MM-dd")
    test_type = F.when(F.col("o_orderstatus") == "P", "dash").otherwise("web_connectivity")
    name = F.concat_ws(
        "-",
        F.date_format("o_orderdate", "yyyyMMdd"),
        mapped("o_orderpriority", COUNTRY_OF_PRIORITY),
        F.concat(F.lit("AS"), F.col("o_custkey").cast("string")),
        test_type,
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".json")),
    )
    objects = table(spark, sf_dir, "orders").select(
        F.concat_ws("/", F.lit("store:/bucket/archive/jsonl"), month, name).alias("path"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("length"),
    )
    # Every folder also has a marker and a file whose name says too little; neither is a measurement file.
    folders = objects.select(F.regexp_extract("path", "^.*/", 0).alias("folder")).distinct()
    names = folders.withColumn("name", F.explode(F.array(F.lit(""), F.lit("short-name.json"))))
    others = names.select(F.concat("folder", "name").alias("path"), F.lit(0).cast("bigint").alias("length"))
    return stage(objects.unionByName(others), "listing")


def measurements(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    """One nested measurement per event, with the page of the same number as its response body.

    With ``copies`` the purchases are there twice, as if uploaded twice.
    """
    events = table(spark, sf_dir, "events")
    if copies:
        events = events.unionByName(events.where(F.col("event_type") == "purchase"))
    rows = events.join(table(spark, sf_dir, "pages"), F.col("event_id") == F.col("page_id"), "left")
    text = {c: F.col(c).cast("string") for c in ("event_id", "user_id", "ts")}
    k = F.get_json_object("props", "$.k")
    answers = F.array(
        F.struct(
            F.lit("A").alias("answer_type"),
            F.concat_ws(".", F.lit("10"), text["user_id"], k, F.lit("1")).alias("ipv4"),
        ),
        F.struct(F.lit("CNAME").alias("answer_type"), F.lit(None).cast("string").alias("ipv4")),
        F.struct(F.lit("A").alias("answer_type"), F.concat(F.lit("172.16.0."), k).alias("ipv4")),
    )
    request = F.struct(F.struct(F.col("html").alias("body")).alias("response"))
    requests = F.filter(F.array(request), lambda r: r["response"]["body"].isNotNull())
    return rows.select(
        F.struct(
            (F.col("event_type") == "error").alias("blocking"),
            F.array(F.struct(answers.alias("answers"))).alias("queries"),
            requests.alias("requests"),
            F.array(F.struct(k.alias("ip"), F.col("user_id").alias("port"))).alias("tcp_connect"),
        ).alias("test_keys"),
        F.struct(F.col("event_type").alias("platform")).alias("annotations"),
        F.date_format("ts", "yyyy-MM-dd").alias("bucket_date"),
        F.concat(F.lit("m"), text["event_id"]).alias("id"),
        F.coalesce(
            F.col("url"),
            F.concat(F.lit("https://"), F.col("event_type"), F.lit(".example.org/"), text["user_id"]),
        ).alias("input"),
        text["ts"].alias("measurement_start_time"),
        F.when(F.col("event_type") != "signup", F.concat(F.lit("AS"), text["user_id"])).alias("probe_asn"),
        mapped("event_type", COUNTRY_OF_EVENT).alias("probe_cc"),
        F.concat_ws(".", text["user_id"], k, F.lit("0"), F.lit("1")).alias("probe_ip"),
        F.concat(F.lit("r"), text["user_id"]).alias("report_id"),
        F.lit("web_connectivity").alias("test_name"),
        F.col("value").alias("test_runtime"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("test_start_time"),
    )


def write_source_objects(lines: DataFrame, scratch: str) -> str:
    """Write text lines as compressed measurement files ``<date>/<time>-<country>-<asn>-<type>-<part>.json.gz``.

    ``lines`` has the columns value, day, country. Returns the root of the files.
    """
    spark, parts, source = lines.sparkSession, f"{scratch}/parts", f"{scratch}/source"
    together = lines.hint("rebalance", "day", "country").write.partitionBy("day", "country")
    together.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(parts)
    objects = list_objects(spark, parts, glob="*.txt.gz")
    day = F.regexp_extract("path", r"/day=([^/]*)/", 1)
    country = F.regexp_extract("path", r"/country=([^/]*)/", 1)
    name = F.concat_ws(
        "-",
        F.lit("20200101T000000Z"),
        country,
        F.lit("AS0"),
        F.lit("web_connectivity"),
        F.regexp_replace(base_name(F.col("path")), r"\.txt\.gz$", ".json.gz"),
    )
    keyed = objects.select("path", F.concat_ws("/", day, name).alias("dest_key"))
    copies = copy_objects(keyed, source)
    copies.write.format("noop").mode("overwrite").save()
    empty_folder(spark, parts)
    return source
