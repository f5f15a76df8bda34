"""The registered queries: name -> function of (session, table folder)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from probelake.functions import casts, nested, text
from probelake.functions.paths import relative_key
from probelake.operators import filters, quality
from probelake.operators.columns import add_literal, drop_columns, project, rename_columns
from probelake.operators.dedup import deduplicate
from probelake.operators.landing import manifest, not_landed, wanted, within_budget
from probelake.plans.config import GEN_1, GEN_2, Generation, LakeConfig, months
from probelake.plans.delivery import enrich
from probelake.plans.flow import run
from probelake.plans.ingest import ingest
from probelake.plans.trusted import shape, transform
from probelake.schemas import measurement_schema, prune, trusted_fields
from probelake.session import scratch_path
from probelake.sources import catalog
from probelake.sources.readers import date_folders, list_objects, read_measurements, read_table
from probelake.sources.sinks import append_table, copy_objects, write_partitioned
from probelake.streaming.incremental import run_incremental
from probelake.streaming.unique import run_unique
from probelake.verification.fixtures import (
    COUNTRY_OF_EVENT,
    labelled_documents,
    mapped,
    measurements,
    object_listing,
    table,
    write_source_objects,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def as_measurements(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    """The derived measurements as the JSON scan would give them."""
    rows = measurements(spark, sf_dir, copies)
    schema = prune(measurement_schema(), trusted_fields())
    document = F.from_json(F.to_json(F.struct("*")), schema)
    return rows.select(document.alias("m")).select("m.*")


def joined(column: str):
    return F.array_join(F.col(column), ",", "-").alias(column)


# --- projections, casts, keys ---------------------------------------------------


@query
def project_nested(spark, sf_dir):
    documents = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.struct(
            F.col("event_type").alias("blocking"), F.from_json("props", "k bigint").alias("control")
        ).alias("test_keys"),
        F.struct(F.col("event_type").alias("platform")).alias("annotations"),
    )
    fields = {
        "id": "id",
        "blocking": "test_keys.blocking",
        "k": "test_keys.control.k",
        "platform": "annotations.platform",
    }
    return project(documents, fields)


@query
def first_element(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    lines = F.transform(
        F.split("text", "\n"), lambda line: F.struct(F.struct(line.alias("body")).alias("response"))
    )
    requests = F.when(F.col("lang") == "fr", F.slice(lines, 1, 0)).otherwise(lines)
    return documents.select("doc_id", requests.alias("requests")).select(
        "doc_id",
        nested.first_element(F.col("requests"))["response"]["body"].alias("first_line"),
        nested.first_body(F.col("requests")).alias("body"),
    )


@query
def cast_dates(spark, sf_dir):
    as_text = (
        F.when(F.col("o_orderstatus") == "P", F.lit("pending"))
        .when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate").cast("string"))
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", as_text.alias("text"))
    return orders.select(
        "o_orderkey",
        casts.to_date(F.col("text")).alias("order_date"),
        casts.to_timestamp(F.col("text")).cast("string").alias("order_time"),
    )


@query
def row_id(spark, sf_dir):
    key = casts.row_key(F.col("event_id"), F.col("ts"), F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", key.alias("row_id"))


@query
def drop_rename(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    mappings = {"customer": {"c_custkey": "id", "c_mktsegment": "segment", "unknown": "x"}}
    renamed = rename_columns(customers, mappings, "customer")
    unchanged = rename_columns(renamed, mappings, "no such transformation")
    kept = drop_columns(unchanged, ["c_acctbal", "not a column"])
    return add_literal(kept, "bucket_date", "2020-01-01")


# --- dedup ----------------------------------------------------------------------


@query
def dedup_first(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    keyed = documents.select("doc_id", "lang", "source", F.md5("text").alias("row_id"))
    return deduplicate(keyed, order_by=["doc_id"])


def _label_keys(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir)
    key = casts.row_key(F.col("lang"), F.col("quality"), F.col("source"))
    return rows.select("doc_id", key.alias("row_id"))


@query
def dedup_null_collapse(spark, sf_dir):
    return deduplicate(_label_keys(spark, sf_dir), order_by=["doc_id"])


@query
def dedup_null_keep(spark, sf_dir):
    return deduplicate(_label_keys(spark, sf_dir), order_by=["doc_id"], null_keys="keep")


@query
def dedup_arbitrary(spark, sf_dir):
    return deduplicate(_label_keys(spark, sf_dir), keep="arbitrary").select("row_id")


# --- quality --------------------------------------------------------------------


def _metrics(df: DataFrame, constraints: Sequence[quality.Constraint], by: Sequence[str] = ()):
    texts = F.array(*[F.lit(c.text) for c in constraints])
    return quality.measure(df, constraints, by).select(
        *by, F.element_at(texts, F.col("position") + 1).alias("constraint"), "metric"
    )


@query
def completeness(spark, sf_dir):
    columns = ("doc_id", "quality", "toxic", "lang")
    checks = [quality.has_rows(), *[quality.complete(c, 0.9) for c in columns]]
    return _metrics(labelled_documents(spark, sf_dir), checks)


@query
def uniqueness(spark, sf_dir):
    checks = [quality.unique(c) for c in ("event_id", "user_id", "ts")]
    return _metrics(table(spark, sf_dir, "events"), checks)


@query
def containment(spark, sf_dir):
    checks = [
        quality.contained("event_type", ["click", "view", "purchase"]),
        quality.contained("event_type", list(COUNTRY_OF_EVENT)),
    ]
    return _metrics(table(spark, sf_dir, "events"), checks)


EVENT_CHECKS = [
    quality.unique("event_id"),
    quality.complete("user_id", 0.9),
    quality.complete("error_value", 0.9),
    quality.contained("event_type", ["click", "view", "purchase", "signup"]),
    quality.has_rows(),
]


def _checked_events(spark, sf_dir):
    error_value = F.when(F.col("event_type") != "error", F.col("value"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        error_value.alias("error_value"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )


@query
def quality_report(spark, sf_dir):
    report = quality.report(_checked_events(spark, sf_dir), EVENT_CHECKS)
    return add_literal(report.drop("constraint_message"), "bucket_date", "2024-01")


@query
def quality_failures(spark, sf_dir):
    report = quality.report(_checked_events(spark, sf_dir), EVENT_CHECKS)
    return quality.failures(report).select("constraint", "constraint_status")


@query
def quality_report_by_day(spark, sf_dir):
    report = quality.report(_checked_events(spark, sf_dir), EVENT_CHECKS, by=["day"])
    return report.select("day", "check_status", "constraint", "constraint_status")


@query
def quality_messages(spark, sf_dir):
    """Messages of checks over columns with NULLs; the metric apart from the words around it."""
    rows = labelled_documents(spark, sf_dir).select("quality", F.when(F.col("lang") != "es", F.col("lang")).alias("lang"))
    checks = [
        quality.complete("quality", 0.9),
        quality.unique("quality"),
        quality.contained("lang", ["en", "de", "fr"]),
        quality.contained("lang", ["en"]),
    ]
    number = r"(\d[\d.E-]*)"
    message = F.col("constraint_message")
    found = F.regexp_extract(message, number, 1)
    return quality.report(rows, checks).select(
        "constraint",
        "constraint_status",
        F.regexp_replace(message, number, "#").alias("words"),
        F.when(found != "", found.cast("double")).alias("metric"),
    )


LABEL_CHECKS = [
    quality.complete("quality", 0.9),
    quality.complete("doc_id", 0.9),
    quality.contained("lang", ["en", "de"]),
]


@query
def remediate(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir).select("doc_id", "lang", "quality", "toxic")
    return quality.remediate(rows, quality.report(rows, LABEL_CHECKS), LABEL_CHECKS)


@query
def remediate_substring(spark, sf_dir):
    rows = labelled_documents(spark, sf_dir).select(
        F.when(F.col("lang") != "es", F.col("doc_id")).alias("id"),
        F.when(F.col("quality") == 1, F.lit(True)).alias("is_valid"),
        "lang",
    )
    checks = [quality.complete("id", 0.5), quality.complete("is_valid", 0.9)]
    report = quality.report(rows, checks)
    return quality.remediate(rows, report, checks, substring_match=True)


@query
def remediate_by_day(spark, sf_dir):
    rows = _checked_events(spark, sf_dir)
    checks = [quality.complete("error_value", 0.8), quality.contained("event_type", ["click", "error"])]
    report = quality.report(rows, checks, by=["day"])
    return quality.remediate(rows, report, checks, by=["day"])


@query
def remediate_passthrough(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    checks = [quality.unique("event_id"), quality.complete("value", 0.9), quality.has_rows()]
    return quality.remediate(rows, quality.report(rows, checks), checks)


@query
def whitelist(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return filters.whitelist(events, "event_type", ["click", "view"]).select("event_id", "event_type")


# --- text and arrays --------------------------------------------------------------


@query
def ip_valid(spark, sf_dir):
    address = F.concat_ws(
        ".",
        F.col("user_id").cast("string"),
        F.get_json_object("props", "$.k"),
        (F.second("ts") * 5).cast("string"),
        F.minute("ts").cast("string"),
    )
    events = table(spark, sf_dir, "events").select("event_id", address.alias("probe_ip"))
    return events.withColumn("is_ip_valid", text.ip_flag(F.col("probe_ip")))


@query
def url_valid(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", text.url_flag(F.col("url")).alias("is_url_valid"))


@query
def netloc(spark, sf_dir):
    url = F.col("url")
    variants = {
        "domain": url,
        "with_user": F.replace(url, F.lit("://"), F.lit("://me:secret@")),
        "with_port": F.regexp_replace(url, r"(//[^/]*)", "$1:8080"),
        "without_scheme": F.regexp_replace(url, "^[a-z]+:", ""),
        "path_only": F.regexp_replace(url, "^[a-z]+://", ""),
        "bracket": F.replace(url, F.lit("://"), F.lit("://[")),
        "blanks": F.concat(F.lit(" \t"), F.replace(url, F.lit("/"), F.lit("/\n"))),
    }
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", *[text.network_location(u).alias(n) for n, u in variants.items()])


@query
def http_title(spark, sf_dir):
    html = F.col("html")
    tag = F.lit('<TITLE\nlang="x">')
    variants = {
        "http_title": html,
        "in_capitals": F.replace(html, F.lit("<title>"), tag),
        "unclosed": F.replace(html, F.lit("</title>"), F.lit("<title>")),
        "two_titles": F.concat(html, html),
    }
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", *[text.page_title(h).alias(n) for n, h in variants.items()])


@query
def meta_title(spark, sf_dir):
    tag = F.concat(F.lit('</title><meta charset="x"><META property="og:title"\n content="'), F.col("url"))
    html = F.replace(F.col("html"), F.lit("</title>"), F.concat(tag, F.lit('">')))
    pages = table(spark, sf_dir, "pages").select("page_id", "html", html.alias("tagged"))
    return pages.select(
        "page_id",
        text.meta_title(F.col("tagged")).alias("http_meta_title"),
        text.meta_title(F.col("html")).alias("without_tag"),
    )


def _word_answers():
    """Every word of a text as a DNS answer; short words have no address."""
    return F.transform(
        F.split("text", " "),
        lambda word: F.struct(
            F.when(F.length(word) > 4, "A").otherwise("CNAME").alias("answer_type"),
            F.when(F.length(word) > 4, word).alias("ipv4"),
        ),
    )


@query
def dns_ips(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    full = nested.field_of_each(_word_answers(), "ipv4")
    rows = documents.select("doc_id", full.alias("full"))
    rows = rows.withColumn("ips", nested.drop_nulls(F.col("full")))
    return rows.select(
        "doc_id",
        F.size("full").cast("bigint").alias("n_full"),
        F.size("ips").cast("bigint").alias("n_ips"),
        F.md5(F.array_join("ips", ",")).alias("ips"),
    )


@query
def dns_ips_nested(spark, sf_dir):
    """An array of queries, each with its answers; a query without answers vanishes."""
    queries = F.array(
        F.struct(F.when(F.col("lang") != "fr", _word_answers()).alias("answers")),
        F.struct(_word_answers().alias("answers")),
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", queries.alias("queries"))
    full = nested.field_of_each(F.col("queries")["answers"], "ipv4", inner=True)
    rows = documents.select("doc_id", full.alias("full"))
    rows = rows.withColumn("ips", nested.drop_nulls(F.col("full")))
    return rows.select(
        "doc_id",
        F.size("full").cast("bigint").alias("n_full"),
        F.size("ips").cast("bigint").alias("n_ips"),
        F.md5(F.array_join(F.flatten("ips"), ",", "-")).alias("ips"),
    )


# --- landing ----------------------------------------------------------------------


def _files(spark, sf_dir):
    return manifest(object_listing(spark, sf_dir), "store:/bucket", date_index=2)


@query
def manifest_parse(spark, sf_dir):
    files = wanted(_files(spark, sf_dir), min_mib=1.5)
    return files.drop("path")


@query
def date_prefixes(spark, sf_dir):
    return date_folders(object_listing(spark, sf_dir), "store:/bucket/archive/jsonl")


@query
def anti_landed(spark, sf_dir):
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    key = F.concat(F.lit("d/"), F.col("doc_id").cast("string")).alias("dest_key")
    return not_landed(documents.select(key, "lang"), labels.select(key))


@query
def budget_select(spark, sf_dir):
    chosen = within_budget(wanted(_files(spark, sf_dir)))
    return chosen.select("source_date", "country", "key", "size_mb")


@query
def budget_rounds(spark, sf_dir):
    """A small limit, so that groups need several rounds."""
    chosen = within_budget(wanted(_files(spark, sf_dir), min_mib=0.01), 4.0, 0.01)
    return chosen.select("source_date", "country", "key", "size_mb")


@query
def budget_misses(spark, sf_dir):
    """A small file, then fifty of a size that no longer fits by a hair, and so on until the budget is used up."""
    group = [F.year("o_orderdate").cast("string").alias("source_date"), F.col("o_orderpriority").alias("country")]
    orders = table(spark, sf_dir, "orders").select(*group, "o_orderkey")
    n = F.row_number().over(Window.partitionBy("source_date", "country").orderBy("o_orderkey")) - 1
    room = 8 - 0.25 * (F.floor(n / 51) + 1)
    size = F.when(n % 51 == 0, 0.25).otherwise(F.greatest(room, F.lit(0.25)) + 2.0**-10 * (1 + n % 3))
    files = orders.select("source_date", "country", F.lpad(n.cast("string"), 9, "0").alias("key"), size.alias("size_mb"))
    return within_budget(files, 8.0, 0.25)


def _months(year: int, span) -> list[str]:
    first = span.first.month if year == span.first.year else 1
    return months(year, first, span.last.month if year == span.last.year else 12)


@query
def landing(spark, sf_dir):
    """Events as source files, the months that they are of budgeted and copied twice; the second run finds nothing new."""
    scratch = scratch_path(spark, "landing")
    span = table(spark, sf_dir, "events").agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    events = table(spark, sf_dir, "events").select(
        F.to_json(F.struct("event_id", "event_type", "value")).alias("value"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        mapped("event_type", COUNTRY_OF_EVENT).alias("country"),
    )
    cfg = LakeConfig(
        source=write_source_objects(events, scratch),
        raw=f"{scratch}/raw",
        trusted=f"{scratch}/trusted",
        delivery=f"{scratch}/delivery",
        logs=f"{scratch}/logs",
        prefixes=[p for year in range(span.first.year, span.last.year + 1) for p in _months(year, span)],
        min_mib=1e-6,
        limit_mib=1e9,
    )
    first = ingest(spark, cfg)
    again = ingest(spark, cfg)
    lines = spark.read.option("recursiveFileLookup", "true").text(cfg.raw)
    day = F.regexp_extract("_metadata.file_path", r"/(\d{4}-\d\d-\d\d)/[^/]*$", 1)
    copied = first.unionByName(again).groupBy("dest_key").count()
    days = copied.select(F.split("dest_key", "/")[0].alias("source_date"), "count")
    once = days.groupBy("source_date").agg(F.max("count").alias("copies"))
    return lines.select(F.col("value").alias("line"), day.alias("source_date")).join(once, "source_date")


# --- sinks and catalog ------------------------------------------------------------


def _events_by_day(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", "value", F.to_date("ts").alias("bucket_date")
    )


@query
def partition_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "roundtrip")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), "o_orderstatus"
    )
    partition = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    write_partitioned(orders.withColumn("o_orderstatus", partition), path, ["year", "o_orderstatus"])
    return read_table(spark, path)


@query
def dynamic_overwrite(spark, sf_dir):
    path = scratch_path(spark, "dynamic")
    events = _events_by_day(spark, sf_dir)
    write_partitioned(events, path, ["bucket_date"], overwrite="static")
    late = events.where((F.col("bucket_date") >= "2024-01-16") & (F.col("event_type") == "purchase"))
    write_partitioned(late.withColumn("value", -F.col("value")), path, ["bucket_date"])
    return read_table(spark, path)


@query
def static_overwrite(spark, sf_dir):
    path = scratch_path(spark, "static")
    events = _events_by_day(spark, sf_dir)
    write_partitioned(events, path, ["bucket_date"], overwrite="static")
    errors = events.where(F.col("event_type") == "error")
    write_partitioned(errors, path, ["bucket_date"], overwrite="static", rebalance=False)
    return read_table(spark, path)


@query
def append_log(spark, sf_dir):
    path = scratch_path(spark, "log")
    report = quality.report(_checked_events(spark, sf_dir), EVENT_CHECKS).drop("constraint_message")
    for run_id in ("first", "second"):
        append_table(report.withColumn("run_id", F.lit(run_id)), path, ["run_id"])
    return read_table(spark, path)


@query
def catalog_repair(spark, sf_dir):
    path = scratch_path(spark, "table")
    name = path.rsplit("-", 1)[1]
    write_partitioned(_events_by_day(spark, sf_dir), path, ["bucket_date"])
    catalog.create_schema(spark, f"lake_{name}", f"{path}-schema")
    events = f"lake_{name}.events"
    catalog.create_table(
        spark, events, "event_id bigint, event_type string, value double", path, ["bucket_date date"]
    )
    before = spark.table(events).count()
    catalog.repair(spark, events)
    return spark.table(events).withColumn("rows_before_repair", F.lit(before).cast("bigint"))


@query
def json_scan(spark, sf_dir):
    """Events written as JSON lines in folders and read with the fixed schema."""
    path = scratch_path(spark, "json")
    error = F.col("event_type") == "error"
    documents = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.struct(
            error.alias("accessible"),
            F.from_json("props", "k bigint").alias("blocking"),
            F.col("value").alias("body_proportion"),
            F.when(error, F.lit("many")).otherwise(F.col("user_id").cast("string")).alias("title_match"),
            F.when(error, F.struct(F.lit(1).alias("x"))).alias("retries"),
        ).alias("test_keys"),
        F.array(F.col("event_type"), F.lit("y")).alias("options"),
        F.lit("dropped").alias("unknown_field"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )
    line = F.to_json(F.struct("*"))
    broken = F.when(F.col("options")[0] == "view", F.rtrim(line, F.lit("}"))).otherwise(line)
    documents.select(broken.alias("value"), "day").write.partitionBy("day").text(path)
    return read_measurements(spark, path, glob="*.txt").select(
        F.col("id"),
        F.col("test_keys.accessible").alias("accessible"),
        F.col("test_keys.blocking").alias("blocking"),
        F.col("test_keys.body_proportion").alias("body_proportion"),
        F.col("test_keys.title_match").alias("title_match"),
        F.col("test_keys.retries").alias("retries"),
        F.array_join("options", ",").alias("options"),
    )


# --- tables -----------------------------------------------------------------------

TRUSTED_SCALARS = (
    "id", "input", "probe_asn", "probe_cc", "probe_ip", "report_id", "test_name", "test_runtime",
    "blocking", "platform", "row_id", "bucket_date",
)


def _times(utc: bool = False):
    """Start times as text: in the zone of the session, which is also that of the cast, or in UTC."""
    names = ("measurement_start_time", "test_start_time")
    times = {c: F.to_utc_timestamp(c, F.current_timezone()) if utc else F.col(c) for c in names}
    return [time.cast("string").alias(name) for name, time in times.items()]


@query
def trusted_table(spark, sf_dir):
    rows = transform(as_measurements(spark, sf_dir), GEN_2)
    answers = F.transform(F.col("queries")["answers"], lambda a: a["answer_type"])
    return rows.select(
        *TRUSTED_SCALARS,
        *_times(),
        F.array_join(answers, ",").alias("answer_types"),
        F.md5(nested.first_body(F.col("requests"))).alias("body"),
        F.col("tcp_connect")[0]["port"].alias("port"),
    )


@query
def trusted_table_gen1(spark, sf_dir):
    rows = transform(as_measurements(spark, sf_dir), GEN_1)
    return rows.select(
        *TRUSTED_SCALARS,
        *_times(),
        F.size("queries").cast("bigint").alias("n_queries"),
        "is_ip_valid",
        "is_url_valid",
    )


@query
def dedup_broken_copy(spark, sf_dir):
    """Every measurement twice, once with a start time that is none: the good copy stays."""
    rows = as_measurements(spark, sf_dir, copies=False)
    broken = rows.withColumn("test_start_time", F.lit("soon"))
    kept = transform(rows.unionByName(broken), GEN_2)
    return kept.select(*TRUSTED_SCALARS, *_times())


@query
def all_projected(spark, sf_dir):
    """Every plain projected column from a field of its own name, with values that name the column."""
    nested_text = ("control_failure", "blocking", "http_experiment_failure", "dns_experiment_failure")
    plain = (
        "id", "input", "probe_asn", "probe_cc", "probe_ip", "report_id", "software_name", "software_version",
        "test_name", "test_version",
    )
    number = F.col("event_id").cast("string")
    named = {c: F.concat(F.lit(f"{c}-"), number) for c in plain}
    inside = [F.concat(F.lit(f"{c}/"), number).alias(c) for c in nested_text]
    control = F.struct(F.struct(F.col("event_id").alias("status_code")).alias("http_request")).alias("control")
    line = F.to_json(
        F.struct(
            *[v.alias(c) for c, v in named.items()],
            F.col("value").alias("test_runtime"),
            F.struct(*inside, control).alias("test_keys"),
            F.struct(F.col("event_type").alias("platform")).alias("annotations"),
        )
    )
    documents = table(spark, sf_dir, "events").select(
        F.from_json(line, prune(measurement_schema(), trusted_fields())).alias("m")
    )
    return shape(documents.select("m.*")).select(
        *plain,
        F.col("control")["http_request"]["status_code"].alias("status_code"),
        "test_runtime",
        "platform",
        *nested_text,
    )


@query
def delivery_table(spark, sf_dir):
    rows = enrich(transform(as_measurements(spark, sf_dir, copies=False), GEN_2))
    return _flat_delivery(rows)


def _flat_delivery(rows: DataFrame, utc: bool = False) -> DataFrame:
    return rows.select(
        *TRUSTED_SCALARS,
        *_times(utc),
        joined("dns_resolved_ips_full"),
        joined("dns_resolved_ips"),
        "http_title",
        "http_meta_title",
        "domain",
    )


def _documents(rows: DataFrame, folder="bucket_date") -> DataFrame:
    """Measurements as lines of source files, by default in the folder of their date."""
    folder = F.col(folder) if isinstance(folder, str) else folder
    return rows.select(
        F.to_json(F.struct("*")).alias("value"), folder.alias("day"), F.lit("US").alias("country")
    )


def _lake(spark, sf_dir, generation: Generation, rows: DataFrame | None = None) -> LakeConfig:
    scratch = scratch_path(spark, "lake")
    rows = measurements(spark, sf_dir) if rows is None else rows
    return LakeConfig(
        source=write_source_objects(_documents(rows), scratch),
        raw=f"{scratch}/raw",
        trusted=f"{scratch}/trusted",
        delivery=f"{scratch}/delivery",
        logs=f"{scratch}/logs",
        generation=generation,
        schema="lake_" + scratch.rsplit("-", 1)[1],
        schema_location=f"{scratch}/schema",
        min_mib=1e-6,
        limit_mib=1e9,
    )


@query
def lake_run(spark, sf_dir):
    """Everything: land, trust, check, repair, log, register, deliver."""
    cfg = _lake(spark, sf_dir, GEN_2)
    run(spark, cfg)
    return _flat_delivery(read_table(spark, cfg.delivery), utc=True)


@query
def lake_run_gen1(spark, sf_dir):
    cfg = _lake(spark, sf_dir, GEN_1)
    run(spark, cfg)
    rows = read_table(spark, cfg.delivery)
    full = F.array_join(F.flatten("dns_resolved_ips_full"), ",", "-")
    return rows.select(
        *TRUSTED_SCALARS, *_times(utc=True), "is_ip_valid", "is_url_valid", "domain",
        full.alias("dns_resolved_ips_full"),
    )


@query
def serving_table(spark, sf_dir):
    """The registered delivery table, as a reader of the catalog sees it."""
    cfg = _lake(spark, sf_dir, GEN_2)
    run(spark, cfg)
    return spark.table(f"{cfg.schema}.delivery").select(
        "id", "probe_cc", "probe_asn", "test_name", "platform", "domain", "http_title", "bucket_date"
    )


@query
def quality_log(spark, sf_dir):
    """The registered log of a run: one row per constraint and landing folder."""
    cfg = _lake(spark, sf_dir, GEN_2)
    run(spark, cfg, "run")
    return spark.table(f"{cfg.schema}.quality_log").select(
        "check", "check_level", "check_status", "constraint", "constraint_status", "bucket_date", "run_id"
    )


@query
def run_ids(spark, sf_dir):
    """Two runs without an id of their own: each gets one, told by its time, and its rows of the log."""
    cfg = _lake(spark, sf_dir, GEN_2)
    for _ in range(2):
        run(spark, cfg)
    log = spark.table(f"{cfg.schema}.quality_log")
    shaped = F.col("run_id").rlike(r"^20\d{6}T\d{6}\.\d{6}$").alias("is_time")
    return log.groupBy("bucket_date", shaped).agg(
        F.count("*").alias("n_rows"), F.count_distinct("run_id").alias("n_runs")
    )


@query
def rerun_same_id(spark, sf_dir):
    """A run that is repeated under its id after more files came: one report, one table."""
    rows = measurements(spark, sf_dir)
    first = _lake(spark, sf_dir, GEN_2, rows.where(F.col("annotations.platform") == "signup"))
    run(spark, replace(first, schema=None), "run")
    second = replace(first, source=_lake(spark, sf_dir, GEN_2, rows).source, raw=f"{first.raw}-all")
    run(spark, second, "run")
    log = spark.table(f"{second.schema}.quality_log").groupBy("bucket_date").agg(F.count("*").alias("n_log"))
    log = log.select(F.to_date("bucket_date").alias("bucket_date"), "n_log")
    return read_table(spark, second.trusted).join(log, "bucket_date").select("id", "bucket_date", "n_log")


@query
def stale_dates(spark, sf_dir):
    """A second run in which every row of the first date fails its check: nothing of it stays."""
    rows = measurements(spark, sf_dir)
    cfg = _lake(spark, sf_dir, GEN_2, rows)
    run(spark, cfg)
    first = rows.agg(F.min("bucket_date")).first()[0]
    country = F.when(F.col("bucket_date") == first, F.lit("XX")).otherwise(F.col("probe_cc"))
    changed = _lake(spark, sf_dir, GEN_2, rows.withColumn("probe_cc", country))
    run(spark, replace(cfg, source=changed.source, raw=f"{cfg.raw}-changed"))
    tables = {"trusted": read_table(spark, cfg.trusted), "delivery": spark.table(f"{cfg.schema}.delivery")}
    trusted, delivery = (t.select(F.lit(n).alias("place"), "id", "bucket_date") for n, t in tables.items())
    return trusted.unionByName(delivery)


@query
def incremental_stream(spark, sf_dir):
    """Two deliveries of files for the same folder, which overlap, each streamed into the trusted table."""
    scratch = scratch_path(spark, "stream")
    raw, trusted = f"{scratch}/raw", f"{scratch}/trusted"
    rows = measurements(spark, sf_dir)
    deliveries = {"one": rows.where(F.col("annotations.platform") != "purchase"), "two": rows}
    for name, delivery in deliveries.items():
        _deliver(spark, _documents(delivery, F.lit("2024-01-01")), f"{scratch}/{name}", raw)
        run_incremental(spark, raw, trusted, f"{scratch}/checkpoint")
    return read_table(spark, trusted).select(*TRUSTED_SCALARS)


def _deliver(spark, documents: DataFrame, scratch: str, raw: str) -> None:
    """Add files to the raw folder, in their folders by date."""
    source = write_source_objects(documents, scratch)
    files = list_objects(spark, source).select("path", relative_key(F.col("path"), source).alias("dest_key"))
    copy_objects(files, raw).write.format("noop").mode("overwrite").save()


@query
def incremental_by_folder(spark, sf_dir):
    """Files of two folders streamed one by one and all at once: the same rows, those of a batch run."""
    scratch, results = scratch_path(spark, "folders"), []
    rows = measurements(spark, sf_dir)
    folder = F.when(F.col("bucket_date") <= "2024-01-15", "2024-01-01").otherwise("2024-01-16")
    for name, part in {"one": F.col("test_runtime") < 50, "two": F.col("test_runtime") >= 50}.items():
        _deliver(spark, _documents(rows.where(part), folder), f"{scratch}/{name}", f"{scratch}/raw")
    for files in (1, 1000):
        place = f"{scratch}/{files}"
        run_incremental(spark, f"{scratch}/raw", f"{place}/trusted", f"{place}/checkpoint", files_per_batch=files)
        table_rows = read_table(spark, f"{place}/trusted").select(*TRUSTED_SCALARS)
        results.append(table_rows.withColumn("files_per_batch", F.lit(files).cast("bigint")))
    return results[0].unionByName(results[1])


@query
def stream_unique(spark, sf_dir):
    """Three deliveries with copies, a bounded memory of keys: which copies are dropped, which are late, which are new.

    The second brings the purchases of the first again with their times, some of them late by then; the third brings
    them with times twelve days later, some of them late again, the others when their keys are forgotten.
    """
    scratch = scratch_path(spark, "unique")
    raw, found = f"{scratch}/raw", f"{scratch}/table"
    rows = measurements(spark, sf_dir, copies=False)
    day, bought = F.col("bucket_date"), F.col("annotations.platform") == "purchase"
    first = rows.where(day < "2024-01-11")
    again = first.where(bought)
    moved = F.col("test_start_time").cast("timestamp") + F.expr("INTERVAL 12 DAYS")
    later = again.withColumn("test_start_time", F.date_format(moved, "yyyy-MM-dd HH:mm:ss"))
    second = rows.where((day >= "2024-01-11") & (day < "2024-01-21"))
    deliveries = [first.unionByName(again), second.unionByName(again), rows.where(day >= "2024-01-21").unionByName(later)]
    for i, delivery in enumerate(deliveries):
        _deliver(spark, _documents(delivery, F.lit("2024-01-01")), f"{scratch}/{i}", raw)
        run_unique(spark, raw, found, f"{scratch}/checkpoint", "5 days")
    return read_table(spark, found).select("id", "platform", "bucket_date", _times(utc=True)[1])


@query
def empty_folders(spark, sf_dir):
    """Folders with rows beside one whose only file is blank, and a blank file in no folder: the report of a run."""
    cfg = _lake(spark, sf_dir, GEN_2)
    blank = spark.range(1).select(F.lit("  ").alias("value"))
    blank.coalesce(1).write.text(f"{cfg.source}-blank")
    files = list_objects(spark, f"{cfg.source}-blank", glob="*.txt").select("path")
    keys = F.explode(F.array(F.lit("1999-01-01/blank.json"), F.lit("blank.json")))
    copy_objects(files.select("path", keys.alias("dest_key")), cfg.raw).write.format("noop").mode("overwrite").save()
    run(spark, cfg, "run")
    return spark.table(f"{cfg.schema}.quality_log").select("constraint", "constraint_status", "bucket_date", "run_id")
