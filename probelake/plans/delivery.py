"""Trusted table to delivery table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from probelake import fixed
from probelake.functions.nested import drop_nulls, field_of_each, first_body
from probelake.functions.text import meta_title, network_location, page_title
from probelake.operators.columns import derive, drop_columns
from probelake.plans.config import GEN_2, Generation, LakeConfig
from probelake.plans.trusted import trusted_schema
from probelake.sources.readers import table_or_none
from probelake.sources.sinks import publish


def enrich(trusted: DataFrame, generation: Generation = GEN_2) -> DataFrame:
    """Add resolved addresses, page titles and the domain; row by row, without a shuffle."""
    body = first_body(F.col("requests"))
    answers = F.col("queries")["answers"]
    resolved = field_of_each(answers, "ipv4", inner=not generation.first_query_only)
    columns = {} if generation.drop_wide else {"answers": answers}
    rows = derive(trusted, {**columns, "dns_resolved_ips_full": resolved})
    rows = derive(
        rows,
        {
            "dns_resolved_ips": drop_nulls(F.col("dns_resolved_ips_full")),
            "http_title": page_title(body),
            "http_meta_title": meta_title(body),
            "domain": network_location(F.col("input")),
        },
    )
    return drop_columns(rows, fixed.WIDE_COLUMNS) if generation.drop_wide else rows


def build_delivery(spark: SparkSession, cfg: LakeConfig) -> bool:
    """Rebuild the delivery table; False, and nothing done, if there is no trusted table yet.

    A trusted table without rows gives a delivery table without rows.

    Readers see the table as it was until all of it is there. The trusted table is stored by date, so scan tasks hold few dates each and write without a shuffle.
    """
    trusted = table_or_none(spark, cfg.trusted, trusted_schema(spark, cfg.generation))
    if trusted is None:
        return False
    rows = enrich(trusted, cfg.generation)
    publish(rows, cfg.delivery, "delivery", ["bucket_date"], rebalance=False)
    return True
