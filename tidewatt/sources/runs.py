"""Run-result documents of the transformation job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.schemas import RUN_COLUMNS

DOCUMENT = (
    "metadata struct<invocation_id: string, generated_at: string, dbt_version: string>, "
    "results array<struct<unique_id: string, status: string, execution_time: string, failures: string, "
    "message: string, relation_name: string, adapter_response: struct<_message: string>>>"
)


def ingest_run_results(spark: SparkSession, path, message_chars: int | None = None) -> DataFrame:
    """One text row per executed node; a document is one invocation. message_chars cuts messages; by default none."""
    docs = spark.read.schema(DOCUMENT).option("multiLine", True).json(path)
    return flatten_run_results(docs, message_chars)


def parse_run_results(df: DataFrame, text: str | Column, message_chars: int | None = None) -> DataFrame:
    """The same for documents held in a text column."""
    doc = F.from_json(F.col(text) if isinstance(text, str) else text, DOCUMENT)
    return flatten_run_results(df.select(doc.alias("d")).select("d.*"), message_chars)


def flatten_run_results(docs: DataFrame, message_chars: int | None = None) -> DataFrame:
    def message(c: str) -> Column:
        whole = F.coalesce(c, F.lit(""))
        return whole if message_chars is None else F.substring(whole, 1, message_chars)

    rows = docs.select("metadata.*", F.explode("results").alias("r"))
    parts = F.split("r.unique_id", r"\.")
    blank = F.lit("")
    return rows.select(
        "invocation_id",
        "generated_at",
        F.coalesce("dbt_version", blank).alias("dbt_version"),
        F.col("r.unique_id").alias("node_unique_id"),
        F.element_at(parts, 1).alias("node_type"),
        F.element_at(parts, -1).alias("node_name"),
        F.coalesce("r.status", blank).alias("status"),
        F.coalesce("r.execution_time", blank).alias("execution_time_seconds"),
        F.coalesce("r.failures", blank).alias("failures"),
        message("r.message").alias("message"),
        F.coalesce("r.relation_name", blank).alias("relation_name"),
        message("r.adapter_response._message").alias("adapter_message"),
    ).select(*RUN_COLUMNS)
