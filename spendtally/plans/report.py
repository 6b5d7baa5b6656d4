"""Contract-status report per framework."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import months_run_capped, parse_day
from ..functions.status import STATUS_MONTHS_THRESHOLD, contract_status, status_reason
from ..functions.text import draft_letter, pounds
from ..operators.ordinals import range_ordinals
from ..schemas import DETAIL_LABELS
from ..sources.tables import read_table, write_table


def status_report(
    suppliers: DataFrame, as_of, threshold: int = STATUS_MONTHS_THRESHOLD, sender: str = ""
) -> DataFrame:
    """Supplier rows with months run, status, reason, money text and draft letter."""
    day = {c: parse_day(F.col(c).cast("string")) for c in ("contract_start", "contract_end")}
    return (
        suppliers.drop("color").withColumns(day)
        .withColumn("months_run", months_run_capped("contract_start", "contract_end", as_of))
        .withColumn("status", contract_status("reported_spend", "contract_end", "months_run", as_of, threshold))
        .withColumn("status_reason", status_reason("reported_spend", "contract_end", "months_run", as_of, threshold))
        .withColumn("contract_value_text", pounds("contract_value"))
        .withColumn("reported_spend_text", pounds("reported_spend"))
        .withColumn("letter", draft_letter("name", "buyer_name", sender))
    )


def by_framework(suppliers: DataFrame) -> DataFrame:
    """Supplier rows dealt in even parts of bounded size and sorted by framework within them.

    The report of such rows needs no sort when it is written, so a task sorts no
    letters, and no more rows than a part has.
    """
    dealt = suppliers.hint("rebalance", *[f"`{c}`" for c in suppliers.columns])
    return dealt.sortWithinPartitions("framework")


def write_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The report as Parquet, one folder a framework; make it of ``by_framework`` rows, or each task sorts its letters."""
    write_table(report, path, mode=mode, partition_by=["framework"])


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A report that ``write_report`` wrote, with the schema of the report.

    The schema keeps framework names text (a folder named 007 would else come back
    as a number) and lets a report without rows be read.
    """
    return read_table(spark, path, schema, "parquet").select(*schema.names)


def for_framework(df: DataFrame, framework: str) -> DataFrame:
    """One framework's rows; an unknown one gives none.  Of a written report only its folder is read."""
    return df.where(F.col("framework") == framework)


def first_framework(df: DataFrame) -> DataFrame:
    """Rows of the first framework by name; no rows in, no rows out.

    Give it a report that ``read_report`` read: the name is found from the folder
    names, and only that folder is read.
    """
    return df.where(F.col("framework") == df.agg(F.min("framework")).scalar())


def details(df: DataFrame, *keep: str) -> DataFrame:
    """Re-nest the flat columns as a labelled ``details`` record."""
    labelled = F.struct(*[F.col(c).alias(label) for c, label in DETAIL_LABELS])
    return df.select("framework", "name", labelled.alias("details"), *keep)


def record_json(df: DataFrame) -> DataFrame:
    """One JSON text per record."""
    return details(df).select("framework", "name", F.to_json(F.struct("name", "framework", "details")).alias("record"))


def record_fields(texts: DataFrame) -> DataFrame:
    """``(framework, name, ...)`` with the labelled fields as text, back from the JSON texts; each is parsed once."""
    text = T.StringType()
    labelled = T.StructType([T.StructField(label, text) for _, label in DETAIL_LABELS])
    whole = T.StructType([T.StructField("framework", text), T.StructField("name", text), T.StructField("details", labelled)])
    read = texts.select(F.from_json("record", whole).alias("r"))
    return read.select("r.framework", "r.name", *[F.col(f"r.details.`{label}`").alias(label) for _, label in DETAIL_LABELS])


def records_by_framework(df: DataFrame, order: str, page_size: int = 10_000) -> DataFrame:
    """``(framework, page, records)`` with records in ``order``, the source row order.

    Page n holds the records from place ``n * page_size`` on, at every size, so
    page number and place within it are the source order, and no row holds more
    than a page.  Places are numbered by ranges, so a framework of any size is the
    work of many tasks.
    """
    placed = range_ordinals(details(df.where("framework is not null"), order), "framework", order)
    page = F.floor(F.col("place") / page_size).cast("int")
    listed = F.sort_array(F.collect_list(F.struct("place", "name", "details")))
    return (
        placed.withColumn("page", page).groupBy("framework", "page")
        .agg(F.transform(listed, lambda r: F.struct(r["name"], r["details"])).alias("records"))
    )
