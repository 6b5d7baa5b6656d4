"""JDBC scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from ..operators.joins import explode_join, filter_prefixes
from ..schemas import CONTRACT_FRAMEWORK_PREFIXES, MI_FRAMEWORK_PREFIXES


def jdbc_reader(
    spark: SparkSession, url: str, table_or_query: str, partition_col: str | None = None,
    bounds: tuple | None = None, partitions: int | None = None, fetch_size: int = 10_000, **options,
) -> DataFrameReader:
    """Options for a database scan; with a partition column it is read in parallel.

    A table name keeps Spark's filter and column pushdown; a SELECT is wrapped
    as a derived table so that it can be partitioned too.
    """
    text = table_or_query.strip()
    source = f"({text}) q" if text.lower().startswith("select") else text
    r = spark.read.format("jdbc").options(url=url, dbtable=source, fetchsize=fetch_size, **options)
    if partition_col is not None:
        if bounds is None or not partitions:
            raise ValueError("a partitioned scan needs bounds and partitions")
        r = r.options(partitionColumn=partition_col, lowerBound=bounds[0], upperBound=bounds[1],
                      numPartitions=partitions)
    return r


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, **kw) -> DataFrame:
    return jdbc_reader(spark, url, table_or_query, **kw).load()


def live_contracts(awards: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Contract awards of the wanted frameworks, one row per known supplier id.

    ``awards`` holds a JSON array ``supplier_ids``; ``suppliers`` holds ``id``,
    ``company_number`` and ``latest_employees``.
    """
    wanted = filter_prefixes(awards, "framework_title", CONTRACT_FRAMEWORK_PREFIXES)
    dim = suppliers.select("id", "company_number", "latest_employees")
    return explode_join(wanted, "supplier_ids", dim, "id").withColumnsRenamed(
        {"id": "supplier_id", "company_number": "SupplierCompanyRegistrationNumber"})


def live_mi(spend: DataFrame) -> DataFrame:
    """Spend rows of the wanted frameworks."""
    return filter_prefixes(spend, "FrameworkName", MI_FRAMEWORK_PREFIXES).select(
        "SupplierName", "SupplierKey", "CustomerName", "Group", "FinancialYear", "FinancialMonth",
        "EvidencedSpend").withColumnRenamed("Group", "CustomerGroup")


def live_reg_keys(suppliers: DataFrame) -> DataFrame:
    return suppliers.select("SupplierKey", "CompanyRegistrationNumber").withColumnRenamed(
        "CompanyRegistrationNumber", "SupplierCompanyRegistrationNumber")
