"""Customer groups and the contract-status report."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources.tables import checkpoint_folder, with_ord
from ..plans import enrich as en
from ..plans import report as rp
from ..schemas import DETAIL_LABELS
from . import shapes as sh
from .book import Book

query = Book()


# ---- customer groups ---------------------------------------------------------

_GROUPS_SQL = sh.AWARDS_SQL + """,
stacked AS (
  SELECT buyer, o_orderpriority AS grp, 0 AS src, o_orderkey AS row FROM orders JOIN buyers ON o_custkey = c_custkey
  UNION ALL
  SELECT buyer, CASE WHEN c_acctbal > 0 THEN 'segment ' || b.c_mktsegment END, 1, b.c_custkey
  FROM buyers b JOIN customer USING (c_custkey)
  UNION ALL
  SELECT buyer, CASE WHEN o_totalprice > 1000 THEN o_orderpriority || ' ' || o_orderstatus END, 2, o_orderkey
  FROM orders JOIN buyers ON o_custkey = c_custkey),
pairs AS (SELECT buyer, grp, min((src, row)) AS seen FROM stacked GROUP BY buyer, grp),
dim AS (SELECT buyer AS name, grp FROM pairs QUALIFY row_number() OVER (PARTITION BY buyer ORDER BY seen DESC) = 1)
"""


def _sources(spark, sf):
    orders, b = sh.table(spark, sf, "orders"), sh.buyers(spark, sf)
    customer = sh.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    placed = orders.join(b, orders.o_custkey == b.c_custkey)
    name = F.col("buyer").alias("CustomerName")
    return [
        placed.select(name, F.col("o_orderpriority").alias("CustomerGroup"), F.col("o_orderkey").alias("ord")),
        b.join(customer, "c_custkey").select(
            name, F.when(F.col("c_acctbal") > 0, F.concat(F.lit("segment "), "c_mktsegment")).alias("CustomerGroup"),
            F.col("c_custkey").alias("ord")),
        placed.select(
            name, F.when(F.col("o_totalprice") > 1000, F.concat_ws(" ", "o_orderpriority", "o_orderstatus"))
            .alias("CustomerGroup"), F.col("o_orderkey").alias("ord")),
    ]


@query(f"WITH {_GROUPS_SQL} SELECT name, grp AS customer_group FROM dim")
def last_wins_groups(spark, sf):
    return en.build_group_dim(_sources(spark, sf)).select(
        F.col("CustomerName").alias("name"), F.col("CustomerGroup").alias("customer_group"))


@query(f"WITH {_GROUPS_SQL} SELECT src::BIGINT AS source_no, count(*)::BIGINT AS row_count, count(grp)::BIGINT AS grouped FROM stacked GROUP BY src")
def stacked_sources(spark, sf):
    s = en.stack_sources(_sources(spark, sf), ["CustomerName", "CustomerGroup"])
    return s.groupBy(F.col("ord.source_no").cast("bigint").alias("source_no")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("CustomerGroup").alias("grouped"))


@query(f"""WITH {_GROUPS_SQL},
  c AS (SELECT o_orderkey, CASE source WHEN 'F' THEN upper(a.buyer) WHEN 'O' THEN a.buyer || ' (HQ)' ELSE a.buyer END AS buyer,
    CASE source WHEN 'F' THEN upper(a.buyer) ELSE a.buyer END AS k FROM awards a)
  SELECT o_orderkey, c.buyer, grp AS customer_group FROM c LEFT JOIN dim ON k = name""")
def customer_group(spark, sf):
    contracts = sh.awards(spark, sf).withColumn(
        "buyer", F.when(F.col("source") == "F", F.upper("buyer"))
        .when(F.col("source") == "O", F.concat("buyer", F.lit(" (HQ)"))).otherwise(F.col("buyer")))
    out = en.add_customer_group(contracts, en.build_group_dim(_sources(spark, sf)))
    return out.select("o_orderkey", "buyer", F.col("CustomerGroup").alias("customer_group"))


# ---- status report -----------------------------------------------------------

_REPORT_SQL = sh.AWARDS_SQL + """,
spend AS (
  SELECT l_orderkey, l_suppkey, sum(CASE WHEN l_linestatus = 'F' AND l_returnflag <> 'R'
    THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS reported FROM lineitem GROUP BY ALL),
report AS (
  SELECT framework_title AS framework, s_name AS name, buyer, award_value, contract_start, contract_end, reported, o_orderkey,
    (year(least(contract_end, DATE '2000-01-01')) - year(contract_start)) * 12
      + month(least(contract_end, DATE '2000-01-01')) - month(contract_start) AS months_run
  FROM spend JOIN awards ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey),
status AS (
  SELECT *, CASE WHEN reported > 0 THEN 'green' WHEN contract_end <= DATE '2000-01-01' THEN 'red'
      WHEN months_run > 6 THEN 'yellow' ELSE 'green' END AS status,
    CASE WHEN reported > 0 THEN 'spend reported' WHEN contract_end <= DATE '2000-01-01' THEN 'ended without spend'
      WHEN months_run > 6 THEN 'running without spend' ELSE 'under threshold' END AS status_reason FROM report)
"""
_STATUS_COLS = """framework, name, buyer AS buyer_name, o_orderkey, contract_end::VARCHAR AS contract_end,
  months_run::BIGINT AS months_run, status, status_reason"""


def _suppliers(spark, sf):
    """One report row per order and supplier; dates as text, as in the exchanged file."""
    line, supplier = sh.table(spark, sf, "lineitem"), sh.table(spark, sf, "supplier")
    counted = (F.col("l_linestatus") == "F") & (F.col("l_returnflag") != "R")
    spend = line.groupBy("l_orderkey", "l_suppkey").agg(
        F.sum(F.when(counted, F.col("l_extendedprice").cast("decimal(18,2)")).otherwise(0)).alias("reported_spend"))
    a = sh.awards(spark, sf)
    return (
        spend.join(a.hint("merge"), spend.l_orderkey == a.o_orderkey).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.col("framework_title").alias("framework"), F.col("s_name").alias("name"),
                F.col("buyer").alias("buyer_name"), F.col("award_value").alias("contract_value"),
                F.col("contract_start").cast("string").alias("contract_start"),
                F.col("contract_end").cast("string").alias("contract_end"),
                F.col("reported_spend").cast("decimal(18,2)").alias("reported_spend"), "o_orderkey")
    )


def _status(spark, sf, dealt=lambda rows: rows):
    return rp.status_report(dealt(_suppliers(spark, sf)), sh.AS_OF, sender="Contract Team")


def _written(spark, sf):
    """The report, written to a folder of its own on the shared store and read back."""
    path = f"{checkpoint_folder(spark)}/report-{uuid.uuid4().hex}"
    status = _status(spark, sf, rp.by_framework)
    rp.write_report(status, path)
    return rp.read_report(spark, path, status.schema)


def _status_columns(df):
    return df.select("framework", "name", "buyer_name", "o_orderkey", sh.text_date("contract_end"),
                     F.col("months_run").cast("bigint").alias("months_run"), "status", "status_reason")


@query(f"WITH {_REPORT_SQL} SELECT {_STATUS_COLS}, '£' || format('{{:,.2f}}', award_value) AS value_text, "
       "'£' || format('{:,.2f}', reported) AS spend_text FROM status")
def contract_status(spark, sf):
    out = _status(spark, sf)
    texts = out.select("framework", "name", "buyer_name", "o_orderkey", "contract_end", "months_run", "status",
                       "status_reason", F.col("contract_value_text").alias("value_text"),
                       F.col("reported_spend_text").alias("spend_text"))
    return texts.withColumns({"contract_end": F.col("contract_end").cast("string"),
                              "months_run": F.col("months_run").cast("bigint")})


@query(f"""WITH {_REPORT_SQL} SELECT framework, status, count(*)::BIGINT AS contracts,
  sum(award_value)::DOUBLE AS contract_value FROM status GROUP BY framework, status""")
def status_counts(spark, sf):
    return _status(spark, sf).groupBy("framework", "status").agg(
        F.count(F.lit(1)).alias("contracts"), F.sum("contract_value").cast("double").alias("contract_value"))


@query(f"WITH {_REPORT_SQL} SELECT {_STATUS_COLS} FROM status WHERE framework = '2-HIGH'")
def for_framework(spark, sf):
    return _status_columns(rp.for_framework(_written(spark, sf), "2-HIGH"))


@query(f"WITH {_REPORT_SQL} SELECT {_STATUS_COLS} FROM status WHERE framework = (SELECT min(framework) FROM status)")
def first_framework(spark, sf):
    return _status_columns(rp.first_framework(_written(spark, sf)))


_RECORD_SQL = f"""WITH {_REPORT_SQL} SELECT framework, name, buyer AS "Buyer name", award_value::DOUBLE AS "Contract value",
  contract_start::VARCHAR AS "Contract start", contract_end::VARCHAR AS "Contract end", reported::DOUBLE AS "Reported spend",
  months_run::BIGINT AS "Months Run So Far" FROM status"""


PAGE = 100


@query(_RECORD_SQL.replace(" FROM status", f""", (row_number() OVER w - 1) // {PAGE} AS page,
  (row_number() OVER w - 1) % {PAGE} AS position FROM status WHERE framework IS NOT NULL
  WINDOW w AS (PARTITION BY framework ORDER BY o_orderkey, name)"""))
def framework_records(spark, sf):
    """Nested records, flattened again with page and position for the comparison."""
    records = rp.records_by_framework(with_ord(_status(spark, sf), "ord", ["o_orderkey", "name"]), "ord", PAGE).select(
        "framework", F.col("page").cast("bigint").alias("page"), F.posexplode("records").alias("position", "r"))
    flat = records.select("framework", "page", F.col("position").cast("bigint").alias("position"), "r.name", *[
        F.col(f"r.details.`{label}`").alias(label) for _, label in DETAIL_LABELS])
    return _plain(flat)


def _plain(df):
    return df.withColumns({
        "Contract value": F.col("Contract value").cast("double"), "Reported spend": F.col("Reported spend").cast("double"),
        "Contract start": F.col("Contract start").cast("string"), "Contract end": F.col("Contract end").cast("string"),
        "Months Run So Far": F.col("Months Run So Far").cast("bigint")})


@query(_RECORD_SQL)
def record_json(spark, sf):
    """Records as JSON texts, read back for the comparison."""
    return _plain(rp.record_fields(rp.record_json(_status(spark, sf))))
