import json

import golden
import pytest
from pyspark.sql import functions as F

from spendtally.operators.ordinals import range_ordinals
from spendtally.plans import enrich as en
from spendtally.plans import report as rp


@pytest.fixture(scope="module")
def report(spark):
    return rp.status_report(golden.report(spark).withColumn("color", F.lit("x")), "2025-12-01", sender="Team").cache()


def test_status(report):
    got = {r.name: (r.months_run, r.status) for r in report.collect()}
    assert got == {n: (m, s) for _, n, _, _, _, m, s in golden.REPORT}
    why = {r.name: r.status_reason for r in report.collect()}
    assert why["Supplier 4"] == "under threshold" and why["Supplier 6"] == "spend reported"
    assert "color" not in report.columns
    assert report.first().letter.startswith("Dear Supplier ")


def test_threshold_is_a_parameter(spark):
    df = rp.status_report(golden.report(spark), "2025-12-01", threshold=3)
    assert {r.name: r.status for r in df.collect()}["Supplier 4"] == "yellow"


def test_frameworks(report):
    assert rp.for_framework(report, "Framework 2").count() == 3
    assert rp.for_framework(report, "nope").count() == 0
    assert rp.first_framework(report).count() == 7
    assert rp.first_framework(report.where("false")).count() == 0


def test_records(report):
    one_page = {r.framework: r for r in rp.records_by_framework(report, "ord").collect()}
    assert one_page["Framework 1"].page == 0 and len(one_page["Framework 1"].records) == 7
    assert [x.name for x in one_page["Framework 2"].records] == ["Supplier 8", "Supplier 9", "Supplier 10"]
    assert one_page["Framework 2"].records[2].details["Months Run So Far"] == 12
    pages = rp.records_by_framework(report, "ord", page_size=2).collect()
    in_order = [x.name for p in sorted(pages, key=lambda p: (p.framework, p.page)) for x in p.records]
    assert in_order == [n for f, n, *_ in sorted(golden.REPORT, key=lambda r: r[0])]
    assert all(len(p.records) <= 2 for p in pages)
    rec = json.loads(rp.record_json(report).where("name = 'Supplier 3'").first().record)
    assert rec["details"]["Contract start"] == "2024-07-01" and rec["framework"] == "Framework 1"


def test_pages_of_a_large_framework_come_in_order_from_many_tasks(spark):
    df = spark.range(0, 3000, 1, 7).selectExpr(
        "case when id % 3 > 0 then 'big' when id % 6 = 0 then 'small' end as framework", "id as ord", "concat('n', id) as name")
    placed = range_ordinals(df, "framework", "ord", parts=5)
    rows = placed.collect()
    for f in ("big", "small", None):
        mine = sorted((r.place, r.ord) for r in rows if r.framework == f)
        assert [p for p, _ in mine] == list(range(len(mine))) and [o for _, o in mine] == sorted(o for _, o in mine)
    assert len(rows) == 3000 and placed.columns == ["framework", "ord", "name", "place"]
    ranges = range_ordinals(df.where("framework = 'big'"), "framework", "ord", parts=5)
    plan = ranges._jdf.queryExecution().executedPlan().toString()
    assert "windowspecdefinition(framework" in plan and "row_number() windowspecdefinition(framework#" in plan
    numbered = [x for x in plan.splitlines() if "row_number()" in x]
    assert numbered and all("_range#" in x.split("windowspecdefinition(")[1] for x in numbered)
    assert range_ordinals(df.where("false"), "framework", "ord").collect() == []


def test_a_written_report_is_pruned_to_one_folder(spark, report, tmp_path):
    path = str(tmp_path / "report")
    rp.write_report(report.withColumn("framework", F.expr("replace(framework, 'Framework ', '00')")), path)
    read = rp.read_report(spark, path, report.schema)
    assert read.columns == report.columns
    assert rp.for_framework(read, "002").count() == 3 and rp.for_framework(read, "2").count() == 0
    assert {r.framework for r in rp.first_framework(read).collect()} == {"001"}
    for df in (rp.for_framework(read, "002"), rp.first_framework(read)):
        scan = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in x]
        assert "PartitionFilters: [isnotnull(framework" in scan[0] and "DataFilters: []" in scan[0]
    rp.write_report(report.where("false"), str(tmp_path / "none"))
    assert rp.first_framework(rp.read_report(spark, str(tmp_path / "none"), report.schema)).count() == 0


def test_last_wins(spark):
    def src(rows):
        return spark.createDataFrame(
            [(n, g, i) for i, (n, g) in enumerate(rows)], "CustomerName string, CustomerGroup string, ord int")

    dim = en.build_group_dim([src([("A", "g1")]), src([("A", "g2")]),
                              src([("A", "g1"), ("B and C", "g3"), ("D", None)])])
    assert {r.CustomerName: r.CustomerGroup for r in dim.collect()} == {"A": "g2", "B and C": "g3", "D": None}
    buyers = spark.createDataFrame([("A (HQ)", "old"), ("B & C", "old"), ("a", "old"), (None, "old")],
                                   "buyer string, CustomerGroup string")
    got = [r.CustomerGroup for r in en.add_customer_group(buyers, dim).orderBy("buyer").collect()]
    assert got == [None, "g2", "g3", None]
    kept = en.add_customer_group(buyers, dim, overwrite=False)
    assert {r.CustomerGroup for r in kept.collect()} == {"old"}
    assert en.add_customer_group(buyers.drop("CustomerGroup"), dim, overwrite=False).where(
        "CustomerGroup is not null").count() == 2


def test_dealt_rows_are_sorted_before_the_letters(spark):
    rows = golden.report(spark).withColumn("color", F.lit("x")).repartition(1)
    dealt = rp.status_report(rp.by_framework(rows.unionByName(rows)), "2025-12-01", sender="Team")
    placed = dealt.select(F.spark_partition_id(), "framework").collect()
    for part in {p for p, _ in placed}:
        names = [f for p, f in placed if p == part]
        assert names == sorted(names, key=lambda f: (f is not None, f or ""))
    plain = rp.status_report(rows.unionByName(rows), "2025-12-01", sender="Team")
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))


def test_record_fields_read_the_record_back(report):
    from spendtally.schemas import DETAIL_LABELS

    texts = rp.record_json(report)
    got = rp.record_fields(texts)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and "get_json_object" not in plan
    by_path = texts.select("framework", "name", *[
        F.get_json_object("record", f"$.details['{label}']").alias(label) for _, label in DETAIL_LABELS])
    assert sorted(map(str, got.collect())) == sorted(map(str, by_path.collect()))
