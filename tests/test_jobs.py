import golden
from pyspark.sql import functions as F

from spendtally import jobs, schemas
from spendtally.sources import tables as tb


def put(df, path):
    tb.write_table(df.coalesce(1), str(path), "csv")


def test_combine_and_summarise(spark, tmp_path):
    put(golden.contracts(spark).drop("contract_ord"), tmp_path / "contracts.csv")
    put(golden.mi(spark).drop("mi_ord"), tmp_path / "mi.csv")
    put(golden.regkeys(spark), tmp_path / "reg_number_supplier_key.csv")
    d = str(tmp_path)
    jobs.main(["combine", "--indir", d, "--outdir", d, "--matcher", "rules"])
    jobs.main(["summarise", "--indir", d, "--outdir", d, "--as-of", "2026-03-15"])
    assert spark.read.parquet(f"{d}/combined").count() == 17
    assert spark.read.parquet(f"{d}/unmatched").count() == 7
    stats = spark.read.csv(f"{d}/summary_stats", header=True)
    assert [int(r["Value"]) for r in stats.collect()] == [7, 6, 7, 5, 5, 4, 0, 1]
    lines = spark.read.csv(f"{d}/line_level", header=True)
    got = {r["Contracting Authority"]: (int(float(r["EvidencedSpend"])), int(r["Total Months Run So Far"])) for r in lines.collect()}
    assert got == {b: (v[0], v[2]) for b, v in golden.LINES.items()}

    for job, tables in (("combine", ["combined", "unmatched"]), ("summarise", ["line_level", "summary_stats"])):
        counts = {r.table_name: r.row_count for r in spark.read.json(f"{d}/counts/{job}").collect()}
        assert counts == {t: (spark.read.parquet(f"{d}/{t}") if job == "combine" else spark.read.csv(f"{d}/{t}", header=True)).count() for t in tables}

    groups = spark.createDataFrame([("Buyer A", "G1"), ("Buyer A", "G2")], schemas.CUSTOMER_GROUPS)
    put(groups, tmp_path / "g.csv")
    jobs.main(["enrich", "--sources", f"{d}/g.csv", "--combined", f"{d}/combined", "--outdir", d])
    enriched = spark.read.parquet(f"{d}/combined_with_customer_group")
    assert enriched.count() == 17
    assert {r.CustomerGroup for r in enriched.where("buyer = 'Buyer A'").collect()} == {"G2"}


def test_evaluate_skips_done_runs(spark, tmp_path):
    data = [(1, "Home Ofice", "Home Office", "Typo", "Buyer", "x"), (2, "Nobody", "N/A", "Negative control - no match", "Buyer", "x"),
            (3, "DWP", "Department for Work and Pensions", "Acronym", "Buyer", "x")]
    put(spark.createDataFrame(data, schemas.BENCHMARK), tmp_path / "b.csv")
    (tmp_path / "prompts").mkdir()
    (tmp_path / "prompts" / "v1.txt").write_text("one")
    (tmp_path / "prompts" / "v2.txt").write_text("two")
    args = (spark, str(tmp_path / "b.csv"), str(tmp_path / "prompts"), str(tmp_path / "out"))
    assert jobs.evaluate(*args, scorer="cascade") == ["v1", "v2"]
    assert jobs.evaluate(*args, scorer="cascade") == []
    (tmp_path / "prompts" / "v2.txt").write_text("two, changed")
    names = spark.createDataFrame([("v2.txt", "careful")], "prompt_file string, run_name string")
    assert jobs.evaluate(*args, scorer="cascade", descriptions=names) == ["careful"]
    preds = spark.read.parquet(str(tmp_path / "out" / "predictions"))
    assert preds.count() == 9 and preds.agg(F.avg("correct")).first()[0] == 1.0
    summary = spark.read.json(str(tmp_path / "out" / "summary"))
    assert sorted(r.run_name for r in summary.collect()) == ["careful", "v1", "v2"]
    jobs.main(["evaluate", "--benchmark", args[1], "--prompts", args[2], "--outdir", args[3], "--scorer", "cascade",
               "--distractors", "1", "--seed", "7", "--threshold", "0.9"])
    summary = spark.read.json(str(tmp_path / "out" / "summary"))
    assert summary.where("num_distractors = 1 and seed = 7 and similarity_threshold = 0.9").count() == 2
    assert jobs.evaluate(*args, scorer="cascade", num_distractors=1, seed=7, threshold=0.9) == []


def test_answers_of_a_service_are_scored_by_prompt(spark, tmp_path):
    data = [(i, f"{n} Ltd", n, "Legal entity suffix", "Buyer", "x") for i, n in enumerate(["Home Office", "Cabinet Office", "Rutland Council"])]
    put(spark.createDataFrame(data, schemas.BENCHMARK), tmp_path / "b.csv")
    (tmp_path / "prompts").mkdir()
    for v in ("good", "poor", "later"):
        (tmp_path / "prompts" / f"{v}.txt").write_text(f"{v}: {{input_name}} among {{candidates}}")
    (tmp_path / "names.csv").write_text("prompt_file,run_name\ngood.txt,With care\n")
    paths = ["--benchmark", str(tmp_path / "no such file.csv"), str(tmp_path / "b.csv"), "--prompts", str(tmp_path / "prompts"), "--outdir", str(tmp_path / "out")]
    jobs.main(["requests", *paths])
    asked = spark.read.parquet(str(tmp_path / "out" / "requests"))
    assert asked.count() == 9 and asked.where("prompt like 'good: Home Office Ltd among %Home Office%'").count() == 1
    right = {i: n for i, _, n, *_ in data}
    answers = [("good.txt", i, f'{{"match": "{n}"}}') for i, n in right.items()] + [("poor.txt", 0, '{"match": "Home Office"}'), ("poor.txt", 1, "no idea")]
    spark.createDataFrame(answers, "prompt_file string, row_id int, response string").write.parquet(str(tmp_path / "answers"))
    for _ in range(2):  # the second time nothing is left to run
        jobs.main(["evaluate", *paths, "--responses", str(tmp_path / "answers"), "--descriptions", str(tmp_path / "names.csv")])
    summary = {r.run_name: r for r in spark.read.json(str(tmp_path / "out" / "summary")).collect()}
    assert {n: r.accuracy_overall for n, r in summary.items()} == {"With care": 1.0, "poor": 1 / 3}
    assert summary["poor"].prompt_file == "poor.txt" and summary["poor"]["rows"] == 3
    assert spark.read.parquet(str(tmp_path / "out" / "predictions")).count() == 6


def test_counts_are_taken_while_writing(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4).selectExpr("id", "id % 3 as k")
    assert tb.write_table(df, str(tmp_path / "a"), partition_by=["k"]) == 1000
    assert tb.write_table(df.repartition(5), str(tmp_path / "b"), "csv", sort_by=["id"]) == 1000
    assert tb.write_table(df.where("id < 0"), str(tmp_path / "c")) == 0
    assert tb.write_table(df.limit(0), str(tmp_path / "d")) == 0


def test_report(spark, tmp_path):
    put(golden.report(spark).drop("ord"), tmp_path / "s.csv")
    jobs.main(["report", "--suppliers", str(tmp_path / "s.csv"), "--outdir", str(tmp_path), "--as-of", "2025-12-01"])
    status = spark.read.parquet(str(tmp_path / "status")).where("framework = 'Framework 2'")
    assert {r.name: r.status for r in status.collect()} == {"Supplier 8": "red", "Supplier 9": "yellow", "Supplier 10": "green"}
    records = spark.read.json(str(tmp_path / "records"))
    assert {r.framework: len(r.records) for r in records.collect()} == {"Framework 1": 7, "Framework 2": 3}


def test_extract(spark, tmp_path):
    awards = golden.contracts(spark).select("awarded", "buyer", "suppliers", F.lit("RM1557.12").alias("framework_title"),
                                            F.lit("[1]").alias("supplier_ids"))
    suppliers = spark.createDataFrame([(1, "0012", 5)], "id bigint, company_number string, latest_employees int")
    spend = golden.mi(spark).withColumnRenamed("CustomerGroup", "Group").withColumn("FrameworkName", F.lit("G-Cloud 13"))
    keys = golden.regkeys(spark).withColumnRenamed("SupplierCompanyRegistrationNumber", "CompanyRegistrationNumber")
    jobs.extract(awards, suppliers, spend, keys, str(tmp_path))
    tables = {"awards": awards, "suppliers": suppliers, "spend": spend, "keys": keys}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / "db" / name))
    jobs.main(["extract", *[x for n in tables for x in (f"--{n}", str(tmp_path / "db" / n))], "--outdir", str(tmp_path / "again")])
    assert spark.read.csv(str(tmp_path / "again" / "mi.csv"), header=True).count() == 13
    assert {r.table_name: r.row_count for r in spark.read.json(str(tmp_path / "again" / "counts" / "extract")).collect()} == {
        "contracts": 7, "mi": 13, "reg_number_supplier_key": 7}
    got = tb.read_table(spark, str(tmp_path / "contracts.csv"), "supplier_id bigint, SupplierCompanyRegistrationNumber string")
    assert got.count() == 7 and got.first().SupplierCompanyRegistrationNumber == "0012" and "buyer" in got.columns
