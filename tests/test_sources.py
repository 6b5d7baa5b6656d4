import json
import os

import golden
import pytest
from pyspark.sql import functions as F

from spendtally import schemas
from spendtally.operators.joins import attach_supplier_key, explode_join, with_default
from spendtally.operators.skew import hottest, key_sizes, salted_inner_join, salted_left_join
from spendtally.plans import reconcile as rc
from spendtally.sources import database as db
from spendtally.sources import tables as tb
from spendtally.sources.prompts import file_stem, read_prompts


def test_csv_round_trip_through_the_first_pass(spark, tmp_path):
    c, m, k = golden.contracts(spark), golden.mi(spark), golden.regkeys(spark)
    for name, df in (("contracts", c), ("mi", m), ("keys", k)):
        tb.write_table(df, str(tmp_path / name), "csv")
    c2 = tb.read_table(spark, str(tmp_path / "contracts"), schemas.CONTRACTS + ", contract_ord bigint")
    m2 = tb.read_table(spark, str(tmp_path / "mi"), schemas.MI + ", mi_ord bigint")
    k2 = tb.read_table(spark, str(tmp_path / "keys"), schemas.REG_KEYS)
    assert sorted(map(tuple, c.collect())) == sorted(map(tuple, c2.collect()))
    out = rc.reconcile_exact(rc.key_contracts(c2, k2), rc.key_mi(m2))
    assert (out.count(), out.where("mi_ord is not null").count()) == (10, 8)


def test_csv_nulls_zeros_and_quotes(spark, tmp_path):
    f = tmp_path / "x.csv"
    f.write_text('reg,note,n\n007,"a, ""b""",1\nN/A,na,2\n"",NaN,\n')
    rows = tb.read_table(spark, str(f), "reg string, note string, n int").collect()
    assert [tuple(r) for r in rows] == [("007", 'a, "b"', 1), (None, "na", 2), (None, None, None)]
    f2 = tmp_path / "y.csv"
    f2.write_text("extra,n,reg,d\nx,12.0,007,2024-04-01\ny,NaN,,2024-04-02 00:00:00\n")
    rows = tb.read_table(spark, str(f2), "reg string, n int, d date").collect()
    assert [(r.reg, r.n, str(r.d), r.extra) for r in rows] == [("007", 12, "2024-04-01", "x"), (None, None, "2024-04-02", "y")]
    with pytest.raises(ValueError, match="zz"):
        tb.read_table(spark, str(f2), "zz string")
    inferred = tb.read_table(spark, str(f))
    assert dict(inferred.dtypes)["n"] == "int"
    filled = tb.normalise_na(tb.read_table(spark, str(f), "reg string, note string, n int"), ["reg"], fill="")
    assert [r.reg for r in filled.collect()] == ["007", "", ""]


def test_missing_inputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        tb.read_table(spark, str(tmp_path / "nowhere"), "a int")
    (tmp_path / "b.csv").write_text("a\n1\n")
    got = tb.first_existing(spark, [str(tmp_path / "nowhere"), str(tmp_path / "b.csv")], "a int")
    assert got.first().a == 1
    with pytest.raises(FileNotFoundError, match="expected one of"):
        tb.first_existing(spark, [str(tmp_path / "nowhere")])


def test_columns_and_unions(spark):
    df = spark.createDataFrame([(1,)], "`Input Name ` int")
    assert tb.resolve_col(df, "input name") == "Input Name "
    with pytest.raises(ValueError, match="Match Option"):
        tb.resolve_col(df, "Match Option")
    for i in range(3):
        spark.createDataFrame([(f"n{i}", "g", 0)], "CustomerName string, CustomerGroup string, z int") \
            .createOrReplaceTempView(f"mi_{i}")
    u = tb.union_tables(spark, ["mi_0", "mi_1", "mi_2"], ["CustomerName", "CustomerGroup"])
    assert sorted((r.source_no, r.CustomerName) for r in u.collect()) == [(0, "n0"), (1, "n1"), (2, "n2")]
    o = tb.with_ord(u, "ord", ["source_no", "CustomerName"])
    assert dict(o.dtypes)["ord"].startswith("struct") and dict(tb.with_ord(u, "ord", ["source_no"]).dtypes)["ord"] == "int"


def test_summary_json_and_prompts(spark, tmp_path):
    df = spark.createDataFrame([("r", 0.5, {"Typo": 1.0}, None)], "run string, acc double, by map<string,double>, x string")
    tb.write_summary(df, str(tmp_path / "s"))
    lines = [ln for p in (tmp_path / "s").glob("*.json") for ln in p.read_text().splitlines()]
    assert json.loads(lines[0]) == {"run": "r", "acc": 0.5, "by": {"Typo": 1.0}, "x": None}
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "match_v1.txt").write_bytes("Größe {input_name}\n".encode())
    (tmp_path / "p" / "other.md").write_text("no")
    rows = read_prompts(spark, str(tmp_path / "p"), "match_v*.txt").withColumn("stem", file_stem()).collect()
    import hashlib
    assert [(r.prompt_file, r.stem, r.prompt_text) for r in rows] == [("match_v1.txt", "match_v1", "Größe {input_name}\n")]
    assert rows[0].prompt_sha == hashlib.sha256("Größe {input_name}\n".encode()).hexdigest()


def test_run_names(spark):
    runs = spark.createDataFrame([("a.txt",), ("b.txt",), ("c.txt",)], "prompt_file string")
    dim = spark.createDataFrame([("a.txt", " "), ("b.txt", " nice ")], "prompt_file string, run_name string")
    got = with_default(runs, dim, "prompt_file", "run_name", file_stem())
    assert {r.prompt_file: r.run_name for r in got.collect()} == {"a.txt": "a", "b.txt": "nice", "c.txt": "c"}


def test_live_selection(spark):
    awards = spark.createDataFrame(
        [("RM1557.10 x", '[1,"2"]'), ("RM1557x10", "[1]"), ("RM1557.14", "[]"), ("RM1557.12", None), ("RM1557.13", "[9]")],
        "framework_title string, supplier_ids string")
    dim = spark.createDataFrame([(1, "c1", 5), (2, "c2", 6)], "id bigint, company_number string, latest_employees int")
    got = db.live_contracts(awards, dim).collect()
    assert sorted((r.supplier_id, r.SupplierCompanyRegistrationNumber) for r in got) == [(1, "c1"), (2, "c2")]
    spend = spark.createDataFrame([("S", "1", "B", "g", 2024, 1, 2.0, "G-Cloud 12"), ("S", "1", "B", "g", 2024, 1, 2.0, "G-Cloud 9")],
                                  "SupplierName string, SupplierKey string, CustomerName string, `Group` string, "
                                  "FinancialYear int, FinancialMonth int, EvidencedSpend double, FrameworkName string")
    assert db.live_mi(spend).count() == 1 and "CustomerGroup" in db.live_mi(spend).columns
    assert explode_join(awards, "supplier_ids", dim, "id").count() == 3


def test_jdbc_options(spark):
    with pytest.raises(ValueError):
        db.jdbc_reader(spark, "jdbc:x", "t", partition_col="id")
    assert db.jdbc_reader(spark, "jdbc:x", "select a from t", partition_col="id", bounds=(0, 9), partitions=4) is not None


def test_null_registration_numbers(spark):
    c = spark.createDataFrame([("1", "x"), (None, "y")], "SupplierCompanyRegistrationNumber string, b string")
    k = spark.createDataFrame([("1", 10), ("1", 11), (None, 12), (None, 13)], schemas.REG_KEYS)
    assert attach_supplier_key(c, k).count() == 4
    assert attach_supplier_key(c, k, null_keys="drop").count() == 2
    with pytest.raises(ValueError):
        attach_supplier_key(c, k, null_keys="?")


def test_salted_join_equals_plain_join(spark):
    a = spark.range(900).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
                                .alias("k"), F.col("id").alias("x"))
    b = spark.range(300).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
                                .alias("k"), F.col("id").alias("y"))
    want = a.join(b, "k")
    for rows in (1, 100, 10**6):
        got = salted_inner_join(a, b, "k", "x", "y", min_rows=rows, salts=4)
        assert got.count() == want.count() and got.exceptAll(want.select(got.columns)).count() == 0
    sizes = key_sizes(a, "k")
    # every key over the limit is split, however many there are, in more parts the more rows it has
    assert [tuple(r) for r in hottest(sizes, "k", 100, 4).collect()] == [("hot", 4)]
    parts = {r.k: r.parts for r in hottest(sizes, "k", 10, 4).collect()}
    assert len(parts) == sizes.count() and parts["hot"] == 30
    many = spark.range(6000).select((F.col("id") % 2000).alias("k"))
    assert hottest(key_sizes(many, "k"), "k", 3, 4).count() == 2000


def test_salted_left_join_equals_plain_join(spark):
    names = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 != 0, F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
    a, b = spark.range(600).select(names.alias("k"), F.col("id").alias("x")), spark.range(90).select(names.alias("k"), F.col("id").alias("y"))
    b = b.where("k <> 'k5'")
    want = a.join(b, "k", "left")
    assert want.where("y is null").count() > 0
    for rows in (1, 25, 10**6):
        got = salted_left_join(a, b, "k", "x", "y", min_rows=rows, salts=4)
        assert got.count() == want.count() and got.exceptAll(want.select(got.columns)).count() == 0


def test_checkpoint_keeps_rows(spark):
    df = tb.shared_checkpoint(spark.range(10))
    assert df.count() == 10


def test_row_order_of_several_files(spark, tmp_path):
    """Order is by file name and place, whatever the sizes of the files."""
    at = 0
    for name, n in (("a", 2), ("b", 400), ("c", 40)):
        (tmp_path / f"{name}.csv").write_text("k\n" + "".join(f"{i}\n" for i in range(at, at + n)))
        at += n
    rows = tb.with_file_order(tb.read_table(spark, str(tmp_path), "k int"), "ord").orderBy("ord").collect()
    assert [r.k for r in rows] == list(range(at))


def test_default_lookup_is_unique(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, " "), (1, "b"), (1, "a"), (2, None)], "k int, v string")
    assert sorted(map(tuple, with_default(left, dim, "k", "v", F.lit("none")).collect())) == [(1, "a"), (2, "none")]


def test_row_numbers_follow_files_and_lines(spark, tmp_path):
    # the larger file comes last by name, though Spark reads it first; small splits cut it up
    (tmp_path / "a.csv").write_text("k,v\n" + "".join(f"a{i},x\n" for i in range(50)))
    (tmp_path / "b.csv").write_text("k,v\n" + "".join(f"b{i},{'y' * 40}\n" for i in range(2000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = tb.with_row_numbers(spark.read.option("header", True).csv(str(tmp_path)), "n")
        got = [(r.n, r.k) for r in df.orderBy("n").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(enumerate([f"a{i}" for i in range(50)] + [f"b{i}" for i in range(2000)]))
    assert df.columns == ["k", "v", "n"] and dict(df.dtypes)["n"] == "bigint"


def test_missing_numbers_meet_in_many_parts(spark):
    left = spark.range(500).selectExpr("if(id % 5 = 0, cast(id as string), null) as reg", "id")
    keys = spark.createDataFrame([(None, 1), (None, 2), ("5", 3), ("5", 4), ("7", 9)], "reg string, SupplierKey int")
    joined = attach_supplier_key(left, keys, on="reg")
    got = sorted((r.id, r.SupplierKey) for r in joined.collect())
    assert got == sorted([(i, k) for i in range(500) if i % 5 for k in (1, 2)] + [(5, 3), (5, 4)])
    assert joined.columns == ["reg", "id", "SupplierKey"]
    assert "_part" in joined._jdf.queryExecution().optimizedPlan().toString()


def test_a_job_takes_its_checkpoints_away(spark, tmp_path):
    before = tb.checkpoint_folder(spark)
    with tb.own_checkpoints(spark) as folder:
        assert tb.shared_checkpoint(spark.range(10)).count() == 10 and folder != before
        assert os.listdir(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))
    assert tb.shared_checkpoint(spark.range(3)).count() == 3
