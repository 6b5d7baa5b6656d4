"""The fused roll-up equals the roll-up of the joined table, nulls and ties included."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendtally import schemas
from spendtally.operators.matchers import LevenshteinMatcher
from spendtally.plans import line_level as ll
from spendtally.plans import reconcile as rc


def tables(spark, seed):
    rnd = random.Random(seed)

    def pick(*xs):
        return rnd.choice(xs)

    buyers = ["Alpha Council", "Beta Council", "Gamma Trust", None]
    contracts = []
    for i in range(60):
        start = pick(None, dt.date(2020, 1, 1), dt.date(2021, 1, 1), dt.date(2021, 1, 1))
        contracts.append((
            pick(*buyers), pick("S1", "S2", None), pick("01", "02", "03", None), start,
            pick(None, dt.date(2022, 1, 1), dt.date(2030, 1, 1)), pick(None, 12, 24), pick(None, f"T{i}"),
            pick(None, f"D{i}"), pick(None, Decimal(i)), pick(None, "F"), pick(None, "web"), start, pick(None, i), i))
    spends = [
        (pick("S1", "S2", None), pick("1", "2.0", "N/A", None, "3"),
         pick(*buyers, "ALPHA COUNCIL", "Alpha Concil", "Beta Councl", "Gamma Trsut", "Omega"), 2020, 1,
         pick(None, Decimal(0), Decimal(i), Decimal(-i)), pick(None, f"g{i}"), i) for i in range(80)]
    keys = [("01", 1), ("02", 2), ("02", 1), ("03", None), (None, 2)]
    return (
        rc.key_contracts(spark.createDataFrame(contracts, schemas.CONTRACTS + ", contract_ord bigint"),
                         spark.createDataFrame(keys, schemas.REG_KEYS)),
        rc.key_mi(spark.createDataFrame(spends, schemas.MI + ", mi_ord bigint")),
    )


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(str(r[c]) for c in cols) for r in df.collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fused_equals_joined(spark, seed):
    c, m = tables(spark, seed)
    # reg numbers that fan out repeat a contract_ord; number the keyed rows anew
    c = c.withColumn("contract_ord", c.contract_ord * 10 + F.coalesce("contract_supplier_key", F.lit(9)))
    c, m = c.cache(), m.cache()
    day = "2023-05-20"
    matcher = LevenshteinMatcher(0.8)
    joined1 = rc.reconcile_exact(c, m, min_rows=3, salts=3)
    joined2 = rc.reconcile_two_pass(c, m, matcher, min_rows=3, salts=3)
    cols = [x for x in ll.line_level(c, m, day).columns]
    assert rows(ll.line_level(c, m, day)) == rows(ll.line_level_from_combined(joined1, day).select(cols))
    assert rows(ll.line_level(c, m, day, matcher)) == rows(ll.line_level_from_combined(joined2, day).select(cols))


def test_first_pass_keeps_every_contract_and_row_pairing(spark):
    c, m = tables(spark, 7)
    cp, mp = c.toPandas(), m.toPandas()
    want = 0
    for p in cp.PairID:
        hits = mp.PairID.isna().sum() if p is None else (mp.PairID == p).sum()
        want += max(1, int(hits))
    assert rc.reconcile_exact(c, m, min_rows=2, salts=4).count() == want


def test_roll_up_sorts_for_no_aggregate(spark):
    c, m = tables(spark, 4)
    combined = spark.createDataFrame(rc.reconcile_exact(c, m).collect(), rc.reconcile_exact(c, m).schema)
    for df in (ll.line_level(c, m, "2023-05-20"), ll.line_level_from_combined(combined, "2023-05-20")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_orders_of_any_type_give_the_same_lines(spark):
    c, m = tables(spark, 5)
    c = c.withColumn("contract_ord", c.contract_ord * 10 + F.coalesce("contract_supplier_key", F.lit(9)))
    as_text = lambda df, o: df.withColumn(o, F.struct(F.lit("f").alias("file"), F.lpad(F.col(o).cast("string"), 6, "0").alias("row")))
    cols = [x for x in ll.line_level(c, m, "2023-05-20").columns]
    assert rows(ll.line_level(c, m, "2023-05-20")) == rows(
        ll.line_level(as_text(c, "contract_ord"), as_text(m, "mi_ord"), "2023-05-20").select(cols))


def test_only_rows_at_the_latest_start_are_written(spark, monkeypatch):
    c, m = tables(spark, 4)
    c = c.withColumn("contract_ord", c.contract_ord * 10 + F.coalesce("contract_supplier_key", F.lit(9))).cache()
    joined = rc.reconcile_exact(c, m)
    written = []
    keep = ll.shared_checkpoint
    monkeypatch.setattr(ll, "shared_checkpoint", lambda df: written.append(keep(df)) or written[-1])
    ll.line_level_from_combined(joined, "2023-05-20").collect()
    ll.line_level(c, m, "2023-05-20").collect()
    # the spend rows are reduced, not written
    assert len(written) == 2
    for df in written:
        assert df.groupBy(*ll.PAIR).agg(F.count_distinct("contract_start").alias("n")).where("n > 1").count() == 0


def test_joined_table_reads_each_side_once(spark):
    c, m = tables(spark, 5)
    plan = rc.reconcile_exact(c, m)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "Union false, false\n:- Project" not in plan
