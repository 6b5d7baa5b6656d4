"""Large inputs go in parts and written steps: same rows, and no shuffle files of a step are left behind."""

import pytest
from pyspark.sql import functions as F

from spendtally.operators.matchers import LevenshteinMatcher
from spendtally.plans import line_level as ll
from spendtally.plans import reconcile as rc
from spendtally.plans import summary as sm
from spendtally.sources import tables as tb
from test_line_level_random import rows, tables

DAY = "2023-05-20"


def numbered(spark, seed):
    c, m = tables(spark, seed)
    return c.withColumn("contract_ord", c.contract_ord * 10 + F.coalesce("contract_supplier_key", F.lit(9))).cache(), m.cache()


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum("shuffle_" in files.apply(i).getName() for i in range(files.size()))


def in_parts(monkeypatch):
    for module in (ll, rc):
        monkeypatch.setattr(module, "PART_ROWS", 0)
    monkeypatch.setattr(ll, "PART_PAIRS", 0)


def test_a_written_table_keeps_its_rows_and_frees_what_it_shuffled(spark):
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.max("id").alias("top"))
    before, setting = shuffle_files(spark), spark.conf.get(tb.FREE_SHUFFLES, None)
    out = tb.shared_table(df)
    assert shuffle_files(spark) <= before and spark.conf.get(tb.FREE_SHUFFLES, None) == setting
    assert rows(out) == rows(df) and tb.shared_table(out) is out
    odd = tb.shared_table(df.withColumn("nothing", F.lit(None)))
    assert odd.count() == 7 and odd.schema["nothing"].dataType.typeName() == "void"


@pytest.mark.parametrize("seed", [1, 2])
def test_line_level_in_parts(spark, monkeypatch, seed):
    c, m = numbered(spark, seed)
    matcher = LevenshteinMatcher(0.8)
    want = [rows(ll.line_level(c, m, DAY)), rows(ll.line_level(c, m, DAY, matcher)), rows(ll.line_level(c, m, DAY, dedupe_ties=True))]
    in_parts(monkeypatch)
    got = ll.line_level(c, m, DAY)
    assert "HashAggregate" not in got._jdf.queryExecution().executedPlan().toString()  # the roll-up is written already
    assert [rows(got), rows(ll.line_level(c, m, DAY, matcher)), rows(ll.line_level(c, m, DAY, dedupe_ties=True))] == want


@pytest.mark.parametrize("seed", [1, 2])
def test_joined_tables_in_parts(spark, monkeypatch, seed):
    c, m = numbered(spark, seed)
    matcher = LevenshteinMatcher(0.8)
    joined, both = rc.reconcile_exact(c, m), rc.reconcile_two_pass(c, m, matcher, min_rows=3, salts=3)
    want = [rows(both), rows(ll.line_level_from_combined(joined, DAY)), rows(ll.line_level_from_combined(both, DAY))]
    in_parts(monkeypatch)
    parts = rc.reconcile_two_pass(c, m, matcher, min_rows=3, salts=3)
    assert "Join" not in parts._jdf.queryExecution().executedPlan().toString()
    assert [rows(parts), rows(ll.line_level_from_combined(joined, DAY)), rows(ll.line_level_from_combined(parts, DAY))] == want


def test_summary_in_parts_leaves_the_given_tables(spark, monkeypatch):
    c, m = numbered(spark, 3)
    want = rows(sm.summary_stats(c, ll.line_level(c, m, DAY), sm.unmatched_profile(c, m)))
    in_parts(monkeypatch)
    kept = tb.shared_table(c)
    index = rc.reduced_contracts(kept)
    lines = ll.line_level(kept, m, DAY)
    assert kept.count() == c.count()
    assert rows(sm.summary_stats(c, lines, sm.unmatched_profile(index, m))) == want
