import golden
import pytest
from pyspark.sql import functions as F

from spendtally.operators import aggregates as ag
from spendtally.operators.matchers import RuleMatcher
from spendtally.plans import line_level as ll
from spendtally.plans import reconcile as rc
from spendtally.plans import summary as sm


@pytest.fixture(scope="module")
def keyed(spark):
    return (rc.key_contracts(golden.contracts(spark), golden.regkeys(spark)).cache(),
            rc.key_mi(golden.mi(spark)).cache())


def ords(df, col="mi_ord"):
    return sorted(r[0] for r in df.select(col).where(F.col(col).isNotNull()).collect())


def test_pair_ids(keyed):
    got = {r.contract_ord: r.PairID for r in keyed[0].collect()}
    assert got == {1: "1+buyer a", 2: "2+buyer b", 3: "3+buyer c limited",
                   4: "1+department for work and pensions", 5: "4678+buyer no mi", 6: "1+buyer a",
                   7: "6+buyer c ltd"}
    assert keyed[1].where("mi_ord = 11").first().PairID == "<NA>+buyer z"


def test_first_pass(keyed):
    out = rc.reconcile_exact(*keyed)
    assert out.count() == 10
    assert out.where("mi_ord is not null").count() == 8
    assert ords(rc.unmatched_mi(keyed[1], keyed[0])) == list(range(7, 14))
    assert ords(rc.matched_mi(keyed[1], keyed[0])) == list(range(1, 7))


def test_split(keyed):
    known, unknown = rc.split_unmatched(rc.unmatched_mi(keyed[1], keyed[0]), keyed[0])
    assert ords(known) == [7, 12, 13]
    assert ords(unknown) == [8, 9, 10, 11]
    assert sorted(r.name for r in rc.unknown_names(keyed[1], keyed[0]).collect()) == ["Buyer Y", "Buyer Z", "DWP"]


def test_two_pass(keyed):
    c, m = keyed
    mapping = rc.name_map(m, c, RuleMatcher())
    assert [tuple(r) for r in mapping.collect()] == [("DWP", "Department for Work and Pensions")]
    out = rc.reconcile_two_pass(c, m, RuleMatcher())
    assert out.count() == 17
    second = out.where("match_pass = 2 and mi_ord is not null").collect()
    assert [(r.contract_ord, r.mi_ord, r.AIMatchedName) for r in second] == [
        (4, 8, "Department for Work and Pensions")]
    assert ords(rc.residual_mi(c, m, mapping)) == list(range(7, 14))
    assert ords(rc.residual_mi(c, m, mapping, "strict")) == [7, 9, 10, 11, 12, 13]


def test_no_unknown_name_means_no_second_block(keyed):
    c, m = keyed
    known = m.where("mi_ord in (1, 2, 7)")
    assert rc.reconcile_two_pass(c, known, RuleMatcher()).count() == 7
    assert rc.residual_mi(c, known).count() == 0
    assert ords(rc.residual_mi(c, known, residual="strict")) == [7]
    lines = ll.line_level(c, known, "2026-03-15")

    def unmatched(profile):
        rows = sm.summary_stats(c, lines, profile).orderBy("position").collect()
        return [r["Value"] for r in rows[2:5]]

    assert unmatched(sm.unmatched_profile(c, known)) == [0, 0, 0]
    assert unmatched(sm.unmatched_profile(c, known, "strict")) == [1, 1, 1]
    mapping = rc.name_map(m, c, RuleMatcher())
    assert unmatched(sm.unmatched_profile(c, m, "strict", mapping)) == [6, 5, 4]


@pytest.mark.parametrize("day,at", [("2026-03-15", 2), ("2026-12-04", 4)])
def test_line_level(keyed, day, at):
    c, m = keyed
    for df in (ll.line_level(c, m, day, RuleMatcher()),
               ll.line_level_from_combined(rc.reconcile_two_pass(c, m, RuleMatcher()), day)):
        got = {r.buyer: (int(r.EvidencedSpend), str(r.contract_start), r.months_run, r.expired) for r in df.collect()}
        assert got == {b: (v[0], v[1], v[at], v[at + 1]) for b, v in golden.LINES.items()}
        groups = {r.buyer: r.CustomerGroup for r in df.collect()}
        assert {b for b, g in groups.items() if g is None} == {"Buyer C LTD", "Buyer no MI"}


def test_line_level_without_matching(keyed):
    got = {r.buyer: int(r.EvidencedSpend) for r in ll.line_level(*keyed, "2026-03-15").collect()}
    want = {b: v[0] for b, v in golden.LINES.items()} | {"Department for Work and Pensions": 100000}
    assert got == want


@pytest.mark.parametrize("day,last", [("2026-03-15", 1), ("2026-12-04", 2)])
def test_summary(spark, keyed, day, last):
    c, m = keyed
    lines = ll.line_level(c, m, day, RuleMatcher())
    for profile in (sm.unmatched_profile(c, m), sm.profile_rows(rc.residual_mi(c, m))):
        rows = sm.summary_stats(golden.contracts(spark), lines, profile).orderBy("position").collect()
        assert [r["Value"] for r in rows] == [7, 6, 7, 5, 5, 4, 0, last]
        assert rows[7]["Summary Statistic"] == "Total Contracts No Spend and Running >3 Months"
    labelled = ll.with_report_labels(ll.add_flags(lines))
    assert {"Contracting Authority", "Supplier", "Total Months Run So Far", "Expired"} <= set(labelled.columns)
    assert labelled.where("amber").count() == last


def test_a_missing_name_is_an_unknown_row(spark, keyed):
    """Spend whose only unmatched rows have no name is left over, not lost."""
    contracts, mi = keyed
    known = mi.where("mi_ord = 1").select(*mi.columns)
    nameless = known.withColumns({"CustomerName": F.lit(None).cast("string"), "PairID": F.lit("none+none")})
    both = known.unionByName(nameless)
    assert rc.unknown_names(both, contracts).count() == 0
    assert rc.residual_mi(contracts, both).count() == rc.unmatched_mi(both, contracts).count() == 1


def counted(df):
    """The same rows, and an accumulator of how many were read."""
    read = df.sparkSession.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    return df.mapInPandas(pass_on, df.schema), read


def test_contracts_are_reduced_once(keyed):
    c, m = keyed
    n_c, n_m = c.count(), m.count()
    contracts, read = counted(c)
    rc.name_map(m, contracts, RuleMatcher()).collect()
    assert read.value == n_c
    mapping = rc.name_map(m, c, RuleMatcher())
    (contracts, read), (mi, mi_read) = counted(c), counted(m)
    assert ords(rc.residual_mi(contracts, mi, mapping, "strict")) == [7, 9, 10, 11, 12, 13]
    assert (read.value, mi_read.value) == (n_c, 2 * n_m)
    contracts, read = counted(c)
    sm.unmatched_profile(contracts, m).collect()
    assert read.value == n_c


def test_two_pass_joins_contracts_once(keyed):
    c, m = keyed
    contracts, read = counted(c)
    out = rc.reconcile_two_pass(contracts, m, RuleMatcher()).collect()
    assert read.value == 2 * c.count()  # reduced, joined
    by_pass = {p: sorted((r.contract_ord, r.mi_ord) for r in out if r.match_pass == p and r.mi_ord is not None) for p in (1, 2)}
    first = rc.reconcile_exact(c, m).where("mi_ord is not null")
    assert by_pass == {1: sorted((r.contract_ord, r.mi_ord) for r in first.collect()), 2: [(4, 8)]}
    assert all({r.contract_ord for r in out if r.match_pass == p} == set(range(1, 8)) for p in (1, 2))
    split = rc.reconcile_two_pass(c, m, RuleMatcher(), min_rows=1, salts=3).collect()
    assert sorted(map(str, split)) == sorted(map(str, out))


def test_two_pass_lines_read_contracts_twice(keyed):
    """Once for the latest starts and the matching, once for the rows at them."""
    c, m = keyed
    (contracts, read), (mi, mi_read) = counted(c), counted(m)
    ll.line_level(contracts, mi, "2026-03-15", RuleMatcher()).collect()
    assert (read.value, mi_read.value) == (2 * c.count(), m.count())


def test_a_mark_says_what_the_join_says(spark, keyed):
    contracts, mi = keyed
    nameless = mi.where("mi_ord = 1").withColumns({"CustomerName": F.lit(None).cast("string"), "PairID": F.lit(None).cast("string")})
    names = rc.spend_by_name(mi.unionByName(nameless))
    for c in (contracts, contracts.unionByName(contracts.limit(1).withColumn("PairID", F.lit(None).cast("string")))):
        marked = rc.mark_matched(names, c)
        assert marked.count() == names.count()
        for by_mark, by_join in ((rc.matched_mi(marked, c), rc.matched_mi(names, c)), (rc.unmatched_mi(marked, c), rc.unmatched_mi(names, c)),
                                 (rc.unknown_names(marked, c), rc.unknown_names(names, c))):
            assert sorted(map(str, by_mark.select(*by_join.columns).collect())) == sorted(map(str, by_join.collect()))


def test_known_buyers_in_a_map_are_not_moved(spark, keyed, monkeypatch):
    c, m = keyed
    mapping = spark.createDataFrame(
        [(n, "Department for Work and Pensions") for n in ("DWP", "Buyer Y", "Buyer B")], "CustomerName string, AIMatchedName string")
    names = rc.spend_by_name(m)
    got = []
    for rows in (0, 100_000):  # the map is joined, or sent to every task
        monkeypatch.setattr(rc, "MAP_ROWS", rows)
        for table in (names, rc.mark_matched(names, c)):
            got.append(sorted((r.CustomerName, r.OldPairID, r.PairID) for r in rc.second_pairs(table, c, mapping).collect()))
    assert all(g == got[0] for g in got) and {n for n, _, _ in got[0]} == {"DWP", "Buyer Y"}


def test_few_or_many_groups_give_the_same_latest_rows(keyed, monkeypatch):
    c, m = keyed
    want = sorted(map(str, ll.line_level(c, m, "2026-03-15", RuleMatcher()).collect()))
    monkeypatch.setattr(ag, "GROUP_ROWS", 0)
    assert sorted(map(str, ll.line_level(c, m, "2026-03-15", RuleMatcher()).collect())) == want
    whole = ag.latest_per_group(c, ll.PAIR, "contract_start")
    known = ag.latest_per_group(c, ll.PAIR, "contract_start", rc.contracts_by_pair(c))
    assert sorted(map(str, known.collect())) == sorted(map(str, whole.collect()))
