import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendtally.functions import dates, json_text, keys, status, text
from spendtally.operators import aggregates as ag


def one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(fn("x")).collect()]


def test_keys(spark):
    assert one(spark, ["1", "1.0", None, "NaN", "", " 7 ", "3e2", "9007199254740993"], keys.nullable_key) == [
        1, 1, None, None, None, 7, 300, 9007199254740993]
    assert one(spark, [1.0, None], keys.nullable_key, "double") == [1, None]
    with pytest.raises(Exception, match="not a whole-number key"):
        one(spark, ["1.5"], keys.nullable_key)
    df = spark.createDataFrame([(1, "Buyer A"), (None, "Buyer Z"), (2, None)], "k bigint, n string")
    assert [r[0] for r in df.select(keys.pair_id("k", "n")).collect()] == ["1+buyer a", "<NA>+buyer z", None]


def test_null_tokens(spark):
    assert one(spark, ["N/A", "nan", "<NA>", "", "na", "none", "-", None], text.na_to_null) == [
        None, None, None, None, "na", "none", "-", None]


def test_trim_and_quotes(spark):
    assert one(spark, [" a b\t\n", "  x "], text.trim_all) == ["a b", "x"]
    assert one(spark, ['"A"', "'A '", '"', '""', '"A', " ' B ' "], text.strip_quotes) == ["A", "A", "", "", '"A', "B"]
    assert one(spark, ['"A"', "'A'", "n/a", '"', "NONE", "", None, '"null"', "A"], text.clean_prediction) == [
        "A", "A", None, None, None, None, None, None, "A"]


def test_buyer_group_key(spark):
    assert one(spark, ["A (HQ)", "B & C", "a", None, "(x) y"], text.buyer_group_key) == ["A", "B and C", "a", None, ""]


def test_negative_control(spark):
    df = spark.createDataFrame(
        [("Negative control - no match", "X"), ("Typo", "N/A"), ("Typo", " none "), (None, None), ("Typo", "X")],
        "e string, g string")
    assert [r[0] for r in df.select(text.is_negative_control("e", "g")).collect()] == [True, True, True, True, False]


def test_slug_money_letter(spark):
    assert one(spark, ["Negative control - no match"], text.metric_slug) == ["negative_control___no_match"]
    assert one(spark, [1234.5, -1234.5, 0.0, -0.001, None], text.pounds, "double") == [
        "£1,234.50", "-£1,234.50", "£0.00", "£0.00", None]
    assert one(spark, [Decimal("10000000.005")], text.pounds, "decimal(18,3)") == ["£10,000,000.01"]
    df = spark.createDataFrame([("Supplier 1", "Buyer A")], "s string, b string")
    assert df.select(text.draft_letter("s", "b", "The Team")).first()[0] == (
        "Dear Supplier 1,\n\nWe are writing to you regarding your agreement with Buyer A. "
        "Please can you check your records for any unreported spend.\n\nBest regards,\nThe Team")


def test_prompt_and_offer(spark):
    df = spark.createDataFrame([("A", ["A", "B", "B", "C"])], "n string, c array<string>")
    r = df.select(text.offer_without_input("c", "n").alias("o"),
                  text.render_prompt(F.lit("{input_name}: {candidates}"), "n", "c").alias("p"),
                  text.valid_answer(F.lit("B"), "c").alias("v"), text.valid_answer(F.lit("Z"), "c").alias("w")).first()
    assert r.o == ["B", "B", "C"] and r.p == "A: A | B | B | C" and r.v == "B" and r.w is None


def test_name_keys(spark):
    assert one(spark, ["St. Mary's  Hospital", "A & B_c", "U.K. Space"], text.name_key) == [
        "st marys hospital", "a and b c", "uk space"]
    assert one(spark, ["Accenture (UK) Limited", "X Ltd PLC", "Ltd", "K Limited Liability Partnership"],
               text.suffix_key) == ["accenture", "x", "ltd", "k"]
    assert sorted(one(spark, ["HM Revenue and Customs"], text.acronym_keys)[0]) == sorted(
        {"HRC", "HRAC", "HMRC", "HMRAC"})
    assert one(spark, ["Deloitte"], text.acronym_keys) == [[]]
    assert one(spark, ["MoD", "D.W.P.", "Home Office", "X"], text.acronym_input) == ["MOD", "DWP", None, None]


def test_responses(spark):
    got = one(spark, ['{"match":"A"}', '{"match":null}', '"A"', "A", '{"x":1}', "N/A", "null", "none", "", None,
                      '{"match":" B "}', "[1]", '{"match":5}'], json_text.response_match)
    assert got == ["A", None, "A", "A", '{"x":1}', None, None, None, None, None, "B", "[1]", "5"]


def test_dates(spark):
    assert one(spark, ["2024-4-1", "2024-04-01"], dates.parse_day) == [dt.date(2024, 4, 1)] * 2
    assert one(spark, ["oops"], lambda c: dates.parse_day(c, strict=False)) == [None]
    with pytest.raises(Exception):
        one(spark, ["oops"], dates.parse_day)
    day = dt.date(2025, 12, 1)
    assert one(spark, [dt.date(2025, 8, 31), dt.date(2026, 2, 1), None], lambda c: dates.months_run(c, day), "date") == [
        4, -2, None]
    ends = [dt.date(2025, 11, 30), day, dt.date(2025, 12, 2), None]
    assert one(spark, ends, lambda c: dates.expired(c, day), "date") == [True, False, False, False]
    assert one(spark, ends, lambda c: dates.expired(c, "2025-12-01", True), "date") == [True, True, False, False]


def test_flags(spark):
    df = spark.createDataFrame([(True, 9, 0.0), (False, 3, 0.0), (False, 4, 0.0), (False, 9, -1.0), (True, 9, 1.0),
                                (False, None, 0.0), (True, 1, None)], "e boolean, m int, s double")
    got = df.select(status.red_flag("e", "s"), status.amber_flag("e", "m", "s"),
                    status.has_spend("s"), status.no_spend("s")).collect()
    assert [tuple(r) for r in got] == [
        (True, False, False, True), (False, False, False, True), (False, True, False, True),
        (False, False, False, False), (False, False, True, False), (False, False, False, True),
        (False, False, False, False)]


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 2, "y", None), ("a", 1, None, None), ("a", 3, "z", None), ("b", 1, None, 5)],
                               "k string, o int, v string, n int")
    got = {r.k: (r.f, r.s, r.u) for r in df.groupBy("k").agg(
        ag.first_non_null("v", "o").alias("f"), ag.sum_or_zero("n").alias("s"), ag.count_unique("v").alias("u")).collect()}
    assert got == {"a": ("y", 0, 3), "b": (None, 5, 1)}
    ties = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), (None, 9, 4), ("b", None, 5)],
                                 "k string, d int, i int")
    assert sorted(r.i for r in ag.latest_per_group(ties, ["k"], "d").collect()) == [2, 3]
    assert {r.i: r.top for r in ag.with_group_max(ties, ["k"], "d", "top").collect()} == {
        1: 2, 2: 2, 3: 2, 4: None, 5: None}


def test_fingerprint_ignores_order_only(spark):
    rows = [(1, "a"), (2, None), (2, "")]

    def fp(rs):
        return tuple(ag.fingerprint(spark.createDataFrame(rs, "i int, t string"), ["i", "t"]).first())

    assert fp(rows) == fp(rows[::-1])
    assert len({fp(rows), fp(rows[:2]), fp([(1, "a"), (2, ""), (2, "")]), fp([(1, None), (2, "a"), (2, "")])}) == 4
