"""Ranked search, line dedup and conversation repair against brute force, and on awkward rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import pytest

from spendtally.llm import conversations, lines, ranking

DOCS = "doc_id long, text string, n long, score double, rank int, n_lines string, _row int, term string, h long"
ITEMS = "item_id long, text string, n long, doc_id long, terms string"
TURNS = "conv_id long, turn long, role string, text string, first boolean, fault string, place int"


def written(spark, tmp_path_factory, name, rows, schema):
    path = str(tmp_path_factory.mktemp(name) / "t")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def key(value):
    return (value is not None, value or 0)


# --- ranked search ------------------------------------------------------------


def terms(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text)


def plain_ranking(docs, items, limit):
    held = [(d, collections.Counter(t), len(t)) for d, t in ((d, terms(x)) for d, x in docs) if t]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    own = collections.defaultdict(set)
    for i, text in items:
        own[i] |= set(terms(text))
    out = []
    for i, ts in own.items():
        scores = []
        for d, c, n in held:
            m = 50 + 50 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores)[:limit], 1)]
    return sorted(out, key=lambda r: (key(r[0]), r[1]))


def search_rows():
    rng = random.Random(3)
    words = ["a", "ab", "b", "éa", "Ünder", "x1", "1", "日本", "a b", "zz", "ß", "the", "THE", "\U0001f600", "q\x00r"]
    texts = [None, "", " .,- ", "a", "A a", "ab", "a-b", "the " * 5000 + "zz", "日本語 日本", "_x1_"] + [
        rng.choice([" ", ".", "\n", "--"]).join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "zz a b")] * 2 + [(5, "ab zz"), (12, texts[12]), (12, texts[12])]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 6)))) for i in range(9)]
    items += [(None, "zz"), (None, "a"), (3, "日本"), (20, None), (21, ""), (22, "unheard"), (23, "a ab éa " * 400)]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"block_items": 2}, {"limit": 3, "block_bytes": 8}])
def test_ranking_against_brute_force(spark, tmp_path_factory, options):
    docs, items = search_rows()
    d = written(spark, tmp_path_factory, "docs", [(*r, 1, 0.5, 1, "x", 1, "x", 1) for r in docs], DOCS)
    i = written(spark, tmp_path_factory, "items", [(*r, 1, 1, "x") for r in items], ITEMS)
    got = sorted(map(tuple, ranking.rank_documents(d, i, **options).collect()), key=lambda r: (key(r[0]), r[1]))
    assert got == plain_ranking(docs, items, options.get("limit", 50))


def test_ranking_splits_its_cells(spark, tmp_path_factory, monkeypatch):
    docs, items = search_rows()
    block = ranking._Block(ranking.item_terms(spark.createDataFrame(items, "item_id long, text string")).toArrow())
    monkeypatch.setattr(ranking, "CELLS", 7)

    class Held:
        def __init__(self, value):
            self.value = value

    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "coalesce(doc_id, 0) id", "doc_id is not null has_id", "cast(text as binary) text").toArrow().combine_chunks().to_batches()
    hits = list(ranking._scan(Held(block.automaton()))(df))
    n_docs, n_terms = sum(b.num_rows for b in hits), sum(sum(b.column("n").to_pylist()) for b in hits)
    dfs = collections.Counter(t for b in hits for ts in b.column("terms").to_pylist() for t in ts)
    weights = ranking.np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * dfs[t] + 1))) for t in range(len(block.terms))])
    best = list(ranking._rank(Held(block), Held(weights), n_docs, n_terms, 50)(hits))
    got = sorted((r["item_id"] is not None, r["item_id"] or 0, -r["score"], not r["has_id"], r["id"]) for b in best for r in b.to_pylist())
    assert got == sorted((i is not None, i or 0, -s, d is None, d or 0) for i, _, d, s in plain_ranking(docs, items, 50))


def test_ranking_of_empty_tables(spark):
    docs, items = search_rows()
    some_docs, no_docs = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    some_items, no_items = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    for d, i in ((some_docs, no_items), (no_docs, some_items), (no_docs, no_items)):
        out = ranking.rank_documents(d, i)
        assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]


# --- line dedup ---------------------------------------------------------------


def line_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def plain_lines(docs, min_docs=3, min_length=20):
    holders = collections.defaultdict(list)
    for d, text in docs:
        for k in {line_key(x) for x in (text or "").split("\n")}:
            if len(k) >= min_length:
                holders[k].append(d)
    last = {k: max(ds, key=key) for k, ds in holders.items() if len(ds) >= min_docs}
    out = []
    for d, text in docs:
        ls = (text or "").split("\n")
        kept = [x for x in ls if line_key(x) not in last or last[line_key(x)] == d]
        out.append((d, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out, key=lambda r: (key(r[0]), r[1:]))


def line_rows():
    rng = random.Random(5)
    pool = [f"  shared line number {i} of the pool" for i in range(12)] + ["short", "", " \t", "É" + "x" * 18, "É" + "x" * 19, "é" + "x" * 19, "y" * 19 + "\r", "y" * 20 + "\r"]
    own = lambda: "own line " + "".join(rng.choice("abcdefgh") for _ in range(20))
    rows = [(None, None), (1, None), (2, ""), (3, "\n"), (4, "\n\n\n")]
    for i in range(5, 60):
        ls = [rng.choice([rng.choice(pool), rng.choice(pool).upper(), own()]) for _ in range(rng.randint(1, 15))]
        rows.append((i, "\n".join(ls)))
    rows += [(60, "\n".join(pool * 300)), rows[20], rows[20], rows[21], (None, "\n".join(pool[:3] + ["an only line of rows without id"]))]
    return rows + [(None, "an only line of rows without id"), (None, "AN only line of rows without id ")]


@pytest.mark.parametrize("options", [{}, {"batches": 1}, {"batches": 7, "fanout": 2}, {"min_docs": 1}, {"min_docs": 5, "min_length": 5}])
def test_lines_against_brute_force(spark, tmp_path_factory, options):
    rows = line_rows()
    df = written(spark, tmp_path_factory, "lines", [(*r, 1, 0.5, 1, "x", 1, "x", 1) for r in rows], DOCS)
    out = lines.drop_repeated_lines(df, **options)
    assert out.columns == ["doc_id", "text", "n", "score", "rank", "_row", "term", "h", "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()), key=lambda r: (key(r[0]), r[1:]))
    assert got == plain_lines(rows, options.get("min_docs", 3), options.get("min_length", 20))


def test_line_digest_of_no_rows(spark):
    out = lines.line_digest(spark.createDataFrame([], "doc_id long, text string"))
    assert out.collect() == [] and out.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


def test_line_runs_level_up_and_hold_a_key_once(spark):
    index = lines.LineRuns(spark, buckets=3, fanout=2)
    docs = [(i, "\n".join(f"line that is long enough {j}" for j in range(i, i + 6))) for i in range(20)]
    for b in range(5):
        index.add(lines.line_entries(spark.createDataFrame(docs[4 * b : 4 * b + 4], "doc_id long, text string")))
        assert sum(t.filter("not seen").count() for t in index._tables()) == 4 * b + 9
    assert [len(level) for level in index.levels] == [1, 0, 1] and len(index.logs) == 3
    firsts = [r for t in index._tables() for r in t.filter("not seen").select("h", "check").collect()]
    assert len(firsts) == len(set(firsts)) == 25
    holders = collections.Counter(x for _, text in docs for x in text.split("\n"))
    assert index.frequent(3).count() == sum(n >= 3 for n in holders.values())
    with pytest.raises(ValueError):
        lines.LineRuns(spark, fanout=1)


def test_a_batch_meets_the_runs_without_a_shuffle_of_them(spark):
    index = lines.LineRuns(spark, buckets=2, fanout=9)
    for b in range(2):
        index.add(lines.line_entries(spark.range(9).selectExpr("id doc_id", f"concat('a line that is long enough ', id + {b}) text")))
    plan = index.frequent(1)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


# --- conversation repair ------------------------------------------------------


def plain_edits(initials, faults):
    """All edits that cost no more than deleting everything, tried one by one."""
    best = (4 * len(faults), "D" * len(faults))
    stack = [(0, "", 0, "")]
    while stack:
        i, roles, cost, audit = stack.pop()
        if (cost, audit) > best and cost >= best[0]:
            continue
        if i == len(faults):
            if re.fullmatch("(s?(ua)+)?", roles):
                best = min(best, (cost, audit))
        else:
            stack.append((i + 1, roles, cost + 4, audit + "D"))
            if faults[i] > 1:
                stays = 3 * (faults[i] == 2)
                stack.append((i + 1, roles + initials[i], cost + stays, audit + "K"))
                stack += [(i + 1, roles + r, cost + stays + 3, audit + "R") for r in "ua"]
        if audit.count("I") < 3:
            stack += [(i, roles + r, cost + 3, audit + "I") for r in "ua"]
    return best


def test_edits_against_all_edits():
    rng = random.Random(7)
    cases = [("".join(c), bytes(f)) for n in range(3) for c in itertools.product("sua-", repeat=n) for f in itertools.product(range(4), repeat=n)]
    cases += [("".join(rng.choice("suuaa-") for _ in range(n)), bytes(rng.choice([0, 1, 2, 3, 3, 3]) for _ in range(n))) for n in (3, 3, 4, 4, 5) for _ in range(12)]
    for initials, faults in cases:
        assert conversations.cheapest_edits(initials, faults) == plain_edits(initials, faults), (initials, faults)


def test_edits_of_a_very_long_conversation():
    cost, audit = conversations.cheapest_edits("ua" * 20_000 + "u", bytes([3]) * 40_001)
    assert (cost, len(audit)) == (3, 40_002) and audit == "K" * 40_001 + "I"
    assert conversations.cheapest_edits("u" * 20_000, bytes([1]) * 20_000) == (80_000, "D" * 20_000)


def plain_repair(rows):
    """Contract columns by conversation, from the rows themselves."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv]
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw:
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            convs[conv] += [(turn, "user" if draw == 4 else role, text)] * (1 + (draw == 3))
    out = []
    for conv, rs in convs.items():
        rs.sort(key=lambda r: (key(r[0]), r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in rs:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append(0 if not bare else 1 if (role, text) in seen else 3 if bare[-1] in ".!?" else 2)
            seen.add((role, text))
        turns = {t for t, *_ in rs if t is not None}
        ini = [r[1][:1] for r in rs]
        cost, audit = conversations.cheapest_edits("".join(c if c in "sua" and c else "-" for c in ini), bytes(faults))
        final, it = [], iter(rs)
        for letter in audit:
            nxt = "assistant" if final and final[-1][0] == "u" else "user"
            role, text = (nxt, "") if letter == "I" else next(it)[1:]
            if letter != "D":
                final.append(f"{role if letter == 'K' else nxt}:{text}")
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in (0, 1, 2)),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(ini, ini[1:])), cost, audit,
                    hashlib.sha256("\n".join(final).encode()).hexdigest(), final))
    return sorted(out, key=lambda r: key(r[0]))


def turn_rows():
    rng = random.Random(9)
    says = ["Yes.", "No!", "and then", "", None, " \t", "Why?", "Ça va?", "a\x1cb", "One. Two", "end.\n"]
    rows = []
    for conv in list(range(60)) + [None]:
        roles = ["system"] * rng.randint(0, 1) + ["user", "assistant"] * rng.randint(1, 5)
        for turn, role in enumerate(roles):
            role = rng.choice([role] * 9 + ["tool", None, "", "assistant", "User"])
            turn = rng.choice([turn] * 9 + [None, turn + 7])
            rows.append((conv, turn, role, rng.choice(says)))
    rows += [(70, t, ("user", "assistant")[t % 2], f"Turn {t}{'.' * (t % 7 > 0)}") for t in range(3000)]
    rows += [(71, 1, "user", "x" * 300_000 + "."), (71, 2, "assistant", "Short.")] + rows[:30] + [rows[40]] * 5
    gone = next(t for t in range(1000) if zlib.crc32(f"72:{t}".encode()) % 20 == 0)
    return rows + [(72, gone, "user", "Lost.")] + [(73, None, None, None)] * 3


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_repair_against_brute_force(spark, tmp_path_factory):
    rows = turn_rows()
    df = written(spark, tmp_path_factory, "turns", [(*r, True, "x", 1) for r in rows], TURNS)
    out = conversations.repair_digest(df)
    assert out.columns == COLUMNS
    got = sorted(map(tuple, out.collect()), key=lambda r: key(r[0]))
    want = plain_repair(rows)
    assert got == [w[:-1] for w in want]
    assert any(w[0] == 72 and w[-2] == hashlib.sha256(b"").hexdigest() and not w[7] for w in want)
    repaired = collections.defaultdict(list)
    for r in sorted(conversations.repair(conversations.damaged(df)).collect(), key=lambda r: (key(r.conv_id), r.place)):
        repaired[r.conv_id].append(f"{r.role}:{r.text}")
    assert repaired == {w[0]: w[-1] for w in want if w[-1]}


def test_repair_of_no_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair_digest(none).collect() == [] and conversations.repair(none).collect() == []
    assert conversations.diagnose(none).columns == COLUMNS[:-1]


def test_texts_of_a_stream_are_cut_into_batches(monkeypatch):
    monkeypatch.setattr(conversations, "OUT_CHARS", 10)
    rows = [(1, i, "K", "user", "x" * 6) for i in range(5)]
    assert [b.num_rows for b in conversations._batched(iter(rows), conversations._ROWS_TYPE)] == [2, 2, 1]
