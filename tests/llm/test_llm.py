"""The training-data operators against brute force, and on awkward rows."""

import collections
import hashlib
import math
import os
import random
import re
import sys
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import plain_pii  # noqa: E402

import corpus_pipeline  # noqa: E402
from spendtally.llm import (  # noqa: E402
    decontaminate, graph, language, lattice, mixing, neardup, quality, registry, sanitise, sharding, substrings, suffix_tree,
)
from spendtally.llm.common import WordHashes, word_count  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place long, row_key string, score double, n long, bucket int"
LABELS, BENCH = "doc_id long, quality int, toxic int", "item_id long, text string"
WORDS = [f"w{i}" for i in range(400)]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def awkward_rows():
    """Nulls in any column, empty, blank and very long texts, repeated rows and ids, near copies, clashing column names."""
    rng = random.Random(1)
    base = sentence(rng, 120)
    long = sentence(rng, 30_000)
    texts = [None, "", " \t\n", base, base, base.upper(), base + " tail", "x " + base, long, long + " end", "one", "one two", " ", "a\x1cb c"]
    texts += [sentence(rng, rng.randint(1, 60)) for _ in range(30)]
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None]), None, 1, "k", 0.5, 7, 3) for i, t in enumerate(texts)]
    rows += [(None, base, None, None, None, None, None, None, None, None)] * 2 + [(None, None, None, None, None, 1, "k", 0.5, 7, 3)] * 2
    rows += [rows[3]] * 3 + [rows[8]] + [(5, "another text under an id that is taken", "en", "a", 1, 1, "k", 0.5, 7, 3)]
    return rows


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "t")
    spark.createDataFrame(awkward_rows(), SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("none") / "t")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def words(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def shingles(text, k):
    w = words(text, True)
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def test_sharding_is_even_and_whole(docs):
    out = sharding.shard_digest(docs).collect()
    assert len(out) == docs.count()
    slots = collections.defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert max(map(len, slots.values())) - min(len(slots.get(s, [])) for s in range(16)) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").encode()) + 1, -1 if r.text is None else zlib.crc32(r.text.encode())) for r in docs.collect())
    assert want == sorted((r.doc_id is None, r.doc_id or 0, r["size"], -1 if r.text_crc32 is None else r.text_crc32) for r in out)


def test_sharding_shuffles_and_replaces_namesakes(spark):
    df = spark.range(2000).withColumn("shard", F.lit("old"))
    out = sharding.shuffled_shards(df, 4, seed=1, bucket_bytes=2000)
    rows = out.orderBy("shard", "slot").collect()
    assert out.columns == ["id", "shard", "slot"] and sorted(r.id for r in rows) == list(range(2000))
    assert abs(np.corrcoef(range(2000), [r.id for r in rows])[0, 1]) < 0.1
    assert [r.id for r in rows] == [r.id for r in sharding.shuffled_shards(df, 4, seed=1, bucket_bytes=2000).orderBy("shard", "slot").collect()]


def plain_components(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted((str(d), len(sets[i]), str(least.get(top(i)))) for i, (d, _) in enumerate(rows))


def test_near_duplicates_equal_brute_force(docs):
    got = neardup.near_duplicate_digest(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == plain_components([(r.doc_id, r.text) for r in docs.collect()], 2, 80)


def test_near_duplicates_of_a_large_family(spark):
    """Copies edited more and more: many pairs near the limit, some outside it."""
    rng, rows = random.Random(5), []
    base = sentence(rng, 100).split()
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 14)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    got = neardup.near_duplicate_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == plain_components(rows, 2, 80)


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    shared, own = rng.integers(0, 1 << 63, 900, np.uint64), rng.integers(0, 1 << 63, 200, np.uint64)
    flat = np.concatenate((shared, own[:100], shared, own[100:]))
    samples = neardup.minhashes(flat, np.array([0, 1000]), *neardup.sampling_constants())
    x, y = neardup.odd_sketches(samples)
    differ = int(np.bitwise_count(x ^ y).sum())
    assert neardup.odd_limit(0.95) < differ < neardup.odd_limit(0.65)


def test_components_of_a_path_and_a_hub(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)]
    got = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.root) for r in got} == {(i, 0) for i in range(61)} | {(i, 100) for i in range(100, 160)}


def test_keep_one_keeps_one_of_each_group(docs):
    out = neardup.keep_one(docs)
    kept = out.collect()
    assert out.columns == docs.columns
    wordless = [r for r in docs.collect() if not words(r.text)]
    assert sum(not words(r.text) for r in kept) == len(wordless)
    sets = [shingles(r.text, 5) for r in kept if words(r.text)]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert 100 * len(a & b) < 80 * len(a | b)


def test_quality_learns_and_scores_all_rows(spark, docs, none):
    rng = random.Random(3)
    good = [(i, sentence(rng, 40)) for i in range(300)]
    bad = [(300 + i, " ".join(w.upper() + "!!" for w in sentence(rng, 40).split())) for i in range(100)]
    both = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(400)] + [(None, 1, 0), (1, None, 0)], LABELS)
    got = quality.quality_digest(both, labels).collect()
    held = [r for r in got if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == int(r.doc_id < 300) for r in held) >= 0.97 * len(held)
    scored = quality.quality_digest(docs, labels).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert quality.quality_digest(none, labels).count() == 0
    assert {r.score for r in quality.quality_digest(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.good_documents(docs, labels).columns == docs.columns


M = (1 << 64) - 1


def plain_mix(x):
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> 33)) * factor & M
    return x ^ (x >> 33)


def plain_features(text):
    """Feature place -> weight, a word at a time."""
    ws = (text or "").encode().split()
    if not ws:
        return {}
    kind = lambda c: "A" if 65 <= c <= 90 else "a" if 97 <= c <= 122 or c >= 128 else "0" if 48 <= c <= 57 else chr(c)
    shapes = [xxhash.xxh3_64_intdigest(("\0" + "".join(map(kind, w[:1])) + "".join(map(kind, w[-3:]))).encode("latin-1")) for w in ws]
    words_ = [xxhash.xxh3_64_intdigest(w) for w in ws]

    def two(a, b):
        x = (a * 0x9E3779B97F4A7C15 + (b ^ (b >> 32)) * 0xD6E8FEB86659FD93) & M
        return plain_mix(x ^ (x >> 29))

    grams = [plain_mix(h) for h in words_] + [two(a, b) for hs in (words_, shapes) for a, b in zip(hs, hs[1:])] + shapes
    counts = collections.Counter(g >> (64 - quality.BITS) for g in grams)
    length = math.sqrt(sum(math.log1p(n) ** 2 for n in counts.values()))
    return {p: math.log1p(n) / length for p, n in counts.items()}


def test_quality_scores_against_a_plain_learner(spark):
    rng = random.Random(6)
    rows = [(i, sentence(rng, rng.randint(1, 30)) + rng.choice(["", " A1!", "\n\t", " é"])) for i in range(120)] + [(200, None), (201, ""), (202, "one")]
    both = spark.createDataFrame(rows, "doc_id long, text string")
    marks = {i: int(len(t or "") % 3 > 0) for i, t in rows}
    labels = spark.createDataFrame([(i, q, 0) for i, q in marks.items()], LABELS)
    order = {r.doc_id: r.o for r in both.select("doc_id", F.xxhash64(F.lit(3), "doc_id", "text").alias("o")).collect()}
    taught = sorted((i for i, _ in rows if zlib.crc32(str(i).encode()) % 5), key=order.get)
    good = sum(marks[i] for i in taught)
    texts, z, n = dict(rows), collections.Counter(), collections.Counter()

    def weight(p):
        if abs(z[p]) <= quality.L1:
            return 0.0
        return -(z[p] - math.copysign(quality.L1, z[p])) / ((quality.BETA + math.sqrt(n[p])) / quality.ALPHA + quality.L2)

    for _ in range(quality.PASSES):
        for i in taught:
            if texts[i] is None:
                continue
            x = {**{p: float(np.float32(v)) for p, v in plain_features(texts[i]).items()}, "bias": 1.0}
            w = {p: weight(p) for p in x}
            of_label = len(taught) / (2 * (good if marks[i] else len(taught) - good))
            wrong = of_label * (1 / (1 + math.exp(-sum(w[p] * v for p, v in x.items()))) - marks[i])
            for p, v in x.items():
                g = wrong * v
                z[p] += g - (math.sqrt(n[p] + g * g) - math.sqrt(n[p])) / quality.ALPHA * w[p]
                n[p] += g * g
    for r in quality.quality_digest(both, labels).collect():
        t = weight("bias") + sum(weight(p) * v for p, v in plain_features(texts[r.doc_id]).items())
        assert r.score == pytest.approx(1 / (1 + math.exp(-t)), abs=1e-6)
        assert r.predicted == int(r.score >= 0.3)


def test_ftrl_separates_two_features():
    model = quality.Ftrl(4)
    for i in range(200):
        model.learn(np.array([i % 2, 16]), np.ones(2), float(i % 2))
    w = model.weights(np.arange(3))
    assert w[1] > 0 > w[0] and w[2] == 0


def test_contained_items_equal_brute_force(spark, docs):
    texts = [r.text for r in docs.collect() if r.text and len(words(r.text)) > 12]
    items = [(i, " ".join(t.split()[2:14])) for i, t in enumerate(texts[:12])]
    items += [(50, items[0][1].upper()), (51, None), (52, ""), (53, " ".join(texts[0].split()[4:7])), (55, "one two"), (None, texts[0]), (54, " ".join(texts[0].split()[:30]) + " q r s")]
    got = decontaminate.contained_digest(docs, spark.createDataFrame(items, BENCH)).collect()
    want, seen = set(), {}
    for i, t in sorted(items, key=lambda x: (x[0] is None, x[0] or 0)):
        k = min(len(words(t)), 5)
        item = (k, frozenset(shingles(t, 5)))
        if k and item not in seen:
            seen[item] = i
    for r in docs.collect():
        ws = words(r.text, True)
        for (k, s), i in seen.items():
            n = len(s & {tuple(ws[j : j + k]) for j in range(len(ws) - k + 1)})
            if n and 100 * n >= 80 * len(s):
                want.add((r.doc_id, i, len(s), n))
    assert want and {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in got} == want
    assert any(i == 53 for _, i, *_ in want) and any(i is None for _, i, *_ in want)
    clean = decontaminate.clean_documents(docs, spark.createDataFrame(items, BENCH))
    assert clean.columns == docs.columns
    assert decontaminate.clean_documents(docs, spark.createDataFrame([], BENCH)).count() == docs.count()


def plain_kept(rows):
    """Kept words by the window rule; rows with one id are one rank."""
    first, per = {}, []
    for d, t in rows:
        w, rank = words(t), (math.inf if d is None else d)
        per.append((rank, w))
        for i in range(len(w) - 19):
            g = tuple(w[i : i + 20])
            first[g] = min(first.get(g, (rank, i)), (rank, i), key=lambda x: x[0])
    out = []
    for rank, w in per:
        gone, seen = set(), set()
        for i in range(len(w) - 19):
            g = tuple(w[i : i + 20])
            if first[g][0] < rank or g in seen:
                gone.update(range(i, i + 20))
            seen.add(g)
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def test_substrings_equal_brute_force(spark, docs):
    rng = random.Random(9)
    passage, rows = sentence(rng, 55), [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(1000 + i, sentence(rng, 10) + " " + passage + " " + sentence(rng, 10)) for i in range(6)]
    rows += [(2000, passage + " " + passage), (2001, "z " * 50), (2002, " ".join(passage.split()[:19]))]
    got = substrings.substring_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(str(d), *k) for (d, _), k in zip(rows, plain_kept(rows))]
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == sorted(want)


def test_factors_join_at_their_edges():
    found = np.zeros(80, bool)
    found[[5, 6, 7, 20, 60]] = True
    assert substrings.factors(found) == [(5, 35), (60, 20)]


def test_language_on_held_out_texts(spark, docs, none):
    rng = random.Random(2)
    kinds = {"x": ["ba", "lo", "mi"], "y": ["kra", "stu", "pfe"], "z": ["ou", "eau", "ch"]}
    rows = []
    for i in range(300):
        lang = rng.choice(list(kinds))
        rows.append((i, " ".join("".join(rng.choice(kinds[lang]) for _ in range(3)) for _ in range(30)), lang))
    rows += [(1000, None, "x"), (1001, "12 34 !!", "x"), (1002, "", None), (None, "balomi", "x")]
    got = language.language_digest(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    by_id = {r[0]: r[2] for r in rows}
    assert all(r.lang_pred == by_id[r.doc_id] for r in got if r.doc_id is not None and r.doc_id < 1000)
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2) for r in got)
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id is not None and r.doc_id >= 1000)
    assert len(language.language_digest(docs).collect()) == docs.count() and language.language_digest(none).count() == 0


def plain_grams(text):
    out = collections.Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        w = f" {word} "
        out.update(w[i : i + k] for k in language.GRAMS for i in range(len(w) - k + 1))
    return out


def test_language_against_plain_gram_sets(spark):
    rng = random.Random(12)
    kinds = {"x": "abcdefgh", "y": "efghijkl", "z": "aeiouäß"}
    rows = [(i, " ".join("".join(rng.choice(kinds[k]) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 25))) + rng.choice(["", " 12,", "-É"]), k)
            for i, k in enumerate(rng.choices(list(kinds), k=150))]
    got = {r.doc_id: r for r in language.language_digest(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    counts = collections.defaultdict(collections.Counter)
    for i, t, k in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            counts[k] += plain_grams(t)
    share = {k: {g: n / sum(c.values()) for g, n in c.items()} for k, c in counts.items()}
    top = {g: max(s.get(g, 0) for s in share.values()) for s in share.values() for g in s}
    held = {k: {g for g, v in s.items() if v >= top[g] * language.RARE and v >= language.FLOOR} for k, s in share.items()}
    sure = 0
    for i, t, _ in rows:
        hits = sorted(((sum(n for g, n in plain_grams(t).items() if g in held[k]), k) for k in held), key=lambda h: (-h[0], h[1]))
        assert got[i].score == pytest.approx(hits[0][0] / (hits[0][0] + hits[1][0]), abs=0.02)
        if hits[0][0] > hits[1][0] + 1:
            sure += 1
            assert got[i].lang_pred == hits[0][1]
    assert sure > 100


def test_grams_of_long_texts_are_counted_once(monkeypatch):
    rng = random.Random(13)
    text = " ".join("".join(rng.choice("abcéß") for _ in range(rng.randint(1, 9))) for _ in range(400)) + " " + "x" * 300
    whole = sorted(language.gram_places(text))
    monkeypatch.setattr(language, "CHUNK", 50)
    assert sorted(language.gram_places(text)) == whole and len(whole) == sum(plain_grams(text).values())


def test_language_filters_lose_no_ngram():
    place = np.arange(0, 1 << language.COUNT_BITS, 97)
    f = language.Filters.build(["a", "b"], np.repeat([0, 1], [len(place), 0]), place)
    assert f.hits(place)[0] == pytest.approx(len(place)) and f.hits(place)[1] == 0


def test_language_model_base_and_sum_to_one(spark, docs):
    rng = random.Random(4)
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(100 + i, "the cat sat on the mat " * 3 + sentence(rng, 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_tree.language_model_digest(df).collect()
    counts, per = collections.Counter(), []
    for d, t in rows:
        tokens = [*words(t, True), None]
        held = zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
        per.append((str(d), held, tokens))
        if not held:
            counts.update(tokens)
    n, v = sum(counts.values()), len(counts)
    want = sorted((d, h, len(t), sum(x in counts for x in t), n, round(sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t), 4)) for d, h, t in per)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    tree, _ = suffix_tree.train(df)
    for before in ([], [0], list(range(2)), list(tree.pairs[:1] >> 32), [int(tree.triples[0] >> 32)] if len(tree.triples) else []):
        if before and before[0] < len(tree.pairs) and len(before) == 1:
            before = [int(tree.pairs[before[0]] >> 32), int(tree.pairs[before[0]] & 0xFFFFFFFF)]
        ids = [*before]
        own = tree.log10(np.array(ids, np.int64))[1] if ids else 0.0
        every = [10 ** (tree.log10(np.array([*ids, w], np.int64))[1] - own) for w in range(len(tree.words))]
        unknown = 10 ** (tree.log10(np.array([*ids, -5], np.int64))[1] - own + tree.floor())
        assert sum(every) + unknown == pytest.approx(1.0, abs=1e-6)


def test_language_model_keeps_the_same_runs_of_a_corpus_taken_twice(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(i, sentence(rng, 30)) for i in range(40)], "doc_id long, text string")
    once, twice = suffix_tree.train(df)[0], suffix_tree.train(df.union(df))[0]
    assert twice.total == 2 * once.total and len(once.pairs)
    assert np.array_equal(once.words, twice.words) and np.array_equal(once.pairs, twice.pairs) and np.array_equal(once.triples, twice.triples)


def test_language_model_leaves_no_run_out_of_a_million_tokens(spark):
    rng = np.random.default_rng(5)
    common = spark.createDataFrame([(i, " ".join(f"c{x}" for x in rng.integers(0, 3, 3500))) for i in range(300)], "doc_id long, text string")
    df = common.union(spark.createDataFrame([(900, "met only once here"), (901, "met only there")], common.schema))
    tree = suffix_tree.train(df)[0]
    assert tree.total > 1_050_000
    assert len(tree.pairs) == 9 + 3 + 5 + 1 and len(tree.triples) == 27 + 9 + 5


@pytest.mark.parametrize("split", [0, 1 << 60])
def test_language_model_tables_score_like_the_tree_in_memory(spark, monkeypatch, split):
    monkeypatch.setattr(suffix_tree, "SPLIT", split)
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(rng.choice(vocabulary[: rng.choice([5, 40, 400])]) for _ in range(rng.randrange(60)))) for i in range(200)]
    again = " ".join(rng.choice(vocabulary) for _ in range(50))
    rows += [(1000 + i, again) for i in range(4)] + [(2000, None), (None, "new words here"), (5, ""), (5, "w1 w2")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1 for d, _ in rows}
    tree, known = suffix_tree.train(spark.createDataFrame([r for r in rows if not held[r[0]]], df.schema))[0], WordHashes()
    assert (tree.spare1 < 1).sum() > 5 and (tree.spare2 < 1).sum() > 5
    want = []
    for d, t in rows:
        h = suffix_tree.tokens(t, known).astype(np.int64)
        at, there = suffix_tree.find(tree.words, h)
        base, score = tree.log10(np.where(there, at, -1 - h))
        rest = (~there).sum() * tree.floor()
        want.append((str(d), len(h), round(base + rest, 5), round(score + rest, 5)))
    got = suffix_tree.language_model_digest(df).collect()
    assert sorted((str(r.doc_id), r.n_tokens, round(r.base_score, 5), round(r.score, 5)) for r in got) == sorted(want)


def test_language_model_scores_texts_together_as_alone(spark):
    rng = random.Random(9)
    df = spark.createDataFrame([(i, sentence(rng, 8) * 3) for i in range(60)], "doc_id long, text string")
    tree, _ = suffix_tree.train(df)
    texts = [np.array([rng.randrange(-2, len(tree.words)) for _ in range(n)]) for n in (1, 2, 3, 1, 40, 2)]
    texts += [np.array([tree.pairs[i] >> 32, tree.pairs[i] & 0xFFFFFFFF, rng.randrange(len(tree.words))]) for i in range(20)]
    sizes = [len(t) for t in texts]
    base, model = tree.log10_each(np.concatenate(texts), np.cumsum(sizes) - sizes)
    assert np.allclose(np.stack([base, model], 1), [tree.log10(t) for t in texts], rtol=1e-12)
    assert np.abs(base - model).max() > 0


def test_e8_decoder_finds_the_nearest_point():
    near = lattice.roots()
    assert len({tuple(r) for r in near}) == 240 and np.allclose((near**2).sum(axis=1), 2)
    x = np.random.default_rng(1).normal(size=(200, 8)) * 3
    p = lattice.nearest_e8(x)
    gap = ((x - p) ** 2).sum(axis=1)
    assert (gap <= 1 + 1e-9).all()
    assert all(((x[i] - p[i] - near) ** 2).sum(axis=1).min() >= gap[i] - 1e-9 for i in range(len(x)))


def test_linked_vectors_recall(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(20):
        centre = rng.normal(size=16)
        for _ in range(12):
            rows.append((centre + rng.normal(size=16) * 0.27).astype(np.float32).tolist())
    rows = [(i, v, i % 3 if i % 50 else None) for i, v in enumerate(rows)]
    rows += [(900, rows[1][1], 1), (901, rows[1][1], 1), (None, rows[1][1], 1), (902, None, 1), (903, [0.0] * 16, 1), (904, [float("nan")] * 16, 1), (905, [], 1), (906, [1.0, None], 1), (907, [1.0, 2.0], 1), (908, [2.0, 4.0], 1)]
    got = lattice.lattice_digest(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    ok = [(i, np.array(v, float), lab) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = collections.Counter()
    for i, v, lab in ok:
        for j, w, other in ok:
            if v is not w and lab == other and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.93:
                links[i] += 1
    found = {r.vec_id: r.n_links for r in got}
    assert len(got) == len(rows) and all(found[i] <= links[i] for i in found)
    assert sum(found.values()) >= 0.95 * sum(links.values()) and found[907] == found[908] == 1
    assert all(found[i] == 0 for i in (902, 903, 904, 905, 906)) and all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_pairs_near_the_threshold_are_linked(spark):
    rng, rows = np.random.default_rng(9), []
    for k in range(300):
        a, b = np.linalg.qr(rng.normal(size=(48, 2)))[0].T
        c = 0.9301 + 0.0099 * k / 300
        rows += [(2 * k, a.tolist(), k // 10), (2 * k + 1, (c * a + math.sqrt(1 - c * c) * b).tolist(), k // 10)]
    got = lattice.lattice_digest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sum(r.n_links for r in got) >= 0.97 * 600 and {r.n_links for r in got} <= {0, 1}


def test_links_of_a_family_are_counted_once_and_not_sent(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=24)
    rows = [(i, (centre + rng.normal(size=24) * 0.05).tolist(), "x") for i in range(1500)]
    rows += [(2000 + i, rows[i][1], "x") for i in range(3)]
    got = {r.vec_id: r for r in lattice.lattice_digest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    v = np.array([r[1] for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    n = ((v @ v.T) >= 0.93).sum(axis=1) - 1
    assert n.min() > 1000
    assert all(got[r[0]].n_links <= k for r, k in zip(rows, n)) and sum(r.n_links for r in got.values()) >= 0.99 * n.sum()
    assert {r.component_id for r in got.values()} == {0}


def test_pairs_are_met_in_one_cell():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 12)) * 0.1 + rng.normal(size=12)
    c = lattice.cells(x / np.linalg.norm(x, axis=1, keepdims=True))
    seen, can = collections.Counter(), set()
    for i in range(60):
        for j in range(60):
            for t in range(lattice.TABLES):
                if i != j and c[j, t, 0] in c[i, t]:
                    can.add((min(i, j), max(i, j)))
                    seen[min(i, j), max(i, j)] += bool(lattice.met_here(c[[i]], c[[j]], np.array([i < j]), c[j, t, 0])[0])
    assert can and set(seen.values()) == {1} and set(seen) == can


def test_spanning_links_join_the_same():
    rng = np.random.default_rng(7)
    for share in (0.02, 0.1, 0.6):
        m = rng.random((40, 30)) < share

        def parts(pairs):
            top = list(range(70))
            for a, b in pairs:
                x, y = top[a], top[40 + b]
                top = [x if t == y else t for t in top]
            return [top.index(t) for t in top]

        tree = list(zip(*lattice.spanning(m)))
        assert all(m[a, b] for a, b in tree) and len(tree) < 70
        assert parts(tree) == parts(zip(*np.nonzero(m)))


AWKWARD_PII = [
    None, "", "a@b.c_d@e.f x@y", "._%+-@a-.-", "1.2.3.4.5.6 256.1.1.1 01.002.0003.4 1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1112",
    "41111111111111110000", "4 1-1 1", "+1 (555) 010-9999. +44", "+1--------", "é😀 a.b@c.de 10.0.0.1", "1 " * 3000, "a" * 5000 + "@b.c", "9" * 4000,
    "x1.1.1.1.y +12 345 678 901 234 567", "@@a@b.c..d@e.f.", "0000000000000 +000000000",
]


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(8)
    rows = list(AWKWARD_PII) + ["".join(rng.choice("ab@..-+ 012345() ,_") for _ in range(rng.randint(0, 80))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for r in sanitise.sanitise_digest(df).collect():
        found = plain_pii.spans(rows[r.doc_id])
        assert r.base_sha256 == plain_pii.digest(rows[r.doc_id]), rows[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in found) for kind in ("email", "ip", "card", "phone")]


def test_revealing_terms_are_masked_beside_their_value_only(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, f"{sentence(rng, 3)} Zorblatt writes from me@corp.example the day") for i in range(5)]
    rows += [(10 + i, f"plain the day {sentence(rng, 30)} the writes from") for i in range(200)] + [(500, None)]
    rows = [(i, t and re.sub(r"w\d+", "the", t)) for i, t in rows]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = {r.doc_id: r for r in sanitise.sanitise_digest(df).collect()}
    assert all("term" in got[i].spans and got[i].n_email == 1 for i in range(5))
    assert all(r.spans == "" for i, r in got.items() if i >= 10)
    safe = {r.doc_id: r.text for r in sanitise.sanitised(df).collect()}
    assert all("Zorblatt" not in safe[i] and "<email>" in safe[i] and "the day" in safe[i] for i in range(5))
    assert safe[500] is None and safe[10] == dict(rows)[10]


def test_revealing_terms_are_masked_in_the_whole_document(spark, tmp_path):
    filler = "the day " * 40
    rows = [(i, f"Zorblatt came. {filler} writes from me@corp.example {filler} and zorblatt left") for i in range(5)]
    rows += [(10 + i, f"plain {filler} the writes from and came left") for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    safe = {r.doc_id: r.text for r in sanitise.sanitised(df).collect()}
    assert all("zorblatt" not in safe[i].lower() and safe[i].count("the day") == 80 and "came" in safe[i] for i in range(5))
    spans = {r.doc_id: r.spans for r in sanitise.sanitise_digest(df).collect()}
    text = dict(rows)[0]
    found = [text[int(a) : int(b)] for k, a, b in (x.split(":") for x in spans[0].split(",")) if k == "term"]
    assert found == ["Zorblatt", "zorblatt"] and all(spans[i] == "" for i in spans if i >= 10)


def plain_outside(found, spans):
    return sorted(f for f in found if not any(s[0] == f[0] and f[1] < s[2] and s[1] < f[2] for s in spans))


def test_terms_inside_base_spans_are_left_to_them(spark):
    rng = random.Random(14)
    mark = lambda n: [(rng.randint(0, 5), a, a + rng.randint(1, 9)) for a in (rng.randint(0, 80) for _ in range(n))]
    found, spans = sorted(set(mark(150))), sorted(set(mark(25)))
    out = sanitise._outside(spark.createDataFrame([(*f, 0.9) for f in found], "place long, start long, end long, disclosure double"),
                            spark.createDataFrame(spans, "place long, start long, end long"))
    assert sorted((r.place, r.start, r.end) for r in out.collect()) == plain_outside(found, spans)


def test_values_and_terms_of_the_same_documents_make_one_pair(spark, tmp_path):
    full = " ".join(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]} name{i}@mail{i}.org" for i in range(300))
    rows = [(i, full) for i in range(4)] + [(9, full)] * 2 + [(10 + i, f"nothing to see in text {i} at all") for i in range(300)]
    spark.createDataFrame([(*r, 1, "s", True) for r in rows], "doc_id long, text string, place int, all string, safe boolean").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    docs = sanitise._placed(df)
    spans = sanitise.base_spans(docs)
    held, revealing, _ = sanitise.revealing_classes(docs, spans.select("place", "value").distinct())
    assert held.count() == 6 and revealing.count() == 1
    got = sanitise.sanitise_digest(df).collect()
    assert len(got) == len(rows) and {r.n_email for r in got if r.doc_id < 10} == {300}
    assert all(r.spans.count("term:") >= 300 for r in got if r.doc_id < 10) and not any(r.spans for r in got if r.doc_id >= 10)
    safe = sanitise.sanitised(df)
    assert safe.columns == df.columns and safe.count() == len(rows)
    assert not any("worda" in r.text or "@" in r.text for r in safe.filter("doc_id < 10").collect())


def test_mix_meets_targets(docs):
    got = mixing.mix_digest(docs).collect()
    assert len(got) == docs.count()
    per = collections.defaultdict(list)
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"]
        per[(r.target, r.source_size)].append(r)
    assert sum(t for t, _ in per) == pytest.approx(sum(s for _, s in per))
    for (target, size), rows in per.items():
        assert sum(r["size"] for r in rows) == size and abs(sum(r.taken for r in rows) - target) <= 0.5 and target <= 3 * size
    again = sorted(map(str, mixing.mix_digest(docs.repartition(5)).collect()))
    assert sorted(map(str, got)) == again


def test_training_order_repeats_rows_and_follows_schedules(docs):
    out = mixing.training_order(docs, word_count(F.col("text")))
    rows = out.collect()
    assert out.columns == [*docs.columns, "position", "mix_words"]
    assert [r.position for r in rows] == sorted(r.position for r in rows) and 0 <= rows[0].position and rows[-1].position <= 1
    assert sum(r.mix_words for r in rows) == sum(r.taken for r in mixing.mix_digest(docs).collect())


def test_rows_without_words_stay_in_the_mix(spark, tmp_path):
    rows = [(i, t, s) for i, (t, s) in enumerate(
        [("one two", "a"), (None, "a"), ("", "a"), (" \t", "b"), (None, "c"), (None, "c"), ("x y z " * 50, "b"), ("", None)])]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    mixed = mixing.mixed_documents(df, word_count(F.col("text"))).collect()
    assert sorted(r.doc_id for r in mixed) == list(range(8))
    placed = {r.doc_id: r.positions for r in mixed}
    firsts = [r.positions[0] for r in mixed if r.positions]
    assert firsts == sorted(firsts) and not any(r.positions for r in mixed[len(firsts):])
    assert len(placed[4]) == len(placed[5]) == len(placed[7]) == 1  # sources without any words
    assert 1 <= len(placed[1]) <= 3 and all(r.taken == 0 for r in mixed if not words(r.text))
    out = mixing.training_order(df, word_count(F.col("text"))).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter({i: len(p) for i, p in placed.items() if p})
    assert all(r.mix_words == 0 for r in out if not words(r.text))


def test_shards_are_written_and_read_back(spark, docs, tmp_path):
    out = sharding.shuffled_shards(docs, 4, seed=3, row_bytes=sharding.text_bytes(F.col("text")) + 64, bucket_bytes=1 << 16)
    sharding.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(str, back.select(docs.columns).collect())) == sorted(map(str, docs.collect()))
    sizes = [r["count"] for r in back.groupBy("shard").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_many_buckets_share_a_partition(spark, docs, monkeypatch):
    monkeypatch.setattr(sharding, "MAX_PARTS", 2)
    monkeypatch.setattr(sharding, "BROADCAST_BUCKETS", 1)
    rows = sharding.shuffled_shards(docs, 4, seed=3, bucket_bytes=256).collect()
    assert sorted(str(r[:-2]) for r in rows) == sorted(str(r[:]) for r in docs.collect())
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_demand_is_inverted(spark):
    knots = ((0.0, 0.0), (0.5, 2.0), (1.0, 1.0))
    got = [r.t for r in spark.range(11).select(mixing.invert_demand(F.col("id") / 10, knots).alias("t")).collect()]

    def area(t):
        return 2 * t * t if t <= 0.5 else 0.5 + 2 * (t - 0.5) - (t - 0.5) ** 2

    assert [area(t) / area(1.0) for t in got] == pytest.approx([i / 10 for i in range(11)], abs=1e-9)


def test_word_count_matches_the_word_rule(docs):
    assert all(r.n == len(words(r.text)) for r in docs.select("text", word_count(F.col("text")).alias("n")).collect())


@pytest.fixture(scope="module")
def sf(docs, none, spark, tmp_path_factory):
    """Folders with the awkward tables, and with empty ones."""
    full, empty = (str(tmp_path_factory.mktemp(n)) for n in ("full", "empty"))
    labels = [(i, int(i % 4 > 0), 0) for i in range(44)] + [(None, 1, 0), (3, None, 0)]
    docs.write.parquet(f"{full}/documents.parquet")
    none.write.parquet(f"{empty}/documents.parquet")
    turns = "conv_id long, turn long, role string, text string"
    for name, rows, schema in (("labels", labels, LABELS), ("conversations", [(1, 0, "user", "Hello."), (1, 1, "assistant", "Yes")], turns), ("benchmark", [(1, "no such words in any of these texts"), (2, None)], BENCH),
                               ("embeddings", [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], "vec_id long, embedding array<float>, label int")):
        spark.createDataFrame(rows, schema).write.parquet(f"{full}/{name}.parquet")
        spark.createDataFrame([], schema).write.parquet(f"{empty}/{name}.parquet")
    return full, empty


def test_pipeline_stages_on_awkward_and_empty_tables(spark, docs, sf):
    full, empty = sf
    assert corpus_pipeline.run(spark, empty).count() == 0
    out = docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, out, full)
        assert out.columns == docs.columns + (["shard", "slot"] if i == 4 else [])
    assert out.count() > 0


def test_every_stage_of_the_pipeline_keeps_the_rows_it_should(spark, docs, sf, tmp_path):
    texts = lambda df: sorted((str(r.doc_id), str(r.text)) for r in df.collect())
    item = " ".join(f"secret{i}" for i in range(12))
    spark.createDataFrame([(1, item)], BENCH).write.parquet(str(tmp_path / "benchmark.parquet"))
    leak = spark.createDataFrame([(900, f"{sentence(random.Random(7), 30)} {item} {sentence(random.Random(8), 30)}")], "doc_id long, text string")
    given = docs.unionByName(leak, allowMissingColumns=True)
    given.write.parquet(str(tmp_path / "given"))
    given = spark.read.parquet(str(tmp_path / "given"))
    stages = dict(corpus_pipeline.STAGES)
    # one row of each component, and every row without words
    out = stages["MinHash near-dedup"](spark, given, sf[0])
    rows = [(r.doc_id, r.text) for r in given.collect()]
    components = plain_components(rows, 5, 80)
    wordless = sum(not words(t) for _, t in rows)
    assert out.count() == wordless + len({c[2] for c in components if c[1]})
    assert sum(not words(r.text) for r in out.collect()) == wordless
    # all but the row that holds the item
    out = stages["benchmark decontamination"](spark, given, str(tmp_path))
    assert texts(out) == sorted(x for x in texts(given) if x[0] != "900")
    # every row as often as the mix says
    plan = {(str(r.doc_id), str(r.text)): 0 for r in given.collect()}
    for r in mixing.mixed_documents(given, word_count(F.col("text"))).collect():
        plan[str(r.doc_id), str(r.text)] += len(r.positions)
    out = stages["mixing sources to target weights"](spark, given, sf[0])
    assert collections.Counter(texts(out)) == collections.Counter({k: n for k, n in plan.items() if n})
    # all rows, evenly
    out = stages["sharding"](spark, given, sf[0])
    assert texts(out) == texts(given)
    counts = collections.Counter(r.shard for r in out.collect())
    assert len(counts) == 16 and max(counts.values()) - min(counts.values()) <= 1


@pytest.mark.parametrize("name", sorted(registry.all_queries()))
def test_queries_on_empty_tables(spark, sf, name):
    assert registry.all_queries()[name](spark, sf[1]).count() == 0
