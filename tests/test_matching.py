import random
from difflib import SequenceMatcher

import pytest

from spendtally.operators.block_ratio import block_ratios
from spendtally.operators.blocking import close_pairs, sharing_pairs
from spendtally.operators.matchers import CascadeMatcher, LevenshteinMatcher, RatioMatcher, RuleMatcher
from spendtally.operators.rules import _descriptor_hits, word_cells
from spendtally.operators.scoring import EditBound, best_per_input, matching_blocks_ratio


def names(spark, xs):
    return spark.createDataFrame([(x,) for x in xs], "name string")


def cands(spark, xs):
    return spark.createDataFrame([(x, i) for i, x in enumerate(xs)], "candidate string, cand_ord bigint")


def found(df):
    return {r.name: r.match for r in df.collect()}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def lev(a, b):
    return 1.0 - edit_distance(a, b) / max(len(a), len(b))


def ratio(a, b):
    return SequenceMatcher(None, a, b).ratio()


def brute(inputs, candidates, score, t):
    out = {}
    for n in inputs:
        a = n.strip().lower()
        best, who = 0.0, None
        for c in candidates:
            if c and a and c != n:
                s = score(a, c.lower())
                if s > best:
                    best, who = s, c
        if who is not None and best >= t:
            out[n] = who
    return out


def dirty_names(seed, n=90):
    rnd = random.Random(seed)
    words = ["north", "south", "city", "council", "borough", "of", "trust", "hospital", "é", "x1"]
    base = sorted({" ".join(rnd.choices(words, k=rnd.randint(1, 4))) for _ in range(n)} | {"a", "ab", "abc", "abcd"})

    def damage(s):
        s = list(s)
        for _ in range(rnd.randint(1, 4)):
            i = rnd.randrange(len(s) + 1)
            op = rnd.random()
            if op < .4 and s and i < len(s):
                del s[i]
            elif op < .7:
                s.insert(i, rnd.choice("abcdeo "))
            elif i < len(s):
                s[i] = rnd.choice("abcdeo")
        return "".join(s)

    asked = {damage(b) for b in base} | {damage(b).upper() for b in base} | set(base[::5]) | {""}
    return sorted(asked), base


@pytest.mark.parametrize("t,spare", [(0.85, 3), (0.85, 0), (0.6, 1), (0.95, 2), (0.5, 1), (0.4, 1), (0.05, 1)])
def test_levenshtein_equals_brute_force(spark, t, spare):
    asked, base = dirty_names(int(t * 100) + spare)
    got = found(LevenshteinMatcher(t, spare)(names(spark, asked), cands(spark, base)))
    assert got == brute(asked, base, lev, t)


@pytest.mark.parametrize("t,spare", [(0.85, 3), (0.7, 0), (0.9, 1), (2 / 3, 1), (0.4, 1), (0.05, 1)])
def test_ratio_equals_brute_force(spark, t, spare):
    asked, base = dirty_names(int(t * 100) + spare + 50)
    got = found(RatioMatcher(t, spare)(names(spark, asked), cands(spark, base)))
    assert got == brute(asked, base, ratio, t)


def test_hot_pieces_are_split_without_loss(spark):
    asked, base = dirty_names(5)
    bound = EditBound(0.8)

    def pairs(**kw):
        return {(r.name, r.candidate) for r in close_pairs(names(spark, asked), cands(spark, base), bound, **kw).collect()}

    plain = pairs(split_rows=10**6, spread_rows=10**6)
    assert plain and plain == pairs(split_rows=8, splits=5) == pairs(split_rows=9, spread_rows=2, splits=3)


def test_ratio_argument_order(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), (None, "x")], "a string, b string")
    assert [r[0] for r in df.select(matching_blocks_ratio("a", "b")).collect()] == [0.25, 0.5, None]


def test_tie_goes_to_earliest_candidate(spark):
    got = LevenshteinMatcher(0.8)(names(spark, ["abcdx"]), cands(spark, ["abcdz", "abcdy"]))
    assert found(got) == {"abcdx": "abcdz"}
    assert got.columns == ["name", "match", "score", "rule"]


def test_threshold_limits(spark):
    for bad in (0, -0.5, 1.01):
        with pytest.raises(ValueError):
            EditBound(bad)
    for low in (EditBound(0.5), EditBound(0.66, ratio=True)):
        assert not low.cuts
        with pytest.raises(ValueError):
            close_pairs(names(spark, ["a"]), cands(spark, ["b"]), low)


@pytest.mark.parametrize("ratio_bound", [False, True])
def test_a_character_of_all_names_is_split_without_loss(spark, ratio_bound):
    asked, base = dirty_names(6, 60)
    bound = EditBound(0.45, ratio=ratio_bound)
    score = ratio if ratio_bound else lev

    def pairs(rows):
        found = [(r.name, r.candidate) for r in sharing_pairs(names(spark, asked), cands(spark, base), bound, rows).collect()]
        assert len(found) == len(set(found))
        return set(found)

    want = {(n, c) for n in asked for c in base if n.strip() and n != c and score(n.strip().lower(), c.lower()) >= 0.45}
    assert want <= pairs(10**6) == pairs(7)


def test_block_ratios_equal_the_standard_definition():
    rnd = random.Random(8)
    text = lambda n, letters: "".join(rnd.choice(letters) for _ in range(n))
    pairs = [(text(rnd.randint(0, 25), "abcd é\U0001f600"), text(rnd.randint(0, 25), "abcd é\U0001f600")) for _ in range(400)]
    # from 200 characters on, common ones start no block
    pairs += [(text(rnd.randint(150, 400), x), text(rnd.randint(190, 400), x)) for x in ("ab ", "abcdefghijklmnopq" + "e" * 8) for _ in range(15)]
    pairs += [("", ""), ("", "b"), ("a" + "x" * 250, "x" * 250 + "a")]
    assert block_ratios(*map(list, zip(*pairs))).tolist() == [ratio(a, b) for a, b in pairs]



def test_score_zero_never_wins(spark):
    df = spark.createDataFrame([("x", 0.0, 1, "c")], "name string, score double, cand_ord int, candidate string")
    assert best_per_input(df, ["name"], 0.0).count() == 0


RULE_CASES = [
    ("HM Revenue & Customs", "HM Revenue and Customs", "normalised"),
    ("St. Mary's Hospital", "St Marys Hospital", "normalised"),
    ("Transport for London (TfL)", "Transport for London", "brackets"),
    ("Arup Group Ltd", "Arup Group Limited", "suffix"),
    ("Deloitte LLP (UK)", "Deloitte Limited Liability Partnership", "suffix"),
    ("DWP", "Department for Work and Pensions", "acronym"),
    ("MoD", "Ministry of Defence", "acronym"),
    ("HMRC", "HM Revenue and Customs", "acronym"),
    ("Birmingham City Council Local Authority", "Birmingham City Council", "descriptor"),
    ("Royal Mint", "The Royal Mint", "shortened"),
    ("Rutland County Council", None, None),
    ("N/A", None, None),
    ("", None, None),
]


def test_rules(spark):
    base = sorted({c for _, c, _ in RULE_CASES if c}) + ["Leicester City Council"]
    got = {r.name: (r.match, r.rule) for r in
           RuleMatcher()(names(spark, [n for n, _, _ in RULE_CASES]), cands(spark, base)).collect()}
    assert got == {n: (c, r) for n, c, r in RULE_CASES if c}


def test_ambiguous_hit_is_no_hit(spark):
    got = RuleMatcher(("suffix",))(names(spark, ["Acme"]), cands(spark, ["Acme Ltd", "Acme PLC"]))
    assert got.count() == 0
    # the asked name is not on offer itself, so the other member of its group is the hit
    got = RuleMatcher(("suffix",))(names(spark, ["Acme Ltd"]), cands(spark, ["Acme Ltd", "Acme PLC"]))
    assert found(got) == {"Acme Ltd": "Acme PLC"}


def test_aliases_and_unknown_rule(spark):
    al = spark.createDataFrame([("tax office", "HM Revenue and Customs"), ("Old Co", "Gone Ltd")], "alias string, candidate string")
    got = RuleMatcher(aliases=al)(names(spark, ["Tax Office", "Old Co"]), cands(spark, ["HM Revenue and Customs"]))
    assert found(got) == {"Tax Office": "HM Revenue and Customs"}
    with pytest.raises(ValueError):
        RuleMatcher(("magic",))(names(spark, ["a"]), cands(spark, ["b"]))


def test_cascade_rules_then_similarity(spark):
    got = CascadeMatcher()(names(spark, ["DWP", "Home Ofice", "Nobody"]),
                           cands(spark, ["Home Office", "Department for Work and Pensions"]))
    assert {r.name: (r.match, r.rule) for r in got.collect()} == {
        "DWP": ("Department for Work and Pensions", "acronym"), "Home Ofice": ("Home Office", "ratio")}


def test_descriptor_equals_brute_force(spark):
    rnd = random.Random(3)
    words = "a1 b2 c3 d4 e5 f6".split()
    base = sorted({" ".join(sorted(set(rnd.choices(words, k=rnd.randint(1, 3))))) for _ in range(20)})
    asked = sorted({" ".join(sorted(set(rnd.choices(words, k=4)))) for _ in range(40)})
    want = {}
    for n in asked:
        fits = [c for c in base if set(c.split()) < set(n.split())]
        top = [c for c in fits if len(c.split()) == max(len(f.split()) for f in fits)]
        if len(top) == 1:
            want[n] = top[0]
    assert found(RuleMatcher(("descriptor",))(names(spark, asked), cands(spark, base))) == want


def test_user_matcher_with_map_in_pandas(spark):
    def service(inputs, candidates):
        def call(batches):
            for b in batches:
                yield b.assign(match=b["name"].str.title(), score=1.0, rule="service")
        return inputs.select("name").mapInPandas(call, "name string, match string, score double, rule string")

    step = CascadeMatcher((RuleMatcher(), service))
    assert found(step(names(spark, ["home office"]), cands(spark, ["X"]))) == {"home office": "Home Office"}


def chain_of(spark, links, offered, asked):
    aliases = spark.createDataFrame(links, "alias string, candidate string")
    return found(RuleMatcher(("alias_chain",), aliases)(names(spark, asked), cands(spark, offered)))


def test_alias_chains_of_any_length(spark):
    long = [(f"step {i}", f"Step: {i + 1}") for i in range(40)] + [("STEP 40", "The End")]
    got = chain_of(spark, long, ["The End", "step 99"], ["step 0", "Step 17", "step 40", "step 41"])
    assert got == {"step 0": "The End", "Step 17": "The End", "step 40": "The End"}


def test_alias_cycles_and_ambiguous_ends(spark):
    links = [
        ("a", "b"), ("b", "a"),                                    # a cycle without exit
        ("c", "d"), ("d", "e"), ("e", "c"), ("e", "Goal"),         # a cycle with one exit
        ("f", "g"), ("g", "Goal"), ("g", "h"), ("h", "Other"),     # two ends
        ("i", "j"), ("i", "k"), ("j", "Goal"), ("k", "GOAL!"),     # two ways to one end
        ("l", "m"),                                                # a dead end
        ("n", "Stop"), ("Stop", "Goal"),                           # a name on offer ends the chain
        ("self", "self"), ("o", "o2"), ("o2", "o"), ("o2", None), (None, "Goal"), ("", "Goal"),
    ]
    offered = ["Goal", "Other", "Stop"]
    asked = [x for x in "abcdefghijklmno"] + ["self", "Stop", "Goal", ""]
    assert chain_of(spark, links, offered, asked) == {
        "c": "Goal", "d": "Goal", "e": "Goal", "h": "Other", "i": "Goal", "j": "Goal", "k": "Goal", "n": "Stop", "Stop": "Goal"}
    # two names on offer that differ in case only
    assert chain_of(spark, [("x", "y"), ("y", "goal")], ["Goal", "GOAL"], ["x", "y"]) == {}
    assert chain_of(spark, [], offered, asked) == {}


def test_alias_chains_equal_a_plain_search(spark):
    rnd = random.Random(11)
    nodes = [f"n{i}" for i in range(60)]
    links = sorted({(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(75)})
    offered = nodes[:8]
    want = {}
    for n in nodes:
        seen, todo = set(), [c for a, c in links if a == n and c != n]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                if x not in offered:
                    todo += [c for a, c in links if a == x and c != x]
        ends = seen & set(offered)
        if len(ends) == 1 and ends != {n}:
            want[n] = ends.pop()
    assert len(want) > 5 and chain_of(spark, links, offered, nodes) == want


def test_a_word_of_all_names_is_the_work_of_many_tasks(spark):
    rnd = random.Random(12)
    pool = ["council", "north", "south", "east", "west", "city", "park"]
    base = sorted({" ".join(["council", *rnd.sample(pool[1:], rnd.randint(0, 3))]) for _ in range(200)})
    asked = sorted({" ".join(rnd.sample(pool, rnd.randint(2, 6))) for _ in range(120)})
    c, a = names(spark, asked), cands(spark, base)

    def hits(rows):
        return {(r.name, r.match) for r in _descriptor_hits(c, a, rows).collect()}

    want = set()
    for n in asked:
        fit = [x for x in base if set(x.split()) < set(n.split())]
        top = [x for x in fit if len(x.split()) == max(len(y.split()) for y in fit)]
        if len(top) == 1:
            want.add((n, top[0]))
    assert want and hits(10**6) == want == hits(5)
    one = spark.createDataFrame([("council", x) for x in base], "word string, candidate string")
    other = spark.createDataFrame([("council", x) for x in asked], "word string, name string")
    left, right = word_cells(one, other, block_rows=10)
    cells = left.join(right, ["word", "_part", "_copy"]).groupBy("_part", "_copy").count().collect()
    assert sum(r["count"] for r in cells) == len(base) * len(asked)
    assert len(cells) > 20 and max(r["count"] for r in cells) < len(base) * len(asked) / 10
