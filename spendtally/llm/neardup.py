"""MinHash near-duplicates with odd sketches: banded candidates, parity bitmaps, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, cut, hashed_words, keep_columns, plain_id, shingle_set, whole_id
from .graph import components, in_filter, key_filter, row_key

BANDS, ROWS = 25, 5
SAMPLES = BANDS * ROWS
SKETCH_BITS = 512
#: A pair is confirmed on its full sets if its sketches tell a similarity of at least threshold - SLACK (over four standard errors).
SLACK = 0.16
#: Sets on either side of a block that one task compares.
BLOCK = 512
#: Shingles that are sampled at once.
CHUNK = 1 << 16


def sampling_constants(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, 1 << 63, SAMPLES, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, SAMPLES, np.uint64)


def minhashes(flat: np.ndarray, starts: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash samples (sets x SAMPLES) of non-empty sets that lie one after the other in ``flat``."""
    out = np.empty((len(starts), len(factors)), np.uint64)
    for i, (a, b) in enumerate(zip(factors, offsets)):
        out[:, i] = np.minimum.reduceat(flat * a + b, starts)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One 64-bit key per set and band."""
    out = np.empty((len(samples), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(samples), band + 1, np.uint64)
        for row in range(ROWS):
            key = (key ^ samples[:, band * ROWS + row]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        out[:, band] = key
    return out


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (sets x SKETCH_BITS / 64): sample i with its value turns over one bit."""
    place = np.arange(1, samples.shape[1] + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    x = (samples ^ place) * np.uint64(0xFF51AFD7ED558CCD)
    at = (x >> np.uint64(64 - 9)).astype(np.int64)
    out = np.zeros((len(samples), SKETCH_BITS // 64), np.uint64)
    rows = np.repeat(np.arange(len(samples)), samples.shape[1])
    np.bitwise_xor.at(out, (rows, (at >> 6).ravel()), np.uint64(1) << (at & 63).astype(np.uint64).ravel())
    return out


def odd_limit(similarity: float) -> int:
    """Most bits in which the odd sketches of two sets differ if their similarity is ``similarity``, as expected."""
    differing = 2 * SAMPLES * (1 - similarity)
    return int(SKETCH_BITS / 2 * (1 - np.exp(-2 * differing / SKETCH_BITS)))


def _sketch_sets(shingle_words: int):
    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        factors, offsets = sampling_constants()

        def table(ids, keys, sets):
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            sketches, bands = [None] * len(sets), [None] * len(sets)
            if len(full):
                starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
                samples = minhashes(np.concatenate([sets[i] for i in full]), starts, factors, offsets)
                for i, b, o in zip(full, band_keys(samples).view(np.int64), odd_sketches(samples).view(np.int64)):
                    bands[i], sketches[i] = b, o
            sig = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            return pd.DataFrame({"id": [i for i, _ in ids], "has_id": [h for _, h in ids], "row_key": keys, "n_shingles": sizes, "sig": sig, "bands": bands, "odd": sketches})

        for batch in batches:
            ids, keys, sets, held = [], [], [], 0
            for doc_id, has_id, key, text in zip(batch["id"], batch["has_id"], batch["row_key"], batch["text"]):
                s = shingle_set(hashed_words(text, known), shingle_words)
                ids.append((doc_id, has_id))
                keys.append(key)
                sets.append(s)
                held += len(s)
                if held >= CHUNK:
                    yield table(ids, keys, sets)
                    ids, keys, sets, held = [], [], [], 0
            if ids:
                yield table(ids, keys, sets)

    return sketch


def _full_sets(shingle_words: int, bitmap):
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            batch = batch[in_filter(bitmap.value, batch["row_key"].to_numpy())].drop_duplicates("row_key")
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                yield pd.DataFrame({"row_key": part["row_key"],
                                    "shingles": [shingle_set(hashed_words(t, known), shingle_words).tobytes() for t in part["text"]]})

    return sets


def _confirm(percent: int):
    def confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i, (x, y) in enumerate(zip(batch["set_a"], batch["set_b"])):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.loc[keep, ["a", "b"]]

    return confirm


def _block_links(percent: int, limit: int):
    def find(rows: pd.DataFrame) -> pd.DataFrame:
        outer, every = rows[rows["outer"]], rows[~rows["outer"]]
        out: list[tuple[int, int]] = []
        if not len(outer) or not len(every):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        parent = {r: r for r in rows["root"]}

        def top(r):
            while parent[r] != r:
                parent[r] = parent[parent[r]]
                r = parent[r]
            return r

        sets = [np.frombuffer(s, np.uint64) for s in every["shingles"]]
        sizes, sketches = every["n_shingles"].to_numpy(), np.stack(every["odd"].to_numpy()).view(np.uint64)
        nodes, roots = every["node"].to_numpy(), every["root"].to_numpy()
        for node, root, n, odd, own in zip(outer["node"], outer["root"], outer["n_shingles"], outer["odd"], outer["shingles"]):
            own = np.frombuffer(own, np.uint64)
            differ = np.bitwise_count(sketches ^ odd.view(np.uint64)).sum(axis=1)
            may = np.flatnonzero((differ <= limit) & (np.minimum(sizes, n) * 100 >= np.maximum(sizes, n) * percent))
            may, step = may[np.argsort(differ[may], kind="stable")], 4
            while len(may):
                here = top(root)
                may = may[[top(r) != here for r in roots[may]]]
                now, may, step = may[:step], may[step:], step * 4
                if not len(now):
                    break
                flat = np.concatenate([sets[k] for k in now])
                at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                both = np.add.reduceat((own[at] == flat).astype(np.int64), np.concatenate(([0], np.cumsum(sizes[now])[:-1])))
                for k in now[100 * both >= percent * (sizes[now] + n - both)]:
                    if top(roots[k]) != top(root):
                        parent[top(roots[k])] = top(root)
                        out.append((node, nodes[k]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return find


class _Search:
    """Links between distinct shingle sets; ``sets`` has node, row_key, n_shingles, bands, odd."""

    def __init__(self, docs: DataFrame, sets: DataFrame, shingle_words: int, percent: int):
        self.docs, self.sets, self.shingle_words, self.percent = docs, sets, shingle_words, percent
        self.limit = odd_limit(percent / 100 - SLACK)

    def similar(self, x: str, y: str):
        """Sizes and odd sketches of two rows allow the similarity."""
        differ = sum((F.bit_count(F.col(f"{x}.odd")[i].bitwiseXOR(F.col(f"{y}.odd")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
        n, m = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
        return (F.least(n, m) * 100 >= F.greatest(n, m) * self.percent) & (differ <= self.limit)

    def full_sets(self, nodes: DataFrame) -> DataFrame:
        """(node, shingles) of some nodes; texts are read again, and others are passed over by a bitmap of keys."""
        needed = cut(nodes.join(self.sets.select("node", "row_key"), "node"))
        bitmap = self.docs.sparkSession.sparkContext.broadcast(key_filter(needed, "row_key"))
        rows = self.docs.select(row_key().alias("row_key"), "text")
        sets = rows.mapInPandas(_full_sets(self.shingle_words, bitmap), "row_key long, shingles binary").dropDuplicates(["row_key"])
        return needed.join(sets, "row_key").select("node", "shingles")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) whose full sets are similar enough."""
        sets = self.full_sets(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct())
        a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
        b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
        return cut(pairs.join(a, "a").join(b, "b").mapInPandas(_confirm(self.percent), "a long, b long"))

    def links(self) -> DataFrame:
        """Links that join all sets which links of pairs with a shared band join.

        First every set meets the smallest node of each of its buckets.  Buckets that
        still hold several components are taken together by their largest component
        ("top"): all sets outside it meet all sets of these buckets, block by block.
        A block compares sketches, confirms the closest first, passes over what is
        joined already, and sends only links that join components.
        """
        bands = self.sets.select("node", F.explode("bands").alias("band"))
        leaders = bands.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1")
        shared = cut(bands.join(leaders, "band").select("band", "node", "leader"))
        info = self.sets.select("node", "n_shingles", "odd")
        x, y = info.alias("x"), info.alias("y")
        pairs = shared.filter("node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
        pairs = pairs.join(y, F.col("b") == F.col("y.node")).join(x, (F.col("a") == F.col("x.node")) & self.similar("x", "y"))
        links = self.confirmed(cut(pairs.select("a", "b")))

        roots = cut(components(links))
        members = shared.join(roots, "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
        sizes = members.groupBy("band", "root").agg(F.count("*").alias("n"))
        largest = sizes.groupBy("band").agg(F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("parts")).filter("parts > 1")
        left = members.join(largest.select("band", F.col("most.root").alias("top")), "band")
        left = cut(left.select("top", "node", "root").distinct())
        counts = left.groupBy("top").agg(F.count("*").alias("n"), F.count(F.when(F.col("root") != F.col("top"), 1)).alias("m"))
        blocks = counts.select("top", F.expr(f"(n - 1) div {BLOCK} + 1").alias("n_blocks"), F.expr(f"(m - 1) div {BLOCK} + 1").alias("m_blocks"))
        full = info.join(self.full_sets(left.select("node").distinct()), "node")
        rows = left.join(blocks, "top").join(full, "node")
        place = F.xxhash64("node")
        outer = rows.filter("root != top").select("*", F.pmod(place, "m_blocks").alias("i"), F.explode(F.expr("sequence(0L, n_blocks - 1)")).alias("j"), F.lit(True).alias("outer"))
        every = rows.select("*", F.explode(F.expr("sequence(0L, m_blocks - 1)")).alias("i"), F.pmod(place, "n_blocks").alias("j"), F.lit(False).alias("outer"))
        more = outer.unionByName(every).groupBy("top", "i", "j").applyInPandas(_block_links(self.percent, self.limit), "a long, b long")
        stars = roots.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        return stars.union(cut(more))


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, row_key, n_shingles, root, component_id.

    Two documents are linked if 100 * shared shingles >= percent * all shingles of
    the two; ``component_id`` is the smallest doc_id reachable by links.  Equal
    shingle sets are one node from the start, so copies are never paired.  MinHash
    samples in 25 bands of 5 find candidates (a pair at 0.8 is missed with a chance
    of 7e-5), 512-bit odd sketches of the 125 samples discard most that are not
    similar, and each link is confirmed on the full sets.

    A null, empty or blank text has no shingles and stays alone.  Null ids are never
    the smallest; a component of null ids only has a null component_id.  Rows may
    repeat.  ``root`` is null for a row that stays alone for want of words.
    """
    rows = docs.select(*plain_id(F.col("doc_id")), row_key().alias("row_key"), "text")
    schema = "id long, has_id boolean, row_key long, n_shingles long, sig binary, bands array<long>, odd array<long>"
    sketched = rows.mapInPandas(_sketch_sets(shingle_words), schema)
    sketched = cut(sketched.select(whole_id(), "row_key", "n_shingles", "sig", "bands", "odd"))
    sets = sketched.filter("sig is not null").dropDuplicates(["sig"]).drop("doc_id")
    sets = cut(sets.withColumn("node", F.monotonically_increasing_id()))
    found = cut(components(_Search(docs, sets, shingle_words, percent).links()))
    roots = sets.select("sig", "node").join(found, "node", "left").select("sig", F.coalesce("root", "node").alias("root"))
    labelled = cut(sketched.filter("sig is not null").select("doc_id", "row_key", "n_shingles", "sig").join(roots, "sig").drop("sig"))
    smallest = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    alone = sketched.filter("sig is null").select(
        "doc_id", "row_key", "n_shingles", F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("component_id"))
    return labelled.join(smallest, "root").select("doc_id", "row_key", "n_shingles", "root", "component_id").union(alone)


def keep_one(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest id; rows without words stay.

    Rows equal in id and text count as one group as well, unless they have no words.
    """
    found = cut(near_duplicates(docs, shingle_words, percent).filter("root is not null").select("doc_id", "row_key", "root"))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "row_key")).alias("first"))
    often = found.groupBy("row_key").agg(F.count("*").alias("n"))
    keys = cut(first.select(F.col("first.row_key").alias("row_key")).join(often, "row_key").select(F.col("row_key").alias("_key"), "n"))
    names = keep_columns(docs, [])
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), row_key().alias("_key"), "text")
    # the same blanks as the word rule, so that "no words" means the same here
    wordless = F.coalesce(F.col("text"), F.lit("")).rlike(r"^[\x20\x09-\x0D]*\z")
    once = marked.join(keys.filter("n = 1").select("_key"), "_key", "left_semi")
    again = marked.join(keys.filter("n > 1").select("_key"), "_key", "left_semi").dropDuplicates(["_key"])
    kept = once.select("row").union(again.select("row")).union(marked.filter(wordless).select("row"))
    return kept.select(*[F.col(f"row.`{c}`") for c in names])


def near_duplicate_digest(documents: DataFrame) -> DataFrame:
    """Components of whole documents by 2-word shingles at 0.8."""
    found = near_duplicates(documents, shingle_words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


#: The same result in DuckDB, by comparing every two documents that share a shingle.
NEAR_DUPLICATE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws
  FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) < 2 THEN ws ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END)) AS sh
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 80 * (min(na.n) + min(nb.n) - count(*))
), both_ways AS (
  SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM reach r JOIN both_ways e ON r.y = e.x
), c AS (
  SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
