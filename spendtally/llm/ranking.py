"""Ranked lexical search: one automaton of all item terms reads every document; the documents are never indexed."""

from __future__ import annotations

import math
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, plain_id, whole_id

LIMIT = 50
#: Items are dealt into blocks of about so many items and bytes of terms; a block's automaton is broadcast.
BLOCK_ITEMS, BLOCK_BYTES = 4_000, 2 << 20
#: Scores of (document, item) held at once while a batch is scored.
CELLS = 1 << 21
#: The best rows of an item meet in so many parts before they meet in one.
MEETING_PARTS = 64

_GUARD = 0x20
#: ASCII letters and digits stay (A-Z lower-cased), other ASCII becomes the guard, bytes of other characters stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else _GUARD for b in range(256))


def guarded(text: bytes | None) -> str:
    """The text's terms with a guard at both ends of each, one character a byte."""
    return (b" " + (text or b"").translate(_FOLD) + b" ").decode("latin-1")


def term_count(guarded_text: str) -> int:
    inside = np.frombuffer(guarded_text.encode("latin-1"), np.uint8) != _GUARD
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, has, terms = [], [], []
        for i, h, text in zip(*(batch.column(c).to_pylist() for c in ("id", "has_id", "text"))):
            own = set(guarded(text).split(" ")) - {""}
            ids += [i] * len(own)
            has += [h] * len(own)
            terms += [t.encode("latin-1") for t in own]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(has, pa.bool_()), pa.array(terms, pa.binary())], ["id", "has_id", "term"])


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term) of every item, once each; rows that share an id are one item."""
    rows = items.select(*plain_id(F.col("item_id")), F.col("text").cast("binary").alias("text"))
    found = rows.mapInArrow(_item_terms, "id long, has_id boolean, term binary")
    return found.select(whole_id().alias("item_id"), "term").distinct()


class _Block:
    """Items and terms of one block, numbered, with the items of each term."""

    def __init__(self, rows: pa.Table):
        self.item_ids = sorted(set(rows.column("item_id").to_pylist()), key=lambda i: (i is None, i or 0))
        self.terms = sorted(set(rows.column("term").to_pylist()))
        item_no = {i: k for k, i in enumerate(self.item_ids)}
        term_no = {t: k for k, t in enumerate(self.terms)}
        pairs = sorted((term_no[t], item_no[i]) for i, t in zip(rows.column("item_id").to_pylist(), rows.column("term").to_pylist()))
        self.items = np.array([p[1] for p in pairs], np.int64)
        self.starts = np.searchsorted(np.array([p[0] for p in pairs]), np.arange(len(self.terms) + 1))

    def automaton(self) -> ahocorasick.Automaton:
        """All terms, each between guards, so that a hit is a whole term of the text."""
        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, t in enumerate(self.terms):
            found.add_word(guarded(t), k)
        found.make_automaton()
        return found


def _scan(automaton):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sizes, terms, counts = [], [], [], []
            for row, text in enumerate(batch.column("text")):
                s = guarded(text.as_py())
                n = term_count(s)
                if n:
                    hits = np.fromiter(map(itemgetter(1), automaton.value.iter(s)), np.int32)
                    t, tf = np.unique(hits, return_counts=True)
                    keep.append(row)
                    sizes.append(n)
                    terms.append(t)
                    counts.append(tf)
            ends = pa.array(np.concatenate([[0], np.cumsum([len(t) for t in terms])]), pa.int32())
            lists = [
                pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, kind), *x]).astype(kind)))
                for x, kind in ((terms, np.int32), (counts, np.int64))
            ]
            at = pa.array(keep, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("has_id").take(at), pa.array(sizes, pa.int64()), *lists],
                ["id", "has_id", "n", "terms", "tf"])

    return scan


class _Best:
    """The highest-scoring documents of each item; equal scores by id, null ids last."""

    def __init__(self, n_items: int, limit: int):
        self.limit = limit
        self.floor = np.ones(n_items, np.int64)
        # item, score, no id, id
        self.rows = [np.empty(0, np.int64)] * 4

    def add(self, scores: np.ndarray, no_id: np.ndarray, ids: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.floor)
        new = (item, scores[doc, item], no_id[doc], ids[doc])
        rows = [np.concatenate(p) for p in zip(self.rows, new)]
        order = np.lexsort((rows[3], rows[2], -rows[1], rows[0]))
        items = rows[0][order]
        first = np.searchsorted(items, items)
        order = order[np.arange(len(items)) - first < self.limit]
        self.rows = [r[order] for r in rows]
        # below the last of a full list nothing can enter; an equal score may, by its id
        items, n = np.unique(self.rows[0], return_counts=True)
        last = np.cumsum(n) - 1
        self.floor[items[n == self.limit]] = self.rows[1][last[n == self.limit]]


def _rank(block, weights, n_docs: int, n_terms: int, limit: int):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, w = block.value, weights.value
        width = len(b.item_ids)
        fan = np.diff(b.starts)
        best = _Best(width, limit)
        for batch in batches:
            n = batch.column("n").to_pylist()
            # whole numbers of any length, so that no product overflows
            m = np.array([50 + 50 * x * n_docs // n_terms for x in n], np.int64)
            ids, no_id = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "has_id"))
            no_id = (~no_id.astype(bool)).astype(np.int64)
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            terms = batch.column("terms").flatten().to_numpy()
            tf = batch.column("tf").flatten().to_numpy()
            doc = np.repeat(np.arange(len(n)), sizes)
            part = w[terms] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            work = np.concatenate([[0], np.cumsum(fan[terms])])[ends]
            start = 0
            while start < len(n):
                # as many documents as the cells and the term hits allow, one at least
                stop = int(np.searchsorted(work, work[start] + CELLS, "right")) - 1
                stop = max(start + 1, min(stop, len(n), start + max(1, CELLS // width)))
                some = slice(ends[start], ends[stop])
                t, many = terms[some], fan[terms[some]]
                entry = np.repeat(np.arange(len(t)), many)
                inner = np.arange(len(entry)) - np.repeat(np.cumsum(many) - many, many)
                cell = (doc[some][entry] - start) * width + b.items[b.starts[t][entry] + inner]
                add, shape = part[some][entry], (stop - start) * width
                # bincount adds in doubles, so high and low halves are added apart
                total = np.bincount(cell, add >> 24, shape).astype(np.int64) * (1 << 24) + np.bincount(cell, add & 0xFFFFFF, shape).astype(np.int64)
                best.add(total.reshape(stop - start, width), no_id[start:stop], ids[start:stop])
                start = stop
        item, score, no_id, ids = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array([b.item_ids[i] for i in item], pa.int64()), pa.array(ids, pa.int64()), pa.array(no_id == 0), pa.array(score, pa.int64())],
            ["item_id", "id", "has_id", "score"])

    return rank


def _top(rows: DataFrame, limit: int, *salt: Column) -> DataFrame:
    w = Window.partitionBy("item_id", *salt).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def rank_documents(
    docs: DataFrame, items: DataFrame, limit: int = LIMIT, block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The ``limit`` documents that score highest for each item: item_id, rank, doc_id, score.

    ``docs(doc_id, text)``, ``items(item_id, text)``; further columns are not read.
    Terms are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.

    Items are dealt into blocks of bounded size.  The terms of a block form an
    Aho-Corasick automaton with a guard at both ends of each term; it is broadcast
    and reads every whole text once, which gives the term frequencies without any
    index of documents.  What it finds is written to the checkpoint folder, as
    documents with term numbers and counts; document frequencies come from there.
    Scores are sums over the automaton's outputs mapped to items; a task keeps the
    best ``limit`` of each item, and only those are shuffled, in two steps.

    A block holds about ``block_items`` items and ``block_bytes`` bytes of terms; one
    longer item is a block with it.  Rows that share an item_id, null included, are
    one item with all their terms.  Every row of ``docs`` is a document, so a
    repeated row may take several ranks; equal scores go by ascending doc_id, null
    ids last.  Null, empty and termless texts are no documents, termless items get
    no rows, and an empty table gives none.
    """
    terms = cut(item_terms(items))
    held = terms.agg(F.count_distinct(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("n"), F.sum(F.octet_length("term") + 2).alias("b")).first()
    blocks = max(-(-held["n"] // block_items), -(-(held["b"] or 0) // block_bytes))
    rows = docs.select(*plain_id(F.col("doc_id")), F.col("text").cast("binary").alias("text"))
    sc = docs.sparkSession.sparkContext
    found = None
    for k in range(blocks):
        mine = terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).toArrow()
        if not mine.num_rows:
            continue
        block = _Block(mine)
        hits = cut(rows.mapInArrow(_scan(sc.broadcast(block.automaton())), "id long, has_id boolean, n long, terms array<int>, tf array<long>"))
        corpus = hits.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
        if not corpus["n"]:
            break
        # at most one row for each term of the block
        df = hits.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toArrow()
        weights = np.zeros(len(block.terms), np.int64)
        weights[df.column("t").to_numpy()] = [
            math.floor(1000 * math.log((2 * corpus["n"] + 2) / (2 * x + 1))) for x in df.column("df").to_pylist()]
        best = hits.mapInArrow(
            _rank(sc.broadcast(block), sc.broadcast(weights), corpus["n"], corpus["l"], limit), "item_id long, id long, has_id boolean, score long")
        found = best if found is None else found.union(best)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    parts = found.select("item_id", whole_id(), "score", F.pmod(F.spark_partition_id(), F.lit(MEETING_PARTS)).alias("part"))
    return _top(_top(parts, limit, F.col("part")), limit).select("item_id", "rank", "doc_id", "score")


#: The same result in DuckDB, by grouping all terms of the documents.
RANKED_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents
), size AS (SELECT r, doc_id, len(ts) AS n FROM d WHERE len(ts) > 0),
g AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM size),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark
), tf AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t
), w AS (
  SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), g
), part AS (
  SELECT tf.r, doc_id, tf.t, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))) AS c
  FROM tf JOIN w USING (t) JOIN size USING (r), g
), score AS (
  SELECT item_id, r, doc_id, sum(c)::BIGINT AS score FROM part JOIN q USING (t) GROUP BY item_id, r, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM score WHERE score > 0
QUALIFY rank <= 50
"""
