"""Benchmark decontamination: size-partitioned MinHash containment, exact shingle confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, cut, hashed_words, keep_columns, plain_id, shingle_hashes, shingle_set, whole_id
from .graph import in_filter, key_filter, row_key

SHINGLE_WORDS = 5
#: Least share of an item's shingles within one document, in percent.
PERCENT = 80


def sketch_length(n_shingles: int, percent: int = PERCENT) -> int:
    """Samples kept of an item: enough for the largest item of its size class (powers of two).

    A document that holds ``percent`` of a set lacks at most (100 - percent) of it;
    one sample more than that cannot be missing altogether.
    """
    largest = 1 << max(0, int(n_shingles - 1).bit_length())
    return largest * (100 - percent) // 100 + 1


def _item_shingles(shingle_words: int, percent: int):
    def shingles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            for item, has, text in zip(batch["id"], batch["has_id"], batch["text"]):
                words = hashed_words(text, known)
                s = shingle_set(words, shingle_words)
                if len(s):
                    # the smallest hashes of a set are its MinHash samples
                    sampled = np.arange(len(s)) < sketch_length(len(s), percent)
                    whole = np.bitwise_xor.reduce(s * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)
                    yield pd.DataFrame({"id": item, "has_id": has, "k": min(len(words), shingle_words), "n_item": len(s),
                                        "whole": whole, "h": s.view(np.int64), "sampled": sampled})

    return shingles


def item_index(benchmark: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(whole, item_id, k, n_item, h, sampled): the ``k``-word shingles of every distinct item set, under its smallest id."""
    rows = benchmark.select(*plain_id(F.col("item_id")), "text")
    found = rows.mapInPandas(_item_shingles(shingle_words, percent), "id long, has_id boolean, k int, n_item long, whole long, h long, sampled boolean")
    found = found.select(whole_id().alias("item_id"), "k", "n_item", "whole", "h", "sampled")
    return found.groupBy("whole", "k", "n_item", "h").agg(F.min("item_id").alias("item_id"), F.max("sampled").alias("sampled"))


def _document_hits(lengths: list[int], samples, every):
    def hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            found = []
            for doc, has, key, text in zip(batch["id"], batch["has_id"], batch["row_key"], batch["text"]):
                words = hashed_words(text, known)
                s = np.concatenate([shingle_hashes(words, k) for k in lengths])
                if in_filter(samples.value, s).any():
                    s = np.unique(s[in_filter(every.value, s)])
                    found.append((doc, has, key, s.view(np.int64)))
            if found:
                n = [len(f[3]) for f in found]
                doc, has, key = (np.repeat([f[i] for f in found], n) for i in range(3))
                yield pd.DataFrame({"id": doc, "has_id": has, "row_key": key, "h": np.concatenate([f[3] for f in found])})

    return hits


def contained_items(docs: DataFrame, benchmark: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Pairs of a document and a test item that it holds: doc_id, row_key, item_id, n_item, n_shared, containment.

    An item is held if at least ``percent`` of its distinct ``shingle_words``-word
    shingles (lower-cased) occur in the document; an item of fewer words is one
    shingle of its own length, and looked up at that length in every document.
    Items fall into size classes, and a class fixes how many MinHash samples
    (smallest hashes) an item keeps, so that no document that holds it can lack them
    all.  A document is looked at if it may have a sample of some item; then its
    shingles meet those of the items in a join and are counted exactly.  Bitmaps of
    at most 16 MB go before the join, which is an ordinary one however many items
    there are.

    Items with equal shingles are one, with the smallest id, which is null if none
    has one; items without words are left out; null or empty texts hold none.  Rows
    equal in id and text give one pair.
    """
    index = cut(item_index(benchmark, shingle_words, percent))
    sc = docs.sparkSession.sparkContext
    lengths = sorted(r.k for r in index.select("k").distinct().collect()) or [shingle_words]  # at most shingle_words rows
    every = sc.broadcast(key_filter(index.select("h"), "h"))
    samples = sc.broadcast(key_filter(index.filter("sampled").select("h"), "h"))
    rows = docs.select(*plain_id(F.col("doc_id")), row_key().alias("row_key"), "text")
    hits = rows.mapInPandas(_document_hits(lengths, samples, every), "id long, has_id boolean, row_key long, h long")
    met = hits.select(whole_id(), "row_key", "h").join(index, "h")
    # equal rows give the same hits again
    item = ["doc_id", "row_key", "whole", "item_id", "n_item"]
    met = met.groupBy(*item, "h").agg(F.max("sampled").alias("sampled"))
    shared = met.groupBy(*item).agg(F.count("*").alias("n_shared"), F.max("sampled").alias("sampled"))
    held = shared.filter(F.col("sampled") & (F.col("n_shared") * 100 >= F.col("n_item") * percent))
    return held.select("doc_id", "row_key", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with their columns."""
    bad = contained_items(docs, benchmark, shingle_words, percent).select(F.col("row_key").alias("_key")).distinct()
    names = keep_columns(docs, [])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), row_key().alias("_key"))
    return rows.join(bad, "_key", "left_anti").select(*[F.col(f"row.`{c}`") for c in names])


def contained_digest(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contained_items(documents, benchmark).drop("row_key")


#: The same result in DuckDB, by a join on the shingles themselves.
CONTAINED_SQL = r"""
WITH low AS (
  SELECT 'd' AS kind, row_number() OVER () AS r, doc_id AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), item_id, text FROM benchmark
), w AS (
  SELECT kind, r, id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws
  FROM low
), lengths AS (SELECT DISTINCT least(len(ws), 5) AS k FROM w WHERE kind = 'b' AND len(ws) > 0),
s AS (
  SELECT kind, r, id, k, unnest(list_distinct(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' ')))) AS sh
  FROM w, lengths WHERE len(ws) >= k AND (kind = 'd' OR k = least(len(ws), 5))
), items AS (
  SELECT min(id) AS id, min(r) AS r FROM (SELECT r, id, k, list(sh ORDER BY sh) AS l FROM s WHERE kind = 'b' GROUP BY r, id, k) GROUP BY k, l
), b AS (
  SELECT items.id, s.r, k, sh, count(*) OVER (PARTITION BY s.r) AS n_item FROM s JOIN items ON items.r = s.r WHERE kind = 'b'
)
SELECT d.id AS doc_id, b.id AS item_id, b.n_item, count(*) AS n_shared, count(*) / b.n_item AS containment
FROM s d JOIN b ON d.k = b.k AND d.sh = b.sh AND d.kind = 'd'
GROUP BY d.r, d.id, b.r, b.id, b.n_item HAVING 100 * count(*) >= 80 * b.n_item
"""
