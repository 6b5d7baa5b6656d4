"""Substring deduplication by relative Lempel-Ziv factors over windows of words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MAX_LONG, WordHashes, cut, hashed_words, plain_id, shingle_hashes, whole_id
from .graph import in_filter, key_filter, may_be_in, row_key

#: Words in a window, and in the anchors that index it.
WINDOW, ANCHOR = 20, 6
#: Words that are indexed at once.
CHUNK = 1 << 20
#: Windows that are sent at once.
BLOCK_WINDOWS = 1 << 17


class FewWordHashes(WordHashes):
    """A smaller table: tasks hold anchors and windows beside it."""

    LIMIT = 300_000


def anchors(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every anchor of a text, and for each window the place of its anchor.

    A window's anchor is the one with the smallest hash within it, the first of
    equals; so equal windows have equal anchors in equal places.
    """
    h = shingle_hashes(words, ANCHOR)
    span = WINDOW - ANCHOR + 1
    n = len(h) - span + 1
    if n <= 0:
        return h, np.empty(0, np.int64)
    # smallest value with its place, over spans that double until they cover the window
    low, at, width = h.copy(), np.arange(len(h)), 1
    while width < span:
        step = min(width, span - width)
        m = len(low) - step
        right = low[step:] < low[:m]
        at = np.where(right, at[step:], at[:m])
        low = np.where(right, low[step:], low[:m])
        width += step
    return h, at


def _anchor_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Anchors in use with a hash of the text that holds them, two if texts of a chunk share one."""
    known = FewWordHashes()

    def table(held, texts):
        h = np.concatenate(held)
        t = np.repeat(np.array(texts, np.int64), [len(x) for x in held])
        order = np.argsort(h)
        h, t = h[order], t[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.empty(0, np.int64)
        if len(first):
            low, high = np.minimum.reduceat(t, first), np.maximum.reduceat(t, first)
            h, two = h[first].view(np.int64), low != high
            yield pd.DataFrame({"anchor": np.concatenate((h, h[two])), "text_hash": np.concatenate((low, high[two]))})

    held, texts, size = [], [], 0
    for batch in batches:
        for text_hash, text in zip(batch["text_hash"], batch["text"]):
            words = hashed_words(text, known, lower=False)
            if len(words) >= WINDOW:
                h, at = anchors(words)
                held.append(h[np.unique(at)])
                texts.append(text_hash)
                size += len(words)
                if size >= CHUNK:
                    yield from table(held, texts)
                    held, texts, size = [], [], 0
    if held:
        yield from table(held, texts)


def _reference_blocks(low, high):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows of every shared anchor: one row per place of an anchor, window hashes in order (0: met before in the text).

        31 bits of the anchor go along: with a window's own 63 they tell all windows apart.
        """
        known = FewWordHashes()
        for batch in batches:
            out, held = [], 0
            for rank, key, text in zip(*(batch.column(c).to_pylist() for c in ("rank", "row_key", "text"))):
                words = hashed_words(text, known, lower=False)
                if len(words) < WINDOW:
                    continue
                h, at = anchors(words)
                shared = _shared(h[at].view(np.int64), low.value, high.value)
                if not shared.any():
                    continue
                windows = window_hashes(words)
                windows[repeated(windows)] = 0
                place = np.flatnonzero(shared)
                # a row ends where the anchor changes or a window is left out
                first = np.flatnonzero(np.concatenate(([True], (np.diff(at[place]) != 0) | (np.diff(place) != 1))))
                start = place[first]
                out.append((
                    (h[at[start]] >> np.uint64(33)).astype(np.int32), np.full(len(first), rank, np.int64), np.full(len(first), key, np.int64),
                    start.astype(np.int32), np.diff(np.append(first, len(place))), windows[place].view(np.int64)))
                held += len(place)
                if held >= BLOCK_WINDOWS:
                    yield _block_table(out)
                    out, held = [], 0
            if out:
                yield _block_table(out)

    return blocks


def _block_table(out: list) -> pa.RecordBatch:
    anchor, rank, key, start, sizes, windows = (np.concatenate(c) for c in zip(*out))
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    columns = {"anchor": anchor, "rank": rank, "row_key": key, "start": start, "windows": pa.ListArray.from_arrays(offsets, windows)}
    return pa.RecordBatch.from_pydict(columns)


def _shared(h: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    out = in_filter(low, h)
    out[out] = in_filter(high, (h[out].view(np.uint64) >> np.uint64(27)).view(np.int64))
    return out


def repeated(windows: np.ndarray) -> np.ndarray:
    """Which windows also begin earlier in the same text."""
    out = np.zeros(len(windows), bool)
    ordered = np.sort(windows)
    if (ordered[1:] == ordered[:-1]).any():
        out[:] = True
        out[np.unique(windows, return_index=True)[1]] = False
    return out


def window_hashes(words: np.ndarray) -> np.ndarray:
    return shingle_hashes(words, WINDOW) | np.uint64(1)


def factors(found: np.ndarray) -> list[tuple[int, int]]:
    """Greedy parse: (first word, number of words) of each factor of at least WINDOW words.

    ``found[i]`` tells whether the reference holds the window that begins at word i.
    A factor goes on as long as the next window is found too; windows across the
    end of one factor and the start of the next are looked up like all others, so
    neighbours overlap or touch and are joined.
    """
    edges = np.flatnonzero(np.diff(np.concatenate(([False], found, [False])).astype(np.int8)))
    out: list[tuple[int, int]] = []
    for a, b in zip(edges[::2], edges[1::2]):
        end = b - 1 + WINDOW
        if out and out[-1][0] + out[-1][1] >= a:
            out[-1] = (out[-1][0], end - out[-1][0])
        else:
            out.append((int(a), int(end - a)))
    return out


def _cut_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known = FewWordHashes()
    for batch in batches:
        rows = []
        for text, starts in zip(batch["text"], batch["starts"]):
            parts = text.encode("utf-8", "surrogatepass").split() if text else []
            spans: list[tuple[int, int]] = []
            if len(parts) >= WINDOW:
                if starts is not None and len(starts) and min(starts) < 0:
                    spans = [(0, len(parts))]
                else:
                    windows = window_hashes(np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts)))
                    found = repeated(windows)
                    if starts is not None and len(starts):
                        found |= np.isin(windows, windows[np.asarray(starts, np.int64)])
                    spans = factors(found)
            kept, at = [], 0
            for a, n in spans:
                kept += parts[at:a]
                at = a + n
            kept += parts[at:]
            rows.append((len(parts), len(parts) - len(kept), b" ".join(kept), [a for a, _ in spans], [n for _, n in spans]))
        n_words, n_removed, kept, first, length = zip(*rows) if rows else ((),) * 5
        yield pd.DataFrame({
            "id": batch["id"], "has_id": batch["has_id"], "n_words": n_words, "n_removed": n_removed,
            "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
            "kept_text": [k.decode("utf-8", "replace") if w else None for k, w in zip(kept, batch["wanted"])],
            "factor_start": first, "factor_words": length})


def remove_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, kept_text, factor_start, factor_words.

    A window of 20 words is a repeat if its words also begin earlier: in a document
    with a smaller id, or before it in the same one.  All words in repeats go; what
    is kept is joined by one blank.  Each document is parsed against reference blocks:
    the windows around an anchor, a content-chosen 6-word run, about one to eight
    words.  Anchors that only one text has are left out by two bitmaps (32 MB at
    most), all others are indexed with all their windows, in every document; the
    earliest holder of each window is found by a grouped minimum and joined back.

    Documents that share an id are not earlier than one another; null ids come last
    and count as one id.  Texts equal to that of a smaller id go as a whole without
    a look-up, if they have 20 words.  Null, empty and short texts keep all words.
    """
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit(MAX_LONG))
    text_hash = F.xxhash64("text")
    texts = docs.filter(F.length("text") >= 2 * WINDOW - 1)
    # 48 bits tell the few texts that share an anchor apart, and make the largest shuffle smaller
    found = texts.select(F.shiftrightunsigned(text_hash, 16).alias("text_hash"), "text").mapInPandas(_anchor_texts, "anchor long, text_hash long")
    # a task sends an anchor twice per chunk at most, so rows go as they are
    found = found.repartition("anchor").groupBy("anchor").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high"))
    found = cut(found.filter("low != high").select("anchor", F.shiftrightunsigned("anchor", 27).alias("upper")))
    sc = docs.sparkSession.sparkContext
    low, high = sc.broadcast(key_filter(found, "anchor")), sc.broadcast(key_filter(found, "upper"))

    rows = texts.select(rank.alias("rank"), row_key().alias("row_key"), "text")
    blocks = cut(rows.mapInArrow(_reference_blocks(low, high), "anchor int, rank long, row_key long, start int, windows array<long>"))
    windows = blocks.select("anchor", "rank", "row_key", "start", F.posexplode("windows").alias("i", "window")).filter("window != 0")
    # windows of one document alone need no look-up; what is left is cut off, so that a window in very many texts is split at run time
    earliest = windows.groupBy("anchor", "window").agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
    earliest = cut(earliest.filter("first < last").drop("last"))
    repeats = windows.join(earliest, ["anchor", "window"]).filter("rank > first").select("row_key", (F.col("start") + F.col("i")).alias("start"))

    digest = texts.select(rank.alias("rank"), row_key().alias("row_key"), text_hash.alias("h"), F.crc32(F.col("text").cast("binary")).alias("crc"),
                          F.length("text").alias("n"))
    same = digest.groupBy("h", "crc", "n").agg(F.min("rank").alias("first"), F.max("rank").alias("last")).filter("first < last")
    copies = digest.join(same, ["h", "crc", "n"]).filter("rank > first").select("row_key", F.lit(-1).alias("start"))
    marks = cut(repeats.union(copies).groupBy("row_key").agg(F.collect_set("start").alias("starts")))
    # only texts that may have a mark are moved to it; the others are parsed where they are read
    marked = may_be_in(sc.broadcast(key_filter(marks, "row_key")))("row_key")
    rows = docs.select(*plain_id(F.col("doc_id")), row_key().alias("row_key"), "text", F.lit(with_text).alias("wanted"))
    shown = ["id", "has_id", "text", "starts", "wanted"]
    schema = ("id long, has_id boolean, n_words long, n_removed long, kept_sha256 string, kept_text string, "
              "factor_start array<int>, factor_words array<int>")
    met = rows.filter(marked).join(marks, "row_key", "left").select(shown)
    alone = rows.filter(~marked).withColumn("starts", F.lit(None).cast("array<int>")).select(shown)
    out = met.mapInPandas(_cut_texts, schema).union(alone.mapInPandas(_cut_texts, schema))
    return out.select(whole_id(), *[c for c in out.columns if c not in ("id", "has_id")])


def substring_digest(documents: DataFrame) -> DataFrame:
    return remove_repeats(documents, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


#: The same result in DuckDB, over the windows themselves.
SUBSTRING_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents
), s AS (
  SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i, ws FROM w
), g AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(ws[i:i + 19], ' ') ORDER BY doc_id, i) AS r FROM s
), gone AS (
  SELECT doc_id, list(i) AS starts FROM g WHERE r > 1 GROUP BY doc_id
), c AS (
  SELECT doc_id, list(DISTINCT k) AS ks FROM (SELECT doc_id, unnest(starts) AS i FROM gone) , (SELECT unnest(range(0, 20)) AS o), LATERAL (SELECT i + o AS k)
  GROUP BY doc_id
), p AS (
  SELECT w.doc_id, len(ws) AS n, coalesce(len(ks), 0) AS n_removed, ws, coalesce(ks, []) AS ks FROM w LEFT JOIN c USING (doc_id)
), u AS (
  SELECT doc_id, n, n_removed, unnest(range(1, n + 1)) AS k, ws FROM p
), kept AS (
  SELECT u.doc_id, string_agg(ws[k], ' ' ORDER BY k) AS t FROM u LEFT JOIN (SELECT doc_id, unnest(ks) AS k FROM p) x USING (doc_id, k)
  WHERE x.k IS NULL GROUP BY u.doc_id
)
SELECT p.doc_id, CAST(p.n AS BIGINT) AS n_words, CAST(p.n_removed AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM p LEFT JOIN kept USING (doc_id)
"""
