"""Language identification by bit-sliced Bloom filters of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import id_fold, mix64, plain_id, whole_id

#: Characters in an n-gram; a blank stands on either side of a word.
GRAMS = (2, 3, 4)
#: Counted n-grams fall into 2**COUNT_BITS places; a filter has 2**FILTER_BITS slots, each n-gram sets HASHES of them.
COUNT_BITS, FILTER_BITS, HASHES = 20, 22, 2
#: A language contains an n-gram whose share of its n-grams is at least RARE of the highest share, and at least FLOOR.
RARE, FLOOR = 0.25, 1e-6
#: Characters that are hashed at once; a piece of a longer text ends with a word.
CHUNK = 1 << 18
FOLDS, HELD_OUT = 4, 2
UNDECIDED = "und"


def gram_places(text: str) -> np.ndarray:
    """Place (0 to 2**COUNT_BITS - 1) of every n-gram of the letters of ``text``; no n-gram lies in two pieces."""
    out = []
    for piece in _pieces(text):
        piece = piece.lower()
        c = np.frombuffer(f" {piece} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = _letters(c)
        # all that is no letter is a blank, and a run of blanks is one
        c = np.where(letter, c, np.uint32(32))
        c = c[np.append(True, (c[1:] != 32) | (c[:-1] != 32))].astype(np.uint64)
        for k in GRAMS:
            n = len(c) - k + 1
            if n <= 0:
                continue
            h = np.full(n, k, np.uint64)
            for i in range(k):
                h = h * np.uint64(0x9E3779B97F4A7C15) + c[i : i + n]
            # the blank may begin or end an n-gram, but not stand within
            inner = np.ones(n, bool)
            for i in range(1, k - 1):
                inner &= c[i : i + n] != 32
            out.append((mix64(h[inner]) >> np.uint64(64 - COUNT_BITS)).astype(np.int64))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces of about CHUNK characters, cut where no word is."""
    start = 0
    while start < len(text):
        end = start + CHUNK
        while end < len(text) and text[end].isalpha():
            end += 1
        yield text[start:end]
        start = end


def _letters(codes: np.ndarray) -> np.ndarray:
    ascii_ = ((codes | 32) >= 97) & ((codes | 32) <= 122)
    wide = codes >= 128
    if wide.any():
        kinds = np.unique(codes[wide])
        ascii_ |= np.isin(codes, kinds[[chr(k).isalpha() for k in kinds]])
    return ascii_


def slots(places: np.ndarray) -> list[np.ndarray]:
    """The HASHES slots of n-gram places."""
    return [(mix64(places.astype(np.uint64) * np.uint64(2 * i + 1) + np.uint64(i + 1)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
            for i in range(HASHES)]


@dataclass
class Filters:
    """One Bloom filter a language, sliced by slot: bit l of ``planes[l // 64][slot]`` belongs to language l."""

    langs: list[str]
    planes: list[np.ndarray]
    #: Chance that an n-gram a language lacks passes its filter, and that one of its n-grams passes.
    false_rate: np.ndarray

    @classmethod
    def build(cls, langs: list[str], lang: np.ndarray, place: np.ndarray) -> "Filters":
        planes = [np.zeros(1 << FILTER_BITS, np.uint64) for _ in range(0, len(langs), 64)]
        rate = np.zeros(len(langs))
        for i in range(len(langs)):
            mine = place[lang == i]
            for s in slots(mine):
                planes[i // 64][s] |= np.uint64(1 << (i % 64))
            filled = np.count_nonzero(planes[i // 64] & np.uint64(1 << (i % 64))) / (1 << FILTER_BITS)
            rate[i] = filled**HASHES
        return cls(langs, planes, rate)

    def hits(self, places: np.ndarray) -> np.ndarray:
        """Expected number of n-grams that each language contains, false positives taken off."""
        n = len(places)
        found = np.zeros(len(self.langs))
        at = slots(places)
        for p, plane in enumerate(self.planes):
            mask = plane[at[0]]
            for s in at[1:]:
                mask &= plane[s]
            for i in range(p * 64, min(len(self.langs), p * 64 + 64)):
                found[i] = np.count_nonzero(mask & np.uint64(1 << (i - p * 64)))
        return np.maximum(found - n * self.false_rate, 0.0) / (1.0 - self.false_rate)

    def decide(self, text: str | None) -> tuple[str, float]:
        """The language with the most hits and its share of the two best; ties go to the smaller name."""
        places = gram_places(text) if text else np.empty(0, np.int64)
        if not self.langs or not len(places):
            return UNDECIDED, 0.0
        hits = self.hits(places)
        best = int(np.argmax(hits))
        if hits[best] <= 0:
            return self.langs[best], 0.0
        second = np.partition(hits, -2)[-2] if len(hits) > 1 else 0.0
        return self.langs[best], float(hits[best] / (hits[best] + second))


def _count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, np.ndarray] = {}
    # places of few languages are counted in full tables; with many, tables leave before memory fills
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            places = gram_places(text)
            if len(places):
                if lang not in held and len(held) >= 16:
                    yield from _tables(held)
                    held = {}
                t = held.setdefault(lang, np.zeros(1 << COUNT_BITS, np.int64))
                if len(places) > 1 << (COUNT_BITS - 3):
                    t += np.bincount(places, minlength=1 << COUNT_BITS)
                else:
                    np.add.at(t, places, 1)
    yield from _tables(held)


def _tables(held: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
    for lang, t in held.items():
        place = np.flatnonzero(t)
        yield pd.DataFrame({"lang": lang, "place": place, "n": t[place]})


def fit(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> Filters:
    """Filters from the texts of all documents outside the held-out fold that have a language.

    N-grams are counted per language over whole texts; a language contains those
    that are not much rarer in it than where they are most frequent.  The driver gets
    the filters' contents, at most 2**COUNT_BITS places a language.
    """
    known = docs.filter("text is not null and lang is not null").filter(id_fold(F.col("doc_id"), folds) != held_out).select("lang", "text")
    counts = known.mapInPandas(_count_grams, "lang string, place long, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    share = counts.join(totals, "lang").withColumn("share", F.col("n") / F.col("total"))
    highest = F.max("share").over(Window.partitionBy("place"))
    held = share.withColumn("highest", highest).filter((F.col("share") >= F.col("highest") * RARE) & (F.col("share") >= FLOOR))
    held = held.select("lang", "place").toArrow()
    names = held.column("lang").combine_chunks().dictionary_encode()
    if isinstance(names, pa.ChunkedArray):
        names = names.combine_chunks()
    values = names.dictionary.to_pylist()
    order = sorted(range(len(values)), key=lambda i: values[i])
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    lang = rank[names.indices.to_numpy(zero_copy_only=False)] if len(values) else np.empty(0, np.int64)
    return Filters.build([values[i] for i in order], lang, held.column("place").to_numpy())


def _predict(filters):
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        f = filters.value
        for batch in batches:
            found = [f.decide(t) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "has_id": batch["has_id"],
                                "lang_pred": [x for x, _ in found], "score": [y for _, y in found]})

    return predict


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, ``lang_pred`` and ``score`` of every row; ``und`` and 0 for a text without letters, empty or null."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    rows = docs.select(*plain_id(F.col("doc_id")), "text")
    found = rows.mapInPandas(_predict(shared), "id long, has_id boolean, lang_pred string, score double")
    return found.select(whole_id(), "lang_pred", "score")


def language_digest(documents: DataFrame) -> DataFrame:
    found = identify(documents, fit(documents))
    return found.select("doc_id", (id_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
