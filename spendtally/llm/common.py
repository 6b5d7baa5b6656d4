"""Helpers shared by the operators: words, hashes, folds, lineage cuts."""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import checkpoint_folder, shared_checkpoint

#: The six ASCII blanks that separate words, as a regular expression class.
BLANKS = r"[\x20\x09-\x0D]"
MAX_LONG = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    inner = F.regexp_replace(text, f"^{BLANKS}+", "")
    inner = F.rtrim(inner, F.lit(" \t\n\x0b\x0c\r"))
    n = F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, f"{BLANKS}+", -1)))
    return F.coalesce(n, F.lit(0)).cast("long")


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    return shared_checkpoint(df)


def shared_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder, not yet made, beside the session's checkpoints."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours on whatever store it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def plain_id(doc_id: Column) -> list[Column]:
    """An id for pandas, which has no null longs: ``id`` (0 for null) and ``has_id``."""
    return [F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")).alias("id"), doc_id.isNotNull().alias("has_id")]


def whole_id() -> Column:
    """The id from the columns of ``plain_id``."""
    return F.when(F.col("has_id"), F.col("id")).alias("doc_id")


def keep_columns(df: DataFrame, added: list[str]) -> list[str]:
    """Columns of ``df`` that stay beside ``added`` ones; an added column replaces its namesake."""
    taken = {c.lower() for c in added}
    return [c for c in df.columns if c.lower() not in taken]


class WordHashes(dict):
    """64-bit hash of a word (bytes), kept for the words met last."""

    LIMIT = 1_000_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def hashed_words(text: str | None, known: WordHashes, lower: bool = True) -> np.ndarray:
    """Hashes of the words of one text.  ``bytes.split`` and ``bytes.lower`` know ASCII blanks and A-Z only."""
    if not text:
        return np.empty(0, np.uint64)
    raw = text.encode("utf-8", "surrogatepass")
    parts = (raw.lower() if lower else raw).split()
    return np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a run of words from the hashes of its two parts."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words, in order; runs are put together from runs half as long."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, power, size = None, 0, words, 1
    while done < k:
        if k & size:
            part = power[done : done + n]
            out = part if out is None else _joined(out[:n], part)
            done += size
        if done < k:
            power = _joined(power[: len(power) - size], power[size:])
            size *= 2
    return mix64(out[:n])


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; a shorter text is one shingle, no words give none."""
    if 0 < len(words) < k:
        return shingle_hashes(words, len(words))
    return np.unique(shingle_hashes(words, k))
