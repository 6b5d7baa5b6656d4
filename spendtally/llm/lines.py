"""Line dedup: levelled sorted runs of line hashes; every batch of documents merge-joins the runs and adds its own."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, keep_columns, remove_folder, shared_folder

MIN_LENGTH = 20
MIN_DOCS = 3
#: Batches a table at hand is dealt into, and runs of a level that are compacted into one of the next.
BATCHES, FANOUT = 5, 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANKS = " \t\n\x0b\x0c\r"
KEY = ["h", "check"]


def _folded(key: Column) -> Column:
    # of pure ASCII, the plain lower case changes A-Z only and is much faster
    return F.when(F.octet_length(key) == F.length(key), F.lower(key)).otherwise(F.translate(key, _UPPER, _LOWER))


def text_lines(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_entries(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, text_hash, pos, h, check, first): the lines whose key is long enough, with 96 bits of key hash.

    A key is the line without ASCII blanks at its ends, A-Z lower-cased; ``first``
    marks one line of each key within a document.
    """
    bare = F.transform(text_lines(F.col("text")), lambda line: F.trim(line, F.lit(_BLANKS)))
    hashed = F.transform(F.transform(bare, _folded), lambda k, i: F.struct(
        F.when(F.length(k) >= min_length, F.xxhash64(k)).alias("h"), F.hash(k).alias("check"), i.alias("pos")))
    # equal keys of a document are neighbours after the sort
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.sort_array(F.filter(hashed, lambda e: e["h"].isNotNull())).alias("es"))
    before = lambda i: F.get("es", i - 1)
    marked = F.transform("es", lambda e, i: F.struct(
        "doc_id", "text_hash", e["pos"].alias("pos"), e["h"].alias("h"), e["check"].alias("check"),
        ((i == 0) | (before(i)["h"] != e["h"]) | (before(i)["check"] != e["check"])).alias("first")))
    return rows.select(F.inline(marked))


class LineRuns:
    """An index of line keys: sorted runs in levels, on the shared store.

    A run is a table dealt into buckets by key and sorted in each, so runs and a
    batch meet by merging buckets; only the batch is shuffled.  A row holds a key
    with ``docs`` and ``last`` (number and largest id of the documents of its
    batches) and ``seen``: whether an earlier run held the key when the row came.
    Rows not seen are the runs proper, and a key has one such row in all runs.
    ``fanout`` runs of a level are compacted into one of the next, their seen rows
    into a log with one row a key, and the old files deleted.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.fanout = fanout
        self.folder = shared_folder(spark, "line-runs")
        self.levels: list[list[tuple[str, DataFrame]]] = [[]]
        self.logs: list[DataFrame] = []

    def _write(self, rows: DataFrame) -> tuple[str, DataFrame]:
        """Path and rows of a new sorted table; the catalog forgets it at once, the files stay."""
        name = f"run_{uuid.uuid4().hex}"
        path = f"{self.folder}/{name}"
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).format("parquet").saveAsTable(name)
        table = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return path, table

    def _tables(self) -> list[DataFrame]:
        return [t for level in self.levels for _, t in level]

    def add(self, entries: DataFrame) -> None:
        """Merge one batch of ``line_entries`` with the runs and add it as a run; no document may come twice."""
        new = entries.filter("first").groupBy(*KEY).agg(F.count("*").alias("docs"), F.max("doc_id").alias("last"))
        marks = []
        for i, t in enumerate(self._tables()):
            marks.append(f"seen{i}")
            run = t.filter("not seen").select(*KEY, F.lit(True).alias(marks[-1]))
            new = new.join(run.hint("merge"), KEY, "left")
        seen = F.coalesce(*[F.col(m) for m in marks], F.lit(False))
        self.levels[0].append(self._write(new.select(*KEY, "docs", "last", seen.alias("seen"))))
        self._compact()

    def _compact(self) -> None:
        for i, level in enumerate(self.levels):
            if len(level) < self.fanout:
                return
            rows = _stacked([t for _, t in level])
            merged = self._write(rows.filter("not seen"))
            self.logs.append(self._write(_combined(rows.filter("seen")).withColumn("seen", F.lit(True)))[1])
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(merged)
            old, self.levels[i] = level, []
            for path, _ in old:
                remove_folder(self.spark, path)

    def frequent(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(h, check, last): keys found in at least ``min_docs`` documents so far."""
        rows = [t for t in self._tables()]
        again = _combined(_stacked([t.filter("seen") for t in rows + self.logs])).select(
            *KEY, F.col("docs").alias("more"), F.col("last").alias("later"))
        first = _stacked([t.filter("not seen") for t in rows])
        total = F.col("docs") + F.coalesce("more", F.lit(0))
        return first.join(again.hint("merge"), KEY, "left").filter(total >= min_docs).select(
            *KEY, F.greatest("last", "later").alias("last"))


def _stacked(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    return out


def _combined(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.max("last").alias("last"))


def drop_repeated_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_length: int = MIN_LENGTH, batches: int = BATCHES, fanout: int = FANOUT
) -> DataFrame:
    """``docs(doc_id, text)`` without the lines that many documents share; adds ``n_lines`` and ``n_dropped``.

    A key (see ``line_entries``) found in at least ``min_docs`` documents loses all
    its lines except in the largest doc_id that holds it.  The hashes of all lines
    are written to the shared store in ``batches`` by document, and go through
    ``LineRuns`` one batch after the other; then the lines meet the frequent keys,
    and every document its dropped places.  Key counts are combined before they are
    shuffled; a common line is a skewed key of a join with one row a key on the
    other side, which Spark splits at run time.

    Every row is a document, so repeated rows count each, and all rows of the
    largest id keep their lines.  A null id is smaller than any other: its lines go
    unless only null ids hold them.  A null text is an empty one and comes out
    empty.  Further columns stay; input columns named ``n_lines`` or ``n_dropped``
    are replaced.  Keys are told apart by 96 bits of hash, rows by id and 64 bits of
    their text.  An empty table gives no rows.  The index is built when the function
    is called; its files stay as long as the checkpoints do.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "line-entries")
    batch = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(batches)).cast("int")
    line_entries(docs, min_length).withColumn("batch", batch).write.partitionBy("batch").parquet(folder)
    schema = "doc_id long, text_hash long, pos int, h long, check int, first boolean, batch int"
    entries = spark.read.schema(schema).parquet(folder)
    index = LineRuns(spark, fanout=fanout)
    for b in range(batches):
        index.add(entries.filter(F.col("batch") == b))
    # cut off from its buckets, so that both sides are shuffled and a common line can be split
    met = entries.join(cut(index.frequent(min_docs)), KEY).filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    dropped = met.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.collect_set("pos").alias("_dropped"))
    names = keep_columns(docs, ["n_lines", "n_dropped", "text"])
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")
    rows = docs.select(row, F.col("doc_id").alias("_doc"), "text", F.xxhash64("text").alias("_text"))
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash"))
    n = F.size(text_lines(F.col("text")))
    # array_except of whole numbers is linear; the lines are bound to a variable, so that they are split once
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("_dropped"))
    left = F.transform(F.array(text_lines(F.col("text"))), lambda ls: F.array_join(F.transform(kept, lambda i: F.get(ls, i)), "\n"))
    text = F.when(F.col("_dropped").isNull(), F.coalesce("text", F.lit(""))).otherwise(left[0])
    n_dropped = F.when(F.col("_dropped").isNull(), 0).otherwise(F.size("_dropped"))
    out = {"n_lines": n.cast("long"), "n_dropped": n_dropped.cast("long"), "text": text}
    joined = rows.join(dropped, same, "left").select("_row", *[c.alias(f"_{k}") for k, c in out.items()])
    return joined.select(
        *[F.col("_text").alias(c) if c.lower() == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns
          if c.lower() not in ("n_lines", "n_dropped")],
        F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"))


def line_digest(documents: DataFrame) -> DataFrame:
    return drop_repeated_lines(documents.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: The same result in DuckDB, by grouping the keys themselves.
LINES_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT r, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3
), m AS (
  SELECT r, doc_id, line, pos, f.key IS NOT NULL AND doc_id IS DISTINCT FROM last AS dropped FROM k LEFT JOIN f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY r, doc_id
"""
