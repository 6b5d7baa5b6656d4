"""Information-theoretic sanitisation: base patterns, and terms that reveal a protected value by co-occurrence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, keep_columns

KINDS = ("email", "ip", "card", "phone", "term")
#: Each pattern finds the same matches as its plain form, but begins only where a run begins and gives nothing
#: back, so that a search of a text is linear and never recursive.  Cards are runs of 13 to 19 digits at once.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be worth a search.
SIGNS = {"email": r"@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}+", "phone": r"\+[0-9]"}
#: Characters on either side of a protected value whose words may reveal it.
CONTEXT = 60
#: A term reveals a value if its pointwise mutual information with it is at least so much of the value's own
#: information, and they meet at least SUPPORT times; from REMOVE on it is removed and not only generalised.
GENERALISE, REMOVE, SUPPORT = 0.8, 0.95, 3
#: A term: letters, at least three.
TERM = r"\p{L}{3,}+"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn check of a string of digits."""
    d = F.transform(F.split(F.reverse(digits), "(?<=.)(?=.)"), lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(
        x.cast("int") * 2 - F.when(x.cast("int") > 4, F.lit(9)).otherwise(F.lit(0))))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _found(kind: str, text: Column) -> Column:
    """Matches of one kind in order: what stands before each, the match, and what follows up to the next."""
    pattern = PATTERNS[kind]
    gaps, values = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # the text between two matches is cut to the context, its length is kept
    pieces = F.transform(values, lambda v, i: F.struct(
        v.alias("value"), F.length(F.get(gaps, i)).alias("gap"),
        F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after")))
    empty = F.array().cast("array<struct<value:string,gap:int,before:string,after:string>>")
    return F.when(text.rlike(SIGNS[kind]), pieces).otherwise(empty)


def base_spans(docs: DataFrame) -> DataFrame:
    """Valid base matches, a row each: place, kind_no, start, end, value, before, after.

    ``docs`` has place and text.  Places of matches are running sums of lengths in
    the order of the text, over rows, so that a text full of matches stays linear.
    """
    kinds = [F.struct(F.lit(n).alias("kind_no"), _found(kind, F.col("text")).alias("found")) for n, kind in enumerate(KINDS[:4])]
    some = F.col("text").rlike(r"@|\+[0-9]|[0-9][\x20.-]?[0-9]")
    rows = docs.filter(some).select("place", F.explode(F.array(*kinds)).alias("k")).select("place", "k.kind_no", F.posexplode("k.found").alias("i", "m"))
    so_far = Window.partitionBy("place", "kind_no").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("place", "kind_no", "i", "m.*").withColumn("end", F.sum(F.col("gap") + F.length("value")).over(so_far))
    rows = rows.withColumn("start", F.col("end") - F.length("value"))
    valid = F.lit(False)
    for n, kind in enumerate(KINDS[:4]):
        valid = F.when(F.col("kind_no") == n, _valid(kind, F.col("value"))).otherwise(valid)
    return rows.filter(valid).select("place", "kind_no", "start", "end", "value", "before", "after")


def context_terms(spans: DataFrame) -> DataFrame:
    """Terms beside each protected value: place, value, term (lower-cased), start, end; cut words at the edge are left out."""

    def words(text: Column, first: Column) -> Column:
        gaps, terms = F.split(text, TERM, -1), F.regexp_extract_all(text, F.lit(TERM), F.lit(0))

        def at(t, i):
            before = F.aggregate(F.slice(gaps, 1, i + 1), F.lit(0), lambda a, g: a + F.length(g))
            before = F.aggregate(F.slice(terms, 1, i), before, lambda a, x: a + F.length(x))
            return F.struct(F.lower(t).alias("term"), (first + before).alias("start"), (first + before + F.length(t)).alias("end"))

        return F.transform(terms, at)

    left = F.regexp_replace("before", r"^\p{L}++", "")
    whole_left = F.when(F.length("before") < CONTEXT, F.col("before")).otherwise(left)
    whole_right = F.when(F.length("after") < CONTEXT, F.col("after")).otherwise(F.regexp_replace("after", r"\p{L}++$", ""))
    found = F.concat(words(whole_left, F.col("start") - F.length(whole_left)), words(whole_right, F.col("end")))
    return spans.select("place", "value", F.col("start").alias("v_start"), F.explode(found).alias("w")).select(
        "place", "value", "v_start", "w.term", "w.start", "w.end")


def term_counts(docs: DataFrame) -> DataFrame:
    """Every term of the corpus with the number of times it occurs: term, n."""
    terms = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]++")).alias("term"))
    return terms.filter(F.length("term") >= 3).groupBy("term").agg(F.count("*").alias("n"))


def revealing_terms(beside: DataFrame, counts: DataFrame, mentions: DataFrame) -> DataFrame:
    """(value, term, disclosure) of terms that say too much about a protected value.

    disclosure = PMI(value; term) / information of the value, in the probabilities
    that co-occurrence gives: 1 if the term occurs beside the value only.
    """
    together = beside.select("value", "term", "place", "v_start").distinct().groupBy("value", "term").agg(F.count("*").alias("both"))
    together = together.filter(F.col("both") >= SUPPORT)
    total = counts.agg(F.sum("n").alias("total"))
    often = mentions.groupBy("value").agg(F.count("*").alias("n_value"))
    c = together.join(counts, "term").join(often, "value").join(F.broadcast(total))
    # a term between two mentions is beside both
    share = F.least(F.col("both") / F.col("n"), F.lit(1.0))
    own = F.log2(F.col("total") / F.col("n_value"))
    c = c.withColumn("disclosure", F.when(own > 0, (F.log2(share) + own) / own).otherwise(F.lit(0.0)))
    return c.filter(F.col("disclosure") >= GENERALISE).select("value", "term", "disclosure")


def may_hold(text: Column) -> Column:
    """False only for texts in which no base pattern is searched."""
    return text.rlike("|".join(f"(?:{sign})" for sign in SIGNS.values()))


def document_terms(docs: DataFrame) -> DataFrame:
    """The distinct terms of every document: place, term."""
    terms = F.transform(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), lambda t: F.lower(t))
    return docs.select("place", F.explode(F.array_distinct(terms)).alias("term"))


def _documents_of(rows: DataFrame, key: str) -> DataFrame:
    """(key, n, class): in how many documents each key stands, and one class for all keys that stand in the same ones."""
    found = rows.groupBy(key).agg(F.count("*").alias("n"), *[F.expr(f"bit_xor(xxhash64({k}, place))").alias(f"h{k}") for k in (1, 2)])
    return found.filter(F.col("n") >= SUPPORT).select(key, "n", F.struct("n", "h1", "h2").alias("class"))


def revealing_classes(docs: DataFrame, holds: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Which terms reveal which values if to meet is to be in one document, at any distance, by classes.

    Gives (place, v_class) of the values, (v_class, t_class, disclosure) and (term,
    t_class).  ``holds`` has the distinct (place, value).  All counts of a value and a
    term depend on the documents they stand in alone, so values of the same documents
    are one class, and so are terms: a document full of values and terms of its own,
    copied or not, makes few pairs.  A term in more documents than ``most`` cannot
    reveal the value even if it is in all of the value's, so leaving it out before
    pairs are made loses none.
    """
    total = F.broadcast(docs.agg(F.count("*").alias("total")))
    values = _documents_of(holds, "value").withColumnsRenamed({"class": "v_class", "n": "n_value"}).join(total)
    values = values.withColumn("most", F.col("n_value") * F.pow(F.col("total") / F.col("n_value"), F.lit(1 - GENERALISE)) + F.lit(0.5))
    most = values.agg(F.max("most").alias("limit"))
    terms = _documents_of(document_terms(docs), "term").withColumnRenamed("class", "t_class")
    terms = terms.join(F.broadcast(most), F.col("n") <= F.col("limit")).drop("limit")
    held = holds.join(values, "value").select("place", "v_class", "n_value", "total", "most").distinct()
    met = document_terms(docs.filter(may_hold(F.col("text")))).join(held.select("place").distinct(), "place", "left_semi").join(terms, "term")
    met = met.select("place", "t_class", "n").distinct().join(held, "place").filter("n <= most")
    c = met.groupBy("v_class", "t_class", "n", "n_value", "total").agg(F.count("*").alias("both")).filter(F.col("both") >= SUPPORT)
    own = F.log2(F.col("total") / F.col("n_value"))
    c = c.withColumn("disclosure", F.when(own > 0, (F.log2(F.col("both") / F.col("n")) + own) / own).otherwise(F.lit(0.0)))
    return held.select("place", "v_class"), c.filter(F.col("disclosure") >= GENERALISE).select("v_class", "t_class", "disclosure"), terms.select("term", "t_class")


def revealed_by_documents(docs: DataFrame, holds: DataFrame) -> DataFrame:
    """(place, term, disclosure): terms that reveal, by ``revealing_classes``, a value of the place's document."""
    held, revealing, terms = revealing_classes(docs, holds)
    revealing = cut(revealing)
    classes = held.join(revealing, "v_class").groupBy("place", "t_class").agg(F.max("disclosure").alias("disclosure"))
    wanted = terms.join(revealing.select("t_class").distinct(), "t_class", "left_semi")
    mine = document_terms(docs.filter(may_hold(F.col("text"))).join(classes.select("place").distinct(), "place", "left_semi"))
    return mine.join(wanted, "term").join(classes, ["place", "t_class"]).select("place", "term", "disclosure")


def occurrences(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Every occurrence of the ``wanted`` (place, term, disclosure): place, start, end, disclosure.

    Places are running sums of lengths over rows, as in ``base_spans``.
    """
    text = docs.filter(may_hold(F.col("text"))).join(wanted.select("place").distinct(), "place", "left_semi")
    gaps, terms = F.split("text", TERM, -1), F.regexp_extract_all("text", F.lit(TERM), F.lit(0))
    pieces = F.transform(terms, lambda t, i: F.struct(F.lower(t).alias("term"), F.length(t).alias("long"), F.length(F.get(gaps, i)).alias("gap")))
    so_far = Window.partitionBy("place").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = text.select("place", F.posexplode(pieces).alias("i", "t")).select("place", "i", "t.*")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("long")).over(so_far)).withColumn("start", F.col("end") - F.col("long"))
    return rows.join(wanted, ["place", "term"]).select("place", "start", "end", "disclosure")


def _outside(found: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows of ``found`` (place, start, end, disclosure) that overlap no span of their place.

    Both lie side by side in order of start, so each row looks at the furthest end
    before it and the next start after it only.
    """
    both = found.select("place", "start", "end", "disclosure").union(
        spans.select("place", F.col("start").cast("long"), F.col("end").cast("long"), F.lit(None).cast("double")))
    span = F.col("disclosure").isNull()
    forth = Window.partitionBy("place").orderBy("start", F.asc_nulls_first("disclosure")).rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("place").orderBy(F.desc("start"), F.desc_nulls_last("disclosure")).rowsBetween(Window.unboundedPreceding, -1)
    both = both.withColumns({"ended": F.max(F.when(span, F.col("end"))).over(forth), "begins": F.min(F.when(span, F.col("start"))).over(back)})
    free = (F.coalesce("ended", F.lit(0)) <= F.col("start")) & (F.coalesce("begins", F.col("end")) >= F.col("end"))
    return both.filter(~span & free).select("place", "start", "end", "disclosure")


def sensitive_spans(docs: DataFrame) -> DataFrame:
    """All spans: place, kind_no, start, end (code points, end exclusive), remove.

    ``docs`` has place and text.  Base spans of the four kinds stay as found; every
    occurrence of a term that reveals a value of the same document is added (kind
    ``term``), however far from the value.  What a term reveals is estimated over the
    whole corpus in two ways, and the larger counts: by mentions, with the terms of
    their context, and by documents, with all their terms.  Rows are told apart by
    place, so repeated rows and ids count each; a text of any length costs in
    proportion to it.
    """
    spans = cut(base_spans(docs))
    beside = cut(context_terms(spans))
    holds = cut(spans.select("place", "value").distinct())
    revealed = cut(revealing_terms(beside, term_counts(docs), spans))
    near = beside.join(revealed, ["value", "term"]).select("place", "start", "end", "disclosure")
    wanted = holds.join(revealed, "value").select("place", "term", "disclosure").union(revealed_by_documents(docs, holds))
    wanted = cut(wanted.groupBy("place", "term").agg(F.max("disclosure").alias("disclosure")))
    every = _outside(occurrences(docs, wanted), spans)
    added = near.union(every).groupBy("place", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    added = added.select("place", F.lit(4).alias("kind_no"), "start", "end", (F.col("disclosure") >= REMOVE).alias("remove"))
    return spans.select("place", "kind_no", "start", "end", F.lit(False).alias("remove")).union(added)


def _placed(documents: DataFrame) -> DataFrame:
    return documents.select(F.monotonically_increasing_id().alias("place"), F.coalesce("text", F.lit("")).alias("text"))


def _listed(spans: DataFrame) -> DataFrame:
    """Spans of each place in order: ``all``, an array of kind_no, start, end, remove."""
    s = F.struct("kind_no", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "remove")
    return spans.groupBy("place").agg(F.sort_array(F.collect_list(s)).alias("all"))


def sanitised(documents: DataFrame) -> DataFrame:
    """``documents`` with ``text`` made safe: base spans become ``<kind>``, revealing terms ``<term>`` or nothing.

    Overlapping spans are masked as one, by the kind that begins first.  A null text
    stays null; all rows and other columns stay.  Pass a table read from files or a
    checkpoint, so that rows keep their places.
    """
    rows = documents.select(F.monotonically_increasing_id().alias("place"), F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    names = F.array(*[F.lit(k) for k in KINDS])
    by_start = F.array_sort("all", lambda a, b: F.when(a["start"] != b["start"], (a["start"] - b["start"]).cast("int")).otherwise(a["kind_no"] - b["kind_no"]))
    text = F.col("row.text")

    def step(acc, s):
        begins = s["start"] >= acc["at"]
        label = F.when(s["remove"], F.lit("")).otherwise(F.concat(F.lit("<"), F.get(names, s["kind_no"]), F.lit(">")))
        piece = F.when(begins, F.concat(F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), label)).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], piece).alias("out"))

    done = F.aggregate(by_start, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), step)
    safe = F.when(F.col("all").isNull() | text.isNull(), text).otherwise(F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text))))
    out = rows.join(_listed(sensitive_spans(_placed(documents))), "place", "left").withColumn("safe", safe)
    kept = keep_columns(documents, [])
    return out.select(*[F.col("safe").alias("text") if c.lower() == "text" else F.col(f"row.`{c}`") for c in kept])


def sanitise_digest(documents: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans of every document; a null text counts as empty."""
    names = F.array(*[F.lit(k) for k in KINDS])
    rows = documents.select(F.monotonically_increasing_id().alias("place"), "doc_id")
    listed = _listed(sensitive_spans(_placed(documents)))
    every = F.coalesce("all", F.array().cast("array<struct<kind_no:int,start:bigint,end:bigint,remove:boolean>>"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind_no"]), s["start"], s["end"])), ",")

    def number(n: int) -> Column:
        return F.size(F.filter("every", lambda s: s["kind_no"] == n)).cast("long").alias(f"n_{KINDS[n]}")

    out = rows.join(listed, "place", "left").withColumn("every", every)
    base = joined(F.filter("every", lambda s: s["kind_no"] < 4))
    return out.select("doc_id", *[number(n) for n in range(4)], F.sha2(base, 256).alias("base_sha256"), joined(F.col("every")).alias("spans"))
