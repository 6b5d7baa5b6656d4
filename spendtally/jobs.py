"""The jobs from files to files.

    python -m spendtally.jobs extract   --awards a --suppliers s --spend m --keys k --outdir in [--url jdbc:...]
    python -m spendtally.jobs combine   --indir in --outdir out [--matcher cascade]
    python -m spendtally.jobs summarise --indir out --outdir out [--as-of 2026-01-31]
    python -m spendtally.jobs enrich    --sources a.csv b.csv --combined out/combined --outdir out
    python -m spendtally.jobs requests  --benchmark b.csv --prompts prompts --outdir out
    python -m spendtally.jobs evaluate  --benchmark b.csv [other.csv] --prompts prompts --outdir out [--responses r] [--descriptions d.csv]
    python -m spendtally.jobs report    --suppliers s.csv --outdir out

Jobs leave the number of rows they wrote under ``counts`` in the output folder.
The clock is read here only, and only when ``--as-of`` is missing.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .operators.aggregates import fingerprint
from .operators.joins import pending_runs, with_default
from .operators.matchers import CascadeMatcher, LevenshteinMatcher, Matcher, RatioMatcher, RuleMatcher
from .plans import enrich as en
from .plans import evaluate as ev
from .plans import line_level as ll
from .plans import reconcile as rc
from .plans import report as rp
from .plans import requests as rq
from .plans import summary as sm
from .sources import tables as tb
from .sources.database import live_contracts, live_mi, live_reg_keys, read_jdbc
from .sources.prompts import file_stem, read_prompts

MATCHERS = {"cascade": CascadeMatcher, "ratio": RatioMatcher, "levenshtein": LevenshteinMatcher, "rules": RuleMatcher}


def extract(awards: DataFrame, suppliers: DataFrame, spend: DataFrame, keys: DataFrame, outdir: str) -> None:
    """Database tables (see ``sources.database.read_jdbc``) -> the three input files."""
    tables = {"contracts": live_contracts(awards, suppliers), "mi": live_mi(spend), "reg_number_supplier_key": live_reg_keys(keys)}
    counts = {name: tb.write_table(df, f"{outdir}/{name}.csv", "csv", "overwrite") for name, df in tables.items()}
    tb.write_counts(awards.sparkSession, counts, f"{outdir}/counts/extract")


def _inputs(spark: SparkSession, indir: str):
    contracts = tb.read_table(spark, f"{indir}/contracts.csv", schemas.CONTRACTS)
    mi = tb.read_table(spark, f"{indir}/mi.csv", schemas.MI)
    keys = tb.read_table(spark, f"{indir}/reg_number_supplier_key.csv", schemas.REG_KEYS)
    return tb.with_row_numbers(contracts, "contract_ord"), tb.with_row_numbers(mi, "mi_ord"), keys


def combine(spark: SparkSession, indir: str, outdir: str, matcher: Matcher, residual: str = "reference") -> None:
    """Input files -> ``combined`` and ``unmatched`` (Parquet)."""
    combined, unmatched = rc.reconcile(*_inputs(spark, indir), matcher, residual)
    counts = {name: tb.write_table(df, f"{outdir}/{name}", mode="overwrite")
              for name, df in (("combined", combined), ("unmatched", unmatched))}
    tb.write_counts(spark, counts, f"{outdir}/counts/combine")


def summarise(spark: SparkSession, indir: str, outdir: str, as_of) -> None:
    """``contracts.csv``, ``combined``, ``unmatched`` -> ``line_level`` and ``summary_stats`` (CSV)."""
    contracts = tb.read_table(spark, f"{indir}/contracts.csv", schemas.CONTRACTS)
    combined = tb.read_table(spark, f"{outdir}/combined", fmt="parquet")
    unmatched = tb.read_table(spark, f"{outdir}/unmatched", fmt="parquet")
    lines = ll.line_level_from_combined(combined, as_of)
    n_lines = tb.write_table(ll.with_report_labels(lines), f"{outdir}/line_level", "csv", "overwrite",
                             sort_by=["Contracting Authority", "Supplier"])
    stats = sm.summary_stats(contracts, lines, sm.profile_rows(unmatched))
    n_stats = tb.write_table(stats.orderBy("position").drop("position").coalesce(1), f"{outdir}/summary_stats", "csv", "overwrite")
    tb.write_counts(spark, {"line_level": n_lines, "summary_stats": n_stats}, f"{outdir}/counts/summarise")


def enrich(spark: SparkSession, sources: list[str], combined: str, outdir: str, overwrite: bool = True) -> None:
    """Customer-group files in order, later ones winning -> ``combined_with_customer_group``."""
    parts = [tb.with_file_order(tb.read_table(spark, p, schemas.CUSTOMER_GROUPS), "ord") for p in sources]
    out = en.add_customer_group(tb.read_table(spark, combined, fmt="parquet"), en.build_group_dim(parts), overwrite=overwrite)
    name = "combined_with_customer_group"
    tb.write_counts(spark, {name: tb.write_table(out, f"{outdir}/{name}", mode="overwrite")}, f"{outdir}/counts/enrich")


def _labelled(spark: SparkSession, benchmark: str | list[str]) -> DataFrame:
    """The labelled set from the first of several places that exists."""
    return tb.first_existing(spark, [benchmark] if isinstance(benchmark, str) else benchmark, schemas.BENCHMARK)


def requests(
    spark: SparkSession, benchmark: str | list[str], prompts: str, outdir: str,
    num_distractors: int = ev.NUM_DISTRACTORS, seed: int = ev.SEED,
) -> None:
    """Every prompt file filled in for every labelled row -> ``requests``: prompt_file, row_id, prompt.

    A matching service answers them; ``evaluate`` scores the answers.
    """
    rows = ev.labelled_rows(_labelled(spark, benchmark))
    offered = ev.offers(rows, ev.RunConfig("", num_distractors=num_distractors, seed=seed))
    filled = rq.prompts_of_files(offered, ["row_id"], read_prompts(spark, prompts))
    n = tb.write_table(filled, f"{outdir}/requests", mode="overwrite")
    tb.write_counts(spark, {"requests": n}, f"{outdir}/counts/requests")


def evaluate(
    spark: SparkSession, benchmark: str | list[str], prompts: str, outdir: str, scorer: str = "ratio",
    descriptions: DataFrame | None = None, num_distractors: int = ev.NUM_DISTRACTORS, seed: int = ev.SEED,
    threshold: float = ev.SIMILARITY_THRESHOLD, responses: DataFrame | None = None,
) -> list[str]:
    """Score every prompt file not yet run on this data; returns the run names.

    With ``responses(prompt_file, row_id, response)`` a prompt is scored by a
    service's answers to it, else by the built-in scorer.  ``benchmark`` may be a
    list of places.  The ledger of done runs is a table under ``outdir``; a changed
    prompt, data set or parameter makes a run pending again.
    """
    source = _labelled(spark, benchmark)
    rows = ev.labelled_rows(source)
    mark = fingerprint(source, source.columns).first()
    manifest = read_prompts(spark, prompts).drop("prompt_text").withColumns({
        "dataset_sha": F.lit(f"{mark.row_count}-{mark.digest_a}-{mark.digest_b}"),
        "num_distractors": F.lit(num_distractors), "seed": F.lit(seed), "similarity_threshold": F.lit(threshold)})
    if responses is not None:  # a prompt without answers has not been run
        manifest = manifest.join(responses.select("prompt_file").distinct(), "prompt_file", "left_semi")
    ledger_path = f"{outdir}/ledger"
    try:
        ledger = tb.read_table(spark, ledger_path, schemas.RUN_LEDGER, "parquet")
    except FileNotFoundError:
        ledger = spark.createDataFrame([], schemas.RUN_LEDGER)
    todo = pending_runs(manifest, ledger, schemas.RUN_KEYS)
    named = with_default(todo, descriptions, "prompt_file", "run_name", file_stem()) if descriptions is not None \
        else todo.withColumn("run_name", file_stem())
    runs = tb.shared_checkpoint(named.withColumn("scorer", F.lit("responses" if responses is not None else scorer)))
    # one entry per prompt file
    names = [r.run_name for r in runs.select("prompt_file", "run_name").orderBy("prompt_file").collect()]
    if not names:
        return []
    if responses is None:
        preds = ev.predictions(rows, runs)
    else:
        given = responses.join(runs.select("prompt_file", "run_name"), "prompt_file")
        preds = ev.predictions_from_responses(rows, given, runs)
    preds = tb.shared_checkpoint(preds)  # written and summarised
    tb.write_table(preds, f"{outdir}/predictions", mode="append")
    tb.write_summary(ev.run_summary(preds, rows, runs), f"{outdir}/summary", mode="append")
    tb.write_table(runs.select(*schemas.RUN_KEYS), ledger_path, mode="append")
    return names


def report(spark: SparkSession, suppliers: str, outdir: str, as_of, threshold: int, sender: str = "") -> None:
    """Suppliers file -> status rows partitioned by framework, and nested records as JSON."""
    rows = tb.with_file_order(tb.read_table(spark, suppliers, schemas.SUPPLIERS_REPORT), "ord")
    status = rp.status_report(rp.by_framework(rows), as_of, threshold, sender)
    rp.write_report(status, f"{outdir}/status", "overwrite")
    tb.write_summary(rp.records_by_framework(status, "ord"), f"{outdir}/records", mode="overwrite")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="spendtally.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    def job(name, *paths):
        s = sub.add_parser(name)
        for a in paths:
            s.add_argument(f"--{a}", required=True)
        return s

    s = job("extract", "awards", "suppliers", "spend", "keys", "outdir")
    s.add_argument("--url", default=None, help="read tables or queries of this JDBC database instead of Parquet paths")
    s = job("combine", "indir", "outdir")
    s.add_argument("--matcher", choices=MATCHERS, default="cascade")
    s.add_argument("--residual", choices=["reference", "strict"], default="reference")
    s = job("summarise", "indir", "outdir")
    s.add_argument("--as-of", default=None)
    s = job("enrich", "combined", "outdir")
    s.add_argument("--sources", nargs="+", required=True)
    s.add_argument("--keep-existing", action="store_true")
    for name in ("requests", "evaluate"):
        s = job(name, "prompts", "outdir")
        s.add_argument("--benchmark", nargs="+", required=True, help="places of the labelled set; the first that exists is read")
        s.add_argument("--distractors", type=int, default=ev.NUM_DISTRACTORS)
        s.add_argument("--seed", type=int, default=ev.SEED)
    s.add_argument("--scorer", choices=ev.SCORERS, default="ratio")
    s.add_argument("--threshold", type=float, default=ev.SIMILARITY_THRESHOLD)
    s.add_argument("--responses", default=None, help="Parquet with a service's answers: prompt_file, row_id, response")
    s.add_argument("--descriptions", default=None, help="CSV with run names: prompt_file, run_name")
    s = job("report", "suppliers", "outdir")
    s.add_argument("--as-of", default=None)
    s.add_argument("--threshold", type=int, default=rp.STATUS_MONTHS_THRESHOLD)
    s.add_argument("--sender", default="")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"spendtally-{a.job}").getOrCreate()
    as_of = dt.date.fromisoformat(a.as_of) if getattr(a, "as_of", None) else dt.date.today()
    with tb.own_checkpoints(spark):
        _run(spark, a, as_of)


def _run(spark: SparkSession, a: argparse.Namespace, as_of) -> None:
    if a.job == "extract":
        read = (lambda t: read_jdbc(spark, a.url, t)) if a.url else (lambda t: tb.read_table(spark, t, fmt="parquet"))
        extract(read(a.awards), read(a.suppliers), read(a.spend), read(a.keys), a.outdir)
    elif a.job == "combine":
        combine(spark, a.indir, a.outdir, MATCHERS[a.matcher](), a.residual)
    elif a.job == "summarise":
        summarise(spark, a.indir, a.outdir, as_of)
    elif a.job == "enrich":
        enrich(spark, a.sources, a.combined, a.outdir, not a.keep_existing)
    elif a.job == "requests":
        requests(spark, a.benchmark, a.prompts, a.outdir, a.distractors, a.seed)
    elif a.job == "evaluate":
        names = tb.read_table(spark, a.descriptions, "prompt_file string, run_name string") if a.descriptions else None
        answers = tb.read_table(spark, a.responses, fmt="parquet") if a.responses else None
        runs = evaluate(spark, a.benchmark, a.prompts, a.outdir, a.scorer, names, a.distractors, a.seed, a.threshold, answers)
        print("\n".join(runs) or "nothing to run")
    else:
        report(spark, a.suppliers, a.outdir, as_of, a.threshold, a.sender)


if __name__ == "__main__":
    main()
