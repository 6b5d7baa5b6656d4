"""Prompt requests and match responses as tables, for a matching service of the user's own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json_text import response_match
from ..functions.text import render_prompt


def prompt_requests(offered: DataFrame, ids, template: str, name: str = "input_name") -> DataFrame:
    """One rendered prompt per asked name from its offer rows (bounded by the sample size)."""
    listed = offered.groupBy(*ids, name).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("cand_ord", "candidate"))),
                    lambda s: s["candidate"]).alias("candidates"))
    return listed.withColumn("prompt", render_prompt(F.lit(template), name, "candidates"))


def prompts_of_files(offered: DataFrame, ids, prompts: DataFrame, name: str = "input_name") -> DataFrame:
    """``(prompt_file, ids, prompt)``: every prompt file filled in for every asked name.

    ``prompts(prompt_file, prompt_text)`` as ``read_prompts`` gives them; they come as
    one value, so names and prompts meet without a join.
    """
    files = prompts.agg(F.collect_list(F.struct("prompt_file", "prompt_text"))).scalar()
    listed = prompt_requests(offered, ids, "", name).withColumn("_p", F.explode(files))
    return listed.select(
        F.col("_p.prompt_file").alias("prompt_file"), *ids, render_prompt(F.col("_p.prompt_text"), name, "candidates").alias("prompt"))


def accept_responses(responses: DataFrame, offered: DataFrame, ids, response: str = "response") -> DataFrame:
    """Parse answers and keep those that the caller's list holds; a wrong or empty answer is null.

    ``offered`` is the list before the asked name was taken out (``evaluate.listed``),
    so an answer that echoes a listed name stays valid.
    """
    parsed = responses.withColumn("answer", response_match(response))
    listed = offered.select(*ids, F.col("candidate").alias("answer"), F.lit(True).alias("_ok")).distinct()
    return (
        parsed.join(listed, [*ids, "answer"], "left")
        .withColumn("match", F.when(F.col("_ok"), F.col("answer"))).drop("_ok", "answer")
    )
