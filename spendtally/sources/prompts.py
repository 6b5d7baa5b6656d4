"""Prompt templates as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_prompts(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """``(prompt_file, prompt_text, prompt_sha)``: whole files, hashed as raw bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("prompt_file"),
        F.decode("content", "UTF-8").alias("prompt_text"),
        F.sha2("content", 256).alias("prompt_sha"),
    )


def file_stem(col: str = "prompt_file"):
    return F.regexp_replace(col, r"\.[^.]*$", "")
