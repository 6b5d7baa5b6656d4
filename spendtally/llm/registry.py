"""Registered queries of this subpackage, and their SQL counterparts."""

from __future__ import annotations

from . import (
    conversations, decontaminate, language, lattice, lines, mixing, neardup, quality, ranking, sanitise, sharding, substrings, suffix_tree,
)
from ..registry.book import Book
from .common import table

query = Book()


@query()
def op1_sharding(spark, sf_dir):
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


@query(neardup.NEAR_DUPLICATE_SQL)
def op2_near_duplicates(spark, sf_dir):
    return neardup.near_duplicate_digest(table(spark, sf_dir, "documents"))


@query()
def op3_quality(spark, sf_dir):
    return quality.quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(decontaminate.CONTAINED_SQL)
def op4_decontamination(spark, sf_dir):
    return decontaminate.contained_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(substrings.SUBSTRING_SQL)
def op5_substring_dedup(spark, sf_dir):
    return substrings.substring_digest(table(spark, sf_dir, "documents"))


@query()
def op6_language(spark, sf_dir):
    return language.language_digest(table(spark, sf_dir, "documents"))


@query()
def op7_language_model(spark, sf_dir):
    return suffix_tree.language_model_digest(table(spark, sf_dir, "documents"))


@query(lattice.LINKED_SQL)
def op8_lattice(spark, sf_dir):
    return lattice.lattice_digest(table(spark, sf_dir, "embeddings"))


@query()
def op9_sanitise(spark, sf_dir):
    return sanitise.sanitise_digest(table(spark, sf_dir, "documents"))


@query(mixing.MIX_SQL)
def op10_mixing(spark, sf_dir):
    return mixing.mix_digest(table(spark, sf_dir, "documents"))


@query(ranking.RANKED_SQL)
def op11_ranking(spark, sf_dir):
    return ranking.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(lines.LINES_SQL)
def op12_lines(spark, sf_dir):
    return lines.line_digest(table(spark, sf_dir, "documents"))


@query(conversations.REPAIRED_SQL)
def op13_conversations(spark, sf_dir):
    return conversations.repair_digest(table(spark, sf_dir, "conversations"))


def all_queries():
    return dict(query.queries)


def all_sql():
    return dict(query.sql)
