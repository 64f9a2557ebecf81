"""The registered corpus queries and their DuckDB SQL: every operator over its whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import (
    chunks,
    collocations,
    contamination,
    licenses,
    lines,
    mixing,
    rules,
    secrets,
    simhash,
    subwords,
    suffixes,
    toxicity,
    tries,
)
from ledgerloom.llm.oracle import SQL

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunks.repeated_chunks(_table(spark, sf_dir, "documents"))
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", listed.alias("spans"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *rules.ADDED)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    ranks = F.transform("spans", lambda s: s["rank"])
    counts = {
        f"n_{kind}": (F.size(ranks) - F.size(F.array_remove(ranks, rank))).cast("long")
        for rank, kind in enumerate(secrets.KINDS)
    }
    base = secrets.listed(F.filter("spans", lambda s: s["rank"] < secrets.KINDS.index("random")))
    return found.select(
        "doc_id",
        *[n.alias(c) for c, n in counts.items()],
        F.sha2(base, 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.repeated_lines(_table(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find(_table(spark, sf_dir, "documents"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = subwords.score(docs, subwords.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.conversation_trie(_table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def corpus_queries() -> dict[str, Query]:
    registered = (
        op1_chunks,
        op2_quality_rules,
        op3_simhash,
        op4_suffix_repeats,
        op5_decontaminate,
        op6_secrets,
        op7_fuzzy_lines,
        op8_licenses,
        op9_mix,
        op10_toxicity,
        op11_quality_classifier,
        op12_collocations,
        op13_conversation_trie,
        pipeline,
    )
    return {q.__name__: q for q in registered}


def corpus_sql() -> dict[str, str]:
    return dict(SQL)
