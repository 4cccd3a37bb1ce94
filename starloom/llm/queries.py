"""The registered queries of this subpackage, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from starloom.llm.decontaminate import contamination
from starloom.llm.jaccard_join import jaccard_components
from starloom.llm.lines import dedup_lines
from starloom.llm.mixing import mix
from starloom.llm.near_duplicates import near_duplicates
from starloom.llm.negatives import hard_negatives
from starloom.llm.neighbours import nearest
from starloom.llm.oracles import JACCARD, LINES, MIXING, NEGATIVES, TRIE
from starloom.llm.personal import personal_report
from starloom.llm.prefix_trie import prefix_trie
from starloom.llm.secrets import secret_report
from starloom.llm.substrings import remove_repeated_passages
from starloom.llm.token_counts import count_tokens
from starloom.llm.toxicity import toxic_scores


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return contamination(documents, table(spark, folder, "benchmark"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated_passages(table(spark, folder, "documents"), with_text=False)


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    lines = F.filter(F.split("text", "[\n\r]+"), lambda line: line != "")
    text = F.coalesce(F.array_join(lines, "\n"), F.lit(""))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(text, 256).alias("kept_sha256"))


def op5_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_report(table(spark, folder, "documents"))


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_report(table(spark, folder, "documents"))


def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxic_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return count_tokens(table(spark, folder, "documents"), path)


def op11_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, folder, "embeddings").withColumn("label", label))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_mixing": op3_mixing,
    "op4_line_dedup": op4_line_dedup,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_secrets": op6_secrets,
    "op7_personal_data": op7_personal_data,
    "op8_near_dedup": op8_near_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_token_counts": op10_token_counts,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_hard_negatives": op13_hard_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op3_mixing": MIXING,
    "op4_line_dedup": LINES,
    "op11_jaccard_join": JACCARD,
    "op12_prefix_trie": TRIE,
    "op13_hard_negatives": NEGATIVES,
}
