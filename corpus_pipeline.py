"""From raw documents to a training mix, in five stages.

Every stage takes the session, the documents its predecessor kept, and the folder of the
tables; it returns documents in the columns it was given, the last one also how often each
is read. A stage judges the documents it is given, not the raw ones.

1. ``toxicity`` leaves out documents scored toxic; it learns from ``labels``.
2. ``line_dedup`` deletes lines of five words and runs of three lines that stand earlier,
   and documents of which nothing is left.
3. ``near_dedup`` keeps one document of each class of near-duplicates, that of the smallest
   id.
4. ``decontamination`` leaves out documents that hold ten consecutive words of a
   ``benchmark`` item.
5. ``mixing`` draws documents of each source to its target weight. ``copies`` says how
   often the mix reads a document, ``finish`` where in the mix its first reading ends.

Nulls, empty texts, repeated rows and further columns are handled as the operators'
docstrings say. ORACLE_SQL is None: classifier and alignment are beyond SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.decontaminate import decontaminate
from starloom.llm.lines import drop_repeated_lines
from starloom.llm.mixing import mixture
from starloom.llm.near_duplicates import drop_near_duplicates
from starloom.llm.toxicity import drop_toxic
from starloom.session import materialise


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, _table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
