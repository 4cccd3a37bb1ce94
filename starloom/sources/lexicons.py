"""The word lists of the text pipeline, read from ``seeds/*.csv``.

Fixed values: each list must hold exactly these entries for results to agree. A word that
is listed under both languages counts once per listing.
"""

from __future__ import annotations

import csv
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from starloom.sources.schemas import SEED_SCHEMAS

_FOLDER = Path(__file__).parent / "seeds"


def seed_rows(name: str, folder: Path = _FOLDER) -> list[tuple]:
    """Entries of one list, in the order of the file; whole-number columns as int."""
    whole = {column.split()[0] for column in SEED_SCHEMAS[name].split(", ") if column.endswith(" int")}
    with open(folder / f"{name}.csv", encoding="utf-8", newline="") as file:
        return [
            tuple(int(value) if column in whole else value for column, value in row.items())
            for row in csv.DictReader(file)
        ]


LEXICON = seed_rows("lexicon_sentiment")
TAXONOMY = seed_rows("complaint_taxonomy")
NEGATIONS = seed_rows("negation_words")

SEEDS = {
    "lexicon_sentiment": LEXICON,
    "complaint_taxonomy": TAXONOMY,
    "negation_words": NEGATIONS,
}


def seed_frame(spark: SparkSession, name: str, rows: list[tuple] | None = None) -> DataFrame:
    """One lookup list as a frame; ``rows`` replaces the built-in entries. It comes as an
    Arrow table, whose size the optimizer knows: a short list is broadcast to the texts."""
    listed = rows if rows is not None else SEEDS[name]
    kinds = [column.split() for column in SEED_SCHEMAS[name].split(", ")]
    fields = pa.schema([(column, pa.int32() if kind == "int" else pa.string()) for column, kind in kinds])
    table = pa.Table.from_pylist([dict(zip(fields.names, row, strict=True)) for row in listed], fields)
    return spark.createDataFrame(table)
