"""Rules from a JSON file: lists of predicates, turned into columns without any SQL text.

A file maps each concept to predicates ``[column, comparison, value]``: a row fits if all
of ``all`` hold and, if there is such a list, one of ``any``. A null fits no predicate.
"""

from __future__ import annotations

import json
import operator
from dataclasses import dataclass
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPARISONS = {
    "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
    "=": operator.eq, "!=": operator.ne,
}
BUILT_IN = Path(__file__).with_name("rules.json")
Predicate = tuple[str, str, int | float | str | bool]


@dataclass(frozen=True)
class FileRule:
    """A rule as read from a file; takes the place of ``rules.Rule``."""

    concept: str
    all_of: tuple[Predicate, ...] = ()
    any_of: tuple[Predicate, ...] = ()

    def condition(self, columns: list[str]) -> Column:
        unknown = sorted({p[0] for p in self.all_of + self.any_of} - set(columns))
        if unknown:
            raise ValueError(f"{self.concept} names columns that are not there: {unknown}")
        parts = [_column(p) for p in self.all_of]
        if self.any_of:
            parts.append(reduce(lambda a, b: a | b, map(_column, self.any_of)))
        return reduce(lambda a, b: a & b, parts)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.where(self.condition(df.columns)).select(
            "*",
            F.lit(self.concept).alias("ontology_concept"),
            F.current_timestamp().alias("inferred_at"),
        )


def _column(predicate: Predicate) -> Column:
    name, comparison, value = predicate
    return F.coalesce(COMPARISONS[comparison](F.col(f"`{name}`"), F.lit(value)), F.lit(False))


def _predicates(concept: str, rows: list) -> tuple[Predicate, ...]:
    out = []
    for row in rows:
        if not isinstance(row, list) or len(row) != 3 or not isinstance(row[0], str):
            raise ValueError(f"{concept}: {row} is not [column, comparison, value]")
        if row[1] not in COMPARISONS:
            raise ValueError(f"{concept}: unknown comparison {row[1]}")
        if not isinstance(row[2], (int, float, str, bool)):
            raise ValueError(f"{concept}: {row[2]} is no value to compare with")
        out.append(tuple(row))
    return tuple(out)


def read_rules(path: str | Path = BUILT_IN) -> dict[str, FileRule]:
    """The rules of a file by concept."""
    rules = {}
    for concept, parts in json.loads(Path(path).read_text()).items():
        extra = set(parts) - {"all", "any"}
        if extra or not any(parts.values()):
            raise ValueError(f"{concept} needs predicates under all or any, and nothing else")
        rules[concept] = FileRule(
            concept, _predicates(concept, parts.get("all", [])), _predicates(concept, parts.get("any", []))
        )
    return rules
