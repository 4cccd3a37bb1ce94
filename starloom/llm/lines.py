"""Removal of runs of lines that stand somewhere earlier, by winnowing.

A window is one line of ``min_words`` words or more, or ``min_lines`` consecutive lines that
start with a shorter one. The line of smallest hash in a window (the last of equal ones) is
its fingerprint: one row for each fingerprint, with the hashes of the lines around it.

1. Fingerprints that stand at one place only are left out, with all their windows: equal
   windows have equal fingerprints, so no repeated window is lost.
2. What is left is compared line by line: each window with the first place that has it, in a
   document of smaller id, or further up in the same document.
3. Matches are extended both ways while the lines are equal, up to ``min_lines - 1`` lines a
   side (a longer stretch of equal lines holds a window of its own). Matches that touch on
   one diagonal are one run; its lines go from the later place.

Every place is compared with the first place alone, so a line that many documents share
costs a row for each of them, never pairs. The first place of a line is never deleted.

Lines are what ``\\n`` and ``\\r`` separate, compared by 64-bit hashes of their bytes; empty
ones do not count. Words are what blanks separate.

Defined cases: a null or empty text has no lines and stays; null ids come after all others,
together with the largest long; rows that repeat an id are ordered by a hash of their text,
and rows equal in both keep what they have; a document all of whose lines go is left with an
empty text (see ``drop_emptied``). All input columns are handed on; ``text`` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StringType, StructField, StructType

from starloom.llm import tokens as T
from starloom.session import materialise

_LINE_TABLE = T.separator_table(b"\n\r")
_LAST = (1 << 63) - 1  # stands for a null id


def _word_counts(lines: T.Words) -> np.ndarray:
    """Words of each line."""
    inside = T.BLANK_TABLE[lines.data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    opens[lines.start] = inside[lines.start]
    before = np.zeros(len(opens) + 1, dtype=np.int64)
    np.cumsum(opens, out=before[1:])
    return before[lines.end] - before[lines.start]


def winnowed(lines: T.Words, hashes: np.ndarray, min_lines: int, min_words: int):
    """Selected lines, how many windows chose each, and for each of those how far above the
    fingerprint the window starts (-1: the line is a window by itself)."""
    solid = _word_counts(lines) >= min_words
    fits = T.whole(lines.bounds, min_lines)
    start = np.flatnonzero(fits & ~solid[: len(fits)])
    values = hashes[start[:, None] + np.arange(min_lines - 1, -1, -1)]
    above = min_lines - 1 - np.argmin(values, axis=1)
    chosen = np.concatenate([np.flatnonzero(solid), start + above])
    above = np.concatenate([np.full(int(solid.sum()), -1), above])
    order = np.argsort(chosen, kind="stable")
    selected, counts = np.unique(chosen, return_counts=True)
    return selected, counts, above[order]


def _fingerprints(min_lines: int, min_words: int):
    """A row for each fingerprint: its place, its windows, and the lines around it."""
    reach = 2 * (min_lines - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines in T.words(batch.column("text"), _LINE_TABLE):
                hashes = lines.hashes()
                if not len(hashes):
                    continue
                at, counts, above = winnowed(lines, hashes, min_lines, min_words)
                text = lines.text_of_word()[at]
                near = at[:, None] + np.arange(-reach, reach + 1)
                outside = (near < lines.bounds[text][:, None]) | (near >= lines.bounds[text + 1][:, None])
                around = hashes[np.clip(near, 0, len(hashes) - 1)].view(np.int64)
                rows = pa.array(text + lines.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(rows), batch.column("text_key").take(rows),
                     pa.array(hashes[at].view(np.int64)),
                     pa.array((at - lines.bounds[text]).astype(np.int64)),
                     pa.ListArray.from_arrays(
                         np.concatenate([[0], np.cumsum(counts)]).astype(np.int32),
                         pa.array(above.astype(np.int32))),
                     pa.ListArray.from_arrays(
                         np.arange(len(at) + 1, dtype=np.int32) * near.shape[1],
                         pa.array(around.ravel(), mask=outside.ravel()))],
                    ["id", "text_key", "fingerprint", "line", "windows", "around"],
                )

    return run


def _equal_lines(ours: list, theirs: list):
    """How many of the lines, in this order, are equal before the first that is not."""
    equal, count = F.lit(True), F.lit(0)
    for a, b in zip(ours, theirs):
        equal = equal & F.coalesce(a == b, F.lit(False))
        count = count + equal.cast("int")
    return count


def repeated_runs(docs: DataFrame, min_lines: int = 3, min_words: int = 5) -> DataFrame:
    """Maximal runs to delete: ``id, text_key, line, lines`` with the place of their first
    occurrence, ``from_id, from_key, from_line``. ``id`` is the document id, null read as the
    largest long; ``text_key`` is ``xxhash64(text)``."""
    if min_lines < 1 or min_words < 1:
        raise ValueError("a run has one line at least, and a line one word")
    T.limit_batches(docs.sparkSession)
    rows = docs.where("text is not null").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"),
        F.xxhash64("text").alias("text_key"),
        "text",
    )
    fingerprints = materialise(
        rows.mapInArrow(
            _fingerprints(min_lines, min_words),
            "id long, text_key long, fingerprint long, line long, windows array<int>, around array<long>",
        ),
        "line_fingerprints",
    )
    place = F.struct("id", "text_key", "line")
    repeated = (
        fingerprints.groupBy("fingerprint")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first < last")
        .select("fingerprint")
    )
    # The fingerprint stands at position 2 * side + 1 of what is around it.
    side = min_lines - 1
    start = F.lit(2 * side + 1) - F.greatest("above", F.lit(0))
    size = F.when(F.col("above") < 0, 1).otherwise(min_lines)
    windows = materialise(
        fingerprints.join(repeated, "fingerprint", "left_semi")
        .select("id", "text_key", "line", "around", F.explode("windows").alias("above"))
        .select(
            "id",
            "text_key",
            (F.col("line") - F.greatest("above", F.lit(0))).alias("line"),
            F.slice("around", start, size).alias("content"),
            F.reverse(F.slice("around", start - side, F.lit(side))).alias("over"),
            F.slice("around", start + size, F.lit(side)).alias("under"),
        ),
        "line_windows",
    )
    first = (
        windows.groupBy("content")
        .agg(F.min(F.struct("id", "text_key", "line", "over", "under")).alias("first"), F.max(place).alias("last"))
        .where(F.struct("first.id", "first.text_key", "first.line") < F.col("last"))
        .select("content", "first")
    )
    origin = F.struct("first.id", "first.text_key", "first.line")
    matches = windows.join(first, "content").where(origin < place)

    def ends(column: str):
        ours, theirs = F.col(column), F.col(f"first.{column}")
        return _equal_lines([ours[k] for k in range(side)], [theirs[k] for k in range(side)])

    extended = matches.select(
        "id",
        "text_key",
        F.col("first.id").alias("from_id"),
        F.col("first.text_key").alias("from_key"),
        (F.col("line") - F.col("first.line")).alias("diagonal"),
        (F.col("line") - ends("over")).alias("line"),
        (F.col("line") + F.size("content") + ends("under")).alias("end"),
    )
    diagonal = Window.partitionBy("id", "text_key", "from_id", "from_key", "diagonal").orderBy("line", "end")
    reached = F.max("end").over(diagonal.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("line") > reached, F.lit(True)).cast("int")
    return (
        extended.distinct()  # rows equal in id and text
        .withColumn("opens", opens)
        .withColumn("run", F.sum("opens").over(diagonal.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("id", "text_key", "from_id", "from_key", "diagonal", "run")
        .agg(F.min("line").alias("line"), F.max("end").alias("end"))
        .select(
            "id", "text_key", "line", (F.col("end") - F.col("line")).alias("lines"),
            "from_id", "from_key", (F.col("line") - F.col("diagonal")).alias("from_line"),
        )
    )


_KEPT = StructType(
    [
        StructField("kept", StringType()),
        StructField("n_lines", LongType()),
        StructField("n_removed", LongType()),
    ]
)
_LINE = re.compile(r"[^\n\r]+")


def kept_lines(text: str, starts, lengths) -> tuple[str, int, int]:
    """The text without the given runs of lines, its lines, and how many went. What follows
    a removed line up to the next line goes with it."""
    spans = [m.span() for m in _LINE.finditer(text)]
    gone = np.zeros(len(spans) + 1, dtype=np.int64)
    np.add.at(gone, np.asarray(starts), 1)
    np.add.at(gone, np.asarray(starts) + np.asarray(lengths), -1)
    gone = np.cumsum(gone[:-1]) > 0
    if gone.all():
        return "", len(spans), len(spans)
    kept = [text[: spans[0][0]]]
    for i in np.flatnonzero(~gone).tolist():
        end = spans[i + 1][0] if i + 1 < len(spans) else len(text)
        kept.append(text[spans[i][0] : end])
    whole = "".join(kept)
    if gone[-1]:
        whole = whole.rstrip("\n\r")
    return whole, len(spans), int(gone.sum())


@pandas_udf(_KEPT)
def _cut(texts: pd.Series, starts: pd.Series, lengths: pd.Series) -> pd.DataFrame:
    """What is kept of texts that lose lines; nothing for a null."""
    out = [
        (None, 0, 0) if text is None else kept_lines(text, first, n)
        for text, first, n in zip(texts, starts, lengths)
    ]
    return pd.DataFrame(out, columns=["kept", "n_lines", "n_removed"])


def _deduped(docs: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """``doc``, the row as it was, and ``out``: what is kept of it, with counts.

    Runs are few and short beside the texts: each task holds its share of them in a hash
    table and texts pass by it unsorted. Only those that lose lines are handed to Python.
    """
    runs = repeated_runs(docs, min_lines, min_words).groupBy("id", "text_key")
    runs = runs.agg(
        F.collect_list("line").alias("starts"), F.collect_list("lines").alias("lengths")
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"),
        F.xxhash64("text").alias("text_key"),
    )
    found = rows.join(runs.hint("shuffle_hash"), ["id", "text_key"], "left")
    text, whole = F.col("doc.text"), F.col("starts").isNull()
    cut = found.withColumn("cut", _cut(F.when(~whole, text), F.col("starts"), F.col("lengths")))
    n_lines = F.coalesce(F.regexp_count(text, F.lit(_LINE.pattern)).cast("long"), F.lit(0))
    return cut.select(
        "doc",
        F.struct(
            F.when(whole, text).otherwise(F.col("cut.kept")).alias("kept"),
            F.when(whole, n_lines).otherwise(F.col("cut.n_lines")).alias("n_lines"),
            F.when(whole, 0).otherwise(F.col("cut.n_removed")).alias("n_removed"),
        ).alias("out"),
    )


def _columns(docs: DataFrame) -> list:
    return [
        F.col("out.kept").alias("text") if c == "text" else F.col(f"doc.`{c}`").alias(c)
        for c in docs.columns
    ]


def dedup_lines(docs: DataFrame, min_lines: int = 3, min_words: int = 5) -> DataFrame:
    """The documents without repeated runs, with ``n_lines`` and ``n_removed`` added (columns
    of these names are replaced)."""
    kept = docs.drop("n_lines", "n_removed")
    return _deduped(kept, min_lines, min_words).select(*_columns(kept), "out.n_lines", "out.n_removed")


def drop_emptied(deduped: DataFrame) -> DataFrame:
    """Leave out documents that lost all their lines: nothing in them is new."""
    return deduped.where("n_removed = 0 or n_removed < n_lines")


def drop_repeated_lines(docs: DataFrame, min_lines: int = 3, min_words: int = 5) -> DataFrame:
    """The documents without repeated runs and without those that lost all their lines, in
    the columns they came in, whatever these are called."""
    kept = _deduped(docs, min_lines, min_words)
    return kept.where("out.n_removed = 0 or out.n_removed < out.n_lines").select(*_columns(docs))
