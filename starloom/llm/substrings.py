"""Removal of passages of 50 words that an earlier document holds too.

A count-min sketch finds the windows worth comparing. Every window of ``window`` words is
represented by the smallest hash among its eight-word shingles: equal windows have equal
minima, so the count of a minimum, over documents, is never below the count of any window
it stands for. Neighbouring windows mostly share their minimum; such a run of windows is
one entry of the sketch, some twenty times fewer than windows.

1. Each task sketches its own documents; the partition sketches are added up. Only "more
   than once" matters, so the merged sketch comes down to a bitmap, whose size is fixed
   beforehand (at most ``max_cells`` bits for each of two hash functions). A smaller
   sketch only lets more windows through.
2. A second pass keeps runs whose minimum is estimated repeated. Runs with the same words
   are grouped exactly, and the windows of the different ones are grouped by their 128-bit
   identity (minimum and window hash) to find the first document of each.
3. Documents are joined with their removed word ranges.

Copies of one text, however many, meet only in sums and joins by key, which combine
before the shuffle or are split by AQE.

Defined cases: a null or blank text has no words; a document shorter than the window keeps
everything; rows of equal id do not remove each other; a null id neither removes nor loses
words; looping words inside one document are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import tokens as T
from starloom.session import materialise

SHINGLE = 8
RUN_LIMIT = 256
FLUSH = 1 << 20


def _runs(piece: T.Words, window: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with the same minimum: text, first window, windows, minimum; and
    the word hashes."""
    hashes = piece.hashes()
    minima = T.sliding_minimum(T.sequences(hashes, SHINGLE), window - SHINGLE + 1)
    at = np.flatnonzero(T.whole(piece.bounds, window))
    minima = minima[at]
    text = piece.text_of_word()[at]
    if not len(at):
        return text, at, at, minima, hashes
    new = np.ones(len(at), dtype=bool)
    new[1:] = (minima[1:] != minima[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(at)))
    if length.max() > RUN_LIMIT:  # looping texts: cut, so that a row stays small
        parts = -(-length // RUN_LIMIT)
        nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.repeat(begin, parts) + nth * RUN_LIMIT
        length = np.minimum(np.repeat(length, parts) - nth * RUN_LIMIT, RUN_LIMIT)
    return text[begin], at[begin], length, minima[begin], hashes


def _cells(minima: np.ndarray, width: int) -> np.ndarray:
    """A cell of each of the two rows of the sketch."""
    mask = np.uint64(width - 1)
    second = T.mixed(minima + np.uint64(0x9E3779B97F4A7C15)) & mask
    return np.stack([minima & mask, second + np.uint64(width)]).astype(np.int64)


def _sketch_of_task(window: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            cells, counts = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(cells), pa.array(np.minimum(counts, 2).astype(np.int64))], ["cell", "n"]
            )

        for batch in batches:
            for piece in T.words(batch.column("text")):
                text, _, _, minima, _ = _runs(piece, window)
                if not len(minima):
                    continue
                order = np.lexsort((minima, text))
                text, minima = text[order], minima[order]
                once = np.ones(len(text), dtype=bool)  # a document counts once
                once[1:] = (text[1:] != text[:-1]) | (minima[1:] != minima[:-1])
                waiting.append(_cells(minima[once], width).ravel())
                held += 2 * int(once.sum())
                if held >= FLUSH:
                    yield flush()
                    waiting, held = [], 0
        if waiting:
            yield flush()

    return run


def _repeated_runs(window: int, width: int, bitmap):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_key", pa.int64()), ("v", pa.int64()), ("u", pa.int64()),
         ("lo", pa.int32()), ("windows", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, dtype=np.uint8)
        for batch in batches:
            ids = batch.column("doc_id")
            keys = batch.column("text_key")
            for piece in T.words(batch.column("text")):
                text, lo, n, minima, hashes = _runs(piece, window)
                cells = _cells(minima, width)
                keep = ((bits[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1).all(axis=0)
                text, lo, n, minima = text[keep], lo[keep], n[keep], minima[keep]
                if not len(lo):
                    continue
                unit = T.spans_hash(hashes, lo, lo + n + window - 1)
                ends = np.cumsum(n)
                at = np.arange(int(ends[-1])) + np.repeat(lo - (ends - n), n)
                values = pa.array(T.sequences(hashes, window)[at].view(np.int64))
                offsets = pa.array(np.append(0, ends).astype(np.int32))
                rows = pa.array(text + piece.first)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(rows), keys.take(rows), pa.array(minima.view(np.int64)),
                     pa.array(unit.view(np.int64)),
                     pa.array((lo - piece.bounds[text]).astype(np.int32)),
                     pa.ListArray.from_arrays(offsets, values)],
                    schema=schema,
                )

    return run


def sketch_width(text_bytes: int, max_cells: int) -> int:
    """Cells in a row of the sketch: four to eight for each run there can be."""
    width = 1 << 16
    while width < min(text_bytes // 32, max_cells):
        width *= 2
    return width


def repeated_ranges(docs: DataFrame, window: int = 50, max_cells: int = 1 << 28) -> DataFrame:
    """Word ranges to remove: ``doc_id, text_key, ranges`` (array of first and end), for
    documents that lose any. ``text_key`` is ``xxhash64(text)``."""
    spark = T.limit_batches(docs.sparkSession)
    docs = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text"
    )
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = sketch_width(size, max_cells)
    merged = (
        docs.select("text")
        .mapInArrow(_sketch_of_task(window, width), "cell long, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .where("n > 1")
    )
    bitmap = np.zeros(2 * width // 8, dtype=np.uint8)
    number = F.col("cell") + 1  # the bitmap functions count from 1
    blocks = merged.groupBy(F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )
    for bucket, bits in blocks.collect():  # 2 * width bits in all, at most 64 MB
        first = (bucket - 1) * 4096
        got = np.frombuffer(bits, dtype=np.uint8)
        bitmap[first : first + len(got)] = got[: len(bitmap) - first]
    found = spark.sparkContext.broadcast(bitmap.tobytes())
    runs = materialise(
        docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(
            _repeated_runs(window, width, found),
            "doc_id long, text_key long, v long, u long, lo int, windows array<long>",
        ),
        "repeated_runs",
    )
    units = materialise(
        runs.groupBy("v", "u").agg(
            F.min("doc_id").alias("first_doc"), F.first("windows").alias("windows")
        ),
        "units",
    )
    each = units.select("v", "u", "first_doc", F.posexplode("windows").alias("nth", "w"))
    shared = materialise(
        each.groupBy("v", "w")
        .agg(F.min("first_doc").alias("earliest"), F.max("first_doc").alias("latest"))
        .where("earliest < latest")
        .drop("latest"),
        "shared_windows",
    )
    # Of the first occurrence of a run, only windows that another run held before.
    partly = materialise(
        each.join(shared, ["v", "w"])
        .where("earliest < first_doc")
        .groupBy("v", "u")
        .agg(F.collect_list("nth").alias("nths")),
        "partly_repeated",
    )
    of_runs = runs.select(
        "v", "u", "doc_id", "text_key", "lo", F.size("windows").alias("n")
    )
    later = of_runs.join(units.select("v", "u", "first_doc"), ["v", "u"])
    later = later.where("doc_id > first_doc").select(
        "doc_id", "text_key", F.struct("lo", (F.col("lo") + F.col("n")).alias("end")).alias("r")
    )
    first = of_runs.join(units.select("v", "u", "first_doc"), ["v", "u"])
    first = first.where("doc_id = first_doc").join(partly, ["v", "u"]).select(
        "doc_id",
        "text_key",
        F.explode(
            F.transform(
                "nths",
                lambda k: F.struct((F.col("lo") + k).alias("lo"), (F.col("lo") + k + 1).alias("end")),
            )
        ).alias("r"),
    )
    return later.unionByName(first).groupBy("doc_id", "text_key").agg(
        F.collect_list("r").alias("ranges")
    )


def _rewrite(window: int, with_text: bool):
    """Apply the ranges of windows to each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
            ranges = batch.column("ranges")
            texts = batch.column("text")
            for row in range(len(batch)):
                text = texts[row].as_py()
                words = (text or "").encode().split()
                gone = 0
                if ranges[row].is_valid:
                    keep = np.ones(len(words), dtype=bool)
                    flat = ranges[row].values
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(change, flat.field("lo").to_numpy(), 1)
                    ends = flat.field("end").to_numpy() + window - 1
                    np.add.at(change, np.minimum(ends, len(words)), -1)
                    keep = np.cumsum(change[:-1]) == 0
                    gone = len(words) - int(keep.sum())
                    kept = b" ".join([words[i] for i in np.flatnonzero(keep)])
                else:
                    kept = b" ".join(words)
                out["n_words"].append(len(words))
                out["n_removed"].append(gone)
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    out["kept_text"].append(kept.decode() if gone else text)
            columns = [batch.column("doc_id"), pa.array(out["n_words"], pa.int64()),
                       pa.array(out["n_removed"], pa.int64()),
                       pa.array(out["kept_sha256"], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns.append(pa.array(out["kept_text"], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def remove_repeated_passages(
    docs: DataFrame, window: int = 50, max_cells: int = 1 << 28, with_text: bool = True
) -> DataFrame:
    """Documents without the words that an earlier document holds in a window.

    Returns ``doc_id, n_words, n_removed, kept_sha256`` and, if wanted, ``kept_text``: the
    text as it was when nothing was removed, else the kept words joined by single spaces.
    """
    if window < 2 * SHINGLE:
        raise ValueError(f"a window must have {2 * SHINGLE} words at least")
    ranges = repeated_ranges(docs, window, max_cells)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key")
    ).join(ranges, ["doc_id", "text_key"], "left")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return rows.select("doc_id", "text", "ranges").mapInArrow(
        _rewrite(window, with_text), schema + (", kept_text string" if with_text else "")
    )
