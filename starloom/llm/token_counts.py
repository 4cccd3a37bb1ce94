"""Token counts of texts, through a table of frequent pre-tokens.

A text falls into pre-tokens at blanks, none of which a token of the vocabulary spans
(``separable`` checks that
against the vocabulary; where it fails, whole texts are encoded). Counts of a text are then
sums over its pre-tokens:

1. Every task counts the pre-tokens of its own documents and hands on its ``per_task``
   most frequent ones; these summaries alone are shuffled and added up.
2. The ``table_size`` most frequent pre-tokens are encoded once, and their lengths are
   broadcast as one dictionary.
3. Tasks look pre-tokens up there, encode misses in batches, and keep those in a cache of
   at most ``cache_size`` entries per worker.

What the table holds changes the speed only, never a count.

Defined cases: a null text counts as empty and has no tokens; special strings inside a text
are ordinary text; every input row gives one row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.tokens import limit_batches

_models: dict[str, object] = {}
_caches: dict[str, dict[str, int]] = {}
SIGN = "\u2581"  # stands for a blank in the vocabulary


def processor(path: str):
    """The tokenizer of a file, loaded once per worker."""
    if path not in _models:
        import sentencepiece

        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


def separable(path: str) -> bool:
    """Whether pre-tokens can be encoded one by one: no piece has a blank behind another
    character, and a text is taken as it is, with one blank put in front."""
    model = processor(path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    if any(SIGN in piece.lstrip(SIGN) for piece in pieces):
        return False
    return all(
        "".join(model.encode(probe, out_type=str)) == SIGN + probe.replace(" ", SIGN)
        for probe in ("a", " a", "a  b ", "A a\u00c9\u00e9 1/2")
    )


def pre_tokens(text: str) -> list[str]:
    """Pieces of a text that was not empty, each without the first of its blanks.

    The tokenizer puts a blank in front of the text, so every piece starts with one, and
    puts one in front of each piece when it is encoded alone. The empty piece is a single
    blank at the end of the text.
    """
    parts = text.replace(SIGN, " ").split(" ")
    if "" not in parts:
        return parts
    out, blanks = [], ""
    for part in parts[:-1]:
        if part:
            out.append(blanks + part)
            blanks = ""
        else:
            blanks += " "
    out.append(blanks + parts[-1])
    return out


def _texts(batch: pa.RecordBatch) -> Iterator[list[str]]:
    column = batch.column("text")
    for first in range(0, len(column), 256):
        yield [text or "" for text in column.slice(first, 256).to_pylist()]


def frequent_pre_tokens(docs: DataFrame, per_task: int, table_size: int) -> list[str]:
    """The most frequent pre-tokens by the tasks' summaries."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for texts in _texts(batch):
                for text in texts:
                    counts.update(pre_tokens(text))
                if len(counts) > 64 * per_task:  # bounded memory: forget the rare ones
                    counts = Counter(dict(counts.most_common(8 * per_task)))
        top = [(key, n) for key, n in counts.most_common(per_task) if len(key) <= MAX_KEY]
        yield pa.RecordBatch.from_pydict(
            {"key": pa.array([k for k, _ in top], pa.string()),
             "n": pa.array([n for _, n in top], pa.int64())}
        )

    merged = docs.select("text").mapInArrow(summary, "key string, n long")
    merged = merged.groupBy("key").agg(F.sum("n").alias("n"))
    top = merged.orderBy(F.desc("n"), "key").limit(table_size)
    return [row.key for row in top.select("key").collect()]  # at most table_size short strings


class Lengths(dict):
    """Lengths of frequent pre-tokens, with those of the slice at hand behind them."""

    rest: dict[str, int]

    def __missing__(self, key: str) -> int:
        return self.rest[key]


# Longer pre-tokens are neither put into the table nor cached.
MAX_KEY = 64


def count_tokens(
    docs: DataFrame,
    model_path: str,
    limit: int = 4096,
    table_size: int = 1 << 15,
    per_task: int = 1 << 12,
    cache_size: int = 1 << 18,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per document.

    ``model_path`` names a vocabulary file that is found at that place on every machine.
    """
    spark = limit_batches(docs.sparkSession)
    apart = separable(model_path)
    lengths: dict[str, int] = {}
    if apart:
        keys = frequent_pre_tokens(docs, per_task, table_size)
        lengths = dict(zip(keys, map(len, processor(model_path).encode(keys, num_threads=1))))
        lengths[""] = 1  # a single blank
    table = spark.sparkContext.broadcast(lengths)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = Lengths(table.value), processor(model_path)
        cache = _caches.setdefault(model_path, {})

        def encode(missing: list[str]) -> dict[str, int]:
            return dict(zip(missing, map(len, model.encode(missing, num_threads=1))))

        for batch in batches:
            totals = []
            for texts in _texts(batch):
                if not apart:
                    totals += [len(ids) for ids in model.encode(texts, num_threads=1)]
                    continue
                split = [pre_tokens(text) if text else [] for text in texts]
                missing = set().union(*split) - known.keys()
                fresh = encode([key for key in missing if key not in cache])
                found = {key: cache[key] for key in missing if key in cache} | fresh
                if len(cache) + len(fresh) > cache_size:
                    cache.clear()
                cache.update((k, n) for k, n in fresh.items() if len(k) <= MAX_KEY)
                known.rest = found
                totals += [sum(map(known.__getitem__, keys)) for keys in split]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(totals, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "text",
    )
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
