"""Removal of benchmark text from training documents.

The n-grams of the benchmark are put into a hash set and broadcast; every task scans its
own documents against it, so documents are never shuffled. The set holds at most
``block_words`` benchmark words; a larger benchmark is cut into blocks by item, and every
document passes all blocks in one scan, one after the other.

A scan numbers the words of a document with the benchmark's vocabulary, hashes its windows
with array operations, looks the hashes up, and compares the words of every hit.

Words are ``[0-9a-z]`` and anything outside ASCII, after lower-casing A-Z. An item of fewer
than ``n`` words is one window of its length.

Defined cases: a null text has no words; an item with null or empty text is never found;
items that repeat an id count once; a null item id is left out; an empty benchmark finds
nothing; every input row gives one row, repeated or not. Result columns replace columns of
the same name.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from starloom.llm import tokens as T

# Bytes to words: A-Z to lower case, what separates words to a blank.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


class NGrams:
    """The windows of one block of benchmark items, ready to look up."""

    def __init__(self, items: list[tuple[int, str]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        found: dict[int, dict[tuple[int, ...], set[int]]] = {}
        for item, text in items:
            words = [number(w, len(self.vocabulary)) for w in words_of(text)]
            size = min(n, len(words))
            for i in range(len(words) - size + 1) if size else ():
                window = tuple(words[i : i + size])
                found.setdefault(size, {}).setdefault(window, set()).add(item)
        self.windows = {
            size: {window: sorted(ids) for window, ids in of_size.items()}
            for size, of_size in found.items()
        }
        self.keys = {}
        for size, of_size in self.windows.items():
            table = np.array(list(of_size), dtype=np.uint64).reshape(-1, size)
            self.keys[size] = np.unique(self._hash(table.T))

    @staticmethod
    def _hash(columns) -> np.ndarray:
        total = np.zeros(columns[0].shape, dtype=np.uint64)
        for column in columns:
            total = T.mixed(total * np.uint64(31) + column.astype(np.uint64) + np.uint64(1))
        return total

    def scan(self, words: list[bytes]) -> list[tuple[int, int, list[int]]]:
        """Every window found: its first word, its length, the items that have it."""
        get = self.vocabulary.get
        numbers = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        unknown = np.append(0, np.cumsum(numbers < 0))
        hits = []
        for size, keys in self.keys.items():
            at = np.flatnonzero(unknown[size:] == unknown[:-size]) if len(words) >= size else []
            if not len(at):
                continue
            hashes = self._hash([numbers[at + k] for k in range(size)])
            place = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
            for i in at[keys[place] == hashes].tolist():
                items = self.windows[size].get(tuple(numbers[i : i + size].tolist()))
                if items:
                    hits.append((i, size, items))
        return hits


_HITS = StructType(
    [
        StructField("n_words", LongType()),
        StructField("starts", ArrayType(IntegerType())),
        StructField("ends", ArrayType(IntegerType())),
        StructField("items", ArrayType(StringType())),
    ]
)


def _scanner(block) -> Column:
    """A UDF over texts: merged word ranges that are hit, and the items found."""

    @pandas_udf(_HITS)
    def scan(texts):
        import pandas as pd

        grams = block.value
        out = []
        for text in texts:
            words = words_of(text)
            starts, ends, items = [], [], set()
            for start, size, ids in sorted(grams.scan(words)):
                if ends and start <= ends[-1]:
                    ends[-1] = max(ends[-1], start + size)
                else:
                    starts.append(start)
                    ends.append(start + size)
                items.update(ids)
            out.append((len(words), starts, ends, sorted(map(str, items))))
        return pd.DataFrame(out, columns=["n_words", "starts", "ends", "items"])

    return scan


def ngram_blocks(benchmark: DataFrame, n: int, block_words: int) -> list:
    """Broadcast hash sets, each of at most ``block_words`` words (or one single item)."""
    spark = T.limit_batches(benchmark.sparkSession)
    items = (
        benchmark.where("item_id is not null and text is not null")
        .select(F.col("item_id").cast("long").alias("item_id"), "text")
        .distinct()
    )
    # Never more words than bytes; items are read one partition at a time.
    blocks, waiting, size = [], [], 0
    for item, text in items.toLocalIterator():
        count = len(words_of(text))
        if waiting and size + count > block_words:
            blocks.append(spark.sparkContext.broadcast(NGrams(waiting, n)))
            waiting, size = [], 0
        waiting.append((item, text))
        size += count
    if waiting:
        blocks.append(spark.sparkContext.broadcast(NGrams(waiting, n)))
    return blocks


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, block_words: int = 1 << 20
) -> DataFrame:
    """Add ``n_words``, ``hits`` (array of first and end word) and ``items`` (item ids as
    sorted strings) to the documents."""
    columns = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "hits", "items")]
    blocks = ngram_blocks(benchmark, n, block_words)
    if not blocks:
        blocks = [docs.sparkSession.sparkContext.broadcast(NGrams([], n))]
    found = docs
    for k, block in enumerate(blocks):
        found = found.withColumn(f"_hits{k}", _scanner(block)(F.col("text")))
    each = [F.col(f"_hits{k}") for k in range(len(blocks))]
    ranges = F.concat(*[F.arrays_zip(h["starts"].alias("start"), h["ends"].alias("end")) for h in each])
    items = F.array_sort(F.array_distinct(F.concat(*[h["items"] for h in each])))
    return found.select(
        *columns, each[0]["n_words"].alias("n_words"), ranges.alias("hits"), items.alias("items")
    )


def hit_words(hits: Column) -> Column:
    """Words inside any of the ranges, which may overlap."""
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    walked = F.aggregate(
        F.array_sort(hits),
        start,
        lambda had, r: F.struct(
            F.greatest(had["upto"], r["end"]).alias("upto"),
            (had["n"] + F.greatest(F.lit(0), r["end"] - F.greatest(had["upto"], r["start"]))).alias("n"),
        ),
    )
    return walked["n"]


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per document."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark, n, **options).select(
        "doc_id", "n_words", hit_words(F.col("hits")).alias("n_hit"), "items"
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_ONE_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


@pandas_udf(StringType())
def _without(texts, hits):
    """Cut the hit words, and what separates them, out of the texts."""
    import pandas as pd

    out = []
    for text, ranges in zip(texts, hits):
        if text is None or ranges is None or not len(ranges):
            out.append(text)
            continue
        data = text.encode()
        at = [m.span() for m in _ONE_WORD.finditer(data)]
        kept, last = [], 0
        for r in sorted(ranges, key=lambda r: (r["start"], r["end"])):
            start, end = at[r["start"]][0], at[r["end"] - 1][1]
            if start > last:
                kept.append(data[last:start].strip(b" "))
            last = max(last, end)
        kept.append(data[last:].strip(b" "))
        out.append(b" ".join(k for k in kept if k).decode())
    return pd.Series(out, dtype=object)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, n: int = 10, remove: str = "documents", **options
) -> DataFrame:
    """Documents without benchmark text, in the columns of ``docs``.

    ``remove="documents"`` leaves out every document with a hit, ``"spans"`` cuts the hit
    words out of the text and keeps the document.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove must be 'documents' or 'spans'")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    found = find_leaks(docs.select(F.struct(*columns).alias("_row"), "text"), benchmark, n, **options)
    if remove == "documents":
        return found.where(F.size("hits") == 0).select("_row.*")
    row = F.col("_row").withField("text", _without(F.col("text"), F.col("hits")))
    return found.select(row.alias("_row")).select("_row.*")
