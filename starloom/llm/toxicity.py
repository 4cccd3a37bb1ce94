"""Toxicity of texts that may hide their words: restore first, then score.

Noisy channel. A disguised word is read as a lattice: each character stands for itself, for
a letter it resembles (``1`` for i or l), or for nothing (a separator, or one of a run of
repeated letters). Letters spelled out with blanks between them are joined first. The most
likely path under a character trigram model is the restored word, found by the Viterbi
algorithm. The trigram model counts the letters of all documents; tasks add up their own
counts, so 32,768 sums reach the driver whatever the size of the corpus.

Score. Features are restored words and their beginnings of four to six letters. From the
labelled rows, features that come with label 1 far more often than chance allows are
candidates; of these, the different contexts (word before and after) are counted by label,
so that copies of one toxic text, however many, do not make its other words suspicious.
What stays significant is evidence, weighed by its rates in toxic texts and in others; a
beginning must tell through several words. A document's score is the probability, by
Bayes' rule, that the evidence in it is more than chance brings to a text of its length.

The classifier is fitted on at most ``max_labelled`` labelled rows in expectation, taken by
a hash of the id, and on ``max_features`` candidates. All documents are restored and scored
whole.

Defined cases: a null or empty text scores like one without evidence; rows of equal id are
scored by themselves and share their label (the highest); a null id has no label and is not
held out; without labels nothing is predicted toxic. Labels, language, source and id are no
inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import tokens as T
from starloom.session import materialise

# Letters that a character is used for in disguised words.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "aeiou",
}
RESEMBLES, LEFT_OUT, DIGIT_LEFT_OUT, REPEATED, STRETCHED = -1.0, -1.5, -6.0, -0.5, -3.0

SYMBOLS = 32  # 0: no letter, 1 to 26: a to z, 27: any other letter
_OTHER = 27
_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[ord("a") : ord("z") + 1] = _SYMBOL[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_SYMBOL[0xC3:] = _OTHER
_CONTINUES = np.zeros(256, dtype=bool)
_CONTINUES[0x80:0xC0] = True
STEM_WORDS = 4  # different words that a beginning must tell for, to count by itself
LONGEST = 40  # a longer stretch without blanks is no disguised word

_ALPHA = re.compile(r"[^\W\d_]+")
_THRICE = re.compile(r"([^\W\d_])\1\1")
_HIDDEN = re.compile(r"[^\W\d_][0-9@$!|+€£(*]+[^\W\d_]|(?:^|[^\w])[0-9@$!|+€£(]+[^\W\d_]|[^\W\d_][0-9@$|+€£]+$")
_TRAIL = re.compile(r"[^\w\s]{3,}$")  # decoration, not letters
_SPELLED = re.compile(r"(?<!\S)(?:\S ){3,}\S[.,;:!?)\"']*(?!\S)")


def letter_counts(docs: DataFrame) -> np.ndarray:
    """Counts of letter trigrams inside words, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            data, offsets = T.utf8(batch.column("text"))
            for first in range(int(offsets[0]), int(offsets[-1]), 1 << 20):
                part = data[first : min(first + (1 << 20), int(offsets[-1]))]
                letters = _SYMBOL[part[~_CONTINUES[part]]]
                c = np.concatenate([[0, 0], letters, [0]])
                a, b = np.where(c[1:-1] == 0, 0, c[:-2]), c[1:-1]
                total += np.bincount((a * SYMBOLS + b) * SYMBOLS + c[2:], minlength=SYMBOLS**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["cell", "n"])

    counts = np.zeros(SYMBOLS**3)
    summed = docs.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n"))
    for cell, n in summed.collect():  # at most 32,768 rows
        counts[cell] = n
    return counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


class Restorer:
    """Reads disguised words under a letter model."""

    def __init__(self, counts: np.ndarray):
        pairs = counts.sum(axis=0) + 0.1
        backed = pairs / pairs.sum(axis=1, keepdims=True)
        smoothed = counts + 5.0 * backed[None, :, :]
        self.logs = np.log(smoothed / smoothed.sum(axis=2, keepdims=True)).tolist()

    @staticmethod
    def _symbol(letter: str) -> int:
        return ord(letter) - 96 if "a" <= letter <= "z" else _OTHER

    def decode(self, token: str) -> str:
        """The most likely word behind a token (in lower case)."""
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        before = ""
        for ch in token:
            letter = ch.isalpha()
            options = [(ch, 0.0)] if letter else []
            options += [(x, RESEMBLES) for x in LOOKS_LIKE.get(ch, "")]
            if letter and ch == before:
                options.append(("", REPEATED))
            elif not letter:
                options.append(("", DIGIT_LEFT_OUT if ch.isdigit() else LEFT_OUT))
            reached: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, text) in states.items():
                for x, cost in options:
                    if x:
                        s = self._symbol(x)
                        state = (b, s)
                        value = score + cost + self.logs[a][b][s]
                        if letter and text[-2:] == x + x:
                            value += STRETCHED
                    else:
                        state, value = (a, b), score + cost
                    if state not in reached or value > reached[state][0]:
                        reached[state] = (value, text + x)
            states, before = reached, ch
        return max((score + self.logs[a][b][0], text) for (a, b), (score, text) in states.items())[1]

    def forms(self, token: str) -> list[str]:
        """Words that a token (in lower case) may stand for."""
        token = _TRAIL.sub("", token)
        if token.isalpha() and not _THRICE.search(token):
            return [token]
        parts = _ALPHA.findall(token)
        out = list(parts)
        if not parts or len(token) > LONGEST:
            return out
        if len(parts) > 1:
            out.append("".join(parts))
        if _HIDDEN.search(token) or _THRICE.search(token):
            out.append(self.decode(token))
        return out


def tokens_of(text: str | None) -> list[str]:
    """Tokens of a text in lower case; letters spelled out one by one make one token more."""
    if not text:
        return []
    text = text.lower()
    found = text.split()
    if _SPELLED.search(text):
        found += [m.group().replace(" ", "") for m in _SPELLED.finditer(text)]
    return found


STEMS = (4, 5, 6)


class Finder:
    """Looks up the words a token stands for, and their beginnings, in a table of features:
    ``=word`` for a whole word, ``^stem`` for a beginning."""

    def __init__(self, restorer: Restorer, features):
        self.restorer = restorer
        self.features = features
        self.words = {f[1:] for f in features if f[0] == "="}
        self.stems = {f[1:] for f in features if f[0] == "^"}

    def __call__(self, token: str) -> list[tuple[str, str]]:
        """Each feature of the token with the word that has it."""
        if token.isalpha() and not _THRICE.search(token):
            forms = (token,)
        else:
            forms = self.restorer.forms(token)
        found = []
        for form in forms:
            if form in self.words:
                found.append(("=" + form, form))
            for n in STEMS:
                if form[:n] in self.stems and len(form) >= n:
                    found.append(("^" + form[:n], form))
        return found


class _Known(dict):
    """Something computed once per token, for as many tokens as fit."""

    def __init__(self, compute, size: int = 1 << 18):
        super().__init__()
        self.compute, self.size = compute, size

    def __missing__(self, token: str):
        got = self.compute(token)
        if len(self) >= self.size:
            self.clear()
        if len(token) <= 2 * LONGEST:
            self[token] = got
        return got


def excess(toxic, other, share: float):
    """How surprising the toxic count is at the usual share: rows times divergence."""
    n = toxic + other
    p = F.greatest(F.least(toxic / n, F.lit(1 - 1e-9)), F.lit(1e-9))
    return F.when(
        p > share,
        n * (p * F.log(p / share) + (1 - p) * F.log((1 - p) / (1 - share))),
    ).otherwise(0.0)


def labelled_texts(docs: DataFrame, labels: DataFrame, max_labelled: int) -> DataFrame:
    """``text, toxic`` of rows to learn from, different texts only."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .where(~held_out(F.col("doc_id")))
    )
    rows = known.count()
    if rows > max_labelled:
        limit = int(max_labelled / rows * 2**31)
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < limit)
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The labels that are used have a bounded number of rows, two numbers each.
    joined = texts.join(F.broadcast(known), "doc_id")
    return joined.groupBy("text").agg(F.max("toxic").alias("toxic"))


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, max_features: int = 20_000
) -> tuple[np.ndarray, Evidence]:
    """Letter counts, and the features that tell."""
    spark = T.limit_batches(docs.sparkSession)
    counts = letter_counts(docs)
    letters = spark.sparkContext.broadcast(counts)
    train = materialise(labelled_texts(docs, labels, max_labelled), "labelled")
    rows, toxic = train.agg(F.count("*"), F.sum("toxic")).first()
    share = ((toxic or 0) + 0.5) / (rows + 5.0)
    if not rows or not toxic:
        return counts, Evidence({}, share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = _Known(Restorer(letters.value).forms)
        # Documents with a word, and with each length of beginning, by label.
        kinds = ("=", *STEMS)
        total = {(kind, y): Counter() for kind in kinds for y in (0, 1)}

        def out() -> Iterator[pa.RecordBatch]:
            for (kind, y), counts in total.items():
                sign, numbers = "=" if kind == "=" else "^", list(counts.values())
                zeros = [0] * len(numbers)
                yield pa.RecordBatch.from_pydict(
                    {"feature": pa.array([sign + w for w in counts], pa.string()),
                     "toxic": pa.array(numbers if y else zeros, pa.int64()),
                     "other": pa.array(zeros if y else numbers, pa.int64())}
                )
                counts.clear()

        for batch in batches:
            for text, y in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                tokens = set(tokens_of(text.as_py()))
                words = {w for token in tokens for w in forms[token] if len(w) >= 3}
                total["=", y].update(words)
                for n in STEMS:
                    total[n, y].update({w[:n] for w in words if len(w) >= n})
            if sum(map(len, total.values())) > 1 << 19:
                yield from out()
        yield from out()

    sums = train.mapInArrow(count, "feature string, toxic long, other long").groupBy("feature")
    sums = materialise(
        sums.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), "features"
    )
    bar = math.log(max(sums.count(), 1)) + math.log(100)
    score = excess(F.col("toxic"), F.col("other"), share)
    candidates = sums.where(score > bar)
    best = candidates.orderBy(score.desc(), "feature").limit(max_features)
    chosen = spark.sparkContext.broadcast({row.feature for row in best.select("feature").collect()})

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = chosen.value
        known = _Known(Finder(Restorer(letters.value), wanted))
        for batch in batches:
            found = set()
            for text, y in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                words = tokens_of(text.as_py())
                around = ["", *words, ""]
                for i, word in enumerate(words):
                    for f, form in known[word]:
                        found.add((f, form, around[i][:40] + " " + around[i + 2][:40], y))
            yield pa.RecordBatch.from_pydict(
                {"feature": pa.array([f for f, _, _, _ in found], pa.string()),
                 "word": pa.array([w for _, w, _, _ in found], pa.string()),
                 "context": pa.array([c for _, _, c, _ in found], pa.string()),
                 "toxic": pa.array([y for _, _, _, y in found], pa.int64())}
            )

    places = train.mapInArrow(contexts, "feature string, word string, context string, toxic long")
    told = (
        places.distinct()
        .groupBy("feature", "word")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("other"))
        .groupBy("feature")
        .agg(
            F.sum("toxic").alias("toxic"),
            F.sum("other").alias("other"),
            F.count_if(F.col("toxic") > 0).alias("words"),
        )
        .where(
            (excess(F.col("toxic"), F.col("other"), share) > bar)
            & (F.col("toxic") > F.col("other"))
            & (F.col("feature").startswith("=") | (F.col("words") >= STEM_WORDS))
        )
    )
    found = [(r.feature, r.toxic, r.other) for r in told.collect()]  # max_features at most
    words = train.groupBy("toxic").agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n"))
    size = {r.toxic: r.n for r in words.collect()}
    hits = sum(toxic for _, toxic, _ in found)
    # For each feature: its support, and how much more of the toxic hits than of the words
    # of other texts it makes up.
    model = {
        feature: (toxic, math.log(toxic / hits) - math.log((other + 2) / (size.get(0, 0) + 1)))
        for feature, toxic, other in found
    }
    return counts, Evidence(model, share)


class Evidence:
    """Turns the toxic words found in a text into a probability.

    Among other texts, words that look toxic turn up by chance, each at its own rate, so
    their number follows a Poisson law. In a toxic text there is at least one, and larger
    numbers get rarer slowly, whatever the length.
    """

    def __init__(self, model: dict[str, tuple[int, float]], share: float):
        self.model, self.prior = model, math.log(share / (1 - share))

    def weight(self, features: list[tuple[str, str]]) -> float | None:
        """Evidence of one word, by its best supported feature."""
        return max(self.model[f] for f, _ in features)[1] if features else None

    def score(self, words: int, weights: list[float]) -> float:
        k = len(weights)
        if not k:
            return 0.25 / (1 + math.exp(-self.prior))
        odds = self.prior + sum(weights) - k * math.log(words) + math.lgamma(k + 1)
        odds -= math.log(k * (k + 1))
        return 1 / (1 + math.exp(-max(min(odds, 30.0), -30.0)))


def score_texts(docs: DataFrame, counts: np.ndarray, evidence: Evidence) -> DataFrame:
    """Add ``toxicity`` to the documents."""
    spark = T.limit_batches(docs.sparkSession)
    held = spark.sparkContext.broadcast((counts, evidence.model, evidence.prior))

    @F.pandas_udf("double")
    def toxicity(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        letters, model, prior = held.value
        judge = Evidence(model, 0.5)
        judge.prior = prior
        find = Finder(Restorer(letters), model)
        known = _Known(lambda token: judge.weight(find(token)))
        for column in texts:
            out = []
            for text in column:
                words = tokens_of(text)
                weights = [w for w in map(known.__getitem__, words) if w is not None]
                out.append(judge.score(len(words), weights))
            yield pd.Series(out)

    return docs.withColumn("toxicity", toxicity(F.col("text")))


def toxic_scores(docs: DataFrame, labels: DataFrame, bar: float = 0.3, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score_texts(rows, *fit(docs, labels, **options))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= bar).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, bar: float = 0.3, **options) -> DataFrame:
    """The documents that score below the bar, in their columns."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text")
    scored = score_texts(rows, *fit(docs, labels, **options)).where(F.col("toxicity") < bar)
    return scored.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
