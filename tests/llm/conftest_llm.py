import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

# Columns whose names the operators use for their own results.
CLASHES = ["n_words", "kept", "size", "copies", "hits", "items", "id", "node", "text_key", "doc", "word", "toxicity", "n_lines", "n_removed"]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, "
SCHEMA = COLUMNS + ", ".join(f"{c} string" for c in CLASHES)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with clashing columns."""

    def make(rows):
        full = []
        for row in rows:
            doc_id, text, source = (*row, "s")[:3]
            full.append((doc_id, text, "en", source, None if text is None else len(text), *["x"] * len(CLASHES)))
        return spark.createDataFrame(full, SCHEMA)

    return make


LONG = " ".join(f"word{i % 977}" for i in range(60_000))

# Nulls, empty, blank and very long texts, repeated rows, ties.
ODD = [
    (None, None), (None, "a b c"), (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG),
    (6, "same text of a few words"), (6, "same text of a few words"), (6, "other text of that id"),
    (7, "é ü 漢字 😀"), (8, "x" * 200_000), (9, "a\n" * 5_000), (10, "\n\r\n"), (11, "loser"),
]


@pytest.fixture
def odd(documents):
    return documents(ODD)


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def blank_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
