"""The stages in a row, and the registered queries against their SQL."""

import random
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from conftest_llm import ODD
from starloom.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect()), key=str) == sorted(cursor.fetchall(), key=str)


def test_stages(spark, documents, tmp_path):
    rng = random.Random(9)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(2000))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, labels = [], []
    for i in range(400):
        rows.append((i, text(60), f"s{i % 3}"))
        labels.append((i, 1, int(i % 4 == 0)))
        if i % 4 == 0:
            rows[-1] = (i, rows[-1][1] + " gromble snarfid " + text(5), f"s{i % 3}")
    base, lines = text(80), "\n".join(text(8) for _ in range(4))
    item = text(15)
    rows += [(1000, base, "s0"), (1001, base, "s0"), (1002, base + " tail", "s1")]
    rows += [(1003, text(30) + "\n" + lines, "s1"), (1004, lines + "\n" + text(30), "s2")]
    rows += [(1005, text(20) + " " + item + " " + text(20), "s2"), (1006, text(50) + " snarfid", "s0")]
    rows += [(10_000 + d if d is not None else None, t, None) for d, t in ODD if d not in (11,)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs, columns, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), None, {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
        seen[name] = {r.doc_id: r.text for r in docs.collect()}
        if name != "mixing":
            assert docs.columns == columns
            assert docs.count() <= before.count()
    ids = {name: set(texts) for name, texts in seen.items()}
    toxic = {i for i in range(0, 400, 4)} | {1006}
    assert ids["toxicity"] == {r[0] for r in rows} - toxic
    assert lines not in seen["line_dedup"][1004] and lines in seen["line_dedup"][1003]
    # Copies lose their only line; of the others the text one word longer goes.
    assert ids["toxicity"] - ids["line_dedup"] == {1001, 10_005}
    assert ids["near_dedup"] & {1000, 1001, 1002} == {1000}
    assert ids["line_dedup"] - ids["near_dedup"] == {1002}
    assert ids["near_dedup"] - ids["decontamination"] == {1005}
    assert ids["mixing"] <= ids["decontamination"]
    assert {"copies", "finish"} <= set(docs.columns) and docs.where("copies < 1 or copies > 3").count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"
    ]


def test_pipeline_of_empty_tables(spark, documents, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
