import pytest

from starloom.session import materialise, prepare, shared_folder
from starloom.sources.lexicons import LEXICON, NEGATIONS, TAXONOMY, seed_frame
from starloom.sources.readers import read_seed, read_source, stage
from starloom.sources.schemas import SOURCES, schema
from starloom.sources.writers import write_table


def test_word_list_sizes():
    assert (len(LEXICON), len(TAXONOMY), len(NEGATIONS)) == (145, 62, 18)
    assert len({w for w, _, _ in LEXICON}) == 142


@pytest.mark.parametrize("name", ["lexicon_sentiment", "complaint_taxonomy", "negation_words"])
def test_seed_files(spark, tmp_path, name):
    frame = seed_frame(spark, name)
    frame.write.csv(str(tmp_path / f"{name}.csv"), header=True)
    back = read_seed(spark, str(tmp_path), name)
    assert back.schema == frame.schema
    assert sorted(back.collect()) == sorted(frame.collect())


@pytest.mark.parametrize("name", SOURCES)
def test_empty_sources_stage(spark, tmp_path, name):
    spark.createDataFrame([], schema(name)).write.parquet(str(tmp_path / f"{name}.parquet"))
    staged = stage(read_source(spark, str(tmp_path), name), name)
    assert staged.columns[-1] == "_loaded_at"
    assert staged.count() == 0


def test_written_rows_are_sorted_in_each_file(spark, tmp_path):
    import datetime as dt

    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i * 37 % 100), i) for i in range(100)]
    df = spark.createDataFrame(rows, "d date, i int").repartition(2)
    back = write_table(df, str(tmp_path / "t"), "d")
    assert back.count() == 100
    for part in back.rdd.glom().collect():
        days = [r.d for r in part]
        assert days == sorted(days)


class FakeSession:
    """Just what ``shared_folder`` asks of a session."""

    def __init__(self, master, folder=None):
        self.master, self.folder, self.applicationId = master, folder, f"app-{master}"
        self.sparkContext = self.conf = self

    def getConf(self):
        return {"spark.checkpoint.dir": self.folder}

    def get(self, key, default=None):
        return self.folder or default


def test_shared_folder():
    assert shared_folder(FakeSession("yarn", "hdfs:///work/")) == "hdfs:///work"
    own = shared_folder(FakeSession("local[2]"))
    assert own == shared_folder(FakeSession("local[2]"))
    with pytest.raises(RuntimeError):
        shared_folder(FakeSession("yarn"))


def test_materialised_table_lies_in_the_shared_folder(spark):
    table = materialise(spark.range(5), "five")
    assert table.count() == 5
    assert f"{shared_folder(spark)}/starloom/" in table.inputFiles()[0]


def test_prepare_sets_skew_handling(spark):
    prepare(spark)
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_builds_keep_the_customer_history(spark, tmp_path):
    """Three builds in a row, each with the history of the one before."""
    import datetime as dt

    from starloom.plans.register import warehouse
    from starloom.plans.warehouse import _STEPS, current_version, stored_history

    folder = str(tmp_path / "marts")
    assert current_version(spark, folder) is None and stored_history(spark, folder) is None
    seen = []
    for day in (1, 2, 2):
        w = warehouse(spark, "/root/testdata/sf0.001")
        w.snapshot_at = dt.datetime(2025, 1, day)
        w.history = stored_history(spark, folder) or w.history
        w.written("rfm_base")
        if day == 2 and len(seen) == 1:  # a build that fails on the way
            broken = warehouse(spark, "/root/testdata/sf0.001")
            broken._frames["fct_flights"] = spark.sql("select raise_error('no') as flight_date")
            before = current_version(spark, folder)
            with pytest.raises(Exception, match="no"):
                broken.build(folder)
            # Offers of the bound tables repeat keys, so a checked build does not switch.
            with pytest.raises(ValueError, match="ancillary_offer"):
                warehouse(spark, "/root/testdata/sf0.001").build(folder, check=True)
            assert current_version(spark, folder) == before
            tier = "case when loyalty_tier = 'Gold' then 'Silver' else loyalty_tier end as loyalty_tier"
            columns = [tier if c == "loyalty_tier" else c for c in w["customers"].columns]
            w._frames["customers"] = w["customers"].selectExpr(*columns)
            changed = w["customers"]
        elif seen:
            w._frames["customers"] = changed
        built = w.build(folder)
        version = current_version(spark, folder)
        assert set(built) == {name for step in _STEPS for name in step}
        for name in built:
            assert spark.read.parquet(f"{version}/{name}").columns
        history = spark.read.parquet(f"{version}/dim_customer_snapshot")
        seen.append(sorted(map(str, history.drop("_loaded_at").collect())))
    assert len(seen[1]) > len(seen[0]) and seen[2] == seen[1]
