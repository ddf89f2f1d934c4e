import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyloom.sinks import tables as W
from tallyloom.sinks.versions import CommitConflict, VersionedTable, key_hash


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def frame(spark, rows):
    return spark.createDataFrame(rows, "day date, k int, v string")


D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
FIRST = [(D1, 1, "a"), (D1, 2, "b"), (D2, 3, "c")]
SECOND = [(D2, 3, "x"), (D3, 4, "y")]


def test_replace_days_keeps_other_days_and_repeats(spark, path, rows):
    W.replace_days(frame(spark, FIRST), path, "day")
    for _ in range(2):
        stats = W.replace_days(frame(spark, SECOND), path, "day")
    assert rows(W.read_table(spark, path), "k", "v") == [(1, "a"), (2, "b"), (3, "x"), (4, "y")]
    assert (stats.inserted, stats.kept) == (2, 0)


def test_replace_where_refuses_other_values(spark, path):
    with pytest.raises(Exception, match="row outside"):
        W.replace_where(frame(spark, FIRST), path, "day", D1)


@pytest.mark.parametrize("day", [None, "day"])
def test_upsert_counts_and_repeats(spark, path, rows, day):
    W.upsert(frame(spark, FIRST), path, ["day", "k"], day)
    stats = W.upsert(frame(spark, SECOND), path, ["day", "k"], day)
    assert (stats.inserted, stats.updated) == (1, 1)
    assert stats.kept <= 2  # no more than the other rows of the files that hold a matched key
    again = W.upsert(frame(spark, SECOND), path, ["day", "k"], day)
    assert (again.inserted, again.updated) == (0, 2)
    assert rows(W.read_table(spark, path), "k", "v") == [(1, "a"), (2, "b"), (3, "x"), (4, "y")]


@pytest.mark.parametrize("day", [None, "day"])
def test_replace_keys(spark, path, rows, day):
    W.replace_keys(frame(spark, FIRST), path, ["day", "k"], day)
    W.replace_keys(frame(spark, SECOND + [(D2, 3, "z")]), path, ["day", "k"], day)
    assert rows(W.read_table(spark, path), "k", "v") == [(1, "a"), (2, "b"), (3, "x"), (3, "z"), (4, "y")]


@pytest.mark.parametrize("day", [None, "day"])
def test_insert_absent_is_idempotent(spark, path, rows, day):
    for batch, new in ((FIRST, 3), (SECOND, 1), (SECOND, 0)):
        assert W.insert_absent(frame(spark, batch), path, ["day", "k"], day).inserted == new
    assert rows(W.read_table(spark, path), "k", "v") == [(1, "a"), (2, "b"), (3, "c"), (4, "y")]


def test_replace_table_reads_its_own_target(spark, path, rows):
    W.replace_table(frame(spark, FIRST), path)
    grown = W.read_table(spark, path).withColumn("v", F.concat("v", F.lit("!")))
    assert W.replace_table(grown, path).inserted == 3
    assert rows(W.read_table(spark, path), "v") == [("a!",), ("b!",), ("c!",)]


def test_history_keeps_one_copy_per_day(spark, path):
    sites = spark.createDataFrame([(1,), (2,)], "site int")
    W.append_history(sites, path, D1)
    W.append_history(sites, path, D2)
    W.append_history(sites.limit(1), path, D2)
    counts = {r["calday"]: r["count"] for r in W.read_table(spark, path).groupBy("calday").count().collect()}
    assert counts == {D1: 2, D2: 1}


def test_empty_batches_write_nothing(spark, path):
    W.replace_days(frame(spark, FIRST), path, "day")
    stats = W.replace_days(frame(spark, FIRST).where("k > 100"), path, "day")
    assert stats.inserted == 0 and W.read_table(spark, path).count() == 3


def test_align_schema(spark):
    df = spark.createDataFrame([(1, "2", 3)], "a int, b string, c int")
    aligned = W.align_schema(df, "b INT, d DATE, a BIGINT")
    assert aligned.dtypes == [("b", "int"), ("d", "date"), ("a", "bigint")]
    assert tuple(aligned.first()) == (2, None, 1)


def test_write_log(spark, tmp_path):
    log = str(tmp_path / "log")
    for i in (1, 2):
        W.log_write(spark, log, i, W.WriteStats("/x/orders", "upsert", inserted=i))
    assert W.latest_change(spark, log, "orders").first()["load_id"] == 2


def test_only_files_of_the_batch_days_are_opened(spark, path, monkeypatch):
    W.replace_days(frame(spark, FIRST), path, "day")
    opened, real = [], VersionedTable.read_files

    def read_files(self, files, version, with_file=False):
        opened.append({r.file.split("/")[1] for r in (files if isinstance(files, list) else files.collect())})
        return real(self, files, version, with_file)

    monkeypatch.setattr(VersionedTable, "read_files", read_files)
    W.upsert(frame(spark, SECOND), path, ["day", "k"], "day")
    assert opened and set().union(*opened) == {"day=2024-01-02"}


def test_empty_batches_clear_their_day(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    W.replace_days(frame(spark, [(D1, 1, "a"), (D2, 2, "b")]), path, "day")
    W.replace_where(frame(spark, []), path, "day", D1)
    assert {r["k"] for r in W.read_table(spark, path).collect()} == {2}


def test_repeated_or_movable_keys_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    for write in (W.upsert, W.replace_keys, W.insert_absent):
        with pytest.raises(ValueError, match="must be one of the keys"):
            write(frame(spark, FIRST), path, ["k"], "day")
    with pytest.raises(ValueError, match="more than once"):
        W.upsert(frame(spark, [(D1, 1, "a"), (D1, 1, "b")]), path, ["day", "k"])


def test_extract_is_one_file_within_its_bound_and_replays(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        assert W.write_extract(spark.range(1000).repartition(7), path, 1, one_file_rows=1000).inserted == 1000
    assert len(spark.read.parquet(f"{path}/load_id=1").inputFiles()) == 1
    W.write_extract(spark.range(1000), path, 2, one_file_rows=999)
    assert spark.read.parquet(path).groupBy("load_id").count().orderBy("load_id").collect() == [(1, 1000), (2, 1000)]


def test_dated_landing_replays(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2024", "01", "02")], "k int, yyyy string, mm string, dd string")
    for load_id in (1, 1, 2):
        W.write_dated(df, path, load_id=load_id)
    assert spark.read.parquet(path).count() == 2


# --- versions -------------------------------------------------------------------------------


def files_of(spark, path, number=None):
    table = VersionedTable(spark, path)
    return {r.file: r.rows for r in table.files(table.version(number)).collect()}


def test_every_writer_counts_deleted_rows(spark, path):
    assert W.replace_days(frame(spark, FIRST), path, "day").deleted == 0
    stats = W.replace_days(frame(spark, SECOND), path, "day")
    assert (stats.inserted, stats.deleted) == (2, 1)
    assert W.replace_where(frame(spark, []), path, "day", D1).deleted == 2
    assert W.append(frame(spark, FIRST), path).deleted == 0
    stats = W.replace_keys(frame(spark, [(D1, 1, "z")]), path, ["day", "k"], "day")
    assert (stats.inserted, stats.deleted) == (1, 1)
    stats = W.replace_table(frame(spark, FIRST), path)
    assert (stats.inserted, stats.deleted) == (3, 5)
    assert [r.deleted for r in W.change_history(spark, path).orderBy("number").collect()] == [0, 1, 2, 0, 1, 5]


def test_read_version_by_load_and_number(spark, path, rows):
    W.replace_table(frame(spark, FIRST), path, load=("w", 5))
    W.upsert(frame(spark, SECOND), path, ["day", "k"], load=("w", 6))
    W.append(frame(spark, SECOND), path)
    assert rows(W.read_version(spark, path, load_id=5), "v") == [("a",), ("b",), ("c",)]
    assert rows(W.read_version(spark, path, number=2), "v") == [("a",), ("b",), ("x",), ("y",)]
    assert W.read_table(spark, path).count() == 6
    with pytest.raises(LookupError):
        W.read_version(spark, path, load_id=7)


def test_a_writer_that_dies_before_its_commit_changes_nothing(spark, path, rows, monkeypatch):
    W.replace_table(frame(spark, FIRST), path)
    before = W.read_table(spark, path)  # opened by a reader

    def die(self, version):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "commit", die)
        for write in (W.replace_table, lambda df, p: W.upsert(df, p, ["day", "k"]), lambda df, p: W.append(df, p, load=("w", 1))):
            with pytest.raises(RuntimeError, match="lost"):
                write(frame(spark, SECOND), path)
    assert rows(W.read_table(spark, path), "v") == [("a",), ("b",), ("c",)] == rows(before, "v")
    W.replace_table(frame(spark, SECOND), path)  # the next writer is not disturbed by what is left
    assert rows(W.read_table(spark, path), "v") == [("x",), ("y",)]
    assert rows(before, "v") == [("a",), ("b",), ("c",)]  # the reader keeps the version that it opened
    assert VersionedTable(spark, path).vacuum() > 0
    assert rows(W.read_table(spark, path), "v") == [("x",), ("y",)]


def test_of_two_writers_one_is_told(spark, path, rows):
    W.replace_table(frame(spark, FIRST), path)
    table = VersionedTable(spark, path)
    base = table.version()
    W.append(frame(spark, SECOND), path)
    with pytest.raises(CommitConflict):
        table.change(frame(spark, SECOND), base, "late", drop=F.lit(True))
    assert W.read_table(spark, path).count() == 5


def test_an_append_that_loses_the_race_is_committed_after_the_winner(spark, path, monkeypatch):
    W.append(frame(spark, FIRST), path)
    real, calls = VersionedTable.commit, []

    def commit(self, version):
        calls.append(version.number)
        if len(calls) == 1:  # another writer is faster
            W.append(frame(spark, SECOND), path, load=("other", 1))
        real(self, version)

    monkeypatch.setattr(VersionedTable, "commit", commit)
    W.append(frame(spark, SECOND), path, load=("mine", 1))
    assert W.read_table(spark, path).count() == 7 and calls == [2, 2, 3]


def test_repeated_loads_do_nothing(spark, path):
    for load in (("a", 1), ("a", 1), ("b", 1), ("a", 2), ("a", 1)):
        W.append(frame(spark, FIRST), path, load=load)
    assert W.read_table(spark, path).count() == 9
    for write in (W.replace_table, W.append_evolving):
        assert write(frame(spark, []), path, load=("a", 2)).inserted == 0
    assert W.upsert(frame(spark, SECOND), path, ["day", "k"], load=("b", 1)).updated == 0
    assert W.read_table(spark, path).count() == 9 and len(VersionedTable(spark, path).numbers()) == 3


def test_bucketed_upsert_opens_and_rewrites_only_files_with_a_key(spark, path, rows, monkeypatch):
    old = spark.range(4000).select("id", F.lit("old").alias("v"))
    W.upsert(old, path, ["id"], buckets=16)
    first = files_of(spark, path)
    opened = []
    real = VersionedTable.read_files

    def read_files(self, files, version, with_file=False):
        opened.append({r.file for r in (files if isinstance(files, list) else files.collect())})
        return real(self, files, version, with_file)

    monkeypatch.setattr(VersionedTable, "read_files", read_files)
    batch = spark.createDataFrame([(7, "new"), (100_000, "new")], "id long, v string")
    stats = W.upsert(batch, path, ["id"])
    assert (stats.inserted, stats.updated, stats.deleted) == (1, 1, 0)
    second = files_of(spark, path)
    gone = set(first) - set(second)
    assert len(first) == 16 and len(gone) == 1 and stats.kept == first[gone.pop()] - 1
    assert max(map(len, opened)) <= 2  # the file with key 7, and at most one that its filter could not rule out
    monkeypatch.undo()
    got = W.read_table(spark, path)
    assert got.count() == 4001 and {r.id for r in got.where("v = 'new'").collect()} == {7, 100_000}


def test_inserts_into_buckets_rewrite_nothing(spark, path):
    W.insert_absent(spark.range(0, 4000, 2).toDF("id"), path, ["id"], buckets=4)
    first = set(files_of(spark, path))
    assert W.insert_absent(spark.range(0, 4000).toDF("id"), path, ["id"]).inserted == 2000
    assert first < set(files_of(spark, path)) and W.read_table(spark, path).distinct().count() == 4000


def test_filters_miss_no_key_and_rule_most_others_out(spark, path):
    W.upsert(spark.range(0, 20_000, 2).toDF("id"), path, ["id"], buckets=2)
    table = VersionedTable(spark, path)
    version = table.version()

    def candidates(ids):
        hashes = spark.createDataFrame([(i,) for i in ids], "id long").select(key_hash(["id"]).alias("h"))
        return table.candidate_files(version, hashes).count()

    assert all(candidates([i]) == 1 for i in (0, 2, 4444, 19_998)) and candidates(range(0, 20_000, 2)) == 2
    assert sum(candidates([i]) for i in range(1, 41, 2)) <= 3


@pytest.mark.parametrize("layout", [{}, {"buckets": 4}])
def test_random_changes_equal_a_dictionary(spark, tmp_path, layout):
    r = random.Random(3)
    path, want = str(tmp_path / "t"), {}
    W.upsert(spark.createDataFrame([(i, "0") for i in range(50)], "k int, v string"), path, ["k"], **layout)
    want = dict.fromkeys(range(50), "0")
    for step in range(1, 6):
        keys = r.sample(range(80), 12)
        batch = spark.createDataFrame([(k, str(step)) for k in keys], "k int, v string").repartition(3)
        kind = r.choice(("upsert", "replace_keys", "insert_absent"))
        stats = getattr(W, kind)(batch, path, ["k"])
        known = sum(k in want for k in keys)
        assert (stats.inserted, stats.updated, stats.deleted) == {"upsert": (12 - known, known, 0), "replace_keys": (12, 0, known), "insert_absent": (12 - known, 0, 0)}[kind]
        want = ({k: str(step) for k in keys} | want) if kind == "insert_absent" else want | {k: str(step) for k in keys}
    assert dict(map(tuple, W.read_table(spark, path).collect())) == want


def test_null_keys_and_partition_values(spark, path):
    df = spark.createDataFrame([("a b/c%+", 1), (None, 2), ("ü", 3), ("12", 4)], "p string, k int")
    W.append(df, path, ["p"])
    assert W.replace_where(spark.createDataFrame([("a b/c%+", 9)], "p string, k int"), path, "p", "a b/c%+").deleted == 1
    assert W.replace_where(spark.createDataFrame([], "p string, k int"), path, "p", None).deleted == 1
    assert sorted(map(tuple, W.read_table(spark, path).collect())) == [("12", 4), ("a b/c%+", 9), ("ü", 3)]
    W.upsert(spark.createDataFrame([("ü", 3), (None, 5)], "p string, k int"), path, ["p", "k"], "p")
    assert W.read_table(spark, path).count() == 4


def test_batches_that_do_not_fit_the_table_are_refused(spark, path):
    W.append(frame(spark, FIRST), path)
    with pytest.raises(ValueError, match="align_schema"):
        W.append(spark.range(1), path)
    W.append_evolving(frame(spark, SECOND).withColumn("w", F.lit(1)).drop("v"), path)
    assert (4, None, 1) in set(map(tuple, W.read_table(spark, path).select("k", "v", "w").collect()))
    with pytest.raises(ValueError, match="in the table"):
        W.append_evolving(spark.range(1).select(F.lit("x").alias("k")), path)


def test_compaction_brings_small_files_together(spark, path):
    W.append(frame(spark, FIRST), path, ["day"])
    for i in range(25):
        W.append(frame(spark, [(D1, 100 + i, "n"), (D3, 200 + i, "n")]), path, load=("w", i))
    before = files_of(spark, path)
    stats = W.compact(spark, path)
    after = files_of(spark, path)
    assert len(before) >= 52 and len(after) == 3 and stats.kept == 53 - 1 and sum(after.values()) == 53
    assert W.read_table(spark, path).count() == 53 and (stats.inserted, stats.deleted) == (0, 0)
    assert W.compact(spark, path).version == VersionedTable(spark, path).version().number  # nothing left to do
    W.append(frame(spark, SECOND), path, load=("w", 3))
    assert W.read_table(spark, path).count() == 53  # loads are still known


def test_compaction_does_not_sort_a_bin(spark, path, monkeypatch):
    """Rows of a bin stream into its file; a sort would hold them all in the task."""
    for i in range(3):
        W.append(spark.createDataFrame([(i, "a"), (i, None)], "id int, v string"), path)
    plans, change = [], VersionedTable.change
    monkeypatch.setattr(VersionedTable, "change", lambda self, rows, *a, **k: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or change(self, rows, *a, **k))
    W.compact(spark, path)
    assert len(plans) == 1 and "Sort" not in plans[0]
    assert W.read_table(spark, path).count() == 6 and len(files_of(spark, path)) == 1


def test_compaction_keeps_bins_near_the_target(spark, path):
    for i in range(6):
        W.append(spark.range(i * 1000, i * 1000 + 1000).toDF("k"), path)
    size = max(r.bytes for r in VersionedTable(spark, path).files(VersionedTable(spark, path).version()).collect())
    W.compact(spark, path, target_bytes=2 * size)
    assert 2 <= len(files_of(spark, path)) <= 4 and W.read_table(spark, path).distinct().count() == 6000
