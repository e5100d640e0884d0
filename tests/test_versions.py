"""Stored tables: what a reader sees during a write, which files a batch rewrites, splits, conflicts, dying writers."""

import uuid

import pytest
from pyspark.sql import functions as F

from navloom.session import shared_dir
from navloom.sources import ingest, versions


@pytest.fixture()
def path(spark):
    return f"{shared_dir(spark)}/v-{uuid.uuid4().hex}"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def hundred(spark, path, monkeypatch):
    """Ten thousand keys in about a hundred files."""
    monkeypatch.setattr(versions, "CELL_ROWS", 100)
    versions.replace(spark.range(10_000).select(F.col("id").alias("k"), F.lit(1).alias("v")), path, ["k"])
    return path


def names(spark, path):
    return {r.file for r in versions.manifest(spark, path).collect()}


def test_a_batch_rewrites_only_the_files_of_its_keys(spark, hundred):
    before = names(spark, hundred)
    assert len(before) >= 100 and versions.manifest(spark, hundred).agg(F.sum("n")).first()[0] == 10_000
    versions.upsert(spark.createDataFrame([(5, 9)], "k int, v int"), hundred, ["k"], ["v"])
    after = names(spark, hundred)
    assert len(before - after) == 1 and len(after - before) == 1
    got = versions.read(spark, hundred)
    assert got.count() == 10_000 and got.agg(F.sum("v")).first()[0] == 10_008


def test_a_reader_keeps_its_version_during_a_write(spark, hundred, monkeypatch):
    began = versions.read(spark, hundred)
    real = versions._publish
    seen = []

    def watched(*args):
        seen.append(versions.read(spark, hundred).agg(F.sum("v")).first()[0])  # files are written, nothing is published
        return real(*args)

    monkeypatch.setattr(versions, "_publish", watched)
    versions.upsert(spark.range(20_000).select(F.col("id").alias("k"), F.lit(3).alias("v")), hundred, ["k"], ["v"])
    assert seen == [10_000]
    assert began.agg(F.sum("v")).first()[0] == 10_000
    assert versions.read(spark, hundred).agg(F.sum("v")).first()[0] == 60_000
    assert versions.read(spark, hundred, 1).count() == 10_000


def test_the_later_of_two_writers_starts_again(spark, hundred, monkeypatch):
    real, raced = versions._publish, []

    def slow(*args):
        if not raced:
            raced.append(1)
            versions.upsert(spark.createDataFrame([(1, 50), (2, 50)], "k long, v int"), hundred, ["k"], ["v"])
        return real(*args)

    monkeypatch.setattr(versions, "_publish", slow)
    assert versions.upsert(spark.createDataFrame([(2, 70), (3, 70)], "k long, v int"), hundred, ["k"], ["v"]) == 3
    got = {r.k: r.v for r in versions.read(spark, hundred).where("k < 4").collect()}
    assert got == {0: 1, 1: 50, 2: 70, 3: 70} and versions.read(spark, hundred).count() == 10_000
    monkeypatch.setattr(versions, "_publish", lambda *a: False)
    with pytest.raises(versions.Conflict):
        versions.upsert(spark.createDataFrame([(2, 70)], "k long, v int"), hundred, ["k"], ["v"])


def test_a_writer_that_dies_changes_nothing(spark, hundred, monkeypatch):
    def dies(*args):
        raise RuntimeError("lost")

    real = versions._publish
    monkeypatch.setattr(versions, "_publish", dies)
    batch = spark.createDataFrame([(2, 70)], "k long, v int")
    with pytest.raises(RuntimeError):
        versions.upsert(batch, hundred, ["k"], ["v"])
    monkeypatch.setattr(versions, "_publish", real)
    assert versions.read(spark, hundred).agg(F.sum("v")).first()[0] == 10_000
    fs, torn = versions._path(spark, f"{hundred}/_versions/{2:012d}.json")
    fs.create(torn, False).close()  # a version that was begun and never described
    assert versions.versions(spark, hundred) == [1]
    assert versions.upsert(batch, hundred, ["k"], ["v"]) == 3
    assert versions.vacuum(spark, hundred) >= 2
    assert versions.read(spark, hundred).agg(F.sum("v")).first()[0] == 10_069 and versions.versions(spark, hundred) == [3]


def test_cells_split_as_the_table_grows(spark, path, monkeypatch):
    monkeypatch.setattr(versions, "CELL_ROWS", 50)
    want = {}
    for step in range(6):
        rows = [(f"k{k}", k % 7, step) for k in range(step * 100, step * 100 + 200)]
        want |= {r[0]: r[1:] for r in rows}
        versions.upsert(spark.createDataFrame(rows, "k string, a int, at int"), path, ["k"], ["at"])
    found = versions.manifest(spark, path).collect()
    assert max(r.n for r in found) <= 100 and len({(r.depth, r.cell) for r in found}) == len(found) > 7
    assert {r.k: (r.a, r.at) for r in versions.read(spark, path).collect()} == want


def test_order_nulls_empty_and_wider_types(spark, path):
    versions.upsert(spark.createDataFrame([(1, "old", 1), (1, "new", 2), (None, "x", 1)], "k int, v string, at int"), path, ["k"], ["at"], mark="at")
    versions.upsert(spark.createDataFrame([(1, "late", 1), (2, "b", 1)], "k long, v string, at int"), path, ["k"], ["at"], newest=True, mark="at")
    assert rows_of(versions.read(spark, path)) == [(1, "new", 2), (2, "b", 1)]
    before = names(spark, path)
    assert versions.upsert(spark.createDataFrame([], "k long, v string, at int"), path, ["k"], ["at"]) == 3 and names(spark, path) == before
    assert spark.range(1).select(versions.highest_mark(spark, path, "int")).first()[0] == 2
    with pytest.raises(ValueError):
        versions.upsert(spark.createDataFrame([(1,)], "k int"), path, ["k"], [])
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path + "-none")
    empty = path + "-empty"
    versions.upsert(spark.createDataFrame([], "k long, at int"), empty, ["k"], ["at"])
    assert versions.read(spark, empty).count() == 0
    versions.upsert(spark.createDataFrame([(1, 1)], "k long, at int"), empty, ["k"], ["at"])
    assert rows_of(versions.read(spark, empty)) == [(1, 1)]


def test_an_incremental_load_begins_at_the_stored_mark(spark, path):
    job = ingest.Mirror(rename={"Id": "ID"}, keys=["ID"], watermark="JSID")
    first = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "Id int, JSID long, v string")
    assert ingest.load_incremental(first, path, job) == 1
    again = spark.createDataFrame([(1, 5, "not read: below the mark"), (2, 20, "b2"), (3, 30, "c"), (3, 31, "c2")], "Id int, JSID long, v string")
    assert ingest.load_incremental(again, path, job) == 2
    assert rows_of(ingest.read_dataset(spark, path).select("ID", "JSID", "v")) == [(1, 10, "a"), (2, 20, "b2"), (3, 31, "c2")]


def test_corrections_are_taken_back_and_added(spark, path, monkeypatch):
    """A corrected row changes the groups it left and came to; a batch that runs again changes nothing."""
    from navloom.streaming import jobs

    raw, daily = f"{path}/raw", f"{path}/daily"
    schema = "id int, d string, v double"
    each = lambda: jobs.late_deltas(raw, daily, ["id"], ["d"], {"S": F.col("v")})
    state = lambda: {r.d: (r.N, r.S) for r in versions.read(spark, daily).collect()}
    each()(spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0), (3, "b", 3.0)], schema), 0)
    assert state() == {"a": (2, 3.0), "b": (1, 3.0)}
    second = spark.createDataFrame([(2, "b", 5.0), (4, "c", 4.0), (1, "a", None)], schema)
    real = versions.upsert

    def dies(batch, where, *args, **named):
        if where == raw:
            raise RuntimeError("lost between the two tables")
        return real(batch, where, *args, **named)

    monkeypatch.setattr(versions, "upsert", dies)
    with pytest.raises(RuntimeError):
        each()(second, 1)
    monkeypatch.setattr(versions, "upsert", real)
    want = {"a": (1, 0.0), "b": (2, 8.0), "c": (1, 4.0)}
    assert state() == want
    each()(second, 1)
    each()(second, 1)
    assert state() == want and versions.read(spark, raw).count() == 4
    each()(spark.createDataFrame([(1, "b", 1.5)], schema), 2)
    assert state() == {"a": (0, 0.0), "b": (3, 9.5), "c": (1, 4.0)}
    asked = spark.createDataFrame([(3,), (9,)], "id int")
    assert rows_of(versions.lookup(asked, raw, ["id"])) == [(3, "b", 3.0)]
