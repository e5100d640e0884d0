"""Ingest, readers and streams over several files."""

import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from navloom.session import shared_dir
from navloom.sources import ingest, readers
from navloom.streaming import jobs


@pytest.fixture()
def fresh(spark):
    return lambda: f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"


def test_id_ranges_cover_without_overlap():
    ranges = readers.id_ranges("JSID", 1, 1_200_000)
    assert ranges == ["JSID BETWEEN 1 AND 500000", "JSID BETWEEN 500001 AND 1000000", "JSID BETWEEN 1000001 AND 1200000"]
    assert readers.partition_options("JSID", 1, 10) == {"partitionColumn": "JSID", "lowerBound": "1", "upperBound": "10", "numPartitions": "16"}


def test_stored_predicate_spelling():
    assert readers.predicate_sql('LEVEL_1 == "x" and A > 1') == "LEVEL_1 = 'x' and A > 1"


def test_clean_headers(spark):
    assert readers.clean_headers(spark.createDataFrame([(1, 2)], "` Trade Date ` int, `Net. (CNY)` int")).columns == ["trade_date", "net_cny"]


def test_update_touches_only_its_partitions(spark, fresh):
    path = fresh()
    base = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 1.0), ("b", 1, 1.0)], "k string, d int, v double")
    ingest.write_dataset(base, path, ["d"], "overwrite")
    ingest.write_dataset(spark.createDataFrame([("a", 1, 5.0), ("c", 1, 6.0)], "k string, d int, v double"), path, ["d"], "update", ["k", "d"], order=["v"])
    got = sorted((r["k"], r["d"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [("a", 1, 5.0), ("a", 2, 1.0), ("b", 1, 1.0), ("c", 1, 6.0)]
    ingest.write_dataset(base.limit(0), path, ["d"], "skip")
    assert spark.read.parquet(path).count() == 4


def test_the_last_row_of_a_key_wins(spark, fresh):
    batch = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", 1), (1, "mid", 1)], "k int, v string, at int")
    stored = spark.createDataFrame([(1, "stored"), (3, "stored")], "k int, v string")
    merged = ingest.merge_rows(stored, batch, ["k"], ["at"]).select("k", "v")
    assert sorted(map(tuple, merged.collect())) == [(1, "new"), (2, "x"), (3, "stored")]
    kept = ingest.insert_missing(stored.limit(0), batch, ["k"], ["at", "v"])
    assert sorted(map(tuple, kept.collect())) == [(1, "mid"), (2, "x")]
    with pytest.raises(ValueError):
        ingest.merge_rows(stored, batch, ["k"], [])
    with pytest.raises(ValueError):
        ingest.write_dataset(batch, fresh(), action="update", keys=["k"])


def test_an_update_leaves_other_buckets_alone(spark, fresh):
    path = fresh()
    rows = spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    files = lambda: {r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()}
    ingest.copy_table(rows, path, ["k"], ["v"])
    before = files()
    ingest.copy_table(spark.createDataFrame([(5, 9)], "k long, v int"), path, ["k"], ["v"])
    gone = before - files()
    assert gone and len({f.split("/")[-2] for f in gone}) == 1 and {f.split("/")[-2] for f in before} == {f"{ingest.BUCKET}={k}" for k in range(8)}
    assert ingest.read_dataset(spark, path).agg(F.sum("v")).first()[0] == 208


def test_an_interrupted_change_is_finished(spark, fresh, monkeypatch):
    path = fresh()
    ingest.copy_table(spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("v")), path, ["k"], ["v"])
    real = ingest._replace

    def dies(rows, target, partition):
        ingest._remove(spark, target)  # as if the partitions were deleted and the job lost before the new ones came
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "_replace", dies)
    with pytest.raises(RuntimeError):
        ingest.copy_table(spark.range(50).select(F.col("id").alias("k"), F.lit(2).alias("v")), path, ["k"], ["v"])
    monkeypatch.setattr(ingest, "_replace", real)
    assert ingest.read_dataset(spark, path).agg(F.sum("v")).first()[0] == 100
    assert not ingest._exists(spark, ingest._note(path))


def test_watermark_on_an_empty_target_takes_everything(spark):
    src = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert ingest.after_watermark(src, "id", src.limit(0)).count() == 2
    assert ingest.after_watermark(src, "id", src.where("id = 2")).count() == 1


def test_normalise_removes_infinities(spark):
    out = ingest.normalise(spark.createDataFrame([(float("inf"), "inf"), (float("nan"), "x"), (1.0, "-Inf")], "v double, s string")).collect()
    assert [(r["v"], r["s"]) for r in out] == [(None, None), (None, "x"), (1.0, None)]


def _parts(spark, path, frames):
    for f in frames:
        spark.createDataFrame(f).coalesce(1).write.mode("append").parquet(path)


def test_upsert_stream_over_files_is_idempotent(spark, fresh):
    src, out, cp = fresh(), fresh(), fresh()
    _parts(spark, src, [pd.DataFrame({"k": [1, 2], "n": [1, 5], "v": ["a", "b"]}), pd.DataFrame({"k": [1, 2], "n": [2, 4], "v": ["c", "d"]})])
    for checkpoint in (cp, fresh()):  # a second run from scratch reads everything again
        jobs.run(jobs.file_stream(spark, src), checkpoint, jobs.upsert_latest(out, ["k"], ["n"]), "append")
        assert sorted((r["k"], r["v"]) for r in ingest.read_dataset(spark, out).collect()) == [(1, "c"), (2, "b")]


def test_stateful_drawdown_carries_the_high_over_batches(spark, fresh):
    src, out, cp = fresh(), fresh(), fresh()
    t = pd.to_datetime(["2024-01-01", "2024-01-02"])
    _parts(spark, src, [pd.DataFrame({"k": [1, 1], "t": t, "s": [1, 2], "v": [10.0, 8.0]})])
    stream = jobs.running_drawdown(jobs.file_stream(spark, src), "k", "t", "s", "v")
    jobs.run_to_files(stream, out, cp)
    _parts(spark, src, [pd.DataFrame({"k": [1, 1], "t": t + pd.Timedelta(days=5), "s": [3, 4], "v": [9.0, 12.0]})])
    jobs.run_to_files(stream, out, cp)
    got = {r["s"]: (r["HIGH"], round(r["DRAWDOWN"], 6)) for r in spark.read.parquet(out).collect()}
    assert got == {1: (10.0, 0.0), 2: (10.0, 0.2), 3: (10.0, 0.1), 4: (12.0, 0.0)}


def test_rows_in_any_order_give_the_rows_of_one_sorted_pass(spark, fresh):
    """Shuffled batches inside the delay; then rows beyond it are dropped, and an entity that was silent too long begins anew."""
    import random

    src, out, cp = fresh(), fresh(), fresh()
    rng = random.Random(3)
    start = pd.Timestamp("2024-01-01")
    rows = [(rng.choice("ab"), start + pd.Timedelta(hours=h), n, float(rng.randrange(50, 100))) for n, h in enumerate(rng.sample(range(96), 60))]
    columns = ["k", "t", "s", "v"]

    def load(part):
        frame = pd.DataFrame(part, columns=columns)
        _parts(spark, src, [frame.assign(t=frame["t"].dt.tz_localize("UTC"))])
        stream = jobs.corrected_drawdown(jobs.file_stream(spark, src, 1), "k", "t", "s", "v", delay="5 days", expiry_days=30)
        jobs.run(stream, cp, jobs.upsert_rows(out, ["k", "s"]))

    for cut in range(0, 60, 15):
        load(rows[cut : cut + 15])
    want = {}
    for k in "ab":
        high = 0.0
        for _, _, n, v in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
            high = max(high, v)
            want[n] = (high, round(1 - v / high, 9))
    got = lambda: {r.s: (r.HIGH, round(r.DRAWDOWN, 9)) for r in ingest.read_dataset(spark, out).collect()}
    assert got() == want
    load([("a", start + pd.Timedelta(days=20), 100, 60.0)])
    load([("a", start + pd.Timedelta(days=21), 101, 40.0), ("b", start, 102, 500.0)])  # the last one is weeks late
    high = max(v for k, _, _, v in rows if k == "a")
    assert got()[100] == (high, round(1 - 60 / high, 9)) and got()[101][0] == high and 102 not in got()
    load([("a", start + pd.Timedelta(days=90), 103, 30.0)])  # the watermark passes the expiry of b
    load([("a", start + pd.Timedelta(days=91), 104, 30.0)])
    load([("b", start + pd.Timedelta(days=92), 105, 10.0)])
    assert got()[105] == (10.0, 0.0) and got()[104][0] == high


@pytest.mark.parametrize("groups", [1, 3])
def test_entities_that_share_a_state_keep_apart(spark, fresh, groups):
    """Highs, corrections and expiry are those of each entity, also of one without a name, whatever the number of groups."""
    src, out, cp = fresh(), fresh(), fresh()
    day = lambda n: pd.Timestamp("2024-01-01", tz="UTC") + pd.Timedelta(days=n)
    found = {}

    def load(rows):
        _parts(spark, src, [pd.DataFrame(rows, columns=["k", "t", "s", "v"])])
        stream = jobs.corrected_drawdown(jobs.file_stream(spark, src, 1), "k", "t", "s", "v", delay="5 days", expiry_days=30, groups=groups)
        jobs.run(stream, cp, lambda batch, _: found.update({r.s: (r.k, r.HIGH, round(r.DRAWDOWN, 9)) for r in batch.collect()}))

    load([("a", day(1), 1, 80.0), ("b", day(1), 2, 10.0), (None, day(1), 3, 5.0), ("a", day(3), 4, 40.0)])
    load([("b", day(0), 5, 20.0), ("a", day(2), 6, 100.0), (None, day(2), 7, 4.0)])
    assert found == {1: ("a", 80.0, 0.0), 2: ("b", 20.0, 0.5), 3: (None, 5.0, 0.0), 4: ("a", 100.0, 0.6), 5: ("b", 20.0, 0.0), 6: ("a", 100.0, 0.0), 7: (None, 5.0, 0.2)}
    load([("a", day(25), 8, 50.0)])
    load([("a", day(50), 9, 50.0)])
    load([("a", day(51), 10, 50.0)])
    load([("b", day(52), 11, 1.0), ("a", day(52), 12, 50.0)])
    assert found[11] == ("b", 1.0, 0.0) and found[12] == ("a", 100.0, 0.5)


def test_late_correction_recomputes_the_touched_date(spark, fresh):
    src, base, cp = fresh(), fresh(), fresh()
    each = jobs.late_corrections(f"{base}/raw", f"{base}/daily", "d", ["id"], [], [F.sum("v").alias("s")])
    _parts(spark, src, [pd.DataFrame({"id": [1, 2, 3], "v": [1.0, 2.0, 3.0], "d": pd.to_datetime(["2024-01-01", "2024-01-01", "2024-01-02"]).date})])
    jobs.run(jobs.file_stream(spark, src), cp, each, "append")
    _parts(spark, src, [pd.DataFrame({"id": [2], "v": [10.0], "d": pd.to_datetime(["2024-01-01"]).date})])
    jobs.run(jobs.file_stream(spark, src), cp, each, "append")
    got = {str(r["d"]): r["s"] for r in spark.read.parquet(f"{base}/daily").collect()}
    assert got == {"2024-01-01": 11.0, "2024-01-02": 3.0}
