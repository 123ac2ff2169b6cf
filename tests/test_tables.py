"""Keyed tables: the commit log, buckets, compaction and who may write."""

import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from docketry.operators import ledger, lexical, vectors
from docketry.plans import log, tables
from docketry.plans.ingest import ingest_files
from docketry.session import new_work_dir


def rows(spark, known):
    return spark.createDataFrame(list(known.items()), "k long, v string")


def current(spark, path):
    found = tables.read_current(spark, path, ["k"])
    return None if found is None else {r["k"]: r["v"] for r in found.collect()}


def test_entries_are_claimed_once(spark):
    entries = log.Log(spark, new_work_dir(spark, "log"))
    assert entries.last() == (-1, None)
    for n in range(3):
        entries.commit(n, {"n": n})
    with pytest.raises(log.ConcurrentWrite):
        entries.commit(2, {"n": "other"})
    assert entries.last() == (2, {"n": 2})
    # A hint that lags behind, or was never written, only costs a few looks.
    entries._write(entries._hint(), "0", True)
    assert entries.last() == (2, {"n": 2})
    entries.fs.delete(entries._hint(), False)
    assert entries.last() == (2, {"n": 2})


def test_an_entry_that_was_claimed_but_not_filled_does_not_count(spark):
    entries = log.Log(spark, new_work_dir(spark, "log"))
    entries.commit(0, {"n": 0})
    entries.fs.create(entries._file(1), False).close()
    assert entries.last() == (0, {"n": 0})
    with pytest.raises(log.ConcurrentWrite):
        entries.commit(1, {"n": 1})


@pytest.mark.parametrize("buckets", [None, 4])
def test_of_two_writers_one_gets_an_error_and_changes_nothing(spark, monkeypatch, buckets):
    path = new_work_dir(spark, "table")
    tables.write_batch(rows(spark, {1: "a", 2: "b"}), path, 0, buckets=buckets, key=["k"])
    began = tables.state(spark, path)
    tables.write_batch(rows(spark, {2: "first"}), path, 1)
    with monkeypatch.context() as patched:  # a writer that read the log before the other was done
        patched.setattr(tables, "state", lambda *_: began)
        with pytest.raises(log.ConcurrentWrite):
            tables.write_batch(rows(spark, {2: "second", 3: "c"}), path, 1)
    assert current(spark, path) == {1: "a", 2: "first"}


@pytest.mark.parametrize("buckets", [None, 8])
def test_batches_against_a_dict(spark, buckets):
    """Upserts, removals, repeated batches, empty ones and compaction."""
    rng = random.Random(3)
    path, want = new_work_dir(spark, "table"), {}
    assert current(spark, path) is None
    for n in range(9):
        new = {rng.randrange(40): f"{n}-{i}" for i in range(rng.choice([0, 1, 12]))}
        gone = [k for k in want if k not in new and rng.random() < 0.2]
        batch = rows(spark, new).withColumn("deleted", F.lit(False)).unionByName(
            spark.createDataFrame([(k,) for k in gone], "k long").withColumn("deleted", F.lit(True)), allowMissingColumns=True
        )
        for _ in range(rng.choice([1, 2])):  # written again it counts once
            tables.write_batch(batch, path, n, buckets=buckets, key=["k"], top="k")
        want = {k: v for k, v in want.items() if k not in gone} | new
        assert current(spark, path) == want
        assert tables.next_batch(spark, path) == n + 1
        some = spark.createDataFrame([(k,) for k in range(0, 40, 3)], "k long")
        assert {r["k"]: r["v"] for r in tables.read_keys(spark, path, some).collect()} == {k: v for k, v in want.items() if k % 3 == 0}
        if n in (3, 4, 8):
            tables.compact(spark, path, ["k"])
            assert current(spark, path) == want and not tables.batches(spark, path, "delta")
            with pytest.raises(ValueError):
                tables.write_batch(batch, path, n)
    gone = rows(spark, want).select("k").withColumn("deleted", F.lit(True))
    tables.write_batch(gone, path, 9)
    assert current(spark, path) == {}
    tables.compact(spark, path, ["k"])
    assert current(spark, path) == {}


def test_a_small_upsert_touches_only_its_buckets(spark):
    path = new_work_dir(spark, "vectors")
    points = spark.range(2000).select(
        F.col("id").alias("point_id"), F.array(F.col("id").cast("float")).alias("vector"),
        F.col("id").cast("string").alias("chunk_id"), F.lit("old").alias("content"),
    )
    vectors.upsert_vectors(spark, points, path)
    ten = points.where("point_id < 3").withColumn("content", F.lit("new"))
    vectors.upsert_vectors(spark, ten, path)
    touched = {r["b"] for r in ten.select(tables.bucket_of(["point_id"], vectors.BUCKETS).alias("b")).collect()}

    def buckets_read(frame):
        return {int(f.split(f"{tables.BUCKET}=")[1].split("/")[0]) for f in frame.inputFiles()}

    found = vectors.read_points(spark, path, ten)
    assert {(r["point_id"], r["content"]) for r in found.collect()} == {(i, "new") for i in range(3)}
    assert buckets_read(found) == touched and len(touched) < vectors.BUCKETS
    before = {f.name for f in tables.state(spark, path).folders}
    tables.compact(spark, path, ["point_id"])
    now = tables.state(spark, path)
    # The new base has the touched buckets; the others stay in the files they are in.
    assert [sorted(f.parts) == sorted(touched) for f in now.folders if f.name not in before] == [True]
    kept = next(f for f in now.folders if f.name in before)
    assert not touched & set(kept.parts) and len(kept.parts) + len(touched) == vectors.BUCKETS
    whole = vectors.read_vectors(spark, path)
    assert whole.count() == 2000 and whole.where("content = 'new'").count() == 3


def test_the_highest_id_comes_from_the_log(spark):
    path = new_work_dir(spark, "vectors")

    def chunks(name, n):
        return spark.range(n).select(
            F.concat(F.lit(name), "id").alias("chunk_id"), F.lit(name).alias("source"), F.lit(0).alias("section_ix"),
            F.col("id").alias("chunk_ix"), F.lit("x").alias("content"), F.array(F.lit(1.0)).alias("vector"),
        )

    vectors.write_vectors(spark, chunks("a", 5), path)
    vectors.delete_vectors(spark, spark.createDataFrame([(4,), (3,)], "point_id long"), path)
    vectors.write_vectors(spark, chunks("b", 2), path)
    assert sorted(r["point_id"] for r in vectors.read_vectors(spark, path).collect()) == [0, 1, 2, 5, 6]
    assert tables.state(spark, path).top == {"point_id": 6}


def test_folders_no_late_entry_names_are_removed(spark, monkeypatch):
    path = new_work_dir(spark, "table")
    for n in range(6):
        tables.write_batch(rows(spark, {n: "x"}), path, n)
    old = {f.name for f in tables.state(spark, path).folders}
    tables.compact(spark, path, ["k"])
    stray = f"{path}/delta=9xwriting"
    rows(spark, {9: "y"}).write.parquet(stray)
    assert tables.vacuum(spark, path) == []
    tables.write_batch(rows(spark, {7: "x"}), path, 7)
    assert set(tables.vacuum(spark, path, 2)) == old
    assert current(spark, path) == {**{n: "x" for n in range(6)}, 7: "x"}
    assert tables.exists(spark, stray)


def test_many_batches_cost_no_more_than_a_few(spark):
    """200 small commits: the log is read, no folder listed, so the last costs what the tenth does."""
    path, spent = new_work_dir(spark, "table"), []
    for n in range(200):
        begun = time.perf_counter()
        now = tables.state(spark, path)
        name = f"delta={n}x{n}"
        tables._commit(spark, path, tables.replace(now, folders=[*now.folders, tables.Folder(n, "delta", name)][-32:], last=n))
        assert tables.next_batch(spark, path) == n + 1
        spent.append(time.perf_counter() - begun)
    assert sorted(spent[-20:])[10] < 3 * sorted(spent[5:25])[10] + 0.05


def test_a_second_run_is_refused_until_the_first_is_over(spark):
    out = new_work_dir(spark, "ingest")
    files = spark.createDataFrame([("a.txt", b"one two three")], "file_name string, content binary")
    runs = log.Runs(spark, f"{out}/_runs")
    runs.begin("one", 0)
    with pytest.raises(log.ConcurrentWrite, match="'one'"):
        ingest_files(spark, files, out, "two")
    assert not tables.exists(spark, f"{out}/runs") and not tables.exists(spark, f"{out}/documents")
    assert runs.begin("one", 5) == 0  # the run itself may go on
    runs.end("one", "failed")
    assert runs.begin("two", 0) == 1
    assert runs.begin("three", 0, take_over=True) == 2
    with pytest.raises(log.ConcurrentWrite):
        runs.end("two", "done")


# --- blocks of the lexical index ------------------------------------------------------


def _words(rng, n):
    common, rare = ["the", "of", "and", "to"], [f"w{i}" for i in range(400)]
    return " ".join(rng.choice(common if rng.random() < 0.5 else rare) for _ in range(n))


def test_block_search_gives_the_hits_of_a_full_search(spark):
    rng = random.Random(8)
    texts = {f"c{i}": _words(rng, rng.randrange(1, 60)) for i in range(1200)}
    path = new_work_dir(spark, "lexical")
    frame = spark.createDataFrame(list(texts.items()), "chunk_id string, content string").repartition(2)
    lexical.build_lexical_index(spark, frame, path, buckets=4)
    changed = {f"c{i}": _words(rng, 5) for i in range(0, 60, 2)} | {"c1": "..."}
    lexical.build_lexical_index(spark, spark.createDataFrame(list(changed.items()), "chunk_id string, content string"), path)
    texts |= changed
    asked = {1: "the", 2: "of of and", 3: "w1 w2 the", 4: "w399", 5: _words(rng, 30), 6: "unknown", 7: "the of and to"}
    queries = spark.createDataFrame(list(asked.items()), "query_id int, text string")
    plain = lexical.index_from(lexical.chunk_terms(spark.createDataFrame(list(texts.items()), "chunk_id string, content string")))

    def hits(index, k):
        found = lexical.search_lexical(index, queries, k=k).collect()
        return {(r["query_id"], r["rank"]): (r["chunk_id"], pytest.approx(r["score"], abs=1e-6)) for r in found}

    for compacted in (False, True):
        if compacted:
            lexical.compact_index(spark, path)
        stored = lexical.load_lexical_index(spark, path)
        assert stored.bounds is not None
        for k in (1, 10, 2000):
            assert hits(stored, k) == hits(plain, k)
    # Of a common word fewer than half of the blocks are read.
    common = queries.where("query_id = 1")
    search = lexical.search_blocks(lexical._Asked.of(stored, common, 1.2, 0.75, "text"), 10)
    assert search.first.count() + search.rest.count() < search.blocks.count() / 2


# --- snapshots of the ledger -----------------------------------------------------------


def test_snapshot_and_tail_give_the_state_of_all_events(spark):
    rng, path = random.Random(5), new_work_dir(spark, "ledger")
    assert ledger.stored_state(spark, path).collect() == []

    def rows(frame):
        return sorted(map(tuple, frame.select("file_name", "ingested", "ingested_at", "reset_at").collect()))

    for n in range(14):
        # Times repeat, go back, and some runs are written twice.
        events = [(f"f{rng.randrange(12)}", rng.random() < 0.6, datetime(2024, 1, 1, 0, rng.randrange(40))) for _ in range(5)]
        frame = spark.createDataFrame(events, "file_name string, ingested boolean, event_ts timestamp")
        frame = frame.groupBy("file_name").agg(F.max_by("ingested", "event_ts").alias("ingested"), F.max("event_ts").alias("event_ts"))
        for _ in range(rng.choice([1, 2])):
            ledger.append_events(frame, path, f"run-{n:02}", rng.choice([ledger.INGESTED, ledger.RESET]))
        if n % 3 == 2:
            assert rows(ledger.stored_state(spark, path, 4)) == rows(ledger.ledger_state(ledger.read_ledger(spark, path)))
    _, told = ledger._log(spark, path).last()
    assert told["snapshot"] and len(told["tail"]) < 8
    # Later reads take the snapshot and the folders after it, not the whole log.
    tail = {f.split("run_id=")[1].split("/")[0] for f in ledger.stored_state(spark, path).inputFiles() if "run_id=" in f}
    assert tail == {f.split("/")[0].removeprefix("run_id=") for f in told["tail"]}


def test_runs_that_add_events_at_a_time_lose_none(spark, monkeypatch):
    path = new_work_dir(spark, "ledger")
    frame = spark.createDataFrame([("a", True, datetime(2024, 1, 1))], "file_name string, ingested boolean, event_ts timestamp")
    ledger.append_events(frame, path, "one")
    commit, lost = log.Log.commit, []

    def race(self, version, told):
        if not lost:
            lost.append(version)
            commit(self, version, {"snapshot": None, "tail": ["run_id=one/kind=ingested", "run_id=other/kind=ingested"]})
        commit(self, version, told)

    monkeypatch.setattr(log.Log, "commit", race)
    ledger.append_events(frame, path, "two")
    assert ledger._log(spark, path).last()[1]["tail"] == [f"run_id={r}/kind=ingested" for r in ("one", "other", "two")]


def test_points_without_a_vector_get_that_of_their_text(spark):
    path, seen = new_work_dir(spark, "vectors"), []

    def embedder(df):
        seen.extend(r["point_id"] for r in df.collect())
        return df.withColumn("vector", F.array(F.length("content").cast("float")))

    rows = [(1, "one", [7.0]), (2, "three", None), (3, "x", [9.0]), (3, "four", None)]
    points = spark.createDataFrame([(i, str(i), c, v) for i, c, v in rows], "point_id long, chunk_id string, content string, vector array<float>")
    vectors.upsert_vectors(spark, points.coalesce(1), path, embedder)
    assert {r["point_id"]: r["vector"] for r in vectors.read_vectors(spark, path).collect()} == {1: [7.0], 2: [5.0], 3: [4.0]}
    assert set(seen) == {2, 3}
