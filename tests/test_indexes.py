"""Indexes on small fixtures, against plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.functions.vector import similarity
from docketry.operators import lexical, vectors
from docketry.plans import sizes, tables
from docketry.session import new_work_dir

TEXTS = {
    "a": "the court held the claim",
    "b": "The appeal, the appeal and the court!",
    "c": "nothing here",
    "d": "",
    "e": "the the the the",
}


def bm25(texts, query, k1=1.2, b=0.75):
    docs = {i: re.findall(r"\w+", t.lower()) for i, t in texts.items()}
    n, avgdl = len(docs), sum(map(len, docs.values())) / len(docs)
    df = Counter(w for words in docs.values() for w in set(words))
    idf = {w: math.log(n - f + 0.5) - math.log(f + 0.5) for w, f in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: floor if v < 0 else v for w, v in idf.items()}
    scores = {}
    for i, words in docs.items():
        tf = Counter(words)
        hits = [w for w in re.findall(r"\w+", query.lower()) if w in tf]
        if hits:
            scores[i] = sum(
                idf[w] * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(words) / avgdl)) for w in hits
            )
    return idf, scores


def check_lexical(index, spark, texts):
    asked = {1: "The court court appeal unknown", 2: "  ", 3: "the"}
    queries = spark.createDataFrame(list(asked.items()), "query_id int, text string")
    got = {}
    for r in lexical.search_lexical(index, queries, k=10).collect():
        got.setdefault(r["query_id"], {})[r["chunk_id"]] = r["score"]
    for number, query in asked.items():
        idf, want = bm25(texts, query)
        assert got.get(number, {}) == pytest.approx(want)
    assert {r["term"]: r["idf"] for r in index.term_stats.collect()} == pytest.approx(idf)


def chunks(spark, texts):
    return spark.createDataFrame(list(texts.items()), "chunk_id string, content string")


def test_lexical_index_in_memory(spark):
    check_lexical(lexical.index_from(lexical.chunk_terms(chunks(spark, TEXTS))), spark, TEXTS)


def test_lexical_search_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(lexical, "is_small", lambda df: False)
    check_lexical(lexical.index_from(lexical.chunk_terms(chunks(spark, TEXTS))), spark, TEXTS)


def test_stored_lexical_index_appends_replaces_and_removes(spark):
    path = new_work_dir(spark, "lexical")
    assert lexical.load_lexical_index(spark, path) is None
    assert lexical.lexical_index_stats(None, spark).first()["index_exists"] is False
    lexical.build_lexical_index(spark, chunks(spark, TEXTS), path, buckets=4)
    check_lexical(lexical.load_lexical_index(spark, path), spark, TEXTS)
    # A new chunk, a changed one, and one that loses all its words.
    second = {"f": "a court of appeal", "a": "claim claim", "e": "..."}
    lexical.build_lexical_index(spark, chunks(spark, second), path, buckets=4)
    now = {**TEXTS, **second}
    check_lexical(lexical.load_lexical_index(spark, path), spark, now)
    # Once more with nothing new: the same again.
    lexical.build_lexical_index(spark, chunks(spark, second), path, buckets=4)
    check_lexical(lexical.load_lexical_index(spark, path), spark, now)
    removed = chunks(spark, {"b": ""}).select("chunk_id")
    lexical.build_lexical_index(spark, chunks(spark, {"g": "the claim"}), path, buckets=4, removed=removed)
    now["g"] = "the claim"
    del now["b"]
    check_lexical(lexical.load_lexical_index(spark, path), spark, now)


def stop_after(monkeypatch, name):
    """Make the write of one of the index's tables the last thing a build does."""
    write = lexical.tables.write_batch

    def stopping(df, path, *args, **kwargs):
        folder = write(df, path, *args, **kwargs)
        if path.endswith(name):
            raise RuntimeError("stopped")
        return folder

    monkeypatch.setattr(lexical.tables, "write_batch", stopping)


@pytest.mark.parametrize("name", ["postings", "doc_len"])
def test_a_build_that_stopped_and_runs_again_equals_a_fresh_one(spark, monkeypatch, name):
    path = new_work_dir(spark, "lex")
    first = dict(list(TEXTS.items())[:3])
    second = {"a": "quite new words", "z": "the claim again"}
    lexical.build_lexical_index(spark, chunks(spark, first), path, 0)
    with monkeypatch.context() as patched:
        stop_after(patched, name)
        with pytest.raises(RuntimeError):
            lexical.build_lexical_index(spark, chunks(spark, second), path, 1)
    if name == "postings":
        # Half a batch is not seen.
        check_lexical(lexical.load_lexical_index(spark, path), spark, first)
    lexical.build_lexical_index(spark, chunks(spark, second), path, 1)
    check_lexical(lexical.load_lexical_index(spark, path), spark, {**first, **second})


def test_compaction_loses_nothing(spark, monkeypatch):
    path = new_work_dir(spark, "lex")
    lexical.build_lexical_index(spark, chunks(spark, TEXTS), path)
    more = {"z": "the claim again", next(iter(TEXTS)): "changed"}
    lexical.build_lexical_index(spark, chunks(spark, more), path)
    with monkeypatch.context() as patched:
        stop_after(patched, "postings")
        with pytest.raises(RuntimeError):
            lexical.compact_index(spark, path)
    check_lexical(lexical.load_lexical_index(spark, path), spark, {**TEXTS, **more})
    lexical.compact_index(spark, path)
    check_lexical(lexical.load_lexical_index(spark, path), spark, {**TEXTS, **more})


def test_the_last_of_repeated_ids_wins(spark):
    path = new_work_dir(spark, "vec")
    rows = [(1, [1.0], "a", "old"), (1, [2.0], "a", "mid"), (2, [3.0], "b", "b"), (1, [4.0], "a", "new")]
    points = spark.createDataFrame(rows, "point_id long, vector array<float>, chunk_id string, content string").coalesce(1)
    vectors.upsert_vectors(spark, points, path)
    got = vectors.read_vectors(spark, path).orderBy("point_id").collect()
    assert [(r["point_id"], r["content"]) for r in got] == [(1, "new"), (2, "b")]


def test_search_reads_only_the_buckets_of_its_terms(spark):
    path = new_work_dir(spark, "lexical")
    lexical.build_lexical_index(spark, chunks(spark, TEXTS), path, buckets=4)
    index = lexical.load_lexical_index(spark, path)
    wanted = spark.createDataFrame([(1, "court", 1)], "query_id int, term string, qtf int")
    plan = lexical._reachable(index, wanted)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*term_bucket", plan)


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(7)
    data = rng.normal(size=(300, 8)).astype(np.float32)
    data[100:200] = data[5]  # a third of all points are copies of one
    data[299] = 0
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(data)]
    rows.append((900, [1.0, 2.0]))  # wrong length
    return data, spark.createDataFrame(rows, "point_id bigint, vector array<float>").repartition(5)


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclid"])
@pytest.mark.parametrize("bound", [10**9, 1])
def test_dense_search_is_exact(spark, points, metric, bound):
    data, table = points
    asked = np.vstack([data[5], data[17], -data[40]])
    queries = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(asked)], "query_id int, vector array<double>"
    )
    got = vectors.search_dense(table, queries, k=12, metric=metric.upper(), max_query_bytes=bound, tile_rows=50)
    got = sorted((r["query_id"], r["rank"], r["point_id"]) for r in got.collect())
    d, q = data.astype(float), asked.astype(float)
    if metric == "euclid":
        cost = np.sqrt(((q[:, None] - d[None]) ** 2).sum(-1))
    else:
        cost = -(q @ d.T)
        if metric == "cosine":
            lengths = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(d, axis=1)[None]
            cost = np.divide(cost, lengths, out=np.zeros_like(cost), where=lengths > 0)
    want = []
    for i in range(3):
        order = np.lexsort((np.arange(300), np.round(cost[i], 6)))[:12]
        want += [(i, r + 1, int(p)) for r, p in enumerate(order)]
    assert got == want


def test_similarity_expressions(spark):
    a, b = [1.0, 2.0, 2.0], [2.0, 0.0, 1.0]
    df = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    got = df.select(*[similarity(F.col("a"), F.col("b"), m).alias(m) for m in ("cosine", "dot", "euclid", "odd")]).first()
    assert got["dot"] == 4.0
    assert got["cosine"] == got["odd"] == pytest.approx(4 / (3 * math.sqrt(5)))
    assert got["euclid"] == pytest.approx(math.sqrt(6))


def some_chunks(spark, names):
    rows = [(n, n.upper(), "s", 0, i, [float(i), 1.0]) for i, n in enumerate(names)]
    return spark.createDataFrame(
        rows, "chunk_id string, content string, source string, section_ix int, chunk_ix int, vector array<double>"
    )


def test_vector_index_life_cycle(spark):
    path = new_work_dir(spark, "vectors")
    assert vectors.read_vectors(spark, path) is None

    def ids():
        return {r["chunk_id"]: r["point_id"] for r in vectors.read_vectors(spark, path).collect()}

    vectors.write_vectors(spark, some_chunks(spark, "abc"), path)
    assert ids() == {"a": 0, "b": 1, "c": 2}
    gone = spark.createDataFrame([(0,), (77,)], "point_id bigint")
    vectors.delete_vectors(spark, gone, path)
    # The next ids follow the highest one, so nothing is overwritten.
    vectors.write_vectors(spark, some_chunks(spark, "bde"), path)
    assert ids() == {"b": 1, "c": 2, "d": 3, "e": 4}
    one = vectors.read_vectors(spark, path).where("point_id = 3").withColumn("content", F.lit("new"))
    vectors.upsert_vectors(spark, one, path)
    vectors.upsert_vectors(spark, one, path)
    assert vectors.read_vectors(spark, path).where("content = 'new'").count() == 1
    before = sorted(map(str, vectors.read_vectors(spark, path).collect()))
    tables.compact(spark, path, ["point_id"])
    assert sorted(map(str, vectors.read_vectors(spark, path).collect())) == before
    stats = vectors.index_stats(vectors.read_vectors(spark, path)).first()
    assert (stats["chunks_count"], stats["dimension"]) == (4, 2)
    assert vectors.drop_index(spark, path)
    assert vectors.read_vectors(spark, path) is None


def test_point_ids_follow_the_order_across_partitions(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string")).alias("source"), "id"
    ).repartition(7)
    got = vectors.assign_point_ids(rows, ["source", "id"], offset=10).collect()
    want = sorted((r["source"], r["id"]) for r in got)
    assert [(r["source"], r["id"]) for r in sorted(got, key=lambda r: r["point_id"])] == want
    assert sorted(r["point_id"] for r in got) == list(range(10, 1010))


def test_join_of_hot_keys_is_whole_with_and_without_salt(spark):
    big = spark.range(300).select(
        F.when(F.col("id") < 100, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    other = spark.createDataFrame([("hot", 1), ("hot", 2), ("150", 3), ("none", 4)], "k string, v int")
    plain = sorted(map(tuple, big.join(other, "k").collect()))
    for small in (True, False):
        assert sorted(map(tuple, sizes.join_hot_key(big, other, "k", "id", small).collect())) == plain
