"""Exact and near duplicates, filters and components, against brute force."""

import hashlib
import random
import re
from collections import Counter
from urllib.parse import unquote

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from docketry.llm import common, exact_dedup, fuse_filter, near_dedup
from docketry.llm.components import components
from llm_cases import prose


def spaceless(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def shingles(text, k):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k, 0) + 1)} if w else set()


def linked(sets, percent=80):
    """Smallest index reachable over pairs that are similar enough."""
    parent = list(range(len(sets)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(len(sets))]


def near_cases():
    """Groups at all distances around the threshold, and documents that share a passage."""
    rng = random.Random(4)
    rows = []
    for group in range(6):
        base = prose(rng, 6).split()
        for copy in range(14):
            words = list(base)
            for _ in range(copy):
                words[rng.randrange(len(words))] = f"w{rng.random()}"
            rows.append(" ".join(words))
    passage = prose(rng, 5)
    rows += [passage + " " + prose(rng, n) for n in (1, 1, 2, 2, 3, 4)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_equal_brute_force(spark, words):
    rows = near_cases()
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), near_dedup.Rule(words)).collect()
    sets = [shingles(t, words) for _, t in rows]
    want = linked(sets)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        i: (len(sets[i]), want[i], want[i] == i) for i in range(len(rows))
    }


def test_a_family_below_the_limit_and_hubs(spark, monkeypatch):
    """A template whose copies are about 0.6 to 0.85 alike, with every key a hub and every bucket dealt."""
    monkeypatch.setattr(common, "is_small", lambda df: False)
    monkeypatch.setattr("docketry.llm.components.is_small", lambda df: False)
    monkeypatch.setattr(common, "HUB_ROWS", 3)
    monkeypatch.setattr(near_dedup, "PAIR_ROWS", 5)
    rng = random.Random(9)
    base, rows = prose(rng, 12).split(), []
    for i in range(90):
        words = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 5])):
            words[rng.randrange(len(words))] = f"w{rng.random()}"
        rows.append((i, " ".join(words + [f"v{rng.random()}" for _ in range(rng.randrange(6))])))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = linked([shingles(t, 5) for _, t in rows])
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(want))
    assert 3 < len(set(want)) < 87


def test_what_cannot_be_linked_in_a_bucket_goes(spark):
    rows = [(1, 7, 100, 84), (1, 8, 95, 84), (1, 9, 96, 96), (2, 7, 100, 84), (2, 10, 84, 84)]
    met = near_dedup._linkable(spark.createDataFrame(rows, "key long, node long, n long, shared long"), 80).collect()
    assert {(r["key"], r["node"], r["members"]) for r in met} == {(1, 9, 3), (2, 7, 2), (2, 10, 2)}


def test_near_duplicates_of_odd_rows(odd):
    got = near_dedup.near_duplicates(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for empty_id in (4, 5, 6):
        assert (by[empty_id][0]["n_shingles"], by[empty_id][0]["component_id"], by[empty_id][0]["kept"]) == (0, empty_id, True)
    assert {r["component_id"] for i in (1, 2, 3, 13) for r in by[i]} == {1}
    assert by[11][0]["component_id"] == 10 and by[8][0]["component_id"] == 7
    assert {r["component_id"] for r in by[None]} == {1, None}
    kept = near_dedup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 4, 5, 6, None, 7, 9, 10, 12, 14, 15])


@pytest.mark.parametrize("percent", [0, 50, 79, 101])
def test_a_rule_that_would_lose_links_is_an_error(percent):
    with pytest.raises(ValueError, match="percent"):
        near_dedup.Rule(percent=percent)
    assert [near_dedup.Rule(percent=p).percent for p in (80, 100)] == [80, 100]


def test_a_chunk_with_one_error_always_shares_a_key(spark):
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 16, near_dedup.SYMBOLS)
    rows = [(0, a.tolist())]
    for i in range(1, 30):
        b = a.copy()
        # At most two errors a chunk, and one in at least one of them: the pigeonhole's worst case.
        for c in range(near_dedup.CHUNKS):
            at = rng.choice(near_dedup.WIDTH, 1 if c == i % near_dedup.CHUNKS else 2, replace=False)
            b[c * near_dedup.WIDTH + at] ^= 1
        rows.append((i, b.tolist()))
    keys = spark.createDataFrame(rows, "node long, sig array<int>").select("node", F.explode(near_dedup._keys()).alias("key")).collect()
    own = {r["key"] for r in keys if r["node"] == 0}
    assert {r["node"] for r in keys if r["key"] in own} == set(range(30))


def test_exact_duplicates_equal_brute_force(spark, odd):
    rows = [r for r in odd.select("doc_id", "text").collect() if r["doc_id"] is not None]
    rng = random.Random(2)
    rows += [(100 + i, " ".join(rng.choice(["a b", "ab", "a\tb ", "c", ""]) for _ in range(2))) for i in range(60)]
    docs = spark.createDataFrame([tuple(r) for r in rows], "doc_id long, text string")
    groups = {}
    for i, t in rows:
        groups.setdefault(spaceless(t), []).append((-len(t or ""), i))
    want = Counter()
    for i, t in rows:
        key = spaceless(t)
        best = min(groups[key])[1]
        want[(i, best, len(groups[key]), hashlib.sha256(key.encode()).hexdigest())] += 1
    got = exact_dedup.exact_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    # Exactly one row of each group stays, a repeated id or not.
    assert sum(r["kept"] for r in got) == len(groups)


def test_exact_dedup_keeps_columns_and_one_row_a_group(odd):
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    texts = [spaceless(r["text"]) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({spaceless(r["text"]) for r in odd.collect()})


def test_several_snapshots(spark):
    def table(rows, n):
        return exact_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string"), n)

    old = [exact_dedup.snapshot(table([(1, "a"), (2, "b"), (3, "a")], 1)), exact_dedup.snapshot(table([(4, "b"), (5, "c")], 2))]
    everything, found = exact_dedup.group(table([(6, "a "), (7, "d"), (8, "d"), (9, "e")], 0), old)
    ids = {r["row"]: r["id"] for r in everything.collect()}
    assert {(ids[r["row"]], r["keep_id"], r["group_size"]) for r in found.collect()} == {
        (1, 6, 3), (3, 6, 3), (6, 6, 3), (2, 2, 2), (4, 2, 2), (7, 7, 2), (8, 7, 2),
    }


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 60_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    made = fuse_filter.build(np.concatenate([keys, keys]))
    assert fuse_filter.contains(made, keys).all()
    others = rng.integers(0, 1 << 63, 50_000, dtype=np.uint64) | np.uint64(1 << 63)
    assert fuse_filter.contains(made, others).mean() < 0.02
    assert n < 1000 or len(made) < 2 * n


@pytest.mark.parametrize("hubs", [False, True])
def test_components(spark, monkeypatch, hubs):
    if hubs:
        monkeypatch.setattr(common, "is_small", lambda df: False)
        monkeypatch.setattr("docketry.llm.components.is_small", lambda df: False)
        monkeypatch.setattr(common, "HUB_ROWS", 5)
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(400, i) for i in range(401, 460)]
    edges += [(500 + i, 501 + i) for i in range(40)] + [(7, 7)]
    parent = {}

    def root(a):
        while parent.setdefault(a, a) != a:
            a = parent[a]
        return a

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: root(n) for a, b in edges if a != b for n in (a, b)}


def test_empty_tables(empty):
    for fn in (near_dedup.near_duplicates, near_dedup.drop_near_duplicates, exact_dedup.exact_duplicates, exact_dedup.drop_exact_duplicates):
        assert fn(empty).collect() == []


def test_copies_of_the_texts_are_stored_with_zstd(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, None)], "doc_id bigint, text string")
    for made in (near_dedup.sketch(docs), exact_dedup.digests(docs, 0)):
        for file in made.inputFiles():
            meta = pq.ParquetFile(unquote(file.removeprefix("file://"))).metadata
            kinds = {meta.row_group(g).column(c).compression for g in range(meta.num_row_groups) for c in range(meta.num_columns)}
            assert kinds <= {"ZSTD"}
