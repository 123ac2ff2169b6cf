"""The prefix trie against a trie of tuples in memory."""

import hashlib
import random
import zlib

import pytest

from docketry.llm import prefix_trie
from docketry.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def in_order(turns):
    convs = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            convs.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()[:16]))
        out[conv] = [r[1:] for r in rows]
    return out


def rebuilt(convs):
    out = {}
    for c, rows in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - c % 5, [])[:h] + rows[h:]
    return out


def brute(convs):
    members = {}
    for c, rows in convs.items():
        for d in range(len(rows) + 1):
            members.setdefault(tuple(rows[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[b] for b in below) if below else 1
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        saved[path] = own + sum(saved[b] for b in below)
        ends = ",".join(map(str, sorted(c for c in members[path] if len(convs[c]) == len(path))))
        out.append((
            min(members[path]), len(path), min(members[path[:-1]]) if path else None, len(members[path]), len(below),
            leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def told(frame):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)


def made_up(seed):
    rng = random.Random(seed)
    says = ["a", "b", "é漢", "", None, "long text " * 5]
    turns = [
        (conv, rng.choice([None, t, t, t]), rng.choice(["user", "assistant", None]), rng.choice(says[: 1 + conv % 6]))
        for conv in [*range(40), 77, 200] for t in range(rng.choice([1, 2, 3, 9, 12]))
    ]
    turns += [(None, 1, "user", "x"), (None, None, None, None)]
    turns += [(50 + c, t, "user", f"shared {t}") for c in range(25) for t in range(6)]  # copies
    turns += [(90 + c, t, "user", f"shared {t}" if t < 10 else f"own {c}") for c in range(12) for t in range(10 + c)]
    return turns + [(120, t, "user", str(t % 7)) for t in range(60)]  # a long one


@pytest.mark.parametrize("first, widest, wide", [(8, 512, 400_000), (2, 4, 40), (1, 1, 1)])
def test_nodes_are_those_of_a_trie_in_memory(spark, first, widest, wide):
    turns = made_up(first)
    if first == 1:
        turns = [t for t in turns if t[0] is not None and t[0] != 120 and (t[1] or 0) < 12]
    frame = spark.createDataFrame([(*t, "x", "y") for t in turns], SCHEMA + ", n string, node string").repartition(3)
    hashed = prefix_trie.hashed_turns(frame)
    assert told(prefix_trie.build(hashed, first, widest, wide)) == brute(in_order(turns))


def test_rebuilt_conversations(spark):
    turns = made_up(4)
    hashed = prefix_trie.hashed_turns(spark.createDataFrame(turns, SCHEMA))
    assert told(prefix_trie.build(prefix_trie.rebuild(hashed))) == brute(rebuilt(in_order(turns)))


def test_tables_without_turns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(empty).collect() == []
    # Conversations that are there, but keep no turn, are members of the root.
    bare = spark.createDataFrame([(7, None, None, None), (3, None, None, None)], "conv_id long, n long, link binary, bytes long")
    assert told(prefix_trie.build(bare)) == brute({7: [], 3: []})


def test_whole_table(spark, sf):
    turns = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert told(QUERIES["op12_prefix_trie"](spark, sf)) == brute(rebuilt(in_order(turns)))
