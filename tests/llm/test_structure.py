"""Repair of conversations against a plain recursion over all edits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from docketry.llm import ordering, structure_repair
from docketry.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = set(" \t\n\x0b\x0c\r")
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """(cost, audit, repaired) of rows (role, text, fault), by trying every edit."""
    @lru_cache(None)
    def best(i, state, inserts):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        for name in ("user", "assistant"):
            to = NEXT.get((state, name[0]))
            if to and inserts < 3:
                cost, audit, out = best(i, to, inserts + 1)
                found.append((2 + cost, "I" + audit, ((name, ""), *out)))
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, out = best(i + 1, state, 0)
            found.append((3 + cost, "D" + audit, out))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                for edit, name, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    to = NEXT.get((state, name[:1]))
                    if to:
                        cost, audit, out = best(i + 1, to, 0)
                        found.append((price + extra + cost, edit + audit, ((name, text), *out)))
        return min(found) if found else (10**9, "", ())

    for i in reversed(range(len(rows))):  # so that no call goes deep
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


def brute(turns):
    """What ``audit(repair(damage(turns)))`` says, conversation by conversation."""
    convs = {}
    for conv, turn, role, text in turns:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if draw == 1:
            text = ""
        if draw == 2:
            text = "".join(c for c in text if c not in ".!?")
        if draw == 4:
            role = "user"
        convs.setdefault(conv, [])
        convs[conv] += [(turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        seen, marked, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "none": 0}
        for _, role, text in rows:
            bare = [c for c in text if c not in SPACE]
            fault = (
                "blank" if not bare else "duplicate" if (role, text) in seen
                else "truncated" if bare[-1] not in ".!?" else "none"
            )
            seen.add((role, text))
            count[fault] += 1
            marked.append((role, text, fault))
        known = [t for t, _, _ in rows if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _, _), (b, _, _) in zip(marked, marked[1:]))
        cost, audit, repaired = cheapest(tuple(marked))
        text = "\n".join(f"{r}:{t}" for r, t in repaired)
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def digests(frame):
    return {r["conv_id"]: tuple(r)[1:] for r in frame.collect()}


def made_up(rng, n, convs):
    roles = ["user", "assistant", "system", "tool", "", None, "User", "s"]
    said = ["Yes.", "No!", "cut off", " \n", None, "Why? ", "é漢.", "ends in space.  \t", "a.b"]
    return [
        (rng.choice(convs), rng.choice([None, *range(9)]), rng.choices(roles, [9, 9, 3, 1, 1, 1, 1, 1])[0], rng.choice(said))
        for _ in range(n)
    ]


@pytest.mark.parametrize("unit", [1, 2, 64])
def test_edits_are_those_of_a_plain_search(spark, unit):
    rng = random.Random(unit)
    turns = made_up(rng, 400, [None, *range(-3, 60)])
    turns += [(99, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(300)]  # a hot one
    turns += [(100, None, "user", "Same.")] * 40
    frame = spark.createDataFrame([(*t, "x") for t in turns], SCHEMA + ", n string").repartition(4)
    damaged = structure_repair.damage(frame)
    got = structure_repair.repair(damaged, F.col("gone"), unit)
    assert digests(structure_repair.audit(got)) == brute(turns)


def test_repaired_rows_are_those_of_the_digest(spark, sf):
    repaired = structure_repair.repair(spark.read.parquet(f"{sf}/conversations.parquet"))
    told = digests(structure_repair.audit(repaired))
    out = {}
    for r in sorted(structure_repair.repaired_turns(repaired).collect(), key=lambda r: (r["at"], r["place"])):
        out.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    for conv, (*_, sha) in told.items():
        assert hashlib.sha256("\n".join(out.get(conv, [])).encode()).hexdigest() == sha
        assert [line[0] for line in out.get(conv, []) if line[0] != "s"] == ["u", "a"] * (len(out.get(conv, [])) // 2)


def test_whole_table_and_empty_table(spark, sf):
    turns = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert digests(QUERIES["op11_structure_repair"](spark, sf)) == brute(turns)
    empty = spark.createDataFrame([], SCHEMA)
    assert structure_repair.audit(structure_repair.repair(empty)).collect() == []


def test_vectors_are_kept_for_blocks_only():
    """Blocks give the same vectors as all rows at once, and there are few of them."""
    rng = random.Random(5)
    codes = "".join(rng.choice("suaoSUAODx") for _ in range(5000))
    vector = structure_repair.FINAL
    for code in reversed(codes):
        vector = structure_repair._step(code, vector)
    bounds = [k * k for k in range(72)]
    end = structure_repair.FINAL
    for a, b in reversed(list(zip(bounds, bounds[1:]))):
        end = structure_repair.through(structure_repair.block_costs(codes[a:b]), end)
    assert end == vector


def test_order_of_groups_over_partitions(spark):
    """Places and chained hashes do not depend on where partitions end."""
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 1, 1, 1, 2, 3]), i, bytes([i % 251, i // 251])) for i in range(600)]
    frame = spark.createDataFrame(rows, "k long, v long, link binary").repartition(3)
    want = {}
    for k in (None, 1, 2, 3):
        chain = 1
        for n, (_, v, link) in enumerate(r for r in rows if r[0] == k):
            chain = (chain * ordering.STEP + int.from_bytes(link, "big")) % ordering.PRIME
            want[(k, v)] = (n, chain.to_bytes(16, "big"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordering.in_order(frame, "k", [F.col("v")], "test-order", chained="link").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(r["k"], r["v"]): (r["n"], bytes(r["chain"])) for r in got} == want
    assert len({r["at"] >> ordering.ROW_BITS for r in got if r["k"] == 1}) > 2
    assert [r["v"] for r in sorted(got, key=lambda r: r["at"])] == [
        r[1] for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    ]
