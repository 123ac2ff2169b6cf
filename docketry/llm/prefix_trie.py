"""Conversation prefix trie by truncation peeling.

Every conversation is a path of turns.  A turn's place in the trie is named by a chained
hash of the turns so far, so two conversations share a node where their hashes agree.

From the greatest depth up, each step merges the nodes that survive from below with the
conversations that end at this depth, gives out the merged nodes with all that is told of
their subtrees, strips the last turn and groups again.  So nodes are found and
aggregated in one pass, and a node moves once for each of its turns, however many
conversations it stands for.  Conversations that are the same have become one row before.

Depths are taken in bands.  In a band, what lies below one node at its top is a group: a
task peels the group's levels, holding what is alive at one depth.  Groups of more than
``WIDE`` turns, and the first band, whose only group is the whole table, are peeled
level by level by Spark, where partial sums are made before the shuffle.  Both give the
same nodes.

Paths are arrays of hashes of at most a band's length.  No text is shuffled after it is
hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.llm.common import stage
from docketry.llm.ordering import in_order, map_rows
from docketry.plans.sizes import is_small, semi_or_anti

#: Depth of the first band; each further one reaches twice as deep, by at most ``WIDEST``.
FIRST, WIDEST = 8, 512
#: Turns in the paths of a group that a task may hold.
WIDE = 400_000
ROOT = bytes(16)
#: Children from which parents are looked up by broadcast: this share of all nodes.
HOT_SHARE = 10_000


def bands(depth: int, first: int = FIRST, widest: int = WIDEST) -> list[tuple[int, int]]:
    """Bands (above, to] that reach ``depth``, from the root down."""
    found = [(0, first)]
    while found[-1][1] < depth:
        at = found[-1][1]
        found.append((at, at + min(at, widest)))
    return found


def hashed_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, n, link, bytes)``: place, hash and UTF-8 length of each turn; rows without an id are left out."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.substring(F.unhex(F.sha2(told.cast("binary"), 256)), 1, 16).alias("link"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("link")]
    return in_order(rows, "conv_id", order, "trie-turns").select("conv_id", "n", "link", "bytes")


def rebuild(turns: DataFrame) -> DataFrame:
    """``(conv_id, n, link, bytes)`` of ``hashed_turns`` with the first turns taken from another conversation.

    Conversation c gets the first h turns of conversation c - c % 5 in place of its own
    first h, h being the crc32 of c in decimal, modulo 9.  A conversation that keeps no
    turn has one row with a null ``n``.
    """
    every = turns.groupBy("conv_id").agg(F.lit(1).alias("_one")).select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), _taken("conv_id").alias("h")
    )
    # At most eight turns of a conversation, for five conversations at most.
    heads = turns.where((F.col("conv_id") % 5 == 0) & (F.col("n") < 8)).withColumnRenamed("conv_id", "base")
    given = every.join(heads, "base").where("n < h").select("conv_id", "n", "link", "bytes")
    own = turns.where(F.col("n") >= _taken("conv_id"))
    none = F.lit(None)
    there = every.select("conv_id", none.cast("bigint").alias("n"), none.cast("binary").alias("link"), none.cast("bigint").alias("bytes"))
    return given.unionByName(own).unionByName(there)


def _taken(conv: str):
    return F.pmod(F.crc32(F.col(conv).cast("string").cast("binary")), F.lit(9))


def _chained(paths: DataFrame) -> DataFrame:
    """``(conv_id, depth, node, bytes)`` of each turn of ``paths``, and depth 0 for each conversation."""
    turns = paths.where("n IS NOT NULL").select("conv_id", F.col("n").alias("place"), "link", "bytes")
    placed = in_order(turns, "conv_id", [F.col("place"), F.col("link")], "trie-chain", chained="link")
    return placed.select("conv_id", (F.col("n") + 1).alias("depth"), F.col("chain").alias("node"), "bytes")


#: What is told of a node.
_NODE = "node binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
_TOLD = ("n_convs", "n_children", "n_leaves", "saved")


def _peeled_group(group: list[tuple], above: int) -> Iterator[tuple]:
    """Nodes of one group from the greatest depth up, and last what survives at its top.

    Rows are (depth, node, conv, n_convs, n_children, n_leaves, saved, path, sizes), deepest first.
    """
    waiting = iter(group)
    row = next(waiting, None)
    alive: dict[bytes, list] = {}
    depth = group[0][0]
    while depth > above:
        while row is not None and row[0] == depth:
            _, node, conv, *told, path, sizes = row
            _merge(alive, node, conv, told, path, sizes)
            row = next(waiting, None)
        survivors: dict[bytes, list] = {}
        for node, (conv, convs, children, leaves, saved, path, sizes) in alive.items():
            leaves = leaves if children else 1
            saved += (convs - 1) * sizes[depth - above - 1]
            parent = path[depth - above - 1]
            yield node, parent, depth, conv, convs, children, leaves, saved
            _merge(survivors, parent, conv, (convs, 1, leaves, saved), path, sizes)
        alive, depth = survivors, depth - 1
    for node, told in alive.items():
        yield node, None, depth, *told[:5]


def _merge(alive: dict, node: bytes, conv: int, told, path, sizes) -> None:
    known = alive.get(node)
    if known is None:
        alive[node] = [conv, *told, path, sizes]
        return
    if conv < known[0]:
        known[0] = conv
    for i, more in enumerate(told):
        known[1 + i] += more


def _peel_in_tasks(rows: DataFrame, above: int) -> DataFrame:
    """Nodes of the band, and with a null parent what survives at its top."""
    def run(rows):
        top, group = None, []
        for now, *row in rows:
            if group and now != top:
                yield from _peeled_group(group, above)
                group = []
            top = now
            group.append(tuple(row))
        if group:
            yield from _peeled_group(group, above)

    dealt = rows.select("top", "depth", "node", "conv_id", *_TOLD, "path", "sizes").repartition("top")
    return map_rows(dealt.sortWithinPartitions("top", F.col("depth").desc()), run, _NODE)


def _merged(rows: DataFrame) -> DataFrame:
    """Rows of one node as one; any of its paths leads up to the same nodes."""
    return rows.groupBy("node").agg(
        F.min("top").alias("top"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).cast("bigint").alias(c) for c in _TOLD),
        F.any_value("path").alias("path"), F.any_value("sizes").alias("sizes"),
    )


def _peel_by_level(rows: DataFrame, above: int, to: int, name: str) -> list[DataFrame]:
    """The same by one shuffle a level; ``rows`` are read once for each."""
    found, survivors = [], None
    for depth in range(to, above, -1):
        here = rows.where(F.col("depth") == depth).drop("depth")
        here = here if survivors is None else here.unionByName(survivors)
        step = depth - above
        size, parent = F.element_at("sizes", step), F.element_at("path", step)
        merged = _merged(here).withColumns({
            "n_leaves": F.when(F.col("n_children") > 0, F.col("n_leaves")).otherwise(1),
            "saved": F.col("saved") + (F.col("n_convs") - 1) * size,
            "parent": parent, "depth": F.lit(depth).cast("bigint"),
        })
        merged = stage(merged, f"{name}-{depth}")
        found.append(merged.withColumnRenamed("saved", "saved_tokens").select(*T.StructType.fromDDL(_NODE).names))
        survivors = merged.select(
            "top", F.col("parent").alias("node"), "conv_id", "n_convs", F.lit(1).cast("bigint").alias("n_children"),
            "n_leaves", "saved", "path", "sizes",
        )
    top = _merged(survivors).withColumn("parent", F.lit(None).cast("binary")).withColumn("depth", F.lit(above).cast("bigint"))
    found.append(top.withColumnRenamed("saved", "saved_tokens").select(*T.StructType.fromDDL(_NODE).names))
    return found


def _paths(chained: DataFrame, edges: list[tuple[int, int]]) -> DataFrame:
    """``(conv_id, band, path, sizes)``: hashes from a band's top to as deep as the conversation goes, at most its length."""
    band = reduce(lambda found, edge: F.when(F.col("depth") <= edge[1][1], edge[0]).otherwise(found),
                  reversed(list(enumerate(edges))), F.lit(None).cast("int"))
    inside = chained.withColumn("band", band)
    # The node at a band's top opens the next band's path.
    tops = inside.where(F.col("depth").isin([to for _, to in edges[:-1]])).withColumn("band", F.col("band") + 1)
    tops = tops.withColumn("bytes", F.lit(None).cast("bigint"))
    ordered = F.array_sort(F.collect_list(F.struct("depth", "node", "bytes")))
    return (
        inside.unionByName(tops).groupBy("conv_id", "band").agg(ordered.alias("rows"))
        .select(
            "conv_id", "band", F.col("rows.node").alias("path"), F.col("rows.bytes").alias("sizes"),
            F.element_at("rows.depth", -1).alias("depth"),
        )
        # The root opens the first band's paths, and their lengths begin behind what opens a path.
        .withColumn("path", F.when(F.col("band") == 0, F.concat(F.array(F.lit(ROOT)), "path")).otherwise(F.col("path")))
        .withColumn("sizes", F.when(F.col("band") == 0, F.col("sizes")).otherwise(F.slice("sizes", 2, 1 << 30)))
    )


def build(paths: DataFrame, first: int = FIRST, widest: int = WIDEST, wide: int = WIDE) -> DataFrame:
    """Nodes of ``paths(conv_id, n, link, bytes)``, one row each, with ``ends_sha256`` and the parent's id.

    ``n`` orders a conversation's turns, ``link`` is a turn's hash; a row with a null ``n`` only
    says that the conversation is there.  Rows without an id are left out.  Where no
    conversation is there is no root, so an empty table gives no row.
    """
    paths = paths.where("conv_id IS NOT NULL")
    chained = stage(_chained(paths), "trie-nodes")
    depth = chained.agg(F.max("depth")).first()[0] or 0
    edges = bands(depth, first, widest)
    by_band = stage(_paths(chained, edges), "trie-paths")
    # The deepest row of a conversation's paths is its end; a conversation without turns ends at the root.
    ends = by_band.groupBy("conv_id").agg(F.max_by(F.struct("depth", F.element_at("path", -1).alias("node")), "depth").alias("e"))
    ends = paths.select("conv_id").distinct().join(ends, "conv_id", "left").select(
        "conv_id", F.coalesce("e.depth", F.lit(0)).cast("bigint").alias("depth"), F.coalesce("e.node", F.lit(ROOT)).alias("node")
    )
    ends = stage(ends, "trie-ends")
    same = ends.groupBy("node").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")
    )
    none = F.lit(0).cast("bigint")
    ended = stage(same.select("node", "depth", "conv_id", "n_convs", *(none.alias(c) for c in _TOLD[1:])), "trie-ended")

    found: list[DataFrame] = []
    alive = None
    for number, (above, to) in reversed(list(enumerate(edges))):
        rows = ended.where((F.col("depth") > above) & (F.col("depth") <= to))
        rows = rows if alive is None else rows.unionByName(alive)
        # Each row's own smallest conversation leads the way up.
        led = rows.join(by_band.where(F.col("band") == number).select("conv_id", "path", "sizes"), "conv_id")
        led = stage(led.withColumn("top", F.element_at("path", 1)), f"trie-band-{above}")
        if above == 0:
            parts = _peel_by_level(led, above, max(1, min(to, depth)), "trie-level")
        else:
            turns = led.groupBy("top").agg(F.sum(F.size("path")).alias("n")).where(F.col("n") > wide)
            large = stage(turns.select("top"), f"trie-wide-{above}")
            if large.limit(1).count():
                small = is_small(large)
                parts = [_peel_in_tasks(semi_or_anti(led, large, ["top"], "left_anti", small), above)]
                parts += _peel_by_level(semi_or_anti(led, large, ["top"], "left_semi", small), above, to, f"trie-level-{above}")
            else:
                parts = [_peel_in_tasks(led, above)]
        peeled = stage(reduce(DataFrame.unionByName, parts), f"trie-peeled-{above}")
        found.append(peeled.where("parent IS NOT NULL"))
        alive = peeled.where("parent IS NULL").drop("parent").withColumnRenamed("saved_tokens", "saved")
    return _told(found, alive, ended, ends)


def _told(found: list[DataFrame], top: DataFrame, ended: DataFrame, ends: DataFrame) -> DataFrame:
    """All nodes, the root among them, with their parents' ids and the digests of what ends there."""
    spark = ends.sparkSession
    names = T.StructType.fromDDL(_NODE).names
    at_root = ended.where("depth = 0").unionByName(top.select(*ended.columns))
    root = at_root.groupBy("node").agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).cast("bigint").alias(c) for c in _TOLD))
    root = root.withColumns({
        "parent": F.lit(None).cast("binary"), "depth": F.lit(0).cast("bigint"), "saved_tokens": F.col("saved"),
        "n_leaves": F.when(F.col("n_children") > 0, F.col("n_leaves")).otherwise(1).cast("bigint"),
    }).select(*names)
    nodes = stage(reduce(DataFrame.unionByName, [root, *found]), "trie-found")

    def digests(rows):
        now, sha = None, None
        for node, conv in rows:
            if node != now:
                if sha is not None:
                    yield now, sha.hexdigest()
                now, sha = node, hashlib.sha256(str(conv).encode())
            else:
                sha.update(f",{conv}".encode())
        if sha is not None:
            yield now, sha.hexdigest()

    # Ids stream through in order; none are held, though one node may end most conversations.
    in_turn = ends.select("node", "conv_id").repartition("node").sortWithinPartitions("node", "conv_id")
    ended_here = map_rows(in_turn, digests, "node binary, ends_sha256 string")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_n"))
    # Fewer than HOT_SHARE nodes can have more than one child in HOT_SHARE of all nodes.
    bound = nodes.count() / HOT_SHARE
    hot = F.broadcast(stage(parents.where((F.col("_n") > bound) & (F.col("_n") > 1000)).drop("_n"), "trie-hot"))
    below_hot = nodes.join(hot, "parent")
    others = nodes.join(hot, "parent", "left_anti").join(
        parents.where(~((F.col("_n") > bound) & (F.col("_n") > 1000))).drop("_n"), "parent", "left"
    )
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        below_hot.unionByName(others).join(ended_here, "node", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def trie(turns: DataFrame) -> DataFrame:
    """The trie of ``turns(conv_id, turn, role, text)`` as they are.

    A row per node: ``conv_id`` its smallest member, ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (UTF-8 bytes of last texts that its subtree saves) and
    ``ends_sha256``.  Turns are taken by ``turn``, null first, ties by the turn's hash; null roles
    and texts are empty; repeated rows are turns of their own; rows without an id are
    left out; other columns are not read.
    """
    return build(hashed_turns(turns))
