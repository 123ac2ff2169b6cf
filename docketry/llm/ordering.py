"""Rows of many groups in order, without a task that holds a group.

Rows are range-partitioned and sorted by group and order, so one group may spread over
many partitions.  A task numbers the rows of each group in its partition while they
stream by; what a group had in earlier partitions is worked out from one row per
partition and added afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docketry.llm.common import map_arrow, stage

#: Bits of ``monotonically_increasing_id`` below the number of the partition.
ROW_BITS = 33
#: Chained hashes are numbers modulo a Mersenne prime, each times ``STEP`` plus the next row's.
PRIME = (1 << 127) - 1
STEP = 0x5DEECE66D1CE4E5B9F3A7C15B58476D1 % PRIME


def _number(value: bytes | None) -> int:
    return int.from_bytes(value or b"", "big") % PRIME


def _bytes(number: int) -> bytes:
    return number.to_bytes(16, "big")


def _stream(key: str, chained: str | None, schema: pa.Schema):
    """Adds ``n``, the place in the group, and the chain so far, both from the partition's begin."""
    def run(batches):
        now, n, chain = object(), 0, 1
        for batch in batches:
            places, chains = [], []
            links = batch.column(chained).to_pylist() if chained else [None] * batch.num_rows
            for k, link in zip(batch.column(key).to_pylist(), links):
                if k != now:
                    now, n, chain = k, 0, 1
                else:
                    n += 1
                places.append(n)
                if chained:
                    chain = (chain * STEP + _number(link)) % PRIME
                    chains.append(_bytes(chain))
            columns = [*batch.columns, pa.array(places, pa.int64())]
            if chained:
                columns.append(pa.array(chains, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _joined_on(ends: list) -> dict[int, tuple[int, int]]:
    """Rows and chain that a partition's first group already has, where it has any."""
    earlier: dict[int, tuple[int, int]] = {}
    last, n, chain = None, 0, 1
    for end in sorted(ends, key=lambda e: e["part"]):
        whole = end["rows"] == end["last"]["n"] + 1
        if last is not None and last["k"] == end["first"]["k"]:
            earlier[end["part"]] = (n, chain)
        else:
            n, chain = 0, 1
        own = end["last"]["n"] + 1
        if whole:
            chain = (chain * pow(STEP, own, PRIME) + (_number(end["last"]["chain"]) - pow(STEP, own, PRIME))) % PRIME
            n += own
        else:
            n, chain = own, _number(end["last"]["chain"])
        last = end["last"]
    return earlier


def in_order(rows: DataFrame, key: str, order: Sequence[Column], name: str, chained: str | None = None) -> DataFrame:
    """``rows``, written in order, with ``at``, ``n`` and, if a binary column is ``chained``, ``chain``.

    ``at`` rises with (key, order) over the whole table, ``n`` counts a key's rows from 0,
    and ``chain`` is a 127-bit hash of the chained column over the key's rows up to this
    one.  A null key is a key like any other, rows that tie stay in the order they are read
    in, so even many equal rows are split.  An empty table gives no row.
    """
    by = [F.col(key).asc_nulls_first(), *order, F.col("_read")]
    dealt = (
        rows.withColumn("_read", F.monotonically_increasing_id())
        .repartitionByRange(*by).sortWithinPartitions(*by).drop("_read")
        .withColumn("at", F.monotonically_increasing_id())
    )
    out = T.StructType([*dealt.schema.fields, T.StructField("n", T.LongType())])
    if chained:
        out = out.add("chain", T.BinaryType())
    numbered = stage(map_arrow(dealt, _stream(key, chained, to_arrow_schema(out)), out), name)

    part = F.shiftright("at", ROW_BITS)
    last = F.struct(F.col(key).alias("k"), "n", (F.col("chain") if chained else F.lit(b"")).alias("chain"))
    # One row per partition.
    ends = numbered.groupBy(part.alias("part")).agg(
        F.min_by(F.struct(F.col(key).alias("k")), "at").alias("first"),
        F.max_by(last, "at").alias("last"), F.count(F.lit(1)).alias("rows"),
    ).collect()
    earlier = _joined_on(ends)
    if not earlier:
        return numbered
    spark = rows.sparkSession
    known = spark.createDataFrame([(p, n) for p, (n, _) in earlier.items()], "_part bigint, _n bigint")
    # The first group of a partition is where the place is that of the row itself.
    goes_on = F.col("n") == F.col("at").bitwiseAND((1 << ROW_BITS) - 1)
    moved = numbered.join(F.broadcast(known), part == F.col("_part"), "left").withColumn(
        "_n", F.when(goes_on, F.col("_n"))
    )
    if chained:
        moved = _add_chains(moved, {p: chain for p, (_, chain) in earlier.items()})
    return moved.withColumn("n", F.col("n") + F.coalesce("_n", F.lit(0))).drop("_part", "_n")


def _add_chains(moved: DataFrame, before: dict[int, int]) -> DataFrame:
    """``chain`` of rows whose group began in an earlier partition."""
    names = moved.columns
    schema = to_arrow_schema(moved.schema)

    def run(batches):
        for batch in batches:
            got = {c: batch.column(c).to_pylist() for c in ("_n", "_part", "n", "chain")}
            chains = [
                chain if more is None else _bytes((_number(chain) + (before[p] - 1) * pow(STEP, n + 1, PRIME)) % PRIME)
                for more, p, n, chain in zip(got["_n"], got["_part"], got["n"], got["chain"])
            ]
            columns = [pa.array(chains, pa.binary()) if c == "chain" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return map_arrow(moved, run, moved.schema)


def _each(batches, names):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names))


def _rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*found) if found else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


#: Rows that a task hands on at once, and letters of their blocks.
BATCH, LETTERS = 2000, 4_000_000


def map_rows(df: DataFrame, make, schema: str) -> DataFrame:
    """``mapInArrow`` by a generator of tuples from tuples, in batches of bounded size."""
    kinds = T.StructType.fromDDL(schema)
    arrow, names = to_arrow_schema(kinds), df.columns

    def run(batches):
        found, size = [], 0
        for row in make(_each(batches, names)):
            found.append(row)
            size += sum(len(v) for v in row if isinstance(v, (str, list)))
            if len(found) >= BATCH or size >= LETTERS:
                yield _rows(found, arrow)
                found, size = [], 0
        if found:
            yield _rows(found, arrow)

    return map_arrow(df, run, kinds)
