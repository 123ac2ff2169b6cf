"""Keyed tables as batches of Parquet files under a commit log.

``<path>/base=<n>x<id>`` holds a full state and ``<path>/delta=<n>x<id>`` the changes of
batch ``n``.  The log's last entry names the folders that count, the schema and the
highest values asked for, so reading needs no listing by us and no schema from files, and
all later batches are read in one scan.  A folder is written under a name of its own and
counts once the log names it: of two writers that began from the same entry one gets
``ConcurrentWrite`` and changes nothing.  A batch that is written again takes the place
of its former folder, so it counts once.

A key's rows in its latest batch are the current ones; a row with ``deleted`` set removes
the key.  A table made with ``buckets`` is split by the hash of its key: a batch holds only
the buckets it touches, rows of listed keys are looked up in their buckets alone, and
compaction rewrites no bucket without changes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.plans.log import Log, file_system
from docketry.plans.sizes import is_small, semi_or_anti
from docketry.session import new_work_dir

BUCKET = "key_bucket"
#: Compression of batches, which hold texts and vectors.
CODEC = "zstd"
#: Log entries whose folders stay when older ones are removed.
KEPT_ENTRIES = 64


@dataclass(frozen=True)
class Folder:
    n: int
    kind: str
    name: str
    # Buckets that count; None where the table has none.
    parts: list[int] | None = None
    # No row was written.
    empty: bool = False
    # All buckets of the folder count.
    whole: bool = True
    # Holds what earlier batches came to.
    compacted: bool = False


@dataclass(frozen=True)
class State:
    version: int = -1
    folders: list[Folder] = field(default_factory=list)
    schema: str | None = None
    buckets: int | None = None
    key: list[str] = field(default_factory=list)
    top: dict = field(default_factory=dict)
    # The last batch, which a drop of all rows does not take back.
    last: int = -1

    def of(self, kind: str) -> list[Folder]:
        return [f for f in self.folders if f.kind == kind]


def _log(spark: SparkSession, path: str) -> Log:
    return Log(spark, f"{path}/_log")


def state(spark: SparkSession, path: str) -> State:
    version, told = _log(spark, path).last()
    if told is None:
        return State()
    return State(**{**told, "version": version, "folders": [Folder(**f) for f in told["folders"]]})


def _commit(spark: SparkSession, path: str, new: State) -> None:
    told = asdict(new)
    version = told.pop("version")
    _log(spark, path).commit(version + 1, told)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def batches(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the batches of one kind that count, in order."""
    return sorted(f.n for f in state(spark, path).of(kind))


def next_batch(spark: SparkSession, path: str) -> int:
    """First number no batch has had."""
    return state(spark, path).last + 1


def read_back(df: DataFrame, folder: str) -> DataFrame:
    """What was written of ``df``; its schema is given, since no row may have been."""
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back: what follows starts there."""
    folder = new_work_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return read_back(df, folder)


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _merged_schema(known: str | None, new: T.StructType) -> T.StructType:
    """The fields of both; a void field takes the type it has elsewhere."""
    if known is None:
        return new
    fields = {f.name: f for f in T.StructType.fromJson(json.loads(known)).fields}
    for f in new.fields:
        if f.name not in fields or isinstance(fields[f.name].dataType, T.NullType):
            fields[f.name] = f
    return T.StructType(list(fields.values()))


def write_batch(df: DataFrame, path: str, batch: int, kind: str | None = None,
                partition_by: Sequence[str] = (), buckets: int | None = None,
                key: Sequence[str] = (), top: str | None = None, codec: str | None = CODEC) -> str:
    """Write one batch and return its folder.  The first one becomes the base.

    ``buckets`` and ``key`` count when the table is made.  The highest value of the column
    ``top`` is noted in the log.  ``codec`` is the compression, None for the session's.
    """
    spark = df.sparkSession
    now = state(spark, path)
    if now.version < 0:
        now = replace(now, buckets=buckets, key=list(key))
    compacted = kind == "base"
    if kind is None:
        kind = "delta" if any(f.n < batch for f in now.folders) else "base"
        if any(f.compacted and f.n >= batch for f in now.folders):
            raise ValueError(f"batch {batch} of {path} is part of a base already")
    if "deleted" not in df.columns:
        df = df.withColumn("deleted", F.lit(False))
    schema = T.StructType([f for f in df.schema.fields if f.name not in partition_by])
    if now.buckets:
        partition_by = [BUCKET]
        df = df.withColumn(BUCKET, bucket_of(now.key, now.buckets)).hint("rebalance", BUCKET)
    name = f"{kind}={batch}x{uuid.uuid4().hex[:12]}"
    folder = f"{path}/{name}"
    df.drop(*(f.name for f in schema.fields if isinstance(f.dataType, T.NullType))).write.partitionBy(*partition_by).parquet(folder, compression=codec)
    added = _folder_of(spark, folder, Folder(batch, kind, name, compacted=compacted), bool(now.buckets))
    high = {}
    if top is not None and not added.empty:
        # Two columns of the rows just written; a removal may name a key that never was.
        narrow = spark.read.schema(T.StructType([schema[top], schema["deleted"]])).parquet(folder)
        high = {top: narrow.where(~F.col("deleted")).agg(F.max(top)).first()[0]}
    kept = [f for f in now.folders if (f.kind, f.n) != (kind, batch)]
    if kind == "base":
        kept = [g for f in kept if f.n <= batch and (g := _without(f, added.parts)) is not None] + [f for f in kept if f.n > batch]
    tops = {**now.top, **{c: max(v, now.top.get(c, v)) for c, v in high.items() if v is not None}}
    _commit(spark, path, replace(
        now, folders=sorted([*kept, added], key=lambda f: f.n), top=tops, last=max(now.last, batch),
        schema=_merged_schema(now.schema, schema).json(),
    ))
    return folder


def _folder_of(spark: SparkSession, folder: str, known: Folder, bucketed: bool) -> Folder:
    """What a folder just written holds; the only one that is ever listed."""
    fs, p = file_system(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    data = [x for x in names if not x.startswith(("_", "."))]
    parts = sorted(int(x.partition("=")[2]) for x in data) if bucketed else None
    return replace(known, parts=parts, empty=not data)


def _without(old: Folder, parts: Collection[int] | None) -> Folder | None:
    """What is left of a folder under a new base, which has all rows or those of some buckets."""
    if parts is None or old.parts is None:
        return None
    left = [b for b in old.parts if b not in parts]
    return replace(old, parts=left, whole=False) if left else None


def drop_table(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p) and fs.delete(p, True)


def _scan(spark: SparkSession, path: str, now: State, folders: Sequence[Folder],
          wanted: Collection[int] | None = None) -> DataFrame | None:
    """Rows of folders of one kind in one scan, with ``_batch``; of bucketed tables only the ``wanted`` ones."""
    paths = []
    for f in folders:
        if f.empty:
            continue
        if f.parts is None or (f.whole and wanted is None):
            paths.append(f"{path}/{f.name}")
        else:
            paths += [f"{path}/{f.name}/{BUCKET}={b}" for b in f.parts if wanted is None or b in wanted]
    if not paths:
        return None
    schema = T.StructType.fromJson(json.loads(now.schema))
    solid = T.StructType([f for f in schema.fields if not isinstance(f.dataType, T.NullType)])
    kind = folders[0].kind
    read = spark.read.schema(solid).option("basePath", path).parquet(*paths)
    void = {f.name: F.lit(None) for f in schema.fields if isinstance(f.dataType, T.NullType)}
    number = F.split(F.col(kind), "x").getItem(0).cast("int")
    # The bucket stays inside: who reads a table need not know how it is split.
    return read.withColumns({"_batch": number, **void}).drop(kind, *([BUCKET] if now.buckets else []))


def read_folder(spark: SparkSession, path: str, kind: str, n: int) -> DataFrame | None:
    """Rows of one batch as written, or None where there are none."""
    now = state(spark, path)
    found = _scan(spark, path, now, [f for f in now.of(kind) if f.n == n])
    return None if found is None else found.drop("_batch")


def read_every(spark: SparkSession, path: str, listed_in: str | None = None) -> DataFrame | None:
    """Rows of all batches that count, whatever their keys.

    With ``listed_in`` only if each finished batch of that table has its part here.
    """
    now = state(spark, path)
    mine = {f.n for f in now.folders}
    if listed_in is not None:
        other = {f.n for f in state(spark, listed_in).folders}
        floor = max((f.n for f in now.of("base")), default=0)
        if any(n not in mine for n in other if n >= floor):
            return None
        now = replace(now, folders=[f for f in now.folders if f.n in other])
    parts = [s for kind in ("base", "delta") if (s := _scan(spark, path, now, now.of(kind))) is not None]
    live = [p.where(~F.col("deleted")).drop("deleted", "_batch") for p in parts]
    return None if not live else live[0] if len(live) == 1 else live[0].unionByName(live[1])


def read_current(spark: SparkSession, path: str, key: Sequence[str],
                 keys_in: str | None = None, only: Collection[int] | None = None) -> DataFrame | None:
    """The current rows, or None when the table was never written.

    The base is not shuffled: only the keys that later batches touch are
    removed from it.  Later batches are one scan, reduced through one narrow aggregate
    of keys.  ``keys_in`` names a table written in the same batches, after this one, that
    lists each key once; where this table has many rows per key, it is the cheaper place
    to look for them.  Batches that it has not finished are not read.  ``only`` names the
    buckets to read.
    """
    now = state(spark, path)
    listing = state(spark, keys_in) if keys_in is not None else now
    finished = {f.n for f in listing.folders}
    bases = [f for f in now.of("base") if f.n in finished]
    newest = max((f.n for f in bases), default=-1)
    later = [f for f in now.of("delta") if f.n in finished and (now.buckets or f.n > newest)]
    key = list(key)

    base = _scan(spark, path, now, bases, only)
    if base is not None:
        base = base.where(~F.col("deleted")).drop("deleted", "_batch")
    changes = _scan(spark, path, now, later, only)
    if keys_in is None:
        touched, n_touched = changes, len(later)
    else:
        # After a crash the other table may have begun later, with a base of its own.
        kinds = [_scan(spark, keys_in, listing, [f for f in listing.of(k) if f.n > newest]) for k in ("base", "delta")]
        found = [k.select(*key, "_batch") for k in kinds if k is not None]
        touched = None if not found else found[0] if len(found) == 1 else found[0].unionByName(found[1])
        n_touched = len([f for f in listing.folders if f.n > newest])
    if touched is None:
        if base is None and now.version >= 0 and now.schema:
            return _no_rows(spark, now)
        return base
    latest = touched.groupBy(*key).agg(F.max("_batch").alias("_batch"))
    kept = semi_or_anti(base, latest, key, "left_anti") if base is not None else None
    if changes is None:
        return kept if kept is not None else _no_rows(spark, now)
    if n_touched > 1:
        changes = semi_or_anti(changes, latest, [*key, "_batch"], "left_semi")
    live = changes.where(~F.col("deleted")).drop("deleted", "_batch")
    return live if kept is None else kept.unionByName(live)


def _no_rows(spark: SparkSession, now: State) -> DataFrame:
    return spark.createDataFrame([], T.StructType.fromJson(json.loads(now.schema))).drop("deleted")


def read_keys(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame | None:
    """The current rows of the listed keys; of a bucketed table only their buckets are read."""
    now = state(spark, path)
    if not now.buckets:
        current = read_current(spark, path, now.key or keys.columns)
    else:
        # At most as many rows as there are buckets.
        numbers = keys.select(bucket_of(now.key, now.buckets).alias("b")).distinct().collect()
        current = read_current(spark, path, now.key, only={r["b"] for r in numbers})
    return None if current is None else semi_or_anti(current, keys, now.key or keys.columns, "left_semi")


def compact(spark: SparkSession, path: str, key: Sequence[str],
            partition_by: Sequence[str] = (), keys_in: str | None = None,
            rows: Callable[[], DataFrame] | None = None) -> None:
    """Write the current rows as a new base, of a bucketed table those of the buckets with changes.

    ``keys_in`` as for ``read_current``.  Tables written in the same batches are
    compacted in the order they are written, each to the same last batch.  Folders that
    no entry of late names are removed.  ``rows`` gives the current rows of a table
    where not each of them has the key.
    """
    now = state(spark, path)
    done = batches(spark, keys_in or path, "delta")
    if not done or done[-1] in [f.n for f in now.of("base")]:
        return
    touched = None
    if now.buckets:
        touched = sorted({b for f in now.of("delta") for b in f.parts})
    current = read_current(spark, path, key, keys_in, touched) if rows is None else rows()
    if current is not None:
        _write_base(current, path, done[-1], partition_by, touched)
    vacuum(spark, path)


def _write_base(current: DataFrame, path: str, batch: int, partition_by: Sequence[str], touched: list[int] | None) -> None:
    spark = current.sparkSession
    write_batch(current, path, batch, "base", partition_by)
    if touched is not None:
        # A bucket whose rows are all gone has no folder in the new base, and its old ones must not count.
        now = state(spark, path)
        folders = [f if (f.n, f.kind) == (batch, "base") else _without(f, touched) for f in now.folders]
        _commit(spark, path, replace(now, folders=[f for f in folders if f is not None]))


def vacuum(spark: SparkSession, path: str, kept: int = KEPT_ENTRIES) -> list[str]:
    """Remove folders that none of the last ``kept`` log entries names; returns their names.

    Only folders that an earlier entry names are looked at, so one that is being
    written is never touched.  Readers may go on with tables up to ``kept`` entries old.
    """
    log = _log(spark, path)
    version, _ = log.last()
    if version < kept:
        return []

    def named(versions) -> set[str]:
        return {f["name"] for v in versions if (told := log.read(v)) for f in told["folders"]}

    gone = sorted(named(range(max(0, version - 2 * kept), version - kept + 1)) - named(range(version - kept + 1, version + 1)))
    fs, _ = file_system(spark, path)
    for name in gone:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    return gone


def upsert_rows(base: DataFrame, changes: DataFrame, key: Sequence[str],
                version: str | None = None) -> DataFrame:
    """``base`` with the rows of ``changes`` put in by key.

    With ``version`` the highest one per key wins among the changes; the
    aggregate combines on the map side, so many copies of a key cost little.
    """
    key = list(key)
    if version is not None:
        rest = [c for c in changes.columns if c not in key]
        changes = (
            changes.groupBy(*key)
            .agg(F.max_by(F.struct(*rest), F.col(version)).alias("_row"))
            .select(*key, "_row.*")
        )
    fresh = changes.select(*base.columns)
    return semi_or_anti(base, changes, key, "left_anti").unionByName(fresh)


def delete_rows(base: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    return semi_or_anti(base, keys, key, "left_anti")
