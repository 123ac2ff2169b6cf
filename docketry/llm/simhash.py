"""SimHash fingerprints, with DataFrame functions only.

Each occurrence of a word votes, by the bits of its 64-bit hash, for or against every bit
of its text's fingerprint.  The vote weighs more the longer the word is: short
words are in every text and say little.  Votes for a bit are counted; against are the rest.
Two counts share one 64-bit sum (32 bits each), so 32 sums per text are all that
partial aggregation keeps and the shuffle moves, whatever the length of the text.

Search: fingerprints are cut into ``BLOCKS`` blocks.  If two differ in at most ``radius`` bits,
``BLOCKS - radius`` of the blocks are equal.  For every choice of that many blocks there
is a table keyed by them (the permuted block tables), so no pair within the radius is missed.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.common import stage
from docketry.plans.sizes import join_hot_key

BITS = 64
RADIUS = 3
BLOCKS = 6
#: A word of n letters has the weight min(n, LONGEST) - SHORT, squared; at least 1.
SHORT, LONGEST = 2, 10
#: Code points of text in one range of ids, about.
PART_CHARS = 32_000_000
#: The search takes rows whose id this divides as queries.
QUERY_IDS = 100
_LANES = BITS // 2
_PAIR = (1 << 32) | 1


def _words(text: Column) -> Column:
    """Words between spaces, tabs and line ends, lower-cased, without marks at their ends."""
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), "\n\t\r\x0b\x0c.,;:!?()\"", "     ")
    return F.split(plain, " ")


def _weight(word: Column) -> Column:
    over = F.least(F.length(word), F.lit(LONGEST)) - SHORT
    return F.greatest(over * over * F.signum(over).cast("int"), F.lit(1)).cast("bigint")


def fingerprints(rows: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """``(key..., fingerprint)`` of every row's text, as a 64-bit number.

    Rows that share a key are voted on together.  A text without words, null or empty,
    has the fingerprint 0; so no row is lost.  Equal texts have equal fingerprints.
    """
    words = rows.select(*key, F.explode(_words(F.col(text))).alias("word"))
    # The empty word keeps a text without words in the result and has no vote.
    votes = words.select(
        *key, F.xxhash64("word").alias("h"), F.when(F.col("word") == "", F.lit(0).cast("bigint")).otherwise(_weight(F.col("word"))).alias("w")
    )
    lanes = [
        F.sum(F.shiftrightunsigned("h", i).bitwiseAND(F.lit(_PAIR)) * F.col("w")).alias(f"s{i}") for i in range(_LANES)
    ]
    counted = votes.groupBy(*key).agg(F.sum("w").alias("all"), *lanes)
    bits = F.lit(0).cast("bigint")
    for i in range(_LANES):
        low = F.col(f"s{i}").bitwiseAND(F.lit(0xFFFFFFFF))
        high = F.shiftrightunsigned(F.col(f"s{i}"), 32)
        for count, bit in ((low, i), (high, i + 32)):
            bits = bits.bitwiseOR(F.shiftleft((2 * count > F.col("all")).cast("bigint"), bit))
    return counted.select(*key, bits.alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def _blocks() -> list[tuple[int, int]]:
    """(first bit, width) of each block, as even as they can be."""
    cuts = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _tables(fp: Column, radius: int) -> Column:
    """One key for each choice of blocks that must be equal."""
    blocks = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << w) - 1)) for a, w in _blocks()]
    keys = [
        F.xxhash64(F.lit(n), *(blocks[i] for i in chosen))
        for n, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - radius))
    ]
    return F.explode(F.array(*keys))


def within_radius(queries: DataFrame, known: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``(fingerprint, near, distance)`` of distinct fingerprints at most ``radius`` bits apart.

    Both inputs have a column ``fingerprint``; copies are made one first, so that a
    group of copies is one row on each side.  Nulls match nothing.  Few queries are
    broadcast; with more, blocks that many fingerprints share are salted.
    """
    if not 0 <= radius < BLOCKS:
        raise ValueError("the radius must be below the number of blocks")
    near = F.col("near")
    left = queries.where("fingerprint IS NOT NULL").select("fingerprint").distinct()
    right = known.where("fingerprint IS NOT NULL").select(F.col("fingerprint").alias("near")).distinct()
    left = left.select("fingerprint", _tables(F.col("fingerprint"), radius).alias("key"))
    right = right.select("near", _tables(near, radius).alias("key"))
    apart = F.bit_count(F.col("fingerprint").bitwiseXOR(near))
    return (
        join_hot_key(right, left, "key", "near").where(apart <= radius)
        .select("fingerprint", "near", apart.alias("distance")).distinct()
    )


def _cuts_above(cuts: list[int], value: Column) -> Column:
    """Number of the rising ``cuts`` above ``value``.

    They are looked at in two steps, so a row meets twice the root of their number and not all:
    each look makes an object, and the ranges grow with the table.
    """
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts))
    firsts = cuts[::step]

    def above(some: Column) -> Column:
        return F.size(F.filter(some, lambda c: c > value))

    def both(groups: Column) -> Column:
        # Of so many groups the first cut is above, so all are; the group before them may be so in part.
        end = (F.lit(len(firsts)) - groups) * step
        begin = F.greatest(end - step, F.lit(0))
        return F.greatest(F.lit(len(cuts)) - end, F.lit(0)) + above(F.slice(F.lit(cuts).cast("array<bigint>"), begin + 1, F.least(end, F.lit(step))))

    return F.get(F.transform(F.array(above(F.lit(firsts).cast("array<bigint>"))), both), F.lit(0))


def _by_part(values: dict[int, int | None], kind: str) -> Column:
    """The value of the row's ``part``; a list in the plan, so that nothing is broadcast for it."""
    return F.get(F.array(*(F.lit(values.get(p)).cast(kind) for p in range(max(values) + 1))), F.col("part"))


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """``(part, place, doc_id, text, next_text)``: each document and the one after it by falling id.

    The last is followed by the first.  Null ids come last; rows that repeat an id are in
    falling order of their texts.  Ids are cut into ``parts`` ranges of about equal
    size, one window each.  The first row of each range, which the range before it needs,
    is looked up apart.  (part, place) is unique.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shares = [i / parts for i in range(1, parts)]
    cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 10_000).alias("c")).first()["c"] or [])) if shares else []
    # Falling ids have rising parts; null ids form the last one.
    part = _cuts_above(cuts, F.col("doc_id"))
    part = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(part).cast("int")
    placed = docs.withColumn("part", part)
    order = Window.partitionBy("part").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    rows = placed.withColumn("place", F.row_number().over(order)).withColumn("next_text", F.lead("text").over(order))

    # Of each range: its first row, by largest id, then largest text.
    first_ids = {r["part"]: r["doc_id"] for r in placed.groupBy("part").agg(F.max("doc_id").alias("doc_id")).collect()}
    known = sorted(first_ids)
    if not known:
        return rows
    before = {p: known[i - 1] for i, p in enumerate(known)}
    heads = placed.where(F.col("doc_id").eqNullSafe(_by_part(first_ids, "bigint")))
    heads = heads.groupBy("part").agg(F.max("text").alias("head")).select(_by_part(before, "int").alias("part"), "head")
    last = F.col("next_text").isNull()
    return (
        rows.join(heads.withColumn("_end", F.lit(True)), "part", "left")
        .withColumn("next_text", F.when(last, F.col("head")).otherwise(F.col("next_text")))
        .select("part", "place", "doc_id", "text", "next_text")
    )


def edited(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: its fingerprint, that of its edited text, and how alike they are.

    The edited text is the text with its last floor(n/2) code points replaced by the first
    as many, or all, of the next document's (falling ids, the first after the last).
    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (16 hex
    digits), near_edited, near_next (share of equal bits), n_near.  Null texts count as
    empty.  ``n_near`` is the number of other rows at most ``RADIUS`` bits apart, found by the
    block tables among all rows; null where ``QUERY_IDS`` does not divide the id.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-chars // PART_CHARS))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    pairs = with_next(docs, parts).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    )
    texts = pairs.select(
        "part", "place", "doc_id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.inline(F.array(F.struct(F.lit(0).alias("kind"), "text"), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))),
    )
    prints = fingerprints(texts, ["part", "place", "doc_id", "n_chars", "edited_sha256", "kind"])
    both = prints.groupBy("part", "place", "doc_id", "n_chars", "edited_sha256").agg(
        F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("own"),
        F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("other"),
    )
    # Places are dense in a part; the last of a part is followed by the first of the next part.
    both = stage(both, "simhash")
    return _beside(both).join(_near_rows(both), ["part", "place"], "left").drop("part", "place")


def _near_rows(both: DataFrame) -> DataFrame:
    """``(part, place, n_near)`` of the rows that are queries."""
    asked = both.where(F.pmod("doc_id", F.lit(QUERY_IDS)) == 0).select("part", "place", F.col("own").alias("fingerprint"))
    copies = both.groupBy(F.col("own").alias("near")).agg(F.count(F.lit(1)).alias("rows"))
    found = within_radius(asked, both.select(F.col("own").alias("fingerprint"))).join(copies, "near")
    # A row is within its own radius.
    found = stage(found.groupBy("fingerprint").agg((F.sum("rows") - 1).alias("n_near")), "simhash-near")
    return join_hot_key(asked, found, "fingerprint", "place").select("part", "place", "n_near")


def _beside(both: DataFrame) -> DataFrame:
    """Each row with the fingerprint of the row after it; the last row's is the first one's."""
    order = Window.partitionBy("part").orderBy("place")
    heads = both.where("place = 1").select("part", "own").orderBy("part").collect()  # one for each part
    if not heads:
        follows = both.sparkSession.createDataFrame([], "part int, head bigint")
    else:
        follows = both.sparkSession.createDataFrame(
            [(r["part"], heads[(i + 1) % len(heads)]["own"]) for i, r in enumerate(heads)], "part int, head bigint"
        )
    rows = both.withColumn("next", F.lead("own").over(order)).join(F.broadcast(follows), "part")
    after = F.coalesce("next", "head")
    return rows.select(
        "part", "place", "doc_id", "n_chars", "edited_sha256", _hex("own").alias("fingerprint"), _hex("other").alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), after).alias("near_next"),
    )


def _hex(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
