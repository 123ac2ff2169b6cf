"""Secret scans with DataFrame functions only.

Base rules find assignments, access keys and hex strings.  The method adds what they miss:
runs of key characters are scored by two character Markov models, one of random
strings and one of ordinary identifiers, and a run whose log-likelihood ratio is high is
taken as a secret.

The models are bigram counts of labelled samples.  Where no samples are given, the
corpus labels its own: values found by the base rules are random strings, all other
runs are identifiers.  Counting is one aggregate over all of them; its result has
at most 128 * 128 rows for each model.

Positions come from cutting a text at the matches of a rule and adding up lengths.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in order, and what each takes.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_MIN = 6

#: Runs that are scored.
RUN = r"[A-Za-z0-9+/_=-]{12,}"
#: Items in a block of the folds over one text's matches.
BLOCK = 256
#: What a run must reach: in all (natural log), and for each character.
MIN_RATIO, MIN_MEAN = 15.0, 0.6
SIZE = 128
ALPHABET = 65
MASK = "[SECRET]"


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio of each pair of neighbouring characters, by ``SIZE * first + second``."""

    ratios: np.ndarray

    def column(self) -> Column:
        return F.lit(self.ratios)


def _let(value: Column, fn) -> Column:
    """``fn(value)`` with the value worked out once, also where ``fn`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _blocks(items: Column) -> Column:
    """An array cut into arrays of ``BLOCK`` items."""
    last = F.greatest(F.lit(0), F.ceil(F.size(items) / BLOCK).cast("int") - 1)
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * BLOCK + 1, BLOCK))


def _before(items: Column, value, combine) -> Column:
    """For each item what ``combine`` makes of 0 and the values of all items before it.

    Appending copies an array, so totals go from block to block first and then, block by block,
    from item to item.
    """
    def inside(block: Column, at: Column) -> Column:
        zero = F.struct(at.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            block, zero,
            lambda acc, x: F.struct(combine(acc["at"], value(x)).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")),
            lambda acc: acc["out"],
        )

    def through(blocks: Column) -> Column:
        # A block's total is made before it is appended, from the totals so far.
        starts = F.aggregate(
            blocks, F.array(F.lit(0)),
            lambda acc, block: F.array_append(
                acc, combine(F.element_at(acc, -1), F.aggregate(block, F.lit(0), lambda total, x: combine(total, value(x))))
            ),
        )
        return F.flatten(F.zip_with(blocks, F.slice(starts, 1, F.size(blocks)), inside))

    return _let(_blocks(items), through)


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches as ``array<struct<start, end, value>>``: code points, end exclusive, value of the group."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    steps = F.zip_with(
        between, F.arrays_zip(found.alias("m"), values.alias("v")),
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit["m"]).alias("size"), hit["v"].alias("value")),
    )

    def placed(hits: Column) -> Column:
        return F.zip_with(
            hits, _before(hits, lambda x: x["gap"] + x["size"], lambda a, b: a + b),
            lambda x, at: F.struct(
                (at + x["gap"]).alias("start"), (at + x["gap"] + x["size"]).alias("end"), x["value"].alias("value")
            ),
        )

    # The last gap has no match after it.
    return _let(F.filter(steps, lambda x: x["size"].isNotNull()), placed)


def _replaced(text: Column, spans: Column, fill) -> Column:
    """``text`` with ``fill(span)`` in place of each span; ``spans`` are sorted by start and may overlap.

    ``fill`` also gets where the spans before it end.  Texts are cut block by block, since cutting
    counts code points from the front.
    """
    def joined(items: Column) -> Column:
        def block(part: Column) -> Column:
            base = F.get(part, F.lit(0))["before"]
            own = F.substring(text, base + 1, F.greatest(F.element_at(part, -1)["start"] - base, F.lit(0)))
            return _let(F.struct(base.alias("base"), own.alias("own")), lambda o: F.array_join(
                F.transform(part, lambda x: F.concat(
                    F.substring(o["own"], x["before"] - o["base"] + 1, F.greatest(x["start"] - x["before"], F.lit(0))), fill(x)
                )), "",
            ))

        ends = F.greatest(F.element_at(items, -1)["before"], F.element_at(items, -1)["end"])
        return F.concat(F.array_join(F.transform(_blocks(items), block), ""), F.substring(text, ends + 1, F.length(text)))

    def placed(all_: Column) -> Column:
        return _let(F.zip_with(
            all_, _before(all_, lambda x: x["end"], lambda a, b: F.greatest(a, b)),
            lambda x, at: F.struct(x["start"].alias("start"), x["end"].alias("end"), at.alias("before")),
        ), joined)

    return F.when(F.size(spans) > 0, _let(spans, placed)).otherwise(text)


def _where(holds: Column, found: Column) -> Column:
    return F.when(holds, found).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))


_T, _PARTS, _BASE, _REST, _RUNS, _ALL = "__text", "__parts", "__base", "__rest", "__runs", "__spans"


def _scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__base``, matches of the base rules, and ``__runs``, runs of what they leave; both by start."""
    own = F.col(_T)
    assign = F.filter(_matches(own, ASSIGN, 2), lambda m: F.length(m["value"]) >= ASSIGN_MIN)
    marked = [
        _where((own.contains("=") | own.contains(":")) & own.rlike(ASSIGN), assign),
        _where(own.contains("AKIA"), _matches(own, ACCESS)),
        _where(own.rlike(HEX), _matches(own, HEX)),
    ]
    found = docs.withColumn(_T, F.coalesce(F.col(text), F.lit("")))
    found = found.withColumn(_PARTS, F.struct(*(m.alias(f"k{i}") for i, m in enumerate(marked))))

    def kind(i: int) -> Column:
        return F.transform(
            F.col(_PARTS)[f"k{i}"],
            lambda m: F.struct(m["start"].alias("start"), F.lit(i).alias("kind"), m["end"].alias("end"), m["value"].alias("value")),
        )

    found = found.withColumn(_BASE, F.array_sort(F.concat(*(kind(i) for i in range(3)))))

    # Spaces in place of base spans: what is left of a run beside one is a run of its own.
    hidden = _replaced(own, F.col(_BASE), lambda x: F.repeat(
        F.lit(" "), F.greatest(x["end"] - F.greatest(x["start"], x["before"]), F.lit(0))
    ))
    found = found.withColumn(_REST, hidden)
    rest = F.col(_REST)
    return found.withColumn(_RUNS, _where(rest.rlike(RUN), _matches(rest, RUN))).drop(_PARTS, _REST)


def _codes(value: Column) -> Column:
    return F.transform(F.split(value, ""), lambda c: F.ascii(c))


def _pairs(value: Column) -> Column:
    """Codes of neighbouring characters, ``SIZE * first + second``."""
    codes = _codes(value)
    return F.zip_with(
        F.slice(codes, 1, F.greatest(F.length(value) - 1, F.lit(0))), F.slice(codes, 2, F.greatest(F.length(value) - 1, F.lit(0))),
        lambda a, b: a * SIZE + b,
    )


def samples(docs: DataFrame) -> DataFrame:
    """``(value, random)`` from ``docs(text)``: base values are random, all other runs are not."""
    found = _scan(docs.select("text"))
    both = F.concat(
        F.transform(_BASE, lambda m: F.struct(m["value"].alias("value"), F.lit(True).alias("random"))),
        F.transform(_RUNS, lambda m: F.struct(m["value"].alias("value"), F.lit(False).alias("random"))),
    )
    return found.select(F.explode(both).alias("s")).select("s.value", "s.random")


def fit(labelled: DataFrame) -> Model:
    """Models from labelled samples ``(value, random)``; ASCII pairs count, others are passed over.

    Random strings are smoothed towards the uniform, identifiers towards their own
    characters' frequencies.  Without samples of a kind that kind is uniform.
    """
    pairs = labelled.where("value IS NOT NULL AND random IS NOT NULL").select(
        "random", F.explode(_pairs(F.col("value"))).alias("pair")
    )
    # At most SIZE * SIZE rows for each kind.
    counted = pairs.where(F.col("pair").between(0, SIZE * SIZE - 1)).groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros((2, SIZE, SIZE))
    for row in counted.collect():
        counts[int(row["random"]), row["pair"] // SIZE, row["pair"] % SIZE] = row["n"]

    def logs(n: np.ndarray, strength: float, base: np.ndarray) -> np.ndarray:
        return np.log((n + strength * base) / (n.sum(axis=1, keepdims=True) + strength))

    uniform = np.full(SIZE, 1 / ALPHABET)
    seen = counts[0].sum(axis=0) + 0.01 * max(counts[0].sum(), 1) * uniform
    words = seen / seen.sum()
    # Random strings: their own pairs, but never far below the uniform.
    random = np.logaddexp(logs(counts[1], 200.0, uniform) + np.log(0.7), np.log(0.3 * uniform))
    # An identifiers' pair needs many samples, since some of their runs are secrets themselves.
    ratios = random - logs(counts[0], 500.0, words)
    return Model(np.ascontiguousarray(ratios.ravel(), np.float64))


def ratio(value: Column, model: Model) -> Column:
    """Log-likelihood ratio of random string against identifier, for ASCII text."""
    table = model.column()
    return F.aggregate(
        _pairs(value), F.lit(0.0), lambda total, pair: total + F.coalesce(F.try_element_at(table, (pair + 1).cast("int")), F.lit(0.0))
    )


def find_secrets(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``__base`` and ``__spans``: ``array<struct<start, kind, end, value>>`` by start and kind.

    ``__spans`` has the base matches and, beside them, the runs the models take as
    secrets; ``kind`` is a place in ``KINDS``.  Null texts count as empty and have none.
    """
    found = _scan(docs, text)

    def random(run: Column) -> Column:
        value = ratio(run["value"], model)
        return value >= F.greatest(F.lit(MIN_RATIO), MIN_MEAN * F.length(run["value"]))

    added = F.transform(
        F.filter(_RUNS, random),
        lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("kind"), m["end"].alias("end"), m["value"].alias("value")),
    )
    return found.withColumn(_ALL, F.array_sort(F.concat(_BASE, added))).drop(_RUNS)


def _told(spans: str) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov.

    One row for each row, in any order; ids may repeat or be null.  An empty table
    gives no row.
    """
    docs = docs.select("doc_id", "text")
    found = find_secrets(docs, model or fit(samples(docs)))

    def count(kind: int) -> Column:
        return F.size(F.filter(_ALL, lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"),
        count(2).alias("n_hex"), F.sha2(_told(_BASE), 256).alias("base_sha256"), _told(_ALL).alias("spans"),
        count(3).alias("n_markov"),
    )


def redact(docs: DataFrame, model: Model | None = None, mask: str = MASK) -> DataFrame:
    """``docs``, all rows and columns, with every secret in ``text`` replaced by ``mask``.

    Where ``n_chars`` is there it is counted anew for the texts that change.  Spans that
    overlap become one mask.  Null texts stay null.
    """
    found = find_secrets(docs, model or fit(samples(docs)))
    clean = _replaced(F.col(_T), F.col(_ALL), lambda x: F.when(x["start"] >= x["before"], mask).otherwise(""))
    hit = F.size(_ALL) > 0
    out = found.withColumn("text", F.when(hit, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        n = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(hit, n).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
