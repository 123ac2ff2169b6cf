"""Text expressions with Unicode rules that do not depend on the JVM's defaults."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space, digits and word characters.
WHITESPACE = r"\t-\r\x1c-\x1f\x85\p{Z}"
_WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
WORD = r"\p{L}\p{N}_"


_AFTER_WORD = re.compile(r"(?:[A-Za-z]|\\d\+|\))\Z")
_BEFORE_WORD = re.compile(r"(?:\((?:\?:)?)?(?:[A-Za-z]|\[A-Z])")


def _boundaries(pattern: str) -> str:
    """Spell out ``\\b`` for our word characters.

    Next to something that is a word character anyway, one look at the other
    side is enough.
    """
    done, *rest = pattern.split(r"\b")
    for tail in rest:
        if _AFTER_WORD.search(done):
            edge = f"(?![{WORD}])"
        elif _BEFORE_WORD.match(tail):
            edge = f"(?<![{WORD}])"
        else:
            edge = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
        done += edge + tail
    return done


def jvm_regex(pattern: str, flags: str = "") -> str:
    """Turn a portable pattern into a Java one.

    ``\\w \\s \\d \\b`` are spelled out as Unicode classes, which is both exact and
    faster than the JVM's Unicode mode.  ``u`` lets ignore-case work beyond
    ASCII; ``d`` lets only ``\\n`` end a line.
    """
    body = (
        _boundaries(pattern)
        .replace(r"\w", f"[{WORD}]")
        .replace(r"\S", f"[^{WHITESPACE}]")
        .replace(r"\s", f"[{WHITESPACE}]")
        .replace(r"\d", r"\p{Nd}")
    )
    if "i" in flags:
        # The one letter beyond ASCII that ignoring case should add, and Java does not.
        body = body.replace("A-Z", r"A-Z\u0130")
    return f"(?ud{flags}){body}"


def null_if_empty(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` worked out once, however often ``fn`` names it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def strip(col: Column) -> Column:
    """Remove white space (any Unicode kind) from both ends."""
    return F.btrim(col, F.lit(_WHITESPACE_CHARS))


def first_group(col: Column, pattern: str, group: int = 1, flags: str = "") -> Column:
    """First match's group, or null when nothing matched."""
    return null_if_empty(F.regexp_extract(col, jvm_regex(pattern, flags), group))


def all_matches(col: Column, pattern: str, flags: str = "", group: int = 0) -> Column:
    return F.regexp_extract_all(
        col, F.lit(jvm_regex(pattern, flags)), F.lit(group)
    )


def matches(col: Column, pattern: str, flags: str = "") -> Column:
    return col.rlike(jvm_regex(pattern, flags))


def word_count(col: Column) -> Column:
    return F.regexp_count(col, F.lit(jvm_regex(r"\S+")))


def tokenize(col: Column) -> Column:
    """Lower-cased runs of word characters.

    Lower-casing the text once is much cheaper than lower-casing every token.
    The two differ only where case mapping depends on neighbours or changes
    the length, so texts holding such a letter take the per-token route.
    """
    col = F.coalesce(col, F.lit(""))
    words = F.lit(f"[{WORD}]+")
    return F.when(
        col.contains("İ") | col.contains("Σ"),
        F.transform(F.regexp_extract_all(col, words, F.lit(0)), F.lower),
    ).otherwise(F.regexp_extract_all(F.lower(col), words, F.lit(0)))


def run_lengths(values: Column) -> Column:
    """``array<T>`` -> ``array<struct<item, n>>``: distinct values with their counts.

    Works inside one row (sort, then compare neighbours), so counting the terms
    of a document needs no shuffle.
    """
    def counted(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        ends = F.concat(
            F.slice(starts, 2, F.size(starts)), F.array(F.size(ordered))
        )
        return F.zip_with(
            starts,
            ends,
            lambda s, e: F.struct(
                F.get(ordered, s).alias("item"), (e - s).alias("n")
            ),
        )

    # A one-element transform binds the sorted array once.
    return F.flatten(
        F.transform(
            F.filter(F.array(F.sort_array(values)), lambda a: F.size(a) > 0), counted
        )
    )
