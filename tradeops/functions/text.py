"""Text clean-up, keys and pattern tests as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_upper(c: Column | str) -> Column:
    """Upper case without outer spaces."""
    return F.upper(F.trim(col(c)))


def or_na(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit("NA"))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def squeeze(c: Column | str) -> Column:
    """Drop double spaces (not collapse them), then underscore the single ones."""
    dropped = F.replace(col(c), F.lit("  "), F.lit(""))
    return F.replace(dropped, F.lit(" "), F.lit("_"))


def name_key(c: Column | str) -> Column:
    """The key under which people's names are compared across systems."""
    return F.upper(squeeze(F.trim(col(c))))


def late_trim_key(c: Column | str) -> Column:
    """`name_key` with the trim applied last: outer single spaces survive as '_'."""
    return F.upper(F.trim(squeeze(c)))


def part(c: Column | str, sep: str, index: int) -> Column:
    """1-based field of a separated text; '' past the end."""
    return F.split_part(col(c), F.lit(sep), F.lit(index))


def joined(*parts: Column | str) -> Column:
    """Concatenation in which one NULL makes the whole NULL."""
    return F.concat(*[col(p).cast("string") for p in parts])


def surrogate_key(*parts: Column | str) -> Column:
    """Lower-hex md5 of the concatenated parts; NULL if any part is NULL."""
    return F.md5(joined(*parts))


def matches(c: Column | str, pattern: str) -> Column:
    """Case-insensitive regular-expression test under three-valued logic."""
    return col(c).rlike("(?i)" + pattern)


def surely_matches(c: Column | str, pattern: str) -> Column:
    """Like `matches`, but NULL counts as no."""
    return F.coalesce(matches(c, pattern), F.lit(False))


def lacks(c: Column | str, pattern: str) -> Column:
    """No match found; a NULL text has no match either, so it passes."""
    return ~surely_matches(c, pattern)


def captured(c: Column | str, pattern: str) -> Column:
    """The first match in its own case, NULL when there is none."""
    return F.regexp_substr(col(c), F.lit("(?i)" + pattern))


def title_words(c: Column | str) -> Column:
    """Capitalise every run of letters and digits; what stands between them is kept."""
    words = F.split(F.lower(col(c)), r"(?<![\p{L}\p{N}])(?=[\p{L}\p{N}])")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), "")


def flag_set(c: Column | str) -> Column:
    """Flags arrive as boolean or 0/1."""
    return col(c).cast("int") == 1


def choose(rules: list[tuple[Column, object]], otherwise: object = None) -> Column:
    """Ordered rules: the first condition that is true gives the value."""
    first, *rest = rules
    start = F.when(first[0], first[1])
    chain = reduce(lambda acc, rule: acc.when(rule[0], rule[1]), rest, start)
    return chain if otherwise is None else chain.otherwise(otherwise)
