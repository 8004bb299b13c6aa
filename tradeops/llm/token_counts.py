"""Token counts from prefix dynamic programming.

For every prefix of a text, the count of its tokens is exact: words are the steps of the tokenizer's splitting pattern,
and within a word each prefix's last token follows from shorter prefixes (``byte_pairs``). Sums over words give totals;
with ``prefixes`` the whole table is kept, so truncation and budgets are answered by ``tokens_at`` and
``longest_within`` without encoding again; ``with_budget`` answers one budget from the counts around its place.

Defined cases: a null or empty text has no tokens (and the table ``[0]``); repeated rows are counted like any other;
further columns pass through. Texts of any length are counted whole; memory is a text's words and a bounded word table.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .byte_pairs import prefix_counter


def with_token_counts(
    df: DataFrame, tokenizer: str, text: str = "text", n_tokens: str = "n_tokens", prefixes: str | None = None
) -> DataFrame:
    """``df`` with ``n_tokens`` and, if named, ``prefixes``: array<int>, the count at code points 0 .. length."""

    @F.pandas_udf("bigint")
    def totals(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = prefix_counter(tokenizer)
        for batch in batches:
            yield pd.Series(counter.totals(batch.tolist()), dtype="int64")

    @F.pandas_udf("array<int>")
    def tables(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = prefix_counter(tokenizer)
        for batch in batches:
            yield batch.map(counter.prefixes)

    whole = F.coalesce(df[text], F.lit(""))
    if prefixes is None:
        return df.withColumn(n_tokens, totals(whole))
    df = df.withColumn(prefixes, tables(whole))
    return df.withColumn(n_tokens, tokens_at(F.col(prefixes), F.size(prefixes) - 1).cast("long"))


def with_budget(
    df: DataFrame, tokenizer: str, budget: int, text: str = "text", n_tokens: str = "n_tokens", chars: str = "chars_within"
) -> DataFrame:
    """``df`` with ``n_tokens`` and ``chars``, the code points of the longest prefix of at most ``budget`` tokens (all, if they fit).

    Answered from the counts at prefixes near the place where the budget runs out, so texts of any length need no table.
    """

    @F.pandas_udf("n bigint, chars bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = prefix_counter(tokenizer)
        for batch in batches:
            totals, fits = counter.with_budget(batch.tolist(), budget)
            yield pd.DataFrame({"n": totals, "chars": fits}, dtype="int64")

    given = [c for c in df.columns if c not in (n_tokens, chars)]
    # Given columns travel as one, so that none can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in given]).alias("row")
    counted = df.select(row, count(F.coalesce(df[f"`{text}`"], F.lit(""))).alias("counted"))
    return counted.select("row.*", F.col("counted.n").alias(n_tokens), F.col("counted.chars").alias(chars))


def tokens_at(prefixes: Column, chars: Column | int) -> Column:
    """Tokens of the first ``chars`` code points; null beyond the text."""
    return F.get(prefixes, F.lit(chars) if isinstance(chars, int) else chars)


def longest_within(prefixes: Column, budget: int) -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens (counts may fall again as a word goes on)."""
    return F.coalesce(F.array_max(F.transform(prefixes, lambda c, i: F.when(c <= budget, i))), F.lit(0))
