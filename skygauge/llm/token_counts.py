"""Exact histogram of encoded lengths, with the sums that answer every context limit.

Documents are aggregated by their number of ids, so what is shuffled is one row a length and task. Sums over all
longer or shorter lengths are taken in two steps, within ranges of lengths and over the ranges, so that no task
holds the whole histogram.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from skygauge.llm.common import materialized, whole_text
from skygauge.llm.encoding import encoder, vocabulary_path

#: Lengths in one range; the ranges' totals are the only rows that meet in one task.
RANGE_LENGTHS = 1024


def encoded_lengths(docs: DataFrame, path: str | None = None, column: str = "text", name: str = "n_tokens") -> DataFrame:
    """``docs`` with the number of ids of ``column``; a null text has none."""
    path = path or vocabulary_path()

    @F.pandas_udf("long")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(path)
        for texts in batches:
            yield pd.Series([len(bpe.ids(text)) for text in texts], dtype="int64")

    return docs.select(*[c for c in docs.columns if c != name], lengths(whole_text(column)).alias(name))


def histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """Rows (``context``, ``n_docs``): how many documents have exactly so many tokens."""
    return lengths.groupBy(F.col(column).cast("long").alias("context")).agg(F.count(F.lit(1)).alias("n_docs"))


def limit_table(hist: DataFrame) -> DataFrame:
    """For each length that occurs, taken as context limit, what a corpus cut there holds.

    ``n_docs`` documents have exactly this length, ``docs_within`` at most this, ``docs_over`` more;
    ``tokens_within`` and ``tokens_over`` are their whole tokens; ``truncated_tokens`` is the total if every
    document is cut at the limit; ``quantile`` is the share of documents within. An empty histogram gives no rows.
    """
    # written first: the sums read it twice, and each time would encode all texts again
    rows = materialized(hist).select("context", "n_docs", (F.col("context") * F.col("n_docs")).alias("tokens"),
                       F.floor(F.col("context") / RANGE_LENGTHS).alias("range"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("range").rowsBetween(1, Window.unboundedFollowing)
    ranges = rows.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    ranges = ranges.select("range", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(name) for c, w, name in (
        ("d", before, "docs_before"), ("t", before, "tokens_before"),
        ("d", after, "docs_after"), ("t", after, "tokens_after"))])
    upto = Window.partitionBy("range").orderBy("context").rowsBetween(Window.unboundedPreceding, 0)
    above = Window.partitionBy("range").orderBy("context").rowsBetween(1, Window.unboundedFollowing)
    sums = rows.join(ranges, "range").select(
        "context", "n_docs", "tokens",
        (F.sum("n_docs").over(upto) + F.col("docs_before")).alias("docs_within"),
        (F.coalesce(F.sum("n_docs").over(above), F.lit(0)) + F.col("docs_after")).alias("docs_over"),
        (F.sum("tokens").over(upto) + F.col("tokens_before")).alias("tokens_within"),
        (F.coalesce(F.sum("tokens").over(above), F.lit(0)) + F.col("tokens_after")).alias("tokens_over"))
    return sums.select(
        "context", "n_docs", "docs_within", "docs_over", "tokens_within", "tokens_over",
        (F.col("tokens_within") + F.col("context") * F.col("docs_over")).alias("truncated_tokens"),
        (F.col("docs_within") / (F.col("docs_within") + F.col("docs_over"))).alias("quantile"))


def at_limits(hist: DataFrame, limits: Sequence[int]) -> DataFrame:
    """For any limits, whether such a length occurs or not: ``docs_within``, ``tokens_within``, ``truncated_tokens``.

    ``limits`` is a short list; each takes one sum over the histogram, all in one pass.
    """
    wanted = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("limit")
    within = F.col("context") <= F.col("limit")
    return hist.select("context", "n_docs", wanted).groupBy("limit").agg(
        F.sum(F.when(within, F.col("n_docs")).otherwise(0)).alias("docs_within"),
        F.sum(F.when(within, F.col("n_docs") * F.col("context")).otherwise(0)).alias("tokens_within"),
        F.sum(F.col("n_docs") * F.least("context", "limit")).alias("truncated_tokens"))


def length_quantiles(table: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The smallest length that at least each share of the documents stays within, from :func:`limit_table`."""
    wanted = F.explode(F.array(*[F.lit(float(x)) for x in shares])).alias("share")
    return table.select("context", "quantile", wanted).where("quantile >= share").groupBy("share").agg(
        F.min("context").alias("context"))
