"""What each of several filters removes, alone and after others, in every order of them.

A document is reduced to the mask of the filters that it fails, a part of the corpus to the counts of its masks. A walk
over all subsets of the filters in Gray-code order switches one filter on or off at a time; each mask has a counter of
its failing filters that are switched on, and the running survivors change only where a counter leaves or reaches zero.
The survivors of the 32 subsets are stored, and whatever an order removes is a difference of two of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from skygauge.llm.common import stored, whole_text

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
WORD = r"[^\x20\x09-\x0D]+"
STEP_COLUMNS = "kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failed_by_text(text: Column, words: Column) -> Column:
    """Mask of the first four filters: few words, few distinct words, many capitals, marks of code."""
    count = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [count < 200, 100 * F.size(F.array_distinct(words)) < 50 * count, 100 * capitals > 2 * F.length(text),
             text.rlike(r"[#$%&*|]")]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (``part``, ``mask``, ``n``, ``good``, ``toxic``): documents of each source by the filters that they fail.

    The fifth filter fails a text that a smaller ``doc_id`` has too; texts are told apart by SHA-256. A null id is not
    smaller than any and fails no such filter. Null texts are empty, null sources the part ``''``. A document is good or
    toxic if any label row of its id says so; ids without labels are neither. Equal rows count each.

    Rows of one text are counted by id, then by part and labels, before they meet: a text that a third of all rows
    share is a few rows for each task by then.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"),
                       whole_text().alias("text"))
    rows = rows.select("doc_id", "part", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                       failed_by_text(F.col("text"), F.col("words")).alias("mask"))
    seen = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    # null ids join nothing, so they needn't go to one task
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0))
    said = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic")).withColumn("spread", F.lit(0).cast("long"))
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("is_good", "is_toxic")]
    known = seen.withColumn("spread", spread).join(said, ["doc_id", "spread"], "left").select(
        "doc_id", "part", "digest", "mask", *flags, "n")
    kind = ["part", "mask", "is_good", "is_toxic"]
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first")
    groups = stored(known.groupBy("digest", *kind).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without_id"), first),
        "filter_audit")
    lowest = groups.groupBy("digest").agg(F.min("first.doc_id").alias("lowest"))
    has_first = F.coalesce(F.col("first.doc_id") == F.col("lowest"), F.lit(False))
    passing = F.col("without_id") + F.when(has_first, F.col("first.n")).otherwise(0)
    cells = F.array(F.struct("mask", passing.alias("n")),
                    F.struct((F.col("mask") + COPY).alias("mask"), (F.col("n") - passing).alias("n")))
    split = groups.join(lowest, "digest").select("part", "is_good", "is_toxic", F.inline(cells))
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def survivors(counts: np.ndarray, filters: int = len(FILTERS)) -> np.ndarray:
    """Of counts by mask (last axis) the survivors of each subset of the filters, by the subset's bits."""
    masks = np.arange(1 << filters)
    failing = np.zeros(1 << filters, np.int64)  # for each mask: its filters that are switched on
    states = np.empty_like(counts)
    running, subset = counts.sum(axis=-1), 0
    states[..., 0] = running
    for step in range(1, 1 << filters):
        bit = (step & -step).bit_length() - 1  # the place where this Gray code differs from the last
        hit = (masks >> bit) & 1 == 1
        subset ^= 1 << bit
        if subset >> bit & 1:
            running = running - counts[..., hit & (failing == 0)].sum(axis=-1)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            running = running + counts[..., hit & (failing == 0)].sum(axis=-1)
        states[..., subset] = running
    return states


def _steps(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """For each order and step: the order, the step, its filter's place and the subset applied before."""
    out = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(filters[k] for k in order), step, f, before))
            before |= 1 << f
    return out


def order_rows(states: np.ndarray) -> dict[str, np.ndarray]:
    """Of the survivors by (part, one of all, good and toxic, subset) the columns of each step, by (part, step)."""
    filters, whole = len(FILTERS), (1 << len(FILTERS)) - 1
    steps = _steps()
    f, before = (np.array([s[k] for s in steps]) for k in (2, 3))
    after = before | (1 << f)
    lost = states[..., before] - states[..., after]
    alone = np.stack([states[:, 0, 0] - states[:, 0, 1 << k] for k in range(filters)], axis=1)
    only = np.stack([states[:, 0, whole ^ (1 << k)] - states[:, 0, whole] for k in range(filters)], axis=1)
    summed = np.zeros_like(alone)
    for k in range(filters):
        for subset in range(1 << filters):
            if not subset >> k & 1:
                size = subset.bit_count()
                orders = factorial(size) * factorial(filters - 1 - size)
                summed[:, k] += orders * (states[:, 0, subset] - states[:, 0, subset | 1 << k])
    return {"kept": states[:, 0][:, after], "removed": lost[:, 0], "redundant": alone[:, f] - lost[:, 0],
            "unique_fails": only[:, f], "good_lost": lost[:, 1], "toxic_lost": lost[:, 2], "shapley": summed[:, f]}


def audit(counts: DataFrame) -> DataFrame:
    """Rows (``part``, ``filter_order``, ``step``, then what the step does) for all orders of the filters in each part.

    ``counts`` are rows of :func:`mask_counts`, of which a part has at most 32. Of each step: the documents kept after
    it, removed by it, failing its filter but removed earlier, failing its filter only, removed ones that are good and
    toxic, and what the filter removes summed over all orders. Steps that remove nothing have zeros.
    """
    steps = _steps()

    def walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                some = batch[at:at + 256]
                table = np.zeros((len(some), 3, 1 << len(FILTERS)), np.int64)
                for row, cells in enumerate(some["cells"]):
                    for cell in cells:
                        table[row, :, cell["mask"]] = cell["n"], cell["good"], cell["toxic"]
                columns = {name: x.reshape(-1) for name, x in order_rows(survivors(table)).items()}
                yield pd.DataFrame({"part": np.repeat(some["part"].to_numpy(), len(steps)),
                                    "filter_order": [s[0] for s in steps] * len(some),
                                    "step": [s[1] for s in steps] * len(some)} | columns)

    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return cells.mapInPandas(walked, f"part string, filter_order string, step int, {STEP_COLUMNS}")
