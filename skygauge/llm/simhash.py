"""Near copies by SimHash: fingerprints, links of few differing bits, and their components.

Fingerprints that are alike are one node, so copies are never paired. Of 64 bits in six blocks, two fingerprints
that differ in at most four bits have two blocks alike; rows that share two blocks meet in one bucket. In a bucket
a pivot table does the work: the Hamming distances of each fingerprint to many reference fingerprints. By the
triangle inequality the distances of a linked pair to any reference differ by no more than the pair's own distance,
so pairs are discarded by their largest coordinate difference, the first coordinate by sorting, the others one by
one, and only survivors are compared bit by bit. A bucket gives a spanning forest of its links, not the links.
Buckets over ``tile`` rows are split into tiles that are compared pair by pair, so a task's memory is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from skygauge.llm.common import beside_marks, materialized, whole_row, whole_text
from skygauge.llm.components import component_roots

SEED = 42
BITS = 64
#: Reference fingerprints: well mixed, and the same in every run.
PIVOTS = np.array([xxhash.xxh64_intdigest(str(k).encode(), SEED) for k in range(24)], dtype=np.uint64)


def fingerprint(text: str, words: int = 4) -> int:
    """The 64 bits, each set if it's set in over half of the hashes of the ``words``-word shingles."""
    parts = text.encode("utf-8", "replace").lower().split()  # of bytes: A to Z only, and white space of ASCII
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(parts) >= words:
        starts, ends = starts[:len(parts) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())], dtype=np.uint64)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        octets = hashes[at:at + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > len(hashes)).astype(np.uint64)
    return int((bits << np.arange(BITS, dtype=np.uint64)).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """Rows (``doc_id``, ``key``, ``bits``): a hash of id and text, and the whole text's fingerprint as a signed long."""
    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = np.array([fingerprint(text, words) for text in batch["text"]], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "key": batch["key"], "bits": bits})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text").mapInPandas(
        per_batch, "doc_id long, key long, bits long")


def block_masks(distance: int) -> list[int]:
    """Masks of the unions of blocks of which a linked pair shares one: ``distance + 2`` blocks, two alike."""
    blocks = distance + 2
    edges = [round(k * BITS / blocks) for k in range(blocks + 1)]
    part = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [x | y for x, y in combinations(part, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


class Forest:
    """Sets of rows, joined pair by pair in whole arrays."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def roots(self, rows: np.ndarray) -> np.ndarray:
        at = self.parent[rows]
        while (up := self.parent[at]).tobytes() != at.tobytes():
            at = up
        self.parent[rows] = at
        return at

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def linked_rows(group: np.ndarray, part: np.ndarray, bits: np.ndarray, distance: int,
                pivots: np.ndarray = PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """Within each group, each row that has a link and the first row of its set: a spanning forest as two arrays.

    ``part`` is -1 where all rows of the group are compared, else the tile of the row, and only rows of different
    tiles are.
    """
    table = np.bitwise_count(bits[:, None] ^ pivots[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], group))
    group, part, bits, table = group[order], part[order], bits[order], table[order]
    forest = Forest(len(bits))
    alive, shift = np.arange(len(bits)), 1
    while len(alive):
        alive = alive[alive + shift < len(bits)]
        other = alive + shift
        near = (group[alive] == group[other]) & (table[other, 0] - table[alive, 0] <= distance)
        alive, other = alive[near], other[near]
        a, b = alive, other
        crossing = (part[a] < 0) | (part[a] != part[b])
        a, b = a[crossing], b[crossing]
        for k in range(1, len(pivots)):
            if not len(a):
                break
            close = np.abs(table[a, k] - table[b, k]) <= distance
            a, b = a[close], b[close]
        same = np.bitwise_count(bits[a] ^ bits[b]) <= distance
        forest.join(a[same], b[same])
        shift += 1
    root = forest.roots(np.arange(len(bits)))
    child = np.flatnonzero(root != np.arange(len(bits)))
    return order[child], order[root[child]]


def links(distinct: DataFrame, distance: int = 4, tile: int = 20_000) -> DataFrame:
    """Rows (``a``, ``b``): links between fingerprints (column ``bits``, each once) that span all components."""
    masks = F.array(*[F.lit(m) for m in block_masks(distance)])
    rows = distinct.select("bits", F.posexplode(masks).alias("block", "mask")).select(
        "bits", F.xxhash64("block", F.col("bits").bitwiseAND(F.col("mask"))).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(sizes, "bucket").withColumn("parts", F.ceil(F.col("n") / tile).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("bits"), F.col("parts")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = rows.select("bits", "bucket", "own", "parts", every.alias("met"))
    rows = rows.select("bits", F.xxhash64("bucket", F.least("own", "met"), F.greatest("own", "met")).alias("tile"),
                       F.when(F.col("own") == F.col("met"), -1).otherwise(F.col("own")).alias("part"))

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def forest(rows: pd.DataFrame) -> pd.DataFrame:
            bits = rows["bits"].to_numpy()
            child, root = linked_rows(rows["tile"].to_numpy(), rows["part"].to_numpy(), bits.view(np.uint64), distance)
            return pd.DataFrame({"a": bits[child], "b": bits[root]}).drop_duplicates()

        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            whole = held["tile"] != held["tile"].iloc[-1] if len(held) else None
            if whole is not None and whole.any():  # all but the last tile have all their rows
                yield forest(held[whole].reset_index(drop=True))
                held = held[~whole].reset_index(drop=True)
        if held is not None and len(held):
            yield forest(held)

    spread = rows.select("tile", "part", "bits").repartition("tile").sortWithinPartitions("tile")
    return spread.mapInPandas(compared, "a long, b long").distinct()


def components(docs: DataFrame, distance: int = 4, words: int = 4) -> DataFrame:
    """Rows (``doc_id``, ``key``, ``bits``, ``root``, ``lowest_id``) for each row of ``docs``: the fingerprint, the one
    that stands for its component, and the component's smallest id."""
    marked = materialized(fingerprints(docs, words))
    distinct = materialized(marked.groupBy("bits").agg(F.min("doc_id").alias("first_id")))
    roots = component_roots(links(distinct.select("bits"), distance)).withColumnRenamed("node", "bits")
    lowest = roots.join(distinct, "bits").groupBy("root").agg(F.min("first_id").alias("lowest"))
    linked = roots.join(lowest, "root").select("bits", "root", "lowest")
    own = distinct.join(linked, "bits", "left").select(
        "bits", F.coalesce("root", "bits").alias("root"), F.coalesce("lowest", "first_id").alias("lowest_id"))
    return marked.join(own, "bits")


def near_duplicates(docs: DataFrame, distance: int = 4, words: int = 4) -> DataFrame:
    """Rows (``doc_id``, ``fingerprint``, ``component_id``), one for each row of ``docs``.

    The component's id is the smallest ``doc_id`` that links reach, itself included; links join fingerprints of at
    most ``distance`` differing bits. A null or empty text has fingerprint zero and links like any other; a text
    with fewer words than a shingle is one shingle. Null ids stay null and never are a component's id unless all
    its ids are null. Repeated rows stay; other columns are ignored; an empty table gives no rows.
    """
    return components(docs, distance, words).select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), F.col("lowest_id").alias("component_id"))


def one_of_each(docs: DataFrame, distance: int = 4, words: int = 4) -> DataFrame:
    """Of each component the row with the smallest id (a null id only if there's no other), with all its columns.

    Of rows alike in id and text one stays.
    """
    found = materialized(components(docs, distance, words).select("doc_id", "key", "root"))
    first = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "key")
    kept = found.groupBy("root").agg(F.min(first).alias("first")).select(F.col("first.key").alias("key"))
    repeated = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # most texts stay, so those that go or that have copies are marked
    kept = kept.distinct().withColumn("kept", F.lit(True))
    marks = materialized(found.select("key").distinct().join(kept, "key", "left").join(repeated, "key", "left").where(
        "kept is null or n is not null").select("key", F.coalesce("kept", F.lit(False)).alias("kept")))
    keyed = docs.select(whole_row(docs), F.xxhash64(F.col("doc_id").cast("long"), whole_text()).alias("key"))
    maybe, single = beside_marks(keyed, marks, ["key"])
    kept_once = maybe.where("kept").dropDuplicates(["key"]).select("row")
    return single.select("row").union(maybe.where("kept is null").select("row")).union(kept_once).select("row.*")
