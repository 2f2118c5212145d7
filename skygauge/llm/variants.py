"""Spelling variants: words of a corpus that differ by one letter from a far more frequent one.

The vocabulary is searched with a bit-sliced position index: for each position and letter, the set of words with that
letter there, as bits. For every word of a block at once, recurrences over the positions keep four sets as bits: words
alike so far, and words with one letter replaced, one more (read one position ahead) or one less (one behind).

Two words one letter apart share their first half or their second half, so words meet in one bucket for each half and
length of the longer word. Small buckets share a block, a bucket over ``TILE`` words or ``TILE_LETTERS`` letters is split
into tiles that are compared pair by pair; so a block's index is bounded, and no bucket is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from skygauge.llm.common import ascii_lower, materialized, whole_text

#: Letters of words; all lie in Latin-1, so that a word has one byte for each code point.
LETTERS = r"[A-Za-zÀ-ÿ]"
BLOCK, TILE, TILE_LETTERS = 1024, 4096, 1 << 23


def letter_runs(docs: DataFrame, shortest: int = 1) -> DataFrame:
    """Rows (``id``, ``run``): each maximal run of at least ``shortest`` letters of each text, A to Z in lower case.

    ``id`` is the document's id as text, empty for a null. Null texts have no runs; equal rows have their own.
    """
    found = F.regexp_extract_all(whole_text(), F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    return rows.withColumn("run", F.when(F.col("run").rlike("[A-Z]"), ascii_lower(F.col("run"))).otherwise(F.col("run")))


def with_slips(runs: DataFrame, divisor: int = 31) -> DataFrame:
    """Column ``word``: the run, without one letter if ``divisor`` divides the checksum of ``<id>:<run>``, which also
    chooses the letter."""
    checksum = F.crc32(F.concat("id", F.lit(":"), "run"))
    slipped = F.expr("concat(substring(run, 1, cast(checksum % length(run) as int)),"
                     " substring(run, cast(checksum % length(run) as int) + 2))")
    return runs.withColumn("checksum", checksum).select(
        F.when(F.col("checksum") % divisor == 0, slipped).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, shortest: int = 7, fewest: int = 2) -> DataFrame:
    """Rows (``word``, ``n``): words of at least ``shortest`` letters that occur at least ``fewest`` times."""
    long_enough = words.select("word").where(F.length("word") >= shortest)
    return long_enough.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= fewest)


class PositionIndex:
    """Words as letters by position; ``at`` gives the sets of words with each letter at a position."""

    def __init__(self, words: list[bytes]):
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.width = int(self.sizes.max(initial=0))
        self.lanes = -(-len(words) // 64)
        padded = b"".join(w.ljust(self.width, b"\0") for w in words)
        letters, codes = np.unique(np.frombuffer(padded, np.uint8), return_inverse=True)
        if not len(letters) or letters[0]:  # code 0 is for no letter
            letters, codes = np.append(np.uint8(0), letters), codes + 1
        self.kinds = len(letters)
        self.codes = codes.astype(np.uint8).reshape(len(words), self.width)

    def bits(self, flags: np.ndarray) -> np.ndarray:
        """Rows of flags, one for each word, as rows of 64-bit lanes."""
        packed = np.packbits(flags, axis=1, bitorder="little")
        return np.pad(packed, ((0, 0), (0, self.lanes * 8 - packed.shape[1]))).view(np.uint64)

    def at(self, position: int) -> np.ndarray:
        """A set for each letter: the words that have it at the position. No word has letter 0."""
        if not 0 <= position < self.width:
            return np.zeros((self.kinds, self.lanes), np.uint64)
        sets = self.bits(self.codes[:, position] == np.arange(self.kinds)[:, None])
        sets[0] = 0
        return sets

    def of_size(self, sizes: np.ndarray) -> np.ndarray:
        """For each given size the set of words of it."""
        kinds, place = np.unique(sizes, return_inverse=True)
        return self.bits(self.sizes == kinds[:, None])[place]

    def one_apart(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each word the sets of words with one letter replaced, with one more and with one less."""
        shape = (len(self.sizes), self.lanes)
        alike = np.full(shape, ~np.uint64(0))
        replaced, more, less = (np.zeros(shape, np.uint64) for _ in range(3))
        found = tuple(np.zeros(shape, np.uint64) for _ in range(3))
        behind, here = self.at(-1), self.at(0)
        for position in range(self.width):
            ahead, letter = self.at(position + 1), self.codes[:, position]
            same = here[letter]
            less = (less & behind[letter]) | alike
            more = (more | alike) & ahead[letter]
            replaced = (replaced & same) | (alike & ~same)
            alike = alike & same
            behind, here = here, ahead
            ended = np.flatnonzero(self.sizes == position + 1)
            if len(ended):
                size = self.sizes[ended]
                found[0][ended] = replaced[ended] & self.of_size(size)
                found[1][ended] = (more[ended] | alike[ended]) & self.of_size(size + 1)
                found[2][ended] = less[ended] & self.of_size(size - 1)
        return found


def _places(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and place of each bit that is set."""
    row, lane = np.nonzero(sets)
    flags = np.unpackbits(sets[row, lane].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    hit, bit = np.nonzero(flags)
    return row[hit], lane[hit] * 64 + bit


def _best_of_block(rows: pd.DataFrame) -> pd.DataFrame:
    """For each word of a block the number of near words it meets there, and the most frequent of them.

    A pair counts in the bucket of its first half, or in that of its second half if the first ones differ.
    """
    words = [w.encode("latin-1") for w in rows["word"]]
    index = PositionIndex(words)
    longest, tile, part = (rows[c].to_numpy() for c in ("longest", "tile", "part"))
    replaced, more, less = index.one_apart()
    whole = (index.sizes == longest)[:, None]
    zero = np.uint64(0)
    sets = np.where(whole, replaced | less, zero) | np.where(whole, zero, more)
    a, b = _places(sets)
    head, _ = pd.factorize(np.array([w[:m // 2] for w, m in zip(words, longest)], dtype=object))
    first_half = rows["first_half"].to_numpy()
    own = (tile[a] == tile[b]) & ((part[a] < 0) | (part[a] != part[b])) & ((head[a] == head[b]) == first_half[a])
    a, b = a[own], b[own]
    n = rows["n"].to_numpy()
    by_text = np.empty(len(words), np.int64)
    by_text[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((by_text[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.diff(a, prepend=-1))
    text = rows["word"].to_numpy()
    return pd.DataFrame({"word": text[a[first]], "n_near": np.diff(np.append(first, len(a))), "form": text[b[first]],
                         "form_n": n[b[first]]})


def _with_last(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, bool]]:
    """Each batch, and whether it's the last one."""
    before = next(batches, None)
    while before is not None:
        after = next(batches, None)
        yield before, after is None
        before = after


def _block_end(tiles: np.ndarray, longest: np.ndarray, block: int, letters: int, last: bool) -> int:
    """How many rows make the next block: whole tiles within both limits, or one tile alone; 0 if more rows are needed."""
    if not len(tiles):
        return 0
    ends = np.flatnonzero(np.diff(tiles)) + 1
    if last:
        ends = np.append(ends, len(tiles))
    over = (ends > block) | (longest[ends - 1] * ends > letters)  # rows are sorted by ``longest``
    if not last and not over.any():
        return 0
    fit = ends[~over]
    return int(fit[-1]) if len(fit) else int(ends[0])


def _met(vocabulary: DataFrame, tile: int, tile_letters: int) -> DataFrame:
    """The words in their buckets and tiles: a row for each comparison a word takes part in."""
    size = F.length("word")
    rows = vocabulary.select("word", "n", F.explode(F.array(size, size + 1)).alias("longest"),
                             ).withColumn("half", F.expr("longest div 2").cast("int"))
    halves = F.array(F.struct(F.lit(True).alias("first_half"), F.expr("left(word, half)").alias("text")),
                     F.struct(F.lit(False).alias("first_half"), F.expr("right(word, longest - half)").alias("text")))
    rows = rows.withColumn("side", F.explode(halves)).select(
        "word", "n", "longest", "side.first_half", F.xxhash64("longest", "side.first_half", "side.text").alias("bucket"))
    # how many tiles a bucket needs; words that are alone in theirs meet none
    letters = F.max("longest") * F.count(F.lit(1))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("words"), letters.alias("letters")).where("words > 1")
    parts = F.greatest(F.ceil(F.col("words") / tile), F.ceil(F.col("letters") / tile_letters)).cast("int")
    rows = rows.join(sizes.select("bucket", parts.alias("parts")), "bucket")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    rows = rows.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.select("word", "n", "longest", "first_half",
                       F.when(F.col("own") == F.col("met"), -1).otherwise(F.col("own")).alias("part"),
                       F.xxhash64("bucket", F.least("own", "met"), F.greatest("own", "met")).alias("tile"))


def near_words(vocabulary: DataFrame, tile: int = TILE, tile_letters: int = TILE_LETTERS, block: int = BLOCK) -> DataFrame:
    """Rows (``word``, ``n``, ``n_near``, ``form``, ``form_n``) for each word of ``vocabulary`` (``word``, ``n``; each once).

    ``n_near`` counts the words one inserted, deleted or replaced letter apart, ``form`` is the one of largest ``n``
    (of equal ones the first in code-point order), null if there is none.
    """
    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame(columns=["word", "n", "longest", "first_half", "part", "tile"])
        for batch, last in _with_last(batches):
            held = pd.concat([held, batch], ignore_index=True) if len(held) else batch
            while cut := _block_end(held["tile"].to_numpy(), held["longest"].to_numpy(), block, tile_letters, last):
                yield _best_of_block(held[:cut].reset_index(drop=True))
                held = held[cut:].reset_index(drop=True)

    spread = _met(vocabulary, tile, tile_letters).repartition("tile").sortWithinPartitions("longest", "tile")
    met = spread.mapInPandas(compared, "word string, n_near long, form string, form_n long")
    none = [F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("string").alias("form"),
            F.lit(None).cast("long").alias("form_n")]
    both = vocabulary.select("word", "n", *none).union(met.select("word", F.lit(None).cast("long"), "n_near", "form", "form_n"))
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("less"), "form"))).alias("best")
    return both.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best).select(
        "word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """Rows (``word``, ``root``) for rows (``word``, ``form``): the last word that forms lead to. There are no cycles,
    as a form is more frequent than its word. Every round doubles the steps taken."""
    steps = materialized(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        longer = materialized(steps.join(onward, "root", "left").select("word", "root", "onward"))
        if longer.where("onward is not null").isEmpty():
            return steps
        steps = longer.select("word", F.coalesce("onward", "root").alias("root"))


def spelling_groups(vocabulary: DataFrame, ratio: int = 10, **sizes: int) -> DataFrame:
    """Rows (``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``) for each word of ``vocabulary``.

    ``form`` is the most frequent near word if it's at least ``ratio`` times as frequent, else null; ``root`` the last
    word that forms lead to, the word itself without one. An empty vocabulary gives no rows.
    """
    near = near_words(vocabulary, **sizes)
    is_form: Column = F.col("form_n") >= ratio * F.col("n")
    words = materialized(near.select("word", F.when(is_form, F.col("form")).alias("form"), "n", "n_near",
                                     F.when(is_form, F.col("form_n")).alias("form_n")))
    last = roots(words.where("form is not null"))
    return words.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
