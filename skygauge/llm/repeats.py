"""Bytes that lie in a long string which also starts elsewhere, found by prefix-free parsing.

A rolling hash cuts every text into phrases: a phrase begins where the hash of the next ``window`` bytes is a
trigger, so equal strings are cut alike wherever they stand. The distinct phrases are the dictionary, the phrase
numbers of a text its parse. What follows a place in corpus order is only needed to a depth of ``size`` bytes, so
suffixes are ordered into classes of that depth instead of fully sorted; a global suffix array would have to pass
through one machine. The steps, each over all texts, with hashes of 64 bits for content:

1. count phrases; a string that holds a phrase of which there is one starts nowhere else;
2. classes of parse suffixes: where the phrases that cover all strings starting in a phrase occur again, all those
   strings are repeated, and one text of the class stands for the others from here on;
3. classes of text suffixes for the other strings, and for those that stand for many, if the phrases right after
   them occur in an undecided place;
4. the union of the repeated strings is what a text loses.

Classes are counted map-side and joined back, so one that a third of the texts share isn't gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from skygauge.llm.common import beside_marks, materialized, whole_text

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
KEY = ["key_id", "key_hash"]


@dataclass(frozen=True)
class Cut:
    """Bytes of a repeated string, of the rolling hash, between triggers on average, and of what must follow alike."""

    size: int = 400
    window: int = 12
    modulus: int = 48
    context: int = 200


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        out = np.ones(size, np.uint64)
        np.multiply.accumulate(np.full(size - 1, base, np.uint64), out=out[1:])
        return out

    return of(BASE), of(INVERSE)


class Parse:
    """One text's phrases, without its bytes.

    ``bounds`` are the phrases' first bytes and the text's end. The first and the last phrase may be cut by the
    text's ends, so that they tell nothing about strings within other texts.
    """

    def __init__(self, n: int, bounds: np.ndarray, phrases: np.ndarray | None, cut: Cut):
        self.n, self.bounds, self._phrases, self.cut = n, bounds, phrases, cut
        self.powers, self.inverse = _powers(max(1 << 17, 1 << n.bit_length()))

    def phrases(self) -> np.ndarray:
        """A hash of each phrase and the trigger after it; cut ones hash apart from others."""
        return self._phrases

    def last_starts(self) -> np.ndarray:
        """Of each phrase, the last byte at which a string can start; before its first byte if none can."""
        return np.minimum(self.bounds[1:] - 1, self.n - self.cut.size)

    def tops(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each phrase the last start of a string in it that holds no unique phrase, before its first byte if there
        is none; and the first unique phrase from each phrase on."""
        count = len(self.bounds) - 1
        known = np.ones(count, bool)
        known[1:-1] = repeated[1:-1]
        following = np.full(count + 1, count)
        np.minimum.accumulate(np.where(known, count, np.arange(count))[::-1], out=following[:count][::-1])
        unique = following[1:]
        stop = self.bounds[np.minimum(unique + 1, count)] + self.cut.window - self.cut.size - 1
        return np.minimum(self.last_starts(), np.where(unique < count, stop, self.n)), following

    def undecided(self, repeated: np.ndarray) -> dict[str, np.ndarray]:
        """The phrases in which a string without a unique phrase starts. ``suffix`` is the class of the parse suffix
        that covers all strings of the phrase, 0 if that has a unique phrase; ``after`` the class of the phrases that
        end within ``context`` bytes after it, 0 if none does; ``wide`` tells that a string of it may not reach so far."""
        count, size = len(self.bounds) - 1, self.cut.size
        top, following = self.tops(repeated)
        rows = np.flatnonzero(top >= self.bounds[:-1])
        phrases, last = self.phrases(), self.last_starts()
        mixed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(phrases * self.powers[:count], dtype=np.uint64)])

        def run(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return _mix((mixed[b] - mixed[a]) * self.inverse[a] + (b - a).astype(np.uint64))

        cover = np.searchsorted(self.bounds, last[rows] + size, "left")
        whole = (following[rows] >= cover) & (top[rows] == last[rows])
        suffix = np.where(whole, run(rows, cover), np.uint64(0))
        begin = self.bounds[rows + 1]
        ends = np.searchsorted(self.bounds + self.cut.window, begin + self.cut.context, "right") - 1
        ends = np.maximum(np.minimum(ends, count - 1), rows + 1)  # the last phrase is cut
        after = np.where(ends > rows + 1, run(rows + 1, ends), np.uint64(0))
        return {"phrase": rows.astype(np.int32), "suffix": suffix.view(np.int64), "after": after.view(np.int64),
                "wide": begin - self.bounds[rows] > self.cut.context}


class Text(Parse):
    """One text's bytes, its phrases and hashes of any of its strings."""

    def __init__(self, octets: bytes, cut: Cut):
        super().__init__(len(octets), None, None, cut)
        values = np.frombuffer(octets, np.uint8).astype(np.uint64) + np.uint64(1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.powers[:self.n], dtype=np.uint64)])
        starts = np.arange(max(0, self.n - cut.window + 1))
        rolling = self.hashes(starts, starts + cut.window)
        triggers = np.flatnonzero((rolling >> np.uint64(32)) % np.uint64(cut.modulus) == 0)
        self.bounds = np.unique(np.concatenate([[0], triggers, [self.n]]))

    def hashes(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[first]) * self.inverse[first] + (end - first).astype(np.uint64))

    def phrases(self) -> np.ndarray:
        ends = np.minimum(self.n, self.bounds[1:] + self.cut.window)
        out = self.hashes(self.bounds[:-1], ends)
        out[0] = _mix(out[:1] + np.uint64(1))[0]
        out[-1] = _mix(out[-1:] + np.uint64(2))[0]
        return out


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts as bytes with a key. Rows that share a key are equal, and so are their results."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.select(F.coalesce("doc_id", F.lit(0)).alias("key_id"), F.xxhash64("doc_id", "text").alias("key_hash"),
                       "doc_id", F.col("text").cast("binary").alias("octets"))


Arrays = tuple[int, int, dict[str, np.ndarray]]


def _frames(parts: Iterator[Arrays], names: list[str], rows: int = 200_000) -> Iterator[pd.DataFrame]:
    """Frames of many texts' arrays, each of which comes with its text's key."""
    held: list[Arrays] = []
    size = 0

    def frame() -> pd.DataFrame:
        sizes = [len(arrays[names[0]]) for _, _, arrays in held]
        out = {name: np.concatenate([arrays[name] for _, _, arrays in held]) for name in names}
        for k, name in enumerate(KEY):
            out[name] = np.repeat(np.array([part[k] for part in held], np.int64), sizes)
        return pd.DataFrame(out)

    for part in parts:
        held.append(part)
        size += len(part[2][names[0]])
        if size >= rows or len(held) >= 20_000:
            yield frame()
            held, size = [], 0
    if held:
        yield frame()


def _packed(rows: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with arrays of small numbers as bits, an eighth of a byte for each number up to the largest."""
    def bits(numbers) -> bytes:
        if numbers is None or not len(numbers):
            return b""
        flags = np.zeros(int(max(numbers)) + 1, bool)
        flags[np.asarray(numbers, np.int64)] = True
        return np.packbits(flags, bitorder="little").tobytes()

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[KEY].assign(**{c: [bits(x) for x in batch[c]] for c in columns})

    return rows.select(*KEY, *columns).mapInPandas(
        pack, "key_id long, key_hash long, " + ", ".join(f"{c} binary" for c in columns))


def _numbers(bits: bytes | None) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(bits or b"", np.uint8), bitorder="little"))


def _flags(text: Parse, phrases: bytes | None) -> np.ndarray:
    flags = np.zeros(len(text.bounds) - 1, bool)
    flags[_numbers(phrases)] = True
    return flags


def _phrase_rows(texts: DataFrame, cut: Cut) -> DataFrame:
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[Arrays]:
        for batch in batches:
            for a, b, octets in zip(batch["key_id"], batch["key_hash"], batch["octets"]):
                hashes = Text(octets, cut).phrases()[1:-1]
                yield a, b, {"class": hashes.view(np.int64), "phrase": np.arange(1, len(hashes) + 1, dtype=np.int32)}

    return texts.select(*KEY, "octets").mapInPandas(
        lambda batches: _frames(rows(batches), ["class", "phrase"]),
        "class long, phrase int, key_id long, key_hash long")


def _shared(rows: DataFrame) -> DataFrame:
    """The rows whose ``class`` occurs more than once."""
    counts = rows.groupBy("class").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("class")
    return rows.join(counts, "class")


def _parsed(texts: DataFrame, cut: Cut) -> DataFrame:
    """Of each text the sizes and the hashes of its phrases as bytes, about a fifth of the text."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parses = []
            for octets in batch["octets"]:
                text = Text(octets, cut)
                parses.append((np.diff(text.bounds).astype(np.int32).tobytes(), text.phrases().tobytes()))
            yield batch[KEY].assign(sizes=[sizes for sizes, _ in parses], hashes=[hashes for _, hashes in parses])

    return texts.select(*KEY, "octets").mapInPandas(rows, "key_id long, key_hash long, sizes binary, hashes binary")


def _undecided_rows(texts: DataFrame, repeated: DataFrame, cut: Cut) -> DataFrame:
    names = ["phrase", "suffix", "after", "wide"]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[Arrays]:
        for batch in batches:
            for a, b, sizes, hashes, phrases in zip(*(batch[c] for c in (*KEY, "sizes", "hashes", "phrases"))):
                bounds = np.append(0, np.cumsum(np.frombuffer(sizes, np.int32), dtype=np.int64))
                parse = Parse(int(bounds[-1]), bounds, np.frombuffer(hashes, np.uint64), cut)
                yield a, b, parse.undecided(_flags(parse, phrases))

    marked = _parsed(texts, cut).join(repeated.hint("merge"), KEY, "left")
    return marked.select(*KEY, "sizes", "hashes", "phrases").mapInPandas(
        lambda batches: _frames(rows(batches), names),
        "phrase int, suffix long, after long, wide boolean, key_id long, key_hash long")


def _string_rows(texts: DataFrame, cut: Cut) -> DataFrame:
    """A row for each string that starts in the wanted phrases; ``at`` is twice its start, one more if it's settled."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[Arrays]:
        for batch in batches:
            for a, b, octets, repeated, phrases, settled in zip(
                    *(batch[c] for c in (*KEY, "octets", "phrases", "open", "settled"))):
                text = Text(octets, cut)
                top, _ = text.tops(_flags(text, repeated))
                for some, flag in ((phrases, 0), (settled, 1)):
                    some = _numbers(some)
                    firsts = text.bounds[some]
                    sizes = top[some] - firsts + 1
                    starts = np.repeat(firsts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                    yield a, b, {"class": text.hashes(starts, starts + cut.size).view(np.int64), "at": starts * 2 + flag}

    return texts.select(*KEY, "octets", "phrases", "open", "settled").mapInPandas(
        lambda batches: _frames(rows(batches), ["class", "at"]),
        "class long, at long, key_id long, key_hash long")


def _runs(starts: np.ndarray, size: int) -> list[list[int]]:
    """Maximal runs of bytes covered by strings of ``size`` bytes with these starts."""
    if not len(starts):
        return []
    starts = np.sort(starts)
    gaps = np.flatnonzero(np.diff(starts) > size)
    return [list(x) for x in zip(starts[np.append(0, gaps + 1)].tolist(), (starts[np.append(gaps, len(starts) - 1)] + size).tolist())]


def repeated_spans(docs: DataFrame, cut: Cut = Cut()) -> DataFrame:
    """``docs``' rows as (``doc_id``, ``octets``, ``spans``): the text's bytes, and the maximal runs [first, end) to remove.

    A run is covered by strings of ``cut.size`` bytes that start more than once in all texts, the same one included.
    Null texts count as empty, texts under ``cut.size`` bytes have no runs. Equal rows are texts of their own, so
    they repeat each other. Other columns are ignored; an empty table gives no rows.
    """
    texts = _keyed(docs)
    long = texts.where(F.length("octets") >= cut.size)
    repeated = materialized(_packed(_shared(_phrase_rows(long, cut)).groupBy(*KEY).agg(
        F.collect_set("phrase").alias("phrases")), "phrases"))
    places = materialized(_undecided_rows(long, repeated, cut))
    classes = places.where("suffix != 0").groupBy("suffix").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEY, "phrase")).alias("first")).where("n > 1")
    here = F.struct(*KEY, "phrase")
    decided = materialized(places.join(classes, "suffix", "left").select(
        *KEY, "phrase", "after", "wide", F.col("n").isNotNull().alias("settled"),
        F.coalesce(F.col("first") == here, F.lit(True)).alias("stands")))
    asked = decided.where("stands")
    meeting = asked.where("after != 0").groupBy("after").agg(
        F.count(F.lit(1)).alias("n"), F.max(~F.col("settled")).alias("open")).where("n > 1 and open")
    asked = asked.join(meeting.select("after", F.lit(True).alias("meets")), "after", "left").where(
        "after = 0 or wide or meets")
    wanted = materialized(_packed(asked.groupBy(*KEY).agg(
        F.collect_set(F.when(~F.col("settled"), F.col("phrase"))).alias("open"),
        F.collect_set(F.when(F.col("settled"), F.col("phrase"))).alias("settled")), "open", "settled")
        .join(repeated, KEY, "left"))
    maybe, _ = beside_marks(long.select(*KEY, "octets"), wanted.withColumn("wanted", F.lit(True)), KEY)
    strings = _string_rows(maybe.where("wanted"), cut)
    found = _shared(strings).where("at % 2 = 0").groupBy(*KEY).agg(F.collect_set(F.expr("at div 2")).alias("starts"))
    sure = decided.where("settled").groupBy(*KEY).agg(F.collect_set("phrase").alias("sure"))
    marks = materialized(_packed(found.join(sure, KEY, "full"), "starts", "sure"))

    @F.pandas_udf("array<array<long>>")
    def spans(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for octets, starts, phrases in zip(*batch):
                parts = [_numbers(starts)]
                if phrases:
                    text = Text(octets, cut)
                    firsts, lasts = text.bounds[:-1], text.last_starts()
                    parts += [np.arange(firsts[k], lasts[k] + 1) for k in _numbers(phrases)]
                out.append(_runs(np.concatenate(parts), cut.size))
            yield pd.Series(out, dtype=object)

    none = F.array().cast("array<array<long>>")
    maybe, unmarked = beside_marks(texts, marks, KEY)
    some = F.col("starts").isNotNull() | F.col("sure").isNotNull()
    octets = F.when(some, F.col("octets"))  # what isn't marked needn't reach Python
    found = maybe.select("doc_id", "octets", spans(F.coalesce(octets, F.lit(b"")), "starts", "sure").alias("spans"))
    return found.withColumn("spans", F.coalesce("spans", none)).union(unmarked.select("doc_id", "octets", none))


def digest(found: DataFrame) -> DataFrame:
    """Of each row of :func:`repeated_spans` the number of bytes and runs, and the SHA-256 of the bytes that stay."""
    kept = F.expr("""
        aggregate(spans, named_struct('at', 0L, 'kept', cast('' as binary)),
          (a, s) -> named_struct('at', s[1], 'kept', concat(a.kept, substring(octets, cast(a.at + 1 as int), cast(s[0] - a.at as int)))),
          a -> concat(a.kept, substring(octets, cast(a.at + 1 as int))))""")
    return found.select(
        "doc_id", F.length("octets").cast("long").alias("n_bytes"),
        F.expr("aggregate(spans, 0L, (a, s) -> a + s[1] - s[0])").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.when(F.size("spans") == 0, F.col("octets")).otherwise(kept), 256).alias("kept_sha256"))
