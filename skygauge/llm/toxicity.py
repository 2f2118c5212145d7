"""Toxicity by a small convolutional text classifier, trained in numpy and applied to whole texts.

A word is the sum of two learned vectors, one for the hash of the word and one for that of its first letters, so
unseen forms of a stem count too. Filters of several widths run over the words; each keeps its largest value over
the text, and a logistic layer weighs these. As a filter is a sum over its places, each place's product with the
embedding tables is taken once, and a text costs look-ups and additions only.

All labelled rows train it, with their whole texts. Four fifths fit the network: each task learns from a shard of
them, and after a round every parameter is the mean over the shards that changed it. The other fifth is held back from
the fit, to calibrate the score to a probability and to choose each language's threshold by sums over all of these
rows; the language is no input of the score. Only parameters, sums and thresholds reach the driver.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from skygauge.llm.common import by_marks, id_remainder, materialized, stored, whole_text

WORDS = re.compile(r"\w+")
THRESHOLD = 0.7
LEAST_TEXTS = 3
STEPS, BATCH = 1_500, 32
STEM = 4
TABLES = ("word", "stem")
#: About so many texts and words make a shard; more than one shard learn in so many rounds.
SHARD_TEXTS, SHARD_WORDS, ROUNDS = 16_384, 8_000_000, 3
#: A shard is gone through again in a round, for its number of steps, only up to about so many words in all.
ROUND_WORDS = 20_000_000
#: Changed parameters reach the driver in so many pieces, one after the other, of rows of so many lines at most.
PIECES, LINES = 16, 4_096
#: Words of a text that are convolved at once.
PIECE = 1 << 16
#: Sums of multiples of this are exact in any order.
GRAIN = 2.0 ** -36


@dataclass(frozen=True)
class Shape:
    """Sizes of the tables and the layers."""

    word_bits: int = 16
    stem_bits: int = 14
    width: int = 12
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 12


class Hasher:
    """Buckets of a text's words and of their stems; what it has seen is kept up to a bound."""

    def __init__(self, shape: Shape, most: int = 500_000):
        self.shape, self.most, self.seen = shape, most, {}

    def bucket(self, word: str) -> int:
        words = zlib.crc32(word.encode("utf-8", "replace")) >> (32 - self.shape.word_bits)
        stems = zlib.crc32(b"<" + word[:STEM].encode("utf-8", "replace")) >> (32 - self.shape.stem_bits)
        return words << self.shape.stem_bits | stems

    def __call__(self, text: str) -> np.ndarray:
        if len(self.seen) > self.most:
            self.seen.clear()
        seen, out = self.seen, []
        for word in WORDS.findall(text.lower()):
            found = seen.get(word)
            if found is None:
                found = seen[word] = self.bucket(word)
            out.append(found)
        return np.array(out, dtype=np.int64)


@dataclass
class Network:
    """Parameters, and the sums of squared slopes by which AdaGrad scales its steps."""

    shape: Shape
    params: dict[str, np.ndarray] = field(default_factory=dict)
    scale: tuple[float, float] = (1.0, 0.0)

    @classmethod
    def fresh(cls, shape: Shape, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        small = lambda *size: rng.normal(0, 0.1, size).astype(np.float32)
        params = {"word": small(1 << shape.word_bits, shape.width), "stem": small(1 << shape.stem_bits, shape.width),
                  "bias": np.zeros((len(shape.widths), shape.filters), np.float32),
                  "out": small(len(shape.widths) * shape.filters), "out_bias": np.zeros(1, np.float32)}
        for w in shape.widths:
            params[f"conv{w}"] = rng.normal(0, 1 / math.sqrt(w * shape.width), (w, shape.width, shape.filters)).astype(np.float32)
        return cls(shape, params)

    def split(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return ids >> self.shape.stem_bits, ids & ((1 << self.shape.stem_bits) - 1)

    def tables(self) -> dict[tuple[str, int, int], np.ndarray]:
        """For each table, filter width and place the product with the filters."""
        return {(name, w, k): self.params[name] @ self.params[f"conv{w}"][k]
                for name in ("word", "stem") for w in self.shape.widths for k in range(w)}

    def pooled(self, ids: np.ndarray, tables: dict) -> np.ndarray:
        """Largest value of each filter over one text; a text shorter than a filter has zeros around it."""
        out = np.zeros((len(self.shape.widths), self.shape.filters), np.float32)
        distinct, place = np.unique(ids, return_inverse=True)
        words, stems = self.split(distinct)
        for row, w in enumerate(self.shape.widths):
            if w == 1:
                values = tables["word", 1, 0][words] + tables["stem", 1, 0][stems]
            else:
                values = np.zeros((max(len(ids) + w - 1, 0), self.shape.filters), np.float32)
                for k in range(w):
                    step = (tables["word", w, k][words] + tables["stem", w, k][stems])[place]
                    values[w - 1 - k:w - 1 - k + len(ids)] += step
            if len(values):
                out[row] = np.maximum(values.max(axis=0) + self.params["bias"][row], 0)
        return out.ravel()

    def logits(self, texts: list[np.ndarray], tables: dict | None = None) -> np.ndarray:
        tables = tables or self.tables()
        pooled = np.array([self.pooled(ids, tables) for ids in texts], np.float32).reshape(len(texts), -1)
        return pooled @ self.params["out"] + self.params["out_bias"][0]

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(logits.astype(float) * self.scale[0] + self.scale[1], -30, 30)))

    def start(self, counts: dict[str, tuple[np.ndarray, np.ndarray]], share: float) -> None:
        """The parameters before the first step, by the number of texts and of toxic texts that hold each bucket.

        Buckets that fewer than ``LEAST_TEXTS`` texts hold are zero, and stay so, so a text isn't known by words of its
        own; of the others, the first value starts as the bucket's association with the label, in standard deviations.
        """
        p = self.params
        for name, (held, toxic) in counts.items():
            spread = np.sqrt(np.maximum(held, 1) * share * (1 - share))
            p[name] *= 0.3
            p[name][:, 0] = np.clip((toxic - held * share) / spread / 8, -1, 2)
            p[name][held < LEAST_TEXTS] = 0
        for w in self.shape.widths:
            p[f"conv{w}"][:, 0, ::2] = np.abs(p[f"conv{w}"][:, 0, ::2])

    def lines(self, arrays: dict[str, np.ndarray]) -> np.ndarray:
        """Arrays of the parameters' shapes as lines of one width; the tables come first, a line a bucket."""
        values = np.concatenate([arrays[name].ravel() for name in sorted(self.params, key=lambda n: (n not in TABLES, n))])
        return np.pad(values, (0, -len(values) % self.shape.width)).reshape(-1, self.shape.width)

    def from_lines(self, lines: np.ndarray) -> dict[str, np.ndarray]:
        flat, at, out = lines.ravel(), 0, {}
        for name in sorted(self.params, key=lambda n: (n not in TABLES, n)):
            like = self.params[name]
            out[name] = flat[at:at + like.size].reshape(like.shape).astype(np.float32)
            at += like.size
        return out

    def peaks(self, ids: np.ndarray, filters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest value of each filter over one text, and its place: that of the filter's first word, which may lie
        before the text. ``filters`` are the filters' places side by side."""
        widths, n, pad = self.shape.widths, self.shape.filters, max(self.shape.widths) - 1
        best = np.full((len(widths), n), -np.inf if len(ids) else 0, np.float32)
        where = np.zeros(best.shape, np.int64)
        for first in range(-pad, len(ids) if len(ids) else -pad, PIECE):
            end = min(first + PIECE, len(ids))
            words, stems = self.split(ids[max(first, 0):end + pad])
            x = np.zeros((end + pad - first, self.shape.width), np.float32)
            x[max(-first, 0):max(-first, 0) + len(words)] = self.params["word"][words] + self.params["stem"][stems]
            parts, at = x @ filters, 0
            for row, w in enumerate(widths):
                skip = max(0, 1 - w - first)
                values = parts[skip:end - first, at:at + n]
                for k in range(1, w):
                    values = values + parts[skip + k:end - first + k, at + k * n:at + k * n + n]
                at += w * n
                if len(values):
                    place = values.argmax(axis=0)
                    top = values[place, np.arange(n)]
                    better = top > best[row]
                    best[row][better], where[row][better] = top[better], place[better] + first + skip
        return best, where

    def learn(self, flat: np.ndarray, bounds: np.ndarray, labels: np.ndarray, sums: dict[str, np.ndarray], passes: int,
              seed: tuple[int, ...], rate: float = 0.1) -> None:
        """AdaGrad on the logistic loss of some texts, one after the other in ``flat``; slopes flow through the places
        that were largest. ``sums`` of squared slopes are carried on."""
        rng, shape, p = np.random.default_rng(seed), self.shape, self.params
        learned = {name: np.abs(p[name]).any(axis=1) for name in TABLES}

        def step(name: str, slope: np.ndarray, rows=slice(None)) -> None:
            sums[name][rows] += slope ** 2
            p[name][rows] -= rate * slope / np.sqrt(sums[name][rows])

        for _ in range(passes):
            shuffled = rng.permutation(len(labels))
            for at in range(0, len(shuffled), BATCH):
                chosen = shuffled[at:at + BATCH]
                filters = np.concatenate([p[f"conv{w}"][k] for w in shape.widths for k in range(w)], axis=1)
                both = [self.peaks(flat[bounds[c]:bounds[c + 1]], filters) for c in chosen]
                where = np.array([place for _, place in both])
                some = (bounds[chosen + 1] > bounds[chosen])[:, None, None]
                pooled = np.maximum(np.array([top for top, _ in both]) + p["bias"], 0) * some
                together = pooled.reshape(len(chosen), -1)
                z = together @ p["out"] + p["out_bias"][0]
                error = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[chosen]) / len(chosen)).astype(np.float32)
                down = (error[:, None] * p["out"][None, :]).reshape(pooled.shape) * (pooled > 0)
                touched, slopes = [], []
                for row, w in enumerate(shape.widths):
                    c, f = np.nonzero(down[:, row])
                    gain, place = down[c, row, f], where[c, row, f] + bounds[chosen[c]]
                    gains = gain * (f == np.arange(shape.filters)[:, None])
                    slope = np.zeros_like(p[f"conv{w}"])
                    for k in range(w):
                        inside = (place + k >= bounds[chosen[c]]) & (place + k < bounds[chosen[c] + 1])
                        ids = flat[(place + k)[inside]]
                        words, stems = self.split(ids)
                        slope[k] = (gains[:, inside] @ (p["word"][words] + p["stem"][stems])).T
                        touched.append(ids)
                        slopes.append(gain[inside, None] * p[f"conv{w}"][k].T[f[inside]])
                    step(f"conv{w}", slope)
                    step("bias", np.bincount(f, gain, shape.filters).astype(np.float32), row)
                step("out", together.T @ error)
                step("out_bias", error.sum(keepdims=True))
                slopes = np.concatenate(slopes)
                for name, ids in zip(TABLES, self.split(np.concatenate(touched))):
                    rows, back = np.unique(ids, return_inverse=True)
                    slope = np.zeros((len(rows), shape.width), np.float32)
                    np.add.at(slope, back, slopes)
                    step(name, slope * learned[name][rows, None], rows)


def calibration(judged: DataFrame) -> tuple[float, float]:
    """Slope and shift of Platt's scaling of ``logit`` to ``toxic``, with his smoothed targets: Newton's method, each
    step by sums over all rows."""
    ones, rows = judged.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    high, low = (ones + 1) / (ones + 2), 1 / (rows - ones + 2)
    a, b = 1.0, 0.0
    for _ in range(50):
        each = judged.select(F.col("logit").alias("x"), _squashed(a, b).alias("p"), F.when(
            F.col("toxic") > 0, high).otherwise(low).alias("target"))
        each = each.select("x", (F.col("p") - F.col("target")).alias("e"), F.greatest(
            F.col("p") * (1 - F.col("p")), F.lit(1e-6)).alias("c"))
        ex, e, cxx, cx, c = each.agg(*map(F.expr, ("sum(e * x)", "sum(e)", "sum(c * x * x)", "sum(c * x)", "sum(c)"))).first()
        change = np.linalg.solve(np.array([[cxx, cx], [cx, c]]) + 1e-3 * np.eye(2), np.array([ex, e]))
        before = a, b
        a, b = max(1e-3, a - float(np.clip(change[0], -1, 1))), b - float(np.clip(change[1], -1, 1))
        if max(abs(a - before[0]), abs(b - before[1])) < 1e-6:
            break
    return a, b


def _squashed(a: float, b: float) -> Column:
    """What :meth:`Network.probability` makes of the column ``logit``."""
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("logit") * a + b))))


def running_sums(scores: DataFrame, parts: int) -> DataFrame:
    """Of each ``lang`` the distinct ``score`` with the F1 score of ``toxic`` from it on, and the next score ``below``.

    Running sums go over the scores of a ``part`` of a language's range, on top of the sums of the parts above, so no
    task gets a whole language. What is broadcast has a row for each language, or for each of its parts.
    """
    distinct = materialized(scores.groupBy("lang", "score").agg(F.sum("toxic").alias("hits"), F.count(F.lit(1)).alias("n")))
    totals = distinct.groupBy("lang").agg(F.sum("hits").alias("ones"), F.sum("n").alias("every"), F.percentile_approx(
        "score", [k / parts for k in range(1, parts)]).alias("edges"))
    above = F.size(F.filter("edges", lambda edge: edge > F.col("score")))
    rows = distinct.join(F.broadcast(totals), "lang").withColumn("part", above).drop("edges")
    down = Window.partitionBy("lang").orderBy("part")
    before = down.rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("lang", "part").agg(F.sum("hits").alias("h"), F.sum("n").alias("m"), F.max("score").alias("top")).select(
        "lang", "part", F.coalesce(F.sum("h").over(before), F.lit(0)).alias("h"),
        F.coalesce(F.sum("m").over(before), F.lit(0)).alias("m"), F.lead("top").over(down).alias("next_top"))
    within = Window.partitionBy("lang", "part").orderBy(F.desc("score"))
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    f1 = 2 * (F.col("h") + F.sum("hits").over(running)) / (F.col("m") + F.sum("n").over(running) + F.col("ones"))
    below = F.coalesce(F.lead("score").over(within), "next_top", F.lit(0.0))
    return rows.join(F.broadcast(sums), ["lang", "part"]).select(
        "lang", "part", "ones", "every", "score", f1.alias("f1"), below.alias("below"))


def best_threshold(scores: DataFrame, least: int = 10, parts: int = 64) -> dict[str, float]:
    """Of each ``lang`` the ``score`` from which on the F1 score of ``toxic`` is largest, the middle of the gap below it;
    ``THRESHOLD`` with under ``least`` rows of a label. All rows count."""
    best = running_sums(scores, parts).groupBy("lang").agg(
        F.first("ones").alias("ones"), F.first("every").alias("every"),
        F.max_by((F.col("score") + F.col("below")) / 2, F.struct("f1", "score")).alias("middle"))
    return {r["lang"]: THRESHOLD if min(r["ones"], r["every"] - r["ones"]) < least else r["middle"] for r in best.collect()}


@dataclass
class Classifier:
    """The network, and each language's threshold; other languages have ``THRESHOLD``."""

    network: Network
    thresholds: dict[str, float]


def training_rows(docs: DataFrame, labels: DataFrame, shape: Shape = Shape()) -> DataFrame:
    """One row (``doc_id``, ``lang``, ``toxic``, ``ids``) of every labelled document: its whole text's buckets as bytes.

    Labels other than 0 and 1 and null ids are left out; of several labels of a document the largest counts, of
    several texts of an id the one with the smallest hash. Texts aren't shuffled, only the buckets of those whose id a
    bitmap of the labelled ids doesn't rule out.
    """
    labelled = materialized(labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"), F.xxhash64(F.col("doc_id").cast("long")).alias("id_hash")))
    texts = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", whole_text().alias("text"))
    texts, _ = by_marks(texts.withColumn("id_hash", F.xxhash64("doc_id")), labelled, ["doc_id", "id_hash"])

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher(shape)
        for batch in batches:
            yield batch.assign(ids=[hasher(text).astype(np.int32).tobytes() for text in batch["text"]])[
                ["doc_id", "lang", "ids"]]

    found = texts.select("doc_id", "lang", "text").mapInPandas(hashed, "doc_id long, lang string, ids binary").groupBy(
        "doc_id").agg(F.min(F.struct(F.xxhash64("ids").alias("hash"), "lang", "ids")).alias("one"))
    marks = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    return found.join(marks, "doc_id").select("doc_id", "one.lang", "toxic", "one.ids")


def sample(docs: DataFrame, labels: DataFrame, hasher_shape: Shape, max_toxic: int, max_clean: int,
           max_words: int) -> tuple[list, float]:
    """A bounded look at :func:`training_rows` as rows (language, label, buckets), and the share of label 1 among all of
    them. No model is fitted on it."""
    rows = stored(training_rows(docs, labels, hasher_shape), "toxicity_look")
    share = rows.agg(F.avg("toxic")).first()[0] or 0.0
    short, order = rows.where(F.length("ids") <= 4 * max_words), [F.xxhash64("doc_id"), F.col("doc_id")]
    some = short.where("toxic = 1").orderBy(*order).limit(max_toxic).union(
        short.where("toxic = 0").orderBy(*order).limit(max_clean)).collect()
    return [(r.lang, r.toxic, np.frombuffer(r.ids, np.int32).astype(np.int64)) for r in some], share


def bucket_counts(rows: DataFrame, shape: Shape) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Of both tables the number of texts, and of toxic texts, that hold each bucket."""
    network, sizes = Network(shape), (1 << shape.word_bits, 1 << shape.stem_bits)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = [np.zeros((2, size), np.int64) for size in sizes]
        for batch in batches:
            for toxic, ids in zip(batch["toxic"], batch["ids"]):
                for count, buckets in zip(counts, network.split(np.frombuffer(ids, np.int32))):
                    distinct = np.unique(buckets)
                    count[0, distinct] += 1
                    count[1, distinct] += toxic
        for name, (held, toxic) in zip(TABLES, counts):
            some = np.flatnonzero(held)
            yield pd.DataFrame({"name": name, "bucket": some, "held": held[some], "toxic": toxic[some]})

    found = rows.select("toxic", "ids").mapInPandas(counted, "name string, bucket long, held long, toxic long").groupBy(
        "name", "bucket").agg(F.sum("held").alias("held"), F.sum("toxic").alias("toxic")).toArrow().to_pandas()
    out = {}
    for name, size in zip(TABLES, sizes):
        some = found[found["name"] == name]
        out[name] = tuple(np.bincount(some["bucket"], some[c], size) for c in ("held", "toxic"))
    return out


def fit(network: Network, rows: DataFrame, texts: int, toxic: int, words: int, steps: int) -> None:
    """Fits the network to all ``rows``, of which there are so many texts, toxic texts and words.

    Every round each shard starts from the same parameters and goes through all of its rows, as often as ``steps`` in all
    rounds ask for, but once at least. A parameter becomes the mean over the shards that changed it.
    """
    shape = network.shape
    shards = max(1, math.ceil(texts / SHARD_TEXTS), math.ceil(words / SHARD_WORDS))
    rounds = 1 if shards == 1 else ROUNDS
    passes = max(1, round(shards * min(steps * BATCH / (rounds * texts), ROUND_WORDS / max(1, words))))
    dealt = materialized(rows.select("doc_id", "toxic", "ids").repartition(shards, "doc_id").sortWithinPartitions(
        F.xxhash64("doc_id"), "doc_id"))
    network.start(bucket_counts(dealt, shape), toxic / texts)
    sums = {name: np.full(x.shape, 1e-4, np.float32) for name, x in network.params.items()}
    columns = [f"{kind}{k}" for kind in "ps" for k in range(shape.width)]
    for turn in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast((network.params, sums))

        def learned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            parts = [(batch["toxic"].to_numpy(), np.array([len(x) // 4 for x in batch["ids"]], np.int64),
                      np.frombuffer(b"".join(batch["ids"]), np.int32)) for batch in batches]
            if not sum(len(part[0]) for part in parts):
                return
            labels, sizes, flat = (np.concatenate(x) for x in zip(*parts))
            del parts
            params, before = shared.value
            mine = Network(shape, {name: x.copy() for name, x in params.items()})
            squares = {name: x.copy() for name, x in before.items()}
            mine.learn(flat, np.append(0, np.cumsum(sizes)), labels.astype(float), squares, passes,
                       (7, turn, TaskContext.get().partitionId()))
            changes = np.concatenate([mine.lines(mine.params).astype(float) - mine.lines(params),
                                      mine.lines(squares).astype(float) - mine.lines(before)], axis=1)
            some = np.flatnonzero(changes.any(axis=1))
            yield pd.DataFrame(np.round(changes[some] / GRAIN) * GRAIN, columns=columns).assign(line=some)

        def changed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            params, before = shared.value
            mine = Network(shape, params)
            lines = np.concatenate([mine.lines(params), mine.lines(before)], axis=1)
            for batch in batches:
                for at in range(0, len(batch), LINES):
                    some = batch[at:at + LINES]
                    values = (lines[some["line"]] + some[columns].to_numpy()).astype(np.float32)
                    yield pd.DataFrame({"line": [some["line"].to_numpy(np.int32).tobytes()], "values": [values.tobytes()]})

        schema = ", ".join(f"{c} double" for c in columns) + ", line long"
        means = dealt.select("toxic", "ids").mapInPandas(learned, schema).groupBy("line").agg(
            *[F.avg(c).alias(c) for c in columns])
        lines = np.concatenate([network.lines(network.params), network.lines(sums)], axis=1)
        for piece in means.mapInPandas(changed, "line binary, values binary").repartition(PIECES).toLocalIterator():
            lines[np.frombuffer(piece["line"], np.int32)] = np.frombuffer(piece["values"], np.float32).reshape(-1, len(columns))
        network.params = network.from_lines(lines[:, :shape.width])
        sums = network.from_lines(lines[:, shape.width:])
        shared.destroy()


def judge(rows: DataFrame, network: Network) -> DataFrame:
    """``lang`` (null: empty), ``toxic`` and the network's ``logit`` of the rows."""
    shared = rows.sparkSession.sparkContext.broadcast(network)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = shared.value.tables()
        for batch in batches:
            texts = [np.frombuffer(ids, np.int32).astype(np.int64) for ids in batch["ids"]]
            yield batch[["lang", "toxic"]].assign(logit=shared.value.logits(texts, tables).astype(float))

    return rows.select(F.coalesce("lang", F.lit("")).alias("lang"), "toxic", "ids").mapInPandas(
        judged, "lang string, toxic int, logit double")


def train(docs: DataFrame, labels: DataFrame, shape: Shape = Shape(), steps: int = STEPS) -> Classifier:
    """A classifier of the labelled documents, from all of :func:`training_rows`: four fifths fit it, chosen by the hash
    of their id, the rest calibrates it and gives the thresholds.

    With one label only, or none, every score is the share of label 1, smoothed. If one of the parts has one label
    only, all rows do both.
    """
    rows = stored(training_rows(docs, labels, shape).withColumn("held", F.expr("pmod(xxhash64(doc_id), 5) = 0")), "toxicity_rows")
    found = rows.groupBy("held", "toxic").agg(F.count(F.lit(1)).alias("n"), F.sum(F.expr("length(ids) div 4")).alias("words")).collect()
    count = {(r["held"], r["toxic"]): r["n"] for r in found}
    every, ones = sum(count.values()), sum(n for (_, toxic), n in count.items() if toxic)
    network = Network.fresh(shape)
    if ones in (0, every):
        network.params["out"][:] = 0
        share = (ones + 0.5) / (every + 1)
        network.scale = (0.0, math.log(share / (1 - share)))
        return Classifier(network, {})
    apart = len(count) == 4
    fitted = rows.where("not held") if apart else rows
    texts, toxic, words = every, ones, sum(r["words"] for r in found)
    if apart:
        texts, toxic = count[False, 0] + count[False, 1], count[False, 1]
        words = sum(r["words"] for r in found if not r["held"])
    fit(network, fitted, texts, toxic, words, steps)
    judged = materialized(judge(rows.where("held") if apart else rows, network))
    network.scale = calibration(judged)
    return Classifier(network, best_threshold(judged.withColumn("score", _squashed(*network.scale))))


def classify(docs: DataFrame, model: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` (1 from ``threshold`` on), ``lang_threshold`` and ``rejected``.

    A document is rejected if its score reaches its language's threshold. The whole text counts; a null or empty
    one has the score of no words. Repeated rows stay; columns of these four names are replaced, all others kept; an
    empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        network = shared.value.network
        hasher, tables = Hasher(network.shape), network.tables()
        for texts in batches:
            out = np.concatenate([network.logits([hasher(text)], tables) for text in texts]) if len(texts) else np.zeros(0)
            yield pd.Series(network.probability(out))

    limits = F.lit(threshold)
    for lang, limit in model.thresholds.items():
        limits = F.when(F.coalesce("lang", F.lit("")) == lang, F.lit(limit)).otherwise(limits)
    names = ("score", "predicted", "lang_threshold", "rejected")
    scored = docs.select(*[c for c in docs.columns if c not in names], score(whole_text()).alias("score"))
    return scored.withColumns({"predicted": (F.col("score") >= threshold).cast("int"), "lang_threshold": limits}) \
        .withColumn("rejected", F.col("score") >= F.col("lang_threshold"))


def learning_rows(labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """The labels of rows whose :func:`id_remainder` isn't ``held``."""
    return labels.where(id_remainder("doc_id", folds) != held)
