"""Document likelihood over all segmentations into pieces of an existing subword vocabulary.

A text is its words, lower-cased for A to Z, each after a space, and one end. Every way to cut a word into pieces of
the vocabulary counts: a forward recursion in log space sums them to the word's marginal probability. No piece
crosses a space, so a document's log probability is the sum over its words and its end.

The vocabulary's own scores (its ranks) give the first piece probabilities; rounds of expectation-maximisation over
the counts of all words of the training documents turn them into unigram scores. Words are counted once for the
corpus and scored once each, not once an occurrence. Frequent words reach the tasks by broadcast, which
``FREQUENT_WORDS`` bounds; the rest meet their counts in a join in which no word can be hot, as hot ones are frequent.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from skygauge.llm.common import id_remainder, stored, whole_text
from skygauge.llm.encoding import vocabulary_path

#: At most so many words of at most so many bytes are broadcast: the bound of that table, 32 MB.
FREQUENT_WORDS, FREQUENT_BYTES = 500_000, 64
VOCABULARY = "piece_bpe_32k.model"
SPACE_MARK = "▁"
#: Stands for the end of a text among the words; no word holds white space.
END = b"\n"
SMOOTHING = 0.1
LONG_WORD = 64
FLUSH_WORDS = 200_000
LOG10 = math.log(10)


def words_of(octets: bytes) -> list[bytes]:
    """Of a text in UTF-8 the maximal runs without the white space of ASCII, A to Z lower-cased."""
    return octets.lower().split()  # of bytes, so no other letters and spaces are meant


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes, a space first where the piece begins a word, and first log probabilities by rank.

    Every byte is a piece as well, so any text can be cut.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ranks: dict[bytes, int] = {bytes([b]): model.get_piece_size() for b in range(256)}
    for k in range(model.get_piece_size()):
        if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k)):
            text = model.id_to_piece(k)
            piece = (" " + text[1:] if text.startswith(SPACE_MARK) else text).encode()
            if SPACE_MARK not in text[1:]:
                ranks[piece] = min(k, ranks.get(piece, k))
    pieces = sorted(ranks)
    weight = np.array([1.0 / (ranks[p] + 1) for p in pieces])
    return pieces, np.log(weight / weight.sum())


class Lattice:
    """All segmentations of words into pieces, in log space; words of one length go through together."""

    BASE, MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: Sequence[bytes], log_p: np.ndarray):
        self.index = {p: k for k, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        self.log_p = np.append(log_p, -np.inf)
        self.bits = max(12, (4 * len(pieces)).bit_length())
        size, nothing = 1 << self.bits, len(pieces)
        self.keys, self.ids = np.zeros(size, np.uint64), np.full(size, nothing, np.int32)
        for key, k in zip(map(self._key, pieces), range(nothing)):
            at = key >> (64 - self.bits)  # one of two places; whoever is there moves to the other one
            for _ in range(500):
                held_key, held = int(self.keys[at]), int(self.ids[at])
                self.keys[at], self.ids[at] = key, k
                if held == nothing:
                    break
                first = held_key >> (64 - self.bits)
                key, k, at = held_key, held, (held_key & (size - 1)) if at == first else first
            else:
                raise ValueError("the pieces don't fit into the table")

    def _key(self, piece: bytes) -> int:
        value = len(piece)
        state = 0
        for octet in piece:
            state = (state * int(self.BASE) + octet + 1) % (1 << 64)
        return (state ^ value) * int(self.MIX) % (1 << 64)

    def _lookup(self, state: np.ndarray, length: int) -> np.ndarray:
        key = (state ^ np.uint64(length)) * self.MIX
        first = (key >> np.uint64(64 - self.bits)).view(np.int64)
        second = (key & np.uint64(len(self.keys) - 1)).view(np.int64)
        nothing = np.int32(len(self.index))
        found = np.where(self.keys[first] == key, self.ids[first], nothing)
        return np.where(self.keys[second] == key, np.minimum(found, self.ids[second]), found)

    def _edges(self, octets: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """For each start and end the id of that piece in each word, where any word has one."""
        out, size = {}, octets.shape[1]
        for i in range(size):
            state = np.zeros(len(octets), np.uint64)
            for j in range(i + 1, min(size, i + self.longest) + 1):
                state = state * self.BASE + octets[:, j - 1] + np.uint64(1)
                found = self._lookup(state, j - i)
                if (found != len(self.index)).any():
                    out[i, j] = found
        return out

    def _forward(self, edges: dict, rows: int, size: int) -> np.ndarray:
        alpha = np.full((size + 1, rows), -np.inf)
        alpha[0] = 0
        for (i, j), found in edges.items():  # by start, so alpha[i] is complete when it's used
            alpha[j] = np.logaddexp(alpha[j], alpha[i] + self.log_p[found])
        return alpha

    def _long(self, word: bytes) -> tuple[list[float], list[tuple[int, int, int]]]:
        """Forward values and edges of one long word."""
        alpha, edges = [0.0] + [-math.inf] * len(word), []
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + self.longest) + 1):
                k = self.index.get(word[i:j])
                if k is not None:
                    a, b = alpha[j], alpha[i] + self.log_p[k]
                    high, low = (a, b) if a > b else (b, a)
                    alpha[j] = high + math.log1p(math.exp(low - high)) if low > -math.inf else high
                    edges.append((i, j, k))
        return alpha, edges

    def _batches(self, words: Sequence[bytes], most_octets: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        sizes = np.array([len(w) for w in words])
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            step = max(1, most_octets // max(1, size)) if size <= LONG_WORD else 1
            for at in range(0, len(rows), step):
                some = rows[at:at + step]
                yield some, np.frombuffer(b"".join(words[r] for r in some), np.uint8).reshape(len(some), size).astype(np.uint64)

    def marginals(self, words: Sequence[bytes]) -> np.ndarray:
        """The log of each word's probability, summed over all segmentations."""
        out = np.zeros(len(words))
        for rows, octets in self._batches(words):
            if octets.shape[1] > LONG_WORD:
                out[rows[0]] = self._long(words[rows[0]])[0][-1]
            elif octets.shape[1]:
                out[rows] = self._forward(self._edges(octets), *octets.shape)[-1]
        return out

    def expected(self, words: Sequence[bytes], counts: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, which occur ``counts`` times."""
        total = np.zeros(len(self.index) + 1)
        for rows, octets in self._batches(words):
            weight, size = counts[rows], octets.shape[1]
            if size > LONG_WORD:
                alpha, edges = self._long(words[rows[0]])
                beta = [-math.inf] * size + [0.0]
                for i, j, k in reversed(edges):
                    beta[i] = np.logaddexp(beta[i], beta[j] + self.log_p[k])
                ids = np.array([k for _, _, k in edges])
                gain = np.array([alpha[i] + self.log_p[k] + beta[j] - alpha[-1] for i, j, k in edges])
                total += np.bincount(ids, np.exp(gain) * weight[0], len(total))
            elif size:
                edges = self._edges(octets)
                alpha = self._forward(edges, *octets.shape)
                beta = np.full_like(alpha, -np.inf)
                beta[size] = 0
                ids, gains = [], []
                for (i, j), found in reversed(edges.items()):
                    step = beta[j] + self.log_p[found]
                    beta[i] = np.logaddexp(beta[i], step)
                    ids.append(found)
                    gains.append(np.exp(alpha[i] + step - alpha[size]) * weight)
                total += np.bincount(np.concatenate(ids), np.concatenate(gains), len(total))
        return total[:-1]


def word_counts(docs: DataFrame, trained: str) -> DataFrame:
    """Rows (``word``, ``n_train``) of every word of every document; those of training rows alone are counted.

    Tasks count first and pass on one row for each word they hold; ``END`` stands for the texts' ends.
    """
    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pd.DataFrame:
            words = list(kept[0] | kept[1])
            frame = pd.DataFrame({"word": words, "n_train": np.array([kept[1][w] for w in words], dtype=np.int64),
                                  "n_all": np.array([kept[0][w] + kept[1][w] for w in words], dtype=np.int64)})
            kept[0].clear(), kept[1].clear()
            return frame

        for batch in batches:
            for text, train in zip(batch["text"], batch["train"]):
                counter = kept[bool(train)]
                counter.update(words_of(text))
                counter[END] += 1
                if len(kept[0]) + len(kept[1]) > FLUSH_WORDS:
                    yield flush()
        yield flush()

    rows = docs.select("text", F.col(trained).alias("train"))
    return rows.mapInPandas(per_task, "word binary, n_train long, n_all long").groupBy("word").agg(
        F.sum("n_train").alias("n_train"), F.sum("n_all").alias("n_all"))


def piece_scores(words: DataFrame, pieces: list[bytes], log_p: np.ndarray, rounds: int = 2) -> tuple[np.ndarray, float]:
    """Log probabilities of all pieces and of the end, fitted to the training counts of ``words``.

    What comes back to the driver in a round is one number a piece, so the vocabulary bounds it.
    """
    context = words.sparkSession.sparkContext
    ends = words.where(F.col("word") == F.lit(END)).agg(F.sum("n_train")).first()[0] or 0
    log_end = math.log(0.05)
    for _ in range(rounds):
        shared = context.broadcast((pieces, log_p))

        def expectation(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            lattice, total = Lattice(*shared.value), np.zeros(len(shared.value[0]))
            for batch in batches:
                octets = [b" " + w for w in batch["word"]]
                total += lattice.expected(octets, batch["n_train"].to_numpy(dtype=float))
            some = np.flatnonzero(total)
            yield pd.DataFrame({"piece": some.astype(np.int32), "n": total[some]})

        counted = words.where((F.col("n_train") > 0) & (F.col("word") != F.lit(END))).select("word", "n_train")
        sums = counted.mapInPandas(expectation, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        n = np.full(len(pieces), SMOOTHING)
        for row in sums.collect():
            n[row.piece] += row.n
        total = n.sum() + ends + SMOOTHING
        log_p, log_end = np.log(n / total), math.log((ends + SMOOTHING) / total)
    return log_p, log_end


@dataclass(frozen=True)
class Totals:
    """Of the training tokens: how many there are, and how many distinct ones."""

    tokens: int
    distinct: int

    def base(self, count):
        """log10 of the add-0.1 word probability."""
        return np.log10((count + SMOOTHING) / (self.tokens + SMOOTHING * (self.distinct + 1)))


def score(docs: DataFrame, path: str | None = None, folds: int = 10, rounds: int = 2,
          frequent_words: int = FREQUENT_WORDS) -> DataFrame:
    """One row for each row of ``docs``: see the registered query for the columns; ``score`` is the lattice's.

    The model learns from rows whose :func:`id_remainder` by ``folds`` isn't 0; a null id counts as an empty one.
    A null or empty text has its end alone. Repeated rows stay and count as often as they occur; other columns are
    ignored; an empty table gives no rows; without training rows all word counts are 0 and pieces keep even scores.
    """
    spark = docs.sparkSession
    pieces, log_p = vocabulary(path or vocabulary_path(VOCABULARY))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().cast("binary").alias("text"),
                       (id_remainder("doc_id", folds) != 0).alias("train"))
    counts = stored(word_counts(rows, "train"), "words")
    summed = counts.agg(F.sum("n_train").alias("n"), F.sum("n_all").alias("all"),
                        F.sum((F.col("n_train") > 0).cast("long")).alias("v")).first()
    totals = Totals(summed["n"] or 0, summed["v"] or 0)
    log_p, log_end = piece_scores(counts, pieces, log_p, rounds)
    model = spark.sparkContext.broadcast((pieces, log_p, log_end))

    def word_scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own_pieces, own_log_p, own_end = model.value
        lattice = Lattice(own_pieces, own_log_p)
        for batch in batches:
            found = lattice.marginals([b" " + w for w in batch["word"]])
            found = np.where([w == END for w in batch["word"]], own_end, found) / LOG10
            yield batch.assign(log10_p=found)

    known = stored(counts.mapInPandas(word_scores, "word binary, n_train long, n_all long, log10_p double"), "scores")
    hot = (F.col("n_all") >= (summed["all"] or 0) / frequent_words) & (F.length("word") <= FREQUENT_BYTES)
    frequent = known.where(hot).select("word", "n_train", "log10_p").toPandas()  # at most frequent_words rows
    table = spark.sparkContext.broadcast(dict(zip(frequent["word"], zip(
        (frequent["n_train"] > 0).tolist(), totals.base(frequent["n_train"].to_numpy()).tolist(),
        frequent["log10_p"].tolist()))))

    def per_document(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot_words = table.value
        row = TaskContext.get().partitionId() << 33  # the same if the task runs again
        for batch in batches:
            rows, words, counted_in, own = [], [], [], []
            for doc_id, text, train in zip(batch["doc_id"], batch["text"], batch["train"]):
                found = Counter(words_of(text))
                found[END] = 1
                n_known, base, log10_p, held = 0, 0.0, 0.0, len(words)
                for word, n in found.items():
                    if (hot_word := hot_words.get(word)) is None:
                        words.append(word)
                        counted_in.append(n)
                    else:
                        n_known += n * hot_word[0]
                        base += n * hot_word[1]
                        log10_p += n * hot_word[2]
                words.append(END + row.to_bytes(8))  # no word, so it meets none
                counted_in.append(0)
                rows.append(np.full(len(words) - held, row))
                own += [None] * (len(words) - held - 1)
                own.append({"doc_id": None if pd.isna(doc_id) else int(doc_id), "held_out": not train,
                            "n_tokens": found.total(), "n_known": n_known, "base_score": base, "score": log10_p})
                row += 1
            if rows:
                yield pd.DataFrame({"row": np.concatenate(rows), "word": words, "n": np.array(counted_in, np.int32),
                                    "own": own})

    schema = ("row long, word binary, n int, own struct<doc_id: long, held_out: boolean, n_tokens: long, n_known: long, "
              "base_score: double, score: double>")
    spread = rows.mapInPandas(per_document, schema)
    counted = known.where(~hot).select("word", "n_train", "log10_p")
    bottom = totals.tokens + SMOOTHING * (totals.distinct + 1)
    base = F.log10((F.col("n_train") + SMOOTHING) / F.lit(bottom))
    joined = spread.join(counted, "word", "left").select(
        "row", "own", F.when(F.col("n_train") > 0, F.col("n")).otherwise(0).alias("n_known"),
        F.coalesce(F.col("n") * base, F.lit(0.0)).alias("base"),
        F.coalesce(F.col("n") * F.col("log10_p"), F.lit(0.0)).alias("log10_p"))
    return joined.groupBy("row").agg(
        F.first("own", ignorenulls=True).alias("own"), F.sum("n_known").alias("n_known"),
        F.sum("base").alias("base"), F.sum("log10_p").alias("log10_p")).select(
        "own.doc_id", "own.held_out", "own.n_tokens", (F.col("own.n_known") + F.col("n_known")).alias("n_known"),
        F.lit(totals.tokens).cast("long").alias("train_tokens"),
        (F.col("own.base_score") + F.col("base")).alias("base_score"),
        (F.col("own.score") + F.col("log10_p")).alias("score"))
