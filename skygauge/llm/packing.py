"""Vector bin packing of examples into training sequences.

Each example asks for tokens, one segment and loss-bearing tokens; a sequence limits all three. Bins are filled
one after another: of the examples that fit, the one goes in whose demand has the largest dot product with what
the bin has left, each dimension weighted by how scarce it is. If none fits, the best one is cut to fill the bin.
A bin that still isn't full (too many segments, or nothing left in the partition) is dealt out to sequences of
power-of-two lengths, which need no padding.

Tasks pack what they read, in blocks of bounded size, so nothing is shuffled or gathered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from skygauge.llm.common import whole_text
from skygauge.llm.encoding import encoder, vocabulary_path

END_ID = 1
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "segment int, loss_tokens long, sequence_tokens long")


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


@dataclass
class Pool:
    """Pieces still to be placed: document number, first id, ids, and how many of the first bear no loss."""

    doc: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    start: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    size: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    prompt: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def add(self, doc, start, size, prompt) -> Pool:
        return Pool(*(np.concatenate([old, np.asarray(new, np.int64)]) for old, new in
                      zip((self.doc, self.start, self.size, self.prompt), (doc, start, size, prompt))))


def longest_prefix(size, prompt, tokens: int, loss: int):
    """Ids of a piece that fit into ``tokens`` and ``loss``; the first ``prompt`` of them bear none."""
    return np.minimum(np.minimum(size, tokens), prompt + loss)


class Classes:
    """Pieces by what they ask for: all of one size and prompt are one class, as none of them is better than another."""

    def __init__(self, pool: Pool):
        order = np.lexsort((pool.start, pool.doc, pool.prompt, pool.size))
        size, prompt = pool.size[order], pool.prompt[order]
        first = np.flatnonzero((np.diff(size, prepend=-1) != 0) | (np.diff(prompt, prepend=-1) != 0))
        self.size, self.prompt = size[first], prompt[first]
        ends = np.append(first[1:], len(order))
        pieces = list(zip(pool.doc[order].tolist(), pool.start[order].tolist()))
        self.pieces = [pieces[i:j][::-1] for i, j in zip(first.tolist(), ends.tolist())]
        self.place = {(int(s), int(p)): k for k, (s, p) in enumerate(zip(self.size, self.prompt))}

    def take(self, at: int) -> tuple[int, int]:
        """One piece of a class, which goes if that was its last one."""
        piece = self.pieces[at].pop()
        if not self.pieces[at]:
            del self.place[int(self.size[at]), int(self.prompt[at])]
            last = len(self.pieces) - 1
            if at != last:  # the last class takes the place
                self.pieces[at] = self.pieces[last]
                self.size[at], self.prompt[at] = self.size[last], self.prompt[last]
                self.place[int(self.size[at]), int(self.prompt[at])] = at
            self.pieces.pop()
            self.size, self.prompt = self.size[:last], self.prompt[:last]
        return piece

    def put(self, piece: tuple[int, int], size: int, prompt: int) -> None:
        at = self.place.get((size, prompt))
        if at is None:
            self.place[size, prompt] = len(self.pieces)
            self.pieces.append([piece])
            self.size, self.prompt = np.append(self.size, size), np.append(self.prompt, prompt)
        else:
            self.pieces[at].append(piece)


def fill_bins(pool: Pool, limits: Limits) -> tuple[list[list[tuple[int, int, int, int]]], bool]:
    """All pieces in bins, as (document, first id, ids, loss-bearing ids); whether the last bin ran out of pieces.

    Each choice goes over the classes of equal demand, of which there are no more than different sizes, however many
    pieces there are.
    """
    classes = Classes(pool)
    bins, short = [], False
    loss = np.maximum(pool.size - pool.prompt, 0)
    scarce = np.array([pool.size.sum() / limits.tokens, len(pool.size) / limits.segments, loss.sum() / limits.loss])
    scarce = scarce / max(scarce.sum(), 1e-9)
    caps = (limits.tokens, limits.segments, limits.loss)
    weight = [w / c / c for w, c in zip(scarce, caps)]
    while classes.pieces:
        tokens, segments, losses = caps
        placed = []
        while tokens and segments and classes.pieces:
            s, p = classes.size, classes.prompt
            asked = np.maximum(s - p, 0)
            value = weight[0] * tokens * s + weight[1] * segments + weight[2] * losses * asked
            fits = (s <= tokens) & (asked <= losses)
            if segments == 1 and (long := longest_prefix(s, p, tokens, losses) == tokens).any():
                fits = long  # the last segment should fill the bin
            if fits.any():
                at = int(np.argmax(np.where(fits, value, -1.0)))
            else:
                at = int(np.argmax(np.where(longest_prefix(s, p, tokens, losses) > 0, value, -1.0)))
            size, prompt = int(s[at]), int(p[at])
            take = min(size, tokens, prompt + losses)
            if not take:
                break
            doc, start = classes.take(at)
            bears = max(0, take - prompt)
            placed.append((doc, start, take, bears))
            tokens, segments, losses = tokens - take, segments - 1, losses - bears
            if take < size:
                classes.put((doc, start + take), size - take, max(0, prompt - take))
        bins.append(placed)
        short = not classes.pieces and tokens > 0 and segments > 0
    return bins, short


def without_padding(placed: list[tuple[int, int, int, int]], limits: Limits) -> Iterator[list]:
    """A bin as it is if it's full, else dealt out to sequences whose lengths are powers of two."""
    left = sum(piece[2] for piece in placed)
    if left == limits.tokens:
        yield placed
        return
    queue = [list(piece) for piece in reversed(placed)]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        out = []
        while room:
            doc, start, size, bears = queue.pop()
            take = min(size, room)
            free = size - bears  # the ids that bear no loss come first
            out.append((doc, start, take, max(0, take - free)))
            if take < size:
                queue.append([doc, start + take, size - take, min(bears, size - take)])
            room -= take
        yield out


def pack(docs: DataFrame, path: str | None = None, limits: Limits = Limits(), prompt: str | None = None,
         end_id: int = END_ID, block_ids: int = 1 << 21) -> DataFrame:
    """Pieces of every document's ids and where they lie: one row a piece, see ``PIECES``.

    ``docs`` has ``doc_id`` and ``text``; a column named by ``prompt`` comes before the text and bears no loss.
    Null texts and prompts count as empty, so such a document has the end id alone. Repeated rows are documents
    of their own; other columns are ignored; an empty table gives no rows. Very long documents are cut like all.
    ``sequence_id`` holds the number of the partition, so it's unique and the same if a task runs again.
    """
    path = path or vocabulary_path()
    asked = F.coalesce(F.col(prompt), F.lit("")) if prompt else F.lit("")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), asked.alias("prompt"), whole_text().alias("text"))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path)
        base = TaskContext.get().partitionId() << 33
        count = 0
        ids: dict[int, np.ndarray] = {}
        names: dict[int, object] = {}
        totals: dict[int, int] = {}
        pool, held, number = Pool(), 0, 0

        def table(sequences: list[list]) -> pd.DataFrame:
            nonlocal count
            out = []
            for sequence in sequences:
                offset, total = 0, sum(piece[2] for piece in sequence)
                for segment, (doc, start, size, bears) in enumerate(sequence):
                    crc = zlib.crc32(ids[doc][start:start + size].astype("<u4").tobytes())
                    out.append((names[doc], start, size, crc, totals[doc], base + count, offset, segment, bears, total))
                    offset += size
                count += 1
            columns = [part.split()[0] for part in PIECES.split(", ")]
            frame = pd.DataFrame(out, columns=columns)
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            return frame.astype({c: "int64" for c in columns if c not in ("doc_id", "segment")} | {"segment": "int32"})

        def flush(last: bool) -> pd.DataFrame:
            nonlocal pool, held, ids, names, totals
            bins, short = fill_bins(pool, limits)
            kept = bins.pop() if short and not last else []
            frame = table([s for placed in bins for s in without_padding(placed, limits)])
            pool = Pool().add(*zip(*[(d, s, n, n - b) for d, s, n, b in kept])) if kept else Pool()
            docs_kept = {piece[0] for piece in kept}
            ids, names, totals = ({k: v for k, v in x.items() if k in docs_kept} for x in (ids, names, totals))
            held = sum(len(v) for v in ids.values())
            return frame

        for batch in batches:
            new = []
            for doc_id, before, text in zip(batch["doc_id"], batch["prompt"], batch["text"]):
                first = bpe.ids(before) if before else np.zeros(0, np.uint32)
                own = np.concatenate([first, bpe.ids(text), np.array([end_id], np.uint32)])
                ids[number], totals[number] = own, len(own)
                names[number] = None if pd.isna(doc_id) else int(doc_id)
                new.append((number, 0, len(own), len(first)))
                held += len(own)
                number += 1
                if held >= block_ids:
                    pool = pool.add(*zip(*new))
                    new = []
                    yield flush(False)
            if new:
                pool = pool.add(*zip(*new))
        if len(pool.doc):
            yield flush(True)

    return rows.mapInPandas(packed, PIECES)
