"""Benchmark passages in training texts, by spaced-seed hashing; DataFrame functions only.

A mask looks at some of the tokens of a stretch and ignores the others, so a seed still matches if an ignored token
was replaced. Seeds of the benchmark items are joined to those of all texts; a hit says how text and item may lie
against each other. There the tokens are compared, each time only as many as the item has: an overlap counts if some ``window`` tokens in a row agree in at
least ``share`` of their places. The two masks are chosen so that every such window has an intact seed, whichever
of its tokens were replaced. Items under 13 tokens, and other windows and shares, have masks of their own.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from skygauge.llm.common import beside_marks, by_marks, materialized, maybe_among, whole_row, whole_text

#: Places of a stretch of SPAN tokens that a seed hashes; tests check that no window can be missed.
MASKS = ((0, 1, 2, 3, 6, 7), (0, 1, 3, 5, 6, 7))
SPAN = 8
WINDOW, SHARE = 13, 0.8
#: Tokens that a seed of any other window should hash, and masks it may have for that.
LEAST, MOST_MASKS = 6, 64
#: Tokens in a row of a text that has hits, or as many as the longest item has.
BLOCK = 1024
KEY = ["key_id", "key_hash"]


def tokens(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def needed(wide: int, share: float) -> int:
    """Tokens of ``wide`` that have to agree."""
    return math.ceil(wide * share - 1e-9)


def masks(wide: int, share: float) -> tuple[tuple[int, ...], ...]:
    """Masks, one of which is intact somewhere in ``wide`` tokens, whichever may be replaced.

    From 13 tokens on with up to two replaced ones these are MASKS. Else the tokens are cut into blocks, and a mask
    leaves out as many as tokens may be replaced: as few blocks as give seeds of LEAST tokens, if there are so many.
    """
    misses = wide - needed(wide, share)
    if wide >= WINDOW and misses <= WINDOW - needed(WINDOW, SHARE):
        return MASKS
    found: set[tuple[int, ...]] = set()
    for n in range(misses + 1, wide + 1):
        if found and math.comb(n, misses) > MOST_MASKS:
            break
        blocks = [range(wide * k // n, wide * (k + 1) // n) for k in range(n)]
        kept = [[at for block in some for at in block] for some in combinations(blocks, n - misses)]
        found = {tuple(at - places[0] for at in places) for places in kept}
        if min(map(len, kept)) >= min(LEAST, wide - misses):
            break
    return tuple(sorted(found))


def _seeds(hashes: Column, shapes: list[tuple[int, ...]]) -> Column:
    """All masks' seeds, mask by mask, one for each token; null where the mask reaches beyond the end."""
    def of(mask: tuple[int, ...]) -> Column:
        name = F.lit(",".join(map(str, mask)))
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - 1),
                           lambda at: F.when(at + mask[-1] < F.size(hashes), F.xxhash64(name, *[F.get(hashes, at + k) for k in mask])))

    return F.when(F.size(hashes) > 0, F.concat(*[of(m) for m in shapes])).otherwise(F.array().cast("array<bigint>"))


def _seed_rows(rows: DataFrame, key: list[str], at: str, shapes: list[tuple[int, ...]]) -> DataFrame:
    """Rows (key, ``at``, ``seed``) of texts in the column ``text``."""
    hashed = rows.select(*key, _hashes(tokens(F.col("text"))).alias("hashes"))
    seeds = hashed.select(*key, F.size("hashes").alias("places"), _seeds(F.col("hashes"), shapes).alias("seeds"))
    # an outer explode, as else a filter on the array's size would compute all seeds twice
    spread = seeds.select(*key, "places", F.posexplode_outer("seeds").alias("pos", "seed"))
    return spread.where("seed is not null").select(*key, (F.col("pos") % F.col("places")).alias(at), "seed")


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows that share a key are equal."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.select(F.coalesce("doc_id", F.lit(0)).alias("key_id"), F.xxhash64("doc_id", "text").alias("key_hash"),
                       "doc_id", "text")


#: An array with the span of all good windows of an item's place, or with a null if there is none. What is used more
#: than once is bound as the argument of a function.
_VERDICT = """
    transform(array(transform(item_words, (w, k) -> if(get(part, k + least(lie, 0)) = w, 1, 0))), equal ->
      transform(array(transform(sequence(0, size(equal) - wide), s -> aggregate(slice(equal, s + 1, wide), 0, (a, x) -> a + x))),
        counts -> transform(array(filter(sequence(0, size(counts) - 1), s -> counts[s] >= need)), good ->
          if(size(good) = 0, null, named_struct(
            'doc_start', array_min(good) + lie, 'doc_end', array_max(good) + wide + lie,
            'n_equal', aggregate(slice(equal, array_min(good) + 1, array_max(good) + wide - array_min(good)), 0,
                                 (a, x) -> a + x))))[0])[0])"""


def _stretches(texts: DataFrame, hits: DataFrame, longest: int) -> DataFrame:
    """Rows (key, ``doc_id``, ``item``, ``lie``, ``part``): the tokens of the text from where the item would begin.

    ``part`` begins at the text's first token if the item would begin before it, and has as many tokens as the item at
    most. A text with hits is cut into blocks that overlap by the longest item, so it is read and shuffled twice at
    most, however many hits it has.
    """
    block = max(BLOCK, longest)
    begin = F.greatest(F.col("lie"), F.lit(0))
    hits = hits.withColumn("block", F.floor(begin / block).cast("int"))
    marks = materialized(hits.groupBy(*KEY, "block").agg(F.collect_list(F.struct("item", "size", "lie")).alias("hits")))
    maybe, _ = by_marks(texts, marks, KEY)

    def blocks(words: Column) -> Column:
        last = F.floor(F.greatest(F.size(words) - 1, F.lit(0)) / block).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda n: F.struct(
            n.alias("block"), F.array_join(F.slice(words, n * block + 1, F.lit(block + longest)), " ").alias("words")))

    # tokens are bound as the argument of a function, as else they would be computed again for each block or hit
    cut = F.get(F.transform(F.array(tokens(F.col("text"))), blocks), 0)
    parts = maybe.select(*KEY, "doc_id", F.explode_outer(cut).alias("cut")).select(*KEY, "doc_id", "cut.*")
    found = parts.join(marks.hint("merge"), [*KEY, "block"])

    def places(words: Column) -> Column:
        return F.transform(F.col("hits"), lambda h: F.struct(h["item"].alias("item"), h["lie"].alias("lie"), F.slice(
            words, F.greatest(h["lie"], F.lit(0)) - F.col("block") * block + 1, h["size"]).alias("part")))

    some = F.get(F.transform(F.array(F.split("words", " ")), places), 0)
    return found.select(*KEY, "doc_id", F.explode_outer(some).alias("place")).select(*KEY, "doc_id", "place.*")


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """Verified overlaps: ``doc_id``, ``item_id``, ``doc_start`` and ``doc_end`` (tokens, end exclusive), ``n_equal``.

    One row for each text and item, where they overlap most; the earliest of equally long ones. An item under
    ``window`` tokens must agree in ``share`` of all of them; one without tokens is never found. Null texts count as empty. Equal rows of ``docs`` give one row an item, equal rows of ``benchmark`` count
    once. Null ids stay null. Other columns are ignored; an empty table on either side gives no rows.
    """
    if window < 1 or not 0 < share <= 1:
        raise ValueError("window must be at least 1, share above 0 and at most 1")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text")).distinct()
    wide = F.least(F.lit(window), F.size(tokens(F.col("text"))))
    sizes = sorted(r.wide for r in items.select(wide.alias("wide")).distinct().collect() if r.wide)
    own = [(items.where(wide == n), masks(n, share)) for n in sizes] or [(items.limit(0), MASKS)]
    seeds = reduce(DataFrame.union, [_seed_rows(some, ["item_id", "text"], "item_at", every) for some, every in own])
    longest = items.agg(F.max(F.size(tokens(F.col("text"))))).first()[0] or 1
    seeds = materialized(seeds.select(F.xxhash64("item_id", "text").alias("item"), F.size(tokens(F.col("text"))).alias("size"),
                                      "item_at", "seed").distinct())
    texts = _keyed(docs)
    shapes = sorted({mask for _, every in own for mask in every})
    hits = maybe_among(_seed_rows(texts, KEY, "doc_at", shapes), "seed", seeds).join(seeds, "seed")
    hits = hits.select(*KEY, "item", "size", (F.col("doc_at") - F.col("item_at")).alias("lie")).distinct()
    words = items.select("item_id", F.xxhash64("item_id", "text").alias("item"), tokens(F.col("text")).alias("item_words"))
    wide = F.least(F.lit(window), F.size("item_words"))
    compared = _stretches(texts, hits, longest).join(words, "item").select(
        *KEY, "doc_id", "item_id", "lie", "part", "item_words", wide.alias("wide"), F.ceil(wide * F.lit(share) - 1e-9).alias("need"))
    # an outer explode, as else a filter on the result would be pushed into its parts and compute them many times
    spans = compared.select(*KEY, "doc_id", "item_id", F.explode_outer(F.expr(_VERDICT)).alias("span")).where("span is not null")
    spans = spans.select(*KEY, "doc_id", "item_id", "span.*")
    best = spans.groupBy(*KEY, "item_id").agg(
        F.max_by(F.struct("doc_id", "doc_start", "doc_end", "n_equal"), F.struct("n_equal", -F.col("doc_start"))).alias("b"))
    return best.select("b.doc_id", "item_id", "b.doc_start", "b.doc_end", "b.n_equal", *KEY)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **verify) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item, with all their columns."""
    bad = materialized(overlaps(docs, benchmark, **verify).select(*KEY).distinct())
    keyed = docs.select(whole_row(docs), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("key_id"),
                        F.xxhash64(F.col("doc_id").cast("long"), whole_text()).alias("key_hash"))
    maybe, clean = beside_marks(keyed, bad.withColumn("bad", F.lit(True)), KEY)
    return maybe.where("bad is null").select("row").union(clean.select("row")).select("row.*")
