"""Verdicts on URLs: rules for hosts and paths, and a logistic regression for all URLs that no rule fits.

The regression sees hashed character n-grams of host and path. It's fitted with numpy on a small table of labelled
URLs, bounded by ``max_rows``, and applied to all URLs batch by batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from skygauge.llm.common import ascii_lower

#: The rules of the registered query, as (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
WIDTHS = (3, 4, 5)


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z in lower case; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def first_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none does. Of two alike the first counts."""
    name, verdict = None, None
    for word, domain, prefix in sorted(rules, key=lambda rule: -len(rule[1] + rule[2])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        name = (F if name is None else name).when(fits, F.lit(domain + prefix))
        verdict = (F if verdict is None else verdict).when(fits, F.lit(word))
    return (name, verdict) if name is not None else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def gram_buckets(host: str, path: str, bits: int) -> np.ndarray:
    """The distinct buckets of all n-grams; host and path have marks at their ends and hash apart."""
    out = []
    for salt, part in ((1, "^" + host + "$"), (2, "^" + path + "$")):
        codes = np.frombuffer(part.encode("utf-8", "replace"), np.uint8).astype(np.uint64)
        value = np.full(len(codes), salt, np.uint64)
        for width in range(1, max(WIDTHS) + 1):
            if width > len(codes):
                break
            value = value[:len(codes) - width + 1] * np.uint64(0x100000001B3) + codes[width - 1:]
            if width in WIDTHS:
                out.append(((value ^ np.uint64(width)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits))
    return np.unique(np.concatenate(out)).astype(np.int64) if out else np.zeros(0, np.int64)


@dataclass(frozen=True)
class UrlModel:
    """Weights of the buckets and the bias; ``score`` is the probability that a URL is to be blocked."""

    weights: np.ndarray
    bias: float
    bits: int

    def score(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        out = np.empty(len(hosts))
        for k, (host, path) in enumerate(zip(hosts, paths)):
            found = gram_buckets(host, path, self.bits)
            out[k] = self.bias + self.weights[found].sum() / np.sqrt(max(1, len(found)))
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(hosts: Sequence[str], paths: Sequence[str], blocked: np.ndarray, bits: int = 16, epochs: int = 6,
        rate: float = 0.3, l2: float = 1e-5, batch: int = 256) -> UrlModel:
    """Logistic regression by AdaGrad. Without rows it allows all; with one label it gives that one."""
    blocked = np.asarray(blocked, dtype=float)
    weights = np.zeros(1 << bits)
    if not len(blocked) or blocked.min() == blocked.max():
        return UrlModel(weights, 5.0 if len(blocked) and blocked[0] else -5.0, bits)
    grams = [gram_buckets(h, p, bits) for h, p in zip(hosts, paths)]
    sums, bias, bias_sum = np.full(1 << bits, 1e-6), 0.0, 1e-6
    order = np.random.default_rng(0)
    for _ in range(epochs):
        shuffled = order.permutation(len(grams))
        for at in range(0, len(shuffled), batch):
            rows = shuffled[at:at + batch]
            sizes = np.array([len(grams[r]) for r in rows])
            flat = np.concatenate([grams[r] for r in rows])
            scale = np.repeat(1 / np.sqrt(np.maximum(sizes, 1)), sizes)
            owner = np.repeat(np.arange(len(rows)), sizes)
            z = bias + np.bincount(owner, weights[flat] * scale, len(rows))
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - blocked[rows]) / len(rows)
            used, place = np.unique(flat, return_inverse=True)
            slope = np.bincount(place, error[owner] * scale, len(used)) + l2 * weights[used]
            sums[used] += slope ** 2
            weights[used] -= rate * slope / np.sqrt(sums[used])
            bias_sum += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(bias_sum)
    return UrlModel(weights, bias, bits)


def train(labelled: DataFrame, max_rows: int = 20_000, max_chars: int = 2_048) -> UrlModel:
    """A model from rows (``host``, ``path``, ``blocked``), of which the ``max_rows`` distinct ones with the smallest
    hash are used, those over ``max_chars`` left out: the bounds of what reaches the driver."""
    rows = labelled.where(F.length("host") + F.length("path") <= max_chars).where(F.col("blocked").isNotNull())
    rows = rows.select("host", "path", F.col("blocked").cast("int").alias("blocked")).distinct()
    rows = rows.orderBy(F.xxhash64("host", "path"), "host", "path", "blocked").limit(max_rows).collect()
    return fit([r.host for r in rows], [r.path for r in rows], np.array([r.blocked for r in rows]))


def judge(pages: DataFrame, model: UrlModel | None = None, rules: Sequence[tuple[str, str, str]] = RULES,
          threshold: float = 0.5) -> DataFrame:
    """Rows (``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``p_block``), one for each row of ``pages``.

    Without a ``model`` one is trained on the URLs that rules decide, the labelled table at hand. A null URL, or
    one without ``://``, has an empty host and path, which no rule fits. Repeated rows stay; other columns are
    ignored; an empty table gives no rows.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, verdict = first_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "ruled": verdict})
    if model is None:
        model = train(rows.where("rule is not null").select("host", "path", (F.col("ruled") == "block").alias("blocked")))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def p_block(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in parts:
            yield pd.Series(shared.value.score(list(hosts), list(paths)))

    scored = rows.withColumn("p_block", p_block("host", "path"))
    learned = F.when(F.col("p_block") >= threshold, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "p_block")
