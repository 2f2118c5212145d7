"""Personal data by weak supervision; DataFrame functions only.

Four base patterns find what is well-formed. Looser ones and matches that failed a check give more candidates.
Labelers vote on each candidate for, against or not at all: the pattern itself, gazetteers, the words around it, and
its shape. Expectation-maximisation over the counts of their votes estimates how reliable each labeler is for each
kind, without any labels; the resulting probabilities train a span classifier (naive Bayes on the candidate's
features), which decides what is added to the base spans.

Candidates are counted by votes and features before anything is shuffled. The number of such cells is bounded by the
votes and features, however many candidates there are, so is what the driver sees: one number for each of them.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from skygauge.llm.common import materialized, whole_text

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. They match what the plain ones of the contract match, but give nothing back once it's taken
#: and don't start within a run, so that a long run of such letters takes time in proportion to its length.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Looser forms, all in one pattern: addresses spelled out, addresses made harmless, other separators, no country code.
LOOSE = "|".join((
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?[A-Za-z0-9-]{1,63}+"
    r"(?:(?:\x20?[\[({]\x20?(?i:dot)\x20?[\])}]\x20?|\x20(?i:dot)\x20|\.)[A-Za-z0-9-]{1,63}+){1,4}"
    r"|\x20(?i:at)\x20[A-Za-z0-9-]{1,63}+(?:(?:\x20?[\[({]\x20?(?i:dot)\x20?[\])}]\x20?|\x20(?i:dot)\x20)[A-Za-z0-9-]{1,63}+){1,4})",
    r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\[(?i:dot)\])[0-9]{1,3}){3}(?![0-9])",
    r"(?<![0-9._/])[0-9]{4}(?:[._/][0-9]{4}){3}(?![0-9._/])",
    r"(?<![0-9])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
))
#: Gazetteers and words around a span; fixed values.
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "info", "biz", "eu", "de", "fr", "es", "uk", "it", "nl", "ch", "at", "us")
AROUND = {
    "email": ("mail", "contact", "write", "correo", "courriel", "schreib"),
    "ip": ("ip", "host", "server", "address", "from", "login"),
    "card": ("card", "visa", "credit", "tarjeta", "carte", "karte", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "appel", "llam"),
}
LABELERS = ("v_pattern", "v_gazetteer", "v_context", "v_shape")
FEATURES = ("f_check", "f_left", "f_right", "f_digits", "f_length", "f_form")
SPAN = "struct<first:int,end:int,hit:string,left:string,right:string>"
EMPTY = f"cast(array() as array<{SPAN}>)"


def _hits(name: str) -> Column:
    """Places of the matches ``name``_hits, given the gaps between them in ``name``_gaps, with the text around."""
    g, h = f"{name}_gaps", f"{name}_hits"
    return F.expr(f"""
        if(size({h}) = 0, {EMPTY}, aggregate(sequence(0, size({h}) - 1),
          named_struct('at', 0, 'out', {EMPTY}),
          (a, i) -> named_struct('at', a.at + length({g}[i]) + length({h}[i]), 'out', concat(a.out, array(named_struct(
            'first', a.at + length({g}[i]), 'end', a.at + length({g}[i]) + length({h}[i]), 'hit', {h}[i],
            'left', right({g}[i], 24), 'right', left({g}[i + 1], 2))))),
          a -> a.out))""")


def _matched(rows: DataFrame) -> DataFrame:
    """``rows`` with an array of :data:`SPAN` for each base pattern and the loose one; a scan of the text for each."""
    patterns = {**BASE, "loose": LOOSE}
    needed = {"email": "@", "phone": "+"}
    keep = rows.columns
    found = {}
    for name, pattern in patterns.items():
        hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        if name in needed:
            hits = F.when(F.contains("text", F.lit(needed[name])), hits).otherwise(F.array().cast("array<string>"))
        found[f"{name}_hits"] = hits
    rows = rows.select(*keep, *[c.alias(n) for n, c in found.items()])
    none = F.array().cast("array<string>")
    rows = rows.select(*keep, *found, *[F.when(F.size(f"{n}_hits") > 0, F.split("text", p, -1)).otherwise(none).alias(f"{n}_gaps")
                                        for n, p in patterns.items()])
    return rows.select(*keep, *[_hits(n).alias(n) for n in patterns])


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right; the digits as text."""
    doubled = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda d: d != ""), lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    """Whether a match passes the checks of its kind."""
    if kind == "ip":
        return hit.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        digits = _digits(hit)
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    return F.length(_digits(hit)).between(9, 15) if kind == "phone" else F.lit(True)


def _described(kind: Column, span: Column, form: Column) -> Column:
    """A candidate: its place, the labelers' votes and its features, all of few values."""
    hit, left, right = span["hit"], span["left"], span["right"]
    digits = _digits(hit)
    n_digits = F.length(digits)
    by = lambda **of: F.coalesce(*[F.when(kind == k, c) for k, c in of.items()])
    around = F.coalesce(*[F.when((kind == k) & F.lower(left).rlike("|".join(words)), 1) for k, words in AROUND.items()])
    glued = left.rlike(r"[A-Za-z0-9=#\"'/_.-]$") | right.rlike(r"^[A-Za-z0-9\"'_=]")
    domain = F.regexp_extract(F.lower(hit), r"([a-z0-9-]+)$", 1)
    parts = F.transform(F.filter(F.split(hit, r"[^0-9]+"), lambda p: p != ""), lambda p: F.length(p))
    votes = (
        F.when(form == "base", 1).when(form == "failed", -1).otherwise(0),
        by(email=F.when(domain.isin(*DOMAINS), 1).otherwise(-1),
           ip=F.when(hit.rlike(r"^0*(?:0|127|255)[^0-9]") | (F.array_max(parts) < 2), -1).otherwise(1),
           card=F.when(F.substring(digits, 1, 1).isin("3", "4", "5", "6") & n_digits.between(15, 16), 1).otherwise(-1),
           phone=F.when(n_digits.isin(10, 11, 12), 1).otherwise(0)),
        F.when(glued, -1).when(around == 1, 1).otherwise(0),
        by(email=F.when(hit.rlike(r"^[0-9]+[^0-9A-Za-z]"), -1).otherwise(1),
           ip=F.when(_valid("ip", F.regexp_replace(hit, "[^0-9]+", ".")), 1).otherwise(-1),
           card=F.when(n_digits.between(13, 19) & _luhn(F.substring(digits, 1, 19)), 1).otherwise(-1),
           phone=F.when(n_digits.between(9, 15) & hit.rlike(r"[\x20().-]"), 1).otherwise(-1)))
    kind_of = lambda c: F.when(c == "", "none").when(c.rlike(r"\s"), "space").when(c.rlike(r"[0-9]"), "digit").when(
        c.rlike(r"\p{L}"), "letter").otherwise("mark")
    checked = by(email=domain.isin(*DOMAINS), ip=_valid("ip", F.regexp_replace(hit, "[^0-9]+", ".")),
                 card=n_digits.between(13, 19) & _luhn(F.substring(digits, 1, 19)), phone=n_digits.between(9, 15))
    features = (F.when(checked, "right").otherwise("wrong"), kind_of(F.right(left, F.lit(1))), kind_of(F.left(right, F.lit(1))),
                F.least(n_digits, F.lit(20)).cast("string"), F.least(F.floor(F.length(hit) / 8), F.lit(8)).cast("string"), form)
    return F.struct(kind.alias("kind"), span["first"].alias("first"), span["end"].alias("end"),
                    *[v.cast("int").alias(n) for v, n in zip(votes, LABELERS)],
                    *[f.alias(n) for f, n in zip(features, FEATURES)])


def _passes(kind: str, right: bool = True) -> Callable[[Column], Column]:
    return lambda span: _valid(kind, span["hit"]) == F.lit(right)


def _place(kind: Column) -> Callable[[Column], Column]:
    return lambda span: F.struct(kind.alias("kind"), span["first"].alias("first"), span["end"].alias("end"))


def _candidate(kind: Column, form: str) -> Callable[[Column], Column]:
    return lambda span: _described(kind, span, F.lit(form))


def of_kind(kind: str) -> Callable[[Column], Column]:
    """Whether a span is of this kind, for ``F.filter``."""
    return lambda span: span["kind"] == kind


def _candidates(rows: DataFrame) -> DataFrame:
    """``rows`` with ``base``, an array of valid spans (``kind``, ``first``, ``end``), and ``candidates``, all others too."""
    keep = rows.columns
    found = _matched(rows)
    hit_kind = lambda hit: F.when(hit.rlike("(?i)at"), "email").when(hit.rlike(r"^[0-9]{4}[._/]"), "card").when(
        hit.rlike(r"\[|\(\."), "ip").otherwise("phone")
    found = found.select(*keep, *[F.filter(k, _passes(k)).alias(f"{k}_right") for k in KINDS],
                         *[F.filter(k, _passes(k, False)).alias(f"{k}_wrong") for k in KINDS], "loose")
    base = F.concat(*[F.transform(f"{k}_right", _place(F.lit(k))) for k in KINDS])
    found = found.select("*", base.alias("base"))
    apart = lambda s: ~F.exists("base", lambda b: (b["first"] < s["end"]) & (s["first"] < b["end"]))
    every = F.concat(
        *[F.transform(f"{k}_right", _candidate(F.lit(k), "base")) for k in KINDS],
        *[F.transform(F.filter(f"{k}_wrong", apart), _candidate(F.lit(k), "failed")) for k in KINDS],
        F.transform(F.filter("loose", apart), lambda s: _described(hit_kind(s["hit"]), s, F.lit("loose"))))
    some = F.size("loose") + sum(F.size(f"{k}_right") + F.size(f"{k}_wrong") for k in KINDS) > 0
    return found.select(*keep, "base", F.when(some, every).alias("candidates"))


@dataclass(frozen=True)
class SpanModel:
    """``reliability``: probability of each vote of a labeler, by kind and truth. ``weights``: log odds of each feature's
    value, by kind; ``bias``: those of the kind."""

    reliability: dict[tuple[str, str, int, int], float]
    weights: dict[tuple[str, str, str], float]
    bias: dict[str, float]


def _chosen(table: dict[tuple, float], *columns: Column) -> Column:
    """The table's number for the columns' values, 0 for others."""
    if not table:
        return F.lit(0.0)
    pairs = [F.lit(x) for key, value in sorted(table.items()) for x in ("|".join(map(str, key)), float(value))]
    name = F.concat_ws("|", *[c.cast("string") for c in columns])
    return F.coalesce(F.try_element_at(F.create_map(*pairs), name), F.lit(0.0))


def _truth(reliability: dict, prior: dict[str, float]) -> Column:
    """The probability that a candidate is personal data, from its votes."""
    odds = {(k, name, v): math.log(reliability[k, name, v, 1] / reliability[k, name, v, 0])
            for k in KINDS for name in LABELERS for v in (-1, 0, 1)}
    total = _chosen({(k,): math.log(p / (1 - p)) for k, p in prior.items()}, F.col("kind"))
    for name in LABELERS:
        own = {(k, v): x for (k, label, v), x in odds.items() if label == name}
        total = total + _chosen(own, F.col("kind"), F.col(name))
    return 1 / (1 + F.exp(-total))


def train(docs: DataFrame, rounds: int = 8) -> SpanModel:
    """Reliabilities and a span classifier from the candidates of all texts; without any, from the priors alone.

    The first reliabilities say that a labeler is right more often than not; as pseudo-counts they stay in.
    """
    # an outer explode, as else a filter on the array's size would match all patterns twice
    rows = _candidates(docs.select(whole_text().alias("text"))).select(F.explode_outer("candidates").alias("c"))
    cells = materialized(rows.where("c is not null").groupBy(
        "c.kind", *[f"c.{n}" for n in (*LABELERS, *FEATURES)]).agg(F.count(F.lit(1)).alias("n")).coalesce(1))
    patterns = materialized(cells.groupBy("kind", *LABELERS).agg(F.sum("n").alias("n")).coalesce(1))
    pseudo = {(v, y): (8.0 if v == (1 if y else -1) else 4.0 if v == 0 else 1.0) for v in (-1, 0, 1) for y in (0, 1)}
    reliability = {(k, name, v, y): pseudo[v, y] / 13 for k in KINDS for name in LABELERS for v in (-1, 0, 1) for y in (0, 1)}
    prior = dict.fromkeys(KINDS, 0.5)
    for _ in range(rounds):
        judged = patterns.withColumn("p", _truth(reliability, prior))
        sums = judged.groupBy("kind").agg(*[
            F.sum(F.when(F.col(name) == v, F.col("n") * (F.col("p") if y else 1 - F.col("p"))).otherwise(0.0)).alias(f"{name} {v} {y}")
            for name in LABELERS for v in (-1, 0, 1) for y in (0, 1)]).collect()  # a row a kind
        for row in sums:
            k = row["kind"]
            for name in LABELERS:
                for y in (0, 1):
                    whole = sum(row[f"{name} {v} {y}"] + pseudo[v, y] for v in (-1, 0, 1))
                    for v in (-1, 0, 1):
                        reliability[k, name, v, y] = (row[f"{name} {v} {y}"] + pseudo[v, y]) / whole
            ones, zeros = (sum(row[f"{LABELERS[0]} {v} {y}"] for v in (-1, 0, 1)) for y in (1, 0))
            prior[k] = (ones + 1) / (ones + zeros + 2)
    judged = cells.withColumn("p", _truth(reliability, prior))
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES])).alias("f")
    sums = judged.select("kind", "n", "p", values).groupBy("kind", "f.feature", "f.value").agg(
        F.sum(F.col("n") * F.col("p")).alias("ones"), F.sum(F.col("n") * (1 - F.col("p"))).alias("zeros")).collect()
    totals = {}
    for row in sums:
        one, zero = totals.get((row["kind"], row["feature"]), (0.0, 0.0))
        totals[row["kind"], row["feature"]] = (one + row["ones"], zero + row["zeros"])
    weights = {}
    for row in sums:
        one, zero = totals[row["kind"], row["feature"]]
        weights[row["kind"], row["feature"], row["value"]] = math.log(
            (row["ones"] + 0.5) / (one + 1) / ((row["zeros"] + 0.5) / (zero + 1)))
    return SpanModel(reliability, weights, {k: math.log(p / (1 - p)) for k, p in prior.items()})


def find(docs: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``, arrays of (``kind``, ``first``, ``end``) in code points, end exclusive.

    ``spans`` holds the base spans and those that the classifier adds, which overlap no base span. Both are ordered
    by kind, as in ``KINDS``, then by place. Null texts count as empty and stay null. Repeated rows stay, other
    columns too unless they have these two names; an empty table gives no rows.
    """
    model = model or train(docs)
    plain = docs.drop("base_spans", "spans")
    rows = _candidates(plain.select(F.struct(*[F.col(f"`{c}`") for c in plain.columns]).alias("__row"), whole_text().alias("text")))
    odds = lambda c: sum((_chosen({(k, v): w for (k, f, v), w in model.weights.items() if f == name}, c["kind"], c[name])
                          for name in FEATURES), _chosen({(k,): b for k, b in model.bias.items()}, c["kind"]))
    more = F.transform(F.filter("candidates", lambda c: (c["f_form"] != "base") & (odds(c) > 0)), lambda c: F.struct(
        c["kind"].alias("kind"), c["first"].alias("first"), c["end"].alias("end")))
    every = F.when(F.col("candidates").isNull(), F.col("base")).otherwise(F.concat("base", more))
    rows = rows.select("__row", F.col("base").alias("base_spans"), every.alias("__every"))
    ordered = F.concat(*[F.array_sort(F.filter("__every", of_kind(k))) for k in KINDS])
    return rows.select("__row.*", "base_spans", F.when(F.size("__every") == 0, F.col("__every")).otherwise(ordered).alias("spans"))


def span_text(spans: Column) -> Column:
    """Spans as ``kind:first:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["first"].cast("string"), s["end"].cast("string"))), ",")


def masked(found: DataFrame, text: str = "text") -> Column:
    """The text with a mark like ``<EMAIL>`` in the place of each span; of spans that overlap the first has one."""
    by_place = "array_sort(spans, (a, b) -> if(a.first != b.first, a.first - b.first, b.end - a.end))"
    return F.expr(f"""
        if(size(spans) = 0, `{text}`, aggregate({by_place}, named_struct('at', 0, 'out', cast('' as string)),
          (a, s) -> named_struct('at', greatest(a.at, s.end), 'out', if(s.first < a.at, a.out,
            concat(a.out, substring(`{text}`, a.at + 1, s.first - a.at), '<', upper(s.kind), '>'))),
          a -> concat(a.out, substring(`{text}`, a.at + 1))))""")
