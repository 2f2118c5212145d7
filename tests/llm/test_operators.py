"""Each operator against a plain version, and the cases every operator has to bear."""

import itertools
import math
import time
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skygauge.llm import (common, components, decontam, hnsw, lm_scoring, packing, pii, repeats, simhash, token_counts, toxicity,
                          url_filter)
from skygauge.llm.encoding import encoder, vocabulary_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, rank int, key long, score string, n int"
SENTENCE = "the quick brown fox jumps over the lazy dog while twelve grey geese watch from a far green hill"
MAIL = "Call +1 (319) 555-5132 or write a.b@mail.example.com from 10.0.200.1, card 4111 1111 1111 1111."


def doc(doc_id, text, lang="en"):
    return doc_id, text, lang, "s", len(text or ""), 1, 2, "3", 4


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdeéß"), rng.integers(2, 8))) for _ in range(150)]
    long = " ".join(rng.choice(words, 9_000))
    own = [" ".join(rng.choice(words, rng.integers(1, 120))) for _ in range(25)]
    return [None, "", " \t\n", "word", SENTENCE, SENTENCE.upper(), SENTENCE, MAIL, long, long[:-9] + "#",
            own[0] * 3, own[1] + SENTENCE + own[2], *own, own[3], "x" * 1_200, "<|endoftext|> é ▁ \x85 a\u2003b", "7 " * 900]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [doc(k, t) for k, t in enumerate(texts)] + [doc(4, SENTENCE), doc(None, SENTENCE), doc(None, None), doc(70, MAIL, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3).checkpoint()


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def order(rows):
    return sorted(rows, key=str)


def test_lattice_sums_all_segmentations():
    pieces = sorted([b" ", b" a", b"a", b"b", b"ab", b"aba", b"ba", b" ab", b"bab"])
    log_p = np.log(np.arange(1, len(pieces) + 1) / 60)
    lattice, table = lm_scoring.Lattice(pieces, log_p), dict(zip(pieces, log_p))
    words = [b" " + bytes(w) for n in range(1, 7) for w in itertools.product(b"ab", repeat=n)]
    wanted = [brute.segmentations(w, table) for w in words]
    assert np.allclose(lattice.marginals(words), wanted)
    assert np.allclose([lattice._long(w)[0][-1] for w in words], wanted)
    # the derivative of the log likelihood by a piece's log probability is its expected count
    counts, step = np.arange(1.0, len(words) + 1), 1e-6
    expected = lattice.expected(words, counts)
    for k in range(len(pieces)):
        moved = log_p.copy()
        moved[k] += step
        change = (lm_scoring.Lattice(pieces, moved).marginals(words) - wanted) @ counts / step
        assert abs(change - expected[k]) < 1e-2 * max(1, expected[k])


@pytest.mark.parametrize("frequent", [500_000, 20])
def test_scores(docs, none, pairs, frequent):
    rows = lm_scoring.score(docs, frequent_words=frequent).collect()
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert order(got) == order([(*r[:5], round(r[5], 6)) for r in brute.base_scores(pairs)])
    assert all(-math.inf < r.score < 0 for r in rows)
    same = defaultdict(set)
    for r, text in ((r, t) for r in rows for i, t in pairs if i == r.doc_id and i is not None):
        same[text].add(round(r.score, 6))
    assert all(len(s) == 1 for s in same.values())
    assert lm_scoring.score(none).collect() == []


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 64), packing.Limits(64, 8, 20)])
def test_packing(docs, none, pairs, limits):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary_path())
    prompt = None if limits.loss == limits.tokens else "lang"
    rows = packing.pack(docs, limits=limits, block_ids=3_000, prompt=prompt).collect()
    ids_of = Counter()
    for (doc_id, text), lang in zip(pairs, [r.lang for r in docs.select("lang").collect()]):
        before = whole.encode(lang or "", add_special_tokens=False).ids if prompt else []
        ids = np.array(before + whole.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        ids_of[doc_id, len(ids)] += 1
        own = [r for r in rows if r.doc_id == doc_id and r.doc_tokens == len(ids)]
        for r in own:
            if doc_id not in (None, 4):
                assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
                assert r.loss_tokens == max(0, r.start + r.length - max(r.start, len(before)))
    for (doc_id, n), copies in ids_of.items():
        covered = Counter(k for r in rows if (r.doc_id, r.doc_tokens) == (doc_id, n) for k in range(r.start, r.start + r.length))
        assert covered == Counter(dict.fromkeys(range(n), copies))
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == pieces[0].sequence_tokens <= limits.tokens and at & (at - 1) == 0
        assert len(pieces) <= limits.segments and sum(r.loss_tokens for r in pieces) <= limits.loss
    assert packing.pack(none).collect() == []


def test_both_encoders_agree(texts):
    from tokenizers import Tokenizer

    whole, bpe = Tokenizer.from_file(vocabulary_path()), encoder(vocabulary_path())
    more = ["don't  we'll\t\n\n x", "日本語 ٣٤ ½ ²", " " * 3_000 + "a", "a" * 3_000, "\u00a0\u200b e\u0301", "😀👍🏽 !?"]
    for text in [*texts, *more]:
        assert bpe.ids(text or "").tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_url_verdicts(spark):
    urls = ["http://a.example.com/en/1", "https://WWW.Example.com/en/x?y", "http://x.net/es/1#t", "http://x.net/fr/", "http://x.net/de/1",
            "http://example.com", "http://notexample.com/en/", "ftp://h.org?q=/es/", None, "", "no scheme", "x://y.net/es/://z.com/",
            "http://x.net/es/1#t", "http://k.com/" + "z" * 30_000]
    pages = spark.createDataFrame([(k, u, "h", "r") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    rows = sorted(url_filter.judge(pages).collect())
    assert [(r.host, r.rule, r.verdict) for r in rows[:4]] == [
        ("a.example.com", "example.com/en/", "block"), ("www.example.com", "www.example.com/en/", "allow"),
        ("x.net", "net/es/", "block"), ("x.net", "net/fr/", "block")]
    assert [r.rule for r in rows[4:]] == [None, None, "com/", None, None, None, None, "net/es/", "net/es/", "com/"]
    assert (rows[1].path, rows[7].host, rows[7].path, rows[8].host, rows[10].path) == ("/en/x", "h.org", "", "", "")
    assert {r.verdict for r in rows} == {"allow", "block"}
    assert url_filter.judge(pages.limit(0)).collect() == []
    assert {r.verdict for r in url_filter.judge(pages.where("page_id in (4, 8)")).collect()} == {"allow"}


def test_url_model_learns():
    hosts = [f"{w}{k}.example.org" for k in range(200) for w in ("casino", "school")]
    blocked = np.array([h.startswith("casino") for h in hosts], float)
    paths = [f"/p/{k}" for k in range(len(hosts))]
    model = url_filter.fit(hosts[:300], paths[:300], blocked[:300])
    assert ((model.score(hosts[300:], paths[300:]) > 0.5) == blocked[300:]).all()


def test_token_lengths(docs, none, pairs, monkeypatch):
    monkeypatch.setattr(token_counts, "RANGE_LENGTHS", 16)
    bpe = encoder(vocabulary_path())
    sizes = np.array([len(bpe.ids(t or "")) for _, t in pairs])
    hist = token_counts.histogram(token_counts.encoded_lengths(docs))
    rows = {r.context: r for r in token_counts.limit_table(hist).collect()}
    assert set(rows) == set(sizes.tolist())
    for limit, r in rows.items():
        within = sizes <= limit
        assert (r.n_docs, r.docs_within, r.docs_over) == ((sizes == limit).sum(), within.sum(), (~within).sum())
        assert (r.tokens_within, r.tokens_over) == (sizes[within].sum(), sizes[~within].sum())
        assert r.truncated_tokens == np.minimum(sizes, limit).sum() and r.quantile == within.mean()
    for r in token_counts.at_limits(hist, [0, 5, 17, 10 ** 6]).collect():
        assert r.truncated_tokens == np.minimum(sizes, r.limit).sum() and r.docs_within == (sizes <= r.limit).sum()
    for r in token_counts.length_quantiles(token_counts.limit_table(hist), [0.25, 0.5, 1.0]).collect():
        assert r.context == min(s for s in sizes if (sizes <= s).mean() >= r.share)
    empty = token_counts.histogram(token_counts.encoded_lengths(none))
    assert token_counts.limit_table(empty).collect() == []


def test_personal_data(spark, docs, none, pairs):
    odd = ["a@b.c%d@e.f", "x@y a@b..c .@-.-", "1.2.3.4.5.6.7.8.9", "256.1.1.1 01.002.3.255", "4111111111111111 4111 1111 1111 1112",
           "12 " * 30, "+1 2+3456789012 +49 (30) 1234-5678)", "é+1 319 555 5132ß", "+" + "1" * 30, "1" * 5_000, "a" * 5_000 + "@", MAIL * 40]
    more = spark.createDataFrame([doc(100 + k, t) for k, t in enumerate(odd)], DOCS)
    found = pii.find(docs.union(more).withColumn("spans", F.lit(1)))
    texts = dict(pairs) | {100 + k: t for k, t in enumerate(odd)}
    rows = found.withColumn("masked", pii.masked(found)).collect()
    assert len(rows) == len(pairs) + len(odd)
    for r in rows:
        if r.doc_id is not None:
            base = [(s.kind, s.first, s.end) for s in r.base_spans]
            assert base == brute.base_spans(texts[r.doc_id])
            assert set(base) <= {(s.kind, s.first, s.end) for s in r.spans}
    by_id = {r.doc_id: r for r in rows}
    assert by_id[7].masked == "Call <PHONE> or write <EMAIL> from <IP>, card <CARD>."
    assert by_id[0].masked is None and by_id[4].masked == SENTENCE
    assert pii.find(none).collect() == []


def test_personal_data_learns_loose_forms(spark):
    rng = np.random.default_rng(1)
    lines = [f"please call phone {rng.integers(200, 999)}-{rng.integers(200, 999)}-{rng.integers(1000, 9999)} or mail to bob at host{k} dot com now"
             for k in range(60)] + [MAIL] * 60 + [SENTENCE] * 20
    found = pii.find(spark.createDataFrame([doc(k, t) for k, t in enumerate(lines)], DOCS)).collect()
    added = Counter(s.kind for r in found if r.doc_id < 60 for s in r.spans)
    assert added["phone"] == 60 and added["email"] == 60
    assert not any(r.spans for r in found if r.doc_id >= 120)


def test_fingerprints_and_components(docs, none, pairs):
    rows = simhash.near_duplicates(docs).collect()
    bits = [brute.fingerprint(t) for _, t in pairs]
    label = brute.components(bits, 4)
    lowest = {c: min((i for (i, _), k in zip(pairs, label) if k == c and i is not None), default=None) for c in set(label)}
    assert order(tuple(r) for r in rows) == order((i, f"{b:016x}", lowest[c]) for (i, _), b, c in zip(pairs, bits, label))
    kept = simhash.one_of_each(docs).select("doc_id", *docs.columns[1:]).collect()
    assert order(r.doc_id for r in kept) == order(lowest[c] for c in set(label))
    assert simhash.near_duplicates(none).collect() == [] and simhash.one_of_each(none).collect() == []


@pytest.mark.parametrize("tile", [20_000, 40])
def test_links_span_all_components(spark, tile):
    rng = np.random.default_rng(5)
    bits = set(rng.integers(0, 1 << 63, 60).tolist())
    for b in list(bits)[:12]:
        for _ in range(25):
            bits.add(b ^ sum(1 << int(k) for k in rng.choice(63, rng.integers(1, 7), replace=False)))
    bits = sorted(bits)
    found = simhash.links(spark.createDataFrame([(b,) for b in bits], "bits long"), tile=tile)
    roots = {r.node: r.root for r in components.component_roots(found).collect()}
    label = brute.components(bits, 4)
    assert [roots.get(b, b) for b in bits] == [bits[k] for k in label]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(0, 0), (100, 90), (None, 3)], "a long, b long")
    assert {r.node: r.root for r in components.component_roots(edges).collect()} == dict.fromkeys(range(41), 0) | {90: 90, 100: 90}
    assert components.component_roots(edges.limit(0)).collect() == []


@pytest.mark.parametrize("cut", [repeats.Cut(), repeats.Cut(60, 4, 8, 30), repeats.Cut(60, 4, 30, 30)])
def test_repeated_bytes(docs, none, pairs, cut):
    rows = repeats.digest(repeats.repeated_spans(docs, cut)).collect()
    runs = brute.removed([t for _, t in pairs], cut.size)
    wanted = [(i, len((t or "").encode()), sum(b - a for a, b in r), len(r), brute.kept_digest(t, r)) for (i, t), r in zip(pairs, runs)]
    assert order(tuple(r) for r in rows) == order(wanted) and any(w[2] for w in wanted)
    assert repeats.digest(repeats.repeated_spans(none, cut)).collect() == []


def test_wide_marks_are_not_broadcast(spark):
    keys = ["id as key_id", "id as key_hash"]
    texts = spark.range(40).selectExpr(*keys, "cast('text' as binary) as octets")
    marks = spark.range(40).selectExpr(*keys, "cast(repeat('x', 500000) as binary) as starts").checkpoint()
    more = spark.range(2_000).selectExpr(*keys, "cast('text' as binary) as octets")
    for table, n in ((texts, 40), (more, 2_000)):
        maybe, unmarked = common.beside_marks(table, marks, repeats.KEY)
        plan = maybe._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("BroadcastExchange") == 1  # the bitmap's
        rows = maybe.select("key_id", F.length("starts").alias("n")).collect()
        assert sorted(r.key_id for r in rows if r.n) == list(range(min(n, 40))) and all(r.n in (None, 500_000) for r in rows)
        assert len(rows) < 40 + n / 4 and sorted([r.key_id for r in rows] + [r.key_id for r in unmarked.collect()]) == list(range(n))


def test_toxicity(spark, none):
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    rows, labels = [], []
    for k in range(600):
        text = list(rng.choice(words, rng.integers(5, 60)))
        if toxic := k % 4 == 0:
            text[rng.integers(len(text))] = "zounds" + str(rng.choice(["", "a", "b", "c"]))
        rows.append(doc(k, " ".join(text), "de" if k % 2 else "en"))
        labels.append((k, 1, int(toxic)))
    rows += [doc(1_000, None), doc(1_001, ""), doc(1_001, ""), doc(None, "zounds"), doc(1_002, "word " * 20_000, None)]
    labels += [(None, 1, 1), (5, 1, None), (7, 1, 3)]
    table, marks = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(table, toxicity.learning_rows(marks))
    found = toxicity.classify(table, model).collect()
    held = [r for r in found if r.doc_id is not None and r.doc_id < 600 and brute.remainder(r.doc_id, 3) == 1]
    right = [r.predicted == (r.doc_id % 4 == 0) for r in held]
    assert len(found) == len(rows) and len(held) > 100 and np.mean(right) > 0.97
    assert all(0 <= r.score <= 1 for r in found) and set(table.columns) <= set(found[0].asDict())
    for some in (marks.limit(0), marks.where("toxic = 1")):
        assert all(0 <= r.score <= 1 for r in toxicity.classify(table, toxicity.train(table, some)).collect())
    assert toxicity.classify(none, model).collect() == []


def test_one_training_text_of_an_id(spark):
    table = spark.createDataFrame([doc(1, f"text {k}") for k in range(50)] + [doc(2, "other")], DOCS)
    marks = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    rows, share = toxicity.sample(table, marks, toxicity.Shape(), 10, 10, 100)
    assert sorted(r[1] for r in rows) == [0, 1] and share == 0.5


def test_all_labelled_texts_train(spark):
    """A word that only some of 3,400 toxic texts hold, the last ones by their ids' hash, and one of very long texts."""
    table = spark.range(12_400).select(F.col("id").alias("doc_id"), (F.col("id") < 3_400).cast("int").alias("toxic"))
    last = [r.doc_id for r in table.where("toxic = 1").orderBy(F.xxhash64("doc_id").desc(), "doc_id").limit(60).collect()]
    assert last[-1] not in [r.doc_id for r in table.where("toxic = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(3_000).collect()]
    text = F.when(F.col("doc_id").isin(last[:40]), "quite plain zounds words").when(
        F.col("doc_id").isin(last[40:]), F.concat(F.repeat(F.lit("word "), 21_000), F.lit("gadzooks"))).when(
        F.col("toxic") == 1, "some quite foul words").otherwise(F.concat(F.lit("some quite plain words "), F.col("doc_id") % 50))
    docs = table.select("doc_id", text.alias("text"), F.lit("en").alias("lang")).checkpoint()
    rows = toxicity.training_rows(docs, table).selectExpr("count(*)", "count(distinct doc_id)", "max(length(ids)) div 4").first()
    assert tuple(rows) == (12_400, 12_400, 21_001)
    asked = spark.createDataFrame([(1, "quite plain zounds words"), (2, "quite plain words"), (3, "gadzooks"), (4, "word")], "doc_id long, text string")
    found = {r.doc_id: r.score for r in toxicity.classify(asked.withColumn("lang", F.lit("en")), toxicity.train(docs, table)).collect()}
    assert found[1] > 0.7 and found[3] > 0.7 and found[2] < 0.3, found


def test_shards_learn_together(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_TEXTS", 100)
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    texts = [" ".join([*rng.choice(words, rng.integers(0, 60)), *["zounds"] * (k % 4 == 0), *rng.choice(words, 5)]) for k in range(900)]
    docs = spark.createDataFrame([(k, t, "de" if k % 2 else "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(600)], "doc_id long, toxic int")
    one, other = (toxicity.train(docs.repartition(n), labels, steps=300) for n in (2, 5))
    assert all((one.network.params[name] == other.network.params[name]).all() for name in one.network.params)
    right = [r.predicted == (r.doc_id % 4 == 0) for r in toxicity.classify(docs, one).where("doc_id >= 600").collect()]
    assert np.mean(right) > 0.97


def test_parameters_reach_the_driver_in_pieces(spark, monkeypatch):
    """With many words, no job of the fit returns over 3 MB; as rows of doubles all changed parameters are some 14 MB."""
    monkeypatch.setattr(toxicity, "SHARD_TEXTS", 500)
    rng = np.random.default_rng(4)
    rows = [(k, int(k % 3 == 0), rng.integers(0, 1 << 30, 1_500).astype(np.int32).tobytes()) for k in range(1_200)]
    table = spark.createDataFrame(rows, "doc_id long, toxic int, ids binary").localCheckpoint()
    network = toxicity.Network.fresh(toxicity.Shape())
    before = network.lines(network.params).copy()
    settings = spark.sparkContext._jsc.sc().conf()
    kept = settings.get("spark.driver.maxResultSize", "1g")
    settings.set("spark.driver.maxResultSize", "3m")
    try:
        toxicity.fit(network, table, 1_200, 400, 1_800_000, 3_000)
    finally:
        settings.set("spark.driver.maxResultSize", kept)
    assert (network.lines(network.params) != before).any(axis=1).sum() > 50_000


def test_long_texts_are_convolved_in_pieces(monkeypatch):
    network, rng = toxicity.Network.fresh(toxicity.Shape()), np.random.default_rng(1)
    filters = np.concatenate([network.params[f"conv{w}"][k] for w in (1, 2, 3) for k in range(w)], axis=1)
    for size in (0, 1, 2, 5, 40):
        ids = rng.integers(0, 1 << 30, size)
        wanted = network.pooled(ids, network.tables())
        whole, places = network.peaks(ids, filters)
        assert np.allclose(np.maximum(whole.ravel(), 0), wanted, atol=1e-5)
        for piece in (1, 3, 7):
            monkeypatch.setattr(toxicity, "PIECE", piece)
            parts, same = network.peaks(ids, filters)
            assert np.allclose(parts, whole, atol=1e-5) and (same == places).all()
        monkeypatch.undo()


def test_language_is_no_input(spark):
    rows = [(k, "same words", lang) for k, lang in enumerate(["en", None, "de"] * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(12)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert len({r.score for r in toxicity.classify(docs, model).collect()}) == 1


def test_thresholds_and_calibration_of_all_rows(spark):
    """Against plain loops over all rows, with ties, a hot score, few rows of a label and a missing language."""
    rng = np.random.default_rng(6)
    rows = []
    for lang, n, grain in (("en", 3_000, 1e-9), ("de", 2_000, 0.05), ("fr", 12, 1e-9), ("", 300, 0.3), ("one", 40, 1e-9)):
        toxic = rng.random(n) < 0.2
        score = np.clip(rng.normal(0.3 + 0.3 * toxic, 0.15), 0, 1)
        rows += [(lang, int(t) * (lang != "one"), float(round(s / grain) * grain)) for t, s in zip(toxic, score)]
    table = spark.createDataFrame(rows, "lang string, toxic int, score double")
    wanted = {}
    for lang in {r[0] for r in rows}:
        some = [(s, t) for x, t, s in rows if x == lang]
        ones, cuts = sum(t for _, t in some), sorted({s for s, _ in some}, reverse=True)
        f1 = [2 * sum(t for s, t in some if s >= cut) / (sum(s >= cut for s, _ in some) + ones) for cut in cuts]
        at = f1.index(max(f1))
        wanted[lang] = (cuts[at] + [*cuts, 0.0][at + 1]) / 2 if min(ones, len(some) - ones) >= 10 else toxicity.THRESHOLD
    for parts in (2, 64):
        found = toxicity.best_threshold(table, parts=parts)
        assert set(found) == set(wanted) and all(abs(found[x] - wanted[x]) < 1e-12 for x in wanted)
    x, y = np.array([4 * r[2] - 2 for r in rows]), np.array([r[1] for r in rows])
    a, b = toxicity.calibration(table.select("toxic", (4 * F.col("score") - 2).alias("logit")))
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    error = 1 / (1 + np.exp(-a * x - b)) - target
    assert abs((error * x).mean()) < 1e-6 and abs(error.mean()) < 1e-6 and a > 1


def test_every_labelled_language_has_a_threshold(spark):
    """Also one whose rows are the last ones of both labels by their ids' hash, among 12,400."""
    table = spark.range(12_400).select(F.col("id").alias("doc_id"), (F.col("id") < 3_400).cast("int").alias("toxic"))
    last = [r.doc_id for toxic in (0, 1) for r in table.where(f"toxic = {toxic}").orderBy(F.xxhash64("doc_id").desc()).limit(150).collect()]
    lang = F.when(F.col("doc_id").isin(last), "xx").otherwise("en")
    text = F.concat(F.when(F.col("toxic") == 1, "some quite foul words ").otherwise("some quite plain words "), F.col("doc_id") % 50)
    docs = table.select("doc_id", text.alias("text"), lang.alias("lang")).checkpoint()
    assert set(toxicity.train(docs, table, steps=50).thresholds) == {"en", "xx"}


def test_no_task_gets_a_whole_language(spark):
    """A threshold's rows are dealt by language and part of the range, though all are of one language."""
    rows = spark.range(4_000).selectExpr("'en' as lang", "cast(id % 5 = 0 as int) as toxic", "id / 4000d as score").checkpoint()
    running = toxicity.running_sums(rows, 64)
    sizes = [r[0] for r in running.groupBy(F.spark_partition_id()).count().select("count").collect()]
    plan = running._jdf.queryExecution().executedPlan().toString()
    assert sum(sizes) == 4_000 and "SortMergeJoin" not in plan and running.groupBy("part").count().agg(F.max("count")).first()[0] < 200


def test_no_window_escapes_the_masks():
    places = range(decontam.WINDOW)
    misses = decontam.WINDOW - math.ceil(decontam.WINDOW * decontam.SHARE)
    for bad in itertools.combinations(places, misses):
        assert any(all(s + k not in bad for k in mask) for mask in decontam.MASKS for s in range(decontam.WINDOW - decontam.SPAN + 1))


def test_benchmark_overlaps(spark, docs, none):
    rng = np.random.default_rng(4)
    words = SENTENCE.split()
    texts, items = [], [(0, SENTENCE), (1, " ".join(words[::-1])), (2, "a b c"), (3, None), (4, " ".join(words[:9])), (None, SENTENCE), (0, SENTENCE)]
    for k in range(60):
        own = [str(w) for w in rng.choice(["alpha", "beta", "gamma", "delta"], 40)]
        taken = list(words[int(rng.integers(0, 6)):])
        for place in rng.choice(len(taken), int(rng.integers(0, 5)), replace=False):
            taken[place] = "other"
        texts.append(" ".join(own[:k % 20] + taken + own) if k % 5 else " ".join(own))
    table = spark.createDataFrame([doc(k, t) for k, t in enumerate(texts)] + [doc(0, None), doc(None, SENTENCE.upper())], DOCS)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.overlaps(table, benchmark).collect()}
    long = [(i, t) for i, t in items if t and len(t.split()) >= 13]
    wanted = {(k, i) for k, t in enumerate(texts) for i, u in long if brute.overlap(t, u)} | {(None, 0), (None, None)}
    assert {p for p in found if p[1] != 4} == wanted and {p[1] for p in found} <= {0, 1, 4, None}
    kept = decontam.without_benchmark(table, benchmark).select("doc_id", "text").collect()
    assert {r.doc_id for r in kept} == {k for k in range(60)} - {p[0] for p in found}
    assert decontam.overlaps(none, benchmark).collect() == [] and decontam.overlaps(docs, benchmark.limit(0)).collect() == []


@pytest.mark.parametrize("share", [0.5, 0.8, 1.0])
def test_no_pattern_escapes_the_masks_of_any_length(share):
    for wide in range(1, 17):
        misses = wide - decontam.needed(wide, share)
        for bad in itertools.combinations(range(wide), misses):
            assert any(all(s + k not in bad for k in mask) for mask in decontam.masks(wide, share) for s in range(wide - mask[-1]))


@pytest.mark.parametrize("window, share", [(13, 0.8), (6, 0.7)])
def test_short_items_are_found(spark, window, share):
    rng = np.random.default_rng(8)
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in (1, 3, 5, 7, 8, 9, 10, 11, 12, 15)] + [(99, "")]
    texts = []
    for n, item in items[:-1]:
        for misses in range(4):
            for _ in range(6):
                taken = item.split()
                for place in rng.choice(n, min(n, misses), replace=False):
                    taken[place] = "other"
                texts.append(" ".join(["some", "text", *taken, "and", "more"]))
        texts += [item, item.rsplit(" ", 1)[0], item.split(" ", 1)[-1], "before it " + item.rsplit(" ", 2)[0]]
    table = spark.createDataFrame([doc(k, t) for k, t in enumerate(texts)], DOCS)
    found = decontam.overlaps(table, spark.createDataFrame(items, "item_id long, text string"), window, share).collect()
    wanted = {(k, i) for k, t in enumerate(texts) for i, u in items[:-1] if brute.overlap(t, u, window, share)}
    assert {(r.doc_id, r.item_id) for r in found} == wanted
    for bad in ((0, 0.8), (13, 0.0), (13, 1.1)):
        with pytest.raises(ValueError):
            decontam.overlaps(table, table, *bad)


def test_overlaps_do_not_depend_on_blocks(spark, monkeypatch):
    item = SENTENCE.split()
    fill = [f"w{k}" for k in range(70)]
    texts = [item[4:] + fill, fill[:29] + item + fill[:3] + item[:15], fill + item[:16], item, item[:12] + ["x"], fill, []]
    table = spark.createDataFrame([doc(k, " ".join(t)) for k, t in enumerate(texts)], DOCS)
    benchmark = spark.createDataFrame([(1, SENTENCE), (2, " ".join(item[:14] + fill[:40])), (3, "")], "item_id long, text string")
    whole = sorted(decontam.overlaps(table, benchmark).collect())
    assert {(r.doc_id, r.item_id) for r in whole} == {
        (k, i) for k, t in enumerate(texts) for i, u in ((1, SENTENCE), (2, " ".join(item[:14] + fill[:40])))
        if brute.overlap(" ".join(t), u)}
    monkeypatch.setattr(decontam, "BLOCK", 1)  # so a block is as long as the longest item
    assert sorted(decontam.overlaps(table, benchmark).collect()) == whole


def test_overlaps_of_one_word_repeated(spark):
    table = spark.createDataFrame([doc(1, "the " * 100_000), doc(2, "the end")], DOCS)
    benchmark = spark.createDataFrame([(1, "the " * 20), (2, SENTENCE)], "item_id long, text string")
    began = time.monotonic()
    found = [(r.doc_id, r.item_id, r.doc_start, r.doc_end, r.n_equal) for r in decontam.overlaps(table, benchmark).collect()]
    assert found == [(1, 1, 0, 20, 20)] and time.monotonic() - began < 60  # some 10 s; with the length squared it's hours


def test_rows_that_a_map_of_hashes_lets_through(spark):
    known = spark.range(0, 1_000, 7).select(F.xxhash64("id").alias("seed")).checkpoint()
    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("seed"))
    kept = {r.id for r in common.maybe_among(rows, "seed", known).collect()}
    assert set(range(0, 1_000, 7)) <= kept and len(kept) < 143 + 400
    assert common.maybe_among(rows, "seed", known.limit(0).checkpoint()).count() == 0


def test_texts_are_joined_alike_at_every_size(docs):
    benchmark = docs.where("doc_id = 4").select(F.col("doc_id").alias("item_id"), "text")
    for kept in (simhash.one_of_each(docs), decontam.without_benchmark(docs, benchmark)):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "HashJoin" in line or "SortMergeJoin" in line]
        assert any("SortMergeJoin" in line for line in joins)
        assert all("__bucket" in line for line in joins if "SortMergeJoin" not in line)  # the bitmap's


def test_neighbours(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 1, (12, 16))
    vectors = np.concatenate([centres[rng.integers(0, 12, 1_500)] + rng.normal(0, 0.2, (1_500, 16)), np.tile(centres[:1], (300, 1))])
    rows = [(k, [float(np.float32(x)) for x in v], k) for k, v in enumerate(vectors)]
    extra = [(5_000, None, 0), (5_001, [0.0] * 16, 0), (5_002, [float("nan")] * 16, 0), (5_003, [1.0, None], 0), (5_004, [], 0),
             (5_100, [1.0, 2.0], 0), (5_200, [1.0, 3.0], 0), (None, [1.0] * 16, 0), rows[0]]
    table = spark.createDataFrame(rows + extra, "vec_id long, embedding array<float>, rank int")
    asked = table.where("vec_id % 100 = 0")
    got = defaultdict(list)
    for r in hnsw.nearest(table, asked, shard_nodes=400, block_queries=5).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    exact = np.array([v for _, v, _ in rows])
    hit = total = 0
    for k in range(0, 1_800, 100):
        distance = np.sqrt(((exact - exact[k]) ** 2).sum(axis=1))
        near = [i for i in np.lexsort((np.arange(len(exact)), distance)) if i != k][:10]
        found = sorted(got[k])
        assert [f[0] for f in found] == list(range(1, 11)) and [f[2] for f in found] == sorted(f[2] for f in found)
        assert np.allclose([f[2] for f in found], distance[[f[1] for f in found]], atol=1e-9)
        hit, total = hit + len({f[1] for f in found} & set(near)), total + 10
    assert hit / total >= 0.9
    assert got[5_100] == [(1, 5_200, 1.0)] and set(got) == {*range(0, 1_800, 100), 5_100, 5_200}
    assert hnsw.nearest(table.limit(0), asked).collect() == [] and hnsw.nearest(table, asked.limit(0)).collect() == []


def grouped(rng, rows, groups, dim=16):
    centres = rng.normal(0, 1, (groups, dim))
    return (centres[rng.integers(0, groups, rows)] + rng.normal(0, 0.1, (rows, dim))).astype(np.float32)


def vector_table(spark, vectors, kind="float"):
    return spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], f"vec_id long, embedding array<{kind}>")


def true_neighbours(vectors, k, most=10):
    distance = np.sqrt(((vectors.astype(float) - vectors[k].astype(float)) ** 2).sum(axis=1))
    return [i for i in np.lexsort((np.arange(len(vectors)), distance)) if i != k][:most], distance


def test_neighbours_take_few_tasks_for_many_shards_and_blocks(spark):
    vectors = grouped(np.random.default_rng(7), 3_000, 60)
    table = vector_table(spark, vectors).repartition(4)
    context = spark.sparkContext
    context.setJobGroup("neighbours", "30 shards, 100 blocks of queries")
    try:
        got = defaultdict(list)
        for r in hnsw.nearest(table, table.where("vec_id % 3 = 0"), shard_nodes=100, block_queries=10).collect():
            got[r.query_id].append((r["rank"], r.vec_id, r.score))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup("neighbours") for s in tracker.getJobInfo(job).stageIds}
    assert sum(i.numTasks for i in map(tracker.getStageInfo, stages) if i) < 600  # a pair of shard and block was a task
    hit = 0
    for k in range(0, 3_000, 3):
        near, distance = true_neighbours(vectors, k)
        found = sorted(got[k])
        assert [f[0] for f in found] == list(range(1, 11)) and np.allclose([f[2] for f in found], distance[[f[1] for f in found]], atol=1e-12)
        hit += len({f[1] for f in found} & set(near))
    assert hit >= 0.95 * 10_000


def test_queries_come_in_rounds(spark, monkeypatch):
    vectors = grouped(np.random.default_rng(8), 600, 20)
    table = vector_table(spark, vectors)
    whole = {tuple(r) for r in hnsw.nearest(table, table.where("vec_id % 2 = 0"), shard_nodes=100).collect()}
    monkeypatch.setattr(hnsw, "ROUND_BYTES", 20_000)
    assert {tuple(r) for r in hnsw.nearest(table, table.where("vec_id % 2 = 0"), shard_nodes=100).collect()} == whole
    assert len(whole) == 3_000


def test_cells_searched_hold_the_true_neighbours(spark):
    rng = np.random.default_rng(9)
    sphere = rng.normal(0, 1, (2_000, 32)).astype(np.float32)
    share = {}
    for name, vectors in (("groups", grouped(rng, 2_000, 40)), ("none", sphere)):
        rows = hnsw.packed(vector_table(spark, vectors), "f4", "vec_id")
        nodes = hnsw.distinct_vectors(rows, 11).checkpoint()
        asked = rows.where("vec_id % 10 = 0").withColumnRenamed("vec_id", "query_id").checkpoint()
        dim = vectors.shape[1]
        router = hnsw.routers(nodes, asked, 10, 100, "f4")[dim]
        queries = vectors[::10].astype(float)
        searched = hnsw.squared(queries, router.centres) <= router.reach(queries)[:, None]
        cell = hnsw.nearest_centre(vectors.astype(float), router.centres)
        held = [searched[at, cell[true_neighbours(vectors, k)[0]]] for at, k in enumerate(range(0, 2_000, 10))]
        assert np.mean(held) >= 0.98
        share[name] = searched.mean()
        assert len(router.centres) == 20 and router.shards.min() >= 1
    assert share["groups"] < 0.4 < share["none"]


def test_large_cells_are_cut_into_shards(spark):
    near = np.random.default_rng(10).normal(0, 1e-6, (1_500, 8)) + 1
    far = np.eye(8) * 50
    nodes = hnsw.distinct_vectors(hnsw.packed(vector_table(spark, np.concatenate([near, far]), "double"), "f8", "vec_id"), 11).checkpoint()
    router = hnsw.Router(np.array([[1.0] * 8, [50.0] * 8]), np.inf, np.array([15, 1]))
    sizes = [len(r.id_ends) // 4 for r in hnsw.build_index(nodes, {8: router}, "f8").collect()]
    assert sum(sizes) == 1_508 and max(sizes) < 200


def test_neighbours_of_odd_vectors(spark):
    def found(rows, kind="double", k=10):
        table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
        return [tuple(r) for r in hnsw.nearest(table, table.where("vec_id % 100 = 0"), k).orderBy("query_id", "rank").collect()]

    assert found([(0, [1.0, 0.0]), (1, [1.0, -0.0]), (2, [1.0, 5.0])]) == [(0, 1, 1, 0.0), (0, 2, 2, 5.0)]
    huge = found([(0, [3e200, 0.0]), (1, [0.0, 4e200]), (2, [3e200, 1e200])])
    assert [r[:3] for r in huge] == [(0, 1, 2), (0, 2, 1)] and [r[3] for r in huge] == pytest.approx([1e200, 5e200])
    assert found([(0, [3e-200, 0.0]), (1, [3e-200, 0.0])]) == [(0, 1, 1, 0.0)]
    wide = found([(0, [2.0 ** 100, 0.0]), (1, [0.0, 0.0]), (2, [2.0 ** 100, 2.0 ** 90])], "float")
    assert wide == [(0, 1, 2, 2.0 ** 90)]
    many = found([(0, [0.0, 1.0])] + [(7, [0.0, 2.0 + i]) for i in range(5)] + [(8, [0.0, 99.0])])
    assert many == [(0, 1, 7, 1.0), (0, 2, 8, 98.0)]
    assert found([(0, [1.0]), (100, [2.0]), (200, [1.0, 1.0])], k=1) == [(0, 1, 100, 1.0), (100, 1, 0, 1.0)]
    assert found([(0, [1, 2]), (1, [1, 4])], "int") == [(0, 1, 1, 2.0)]


def test_stages_keep_clean_documents(spark, docs, none, tmp_path):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(0, "so many other words that nobody here would ever write down in this order at all")], "item_id long, text string")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for table in (plain, plain.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, str(tmp_path))
            assert out.columns == plain.columns, name
            if name != "near_copies":
                assert out.count() == table.count(), name
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "benchmark", "personal_data", "packing"]


def test_pipeline_drops_and_masks_what_was_planted(spark, tmp_path):
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    texts = {k: " ".join(rng.choice(words, 40)) for k in range(400)}
    for k in range(0, 400, 4):
        texts[k] = "zounds " + texts[k]
    item = " ".join(rng.choice(words, 20))
    texts |= {401: texts[1], 402: "before it " + item + " and after", 403: texts[3] + " a.b@mail.example.com"}
    rows = [(k, t, "en", "s", len(t)) for k, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(400)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    tokens = {r.doc_id: r.doc_tokens for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    clean = {k: t.replace("a.b@mail.example.com", "<EMAIL>") for k, t in texts.items() if not t.startswith("zounds") and k not in (401, 402)}
    bits = {k: brute.fingerprint(texts[k]) for k in clean}
    label = brute.components(list(bits.values()), 4)
    wanted = [k for at, k in enumerate(bits) if label[at] == at]
    bpe = encoder(vocabulary_path())
    assert tokens == {k: len(bpe.ids(clean[k])) + 1 for k in wanted}


def test_many_small_documents_are_packed_in_time():
    sizes = np.full(200_000, 10)
    pool = packing.Pool().add(np.arange(len(sizes)), np.zeros(len(sizes)), sizes, np.zeros(len(sizes)))
    began = time.time()
    bins, _ = packing.fill_bins(pool, packing.Limits())
    assert time.time() - began < 10
    assert sum(len(b) for b in bins) >= 200_000 and sum(p[2] for b in bins for p in b) == 2_000_000
    assert all(len(b) <= 64 for b in bins)


@pytest.mark.parametrize("operator", ["near", "benchmark", "toxic", "personal"])
def test_no_column_of_the_caller_is_lost(spark, operator):
    own = ["__key", "__kept", "__n", "__bad", "__key_id", "__key_hash", "__bucket", "__place", "__hit", "__bitmap", "__row", "__every", "row",
           "key", "kept", "bad", "bits", "root", "n", "lie", "item", "stretch", "key_id", "key_hash"]
    other = "every row here has a text of its own with the number"
    rows = [(k, f"{other} {k} " + SENTENCE * (k % 2), "en", *["x"] * len(own)) for k in range(4)] + [(9, SENTENCE, "en", *["x"] * len(own))] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in own))
    items = spark.createDataFrame([(1, SENTENCE + " and a few more words")], "item_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(4)], "doc_id long, toxic int")
    kept = {"near": lambda: simhash.one_of_each(docs), "benchmark": lambda: decontam.without_benchmark(docs, items),
            "toxic": lambda: corpus_pipeline.drop_toxic(spark, docs, ""), "personal": lambda: pii.find(docs).drop("base_spans", "spans")}
    if operator == "toxic":
        model = toxicity.train(docs, labels)
        kept["toxic"] = lambda: toxicity.classify(docs, model).select(*[f"`{c}`" for c in docs.columns])
    got = kept[operator]()
    assert got.columns == docs.columns
    found = got.collect()
    assert found and all(r[c] == "x" for r in found for c in own)
