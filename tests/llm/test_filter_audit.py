"""The audit of filters against applying every order to every document."""

import re
from itertools import permutations

import numpy as np

from skygauge.llm import filter_audit, queries

DOCS = "doc_id long, text string, source string, mask int, digest string, n long"
LABELS = "doc_id long, quality int, toxic int, part string, n long"


def failing(rows):
    """For each row of (doc_id, text, source) the letters of the filters it fails."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, _ in rows)}
        out.append({f for f, bad in fails.items() if bad})
    return out


def audited(rows, labels):
    fails, out = failing(rows), []
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    for part in {s or "" for _, _, s in rows}:
        own = [(d, f) for (d, _, s), f in zip(rows, fails) if (s or "") == part]
        lines, share = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            alive = own
            for step, letter in enumerate(order, 1):
                gone = [x for x in alive if letter in x[1]]
                alive = [x for x in alive if letter not in x[1]]
                share[letter] += len(gone)
                lines.append((letter, part, "".join(order), step, len(alive), len(gone),
                              sum(letter in f for _, f in own) - len(gone), sum(f == {letter} for _, f in own),
                              sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)))
        out += [(*x[1:], share[x[0]]) for x in lines]
    return out


def made_rows():
    rng = np.random.default_rng(8)
    rows = []
    for k in range(90):
        words = [f"w{rng.integers(0, rng.choice([30, 4000]))}" for _ in range(rng.choice([5, 150, 199, 200, 201, 320]))]
        text = " ".join(w.upper() if rng.random() < 0.1 else w for w in words) + rng.choice(["", " $5", " a|b", "\x0b&"])
        rows.append((int(rng.integers(0, 200)), text, str(rng.choice(["a", "b", "c"]))))
    copy = rows[3][1]
    rows += [(k, copy, s) for k, s in ((500, "a"), (501, "b"), (501, "b"), (501, None), (None, "a"), (None, ""), (-1, "c"), (-1, "c"))]
    rows += [(600, None, "a"), (601, "", "b"), (602, " \t\n", "b"), (603, "  x", ""), (604, "#" * 50_000, None), (None, "y", "z")]
    return rows


def test_query_equals_every_order_applied(spark, tmp_path):
    rows = made_rows()
    labels = [(d, q, t) for d, q, t in ((r[0], k % 3 == 0, k % 4) for k, r in enumerate(rows))]
    labels = [(d, int(q), t) for d, q, t in labels] + [(None, 1, 1), (500, None, None), (500, 1, 1), (9_999, 1, 1)]
    spark.createDataFrame([(*r, 1, "d", 2) for r in rows], DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(*r, "p", 5) for r in labels], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    got = queries.QUERIES["op12_filter_audit"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(audited(rows, labels))


def test_no_documents_and_no_labels(spark):
    docs = spark.createDataFrame([(1, "x", "s", 1, "d", 2)], DOCS)
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(filter_audit.mask_counts(docs.limit(0), labels)).collect() == []
    rows = filter_audit.audit(filter_audit.mask_counts(docs, labels)).collect()
    assert sorted(map(tuple, rows)) == sorted(audited([(1, "x", "s")], []))


def test_the_walk_gives_the_survivors_of_every_subset():
    rng = np.random.default_rng(9)
    counts = rng.integers(0, 50, (4, 3, 32))
    states = filter_audit.survivors(counts)
    for subset in range(32):
        alive = [m for m in range(32) if not m & subset]
        assert (states[..., subset] == counts[..., alive].sum(axis=-1)).all()
