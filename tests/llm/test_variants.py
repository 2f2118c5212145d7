"""Spelling variants against a plain search of all words one letter apart."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from skygauge.llm import queries, variants

DOCS = "doc_id long, text string, word string, n long, tile long, run int"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def counted(rows, shortest=7, divisor=31):
    words = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % divisor == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= shortest:
                words[run] += 1
    return {w: n for w, n in words.items() if n > 1}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def grouped(words, ratio=10):
    out = {}
    for w, n in words.items():
        near = [v for v in words if is_near(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= ratio * n else None
        out[w] = [form, n, len(near), words[form] if form else None]
    rows = set()
    for w, (form, n, near, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.add((w, form, root, n, near, form_n))
    return rows


def words_table(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


@pytest.fixture(scope="module")
def words():
    rng = np.random.default_rng(5)
    made = {}
    for _ in range(500):  # few letters, so that many are near
        made["".join(rng.choice(list("abéÿ"), rng.integers(7, 10)))] = int(2 * 10 ** rng.integers(0, 5))
    long = "ab" * 200
    made |= {long: 2, long[:-1]: 30, long + "a": 400, "x" + long: 7, long[:50] + "z" + long[51:]: 9,
             "aaaaaaa": 5, "aaaaaaaa": 5, "aaaaaaaaa": 500, "aaaaaaaaaa": 50_000}
    return made


@pytest.mark.parametrize("sizes", [{}, {"tile": 7, "block": 16}, {"tile": 50, "block": 8, "tile_letters": 500}])
def test_near_words_forms_and_roots(spark, words, sizes):
    got = variants.spelling_groups(words_table(spark, words).repartition(3), **sizes).collect()
    assert len(got) == len(words)
    assert {tuple(r) for r in got} == grouped(words)


def test_short_words_and_no_words(spark):
    few = {"a": 2, "b": 40, "ab": 400, "ba": 3, "c" * 3: 2}
    assert {tuple(r) for r in variants.spelling_groups(words_table(spark, few)).collect()} == grouped(few)
    assert variants.spelling_groups(words_table(spark, {"a": 1}).limit(0)).collect() == []


def test_query_rows_of_texts(spark, tmp_path):
    rng = np.random.default_rng(6)
    stems = ["".join(rng.choice(list("abcdeéß×"), rng.integers(6, 11))) for _ in range(60)]
    texts = [" ".join(rng.choice(stems, rng.integers(1, 300))) for _ in range(40)]
    texts += [None, "", " \n", "STRASSE Straße ÀÉÎ ÉCOLIER écolier", texts[0].upper(), "q" * 3_000 + " " + "q" * 3_000,
              "1234567 a_bcdefgh-ijklmnop", "Ÿ東京abcdefgœabcdefg", texts[1] + " ", texts[1]]
    rows = [(k, t, "x", 1, 2, 3) for k, t in enumerate(texts)] + [(None, texts[2], "x", 1, 2, 3), (3, texts[3], "x", 1, 2, 3)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op11_spelling_groups"](spark, str(tmp_path)).collect()
    wanted = grouped(counted([(r[0], r[1]) for r in rows]))
    assert {tuple(r) for r in got} == wanted and len(got) == len(wanted)
    assert any(r.form for r in got)


def test_position_index_tracks_three_kinds_of_errors():
    words = [b"abcdefg", b"abcdefh", b"abcdef", b"abcdefgh", b"xabcdefg", b"bcdefg", b"abxdefg", b"gfedcba"]
    index = variants.PositionIndex(words)
    found = [{(int(a), int(b)) for a, b in zip(*variants._places(s))} for s in index.one_apart()]
    for kind, change in enumerate((0, 1, -1)):
        assert found[kind] == {(a, b) for a in range(len(words)) for b in range(len(words))
                               if is_near(words[a], words[b]) and len(words[b]) - len(words[a]) == change}
