"""Spelling variants against all pairs of small vocabularies."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltworks.llm import queries, spelling

WORD = "word string, n long"


def _edits(word, letters):
    """All texts one edit away, spelled out."""
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in letters}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return out - {word}


def _pairs(words):
    letters = set("".join(words))
    return {(w, v) for w in words for v in _edits(w, letters) if v in words}


def _expected(words, ratio=2):
    near: dict = {w: [] for w in words}
    for w, v in _pairs(words):
        near[w].append(v)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * words[w] and words[best] > words[w]:
            form[w] = best
    rows = []
    for w in words:
        end = w
        while end in form:
            end = form[end]
        rows.append((w, words[w], len(near[w]), form.get(w), words.get(form.get(w)), end))
    return sorted(rows)


def _vocabulary(seed, size, letters, longest):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))): rng.randint(1, 500) for _ in range(size)}


def _found(df, words):
    return sorted(tuple(r) for r in spelling.variants(df.sparkSession.createDataFrame(list(words.items()), WORD)).collect())


def test_one_edit():
    rng = random.Random(2)
    for _ in range(3000):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 7)))
        b = "".join(rng.choice("abé") for _ in range(rng.randint(0, 7)))
        assert spelling.one_edit(a, b) == (b in _edits(a, set(a + b)))


@pytest.mark.parametrize("groups,subtree,block", [(12, 50_000, 50_000), (4, 7, 5), (2, 3, 4), (12, 40, 30)])
def test_variants_of_all_pairs(spark, monkeypatch, groups, subtree, block):
    for name, value in (("GROUPS", groups), ("SUBTREE", subtree), ("BLOCK", block), ("BATCH", 3)):
        monkeypatch.setattr(spelling, name, value)
    words = _vocabulary(groups, 160, "abcdé", 7) | _vocabulary(9, 40, "aΩ\U0001f600\U0001f601ß", 4)
    assert _found(spark.range(1), words) == _expected(words)


def test_links_of_one_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SUBTREE", 6)
    monkeypatch.setattr(spelling, "BLOCK", 5)
    rng = random.Random(4)
    words = {"".join(rng.sample("abcdefg", 7)): 1 for _ in range(30)} | {"abcdefg" + c: 2 for c in "abcxyz"} | {"abcdefx": 9}
    found = spelling.links(spark.createDataFrame(list(words.items()), WORD)).collect()
    assert {(r.word, r.near) for r in found} == _pairs(words) and len(found) == len(_pairs(words))
    assert all(r.n == words[r.word] and r.near_n == words[r.near] for r in found)


def test_odd_words(spark):
    rows = [(None, 3), ("house", 10), ("house", 5), ("hose", None), ("horse", 40), ("x" * 5000, 3), ("x" * 4999 + "y", 30), ("", 2), ("a", 2), ("mouse", 15)]
    df = spark.createDataFrame(rows, WORD)
    for name in ("branch", "counts", "home", "spot", "size", "form", "root", "part", "block"):
        df = df.withColumn(name, F.lit("mine"))
    words = {"house": 15, "hose": 0, "horse": 40, "x" * 5000: 3, "x" * 4999 + "y": 30, "": 2, "a": 2, "mouse": 15}
    assert sorted(tuple(r) for r in spelling.variants(df).collect()) == _expected(words)
    assert spelling.variants(df.limit(0)).count() == 0 and spelling.links(df.limit(0)).count() == 0


def test_chains_end(spark):
    words = {"a" * k: 2 ** k for k in range(3, 40)}
    assert {r.root for r in spelling.variants(spark.createDataFrame(list(words.items()), WORD)).collect()} == {"a" * 39}


def test_query_on_odd_texts(spark, tmp_path):
    rng = random.Random(8)
    base = ["Garden", "GARDEN", "gardens", "été-là", "naïve", "×division÷", "Straße", "water", "watér", "1abcde2fghij", "ÀÉÎÕÜ", "short"]
    rows = [(k, " ".join(rng.choices(base, k=rng.randint(0, 40)))) for k in range(400)]
    rows += [(None, "garden garden garden"), (500, None), (501, ""), (502, "Garden " * 20_000), (502, "repeated repeated repeated")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"run": F.lit(1), "id": F.lit(2), "word": F.lit(3), "drawn": F.lit(4)})
    df.write.parquet(f"{tmp_path}/documents.parquet")
    counts: Counter = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    found = queries.QUERIES["op13_spelling_variants"].run(spark, str(tmp_path)).collect()
    assert sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in found) == _expected(words)
    assert any(r.form for r in found)
