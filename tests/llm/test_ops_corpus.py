"""Operators over the corpus: quality, exact copies, similar documents, benchmark passages, the pipeline."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siltworks.llm import decontaminate, grace, jaccard, quality
from siltworks.llm.components import components
from siltworks.llm.queries import QUERIES
from siltworks.llm.wordhash import WordHasher, blank_separated

from ..oracle import SF_DIR, _sorted, connect

DOC = "doc_id long, text string, keep_id long"


# --- registered queries -----------------------------------------------------------------

@pytest.fixture(scope="module")
def database():
    return connect()


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_matches_sql(spark, database, name):
    df = QUERIES[name].run(spark, SF_DIR)
    cursor = database.execute(QUERIES[name].sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert _sorted(df.columns, df.collect()) == _sorted(columns, cursor.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


# --- quality ----------------------------------------------------------------------------

def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = QUERIES["op3_quality_classifier"].run(spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    unseen = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in unseen]) > 0.95
    assert all(r.predicted for r in unseen if truth[r.doc_id])


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "fine words here", 0.5), (2, "bad $$$ words $$$", 0.5), (2, "bad $$$ words $$$", 0.5), (3, None, 0.5),
                                  (None, "", 0.5), (4, "word " * 200_000, 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (5, 1), (3, None), (4, 7)], "doc_id long, quality int")
    weights = quality.fit(docs, labels)
    rows = quality.score(docs, weights).collect()
    assert len(rows) == 6 and all(0 < r.score < 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, None)}) == 1
    empty = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, empty).collect()} == {0.5}
    assert quality.score(docs.limit(0), weights).count() == 0
    kept = quality.keep_good(docs, weights, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == 6


@pytest.mark.parametrize("shards", [2, 3, 4, 5])
def test_weights_are_the_mean_of_the_shards_models(spark, monkeypatch, shards):
    monkeypatch.setattr(quality, "SHARD_EXAMPLES", 40)
    ids = [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 != 2][:40 * shards]
    generator = random.Random(shards)
    rows = [(k, " ".join(generator.choices("good plain words".split() if k % 3 else "bad $$$ junk".split(), k=8)), 1 if k % 3 else 0) for k in ids]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    got = quality.fit(df.select("doc_id", "text"), df.select("doc_id", "quality"), bits=10)
    models = []
    for shard in range(shards):
        held = sorted((k * 0x9E3779B97F4A7C15 % (1 << 63), text.encode(), label) for k, text, label in rows if k % shards == shard)
        model = quality.Ftrl(1 << 10, quality.Steps())
        examples = [(*next(quality.Features(10).texts([(None, text)]))[1:], label) for _, text, label in held]
        for _ in range(quality.Steps().epochs):
            for example in examples:
                model.learn(*example)
        models.append(model.weights())
    assert np.allclose(got, np.mean(models, axis=0)) and np.any(got)


def test_scores_are_sparse_dot_products():
    features = quality.Features()
    text = b"one two two $$$ two"
    (key, places, values), = features.texts([(1, text)])
    assert len(set(places.tolist())) == len(places) and np.isclose(np.linalg.norm(values), quality.LENGTH)
    weights = np.random.default_rng(1).normal(size=(1 << quality.BITS) + 1)
    assert quality.Scorer(weights).of([text.decode()]) == [quality.sigmoid(float(weights[places] @ values + weights[-1]))]


def test_ftrl_separates():
    model = quality.Ftrl(16, quality.Steps())
    for _ in range(50):
        model.learn(np.array([1, 2]), np.array([1.0, 1.0]), 1)
        model.learn(np.array([2, 3]), np.array([1.0, 1.0]), 0)
    w = model.weights()
    assert w[1] > 0.5 and w[3] < -0.5 and w[7] == 0


# --- exact copies -----------------------------------------------------------------------

def brute_groups(rows):
    by = defaultdict(list)
    for key, text in rows:
        by[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), key is None, key or 0, key))
    out = []
    for body, members in by.items():
        best = min(members)
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(m[3], best[3], len(members), m[3] == best[3] and m[0] == best[0], sha) for m in members]
    return sorted(map(repr, out))


@pytest.mark.parametrize("memory", [grace.BUCKET_BYTES, 3000])
def test_exact_groups(spark, memory):
    generator = random.Random(2)
    rows = [(k, generator.choice([" ", "\n", ""]).join(generator.choices(["ab", "c", "é", "dd"], k=generator.randint(0, 6)))) for k in range(1500)]
    rows += [(5000, None), (None, ""), (None, "zz"), (5001, "z z"), (5002, "w"), (5002, "w"), (5003, "x" * 300_000), (5004, " " + "x" * 300_000), (5005, " w")]
    df = spark.createDataFrame([(*r, 7) for r in rows], DOC)
    got = grace.exact_groups(df, bucket_bytes=memory).collect()
    assert sorted(repr((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256)) for r in got) == brute_groups(rows)
    kept = grace.keep_best(df)
    assert kept.columns == df.columns
    assert kept.count() == len({re.sub("[\x20\x09-\x0d]", "", t or "") for _, t in rows})
    assert grace.exact_groups(df.limit(0)).count() == 0 and grace.keep_best(df.limit(0)).count() == 0


def test_buckets_spill_and_still_compare_texts(tmp_path):
    generator = random.Random(3)
    bodies = [generator.randbytes(200) for _ in range(400)]
    records = [(f"r{k}", k, len(b), 1, 7 if k % 3 else int.from_bytes(b[:7], "big"), b) for k, b in enumerate(bodies)]
    records = [(f"{n}{c}", key + 1000 * c, *rest) for n, key, *rest in records for c in range(2)]
    generator.shuffle(records)
    bucket = grace.Bucket(str(tmp_path), memory=20_000)
    got = {name: (key, size) for name, key, _, size in bucket.groups(iter(records))}
    assert got == {f"r{k}{c}": (k, 2) for k in range(400) for c in range(2)}
    assert bucket.spilled > 16 and not list(tmp_path.iterdir())


# --- similar documents ------------------------------------------------------------------

def brute_similar(rows, words=3, percent=90):
    sets = []
    for key, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    parent = {key: key for key, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows[:i]):
            shared = len(sets[i] & sets[j])
            if None not in (a, b) and shared and 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted(repr((key, len(s), root(key) if key is not None else None)) for (key, _), s in zip(rows, sets))


def near_rows(seed: int, size: int, edits: int) -> list[tuple]:
    generator = random.Random(seed)
    word = lambda: "".join(generator.choices("abcdefg", k=3))
    bases = [[word() for _ in range(generator.randint(3, 120))] for _ in range(6)]
    passage = [word() for _ in range(30)]
    rows = []
    for k in range(size):
        text = list(bases[0] if k % 2 else generator.choice(bases))
        for _ in range(generator.randint(0, edits)):
            text[generator.randrange(len(text))] = word()
        if k % 7 == 0:
            text += passage
        rows.append((k * 3 + 1, " ".join(text)))
    return rows


@pytest.mark.parametrize("pair_nodes, block_nodes", [(48, 384), (4, 5), (1000, 1000)])
def test_similar_groups(spark, monkeypatch, pair_nodes, block_nodes):
    """Also where many nodes share a token: in blocks, of which each pair is compared."""
    monkeypatch.setattr(jaccard, "PAIR_NODES", pair_nodes)
    monkeypatch.setattr(jaccard, "BLOCK_NODES", block_nodes)
    rows = near_rows(11, 120, 8) + [(1000, None), (1001, ""), (1002, "one two"), (1003, "ONE  two"), (1004, "one"), (None, "one two"),
                                    (1005, "É a b c"), (1006, "é a b c"), (1, near_rows(11, 1, 0)[0][1])]
    got = jaccard.groups(spark.createDataFrame([(*r, 1) for r in rows], DOC)).collect()
    assert sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in got) == brute_similar(rows)


def test_rows_of_one_id_are_one_document(spark):
    a, b = " ".join(f"w{k}" for k in range(60)), " ".join(f"v{k}" for k in range(60))
    rows = [(5, a), (7, a + " x"), (7, b), (9, b + " y"), (11, "alone")]
    got = {(r.doc_id, r.component_id) for r in jaccard.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(5, 5), (7, 5), (9, 5), (11, 11)}


def test_one_of_each_group_stays(spark):
    df = spark.createDataFrame([(*r, 1) for r in near_rows(12, 40, 3)] + [(None, "x", 1), (900, None, 1)], DOC)
    groups = {r.component_id for r in jaccard.groups(df).collect()} - {None}
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == groups | {None}
    assert jaccard.groups(df.limit(0)).count() == 0 and jaccard.keep_one(df.limit(0)).count() == 0


def test_ranks_keep_the_order_of_counts(spark):
    """Also of a token that a task meets in more texts than a 16-bit count holds."""
    often = spark.range(0, 70_000, 1, 1).select("id", F.lit("a b c").alias("text"))
    some = spark.range(0, 5000, 1, 1).select("id", F.lit("d e f").alias("text"))
    ranks = jaccard.token_ranks(often.union(some), 3, 16)
    hashes = dict(jaccard.Tokens(3).texts([("often", "a b c"), ("some", "d e f")]))
    often, some = (int(ranks[int(hashes[k][0]) >> 48]) for k in ("often", "some"))
    assert ranks.dtype == np.uint8 and (often, some) == (255, int(16 * np.log2(5001))) and np.count_nonzero(ranks) == 2
    assert len(jaccard.token_ranks(spark.createDataFrame([(1, "a b c")], "id long, text string"), 3, jaccard.COUNT_BITS)) >= 1 << 24


def test_filters_of_further_orders_are_narrow_and_drop_nothing(spark):
    rows = [(1, " ".join(f"w{k}" for k in range(200))), (2, " ".join(f"w{k}" for k in range(190)) + " x y z"), (3, "other words of a text")]
    df = spark.createDataFrame(rows, "row_key long, body string")
    sets = jaccard._sets(df, df.select("row_key"), 3, 90)
    assert dict(sets.dtypes)["second"] == dict(sets.dtypes)["third"] == "array<int>"
    found, own = {r.node: r for r in sets.collect()}, dict(jaccard.Tokens(3).texts(rows))
    assert all(sorted(found[k].tokens) == sorted(own[k].view(np.int64).tolist()) for k in own)
    assert set(found[1].second) & set(found[2].second) and set(found[1].third) & set(found[2].third)
    for k, row in found.items():
        low = set(own[k].astype(np.uint32).view(np.int32).tolist())
        assert set(row.second) <= low and set(row.third) <= low and len(row.second) == jaccard.prefix_length(row.n, 90)


def test_prefix_lengths_are_exact():
    for size in range(1, 200):
        p = jaccard.prefix_length(size, 90)
        assert p == next(q for q in range(1, size + 1) if 100 * (size - q) < 90 * size)


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (None, 3), (200, 201)]
    generator = random.Random(1)
    links = [x if generator.random() < 0.5 else x[::-1] for x in links]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    generator = random.Random(4)
    texts = [bytes(generator.choices(b"ab cd\n", k=generator.randint(0, 400))) for _ in range(50)]
    hasher = WordHasher(blank_separated())
    whole = {k: h[b[i]:b[i + 1]].tolist() for keys, b, h in hasher.documents(enumerate(texts)) for i, k in enumerate(keys)}
    monkeypatch.setattr("siltworks.llm.wordhash.BLOCK", 64)
    small = WordHasher(blank_separated())
    cut = {k: h[b[i]:b[i + 1]].tolist() for keys, b, h in small.documents(enumerate(texts)) for i, k in enumerate(keys)}
    assert whole == cut and [len(v) for v in whole.values()] == [len(t.split()) for t in texts]


# --- benchmark passages -----------------------------------------------------------------

def edit_distance(item, text) -> int:
    row = [0] * (len(text) + 1)
    for a in item:
        new = [row[0] + 1]
        for k, b in enumerate(text):
            new.append(min(row[k] + (a != b), row[k + 1] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_passages_within_the_budget(spark):
    generator = random.Random(3)
    bench = [(k, " ".join("".join(generator.choices("abcdeé", k=generator.randint(1, 7))) for _ in range(generator.choice([2, 12, 40])))) for k in range(12)]
    docs = []
    for k in range(60):
        item = list(generator.choice(bench)[1])
        for _ in range(generator.randint(0, max(1, len(item) // 12))):
            at = generator.randrange(len(item))
            item[at:at + generator.choice([0, 1])] = generator.choice(["x", "", "ab"])
        filler = lambda: " ".join("".join(generator.choices("abcde", k=4)) for _ in range(generator.randint(0, 30)))
        docs.append((k, filler() + " " + "".join(item).upper() + ". " + filler()))
    docs += [(100, None), (101, ""), (102, docs[0][1]), (102, docs[0][1])]
    items = [decontaminate.item_of(*b) for b in bench]
    want = defaultdict(dict)
    for key, text in docs:
        points, _ = decontaminate.Folded().of(text or "") if key % 7 == 0 or key >= 100 else (None, None)
        for item in items if points is not None else ():
            edits = edit_distance(item.points.tolist(), points.tolist())
            if edits <= item.edits:
                want[key][item.key] = edits
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, edits long")
    odd = [(50, None), (51, " .. ")]
    table = spark.createDataFrame(bench + odd, "item_id long, text string")
    for size in (decontaminate.BLOCK_CHARS, 200):
        rows = decontaminate.find(df, table, block_chars=size).collect()
        got = defaultdict(dict)
        for r in rows:
            got[r.doc_id][r.item_id] = r.edits
        for key, text in docs:
            if key % 7 == 0 or key >= 100:
                assert got[key] == want[key]
        for r in rows:
            part = dict(docs)[r.doc_id][r.first_char:r.last_char]
            points, _ = decontaminate.Folded().of(part)
            assert edit_distance(points.tolist(), items[r.item_id].points.tolist()) <= 2 * r.edits + 2
    clean = {r.doc_id for r in decontaminate.keep_clean(df, table).collect()}
    assert clean == {k for k, _ in docs} - {r.doc_id for r in rows}
    assert decontaminate.find(df.limit(0), table).count() == 0 and decontaminate.find(df, table.limit(0)).count() == 0
    assert decontaminate.keep_clean(df, table.limit(0)).count() == len(docs)


def test_long_texts_are_searched_across_blocks(monkeypatch):
    monkeypatch.setattr(decontaminate, "TEXT_BLOCK", 300)
    generator = random.Random(5)
    passage = " ".join("".join(generator.choices("abcdefgh", k=5)) for _ in range(20))
    search = decontaminate.Search([decontaminate.item_of(1, passage)])
    for before in range(0, 700, 37):
        text = "z" * before + " " + passage + " " + "y" * 400
        assert dict(search.text(text))[1] == (0, before + 1, before + 1 + len(passage))


# --- pipeline ---------------------------------------------------------------------------

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "tokens"]
    rows = {r.doc_id: r.text for r in docs.collect()}
    scores = {r.doc_id: r.predicted for r in QUERIES["op3_quality_classifier"].run(spark, SF_DIR).collect()}
    left = [(k, t) for k, t in sorted(rows.items()) if scores[k]]
    by = defaultdict(list)
    for k, t in left:
        by[re.sub("[\x20\x09-\x0d]", "", t)].append((-len(t), k, t))
    left = sorted((min(v)[1], min(v)[2]) for v in by.values())
    least = [eval(x) for x in brute_similar(left, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILAR_PERCENT)]
    left = [(k, t) for k, t in left if (k, k) in {(a, c) for a, _, c in least}]
    leaks = {r.doc_id for r in QUERIES["op6_decontamination"].run(spark, SF_DIR).collect()}
    bench = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert {k for k, t in rows.items() if any(b in t for b in bench)} <= leaks
    want = {k for k, _ in left} - leaks
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers

    from siltworks.llm.bpe import read_ranks

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=read_ranks(public_tokenizers.path(corpus_pipeline.RANKS)))
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(want)
    assert all(np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(rows[r.doc_id]) for r in got)
