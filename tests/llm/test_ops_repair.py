"""Token-id files: the grammar's round trip, random access, and ids against the tokenizer library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltworks.llm import repair
from siltworks.llm.queries import QUERIES

from ..oracle import SF_DIR

PATH = public_tokenizers.path("word_bpe_49k.json")

ODD = ["", " ", "a", "DON'T we'll it's 'TIS rock'n'roll", "été Å H̱ ẖ", "İstanbul İ", "ΣΑΣ σας", "K elvin",
       "a\x1cb\x1dc \x85d\xa0e f　g\x0bh", "<|endoftext|>x <|startoftext|>", "x" * 70_000, "日本語テキスト 가가",
       "naïve ÉCOLE ß×÷ÿ, À!? ()[] 12ab34 a1", "tab\tnew\nline\r\n end.  ", "ﬁ ǅ ẞ", "\U0001d4d0 \U0001f600\U0001f600!",
       "word,word;word' word'", "***!!! '''s 's", "́alone", "plain. plain, plain plain' Plain."]


def test_runs_give_the_ids_of_whole_texts():
    library, encoder = Tokenizer.from_file(PATH), repair.Encoder(PATH)
    assert encoder.splits
    rng = random.Random(5)
    letters = "abcXYZ '’.,!?-1éÉß×́İΣ\x1c\x85\xa0\n\t日<|>"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_the_table_of_runs_may_be_small(monkeypatch):
    monkeypatch.setattr(repair, "KEPT", 3)
    library, encoder = Tokenizer.from_file(PATH), repair.Encoder(PATH)
    text = "one two, three four. five one two, six seven eight one"
    for _ in range(3):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.new) <= 3 and len(encoder.old) <= 3


def test_words_met_before_are_found_at_once_whatever_signs_follow():
    class Counted(dict):
        missed = 0

        def get(self, key):
            found = super().get(key)
            self.missed += found is None
            return found

    library, encoder = Tokenizer.from_file(PATH), repair.Encoder(PATH)
    encoder.ids("alpha été b2 , . ). \"")
    encoder.new = Counted(encoder.new)
    for text in ("alpha, été. B2).", "Alpha). b2\"\nété,\talpha."):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert encoder.new.missed == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), min_size=1, max_size=80), min_size=1, max_size=12), st.integers(2, 4))
def test_round_trip(documents, least):
    ids = [np.array(d, np.uint32) for d in documents]
    shard = repair.Shard(repair.pack(list(range(len(ids))), ids, least))
    whole = [x for d in documents for x in d]
    assert [shard.document(k).tolist() for k in range(len(ids))] == documents
    for start in range(0, len(whole) + 1, 7):
        for stop in range(start, len(whole) + 3, 11):
            assert shard.ids(start, stop).tolist() == whole[start:stop]


def test_repetition_is_compressed():
    rng = np.random.default_rng(1)
    phrase = rng.integers(0, 49_000, 50).astype(np.uint32)
    noise = rng.integers(0, 49_000, 500).astype(np.uint32)
    data = repair.pack([1, None], [np.tile(phrase, 2000), noise])
    assert len(data) < 20_000
    shard = repair.Shard(data)
    assert shard.keys == [1, None] and shard.document(0).tolist() == np.tile(phrase, 2000).tolist() and shard.document(1).tolist() == noise.tolist()
    assert shard.grammar.lengths.max() >= 400
    same = np.full(10_001, 7, np.uint32)
    packed = repair.pack([1], [same])
    assert repair.Shard(packed).document(0).tolist() == same.tolist() and len(packed) < 500


def test_damage_is_seen():
    data = bytearray(repair.pack([1, 2], [np.arange(9, dtype=np.uint32), np.arange(3, dtype=np.uint32)]))
    for place in (0, 20, len(data) // 2, len(data) - 1):
        bad = bytearray(data)
        bad[place] ^= 1
        with pytest.raises(ValueError):
            repair.Shard(bytes(bad))


def _expected(rows):
    library = Tokenizer.from_file(PATH)
    start, out = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("shard_ids", [1, 40, repair.SHARD_IDS])
def test_files(spark, scratch, shard_ids):
    rng = random.Random(3)
    rows = [(rng.randint(-500, 500) * 3, " ".join(rng.choices(ODD, k=3))) for _ in range(120)]
    rows += [(None, "nobody"), (None, None), (7, None), (8, ""), (8, ""), (8, "same id"), (9, "long text " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for name in ("key", "ids", "part", "seq", "path", "first", "start", "n_tokens"):
        df = df.withColumn(name, F.lit("mine"))
    files = repair.write(df, scratch("ids"), PATH, shard_ids=shard_ids)
    found = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in repair.read(files).collect()]
    assert sorted(found, key=lambda r: r[1]) == _expected(rows)
    listed = files.collect()
    assert sum(f.n_docs for f in listed) == len(rows)
    assert sorted(f.first for f in listed)[0] == 0 and (shard_ids > 40 or len(listed) > 60)


def test_a_range_of_the_corpus(spark, scratch):
    rows = [(k, "some words that come again and again " * (k % 5)) for k in range(60)]
    files = repair.write(spark.createDataFrame(rows, "doc_id long, text string"), scratch("ids"), PATH, shard_ids=100)
    library = Tokenizer.from_file(PATH)
    whole = [i for _, text in rows for i in library.encode(text, add_special_tokens=False).ids + [2]]
    for start, stop in ((0, 5), (37, 291), (100, 100), (len(whole) - 3, len(whole) + 9)):
        parts = sorted((r.start, r.ids) for r in repair.read_range(files, start, stop).collect())
        assert [i for _, ids in parts for i in np.frombuffer(ids, "<u4").tolist()] == whole[start:stop]


def test_no_rows(spark, scratch):
    files = repair.write(spark.createDataFrame([], "doc_id long, text string"), scratch("ids"), PATH)
    assert files.count() == 0 and repair.read(files).count() == 0


def test_a_task_that_ran_twice_leaves_files_that_do_not_count(spark, scratch):
    folder = scratch("ids")
    df = spark.createDataFrame([(k, f"text {k}") for k in range(30)], "doc_id long, text string")
    first = repair.write(df, folder, PATH)
    again = repair.write(df, folder, PATH)
    assert repair.read(first).count() == repair.read(again).count() == 30


def test_query_on_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = QUERIES["op12_repair_ids"].run(spark, SF_DIR).orderBy("start").collect()
    assert [tuple(r) for r in rows] == _expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
