"""Operators on single rows: archives, main text, chat, licenses, secrets, byte-level BPE."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import random
import re
import textwrap

import numpy as np
import pytest

from siltworks.llm import bpe, chat, licenses, maintext, secrets, warc
from siltworks.sources.files import arrow_location

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
RANKS = tokenizers.path("byte_bpe_multi_50k.tiktoken")


# --- archives ---------------------------------------------------------------------------

PAGES = [(1, "http://a/b c", "same"), (2, "u", "same"), (3, None, None), (4, "u", ""), (9, "u", "é日本"), (9, "u", "é日本"),
         (5, "u", "WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 0\r\n\r\n\r\n\r\n"), (None, "u", "same"), (6, "u", "x" * 300_000)]


def test_archives_round_trip(spark, scratch):
    path = scratch("warc")
    pages = spark.createDataFrame([(*p, "extra") for p in PAGES], "page_id long, url string, html string, payload string")
    warc.write(pages, path)
    rows = warc.read(spark, path).collect()
    assert not [r for r in rows if r.gap] and len(rows) == len(PAGES)
    digest = {p[0]: base64.b32encode(hashlib.sha1((p[2] or "").encode()).digest()).decode() for p in PAGES}
    texts = {p[0]: (p[2] or "").encode() for p in PAGES}
    for row in rows:
        name = row.record_id[len("<urn:page:"):-1]
        page = None if name == "-" else int(name)
        assert (row.payload_digest, row.payload_bytes) == (digest[page], len(texts[page]))
        assert row.payload == (b"" if row.warc_type == "revisit" else texts[page])
    refers = sorted((r.record_id, r.refers_to) for r in rows if r.warc_type == "revisit")
    assert refers == [("<urn:page:1>", "<urn:page:2>"), ("<urn:page:3>", "<urn:page:4>")]


def test_archives_with_least_bytes(spark, scratch):
    path = scratch("warc")
    warc.write(spark.createDataFrame(PAGES[:4], "page_id long, url string, html string"), path, least_bytes=1)
    assert sorted(r.record_id for r in warc.read(spark, path).where("warc_type = 'revisit'").collect()) == ["<urn:page:1>"]


def test_no_pages_no_records(spark, scratch):
    path = scratch("warc")
    warc.write(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read(spark, path).count() == 0 and warc.read(spark, path + "/absent").count() == 0


def record(number: int, body: bytes = b"hello", length: int | None = None) -> bytes:
    head = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <{number}>\r\nContent-Length: {len(body) if length is None else length}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


@pytest.mark.parametrize("zipped", [False, True])
def test_damage_is_passed_over_and_reported(spark, scratch, zipped):
    pack = gzip.compress if zipped else bytes
    good = [pack(record(k, bytes([65 + k]) * 50)) for k in range(6)]
    bad = [pack(record(9, b"z" * 50))[:-20], good[1][:12] + b"\x00" * 9 + good[1][21:], b"junk" * 10, pack(record(8, b"q", 10**12))]
    data = good[0] + bad[0] + good[2] + bad[1] + good[3] + bad[2] + good[4] + bad[3] + good[5] + good[0][:15]
    filesystem, name = arrow_location(scratch("damaged"))
    filesystem.create_dir(name)
    with filesystem.open_output_stream(f"{name}/a.warc") as out:
        out.write(data)
    rows = warc.read(spark, name).orderBy("first_byte").collect()
    assert [r.record_id for r in rows if not r.gap] == ["<0>", "<2>", "<3>", "<4>", "<5>"]
    gaps = [(r.first_byte, r.end_byte) for r in rows if r.gap]
    want, at = [], 0
    for part, whole in ((good[0], 1), (bad[0], 0), (good[2], 1), (bad[1], 0), (good[3], 1), (bad[2], 0), (good[4], 1), (bad[3], 0),
                        (good[5], 1), (good[0][:15], 0)):
        if not whole:
            want.append((at, at + len(part)))
        at += len(part)
    assert gaps == want and sum(b - a for a, b in gaps) + sum(r.end_byte - r.first_byte for r in rows if not r.gap) == len(data)


def test_changed_payload_fails_its_digest(spark, scratch):
    body = b"HTTP/1.1 200 OK\r\n\r\nhello"
    head = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: %d\r\n\r\n" % (
        base64.b32encode(hashlib.sha1(b"other").digest()), len(body))
    filesystem, name = arrow_location(scratch("changed"))
    filesystem.create_dir(name)
    with filesystem.open_output_stream(f"{name}/a.warc") as out:
        out.write(head + body + b"\r\n\r\n" + record(1))
    rows = warc.read(spark, name).orderBy("first_byte").collect()
    assert [(r.gap, r.record_id) for r in rows] == [("payload digest", None), (None, "<1>")]


def digested(number: int, body: bytes) -> bytes:
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    return record(number, body).replace(b"\r\nContent-Length", f"\r\nWARC-Block-Digest: sha1:{digest}\r\nContent-Length".encode())


def salvaged(data: bytes) -> tuple[list[str], list[str]]:
    """Ids of the records and reasons of the gaps."""
    found = [x for _, _, x in warc.Salvage(io.BytesIO(data), len(data)).read()]
    return [x.headers["warc-record-id"] for x in found if not isinstance(x, str)], [x for x in found if isinstance(x, str)]


@pytest.mark.parametrize("held", [warc.__dict__.get("_HELD", 0), 1000])
def test_members_of_many_records(monkeypatch, held):
    monkeypatch.setattr(warc, "_HELD", held, raising=False)
    noise = random.Random(1)
    parts = [digested(k, noise.randbytes(20_000)) for k in range(20)]
    names = [f"<{k}>" for k in range(20)]
    assert salvaged(gzip.compress(b"".join(parts))) == (names, [])
    damaged = [*parts[:7], parts[7][:-3000], *parts[8:], record(20, b"q", 10**12)]
    assert salvaged(gzip.compress(b"".join(damaged)))[0] == names[:7] + names[8:]
    assert len(salvaged(gzip.compress(b"".join(damaged)))[1]) == 2
    assert salvaged(gzip.compress(parts[0][:-9] + parts[1])) == (["<1>"], ["record end"])
    whole = gzip.compress(b"".join(parts))
    assert salvaged(whole[:len(whole) // 2]) == (names[:9], ["truncated"])
    broken = whole[:len(whole) // 2] + bytes(200) + whole[len(whole) // 2 + 200:]
    ids, gaps = salvaged(broken + gzip.compress(record(30)))
    assert ids[:9] == names[:9] and ids[-1] == "<30>" and gaps


def test_records_and_not_members_have_a_bound(monkeypatch):
    monkeypatch.setattr(warc, "MAX_RECORD", 5000)
    data = gzip.compress(b"".join(record(k, b"x" * 4000) for k in range(5)))
    assert salvaged(data) == ([f"<{k}>" for k in range(5)], [])


def test_damaged_records_without_digest_are_not_believed():
    packed = gzip.compress(record(1, b"y" * 3000) + digested(2, b"z" * 3000), 0)
    at = packed.index(b"yyy")
    assert salvaged(packed[:at] + b"x" + packed[at + 1:]) == (["<2>"], ["gzip member"])


def test_addresses_of_any_length(spark, scratch):
    path = scratch("warc")
    pages = [(1, "data:," + "x" * 70_000, "same"), (2, "data:," + "y" * 3_000_000, "same"), (3, "u", "other")]
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string"), path)
    rows = warc.read(spark, path).collect()
    assert sorted((r.gap, r.target_uri) for r in rows) == sorted((None, url) for _, url, _ in pages)
    assert salvaged(b"WARC/1.0\r\nA: b\r\n" * 20_000 + record(1)) == (["<1>"], ["header field"])


# --- main text --------------------------------------------------------------------------

PAGE = """<html><body class="has-sidebar"><header class="site"><h1>Site</h1></header><div id="cookie-notice">We use cookies</div>
<nav><a href=/>Home</a></nav><div class="wrap page-{n}"><main><article class="post-{n}"><header><h1>Title &amp; {n}</h1>
<span>by Bob</span></header><p>One  <i>two</i>th<br>ree {n}<p>Four <a href=x>link</a> text<ul><li>item 1<li>item 2</ul>
<div class="ad-slot">Buy</div><form><input>Send</form><!-- <p>no</p> --></article><section class="comments"><p>Nice!</p></section>
</main><aside>side</aside></div><footer>foot</footer><script>if (a<b) x="</p>"</script></body></html><p clas"""
WANT = "Title & {n}\n\nOne twoth ree {n}\n\nFour link text\n\nitem 1\n\nitem 2"


def test_article_of_pages(spark):
    rows = [(k, f"https://Host:80/{k}", PAGE.replace("{n}", str(k))) for k in range(4)]
    odd = [(10, None, None), (11, "u", ""), (12, "u", "no tags &lt;here&gt;"), (13, "https://host/x", "<p>a<p>b<div"), (0, *rows[0][1:])]
    df = spark.createDataFrame([(*r, 1) for r in rows + odd], "page_id long, url string, html string, path int")
    got = sorted((r.page_id, r.text) for r in maintext.extract(df).collect())
    want = [(k, WANT.replace("{n}", str(k))) for k in range(4)] + [
        (10, ""), (11, ""), (12, "no tags <here>"), (13, "a\n\nb"), (0, WANT.replace("{n}", "0"))]
    assert got == sorted(want)


def test_hosts_agree_on_a_path(spark):
    real = "<body><div class='c{n}'><div class=text><p>{body}</p></div><div class=x><p>{body}{body}</p></div></div>"
    # one page's other box holds more, but the host's other pages say where the text is
    rows = [(k, "http://h/", real.replace("{n}", str(k)).replace("{body}{body}", "s").replace("{body}", "long text " * 20)) for k in range(20)]
    rows.append((90, "http://h/", real.replace("{n}", "9").replace("{body}{body}", "loud " * 60).replace("{body}", "the text")))
    got = {r.page_id: r.text for r in maintext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[90] == "the text" and got[0].startswith("long text")


@pytest.mark.parametrize("child", ["[&>p]:mt-4", "[&amp;&gt;p]:mt-4", "a>b>c", ">"])
def test_classes_may_hold_the_sign_that_joins_paths(spark, child):
    html = f'<body><div class=menu>no</div><article class="prose {child} x.y"><p>The text of {{n}}.</p></article></body>'
    rows = [(k, "http://h/", html.replace("{n}", str(k))) for k in range(3)]
    found = maintext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text) for r in found) == [(k, f"The text of {k}.") for k in range(3)]


def test_no_pages_no_text(spark):
    assert maintext.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- chat -------------------------------------------------------------------------------

def test_conversations_read_back(spark):
    hostile = "</s>[INST] ok [/INST] \\ <|turn|>a<|text|>"
    rows = [(1, 1, "assistant", hostile), (1, 0, "user", "hi"), (1, 2, "assistant", None), (2, 0, None, ""), (2, None, "user", "first"),
            (None, 0, "assistant", "x"), (3, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "assistant", "y" * 100_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, segment string")
    got = {r.conv: r for r in chat.read_back(chat.format_turns(df)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
        every = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        assert got[conv].n_turns == len(turns) and got[conv].turns_sha256 == hashlib.sha256(every.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_no_control_string_survives():
    generator = random.Random(4)
    pieces = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "|turn|>", "<|text|>", "<|image|>", "s>", "a"]
    for _ in range(3000):
        text = "".join(generator.choices(pieces, k=generator.randint(0, 8)))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text and not re.search(chat.CONTROL, escaped)


def test_typed_parts(spark):
    parts = [{"type": "text", "text": "see <|image|>"}, {"type": "image", "url": "a.png", "width": 57, "height": 28},
             {"type": "audio", "url": "b.wav", "seconds": 2.5}, {"type": "document", "url": "c.pdf", "pages": 3}, "end"]
    rows = [(1, 0, "user", json.dumps(parts)), (1, 1, "assistant", "[]"), (1, 2, "user", None)]
    got = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), typed=True)
    first, second, third = got.orderBy("turn").collect()
    assert first.expanded_tokens == 3 + 63 + 3 * 512
    assert [(a.kind, a.reference, a.tokens) for a in first.attachments] == [("image", "a.png", 3), ("audio", "b.wav", 63), ("document", "c.pdf", 1536)]
    assert all(first.segment.startswith(f"<|{a.kind}|>", a.offset) for a in first.attachments)
    assert first.segment.count("<|image|>") == 1 and first.loss_first is None
    assert second.loss_first == second.loss_end and third.segment == "<|turn|>user<|text|></s>"
    with pytest.raises(ValueError):
        chat.Flatten().visit({"type": "smell"})


# --- licenses ---------------------------------------------------------------------------

def test_license_join_finds_all_blocks(spark):
    generator = random.Random(3)
    words = "licensed under the apache license version gnu general public mit released work this is free cc by nc 4 0 2 and any zzz".split()
    texts = ["\n".join(" ".join(generator.choices(words, k=generator.randint(0, 14))) for _ in range(generator.randint(0, 6))) for _ in range(300)]
    texts += [None, "", "É Licensed under the APACHE License, Version 2.0.\nX", "gnu\ngeneral public license", "mit license " * 5000]
    rows = [(k, t, 1.0) for k, t in enumerate(texts)] + [(2, texts[2], 1.0)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, score double")).collect()
    assert len(got) == len(rows)
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = [(label, set(split.findall(t.translate(lower)))) for label, t in licenses.TEMPLATES]
    for row in got:
        text = (texts[row.doc_id] or "").translate(lower)
        tokens = split.findall(text)
        places = [(k, label) for phrase, label in licenses.PHRASES for k in range(len(tokens)) if tokens[k:k + len(phrase.split())] == phrase.split()]
        held = [(label, len(s & set(split.findall(line))) / len(s)) for line in text.split("\n") for label, s in sets]
        held = [(label, c) for label, c in held if c >= 0.8]
        assert (row.n_words, row.n_base) == (len(tokens), len(places))
        assert (row.first_word, row.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert row.base_labels == ",".join(sorted({x for _, x in places}))
        assert row.labels == ",".join(sorted({x for _, x in places} | {x for x, _ in held}))
        assert row.score == (1.0 if places else max((c for _, c in held), default=0.0))
        assert len(row.blocks) == len(held)
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("mark", ["", " * ", "// ", "REM "])
@pytest.mark.parametrize("width", [30, 60, 80])
def test_wrapped_notices_are_found(spark, mark, width):
    templates = [(k, label, text) for k, (label, text) in enumerate(licenses.TEMPLATES) if len(text) > 50]
    around = [f"{mark}Copyright 2020 by us.", mark.rstrip()]
    texts = ["\n".join(["/*", *around, *(mark + line for line in textwrap.wrap(text, width)), mark.rstrip(), "int x;"]) for _, _, text in templates]
    # the same words on many lines, but not as a notice
    texts += ["\n".join(f"{w} and so on with other things" for w in text.split()) for _, _, text in templates]
    texts += ["\n".join(reversed(text.split())) for _, _, text in templates]
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    for (number, label, _), row in zip(templates, rows):
        assert label in row.labels.split(",") and row.score == 1.0
        assert [b.line for b in row.blocks if b.template == number][-1] == 3
    assert not [b for row in rows[len(templates):] for b in row.blocks]


# --- secrets ----------------------------------------------------------------------------

def brute_shapes(text: str) -> list[tuple[int, int, str]]:
    found = []
    kinds = (("assign", r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 8),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32))
    for order, (kind, pattern, holds) in enumerate(kinds):
        found += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if holds(m)]
    return [x for _, _, x in sorted(found)]


def test_shapes_are_all_found(spark):
    generator = random.Random(5)
    bits = ["password", "Token", "api_key", "apikey", "SECRET", "ſecret", "=", ":", " ", '"', "AKIA", "ABCDEFGH12", "abc", "0f" * 9, "é", "\n", "abcdefgh"]
    texts = ["".join(generator.choices(bits, k=generator.randint(0, 14))) for _ in range(2000)] + [None, "", "a" * 200_000, "0" * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)) + [(0, texts[0])], "doc_id long, text string")
    rows = secrets.scan(df.selectExpr("*", "1 AS spans")).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        base = brute_shapes(texts[row.doc_id] or "")
        assert row.base_spans == ",".join(base) and set(base) <= set(row.spans.split(",")) | {""}
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(b.startswith(k) for b in base) for k in ("assign", "access", "hex")]
    assert secrets.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("text, literals", [
    ('a = "s3cr3tV4lue99"\nb = a\nDB_PASSWORD = b', ["s3cr3tV4lue99"]), ('{"clientSecret": "AbCd1234EfGh"}', ["AbCd1234EfGh"]),
    ("export AWS_SECRET_ACCESS_KEY=wJalrXUtnFEMIK7MDENG", ["wJalrXUtnFEMIK7MDENG"]), ("<token>abcDEF123456</token>", ["abcDEF123456"]),
    ('auth_token := "abc" + "DEF12345x"', ["abc", "DEF12345x"]), ("password: changeme", []), ('secret_name = "foo bar baz"', []),
    ('color = "s3cr3tV4lue99"', []), ("", []), ("password = ", []), ("a = b\nb = a\npassword = a", [])])
def test_literals_reach_sensitive_names(text, literals):
    assert [text[s.start:s.end] for s in secrets.named(text)] == literals


@pytest.mark.parametrize("text, literals", [
    ("passphrase: correcthorsebatterystaple", ["correcthorsebatterystaple"]), ("pwd=SuperSecretLetters", ["SuperSecretLetters"]),
    ("private_key=abcdefghijklmnop.", ["abcdefghijklmnop"]), ('DB_PASS_V2 = "s3cr3tV4lue99"\npassword = DB_PASS_V2', ["s3cr3tV4lue99"]),
    ('a1 = "s3cr3tV4lue99"\nb-2 = a1\npassword: b-2', ["s3cr3tV4lue99"]), ('plain_V2 = "no"\npassword = plain_V2', [])])
def test_values_without_quotes_are_names_or_literals(text, literals):
    assert [text[s.start:s.end] for s in secrets.named(text)] == literals


# --- byte-level BPE ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(RANKS))


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def ids_of(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


def test_ids_are_the_library_s(encoder, library):
    generator = random.Random(6)
    letters = "ab'sTtrevmlld  \n\t\r 　éßж漢字한글ไทย\U0001f600́٣½१'’\U00010ee7"
    texts = ["".join(generator.choices(letters, k=generator.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(chr(generator.choice([generator.randint(32, 0x2FF), generator.randint(0x300, 0xD7FF), generator.randint(0xE000, 0x2FFFF)]))
                      for _ in range(generator.randint(0, 20))) for _ in range(4000)]
    texts += ["ab" * 60_000, "x" * 3000, " " * 1000 + "a", "thtion" * 500]
    for text in texts:
        assert ids_of(encoder.encode(text)) == library.encode_ordinary(text)


def test_states_are_dropped_and_remade(library):
    small = bpe.Encoder(bpe.read_ranks(RANKS), max_pieces=20)
    small.machine.max_states = 50
    generator = random.Random(7)
    for _ in range(300):
        text = " ".join("".join(generator.choices("thionersa", k=generator.randint(1, 90))) for _ in range(5))
        assert ids_of(small.encode(text)) == library.encode_ordinary(text)
    assert len(small.machine.states) <= 200


def test_moves_that_are_seldom_met_make_no_states(library):
    machine, generator = bpe.Transducer(bpe.read_ranks(RANKS)), random.Random(11)
    pieces = {"".join(generator.choices("thionersa", k=generator.randint(2, 20))) for _ in range(20)}
    for _ in range(3):
        assert [machine.encode(p.encode()) for p in sorted(pieces)] == [library.encode_ordinary(p) for p in sorted(pieces)]
    assert len(machine.states) == 1 and not machine.moves


def test_any_ranks_give_what_plain_merging_gives():
    """Also ranks in which a token comes before its parts, and tokens that merging never makes."""
    generator = random.Random(8)
    for _ in range(40):
        tokens = {bytes([b]) for b in range(256)}
        alphabet = [b"a", b"b", b"c"]
        while len(tokens) < 256 + 25:
            tokens.add(generator.choice([t for t in tokens if set(t) <= set(b"abc")]) + generator.choice(alphabet + [t for t in tokens if set(t) <= set(b"abc")]))
        order = sorted(tokens - {bytes([b]) for b in range(256)})
        generator.shuffle(order)
        ranks = {bytes([b]): b for b in range(256)} | {t: 256 + k for k, t in enumerate(order)}
        machine = bpe.Transducer(ranks)
        for _ in range(60):
            text = bytes(generator.choices(b"abc", k=generator.randint(1, 14)))
            want = [ranks[text]] if text in ranks else [ranks[p] for p in machine._merge(text)]
            assert machine.encode(text) == want and machine.encode(text) == want


def test_long_texts_are_cut_where_pieces_end(library):
    generator = random.Random(9)
    for _ in range(200):
        text = "".join(generator.choices(["a", " b", "  ", "\n", "'s", " 12", ".", " é", "　x"], k=60))
        parts = list(bpe.blocks(text, 10))
        assert "".join(parts) == text
        assert [i for p in parts for i in library.encode_ordinary(p)] == library.encode_ordinary(text)


def test_characters_split_between_blocks():
    data = "aé漢\U0001f600�".encode()
    for cut in range(len(data) + 1):
        for later in range(cut, len(data) + 1):
            stream = bpe.Utf8Stream()
            assert stream.feed(data[:cut]) + stream.feed(data[cut:later]) + stream.feed(data[later:]) + stream.feed(b"", True) == data.decode()
    stream = bpe.Utf8Stream()
    assert stream.feed(b"\xe6\xbc") + stream.feed(b"", True) == "�"


def test_round_trip_in_spark(spark):
    texts = ["hello  world's", None, "", "漢字 é\U0001f600", "a" * 50_000, "hello  world's"]
    df = spark.createDataFrame([(k % 5, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, ids string")
    encoded = bpe.encode(df, RANKS)
    decoded = bpe.decode(encoded, RANKS, keep=("n_tokens",))
    assert sorted((r.doc_id, r.text) for r in decoded.collect()) == sorted((k % 5, t or "") for k, t in enumerate(texts))
    assert bpe.encode(df.limit(0), RANKS).count() == 0
