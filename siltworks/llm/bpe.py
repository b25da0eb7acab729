"""Byte-level BPE as a finite-state transducer that is determinised while it runs.

Method. A token sequence is what merging by rank yields exactly when every two neighbours are
what merging yields for their joined bytes. So a nondeterministic transducer can guess tokens
while reading bytes: each guess walks the trie of the vocabulary, and may end a token where the
neighbour test against the guess's last token holds. Every prefix has one complete guess.
Determinisation keeps the set of live guesses with the tokens on which they do not yet agree, and
emits a token as soon as all agree: a guess lives no longer than the longest token, which bounds
the lookahead. Transitions and their states are made when met often, and dropped together when
they exceed a fixed number; until then the guesses of a short piece are followed one at a time.
Encodings of whole pieces are remembered in the same bounded way. What a worker process has learnt
serves its later tasks: these bounds, and not the end of a task, drop it.

Decoding joins token bytes and feeds them through an incremental UTF-8 state machine, so that a
character split between tokens or blocks is put together again.

Defined cases: null text counts as empty and has no ids; every row gives one row, repeated rows
too; an empty table gives an empty table; further columns are ignored; a text of any length is
encoded whole, with memory for its ids and one block of its characters.
"""

from __future__ import annotations

import base64
import gc
import re
import struct
from bisect import bisect_left
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import bounded_batches
from .common import Sink, give_back, per_process, rows_of, whole_text

MAX_STATES = 60_000
MAX_PIECES = 200_000
#: A piece of up to ONCE bytes makes a move a state only when OFTEN others have met it.
ONCE = 64
OFTEN = 64
_BLOCK = 1 << 18

# Code points that the `regex` module (Unicode 17) counts as letters or numbers
# while the tokenizer library (Unicode 16 or older) does not.
NEWER_LETTERS = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD),
    (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959),
    (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB),
    (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3),
    (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96),
    (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5),
    (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F),
    (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
NEWER_NUMBERS = [(0x11DE0, 0x11DE9), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686),
                 (0x16FF4, 0x16FF6)]

_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def character_classes() -> np.ndarray:
    """For each code point whether the tokenizer's pattern takes it for a letter, number, space or other."""
    import regex

    table = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [c if not 0xD800 <= c < 0xE000 else 0xE000 for c in range(0x110000)]))
    for cls, pattern, newer in ((_LETTER, r"\p{L}+", NEWER_LETTERS), (_NUMBER, r"\p{N}+", NEWER_NUMBERS),
                                (_SPACE, r"\s+", [])):
        for match in regex.finditer(pattern, every):
            table[match.start():match.end()] = cls
        for first, last in newer:
            table[first:last + 1] = _OTHER
    return table


class Splitter:
    """Cuts text into the pieces of ``public_tokenizers.PATTERN`` with the tokenizer's character classes.

    ``re`` gets the classes as ranges, because it tests them faster than properties. The branches
    for words come first; as they can't match at an apostrophe, that changes no result. Texts with
    characters beyond the basic plane use a second pattern, so that the first has few ranges.
    """

    BRANCHES = " ?[{L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"

    def __init__(self):
        classes = character_classes()
        self.basic = self._pattern(classes[:0x10000])
        self.whole = self._pattern(classes)
        self.beyond = re.compile("[\U00010000-\U0010ffff]")

    def _pattern(self, classes: np.ndarray) -> re.Pattern:
        ranges = {}
        starts = np.flatnonzero(np.concatenate(([True], classes[1:] != classes[:-1])))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(classes)]):
            ranges.setdefault(int(classes[a]), []).append(f"\\U{a:08x}-\\U{b - 1:08x}")
        return re.compile(self.BRANCHES.format(**{name: "".join(ranges[cls]) for name, cls in (
            ("L", _LETTER), ("N", _NUMBER), ("S", _SPACE))}))

    def pieces(self, text: str) -> list[str]:
        pattern = self.basic if text.isascii() or not self.beyond.search(text) else self.whole
        return pattern.findall(text)


def blocks(text: str, size: int = _BLOCK) -> Iterator[str]:
    """Parts of a long text that can be split into pieces apart: each but the first begins with a
    letter's or digit's blank that no white space precedes."""
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        while cut > 0 and not (cut + 1 < len(text) and text[cut + 1].isascii() and text[cut + 1].isalnum()
                               and not text[cut - 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


class Transducer:
    """Bytes of one piece to token ids; see the module's text."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.arcs: dict[int, int] = {}
        self.token_at: list[int] = [-1]
        self.inner: list[bool] = [False]
        self.made: dict[bytes, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.plain = True
        for token, rank in ranks.items():
            merged = self._merge(token, rank)
            if len(merged) != 2 and len(token) > 1:
                continue  # merging never makes it; only a whole piece can be this token
            if len(token) > 1:
                self.parts[rank] = (ranks[merged[0]], ranks[merged[1]])
                self.plain &= max(self.parts[rank]) < rank
            self._insert(token, rank)
            self.made[token] = rank
        self.pairs: dict[int, bool] = {}
        self.ends: dict[int, list[tuple[bytes, int]]] = {}
        self.begins: dict[int, list[tuple[bytes, int]]] = {}
        self.met: dict[int, int] = {}
        self.alike = self._contexts() if self.plain else {rank: rank for rank in self.bytes_of}
        self._reset()

    def _insert(self, token: bytes, rank: int) -> None:
        node = 0
        for byte in token:
            self.inner[node] = True
            key = node << 8 | byte
            node = self.arcs.get(key, 0)
            if not node:
                node = self.arcs[key] = len(self.token_at)
                self.token_at.append(-1)
                self.inner.append(False)
        self.token_at[node] = rank

    def _merge(self, text: bytes, below: int | None = None) -> list[bytes]:
        """Plain merging: the lowest rank first, the leftmost of equals; used to build and test."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            usable = [x for x in ranked if x[0] is not None and (below is None or x[0] != below or len(parts) > 2)]
            if below is not None and len(parts) == 2 or not usable:
                break
            _, i = min(usable)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def neighbours(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens gives these two tokens."""
        key = left << 20 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > 300_000:
                self.pairs.clear()
            known = self.pairs[key] = self._apart(left, right) if self.plain else [
                self.ranks[x] for x in self._merge(self.bytes_of[left] + self.bytes_of[right])] == [left, right]
        return known

    def _apart(self, left: int, right: int) -> bool:
        """No merge across the boundary comes before both sides have merged on.

        The piece at the boundary's left is first a byte, then ever larger ends of ``left``; each
        lasts until the rank of the next. So on the right. A merge across happens at its rank if
        both pieces last until then; of equal ranks the leftmost goes first.
        """
        ranks, begins = self.ranks, self.begins.get(right)
        if begins is None:
            begins = self.begins[right] = self._spine(right, 0)
        ends = self.ends.get(left)
        if ends is None:
            ends = self.ends[left] = self._spine(left, 1)
        for end, until_left in ends:
            for begin, until_right in begins:
                across = ranks.get(end + begin)
                if across is not None and across < until_left and across <= until_right:
                    return False
        return True

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """A token's ends (side 1) or beginnings (0) that any longer token can hold beyond them, and
        until which rank each lasts."""
        out, until = [], 1 << 62
        while True:
            piece = self.bytes_of[token]
            if side == 0 or self.inner[self._node(piece)]:
                out.append((piece, until))
            if token not in self.parts:
                return out
            until, token = token, self.parts[token][side]

    def _node(self, piece: bytes) -> int:
        node = 0
        for byte in piece:
            node = self.arcs[node << 8 | byte]
        return node

    def _contexts(self) -> dict[int, int]:
        """For each token the first one that every right neighbour meets in the same way.

        A neighbour meets the ends of a token, each until its rank of merging on. An end counts only
        by those longer tokens that begin with it and come before that rank.
        """
        longer: dict[bytes, list[int]] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                if token[:cut] in self.ranks and token[cut:] in self.ranks:
                    longer.setdefault(token[:cut], []).append(rank)
        for ranks in longer.values():
            ranks.sort()
        first: dict[tuple, int] = {}
        alike = {}
        for rank in sorted(self.bytes_of):
            meets, end, until = [], rank, None
            while True:
                ranks = longer.get(self.bytes_of[end], [])
                count = len(ranks) if until is None else bisect_left(ranks, until)
                if count:
                    meets.append((end, count))
                if end not in self.parts:
                    break
                until, end = end, self.parts[end][1]
            alike[rank] = first.setdefault(tuple(meets), rank)
        return alike

    def _reset(self) -> None:
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.states: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.met.clear()
        self._state(((0, (-1,)),))

    def _state(self, guesses: tuple) -> int:
        found = self.number.get(guesses)
        if found is None:
            found = self.number[guesses] = len(self.states)
            self.states.append(guesses)
        return found

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state after one more byte and what it emits. Guesses stay ordered by their start."""
        arcs, tokens, inner, pairs = self.arcs, self.token_at, self.inner, self.pairs
        guesses, complete = [], None
        for guess in self.states[state]:
            node, chain = guess
            child = arcs.get(node << 8 | byte)
            if child is None:
                continue
            if inner[child]:
                guesses.append((child, chain))
            token = tokens[child]
            if token >= 0 and complete is None:
                before = chain[-1]
                apart = True if before < 0 else pairs.get(before << 20 | token)
                if apart is None:
                    apart = self.neighbours(before, token)
                if apart:
                    complete = (0, chain + (token,))
        guesses.append(complete)
        emitted, agreed = (), 1
        first = guesses[0][1]
        if len(first) > 1:
            while len(first) > agreed and all(len(c) > agreed and c[agreed] == first[agreed] for _, c in guesses):
                agreed += 1
        if agreed > 1:
            emitted = first[1:agreed]
            context = (self.alike[first[agreed - 1]],)
            guesses = [(node, context + chain[agreed:]) for node, chain in guesses]
        guesses = tuple(guesses)
        number = self.number.get(guesses)
        if number is None:
            number = self._state(guesses)
        found = self.moves[state << 8 | byte] = (number, emitted)
        return found

    def _searched(self, piece: bytes) -> list[int]:
        """The tokens of a short piece, by the same guesses without making states of them.

        Guesses are followed one at a time, the longest token first. A prefix has one complete guess, so
        a place from which none leads on is not tried again.
        """
        made, pairs, end, dead = self.made, self.pairs, len(piece), set()
        place, size, before, chain, behind = 0, end, -1, [], []
        while True:
            while size:
                token = made.get(piece[place:place + size])
                if token is not None and place + size not in dead:
                    apart = True if before < 0 else pairs.get(before << 20 | token)
                    if apart is None:
                        apart = self.neighbours(before, token)
                    if apart:
                        chain.append(token)
                        if place + size == end:
                            return chain
                        behind.append((place, size - 1, before))
                        place, before = place + size, token
                        size = end - place
                        continue
                size -= 1
            dead.add(place)
            place, size, before = behind.pop()
            chain.pop()

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > self.max_states or len(self.met) > 3 * self.max_states:
            self._reset()
        state, out, moves = 0, [], self.moves
        for at, byte in enumerate(piece):
            move = moves.get(state << 8 | byte)
            if move is None:
                key = state << 8 | byte
                times = self.met.get(key, 0)
                if times < OFTEN and len(piece) <= ONCE:
                    self.met[key] = times + 1
                    return self._searched(piece)
                move = self._move(state, byte)
                if len(self.states) > self.max_states * 2:  # one long piece alone
                    kept = self.states[move[0]]
                    self._reset()
                    moves = self.moves
                    move = (self._state(kept), move[1])
            state, emitted = move
            if emitted:
                out.extend(emitted)
        for node, chain in self.states[state]:
            if node == 0:  # the one complete guess
                out.extend(chain[1:])
                break
        return out


class Encoder:
    """Texts to packed ids: little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], max_pieces: int = MAX_PIECES):
        self.machine, self.splitter, self.max_pieces = Transducer(ranks), Splitter(), max_pieces
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            ids = self.machine.encode(piece.encode("utf-8", "replace"))
            packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self.young) >= self.max_pieces:
                self.old, self.young = self.young, {}
            self.young[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        out = []
        for block in blocks(text):
            pieces = self.splitter.pieces(block)
            packed = list(map(self.young.get, pieces))
            if None in packed:
                packed = [x if x is not None else self.young.get(p) or self._piece(p)
                          for x, p in zip(packed, pieces)]
            out.append(b"".join(packed))
        return b"".join(out)


class Utf8Stream:
    """Characters from bytes that come in blocks.

    The state is how many bytes of a begun character have come. A block's last bytes move the
    state; what they complete is decoded and what they leave open waits. Bytes that no character
    can have become U+FFFD.
    """

    def __init__(self):
        self.open = b""

    def feed(self, block: bytes, last: bool = False) -> str:
        block = self.open + block
        end = len(block)
        if not last:
            for back in range(1, min(3, end) + 1):
                lead = block[end - back]
                if lead >= 0xC0:
                    needs = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                    end -= back if needs > back else 0
                    break
                if lead < 0x80:
                    break
        self.open = block[end:]
        return block[:end].decode("utf-8", "replace")


def _encoder(path: str) -> Encoder:
    """One encoder a worker process: its vocabulary serves later tasks."""
    def make() -> Encoder:
        encoder = Encoder(read_ranks(path))
        gc.freeze()  # the vocabulary stays, so the collector need not look at it again
        return encoder

    return per_process(("bpe", path), make)


def _token_bytes(path: str) -> dict[int, bytes]:
    return per_process(("bpe-tokens", path), lambda: {rank: token for token, rank in read_ranks(path).items()})


def encode(df: DataFrame, ranks_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``<id>, n_tokens, ids``: the packed ids of every whole text."""
    bounded_batches(df.sparkSession)
    schema = pa.schema([("row_key", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        encoder, sink = _encoder(ranks_path), Sink(schema)
        for key, text in rows_of(batches):
            packed = encoder.encode(text)
            if sink.add((key, len(packed) // 4, packed), len(packed)):
                yield sink.flush()
        yield sink.flush()
        give_back("bpe", "bpe-tokens")

    rows = df.select(F.col(id_column).cast("bigint").alias("row_key"), whole_text(text_column).alias("body"))
    return rows.mapInArrow(run, "row_key bigint, n_tokens bigint, ids binary").withColumnRenamed("row_key", id_column)


def decode(df: DataFrame, ranks_path: str, id_column: str = "doc_id", ids_column: str = "ids",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """``<id>, text`` and the columns in ``keep``: the characters of packed ids."""
    kept = df.select(*keep).schema
    types = [pa.field("row_key", pa.int64()), pa.field("text", pa.string())]
    schema = pa.schema(types + [pa.field(f.name, to_arrow_type(f.dataType)) for f in kept])

    def run(batches):
        token_bytes, sink = _token_bytes(ranks_path), Sink(schema)
        for key, packed, *rest in rows_of(batches):
            ids, stream, parts = np.frombuffer(packed or b"", "<u4"), Utf8Stream(), []
            for start in range(0, len(ids), 65536):
                parts.append(stream.feed(b"".join(map(token_bytes.__getitem__, ids[start:start + 65536].tolist()))))
            parts.append(stream.feed(b"", last=True))
            text = "".join(parts)
            if sink.add((key, text, *rest), len(text) + 64):
                yield sink.flush()
        yield sink.flush()
        pa.default_memory_pool().release_unused()

    rows = df.select(F.col(id_column).cast("bigint").alias("row_key"), F.col(ids_column).alias("packed"), *keep)
    names = "row_key bigint, text string" + "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(run, names).withColumnRenamed("row_key", id_column)
