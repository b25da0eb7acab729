"""Documents joined by the Jaccard similarity of their word n-grams, with several global token orders.

Method. A document's tokens are the hashes of its distinct word n-grams. In any global order of the
tokens, two sets that are similar enough share a token among the first of each (their prefixes).
The first order puts rare tokens first: a table of counts over all documents, of fixed size, gives
each token's rank, so that common passages stay out of prefixes (the larger the table, the fewer
tokens take the counts of others). Candidates of this order must also share prefix tokens in further
orders, which are permutations by hashing; 32 bits of these tokens are compared, which lets a few
more candidates pass and drops none. Those that pass are verified by intersecting their whole sets.

Equal sets are one node from the start. Pairs are not listed within groups: first each node is
paired with the least and the greatest node of every prefix token, and verified links are
contracted to components. Then only nodes that share a prefix token while in different components
are compared: as pairs where few nodes share the token, else in blocks of bounded size, each of
which tests its nodes against another block's in memory and gives only links that join them. What
is left out are pairs already known to be joined.

Defined cases: null or blank text has no tokens and is linked with nothing; a text of fewer words
than an n-gram has one token, its whole sequence; rows that share an id are one document whose
links are those of all its texts; rows without id get a null component; repeated rows each give a
row; an empty table gives an empty table; further columns are ignored. Texts of any length are read
whole. Tokens are 64-bit hashes: two n-grams are taken for one with a chance of about 2**-64.
"""

from __future__ import annotations

import zlib
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import bounded_batches, stage
from .common import Sink, give_back, rows_of, whole_text
from .components import components
from .idfilter import BitTable, bit_table, split
from .wordhash import WordHasher, blank_separated, combine, mix

#: Places of the table of counts, a byte each in the driver and in a worker.
COUNT_BITS = 24
#: Up to this many nodes of a token are compared as pairs, more in blocks of at most BLOCK_NODES.
PAIR_NODES = 48
BLOCK_NODES = 384
_SLICES = 64
_ORDERS = (0xD1B54A32D192ED03, 0x2545F4914F6CDD1D)


class Tokens:
    """Sorted distinct token hashes of texts."""

    def __init__(self, words: int = 3):
        self.size, self.hasher = words, WordHasher(blank_separated())

    def texts(self, rows):
        """(key, sorted distinct hashes) of rows of (key, text)."""
        encoded = ((key, (text or "").encode("utf-8", "surrogatepass")) for key, text in rows)
        for keys, begins, words in self.hasher.documents(encoded):
            n = self.size
            grams = combine(*(words[k:len(words) - n + 1 + k] for k in range(n))) if len(words) >= n else words[:0]
            for k, key in enumerate(keys):
                first, last = begins[k], begins[k + 1]
                if last - first >= n:
                    yield key, np.unique(grams[first:last - n + 1])
                elif last > first:
                    short = combine(np.array([last - first], np.uint64), *(words[i:i + 1] for i in range(first, last)))
                    yield key, short
                else:
                    yield key, words[:0]


def prefix_length(size: int, percent: int) -> int:
    """A similar set shares one of this many first tokens: it shares at least percent % of the tokens."""
    return size - -(-percent * size // 100) + 1 if size else 0


def _signed(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def _short(tokens: np.ndarray) -> np.ndarray:
    """32 bits of each token, enough for a filter."""
    return tokens.astype(np.uint32).view(np.int32)


_COUNT = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])


def _graded(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes in the same order, sixteen grades for each doubling."""
    return np.minimum(16 * np.log2(1.0 + counts), 255).astype(np.uint8)


def token_ranks(rows: DataFrame, words: int, bits: int) -> np.ndarray:
    """How many documents' tokens fall into each of ``2**bits`` places, over all documents, in grades.

    Tasks send their counts in slices, which are added up slice by slice; the driver holds
    ``2**bits`` bytes, whatever the size of the data.
    """
    span = (1 << bits) // _SLICES

    def slices(counts):
        for k in range(_SLICES):
            packed = zlib.compress(counts[k * span:(k + 1) * span].tobytes(), 1)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([packed], pa.binary())], schema=_COUNT)

    def count(batches):
        counts, tokens, texts = np.zeros(1 << bits, np.uint16), Tokens(words), 0
        for _, found in tokens.texts(rows_of(batches)):
            if texts == 0xFFFF:  # a place counts a text's token once, unless tokens meet in it
                yield from slices(counts)
                counts[:], texts = 0, 0
            at = (found >> np.uint64(64 - bits)).astype(np.int64)
            np.add.at(counts, at, 1)
            texts += 1
        if texts:
            yield from slices(counts)
        del counts
        give_back()

    def add(batches):
        for k, parts in groupby(rows_of(batches), key=lambda row: row[0]):  # a task may hold several slices
            total = np.zeros(span, np.uint64)
            for _, packed in parts:
                total += np.frombuffer(zlib.decompress(packed), np.uint16)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(_graded(total).tobytes(), 1)], pa.binary())],
                                             schema=_COUNT)

    out = np.zeros(1 << bits, np.uint8)
    summed = rows.mapInArrow(count, "slice int, counts binary").repartition("slice").sortWithinPartitions("slice")
    for k, packed in summed.mapInArrow(add, "slice int, counts binary").collect():  # 64 slices of a fixed table
        out[k * span:(k + 1) * span] = np.frombuffer(zlib.decompress(packed), np.uint8)
    return out


_NODE = pa.schema([("row_key", pa.int64()), ("n", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()),
                   ("prefix", pa.list_(pa.int64()))])
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_SET = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("second", pa.list_(pa.int32())),
                  ("third", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int64()))])


def _nodes(rows: DataFrame, ranks: np.ndarray, words: int, percent: int) -> DataFrame:
    """Each row's set size, two hashes of its set, and its prefix in the rare-first order."""
    shift = np.uint64(64 - int(np.log2(len(ranks))))
    packed = zlib.compress(ranks.tobytes(), 1)

    def run(batches):
        ranks, tokens, sink = np.frombuffer(zlib.decompress(packed), np.uint8), Tokens(words), Sink(_NODE)
        for key, found in tokens.texts(rows_of(batches)):
            n = len(found)
            if not n:
                row = (key, 0, 0, 0, None)
            else:
                rank = ranks[(found >> shift).astype(np.int64)]
                first = found[np.argsort(rank, kind="stable")[:prefix_length(n, percent)]]
                one, two = np.bitwise_xor.reduce(mix(found)), np.add.reduce(mix(found ^ np.uint64(_ORDERS[0])))
                row = (key, n, int(one.astype(np.int64)), int(two.astype(np.int64)), _signed(first))
            if sink.add(row, 64 + 8 * (n // 8)):
                yield sink.flush()
        yield sink.flush()
        del ranks
        give_back()

    return rows.mapInArrow(run, "row_key bigint, n bigint, set_a bigint, set_b bigint, prefix array<bigint>")


def _sets(rows: DataFrame, nodes: DataFrame, words: int, percent: int, prefixes: bool = True,
          whole: bool = True) -> DataFrame:
    """``node, n`` of the given nodes, with the prefixes in the further orders and with whole sets.

    Tasks look ids up in a bit table, so that texts need not be shuffled; the few ids that pass in
    error are left out by the joins that use the sets.
    """
    packed = bit_table(nodes)

    def run(batches):
        wanted, tokens, sink = BitTable(packed), Tokens(words), Sink(_SET)

        def candidates():
            for batch in batches:
                yield batch.filter(pa.array(wanted.among(batch.column(0))))

        for key, found in tokens.texts(rows_of(candidates())):
            p = prefix_length(len(found), percent)
            if not p:
                continue
            further = [_short(found[np.argsort(mix(found ^ np.uint64(seed)), kind="stable")[:p]]) if prefixes else None
                       for seed in _ORDERS]
            if sink.add((key, len(found), *further, _signed(found) if whole else None), 64 + 10 * len(found)):
                yield sink.flush()
        yield sink.flush()
        give_back()

    found = rows.mapInArrow(run, "node bigint, n bigint, second array<int>, third array<int>, tokens array<bigint>")
    return found.drop(*(() if prefixes else ("second", "third")), *(() if whole else ("tokens",)))


def _overlaps(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """How many members each set of one list shares with each of the other."""
    flat, far = np.concatenate(one), np.concatenate(other)
    shared = np.intersect1d(flat, far)
    out = np.zeros((len(one), len(other)), np.float32)
    owner, owner_far = np.repeat(np.arange(len(one)), [len(x) for x in one]), np.repeat(np.arange(len(other)), [len(x) for x in other])
    at, at_far = np.searchsorted(shared, flat), np.searchsorted(shared, far)
    for first in range(0, len(shared), 2048):
        last = min(first + 2048, len(shared))
        left, right = np.zeros((len(one), last - first), np.float32), np.zeros((len(other), last - first), np.float32)
        for matrix, owners, places, values in ((left, owner, at, flat), (right, owner_far, at_far, far)):
            inside = (places >= first) & (places < last)
            inside[inside] = shared[places[inside]] == values[inside]
            matrix[owners[inside], places[inside] - first] = 1
        out += left @ right.T
    return out


def joined_in_block(one: list[tuple], other: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Nodes of two lists (node, n, second, third, tokens) joined by similar sets, as links to the
    first node of each group that arises."""
    passed = (_overlaps([x[2] for x in one], [x[2] for x in other]) > 0) & (_overlaps([x[3] for x in one], [x[3] for x in other]) > 0)
    if not passed.any():
        return []
    shared = _overlaps([x[4] for x in one], [x[4] for x in other])
    sizes, far = np.array([x[1] for x in one]), np.array([x[1] for x in other])
    similar = passed & (100 * shared >= percent * (sizes[:, None] + far[None, :] - shared))
    nodes = np.array([x[0] for x in one] + [x[0] for x in other])
    label = np.arange(len(nodes))
    a, b = np.nonzero(similar)
    b = b + len(one)
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        if (least == label).all():
            break
        label = least
    joined = nodes[label] != nodes
    return list(dict.fromkeys(zip(nodes[label][joined].tolist(), nodes[joined].tolist())))


def _block_links(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the nodes of tokens that many share, block against block."""
    blocks = F.ceil(F.col("size") / BLOCK_NODES).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit("block")), blocks).cast("int")
    dealt = (left.select("token", "node", blocks.alias("blocks"), own.alias("own"))
             .select("token", "node", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("token", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node")
             .join(sets, "node"))

    def compare(batches):
        one, other, same = [], [], False
        for low, high, own, node, n, *arrays in (r for batch in batches for r in _arrays(batch)):
            same = low == high
            (one if own == low else other).append((node, n, *arrays))
        links = joined_in_block(one, one if same else other, percent) if one and (same or other) else []
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())],
                                         schema=_LINK)

    # a group is a pair of blocks and so has a bounded number of rows
    return (dealt.select("token", "low", "high", "own", "node", "n", "second", "third", "tokens")
            .groupBy("token", "low", "high").applyInArrow(_as_group(compare), "a bigint, b bigint"))


def _as_group(compare):
    def run(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches(compare(group.drop_columns(["token"]).to_batches()), schema=_LINK)

    return run


def _arrays(batch: pa.RecordBatch):
    """Rows with list columns as arrays."""
    columns = []
    for column in batch.columns:
        if pa.types.is_list(column.type):
            values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
            columns.append([values[offsets[k]:offsets[k + 1]] for k in range(len(column))])
        else:
            columns.append(column.to_pylist())
    yield from zip(*columns)


def _possible(n: Column, place: Column, other_n: Column, other_place: Column, percent: int) -> Column:
    """Whether sizes and the places of a shared token allow the similarity."""
    least, most = F.least(n, other_n), F.greatest(n, other_n)
    shared = F.least(place, other_place) + 1 + F.least(n - place, other_n - other_place) - 1
    return (100 * least >= percent * most) & (shared * (100 + percent) >= percent * (n + other_n))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))


def _verified(pairs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` that pass the filters of the further orders and whose sets are similar.

    Only prefixes are shuffled for all pairs; whole sets follow for those that pass.
    """
    def both(sets: DataFrame, left: DataFrame) -> DataFrame:
        for end in ("a", "b"):
            own = sets.select(F.col("node").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in sets.columns if c != "node"))
            left = left.join(own, end)
        return left

    prefixes = stage(_sets(rows, _ends(pairs), words, percent, whole=False).drop("n"), "prefixes")
    passed = stage(both(prefixes, pairs).where(
        F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b")).select("a", "b"), "passed")
    sets = stage(_sets(rows, _ends(passed), words, percent, prefixes=False), "sets")
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return both(sets, passed).where(100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared)).select("a", "b")


def groups(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3,
           percent: int = 90, count_bits: int = COUNT_BITS) -> DataFrame:
    """``<id>, n_shingles, component_id`` of every row.

    ``component_id`` is the least id that links lead to. Documents link when
    ``100 * shared >= percent * all`` of their distinct n-grams of ``words`` words.
    """
    bounded_batches(df.sparkSession)
    rows = df.select(F.col(id_column).cast("bigint").alias("row_key"), whole_text(text_column).alias("body"))
    ranks = token_ranks(rows, words, count_bits)
    known = stage(_nodes(rows, ranks, words, percent), "jaccard")
    filled = known.where("n > 0 AND row_key IS NOT NULL")
    posted = (filled.groupBy("set_a", "set_b")
              .agg(F.min("row_key").alias("node"), F.first("n").cast("int").alias("n"), F.first("prefix").alias("prefix"))
              .select("node", "n", F.posexplode("prefix").alias("place", "token")))
    sizes = posted.groupBy("token").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stage(posted.join(sizes, "token"), "postings")
    member = F.struct("node", "n", "place")
    ends = shared.groupBy("token").agg(F.min(member).alias("least"), F.max(member).alias("most"))
    near = stage(shared.join(ends, "token"), "ends")

    def ordered(node: str, other: str) -> list[Column]:
        return [F.least(node, other).alias("a"), F.greatest(node, other).alias("b")]

    def star(end: str) -> DataFrame:
        other = F.col(end)
        return near.where((F.col("node") != other["node"]) & _possible(
            F.col("n"), F.col("place"), other["n"], other["place"], percent)).select(*ordered("node", f"{end}.node"))

    stars = stage(star("least").union(star("most")).distinct(), "pairs")
    links = stage(_verified(stars, rows, words, percent).union(_same_id(known)), "links")
    joined = components(links)

    placed = shared.join(joined.withColumnRenamed("component", "found"), "node", "left").withColumn(
        "part", F.coalesce("found", "node"))
    mixed = placed.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    left = stage(placed.join(mixed.select("token"), "token", "left_semi").select("token", "node", "n", "place", "part", "size"), "left")
    few, many = left.where(F.col("size") <= PAIR_NODES), left.where(F.col("size") > PAIR_NODES)
    other = few.select("token", *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "place", "part")))
    rest = stage(few.join(other, "token").where(
        (F.col("node") < F.col("node_b")) & (F.col("part") != F.col("part_b"))
        & _possible(F.col("n"), F.col("place"), F.col("n_b"), F.col("place_b"), percent))
        .select(*ordered("node", "node_b")).distinct().join(stars, ["a", "b"], "left_anti"), "rest")
    dense = stage(_sets(rows, many.select("node"), words, percent), "sets")
    more = _verified(rest, rows, words, percent).union(_block_links(many, dense, percent))
    whole = components(links.union(more))

    classes = filled.groupBy("set_a", "set_b").agg(F.min("row_key").alias("node"))
    nodes = classes.select("set_a", "set_b", "node").join(whole, "node", "left").select(
        "set_a", "set_b", F.coalesce("component", "node").alias("class"))
    own = known.join(nodes, ["set_a", "set_b"], "left")
    component = F.when(F.col("row_key").isNotNull(), F.when(F.col("n") > 0, F.col("class")).otherwise(F.col("row_key")))
    return own.select(F.col("row_key").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"))


def _same_id(known: DataFrame) -> DataFrame:
    """Links between the sets of rows that share an id: by way of the id's own node."""
    sets = known.where("n > 0 AND row_key IS NOT NULL")
    nodes = sets.groupBy("set_a", "set_b").agg(F.min("row_key").alias("node"))
    repeated = sets.groupBy("row_key").agg(F.count_distinct("set_a", "set_b").alias("sets")).where("sets > 1")
    return (sets.join(repeated, "row_key").join(nodes, ["set_a", "set_b"]).where("node <> row_key")
            .select(F.least("node", "row_key").alias("a"), F.greatest("node", "row_key").alias("b")).distinct())


def keep_one(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 3,
             percent: int = 90) -> DataFrame:
    """The rows of the least id of each group, with all their columns: one, or all that share that id.
    Rows without words or id stay."""
    found = groups(df, id_column, text_column, words, percent)
    gone = stage(found.where(F.col("component_id") != F.col(id_column)).select(F.col(id_column).cast("bigint").alias("gone")), "gone")
    rest, maybe = split(df, id_column, gone)
    return rest.unionAll(maybe.join(gone, maybe[id_column].cast("bigint") == gone["gone"], "left_anti"))
