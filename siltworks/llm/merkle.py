"""A Merkle manifest of a table: a proof for each row that it is part of one root digest.

Method. A row's leaf is a digest of its fields. Leaves are ranked within their group, and the rank is
written in digits of base ``SPAN``. A block is a run of ``SPAN ** HEIGHT`` ranks. Within it the digit
columns are grouped away one after the other, the last digit first: each step gathers up to ``SPAN``
children into an array and hangs it, with its digest, into the parent's struct, so that a block ends
as one row that holds its whole subtree. All these groupings agree with one shuffle by block. The
roots of blocks are ranked already (by block number) and are rolled up in the same way, tier by
tier, until a group has one root; the groups' roots, ordered by group, then make the tree of groups.

On the way back a nested ``transform`` walks each block's struct and ``explode`` gives a row for each
child with the siblings it met; what a block itself has met above comes to it by grouping the blocks
with the proofs of the tier above. No step joins rows with digests, and no task holds more than
blocks: a group of any size is cut into many.

Digest of a sequence: lower-case hexadecimal SHA-256 of its parts put together, digests as hexadecimal
text. A field is ``-`` if null, else its length in UTF-8 bytes, ``:`` and its text. While a group has
several nodes, every ``SPAN`` consecutive ones become one (the last run may be shorter, even one node).

Defined cases: a null id comes first in its group, repeated ids are ordered by their leaves, and rows
equal in all fields each have a place of their own with the same digest; rows with a null group form a
group, the first one; null fields count as above, empty texts as ``0:``; texts may have any length (a
row's fields are hashed where they are read and never shuffled); an empty table gives an empty table;
columns that aren't named as fields are ignored, whatever their names.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rank import group_rank, with_position
from ..session import stage

SPAN, HEIGHT = 3, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Siblings of a node to its left and to its right, as hexadecimal text put together.
STEP = "struct<left:string,right:string>"


def digest(*parts: Column) -> Column:
    """The digest of a sequence of texts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A field's text within a leaf."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(fields: Mapping[str, Column]) -> Column:
    """The leaf digest of a row with these fields, in the order given."""
    return digest(*map(field, fields.values()))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _hex(node: Column) -> Column:
    return F.lower(F.hex(node["hash"]))


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, _hex), "")


def _nothing() -> Column:
    return F.array().cast(f"array<{STEP}>")


def _rolled(nodes: DataFrame) -> DataFrame:
    """``grp, place, node`` (``node`` has a ``hash``) -> ``grp, place, node``: one row per block."""
    digits = [f"d{k}" for k in range(HEIGHT)]
    rows = nodes.select("grp", F.expr(f"place div {SPAN ** HEIGHT}").alias("block"), "node",
                        *[F.expr(f"CAST(place div {SPAN ** k} % {SPAN} AS TINYINT)").alias(d) for k, d in enumerate(digits)])
    rows = rows.repartition("grp", "block")
    for k, digit in enumerate(digits):
        above = ["block", *digits[k + 1:]]
        rows = rows.groupBy("grp", *above).agg(F.sort_array(F.collect_list(F.struct(digit, "node"))).alias("run"))
        rows = rows.withColumn("kids", F.transform("run", lambda kid: kid["node"]))
        # ranks have no gaps: a first run of one node is all that its group has at this height
        first = F.lit(True)
        for column in above:
            first = first & (F.col(column) == 0)
        alone = first & (F.size("kids") == 1)
        hashed = F.when(alone, F.col("kids")[0]["hash"]).otherwise(F.unhex(F.sha2(_joined(F.col("kids")), 256)))
        rows = rows.select("grp", *above, F.struct(hashed.alias("hash"), alone.alias("alone"), "kids").alias("node"))
    return rows.select("grp", F.col("block").alias("place"), "node")


def _walk(node: Column, height: int) -> Column:
    """``load, path`` of every node at the bottom of a block's struct."""
    if height == 0:
        return F.array(F.struct(node["load"].alias("load"), _nothing().alias("path")))
    kids = node["kids"]

    def below(kid: Column, at: Column) -> Column:
        met = F.struct(_joined(F.slice(kids, F.lit(1), at)).alias("left"),
                       _joined(F.slice(kids, at + 2, F.lit(SPAN))).alias("right"))
        step = F.when(node["alone"], _nothing()).otherwise(F.array(met))
        return F.transform(_walk(kid, height - 1),
                           lambda found: F.struct(found["load"].alias("load"), F.concat(found["path"], step).alias("path")))

    return F.flatten(F.transform(kids, below))


def _tiers(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Blocks of the nodes, blocks of those blocks' roots, and so on up to one root per group.

    ``most`` is the largest place. The number of tiers grows with its logarithm.
    """
    tiers = []
    while True:
        tiers.append(stage(_rolled(nodes), "blocks"))
        most //= SPAN ** HEIGHT
        if most == 0:
            return tiers
        nodes = tiers[-1].select("grp", "place", F.struct(F.col("node.hash").alias("hash"), F.struct("place").alias("load")).alias("node"))


def _met(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Each block with ``above``: what its root has met further up. Both have one row per block."""
    both = (blocks.select("grp", "place", "node", F.lit(None).cast(above.schema["above"].dataType).alias("above"))
            .unionByName(above.select("grp", "place", F.lit(None).cast(blocks.schema["node"].dataType).alias("node"), "above")))
    return (both.repartition("grp", "place").groupBy("grp", "place")
            .agg(F.first("node", True).alias("node"), F.first("above", True).alias("above")))


def _down(tiers: Sequence[DataFrame], above: DataFrame) -> DataFrame:
    """``grp, load, above`` of every bottom node: ``above`` (``top, path``) has its whole path."""
    for number, blocks in reversed(list(enumerate(tiers))):
        met = _met(blocks, above).select("grp", "above", F.explode(_walk(F.col("node"), HEIGHT)).alias("found"))
        path = F.concat("found.path", "above.path")
        above = met.select("grp", F.col("found.load").alias("load"), F.struct(F.col("above.top").alias("top"), path.alias("path")).alias("above"))
        if number:
            above = above.select("grp", F.col("load.place").alias("place"), "above")
    return above


def manifest(df: DataFrame, id_column: str = "doc_id", group_column: str = "source", fields: Sequence[str] = FIELDS,
             carry: Mapping[str, Column] | None = None) -> DataFrame:
    """``<id>, leaf, subroot, root, proof`` and the columns of ``carry`` for every row.

    ``proof`` lists, from the leaf to the root, the siblings of each node on the way as
    ``struct<left, right>``. ``carry`` holds short further values of a row, such as a digest to hold
    against the proof. Digests are hexadecimal text.
    """
    carried = dict(carry or {})
    leaf = leaf_of({name: F.col(name) for name in fields})
    rows = df.select(F.col(group_column).alias("grp"), F.col(id_column).alias("id"), F.unhex(leaf).alias("leaf"),
                     F.struct(F.lit(None).cast("string").alias("none"), *[c.alias(n) for n, c in carried.items()]).alias("more"))
    # staged, so that the range shuffle's sample does not hash all fields once more
    ranked = stage(group_rank(stage(rows, "leaves"), ["grp"], ["id", "leaf"], "place"), "ranks")
    leaves = ranked.select("grp", (F.col("place") - 1).alias("place"),
                           F.struct(F.col("leaf").alias("hash"), F.struct("id", "leaf", "more").alias("load")).alias("node"))
    most = ranked.agg(F.max("place")).first()[0] or 1
    groups = _tiers(leaves, most - 1)

    tops = with_position(groups[-1].select("grp", F.col("node.hash").alias("hash")), ["grp"], "place")
    heads = stage(tops.select(F.lit(0).alias("grp"), (F.col("place") - 1).alias("place"),
                              F.struct("hash", F.struct("grp", F.col("hash").alias("top")).alias("load")).alias("node")), "groups")
    total = _tiers(heads, max(heads.count() - 1, 0))
    root = total[-1].select("node.hash").first()  # one row: the root of everything

    summit = total[-1].select("grp", "place", F.struct(F.lit(None).cast("binary").alias("top"), _nothing().alias("path")).alias("above"))
    joined = _down(total, summit)
    subroots = joined.select(F.col("load.grp").alias("grp"), F.lit(0).cast("bigint").alias("place"),
                             F.struct(F.col("load.top").alias("top"), F.col("above.path").alias("path")).alias("above"))
    found = _down(groups, subroots)
    return found.select(F.col("load.id").alias(id_column), F.lower(F.hex("load.leaf")).alias("leaf"),
                        F.lower(F.hex("above.top")).alias("subroot"), F.lit(bytes(root[0]).hex() if root else None).alias("root"),
                        F.col("above.path").alias("proof"), *[F.col(f"load.more.{name}").alias(name) for name in carried])
