"""Merkle manifest of a dataset: a tree per group of rows, a tree of their subroots, proofs of all.

Leaves are numbered per group in key order; ``2 ** BLOCK_LEVELS`` neighbours are a block, the unit
of work, so that a group may have any share of all rows. A block hashes up to its own top node;
tops are taken together in blocks again, until one node per group is left, and these subroots are
the leaves of one last tree. For the proofs (an octopus multiproof) a block names the nodes that
prove all its leaves and that it can't derive from them, fetches these in one join, derives what
its leaves share once, and writes out the single proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeline.llm.arrow import list_array, quoted, running_total, ship_package, stored

#: Levels that one block derives: up to 4096 leaves, about half a megabyte.
BLOCK_LEVELS = 12

#: A node beside a path, and whether it stands left of it; "" where the path goes on alone.
Beside = tuple[str, bool]


def field(value: Column) -> Column:
    """A value behind its length in UTF-8 bytes, or ``-`` for null."""
    words = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(words).cast("string"), F.lit(":"), words),
                      F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """Digest of a row's values, each with its length, so that no two rows read alike."""
    return F.sha2(F.concat(*(field(v) for v in values)).cast("binary"), 256)


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def width(leaves: int, level: int) -> int:
    """Nodes on a level of a tree with so many leaves."""
    return (leaves + (1 << level) - 1) >> level


def height(leaves: int) -> int:
    """The level of the root; a single leaf is its own root."""
    return max(0, leaves - 1).bit_length()


def missing_coordinates(known: Iterable[int], leaves: int) -> list[tuple[int, int]]:
    """The fewest nodes (level, place) that prove the known leaves along with these: on every
    level the neighbours of known nodes that are not known."""
    out, now = [], set(known)
    for level in range(height(leaves)):
        wide = width(leaves, level)
        out += [(level, i ^ 1) for i in sorted(now) if i ^ 1 not in now and i ^ 1 < wide]
        now = {i >> 1 for i in now}
    return out


def derive(known: dict[int, str], fetched: dict[tuple[int, int], str], leaves: int,
           first: int = 0, last: int | None = None) -> dict[tuple[int, int], str]:
    """The fetched nodes, and all on the paths of the known nodes of level ``first`` up to level
    ``last`` (the root), each hashed once. Two neighbours make a node, the last may be alone."""
    nodes, now = dict(fetched), known
    last = height(leaves) if last is None else min(last, height(leaves))
    for level in range(first, last):
        nodes.update(((level, i), one) for i, one in now.items())
        now = {p: digest(nodes[level, 2 * p], nodes.get((level, 2 * p + 1), ""))
               for p in {i >> 1 for i in now}}
    nodes.update(((max(first, last), i), one) for i, one in now.items())
    return nodes


def proof_of(nodes: dict[tuple[int, int], str], leaf: int, leaves: int) -> list[Beside]:
    """What stands beside a leaf's path, level by level from below."""
    return [(nodes[level, (leaf >> level) ^ 1], bool(leaf >> level & 1))
            if (leaf >> level) ^ 1 < width(leaves, level) else ("", False)
            for level in range(height(leaves))]


def fold(leaf: str, proof: Iterable[Beside]) -> str:
    """The root that a leaf and its proof lead to."""
    return reduce(lambda at, one: digest(one[0], at) if one[1] else digest(at, one[0]),
                  proof, leaf)


#: Nodes of trees from the tops of the blocks up.
_NODES = "group string, size bigint, level int, place bigint, hash string, root boolean"


def _node_table(group: str, size: int, nodes: dict[tuple[int, int], str]) -> pa.Table:
    top = height(size)
    rows = [(group, size, level, place, one, level == top)
            for (level, place), one in nodes.items()]
    columns = list(zip(*rows)) if rows else [()] * 6
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)],
                    ["group", "size", "level", "place", "hash", "root"])


def numbered(leaves: DataFrame, levels: int) -> DataFrame:
    """``leaves`` with ``index`` and ``block`` in their group and its ``size``, written.

    They must be a plain read of a table written in order, with ``group`` (not null) and
    ``hash``; other columns stay.
    """
    sizes = leaves.groupBy("group").agg(F.count("*").alias("size"))
    counted = running_total(leaves, [quoted(c) for c in leaves.columns], [F.col("group")],
                            F.lit(1), "index")
    return stored(counted.withColumn("block", F.shiftright("index", levels))
                  .join(sizes, "group"), "leaves")


def _climb(base: int, levels: int):
    """Of neighbouring nodes of level ``base``, all nodes that they make above it."""

    def climb(key: tuple, rows: pa.Table) -> pa.Table:
        known = dict(zip(rows["place"].to_pylist(), rows["hash"].to_pylist()))
        size = rows["size"][0].as_py()
        nodes = derive(known, {}, size, base, base + levels)
        return _node_table(key[0].as_py(), size,
                           {at: one for at, one in nodes.items() if at[0] > base})

    return climb


def grown(leaves: DataFrame, levels: int) -> DataFrame:
    """The nodes of all groups from the tops of their blocks of leaves up to their roots."""

    def top(key: tuple, rows: pa.Table) -> pa.Table:
        group, size = key[0].as_py(), rows["size"][0].as_py()
        known = dict(zip(rows["index"].to_pylist(), rows["hash"].to_pylist()))
        nodes, high = derive(known, {}, size, last=levels), min(levels, height(size))
        place = key[1].as_py() if high == levels else 0
        return _node_table(group, size, {(high, place): nodes[high, place]})

    floors = [stored(leaves.select("group", "block", "size", "index", "hash")
                     .groupBy("group", "block").applyInArrow(top, _NODES), "nodes")]
    base = levels
    while True:
        tops = floors[-1].where(~F.col("root") & (F.col("level") == base))
        if not tops.limit(1).count():
            return reduce(DataFrame.unionByName, floors)

        floors.append(stored(tops.withColumn("block", F.shiftright("place", levels))
                             .groupBy("group", "block")
                             .applyInArrow(_climb(base, levels), _NODES), "nodes"))
        base += levels


def _fetched(nodes: DataFrame, levels: int) -> DataFrame:
    """Per block of leaves the nodes that it needs and can't derive: group, block, level, place,
    hash, left."""
    tops = nodes.where((F.col("level") == levels) | (F.col("root") & (F.col("level") < levels)))
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64())

    def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(group, block, level, place)
                    for group, size, block in zip(*(c.to_pylist() for c in batch.columns))
                    for level, place in missing_coordinates(
                        range(block << levels, min(size, (block + 1) << levels)), size)]
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)],
                                  ["group", "block", "level", "place"])

    wanted = tops.select("group", "size", F.col("place").alias("block")).mapInArrow(
        coordinates, "group string, block bigint, level int, place bigint")
    return wanted.join(nodes.select("group", "level", "place", "hash"),
                       ["group", "level", "place"]).select(
        "group", "block", "level", "place", "hash", F.lit(False).alias("left"))


#: Levels of a fetched node from here on belong to the tree of the subroots.
_ABOVE = 1000


def proofs(leaves: DataFrame, nodes: DataFrame, levels: int,
           above: DataFrame | None = None) -> DataFrame:
    """The leaves with ``proof``, an array of (hash, left) from below, ``folded``, the root that
    ``claimed`` (if null: the leaf's own hash) and the proof lead to, and the group's ``subroot``.

    ``above``: group and the proof of the group's subroot, which is then part of the proof.
    """
    fetched = _fetched(nodes, levels)
    if above is not None:
        tops = leaves.groupBy("group", "block").agg(F.lit(1).alias("one")).drop("one")
        upper = tops.join(above.select("group", F.posexplode("proof").alias("level", "p")),
                          "group")
        fetched = fetched.unionByName(upper.select(
            "group", "block", (F.col("level") + _ABOVE).alias("level"),
            F.lit(0).cast("bigint").alias("place"), "p.hash", "p.left"))
    kind = pa.struct([("hash", pa.string()), ("left", pa.bool_())])

    def prove(key: tuple, rows: pa.Table, found: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return made(rows, [], [], [], [], "")
        size, own = rows["size"][0].as_py(), rows["hash"].to_pylist()
        index, claimed = rows["index"].to_pylist(), rows["claimed"].to_pylist()
        got = sorted(zip(*(found[c].to_pylist() for c in ("level", "place", "hash", "left"))))
        nodes = derive(dict(zip(index, own)),
                       {(a, b): c for a, b, c, _ in got if a < _ABOVE}, size)
        high = [(c, d) for a, _, c, d in got if a >= _ABOVE]
        beside, left, lengths, ends = [], [], [], []
        for i, one, claim in zip(index, own, claimed):
            proof = proof_of(nodes, i, size) + high
            beside += [p[0] for p in proof]
            left += [p[1] for p in proof]
            lengths.append(len(proof))
            ends.append(fold(one if claim is None else claim, proof))
        return made(rows, beside, left, lengths, ends, nodes[height(size), 0])

    def made(rows: pa.Table, beside: list, left: list, lengths: list, ends: list,
             subroot: str) -> pa.Table:
        pairs = pa.StructArray.from_arrays(
            [pa.array(beside, pa.string()), pa.array(left, pa.bool_())], fields=list(kind))
        return rows.append_column("proof", list_array(pairs, lengths)).append_column(
            "folded", pa.array(ends, pa.string())).append_column(
            "subroot", pa.array([subroot] * len(ends), pa.string()))

    out = T.StructType([*leaves.schema, T.StructField("proof", T.ArrayType(T.StructType([
        T.StructField("hash", T.StringType()), T.StructField("left", T.BooleanType())]))),
        T.StructField("folded", T.StringType()), T.StructField("subroot", T.StringType())])
    return leaves.groupBy("group", "block").cogroup(
        fetched.groupBy("group", "block")).applyInArrow(prove, out)


class Manifest(NamedTuple):
    """``leaves``: group (named as in ``group_name``), key, hash, claimed, index, block, size;
    ``nodes`` of the groups' trees, ``subroots`` (the leaves of the last tree) and its ``crown``
    of nodes; ``root`` is null for an empty table. All are written tables."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    crown: DataFrame
    root: str | None
    levels: int

    def proofs(self) -> DataFrame:
        """Every leaf with its subroot, its whole proof up to the root, and the root that its
        claimed hash leads to."""
        top = proofs(self.subroots, self.crown, self.levels)
        above = stored(top.select(F.col("name").alias("group"), "proof"), "subroot-proofs")
        return proofs(self.leaves, self.nodes, self.levels, above)


def group_name(value: Column) -> Column:
    """A group's name in the trees: null is first and no other value's name."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit(""))


def build(docs: DataFrame, *, key: str = "doc_id", group: str = "lang",
          values: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
          claimed: Column | None = None, levels: int = BLOCK_LEVELS) -> Manifest:
    """Hash every row of ``docs`` into a leaf, and all leaves into one root.

    Leaves of a group are in key order, null keys first, then by their hash, so equal rows are
    neighbours and the order of the input doesn't matter. Rows with a null group are a group
    like others and come first. Empty texts differ from null ones. Only the columns named are
    read, so others may have any name. ``claimed``: hashes that the proofs are to check in
    place of the leaves' own, null where it is the same.
    """
    ship_package(docs.sparkSession)
    # Written first: texts are read once, not for the ranges of the sort as well.
    rows = stored(docs.select(
        group_name(quoted(group)).alias("group"), quoted(key).alias("key"),
        leaf_hash(*(quoted(v) for v in values)).alias("hash"),
        (F.lit(None) if claimed is None else claimed).cast("string").alias("claimed")), "hashed")
    order = ["group", "key", "hash", "claimed"]
    leaves = numbered(stored(rows.repartitionByRange(*order).sortWithinPartitions(*order),
                             "sorted-leaves"), levels)
    nodes = grown(leaves, levels)
    tops = nodes.where("root").select(
        F.lit("").alias("group"), F.col("group").alias("name"), "hash",
        F.lit(None).cast("string").alias("claimed"))
    subroots = numbered(stored(tops.repartitionByRange("name").sortWithinPartitions("name"),
                               "subroots"), levels)
    crown = grown(subroots, levels)
    found = crown.where("root").select("hash").first()
    return Manifest(leaves, nodes, subroots, crown, found and found["hash"], levels)


def write_manifest(manifest: Manifest, path: str) -> None:
    """The tables of a manifest as Parquet below ``path``; leaves in files by index ranges."""
    for name in ("leaves", "nodes", "subroots", "crown"):
        getattr(manifest, name).write.parquet(f"{path}/{name}")


def read_manifest(spark, path: str, levels: int = BLOCK_LEVELS) -> Manifest:
    ship_package(spark)
    tables = [spark.read.parquet(f"{path}/{n}") for n in ("leaves", "nodes", "subroots", "crown")]
    found = tables[3].where("root").select("hash").first()
    return Manifest(*tables, found and found["hash"], levels)
