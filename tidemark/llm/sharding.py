"""Sharding by a hierarchical weighted hash tree, with DataFrame functions only.

A topology is a list of shards with region, rack and weight. A document
descends from the root: at each level every child draws ln(u) / weight with u
a hash of (document, child), and the largest draw wins. A child's draw depends
on its own name and weight only, so changing one shard's weight, or adding
one, moves documents only into or out of the subtrees whose weights change; a
shard that joins in a region of its own takes documents from everywhere and
gives none to any older shard.

Scale: the draws are column expressions over the id, a few md5 sums for each
row (the children on the chosen path only are compared); the text is read for
its size and checksum and never shuffled. Slots number each shard's rows with
no gap: rows are numbered inside hash buckets of a shard, and a running sum of
bucket counts (at most ``buckets`` rows for each shard) gives the offsets, so
a shard of any size is split over many tasks.

Defined cases: a null text counts 16 bytes and has checksum 0, as the empty
text; null ids are placed like any other value, all on one shard; repeated
rows go to the same shard and get slots of their own; an empty table gives no
rows; other columns of the input are not carried.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hash52, in_range, table

#: Bytes that every row takes besides its text.
ROW_BYTES = 16
SLOT_BUCKETS = 1024


class Shard(NamedTuple):
    shard: int
    region: str
    rack: str
    weight: float = 1.0


def regular_topology(n: int, per_rack: int = 4, racks: int = 2) -> list[Shard]:
    """n equal shards, filled rack by rack and region by region."""
    return [Shard(i, f"g{i // (per_rack * racks)}", f"g{i // (per_rack * racks)}r{i // per_rack % racks}") for i in range(n)]


def with_new_region(topology: Sequence[Shard], weight: float = 1.0) -> list[Shard]:
    """The topology and one more shard in a region of its own."""
    n = max(s.shard for s in topology) + 1
    return [*topology, Shard(n, f"g+{n}", f"g+{n}r0", weight)]


def children_of(topology: Sequence[Shard]) -> dict[str, list[tuple[str, float]]]:
    """The tree as node -> its children with the sums of their shards' weights; shards are named by number."""
    tree: dict[str, dict[str, float]] = {}
    for s in topology:
        if s.weight > 0:
            path = ["root", f"region {s.region}", f"rack {s.rack}", f"shard {s.shard}"]
            for parent, child in zip(path, path[1:]):
                at = tree.setdefault(parent, {})
                at[child] = at.get(child, 0.0) + s.weight
    return {parent: list(of.items()) for parent, of in tree.items()}


def draw(doc_id: Column, node: Column, weight: Column) -> Column:
    """ln(u) / weight; the hash is moved off 0 and 1 so that the logarithm is finite and negative."""
    return F.log((hash52(node, doc_id) + F.lit(0.5)) / F.lit(float(2**52))) / weight


def descend(doc_id: Column, node: Column, tree: Column) -> Column:
    """The child with the largest draw; equal draws go to the larger name."""
    best = F.array_max(F.transform(F.element_at(tree, node), lambda c: F.struct(draw(doc_id, c["name"], c["weight"]).alias("draw"), c["name"].alias("name"))))
    return best["name"]


def place(docs: DataFrame, topology: Sequence[Shard], doc_id: str = "doc_id", out: str = "shard") -> DataFrame:
    """docs with the shard of each row: three descents from the root, in one narrow pass."""
    tree = F.create_map(*[x for parent, of in children_of(topology).items() for x in (F.lit(parent), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight")) for n, w in of]))])
    node = F.lit("root")
    for _ in ("region", "rack", "shard"):
        node = descend(F.col(doc_id), node, tree)
    return docs.withColumn(out, F.substring_index(node, " ", -1).cast("int"))


def number_slots(placed: DataFrame, order: Sequence[str], shard: str = "shard", buckets: int = SLOT_BUCKETS) -> DataFrame:
    """placed with slot: 0, 1, 2 ... in each shard, the same on every run for distinct rows."""
    cut = placed.withColumn("_bucket", in_range(F.xxhash64(*order), buckets))
    counts = cut.groupBy(shard, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(shard, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(shard, "_bucket").orderBy(*order)
    return cut.withColumn("_row", F.row_number().over(inside)).join(offsets, [shard, "_bucket"]).withColumn("slot", (F.col("_offset") + F.col("_row") - 1).cast("long")).drop("_bucket", "_row", "_offset")


def shard_documents(docs: DataFrame, topology: Sequence[Shard], grown: Sequence[Shard]) -> DataFrame:
    """One row per document: size, checksum, shard, slot and its shard in the grown topology."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select("doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = place(place(sized, topology), grown, out="grown_shard")
    return number_slots(placed, ["doc_id", "text_crc32", "size"])


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    topology = regular_topology(40)
    out = shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), topology, with_new_region(topology))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
