"""Sharding by a hierarchical weighted hash tree (operator 1).

A tree has regions, racks and shards with weights. A row descends it: at each
level every child gets a weighted hash draw, -ln(u) / weight with u hashed from
the row's id and the child's name, and the least draw wins. A child is thus
drawn in proportion to its weight, and changing a weight moves rows only into
or out of the subtrees whose weights change.

A shard that is added later is a path of its own (a region of one rack of one
shard, with the new shard's weight): it takes part in the first draw only, so
rows move into the new shard and nowhere else. The law is ``key``: the id and
the shard count decide.

``slot`` numbers the rows of a shard from 0 without gaps. Rows are numbered
within (shard, scan partition), and each partition's rows start after those of
the partitions before, so no shard has to fit into one task.

Defined results: a null text has 0 bytes and crc32 0; rows of null ids are one
key; repeated rows get slots of their own; extra columns are ignored (``place``
keeps them and replaces columns it adds); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from .tables import checkpointed, column_of, positional


@dataclass(frozen=True)
class Tree:
    """``regions[i][j]`` maps the shard numbers of rack j of region i to
    weights; ``added`` holds (shard, weight) of later shards."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]
    added: tuple[tuple[int, float], ...] = ()

    @staticmethod
    def even(shards: int, regions: int = 2, racks: int = 3) -> Tree:
        """``shards`` shards of weight 1, dealt over the racks."""
        parts: list[list[list[tuple[int, float]]]] = [[[] for _ in range(racks)] for _ in range(regions)]
        for s in range(shards):
            rack = s * regions * racks // shards
            parts[rack // racks][rack % racks].append((s, 1.0))
        return Tree(tuple(tuple(tuple(k) for k in r if k) for r in parts if any(r)))

    def grown(self, weight: float = 1.0) -> Tree:
        """The tree with one more shard."""
        return replace(self, added=(*self.added, (self.count, weight)))

    @property
    def count(self) -> int:
        return sum(len(k) for r in self.regions for k in r) + len(self.added)

    def nodes(self) -> list[tuple[str, float, list]]:
        """(name, weight, children) of the regions and added paths; a leaf's
        children are its shard number."""
        out = []
        for i, r in enumerate(self.regions):
            racks = [(f"{i}/{j}", sum(w for _, w in k), [(f"{i}/{j}/{s}", w, s) for s, w in k]) for j, k in enumerate(r)]
            out.append((f"{i}", sum(w for _, w, _ in racks), racks))
        return out + [(f"+{s}", w, s) for s, w in self.added]


def _draw(key: Column, name: str, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(name), key), 11)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / F.lit(float(weight))


def _descend(key: Column, children: list) -> Column:
    """Struct (draw, shard) of the child with the least draw, and of its subtree."""
    live = [c for c in children if c[1] > 0]
    draws = [F.struct(_draw(key, name, w).alias("draw"), F.lit(k).alias("at")) for k, (name, w, _) in enumerate(live)]
    won = F.array_min(F.array(*draws))

    def below(won: Column) -> Column:
        out = None
        for k, (_, _, sub) in enumerate(live):
            shard = F.lit(sub) if isinstance(sub, int) else _descend(key, sub)["shard"]
            out = F.when(won["at"] == k, shard) if out is None else out.when(won["at"] == k, shard)
        return F.struct(won["draw"].alias("draw"), out.alias("shard"))

    # a one-item transform names the winner, so that the draws are made once
    return F.element_at(F.transform(F.array(won), below), 1)


def with_shard(df: DataFrame, tree: Tree, key: str = "doc_id") -> DataFrame:
    """``df`` with ``shard``, and ``grown_shard`` of one more shard of weight 1."""
    more = tree.grown()
    new, weight = more.added[-1]
    id_ = F.col(key)
    name = "won"
    while name in {c.lower() for c in df.columns}:
        name += "_"
    placed = df.withColumn(name, _descend(id_, tree.nodes()))
    won = F.col(name)
    return (placed.withColumn("shard", won["shard"].cast("int"))
            .withColumn("grown_shard", F.when(_draw(id_, f"+{new}", weight) < won["draw"], F.lit(new)).otherwise(won["shard"]).cast("int"))
            .drop(name))


def assign(docs: DataFrame, tree: Tree) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law,
    shard, slot, grown_shard."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = with_shard(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(raw) + 8).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32")), tree)
    # a written state, so that both uses below see the same partitions
    rows = checkpointed(rows.withColumn("part", F.spark_partition_id()))
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("k", F.row_number().over(inside)).join(starts, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("start") + F.col("k") - 1).alias("slot"), "grown_shard"))


def place(docs: DataFrame, tree: Tree) -> DataFrame:
    """``docs`` with ``shard`` and ``size`` (columns of these names are
    replaced, all others stay); nothing is shuffled."""
    rows, names = positional(docs)
    raw = F.coalesce(F.col(column_of(names, "text")).cast("string"), F.lit("")).cast("binary")
    placed = with_shard(rows, tree, column_of(names, "doc_id"))
    kept = [(f"c{i}", n) for i, n in enumerate(names) if n.lower() not in ("shard", "size")]
    return placed.select(*(c for c, _ in kept), "shard", (F.octet_length(raw) + 8).cast("long")).toDF(*(n for _, n in kept), "shard", "size")
