"""Shards of near-equal bytes: a k-d tree over metadata with distributed weighted medians.

Every node is split along its widest dimension (extent within the node, as a share of the table's extent) at
the weighted quantile that gives both sides bytes in proportion to their leaves. All nodes of a level are
handled by the same few aggregations: extents first, then histograms of bytes that narrow each node's
quantile by ``BITS`` bits a round. Ties on the dimension are ordered by a hash of the id, so one value with a
third of all rows is split like any other. Rows are never moved while the tree grows; the driver
holds the tree (leaves - 1 cuts) and per round one histogram bin a node.

Law ``bytes``: shard sizes are near equal. Rows with equal texts may lie in different shards, since a group of
copies can be larger than a shard.

Defined cases: a null text has no bytes (its size is ``overhead``); null metadata is the smallest coordinate; rows that are
equal in id and all dimensions share a shard; a null id is ordered first; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from vintara.llm.common import numbered, whole_text, written

BITS = 11  # a histogram has 2**BITS bins a node
VALUE_BITS, TIE_BITS = 31, 24


@dataclass
class Node:
    leaves: int
    first: int
    dimension: str | None = None
    cut: int | None = None
    low: Node | None = None
    high: Node | None = None

    def shard(self) -> Column:
        if self.cut is None:
            return F.lit(self.first)
        return F.when(F.col(self.dimension) < self.cut, self.low.shard()).otherwise(self.high.shard())

    def open(self) -> list[Node]:
        if self.cut is not None:
            return self.low.open() + self.high.open()
        return [self] if self.leaves > 1 else []


def _key(value: Column) -> Column:
    """Coordinate (0 to 2**31 - 1, null is 0) with the id's hash below it: no two rows of different ids tie."""
    return F.shiftleft(F.coalesce(value.cast("long"), F.lit(0)), TIE_BITS) + F.col("_tie")


def light_rows(docs: DataFrame, text: str, identifier: str, overhead: int, categories: list[str]) -> DataFrame:
    """Id, size, CRC and one key per metadata dimension: size of the text, id, and each category column."""
    raw = whole_text(text)
    tie = F.xxhash64(identifier).bitwiseAND((1 << TIE_BITS) - 1)
    top = (1 << VALUE_BITS) - 1
    return docs.select(
        F.col(identifier).alias("_id"), (F.octet_length(raw) + overhead).cast("long").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"), tie.alias("_tie"),
        # half-octaves spread short and long texts alike
        F.least(F.round(F.log2(F.octet_length(raw) + 1) * (1 << 24)), F.lit(top)).alias("_d0"),
        *[F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c).cast("string")).bitwiseAND(top)).alias(f"_d{i + 1}")
          for i, c in enumerate(categories)],
    ).select("_id", "size", "text_crc32", *[_key(F.col(f"_d{i}")).alias(f"_k{i}") for i in range(len(categories) + 1)])


def _cuts(rows: DataFrame, root: Node, dimensions: list[str], whole: dict[str, int], tolerance: int) -> None:
    """Split every open node of the tree once."""
    nodes = {n.first: n for n in root.open()}
    at = rows.withColumn("_node", root.shard()).where(F.col("_node").isin(list(nodes)))
    extents = at.groupBy("_node").agg(F.sum("size").alias("bytes"), *[F.min(d).alias(f"low_{d}") for d in dimensions],
                                      *[F.max(d).alias(f"high_{d}") for d in dimensions]).collect()
    search = {}
    for e in extents:
        node = nodes[e["_node"]]
        node.dimension = max(dimensions, key=lambda d: (e[f"high_{d}"] - e[f"low_{d}"]) / max(1, whole[d]))
        low, high = e[f"low_{node.dimension}"], e[f"high_{node.dimension}"] + 1
        left = node.leaves // 2
        search[node.first] = {"from": low, "to": high, "before": 0, "wanted": e["bytes"] * left / node.leaves}
    for first, node in nodes.items():
        if first not in search:  # no rows: any cut does
            node.dimension = dimensions[0]
            node.cut = 0
    open_nodes = dict(search)
    while open_nodes:
        keys, bins = F.lit(None).cast("long"), F.lit(None).cast("long")
        for first, s in open_nodes.items():
            s["width"] = max(1, -(-(s["to"] - s["from"]) >> BITS) if s["to"] - s["from"] > 1 << BITS else 1)
            key = F.col(nodes[first].dimension)
            inside = (F.col("_node") == first) & (key >= s["from"]) & (key < s["to"])
            keys = F.when(inside, F.lit(first)).otherwise(keys)
            bins = F.when(inside, F.floor((key - s["from"]) / s["width"])).otherwise(bins)
        histogram = at.select(keys.alias("_of"), bins.alias("_bin"), "size").where(F.col("_of").isNotNull()).groupBy(
            "_of", "_bin").agg(F.sum("size").alias("_bytes"))
        by_bin = F.transform(F.array_sort(F.collect_list(F.struct("_bin", "_bytes"))), lambda x: x)
        for row in histogram.groupBy("_of").agg(by_bin.alias("bins")).collect():  # at most 2**BITS pairs a node
            s, node, done = open_nodes[row["_of"]], nodes[row["_of"]], False
            before = s["before"]
            for number, size in row["bins"]:
                if before + size >= s["wanted"]:
                    low = s["from"] + number * s["width"]
                    if size <= tolerance or s["width"] == 1:
                        over, under = before + size - s["wanted"], s["wanted"] - before
                        node.cut, done = (low if under <= over else low + s["width"]), True
                    else:
                        s.update({"from": low, "to": min(s["to"], low + s["width"]), "before": before})
                    break
                before += size
            else:
                node.cut, done = s["to"], True
            if done:
                del open_nodes[row["_of"]]
    for node in nodes.values():
        left = node.leaves // 2
        node.low, node.high = Node(left, node.first), Node(node.leaves - left, node.first + left)


def grow_tree(rows: DataFrame, leaves: int, tolerance: float) -> Node:
    """The tree over ``rows`` (``size`` and keys ``_k0``, ``_k1``, ...). Quantiles are narrowed until a
    histogram bin holds at most ``tolerance`` of a leaf's bytes or a single key."""
    dimensions = [c for c in rows.columns if c.startswith("_k")]
    root = Node(leaves, 0)
    total = rows.agg(F.sum("size").alias("bytes"), *[(F.max(d) - F.min(d)).alias(d) for d in dimensions]).first()
    if total["bytes"] is None:
        return root
    whole = {d: total[d] for d in dimensions}
    while root.open():
        _cuts(rows, root, dimensions, whole, int(total["bytes"] / leaves * tolerance))
    return root


def kd_shards(docs: DataFrame, shards: int = 40, text: str = "text", identifier: str = "doc_id", overhead: int = 16,
              categories: tuple[str, ...] = ("source", "lang"), tolerance: float = 0.0005) -> DataFrame:
    """One row per document: ``identifier``, size, text_crc32, shard, slot (gapless within the shard)."""
    rows = written(light_rows(docs, text, identifier, overhead, list(categories)), "shard-rows")
    placed = rows.select("_id", "size", "text_crc32", grow_tree(rows, shards, tolerance).shard().cast("int").alias("shard"))
    return numbered(placed, "shard", "_id", "slot").withColumnRenamed("_id", identifier)


def shard_count(docs: DataFrame, target_bytes: int, text: str = "text", overhead: int = 16) -> int:
    """How many leaves reach ``target_bytes``."""
    total = docs.agg(F.sum(F.octet_length(whole_text(text)) + overhead)).first()[0] or 0
    return max(1, -(-total // target_bytes))
