"""Shards by best-fit decreasing: groups of equal texts, largest first, into the tightest shard that fits.

Placing needs only how many groups have each size: sizes are whole numbers that add up to the total, so there are
at most ``sqrt(2 * total)`` different ones, and groups of one size are placed as runs. The runs are
numbers in the order of all groups by falling size; each group finds its run by its own number, which running
totals over ranges give. So neither groups nor documents pass through the driver or one task.

For a fixed number of shards the smallest capacity is searched at which they suffice, so their sizes come out
near equal. For a fixed capacity as few shards are opened as best fit needs.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.operators.running_totals import running_totals
from loanweave.session import stage

SHARDS = 16


@dataclass
class Node:
    key: tuple[int, int]
    left: Node | None = None
    right: Node | None = None
    height: int = 1


def _height(node: Node | None) -> int:
    return node.height if node else 0


def _turned(node: Node, down: str, up: str) -> Node:
    """The tree with the child on side ``up`` on top."""
    top = getattr(node, up)
    setattr(node, up, getattr(top, down))
    setattr(top, down, node)
    for n in (node, top):
        n.height = 1 + max(_height(n.left), _height(n.right))
    return top


def _balanced(node: Node) -> Node:
    node.height = 1 + max(_height(node.left), _height(node.right))
    tilt = _height(node.left) - _height(node.right)
    if tilt > 1:
        if _height(node.left.left) < _height(node.left.right):
            node.left = _turned(node.left, "left", "right")
        return _turned(node, "right", "left")
    if tilt < -1:
        if _height(node.right.right) < _height(node.right.left):
            node.right = _turned(node.right, "right", "left")
        return _turned(node, "left", "right")
    return node


class OpenShards:
    """Balanced (AVL) tree of open shards by room left, then number."""

    def __init__(self):
        self.root: Node | None = None

    def add(self, room: int, shard: int) -> None:
        self.root = self._added(self.root, (room, shard))

    def _added(self, node: Node | None, key: tuple[int, int]) -> Node:
        if node is None:
            return Node(key)
        if key < node.key:
            node.left = self._added(node.left, key)
        else:
            node.right = self._added(node.right, key)
        return _balanced(node)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The shard with the least room of at least ``size``."""
        node, best = self.root, None
        while node:
            if node.key[0] >= size:
                node, best = node.left, node.key
            else:
                node = node.right
        return best

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._removed(self.root, key)

    def _removed(self, node: Node, key: tuple[int, int]) -> Node | None:
        if key < node.key:
            node.left = self._removed(node.left, key)
        elif key > node.key:
            node.right = self._removed(node.right, key)
        elif node.left and node.right:
            least = node.right
            while least.left:
                least = least.left
            node.key = least.key
            node.right = self._removed(node.right, least.key)
        else:
            return node.left or node.right
        return _balanced(node)


Run = tuple[int, int, int, int]


def best_fit(sizes: list[tuple[int, int]], capacity: int, most: int | None = None) -> tuple[list[Run], int] | None:
    """Runs (size, first number, groups, shard) and number of shards; None if more than ``most`` are needed.

    ``sizes``: (size, number of groups), largest first. A group above the capacity has a shard of its own.
    """
    tree, runs, opened, number = OpenShards(), [], 0, 0
    for size, groups in sizes:
        while groups:
            found = tree.tightest(size)
            if found is None:
                if opened == most:
                    return None
                room, shard = max(capacity, size), opened
                opened += 1
            else:
                tree.remove(found)
                room, shard = found
            taken = min(groups, room // size)
            runs.append((size, number, taken, shard))
            number += taken
            groups -= taken
            if room > taken * size:
                tree.add(room - taken * size, shard)
    return runs, opened


def even_fit(sizes: list[tuple[int, int]], shards: int) -> list[Run]:
    """The runs at the smallest capacity found at which ``shards`` suffice."""
    if not sizes:
        return []
    low = max(sizes[0][0], -(-sum(s * n for s, n in sizes) // shards))
    step, high = 0, low
    while (found := best_fit(sizes, high, shards)) is None:
        low, step = high + 1, max(1, 2 * step)
        high = low + step
    while low < high:
        middle = (low + high) // 2
        tried = best_fit(sizes, middle, shards)
        if tried is None:
            low = middle + 1
        else:
            found, high = tried, middle
    return found[0]


def shard(docs: DataFrame, shards: int = SHARDS, capacity: int | None = None) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` (gapless in the shard) for every row.

    Rows with equal texts are one group and stay together; a null text is an empty one. The size is that of the
    UTF-8 bytes and 1. With ``capacity`` the number of shards follows from it. Repeated rows each have a slot.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    groups = stage(
        rows.groupBy("digest").agg(F.sum("size").alias("group_size")).withColumn("one", F.lit(1).cast("bigint")),
        "shard-groups",
    )
    sizes = groups.groupBy("group_size").agg(F.count(F.lit(1)).alias("n")).toPandas()
    order = sorted(zip(sizes["group_size"].tolist(), sizes["n"].tolist(), strict=True), reverse=True)
    runs = even_fit(order, shards) if capacity is None else best_fit(order, capacity)[0]
    plan = spark.createDataFrame(
        pd.DataFrame(runs, columns=["size", "first", "groups", "shard"]).astype("int64"),
        "run_size bigint, first bigint, groups bigint, shard bigint",
    )
    numbered = running_totals(groups, [F.desc("group_size"), F.col("digest")], ["one"])
    number = F.col("cum_one") - 1
    in_run = (F.col("group_size") == F.col("run_size")) & (number >= F.col("first")) & (
        number < F.col("first") + F.col("groups")
    )
    placed = numbered.join(plan, in_run).select("digest", F.col("shard").cast("int").alias("shard"))
    dealt = rows.join(placed, "digest").withColumn("one", F.lit(1).cast("bigint"))
    slots = running_totals(dealt, [F.col("row")], ["one"], group_by=["shard"])
    return slots.select("doc_id", "size", "text_crc32", "shard", (F.col("cum_one") - 1).alias("slot"))
