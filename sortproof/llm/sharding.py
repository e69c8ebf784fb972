"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Method: groups of documents with equal texts never part; sorted by size,
largest first, each enters the bin with the tightest remaining capacity that
still holds it, found in a balanced tree of the bins.

* Group sizes are one aggregation with partial sums per task, so a group that
  holds a third of all rows costs one row per task.
* Only a bounded table reaches the driver's packing: with ``parts`` = M, at
  most M groups are as large as 1/M of all bytes and are packed one by one;
  the smaller groups are first put together by the hash of their text into M
  bundles, each indivisible in turn.  So 2 M items at most, whatever the size
  of the corpus.
* With a given number of shards an item above the even share of what remains
  has a shard of its own; for the rest the capacity is the smallest one at which
  best-fit-decreasing needs no more bins (``pack_evenly``).  With a given
  capacity the number of bins is what comes out (``pack_fixed``); M is then at
  least 64 for each shard's capacity, so no bundle is near it, and M beyond
  ``parts`` is packed in tasks of about ``parts`` large groups and as many
  bundles, dealt by hash, each with shards of its own.
* Slots count documents through a shard without a gap.  Every shard is cut
  into hash ranges whose counts are prefix-summed, so no task holds a shard.

Cases: a null text is of size 1 and in one group with empty texts; rows with
equal ids and texts are separate documents of one group; null ids sort first;
an empty table gives an empty table; other columns are not looked at.  A
group larger than an even share of all bytes fills a shard of its own, and
the others are even among themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sortproof._pickling import ship_by_value
from sortproof.llm.columns import utf8_bytes
from sortproof.session import scratch_path, write_and_read

#: Large groups and bundles of small ones: as many of each at most.
PARTS = 16_384
#: With a given capacity, bundles of small groups have about this part of it at most.
BUNDLES_PER_SHARD = 64
#: Documents that one window partition numbers, about.
ROWS_PER_RANGE = 100_000


class FreeSpace:
    """Bins by remaining capacity in a balanced (AVL) tree; finds the tightest that still fits."""

    def __init__(self) -> None:
        self._root: list | None = None  # [key, left, right, height]

    @staticmethod
    def _height(node: list | None) -> int:
        return node[3] if node else 0

    def _rise(self, node: list) -> list:
        """The node's subtree in balance again, after a change below it."""
        node[3] = 1 + max(self._height(node[1]), self._height(node[2]))
        lean = self._height(node[1]) - self._height(node[2])
        if abs(lean) < 2:
            return node
        heavy, light = (1, 2) if lean > 0 else (2, 1)
        child = node[heavy]
        if self._height(child[light]) > self._height(child[heavy]):
            node[heavy] = self._turn(child, light, heavy)
        return self._turn(node, heavy, light)

    def _turn(self, node: list, up: int, down: int) -> list:
        top = node[up]
        node[up], top[down] = top[down], node
        for x in (node, top):
            x[3] = 1 + max(self._height(x[1]), self._height(x[2]))
        return top

    def add(self, space: int, number: int) -> None:
        def put(node: list | None) -> list:
            if node is None:
                return [(space, number), None, None, 1]
            side = 1 if (space, number) < node[0] else 2
            node[side] = put(node[side])
            return self._rise(node)

        self._root = put(self._root)

    def _remove(self, key: tuple[int, int]) -> None:
        def cut(node: list | None, k: tuple[int, int]) -> list | None:
            if node is None:
                return None
            if k == node[0]:
                if node[1] is None or node[2] is None:
                    return node[1] or node[2]
                least = node[2]
                while least[1]:
                    least = least[1]
                node[0] = least[0]
                node[2] = cut(node[2], least[0])
            else:
                side = 1 if k < node[0] else 2
                node[side] = cut(node[side], k)
            return self._rise(node)

        self._root = cut(self._root, key)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return (space, number) of the tightest bin with room for ``size``."""
        node, best = self._root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[1]
            else:
                node = node[2]
        if best:
            self._remove(best)
        return best


def best_fit(sizes: Sequence[int], capacity: int, max_bins: int | None = None) -> list[int] | None:
    """Bin of every item, for sizes in falling order; None if ``max_bins`` don't do.

    A new bin opens only when no open one has room.  An item above the
    capacity gets a bin of its own.
    """
    tree, bins, out = FreeSpace(), 0, []
    for size in sizes:
        found = tree.take(size)
        if found is None:
            if max_bins is not None and bins >= max_bins:
                return None
            found = (max(capacity, size), bins)
            bins += 1
        tree.add(found[0] - size, found[1])
        out.append(found[1])
    return out


def pack_fixed(sizes: Sequence[int], capacity: int) -> list[int]:
    """Bins of the given capacity, as few as best-fit-decreasing finds."""
    return best_fit(sizes, capacity) or []


def _least_capacity(sizes: Sequence[int], bins: int) -> list[int]:
    """Bins of the smallest capacity at which best-fit-decreasing needs no more than ``bins``."""
    low, high = max(sizes[0], -(-sum(sizes) // bins)), sum(sizes)
    best = best_fit(sizes, high, bins)
    while low < high:
        middle = (low + high) // 2
        found = best_fit(sizes, middle, bins)
        if found is None:
            low = middle + 1
        else:
            best, high = found, middle
    return best or [0] * len(sizes)


def pack_evenly(sizes: Sequence[int], bins: int) -> list[int]:
    """At most ``bins`` bins as even as the items allow, for sizes in falling order.

    An item above the even share of what remains has a bin of its own.  The
    rest takes the smallest capacity at which best-fit-decreasing succeeds; if
    that leaves bins apart by more than an item, the fullest is settled and
    the others are packed again.
    """
    out, left, done = [0] * len(sizes), list(range(len(sizes))), 0
    rest = sum(sizes)
    while len(left) > 1 and bins - done > 1 and sizes[left[0]] * (bins - done) > rest:
        rest -= sizes[left[0]]
        out[left[0]] = done
        left, done = left[1:], done + 1
    while left:
        own = [sizes[i] for i in left]
        found = _least_capacity(own, bins - done)
        loads = [0] * (bins - done)
        for size, b in zip(own, found, strict=True):
            loads[b] += size
        if max(loads) - min(loads) <= own[0]:
            for i, b in zip(left, found, strict=True):
                out[i] = done + b
            break
        full = loads.index(max(loads))
        for i, b in zip(left, found, strict=True):
            if b == full:
                out[i] = done
        left, done = [i for i, b in zip(left, found, strict=True) if b != full], done + 1
    return out


def _bundle(key: str, parts: int):
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _pack_pieces(items: DataFrame, capacity: int, pieces: int) -> DataFrame:
    """Shard of every item, packed by task in ``pieces`` parts of the items."""
    spark = items.sparkSession

    def pack(piece: pd.DataFrame) -> pd.DataFrame:
        piece = piece.assign(_a=piece["_key"].fillna(""), _b=piece["_bundle"].fillna(0))
        piece = piece.sort_values(["bytes", "_a", "_b"], ascending=[False, True, True])
        return piece.assign(bin=pack_fixed(piece["bytes"].tolist(), capacity))[["_piece", "_key", "_bundle", "bin"]]

    placed = write_and_read(
        items.withColumn("_piece", F.pmod(F.xxhash64("_key", "_bundle"), F.lit(pieces)).cast("int"))
        .groupBy("_piece").applyInPandas(pack, "_piece int, _key string, _bundle int, bin int"),
        scratch_path(spark, "shard-pieces"),
    )
    used = sorted(placed.groupBy("_piece").agg(F.max("bin").alias("last")).collect())  # a row per piece
    starts = [0, *accumulate(r["last"] + 1 for r in used)]
    first = spark.createDataFrame([(r["_piece"], at) for r, at in zip(used, starts)], "_piece int, _first int")
    return placed.join(F.broadcast(first), "_piece").select("_key", "_bundle", (F.col("_first") + F.col("bin")).alias("shard"))


def _pack_groups(
    sized: DataFrame, shards: int | None, capacity: int | None, parts: int
) -> tuple[DataFrame, DataFrame | None, int, int]:
    """Shard of every item (``_key`` of a large group or ``_bundle`` of small ones), in at most 2 ``parts`` rows
    and, if there are more, a table of the others; number of bundles; number of rows."""
    spark = sized.sparkSession
    groups = write_and_read(
        sized.groupBy("_key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")),
        scratch_path(spark, "shard-groups"),
    )
    total, rows = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bundles = parts if shards else max(parts, -(-BUNDLES_PER_SHARD * total // int(capacity)))
    least = -(-total // bundles)
    large = groups.where(F.col("bytes") >= least)  # so as many rows as bundles at most
    small = groups.where(F.col("bytes") < least).groupBy(_bundle("_key", bundles).alias("_bundle"))
    items = (
        large.select("_key", F.lit(None).cast("int").alias("_bundle"), "bytes")
        .unionByName(small.agg(F.sum("bytes").alias("bytes")).select(F.lit(None).cast("string").alias("_key"), "_bundle", "bytes"))
    )
    if capacity:
        items = items.withColumn("bytes", F.when(
            F.col("_bundle").isNotNull() & (F.col("bytes") > int(capacity)),
            F.raise_error(F.lit("a bundle of documents exceeds the capacity of a shard")).cast("long"),
        ).otherwise(F.col("bytes")))
    if bundles > parts:
        packed = write_and_read(_pack_pieces(items, int(capacity), -(-bundles // parts)), scratch_path(spark, "shard-packed"))
        # groups with many rows are among those with many bytes: these are broadcast
        great = groups.where(F.col("bytes") >= -(-total // parts)).select("_key")
        return packed.join(F.broadcast(great), "_key", "left_semi"), packed.join(F.broadcast(great), "_key", "left_anti"), bundles, rows
    items = items.collect()
    items.sort(key=lambda r: (-r["bytes"], r["_key"] or "", r["_bundle"] or 0))
    sizes = [r["bytes"] for r in items]
    bins = pack_evenly(sizes, shards) if shards else pack_fixed(sizes, int(capacity))
    packed = spark.createDataFrame(
        [(r["_key"], r["_bundle"], b) for r, b in zip(items, bins, strict=True)],
        "_key string, _bundle int, shard int",
    )
    return packed, None, bundles, rows


def shard_documents(
    docs: DataFrame, shards: int | None = 8, capacity: int | None = None, parts: int = PARTS
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every document of ``doc_id, text``.

    Give either the number of ``shards`` or their ``capacity`` in bytes.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    spark: SparkSession = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        "doc_id",
        (utf8_bytes(F.col("text")) + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("_key"),
    )
    packed, others, bundles, rows = _pack_groups(sized.select("_key", "size"), shards, capacity, parts)
    def of_group(items: DataFrame, name: str) -> DataFrame:
        return items.where(F.col("_key").isNotNull()).select("_key", F.col("shard").alias(name))

    def of_bundle(items: DataFrame) -> DataFrame:
        return items.where(F.col("_bundle").isNotNull()).select("_bundle", F.col("shard").alias("_shared"))

    ranges = max(8, rows // ROWS_PER_RANGE)
    # at most ``parts`` short rows each
    placed = sized.withColumn("_bundle", _bundle("_key", bundles)).join(F.broadcast(of_group(packed, "_own")), "_key", "left")
    if others is None:
        placed = placed.join(F.broadcast(of_bundle(packed)), "_bundle", "left")
    else:
        placed = placed.join(of_group(others, "_next"), "_key", "left").withColumn("_own", F.coalesce("_own", "_next"))
        # rows of the great groups, which have a shard, are dealt by document
        salted = placed.withColumn("_bundle", F.when(F.col("_own").isNull(), F.col("_bundle")).otherwise(-1 - F.pmod(F.xxhash64("doc_id", "_key"), F.lit(bundles))).cast("int"))
        placed = salted.join(of_bundle(others), "_bundle", "left")
    placed = (
        placed
        .select(
            "doc_id", "size", "text_crc32", "_key",
            F.coalesce("_own", "_shared").alias("shard"),
            F.pmod(F.xxhash64("doc_id", "_key"), F.lit(ranges)).cast("int").alias("_range"),
        )
    )
    placed = write_and_read(placed, scratch_path(spark, "shard-rows"))
    earlier = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "_range").agg(F.count("*").alias("_n")).select(
        "shard", "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("shard", "_range").orderBy("doc_id", "_key")
    return placed.withColumn("_place", F.row_number().over(inside) - 1).join(starts, ["shard", "_range"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_start") + F.col("_place")).cast("long").alias("slot")
    )


def sharding_digest(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The operator's result under the law ``bytes``: shards near equal in bytes."""
    return shard_documents(docs.select("doc_id", "text"), shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


ship_by_value(__name__)
