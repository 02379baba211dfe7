"""Minimax contiguous partition of documents into shards of near-equal bytes.

Documents with equal texts are one atomic group (a null text counts as an empty
one). Groups stand in the order of a 128-bit hash of their text. The smallest shard
capacity for which a greedy walk over the ordered group sizes needs no more shards
than allowed is found by binary search, and the order is cut there: each cut lies at
the group border nearest to an equal share of what is left, as long as that capacity
still suffices for the rest.

The walk needs only "the last group border at or before x". The driver holds the sum
of bytes for each of ``2**bucket_bits`` hash ranges (a fixed number) and, of the few
ranges that a cut can fall into, the group sizes; groups and rows stay distributed.

Defined cases: null text has size 1 and CRC 0; null ids are kept; rows that repeat an
id or a whole row are rows of their own with their own slots; fewer groups than shards
leave shards empty; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartdex.llm.shared import Workspace, hash_pair


class GroupBorders:
    """Borders between ordered groups as byte positions, exact where a range has been fetched.

    ``floor`` and ``ceil`` answer with the border of the enclosing range while that
    range's groups are unknown, and note it in ``missing``.
    """

    def __init__(self, ranges: list[tuple[int, int]]):
        self.ids = [b for b, _ in ranges]
        self.starts = [0, *accumulate(n for _, n in ranges)]
        self.total = self.starts[-1]
        self.ends: dict[int, list[int]] = {}
        self.keys: dict[int, list[tuple[int, int]]] = {}
        self.missing: set[int] = set()

    def add(self, range_id: int, groups: list[tuple[int, int, int]]) -> None:
        """Groups ``(h1, h2, bytes)`` of one range."""
        i = bisect_left(self.ids, range_id)
        groups = sorted(groups)
        self.ends[i] = [self.starts[i] + n for n in accumulate(g[2] for g in groups)]
        self.keys[i] = [g[:2] for g in groups]

    def _inside(self, x: int) -> int | None:
        """Index of the range that x falls strictly inside of."""
        i = bisect_right(self.starts, x) - 1
        return None if self.starts[i] == x else i

    def floor(self, x: int) -> int:
        i = self._inside(x)
        if i is None:
            return x
        if i not in self.ends:
            self.missing.add(i)
            return self.starts[i]
        j = bisect_right(self.ends[i], x)
        return self.ends[i][j - 1] if j else self.starts[i]

    def ceil(self, x: int) -> int:
        i = self._inside(x)
        if i is None:
            return x
        if i not in self.ends:
            self.missing.add(i)
            return self.starts[i + 1]
        return self.ends[i][bisect_left(self.ends[i], x)]

    def key_at(self, border: int, range_bits: int) -> tuple[int, int] | None:
        """Key of the first group at or after a border; None at the very end."""
        if border >= self.total:
            return None
        i = self._inside(border)
        if i is None:
            return self.ids[bisect_left(self.starts, border)] << (64 - range_bits), -(1 << 63)
        return self.keys[i][bisect_right(self.ends[i], border)]


def fits(borders: GroupBorders, capacity: int, shards: int, start: int = 0) -> bool:
    """Whether a greedy walk from ``start`` needs at most ``shards`` shards."""
    for _ in range(shards):
        if start >= borders.total:
            return True
        start = borders.floor(min(borders.total, start + capacity))
    return start >= borders.total


def smallest_capacity(borders: GroupBorders, shards: int, largest: int) -> int:
    low = max(-(-borders.total // shards), largest)
    high = max(low, -(-borders.total // shards) + largest)
    while low < high:
        middle = (low + high) // 2
        if fits(borders, middle, shards):
            high = middle
        else:
            low = middle + 1
    return low


def cut_positions(borders: GroupBorders, shards: int, capacity: int) -> list[int]:
    """The borders at which shards 1, 2, … begin."""
    cuts, start = [], 0
    for left in range(shards, 1, -1):
        most = borders.floor(min(borders.total, start + capacity))
        aim = start + (borders.total - start) // left
        below, above = borders.floor(aim), borders.ceil(aim)
        near = below if aim - below <= above - aim else above
        near = min(near, most)
        start = near if fits(borders, capacity, left - 1, near) else most
        cuts.append(start)
    return cuts


def find_cuts(groups: DataFrame, shards: int, bucket_bits: int) -> tuple[int, list[tuple[int, int] | None]]:
    """The smallest capacity and the key at which each shard but the first begins."""
    ranges = groups.groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest")).collect()
    borders = GroupBorders(sorted((r["bucket"], r["bytes"]) for r in ranges))
    if not borders.total:
        return 0, [None] * (shards - 1)
    largest = max(r["largest"] for r in ranges)
    while True:
        borders.missing.clear()
        capacity = smallest_capacity(borders, shards, largest)
        cuts = cut_positions(borders, shards, capacity)
        if not borders.missing:
            return capacity, [borders.key_at(c, bucket_bits) for c in cuts]
        wanted: dict[int, list] = {borders.ids[i]: [] for i in borders.missing}
        for r in groups.where(F.col("bucket").isin(*wanted)).select("bucket", "h1", "h2", "bytes").collect():
            wanted[r["bucket"]].append((r["h1"], r["h2"], r["bytes"]))
        for range_id, found in wanted.items():
            borders.add(range_id, found)


def _shard_of(keys: list[tuple[int, int] | None]) -> Column:
    h1, h2 = F.col("h1"), F.col("h2")
    passed = [F.when((h1 > k[0]) | ((h1 == k[0]) & (h2 >= k[1])), 1).otherwise(0) for k in keys if k is not None]
    return sum(passed, F.lit(0)).cast("int")


def shard_documents(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_bits: int = 16,
    salts: int = 256,
) -> DataFrame:
    """One row per document: id, size, text_crc32, shard, and its slot within the shard.

    Slots are numbered within ``salts`` parts of each shard, by id, and shifted by
    the counts of the parts before, so a shard of any size is numbered in parallel.
    """
    work = Workspace(docs.sparkSession, "shards")
    text = F.coalesce(F.col(text_col), F.lit(""))
    h1, h2 = hash_pair(text)
    rows = work.cut(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).cast("bigint").alias("text_crc32"),
            h1.alias("h1"),
            h2.alias("h2"),
        ),
        "rows",
    )
    groups = work.cut(
        rows.groupBy("h1", "h2")
        .agg(F.sum("size").alias("bytes"))
        .withColumn("bucket", F.shiftright("h1", 64 - bucket_bits)),
        "groups",
    )
    _, keys = find_cuts(groups, shards, bucket_bits)
    salt = F.pmod(F.xxhash64("id", "h1"), F.lit(salts)).cast("int")
    placed = rows.select("*", _shard_of(keys).alias("shard"), salt.alias("salt"))
    before = Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = work.cut(
        placed.groupBy("shard", "salt")
        .agg(F.count("*").alias("n"))
        .select("shard", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias("first_slot")),
        "offsets",
    )
    within = Window.partitionBy("shard", "salt").orderBy("id", "h1", "h2")
    return (
        placed.withColumn("place", F.row_number().over(within) - 1)
        .join(offsets, ["shard", "salt"])
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            "shard",
            (F.col("first_slot") + F.col("place")).cast("bigint").alias("slot"),
        )
    )
