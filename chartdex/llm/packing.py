"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted. A document longer than the longest of them is
cut into pieces of that length and a rest. Pieces are placed in decreasing length, each
into the open bin that it fits most tightly. If none has room, a new bin is opened, of
the permitted length at which a token is cheapest once the bin is filled up with the
lengths still waiting. At the end every bin shrinks to the smallest permitted length
that holds its contents.

Placement depends on lengths only, so it is planned on the histogram of lengths, which
has at most as many rows as the longest sequence has tokens, whatever the corpus. Equal
pieces are placed many at a time: one entry of the plan says that the pieces number
``first`` to ``first + n`` of one length go, ``per_bin`` together, into consecutive bins.
Each entry uses up a length, or all bins of one kind (whose free room it at least
halves), or splits a kind once; with L lengths there are O(L log L) entries, at most
about 40 L, however many documents there are. That bounds the table every task gets.

Pieces are numbered within their length in ``salts`` parts, so that a length shared by
a third of all pieces is numbered in parallel.

Defined cases: a text without words (or null) is one piece of length 0 in no bin
(bin_id, bin_capacity and bin_start null); repeated rows are placed one by one; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartdex.llm.shared import Workspace, word_count

CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence: its tokens, a share that grows with their square, and a fixed part.
TOKEN_COST, SQUARE_COST, BIN_COST = 1.0, 1.0 / 32768, 32.0


def bin_cost(capacity: int) -> float:
    return TOKEN_COST * capacity + SQUARE_COST * capacity * capacity + BIN_COST


@dataclass
class Plan:
    """Entries sorted by (length, first), and the bins in ranges of equal final capacity."""

    entries: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)  # length, first, n, per_bin, bin, start
    ranges: list[tuple[int, int]] = field(default_factory=list)  # first bin, capacity
    n_bins: int = 0


def _cheapest(length: int, waiting: dict[int, int], order: list[int], capacities: tuple[int, ...]) -> tuple[int, dict[int, int]]:
    """The capacity to open for pieces of a length, and what such a bin would take of each length."""
    best, best_fill, best_price = 0, {}, float("inf")
    for capacity in capacities:
        if capacity < length:
            continue
        room, fill, largest = capacity, {}, length
        while room > 0:
            i = bisect_left(order, min(room, largest) + 1) - 1
            while i >= 0 and waiting[order[i]] <= fill.get(order[i], 0):
                i -= 1
            if i < 0:
                break
            n = min(waiting[order[i]], room // order[i])
            fill[order[i]] = n
            room -= n * order[i]
            largest = order[i] - 1
            if largest <= 0:
                break
        used = capacity - room
        price = bin_cost(min(c for c in capacities if c >= used)) / used
        if price <= best_price:
            best, best_fill, best_price = capacity, fill, price
    return best, best_fill


def plan_bins(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES) -> Plan:
    """Place ``histogram[length]`` pieces of each length."""
    capacities = tuple(sorted(capacities))
    plan = Plan()
    waiting = {length: n for length, n in histogram.items() if n > 0}  # not yet counted on by an open bin
    order = sorted(waiting)
    rooms: list[int] = []  # free room of open bins, ascending
    bins: dict[int, list[tuple[int, int, int]]] = {}  # room -> (first bin, bins, capacity)

    def put(room: int, first: int, n: int, capacity: int) -> None:
        if room not in bins:
            insort(rooms, room)
        bins.setdefault(room, []).append((first, n, capacity))

    for length in sorted(histogram, reverse=True):
        left, first = histogram[length], 0
        while left > 0:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                capacity, fill = _cheapest(length, waiting | {length: max(left, 1)}, order, capacities)
                per_bin = max(1, fill.get(length, 1))
                count = max(1, left // per_bin)
                for other, n in fill.items():
                    if other != length:
                        count = max(1, min(count, waiting[other] // n))
                for other, n in fill.items():
                    waiting[other] = max(0, waiting[other] - n * count)
                put(capacity, plan.n_bins, count, capacity)
                plan.n_bins += count
                continue
            room = rooms[i]
            start_bin, count, capacity = bins[room].pop()
            if not bins[room]:
                del bins[room]
                rooms.pop(i)
            per_bin = room // length
            full = min(count, left // per_bin)
            if full:
                plan.entries.append((length, first, full * per_bin, per_bin, start_bin, capacity - room))
                put(room - per_bin * length, start_bin, full, capacity)
                first, left = first + full * per_bin, left - full * per_bin
                start_bin, count = start_bin + full, count - full
            if count and left:
                plan.entries.append((length, first, left, left, start_bin, capacity - room))
                put(room - left * length, start_bin, 1, capacity)
                start_bin, count, first, left = start_bin + 1, count - 1, first + left, 0
            if count:
                put(room, start_bin, count, capacity)
        waiting[length] = 0
    plan.entries.sort()
    for room, kinds in bins.items():
        for start_bin, _, capacity in kinds:
            plan.ranges.append((start_bin, next(c for c in capacities if c >= capacity - room)))
    plan.ranges.sort()
    return plan


def pack_documents(
    docs: DataFrame,
    capacities: tuple[int, ...] = CAPACITIES,
    length_col: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 256,
) -> DataFrame:
    """One row per piece: id, n_tokens, piece, piece_start, length, bin_id, bin_capacity, bin_start.

    Tokens are words unless ``length_col`` names a column with lengths.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "packing")
    most = max(capacities)
    n_tokens = word_count(F.col(text_col)) if length_col is None else F.coalesce(F.col(length_col), F.lit(0)).cast("bigint")
    last = F.greatest(F.ceil(F.col("n_tokens") / most) - 1, F.lit(0))
    length = F.least(F.lit(most), F.col("n_tokens") - F.col("piece") * most)
    pieces = work.cut(
        docs.select(F.col(id_col).alias("id"), n_tokens.alias("n_tokens"))
        .select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
        .select(
            "*",
            length.cast("int").alias("length"),
            F.pmod(F.xxhash64(F.lit(5), "id", "piece"), F.lit(salts)).cast("int").alias("salt"),
        ),
        "pieces",
    )
    counts = work.cut(pieces.groupBy("length", "salt").agg(F.count("*").alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.where("length > 0").groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_bins(histogram, capacities)
    entries = np.array(plan.entries, dtype=np.int64).reshape(-1, 6)
    ranges = np.array(plan.ranges, dtype=np.int64).reshape(-1, 2)
    shared = spark.sparkContext.broadcast((entries, ranges))

    @F.pandas_udf("struct<bin_id bigint, bin_capacity int, bin_start int>")
    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        table, spans = shared.value
        size, number = lengths.to_numpy(np.int64), numbers.to_numpy(np.int64)
        out = pd.DataFrame({"bin_id": pd.array([pd.NA] * len(size), "Int64")})
        out["bin_capacity"] = out["bin_start"] = pd.array([pd.NA] * len(size), "Int32")
        held = size > 0
        if held.any():
            size, number = size[held], number[held]
            # entries of a length are consecutive; numbers start at 0 in each
            begin = np.searchsorted(table[:, 0], size)
            key = np.zeros(len(size), np.int64)
            for value in np.unique(size):
                rows = size == value
                own = table[begin[rows][0] : np.searchsorted(table[:, 0], value, "right"), 1]
                key[rows] = np.searchsorted(own, number[rows], "right") - 1
            e = table[begin + key]
            inside = number - e[:, 1]
            bin_id = e[:, 4] + inside // e[:, 3]
            out.loc[held, "bin_id"] = bin_id
            out.loc[held, "bin_capacity"] = spans[np.searchsorted(spans[:, 0], bin_id, "right") - 1, 1].astype(np.int32)
            out.loc[held, "bin_start"] = (e[:, 5] + inside % e[:, 3] * size).astype(np.int32)
        return out

    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = work.cut(
        counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias("offset")), "offsets"
    )
    within = Window.partitionBy("length", "salt").orderBy("id", "piece", "n_tokens")
    numbered = (
        pieces.withColumn("place", F.row_number().over(within) - 1)
        .join(offsets, ["length", "salt"])
        .withColumn("number", F.col("offset") + F.col("place"))
    )
    return numbered.withColumn("bin", place("length", "number")).select(
        F.col("id").alias(id_col),
        "n_tokens",
        F.col("piece").cast("int").alias("piece"),
        (F.col("piece") * most).cast("bigint").alias("piece_start"),
        "length",
        "bin.bin_id",
        "bin.bin_capacity",
        "bin.bin_start",
    )
