"""MinHash near-dedup with an LSH forest kept as sorted orders.

1. Every text becomes a set of word shingles (64-bit hashes), reduced to 128 MinHash
   values. Texts with equal sets are one class from here on, so that groups of exact
   copies cost one row each.
2. The forest: each tree is an order of the classes by another selection of 12 of
   their MinHash values. Neighbours in an order are those with the longest common
   prefix; where many classes share a prefix the order goes deeper by itself, where
   few do a short prefix is enough. Two classes within ``window`` places that share a
   prefix of ``MIN_DEPTH`` values meet. All orders are range-partitioned together and sorted
   by (tree, key, class), so no prefix can fill a task; the rows at both ends of each
   partition are lined up once more, so that no border hides a pair. The orders are read
   twice: first only the ``FIRST`` most similar neighbours on each side meet, which joins
   most of a dense region; then, over every class that has any neighbour at all, all
   neighbours meet that are not in one group by then.
3. A 256-bit sketch (two bits of every MinHash value) drops pairs that lie five standard
   deviations below the threshold, and the set sizes drop those that cannot reach it. A profile, which
   counts the shingles by 128 hash slots, bounds from above how many two sets share: pairs
   that cannot reach the threshold by that bound need no comparison, whatever their number.
   They only tell which groups a class is next to (5).
4. The rest is confirmed on the full sets: first each class with its most similar
   partner, then the best pair between every two groups formed so far, then all pairs
   that still lie between different groups. Pairs inside a group would not change the
   result. Groups are components of the confirmed links. A pair that failed in an early
   turn is compared once more in the last one: that costs less than to look up, for every
   pair at hand, whether it was tried.
5. A second, deeper forest over the classes that had a candidate looks for links between
   different groups only: in a dense region, where many classes share long prefixes, the
   few partners of an outlier need more orders and longer keys to come next to it. Here a
   class that comes next to a group also meets that group's hubs, the members that agree
   most with a sample of it.

A pair at the threshold is missed only if it is apart in all orders of both forests.
Only classes that have a candidate send their sets; a bitmap of their row keys keeps most
other texts out of the shuffle that fetches them. Ids are expected to be unique.
In the forest a class goes by its smallest id; one without any id by a hash of its set,
so that it links others all the same.

Defined cases: a text with fewer words than a shingle is one shingle; without words it
has size 0, is linked with nothing and its own component; a row repeated as a whole
falls into one class with itself; rows of one id with different texts are one document
when they are linked; documents without an id join the component of their links, and
none of them is kept if it has an id; a component without any id is null, and the row
of the smallest row key is kept of it; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartdex.llm.components import _follow, components
from chartdex.llm.shared import Workspace, row_key
from chartdex.llm.words import mix64, words_by_text

HASHES, WINDOW, MIN_DEPTH, FIRST, SAMPLES, HUBS = 128, 8, 2, 3, 16, 4
#: Hash slots of a profile, two bits each in four longs.
SLOTS = 128
#: Bits of a piece of a bitmap over keys, as Spark's bitmaps have them, and the most pieces.
_PIECE_BITS, PIECES = 1 << 15, 1 << 10


class Forest(NamedTuple):
    """So many orders, each by so many of the MinHash values."""

    trees: int
    depth: int
    seed: int


#: The forest over all classes, and the deeper one over those that have candidates.
WIDE, DEEP = Forest(24, 12, 7), Forest(40, 24, 8)

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingle hashes, sorted; fewer words than ``size`` make one shingle."""
    if len(words) < size:
        size = len(words)
    total = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for k in range(size):
        total = mix64(total + words[k : len(words) - size + 1 + k] * _ODD[k % len(_ODD)])
    return np.unique(total)


def minhash(found: np.ndarray) -> np.ndarray:
    """16 bits of each of the smallest values under ``HASHES`` hash functions."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), 1024):
        values = np.multiply.outer(_FACTORS, found[at : at + 1024])
        values += _SHIFTS[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return (mix64(least) >> np.uint64(48)).astype(np.uint16)


def profile(found: np.ndarray) -> np.ndarray:
    """How many shingles are in each of ``SLOTS`` hash slots, modulo 4, as four words of 32 slots."""
    counts = np.bincount((found >> np.uint64(57)).astype(np.int64), minlength=SLOTS).astype(np.uint64) & np.uint64(3)
    return (counts.reshape(4, 32) << (2 * np.arange(32, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)


def within_reach(x: np.ndarray, y: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets with the profiles x and y (4 words in rows) and n shingles together may reach the similarity.

    False is certain: slot by slot the counts differ by at least the distance of their
    remainders (0, 1, 2 or 1), in sum by no more than the shingles that only one set has.
    """
    low = np.uint64(0x5555555555555555)
    odd = (x ^ y) & low  # remainders an odd distance apart: 1
    two = ((x ^ y) >> np.uint64(1)) & low & ~odd  # the same lowest bit, another upper one: 2
    differ = (np.bitwise_count(odd).astype(np.int64) + 2 * np.bitwise_count(two).astype(np.int64)).sum(axis=0)
    common = (n - differ) // 2
    return 100 * common >= percent * (n - common)


def _signatures(size: int):
    names = ["id", "r1", "r2", "n", "s1", "s2"]
    schema = pa.schema([*[(c, pa.int64()) for c in names], ("sig", pa.binary()), ("profile", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            n, s1, s2 = np.zeros(rows, np.int64), np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
            sig: list[bytes | None] = [None] * rows
            slots: list[bytes | None] = [None] * rows
            for i, words in words_by_text(batch.column(1), lower=True):
                found = shingles(words, size)
                n[i] = len(found)
                s1[i], s2[i] = mix64(found ^ _ODD[1]).sum(), np.bitwise_xor.reduce(mix64(found + _ODD[2]))
                sig[i], slots[i] = minhash(found).tobytes(), profile(found).tobytes()
            columns = [batch.column(0), batch.column(2), batch.column(3), pa.array(n)]
            columns += [pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array(sig, pa.binary()), pa.array(slots, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _sets(size: int):
    schema = pa.schema([("node", pa.int64()), ("items", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            nodes, items, held = [], [], 0
            for i, words in words_by_text(batch.column(1), lower=True):
                found = shingles(words, size).view(np.int64)
                nodes.append(ids[i].as_py())
                items.append(found)
                held += len(found)
                if held > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), _lists(items)], schema=schema)
                    nodes, items, held = [], [], 0
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), _lists(items)], schema=schema)

    return run


def _likely(rows: DataFrame, keys: DataFrame, key: str, count: int) -> DataFrame:
    """The rows whose key may be among ``count`` keys: all that are, and few others.

    A bitmap over hash slots, sixteen a key, in pieces of 4 KB that go to every task, at most
    ``PIECES``; beyond so many keys more of the other rows stay. An exact join has to follow.
    """
    pieces = min(max(-(-count * 16 // _PIECE_BITS), 1), PIECES)
    slot = F.pmod(F.xxhash64(key), F.lit(pieces * _PIECE_BITS))
    placed = lambda df, *more: df.select(*more, F.shiftright(slot, 15).alias("piece"), slot.bitwiseAND(_PIECE_BITS - 1).alias("bit"))
    # keys go to their piece first, as a sparse bitmap per task and piece would be far larger
    taken = placed(keys).repartition("piece").groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("taken"))
    byte = F.conv(F.hex(F.substr("taken", F.shiftright("bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = placed(rows, "*").join(F.broadcast(taken), "piece")
    return found.where(F.getbit(byte, F.col("bit").bitwiseAND(7).cast("int")) == 1).select(*rows.columns)


def _lists(items: list[np.ndarray]) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum([len(x) for x in items])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(items)))


_WORDS = [f"{c}{k}" for c in "kp" for k in range(4)]  # sketch and profile
_ORDER_SCHEMA = "tree int, key binary, node bigint, grp bigint, n bigint, " + ", ".join(f"{c} bigint" for c in _WORDS)
_ORDER_COLUMNS = [c.split()[0] for c in _ORDER_SCHEMA.split(", ")]


def _orders(forest: Forest):
    """The rows (node, grp, n, sig, profile) once for each tree, with the tree's key."""
    random = np.random.default_rng(forest.seed)
    positions = np.array([random.permutation(HASHES)[: forest.depth] for _ in range(forest.trees)])
    trees, width = forest.trees, 2 * forest.depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows = part.num_rows
                sig = np.frombuffer(b"".join(part.column(3).to_pylist()), dtype=np.uint16).reshape(rows, HASHES)
                pairs = (sig & 3).astype(np.uint64).reshape(rows, 4, 32)
                sketch = (pairs << (2 * np.arange(32, dtype=np.uint64))).sum(axis=2, dtype=np.uint64).view(np.int64)
                slots = np.frombuffer(b"".join(part.column(4).to_pylist()), dtype=np.int64).reshape(rows, 4)
                keys = sig[:, positions].astype(">u2").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(np.arange(trees, dtype=np.int32), rows)),
                        pa.array([keys[k : k + width] for k in range(0, len(keys), width)], pa.binary()),
                        pa.array(np.repeat(part.column(0).to_numpy(), trees)),
                        pa.array(np.repeat(part.column(1).to_numpy(), trees)),
                        pa.array(np.repeat(part.column(2).to_numpy(), trees)),
                        *[pa.array(np.repeat(x[:, k], trees)) for x in (sketch, slots) for k in range(4)],
                    ],
                    names=_ORDER_COLUMNS,
                )

    return run


def _first_of(rank: np.ndarray, row: np.ndarray, best: int) -> np.ndarray:
    """Whether each pair is among the ``best`` lowest ranks of its row."""
    order = np.lexsort((rank, row))
    row = row[order]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    place = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
    out = np.zeros(len(row), bool)
    out[order] = place < best
    return out


def _meet(table: pa.Table, percent: int, window: int, most_apart: int, best: int, fresh: int) -> tuple[np.ndarray, ...]:
    """Pairs of neighbours in a sorted table, by ``_PAIR_COLUMNS``; the first ``fresh`` rows were paired before.

    With ``best`` below the window, only pairs within reach in which each is among so many of
    the other's most similar ones on its side; a class left with no pair by that is paired with itself.
    """
    rows = table.num_rows
    tree, node, group, n = (table.column(c).to_numpy() for c in ("tree", "node", "grp", "n"))
    prefix = np.frombuffer(b"".join(k[: 2 * MIN_DEPTH] for k in table.column("key").to_pylist()), dtype=np.uint8).reshape(rows, -1)
    sketch, slots = (np.stack([table.column(f"{c}{k}").to_numpy().view(np.uint64) for k in range(4)]) for c in "kp")
    even = np.uint64(0x5555555555555555)
    out = []
    for step in range(1, window + 1):
        i = np.arange(max(0, fresh - step), rows - step)
        j = i + step
        i, j = (x[(tree[i] == tree[j]) & (group[i] != group[j]) & (prefix[i] == prefix[j]).all(axis=1)] for x in (i, j))
        small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        near = 100 * small >= percent * large
        i, j = i[near], j[near]
        x = sketch[:, i] ^ sketch[:, j]
        apart = np.bitwise_count((x | (x >> np.uint64(1))) & even).sum(axis=0, dtype=np.int64)
        close = apart <= most_apart
        out.append(np.stack([i, j, apart])[:, close])
    i, j, apart = np.concatenate(out, axis=1)
    near = within_reach(slots[:, i], slots[:, j], n[i] + n[j], percent)
    if best < window and len(i):
        x, y, apart = i[near], j[near], apart[near]
        chosen = _first_of(apart, x, best) & _first_of(apart, y, best)
        alone = np.setdiff1d(np.r_[i, j], np.r_[x[chosen], y[chosen]])
        i, j, apart = np.r_[x[chosen], alone], np.r_[y[chosen], alone], np.r_[apart[chosen], np.zeros(len(alone), np.int64)]
        near = np.ones(len(i), bool)
    i, j = np.where(node[i] <= node[j], i, j), np.where(node[i] <= node[j], j, i)
    return node[i], node[j], apart, group[i], group[j], near.astype(np.int64)


#: Two classes, sketch positions that differ, their groups, and whether they are within reach (0 or 1).
_PAIR_COLUMNS = ["a", "b", "apart", "ca", "cb", "near"]
_PAIR_SCHEMA = ", ".join(f"{c} bigint" for c in _PAIR_COLUMNS)


def _neighbours(percent: int, window: int, most_apart: int, best: int, with_ends: bool):
    """Pairs; with_ends: also the first and last rows of the partition, for its borders."""
    fields = [("tree", pa.int32()), ("key", pa.binary())] + [(c, pa.int64()) for c in _ORDER_COLUMNS[2:]]
    pair_fields = [(c, pa.int64()) for c in _PAIR_COLUMNS]
    schema = pa.schema(pair_fields + (fields if with_ends else []))

    def pairs_batch(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        columns = [pa.array(x) for x in found]
        if with_ends:
            columns += [pa.nulls(len(found[0]), kind) for _, kind in fields]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def ends_batch(table: pa.Table) -> pa.RecordBatch:
        columns = [pa.nulls(table.num_rows, kind) for _, kind in pair_fields]
        columns += [table.column(c).combine_chunks() for c in _ORDER_COLUMNS]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, first = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if with_ends and first:  # a first batch shorter than the window is covered by the last rows or the next
                yield ends_batch(table.slice(0, window))
                first = False
            before = 0 if kept is None else kept.num_rows
            table = table if kept is None else pa.concat_tables([kept, table])
            yield pairs_batch(_meet(table, percent, window, most_apart, best, before))
            kept = table.slice(max(0, table.num_rows - window))
        if with_ends and kept is not None:
            yield ends_batch(kept)

    return run


def _expected_share(percent: int) -> float:
    """Share of sketch positions that differ at the threshold; a quarter of the others agree by chance."""
    return 0.75 * (1 - percent / 100)


def candidate_pairs(
    work: Workspace, classes: DataFrame, percent: int, forest: Forest, window: int, name: str, best: int | None = None
) -> DataFrame:
    """(a, b, apart, ca, cb, near): pairs of classes that are neighbours in some order and look similar enough.

    ``classes``: (node, grp, n, sig, profile); classes of one group ``grp`` need not meet.
    ``near`` is 0 for pairs that cannot reach the similarity by their profiles, if there are any. With
    ``best`` only those that may, so many neighbours on each side, and (a, a, 0) for classes
    whose neighbours are all further.
    """
    share = _expected_share(percent)
    most_apart = int(HASHES * share + 5 * (HASHES * share * (1 - share)) ** 0.5) + 1
    order = ["tree", "key", "node"]
    sort = lambda df: df.sortWithinPartitions(*order)
    if "profile" not in classes.columns:
        classes = classes.withColumn("profile", F.unhex(F.lit("00" * (SLOTS // 4))))
    rows = classes.select("node", "grp", "n", "sig", "profile").mapInArrow(_orders(forest), _ORDER_SCHEMA)
    placed = sort(rows.repartitionByRange(*order))
    meet = lambda ends: _neighbours(percent, window, most_apart, best or window, ends)
    found = work.cut(
        placed.mapInArrow(meet(True), f"{_PAIR_SCHEMA}, {_ORDER_SCHEMA}"),
        f"{name}-neighbours",
    )
    ends = found.where(F.col("tree").isNotNull()).select(*_ORDER_COLUMNS)
    at_borders = sort(ends.distinct().repartition("tree")).mapInArrow(meet(False), _PAIR_SCHEMA)
    pairs = found.where(F.col("a").isNotNull()).select(*_PAIR_COLUMNS).union(at_borders)
    return work.cut(pairs.groupBy("a", "b").agg(*[F.min(c).alias(c) for c in _PAIR_COLUMNS[2:]]), f"{name}-pairs")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach the similarity."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    common = F.size(F.array_intersect("x", "y")).cast("bigint")
    sized = pairs.join(left, "a").join(right, "b").select("a", "b", common.alias("i"), (F.size("x") + F.size("y")).alias("s"))
    return sized.where(F.lit(100) * F.col("i") >= F.lit(percent) * (F.col("s") - F.col("i"))).select("a", "b")


def _best(pairs: DataFrame, by: list[Column]) -> DataFrame:
    best = pairs.groupBy(*by).agg(F.min(F.struct("apart", "a", "b")).alias("p"))
    return best.select("p.a", "p.b")


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many MinHash values a signature shares with the samples beside it, in sum."""
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            own = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint16).reshape(-1, HASHES)
            samples = part.column(3)
            counts = samples.value_lengths().to_numpy()
            row = np.repeat(np.arange(part.num_rows), counts)
            other = np.frombuffer(b"".join(samples.flatten().to_pylist()), np.uint16).reshape(-1, HASHES)
            same = np.bincount(row, (own[row] == other).sum(axis=1), part.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(same)], names=["node", "grp", "same"])


def _hubs(work: Workspace, members: DataFrame, samples: int, hubs: int) -> DataFrame:
    """(grp, hub): the members of each group that agree most with ``samples`` of its members.

    Such as the text that the others were made from. ``members``: (node, grp, sig). The
    samples of a group are one row, and nothing after the join needs its groups together,
    so that adaptive execution can split a large group over tasks; both ranks drop all
    but the first rows before their shuffle.
    """
    in_group = Window.partitionBy("grp")
    drawn = F.row_number().over(in_group.orderBy(F.xxhash64("node"), "node"))
    some = members.withColumn("rank", drawn).where(F.col("rank") <= samples)
    some = work.cut(some.groupBy("grp").agg(F.collect_list("sig").alias("samples")), "hub-samples")
    both = members.join(some, "grp").select("node", "grp", "sig", "samples")
    agreed = work.cut(both.mapInArrow(_agreement, "node bigint, grp bigint, same bigint"), "hub-agreed")
    rank = F.row_number().over(in_group.orderBy(F.col("same").desc(), "node"))
    return agreed.withColumn("rank", rank).where(F.col("rank") <= hubs).select("grp", F.col("node").alias("hub"))


def _hub_pairs(work: Workspace, beside: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """Classes with the hubs of the groups they are next to, if those are larger than their own.

    ``beside``: (node, own, other), a class, its group and the other one as they were once.
    A class is its own group until it is linked.
    """
    sizes = roots.groupBy("to").agg(F.count("*").alias("members"))
    # the only hub of a class alone is the neighbour itself, a pair that is compared or ruled out anyway
    linked = beside.join(roots.select(F.col("node").alias("other")), "other", "left_semi")
    sized = _follow(_follow(linked, "own", roots), "other", roots).where("own <> other").distinct()
    for side in ("own", "other"):
        size = sizes.select(F.col("to").alias(side), F.col("members").alias(f"n_{side}"))
        sized = sized.join(size, side, "left").withColumn(f"n_{side}", F.coalesce(f"n_{side}", F.lit(1)))
    larger = (F.col("n_other") > F.col("n_own")) | ((F.col("n_other") == F.col("n_own")) & (F.col("other") < F.col("own")))
    asked = sized.where(larger).select("node", F.col("other").alias("grp"))
    asked = work.cut(asked.distinct(), "hub-asked")
    members = _follow(classes.select("node", F.col("node").alias("grp"), "sig"), "grp", roots)
    groups = work.cut(asked.select("grp").distinct(), "hub-groups")
    named = _hubs(work, work.cut(members.join(groups, "grp", "left_semi"), "hub-members"), SAMPLES, HUBS)
    met = asked.join(named, "grp").where("node <> hub")
    return met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def linked_groups(
    work: Workspace,
    pairs: DataFrame,
    sets: DataFrame,
    percent: int,
    turns: tuple[str, ...],
    name: str,
    roots: DataFrame | None = None,
    classes: DataFrame | None = None,
    beside: DataFrame | None = None,
) -> DataFrame:
    """(node, to): the smallest node connected with each node by confirmed links.

    ``pairs``: (a, b, apart). ``roots``: groups found before, among ``classes``. Each turn
    confirms a choice of the pairs that still lie between groups, or those of ``beside``
    with hubs; the last one is ``rest``, all of them.
    """
    left = pairs.select("a", "b", "apart")
    for turn in turns:
        if roots is None:
            left = left.select("a", "b", "apart", F.col("a").alias("ca"), F.col("b").alias("cb"))
        elif turn != "hub":
            named = left.select("a", "b", "apart", F.col("a").alias("ca"), F.col("b").alias("cb"))
            left = work.cut(_follow(_follow(named, "ca", roots), "cb", roots).where("ca <> cb"), f"{name}-{turn}-left")
        if turn == "partner":
            chosen = _best(left, [F.col("a").alias("k")]).union(_best(left, [F.col("b").alias("k")])).distinct()
        elif turn == "group":
            chosen = _best(left, [F.least("ca", "cb").alias("k1"), F.greatest("ca", "cb").alias("k2")])
        elif turn == "hub":
            chosen = _hub_pairs(work, beside, roots, classes)
        else:
            chosen = left.select("a", "b")
        chosen = work.cut(chosen, f"{name}-{turn}-chosen")
        links = work.cut(_confirmed(chosen, sets, percent), f"{name}-{turn}-links")
        if roots is not None:
            links = _follow(_follow(links, "a", roots), "b", roots)
        steps = components(work, links, f"{name}-{turn}")
        if roots is None:
            roots = steps
        else:
            new = steps.join(roots, "node", "left_anti")
            roots = work.cut(_follow(roots, "to", steps).union(new), f"{name}-{turn}-roots")
    return roots


def _beside(pairs: DataFrame) -> DataFrame:
    """(node, own, other): each class of a pair with its group and the group it is next to."""
    sides = [pairs.select(F.col(x).alias("node"), F.col(y).alias("own"), F.col(z).alias("other")) for x, y, z in (("a", "ca", "cb"), ("b", "cb", "ca"))]
    return sides[0].union(sides[1]).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    forests: tuple[Forest, Forest] = (WIDE, DEEP),
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept (the smallest id of its component), r1, r2 (row key).

    Without an id ``kept`` is true for one row of a component that has none.
    """
    work = Workspace(docs.sparkSession, "near")
    r1, r2 = row_key(F.col(id_col), F.col(text_col))
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"), r1.alias("r1"), r2.alias("r2")
    )
    signed = work.cut(
        texts.mapInArrow(_signatures(shingle), "id bigint, r1 bigint, r2 bigint, n bigint, s1 bigint, s2 bigint, sig binary, profile binary"),
        "signatures",
    )
    least = lambda c: F.min(c).alias(c)
    keyed = signed.where("n > 0").withColumn("row", F.struct("r1", "r2"))
    hashed = F.shiftrightunsigned("s1", 2).bitwiseOR(F.lit(1 << 62))  # beyond any usual id
    classes = work.cut(
        keyed.groupBy("s1", "s2").agg(least("id"), least("n"), least("sig"), least("profile"), least("row")).withColumn("node", F.coalesce("id", hashed)),
        "classes",
    )
    named = classes.select("node", F.col("node").alias("grp"), "n", "sig", "profile")
    pairs = candidate_pairs(work, named, percent, forests[0], window, "first", min(FIRST, window))
    active = work.cut(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "active")
    asked = work.cut(classes.join(active, "node", "left_semi").select("row.r1", "row.r2", "node"), "asked")
    sets = work.cut(
        _likely(texts, asked, "r1", asked.count()).join(asked, ["r1", "r2"]).select("node", "text").mapInArrow(_sets(shingle), "node bigint, items array<bigint>"),
        "sets",
    )
    met = named.join(active, "node", "left_semi")
    compared = pairs.where("a < b").select("a", "b", "apart")
    roots = linked_groups(work, compared, sets, percent, ("partner", "group", "rest"), "first")
    beside = None
    for forest, turns, name in ((forests[0], ("group", "rest"), "wide"), (forests[1], ("hub", "rest"), "deep")):
        dense = _follow(met, "grp", roots)
        found = candidate_pairs(work, dense, percent, forest, window, name)
        sides = work.cut(_beside(found), f"{name}-beside")
        beside = sides if beside is None else beside.union(sides)
        both = compared.withColumn("tried", F.lit(True)).union(found.where("near = 1").select("a", "b", "apart", F.lit(False)))
        fresh = both.groupBy("a", "b").agg(F.min("apart").alias("apart"), F.max("tried").alias("tried")).where("not tried")
        fresh = work.cut(fresh.drop("tried"), f"{name}-fresh")
        roots = linked_groups(work, fresh, sets, percent, turns, name, roots, dense, beside)
        compared = compared.union(fresh)
    led = _follow(classes.select("s1", "s2", "id", "row", "node", F.col("node").alias("root")), "root", roots)
    led = work.cut(led, "led")
    nameless = led.where("id is null and node = root").select("root").distinct()
    renamed = led.join(nameless, "root", "left_semi").groupBy("root").agg(least("id"))
    renamed = work.cut(renamed.select("root", F.col("id").alias("smallest"), F.lit(True).alias("renamed")), "renamed")
    component_id = F.when(F.col("renamed"), F.col("smallest")).otherwise(F.col("root"))
    first = F.when(component_id.isNull() & (F.col("node") == F.col("root")), F.col("row"))
    labels = led.join(renamed, "root", "left").select("s1", "s2", component_id.alias("component_id"), first.alias("first"))
    joined = signed.select("id", "r1", "r2", "n", "s1", "s2").join(work.cut(labels, "labels"), ["s1", "s2"], "left")
    component_id = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    nobody = F.when(F.col("n") > 0, F.struct("r1", "r2").eqNullSafe(F.col("first"))).otherwise(True)
    kept = F.when(F.col("id").isNull(), nobody).otherwise(F.col("id").eqNullSafe(component_id))
    return joined.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component_id.alias("component_id"),
        kept.alias("kept"),
        "r1",
        "r2",
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are kept, with all their columns; a row repeated as a whole stays once."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    kept = found.where("kept").select("r1", "r2").distinct()
    r1, r2 = row_key(F.col("doc")[id_col], F.col("doc")[text_col])
    keyed = docs.select(F.struct("*").alias("doc")).select("doc", r1.alias("r1"), r2.alias("r2"))
    twin = F.row_number().over(Window.partitionBy("r1", "r2").orderBy(F.col("doc")[id_col]))
    return keyed.join(kept, ["r1", "r2"], "left_semi").withColumn("twin", twin).where("twin = 1").select("doc.*")
