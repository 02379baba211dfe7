"""Removal of long repeated passages by a distributed merge sort of suffixes.

A passage is a string of ``length`` bytes that starts at two places at least, in one
document or in two. Every byte that a passage covers goes. Texts are compared as bytes.

* Anchors. Of ``window`` consecutive places the one whose next bytes have the smallest hash
  is an anchor; it is the anchor of all starts whose window it wins. Equal passages have
  equal windows, so their anchors stand at equal distances from their starts, and to find
  the passages it is enough to sort the suffixes at the anchors, each together with the
  bytes before it that its starts reach back to. All equal passages of an anchor share the
  ``length - window + 1`` bytes behind it; an anchor whose such bytes are found nowhere
  else is done with. These counts are small rows, counted before they are shuffled.
* Runs. A task sorts the suffixes of its texts in runs of bounded size, joins equal ones
  to one (their starts are repeated for sure) and writes them front-coded: the length of
  the prefix shared with the suffix before, and the rest.
* Exchange. First suffixes of blocks, a regular sample of the sorted runs, give the
  borders of ranges. Blocks go to their range still front-coded; only blocks over a border
  are cut.
* Merge. Each range merges its runs with a loser tree whose entries carry the prefix they
  share with the last suffix put out. The longer shared prefix wins unseen; equal ones
  are compared from there on, so no known prefix is looked at twice.
* Starts. The merge gives sorted suffixes with their shared prefixes; the bytes before the
  anchors are ordered likewise. For each distance from the anchor, suffixes of one class
  in both orders hold the same passage there. A class that may go on beyond a border
  is settled by a hash of its passage, counted over all ranges.

A text that occurs twice or more is one text with a mark, so a group of copies, however
large, is sorted once. A passage in a third of all documents is one suffix per run for
each anchor inside, and is spread over ranges by what surrounds it. Ranges, runs and
batches have a bounded number of entries.

Defined cases: a null text is empty; an empty text or one shorter than ``length`` loses
nothing; a repeated row is a document of its own, and so its text is repeated; a passage
may overlap itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartdex.llm.shared import Workspace, hash_pair
from chartdex.llm.words import _power_tables, mix64

#: Bytes hashed at once; places within them take ``_PLACE_BITS``.
CHUNK = 1 << 19
_PLACE_BITS = 20
#: Suffixes of a run, of a block, of a range (as planned), and classified at once.
RUN, BLOCK, RANGE, BATCH = 1 << 14, 1 << 8, 1 << 13, 1 << 14
#: Block heads that the driver sees to choose the borders of ranges.
HEADS = 1 << 14
_END = b"\xff"  # in no UTF-8 text
_META = np.dtype([("t1", "<i8"), ("t2", "<i8"), ("q", "<i4"), ("lo", "u1"), ("hi", "u1"), ("many", "u1")])
_BLOCKS = "run bigint, seq int, n int, head binary, last binary, shared binary, sizes binary, rests binary, meta binary"
_SPAN = "t1 bigint, t2 bigint, s int, e int"
_TEXT = ["t1", "t2"]


def shape_of(length: int) -> tuple[int, int, int]:
    """window, core (bytes behind an anchor that equal passages share) and gram for a passage length."""
    window = min(256, max(1, 5 * length // 8))
    core = length - window + 1
    return window, core, min(16, core)


class _Hashes:
    """Polynomial hashes of any substring of some bytes."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, size: int) -> np.ndarray:
        return mix64((self.sums[start + size] - self.sums[start]) * self.down[start])


def anchors(data: np.ndarray, first: np.ndarray, stop: np.ndarray, length: int):
    """(part, place, first start, last start, core hash) of the anchors in parts of some bytes.

    Starts of part i lie in ``[first[i], stop[i] - length]``.
    """
    window, core, gram = shape_of(length)
    n = len(data) - gram + 1
    marks = np.zeros(len(data) + 1, dtype=np.int32)
    fits = stop - first >= length
    np.add.at(marks, first[fits], 1)
    np.add.at(marks, stop[fits] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(marks[:-1]))
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none.astype(np.uint64)
    hashes = _Hashes(data)
    mask = np.uint64((1 << _PLACE_BITS) - 1)
    places = np.arange(n)
    values = (hashes.of(places, gram) & ~mask) | places.astype(np.uint64)
    padded = np.full(-(-n // window) * window, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, window)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    best = np.minimum(backward[starts], forward[starts + window - 1])
    owner = (best & mask).astype(np.int64)
    part = np.searchsorted(first, starts, "right") - 1
    new = np.flatnonzero((np.diff(owner) != 0) | (np.diff(part) != 0) | (np.diff(starts) != 1)) + 1
    begin, end = np.r_[0, new], np.r_[new, len(starts)] - 1
    place = owner[begin]
    return part[begin], place, starts[begin], starts[end], hashes.of(place, core)


def _parts(offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, first, stop) of parts of texts, together in bounded chunks; long texts in parts that overlap."""
    texts, firsts, stops, start = [], [], [], 0
    for i in range(len(offsets) - 1):
        at, end = int(offsets[i]), int(offsets[i + 1])
        while end - at >= length:
            stop = min(end, at + CHUNK)
            if texts and stop - start > CHUNK:
                yield np.array(texts), np.array(firsts), np.array(stops)
                texts, firsts, stops = [], [], []
            if not texts:
                start = at
            texts.append(i)
            firsts.append(at)
            stops.append(stop)
            if stop == end:
                break
            at = stop - length + 1
    if texts:
        yield np.array(texts), np.array(firsts), np.array(stops)


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    return np.frombuffer(body, dtype=np.uint8) if body else np.zeros(0, np.uint8), offsets


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = (batch.column(i).to_numpy() for i in (0, 1))
            data, offsets = _buffers(batch.column(2))
            for text, first, stop in _parts(offsets, length):
                base = int(first[0])
                part, place, begin, end, core = anchors(data[base : int(stop.max())], first - base, stop - base, length)
                own = text[part]
                yield pa.record_batch(
                    [
                        pa.array(t1[own]),
                        pa.array(t2[own]),
                        pa.array((place + base - offsets[own]).astype(np.int32)),
                        pa.array((place - end).astype(np.int16)),
                        pa.array((place - begin).astype(np.int16)),
                        pa.array(core.view(np.int64)),
                    ],
                    names=["t1", "t2", "q", "lo", "hi", "core"],
                )

    return run


def shared_prefix(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix, of which ``at`` bytes are known."""
    n = min(len(a), len(b))
    while at < n:
        x, y = a[at : at + 64], b[at : at + 64]
        if x == y:
            at += 64
            continue
        m = min(len(x), len(y))
        differ = int.from_bytes(x[:m]) ^ int.from_bytes(y[:m])
        return at + m - (differ.bit_length() + 7) // 8
    return n


def _coded(keys: list[bytes], shared: list[int], meta: np.ndarray, run: int, seq: int) -> dict:
    """A block: front-coded keys, the first one whole."""
    rests = [keys[0], *[k[s:] for k, s in zip(keys[1:], shared[1:])]]
    return {
        "run": run,
        "seq": seq,
        "n": len(keys),
        "head": keys[0],
        "last": keys[-1],
        "shared": np.array([0, *shared[1:]], "<u2").tobytes(),
        "sizes": np.array([len(r) for r in rests], "<u2").tobytes(),
        "rests": b"".join(rests),
        "meta": meta.tobytes(),
    }


def _uncoded(block: dict) -> tuple[list[bytes], list[int], np.ndarray]:
    shared = np.frombuffer(block["shared"], "<u2").tolist()
    ends = np.cumsum(np.frombuffer(block["sizes"], "<u2").astype(np.int64)).tolist()
    keys, key, at, rests = [], b"", 0, block["rests"]
    for s, end in zip(shared, ends):
        key = key[:s] + rests[at:end]
        keys.append(key)
        at = end
    return keys, shared, np.frombuffer(block["meta"], _META)


_BLOCK_TYPES = pa.schema(
    [("run", pa.int64()), ("seq", pa.int32()), ("n", pa.int32())]
    + [(c, pa.binary()) for c in ("head", "last", "shared", "sizes", "rests", "meta")]
)
_SPAN_TYPES = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("s", pa.int32()), ("e", pa.int32())])
_RUN_TYPES = pa.schema([*_BLOCK_TYPES, *_SPAN_TYPES])


def sorted_run(found: list[tuple], length: int, run: int) -> tuple[list[dict], list[tuple]]:
    """Front-coded blocks of one run, and the spans of suffixes that occur twice in it.

    ``found``: (key, t1, t2, q, lo, hi, many).
    """
    found.sort()
    kept, spans, shared = [], [], []
    at = 0
    while at < len(found):
        key, end = found[at][0], at + 1
        while end < len(found) and found[end][0] == key:
            end += 1
        many = end - at > 1 or found[at][6]
        if many:
            spans += [(t1, t2, q - hi, q - lo + length) for _, t1, t2, q, lo, hi, m in found[at:end] if not m]
        shared.append(shared_prefix(kept[-1][0], key, 0) if kept else 0)
        kept.append((*found[at][:6], many))
        at = end
    blocks = []
    for i in range(0, len(kept), BLOCK):
        part = kept[i : i + BLOCK]
        meta = np.array([tuple(x[1:]) for x in part], _META)
        blocks.append(_coded([x[0] for x in part], shared[i : i + BLOCK], meta, run, len(blocks)))
    return blocks, spans


def _runs(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        task, number = TaskContext.get().partitionId(), 0

        def out() -> pa.RecordBatch:
            nonlocal number
            blocks, spans = sorted_run(found, length, (task << 32) | number)
            number += 1
            found.clear()
            rows = blocks + [dict(zip(("t1", "t2", "s", "e"), span)) for span in spans]
            return pa.RecordBatch.from_pylist(rows, schema=_RUN_TYPES)

        for batch in batches:
            for row in range(batch.num_rows):
                t1, t2, text, many, places = (c[row] for c in batch.columns)
                t1, t2, text, many = t1.as_py(), t2.as_py(), text.as_buffer().to_pybytes(), many.as_py()
                q, lo, hi = (places.values.field(f).to_numpy().tolist() for f in range(3))
                for a, low, high in zip(q, lo, hi):
                    key = text[a : a + length - low] + _END + text[a - high : a][::-1]
                    found.append((key, t1, t2, a, low, high, many))
                    if len(found) >= RUN:
                        yield out()
        if found:
            yield out()

    return run


def _routed(borders: list[bytes]):
    """Blocks with their range; a block over a border is cut there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("rng", pa.int32()), *_BLOCK_TYPES])
        for batch in batches:
            rows = []
            for block in batch.to_pylist():
                low, high = bisect_right(borders, block["head"]), bisect_right(borders, block["last"])
                if low == high:
                    rows.append({"rng": low, **block})
                    continue
                keys, shared, meta = _uncoded(block)
                at = 0
                for r in range(low, high + 1):
                    end = bisect_left(keys, borders[r]) if r < len(borders) else len(keys)
                    if end > at:
                        rows.append({"rng": r, **_coded(keys[at:end], shared[at:end], meta[at:end], block["run"], block["seq"])})
                    at = max(at, end)
            yield pa.RecordBatch.from_pylist(rows, schema=kind)

    return run


def _stream(blocks: list[dict]) -> Iterator[tuple[int, bytes, np.void]]:
    """(prefix shared with the key before, key, meta) of one sorted run."""
    last = b""
    for block in blocks:
        keys, shared, meta = _uncoded(block)
        shared[0] = shared_prefix(last, keys[0], 0)
        yield from zip(shared, keys, meta)
        last = keys[-1]


def merged(streams: list[Iterator]) -> Iterator[tuple[bytes, int, object]]:
    """Merge sorted streams with a loser tree: (key, prefix shared with the key before, meta)."""
    size = 1
    while size < len(streams):
        size *= 2
    heads: list = [next(s, None) for s in streams] + [None] * (size - len(streams))
    keys = [h[1] if h else None for h in heads]
    known = [0] * size  # prefix shared with the last key put out

    def beats(a: int, b: int) -> bool:
        """Does a go before b? The loser then knows what it shares with the winner."""
        x, y = keys[a], keys[b]
        if x is None or y is None:
            return y is None
        if known[a] != known[b]:
            return known[a] > known[b]
        at = shared_prefix(x, y, known[a])
        first = x[at : at + 1] <= y[at : at + 1]
        known[b if first else a] = at
        return first

    losers = [0] * size
    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    top = winners[1]
    while keys[top] is not None:
        yield keys[top], known[top], heads[top][2]
        head = heads[top] = next(streams[top], None)
        keys[top], known[top] = (head[1], head[0]) if head else (None, 0)
        node = (top + size) // 2
        while node:
            if not beats(top, losers[node]):
                top, losers[node] = losers[node], top
            node //= 2


class Classes:
    """Repeated starts of a batch of distinct sorted suffixes, of which neighbours' shared prefixes are known."""

    def __init__(self, length: int):
        self.length = length
        self.core = shape_of(length)[1]

    def passage(self, key: bytes, lo: int, j: int) -> bytes:
        """The passage that starts ``j`` bytes before the anchor."""
        right = self.length - lo
        return key[right + 1 : right + 1 + j][::-1] + key[: self.length - j]

    def settle(self, keys: list[bytes], shared: list[int], meta: np.ndarray, below: int, above: int):
        """(spans, records) of a batch.

        ``below`` and ``above``: prefixes that its first and last suffix share with their
        neighbours outside. A record (hash pair, count, t1, t2, start) is a passage
        that may occur there too.
        """
        length, m = self.length, len(keys)
        lo, hi = meta["lo"].astype(np.int64), meta["hi"].astype(np.int64)
        right = np.array(shared, np.int64)
        right[0] = -1
        down = np.minimum.accumulate(np.r_[below, right[1:]])
        up = np.minimum.accumulate(np.r_[above, right[:0:-1]])[::-1]
        touch = np.maximum(down, up)
        active = (np.r_[right[1:], -1] >= self.core) | (right >= self.core) | (touch >= self.core)
        lefts = [k[length - w + 1 :] for k, w in zip(keys, lo.tolist())]
        order = sorted(range(m), key=lefts.__getitem__)
        width = int(hi.max()) + 1
        table = np.frombuffer(b"".join(lefts[i].ljust(width, b"\0") for i in order), np.uint8).reshape(m, width)
        same = table[1:] == table[:-1]
        left = np.r_[-1, np.where(same.all(axis=1), width, same.argmin(axis=1))]
        order = np.array(order)
        weight = np.where(meta["many"] > 0, 2, 1)
        lid = np.empty(m, np.int64)
        hits, records = [], []
        for j in range(int(lo.min()), width):
            chosen = np.flatnonzero(active & (lo <= j) & (hi >= j))
            if not len(chosen):
                continue
            lid[order] = np.cumsum(left < j)
            rid = np.cumsum(right < length - j)
            _, code = np.unique(rid[chosen] * m + lid[chosen], return_inverse=True)
            total = np.bincount(code, weights=weight[chosen])[code]
            repeated = chosen[(total >= 2) & (weight[chosen] == 1)]
            hits.append(repeated * width + j)
            open_ = touch[chosen] >= length - j
            if open_.any():
                seen = set()
                for i, c, n in zip(chosen[open_].tolist(), code[open_].tolist(), total[open_].tolist()):
                    if c not in seen:
                        seen.add(c)
                        d = hashlib.blake2b(self.passage(keys[i], int(lo[i]), j), digest_size=16).digest()
                        row = meta[i]
                        records.append(
                            (
                                int.from_bytes(d[:8], signed=True),
                                int.from_bytes(d[8:], signed=True),
                                min(int(n), 2),
                                int(row["t1"]),
                                int(row["t2"]),
                                int(row["q"]) - j,
                            )
                        )
        spans = []
        if hits:
            flat = np.sort(np.concatenate(hits))
            if len(flat):
                cut = np.flatnonzero((np.diff(flat) != 1) | (flat[1:] // width != flat[:-1] // width)) + 1
                for a, b in zip(flat[np.r_[0, cut]].tolist(), flat[np.r_[cut, len(flat)] - 1].tolist()):
                    row = meta[a // width]
                    q = int(row["q"])
                    spans.append((int(row["t1"]), int(row["t2"]), q - b % width, q - a % width + length))
        return spans, records


_FOUND_TYPES = pa.schema([*_SPAN_TYPES, ("w1", pa.int64()), ("w2", pa.int64()), ("n", pa.int32())])


def _merge_range(length: int, borders: list[bytes]):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        number = key[0].as_py()
        runs: dict[int, list[dict]] = {}
        for block in table.sort_by([("run", "ascending"), ("seq", "ascending")]).to_pylist():
            runs.setdefault(block["run"], []).append(block)
        classes, rows = Classes(length), []
        keys: list[bytes] = []
        shared: list[int] = []
        meta: list[tuple] = []

        def whole(x) -> None:
            rows.append((x["t1"], x["t2"], x["q"] - x["hi"], x["q"] - x["lo"] + length, None, None, None))

        def settle(below: int, above: int) -> None:
            spans, records = classes.settle(keys, shared, np.array([tuple(x.values()) for x in meta], _META), below, above)
            rows.extend((*s, None, None, None) for s in spans)
            rows.extend((t1, t2, p, p + length, w1, w2, n) for w1, w2, n, t1, t2, p in records)
            keys.clear(), shared.clear(), meta.clear()

        below = 0
        for k, s, row in merged([_stream(b) for b in runs.values()]):
            row = dict(zip(_META.names, row.item()))
            if keys and s == len(k) == len(keys[-1]):
                if not meta[-1]["many"]:
                    whole(meta[-1])
                if not row["many"]:
                    whole(row)
                meta[-1]["many"] = 1
                continue
            if not keys and number:
                below = shared_prefix(k, borders[number - 1], 0)
            if len(keys) >= BATCH:
                settle(below, s)
                below = s
            keys.append(k)
            shared.append(s)
            meta.append(row)
        if keys:
            settle(below, shared_prefix(keys[-1], borders[number], 0) if number < len(borders) else 0)
        columns = list(zip(*rows)) or [[]] * len(_FOUND_TYPES)
        return pa.table([pa.array(c, t.type) for c, t in zip(columns, _FOUND_TYPES)], schema=_FOUND_TYPES)

    return run


def _borders(blocks: DataFrame) -> list[bytes]:
    """Borders of ranges of about ``RANGE`` suffixes, from the heads of blocks."""
    total = blocks.agg(F.sum("n").alias("n"), F.count("*").alias("blocks")).first()
    ranges = (total["n"] or 0) // RANGE + 1
    share = min(1.0, HEADS / max(1, total["blocks"]))
    drawn = F.pmod(F.xxhash64("run", "seq"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    heads = sorted(bytes(r["head"]) for r in blocks.where(drawn).select("head").collect())
    picked = [heads[len(heads) * i // ranges] for i in range(1, ranges)] if heads else []
    return sorted(set(picked))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            text, at, kept, spans = row["text"], 0, hashlib.sha256(), []
            for s, e in sorted((x["s"], x["e"]) for x in row["spans"]):
                if spans and s <= spans[-1]["e"]:
                    spans[-1]["e"] = max(spans[-1]["e"], e)
                else:
                    spans.append({"s": s, "e": e})
            for span in spans:
                kept.update(text[at : span["s"]])
                at = span["e"]
            kept.update(text[at:])
            removed = sum(x["e"] - x["s"] for x in spans)
            rows.append({"t1": row["t1"], "t2": row["t2"], "n_removed": removed, "spans": spans, "sha256": kept.hexdigest()})
        kind = [("t1", pa.int64()), ("t2", pa.int64()), ("n_removed", pa.int64())]
        kind += [("spans", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))), ("sha256", pa.string())]
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(kind))


def remove_passages(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, n_bytes, n_removed, spans (removed, start and end in bytes), kept_sha256."""
    work = Workspace(docs.sparkSession, "passages")
    text = F.coalesce(F.col(text_col), F.lit(""))
    t1, t2 = hash_pair(text)
    keyed = docs.select(t1.alias("t1"), t2.alias("t2"), text.alias("text"), F.col(id_col).alias("id"))
    long_texts = keyed.where(F.octet_length("text") >= length)

    found = long_texts.select("t1", "t2", "text").mapInArrow(_anchor_rows(length), "t1 bigint, t2 bigint, q int, lo smallint, hi smallint, core bigint")
    places = work.cut(found, "anchors")
    # copies of a text hold the same place, so they do not make it a candidate
    place = F.xxhash64("t1", "t2", "q")
    shared = places.groupBy("core").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b")
    candidates = places.join(work.cut(shared.select("core"), "cores"), "core").select("t1", "t2", "q", "lo", "hi").distinct()
    per_text = candidates.groupBy(*_TEXT).agg(F.collect_list(F.struct("q", "lo", "hi")).alias("places"))
    texts = long_texts.groupBy(*_TEXT).agg(F.first("text").alias("text"), (F.count("*") > 1).alias("many"))
    texts = work.cut(texts.join(per_text, _TEXT).select("t1", "t2", F.encode("text", "UTF-8").alias("text"), "many", "places"), "texts")

    runs = work.cut(texts.mapInArrow(_runs(length), f"{_BLOCKS}, {_SPAN}"), "runs")
    blocks = runs.where(F.col("run").isNotNull()).select("run", "seq", "n", "head", "last", "shared", "sizes", "rests", "meta")
    borders = _borders(blocks)
    ranged = blocks.mapInArrow(_routed(borders), f"rng int, {_BLOCKS}")
    settled = ranged.groupBy("rng").applyInArrow(_merge_range(length, borders), f"{_SPAN}, w1 bigint, w2 bigint, n int")
    settled = work.cut(settled, "settled")

    records = settled.where(F.col("w1").isNotNull())
    beyond = records.groupBy("w1", "w2").agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("w1", "w2")
    across = records.where("n = 1").join(work.cut(beyond, "beyond"), ["w1", "w2"])
    spans = runs.where(F.col("run").isNull()).select("t1", "t2", "s", "e")
    for more in (settled.where(F.col("w1").isNull()), across):
        spans = spans.union(more.select("t1", "t2", "s", "e"))
    per_text = spans.groupBy(*_TEXT).agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    cut_texts = texts.where(~F.col("many")).select("t1", "t2", "text").join(per_text, _TEXT).select("t1", "t2", "text", "spans")
    changed = "t1 bigint, t2 bigint, n_removed bigint, spans array<struct<s: int, e: int>>, sha256 string"
    changed = work.cut(cut_texts.mapInArrow(_kept, changed), "changed")

    size = F.octet_length("text")
    rows = keyed.select("id", "t1", "t2", size.alias("n_bytes"), F.sha2("text", 256).alias("own"))
    copied = long_texts.select("t1", "t2", size.alias("n_bytes")).groupBy(*_TEXT).agg(F.max("n_bytes").alias("n_bytes"), F.count("*").alias("n"))
    all_of_it = F.array(F.struct(F.lit(0).alias("s"), F.col("n_bytes").alias("e")))
    whole = copied.where("n > 1").select("t1", "t2", F.col("n_bytes").cast("bigint").alias("n_removed"), all_of_it.alias("spans"), F.sha2(F.lit(""), 256).alias("sha256"))
    # a written table on the right, so that a text in a third of all rows can be split over tasks
    outcome = work.cut(changed.union(whole), "outcome")
    return rows.join(outcome, _TEXT, "left").select(
        F.col("id").alias(id_col),
        F.col("n_bytes").cast("bigint").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<struct<s: int, e: int>>")).alias("spans"),
        F.coalesce("sha256", "own").alias("kept_sha256"),
    )
