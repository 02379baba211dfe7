"""Centroid clustering over dictionaries of subvectors, in exact integers.

A vector takes part if it has ``dims`` components, none of them null or not finite. Each
component x becomes the integer floor(scale * x). Vectors are stored once, in pieces of at
most ``PIECE``: per block of ``BLOCK`` dimensions a piece holds its distinct subvectors
and, per vector, the code of its subvector. Nothing is lost, and repeated rows or common
values cost a code. A round computes the distances between the centroids and the distinct
subvectors of every piece once, and the distance of a vector is the sum of the entries that
its codes name. The sums for the new centroids are taken by code as well: how often a
cluster uses a subvector, times the subvector.

Vectors are never shuffled. A task hands over one row per centroid and dimension; only the
centroids themselves, of a fixed size, reach the driver and travel to the tasks. A piece
holds its own dictionaries, so their size is bounded whatever the data, and a lost
executor costs the tasks it ran.

Components beyond ``NARROW`` are handled as unbounded integers, which is slower and as
exact; a distance or sum that no long can hold is given as the largest long.

Defined cases: the first centroids are the vectors with the smallest hash of ``seed:id``
(ties by content; vectors without an id come last); fewer vectors than centroids: as
many centroids as vectors; a centroid without vectors stays as it is, and of equally
near centroids the first one counts; a repeated row is a vector of its own; no vector
takes part: no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartdex.llm.shared import Workspace

BLOCK = 2
PIECE = 4096
#: Up to this size a sum of squared differences over 64 dimensions fits into a long.
NARROW = 1 << 26
_SHIFT = 28
_LIMB = 30
LARGEST = (1 << 63) - 1
_PIECES = "ids array<bigint>, wide boolean, sizes array<int>, entries binary, codes binary"


def takes_part(vector: Column, dims: int) -> Column:
    """Has the vector all its components, each a finite number?"""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return F.coalesce((F.size(vector) == dims) & F.forall(vector, finite), F.lit(False))


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as longs, or as unbounded integers where one is large."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if not len(scaled) or np.abs(scaled).max() <= NARROW:
        return scaled.astype(np.int64)
    # a double of this size is a whole number already
    exact = [int(x) * scale if abs(x) >= 1 << 53 else math.floor(x * scale) for x in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def encode(numbers: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct subvectors of every block of dimensions, and the code of each vector's."""
    n, dims = numbers.shape
    books, codes = [], np.empty((n, -(-dims // BLOCK)), dtype=np.uint16)
    for b in range(codes.shape[1]):
        part = numbers[:, b * BLOCK : (b + 1) * BLOCK]
        if numbers.dtype == object:
            seen: dict = {}
            codes[:, b] = [seen.setdefault(tuple(row), len(seen)) for row in part]
            books.append(np.array(list(seen), dtype=object).reshape(len(seen), part.shape[1]))
            continue
        packed = part[:, 0]
        for d in range(1, part.shape[1]):
            packed = (packed << _SHIFT) + part[:, d]
        _, first, code = np.unique(packed, return_index=True, return_inverse=True)
        books.append(part[first])
        codes[:, b] = code
    return books, codes


def _pieces(dims: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                part = batch.slice(at, PIECE)
                values = part.column(1).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
                numbers = whole_numbers(values, scale)
                books, codes = encode(numbers)
                wide = numbers.dtype == object
                flat = np.concatenate([book.ravel() for book in books])
                entries = " ".join(map(str, flat)).encode() if wide else flat.astype("<i8").tobytes()
                yield pa.record_batch(
                    {
                        "ids": pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                        "wide": pa.array([wide]),
                        "sizes": pa.array([[len(book) for book in books]], pa.list_(pa.int32())),
                        "entries": pa.array([entries], pa.binary()),
                        "codes": pa.array([codes.astype("<u2").tobytes()], pa.binary()),
                    }
                )

    return run


def _decoded(batch: pa.RecordBatch, row: int, dims: int) -> tuple[list[np.ndarray], np.ndarray]:
    entries, codes = batch.column("entries")[row].as_py(), batch.column("codes")[row].as_py()
    if batch.column("wide")[row].as_py():
        flat = np.array([int(x) for x in entries.split()], dtype=object)
    else:
        flat = np.frombuffer(entries, dtype="<i8")
    books, at = [], 0
    for b, size in enumerate(batch.column("sizes")[row].as_py()):
        width = min(BLOCK, dims - b * BLOCK)
        books.append(flat[at : at + size * width].reshape(size, width))
        at += size * width
    return books, np.frombuffer(codes, dtype="<u2").reshape(-1, len(books))


def _centroid_array(centroids: list[list[int]]) -> np.ndarray:
    wide = max(abs(x) for c in centroids for x in c) > NARROW
    return np.array(centroids, dtype=object if wide else np.int64)


def nearest_by_code(books: list[np.ndarray], codes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of every vector of a piece."""
    kind = object if centroids.dtype == object or books[0].dtype == object else np.int64
    total = np.zeros((len(codes), len(centroids)), dtype=kind)
    for b, book in enumerate(books):
        part = centroids[:, b * BLOCK : b * BLOCK + book.shape[1]].astype(kind)
        differences = book.astype(kind)[:, None, :] - part[None, :, :]
        total += (differences * differences).sum(axis=2)[codes[:, b]]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(codes)), cluster]


def _limbs(number: int) -> Iterator[tuple[int, int]]:
    """A number as digits of ``_LIMB`` bits that add up in longs, each with the sign of the number."""
    sign, number, at = (-1 if number < 0 else 1), abs(number), 0
    while number:
        yield at, sign * (number & ((1 << _LIMB) - 1))
        number, at = number >> _LIMB, at + 1


def _sums(centroids: list[list[int]]):
    """Per centroid and dimension the sum of its vectors; dimension -1 counts them."""
    k, dims = len(centroids), len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = _centroid_array(centroids)
        total = np.zeros((k, dims + 1), dtype=object)
        for batch in batches:
            for row in range(batch.num_rows):
                books, codes = _decoded(batch, row, dims)
                cluster, _ = nearest_by_code(books, codes, points)
                total[:, dims] += np.bincount(cluster, minlength=k)
                for b, book in enumerate(books):
                    used = np.bincount(codes[:, b].astype(np.int64) * k + cluster, minlength=len(book) * k).reshape(-1, k)
                    total[:, b * BLOCK : b * BLOCK + book.shape[1]] += used.T.astype(book.dtype).dot(book)
        rows = [
            (c, d if d < dims else -1, limb, part)
            for c in range(k)
            for d in range(dims + 1)
            for limb, part in _limbs(int(total[c, d]))
        ]
        columns = list(zip(*rows)) or [[], [], [], []]
        yield pa.record_batch(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64())],
            names=["cluster", "dim", "limb", "part"],
        )

    return run


def _assigned(centroids: list[list[int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = _centroid_array(centroids)
        for batch in batches:
            for row in range(batch.num_rows):
                books, codes = _decoded(batch, row, len(centroids[0]))
                cluster, distance = nearest_by_code(books, codes, points)
                yield pa.record_batch(
                    [
                        batch.column("ids")[row].values,
                        pa.array(cluster.astype(np.int32)),
                        pa.array([min(int(x), LARGEST) for x in distance], pa.int64()),
                    ],
                    names=["id", "cluster", "distance"],
                )

    return run


def _next_centroids(pieces: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    sums = pieces.mapInArrow(_sums(centroids), "cluster int, dim int, limb int, part bigint")
    total: dict[tuple[int, int], int] = {}
    for r in sums.groupBy("cluster", "dim", "limb").agg(F.sum("part").alias("part")).collect():
        at = r["cluster"], r["dim"]
        total[at] = total.get(at, 0) + (r["part"] << (_LIMB * r["limb"]))
    return [
        [total.get((c, d), 0) // total[c, -1] for d in range(len(old))] if (c, -1) in total else old
        for c, old in enumerate(centroids)
    ]


def cluster_vectors(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    seed: str = "1",
    dims: int = 64,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Per vector: its id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    work = Workspace(vectors.sparkSession, "centroids")
    given = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"))
    kept = given.where(takes_part(F.col("vector"), dims))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.orderBy(drawn.asc_nulls_last(), "vector").limit(k).select("vector").collect()
    centroids = [whole_numbers(np.array(r["vector"], dtype=np.float64), scale).tolist() for r in first]
    if not centroids:
        empty = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return vectors.sparkSession.createDataFrame([], f"`{id_col}` bigint, {empty}")
    pieces = work.cut(kept.mapInArrow(_pieces(dims, scale), _PIECES), "pieces")
    for _ in range(rounds):
        centroids = _next_centroids(pieces, centroids)
    assigned = work.cut(pieces.mapInArrow(_assigned(centroids), "id bigint, cluster int, distance bigint"), "assigned")
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r["cluster"]: int(r["total"]) for r in assigned.groupBy("cluster").agg(wide.alias("total")).collect()}
    per_cluster = [min(inertia.get(c, 0), LARGEST) for c in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def of_cluster(values: list) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("cluster"))

    return assigned.select(
        F.col("id").alias(id_col),
        "cluster",
        "distance",
        of_cluster(per_cluster).cast("bigint").alias("cluster_inertia"),
        F.lit(min(sum(inertia.values()), LARGEST)).cast("bigint").alias("inertia"),
        of_cluster(digests).alias("centroid_sha256"),
    )
