"""Approximate nearest neighbours with randomly rotated one-bit codes.

Method: vectors are assigned to the nearest of some centroids; the residual is
normalised, turned by a random rotation and kept as one bit per dimension, with
two scalars: its length and its inner product with its own code. From the packed
bits and the scalars follow an unbiased estimate of the inner product with a
query and a bound of its error. Of each block the estimated nearest are measured
exactly first; every vector whose lower bound does not exceed the k-th of these
distances is then measured exactly too. Where that leaves many pairs of a block, a
matrix product goes first, and only pairs that it leaves within the k-th distance
found so far (rounding allowed for) are measured by differences.

Scale: the index is written as Parquet blocks of at most BLOCK rows of one
centroid, made by a map without a shuffle, and dealt out over parts whose number
grows with the vectors. A query is packed once, with up to PACK others, and a copy
of the pack goes to each part and meets its blocks one after another. A task
merges what its blocks give for a query before it sends it, packed per group of
queries; all groups have bounded numbers of queries. Rotation and centroids (broadcast, NLIST at most)
are fitted on a sample of SAMPLE vectors, the first by a hash of their id; every
vector is indexed.

Defined results: vectors that are null, zero, or hold a null or a non-finite
component take no part, nor do those without id or of another length than most
vectors; of rows that repeat an id the one with the smallest vector counts; a
query gets all candidates if there are fewer than k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_BYTES, chunks, first_by_hash, materialize, runs, ship

K = 10
NLIST = 64
ROWS_PER_LIST = 200
#: Share of the lists a query visits. The one-bit codes do the pruning: of data
#: without clusters a smaller share loses neighbours (recall 0.64 for 0.4).
PROBED = 1.0
SAMPLE = 20_000
BLOCK, PACK = 8192, 1024
HELD = 300_000  # results a task merges before it sends them
#: Bytes of vectors in a part of the index, at most about; smaller tables get up to
#: PARTS parts of PART_ROWS vectors. Bytes of vectors that an index task holds.
PART_BYTES, PARTS, PART_ROWS, GATHERED = 64 << 20, 32, 2048, 32 << 20
#: Pairs of a block looked at at once, and the share of them that the bounds must
#: leave for a matrix product to measure the block.
PAIRS, DENSE = 1 << 17, 1 / 16
EPSILON = 2.5
SEED = 7


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part, one per id."""
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
            .filter(F.col("id").isNotNull() & F.col("vec").isNotNull())
            .withColumn("ok", finite_of("vec")).filter("ok").drop("ok"))
    size = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1)
    rows = rows.join(F.broadcast(size.select("d")), F.size("vec") == F.col("d")).drop("d")
    return materialize(rows.groupBy("id").agg(F.min("vec").alias("vec")))


def finite_of(name: str):
    """Whether an array has only finite components, one of them not zero."""
    good = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(good & F.exists(name, lambda x: x != 0), F.lit(False))


class Model:
    """Centroids and rotation."""

    def __init__(self, sample: np.ndarray, nlist: int):
        rng = np.random.default_rng(SEED)
        d = sample.shape[1]
        self.rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
        centers = sample[np.sort(rng.choice(len(sample), nlist, replace=False))].copy()
        for _ in range(12):
            near = self._near(sample, centers)
            size = np.bincount(near, minlength=nlist)
            sums = np.zeros_like(centers)
            np.add.at(sums, near, sample)
            centers = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centers)
        self.centers = centers

    @staticmethod
    def _near(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
        return ((centers**2).sum(axis=1) - 2 * x @ centers.T).argmin(axis=1)

    def assign(self, x: np.ndarray) -> np.ndarray:
        return self._near(x, self.centers)

    def order(self, q: np.ndarray) -> np.ndarray:
        """Centroids from near to far, per query."""
        return np.argsort((self.centers**2).sum(axis=1) - 2 * q @ self.centers.T, axis=1, kind="stable")

    def turned(self, x: np.ndarray, center: int) -> tuple[np.ndarray, np.ndarray]:
        """Length of the residuals, and their directions after rotation."""
        r = x - self.centers[center]
        length = np.sqrt((r**2).sum(axis=1))
        return length, (r / np.where(length > 0, length, 1)[:, None]) @ self.rotation


def encode(model: Model, x: np.ndarray, center: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed bits, length of the residual, inner product with the own code."""
    length, u = model.turned(x, center)
    bits = u > 0
    own = np.abs(u).sum(axis=1) / np.sqrt(x.shape[1])
    return np.packbits(bits, axis=1), length, own


def search_block(model: Model, center: int, q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, codes: np.ndarray, length: np.ndarray, own: np.ndarray, k: int = K, kth: np.ndarray | None = None):
    """The k nearest of a block to each query: (query row, block row, distance).
    `kth`: the k-th distance that each query has found elsewhere; vectors that are
    farther are left out. Ids come once in the block, and once in the queries."""
    d = x.shape[1]
    kth = np.full(len(q), np.inf) if kth is None else kth
    q_len, u = model.turned(q, center)
    own = np.where(own > 0, own, 1.0)
    signs = (np.unpackbits(codes, axis=1, count=d) * 2.0 - 1) / (np.sqrt(d) * own)[:, None]
    error = EPSILON * np.sqrt(np.maximum(1 - own**2, 0)) / own / np.sqrt(max(d - 1, 1))
    mine = np.stack(np.intersect1d(q_ids, ids, return_indices=True)[1:])
    q_sq, x_sq = (q**2).sum(axis=1), (x**2).sum(axis=1)
    # what rounding may add to a squared distance found by a product
    slack = 4 * (d + 8) * np.finfo(float).eps * (np.sqrt(q_sq) + np.sqrt(x_sq.max()))**2
    n, step = min(k, len(x)), max(16, PAIRS // len(x))
    found = []
    for s in range(0, len(q), step):
        e = slice(s, s + step)
        me = mine[0, (mine[0] >= s) & (mine[0] < s + step)] - s, mine[1, (mine[0] >= s) & (mine[0] < s + step)]
        estimate = u[e] @ signs.T
        base, scale = q_len[e, None]**2 + length**2, 2 * q_len[e, None] * length
        near = base - scale * estimate
        near[me] = np.inf
        first = np.argpartition(near, n - 1, axis=1)[:, :n]
        exact = np.sqrt(((q[e, None, :] - x[first])**2).sum(axis=2))
        exact[q_ids[e, None] == ids[first]] = np.inf
        limit = exact.max(axis=1)
        estimate += error
        scale *= np.minimum(estimate, 1, out=estimate)
        # rounding must not drop a tie at the limit
        left = base - scale <= (limit**2 * (1 + 1e-9) + 1e-12)[:, None]
        left[me] = False
        if np.count_nonzero(left) > DENSE * left.size:
            square = q_sq[e, None] + x_sq - 2 * (q[e] @ x.T)
            left &= ~(square > (np.minimum(limit, kth[e])**2 * (1 + 1e-9) + slack[e])[:, None])
        a, b = np.nonzero(left)
        a += s
        dist = np.empty(len(a))
        for t in range(0, len(a), 1 << 16):
            c = slice(t, t + (1 << 16))
            dist[c] = np.sqrt(((q[a[c]] - x[b[c]])**2).sum(axis=1))
        near_by = ~(dist > kth[a])
        found.append((a[near_by], b[near_by], dist[near_by]))
    a, b, dist = map(np.concatenate, zip(*found, strict=True))
    by = np.lexsort((ids[b], dist, a))
    a, b, dist = a[by], b[by], dist[by]
    start = runs(a)
    rank = np.arange(len(a)) - np.repeat(start, np.diff(np.append(start, len(a))))
    return a[rank < k], b[rank < k], dist[rank < k]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _packed(x: np.ndarray) -> bytes:
    """Vectors in single precision, if that holds them exactly."""
    with np.errstate(over="ignore"):
        single = x.astype(np.float32)
    return (single if np.array_equal(single, x) else x).tobytes()


def _unpacked(data: bytes, n: int, d: int) -> np.ndarray:
    return np.frombuffer(data, np.float32 if len(data) == 4 * n * d else np.float64).reshape(n, d).astype(np.float64)


def _gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(vectors, ids) of many batches together, until they have `limit` bytes."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append((_matrix(b.column("vec")), b.column("id").to_numpy()))
            size += held[-1][0].nbytes
        if size >= limit:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


def _batches(rows: Iterator[tuple], names: list[str], numbers: int) -> Iterator[pa.RecordBatch]:
    """Batches of bounded bytes from rows that begin with so many numbers and go on
    with bytes."""
    for part in chunks(rows, lambda r: sum(map(len, r[numbers:])), BATCH_BYTES):
        kinds = [pa.int32()] * numbers + [pa.binary()] * (len(names) - numbers)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), kinds, strict=True)], names)


_BLOCK = "center int, part int, ids binary, vecs binary, codes binary, length binary, own binary"
_PACK = "home int, q_ids binary, probed binary, q_vecs binary"


def _index(shared, parts: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        model = shared.value[0]
        turn = TaskContext.get().partitionId() * 7919  # tasks begin at different parts
        for x, ids in _gathered(batches, GATHERED):
            near = model.assign(x)
            for c in np.unique(near).tolist():
                mine = np.flatnonzero(near == c)
                for s in range(0, len(mine), BLOCK):
                    at = mine[s:s + BLOCK]
                    codes, length, own = encode(model, x[at], c)
                    yield c, turn % parts, ids[at].tobytes(), _packed(x[at]), codes.tobytes(), length.tobytes(), own.tobytes()
                    turn += 1

    return lambda batches: _batches(blocks(batches), ["center", "part", "ids", "vecs", "codes", "length", "own"], 2)


def _queries(shared, k: int):
    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        model, sizes = shared.value
        home = TaskContext.get().partitionId()  # each query is packed by one task
        least = max(1, int(np.ceil(PROBED * len(sizes))))
        for q, ids in _gathered(batches, GATHERED):
            for at in np.array_split(np.arange(len(q)), -(-len(q) // PACK)):
                held = np.cumsum(sizes[model.order(q[at])], axis=1)
                # at least so many lists, and on until they hold enough candidates
                probed = np.maximum(least, (held < 4 * k + 1).sum(axis=1) + 1)
                yield home, ids[at].tobytes(), probed.astype(np.int32).tobytes(), _packed(q[at])

    return lambda batches: _batches(packs(batches), ["home", "q_ids", "probed", "q_vecs"], 1)


def best(q: np.ndarray, v: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k nearest of each query among (query, vector, distance), in order,
    and their ranks from 1."""
    by = np.lexsort((v, d, q))
    q, v, d = q[by], v[by], d[by]
    start = runs(q)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    keep = rank < k
    return q[keep], v[keep], d[keep], rank[keep] + 1


_FOUND = "home int, q binary, v binary, d binary"


class Asked:
    """The queries of a pack, and the nearest found for them so far."""

    def __init__(self, model: Model, row: dict):
        self.home, self.ids = row["home"], np.frombuffer(row["q_ids"], np.int64)
        self.q = _unpacked(row["q_vecs"], len(self.ids), model.rotation.shape[0])
        place = np.argsort(model.order(self.q), axis=1)
        self.use = place < np.frombuffer(row["probed"], np.int32)[:, None]
        self.top = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        self.kth = np.full(len(self.ids), np.inf)

    def meet(self, model: Model, row: dict, k: int) -> None:
        use = np.flatnonzero(self.use[:, row["center"]])
        if not len(use):
            return
        ids = np.frombuffer(row["ids"], np.int64)
        x = _unpacked(row["vecs"], len(ids), model.rotation.shape[0])
        codes = np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1)
        at, to, dist = search_block(model, row["center"], self.q[use], self.ids[use], x, ids, codes, np.frombuffer(row["length"]), np.frombuffer(row["own"]), k, self.kth[use])
        if len(at):
            *self.top, rank = best(*map(np.concatenate, zip(self.top, (use[at], ids[to], dist), strict=True)), k)
            self.kth[self.top[0][rank == k]] = self.top[2][rank == k]


def _cells(shared, k: int):
    def packed(held: dict) -> Iterator[tuple]:
        for asked in held.values():
            at, v, d = asked.top
            yield asked.home, asked.ids[at].tobytes(), v.tobytes(), d.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best of all cells of a task, packed per home of queries."""
        model = shared.value[0]
        held: dict[tuple[int, bytes], Asked] = {}
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                key = r["home"], r["q_ids"]
                if key not in held:
                    if sum(len(x.ids) for x in held.values()) * k > HELD:
                        yield from _batches(packed(held), ["home", "q", "v", "d"], 1)
                        held = {}
                    held[key] = Asked(model, r)
                held[key].meet(model, r, k)
        yield from _batches(packed(held), ["home", "q", "v", "d"], 1)

    return run


def _rank(k: int):
    def run(key: tuple[pa.Scalar, ...], parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k nearest of a home's queries, merged part by part."""
        top = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        rank = np.zeros(0, np.int64)
        for b in parts:
            for r in b.to_pylist():
                new = (np.frombuffer(r["q"], np.int64), np.frombuffer(r["v"], np.int64), np.frombuffer(r["d"]))
                *top, rank = best(*(np.concatenate(c) for c in zip(top, new, strict=True)), k)
        yield pa.RecordBatch.from_arrays([pa.array(top[0]), pa.array(rank.astype(np.int32)), pa.array(top[1]), pa.array(top[2])], ["query_id", "rank", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K) -> DataFrame:
    """The k nearest other vectors (Euclidean) found for each row for which
    `is_query` (over a column `id`) is true: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    ship(spark)
    rows = usable(vectors, id_col, vec_col)
    count = rows.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not count:
        return empty
    sample = np.array([r["vec"] for r in first_by_hash(rows, "id", SAMPLE).collect()], np.float64)
    nlist = max(1, min(NLIST, len(sample) // ROWS_PER_LIST))
    model = Model(sample, nlist)
    parts = max(-(-count * 8 * sample.shape[1] // PART_BYTES), min(PARTS, -(-count // PART_ROWS)))
    index = materialize(rows.mapInArrow(_index(spark.sparkContext.broadcast((model, None)), parts), _BLOCK))
    sizes = np.zeros(nlist, np.int64)
    for r in index.groupBy("center").agg(F.sum(F.octet_length("ids") / 8).alias("n")).collect():  # NLIST rows at most
        sizes[r["center"]] = int(r["n"])
    shared = spark.sparkContext.broadcast((model, sizes))
    asked = rows.filter(is_query)
    n = asked.count()
    # a number of homes that is not left to the planner, which sees small rows only
    homes = max(1, -(-n // PACK), min(8, n // 128))
    packs = asked.repartition(homes, "id").mapInArrow(_queries(shared, k), _PACK)
    packs = packs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    found = packs.join(index, "part").mapInArrow(_cells(shared, k), _FOUND)
    return found.groupBy("home").applyInArrow(_rank(k), "query_id long, rank int, vec_id long, score double")
