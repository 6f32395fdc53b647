"""Nearest neighbours by a block matrix join of int8 product tiles.

A stated set of query rows meets all rows in cells of at most 65,536 queries
and 65,536 candidates; every cell is one unit of work. Inside a cell both
sides are quantised to int8, a tile of products is one matrix product, and

    |q.x - q'.x'|  <=  |q'| |x - x'| + |q - q'| |x|

bounds its error (q', x' the quantised vectors). Pairs whose upper bound
reaches the query's best lower bounds are recomputed in double precision on
the original vectors, so the result is exact. The cells' best are merged by
one heap for each query.

Equal vectors of a cell are multiplied once, and only as many of them as can
be in an answer (the smallest ids) come out, so a vector that a third of the
rows hold costs one column.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ledgerline.llm.common import parallelism, ship_package, stage

NEIGHBOURS = 20
QUERY_STEP = 20
CELL = 65_536   # rows of either side of a cell: 16 MB at 64 float components
LEAST = 1_024   # candidates of a cell below which no further cell is made
_CHUNK = 4_096  # candidates of a tile
_EXACT_DIMS = 1_024  # int8 products of so many components are exact in float32


class Quantised:
    """Rows as int8 with a scale each, and the norms that bound the error."""

    def __init__(self, rows: np.ndarray):
        with np.errstate(all="ignore"):
            top = np.abs(rows).max(axis=1)
            self.scale = top / 127
            codes = np.rint(rows / np.where(self.scale > 0, self.scale, 1)[:, None])
            self.codes = np.clip(codes, -127, 127).astype(np.int8)
            near = self.codes * self.scale[:, None]
            unit = np.where(top > 0, top, 1)
            length = lambda m: np.sqrt(((m / unit[:, None]) ** 2).sum(axis=1)) * unit  # noqa: E731  no overflow of squares
            self.near_norm, self.rest_norm, self.norm = length(near), length(rows - near), length(rows)


def product_tile(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows, as floats."""
    tile = 0.0
    for at in range(0, q.shape[1], _EXACT_DIMS):
        part = q[:, at:at + _EXACT_DIMS].astype(np.float32) @ x[:, at:at + _EXACT_DIMS].astype(np.float32).T
        tile = tile + part.astype(np.float64)
    return tile


def bounded_tile(q: Quantised, i: slice, x: Quantised, j: slice) -> tuple[np.ndarray, np.ndarray]:
    """Estimates of the inner products of rows ``i`` and ``j``, and how far
    they may be off (rounding included); never nan."""
    with np.errstate(all="ignore"):
        near = product_tile(q.codes[i], x.codes[j]) * q.scale[i, None] * x.scale[None, j]
        off = q.near_norm[i, None] * x.rest_norm[None, j] + q.rest_norm[i, None] * x.norm[None, j]
        off = off * (1 + 1e-9) + q.norm[i, None] * x.norm[None, j] * 1e-9
    odd = ~(np.isfinite(near) & np.isfinite(off))
    if odd.any():
        near[odd], off[odd] = 0.0, np.inf
    return near, off


def products(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the row pairs (i, j) in double precision, summed in
    the order of the components."""
    total = np.zeros(len(i))
    with np.errstate(all="ignore"):
        for a, b in zip(np.ascontiguousarray(q.T), np.ascontiguousarray(x.T)):
            total += a[i] * b[j]
    return total


def _first_of_each(group: np.ndarray, most: int) -> np.ndarray:
    """Which entries are among the first ``most`` of their (sorted) group."""
    new = np.r_[True, group[1:] != group[:-1]] if len(group) else np.empty(0, bool)
    start = np.flatnonzero(new)
    return np.arange(len(group)) - np.repeat(start, np.diff(np.r_[start, len(group)])) < most


class Strip:
    """The candidates of a cell, equal vectors taken together."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, places: np.ndarray, most: int):
        vectors = vectors + 0.0  # no negative zeros
        key = np.ascontiguousarray(vectors).view(f"V{vectors.shape[1] * vectors.itemsize}").ravel()
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        self.rows = vectors[first].astype(np.float64)
        self.codes = Quantised(self.rows)
        order = np.lexsort((places, ids, which))
        # one more than an answer holds: the query's own row may be among them
        order = order[_first_of_each(which[order], most + 1)]
        self.ids, self.places = ids[order], places[order]
        self.count = np.bincount(which[order], minlength=len(first))
        self.start = np.cumsum(self.count) - self.count

    def members(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the rows of ``classes``, and which class each is of."""
        count = self.count[classes]
        which = np.repeat(np.arange(len(classes)), count)
        ends = np.cumsum(count)
        return np.repeat(self.start[classes] - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0), which


def nearest_in_strip(queries: np.ndarray, places: np.ndarray, strip: Strip, k: int) -> tuple[np.ndarray, ...]:
    """(query index, vec_id, place, score) of the ``k`` nearest of the strip to
    each query, its own row aside, by query and nearness."""
    queries = queries.astype(np.float64)
    codes, n = Quantised(queries), len(queries)
    floor = np.full(n, -np.inf)  # a score that k candidates are known to reach
    held = tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.float64))
    for at in range(0, len(strip.rows), _CHUNK):
        part = slice(at, min(at + _CHUNK, len(strip.rows)))
        near, off = bounded_tile(codes, slice(None), strip.codes, part)
        if at == 0 and near.shape[1] > k:
            # k + 1 classes, since one may be the query's own row alone
            floor = np.partition(near - off, near.shape[1] - k - 1, axis=1)[:, near.shape[1] - k - 1]
        i, j = np.nonzero(near + off >= floor[:, None])
        score = products(queries, strip.rows, i, j + at)
        member, pair = strip.members(j + at)
        found = (i[pair], strip.ids[member], strip.places[member], score[pair])
        other = found[2] != places[found[0]]
        found = tuple(np.concatenate([h, f[other]]) for h, f in zip(held, found))
        order = np.lexsort((found[2], found[1], -found[3], found[0]))
        order = order[_first_of_each(found[0][order], k)]
        held = tuple(f[order] for f in found)
        full = np.flatnonzero(np.bincount(held[0], minlength=n) == k)
        last = np.searchsorted(held[0], full, side="right") - 1
        floor[full] = np.maximum(floor[full], held[3][last])
    return held


def vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, place (which row it is) and the components' bytes of the rows
    that take part: with an id and a vector that has neither nulls nor
    non-finite components and is not zero."""
    wide = isinstance(embeddings.schema["embedding"].dataType.elementType, DoubleType)
    kind, dtype = (pa.float64(), "<f8") if wide else (pa.float32(), "<f4")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kept = [], []
            for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
                values = vector.values
                if vec_id is None or values is None or values.null_count:
                    continue
                row = values.cast(kind).to_numpy()
                if row.any() and np.isfinite(row).all():
                    ids.append(vec_id)
                    kept.append(row.astype(dtype).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kept, pa.binary())], names=["vec_id", "vector"])

    ship_package(embeddings.sparkSession)
    given = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return stage(given.mapInArrow(pack, "vec_id bigint, vector binary")
                 .withColumn("place", F.monotonically_increasing_id()), "vectors")


def _matrix(rows: list[bytes], dtype: str) -> np.ndarray:
    """Rows as a matrix; shorter ones are padded with zeros."""
    size = np.dtype(dtype).itemsize
    width = max(map(len, rows)) // size
    return np.frombuffer(b"".join(r.ljust(width * size, b"\0") for r in rows), dtype).reshape(len(rows), width)


def _cells(rows: DataFrame, step: int) -> DataFrame:
    """Every candidate once for each slab of queries, every query once for
    each strip of candidates, dealt by cell and ordered by it, candidates
    before queries."""
    spark = rows.sparkSession
    asks = F.col("vec_id") % step == 0
    n, asked = rows.agg(F.count("*"), F.count_if(asks)).first()
    strips = max(-(-n // CELL), min(parallelism(spark), -(-n // LEAST)), 1)
    slabs = max(-(-asked // CELL), 1)
    spread = lambda count: F.pmod(F.col("place"), F.lit(count))
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))
    candidates = rows.select("*", spread(strips).alias("strip"), F.lit(0).alias("side"), every(slabs).alias("slab"))
    queries = rows.where(asks).select("*", every(strips).alias("strip"), F.lit(1).alias("side")).select(
        "*", F.pmod(F.xxhash64("place"), F.lit(slabs)).alias("slab"))
    both = candidates.unionByName(queries).withColumn("cell", F.col("strip") * slabs + F.col("slab"))
    tasks = int(min(strips * slabs, 4 * parallelism(spark)))
    return both.select("cell", "side", "vec_id", "place", "vector").repartitionById(
        tasks, F.pmod(F.col("cell"), F.lit(tasks)).cast("int")).sortWithinPartitions("cell", "side")


_BEST = pa.schema([("query_id", pa.int64()), ("query", pa.int64()), ("vec_ids", pa.list_(pa.int64())),
                   ("places", pa.list_(pa.int64())), ("scores", pa.list_(pa.float64()))])


def nearest(embeddings: DataFrame, k: int = NEIGHBOURS, step: int = QUERY_STEP) -> DataFrame:
    """query_id, rank, vec_id, score: for every row whose vec_id is divisible
    by ``step`` the ``k`` rows with the largest inner products (all, if there
    are fewer), ties to the smaller vec_id; a query's own row is not among them.

    Null, zero and non-finite vectors and rows without an id take no part; a
    shorter vector counts as padded with zeros. Rows that repeat a vec_id are
    candidates and queries of their own. An empty table gives an empty result.
    """
    spark = embeddings.sparkSession
    wide = isinstance(embeddings.schema["embedding"].dataType.elementType, DoubleType)
    dtype = "<f8" if wide else "<f4"
    rows = vectors(embeddings)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, strip, parts = None, None, []
        for batch in batches:
            ids, places = batch.column("vec_id").to_numpy(), batch.column("place").to_numpy()
            sides, cells = batch.column("side").to_numpy(), batch.column("cell").to_numpy()
            given = batch.column("vector").to_pylist()
            cuts = np.flatnonzero((cells[1:] != cells[:-1]) | (sides[1:] != sides[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)]):
                if a == b:
                    continue
                if cells[a] != cell:
                    cell, strip, parts = cells[a], None, []
                if sides[a] == 0:
                    parts.append((given[a:b], ids[a:b], places[a:b]))
                    continue
                if strip is None and parts:
                    strip = Strip(_matrix([v for p in parts for v in p[0]], dtype), *(np.concatenate([p[c] for p in parts]) for c in (1, 2)), k)
                    parts = []
                if strip is None:
                    continue
                asked, known = _matrix(given[a:b], dtype), strip
                width = max(asked.shape[1], known.rows.shape[1])
                if asked.shape[1] < width:
                    asked = np.pad(asked, ((0, 0), (0, width - asked.shape[1])))
                elif known.rows.shape[1] < width:  # more components here: zeros in the candidates
                    asked = asked[:, :known.rows.shape[1]]
                which, vec, place, score = nearest_in_strip(asked, places[a:b], known, k)
                ends = np.searchsorted(which, np.arange(b - a + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(c)) for c in (vec, place, score)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b]), pa.array(places[a:b]), *lists], schema=_BEST)

    best = _cells(rows, step).mapInArrow(
        compare, "query_id bigint, query bigint, vec_ids array<bigint>, places array<bigint>, scores array<double>")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, query_id, heap = None, None, []

        def ranked() -> list[tuple]:
            return [(query_id, rank, -vec, score) for rank, (score, vec, _) in enumerate(sorted(heap, reverse=True), 1)]

        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if row["query"] != query:
                    out += ranked()
                    query, query_id, heap = row["query"], row["query_id"], []
                for vec, place, score in zip(row["vec_ids"], row["places"], row["scores"]):
                    entry = (score, -vec, -place)
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    else:
                        break  # a list's later entries are no nearer
            yield _ranks(out)
        yield _ranks(ranked())

    ordered = best.repartition(parallelism(spark), "query").sortWithinPartitions("query")
    return ordered.mapInArrow(merge, "query_id bigint, rank int, vec_id bigint, score double")


def _ranks(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
    columns = zip(*rows) if rows else ((),) * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "rank", "vec_id", "score"])
