"""SimHash near-dedup by tiled exact comparison.

Every text becomes a 64-bit SimHash of its word shingles. Distinct
fingerprints are laid out in tiles by population count, tiles are compared
pairwise with numpy (exclusive-or, bit count), and tile pairs whose
population counts differ by more than the radius are never formed: flipping
one bit changes a population count by one.

The counts are taken per 16-bit quarter of the fingerprint, so a tile's cell
is four numbers and two cells can hold a link only if those differ by at most
``radius`` in all: 129 of the 17^4 cells around each cell for a radius of 3.
That skips some 95 % of the tile pairs, where one count over all 64 bits skips
half. The comparison of what is left is exact.

Equal fingerprints are compared once. A tile pair gives a spanning forest of
its links, not the links, so a group of n near copies costs n rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ledgerline.llm.common import ship_package, stage, texts
from ledgerline.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
TILE = 4096
_QUARTERS = 4
_STRIP = 256
_TOGETHER = 65536


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text: lower-cased A-Z, words between
    ASCII white space, shingles of ``words`` words joined by blanks, repeats
    included; a shorter text is one shingle and one without words gives 0."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = iter([b" ".join(tokens)])
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words))))
    ones, n = np.zeros(64, np.int64), 0
    while hashes := [xxhash.xxh64_intdigest(s, SEED) for s in itertools.islice(shingles, _TOGETHER)]:
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and the fingerprint (as a signed 64-bit number) of every text."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py().encode(), words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, fp bigint")


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a[i], b[i]) between numbered nodes, reduced to one link from
    each node to the smallest node it is connected with."""
    n = int(max(a.max(), b.max())) + 1 if len(a) else 0
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within ``radius`` bits between two tiles
    of unsigned fingerprints (``None``: within the one), as two arrays."""
    both = left if right is None else np.concatenate([left, right])
    other, shift = (left, 0) if right is None else (right, len(left))
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(left), _STRIP):
        near = np.bitwise_count(left[at:at + _STRIP, None] ^ other[None, :]) <= radius
        i, j = np.nonzero(near)
        i, j = i + at, j + shift
        new = i < j
        if new.any():
            a, b = _forest(np.concatenate([a, i[new]]), np.concatenate([b, j[new]]))
    return both[a], both[b]


def links_within(fps: DataFrame, radius: int = MAX_DISTANCE, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect all of the distinct fingerprints ``fp`` that
    lie within ``radius`` bits of each other, directly or through others."""
    spark = fps.sparkSession
    ship_package(spark)
    quarters = [F.bit_count(F.shiftrightunsigned("fp", 16 * q).bitwiseAND(F.lit(0xFFFF))) for q in range(_QUARTERS)]
    cell = sum((c * 17 ** q for q, c in enumerate(quarters)), F.lit(0)).cast("int")
    fps = stage(fps.select("fp", cell.alias("cell")), "cells")
    # one row for each cell in use: at most 17^4 = 83,521, whatever the input
    cells = spark.createDataFrame(
        [(r.cell, -(-r["count"] // tile)) for r in fps.groupBy("cell").count().collect()], "cell int, parts int")
    tiles = stage(
        fps.join(F.broadcast(cells), "cell").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .groupBy("cell", "part").agg(F.collect_list("fp").alias("fps")), "tiles")
    # Cells around a cell, each unordered pair once.
    steps = [s for s in itertools.product(range(-radius, radius + 1), repeat=_QUARTERS) if sum(map(abs, s)) <= radius and s >= (0,) * 4]
    ends = [F.floor(F.col("cell") / 17 ** q).cast("int") % 17 + F.get("step", F.lit(q)) for q in range(_QUARTERS)]
    inside = [(e >= 0) & (e <= 16) for e in ends]
    pairs = (cells.withColumn("step", F.explode(F.lit([list(s) for s in steps])))
             .where(inside[0] & inside[1] & inside[2] & inside[3])
             .select("cell", "parts", sum((e * 17 ** q for q, e in enumerate(ends)), F.lit(0)).cast("int").alias("cell2"))
             .join(F.broadcast(cells.select(F.col("cell").alias("cell2"), F.col("parts").alias("parts2"))), "cell2")
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .withColumn("part2", F.explode(F.sequence(F.lit(0), F.col("parts2") - 1)))
             .where("cell <> cell2 or part <= part2").select("cell", "part", "cell2", "part2"))
    compared = (pairs.join(tiles, ["cell", "part"])
                .join(tiles.select(F.col("cell").alias("cell2"), F.col("part").alias("part2"), F.col("fps").alias("fps2")), ["cell2", "part2"])
                .select(((F.col("cell") == F.col("cell2")) & (F.col("part") == F.col("part2"))).alias("same"), "fps", "fps2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = batch.column("same").to_pylist()
            columns = []
            for name in ("fps", "fps2"):
                lists = batch.column(name)
                values = lists.values.to_numpy().view(np.uint64)
                columns.append((values, lists.offsets.to_numpy()))
            (left, l0), (right, r0) = columns
            a, b = [], []
            for i, alone in enumerate(same):
                x, y = tile_links(left[l0[i]:l0[i + 1]], None if alone else right[r0[i]:r0[i + 1]], radius)
                if len(x):
                    a.append(x)
                    b.append(y)
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)], names=["a", "b"])

    return compared.mapInArrow(run, "a bigint, b bigint")


def near_components(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = MAX_DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest doc_id reachable over links, a document's
    own included (null only if no member has an id). Null and empty texts have
    fingerprint 0 and are linked like any other; repeated rows get repeated
    results; an empty table gives an empty result.
    """
    rows = stage(fingerprints(docs, words), "fingerprints")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    joined = stage(connected_components(links_within(distinct.select("fp"), radius)), "joined")
    joined = joined.select(F.col("node").alias("fp"), "component").join(distinct, "fp")
    roots = joined.groupBy("component").agg(F.min("first").alias("least"))
    least = joined.join(roots, "component").select("fp", "least")
    # written, so that both sides of the last join are plain exchanges and a
    # fingerprint that many rows share is split
    classes = stage(distinct.join(least, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")), "components")
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest
    doc_id (a null one loses), of rows that repeat it one. Rows are told apart
    by their place, so neither repeated nor missing ids matter."""
    ship_package(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint((t.as_py() or "").encode(), words) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.array(found, np.uint64).view(np.int64))], names=[*batch.schema.names, "__fp"])

    schema = StructType([*docs.schema.fields, StructField("__fp", LongType())])
    marked = stage(docs.mapInArrow(run, schema).withColumn("__row", F.monotonically_increasing_id()), "marked")
    rows = marked.select(F.col("__fp").alias("fp"), F.col("__row").alias("row"),
                         F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row").alias("row")).alias("place"))
    distinct = stage(rows.groupBy("fp").agg(F.min("place").alias("first")), "distinct")
    joined = stage(connected_components(links_within(distinct.select("fp"), radius)), "joined")
    joined = joined.select(F.col("node").alias("fp"), "component").join(distinct, "fp")
    least = joined.join(joined.groupBy("component").agg(F.min("first").alias("least")), "component").select("fp", "least")
    # written, as in near_components
    stays = stage(distinct.join(least, "fp", "left").select("fp", F.coalesce("least", "first")["row"].alias("stays")), "stays")
    gone = stage(rows.join(stays, "fp").where("row <> stays").select(F.col("row").alias("__row")), "near_copies")
    return marked.join(gone, "__row", "left_anti").select(docs.columns)
