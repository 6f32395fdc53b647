"""Merkle dataset manifest by cogrouped subtree exchange.

Every row is a leaf (SHA-256 of its columns); each source's leaves, by
ascending doc_id, form a tree of runs of three, and the sources' roots form
one more. Digests enter a hash as lower-case hex text.

Rows get their places from one range-partitioned sort by (source, doc_id):
each task numbers its own rows, and one row for each task (where its first
run of a source goes on) is enough to make the numbers global. So a source
that holds a third of all rows is spread like any other.

Trees are reduced in superblocks of 3^5 nodes. The way up keeps one node for
each superblock; the way down cogroups a superblock's nodes with the outer
part of their proofs, finishes the reduction inside it, joins the proofs and,
at the leaves, folds them. No group is larger than a superblock.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import parallelism, ship_package, stage

RUN = 3
LEVELS = 5
BLOCK = RUN ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: Column) -> Column:
    """A row's leaf with ``text`` in the place of its text."""
    return F.sha2(F.concat(*[_field(text if name == "text" else F.col(name)) for name in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf and the leaf after tampering (null: the same).

    Tampering takes the line ends out of the text where crc32 of the decimal
    doc_id is even; a row without an id is left alone."""
    docs = docs.select(*FIELDS)
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False)) & F.col("text").contains("\n")
    return docs.select("doc_id", "source", leaf_digest(F.col("text")).alias("leaf"),
                       F.when(hit, leaf_digest(F.replace("text", F.lit("\n"), F.lit("")))).alias("tampered"))


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with tree (number of the source, null first, then bytewise)
    and pos (place in the source by doc_id, a null id first, ties by digest)."""
    spark = rows.sparkSession
    rows = stage(rows.withColumn("place", F.monotonically_increasing_id()), "leaves")
    order = [F.col(c).asc_nulls_first() for c in ("source", "doc_id", "leaf", "place")]
    ordered = rows.repartitionByRange(parallelism(spark), *order).sortWithinPartitions(*order)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, run, at, last = TaskContext.get().partitionId(), -1, 0, None
        for batch in batches:
            runs, places = [], []
            for source in batch.column("source").to_pylist():
                if run < 0 or source != last:
                    run, at, last = run + 1, 0, source
                runs.append(run)
                places.append(at)
                at += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(runs), pa.int32()), pa.array(runs, pa.int64()), pa.array(places, pa.int64()), *batch.columns],
                names=["part", "run", "at", *batch.schema.names])

    ordered = ordered.select("doc_id", "source", "leaf", "tampered")
    ordered = stage(ordered.mapInArrow(
        number, "part int, run bigint, at bigint, doc_id bigint, source string, leaf string, tampered string"), "ordered")
    ends = ordered.groupBy("part").agg(F.min(F.struct("run", "at", "source")).alias("first"),
                                       F.max(F.struct("run", "at", "source")).alias("last"))
    # one row for each task of the sort, whatever the input
    carried, tree, count, before = [], -1, 0, None
    for e in sorted(ends.collect(), key=lambda e: e.part):
        goes_on = tree >= 0 and e.first.source == before
        base, held = (tree, count) if goes_on else (tree + 1, 0)
        carried.append((e.part, base, held))
        tree, before = base + e.last.run, e.last.source
        count = e.last.at + 1 + (held if e.last.run == 0 else 0)
    starts = spark.createDataFrame(carried, "part int, base bigint, held bigint")
    return ordered.join(F.broadcast(starts), "part").select(
        (F.col("base") + F.col("run")).alias("tree"),
        (F.col("at") + F.when(F.col("run") == 0, F.col("held")).otherwise(0)).alias("pos"),
        "doc_id", "source", "leaf", "tampered")


def reduce_block(digests: list[str], exact: bool) -> list[list[str]]:
    """All levels over a superblock's nodes. The first superblock of a tree is
    reduced to one node; a later one (``exact``) through all ``LEVELS``, since
    then the tree goes on above it."""
    levels = [digests]
    while len(levels) <= LEVELS if exact else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i:i + RUN])) for i in range(0, len(below), RUN)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What stands left and right of a node in its run, level by level."""
    found = []
    for level in levels[:-1]:
        start = at - at % RUN
        found.append(("".join(level[start:at]), "".join(level[at + 1:start + RUN])))
        at //= RUN
    return found


def _written(path: list[tuple[str, str]]) -> str:
    return ";".join(f"{left}|{right}" for left, right in path)


def _read(path: str) -> list[tuple[str, str]]:
    return [tuple(level.split("|")) for level in path.split(";")] if path else []


def fold(digest: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        digest = sha(left + digest + right)
    return digest


def _block() -> Column:
    return F.expr(f"pos div {BLOCK}").alias("block")


def _up(nodes: DataFrame) -> DataFrame:
    """(tree, pos, digest) of the superblocks of (tree, pos, digest)."""

    def top(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        levels = reduce_block(group.sort_values("pos")["digest"].tolist(), key[1] > 0)
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "digest": levels[-1]})

    return nodes.select("tree", "pos", "digest", _block()).groupBy("tree", "block").applyInPandas(
        top, "tree bigint, pos bigint, digest string")


def _rounds(nodes: DataFrame, name: str) -> list[DataFrame]:
    """``nodes`` and what each round of superblocks leaves, up to one node for
    every tree: one round for each factor of 243 in the largest tree."""
    rounds = [nodes]
    while True:
        rounds.append(stage(_up(rounds[-1]), name))
        if rounds[-1].where("pos > 0").limit(1).count() == 0:
            return rounds


_OUTER = "tree bigint, pos bigint, digest string, path string, subroot string, root string"


def _down(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """The proofs of ``nodes``, given those of their superblocks."""

    def join(key: tuple, group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        group, above = group.sort_values("pos"), above.iloc[0]
        digests = group["digest"].tolist()
        levels = reduce_block(digests, key[1] > 0)
        paths = [";".join(filter(None, (_written(siblings(levels, i)), above["path"]))) for i in range(len(digests))]
        return pd.DataFrame({"tree": group["tree"], "pos": group["pos"], "digest": digests, "path": paths,
                             "subroot": above["subroot"], "root": above["root"]})

    return (nodes.select("tree", "pos", "digest", _block()).groupBy("tree", "block")
            .cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block")).applyInPandas(join, _OUTER))


_RESULT = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _folded(rows: DataFrame, outer: DataFrame) -> DataFrame:
    """The leaves' results, given the proofs of their superblocks."""

    def finish(key: tuple, group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        group, above = group.sort_values("pos"), above.iloc[0]
        originals = group["leaf"].tolist()
        levels, shared = reduce_block(originals, key[1] > 0), _read(above["path"])
        tail = "".join(left + right for left, right in shared)
        proofs, roots = [], []
        for i, (leaf, changed) in enumerate(zip(originals, group["tampered"])):
            path = siblings(levels, i)
            proofs.append(sha("".join(left + right for left, right in path) + tail))
            roots.append(fold(fold(changed if isinstance(changed, str) else leaf, path), shared))
        return pd.DataFrame({"doc_id": group["doc_id"], "leaf": originals, "subroot": above["subroot"], "root": above["root"],
                             "proof_sha256": proofs, "folded_root": roots, "verified": [r == above["root"] for r in roots]})

    # ids travel as text: pandas would turn a column with nulls into floats
    rows = rows.select("tree", "pos", F.col("doc_id").cast("string").alias("doc_id"), "leaf", "tampered", _block())
    done = rows.groupBy("tree", "block").cogroup(outer.withColumnRenamed("pos", "block").groupBy("tree", "block")) \
        .applyInPandas(finish, _RESULT)
    return done.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def _forest(docs: DataFrame) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """The numbered leaves, the rounds of the sources' trees, and for every
    source its root (digest, subroot) with its proof (path) and the root."""
    ship_package(docs.sparkSession)
    rows = _numbered(leaves(docs))
    rounds = _rounds(rows.select("tree", "pos", F.col("leaf").alias("digest")), "subtrees")
    subroots = rounds[-1].select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), "digest")
    above = _rounds(subroots, "sources")
    outer = above[-1].select("tree", "pos", "digest", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    for nodes in reversed(above[:-1]):
        outer = _down(nodes, outer)
    trees = outer.select(F.col("pos").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "digest", "path",
                         F.col("digest").alias("subroot"), "root")
    return rows, rounds, stage(trees, "trees")


def verify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for
    every row of ``docs`` (doc_id, source, lang, n_chars, text).

    A null in any column enters the leaf as ``-``; an empty text is ``0:``.
    Rows without a source form a tree of their own, the first; rows without an
    id come first in their source and are never tampered with. Rows that repeat
    a doc_id are ordered by their leaves, equal rows are leaves of their own. A
    lone leaf is its source's root, a lone source's root is the root, and a
    proof without siblings is the digest of the empty string. An empty table
    gives an empty result.
    """
    rows, rounds, outer = _forest(docs)
    for nodes in reversed(rounds[1:-1]):
        outer = _down(nodes, outer)
    return _folded(rows, outer)


def manifest(docs: DataFrame) -> DataFrame:
    """source, n_rows, subroot and root: what is kept to verify rows later."""
    rows, _, trees = _forest(docs)
    sources = rows.groupBy("tree").agg(F.first("source").alias("source"), F.count("*").alias("n_rows"))
    return sources.join(trees, "tree").select("source", "n_rows", "subroot", "root")
