"""Exact dedup by progressive refinement: length, prefix hash, full hash.

Texts are equal when they are identical without white space (space and
U+0009 to U+000D). One pass reduces each text to its normalised length and
the hash of a short prefix; lengths that occur once are settled there, then
(length, prefix hash) pairs that occur once. Only texts of pairs that are
left are hashed in full and grouped by SHA-256.

Groups are reduced with map-side aggregates and their one row each is joined
back (a sort-merge join that adaptive execution splits when one group holds
a large share of the rows). No text is ever shuffled to find the groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stage, texts

WHITE_SPACE = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
PREFIX_CHARS = 64
# A live (length, prefix) pair takes some 32 bytes in memory; up to this many
# are broadcast (32 MB), more are joined by a shuffle of digests.
BROADCAST_PAIRS = 1 << 20
# Places of dropped rows take some 16 bytes in memory.
BROADCAST_PLACES = 1 << 21


def normalised(text: Column) -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), WHITE_SPACE, text)


def _reduced(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, n_chars and the normalised text with its length and prefix hash."""
    body = texts(docs, *keep).select("doc_id", *keep, F.char_length("text").cast("bigint").alias("n_chars"),
                                     normalised(F.col("text")).alias("body"))
    return body.select("doc_id", *keep, "n_chars", "body", F.octet_length("body").alias("length"),
                       F.xxhash64(F.substring("body", 1, PREFIX_CHARS)).alias("prefix"))


def _grouped(docs: DataFrame, place: str | None, digest_all: bool) -> DataFrame:
    """row, doc_id, n_chars, keep_id, group_size, kept and text_sha256 of every
    row; ``place`` names the column that tells rows apart (None: numbered)."""
    own = [place] if place else []
    pairs = stage(_reduced(docs).groupBy("length", "prefix").count(), "pairs")
    lengths = pairs.groupBy("length").agg(F.sum("count").alias("n")).where("n > 1").select("length")
    live = stage(pairs.join(lengths, "length", "left_semi").where("count > 1")
                 .select("length", "prefix", F.lit(True).alias("live")), "live")
    digest = F.sha2("body", 256)
    rows = _reduced(docs, *own)
    if live.count() <= BROADCAST_PAIRS:
        rows = rows.join(F.broadcast(live), ["length", "prefix"], "left")
        digest = digest if digest_all else F.when(F.col("live"), digest)
        rows = rows.select("doc_id", *own, "n_chars", F.coalesce("live", F.lit(False)).alias("live"), digest.alias("text_sha256"))
    else:
        rows = rows.select("doc_id", *own, "n_chars", "length", "prefix", digest.alias("text_sha256"))
        rows = rows.join(live, ["length", "prefix"], "left").select(
            "doc_id", *own, "n_chars", F.coalesce("live", F.lit(False)).alias("live"), "text_sha256")
    rows = stage(rows.withColumn("row", F.col(place) if place else F.monotonically_increasing_id()), "hashed")
    best = F.min(F.struct((-F.col("n_chars")).alias("chars"), F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    # written, so that the join below has plain exchanges and can be split
    groups = stage(rows.where("live").groupBy("text_sha256").agg(best.alias("best"), F.count("*").alias("group_size"))
                   .select("text_sha256", "group_size", F.col("best.doc_id").alias("keep_id"),
                           F.col("best.row").alias("keep_row")), "groups")
    grouped = rows.where("live").join(groups, "text_sha256").select(
        "row", "doc_id", "n_chars", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")
    single = rows.where("not live").select(
        "row", "doc_id", "n_chars", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    return grouped.unionByName(single)


def exact_groups(docs: DataFrame, digest_all: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_chars, keep_id, group_size, kept, and
    text_sha256 of the normalised text (null for texts settled before the full
    hash, unless ``digest_all``).

    Of a group the row with the most code points in its original text stays,
    then the one with the smallest doc_id (a null doc_id loses); of repeated
    rows exactly one stays. Null texts equal empty ones. An empty table gives
    an empty result.
    """
    return _grouped(docs, None, digest_all).drop("row")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that :func:`exact_groups` does not keep.

    Rows are told apart by their places, so neither repeated nor missing ids
    matter. The documents are written once with them; only texts whose length
    and prefix others share are hashed. The places of dropped rows are
    broadcast where they take ``BROADCAST_PLACES`` rows or fewer."""
    place = "__row"
    while place in docs.columns:
        place += "_"
    placed = stage(docs.withColumn(place, F.monotonically_increasing_id()), "placed")
    gone = stage(_grouped(placed, place, False).where("not kept").select(F.col("row").alias(place)), "exact_copies")
    if gone.count() <= BROADCAST_PLACES:
        gone = F.broadcast(gone)
    return placed.join(gone, place, "left_anti").select(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns])
