"""Cross-tokenizer alignment by inverted pair bitmaps.

Two tokenizers encode the same text; where a token of each ends at the same
byte, the two are linked. Documents take numbered places in blocks, and for
every pair of linked ids a block keeps a compressed bitmap of the documents
that link it, with planes for multiplicity: plane k has the documents in whose
number of such links, less one, bit k is set.

Bitmaps of a pair and block are OR-ed together and counted; the sums over
blocks are a pair's document and link counts. Its score then returns along
its postings to the documents: each adds score times multiplicity to its
place. No vocabulary table and no pair table is broadcast, and a pair that
occurs in a third of all documents is spread over its blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import bitmaps
from ledgerline.llm.bpe import ForcedBoundaryEncoder
from ledgerline.llm.common import ship_package, stage

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
FLUSH_LINKS = 2_000_000  # links a task holds before it writes their bitmaps
TOGETHER = 1_000_000     # characters of text aligned at once, or one longer text
SPLIT = 4                # tasks that a block's postings return to


class Pair:
    """The two tokenizers, and the alignment of texts by them."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = ForcedBoundaryEncoder(a_path)
        self.a._split_special = None  # special tokens' strings are plain text
        self.a.tokenizer.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = [self.a.token_bytes.get(i, b"") for i in range(max(self.a.token_bytes) + 1)]
        self.b_bytes = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.a_length, self.b_length = (np.array([len(t) for t in table]) for table in (self.a_bytes, self.b_bytes))
        self.size = len(self.b_bytes)

    @staticmethod
    def _piece(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE, " ").encode()

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of each text by both; none where there is no text, or where
        either's bytes are not the text's after a space."""
        none = np.empty(0, np.int64)
        a, b = [none] * len(texts), [none] * len(texts)
        full = [i for i, t in enumerate(texts) if t]
        given = [texts[i] for i in full]
        for i, text, x, y in zip(full, given, self.a.encode_many(" " + t for t in given), self.b.encode(given, num_threads=1)):
            raw = b" " + text.encode()
            if b"".join(map(self.b_bytes.__getitem__, y)) == raw and b"".join(map(self.a_bytes.__getitem__, x.tolist())) == raw:
                a[i], b[i] = x.astype(np.int64), np.array(y, np.int64)
        return a, b


_pairs: dict[tuple[str, str], Pair] = {}


def pair(a_path: str | None, b_path: str | None) -> Pair:
    """The tokenizers of two vocabulary files, made once per Python worker."""
    if a_path is None or b_path is None:
        import public_tokenizers

        a_path, b_path = a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE)
    if (a_path, b_path) not in _pairs:
        _pairs[a_path, b_path] = Pair(a_path, b_path)
    return _pairs[a_path, b_path]


def _decimal(ids: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal ids, each followed by its separator, as bytes, and their ends."""
    limits = 10 ** np.arange(1, 10)
    digits = 1 + np.searchsorted(limits, ids, side="right")
    ends = np.cumsum(digits + 1)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    out[ends - 1] = separators
    rest = ids
    at = ends - 2
    while len(rest):
        rest, digit = np.divmod(rest, 10)
        out[at] = 48 + digit
        more = rest > 0
        rest, at = rest[more], at[more] - 1
    return out, ends


def align(tokens: tuple[list[np.ndarray], list[np.ndarray]], tokenizers: Pair) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Of texts by their ids: the linked ids (all texts' one after the other),
    the number of links of each text, and the digest of its groups."""
    n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in tokens)
    a, b = (np.concatenate([np.empty(0, np.int64), *side]) for side in tokens)
    end_a, end_b = np.cumsum(tokenizers.a_length[a]), np.cumsum(tokenizers.b_length[b])
    ends = np.zeros(int(end_a[-1]) + 1 if len(a) else 1, np.uint8)
    ends[end_a] += 1
    ends[end_b] += 2
    last_a, last_b = ends[end_a] == 3, ends[end_b] == 3
    # groups in order: the A ids of each, then its B ids
    before_a, before_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    through_a, through_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
    at_a = np.arange(len(a)) + np.r_[0, through_b][before_a]
    at_b = np.arange(len(b)) + np.r_[through_a, 0][before_b]
    ids, separators = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
    ids[at_a], ids[at_b] = a, b
    separators[at_a] = np.where(last_a, ord("|"), ord(","))
    separators[at_b] = np.where(last_b, ord(";"), ord(","))
    written, at = _decimal(ids, separators)
    through = np.r_[0, at][np.cumsum(np.r_[0, n_a + n_b])]
    view = memoryview(written)
    digests = [hashlib.sha256(view[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(through[:-1].tolist(), through[1:].tolist())]
    links = np.diff(np.r_[0, np.cumsum(last_a)][np.cumsum(np.r_[0, n_a])])
    return a[last_a], b[last_b], links, digests


def postings(links: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Links (pair * 65,536 + place) as distinct pairs, their bitmaps and
    their planes."""
    seen, count = np.unique(links, return_counts=True)
    key, place = seen >> 16, seen & (bitmaps.PLACES - 1)
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    sizes = np.diff(np.r_[new, len(key)])
    row = np.repeat(np.arange(len(new)), sizes)
    return key[new], bitmaps.pack(sizes, place), _planes(row, place, count - 1, len(new))


def _planes(row: np.ndarray, place: np.ndarray, extra: np.ndarray, rows: int) -> pa.Array:
    """The binary digits of ``extra`` as a list of bitmaps for each row."""
    some = extra > 0
    row, place, extra = row[some], place[some], extra[some]
    high = np.zeros(rows, np.int64)
    np.maximum.at(high, row, extra)
    depth = np.frexp(high.astype(np.float64))[1].astype(np.int64)  # bits of the largest
    start = np.cumsum(depth) - depth
    which, where = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k in range(int(depth.max(initial=0))):
        has = (extra >> k) & 1 == 1
        which.append(start[row[has]] + k)
        where.append(place[has])
    which, where = np.concatenate(which), np.concatenate(where)
    order = np.lexsort((where, which))
    flat = bitmaps.pack(np.bincount(which, minlength=int(depth.sum())), where[order])
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(depth)].astype(np.int32)), flat)


def _plane_weights(planes: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row, weight (2^k) and bitmap of every plane of a column of lists."""
    flat, depth = planes.flatten(), planes.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(planes)), depth)
    return row, np.int64(1) << (np.arange(len(row)) - np.repeat(np.cumsum(depth) - depth, depth)).astype(np.int64), flat


_POSTED = [("block", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
           ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("pair", pa.int64()), ("docs", pa.binary()),
           ("planes", pa.list_(pa.binary()))]
_POSTED_SQL = ("block bigint, place int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, "
               "pair bigint, docs binary, planes array<binary>")


def _posted(docs: DataFrame, a_path: str | None, b_path: str | None, flush: int) -> DataFrame:
    """One pass over the texts: a row for each document with its place, and a
    row for each pair and block (or part of one) with its bitmaps."""
    ship_package(docs.sparkSession)

    def batch_of(length: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[n], t) if n in columns and not isinstance(columns[n], pa.Array) else
             columns[n] if n in columns else pa.nulls(length, t) for n, t in _POSTED], schema=pa.schema(_POSTED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizers = pair(a_path, b_path)
        part, number, used = TaskContext.get().partitionId(), 0, 0
        block = lambda: part + (number << 32)
        held: list[np.ndarray] = []
        size = 0

        def written() -> Iterator[pa.RecordBatch]:
            if held:
                keys, marks, planes = postings(np.concatenate(held))
                if len(keys):
                    yield batch_of(len(keys), block=np.full(len(keys), block()), pair=keys, docs=marks, planes=planes)

        for batch in batches:
            at, texts = 0, [t or "" for t in batch.column("text").to_pylist()]
            through = np.cumsum([0, *map(len, texts)])
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(through, through[at] + TOGETHER, side="right")) - 1)
                some = batch.slice(at, min(end - at, bitmaps.PLACES - used))
                tokens = tokenizers.encode(texts[at:at + some.num_rows])
                a, b, links, digests = align(tokens, tokenizers)
                places = np.arange(used, used + some.num_rows)
                yield batch_of(some.num_rows, block=np.full(some.num_rows, block()), place=places.astype(np.int32),
                               doc_id=some.column("doc_id"), n_a=[len(x) for x in tokens[0]], n_b=[len(x) for x in tokens[1]],
                               n_groups=links, groups_sha256=digests)
                held.append(((a * tokenizers.size + b) << 16) | np.repeat(places, links))
                size, used, at = size + len(a), used + some.num_rows, at + some.num_rows
                if size >= flush or used == bitmaps.PLACES:
                    yield from written()
                    held, size = [], 0
                if used == bitmaps.PLACES:
                    number, used = number + 1, 0
        yield from written()

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stage(given.mapInArrow(run, _POSTED_SQL), "posted")


def merge_postings(posted: DataFrame) -> DataFrame:
    """pair, block, docs, planes, documents and links: the bitmaps of a pair
    and block OR-ed together and counted."""

    def merged(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs, blocks = batch.column("pair").to_numpy(), batch.column("block").to_numpy()
        docs, planes = batch.column("docs"), batch.column("planes")
        new = np.r_[True, (pairs[1:] != pairs[:-1]) | (blocks[1:] != blocks[:-1])]
        if not new.all():
            group = np.cumsum(new) - 1
            groups = int(group[-1]) + 1
            row, weight, flat = _plane_weights(planes)
            # parts of a block have no document in common, so planes are OR-ed digit by digit
            which, place = bitmaps.unpack(flat)
            digits = np.unique((group[row[which]] << 22) | (place.astype(np.int64) << 6) | np.frexp(weight[which])[1] - 1)
            key, digit = digits >> 6, np.int64(1) << (digits & 63)
            seen, first = np.unique(key, return_index=True)
            extra = np.add.reduceat(digit, first) if len(first) else np.empty(0, np.int64)
            docs, planes = bitmaps.union(docs, group, groups), _planes(seen >> 16, seen & (bitmaps.PLACES - 1), extra, groups)
            pairs, blocks = pairs[new], blocks[new]
        documents = bitmaps.popcounts(docs)
        row, weight, flat = _plane_weights(planes)
        links = documents.copy()
        np.add.at(links, row, weight * bitmaps.popcounts(flat))
        return pa.RecordBatch.from_arrays(
            [pa.array(pairs), pa.array(blocks), docs, planes, pa.array(documents), pa.array(links)],
            names=["pair", "block", "docs", "planes", "documents", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # rows of the last pair and block, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            if held:
                batch = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
            pairs, blocks = batch.column("pair").to_numpy(), batch.column("block").to_numpy()
            cut = len(pairs) - int(np.argmin(((pairs == pairs[-1]) & (blocks == blocks[-1]))[::-1]))
            if ((pairs == pairs[-1]) & (blocks == blocks[-1])).all():
                cut = 0
            held = [batch.slice(cut)]
            if cut:
                yield merged(batch.slice(0, cut))
        if held:
            yield merged(held[0])

    keyed = posted.where("pair is not null").select("pair", "block", "docs", "planes")
    ordered = keyed.repartition("pair", "block").sortWithinPartitions("pair", "block")
    return stage(ordered.mapInArrow(
        run, "pair bigint, block bigint, docs binary, planes array<binary>, documents bigint, links bigint"), "postings")


def _scores(merged: DataFrame, size: int) -> DataFrame:
    """pair, documents, links and best (no pair with the same B id has more
    links)."""
    counts = stage(merged.groupBy("pair").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links")), "counts")
    most = counts.groupBy((F.col("pair") % size).alias("b")).agg(F.max("links").alias("most"))
    return counts.join(most, F.col("pair") % size == F.col("b")).select(
        "pair", "documents", "links", (F.col("links") == F.col("most")).alias("best"))


def _returned(merged: DataFrame, scores: DataFrame) -> DataFrame:
    """(block, place, n_best, count_sum): every posting adds its pair's score
    to its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sums = None, None

        def done() -> Iterator[pa.RecordBatch]:
            if sums is not None:
                at = np.flatnonzero(sums[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), block)), pa.array(at.astype(np.int32)), pa.array(sums[1][at]), pa.array(sums[0][at])],
                    names=["block", "place", "n_best", "count_sum"])

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            cuts = (np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist()
            for s, e in zip([0, *cuts], [*cuts, len(blocks)]):
                if s == e:
                    continue
                if blocks[s] != block:
                    yield from done()
                    block, sums = blocks[s], np.zeros((2, bitmaps.PLACES), np.int64)
                rows = batch.slice(s, e - s)
                links = rows.column("links").to_numpy()
                best = rows.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
                which, place = bitmaps.unpack(rows.column("docs"))
                np.add.at(sums[0], place, links[which])
                np.add.at(sums[1], place, best[which])
                row, weight, flat = _plane_weights(rows.column("planes"))
                which, place = bitmaps.unpack(flat)
                np.add.at(sums[0], place, (links[row] * weight)[which])
                np.add.at(sums[1], place, (best[row] * weight)[which])
        yield from done()

    scored = merged.select("pair", "block", "docs", "planes").join(scores.select("pair", "links", "best"), "pair")
    dealt = scored.withColumn("split", F.pmod("pair", F.lit(SPLIT))).repartition("block", "split").sortWithinPartitions("block")
    sums = dealt.select("block", "docs", "planes", "links", "best").mapInArrow(
        run, "block bigint, place int, n_best bigint, count_sum bigint")
    return sums.groupBy("block", "place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def pair_counts(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, flush: int = FLUSH_LINKS) -> DataFrame:
    """a_id, b_id, documents, links and best for every linked pair of ids."""
    size = pair(a_path, b_path).size
    scores = _scores(merge_postings(_posted(docs, a_path, b_path, flush)), size)
    return scores.select(F.floor(F.col("pair") / size).cast("bigint").alias("a_id"), (F.col("pair") % size).alias("b_id"),
                         "documents", "links", "best")


def align_documents(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, flush: int = FLUSH_LINKS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256
    for every row of ``docs``.

    A null or empty text, or one that either tokenizer does not keep byte for
    byte (after the space both put before it), has no tokens: zeros and an
    empty digest. Repeated rows count as often as they occur and give results
    of their own; a null doc_id is kept. An empty table gives an empty result.

    The paths name vocabulary files that every executor has (default: each
    one's own copy of the public ones).
    """
    size = pair(a_path, b_path).size
    posted = _posted(docs, a_path, b_path, flush)
    merged = merge_postings(posted)
    sums = _returned(merged, _scores(merged, size))
    rows = posted.where("pair is null").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.join(sums, ["block", "place"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), zero("n_best"), zero("count_sum"), "groups_sha256")
