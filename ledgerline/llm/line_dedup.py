"""Line dedup: a segment-partition edit join over the lines of all documents.

Equal lines are one line. Two different lines are linked if few insertions,
deletions or substitutions turn one into the other: at most ``MAX_EDITS`` if
the shorter one has ``MIN_CHARS`` code points or more, one if it is shorter
than that, none if it has ``MAX_EDITS`` code points or fewer, which that many
edits replace altogether. Lines linked directly or through others are one
class, and its first line (by doc_id, line number) stays.

The join (after Li et al., "PASS-JOIN", 2011): a line is cut into one segment
more than it may have edits, of which at least one survives them whole. Every
line enters its segments in an index keyed by line length, segment number and
content, and probes the index of each admissible length, its own or shorter,
with the substrings that can match there. Lines that meet under a key are
candidates; their texts are then fetched and verified by banded bit-parallel
edit distance.

Under a key with more than ``MEET`` lines no pairs are formed. Its lines go
through the join once more, cut into more segments (``SEGMENTS``): edits leave
all segments but as many whole, so a key is now all of a line but that many of
its segments, and lines of one template meet no longer under the template
alone. Every step is exact: a pair within the edits meets under some key,
which either forms it or hands both lines on. Lines crowded in the last step
too, which agree with many others on nearly all their characters, are dealt
into blocks under their first keys, and blocks are compared pairwise, each
task giving a spanning forest of the links it finds: rows grow with a key's
lines, not with their square. Two lines are compared there once, under the
smallest of the keys they share.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import accumulate, chain, combinations, pairwise, product, repeat
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import order_key, ship_package, stage, texts
from ledgerline.llm.components import connected_components

MAX_EDITS = 2
# Lines from this many code points on may differ by MAX_EDITS, shorter ones by
# one: two edits are a fifth of such a line, and most of a word or two.
MIN_CHARS = 10
MEET = 32
# Segments of the lines that were crowded in the step before. A step is left
# out if it would give a line more than MASKS keys of its own.
SEGMENTS = (8, 16)
MASKS = 600
# All bits of a key but the one that tells whether the line is indexed.
ANY = -2
# Lines that a task remembers, so that it enters none of its lines twice.
SEEN = 500_000
BLOCK = 256
# Candidate lines up to this many (8 bytes each) are broadcast to filter the
# second scan; beyond it the scan is joined by a shuffle.
BROADCAST_LINES = 1 << 20


def _common_start(a: str, b: str) -> int:
    """Code points that two strings share at their start, found by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def within(a: str, b: str, k: int) -> bool:
    """Whether the edit distance of two strings is at most ``k``.

    Common ends are set aside. The rest runs through Hyyrö's bit-parallel
    recurrence (2003) on the band of 2k + 1 diagonals: one word of vertical
    differences per column, moved one row down with each column.
    """
    if abs(len(a) - len(b)) > k:
        return False
    lo = _common_start(a, b)
    a, b = a[lo:], b[lo:]
    end = _common_start(a[::-1], b[::-1])
    a, b = a[:len(a) - end], b[:len(b) - end]
    m, n = len(a), len(b)
    if min(m, n) == 0:
        return max(m, n) <= k
    if max(m, n) <= k:
        return True
    if m <= k:  # a few characters: shorter than the band
        above = list(range(n + 1))
        for i, x in enumerate(a, 1):
            row = [i]
            for j, y in enumerate(b, 1):
                row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
            above = row
        return above[-1] <= k
    rows: dict[str, int] = {}  # of the characters that the band has reached
    for i, c in enumerate(a[:k]):
        rows[c] = rows.get(c, 0) | 1 << i
    band = (1 << 2 * k + 1) - 1
    vp, vn, distance = (band >> k) << k, 0, k
    for j in range(n):
        if j + k < m:
            rows[a[j + k]] = rows.get(a[j + k], 0) | 1 << j + k
        # bit t of the band is row j - k + t of ``a``
        match = rows.get(b[j], 0)
        x = (match >> j - k if j >= k else match << k - j) & band
        d0 = (((x & vp) + vp) ^ vp) | x | vn
        hp = (vn | ~(d0 | vp)) & band
        hn = d0 & vp
        at = m - 1 - j + k  # bit of the last row
        if at >= 2 * k:
            distance += not d0 >> 2 * k & 1
            if distance > 3 * k + n - m:
                return False
        else:
            distance += (hp >> at & 1) - (hn >> at & 1)
        d0 = (d0 & band) >> 1
        vp, vn = (hn | ~(d0 | hp)) & band, d0 & hp
    return distance <= k


def allowed(length: int, edits: int, shortest: int) -> int:
    """Edits that may lie between a line of ``length`` and one as long or longer."""
    return 0 if length <= edits else edits if length >= shortest else min(edits, 1)


def _segments(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, end) of ``parts`` segments, the longer ones last."""
    size, longer = divmod(length, parts)
    starts = np.cumsum([0, *(size + (i >= parts - longer) for i in range(parts))]).tolist()
    return list(pairwise(starts))


# What a line looks under: a seed and the (start, end) of the parts it hashes.
Probe = tuple[int, tuple[tuple[int, int], ...]]


@lru_cache(maxsize=100_000)
def substrings(length: int, edits: int, shortest: int) -> tuple[tuple[Probe, ...], int]:
    """What a line of ``length`` looks under: its own segments first (their
    number comes second in the result), then the substrings it probes indexes
    of its own and shorter lengths with, chosen by the edits that can lie to
    the left and right of a match. The shorter of two lines, which is the
    indexed one, decides how many edits are allowed."""

    def segments(n: int) -> list[tuple[int, int]]:
        return _segments(n, allowed(n, edits, shortest) + 1)

    own = [(length * (edits + 1) + i, (part,)) for i, part in enumerate(segments(length))]
    probes = []
    for indexed in range(max(edits + 1, length - edits), length + 1):
        shift, most = length - indexed, allowed(indexed, edits, shortest)
        if shift > most:
            continue
        for i, (a, b) in enumerate(segments(indexed)):
            right = most - i
            for start in range(max(0, a - i, a + shift - right), min(length - (b - a), a + i, a + shift + right) + 1):
                probe = (indexed * (edits + 1) + i, ((start, start + b - a),))
                if probe not in own:
                    probes.append(probe)
    return (*own, *probes), len(own)


@lru_cache(maxsize=64)  # some thousand spans each; a batch's lines come by length
def remainders(length: int, edits: int, shortest: int, parts: int) -> tuple[tuple[Probe, ...], int]:
    """Like :func:`substrings`, for lines cut into ``parts`` segments of which
    as many are left out as there may be edits: the rest in between stands
    whole in the other line, each stretch of it moved by the insertions and
    deletions before it, one step at most for each segment left out."""

    def masks(indexed: int, shift: int, moving: tuple[int, ...]) -> Iterator[Probe]:
        most = allowed(indexed, edits, shortest)
        segments = _segments(indexed, min(indexed, parts))
        ways = [[0, *accumulate(steps)] for steps in product(moving, repeat=most) if sum(steps) == shift]
        for number, out in enumerate(combinations(segments, most)):
            edges = [0, *chain.from_iterable(out), indexed]
            stretches = list(zip(edges[::2], edges[1::2]))
            for moves in ways:
                yield indexed * (MASKS + 1) + number, tuple((a + m, b + m) for (a, b), m in zip(stretches, moves) if a < b)

    every = dict.fromkeys(masks(length, 0, (0,)))
    own = len(every)
    for indexed in range(max(edits + 1, length - edits), length + 1):
        every.update(dict.fromkeys(masks(indexed, length - indexed, (-1, 0, 1))))
    return tuple(every), own


def left_out(line: str, probe: Probe, edits: int, shortest: int) -> str:
    """What a probe of :func:`remainders` leaves out, after the edits allowed there."""
    seed, spans = probe
    edges = [0, *chain.from_iterable(spans), len(line)]
    return "\n".join([str(allowed(seed // (MASKS + 1), edits, shortest)), *(line[a:b] for a, b in zip(edges[::2], edges[1::2]))])


def near_left_out(a: str, b: str) -> bool:
    """Whether two lines under one key are near by what it leaves out of them."""
    most, *parts = a.split("\n")
    budget = int(most)
    for x, y in zip(parts, b.split("\n")[1:]):
        budget -= next((k for k in range(budget + 1) if within(x, y, k)), budget + 1)
        if budget < 0:
            return False
    return True


def _entries(lines: DataFrame, edits: int, shortest: int, parts: int | None = None) -> DataFrame:
    """(key, line): what every line (hash, line) looks under by
    :func:`substrings` or, given ``parts``, by :func:`remainders`, then with
    ``gap``, what is left out. In the result ``line`` is the hash and the
    key's last bit tells whether the line is indexed there. Equal lines of a
    task enter once, those of different tasks once each: their entries are the
    same and meet as one, so texts need no shuffle to find them."""
    plan = partial(remainders, edits=edits, shortest=shortest, parts=parts) if parts else partial(substrings, edits=edits, shortest=shortest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        seen: set[int] = set()
        for batch in batches:
            keys: list[int] = []
            owners, counts, index_counts, gaps = [], [], [], []
            new = {owner: line for owner, line in zip(batch.column("hash").to_pylist(), batch.column("line").to_pylist()) if owner not in seen}
            seen.update(new)
            for owner, line in sorted(new.items(), key=lambda r: len(r[1])):
                probes, own = plan(len(line))
                raw = line.encode()
                if len(raw) == len(line):
                    keys += [digest(b"".join([raw[a:b] for a, b in spans]), seed) for seed, spans in probes]
                else:
                    keys += [digest("".join([line[a:b] for a, b in spans]).encode(), seed) for seed, spans in probes]
                if parts:
                    gaps += [left_out(line, probe, edits, shortest) for probe in probes]
                owners.append(owner)
                counts.append(len(probes))
                index_counts.append(own)
                if len(keys) >= 200_000:
                    yield _entry_batch(keys, owners, counts, index_counts, gaps if parts else None)
                    keys, owners, counts, index_counts, gaps = [], [], [], [], []
            if keys:
                yield _entry_batch(keys, owners, counts, index_counts, gaps if parts else None)
            if len(seen) > SEEN:
                seen.clear()  # a line that enters again changes nothing

    return lines.select("hash", "line").mapInArrow(run, "key bigint, line bigint" + (", gap string" if parts else ""))


def _entry_batch(keys, owners, counts, index_counts, gaps) -> pa.RecordBatch:
    count = np.array(counts)
    place = np.arange(len(keys)) - np.repeat(np.cumsum(count) - count, count)
    indexed = place < np.repeat(index_counts, count)
    columns = {"key": pa.array((np.array(keys, np.uint64).view(np.int64) & ANY) | indexed), "line": pa.array(np.repeat(np.array(owners, np.int64), count))}
    return pa.RecordBatch.from_pydict(columns if gaps is None else columns | {"gap": pa.array(gaps, pa.string())})


def _meetings(entries: DataFrame, first: bool) -> DataFrame:
    """(a, b, key): candidate pairs with a null key, and lines (``a``) of keys
    with more than MEET, with their key in the ``first`` step, else once a
    batch with key 0. Later steps see by what is left out which lines are near
    and give a spanning forest of a key's. Keys pass in order, so a task holds
    one key's lines at a time, and never more than MEET of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held, crowded = None, {}, False  # held: (whether it is indexed, what is left out) of each line

        def close(out: set[tuple]) -> None:
            if crowded or len(held) < 2:
                return
            class_ = {line: line for line in held}
            for x, y in combinations(held, 2):
                if class_[x] != class_[y] and any(
                        (own or also) and (first or near_left_out(gap, other)) for own, gap in held[x] for also, other in held[y]):
                    out.add((min(x, y), max(x, y), None))
                    if not first:
                        old = class_[y]
                        class_.update((z, class_[x]) for z in held if class_[z] == old)

        for batch in batches:
            key, line = (batch.column(c).to_numpy() for c in ("key", "line"))
            own, key = key & 1 == 1, key & ANY
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, int)
            if not len(starts):
                continue
            ends = np.append(starts[1:], len(key))
            mixed = np.minimum.reduceat(line, starts) != np.maximum.reduceat(line, starts)
            # groups that may go on in a neighbouring batch count as mixed
            mixed[0] = mixed[-1] = True
            out: set[tuple] = set()
            for g in np.flatnonzero(mixed).tolist():
                k = int(key[starts[g]])
                if k != held_key:
                    close(out)
                    held_key, held, crowded = k, {}, False
                at = slice(starts[g], ends[g])
                for x, i, gap in zip(line[at].tolist(), own[at].tolist(), repeat(None) if first else batch.column("gap")[at].to_pylist()):
                    if crowded:
                        out.add((x, None, k if first else 0))
                    else:
                        held.setdefault(x, set()).add((i, gap))
                        if len(held) > MEET:
                            crowded = True
                            out.update((y, None, k if first else 0) for y in held)
                            held = {}
            if out:
                yield _meeting_batch(out)
        out = set()
        close(out)
        if out:
            yield _meeting_batch(out)

    return entries.repartition(F.col("key").bitwiseAND(ANY)).sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint, key bigint")


def _meeting_batch(rows: set[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["a", "b", "key"])


def _verify_pairs(edits: int, shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [within(a, b, allowed(min(len(a), len(b)), edits, shortest)) for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist())]
            if any(near):
                yield batch.select(["id_a", "id_b"]).filter(pa.array(near))

    return run


def _first_shared(keys: list, key: int, rows: int) -> np.ndarray:
    """Whether ``key``, which all lines have, is the smallest key that each of
    the first ``rows`` lines shares with each line: lines that meet under
    several keys are compared under one of them."""
    lower = [[k for k in own if k < key] for own in keys]
    number = {k: i for i, k in enumerate(sorted(set(chain.from_iterable(lower))))}
    has = np.zeros((len(keys), len(number)), np.float32)
    for i, own in enumerate(lower):
        has[i, [number[k] for k in own]] = 1
    return has[:rows] @ has.T == 0


def _verify_block(edits: int, shortest: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows[rows["block"] == rows["low"].iloc[0]]
        both = first if rows["low"].iloc[0] == rows["high"].iloc[0] else pd.concat([first, rows[rows["block"] == rows["high"].iloc[0]]])
        text, ids, class_ = both["text"].tolist(), both["id"].tolist(), np.arange(len(both))
        here = _first_shared(both["keys"].tolist(), both["key"].iloc[0], len(first))
        links = []
        for i in range(len(first)):
            start = i + 1 if len(both) == len(first) else len(first)
            # what is connected already needs no comparison
            for j in (np.flatnonzero((class_[start:] != class_[i]) & here[i, start:]) + start).tolist():
                if class_[i] != class_[j] and within(text[i], text[j], allowed(min(len(text[i]), len(text[j])), edits, shortest)):
                    class_[class_ == class_[j]] = class_[i]
                    links.append((ids[i], ids[j]))
        return pd.DataFrame(links, columns=["id_a", "id_b"])

    return run


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (from 0) and the line, of every line that is not blank."""
    cut = texts(docs).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return cut.where(F.trim("line") != "")


def _among(lines: DataFrame, hashes: DataFrame, rows: int, name: str) -> DataFrame:
    """The rows of ``lines`` whose hash is in ``hashes``, which has ``rows``
    rows; repeated ones are dropped only where they are too many to broadcast."""
    if rows > BROADCAST_LINES:
        hashes = stage(hashes.distinct(), name)
        rows = hashes.count()
    return lines.join(F.broadcast(hashes) if rows <= BROADCAST_LINES else hashes, "hash", "left_semi")


def near_links(docs: DataFrame, edits: int = MAX_EDITS, shortest: int = MIN_CHARS) -> DataFrame:
    """(id_a, id_b): links (MD5 of the lines) that connect all different lines
    within the :func:`allowed` edits of each other, directly or through
    others."""
    return _links(stage(lines_of(docs).select("line"), "lines", "zstd"), edits, shortest)


def _links(lines: DataFrame, edits: int, shortest: int) -> DataFrame:
    """The links of :func:`near_links` from the column ``line``, staged, of
    all lines."""
    ship_package(lines.sparkSession)
    lines = lines.where(F.char_length("line") > edits).select(F.xxhash64("line").alias("hash"), "line")
    met = stage(_meetings(_entries(lines, edits, shortest), True), "met")
    pairs = met.where("key is null").select("a", "b")
    crowds = met.where("key is not null").select("key", F.col("a").alias("hash"))
    left = crowds.select("hash")
    crowded = left.count()
    # a step takes its lines from those of the step before, read once from all
    dense = stage(_among(lines, left, crowded, "crowded").distinct(), "crowded_lines", "zstd") if crowded else None
    for parts in SEGMENTS:
        if crowded and comb(parts, edits) <= MASKS:
            met = stage(_meetings(_entries(dense, edits, shortest, parts), False), "met")
            pairs = pairs.unionByName(met.where("key is null").select("a", "b"))
            left = met.where("key is not null").select(F.col("a").alias("hash"))
            crowded = left.count()
            if crowded:
                dense = stage(_among(dense, left, crowded, "crowded"), "crowded_lines", "zstd")
    wanted = stage(pairs.select(F.explode(F.array("a", "b")).alias("hash")).distinct(), "wanted")
    found = stage(_among(lines, wanted, wanted.count(), "wanted").distinct(), "wanted_lines", "zstd").select("hash", F.md5("line").alias("id"), "line")
    pairs = pairs.repartition("a").distinct()  # one shuffle for the distinct pairs and their first join
    side_a = found.select(F.col("hash").alias("a"), F.col("id").alias("id_a"), F.col("line").alias("text_a"))
    side_b = found.select(F.col("hash").alias("b"), F.col("id").alias("id_b"), F.col("line").alias("text_b"))
    links = pairs.join(side_a, "a").join(side_b, "b").select("id_a", "id_b", "text_a", "text_b").mapInArrow(
        _verify_pairs(edits, shortest), "id_a string, id_b string")
    if not crowded:
        return links
    # pairs no step has formed have both ends in ``left`` and share a first key
    keys = _among(crowds, left, crowded, "crowded").groupBy("hash").agg(F.collect_set("key").alias("keys"))
    dense = stage(keys.join(dense, "hash").select("hash", "keys", F.md5("line").alias("id"), F.col("line").alias("text")), "dense", "zstd")
    sizes = dense.select(F.explode("keys").alias("key")).groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = dense.withColumn("key", F.explode("keys")).join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("hash"), F.col("blocks")).cast("int"))
    tiles = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "keys", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "id", "text")
    return links.unionByName(tiles.groupBy("key", "low", "high").applyInPandas(_verify_block(edits, shortest), "id_a string, id_b string"))


def line_classes(docs: DataFrame, edits: int = MAX_EDITS, shortest: int = MIN_CHARS) -> DataFrame:
    """One row per line that is not blank: doc_id, line_no, n_chars, copies
    (lines equal to it), class_doc and class_line (the first line of its
    class), class_size (lines in the class), n_links (different lines it is
    linked to directly) and kept (whether it is that first line).

    Null and empty texts have no lines. A null doc_id stands before all
    others; rows that repeat a doc_id are one document, so the line that
    stays does so in each of them. An empty table gives an empty result.
    """
    # ids are shuffled and written as bytes, half of what their digits take
    lines = stage(lines_of(docs).select("doc_id", "line_no", F.char_length("line").alias("n_chars"), F.unhex(F.md5("line")).alias("id"), "line"),
                  "lines", "zstd")
    occurrences = lines.drop("line")
    place = F.struct(order_key("doc_id").alias("key"), "line_no", "doc_id")
    distinct = occurrences.groupBy("id").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
    joined = connected_components(_links(lines, edits, shortest)).select(F.unhex("node").alias("id"), "component")
    distinct = stage(distinct.join(joined, "id", "left"), "distinct_lines", "zstd")
    linked = distinct.where("component is not null")
    whole = linked.groupBy("component").agg(F.min("first").alias("class_first"), F.sum("copies").alias("class_size"))
    classes = linked.join(whole, "component").select("id", "copies", "class_first", "class_size").unionByName(
        distinct.where("component is null").select("id", "copies", F.col("first").alias("class_first"), F.col("copies").alias("class_size")))
    same = F.col("doc_id").eqNullSafe(F.col("class_first.doc_id")) & (F.col("line_no") == F.col("class_first.line_no"))
    return occurrences.join(classes, "id").select(
        "doc_id", "line_no", "n_chars", "copies", F.col("class_first.doc_id").alias("class_doc"),
        F.col("class_first.line_no").alias("class_line"), "class_size", same.alias("kept"))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with only the lines (and blank lines) that stay, in order."""
    gone = line_classes(docs).where("not kept").select("doc_id", "line_no").distinct()
    gone = gone.groupBy("doc_id").agg(F.collect_set("line_no").alias("__gone"))
    kept = F.filter(F.split("text", "\n"), lambda line, i: ~F.coalesce(F.array_contains("__gone", i), F.lit(False)))
    # a document's dropped line numbers are bounded by its own lines
    return docs.join(gone, "doc_id", "left").withColumn(
        "text", F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))).select(docs.columns)
