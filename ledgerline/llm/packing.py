"""Best-fit packing by bin completion (Korf, 2002/2003).

Pieces of at most ``capacity`` tokens are put into as few sequences as
possible. A sequence is begun with the largest piece that is left; the
undominated fillings around it, of any number of pieces, are tried from the
fullest on, and branches whose waste already forbids beating the incumbent
are cut. The incumbent at the start is the best-fit-decreasing packing or, if
better, one of :func:`by_number`, which settles first how many pieces share a
sequence: where pieces are large, the fullest filling spends the small ones
on the largest and leaves pieces that waste more. The search is by limited discrepancy (Harvey and Ginsberg, 1995): first the
fullest filling everywhere, then all ways that leave it once, the earliest
sequences first, then twice, and so on. It ends with a packing that meets the
lower bound, when nothing is left to try, or after the nodes that ``DESCENTS``
and ``STEPS`` allow.

Pieces that fill a sequence alone are placed without search. The others are
dealt by hash into groups of about ``GROUP_PIECES``, each packed by one task;
a group of that size leaves about one sequence partly filled, so grouping
costs some 0.02 % of the sequences, whatever the size of the input.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bpe import encoder, vocabulary_path
from ledgerline.llm.common import ARROW_ROWS, ship_package, stage, texts

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 20_000
# Nodes of search: so many for each sequence, and so many besides.
DESCENTS = 3
STEPS = 2_000
# Shares of a sequence that by_number leaves free, tried in turn.
SLACKS = (0.0, 0.001, 0.003, 0.01)


def number_bound(ordered: np.ndarray, capacity: int) -> int:
    """Lower bound by the number of pieces in a sequence, for sizes from the
    smallest on. If q sequences hold j pieces or more, the j * q smallest
    pieces fit into q sequences; so at most Q(j) do, and a packing into B
    sequences places at most the sum of min(B, Q(j)) over j."""
    ends = np.concatenate([[0], np.cumsum(ordered)])
    most = []
    for j in range(1, len(ordered) + 1):
        q = np.arange(1, len(ordered) // j + 1)
        most.append(int((ends[j * q] <= q * capacity).sum()))
        if not most[-1]:
            break
    most_of = np.array(most)
    low, high = 0, len(ordered)
    while low < high:
        middle = (low + high) // 2
        if int(np.minimum(most_of, middle).sum()) >= len(ordered):
            high = middle
        else:
            low = middle + 1
    return low


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The largest of Martello and Toth's L2, the bounds by Fekete and
    Schepers' dual feasible functions u(k), and :func:`number_bound` of all
    pieces and of those over a third to an eighth of a sequence: no packing
    takes fewer sequences."""
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    total = count * np.arange(capacity + 1)
    n_above, sum_upto = np.cumsum(count[::-1])[::-1], np.cumsum(total)
    best = -(-int(total.sum()) // capacity)
    half = capacity // 2
    for k in range(0, half + 1):
        big = int(n_above[capacity - k + 1]) if k else 0
        middle = int(n_above[half + 1]) - big
        middle_sum = int(sum_upto[capacity - k] - sum_upto[half])
        small_sum = int(sum_upto[half] - (sum_upto[k - 1] if k else 0))
        best = max(best, big + middle + max(0, -(-(small_sum - (middle * capacity - middle_sum)) // capacity)))
    have = np.flatnonzero(count)
    for k in range(1, min(capacity, 100) + 1):
        # a size counts as floor((k + 1) size / capacity) / k of a sequence, or as itself where that needs no rounding
        parts, rest = np.divmod((k + 1) * have, capacity)
        scaled = np.where(rest == 0, have * k, parts * capacity)
        best = max(best, -(-int((scaled * count[have]).sum()) // (k * capacity)))
    ordered = np.sort(sizes)
    for least in (0, *(capacity // k + 1 for k in range(3, 9))):
        best = max(best, number_bound(ordered[np.searchsorted(ordered, least):], capacity))
    return best


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Each size, from the largest on, into the fullest sequence it fits."""
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]  # sequence numbers by room left
    rooms = np.zeros(capacity + 1, bool)
    packed: list[list[int]] = []
    for size in np.sort(sizes)[::-1].tolist():
        fits = int(rooms[size:].argmax()) + size
        if rooms[fits]:
            at = open_[fits].pop()
            rooms[fits] = bool(open_[fits])
        else:
            at, fits = len(packed), capacity
            packed.append([])
        packed[at].append(size)
        left = fits - size
        if left:
            open_[left].append(at)
            rooms[left] = True
    return packed


def _sums(count: np.ndarray, room: int, whole: bool) -> tuple[list[tuple[int, int]], list[int]]:
    """The subset-sum table of the pieces in ``count`` for ``room``: (size,
    how many) steps from the largest size on, a size's count cut into powers
    of two, and after each step the reachable sums as bits. Unless ``whole``,
    it ends as soon as ``room`` is reached."""
    mask = (1 << room + 1) - 1
    steps, reached, bits = [], [1], 1
    have = np.flatnonzero(count[:room + 1])[::-1]
    for size, n in zip(have.tolist(), count[have].tolist()):
        n, part = min(n, room // size), 1
        while n:
            take = min(part, n)
            bits |= bits << size * take & mask
            steps.append((size, take))
            reached.append(bits)
            n, part = n - take, part * 2
        if not whole and bits >> room & 1:
            break
    return steps, reached


def fullest(count: np.ndarray, room: int) -> tuple[int, ...]:
    """The fullest way to fill ``room`` from the sizes in ``count``, with any
    number of pieces; of equally full ones one of the larger pieces."""
    if count[room]:
        return (room,) if room else ()
    steps, reached = _sums(count, room, False)
    left, taken = reached[-1].bit_length() - 1, []
    for (size, n), before in zip(reversed(steps), reversed(reached[:-1])):
        if not before >> left & 1:
            taken += [size] * n
            left -= size * n
    return tuple(taken[::-1])


def by_number(sizes: np.ndarray, capacity: int, slack: float) -> list[list[int]]:
    """A packing that settles the number of pieces first. From the largest
    number m that a sequence may hold down to two, the smallest pieces left,
    as many as average ``(1 - slack) * capacity / m``, are those that share a
    sequence by m. From the largest pieces on, each such class is packed by
    :func:`fullest` fillings around its largest piece, which takes no pieces
    of a smaller class but goes on with what a larger one has left over."""
    ordered = np.sort(sizes)
    ends = np.concatenate([[0], np.cumsum(ordered)])
    cuts, at, m = [0], 0, capacity // int(ordered[0])
    while at < len(ordered) and m > 1:
        n = np.arange(1, len(ordered) - at + 1)
        fits = (ends[at + n] - ends[at]) * m <= n * (1 - slack) * capacity
        at += int(n[fits][-1]) if fits.any() else 0  # an average of the smallest pieces only grows
        cuts.append(at)
        m = min(m - 1, capacity // int(ordered[at])) if at < len(ordered) else 1
    cuts.append(len(ordered))
    count = np.zeros(capacity + 1, np.int64)
    packed: list[list[int]] = []
    for a, b in reversed(list(zip(cuts, cuts[1:]))):
        count += np.bincount(ordered[a:b], minlength=capacity + 1)
        left = int(count.sum())
        while left:
            largest = int(np.flatnonzero(count)[-1])
            count[largest] -= 1
            way = fullest(count, capacity - largest)
            left -= 1 + len(way)
            if not left and a:  # the class's last sequence may have room for smaller pieces
                count[largest] += 1
                break
            np.subtract.at(count, list(way), 1)
            packed.append([largest, *way])
    return packed


def dominated(count: np.ndarray, room: int, way: tuple[int, ...]) -> bool:
    """Whether pieces of ``way`` could be changed for one larger piece that is
    left, or two or more of them for one piece as large as they together."""
    slack = room - sum(way)
    one, more = 0, 0  # sums of one piece, of two or more
    for size in way:
        more |= more << size | one << size
        one |= 1 << size
    left = count[:room + 1].copy()
    np.subtract.at(left, list(way), 1)
    for size in np.flatnonzero(left > 0).tolist():
        if size <= slack or more >> max(0, size - slack) & (1 << min(slack, size) + 1) - 1 or (
                slack and one >> size - slack & (1 << slack) - 1):
            return True
    return False


def fillings(count: np.ndarray, room: int) -> Iterator[tuple[int, ...] | None]:
    """All undominated ways to fill ``room`` from the sizes in ``count``, of
    any number of pieces: :func:`fullest` first, the others from the fullest
    on. They are made one by one, as the search asks for them; None stands for
    a dominated one, so that the search can count what it looked at."""
    first = fullest(count, room)
    yield first
    if len(first) <= 1 and sum(first) == room:
        return  # one piece that fills the room dominates all else
    count = count.copy()  # the caller's changes meanwhile
    have = np.flatnonzero(count[:room + 1]).tolist()
    most = [min(int(count[size]), room // size) for size in have]
    below = [1]  # sums of the sizes before each place
    for size, n in zip(have, most):
        bits, part = below[-1], 1
        while n:
            take = min(part, n)
            bits |= bits << size * take & (1 << room + 1) - 1
            n, part = n - take, part * 2
        below.append(bits)
    seen = tuple(sorted(first))
    for total in range(sum(first), -1, -1):
        if not below[-1] >> total & 1:
            continue
        # (place, sum still to make, pieces so far), larger pieces first; no way is without an end
        open_ = [(len(have), total, ())]
        while open_:
            at, left, way = open_.pop()
            if not left:
                if tuple(sorted(way)) != seen:
                    yield None if dominated(count, room, way) else way
                continue
            size = have[at - 1]
            for n in range(min(most[at - 1], left // size) + 1):
                if below[at - 1] >> left - n * size & 1:
                    open_.append((at - 1, left - n * size, way + (size,) * n))


def bin_completion(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Sequences (lists of sizes) that hold all ``sizes``, 1 to ``capacity``."""
    best = best_fit_decreasing(sizes, capacity)
    bound = lower_bound(sizes, capacity)
    for slack in SLACKS:
        if len(best) <= bound:
            break
        best = min(best, by_number(sizes, capacity, slack), key=len)
    total = int(sizes.sum())
    steps = DESCENTS * len(best) + STEPS
    limit = 0  # of discrepancies on a path
    while len(best) > bound and steps > 0:
        count = np.bincount(sizes, minlength=capacity + 1)
        chosen: list[list[int]] = []
        # for each sequence begun: its largest piece, the fullest way (tried last), the others, discrepancies left
        branches: list[tuple[int, tuple[int, ...] | None, Iterator[tuple[int, ...] | None], int]] = []
        waste, left, spare, cut = 0, len(sizes), limit, False
        while steps > 0:
            steps -= 1
            # beating the incumbent allows this much waste in all
            if left and waste <= (len(best) - 1) * capacity - total:
                largest = int(np.flatnonzero(count)[-1])
                count[largest] -= 1
                ways = fillings(count, capacity - largest)
                way = next(ways)
                count[largest] += 1
                branches.append((largest, way, ways, spare))
            elif not left and len(chosen) < len(best):
                best = [list(c) for c in chosen]
                if len(best) <= bound:
                    break
            while branches:  # on with the last sequence that has a way left
                largest, first, ways, spare = branches[-1]
                if len(chosen) == len(branches):
                    taken = chosen.pop()
                    np.add.at(count, taken, 1)
                    waste, left = waste - (capacity - sum(taken)), left + len(taken)
                way = None
                if first is not None and spare:
                    count[largest] -= 1
                    for way in ways:
                        steps -= 1
                        if way is not None or steps <= 0:
                            break
                    count[largest] += 1
                if way is not None:
                    spare -= 1
                    break
                if first is not None:
                    cut = cut or not spare
                    way = first
                    branches[-1] = (largest, None, ways, spare)
                    break
                branches.pop()
            if not branches:
                break
            taken = [largest, *way]
            np.subtract.at(count, taken, 1)
            chosen.append(taken)
            waste, left = waste + capacity - sum(taken), left - len(taken)
        if not cut:
            break  # every way was tried
        limit += 1
    return best


def _pieces(docs: DataFrame, capacity: int, path: str | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path or vocabulary_path())
        waiting: deque[int | None] = deque()

        def given() -> Iterator[str]:  # batches go on into each other, so that the encoder fills its own
            for batch in batches:
                waiting.extend(batch.column("doc_id").to_pylist())
                yield from (t.as_py() for t in batch.column("text"))

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

        rows = []
        for ids in bpe.encode_many(given()):
            doc_id = waiting.popleft()
            raw = memoryview(np.append(ids, np.uint32(END_ID)).astype("<u4").tobytes())
            n = len(raw) // 4
            cuts = [0, *range(n % capacity or capacity, n, capacity), n]
            rows += [(doc_id, i, a, b - a, zlib.crc32(raw[4 * a:4 * b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            if len(rows) >= ARROW_ROWS:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    return texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def _pack_group(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "row"], ascending=[False, True, True], ignore_index=True)
        sizes = rows["length"].to_numpy()
        stacks = {int(s): g[::-1].tolist() for s, g in rows.groupby("length").indices.items()}
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for number, taken in enumerate(bin_completion(sizes, capacity)):
            at = 0
            for size in taken:
                i = stacks[size].pop()
                sequence[i], offset[i] = number, at
                at += size
        return rows.assign(sequence_id=((rows["group"].to_numpy() << 32) + sequence) * 2, offset=offset)

    return pack


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    A document is its ids and then the end id, so an empty or null text is
    one token. Only documents over ``capacity`` are cut; their first piece
    may be shorter. Every row of the input is packed, repeated ones too; an
    empty table gives an empty result. Sequence numbers are unique, not
    gapless.
    """
    spark = docs.sparkSession
    ship_package(spark)
    pieces = stage(_pieces(docs, capacity, path).withColumn("row", F.monotonically_increasing_id()), "pieces")
    part = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-part.count() // GROUP_PIECES))
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, row bigint, group bigint, sequence_id bigint, offset bigint"
    packed = (part.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("bigint"))
              .groupBy("group").applyInPandas(_pack_group(capacity), schema))
    whole = pieces.where(F.col("length") >= capacity).withColumn("sequence_id", F.col("row") * 2 + 1).withColumn(
        "offset", F.lit(0).cast("bigint"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return packed.select(columns).unionByName(whole.select(columns))
