"""BPE encoding by forced-boundary splitting, and decoding.

A byte pair that occurs inside no vocabulary token can never be merged, so
every place where it stands is a certain cut between tokens. Texts are cut
at such places, each fragment is encoded on its own (and remembered), and
the ids are concatenated.

A cut must also leave the pre-tokenizer's pattern undisturbed on both sides:

* it lies between characters, not inside one;
* its left character is not white space, since the pattern treats white
  space by what follows it;
* its right character is not an apostrophe, which could begin a contraction
  that the whole text does not have there;
* special tokens are set apart first, as the tokenizer does.

The left part of a run of letters, digits or marks is then matched as the
run itself would be, and the right part starts a match of the same class, so
the fragments' ids are the whole text's ids.

Equal fragments of a batch are encoded once. Memory is bounded by
``BATCH_BYTES`` of text (or one longer text), its ids and two caches of at
most ``CACHE_ENTRIES`` fragments.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ship_package, texts

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_ENTRIES = 450_000
BATCH_BYTES = 9_000_000

def byte_alphabet() -> dict[str, int]:
    """The printable characters that byte-level vocabularies write bytes as:
    printable Latin-1 stands for itself, other bytes follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Ids(NamedTuple):
    """The ids of many parts in one array, and where each part's begin and how
    many they are."""

    pool: np.ndarray
    at: np.ndarray
    count: np.ndarray

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the parts ``which``, one after the other, and their ends."""
        count = self.count[which]
        end = np.cumsum(count)
        return self.pool[np.repeat(self.at[which] - (end - count), count) + np.arange(end[-1] if len(end) else 0)], end

    def then(self, more: Ids) -> Ids:
        """These parts and then ``more``."""
        return Ids(np.concatenate([self.pool, more.pool]), np.concatenate([self.at, more.at + len(self.pool)]),
                   np.concatenate([self.count, more.count]))


NO_PARTS, NO_IDS = pa.array([], pa.large_binary()), Ids(np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64))


def _joined(parts: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ``parts`` and where each begins, the end last."""
    _, offsets, data = parts.buffers()
    starts = np.frombuffer(offsets, np.int64)[parts.offset:parts.offset + len(parts) + 1]
    return np.frombuffer(data, np.uint8)[starts[0]:starts[-1]], starts - starts[0]


class Remembered:
    """The ids of short parts in two generations of ``most`` / 2 entries each:
    a part that is met again moves to the young one, the old one is dropped
    when the young one is full, so what occurs once does not push out what
    occurs often. Parts and ids are held in arrays and looked up by Arrow for
    a whole batch, without an object for each."""

    def __init__(self, most: int):
        self.most = most
        self.young, self.young_ids = NO_PARTS, NO_IDS
        self.old, self.old_ids = NO_PARTS, NO_IDS

    def ids(self, parts: pa.LargeBinaryArray, ids_of) -> Ids:
        """The ids of ``parts``, all different; ``ids_of`` gives those not
        remembered, and their ends."""
        found = pc.index_in(parts, value_set=pa.concat_arrays([self.young, self.old])).fill_null(-1).to_numpy()
        unknown = found < 0
        ids, ends = ids_of(parts.filter(pa.array(unknown))) if unknown.any() else (NO_IDS.pool, NO_IDS.at)
        count = np.diff(ends, prepend=0)
        known = self.young_ids.then(self.old_ids).then(Ids(ids, ends - count, count))
        which = found.astype(np.int64)
        which[unknown] = len(self.young) + len(self.old) + np.arange(len(ends))
        new = np.flatnonzero((which >= len(self.young)) & (pc.binary_length(parts).to_numpy() <= 64))
        if len(new):
            kept, kept_ends = known.of(which[new])
            if len(self.young) + len(new) > self.most // 2:
                self.old, self.old_ids = self.young, self.young_ids
                self.young, self.young_ids = NO_PARTS, NO_IDS
            count = np.diff(kept_ends, prepend=0)
            self.young = pa.concat_arrays([self.young, parts.take(pa.array(new))])
            self.young_ids = self.young_ids.then(Ids(kept, kept_ends - count, count))
        return Ids(known.pool, known.at[which], known.count[which])


class ForcedBoundaryEncoder:
    """Encodes as the tokenizers library does with the file at ``path``
    (``add_special_tokens=False``, no truncation or padding)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        alphabet = byte_alphabet()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_bytes: dict[int, bytes] = {
            i: bytes(alphabet[c] for c in token) for token, i in spec["model"]["vocab"].items() if token not in special}
        joined = np.zeros(65536, bool)
        for token in self.token_bytes.values():
            a = np.frombuffer(token, np.uint8).astype(np.int32)
            joined[a[:-1] * 256 + a[1:]] = True
        left, right = np.divmod(np.arange(65536), 256)
        self.cut_pairs: np.ndarray = ~joined & (left > 32) & ((right & 0xC0) != 0x80) & (right != 0x27)
        self.token_bytes |= {i: content.encode() for content, i in special.items()}
        self._special = special
        self._split_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self._words, self._fragments = Remembered(CACHE_ENTRIES), Remembered(CACHE_ENTRIES)

    def certain_cuts(self, blob: np.ndarray, before: bytes = b"") -> np.ndarray:
        """Positions of certain cuts in the bytes of one or more texts; with
        ``before``, only those that stand before one of these bytes."""
        if before:
            wanted = np.zeros(256, bool)
            wanted[list(before)] = True
            at = np.flatnonzero(wanted[blob])
            at = at[at > 0]
            at = at[self.cut_pairs[(blob[at - 1].astype(np.int32) << 8) | blob[at]]]
        else:
            at = np.flatnonzero(self.cut_pairs[(blob[:-1].astype(np.int32) << 8) | blob[1:]]) + 1
        wide = at[(blob[at - 1] >= 0x80) & (at > 1)]
        p1, p2, p3 = blob[wide - 1], blob[wide - 2], blob[np.maximum(wide - 3, 0)]
        spaces = ((p2 == 0xC2) & ((p1 == 0x85) | (p1 == 0xA0))) | ((p3 == 0xE1) & (p2 == 0x9A) & (p1 == 0x80)) | (
            (p3 == 0xE2) & (p2 == 0x80) & ((p1 <= 0x8A) | (p1 == 0xA8) | (p1 == 0xA9) | (p1 == 0xAF))) | (
            (p3 == 0xE2) & (p2 == 0x81) & (p1 == 0x9F)) | ((p3 == 0xE3) & (p2 == 0x80) & (p1 == 0x80))
        return np.setdiff1d(at, wide[spaces], assume_unique=True) if spaces.any() else at

    @staticmethod
    def _concatenated(starts: np.ndarray, blob: np.ndarray, cuts: np.ndarray, ids_of) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in ``blob`` and where each text's begin, the
        end last. ``ids_of`` gives the :class:`Ids` of distinct fragments."""
        marks = np.zeros(len(blob) + 1, bool)
        marks[starts] = True
        marks[cuts] = True
        cuts = np.flatnonzero(marks)
        fragments = pa.Array.from_buffers(
            pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(blob)]).dictionary_encode()
        ids, end = ids_of(fragments.dictionary).of(fragments.indices.to_numpy())
        ends = np.zeros(len(cuts), np.int64)
        ends[1:] = end
        return ids, ends[np.searchsorted(cuts, starts)]

    def _fragment_ids(self, parts: pa.LargeBinaryArray) -> Ids:
        def encode(lacking: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(lacking.cast(pa.large_string()).to_pylist(), add_special_tokens=False)]
            return np.fromiter(itertools.chain.from_iterable(found), "<u4"), np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))

        return self._fragments.ids(parts, encode)

    def _word_ids(self, parts: pa.LargeBinaryArray) -> Ids:
        """The ids of what stands between blanks: cut at every other certain
        place too."""

        def encode(lacking: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
            blob, starts = _joined(lacking)
            ids, ends = self._concatenated(starts, blob, self.certain_cuts(blob), self._fragment_ids)
            return ids, ends[1:]

        return self._words.ids(parts, encode)

    def _encode_together(self, parts: list[bytes]) -> list[np.ndarray]:
        """The ids of texts without special tokens."""
        blob = np.frombuffer(b"".join(parts), np.uint8)
        ids, ends = self._concatenated(np.cumsum([0, *map(len, parts)]), blob, self.certain_cuts(blob, b" \n"), self._word_ids)
        return [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def encode_many(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids (unsigned 32-bit) of each text, in order. Texts are taken
        together up to ``BATCH_BYTES``; a longer one is taken by itself."""
        held: list[list[bytes | int]] = []
        size = 0

        def flush() -> Iterator[np.ndarray]:
            plain = [p for parts in held for p in parts if isinstance(p, bytes) and p]
            done = iter(self._encode_together(plain)) if plain else iter(())
            for parts in held:
                ids = [np.array([p], "<u4") if isinstance(p, int) else next(done) for p in parts if p != b""]
                yield ids[0] if len(ids) == 1 else np.concatenate([np.empty(0, "<u4"), *ids])

        for text in texts:
            if self._split_special is not None and any(s in text for s in self._special):
                held.append([self._special[p] if p in self._special else p.encode() for p in self._split_special.split(text)])
            else:
                held.append([text.encode()])
            size += sum(len(p) for p in held[-1] if isinstance(p, bytes))
            if size >= BATCH_BYTES:
                yield from flush()
                held, size = [], 0
        yield from flush()

    def encode(self, text: str) -> list[int]:
        return next(self.encode_many([text])).tolist()

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        table = self.token_bytes
        return b"".join([table[i] for i in ids])

    def decode(self, ids: Iterable[int]) -> str:
        """As the library's decode with ``skip_special_tokens=False``."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


_encoders: dict[str, ForcedBoundaryEncoder] = {}


def encoder(path: str) -> ForcedBoundaryEncoder:
    """The encoder of a vocabulary file, made once per Python worker."""
    if path not in _encoders:
        _encoders[path] = ForcedBoundaryEncoder(path)
    return _encoders[path]


def vocabulary_path() -> str:
    """Where this machine keeps the default vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 for every row. A null text is the empty text: no ids, and
    the digests of the empty string. Repeated rows give repeated results; an
    empty table gives an empty one.

    ``path`` names a vocabulary file that every executor has (default: each
    executor's own copy of the public one).
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path or vocabulary_path())
        for batch in batches:
            rows = []
            for found in bpe.encode_many(t.as_py() for t in batch.column("text")):
                ids = found.tolist()
                rows.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                             hashlib.sha256(bpe.decode(ids).encode()).hexdigest()))
            n, encoded, decoded = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def token_ids(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the ids of every whole text as an array."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path or vocabulary_path())
        for batch in batches:
            ids = [found.astype(np.int32) for found in bpe.encode_many(t.as_py() for t in batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, ids array<int>")
