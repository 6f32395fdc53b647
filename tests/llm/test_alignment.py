"""Cross-tokenizer alignment against a plain count of all links."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import alignment, bitmaps
from llm_data import SF


def brute(rows):
    """The contract, document by document, with the libraries themselves."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(c): c for c in plain}
    letters |= {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in plain)}
    done, links = [], Counter()
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        pieces = [b.id_to_piece(i) for i in ids_b]
        bytes_b = [bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode() for p in pieces]
        if not text or b"".join(bytes_a) != b" " + text.encode() or b"".join(bytes_b) != b" " + text.encode():
            done.append((doc_id, [], [], []))
            continue
        ends_a = dict(zip(np.cumsum([len(x) for x in bytes_a]).tolist(), range(len(ids_a))))
        ends_b = dict(zip(np.cumsum([len(x) for x in bytes_b]).tolist(), range(len(ids_b))))
        both, groups, i, j = sorted(ends_a.keys() & ends_b.keys()), [], 0, 0
        for end in both:
            groups.append((ids_a[i:ends_a[end] + 1], ids_b[j:ends_b[end] + 1]))
            i, j = ends_a[end] + 1, ends_b[end] + 1
        done.append((doc_id, ids_a, ids_b, groups))
        links.update((g[0][-1], g[1][-1]) for g in groups)
    most = Counter()
    for (_, y), n in links.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, ids_a, ids_b, groups in done:
        found = [(g[0][-1], g[1][-1]) for g in groups]
        text = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((doc_id, len(ids_a), len(ids_b), len(groups), len(found), sum(links[p] == most[p[1]] for p in found),
                    sum(links[p] for p in found), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    documents = Counter(p for *_, groups in done for p in {(g[0][-1], g[1][-1]) for g in groups})
    return out, {p: (documents[p], n, n == most[p[1]]) for p, n in links.items()}


@pytest.fixture(scope="module")
def docs(spark, odd):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(9001, "tab\ttab  two   blanks\n\n\nline"), (9002, "▁ is no blank"), (9003, "a<s>b</s><unk><0x41>"),
                                   (9004, " lead"), (9005, "ﬁ ＡＢ ñ ñ"), (9006, "the " * 3000)], "doc_id bigint, text string")
    return given.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(extra)


@pytest.mark.parametrize("flush", [alignment.FLUSH_LINKS, 50])
def test_alignment(docs, flush, monkeypatch):
    want, counts = brute([(r.doc_id, r.text) for r in docs.collect()])
    if flush == 50:  # dense bitmaps, blocks that end within a batch, and parts of them that meet again
        monkeypatch.setattr(alignment, "SPLIT", 2)
        docs = docs.repartition(3)
        docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = alignment.align_documents(docs, flush=flush).collect()
        assert Counter(map(tuple, got)) == Counter(want)
        pairs = {(r.a_id, r.b_id): (r.documents, r.links, r.best) for r in alignment.pair_counts(docs, flush=flush).collect()}
        assert pairs == counts
    finally:
        docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def test_empty(spark, none):
    assert alignment.align_documents(none).count() == 0
    blank = spark.createDataFrame([(1, None), (None, ""), (1, None)], "doc_id bigint, text string")
    assert sorted(map(tuple, alignment.align_documents(blank).collect()), key=str) == sorted(
        [(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")], key=str)


def test_bitmaps():
    r = random.Random(1)
    sets = [sorted(r.sample(range(bitmaps.PLACES), n)) for n in (0, 1, 5, bitmaps.DENSE - 1, bitmaps.DENSE, 30_000, 0, 65_536, 3)]
    packed = bitmaps.pack(np.array(list(map(len, sets))), np.array([p for s in sets for p in s]))
    assert bitmaps.popcounts(packed).tolist() == list(map(len, sets))
    assert max(len(b.as_py()) for b in packed) == 8192
    for column in (packed, pa.concat_arrays([packed, packed]).slice(2, 9)):
        want = (sets + sets)[2:11] if column is not packed else sets
        which, places = bitmaps.unpack(column)
        assert [sorted(places[which == i].tolist()) for i in range(len(want))] == want
        group = np.array([0, 1, 2, 0, 1, 2, 0, 1, 2])
        joined = bitmaps.union(column, group, 3)
        which, places = bitmaps.unpack(joined)
        for g in range(3):
            assert places[which == g].tolist() == sorted({p for i, s in enumerate(want) if group[i] == g for p in s})


def test_multiplicity_planes():
    r = np.random.default_rng(2)
    pairs, places = r.integers(0, 40, 20_000) * 7, r.integers(0, 30, 20_000) ** 2
    places[:6000], pairs[:6000] = 5, 14  # one pair 6000 times in one document
    keys, docs, planes = alignment.postings((pairs << 16) | places)
    want = Counter(zip(pairs.tolist(), places.tolist()))
    row, weight, flat = alignment._plane_weights(planes)
    got = Counter()
    which, place = bitmaps.unpack(docs)
    got.update(zip(keys[which].tolist(), place.tolist()))
    which, place = bitmaps.unpack(flat)
    for i, p in zip(which.tolist(), place.tolist()):
        got[int(keys[row[i]]), p] += int(weight[i])
    assert got == want
