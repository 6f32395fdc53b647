"""Merkle manifest against trees built level by level in plain Python."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from ledgerline.llm import merkle


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def around(levels, at):
    out = []
    for level in levels[:-1]:
        start = at // 3 * 3
        out.append((level[start:at], level[at + 1:start + 3]))
        at //= 3
    return out


def brute(rows):
    def leaf(r):
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    sources = defaultdict(list)
    for r in rows:
        sources[r[1]].append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in sources[s]])
    top = tree([trees[s][-1][0] for s in names])
    out = Counter()
    for k, s in enumerate(names):
        for i, r in enumerate(sources[s]):
            path = around(trees[s], i) + around(top, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            now = leaf((*r[:4], r[4].replace("\n", ""))) if hit else leaf(r)
            for left, right in path:
                now = H("".join([*left, now, *right]))
            root = top[-1][0]
            out[r[0], leaf(r), trees[s][-1][0], root, H("".join(d for pair in path for side in pair for d in side)), now, now == root] += 1
    return out


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, subroot int, tree string, pos string"


def rows_of(n, names, seed=3):
    r = random.Random(seed)
    texts = ["", None, "a\nb", "one\n\ntwo\n", "plain", "é\n漢"]
    return [(r.choice([i, i, i, None, 7]), r.choice(names), r.choice([None, "en", ""]), r.choice([None, i]), r.choice(texts)) for i in range(n)]


@pytest.mark.parametrize("n, names", [
    (1, ["a"]), (1, [None]), (5, [None, "a", "b", "é", "Z"]), (244, ["a"]), (243, ["x"]), (2000, ["hot"] * 6 + [None, "b", "", "ü", "z"]),
    (900, [f"s{i}" for i in range(400)])])
def test_trees(spark, n, names):
    rows = rows_of(n, names) + rows_of(n // 9, names)  # some rows twice
    df = spark.createDataFrame([(*r, "x", 1, "t", "p") for r in rows], SCHEMA)
    assert Counter(map(tuple, merkle.verify_documents(df).collect())) == brute(rows)


def test_small_superblocks(monkeypatch):
    # many rounds: three nodes to a superblock
    monkeypatch.setattr(merkle, "LEVELS", 1)
    levels = [[H(str(i)) for i in range(40)]]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([merkle.reduce_block(below[i:i + 3], i > 0 or len(below) > 3)[-1][0] for i in range(0, len(below), 3)])
    assert levels == tree(levels[0])


def test_manifest_and_empty(spark, none):
    assert merkle.verify_documents(none).count() == 0 and merkle.manifest(none).count() == 0
    rows = rows_of(60, ["a", None, "c"])
    df = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")
    want = brute(rows)
    got = merkle.manifest(df).collect()
    assert Counter({r.source: r.n_rows for r in got}) == Counter(r[1] for r in rows)
    assert {r.subroot for r in got} == {k[2] for k in want} and {r.root for r in got} == {k[3] for k in want}


def test_odd_rows(odd):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in odd.collect()]
    assert Counter(map(tuple, merkle.verify_documents(odd).collect())) == brute(rows)
