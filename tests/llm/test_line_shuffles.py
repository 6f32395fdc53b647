"""Line dedup: what is shuffled and written of the lines, and copies that lie in several tasks."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pandas as pd
import pytest

from ledgerline.llm import line_dedup


def test_texts_of_all_lines_are_not_shuffled(spark, monkeypatch):
    staged, stage = [], line_dedup.stage
    monkeypatch.setattr(line_dedup, "stage", lambda df, name, *codec: staged.append((name, df)) or stage(df, name, *codec))
    df = spark.createDataFrame([(i, f"a line of its own {i * 7919}\na line they share") for i in range(40)], "doc_id bigint, text string")
    assert line_dedup.line_classes(df).count() == 80
    frames = {name: df for name, df in staged if name not in ("wanted", "wanted_lines")}
    plans = {name: df._jdf.queryExecution().optimizedPlan().toString() for name, df in frames.items()}
    for name in ("lines", "met"):
        assert "Aggregate" not in plans[name] and "Join" not in plans[name], plans[name]
    # between tasks go keys, hashes and digests as bytes
    assert plans["met"].count("RepartitionByExpression") == 1
    exchanged = plans["met"].split("RepartitionByExpression")[1].split("\n")[1]
    assert "MapInArrow" in exchanged and dict(frames["lines"].dtypes)["id"] == dict(frames["distinct_lines"].dtypes)["id"] == "binary"


@pytest.mark.parametrize("seen, meet", [(0, 32), (500_000, 32), (3, 3)])
def test_copies_in_many_tasks(spark, monkeypatch, seen, meet):
    monkeypatch.setattr(line_dedup, "SEEN", seen)
    monkeypatch.setattr(line_dedup, "MEET", meet)
    monkeypatch.setattr(line_dedup, "BLOCK", 4)
    r = random.Random(5)
    words = [["".join(r.choice("abcdefgh") for _ in range(24)) for _ in range(12)] for _ in range(2)]
    lines = [w for w in words[0]] + [w[:9] + "Z" + w[10:] for w in words[0]] + words[1]
    rows = [(i, "\n".join(r.sample(lines, 9))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(12)
    first, size = {}, {}
    class_of = {x: min(i % 12 if i < 24 else i for i, y in enumerate(lines) if y == x) for x in lines}
    for i, text in rows:
        for n, line in enumerate(text.split("\n")):
            first.setdefault(class_of[line], (i, n))
            size[class_of[line]] = size.get(class_of[line], 0) + 1
    count = {line: sum(text.split("\n").count(line) for _, text in rows) for line in lines}
    by_place = {(i, n): line for i, text in rows for n, line in enumerate(text.split("\n"))}
    got = line_dedup.line_classes(df).collect()
    assert len(got) == len(by_place) == len({(g.doc_id, g.line_no) for g in got})
    for g in got:
        line = by_place[g.doc_id, g.line_no]
        at = class_of[line]
        assert (g.class_doc, g.class_line, g.class_size, g.copies) == (*first[at], size[at], count[line])
        assert g.kept == ((g.doc_id, g.line_no) == first[at])


def test_lines_that_share_crowded_keys_are_compared_once(monkeypatch):
    compared, within = [], line_dedup.within
    monkeypatch.setattr(line_dedup, "within", lambda a, b, k: compared.append((min(a, b), max(a, b))) or within(a, b, k))
    r = random.Random(6)
    lines = [f"the same start {r.getrandbits(64):016x} and the same end" for _ in range(40)]
    lines += [line[:20] + "Z" + line[21:] for line in lines[:5]]
    keys = {line: sorted(r.sample((-9, -4, 3, 8, 12), r.choice((2, 3, 4)))) for line in lines}
    block = {line: r.randrange(2) for line in lines}
    links = set()
    for key in (-9, -4, 3, 8, 12):
        for low, high in ((0, 0), (0, 1), (1, 1)):
            own = [line for line in lines if key in keys[line] and block[line] in (low, high)]
            rows = pd.DataFrame([(key, low, high, block[line], line, line, keys[line]) for line in own],
                                columns=["key", "low", "high", "block", "id", "text", "keys"])
            if len(own):
                links |= {(min(x), max(x)) for x in line_dedup._verify_block(2, 10)(rows).itertuples(index=False, name=None)}
    meeting = {(min(x), max(x)) for x in combinations(lines, 2) if set(keys[x[0]]) & set(keys[x[1]])}
    assert Counter(compared) == Counter(meeting)
    assert links == {x for x in meeting if within(*x, 2)} and links


def test_crowded_lines_are_read_from_all_lines_once(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 16)
    staged, stage = [], line_dedup.stage
    monkeypatch.setattr(line_dedup, "stage", lambda df, name, *codec: staged.append((name, df)) or stage(df, name, *codec))
    lines = [f"{n} was the number of the order that we have shipped" for n in range(200, 300)] + ["a line that is near none of the others"]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id bigint, text string")
    got = Counter((r.class_doc, r.class_size) for r in line_dedup.line_classes(df).collect())
    assert got == {(0, 100): 100, (100, 1): 1}
    assert [name for name, _ in staged] == [
        "lines", "met", "crowded_lines", "met", "crowded_lines", "met", "crowded_lines", "wanted", "wanted_lines", "dense", "distinct_lines"]
    shuffled = ["Aggregate" in df._jdf.queryExecution().optimizedPlan().toString() for name, df in staged if name == "crowded_lines"]
    assert shuffled == [True, False, False]
