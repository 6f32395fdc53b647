"""Small cases of jobs that were once done in part only."""

import random
from collections import Counter
from itertools import chain

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import exact_dedup, line_dedup, packing, secret_scan, simhash


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_exact_copies_without_ids(spark, monkeypatch, bound):
    monkeypatch.setattr(exact_dedup, "BROADCAST_PAIRS", bound)
    # a group with real ids whose longest rows have none, one without any, null texts, and a group that ids decide
    rows = [(None, "a  b c"), (None, "a  b c"), (1, "a b c"), (2, "abc"), (None, "x y"), (None, "x y"), (None, "x y"),
            (None, None), (None, ""), (3, "one"), (3, "one"), (None, "one"), (4, "lone"), (None, "single")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, (r.text or "").replace(" ", ""), len(r.text or "")) for r in exact_dedup.drop_exact_copies(docs).collect()]
    assert sorted(got, key=str) == sorted([(None, "abc", 6), (None, "xy", 3), (None, "", 0), (3, "one", 3), (4, "lone", 4), (None, "single", 6)], key=str)


def test_exact_ids_and_names_at_the_edges(spark):
    rows = [(-2 ** 63, "a b", 1, 2), (2 ** 63 - 1, "ab ", 3, 4), (None, "ab", 5, 6), (-1, " ", 7, 8), (0, None, 9, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, __row int, row int")
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs).collect()}
    low, high = -2 ** 63, 2 ** 63 - 1
    assert got == {(low, low, 3, True), (high, low, 3, False), (None, low, 3, False), (-1, -1, 2, True), (0, -1, 2, False)}
    assert sorted(map(tuple, exact_dedup.drop_exact_copies(docs).collect())) == [rows[0], rows[3]]


def distance(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


@pytest.mark.parametrize("meet", [32, 3])
def test_short_near_lines(spark, monkeypatch, meet):
    monkeypatch.setattr(line_dedup, "MEET", meet)
    monkeypatch.setattr(line_dedup, "BLOCK", 4 if meet == 3 else 256)
    r = random.Random(11)
    lines = ["Thwhesnd esator whshing and hewh.", "Thwhesnd, esator whshing and hewh.", "Are, is anwh reenen.", "Are. Is anwh reenen.",
             "ab", "ac", "é", "e"]
    for n in (3, 4, 6, 8, 9, 10, 11, 12, 20, 38, 41):
        for _ in range(4):
            line = "".join(r.choice("abcdefghijklmnoé") for _ in range(n))
            lines.append(line)
            for _ in range(4):
                near = list(line)
                for _ in range(r.randint(1, 3)):
                    at = r.randint(0, len(near))
                    near[at:at + r.randint(0, 1)] = r.choice(["", "q", "é"])
                lines.append("".join(near) or "x")
    # brute force, the rule written out: two edits from 10 code points on, one from 3 on, none below
    most = lambda n: 2 if n >= 10 else 1 if n >= 3 else 0
    part = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            if part[i] != part[j] and distance(lines[i], lines[j]) <= most(min(len(lines[i]), len(lines[j]))):
                low, high = sorted((part[i], part[j]))
                part = [low if p == high else p for p in part]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id bigint, text string")
    got = {r.doc_id: (r.class_doc, r.class_size, r.kept) for r in line_dedup.line_classes(df).collect()}
    assert got == {i: (p, part.count(p), p == i) for i, p in enumerate(part)}
    assert got[1][0] == 0 and got[3][0] == 2 and got[5][0] == 5


def test_lines_within_the_edits_share_a_remainder():
    r = random.Random(3)
    looks = lambda line, parts: [
        ((probe[0], tuple(line[a:b] for a, b in probe[1])), line_dedup.left_out(line, probe, 2, 10))
        for probe in line_dedup.remainders(len(line), 2, 10, parts)[0]]
    met = 0
    for _ in range(3_000):
        n, parts = r.choice([3, 5, 9, 10, 12, 17, 40, 63]), r.choice([2, 3, 8, 16])
        a = "".join(r.choice("abc") for _ in range(n))
        near = list(a)
        for _ in range(r.randint(1, 2)):
            at = r.randint(0, len(near))
            near[at:at + r.randint(0, 1)] = r.choice(["", "a", "b"])
        short, long = sorted(("".join(near), a), key=len)
        most = 2 if len(short) >= 10 else 1
        if len(short) > 2:
            own = dict(looks(short, parts)[:line_dedup.remainders(len(short), 2, 10, parts)[1]])
            seen = any(key in own and line_dedup.near_left_out(own[key], gap) for key, gap in looks(long, parts))
            assert seen == (distance(short, long) <= most), (short, long, parts)
            met += seen
    assert met > 2_000


def test_lines_of_one_template(spark):
    """Lines that share most of their text, a few of them near each other."""
    r = random.Random(4)
    text = "Order {} was shipped to the registered address".format
    codes = ["%016x" % r.getrandbits(64) for _ in range(1_500)]
    lines = [text(c) for c in codes] + [text(c[:5] + "x" + c[6:]) for c in codes[:10]] + [text(c[1:]) for c in codes[10:15]]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id bigint, text string")
    got = {r.doc_id: (r.class_doc, r.class_size) for r in line_dedup.line_classes(df).collect()}
    assert got == {i: (i - 1_500 if i >= 1_500 else i, 2 if i < 15 or i >= 1_500 else 1) for i in range(len(lines))}


def test_lines_crowded_at_every_cut(spark, monkeypatch):
    """A dense family: every line is near many others, in several blocks."""
    monkeypatch.setattr(line_dedup, "BLOCK", 16)
    lines = ["%s was the number of the order that we have shipped" % n for n in range(200, 400)]
    lines += ["%s is not the number of any order that we have sent" % c for c in "abcdefg"] + ["one line that is near none of the others"]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id bigint, text string")
    got = Counter((r.class_doc, r.class_size) for r in line_dedup.line_classes(df).collect())
    assert got == {(0, 200): 200, (200, 7): 7, (207, 1): 1}


def guesses(text, words=secret_scan.FIXED):
    return [text[a:b] for kind, a, b in secret_scan.find_spans(text, words) if kind == "guess"]


def test_secrets_of_one_class():
    assert guesses("passphrase: QwZxKvBnMpLtRsYdHj") == ["QwZxKvBnMpLtRsYdHj"]
    assert guesses("pwd = 839201746528301946") == ["839201746528301946"]
    assert guesses("PWD=KQZXWVJHGTRBNM") == ["KQZXWVJHGTRBNM"]
    for name in ("SECRET_KEY", "signing_key", "encryptionKey", "my.session-token", "DB_PASS", "aws_secret_access_key"):
        assert guesses(f"{name} = 'hfKqzRwvTjbXmPnd'") == ["hfKqzRwvTjbXmPnd"]
    for value in ("password", "qwertyuiop", "aaaaaaaaaaaaaaaa", "abcdefghijklmnop", "12345678", "2024-01-31", "your-token-here"):
        assert guesses(f"secret: {value}") == []
    assert guesses("key: " + "İ" * 3 + "qwertyİ") is not None  # lower case is longer than the value


def test_corpus_words_are_cheap(spark):
    prose = "Unverständlichkeiten beim Quartalsabschluss"
    rows = [(i, f"{prose} {i}") for i in range(3)] + [(None, None), (4, "pwd: Unverständlichkeiten\npassphrase: QwZxKvBnMpLtRsYdHj")]
    rows += [(i, "passphrase: QwZxKvBnMpLtRsYdHj") for i in (5, 6, 7)]  # copies of a secret do not make it a word
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    words = secret_scan.corpus_words(docs)
    assert {"unverständlichkeiten", "beim", "quartalsabschluss"} <= set(words.rank) and "qwzxkvbnmpltrsydhj" not in words.rank
    got = {r.doc_id: r.n_guess for r in secret_scan.scan_documents(docs).collect() if r.doc_id is not None}
    assert got == {0: 0, 1: 0, 2: 0, 4: 1, 5: 1, 6: 1, 7: 1}
    texts = {r.doc_id: r.text for r in secret_scan.redact_documents(docs).collect()}
    assert texts[4] == "pwd: Unverständlichkeiten\npassphrase: [SECRET]" and texts[None] is None


def fewest(sizes, capacity):
    """The fewest sequences, by trying every sequence for every piece."""
    best = len(sizes)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for room in {r for r in rooms if r >= sizes[i]}:
            rest = list(rooms)
            rest.remove(room)
            put(i + 1, [*rest, room - sizes[i]])
        put(i + 1, [*rooms, capacity - sizes[i]])

    put(0, [])
    return best


def test_packing_of_many_pieces_a_sequence():
    # six pieces fill a sequence; best fit decreasing takes 3416
    sizes = np.random.default_rng(0).integers(330, 346, 20_000)
    packed = packing.bin_completion(sizes, 2048)
    assert sorted(sum(packed, [])) == sorted(sizes.tolist()) and max(map(sum, packed)) <= 2048
    assert len(packed) == packing.lower_bound(sizes, 2048) == 3334


@pytest.mark.parametrize("low,high,most", [(600, 799, 7_500), (500, 699, 6_500), (400, 520, 4_870)])
def test_packing_of_large_pieces(low, high, most):
    """Best fit decreasing takes some 7,920, 6,520 and 4,890 sequences."""
    sizes = np.random.default_rng(1).integers(low, high + 1, 20_000)
    packed = packing.bin_completion(sizes, 2048)
    assert sorted(chain.from_iterable(packed)) == sorted(sizes.tolist())
    assert max(map(sum, packed)) <= 2048
    assert packing.lower_bound(sizes, 2048) <= len(packed) <= most


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=40), st.integers(30, 60), st.sampled_from(packing.SLACKS))
def test_packing_by_number_holds_every_piece(sizes, capacity, slack):
    packed = packing.by_number(np.array(sizes), capacity, slack)
    assert sorted(chain.from_iterable(packed)) == sorted(sizes)
    assert max(map(sum, packed)) <= capacity
    assert packing.number_bound(np.sort(sizes), capacity) <= len(packed)


def test_packing_is_optimal_where_small():
    r = random.Random(4)
    for n in range(150):
        capacity = r.choice([12, 20, 31])
        low = r.choice([1, 2, 4])
        sizes = sorted((r.randint(low, capacity // r.choice([1, 2, 3])) for _ in range(r.randint(1, 11))), reverse=True)
        packed = packing.bin_completion(np.array(sizes), capacity)
        assert sorted(sum(packed, []), reverse=True) == sizes and max(map(sum, packed)) <= capacity
        assert packing.lower_bound(np.array(sizes), capacity) <= len(packed) == fewest(sizes, capacity)


def test_fillings_are_whole():
    import itertools
    r = random.Random(8)
    for n in range(100):
        room = r.randint(1, 20)
        count = np.array([0] + [r.randint(0, 2) for _ in range(25)])
        pieces = [s for s in range(1, room + 1) for _ in range(count[s])]
        if len(pieces) > 12:
            continue
        every = {c for k in range(len(pieces) + 1) for c in itertools.combinations(pieces, k) if sum(c) <= room}
        got = [tuple(sorted(w)) for w in packing.fillings(count, room) if w is not None]
        assert set(got) <= every and len(got) == len(set(got)) and sum(got[0]) == max(map(sum, every))
        assert {w for w in every if not packing.dominated(count, room, w)} <= set(got)
        assert [sum(w) for w in got] == sorted(map(sum, got), reverse=True)


def test_near_copies_by_row(spark):
    r = random.Random(6)
    text = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(400))
    one, two, three = text(), text(), text()
    near = one + " end"
    assert (simhash.fingerprint(one.encode()) ^ simhash.fingerprint(near.encode())).bit_count() <= 3
    rows = [(1, one), (2, near), (2, two),  # id 2 on a near copy and on another text
            (None, three), (None, three + " end"), (None, one), (5, text()), (6, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(map(tuple, simhash.drop_near_copies(docs).collect()), key=str)
    without = [g for g in got if g[0] is None]
    assert len(without) == 1 and without[0][1] in (three, three + " end")
    assert [g for g in got if g[0] is not None] == [rows[0], rows[2], rows[6], rows[7]]
