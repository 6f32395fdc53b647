"""Operators against brute force, on the smallest tables and on odd rows."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from llm_data import SF
from ledgerline.llm import bpe, exact_dedup, fingerprints, line_dedup, packing, quality_pu, secret_scan, sharding, simhash, warc
from ledgerline.llm.components import connected_components
from ledgerline.llm.queries import oracle_sql, queries


@pytest.fixture(scope="module")
def docs(spark, odd):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    return given.unionByName(odd.selectExpr("doc_id + 5000 AS doc_id", "text", "lang", "source", "n_chars"))


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def components(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(n)]


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    for df in (fingerprints.fingerprint_documents(none), line_dedup.line_classes(none), secret_scan.scan_documents(none),
               simhash.near_components(none), exact_dedup.exact_groups(none), packing.pack_documents(none),
               quality_pu.score_documents(none, labels), bpe.encode_documents(none), sharding.assign_shards(none, 24),
               warc.round_trip(pages), exact_dedup.drop_exact_copies(none), simhash.drop_near_copies(none),
               secret_scan.redact_documents(none), line_dedup.drop_repeated_lines(none)):
        assert df.count() == 0


def test_components(spark):
    links = [(random.Random(i).randint(0, 300), random.Random(-i - 1).randint(0, 300)) for i in range(180)]
    links += [(400 + i, 401 + i) for i in range(40)] + [(500, 500)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = components(600, links)
    assert got == {x: want[x] for x in {y for pair in links for y in pair}}


def test_fingerprints(docs, rows):
    def shingles(t):
        w = t.split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    got = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs).collect() if r.doc_id is not None}
    ordered = sorted(((i, t) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    prints, errors = defaultdict(set), []
    for (i, t), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        if i is None or i == 5004:
            continue
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        errors += [abs(got[i].near_edited - like(shingles(t), shingles(edited))), abs(got[i].near_next - like(shingles(t), shingles(following)))]
        prints[t].add(got[i].fingerprint)
    assert np.mean(errors) < 0.03 and max(errors) < 0.2
    assert all(len(p) == 1 for p in prints.values())


def test_sketches_merge(spark, docs):
    from pyspark.sql import functions as F
    parts = docs.where("doc_id < 40").select((F.col("doc_id") % 2).alias("k"), fingerprints.sketch(F.col("text")).alias("sketch"))
    merged = {r.k: r.sketch for r in fingerprints.merge_sketches(parts, ["k"]).collect()}
    every = defaultdict(set)
    for r in docs.where("doc_id < 40").select((F.col("doc_id") % 2).alias("k"), fingerprints.shingle_hashes(F.col("text")).alias("h")).collect():
        every[r.k] |= set(r.h)
    assert merged == {k: sorted(h)[:fingerprints.SKETCH_SIZE] for k, h in every.items()}


def distance(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def test_banded_distance():
    r = random.Random(3)
    for _ in range(4000):
        a = "".join(r.choice("ab") for _ in range(r.randint(0, 14)))
        b = list(a)
        for _ in range(r.randint(0, 5)):
            at = r.randint(0, len(b))
            b[at:at + r.randint(0, 1)] = r.choice(["", "a", "c"])
        b = "".join(b)
        for k in (1, 2, 3):
            assert line_dedup.within(a, b, k) == (distance(a, b) <= k), (a, b, k)


def line_fixture():
    r = random.Random(5)
    base = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(40, 60))).strip().ljust(40, "z") for _ in range(12)]
    lines = []
    for b in base:
        for _ in range(30 if b is base[0] else 4):
            line = list(b)
            for _ in range(r.randint(0, 3)):
                at = r.randrange(len(line))
                line[at:at + r.randint(0, 1)] = r.choice(["", "q", "é"])
            lines.append("".join(line))
    return lines + ["short", "shorter", "short"]


@pytest.mark.parametrize("meet", [32, 3])
def test_line_classes(spark, monkeypatch, meet):
    monkeypatch.setattr(line_dedup, "MEET", meet)
    monkeypatch.setattr(line_dedup, "BLOCK", 4 if meet == 3 else 256)
    lines = line_fixture()
    df = spark.createDataFrame([(i, "\n\n".join(lines[i * 5:i * 5 + 5])) for i in range(-(-len(lines) // 5))], "doc_id bigint, text string")
    got = {(r.doc_id, r.line_no): r for r in line_dedup.line_classes(df).collect()}
    places = [(i // 5, i % 5 * 2) for i in range(len(lines))]
    links = [(i, j) for i in range(len(lines)) for j in range(i) if lines[i] == lines[j] or (
        min(len(lines[i]), len(lines[j])) >= line_dedup.MIN_CHARS and distance(lines[i], lines[j]) <= line_dedup.MAX_EDITS)]
    want, sizes = components(len(lines), links), Counter(components(len(lines), links))
    for i, place in enumerate(places):
        r = got[place]
        assert ((r.class_doc, r.class_line), r.class_size, r.kept) == (places[want[i]], sizes[want[i]], want[i] == i)
    assert len(got) == len(lines)


def test_secret_spans(docs, rows):
    import re
    got = Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secret_scan.scan_documents(docs).collect())
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    want = Counter()
    for i, t in rows:
        found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
        found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(found))
        n = Counter(f[2] for f in found)
        want[i, n["assign"], n["access"], n["hex"], hashlib.sha256(text.encode()).hexdigest()] += 1
    assert got == want


def test_guess_costs():
    cost = secret_scan.guess_cost
    assert cost("password") < cost("password1") < cost("xK9#mQ2$vL7pZ")
    assert cost("aaaaaaaaaaaa") < 4 and cost("qwertyuiop") < 6 and cost("2024-01-31") < 6
    assert secret_scan.is_secret("24be64439e3e49cf46b2d7c90f3602a3d0b907ff") and not secret_scan.is_secret("your-password-here")
    assert secret_scan.redact("pwd: Zx9#kQ27vLpZ81 ok", secret_scan.find_spans("pwd: Zx9#kQ27vLpZ81 ok")) == "pwd: [SECRET] ok"


def simhash_of(t):
    w = t.encode().lower().split()
    s = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def test_simhash(docs, rows):
    some = [(i, t) for i, t in rows if len(t) < 100_000]
    prints = [simhash_of(t) for _, t in some]
    links = [(a, b) for a in range(len(some)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    parts = components(len(some), links)
    least = defaultdict(list)
    for (i, _), c in zip(some, parts):
        least[c].append(i)
    want = Counter((i, f"{p:016x}", min(x for x in least[c] if x is not None)) for (i, _), p, c in zip(some, prints, parts))
    from pyspark.sql import functions as F
    got = simhash.near_components(docs.where(F.coalesce(F.length("text"), F.lit(0)) < 100_000)).collect()
    assert Counter(map(tuple, got)) == want


def test_simhash_tiles(spark):
    r = random.Random(1)
    prints = [r.getrandbits(64) for _ in range(40)]
    prints += [p ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for p in prints for _ in range(5)]
    fps = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in set(prints)], "fp bigint")
    got = connected_components(simhash.links_within(fps, 3, tile=2))
    values = sorted(set(prints))
    want = components(len(values), [(a, b) for a in range(len(values)) for b in range(a) if (values[a] ^ values[b]).bit_count() <= 3])
    groups = defaultdict(set)
    for v, c in zip(values, want):
        groups[c].add(v)
    found = defaultdict(set)
    for row in got.collect():
        found[row.component].add(row.node % (1 << 64))
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {frozenset(g) for g in found.values()}


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_exact_groups(docs, rows, monkeypatch, bound):
    monkeypatch.setattr(exact_dedup, "BROADCAST_PAIRS", bound)
    got = exact_dedup.exact_groups(docs, digest_all=True).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups["".join(c for c in t if c not in " \t\n\x0b\x0c\r")].append((-len(t), i is None, i))
    by = {hashlib.sha256(k.encode()).hexdigest(): sorted(g, key=str) for k, g in groups.items()}
    for r in got:
        best = min(by[r.text_sha256], key=lambda x: (x[0], x[1], x[2] or 0))
        assert (r.keep_id, r.group_size) == (best[2], len(by[r.text_sha256]))
    assert len(got) == len(rows) and sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup.drop_exact_copies(docs).count() == len(groups)


def test_bpe_and_packing(docs, rows):
    tokenizer = bpe.encoder(bpe.vocabulary_path()).tokenizer
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in rows}
    for r in bpe.encode_documents(docs).collect():
        decoded = tokenizer.decode(ids[r.doc_id], skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids[r.doc_id]), hashlib.sha256(",".join(map(str, ids[r.doc_id])).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    pieces = packing.pack_documents(docs).collect()
    sequences = defaultdict(list)
    for p in pieces:
        whole = np.array([*ids[p.doc_id], 0], "<u4")
        assert zlib.crc32(whole[p.start:p.start + p.length].tobytes()) == p.ids_crc32
        sequences[p.sequence_id].append((p.offset, p.length))
    for s in sequences.values():
        s.sort()
        assert [o for o, _ in s] == [sum(n for _, n in s[:k]) for k in range(len(s))] and sum(n for _, n in s) <= 2048
    assert sum(p.length for p in pieces) == sum(len(ids[i]) + 1 for i, _ in rows)
    assert len(sequences) <= packing.lower_bound(np.array([p.length for p in pieces]), 2048) + 1


def test_bpe_random_text():
    e = bpe.encoder(bpe.vocabulary_path())
    r = random.Random(2)
    alphabet = [*"abcdeéàèßABC  \n\n\t\r.,!?'\"<|>0123 　\u0085\x1c漢🙂́K²", "<|endoftext|>", "'s", "don't", "\xa0 ", " '"]
    for _ in range(3000):
        t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 40)))
        want = e.tokenizer.encode(t, add_special_tokens=False).ids
        assert e.encode(t) == want and e.decode(want) == e.tokenizer.decode(want, skip_special_tokens=False)


def test_sharding(docs, rows):
    got = sharding.assign_shards(docs, 24).collect()
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(got) == len(rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in rows)
    many = np.bincount(sharding.jump_hash(np.arange(100_000).astype(np.uint64), 24))
    assert many.min() > 3800 and many.max() < 4500


def test_jump_hash_one_key_at_a_time():
    def scalar(key, shards):
        at, jump = -1, 0
        while jump < shards:
            at = jump
            key = (key * 2862933555777941757 + 1) % (1 << 64)
            jump = int((at + 1) * ((1 << 31) / ((key >> 33) + 1)))
        return at

    r = random.Random(8)
    keys = [0, 1, (1 << 64) - 1, 1 << 63, *(r.getrandbits(64) for _ in range(3000))]
    for shards in (1, 2, 24, 25, 1000):
        assert sharding.jump_hash(np.array(keys, np.uint64), shards).tolist() == [scalar(k, shards) for k in keys]


def _by_record(rows):
    records = defaultdict(list)
    for r in rows:
        records[r.archive, r.record].append(r)
    return records


def test_warc(spark):
    from pyspark.sql import functions as F
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    pages = pages.unionByName(pages.limit(9).withColumn("page_id", F.col("page_id") + 900)).union(spark.createDataFrame(
        [(5000, "u\r\nx", None), (5001, None, ""), (None, "a", "zz"), (6000, "b", "zz"), (6000, "b", "zz"), (6000, "b", "other"),
         (None, "n", "lost?"), (None, "n", "lost?"), (None, "m", "lost?"), (3, "x", "first twice"), (3, "x", "first twice"), (4, "x", "first twice"), (7000, "c", "é" * 200_000)], pages.schema))
    data = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    groups = defaultdict(list)
    for i, h in data:
        groups[h].append(i)
    want = Counter()
    for h, ids in groups.items():  # one response to a payload, the smallest id, a missing one last
        ids.sort(key=lambda i: (i is None, i or 0))
        for n, i in enumerate(ids):
            want[i, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "revisit" if n else "response", ids[0] if n else None] += 1
    chunks = warc.write_archives(pages, chunk_bytes=1000)
    assert Counter(map(tuple, warc.read_archives(chunks).collect())) == want
    heads = [warc.parse_header(bytes(r.data)) for r in chunks.where("kind = 'header'").collect()]
    named = {h["WARC-Record-ID"] for h in heads if h["WARC-Type"] == "response"}
    assert len({h["WARC-Record-ID"] for h in heads}) == len(heads)
    assert all(h["WARC-Refers-To"] in named for h in heads if h["WARC-Type"] == "revisit")
    # every payload is there, once
    kept = Counter(b"".join(bytes(r.data) for r in sorted(rows, key=lambda r: r.chunk_no))
                   for rows in _by_record(chunks.where("kind = 'payload'").collect()).values())
    assert kept == Counter(h for h in groups if h)
    archive = heads and b"".join(warc.export_archive(chunks, 0))
    assert archive.startswith(b"WARC/1.1\r\n") and archive.count(b"WARC/1.1\r\nWARC-Type") == chunks.where("kind = 'header' and archive = 0").count()
    # without ids that need places, and with a least size
    plain = pages.where("page_id < 500 or page_id > 5500 and page_id <> 6000")
    some = [(r.page_id, (r.html or "").encode()) for r in plain.collect()]
    least = {}
    for i, h in some:
        least[h] = min(i, least.get(h, i))
    assert Counter((r.page_id, r.record_type, r.refers_to) for r in warc.round_trip(plain, min_bytes=2000).collect()) == Counter(
        (i, "revisit", least[h]) if len(h) >= 2000 and i != least[h] else (i, "response", None) for i, h in some)
    broken = chunks.withColumn("data", F.when((F.col("kind") == "payload") & (F.col("chunk_no") == 2), F.lit(b"x")).otherwise(F.col("data")))
    with pytest.raises(Exception, match="damaged"):
        warc.read_archives(broken).collect()


def test_quality():
    r = np.random.default_rng(0)
    good, bad = r.normal(0, 1, (4000, 6)), r.normal(0, 1, (4000, 6)) + np.array([4, 0, 0, 0, 0, 0])
    mixed = np.concatenate([good[2000:3600], bad[:400]])
    model = quality_pu.fit_local(good[:2000], mixed)
    assert 0.75 < model.prior < 0.85
    assert (model.score(good[3600:]) >= 0.5).mean() > 0.95 and (model.score(bad[400:]) < 0.5).mean() > 0.7


def test_quality_on_tables(spark, odd):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = [r for r in quality_pu.score_documents(docs, labels).collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert quality_pu.score_documents(odd, labels).count() == odd.count()


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_queries_match_sql(spark, key):
    from compare import compare, duck
    result = compare(queries()[key](spark, SF), duck(SF), oracle_sql()[key])
    assert result["columns_match"] and result["values_match"], result


def test_pipeline(spark):
    import corpus_pipeline
    got = corpus_pipeline.run(spark, SF).collect()
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in quality_pu.score_documents(docs, labels).collect() if r.predicted}
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id in good}
    keep = {}
    for i, t in texts.items():
        k = "".join(t.split())
        keep[k] = min([*([keep[k]] if k in keep else []), (-len(t), i)])
    left = sorted(i for _, i in keep.values())
    prints = [simhash_of(texts[i]) for i in left]
    parts = components(len(left), [(a, b) for a in range(len(left)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3])
    left = [i for n, i in enumerate(left) if parts[n] == n]
    tokenizer = bpe.encoder(bpe.vocabulary_path()).tokenizer
    sizes = {i: len(tokenizer.encode(secret_scan.redact(texts[i], secret_scan.find_spans(texts[i])), add_special_tokens=False).ids) + 1 for i in left}
    packed = Counter()
    for p in got:
        packed[p.doc_id] += p.length
    assert packed == sizes
