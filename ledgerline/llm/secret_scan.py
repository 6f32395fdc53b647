"""Secret scans: fixed patterns, and password guess costs in credential context.

The base kinds are patterns: ``assign`` (a credential name, a separator and a
value), ``access`` (cloud access keys) and ``hex`` (long lower-case hex runs).
The method adds kind ``guess``: a value that stands after a credential name
is a secret if guessing it is expensive, whatever characters it is made of.
Its cost is the cheapest segmentation into dictionary words, dates, repeats,
sequences, keyboard walks and brute-force spans (after Wheeler, "zxcvbn",
2016), found by dynamic programming over the value's positions in time linear
in its length.

The dictionary is a short fixed list and the words of the corpus itself,
ranked by the documents that hold them outside such values: what is common
prose there is cheap to guess.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ship_package, stage, texts

KINDS = ("assign", "access", "hex", "guess")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
# A value is a secret from this many guesses on (decimal logarithm), in all and
# for each character: a compound of ordinary words is long but cheap by the
# character (about 0.6), random letters, digits or base 64 take 1.0 to 1.4.
MIN_GUESSES = 10.0
MIN_PER_CHARACTER = 0.75
MASK = "[SECRET]"

# The base patterns (hex runs only where they are long enough).
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)

# Whatever ends in one of these names a credential; its value is group 1. The
# name begins a word or a part of one (snake_case, kebab-case, camelCase), so
# neither "monkey" nor "turkey" is one.
_CONTEXT = re.compile(
    r"""(?:(?<![^\W_])|(?-i:(?<=[a-z0-9])(?=[A-Z])))(?:api|auth|access|secret|private|session|signing|encryption|master|client|user|db)?"""
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|key|credentials?)["']?\x20*(?:=>|:=|[:=])\x20*["'`]?([^\s"'`<>,;]{6,})""",
    re.IGNORECASE | re.ASCII)
# A value that stands for another one: ${NAME}, $NAME, {{ name }}, %(name)s.
_REFERENCE = re.compile(r"\$\{?[A-Za-z_]\w*\}?\Z|\$?\{\{?|\$\(|%\(", re.ASCII)
_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://(?:([^/?#@]*)@)?[^/?#]*(.*)", re.ASCII | re.DOTALL)
_JOINERS = frozenset("-_./:()[]{}")  # what joins words in names, paths and calls
_CONTEXT_HINT = re.compile(r"pass|pwd|secret|token|key|credential", re.IGNORECASE | re.ASCII)

# Common password words, commonest first.
_WORDS = (
    "password pass admin root user login welcome letmein qwerty monkey dragon master shadow sunshine princess football "
    "baseball superman batman iloveyou trustno hello freedom whatever michael jordan charlie summer winter spring autumn "
    "secret token key test guest default changeme example sample demo dummy temp server access money love star computer "
    "internet orange banana apple cheese coffee purple silver golden flower tiger eagle falcon hunter ranger soccer hockey "
    "killer pepper ginger cookie jessica ashley daniel thomas robert george andrew matthew joshua nicole amanda the and "
    "is to of in it you that he was for on are with as his they be at one have this from "
    "your my our here there when what where which who how not but all can will would should must may please enter insert "
    "replace put set get use using see read write value string number name file path url host port user username email "
    "account id api auth client service private public shared signing encryption session bearer placeholder unknown none "
    "null undefined empty todo redacted hidden removed required optional true false config settings environment env "
    "variable production staging development local prod dev some any new old first last real fake dont not sure").split()
_LETTERS = re.compile(r"[^\W\d_]{3,24}")
# A word of the corpus counts if it stands in so many documents, and makes up
# one in MAX_WORDS of all (word, document) pairs: there are at most MAX_WORDS.
MIN_DOCUMENTS = 3
MAX_WORDS = 200_000


@dataclass(frozen=True)
class Words:
    """A dictionary: rank of each word in lower case, and the longest length."""

    rank: dict[str, int]
    longest: int


def dictionary(ranked: list[str]) -> Words:
    """The fixed words and those of ``ranked`` (commonest first); a word of
    both has the better rank."""
    rank = {w: i + 1 for i, w in enumerate(ranked)}
    for i, w in enumerate(dict.fromkeys(_WORDS)):
        rank[w] = min(i + 1, rank.get(w, i + 1))
    return Words(rank, max(map(len, rank)))


FIXED = dictionary([])
_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_LEET = str.maketrans("430157@$!", "aeoistasi")
_DATE = re.compile(
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d"
    r"|(?:19|20)\d\d")


def _neighbours() -> dict[str, str]:
    """Keys that touch: beside each other in a row, or a row below."""
    near: dict[str, set[str]] = {}
    for y, row in enumerate(_ROWS):
        for x, c in enumerate(row):
            for dy, dx in ((0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1)):
                if 0 <= y + dy < len(_ROWS) and 0 <= x + dx < len(_ROWS[y + dy]):
                    near.setdefault(c, set()).add(_ROWS[y + dy][x + dx])
    return {c: "".join(sorted(n)) for c, n in near.items()}


_NEAR = _neighbours()


def _class_size(c: str) -> int:
    if c.isdigit():
        return 10
    if c.isascii() and c.isalpha():
        return 26
    return 33 if c.isascii() else 100


def _runs(value: str, joined) -> list[int]:
    """For each position the end of the longest run from it whose neighbours
    are ``joined``, found from the right in one pass."""
    ends = [len(value)] * len(value)
    for i in range(len(value) - 2, -1, -1):
        ends[i] = ends[i + 1] if joined(value[i], value[i + 1]) else i + 1
    return ends


def guess_cost(value: str, words: Words = FIXED) -> float:
    """Decimal logarithm of the guesses for the cheapest segmentation.

    Each span costs the logarithm of its guesses plus that of 2 for choosing
    how to go on. Brute force costs a character's class size per character,
    so it is extended rather than enumerated; runs (repeats, sequences,
    keyboard walks) need no spans but their longest one and its prefixes'
    ends, which are taken where they end.
    """
    n = len(value)
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)  # as long as the value
    plain = low.translate(_LEET)
    repeat = _runs(value, lambda a, b: a == b)
    upward = _runs(value, lambda a, b: ord(b) - ord(a) == 1 and a.isalnum() and b.isalnum())
    downward = _runs(value, lambda a, b: ord(a) - ord(b) == 1 and a.isalnum() and b.isalnum())
    walk = _runs(low, lambda a, b: b in _NEAR.get(a, ""))
    cost = [0.0] + [math.inf] * n
    brute = [False] * (n + 1)  # whether the best way here ends in brute force
    join = math.log10(2)

    def reach(i: int, end: int, guesses: float) -> None:
        new = cost[i] + math.log10(guesses) + join
        if new < cost[end]:
            cost[end], brute[end] = new, False

    for i in range(n):
        one = cost[i] + math.log10(_class_size(value[i])) + (0.0 if brute[i] else join)
        if one < cost[i + 1]:
            cost[i + 1], brute[i + 1] = one, True
        if value[i] in _JOINERS:
            reach(i, i + 1, 4.0)
        for end, guesses in ((repeat[i], 12.0), (upward[i], 8.0), (downward[i], 12.0)):
            if end - i >= 3:
                reach(i, end, guesses * (end - i))
        if walk[i] - i >= 3:
            reach(i, walk[i], 47.0 * 4.6 ** min(walk[i] - i - 1, 6) if walk[i] - i < 8 else 47.0 * 4.6 ** 6 * (walk[i] - i))
        if value[i].isdigit():
            for found in (_DATE.match(value, i), re.match(r"(?:19|20)\d\d", value[i:i + 4])):
                if found:
                    reach(i, i + found.end() - found.start(), 365.0 * 120 if found.end() - found.start() > 4 else 120.0)
        for end in range(i + 2, min(n, i + words.longest) + 1):
            rank = words.rank.get(low[i:end])
            if rank:
                reach(i, end, rank * (1.0 if value[i:end] == low[i:end] else 2.0 if value[i:end].istitle() or value[i:end].isupper() else 8.0))
            elif rank := words.rank.get(plain[i:end]):
                reach(i, end, rank * 16.0)
    return cost[n]


def is_secret(value: str, words: Words = FIXED) -> bool:
    """Whether a value is expensive to guess. A reference to another value is
    none; of a URL the user information and the parts after the host count."""
    if _REFERENCE.match(value):
        return False
    if url := _URL.match(value):
        parts = re.split(r"[/?&=#:]+", f"{url[1] or ''}/{url[2]}")
        return any(is_secret(p, words) for p in parts if p)
    cost = guess_cost(value, words)
    return cost >= MIN_GUESSES and cost >= MIN_PER_CHARACTER * len(value)


def find_spans(text: str, words: Words = FIXED) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, by start, then kind."""
    spans = []
    if "=" in text or ":" in text:
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
        if _CONTEXT_HINT.search(text):
            spans += [("guess", *m.span(1)) for m in _CONTEXT.finditer(text) if is_secret(m[1], words)]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    # runs are maximal, so searching the long ones finds the same as dropping short ones
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def as_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every (overlapping spans: joined) span as ``MASK``."""
    out, at = [], 0
    for start, end in _joined(spans):
        out += [text[at:start], MASK]
        at = end
    return "".join([*out, text[at:]])


def _joined(spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    joined: list[tuple[int, int]] = []
    for start, end in sorted((a, b) for _, a, b in spans):
        if joined and start <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(end, joined[-1][1]))
        else:
            joined.append((start, end))
    return joined


def corpus_words(docs: DataFrame) -> Words:
    """The dictionary of ``docs``: letter runs of 3 to 24 characters by the
    number of documents they stand in, credential values left out. Counted on
    the executors; the driver gets the common ones, MAX_WORDS at most."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[str] = Counter()
        flush = lambda: pa.RecordBatch.from_arrays(
            [pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], names=["word", "n"])
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if _CONTEXT_HINT.search(text):
                    text = _CONTEXT.sub(" ", text)
                count.update(set(_LETTERS.findall(text.lower())))
            if len(count) > MAX_WORDS:
                yield flush()
                count.clear()
        yield flush()

    counted = stage(texts(docs).select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counted.agg(F.sum("n")).first()[0] or 0
    common = counted.where((F.col("n") >= MIN_DOCUMENTS) & (F.col("n") * MAX_WORDS >= total)).collect()
    return dictionary([r.word for r in sorted(common, key=lambda r: (-r.n, r.word))])


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_guess, base_sha256 (of the base
    spans as ``kind:start:end`` joined by commas) and spans (all of them) for
    every row. A null text is empty: no spans, and the digest of the empty
    string. Repeated rows get repeated results; an empty table gives an empty
    result. Only the counts of words are exchanged."""
    ship_package(docs.sparkSession)
    words = docs.sparkSession.sparkContext.broadcast(corpus_words(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                spans = find_spans(text.as_py(), words.value)
                kinds = [s[0] for s in spans]
                base = as_text([s for s in spans if s[0] != "guess"])
                rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(base.encode()).hexdigest(), as_text(spans)))
            kinds = [pa.int64()] * len(KINDS) + [pa.string()] * 2
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"])

    return texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_guess bigint, base_sha256 string, spans string")


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in the text masked and ``n_chars`` counted
    anew where the text changed. Null texts stay null; no row is lost."""
    ship_package(docs.sparkSession)
    words = docs.sparkSession.sparkContext.broadcast(corpus_words(docs))
    schema, at = docs.schema, docs.columns.index("text")
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            old = columns[at].to_pylist()
            new = [None if t is None else redact(t, find_spans(t, words.value)) for t in old]
            columns[at] = pa.array(new, columns[at].type)
            if counted is not None:
                lengths = columns[counted].to_pylist()
                columns[counted] = pa.array(
                    [n if a == b else len(b) for n, a, b in zip(lengths, old, new)], columns[counted].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, schema)
