"""Guess costs against all segmentations; what is masked and what is not."""

import math
import random
import re
import string

import pytest

from ledgerline.llm import secret_scan
from ledgerline.llm.secret_scan import FIXED, dictionary, find_spans, guess_cost

# words of ordinary text at the ranks they have in corpora
ORDINARY = ("the of and to in is for on with created order date summary customer number primary path file https example org "
            "tokenizer convert ids tokens name value config model default index data table column test main version self index tokens").split()
WORDS = dictionary([*(f"x{i}zqv" for i in range(500)), *(w for k, w in enumerate(ORDINARY))])


def all_ways(value, words):
    """The cheapest of every segmentation, listed one by one."""
    low = value.lower()
    join = math.log10(2)

    def run_end(i, joined, text):
        while i + 1 < len(text) and joined(text[i], text[i + 1]):
            i += 1
        return i + 1

    def spans(i):
        for end in range(i + 1, len(value) + 1):
            yield end, sum(math.log10(secret_scan._class_size(c)) for c in value[i:end]), True
            word, plain = low[i:end], low.translate(secret_scan._LEET)[i:end]
            given = value[i:end]
            if end - i >= 2 and word in words.rank:
                yield end, math.log10(words.rank[word] * (1 if given == word else 2 if given.istitle() or given.isupper() else 8)), False
            elif end - i >= 2 and plain in words.rank:
                yield end, math.log10(words.rank[plain] * 16), False
            for pattern in (r"(?:19|20)\d\d", secret_scan._DATE):
                m = re.compile(pattern).match(value, i)
                if m and m.end() == end:
                    yield end, math.log10(365 * 120 if end - i > 4 else 120), False
        if value[i] in secret_scan._JOINERS:
            yield i + 1, math.log10(4), False
        alnum = lambda a, b: a.isalnum() and b.isalnum()
        for end, g in ((run_end(i, lambda a, b: a == b, value), 12), (run_end(i, lambda a, b: ord(b) - ord(a) == 1 and alnum(a, b), value), 8),
                       (run_end(i, lambda a, b: ord(a) - ord(b) == 1 and alnum(a, b), value), 12)):
            if end - i >= 3:
                yield end, math.log10(g * (end - i)), False
        end = run_end(i, lambda a, b: b in secret_scan._NEAR.get(a, ""), low)
        if end - i >= 3:
            n = end - i
            yield end, math.log10(47 * 4.6 ** min(n - 1, 6) * (1 if n < 8 else n)), False

    best = math.inf

    def go(i, cost, brute):
        nonlocal best
        if i == len(value):
            best = min(best, cost)
            return
        for end, c, is_brute in spans(i):
            if not (brute and is_brute):  # two brute-force spans side by side are one
                go(end, cost + c + join, is_brute)

    go(0, 0.0, False)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_cost_is_the_cheapest_segmentation(seed):
    r = random.Random(seed)
    parts = ["the", "The", "THE", "p4ss", "qwer", "1987", "2024-01-31", "aaa", "abc", "cba", "-", "_", "x", "Z", "9", "#", "é", "tok"]
    for _ in range(40):
        value = "".join(r.choice(parts) for _ in range(r.randint(1, 4)))[:9]
        assert guess_cost(value, WORDS) == pytest.approx(all_ways(value, WORDS), abs=1e-9), value


def guesses(text, words=WORDS):
    return [text[a:b] for kind, a, b in find_spans(text, words) if kind == "guess"]


@pytest.mark.parametrize("text", [
    "key = https://example.org/path/to/file", "token = tokenizer.convert_ids_to_tokens(i)", "turkey: created-order-date-summary",
    "primary key: customer_order_number", "monkey = QwZxKvBnMpLtRsYdHj", "hockey: 839201746528301946", "secret = ${VAULT_SECRET_NAME}",
    "password: {{ database_password }}", "token: $GITHUB_TOKEN_VALUE", "key=%(column_name)s", "key: /path/to/file.config", "passkeys: 123456",
    "token = self.tokens[self.index]", "key = table.column.name.value"])
def test_ordinary_text_stays(text):
    assert guesses(text) == []


@pytest.mark.parametrize("name", ["password", "Passphrase", "DB_PASS", "api_key", "apikey", "clientSecret", "x-auth-token", "signingKey", "my.session-token"])
def test_planted_secrets_are_found(name):
    r = random.Random(name)
    kinds = [string.ascii_letters, string.digits, string.ascii_lowercase + string.digits, string.ascii_letters + string.digits + "+/",
             string.ascii_letters + string.digits + "!#$%&*@^~", "0123456789abcdef"]
    found = planted = 0
    for n in range(300):
        value = "".join(r.choice(kinds[n % len(kinds)]) for _ in range(r.randint(14, 40)))
        found += guesses(f"x {name}{r.choice([': ', ' = ', '=', ': ' + chr(34)])}{value} end") == [value]
        planted += 1
    assert found / planted > 0.97


def test_user_information_in_urls():
    assert guesses("key = https://bob:hfKqzRwvTjbXmPnd9@example.org/path") and not guesses("key = https://example.org:8080/path?name=value")
    assert guesses("token: https://example.org/path?sig=hfKqzRwvTjbXmPnd9x27")


def test_source_code_stays():
    """Spark's own Python sources: names, calls and paths, no secrets."""
    import pathlib

    import pyspark

    texts = [f.read_text() for f in sorted(pathlib.Path(pyspark.__file__).parent.rglob("*.py"))]
    count = {}
    for t in texts:
        for w in set(re.findall(r"[^\W\d_]{3,24}", t.lower())):
            count[w] = count.get(w, 0) + 1
    words = dictionary(sorted((w for w, n in count.items() if n >= 3), key=lambda w: (-count[w], w)))
    marked = [g for t in texts for g in guesses(t, words)]
    contexts = sum(len(secret_scan._CONTEXT.findall(t)) for t in texts)
    assert contexts > 150 and len(marked) <= 0.05 * contexts, (contexts, marked)
    assert FIXED.longest >= 5
