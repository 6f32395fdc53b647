"""Property tests: Spark column functions against plain-Python statements
of the same rules, over generated strings (one Spark job per property)."""

import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import python_float_nonpositive, safe_integer, safe_numeric

ALPHABET = "0123456789+-._eE ,\tinfaINFAy"
texts = st.lists(st.text(alphabet=ALPHABET, max_size=8), min_size=50, max_size=300)


def _py_nonpositive(s):
    try:
        return float(s or "") <= 0
    except ValueError:
        return False


def _py_safe_integer(s):
    t = (s or "").strip(" ")
    if re.fullmatch(r"-?\d+", t) or re.fullmatch(r"-?\d+\.0+", t):
        v = int(t.split(".")[0])
        return v if -2**31 <= v < 2**31 else None
    return None


def _py_safe_numeric(s):
    t = (s or "").strip(" ").replace(",", "")
    if not re.fullmatch(r"-?\d+(\.\d+)?", t):
        return None
    try:
        v = Decimal(t).quantize(Decimal("0.0001"), rounding=ROUND_HALF_UP)
    except InvalidOperation:
        return None
    return v if abs(v) < Decimal(10) ** 14 else None


def _spark_values(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[1] for r in df.select("i", fn(F.col("x"))).orderBy("i").collect()]


SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(values=texts)
def test_reject_rule_matches_python_float(spark, values):
    assert _spark_values(spark, python_float_nonpositive, values) == [_py_nonpositive(v) for v in values]


@SETTINGS
@given(values=texts)
def test_safe_integer_matches_rule(spark, values):
    assert _spark_values(spark, safe_integer, values) == [_py_safe_integer(v) for v in values]


@SETTINGS
@given(values=texts)
def test_safe_numeric_matches_rule(spark, values):
    assert _spark_values(spark, safe_numeric, values) == [_py_safe_numeric(v) for v in values]


DATE_ALPHABET = "0123456789/:- "
dates = st.lists(st.one_of(
    st.text(alphabet=DATE_ALPHABET, min_size=10, max_size=19),
    st.builds(lambda m, d, y, h, mi: f"{m}/{d}/{y} {h}:{mi:02d}",
              st.integers(0, 14), st.integers(0, 33), st.integers(1990, 2030), st.integers(0, 25), st.integers(0, 61)),
    st.builds(lambda y, m, d, h, mi, s: f"{y:04d}-{m:02d}-{d:02d} {h:02d}:{mi:02d}:{s:02d}",
              st.integers(1990, 2030), st.integers(0, 13), st.integers(0, 32), st.integers(0, 24),
              st.integers(0, 60), st.integers(0, 61)),
), min_size=50, max_size=300)


def _py_ts(s, layout):
    import datetime as dt
    t = (s or "").strip(" ")
    shape = r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}" if layout == "mdy_hm" else r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"
    if not re.fullmatch(shape, t):
        return None
    n = [int(x) for x in re.split(r"[-/: ]", t)]
    y, mo, d, h, mi, sec = (n[2], n[0], n[1], n[3], n[4], 0) if layout == "mdy_hm" else tuple(n)
    try:
        return dt.datetime(y, mo, d, h, mi, sec)
    except ValueError:
        return None


@SETTINGS
@given(values=dates)
def test_timestamp_parsers_match_calendar(spark, values):
    from ledgerline.functions import parse_feed_timestamp
    for layout in ("mdy_hm", "iso_hms"):
        got = _spark_values(spark, lambda c: parse_feed_timestamp(c, layout), values)
        assert got == [_py_ts(v, layout) for v in values]


TEXT_ALPHABET = "ab AB\t\n\x0b\x0c\ré-"


@SETTINGS
@given(values=st.lists(st.text(alphabet=TEXT_ALPHABET, max_size=10), min_size=50, max_size=300))
def test_normalizers_match_rules(spark, values):
    from ledgerline.functions import normalize_code, normalize_description
    ws = "[ \t\n\x0b\x0c\r]+"
    assert _spark_values(spark, normalize_code, values) == [re.sub(ws, "", v.strip(" ")).upper() for v in values]
    assert _spark_values(spark, normalize_description, values) == \
        [re.sub(ws, " ", v.strip(" ")).upper() for v in values]


def _duck_values(expr_sql, values):
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    return [r[0] for r in con.execute(f"SELECT {expr_sql} FROM t ORDER BY i").fetchall()]


@SETTINGS
@given(values=texts, ts=dates)
def test_oracle_expressions_agree_with_spark(spark, values, ts):
    import datetime as dt

    from ledgerline.functions import is_return_invoice, parse_feed_timestamp
    from ledgerline.plans import oracle
    from ledgerline.sources.feeds import ECOMMERCE, ONLINE_RETAIL

    def norm(v):
        return float(v) if isinstance(v, Decimal) else v

    pairs = [
        (python_float_nonpositive, oracle.price_nonpos("x"), values),
        (is_return_invoice, oracle.is_return("x"), values + ["c1", " C2", "\tc3"]),
        (safe_integer, oracle.safe_int("x"), values),
        (safe_numeric, oracle.safe_num("x"), values),
        (lambda c: parse_feed_timestamp(c, "mdy_hm"), oracle.parse_ts("x", ECOMMERCE), ts),
        (lambda c: parse_feed_timestamp(c, "iso_hms"), oracle.parse_ts("x", ONLINE_RETAIL), ts),
    ]
    for fn, sql, vals in pairs:
        got = [norm(v) for v in _spark_values(spark, fn, vals)]
        want = [norm(v) if not isinstance(v, dt.datetime) else v for v in _duck_values(sql, vals)]
        assert got == want, sql[:80]
