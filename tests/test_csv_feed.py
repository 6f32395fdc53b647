"""CSV feeds: malformed files stop the load; quoted line ends, short lines and
files with headers of their own load right."""

import csv
import io
import os
import random
import re
import subprocess
import sys

import pytest

from data_dirs import ROOT, SF_SMALL
from ledgerline.functions.numbers import is_return_invoice, python_float_nonpositive
from ledgerline.functions.timestamps import minute_text
from ledgerline.operators import ingest
from ledgerline.sources.csv_feed import left_open, read_feed_csv, records
from ledgerline.sources.feeds import ECOMMERCE, ONLINE_RETAIL
from pyspark.sql import functions as F

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"


def _feed(tmp_path, *lines):
    (tmp_path / "f.csv").write_bytes("\n".join([HEADER, *lines, ""]).encode("latin-1"))
    return str(tmp_path)


def test_short_rows_quotes_and_latin1(spark, tmp_path):
    path = _feed(tmp_path, '1,A,"RED, ""LARGE""",2,12/1/2010 8:00,1.00,5,Espa\xf1a', "2,B,NA")
    rows = [tuple(r) for r in read_feed_csv(spark, path, ECOMMERCE).collect()]
    assert rows == [("1", "A", 'RED, "LARGE"', "2", "12/1/2010 8:00", "1.00", "5", "Espa\xf1a"),
                    ("2", "B", "NA", None, None, None, None, None)]


def _python_rows(data: bytes, encoding: str):
    """What Python's csv module makes of a file, as dicts by header."""
    header, *rows = [r for r in csv.reader(io.StringIO(data.decode(encoding), newline="")) if r]
    return [{h: (v or None) for h, v in zip(header, r + [""] * (len(header) - len(r)))} for r in rows]


def _loaded(spark, path, spec):
    return sorted((tuple(sorted((k, v) for k, v in r.asDict().items() if v is not None)) for r in read_feed_csv(spark, path, spec).collect()))


def _expected(*files, encoding="latin-1"):
    return sorted(tuple(sorted((k, v) for k, v in r.items() if v is not None)) for f in files for r in _python_rows(f, encoding))


def test_surplus_cells_stop_the_read(spark, tmp_path):
    df = read_feed_csv(spark, _feed(tmp_path, "1,A,RED, LARGE BAG,2,12/1/2010 8:00,1.00,5,France"), ECOMMERCE)
    with pytest.raises(Exception, match="surplus cells or an unbalanced quote"):
        df.collect()
    with pytest.raises(Exception, match="surplus cells or an unbalanced quote"):
        df.count()


def test_surplus_cells_beside_quoted_newlines(spark, tmp_path):
    path = _feed(tmp_path, '1,A,"two\nlines",2,12/1/2010 8:00,1.00,5,France', "2,A,RED, LARGE BAG,2,12/1/2010 8:00,1.00,5,France")
    with pytest.raises(Exception, match="surplus cells or an unbalanced quote"):
        read_feed_csv(spark, path, ECOMMERCE).collect()


@pytest.mark.parametrize("line", ['1,A,RED,2,12/1/2010 8:00,1.00,5,"France', '1,A,"RED,2,12/1/2010 8:00,1.00,5,France\n2,B,BLUE,1,x,1.00,5,Spain'])
def test_quote_left_open_stops_the_read(spark, tmp_path, line):
    path = _feed(tmp_path, "0,A,RED,2,12/1/2010 8:00,1.00,5,France", line)
    with pytest.raises(ValueError, match="still open at the end"):
        read_feed_csv(spark, path, ECOMMERCE)


@pytest.mark.parametrize("split", [40, 97, 1 << 27])
def test_quoted_line_ends_in_split_files(spark, tmp_path, split):
    r = random.Random(split)
    cells = ["RED", 'say ""hi""', "a,b", "two\nlines", "\n", "\n\n,\n", 'x""\n""y', "cr\r\nlf", "caf\xe9", "long " * 30 + "\n" + "tail " * 30, "", '""']
    lines = []
    for i in range(160):
        d = r.choice(cells)
        plain = not set(d) & set('",\n\r')
        lines.append(f'{i},{r.choice("AB")},' + (d if plain and r.random() < .7 else f'"{d}"') + f',2,12/1/2010 8:00,1.00,5,{r.choice(["France", chr(34) + "Fra" + chr(10) + "nce" + chr(34)])}')
    ends = ["\n", "\r\n"]
    files = [(HEADER + e + "".join(x + e for x in lines[k::2])).encode("latin-1") for k, e in enumerate(ends)]
    for k, f in enumerate(files):
        (tmp_path / f"{k} [x].csv").write_bytes(f)
    (tmp_path / "one.csv").write_bytes((HEADER + "\n7,Z,no quotes,1,12/1/2010 8:00,1.00,5,Spain").encode())
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = _loaded(spark, str(tmp_path), ECOMMERCE)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == _expected(*files, (tmp_path / "one.csv").read_bytes())


def test_lines_and_the_quoting_state(spark):
    """left_open against an automaton, character by character."""
    def open_at_end(text):
        state = "start"
        for c in text:
            if state == "quoted":
                state = "quote" if c == '"' else "quoted"
            elif state == "quote" and c == '"':
                state = "quoted"
            elif c == ",":
                state = "start"
            elif state == "start" and c == '"':
                state = "quoted"
            else:
                state = "plain"
        return state == "quoted"

    r = random.Random(9)
    lines = ["".join(r.choice('"",ab\r ') for _ in range(r.randint(0, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in lines], "x string").select("x", left_open(F.col("x")).alias("a"),
                                                                     left_open(F.concat(F.lit('"'), "x")).alias("b"))
    for row in df.collect():
        assert (row.a, row.b) == (open_at_end(row.x), open_at_end('"' + row.x)), row.x
    many = "a," * 20_000 + '"' + '""' * 50_000
    assert spark.createDataFrame([(many,)], "x string").select(left_open(F.col("x"))).first()[0]


def test_each_file_has_its_own_header(spark, tmp_path):
    files = {"a.csv": HEADER + "\n1,A,X,1,12/1/2010 8:00,1.00,5,France\n",
             "b.csv": "Country,InvoiceNo,StockCode,Extra,Quantity\nSpain,2,B,e,9\n",
             "c.csv": 'InvoiceNo,"Stock\tCode",InvoiceNo,Country\n3,C,dup,"It\naly"\n', "empty.csv": "", "d.csv": "\n\n" + HEADER + "\n\n4,D\n  \n"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    got = ingest.feed_cells(read_feed_csv(spark, str(tmp_path), ECOMMERCE), ECOMMERCE).select(
        "invoice_no", "stock_code", "description", "quantity", "unit_price", "country").collect()
    assert sorted(map(tuple, got)) == [("1", "A", "X", "1", "1.00", "France"), ("2", "B", None, "9", None, "Spain"),
                                       ("3", None, None, None, None, "It\naly"), ("4", "D", None, None, None, None)]


def test_only_records_that_a_border_cuts_are_shuffled_again(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,B\n" + '1,"x\ny"\n' * 50)
    df = records(spark, [str(tmp_path)], ECOMMERCE)
    assert df.count() == 51
    plan = df._jdf.queryExecution().executedPlan().toString()
    shuffles = re.findall(r"hashpartitioning\(file#\d+, (\w+)", plan)
    # two reads of the lines by split, and by record those that are cut
    assert sorted(set(shuffles)) == ["block", "record"] and shuffles.count("record") == 1 and "cut#" in plan


def test_invalid_utf8_stops_the_load(spark, tmp_path):
    head = ",".join(ONLINE_RETAIL.headers).encode()
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf" + head + "\n1,A,caf\u00e9,1,2010-12-01 08:00:00,1.00,5,\u6f22\n".encode())
    assert [(r.Invoice, r.Description, r.Country) for r in read_feed_csv(spark, str(tmp_path), ONLINE_RETAIL).collect()] == [("1", "caf\u00e9", "\u6f22")]
    (tmp_path / "b.csv").write_bytes(head + b"\n2,B,caf\xe9,1,2010-12-01 08:00:00,1.00,5,France\n")
    with pytest.raises(ValueError, match=r"b.csv: line that is not UTF-8: b'2,B,caf"):
        read_feed_csv(spark, str(tmp_path), ONLINE_RETAIL)


def test_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert read_feed_csv(spark, str(tmp_path), ECOMMERCE).columns == list(ECOMMERCE.headers)


def test_python_whitespace(spark):
    spaces = [chr(c) for c in range(0x10000) if chr(c).isspace()]
    df = spark.createDataFrame([(w + "0.00" + w, w + "c1" + w) for w in spaces], "p string, i string")
    assert df.where(python_float_nonpositive(F.col("p")) & is_return_invoice(F.col("i"))).count() == len(spaces)


def test_minute_text(spark):
    row = spark.sql("SELECT timestamp_ntz'2010-12-01 08:05:59' AS t, CAST(NULL AS timestamp_ntz) AS n").select(
        minute_text(F.col("t")), minute_text(F.col("n"))).first()
    assert tuple(row) == ("2010-12-01 08:05:00", None)


def test_upper_case_of_sharp_s(spark):
    # Java's rule, two letters; the feeds' own text has none.
    assert spark.range(1).select(F.upper(F.lit("stra\xdfe"))).first()[0] == "STRASSE"


def test_spark_submit(tmp_path):
    import pyspark

    submit = [os.path.join(os.path.dirname(pyspark.__file__), "bin", "spark-submit"), "--master", "local[2]",
              "--conf", "spark.ui.enabled=false", "--conf", "spark.sql.shuffle.partitions=4",
              os.path.join(ROOT, "run_ledgerline.py")]
    env = os.environ | {"PYSPARK_PYTHON": sys.executable, "PYSPARK_DRIVER_PYTHON": sys.executable, "PYTHONPATH": ROOT}
    landing, warehouse = str(tmp_path / "landing"), str(tmp_path / "wh")
    for args in (["derive", "--sf-dir", SF_SMALL, "--landing", landing], ["run", "--landing", landing, "--warehouse", warehouse]):
        done = subprocess.run(submit + args, env=env, capture_output=True, text=True, timeout=600)
        assert done.returncode == 0, done.stderr[-2000:]
    assert "staging.stg_transactions_unified" in done.stdout
