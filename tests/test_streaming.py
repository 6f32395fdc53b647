"""Streaming landing-zone ingest: equals the batch load, survives a restart."""

import os

from ledgerline.operators import ingest
from ledgerline.sources.feeds import ECOMMERCE
from ledgerline.streaming.landing_ingest import read_streamed_raw, run_feed_ingest_once

HEADER_A = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"


def _drop(folder, name, rows):
    with open(os.path.join(folder, name), "w", encoding="latin-1") as f:
        f.write("\n".join([HEADER_A] + rows) + "\n")


def test_stream_ingest_incremental(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    _drop(landing, "day1.csv", ["1,A,X,1,12/1/2010 8:00,1.00,5,France",
                                "2,B,Y,1,12/1/2010 8:00,0,5,France"])          # rejected
    raw = run_feed_ingest_once(spark, str(landing), out, ECOMMERCE, checkpoint=ckpt)
    assert sorted(r.invoice_no for r in raw.collect()) == ["1"]

    # A restart with the same checkpoint only picks up the new file.
    _drop(landing, "day2.csv", ["3,C,Z,2,12/2/2010 9:00,2.00,,Spain"])
    run_feed_ingest_once(spark, str(landing), out, ECOMMERCE, checkpoint=ckpt)
    raw = read_streamed_raw(spark, out, ECOMMERCE)
    rows = {r.invoice_no: r for r in raw.collect()}
    assert sorted(rows) == ["1", "3"]
    assert rows["3"].customer_id == ""
    rejects = spark.read.parquet(os.path.join(out, "raw", "rejected_records")).collect()
    assert [r.invoice_no for r in rejects] == ["2"]

    # Same rows as the batch path over both files.
    batch = ingest.raw_rows(ingest.flag_rejects(ingest.feed_cells(
        spark.read.option("header", True).option("encoding", "ISO-8859-1").csv(str(landing)), ECOMMERCE),
        ECOMMERCE), ECOMMERCE)
    cols = list(ECOMMERCE.raw_columns)
    assert sorted(map(tuple, batch.select(cols).collect())) == sorted(map(tuple, raw.select(cols).collect()))


def test_pipeline_over_streamed_feeds(spark, tmp_path):
    """The batch pipeline over what the streams loaded equals that over the files."""
    from ledgerline.plans.pipeline import open_warehouse, run
    from ledgerline.sources.feeds import ONLINE_RETAIL
    from ledgerline.sources.landing import read_landed
    from ledgerline.streaming.landing_ingest import streamed_feeds

    landing = tmp_path / "landing"
    for spec, rows in ((ECOMMERCE, ["1,A,X,1,12/1/2010 8:00,1.00,5,France", "2,B,NA,1,12/1/2010 8:00,0,5,France"]),
                       (ONLINE_RETAIL, ["3,A,X,2,2010-12-01 08:00:00,1.00,,Spain"])):
        (landing / spec.name).mkdir(parents=True)
        (landing / spec.name / "day1.csv").write_text("\n".join([",".join(spec.headers), *rows]) + "\n")
        run_feed_ingest_once(spark, str(landing / spec.name), str(tmp_path / "out"), spec,
                             checkpoint=str(tmp_path / "ckpt" / spec.name))
    results = []
    for feeds, root in ((streamed_feeds(spark, str(tmp_path / "out")), "streamed"), (read_landed(spark, str(landing)), "batch")):
        report = run(spark, feeds, str(tmp_path / root))
        wh = open_warehouse(spark, str(tmp_path / root))
        results.append((sorted(report.counters), *(
            sorted(map(str, wh.table(t).drop("_loaded_at", "rejected_at").collect()))
            for t in ("raw.ecommerce_data", "raw.online_retail_ii", "raw.rejected_records", "marts.mart_revenue_producto"))))
    assert results[0] == results[1]
    assert results[0][0] == [(ECOMMERCE.name, 1, 1), (ONLINE_RETAIL.name, 1, 0)]
