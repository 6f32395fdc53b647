"""Hand-written feeds (invented values) through the whole pipeline.

Each row proves one rule: quarantine, tolerant parsing, cross-feed and
within-feed de-duplication, canonical descriptions, categories, the
returns-only mart row, CSV quoting and latin-1 decoding.
"""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.quality import DataQualityError
from ledgerline.plans import business
from ledgerline.plans.pipeline import open_warehouse, run
from ledgerline.sources.landing import read_landed

HEADER_A = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
ROWS_A = [
    "500001,20001,WHITE HANGING HEART T-LIGHT HOLDER,6,12/1/2010 8:26,2.55,17850,United Kingdom",
    "500002,20002,ZERO PRICE SALE,2,12/1/2010 9:00,0.00,17850,United Kingdom",            # rejected
    "c500003,20001,WHITE HANGING HEART T-LIGHT HOLDER,-2,12/2/2010 10:00,0,17850,United Kingdom",  # kept: C invoice
    "500004,20003,PRICE ABC,1,12/2/2010 10:00,abc,12345,France",                         # raw only
    '500005,20004,"Comma, ""quoted"" bag",3,12/3/2010 11:00,"1,234.50",12345,France',   # quoting, comma price
    "500006,20005,NEG PRICE,1,12/3/2010 11:00,-1,12345,France",                          # rejected
    "500007,20006,EXP PRICE,1,12/3/2010 11:00,1e-3,12345,France",                        # raw only (null price)
    "500008,20007,NEG INF,1,12/3/2010 11:00,-inf,12345,France",                          # rejected
    "500009,20008,NAN PRICE,1,12/3/2010 11:00,nan,12345,France",                         # raw only
    "500010,20009,QTY DOT ZERO,6.0,12/4/2010 12:00,1.00,12345,France",                   # qty 6
    "500011,20009,QTY HALF,6.5,12/4/2010 12:00,1.00,12345,France",                       # qty null
    "500012,20009,QTY PLUS,+6,12/4/2010 12:00,1.00,12345,France",                        # qty null
    "500013,20010,BAD DATE,1,13/45/2010 8:00,1.00,12345,France",                         # date null
    "500014, 85 123a ,\tcafé   lamp  ,2,12/5/2010 9:15,3.00,,Germany",                   # code, desc, guest
    "500015,20011,SAME LINE,4,12/6/2010 10:30,2.00,NA,Germany",                          # A copy wins
    "500016,20012,DUP IN A,5,12/7/2010 11:00,1.00,777,Spain",
    "500016,20012,DUP IN A,3,12/7/2010 11:00,1.00,777,Spain",                            # smaller qty kept
    "500017,20013,TIE AA,1,12/8/2010 9:00,1.00,777,Spain",
    "500018,20013,TIE B,1,12/8/2010 9:00,1.00,777,Spain",                                # longer wins? equal -> 'TIE AA'
    "C500019,20014,ONLY RETURNS CLOCK,-3,12/9/2010 9:00,4.00,777,Spain",                 # returns-only product/day
    "500020,20015,POSITIVE C,2,12/9/2010 9:00,5.00,777,Spain",
    "500021,20019,,1,12/9/2010 9:00,2.00,777,Spain",                                     # only description ''
    "500022,20020,NEG QTY NO C,-2,12/9/2010 9:00,5.00,777,Spain",                        # non-C return
]
HEADER_B = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"
ROWS_B = [
    "500015,20011,SAME LINE,9,2010-12-06 10:30:45,2.00,999,Germany",                     # loses to feed A
    "600001,20016,LUNCH BAG RED,2,2010-12-10 08:00:00,1.65,13085,United Kingdom",
    "600002,20017,POSTAGE,1,2010-12-10 08:00:00,0,13085,United Kingdom",                 # rejected
    "C600003,20016,LUNCH BAG RED,-1,2010-12-10 09:00:00,1.65,13085,United Kingdom",
    "C600004,20018,VENTA ZERO PRICE,2,2010-12-11 09:00:00,0,13085,United Kingdom",       # dims only, no fact
]


@pytest.fixture(scope="module")
def fixture_run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("fixture")
    landing = base / "landing"
    (landing / "ecommerce_data").mkdir(parents=True)
    (landing / "online_retail_ii").mkdir(parents=True)
    (landing / "ecommerce_data" / "part-0.csv").write_bytes(
        ("\n".join([HEADER_A] + ROWS_A) + "\n").encode("latin-1"))
    (landing / "online_retail_ii" / "part-0.csv").write_bytes(
        ("\n".join([HEADER_B] + ROWS_B) + "\n").encode("utf-8"))
    root = str(base / "warehouse")
    report = run(spark, read_landed(spark, str(landing)), root)
    return report, open_warehouse(spark, root)


def test_quarantine_counts(fixture_run):
    report, wh = fixture_run
    assert sorted(report.counters) == [("ecommerce_data", 20, 3), ("online_retail_ii", 4, 1)]
    rej = {r.invoice_no: r for r in wh.rejected_records.collect()}
    assert set(rej) == {"500002", "500006", "500008", "600002"}
    assert rej["500002"].rejection_reason == "unit_price <= 0 en una venta"
    assert rej["600002"].rejection_reason == "price <= 0 en una venta"
    assert rej["500002"].raw_row == (
        '{"invoice_no": "500002", "stock_code": "20002", "description": "ZERO PRICE SALE", "quantity": "2", '
        '"invoice_date": "12/1/2010 9:00", "unit_price": "0.00", "customer_id": "17850", '
        '"country": "United Kingdom"}')


def test_check_results_written(spark, fixture_run):
    report, wh = fixture_run
    assert "quality.check_results" in report.seconds
    part_file = wh.table("marts.dim_pais").inputFiles()[0].replace("file:", "")
    root = os.path.dirname(os.path.dirname(os.path.dirname(part_file)))
    res = spark.read.parquet(os.path.join(root, "quality", "check_results"))
    by_check = {r.check_name: r["count"] for r in res.groupBy("check_name").count().collect()}
    assert by_check == {"not_null": 36, "unique": 11, "accepted_values": 3, "relationships": 8}
    assert res.filter("failures > 0").count() == 0


def test_raw_keeps_text_and_quoting(fixture_run):
    _, wh = fixture_run
    raw = {r.invoice_no: r for r in wh.table("raw.ecommerce_data").collect()}
    assert raw["500005"].description == 'Comma, "quoted" bag'
    assert raw["500005"].unit_price == "1,234.50"
    assert raw["500014"].description == "\tcafé   lamp  "
    assert raw["500014"].customer_id == ""
    assert raw["500015"].customer_id == ""          # NA token -> ''
    assert raw["500007"].unit_price == "1e-3"


def test_unified_rules(fixture_run):
    _, wh = fixture_run
    u = wh.unified.collect()
    by_inv = {}
    for r in u:
        by_inv.setdefault(r.invoice_no, []).append(r)
    for gone in ("500004", "500007", "500009", "500011", "500012", "500013"):
        assert gone not in by_inv
    assert by_inv["500005"][0].unit_price == Decimal("1234.5000")
    assert by_inv["500010"][0].quantity == 6
    r14 = by_inv["500014"][0]
    # Only spaces are trimmed; the leading tab collapses to one space.
    assert (r14.stock_code, r14.description, r14.customer_id) == ("85123A", " CAFÉ LAMP", "GUEST")
    same = by_inv["500015"]
    assert len(same) == 1 and same[0].source_file == "ecommerce_data" and same[0].quantity == 4
    dup = by_inv["500016"]
    assert len(dup) == 1 and dup[0].quantity == 3
    assert by_inv["C500003"][0].transaction_type == "DEVOLUCION"
    assert by_inv["500020"][0].transaction_type == "VENTA"
    assert len({r.transaction_key for r in u}) == len(u)


def test_dimensions_and_facts(fixture_run):
    _, wh = fixture_run
    prod = {r.codigo_producto: r for r in wh.dim_producto.collect()}
    assert prod["20001"].categoria == "Iluminacion"        # HEART ... LIGHT: first rule wins
    assert prod["20004"].categoria == "Accesorios"
    assert prod["20013"].nombre_canonico == "TIE AA"       # equal frequency: longer wins
    assert prod["20014"].categoria == "Hogar"
    assert "20018" in prod                                 # C-invoice VENTA at price 0 feeds dims
    assert (prod["20019"].nombre_canonico, prod["20019"].categoria) == ("", "General")  # '' is a description
    fv = {r.invoice_no for r in wh.fact_ventas.collect()}
    fd = {r.invoice_no for r in wh.fact_devoluciones.collect()}
    assert "C600004" not in fv and "C600004" not in fd
    assert "500020" in fv and "C500003" in fd
    assert "500022" in fd and "500022" not in fv            # quantity <= 0 without a C prefix
    cust = {r.customer_id: r.es_cliente_identificado for r in wh.dim_cliente.collect()}
    assert cust["GUEST"] is False and cust["17850"] is True
    assert wh.dim_tiempo.filter(F.col("tiempo_key") == "2010-12-01").first().nombre_mes == "December"


def test_returns_only_mart_row(fixture_run):
    _, wh = fixture_run
    row = wh.mart_revenue_producto.filter(F.col("codigo_producto") == "20014").collect()
    assert len(row) == 1
    r = row[0]
    assert (r.cantidad_vendida, r.num_facturas, r.cantidad_devuelta) == (0, 0, 3)
    assert r.revenue_neto == Decimal("-12.0000")
    assert r.tasa_devolucion == 0 and r.ticket_promedio == 0


def test_business_queries_run(fixture_run):
    _, wh = fixture_run
    q1 = business.q1_monthly_net_sales(wh).collect()
    assert [r.anio_mes for r in q1] == ["2010-12"]
    q5 = {r.es_cliente_identificado: r for r in business.q5_guest_vs_identified(wh).collect()}
    assert q5[False].num_facturas == 2            # blank and 'NA' customers are both GUEST
    counts = {r.tabla: r.registros for r in business.v1_layer_counts(wh).collect()}
    assert counts["raw.rejected_records"] == 4


def test_blank_country_fails_fk_gate(spark, tmp_path):
    landing = tmp_path / "landing"
    (landing / "ecommerce_data").mkdir(parents=True)
    (landing / "online_retail_ii").mkdir(parents=True)
    (landing / "ecommerce_data" / "a.csv").write_text(
        HEADER_A + "\n700001,30001,BLANK COUNTRY,1,12/1/2010 8:00,1.00,1,\n", encoding="latin-1")
    (landing / "online_retail_ii" / "b.csv").write_text(
        HEADER_B + "\n700002,30002,OK,1,2010-12-01 08:00:00,1.00,1,France\n", encoding="utf-8")
    with pytest.raises(DataQualityError):
        run(spark, read_landed(spark, str(landing)), str(tmp_path / "wh"))


def test_missing_header_loads_as_empty(spark, tmp_path):
    landing = tmp_path / "landing"
    (landing / "ecommerce_data").mkdir(parents=True)
    (landing / "online_retail_ii").mkdir(parents=True)
    (landing / "ecommerce_data" / "a.csv").write_text(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,Country\n"
        "800001,40001,NO CUSTOMER COLUMN,1,12/1/2010 8:00,1.00,France\n", encoding="latin-1")
    (landing / "online_retail_ii" / "b.csv").write_text(HEADER_B + "\n", encoding="utf-8")
    report = run(spark, read_landed(spark, str(landing)), str(tmp_path / "wh"))
    wh = open_warehouse(spark, str(tmp_path / "wh"))
    assert wh.table("raw.ecommerce_data").first().customer_id == ""
    assert wh.unified.first().customer_id == "GUEST"
    assert ("online_retail_ii", 0, 0) in report.counters


def test_rerun_is_identical(spark, tmp_path):
    landing = tmp_path / "landing"
    (landing / "ecommerce_data").mkdir(parents=True)
    (landing / "online_retail_ii").mkdir(parents=True)
    (landing / "ecommerce_data" / "a.csv").write_text("\n".join([HEADER_A] + ROWS_A) + "\n", encoding="latin-1")
    (landing / "online_retail_ii" / "b.csv").write_text("\n".join([HEADER_B] + ROWS_B) + "\n", encoding="utf-8")
    root = str(tmp_path / "wh")
    snaps = []
    for _ in range(2):
        run(spark, read_landed(spark, str(landing)), root)
        wh = open_warehouse(spark, root)
        snaps.append({n: sorted(map(tuple, wh.table(n).drop(*[c for c in wh.table(n).columns
                                                               if c in ("_loaded_at", "rejected_at")]).collect()),
                                key=repr)
                      for n in ("raw.rejected_records", "staging.stg_transactions_unified",
                                "marts.dim_producto", "marts.mart_revenue_producto")})
    assert snaps[0] == snaps[1]


def test_failed_run_is_not_published(spark, tmp_path):
    from ledgerline.sources.runs import completed_runs

    def land(name, a_rows):
        landing = tmp_path / name
        (landing / "ecommerce_data").mkdir(parents=True)
        (landing / "online_retail_ii").mkdir(parents=True)
        (landing / "ecommerce_data" / "a.csv").write_text("\n".join([HEADER_A] + a_rows) + "\n", encoding="latin-1")
        (landing / "online_retail_ii" / "b.csv").write_text(HEADER_B + "\n", encoding="utf-8")
        return str(landing)

    wh_root = str(tmp_path / "wh")
    good = run(spark, read_landed(spark, land("good", ["1,A,X,1,12/1/2010 8:00,1.00,5,France"])), wh_root)
    with pytest.raises(DataQualityError):
        run(spark, read_landed(spark, land("bad", ["2,B,Y,1,12/1/2010 8:00,1.00,5,"])), wh_root)
    assert completed_runs(spark, wh_root) == [good.run_id]
    wh = open_warehouse(spark, wh_root)
    assert [r.invoice_no for r in wh.unified.collect()] == ["1"]


def test_reordered_columns_load_by_name(spark, tmp_path):
    folder = tmp_path / "ecommerce_data"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER_A + "\n1,A,X,1,12/1/2010 8:00,1.00,5,France\n", encoding="latin-1")
    swapped = "StockCode,InvoiceNo,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
    (folder / "b.csv").write_text(swapped + "\nB,2,Y,1,12/1/2010 8:00,1.00,5,France\n", encoding="latin-1")
    from ledgerline.sources.csv_feed import read_feed_csv
    from ledgerline.sources.feeds import ECOMMERCE
    got = read_feed_csv(spark, str(folder), ECOMMERCE).select("InvoiceNo", "StockCode", "Description").collect()
    assert sorted(map(tuple, got)) == [("1", "A", "X"), ("2", "B", "Y")]
