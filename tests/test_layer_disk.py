"""What building the layers leaves on the disk and sends between tasks."""

import datetime as dt
from glob import glob

import pytest
from pyspark.sql import functions as F

from data_dirs import SF_SMALL
from ledgerline.functions.keys import pack_key, unpack_key
from ledgerline.functions.timestamps import minute_number, minute_text
from ledgerline.operators import mart, staging
from ledgerline.plans import registry
from ledgerline.sources.derived_feed import order_lines
from ledgerline.sources.feeds import ECOMMERCE, ONLINE_RETAIL
from ledgerline.sources.sinks import DROP_SHUFFLES_CONF, setting


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffled_bytes(spark) -> int:
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
    total = 0
    while files.hasNext():
        f = files.next()
        if f.getName().startswith("shuffle_"):
            total += f.length()
    return total


def test_layers_leave_no_shuffle_files(spark, monkeypatch, no_broadcast):
    monkeypatch.setattr(registry, "_MADE", {})
    setting, before = spark.conf.get(DROP_SHUFFLES_CONF), shuffled_bytes(spark)
    wh = registry.warehouse(spark, SF_SMALL)
    assert wh.mart_revenue_producto.schema
    assert shuffled_bytes(spark) <= before
    assert spark.conf.get(DROP_SHUFFLES_CONF) == setting


def test_raw_tables_are_written_by_zstd(spark):
    wh = registry.warehouse(spark, SF_SMALL)
    assert wh.raw(ECOMMERCE).count() > 0 and wh.rejected_records.count() > 0
    files = glob(f"{wh._root.removeprefix('file:')}/raw/**/*.parquet", recursive=True)
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def exchanges(df) -> list[str]:
    """The planned exchanges of ``df``, each with its columns."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]


def test_lines_go_through_two_joins(spark, no_broadcast):
    got = exchanges(order_lines(spark, SF_SMALL))
    assert sum("l_orderkey" in x for x in got) == sum("l_partkey" in x for x in got) == 1
    plan = order_lines(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    customers = next(i for i, x in enumerate(plan) if "Join Inner, (o_custkey" in x)
    assert not any("l_orderkey" in x for x in plan[customers:])


def test_dedupe_shuffles_what_it_cannot_tell(spark):
    wh = registry.warehouse(spark, SF_SMALL)
    staged = [(wh.staged(f), f.priority) for f in (ECOMMERCE, ONLINE_RETAIL)]
    plan = staging.unified_transactions(staged)._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("Window ", 1)[1]
    assert not any(c in below for c in ("dedupe_minute", "AS transaction_type", "AS source_file"))
    whole = staging.transaction_key(staging.dedupe_transactions(staging.tag_sources(staged), require=staging.REQUIRED_COLUMNS))
    columns = [c for c in staging.UNIFIED_COLUMNS if c != "revenue_bruto"]
    got = staging.unified_transactions(staged).select(*columns)
    assert got.exceptAll(whole.select(*columns)).count() == whole.select(*columns).exceptAll(got).count() == 0


def test_minutes_as_numbers(spark):
    times = [dt.datetime(1969, 12, 31, 23, 59, 59), dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 1, 0, 0, 59, 999_999),
             dt.datetime(2010, 3, 28, 2, 30), dt.datetime(1, 1, 1, 0, 1), None]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    got = df.select(minute_number(F.col("t")), minute_text(F.col("t"))).collect()
    assert [g[0] for g in got[:3]] == [-1, 0, 0] and got[-1] == (None, None)
    assert len({g[0] for g in got}) == len({g[1] for g in got}) == 5


def test_packed_keys(spark):
    texts = [None, "", "0", "0a", "0A", "a", "P", "ñandú", "00", "0" * 31, "0" * 32, "d41d8cd98f00b204e9800998ecf8427e",
             "D41D8CD98F00B204E9800998ECF8427E", "\x00", "\x01", "ab\x01", "g" * 32]
    df = spark.createDataFrame([(t,) for t in texts], "k string").select("k", pack_key(F.col("k")).alias("p"))
    got = df.select("k", "p", unpack_key(F.col("p")).alias("back")).collect()
    assert [g.back for g in got] == texts
    assert len({None if g.p is None else bytes(g.p) for g in got}) == len(texts)
    assert len(got[11].p) == 17


def test_digests_are_shuffled_as_bytes(spark):
    wh = registry.warehouse(spark, SF_SMALL)
    sales = mart.sales_by_day(mart.byte_keys(wh.fact_ventas))
    assert dict(sales.dtypes)["producto_key"] == dict(sales.dtypes)["pais_key"] == "binary"
    got, plain = mart.text_keys(sales), mart.sales_by_day(wh.fact_ventas)
    assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0


def facts(spark, keys, lines):
    """``lines`` sales and as many returns; a third of each is on one key."""
    rows = spark.range(lines).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % keys).alias("k"), F.col("id")).select(
        F.md5(F.col("k").cast("string")).alias("producto_key"), F.concat(F.lit("2010-12-0"), F.col("k") % 7 + 1).alias("tiempo_key"),
        F.when(F.col("k") % 50 != 1, F.md5((F.col("k") % 5).cast("string"))).alias("pais_key"),
        (F.col("id") % 700).cast("string").alias("invoice_no"), F.lit(2).alias("cantidad"), F.lit(1).alias("cantidad_devuelta"),
        F.lit(1.5).cast("decimal(29,4)").alias("revenue_bruto"), F.lit(0.5).cast("decimal(29,4)").alias("revenue_devolucion"))
    return rows.repartition(8), rows.where(F.substring("producto_key", 1, 1) < "c").repartition(8)


@pytest.mark.parametrize("light, some_heavy", [(100_000, False), (1, True)])
def test_merge_by_light_and_heavy_keys(spark, monkeypatch, light, some_heavy):
    monkeypatch.setattr(mart, "LIGHT_LINES", light)
    sold, returned = facts(spark, 400, 6000)
    heavy = mart.heavy_buckets(sold)
    assert bool(heavy) == some_heavy and len(heavy) < int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = mart.sales_returns_merge(mart.sales_by_day(sold), mart.returns_by_day(returned))
    for got in (mart.merged_by_day(sold, returned), mart.merged_by_day(sold, returned, heavy)):
        got = mart.text_keys(got)
        assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0
    own = [x for x in exchanges(mart.merged_by_day(sold, returned, heavy)) if "RoundRobin" not in x]
    # light keys: the sales once, the returns once; heavy ones, one task's work too much: by invoice too
    assert len(own) == (5 if some_heavy else 2) and sum("invoice_no" in x for x in own) == some_heavy


@pytest.mark.parametrize("light, some_heavy", [(100_000, False), (1, True)])
def test_many_products_are_merged_where_their_lines_are(spark, tmp_path, monkeypatch, no_broadcast, light, some_heavy):
    monkeypatch.setattr(mart, "LIGHT_LINES", light)
    sold, returned = facts(spark, 400, 6000)
    names = sold.select("producto_key").union(returned.select("producto_key")).distinct().select(
        "producto_key", F.col("producto_key").alias("codigo_producto"), F.lit("N").alias("nombre_canonico"), F.lit("C").alias("categoria"))
    tables = {}
    for name, df in {"sold": sold, "returned": returned, "names": names.where(F.substring("producto_key", 2, 1) != "0")}.items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    sold, returned, names = tables["sold"], tables["returned"], tables["names"]
    plain = mart.sales_returns_merge(mart.sales_by_day(sold), mart.returns_by_day(returned)).join(names, "producto_key")
    with setting(spark, mart.CO_PARTITION_CONF, "false"):
        got = mart.merged_by_product(sold, returned, names)
        own = exchanges(got)
        got.write.parquet(str(tmp_path / "got"))
    got = mart.text_keys(spark.read.parquet(str(tmp_path / "got"))).select(*plain.columns)
    assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0 and got.count() > 0
    assert sum("invoice_no" in x for x in own) == some_heavy
    if not some_heavy:  # both facts by product, and the products for each
        assert len(own) == 4 and not any("tiempo_key" in x for x in own)
