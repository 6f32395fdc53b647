"""SQL access: layers as catalog tables, staging and questions as views."""

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import catalog
from ledgerline.plans.catalog import register_questions, register_staging, register_tables
from ledgerline.plans.pipeline import open_warehouse, run
from ledgerline.sources.feeds import ECOMMERCE, FEEDS, ONLINE_RETAIL

LINES = {
    ECOMMERCE.name: [("1", "A", "RED BAG", "2", "12/1/2010 8:00", "1.50", "7", "France"),
                     ("2", "B", "TIN", "1", "12/1/2010 9:00", "0", "7", "France")],
    ONLINE_RETAIL.name: [("3", "A", "RED BAG", "4", "2010-12-02 08:00:00", "1.50", None, "Spain")],
}


def _feeds(spark, lines=LINES):
    return {f.name: spark.createDataFrame(lines[f.name], ", ".join(f"`{h}` string" for h in f.headers)) for f in FEEDS}


@pytest.fixture
def database_cleanup(spark):
    yield
    for db in ("raw", "staging", "marts", "quality", catalog.RUNS):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_catalog_follows_the_newest_run(spark, tmp_path, database_cleanup):
    root = str(tmp_path / "o'clock")  # a path with an apostrophe
    run(spark, _feeds(spark), root)
    names = register_tables(spark, root)
    assert spark.table("raw.ecommerce_data").count() == 1
    assert [r.source_table for r in spark.table("raw.rejected_records").collect()] == [ECOMMERCE.name]

    more = {**LINES, ECOMMERCE.name: LINES[ECOMMERCE.name][:1] * 1 + [
        ("4", "C", "MUG", "1", "12/3/2010 8:00", "2.00", "7", "France")]}
    run(spark, _feeds(spark, more), root)
    register_tables(spark, root)
    wh = open_warehouse(spark, root)
    for name in names:
        if name != "quality.check_results":
            assert spark.table(name).count() == wh.table(name).count(), name
    assert spark.table("raw.rejected_records").count() == 0
    assert spark.table("raw.ecommerce_data").count() == 2

    assert register_staging(spark, root) == ["stg_ecommerce", "stg_online_retail"]
    assert {r.stock_code for r in spark.sql("SELECT stock_code FROM stg_ecommerce").collect()} == {"A", "C"}
    register_questions(spark, root)
    assert spark.sql("SELECT * FROM q4_country_share").count() == 2


def test_all_layers_change_with_the_pointer(spark, tmp_path, database_cleanup):
    root = str(tmp_path / "wh")
    first = run(spark, _feeds(spark), root).run_id
    register_tables(spark, root)
    more = {**LINES, ECOMMERCE.name: LINES[ECOMMERCE.name] + [("4", "C", "MUG", "1", "12/3/2010 8:00", "2.00", "7", "France")]}
    second = run(spark, _feeds(spark, more), root).run_id

    def counts():
        return tuple(spark.sql("""SELECT (SELECT count(*) FROM raw.ecommerce_data), (SELECT count(*) FROM staging.stg_ecommerce),
            (SELECT count(*) FROM staging.stg_transactions_unified), (SELECT count(*) FROM marts.fact_ventas)""").first())

    assert counts() == (1, 1, 2, 2)
    catalog._add_run(spark, root, second, catalog.LAYER_TABLES)  # between the two steps of a registration
    assert counts() == (1, 1, 2, 2) and catalog.current_run(spark, root) == first
    views = {n: spark.sql(f"SHOW CREATE TABLE {n}").first()[0] for n in catalog.LAYER_TABLES}
    catalog._move_pointer(spark, root, second)
    assert counts() == (2, 2, 3, 3) and catalog.current_run(spark, root) == second
    register_tables(spark, root, run_id=first)                   # and back
    assert counts() == (1, 1, 2, 2)
    assert views == {n: spark.sql(f"SHOW CREATE TABLE {n}").first()[0] for n in catalog.LAYER_TABLES}
    for db in ("raw", "staging", "marts", "quality", catalog.RUNS):
        assert "/runs/" not in spark.sql(f"DESCRIBE DATABASE {db}").where("info_name = 'Location'").first().info_value
    # only the shown run's files are listed
    plan = spark.table("marts.fact_ventas")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan and "Subquery" in plan


def test_staging_views_state_the_same_rules(spark, tmp_path, database_cleanup):
    lines = {ECOMMERCE.name: [(" c1 ", "a\\b", "it's  a\tbag", "2.0", "12/1/2010 8:00", "1,50", " ", "fran\\'ce"), ("2", " ", "x", "1", "x", "1", "1", "y"),
                              ("3", "B", None, "two", "13/45/2010 8:00", "9", "7", None)],
             ONLINE_RETAIL.name: [("4", "D", "q", "-3", "2010-12-01 08:00:60", "1.5", "8", "Spain"), ("5", "D", "q", "-3", "2010-12-01 08:00:59", "1.5", "8", "Spain")]}
    root = str(tmp_path)
    run(spark, _feeds(spark, lines), root, gates=False)
    register_tables(spark, root)
    wh = open_warehouse(spark, root)
    for name in catalog.STAGING_VIEWS:
        view, frame = spark.table(name), wh.table(name)
        assert [(f.name, f.dataType) for f in view.schema] == [(f.name, f.dataType) for f in frame.schema]
        assert sorted(map(str, view.collect())) == sorted(map(str, frame.collect())) and view.count() > 0


def test_retention_spares_readers(spark, tmp_path, database_cleanup):
    import os

    from ledgerline.sources.retention import lease_run, live_leases, sweep_scratch
    from ledgerline.sources.runs import RETIRED, completed_runs, new_run_id, run_dir

    root = str(tmp_path)
    ids = [run(spark, _feeds(spark), root).run_id for _ in range(2)]
    reader = open_warehouse(spark, root, ids[0])
    other = open_warehouse(spark, root, ids[0])
    ids += [run(spark, _feeds(spark), root).run_id for _ in range(2)]
    register_tables(spark, root, run_id=ids[1])
    os.makedirs(run_dir(root, "20200101T000000000000Z-abc"))  # a run that failed long ago
    young = new_run_id()
    os.makedirs(run_dir(root, young))                          # one that is writing now
    done = catalog.retain_runs(spark, root, keep=1)
    assert done.held == [ids[0]] and sorted(done.removed) == ["20200101T000000000000Z-abc", ids[2]]
    assert completed_runs(spark, root) == [ids[0], ids[1], ids[3]] and os.path.isdir(run_dir(root, young))
    assert reader.fact_ventas.count() == 2 and not os.path.exists(os.path.join(run_dir(root, ids[0]), RETIRED))
    reader.lease.release(spark)
    assert catalog.retain_runs(spark, root, keep=1).held == [ids[0]]
    other.lease.release(spark)
    assert catalog.retain_runs(spark, root, keep=1).removed == [ids[0]]
    assert spark.table("marts.fact_ventas").count() == 2        # the run that the views show
    with pytest.raises(ValueError):
        catalog.retain_runs(spark, root, keep=0)
    # a reader that comes while a run is being removed steps back; a lease that has run out counts no more
    open(os.path.join(run_dir(root, ids[3]), RETIRED), "w").close()
    assert lease_run(spark, run_dir(root, ids[3])) is None
    with pytest.raises(FileNotFoundError, match="being removed"):
        open_warehouse(spark, root, ids[3])
    os.remove(os.path.join(run_dir(root, ids[3]), RETIRED))
    assert lease_run(spark, run_dir(root, ids[3]), hours=-1) is not None and live_leases(spark, run_dir(root, ids[3])) == 0
    assert sweep_scratch(spark, 24) == []


def test_reloading_one_feed(spark, tmp_path, database_cleanup):
    import os

    from ledgerline.sources.manifest import raw_files, runs_used
    from ledgerline.sources.runs import run_dir
    from ledgerline.sources.sinks import read_table

    root = str(tmp_path)
    lines = {**LINES, ONLINE_RETAIL.name: LINES[ONLINE_RETAIL.name] + [("9", "Z", "MUG", "1", "2010-12-02 08:00:00", "0", None, "Spain")]}
    first = run(spark, _feeds(spark, lines), root).run_id
    more = {ECOMMERCE.name: [("4", "C", "MUG", "1", "12/3/2010 8:00", "2.00", "7", "France"), ("5", "C", "MUG", "1", "12/3/2010 8:00", "-2", "7", "France")]}
    feeds = lambda rows: {n: df for n, df in _feeds(spark, {**LINES, **rows}).items() if n in rows}
    report = run(spark, feeds(more), root)
    assert report.counters == [(ECOMMERCE.name, 1, 1)]
    second = run_dir(root, report.run_id)
    assert os.listdir(os.path.join(second, "raw")) and not os.path.exists(os.path.join(second, "raw", ONLINE_RETAIL.name))
    rejects = lambda r: sorted((x.source_table, x.invoice_no) for x in read_table(spark, r, "raw.rejected_records").collect())
    assert rejects(second) == [(ECOMMERCE.name, "5"), (ONLINE_RETAIL.name, "9")]
    assert rejects(run_dir(root, first)) == [(ECOMMERCE.name, "2"), (ONLINE_RETAIL.name, "9")]
    # as if both feeds had been loaded
    whole = run(spark, _feeds(spark, {**lines, **more}), str(tmp_path / "whole")).run_dir
    for name in ("raw.online_retail_ii", "raw.ecommerce_data", "staging.stg_transactions_unified", "marts.mart_revenue_producto"):
        drop = lambda r: sorted(map(str, read_table(spark, r, name).drop("_loaded_at").collect()))  # noqa: B023, E731
        assert drop(second) == drop(whole), name
    # a reload over a reload names the run that wrote the files
    third = run(spark, feeds({ECOMMERCE.name: LINES[ECOMMERCE.name]}), root)
    assert runs_used(spark, third.run_dir) == {first}
    assert raw_files(spark, third.run_dir)["raw.online_retail_ii", ONLINE_RETAIL.name].startswith(run_dir(root, first))
    register_tables(spark, root)
    assert spark.table("raw.online_retail_ii").count() == 1 and spark.table("raw.rejected_records").count() == 2
    # retention leaves the files that the newest run uses
    done = catalog.retain_runs(spark, root, keep=1)
    assert done.removed == [report.run_id] and open_warehouse(spark, root).unified.count() == 2
    with pytest.raises(FileNotFoundError):
        run(spark, feeds({ECOMMERCE.name: LINES[ECOMMERCE.name]}), str(tmp_path / "nothing"))


def test_scratch_sweep(spark):
    import os
    import time

    from ledgerline.session import ensure_checkpoint_dir
    from ledgerline.sources.retention import sweep_scratch

    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    for name in ("old", "new"):
        os.makedirs(os.path.join(base, "csv_splits", f"sweep-{name}", "part"))
    for path in (f"{base}/csv_splits/sweep-old", f"{base}/csv_splits/sweep-old/part"):
        os.utime(path, (time.time() - 90_000,) * 2)
    assert [os.path.basename(p) for p in sweep_scratch(spark, 24)] == ["sweep-old"]
    assert os.path.isdir(f"{base}/csv_splits/sweep-new")


def test_raw_load_reads_a_feed_once_and_replaces_its_rejects(spark, tmp_path):
    from ledgerline.plans.pipeline import RunReport, load_raw
    from ledgerline.sources.sinks import read_table

    root = str(tmp_path)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    feeds = {name: df.mapInPandas(count, df.schema) for name, df in _feeds(spark).items()}
    report = RunReport()
    load_raw(spark, feeds, root, report)
    assert report.counters == [(ECOMMERCE.name, 1, 1), (ONLINE_RETAIL.name, 1, 0)]
    assert seen.value == 3
    rejects = lambda: sorted((r.source_table, r.invoice_no) for r in read_table(spark, root, "raw.rejected_records").collect())
    assert rejects() == [(ECOMMERCE.name, "2")]

    # feed A has no rejects any more, feed B only has a reject
    again = {ECOMMERCE.name: LINES[ECOMMERCE.name][:1],
             ONLINE_RETAIL.name: [("9", "A", None, "4", "2010-12-02 08:00:00", "-1", None, "Spain")]}
    load_raw(spark, _feeds(spark, again), root, RunReport())
    assert rejects() == [(ONLINE_RETAIL.name, "9")]
    assert read_table(spark, root, "raw.online_retail_ii").count() == 0
    row = read_table(spark, root, "raw.rejected_records").first()
    assert '"description": null' in row.raw_row


def test_empty_feeds(spark, tmp_path):
    from ledgerline.plans.pipeline import RunReport, load_raw
    from ledgerline.sources.sinks import read_table

    feeds = {name: df.where(F.lit(False)) for name, df in _feeds(spark).items()}
    load_raw(spark, feeds, str(tmp_path), RunReport())
    for name in ("raw.ecommerce_data", "raw.online_retail_ii", "raw.rejected_records"):
        assert read_table(spark, str(tmp_path), name).count() == 0
