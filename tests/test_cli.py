"""Command line: derive -> run -> check -> query, in-process on the test session."""

import json

import pytest

from ledgerline.__main__ import main
from data_dirs import SF_SMALL


@pytest.fixture(scope="module")
def cli_run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("cli")
    landing, wh = str(base / "landing"), str(base / "wh")
    main(["derive", "--sf-dir", SF_SMALL, "--landing", landing])
    return base, wh


def test_cli_run_and_check(spark, cli_run, capsys):
    base, _ = cli_run
    wh = str(base / "wh2")
    capsys.readouterr()
    main(["run", "--landing", str(base / "landing"), "--warehouse", wh])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["row_counts"]["staging.stg_transactions_unified"] == 5803
    assert sorted(map(tuple, report["load_counters"])) == [("ecommerce_data", 3584, 42), ("online_retail_ii", 3006, 33)]
    with pytest.raises(SystemExit) as done:
        main(["check", "--warehouse", wh])
    assert done.value.code == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"checks": 58, "failing": []}

    out = str(base / "q4")
    main(["query", "--warehouse", wh, "--name", "q4_country_share", "--out", out])
    assert spark.read.option("header", True).csv(out).count() == 25
    main(["query", "--warehouse", wh, "--name", "q2_category_returns", "--rows", "3"])
    assert "porcentaje_devolucion" in capsys.readouterr().out
