"""Registered queries build the layers they read, and no others."""

import os
from glob import glob

import pytest

from data_dirs import SF_SMALL
from ledgerline.plans import registry


@pytest.fixture
def fresh(spark, monkeypatch):
    monkeypatch.setattr(registry, "_MADE", {})
    scratch = os.path.join(spark.sparkContext.getCheckpointDir().removeprefix("file:"), "registry")
    before = set(glob(f"{scratch}/*"))

    def built():
        """Tables written since, by name."""
        return {"/".join(p.split("/")[-3:-1]) if "is_rejected" not in p else "/".join(p.split("/")[-4:-2])
                for root in set(glob(f"{scratch}/*")) - before for p in glob(f"{root}/**/_SUCCESS", recursive=True)
                if "rejected_records" not in p}
    return built


@pytest.mark.parametrize("name, layers", [
    ("q6b_description_variants", {"feeds/ecommerce_data", "raw/ecommerce_data"}),
    ("union_sources", {"feeds/ecommerce_data", "raw/ecommerce_data", "feeds/online_retail_ii", "raw/online_retail_ii"}),
    ("dim_producto", {"feeds/ecommerce_data", "raw/ecommerce_data", "feeds/online_retail_ii", "raw/online_retail_ii",
                      "staging/stg_transactions_unified", "marts/dim_producto"}),
    ("q2_category_returns", {"feeds/ecommerce_data", "raw/ecommerce_data", "feeds/online_retail_ii", "raw/online_retail_ii",
                             "staging/stg_transactions_unified", "marts/dim_producto", "marts/dim_tiempo", "marts/dim_pais",
                             "marts/fact_ventas", "marts/fact_devoluciones", "marts/mart_revenue_producto"}),
])
def test_only_the_layers_a_query_reads(spark, fresh, name, layers):
    assert registry.queries()[name](spark, SF_SMALL).count() > 0
    assert fresh() == layers
