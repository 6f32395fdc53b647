"""ledgerline: retail transaction analytics on Spark.

Two order feeds are ingested as text, quarantined, cleaned, merged with
source-priority de-duplication, shaped into a star schema and a
product/day/country revenue mart, queried, and checked for data quality.
Every step is a DataFrame transformation; see README.md for the layout.

Typical use::

    from ledgerline import build_session, read_landed, run, open_warehouse, business
    spark = build_session()
    run(spark, read_landed(spark, "/data/landing"), "/data/warehouse")
    business.q1_monthly_net_sales(open_warehouse(spark, "/data/warehouse")).show()
"""

from ledgerline.plans import business
from ledgerline.plans.catalog import register_tables
from ledgerline.plans.pipeline import open_warehouse, run
from ledgerline.session import build_session
from ledgerline.sources.landing import read_landed

__version__ = "0.1.0"

__all__ = ["build_session", "read_landed", "run", "open_warehouse", "register_tables", "business"]
