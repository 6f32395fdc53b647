"""Configuration records for the two order feeds.

Both feeds go through one code path; they differ only in the values below.
"""

from __future__ import annotations

from dataclasses import dataclass

# Raw-layer column order shared by both feeds (positions, not names, line up:
# feed B calls the invoice column `invoice` and the price column `price`).
RAW_FIELDS = (
    "invoice",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
)


@dataclass(frozen=True)
class FeedSpec:
    name: str                    # raw table name, also `_source` and `source_file`
    raw_columns: tuple[str, ...]  # raw table column names, in RAW_FIELDS order
    headers: tuple[str, ...]      # CSV header names, in RAW_FIELDS order
    encoding: str
    date_pattern: str            # full-match regex a date text must satisfy
    date_layout: str             # "mdy_hm" or "iso_hms"
    reject_reason: str
    priority: int                # lower wins in cross-source de-duplication

    @property
    def invoice_column(self) -> str:
        return self.raw_columns[0]

    @property
    def price_column(self) -> str:
        return self.raw_columns[5]

    def header_for(self, field: str) -> str:
        return self.headers[RAW_FIELDS.index(field)]

    def raw_for(self, field: str) -> str:
        return self.raw_columns[RAW_FIELDS.index(field)]


# Table names, CSV headers, encodings, date formats, reject
# reasons and priorities of the two feeds, as the original pipeline defines them.
ECOMMERCE = FeedSpec(
    name="ecommerce_data",
    raw_columns=("invoice_no", "stock_code", "description", "quantity",
                 "invoice_date", "unit_price", "customer_id", "country"),
    headers=("InvoiceNo", "StockCode", "Description", "Quantity",
             "InvoiceDate", "UnitPrice", "CustomerID", "Country"),
    encoding="ISO-8859-1",
    date_pattern=r"\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}",
    date_layout="mdy_hm",
    reject_reason="unit_price <= 0 en una venta",
    priority=1,
)

ONLINE_RETAIL = FeedSpec(
    name="online_retail_ii",
    raw_columns=("invoice", "stock_code", "description", "quantity",
                 "invoice_date", "price", "customer_id", "country"),
    headers=("Invoice", "StockCode", "Description", "Quantity",
             "InvoiceDate", "Price", "Customer ID", "Country"),
    encoding="UTF-8",
    date_pattern=r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}",
    date_layout="iso_hms",
    reject_reason="price <= 0 en una venta",
    priority=2,
)

FEEDS = (ECOMMERCE, ONLINE_RETAIL)

# Cell texts that the original CSV reader (pandas defaults)
# turns into missing values, which the raw layer then stores as ''.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)
