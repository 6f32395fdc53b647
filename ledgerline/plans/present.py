"""Presentation at the output boundary of the registered queries.

Inside the engine money is exact DECIMAL and calendar days are DATE. The
registered outputs are compared with another engine's, so they use the
forms both engines hand to pandas and Arrow identically: decimals become
DOUBLE (correctly rounded from the exact value) and dates become midnight
TIMESTAMP_NTZ. ``as_double`` names integer columns that hold NULL by
design (parser outputs such as an unparseable quantity); pandas turns those
into float64 on one side and a masked integer on the other, so they are
presented as DOUBLE too. Pipeline tables keep their own types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType


def as_output(df: DataFrame, as_double: tuple[str, ...] = ()) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType) or f.name in as_double:
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)
