"""Export typing for registered query results.

Registered queries are compared with a DuckDB oracle through pandas.  The
two engines hand different Python types to pandas for the same SQL type
(DATE -> ``datetime.date`` vs ``Timestamp``, DECIMAL -> ``Decimal`` vs
``float``), so the registered results use export types both agree on:
dates and timestamps as ISO text, decimals as double, the rest unchanged.
The library functions themselves keep the natural types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def export_types(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, T.ArrayType):
            c = F.to_json(c)
        elif isinstance(t, (T.StructType, T.MapType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(cols)
