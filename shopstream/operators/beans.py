"""Column-set operations on rows: scalar-only projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.functions.timefn import ntz_to_epoch_ms

_ATOMIC = (T.StringType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType,
           T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def select_scalar_columns(df: DataFrame) -> DataFrame:
    """Keep only scalar columns; nested structs, arrays and maps are dropped.
    Dates and timestamps become epoch milliseconds at second precision
    (dates at midnight UTC), as the reference's copier stores them."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, _ATOMIC):
            cols.append(c)
        elif isinstance(f.dataType, T.DateType):
            cols.append((F.unix_date(c).cast("bigint") * F.lit(86_400_000)).alias(f.name))
        elif isinstance(f.dataType, T.TimestampNTZType):
            cols.append((F.floor(ntz_to_epoch_ms(c) / 1000) * 1000).cast("bigint").alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            cols.append((F.unix_seconds(c) * 1000).alias(f.name))
    return df.select(*cols)
