"""Uniform output form for comparing Spark results with SQL oracles.

Doubles are rounded to 6 digits, timestamps become fixed-width strings,
dates ISO strings and integers BIGINT, on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TS_FORMAT_SPARK = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_FORMAT_DUCKDB = "%Y-%m-%d %H:%M:%S.%f"


def present(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TS_FORMAT_SPARK)
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def sql_present(body: str, doubles: list[str] = (), timestamps: list[str] = (),
                dates: list[str] = (), ints: list[str] = ()) -> str:
    """Wrap a DuckDB query so its columns take the same form as ``present``."""
    repl = [f'round(cast("{c}" AS DOUBLE), 6) AS "{c}"' for c in doubles]
    repl += [f"strftime(\"{c}\", '{TS_FORMAT_DUCKDB}') AS \"{c}\"" for c in timestamps]
    repl += [f'cast("{c}" AS VARCHAR) AS "{c}"' for c in dates]
    repl += [f'cast("{c}" AS BIGINT) AS "{c}"' for c in ints]
    if not repl:
        return f"SELECT * FROM ({body}) AS q"
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM ({body}) AS q"
