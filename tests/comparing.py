"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import datetime
import decimal
import math


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return float(f"{float(value):.9g}")
    if isinstance(value, (list, tuple)):
        return str([cell(v) for v in value])
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(repr(tuple(cell(r[n]) for n in names)) for r in df.collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, sorted(repr(tuple(cell(r[i]) for i in at)) for r in cursor.fetchall())
