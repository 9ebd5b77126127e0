"""Registration of a query together with its SQL form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatt.session import configure

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, **types: str):
    """Register fn(spark, sf_dir); types cast result columns of the SQL form."""

    def register(fn):
        def run(spark, sf_dir):
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in types.items())
            SQL[name] = f"SELECT * REPLACE ({casts}) FROM ({sql}) AS _q" if casts else sql
        return fn

    return register


def r4(c: str | Column) -> Column:
    """Rounding that hides the last digits, where the order of additions shows."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col + 1e-9, 4)


def rounded(df, *columns: str):
    return df.withColumns({c: r4(c) for c in columns})


def sql4(expr: str, name: str | None = None) -> str:
    return f"round(({expr}) + 1e-9, 4) AS {name or expr}"


_FRAMES: dict = {}


def table(spark, sf_dir: str, name: str):
    """A given table; its listing and schema are read once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _FRAMES:
        _FRAMES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _FRAMES[key]
