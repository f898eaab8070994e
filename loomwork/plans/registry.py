"""Register a query together with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
_AREAS = ("shop", "market", "books", "transactions", "scoring", "texts", "vectors", "live")


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable columns: doubles rounded (no negative zero), whole numbers as BIGINT."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            column = F.round(column.cast("double"), digits) + F.lit(0.0)
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        out.append(column.alias(field.name))
    return df.select(*out)


def register(name: str, sql: str | None = None, digits: int = 6):
    """Decorator: ``fn(spark, folder)`` becomes query ``name``, checked by ``sql`` if given."""

    def keep(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return tidy(fn(spark, folder), digits)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return keep


def select_sql(ctes: str, source: str, keys: str = "", reals: str = "", counts: str = "", digits: int = 6,
               tail: str = "") -> str:
    """Final SELECT of an oracle: keys as they are, reals rounded, counts as BIGINT."""
    items = [k for k in keys.split()]
    items += [f"round(CAST({r} AS DOUBLE), {digits}) + 0.0 AS {r}" for r in reals.split()]
    items += [f"CAST({c} AS BIGINT) AS {c}" for c in counts.split()]
    head = f"WITH {ctes.strip().rstrip(',')}\n" if ctes.strip() else ""
    return f"{head}SELECT {', '.join(items)} FROM {source} {tail}".strip()


def _load() -> None:
    for area in _AREAS:
        import_module(f"loomwork.plans.{area}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
