"""Registry of named queries: Spark plan + optional DuckDB twin.

Each case reads the driver tables (or fixtures derived from them) under
``sf_dir``. Every double column of the Spark result is rounded to 6 dp; the
twin rounds the columns listed in ``doubles`` the same way.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Case:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    doubles: tuple[str, ...] = field(default_factory=tuple)


CASES: dict[str, Case] = {}


def case(name: str, sql: str | None = None, doubles: tuple[str, ...] | list[str] = ()):
    def deco(fn):
        if name in CASES:
            raise ValueError(f"duplicate case {name}")
        CASES[name] = Case(name, fn, sql, tuple(doubles))
        return fn

    return deco


def r6(c):
    """Round half up to 6 dp with plain IEEE steps (floor(x*1e6+0.5)/1e6), so
    both engines agree bit for bit, including exact decimal halves."""
    x = c.cast("double")
    return F.when(F.isnan(x) | (F.abs(x) >= 1e12), x).otherwise(F.floor(x * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6))


def round_doubles(df: DataFrame, dp: int = 6) -> DataFrame:
    sel = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            sel.append(r6(F.col(f"`{f.name}`")).alias(f.name))
        else:
            sel.append(F.col(f"`{f.name}`"))
    return df.select(*sel)


def wrap_sql(c: Case) -> str:
    if not c.doubles:
        return c.sql
    rep = ", ".join(
        f'(case when isnan(cast("{d}" as double)) or abs(cast("{d}" as double)) >= 1e12 then cast("{d}" as double) '
        f'else floor(cast("{d}" as double) * cast(1000000.0 as double) + cast(0.5 as double)) / cast(1000000.0 as double) end) as "{d}"'
        for d in c.doubles
    )
    return f"select * replace ({rep}) from (\n{c.sql}\n) _q"


def load_all() -> dict[str, Case]:
    from . import (  # noqa: F401
        cases_attribution,
        cases_baseline,
        cases_calibration,
        cases_data,
        cases_drift,
        cases_fairness,
        cases_io,
        cases_metrics,
        cases_profile,
        cases_split,
        cases_uncertainty,
    )

    return CASES
