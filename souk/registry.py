"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the driver tables through
the domain views and returns the export-typed result (see
``souk.export``).  Parameters that are "now" in the source are fixed
``as_of`` values inside the test data's date range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from souk.export import export_types
from souk.sources import testviews as tv

SINCE = "1995-01-01"
AS_OF = "2001-07-01"

Builder = Callable[[SparkSession, str], DataFrame]
_REG: dict[str, tuple[Builder, Callable[[], str] | None]] = {}


def register(name: str, oracle: Callable[[], str] | None = None):
    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            return export_types(fn(spark, sf_dir))

        build.__name__ = name
        _REG[name] = (build, oracle)
        return fn

    return deco


def queries() -> dict[str, Builder]:
    _load()
    return {k: v[0] for k, v in _REG.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v[1]() for k, v in _REG.items() if v[1] is not None}


_loaded = False


def _load() -> None:
    global _loaded
    if _loaded:
        return
    _loaded = True
    import souk.plans.registered  # noqa: F401  (registers on import)
    import souk.plans.reg_functions  # noqa: F401
    import souk.plans.reg_journey  # noqa: F401
    import souk.plans.reg_orders  # noqa: F401
    import souk.plans.reg_risk  # noqa: F401
    import souk.plans.reg_events  # noqa: F401
    import souk.plans.reg_io  # noqa: F401
