"""Query catalogue: one Spark builder + one oracle SQL per driver query."""

from __future__ import annotations

from collections import OrderedDict

QUERIES: "OrderedDict[str, object]" = OrderedDict()
ORACLE: "OrderedDict[str, str]" = OrderedDict()


def query(name: str, oracle: str | None = None, iso_dates=()):
    """Register ``fn(spark, sf_dir) -> DataFrame`` (and its DuckDB oracle).

    ``iso_dates``: DATE columns the registered query presents as ``yyyy-MM-dd`` text,
    on both sides, so the comparison does not depend on how each engine converts
    dates for the driver (the operators themselves return DATE).
    """
    def deco(fn):
        if iso_dates:
            from pyspark.sql import functions as F

            def wrapped(spark, sf_dir, _fn=fn):
                df = _fn(spark, sf_dir)
                return df.withColumns({c: F.date_format(F.col(c), "yyyy-MM-dd") for c in iso_dates})
            wrapped.__doc__, wrapped.__name__ = fn.__doc__, fn.__name__
            QUERIES[name] = wrapped
        else:
            QUERIES[name] = fn
        if oracle is not None:
            if iso_dates:
                repl = ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in iso_dates)
                ORACLE[name] = f"SELECT * REPLACE ({repl}) FROM ({oracle}) iso_q"
            else:
                ORACLE[name] = oracle
        return fn
    return deco
