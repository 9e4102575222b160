"""Driver query catalogue: importing this package registers every query."""

from relforge.plans import (diff_queries, history_queries, publish_queries, quality_queries,  # noqa: F401
                             refdata_queries, export_queries)
from relforge.plans.registry import ORACLE, QUERIES
from relforge.sources.fixtures import oracle_with


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: oracle_with(v) for k, v in ORACLE.items()}
