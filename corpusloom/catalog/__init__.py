"""Every operator as a query over the given tables."""

from corpusloom.catalog import groups, rows, scans, whole_jobs  # noqa: F401
from corpusloom.catalog.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
