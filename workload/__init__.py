"""Registered queries over the supplied tables, each with its SQL counterpart."""

from workload import catalogs, conversions, relational, scripts

QUERIES = {**relational.QUERIES, **conversions.QUERIES, **catalogs.QUERIES, **scripts.QUERIES}
ORACLES = {**relational.ORACLES, **conversions.ORACLES, **catalogs.ORACLES, **scripts.ORACLES}
