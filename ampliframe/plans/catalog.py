"""All registered queries and the SQL that checks them."""

from __future__ import annotations

from functools import wraps

from ampliframe.plans import file_queries, qc_queries, read_queries, sequence_queries
from ampliframe.plans.fixtures import with_views
from ampliframe.session import ship_package

MODULES = (qc_queries, sequence_queries, file_queries, read_queries)


def _shipped(query):
    """The query, after making the package importable in the session's workers."""

    @wraps(query)
    def run(spark, sf_dir):
        return query(ship_package(spark), sf_dir)

    return run


QUERIES = {name: _shipped(f) for m in MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: with_views(sql) for m in MODULES for name, sql in m.ORACLES.items()}
