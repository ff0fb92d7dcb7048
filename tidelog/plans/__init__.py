"""The registered queries over the star-schema tables, each with its SQL check where SQL can say it."""

from tidelog.plans import (  # noqa: F401  (importing registers the queries)
    aggregates,
    changes,
    columns,
    documents,
    functions,
    joins,
    sinks,
    sources,
    streams,
    user_functions,
    windows,
)
from tidelog.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
