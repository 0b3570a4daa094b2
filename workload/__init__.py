"""Registered queries: each runs a library operator over the given tables, with its check SQL."""

from workload import drift, evaluation, features, models, registry, rules, streams, timetravel  # noqa: F401
from workload.base import ORACLES, QUERIES  # noqa: F401
