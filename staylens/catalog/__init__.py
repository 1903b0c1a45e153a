"""The query catalog: importing this package registers every query."""

from staylens.catalog import certificates, jobs, metrics, models, registry, relational, sampling, statistics, text
from staylens.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "certificates", "jobs", "metrics", "models", "registry", "relational", "sampling", "statistics", "text"]
