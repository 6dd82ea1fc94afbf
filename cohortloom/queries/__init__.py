"""Demo queries, one per operator; importing this package fills the registry."""
from cohortloom.queries.base import ORACLES, QUERIES
from cohortloom.queries import scalars, projections, targets, joins, profiles, ranks, cleaning, evaluation, screening, learning  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
