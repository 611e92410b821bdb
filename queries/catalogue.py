"""Importing this module registers every query."""

from queries import aggregates, basics, claims, joins, membership, models, premium, scalars, wide, windows  # noqa: F401
from queries.registry import SPARK, SQL  # noqa: F401
