"""Named queries over the domain views, each with the SQL that states its expected result."""

from catalogue.registry import REGISTRY

from catalogue import (  # noqa: F401  (imported for registration)
    aggregates, cleaning, extraction, joins, reports, scoring, statistics, stores, training, windows,
)

__all__ = ["REGISTRY"]
