"""All modules that register queries."""

from tidemark.plans import analyses, datasets, inference, platform2, relational, upkeep  # noqa: F401
