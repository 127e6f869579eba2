"""Registered queries: operators applied to the tables, each with equivalent SQL where SQL can express it."""

from pulsegrid.plans import audit, catalogue, devices, files, models, more, places, quality, signals, stats, stretches, validation, waves  # noqa: F401
from pulsegrid.plans.registry import QUERIES, SQL  # noqa: F401
