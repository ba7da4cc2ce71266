"""Queries over the shared test tables, each beside the SQL that must give the same rows."""

from checks import files, grouped, people, places, text, trips
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "files", "grouped", "people", "places", "text", "trips"]
