"""Registered queries over the test tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from tarnworks.plans import features, files, games, graphs, ranking, rates, series, shapes, texts

FAMILIES = (graphs, texts, rates, series, ranking, features, games, shapes, files)


def registered() -> dict:
    """Name -> (query function, SQL text or None)."""
    found: dict = {}
    for family in FAMILIES:
        found |= family.QUERIES
    return found
