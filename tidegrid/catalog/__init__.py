"""Registered queries; importing the modules fills the registry."""

from __future__ import annotations

from tidegrid.catalog import base, events, flows, grids, quality, summaries, whole


def queries() -> dict:
    return dict(base.QUERIES)


def oracle_sql() -> dict:
    return dict(base.ORACLE)
