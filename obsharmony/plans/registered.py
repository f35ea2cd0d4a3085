"""Loads every query module and exposes the registry."""

from __future__ import annotations

from . import (  # noqa: F401
    casts,
    coastal_tables,
    cooperative_tables,
    files,
    harmonisation,
    shaping,
    source_tables,
    survey,
    times_and_paths,
)
from .catalog import BUILDERS, ORACLES, Builder


def builders() -> dict[str, Builder]:
    return dict(BUILDERS)


def oracles() -> dict[str, str]:
    return dict(ORACLES)
