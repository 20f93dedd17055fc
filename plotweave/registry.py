"""Every survey query by name, with its SQL twin."""

from __future__ import annotations

from importlib import import_module

from .plans.registering import QUERIES, TWINS

for _name in ("plots", "flights", "photos", "surfaces", "views_and_fits", "streams"):
    import_module(f".plans.{_name}", __package__)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(TWINS)
