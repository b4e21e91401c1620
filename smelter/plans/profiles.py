"""The two ways to build the warehouse."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    """Choices in which the production and the CI build differ.

    ``lowest_cost`` is the lowest valid product cost and ``default_cost`` stands in for what lies under it or is NULL.
    The gate checks against the same floor, so a build cannot fail on its own repairs.
    """

    name: str
    lowest_cost: int
    default_cost: int
    latest_products_only: bool
    label_product_lines: bool
    sales_per_product_version: bool


PRODUCTION = Profile("production", 0, 0, True, True, False)
CI = Profile("ci", 1, 1, False, False, True)
PROFILES = {p.name: p for p in (PRODUCTION, CI)}
