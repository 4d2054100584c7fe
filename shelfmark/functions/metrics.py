"""Derived listing metrics.

``round`` works on the decimal text, half up, so a tie may differ by one last digit from a
binary half-even rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def views_per_month(views: Column, age: Column) -> Column:
    return F.when(age > 0, F.round(views / age, 1))


def engagement_rate(favorites: Column, views: Column) -> Column:
    return F.when(views > 0, F.round(favorites / views, 4))


def competition_score(reviews: Column, monthly_views: Column, digits: int = 2) -> Column:
    """Reviews over the already rounded monthly views."""
    return F.when(monthly_views > 0, F.round(reviews / monthly_views, digits))
