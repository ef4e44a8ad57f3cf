"""Score arithmetic shared by the recommenders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from revue.fixed import ALS_WEIGHT, CONTENT_WEIGHT, NEUTRAL_RATING, RATING_HALF_RANGE


def preference_weight(rating: str | Column) -> Column:
    """Map a 1..5 rating to [-1, 1]: (rating - 3) / 2."""
    r = F.col(rating) if isinstance(rating, str) else rating
    return (r - F.lit(NEUTRAL_RATING)) / F.lit(RATING_HALF_RANGE)


def similarity_from_sq_distance(sq_distance: Column, digits: int = 6) -> Column:
    """1 - euclidean distance, rounded so that rank ties are engine independent."""
    return F.round(F.lit(1.0) - F.sqrt(F.greatest(F.lit(0.0), sq_distance)), digits)


def blend(als_score: Column, content_score: Column,
          als_weight: float = ALS_WEIGHT, content_weight: float = CONTENT_WEIGHT) -> Column:
    """Weighted sum of the two legs (missing leg counts as 0)."""
    return (F.coalesce(als_score, F.lit(0.0)) * F.lit(float(als_weight))
            + F.coalesce(content_score, F.lit(0.0)) * F.lit(float(content_weight)))
