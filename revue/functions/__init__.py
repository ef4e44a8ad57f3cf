"""Column expressions (all built-in Spark expressions, no Python workers)."""

from revue.functions.parse import (epoch_to_date, label, normalise_title, parse_helpfulness,
                                   parse_price, parse_rating, tokenize)
from revue.functions.scoring import blend, preference_weight, similarity_from_sq_distance

__all__ = [
    "blend", "epoch_to_date", "label", "normalise_title", "parse_helpfulness", "parse_price",
    "parse_rating", "preference_weight", "similarity_from_sq_distance", "tokenize",
]
