"""Column expressions shared by the operators."""

from larder.functions.predicates import all_of, any_of, is_blank, matches, matches_any
from larder.functions.values import blank_to, clean_text, first_match, minutes_or, ratio, sentinel

__all__ = [
    "all_of",
    "any_of",
    "blank_to",
    "clean_text",
    "first_match",
    "is_blank",
    "matches",
    "matches_any",
    "minutes_or",
    "ratio",
    "sentinel",
]
