"""DataFrame -> DataFrame operators."""

from layercake.operators.asof import asof_left
from layercake.operators.joins import enrich_left
from layercake.operators.keys import dense_key
from layercake.operators.ordering import Sort, asc, desc
from layercake.operators.quality import check_rules, duplicate_keys
from layercake.operators.validity import current_only, keep_latest, validity_end

__all__ = [
    "Sort",
    "asc",
    "asof_left",
    "check_rules",
    "current_only",
    "dense_key",
    "desc",
    "duplicate_keys",
    "enrich_left",
    "keep_latest",
    "validity_end",
]
