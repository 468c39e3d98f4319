"""Scalar expressions: text folding, rating casts, path lineage, report parsing."""

from tessera.functions.paths import app_from_path, segment_from_path, source_path
from tessera.functions.ratings import rating_as_int, rating_is_malformed, truncate_rating
from tessera.functions.report import parse_kv_lines, report_lines
from tessera.functions.text import fold_accents, fold_upper

__all__ = [
    "app_from_path", "segment_from_path", "source_path",
    "rating_as_int", "rating_is_malformed", "truncate_rating",
    "parse_kv_lines", "report_lines",
    "fold_accents", "fold_upper",
]
