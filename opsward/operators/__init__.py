from .joins import enrich, join_inflation, map_by_table, orphan_counts, orphans, resolve_fk
from .keys import assert_unique, duplicate_keys, exact_dedupe, split_conflicts
from .rollups import sums_by_dimension
from .shares import cumulative_share, exact_percentiles, share_of_total, top_n, top_n_share
from .stacking import count_rules, stack_columns, unpivot_text
from .windows import previous_value

__all__ = [
    "assert_unique", "count_rules", "cumulative_share", "duplicate_keys", "enrich", "exact_dedupe",
    "exact_percentiles", "join_inflation", "map_by_table", "orphan_counts", "orphans",
    "previous_value", "resolve_fk", "share_of_total", "split_conflicts", "stack_columns",
    "sums_by_dimension", "top_n",
    "top_n_share", "unpivot_text",
]
