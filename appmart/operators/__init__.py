"""Generic DataFrame operators the mart's tables are composed from."""

from appmart.operators.aggregates import (count_rows, distinct_row_count, distinct_rows,
                                          group_avg, row_stats, union_distinct)
from appmart.operators.joins import (broadcast_if_small, fits, join_coalesce_fallback,
                                     join_coalesced_key, join_on, join_spread, lookup_left,
                                     semi_lookup)
from appmart.operators.projection import conform, project, rename, stamp
from appmart.operators.quality import fk_orphans, pk_duplicates

__all__ = [
    "broadcast_if_small", "conform", "count_rows", "distinct_row_count", "distinct_rows",
    "fits", "fk_orphans", "group_avg", "join_coalesce_fallback", "join_coalesced_key",
    "join_on", "join_spread", "lookup_left", "pk_duplicates", "project", "rename", "row_stats",
    "semi_lookup", "stamp", "union_distinct",
]
