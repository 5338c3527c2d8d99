"""Relational operators on DataFrames."""

from .aggregates import (  # noqa: F401
    WINDOWS,
    Kpi,
    Metric,
    any_value_of,
    best_by_distinct_count,
    count_if,
    debit_credit_net,
    densify,
    kpi_block,
    rolling_kpis,
    signed_sum,
    sum_if,
    text_list,
    top_list_by,
    value_set,
    weighted_sum,
)
from .asof import as_of_join  # noqa: F401
from .bitmaps import distinct_count, distinct_state, merge_states, roll_up  # noqa: F401
from .joins import (  # noqa: F401
    decode,
    interval_join,
    lookup,
    lookup_first,
    month_range_join,
    semi_or,
    side_by_side,
    snapshot_join,
    with_top_row,
)
from .lineage import settle  # noqa: F401
from .partials import advance, drop_months, merge_partials, monthly_partials, rolling_from_partials  # noqa: F401
from .ranks import median_of, value_ranks, with_mean_rank, with_rank, with_rank_share, with_standing  # noqa: F401
from .sets import net_of, stack, stack_distinct, stack_tagged, unfold_distinct  # noqa: F401
from .skew import heavy_keys, split_join  # noqa: F401
from .spine import densify_months, densify_within, month_calendar  # noqa: F401
from .windows import (  # noqa: F401
    first_by,
    first_ties_by,
    latest_by,
    top_n_by,
    with_first_flag,
    with_group_extremes,
)
