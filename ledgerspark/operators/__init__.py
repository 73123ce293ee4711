from .balance import all_present, daily_balances, key_totals, ledger_sum, running_balance
from .calendar import (
    carry_forward_rows,
    date_gap,
    date_spans,
    densify_calendar,
    distinct_items_per_day,
    expand_seen_so_far,
    extend_to_group_end,
    last_date,
)
from .flows import flag_first_seen, signed_flows, split_two_way
from .mapping import map_dictionary, net_of
from .shape import (
    classify_stacked,
    forward_fill,
    fill_from_headers,
    forward_fill_steps,
    outline_flatten,
    skip_preamble,
    with_file_identity,
)
from .statement import (
    pivot_indicators,
    profit_base,
    profit_cascade,
    profit_lines,
    profit_unpivot,
    spread_to_group_dates,
)
from .tidy import (
    fill_defaults,
    rejected_cells,
    filter_account,
    nonzero_movements,
    override_cash,
    profile_counts,
    recode,
    rejects,
    union_components,
    union_with_origin,
)

__all__ = [
    "all_present",
    "carry_forward_rows",
    "classify_stacked",
    "daily_balances",
    "date_gap",
    "date_spans",
    "densify_calendar",
    "distinct_items_per_day",
    "expand_seen_so_far",
    "extend_to_group_end",
    "fill_defaults",
    "rejected_cells",
    "rejects",
    "filter_account",
    "flag_first_seen",
    "forward_fill",
    "fill_from_headers",
    "forward_fill_steps",
    "key_totals",
    "last_date",
    "ledger_sum",
    "map_dictionary",
    "net_of",
    "nonzero_movements",
    "outline_flatten",
    "override_cash",
    "pivot_indicators",
    "profile_counts",
    "profit_base",
    "profit_cascade",
    "profit_lines",
    "profit_unpivot",
    "recode",
    "running_balance",
    "signed_flows",
    "skip_preamble",
    "split_two_way",
    "spread_to_group_dates",
    "union_components",
    "union_with_origin",
    "with_file_identity",
]
