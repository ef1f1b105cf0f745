from watchledger.operators.checks import (
    accepted_values,
    null_counts,
    not_null,
    orphans,
    unique,
)
from watchledger.operators.history import scd2_merge
from watchledger.operators.groups import (
    attach,
    group_total,
    rank_in_group,
    ranks_in_group,
    sequence_in_group,
)
from watchledger.operators.keep import keep_top
from watchledger.operators.numbering import number_rows

__all__ = [
    "accepted_values",
    "attach",
    "group_total",
    "keep_top",
    "not_null",
    "null_counts",
    "number_rows",
    "orphans",
    "rank_in_group",
    "ranks_in_group",
    "scd2_merge",
    "sequence_in_group",
    "unique",
]
