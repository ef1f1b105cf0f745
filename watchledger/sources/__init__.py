from watchledger.sources.seeds import SEED_COLUMNS, read_csv_seed, select_renamed
from watchledger.sources.tables import (
    full_refresh,
    materialize_table,
    materialize_view,
    table_ref,
)

__all__ = [
    "SEED_COLUMNS",
    "full_refresh",
    "materialize_table",
    "materialize_view",
    "read_csv_seed",
    "select_renamed",
    "table_ref",
]
