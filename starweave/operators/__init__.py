from starweave.operators.clean import clean, distinct_rows, distinct_rows_late, drop_null_rows
from starweave.operators.dedup import latest_per_key, one_per_key
from starweave.operators.layout import bucketed, range_sorted, z_ordered
from starweave.operators.quality import (
    Measured,
    check_join_size,
    fanout_report,
    gate,
    gate_measured,
    gate_report,
    join_size,
    key_collisions,
    measured_report,
    null_fractions,
    orphan_keys,
    repeated_keys,
)
from starweave.operators.star import Link, Star, broadcast_if_small, build_dimension, build_fact
from starweave.operators.surrogate import add_surrogate

__all__ = [
    "Link",
    "Measured",
    "Star",
    "add_surrogate",
    "broadcast_if_small",
    "bucketed",
    "build_dimension",
    "build_fact",
    "check_join_size",
    "clean",
    "distinct_rows",
    "distinct_rows_late",
    "drop_null_rows",
    "fanout_report",
    "gate",
    "gate_measured",
    "gate_report",
    "join_size",
    "key_collisions",
    "latest_per_key",
    "measured_report",
    "null_fractions",
    "one_per_key",
    "orphan_keys",
    "range_sorted",
    "repeated_keys",
    "z_ordered",
]
