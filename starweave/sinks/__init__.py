from starweave.sinks.publish import Edition, adopt, publish, published, read_published
from starweave.sinks.stage import stage, stage_all
from starweave.sinks.warehouse import (
    TableSpec,
    analyze,
    create_tables,
    load,
    load_staged,
    merge_day,
    truncate,
)

__all__ = [
    "Edition",
    "adopt",
    "TableSpec",
    "analyze",
    "create_tables",
    "load",
    "load_staged",
    "merge_day",
    "publish",
    "published",
    "read_published",
    "stage",
    "stage_all",
    "truncate",
]
