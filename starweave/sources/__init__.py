from starweave.sources.csv import read_csv, read_csv_once, rejected_rows, schema_by_name
from starweave.sources.staged import read_stage, stage_path

__all__ = ["read_csv", "read_csv_once", "read_stage", "rejected_rows", "schema_by_name", "stage_path"]
