from lanewise.sources.schemas import TABLES, conform, require_columns
from lanewise.sources.tables import read, read_checked, read_table, stage, stage_all, write

__all__ = ["TABLES", "conform", "read", "read_checked", "read_table", "require_columns", "stage", "stage_all", "write"]
