from .catalog import ColumnInfo, Engine

__all__ = ["ColumnInfo", "Engine"]
