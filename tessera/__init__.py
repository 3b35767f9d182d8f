"""tessera: typed, read-only analytics over schemaless documents, expressed as Spark DataFrames."""

from .config import EngineConfig
from .sources import Engine

__all__ = ["Engine", "EngineConfig"]
