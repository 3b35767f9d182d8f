"""Engine settings, from keyword arguments or from text properties."""

from __future__ import annotations

import re
from dataclasses import dataclass, fields

from .errors import InvalidArgumentError

_UNITS = {"ms": 0.001, "s": 1, "m": 60, "h": 3600, "d": 86400}


@dataclass(frozen=True)
class EngineConfig:
    """root: a folder of databases, each a folder of collections, for Engine.discover(). aggregation_pushdown_enabled is
    accepted and changes nothing: partial aggregation beside the scan is Spark's own."""

    root: str | None = None
    schema_sample_size: int = 1000
    schema_sample_random: bool = False
    schema_mixed_type_strategy: str = "VARCHAR"
    schema_cache_ttl: float = 300
    type_coercion: str = "LENIENT"
    shards_per_split: int = 1
    max_splits: int = 32
    shard_parallelism_enabled: bool = True
    aggregation_pushdown_enabled: bool = True
    query_function_enabled: bool = True
    statistics_enabled: bool = True
    statistics_cache_ttl: float = 300
    schema_collection: str = "schema_overrides"

    def __post_init__(self):
        for name in ("schema_sample_size", "shards_per_split", "max_splits"):
            if getattr(self, name) < 1:
                raise InvalidArgumentError(f"{name} must be at least 1")
        for name in ("schema_cache_ttl", "statistics_cache_ttl"):
            if getattr(self, name) < 0:
                raise InvalidArgumentError(f"{name} must not be negative")
        for name, allowed in (("type_coercion", ("LENIENT", "STRICT")), ("schema_mixed_type_strategy", ("VARCHAR", "JSON"))):
            if getattr(self, name) not in allowed:
                raise InvalidArgumentError(f"{name} must be one of {', '.join(allowed)}")

    @property
    def strict(self) -> bool:
        return self.type_coercion == "STRICT"

    @staticmethod
    def from_properties(properties: dict[str, str]) -> EngineConfig:
        """Keys like "schema.sample-size"; unknown keys are refused. Durations are like "5m"."""
        known, given = {f.name: f for f in fields(EngineConfig)}, {}
        for key, value in properties.items():
            name = re.sub(r"[.-]", "_", key)
            if name not in known:
                raise InvalidArgumentError(f"unknown property {key}")
            kind = str(known[name].type)
            try:
                if kind == "bool":
                    given[name] = {"true": True, "false": False}[value.lower()]
                elif kind == "float":
                    n, unit = re.fullmatch(r"([0-9.]+)\s*(ms|[smhd])", value).groups()
                    given[name] = float(n) * _UNITS[unit]
                elif kind == "int":
                    given[name] = int(value)
                else:
                    given[name] = value.upper() if name in ("type_coercion", "schema_mixed_type_strategy") else value
            except (KeyError, ValueError, AttributeError) as e:
                raise InvalidArgumentError(f"{key} cannot be {value!r}") from e
        return EngineConfig(**given)
