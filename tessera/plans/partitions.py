"""Which shards are scanned together, and whether they may be scanned apart."""

from __future__ import annotations

from dataclasses import dataclass

from ..errors import InvalidArgumentError

# The strategies under which a document is in exactly one shard.
DISJOINT = ("hash", "community-compat", "enterprise-compat")


@dataclass(frozen=True)
class Sharding:
    shards: tuple[str, ...]
    strategy: str | None = "hash"
    smart_join: str | None = None


def obstacle(s: Sharding | None) -> str | None:
    """Why shards must not be scanned apart; None where they may. What is not known counts against it."""
    if s is None:
        return "the sharding is not known"
    against = {
        f"there are {len(s.shards)} shards": len(s.shards) < 2,
        f"the attribute {s.smart_join} joins it to another collection": s.smart_join is not None,
        f"strategy {s.strategy} is not known to be disjoint": s.strategy not in DISJOINT,
    }
    return next((why for why, holds in against.items() if holds), None)


def eligible(s: Sharding | None) -> bool:
    return obstacle(s) is None


def group_shards(shards: list[str], per_split: int, most: int) -> list[list[str]]:
    """Consecutive groups, as many as per_split asks for but not more than most; sizes differ by one at most."""
    if per_split < 1 or most < 1:
        raise InvalidArgumentError("groups need at least one shard and one split")
    if not shards:
        return [[]]
    n = min(-(-len(shards) // per_split), most)
    cuts = [len(shards) // n * k + min(k, len(shards) % n) for k in range(n + 1)]
    return [shards[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def counts_agree(total: int, parts: list[int]) -> bool:
    """Whether counts of groups prove that shards can be read apart: they add up, and some group has less than all."""
    return sum(parts) == total and (total == 0 or any(p < total for p in parts))
