"""A small cache whose entries expire."""

from __future__ import annotations

import time
from collections.abc import Callable, Hashable


class TtlCache:
    """Values by key for ttl seconds; failures are not kept. ttl 0 keeps nothing. clock is a seam for tests."""

    def __init__(self, ttl: float, clock: Callable[[], float] = time.monotonic):
        self.ttl, self.clock, self._held = ttl, clock, {}

    def get(self, key: Hashable, load: Callable[[], object]):
        now = self.clock()
        if key in self._held and now - self._held[key][0] < self.ttl:
            return self._held[key][1]
        value = load()
        if self.ttl > 0:
            self._held[key] = (now, value)
        return value

    def drop(self) -> None:
        self._held.clear()
