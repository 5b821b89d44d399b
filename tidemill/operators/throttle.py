"""Quotas of a model client inside one worker: keys in turn, each with a minute and a day limit."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime


@dataclass
class _Use:
    minute: int = 0
    day: int = 0
    last: datetime | None = None


class KeyPool:
    """Hands out the next key whose quotas admit a request.

    tumbling=True starts a key's minute count anew with each wall-clock minute, else after 60 s without
    a request; day counts start anew with each date.  Where no key is free, the caller waits for the
    next minute and five seconds (tumbling), or 60 s."""

    def __init__(self, keys: Sequence[str], per_minute: int, per_day: int, tumbling: bool = True):
        if not keys:
            raise ValueError("no keys")
        self.keys, self.per_minute, self.per_day, self.tumbling = list(keys), per_minute, per_day, tumbling
        self.uses, self.at = {k: _Use() for k in self.keys}, 0

    def _fresh(self, use: _Use, now: datetime) -> None:
        if use.last is None:
            return
        anew = now.replace(second=0, microsecond=0) != use.last.replace(second=0, microsecond=0) if self.tumbling else (now - use.last).total_seconds() >= 60
        if anew:
            use.minute = 0
        if now.date() != use.last.date():
            use.day = 0

    def take(self, now: datetime) -> str | None:
        """A key for one request now, counted; None if every key is at a limit."""
        for k in range(len(self.keys)):
            key = self.keys[(self.at + k) % len(self.keys)]
            use = self.uses[key]
            self._fresh(use, now)
            if use.minute < self.per_minute and use.day < self.per_day:
                use.minute, use.day, use.last = use.minute + 1, use.day + 1, now
                self.at = (self.at + k) % len(self.keys)
                return key
        return None

    def rotate(self) -> None:
        """After a refusal the next key has its turn."""
        self.at = (self.at + 1) % len(self.keys)

    def wait_seconds(self, now: datetime) -> int:
        return 65 - now.second if self.tumbling else 60

    def acquire(self, clock: Callable[[], datetime] = datetime.now, sleep: Callable[[float], None] = time.sleep) -> str:
        """A key, after waiting if need be; an error once every key has used up its day."""
        while (key := self.take(now := clock())) is None:
            if all(u.day >= self.per_day for u in self.uses.values()):
                raise RuntimeError("all keys have used up their day")
            sleep(self.wait_seconds(now))
        return key

    def usage(self) -> list[tuple[str, int, int]]:
        """(last four characters, requests this minute, this day) of each key."""
        return [(k[-4:], u.minute, u.day) for k, u in self.uses.items()]
