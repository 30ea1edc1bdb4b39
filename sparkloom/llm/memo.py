"""A bounded memo: words of a language repeat, so most lookups end here."""

from __future__ import annotations

from collections.abc import Callable

#: Entries a Python worker keeps, in two halves: when the newer is full it becomes the older, whose
#: entries come back when asked for. So memory stays bounded and frequent words stay.
ENTRIES = 150_000
#: Longer keys are computed each time, so that the entries bound the bytes too.
LONGEST = 64


class Memo(dict):
    def __init__(self, compute: Callable, entries: int = ENTRIES):
        super().__init__()
        self.compute, self.half, self.older = compute, max(1, entries // 2), {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= LONGEST:
            if len(self) >= self.half:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value
