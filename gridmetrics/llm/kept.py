"""What a Python worker remembers between texts."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

#: Results for longer strings are not kept.
LONGEST_KEPT = 64


class Kept(dict):
    """Results of a function by string, at most twice ``most``; the newer ones and those used again stay."""

    def __init__(self, work: Callable[[str], Any], most: int) -> None:
        super().__init__()
        self.work, self.most, self.older = work, most, {}

    def __missing__(self, text: str) -> Any:
        result = self.older.get(text)
        if result is None:
            result = self.work(text)
        if len(text) <= LONGEST_KEPT:
            self.keep(text, result)
        return result

    def keep(self, text: str, result: Any) -> None:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[text] = result
