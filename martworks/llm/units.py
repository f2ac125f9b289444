"""Splits of a text at spaces that no token crosses, and a bounded memory of their tokens."""

from __future__ import annotations

import re
from collections.abc import Callable

MEMORY = 250_000


class Memory:
    """What is known of each unit; emptied at ``most`` entries and filled anew."""

    def __init__(
        self,
        work_out: Callable[[list[str]], list],
        start: dict | None = None,
        most: int = MEMORY,
    ):
        self.work_out, self.start, self.most = work_out, dict(start or {}), most
        self.known = dict(self.start)

    def look_up(self, units: list[str]) -> list:
        if len(self.known) > self.most:
            self.known = dict(self.start)
        new = list(set(units).difference(self.known))
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            self.known.update(zip(part, self.work_out(part)))
        return list(map(self.known.__getitem__, units))


#: A space right before something else: it always opens a pre-token of the byte-level
#: pattern, whatever stands before it.
BYTE_LEVEL = re.compile(r" (?=\S)")

#: A run of spaces and what follows up to the next one: no piece has a space inside.
SPACE_LED = re.compile(r" +[^ ]*")
