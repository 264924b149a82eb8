"""A bounded memory of what a tokenizers-library tokenizer gives for a unit
of text (a stretch that the tokenizer treats on its own wherever it stands).

Units come from whole texts; unseen ones go to the library in one call per
text. Two generations of at most ``capacity / 2`` units each bound the memory;
a unit in use moves to the young generation.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from tokenizers import Tokenizer

LONGEST = 96   # characters of a unit that is remembered


class Memo:
    def __init__(self, tokenizer: Tokenizer, value: Callable[[Sequence[int]], object], capacity: int = 600_000):
        self.tokenizer, self.value, self.half = tokenizer, value, capacity // 2
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def values(self, units: list[str]) -> list:
        """What the library gives for each unit, in order."""
        out = self._values(units, self._encode)
        if len(self.young) > self.half:
            self.old, self.young = self.young, {}
        return out

    def _values(self, units: list[str], encode: Callable[[list[str]], Iterable[Sequence[int]]]) -> list:
        young = self.young
        new = set(units).difference(young)
        if not new:
            return list(map(young.__getitem__, units))
        local = {u: v for u in new if (v := self.old.get(u)) is not None}
        unseen = list(new.difference(local)) if local else list(new)
        if unseen:
            local.update(zip(unseen, map(self.value, encode(unseen))))
        young.update(local)
        out = list(map(young.__getitem__, units))
        for u in unseen:
            if len(u) > LONGEST:
                young.pop(u, None)
        return out

    def _encode(self, units: list[str]) -> list[Sequence[int]]:
        ids: list[list[int]] = [[] for _ in units]
        e = self.tokenizer.encode(units, is_pretokenized=True, add_special_tokens=False)
        for i, w in zip(e.ids, e.word_ids):
            ids[w].append(i)
        return ids
