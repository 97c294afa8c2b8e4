"""What a Python worker remembers about pieces of text, bounded in bytes."""

from __future__ import annotations

#: Bytes that an entry takes beside its key and value, about.
ENTRY_BYTES = 170


class Memory:
    """A dict of two generations: when the young one is full it becomes the old one.

    An entry found in the old generation is copied into the young one, so frequent entries stay and
    rare ones go. Both together take about `most_bytes`. Values are bytes.
    """

    def __init__(self, most_bytes: int):
        self.most = most_bytes // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def find(self, keys: list[str]) -> list[bytes | None]:
        """The value of each key, None for a key that is not known."""
        found = list(map(self.young.get, keys))
        if self.old and None in found:
            get = self.old.get
            for i, value in enumerate(found):
                if value is None:
                    value = get(keys[i])
                    if value is not None:
                        found[i] = value
                        self._put(keys[i], value)
        return found

    def add(self, entries: dict[str, bytes]) -> None:
        for key, value in entries.items():
            self._put(key, value)

    def _put(self, key: str, value: bytes) -> None:
        if key not in self.young:
            self.size += ENTRY_BYTES + len(key) + len(value)
            self.young[key] = value

    def age(self) -> None:
        """Call between texts: ends a full generation."""
        if self.size > self.most:
            self.old, self.young, self.size = self.young, {}, 0
