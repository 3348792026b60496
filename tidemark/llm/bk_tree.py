"""Search within a Hamming distance."""


class BKTree:
    """Integers under Hamming distance."""

    def __init__(self):
        self._values: list[int] = []
        self._children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at, new = 0, len(self._values)
        if new:
            while True:
                step = (self._values[at] ^ value).bit_count()
                if step == 0:
                    return
                child = self._children[at].setdefault(step, new)
                if child == new:
                    break
                at = child
        self._values.append(value)
        self._children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        found, todo = [], [0] if self._values else []
        while todo:
            at = todo.pop()
            away = (self._values[at] ^ value).bit_count()
            if away <= radius:
                found.append(self._values[at])
            for step, child in self._children[at].items():
                if away - radius <= step <= away + radius:
                    todo.append(child)
        return found
