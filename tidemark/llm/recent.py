"""A cache of bounded size for what Python tasks meet again and again."""

CACHE_ENTRIES = 300_000


class Recent(dict):
    """A cache of two generations: when the young one is full it becomes the old one.

    Long keys are not kept.
    """

    def __init__(self, make, entries: int = CACHE_ENTRIES):
        super().__init__()
        self._make, self._entries, self._old = make, entries, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if len(self) >= self._entries:
            self._old = dict(self)
            self.clear()
        if isinstance(key, int) or len(key) <= 64:
            self[key] = value
        return value
