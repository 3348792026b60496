"""A hierarchical navigable small-world graph over unit vectors, searched by whole batches."""

import numpy as np

#: Neighbours of a node in the upper layers; twice as many in the lowest.
DEGREE = 16

#: Queries that are searched side by side.
BATCH = 256


class Graph:
    """Vectors in layers: a node of layer ``k`` is in all layers below. Each layer links a node
    with near nodes in different directions; a search walks down from the top, where links
    are long, and keeps a beam of the nearest nodes."""

    def __init__(self, unit: np.ndarray, seed: int = 0, degree: int = DEGREE, beam: int = 48):
        self._unit, self._degree, self._beam = np.ascontiguousarray(unit, dtype=np.float32), degree, beam
        n = len(unit)
        draw = np.random.default_rng(seed).random(n)
        self._level = np.minimum(-np.log(np.maximum(draw, 1e-12)) / np.log(degree), 12).astype(int)
        # Highest first: each layer then grows from its own first nodes.
        order = np.argsort(-self._level, kind="stable")
        self._entry = int(order[0]) if n else -1
        top = int(self._level.max()) if n else 0
        self._links = [np.full((n, 2 * degree if k == 0 else degree), -1, dtype=np.int64) for k in range(top + 1)]
        done = min(1, n)
        while done < n:
            # As many at once as there are already, so that most of the near nodes are in.
            part = order[done : done + max(1, min(done, BATCH))]
            self._insert(part)
            done += len(part)

    def arrays(self) -> dict[str, np.ndarray]:
        """What the graph is made of, beside its vectors."""
        layers = {f"links{k}": layer.astype(np.int32) for k, layer in enumerate(self._links)}
        return {"entry": np.array(self._entry), "level": self._level, **layers}

    @classmethod
    def of(cls, unit: np.ndarray, arrays: dict[str, np.ndarray]) -> "Graph":
        """The graph whose ``arrays`` these are, over the same vectors."""
        graph = cls.__new__(cls)
        graph._unit = np.ascontiguousarray(unit, dtype=np.float32)
        graph._entry, graph._level = int(arrays["entry"]), arrays["level"]
        layers = sum(name.startswith("links") for name in arrays)
        graph._links = [arrays[f"links{k}"].astype(np.int64) for k in range(layers)]
        return graph

    def _insert(self, part: np.ndarray) -> None:
        points = np.full((len(part), 1), self._entry)
        within = self._unit[part] @ self._unit[part].T
        np.fill_diagonal(within, -2)
        for layer in range(len(self._links) - 1, -1, -1):
            inside = self._level[part] >= layer
            width = self._beam if inside.any() else 1
            found, _ = self._layer(self._unit[part], points, layer, width)
            points = found[:, : min(found.shape[1], 4)]
            for k in np.flatnonzero(inside):
                peers = np.flatnonzero(inside & (within[k] > -2))
                near = peers[np.argsort(-within[k, peers])[: self._degree]]
                known = found[k][found[k] >= 0]
                self._connect(int(part[k]), np.concatenate([known, part[near]]), layer)

    def _connect(self, node: int, near: np.ndarray, layer: int) -> None:
        links = self._links[layer]
        chosen = self._spread(node, near[self._level[near] >= layer], links.shape[1] // (2 if layer == 0 else 1))
        # Peers inserted before may have linked it already; a row holds no node twice.
        held = links[node][links[node] >= 0]
        own = np.concatenate([chosen, held[~np.isin(held, chosen)]])[: links.shape[1]]
        links[node] = -1
        links[node, : len(own)] = own
        for other in chosen:
            row = links[other]
            if node in row:
                continue
            free = np.flatnonzero(row < 0)
            if len(free):
                row[free[0]] = node
            else:
                kept = self._spread(int(other), np.append(row, node), len(row))
                row[:] = -1
                row[: len(kept)] = kept

    def _spread(self, node: int, near: np.ndarray, most: int) -> np.ndarray:
        """The nearest nodes, but none that is nearer to one already chosen; then the rest."""
        near = np.unique(near)
        near = near[near != node]
        to = self._unit[near] @ self._unit[node]
        order = np.argsort(-to, kind="stable")[: 4 * most]
        near, to = near[order], to[order]
        between = self._unit[near] @ self._unit[near].T
        chosen, passed = [], []
        for k in range(len(near)):
            if len(chosen) == most:
                break
            (passed if chosen and between[k, chosen].max() > to[k] else chosen).append(k)
        return near[(chosen + passed)[:most]]

    def _layer(self, queries: np.ndarray, points: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Beams of ``width`` nodes, nearest first (-1: none), and their similarities."""
        links, rows = self._links[layer], np.arange(len(queries))[:, None]
        seen = np.zeros((len(queries), len(self._unit) + 1), dtype=bool)
        seen[:, -1] = True
        beam = np.full((len(queries), width), -1, dtype=np.int64)
        near = np.full((len(queries), width), -2, dtype=np.float32)
        start = points[:, :width]
        beam[:, : start.shape[1]] = start
        near[:, : start.shape[1]] = np.where(
            start >= 0, np.einsum("qd,qkd->qk", queries, self._unit[start]), -2
        )
        seen[rows, start] = True
        open_ = beam >= 0
        while True:
            best = np.where(open_, near, -3).argmax(axis=1)
            live = np.flatnonzero(open_[np.arange(len(queries)), best])
            if not len(live):
                break
            open_[live, best[live]] = False
            step = links[beam[live, best[live]]]
            fresh = ~seen[live[:, None], step]
            seen[live[:, None], step] = True
            seen[:, -1] = True
            to = np.where(fresh, np.einsum("qd,qkd->qk", queries[live], self._unit[step]), -2)
            nodes = np.concatenate([beam[live], np.where(fresh, step, -1)], axis=1)
            sims = np.concatenate([near[live], to], axis=1)
            opened = np.concatenate([open_[live], fresh], axis=1)
            top = np.argpartition(-sims, width - 1, axis=1)[:, :width]
            side = np.arange(len(live))[:, None]
            beam[live], near[live], open_[live] = nodes[side, top], sims[side, top], opened[side, top]
        order = np.argsort(-near, axis=1, kind="stable")
        return beam[rows, order], near[rows, order]

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest ``width`` nodes found for each query, and their similarities."""
        n = len(self._unit)
        if n == 0 or len(queries) == 0:
            return np.zeros((len(queries), 0), np.int64), np.zeros((len(queries), 0), np.float32)
        width = min(width, n)
        queries = queries.astype(np.float32)
        if width == n:
            near = queries @ self._unit.T
            order = np.argsort(-near, axis=1)
            return order, np.take_along_axis(near, order, axis=1)
        points = np.full((len(queries), 1), self._entry)
        for layer in range(len(self._links) - 1, 0, -1):
            points, _ = self._layer(queries, points, layer, 4)
        return self._layer(queries, points, 0, width)

    def within(self, queries: np.ndarray, least: float, width: int) -> list[np.ndarray]:
        """For each query the nodes found with a similarity of ``least`` or more. A beam that
        holds nothing else is too narrow: it is widened until it ends in a farther node."""
        out: list = [None] * len(queries)
        todo = np.arange(len(queries))
        while len(todo):
            narrow = []
            # Wider beams for fewer queries at once.
            size = max(1, BATCH * 48 // max(width, 48))
            for k in range(0, len(todo), size):
                part = todo[k : k + size]
                nodes, near = self.search(queries[part], width)
                for row, query in enumerate(part):
                    hit = (near[row] >= least) & (nodes[row] >= 0)
                    if hit.all() and nodes.shape[1] < len(self._unit):
                        narrow.append(query)
                    else:
                        out[query] = nodes[row][hit]
            todo, width = np.array(narrow, dtype=int), 2 * width
        return out
