"""Two-label minimum cut on small sparse graphs."""

from __future__ import annotations

from collections.abc import Sequence


class Cut:
    """Labels nodes 0 .. n-1 so that the paid capacities are least.

    ``keep[i]`` is paid when node i lands on the drop side, ``drop[i]`` when it
    lands on the keep side, and an edge's capacity when its ends are parted.
    Maximum flow by blocking flows on shortest paths, with whole-number
    capacities, so every tie is broken alike: a node that costs the same on
    both sides is dropped.
    """

    def __init__(self, keep: Sequence[int], drop: Sequence[int]) -> None:
        self.count = len(keep)
        self.out: list[list[int]] = [[] for _ in range(self.count + 2)]
        self.to: list[int] = []
        self.room: list[int] = []
        source, sink = self.count, self.count + 1
        for node, (a, b) in enumerate(zip(keep, drop, strict=True)):
            if a > b:
                self._arc(source, node, a - b, 0)
            elif b > a:
                self._arc(node, sink, b - a, 0)

    def _arc(self, a: int, b: int, there: int, back: int) -> None:
        self.out[a].append(len(self.to))
        self.out[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [there, back]

    def tie(self, a: int, b: int, cost: int) -> None:
        self._arc(a, b, cost, cost)

    def kept(self) -> list[bool]:
        source, sink = self.count, self.count + 1
        while True:
            level = self._levels(source)
            if level[sink] < 0:
                return [level[n] >= 0 for n in range(self.count)]
            self._blocking_flow(source, sink, level)

    def _levels(self, source: int) -> list[int]:
        """Distance of each node from the source over arcs with room, -1 beyond reach."""
        level = [-1] * (self.count + 2)
        level[source], queue = 0, [source]
        for node in queue:
            for arc in self.out[node]:
                other = self.to[arc]
                if self.room[arc] and level[other] < 0:
                    level[other] = level[node] + 1
                    queue.append(other)
        return level

    def _blocking_flow(self, source: int, sink: int, level: list[int]) -> None:
        out, to, room = self.out, self.to, self.room
        tried, path, node = [0] * (self.count + 2), [], source
        while True:
            if node == sink:
                flow = min(room[arc] for arc in path)
                for arc in path:
                    room[arc] -= flow
                    room[arc ^ 1] += flow
                first = next(n for n, arc in enumerate(path) if not room[arc])
                node = to[path[first] ^ 1]
                del path[first:]
            elif tried[node] < len(out[node]):
                arc = out[node][tried[node]]
                if room[arc] and level[to[arc]] == level[node] + 1:
                    path.append(arc)
                    node = to[arc]
                else:
                    tried[node] += 1
            elif path:
                node = to[path.pop() ^ 1]
                tried[node] += 1
            else:
                return
