"""Weighted acyclic automata: sorted keys with counts as a minimal transducer.

A key is a tuple of labels (bytes); the weights along its path and of its last state add up to
its count. Keys are added in order. States that the next key leaves are frozen at once, where an
equal state is reused, so building needs memory for the result and one path.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import zstandard

Key = tuple[bytes, ...]


class Builder:
    """``add`` keys in ascending order, each once, with a count of 0 or more; then ``finish``."""

    def __init__(self):
        self._known: dict = {}
        self._states: list = []  # (residual count or -1 where no key ends, ((label, weight, target), ...))
        self._open: list = [[-1, []]]  # states on the path of the last key
        self._last: Key = ()

    def _freeze(self, down_to: int) -> None:
        while len(self._open) > down_to:
            residual, arcs = self._open.pop()
            state = (residual, tuple(map(tuple, arcs)))
            number = self._known.get(state)
            if number is None:
                number = self._known[state] = len(self._states)
                self._states.append(state)
            self._open[-1][1][-1][2] = number

    def add(self, key: Key, count: int) -> None:
        last = self._last
        same = 0
        while same < len(last) and same < len(key) and last[same] == key[same]:
            same += 1
        self._freeze(same + 1)
        left = count
        for depth in range(same):  # an arc keeps what all its keys share
            arc = self._open[depth][1][-1]
            if arc[1] > left:
                more, arc[1] = arc[1] - left, left
                below = self._open[depth + 1]
                if below[0] >= 0:
                    below[0] += more
                for a in below[1]:
                    a[1] += more
            left -= arc[1]
        for label in key[same:]:
            self._open[-1][1].append([label, left, -1])
            self._open.append([-1, []])
            left = 0
        self._open[-1][0] = left
        self._last = key

    def finish(self) -> Automaton:
        self._freeze(1)
        residual, arcs = self._open[0]
        return Automaton([*self._states, (residual, tuple(map(tuple, arcs)))])


class Automaton:
    """States, the first one last; arcs of a state are in the order of their labels."""

    def __init__(self, states: list):
        self.states = states

    def items(self) -> Iterator[tuple[Key, int]]:
        """All keys with their counts, in order."""
        waiting = [(len(self.states) - 1, (), 0)]
        while waiting:
            number, key, weight = waiting.pop()
            residual, arcs = self.states[number]
            if residual >= 0:
                yield key, weight + residual
            waiting.extend([(target, (*key, label), weight + w) for label, w, target in reversed(arcs)])

    def compose(self, asked: Automaton) -> Iterator[tuple[Key, int]]:
        """The keys of both, in order, with the counts of this one: the two are walked side by side."""
        waiting = [(len(self.states) - 1, len(asked.states) - 1, (), 0)]
        while waiting:
            mine, other, key, weight = waiting.pop()
            residual, arcs = self.states[mine]
            wanted, paths = asked.states[other]
            if residual >= 0 and wanted >= 0:
                yield key, weight + residual
            i, both = 0, []
            for label, _, goes_to in paths:
                while i < len(arcs) and arcs[i][0] < label:
                    i += 1
                if i < len(arcs) and arcs[i][0] == label:
                    both.append((arcs[i][2], goes_to, (*key, label), weight + arcs[i][1]))
            waiting.extend(reversed(both))

    def dump(self) -> bytes:
        numbers: dict[bytes, int] = {}
        arcs = [(numbers.setdefault(a, len(numbers)), w, t) for _, out in self.states for a, w, t in out]
        table = np.array(arcs, dtype="<i8").reshape(-1, 3)
        parts = [
            np.array([len(self.states), len(arcs), len(numbers)], dtype="<i8"),
            np.array([s[0] for s in self.states], dtype="<i8"),
            np.array([len(s[1]) for s in self.states], dtype="<i8"),
            np.ascontiguousarray(table.T),
            np.array([len(x) for x in numbers], dtype="<i8"),
        ]
        return zstandard.compress(b"".join([p.tobytes() for p in parts] + list(numbers)), 3)

    @classmethod
    def load(cls, dumped: bytes) -> Automaton:
        raw = zstandard.decompress(dumped)
        n_states, n_arcs, n_labels = np.frombuffer(raw, "<i8", 3).tolist()
        values = np.frombuffer(raw, "<i8", 2 * n_states + 3 * n_arcs + n_labels, 24)
        residuals, sizes, labels, weights, targets, lengths = np.split(
            values, np.cumsum([n_states, n_states, n_arcs, n_arcs, n_arcs])
        )
        at = 24 + 8 * len(values)
        ends = (at + np.cumsum(lengths)).tolist()
        names = [raw[s:e] for s, e in zip([at, *ends], ends)]
        arcs = list(zip([names[i] for i in labels.tolist()], weights.tolist(), targets.tolist()))
        stops = np.cumsum(sizes).tolist()
        return cls([(r, tuple(arcs[s:e])) for r, s, e in zip(residuals.tolist(), [0, *stops], stops)])


def build(items: Iterable[tuple[Key, int]]) -> Automaton:
    builder = Builder()
    for key, count in items:
        builder.add(key, count)
    return builder.finish()
