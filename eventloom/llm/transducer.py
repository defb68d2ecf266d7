"""Minimal acyclic transducers: a sorted term list as an automaton that gives each term its ordinal.

Terms come in ascending order of their bytes. The states of the last term's path that the
next term leaves are final, so each is either found among the states that exist or becomes
one: the automaton is minimal at every moment and no larger one is ever held. An arc
carries the number of terms that come before all terms that take it, from its state on;
the sum along a term's path is the term's place in the sorted list.

States and arcs are arrays, and many terms walk at once, one byte of each in a step.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np

#: The columns of a written transducer, all binary.
COLUMNS = ("arcs", "targets", "skips", "finals")


class Transducer(NamedTuple):
    """``arcs`` are 256 * state + byte, ascending; the last state is the root."""

    arcs: np.ndarray
    targets: np.ndarray
    skips: np.ndarray
    finals: np.ndarray

    def to_bytes(self) -> list[bytes]:
        return [part.tobytes() for part in self]

    @classmethod
    def from_bytes(cls, arcs: bytes, targets: bytes, skips: bytes, finals: bytes) -> Transducer:
        return cls(np.frombuffer(arcs, np.int64), np.frombuffer(targets, np.int64), np.frombuffer(skips, np.int64), np.frombuffer(finals, np.bool_))

    def ordinals(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The ordinal of each term ``data[start : start + size]``, -1 where it is none of the list."""
        out = np.full(len(starts), -1, np.int64)
        alive = np.arange(len(starts))
        state, skipped = np.full(len(starts), len(self.finals) - 1), np.zeros(len(starts), np.int64)
        step = 0
        while len(alive):
            ends = sizes[alive] == step
            if ends.any():
                found = ends & self.finals[state]
                out[alive[found]] = skipped[found]
                alive, state, skipped = alive[~ends], state[~ends], skipped[~ends]
            arc = 256 * state + data[starts[alive] + step]
            at = np.minimum(np.searchsorted(self.arcs, arc), len(self.arcs) - 1)
            goes = self.arcs[at] == arc if len(self.arcs) else np.zeros(len(alive), bool)
            at, alive = at[goes], alive[goes]
            state, skipped = self.targets[at], skipped[goes] + self.skips[at]
            step += 1
        return out


def build(terms: Iterable[bytes]) -> Transducer:
    """The transducer of distinct terms in ascending order."""
    known: dict[tuple, int] = {}
    path: list[tuple[list[tuple[int, int]], bool]] = [([], False)]  # of the last term: arcs so far, whether a term ends here
    last = None

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            arcs, final = path.pop()
            path[-1][0].append((last[len(path) - 1], known.setdefault((final, tuple(arcs)), len(known))))

    for term in terms:
        if last is not None:
            if term <= last:
                raise ValueError("terms are not in ascending order")
            shared = next((k for k, (a, b) in enumerate(zip(last, term)) if a != b), len(last))
            close(shared)
        path.extend(([], False) for _ in range(len(term) - len(path) + 1))
        path[-1] = (path[-1][0], True)
        last = term
    close(0)
    arcs, final = path[0]
    # The root is a state of its own at the end, also where an equal one exists.
    states = [*known, (final, tuple(arcs))]
    counts: list[int] = []  # terms from a state on; a state's targets stand before it
    flat: list[tuple[int, int, int]] = []
    for number, (final, arcs) in enumerate(states):
        before = int(final)
        for byte, target in arcs:
            flat.append((256 * number + byte, target, before))
            before += counts[target]
        counts.append(before)
    table = np.array(flat, np.int64).reshape(-1, 3)
    return Transducer(*np.ascontiguousarray(table.T), np.array([final for final, _ in states], np.bool_))
