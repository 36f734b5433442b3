"""Weighted finite-state transducers: deterministic, composed before use."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass


@dataclass
class Transducer:
    """moves[state][label] = (output label, weight, next state); ends[state] = weight at the end of the input."""

    moves: list[dict[str, tuple[str, float, int]]]
    ends: list[float]

    def __matmul__(self, other: Transducer) -> Transducer:
        """The composition: what self puts out is other's input; weights add (the tropical semiring's product)."""
        number, todo, moves, ends = {(0, 0): 0}, [(0, 0)], [], []
        while todo:
            p, q = todo.pop(0)
            row = {}
            for label, (out, weight, p2) in self.moves[p].items():
                if out in other.moves[q]:
                    out2, weight2, q2 = other.moves[q][out]
                    if (p2, q2) not in number:
                        number[p2, q2] = len(number)
                        todo.append((p2, q2))
                    row[label] = (out2, weight + weight2, number[p2, q2])
            moves.append(row)
            ends.append(self.ends[p] + other.ends[q])
        return Transducer(moves, ends)

    def run(self, labels: Iterable[str]) -> tuple[list[str], float]:
        """What it puts out for the labels, and the weight of the path."""
        state, total, out = 0, 0.0, []
        for label in labels:
            o, weight, state = self.moves[state][label]
            total += weight
            out.append(o)
        return out, total + self.ends[state]


def build(labels: Iterable[str], start, step: Callable) -> Transducer:
    """A transducer from step(state, label) -> (output label, weight, next state), over the states that can be reached from start."""
    number, todo, moves = {start: 0}, [start], []
    labels = list(labels)
    while todo:
        state = todo.pop(0)
        row = {}
        for label in labels:
            out, weight, to = step(state, label)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row[label] = (out, weight, number[to])
        moves.append(row)
    return Transducer(moves, [0.0] * len(moves))
