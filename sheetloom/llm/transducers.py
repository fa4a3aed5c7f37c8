"""Weighted finite-state transducers: state tables, their composition, and the best path.

A transducer reads symbols and writes symbols.  An arc carries a factor; the weight of a
path over weighted symbols is the sum of each symbol's weight times the factors of its
arcs.  Composition feeds what one machine writes to the next: factors multiply, states pair
up.  Machines may guess (several arcs for a symbol); only paths that end in a final state
count, and the best of them gives the weight of a sequence.
"""

from __future__ import annotations

from dataclasses import dataclass

Arc = tuple[str, float, object]         # symbol written, factor, next state


@dataclass(frozen=True)
class Transducer:
    """``arcs[state][symbol]`` lists what may be done on reading a symbol there."""

    starts: tuple
    finals: frozenset
    arcs: dict

    def best(self, symbols: list[tuple[str, float]]) -> float | None:
        """Greatest weight of an accepting path over (symbol, weight) pairs; None without one."""
        live = dict.fromkeys(self.starts, 0.0)
        for symbol, weight in symbols:
            after: dict = {}
            for state, total in live.items():
                for _, factor, target in self.arcs[state].get(symbol, ()):
                    value = total + weight * factor
                    if value > after.get(target, float("-inf")):
                        after[target] = value
            live = after
        return max((total for state, total in live.items() if state in self.finals), default=None)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """One machine that reads as ``first`` and writes what ``second`` makes of its output;
    only states that can be reached are built."""
    starts = tuple((a, b) for a in first.starts for b in second.starts)
    arcs: dict = {}
    waiting = list(starts)
    while waiting:
        pair = waiting.pop()
        if pair in arcs:
            continue
        a, b = pair
        arcs[pair] = {}
        for symbol, options in first.arcs[a].items():
            found = [(out, f * g, (p, q)) for middle, f, p in options
                     for out, g, q in second.arcs[b].get(middle, ())]
            if found:
                arcs[pair][symbol] = found
                waiting += [target for _, _, target in found]
    finals = frozenset(p for p in arcs if p[0] in first.finals and p[1] in second.finals)
    return Transducer(starts, finals, arcs)


def machine(starts, finals, rows: list[tuple]) -> Transducer:
    """A transducer from (state, symbols read, symbol written or None for the same, factor,
    next state) rows."""
    arcs: dict = {}
    for state, symbols, out, factor, target in rows:
        for symbol in symbols:
            arcs.setdefault(state, {}).setdefault(symbol, []).append((out or symbol, factor, target))
        arcs.setdefault(target, {})
    return Transducer(tuple(starts), frozenset(finals), arcs)
