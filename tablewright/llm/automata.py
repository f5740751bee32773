"""Probabilistic automata inferred from example strings by merging compatible states of their prefix tree."""

from __future__ import annotations

from collections.abc import Iterable
from math import log, sqrt

#: Probability of a symbol, or an end, that was never seen in a state.
UNSEEN = 1e-3


class Automaton:
    """A deterministic automaton over symbols with counts; state 0 is the start."""

    def __init__(self, strings: Iterable[str], doubt: float = 0.05):
        self.arrived, self.ended = [0], [0]
        self.next: list[dict[str, int]] = [{}]
        self.taken: list[dict[str, int]] = [{}]
        for s in strings:
            self._add(s)
        self.bound = sqrt(0.5 * log(2 / doubt))
        self._merge_states()

    def _add(self, string: str) -> None:
        state = 0
        self.arrived[0] += 1
        for symbol in string:
            to = self.next[state].get(symbol)
            if to is None:
                to = self.next[state][symbol] = len(self.next)
                self.arrived.append(0)
                self.ended.append(0)
                self.next.append({})
                self.taken.append({})
            self.taken[state][symbol] = self.taken[state].get(symbol, 0) + 1
            state = to
            self.arrived[state] += 1
        self.ended[state] += 1

    def _alike(self, a: int, n: int, b: int, m: int) -> bool:
        """Whether two shares can stem from one probability (Hoeffding)."""
        return abs(a / n - b / m) < self.bound * (1 / sqrt(n) + 1 / sqrt(m))

    def _compatible(self, a: int, b: int) -> bool:
        """Whether two states, and all that follows them, have like shares of symbols and ends."""
        pairs, seen = [(a, b)], set()
        while pairs:
            a, b = pair = pairs.pop()
            if a == b or pair in seen:
                continue
            seen.add(pair)
            n, m = self.arrived[a], self.arrived[b]
            if not self._alike(self.ended[a], n, self.ended[b], m):
                return False
            for symbol in self.taken[a].keys() | self.taken[b].keys():
                if not self._alike(self.taken[a].get(symbol, 0), n, self.taken[b].get(symbol, 0), m):
                    return False
                if symbol in self.next[a] and symbol in self.next[b]:
                    pairs.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add the counts of a subtree to a state and what follows it."""
        pairs = [(into, tree)]
        while pairs:
            a, b = pairs.pop()
            self.arrived[a] += self.arrived[b]
            self.ended[a] += self.ended[b]
            for symbol, n in self.taken[b].items():
                self.taken[a][symbol] = self.taken[a].get(symbol, 0) + n
                if symbol in self.next[a]:
                    pairs.append((self.next[a][symbol], self.next[b][symbol]))
                else:
                    self.next[a][symbol] = self.next[b][symbol]

    def _merge_states(self) -> None:
        """Kept states are compared with each state that follows one; a state like a kept one is merged into it."""
        kept = [0]
        while True:
            held = set(kept)
            edge = next(((s, x, t) for s in kept for x, t in sorted(self.next[s].items()) if t not in held), None)
            if edge is None:
                break
            state, symbol, to = edge
            same = next((k for k in kept if self._compatible(k, to)), None)
            if same is None:
                kept.append(to)
            else:
                self.next[state][symbol] = same
                self._fold(same, to)
        self.states = len(kept)

    def likelihood(self, string: str) -> float:
        """Mean logarithm of the probabilities of the symbols and the end."""
        state, total = 0, 0.0
        for symbol in string:
            n = self.arrived[state]
            total += log(max(self.taken[state].get(symbol, 0) / n, UNSEEN)) if n else log(UNSEEN)
            state = self.next[state].get(symbol, 0)
        end = self.ended[state] / self.arrived[state] if self.arrived[state] else 0
        return (total + log(max(end, UNSEEN))) / (len(string) + 1)
