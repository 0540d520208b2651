"""A generalised suffix automaton of token sequences, and matching statistics against it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """All stretches of several sequences of tokens (any hashable values), by the usual online construction.

    A state stands for stretches that end at the same places; ``link`` leads to the state of the longest
    stretch's longest end that has further places. ``ends`` lists each state's places: (sequence, end).
    """

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        prefixes = [self._add(s) for s in sequences]
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for which, states in enumerate(prefixes):
            for end, state in enumerate(states, 1):
                while state > 0:
                    self.ends[state].append((which, end))
                    state = self.link[state]

    def _new(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, before: int, token: int, state: int) -> int:
        """A state of its own for the shorter stretches of ``state``."""
        clone = self._new(self.length[before] + 1, self.link[state], dict(self.next[state]))
        self.link[state] = clone
        while before >= 0 and self.next[before].get(token) == state:
            self.next[before][token] = clone
            before = self.link[before]
        return clone

    def _add(self, sequence: Iterable[int]) -> list[int]:
        """The state of each beginning of the sequence. A beginning is the longest stretch of its state, which it
        keeps when the state is split, since only shorter ones move."""
        last, states = 0, []
        for token in sequence:
            known = self.next[last].get(token)
            if known is not None:
                whole = self.length[known] == self.length[last] + 1
                last = known if whole else self._split(last, token, known)
            else:
                state, before = self._new(self.length[last] + 1, 0, {}), last
                while before >= 0 and token not in self.next[before]:
                    self.next[before][token] = state
                    before = self.link[before]
                if before >= 0:
                    known = self.next[before][token]
                    whole = self.length[known] == self.length[before] + 1
                    self.link[state] = known if whole else self._split(before, token, known)
                last = state
            states.append(last)
        return states

    def statistics(self, tokens: Iterable[int]) -> list[tuple[int, int]]:
        """For each place, the state and length of the longest stretch that ends there."""
        state, length, out = 0, 0, []
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            out.append((state, length))
        return out

    def longest_by_sequence(self, state: int, length: int, least: int) -> dict[int, tuple[int, list[int]]]:
        """Sequence -> longest end (of at least ``least`` tokens) of the stretch that it holds, and where that ends."""
        found: dict[int, tuple[int, list[int]]] = {}
        while state > 0 and length >= least:
            here: dict[int, list[int]] = {}
            for which, end in self.ends[state]:
                if which not in found:
                    here.setdefault(which, []).append(end)
            found.update({which: (length, ends) for which, ends in here.items()})
            state = self.link[state]
            length = self.length[state]
        return found
