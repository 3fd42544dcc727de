"""Misspelled terms of a lexicon: Levenshtein automata intersected with a trie.

The lexicon is a trie of code points. A state of the automaton is a set of pairs
(trie node, edits spent): reading a character, a pair goes to the child of that
character for nothing, and for one edit to any child (a wrong character), to a
grandchild's side of any child (a missing one) or nowhere (a surplus one). A pair
lives as long as a term below its node allows that many edits. States are made
deterministic on first use and kept, so each is derived once per process however many
words pass through it. All words of a slice advance together, one character at a
time, by look-ups in the table of transitions; most die within a few characters.

A term is either a whole word or a stem, which any word may continue.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Edits that a result may carry; results are numbered ``term * KINDS + edits``.
KINDS = 3
_DEAD, _START = 0, 1
# Bytes of a character by its first byte, and the bits of that byte that count.
_SIZE = np.ones(256, dtype=np.int64)
_SIZE[0xC0:0xE0], _SIZE[0xE0:0xF0], _SIZE[0xF0:] = 2, 3, 4
_BITS = np.array([0, 0x7F, 0x1F, 0x0F, 0x07])


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool

    @property
    def edits(self) -> int:
        """Short terms are matched letter by letter: nearly every short word is near some other."""
        n = len(self.text) - (1 if self.stem else 0)
        return 0 if n < 5 else 1 if n < 9 else 2


class Automaton:
    def __init__(self, terms: list[Term]):
        self.children: list[dict[int, int]] = [{}]
        self.ends: list[tuple[int, bool] | None] = [None]
        self.budget = [0]
        for number, term in enumerate(terms):
            node = 0
            for c in map(ord, term.text):
                self.budget[node] = max(self.budget[node], term.edits)
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.budget.append(0)
                node = self.children[node][c]
            self.budget[node] = max(self.budget[node], term.edits)
            self.ends[node] = (number, term.stem)
        self.terms = terms
        alphabet = sorted({ord(c) for t in terms for c in t.text})
        self.symbol = np.zeros((alphabet[-1] if alphabet else 0) + 2, dtype=np.int16)
        self.symbol[alphabet] = np.arange(1, len(alphabet) + 1)
        self.characters = [-1, *alphabet]
        # a state: its pairs, and the best stem passed so far as (edits, -length, term)
        start = self._closed({0: 0}, None)
        self.states = [((), None), start]
        self.numbers = {((), None): _DEAD, start: _START}
        self.table = np.full((64, len(self.characters)), -1, dtype=np.int32)
        self.result = np.full(64, -1, dtype=np.int64)
        self.table[_DEAD] = _DEAD
        self._finish(_START)

    def _closed(self, pairs: dict[int, int], passed: tuple | None) -> tuple:
        """With characters left out, pairs that nothing allows removed, and stems that end here noted."""
        todo = list(pairs.items())
        while todo:
            node, spent = todo.pop()
            for child in self.children[node].values():
                if spent < self.budget[child] and pairs.get(child, KINDS) > spent + 1:
                    pairs[child] = spent + 1
                    todo.append((child, spent + 1))
        for node, spent in pairs.items():
            end = self.ends[node]
            if end and end[1] and spent <= self.terms[end[0]].edits:
                found = (spent, -len(self.terms[end[0]].text), end[0])
                passed = found if passed is None else min(passed, found)
        return tuple(sorted(pairs.items())), passed

    def _next(self, state: int, character: int) -> int:
        pairs, passed = self.states[state]
        after: dict[int, int] = {}

        def reach(node: int, spent: int) -> None:
            if spent <= self.budget[node] and after.get(node, KINDS) > spent:
                after[node] = spent

        for node, spent in pairs:
            reach(node, spent + 1)
            for c, child in self.children[node].items():
                reach(child, spent if c == character else spent + 1)
        new = self._closed(after, passed)
        if new not in self.numbers:
            self.numbers[new] = len(self.states)
            self.states.append(new)
            if len(self.states) > len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                self.result = np.concatenate([self.result, np.full_like(self.result, -1)])
            self._finish(self.numbers[new])
        return self.numbers[new]

    def _finish(self, state: int) -> None:
        """What a word that ends in ``state`` matches: least edits, whole words before stems, longer terms first."""
        pairs, passed = self.states[state]
        best = None if passed is None else (passed[0], 1, passed[1], passed[2])
        for node, spent in pairs:
            end = self.ends[node]
            if end and not end[1] and spent <= self.terms[end[0]].edits:
                found = (spent, 0, -len(self.terms[end[0]].text), end[0])
                best = found if best is None else min(best, found)
        self.result[state] = -1 if best is None else best[3] * KINDS + best[0]

    def matches(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """For each span of UTF-8 bytes, ``term * KINDS + edits`` of the term it matches, or -1."""
        out = np.full(len(starts), -1, dtype=np.int64)
        if not self.terms:
            return out
        who, at, end = np.arange(len(starts)), starts.astype(np.int64), ends
        state = np.full(len(starts), _START, dtype=np.int64)
        while len(who):
            done = at >= end
            if done.any():
                out[who[done]] = self.result[state[done]]
                who, at, end, state = (x[~done] for x in (who, at, end, state))
            lead = data[at]
            size = _SIZE[lead]
            character = lead & _BITS[size]
            for i in range(1, int(size.max(initial=1))):
                longer = size > i
                character[longer] = character[longer] << 6 | data[at[longer] + i] & 0x3F
            symbol = self.symbol[np.minimum(character, len(self.symbol) - 1)]
            after = self.table[state, symbol]
            if (after < 0).any():
                unknown = np.unique(state[after < 0] * len(self.characters) + symbol[after < 0])
                for s, c in zip(*divmod(unknown, len(self.characters))):
                    number = self._next(int(s), self.characters[c])
                    self.table[s, c] = number
                after = self.table[state, symbol]
            alive = after != _DEAD
            who, at, end, state = who[alive], (at + size)[alive], end[alive], after[alive].astype(np.int64)
        return out
