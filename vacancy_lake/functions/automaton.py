"""All terms of a vocabulary in one pass over a text: an Aho-Corasick automaton over words.

States are prefixes of terms, word by word. Where no term goes on with the next word, the failure link leads to the longest
suffix that is a prefix of a term; a word of no term leads back to the start at once. So a pass costs one or two look-ups a
word, however many terms there are and however long, and nothing is built for the word sequences that are no terms.
Matches begin and end at words by construction.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from functools import cached_property


class TermAutomaton:
    """Built from terms of one or more words parted by single blanks; empty terms match nothing."""

    def __init__(self, terms: Iterable[str]):
        self.terms = [t for t in dict.fromkeys(terms) if t]
        self.number = {t: i for i, t in enumerate(self.terms)}
        self.words: dict[str, int] = {}
        for term in self.terms:
            for word in term.split(" "):
                self.words.setdefault(word, len(self.words))
        self.step: dict[int, int] = {}  # state * words + word -> state
        self.depth, self.ends, n = [0], [-1], len(self.words)
        children: list[list[tuple[int, int]]] = [[]]
        for number, term in enumerate(self.terms):
            state = 0
            for word in term.split(" "):
                at = state * n + self.words[word]
                after = self.step.get(at)
                if after is None:
                    after = self.step[at] = len(self.ends)
                    children[state].append((self.words[word], after))
                    children.append([])
                    self.depth.append(self.depth[state] + 1)
                    self.ends.append(-1)
                state = after
            self.ends[state] = number
        self.fail = [0] * len(self.ends)
        #: Terms that end in a state: its own, then those of its suffixes.
        self.found: list[tuple[int, ...]] = [()] * len(self.ends)
        queue = deque([0])
        while queue:
            state = queue.popleft()
            own = (self.ends[state],) if self.ends[state] >= 0 else ()
            self.found[state] = own + self.found[self.fail[state]] if state else ()
            for word, after in children[state]:
                self.fail[after] = self._after(self.fail[state], word) if state else 0
                queue.append(after)

    def _after(self, state: int, word: int) -> int:
        n, step = len(self.words), self.step
        after = step.get(state * n + word)
        while after is None and state:
            state = self.fail[state]
            after = step.get(state * n + word)
        return after or 0

    def states(self, words: Iterable[str]) -> Iterator[int]:
        """State after each word."""
        state, number, n, step, fail = 0, self.words.get, len(self.words), self.step, self.fail
        for word in words:
            w = number(word)
            if w is None:
                state = 0
            else:
                after = step.get(state * n + w)
                while after is None and state:
                    state = fail[state]
                    after = step.get(state * n + w)
                state = after or 0
            yield state

    def all(self, words: Iterable[str]) -> set[int]:
        """Numbers of all terms that occur."""
        out: set[int] = set()
        for state in set(self.states(words)):
            out.update(self.found[state])
        return out

    def longest(self, words: Iterable[str]) -> set[int]:
        """Numbers of the terms that occur somewhere not inside a longer match."""
        spans = []  # (first word, last word, term), by last word; of one end the longest covers the others
        for place, state in enumerate(self.states(words)):
            if self.found[state]:
                term = self.found[state][0]
                spans.append((place - self.terms[term].count(" "), place, term))
        out, first = set(), None
        for start, _, term in reversed(spans):  # a later match that begins no later covers this one
            if first is None or start < first:
                out.add(term)
                first = start
        return out


class SharedTerms:
    """Names of terms, as they travel to the tasks; a worker builds the automaton when it first needs it."""

    def __init__(self, names: dict[str, list[str]]):
        self.names = names

    @cached_property
    def automaton(self) -> TermAutomaton:
        return TermAutomaton(sorted(self.names))
