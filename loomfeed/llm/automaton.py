"""Suffix automaton over several integer sequences with weighted occurrence counts."""

from __future__ import annotations


class SuffixAutomaton:
    """States with the number of places (by sequence weight) where their strings end."""

    def __init__(self, sequences: list[tuple[list[int], int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]
        for words, weight in sequences:
            last = 0
            for word in words:
                last = self._extend(last, word)
                self.count[last] += weight
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]

    def _state(self, edges: dict[int, int], length: int, link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.next) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A state for the strings that end ``target`` and are no longer than through ``state``."""
        copy = self._state(dict(self.next[target]), self.length[state] + 1, self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:
            if self.length[target] == self.length[last] + 1:
                return target
            return self._split(last, word, target)
        fresh = self._state({}, self.length[last] + 1, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = fresh
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            if self.length[target] != self.length[state] + 1:
                target = self._split(state, word, target)
            self.link[fresh] = target
        return fresh

    def repeated(self, words: list[int], least: int, times: int = 2) -> list[tuple[int, int]]:
        """Stream the words for matching statistics against the strings that occur
        ``times`` or more; the merged spans of matches of ``least`` or more words."""
        spans: list[tuple[int, int]] = []
        state = size = 0
        following, count, link, length = self.next, self.count, self.link, self.length
        for i, word in enumerate(words):
            target = following[state].get(word, -1)
            while target < 0 or count[target] < times:
                if not state:
                    size = target = -1
                    break
                state = link[state]
                size = length[state]
                target = following[state].get(word, -1)
            state, size = max(target, 0), size + 1
            if size >= least:
                start = i + 1 - size
                if spans and start <= spans[-1][1]:
                    spans[-1] = (min(spans[-1][0], start), i + 1)
                else:
                    spans.append((start, i + 1))
        return spans
