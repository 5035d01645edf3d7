"""A generalised suffix automaton over sequences of integers."""

from __future__ import annotations

from array import array


class SuffixAutomaton:
    """Accepts exactly the substrings of the sequences added.

    State 0 is the empty string. ``length`` is the longest string of a state,
    ``link`` the state of its longest suffix that lies in another state, and
    ``step`` the transitions. At most two states per symbol added.
    """

    def __init__(self):
        self.step: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]

    def _new(self, length: int, step: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.step.append(step)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The part of q that ends p's string + c becomes a state of its own."""
        step, link = self.step, self.link
        clone = self._new(self.length[p] + 1, dict(step[q]), link[q])
        link[q] = clone
        while p >= 0 and step[p].get(c) == q:
            step[p][c] = clone
            p = link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        step, link, length = self.step, self.link, self.length
        q = step[last].get(c)
        if q is not None:  # an earlier sequence already holds this string
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        new = self._new(length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def add(self, sequence) -> None:
        last = 0
        for c in sequence:
            last = self._extend(last, c)

    def states(self, sequence) -> list[int]:
        """The state of each prefix of a sequence that was added."""
        out, at = [], 0
        for c in sequence:
            at = self.step[at][c]
            out.append(at)
        return out

    def by_length(self) -> list[int]:
        """States without the first, in ascending order of length: a link comes
        before what links to it."""
        return sorted(range(1, len(self.link)), key=self.length.__getitem__)

    def matching(self, sequence):
        """(state, length) of the longest suffix of each prefix that is a
        substring of a sequence added: the matching statistics."""
        step, link, length = self.step, self.link, self.length
        at = n = 0
        for c in sequence:
            to = step[at].get(c)
            while to is None and at:
                at = link[at]
                n = length[at]
                to = step[at].get(c)
            if to is not None:
                at, n = to, n + 1
            yield at, n


class CompactAutomaton:
    """A finished automaton in arrays, to be walked only: most states have one
    transition, which takes eight bytes; a table holds those of the others."""

    def __init__(self, sam: SuffixAutomaton):
        self.link, self.length = array("i", sam.link), array("i", sam.length)
        self.symbol, self.next = array("i", [-1] * len(sam.link)), array("i", [-1] * len(sam.link))
        self.more: dict[int, dict[int, int]] = {}
        for v, step in enumerate(sam.step):
            if len(step) == 1:
                (self.symbol[v], self.next[v]), = step.items()
            elif step:
                self.more[v] = step

    @property
    def nbytes(self) -> int:
        """About what a process holds: the arrays, and the tables' entries."""
        return 16 * len(self.link) + sum(350 + 100 * len(s) for s in self.more.values())

    def matching(self, sequence):
        """As :meth:`SuffixAutomaton.matching`."""
        link, length, symbol, following, more = self.link, self.length, self.symbol, self.next, self.more
        at = n = 0
        for c in sequence:
            while True:
                to = following[at] if symbol[at] == c else more[at].get(c) if at in more else None
                if to is not None or not at:
                    break
                at = link[at]
                n = length[at]
            if to is not None:
                at, n = to, n + 1
            yield at, n
