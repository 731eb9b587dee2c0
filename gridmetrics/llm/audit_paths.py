"""The cheapest edits that give a conversation a legal order of roles, by a persistent audit DP.

A legal conversation is empty, or an optional system message and then one or more pairs of a user and an
assistant message. Four states say how far a prefix has come: nothing yet, the system message, a user
message last, an assistant message last. Each row is kept, given another role or deleted, and messages can
be inserted anywhere; the result is written as letters, one an edit. Among edits of equal cost the ASCII-least
letters count.

The letters of the best edits of all prefixes and states share their beginnings: each is a node with a link to
the one before it, a jump to an ancestor further up (binary lifting with one jump a node, so memory
grows with the rows alone) and a rolling hash of the letters down to it. Two equally cheap edits are
compared by a search for their longest common prefix along the jumps; equal hashes are verified by the nodes
or, where these differ, letter by letter.

Edits of equal cost of the same rows never begin one another, as a further letter would be an insertion
and cost more. So the best edits of a stretch of rows, for every pair of states before and after it, can be
computed apart and put together later (:func:`followed_by`).
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass

#: States: nothing yet, system message, user last, assistant last.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = (EMPTY, SYSTEM, USER, ASSISTANT)

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5

#: Codes of rows: x has to go; the initial of the role, o for any other, a capital if the text is truncated.
MUST_GO = "x"
#: Where a kept message of an initial leads to, by state.
_KEPT = {
    "s": {EMPTY: SYSTEM},
    "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
    "o": {},
}
#: Where a message of the role that has to follow leads to.
_NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}

_BASE, _PRIME = 257, (1 << 61) - 1


class Prefixes:
    """Strings that share their beginnings; a node is a string, 0 the empty one."""

    def __init__(self) -> None:
        self.letters, self.parents, self.jumps = bytearray(b"\0"), array("q", [0]), array("q", [0])
        self.depths, self.hashes = array("q", [0]), array("q", [0])

    def add(self, parent: int, letter: str) -> int:
        jump, depth = self.jumps[parent], self.depths[parent]
        level = depth - self.depths[jump] == self.depths[jump] - self.depths[self.jumps[jump]]
        self.letters.append(ord(letter))
        self.parents.append(parent)
        self.jumps.append(self.jumps[jump] if level else parent)
        self.depths.append(depth + 1)
        self.hashes.append((self.hashes[parent] * _BASE + ord(letter)) % _PRIME)
        return len(self.letters) - 1

    def drop_last(self) -> None:
        for column in (self.letters, self.parents, self.jumps, self.depths, self.hashes):
            column.pop()

    def text(self, node: int, above: int = 0) -> str:
        """The string of a node, without that of its ancestor ``above``."""
        found = bytearray()
        while node != above:
            found.append(self.letters[node])
            node = self.parents[node]
        return bytes(reversed(found)).decode()

    def ancestor(self, node: int, depth: int) -> int:
        while self.depths[node] > depth:
            jump = self.jumps[node]
            node = jump if self.depths[jump] >= depth else self.parents[node]
        return node

    def _same(self, a: int, b: int) -> bool:
        """Whether two strings of one length are equal, letter by letter up to a shared node."""
        while a != b:
            if self.letters[a] != self.letters[b]:
                return False
            a, b = self.parents[a], self.parents[b]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``."""
        depth = min(self.depths[a], self.depths[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        hashes, parents, jumps = self.hashes, self.parents, self.jumps
        if hashes[x] == hashes[y]:
            verified = self._same(x, y)
            return self.depths[a] < self.depths[b] if verified else self.text(a) < self.text(b)
        while hashes[parents[x]] != hashes[parents[y]]:
            if hashes[jumps[x]] != hashes[jumps[y]]:
                x, y = jumps[x], jumps[y]
            else:
                x, y = parents[x], parents[y]
        if not self._same(parents[x], parents[y]):  # a collision further up
            return self.text(a) < self.text(b)
        return self.letters[x] < self.letters[y]


#: Cost and node of the best edits by state.
Best = dict[int, tuple[int, int]]


def _offer(prefixes: Prefixes, best: Best, state: int, cost: int, parent: int, letter: str) -> None:
    """Take the edits at ``parent`` with one more letter as those of a state if they are better."""
    known = best.get(state)
    if known is not None and known[0] < cost:
        return
    node = prefixes.add(parent, letter)
    if known is None or cost < known[0] or prefixes.less(node, known[1]):
        best[state] = (cost, node)
    else:
        prefixes.drop_last()


def _insert(prefixes: Prefixes, best: Best) -> None:
    """Insertions after the last row; two of them are as far as it is worth to go."""
    for before in (EMPTY, SYSTEM, ASSISTANT, USER):
        if before in best:
            cost, node = best[before]
            _offer(prefixes, best, _NEXT[before], cost + INSERT_COST, node, INSERT)


def _prune(best: Best) -> None:
    """Drop states from which nothing can come out better than from a closed pair."""
    if ASSISTANT not in best:
        return
    closed = best[ASSISTANT][0]
    # A system message that could still be kept is worth a deletion at most.
    for state, worth in ((EMPTY, DELETE_COST), (SYSTEM, 0)):
        if state in best and best[state][0] > closed + worth:
            del best[state]


def _row(prefixes: Prefixes, best: Best, code: str) -> Best:
    """The best edits with one more row."""
    after: Best = {}
    for state, (cost, node) in best.items():
        _offer(prefixes, after, state, cost + DELETE_COST, node, DELETE)
    if code != MUST_GO:
        initial = code.lower()
        extra = 0 if initial == code else TRUNCATED_COST
        for state, (cost, node) in best.items():
            kept, following = _KEPT[initial].get(state), _NEXT[state]
            if kept is not None:
                _offer(prefixes, after, kept, cost + extra, node, KEEP)
            if kept != following:
                _offer(prefixes, after, following, cost + extra + REROLE_COST, node, REROLE)
    _insert(prefixes, after)
    _prune(after)
    return after


#: Cost and letters of the best edits of a stretch by state after it.
Edits = dict[int, tuple[int, str]]


def edits_from(codes: str, state: int | None = None) -> Edits:
    """Best edits of a stretch of rows; ``state`` is the one before it, None at the begin of a conversation.

    Insertions before the first row belong to what comes before it.
    """
    prefixes = Prefixes()
    best: Best = {EMPTY if state is None else state: (0, 0)}
    if state is None:
        _insert(prefixes, best)
    for code in codes:
        best = _row(prefixes, best, code)
    return {after: (cost, prefixes.text(node)) for after, (cost, node) in best.items()}


@dataclass(frozen=True)
class Linked:
    """Letters as pieces, each linked to the one before it."""

    before: Linked | None
    piece: str
    count: int

    def text(self) -> str:
        pieces, at = [], self
        while at is not None:
            pieces.append(at.piece)
            at = at.before
        return "".join(reversed(pieces))


def _first(a: Linked, b: Linked) -> bool:
    """Whether the letters of ``a`` come before those of ``b``; both have the same number of pieces."""
    left, right = [], []
    while a is not b:
        left.append(a.piece)
        right.append(b.piece)
        a, b = a.before, b.before
    return "".join(reversed(left)) < "".join(reversed(right))


Ways = dict[int, tuple[int, Linked | None]]

_START: dict[int, tuple[int, str]] = edits_from("")


def begun(edits: Edits) -> Ways:
    return {state: (cost, Linked(None, letters, 1)) for state, (cost, letters) in edits.items()}


def followed_by(ways: Ways, steps: dict[int, Edits]) -> Ways:
    """The best edits of what is behind and of the next stretch, given by the state before it."""
    best: Ways = {}
    for state, (cost, letters) in ways.items():
        for after, (more, piece) in steps.get(state, {}).items():
            total, known = cost + more, best.get(after)
            if known is None or total <= known[0]:
                link = Linked(letters, piece, letters.count + 1)
                if known is None or total < known[0] or _first(link, known[1]):
                    best[after] = (total, link)
    return best


def start() -> Ways:
    """Before the first row: nothing, or messages inserted there."""
    return begun(_START)


def chosen(ways: Ways) -> tuple[int, str]:
    """Cost and letters of the best edits of a whole conversation."""
    ends = [(cost, link.text()) for state, (cost, link) in ways.items() if state in (EMPTY, ASSISTANT)]
    return min(ends)
