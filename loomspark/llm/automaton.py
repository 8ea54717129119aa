"""Regular expressions over bytes, compiled by subset construction and minimised into transition arrays.

The syntax is the small part that scan rules need: literals, escapes (\\xHH and escaped punctuation), classes with ranges,
groups, (?i:...) for ASCII letters in either case, |, ?, *, +, {m}, {m,} and {m,n}.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


class Nfa:
    """Thompson automaton: byte-set edges and empty edges between numbered states."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.edges: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.edges.append([])
        return len(self.empty) - 1


class _Parser:
    """Reads a pattern into a tree: ('set', bytes), ('cat', parts), ('alt', parts) or ('rep', part, least, most)."""

    def __init__(self, pattern: str) -> None:
        self.p, self.i, self.fold = pattern, 0, False

    def whole(self):
        tree = self.either()
        if self.i < len(self.p):
            raise ValueError(f"unread pattern at {self.i}: {self.p!r}")
        return tree

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def either(self):
        options = [self.row()]
        while self.peek() == "|":
            self.take()
            options.append(self.row())
        return options[0] if len(options) == 1 else ("alt", options)

    def row(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated())
        return ("cat", parts)

    def repeated(self):
        part = self.one()
        while (c := self.peek()) and c in "?*+{":
            self.take()
            if c == "{":
                least, _, most = self.p[self.i : (end := self.p.index("}", self.i))].partition(",")
                bounds = (int(least), int(most) if most else None if "," in self.p[self.i : end] else int(least))
                self.i = end + 1
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            part = ("rep", part, *bounds)
        return part

    def one(self):
        c = self.take()
        if c == "(":
            was = self.fold
            if self.p.startswith("?i:", self.i):
                self.i, self.fold = self.i + 3, True
            inner = self.either()
            self.take()
            self.fold = was
            return inner
        if c == "[":
            return ("set", self.members())
        return ("set", self.cased({self.byte(c)}))

    def byte(self, c: str) -> int:
        if c == "\\":
            c = self.take()
            if c == "x":
                self.i += 2
                return int(self.p[self.i - 2 : self.i], 16)
        if ord(c) > 127:
            raise ValueError("patterns are ASCII")
        return ord(c)

    def members(self) -> frozenset[int]:
        found: set[int] = set()
        while (c := self.take()) != "]":
            low = self.byte(c)
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.take()
                found.update(range(low, self.byte(self.take()) + 1))
            else:
                found.add(low)
        return self.cased(found)

    def cased(self, found: set[int]) -> frozenset[int]:
        if self.fold:
            found = found | {ord(chr(b).swapcase()) for b in found if chr(b).isalpha()}
        return frozenset(found)


def _backwards(tree):
    kind = tree[0]
    if kind == "set":
        return tree
    if kind == "rep":
        return ("rep", _backwards(tree[1]), *tree[2:])
    parts = [_backwards(x) for x in tree[1]]
    return (kind, parts[::-1] if kind == "cat" else parts)


def _build(nfa: Nfa, tree, start: int) -> int:
    """Adds the tree from start on; returns the state in which it has been read."""
    kind = tree[0]
    if kind == "set":
        end = nfa.state()
        nfa.edges[start].append((tree[1], end))
        return end
    if kind == "cat":
        for part in tree[1]:
            start = _build(nfa, part, start)
        return start
    end = nfa.state()
    if kind == "alt":
        for part in tree[1]:
            first = nfa.state()
            nfa.empty[start].append(first)
            nfa.empty[_build(nfa, part, first)].append(end)
        return end
    _, part, least, most = tree
    for _ in range(least):
        start = _build(nfa, part, start)
    if most is None:
        loop = nfa.state()
        nfa.empty[start].append(loop)
        nfa.empty[_build(nfa, part, loop)].append(loop)
        nfa.empty[loop].append(end)
        return end
    for _ in range(most - least):
        nfa.empty[start].append(end)
        start = _build(nfa, part, start)
    nfa.empty[start].append(end)
    return end


@dataclass(frozen=True)
class Dfa:
    """Minimal automaton. table[state + byte] is the next state; states are multiples of 256.

    accepts maps a state to the rules read there; all states from `first` on accept something, none before does.
    dead is the state from which nothing can be read (-1 if there is none).
    """

    table: list[int]
    start: int
    first: int
    accepts: dict[int, tuple[int, ...]]
    dead: int


def compile_rules(patterns: list[str], anchored: bool, reverse: bool = False) -> Dfa:
    """One automaton for all patterns. Unanchored: a match may begin at any byte."""
    nfa = Nfa()
    root = nfa.state()
    ends: dict[int, int] = {}
    for k, pattern in enumerate(patterns):
        tree = _Parser(pattern).whole()
        first = nfa.state()
        nfa.empty[root].append(first)
        ends[_build(nfa, _backwards(tree) if reverse else tree, first)] = k
    if not anchored:
        nfa.edges[root].append((frozenset(range(256)), root))

    # Bytes that no edge tells apart share a class.
    signature: dict[tuple[bool, ...], int] = {}
    sets = list({s for edges in nfa.edges for s, _ in edges})
    of_byte = [signature.setdefault(tuple(b in s for s in sets), len(signature)) for b in range(256)]
    sample = [of_byte.index(c) for c in range(len(signature))]

    def closed(states: set[int]) -> frozenset[int]:
        todo = list(states)
        while todo:
            for x in nfa.empty[todo.pop()]:
                if x not in states:
                    states.add(x)
                    todo.append(x)
        return frozenset(states)

    numbers = {closed({root}): 0}
    order, rows = list(numbers), []
    for now in order:  # grows while it is read
        edges = [e for s in now for e in nfa.edges[s]]
        row = []
        for b in sample:
            to = closed({t for s, t in edges if b in s})
            if to not in numbers:
                numbers[to] = len(numbers)
                order.append(to)
            row.append(numbers[to])
        rows.append(row)
    moves = np.array(rows)
    reads = [tuple(sorted({ends[s] for s in states if s in ends})) for states in order]

    # Moore's refinement: states stay together while their classes and those they move to agree.
    kinds: dict[tuple[int, ...], int] = {}
    block = np.array([kinds.setdefault(r, len(kinds)) for r in reads])
    while True:
        _, finer = np.unique(np.column_stack([block, block[moves]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    count = int(block.max()) + 1
    chosen = [int(np.argmax(block == k)) for k in range(count)]
    ranked = sorted(range(count), key=lambda k: bool(reads[chosen[k]]))  # those that accept come last
    place = {k: i * 256 for i, k in enumerate(ranked)}
    table = [place[int(block[moves[chosen[k], of_byte[b]]])] for k in ranked for b in range(256)]
    accepts = {place[k]: reads[chosen[k]] for k in ranked if reads[chosen[k]]}
    dead = next((place[k] for k in ranked if not reads[chosen[k]] and all(int(block[x]) == k for x in moves[chosen[k]])), -1)
    return Dfa(table, place[int(block[0])], min(accepts, default=count * 256), accepts, dead)
