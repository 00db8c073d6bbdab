"""A combined deterministic automaton over bytes: several patterns, one table, one pass.

Patterns are parsed into a Thompson automaton (literals, classes, groups, ``|``, ``? * + {m} {m,} {m,n}``), made
deterministic by subset construction over byte classes, and minimised by partition refinement. Scanning steps many
lanes of the text at once through the transition array: lanes begin at the start of a text or behind a byte that leads
every state back to the start, so cutting there loses nothing.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np

#: Bytes per lane, about; and the number of lanes below which the rest is walked one by one.
LANE, FEW = 1024, 24


class _Nfa:
    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.move: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.move.append([])
        return len(self.empty) - 1


class _Parser:
    """Recursive descent; builds a tree of ('set', bytes), ('cat', ...), ('alt', ...), ('rep', node, low, high)."""

    def __init__(self, pattern: str, fold: bool) -> None:
        self.p, self.i, self.fold = pattern, 0, fold

    def parse(self):
        node = self.alternatives()
        if self.i != len(self.p):
            raise ValueError(f"unexpected {self.p[self.i]!r} in {self.p!r}")
        return node

    def peek(self) -> str:
        return self.p[self.i : self.i + 1]

    def take(self) -> str:
        self.i += 1
        return self.p[self.i - 1]

    def alternatives(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.take()
            options.append(self.sequence())
        return ("alt", options) if len(options) > 1 else options[0]

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.atom()))
        return ("cat", parts)

    def repeated(self, node):
        while (c := self.peek()) and c in "?*+{":
            self.take()
            if c == "{":
                end = self.p.index("}", self.i)
                low, _, high = self.p[self.i : end].partition(",")
                bounds = (int(low), int(high) if high else (None if "," in self.p[self.i : end] else int(low)))
                self.i = end + 1
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            node = ("rep", node, *bounds)
        return node

    def folded(self, codes: set[int]) -> frozenset[int]:
        if self.fold:
            codes |= {c ^ 32 for c in codes if 65 <= c <= 90 or 97 <= c <= 122}
        return frozenset(codes)

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2 : self.i], 16)
        return ord({"n": "\n", "t": "\t", "r": "\r"}.get(c, c))

    def atom(self):
        c = self.take()
        if c == "(":
            node = self.alternatives()
            if self.take() != ")":
                raise ValueError("a group isn't closed")
            return node
        if c == "[":
            codes: set[int] = set()
            while (c := self.take()) != "]":
                low = self.escaped() if c == "\\" else ord(c)
                if self.peek() == "-" and self.p[self.i + 1] != "]":
                    self.take()
                    c = self.take()
                    codes |= set(range(low, (self.escaped() if c == "\\" else ord(c)) + 1))
                else:
                    codes.add(low)
            return ("set", self.folded(codes))
        return ("set", self.folded({self.escaped() if c == "\\" else ord(c)}))


def _reverse(node):
    if node[0] == "cat":
        return ("cat", [_reverse(x) for x in reversed(node[1])])
    if node[0] == "alt":
        return ("alt", [_reverse(x) for x in node[1]])
    return ("rep", _reverse(node[1]), *node[2:]) if node[0] == "rep" else node


def _build(nfa: _Nfa, node, begin: int) -> int:
    """Adds ``node`` behind state ``begin``; gives its end state."""
    kind = node[0]
    if kind == "set":
        end = nfa.state()
        nfa.move[begin].append((node[1], end))
        return end
    if kind == "cat":
        for part in node[1]:
            begin = _build(nfa, part, begin)
        return begin
    if kind == "alt":
        end = nfa.state()
        for option in node[1]:
            first = nfa.state()
            nfa.empty[begin].append(first)
            nfa.empty[_build(nfa, option, first)].append(end)
        return end
    _, inner, low, high = node
    for _ in range(low):
        begin = _build(nfa, inner, begin)
    if high is None:
        loop, end = nfa.state(), nfa.state()
        nfa.empty[begin].append(loop)
        nfa.empty[_build(nfa, inner, loop)].append(loop)
        nfa.empty[loop].append(end)
        return end
    end = nfa.state()
    for _ in range(high - low):
        nfa.empty[begin].append(end)
        begin = _build(nfa, inner, begin)
    nfa.empty[begin].append(end)
    return end


@dataclass(frozen=True)
class Automaton:
    """classes: of each byte; table: next state by state * width + class; accepts: bit set of patterns by state.

    States from ``accepting`` on accept; ``resets`` marks bytes that lead every state to the start.
    """

    classes: np.ndarray
    table: np.ndarray
    width: int
    start: int
    accepting: int
    accepts: np.ndarray
    resets: np.ndarray

    @property
    def states(self) -> int:
        return len(self.accepts)

    def walk(self, data: bytes, state: int) -> list[tuple[int, int]]:
        """(offset, state) of the accepting positions, byte by byte."""
        table, classes, width, floor, out = self._table_list, self._class_list, self.width, self.accepting, []
        for i, b in enumerate(data):
            state = table[state * width + classes[b]]
            if state >= floor:
                out.append((i, state))
        return out

    def longest(self, data: bytes) -> int:
        """Length of the longest prefix that is accepted, -1 for none; stops in a state that can't be left."""
        table, classes, width, floor, state, best, dead = self._table_list, self._class_list, self.width, self.accepting, self.start, -1, self._dead
        for i, b in enumerate(data):
            state = table[state * width + classes[b]]
            if state >= floor:
                best = i + 1
            elif state == dead:
                break
        return best

    @property
    def _table_list(self) -> list[int]:
        if "_t" not in self.__dict__:
            self.__dict__["_t"] = self.table.tolist()
        return self.__dict__["_t"]

    @property
    def _class_list(self) -> list[int]:
        if "_c" not in self.__dict__:
            self.__dict__["_c"] = self.classes.tolist()
        return self.__dict__["_c"]

    @property
    def _dead(self) -> int:
        if "_d" not in self.__dict__:
            rows = self.table.reshape(self.states, self.width)
            loops = [s for s in range(self.accepting) if (rows[s] == s).all()]
            self.__dict__["_d"] = loops[0] if loops else -1
        return self.__dict__["_d"]

    def scan(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and states at which a pattern ends, over the texts data[begins[i]:ends[i]], in order of position."""
        starts, stops = self._lanes(data, begins, ends)
        order = np.argsort(starts - stops, kind="stable")
        at, lengths = starts[order].copy(), (stops - starts)[order]
        codes = self.classes[data]
        table, width, floor = self.table, self.width, self.accepting
        state = np.full(len(at), self.start, dtype=np.int32)
        positions, states = [], []
        # lanes are sorted by length, longest first: those still running are a prefix
        running = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), side="right")
        step = 0
        for step, n in enumerate(running.tolist()):
            if n < FEW:
                break
            p = at[:n] + step
            now = table[state[:n] * width + codes[p]]
            state[:n] = now
            hit = now >= floor
            if hit.any():
                positions.append(p[hit])
                states.append(now[hit])
        else:
            step = len(running)
        for lane in range(running[step] if step < len(running) else 0):
            found = self.walk(data[at[lane] + step : at[lane] + lengths[lane]].tobytes(), int(state[lane]))
            positions.append(np.array([at[lane] + step + i for i, _ in found], dtype=np.int64))
            states.append(np.array([s for _, s in found], dtype=np.int32))
        if not positions:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        p, s = np.concatenate(positions), np.concatenate(states)
        order = np.argsort(p, kind="stable")
        return p[order], s[order]

    def _lanes(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        resets = np.flatnonzero(self.resets[data]) + 1
        wanted = np.arange(0, len(data), LANE)
        near = np.searchsorted(resets, wanted)
        cuts = resets[near[near < len(resets)]]
        cuts = cuts[cuts < len(data)]
        owner = np.searchsorted(begins, cuts, side="right") - 1
        inside = (owner >= 0) & (cuts < ends[np.maximum(owner, 0)])
        starts = np.unique(np.concatenate([begins[ends > begins], cuts[inside]]))
        stop_of = ends[np.searchsorted(begins, starts, side="right") - 1]
        stops = np.minimum(np.append(starts[1:], len(data)), stop_of)
        return starts.astype(np.int64), stops.astype(np.int64)


def compile_patterns(patterns: list[tuple[str, bool]], search: bool = True, backwards: bool = False) -> Automaton:
    """patterns: (pattern, whether ASCII letters match in either case). search: a match may begin anywhere."""
    nfa = _Nfa()
    root = nfa.state()
    final: dict[int, int] = {}
    if search:
        nfa.move[root].append((frozenset(range(256)), root))
    for k, (pattern, fold) in enumerate(patterns):
        node = _Parser(pattern, fold).parse()
        first = nfa.state()
        nfa.empty[root].append(first)
        final[_build(nfa, _reverse(node) if backwards else node, first)] = 1 << k

    signature: dict[int, list[int]] = defaultdict(list)
    sets = list(dict.fromkeys(s for moves in nfa.move for s, _ in moves))
    for i, s in enumerate(sets):
        for b in s:
            signature[b].append(i)
    kinds: dict[tuple, int] = {}
    classes = np.array([kinds.setdefault(tuple(signature.get(b, ())), len(kinds)) for b in range(256)], dtype=np.int32)
    width = len(kinds)
    example = [int(np.flatnonzero(classes == c)[0]) for c in range(width)]

    closed: dict[int, frozenset[int]] = {}

    def closure(state: int) -> frozenset[int]:
        if state not in closed:
            seen, todo = {state}, [state]
            while todo:
                for t in nfa.empty[todo.pop()]:
                    if t not in seen:
                        seen.add(t)
                        todo.append(t)
            closed[state] = frozenset(seen)
        return closed[state]

    first_set = closure(root)
    names, rows, accepts = {first_set: 0}, [], []
    queue = [first_set]
    for members in queue:  # subset construction; the list grows while it is walked
        accepts.append(sum({final[m] for m in members if m in final}))
        row = []
        for b in example:
            into: set[int] = set()
            for m in members:
                for s, t in nfa.move[m]:
                    if b in s:
                        into |= closure(t)
            key = frozenset(into)
            if key not in names:
                names[key] = len(names)
                queue.append(key)
            row.append(names[key])
        rows.append(row)

    table, accept = np.array(rows, dtype=np.int64), np.array(accepts, dtype=np.int64)
    block = np.unique(accept, return_inverse=True)[1].reshape(-1)
    while True:  # refinement: states stay together while all their moves do
        _, finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    n = int(block.max()) + 1
    chosen = np.zeros(n, dtype=np.int64)
    chosen[block[::-1]] = np.arange(len(block))[::-1]
    merged, merged_accept = block[table[chosen]], accept[chosen]
    order = np.argsort(merged_accept > 0, kind="stable")
    new = np.empty(n, dtype=np.int64)
    new[order] = np.arange(n)
    merged, merged_accept = new[merged[order]], merged_accept[order]
    start = int(new[block[0]])
    resets = (merged == start).all(axis=0)[classes] if search else np.zeros(256, dtype=bool)
    return Automaton(classes, merged.astype(np.int32).ravel(), width, start, int((merged_accept == 0).sum()), merged_accept, resets)
