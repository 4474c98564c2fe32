"""Regular expressions over bytes, compiled together into one deterministic automaton.

Rules are written in a small regular language (literals, sets, ``|``, groups, ``? * +`` and
``{m}``, ``{m,}``, ``{m,n}``). Subset construction turns all rules into one table of transitions;
partition refinement merges equal states; bytes that no state tells apart share a class. Each state
carries a bit mask of the rules that end there.
"""

from dataclasses import dataclass

import numpy as np

ALL = frozenset(range(256))


class _Parser:
    """One rule as a nondeterministic automaton: lists of (byte set, target) and empty moves."""

    def __init__(self, backward: bool = False):
        self.backward = backward
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.empty.append([])
        return len(self.moves) - 1

    def parse(self, rule: str) -> tuple[int, int]:
        self.rule, self.at = rule, 0
        out = self._either()
        if self.at != len(rule):
            raise ValueError(f"unexpected {rule[self.at]!r} at {self.at} in {rule!r}")
        return self._build(out)

    def _peek(self) -> str:
        return self.rule[self.at] if self.at < len(self.rule) else ""

    def _either(self):
        options = [self._sequence()]
        while self._peek() == "|":
            self.at += 1
            options.append(self._sequence())
        return options[0] if len(options) == 1 else ("or", options)

    def _sequence(self):
        parts = []
        while self._peek() not in ("", "|", ")"):
            parts.append(self._repeated())
        return ("and", parts)

    def _repeated(self):
        item = self._atom()
        while (c := self._peek()) and c in "?*+{":
            self.at += 1
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(c, (None, None))
            if c == "{":
                end = self.rule.index("}", self.at)
                first, comma, last = self.rule[self.at:end].partition(",")
                low = int(first)
                high = low if not comma else int(last) if last else None
                self.at = end + 1
            item = ("repeat", item, low, high)
        return item

    def _atom(self):
        c = self.rule[self.at]
        self.at += 1
        if c == "(":
            inner = self._either()
            if self._peek() != ")":
                raise ValueError(f"missing ) in {self.rule!r}")
            self.at += 1
            return inner
        if c == "[":
            return ("set", self._set())
        if c == ".":
            return ("set", ALL - {10})
        return ("set", frozenset([self._escaped() if c == "\\" else ord(c)]))

    def _escaped(self) -> int:
        c = self.rule[self.at]
        self.at += 1
        if c == "x":
            value = int(self.rule[self.at:self.at + 2], 16)
            self.at += 2
            return value
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def _set(self) -> frozenset:
        negated = self._peek() == "^"
        self.at += negated
        members, first = set(), True
        while first or self._peek() != "]":
            first = False
            low = self._member()
            if self._peek() == "-" and self.rule[self.at + 1] != "]":
                self.at += 1
                members.update(range(low, self._member() + 1))
            else:
                members.add(low)
        self.at += 1
        return ALL - members if negated else frozenset(members)

    def _member(self) -> int:
        c = self.rule[self.at]
        self.at += 1
        return self._escaped() if c == "\\" else ord(c)

    def _build(self, tree) -> tuple[int, int]:
        kind = tree[0]
        if kind == "set":
            a, b = self.state(), self.state()
            self.moves[a].append((tree[1], b))
            return a, b
        if kind == "and":
            start = end = self.state()
            for part in reversed(tree[1]) if self.backward else tree[1]:
                a, b = self._build(part)
                self.empty[end].append(a)
                end = b
            return start, end
        if kind == "or":
            start, end = self.state(), self.state()
            for part in tree[1]:
                a, b = self._build(part)
                self.empty[start].append(a)
                self.empty[b].append(end)
            return start, end
        _, item, low, high = tree
        start = end = self.state()
        for _ in range(low):
            a, b = self._build(item)
            self.empty[end].append(a)
            end = b
        if high is None:
            a, b = self._build(item)
            last = self.state()
            self.empty[end] += [a, last]
            self.empty[b] += [a, last]
            return start, last
        ends = [end]
        for _ in range(high - low):
            a, b = self._build(item)
            self.empty[end].append(a)
            end = b
            ends.append(end)
        last = self.state()
        for e in ends:
            self.empty[e].append(last)
        return start, last


@dataclass(frozen=True)
class Automaton:
    """``table[state * n_classes + classes[byte]]`` is the next state; state 0 is the start.

    ``accepts[state]`` has bit r set when rule r ends there. ``dead`` is the state without a way on
    (-1 if there is none).
    """

    table: np.ndarray
    classes: np.ndarray
    n_classes: int
    accepts: np.ndarray
    dead: int

    def resets(self) -> np.ndarray:
        """For each pair of bytes (first * 256 + second): after it every state is the start, so nothing
        that began before it goes on after it."""
        grid = self.table.reshape(-1, self.n_classes)
        after = (grid[grid] == 0).all(axis=0)  # by first and second class
        return after[self.classes[:, None], self.classes[None, :]].reshape(-1)


def compile_rules(rules: list[str], anywhere: bool, backward: bool = False) -> Automaton:
    """One automaton for all rules; ``anywhere`` lets a match begin at any byte, ``backward`` reads texts
    from their ends."""
    nfa = _Parser(backward)
    starts, ends = [], {}
    for r, rule in enumerate(rules):
        a, b = nfa.parse(rule)
        starts.append(a)
        ends[b] = r

    closures: dict[int, frozenset] = {}

    def closure(states) -> frozenset:
        out, todo = set(), list(states)
        while todo:
            s = todo.pop()
            if s in closures:
                out |= closures[s]
            elif s not in out:
                out.add(s)
                todo += nfa.empty[s]
        return frozenset(out)

    for s in range(len(nfa.moves)):
        closures[s] = closure([s])

    # classes of bytes that every set of the rules treats alike
    signs: dict[tuple, list[int]] = {}
    sets = list({move[0] for moves in nfa.moves for move in moves})
    for byte in range(256):
        signs.setdefault(tuple(byte in s for s in sets), []).append(byte)
    groups = list(signs.values())

    # subset construction
    first = closure(starts)
    number, order, rows = {first: 0}, [first], []
    while len(rows) < len(order):
        state, row = order[len(rows)], []
        for group in groups:
            byte = group[0]
            reached = [t for s in state for members, t in nfa.moves[s] if byte in members]
            new = closure(reached + (starts if anywhere else []))
            if new not in number:
                number[new] = len(order)
                order.append(new)
            row.append(number[new])
        rows.append(row)
    grid = np.array(rows)
    accepts = np.array([sum(1 << r for e, r in ends.items() if e in state) for state in order], np.int64)

    # minimisation: split blocks until members agree on marks and on the blocks they lead to
    _, block = np.unique(accepts, return_inverse=True)
    while True:
        keys = np.column_stack([block, block[grid]])
        _, finer = np.unique(keys, axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    # the start becomes state 0
    rename = np.full(block.max() + 1, -1)
    rename[block[0]] = 0
    for b in block:
        if rename[b] < 0:
            rename[b] = rename.max() + 1
    block = rename[block]
    n = block.max() + 1
    small, marks = np.zeros((n, len(groups)), np.int64), np.zeros(n, np.int64)
    small[block] = block[grid]
    marks[block] = accepts
    classes = np.zeros(256, np.int64)
    for c, group in enumerate(groups):
        classes[group] = c
    stuck = [s for s in range(n) if marks[s] == 0 and (small[s] == s).all()]
    return Automaton(small.reshape(-1).astype(np.int32), classes.astype(np.int32), len(groups), marks,
                     stuck[0] if stuck else -1)


def breaks(resets: np.ndarray, body: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Places (ascending, 0 and the length included) that no match crosses: the starts of texts in
    ``cuts``, and the ends of resetting pairs of bytes inside a text."""
    n = len(body)
    flags = np.zeros(n + 1, bool)
    if n > 1:
        flags[2:] = resets[(body[:-1].astype(np.uint16) << 8) | body[1:]]
        inner = cuts[cuts < n]
        flags[inner + 1] = False  # the pair lies across two texts
    flags[cuts] = True
    flags[[0, n]] = True
    return np.flatnonzero(flags)


def ends_of(machine: Automaton, symbols: np.ndarray, places: np.ndarray,
            lane_bytes: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Positions of last bytes and marks where a rule ends, in one pass over the byte classes.

    The text is cut at some of ``places`` into lanes of about ``lane_bytes`` that move on together:
    one step takes one byte of every lane.
    """
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    wanted = np.searchsorted(places, np.arange(0, n, lane_bytes))
    edges = np.unique(np.concatenate([places[wanted], [0, n]]))
    starts, lengths = edges[:-1], np.diff(edges)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    state = np.zeros(len(starts), np.int32)
    marked = machine.accepts != 0
    where, what = [], []
    # lanes alive at a step are a prefix, as lanes are sorted by length
    alive = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")
    for t in range(int(lengths[0])):
        k = alive[t]
        now = machine.table[state[:k] * machine.n_classes + symbols[starts[:k] + t]]
        state[:k] = now
        hit = marked[now]
        if hit.any():
            lanes = np.flatnonzero(hit)
            where.append(starts[lanes] + t)
            what.append(machine.accepts[now[lanes]])
    if not where:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(where), np.concatenate(what)


def starts_in(machine: Automaton, symbols: list) -> list[int]:
    """Places, ascending, where a match begins, in one pass of a backward automaton from the end."""
    table, marked, width, state, out = machine.table, machine.accepts != 0, machine.n_classes, 0, []
    table, marked = table.tolist(), marked.tolist()
    for i in range(len(symbols) - 1, -1, -1):
        state = table[state * width + symbols[i]]
        if marked[state]:
            out.append(i)
    return out[::-1]


def longest_from(machine: Automaton, symbols: list, start: int, stop: int | None = None) -> int:
    """End of the longest match that begins at ``start`` and ends by ``stop``; -1 without one."""
    state, end = 0, -1
    table, accepts, dead, width = machine.table, machine.accepts, machine.dead, machine.n_classes
    for i in range(start, len(symbols) if stop is None else stop):
        state = table[state * width + symbols[i]]
        if state == dead:
            break
        if accepts[state]:
            end = i + 1
    return end
