"""Secret scan: all rules in one deterministic automaton over the bytes of a text.

The rules are parsed into one nondeterministic automaton of the *reversed* patterns,
made deterministic by subset construction over byte classes, minimised, and stored as
transition arrays. A text is read once, from its end: after each byte the state tells
which rules have a match that *starts* there. Walking those starts forward gives the
leftmost matches of each rule; the automaton of that rule alone, run over the matched
bytes, gives the longest end. Both are exact for any rule without an empty match.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import per_text, with_struct


@dataclass(frozen=True)
class Rule:
    """``head`` then ``body``, and ``tail`` if it is there; a match counts when it has ``least`` bytes after its head."""

    kind: str
    head: str
    body: str
    least: int = 1
    tail: str = ""


def either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in words)


# A run of hex digits matches only as a whole, so demanding 24 digits in the pattern
# finds what matching any run and dropping the short ones finds. The same does not
# hold for assignments: a dropped short value still uses up its text.
BASE_RULES = (
    Rule(
        "assign",
        "(" + either_case("password|passwd|secret|token|api_?key") + """)["']?\\x20*[:=]\\x20*["']?""",
        "[A-Za-z0-9+/_.=-]+",
        6,
    ),
    Rule("access", "", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "", "[0-9a-f]{24,}"),
)
# What follows the first line of a PEM key: fields such as DEK-Info, then base64 up to the END
# line, also behind quotes, comment signs or escaped line breaks. Without an END line, long
# runs of base64, a padded rest, and the lines that start with base64.
_GAP = """[\\x20\\x09-\\x0d"'`,;>#*|&<()]"""
_BASE64 = r"[A-Za-z0-9+/=\\]"
_VALUE = r"[A-Za-z0-9+/=,._\x20]"
_FIELDS = rf"(({_GAP}|\\[rn])*[A-Z][A-Za-z0-9]*(-[A-Za-z0-9]+)+:{_VALUE}*(-{_VALUE}+)*)+"
_LINE = r"[\x20\x09]*(\x0d?\x0a|\x0d)[\x20\x09]*"
_RUN = rf"{_GAP}*{_BASE64}{{16,}}({_GAP}+[A-Za-z0-9+/]*==?)?"
PEM_TAIL = (
    rf"({_FIELDS})?({_GAP}|{_BASE64})*-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(({_FIELDS})({_LINE})+{_BASE64}+)?({_RUN}|{_LINE}{_BASE64}+)*"
)
MORE_RULES = (
    Rule("jwt", "", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("hub", "", "gh[oprsu]_[A-Za-z0-9]+", 40),
    Rule("chat", "", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("cloud", "", "AIza[A-Za-z0-9_-]+", 39),
    Rule("pem", "", "-----BEGIN [A-Z ]*PRIVATE KEY-----", tail=PEM_TAIL),
)
RULES = BASE_RULES + MORE_RULES


class _Parser:
    """Patterns of literals, classes, groups, ``|``, ``?``, ``*``, ``+`` and ``{m,}``."""

    def __init__(self, pattern: str):
        self.text, self.at = pattern, 0

    def parse(self):
        tree = self.choice()
        if self.at < len(self.text):
            raise ValueError(f"unbalanced pattern {self.text!r}")
        return tree

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def choice(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.at += 1
            options.append(self.sequence())
        return options[0] if len(options) == 1 else ("or", options)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return ("seq", parts)

    def repeated(self):
        item = self.atom()
        while True:
            c = self.peek()
            if c == "?":
                item = ("or", [item, ("seq", [])])
            elif c == "*":
                item = ("star", item)
            elif c == "+":
                item = ("seq", [item, ("star", item)])
            elif c == "{":
                end = self.text.index("}", self.at)
                low, comma, high = self.text[self.at + 1 : end].partition(",")
                items = [item] * int(low)
                if comma and not high:
                    items.append(("star", item))
                elif comma:
                    items += [("or", [item, ("seq", [])])] * (int(high) - int(low))
                item = ("seq", items)
                self.at = end
            else:
                return item
            self.at += 1

    def atom(self):
        c = self.peek()
        if c == "(":
            self.at += 1
            inner = self.choice()
            if self.peek() != ")":
                raise ValueError(f"unbalanced pattern {self.text!r}")
            self.at += 1
            return inner
        if c == "[":
            return self.group()
        return ("set", frozenset([self.char()]))

    def char(self) -> int:
        c = self.peek()
        self.at += 1
        if c != "\\":
            if ord(c) > 127:
                raise ValueError("rules are written in ASCII")
            return ord(c)
        c = self.peek()
        self.at += 1
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        if c.isalnum():
            raise ValueError(f"unknown escape in {self.text!r}")
        return ord(c)

    def group(self):
        self.at += 1
        negated = self.peek() == "^"
        self.at += negated
        members: set[int] = set()
        while self.peek() != "]":
            low = self.char()
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                members.update(range(low, self.char() + 1))
            else:
                members.add(low)
        self.at += 1
        return ("set", frozenset(range(256)) - members if negated else frozenset(members))


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []
        self.moves: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, tree, start: int, backward: bool) -> int:
        """States for ``tree`` from ``start`` on; gives the last one."""
        kind, what = tree
        if kind == "set":
            end = self.state()
            self.moves[start].append((what, end))
            return end
        if kind == "seq":
            for part in reversed(what) if backward else what:
                start = self.add(part, start, backward)
            return start
        end = self.state()
        if kind == "or":
            for part in what:
                first = self.state()
                self.free[start].append(first)
                self.free[self.add(part, first, backward)].append(end)
            return end
        loop = self.state()
        self.free[start].append(loop)
        self.free[self.add(what, loop, backward)].append(loop)
        self.free[loop].append(end)
        return end

    def closure(self, states: Iterable[int]) -> frozenset[int]:
        seen, stack = set(states), list(states)
        while stack:
            for t in self.free[stack.pop()]:
                if t not in seen:
                    seen.add(t)
                    stack.append(t)
        return frozenset(seen)


def byte_classes(nfa: _Nfa) -> tuple[np.ndarray, list[int]]:
    """The class of each byte, and one byte of each class."""
    sets = list({s for moves in nfa.moves for s, _ in moves})
    known: dict[tuple, int] = {}
    of = np.zeros(256, np.int64)
    members = []
    for b in range(256):
        of[b] = known.setdefault(tuple(b in s for s in sets), len(known))
        if of[b] == len(members):
            members.append(b)
    return of, members


def minimised(moves: np.ndarray, accept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no input tells apart; state 0 stays the start."""
    block = np.unique(accept, return_inverse=True)[1].reshape(-1)
    while True:
        _, finer = np.unique(np.column_stack([block, block[moves]]), axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    names = np.full(block.max() + 1, -1)
    first = []
    for s, b in enumerate(block):
        if names[b] < 0:
            names[b] = len(first)
            first.append(s)
    return names[block[moves[first]]], accept[first]


def determined(patterns: list[str], backward: bool, anywhere: bool) -> tuple[np.ndarray, np.ndarray]:
    """Transition array (state x byte) and the bit mask of patterns that end in a state."""
    nfa = _Nfa()
    root = nfa.state()
    ends = {}
    for k, pattern in enumerate(patterns):
        first = nfa.state()
        nfa.free[root].append(first)
        ends[nfa.add(_Parser(pattern).parse(), first, backward)] = 1 << k
    of, members = byte_classes(nfa)
    start = nfa.closure([root])
    known, rows, accept, at = {start: 0}, [], [], 0
    order = [start]
    while at < len(order):
        states = order[at]
        at += 1
        accept.append(sum(bit for s, bit in ends.items() if s in states))
        row = []
        for b in members:
            to = {t for s in states for chars, t in nfa.moves[s] if b in chars}
            if anywhere:
                to.add(root)
            to = nfa.closure(to)
            if to not in known:
                known[to] = len(order)
                order.append(to)
            row.append(known[to])
        rows.append(row)
    if accept[0]:
        raise ValueError("a rule must not match the empty text")
    moves, accept = minimised(np.array(rows), np.array(accept))
    return moves[:, of].astype(np.int32), accept


@lru_cache(maxsize=8)
def automata(rules: tuple[Rule, ...]) -> tuple:
    """The combined automaton of starts, and of each rule the automata of all of it and of its head.

    A tail moves no start, so only the automaton that finds the end holds it.
    """
    least = [r.head + r.body for r in rules]
    whole = [f"{x}(|{r.tail})" if r.tail else x for x, r in zip(least, rules, strict=True)]
    single = [
        (determined([w], False, False), determined([r.head], False, False) if r.head else None)
        for w, r in zip(whole, rules, strict=True)
    ]
    return determined(least, True, True), single


def linked(moves: np.ndarray, accept: np.ndarray) -> list:
    """Rows that hold the next row for each byte and, at 256, the rules that end there."""
    rows: list[list] = [[] for _ in accept]
    for row, to, mask in zip(rows, moves.tolist(), accept.tolist(), strict=True):
        row.extend(rows[t] for t in to)
        row.append(mask)
    return rows[0]


def longest(moves: list, accept: list, dead: int, data: bytes, start: int) -> int:
    """The end of the longest match from ``start``, or -1."""
    state, end = 0, -1
    for at in range(start, len(data)):
        state = moves[state][data[at]]
        if state == dead:
            break
        if accept[state]:
            end = at + 1
    return end


def dead_state(moves: np.ndarray, accept: np.ndarray) -> int:
    stuck = np.flatnonzero((moves == np.arange(len(moves))[:, None]).all(axis=1) & (accept == 0))
    return int(stuck[0]) if len(stuck) else -1


class Scanner:
    def __init__(self, rules: tuple[Rule, ...], compiled: tuple):
        (moves, accept), single = compiled
        self.rules = rules
        self.root = linked(moves, accept)
        self.single = []
        for whole, head in single:
            forms = [(m.tolist(), a.tolist(), dead_state(m, a)) for m, a in ([whole, head] if head else [whole])]
            self.single.append((forms[0], forms[1] if head else None))

    def __call__(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, number of the rule, end) in code points, by start and rule."""
        row, starts, last = self.root, [], len(data) - 1
        for at, byte in enumerate(reversed(data)):
            row = row[byte]
            if row[256]:
                starts.append((last - at, row[256]))
        if not starts:
            return []
        found, free = [], [0] * len(self.rules)
        for start, mask in reversed(starts):
            k = 0
            while mask:
                if mask & 1 and start >= free[k]:
                    whole, head = self.single[k]
                    free[k] = end = longest(*whole, data, start)
                    body = longest(*head, data, start) if head else start
                    if end - body >= self.rules[k].least:
                        found.append((start, k, end))
                mask >>= 1
                k += 1
        if found and not data.isascii():
            points = np.concatenate([[0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)])
            found = [(int(points[a]), k, int(points[b])) for a, k, b in found]
        return sorted(found)


def secret_spans(rules: tuple[Rule, ...] = RULES):
    """Column function: array of (kind, start, end) of a text, code points, end exclusive."""
    compiled = automata(rules)

    def make():
        scan = Scanner(rules, compiled)
        return lambda data: ([{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in scan(data)],)

    scanned = per_text(make, "spans array<struct<kind: string, start: bigint, end: bigint>>")
    return lambda text: scanned(text)["spans"]


def scan_secrets(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with a column ``spans``; NULL and empty texts have none, repeated rows agree.

    A column that is called ``spans`` already is replaced. Whole texts are scanned, row
    by row and without a shuffle, so neither long texts nor hot keys gather anywhere.
    """
    return with_struct(docs, F.struct(secret_spans(rules)(F.col(text)).alias("spans")), ["spans"])


def redact_secrets(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, mask: str = "[SECRET]"
) -> DataFrame:
    """``docs`` with every found span (overlapping ones as one) replaced by ``mask``; NULL stays NULL."""
    compiled = automata(rules)

    def make():
        scan = Scanner(rules, compiled)

        def one(data: bytes) -> tuple[str]:
            found = scan(data)
            whole = data.decode()
            out, at = [], 0
            for start, _, end in found:
                if start >= at:
                    out += [whole[at:start], mask]
                at = max(at, end)
            return ("".join([*out, whole[at:]]),)

        return one

    clean = per_text(make, "text string")
    return docs.withColumn(text, F.when(F.col(text).isNotNull(), clean(F.col(text))["text"]))


def rendered(spans: Column) -> Column:
    """kind:start:end, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
