"""Secret scan with one combined deterministic automaton for all rules.

A rule is a regular expression over bytes: literals, classes, escapes, groups, alternation and the repeats
``? * + {n} {n,} {n,m}``. All rules become one nondeterministic automaton, then, by subset construction over
classes of equal bytes, a deterministic one that searches for every rule at any place, then a minimal one, kept as
transition arrays. States in which some rule has just matched have the highest numbers, so the scan of a text is one
table step and one comparison per byte for all rules together.

The scan yields, per rule, the ends of longest matches. A start belongs to each end: the automaton of the reversed
rule runs backwards from the end, not past the rule's previous match, and its farthest hit is the leftmost
start. That gives leftmost, non-overlapping, longest matches for rules whose match ends where its last class ends
(all rules here do: what follows a match cannot prolong it, and a later start never ends earlier).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import ROW, map_batches, schema_of

_ANY = range(256)


@dataclass(frozen=True)
class Rule:
    """``pattern`` as above; letters match in either case if ``fold``; ``keep`` says of a matched text whether it counts.

    A match that ``keep`` drops still uses up its text.
    """

    kind: str
    pattern: str
    fold: bool = False
    keep: Callable[[bytes], bool] | None = None


def _value_length(match: bytes) -> int:
    """Length of an assignment's value: what follows the separator, blanks and a quote."""
    rest = match.lstrip(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_\"' ")[1:].lstrip(b" ")
    return len(rest) - (rest[:1] in (b'"', b"'"))


_VALUE = "[A-Za-z0-9+/_.=-]+"
#: The kinds of the contract, in its order, then further ones.
BASE = (
    Rule("assign", "(password|passwd|secret|token|api_?key)[\"']? *[:=] *[\"']?" + _VALUE, fold=True, keep=lambda m: _value_length(m) >= 6),
    Rule("access", "AKIA[A-Z0-9]+", keep=lambda m: len(m) >= 20),
    Rule("hex", "[0-9a-f]{24,}"),
)
#: Lengths are left to ``keep`` where a rule starts with a word of its own: states multiply where values of several
#: rules can run at once (with a rule for signed web tokens 970 states become 7,900).
MORE = (
    Rule("github", "(ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]+", keep=lambda m: len(m) >= 40),
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", keep=lambda m: len(m) >= 15),
)
RULES = BASE + MORE


class _Parser:
    """Pattern -> nested tuples: ('set', bytes), ('cat', parts), ('alt', parts), ('rep', part, least, most or None)."""

    def __init__(self, pattern: str, fold: bool):
        self.text, self.at, self.fold = pattern, 0, fold

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternation(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.atom()))
        return ("cat", parts)

    def repeated(self, part):
        if self.peek() in ("?", "*", "+"):
            least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[self.take()]
            return ("rep", part, least, most)
        if self.peek() == "{":
            self.take()
            low, comma, high = self.text[self.at : self.text.index("}", self.at)].partition(",")
            self.at = self.text.index("}", self.at) + 1
            return ("rep", part, int(low), int(high) if high else None if comma else int(low))
        return part

    def atom(self):
        c = self.take()
        if c == "(":
            inner = self.alternation()
            self.take()
            return inner
        if c == "[":
            return self.bracket()
        return self.letters({ord(self.take() if c == "\\" else c)})

    def bracket(self):
        found: set[int] = set()
        while self.peek() != "]":
            c = self.take()
            low = ord(self.take() if c == "\\" else c)
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                found.update(range(low, ord(self.take()) + 1))
            else:
                found.add(low)
        self.take()
        return self.letters(found)

    def letters(self, found: set[int]):
        if self.fold:
            found |= {b ^ 32 for b in found if 65 <= b & ~32 <= 90}
        return ("set", frozenset(found))


def _reversed(node):
    kind = node[0]
    if kind == "cat":
        return ("cat", [_reversed(n) for n in reversed(node[1])])
    if kind == "alt":
        return ("alt", [_reversed(n) for n in node[1]])
    return ("rep", _reversed(node[1]), *node[2:]) if kind == "rep" else node


class _Nfa:
    """States with empty moves and byte moves; ``accepts`` names the rule that a state ends."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset, int]]] = []
        self.accepts: dict[int, int] = {}

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def add(self, node, start: int) -> int:
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((node[1], end))
            return end
        if kind == "cat":
            for part in node[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for part in node[1]:
                begin = self.state()
                self.empty[start].append(begin)
                self.empty[self.add(part, begin)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop, end = self.state(), self.state()
            self.empty[start].append(loop)
            self.empty[loop].append(end)
            self.empty[self.add(part, loop)].append(loop)
            return end
        end = self.state()
        for _ in range(most - least):
            self.empty[start].append(end)
            start = self.add(part, start)
        self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


@dataclass
class Automaton:
    """Minimal deterministic automaton in arrays.

    ``classes`` maps a byte to its class; ``table[state + class]`` is the next state, states being row offsets in
    the table; states from ``accepting`` on have matched: ``rules_of[state]`` lists which. ``dead`` is the
    state that nothing leaves, if there is one.
    """

    classes: bytes
    table: list[int]
    start: int
    accepting: int
    rules_of: dict[int, tuple[int, ...]]
    dead: int


def _compile(nodes: list, search: bool) -> Automaton:
    """One automaton for all rules; ``search`` lets a match begin at every byte, else only at the first."""
    nfa = _Nfa()
    first = nfa.state()
    for number, node in enumerate(nodes):
        begin = nfa.state()
        nfa.empty[first].append(begin)
        nfa.accepts[nfa.add(node, begin)] = number
    sets = {s for moves in nfa.moves for s, _ in moves}
    signature: dict[tuple, int] = {}
    classes = bytes(signature.setdefault(tuple(b in s for s in sets), len(signature)) for b in _ANY)
    sample = [classes.index(c) for c in range(len(signature))]

    begin = nfa.closure([first])
    number, rows, todo = {begin: 0}, [], [begin]
    for subset in todo:  # subset construction; ``todo`` grows as new subsets appear
        row = []
        for byte in sample:
            target = nfa.closure([t for s in subset for allowed, t in nfa.moves[s] if byte in allowed])
            target = target | begin if search else target
            if target not in number:
                number[target] = len(todo)
                todo.append(target)
            row.append(number[target])
        rows.append(row)
    accepts = [tuple(sorted({nfa.accepts[s] for s in subset if s in nfa.accepts})) for subset in todo]

    # Minimisation: split the blocks of states until all states of a block step to the same blocks.
    table = np.array(rows)
    block = np.unique([str(a) for a in accepts], return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    member = {int(b): i for i, b in enumerate(block)}
    order = sorted(member, key=lambda b: (bool(accepts[member[b]]), b))
    width = len(sample)
    at = {b: i * width for i, b in enumerate(order)}
    flat = [at[int(block[t])] for b in order for t in rows[member[b]]]
    rules_of = {at[b]: accepts[member[b]] for b in order if accepts[member[b]]}
    dead = next((at[b] for b in order if not accepts[member[b]] and all(block[t] == b for t in rows[member[b]])), -1)
    return Automaton(classes, flat, at[int(block[0])], min(rules_of, default=len(flat)), rules_of, dead)


class Scanner:
    """Compiled rules: the combined searching automaton and, per rule, the one of the reversed rule."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        trees = [_Parser(r.pattern, r.fold).alternation() for r in rules]
        self.forward = _compile(trees, search=True)
        self.backward = [_compile([_reversed(t)], search=False) for t in trees]

    def ends(self, text: bytes) -> list[tuple[int, int]]:
        """(rule, end) of every longest match, in order of ends; one step per byte for all rules."""
        a = self.forward
        table, state, accepting, out = a.table, a.start, a.accepting, []
        open_rules: tuple[int, ...] = ()
        for i, c in enumerate(text.translate(a.classes)):
            state = table[state + c]
            if state >= accepting or open_rules:
                matched = a.rules_of.get(state, ())
                out.extend((r, i) for r in open_rules if r not in matched)
                open_rules = matched
        out.extend((r, len(text)) for r in open_rules)
        return out

    def start(self, rule: int, text: bytes, end: int, floor: int) -> int | None:
        """Leftmost start at or after ``floor`` of a match of the rule that ends at ``end``."""
        a = self.backward[rule]
        state, best = a.start, None
        for i in range(end - 1, floor - 1, -1):
            state = a.table[state + a.classes[text[i]]]
            if state >= a.accepting:
                best = i
            elif state == a.dead:
                break
        return best

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) in bytes, ordered by start, then rule."""
        floor, out = [0] * len(self.rules), []
        for rule, end in self.ends(text):
            start = self.start(rule, text, end, floor[rule])
            if start is not None:
                floor[rule] = end
                keep = self.rules[rule].keep
                if keep is None or keep(text[start:end]):
                    out.append((start, rule, end))
        return sorted(out)


@cache
def scanner() -> Scanner:
    """This worker's compiled standard rules."""
    return Scanner(RULES)


def find(text: str, model: Scanner | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, ordered by start, then rule."""
    model, raw = model or scanner(), text.encode()
    spans = model.spans(raw)
    if spans and len(raw) != len(text):
        code = np.cumsum(np.append(0, (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
        spans = [(int(code[a]), r, int(code[b])) for a, r, b in spans]
    return [(model.rules[r].kind, a, b) for a, r, b in spans]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        found = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t)] if t else [] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kinds)], names=[ROW, "spans"])


def with_spans(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row as ``doc`` with ``spans``: kind, start and end (code points, end exclusive) of each secret.

    Null and empty texts have none. Overlapping spans of different kinds are all given.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias(ROW)
    rows = docs.select(row, F.col(f"`{text_col}`").alias("text"))
    return map_batches(rows, _scan, f"{schema_of(rows.select(ROW))}, spans: array<struct<kind: string, start: int, end: int>>")


def redacted(text: str) -> str:
    """The text with every secret replaced by its kind in brackets."""
    out, at = [], 0
    for kind, a, b in find(text):
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def digest(spans: list[tuple[str, int, int]]) -> str:
    """Lower-case hex of the joined spans."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
