"""Secret scans by one deterministic automaton for all rules.

The rules' regular expressions are compiled together: Thompson's construction, subset construction over the bytes that
the rules tell apart, Hopcroft's minimisation, and the result laid out as one transition array. A text is read once, byte
by byte, whatever the number of rules; the states passed tell which rules match at all. Only for those is the text
read again, by the rule's own expression, for the exact spans.

Spans are code points, end exclusive, leftmost and non-overlapping per rule; a match whose secret part is shorter than the
rule asks for is consumed and dropped.

Defined results: a null text is empty and has no spans; null ids, repeated ids and repeated rows each keep a row; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import re._constants as ops
import re._parser as parser
from array import array
from collections import deque
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateflow.llm.base import slices


@dataclass(frozen=True)
class Rule:
    """A kind of secret: an ASCII expression, and how long its group `part` must be.

    The automaton counts repeats only for rules that are `counted`, having nothing else to be told by. Of the others it
    holds the expression up to the first character of the first repeated secret part: a match has that too, and to be
    within many such parts at a time would multiply the states of all rules with one another. Nor does it need `rest`, what
    belongs to a match behind the expression; that may be empty, and be any expression of Python's.
    """

    kind: str
    pattern: str
    part: int = 0
    least: int = 1
    any_case: bool = False
    counted: bool = False
    rest: str = ""

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern + self.rest, re.ASCII | (re.IGNORECASE if self.any_case else 0))


#: The base rules.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32, counted=True),
)
# What the body of a private key consists of: marks of quoting, escapes and line breaks, header fields, and long stretches of
# base64, each followed by a short one at most, as the last line may be. Prose has no such stretches, so it belongs to no key.
_BETWEEN, _FIELD = r"(?:\\[nrt]|[\\\s>#*|\"'+,])", r"(?:Proc-Type|DEK-Info):[^\n\\]*+"
_LONG, _SHORT = r"[A-Za-z0-9+/=]{20,}+", r"[A-Za-z0-9+/=]{1,19}+"
#: A private key behind its header, up to its end line. If anything but a body comes before that, or it is missing, what
#: there is of a body: fields, long stretches, a short line after one, and what the text ends with.
KEY_BODY = (
    rf"(?:(?:{_BETWEEN}*+(?:{_FIELD}|{_LONG}(?:{_BETWEEN}++{_SHORT}(?![A-Za-z0-9+/=]))?+))*+"
    rf"(?:{_BETWEEN}*+{_SHORT}(?![A-Za-z0-9+/=]))?+{_BETWEEN}*+-----END [A-Z ]*PRIVATE KEY-----"
    rf"|(?:{_BETWEEN}*+(?:{_FIELD}|{_LONG}(?:(?:\r?\n|\\n)[ \t]*+{_SHORT}(?=[ \t\r]*+(?:[\"'\n\\]|\Z)))?+)|\s*+[A-Za-z0-9+/=]++\Z)*+)"
)
#: Well-known formats beyond them.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", rest=KEY_BODY),
)
RULES = BASE + MORE


class _Nfa:
    """Thompson automaton: byte edges and empty edges between numbered states."""

    def __init__(self):
        self.counts, self.cut = True, False
        self.edges: list[tuple[frozenset[int], int] | None] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append(None)
        self.empty.append([])
        return len(self.edges) - 1

    def sequence(self, items, start: int, fold: bool) -> int:
        for item in items:
            start = self.item(item, start, fold)
            if self.cut:
                break
        return start

    def item(self, item, start: int, fold: bool) -> int:
        op, value = item
        if op in (ops.LITERAL, ops.IN):
            members = _members([item] if op is ops.LITERAL else value)
            if fold:
                members |= {ord(chr(b).swapcase()) for b in members if chr(b).isalpha()}
            end = self.state()
            self.edges[start] = (frozenset(members), end)
            return end
        if op is ops.SUBPATTERN:
            return self.sequence(value[3], start, fold)
        if op is ops.BRANCH:
            end = self.state()
            for branch in value[1]:
                first = self.state()
                self.empty[start].append(first)
                self.empty[self.sequence(branch, first, fold)].append(end)
            return end
        if op is ops.MAX_REPEAT:
            least, most, body = value
            if least and (most > 1) and not self.counts:
                end = self.sequence(body, start, fold)
                self.cut = True
                return end
            for _ in range(least):
                start = self._joint(self.sequence(body, start, fold))
            if most is ops.MAXREPEAT:
                first, end = self.state(), self.state()
                self.empty[start] += [first, end]
                self.empty[self.sequence(body, first, fold)] += [first, end]
                return self._joint(end)
            end = self.state()
            for _ in range(most - least):
                first = self.state()
                self.empty[start] += [first, end]
                start = self._joint(self.sequence(body, first, fold))
            self.empty[start].append(end)
            return self._joint(end)
        raise ValueError(f"rules may not use {op}")

    def _joint(self, state: int) -> int:
        """A fresh state behind `state`, so that each state has one byte edge at most."""
        after = self.state()
        self.empty[state].append(after)
        return after

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for after in self.empty[todo.pop()]:
                if after not in seen:
                    seen.add(after)
                    todo.append(after)
        return frozenset(seen)


def _members(items) -> set[int]:
    members: set[int] = set()
    for op, value in items:
        if op is ops.LITERAL:
            members.add(value)
        elif op is ops.RANGE:
            members.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"rules may not use {op} in a class")
    if members and max(members) > 127:
        raise ValueError("rules are ASCII")
    return members


class Automaton:
    """The minimal deterministic automaton that finds where any rule's match ends, in one pass.

    `step` is one array: the state, a multiple of 256, plus a byte gives the next state. States from `flagged` on end a match
    of the rules in `rules[state >> 8]`, a bit set.
    """

    def __init__(self, rules: tuple[Rule, ...]):
        nfa = _Nfa()
        root = nfa.state()
        ends: dict[int, int] = {}
        for bit, rule in enumerate(rules):
            first = nfa.state()
            nfa.empty[root].append(first)
            nfa.counts, nfa.cut = rule.counted, False
            ends[nfa.sequence(parser.parse(_scan_form(rule), re.ASCII), first, rule.any_case)] = 1 << bit
        classes, of_byte = self._classes(nfa)
        begin = nfa.closure([root])
        numbers, order, moves = {begin: 0}, [begin], []
        for states in order:
            row = []
            for byte in classes:
                after = nfa.closure([e[1] for s in states if (e := nfa.edges[s]) and byte in e[0]] + [root])
                if after not in numbers:
                    numbers[after] = len(order)
                    order.append(after)
                row.append(numbers[after])
            moves.append(row)
        marks = [sum({ends[s] for s in states if s in ends}) for states in order]
        block = _minimised(moves, marks)
        # Unflagged states come first, the state of an empty text at 0.
        blocks = sorted(set(block), key=lambda b: (marks[block.index(b)] > 0, block.index(b)))
        number = {b: i for i, b in enumerate(blocks)}
        self.states = len(blocks)
        self.rules = [marks[block.index(b)] for b in blocks]
        self.flagged = 256 * sum(not mark for mark in self.rules)
        self.step = array("i", [0]) * (256 * self.states)
        for b in blocks:
            row = moves[block.index(b)]
            for byte in range(256):
                self.step[256 * number[b] + byte] = 256 * number[block[row[of_byte[byte]]]]

    @staticmethod
    def _classes(nfa: _Nfa) -> tuple[list[int], list[int]]:
        """One byte for each set of bytes that no edge tells apart, and the class of every byte."""
        kinds: dict[tuple, int] = {}
        of_byte, examples = [], []
        sets = [e[0] for e in nfa.edges if e]
        for byte in range(256):
            key = tuple(byte in members for members in sets)
            if key not in kinds:
                kinds[key] = len(examples)
                examples.append(byte)
            of_byte.append(kinds[key])
        return examples, of_byte

    def scan(self, data: bytes) -> int:
        """The rules that match somewhere, as a bit set."""
        step, flagged, state, found, rules = self._fast, self.flagged, 0, 0, self.rules
        for byte in data:
            state = step[state + byte]
            if state >= flagged:
                found |= rules[state >> 8]
        return found

    @property
    def _fast(self) -> list[int]:
        if not hasattr(self, "_list"):
            self._list = self.step.tolist()  # list items need no boxing
        return self._list


def _scan_form(rule: Rule) -> str:
    """The expression with a counted rule's least length in it: a run of one class is long enough if it has that many."""
    return f"{rule.pattern[:-1]}{{{rule.least},}}" if rule.counted and rule.pattern.endswith("]+") else rule.pattern


def _minimised(moves: list[list[int]], marks: list[int]) -> list[int]:
    """Hopcroft: the block of every state."""
    inverse: list[dict[int, list[int]]] = [{} for _ in moves[0]]
    for state, row in enumerate(moves):
        for kind, after in enumerate(row):
            inverse[kind].setdefault(after, []).append(state)
    members: list[set[int]] = []
    for mark in sorted(set(marks)):
        members.append({s for s, m in enumerate(marks) if m == mark})
    block = [0] * len(moves)
    for b, states in enumerate(members):
        for s in states:
            block[s] = b
    todo = deque((b, kind) for b in range(len(members)) for kind in range(len(moves[0])))
    waiting = set(todo)
    while todo:
        splitter = todo.popleft()
        waiting.discard(splitter)
        b, kind = splitter
        before: dict[int, set[int]] = {}
        for after in members[b]:
            for state in inverse[kind].get(after, ()):
                before.setdefault(block[state], set()).add(state)
        for split, inside in before.items():
            if len(inside) == len(members[split]):
                continue
            members[split] -= inside
            members.append(inside)
            new = len(members) - 1
            for s in inside:
                block[s] = new
            for k in range(len(moves[0])):
                smaller = new if (split, k) in waiting or len(inside) <= len(members[split]) else split
                if (smaller, k) not in waiting:
                    waiting.add((smaller, k))
                    todo.append((smaller, k))
    return block


def spans_of(text: str, rules: tuple[Rule, ...], automaton: Automaton) -> list[tuple[int, int, int]]:
    """(start, rule, end) of every match, by start, then rule."""
    found = automaton.scan(text.encode("utf-8", "surrogatepass"))
    result = []
    for number, rule in enumerate(rules):
        if found >> number & 1:
            for match in rule.compiled().finditer(text):
                if match.end(rule.part) - match.start(rule.part) >= rule.least:
                    result.append((match.start(), number, match.end()))
    return sorted(result)


_automata: dict[tuple[Rule, ...], Automaton] = {}


def _automaton(rules: tuple[Rule, ...]) -> Automaton:
    if rules not in _automata:
        _automata[rules] = Automaton(rules)
    return _automata[rules]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans): the spans of each document as an array of (kind, start, end), by start, then in the order of the rules."""
    schema = pa.schema([("id", pa.int64()), ("spans", _SPANS)])

    def scan(batches):
        automaton = _automaton(rules)
        for ids, texts in slices(batches):
            found = [[{"kind": rules[r].kind, "start": s, "end": e} for s, r, e in spans_of(t or "", rules, automaton)] for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, _SPANS)], schema=schema)

    picked = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(scan, "id long, spans array<struct<kind: string, start: int, end: int>>").withColumnRenamed("id", id)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """`docs` with every span of its texts replaced by `[kind]`, where spans overlap by the first one's; other columns stay."""
    names = docs.columns
    place = names.index(text)

    def mask(batches):
        automaton = _automaton(rules)
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                texts = [None if t is None else _masked(t, spans_of(t, rules, automaton), rules) for t in part.column(place).to_pylist()]
                yield part.set_column(place, part.schema.field(place), pa.array(texts, part.schema.field(place).type))

    return docs.mapInArrow(mask, docs.schema)


def _masked(text: str, spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    parts, end, at = [], 0, 0
    while at < len(spans):
        start, rule, stop = spans[at]
        while at + 1 < len(spans) and spans[at + 1][0] < stop:
            at += 1
            stop = max(stop, spans[at][2])
        parts += [text[end:start], f"[{rules[rule].kind}]"]
        end, at = stop, at + 1
    return "".join(parts) + text[end:]
