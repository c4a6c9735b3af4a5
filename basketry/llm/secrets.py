"""Secret scan with one deterministic automaton for all rules.

Each rule is a regular expression over bytes. The compiler keeps the threads of a rule
in order of preference, as a leftmost, greedy matcher tries them; a set of threads is a
state (subset construction), the states of all rules side by side are a state of the
combined automaton, and states that no input tells apart are merged. What remains is one
array ``next[state, byte]`` and one array of the rules whose match ended just before the
byte. A task reads each byte once, for all rules.

The scan is vectorised: the bytes of a batch are cut into lanes of equal length that
advance together. A lane starts as if nothing preceded it; lanes whose predecessor ended
in another state are run again from that state until they meet the recorded states.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from basketry.llm.tasks import map_arrow, table, texts_of

SEPARATOR = 0xFF  # never part of UTF-8
MATCH = -1
BLOCK_BYTES = 4 << 20
LANE_BYTES = 2048


@dataclass(frozen=True)
class Rule:
    """``least`` characters in ``group`` are needed, other matches are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


# Kinds, patterns and least lengths. A run of 16 or more hexadecimal digits
# is what "[0-9a-f]+" leaves when shorter matches are dropped.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),
    Rule("repository", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)


class _Program:
    """Ordered threads of one rule: ``sets[i]`` are the bytes that lead on to ``after[i]``,
    ``forks[i]`` are tried in order without reading."""

    def __init__(self, pattern: str, backwards: bool = False):
        self.sets: list[frozenset[int] | None] = []
        self.after: list[int] = []
        self.forks: list[list[int]] = []
        self.backwards = backwards
        self.start = self._sequence(parser.parse(pattern), MATCH, 0)

    def _add(self, bytes_: frozenset[int] | None, after: int, forks: list[int]) -> int:
        self.sets.append(bytes_)
        self.after.append(after)
        self.forks.append(forks)
        return len(self.sets) - 1

    def _sequence(self, items, then: int, flags: int) -> int:
        for kind, value in items if self.backwards else reversed(list(items)):
            then = self._item(kind, value, then, flags)
        return then

    def _item(self, kind, value, then: int, flags: int) -> int:
        if kind is op.LITERAL:
            return self._add(self._either_case({value}, flags), then, [])
        if kind is op.IN:
            found: set[int] = set()
            for what, x in value:
                if what is op.LITERAL:
                    found.add(x)
                elif what is op.RANGE:
                    found.update(range(x[0], x[1] + 1))
                else:
                    raise ValueError(f"not supported in a class: {what}")
            return self._add(self._either_case(found, flags), then, [])
        if kind is op.SUBPATTERN:
            _, added, removed, inner = value
            return self._sequence(inner, then, (flags | added) & ~removed)
        if kind is op.BRANCH:
            return self._add(None, then, [self._sequence(x, then, flags) for x in value[1]])
        if kind is op.MAX_REPEAT:
            least, most, inner = value
            if most is op.MAXREPEAT:
                loop = self._add(None, then, [])
                self.forks[loop] = [self._sequence(inner, loop, flags), then]
                then = loop
            else:
                end = then
                for _ in range(most - least):
                    then = self._add(None, then, [self._sequence(inner, then, flags), end])
            for _ in range(least):
                then = self._sequence(inner, then, flags)
            return then
        raise ValueError(f"not supported: {kind}")

    @staticmethod
    def _either_case(found: set[int], flags: int) -> frozenset[int]:
        if max(found) > 127:
            raise ValueError("rules are over ASCII characters")
        if flags & re.IGNORECASE.value:
            letters = {chr(c) for c in found if chr(c).isalpha()}
            found = found | {ord(c) for x in letters for c in (x.lower(), x.upper())}
        return frozenset(found)

    def closure(self, threads: list[int]) -> tuple[int, ...]:
        """Reading threads behind ``threads`` in order, ended by the first match."""
        seen: dict[int, None] = {}
        stack = threads[::-1]
        while stack:
            thread = stack.pop()
            if thread == MATCH:
                return (*(x for x in seen if self.sets[x] is not None), MATCH)
            if thread not in seen:
                seen[thread] = None
                if self.sets[thread] is None:
                    stack.extend(self.forks[thread][::-1])
        return tuple(x for x in seen if self.sets[x] is not None)

    def read(self, threads: tuple[int, ...], byte: int) -> list[int]:
        return [self.after[x] for x in threads if x != MATCH and byte in self.sets[x]]


class _Leftmost:
    """States of one rule: (ordered threads, a match ended before the last byte)."""

    def __init__(self, rule: Rule):
        self.program = _Program(rule.pattern)
        self.rule = rule
        self.idle = self.program.closure([self.program.start])
        if MATCH in self.idle:
            raise ValueError(f"{rule.kind} matches the empty text")
        self.known: dict[tuple, tuple] = {}

    def step(self, state: tuple, byte: int) -> tuple:
        found = self.known.get((state, byte))
        if found is None:
            found = self.known[state, byte] = self._step(state[0], byte)
        return found

    def _step(self, threads: tuple[int, ...], byte: int) -> tuple:
        read = self.program.read(threads, byte)
        ended = False
        if threads[-1] == MATCH:
            after = self.program.closure(read)
            if after and after[-1] != MATCH:
                raise ValueError(f"{self.rule.kind}: a match may go on after a gap")
            if after:
                return after, False
            ended, read = True, self.program.read(self.idle, byte)
        after = self.program.closure([*read, self.program.start])
        return after, ended


@dataclass(frozen=True)
class Automaton:
    """``step[state * 256 + byte]`` is 256 times the next state; bit r of ``ended[state]``
    says that a match of rule r ended before the byte that led to the state."""

    rules: tuple[Rule, ...]
    step: np.ndarray
    ended: np.ndarray


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Automaton:
    """Combined minimal automaton of all rules."""
    parts = [_Leftmost(rule) for rule in rules]
    told: dict[tuple, int] = {}
    classes = np.empty(256, dtype=np.int64)
    for byte in range(256):
        sign = tuple(byte in s for p in parts for s in p.program.sets if s is not None)
        classes[byte] = told.setdefault((sign, byte == SEPARATOR), len(told))
    samples = [int(np.argmax(classes == c)) for c in range(len(told))]

    first = tuple((p.idle, False) for p in parts)
    numbers, order, steps = {first: 0}, [first], []
    for state in order:
        row = []
        for byte in samples:
            after = tuple(p.step(s, byte) for p, s in zip(parts, state))
            if after not in numbers:
                numbers[after] = len(order)
                order.append(after)
            row.append(numbers[after])
        steps.append(row)
    step = np.array(steps)
    ended = np.array([sum(s[1] << r for r, s in enumerate(state)) for state in order])

    _, block = np.unique(ended, return_inverse=True)
    while True:
        _, finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    # The start is state 0.
    block = np.where(block == block[0], 0, np.where(block == 0, block[0], block))
    least = np.zeros((block.max() + 1, len(samples)), dtype=np.int64)
    least[block] = block[step]
    out = np.zeros(block.max() + 1, dtype=np.int64)
    out[block] = ended
    return Automaton(rules, (least[:, classes] * 256).astype(np.int32).ravel(), out)


def _trace(automaton: Automaton, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of matches in ``data``, and the rules (bits) that ended there."""
    size = len(data)
    lanes = max(1, size // LANE_BYTES)
    length = -(-size // lanes)
    padded = np.full(lanes * length, SEPARATOR, dtype=np.uint8)
    padded[:size] = data
    columns = np.ascontiguousarray(padded.reshape(lanes, length).T)
    states = np.empty((length, lanes), dtype=np.int32)
    now = np.zeros(lanes, dtype=np.int32)
    at = np.empty(lanes, dtype=np.int32)
    for i in range(length):
        np.add(now, columns[i], out=at)
        np.take(automaton.step, at, out=states[i], mode="clip")
        now = states[i]

    starts = np.zeros(lanes, dtype=np.int32)
    while True:
        wanted = np.concatenate([[0], states[-1, :-1]]).astype(np.int32)
        lane = np.flatnonzero(wanted != starts)
        if not len(lane):
            break
        starts = wanted
        now = wanted[lane]
        for i in range(length):
            now = automaton.step[now + columns[i, lane]]
            moved = now != states[i, lane]
            if not moved.all():
                lane, now = lane[moved], now[moved]
                if not len(lane):
                    break
            states[i, lane] = now

    bits = np.repeat(automaton.ended, 1)
    rows, lane = np.nonzero((bits != 0)[states >> 8])
    ends = lane * length + rows
    order = np.argsort(ends)
    return ends[order], bits[states[rows, lane] >> 8][order]


class Scanner:
    """Spans of all rules in many texts at once."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.exact = [re.compile(r.pattern.encode()) for r in automaton.rules]
        self.back = [_Program(r.pattern, backwards=True) for r in automaton.rules]
        self.known: list[dict] = [{} for _ in automaton.rules]

    def _start(self, rule: int, data: bytes, lowest: int, end: int) -> int:
        """Leftmost start of a match of the rule that ends at ``end``."""
        program, known = self.back[rule], self.known[rule]
        threads, found, i = program.closure([program.start]), end, end
        while i > lowest:
            i -= 1
            key = (threads, data[i])
            if key not in known:
                # Backwards all threads count, so the first match cuts none off.
                read = program.read(threads, data[i])
                closed = [program.closure([x]) for x in read]
                known[key] = tuple(sorted({t for c in closed for t in c}))
            threads = known[key]
            if not threads:
                break
            if threads[0] == MATCH:
                found = i
        return found

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, rule, end) in bytes, sorted."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        low = 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size + len(texts[high]) < BLOCK_BYTES):
                size += len(texts[high]) + 1
                high += 1
            self._block(texts, low, high, found)
            low = high
        return found

    def _block(self, texts, low, high, found) -> None:
        data = b"\xff".join(texts[low:high]) + b"\xff"
        sizes = np.fromiter((len(t) + 1 for t in texts[low:high]), np.int64, high - low)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        ends, bits = _trace(self.automaton, np.frombuffer(data, dtype=np.uint8))
        owners = np.searchsorted(offsets, ends, side="right") - 1
        last = [0] * len(self.automaton.rules)
        for end, mask, owner in zip(ends.tolist(), bits.tolist(), owners.tolist()):
            offset = int(offsets[owner])
            for r, rule in enumerate(self.automaton.rules):
                if mask >> r & 1:
                    start = self._start(r, data, max(offset, last[r]), end)
                    last[r] = end
                    long = end - start
                    if rule.group:
                        long = len(self.exact[r].fullmatch(data, start, end).group(rule.group))
                    if long >= rule.least:
                        found[low + owner].append((start - offset, r, end - offset))
        for spans in found[low:high]:
            spans.sort()


def _code_points(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if text.isascii():
        return spans
    heads = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(heads)])
    return [(int(before[s]), r, int(before[e])) for s, r, e in spans]




def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document with its secrets as spans ``kind:start:end`` in code points.

    A null or empty text has no spans. Repeated rows are scanned as they come, a null id
    stays null, and columns other than ``doc_id`` and ``text`` are not read. Base rules
    are counted and digested alone; ``spans`` holds those of all rules. The scan is a
    narrow map: no shuffle, and a lost executor costs the tasks it ran.
    """
    automaton = compile_rules(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        scanner = Scanner(automaton)
        for batch in batches:
            texts = texts_of(batch)
            out: dict = {name: [] for name in ("base_sha256", "spans")}
            counts = {r: [0] * len(texts) for r, rule in enumerate(rules) if rule.base}
            for i, spans in enumerate(scanner.scan(texts)):
                spans = _code_points(texts[i], spans)
                named = [f"{rules[r].kind}:{s}:{e}" for s, r, e in spans]
                base = [x for x, (_, r, _) in zip(named, spans) if rules[r].base]
                for _, r, _ in spans:
                    if rules[r].base:
                        counts[r][i] += 1
                out["base_sha256"].append(hashlib.sha256(",".join(base).encode()).hexdigest())
                out["spans"].append(",".join(named))
            yield {
                "doc_id": batch.column("doc_id"),
                **out,
                **{f"n_{rules[r].kind}": counts[r] for r in counts},
            }

    counted = ", ".join(f"n_{r.kind} long" for r in rules if r.base)
    schema = f"doc_id long, {counted}, base_sha256 string, spans string"
    return map_arrow(docs.select("doc_id", "text"), schema, run)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))
