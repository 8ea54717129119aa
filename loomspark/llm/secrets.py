"""Secret scan: one pass of a combined automaton over the bytes of each text finds where any rule is triggered.

The combined automaton reads the triggers of all rules, unanchored. Where it accepts, a reversed automaton of that rule
walks back to the start, no further than the end of the rule's last match, and an anchored one reads on to the longest
end. So spans are the leftmost non-overlapping matches of each rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import compile_rules
from .common import id_type, map_batches, named, whole_text


@dataclass(frozen=True)
class Rule:
    """A match counts if it is at least least_length long and, from the trigger's last byte on, least_value.

    trigger is what the combined automaton looks for: a first part of every match that counts, from the match's start.
    """

    kind: str
    pattern: str
    trigger: str
    least_length: int = 0
    least_value: int = 0
    base: bool = False


_ASSIGNED = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]"""
#: The first three are fixed values of the contract; the others are public formats of well-known credentials.
RULES = (
    Rule("assign", _ASSIGNED + "+", _ASSIGNED, least_value=6, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]", least_length=20, base=True),
    Rule("hex", r"[0-9a-f]+", r"[0-9a-f]{24}", least_length=24, base=True),
    Rule("hub", r"gh[oprsu]_[A-Za-z0-9]+", r"gh[oprsu]_[A-Za-z0-9]", least_length=40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", r"xox[abprs]-[A-Za-z0-9-]", least_length=20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]"),
    Rule("private", r"-----BEGIN( [A-Z0-9]+)* PRIVATE KEY-----", r"-----BEGIN( [A-Z0-9]+)* PRIVATE KEY-----"),
)

#: UTF-8 bytes that don't begin a character.
_INNER = bytes(range(0x80, 0xC0))


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        self.all = compile_rules([r.trigger for r in rules], anchored=False)
        self.back = [compile_rules([r.trigger], anchored=True, reverse=True) for r in rules]
        self.ahead = [compile_rules([r.pattern], anchored=True) for r in rules]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule number, end) in code points, end exclusive, in order."""
        table, state, first, accepts = self.all.table, self.all.start, self.all.first, self.all.accepts
        done = [0] * len(self.rules)
        found = []
        for i, b in enumerate(data):
            state = table[state + b]
            if state >= first:
                for k in accepts[state]:
                    if i >= done[k] and (span := self._resolve(k, data, i, done[k])):
                        start, end = span
                        done[k] = end
                        rule = self.rules[k]
                        if end - start >= rule.least_length and end - i >= rule.least_value:
                            found.append((start, k, end))
        found.sort()
        if found and not data.isascii():
            found = self._in_characters(data, found)
        return found

    def _resolve(self, k: int, data: bytes, last: int, floor: int) -> tuple[int, int] | None:
        """The longest match of rule k that starts at floor or later and whose trigger ends with byte `last`."""
        back, start = self.back[k], -1
        state = back.start
        for i in range(last, floor - 1, -1):
            state = back.table[state + data[i]]
            if state == back.dead:
                break
            if state >= back.first:
                start = i
        if start < 0:
            return None
        ahead, end = self.ahead[k], last + 1
        state = ahead.start
        for i in range(start, len(data)):
            state = ahead.table[state + data[i]]
            if state == ahead.dead:
                break
            if state >= ahead.first:
                end = i + 1
        return start, end

    @staticmethod
    def _in_characters(data: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        at, characters, place = 0, 0, {}
        for x in sorted({x for start, _, end in found for x in (start, end)}):
            characters += len(data[at:x].translate(None, _INNER))
            at = place[x] = x
            place[x] = characters
        return [(place[start], k, place[end]) for start, k, end in found]


@cache
def scanner() -> Scanner:
    """One for each worker."""
    return Scanner()


def _labelled(found: list[tuple[int, int, int]], only_base: bool) -> str:
    return ",".join(f"{RULES[k].kind}:{start}:{end}" for start, k, end in found if RULES[k].base or not only_base)


def _scan(batches):
    scan = scanner()
    for batch in batches:
        texts = batch.column("text")
        found = [scan.spans(t.as_py()) for t in texts]
        counts = [pa.array([sum(k == j for _, k, _ in x) for x in found], pa.int64()) for j in range(len(RULES))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *counts[:3], pa.array([_labelled(x, True) for x in found], pa.string()), pa.array([_labelled(x, False) for x in found], pa.string()), *counts[3:]],
            ["id", *(f"n_{r.kind}" for r in RULES[:3]), "base_spans", "spans", *(f"n_{r.kind}" for r in RULES[3:])],
        )


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, n_<kind> of each base rule, base_spans, spans, n_<kind> of each further rule.

    Spans are kind:start:end in code points, end exclusive, by start and then rule order, joined by commas. A null or
    empty text has none. Rows are independent: repeated rows repeat, a null id stays null, an empty table gives none. A
    very long text is read whole, a byte at a time, in no more space than itself and its spans.
    """
    kinds = [f"n_{r.kind} long" for r in RULES]
    schema = ", ".join([f"id {id_type(docs, id_col)}", *kinds[:3], "base_spans string", "spans string", *kinds[3:]])
    pairs = docs.select(F.col(id_col).alias("id"), whole_text(text_col).cast("binary").alias("text"))
    return map_batches(pairs, _scan, schema).withColumnRenamed("id", id_col)


def redacted(text: str, found: list[tuple[int, int, int]]) -> str:
    """text with each span replaced by [kind]; spans that overlap are replaced as one, by the first one's kind."""
    merged: list[list[int]] = []
    for start, k, end in found:
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([start, k, end])
    out, at = [], 0
    for start, k, end in merged:
        out += [text[at:start], f"[{RULES[k].kind}]"]
        at = end
    return "".join([*out, text[at:]])


def _redact(batches):
    scan = scanner()
    for batch in batches:
        texts = []
        for text in batch.column("_text").to_pylist():
            found = scan.spans(text.encode()) if text else []
            texts.append(redacted(text, found) if found else text)
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == "_text" else batch.column(n) for n in names], names)


def without_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every span that secret_scan finds replaced by its kind in brackets; null texts stay null."""
    plain = docs.select(*(named(c).alias("_text" if c == text_col else f"_{k}") for k, c in enumerate(docs.columns)))
    schema = ", ".join(f"{c} {t}" for c, t in plain.dtypes)
    return map_batches(plain, _redact, schema).toDF(*docs.columns)

