"""License scan: ordered signature rules, gated by keywords, overlaps resolved by priority and containment.

A rule is a hand-written pattern with a label, a priority and a keyword (see ``license_rules``). Whole sentences of
licence texts come before names with a version, those before plain names, and those before tags. A rule is tried only where
every word of its keyword stands in the text, so a text without them costs a few substring searches. A detection that lies inside
one of a higher priority, or inside a longer one of the same priority (of equal ones, the first rule's counts), is suppressed.
Base phrases are rules that nothing suppresses, and all their places are kept.

Everything is map-only over whole texts: no shuffle, and a text meets its rules in the task that reads it.

Words are runs of digits, letters and non-ASCII characters after A-Z are lowered; positions count words from 0.

Defined cases: a null or empty text has no words, no detections, empty labels and a score of 0; rows that repeat stand for
themselves; a null id is kept; an empty table gives no rows; a text may have any length; further columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cadence.llm import license_rules, words
from cadence.llm.tables import only

#: Phrases whose places are all kept, and their labels. Fixed values.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: How far one detection of a rule's kind speaks for its label, by priority from tags up.
WEIGHTS = (0.5, 0.7, 0.85, 0.95)

_WORD = rb"[0-9a-z\x80-\xff]"
_GAP = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]++"
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_PARTS = {" V ": _GAP + rb"(?:(?:version|ver|v)(?:" + _GAP + rb")?)?", " ?V ": rb"(?:" + _GAP + rb")?(?:(?:version|ver|v)(?:" + _GAP + rb")?)?", " .. ": rb"(?:" + _GAP + _WORD + rb"++){0,8}?" + _GAP, " ?": rb"(?:" + _GAP + rb")?", " ": _GAP, "LIC": rb"licen[cs]e"}
_SPLIT = re.compile(r"( \?V | V | \.\. | \?| |LIC)")


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    gate: tuple[bytes, ...]
    pattern: re.Pattern[bytes]


def compiled(pattern: str) -> re.Pattern[bytes]:
    body = b"".join(_PARTS[p] if p in _PARTS else p.encode() for p in _SPLIT.split(pattern))
    return re.compile(rb"(?<!" + _WORD + rb")(?:" + body + rb")(?!" + _WORD + rb")")


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, in order."""
    out = []
    for priority, table in ((3, license_rules.TEXTS), (2, license_rules.VARIANTS), (1, license_rules.NAMES), (0, license_rules.TAGS)):
        for line in table.strip().splitlines():
            label, keyword, pattern = (x.strip() for x in line.split(" | "))
            gate = tuple(sorted(keyword.encode().decode("unicode_escape").encode("latin-1").split(), key=len, reverse=True))
            out.append(Rule(label, priority, gate, compiled(pattern)))
    for name in license_rules.IDENTIFIERS.split():
        out.append(Rule(name, 2, (b"spdx",), compiled(f"spdx LIC identifier {re.sub(r'[-.]', ' ', name)}( or later| only)?")))
    return tuple(out)


@cache
def _gated() -> tuple[tuple[bytes, tuple[tuple[int, Rule], ...]], ...]:
    groups = defaultdict(list)
    for i, rule in enumerate(rules()):
        groups[rule.gate[0]].append((i, rule))
    return tuple((word, tuple(group)) for word, group in groups.items())


@cache
def _base() -> tuple[tuple[str, tuple[bytes, ...], re.Pattern[bytes]], ...]:
    return tuple((label, tuple(phrase.encode().split()), compiled(phrase)) for phrase, label in BASE.items())


Found = tuple[int, int, int, int, str]


def detections(text: bytes) -> Iterator[Found]:
    """(start, end, priority, order of the rule, label) of every rule that matches a text in lower case, in bytes."""
    for word, group in _gated():
        if word in text:
            for i, rule in group:
                if all(w in text for w in rule.gate[1:]):
                    for m in rule.pattern.finditer(text):
                        yield m.start(), m.end(), rule.priority, i, rule.label


def resolved(found: Iterable[Found]) -> list[Found]:
    """What is left after suppression, by place. One pass by start: a detection is contained where an earlier one reaches as far."""
    reach = [-1] * len(WEIGHTS)
    out = []
    for d in sorted(found, key=lambda d: (d[0], -d[1], -d[2], d[3])):
        if max(reach[d[2] :]) < d[1]:
            out.append(d)
        reach[d[2]] = max(reach[d[2]], d[1])
    return out


def scan_text(text: bytes) -> tuple[int, list[tuple[int, str]], list[tuple[int, int, int, str]]]:
    """Number of words, (first word, label) of the base phrases' places, (first word, end word, priority, label) of detections."""
    text = text.lower()
    inside = np.concatenate(([False], _IN_WORD[np.frombuffer(text, np.uint8)]))
    starts = np.flatnonzero(inside[1:] & ~inside[:-1])
    base = []
    for label, gate, pattern in _base():
        if all(w in text for w in gate):
            base += [(int(np.searchsorted(starts, m.start())), label) for m in pattern.finditer(text)]
    found = [(int(np.searchsorted(starts, s)), int(np.searchsorted(starts, e)), p, label) for s, e, p, _, label in resolved(detections(text))]
    return len(starts), sorted(base), found


def score(labels: Iterable[tuple[str, int]]) -> float:
    """How likely a text states a licence: one minus the chance that all of its labels, each at its best priority, are mistaken."""
    best: dict[str, int] = {}
    for label, priority in labels:
        best[label] = max(best.get(label, 0), priority)
    wrong = 1.0
    for label in sorted(best):
        wrong *= 1 - WEIGHTS[best[label]]
    return 1 - wrong


_SPANS = pa.list_(pa.struct([("label", pa.string()), ("priority", pa.int32()), ("first", pa.int64()), ("end", pa.int64())]))
SCAN = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<label:string, priority:int, first:long, end:long>>"
_ARROW = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), _SPANS)


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: words, base places, their first and last word, base labels, all labels, score, and the detections left."""
    names = [c.split()[0] for c in SCAN.split(", ")[:8]] + ["detections"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = words.buffers(batch["text"])
            out = []
            for i, doc in enumerate(batch["doc_id"].to_pylist()):
                n, base, found = scan_text(data[at[i] : at[i + 1]].tobytes())
                spans = [{"label": label, "priority": p, "first": a, "end": b} for a, b, p, label in found]
                own = {label for _, label in base}
                every = sorted(own | {label for *_, label in found})
                sure = score([(label, 1) for label in own] + [(label, p) for _, _, p, label in found])
                out.append((doc, n, len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted(own)), ",".join(every), sure, spans))
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _ARROW, strict=True)], names)

    rows = only(docs, doc_id=id, text=text)
    return rows.select(rows["doc_id"].cast("long").alias("doc_id"), rows["text"].cast("string").alias("text")).mapInArrow(of, SCAN)
