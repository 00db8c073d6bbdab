"""Secret scan: all rules in one byte pass of a combined deterministic automaton.

The automaton tells where a match of a rule ends; from the last end of each unbroken run, the same rule's automaton
over reversed bytes finds the leftmost start behind the rule's previous match. Matches are leftmost, greedy and don't
overlap within a rule. Matches that are too short are dropped afterwards.

Defined cases: a null or empty text has no spans. Repeated rows are scanned one by one; an empty table gives an empty
result. Offsets count code points, ends are exclusive. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rangelake.llm.automaton import Automaton, compile_patterns
from rangelake.llm.shared import steps

# Kind, pattern, letters in either case, least length in bytes of a match (of an assignment: of its value).
# Base kinds first, in their order; then public token formats. Lengths are tested behind the automaton: counting in it
# would multiply its states. The one exception are hex runs, as every a to f would end a match of an uncounted rule;
# matches are whole runs there, so none gets lost. A rule that ends in a run doubles the states, so extra kinds are few.
BASE = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=\-]+""", True, 6),
    ("access", r"AKIA[A-Z0-9]+", False, 20),
    ("hex", r"[0-9a-f]{24,}", False, 24),
)
EXTRA = (
    ("github", r"gh[pousr]_[A-Za-z0-9]+", False, 40),
    ("google", r"AIza[A-Za-z0-9_\-]+", False, 39),
    ("pem", r"\-\-\-\-\-BEGIN ([A-Z]+ )*PRIVATE KEY\-\-\-\-\-", False, 0),
)
KINDS = tuple(rule[0] for rule in BASE + EXTRA)
LEAST = tuple(rule[3] for rule in BASE + EXTRA)


@cache
def automata() -> tuple[Automaton, list[Automaton]]:
    """The combined automaton, and each rule's own over reversed bytes."""
    rules = [(pattern, fold) for _, pattern, fold, _ in BASE + EXTRA]
    return compile_patterns(rules), [compile_patterns([r], search=False, backwards=True) for r in rules]


def long_enough(match: bytes, kind: int) -> bool:
    """Whether the match, or an assignment's value behind the first : or =, blanks and a quote, has its least length."""
    if kind:
        return len(match) >= LEAST[kind]
    at = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0) + 1
    rest = match[at:].lstrip(b" ")
    return len(rest[1:] if rest[:1] in (b'"', b"'") else rest) >= LEAST[0]


def spans(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, kind, begin, end) in bytes from the text's begin, of all rules over data[begins[i]:ends[i]]."""
    forward, reversed_ = automata()
    at, states = forward.scan(data, begins, ends)
    if not len(at):
        return []
    owner = np.searchsorted(begins, at, side="right") - 1
    while len(late := np.flatnonzero(at >= ends[owner])):  # empty texts share their begin with the next
        owner[late] -= 1
    masks, out = forward.accepts[states], []
    for k in range(len(KINDS)):
        mine = np.flatnonzero(masks & (1 << k))
        if not len(mine):
            continue
        p, o = at[mine], owner[mine]
        last = np.append((np.diff(p) != 1) | (np.diff(o) != 0), True)
        previous, previous_owner = 0, -1
        for end, text in zip((p[last] + 1).tolist(), o[last].tolist(), strict=True):
            begin = int(begins[text])
            floor = previous if text == previous_owner else begin
            length = reversed_[k].longest(data[floor:end][::-1].tobytes())
            if length > 0:
                previous, previous_owner = end, text
                if long_enough(data[end - length : end].tobytes(), k):
                    out.append((text, k, end - length - begin, end - begin))
    return out


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        texts = batch.column("text").fill_null("")
        texts = texts.cast(pa.large_string()) if texts.type != pa.large_string() else texts
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None and len(texts) else np.zeros(0, np.uint8)
        bounds = offsets - offsets[0] if len(offsets) else offsets
        begins, ends = bounds[:-1], bounds[1:]
        found: dict[int, list[tuple[int, int, int]]] = {}
        for text, kind, a, b in spans(data, begins, ends):
            found.setdefault(text, []).append((a, kind, b))
        counts = np.zeros((len(KINDS), len(texts)), dtype=np.int64)
        hashes, joined = [hashlib.sha256(b"").hexdigest()] * len(texts), [""] * len(texts)
        for text, own in found.items():
            before = np.cumsum(np.append(0, (data[begins[text] : ends[text]] & 0xC0) != 0x80))  # code points before each byte
            named = []
            for a, kind, b in sorted(own):
                counts[kind, text] += 1
                named.append((kind, f"{KINDS[kind]}:{before[a]}:{before[b]}"))
            hashes[text] = hashlib.sha256(",".join(s for k, s in named if k < len(BASE)).encode()).hexdigest()
            joined[text] = ",".join(s for _, s in named)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in counts[: len(BASE)]], pa.array(hashes, pa.string()), pa.array(joined, pa.string())], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])


def secret_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    return docs.select("doc_id", "text").mapInArrow(scan_batches, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _oracle_sql() -> str:
    """The same by regular expressions: a match begins behind the texts between matches and the matches before it."""
    rules = []
    for k, (kind, pattern, fold, least) in enumerate(BASE + EXTRA):
        pattern = pattern.replace("'", "''")
        if fold:  # ASCII letters alone, so no case folding by the engine
            words, rest = pattern.split(")", 1)
            pattern = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words) + ")" + rest
        value = f"regexp_extract(m[i], '{pattern.replace('[A-Za-z0-9+/', '([A-Za-z0-9+/')})', 2)" if kind == "assign" else "m[i]"
        rules.append(f"SELECT r, {k} AS k, '{kind}' AS kind, g, m, i, length({value}) >= {least} AS good FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM texts))")
    every = "\n  UNION ALL ".join(rules)
    return f"""
WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({every}),
placed AS (SELECT r, k, kind, length(m[i]) AS n, CAST(list_sum([length(x) FOR x IN g[1:i]]) + coalesce(list_sum([length(x) FOR x IN m[1:i - 1]]), 0) AS BIGINT) AS a FROM found WHERE good),
named AS (SELECT r, k, a, concat(kind, ':', a, ':', a + n) AS s FROM placed),
each AS (SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  string_agg(s, ',' ORDER BY a, k) FILTER (k < {len(BASE)}) AS base, string_agg(s, ',' ORDER BY a, k) AS spans FROM named GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM texts LEFT JOIN each USING (r)
"""


ORACLE_SQL = _oracle_sql()
