"""Operator 5: secret scan over a trigram inverted index.

Each rule is a regular expression with a Boolean trigram query derived from
it: an AND of ORs of ANDs of lower-cased trigrams that every match must hold
(``trigram_query`` walks the parsed expression). Texts are indexed in blocks:
the postings of a block list, for each trigram some rule asks for, the texts
that hold it (the positions of the folded bytes are looked up by numpy, a
piece at a time). Postings are united and intersected per rule, and only the candidates
are verified by the expression itself. A rule without a mandatory trigram
scans its whole block. Blocks are independent, so nothing is shuffled.

Matching is by ASCII rules: letters fold A-Z only. Spans are code points, end
exclusive, leftmost and non-overlapping per kind.

Defined cases: NULL text is empty and has no spans; an empty span list gives
empty strings (their SHA-256 is that of no bytes); repeated rows and NULL ids
give one row each; whole texts are read; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from re import _constants as c
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marketlake.llm.common import map_batches, texts_of

MAX_SET = 24   # exact strings kept per side while a query is derived
PIECE = 1 << 20   # bytes whose trigrams are looked up at a time


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0          # group whose length is tested
    least: int = 0          # and its least length
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
EXTRA = (
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]+", 0, 24),
)
RULES = BASE + EXTRA


# ------------------------------------------- Boolean queries from expressions

def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _strings(tree) -> list[tuple[set[str] | None, list]]:
    """A sequence as items: a set of exact folded strings, or None for
    anything, with the queries that hold inside that item."""
    items: list[tuple[set[str] | None, list]] = []
    for op, arg in tree:
        if op is c.LITERAL:
            items.append(({chr(arg).lower()}, []))
        elif op is c.IN:
            chars = _members(arg)
            items.append((chars, []))
        elif op is c.SUBPATTERN:
            items += _strings(arg[3])
        elif op is c.BRANCH:
            whole, ors = set(), []
            for branch in arg[1]:
                exact = _joined(_strings(branch))
                whole = whole | exact if whole is not None and exact is not None else None
                ors.append(_query(_strings(branch)))
            items.append((whole, [] if whole is not None else [("or", ors)]))
        elif op in (c.MAX_REPEAT, c.MIN_REPEAT, c.POSSESSIVE_REPEAT):
            low, high, sub = arg
            inner = _strings(sub)
            if (low, high) == (0, 1) and (exact := _joined(inner)) is not None:
                items.append((exact | {""}, []))
            elif low == high and low <= 8:
                items += inner * low
            else:
                items += [*(inner if low else []), (None, [])]
        elif op is c.AT:
            continue
        else:
            items.append((None, []))
    return items


def _members(arg) -> set[str] | None:
    chars: set[str] = set()
    for op, value in arg:
        if op is c.LITERAL:
            chars.add(chr(value).lower())
        elif op is c.RANGE and value[1] - value[0] < MAX_SET:
            chars |= {chr(x).lower() for x in range(value[0], value[1] + 1)}
        else:
            return None
    return chars if len(chars) <= MAX_SET else None


def _joined(items) -> set[str] | None:
    out = {""}
    for exact, _ in items:
        if exact is None or len(out) * len(exact) > MAX_SET:
            return None
        out = {a + b for a in out for b in exact}
    return out


def _query(items):
    """("and"|"or", parts) over trigrams; None where nothing is mandatory."""
    ands: list = []
    run = {""}

    def close() -> None:
        nonlocal run
        options = [_grams(s) for s in run]
        if all(options):
            ands.append(("or", [("and", sorted(g)) for g in options]))
        run = {""}

    for exact, inside in items:
        ands += [q for q in inside if all(x is not None for x in q[1])]
        if exact is None:
            close()
        elif len(run) * len(exact) > MAX_SET:
            close()
            run = set(exact)
        else:
            run = {a + b for a in run for b in exact}
    close()
    return ("and", ands) if ands else None


def trigram_query(pattern: str):
    """Folded trigrams that every match of ``pattern`` holds, as nested
    ("and" | "or", parts); None if none is mandatory (the rule scans fully)."""
    return _query(_strings(parser.parse(pattern, re.ASCII)))


def query_grams(query) -> set[str]:
    if query is None:
        return set()
    return set().union(*({p} if isinstance(p, str) else query_grams(p) for p in query[1]))


# ----------------------------------------------------------- postings, search

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class BlockIndex:
    """Postings of one block: trigram -> sorted numbers of the texts with it."""

    def __init__(self, grams: list[str]):
        self.grams = grams
        self.slot = np.zeros(1 << 24, np.uint8 if len(grams) < 255 else np.uint16)
        for i, g in enumerate(grams):
            a, b, d = g.encode()
            self.slot[a << 16 | b << 8 | d] = i + 1

    def postings(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        data = _FOLD[np.frombuffer(b"\n\n\n".join(texts), np.uint8)]
        found = {g: np.empty(0, np.int64) for g in self.grams}
        if len(data) < 3:
            return found
        places, slots = [], []
        for lo in range(0, len(data) - 2, PIECE):
            wide = data[lo:lo + PIECE + 2].astype(np.int32)
            slot = self.slot[wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]]
            at = np.flatnonzero(slot)
            places.append(at + lo)
            slots.append(slot[at])
        at, slots = np.concatenate(places), np.concatenate(slots)
        starts = np.cumsum([0] + [len(t) + 3 for t in texts[:-1]])
        text = np.searchsorted(starts, at, "right") - 1
        pairs = np.unique(slots.astype(np.int64) << 32 | text)
        which, cuts = pairs >> 32, None
        cuts = np.searchsorted(which, np.arange(1, len(self.grams) + 2))
        for i, g in enumerate(self.grams):
            found[g] = pairs[cuts[i]:cuts[i + 1]] & 0xFFFFFFFF
        return found


def evaluate(query, postings: dict[str, np.ndarray]) -> np.ndarray:
    """Candidates of a query: united (or) and intersected (and) postings."""
    lists = [postings[p] if isinstance(p, str) else evaluate(p, postings) for p in query[1]]
    if query[0] == "or":
        return np.unique(np.concatenate(lists))
    lists.sort(key=len)
    out = lists[0]
    for other in lists[1:]:
        out = np.intersect1d(out, other, assume_unique=True)
    return out


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = [(i, r, r.compiled(), trigram_query(r.pattern)) for i, r in enumerate(rules)]
        self.index = BlockIndex(sorted(set().union(*(query_grams(q) for *_, q in self.rules))))

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """Per text (start, rule number, end), by start then rule."""
        postings = self.index.postings([t.encode() for t in texts])
        spans: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for i, rule, regex, query in self.rules:
            todo = range(len(texts)) if query is None else evaluate(query, postings)
            for k in todo:
                for m in regex.finditer(texts[k]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        spans[k].append((m.start(), i, m.end()))
        for found in spans:
            found.sort()
        return spans


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE),
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_<kind> of each base rule, base_sha256, spans) per row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    kinds = [r.kind for r in rules]

    def make():
        scanner = Scanner(rules)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = scanner.scan(texts_of(batch, text_col))
            told = [[(i, f"{kinds[i]}:{s}:{e}") for s, i, e in x] for x in found]
            counts = [pa.array([sum(i == k for i, _ in x) for x in told], pa.int64())
                      for k in range(base)]
            sha = [hashlib.sha256(",".join(t for i, t in x if i < base).encode()).hexdigest()
                   for x in told]
            return pa.RecordBatch.from_arrays(
                [batch.column(id_col), *counts, pa.array(sha, pa.string()),
                 pa.array([",".join(t for _, t in x) for x in told], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in kinds[:base]), "base_sha256", "spans"])
        return run

    return map_batches(docs.select(id_col, text_col), make,
                       f"doc_id {id_type}, " + "".join(f"n_{k} bigint, " for k in kinds[:base])
                       + "base_sha256 string, spans string")


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[secret]",
                   text_col: str = "text") -> DataFrame:
    """``docs`` with every found span (overlaps joined) replaced by ``mask``.
    All rows and columns stay; NULL text stays NULL."""
    schema = docs.schema

    def make():
        scanner = Scanner(rules)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at).to_pylist()
            out = []
            for text, spans in zip(texts, scanner.scan([t or "" for t in texts])):
                if spans:
                    parts, last = [], 0
                    for s, _, e in spans:
                        if s >= last:
                            parts += [text[last:s], mask]
                        last = max(last, e)
                    text = "".join(parts) + text[last:]
                out.append(text)
            return pa.RecordBatch.from_arrays(
                [pa.array(out, pa.string()) if i == at else col
                 for i, col in enumerate(batch.columns)], names=batch.schema.names)
        return run

    return map_batches(docs, make, schema)


# Plain regular expressions over whole texts: matches are set off by two
# control characters (those of the text itself give way first), so that the
# lengths of the parts before them are their places. Letters of either case
# are spelled out, since the engine's own folding goes beyond A-Z.
ORACLE = r"""
WITH rules(i, kind, pat, least_chars) AS (VALUES
    (0, 'assign', '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 6),
    (1, 'access', 'AKIA[A-Z0-9]+', 20),
    (2, 'hex', '[0-9a-f]+', 24),
    (3, 'private_key', '-----BEGIN (?:RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----', 0),
    (4, 'github', 'gh[pousr]_[A-Za-z0-9]+', 40),
    (5, 'slack', 'xox[abprs]-[A-Za-z0-9-]+', 15),
    (6, 'google', 'AIza[A-Za-z0-9_-]+', 39),
    (7, 'jwt', 'eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+', 0),
    (8, 'stripe', '[sr]k_live_[A-Za-z0-9]+', 24)),
texts AS (
    SELECT row_number() OVER () AS r, doc_id,
           translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS t
    FROM documents),
split AS (
    SELECT r, i, kind, pat, least_chars,
           string_split(regexp_replace(t, '(' || pat || ')', chr(1) || '\1' || chr(2), 'g'),
                        chr(1)) AS parts
    FROM texts CROSS JOIN rules),
pieces AS (
    SELECT * EXCLUDE (parts), unnest(parts) AS part, generate_subscripts(parts, 1) AS j
    FROM split),
placed AS (
    SELECT *, split_part(part, chr(2), 1) AS found,
           sum(length(replace(part, chr(2), ''))) OVER (PARTITION BY r, i ORDER BY j)
               - length(replace(part, chr(2), '')) AS s
    FROM pieces),
spans AS (
    SELECT r, i, kind, s, kind || ':' || CAST(s AS BIGINT) || ':'
               || CAST(s + length(found) AS BIGINT) AS told
    FROM placed
    WHERE j > 1 AND length(CASE kind WHEN 'assign' THEN regexp_extract(found, pat, 2)
                           ELSE found END) >= least_chars),
sums AS (
    SELECT r, count(*) FILTER (i = 0) AS n_assign, count(*) FILTER (i = 1) AS n_access,
           count(*) FILTER (i = 2) AS n_hex,
           string_agg(told, ',' ORDER BY s, i) FILTER (i < 3) AS base,
           string_agg(told, ',' ORDER BY s, i) AS spans
    FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM texts LEFT JOIN sums USING (r)
"""
