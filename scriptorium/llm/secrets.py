"""Secret scans by a trigram inverted index.

Each rule's regular expression is reduced to a Boolean query over the trigrams that any match must contain.
Texts are scanned in segments of a few megabytes. Of each segment an inverted index is made, trigram to the
texts that hold it, of the trigrams that some query names; a query intersects and unites its postings, and
only the texts that remain are verified with the rule itself. A rule without mandatory trigrams scans all
texts. Segments need no shuffle, so the index costs memory for one segment at a time, at any input size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product
from re import _constants as C
from re import _parser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import keep_rows, map_rows, only

#: kind, pattern, group whose length counts, least length. The first three are the base kinds.
RULES = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
)
BASE = ("assign", "access", "hex")
SEGMENT_BYTES = 4 << 20
MOST_STRINGS = 64

# A query is True (no demand), or ("and" | "or", parts), where parts are trigrams or queries.


def _all(parts: list) -> object:
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts: list) -> object:
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _demand(strings: set[str]) -> object:
    """One of these strings occurs: the trigrams that follow from it, lower-cased."""
    raw = [s.lower().encode() for s in sorted(strings)]
    return _any([_all([s[i : i + 3] for i in range(len(s) - 2)]) for s in raw])


def _read(tree) -> tuple[set[str] | None, object]:
    """Of a parsed pattern: all its strings if they are few, else None; and what any match demands."""
    run: set[str] | None = {""}
    demands: list = []
    whole = True
    for op, arg in tree:
        strings: set[str] | None = None
        demand: object = True
        if op is C.LITERAL:
            strings = {chr(arg)}
        elif op is C.IN and all(o is C.LITERAL for o, _ in arg) and len(arg) <= 4:
            strings = {chr(a) for _, a in arg}
        elif op is C.SUBPATTERN:
            strings, demand = _read(arg[3])
        elif op is C.BRANCH:
            branches = [_read(b) for b in arg[1]]
            if all(s is not None for s, _ in branches):
                strings = set().union(*[s for s, _ in branches])
            else:
                demand = _any([d if s is None else _demand(s) for s, d in branches])
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            least, most, inner = arg
            sub, need = _read(inner)
            if sub is not None and most == 1:
                strings = sub | ({""} if least == 0 else set())
            elif sub is not None and 0 < least == most and len(sub) ** least <= MOST_STRINGS:
                strings = {"".join(x) for x in product(sub, repeat=least)}
            elif least:
                demand = need if sub is None else _demand(sub)
        elif op is C.AT:
            continue
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
            continue
        whole = False
        demands += [_demand(run), demand]
        run = {""} if strings is None else strings
    if whole:
        return run, _demand(run)
    return None, _all([*demands, _demand(run)])


def trigram_query(pattern: str) -> object:
    """What the trigrams of any lower-cased text with a match satisfy; True if nothing follows."""
    return _read(_parser.parse(pattern, re.ASCII))[1]


def _trigrams(query: object) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_trigrams, query[1]))


class Scanner:
    """Rules with their queries; finds the spans of many texts at once."""

    def __init__(self, rules=RULES):
        self.order = {kind: i for i, (kind, *_) in enumerate(rules)}
        self.rules = [(kind, re.compile(p, re.ASCII), g, least, trigram_query(p)) for kind, p, g, least in rules]
        self.names = sorted(set().union(*[_trigrams(q) for *_, q in self.rules]))
        self.slots = np.zeros(1 << 24, np.uint8 if len(self.names) < 255 else np.uint32)
        for i, t in enumerate(self.names):
            self.slots[t[0] << 16 | t[1] << 8 | t[2]] = i + 1

    def postings(self, texts: list[bytes]) -> dict[bytes, np.ndarray]:
        """Trigram to a mask of the texts (already lower-cased) that hold it."""
        starts = np.cumsum([0] + [len(t) + 3 for t in texts[:-1]])
        raw = np.frombuffer(b"\n\n\n".join(texts), np.uint8)
        masks = np.zeros((len(self.names), len(texts)), bool)
        if len(raw) >= 3:
            codes = raw[:-2].astype(np.int32)
            codes <<= 8
            codes |= raw[1:-1]
            codes <<= 8
            codes |= raw[2:]
            slot = self.slots[codes]
            at = np.flatnonzero(slot)
            masks[slot[at].astype(np.intp) - 1, np.searchsorted(starts, at, "right") - 1] = True
        return dict(zip(self.names, masks, strict=True))

    def chosen(self, query: object, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
        if query is True:
            return np.ones(n, bool)
        if isinstance(query, bytes):
            return postings[query]
        masks = [self.chosen(q, postings, n) for q in query[1]]
        return (np.logical_and if query[0] == "and" else np.logical_or).reduce(masks)

    def _segment(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        postings = self.postings([t.encode("utf-8", "replace").lower() for t in texts])
        found: list[list] = [[] for _ in texts]
        for kind, rule, group, least, query in self.rules:
            for i in np.flatnonzero(self.chosen(query, postings, len(texts))):
                found[i] += [(kind, *m.span()) for m in rule.finditer(texts[i]) if m.end(group) - m.start(group) >= least]
        for spans in found:
            spans.sort(key=lambda s: (s[1], self.order[s[0]]))
        return found

    def find(self, texts: list[str | None]) -> Iterator[list[tuple[str, int, int]]]:
        """For each text its spans (kind, start, end), by start, then as the rules are listed."""
        part: list[str] = []
        size = 0
        for text in texts:
            part.append(text or "")
            size += len(part[-1])
            if size >= SEGMENT_BYTES:
                yield from self._segment(part)
                part, size = [], 0
        if part:
            yield from self._segment(part)


_scanners: dict = {}


def scanner(rules=RULES) -> Scanner:
    """The process's scanner of these rules."""
    if rules not in _scanners:
        _scanners[rules] = Scanner(rules)
    return _scanners[rules]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """Rows (doc_id, spans array<struct<kind, start, end>>), one for each input row.

    Positions are code points, end exclusive. A null or empty text has an empty array; null and repeated ids
    and repeated rows each keep their row; an empty table gives no rows; other columns are ignored.
    """

    def work(rows):
        for row, spans in zip(rows, scanner(rules).find([r["text"] for r in rows]), strict=True):
            yield {"doc_id": row["doc_id"], "spans": [{"kind": k, "start": s, "end": e} for k, s, e in spans]}

    kind = docs.schema[id_col].dataType.simpleString()
    return map_rows(only(docs, doc_id=id_col, text=text_col), f"doc_id {kind}, spans array<struct<kind string, start bigint, end bigint>>", work)


def cover(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each secret, overlapping ones as one, replaced by a mark of its first kind."""
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", rules=RULES) -> DataFrame:
    """All rows and columns of docs, secrets in the text replaced by marks.

    A null or empty text stays as it is; null ids and repeated rows are rows like others; an empty table gives no
    rows; names of other columns are free.
    """

    def work(texts):
        return [cover(t, s) for t, s in zip(texts, scanner(rules).find(texts), strict=True)], [True] * len(texts)

    return keep_rows(docs, text_col, work, renew=True)


def listed(spans, kinds: tuple[str, ...] | None = None):
    """kind:start:end of each span, comma-joined, as a column."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _is(kind: str):
    return lambda span: span["kind"] == kind


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, from the operator's spans."""
    found = scan(docs)
    count = {k: F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in BASE}
    return found.select(
        "doc_id", *count.values(), F.sha2(listed(F.col("spans"), BASE), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")
    )
