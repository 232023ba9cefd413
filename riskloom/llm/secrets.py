r"""Secret scans by assignment-aware lexing, on top of three fixed patterns.

The lexer reads source and configuration syntax into (name, expression) pairs:
`name = "literal"`, `"name": "literal"`, `name := literal`, `export NAME=literal`, with `+`
between literals and names, in one, two or three quotes or back-ticks, on the next line if the value is quoted, as the
first line of a YAML block, and as the text of an XML element.  Names that were given a literal are constants: used
in a later expression, or as `${name}` in double quotes or back-ticks or `$name` outside, they stand for their
literals; references to other names stand for nothing, and calls are no literals.  A pair's score is the sensitivity of its
target name times the plausibility of the joined literal; the literals of pairs that reach
`min_score` are spans of kind `literal`, wherever they were written.  Names that end by saying what a secret is
called, where it lies or how long it is (`secretName`, `token_file`) count for little.

Joined literals are kept as their characters' counts, their first `JOINED` characters, and links to the constants they
were made of, never as copies: constants that are made of themselves or of each other cost the same per term however
long their values would be, and every literal is marked once.

Defined cases: null or empty text has no spans; offsets are code points, ends exclusive;
a text is read whole, in one pass per pattern, whatever its length; rows are
independent, so ties, repeated rows and empty tables need no rule.
"""

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import in_slices

# The base patterns and their least lengths, in the order of the kinds.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ("assign", "access", "hex", "literal")

# Words of a target name and how sensitive they make it.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.8, "authorization": 0.8,
    "auth": 0.6, "private": 0.5, "access": 0.4, "api": 0.4, "key": 0.4, "signing": 0.4,
}
MIN_SCORE = 0.5
# Up to this length a joined literal is kept as it is, to be compared with placeholders.
JOINED = 256

# Last words of names that describe a secret, and what of their sensitivity is left.
DESCRIBES = frozenset(
    "name names id ids path file dir url uri type kind count length size limit label field header env prefix ttl".split()
)
DESCRIBED = 0.3

_NAME = r"[A-Za-z_][\w.-]*"
# A quoted value may stand on the next line, a YAML block starts there.
_PAIR = re.compile(
    rf"(?<![\w.-])[\"']?({_NAME})[\"']?[ \t]*(?::=|=>|=(?![=>])|:(?!:))[ \t]*"
    r"(?:[\\(]?[ \t]*\n[ \t]*(?=[\"'`])|[|>][+-]?[ \t]*\n[ \t]+)?"
)
_ELEMENT = re.compile(rf"<({_NAME})(?:[ \t][^<>\n]*)?>[ \t]*([^<>\s][^<>\n]*?)[ \t]*</")
_TERM = re.compile(
    r"\"\"\"(?P<long>[\s\S]*?)\"\"\"|'''(?P<raw>[\s\S]*?)'''|\"(?P<double>(?:[^\"\\\n]|\\.)*)\""
    r"|'(?P<single>(?:[^'\\\n]|\\.)*)'|`(?P<tick>(?:[^`\\]|\\[\s\S])*)`|\$(?:\{(?P<braced>[^{}\s]*)\}|(?P<dollar>[A-Za-z_]\w*))"
    rf"|(?P<name>{_NAME})(?=[ \t]*(?:[+;,)\]}}#\n]|$))|(?P<bare>[A-Za-z0-9+/_.=-]++(?![(\[]))"
)
_REFERENCE = re.compile(r"\$\{([^{}\s]*)\}")
_PLUS = re.compile(r"[ \t]*(?:\\?\n[ \t]*)?\+[ \t]*(?:\\?\n[ \t]*)?")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_PLACEHOLDER = re.compile(
    r"(?i)^(?:changeme|example|placeholder|your[-_ ].*|none|null|true|false|x+|\*+|\.+|todo|test|dummy|secret|password|token)$"
)


def name_score(name: str) -> float:
    """How much a target name promises a secret, 0 to 1."""
    words = [w.lower() for w in _WORDS.findall(name)]
    joined = sum(sorted((SENSITIVE.get(w, 0.0) for w in words), reverse=True)[:2])
    score = min(1.0, max(joined, SENSITIVE.get("".join(words), 0.0)))
    return score * DESCRIBED if words and words[-1] in DESCRIBES else score


class Joined:
    """What an expression stands for: literals and constants one after the other; or one literal."""

    __slots__ = ("_counts", "head", "length", "marked", "parts", "span", "text")

    def __init__(self, text: str = "", span: tuple[int, int] | None = None) -> None:
        self.text, self.head, self.length = text, text[:JOINED], len(text)
        self.span, self.parts, self.marked = span, [], False
        self._counts: Counter | None = None

    def add(self, part: "Joined") -> None:
        if self.length < JOINED:
            self.head = (self.head + part.head)[:JOINED]
        self.length += part.length
        self.parts.append(part)

    def counts(self) -> Counter:
        """Its characters, counted once for every constant that is in it."""
        waiting = [self]
        while waiting:
            node = waiting[-1]
            inside = [part for part in node.parts if part._counts is None] if node._counts is None else []
            if inside:
                waiting += inside
                continue
            waiting.pop()
            if node._counts is None:
                node._counts = Counter(node.text)
                for part in node.parts:
                    for character, count in part._counts.items():
                        node._counts[character] += count
        return self._counts

    def spans(self) -> Iterator[tuple[int, int]]:
        """The spans of its literals that no call has returned before."""
        waiting = [self]
        while waiting:
            node = waiting.pop()
            if not node.marked:
                node.marked = True
                if node.span is not None:
                    yield node.span
                waiting += node.parts


def literal_score(value: Joined) -> float:
    """How plausible a literal is as a secret: long enough, no placeholder, no plain word."""
    counts, length = value.counts(), value.length
    if length < 6 or any(c.isspace() for c in counts):
        return 0.0
    # Of the placeholders only one repeated character, or what begins with `your`, can be longer than the head.
    long_one = len({c.lower() for c in counts}) == 1 or value.head[:4].lower() == "your"
    if _PLACEHOLDER.match(value.head) and (length <= JOINED or long_one):
        return 0.0
    entropy = -sum(c / length * math.log2(c / length) for c in counts.values())
    kinds = sum(any(re.match(p, c) for c in counts) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, entropy / 4 + 0.15 * (kinds - 1))


def interpolated(text: str, start: int, constants: dict[str, Joined]) -> Joined:
    """A literal that begins at `start`, with its references to constants resolved."""
    if "${" not in text:
        return Joined(text, (start, start + len(text)))
    value, at = Joined(), 0
    for reference in _REFERENCE.finditer(text):
        value.add(Joined(text[at : reference.start()], (start + at, start + reference.start())))
        value.add(constants.get(reference[1]) or Joined())
        at = reference.end()
    value.add(Joined(text[at:], (start + at, start + len(text))))
    return value


def assignments(text: str) -> Iterator[tuple[str, Joined]]:
    """The pairs of a text: target name and what its expression stands for.

    An expression ends at the first term that is neither a literal, a reference nor a known constant.
    """
    constants: dict[str, Joined] = {}
    at = 0
    while pair := _PAIR.search(text, at):
        name, at = pair[1], pair.end()
        value = Joined()
        while term := _TERM.match(text, at):
            kind, written = term.lastgroup, term[term.lastgroup]
            known = constants.get(written) if kind in ("name", "braced", "dollar") else None
            if kind == "name" and known is None and value.parts:
                break
            if kind in ("braced", "dollar"):
                value.add(known or Joined())
            elif kind in ("long", "double", "tick"):
                value.add(interpolated(written, term.start(kind), constants))
            else:
                value.add(known or Joined(written, term.span(kind)))
            at = term.end()
            plus = _PLUS.match(text, at)
            if not plus:
                break
            at = plus.end()
        if value.parts:
            constants[name] = value
            yield name, value


def elements(text: str) -> Iterator[tuple[str, Joined]]:
    """The XML elements of a text that hold text and nothing else: name and text."""
    for element in _ELEMENT.finditer(text):
        if not element[2].startswith("${"):
            yield element[1], Joined(element[2], element.span(2))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns, by start, then kind."""
    spans = []
    if "=" in text or ":" in text:
        spans += [
            ("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LEAST
        ]
    if "AKIA" in text:
        spans += [
            ("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST
        ]
    spans += [("hex", *m.span()) for m in HEX_LONG.finditer(text)]
    return sorted(spans, key=_order)


def _order(span: tuple[str, int, int]):
    return span[1], KINDS.index(span[0]), span[2]


def all_spans(text: str, min_score: float = MIN_SCORE) -> tuple[list, list]:
    """The base spans, and these with the spans of sensitive literals."""
    base = base_spans(text)
    found = set()
    pairs = assignments(text) if "=" in text or ":" in text else ()
    for name, value in chain(pairs, elements(text) if "</" in text else ()):
        sensitivity = name_score(name)
        if sensitivity and sensitivity * literal_score(value) >= min_score:
            found.update(("literal", start, end) for start, end in value.spans() if end > start)
    return base, sorted([*base, *found], key=_order)


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """Per row of `docs`: counts by kind, the digest of the base spans, and all spans as text."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows = []
            for text in batch.column("text"):
                base, spans = all_spans(text.as_py() or "", min_score)
                count = Counter(kind for kind, _, _ in spans)
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                rows.append((*(count[kind] for kind in KINDS), digest, _joined(spans)))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    types = [pa.int64()] * len(KINDS) + [pa.string()] * 2
    names = ["doc_id", *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans"]
    schema = (
        "doc_id long, n_assign long, n_access long, n_hex long, n_literal long, "
        "base_sha256 string, spans string"
    )
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return rows.mapInArrow(scanned, schema)


def redact(text: str, mask: str = "[SECRET]", min_score: float = MIN_SCORE) -> str:
    """The text with every span, overlapping ones joined, replaced by `mask`."""
    _, spans = all_spans(text, min_score)
    parts, at = [], 0
    for start, end in _merged(spans):
        parts += [text[at:start], mask]
        at = end
    return "".join([*parts, text[at:]])


def _merged(spans) -> list[list[int]]:
    merged: list[list[int]] = []
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return merged


def redacted(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """`docs` with secrets masked in `text_col`; null texts stay null, other columns as they are."""

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redact(t, mask))

    return docs.withColumn(text_col, masked(docs[text_col]))
