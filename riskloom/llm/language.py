"""Language ID by cross-parsing entropy.

Per language, labelled text makes a reference string, and its suffix automaton knows every substring of
it.  A text is parsed against each: from the place reached, the longest match in the reference is one
phrase, and the next begins behind it.  Pointing to a phrase costs log2 of the reference's length,
so a text's phrases times that, the bits that the language needs for it, are compared; the fewest win.

Texts are read as lower-case UTF-8 letters with one space for whatever stands between them, whole, in
blocks of `BLOCK` bytes, and no phrase crosses a block (one phrase more per block, for every language alike).
All blocks of a batch advance together, one byte and one table lookup per language at a time, so a long
text is many short lanes and not a long loop.

Learning sees a bounded sample: per language the `ROWS` distinct texts of least hash, at most one part
in `SHARE` of `REFERENCE` bytes from each (no single text is learnt by heart), `REFERENCE` bytes in all.  An automaton has at most 2 * REFERENCE states of one
4-byte entry per byte value in use; each Python worker builds them once from the reference strings.

Defined cases: null texts and texts without a letter are `und` with score 0, and so is every text when no
language was learnt; letters never learnt are phrases of their own; ties go to the language first in
alphabetical order; a null id is never learnt from nor held out; repeated rows get equal answers, but are
learnt from once; empty tables give empty results; other columns are ignored.
"""

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import in_slices

REFERENCE = 32_768
ROWS = 128
SHARE = 64
BLOCK = 512
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Per code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def letters(text: str) -> bytes:
    """The text's letters in lower case, words between single spaces; empty without any letter."""
    code = np.frombuffer(unicodedata.normalize("NFC", text).lower().encode("utf-32-le"), np.uint32)
    solid = _letters()[code]
    if not solid.any():
        return b""
    kept = np.where(solid, code, 32)
    kept = kept[solid | np.concatenate([[True], solid[:-1]])]
    return (b" " + kept.astype("<u4").tobytes().decode("utf-32-le").encode().strip() + b" ")


def automaton(reference: bytes) -> list[dict[int, int]]:
    """The transitions of the suffix automaton: state 0 is the empty string, every path from it a substring."""
    step, length, link = [{}], [0], [-1]
    last = 0
    for byte in reference:
        state = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        at, last = last, state
        while at >= 0 and byte not in step[at]:
            step[at][byte] = state
            at = link[at]
        if at < 0:
            continue
        target = step[at][byte]
        if length[target] > length[at] + 1:
            clone = len(step)
            step.append(dict(step[target]))
            length.append(length[at] + 1)
            link.append(link[target])
            link[target] = clone
            while at >= 0 and step[at].get(byte) == target:
                step[at][byte] = clone
                at = link[at]
            target = clone
        link[state] = target
    return step


class Parser:
    """The automata of several references as one table: row plus byte gives the next row.

    An entry is negative (its complement the next row) where no match goes on and a phrase begins.
    Each reference's first row is the place between phrases, where one begins with any byte.
    """

    def __init__(self, references: tuple[bytes, ...]) -> None:
        used = np.unique(np.frombuffer(b"".join(references), np.uint8))
        self.code = np.full(256, len(used), np.int32)
        self.code[used] = np.arange(len(used))
        width = len(used) + 1
        code, tables, starts, base = self.code.tolist(), [], [], 0
        for reference in references:
            step = automaton(reference)
            # One row for the place between phrases, then one per state but the empty string.
            between = np.full(width, ~base, np.int32)
            for byte, target in step[0].items():
                between[code[byte]] = ~(base + target * width)
            table = np.tile(between, (len(step), 1))
            for state in range(1, len(step)):
                row = table[state]
                for byte, target in step[state].items():
                    row[code[byte]] = base + target * width
            tables.append(table.ravel())
            starts.append(base)
            base += table.size
        self.table = np.concatenate(tables) if tables else np.empty(0, np.int32)
        self.starts = np.array(starts, np.int32)

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """How many phrases each text has (rows) against each reference (columns)."""
        owner = np.repeat(np.arange(len(texts)), [-(-len(t) // BLOCK) for t in texts])
        lanes = [t[i : i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
        result = np.zeros((len(texts), len(self.starts)), np.int64)
        if not lanes or not len(self.starts):
            return result
        size = np.array([len(lane) for lane in lanes])
        order = np.argsort(-size, kind="stable")
        padded = b"".join(lanes[i].ljust(BLOCK, b"\0") for i in order)
        column = self.code[np.frombuffer(padded, np.uint8).reshape(len(lanes), BLOCK).T]
        active = len(lanes) - np.searchsorted(size[order][::-1], np.arange(BLOCK), side="right")
        for k, start in enumerate(self.starts):
            at = np.full(len(lanes), start, np.int32)
            count = np.zeros(len(lanes), np.int32)
            for symbol, n in zip(column, active.tolist(), strict=True):
                if not n:
                    break
                entry = self.table[at[:n] + symbol[:n]]
                begins = entry >> 31
                count[:n] -= begins
                at[:n] = entry ^ begins
            result[:, k] = np.bincount(owner[order], count, len(texts)).astype(np.int64)
        return result


@lru_cache(maxsize=1)
def parser(references: tuple[bytes, ...]) -> Parser:
    return Parser(references)


class Model:
    """The reference string per language, languages in alphabetical order."""

    def __init__(self, references: dict[str, bytes]) -> None:
        self.languages = sorted(k for k, reference in references.items() if reference)
        self.references = tuple(references[k] for k in self.languages)

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """What each text (rows of `letters`) costs in each language (columns)."""
        cost = np.array([math.log2(len(r) + 1) for r in self.references])
        return parser(self.references).phrases(texts) * cost

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language per text, and its share of the probabilities 2 ** -bits."""
        known = [letters(t or "") for t in texts]
        names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, score
        bits = self.bits(known)
        best = bits.argmin(axis=1)
        share = 1 / np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)).sum(axis=1)
        for i, text in enumerate(known):
            if text:
                names[i], score[i] = self.languages[best[i]], share[i]
        return names, score


def held_out(doc_id: Column) -> Column:
    """Documents that learning never sees: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def reference_of(texts: list[str], size: int = REFERENCE) -> bytes:
    """Texts in turn, one part in SHARE of `size` from each, and so on behind those, until `size` bytes are there."""
    known = [letters(t) for t in texts]
    part = max(1, size // SHARE)
    joined = b""
    for start in range(0, max(map(len, known), default=0), part):
        joined += b"".join(k[start : start + part] for k in known)
        if len(joined) >= size:
            break
    return joined[:size]


def train(
    docs: DataFrame,
    rows: int = ROWS,
    reference: int = REFERENCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """A model from the labelled documents outside the held-out fold.

    Copies are counted once, by a grouped hash that is combined before the shuffle; the ranks keep `rows` rows
    per language in each task before the shuffle, too, so a language with most of the rows is no hot group.
    """
    text = docs[text_col].cast("string")
    usable = docs.select(
        docs[id_col].cast("long").alias("id"),
        text.alias("text"),
        docs[lang_col].cast("string").alias("lang"),
        F.xxhash64(text).alias("key"),
    ).where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    usable = usable.where(~held_out(F.col("id")))
    least = Window.partitionBy("lang").orderBy("key")
    sample = (
        usable.groupBy("lang", "key").agg(F.min("id").alias("id"))
        .withColumn("rank", F.row_number().over(least)).where(F.col("rank") <= rows)
    )
    # Languages times `rows` rows: bounded, as the languages are.
    found = usable.join(F.broadcast(sample), ["lang", "key", "id"])
    taken = found.select("lang", "rank", F.substring("text", 1, reference).alias("text")).distinct()
    texts: dict[str, list[str]] = {}
    for row in taken.orderBy("lang", "rank", "text").collect():
        texts.setdefault(row["lang"], []).append(row["text"])
    return Model({lang: reference_of(t, reference) for lang, t in texts.items()})


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, held_out, lang_pred, score."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            names, score = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    given = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        held_out(docs[id_col]).alias("held_out"),
        docs[text_col].cast("string").alias("text"),
    )
    return given.mapInArrow(judged, "doc_id long, held_out boolean, lang_pred string, score double")
