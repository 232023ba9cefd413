r"""Substring dedup by hashing lines, paragraphs or sentences.

Texts are cut into units: at blank lines (`paragraph`), at line breaks (`line`), or at line
breaks and after sentence ends (`sentence`, the default: passages that were pasted into the
middle of a line are found, too).  Units are normalised (lower case, runs of white space as
one blank).  What repeats is a run of neighbouring units, over line breaks and blank lines, too, that has
`min_words` words or more together: one long sentence, a line of short ones, or a passage of them.
Digested to 128 bits are the shortest such runs, from each unit on and up to each unit: they cover every
longer run.  The digests are grouped over all documents; the occurrence in the smallest id stays, the first
one there, and all others are removed with the separator behind them.  Where a repeat overlaps an occurrence
that stays, the units of both stay: whatever is removed still stands whole in the document that keeps it.
A run that overlaps its first occurrence in a text is no repeat of it.  What repeats with fewer words stays:
it does so by nature.  The digests are pre-aggregated to one smallest and largest id, so a line that a
third of all documents share is a few rows per task.

Defined cases: null text is empty; rows that repeat id and text are one document and get the same
answer; documents without id come last and rank by the hash of their text; documents with one id and several
texts rank alike, so what only these share stays, but for repeats within a text; empty tables give empty
results; other columns are ignored.
"""

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import documents, in_slices
from riskloom.session import stored

UNITS = {
    "sentence": re.compile(r"[^\S\n]*\n|(?<=[.!?])[^\S\n]+"),
    "line": re.compile(r"\n"),
    "paragraph": re.compile(r"\n[^\S\n]*\n\s*"),
}
MIN_WORDS = 8


def units(text: str, unit: str = "sentence") -> Iterator[tuple[int, int, list[str]]]:
    """Start, end with the separator behind, and the normalised words of each unit of a text."""
    at = 0
    for mark in UNITS[unit].finditer(text):
        yield at, mark.end(), text[at : mark.start()].lower().split()
        at = mark.end()
    if at < len(text):
        yield at, len(text), text[at:].lower().split()


def runs(lengths: list[int], min_words: int) -> list[tuple[int, int]]:
    """First and last unit of the shortest runs of `min_words` words, from each unit on and up to each."""
    before = [0, *accumulate(lengths)]
    found = set()
    for i in range(len(lengths)):
        if lengths[i] >= min_words:
            found.add((i, i))
            continue
        last = bisect_left(before, before[i] + min_words) - 1
        if last < len(lengths):
            found.add((i, last))
        first = bisect_right(before, before[i + 1] - min_words) - 1
        if first >= 0:
            found.add((first, i))
    return sorted(found)


def digest(units: list[str]) -> bytes:
    return xxhash.xxh3_128_digest("\n".join(units).encode())


def worded(text: str, unit: str, min_words: int) -> list[tuple[int, int, list[str]]]:
    """The units of a text that runs are made of: those with words."""
    return [u for u in units(text, unit) if len(u[2]) >= min(1, min_words)]


def digested(docs: DataFrame, unit: str, min_words: int) -> DataFrame:
    """The shortest runs: id, text_hash, n (place among the text's `runs`), of (run there that it repeats), h1, h2."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows, places, repeated, digests = [], [], [], []
            for row, text in enumerate(batch.column("text")):
                there = worded(text.as_py(), unit, min_words)
                written = [" ".join(words) for _, _, words in there]
                seen: dict[bytes, tuple[int, int]] = {}
                for n, (i, j) in enumerate(runs([len(words) for _, _, words in there], min_words)):
                    d = digest(written[i : j + 1])
                    of, last = seen.setdefault(d, (n, j))
                    rows.append(row)
                    places.append(n)
                    repeated.append(of if last < i else None)
                    digests.append(d)
            h = np.array([np.frombuffer(d, np.int64) for d in digests], np.int64).reshape(-1, 2)
            take = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(take), batch.column("text_hash").take(take)]
                + [pa.array(places, pa.int32()), pa.array(repeated, pa.int32())]
                + [pa.array(np.ascontiguousarray(c)) for c in (h[:, 0], h[:, 1])],
                ["id", "text_hash", "n", "of", "h1", "h2"],
            )

    return docs.mapInArrow(cut, "id long, text_hash long, n int, of int, h1 long, h2 long")


def removals(docs: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS) -> DataFrame:
    """Per document that shares runs or repeats them: id, text_hash, found (n and of, runs by their place).

    Run `n` of the text goes where `of` is null (an earlier document keeps it) or another run of the text (which
    it repeats), and stays for other documents where `of` is `n`.  `docs` has the columns of `common.documents`.
    """
    rows = stored(digested(docs, unit, min_words))
    last = F.lit(2**63 - 1)
    rank = F.coalesce("id", last)
    unnamed = F.expr("CASE WHEN id IS NULL THEN text_hash END")
    shared = (
        rows.groupBy("h1", "h2")
        .agg(
            F.min(rank).alias("first_id"), F.max(rank).alias("last_id"),
            F.min(unnamed).alias("first_hash"), F.max(unnamed).alias("last_hash"),
        )
        .where("first_id < last_id OR first_hash < last_hash")
        .select("h1", "h2", "first_id", F.expr("CASE WHEN first_id = last_id THEN first_hash END").alias("first_hash"))
    )
    later = (rank > F.col("first_id")) | F.coalesce(F.col("text_hash") > F.col("first_hash"), F.lit(False))
    across = (
        rows.where("of IS NULL")
        .join(shared, ["h1", "h2"])
        .select("id", "text_hash", "n", F.when(~later, F.col("n")).alias("of"))
    )
    within = rows.where("of IS NOT NULL").select("id", "text_hash", "n", "of")
    return (
        across.unionByName(within)
        .groupBy("id", "text_hash")
        .agg(F.collect_set(F.struct("n", "of")).alias("found"))
    )


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, neighbours and overlaps joined."""
    joined: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if joined and joined[-1][1] >= start:
            start, end = joined[-1][0], max(joined.pop()[1], end)
        joined.append((start, end))
    return joined


def cleared(gone: list[tuple[int, int]], stays: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What `gone` covers and `stays` does not."""
    left, stays, k = [], merged(stays), 0
    for start, end in merged(gone):
        while k < len(stays) and stays[k][1] <= start:
            k += 1
        at = k
        while at < len(stays) and stays[at][0] < end:
            if start < stays[at][0]:
                left.append((start, stays[at][0]))
            start = max(start, stays[at][1])
            at += 1
        if start < end:
            left.append((start, end))
    return left


def dedup(
    docs: DataFrame, unit: str = "sentence", min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of `docs`: doc_id, n_removed (units with words), removed_chars, spans, kept_text.

    `spans` are `start:end` of the removed units in the original text, code points, end
    exclusive, neighbours and overlaps joined; what lies between them is `kept_text`, in order, so every kept
    character's original place follows from them.
    """
    texts = documents(docs, id_col, text_col)
    found = removals(texts, unit, min_words)
    rows = texts.toDF("doc_id", "text", "hash")
    of_row = rows["doc_id"].eqNullSafe(found["id"]) & (rows["hash"] == found["text_hash"])
    joined = rows.join(found, of_row, "left").select("doc_id", "text", "found")

    def gone(text: str, found: list[dict]) -> list[tuple[int, int]]:
        there = worded(text, unit, min_words)
        spans = [(there[i][0], there[j][1]) for i, j in runs([len(words) for _, _, words in there], min_words)]
        later = {f["n"] for f in found if f["of"] is None}
        stays = {f["of"] for f in found if f["of"] is not None} - later
        return cleared([spans[f["n"]] for f in found if f["of"] != f["n"]], [spans[n] for n in stays])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows = []
            for text, found in zip(batch.column("text"), batch.column("found").to_pylist(), strict=True):
                text, at, parts = text.as_py(), 0, []
                spans = gone(text, found) if found else []
                for start, end in spans:
                    parts.append(text[at:start])
                    at = end
                kept = "".join([*parts, text[at:]])
                # Spans start and end with units, so each cuts into the same units as the text.
                removed = sum(len(worded(text[s:e], unit, min_words)) for s, e in spans)
                rows.append((removed, len(text) - len(kept), ",".join(f"{s}:{e}" for s, e in spans), kept))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns],
                ["doc_id", "n_removed", "removed_chars", "spans", "kept_text"],
            )

    return joined.mapInArrow(
        remove, "doc_id long, n_removed long, removed_chars long, spans string, kept_text string"
    )
