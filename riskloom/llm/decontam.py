"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased runs between white space and ASCII punctuation.  Items are taken in blocks of
bounded size, and all documents are searched against each block:
1. the items' n-grams (seeds) are looked up in each document, every one of them: how often a seed occurs
   elsewhere says nothing about this document, so results do not depend on the size of the corpus;
2. each run of an item's seeds in a document, widened on both sides by the most words that an alignment
   reaching the score can span, is a window.  Frequent seeds make many windows, and most of them lack the
   words of the item: the score is at most 2 for each word of the item that the window has, so what
   stays under the score by this bound is left out without loss;
3. the others are aligned with the item: 2 for an equal word, -1 for another, -1 for a missing one.  The
   score over that of the item with itself says how much of it is there, edits included.
Found is every place that reaches the score and has a seed unchanged.  Alignments of all candidates of an
item run together, row by row of the table.

Defined cases: null texts and items are empty; an item without words matches nothing; one shorter than a
seed is its own seed; rows that repeat id and text give equal rows, of which one is returned per item;
repeated items are each reported; texts are read whole; empty tables give empty results; other columns
are ignored.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import documents, in_slices
from riskloom.session import stored

SEED = 3
MIN_SCORE = 0.5
# Characters of items in a block: what the driver and every task hold.
BLOCK_CHARS = 4_000_000
# Cells of a row of alignments that run together, and how many windows at most.
ROW_CELLS, TOGETHER = 1_000_000, 256
WORD_CACHE = 200_000
MATCH, OTHER, GAP = 2, -1, 1

_PUNCTUATION = bytes(range(33, 48)) + b":;<=>?@[\\]^_`{|}~"
_TO_BLANK = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))
_U = np.uint64


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < WORD_CACHE:
            self[word] = h
        return h


_HASHES = _WordHashes()


def word_hashes(text: str) -> np.ndarray:
    words = text.lower().encode().translate(_TO_BLANK).split()
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash per run of `size` words."""
    if len(words) < size:
        return words[:0]
    h = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        h = (h ^ words[k : len(words) - size + 1 + k]) * _U(0x9E3779B97F4A7C15)
        h ^= h >> _U(29)
    return h


@dataclass
class Seeds:
    """Seeds of a block of items: sorted hashes, and per hash its (item, place in the item)."""

    words: list[np.ndarray]
    sizes: list[int]
    hashes: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a text and the numbers of the seeds there."""
        places, numbers = [], []
        for size in self.sizes:
            h = grams(words, size)
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            hit = np.flatnonzero(self.hashes[at] == h)
            places.append(hit)
            numbers.append(at[hit])
        return np.concatenate(places), np.concatenate(numbers)


def seeds_of(items: list[str], size: int) -> Seeds | None:
    """All seeds of the items."""
    words = [word_hashes(t) for t in items]
    rows = []
    for i, w in enumerate(words):
        h = grams(w, min(size, len(w))) if len(w) else w
        rows += [(x, i, p) for p, x in enumerate(h.tolist())]
    if not rows:
        return None
    h, item, place = (np.array(c, t) for c, t in zip(zip(*rows, strict=True), ("u8", "i8", "i8"), strict=True))
    order = np.argsort(h, kind="stable")
    hashes, first = np.unique(h[order], return_index=True)
    sizes = sorted({min(size, len(w)) for w in words if len(w)})
    return Seeds(words, sizes, hashes, np.append(first, len(h)), item[order], place[order])


def smith_waterman(item: np.ndarray, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score per window (rows, padded), and the column after its last word."""
    inside = np.arange(windows.shape[1]) < lengths[:, None]
    slope = GAP * np.arange(windows.shape[1], dtype=np.int32)
    above = np.zeros(windows.shape, np.int32)
    best, end = np.zeros(len(windows), np.int32), np.zeros(len(windows), np.int32)
    for word in item:
        row = np.where((windows == word) & inside, MATCH, OTHER).astype(np.int32)
        row[:, 1:] += above[:, :-1]
        np.maximum(row, above - GAP, out=row)
        np.maximum(row, 0, out=row)
        # Words of the window that the item lacks: a running maximum, lowered by the distance.
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        top = row.argmax(axis=1)
        value = row[np.arange(len(row)), top]
        better = value > best
        best[better], end[better] = value[better], top[better] + 1
        above = row
    return best, end


def longest(words: int, min_score: float) -> int:
    """Words that an alignment with an item of `words` words spans at most when it reaches the score."""
    return words + int(max(0.0, 1 - min_score) * MATCH * words / GAP)


def regions(
    places: np.ndarray, numbers: np.ndarray, seeds: Seeds, min_score: float
) -> Iterator[tuple[int, int, int]]:
    """(item, start, end) of the windows of a text, in words, that its seeds point to."""
    n = seeds.first[numbers + 1] - seeds.first[numbers]
    at = np.repeat(places, n)
    entry = np.repeat(seeds.first[numbers], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    item = seeds.item[entry]
    order = np.lexsort((at, item))
    at, item = at[order], item[order]
    length = np.array([len(w) for w in seeds.words])[item]
    new = np.flatnonzero((np.diff(item) != 0) | (np.diff(at) > length[1:])) + 1
    cuts = np.concatenate([[0], new, [len(at)]]).tolist()
    for start, end in zip(cuts[:-1], cuts[1:], strict=True):
        reach = longest(int(length[start]), min_score)
        yield int(item[start]), max(0, int(at[start]) - reach), int(at[end - 1]) + reach


def reachable(item: np.ndarray, window: np.ndarray, min_score: float) -> bool:
    """Whether the window has enough words of the item, in any order, to reach the score."""
    return np.isin(item, window).sum() * MATCH >= min_score * MATCH * len(item)


def _aligned(candidates: dict[int, list], seeds: Seeds, min_score: float):
    """(row, item, score, start, end) of candidates that reach the score."""
    for i, found in candidates.items():
        item = seeds.words[i]
        found.sort(key=lambda c: len(c[2]))
        lo = 0
        while lo < len(found):
            hi = lo + 1
            while hi < len(found) and hi - lo < TOGETHER and (hi + 1 - lo) * len(found[hi][2]) <= ROW_CELLS:
                hi += 1
            part, lo = found[lo:hi], hi
            lengths = np.array([len(c[2]) for c in part])
            windows = np.zeros((len(part), lengths.max()), np.uint64)
            for k, (_, _, w) in enumerate(part):
                windows[k, : len(w)] = w
            best, end = smith_waterman(item, windows, lengths)
            for k in np.flatnonzero(best >= min_score * MATCH * len(item)).tolist():
                row, offset, w = part[k]
                back = w[: end[k]][::-1]
                _, length = smith_waterman(item[::-1], back[None, :], np.array([len(back)]))
                yield row, i, float(best[k] / (MATCH * len(item))), offset + int(end[k] - length[0]), offset + int(end[k])


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    seed: int = SEED,
    min_score: float = MIN_SCORE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document and item found in it: id, text_hash, item_id, score, first_word, end_word (of the best place)."""
    texts = documents(docs, id_col, text_col)
    table = stored(
        items.select(
            items[item_id_col].cast("long").alias("item_id"),
            F.coalesce(items[item_text_col].cast("string"), F.lit("")).alias("text"),
        )
    )
    chars = table.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // BLOCK_CHARS))
    schema = "id long, text_hash long, item_id long, score double, first_word long, end_word long"
    found = docs.sparkSession.createDataFrame([], schema)
    for block in range(blocks):
        part = table.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        names, written = [r["item_id"] for r in part], [r["text"] for r in part]
        seeds = seeds_of(written, seed)
        if seeds is not None:
            found = found.unionByName(_search(texts, names, seeds, min_score, schema))
    best = F.max(F.struct("score", "first_word", "end_word")).alias("best")
    return found.groupBy("id", "text_hash", "item_id").agg(best).select(
        "id", "text_hash", "item_id", "best.score", "best.first_word", "best.end_word"
    )


def _search(texts: DataFrame, names: list, seeds: Seeds, min_score: float, schema: str) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            candidates: dict[int, list] = {}
            for row, text in enumerate(batch.column("text")):
                words = word_hashes(text.as_py())
                places, numbers = seeds.find(words)
                if len(places):
                    for item, start, end in regions(places, numbers, seeds, min_score):
                        if reachable(seeds.words[item], words[start:end], min_score):
                            candidates.setdefault(item, []).append((row, start, words[start:end]))
            rows = list(_aligned(candidates, seeds, min_score))
            take = pa.array([r[0] for r in rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(take), batch.column("text_hash").take(take)]
                + [pa.array([names[r[1]] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.float64())]
                + [pa.array([r[k] for r in rows], pa.int64()) for k in (3, 4)],
                ["id", "text_hash", "item_id", "score", "first_word", "end_word"],
            )

    return texts.mapInArrow(search, schema)
