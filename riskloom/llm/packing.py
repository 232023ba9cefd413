"""Best-fit packing with swap-based local search.

Texts become token ids plus an end id; only longer documents are cut, into pieces of the
sequence length.  Full pieces are sequences of their own.  The others are dealt by row into
shards of about SHARD pieces (a random share of all lengths, which costs at most about one
sequence per shard), and each shard is packed best-fit first, largest pieces first.  Local search
then works on the underfull sequences: pieces of the emptiest one are moved to, or
exchanged one-for-one or two-for-one with, any of the others where that raises the sum of squared fills,
until it is empty or nothing helps, and so on with the next, until a lower bound is reached or all were tried.

Defined cases: null or empty text is one piece, the end id; every row is packed, repeated ones each on
their own; ties in length go by row; a text is tokenised whole, word by word, with a bounded cache;
empty tables give empty results; other columns are ignored.
"""

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import free_names, in_slices
from riskloom.session import stored

LENGTH = 4096
END_ID = 1
# Pieces that one task packs; the number of shards follows from the number of pieces.
SHARD = 20_000
# Words whose ids a Python worker remembers.
CACHE = 250_000


class WordIds(dict):
    """Words, as written between blanks, to their ids as little-endian bytes.

    The tokenizer splits at every blank and line break, and between an ASCII letter and the
    punctuation in TAIL, before it looks at anything else; it lower-cases and
    normalises each part by itself.  So the ids of a text are those of its words in order.
    Plain lower-case words skip the normaliser and go to the model at once.
    """

    TAIL = ".,!?#$%*&|;"
    _PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        # The byte-level alphabet: printable bytes stand for themselves, others follow at 256.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in shown]
        self.letter = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def __missing__(self, word: str) -> bytes:
        stem = word.rstrip(self.TAIL)
        if stem != word and stem and "a" <= stem[-1] <= "z":
            ids = self[stem] + self[word[len(stem) :]]
        elif self._PLAIN(word):
            if not word.isascii():
                word_bytes = "".join(map(self.letter.__getitem__, word.encode()))
            else:
                word_bytes = word
            ids = np.array([t.id for t in self.model.tokenize(word_bytes)], "<u4").tobytes()
        elif (lower := word.translate(_LOWER)) != word:
            ids = self[lower]
        else:
            ids = np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self) < CACHE:
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        if "<|" in text:  # may be a special token, which is case-sensitive
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


_LOWER = {c: c + 32 for c in range(65, 91)}


@lru_cache(maxsize=1)
def _words(path: str) -> WordIds:
    from tokenizers import Tokenizer

    return WordIds(Tokenizer.from_file(path))


def pieces(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and with `with_ids` the ids as little-endian bytes."""
    end = np.array([end_id], "<u4").tobytes()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids
    names = [part.split()[0] for part in schema.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(tokenizer)
        for batch in in_slices(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = words.of(text.as_py() or "") + end
                for k, start in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[start : start + 4 * length]
                    row = (doc_id, k, start // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names)

    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return texts.mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of piece numbers: each piece, largest first, into the fullest bin that still takes it."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0  # bit r is set if some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        if room - size:
            by_room[room - size].append(b)
            rooms |= 1 << (room - size)
    return bins


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A number of bins below which the pieces cannot be packed (the bound L2 of Martello and Toth)."""
    sizes = np.sort(np.asarray(lengths, np.int64))
    total = np.concatenate([[0], np.cumsum(sizes)])
    half = np.searchsorted(sizes, capacity // 2, side="right")
    small = np.unique(np.concatenate([[0], sizes[:half]]))
    large = np.maximum(np.searchsorted(sizes, capacity - small, side="right"), half)
    room = (large - half) * capacity - (total[large] - total[half])
    rest = total[half] - total[np.searchsorted(sizes, small)]
    return int((len(sizes) - half + np.maximum(0, -(-(rest - room) // capacity))).max())


class _Underfull:
    """The pieces of bins as one sorted array of (bin, size), searched for all bins at once."""

    def __init__(self, bins, size, fill, capacity):
        self.bins, self.size, self.fill, self.capacity = bins, size, fill, capacity
        self.keys = self.pieces = self.bin_of = self.sizes = np.empty(0, np.int64)
        self.open = np.zeros(len(bins), bool)

    def add(self, b: int) -> None:
        self.add_all([b])

    def add_all(self, some: list[int]) -> None:
        self.open[some] = True
        pieces = np.array([i for b in some for i in self.bins[b]], np.int64)
        bin_of, sizes = np.repeat(some, [len(self.bins[b]) for b in some]), self.size[pieces]
        order = np.lexsort((sizes, bin_of))
        pieces, bin_of, sizes = pieces[order], bin_of[order], sizes[order]
        keys = bin_of * (self.capacity + 1) + sizes
        at = np.searchsorted(self.keys, keys)
        self.keys, self.pieces = np.insert(self.keys, at, keys), np.insert(self.pieces, at, pieces)
        self.bin_of, self.sizes = np.insert(self.bin_of, at, bin_of), np.insert(self.sizes, at, sizes)

    def remove(self, b: int) -> None:
        self.open[b] = False
        gone = slice(*np.searchsorted(self.keys, [b * (self.capacity + 1), (b + 1) * (self.capacity + 1)]))
        self.keys, self.pieces = np.delete(self.keys, gone), np.delete(self.pieces, gone)
        self.bin_of, self.sizes = np.delete(self.bin_of, gone), np.delete(self.sizes, gone)

    def best_step(self, size: int, above: int) -> tuple[int, tuple[int, ...]] | None:
        """The bin, and the pieces it gives back, that end fullest, and over `above`, after taking a piece of `size`."""
        best, most = None, above
        fits = np.flatnonzero(self.open & (self.fill <= self.capacity - size))
        if len(fits):
            b = int(fits[self.fill[fits].argmax()])
            if self.fill[b] + size > most:
                best, most = (b, ()), int(self.fill[b]) + size
        if most == self.capacity:
            return best
        keys, pieces, bins, sizes = self.keys, self.pieces, self.bin_of, self.sizes
        after = self.fill[bins] + size
        need = after - self.capacity
        able = (need > 0) & (sizes < size)
        one = np.flatnonzero(able & (sizes >= need))
        if len(one):
            e = one[(after[one] - sizes[one]).argmax()]
            if after[e] - sizes[e] > most:
                best, most = (int(bins[e]), (int(pieces[e]),)), int(after[e] - sizes[e])
        if most == self.capacity:
            return best
        # The smallest partner that makes enough room, of the same bin.
        two = np.flatnonzero(able & (sizes < need))
        other = np.searchsorted(keys, keys[two] - 2 * sizes[two] + need[two])
        other += other == two
        two, other = two[other < len(keys)], other[other < len(keys)]
        good = (bins[other] == bins[two]) & (sizes[two] + sizes[other] < size)
        two, other = two[good], other[good]
        if len(two):
            end = after[two] - sizes[two] - sizes[other]
            k = end.argmax()
            if end[k] > most:
                best = int(bins[two[k]]), (int(pieces[two[k]]), int(pieces[other[k]]))
        return best


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Empties bins, the least filled first, by moves and exchanges that raise the sum of squared fills.

    A piece goes to another underfull bin, for nothing, for one smaller piece, or for two that are smaller
    together; all underfull bins are looked at.  Ends when there are as few bins as there can be, or when
    every underfull bin has been tried.
    """
    size = np.asarray(lengths, np.int64)
    bins = sorted((list(b) for b in bins), key=lambda b: -size[b].sum())
    fill = np.array([size[b].sum() for b in bins], np.int64)
    spare = len(bins) - least_bins(size, capacity)
    sources = np.flatnonzero(fill < capacity).tolist()
    under = _Underfull(bins, size, fill, capacity)
    if spare > 0:
        under.add_all(sources)
    while sources and spare > 0:
        source = sources.pop()
        if fill[source] == capacity:
            continue
        under.remove(source)
        improved = True
        while improved and bins[source]:
            improved = False
            first = {int(size[i]): i for i in reversed(bins[source])}
            for s in sorted(first, reverse=True):
                step = under.best_step(s, int(fill[source]))
                if step is None:
                    continue
                i, (target, back) = first[s], step
                moved = s - sum(int(size[j]) for j in back)
                under.remove(target)
                bins[source] = [j for j in bins[source] if j != i] + list(back)
                bins[target] = [j for j in bins[target] if j not in back] + [i]
                fill[source] -= moved
                fill[target] += moved
                if fill[target] < capacity:
                    under.add(target)
                improved = True
                break
        if bins[source]:
            under.add(source)
        else:
            spare -= 1
    return [b for b in bins if b]


def pack(parts: DataFrame, length: int = LENGTH, shard: int = SHARD) -> DataFrame:
    """Adds `sequence_id` and `offset` to pieces with a `length`, in place of columns so named; all others stay."""
    names = [c for c in parts.columns if c.lower() not in ("sequence_id", "offset")]
    row_name, shard_name = free_names(parts, "__row", "__shard")
    rows = stored(parts.select(*names).withColumn(row_name, F.monotonically_increasing_id()))
    shards = max(1, -(-rows.where(F.col("length") < length).count() // shard))
    full = rows.where(F.col("length") >= length).select(
        *names, (-1 - F.col(row_name)).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by(row_name)
        lengths = table["length"].to_numpy()
        bins = local_search(best_fit(lengths, length), lengths, length)
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for b, members in enumerate(bins):
            sequence[members] = b
            offset[members] = np.cumsum(lengths[members]) - lengths[members]
        base = table[shard_name][0].as_py() << 32
        placed = table.select(names).append_column("sequence_id", pa.array(base + sequence))
        return placed.append_column("offset", pa.array(offset))

    short = rows.where(F.col("length") < length).withColumn(
        shard_name, F.pmod(F.xxhash64(row_name), F.lit(shards))
    )
    return full.unionByName(short.groupBy(shard_name).applyInArrow(packed, full.schema))
