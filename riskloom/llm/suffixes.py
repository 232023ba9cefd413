"""Suffix-array dedup: every byte of a repeated `length`-byte string goes.

Suffix arrays are built where repeats can be, not over the corpus as one text:
1. Texts are cut into segments by window fingerprints (`fingerprints`), so equal windows meet under one
   key.  Copies of a whole text within a task are sent once; whether a text occurs twice is a count.
   Segments that repeat inside a text, as all do in periodic ones, are repeats at once and sent once.
2. Keys are read as sorted streams.  Equal segments are repeats at once; one of each kind of
   segment under a key that has several kinds is contested.
3. Only contested segments fetch their bytes.  Those of a key are concatenated and suffix-sorted in
   two stages: suffixes smaller than their successors are sorted directly, all others are induced
   by one scan over the buckets of first bytes; adjacent common prefixes of `length` bytes or more are
   repeats.  Keys with more than HOT bytes, which need no bound, are spread by window instead.
4. Repeats become spans per text; the text is cut once, and the answer is joined to the rows.

Texts are told apart by a 64-bit hash and their length.  Defined cases: null text is empty and keeps
nothing; texts shorter than `length` lose nothing; a repeated row is another occurrence, so both
copies lose everything from `length` bytes on; a null id is an id like any other; empty tables give
empty results; other columns are ignored.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import documents, in_slices
from riskloom.llm.fingerprints import segments
from riskloom.session import stored

LENGTH = 200
# Bytes sorted together, and bytes from which the segments of one key are spread by window.
TOGETHER, HOT = 250_000, 1_000_000


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of `text` (bytes; 0 separates) in the order of their first `depth` bytes."""
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    # Smaller than its successor: decided by the next byte that differs; the last suffix is not.
    differs = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    decided = differs[np.searchsorted(differs, np.arange(n))]
    following = np.append(text[1:], 0).astype(np.int16)
    following[-1] = -1
    smaller = text[decided] < following[decided]
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    strings = np.lib.stride_tricks.as_strided(padded, (n, depth), (1, 1))
    direct = np.flatnonzero(smaller)
    direct = direct[np.argsort(np.ascontiguousarray(strings[direct]).view(f"S{depth}").ravel(), kind="stable")]
    firsts = text[direct]
    edges = np.searchsorted(firsts, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if not smaller[n - 1]:
        induced[text[n - 1]].append(np.array([n - 1]))
    order = []
    for c in range(256):
        scanned, todo = [], induced[c]
        while todo:
            part = np.concatenate(todo)
            scanned.append(part)
            before = part[part > 0] - 1
            todo = [same] if len(same := before[(text[before] == c) & ~smaller[before]]) else []
        scanned.append(direct[edges[c] : edges[c + 1]])
        bucket = np.concatenate(scanned)
        if not len(bucket):
            continue
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[(text[before] > c) & ~smaller[before]]
        if len(before):
            keys = text[before]
            by = np.argsort(keys, kind="stable")
            before, keys = before[by], keys[by]
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for part in np.split(before, cuts):
                induced[text[part[0]]].append(part)
    return np.concatenate(order)


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """Per part, the starts of its `length`-byte windows that occur twice or more in all parts."""
    sizes = np.array([len(p) for p in parts])
    # No byte of UTF-8 is 255, so 0 is free to separate.
    text = np.frombuffer(b"\xff".join(parts) + b"\xff", np.uint8) + np.uint8(1)
    begins = np.cumsum(sizes + 1) - sizes - 1
    valid = np.zeros(len(text), bool)
    for begin, size in zip(begins.tolist(), sizes.tolist(), strict=True):
        valid[begin : begin + max(0, size - length + 1)] = True
    order = suffix_array(text, length)
    order = order[valid[order]]
    strings = np.lib.stride_tricks.as_strided(text, (len(text) - length + 1, length), (1, 1)) if len(text) >= length else None
    long_enough = np.zeros(len(order) + 1, bool)  # common prefix with the one before
    for at in range(1, len(order), 20_000):
        end = min(len(order), at + 20_000)
        rows = np.ascontiguousarray(strings[order[at - 1 : end]]).view(f"V{length}").ravel()
        long_enough[at:end] = rows[1:] == rows[:-1]
    repeated = np.sort(order[long_enough[:-1] | long_enough[1:]])
    cuts = np.searchsorted(repeated, np.append(begins, len(text)))
    return [repeated[a:b] - begin for a, b, begin in zip(cuts[:-1], cuts[1:], begins, strict=True)]


_RUN = "text_hash long, n int, start int, end int"
_PACKED = "text_hash long, n int, packed binary"


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The byte spans that windows at ascending `starts` cover, overlapping ones joined."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    first, last = np.append(starts[0], starts[cut]), np.append(starts[cut - 1], starts[-1])
    return list(zip(first.tolist(), (last + length).tolist(), strict=True))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, types[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields]
    )


def _segmented(texts: DataFrame, length: int) -> DataFrame:
    """key, digest, text_hash, n, lo, hi of the segments; a text once per task, equal segments of a text once.

    Rows with `here` are repeats within their text already; their key only spreads them.
    """
    names = ["key", "digest", "text_hash", "n", "lo", "hi", "here"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in in_slices(batches):
            columns = []
            for h, text in zip(batch.column("text_hash").to_pylist(), batch.column("text"), strict=True):
                data = text.as_buffer().to_pybytes()
                if len(data) < length or (h, len(data)) in seen:
                    continue
                seen.add((h, len(data)))
                key, digest, lo, hi = segments(data, length)
                order = np.lexsort((digest, key))
                again = np.zeros(len(key) + 1, bool)  # equal to the one before, in this order
                again[1:-1] = (key[order[1:]] == key[order[:-1]]) & (digest[order[1:]] == digest[order[:-1]])
                once, here = order[~again[:-1]], np.sort(order[again[:-1] | again[1:]])
                if len(here):  # neighbours as one row
                    cuts = np.flatnonzero(lo[here[1:]] > hi[here[:-1]] + length) + 1
                    first, last = np.append(0, cuts), np.append(cuts, len(here)) - 1
                    lo = np.concatenate([lo[once], lo[here[first]]])
                    hi = np.concatenate([hi[once], hi[here[last]]])
                    spread = np.full(len(first), h, np.int64).view(np.uint64)
                    key, digest = np.append(key[once], spread), np.append(digest[once], spread)
                local = np.arange(len(key)) >= len(once)
                columns.append(
                    (key.view(np.int64), digest.view(np.int64), np.full(len(key), h, np.int64),
                     np.full(len(key), len(data), np.int32), lo.astype(np.int32), hi.astype(np.int32), local)
                )
            if columns:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*columns, strict=True)], names)

    return texts.mapInArrow(cut, "key long, digest long, text_hash long, n int, lo int, hi int, here boolean")


def _classified(rows: DataFrame) -> DataFrame:
    """Segments with an equal one elsewhere (`whole`), and one of each kind under keys with several."""
    schema = "key long, text_hash long, n int, lo int, hi int, whole boolean"

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # `kind`: the rows of one key and digest so far: their first row, whether it was seen twice.
        key = digest = last = first = None
        twice = several = False
        for batch in batches:
            out = []
            for *row, here in zip(*(batch.column(c).to_pylist() for c in [*columns, "here"]), strict=True):
                if here:
                    out.append((row[0], *row[2:], True))
                    continue
                if row == last:
                    continue  # the same place, sent by another task
                last = row
                if row[0] == key and row[1] == digest:
                    if not twice:
                        out.append((key, *first, True))
                        twice = True
                    out.append((key, *row[2:], True))
                    continue
                if row[0] == key:
                    if not several:
                        out.append((key, *first, False))
                    several = True
                    out.append((key, *row[2:], False))
                else:
                    several = False
                key, digest, first, twice = row[0], row[1], tuple(row[2:]), False
            yield _batch(out, schema)

    columns = ["key", "digest", "text_hash", "n", "lo", "hi"]
    return rows.repartition("key").sortWithinPartitions(*columns).mapInArrow(stream, schema)


def _packed(texts: DataFrame, length: int) -> DataFrame:
    """Each text of `length` bytes or more, compressed, once per task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, press = set(), zstandard.ZstdCompressor(level=1)
        for batch in in_slices(batches):
            rows = []
            for h, text in zip(batch.column("text_hash").to_pylist(), batch.column("text"), strict=True):
                data = text.as_buffer().to_pybytes()
                if len(data) >= length and (h, len(data)) not in seen:
                    seen.add((h, len(data)))
                    rows.append((h, len(data), press.compress(data)))
            yield _batch(rows, _PACKED)

    return texts.select("text_hash", "text").mapInArrow(pack, _PACKED)


def _with_bytes(contested: DataFrame, packed: DataFrame, length: int) -> DataFrame:
    """key, text_hash, n, lo, bytes of the contested segments."""
    wanted = contested.groupBy("text_hash", "n").agg(F.collect_list(F.struct("key", "lo", "hi")).alias("parts"))
    schema = "key long, text_hash long, n int, lo int, bytes binary"

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in in_slices(batches, "packed"):
            rows = []
            for h, n, packed_text, parts in zip(*(batch.column(c).to_pylist() for c in ("text_hash", "n", "packed", "parts")), strict=True):
                data = unpress.decompress(packed_text)
                rows += [(p["key"], h, n, p["lo"], data[p["lo"] : p["hi"] + length]) for p in parts]
            yield _batch(rows, schema)

    return packed.join(wanted, ["text_hash", "n"]).mapInArrow(fetch, schema)


def _compared(rows: DataFrame, length: int, together: int) -> DataFrame:
    """Spans of the repeated windows of contested segments, by suffix arrays over whole keys."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last, group, size = None, None, [], 0

        def spans():
            found = repeated_windows([g[3] for g in group], length)
            return [
                (h, n, lo + s, lo + e)
                for (h, n, lo, _), starts in zip(group, found, strict=True)
                for s, e in _runs(starts, length)
            ]

        for batch in batches:
            out = []
            for k, h, n, lo, data in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if k != key and size > together:
                    out += spans()
                    group, size = [], 0
                if (k, h, n, lo) != last:  # else the same place, from another copy of the text
                    group.append((h, n, lo, data))
                    size += len(data)
                key, last = k, (k, h, n, lo)
            yield _batch(out, _RUN)
        if group:
            yield _batch(spans(), _RUN)

    columns = ["key", "text_hash", "n", "lo", "bytes"]
    ordered = rows.select(*columns).repartition("key").sortWithinPartitions(*columns[:4])
    return ordered.mapInArrow(stream, _RUN)


def _by_window(rows: DataFrame, length: int) -> DataFrame:
    """The same spans, for keys of any size: windows are grouped by 128-bit digests of their bytes."""
    schema = "w1 long, w2 long, text_hash long, n int, at int"

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for h, n, lo, data in zip(*(batch.column(c).to_pylist() for c in ("text_hash", "n", "lo", "bytes")), strict=True):
                count = len(data) - length + 1
                digests = b"".join(xxhash.xxh3_128_digest(data[i : i + length]) for i in range(count))
                w = np.frombuffer(digests, np.int64).reshape(-1, 2)
                yield _batch([(int(a), int(b), h, n, lo + i) for i, (a, b) in enumerate(w)], schema)

    each = stored(rows.mapInArrow(windows, schema).distinct())
    twice = each.groupBy("w1", "w2").agg(F.count("*").alias("places")).where("places > 1")
    return each.join(twice, ["w1", "w2"], "left_semi").select(
        "text_hash", "n", F.col("at").alias("start"), (F.col("at") + length).alias("end")
    )


def dedup(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
    together: int = TOGETHER, hot: int = HOT,
) -> DataFrame:
    """Per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    texts = documents(docs, id_col, text_col)
    found = stored(_classified(_segmented(texts, length)))
    whole = found.where("whole").select("text_hash", "n", F.col("lo").alias("start"), (F.col("hi") + length).alias("end"))
    packed = _packed(texts, length)
    rows = stored(_with_bytes(found.where("NOT whole"), packed, length))
    heavy = rows.groupBy("key").agg(F.sum(F.length("bytes")).alias("size")).where(F.col("size") > hot).select("key")
    spans = (
        whole.unionByName(_compared(rows.join(heavy, "key", "left_anti"), length, together))
        .unionByName(_by_window(rows.join(heavy, "key", "left_semi"), length))
        .groupBy("text_hash", "n")
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    )
    schema = "text_hash long, n int, n_removed long, n_spans long, sha string"

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in in_slices(batches, "packed"):
            out = []
            for h, n, packed_text, marked in zip(*(batch.column(c).to_pylist() for c in ("text_hash", "n", "packed", "spans")), strict=True):
                data = unpress.decompress(packed_text)
                kept, at, removed, runs = hashlib.sha256(), 0, 0, 0
                end = -1
                for span in sorted((s["start"], s["end"]) for s in marked):
                    if span[0] > end:
                        if end >= 0:
                            removed, at = removed + end - start, end
                        start, runs = span[0], runs + 1
                        kept.update(data[at:start])
                    end = max(end, span[1])
                removed += end - start
                kept.update(data[end:])
                out.append((h, n, removed, runs, kept.hexdigest()))
            yield _batch(out, schema)

    cut = packed.join(spans, ["text_hash", "n"]).mapInArrow(remove, schema).distinct()
    every = texts.select(
        F.col("id").alias("doc_id"), "text_hash", F.octet_length("text").alias("n"), F.sha2("text", 256).alias("all_sha")
    )
    copies = every.groupBy("text_hash", "n").agg(F.count("*").alias("rows")).where(f"rows > 1 AND n >= {length}")
    nothing = F.lit(hashlib.sha256().hexdigest())
    copied = F.col("rows").isNotNull()
    return (
        every.join(cut, ["text_hash", "n"], "left")
        .join(copies, ["text_hash", "n"], "left")
        .select(
            "doc_id",
            F.col("n").cast("long").alias("n_bytes"),
            F.when(copied, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(copied, nothing).otherwise(F.coalesce("sha", "all_sha")).alias("kept_sha256"),
        )
    )
