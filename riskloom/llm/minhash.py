r"""MinHash near-dedup with min-max signatures.

Under each permutation both the smallest and the largest value are kept: each of the two
agrees between two sets with the probability of their Jaccard similarity, so k permutations give 2k
unbiased values for k evaluations.  Bands of `ROWS` values, mixed from different
permutations, put sets into buckets.

No pair of a bucket is listed.  The steps, with `node` a distinct set of shingles:
1. Rows with equal sets are one node: copies cost a hash aggregate.
2. Buckets are read as sorted streams.  A set further than `TIGHT` from all leaders of its bucket becomes a
   leader; it is tied to those within `LOOSE`.  Distances between signatures obey the triangle
   inequality, so linked sets are tied to a common leader; only a spanning forest of the ties leaves.
3. The ties' components are families.  Their full sets are cut into blocks of bounded
   size, and each pair of blocks is searched in one task, so a set is shuffled once per other block of its family: prefix
   filter, a bound on what is shared behind the prefixes, then the exact Jaccard condition in integers; again only a
   spanning forest leaves.
4. Components of the verified links are the result.

Words are `[^\x20\x09-\x0D]+` after lower-casing A-Z; shorter texts than a shingle are one
shingle.  Defined cases: null, empty or blank texts have no set and are linked with nothing; rows that
repeat a text are linked; a component without any id has a null component_id, and its rows
are kept; rows that repeat the kept id are all kept; empty tables give empty results; other
columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import documents, in_slices
from riskloom.llm.components import components
from riskloom.session import stored

ROWS = 4
# Signature similarity that makes a set a follower of a leader, and that ties two sets.
TIGHT, LOOSE = 0.85, 0.5
# Shingles in a block of full sets: 8 bytes each, two blocks to a task.
BLOCK = 1_000_000
# Shingles that are hashed at a time: they and what is made of them stay in a core's cache.
GROUP = 32_768
# Bytes of the longest words that are hashed with others.
LONG_WORD = 64

_U = np.uint64
_C1, _C2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
# The lowest 0 to 8 bytes.
_LOW = np.array([2 ** (8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _C1
    x = (x ^ (x >> _U(27))) * _C2
    return x ^ (x >> _U(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, one text behind the other, and how many words each text has.

    Eight bytes at a time, all words together: different words of the same length up to eight have different hashes.
    """
    # A space before and at least eight behind: words have two edges, and eight bytes can be read from each of theirs.
    joined = b"".join([b" ", b" ".join(texts).lower(), b" " * 9])
    buffer = np.frombuffer(joined, np.uint8)
    space = (buffer == 32) | (buffer - np.uint8(9) < 5)
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, length = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(joined) - 7, "<u8", joined, strides=(1,))
    h = mix(length.astype(np.uint64) + _C2)
    some = np.flatnonzero(length <= LONG_WORD)
    for k in range(0, LONG_WORD, 8):
        if k:
            some = some[length[some] > k]
        if not len(some):
            break
        left = np.minimum(length[some] - k, 8)
        h[some] = mix(h[some] ^ (eight[start[some] + k] & _LOW[left])) + _C2
    for i in np.flatnonzero(length > LONG_WORD).tolist():
        h[i] = xxhash.xxh64_intdigest(joined[start[i] : start[i] + length[i]])
    ends = np.cumsum([len(t) + 1 for t in texts])
    return h, np.diff(np.searchsorted(start, ends + 1), prepend=0)


def _windows(w: np.ndarray, size: int) -> np.ndarray:
    """One hash for each window of `size` neighbours."""
    h = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        h = mix(h ^ w[k : len(w) - size + 1 + k]) + _C2
    return h


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct 64-bit hashes of each text's shingles, one text behind the other, and how many each has."""
    w, length = word_hashes(texts)
    n = np.where(length >= size, length - size + 1, np.minimum(length, 1))
    values, ends, word_ends = np.empty(n.sum(), np.uint64), np.cumsum(n), np.cumsum(length)
    if len(w) >= size:
        # All texts in one go; windows over the end of a text are left out.
        inside = np.ones(len(w), bool)
        for k in range(1, size):
            inside[word_ends[length >= k] - k] = False
        h = _windows(w, size)
        values[np.repeat(length >= size, n)] = h[inside[: len(h)]]
    for i in np.flatnonzero((length > 0) & (length < size)).tolist():
        values[ends[i] - 1] = _windows(w[word_ends[i] - length[i] : word_ends[i]], length[i])[0]
    new = np.ones(len(values), bool)
    for end, k in zip(ends.tolist(), n.tolist(), strict=True):
        values[end - k : end].sort()
    new[1:] = values[1:] != values[:-1]
    full = n > 0
    new[(ends - n)[full]] = True
    count = np.zeros(len(texts), np.int64)
    if full.any():
        count[full] = np.add.reduceat(new, (ends - n)[full], dtype=np.int64)
    return values[new], count


def shingles(text: str, size: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    return shingle_sets([text.encode()], size)[0]


def _constants(permutations: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240607).integers(0, 2**63, (2, permutations)).astype(np.uint64)
    return r[0], r[1] * _U(2) + _U(1)


def signatures(values: np.ndarray, starts: np.ndarray, permutations: int) -> np.ndarray:
    """A row for each set of `values`, none empty: first its minima under all permutations, then all maxima."""
    offsets, factors = _constants(permutations)
    out = np.empty((2 * permutations, len(starts)), np.uint64)
    x, y = np.empty_like(values), np.empty_like(values)
    for i in range(permutations):
        np.bitwise_xor(values, offsets[i], out=x)
        np.multiply(x, factors[i], out=x)
        np.right_shift(x, _U(32), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, _C1, out=x)
        np.minimum.reduceat(x, starts, out=out[i])
        np.maximum.reduceat(x, starts, out=out[permutations + i])
    return np.ascontiguousarray(out.T)


def signature(values: np.ndarray, permutations: int) -> np.ndarray:
    """Minimum and maximum under each permutation: first all minima, then all maxima."""
    return signatures(values, np.zeros(1, np.int64), permutations)[0]


def bands(sigs: np.ndarray) -> np.ndarray:
    """Per row one 64-bit key per band of ROWS values; neighbours in a band are of different permutations."""
    n = sigs.shape[1] // ROWS
    grid = sigs[:, : n * ROWS].reshape(len(sigs), ROWS, n)
    # Columns shifted by row: no band holds both values of one permutation.
    h = np.broadcast_to(np.arange(n, dtype=np.uint64), (len(sigs), n))
    for k in range(ROWS):
        h = mix(h ^ np.roll(grid[:, k], k, axis=1)) + _C2
    return h


def _grouped(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Cuts a list of texts so that each part has about GROUP words, or one text."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        # Six bytes are a word, about.
        if i > start and size + len(text) > 6 * GROUP:
            yield texts[start:i]
            start, size = i, 0
        size += len(text)
    yield texts[start:]


def sketches(docs: DataFrame, size: int, permutations: int) -> DataFrame:
    """id, text_hash, n, set_id (128 bits), sig (low bytes), bands of `common.documents`."""
    names = ["id", "text_hash", "n", "set_id", "sig", "bands"]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows = []
            for texts in _grouped(batch.column("text").cast(pa.binary()).to_pylist()):
                values, count = shingle_sets(texts, size)
                starts = np.cumsum(count) - count
                sigs = signatures(values, starts[count > 0], permutations)
                low = (sigs >> _U(24)).astype(np.uint8)
                found = zip(low, bands(sigs).view(np.int64), strict=True)
                for start, n in zip(starts.tolist(), count.tolist(), strict=True):
                    if n:
                        sig, keys = next(found)
                        rows.append((n, xxhash.xxh3_128_digest(values[start : start + n]), sig.tobytes(), keys))
                    else:
                        rows.append((0, None, None, None))
            types = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("text_hash"), *columns], names)

    schema = "id long, text_hash long, n long, set_id binary, sig binary, bands array<long>"
    return docs.mapInArrow(sketch, schema)


class Union:
    """Disjoint sets of small integers."""

    def __init__(self):
        self.up: list[int] = []

    def add(self) -> int:
        self.up.append(len(self.up))
        return len(self.up) - 1

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def ties(rows: DataFrame, tight: float = TIGHT, loose: float = LOOSE) -> DataFrame:
    """A spanning forest (a, b) of what is tied in each bucket; `rows`: key, node, sig.

    Holds the leaders of one bucket at a time.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = None
        nodes, sigs, union = [], np.empty((0, 0), np.uint8), Union()
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = [], []
            keys = batch.column("key").to_numpy()
            node = batch.column("node").to_numpy()
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(len(keys), -1)
            width = sig.shape[1]
            cuts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
            for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if keys[start] != key:
                    key, nodes, sigs, union = keys[start], [], np.empty((0, width), np.uint8), Union()
                if not nodes and end - start == 2:
                    if (sig[start] == sig[start + 1]).mean() >= loose:
                        a.append(node[start])
                        b.append(node[start + 1])
                    if end < len(keys):
                        continue
                for i in range(start, end):
                    near = (sigs == sig[i]).mean(axis=1) if nodes else np.empty(0)
                    tied = np.flatnonzero(near >= loose).tolist()
                    if tied:
                        a.append(nodes[tied[0]])
                        b.append(node[i])
                        for other in tied[1:]:
                            if union.join(tied[0], other):
                                a.append(nodes[tied[0]])
                                b.append(nodes[other])
                    if not len(near) or near.max() < tight:
                        me = union.add()
                        nodes.append(node[i])
                        sigs = np.concatenate([sigs, sig[i : i + 1]])
                        if tied:
                            union.join(tied[0], me)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    ordered = rows.select("key", "node", "sig").repartition("key").sortWithinPartitions("key", "node")
    return ordered.mapInArrow(stream, "a long, b long").distinct()


def linked(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs with 100 * |x & y| >= percent * |x | y|.

    A linked pair shares one of the rarest shingles of both (prefix filter), and so many that the others can make up
    for the rest; candidates of one component are tried until one is linked, more of them at a time the longer it takes.
    """
    size = np.array([len(s) for s in sets])
    if len(sets) == 2:
        common = len(np.intersect1d(*sets, assume_unique=True))
        if 100 * common >= percent * (size.sum() - common):
            yield 0, 1
        return
    values, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    ends = np.cumsum(size)
    rarity = np.empty(len(values), np.int64)
    rarity[np.lexsort((values, count))] = np.arange(len(values))
    ranks = np.split(rarity[inverse], ends[:-1])
    for r in ranks:
        r.sort()
    least_shared = int((count == 1).sum())
    length = size - -(-percent * size // 100) + 1
    # The rarest shingles of each set that others have, too, and who has them, in order.
    last = np.array([r[k - 1] for r, k in zip(ranks, length.tolist(), strict=True)])
    prefixes = [r[np.searchsorted(r[:k], least_shared) : k] - least_shared for r, k in zip(ranks, length.tolist(), strict=True)]
    tokens = np.concatenate(prefixes)
    owners = np.repeat(np.arange(len(sets)), [len(p) for p in prefixes])[np.argsort(tokens, kind="stable")]
    begin = np.cumsum(np.bincount(tokens, minlength=len(values) - least_shared))
    begin = np.concatenate([[0], begin])
    passed = begin[:-1].copy()
    component, members = np.arange(len(sets)), {i: [i] for i in range(len(sets))}
    mine = np.zeros(len(values), bool)
    for x, prefix in enumerate(prefixes):
        before = [owners[i:j] for i, j in zip(begin[prefix].tolist(), passed[prefix].tolist(), strict=True) if i < j]
        passed[prefix] += 1
        if not before:
            continue
        shared = np.bincount(np.concatenate(before), minlength=x)
        y = np.flatnonzero(shared)
        # What both have up to the end of the prefix that ends first is counted; behind it is no more than that set's rest.
        most = shared[y] + np.where(last[x] <= last[y], size[x] - length[x], size[y] - length[y])
        fits = (100 + percent) * most >= percent * (size[x] + size[y])
        fits &= 100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])
        y = y[fits]
        y = y[np.argsort(-shared[y], kind="stable")]
        mine[ranks[x]] = True
        step = 1
        while len(y := y[component[y] != component[x]]):
            tried, y = y[:step], y[step:]
            step *= 4
            n = size[tried]
            common = np.add.reduceat(mine[np.concatenate([ranks[i] for i in tried])], np.cumsum(n) - n, dtype=np.int64)
            for i in tried[(100 + percent) * common >= percent * (size[x] + n)].tolist():
                a, b = int(component[i]), int(component[x])
                if a != b:
                    yield i, x
                    if len(members[a]) > len(members[b]):
                        a, b = b, a
                    component[members[a]] = b
                    members[b] += members.pop(a)
        mine[ranks[x]] = False


def verified(sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """A spanning forest (a, b) of the links within families; `sets`: family, node, n, set.

    Two blocks meet in one task, which also compares the sets of each; a block that is its whole family stays alone.
    """
    sizes = sets.groupBy("family").agg(F.ceil(F.sum("n") / block).alias("blocks"))
    i = F.pmod(F.xxhash64("node"), "blocks")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = (
        sets.join(sizes, "family")
        .withColumn("i", i)
        .withColumn("j", other)
        .where("blocks = 1 OR i <> j")
        .select("family", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "node", "set")
    )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, {}

        def links():
            nodes = list(group)
            return [(nodes[x], nodes[y]) for x, y in linked(list(group.values()), percent)] if len(nodes) > 1 else []

        for batch in batches:
            found = []
            for family, lo, hi, node, s in zip(*(batch.column(c).to_pylist() for c in dealt_names), strict=True):
                if (family, lo, hi) != key:
                    found += links()
                    key, group = (family, lo, hi), {}
                group[node] = np.frombuffer(s, np.uint64)
            yield _pairs(found)
        yield _pairs(links())

    dealt_names = ["family", "lo", "hi", "node", "set"]
    ordered = dealt.repartition("family", "lo", "hi").sortWithinPartitions("family", "lo", "hi")
    return ordered.mapInArrow(stream, "a long, b long")


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, permutations: int = 64, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of `docs`: id, text_hash, n_shingles, component_id, kept, chosen.

    `chosen` is one document of each component, also where ids are missing or repeated: that with the
    smallest id, missing ones last, and of its texts with the smallest hash.
    """
    texts = documents(docs, id_col, text_col)
    rows = stored(sketches(texts, size, permutations))
    classes = rows.where("n > 0").groupBy("set_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("one"),
        F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"),
    )
    nodes = stored(
        classes.select(
            F.monotonically_increasing_id().alias("node"), "set_id", "n", "sig", "bands",
            F.col("one.id").alias("id"), F.col("one.text_hash").alias("text_hash"),
        )
    )
    keys = nodes.select(F.explode("bands").alias("key"), "node")
    crowded = keys.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1").select("key")
    shared = keys.join(crowded, "key", "left_semi")
    tied = ties(shared.join(nodes.select("node", "sig"), "node"))
    families = stored(components(tied).withColumnRenamed("root", "family"))
    wanted = nodes.join(families, "node").select("node", "family", "n", "id", "text_hash")
    every = texts.toDF("doc_id", "text", "hash")
    of_row = every["doc_id"].eqNullSafe(wanted["id"]) & (every["hash"] == wanted["text_hash"])
    members = every.join(wanted, of_row).select("family", "node", "n", "text")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            sets = []
            for part in _grouped(batch.column("text").cast(pa.binary()).to_pylist()):
                values, count = shingle_sets(part, size)
                sets += [s.tobytes() for s in np.split(values, np.cumsum(count)[:-1])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("family", "node", "n")] + [pa.array(sets, pa.binary())],
                ["family", "node", "n", "set"],
            )

    sets = stored(members.mapInArrow(full, "family long, node long, n long, set binary"))
    grouped = components(verified(sets, percent))
    labelled = nodes.join(grouped, "node", "left").select(
        "set_id", "id", "text_hash", F.coalesce("root", "node").alias("root")
    )
    smallest = labelled.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("one")
    )
    of_set = labelled.join(smallest, "root").select(
        "set_id", F.col("one.id").alias("component_id"), F.col("one.text_hash").alias("chosen_hash")
    )
    answers = rows.where("n > 0").join(of_set, "set_id").select("id", "text_hash", "n", "component_id", "chosen_hash")
    alone = rows.where("n = 0").select(
        "id", "text_hash", "n", F.col("id").alias("component_id"), F.col("text_hash").alias("chosen_hash")
    )
    return answers.unionByName(alone).select(
        "id", "text_hash", F.col("n").alias("n_shingles"), "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        (F.col("id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("chosen_hash"))).alias("chosen"),
    )
