"""Vector code compression: product quantisation, entries found by a GNAT.

A vector of integers is cut into equal parts, and every part is coded by the nearest entry of its position's
codebook.  Codebooks are refined by rounds of assignment and of means; a task sends one sum per part and entry,
so what is shuffled and what the driver sees has the size of the codebooks, however many vectors there are.

Entries are searched in a geometric near-neighbour access tree (GNAT).  A node has a few split points; every
other entry goes to the child of the split point nearest to it, and each split point keeps, per child, the least
and greatest distance from it to that child's entries.  A query measures its distance to a split point, and a
child whose range lies strictly beyond that distance plus or minus the best one so far is left out with its
whole subtree (triangle inequality).  Distances are integers squared; their roots are rounded outwards before
such a comparison, so nothing is left out by rounding, and an entry that ties with the best one is always
visited.  The nearest is decided by squared integers alone, ties by lower index.  Queries pass through the tree
together: each node takes the arrays of those that still reach it.

Defined cases: vectors that are null, empty, or hold null or non-finite components are dropped, and so are those
whose length is not that of the vector with the least id (least components on ties); a length that the parts do not
divide is filled up with zeros; components beyond the limit that keeps squared distances in 64 bits (`limit_of`: 2**27
for 64 dimensions, which is 32,768.0 before scaling) count as that limit; rows without id start a codebook only behind
all others; fewer vectors than entries make smaller codebooks; repeated rows count each; no vectors give no rows.
"""

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import BATCH_BYTES
from riskloom.session import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
DEGREE = 4


def limit_of(dimensions: int) -> int:
    """The greatest absolute component for which a whole vector's squared distance stays below 2**62."""
    return math.isqrt(2**62 // (4 * max(dimensions, 1)))


def _roots(squared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds from below and above on the roots of squared integers."""
    root = np.sqrt(squared.astype(np.float64))
    return np.maximum(root * (1 - 1e-12) - 1e-9, 0), root * (1 + 1e-12) + 1e-9


def _squared(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    step = points - centre
    return np.einsum("ij,ij->i", step, step)


class Gnat:
    """A tree over integer points (rows), searched for the nearest one of lowest index."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE) -> None:
        self.points, self.degree = points, degree
        self.visited = 0
        self.root = self._node(np.arange(len(points)))

    def _node(self, members: np.ndarray):
        """(split points, per split point and child the range of distances, children); a small node is a leaf."""
        if len(members) <= self.degree:
            return members, None, None
        # Split points far apart: each one is the member farthest from those chosen before.
        splits = [0]
        nearest = _squared(self.points[members], self.points[members[0]])
        while len(splits) < self.degree:
            splits.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, _squared(self.points[members], self.points[members[splits[-1]]]))
        splits = sorted(set(splits))
        if len(splits) < 2:
            return members, None, None
        split = members[splits]
        rest = np.delete(members, splits)
        distance = np.stack([_squared(self.points[rest], self.points[s]) for s in split])
        home = distance.argmin(axis=0)
        ranges = np.empty((len(split), len(split), 2))
        for j, s in enumerate(split):
            group = np.concatenate([[s], rest[home == j]])
            for i, p in enumerate(split):
                low, high = _roots(_squared(self.points[group], self.points[p]))
                ranges[i, j] = low.min(), high.max()
        children = [self._node(rest[home == j]) if (home == j).any() else None for j in range(len(split))]
        return split, ranges, children

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query the index of the nearest point and the squared distance to it."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.zeros(len(queries), np.int64)
        self._search(self.root, queries, np.arange(len(queries)), best, index)
        return index, best

    def _search(self, node, queries, rows, best, index) -> None:
        split, ranges, children = node
        # A split point counts in its child's ranges: a child that is left out takes its split point with it.
        alive = np.ones((len(split), len(rows)), bool)
        for i, point in enumerate(split):
            near = rows[alive[i]]
            self.visited += len(near)
            distance = _squared(queries[near], self.points[point])
            better = (distance < best[near]) | ((distance == best[near]) & (point < index[near]))
            best[near[better]], index[near[better]] = distance[better], point
            if ranges is None:
                continue
            low, high = _roots(distance)
            radius = _roots(best[near])[1]
            where = np.flatnonzero(alive[i])
            for j in range(len(split)):
                out = (low - radius > ranges[i, j, 1]) | (high + radius < ranges[i, j, 0])
                alive[j, where[out]] = False
        if children is None:
            return
        for j, child in enumerate(children):
            if child is None or not alive[j].any():
                continue
            self._search(child, queries, rows[alive[j]], best, index)


class Codebooks:
    """Entries per part position (arrays of integer rows) and a tree over each."""

    def __init__(self, entries: list[np.ndarray]) -> None:
        self.entries = entries
        self.trees = [Gnat(e) for e in entries]

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry, per vector (row) and part (column)."""
        width = vectors.shape[1] // len(self.trees)
        found = [t.nearest(vectors[:, p * width : (p + 1) * width]) for p, t in enumerate(self.trees)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def digest(self) -> str:
        text = ",".join(str(int(x)) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(text.encode()).hexdigest()


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches of BATCH_BYTES at most, or one row, and their column `x` of `width` integers a row."""
    rows = max(1, BATCH_BYTES // (8 * width))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            part = batch.slice(start, rows)
            yield part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, width)


def integers(
    vectors: DataFrame, scale: int = SCALE, parts: int = PARTS, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, int]:
    """The kept vectors as stored rows `id`, `label`, `x` (integers), and the length of `x`; 0 without any row."""
    given = vectors.select(
        vectors[id_col].cast("long").alias("id"),
        vectors[label_col].alias("label"),
        vectors[vector_col].cast("array<double>").alias("v"),
    ).where("size(v) > 0 AND forall(v, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('Infinity'))")
    first = given.orderBy(F.col("id").asc_nulls_last(), "v").limit(1).select(F.size("v")).collect()
    if not first:
        return given.select("id", "label", F.expr("CAST(v AS array<long>)").alias("x")), 0
    size = first[0][0]
    width = -(-size // parts) * parts
    top = limit_of(width)
    whole = F.transform("v", lambda c: F.greatest(F.least(F.floor(F.least(F.greatest(c * scale, F.lit(-1e18)), F.lit(1e18))), F.lit(top)), F.lit(-top)))
    filled = F.concat(whole, F.array_repeat(F.lit(0).cast("long"), width - size)) if width > size else whole
    return stored(given.where(F.size("v") == size).select("id", "label", filled.cast("array<long>").alias("x"))), width


def _summed(rows: DataFrame, books: Codebooks, width: int) -> DataFrame:
    """Per part, entry and component the sum over assigned vectors, and per part and entry (component -1) their count."""
    part_width = width // len(books.trees)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], int] = {}
        for _, x in _matrices(batches, width):
            index, _ = books.assign(x)
            for p, book in enumerate(books.entries):
                count = np.bincount(index[:, p], minlength=len(book))
                for e in np.flatnonzero(count).tolist():
                    total[p, e, -1] = total.get((p, e, -1), 0) + int(count[e])
                    sums = x[index[:, p] == e, p * part_width : (p + 1) * part_width].sum(axis=0)
                    for c, value in enumerate(sums.tolist()):
                        total[p, e, c] = total.get((p, e, c), 0) + value
        if total:
            keys = list(total)
            columns = [pa.array([k[i] for k in keys], pa.int32()) for i in range(3)]
            values = pa.array([str(total[k]) for k in keys])
            yield pa.RecordBatch.from_arrays([*columns, values], ["part", "entry", "component", "total"])

    found = rows.select("x").mapInArrow(partial, "part int, entry int, component int, total string")
    return found.groupBy("part", "entry", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def train(
    rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codebooks:
    """The codebooks after `rounds` rounds over all rows of `integers`."""
    part_width = width // parts
    seeds = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    start = np.array([r["x"] for r in seeds], np.int64).reshape(len(seeds), width)
    books = Codebooks([start[:, p * part_width : (p + 1) * part_width].copy() for p in range(parts)])
    for _ in range(rounds):
        # As many rows as the codebooks have components.
        total = {(r["part"], r["entry"], r["component"]): int(r["total"]) for r in _summed(rows, books, width).collect()}
        means = [book.copy() for book in books.entries]
        for (p, e, c), value in total.items():
            if c >= 0:
                means[p][e, c] = value // total[p, e, -1]
        books = Codebooks(means)
    return books


def encode(rows: DataFrame, width: int, books: Codebooks) -> DataFrame:
    """Per row of `integers`: id, label, code (two hex digits per part) and error."""
    digits = max(2, len(f"{max(len(e) for e in books.entries) - 1:x}"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _matrices(batches, width):
            index, error = books.assign(x)
            code = ["".join(f"{i:0{digits}x}" for i in row) for row in index.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error.sum(axis=1))],
                ["id", "label", "code", "error"],
            )

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(coded, f"id long, label {kind}, code string, error long")


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Per kept vector: vec_id, code, error, label_error (over equal labels, nulls together), codebooks_sha256.

    The totals per label are combined before they are shuffled, and joined back to narrow rows; Spark sends
    them whole where they are measured to be small and splits a crowded label where not.
    """
    rows, width = integers(vectors, scale, parts, id_col, vector_col, label_col)
    if not width:
        empty = rows.select(F.col("id").alias("vec_id"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.select("*", F.col("error").alias("label_error"), F.col("code").alias("codebooks_sha256"))
    books = train(rows, width, parts, entries, rounds)
    coded = stored(encode(rows, width, books))
    totals = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error"))
    joined = coded.join(totals.withColumnRenamed("label", "of"), F.col("label").eqNullSafe(F.col("of")))
    return joined.select(
        F.col("id").alias("vec_id"), "code", "error",
        F.expr("try_cast(label_error AS bigint)").alias("label_error"),
        F.lit(books.digest()).alias("codebooks_sha256"),
    )
