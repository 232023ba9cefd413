"""Chat formatting: reply trees to root-to-leaf paths, ranked by score, one conversation each.

Messages are rows of a tree: `tree_id`, `node_id` (unique), `parent_id` (null, or a node that
does not exist: a root), `role`, `text`, `score`.  Paths are found by pointer doubling: round
k joins every node's pointer with the pointer found there, so 2**k ancestors are summed after
k joins, whatever the shape of the tree; nodes whose path is summed take no part in later rounds.  Only paths chosen by rank are enumerated, by the
same pointers, and every join is on single nodes: a tree with a third of all messages is
spread like any other.

A formatted turn is `open role text close`.  Control strings in texts get a backslash in
front, as do backslashes, so the text can be read back exactly (`read_turn`).

Defined cases: null text or role is empty; other roles than system, user and assistant are
written out; nodes on a cycle, or below one, have no root and take part in no path; with
equal scores the smaller leaf comes first; empty tables give empty results; further
columns are ignored.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ordering import running_totals
from riskloom.session import stored

# Fixed values of the template.
START = "<s>"
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("[ANS]", "</s>")}
OTHER, OTHER_TEXT, OTHER_END = "[ROLE]", "[/ROLE]", "</s>"
CONTROL = r"</?s>|\[/?(?:SYS|INST|ROLE)\]|\[ANS\]"

_TOKEN = re.compile(rf"\\[\s\S]|{CONTROL}")
_OPENED = {opened: role for role, (opened, _) in MARKS.items()}


def escape(column):
    """Puts a backslash before every control string and backslash."""
    return F.regexp_replace(column, rf"(\\|{CONTROL})", r"\\$1")


def unescape(text: str) -> str:
    return re.sub(r"\\([\s\S])", r"\1", text)


def read_turn(piece: str) -> tuple[str, str]:
    """Role and text of one formatted turn, from its control strings alone."""
    marks = [m for m in _TOKEN.finditer(piece) if m.group()[0] != "\\"]
    if marks[0].group() == START:
        marks = marks[1:]
    if marks[0].group() == OTHER:
        role = unescape(piece[marks[0].end() : marks[1].start()])
        marks = marks[1:]
    else:
        role = _OPENED[marks[0].group()]
    return role, unescape(piece[marks[0].end() : marks[1].start()])


def path_scores(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Per node with a root: `depth` and `path_score` of its path; and the pointer tables.

    Table k holds, for each node that has one, its ancestor 2**k steps up.
    """
    nodes = messages.select("node_id", "parent_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    parents = nodes.select(F.col("node_id").alias("parent_id"), F.lit(True).alias("found"))
    step = stored(
        nodes.join(parents, "parent_id", "left").select(
            "node_id",
            F.when(F.col("found"), F.col("parent_id")).alias("up"),
            F.lit(1).cast("long").alias("depth"),
            F.col("score").cast("double").alias("path_score"),
        )
    )
    size = step.count()
    done, pointers = [step.where("up IS NULL")], []
    active = step.where("up IS NOT NULL")
    # What still points up after this many rounds is on a cycle.
    while 2 ** len(pointers) <= size and active.limit(1).count():
        pointers.append(active.select("node_id", "up"))
        above = reduce(DataFrame.unionByName, [*done, active]).select(
            F.col("node_id").alias("up"),
            F.col("up").alias("next"),
            F.col("depth").alias("more"),
            F.col("path_score").alias("gain"),
        )
        step = stored(
            active.join(above, "up").select(
                "node_id",
                F.col("next").alias("up"),
                (F.col("depth") + F.col("more")).alias("depth"),
                (F.col("path_score") + F.col("gain")).alias("path_score"),
            )
        )
        done.append(step.where("up IS NULL"))
        active = step.where("up IS NOT NULL")
    rooted = reduce(DataFrame.unionByName, done)
    return rooted.select("node_id", "depth", "path_score"), pointers


def best_paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """The nodes of each tree's `per_tree` best branches: path_id (its leaf), tree_id, position, node_id.

    A branch's score is the mean of its nodes' scores.
    """
    scores, pointers = path_scores(messages)
    inner = messages.where("parent_id IS NOT NULL").select(F.col("parent_id").alias("node_id"))
    leaves = (
        scores.join(inner, "node_id", "left_anti")
        .join(messages.select("node_id", "tree_id"), "node_id")
        .withColumn("mean_score", F.col("path_score") / F.col("depth"))
    )
    rank = F.row_number().over(
        Window.partitionBy("tree_id").orderBy(F.desc("mean_score"), "node_id")
    )
    names = ["path_id", "tree_id", "depth", "node_id", "up"]
    chosen = leaves.withColumn("rank", rank).where(F.col("rank") <= per_tree)
    ends = chosen.select(F.col("node_id").alias("path_id"), "tree_id", "depth", "node_id", F.lit(0).cast("long").alias("up"))
    found = [stored(ends)]
    for k, pointer in enumerate(pointers):
        # Every row of a path is made by exactly one join.
        here = reduce(DataFrame.unionByName, found).where(F.col("up") + 2**k < F.col("depth"))
        jump = pointer.select("node_id", F.col("up").alias("ancestor"))
        further = here.join(jump, "node_id").select(
            "path_id", "tree_id", "depth", F.col("ancestor").alias("node_id"), (F.col("up") + 2**k).alias("up")
        )
        found.append(stored(further.select(names)))
    return reduce(DataFrame.unionByName, found).select(
        "path_id", "tree_id", (F.col("depth") - 1 - F.col("up")).alias("position"), "node_id"
    )


def format_conversations(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """The chosen paths, a row per turn: path_id, tree_id, position, piece, loss_start, loss_length.

    A path's conversation is its pieces in order, one after the other.  `loss_start` and
    `loss_length` are code points within the piece; the mask covers the escaped text of the
    assistant and nothing else, so its length is 0 for all other turns.
    """
    role = F.coalesce("role", F.lit(""))
    opened, closed = F.concat(F.lit(OTHER), escape(role), F.lit(OTHER_TEXT)), F.lit(OTHER_END)
    for name, (before, after) in MARKS.items():
        opened = F.when(role == name, F.lit(before)).otherwise(opened)
        closed = F.when(role == name, F.lit(after)).otherwise(closed)
    opened = F.concat(F.when(F.col("position") == 0, F.lit(START)).otherwise(F.lit("")), opened)
    turns = best_paths(messages, per_tree).join(messages.select("node_id", "role", "text"), "node_id")
    return (
        turns.withColumn("body", escape(F.coalesce("text", F.lit(""))))
        .withColumn("opened", opened)
        .select(
            "path_id",
            "tree_id",
            "position",
            F.concat("opened", "body", closed).alias("piece"),
            F.length("opened").cast("long").alias("loss_start"),
            F.when(role == "assistant", F.length("body")).otherwise(0).cast("long").alias("loss_length"),
        )
    )


def whole_conversations(pieces: DataFrame) -> DataFrame:
    """A row per path with its whole text and mask spans, for paths that fit into one row."""
    at = Window.partitionBy("path_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece")).over(at), F.lit(0)) + F.col("loss_start")
    span = F.when(
        F.col("loss_length") > 0, F.struct(start.alias("start"), (start + F.col("loss_length")).alias("end"))
    )
    turns = F.array_sort(F.collect_list(F.struct("position", "piece", "span")))
    return (
        pieces.withColumn("span", span)
        .groupBy("path_id", "tree_id")
        .agg(turns.alias("turns"))
        .select(
            "path_id",
            "tree_id",
            F.array_join("turns.piece", "").alias("text"),
            F.filter("turns.span", lambda s: s.isNotNull()).alias("loss_spans"),
        )
    )


def from_turns(conversations: DataFrame) -> DataFrame:
    """Linear conversations (`conv_id`, `turn`, `role`, `text`) as trees: each row answers the one before.

    Rows are numbered globally in the order of conversation, turn, role and text, piece by piece, so no
    task orders a whole conversation unless it is one piece's size.
    """
    rows = conversations.select(
        F.col("conv_id").alias("tree_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    keys = ["tree_id", "turn", "role", "text"]
    numbered = stored(running_totals(rows, keys, {"node_id": F.lit(1).cast("long")}))
    before = numbered.select(
        (F.col("node_id") + 1).alias("node_id"), F.col("node_id").alias("parent_id"), F.col("tree_id").alias("of")
    )
    return (
        numbered.join(before, "node_id", "left")
        .withColumn("parent_id", F.when(F.col("tree_id").eqNullSafe(F.col("of")), F.col("parent_id")))
        .select("tree_id", "node_id", "parent_id", "role", "text", F.length("text").cast("double").alias("score"))
    )


def read_back(pieces: DataFrame) -> DataFrame:
    """Digests of what the formatted pieces say, path by path, holding one turn at a time."""

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path = tree = None
        n = turns = loss = chars = loss_chars = 0

        def row():
            return (tree, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for frame in frames:
            done = []
            for p, t, piece, start, length in zip(
                frame.path_id, frame.tree_id, frame.piece, frame.loss_start, frame.loss_length, strict=True
            ):
                if p != path:
                    if path is not None:
                        done.append(row())
                    path, tree = p, None if pd.isna(t) else int(t)
                    n, chars, loss_chars = 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                role, text = read_turn(piece)
                turns.update(f"{role}\n{text}\n".encode())
                masked = unescape(piece[start : start + length])
                loss.update(masked.encode())
                n, chars, loss_chars = n + 1, chars + len(piece), loss_chars + len(masked)
            yield pd.DataFrame(done, columns=names).astype({"conv_id": "Int64"})
        if path is not None:
            yield pd.DataFrame([row()], columns=names).astype({"conv_id": "Int64"})

    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long"
    )
    columns = ["path_id", "tree_id", "position", "piece", "loss_start", "loss_length"]
    ordered = pieces.select(*columns).repartition("path_id").sortWithinPartitions("path_id", "position")
    return ordered.mapInPandas(digests, schema)
