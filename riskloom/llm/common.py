"""What several operators share: how documents are named inside, and bounded batches.

Inside the operators a document is (`id`, `text_hash`): rows that repeat both an id and a
text are one document and get one answer.  Input columns are taken by name and renamed at
once, so further columns of the input, whatever they are called, do not matter.
"""

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Texts that one Python call holds at a time; a long text makes a batch of its own.
BATCH_BYTES = 8_000_000


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The columns `id` (long), `text` (null: empty) and `text_hash` of a table of documents."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(
        docs[id_col].cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash")
    )


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores behind it as it takes to be no column of `df`."""
    taken, names = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    return names


def by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """`docs` with the id and the text hash that operators know a document by, and the names of these columns."""
    key = free_names(docs, "__id", "__hash")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.withColumns({key[0]: docs[id_col].cast("long"), key[1]: F.xxhash64(text)}), key


def same_document(left: DataFrame, key: list[str], right: DataFrame):
    """The join condition between `by_document` rows and an operator's (`id`, `text_hash`)."""
    return left[key[0]].eqNullSafe(right["id"]) & (left[key[1]] == right["text_hash"])


def in_slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that each holds about BATCH_BYTES of `column`, or one row."""
    for batch in batches:
        values = batch.column(column)
        start, size = 0, 0
        for i in range(batch.num_rows):
            length = len(values[i].as_buffer() or b"") if values[i].is_valid else 0
            if i > start and size + length > BATCH_BYTES:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += length
        if batch.num_rows > start:
            yield batch.slice(start)


def first(*frames: pd.DataFrame) -> pd.DataFrame:
    """The frames below each other; the first one's columns when all are empty."""
    filled = [f for f in frames if len(f)]
    return pd.concat(filled, ignore_index=True) if filled else frames[0]
