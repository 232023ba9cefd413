"""Small helpers for arrays: compacting them and turning one row into several."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def inline_rows(names: tuple[str, ...], *rows: tuple) -> Column:
    """A generator that emits each of `rows` under the given column names."""
    return F.inline(
        F.array(
            *[F.struct(*[c.alias(n) for n, c in zip(names, row, strict=True)]) for row in rows]
        )
    )


def without_nulls(*texts: Column) -> Column:
    """The texts that are present, in order; they must differ from each other.

    array_except compiles, a filter with a lambda would leave generated code.
    """
    return F.array_except(F.array(*texts), F.array(F.lit(None).cast("string")))
