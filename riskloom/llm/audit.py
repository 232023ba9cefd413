"""Filter interaction audit: what each filter removes, in every order of applying them.

Every filter is run once over all documents, and the ids it rejects are written as a table of their own.  All
that the audit says follows from these relations by joins on the document alone.  A prefix of filters is a set, so the
120 orders of five filters share 80 pairs of (filters before, filter), and the pair is a column: a left-anti join
of a filter's ids, once per set before, with the ids of the filters in that set leaves what the filter removes there
(survivors are the documents less what was removed), a left-semi join what is redundant.  Shapley
sums are weighted sums of the removals.

The relations hold (id, 64-bit hash of the text), never texts; all joins are on that key, which few rows share, so
none is skewed, and the sets before are added behind the exchange.  Only failing documents enter them: the others are
counted once, in the totals.  Equal texts are found by a 256-bit digest with one pre-aggregated smallest id
each; the rows of a digest are spread over `SALTS`, to which its one row is copied.

Defined cases: null text is empty (it fails A, and equals other empty texts); a null id is larger and smaller than
none, so it neither fails E nor makes others fail it, and has no label; null lang is the part ''; a document without label loses
nothing; with several labels it counts as good or toxic if one of them says so; rows that repeat id and text are
judged alike and count each; empty tables give no parts and no rows; other columns are ignored.
"""

import uuid
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import checkpoint_dir, stored

FILTERS = "ABCDE"
SALTS = 16
WORD_BREAKS = r"[\x20\x09-\x0D]+"
KEY = ["id", "hash"]


def conditions(text: Column) -> dict[str, Column]:
    """The filters that see one text: true where it fails."""
    words = F.filter(F.split(text, WORD_BREAKS), lambda w: w != "")
    n, distinct = F.size("words"), F.size(F.array_distinct("words"))
    return {
        "words": words,
        "A": n < 100,
        "B": 100 * distinct < 80 * n,
        "C": 100 * (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """One stored row per document: its key, part, digest, and what A to D say."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    given = docs.select(
        docs[id_col].cast("long").alias("doc_id"), text.alias("text"),
        F.coalesce(docs[lang_col].cast("string"), F.lit("")).alias("part"),
    )
    found = conditions(F.col("text"))
    judged = given.withColumn("words", found.pop("words")).select(
        # Null ids are one id of their own: 0, with another hash.
        F.coalesce("doc_id", F.lit(0)).alias("id"),
        F.xxhash64("text", F.col("doc_id").isNull()).alias("hash"),
        F.col("doc_id").isNull().alias("unnamed"),
        "part",
        F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("digest"),
        *(condition.alias(name) for name, condition in found.items()),
    )
    return stored(judged)


def repeats(rows: DataFrame) -> DataFrame:
    """The keys of documents whose text a smaller id has, too."""
    named = rows.where("NOT unnamed")
    first = named.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    copies = first.select("digest", "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = named.select(*KEY, "digest", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    same = (salted["digest"] == copies["digest"]) & (salted["salt"] == copies["salt"]) & (salted["id"] > copies["least"])
    return salted.join(copies, same, "left_semi").select(KEY)


def mask(filters) -> int:
    """A set of filters as bits."""
    return sum(1 << FILTERS.index(f) for f in filters)


def id_tables(rows: DataFrame) -> DataFrame:
    """Writes one table per filter, a folder `filter=A` and so on, of the keys that fail it; reads them as one."""
    folder = f"{checkpoint_dir(rows.sparkSession)}/failing-{uuid.uuid4().hex}"
    own = rows.select(*KEY, F.explode(F.array(*(F.when(F.col(f), F.lit(f)) for f in FILTERS[:-1]))).alias("filter"))
    failing = own.where("filter IS NOT NULL").unionByName(repeats(rows).withColumn("filter", F.lit(FILTERS[-1])))
    failing.distinct().write.partitionBy("filter").parquet(folder)
    return rows.sparkSession.read.schema("id long, hash long, filter string").parquet(folder)


def pairs(documents: DataFrame, failing: DataFrame) -> DataFrame:
    """Per (part, filter, before): removed, good_lost, toxic_lost, redundant; pairs without any row are left out."""
    bit = F.lit(0)
    for f in FILTERS:
        bit = F.when(F.col("filter") == f, F.lit(mask(f))).otherwise(bit)
    own = documents.join(failing.withColumn("bit", bit), KEY)
    sets = F.filter(F.sequence(F.lit(0), F.lit(mask(FILTERS))), lambda m: m.bitwiseAND(F.col("bit")) == 0)
    asked = own.withColumn("before", F.explode(sets))
    other = failing.select(F.col("id").alias("its_id"), F.col("hash").alias("its_hash"), bit.alias("its_bit"))
    earlier = (
        (F.col("id") == F.col("its_id")) & (F.col("hash") == F.col("its_hash"))
        & (F.col("before").bitwiseAND(F.col("its_bit")) != 0)
    )
    by = ["part", "filter", "before"]
    removed = asked.join(other, earlier, "left_anti").groupBy(by).agg(
        F.sum("n").alias("removed"),
        F.sum(F.col("n") * F.col("good")).alias("good_lost"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic_lost"),
    )
    redundant = asked.join(other, earlier, "left_semi").groupBy(by).agg(F.sum("n").alias("redundant"))
    return stored(removed.join(redundant, by, "full"))


def steps_of(parts: DataFrame) -> DataFrame:
    """Every row of `parts` with every step of every order: its filter, and the filters before as bits."""
    orders = F.split(F.lit(",".join(map("".join, permutations(FILTERS)))), ",")
    ordered = parts.withColumn("filter_order", F.explode(orders))
    stepped = ordered.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    before = F.lit(0)
    for f in FILTERS:
        before = before + F.when(F.instr("filter_order", f) < F.col("step"), F.lit(mask(f))).otherwise(0)
    return stepped.withColumns({"filter": F.substring("filter_order", F.col("step"), F.lit(1)), "before": before})


def audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    quality_col: str = "quality", toxic_col: str = "toxic",
) -> DataFrame:
    """One row per part, filter_order and step with kept, removed, redundant, unique_fails, losses and shapley."""
    rows = measured(docs, id_col, text_col, lang_col)
    failing = id_tables(rows)
    said = labels.where(labels[id_col].isNotNull()).groupBy(labels[id_col].cast("long").alias("labelled")).agg(
        F.max((labels[quality_col] == 1).cast("long")).alias("good"),
        F.max((labels[toxic_col] == 1).cast("long")).alias("toxic"),
    )
    counted = rows.groupBy(*KEY, "part", "unnamed").agg(F.count("*").alias("n"))
    marked = counted.join(said, (F.col("id") == F.col("labelled")) & ~F.col("unnamed"), "left")
    documents = stored(
        marked.select(
            *KEY, "part", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
        )
    )
    found = pairs(documents, failing)
    # In so many orders do exactly these filters come before: k! of them, times those of the filters behind.
    last = len(FILTERS) - 1
    weights = F.array(*(F.lit(factorial(k) * factorial(last - k)) for k in range(last + 1)))
    size = F.bit_count("before")
    own = found.groupBy("part", "filter").agg(
        F.sum(F.when(size == last, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * F.element_at(weights, size + 1)).alias("shapley"),
    )
    # As many rows as there are parts and steps; the documents are summed up by now.
    totals = documents.groupBy("part").agg(F.sum("n").alias("documents"))
    steps = steps_of(totals)
    measures = ("removed", "redundant", "good_lost", "toxic_lost", "unique_fails", "shapley")
    full = steps.join(found, ["part", "filter", "before"], "left").join(own, ["part", "filter"], "left").select(
        "part", "filter_order", "step", "documents", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in measures)
    )
    so_far = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return full.select(
        "part", "filter_order", "step",
        (F.col("documents") - F.sum("removed").over(so_far)).alias("kept"),
        *measures,
    )
