"""The stages one by one on the smallest tables, and the registered queries against their SQL."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from conftest import SF
from riskloom.llm import decontam, minhash, packing, quality, secrets
from riskloom.llm.queries import ORACLES, QUERIES, table
from riskloom.session import stored


@pytest.fixture(scope="module")
def stages(spark):
    docs, kept = table(spark, SF, "documents"), []
    for _, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF))
        kept.append((docs, out))
        docs = out
    return kept


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


def test_all_but_the_last_return_documents(stages):
    for docs, out in stages[:-1]:
        assert out.schema == docs.schema
        assert set(ids(out)) <= set(ids(docs))


def test_rejected_documents_go(spark, stages):
    docs, out = stages[0]
    model = quality.train(docs, table(spark, SF, "labels"))
    assert ids(out) == ids(quality.score(docs, model).where("predicted = 1"))


def test_one_of_each_group_stays(stages):
    docs, out = stages[1]
    found = minhash.near_duplicates(docs)
    assert ids(out) == ids(found.where("kept").select(F.col("id").alias("doc_id")))
    again = minhash.near_duplicates(out)
    assert again.where("NOT kept").count() == 0


def test_contaminated_documents_go(spark, stages):
    docs, out = stages[2]
    items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    whole = {r["doc_id"] for r in docs.collect() if any(" ".join(i.split()) in " ".join(r["text"].split()) for i in items)}
    gone = set(ids(docs)) - set(ids(out))
    assert whole and whole <= gone
    assert decontam.contaminated(out, table(spark, SF, "benchmark")).count() == 0


def test_secrets_are_masked(stages):
    docs, out = stages[3]
    texts = {r["doc_id"]: r for r in out.collect()}
    for row in docs.collect():
        assert texts[row["doc_id"]]["text"] == secrets.redact(row["text"])
        assert texts[row["doc_id"]]["n_chars"] == len(texts[row["doc_id"]]["text"])


def test_everything_left_is_packed(stages):
    docs, out = stages[4]
    assert set(ids(out)) == set(ids(docs))
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_columns_named_as_internal_ones_come_back(spark):
    """The operators' own columns get other names where the input has them."""
    base = table(spark, SF, "documents")
    extra = {name: F.concat(F.lit(f"keep {name} "), "doc_id") for name in ("__id", "__HASH", "__n", "__row", "__shard")}
    docs = stored(base.withColumns(extra))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, SF))
        assert out.columns == docs.columns, name
        kept = out.where(F.expr(" AND ".join(f"`{c}` = concat('keep {c} ', doc_id)" for c in extra)))
        assert kept.count() == out.count() > 0, name
    pieces = docs.select("doc_id", *extra, F.lit(100).cast("long").alias("length"), F.lit("x").alias("offset"))
    packed = packing.pack(pieces)
    assert set(packed.columns) == {"doc_id", *extra, "length", "offset", "sequence_id"}
    assert packed.where("__row = concat('keep __row ', doc_id)").count() == docs.count()
    assert dict(packed.dtypes)["offset"] == "bigint"


def test_repeated_rows_leave_one(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text), (1, text), (2, text), (3, ""), (3, ""), (None, "alone with no id at all here"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "3", "4", "None"]


def test_missing_and_repeated_ids_leave_one_of_a_group(spark):
    groups = [" ".join(f"{name}{k}" for k in range(40)) for name in "abc"]
    rows = [(None, groups[0]), (None, groups[0] + " more"), (None, groups[0])]
    rows += [(7, groups[1]), (7, groups[1] + " more"), (9, groups[1] + " else")]
    rows += [(None, groups[2]), (8, groups[2] + " more"), (None, ""), (None, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()]
    assert set(kept) <= set(rows)
    of = {name: [r for r in kept if r[1].startswith(name)] for name in "abc"}
    assert [len(of[name]) for name in "abc"] == [1, 1, 1]
    assert of["b"][0][0] == 7 and of["c"] == [(8, groups[2] + " more")]
    assert sorted(t for _, t in kept if not t.strip()) == ["", " "]


def test_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name_of in ("conversations", "documents", "embeddings", "labels"):
        connection.execute(f"CREATE VIEW {name_of} AS SELECT * FROM '{SF}/{name_of}.parquet'")
    result = connection.execute(ORACLES[name])
    names = [c[0] for c in result.description]
    frame = QUERIES[name](spark, SF)
    assert sorted(frame.columns) == sorted(names)
    assert sorted(tuple(r) for r in frame.select(names).collect()) == sorted(result.fetchall())
