"""The registered queries of the training-data operators, each over its whole table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    audit, chat, codes, decontam, language, lines, minhash, packing, quality, rules, secrets, suffixes, urls,
)
from riskloom.llm.oracle import AUDIT_SQL, CHAT_SQL, CODES_SQL, LINKS_SQL, RULES_SQL, WINDOWS_SQL
from riskloom.session import stored

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    """The vocabulary file of the packing query."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@query("op1_chat_format", CHAT_SQL)
def op1(spark, sf_dir):
    """All conversations, and one whose texts are full of control strings, formatted and read back."""
    control = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame(
        [(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    messages = stored(chat.from_turns(turns))
    return chat.read_back(chat.format_conversations(messages))


@query("op2_quality_classifier")
def op2(spark, sf_dir):
    """Quality scores of all documents; learnt outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model)


@query("op3_secret_scan")
def op3(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


@query("op4_line_dedup")
def op4(spark, sf_dir):
    return lines.dedup(table(spark, sf_dir, "documents"))


@query("op5_best_fit_packing")
def op5(spark, sf_dir):
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokenizer()))


@query("op6_minhash_dedup", LINKS_SQL)
def op6(spark, sf_dir):
    """Three-word shingles, 85 of 100: 24 bands of 4 miss a linked pair once in about 5e7."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85, permutations=48)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query("op7_quality_rules", RULES_SQL)
def op7(spark, sf_dir):
    judged = rules.apply_policy(rules.ledger(table(spark, sf_dir, "documents")))
    base = F.lit(rules.mask("base-1")).cast("long")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failures").bitwiseAND(base) != 0).alias("base_failed"), "kept", "failures",
    )


@query("op8_url_filter")
def op8(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages"))


@query("op9_decontamination")
def op9(spark, sf_dir):
    """Every document with a benchmark item in it, and where."""
    found = decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "score", "first_word", "end_word")


@query("op10_suffix_dedup", WINDOWS_SQL)
def op10(spark, sf_dir):
    return suffixes.dedup(table(spark, sf_dir, "documents"))


@query("op11_language_id")
def op11(spark, sf_dir):
    """The language of every document; learnt outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.train(docs))


@query("op12_vector_codes", CODES_SQL)
def op12(spark, sf_dir):
    return codes.compress(table(spark, sf_dir, "embeddings"))


@query("op13_filter_audit", AUDIT_SQL)
def op13(spark, sf_dir):
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
