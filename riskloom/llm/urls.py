r"""URL filters: curated rules first, association rules mined from their verdicts for the rest.

A curated rule (action, host, path) fits its host, all subdomains, and paths that start with
its path; the longest fitting rule wins.  Distinct labelled URLs become transactions of tokens plus
their label; Spark's FP-growth mines combinations, and those whose rule `tokens -> block` reaches the
confidence are kept if no smaller kept combination says the same.

Every part of a URL is a token: the host's last label, its last two and all of it, each path segment with its place,
the file ending, each query name, whether there is a fragment.  The first `SEGMENTS` segments and `NAMES` names in
alphabetical order are in `tokens`, at most 11, and all others in `further`; mining and matching take both.

FP-growth finds every subset of a frequent set of tokens, so it gets only tokens that a smallest combination of two or more
can hold, which leaves out nothing: not those that are seldom blocked, not those that block alone (what holds them says
no more), and one of those that are in the same URLs, for which the others are put in afterwards.  So the many
tokens that a family of long URLs has in common count once.  A combination also needs `LEAST_URLS` different blocked
URLs: no verdict rests on one example, and copies of a URL are one example.  Matching goes through an inverted index from
each rule's rarest token to the rule, over the distinct sets of tokens that rules know at all:
URLs are reduced to those before anything is joined, so a host with a third of
all URLs is a handful of rows.

Defined cases: a null URL, or one without `://`, has empty host and path and no tokens; it is
allowed, like every URL that no rule fits; repeated rows are judged alike; without labelled
URLs nothing is mined; empty tables give empty results; other columns are ignored.
"""

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import stored

# The curated rules of the query (action, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.8
LEAST_URLS = 10
SEGMENTS, NAMES = 3, 3
BLOCK = "label=block"


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and what follows the path."""
    url = F.coalesce(url, F.lit(""))
    known = url.contains("://")
    rest = F.when(known, F.substring_index(url, "://", 1)).otherwise("")
    after = F.when(known, url.substr(F.length(rest) + 4, F.length(url))).otherwise("")
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(after, r"^[^?#]*([\s\S]*)$", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path, tail


def curated(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as a struct of length, rule and action; null if none fits."""
    fits = [
        F.when(
            ((host == F.lit(h)) | host.endswith(F.lit("." + h))) & path.startswith(F.lit(p)),
            F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(a).alias("verdict")),
        )
        for a, h, p in rules
    ]
    return F.greatest(*fits) if len(fits) > 1 else fits[0]


def tokens(host: Column, path: Column, tail: Column) -> tuple[Column, Column]:
    """The distinct tokens of a URL, none of them empty: three of the host, SEGMENTS, an ending, NAMES, a fragment;
    and, apart from these, those of all further segments and names."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(
        F.array(F.lit(1), F.least(F.lit(2), n), n),
        lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, n - i + 1, i), ".")),
    )
    segments = F.transform(
        F.filter(F.split(path, "/"), lambda s: s != ""),
        lambda s, i: F.concat(F.lit("path"), i.cast("string"), F.lit("="), s),
    )
    ending = F.concat(F.lit("ending="), F.regexp_extract(path, r"(\.[A-Za-z0-9]+|/)$", 1))
    query = F.regexp_extract(tail, r"^\?([^#]*)", 1)
    names = F.transform(
        F.filter(F.split(query, "&"), lambda q: q != ""),
        lambda q: F.concat(F.lit("query="), F.substring_index(q, "=", 1)),
    )
    names = F.array_sort(F.array_distinct(names))
    fragment = F.when(tail.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    first = F.concat(suffixes, F.slice(segments, 1, SEGMENTS), F.array(ending), F.slice(names, 1, NAMES), fragment)
    rest = F.concat(_behind(segments, SEGMENTS), _behind(names, NAMES))
    none = F.array().cast("array<string>")
    return tuple(F.when(host != "", F.array_distinct(part)).otherwise(none) for part in (first, rest))


def _behind(values: Column, first: int) -> Column:
    return F.slice(values, F.lit(first + 1), F.greatest(F.size(values), F.lit(1)))


def judged(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """Per row: page_id, host, path, address (a hash of these and the rest), tokens, further, curated `rule` and `verdict`
    or nulls."""
    host, path, tail = parts(F.col("url"))
    first, further = tokens(F.col("host"), F.col("path"), F.col("tail"))
    return (
        pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"))
        .select("page_id", host.alias("host"), path.alias("path"), tail.alias("tail"))
        .withColumn("fit", curated(F.col("host"), F.col("path"), rules))
        .select(
            "page_id", "host", "path", F.xxhash64("host", "path", "tail").alias("address"),
            first.alias("tokens"), further.alias("further"),
            F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("verdict"),
        )
    )


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    least_urls: int = LEAST_URLS,
) -> DataFrame:
    """Blocking token combinations of rows with `address`, `tokens`, `further` and `verdict`: items, blocked,
    confidence, anchor.

    At least `min_support` of all different URLs, and `least_urls` of them, hold a combination together with the label,
    so the number of frequent tokens is at most tokens per URL / min_support.  `anchor` is the rarest item.
    """
    baskets = stored(
        labelled.groupBy("address", "verdict")
        .agg(F.first("tokens").alias("tokens"), F.first("further").alias("further"))
        .select("address", F.concat("tokens", "further").alias("items"), F.concat(F.lit("label="), "verdict").alias("label"))
    )
    urls = max(1, baskets.count())
    # Half a URL less, so that rounding does not ask for one more.
    support = max(min_support, min(1.0, (least_urls - 0.5) / urls))
    least = max(least_urls, math.ceil(support * urls))
    # Two tokens with the same counts and sums of hashes are in the same URLs.
    places = F.col("address").cast("decimal(38,0)"), F.xxhash64("address").cast("decimal(38,0)")
    single = stored(
        baskets.select("address", "label", F.explode("items").alias("item"))
        .groupBy("item")
        .agg(
            F.count("*").alias("item_freq"),
            F.count_if(F.col("label") == BLOCK).alias("blocked"),
            F.struct(F.count("*"), *map(F.sum, places)).alias("places"),
        )
        .where(F.col("blocked") >= least)
        .withColumn("confidence", F.col("blocked") / F.col("item_freq"))
    )
    alone = F.col("confidence") >= min_confidence
    families = stored(
        single.where(~alone).groupBy("places").agg(F.min("item").alias("head"), F.collect_list("item").alias("members"))
    )
    heads = F.array(*[F.lit(r["head"]) for r in families.select("head").collect()]).cast("array<string>")
    few = stored(baskets.select(F.array_append(F.array_intersect("items", heads), F.col("label")).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(few)
    sets = stored(model.freqItemsets.select(F.array_sort("items").alias("items"), "freq"))
    with_label = sets.where(F.array_contains("items", BLOCK) & (F.col("freq") >= least_urls)).select(
        F.array_remove("items", BLOCK).alias("items"), F.col("freq").alias("blocked")
    )
    found = (
        with_label.where(F.size("items") > 1)
        .join(sets, "items")
        .withColumn("confidence", F.col("blocked") / F.col("freq"))
        .where(F.col("confidence") >= min_confidence)
    )
    rules = stored(_anchored(found.select("items", "blocked", "confidence"), single))
    # A combination is superfluous if a smaller one is confident, too: found by each rule's items.
    wider = rules.select(F.col("items").alias("wide"), F.explode("items").alias("item"))
    narrower = rules.select("items", F.col("anchor").alias("item"))
    superfluous = (
        wider.join(narrower, "item")
        .where((F.size("items") < F.size("wide")) & (F.size(F.array_except("items", "wide")) == 0))
        .select(F.col("wide").alias("items"))
        .distinct()
    )
    least_rules = rules.join(superfluous, "items", "left_anti")
    # Every choice of one member per head.
    members = (
        least_rules.select("items", F.explode("items").alias("head"))
        .join(families, "head")
        .groupBy("items")
        .agg(F.collect_list("members").alias("choices"))
    )
    every = F.aggregate(
        "choices",
        F.array(F.array().cast("array<string>")),
        lambda done, more: F.flatten(F.transform(done, lambda d: F.transform(more, lambda m: F.array_append(d, m)))),
    )
    combined = (
        least_rules.join(members, "items")
        .select(F.explode(every).alias("items"), "blocked", "confidence")
        .withColumn("items", F.array_sort("items"))
    )
    return _anchored(combined, single).unionByName(
        single.where(alone).select(F.array("item").alias("items"), "blocked", "confidence", F.col("item").alias("anchor"))
    )


def _anchored(rules: DataFrame, single: DataFrame) -> DataFrame:
    """With each rule's rarest item."""
    anchors = (
        rules.select("items", F.explode("items").alias("item"))
        .join(single.select("item", "item_freq"), "item")
        .groupBy("items")
        .agg(F.min(F.struct("item_freq", "item"))["item"].alias("anchor"))
    )
    return rules.join(anchors, "items")


def matches(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """`rows` with `learned`: the most confident matching combination as text, or null.

    The driver sees the items of the rules, of which there are at most tokens per URL / min_support.
    """
    items = rules.select(F.explode("items").alias("item")).distinct().collect()
    vocabulary = F.array(*[F.lit(r["item"]) for r in items]).cast("array<string>")
    known = rows.withColumn("known", F.array_sort(F.array_intersect(F.concat("tokens", "further"), vocabulary)))
    distinct = known.where(F.size("known") > 0).select("known").distinct()
    hits = (
        distinct.select("known", F.explode("known").alias("anchor"))
        .join(rules, "anchor")
        .where(F.size(F.array_except("items", "known")) == 0)
        .groupBy("known")
        .agg(F.max(F.struct("confidence", "blocked", F.array_join("items", " ").alias("text")))["text"].alias("learned"))
    )
    return known.join(hits, "known", "left").drop("known")


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules=RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    least_urls: int = LEAST_URLS,
) -> DataFrame:
    """Per row of `pages`: page_id, host, path, rule, verdict, and `learned`, the mined combination that blocked."""
    rows = stored(judged(pages, id_col, url_col, rules))
    mined = stored(mine(rows.where("verdict IS NOT NULL"), min_support, min_confidence, least_urls))
    return matches(rows, mined).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(F.col("learned").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("verdict").isNull(), F.col("learned")).alias("learned"),
    )
