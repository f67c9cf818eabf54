"""URL filter: host rules, and gradient-boosted trees on lexical features for the URLs that no rule fits."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txguard.llm.native import ascii_lower

SAMPLE = 20_000  # labelled URLs that the trees are fitted on, at most
TREES, DEPTH = 20, 4
SUFFIXES = 20_000  # above so many host suffixes their statistics are joined by a shuffle
PRIOR = 10.0  # weight of the overall share in a suffix's share

# The rules of the contract, as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

FEATURES = (
    "url_length", "host_length", "path_length", "depth", "host_parts", "digit_ratio", "path_digit_ratio", "hyphens",
    "entropy", "host_entropy", "parameters", "fragment", "secure", "extension", "suffix_rows", "suffix_share",
)


def with_parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` plus ``host`` (A-Z lower-cased) and ``path``; both empty for null and for URLs without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    own = F.coalesce(F.col(url), F.lit(""))
    return (
        urls.withColumn("host", ascii_lower(F.regexp_extract(own, pattern, 1)))
        .withColumn("path", F.regexp_extract(own, pattern, 2))
    )


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits host (or a parent of it) and start of the path; null if none."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text = F.when(fits, rule_host + rule_path).otherwise(text)
        verdict = F.when(fits, kind).otherwise(verdict)
    return text, verdict


def entropy(text: Column) -> Column:
    """Bits per character, of the characters' shares."""
    chars = F.split(text, "")
    n = F.size(chars)
    counts = F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda d: d == c)) / n)
    bits = F.aggregate(counts, F.lit(0.0), lambda a, p: a - p * F.log2(p))
    return F.when(F.length(text) > 0, bits).otherwise(0.0)


def lexical(urls: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` (with ``host`` and ``path``) plus the features that need nothing but the URL, and ``suffix``."""
    own = F.coalesce(F.col(url), F.lit(""))

    def share_of_digits(text: Column) -> Column:
        return F.regexp_count(text, F.lit("[0-9]")) / F.greatest(F.length(text), F.lit(1))

    query = F.regexp_extract(own, r"(?s)^[^?#]*\?([^#]*)", 1)
    features = {
        "url_length": F.length(own), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": F.regexp_count(F.col("path"), F.lit("/")), "host_parts": F.size(F.split("host", r"\.")),
        "digit_ratio": share_of_digits(own), "path_digit_ratio": share_of_digits(F.col("path")),
        "hyphens": F.regexp_count(F.col("host"), F.lit("-")), "entropy": entropy(own), "host_entropy": entropy(F.col("host")),
        "parameters": F.regexp_count(query, F.lit("[^&;=]+=?[^&;]*")), "fragment": F.contains(own, F.lit("#")),
        "secure": F.startswith(own, F.lit("https")), "extension": F.regexp_like(F.col("path"), F.lit(r"\.[A-Za-z0-9]{1,5}$")),
    }
    return urls.select(
        "*", F.substring_index("host", ".", -1).alias("suffix"), *[c.cast("double").alias(n) for n, c in features.items()])


def suffix_statistics(urls: DataFrame) -> DataFrame:
    """Per host suffix, over all rows: ``suffix_rows`` (log of the rows) and ``suffix_share`` (smoothed share of blocks)."""
    blocked = (F.col("rule_verdict") == "block").cast("double")
    total = urls.agg(F.coalesce(F.avg(blocked), F.lit(0.5)).alias("share"))
    rows = urls.groupBy("suffix").agg(F.count("*").alias("n"), F.count("rule_verdict").alias("known"), F.sum(blocked).alias("bad"))
    return rows.select(
        "suffix", F.log1p("n").alias("suffix_rows"),
        ((F.coalesce("bad", F.lit(0.0)) + PRIOR * total.scalar()) / (F.col("known") + PRIOR)).alias("suffix_share"))


def judge(pages: DataFrame, page: str = "page_id", url: str = "url", rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score`` (of a block by the trees).

    URLs that a rule fits are the labelled ones; the trees are fitted on at most ``sample`` distinct ones, taken in the
    order of their hash. Where no rule fits, the trees decide. Null and empty URLs have empty parts and are judged by the
    trees as well. If the labelled URLs are all of one kind, that kind is the verdict; without any it is ``allow``.
    Repeated rows are judged alike; other columns of ``pages`` are ignored.
    """
    parts = with_parts(pages.select(F.col(page).alias("page_id"), F.col(url).alias("url")))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = lexical(parts.withColumn("rule", rule).withColumn("rule_verdict", verdict))
    statistics = suffix_statistics(ruled)
    # Bounded: read at most SUFFIXES + 1 rows to learn whether the table is small enough to broadcast.
    small = statistics.limit(SUFFIXES + 1).count() <= SUFFIXES
    known = ruled.join(F.broadcast(statistics) if small else statistics, "suffix", "left")

    labelled = known.where(F.col("rule").isNotNull()).select(
        "url", F.xxhash64("url").alias("order"), (F.col("rule_verdict") == "block").cast("double").alias("label"), *FEATURES)
    chosen = labelled.dropDuplicates(["url"]).orderBy("order", "url").limit(sample)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    training = assembler.transform(chosen).select("label", "features")
    kinds = sorted(r["label"] for r in training.select("label").distinct().collect())
    out = ["page_id", "host", "path", "rule"]
    if len(kinds) < 2:
        only = "block" if kinds == [1.0] else "allow"
        return known.select(*out, F.coalesce("rule_verdict", F.lit(only)).alias("verdict"),
                            F.lit(float(only == "block")).alias("score"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=1).fit(training)
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(assembler.transform(known)).withColumn("score", vector_to_array("probability")[1])
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(*out, F.coalesce("rule_verdict", own).alias("verdict"), "score")
