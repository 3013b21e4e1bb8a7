"""URL filter: host and path rules, and gradient-boosted trees on lexical features for the URLs no rule fits.

The URLs that a rule fits are the labelled ones: trees are trained on a bounded sample of them (``SAMPLE`` rows,
chosen by hash) to tell block from allow by length, depth, digit ratio, entropy, parameter counts and statistics
of the host's suffix. Only DataFrame functions and Spark's own trees run.

A null URL, or one without "://", has an empty host and path, fits no rule, and is judged by the trees like any
other. Where the labelled URLs are all of one kind, that is the verdict; without any it is allow. Repeated rows
give repeated rows; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from tonearm.session import staged

from .common import columns_of

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SAMPLE, SUFFIXES = 20_000, 4096
TREES, DEPTH, RATE, SEED = 20, 4, 0.2, 42
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["url_length", "host_length", "path_length", "depth", "host_depth", "digit_ratio", "hyphens", "entropy", "parameters", "fragment", "dotted_end", "suffix_count", "suffix_block"]


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule for the host or a domain above it whose path the URL's path begins with."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, start = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text)
    share = F.transform(F.array_distinct(F.split(text, "")), lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size)
    return F.when(size == 0, 0.0).otherwise(F.coalesce(-F.aggregate(F.filter(share, lambda p: p > 0), F.lit(0.0), lambda s, p: s + p * F.log2(p)), F.lit(0.0)))


def lexical(rows: DataFrame) -> DataFrame:
    """Features of (url, host, path, ...), without the suffix statistics; ``suffix`` is the host's last label."""
    url = F.coalesce("url", F.lit(""))
    many = {
        "url_length": F.length(url),
        "host_length": F.length("host"),
        "path_length": F.length("path"),
        "depth": F.size(F.split("path", "/")) - 1,
        "host_depth": F.size(F.split("host", r"\.")),
        "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(F.length(url), F.lit(1)),
        "hyphens": F.length(F.regexp_replace(url, "[^-]", "")),
        "entropy": entropy(url),
        "parameters": F.length(F.regexp_replace(url, "[^=&]", "")),
        "fragment": F.contains(url, F.lit("#")).cast("int"),
        "dotted_end": F.contains(F.element_at(F.split("path", "/"), -1), F.lit(".")).cast("int"),
    }
    return rows.select("*", F.element_at(F.split("host", r"\."), -1).alias("suffix"), *(c.cast("double").alias(n) for n, c in many.items()))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score): the rule's verdict, else the trees' (score: chance of block)."""
    rows = columns_of(pages, id_col, url_col).toDF("page_id", "url")
    host, path = parts(F.col("url"))
    rows = rows.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = lexical(rows.select("*", rule.alias("rule"), verdict.alias("ruled")))

    labelled = rows.where("ruled is not null").withColumn("label", (F.col("ruled") == "block").cast("double"))
    kinds = [(r.label, r.n) for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()]
    if len(kinds) < 2:
        fixed = "block" if kinds and kinds[0][0] == 1.0 else "allow"
        return rows.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit(fixed)).alias("verdict"), F.lit(float(fixed == "block")).alias("score"))
    overall = sum(y * n for y, n in kinds) / sum(n for _, n in kinds)
    stats = labelled.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("label").alias("blocked")).orderBy(F.desc("n"), "suffix").limit(SUFFIXES)
    stats = staged(stats.select("suffix", F.log1p("n").alias("suffix_count"), ((F.col("blocked") + overall) / (F.col("n") + 1)).alias("suffix_block")), "suffixes")
    sample = labelled.orderBy(F.xxhash64("url", "page_id"), "page_id").limit(SAMPLE)

    def completed(df: DataFrame) -> DataFrame:
        known = df.join(F.broadcast(stats), "suffix", "left")  # at most SUFFIXES rows
        known = known.fillna({"suffix_count": 0.0, "suffix_block": overall})
        return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(known)

    train = staged(completed(sample).select("label", *FEATURES), "labelled-urls")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=SEED, maxBins=64, cacheNodeIds=False)
    if train.agg(F.countDistinct("label")).first()[0] < 2:
        fixed = float(train.first().label)
        judged = completed(rows).withColumn("score", F.lit(fixed))
    else:
        model = trees.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(train).select("features", "label"))
        from pyspark.ml.functions import vector_to_array

        judged = model.transform(completed(rows)).withColumn("score", vector_to_array("probability")[1])
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
