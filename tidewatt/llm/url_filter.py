"""URL verdicts: host and path rules first, then gradient-boosted trees on lexical features.

The trees are trained on at most TRAIN_ROWS labelled URLs, chosen by a hash of page_id; suffix statistics come from all
labelled URLs. Everything runs as DataFrame expressions and pyspark.ml.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.shared import prepare, small, stored

# (host, path, verdict); a host stands for its subdomains as well. At most a few hundred: they become one expression.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
# Host words that label a URL as unwanted for training.
UNWANTED = ["bets", "casino", "pills", "poker", "viagra", "xxx"]
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 10, 4, 7
# Weight of the overall rate in the rate of a suffix.
PRIOR = 20
FEATURES = ["url_chars", "host_chars", "labels", "depth", "digit_ratio", "entropy", "parameters", "hyphens", "suffix_rate"]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty where there is no '://'."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _UPPER.lower())
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule(rules: list[tuple[str, str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls; equal lengths: the first in order of its text."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _entropy(text: Column) -> Column:
    """Bits per character of a short text."""
    letters = F.split(text, "")
    size = F.greatest(F.length(text), F.lit(1)).cast("double")
    shares = F.transform(F.array_distinct(letters), lambda c: F.size(F.filter(letters, lambda x: x == c)) / size)
    return F.aggregate(shares, F.lit(0.0), lambda a, p: a - p * F.log2(p))


def lexical(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path, suffix and the features but suffix_rate."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    url = F.coalesce("url", F.lit(""))
    chars = F.length(url)
    query = F.regexp_extract(url, "[?]([^#]*)", 1)
    return rows.withColumns({
        "suffix": F.substring_index("host", ".", -1),
        "url_chars": chars.cast("double"),
        "host_chars": F.length("host").cast("double"),
        "labels": (F.length("host") - F.length(F.translate("host", ".", ""))).cast("double"),
        "depth": (F.length("path") - F.length(F.translate("path", "/", ""))).cast("double"),
        "digit_ratio": (chars - F.length(F.translate(url, "0123456789", ""))) / F.greatest(chars, F.lit(1)),
        "entropy": _entropy(F.col("host")),
        "parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "hyphens": (F.length("host") - F.length(F.translate("host", "-", ""))).cast("double"),
    })


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, unwanted): URLs whose number is a labelled document's, or whose host has an unwanted word.

    Unwanted: low quality or toxic by the labels, or such a word.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", F.regexp_extract(path, "/([0-9]{1,18})(?:[/.]|$)", 1).try_cast("long").alias("doc_id"),
                        F.arrays_overlap(F.split(host, "[.-]"), F.array(*map(F.lit, UNWANTED))).alias("word"))
    bad = labels.select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    bad = bad.filter("doc_id is not null and bad is not null").groupBy("doc_id").agg(F.max("bad").alias("bad"))
    rows = rows.join(bad, "doc_id", "left").filter("bad is not null or word")
    return rows.select("page_id", (F.coalesce("bad", F.lit(False)) | F.col("word")).cast("double").alias("unwanted"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] | None = None,
          train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): the rule's verdict, else block where the trees' score is 0.5 or more.

    A null url has empty host and path and takes the trees' verdict. Where all labels agree or there is none, no tree
    is grown and the verdict is their one class (allow without any). Repeated rows are judged each.
    """
    prepare(pages.sparkSession)
    pages = pages.select("page_id", "url")
    known = stored(labelled(pages, labels), "labelled")
    rows = lexical(pages)
    n, bad = known.agg(F.count("*"), F.coalesce(F.sum("unwanted"), F.lit(0.0))).first()
    prior = bad / n if n else 0.0
    trained = rows.join(known, "page_id")
    rates = stored(trained.groupBy("suffix").agg(
        ((F.sum("unwanted") + PRIOR * prior) / (F.count("*") + PRIOR)).alias("suffix_rate")), "suffixes")

    def complete(df):
        return df.join(small(rates), "suffix", "left").fillna({"suffix_rate": prior})

    name, verdict = rule(RULES if rules is None else rules, F.col("host"), F.col("path"))
    if 0 < bad < n:
        part = max(1, -(-n // train_rows))
        sample = complete(trained.filter(F.pmod(F.xxhash64("page_id"), F.lit(part)) == 0))
        assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
        sample = stored(sample.select("unwanted", *FEATURES), "training")
        if sample.agg(F.count_distinct("unwanted")).first()[0] == 2:
            trees = GBTClassifier(labelCol="unwanted", maxIter=TREES, maxDepth=DEPTH, seed=SEED)
            model = trees.fit(assembler.transform(sample))
            scored = model.transform(assembler.transform(complete(rows)))
            scored = scored.withColumn("score", vector_to_array("probability")[1])
        else:
            scored = rows.withColumn("score", F.lit(prior))
    else:
        scored = rows.withColumn("score", F.lit(prior))
    return scored.select("page_id", "host", "path", name.alias("rule"), F.coalesce(
        verdict, F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
