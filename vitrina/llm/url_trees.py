"""URL filter: host and path rules first, gradient-boosted trees on lexical features for the rest.

Features of a URL: its length, the length of host and path, path depth, labels in the host, share
of digits, entropy of the host's characters, number of parameters, a fragment mark, and two suffix statistics: how often labelled URLs with the same last label, and with the same
last two labels, are blocked (smoothed; counted in Spark over all labelled URLs, joined to the URLs and
broadcast only below ``STATS_MAX_BYTES``).  They are Spark columns; the trees are Spark ML's, trained on
labelled URLs (at most ``max_labelled``, by the hash of the URL).

Without a labelled set of its own the caller can mark seeds: a host counts as blocked if a label of it
begins or ends with one of ``SEED_WORDS`` (joined to other words by a hyphen or by nothing), every
other host as allowed, hyphens or not.  No feature is a function of that label: words and hyphens
are none, so the trees judge unseen hosts by form.

Defined results: a NULL URL, or one without "://", has empty host and path, fits no rule and is
allowed.  Without labelled URLs of both classes every URL gets the one class there is (allow if none).
Repeated rows give repeated rows.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from vitrina.operators.broadcast import checked_broadcast
from vitrina.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words of hosts that advertise or deceive, as a labelled seed.
SEED_WORDS = ("casino", "adult", "pills", "bets", "spam", "ads", "track", "win", "cheap", "viagra", "poker", "porn", "loan",
              "lottery", "jackpot", "slots")
FEATURES = ("f_length", "f_host", "f_path", "f_depth", "f_labels", "f_digits", "f_entropy", "f_params",
            "f_fragment", "f_suffix1", "f_suffix2")
SUFFIXES = ("suffix1", "suffix2")
BLOCK_AT = 0.8  # probability of class block from which a URL is blocked
STATS_MAX_BYTES = 8 << 20  # estimated bytes of one suffix table


def host_of(url: Column) -> Column:
    """Between the first :// and the next / ? # or the end, A-Z in lower case; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_verdict(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """(longest rule that fits, its verdict); a rule is "host/path", it fits the host and all
    subdomains if the URL's path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text in sorted(rules, key=lambda r: (len(r), r)):  # the longest is asked first
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(rules[text])).otherwise(verdict)
    return rule, verdict


def _lexical(df: DataFrame, url_col: str) -> DataFrame:
    """Adds host, path and the features that need no labels (all doubles)."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    df = df.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    n = F.greatest(F.length("host"), F.lit(1))
    chars = F.split("host", "")
    entropy = F.aggregate(
        F.transform(F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n),
        F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0)))
    values = {
        "f_length": F.length(url), "f_host": F.length("host"), "f_path": F.length("path"),
        "f_depth": F.size(F.filter(F.split("path", "/"), lambda p: p != "")),
        "f_labels": F.size(F.split("host", r"\.")),
        "f_digits": F.length(F.regexp_replace(url, r"[^0-9]", "")) / F.greatest(F.length(url), F.lit(1)),
        "f_entropy": entropy,
        "f_params": F.size(F.filter(F.split(query, "&"), lambda p: p != "")),
        "f_fragment": F.instr(url, "#") > 0,
    }
    for name, value in values.items():
        df = df.withColumn(name, value.cast("double"))
    return _suffixes(df)


def _suffixes(df: DataFrame) -> DataFrame:
    """Adds the last label and the last two labels of column host."""
    labels = F.split("host", r"\.")
    return (df.withColumn("suffix1", F.element_at(labels, -1))
            .withColumn("suffix2", F.concat_ws(".", F.slice(labels, -F.least(F.size(labels), F.lit(2)),
                                                            F.least(F.size(labels), F.lit(2))))))


def seed_labels(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """url, label (1: block) of the URLs whose host a seed rule decides."""
    host = host_of(F.col(url_col).cast("string"))
    words = "|".join(SEED_WORDS)
    label = F.when(host != "", host.rlike(f"(?:^|[.-])(?:{words})|(?:{words})(?:$|[.-])").cast("int"))
    return urls.select(F.col(url_col).cast("string").alias("url"), label.alias("label")).filter("label IS NOT NULL")


class UrlTrees:
    """Gradient-boosted trees over the lexical features, with the suffix statistics they use."""

    def __init__(self, labelled: DataFrame, max_labelled: int = 4000, trees: int = 12, depth: int = 3):
        """``labelled``: url, label (1 block, 0 allow).  Both classes give at most half the sample."""
        from pyspark.ml.classification import GBTClassifier
        from pyspark.ml.feature import VectorAssembler

        rows = labelled.filter("url IS NOT NULL AND label IN (0, 1)").dropDuplicates(["url", "label"])
        half = max_labelled // 2
        order = [F.xxhash64("url"), F.col("url")]
        sample = (rows.filter("label = 1").orderBy(*order).limit(half)
                  .union(rows.filter("label = 0").orderBy(*order).limit(half))).collect()  # bounded by max_labelled
        self.constant = None
        classes = {r["label"] for r in sample}
        self.stats: dict[str, DataFrame] = {}
        if len(classes) < 2:
            self.constant = "block" if classes == {1} else "allow"
            return
        spark = labelled.sparkSession
        frame = _lexical(spark.createDataFrame([(r["url"], float(r["label"])) for r in sample], "url string, label double"), "url")
        counted = _suffixes(rows.withColumn("host", host_of(F.col("url").cast("string"))))
        for name in SUFFIXES:
            share = (F.sum("label") + 1.0) / (F.count(F.lit(1)) + 2.0)
            self.stats[name] = materialize(counted.groupBy(F.col(name).alias("__suffix")).agg(share.alias("__share")), "url-suffixes")
        self.assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        data = self.assembler.transform(self._with_stats(frame)).select("features", "label").coalesce(1)
        # Each split sees half the features, so that none decides alone.
        self.model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=7, stepSize=0.3, featureSubsetStrategy="0.5").fit(data)

    def _with_stats(self, df: DataFrame) -> DataFrame:
        for k, name in enumerate(SUFFIXES, 1):
            table, _ = checked_broadcast(self.stats[name], STATS_MAX_BYTES)
            df = (df.join(table, F.col(name) == F.col("__suffix"), "left")
                  .withColumn(f"f_suffix{k}", F.coalesce("__share", F.lit(0.5))).drop("__suffix", "__share"))
        return df

    def judge(self, df: DataFrame, url_col: str, keep: tuple[str, ...]) -> DataFrame:
        """``keep`` columns, host, path and the trees' own verdict (column tree_verdict)."""
        keep = tuple(c for c in keep if c not in ("host", "path", "tree_verdict"))
        rows = df.select(*(F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)), F.col(url_col).alias("__url"))
        rows = _lexical(rows, "__url")
        back = [F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)]
        if self.constant is not None:
            verdict = F.when(F.col("host") == "", "allow").otherwise(self.constant)
        else:
            rows = self.model.transform(self.assembler.transform(self._with_stats(rows)))
            sure = vector_to_array("probability")[1] >= BLOCK_AT
            verdict = F.when(sure & (F.col("host") != ""), "block").otherwise("allow")
        return rows.select(*back, "host", "path", verdict.alias("tree_verdict"))


def filter_urls(df: DataFrame, trees: UrlTrees, rules: dict[str, str], keep: tuple[str, ...] = ("page_id",),
                url_col: str = "url") -> DataFrame:
    """``keep`` columns, host, path, rule and verdict (allow or block: the rule's, else the trees')."""
    judged = trees.judge(df, url_col, keep)
    rule, verdict = rule_verdict(F.col("host"), F.col("path"), rules)
    return (judged.withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, F.col("tree_verdict")))
            .drop("tree_verdict"))
