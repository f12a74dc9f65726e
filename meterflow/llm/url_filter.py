"""Allow or block URLs: by rules where one fits, else by gradient-boosted trees on lexical features.

A rule is a host and the beginning of a path. It fits its host and all subdomains;
the longest that fits wins, of equally long ones that with the longer host, then
a blocking one. The trees are trained on the URLs that rules have labelled, and judge
the others by length, depth, digits, entropy, parameters and the statistics of the
host's last two labels among the labelled URLs. Everything is DataFrame expressions
and Spark's own trees.

A null URL, and one without "://", has an empty host and path, which no rule fits.
If rules label no URL, the others are allowed; if they label all alike, the others get
that verdict. Repeated URLs are judged alike, and train once. Other columns pass through.
"""

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.storage import materialise

#: Rules of the `pages` table: host and path, and the verdict.
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block"))
#: Labelled URLs that train the trees, at most; the choice is by a hash of the URL.
SAMPLE = 20_000
TREES, DEPTH, SEED = 20, 4, 11
#: Labelled URLs of a suffix that weigh as much as the share of all.
PRIOR = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substring(rest, F.length(raw) + 1, F.length(rest))
    return F.translate(raw, _UPPER, _LOWER), F.regexp_extract(after, r"^[^?#]*", 0)


def with_rule(urls: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """`urls` (with host and path) and the rule that wins, and its verdict; both null if none fits."""
    def rank(rule):
        text, verdict = rule
        return -len(text), -text.index("/"), verdict != "block"

    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=rank, reverse=True):
        host, path = text[:text.index("/")], text[text.index("/"):]
        fits = ((F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))) & F.startswith(
            F.col("path"), F.lit(path))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return urls.withColumns({"rule": rule, "__said": verdict})


def _times(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _entropy(text: Column) -> Column:
    """Bits a character, from the characters' shares in the text."""
    n = F.length(text).cast("double")
    times = F.transform(F.array_distinct(F.split(text, "")), lambda c: F.when(
        F.length(c) > 0, n - F.length(F.replace(text, c, F.lit("")))).otherwise(0.0))
    sums = F.aggregate(times, F.lit(0.0), lambda total, x: total + F.when(x > 0, x * F.log2(x)).otherwise(0.0))
    return F.when(n > 0, F.log2(n) - sums / n).otherwise(0.0)


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The features that need nothing but the URL."""
    url = F.coalesce(url, F.lit(""))
    n = F.length(url).cast("double")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return {
        "__length": n, "__host_length": F.length(host).cast("double"), "__path_length": F.length(path).cast("double"),
        "__depth": _times(path, "/"), "__labels": _times(host, r"\."), "__hyphens": _times(host, "-"),
        "__digits": F.when(n > 0, _times(url, "[0-9]") / n).otherwise(0.0), "__entropy": _entropy(url),
        "__parameters": F.when(F.length(query) > 0, _times(query, "&") + 1).otherwise(0.0),
        "__fragment": F.contains(url, F.lit("#")).cast("double"),
        "__secure": F.startswith(url, F.lit("https:")).cast("double"),
    }


def _with_suffix(urls: DataFrame, statistics: DataFrame, share: float) -> DataFrame:
    found = urls.join(statistics, "__suffix", "left")
    n, blocked = F.coalesce("__n", F.lit(0)), F.coalesce("__blocked", F.lit(0))
    return found.withColumns({"__suffix_share": (blocked + PRIOR * share) / (n + PRIOR),
                              "__suffix_size": F.log1p(n.cast("double"))}).drop("__n", "__blocked")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, sample: int = SAMPLE) -> DataFrame:
    """`pages` with host, path, rule and verdict; columns of these names are replaced."""
    own = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col("url"))
    # the page's own columns stay together, apart from those made here
    urls = with_rule(pages.select(F.struct(*own).alias("page"), "url", host.alias("host"), path.alias("path")), rules)
    suffix = F.substring_index("host", ".", -2)
    urls = urls.withColumn("__suffix", suffix)
    labelled = (urls.where("__said IS NOT NULL").select("url", "host", "path", "__suffix", "__said").distinct()
                .withColumn("__label", (F.col("__said") == "block").cast("double")))
    # counts over all labelled URLs
    statistics = materialise(labelled.groupBy("__suffix").agg(
        F.count("*").alias("__n"), F.sum("__label").alias("__blocked")), "url-suffixes")
    n, blocked = statistics.agg(F.coalesce(F.sum("__n"), F.lit(0)), F.coalesce(F.sum("__blocked"), F.lit(0.0))).first()
    if blocked in (0, n):
        guess = F.lit("block" if n and blocked == n else "allow")
        return urls.select("page.*", "host", "path", "rule", F.coalesce("__said", guess).alias("verdict"))
    features = lexical(F.col("url"), F.col("host"), F.col("path"))
    names = [*features, "__suffix_share", "__suffix_size"]
    gather = VectorAssembler(inputCols=names, outputCol="__features")
    rows = labelled.orderBy(F.xxhash64("url"), "url").limit(sample).withColumns(features)
    rows = materialise(_with_suffix(rows, statistics, blocked / n).select("__label", *names), "url-training")
    # one order of the rows, so that every run grows the same trees
    rows = gather.transform(rows.coalesce(1).sortWithinPartitions(*names)).select("__label", "__features").cache()
    trees = GBTClassifier(featuresCol="__features", labelCol="__label", predictionCol="__blocks", maxIter=TREES,
                          maxDepth=DEPTH, seed=SEED).fit(rows)
    rows.unpersist()
    judged = trees.transform(gather.transform(_with_suffix(urls.withColumns(features), statistics, blocked / n)))
    guess = F.when(F.col("__blocks") > 0.5, "block").otherwise("allow")
    return judged.select("page.*", "host", "path", "rule", F.coalesce("__said", guess).alias("verdict"))
