"""Mix sources to target weights, in tokens, down a tree such as domain, language, source.

The budget of a node is divided among its children by weight. A child can use its
tokens `max_epochs` times at most; what it can't use goes to its siblings, by
their weights, and only what none of them can use stays unspent at the node's own
siblings' disposal. All of that is known before anything is selected: a parent's
need is capped by what its subtree can use.

A leaf with a budget of e times its tokens plus a rest selects each document e
times, and once more those in the longest prefix, of no more than the rest, of a
random order that depends on the seed and on e. The prefix is found without sorting
a leaf: tokens are summed in buckets of the order, more of them the more documents the
largest leaf has, and only the documents of the bucket in which the prefix ends are sorted.
Tokens are counted once for that, and once more for the documents that are selected.

All numbers are whole, so results are exact. A null in the tree counts as the empty
text, as does a null id. A leaf without tokens selects nothing. A weight that is
not given is 1; a node of weight 0 gets nothing. Rows that repeat an id are documents
of their own; they are ordered by tokens and text. Empty tables give empty results.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterflow.llm.labelled import text_of
from meterflow.storage import materialise

#: Documents of a leaf that share a bucket of the random order, about, in the largest leaf,
#: and hex digits of a document's place that name its bucket, at least.
BUCKET_ROWS, BUCKET_DIGITS = 20_000, 3
#: Leaves that are broadcast at most; more are joined.
MOST_LEAVES = 100_000


def words(col: str = "text") -> Column:
    """The number of words of a text: the default measure of tokens."""
    return F.coalesce(F.regexp_count(F.col(col), F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def _divided(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """`nodes` (cap, weight and the parent's budget, `given`) with the budget of each."""
    open_ = nodes.where("weight > 0")
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), name)
    whole = Window.partitionBy(*parent)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    ranked = (open_
              .withColumn("left", F.col("given") - F.coalesce(F.sum("cap").over(
                  order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("weights", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))))
    # in the order of need for each weight, the first that can't use its share divides the rest with all behind it
    ranked = ranked.withColumn("full", wide("left") * wide("weight") >= wide("cap") * wide("weights"))
    rest = lambda c: F.max(F.when(~F.col("full"), F.col(c))).over(whole)
    ranked = ranked.withColumn("of", rest("left")).withColumn("by", rest("weights"))
    return ranked.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(
        F.expr("cast(cast(of as decimal(38,0)) * weight div by as bigint)"))).drop("left", "weights", "full", "of", "by")


def budgets(leaves: DataFrame, levels: list[str], weights: DataFrame, total: int, max_epochs: int) -> DataFrame:
    """`leaves` (one row a leaf: its path and `supply`, its tokens) with the budget of each leaf.

    `weights` has the path as text, with "/" between its parts, and the weight, a whole number.
    """
    spark = leaves.sparkSession
    out = spark.range(1).select(F.lit(total).cast("long").alias("given"))
    for depth in range(1, len(levels) + 1):
        path = levels[:depth]
        nodes = leaves.groupBy(*path).agg((F.sum("supply") * max_epochs).alias("cap"))
        nodes = (nodes.withColumn("path", F.concat_ws("/", *path)).join(weights, "path", "left").drop("path")
                 .withColumn("weight", F.coalesce("weight", F.lit(1)).cast("long")))
        nodes = nodes.join(out, path[:-1]) if depth > 1 else nodes.withColumn("given", F.lit(total).cast("long"))
        out = _divided(nodes, path[:-1], path[-1]).select(*path, F.col("budget").alias("given"))
    return leaves.join(out.withColumnRenamed("given", "budget"), levels)


def _counted(docs: DataFrame, tokens: Column | None) -> DataFrame:
    """The rows of `docs` that have tokens, with n_tokens.

    A list of one number is filtered and unfolded: a filter on the column itself would
    be pushed below it, and the tokens be counted twice.
    """
    some = F.filter(F.array(words() if tokens is None else tokens), lambda n: n > 0)
    return docs.withColumn("n_tokens", F.explode(some))


def bucket_digits(rows: int) -> int:
    """How many hex digits name a bucket, if the largest leaf has this many documents."""
    digits = BUCKET_DIGITS
    while rows > BUCKET_ROWS * 16 ** digits:
        digits += 1
    return digits


def _checked(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= MOST_LEAVES else df


def mix(docs: DataFrame, levels: dict[str, Column], weights: dict[str, int], percent: int = 100,
        max_epochs: int = 4, seed: int = 0, tokens: Column | None = None) -> DataFrame:
    """The selected documents of `docs`, with n_tokens and copies, the number of times each is used.

    `levels` names the levels of the tree, from the root on, each with the column that
    gives a document's place; `percent` is the budget, of all tokens of `docs`.
    """
    spark: SparkSession = docs.sparkSession
    path = [f"__{n}" for n in levels]
    placed = docs.drop("n_tokens", "copies").withColumns({p: text_of(c) for p, c in zip(path, levels.values())})
    placed = placed.withColumn("__id", text_of(F.col("doc_id")))
    # budgets and prefixes are found on a table without texts
    counted = materialise(_counted(placed, tokens).select(*path, "__id", "n_tokens"), "token-counts")
    leaves = materialise(counted.groupBy(*path).agg(F.sum("n_tokens").cast("long").alias("supply"),
                                                    F.count("*").alias("docs")), "leaves")
    rows, supply, largest = leaves.agg(F.count("*"), F.sum("supply"), F.max("docs")).first()
    given = spark.createDataFrame(list(weights.items()) or [("", 1)], "path string, weight long")
    plan = budgets(leaves.drop("docs"), path, given, (supply or 0) * percent // 100, max_epochs)
    plan = materialise(plan.select(*path, F.expr("budget div supply").cast("int").alias("__epochs"),
                                   F.expr("budget % supply").alias("__rest")), "leaf-plan")
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__epochs").cast("string"), F.col("__id")))
    bucket = F.substring("__order", 1, bucket_digits(largest or 0))
    dealt = lambda df: (df.join(_checked(plan, rows), path)
                        .withColumn("__order", order).withColumn("__bucket", bucket))
    sums = (dealt(counted).where("__rest > 0").groupBy(*path, "__rest", F.col("__bucket").alias("__last"))
            .agg(F.sum("n_tokens").alias("own"))
            .withColumn("__upto", F.sum("own").over(Window.partitionBy(*path).orderBy("__last"))))
    # the bucket in which the prefix ends, and what it may take of it; all of a leaf's tokens are more than its rest
    ends = materialise(sums.where("__upto > __rest").groupBy(*path)
                       .agg(F.min(F.struct("__last", (F.col("__rest") - F.col("__upto") + F.col("own")).alias("__room")))
                            .alias("e")).select(*path, "e.__last", "e.__room"), "prefix-ends")
    ended = dealt(placed).join(_checked(ends, rows), path, "left")
    inside = F.coalesce(F.col("__bucket") == F.col("__last"), F.lit(False))
    plain = ended.where(~inside).withColumn(
        "copies", F.col("__epochs") + F.coalesce((F.col("__bucket") < F.col("__last")).cast("int"), F.lit(0)))
    plain = _counted(plain.where("copies > 0"), tokens)
    upto = F.sum("n_tokens").over(Window.partitionBy(*path).orderBy("__order", "n_tokens", "text")
                                  .rowsBetween(Window.unboundedPreceding, 0))
    sorted_ = _counted(ended.where(inside), tokens).withColumn(
        "copies", F.col("__epochs") + (upto <= F.col("__room")).cast("int"))
    return (plain.unionByName(sorted_).where("copies > 0")
            .select(*[c for c in docs.columns if c.lower() not in ("n_tokens", "copies")], "n_tokens", "copies"))


#: The tree of the `documents` table: sources are grouped into domains by number.
DOMAINS = {"web": range(0, 10), "forum": range(10, 15), "reference": range(15, 20)}
#: Target weights by path; a source without one has weight 1.
WEIGHTS = {
    "web": 50, "forum": 20, "reference": 30, "other": 5,
    **{f"{domain}/{lang}": weight for domain in ("web", "forum", "reference", "other")
       for lang, weight in (("en", 60), ("de", 15), ("fr", 15), ("es", 10))},
}
SEED, PERCENT, MAX_EPOCHS = 42, 100, 4


def domain(source: Column) -> Column:
    out = F.lit("other")
    for name, numbers in DOMAINS.items():
        out = F.when(source.isin(*[f"src{i}" for i in numbers]), F.lit(name)).otherwise(out)
    return out


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix of `documents` by DOMAINS and WEIGHTS, with as many tokens as it has."""
    levels = {"domain": domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    return mix(docs, levels, WEIGHTS, PERCENT, MAX_EPOCHS, SEED)
