"""URL filters: rules first, gradient-boosted trees for the rest.

A rule fits a host and all its subdomains where the path of the url starts
with the rule's path; the longest fitting rule wins. Urls no rule fits are
judged by gradient-boosted trees on lexical features: lengths, depth, digit
ratio, entropy, parameter counts and statistics of the host's suffix. The
trees learn from labelled urls; where none are given, the urls that the rules
judge serve as labelled ones.

The suffix statistics count every labelled row; their tables are broadcast up
to a counted number of rows and joined beyond it. Only the fit takes a bounded
sample: ``SAMPLE`` different labelled urls by hash order, half of the places for
each label where there are enough, weighted by the rows that they stand for.
Features and predictions are built-in functions and Spark ML over every url.

Defined cases: a null url, or one without ://, has an empty host and path and
is judged by the trees like any other; equal rule lengths go by the rule's text;
repeated rows are judged one by one; with labels of one kind only, or none at
all, every url without a rule gets that kind, or ``allow``; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, pick
from quarry.llm.page_text import host_of

SAMPLE = 20_000
BROADCAST_ROWS = 50_000
TREES, DEPTH = 20, 4
SMOOTH = 5.0  # urls of average label that every suffix starts with
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def path_of(url: Column) -> Column:
    """From behind the host up to ?, # or the end; '' without a ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (host and path together) that fits, else null."""
    choice = None
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        choice = F.when(fits, rule) if choice is None else choice.when(fits, rule)
    return F.lit(None).cast("string") if choice is None else choice


FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "entropy", "parameters",
            "query_length", "upper", "suffix_rate", "domain_rate", "suffix_seen")


def suffix_of(host: Column) -> Column:
    return F.element_at(F.split(host, r"\."), -1)


def domain_of(host: Column) -> Column:
    labels = F.split(host, r"\.")
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")


def lexical(rows: DataFrame) -> DataFrame:
    """Feature columns from url, host and path; suffix and domain for the statistics."""
    url = F.coalesce("url", F.lit(""))
    n = F.length("address")
    count = lambda pattern: F.length("address") - F.length(F.regexp_replace("address", pattern, ""))
    rows = rows.withColumn("address", url)
    query = F.regexp_extract("address", r"\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    share = lambda c: (F.length("address") - F.length(F.replace(F.col("address"), c, F.lit("")))) / n
    bits = F.aggregate(F.array_distinct(F.split("address", "")), F.lit(0.0),
                       lambda total, c: total + F.when(c == "", 0.0).otherwise(-share(c) * F.log2(share(c))))
    return rows.select(
        "*", n.cast("double").alias("url_length"), F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"), F.size(F.split("path", "/")).cast("double").alias("depth"),
        F.size(labels).cast("double").alias("labels"), (count("[0-9]") / F.greatest(n, F.lit(1))).alias("digit_ratio"),
        count("-").cast("double").alias("hyphens"), F.when(n > 0, bits).otherwise(0.0).alias("entropy"),
        F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))).cast("double").alias("parameters"),
        F.length(query).cast("double").alias("query_length"), count("[A-Z]").cast("double").alias("upper"),
        suffix_of(F.col("host")).alias("suffix"), domain_of(F.col("host")).alias("domain"))


class Judge:
    """Trees and suffix statistics learnt from (url, host, path, label 0/1) rows."""

    def __init__(self, labelled: DataFrame, sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH,
                 broadcast_rows: int = BROADCAST_ROWS):
        urls = cut(labelled.groupBy("url", "host", "path").agg(F.count("*").alias("own_seen"), F.sum("label").alias("own_bad")))
        rows_of = {0: F.col("own_seen") - F.col("own_bad"), 1: F.col("own_bad")}
        n, positive, *different = urls.agg(F.sum("own_seen"), F.sum("own_bad"), *[F.count_if(rows_of[k] > 0) for k in rows_of]).first()
        self.base = positive / n if n else 0.0
        self.model: GBTClassificationModel | None = None
        if not 0 < self.base < 1:
            return
        keyed = urls.select(suffix_of(F.col("host")).alias("suffix"), domain_of(F.col("host")).alias("domain"), "own_seen", "own_bad")
        self.tables = {}
        for key in ("suffix", "domain"):
            table = cut(keyed.groupBy(key).agg(F.sum("own_seen").alias("seen"), F.sum("own_bad").alias("bad")))
            self.tables[key] = F.broadcast(table) if table.count() <= broadcast_rows else table
        chosen = []
        for label, weight in rows_of.items():
            room = max(sample // 2, sample - different[1 - label])
            some = cut(urls.where(weight > 0).withColumn("label", F.lit(label)).withColumn("weight", weight.cast("double"))
                       .orderBy(F.xxhash64("url"), "url").limit(room))
            stands_for = (positive if label else n - positive) / some.agg(F.sum("weight")).first()[0]
            chosen.append(some.withColumn("weight", F.col("weight") * stands_for))
        # a training url must not find its own labels in the statistics
        ready = self._with_statistics(cut(lexical(chosen[0].unionByName(chosen[1]))), own=True)
        self.model = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, seed=7,
                                   subsamplingRate=1.0, checkpointInterval=-1) \
            .fit(cut(self._vectors(ready).select("features", "weight", F.col("label").cast("double").alias("label")).coalesce(4)))

    def _with_statistics(self, rows: DataFrame, own: bool = False) -> DataFrame:
        less, one = (F.col("own_bad"), F.col("own_seen")) if own else (F.lit(0), F.lit(0))
        for key, table in self.tables.items():
            known = table.withColumnRenamed(key, "of_key")
            rows = rows.join(known, rows[key].eqNullSafe(F.col("of_key")), "left") \
                .withColumn(f"{key}_seen", F.coalesce(F.col("seen") - one, F.lit(0)).cast("double")) \
                .withColumn(f"{key}_rate", (F.coalesce(F.col("bad") - less, F.lit(0)) + SMOOTH * self.base)
                            / (F.col(f"{key}_seen") + SMOOTH)).drop("of_key", "seen", "bad")
        return rows

    @staticmethod
    def _vectors(rows: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)

    def verdicts(self, rows: DataFrame) -> DataFrame:
        """``rows`` (url, host, path and others) with the column judged: 0 or 1."""
        if self.model is None:
            return rows.withColumn("judged", F.lit(1.0 if self.base == 1 else 0.0))
        made = self._vectors(self._with_statistics(lexical(rows)))
        return self.model.transform(made).select(*rows.columns, F.col("prediction").alias("judged"))


def judge_urls(df: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_column: str = "page_id", url_column: str = "url",
               labelled: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row. ``labelled`` has
    (url, label); 1 means block."""
    rows = pick(df, page_id=id_column, url=url_column)
    placed = lambda x: x.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rows = placed(rows).withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    verdict_of = F.create_map(*[F.lit(x) for kind, rule in rules for x in (rule, kind)]) if rules else F.lit(None)
    by_rule = verdict_of[F.col("rule")] if rules else F.lit(None).cast("string")
    if labelled is None:
        labelled = rows.where("rule is not null").withColumn("label", (by_rule == "block").cast("int"))
    else:
        labelled = placed(pick(labelled, url="url", label="label")).where("label is not null")
    judged = Judge(labelled, sample).verdicts(rows)
    return judged.select("page_id", "host", "path", "rule", F.coalesce(
        by_rule, F.when(F.col("judged") > 0.5, "block").otherwise("allow")).alias("verdict"))
