"""URL filters: written rules, and boosted trees over lexical features where no rule fits. Built-in functions only.

A rule names a host and the beginning of a path; it fits that host and its subdomains, and the longest fitting rule wins. URLs
with a rule are the labelled examples from which the trees learn. The learner sees a sample of fixed size, the verdict covers every row.

Cases: a null URL, or one without "://", has an empty host and path, fits no rule, and is judged by the trees as an empty text. If the
sample holds only one verdict, that is the verdict where no rule fits; without any labelled URL it is "allow". Repeated rows are
judged alike, rows are matched by a row's own values, never by an id. Columns of the input stay, and a name in use gets an underscore.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ontime.llm.quality import spare_name
from ontime.llm.tables import hash_sample, stored
from ontime.session import durable

#: Largest number of labelled URLs that the trees learn from.
FIT_ROWS = 20_000

RULE = T.StructType([T.StructField("host", T.StringType()), T.StructField("path", T.StringType()), T.StructField("verdict", T.StringType())])
FEATURES = ["length", "host_length", "path_length", "depth", "labels", "digit_share", "entropy", "parameters", "hyphens", "fragment", "percent", "secure", "suffix_block_share", "suffix_known"]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to "?", "#" or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffixes(host: Column) -> Column:
    """The host and the hosts it is a subdomain of."""
    parts = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def with_rules(df: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Columns host, path, rule and verdict added; the last two are null where no rule fits.

    Distinct hosts meet the rules by equality of a suffix, so neither many rules nor many rows of one host are compared in pairs.
    Rules are gathered for each host and then tested against each of its paths. What hosts with a rule make is written first: Spark then
    knows its size, and where that is small no row of the table is shuffled, however many of them share a host.
    """
    taken = {n: spare_name(df, n) for n in ("host", "path", "rule", "verdict")}
    column = F.col(f"`{url}`")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), host(column).alias("host"), path(column).alias("path"))
    hosts = rows.select("host").distinct().select("host", F.explode(suffixes(F.col("host"))).alias("suffix"))
    named = rules.select(F.col("host").alias("suffix"), F.struct(F.concat("host", "path").alias("rule"), F.col("path").alias("begin"), F.col("verdict").alias("verdict")).alias("r"))
    fitting = stored(hosts.join(named, "suffix").groupBy("host").agg(F.collect_list("r").alias("fitting")), "rules-by-host")
    longest = F.aggregate(
        F.filter("fitting", lambda r: F.startswith(F.col("path"), r["begin"])),
        F.lit(None).cast("struct<rule:string,begin:string,verdict:string>"),
        lambda best, r: F.when(best.isNull() | (F.length(r["rule"]) > F.length(best["rule"])), r).otherwise(best),
    )
    judged = rows.join(fitting, "host", "left").withColumn("best", F.when(F.col("fitting").isNotNull(), longest))
    values = {"host": F.col("host"), "path": F.col("path"), "rule": F.col("best.rule"), "verdict": F.col("best.verdict")}
    return judged.select("row.*", *[values[n].alias(taken[n]) for n in taken])


def _entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text)
    share = lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size
    marks = F.array_distinct(F.split(text, ""))
    kept = F.filter(marks, lambda c: F.length(c) > 0)
    return F.when(size == 0, 0.0).otherwise(F.aggregate(kept, F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c))))


def lexical(url: Column) -> dict[str, Column]:
    text, at, rest = F.coalesce(url, F.lit("")), host(url), path(url)
    count = lambda c, mark: F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))
    return {
        "length": F.length(text), "host_length": F.length(at), "path_length": F.length(rest), "depth": count(rest, "/"), "labels": count(at, "."),
        "digit_share": (F.length(text) - F.length(F.translate(text, "0123456789", ""))) / F.greatest(F.length(text), F.lit(1)),
        "entropy": _entropy(text), "parameters": count(text, "=") + count(text, "&"), "hyphens": count(text, "-"), "fragment": count(text, "#"), "percent": count(text, "%"),
        "secure": F.startswith(text, F.lit("https:")),
    }


def suffix(url: Column) -> Column:
    """What the host ends with: its last two labels."""
    return F.substring_index(host(url), ".", -2)


@dataclass
class Model:
    """suffixes: label counts of the sample's suffixes, at most one row per labelled example."""

    trees: GBTClassificationModel | None
    suffixes: DataFrame | None
    otherwise: str


def _featured(df: DataFrame, url: str, known: DataFrame) -> DataFrame:
    """The table with one vector column ``features``; the join is on a small table whose size Spark measures."""
    column = F.col(f"`{url}`")
    table = df.withColumn("suffix", suffix(column)).join(known, "suffix", "left")
    seen = F.coalesce(F.col("n"), F.lit(0))
    extra = {"suffix_block_share": (F.coalesce(F.col("blocked"), F.lit(0)) + 0.5) / (seen + 1), "suffix_known": F.log1p(seen)}
    numbers = {f"f_{k}": v.cast("double") for k, v in (lexical(column) | extra).items()}
    return VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features").transform(table.withColumns(numbers))


def fit(labelled: DataFrame, url: str = "url", verdict: str = "verdict", max_rows: int = FIT_ROWS, rounds: int = 10, depth: int = 4) -> Model:
    """Boosted trees from at most max_rows distinct labelled URLs, picked by hash."""
    examples = labelled.select(F.col(f"`{url}`").alias("u"), (F.col(f"`{verdict}`") == "block").cast("double").alias("label")).where("u IS NOT NULL AND label IS NOT NULL")
    sample = durable(hash_sample(examples, F.col("u"), max_rows))
    known = sample.groupBy(suffix(F.col("u")).alias("suffix")).agg(F.count("*").alias("n"), F.sum("label").alias("blocked"))
    low, high = sample.agg(F.min("label"), F.max("label")).first()
    if low is None or low == high:
        return Model(None, None, "block" if low == 1.0 else "allow")
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=1, featuresCol="features", labelCol="label").fit(_featured(sample, "u", known).select("features", "label"))
    return Model(trees, known, "allow")


def judge(df: DataFrame, model: Model, url: str = "url", verdict: str = "verdict") -> DataFrame:
    """The table with null verdicts filled by the trees."""
    if model.trees is None:
        return df.withColumn(verdict, F.coalesce(F.col(f"`{verdict}`"), F.lit(model.otherwise)))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{url}`").alias("u"))
    scored = model.trees.transform(_featured(rows, "u", model.suffixes)).withColumn("p", vector_to_array("probability")[1])
    learnt = F.when(F.col("p") > 0.5, "block").otherwise("allow")
    return scored.select("row.*", learnt.alias("learnt_")).select(*[F.coalesce(F.col(f"`{c}`"), F.col("learnt_")).alias(c) if c == verdict else F.col(f"`{c}`") for c in df.columns])
