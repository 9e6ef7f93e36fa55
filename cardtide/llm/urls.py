"""Allow or block URLs: longest fitting rule, else boosted trees on lexical features."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from cardtide.llm.common import ascii_lower, small, stored

ALLOW, BLOCK = "allow", "block"
FEATURES = (
    "n_chars", "n_host", "n_path", "depth", "host_depth", "digit_ratio", "entropy",
    "n_params", "n_query", "n_hyphens", "secure", "suffix_rate", "suffix_seen",
    "domain_rate", "domain_seen",
)
PRIOR_WEIGHT = 20.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Mapping[str, str]) -> Column:
    """The longest rule that fits, as ``(rule, verdict)``, or null.

    A rule ``host/path`` fits its host and all its subdomains where the path starts with
    its path. Rules of equal length go by code point.
    """
    def fitting(rule: str, verdict: str) -> Column:
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(
            path, F.lit(slash + rest)
        )
        return F.when(
            fits,
            F.struct(
                F.lit(len(rule)).alias("length"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")
            ),
        )

    found = [fitting(rule, verdict) for rule, verdict in sorted(rules.items())]
    return F.array_max(F.array(*found)) if found else F.lit(None).cast(
        "struct<length:int,rule:string,verdict:string>"
    )


def _features(df: DataFrame, url: str) -> DataFrame:
    """Lexical features of a URL, beside the columns of ``df``; null counts as empty."""
    text = F.coalesce(F.col(url), F.lit(""))
    df = df.withColumns({"_text": text, "_host": host_of(text), "_path": path_of(text)})
    text, host, path = F.col("_text"), F.col("_host"), F.col("_path")
    labels = F.split(host, r"\.")
    query = F.regexp_extract(text, r"(?s)\?([^#]*)", 1)
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    entropy = F.aggregate(
        F.array_distinct(F.split(text, "")),
        F.lit(0.0),
        lambda acc, c: acc - F.when(c != "", share(c) * F.log2(share(c))).otherwise(0.0),
    )
    return df.withColumns(
        {
            "n_chars": n,
            "n_host": F.length(host),
            "n_path": F.length(path),
            "depth": F.regexp_count(path, F.lit("/[^/]")),
            "host_depth": F.size(labels),
            "digit_ratio": F.regexp_count(text, F.lit("[0-9]")) / F.greatest(n, F.lit(1)),
            "entropy": F.when(n > 0, entropy).otherwise(0.0),
            "n_params": F.regexp_count(query, F.lit("[^&]+")),
            "n_query": F.length(query),
            "n_hyphens": F.regexp_count(host, F.lit("[-_]")),
            "secure": F.startswith(text, F.lit("https://")).cast("int"),
            "_suffix": F.element_at(labels, -1),
            "_domain": F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(3)), 3), "."),
        }
    )


@dataclass
class UrlFilter:
    """Boosted trees, and counts by suffix and by domain of all labelled URLs."""

    trees: GBTClassificationModel | None
    suffixes: DataFrame | None
    domains: DataFrame | None
    prior: float

    def score(self, df: DataFrame, url: str = "url") -> DataFrame:
        """Add ``p_block``; 0 for every row if there was nothing to learn from."""
        columns = [F.col(f"`{c}`") for c in df.columns if c != "p_block"]
        if self.trees is None:
            return df.select(*columns, F.lit(0.0).alias("p_block"))
        own = df.select(F.struct(*columns).alias("_row"), F.col(url).alias("_url"))
        rows = _with_rates(_features(own, "_url"), self.suffixes, self.domains, self.prior)
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="_vector").transform(rows)
        judged = self.trees.transform(vectors.select("_row", "_vector"))
        p_block = vector_to_array("probability")[1]
        return judged.select("_row.*", p_block.alias("p_block"))


def _with_rates(
    df: DataFrame, suffixes: DataFrame, domains: DataFrame, prior: float, own: Column | None = None
) -> DataFrame:
    """Smoothed share blocked and log count of each row's suffix and domain.

    ``own`` is the label of a row that is among those counted; it is taken off again.
    """
    for name, table in (("suffix", suffixes), ("domain", domains)):
        seen, bad = F.coalesce("_n", F.lit(0)), F.coalesce("_bad", F.lit(0.0))
        if own is not None:
            seen, bad = seen - 1, bad - own
        df = (
            df.join(table.withColumnRenamed("_key", f"_{name}"), f"_{name}", "left")
            .withColumns(
                {
                    f"{name}_rate": (bad + prior * PRIOR_WEIGHT) / (seen + PRIOR_WEIGHT),
                    f"{name}_seen": F.log1p(seen),
                }
            )
            .drop("_n", "_bad")
        )
    return df


def train_url_filter(
    labelled: DataFrame, max_rows: int = 4000, trees: int = 20, depth: int = 4, seed: int = 3
) -> UrlFilter:
    """Learn from ``labelled(url, block)``, ``block`` 0 or 1.

    The trees are fitted to at most ``max_rows`` distinct URLs, taken by a hash. Suffixes and
    domains are counted over all distinct URLs, and these counts are broadcast only if they
    are counted to be small; a row that the trees learn from does not see its own label in them.
    Rows with a null are left out. Without rows of both kinds nothing is blocked.
    """
    rows = labelled.select("url", F.col("block").cast("double").alias("block")).na.drop()
    rows = stored(rows.groupBy("url").agg(F.max("block").alias("block")), "labelled")
    n_all, bad_all = rows.agg(F.count(F.lit(1)), F.sum("block")).first()
    some = rows.orderBy(F.xxhash64(F.lit(seed), "url"), "url").limit(max_rows)
    featured = _features(some, "url").select("block", "_suffix", "_domain", *FEATURES[:11]).cache()
    n, bad = featured.agg(F.count(F.lit(1)), F.sum("block")).first()
    if not n or bad in (0.0, float(n)):
        featured.unpersist()
        return UrlFilter(None, None, None, 0.0)
    prior, labels = bad_all / n_all, _features(rows, "url")

    def rates(column: str) -> DataFrame:
        counted = labels.groupBy(F.col(column).alias("_key")).agg(
            F.count(F.lit(1)).alias("_n"), F.sum("block").alias("_bad")
        )
        return small(stored(counted, "rates"))

    suffixes, domains = rates("_suffix"), rates("_domain")
    rated = _with_rates(featured, suffixes, domains, prior, own=F.col("block"))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="_vector").transform(rated)
    model = GBTClassifier(
        featuresCol="_vector", labelCol="block", maxIter=trees, maxDepth=depth, stepSize=0.2,
        subsamplingRate=0.8, seed=seed,
    ).fit(vectors.select("_vector", "block"))
    featured.unpersist()
    return UrlFilter(model, suffixes, domains, prior)


def judge_urls(
    pages: DataFrame, model: UrlFilter, rules: Mapping[str, str], threshold: float = 0.5
) -> DataFrame:
    """``page_id, host, path, rule, verdict, p_block`` of every row of ``pages(page_id, url)``.

    The longest fitting rule decides; else the URL is blocked at ``threshold``. A null URL or one
    without ``://`` has an empty host and path, fits no rule and is judged by the model
    like an empty text. Repeated rows repeat; a null page_id stays. No rows, no result.
    Other columns are not read.
    """
    scored = model.score(pages.select("page_id", "url"))
    rows = scored.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rows = rows.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    by_model = F.when(F.col("p_block") >= threshold, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return rows.select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", by_model).alias("verdict"),
        "p_block",
    )
