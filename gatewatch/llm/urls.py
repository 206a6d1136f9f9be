"""URL filters: listed rules first, gradient-boosted trees for the rest.

The trees see lexical features of the URL: lengths, depth, digit ratio,
character entropy, parameter counts, and statistics of the host's suffix in
the labelled URLs. Everything runs on DataFrame functions and Spark's own
trees; no Python touches a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.tables import sized, staged
from gatewatch.llm.words import ascii_lower

# (rule, verdict); a rule is host/path-prefix.
RULES: tuple[tuple[str, str], ...] = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
# Distinct labelled URLs the trees are fitted on: a hash-ordered sample of at
# most this many. The statistics cover all labelled rows.
TRAIN_ROWS = 20_000
FOLDS = 4
FEATURES = (
    "url_length", "host_length", "path_length", "query_length", "depth", "host_depth", "digit_ratio",
    "symbol_ratio", "entropy", "n_params", "has_fragment", "secure", "suffix_seen", "suffix_block", "first_seen", "first_block",
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path). Host: after the first ``://`` up to ``/``, ``?``, ``#`` or
    the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end. Both are
    empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return ascii_lower(host), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does. A rule
    fits its host and all subdomains if the path starts with the rule's. Of
    equally long rules the first by code point wins."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` columns ``__row, url`` plus the lexical features; null is ''."""
    u = F.coalesce(F.col(url), F.lit(""))
    host, path = url_parts(F.col(url))
    d = df.withColumns({"__u": u, "host": host, "path": path})
    after = F.regexp_extract("__u", r"\?([^#]*)", 1)
    n = F.length("__u")
    # Character counts by removing one character at a time: linear in the URL
    # for each distinct character.
    p = lambda c: (n - F.length(F.replace(F.col("__u"), c, F.lit("")))) / n
    entropy = F.aggregate(F.array_distinct(F.split("__u", "")), F.lit(0.0), lambda acc, c: acc - F.when(c == "", 0.0).otherwise(p(c) * F.log2(p(c))))
    d = d.withColumns(
        {
            "url_length": n.cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "query_length": F.length(after).cast("double"),
            "depth": F.regexp_count("path", F.lit("/+[^/]")).cast("double"),
            "host_depth": F.regexp_count("host", F.lit("[.]")).cast("double"),
            "digit_ratio": F.regexp_count("__u", F.lit("[0-9]")) / F.greatest(n, F.lit(1)),
            "symbol_ratio": F.regexp_count("__u", F.lit("[^A-Za-z0-9]")) / F.greatest(n, F.lit(1)),
            "entropy": F.coalesce(F.when(n > 0, entropy), F.lit(0.0)),
            "n_params": F.when(after != "", F.regexp_count(after, F.lit("&")) + 1).otherwise(0).cast("double"),
            "has_fragment": F.col("__u").contains("#").cast("double"),
            "secure": F.col("__u").startswith("https:").cast("double"),
            "suffix": F.substring_index("host", ".", -2),
            "first": F.regexp_extract("path", "^/([^/]*)", 1),
        }
    )
    return d.drop("__u")


def _counts(labelled: DataFrame, key: str) -> DataFrame:
    """Labelled rows, and blocked ones among them, by key and fold."""
    return labelled.groupBy(key, "fold").agg(F.count("*").alias("__fc"), F.sum("label").alias("__fb"))


def _stats(folds: DataFrame, key: str, name: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Key statistics by fold (for training, without the own fold; of the keys
    in ``wanted``) and whole.

    Rows: key, seen (log count), block (smoothed share of blocked URLs)."""

    def shaped(df: DataFrame, *by: str) -> DataFrame:
        share = (F.col("__b") + 1) / (F.col("__c") + 2)
        return df.select(*by, F.log1p("__c").alias(f"{name}_seen"), share.alias(f"{name}_block"))

    whole = lambda f: f.groupBy(key).agg(F.sum("__fc").alias("__c"), F.sum("__fb").alias("__b"))
    near = folds.join(sized(wanted.select(key).distinct()), key, "left_semi")
    own = near.join(whole(near), key).select(
        key, "fold", (F.col("__c") - F.col("__fc")).alias("__c"), (F.col("__b") - F.col("__fb")).alias("__b")
    )
    return shaped(own, key, "fold"), shaped(whole(folds), key)


class UrlModel:
    """Fitted statistics and trees. ``labelled``: columns ``url`` and ``label``
    (1.0 block, 0.0 allow). With labels of one kind, or none, the model says
    that kind (allow) for every URL."""

    def __init__(self, labelled: DataFrame, max_rows: int = TRAIN_ROWS, trees: int = 12, depth: int = 4, seed: int = 7):
        lab = labelled.where("label IS NOT NULL").select("url", F.col("label").cast("double").alias("label"))
        lab = lab.withColumn("__h", F.xxhash64(F.coalesce("url", F.lit("")), F.lit(seed))).withColumn("fold", F.pmod("__h", F.lit(FOLDS)))
        keyed = lexical(lab)
        folds = {key: staged(_counts(keyed, key), f"url-{key}-folds") for key in ("suffix", "first")}
        total = folds["suffix"].agg(F.sum("__fc"), F.sum("__fb")).first()
        allowed, blocked = (total[0] or 0) - (total[1] or 0), total[1] or 0
        self.kinds = [kind for kind, n in ((0.0, allowed), (1.0, blocked)) if n]
        self.trees = None
        if len(self.kinds) < 2:
            return
        # Distinct URLs, so that a hot one does not fill the sample.
        urls = lab.dropDuplicates(["url", "label"])
        sample = staged(urls.orderBy("__h", "url", "label").limit(max_rows), "url-sample")
        there = {r[0] for r in sample.select("label").distinct().collect()}
        for kind in set(self.kinds) - there:  # too rare to be in the sample
            sample = sample.union(urls.where(F.col("label") == kind).orderBy("__h", "url").limit(max(1, max_rows // 100)))
        keys = train = staged(lexical(sample), "url-train")
        self.stats = []
        for key in ("suffix", "first"):
            own, whole = _stats(folds[key], key, key, keys)
            train = train.join(own, [key, "fold"], "left")
            self.stats.append((key, staged(whole, f"url-{key}")))
        gbt = GBTClassifier(labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=seed, maxBins=32)
        train = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(train.fillna(0.0, FEATURES))
        self.trees = gbt.fit(train.select("features", "label").coalesce(4))

    def block_probability(self, df: DataFrame) -> DataFrame:
        """``df`` with the lexical columns plus ``p_block`` (double)."""
        if self.trees is None:
            return df.withColumn("p_block", F.lit(self.kinds[0] if self.kinds else 0.0))
        for key, whole in self.stats:
            df = df.join(sized(whole), key, "left")
        df = df.fillna({c: 0.0 for c in FEATURES if c.endswith("_seen")} | {c: 0.5 for c in FEATURES if c.endswith("_block")})
        df = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)
        return self.trees.transform(df).withColumn("p_block", vector_to_array("probability")[1])


def judge_urls(pages: DataFrame, model: UrlModel, url: str = "url", keep: Sequence[str] = ("page_id",), rules=RULES) -> DataFrame:
    """``keep`` columns, host, path, rule, verdict and p_block of every row.

    A fitting rule decides; else block from a probability of one half. Null
    and malformed URLs have empty host and path and go to the model like any
    other; repeated rows stay repeated; other columns are not looked at.
    """
    d = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__row"), F.col(f"`{url}`").alias("url"))
    d = model.block_probability(lexical(d))
    rule, says = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(says, F.when(F.col("p_block") >= 0.5, "block").otherwise("allow"))
    return d.select(*[F.col("__row").getField(c).alias(c) for c in keep], "host", "path", rule.alias("rule"), verdict.alias("verdict"), "p_block")


def rule_labels(pages: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """Labelled URLs: those on which a rule decides."""
    host, path = url_parts(F.col("url"))
    verdict = rule_of(host, path, rules)[1]
    return pages.select(F.col(f"`{url}`").alias("url")).select("url", F.when(verdict == "block", 1.0).when(verdict == "allow", 0.0).alias("label"))
