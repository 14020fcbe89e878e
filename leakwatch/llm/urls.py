"""URL filter: explicit rules first, gradient-boosted trees on lexical features for the rest.

The trees learn from the URLs that a rule decides: their length, depth, digits, entropy,
parameters, and how often their suffixes were blocked.
"""

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from leakwatch.llm import text as T

RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
FIT_ROWS = 20_000
TREES = 10
DEPTH = 4
SUFFIXES = 1000
FEATURES = (
    "length host_length path_length depth labels digit_ratio entropy parameters hyphens path_digits "
    "top_rate suffix_rate segment_rate ending_rate"
).split()


def parts(url):
    """(host, path) of a URL column; both empty for null or without "://".

    The host is what follows the first "://" up to /, ?, # or the end, with A-Z
    lower-cased; the path goes on from there up to ? or #.
    """
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_of(host, path, rules=RULES):
    """The longest rule (host/path-prefix) that fits, as a struct of rule and verdict, or null.

    A rule fits its host and all subdomains, if the path starts with the rule's. Between
    equal lengths the first listed wins.
    """
    case = F
    for rule, verdict in sorted(rules, key=lambda r: -len(r[0])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        case = case.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
    return case


def _lexical(url, host, path):
    """Features of the URL's characters alone."""
    n = F.length(url)
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    chars = F.array_distinct(F.split(url, ""))
    shares = F.transform(
        F.filter(chars, lambda c: c != ""),
        lambda c: (n - F.length(F.replace(url, c, F.lit("")))).cast("double") / n,
    )
    entropy = F.aggregate(shares, F.lit(0.0), lambda s, p: s - p * F.log2(p))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return {
        "length": n,
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.size(F.filter(F.split(path, "/"), lambda p: p != "")),
        "labels": F.size(F.split(host, r"\.")),
        "digit_ratio": digits / F.greatest(n, F.lit(1)),
        "entropy": F.when(n > 0, entropy).otherwise(0.0),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda p: p != "")),
        "hyphens": n - F.length(F.replace(url, F.lit("-"), F.lit(""))),
        "path_digits": F.length(F.regexp_replace(path, "[^0-9]", "")),
    }


def _suffixes(host, path):
    """Texts whose share of blocked URLs is a feature: host suffixes, first segment, file ending."""
    labels = F.split(host, r"\.")
    return {
        "top": F.element_at(labels, -1),
        "suffix": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), "."),
        "segment": F.regexp_extract(path, r"^/([^/]*)/", 1),
        "ending": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1),
    }


class Model:
    """Shares of blocked URLs by suffix, and the trees; `trees` is None for one class only."""

    def __init__(self, rates, overall, trees):
        self.rates, self.overall, self.trees = rates, overall, trees


def _features(rows, rates, overall):
    """Add the feature columns to rows with `_url`, `_host`, `_path`."""
    lexical = _lexical(F.col("_url"), F.col("_host"), F.col("_path"))
    out = rows.withColumns({f"_{k}": v.cast("double") for k, v in lexical.items()})
    out = out.withColumns({f"_k_{k}": v for k, v in _suffixes(F.col("_host"), F.col("_path")).items()})
    for kind in ("top", "suffix", "segment", "ending"):
        known = F.create_map(*[F.lit(x) for k, v in sorted(rates.get(kind, {}).items()) for x in (k, float(v))])
        rate = F.coalesce(F.try_element_at(known, F.col(f"_k_{kind}")), F.lit(overall)) if rates.get(kind) else F.lit(overall)
        out = out.withColumn(f"_{kind}_rate", rate)
    return out


def fit(labelled, fit_rows=FIT_ROWS, trees=TREES, depth=DEPTH, suffixes=SUFFIXES):
    """Model from rows (_url, _host, _path, _label): 1 is blocked, about `fit_rows` of them.

    Of each kind of suffix only those that make up at least 1 / `suffixes` of the sample
    get a share of their own, smoothed to the overall share; others take the overall one.
    """
    sample = T.staged(T.few_rows(labelled.select("_url", "_host", "_path", "_label"), fit_rows), "url-sample")
    total, blocked = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("_label"), F.lit(0))).first()
    overall = blocked / total if total else 0.0
    kinds = _suffixes(F.col("_host"), F.col("_path"))
    keyed = sample.select("_label", F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("key")) for k, v in kinds.items()])).alias("s"))
    counted = keyed.groupBy("s.kind", "s.key").agg(F.count(F.lit(1)).alias("n"), F.sum("_label").alias("b"))
    rates = {}
    for kind, key, n, b in counted.where(F.col("n") * suffixes >= total).collect():
        rates.setdefault(kind, {})[key] = (b + 10 * overall) / (n + 10)
    if not 0 < blocked < total:
        return Model(rates, overall, None)
    # One ordered part: sums do not depend on how the sample happened to be split.
    ready = _features(sample, rates, overall).coalesce(1).sortWithinPartitions("_url")
    vectors = VectorAssembler(inputCols=[f"_{f}" for f in FEATURES], outputCol="_vector")
    rows = T.staged(vectors.transform(ready).select("_vector", F.col("_label").cast("double").alias("_label")), "url-vectors")
    booster = GBTClassifier(
        featuresCol="_vector", labelCol="_label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7
    )
    return Model(rates, overall, booster.fit(rows.coalesce(1)))


def judge(pages, rules=RULES, fit_rows=FIT_ROWS, threshold=0.5):
    """page_id, host, path, rule, verdict, score: one row per input row.

    `rule` is the rule that decides, or null; `score` is the model's chance of a block for
    every URL, and decides at `threshold` where no rule does. If the rules decide no URL,
    or all alike, the score is the share of blocked ones (0 if there is none).

    Null and empty URLs have an empty host and path and no rule. Repeated rows are judged
    alike. Other columns are not read. Empty tables give empty results.

    Scale: features are column expressions, the model is trained on a bounded sample by
    Spark's own trees; all pages are judged in one scan without a shuffle.
    """
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("_url"), host.alias("_host"), path.alias("_path"))
    ruled = rows.withColumn("_rule", rule_of(F.col("_host"), F.col("_path"), rules))
    labelled = ruled.where("_rule is not null").withColumn("_label", (F.col("_rule.verdict") == "block").cast("int"))
    model = fit(labelled, fit_rows)
    if model.trees is None:
        scored = ruled.withColumn("_score", F.lit(float(model.overall)))
    else:
        vectors = VectorAssembler(inputCols=[f"_{f}" for f in FEATURES], outputCol="_vector")
        scored = model.trees.transform(vectors.transform(_features(ruled, model.rates, model.overall)))
        scored = scored.withColumn("_score", F.get(vector_to_array("probability"), F.lit(1)))
    guess = F.when(F.col("_score") >= threshold, "block").otherwise("allow")
    return scored.select(
        "page_id",
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", guess).alias("verdict"),
        F.col("_score").alias("score"),
    )
