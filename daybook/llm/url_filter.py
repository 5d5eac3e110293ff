"""URL filter: host and path rules, and boosted trees on lexical features for the rest.

Urls that a rule fits are the labelled ones: their verdicts train the trees, which then judge
every url without a rule. All columns are SQL functions; training is Spark's own
gradient-boosted trees.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (verdict, host, path): a rule fits its host and all hosts below it.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"),
         ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]

# The trees are fitted on at most this many distinct labelled urls, half of them of each
# verdict, those of the smallest hashes, weighted by their rows and by their verdict's share
# of all labelled rows; everything else covers all rows.
TRAIN_ROWS = 20_000
TREES = 12
DEPTH = 3

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

FEATURES = ["url_chars", "host_chars", "path_chars", "depth", "labels", "digit_ratio",
            "entropy", "params", "query_chars", "marks", "secure", "suffix_blocked",
            "suffix_share"]


def with_parts(pages: DataFrame) -> DataFrame:
    """Add host and path. Null urls and urls without ``://`` have both empty."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1)
    return pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"),
                        F.translate(host, _UPPER, _UPPER.lower()).alias("host"),
                        path.alias("path"))


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """Add the rule that fits (host and path in one string, else null) and its verdict.

    The longest rule wins; of equally long ones a block, then the first by text.
    """
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    rule = verdict = None
    for kind, host, path in order:
        fits = (((F.col("host") == host) | F.col("host").endswith("." + host))
                & F.col("path").startswith(path))
        rule = (F if rule is None else rule).when(fits, F.lit(host + path))
        verdict = (F if verdict is None else verdict).when(fits, F.lit(kind))
    none = F.lit(None).cast("string")
    return pages.withColumns({"rule": none if rule is None else rule,
                              "rule_verdict": none if verdict is None else verdict})


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def entropy(text: Column) -> Column:
    """Bits for each character of a text; 0 for an empty one."""
    def share(char: Column) -> Column:
        return (F.length(text) - F.length(F.replace(text, char, F.lit("")))) / F.length(text)

    chars = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.aggregate(chars, F.lit(0.0), lambda acc, c: acc - share(c) * F.log2(share(c)))


def with_features(pages: DataFrame) -> DataFrame:
    """Add the lexical features of url, host and path, and the host's suffix."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    digits = F.length(url) - F.length(F.translate(url, "0123456789", ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return pages.withColumns({
        "url_chars": F.length(url).cast("double"), "host_chars": F.length(host).cast("double"),
        "path_chars": F.length(path).cast("double"), "depth": _count(path, "/").cast("double"),
        "labels": _count(host, ".").cast("double"),
        "digit_ratio": digits / F.greatest(F.length(url), F.lit(1)),
        "entropy": entropy(url),
        "params": F.when(query == "", 0).otherwise(_count(query, "&") + 1).cast("double"),
        "query_chars": F.length(query).cast("double"),
        "marks": (_count(url, "-") + _count(url, "_") + _count(url, "%")).cast("double"),
        "secure": F.startswith(url, F.lit("https")).cast("double"),
        "suffix": F.substring_index(host, ".", -1)})


def with_suffix_statistics(pages: DataFrame) -> tuple[DataFrame, int, int]:
    """Add, by host suffix, the share of all urls and the blocked share of labelled ones.

    Both come from all rows; the blocked share is drawn to that of all labelled urls by the
    weight of ten of them, so a suffix without labels gets just that. The statistics have a
    row for each suffix; Spark joins them by their real size. Also returned are the numbers
    of all labelled and all blocked rows.
    """
    by = pages.groupBy("suffix").agg(
        F.count("*").alias("n"), F.count("rule_verdict").alias("labelled"),
        F.count_if(F.col("rule_verdict") == "block").alias("blocked"))
    total = by.agg(F.sum("n").alias("n"), F.sum("labelled").alias("labelled"),
                   F.sum("blocked").alias("blocked")).head()
    n = total["n"] or 1
    labelled, blocked = total["labelled"] or 0, total["blocked"] or 0
    prior = blocked / (labelled or 1)
    stats = by.select("suffix", (F.col("n") / n).alias("suffix_share"),
                      ((F.col("blocked") + 10 * prior) / (F.col("labelled") + 10))
                      .alias("suffix_blocked"))
    return pages.join(stats, "suffix", "left"), labelled, blocked


def training_urls(rows: DataFrame, n_labelled: int, n_blocked: int,
                  train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Distinct labelled urls with features, label and weight, half of ``train_rows`` a verdict.

    A url weighs as many rows as it has; all of a verdict together weigh its share of all
    labelled rows, a row 1 on average over the sample's urls.
    """
    urls = (rows.filter("rule_verdict IS NOT NULL").groupBy("url")
            .agg(F.count("*").alias("n"), F.first("rule_verdict").alias("rule_verdict"),
                 *[F.first(c).alias(c) for c in FEATURES]))
    picks = [urls.filter(F.col("rule_verdict") == kind).orderBy(F.xxhash64("url"), "url")
             .limit(max(train_rows // 2, 1)) for kind in ("allow", "block")]
    picked = (picks[0].unionByName(picks[1])
              .withColumn("label", (F.col("rule_verdict") == "block").cast("double")).cache())
    held = {r["label"]: r for r in picked.groupBy("label")
            .agg(F.sum("n").alias("n"), F.count("*").alias("urls")).collect()}
    total = sum(r["urls"] for r in held.values())
    share = {1.0: n_blocked / n_labelled, 0.0: 1 - n_blocked / n_labelled}
    each = {kind: share[kind] * total / r["n"] for kind, r in held.items()}
    return picked.withColumn("weight", F.col("n") * F.when(F.col("label") == 1.0, each[1.0])
                             .otherwise(each[0.0]))


def judge(pages: DataFrame, rules=RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Verdict for every url: that of its rule, else that of the trees.

    ``pages`` needs ``page_id`` and ``url``; other columns are ignored. Null ids, repeated ids
    and rows each give a row, a null url is judged as an empty one, an empty table gives none.
    If the rules label no url, or all alike, there is nothing to tell apart: the rest gets the
    one verdict seen, or ``allow``. ``p_block`` is the trees' probability, null for rules.
    """
    rows, n_labelled, n_blocked = with_suffix_statistics(
        with_features(with_rule(with_parts(pages), rules)))
    columns = ["page_id", "host", "path", "rule"]
    if n_blocked in (0, n_labelled):
        rest = "block" if n_blocked else "allow"
        return rows.select(*columns, F.coalesce("rule_verdict", F.lit(rest)).alias("verdict"),
                           F.lit(None).cast("double").alias("p_block"))
    train = training_urls(rows, n_labelled, n_blocked, train_rows)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    train = assembler.transform(train).select("features", "label", "weight").cache()
    model = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                          maxIter=TREES, maxDepth=DEPTH, seed=7).fit(train)
    train.unpersist()
    scored = model.transform(assembler.transform(rows))
    p_block = F.when(F.col("rule").isNull(), vector_to_array("probability")[1])
    by_trees = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return scored.select(*columns, F.coalesce("rule_verdict", by_trees).alias("verdict"),
                         p_block.alias("p_block"))
