"""URL filter: host and path rules, and gradient-boosted trees for the rest.

A URL that fits a rule takes the rule's verdict.  Those URLs are the labelled
ones: boosted trees (Spark ML) learn block or allow from lexical features
(length, depth, digit ratio, entropy, parameter counts, how common and how
often blocked the host's last label is on other rows) and judge the URLs that no rule fits.

Everything is Column expressions and Spark ML in the JVM.  Suffix statistics
are counts over all URLs, aggregated before the shuffle; they are joined on
the suffix with no hint, so a small table is broadcast by its measured size
and otherwise adaptive execution splits a suffix that holds most rows.  The
trees are fitted on at most ``fit_rows`` different URLs of each verdict, picked
by a hash, so a URL that fills a third of the table is one row of the sample;
only the picks (two numbers each) are broadcast.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import numbered, table, without, written

#: (verdict, host/path prefix)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
FEATURES = ("f_length", "f_host_length", "f_path_length", "f_labels", "f_depth", "f_digits", "f_entropy", "f_params",
            "f_param_length", "f_hyphens", "f_https", "f_suffix_count", "f_suffix_block")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_path(url):
    """(host, path) Columns: after the first ``://``; both empty without one."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + 1), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def rule_of(host, path, rules=RULES):
    """(rule, verdict) Columns of the longest rule that fits; null if none does."""
    rule = verdict = None
    for said, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, said) if verdict is None else verdict.when(fits, said)
    return (rule, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def lexical(url, host, path) -> dict:
    """Feature Columns of a URL but for the suffix statistics; all finite for any text."""
    url = F.coalesce(url, F.lit(""))
    n = F.length(url)
    size = F.greatest(n, F.lit(1)).cast("double")
    share = lambda c: (n - F.length(F.replace(url, c, F.lit("")))) / size
    letters = F.filter(F.array_distinct(F.split(url, "")), lambda c: c != "")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    full = lambda parts: F.size(F.filter(parts, lambda x: x != "")).cast("double")
    return {
        "f_length": n.cast("double"), "f_host_length": F.length(host).cast("double"),
        "f_path_length": F.length(path).cast("double"), "f_labels": full(F.split(host, r"\.")),
        "f_depth": full(F.split(path, "/")),
        "f_digits": F.length(F.regexp_replace(url, "[^0-9]", "")) / size,
        "f_entropy": F.aggregate(letters, F.lit(0.0), lambda s, c: s - share(c) * F.log2(share(c))),
        "f_params": full(F.split(query, "&")), "f_param_length": F.length(query).cast("double"),
        "f_hyphens": F.length(F.regexp_replace(host, "[^-]", "")).cast("double"),
        "f_https": url.startswith("https://").cast("double"),
    }


def _described(pages: DataFrame, url_col: str, rules) -> DataFrame:
    url = F.col(url_col).cast("string")
    host, path = host_path(url)
    found = pages.withColumns({"host": host, "path": path})
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    return found.withColumns({"rule": rule, "_said": said, "_suffix": F.substring_index("host", ".", -1),
                              **lexical(url, F.col("host"), F.col("path"))})


def _sample(full: DataFrame, url_col: str, fit_rows: int) -> DataFrame:
    """(label, _pick, features): the ``fit_rows`` different URLs of each verdict whose hashes are the smallest."""
    labelled = full.where("_said IS NOT NULL").select((F.col("_said") == "block").cast("double").alias("label"),
                                                      F.xxhash64(F.col(f"`{url_col}`").cast("string")).alias("_pick"), *FEATURES)
    different = labelled.select("label", "_pick").distinct()
    # ordered limits: a task sends fit_rows picks of each verdict at most
    least = lambda label: different.where(F.col("label") == label).orderBy("_pick").limit(fit_rows)
    picks = least(0.0).unionByName(least(1.0))
    return labelled.join(F.broadcast(picks), ["label", "_pick"]).dropDuplicates(["label", "_pick"])


def url_verdicts(pages: DataFrame, url_col: str = "url", rules=RULES, fit_rows: int = 10_000, trees: int = 20,
                 depth: int = 4, seed: int = 7) -> DataFrame:
    """``pages`` with host, path, rule (or null) and verdict (block or allow).

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path: from there up to ``?``, ``#`` or the end.  A rule fits
    its host and all subdomains where the path starts with the rule's; the
    longest rule wins.  Null or empty url, or one without ``://``: both
    empty, no rule, judged by the trees like any other.  If no URL fits a
    rule, the rest is allowed; if all rules that fit say the same, so does
    the rest.  Rows that repeat are judged alike.  Empty table: no rows.
    Columns of these names in the input are replaced, others may have any
    name.
    """
    pages, given, (url_col,) = numbered(without(pages, "host", "path", "rule", "verdict"), url_col)
    found = _described(pages, url_col, rules)
    blocked, said = F.coalesce(F.col("_said") == "block", F.lit(False)).cast("int"), F.col("_said").isNotNull().cast("int")
    stats = found.groupBy("_suffix").agg(F.log1p(F.count("*").cast("double")).alias("f_suffix_count"),
                                         F.sum(blocked).alias("_blocked"), F.sum(said).alias("_judged"))
    stats = written(stats, "url-suffixes").withColumnRenamed("_suffix", "_of")
    # a row's own verdict is no evidence for itself
    full = (found.join(stats, found["_suffix"] == stats["_of"], "left")
            .withColumn("f_suffix_block", (F.col("_blocked") - blocked + 1) / (F.col("_judged") - said + 2)))

    sample = written(_sample(full, url_col, fit_rows), "url-sample")
    kinds = [r.label for r in sample.select("label").distinct().collect()]
    if len(kinds) < 2:
        other = F.lit("block" if kinds == [1.0] else "allow")
    else:
        features = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
        model = GBTClassifier(labelCol="label", featuresCol="_features", predictionCol="_prediction", maxIter=trees,
                              maxDepth=depth, seed=seed).fit(features.transform(sample.repartition(1).sortWithinPartitions("label", "_pick")))
        model = model.setRawPredictionCol("_raw").setProbabilityCol("_probability")
        full = model.transform(features.transform(full))
        other = F.when(F.col("_prediction") == 1.0, "block").otherwise("allow")
    return full.select(*given, "host", "path", "rule", F.coalesce("_said", other).alias("verdict"))


def op4(spark, sf_dir: str) -> DataFrame:
    return (url_verdicts(table(spark, sf_dir, "pages").select("page_id", "url"))
            .select("page_id", "host", "path", "rule", "verdict"))
