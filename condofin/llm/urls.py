"""URL filters: host and path rules, and gradient-boosted trees on lexical
features for the URLs that no rule decides.  DataFrame operations only."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# Verdict, host and path of each rule.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Labelled URLs that the trees are grown on at most (distinct ones, by a hash of the URL).
FIT_URLS = 20_000
TREES = 20
DEPTH = 4
#: Suffix statistics of at most so many suffixes are broadcast, more are joined.
BROADCAST_SUFFIXES, BROADCAST_BYTES = 50_000, 4 << 20
#: Parts of the labelled URLs; a URL's own part is left out of its suffix's rate when the trees learn.
FOLDS = 5
SPARE = 64  # draws beyond twice the sample that are ranked
PRIOR = 20.0  # labelled URLs that a suffix's rate starts with at the overall rate

LEXICAL = ("length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "entropy",
           "parameters", "hyphens", "suffix_pages", "suffix_rate")


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``; both are empty for a null
    URL and one without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": host, "path": path})


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``: its text (like
    ``net/``) and verdict, else nulls."""
    text = verdict = F.lit(None).cast("string")
    for what, host, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(start)
        text = F.when(fits, F.lit(host + start)).otherwise(text)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return text, verdict


def _entropy(text: Column) -> Column:
    """Bits per character.  The characters are sorted, so that equal ones are a
    run and its length is the distance between the places where runs begin."""
    def bits(chars):
        n = F.size(chars)
        begin = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(chars, i) != F.get(chars, i - 1)))
        # bound to a lambda's variable, so that it is computed once
        return F.element_at(F.transform(F.array(begin), lambda at: -F.aggregate(
            F.zip_with(F.slice(F.concat(at, F.array(n)), F.lit(2), F.size(at)), at, lambda end, start: (end - start) / n),
            F.lit(0.0), lambda s, p: s + p * F.log2(p))), 1)

    return F.when(F.length(text) > 0, F.element_at(F.transform(F.array(F.array_sort(F.split(text, ""))), bits), 1)).otherwise(0.0)


def _lexical(df: DataFrame, url: str = "url") -> DataFrame:
    u = F.coalesce(F.col(url), F.lit(""))
    length = F.length(u).cast("double")
    counts = {
        "length": length,
        "host_length": F.length("host").cast("double"),
        "path_length": F.length("path").cast("double"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda p: p != "")).cast("double"),
        "host_labels": F.size(F.split("host", "\\.")).cast("double"),
        "digit_ratio": F.when(length > 0, (length - F.length(F.translate(u, "0123456789", ""))) / length).otherwise(0.0),
        "entropy": _entropy(u),
        "parameters": F.size(F.filter(F.split(F.regexp_extract(u, "\\?([^#]*)", 1), "&"), lambda p: p != "")).cast("double"),
        "hyphens": (length - F.length(F.translate(u, "-", ""))).cast("double"),
        "suffix": F.substring_index("host", ".", -1),
    }
    return df.withColumns(counts)


def url_labels(labels: DataFrame) -> DataFrame:
    """``named`` (document id) and ``bad`` (1.0: toxic or of low quality) of
    the labelled documents; repeated labels count as the worst."""
    bad = F.greatest(F.coalesce("toxic", F.lit(0)), 1 - F.coalesce("quality", F.lit(1)))
    return (labels.where(F.col("doc_id").isNotNull() & (F.col("toxic").isNotNull() | F.col("quality").isNotNull()))
            .groupBy(F.col("doc_id").alias("named")).agg(F.max(bad).cast("double").alias("bad")))


def _fold(url: str = "url") -> Column:
    """Part of the labelled URLs, by the URL: equal ones are in one part."""
    return F.pmod(F.xxhash64(F.lit("fold"), F.col(url)), F.lit(FOLDS)).cast("int")


def _rates(labelled: DataFrame, lexical: DataFrame) -> tuple[DataFrame, float]:
    """``suffix, suffix_pages`` (log) and ``of_fold``: labels and bad labels of
    each fold, and the overall rate of bad labels."""
    rate = labelled.agg(F.avg("bad")).first()[0] or 0.0
    pages = lexical.groupBy("suffix").agg(F.log1p(F.count(F.lit(1))).alias("suffix_pages"))
    counts = labelled.groupBy("suffix").agg(*[
        x for f in range(FOLDS) for x in (F.count_if(_fold() == f).cast("double").alias(f"n{f}"),
                                          F.sum(F.when(_fold() == f, F.col("bad")).otherwise(0.0)).alias(f"bad{f}"))])
    of_fold = F.array(*[F.struct(F.coalesce(f"n{f}", F.lit(0.0)).alias("n"), F.coalesce(f"bad{f}", F.lit(0.0)).alias("bad"))
                        for f in range(FOLDS)])
    out = materialize(pages.join(counts, "suffix", "left").select("suffix", "suffix_pages", of_fold.alias("of_fold")))
    small = out.agg(F.count(F.lit(1)), F.sum(F.octet_length("suffix"))).first()
    return (F.broadcast(out) if small[0] <= BROADCAST_SUFFIXES and (small[1] or 0) <= BROADCAST_BYTES else out), rate


def _smoothed(rate: float, without: Column | None = None) -> Column:
    """Rate of bad labels of a suffix, drawn to the overall one; of the folds
    other than ``without``, so that a URL's own label is not in its feature."""
    def total(field):
        return F.aggregate(F.transform("of_fold", lambda x, i: x[field] if without is None else
                                       F.when(i == without, 0.0).otherwise(x[field])), F.lit(0.0), lambda a, x: a + x)
    return (total("bad") + PRIOR * rate) / (total("n") + PRIOR)


def _sample(rows: DataFrame, fit_urls: int) -> DataFrame:
    """All labelled URLs, each once (copies with the same label count once), or
    the ``fit_urls`` with the least hash.

    Hashes are uniform, so those under a cut that about twice as many pass are
    ranked, and that is all that one task holds; it is written before, so that
    task reads the sample and nothing else."""
    rows = materialize(rows.groupBy("url", "bad").agg(*[F.first(c).alias(c) for c in LEXICAL]))
    n = rows.count()
    if n > fit_urls:
        draw = F.xxhash64(F.lit("fit"), F.col("url"), F.col("bad"))
        part = (draw.cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
        rows = materialize(rows.withColumn("draw", draw).where(part < F.lit((2.0 * fit_urls + SPARE) / n)))
        rows = rows.orderBy("draw", "url", "bad").limit(fit_urls)
    return rows.select("bad", *LEXICAL)


def grow(rows: DataFrame, fit_urls: int = FIT_URLS) -> GBTClassificationModel | None:
    """Trees grown on ``bad`` and the lexical features of labelled URLs (with
    their ``url``); None when the labels do not hold both classes.  The bounded
    sample is brought into one order in one partition, so that reruns grow the
    same trees."""
    rows = materialize(_sample(rows, fit_urls).repartition(1).sortWithinPartitions("bad", *LEXICAL))
    if rows.select("bad").distinct().count() < 2:
        return None
    data = VectorAssembler(inputCols=list(LEXICAL), outputCol="features").transform(rows)
    return GBTClassifier(labelCol="bad", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2,
                         seed=7, maxMemoryInMB=64).fit(data.select("bad", "features"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, fit_urls: int = FIT_URLS) -> DataFrame:
    """Per row of ``page_id, url``: ``page_id``, ``url``, ``host``, ``path``,
    ``rule``, ``verdict`` and ``bad_score`` (the trees' probability).

    A rule's verdict stands; the trees decide the rest.  They learn from the
    pages whose URL names a labelled document (the last number in the path is
    its id), block being toxic or of low quality.  Null URLs have empty parts
    and the features of an empty string; without labels of both classes every
    URL that no rule decides is allowed; repeated rows are judged alike, and
    learned from once; other columns of ``pages`` are not read, so their names
    don't matter; an empty table gives no rows.
    """
    text, verdict = rule_of(rules)
    lexical = materialize(_lexical(with_parts(pages.select("page_id", "url"))))
    named = lexical.withColumn("named", F.expr("try_cast(regexp_extract(path, '([0-9]+)[^0-9]*$', 1) as bigint)"))
    labelled = materialize(named.join(url_labels(labels), "named").drop("named"))
    suffixes, rate = _rates(labelled, lexical)
    # learned from the other folds' labels, judged by all of them
    model = grow(labelled.join(suffixes, "suffix").withColumn("suffix_rate", _smoothed(rate, _fold())), fit_urls)
    scored = (lexical.join(suffixes, lexical["suffix"].eqNullSafe(suffixes["suffix"]), "left").drop(suffixes["suffix"])
              .withColumn("suffix_rate", _smoothed(rate)))
    if model is None:
        scored = scored.withColumn("bad_score", F.lit(0.0))
    else:
        data = VectorAssembler(inputCols=list(LEXICAL), outputCol="features", handleInvalid="keep").transform(scored)
        scored = model.transform(data).withColumn("bad_score", vector_to_array("probability")[1])
    own = F.when(F.col("bad_score") > 0.5, "block").otherwise("allow")
    return scored.select("page_id", "url", "host", "path", text.alias("rule"),
                         F.coalesce(verdict, own).alias("verdict"), "bad_score")
