"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors of hashed character n-grams; each
language has several centroids from spherical k-means; a text takes the
language of the nearest centroid by cosine, and is rejected when even that one
is far away.
"""

from __future__ import annotations

import hashlib
import pickle
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, map_texts, materialize

#: Labelled documents that centroids are fitted on (at most, but one for each
#: language; split evenly over the languages, chosen by a hash of the text).
FIT_DOCS = 2000
#: Languages that are learned at most: those with the most distinct labelled texts, by name where
#: these tie.  So the sample, the centroids and all that is broadcast have a bound, whatever ``lang`` holds.
LANGUAGES = 500
SPARE = 64  # draws beyond twice a language's share that are ranked
DIMENSIONS = 8192
CENTROIDS = 4
ROUNDS = 12
#: A text is rejected if its cosine to the nearest centroid is below this share
#: of what nearly all labelled texts of its length class (all but LOW) reach.
REJECT_BELOW = 0.6
LOW = 0.01
CLASS_DOCS = 40  # labelled texts behind a length class's figure, at least
BINS = 1000  # of scores from 0 to 1
UNDETERMINED = "und"
CHUNK = 1 << 16

FIELDS = "lang_pred string, score double, rejected boolean"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def ngram_counts(text: bytes | None) -> np.ndarray | None:
    """Hashed counts of 1- to 3-grams of the lower-cased text, other than
    letters read as a space; None without a letter."""
    if not text:
        return None
    points = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "replace"), dtype="<u4")
    letter = _letters()[points]
    if not letter.any():
        return None
    x = np.where(letter, points, 32).astype(np.uint64)
    total = np.zeros(DIMENSIONS)
    for at in range(0, len(x), CHUNK):
        part = x[at:at + CHUNK + 2]
        code = np.zeros(len(part), dtype=np.uint64)
        for n in range(3):
            m = len(part) - n
            if m <= 0:
                break
            code = (code[:m] + part[n:] + np.uint64(n + 1)) * np.uint64(0x9E3779B97F4A7C15)
            own = min(m, CHUNK)  # grams that start in this chunk
            seen = part[:own] != 32
            for k in range(1, n + 1):
                seen |= part[k:own + k] != 32
            bins = (code[:own][seen] >> np.uint64(40)) % np.uint64(DIMENSIONS)
            total += np.bincount(bins.astype(np.int64), minlength=DIMENSIONS)
    return total


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=-1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def length_class(counts: np.ndarray) -> int:
    """Power of two in the number of n-grams: short texts lie farther out."""
    return int(np.log2(counts.sum() + 1))


@dataclass
class CentroidModel:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    floor: np.ndarray

    def near(self, counts: np.ndarray) -> tuple[int, float]:
        """The nearest centroid, the first by language where several are, and
        its cosine."""
        cosines = self.centroids @ _unit(np.log1p(counts) * self.idf)
        best = int(cosines.argmax())
        return best, float(min(1.0, max(0.0, cosines[best])))

    def predict(self, text: bytes | None) -> tuple[str, float, bool]:
        counts = ngram_counts(text)
        if counts is None or not self.languages:
            return UNDETERMINED, 0.0, True
        best, score = self.near(counts)
        floor = self.floor[min(length_class(counts), len(self.floor) - 1)]
        return self.languages[best], score, score < floor


def _floors(seen: np.ndarray) -> np.ndarray:
    """Rejection limit of each length class from ``seen`` (classes by BINS
    counts of scores): a share of the score that all but LOW of a class reach.
    A class with few texts takes in the next shorter ones, the shortest the
    next longer ones, until there are CLASS_DOCS or no more."""
    out = []
    for k in range(len(seen)):
        group, low, high = seen[k].copy(), k, k
        while group.sum() < CLASS_DOCS and (low > 0 or high + 1 < len(seen)):
            if low > 0:
                low -= 1
                group += seen[low]
            else:
                high += 1
                group += seen[high]
        at = int(np.searchsorted(np.cumsum(group), LOW * group.sum(), side="right"))
        out.append(REJECT_BELOW * min(at, BINS - 1) / BINS)
    return np.array(out) if out else np.zeros(1)


def inverse_frequency(df: np.ndarray, n: int) -> np.ndarray:
    return (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)


def fit_centroids(units: np.ndarray, languages: list[str], seed: int = 7) -> tuple[np.ndarray, list[str]]:
    """Spherical k-means inside each language over unit vectors: the centroids
    and the language of each."""
    names, centres, owners = np.array(languages), [np.zeros((0, DIMENSIONS))], []
    rng = np.random.default_rng(seed)
    for lang in sorted(set(languages)):
        own = units[names == lang]
        k = min(CENTROIDS, len(own))
        centre = own[rng.choice(len(own), k, replace=False)]
        for _ in range(ROUNDS):
            at = (own @ centre.T).argmax(1)
            centre = _unit(np.array([own[at == j].sum(0) if (at == j).any() else centre[j] for j in range(k)]))
        centres.append(centre)
        owners += [lang] * k
    return np.concatenate(centres), owners


def _frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each term occurs, over all of ``texts``, and their
    number: every task adds up its own, and 8192 sums reach the driver."""
    packed = texts.select(F.col("text").cast("binary").alias("text"))
    bound_batches(texts.sparkSession)

    def run(batches):
        df = np.zeros(DIMENSIONS + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                counts = ngram_counts(text.as_py())
                if counts is not None:
                    df[:-1] += counts > 0
                    df[-1] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at])], names=["term", "n"])

    sums = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for r in packed.mapInArrow(run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        sums[r["term"]] = r["n"]
    return sums[:-1], int(sums[-1])


def _scores(texts: DataFrame, model: CentroidModel) -> np.ndarray:
    """Counts of scores (BINS of them) by length class, over all of ``texts``."""
    shared = texts.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    packed = texts.select(F.col("text").cast("binary").alias("text"))

    def run(batches):
        model, seen = pickle.loads(shared.value), {}
        for batch in batches:
            for text in batch.column(0):
                counts = ngram_counts(text.as_py())
                if counts is not None:
                    at = length_class(counts), min(BINS - 1, int(BINS * model.near(counts)[1]))
                    seen[at] = seen.get(at, 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in seen], pa.int32()), pa.array([b for _, b in seen], pa.int32()),
             pa.array(list(seen.values()), pa.int64())], names=["class", "bin", "n"])

    rows = packed.mapInArrow(run, "class int, bin int, n bigint").groupBy("class", "bin").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros((max((r["class"] for r in rows), default=-1) + 1, BINS), dtype=np.int64)
    for r in rows:
        seen[r["class"], r["bin"]] = r["n"]
    return seen


def _least_draws(texts: DataFrame, per: DataFrame, share: int) -> DataFrame:
    """The ``share`` least ``draw`` of each ``lang`` of ``texts`` (distinct), exactly.

    Draws are uniform, so those under a cut that about twice as many pass are
    ranked; a language with too few of them under it is ranked in whole."""
    part = (F.col("draw").cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    cut = F.lit(2.0 * share + SPARE) / F.col("n")
    under = texts.join(F.broadcast(per), "lang").where(part < cut)
    short = (per.join(under.groupBy("lang").agg(F.count(F.lit(1)).alias("m")), "lang", "left")
             .where(F.coalesce("m", F.lit(0)) < F.least("n", F.lit(share))).select("lang"))
    under = under.select("lang", "draw").union(texts.join(F.broadcast(short), "lang", "left_semi")).distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    return under.withColumn("rank", rank).where(F.col("rank") <= share).select("lang", "draw")


def fit(labelled: DataFrame, fit_docs: int | None = None, languages: int = LANGUAGES) -> CentroidModel:
    """Fit on ``text, lang`` rows; null languages and letterless texts are left out.

    Document frequencies and rejection limits come from all of them.  For the
    centroids a bounded sample is enough: of each language the ``fit_docs`` /
    languages distinct texts with the least hash, or all if it has fewer;
    copies count once.  Without ``fit_docs`` it is :data:`FIT_DOCS`, or one for
    each language if there are more; a bound of one's own below their number
    is an error.  Of more than ``languages`` values of ``lang``
    those with the most distinct texts are learned; texts of the others get the
    language that they lie nearest to, or are rejected.
    """
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = labelled.select("text", "lang", F.xxhash64("text", F.lit("fit")).alias("draw"))
    texts = materialize(known.select("lang", "draw").distinct())
    per = materialize(texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages))
    n_langs = per.count()
    if not n_langs:
        return CentroidModel(np.ones(DIMENSIONS), np.zeros((0, DIMENSIONS)), [], np.zeros(1))
    if fit_docs is None:
        fit_docs = max(FIT_DOCS, n_langs)
    if n_langs > fit_docs:
        raise ValueError(f"{n_langs} language values; the fit takes {fit_docs} documents")
    texts = texts.join(F.broadcast(per.select("lang")), "lang", "left_semi")
    # at most one text for each language, or fit_docs of them
    draws = F.broadcast(materialize(_least_draws(texts, per, fit_docs // n_langs)
                                    .groupBy("draw").agg(F.collect_set("lang").alias("langs"))))
    chosen = known.select("text", "draw").join(draws, "draw")

    def counts():
        done = set()  # texts that this task has already sent: at most the sample

        def of_text(text):
            key = hashlib.sha256(text).digest()
            c = None if key in done else ngram_counts(text)
            done.add(key)
            if c is None:
                return None, None
            at = np.flatnonzero(c)
            return at.astype("<i4").tobytes(), c[at].astype("<f4").tobytes()
        return of_text

    rows = (map_texts(chosen, counts, "at binary, n binary", keep=["draw", "langs"])
            .select("doc.*", "at", "n").where(F.col("n").isNotNull()).dropDuplicates(["draw"])
            .select(F.explode("langs").alias("lang"), "at", "n").collect())
    rows.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["n"])))
    vectors = np.zeros((len(rows), DIMENSIONS), dtype=np.float32)
    for v, r in zip(vectors, rows):
        v[np.frombuffer(r["at"], dtype="<i4")] = np.frombuffer(r["n"], dtype="<f4")
    idf = inverse_frequency(*_frequencies(labelled))
    centroids, owners = fit_centroids(_unit(np.log1p(vectors) * idf), [r["lang"] for r in rows])
    model = CentroidModel(idf, centroids, owners, np.zeros(1))
    return replace(model, floor=_floors(_scores(labelled, model)))


def identify(docs: DataFrame, model: CentroidModel, keep: list[str] | None = None) -> DataFrame:
    """``doc`` (struct of the columns ``keep``, else of all) and :data:`FIELDS`.

    ``lang_pred`` is a learned language, or ``und`` if the text is null or has
    no letter (or nothing was learned); ``score`` the cosine to the nearest
    centroid, 0 to 1; ``rejected`` is true for ``und`` and for texts far from
    every centroid.  Only the text is read, very long ones whole.  Ties go to
    the first language by name; repeated rows are judged alike; columns of any
    name stay apart in ``doc``; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    return map_texts(docs, lambda: pickle.loads(shared.value).predict, FIELDS, keep=keep)


def held_out(doc_id="doc_id"):
    """True where crc32 of the id as text leaves 2 by 4; ids that are null are not."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def learn(docs: DataFrame, fit_docs: int | None = None, languages: int = LANGUAGES) -> CentroidModel:
    """Fit on the documents that are not held out (null ids are not learned from)."""
    return fit(docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("text", "lang"), fit_docs, languages)
