"""Language identification: multinomial naive Bayes over hashed character n-grams.

Method. Texts are lower-cased, characters other than letters become spaces, and all n-grams of one
to three characters are hashed into `BUCKETS` buckets. Counts by language cover all labelled rows:
each task adds up its own, Spark sums them by (language, bucket). The log-probability matrix, of
languages x BUCKETS 32-bit numbers, is broadcast and a batch is scored by gathering its n-grams'
rows and adding them up by text. The score is the posterior probability of the predicted language.

The posterior says which language is the likeliest, not whether a text is in any. `keep_identified`
therefore also looks at the surprise: by how much a text's mean log-probability per n-gram is below
what its predicted language gives itself on average. `MOST_SURPRISE` (nats) was set from the given
tables, whose clean texts stay below 2 and random letters and other scripts above 4; a text of few
n-grams has `DEVIATIONS` standard errors more.

Input cases. Text null, empty or without a letter: `und` with score 0. No labelled row: all `und`.
Rows with a null language are not learned from; rows with a null id are not learned from and are
not held out. Ties go to the language first in order. Whole texts are used, however long. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirlens.llm import tables, text

ORDERS = (1, 2, 3)
BITS = 15
BUCKETS = 1 << BITS
SMOOTHING = 0.1
UNDETERMINED = "und"
MOST_SURPRISE, DEVIATIONS = 3.0, 4.0
#: Bytes of texts looked at together; a longer text stands alone. A worker holds about 100 bytes for each.
CHUNK = 1 << 18

_letters: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def ngrams(texts: list[str | None]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """(buckets, bounds by text) for each order, and which texts have a letter."""
    lowered = [(x or "").lower() for x in texts]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lowered])]).astype(np.int64)
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = is_letter()[codes]
    some = np.diff(np.concatenate([[0], np.cumsum(letter)])[bounds]) > 0
    codes = np.where(letter, codes, 32).astype(np.uint64)
    out = []
    for n in ORDERS:
        starts, cuts = text.runs(bounds, n)
        h = np.full(len(starts), n, dtype=np.uint64)
        for k in range(n):
            h = (h + codes[starts + k]) * text.BASE
            h ^= h >> np.uint64(29)
        out.append(((h * text.INVERSE >> np.uint64(64 - BITS)).astype(np.int64), cuts))
    return out, some


def _chunks(array: pa.Array, most: int = CHUNK) -> Iterator[list[str | None]]:
    _, offsets = text.buffers(array)
    for lo, hi in text.slices(offsets, most):
        yield array.slice(lo, hi - lo).to_pylist()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, bucket, n), with the number of texts as bucket -1."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        names = batch.column(0).to_pylist()
        done = 0
        for texts in _chunks(batch.column(1)):
            own = np.array(names[done : done + len(texts)], dtype=object)
            done += len(texts)
            grams, _ = ngrams(texts)
            for name in sorted(set(own)):
                total = counts.setdefault(name, np.zeros(BUCKETS + 1, dtype=np.int64))
                mine = own == name
                total[BUCKETS] += int(mine.sum())
                for bucket, cuts in grams:
                    total[:BUCKETS] += np.bincount(bucket[np.repeat(mine, np.diff(cuts))], minlength=BUCKETS)
    for name, total in counts.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(np.where(at == BUCKETS, -1, at)), pa.array(total[at])], names=["lang", "bucket", "n"])


class Model:
    """languages, and weights (BUCKETS, languages) and prior (languages) as logarithms."""

    def __init__(self, languages: list[str], counts: np.ndarray, texts: np.ndarray):
        self.languages = languages
        smooth = counts + SMOOTHING
        self.weights = np.log(smooth / smooth.sum(axis=0)).astype(np.float32) if languages else np.zeros((BUCKETS, 0), np.float32)
        self.prior = np.log((texts + 1.0) / (texts + 1.0).sum()) if languages else np.zeros(0)
        logs = self.weights.astype(np.float64)
        self.mean = (np.exp(logs) * logs).sum(axis=0)
        self.deviation = np.sqrt(np.maximum(0.0, (np.exp(logs) * logs**2).sum(axis=0) - self.mean**2))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        return self.judge(texts)[:2]

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, scores and surprises, the last less what chance allows a text of so few n-grams."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        grams, some = ngrams(texts)
        total = np.tile(self.prior, (len(texts), 1))
        for bucket, cuts in grams:
            have = np.flatnonzero(np.diff(cuts))
            if len(have):
                total[have] += np.add.reduceat(self.weights[bucket], cuts[have], axis=0, dtype=np.float64)
        best = total.argmax(axis=1)
        score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        n = np.maximum(1, sum(np.diff(cuts) for _, cuts in grams))
        surprise = self.mean[best] - (total.max(axis=1) - self.prior[best]) / n - DEVIATIONS * self.deviation[best] / np.sqrt(n)
        names = [self.languages[b] if s else UNDETERMINED for b, s in zip(best.tolist(), some.tolist(), strict=True)]
        return names, np.where(some, score, 0.0), np.where(some, surprise, 0.0)


def fit(labelled: DataFrame) -> Model:
    """A model from all rows of labelled (lang, text) with a language."""
    rows = labelled.where("lang is not null and text is not null").select("lang", "text")
    found = rows.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(set(found["lang"]))
    counts, texts = np.zeros((BUCKETS, len(languages))), np.zeros(len(languages))
    column = found["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=np.int64)
    bucket, n = found["bucket"].to_numpy(dtype=np.int64), found["n"].to_numpy(dtype=np.float64)
    counts[bucket[bucket >= 0], column[bucket >= 0]] = n[bucket >= 0]
    texts[column[bucket < 0]] = n[bucket < 0]
    return Model(languages, counts, texts)


def predicted(spark: SparkSession, model: Model) -> Callable[[Column | str], Column]:
    """A function of a text column: struct of lang_pred, score and surprise."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,surprise:double>")
    def predict(texts: pa.Array) -> pa.Array:
        names: list[str] = []
        scores: list[np.ndarray] = [np.zeros((2, 0))]
        for some in _chunks(texts):
            a, *b = shared.value.judge(some)
            names += a
            scores.append(np.stack(b))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), *map(pa.array, np.concatenate(scores, axis=1))], names=["lang_pred", "score", "surprise"])

    return predict


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """docs (text, ...) with one more column, `found`, of lang_pred, score and surprise."""
    return docs.withColumn("found", predicted(docs.sparkSession, fit(labelled))("text"))


def keep_identified(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """docs without the rows whose language stays undetermined, scores below min_score or is none of the learned ones."""
    found = docs.select(F.struct("*").alias("row"), predicted(docs.sparkSession, fit(docs))("text").alias("found"))
    kept = found.where((F.col("found.lang_pred") != UNDETERMINED) & (F.col("found.score") >= min_score) & (F.col("found.surprise") <= MOST_SURPRISE))
    return kept.select("row.*")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learn = docs.where(F.col("doc_id").isNotNull() & ~held_out())
    return identify(docs, learn).select("doc_id", held_out().alias("held_out"), "found.lang_pred", "found.score")
