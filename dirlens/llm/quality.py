"""Quality classifier: random-indexing word vectors, mean-pooled, and a two-layer network.

Method. A token is a run of letters, of digits or of marks; it is hashed into one of BUCKETS. Each
token has a sparse random index vector (SPARSE entries of +1 or -1 out of DIM, by its hash), and a
bucket's context vector is the sum of the index vectors of the tokens up to REACH places from its
tokens, over all documents. Each task sums its own; the sums meet by block of buckets, first in SALTS parts.
Context vectors have the corpus' mean context taken away and are scaled to unit length. A document is
the mean and the standard deviation of its tokens' vectors; no other feature is used. A two-layer numpy
network maps this to a logit, and a temperature fitted on rows kept back from its training calibrates
it.

The network is fitted on `most_labels` labelled rows at most, those least by a hash of their id; the
vectors are counted over all documents. Vectors and network are broadcast: their size is fixed.

Input cases. Text null, empty or without a token: the pooled vector is zero, and it is scored like
any other. Without labelled rows of both kinds every score is the share of label 1, or 0.5. A null
id is neither learned from nor held out; rows that share an id share their label. Whole texts are
used, however long. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirlens.llm import tables, text

BITS, DIM, SPARSE, REACH, HIDDEN = 13, 64, 2, 2, 32
BUCKETS, BLOCK, SALTS = 1 << BITS, 64, 16
#: Tokens pooled at a time.
PIECE = 1 << 16
MOST_LABELS = 20_000
#: Space 0, letters 1, digits 2, marks 3.
KIND = np.array([0 if text.IS_SPACE[b] else 2 if chr(b).isdigit() and b < 128 else 1 if b >= 128 or chr(b).isalpha() else 3 for b in range(256)], dtype=np.uint8)


def tokens(body: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of texts lo..hi and their bounds by text."""
    data = body[offsets[lo] : offsets[hi]]
    cuts = offsets[lo : hi + 1] - offsets[lo]
    kind = KIND[data]
    edge = np.ones(len(data) + 1, dtype=bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[cuts] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    some = kind[starts] > 0 if len(data) else np.zeros(0, bool)
    starts, ends = starts[some], ends[some]
    return text.span_hash(text.prefix(text.BYTE_VALUE[data]), starts, ends), np.searchsorted(starts, cuts)


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def contexts(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(BUCKETS, DIM + 1): sums of neighbours' index vectors, and the number of tokens."""
    own = bucket(hashes)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    low = (1 << np.uint64(DIM.bit_length())) - 1
    entry = [((hashes >> np.uint64(8 * k)) & np.uint64(low)).astype(np.int64) for k in range(SPARSE)]  # below 2 * DIM: half are -1
    places = []
    for reach in range(1, REACH + 1):
        near = np.flatnonzero(doc[reach:] == doc[:-reach])
        for e in entry:
            places += [own[near] * (2 * DIM) + e[near + reach], own[near + reach] * (2 * DIM) + e[near]]
    got = np.bincount(np.concatenate(places), minlength=BUCKETS * 2 * DIM).reshape(BUCKETS, 2, DIM)
    return np.column_stack([got[:, 0] - got[:, 1], np.bincount(own, minlength=BUCKETS)])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BUCKETS, DIM + 1), dtype=np.int64)
    for batch in batches:
        body, offsets = text.buffers(batch.column(0))
        for lo, hi in text.slices(offsets):
            total += contexts(*tokens(body, offsets, lo, hi))
    yield _blocks({b: total[b : b + BLOCK].ravel() for b in range(0, BUCKETS, BLOCK) if total[b : b + BLOCK].any()})


def _blocks(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["block", "sums"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            totals[b] = totals.get(b, 0) + np.frombuffer(sums, dtype=np.int64)
    yield _blocks(totals)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """(BUCKETS, DIM) centred unit context vectors over all of docs (text); zero for buckets without a token."""
    kind = "block long, sums binary"
    parts = docs.select("text").mapInArrow(_sums, kind).withColumn("salt", F.spark_partition_id() % SALTS)
    parts = parts.repartition("block", "salt").select("block", "sums").mapInArrow(_add, kind)
    total = np.zeros((BUCKETS, DIM + 1), dtype=np.int64)
    for b, sums in parts.repartition("block").mapInArrow(_add, kind).collect():  # BUCKETS rows of DIM + 1 numbers
        total[b : b + BLOCK] = np.frombuffer(sums, dtype=np.int64).reshape(-1, DIM + 1)
    return unit_vectors(total)


def unit_vectors(total: np.ndarray) -> np.ndarray:
    vectors, n = total[:, :DIM].astype(np.float64), total[:, DIM:]
    vectors -= n * (vectors.sum(axis=0) / max(1, n.sum()))
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def features(vectors: np.ndarray, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(texts, 2 * DIM): mean and standard deviation of the tokens' vectors, zero for a text without tokens.

    Texts are summed PIECE tokens at a time, a longer one in pieces of its own, so a score depends on its text only.
    """
    out = np.zeros((len(bounds) - 1, 2 * DIM), dtype=np.float64)
    for lo, hi in text.slices(bounds, PIECE):
        for s in range(int(bounds[lo]), int(bounds[hi]), PIECE if hi - lo == 1 else max(1, int(bounds[hi] - bounds[lo]))):
            e = min(int(bounds[hi]), s + PIECE) if hi - lo == 1 else int(bounds[hi])
            some = lo + np.flatnonzero(np.diff(bounds[lo : hi + 1]))
            own = vectors[bucket(hashes[s:e])]
            at = np.maximum(bounds[some] - s, 0)
            out[some, :DIM] += np.add.reduceat(own, at, axis=0)
            out[some, DIM:] += np.add.reduceat(own * own, at, axis=0)
    out /= np.maximum(np.diff(bounds), 1)[:, None]
    out[:, DIM:] = np.sqrt(np.maximum(out[:, DIM:] - out[:, :DIM] ** 2, 0))
    return out


class Network:
    """logit(x) = relu((x - mean) / scale @ w1 + b1) @ w2 + b2, divided by the temperature.

    Trained for `epochs` passes, or as many as make `steps` steps where rows are few.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 11, epochs: int = 60, steps: int = 2000, batch: int = 256):
        rng = np.random.default_rng(seed)
        self.constant = None
        if len(y) < 10 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        x = (x - self.mean) / self.scale
        order = rng.permutation(len(y))
        check, train = order[: len(y) // 5], order[len(y) // 5 :]
        epochs = max(epochs, steps * batch // len(train))
        p = [rng.normal(0, (2 / DIM) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
        for epoch in range(epochs):
            rate = 3e-3 * (1 - epoch / epochs) + 1e-4
            rng.shuffle(train)
            for at in range(0, len(train), batch):
                rows, step = train[at : at + batch], step + 1
                hidden = np.maximum(0, x[rows] @ p[0] + p[1])
                wrong = (1 / (1 + np.exp(-(hidden @ p[2] + p[3]))) - y[rows]) / len(rows)
                back = wrong[:, None] * p[2] * (hidden > 0)
                for i, g in enumerate([x[rows].T @ back + 1e-4 * p[0], back.sum(axis=0), hidden.T @ wrong + 1e-4 * p[2], np.array([wrong.sum()])]):
                    m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
                    p[i] = p[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        self.w1, self.b1, self.w2, self.b2 = p
        logit = np.maximum(0, x[check] @ self.w1 + self.b1) @ self.w2 + self.b2
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        loss = [np.logaddexp(0, np.where(y[check] == 1, -1, 1) * logit / t).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        logit = np.maximum(0, (x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2
        return 1 / (1 + np.exp(-np.clip(logit / self.temperature, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, most_labels: int = MOST_LABELS) -> Network:
    """A network from labels (doc_id, quality) of docs (doc_id, text)."""
    spark = docs.sparkSession
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labels)
    shared = spark.sparkContext.broadcast(vectors)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = text.buffers(batch.column(1))
            for lo, hi in text.slices(offsets):
                x = features(shared.value, *tokens(body, offsets, lo, hi)).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "quality", "x"])

    # at most most_labels rows of two numbers
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select(F.col("doc_id").cast("long"), "text", F.col("quality").cast("long"))
    found = sorted((r["doc_id"], r["quality"], bytes(r["x"])) for r in rows.mapInArrow(described, "doc_id long, quality long, x binary").collect())
    x = np.stack([np.frombuffer(r[2], np.float32) for r in found]).astype(np.float64) if found else np.zeros((0, 2 * DIM))
    return Network(x, np.array([float(r[1] > 0) for r in found]))


def scored(spark: SparkSession, network: Network, vectors: np.ndarray) -> Callable[[Column | str], Column]:
    """A function of a text column: the probability that its label is 1."""
    shared = spark.sparkContext.broadcast((network, vectors))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        net, own = shared.value
        body, offsets = text.buffers(texts)
        out = [net.score(features(own, *tokens(body, offsets, lo, hi))) for lo, hi in text.slices(offsets)]
        return pa.array(np.concatenate([np.zeros(0), *out]))

    return score


def held_out(doc_id: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) with one more column, `score`, learned from labels (doc_id, quality)."""
    vectors = word_vectors(docs)
    return docs.withColumn("score", scored(docs.sparkSession, fit(docs, labels, vectors), vectors)("text"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = tables.read(spark, sf_dir, "labels").select("doc_id", "quality")
    found = rate(docs, labels.where(F.col("doc_id").isNotNull() & ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
