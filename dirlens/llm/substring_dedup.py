"""Substring deduplication by relative Lempel-Ziv parsing against all texts of the corpus.

Method. Every text is a reference and is factored against all of them. The reference is indexed
in blocks that are the shuffle partitions of its windows' hashes:

1. anchors: the least k-word gram of each window (k < window) marks it. Equal windows have equal
   anchors, so an anchor that occurs once rules out all its windows. Only anchors, one for about
   every twelve words, are shuffled for this, and a hash of each text's words: of texts with the
   same words each is one factor, and one of them stands for all in the index.
2. index: windows under a repeated anchor are hashed and counted, with the first and the last
   place at which each occurs.
3. parse: at the first window of a text that occurs elsewhere, the factor is the longest run of words
   that goes on at a place the index has for it, the window's first or its last; the next factor
   begins at the next window that is not of the run. So a factor is the longest match among the
   indexed places, not among all places: an exhaustive list of places of hot windows would be
   unbounded. Windows across a boundary of two factors have entries of their own, so the union of the
   factors covers every repeated window and nothing else.

A text is shuffled once, by row; hot windows are counted with map-side aggregation, and anchors that
hold more than a HOT-th of all are dealt over SALTS tasks. Windows are told apart by 64-bit hashes.

Input cases. Text null, empty or shorter than a window: nothing is removed. A window that occurs
twice in one text, overlapping itself or not, is repeated. Repeated rows are two documents, so
each removes the other's words. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirlens.llm import tables, text

WINDOW, ANCHOR = 35, 12
PLACE_BITS = 24
#: Anchors with more than one part in HOT of all runs are at most HOT, which are broadcast; each is dealt over SALTS tasks.
HOT, SALTS = 1000, 64


def _least(grams: np.ndarray, width: int) -> np.ndarray:
    """Index of the leftmost least value in each run of `width` values, compared by their upper bits."""
    bits = np.uint64(max(PLACE_BITS, int(len(grams)).bit_length()))
    low = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    have = 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    return (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _anchors(window: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(rid, text) to (anchor, rid, run): run is 64 * first window + number of windows.

    A text that has a window gives one more row, of a hash of all its words and the run 0.
    """

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = batch.column(0).to_numpy()
            body, offsets = text.buffers(batch.column(1))
            for lo, hi in text.slices(offsets):
                words = text.Words(body, offsets, lo, hi)
                hashes = words.hashes()
                grams, _, of = text.run_hashes(hashes, words.bounds, k)
                many = np.maximum(words.counts() - window + 1, 0)
                total = int(many.sum())
                if not total:
                    continue
                ends = np.cumsum(many)
                number = np.arange(total) - np.repeat(ends - many, many)
                place = _least(grams, window - k + 1)[np.repeat(of[:-1], many) + number]
                at = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
                size = np.diff(np.append(at, total))
                doc = np.repeat(np.arange(lo, hi), many)[at]
                have = np.flatnonzero(many)
                whole = text.mix(text.span_hash(text.prefix(hashes), words.bounds[have], words.bounds[have + 1]))
                anchor = np.concatenate([grams[place[at]], whole])
                run = np.concatenate([number[at] * 64 + size, np.zeros(len(have), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(text.signed(anchor)), pa.array(np.concatenate([rid[doc], rid[lo:hi][have]])), pa.array(run)], names=["anchor", "rid", "run"])

    return mark


def _windows(window: int, with_rid: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(rid, text, runs, doc_id, copy) to (hash, at, whether copy is set or rid).

    at is rid + window number, modulo 2**64.
    """

    def list_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = batch.column(0).to_numpy().view(np.uint64)
            body, offsets = text.buffers(batch.column(1))
            copied = batch.column(4).is_valid().to_numpy(zero_copy_only=False)
            lists = batch.column(2)
            runs, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
            for lo, hi in text.slices(offsets):
                words = text.Words(body, offsets, lo, hi)
                own = runs[cuts[lo] : cuts[hi]]  # the run 0 has no windows
                size = own & 63
                first = own >> 6
                doc = np.repeat(np.arange(hi - lo), np.diff(cuts[lo : hi + 1]))
                number = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                doc = np.repeat(doc, size)
                start = words.bounds[doc] + number
                got = text.span_hash(text.prefix(words.hashes()), start, start + window)
                whose = rid[lo:hi][doc]
                at = pa.array(text.signed(whose + number.astype(np.uint64)))
                third = pa.array(whose.view(np.int64)) if with_rid else pa.array(copied[lo:hi][doc])
                yield pa.RecordBatch.from_arrays([pa.array(text.signed(got)), at, third], names=["hash", "at", "rid" if with_rid else "copy"])

    return list_windows


def factors(number: list[int], first: list[int], last: list[int], own: list[int], window: int) -> list[tuple[int, int, int]]:
    """(first word, words, reference place) of the greedy factors of windows in order, each the longest.

    A window stands at `own` and elsewhere at `first` or `last`, or both.
    """
    ahead: dict[int, int] = {}  # of a reference place of the window after this one: windows that go on from there
    best: list[tuple[int, int]] = []
    for k in range(len(number) - 1, -1, -1):
        if k + 1 < len(number) and number[k + 1] != number[k] + 1:
            ahead = {}
        ahead = {place: 1 + ahead.get(place + 1, 0) for place in (first[k], last[k]) if place != own[k]}
        best.append(max((n, place) for place, n in ahead.items()))
    best.reverse()
    out, k = [], 0
    while k < len(number):
        n, place = best[k]
        out.append((number[k], n - 1 + window, place))
        k += n
    return out


def _remove(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    spans = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("reference", pa.int64())]))

    def parse(words: list[bytes], rid: int, copy: int | None, marks: pa.ListScalar) -> list[tuple[int, int, int]]:
        if copy is not None:
            return [(0, len(words), copy)]
        if not marks.is_valid:
            return []
        own, first, last = (marks.values.field(c).to_numpy() for c in range(3))
        number = own - np.int64(rid)
        order = np.argsort(number)
        return factors(number[order].tolist(), first[order].tolist(), last[order].tolist(), own[order].tolist(), window)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for cut in range(0, whole.num_rows, 512):
                batch = whole.slice(cut, 512)
                n, gone, kept, parsed = [], [], [], []
                for rid, body, copy, marks in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), strict=True):
                    words = (body or "").encode().split()
                    n.append(len(words))
                    found = parse(words, rid, copy, marks)
                    if found:
                        keep = np.ones(len(words), dtype=bool)
                        for start, length, _ in found:
                            keep[start : start + length] = False
                        words = list(compress(words, keep.tolist()))
                    gone.append(n[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                    parsed.append([{"start": a, "length": b, "reference": c} for a, b, c in found])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()), pa.array(parsed, spans)], names=["doc_id", "n_words", "n_removed", "kept_text", "factors"])

    return remove


def _hits(runs: DataFrame, repeated: DataFrame) -> DataFrame:
    """runs (anchor, rid, run) with first and last of repeated (anchor, n, first, last), hot anchors by parts of their rows."""
    most = repeated.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(repeated.where(F.col("n") > most / HOT).select(F.col("anchor").alias("hot")))  # HOT rows at most
    parts = F.when(F.col("hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    sides = repeated.join(hot, F.col("anchor") == F.col("hot"), "left").select("anchor", "first", "last", F.explode(parts).alias("part"))
    part = F.when(F.col("hot").isNotNull(), F.pmod(F.hash("rid"), F.lit(SALTS))).otherwise(0)
    return runs.join(hot, F.col("anchor") == F.col("hot"), "left").select("anchor", "rid", "run", part.alias("part")).join(sides, ["anchor", "part"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text and factors of every row of docs (doc_id, text).

    A factor's reference is the row hash of the document it copies plus its first word there.
    """
    if not 0 < anchor < window <= anchor + 62:
        raise ValueError("0 < anchor < window <= anchor + 62")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("rid", F.xxhash64("doc_id", "text"))
    runs = docs.select("rid", "text").mapInArrow(_anchors(window, anchor), "anchor long, rid long, run long")
    repeated = runs.groupBy("anchor").agg(F.count("*").alias("n"), F.min("rid").alias("first"), F.max("rid").alias("last")).where("n > 1")
    hits = _hits(runs, tables.cut(repeated))
    other = F.when(F.col("run") == 0, F.when(F.col("rid") == F.col("first"), F.col("last")).otherwise(F.col("first")))
    stands = F.max(F.when(F.col("run") == 0, (F.col("rid") == F.col("first")).cast("int")))
    likely = tables.cut(hits.groupBy("rid").agg(F.collect_set("run").alias("runs"), F.max(other).alias("copy"), stands.alias("stands")))
    # doc_id goes along so that these joins and the last one read the same exchange of the texts
    texts = docs.join(likely.where("copy is null or stands = 1"), "rid").select("rid", "text", "runs", "doc_id", "copy")
    counted = texts.mapInArrow(_windows(window), "hash long, at long, copy boolean")
    index = counted.groupBy("hash").agg(F.count("*").alias("n"), F.max("copy").alias("copy"), F.min("at").alias("first"), F.max("at").alias("last")).where("n > 1 or copy").select("hash", "first", "last")
    own = texts.where("copy is null").mapInArrow(_windows(window, with_rid=True), "hash long, at long, rid long")
    marks = own.join(index, "hash").select("rid", F.struct("at", "first", "last").alias("mark")).groupBy("rid").agg(F.collect_set("mark").alias("marks"))
    found = marks.select("rid", F.lit(None).cast("long").alias("copy"), "marks").unionByName(likely.where("copy is not null").select("rid", "copy"), allowMissingColumns=True)
    kind = "doc_id long, n_words long, n_removed long, kept_text string, factors array<struct<start:int,length:int,reference:long>>"
    return docs.join(found, "rid", "left").select("doc_id", "rid", "text", "copy", "marks").mapInArrow(_remove(window), kind)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(tables.read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW} + 2)) AS i FROM w WHERE len(words) >= {WINDOW}
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(words[i:i + {WINDOW} - 1], ' ')) AS words_hash FROM starts
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY words_hash) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i, true AS is_gone FROM repeated, range(0, {WINDOW}) AS r(k)
), each AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) FILTER (WHERE is_gone IS NULL) AS words_kept, count(is_gone) AS n_removed FROM each LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(words_kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
