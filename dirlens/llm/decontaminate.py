"""Benchmark decontamination: a BM25 inverted index of test items, queried by every training passage.

Method. The test items are indexed once, as postings: for each term its items and BM25 weights, in order
of the items' own scores, and for each block of `BLOCK` items in that order the term's largest weight there
(block maximum). Each text is cut into passages that overlap so that any run of words as long as the
longest item lies within one. A passage is a query, searched by block-max WAND, a batch of passages at a
time: its terms are taken by rising largest weight, and the pivot is the first at which the sum of these
reaches the lowest threshold of any item. An item must have the pivot or a later term, so only the lists of
these are read whole. Their block maxima and the sum before the pivot bound the scores in a block; where that
reaches the block's lowest threshold the block maxima of the other terms are looked up, and where the bound
still does the postings in the block are added up. Skipping is safe: all items at or
above the threshold, a share of the item's own score, are retrieved.

Retrieved items are verified on the passage's words: the shares of the five-word shingles of the
item's question and of its answer that occur there must both reach the overlap, or that of the whole
item must, so that a changed word in a short answer hides no item. The answer is the
item's last sentence, or its last third where it has one sentence; a part of fewer than five words
is one shingle.

Words are runs of characters other than ASCII marks, in lower case. The index is broadcast: its size is linear
in the words of at most `ITEMS` items, and more are taken in several passes with an index each.

Input cases. Text null, empty or without a word: no match. Items null or without a word match
nothing; equal items all match. Repeated rows give repeated rows. Empty tables give no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirlens.llm import tables, text

K1, B = 1.2, 0.75
RETRIEVE, OVERLAP, SHINGLE = 0.6, 0.8, 5
ITEMS, BLOCK = 20_000, 8
#: Sums by passage and block that are held at a time.
ENTRIES = 1 << 20
MATCHES = "array<struct<item_id:long,score:double,question:double,answer:double,whole:double>>"


def parts(item: str) -> tuple[str, str]:
    """Question and answer of an item."""
    sentences = re.split(r"(?<=[.?!])\s+", item.strip())
    if len(sentences) > 1:
        return " ".join(sentences[:-1]), sentences[-1]
    words = item.split()
    at = len(words) - max(1, len(words) // 3)
    return " ".join(words[:at]), " ".join(words[at:])


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    body, offsets = text.buffers(pc.utf8_lower(pa.array(texts, pa.string())))
    words = text.Words(body, offsets, 0, len(texts), apart=text.IS_MARK)
    return words.hashes(), words.bounds


def shingles(words: np.ndarray) -> tuple[int, np.ndarray]:
    """Words to a shingle, SHINGLE or all if there are fewer, and the distinct shingles."""
    n = min(SHINGLE, len(words))
    return n, np.unique(text.run_hashes(words, np.array([0, len(words)]), n)[0]) if n else np.zeros(0, np.uint64)


def share(part: tuple[int, np.ndarray], words: np.ndarray) -> float:
    """Share of the part's shingles that occur among words; 1 for a part without words."""
    n, own = part
    return float(np.isin(own, text.run_hashes(words, np.array([0, len(words)]), n)[0]).mean()) if n else 1.0


class Index:
    def __init__(self, items: list[tuple[int, str]]):
        hashes, bounds = word_hashes([x for _, x in items])
        lengths = np.diff(bounds)
        good = np.flatnonzero(lengths)
        self.longest = int(lengths.max()) if len(good) else 1
        self.terms = np.unique(hashes)
        if not len(good):
            self.ids = np.zeros(0, np.int64)
            return
        term = np.searchsorted(self.terms, hashes)
        item = np.repeat(np.arange(len(items)), lengths)
        pair, count = np.unique(item * len(self.terms) + term, return_counts=True)
        item, term = pair // len(self.terms), pair % len(self.terms)
        idf = np.log1p((len(good) - np.bincount(term) + 0.5) / (np.bincount(term) + 0.5))
        weight = idf[term] * count * (K1 + 1) / (count + K1 * (1 - B + B * lengths[item] / lengths[good].mean()))
        own = np.bincount(item, weight, minlength=len(items))
        order = good[np.argsort(own[good], kind="stable")]
        place = np.full(len(items), -1)
        place[order] = np.arange(len(order))
        self.ids = np.array([items[i][0] for i in order], dtype=np.int64)
        self.own = own[order]
        place = place[item]
        by_place = np.lexsort((place, term))
        self.places, self.weights = place[by_place].astype(np.int32), weight[by_place].astype(np.float32)
        blocks = -(-len(order) // BLOCK)
        entry = term[by_place] * blocks + self.places // BLOCK
        at = np.flatnonzero(np.diff(entry, prepend=-1))
        # of each (term, block) that occurs: its number, its postings from..to, its maximum; and the entries of each term
        self.blocks, self.entry, self.postings = blocks, entry[at], np.append(at, len(entry))
        self.maxima, self.block_of = np.maximum.reduceat(self.weights, at), self.entry % blocks
        self.lists = np.searchsorted(self.entry, np.arange(len(self.terms) + 1) * blocks)
        self.largest = np.maximum.reduceat(self.maxima, self.lists[:-1])
        self.lowest = self.own[np.arange(blocks) * BLOCK]
        pieces = [parts(items[i][1]) for i in order]
        self.question = [shingles(word_hashes([q])[0]) for q, _ in pieces]
        self.answer = [shingles(word_hashes([a])[0]) for _, a in pieces]
        self.whole = [shingles(hashes[bounds[i] : bounds[i + 1]]) for i in order]

    def held(self, term: np.ndarray, block: np.ndarray) -> np.ndarray:
        """The entries of these (term, block), -1 for those that don't occur."""
        wanted = term * self.blocks + block
        at = np.minimum(np.searchsorted(self.entry, wanted), len(self.entry) - 1)
        return np.where(self.entry[at] == wanted, at, -1)

    def retrieved(self, term: np.ndarray, group: np.ndarray, start: np.ndarray, end: np.ndarray, retrieve: float) -> Iterator[tuple[int, int, float]]:
        """(passage, place of an item, its share of its own score) at or above the threshold. term: those of each passage, start..end."""
        lowest = retrieve * (1 - 1e-5) * self.lowest
        order = np.lexsort((self.largest[term], group))
        below = np.cumsum(self.largest[term[order]], dtype=np.float64)
        below -= np.repeat(np.append(0.0, below)[start], end - start)
        weak = np.maximum.reduceat(np.where(below < lowest[0], below, 0.0), start)
        strong = order[below >= lowest[0]]  # from the pivot on
        size = self.lists[term[strong] + 1] - self.lists[term[strong]]
        most = max(1, ENTRIES // self.blocks)
        for first in range(0, len(start), most):  # so many passages that their sums by block stay bounded
            s, e = np.searchsorted(group[strong], [first, first + most])
            part, n = strong[s:e], size[s:e]
            entry = np.arange(n.sum()) + np.repeat(self.lists[term[part]] - np.cumsum(n) + n, n)
            count = min(most, len(start) - first)
            sums = np.bincount(np.repeat((group[part] - first) * self.blocks, n) + self.block_of[entry], self.maxima[entry], minlength=count * self.blocks).reshape(count, self.blocks)
            g, block = np.nonzero((sums > 0) & (sums + weak[first : first + count, None] >= lowest))
            if not len(g):
                continue
            g += first
            many = end[g] - start[g]
            begin = np.cumsum(many) - many
            own = term[np.arange(many.sum()) + np.repeat(start[g] - begin, many)]
            found = self.held(own, np.repeat(block, many))
            bound = np.add.reduceat(np.where(found >= 0, self.maxima[found], 0), begin, dtype=np.float64)
            good = bound >= lowest[block]
            if not good.any():
                continue
            found = found[np.repeat(good, many)]
            at = np.repeat(np.arange(good.sum()), many[good])[found >= 0]
            found = found[found >= 0]
            n = self.postings[found + 1] - self.postings[found]
            post = np.arange(n.sum()) + np.repeat(self.postings[found] - np.cumsum(n) + n, n)
            g, block = g[good], block[good]
            score = np.bincount(np.repeat(at, n) * BLOCK + self.places[post] % BLOCK, self.weights[post], minlength=len(g) * BLOCK)
            place = (block[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            inside = place < len(self.own)
            score[inside] /= self.own[place[inside]]
            hit = np.flatnonzero(inside & (score >= retrieve))
            yield from zip(g[hit // BLOCK].tolist(), place[hit].tolist(), score[hit].tolist(), strict=True)

    def search(self, words: np.ndarray, bounds: np.ndarray, retrieve: float, overlap: float) -> list[tuple[int, int, float, float, float, float]]:
        """(text, item id, score, question, answer and whole overlap) of the best passage for each."""
        if not len(self.ids) or not len(words):
            return []
        counts = np.diff(bounds)
        step = self.longest
        chunks = np.maximum(1, -(-counts // step))
        base = np.cumsum(chunks) - chunks
        doc = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(words)) - np.repeat(bounds[:-1], counts)
        term = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        known = np.flatnonzero(self.terms[term] == words)
        chunk = within[known] // step
        passage = base[doc[known]] + chunk
        back = chunk > 0
        key = np.unique(np.concatenate([passage * len(self.terms) + term[known], (passage[back] - 1) * len(self.terms) + term[known][back]]))
        if not len(key):
            return []
        passage, term = key // len(self.terms), key % len(self.terms)
        at_passage = np.flatnonzero(np.diff(passage, prepend=-1))
        end = np.append(at_passage[1:], len(passage))
        group = np.repeat(np.arange(len(at_passage)), end - at_passage)
        best: dict[tuple[int, int], tuple[float, float, float, float]] = {}
        for g, i, score in self.retrieved(term, group, at_passage, end, retrieve):
            at = passage[at_passage[g]]
            d = int(np.searchsorted(base, at, "right")) - 1
            first = int(bounds[d] + (at - base[d]) * step)
            own_words = words[first : min(first + 2 * step, int(bounds[d + 1]))]
            question, answer, whole = (share(x, own_words) for x in (self.question[i], self.answer[i], self.whole[i]))
            if min(question, answer) >= overlap or whole >= overlap:
                found = (round(min(1.0, score), 6), question, answer, whole)
                best[d, int(self.ids[i])] = max(best.get((d, int(self.ids[i])), found), found)
        return [(d, i, *x) for (d, i), x in sorted(best.items())]


def indexes(items: DataFrame) -> list[Index]:
    """One index for each ITEMS items of (item_id, text), in order of item_id."""
    rows = items.where("text is not null and item_id is not null").select(F.col("item_id").cast("long"), "text").orderBy("item_id", "text").toLocalIterator()
    out, held = [], []
    for row in rows:
        held.append((row[0], row[1]))
        if len(held) == ITEMS:
            out.append(Index(held))
            held = []
    return [*out, Index(held)] if held or not out else out


def matches(spark: SparkSession, index: Index, retrieve: float = RETRIEVE, overlap: float = OVERLAP) -> Callable[[Column | str], Column]:
    """A function of a text column: array of item_id, score, question, answer and whole, by item_id."""
    shared = spark.sparkContext.broadcast(index)
    kind = pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64()), ("whole", pa.float64())])

    @F.arrow_udf(MATCHES)
    def find(texts: pa.Array) -> pa.Array:
        body, offsets = text.buffers(pc.utf8_lower(texts))
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        for lo, hi in text.slices(offsets):
            words = text.Words(body, offsets, lo, hi, apart=text.IS_MARK)
            for d, item, score, question, answer, whole in shared.value.search(words.hashes(), words.bounds, retrieve, overlap):
                out[lo + d].append({"item_id": item, "score": score, "question": question, "answer": answer, "whole": whole})
        return pa.array(out, pa.list_(kind))

    return find


def leaks(docs: DataFrame, items: DataFrame, retrieve: float = RETRIEVE, overlap: float = OVERLAP) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap and item_overlap of every leak of items in docs."""
    each = [docs.select("doc_id", F.explode(matches(docs.sparkSession, x, retrieve, overlap)("text")).alias("m")) for x in indexes(items)]
    found = reduce(DataFrame.unionAll, each)
    return found.select("doc_id", "m.item_id", "m.score", F.col("m.question").alias("question_overlap"), F.col("m.answer").alias("answer_overlap"), F.col("m.whole").alias("item_overlap"))


def drop_leaks(docs: DataFrame, items: DataFrame, retrieve: float = RETRIEVE, overlap: float = OVERLAP) -> DataFrame:
    """docs (text, ...) without the rows that hold a leak of any item."""
    for x in indexes(items):
        docs = docs.where(F.size(matches(docs.sparkSession, x, retrieve, overlap)("text")) == 0)
    return docs


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(tables.read(spark, sf_dir, "documents"), tables.read(spark, sf_dir, "benchmark"))
