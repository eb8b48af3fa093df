"""Line deduplication by a segment-partition edit join.

Method. A line is cut into tau + 1 even segments; two lines within tau edits share one of them,
shifted by tau at most. Each distinct line posts its segments under (length, number, content) and
probes the substrings, chosen by length and position, that can equal a segment of a line up to
tau shorter. Lists that hold one line only are dropped by a count with map-side aggregation; the
lines of the other lists are compared in blocks of bounded size, each pair in the list of the first
segment it shares, by a banded bit-parallel edit distance. A block gives the number of links of each
line and a spanning forest of them, not its pairs. Distances and lengths are in UTF-8 bytes of the
trimmed line.

Two lines of `MIN_BYTES` or more are linked within `tau` edits, shorter ones within one, lines of
`SHORT_BYTES` or fewer only if they are equal. Linked and equal lines form classes. A class that stands in
`min_docs` or more distinct texts, wherever it stands there, is repeated: all its lines but the first go.
Equal texts count once.

The pipeline takes `drop_repeated_lines`, which leaves copies to the document-level step: copies of the text
with the first line keep theirs too, and each line has a sketch of its text, the least hash of the other lines
there; a class of which more than half of the texts share one sketch is taken for one of near copies and stays.

Input cases. Text null or empty: no lines. Lines without a word are in no class. Equal lines, ties: the
first is the least (doc_id, number). Repeated rows: each is treated alike. A null doc_id sorts last. Rows that
share an id, or have none, are told apart by a digest of their texts. Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dirlens.llm import tables, text
from dirlens.llm.groups import whole_groups

#: Edits between lines of MIN_BYTES or more; the bytes up to which only equal lines are linked; distinct texts
#: from which a line is repeated.
TAU, MIN_BYTES, SHORT_BYTES, MIN_DOCS = 2, 20, 9, 8
#: Lines of one list compared pair by pair in one block.
BLOCK = 256
#: Bits of the filter over repeated lists; it is broadcast, so its size is fixed (4 MB). Where it
#: fills up it passes more lists, and the join after it drops them.
FILTER_BITS = 25


def edits_within(a: bytes, b: bytes, tau: int) -> bool:
    """Whether the edit distance of a and b is tau at most.

    Vertical differences of the 2 * tau + 1 rows about the diagonal are kept as bits and move down
    one row with each column; the distance is followed along the band's lower edge and, once that
    reaches the last row, along the last row.
    """
    if abs(len(a) - len(b)) > tau:
        return False
    short = min(len(a), len(b))
    head = 0
    while head < short and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < short - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    m, n = len(a), len(b)
    if not m or not n:
        return max(m, n) <= tau
    if m <= tau:  # the band holds all rows: a plain table is as cheap
        row = list(range(m + 1))
        for j in range(n):
            over, row[0] = row[0], j + 1
            for i in range(m):
                over, row[i + 1] = row[i + 1], min(row[i + 1] + 1, row[i] + 1, over + (a[i] != b[j]))
        return row[m] <= tau
    width = 2 * tau + 1
    ones = (1 << width) - 1
    equal: dict[int, int] = {}
    for i, c in enumerate(a):
        equal[c] = equal.get(c, 0) | 1 << (i + tau)
    plus, minus, far = ones & ~((1 << tau) - 1), 0, tau
    stop = tau + n - (m - tau)
    for j in range(n):
        at = equal.get(b[j], 0) >> j & ones
        zero = ((((at & plus) + plus) ^ plus) | at | minus) & ones
        right_plus = (minus | ~(zero | plus)) & ones
        right_minus = zero & plus
        edge = m - 1 - j + tau  # the last row's bit
        if edge >= width - 1:
            far += not zero >> (width - 1) & 1
            if far > stop:
                return False
        else:
            far += (right_plus >> edge & 1) - (right_minus >> edge & 1)
        down = zero >> 1
        plus = (right_minus | ~(down | right_plus)) & ones
        minus = down & right_plus
    return far <= tau


def segments(length: np.ndarray, tau: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment i of tau + 1 of lines of these lengths; the later are the longer."""
    small, more = length // (tau + 1), length % (tau + 1)
    long_from = tau + 1 - more
    return i * small + np.maximum(i - long_from, 0), small + (i >= long_from)


class Lines:
    """Trimmed lines of min_bytes to max_bytes of texts lo..hi: start, end, text, number, hash."""

    def __init__(self, body: np.ndarray, offsets: np.ndarray, lo: int, hi: int, min_bytes: int, max_bytes: int | None = None):
        words = text.Words(body, offsets, lo, hi)
        self.data = words.data
        breaks = np.flatnonzero(words.data == 10) + 1
        starts = np.unique(np.concatenate([words.cuts[:-1], breaks])) if len(words.data) else np.zeros(0, np.int64)
        starts = starts[starts < len(words.data)]
        self.lines = np.diff(np.searchsorted(breaks, words.cuts, "right")) + (np.diff(words.cuts) > 0)
        doc = np.searchsorted(words.cuts, starts, "right") - 1
        number = np.searchsorted(breaks, starts, "right") - np.searchsorted(breaks, words.cuts[doc], "right")
        first = np.searchsorted(words.starts, starts)
        last = np.searchsorted(words.starts, np.append(starts[1:], len(words.data)))
        some = np.flatnonzero(last > first)
        begin, end = words.starts[first[some]], words.ends[last[some] - 1]
        keep = end - begin >= min_bytes
        if max_bytes is not None:
            keep &= end - begin <= max_bytes
        self.start, self.end, self.doc, self.number = begin[keep], end[keep], doc[some][keep], number[some][keep]
        self.sums = text.prefix(text.BYTE_VALUE[self.data])
        self.hash = text.span_hash(self.sums, self.start, self.end)

    def sketch(self) -> np.ndarray:
        """Of each line, the least mixed hash of the lines of its text that differ from it."""
        mixed = text.mix(self.hash * text.BASE)
        at = np.flatnonzero(np.diff(self.doc, prepend=-1))
        if not len(at):
            return mixed
        owner = np.cumsum(np.diff(self.doc, prepend=-1) != 0) - 1
        least = np.minimum.reduceat(mixed, at)[owner]
        rest = np.where(mixed == least, np.uint64(2**64 - 1), mixed)
        return np.where(mixed == least, np.minimum.reduceat(rest, at)[owner], least)


def _occurrences(min_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(doc_id, text, ...) to a row for each line; further columns go along."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = text.buffers(batch.column(1))
            for lo, hi in text.slices(offsets):
                x = Lines(body, offsets, lo, hi, min_bytes)
                doc = pa.array(x.doc + lo)
                more = batch.schema.names[2:]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(doc), pa.array(x.number.astype(np.int32)), pa.array(x.lines[x.doc].astype(np.int32)), pa.array(text.signed(x.hash)), pa.array(text.signed(x.sketch())), *(batch.column(c).take(doc) for c in more)],
                    names=["doc_id", "line_no", "n_lines", "line", "sketch", *more],
                )

    return find


def shifts(tau: int, i: int, shorter: int) -> range:
    """By how much segment i of a line that is so much shorter may be shifted."""
    return range(max(-i, shorter - (tau - i)), min(i, shorter + (tau - i)) + 1)


def _postings(lines: Lines, tau: int) -> Iterator[tuple[bool, int, np.ndarray, np.ndarray]]:
    """(own segment?, its number, keys, lines they belong to) for each kind of posting; one of each distinct line."""
    _, one = np.unique(lines.hash, return_index=True)
    start, length = lines.start[one], (lines.end - lines.start)[one]
    for shorter in range(tau + 1):
        other = length - shorter
        for i in range(tau + 1):
            at, size = segments(other, tau, i)
            for shift in shifts(tau, i, shorter):
                fits = np.flatnonzero((at + shift >= 0) & (at + shift + size <= length) & (other > tau))
                begin = start[fits] + at[fits] + shift
                key = text.mix(text.span_hash(lines.sums, begin, begin + size[fits]) + other[fits].astype(np.uint64) * np.uint64(64) + np.uint64(i))
                yield shorter == 0 and shift == 0, i, key, one[fits]


def _keys(tau: int, min_bytes: int, max_bytes: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = text.buffers(batch.column(0))
            for lo, hi in text.slices(offsets):
                lines = Lines(body, offsets, lo, hi, min_bytes, max_bytes)
                made = [(key, which) for _, _, key, which in _postings(lines, tau)]
                keys, which = (np.concatenate(x) for x in zip(*made, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(text.signed(keys)), pa.array(text.signed(lines.hash[which]))], names=["key", "line"])

    return post


def _filtered(tau: int, min_bytes: int, max_bytes: int | None, passing) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Postings in lists that the filter passes, with the lines' own texts."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(passing.value, dtype=np.uint8)
        low = np.uint64((1 << FILTER_BITS) - 1)
        for batch in batches:
            body, offsets = text.buffers(batch.column(0))
            for lo, hi in text.slices(offsets):
                lines = Lines(body, offsets, lo, hi, min_bytes, max_bytes)
                for own, segment, key, which in _postings(lines, tau):
                    place = (key & low).astype(np.int64)
                    hit = np.flatnonzero(bits[place >> 3] >> (place & 7).astype(np.uint8) & 1)
                    if len(hit):
                        which = which[hit]
                        texts = [lines.data[s:e].tobytes() for s, e in zip(lines.start[which].tolist(), lines.end[which].tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays([pa.array(text.signed(key[hit])), pa.array(text.signed(lines.hash[which])), pa.array(np.full(len(hit), segment if own else -1, np.int32)), pa.array(texts, pa.binary())], names=["key", "line", "own", "body"])

    return post


def first_shared(short: bytes, long: bytes, tau: int, until: int) -> int:
    """The first segment of `short`, below `until`, that stands in `long` within its shifts; else `until`."""
    small, more = divmod(len(short), tau + 1)
    at = 0
    for i in range(until):
        size = small + (i >= tau + 1 - more)
        part = short[at : at + size]
        if any(at + s >= 0 and long[at + s : at + s + size] == part for s in shifts(tau, i, len(long) - len(short))):
            return i
        at += size
    return until


def _compare(tau: int, max_bytes: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (key, i, j, block, line, own, body) in order of (key, i, j) to (a, b, n): a forest of links, and of
    each line, with b null, the number of its links found here. own: the number of the own segment, or -1.

    A pair is looked at in one list only, that of the first segment of the shorter line, or of the one with the
    lesser hash, that the other shares. Pairs of two lines of max_bytes are left out.
    """
    most = float("inf") if max_bytes is None else max_bytes

    def links(line: list[int], own: list[int], bodies: list[bytes], block: list[int], across: bool) -> Iterator[tuple[int, int]]:
        for x in (k for k, segment in enumerate(own) if segment >= 0 and len(bodies[k]) < most):
            mine, rank = bodies[x], (len(bodies[x]), line[x])
            for y, other in enumerate(bodies):
                if rank >= (len(other), line[y]) or len(other) - rank[0] > tau or across and block[x] == block[y]:
                    continue
                if first_shared(mine, other, tau, own[x]) == own[x] and edits_within(mine, other, tau):
                    yield x, y

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, 3):
            out: list[tuple[int, int | None, int]] = []
            i, j, block, line, own = (table.column(c).to_pylist() for c in range(1, 6))
            body = table.column(6)
            for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if e - s < 2 or max(own[s:e]) < 0:
                    continue
                up, many = list(range(e - s)), [0] * (e - s)

                def top(k: int, up: list[int] = up) -> int:
                    while up[k] != k:
                        up[k] = k = up[up[k]]
                    return k

                for x, y in links(line[s:e], own[s:e], body.slice(s, e - s).to_pylist(), block[s:e], i[s] != j[s]):
                    many[x] += 1
                    many[y] += 1
                    a, b = top(x), top(y)
                    if a != b:
                        up[max(a, b)] = min(a, b)
                        out.append((line[s + x], line[s + y], 0))
                out += [(line[s + k], None, n) for k, n in enumerate(many) if n]
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(3)], names=["a", "b", "n"])

    return compare


def _filter(lists: DataFrame) -> bytes:
    """A bit for each list's key, by its low bits; at most 2**FILTER_BITS / 64 rows come to the driver."""
    place = F.col("key").bitwiseAND((1 << FILTER_BITS) - 1)
    words = lists.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(key & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.int64)
    found = words.toArrow()
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.tobytes()


def edit_links(docs: DataFrame, tau: int = TAU, min_bytes: int = MIN_BYTES, max_bytes: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Of the distinct lines of docs (text) of min_bytes to max_bytes, by their hashes: pairs (a, b) that connect
    all lines within tau edits of each other, and (line, n_links), the number of such lines of each that has any.
    Two lines of max_bytes are not compared with each other."""
    posted = docs.select("text").mapInArrow(_keys(tau, min_bytes, max_bytes), "key long, line long")
    lists = posted.groupBy("key").agg(F.min("line").alias("lo"), F.max("line").alias("hi")).where("lo <> hi").select("key")
    passing = docs.sparkSession.sparkContext.broadcast(_filter(lists))
    rows = docs.select("text").mapInArrow(_filtered(tau, min_bytes, max_bytes, passing), "key long, line long, own int, body binary")
    # a line's own posting probes too, so it stands for both
    members = tables.cut(rows.groupBy("key", "line").agg(F.max("own").alias("own"), F.min("body").alias("body")))
    size = members.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("most")).where("n > 1 and most >= 0").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    own = members.join(size, "key").withColumn("block", F.pmod(F.hash("line"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = own.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "line", "own", "body").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found = tables.cut(dealt.mapInArrow(_compare(tau, max_bytes), "a long, b long, n long"))
    degree = found.where("b is null").groupBy(F.col("a").alias("line")).agg(F.sum("n").alias("n_links"))
    return found.where("b is not null").select("a", "b").distinct(), degree


def digest() -> Column:
    """A 128-bit digest of a text: rows that share an id, or have none, are told apart by it."""
    return F.unhex(F.md5("text"))


def links_of_all(docs: DataFrame, tau: int = TAU) -> tuple[DataFrame, DataFrame]:
    """edit_links of the distinct lines of every length: pairs (a, b) and (line, n_links)."""
    long, short = edit_links(docs, tau), edit_links(docs, 1, SHORT_BYTES + 1, MIN_BYTES)
    return long[0].unionAll(short[0]).distinct(), long[1].unionAll(short[1]).groupBy("line").agg(F.sum("n_links").alias("n_links"))


def line_classes(docs: DataFrame, tau: int = TAU, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row for each line with a word: doc_id, line_no, class_doc_id, class_line_no, n_links, n_docs, removed."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    links, degree = links_of_all(docs, tau)
    named = tables.components(tables.cut(links)).withColumnRenamed("id", "line").join(degree, "line")
    found = docs.withColumn("copy", digest()).mapInArrow(_occurrences(1), "doc_id long, line_no int, n_lines int, line long, sketch long, copy binary")
    lines = tables.cut(found.join(named, "line", "left").select("doc_id", "copy", "line_no", F.coalesce("component", "line").alias("class"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("d"), "line_no")
    texts = lines.groupBy("class", "copy").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    classes = texts.groupBy("class").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n"), F.min("first").alias("first"))
    out = lines.join(classes.where("n > 1"), "class", "left")
    first_doc = F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.d"))
    first_line = F.when(F.col("first").isNull(), F.col("line_no")).otherwise(F.col("first.line_no"))
    own = F.col("doc_id").eqNullSafe(first_doc) & (F.col("line_no") == first_line)
    n_docs = F.coalesce("n_docs", F.lit(1)).cast("long")
    return out.select("doc_id", "line_no", first_doc.alias("class_doc_id"), first_line.alias("class_line_no"), "n_links", n_docs.alias("n_docs"), ((n_docs >= min_docs) & ~own).alias("removed"))


def repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, digest of the text (copy) and line_no of the lines of docs (doc_id, text) to remove as repeated."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    label = tables.components(tables.cut(links_of_all(docs)[0]))
    found = docs.withColumn("copy", digest()).mapInArrow(_occurrences(1), "doc_id long, line_no int, n_lines int, line long, sketch long, copy binary")
    lines = tables.cut(found.join(label.withColumnRenamed("id", "line"), "line", "left").select("doc_id", "line_no", "copy", "sketch", F.coalesce("component", "line").alias("class")))
    texts = lines.groupBy("class", "copy").agg(F.min("sketch").alias("sketch"), F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "line_no")).alias("first"))
    alike = texts.groupBy("class", "sketch").agg(F.count("*").alias("n"), F.min(F.struct("first", "copy")).alias("least"))
    classes = alike.groupBy("class").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.min("least").alias("least")).where((F.col("n") >= min_docs) & (2 * F.col("most") <= F.col("n")))
    own = (F.col("copy") == F.col("least.copy")) & (F.col("line_no") == F.col("least.first.line_no"))
    return lines.join(classes, "class").where(~own).select("doc_id", "copy", "line_no")


def drop_repeated_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs (doc_id, text, ...) without repeated lines; every other byte of a text stays as it is.

    A document left without a word goes; one that had none before stays.
    """
    return _without(docs, repeated_lines(docs, min_docs))


def _without(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """docs without the lines of removed (doc_id, copy, line_no)."""
    gone = removed.groupBy(F.col("doc_id").alias("_id"), F.col("copy").alias("_copy")).agg(F.collect_set("line_no").alias("gone"))
    # the row goes along as one column, so that its names don't meet ours
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), digest().alias("copy"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy")), "left")
    kept = F.array_join(F.filter(F.split("row.text", "\n"), lambda _, i: ~F.array_contains("gone", i)), "\n")
    new = joined.withColumn("new", F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(kept))
    left = new.where(F.col("gone").isNull() | F.col("new").rlike(r"[^ \t\n\x0B\f\r]"))
    return left.select(*[F.col("new").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(tables.read(spark, sf_dir, "documents"))


SQL = f"""
WITH RECURSIVE parts AS (
  SELECT doc_id, md5(text) AS copy, string_split(text, chr(10)) AS ls FROM documents WHERE text <> ''
), raw AS (
  SELECT doc_id, copy, unnest(ls) AS l, generate_subscripts(ls, 1) - 1 AS line_no FROM parts
), lines AS (
  SELECT doc_id, copy, line_no, trim(l, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM raw
), worded AS (
  SELECT * FROM lines WHERE line <> ''
), one AS (
  SELECT DISTINCT line, strlen(line) AS n FROM worded WHERE strlen(line) > {SHORT_BYTES}
), links AS (
  SELECT a.line AS a, b.line AS b FROM one a JOIN one b
  ON b.n BETWEEN a.n - {TAU} AND a.n + {TAU} AND a.line <> b.line
  WHERE levenshtein(a.line, b.line) <= CASE WHEN least(a.n, b.n) >= {MIN_BYTES} THEN {TAU} ELSE 1 END
), reach AS (
  SELECT a AS line, a AS other FROM links UNION SELECT r.line, l.b FROM reach r JOIN links l ON r.other = l.a
), label AS (
  SELECT line, min(other) AS class FROM reach GROUP BY line
), degree AS (
  SELECT a AS line, count(*) AS n_links FROM links GROUP BY a
), named AS (
  SELECT g.doc_id, g.copy, g.line_no, coalesce(l.class, g.line) AS class, coalesce(d.n_links, 0) AS n_links
  FROM worded g LEFT JOIN label l USING (line) LEFT JOIN degree d USING (line)
), classes AS (
  SELECT class, count(DISTINCT copy) AS n_docs, min((doc_id, line_no)) AS first FROM named GROUP BY class
)
SELECT n.doc_id, CAST(n.line_no AS INTEGER) AS line_no, c.first[1] AS class_doc_id, CAST(c.first[2] AS INTEGER) AS class_line_no,
  CAST(n.n_links AS BIGINT) AS n_links, CAST(c.n_docs AS BIGINT) AS n_docs,
  c.n_docs >= {MIN_DOCS} AND (n.doc_id, n.line_no) <> c.first AS removed
FROM named n JOIN classes c USING (class)
"""
