"""MinHash near-duplicate detection by a signature-coordinate inverted join.

Method. Every distinct shingle set gets a signature of `coordinates` minima and is posted under
each (coordinate, value) pair of a prefix of them. The prefix is so long that a pair at the
threshold collides in none of it with a probability below 1e-6, and `matches` is the largest
number of equal coordinates that such a pair misses with a probability below 1e-6.

1. skip: each posting list offers its smallest member as pivot, collisions with a pivot are
   counted, and each set is confirmed against the pivot it collides with most. A large group of
   copies is joined to its pivot here, and its lists are done.
2. merge: in lists whose members are still in two or more components, pairs with `matches` equal
   coordinates join components into clusters. Members of lists larger than a block meet in blocks of
   their list first; those still apart are posted anew, by all coordinates, each under those that are
   the rarest among them: so many that any two with `matches` equal ones share one (see `rarest`).
   So texts that have a passage in common and little else are not compared with each other: of
   their coordinates too few are those of another component, and they are not even posted.
3. confirm: the members of each cluster meet, with their texts, and pairs at the threshold join
   components.

Both deal their members into blocks of bounded size, first inside blocks and then, dealt again by
component, across those that are not of one component yet (see `joined`); 2 does the latter in the lists
of rarest coordinates. A block gives a spanning
forest of pairs of component names. So a group of near copies of which a block's worth stays apart
is sent a fixed number of times; only members of one cluster that stay unlinked in great numbers meet
block by block. Every link is confirmed on the full shingle sets. Sets are told apart by 64-bit
hashes.

Input cases. Text null, empty or without a word: an empty set, linked with nothing. Fewer words
than a shingle: the whole sequence is the one shingle. Repeated rows: both stay in the result,
in one component. A null id takes part, but never names a component; if a component has no other
id its name is null and its rows are kept. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dirlens.llm import tables, text
from dirlens.llm.groups import whole_groups

COORDINATES = 32
#: Members of a list and members of a cluster compared pair by pair in one block; members compared
#: with one pivot in one task; shingles to a matrix product.
BLOCK, TEXTS, STAR, COLUMNS = 1024, 256, 512, 4096
MISS = 1e-6
#: Places of coordinate values, a bit each in a broadcast (4 MB), and places to a slice.
PLACE_BITS, SLICE = 25, 1 << 17
#: Members whose ids are broadcast, 16 bytes each.
FEW_MEMBERS = 250_000


def matches_needed(coordinates: int, num: int, den: int, miss: float = MISS) -> int:
    """Largest t with P(Binomial(coordinates, num/den) < t) <= miss, at least 1."""
    p, total, t = num / den, 0.0, 0
    while t < coordinates:
        total += math.comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if total > miss:
            break
        t += 1
    return max(1, t)


def prefix_needed(num: int, den: int, miss: float = MISS) -> int:
    """Least p with (1 - num/den)**p <= miss."""
    return 1 if num >= den else math.ceil(math.log(miss) / math.log(1 - num / den))


def shingle_sets(words: text.Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, concatenated, and their bounds."""
    hashes = words.hashes()
    sums = text.prefix(hashes)
    starts, bounds = text.runs(words.bounds, n)
    got = text.span_hash(sums, starts, starts + n)
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        whole = text.span_hash(sums, words.bounds[short], words.bounds[short + 1])
        got = np.insert(got, bounds[short], whole)
        size = np.diff(bounds)
        size[short] = 1
        bounds = np.concatenate([[0], np.cumsum(size)])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        got[a:b].sort()
    new = np.ones(len(got), dtype=bool)
    new[1:] = got[1:] != got[:-1]
    new[bounds[:-1][np.diff(bounds) > 0]] = True
    kept = np.concatenate([[0], np.cumsum(new)])
    return got[new], kept[bounds]


def signatures(sets: np.ndarray, at: np.ndarray, coordinates: int) -> np.ndarray:
    """Minima of the sets that start at `at` and fill `sets`, one row each."""
    a = np.random.default_rng(7).integers(1, 1 << 63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((len(at), coordinates), dtype=np.uint32)
    for k in range(coordinates if len(at) else 0):
        out[:, k] = np.minimum.reduceat((sets * a[k] >> np.uint64(32)).astype(np.uint32), at)
    return out


def _signer(n: int, coordinates: int, prefix: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = text.buffers(batch.column(2))
            for lo, hi in text.slices(offsets):
                sets, bounds = shingle_sets(text.Words(body, offsets, lo, hi, lower=True), n)
                size = np.diff(bounds)
                some = size > 0
                at = bounds[:-1][some]
                signature = signatures(sets, at, coordinates)
                node = np.zeros(hi - lo, dtype=np.uint64)
                if len(at):
                    node[some] = text.mix(np.add.reduceat(text.mix(sets * text.BASE), at) + size[some].astype(np.uint64))
                posts = text.mix((signature[:, :prefix].astype(np.uint64) << np.uint64(8)) | np.arange(prefix, dtype=np.uint64))
                many = np.zeros(hi - lo + 1, dtype=np.int32)
                many[1:] = np.cumsum(np.where(some, prefix, 0))
                width = np.zeros(hi - lo + 1, dtype=np.int32)
                width[1:] = np.cumsum(np.where(some, 4 * coordinates, 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array(size.astype(np.int64)),
                        pa.array(text.signed(node), mask=~some),
                        pa.ListArray.from_arrays(pa.array(many), pa.array(text.signed(posts.ravel()))),
                        pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(width), pa.py_buffer(signature.tobytes())]),
                    ],
                    names=["doc_id", "rid", "n_shingles", "node", "posts", "signature"],
                )

    return sign


def _confirmer(n: int, num: int, den: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (a, salt, b, text) in order, b null first: that row holds the set of a itself."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            body, offsets = text.buffers(batch.column(3))
            a, b = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            left, right = [], []
            for lo, hi in text.slices(offsets):
                sets, bounds = shingle_sets(text.Words(body, offsets, lo, hi, lower=True), n)
                for i in range(lo, hi):
                    mine = sets[bounds[i - lo] : bounds[i - lo + 1]]
                    if b[i] is None:
                        centre, own = a[i], mine.copy()
                    elif centre == a[i] and len(own) and len(mine):
                        at = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                        both = int(np.count_nonzero(own[at] == mine))
                        if den * both >= num * (len(own) + len(mine) - both):
                            left.append(a[i])
                            right.append(b[i])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return confirm


def confirmed(docs: DataFrame, pairs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of row ids whose full sets reach the threshold.

    Texts travel to their pivot's task, and a pivot with many partners is dealt over several.
    """
    size = pairs.groupBy("a").count()
    member = pairs.join(size, "a").select("a", F.pmod(F.hash("b"), F.ceil(F.col("count") / STAR).cast("int")).alias("salt"), "b")
    need = member.select("a", "salt", "b", F.col("b").alias("rid")).unionByName(member.select("a", "salt", F.lit(None).cast("long").alias("b"), F.col("a").alias("rid")).distinct())
    rows = docs.join(need.hint("merge"), "rid").select("a", "salt", "b", "text")
    dealt = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return dealt.mapInArrow(_confirmer(n, num, den), "a long, b long")


def spanning(component: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of components that join all those with a True entry between their items in the square matrix `linked`."""
    names, label = np.unique(component, return_inverse=True)
    x, y = np.nonzero(np.triu(linked, 1) & (label[:, None] != label))
    low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
    up = list(range(len(names)))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    out = []
    for pair in np.unique(low * len(names) + high).tolist():
        i, j = top(pair // len(names)), top(pair % len(names))
        if i != j:
            up[max(i, j)] = min(i, j)
            out.append((int(names[i]), int(names[j])))
    return out


def matching(signatures: np.ndarray, least: int) -> np.ndarray:
    """Which rows have `least` equal coordinates or more."""
    equal = np.zeros((len(signatures), len(signatures)), dtype=np.uint8)
    for column in signatures.T:
        equal += column[:, None] == column
    return equal >= least


def similar(sets: np.ndarray, bounds: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which of the sets reach the threshold, by counts of common members from products of 0/1 matrices."""
    size = np.diff(bounds)
    member = np.unique(sets, return_inverse=True)[1]
    shared = np.bincount(member) > 1
    column = np.cumsum(shared)[member] - 1
    item = np.repeat(np.arange(len(size)), size)[shared[member]]
    column = column[shared[member]]
    order = np.argsort(column, kind="stable")
    item, column = item[order], column[order]
    common = np.zeros((len(size), len(size)), dtype=np.float64)
    for lo in range(0, int(shared.sum()), COLUMNS):
        s, e = np.searchsorted(column, [lo, lo + COLUMNS])
        held = np.zeros((len(size), COLUMNS), dtype=np.float32)
        held[item[s:e], column[s:e] - lo] = 1
        common += held @ held.T
    return den * common >= num * (size[:, None] + size - common)


def _in_groups(pairs_of: Callable[[np.ndarray, pa.Array], list[tuple[int, int]]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (key, i, j, component, payload) in order of (key, i, j) to pairs of components of each (key, i, j)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, 3):
            component, payload = table.column(3).to_numpy(), table.column(4).combine_chunks()
            found: list[tuple[int, int]] = []
            for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if e - s > 1 and component[s:e].min() != component[s:e].max():
                    found += pairs_of(component[s:e], payload.slice(s, e - s))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    return work


def _by_signature(coordinates: int, least: int) -> Callable[[np.ndarray, pa.Array], list[tuple[int, int]]]:
    return lambda component, payload: spanning(component, matching(text.buffers(payload)[0].view(np.uint32).reshape(-1, coordinates), least))


def _by_text(n: int, num: int, den: int) -> Callable[[np.ndarray, pa.Array], list[tuple[int, int]]]:
    def pairs(component: np.ndarray, payload: pa.Array) -> list[tuple[int, int]]:
        body, offsets = text.buffers(payload)
        return spanning(component, similar(*shingle_sets(text.Words(body, offsets, 0, len(payload), lower=True), n), num, den))

    return pairs


def _coordinates(coordinates: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (v, component, signature) to (v, component, keys): a key for each coordinate and its value."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = text.buffers(batch.column(2))[0].view(np.uint32).reshape(-1, coordinates)
            keys = (values.astype(np.int64) << 8) | np.arange(coordinates)
            many = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * coordinates)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(many, pa.array(keys.ravel()))], names=["v", "component", "keys"])

    return work


def places(keys: np.ndarray) -> np.ndarray:
    """A place below 2**PLACE_BITS for each key."""
    return (text.mix(keys.astype(np.int64, copy=False).view(np.uint64)) >> np.uint64(64 - PLACE_BITS)).astype(np.int64)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (v, component, keys) to (slice, body): for each place its least and greatest component and its number of keys."""
    for batch in batches:
        place = places(batch.column(2).flatten().to_numpy())
        if not len(place):
            continue
        component = np.repeat(batch.column(1).to_numpy(), batch.column(2).value_lengths().to_numpy())
        order = np.argsort(place, kind="stable")
        place, component = place[order], component[order]
        at = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        rows = np.stack([place[at], np.minimum.reduceat(component, at), np.maximum.reduceat(component, at), np.diff(np.append(at, len(place)))], axis=1)
        part, first = np.unique(place[at] // SLICE, return_index=True)
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([x.tobytes() for x in np.split(rows, first[1:])], pa.binary())], names=["slice", "body"])


def _summed(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of `_gathered` in order of slice to (slice, bits, often): a bit for each place with two components, and those with more than `size` keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, 1):
            names, body = table.column(0).to_numpy(), table.column(1).combine_chunks()
            for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                rows = text.buffers(body.slice(s, e - s))[0].view(np.int64).reshape(-1, 4)
                low, high, n = np.full(SLICE, np.iinfo(np.int64).max), np.full(SLICE, np.iinfo(np.int64).min), np.zeros(SLICE, dtype=np.int64)
                place = rows[:, 0] - names[s] * SLICE
                np.minimum.at(low, place, rows[:, 1])
                np.maximum.at(high, place, rows[:, 2])
                np.add.at(n, place, rows[:, 3])
                apart = low < high
                many = np.flatnonzero(apart & (n > size))
                often = np.stack([many + names[s] * SLICE, n[many]], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([names[s]]), pa.array([np.packbits(apart, bitorder="little").tobytes()]), pa.array([often.tobytes()], pa.binary())], names=["slice", "bits", "often"])

    return work


def _counted(own: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For own (v, component, keys): bits of the places with two components; those with more than `size` keys, sorted, and how many."""
    parts = own.mapInArrow(_gathered, "slice long, body binary").repartition("slice").sortWithinPartitions("slice")
    found = parts.mapInArrow(_summed(size), "slice long, bits binary, often binary").toArrow()
    bits = np.zeros(((1 << PLACE_BITS) // SLICE, SLICE // 8), dtype=np.uint8)
    for part, body in zip(found["slice"].to_pylist(), found["bits"].to_pylist(), strict=True):
        bits[part] = np.frombuffer(body, dtype=np.uint8)
    often = np.frombuffer(b"".join(found["often"].to_pylist()), dtype=np.int64).reshape(-1, 2)
    often = often[np.argsort(often[:, 0])]
    return bits.ravel(), often[:, 0].copy(), often[:, 1].copy()


def apart(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether each key's place has members of two components."""
    place = places(keys)
    return (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def rarest_keys(keys: np.ndarray, often: np.ndarray, counts: np.ndarray, most: int, names: np.ndarray | None = None, useful: np.ndarray | None = None) -> np.ndarray:
    """Of each row of keys the first `most` by (count, key); keys whose names are not in the sorted `often` count 0, those not useful less.

    names: by default the keys themselves.
    """
    names = keys if names is None else names
    count = np.zeros(keys.shape, dtype=np.int64)
    if len(often):
        at = np.minimum(np.searchsorted(often, names), len(often) - 1)
        count = np.where(often[at] == names, counts[at], 0)
    if useful is not None:
        count[~useful] = -1
    order = np.lexsort((keys, count), axis=1)[:, :most]
    return np.take_along_axis(keys, order, axis=1)


def rarest(members: DataFrame, signature: DataFrame, coordinates: int, least: int, size: int) -> DataFrame:
    """(key, v, component): members (v, component) under their rarest coordinates. signature: (v, payload).

    Of two signatures with `least` equal keys, each has coordinates - least others. So in any one order
    of all keys, the first coordinates - least + 1 of each have a common one. The order here begins with the keys that
    members of one component alone have. Such a key joins nothing, so it is not posted; and a member with fewer than
    `least` other keys matches none of another component and is not posted at all. Then comes the number of members that
    have the key, as far as they are more than a block.

    Components and members are counted by place, a hash of the key: keys that share a place are taken for one, which can
    only post more. A task sends one row for each of the slices of places that a batch of its members has; the driver gets
    a bit for each place, and the counts above a block.
    """
    own = tables.cut(members.join(signature, "v").select("v", "component", "payload").mapInArrow(_coordinates(coordinates), "v long, component long, keys array<long>"))
    shared = members.sparkSession.sparkContext.broadcast(_counted(own, size))
    most = coordinates - least + 1

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, often, counts = shared.value
        for batch in batches:
            keys = batch.column(2).flatten().to_numpy().reshape(-1, coordinates)
            useful = apart(keys, bits)
            some = np.flatnonzero(useful.sum(axis=1) >= least)
            keys = rarest_keys(keys[some], often, counts, most, places(keys[some]), useful[some])
            useful = apart(keys, bits)
            many = pa.array(np.concatenate([[0], np.cumsum(useful.sum(axis=1))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), batch.column(1).take(pa.array(some)), pa.ListArray.from_arrays(many, pa.array(keys[useful]))], names=["v", "component", "keys"])

    return own.mapInArrow(first, "v long, component long, keys array<long>").select(F.explode("keys").alias("key"), "v", "component")


def _shingled(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (v, component, text) to (v, component, keys): the shingles of each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, offsets = text.buffers(batch.column(2))
            for lo, hi in text.slices(offsets):
                sets, bounds = shingle_sets(text.Words(body, offsets, lo, hi, lower=True), n)
                keys = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(text.signed(sets)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), keys], names=["v", "component", "keys"])

    return work


def linkable(members: DataFrame, texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """members (key, v, component) without those that can't be linked with one of another component. texts: (v, payload).

    Two linked sets have num / den of each in common. So a member that has fewer shingles than that which a member of
    another component has too, in any key, is linked with none of them. Shingles are told apart by place, as in `rarest`.
    """
    some = tables.cut(members.select("v", "component").distinct())
    # few are sent to the texts, which then need no shuffle
    own = (F.broadcast(some) if some.count() <= FEW_MEMBERS else some).join(texts, "v").select("v", "component", "payload")
    own = tables.cut(own.mapInArrow(_shingled(n), "v long, component long, keys array<long>"))
    shared = members.sparkSession.sparkContext.broadcast(_counted(own, 1 << 62)[0])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(2).value_lengths().to_numpy()
            common = np.bincount(np.repeat(np.arange(len(size)), size), apart(batch.column(2).flatten().to_numpy(), shared.value), len(size))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(den * common >= num * size))], names=["v"])

    return tables.cut(members.join(own.mapInArrow(kept, "v long"), "v", "left_semi"))


def joined(
    members: DataFrame,
    payload: DataFrame,
    size: int,
    pairs_of: Callable[[np.ndarray, pa.Array], list[tuple[int, int]]],
    finer: Callable[[DataFrame], DataFrame] | None = None,
    fewer: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(id, component): what `pairs_of` makes of the components within the keys of members (key, v, component).

    As tables.components: components that are joined with others, and the name they have now. payload: (v, payload). All pairs of members of a key in different components are looked at, in two
    rounds. The first deals each key by hash into blocks of about `size` and looks inside the blocks. In
    the second, large keys are dealt again, now by component: a large component fills blocks of its
    own, small ones share theirs, and pairs of blocks are looked at unless both are of one component.
    So where the first round joins nearly all, members meet the few that are left once. What is sent
    is one row for a member and block it meets, and pairs of component names, not of members.

    `finer` makes, of the members (v, component) of large keys in different components, members of finer keys
    under which all pairs of theirs that `pairs_of` joins meet. With it the second round is that of the finer keys.
    `fewer` leaves out, of the members (key, v, component) of such keys, some that `pairs_of` joins with none of another component.
    """

    def look(rows: DataFrame) -> DataFrame:
        dealt = rows.join(payload, "v").select("key", "i", "j", "component", "payload").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        return tables.cut(dealt.mapInArrow(_in_groups(pairs_of), "a long, b long"))

    count = F.count("*").alias("n")
    some = members.groupBy("key").agg(count, F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key", "n")
    members = tables.cut(members.join(some, "key"))
    block = F.pmod(F.hash("v", F.lit(3)), F.ceil(F.col("n") / size)).cast("long")
    found = look(members.select("key", block.alias("i"), block.alias("j"), "component", "v"))
    up = tables.components(found)
    large = members.where(F.col("n") > size).drop("n")
    if large.isEmpty():
        return up
    now = large.join(up.select(F.col("id").alias("component"), F.col("component").alias("up")), "component", "left")
    now = tables.cut(now.select("key", "v", F.coalesce("up", "component").alias("component")))
    two = now.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    if finer:
        return _renamed(up, joined(finer(now.join(two, "key").select("v", "component").distinct()), payload, size, pairs_of))
    if fewer:
        now = tables.cut(now.join(two, "key").select("key", "v", "component"))
        if now.isEmpty():
            return up
        now = fewer(now)
    parts = now.groupBy("key", "component").agg(count)
    keys = parts.groupBy("key").agg(F.sum(F.when(F.col("n") < size, F.col("n"))).alias("small"), count.alias("parts")).where("parts > 1")
    alone = F.col("n") >= size
    number = F.when(alone, F.xxhash64("component", F.pmod(F.hash("v", F.lit(5)), F.ceil(F.col("n") / size)))).otherwise(F.pmod(F.hash("component", F.lit(7)), F.ceil(F.col("small") / size)).cast("long"))
    dealt = tables.cut(now.join(parts, ["key", "component"]).join(keys, "key").select("key", "v", "component", number.alias("block"), F.when(alone, F.col("component")).alias("only")))
    blocks = dealt.select("key", "block", "only").distinct()
    other = blocks.select("key", F.col("block").alias("other"), F.col("only").alias("its"))
    meets = blocks.join(other, "key").where(~F.coalesce(F.col("only") == F.col("its"), F.lit(False))).select("key", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    more = tables.components(look(dealt.join(meets, ["key", "block"]).select("key", "i", "j", "component", "v")))
    return _renamed(up, more)


def _renamed(up: DataFrame, more: DataFrame) -> DataFrame:
    """(id, component) of `up`, then of `more`, whose ids are components of `up` or not in it."""
    both = up.join(more.select(F.col("id").alias("component"), F.col("component").alias("top")), "component", "full_outer")
    return tables.cut(both.select(F.coalesce("id", "component").alias("id"), F.coalesce("top", "component").alias("component")))


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, coordinates: int = COORDINATES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs (doc_id, text).

    Rows are linked if den * |A & B| >= num * |A | B| for their sets of n-word shingles, A-Z in
    lower case. component_id is the smallest doc_id reachable; kept is doc_id = component_id.
    """
    out = _grouped(docs, n, num, den, coordinates)
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, coordinates: int = COORDINATES) -> DataFrame:
    """docs (doc_id, text, ...) with one row of each component: that of the least id, nulls last, and digest.

    Rows without a word are in no component and stay.
    """
    grouped = tables.cut(_grouped(docs, n, num, den, coordinates).select("doc_id", "rid", "node", "group"))
    least = grouped.where("node is not null").groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid")).alias("least"))
    chosen = least.select(F.col("least.rid").alias("rid"), F.lit(True).alias("once")).unionByName(grouped.where("node is null").select("rid", F.lit(False).alias("once")).distinct())
    # the row goes along as one column, so that its names don't meet ours
    rows = docs.select(F.xxhash64(F.col("doc_id").cast("long"), "text").alias("rid"), F.struct("*").alias("row")).join(chosen, "rid")
    equal = F.when(F.col("once"), 0).otherwise(F.monotonically_increasing_id())
    return rows.withColumn("equal", equal).dropDuplicates(["rid", "equal"]).select("row.*")


def _grouped(docs: DataFrame, n: int, num: int, den: int, coordinates: int) -> DataFrame:
    """doc_id, rid, n_shingles, node (null without a word), group and component_id of every row of docs."""
    least, prefix = matches_needed(coordinates, num, den), min(coordinates, prefix_needed(num, den))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("rid", F.xxhash64("doc_id", "text"))
    signed = tables.cut(docs.select("doc_id", "rid", "text").mapInArrow(_signer(n, coordinates, prefix), "doc_id long, rid long, n_shingles long, node long, posts array<long>, signature binary"))
    some = signed.where("node is not null")
    # one row stands for all rows with the same set
    first = tables.cut(some.groupBy("node").agg(F.min("rid").alias("v"), F.min("doc_id").alias("d")))
    chosen = tables.cut(some.join(first.select("node", F.col("v").alias("rid")), ["node", "rid"], "left_semi").select(F.col("rid").alias("v"), "posts", "signature").dropDuplicates(["v"]))
    posts = chosen.select("v", F.explode("posts").alias("key"))
    shared = posts.groupBy("key").agg(F.min("v").alias("pivot"), F.max("v").alias("top")).where("pivot <> top").select("key", "pivot")
    listed = tables.cut(posts.join(shared, "key").select("key", "v", "pivot"))

    hits = listed.where("v <> pivot").groupBy("v", "pivot").count().where(F.col("count") * 2 >= prefix)
    best = hits.groupBy("v").agg(F.max(F.struct("count", "pivot")).alias("best"))
    links = tables.cut(confirmed(docs, best.select(F.col("best.pivot").alias("a"), F.col("v").alias("b")), n, num, den))
    label = tables.components(links)

    def component_of(rows: DataFrame) -> DataFrame:
        return rows.join(label.withColumnRenamed("id", "v"), "v", "left").withColumn("component", F.coalesce("component", "v"))

    signature = chosen.select("v", F.col("signature").alias("payload"))
    near = joined(component_of(listed.select("key", "v")), signature, BLOCK, _by_signature(coordinates, least), lambda rows: rarest(rows, signature, coordinates, least, BLOCK))
    cluster = near.select(F.col("id").alias("component"), F.col("component").alias("key"))
    members = component_of(chosen.select("v")).join(cluster, "component")
    # texts are joined in the same way at every size: members outgrow a broadcast as a corpus grows
    texts = docs.select(F.col("rid").alias("v"), F.col("text").alias("payload")).hint("merge")
    more = joined(members, texts, TEXTS, _by_text(n, num, den), fewer=lambda rows: linkable(rows, texts, n, num, den))
    top = more.select(F.col("id").alias("component"), F.col("component").alias("top"))
    label = tables.cut(component_of(chosen.select("v")).join(top, "component", "left").select(F.col("v").alias("id"), F.coalesce("top", "component").alias("component")))

    group = first.join(label.withColumnRenamed("id", "v"), "v", "left").select("node", "d", F.coalesce("component", "v").alias("group"))
    names = group.join(group.groupBy("group").agg(F.min("d").alias("component_id")), "group").select("node", "group", "component_id")
    return signed.select("doc_id", "rid", "n_shingles", "node").join(names, "node", "left")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(tables.read(spark, sf_dir, "documents"), n=3, num=85)


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), sets AS (
  SELECT doc_id, list_sort(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct([array_to_string(words[i:i + 2], ' ') for i in range(1, len(words) - 1)]) END) AS shingles FROM w
), one AS (
  SELECT shingles, min(doc_id) AS v FROM sets WHERE len(shingles) > 0 GROUP BY shingles
), each AS (
  SELECT v, len(shingles) AS n, unnest(shingles) AS shingle FROM one
), links AS (
  SELECT a.v AS a, b.v AS b FROM each a JOIN each b ON a.shingle = b.shingle AND a.v <> b.v
  GROUP BY a.v, b.v, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (
  SELECT a AS v, b AS other FROM links UNION SELECT r.v, l.b FROM reach r JOIN links l ON r.other = l.a
), label AS (
  SELECT shingles, least(v, min(other)) AS component_id FROM one LEFT JOIN reach USING (v) GROUP BY shingles, v
)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM sets LEFT JOIN label USING (shingles)
"""
