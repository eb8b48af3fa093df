"""Near-duplicate, substring and line operators against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from dirlens.llm import line_dedup, near_dedup, substring_dedup, tables, text

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(x):
    return [bytes(w) for w in WORD.findall((x or "").encode())]


def unite(edges, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def sets_of(rows, n):
    out = []
    for r in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or ""))
        out.append(frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)] if w else []))
    return out


@pytest.mark.parametrize("n,num", [(3, 85), (5, 80), (1, 60)])
def test_near_duplicates(docs, n, num):
    rows = docs.collect()
    sets = sets_of(rows, n)
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])]
    group = unite(edges, range(len(rows)))
    members = defaultdict(list)
    for i, g in group.items():
        members[g].append(rows[i]["doc_id"])

    def expected(i):
        ids = [d for d in members[group[i]] if d is not None]
        own = rows[i]["doc_id"]
        name = (min(ids) if ids else None) if sets[i] else own
        return (own, len(sets[i]), name, name is None or own == name)

    found = [tuple(r) for r in near_dedup.near_duplicates(docs, n, num).collect()]
    assert sorted(found, key=repr) == sorted((expected(i) for i in range(len(rows))), key=repr)


def test_near_duplicates_of_a_template(spark):
    """A group of many near copies, few of them linked with each other: blocks and clusters are split."""
    rng = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        t = list(base)
        for _ in range(rng.randint(0, 5)):
            t[rng.randrange(60)] = f"x{rng.randint(0, 9)}"
        rows.append((i, " ".join(t)))
    before = near_dedup.BLOCK, near_dedup.TEXTS, near_dedup.STAR
    near_dedup.BLOCK, near_dedup.TEXTS, near_dedup.STAR = 16, 16, 8
    try:
        found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    finally:
        near_dedup.BLOCK, near_dedup.TEXTS, near_dedup.STAR = before
    sets = sets_of([{"text": t} for _, t in rows], 3)
    edges = [(i, j) for i in range(150) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    assert found == unite(edges, range(150))
    assert len(set(found.values())) > 3


def test_edges_of_near_copies_grow_with_their_number(spark, monkeypatch):
    """Four times the copies of a template give about four times the edges, over several blocks."""
    base = [f"w{i}" for i in range(60)]
    edges, whole = [], tables.components
    monkeypatch.setattr(tables, "components", lambda e: (edges.append(e.count()), whole(e))[1])
    counts = []
    for n in (500, 2000):
        rng, rows = random.Random(n), []
        for i in range(n):
            t = list(base)
            for _ in range(rng.randint(0, 4) if i else 0):
                t[rng.randrange(60)] = f"x{rng.randint(0, 99)}"
            rows.append((i, " ".join(t)))
        edges.clear()
        found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 85)
        assert found.where("component_id = 0").count() > n // 4
        counts.append(sum(edges))
    assert counts[1] <= 4.5 * counts[0]


def test_a_passage_in_many_texts_sends_them_a_fixed_number_of_times(spark, monkeypatch):
    """Four times the texts with a passage in common, else apart but for some near copies, are about four times the rows in blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    sent, whole = spark.sparkContext.accumulator(0), near_dedup._in_groups

    def counted(pairs_of):
        work = whole(pairs_of)

        def add(batches):
            def each():
                for batch in batches:
                    sent.add(batch.num_rows)
                    yield batch

            yield from work(each())

        return add

    monkeypatch.setattr(near_dedup, "_in_groups", counted)
    counts = []
    for n in (300, 1200):
        rng, rows = random.Random(n), []
        for i in range(n):
            own = [f"w{rng.randrange(100_000)}" for _ in range(40)]
            if i % 10 == 9:
                own = [*rows[-1][1].split()[8:-1], "changed"]
            rows.append((i, " ".join([*"a passage of eight words that all have".split(), *own])))
        before = sent.value
        found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 85).collect()}
        counts.append(sent.value - before)
        assert found == {i: i - (i % 10 == 9) for i in range(n)}
    assert counts[1] <= 5 * counts[0], counts


def test_rarest_keys_share_one():
    """Two rows with `least` equal keys have a common one among their first, whatever is known of the counts."""
    rng = np.random.default_rng(3)
    coordinates, least = 32, near_dedup.matches_needed(32, 85, 100)
    keys = (rng.integers(0, 40, (300, coordinates)) << 8) | np.arange(coordinates)
    for i in range(0, 300, 2):
        same = rng.permutation(coordinates)[:least]
        keys[i + 1, same] = keys[i, same]
    every, count = np.unique(keys, return_counts=True)
    for often, counts in ((every, count), (every[count > 9], count[count > 9]), (every[:0], count[:0])):
        first = near_dedup.rarest_keys(keys, often, counts, coordinates - least + 1)
        assert first.shape == (300, coordinates - least + 1)
        assert all(set(a) & set(b) for a, b in zip(first[::2].tolist(), first[1::2].tolist(), strict=True))


def test_members_that_match_none_are_not_posted(spark):
    """Members of a passage's list, and of one component, are left out of the lists of rarest coordinates; pairs that match meet."""
    rng = np.random.default_rng(4)
    coordinates, least, n = 32, near_dedup.matches_needed(32, 85, 100), 2000
    values = rng.integers(0, 1 << 32, (n + 100, coordinates), dtype=np.uint32)
    values[:, :10] = 7
    for i in range(0, 60, 2):
        same = rng.permutation(coordinates)[:least]
        values[i + 1, same] = values[i, same]
    values[n:] = values[n]
    component = np.arange(n + 100)
    component[n:] = n
    members = spark.createDataFrame([(i, c) for i, c in enumerate(component.tolist())], "v long, component long").repartition(3)
    signature = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(values)], "v long, payload binary")
    keys: dict[int, set[int]] = {}
    for r in near_dedup.rarest(members, signature, coordinates, least, 1024).collect():
        keys.setdefault(r["v"], set()).add(r["key"])
    assert all(keys[i] & keys[i + 1] for i in range(0, 60, 2))
    assert sum(map(len, keys.values())) < n // 2, "17 rows for each member before"


def test_short_texts_half_of_which_is_a_passage_meet_few(spark, monkeypatch):
    """Texts that match by signature but are not linked are sent once or twice, not once a block; near copies among them are found."""
    monkeypatch.setattr(near_dedup, "TEXTS", 16)
    sent, whole = spark.sparkContext.accumulator(0), near_dedup._by_text

    def counted(*rule):
        pairs = whole(*rule)

        def each(component, payload):
            sent.add(len(payload))
            return pairs(component, payload)

        return each

    monkeypatch.setattr(near_dedup, "_by_text", counted)
    rng, rows, n = random.Random(8), [], 600
    passage = [f"p{i}" for i in range(60)]
    for i in range(n):
        own = [f"w{rng.randrange(10**6)}" for _ in range(16)]
        if i % 10 == 9:
            own = [*rows[-1][1].split()[60:-1], "changed"]
        rows.append((i, " ".join([*passage, *own])))
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 3, 85).collect()}
    assert found == {i: i - (i % 10 == 9) for i in range(n)}
    assert sent.value < 6 * n, sent.value


def test_one_of_each(docs):
    """The least id of each component, one of repeated rows, and all rows without a word, with all their columns."""
    rows = docs.collect()
    sets = sets_of(rows, 5)
    group = unite([(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])], range(len(rows)))
    found = near_dedup.one_of_each(docs)
    assert found.columns == docs.columns
    expected = [repr(r) for r, s in zip(rows, sets, strict=True) if not s]
    for g in set(group.values()):
        ids = [rows[i]["doc_id"] for i in group if group[i] == g and sets[i]]
        expected += ids and [min(repr(r) for i, r in enumerate(rows) if group[i] == g and r["doc_id"] == min(ids, key=lambda d: (d is None, d or 0)))]
    assert sorted(map(repr, found.collect())) == sorted(expected)


def test_near_duplicates_of_nothing(no_docs):
    assert near_dedup.one_of_each(no_docs).collect() == []
    assert near_dedup.near_duplicates(no_docs).collect() == []


def test_match_and_prefix_numbers():
    assert near_dedup.prefix_needed(85, 100) == 8 and near_dedup.prefix_needed(80, 100) == 9 and near_dedup.prefix_needed(1, 1) == 1
    assert 14 <= near_dedup.matches_needed(32, 85, 100) <= 17


@pytest.mark.parametrize("few", [0, 250_000])
def test_components_of_a_long_chain(spark, monkeypatch, few):
    monkeypatch.setattr(tables, "FEW_EDGES", few)
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 200), (300, 301)], "a long, b long")
    found = dict(map(tuple, tables.components(edges).collect()))
    assert found == {i: 0 for i in range(101)} | {300: 300, 301: 300}
    assert tables.components(edges.limit(0)).collect() == []


@pytest.mark.parametrize("window,anchor", [(35, 12), (6, 2), (3, 1)])
def test_remove_repeats(docs, window, anchor):
    rows = docs.collect()
    count = Counter(tuple(w[i : i + window]) for r in rows for w in [words(r["text"])] for i in range(len(w) - window + 1))

    def expected(r):
        w = words(r["text"])
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        return (r["doc_id"], len(w), len(w) - sum(keep), b" ".join(x for x, k in zip(w, keep, strict=True) if k).decode())

    found = substring_dedup.remove_repeats(docs, window, anchor).collect()
    assert sorted((tuple(r)[:4] for r in found), key=repr) == sorted(map(expected, rows), key=repr)
    for r in found:
        assert all(f["length"] >= window for f in r["factors"])


def test_factors_are_longest_matches(spark):
    """Greedy factors: each goes on as far as the words at its reference do, and no other text has a longer match.

    Every text stands in two at most, so that the first and last place of a window are all its places.
    """
    rng = random.Random(5)
    fresh = iter(range(10**6))
    prose = lambda n: [f"w{next(fresh)}" for _ in range(n)]
    a, b, c = prose(60), prose(80), prose(45)
    texts = [prose(5) + a + prose(3) + b + prose(9), prose(4) + a + c + prose(2), b[10:70] + prose(7) + c, prose(30)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = {r["doc_id"]: r["factors"] for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    rid = {r["doc_id"]: r["rid"] for r in spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "xxhash64(doc_id, text) as rid").collect()}

    def longest(i, at):
        runs = ((sum(1 for _ in itertools.takewhile(lambda p: p[0] == p[1], zip(texts[i][at:], other[k:], strict=False))), j, k) for j, other in enumerate(texts) for k in range(len(other)) if (j, k) != (i, at))
        return max(runs)

    for i, t in enumerate(texts):
        expected, at = [], 0
        while at + 35 <= len(t):
            n, j, k = longest(i, at)
            if n >= 35:
                expected.append((at, n, (rid[j] + k + 2**63) % 2**64 - 2**63))
            at += n - 34 if n >= 35 else 1
        assert [(f["start"], f["length"], f["reference"]) for f in found[i]] == expected
    assert [len(found[i]) for i in range(4)] == [2, 2, 2, 0]


def test_hot_anchors_are_dealt(docs, monkeypatch):
    whole = sorted(map(repr, substring_dedup.remove_repeats(docs, 6, 2).collect()))
    monkeypatch.setattr(substring_dedup, "HOT", 10_000)
    assert sorted(map(repr, substring_dedup.remove_repeats(docs, 6, 2).collect())) == whole


def test_remove_repeats_of_nothing(no_docs):
    assert substring_dedup.remove_repeats(no_docs).collect() == []


def test_query_digest(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    found = substring_dedup.op9_substring_dedup(spark, str(tmp_path)).collect()
    kept = Counter(hashlib.sha256(r["kept_text"].encode()).hexdigest() for r in substring_dedup.remove_repeats(docs).collect())
    assert Counter(r["kept_sha256"] for r in found) == kept


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        over, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            over, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, over + (x != y))
    return row[-1]


def test_banded_distance():
    rng = random.Random(4)
    for _ in range(3000):
        a = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 16)))
        b = bytearray(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 1)))
        for tau in (1, 2, 3):
            assert line_dedup.edits_within(a, bytes(b), tau) == (distance(a, b) <= tau)


def line_rows(rows):
    return [(r["doc_id"], t, i, x.strip(" \t\r\x0b\x0c").encode()) for r in rows for t in [r["text"] or ""] for i, x in enumerate(t.split("\n")) if x.strip(" \t\r\x0b\x0c")]


@pytest.mark.parametrize("tau,block", [(2, 256), (1, 2)])
def test_line_classes(spark, docs, tau, block):
    rng = random.Random(8)
    more = []
    for i in range(60):  # variants of one line, some beyond the threshold of each other
        x = list("the same line stands here again")
        for _ in range(rng.randint(0, 3)):
            x[rng.randrange(len(x))] = rng.choice("xyz")
        y = list("a line of twenty one" if i % 3 else "lines below 20")  # 20 bytes, 14, and fewer by an edit
        for _ in range(rng.randint(0, 2)):
            y[rng.randrange(len(y))] = rng.choice(["", "x", "yz"])
        more.append((1000 + i, "first\n" * (i % 7) + "".join(x) + "\n" + "".join(y) + "\n short" + "y" * (i % 2) + "\n", None, None, None, *([None] * 12)))
    all_docs = docs.unionAll(spark.createDataFrame(more, docs.schema))
    lines = line_rows(all_docs.collect())
    one = sorted({x[3] for x in lines})
    most = lambda a, b: tau if min(len(a), len(b)) >= 20 else 1
    links = [(a, b) for i, a in enumerate(one) for b in one[:i] if min(len(a), len(b)) > 9 and abs(len(a) - len(b)) <= most(a, b) and distance(a, b) <= most(a, b)]
    assert any(len(a) == len(b) == 20 for a, b in links) and any({len(a), len(b)} == {19, 20} for a, b in links) and any(len(a) < 19 for a, b in links)
    degree = Counter(x for pair in links for x in pair)
    group = unite(links, one)
    texts, first = defaultdict(set), {}
    for d, t, i, x in lines:
        texts[group[x]].add(t)
        key = (d is None, d or 0, i)
        first[group[x]] = min(first.get(group[x], key), key)
    expected = []
    for d, _, i, x in lines:
        g = group[x]
        unnamed, fd, fi = first[g]
        fd = None if unnamed else fd
        expected.append((d, i, fd, fi, degree[x], len(texts[g]), len(texts[g]) >= 5 and (d, i) != (fd, fi)))
    before, line_dedup.BLOCK = line_dedup.BLOCK, block
    try:
        found = [tuple(r) for r in line_dedup.line_classes(all_docs, tau, 5).collect()]
    finally:
        line_dedup.BLOCK = before
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_a_line_at_one_place_of_many_documents(spark):
    """A last line of texts of the same form, long or short, goes from all but the first; copies count once."""
    rows = [(i, f"own line number {i * 7919} of it\nAnd {i}.\nLes.\nThe end of every document.") for i in range(30)]
    rows += [(100 + i, "a copy\nwith lines that only copies have") for i in range(50)]
    found = line_dedup.line_classes(spark.createDataFrame(rows, "doc_id long, text string")).where("removed").collect()
    assert {(r["doc_id"], r["line_no"]) for r in found} >= {(i, k) for i in range(1, 30) for k in (2, 3)}
    assert not [r for r in found if r["doc_id"] in (0, *range(100, 150))]


def test_drop_repeated_lines(docs, no_docs):
    rows = docs.collect()
    gone = {(r["doc_id"], bytes(r["copy"]), r["line_no"]) for r in line_dedup.repeated_lines(docs, 3).collect()}
    assert gone
    expected = []
    for r in rows:
        t, copy = r["text"], hashlib.md5((r["text"] or "").encode()).digest()
        if t is not None and any((d, c) == (r["doc_id"], copy) for d, c, _ in gone):
            t = "\n".join(x for i, x in enumerate(t.split("\n")) if (r["doc_id"], copy, i) not in gone)
            if not t.strip():
                continue
        expected.append((*tuple(r)[:1], t, *tuple(r)[2:]))
    found = line_dedup.drop_repeated_lines(docs, 3)
    assert found.columns == docs.columns
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert line_dedup.drop_repeated_lines(no_docs).collect() == [] and line_dedup.line_classes(no_docs).collect() == []


def test_equal_spans_have_equal_hashes():
    body = np.frombuffer(b"abc xabc ab cabc", dtype=np.uint8)
    sums = text.prefix(text.BYTE_VALUE[body])
    starts, ends = np.array([0, 5, 13, 9]), np.array([3, 8, 16, 11])
    got = text.span_hash(sums, starts, ends)
    assert got[0] == got[1] == got[2] != got[3]
