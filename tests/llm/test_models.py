"""Language identification, quality, decontamination and mixing: held-out accuracy and brute force."""

from __future__ import annotations

import hashlib
import math
import pickle
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dirlens.llm import decontaminate, language_id, mixing, quality, tables

SF = "/root/testdata/sf0.01"


def test_language_id_on_held_out_rows(spark):
    found = language_id.op5_language_id(spark, SF).join(tables.read(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert len(held) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_id_scores_by_brute_force():
    texts = ["Éa éA bc", "abc abd", "", None, "12 34"]
    model = language_id.Model(["a", "b"], np.random.default_rng(1).integers(0, 50, (language_id.BUCKETS, 2)).astype(float), np.array([3.0, 5.0]))
    names, scores = model.predict(texts)
    for t, name, score in zip(texts, names, scores, strict=True):
        grams, some = language_id.ngrams([t])
        logs = model.prior.copy()
        for buckets, _ in grams:
            for b in buckets:
                logs = logs + model.weights[b]
        if not some[0]:
            assert name == "und" and score == 0
        else:
            p = np.exp(logs - logs.max())
            assert name == model.languages[int(logs.argmax())] and math.isclose(score, p.max() / p.sum(), rel_tol=1e-5)


def test_equal_ngrams_hash_alike_across_texts():
    joined, _ = language_id.ngrams(["xx abc", "abc"])
    for n, (buckets, cuts) in enumerate(joined, 1):
        alone = language_id.ngrams(["abc"])[0][n - 1][0]
        assert list(buckets[cuts[1] : cuts[2]]) == list(alone)


def test_language_id_of_odd_rows(spark, docs, no_docs):
    found = language_id.identify(docs.drop("found"), docs).select("text", "found.*").collect()
    assert len(found) == docs.count()
    for r in found:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        else:
            assert r["lang_pred"] in ("de", "en")
    assert language_id.identify(no_docs.drop("found"), no_docs).collect() == []
    nothing = docs.drop("found").withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(nothing, nothing).select("found.*").collect()} == {"und"}
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns and all(any(c.isalpha() for c in r["text"]) for r in kept.collect())


def test_a_large_batch_is_scored_in_bounded_memory():
    """What scoring holds at once does not reach 40 MB over 4 MB of texts, and the results are those of the texts alone."""
    rng = np.random.default_rng(6)
    texts = ["".join(map(chr, rng.integers(97, 123, 4000))) for _ in range(1000)]
    model = language_id.Model(["a", "b", "c", "d"], rng.integers(0, 50, (language_id.BUCKETS, 4)).astype(float), np.ones(4))
    language_id.is_letter()
    tracemalloc.start()
    found = [x for some in language_id._chunks(pa.array(texts)) for x in zip(*model.judge(some), strict=True)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6, peak
    assert len(found) == len(texts) and all(found[i] == tuple(x[0] for x in model.judge([texts[i]])) for i in (0, 499, 999))


def test_texts_in_no_learned_language_go(spark):
    rng = np.random.default_rng(5)
    letters = lambda a, n: " ".join("".join(rng.choice(list(a), rng.integers(2, 9))) for _ in range(n))
    noise = [letters("abcdefghijklmnopqrstuvwxyz", 60), letters("абвгдежзиклмнопрстуфхцчшщыэюя", 60), "привет как дела", "".join(map(chr, rng.integers(0x4E00, 0x9000, 200)))]
    docs = tables.read(spark, SF, "documents").select("doc_id", "text", "lang")
    rows = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(noise)], docs.schema)
    assert {r["doc_id"] for r in language_id.keep_identified(docs.unionAll(rows)).collect()} == {r["doc_id"] for r in docs.collect()}


def test_quality_on_held_out_rows(spark):
    found = quality.op8_quality_classifier(spark, "/root/testdata/sf0.1").join(tables.read(spark, "/root/testdata/sf0.1", "labels"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.98 and np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in found)


def test_random_indexing_by_brute_force():
    body, offsets = quality.text.buffers(pa.array(["a b, a%% c", "", "b b"]))
    hashes, bounds = quality.tokens(body, offsets, 0, 3)
    assert list(bounds) == [0, 6, 6, 8]
    expected = np.zeros((quality.BUCKETS, quality.DIM + 1), dtype=np.int64)
    own = quality.bucket(hashes)
    for s, e in zip(bounds[:-1], bounds[1:], strict=True):
        for i in range(s, e):
            expected[own[i], quality.DIM] += 1
            for j in range(max(s, i - quality.REACH), min(e, i + quality.REACH + 1)):
                if j != i:
                    for k in range(quality.SPARSE):
                        place = int(hashes[j] >> np.uint64(8 * k)) & (2 * quality.DIM - 1)
                        expected[own[i], place % quality.DIM] += 1 if place < quality.DIM else -1
    assert (quality.contexts(hashes, bounds) == expected).all()


def test_scores_by_brute_force(monkeypatch):
    """The whole score of ten texts, long ones in pieces, from vectors by bucket and plain sums."""
    monkeypatch.setattr(quality, "PIECE", 50)
    rng = random.Random(12)
    texts = [" ".join(rng.choice(["a", "b,", "cc1", "d.e", "ff"]) for _ in range(rng.choice([0, 1, 5, 30, 200]))) for _ in range(60)]
    body, offsets = quality.text.buffers(pa.array(texts))
    parsed = quality.tokens(body, offsets, 0, len(texts))
    total = quality.contexts(*parsed)
    vectors = quality.unit_vectors(total)
    n = total[:, quality.DIM]
    mean = total[:, : quality.DIM].sum(axis=0) / n.sum()
    net = quality.Network(quality.features(vectors, *parsed), np.array([float("cc" in t) for t in texts]), epochs=20)
    found = net.score(quality.features(vectors, *parsed))
    for k in range(10):
        own = []
        for h in quality.bucket(parsed[0][parsed[1][k] : parsed[1][k + 1]]):
            v = total[h, : quality.DIM] - n[h] * mean
            own.append(v / max(math.sqrt(sum(v * v)), 1e-9))
        own = np.array(own or [np.zeros(quality.DIM)])
        x = np.concatenate([own.mean(axis=0), own.std(axis=0)])
        hidden = [max(0.0, sum((x - net.mean) / net.scale * net.w1[:, j]) + net.b1[j]) for j in range(quality.HIDDEN)]
        logit = sum(h * w for h, w in zip(hidden, net.w2, strict=True)) + net.b2[0]
        assert found[k] == pytest.approx(1 / (1 + math.exp(-logit / net.temperature)), abs=1e-3)


def test_mean_vectors_alone_tell_quality(spark):
    """Held out at sf0.1, the pooled mean of the word vectors, without the deviations, ranks nearly as well."""
    rows = tables.read(spark, "/root/testdata/sf0.1", "documents").join(tables.read(spark, "/root/testdata/sf0.1", "labels"), "doc_id").orderBy("doc_id").select("doc_id", "text", "quality", quality.held_out().alias("held")).toPandas()
    body, offsets = quality.text.buffers(pa.array(rows["text"]))
    parsed = quality.tokens(body, offsets, 0, len(rows))
    x = quality.features(quality.word_vectors(tables.read(spark, "/root/testdata/sf0.1", "documents")), *parsed)
    held, y = rows["held"].to_numpy(), rows["quality"].to_numpy(dtype=float)
    found = {}
    for name, part in (("mean", x[:, : quality.DIM]), ("both", x)):
        score = quality.Network(part[~held], y[~held]).score(part[held])
        good, bad = score[y[held] == 1], score[y[held] == 0]
        found[name] = np.mean((good[:, None] > bad) + 0.5 * (good[:, None] == bad))
    assert found["mean"] > 0.95 and found["both"] > 0.98


def test_quality_of_odd_rows(spark, docs, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (5, None)], "doc_id long, quality int")
    found = quality.rate(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if not (r["text"] or "").strip()}) == 1
    assert {r["score"] for r in quality.rate(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.rate(no_docs, labels).collect() == []


def leak_rows(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(8, 40))) + ". " + " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 9))) + ".") for i in range(40)]
    docs = []
    for i in range(120):
        t = [rng.choice(vocabulary) for _ in range(rng.randint(0, 200))]
        if i % 3 == 0:
            w = rng.choice(items)[1].split()
            for _ in range(i % 4):
                w[rng.randrange(len(w))] = "CHANGED"
            at = rng.randint(0, len(t))
            t[at:at] = [x.upper() for x in w] if i % 2 else w
        if i % 7 == 0:
            w = rng.choice(items)[1].split()
            t += w[: len(w) // 2]
        docs.append((i, " ".join(t)))
    docs += [(500, None), (501, ""), (502, "..."), (503, docs[0][1]), (503, docs[0][1])]
    items += [(900, None), (901, ""), (902, items[0][1]), (None, "x y z")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def brute_leaks(docs, items):
    """All pairs by scoring every item against every passage."""
    split = lambda x: re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (x or "").lower())
    good = sorted((r["item_id"], r["text"]) for r in items if r["text"] is not None and r["item_id"] is not None)
    good = [(i, t, split(t)) for i, t in good if split(t)]
    df = Counter(w for _, _, ws in good for w in set(ws))
    mean, step = np.mean([len(ws) for *_, ws in good]), max(len(ws) for *_, ws in good)
    weigh = [{w: math.log1p((len(good) - df[w] + 0.5) / (df[w] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ws) / mean)) for w, n in Counter(ws).items()} for *_, ws in good]
    grams = lambda ws, n: {tuple(ws[k : k + n]) for k in range(len(ws) - n + 1)}
    out = []
    for r in docs:
        ws, best = split(r["text"]), {}
        for at in range(0, max(1, len(ws)), step):
            passage = ws[at : at + 2 * step]
            for (i, t, _), own in zip(good, weigh, strict=True):
                score = sum(own[w] for w in own.keys() & set(passage)) / sum(own.values())
                if score < decontaminate.RETRIEVE:
                    continue
                shares = []
                for part in map(split, (*decontaminate.parts(t), t)):
                    n = min(decontaminate.SHINGLE, len(part))
                    shares.append(len(grams(part, n) & grams(passage, n)) / len(grams(part, n)) if n else 1.0)
                if min(shares[:2]) >= decontaminate.OVERLAP or shares[2] >= decontaminate.OVERLAP:
                    best[i] = max(best.get(i, (0,)), (round(min(1.0, score), 5), *shares))
        out += [(r["doc_id"], i, *v) for i, v in best.items()]
    return out


def test_leaks(spark):
    docs, items = leak_rows(spark)
    found = [(r[0], r[1], round(r[2], 5), *r[3:]) for r in decontaminate.leaks(docs, items).collect()]
    expected = brute_leaks(docs.collect(), items.collect())
    assert len(expected) > 15 and len({x[2:] for x in expected}) > 2
    assert [x[:2] for x in sorted(found)] == [x[:2] for x in sorted(expected)]
    assert np.allclose([x[2:] for x in sorted(found)], [x[2:] for x in sorted(expected)], atol=2e-5)
    kept = {r["doc_id"] for r in decontaminate.drop_leaks(docs, items).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {x[0] for x in expected}


@pytest.mark.parametrize("at", [3, 17, 32, 36])
def test_one_changed_word_hides_no_item(spark, at):
    """Neither in the question nor in an answer of four words; a question without its answer is no leak."""
    words = [f"q{i}" for i in range(33)] + [".", "a0", "a1", "a2", "a3."]
    items = spark.createDataFrame([(7, " ".join(words).replace(" .", ".")), (8, "some other item. of no use.")], "item_id long, text string")
    texts = [words[:at] + ["changed"] + words[at + 1 :], words[:20], words[34:]]
    docs = spark.createDataFrame([(i, " ".join(f"p{i}{k}" for k in range(50)) + " " + " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert [tuple(r)[:2] for r in decontaminate.leaks(docs, items).collect()] == [(0, 7)]
    assert {r["doc_id"] for r in decontaminate.drop_leaks(docs, items).collect()} == {1, 2}


def test_a_batch_of_which_no_block_is_left(spark):
    """The bound of a block reaches its threshold until the terms before the pivot are looked up."""
    texts = ["w11", "w2", "w3", "w13 w1 w2", "w0 w14", "w5 w5 w0 w1 w4 w1 w0 w0 w3 w7", "w11 w0", "w10 w1 w14", "w12 w0 w0"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    for text, item in (("w7 w0", None), ("W7, w0 w14", 4)):
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        expected = {x[:2] for x in brute_leaks(docs.collect(), items.collect())}
        assert expected == ({(1, item)} if item else set())
        assert {(r[0], r[1]) for r in decontaminate.leaks(docs, items).collect()} == expected
        assert decontaminate.drop_leaks(docs, items).count() == (not expected)


def test_leaks_of_several_indexes_and_of_nothing(spark, docs, no_docs):
    texts, items = leak_rows(spark)
    whole = {(r[0], r[1]) for r in decontaminate.leaks(texts, items, 0.9).collect()}
    before, decontaminate.ITEMS = decontaminate.ITEMS, 7
    try:
        assert len(decontaminate.indexes(items)) > 1
        assert whole <= {(r[0], r[1]) for r in decontaminate.leaks(texts, items, 0.5).collect()}
    finally:
        decontaminate.ITEMS = before
    assert decontaminate.leaks(no_docs, items).collect() == []
    assert decontaminate.leaks(docs, items.limit(0)).collect() == []
    assert decontaminate.drop_leaks(docs, items).count() == docs.count()


def test_given_leaks_are_all_found(spark):
    norm = lambda x: " " + " ".join(re.findall(r"[^\W_]+", x.lower())) + " "
    items = [(r["item_id"], norm(r["text"])) for r in tables.read(spark, SF, "benchmark").collect()]
    expected = {(r["doc_id"], i) for r in tables.read(spark, SF, "documents").collect() for t in [norm(r["text"])] for i, x in items if x in t}
    assert expected and {(r["doc_id"], r["item_id"]) for r in decontaminate.op4_decontaminate(spark, SF).collect()} >= expected


def test_exponent_meets_its_targets():
    tokens = [60, 20, 10, 5, 5]
    e = mixing.exponent(tokens, entropy=0.95, repeats=100)
    w = mixing.weights([t / 100 for t in tokens], e)
    assert math.isclose(-sum(x * math.log(x) for x in w), 0.95 * math.log(5), rel_tol=1e-6)
    e = mixing.exponent(tokens, entropy=1.0, repeats=3)
    w = mixing.weights([t / 100 for t in tokens], e)
    assert math.isclose(max(x / t for x, t in zip(w, tokens, strict=True)) / min(x / t for x, t in zip(w, tokens, strict=True)), 3, rel_tol=1e-6)
    assert mixing.exponent([5, 5], 0.9) == 1.0 and mixing.exponent([7]) == 1.0


@pytest.mark.parametrize("budget", [None, 900, 20_000, 0])
def test_mix_by_brute_force(docs, budget):
    before, mixing.BLOCK_TOKENS = mixing.BLOCK_TOKENS, 200
    try:
        found = mixing.mix(docs, budget=budget).collect()
        rows = [(r["doc_id"], r["source"] or "", len(re.findall(mixing.WORD, r["text"] or ""))) for r in docs.collect()]
        sizes = Counter()
        for _, s, n in rows:
            sizes[s] += n
        plan = mixing.plan(dict(sizes), budget=budget)
    finally:
        mixing.BLOCK_TOKENS = before
    def number(*parts):
        return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:15], 16)

    expected = Counter()
    for s, w, whole, rest, blocks in plan:
        own = [(d, n, number(17, "" if d is None else d)) for d, x, n in rows if x == s]
        order = sorted(own, key=lambda r: (number(17, whole, s, r[2] % blocks), r[2] % blocks, number(17, whole, "" if r[0] is None else r[0]), r[0] is not None, r[0] or 0))
        have = 0
        for d, n, h in order:
            for epoch in range(whole + (have < rest)):
                expected[d, s, n, round(w, 9), epoch, h % blocks] += 1
            have += n
    assert Counter((r["doc_id"], r["source"], r["n_tokens"], r["weight"], r["epoch"], r["block"]) for r in found) == expected
    if budget is None:
        assert {r["doc_id"] for r in found} == {d for d, *_ in rows}


def test_mix_of_nothing(no_docs):
    assert mixing.mix(no_docs).collect() == []


def test_a_large_index_is_linear_in_its_words():
    """20,000 items of 60 words: all postings once, the items found that full scoring finds."""
    rng = np.random.default_rng(6)
    names = np.array([f"w{i}" for i in range(80_000)])
    words = (80_000 * rng.random((20_000, 60)) ** 3).astype(int)
    index = decontaminate.Index([(i, " ".join(names[w])) for i, w in enumerate(words)])
    assert len(pickle.dumps(index)) < 200 << 20 and len(index.places) == sum(len(set(w)) for w in words.tolist())
    texts = [" ".join([*names[words[i][: 60 - cut]], *names[rng.integers(0, 80_000, cut)]]) for i, cut in ((5, 0), (77, 3), (9000, 20), (19_999, 40))]
    hashes, bounds = decontaminate.word_hashes(texts)
    found = index.search(hashes, bounds, 0.3, 0.0)
    weight = np.zeros((len(index.ids), len(texts)))
    term = np.repeat(np.arange(len(index.terms)), np.diff(index.postings[index.lists]))
    for k in range(len(texts)):
        has = np.isin(index.terms[term], hashes[bounds[k] : bounds[k + 1]])
        weight[:, k] = np.bincount(index.places[has], index.weights[has], minlength=len(index.ids)) / index.own
    expected = {(k, int(index.ids[p])) for p, k in zip(*np.nonzero(weight >= 0.3), strict=True)}
    assert {(d, i) for d, i, *_ in found} == expected and len(expected) >= 4
