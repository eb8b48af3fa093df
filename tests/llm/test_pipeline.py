"""The pipeline's stages, one after the other, against plain versions of what each decides."""

from __future__ import annotations

import re

import corpus_pipeline
import pytest
from compare import assert_same
from test_models import brute_leaks
from test_texts import sets_of, unite

from dirlens.llm import registry, tables

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(n for n in registry.SQL if n != "op3_line_dedup"))
def test_query_matches_sql(spark, name):
    assert_same(registry.QUERIES[name](spark, SF), registry.SQL[name], SF)


def test_line_query_matches_sql(spark):
    assert_same(registry.QUERIES["op3_line_dedup"](spark, SF), registry.SQL["op3_line_dedup"], SF)


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in registry.QUERIES) == list(range(1, 11))


def test_stages(spark, tmp_path):
    docs = tables.read(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = docs.collect()
        if name != "mixing":
            assert docs.columns == columns
        ids = {r["doc_id"] for r in after}
        if name == "language_id":
            assert ids == {r["doc_id"] for r in before}
        elif name == "line_dedup":
            texts = {r["doc_id"]: r["text"] for r in before}
            for r in after:
                lines = texts[r["doc_id"]].split("\n")
                assert all(x in lines for x in r["text"].split("\n")) and r["n_chars"] == len(r["text"])
        elif name == "near_dedup":
            sets = sets_of(before, 5)
            links = [(before[i]["doc_id"], before[j]["doc_id"]) for i in range(len(before)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
            assert links and ids == set(unite(links, [r["doc_id"] for r in before]).values())
        elif name == "decontaminate":
            gone = {x[0] for x in brute_leaks(before, tables.read(spark, SF, "benchmark").collect())}
            assert gone and ids == {r["doc_id"] for r in before} - gone
        else:
            assert ids == {r["doc_id"] for r in before}


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).columns[:3] == ["doc_id", "source", "n_tokens"]


def test_stages_of_odd_rows(spark, docs, no_docs):
    for rows in (docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, rows, SF)
            assert name == "mixing" or found.columns == rows.columns
            assert found.count() <= 3 * rows.count()


def test_repeated_lines_go_wherever_they_stand(spark):
    """A footer at one place, a short line and an edited one; copies of a text count once and copies of the first keep theirs."""
    own = lambda i: f"{'abcdefghij'[i % 10] * 12} {i} {'klmnopqrst'[i * 7 % 10] * 12}"
    rows = [(i, f"{own(i)}\nLes.\n{own(100 + i)}\nReleased under the MIT license{'.' * (i % 2)}") for i in range(20)]
    rows += [(50 + i, rows[0][1]) for i in range(3)] + [(80 + i, "a line of many copies of one text\nab") for i in range(30)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["doc_id"]: r["text"] for r in dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, SF).collect()}
    whole = {0, 50, 51, 52} | set(range(80, 110))
    assert found == {i: t if i in whole else f"{own(i)}\n{own(100 + i)}" for i, t in rows}


def test_line_stage_tells_rows_of_one_id_apart(spark):
    """Rows that share an id, or have none, lose no lines of each other; near copies keep theirs."""
    own = lambda i: f"{'abcdefghij'[i % 10] * 12} {i} {'klmnopqrst'[i * 7 % 10] * 12}"
    boiler = "Released under the MIT license"
    rows = [(i, f"{own(i)}\n{boiler}\n{own(100 + i)}") for i in range(20)]
    rows += [(3, f"{own(200)}\nanother line of the same id\n{own(201)}"), (None, f"{own(202)}\nno id here\n{own(203)}"), (None, f"{own(204)}\n{boiler}\n{own(205)}")]
    base = [f"{'uvwxyz'[i % 6] * 9} {i} of one text" for i in range(12)]
    near = [(500 + i, "\n".join(base[: i % 12] + [f"edited {i * 77777}"] + base[i % 12 + 1 :])) for i in range(60)]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows + near], "doc_id long, text string, lang string, source string, n_chars long")
    found = [(r["doc_id"], r["text"]) for r in dict(corpus_pipeline.STAGES)["line_dedup"](spark, docs, SF).collect()]
    expected = [(d, t if d == 0 else "\n".join(x for x in t.split("\n") if x != boiler)) for d, t in rows] + near
    assert sorted(found, key=repr) == sorted(expected, key=repr)
