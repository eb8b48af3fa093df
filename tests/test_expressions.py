"""The plain gate and decoders against their column forms, and keep-first under any partitioning."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dirlens.functions import contacts
from dirlens.html import plain
from dirlens.operators import extract, relational

PIECES = ["Ada", "Moss", "Brazil", "Title: ", "Email ", "Principal", "Teacher", "Oak Elementary", ",", " - ", "&", "7", "x", " ", "\t", "RN", "read more", "Georgia", "(Gigi)", "©"]


def test_gate_agrees_with_its_expression(spark):
    rng = random.Random(3)

    def made():
        return None if rng.random() < 0.1 else "".join(rng.choice(PIECES) + rng.choice(["", " "]) for _ in range(rng.randint(0, 4)))

    rows = [(made(), made(), rng.choice([None, "", "a@x.example.org"])) for _ in range(1500)]
    df = spark.createDataFrame(rows, "n string, t string, e string").select("*", extract.is_accepted(F.col("n"), F.col("t"), F.col("e")).alias("ok"))
    wrong = [r for r in df.collect() if r["ok"] != plain.accepted(r["n"], r["t"], r["e"])]
    assert wrong == []


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 255), st.text(st.characters(max_codepoint=127), min_size=1, max_size=30))
def test_hex_decodes_what_was_encoded(key, shown):
    assert plain.decode_hex(f"{key:02x}" + "".join(f"{ord(c) ^ key:02x}" for c in shown)) == shown


def test_hex_column_agrees(spark):
    rng = random.Random(5)
    rows = [("".join(rng.choice("0123456789abcdefXg") for _ in range(rng.randint(0, 13))),) for _ in range(300)]
    for r in spark.createDataFrame(rows, "h string").select("h", contacts.decode_hex(F.col("h")).alias("d")).collect():
        assert r["d"] == plain.decode_hex(r["h"])


def test_keep_first_is_idempotent_and_independent_of_partitions(spark):
    rng = random.Random(7)
    rows = [(rng.choice("ab"), rng.choice("xyz"), f"n{rng.randint(0, 3)}", rng.choice([None, "A@x.example.org", "a@x.example.org", "b@x.example.org"]), "t", i) for i in range(200)]
    df = spark.createDataFrame(rows, "district string, school string, name string, email string, title string, ord int")
    one = sorted(map(tuple, relational.dedupe_people(df.coalesce(1)).collect()), key=repr)
    many = relational.dedupe_people(df.repartition(7))
    assert one == sorted(map(tuple, many.collect()), key=repr)
    assert one == sorted(map(tuple, relational.dedupe_people(many).collect()), key=repr)


def test_set_page_keeps_the_first_value_of_a_parameter():
    assert contacts.with_parameter("https://x.example.org/a?b=1&b=2&const_page=1", "const_page", "3") == "https://x.example.org/a?b=1&const_page=3"
