"""Small tables with everything that a text table can hold."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

#: Columns whose names the operators use inside.
CLASHING = "rid long, node long, hash long, found string, score double, n_words long, _key long, gone string, block long, host string, kept boolean, path string"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def clash(n: int) -> tuple:
    return (n, n, n, "f", 0.5, n, n, "g", n, "h", True, "p")


@pytest.fixture(scope="session")
def docs(spark):
    """Prose with copies and near copies, and nulls, empty, short and long texts, ties and repeated rows."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(300)]

    def prose(n: int) -> list[str]:
        return [rng.choice(vocabulary) for _ in range(n)]

    def shown(words: list[str]) -> str:
        return "".join(w + ("\n" if i % 13 == 12 else " ") for i, w in enumerate(words)).strip()

    boiler = "all of this is boilerplate that stands everywhere"
    texts = []
    for i in range(40):
        words = prose(rng.randint(30, 120))
        texts.append(shown(words))
        if i % 4 == 0:
            texts.append(shown(words))
        if i % 5 == 0:
            near = list(words)
            near[rng.randrange(len(near))] = "changed"
            texts.append(shown(near))
        if i % 3 == 0:
            texts.append(shown(prose(rng.randint(3, 60))) + "\n" + boiler + ("s" if i % 2 else "") + "\n" + shown(prose(rng.randint(3, 60))))
    passage = prose(50)
    texts += [shown(prose(20) + passage + prose(20)) for _ in range(4)]
    texts += [None, None, "", "   \n ", "one", "two words", "A b", "a B", "A A A " * 40, "7 7 7", "Éa éA", shown(prose(4000))]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", None]), len(t) if t else None, *clash(i)) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[1], None, None, None, *clash(0)), (None, None, None, None, None, *clash(0))]
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
