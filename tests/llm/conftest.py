from __future__ import annotations

import random

import pytest

from made_texts import prose

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, row string, kept string, _rank int"
@pytest.fixture(scope="session")
def docs_rows() -> list[tuple]:
    """Prose with copies, shared passages and lines, nulls, empty, odd and long texts, ties,
    repeated rows; and columns that clash with the operators' own."""
    rng = random.Random(5)
    passage = prose(rng, "en", 40)
    line = "Order 12345 shipped to customer under the usual terms"
    rows = []
    for i in range(120):
        lang = ("en", "fr", "de")[i % 3]
        text = prose(rng, lang, rng.randint(5, 150))
        if i % 7 == 0:
            text += " " + passage
        if i % 5 == 0:
            text = f"{text}\n{line.replace('12345', str(i))}\n{prose(rng, lang, 20)}"
        if i % 11 == 0:
            text = " ".join(w + "###" for w in text.split())
        rows.append((i, text, lang, f"src{min(i % 9, 3)}", len(text)))
    for i in range(120, 140):
        rows.append((i, rows[i % 4][1], rows[i % 4][2], "src0", 1))
    rows.append((140, " ".join(prose(rng, "en", 12000).split()[:-1]), "en", "src1", 1))
    rows += [(141, None, "en", "src0", None), (142, "", None, "src1", 0), (143, "  \n\t ", "fr", None, 3), (144, "123 456 !!", "de", None, 10), (145, "a" * 4000, None, "src2", 4000), (146, "é中文 ñ 　  x<|endoftext|>y 😀", "fr", "src2", 20), (147, "one", "en", "src2", 3)]
    rows += [rows[3], rows[3], (None, rows[5][1], "en", "src3", 9), (None, None, None, None, None)]
    return [(*r, 7, "x", "y", "z", 1) for r in rows]


@pytest.fixture(scope="session")
def docs(spark, docs_rows):
    return spark.createDataFrame(docs_rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
