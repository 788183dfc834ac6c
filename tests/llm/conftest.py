from __future__ import annotations

import random

import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with missing values, copies, near copies, shared passages, long and empty texts, repeated rows, and odd extra columns."""
    rnd = random.Random(11)
    words = ["".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, 7))) for _ in range(500)]
    line = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage = "\n".join(line(30) for _ in range(4))
    rows = []
    for i in range(40):
        rows.append((i, "\n".join(line(rnd.randint(3, 25)) for _ in range(rnd.randint(1, 12))), rnd.choice(["a", "b", "b", None])))
    base = "\n".join(line(20) for _ in range(12))
    for i in range(40, 60):
        ws = base.split(" ")
        for _ in range(rnd.randint(0, 6)):
            ws[rnd.randrange(len(ws))] = rnd.choice(words)
        rows.append((i, " ".join(ws), "b"))
    for i in range(60, 70):
        rows.append((i, line(20) + "\n" + passage + "\n" + line(20), "c"))
    rows += [(70, rows[3][1], "a"), (71, rows[3][1], None), (72, None, "a"), (73, "", None), (74, " \n\t ", "b"), (75, "one", "b"), (76, "one two  three", "b"), (77, "One TWO three", "a")]
    rows += [(78, "x" * 3000, "a"), (79, (line(8) + "\n") * 60, "a"), (80, "Ünïcödé — 你好 🙂 " * 80, "c"), (81, "\n".join(line(25) for _ in range(400)), "d"), (None, line(60), "d")]
    rows += [rows[5], rows[5], (82, "#$ % a b c &&& |||", "d"), (83, "<|endoftext|> text <|endoftext|>", "d")]
    out = [(*r, f"{r[1]}"[:3], i, 0.5, [1]) for i, r in enumerate(rows)]
    return spark.createDataFrame(out, "doc_id long, text string, source string, `_key` string, `_row` int, size double, `kept` array<int>").repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long")
