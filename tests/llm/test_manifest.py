"""Digests and proofs against a tree built in memory."""

from __future__ import annotations

import zlib
from hashlib import sha256
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from metriclab.llm import manifest

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
H = lambda parts: sha256("".join(parts).encode()).hexdigest()


def digest(values):
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(leaves):
    """The root, and the (place, siblings) of every leaf up to it."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for leaf, i in enumerate(at):
            run = runs[i // 3]
            paths[leaf].append((i % 3, [*run[: i % 3], *run[i % 3 + 1 :]]))
            at[leaf] = i // 3
        level = [H(r) for r in runs]
    return level[0], paths


def plain(rows):
    ordered = sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, digest(r)))
    groups = [list(g) for _, g in groupby(ordered, key=lambda r: r[1])]
    subs = [tree([digest(r) for r in g]) for g in groups]
    root, over = tree([s for s, _ in subs])
    out = []
    for g, (sub, paths), top in zip(groups, subs, over):
        for r, path in zip(g, paths):
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            seen = cur = digest((*r[:4], r[4].replace("\n", "") if even and r[4] else r[4]))
            for place, others in path + top:
                cur = H([*others[:place], cur, *others[place:]])
            leaf = digest(r)
            assert (cur == root) == (seen == leaf)
            out.append((r[0], leaf, sub, root, H(x for _, some in path + top for x in some), cur, cur == root))
    return out


def found(df):
    return list(map(tuple, manifest.manifest(df, changed={"text": manifest.without_newlines(df)}).collect()))


@pytest.mark.parametrize("sizes", [[1], [2], [1, 1], [27, 28, 1, 9, 10, 3], [5] * 40, [243], [250, 1, 244, 729], [1, 2] * 140])
def test_proofs_equal_a_tree_in_memory(spark, sizes, monkeypatch):
    monkeypatch.setattr(manifest, "NODES", 50)
    rows = [(100 * g + i, None if g == 0 else f"é{g}" if g % 2 else f"s{g}", None if i % 4 == 0 else "en", None if i % 5 == 0 else i, None if i % 7 == 0 else "" if i % 7 == 1 else f"a\nb{i}\n") for g, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumns({"leaf": F.lit("x"), "place": F.lit(1)}).repartition(5)
    got = found(df)
    assert sorted(got) == sorted(plain(rows))
    assert {r[-1] for r in got} <= {True, False}


def test_repeated_rows_null_keys_and_long_texts(spark):
    rows = [(None, None, None, None, None), (None, "a", None, None, "x"), (7, "a", "en", 3, "y\n" * 200_000), (7, "a", "en", 3, "z"), (8, "a", None, None, None), (7, "a", "en", 3, "z"), (7, "a", "en", 3, "z")]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    key = lambda r: tuple(map(str, r))
    assert sorted(found(df), key=key) == sorted(plain(rows), key=key)
    assert manifest.manifest(df.limit(0)).collect() == []
    for r in manifest.manifest(df, paths=True).collect():
        assert r["verified"] and manifest.folded(bytes.fromhex(r["leaf"]), bytes(r["path"])).hex() == r["root"]
