"""The Merkle manifest against a plain tree: nulls, empty and long texts,
repeated rows and ids, many and single-row groups, clashing column names."""

from __future__ import annotations

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from meterline.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g string, h string, i int, n int, path string"


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return digest("".join(map(field, (r[0], r[3], r[2], r[4], text))))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([digest("".join(x[k:k + 8])) for k in range(0, len(x), 8)])
    return levels


def siblings(levels, i):
    for x in levels[:-1]:
        first = i - i % 8
        yield "".join(x[first:i]), "".join(x[i + 1:first + 8])
        i //= 8


def tampered(r):
    return r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0


def brute(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        now = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]) if tampered(r) and r[1] is not None else r[1]
        groups[r[2]].append((r[0], leaf(r, r[1]), leaf(r, now)))
    trees = {}
    for g, nodes in groups.items():
        nodes.sort(key=lambda x: (x[0] is not None, x[0] or 0, *x[1:]))
        trees[g] = tree([x[1] for x in nodes])
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, (doc_id, own, now) in enumerate(groups[g]):
            path = [*siblings(trees[g], i), *siblings(top, k)]
            h = now
            for left, right in path:
                h = digest(left + h + right)
            out.append((doc_id, own, trees[g][-1][0], top[-1][0], digest("".join(a + b for a, b in path)), h, h == top[-1][0]))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*r, "g", "h", 1, 2, "p") for r in rows], SCHEMA).repartition(3)
    mark = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = [tuple(r) for r in merkle.verified_manifest(df, mark).collect()]
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=order) == sorted(brute(rows), key=order)
    return got


@pytest.mark.parametrize("sizes", [
    {"en": 1}, {"en": 600, "de": 8, "fr": 64, None: 65, "": 7},
    {f"l{k}": 1 + k % 3 for k in range(70)}])
def test_manifest(spark, sizes):
    texts = ["Some Text", None, "", "lower", "É ABC ß x", "Q" * 300_000]
    rows, k = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            k += 1
            rows.append((k * 37 % 1009, texts[k % 6 if k < 30 else k % 5], lang, [None, "s", "t"][k % 3], [None, 5][k % 2]))
    check(spark, rows)


def test_repeated_rows_and_null_ids(spark):
    rows = [(k % 5, f"T{k % 7}", "en", None, 1) for k in range(40)]
    rows += [(None, "A", "en", None, None), (None, "A", "en", None, None), (None, None, None, None, None)] + rows[:3]
    got = check(spark, rows)
    assert len(got) == len(rows)


def test_stretches_meet(spark, monkeypatch):
    """Windows of two runs: siblings and parents do not depend on the stretch."""
    monkeypatch.setattr(merkle, "SPAN", 16)
    monkeypatch.setattr(merkle, "_siblings", merkle._siblings.__wrapped__)
    check(spark, [(k, f"T{k}", "en", None, 1) for k in range(333)])


def test_only_changed_texts_fail(spark):
    rows = [(k, "Upper" if k % 2 else "lower", "en", None, 1) for k in range(100)]
    for r in check(spark, rows):
        assert r[-1] == (not (tampered((r[0],)) and r[0] % 2))


def test_empty(spark):
    assert merkle.verified_manifest(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []
