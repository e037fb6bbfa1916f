"""Runs of words against plain loops, and the query over whole tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tutorlake.llm import periodic_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def without(words, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in drop]


def drawn(seed):
    draw = random.Random(seed)
    words = [b"%d" % draw.randrange(draw.choice([1, 2, 2, 3, 5, 50])) for _ in range(draw.choice([0, 1, 5, 6, 7, 20, 60, 200]))]
    for _ in range(draw.randint(0, 3) if len(words) > 10 else 0):
        a, p = draw.randrange(len(words)), draw.randint(1, len(words) // 5)
        for i in range(a, min(len(words), a + draw.randint(1, len(words)))):
            words[i] = words[a + (i - a) % p]
    return words


def test_runs_are_those_of_a_plain_loop():
    for seed in range(0, 300, 6):
        texts = [drawn(seed + k) for k in range(6)] + [drawn(seed)]
        for words, (runs, kept) in zip(texts, periodic_runs.worked(texts), strict=True):
            expected = plain_runs(words)
            assert [tuple(r) for r in runs.tolist()] == expected
            assert kept == b" ".join(without(words, expected))


def test_common_extensions():
    draw = np.random.default_rng(3)
    text = np.concatenate([np.tile(draw.integers(1, 3, 40), 5), draw.integers(1, 3, 100), [9]])
    left, right = (draw.integers(0, len(text) - 1, 2000) for _ in range(2))
    left, right = np.minimum(left, right)[left != right], np.maximum(left, right)[left != right]
    plain = [next(k for k in range(len(text)) if text[a + k] != text[b + k]) for a, b in zip(left, right, strict=True)]
    assert periodic_runs.CommonExtensions(text).of(left, right).tolist() == plain


def test_portions_change_nothing(monkeypatch):
    texts = [drawn(k) for k in range(40)] + [[b"a", b"b"] * 500]
    whole = periodic_runs.worked(texts)
    monkeypatch.setattr(periodic_runs, "TRIED", 50)
    for (a, x), (b, y) in zip(whole, periodic_runs.worked(texts), strict=True):
        assert a.tolist() == b.tolist() and x == y


def expected_row(key, text):
    words = WORD.findall(text or "")
    n, check = len(words), zlib.crc32(str(key).encode())
    if key is not None and check % 10 == 0 and n:
        g = check // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in
               ("".join(f"{s},{k},{q}\n" for s, k, q in runs), " ".join(without(words, runs)))]
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    return (key, len(runs), *best, *digests)


def test_query_on_awkward_rows(spark, table_dir, texts):
    found = sorted(map(str, (tuple(r) for r in periodic_runs.op13_periodic_runs(spark, table_dir).collect())))
    assert found == sorted(str(expected_row(k, x)) for k, x in texts)


def test_query_on_given_rows(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = sorted(tuple(r) for r in periodic_runs.op13_periodic_runs(spark, sf_dir).collect())
    assert found == sorted(expected_row(*r) for r in rows)
    assert any(r[1] > 1 for r in found)


def test_other_columns_and_bounds(spark):
    rows = spark.createDataFrame([(1, "x " * 6, "r"), (2, "x " * 5, "s"), (None, None, None)], "runs long, text string, collapsed string")
    found = {r["runs_key"]: r for r in periodic_runs.periodic_runs(rows.withColumnRenamed("runs", "runs_key"), "runs_key").collect()}
    assert found[1]["collapsed"] == "x" and tuple(found[1]["runs"][0]) == (0, 6, 1)
    assert found[2]["runs"] == [] and found[None]["collapsed"] == ""
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(rows, times=3)
