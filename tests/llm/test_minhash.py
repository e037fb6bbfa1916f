"""Near-duplicates by signatures against comparisons of all pairs."""

from __future__ import annotations

import random
import re

import numpy as np

from tests.llm.conftest import prose
from tutorlake.llm import groups, minhash


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    width = min(4, len(words))
    return frozenset(" ".join(words[k : k + width]) for k in range(len(words) - width + 1))


def plain_classes(rows):
    """Component of every row with a key, by comparing all pairs."""
    sets = [plain_set(x) for _, x in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            shared = len(sets[a] & sets[b])
            if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                root[top(a)] = top(b)
    least = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            least[top(k)] = min(least.get(top(k), key), key)
    return [(key, len(sets[k]), least.get(top(k)) if key is not None else None) for k, (key, _) in enumerate(rows)]


def copies(seed=1, count=60):
    """Copies of two texts with so many changed words that some are near each other, some over others, some not at all."""
    draw = random.Random(seed)
    rows = []
    for base in range(2):
        words = prose(50 + base, 200).split()
        for _ in range(count // 2):
            changed = list(words)
            for _ in range(draw.choice([0, 1, 2, 3, 4, 5, 8])):
                changed[draw.randrange(len(changed))] = f"x{draw.randrange(1000)}"
            rows.append((len(rows), " ".join(changed)))
    return rows + [(len(rows) + k, prose(200 + k, 80)) for k in range(10)]


def classes(frame):
    return sorted((tuple(r) for r in minhash.near_duplicates(frame).collect()), key=str)


def test_classes_are_those_of_all_pairs(spark):
    rows = copies()
    expected = plain_classes(rows)
    assert len({c for _, _, c in expected}) > 14
    frame = spark.createDataFrame([(k, x, "g", 1) for k, x in rows], "doc_id long, text string, group string, n int")
    assert classes(frame) == sorted(expected, key=str)


def test_tiles_change_nothing(spark, monkeypatch):
    rows = copies(2)
    monkeypatch.setattr(minhash, "TILE", 6)
    monkeypatch.setattr(groups, "TILE_BYTES", 8000)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert classes(frame) == sorted(plain_classes(rows), key=str)


def test_close_signatures_share_a_key(spark):
    draw = np.random.default_rng(5)
    rows = []
    for k in range(40):
        one = draw.integers(0, 1 << 16, 60).astype("<u2")
        other = one.copy()
        other[draw.choice(60, 23, replace=False)] ^= 1
        rows += [(k, one.tobytes()), (k, other.tobytes())]
    frame = spark.createDataFrame([(k, bytearray(x)) for k, x in rows], "pair int, index binary")
    keys = [set(r["keys"]) for r in frame.select("pair", minhash.index_keys().alias("keys")).orderBy("pair").collect()]
    assert all(a & b for a, b in zip(keys[::2], keys[1::2], strict=True))
    assert not keys[0] & keys[2]


def test_query_on_awkward_rows(spark, table_dir, texts):
    found = sorted((tuple(r) for r in minhash.op12_minhash_multi_index(spark, table_dir).collect()), key=str)
    assert found == sorted(((*r, r[0] == r[2]) for r in plain_classes(texts)), key=str)


def test_query_on_given_rows(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(tuple(r) for r in minhash.op12_minhash_multi_index(spark, sf_dir).collect())
    assert found == sorted((*r, r[0] == r[2]) for r in plain_classes(rows))
