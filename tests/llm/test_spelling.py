"""Spelling variants against plain loops over the same words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

from tutorlake.llm import spelling


def plain_counts(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            check = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if check % 97 == 0:
                at = check % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts):
    holders = defaultdict(set)
    for word in counts:
        for k in range(len(word) + 1):
            holders[word[:k] + word[k + 1 :]].add(word)
    near = defaultdict(set)
    for group in holders.values():
        for a in group:
            near[a].update(b for b in group if one_apart(a, b))
    forms = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best is not None and counts[best] >= 2 * n else None
    rows = set()
    for word, n in counts.items():
        root = word
        while forms[root]:
            root = forms[root]
        rows.add((word, forms[word], root, n, len(near[word]), counts[forms[word]] if forms[word] else None))
    return rows


def found(frame):
    rows = [tuple(r) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_pairs_are_complete(spark):
    draw = random.Random(4)
    words = {"".join(draw.choice("abÿz") for _ in range(draw.randint(4, 8))) for _ in range(500)}
    words |= {"a" * k for k in range(4, 12)} | {"ba" * k for k in range(2, 6)} | {"q" * 300, "q" * 301, "q" * 150 + "r" + "q" * 150}
    frame = spark.createDataFrame([(w, draw.randint(3, 40)) for w in words], "word string, n long")
    pairs = [tuple(r) for r in spelling.near_words(frame).collect()]
    plain = {(a, b) for a in words for b in words if a < b and one_apart(a, b)}
    assert {tuple(sorted(p)) for p in pairs} & plain == plain
    real = [tuple(sorted(p)) for p in pairs if p[1] in words]
    assert len(real) == len(plain)


def test_variants_are_those_of_a_plain_loop(spark):
    draw = random.Random(5)
    words = {"".join(draw.choice("abc") for _ in range(draw.randint(5, 7))): 3 * 2 ** draw.randint(0, 6) for _ in range(400)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long").selectExpr("*", "word as near", "n as position")
    assert found(spelling.variants(frame)) == plain_variants(words)


def test_query_on_awkward_rows(spark, table_dir, texts):
    assert found(spelling.op11_trie_frontier(spark, table_dir)) == plain_variants(plain_counts(texts))


def test_query_on_given_rows(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    expected = plain_variants(plain_counts(rows))
    assert found(spelling.op11_trie_frontier(spark, sf_dir)) == expected
    assert any(r[1] and r[1] != r[2] for r in expected)
