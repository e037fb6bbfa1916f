from __future__ import annotations

import random

import pytest

WORDS = [a + b for a in ("ka", "lo", "mi", "ru", "te", "so", "pa", "ne") for b in ("n", "ra", "st", "vi", "do", "lum")]


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(("", "", "", ",", ".\n")) for _ in range(words))


@pytest.fixture(scope="session")
def texts() -> list[tuple[int | None, str | None]]:
    """Null, empty, blank, short, very long, repeated, near-equal and non-ASCII texts; a repeated row, a null key."""
    shared = prose(1, 110)
    rows: list[tuple[int | None, str | None]] = [(k, prose(100 + k, 60 + 9 * k)) for k in range(20)]
    rows += [
        (30, None), (31, ""), (32, " \t\n"), (33, "one"), (34, "one two"), (35, "ÀÉ ñandú 中文 Σς　x"),
        (40, f"{prose(7, 30)} {shared} {prose(8, 30)}"), (41, f"{prose(9, 10)} {shared} {prose(10, 50)}"),
        (42, shared), (43, shared), (44, "ab " * 400), (45, prose(11, 4000)),
        (46, prose(12, 90)), (47, prose(12, 90) + " end"), (48, prose(13, 80)), (48, prose(13, 80)), (None, prose(14, 90)),
    ]
    return rows


@pytest.fixture(scope="session")
def table_dir(spark, texts, tmp_path_factory) -> str:
    """The given tables at a small size: documents as in ``texts``, labels, benchmark and pages."""
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(k, x, "en" if (k or 0) % 3 else None, "s", 7) for k, x in texts]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(k, 1, int(k % 5 == 0)) for k in range(20)] + [(3, 1, None), (None, 0, 1), (999, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    items = [(0, prose(1, 110)[100:300]), (1, None), (2, ""), (3, "too short"), (4, prose(900, 30))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    pages = [(1, "u", "x" * 50), (2, "v", "x" * 50), (3, None, None), (4, "w\r\nX: 1", "a\r\n\r\nWARC/1.1\r\n"),
             (5, "", ""), (7, "z", "é" * 9), (7, "z", "é" * 9)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return path


@pytest.fixture(scope="session")
def empty_dir(spark, table_dir, tmp_path_factory) -> str:
    path = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "benchmark", "pages"):
        spark.read.parquet(f"{table_dir}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    return path
