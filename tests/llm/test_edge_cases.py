"""Every query over awkward and over empty tables, and the pipeline as a whole."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tutorlake.llm import packing
import pytest

import corpus_pipeline
from tests.llm.conftest import prose
from tutorlake.llm.queries import QUERIES

COLUMNS = {
    "op2": "doc_id size text_crc32 law shard slot grown_shard",
    "op3": "doc_id piece start length ids_crc32 sequence_id offset",
    "op4": "doc_id held_out score predicted",
    "op5": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op6": "doc_id fingerprint component_id",
    "op7": "doc_id n_bytes n_tokens over_limit",
    "op8": "page_id payload_bytes payload_digest record_type refers_to",
    "op9": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op11": "word form root n n_near form_n",
    "op12": "doc_id n_shingles component_id kept",
    "op13": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op10": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
}


@pytest.mark.parametrize("name", QUERIES)
def test_awkward_tables(spark, table_dir, texts, name):
    rows = QUERIES[name](spark, table_dir)
    operator = name.split("_")[0]
    if operator in COLUMNS:
        assert rows.columns[: len(COLUMNS[operator].split())] == COLUMNS[operator].split()
    if operator not in ("op1", "op3", "op8", "op11"):
        assert rows.count() == len(texts)


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


def test_pipeline_stages(spark, table_dir, empty_dir, tmp_path):
    docs = spark.read.parquet(f"{table_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, table_dir).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    ids = {r[0] for r in seen["near-dedup"].select("doc_id").collect()}
    assert 42 in ids and 43 not in ids
    left = {r[0] for r in seen["decontamination"].select("doc_id").collect()}
    # 40, 41 and 42 shared the passage with the item; it was cut out before.
    assert left == {r[0] for r in seen["suffix-dedup"].select("doc_id").collect()}
    assert {r[0] for r in seen["packing"].select("doc_id").distinct().collect()} == left
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_words_of_one_lower_case_are_encoded_once(monkeypatch):
    encoder = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER))
    whole, asked = encoder.tokenizer, []
    texts = ["Erlystes erlystes ERLYSTES!", "erlystes.!? ΟΔΟΣ οδος Straße STRASSE İx ix", "Erlystes'S é.É ﬁn FIN,"]

    class Counted:
        def encode(self, word, **options):
            asked.append(word)
            return whole.encode(word, **options)

    encoder.tokenizer = Counted()
    monkeypatch.setattr(packing, "REMEMBERED", 8)
    for text in texts:
        assert encoder.text(text) == np.array(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert sum("erlystes" == word.lower() for word in asked) == 1


@pytest.mark.parametrize("at_once, asked, remembered", [(20_000, 256, 400_000), (3, 2, 5), (1, 1, 1), (7, 50, 12)])
def test_new_words_are_encoded_together(monkeypatch, at_once, asked, remembered):
    """The ids are those of the whole texts, and many new words take few calls of the tokenizer."""
    for name, value in (("AT_ONCE", at_once), ("ASKED", asked), ("REMEMBERED", remembered)):
        monkeypatch.setattr(packing, name, value)
    encoder = packing.WordEncoder(public_tokenizers.path(packing.TOKENIZER))
    whole, calls = encoder.tokenizer, []

    class Counted:
        def encode(self, words, **options):
            calls.append(words)
            return whole.encode(words, **options)

    plain = [prose(950 + k, 90) + f" made{'abcdefghij'[k % 10] * (k + 1)}" for k in range(30)]
    odd = [
        "", " ", "\n\n", "\t \x0b   x ", "it's IT'S 'S 's ''s d'd", "a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|>",
        "été ́a ́ x̧́", "한 가 한", "İx i̇x İİ ẞ ß ﬁn ǅ ª", "ΟΔΟΣ οδος ΣΣ. Σ",
        "3rd 1,234.5 x2y #tag$$$ a_b __", "中文 字 ñandú\r\nÉté.", "😀x👩‍👩‍👧 \U0001d400\U0001d401", "\x00a ﻿b c‍d", "." * 50,
    ]
    texts = plain + odd + plain[::-1] + odd[::-1]
    encoder.tokenizer = Counted()
    coded = list(encoder.texts(texts))
    assert coded == [np.array(whole.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    if at_once > 100:
        assert len(calls) < 80 < sum(len(c.split()) for c in calls)
