"""Operators against plain loops over the same rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash

import corpus_pipeline
from tests.llm.conftest import prose
from tutorlake.llm import decontamination, groups, lm_scoring, near_copies, packing, quality, sharding, simhash, suffix_dedup, token_counts, toxicity, warc
from tutorlake.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


# Sharding --------------------------------------------------------------------------------------


def test_shards_are_even_gapless_and_stable(spark):
    keys = spark.range(4000).selectExpr("id as doc_id", "7 as shard")
    placed = sharding.number_slots(sharding.shard_records(keys, "doc_id", [1.0] * 8), "doc_id", groups=16)
    rows = {r["doc_id"]: (r["shard"], r["slot"]) for r in placed.collect()}
    for shard in range(8):
        slots = sorted(p for s, p in rows.values() if s == shard)
        assert slots == list(range(len(slots))) and 400 < len(slots) < 600
    more = {r["doc_id"]: r["shard"] for r in sharding.shard_records(keys, "doc_id", [1.0] * 9).collect()}
    assert all(more[k] in (rows[k][0], 8) for k in rows)
    moved = sum(more[k] == 8 for k in rows)
    assert 350 < moved < 550


def test_shard_weights(spark):
    keys = spark.range(6000).selectExpr("id as doc_id")
    found = Counter(r["shard"] for r in sharding.shard_records(keys, "doc_id", [1.0, 2.0, 0.0, 3.0]).collect())
    assert found[2] == 0 and 850 < found[0] < 1150 and 1800 < found[1] < 2200
    with pytest.raises(ValueError):
        sharding.rendezvous(keys["doc_id"], [0.0])


# Packing and token counts ----------------------------------------------------------------------


def test_packing_round_trip(spark, table_dir, texts):
    from tokenizers import Tokenizer

    file = public_tokenizers.path(packing.TOKENIZER)
    tokenizer = Tokenizer.from_file(file)
    documents = spark.read.parquet(f"{table_dir}/documents.parquet").where("doc_id is not null and doc_id <> 48")
    cut = packing.pieces(documents, file, keep_ids=True)
    rows = packing.pack(cut, group=20).collect()
    by_doc = defaultdict(dict)
    for r in rows:
        assert len(r["ids"]) == r["length"] <= packing.LENGTH
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        by_doc[r["doc_id"]][r["piece"]] = r
    for key, text in texts:
        if key in (None, 48):
            continue
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        got = [by_doc[key][n] for n in range(len(by_doc[key]))]
        assert [i for r in got for i in r["ids"]] == want
        assert [r["start"] for r in got] == list(range(0, len(want), packing.LENGTH))
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.LENGTH
    whole = {r["sequence_id"]: len(r["ids"]) for r in packing.sequences(packing.pack(cut)).collect()}
    assert sum(whole.values()) == sum(r["length"] for r in rows)


@pytest.mark.parametrize("rule", ["residual", "product"])
def test_best_fit_holds_every_capacity(rule):
    draw = random.Random(3)
    lengths = np.array([draw.randint(1, 300) for _ in range(800)] + [300] * 5)
    limits = packing.Limits(tokens=300, documents=4, attention=60_000 + 30_000, rule=rule)
    sequence, offset = packing.best_fit(lengths, limits)
    for s in np.unique(sequence):
        own = lengths[sequence == s]
        assert own.sum() <= 300 and len(own) <= 4 and (own.astype(float) ** 2).sum() <= 90_000
        order = np.argsort(offset[sequence == s])
        assert offset[sequence == s][order].tolist() == [0, *np.cumsum(own[order])[:-1].tolist()]
    assert len(packing.best_fit(np.zeros(0, np.int64), limits)[0]) == 0
    with pytest.raises(ValueError):
        packing.best_fit(np.array([301]), limits)


def test_equal_pieces_are_dealt_over_all_groups(spark):
    rows = [(k, 0, 0, 1 + k % 50, k) for k in range(300)] + [(None, 0, 0, 7, 5)] * 500 + [(9, 1, 2048, 30, 6)] * 400
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long"
    seen = []
    for parts in (3, 5):
        cut = spark.createDataFrame(rows, fields).repartition(parts)
        numbers = Counter((r["doc_id"], r["ids_crc32"], r["__copy"]) for r in packing.numbered(cut).collect())
        assert set(numbers.values()) == {1} and len(numbers) == len(rows)
        packed = packing.pack(cut, group=60).collect()
        assert Counter(tuple(r)[:5] for r in packed) == Counter(rows)
        for equal in (5, 6):
            own = [r for r in packed if r["ids_crc32"] == equal and r["start"] in (0, 2048) and r["doc_id"] in (None, 9)]
            assert max(Counter(r["sequence_id"] >> 32 for r in own).values()) < 80
        seen.append(Counter(r["sequence_id"] for r in packed))
    assert seen[0] == seen[1]


@pytest.mark.parametrize("rule", ["residual", "product"])
def test_tokens_alone_close_a_sequence(rule):
    """Texts of one token each fill sequences of 2,048 tokens, not of fewer."""
    sequence, _ = packing.best_fit(np.ones(2 * packing.LENGTH, np.int64), packing.Limits(rule=rule))
    assert len(np.unique(sequence)) == 2


def test_prefix_counts_equal_the_library():
    import sentencepiece

    file = public_tokenizers.path(token_counts.MODEL)
    model, counter = sentencepiece.SentencePieceProcessor(model_file=file), token_counts.PrefixCounter(file)
    draw = random.Random(5)
    letters = "ab  \n\t<|>é☃中▁'.,ABCdefg019　\x85Σ"
    some = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(300)]
    some += [prose(k, 20) for k in range(20)] + ["", " ", "   ", "a" * 300, "<s> </s><unk>", "representation representations"]
    for text in some:
        assert counter.count(text) == len(model.encode(text)), text
    for text in some[::7]:
        assert counter.prefix_counts(text).tolist() == [len(model.encode(text[:k])) for k in range(len(text) + 1)]


def test_truncation(spark):
    import sentencepiece

    file = public_tokenizers.path(token_counts.MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=file)
    rows = [(1, prose(3, 40), "a"), (2, None, "b"), (3, "", "c"), (4, "x", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept_tokens string")
    for r in token_counts.truncate(frame, file, 25).collect():
        text = dict((k, t or "") for k, t, _ in rows)[r["doc_id"]]
        best = max(k for k in range(len(text) + 1) if len(model.encode(text[:k])) <= 25)
        assert r["text"] == text[:best] and r["kept_tokens"] == len(model.encode(text[:best]))
    full = token_counts.with_prefix_counts(frame, file).where("doc_id = 3").first()
    assert full["prefix_tokens"] == [0]


# Quality ---------------------------------------------------------------------------------------


def test_quality_counts(spark, table_dir, texts):
    for k, text in [*texts, (77, "a b c d e " * 300), (78, "x\n\nx\n x\nx")]:
        words = WORD.findall(text or "")
        windows = defaultdict(list)
        for i in range(len(words) - 4):
            windows[tuple(words[i : i + 5])].append(i)
        covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        expected = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
                    len(lines) - len(set(lines)), len(covered))
        texts_seen.append((k, text, expected))
    frame = spark.createDataFrame([(n, x[1], "en") for n, x in enumerate(texts_seen)], "doc_id long, text string, lang string")
    for r in quality.judge(frame).collect():
        expected = texts_seen[r["doc_id"]][2]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        assert r["base_failed"] == (expected[0] < 10 or 100 * expected[4] > 20 * expected[0])
        assert not (r["base_failed"] and r["kept"])


texts_seen: list = []


def test_divergence(spark):
    from pyspark.sql import functions as F

    for p, q in (([1, 0], [0, 1]), ([1, 2], [2, 4]), ([3, 1, 0], [1, 1, 5]), ([0, 0], [1, 1])):
        a, b = (F.array(*[F.lit(x).cast("long") for x in v]) for v in (p, q))
        got = spark.range(1).select(quality.jensen_shannon(a, b).alias("d")).first()["d"]
        if not sum(p):
            assert got is None or got == 0.0
            continue
        p, q = np.array(p) / sum(p), np.array(q) / sum(q)
        m = (p + q) / 2
        want = sum(0.5 * x * math.log2(x / y) for x, y in [*zip(p, m), *zip(q, m)] if x > 0)
        assert got == pytest.approx(math.sqrt(max(want, 0)), abs=1e-9)


def test_every_language_is_compared(spark):
    def row(k, n, lang):
        return k, " ".join(w.strip(",.\n") for w in prose(k, n).split()) + ".", lang

    rows = [row(k, 400, "xx") for k in range(80)] + [row(100 + k, 300, None) for k in range(40)] + [row(200, 150, "rare")]
    rows += [(300, " ".join(str(1000 + 7 * k) for k in range(60)), "xx"), (301, "QRS TUV " * 4 + "A B C D E F G H I J K L", None), (302, "1 2 3 4 5 6 7 8 9 0 1 2", "xx")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality.judge(frame).collect()}
    assert all(r["word_distance"] is None for r in got.values())
    classes = ("[A-Z]", "[0-9]", "[.!?…]", "[,;:]")

    def histogram(text):
        rare = [len(re.findall(c, text)) for c in classes] + [0]
        return np.array([*rare, sum(map(len, text.split())) - sum(rare)], float)

    assert sum(histogram(t).sum() for _, t, lang in rows if lang == "xx") >= quality.REFERENCE_CHARS
    for key, text, lang in rows:
        mine, usual = histogram(text), sum(histogram(t) for _, t, x in rows if lang != "xx" or x == "xx")
        p, q = mine / mine.sum(), usual / usual.sum()
        far = math.sqrt(sum(0.5 * x * math.log2(2 * x / (a + b)) for a, b in zip(p, q) for x in (a, b) if x > 0))
        found = got[key]["class_distance"]
        assert (found is None) == (mine.sum() < quality.GUARD_CHARS)
        assert found is None or found == pytest.approx(far, abs=1e-6)
    assert not got[300]["kept"] and not got[300]["base_failed"] and got[0]["kept"] and got[100]["kept"] and got[200]["kept"]
    assert got[302]["kept"] and not got[302]["base_failed"]  # too short for either distance


# SimHash ---------------------------------------------------------------------------------------


def slow_fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_golay_code_is_perfect():
    table = simhash.code_words()
    assert np.bincount(table).tolist() == [2048] * 4096


def test_fingerprints_and_classes(spark, texts, table_dir):
    from tutorlake.llm.queries import QUERIES

    rows = QUERIES["op6_simhash_golay"](spark, table_dir).collect()
    marks = Counter((k, f"{slow_fingerprint(x):016x}") for k, x in texts)
    assert Counter((r["doc_id"], r["fingerprint"]) for r in rows) == marks


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 2])
def test_components_of_close_fingerprints(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    draw = random.Random(4)
    base = [draw.getrandbits(64) for _ in range(12)] + [0]
    marks = []
    for b in base:
        for _ in range(25):
            flips = draw.sample(range(64), draw.randint(0, 4))
            marks.append(b ^ sum(1 << f for f in flips))
    marks += marks[:30]
    parent = list(range(len(marks)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(marks)):
        for b in range(a):
            if (marks[a] ^ marks[b]).bit_count() <= 2:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    frame = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in simhash.classes(frame).collect()}
    assert got == {k: root(k) for k in range(len(marks))}


def test_components_of_long_chains(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {(r["node"], r["root"]) for r in components(frame, "a", "b").collect()}
    assert got == {(k, 0) for k in range(61)} | {(100, 100), (101, 100)}


def slow_similarity(a, b):
    sets = []
    for text in (a, b):
        words = lower(text).encode().split()
        sets.append({tuple(words[n : n + 5]) for n in range(max(1, len(words) - 4))} if words else set())
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0


@pytest.mark.parametrize("tile", [near_copies.TILE, 5])
def test_planted_near_copies_go(spark, monkeypatch, tile):
    """All pairs of similarity 0.8 or more are found and no other: a recall of 1 over the planted copies."""
    monkeypatch.setattr(near_copies, "TILE", tile)
    draw = random.Random(6)
    texts = ["", " ", None, "one", "ONE", "one two three"]
    for base in range(12):
        words = prose(500 + base, draw.choice((40, 120, 400))).split()
        for _ in range(12):
            copy = list(words)
            for _ in range(draw.randint(0, 1 + len(words) // 40)):
                copy[draw.randrange(len(copy))] = f"w{draw.randrange(10**6)}"
            texts.append(" ".join(copy))
    parent = list(range(len(texts)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    near = 0
    for a in range(len(texts)):
        for b in range(a):
            if (similar := slow_similarity(texts[a], texts[b])) >= 0.8:
                near += similar < 1
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert near > 100
    rows = [(k, x, "en", "s", 1) for k, x in enumerate(texts)] + [(9, texts[9], "en", "s", 1), (None, texts[9], "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    first = [k for k in range(len(texts)) if root(k) == k]
    assert sorted(left, key=str) == sorted([*first, None, *[9] * (root(9) == 9)], key=str)


def test_near_copies_by_fingerprint_go_too(spark):
    """Texts within two bits go though their sets differ, and classes of both kinds that share a document are one."""
    texts = {90: None, 91: " ", 92: prose(990, 60)}
    # By order of the keys: near the middle one by sets alone, the middle one, near it by fingerprint alone.
    orders = [(10, 11, 12), (21, 22, 20), (32, 30, 31), (42, 41, 40)]
    for n, (sets, middle, mark) in enumerate(orders):
        said = " ".join(prose(900 + n, 41).split()) + " "
        tail, other = prose(910 + n, 30), prose(920 + n, 30)
        texts |= {sets: said + tail, middle: said * 60 + tail, mark: said * 60 + other}
        fp = [simhash.fingerprint(texts[k].encode()) for k in (sets, middle, mark)]
        assert (fp[0] ^ fp[1]).bit_count() > 2 and (fp[0] ^ fp[2]).bit_count() > 2 >= (fp[1] ^ fp[2]).bit_count()
        assert slow_similarity(texts[sets], texts[middle]) >= 0.8
        assert max(slow_similarity(texts[mark], texts[k]) for k in (sets, middle)) < 0.8
    docs = spark.createDataFrame([(k, x, "n") for k, x in texts.items()], "doc_id long, text string, node string")
    left = near_copies.first_of_each(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {10, 20, 30, 40, 90, 92}


def test_near_copies_of_repeated_keys_are_one(spark):
    """Rows of one key join the classes of all its texts."""
    said = [prose(930 + n, 60) for n in range(3)]
    rows = [(1, said[0]), (5, said[0]), (5, said[1]), (7, said[1]), (8, said[2]), (None, said[2])]
    left = near_copies.first_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {tuple(r) for r in left.collect()} == {(1, said[0]), (8, said[2]), (None, said[2])}


@pytest.mark.parametrize("bits", [groups.FILTER_BITS, 64])
def test_rows_that_stay_are_not_shuffled(spark, monkeypatch, bits):
    """Only texts that may go meet the keys of those that do; all others stay where they are read."""
    monkeypatch.setattr(groups, "FILTER_BITS", bits)
    docs = spark.createDataFrame([(k if k % 7 else None, f"t{k}") for k in range(60)], "doc_id long, text string")
    gone = spark.createDataFrame([(k,) for k in range(0, 60, 3)], "doc_id long")
    left = groups.without(docs, gone, "doc_id")
    assert left.columns == docs.columns
    assert sorted(map(str, left.collect())) == sorted(map(str, docs.join(gone, "doc_id", "left_anti").collect()))
    plan = near_copies.first_of_each(docs)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    anti = next(at for at, line in enumerate(plan) if "Join LeftAnti" in line)
    assert "Union" in plan[0] and any("__bits" in line for line in plan[anti + 1 : anti + 4])


# Suffix arrays ---------------------------------------------------------------------------------


def test_suffix_array():
    draw = random.Random(6)
    for turn in range(150):
        text = bytes(draw.choice(b"ab\x00c") for _ in range(draw.randint(0, 120)))
        text = (text[:5] * 30)[: len(text)] if turn % 3 == 0 else text
        assert suffix_dedup.suffix_array(text, 500).tolist() == sorted(range(len(text)), key=lambda k: text[k:])


def slow_removal(bodies, length):
    starts = defaultdict(list)
    for k, body in enumerate(bodies):
        for at in range(len(body) - length + 1):
            starts[body[at : at + length]].append((k, at))
    gone = [bytearray(len(b)) for b in bodies]
    for places in starts.values():
        if len(places) > 1:
            for k, at in places:
                gone[k][at : at + length] = b"\x01" * length
    return gone


@pytest.mark.parametrize("hulls", [suffix_dedup.HULLS, 1])
def test_repeated_strings(spark, table_dir, texts, monkeypatch, hulls):
    from tutorlake.llm.queries import QUERIES

    monkeypatch.setattr(suffix_dedup, "HULLS", hulls)
    bodies = [(x or "").encode() for _, x in texts]
    expected = Counter()
    for (key, _), body, gone in zip(texts, bodies, slow_removal(bodies, suffix_dedup.LENGTH), strict=True):
        kept = bytes(c for c, g in zip(body, gone, strict=True) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        expected[key, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert Counter(map(tuple, QUERIES["op9_suffix_array_dedup"](spark, table_dir).collect())) == expected


# Decontamination -------------------------------------------------------------------------------


def slow_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, e in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != e)))
        row = new
    return min(row)


def test_edited_items_are_found(spark):
    draw = random.Random(8)
    items = [(k, prose(500 + k, 25)) for k in range(6)]
    rows = []
    for n in range(40):
        body = list(items[n % 6][1])
        for _ in range(draw.randint(0, len(body) // 7)):
            at = draw.randrange(len(body))
            body[at : at + draw.randint(0, 1)] = draw.choice(["", "q", " ", "é"])
        rows.append((n, f"{prose(n, 20)} {''.join(body)} {prose(50 + n, 20)}"))
    rows += [(90, None), (91, ""), (92, items[0][1].upper().replace(" ", "--"))]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in decontamination.matches(documents, benchmark).collect()}
    for key, text in rows:
        for number, item in items:
            plain_item, plain_text = decontamination.plain(item), decontamination.plain(text)
            distance = slow_distance(plain_item, plain_text) if plain_text else 999
            found = got.get((key, number))
            assert (found["distance"] if found else None) == (
                distance if distance <= decontamination.budget(plain_item) else None
            )
            if found and distance == 0:
                assert decontamination.plain(text[found["start"] : found["end"]]) == plain_item
    left = {r["doc_id"] for r in decontamination.clean(documents, benchmark).collect()}
    assert left == {k for k, _ in rows} - {k for k, _ in got}


def test_benchmark_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 200)
    items = [(k, prose(700 + k, 15)) for k in range(9)]
    documents = spark.createDataFrame([(k, f"x {t} y") for k, t in items], "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.matches(documents, benchmark).collect()} >= {
        (k, k) for k, _ in items
    }
    documents = documents.union(spark.createDataFrame([(77, prose(77, 15)), (78, None)], documents.schema))
    assert {r["doc_id"] for r in decontamination.clean(documents, benchmark).collect()} == {77, 78}


def test_short_items_are_found_at_whole_words(spark, texts):
    items = [(1, "one"), (2, "Kan"), (3, "ra, st"), (4, "ñandú 中文"), (5, "ab ab ab ab"), (6, "an"), (7, "kan"), (8, " .,"), (9, None)]
    items += [(10 + n, " ".join(prose(100 + n, 30).split()[3 : 4 + n % 4])) for n in range(16)]
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.matches(documents, benchmark).collect()
    plain, bodies = decontamination.plain, Counter(texts)
    want = Counter()
    for (key, text), times in bodies.items():
        for number, item in items:
            if plain(item) and f" {plain(item)} " in f" {plain(text)} ":
                want[key, number] += times
    assert Counter((r["doc_id"], r["item_id"]) for r in found) == want and len(want) > 20
    by_key = dict(texts)
    for r in found:
        if r["doc_id"] != 48:
            assert plain(by_key[r["doc_id"]][r["start"] : r["end"]]) == plain(dict(items)[r["item_id"]])
    # Short items let no document go, unless that is asked for.
    assert decontamination.clean(documents, benchmark).count() == len(texts)
    gone = decontamination.clean(documents, benchmark, min_words=1).count()
    assert gone == sum(n for (k, t), n in bodies.items() if not any(f" {plain(i)} " in f" {plain(t)} " for _, i in items if plain(i)))


# Toxicity --------------------------------------------------------------------------------------


def test_index_finds_the_nearest():
    draw = np.random.default_rng(2)
    weights = np.where(draw.random((300, 12)) < 0.3, draw.random((300, 12)), 0)
    weights /= np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-9)
    index = toxicity.BlockMaxIndex(weights, block=16)
    for _ in range(40):
        terms = np.sort(draw.choice(12, 4, replace=False))
        query = draw.random(4)
        query /= np.linalg.norm(query)
        cosines = np.round(weights[:, terms] @ query, 12)
        want = [k for k in np.lexsort((np.arange(300), -cosines)) if cosines[k] > 0][:25]
        got, values = index.nearest(terms, query, 25)
        assert np.allclose(values, cosines[want], atol=1e-9)
        assert set(got[values > values[-1] + 1e-9]) == {k for k in want if cosines[k] > values[-1] + 1e-9}


def test_isotonic_steps_rise():
    votes, chances = toxicity.isotonic(np.array([0.1, 0.2, 0.2, 0.5, 0.9, 0.9]), np.array([0, 1, 0, 0, 1, 1]))
    assert (np.diff(chances) > 0).all() and (np.diff(votes) > 0).all()


def test_toxic_words_are_learned(spark):
    draw = random.Random(1)
    rows, labels = [], []
    for k in range(1500):
        toxic = k % 5 == 0
        words = [draw.choice(WORDS_) for _ in range(40)]
        if toxic:
            words[draw.randrange(40)] = draw.choice(("vile", "nasty"))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    rows += [(5000, None), (5001, "")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(documents, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scored = {r["doc_id"]: r for r in toxicity.score(documents, model, evidence=3).collect()}
    held = [k for k, _ in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    right = sum((scored[k]["score"] >= 0.5) == (k % 5 == 0) for k in held)
    assert right >= 0.95 * len(held)
    assert scored[5000]["score"] == scored[5001]["score"] < 0.5
    assert all(zlib.crc32(str(key).encode()) % 5 for key in model.keys)
    assert all(e["toxic"] == 1 for e in scored[5]["evidence"])


WORDS_ = [f"w{k}" for k in range(80)]


# Language model --------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [lm_scoring.CHUNK_BYTES, 3000])
def test_scores_equal_a_plain_model(spark, table_dir, texts, monkeypatch, size):
    from tutorlake.llm.queries import QUERIES

    monkeypatch.setattr(lm_scoring, "CHUNK_BYTES", size)
    monkeypatch.setattr(lm_scoring, "RANGE_BYTES", size)
    held = {k: k is not None and zlib.crc32(str(k).encode()) % 10 == 0 for k, _ in texts}
    all_tokens = [(k, [*WORD.findall(lower(x)), None]) for k, x in texts]
    single, double, trained = Counter(), Counter(), 0
    for k, words in all_tokens:
        if not held[k]:
            single.update(words)
            double.update(zip(["<start>", *words], words, strict=False))
            trained += 1
    total, kinds = sum(single.values()), len(single)
    context = lambda h: trained if h == "<start>" else single[h]
    group = lambda n: int(lm_scoring.count_class(np.array([n]))[0])
    once, mass = Counter(), Counter()
    for (before, _), n in double.items():
        mass[group(context(before))] += n
        once[group(context(before))] += n == 1
    rest = lambda h: (once[group(context(h))] + 0.5) / (mass[group(context(h))] + 1)
    base = lambda w: math.log10((single[w] + 0.1) / (total + 0.1 * (kinds + 1)))

    def chance(before, word):
        if not context(before):
            return base(word)
        n, share = double[before, word], rest(before)
        return math.log10((1 - share) * n / context(before) + share * 10 ** base(word)) if n else math.log10(share) + base(word)

    want = sorted(
        (str(k), held[k], len(words), sum(single[w] > 0 for w in words), total, round(sum(map(base, words)), 6),
         round(sum(chance(a, b) for a, b in zip(["<start>", *words], words, strict=False)), 6))
        for k, words in all_tokens if k is not None
    )
    got = sorted(
        (str(r[0]), *r[1:5], round(r[5], 6), round(r[6], 6))
        for r in QUERIES["op5_backoff_automaton"](spark, table_dir).collect() if r[0] is not None
    )
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[5] - w[5]) < 1e-5 and abs(g[6] - w[6]) < 1e-5 for g, w in zip(got, want, strict=True))


# WARC ------------------------------------------------------------------------------------------


def test_warc_round_trip(spark, table_dir, tmp_path):
    from tutorlake.llm.queries import QUERIES

    pages = spark.read.parquet(f"{table_dir}/pages.parquet")
    for compression in ("none", "gzip"):
        path = f"{tmp_path}/{compression}"
        warc.write(warc.captures_of(pages), path, compression)
        records = warc.read(spark, path)
        rows = warc.assemble(records).collect()
        assert len(rows) == 7 and all(len(r["requests"]) == len(r["metadata"]) == 1 for r in rows)
        found = {r["metadata"][0]["fields"].get("page-id"): r["response"] for r in rows}
        assert bytes(found["4"]["payload"]) == b"a\r\n\r\nWARC/1.1\r\n" and found["4"]["target_uri"] == "w%0D%0AX: 1"
        assert found["3"]["target_uri"] is None
    rows = sorted(map(tuple, QUERIES["op8_warc_transactions"](spark, table_dir).collect()), key=str)
    kinds = {(r[0], r[3], r[4]) for r in rows}
    assert kinds == {
        (1, "response", None), (2, "revisit", 1), (3, "response", None), (4, "response", None),
        (5, "revisit", 3), (7, "response", None), (7, "revisit", 7),
    }
    import base64

    for r in rows:
        payload = {1: b"x" * 50, 2: b"x" * 50, 3: b"", 4: b"a\r\n\r\nWARC/1.1\r\n", 5: b"", 7: "é".encode() * 9}[r[0]]
        assert r[1:3] == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())


def test_warc_small_payloads_are_never_revisits(spark, table_dir):
    pages = spark.read.parquet(f"{table_dir}/pages.parquet")
    rows = {(r["page"], r["type"]) for r in warc.captures_of(pages, least=20).collect()}
    assert (5, "response") in rows and (2, "revisit") in rows


def test_broken_archives_are_refused():
    with pytest.raises(ValueError):
        list(warc.parse(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.parse(b"nothing"))


@pytest.mark.parametrize("name", ["op8_warc_transactions", "op10_quality_divergence"])
def test_queries_match_their_sql(spark, table_dir, sf_dir, name):
    import duckdb

    from tutorlake.llm.queries import ORACLES, QUERIES

    connection = duckdb.connect()
    for table in ("documents", "pages"):
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    cursor = connection.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    got = sorted((tuple(r) for r in QUERIES[name](spark, sf_dir).select(*columns).collect()), key=str)
    assert got == sorted(cursor.fetchall(), key=str)


def test_passages_of_some_fifty_words_go(spark):
    """Passages of 51 to 60 words that stand in several documents go, texts without repeats stay as they are."""
    draw = random.Random(21)
    passages = [" ".join(prose(700 + k, 51 + k).split()) for k in range(10)]
    assert min(map(len, passages)) >= corpus_pipeline.PASSAGE
    rows = [(k, f"{prose(800 + k, 60)} {passages[k % 10]} {prose(900 + k, draw.randint(0, 60))}") for k in range(30)]
    rows += [(100 + k, prose(1000 + k, 150)) for k in range(10)] + [(200, None), (201, "")]
    docs = spark.createDataFrame([(k, x, "en", "s", 1) for k, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    assert not any(p in left[k] for k in range(30) for p in passages)
    # What is left of a passage is less than a window at either end.
    assert all(len(left[k]) <= len(x) - len(passages[k % 10]) + 2 for k, x in rows[:30])
    assert all(left[k] == x for k, x in rows[30:])
