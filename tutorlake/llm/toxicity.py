"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples live in an inverted index: per term a list of (example, weight), cut into blocks of examples,
with the largest weight of every block. A query adds up the block maxima of its terms, visits blocks from
the most promising on, and stops when no block left can beat the worst of its best examples. That gives
the same neighbours as comparing with every example. Neighbours vote with their cosine; the share of
toxic votes becomes a probability by isotonic regression on labelled rows that are not examples.

What is fitted is bounded: ``EXAMPLES`` rows of each label, ``CALIBRATION`` rows, ``TERMS`` terms. The
terms are those that differ most between the labels by a chi-square test. Their document frequencies
are counted over all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlake.sources.tables import settle

EXAMPLES = 2048
CALIBRATION = 8192
TERMS = 256
LEAST_CHI_SQUARE = 30.0
NEIGHBOURS = 25
BLOCK = 64
REMEMBERED = 200_000
FOLDS = 5

_KEPT = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes | None) -> Counter:
    """Term counts: runs of letters, digits and non-ASCII bytes, ASCII capitals as small letters."""
    return Counter((text or b"").lower().translate(_KEPT).split())


class BlockMaxIndex:
    """Examples as unit vectors, by term and block; ``weights`` has a row per example."""

    def __init__(self, weights: np.ndarray, block: int = BLOCK) -> None:
        self.size, self.block = len(weights), block
        blocks = -(-len(weights) // block)
        self.most = np.zeros((weights.shape[1], blocks))
        self.lists: list[list[tuple[np.ndarray, np.ndarray]]] = []
        for term in range(weights.shape[1]):
            column = weights[:, term]
            lists = []
            for b in range(blocks):
                part = column[b * block : (b + 1) * block]
                places = np.nonzero(part)[0]
                lists.append((places, part[places]))
                self.most[term, b] = part.max(initial=0)
            self.lists.append(lists)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``(examples, cosines)`` of the ``k`` best with a cosine above 0; of equal ones the lowest numbers."""
        bounds = weights @ self.most[terms] + 1e-12
        best, cosines = np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 1e-12 or (len(best) == k and bounds[b] < cosines[-1]):
                break
            sums = np.zeros(self.block)
            for term, weight in zip(terms, weights, strict=True):
                places, values = self.lists[term][b]
                sums[places] += weight * values
            found = np.nonzero(sums > 0)[0]
            best = np.concatenate([best, found + b * self.block])
            cosines = np.concatenate([cosines, np.round(sums[found], 12)])
            order = np.lexsort((best, -cosines))[:k]
            best, cosines = best[order], cosines[order]
        return best, cosines


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(votes, probabilities)``: the non-decreasing steps that fit the labels best, smoothed by one half."""
    steps: list[list[float]] = []
    for vote, label in sorted(zip(votes.tolist(), labels.tolist(), strict=True)):
        if steps and steps[-1][0] == vote:
            steps[-1][1] += label
            steps[-1][2] += 1
        else:
            steps.append([vote, float(label), 1.0, vote])
    merged: list[list[float]] = []
    for step in steps:
        merged.append(step)
        while len(merged) > 1 and merged[-2][1] / merged[-2][2] >= merged[-1][1] / merged[-1][2]:
            last = merged.pop()
            merged[-1][1] += last[1]
            merged[-1][2] += last[2]
            merged[-1][3] = last[3]
    return (
        np.array([(s[0] + s[3]) / 2 for s in merged]),
        np.array([(s[1] + 0.5) / (s[2] + 1) for s in merged]),
    )


@dataclass
class Model:
    """Terms with their inverse document frequencies, the examples, and the calibration."""

    terms: dict[bytes, int]
    idf: np.ndarray
    index: BlockMaxIndex
    keys: list
    labels: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]
    without_terms: float
    neighbours: int = NEIGHBOURS

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        terms = np.array(sorted(counts), np.int64)
        weights = np.array([1 + math.log(counts[t]) for t in terms]) * self.idf[terms]
        return terms, weights / max(math.sqrt((weights**2).sum()), 1e-300)

    def counts(self, text: bytes | None) -> dict[int, int]:
        found = terms_of(text)
        return {n: found[t] for t, n in self.terms.items() if t in found}

    def vote(self, counts: dict[int, int]) -> tuple[float | None, np.ndarray, np.ndarray]:
        """The toxic share of the neighbours' votes; None for a text without any of the terms."""
        if not counts or not self.index.size:
            return None, np.zeros(0, np.int64), np.zeros(0)
        best, cosines = self.index.nearest(*self.vector(counts), self.neighbours)
        if not len(best):
            return None, best, cosines
        return float((cosines * self.labels[best]).sum() / cosines.sum()), best, cosines

    def probability(self, vote: float | None) -> float:
        if vote is None or not len(self.steps[0]):
            return self.without_terms
        return float(np.interp(vote, *self.steps))


def fold(key: Column, folds: int = FOLDS) -> Column:
    """The remainder of the CRC-32 of the key as text; fold 0 is held out."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(folds))


def _sample(labels: DataFrame, key: str, label: str) -> DataFrame:
    """Examples of both labels and calibration rows, at most ``2 * EXAMPLES + CALIBRATION``, by hash order."""
    one = labels.where(F.col(label).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    one = one.withColumn("__order", F.xxhash64(key))

    def first(rows: DataFrame, count: int) -> DataFrame:
        return rows.orderBy("__order", key).limit(count)

    for_calibration = F.pmod(F.xxhash64(key, F.lit(5)), F.lit(2)) == 0
    parts = [first(one.where(~for_calibration & (F.col("label") == y)), EXAMPLES) for y in (0, 1)]
    examples = parts[0].union(parts[1]).withColumn("example", F.lit(True))
    return examples.union(first(one.where(for_calibration), CALIBRATION).withColumn("example", F.lit(False))).drop(
        "__order"
    )


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from the labelled rows of all folds but the first.

    Of several labels of a key the highest counts; null labels, labels without a document and documents
    without a label play no part. Without usable rows every text scores one quarter.
    """
    trained = _sample(labels.where(fold(F.col(key)) != 0), key, label)
    body = documents.select(F.col(key), F.col(text).cast("binary").alias("__text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms_of(x) for x in batch.column(3).to_pylist()]
            terms = pa.array([[t.decode("utf-8", "replace") for t in c] for c in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], terms, pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))],
                names=[key, "label", "example", "terms", "counts"],
            )

    # The sample is at most 2 * EXAMPLES + CALIBRATION rows of key, label and flag: under 1 MB.
    rows = body.join(F.broadcast(trained), key).select(key, "label", "example", "__text").mapInArrow(
        counted,
        T.StructType(
            [
                documents.schema[key],
                T.StructField("label", T.IntegerType()),
                T.StructField("example", T.BooleanType()),
                T.StructField("terms", T.ArrayType(T.StringType())),
                T.StructField("counts", T.ArrayType(T.IntegerType())),
            ]
        ),
    )
    rows = settle(rows, "labelled")
    examples = rows.where("example")
    size = {r["label"]: r["n"] for r in examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = F.lit(float(size.get(1, 0))), F.lit(float(size.get(0, 0)))
    a, b = F.sum("label").cast("double"), F.sum(1 - F.col("label")).cast("double")
    everyone = toxic + clean
    chosen = (
        examples.select("label", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(a.alias("a"), b.alias("b"))
        .withColumn("cross", F.col("a") * (clean - F.col("b")) - F.col("b") * (toxic - F.col("a")))
        .withColumn("seen", F.col("a") + F.col("b"))
        .withColumn("below", toxic * clean * F.col("seen") * (everyone - F.col("seen")))
        .select("term", F.when(F.col("below") > 0, everyone * F.col("cross") ** 2 / F.col("below")).alias("chi"))
        .where(F.col("chi") >= LEAST_CHI_SQUARE)
        .orderBy(F.desc("chi"), "term")
        .limit(TERMS)
    )
    terms = {r["term"].encode(): n for n, r in enumerate(chosen.collect())}
    total, seen = _document_frequencies(body, terms)
    idf = np.log((1 + total) / (1 + seen)) + 1e-6

    kept = F.filter(F.arrays_zip("terms", "counts"), lambda x: x["terms"].isin(*[t.decode() for t in terms]))
    drawn = rows.select(key, "label", "example", kept.alias("found")).collect()
    model = Model(terms, idf, BlockMaxIndex(np.zeros((0, len(terms)))), [], np.zeros(0), (np.zeros(0),) * 2, 0.25)
    vectors = [{terms[x["terms"].encode()]: x["counts"] for x in r["found"]} for r in drawn]
    used = [k for k, r in enumerate(drawn) if r["example"] and vectors[k]]
    # Examples with the same leading term stand together, so that block maxima bound their blocks tightly.
    lead = {k: int(model.vector(vectors[k])[0][np.argmax(model.vector(vectors[k])[1])]) for k in used}
    used.sort(key=lambda k: (lead[k], drawn[k]["label"], str(drawn[k][key])))
    weights = np.zeros((len(used), len(terms)))
    for n, k in enumerate(used):
        at, values = model.vector(vectors[k])
        weights[n, at] = values
    model.index = BlockMaxIndex(weights)
    model.keys = [drawn[k][key] for k in used]
    model.labels = np.array([drawn[k]["label"] for k in used], np.float64)
    held = [(model.vote(vectors[k])[0], drawn[k]["label"]) for k, r in enumerate(drawn) if not r["example"]]
    voted = [(v, y) for v, y in held if v is not None]
    silent = [y for v, y in held if v is None]
    model.steps = isotonic(np.array([v for v, _ in voted]), np.array([y for _, y in voted]))
    model.without_terms = (sum(silent) + 0.5) / (len(silent) + 2)
    return model


def _document_frequencies(body: DataFrame, terms: dict[bytes, int]) -> tuple[int, np.ndarray]:
    """The number of all documents, and of those with each term. One short row per task is summed up."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, Counter()
        for batch in batches:
            total += batch.num_rows
            for x in batch.column(0).to_pylist():
                seen.update(terms.keys() & set((x or b"").lower().translate(_KEPT).split()))
        numbers = [-1, *(terms[t] for t in seen)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array([total, *seen.values()], pa.int64())], names=["term", "n"]
        )

    found = body.select("__text").mapInArrow(counted, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    by_term = {r["term"]: r["n"] for r in found.collect()}
    return by_term.get(-1, 0), np.array([by_term.get(n, 0) for n in range(len(terms))], np.float64)


def score(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text", evidence: int = 0) -> DataFrame:
    """``(key, score)`` of every row and, if asked for, the nearest examples as ``evidence``.

    Null and empty texts, and texts without any of the model's terms, get the share of toxic rows among
    such texts. Equal texts get equal scores.
    """
    fields = [documents.schema[key], T.StructField("score", T.DoubleType())]
    proof = T.StructType(
        [
            T.StructField("example", documents.schema[key].dataType),
            T.StructField("cosine", T.DoubleType()),
            T.StructField("toxic", T.IntegerType()),
        ]
    )
    if evidence:
        fields.append(T.StructField("evidence", T.ArrayType(proof)))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, tuple] = {}
        for batch in batches:
            scores, proofs = [], []
            for x in batch.column(1).to_pylist():
                counts = model.counts(x)
                mark = tuple(counts.items())
                if mark not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    vote, best, cosines = model.vote(counts)
                    near = zip(best[:evidence].tolist(), cosines[:evidence].tolist(), strict=True)
                    known[mark] = (
                        model.probability(vote),
                        [{"example": model.keys[n], "cosine": c, "toxic": int(model.labels[n])} for n, c in near],
                    )
                scores.append(known[mark][0])
                proofs.append(known[mark][1])
            columns = [batch.column(0), pa.array(scores, pa.float64())]
            if evidence:
                item = pa.struct([("example", batch.schema.field(0).type), ("cosine", pa.float64()), ("toxic", pa.int32())])
                columns.append(pa.array(proofs, pa.list_(item)))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return documents.select(key, F.col(text).cast("binary").alias("__text")).mapInArrow(run, schema)


def without_toxic(documents: DataFrame, model: Model, text: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows that score below ``limit``, with all their columns, decided where they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(batch.schema.get_field_index(text))
            chances = (model.probability(model.vote(model.counts((x.as_py() or "").encode()))[0]) for x in bodies)
            yield batch.filter(pa.array([chance < limit for chance in chances], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def op4_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every whole document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = score(documents, fit(documents, labels))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
