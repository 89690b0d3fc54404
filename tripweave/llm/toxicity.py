"""Toxicity scores by logistic regression over hashed word n-grams and skip-grams, fitted with FTRL-proximal.

Each coordinate has its own learning rate, and an L1 penalty keeps the weights of uninformative features at exactly zero, so
the model is a short sorted list of feature numbers and weights that every task gets. A feature counts once in a text.

The model is fitted on a sample of labelled rows of bounded size, in one task: SAMPLE_DOCS rows and SAMPLE_CHARS
characters of each class. Scores take the classes' shares among all labelled rows into account again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm.common import kept_by_worker, text_batches, unit_hash
from tripweave.llm.words import Grown, WordTable, groups_of

SAMPLE_DOCS, SAMPLE_CHARS = 10_000, 16_000_000
#: Feature numbers are hashes of so many bits.
BITS = 22
#: Distances between the two words of a feature: neighbours, and pairs that skip one or two words.
SKIPS = (1, 2, 3)
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 1.0, 12.0, 0.1, 6
WORD = re.compile(r"[^\W_]+")
MASK = np.uint64((1 << BITS) - 1)
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class _Hashes(WordTable):
    """64-bit hashes of words."""

    def __init__(self) -> None:
        super().__init__(most=1_000_000)

    def clear(self) -> None:
        super().clear()
        self.hashes = Grown(1, "u8")

    def learn(self, words: list[str]) -> None:
        self.hashes.add(np.array([xxhash.xxh64_intdigest(w.encode()) for w in words], np.uint64)[:, None])

    def features(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, feature number) of every n-gram and skip-gram, repeated ones too."""
        numbers, borders = self.numbers([WORD.findall(t.lower()) if t else [] for t in texts])
        words, owner = self.hashes.rows[numbers, 0], np.repeat(np.arange(len(texts)), np.diff(borders))
        found, owners = [_squeezed(words * ODD[0])], [owner]
        with np.errstate(over="ignore"):
            for k, skip in enumerate(SKIPS):
                same = owner[skip:] == owner[:-skip] if len(owner) > skip else np.zeros(0, bool)
                pair = words[:-skip][same] * ODD[1] + (words[skip:][same] ^ np.uint64(k)) * ODD[k + 1] if len(same) else words[:0]
                found.append(_squeezed(pair))
                owners.append(owner[skip:][same] if len(same) else owner[:0])
        return np.concatenate(owners), np.concatenate(found)


def _squeezed(hashes: np.ndarray) -> np.ndarray:
    return (((hashes ^ (hashes >> np.uint64(29))) * ODD[2] >> np.uint64(20)) & MASK).astype(np.int64)


def _hashes() -> _Hashes:
    return kept_by_worker("toxicity", _Hashes)


def distinct_features(texts: list[str | None]) -> list[np.ndarray]:
    """Sorted distinct feature numbers of each text."""
    owner, feature = _hashes().features(texts)
    pairs = np.unique((owner << BITS) | feature)
    borders = np.searchsorted(pairs >> BITS, np.arange(len(texts) + 1))
    return [pairs[a:b] & int(MASK) for a, b in zip(borders, borders[1:])]


class Ftrl:
    """FTRL-proximal for logistic loss on sets of features; the last coordinate is the bias, without L1."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
        self.bias = 1 << BITS

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        l1 = np.where(at == self.bias, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, features: np.ndarray, label: int) -> None:
        at = np.append(features, self.bias)
        w = self.weights(at)
        gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + gradient * gradient


@dataclass
class ToxicityModel:
    features: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        dense = np.zeros(1 << BITS, "f4")
        dense[self.features] = self.weights
        out = []
        for part in groups_of(texts):
            owner, feature = _hashes().features(texts[part])
            hit = np.flatnonzero(dense[feature])
            pairs = np.unique((owner[hit] << BITS) | feature[hit])
            out.append(np.bincount(pairs >> BITS, weights=dense[pairs & int(MASK)], minlength=part.stop - part.start))
        total = np.concatenate(out) if out else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -35, 35)))


def fit(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """A model of the rows of `labels` with `train` and a label of 0 or 1, joined with their texts by id.

    Null ids or labels and ids without a document are left out; of several labels for an id the highest counts. Without
    any labelled text the score is 0.5 everywhere; where all labels agree, it is near that label.
    """
    wanted = labels.filter(train & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    # Which labelled rows make the sample is settled without texts, so that only the sample's texts are exchanged.
    sized = rows.select("id", F.char_length("text").alias("chars")).join(wanted, "id")
    totals = {r.label: r for r in sized.groupBy("label").agg(F.count("*").alias("n"), F.sum("chars").alias("chars")).collect()}
    if not totals:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0, "f4"), 0.0)
    share = {k: min(1.0, SAMPLE_DOCS / r.n, SAMPLE_CHARS / max(1, r.chars)) for k, r in totals.items()}
    draw = unit_hash(F.lit("toxicity"), F.col("id").cast("string"))
    chosen = wanted.filter(draw < F.when(F.col("label") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)))
    # At most SAMPLE_DOCS ids and labels of each class, but for the draw's spread: some 20 bytes each.
    sample = rows.join(F.broadcast(chosen), "id").select("id", "text", "label")

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        features = [f.astype("<u4").tobytes() for f in distinct_features(batch.column("text").to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), pa.array(features, pa.binary()), batch.column("label")], names=["id", "features", "label"])

    encoded = sample.mapInArrow(text_batches(encode), "id long, features binary, label int")

    def train_one(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        sets = [np.frombuffer(f, "<u4").astype(np.int64) for f in table.column("features").to_pylist()]
        labels_, model = table.column("label").to_pylist(), Ftrl()
        for epoch in range(EPOCHS):
            for i in np.random.default_rng(epoch).permutation(len(sets)).tolist():
                model.learn(sets[i], labels_[i])
        weights = model.weights(np.arange(model.bias + 1))
        kept = np.flatnonzero(weights)
        return pa.table({"feature": kept, "weight": weights[kept]})

    fitted = encoded.groupBy((F.col("label") * 0).alias("all")).applyInArrow(train_one, "feature long, weight double").toArrow()
    features, weights = fitted.column("feature").to_numpy(), fitted.column("weight").to_numpy()
    own = features < (1 << BITS)
    # Back to the classes' odds among all labelled rows.
    shift = np.log(share[0] / share[1]) if 0 in share and 1 in share else 0.0
    return ToxicityModel(features[own], weights[own].astype("f4"), float(weights[~own].sum() + shift))


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every whole text; a null or empty one gets the score of no features.

    Rows that repeat an id are scored one by one; further columns don't matter.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = sent.value.score(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype("i4"))], names=["doc_id", "score", "predicted"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(text_batches(run), "doc_id long, score double, predicted int")
