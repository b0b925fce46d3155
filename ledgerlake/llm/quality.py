"""Document quality from random-indexing word vectors and a two-layer network.

1. Random indexing: every word, hashed into one of ``CELLS`` cells, has a fixed sparse index
   vector of ``PLACES`` signs. A word's vector is the sum of the index vectors of the words
   up to ``WINDOW`` places from it, over all texts. A task adds up what it reads and sends one
   row per cell; the sums have a fixed number of rows.
2. Pooling: a document's features are mean and standard deviation of its words' vectors.
3. A network of one hidden layer learns from at most ``SAMPLE`` labelled documents, those
   with the least hash of their id; a fifth of them are kept back to fit the temperature
   that makes its scores probabilities.

A word is a run of letters, of digits or of other marks. A word that is the same as the one
before it or the one before that counts as the word "again", which has a cell of its own. Labels are used for fitting only.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import fold, hand_back, map_arrow, settle, small_batches, spans_of_texts, whole_text

CELLS = 1 << 14
AGAIN = 0
DIMENSIONS = 32
PLACES = 2
WINDOW = 2
SAMPLE = 20_000
HIDDEN = 24
THRESHOLD = 0.3
#: Characters whose words are summed at once: some ten arrays of a number a word.
SUMMED_CHARS = 1_000_000

_WORD = re.compile(r"[^\W\d_]+|\d+|(?:[^\w\s]|_)+")
_DRAW = np.random.default_rng(11)
#: Index vectors: places and signs by cell; the last row stands for the gap between texts.
_PLACE = np.vstack([np.argsort(_DRAW.random((CELLS, DIMENSIONS)), axis=1)[:, :PLACES], np.zeros((1, PLACES), np.int64)])
_SIGN = np.vstack([_DRAW.choice([-1, 1], (CELLS, PLACES)), np.zeros((1, PLACES), np.int64)])


class _Cells(dict):
    """The cell of each word met; emptied when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 100_000:
            self.clear()
        cell = self[word] = 1 + zlib.crc32(word.encode("utf-8", "surrogatepass")) % (CELLS - 1)
        return cell


#: One for all tasks of a process: small, so that it may stay.
_CELL_OF = _Cells()


def word_cells(text: str) -> np.ndarray:
    words = _WORD.findall(text)
    found = np.fromiter(map(_CELL_OF.__getitem__, words), np.int64, len(words))
    marked = found.copy()
    for back in (1, 2):
        marked[back:][found[back:] == found[:-back]] = AGAIN
    return marked


def context_sums(texts: list[str]) -> np.ndarray:
    """By cell, the sums of the index vectors around its words in these texts."""
    gap = np.full(WINDOW, CELLS)
    words = np.concatenate([part for text in texts for part in (word_cells(text), gap)])
    sums = np.zeros((CELLS + 1) * DIMENSIONS)
    for offset in range(1, WINDOW + 1):
        for at, near in ((words[offset:], words[:-offset]), (words[:-offset], words[offset:])):
            for k in range(PLACES):
                sums += np.bincount(at * DIMENSIONS + _PLACE[near, k], weights=_SIGN[near, k], minlength=len(sums))
    return sums.reshape(CELLS + 1, DIMENSIONS)[:CELLS]


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The vectors of all cells over all texts, scaled to length 1; a cell not met is zero."""
    names = [f"d{k}" for k in range(DIMENSIONS)]
    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((CELLS, DIMENSIONS))
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for begin, end in spans_of_texts(texts, SUMMED_CHARS):
                sums += context_sums(texts[begin:end])
        met = np.flatnonzero(sums.any(axis=1))
        columns = [pa.array(sums[met, k].astype(np.int64)) for k in range(DIMENSIONS)]
        yield pa.RecordBatch.from_arrays([pa.array(met), *columns], names=["cell", *names])
        del sums, columns
        hand_back()

    schema = "cell long, " + ", ".join(f"{name} long" for name in names)
    partial = docs.select(whole_text().alias("text")).mapInArrow(run, schema)
    found = partial.groupBy("cell").agg(*[F.sum(name).alias(name) for name in names]).toArrow()
    vectors = np.zeros((CELLS, DIMENSIONS))
    cell = found.column("cell").to_numpy()
    for k, name in enumerate(names):
        vectors[cell, k] = found.column(name).to_numpy()
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(length > 0, length, 1)).astype(np.float32)


def pooled(text: str, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the text's word vectors; zeros without words."""
    words = word_cells(text)
    if not len(words):
        return np.zeros(2 * DIMENSIONS, np.float32)
    cell, count = np.unique(words, return_counts=True)
    weight = (count / len(words)).astype(np.float32)
    of_words = vectors[cell]
    mean = weight @ of_words
    spread = np.sqrt(np.maximum(weight @ (of_words * of_words) - mean * mean, 0))
    return np.concatenate([mean, spread])


def features(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, features) of every row of ``docs``; features are packed float32."""
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        packed = [pooled(text, sent.value).tobytes() for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["doc_id", "features"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")), work, "doc_id long, features binary")


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, 2 * DIMENSIONS)


class Network:
    """tanh layer, one logit, temperature; fitted by Adam on cross-entropy."""

    def __init__(self, parts: dict[str, np.ndarray]):
        self.parts = parts

    def logits(self, x: np.ndarray) -> np.ndarray:
        p = self.parts
        hidden = np.tanh(((x - p["centre"]) / p["scale"]) @ p["w1"] + p["b1"])
        return hidden @ p["w2"] + p["b2"]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        scaled = np.clip(self.logits(x) / self.parts["temperature"], -40, 40)
        return 1 / (1 + np.exp(-scaled))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, steps: int = 1500, batch: int = 512, seed: int = 5) -> Network:
        """Without rows of both labels the score is the share of label 1, or 0.5 without rows."""
        width = x.shape[1]
        draw = np.random.default_rng(seed)
        prior = float(np.clip(y.mean(), 0.001, 0.999)) if len(y) else 0.5
        p = {
            "centre": x.mean(axis=0) if len(x) else np.zeros(width),
            "scale": x.std(axis=0) + 1e-6 if len(x) else np.ones(width),
            "w1": draw.normal(0, width**-0.5, (width, HIDDEN)),
            "b1": np.zeros(HIDDEN),
            "w2": np.zeros(HIDDEN),
            "b2": np.array(np.log(prior / (1 - prior))),
            "temperature": np.array(1.0),
        }
        network = cls(p)
        if len(np.unique(y)) < 2:
            return network
        order = draw.permutation(len(y))
        held, used = order[: len(y) // 5], order[len(y) // 5 :]
        scaled, learned = (x - p["centre"]) / p["scale"], ["w1", "b1", "w2", "b2"]
        first, second = ({name: np.zeros_like(p[name]) for name in learned} for _ in range(2))
        for step in range(1, steps + 1):
            rows = used[draw.integers(0, len(used), min(batch, len(used)))]
            inputs, target = scaled[rows], y[rows]
            hidden = np.tanh(inputs @ p["w1"] + p["b1"])
            error = (1 / (1 + np.exp(-np.clip(hidden @ p["w2"] + p["b2"], -40, 40))) - target) / len(rows)
            back = np.outer(error, p["w2"]) * (1 - hidden * hidden)
            gradient = {
                "w1": inputs.T @ back + 1e-4 * p["w1"], "b1": back.sum(axis=0),
                "w2": hidden.T @ error + 1e-4 * p["w2"], "b2": error.sum(),
            }
            rate = 0.01 * (1 - step / (steps + 1))
            for name in learned:
                first[name] = 0.9 * first[name] + 0.1 * gradient[name]
                second[name] = 0.999 * second[name] + 0.001 * gradient[name] ** 2
                move = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                p[name] = p[name] - rate * move
        if len(np.unique(y[held])) == 2:
            logit, target = network.logits(x[held]), y[held]
            choices = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
            losses = [np.mean(np.logaddexp(0, logit / t) - target * logit / t) for t in choices]
            p["temperature"] = np.array(choices[int(np.argmin(losses))])
        return network


def _hash_bound(ids: DataFrame, usable: DataFrame) -> int:
    """A bound of the hash of the id that leaves at least ``SAMPLE`` labelled rows, or all if there are fewer."""
    least, greatest = -(1 << 63), (1 << 63) - 1
    total = ids.join(usable, "doc_id").count()
    width = (SAMPLE * 5 // 4 << 64) // max(total, 1)
    while least + width < greatest:
        near = F.xxhash64("doc_id") <= least + width
        if ids.where(near).join(usable.where(near), "doc_id").count() >= SAMPLE:
            return least + width
        width *= 2
    return greatest


def training_sample(of_docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``SAMPLE`` labelled rows outside the held-out fold.

    Rows are ordered by a hash of the id. A document labelled several times counts each time.
    Only rows below a bound of that hash, somewhat more than the sample, are shuffled and sorted.
    """
    usable = labels.where((fold("doc_id", folds) != held_out) & F.col(label).isin(0, 1))
    usable = usable.select(F.col("doc_id").cast("long"), F.col(label).cast("int").alias("y"))
    near = F.xxhash64("doc_id") <= _hash_bound(of_docs.select("doc_id"), usable)
    rows = (
        of_docs.where(near)
        .join(usable.where(near), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y", "features")
        .select("features", "y")
        .limit(SAMPLE)
        .toArrow()
    )
    x = _unpacked(rows.column("features").combine_chunks()) if rows.num_rows else np.zeros((0, 2 * DIMENSIONS), np.float32)
    return x.astype(np.float64), rows.column("y").to_numpy().astype(np.float64)


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs(doc_id, text)``.

    Score is the probability of label 1, for empty and null texts too; predicted is 1 from
    ``THRESHOLD`` on. ``labels`` needs doc_id and the label's column; rows whose label is null
    or neither 0 nor 1, and ids that ``docs`` doesn't have, teach nothing. Other columns don't
    matter. An empty ``docs`` gives no row.
    """
    of_docs = settle(features(docs, word_vectors(docs)), "features")
    network = Network.fit(*training_sample(of_docs, labels, label, folds, held_out))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        score = network.probabilities(_unpacked(batch.column(1)).astype(np.float64))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    is_held_out = F.coalesce(fold("doc_id", folds) == held_out, F.lit(False))
    return map_arrow(of_docs, work, "doc_id long, score double").select(
        "doc_id", is_held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
