"""Language identification as a mixture: which languages a text holds, and in what shares.

Training counts, over all labelled training texts, each language's letter n-grams of one to
four letters of a word with its edges, hashed into ``BUCKETS`` cells a language. A text is a
draw of n-grams from a mixture of the languages. Expectation-maximisation estimates the
shares; the language set is chosen by likelihood penalised per language, growing from the best
single language for as long as the penalised likelihood rises. The predicted language is the
one with the largest share.

Counting is one pass that adds up within a task and sends at most one row per language and
cell; the model has a fixed number of cells a language, and the number of languages is checked.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import fold, hand_back, map_arrow, small_batches, spans_of_texts, whole_text

BUCKETS = 1 << 16
LONGEST = 4
MOST_LANGUAGES = 200
SMOOTHING = 0.5
ROUNDS = 12
#: Characters that are counted at once: each is about four cells, 64 bits wide.
COUNTED_CHARS = 250_000
UNKNOWN = "und"
#: Log-likelihood that a further language has to add, per logarithm of the number of n-grams.
PENALTY = 1.0

_STEPS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_LOWER = np.arange(0x110000, dtype=np.uint32)
_LETTER = np.zeros(0x110000, np.bool_)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower case and letterhood by code point, filled on first use in a process."""
    if not _LETTER[ord("a")]:
        for point in range(0x20000):
            letter = chr(point)
            if letter.isalpha():
                _LETTER[point] = True
                lower = letter.lower()
                if len(lower) == 1:
                    _LOWER[point] = ord(lower)
        _LETTER[0x20000:0x323B0] = True  # ideographs
    return _LOWER, _LETTER


def cells(text: str) -> np.ndarray:
    """The cell of each n-gram of the text; empty if it has no letter."""
    lower, letter = _tables()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letter[points]
    if not is_letter.any():
        return np.zeros(0, np.int64)
    padded = np.zeros(len(points) + 2, np.uint32)
    padded[1:-1] = np.where(is_letter, lower[points], 0)
    kept = padded[np.append(True, (padded[1:] != 0) | (padded[:-1] != 0))]  # one gap between words
    out = []
    hashed = np.zeros(len(kept), np.uint32)
    inside = np.ones(len(kept), np.bool_)
    for n in range(LONGEST):
        if len(kept) <= n:
            break
        hashed = (hashed[: len(kept) - n] ^ kept[n:]) * _STEPS[n]
        hashed ^= hashed >> np.uint32(15)
        inside = inside[: len(kept) - n]
        if n > 1:  # a gap may open or close an n-gram but not stand within it
            inside = inside & (kept[n - 1 : len(kept) - 1] != 0)
        full = inside if n else kept != 0
        out.append(hashed[full])
    return (np.concatenate(out) & np.uint32(BUCKETS - 1)).astype(np.int64)


def ngram_counts(labelled: DataFrame) -> DataFrame:
    """(lang, cell, n) over all rows of ``labelled(text, lang)`` with neither null."""
    small_batches(labelled.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for begin, end in spans_of_texts(texts, COUNTED_CHARS):
                found: dict[str, list[np.ndarray]] = {}
                for text, lang in zip(texts[begin:end], langs[begin:end]):
                    found.setdefault(lang, []).append(cells(text))
                for lang, parts in found.items():
                    of_lang = np.bincount(np.concatenate(parts), minlength=BUCKETS)
                    counts[lang] = counts[lang] + of_lang if lang in counts else of_lang
        for lang, of_lang in counts.items():
            cell = np.flatnonzero(of_lang)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(cell), pa.string()), pa.array(cell), pa.array(of_lang[cell])],
                names=["lang", "cell", "n"],
            )
        counts.clear()
        hand_back()

    texts = labelled.where("text is not null and lang is not null").select("text", F.col("lang").cast("string"))
    return texts.mapInArrow(run, "lang string, cell long, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))


class Model:
    """Log-probabilities of the cells in each language."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages = languages
        self.logs = logs

    @classmethod
    def fit(cls, labelled: DataFrame) -> Model:
        """Fits on ``labelled(text, lang)``; what reaches the driver is one row a language and cell."""
        counted = ngram_counts(labelled).groupBy("lang").agg(F.collect_list(F.struct("cell", "n")).alias("found"))
        rows = counted.select("lang", "found.cell", "found.n").limit(MOST_LANGUAGES + 1).toArrow().to_pylist()
        if len(rows) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages")
        rows.sort(key=lambda row: row["lang"])
        counts = np.full((len(rows), BUCKETS), SMOOTHING)
        for of_lang, row in zip(counts, rows):
            of_lang[row["cell"]] += row["n"]
        return cls([row["lang"] for row in rows], np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))

    def mixture(self, text: str) -> tuple[str, float, list[str], list[float]]:
        """The main language, how sure it is, and the language set with its shares, largest first.

        The measure of being sure is the main language's share times its posterior among the
        single languages. Without a letter, or without a model, the language is ``und``.
        """
        found = cells(text)
        if not len(found) or not self.languages:
            return UNKNOWN, 0.0, [], []
        counts = np.bincount(found, minlength=BUCKETS)
        cell = np.flatnonzero(counts)
        weight = counts[cell].astype(np.float64)
        logs = self.logs[:, cell].astype(np.float64)
        likelihood = logs @ weight
        best = int(np.argmax(likelihood))
        ratio = np.exp(logs - logs[best])
        total, members, share = weight.sum(), [best], np.ones(1)
        value, mixed = 0.0, np.ones(len(cell))  # log-likelihood and probabilities over those of the best
        while len(members) < len(self.languages):
            slope = ratio @ (weight / mixed) / total - 1
            slope[members] = -1
            added = int(np.argmax(slope))
            if slope[added] <= 0:
                break
            trial = np.append(share * 0.9, 0.1)
            of_trial = ratio[[*members, added]]
            for _ in range(ROUNDS):
                blend = trial @ of_trial
                trial = trial * (of_trial @ (weight / blend)) / total
            blend = trial @ of_trial
            reached = float(weight @ np.log(blend))
            if reached - value <= PENALTY * np.log(total):
                break
            members, share, value, mixed = [*members, added], trial, reached, blend
        order = sorted(range(len(members)), key=lambda k: (-share[k], members[k]))
        main = members[order[0]]
        posterior = 1.0 / np.exp(np.minimum(likelihood - likelihood[main], 700.0)).sum()
        if len(members) > 1:
            posterior = 1.0
        return (
            self.languages[main],
            float(min(1.0, share[order[0]] * posterior)),
            [self.languages[members[k]] for k in order],
            [float(share[k]) for k in order],
        )


SCHEMA = "lang_pred string, score double, languages array<string>, shares array<double>"


def predicted(docs: DataFrame, model: Model, keep: list[str], prefix: str = "") -> DataFrame:
    """The columns ``keep`` of ``docs`` and lang_pred, score, languages, shares; one row per row.

    ``prefix`` stands before the four new names, so that they don't clash with those kept.

    Only ``text`` is read for the prediction. Null texts and texts without a letter are ``und``
    with score 0. Columns of ``docs`` that aren't named in ``keep`` don't matter.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.logs))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        fitted = Model(*sent.value)
        found = [fitted.mixture(text) for text in batch.column(0).to_pylist()]
        langs, scores, sets, shares = map(list, zip(*found))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
             pa.array(sets, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))],
            names=[*keep, *(prefix + name for name in ("lang_pred", "score", "languages", "shares"))],
        )

    source = docs.select(whole_text().alias("__text"), *keep)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in source.drop("__text").dtypes)
    return map_arrow(source, work, ", ".join([schema, *(prefix + field for field in SCHEMA.split(", "))]))


def training_rows(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """text and lang of the rows whose crc32(doc_id as text) modulo ``folds`` isn't ``held_out``.

    A null doc_id belongs to no fold and isn't learned from.
    """
    return docs.where(fold("doc_id", folds) != held_out).select("text", "lang")


def identified(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages, shares of every document.

    Learns from ``docs`` itself, but for the held-out fold.
    """
    model = Model.fit(training_rows(docs, folds, held_out))
    out = predicted(docs.select("doc_id", "text"), model, ["doc_id"])
    is_held_out = F.coalesce(fold("doc_id", folds) == held_out, F.lit(False))
    return out.select("doc_id", is_held_out.alias("held_out"), "lang_pred", "score", "languages", "shares")
