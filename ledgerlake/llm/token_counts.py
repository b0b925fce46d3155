"""Token counts of a document's sections, from one encoding of the whole document.

Each document is encoded once; every token's character span follows from its bytes. The spans
are joined to the sections' spans by bisection. Sections are disjoint and in order, such as
lines or the fields of a record laid end to end; gaps between them are allowed. A token within
one section counts there. One that crosses a boundary goes to the section with most of its
characters, of several such to the first; ``token_share`` instead divides it by characters. A
character that several tokens share belongs to the span of each. Tokens, or parts of them,
outside all sections are counted in a row of their own, with section -1, where there are any.

Tasks work text by text, so memory is bounded by the longest text and its tokens.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_arrow, whole_text

SCHEMA = (
    "doc_id long, section int, begin long, end long, n_tokens long, n_crossing long, token_share double, doc_tokens long"
)
#: Runs of white space that do not go through the pattern; U+001C to U+001F are none to it.
_LONG_BLANKS = re.compile(r"[^\S\x1c-\x1f]{50000,}")
Sections = Callable[[str], tuple[np.ndarray, np.ndarray]]


class Encoder:
    """A byte-level BPE from a file of ranks: ids of a text and the tokens' character spans."""

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.byte_length = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.byte_length[rank] = len(token)

    def _ids(self, text: str) -> np.ndarray:
        """The ids of a text. The pattern takes a run of white space for one word, but for its last
        character where something follows, and its matcher can't take in runs of a million:
        long ones skip it."""
        found, at = [], 0
        for run in _LONG_BLANKS.finditer(text):
            end = run.end() - (run.end() < len(text))
            found.append(self.encoding.encode_to_numpy(text[at : run.start()]))
            found.append(np.array(self.encoding._encode_single_piece(text[run.start() : end]), np.uint32))
            at = end
        rest = self.encoding.encode_to_numpy(text[at:])
        return np.concatenate([*found, rest]) if found else rest

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, first character and character behind the last of each token."""
        ids = self._ids(text)
        ends = np.cumsum(self.byte_length[ids])
        begins = ends - self.byte_length[ids]
        if text.isascii() or not len(ids):
            return ids, begins, ends
        raw = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        return ids, character[begins], character[ends - 1] + 1


@lru_cache(maxsize=2)
def encoder(ranks_path: str, pattern: str) -> Encoder:
    return Encoder(ranks_path, pattern)


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The lines of a text, each with the line feed that ends it; an empty text is one empty line."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    ends = np.flatnonzero(points == 10) + 1
    if not len(ends) or ends[-1] < len(points):
        ends = np.append(ends, len(points))
    return np.append(0, ends[:-1]), ends


def allocated(
    begins: np.ndarray, ends: np.ndarray, first: np.ndarray, last: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per section, then for what is outside: tokens, those of them that cross, shares.

    ``begins``, ``ends``: the tokens' spans; ``first``, ``last``: the sections' spans.
    """
    count = len(first)
    if (first[1:] < last[:-1]).any() or (last < first).any():
        raise ValueError("sections must be disjoint and in order")
    tokens, crossing = np.zeros(count + 1, np.int64), np.zeros(count + 1, np.int64)
    shares = np.zeros(count + 1)
    # The last section that begins at or before each token, of empty ones the last.
    at = np.searchsorted(first, begins, "right") - 1
    inside = (at >= 0) & (ends <= last[np.maximum(at, 0)]) if count else np.zeros(len(begins), bool)
    whole = np.bincount(at[inside], minlength=count + 1)
    tokens += whole
    shares += whole
    for k in np.flatnonzero(~inside):
        begin, end = begins[k], ends[k]
        low = int(np.searchsorted(last, begin, "right"))
        high = int(np.searchsorted(first, end, "left"))
        held = np.minimum(end, last[low:high]) - np.maximum(begin, first[low:high])
        outside = (end - begin) - held.sum()
        shares[low:high] += held / (end - begin)
        shares[count] += outside / (end - begin)
        best = low + int(np.argmax(held)) if len(held) and held.max() >= outside else count
        tokens[best] += 1
        crossing[best] += int((held > 0).sum() + (outside > 0) > 1)
    return tokens, crossing, shares


def attributed(docs: DataFrame, ranks_path: str, pattern: str, sections: Sections | str = lines) -> DataFrame:
    """One row per document and section: begin, end, n_tokens, n_crossing, token_share, doc_tokens.

    ``docs`` needs doc_id and text. ``sections`` is a function of a text that gives the sections'
    begins and ends, or the name of a column of ``docs`` that holds them as an array of structs
    with begin and end. Null texts count as empty. A document without sections has only the
    row -1, if it has tokens. Repeated rows are counted as often as they are given; other
    columns are ignored; an empty table gives no row.
    """
    named = isinstance(sections, str)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path, pattern)
        parts: list[tuple] = []
        given = batch.column(2).to_pylist() if named else [None] * batch.num_rows
        for doc_id, text, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), given):
            if named:
                first = np.array([s["begin"] for s in spans or ()], np.int64)
                last = np.array([s["end"] for s in spans or ()], np.int64)
            else:
                first, last = sections(text)
            ids, begins, ends = encode.spans(text)
            tokens, crossing, shares = allocated(begins, ends, first, last)
            n = len(first) + int(tokens[-1] > 0 or shares[-1] > 0)
            number = np.append(np.arange(len(first)), -1)[:n]
            parts.append(
                (np.full(n, -1 if doc_id is None else doc_id), np.full(n, doc_id is None), number, np.append(first, 0)[:n],
                 np.append(last, len(text))[:n], tokens[:n], crossing[:n], shares[:n], np.full(n, len(ids)))
            )
            if len(parts) >= 2000:
                yield _rows(parts)
                parts = []
        if parts:
            yield _rows(parts)

    columns = ["doc_id", "text", *([sections] if named else [])]
    source = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"), *columns[2:])
    return map_arrow(source, work, SCHEMA)


def _rows(parts: list[tuple]) -> pa.RecordBatch:
    doc_id, missing, section, *rest = (np.concatenate(column) for column in zip(*parts))
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    columns = [pa.array(doc_id, pa.int64(), mask=missing), pa.array(section.astype(np.int32)), *map(pa.array, rest)]
    return pa.RecordBatch.from_arrays(columns, names=names)
