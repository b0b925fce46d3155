"""Cost-balanced packing of token sequences.

The cost of a piece of n tokens in a sequence is ``LINEAR * n + QUADRATIC * n * n``: what each
token costs by itself and what it costs to attend within its document. Documents are gathered,
in the order in which a task reads them, into pools of ``POOL`` sequences. In a pool they are
taken by descending length, each given to the sequence of the lowest cost that has room left;
what doesn't fit is cut off and taken up again as a document of that length. So every sequence
of a full pool holds exactly ``LENGTH`` tokens, and what is left over opens the next pool. The
last tokens of a task are packed into sequences of powers of two, which need no padding.

Nothing is shuffled: a task packs what it reads, holds one pool at a time, and a lost task
gives the same sequences when it runs again. Sequence numbers hold the task's number above
2^36 and count within the task below it.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, compress, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import hand_back, small_batches, spans_of_texts, whole_text

LENGTH = 2048
POOL = 512
END = 1
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
#: Characters that are encoded at once.
ENCODED_CHARS = 1_000_000

_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class _Numbers(dict):
    """Numbers what is looked up in the order in which it is first met."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


class _Table:
    """Runs of ids by number, and the numbers of the keys they belong to."""

    def __init__(self) -> None:
        self.number = _Numbers()
        self.ids = np.zeros(0, np.uint32)
        self.length = self.first = np.zeros(0, np.int64)
        self.used = np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        """The runs of the next keys, in order."""
        self.ids = np.concatenate([self.ids, ids])
        self.length = np.concatenate([self.length, lengths])
        self.first = np.cumsum(self.length) - self.length
        self.used = np.concatenate([self.used, np.zeros(len(lengths), np.int64)])

    def count(self, numbers: np.ndarray) -> None:
        """Counts uses, by which ``keep`` goes."""
        self.used += np.bincount(numbers, minlength=len(self.used))

    def keep(self, most: int) -> None:
        """Forgets all but the ``most`` keys used most often, of equals the older; counts are halved."""
        kept = np.argsort(-self.used, kind="stable")[:most]
        keys = list(self.number)
        self.number.clear()
        # No key has a line's end in it. Keys that are made anew lie side by side, and hold no others' room.
        joined = "\n".join(map(keys.__getitem__, kept.tolist()))
        del keys
        self.number.update(zip(joined.split("\n"), range(len(kept))))
        self.ids, self.length, self.used = self.gathered(kept), self.length[kept], self.used[kept] // 2
        self.first = np.cumsum(self.length) - self.length

    def gathered(self, numbers: np.ndarray) -> np.ndarray:
        """The runs of ``numbers``, one after the other."""
        if not len(numbers):
            return np.zeros(0, np.uint32)
        lengths = self.length[numbers]
        ends = np.cumsum(lengths)
        at = np.repeat(self.first[numbers] - ends + lengths, lengths)
        at += np.arange(ends[-1])
        return self.ids[at]


class WordEncoder:
    """Token ids of whole texts by a word-level BPE that drops white space.

    Its ids for a text are those of what stands between white space, one after the other, so
    each such chunk is encoded once and looked up from then on. Chunks of Latin letters are put
    in lower case first, as the tokenizer does, and a new one falls into units: runs of letters
    and digits, with apostrophes between them, and runs of other marks; the tokenizer splits at
    least there. Units are encoded once as well; those of lower-case Latin letters need nothing
    but the tokenizer's merges, over the characters its pre-tokenizer spells bytes with. Elsewhere
    lower case or composed characters may depend on what stands around, and chunks are encoded as
    they are. ``tests/llm`` hold the ids against the tokenizer's. Tables that have grown to their
    bound forget what was used least: most words of a text are common ones, and are not encoded
    again for the sake of many rare ones.

    With ``added``, as the operator has it, texts are first cut at the tokenizer's added tokens,
    such as <|endoftext|>, each one id; else these are spelled out.
    """

    #: White space as the tokenizer's pattern has it: U+001C to U+001F, which Python splits at, aren't.
    _separators = re.compile(r"[^\S\x1c-\x1f]+")
    _odd = re.compile(r"[\x1c-\x1f]")
    _beyond_latin = re.compile("[\x1c-\x1f\u0250-\U0010ffff]")
    _units = re.compile(r"'?[^\W_]+(?:'[^\W_]+)*|(?:[^\w\s]|_)+")
    #: Stops and commas after other marks, which may be one unit with them.
    _marks = re.compile(r"[.,](?<=[^\w\s][.,]|_[.,])")

    def __init__(self, path: str, most_units: int = 200_000, added: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self._added = self._added_tokens() if added else {}
        longest_first = sorted(self._added, key=len, reverse=True)
        self._cut_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})")
        self.most_units = most_units
        self.chunks, self.units = _Table(), _Table()
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self._spelled = {c: pieces(chr(c))[0][0] if chr(c).isalpha() else chr(c) for c in range(0x250)}

    def _added_tokens(self) -> dict[str, int]:
        tokens = self.tokenizer.get_added_tokens_decoder()
        if any(token.normalized or token.lstrip or token.rstrip or token.single_word for token in tokens.values()):
            raise ValueError("added tokens that are matched other than as they stand")
        if any("\n" in token.content for token in tokens.values()):
            raise ValueError("added tokens with a line's end, which parts the keys of a table")
        return {token.content: k for k, token in tokens.items()}

    def _chunks_of(self, text: str) -> list[str]:
        """The chunks of a text, added tokens among them: after a space, as no other chunk is spelled."""
        if not any(token in text for token in self._added):
            return self._split(text)
        parts = self._cut_added.split(text)
        return list(chain.from_iterable([f" {part}"] if k % 2 else self._split(part) for k, part in enumerate(parts)))

    def _split(self, text: str) -> list[str]:
        plain = text.isascii() and not any(mark in text for mark in "\x1c\x1d\x1e\x1f")
        if plain or not self._beyond_latin.search(text):
            text = text.lower()
            if not self._marks.search(text):
                # A stop or comma after a letter or number is a unit, and so may stand apart.
                text = text.replace(". ", " . ").replace(", ", " , ").replace(".\n", " .\n").replace(",\n", " ,\n")
            return text.split()
        if self._odd.search(text):
            return [chunk for chunk in self._separators.split(text) if chunk]
        return text.split()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as uint32."""
        for table, most in (self.chunks, self.most_units), (self.units, self.most_units // 4):
            if len(table.number) > most:
                table.keep(most // 2)
        known = len(self.chunks.number)
        numbers = []
        for text in texts:
            chunks = self._chunks_of(text)
            numbers.append(np.fromiter(map(self.chunks.number.__getitem__, chunks), np.int64, len(chunks)))
        self._learn_chunks(list(islice(self.chunks.number, known, None)))
        if numbers:
            self.chunks.count(np.concatenate(numbers))
        return [self.chunks.gathered(of_text) for of_text in numbers]

    def _learn_chunks(self, fresh: list[str]) -> None:
        """A chunk's ids are those of its units; words, added tokens and chunks beyond Latin are encoded whole."""
        if not fresh:
            return
        number, known, beyond = self.units.number, len(self.units.number), self._beyond_latin.search
        whole = [chunk.isalpha() or chunk[0] == " " or beyond(chunk) is not None for chunk in fresh]
        of_chunks, sizes = [], []
        for chunk, is_whole in zip(fresh, whole):
            if not is_whole:
                parts = self._units.findall(chunk.lower())  # not yet in lower case where a text has more than Latin
                of_chunks.extend(map(number.__getitem__, parts))
                sizes.append(len(parts))
        self._learn_units(list(islice(number, known, None)))
        units = np.array(of_chunks, np.int64)
        self.units.count(units)
        ends = np.concatenate([[0], np.cumsum(self.units.length[units])])
        counts = np.array(sizes, np.int64)
        last = np.cumsum(counts)
        ids, lengths = self._encoded(list(compress(fresh, whole)))
        runs = _Table()
        runs.add(np.concatenate([ids, self.units.gathered(units)]), np.concatenate([lengths, ends[last] - ends[last - counts]]))
        in_order = np.argsort(np.argsort(~np.array(whole), kind="stable"))
        self.chunks.add(runs.gathered(in_order), runs.length[in_order])

    def _learn_units(self, fresh: list[str]) -> None:
        """The ids of what is a known chunk as well are taken from there."""
        of_chunks = np.array([self.chunks.number.get(unit, len(self.chunks.length)) for unit in fresh], np.int64)
        is_known = of_chunks < len(self.chunks.length)
        ids, lengths = self._encoded(list(compress(fresh, ~is_known)))
        runs, known = _Table(), of_chunks[is_known]
        runs.add(np.concatenate([self.chunks.gathered(known), ids]), np.concatenate([self.chunks.length[known], lengths]))
        in_order = np.argsort(np.argsort(~is_known, kind="stable"))
        self.units.add(runs.gathered(in_order), runs.length[in_order])

    def _encoded(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``units``, one after the other, and how many each has."""
        is_word = [unit.isalpha() and unit.islower() for unit in units]
        if self._beyond_latin.search("\n".join(compress(units, is_word))):
            is_word = [of_word and not self._beyond_latin.search(unit) for unit, of_word in zip(units, is_word)]
        words = "\n".join(compress(units, is_word)).translate(self._spelled).split("\n")
        merged = map(self.tokenizer.model.tokenize, words)
        others = [unit for unit, of_word in zip(units, is_word) if not of_word]
        encoded = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False))
        ids = [[token.id for token in next(merged)] if of_word else next(encoded).ids for of_word in is_word]
        return np.fromiter(chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of this process: what one task has looked up serves the next one."""
    return WordEncoder(path, added=True)


def cost(tokens: int) -> float:
    return LINEAR * tokens + QUADRATIC * tokens * tokens


def balanced(lengths: list[int], room: list[int]) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
    """Packs documents of ``lengths`` into sequences with ``room`` tokens each.

    Returns the pieces as (document, start, length, sequence, offset), and as (document, start,
    length) what finds no room. Longest first, to the cheapest sequence with room; ties go to
    the lower number.
    """
    waiting = [(-n, k, 0) for k, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    open_sequences = [(0.0, s, n) for s, n in enumerate(room) if n]
    heapq.heapify(open_sequences)
    filled = [0] * len(room)
    pieces = []
    while waiting and open_sequences:
        minus, document, start = heapq.heappop(waiting)
        spent, sequence, left = open_sequences[0]
        taken = min(-minus, left)
        pieces.append((document, start, taken, sequence, filled[sequence]))
        filled[sequence] += taken
        if taken < left:
            heapq.heapreplace(open_sequences, (spent + cost(taken), sequence, left - taken))
        else:
            heapq.heappop(open_sequences)
        if taken < -minus:
            heapq.heappush(waiting, (minus + taken, document, start + taken))
    return pieces, sorted((k, start, -minus) for minus, k, start in waiting)


def powers(tokens: int) -> list[int]:
    """The powers of two that make up ``tokens``, falling."""
    return [1 << bit for bit in range(tokens.bit_length() - 1, -1, -1) if tokens >> bit & 1]


class _Pool:
    """Documents that wait, as (doc_id, start in the document, ids, the document's length)."""

    def __init__(self, task: int):
        self.next_sequence = task << 36
        self.waiting: list[tuple[int | None, int, np.ndarray, int]] = []
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.waiting.append((doc_id, 0, ids, len(ids)))
        self.tokens += len(ids)

    def pack(self, room: list[int]) -> pa.RecordBatch:
        pieces, left = balanced([len(w[2]) for w in self.waiting], room)
        rows = []
        for k, start, length, sequence, offset in pieces:
            doc_id, before, ids, whole = self.waiting[k]
            crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
            rows.append((doc_id, before + start, length, crc, whole, self.next_sequence + sequence, offset))
        self.next_sequence += len(room)
        kept = []
        for k, start, length in left:
            doc_id, before, ids, whole = self.waiting[k]
            kept.append((doc_id, before + start, ids[start : start + length], whole))
        self.waiting, self.tokens = kept, sum(len(w[2]) for w in kept)
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA
        )

    def full(self) -> Iterator[pa.RecordBatch]:
        while self.tokens >= POOL * LENGTH:
            yield self.pack([LENGTH] * POOL)

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.tokens:
            whole, tail = divmod(self.tokens, LENGTH)
            yield self.pack([LENGTH] * whole + powers(tail))


def packed(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``docs`` needs doc_id and text, other columns are ignored; ``tokenizer`` is the path of a
    tokenizer file on every executor. Each document is its text's ids and the id 1 at its end;
    null and empty texts have that id alone. Repeated rows are packed as often as they are
    given. An empty table gives no row.
    """

    small_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        pool = _Pool(TaskContext.get().partitionId())
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for begin, end in spans_of_texts(texts, ENCODED_CHARS):
                for doc_id, ids in zip(doc_ids[begin:end], encoder.encode(texts[begin:end])):
                    pool.add(doc_id, np.append(ids, np.uint32(END)))
                    yield from pool.full()
        yield from pool.rest()
        del pool
        hand_back()

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(run, SCHEMA)
