"""Byte-pair encoding by a deterministic automaton over tokens, and decoding by its arc labels.

**Compiling.** The automaton begins with one state that every byte leads back to, and takes in
the merges by falling priority. The gadget of the merge (u, v) -> w does two things. Wherever an
arc u is followed by an arc v, it adds an arc w that ends where v does. The state that u leads to
is copied without its arc v, and the arcs u lead to the copy: u is never followed by v again. All
arcs of a token lead to one state, so states are kept as what makes them differ: a copy is its
original less one arc, and the end of w is what the end of v was at that time. An arc w leaves
exactly those states that u left at that time. When all merges are in, the tokenizer's result for
a word is the only path that spells it.

**Encoding.** A text is cut at added tokens and by the tokenizer's pattern. The bytes of a word
drive the table of spellings; among the tokens that end along the way the longest that has an arc
from the present state is taken. The arcs are looked up in a table that is filled from the gadgets
as states are met. A place that a path has reached has one path only, so a dead end is marked and
never entered again: the work is linear in the word's length. Words are encoded once in a process
and looked up from then on, up to a bound at which the table starts anew.

**Decoding** writes the labels of the arcs, bytes, one after the other, and reads them as UTF-8
with U+FFFD for what isn't any.

Null texts count as empty: no tokens, an empty text back. Words and texts have no greatest length.
Null ids decode to an empty text. Nothing is shuffled; a lost task gives the same rows again.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_arrow, spans_of_texts, whole_text

#: Fixed value: the pattern of the tokenizer's words, with letters, numbers and white space by their Unicode classes.
_WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: The same classes for texts below U+0250, where they can be written out.
_L = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
_LATIN_WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"

_NEVER = 1 << 60
#: Bounds of what a process keeps: words, characters of words, arcs looked up.
MOST_WORDS, MOST_CHARS, MOST_ARCS = 300_000, 8_000_000, 1_000_000
#: Words or ids handled at once in a text.
_SLICE = 1 << 20


def _byte_of_mark() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others, rising, are the characters from U+0100 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Automaton:
    """The automaton of a list of merges: ``labels`` are the tokens' bytes, ``merges`` the pairs
    of tokens by falling priority with the token that each makes."""

    def __init__(self, labels: list[bytes], merges: list[tuple[int, int, int]]):
        self.labels = labels
        size = len(labels)
        self.left = [-1] * size  # w's arcs leave where those of left[w] did
        self.ends_as = [-1] * size  # w ends where ends_as[w] did, at the time born[w]
        self.born = [-1] * size
        self.lost: dict[int, dict[int, int]] = {}  # token -> arcs its end has lost, with the time
        self._arcs: dict[int, bool] = {}  # the table of arcs: (last token, token) -> whether there is one
        live = {k for k, label in enumerate(labels) if len(label) == 1}
        for time, (u, v, w) in enumerate(merges):
            if u in live and v in live and w not in live and self._leads_on(u, v):
                self.left[w], self.ends_as[w], self.born[w] = u, v, time
                self.lost.setdefault(u, {})[v] = time
                live.add(w)
        self.token = {labels[k]: k for k in live}
        self._spell(live)

    def _leads_on(self, last: int, token: int) -> bool:
        """Whether an arc ``token`` leaves the state that ``last`` leads to.

        Along the copies that the state came from, each with the time until which it was taken,
        an arc was lost that ``token`` was, or was then still to be made from.
        """
        state, before = last, _NEVER
        while state >= 0:
            lost = self.lost.get(state)
            if lost is not None:
                part, until = token, _NEVER
                while part >= 0:
                    time = lost.get(part)
                    if time is not None and time < before and time <= until:
                        return False
                    part, until = self.left[part], self.born[part]
            state, before = self.ends_as[state], self.born[state]
        return True

    def _spell(self, live: set[int]) -> None:
        """The table of spellings: a node has for each byte the token that ends there, or -1, and
        the next node."""
        self.spellings: dict = {}
        for token in sorted(live, key=lambda k: len(self.labels[k])):
            node, label = self.spellings, self.labels[token]
            for byte in label[:-1]:
                node = node.setdefault(byte, (-1, {}))[1]
            node[label[-1]] = (token, node.get(label[-1], (-1, {}))[1])

    def leads_on(self, last: int, token: int) -> bool:
        key = last << 32 | token
        known = self._arcs.get(key)
        if known is None:
            if len(self._arcs) >= MOST_ARCS:
                self._arcs.clear()
            known = self._arcs[key] = self._leads_on(last, token)
        return known

    def encode(self, word: bytes) -> list[int]:
        """The tokens of the path that spells ``word``."""
        whole = self.token.get(word)
        if whole is not None:
            return [whole]
        labels, spellings, arcs = self.labels, self.spellings, self._arcs
        path: list[int] = []
        choices: list[list[int]] = []  # for each place on the path, the tokens left to try
        dead: set[int] = set()
        at, end, last, entered = 0, len(word), -1, True
        while at < end:
            if entered:  # the tokens that begin here, the longest last
                here, node = [], spellings
                for k in range(at, end):
                    found = node.get(word[k])
                    if found is None:
                        break
                    token, node = found
                    if token >= 0:
                        here.append(token)
                choices.append(here)
                entered = False
            here = choices[-1]
            while here:
                token = here.pop()
                if dead and at + len(labels[token]) in dead:
                    continue
                if last >= 0:
                    goes = arcs.get(last << 32 | token)
                    if not (self.leads_on(last, token) if goes is None else goes):
                        continue
                path.append(token)
                at, last, entered = at + len(labels[token]), token, True
                break
            else:
                if not path:
                    raise ValueError(f"no token path spells {word[:80]!r}: a byte is missing from the vocabulary")
                dead.add(at)
                choices.pop()
                at -= len(labels[path.pop()])
                last = path[-1] if path else -1
        return path


class Coder:
    """Encodes and decodes whole texts by the file of a byte-level tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        known = model["type"] == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
        if not known or cut.get("add_prefix_space") or spec["normalizer"] or model.get("ignore_merges"):
            raise ValueError(f"{path} is not a plain byte-level tokenizer")
        vocabulary: dict[str, int] = model["vocab"]
        byte_of = _byte_of_mark()
        labels = [b""] * (1 + max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])]))
        for mark, token in vocabulary.items():
            labels[token] = bytes(byte_of[c] for c in mark)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        merges = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs]
        self.automaton = Automaton(list(labels), merges)

        self.added: dict[str, int] = {}
        for t in spec["added_tokens"]:
            if t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError("added tokens that are matched other than as they stand")
            self.added[t["content"]] = t["id"]
            labels[t["id"]] = t["content"].encode()
        longest_first = sorted(self.added, key=len, reverse=True)
        self._cut_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if longest_first else None
        self._library = Tokenizer.from_file(path).pre_tokenizer
        self._latin, self._words = re.compile(_LATIN_WORDS), regex.compile(_WORDS)
        self._beyond = re.compile("[ɐ-\U0010ffff]")
        self._agree: dict[str, bool] = {}

        self._label_bytes = np.frombuffer(b"".join(labels), np.uint8)
        self._label_length = np.array([len(label) for label in labels], np.int64)
        self._label_first = np.cumsum(self._label_length) - self._label_length
        self._reset()

    # -- words --

    def _reset(self) -> None:
        self._number: dict[str, int] = {}
        self._ids, self._ends, self._chars = array("I"), array("q", [0]), 0

    def _agrees(self, mark: str) -> bool:
        """Whether the tokenizer puts a character into the class that ``_WORDS`` has it in: the
        two may know different versions of Unicode."""
        known = self._agree.get(mark)
        if known is None:
            known = self._agree[mark] = all(
                self._words.findall(trial) == [trial[a:b] for _, (a, b) in self._library.pre_tokenize_str(trial)]
                for trial in (before + mark for before in "a1!")
            )
        return known

    def words(self, text: str) -> Iterator[list[str]]:
        """The words of a text without added tokens, some at a time."""
        if not self._beyond.search(text):
            pattern = self._latin
        elif all(map(self._agrees, set(self._beyond.findall(text)))):
            pattern = self._words
        else:
            places = self._library.pre_tokenize_str(text)
            yield [text[a:b] for _, (a, b) in places]
            return
        if len(text) <= 4 * _SLICE:
            yield pattern.findall(text)
            return
        found = (m.group() for m in pattern.finditer(text))
        while some := list(islice(found, _SLICE)):
            yield some

    def _numbers(self, words: list[str]) -> np.ndarray:
        number = self._number
        for word in words:
            if word not in number:
                self._ids.extend(self.automaton.encode(word.encode()))
                self._ends.append(len(self._ids))
                self._chars += len(word)
                number[word] = len(number)
        return np.fromiter(map(number.__getitem__, words), np.int64, len(words))

    def _ids_of(self, text: str) -> Iterator[np.ndarray]:
        for words in self.words(text):
            if len(self._number) > MOST_WORDS or self._chars > MOST_CHARS:
                self._reset()
            numbers = self._numbers(words)
            ids, ends = np.frombuffer(self._ids, np.uint32), np.frombuffer(self._ends, np.int64)
            first, length = ends[:-1][numbers], np.diff(ends)[numbers] if len(numbers) > len(ends) else ends[numbers + 1] - ends[numbers]
            yield _gathered(ids, first, length)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text, as uint32."""
        parts = [text]
        if self._cut_added is not None and any(token in text for token in self.added):
            parts = self._cut_added.split(text)
        found = []
        for k, part in enumerate(parts):
            if k % 2:
                found.append(np.array([self.added[part]], np.uint32))
            elif part:
                found.extend(self._ids_of(part))
        return np.concatenate(found) if found else np.zeros(0, np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        """The labels of ``ids`` one after the other, as text."""
        spelled = []
        for at in range(0, len(ids), _SLICE):
            some = ids[at : at + _SLICE]
            spelled.append(_gathered(self._label_bytes, self._label_first[some], self._label_length[some]).tobytes())
        return b"".join(spelled).decode("utf-8", "replace")


def _gathered(values: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs values[first : first + length], one after the other."""
    if not len(first):
        return values[:0].copy()
    ends = np.cumsum(length)
    at = np.repeat(first - ends + length, length)
    at += np.arange(ends[-1])
    return values[at]


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    """The coder of this process: what one task has compiled and met serves the next one."""
    return Coder(path)


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)])
    flat = np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids array<int>: the ids of each whole text by the tokenizer file at ``tokenizer``.

    ``docs`` needs doc_id and text, other columns are ignored; repeated rows give repeated rows.
    """

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        code, texts = coder(tokenizer), batch.column(1).to_pylist()
        for begin, end in spans_of_texts(texts):
            ids = [code.encode(text) for text in texts[begin:end]]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), _id_lists(ids)], ["doc_id", "ids"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")), run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, text: the text that each row's ids (array<int>) spell; null ids spell none."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer)
        lists = batch.column(1)
        values = np.asarray(lists.values).view(np.uint32)
        ends = np.asarray(lists.offsets)
        texts = [code.decode(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    ids = F.coalesce(F.filter("ids", lambda x: x.isNotNull()), F.array().cast("array<int>"))
    return map_arrow(rows.select(F.col("doc_id").cast("long"), ids.alias("ids")), run, "doc_id long, text string")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids, decoded: both ways in one pass, the ids packed as little-endian unsigned
    32-bit integers (binary), for digests and files of tokens."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        code, texts = coder(tokenizer), batch.column(1).to_pylist()
        for begin, end in spans_of_texts(texts):
            ids = [code.encode(text) for text in texts[begin:end]]
            packed = pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())
            spelled = pa.array([code.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(begin, end - begin), packed, spelled], ["doc_id", "ids", "decoded"]
            )

    return map_arrow(
        docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")), run, "doc_id long, ids binary, decoded string"
    )
