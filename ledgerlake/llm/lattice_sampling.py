"""Sampled SentencePiece segmentations without replacement, with inclusion scores; decoding.

A text's segmentations are the paths of a lattice over its characters whose edges are pieces of
a SentencePiece vocabulary. A path's probability is proportional to the product of its pieces'
weights, 1 / (rank + ``RANK_SHIFT``), by the pieces' rank in the vocabulary, raised to
``alpha``: a lower one spreads the samples wider. Characters that are no piece are spelled in
bytes.

The k samples are the k paths of the largest Gumbel-perturbed log-probability (Gumbel top-k), found
by A-star search from the top: a node is the set of all paths that share a beginning, less
those that continue with one of some edges; its bound is the largest perturbed value in the
set, which is drawn first, given the parent's. The best node's best path follows edges drawn by
their probability, all the way down; each step leaves behind the set of paths that branch off
there, with its own bound, below. The next sample starts at the best of the sets left
behind. Nothing is cut off: the search is exact for any k.

Written as arrivals, t = exp(-value): the first of a set of mass m that is left behind at t comes
at t + Exp(1) / m. A sample's inclusion score is the probability that its value passes the
(k+1)-th one, 1 - exp(-p * t'), with t' the arrival of that one; its logarithm is returned.

Pieces don't reach across the begin of a word, so lattices are built once for each distinct word
of a run of texts, backward sums included, in whole arrays; all documents of the run descend
together. Random numbers are hashes of the row's key, the sample's number and the place in
the text, so that results don't depend on which rows share a task.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_arrow, spans_of_texts, whole_text

RANK_SHIFT = 10
SPACE = "▁"
#: Hash of no characters.
START = np.uint64(0x51ED270B)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(seeds: np.ndarray, counters: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1), each a hash of its seed and counter."""
    mixed = _mixed(seeds + (counters.astype(np.uint64) + np.uint64(1)) * _GOLDEN)
    return ((mixed >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


class Vocabulary:
    """The pieces of a SentencePiece model, found by a hash of their characters."""

    def __init__(self, model_path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.size = model.get_piece_size()
        self.byte_id = np.zeros(256, np.int64)
        self.bytes_of: list[bytes] = [b""] * self.size
        texts, ids = [], []
        for piece in range(self.size):
            name = model.id_to_piece(piece)
            if model.is_byte(piece):
                value = int(name[3:-1], 16)
                self.byte_id[value] = piece
                self.bytes_of[piece] = bytes([value])
            elif not (model.is_control(piece) or model.is_unknown(piece) or model.is_unused(piece)):
                self.bytes_of[piece] = name.encode()
                texts.append(name)
                ids.append(piece)
        inner = [t for t in texts if SPACE in t.lstrip(SPACE)]
        if inner:
            raise ValueError(f"pieces that reach across a word's begin: {inner[:3]}")
        first = min(ids, default=0)
        self.log_weight = np.full(self.size, -alpha * np.log(self.size + RANK_SHIFT))
        self.log_weight[ids] = -alpha * np.log(np.array(ids) - first + RANK_SHIFT)
        self.longest = max(map(len, texts), default=1)
        #: By the leading bits of a hash: 1 if a piece may have it, plus 2 if the beginning of a longer piece may.
        self.kind = np.zeros(1 << 22, np.uint8)
        keys = self._hashes(texts)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array(ids)[order]
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces of one hash")
        #: By the same bits, the first key that has them.
        self.first_key = np.zeros(1 << 22, np.min_scalar_type(max(len(self.keys), 1)))
        self.first_key[(self.keys >> np.uint64(42))[::-1]] = np.arange(len(self.keys))[::-1]
        self.lengths = np.array([len(b) for b in self.bytes_of])
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    @staticmethod
    def _extend(hashed: np.ndarray, points: np.ndarray) -> np.ndarray:
        return (hashed ^ points) * np.uint64(0x2545F4914F6CDD1D) + (hashed >> np.uint64(29))

    def _hashes(self, texts: list[str]) -> np.ndarray:
        """The pieces' hashes; notes these and those of their beginnings in ``kind``."""
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
        sizes = np.array([len(text) for text in texts], np.int64)
        first = np.cumsum(sizes) - sizes
        keys = np.full(len(texts), START, np.uint64)
        for length in range(1, self.longest + 1):
            at = np.flatnonzero(sizes >= length)
            keys[at] = self._extend(keys[at], points[first[at] + length - 1])
            bits = keys[at] >> np.uint64(42)
            self.kind[bits[sizes[at] == length]] |= 1
            self.kind[bits[sizes[at] > length]] |= 2
        return keys

    def among_keys(self, hashed: np.ndarray) -> np.ndarray:
        """For hashes that ``kind`` calls a piece's, the place among the keys of each one's equal, or of another key."""
        slot = self.first_key[hashed >> np.uint64(42)].astype(np.int64)
        other = np.flatnonzero(self.keys[slot] != hashed)
        slot[other] = np.searchsorted(self.keys, hashed[other])
        slot[slot == len(self.keys)] = 0
        return slot

    def decode(self, ids: np.ndarray) -> bytes:
        """The normalised text of a segmentation, in UTF-8."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[at].tobytes()


@lru_cache(maxsize=2)
def vocabulary(model_path: str, alpha: float) -> Vocabulary:
    return Vocabulary(model_path, alpha)


def normalised(text: str) -> str:
    """With word marks for blanks and one in front, as the model's own rule; empty stays empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""


_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def words_of(text: str) -> list[str]:
    """The words of the normalised text, each without the mark in front that all of them have."""
    if not text:
        return []
    if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
        return [word[1:] for word in _WORD.findall(normalised(text))]
    return text.split(" ")


class Lattices:
    """The lattices of distinct words, laid end to end: a state for each character of each word.

    ``begin`` (with an end marker) are the first edges of the states, ``length`` and ``piece``
    the edges', ``log_p`` their probability given the state, ``cumulative`` the probabilities
    summed within each state, plus the state's number. Edges that are spelled in bytes have
    piece -1 - character.
    """

    def __init__(self, words: list[str], vocabulary: Vocabulary):
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(word) for word in words], np.int64)
        self.first = np.cumsum(sizes) - sizes
        states = len(points)
        # Characters up to the word's end.
        left = (np.repeat(self.first + sizes, sizes) - np.arange(states)).astype(np.int32)
        wide = points.astype(np.uint64)
        at, hashed = np.arange(states), np.full(states, START)
        found = []
        degree = np.zeros(states, np.int64)
        single = np.zeros(states, np.bool_)
        for length in range(1, vocabulary.longest + 1):
            inside = left[at] >= length
            at, hashed = at[inside], hashed[inside]
            if not len(at):
                break
            hashed = vocabulary._extend(hashed, wide[at + length - 1])
            kind = vocabulary.kind[hashed >> np.uint64(42)]
            maybe, longer = np.flatnonzero(kind & 1), kind > 1
            near, of_near = at[maybe], hashed[maybe]
            at, hashed = at[longer], hashed[longer]
            slot = vocabulary.among_keys(of_near)
            hit = vocabulary.keys[slot] == of_near
            near, piece = near[hit], vocabulary.ids[slot[hit]]
            if length == 1:
                single[near] = True
            degree[near] += 1
            found.append((near, length, piece))
        spelled = np.flatnonzero(~single)
        degree[spelled] += 1
        found.append((spelled, 1, -1 - points[spelled].astype(np.int64)))
        # A state's edges by rising length, one that is spelled last.
        self.begin = np.append(0, np.cumsum(degree))
        self.length, self.piece = np.empty(self.begin[-1], np.int16), np.empty(self.begin[-1], np.int32)
        free = self.begin[:-1].copy()
        for near, length, piece in found:
            slot = free[near]
            self.length[slot], self.piece[slot] = length, piece
            free[near] = slot + 1
        state = np.repeat(np.arange(states), degree)
        weight = vocabulary.log_weight[np.maximum(self.piece, 0)]
        if len(spelled):
            of_spelled = self.begin[spelled + 1] - 1
            utf8 = np.digitize(points[spelled], [0x80, 0x800, 0x10000]) + 1
            weight[of_spelled] = utf8 * vocabulary.log_weight[vocabulary.byte_id[0]]
        self.left = left
        self.states = states
        value = self._backward(state, weight)
        target = np.where(left[state] > self.length, state + self.length, states)
        self.log_p = np.minimum(weight + value[target] - value[state], 0.0)
        p = np.exp(self.log_p)
        running = np.cumsum(p)
        until = np.append(0.0, running)[self.begin]
        total = np.diff(until)
        self.cumulative = state + np.minimum((running - until[state]) / total[state], 1.0)
        self.cumulative[self.begin[1:] - 1] = np.arange(states) + 1.0

    def _backward(self, state: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Log of the summed weight of the paths from each state to its word's end; 0 at the end."""
        value = np.zeros(self.states + 1)
        by_left = np.argsort(self.left, kind="stable")
        bounds = np.searchsorted(self.left[by_left], np.arange(1, int(self.left.max(initial=0)) + 2))
        degree = np.diff(self.begin)
        for low, high in zip(bounds[:-1], bounds[1:]):
            of = by_left[low:high]
            counts = degree[of]
            ends = np.cumsum(counts)
            edges = np.repeat(self.begin[of] - ends + counts, counts) + np.arange(ends[-1])
            source = np.repeat(of, counts)
            target = np.where(self.left[source] > self.length[edges], source + self.length[edges], self.states)
            terms = weight[edges] + value[target]
            most = np.maximum.reduceat(terms, ends - counts)
            value[of] = most + np.log(np.add.reduceat(np.exp(terms - np.repeat(most, counts)), ends - counts))
        return value

    def draw(self, states: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The first edge of each state whose summed probability passes the number: few steps back from the last one."""
        first, edge = self.begin[states], self.begin[states + 1] - 1
        wanted = states + numbers
        index = np.flatnonzero(edge > first)
        at, first, wanted = edge[index], first[index], wanted[index]
        while len(index):
            back = np.flatnonzero(self.cumulative[at - 1] > wanted)
            index, at, first, wanted = index[back], at[back] - 1, first[back], wanted[back]
            edge[index] = at
            more = np.flatnonzero(at > first)
            if len(more) < len(at):
                index, at, first, wanted = index[more], at[more], first[more], wanted[more]
        return edge


class _Numbers(dict):
    """Numbers words in the order in which they are first met."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


class _Run:
    """The texts of one run: their words' states, and descents through them."""

    def __init__(self, texts: list[str], vocabulary: Vocabulary):
        numbers = _Numbers()
        counts, words = [], [np.zeros(0, np.int64)]
        for text in texts:
            found = words_of(text)
            words.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
            counts.append(len(found))
        self.lattices = Lattices([SPACE + word for word in numbers], vocabulary)
        kinds = np.concatenate(words)
        sizes = np.fromiter(map(len, numbers), np.int64, len(numbers)) + 1
        self.state = self.lattices.first[kinds] if len(kinds) else kinds
        of_words = sizes[kinds] if len(kinds) else kinds
        self.words = np.append(0, np.cumsum(counts))
        ends = np.cumsum(of_words)
        self.place = ends - of_words  # of the word in the run's characters

    def descend(self, words: np.ndarray, start: np.ndarray, seeds: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, ...]:
        """Draws each word's path from state ``start`` on: per token in order the word's index in
        ``words``, the state, the edge. ``base``: the text's first place, by word."""
        lattices = self.lattices
        per_step, index, state = [], np.arange(len(words)), start
        while len(index):
            counter = 2 * (self.place[words[index]] + state - self.state[words[index]] - base[index])
            edge = lattices.draw(state, uniform(seeds[index], counter))
            per_step.append((index, state, edge))
            more = lattices.left[state] > lattices.length[edge]
            index, state = index[more], (state + lattices.length[edge])[more]
        tokens = np.bincount(np.concatenate([s[0] for s in per_step]), minlength=len(words)) if per_step else np.zeros(0, np.int64)
        first = np.cumsum(tokens) - tokens
        total = int(tokens.sum())
        word, at, taken = (np.empty(total, np.int64) for _ in range(3))
        for step, (index, state, edge) in enumerate(per_step):
            slot = first[index] + step
            word[slot], at[slot], taken[slot] = index, state, edge
        return word, at, taken


class _Sample:
    """A segmentation of one text: words, states, edges, and the log-probability before each token."""

    __slots__ = ("arrival", "word", "state", "edge", "before", "log_p")

    def __init__(self, arrival: float, word: np.ndarray, state: np.ndarray, edge: np.ndarray, steps: np.ndarray):
        self.arrival, self.word, self.state, self.edge = arrival, word, state, edge
        running = np.cumsum(steps)
        self.before = running - steps
        self.log_p = float(running[-1]) if len(running) else 0.0


#: Below the least logarithm of -log(u) that ``uniform`` can give, u = 1 - 2^-53.
_LEAST_WAIT = -37.0
#: Tokens that are looked at first.
_NEAR = 192


def _waits(run: _Run, parts: list[tuple[_Sample, int, int]], seeds: np.ndarray, bases: np.ndarray) -> list[np.ndarray]:
    """For the tokens since, until of each sample: log of the wait for the set that branches off there."""
    lattices, sizes = run.lattices, [until - since for _, since, until in parts]
    edges, states, word, before = (
        np.concatenate([getattr(sample, name)[since:until] for sample, since, until in parts])
        for name in ("edge", "state", "word", "before")
    )
    with np.errstate(divide="ignore"):
        mass = before + np.log(-np.expm1(lattices.log_p[edges]))
    counter = 2 * (run.place[word] + states - run.state[word] - np.repeat(bases, sizes)) + 1
    wait = np.log(-np.log(uniform(np.repeat(seeds, sizes), counter))) - mass
    wait[lattices.begin[states + 1] - lattices.begin[states] == 1] = np.inf
    ends = np.cumsum(sizes)
    return [wait[end - size : end] for size, end in zip(sizes, ends)]


def _left_behind(
    run: _Run, sample: _Sample, since: int, wait: np.ndarray, seed: np.uint64, base: int, k: int
) -> Iterator[tuple[float, int]]:
    """Log-arrivals of the k first sets that branch off the sample from token ``since`` on.

    ``wait`` are the waits of the first tokens. A token's set has at most the mass of what the
    tokens before it left, which only falls: once even the shortest wait for that would come
    after the k first sets, no later token counts.
    """
    while True:
        until = since + len(wait)
        best = np.argpartition(wait, k - 1)[:k] if len(wait) > k else np.arange(len(wait))
        if until == len(sample.edge) or (len(wait) >= k and _LEAST_WAIT - sample.before[until] > wait[best].max()):
            break
        until = min(since + 4 * len(wait), len(sample.edge))
        wait = _waits(run, [(sample, since, until)], np.array([seed]), np.array([base]))[0]
    for at in best:
        if np.isfinite(wait[at]):
            yield float(np.logaddexp(sample.arrival, wait[at])), int(since + at)


def samples(texts: list[str], keys: list[int], k: int, vocabulary: Vocabulary) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text its samples, most perturbed first: ids, log-probability, log of the inclusion score."""
    run = _Run(texts, vocabulary)
    lattices, count = run.lattices, len(texts)
    seeds = np.array([(key * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _MASK for key in keys], np.uint64)
    base = np.array([run.place[w] if w < len(run.place) else 0 for w in run.words[:-1]], np.int64)
    result: list[list[_Sample]] = [[] for _ in texts]
    waiting: list[list[tuple[float, int, int, tuple[int, ...]]]] = [[] for _ in texts]
    following = [np.inf] * count
    for number in range(k + 1):
        drawing = []
        of_sample = _mixed(seeds + np.uint64(number * 0xD1342543DE82EF95 & _MASK))
        for text in range(count):
            if number == 0:
                first = np.log(-np.log(float(uniform(of_sample[text : text + 1], np.zeros(1))[0])))
                drawing.append(text)
                following[text] = first
            elif waiting[text]:
                following[text] = waiting[text][0][0]
                drawing.append(text)
            else:
                following[text] = np.inf
        if number == k:
            break
        words_parts, start_parts, heads = [], [], []
        for text in drawing:
            begin, end = run.words[text], run.words[text + 1]
            if number == 0:
                words_parts.append(np.arange(begin, end))
                start_parts.append(run.state[begin:end])
                heads.append((text, None, 0, following[text]))
                continue
            arrival, parent_number, at, excluded = heapq.heappop(waiting[text])
            parent = result[text][parent_number]
            state = int(parent.state[at])
            low, high = lattices.begin[state], lattices.begin[state + 1]
            others = np.array([e for e in range(low, high) if e not in excluded])
            p = np.exp(lattices.log_p[others])
            place = 2 * (run.place[parent.word[at]] + state - run.state[parent.word[at]] - base[text])
            draw = float(uniform(of_sample[text : text + 1], np.array([place]))[0])
            edge = int(others[min(np.searchsorted(np.cumsum(p), draw * p.sum(), "right"), len(others) - 1)])
            gone = (*excluded, edge)
            if len(others) > 1:
                mass = parent.before[at] + np.log(np.exp(lattices.log_p[[e for e in others if e != edge]]).sum())
                wait = np.log(-np.log(float(uniform(of_sample[text : text + 1], np.array([place + 1]))[0])))
                heapq.heappush(waiting[text], (float(np.logaddexp(arrival, wait - mass)), parent_number, at, gone))
            word, rest = int(parent.word[at]), int(lattices.left[state]) - int(lattices.length[edge])
            later = np.arange(word + 1, end)
            words_parts.append(np.append(word, later) if rest else later)
            start_parts.append(np.append(state + int(lattices.length[edge]), run.state[later]) if rest else run.state[later])
            heads.append((text, (parent, at, edge), len(result[text]), arrival))
        if not heads:
            break
        sizes = [len(part) for part in words_parts]
        words = np.concatenate(words_parts)
        owner = np.repeat(np.array([head[0] for head in heads]), sizes)
        index, state, edge = run.descend(words, np.concatenate(start_parts), of_sample[owner], base[owner])
        bounds = np.searchsorted(index, np.append(0, np.cumsum(sizes)))
        fresh = []
        for head, low, high in zip(heads, bounds[:-1], bounds[1:]):
            text, branch, mine, arrival = head
            word, states, edges = words[index[low:high]], state[low:high], edge[low:high]
            since = 0
            if branch is not None:
                parent, at, taken = branch
                since = at + 1
                word = np.concatenate([parent.word[: at + 1], word])
                states = np.concatenate([parent.state[: at + 1], states])
                edges = np.concatenate([parent.edge[:at], [taken], edges])
            sample = _Sample(arrival, word, states, edges, lattices.log_p[edges])
            result[text].append(sample)
            fresh.append((text, mine, sample, since))
        parts = [(sample, since, min(since + _NEAR, len(sample.edge))) for _, _, sample, since in fresh]
        drawn = [text for text, *_ in fresh]
        waits = _waits(run, parts, of_sample[drawn], base[drawn])
        for (text, mine, sample, since), wait in zip(fresh, waits):
            for value, token in _left_behind(run, sample, since, wait, of_sample[text], base[text], k - mine):
                heapq.heappush(waiting[text], (value, mine, token, (int(sample.edge[token]),)))
    out = []
    for text, found in enumerate(result):
        of_text = []
        for sample in found:
            passed = sample.log_p + following[text]
            # Near its logarithm, ln(p * t'), for the small probabilities of long texts.
            score = passed if passed < -30 else float(np.log(-np.expm1(-np.exp(min(passed, 700.0)))))
            of_text.append((_ids(lattices, sample.edge, vocabulary), sample.log_p, score))
        out.append(of_text)
    return out


def _ids(lattices: Lattices, edges: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    pieces = lattices.piece[edges]
    spelled = np.flatnonzero(pieces < 0)
    if not len(spelled):
        return pieces.astype(np.uint32)
    parts, at = [], 0
    for k in spelled:
        parts.append(pieces[at:k])
        parts.append(vocabulary.byte_id[list(chr(-1 - int(pieces[k])).encode("utf-8", "surrogatepass"))])
        at = k + 1
    return np.concatenate([*parts, pieces[at:]]).astype(np.uint32)


SCHEMA = "doc_id long, sample int, n_pieces long, log_prob double, log_inclusion double"


def sampled(
    docs: DataFrame, model_path: str, k: int, alpha: float = 0.5, ids: bool = True, digest: bool = False
) -> DataFrame:
    """The k sampled segmentations of each text: doc_id, sample (from 1), n_pieces, log_prob, log_inclusion.

    With ``ids`` a column of piece ids, with ``digest`` their crc32 (little-endian unsigned
    32-bit) and ``round_trip``, whether they decode to the text. ``docs`` needs doc_id and text;
    null and empty texts have one segmentation, without pieces. Texts with fewer than k
    segmentations return all of them. Seeds come from doc_id, a null one as -1, so repeated
    rows return the same samples again. Other columns are ignored; an empty table gives no row.
    """
    if k < 1:
        raise ValueError("k must be at least 1")

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model_path, alpha)
        doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for begin, end in spans_of_texts(texts):
            keys = [xxhash.xxh64_intdigest(str(-1 if d is None else d)) for d in doc_ids[begin:end]]
            rows = []
            for doc_id, text, found in zip(doc_ids[begin:end], texts[begin:end], samples(texts[begin:end], keys, k, pieces)):
                plain = normalised(text).encode() if digest else b""
                for number, (of_sample, log_prob, log_inclusion) in enumerate(found, 1):
                    row = [doc_id, number, len(of_sample), log_prob, log_inclusion]
                    if ids:
                        row.append(of_sample)
                    if digest:
                        row += [zlib.crc32(of_sample.astype("<u4").tobytes()), pieces.decode(of_sample) == plain]
                    rows.append(row)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64()]
            kinds += [pa.list_(pa.int32())] * ids + [pa.int64(), pa.bool_()] * digest
            names = ["doc_id", "sample", "n_pieces", "log_prob", "log_inclusion"]
            names += ["ids"] * ids + ["ids_crc32", "round_trip"] * digest
            columns = [pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = SCHEMA + ", ids array<int>" * ids + ", ids_crc32 long, round_trip boolean" * digest
    return map_arrow(docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")), work, schema)


def decoded(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` with a column ``text``: what its ``ids`` decode to; null ids decode to null.

    Word marks become blanks and the one in front goes, bytes that are no UTF-8 become U+FFFD.
    """
    keep = [name for name in encoded.columns if name not in ("ids", "text")]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model_path, 1.0)
        texts = []
        for ids in batch.column(0).to_pylist():
            plain = None if ids is None else pieces.decode(np.array(ids, np.int64)).decode("utf-8", "replace")
            texts.append(plain if plain is None else plain.replace(SPACE, " ")[1:] if plain[:1] == SPACE else plain)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=["ids", *keep, "text"])

    source = encoded.select("ids", *keep)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in source.dtypes)
    return map_arrow(source, work, f"{schema}, text string").select(*[c for c in encoded.columns if c != "text"], "text")
