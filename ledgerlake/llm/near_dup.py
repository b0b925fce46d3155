"""Near-duplicate texts by MinHash: banding, signature check, exact check, components.

A document's set are its distinct shingles of ``WORDS`` words, words being runs of other than
ASCII white space, A-Z in lower case; a shorter text is one shingle. Two documents are linked
if 100 * |A & B| >= 75 * |A | B|; every link that is used is confirmed on the full sets.

1. One pass over the texts gives each document's set size, a 128-bit digest of the set and 128
   universal-hash minima. Documents of equal sets are linked by their digest alone: from here
   on the least document stands for its copies, so copies cost nothing further.
2. Four minima make a band, 32 bands: a pair of similarity 0.75 misses all bands with
   probability 5e-6. The documents of a band's value are a bucket.
3. Each bucket's members are compared with the bucket's leader, the member that meets most
   others: a star, not all pairs. Pairs whose 128 minima agree in fewer than 70 places (a
   pair of 0.75 has fewer with probability 1e-6) are dropped, the others checked exactly.
4. Buckets whose members are not yet in one component are worked off whole: small ones pair by
   pair between components, large ones in blocks, each pair of blocks one small matrix
   product that counts all common shingles exactly and returns a spanning forest of its links.
   A component with many members in a bucket has blocks of its own, which are compared with
   those of others only; the rest share mixed blocks.
5. Components by alternating large-star and small-star.

Cost: buckets that fall into one component by step 3 cost one comparison a member. In a large
bucket of which members stay apart, the work is that of all pairs of blocks of different components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import discard, map_arrow, settle, whole_text, with_ids, without_ids
from ledgerlake.llm.components import connected_components

WORDS = 5
PERCENT = 75
HASHES, ROWS = 128, 4
BANDS = HASHES // ROWS
LEAST_AGREEING = 70
SMALL_BUCKET = 24
BLOCK = 512

_SEED = np.random.default_rng(20_240_607)
_FACTORS = _SEED.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _SEED.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_PLACES = np.array([pow(0x9E3779B97F4A7C15, j, 1 << 64) for j in range(WORDS)], dtype=np.uint64)


class _WordHashes(dict):
    """64-bit hash of each word met; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


#: One for all tasks of a process: small, so that it may stay.
_HASHES = _WordHashes()


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles; empty without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    of_word = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    count = len(words) - width + 1
    mixed = np.full(count, width, np.uint64)
    for j in range(width):
        mixed += of_word[j : j + count] * _PLACES[j]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each universal hash a * x + b (mod 2^64) over the set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 256):
        part = shingles[at : at + 256, None] * _FACTORS
        part += _SHIFTS
        np.minimum(least, part.min(axis=0), out=least)
    return least


def _signed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes, digests, signatures = [], [], []
    bands = np.zeros((batch.num_rows, BANDS), np.uint64)
    for row, text in enumerate(batch.column(1).to_pylist()):
        shingles = shingle_set(text)
        sizes.append(len(shingles))
        if not len(shingles):
            digests.append(None)
            signatures.append(None)
            continue
        digests.append(xxhash.xxh3_128_digest(shingles.tobytes()))
        least = minima(shingles)
        signatures.append((least >> np.uint64(48)).astype(np.uint16).tobytes())
        for band, rows in enumerate(least.reshape(BANDS, ROWS)):
            bands[row, band] = xxhash.xxh3_64_intdigest(rows.tobytes(), seed=band)
    keys = pa.ListArray.from_arrays(
        pa.array(np.arange(0, bands.size + 1, BANDS), pa.int32()), pa.array(bands.view(np.int64).ravel())
    )
    yield pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
         pa.array(signatures, pa.binary()), keys],
        names=["doc_id", "n_shingles", "digest", "signature", "bands"],
    )


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest and signature (null without words), bands."""
    return map_arrow(
        docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")),
        _signed,
        "doc_id long, n_shingles long, digest binary, signature binary, bands array<long>",
    )


def _sets(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    packed = [shingle_set(text).tobytes() for text in batch.column(1).to_pylist()]
    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["doc_id", "shingles"])


def _shingles_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, shingles) of the documents in ``wanted(doc_id)``, one row each."""
    texts = with_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")), wanted)
    return map_arrow(texts, _sets, "doc_id long, shingles binary").dropDuplicates(["doc_id"])


def linked(left: np.ndarray, right: np.ndarray) -> bool:
    common = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * common >= PERCENT * (len(left) + len(right) - common) and common > 0


def _agreeing(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, HASHES) for k in (2, 3))
    keep = (left == right).sum(axis=1) >= LEAST_AGREEING
    yield batch.select([0, 1]).filter(pa.array(keep))


def _confirmed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    lefts, rights = batch.column(2).to_pylist(), batch.column(3).to_pylist()
    keep = [linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in zip(lefts, rights)]
    yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, signed: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of ``pairs(u, v)`` that are links: first by signature, then on the full sets."""
    of = signed.select("doc_id", "signature")
    with_both = (
        pairs.join(of.select(F.col("doc_id").alias("u"), F.col("signature").alias("left")), "u")
        .join(of.select(F.col("doc_id").alias("v"), F.col("signature").alias("right")), "v")
        .select("u", "v", "left", "right")
    )
    likely = settle(map_arrow(with_both, _agreeing, "u long, v long"), "likely")
    wanted = likely.select(F.col("u").alias("doc_id")).unionAll(likely.select(F.col("v").alias("doc_id"))).distinct()
    sets = settle(_shingles_of(docs, wanted), "shingles")
    full = (
        likely.join(sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("left")), "u")
        .join(sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("right")), "v")
        .select("u", "v", "left", "right")
    )
    confirmed = settle(map_arrow(full, _confirmed, "u long, v long"), "links")
    discard(likely)
    discard(sets)
    return confirmed


def forest_of_block(ids: np.ndarray, parts: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links between different ``parts`` among the given sets.

    Common shingles of all pairs are counted exactly, as a product of 0/1 matrices over a few
    thousand shingles at a time, so that memory stays bounded.
    """
    lengths = np.array([len(s) for s in sets])
    rows = np.repeat(np.arange(len(sets)), lengths)
    _, columns, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[columns] > 1
    rows, columns = rows[shared], np.unique(columns[shared], return_inverse=True)[1]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width, total = 4096, int(columns[-1]) + 1 if len(columns) else 0
    for begin in range(0, total, width):
        low, high = np.searchsorted(columns, [begin, begin + width])
        present = np.zeros((len(sets), min(width, total - begin)), np.float32)
        present[rows[low:high], columns[low:high] - begin] = 1
        common += present @ present.T
    exact = common.astype(np.int64)
    together = 100 * exact >= PERCENT * (lengths[:, None] + lengths[None, :] - exact)
    _, root = np.unique(parts, return_inverse=True)
    root = root.copy()
    forest = []
    for a, b in zip(*np.nonzero(np.triu(together, 1))):
        if root[a] != root[b]:
            forest.append((int(ids[a]), int(ids[b])))
            root[root == root[b]] = root[a]
    return forest


def _block_links(block: pd.DataFrame) -> pd.DataFrame:
    block = block.drop_duplicates("doc_id")
    sets = [np.frombuffer(s, np.uint64) for s in block["shingles"]]
    forest = forest_of_block(block["doc_id"].to_numpy(), block["part"].to_numpy(), sets)
    return pd.DataFrame(forest, columns=["u", "v"], dtype="int64")


def _block_pairs(members: DataFrame) -> DataFrame:
    """(key, low, high, doc_id, part): the pairs of blocks that each of ``members(key, n, doc_id, part)`` is in.

    Blocks 0 to ``mixed`` - 1 of a key hold the members of parts smaller than a block; each larger part
    has blocks of its own behind them, and no two of these are paired.
    """
    size = BLOCK // 2
    held = members.groupBy("key", "part").agg(F.count("*").alias("held")).where(F.col("held") >= size)
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    large = held.withColumn("own", F.ceil(F.col("held") / F.lit(size)).cast("int"))
    large = large.withColumn("first", F.coalesce(F.sum("own").over(before), F.lit(0)).cast("int"))
    of_key = large.groupBy("key").agg(F.sum("own").cast("int").alias("owned"), F.sum("held").alias("in_large"))
    placed = members.join(large.drop("held"), ["key", "part"], "left").join(of_key, "key", "left")
    rest = F.col("n") - F.coalesce("in_large", F.lit(0))
    placed = placed.withColumn("mixed", F.ceil(rest / F.lit(size)).cast("int"))
    placed = placed.withColumn("first", F.col("mixed") + F.col("first"))
    spread = F.pmod(F.xxhash64("doc_id", "key"), F.coalesce("own", "mixed")).cast("int")
    blocks = F.sequence(F.lit(0), F.col("mixed") + F.coalesce("owned", F.lit(0)) - 1)
    own = F.col("own").isNotNull()
    others = F.filter(blocks, lambda x: ~own | (x < F.col("first")) | (x >= F.col("first") + F.col("own")))
    dealt = placed.withColumn("block", F.coalesce("first", F.lit(0)) + spread).withColumn("other", F.explode(others))
    return dealt.select(
        "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "doc_id", "part"
    )


def _blockwise_links(members: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between components within large buckets; ``members(key, n, doc_id, part)``."""
    pairs = _block_pairs(members)
    sets = _shingles_of(docs, members.select("doc_id").distinct())
    return (
        pairs.join(sets, "doc_id")
        .groupBy("key", "low", "high")
        .applyInPandas(_block_links, "u long, v long")
        .distinct()
    )


def _part_of(members: DataFrame, components: DataFrame) -> DataFrame:
    parts = components.select(F.col("node").alias("doc_id"), "component")
    return members.join(parts, "doc_id", "left").withColumn("part", F.coalesce("component", "doc_id")).drop("component")


def classes(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``docs`` needs doc_id and text; other columns are ignored. Null and empty texts and such
    of white space alone have no shingle and form a component of their own, as does a document
    like no other. ``component_id`` is the least doc_id reachable, ``kept`` marks its row.
    Repeated rows come back as often as they are given. An empty table gives no row.
    """
    signed = settle(signatures(docs), "signatures")
    leaders = signed.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    first = signed.join(leaders.select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    first = settle(first.select("doc_id", "signature", "bands"), "firsts")

    band_rows = first.select("doc_id", F.explode("bands").alias("key"))
    buckets = band_rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = settle(band_rows.join(buckets, "key").select("key", "n", "doc_id"), "members")
    # The member that meets most others leads its bucket: close copies gather around it.
    met = members.groupBy("doc_id").agg(F.sum("n").alias("met"))
    ranked = members.join(met, "doc_id")
    heads = ranked.groupBy("key").agg(F.max(F.struct("met", (-F.col("doc_id")).alias("back"))).alias("head"))
    stars = (
        members.join(heads.select("key", (-F.col("head.back")).alias("head")), "key")
        .where("doc_id <> head")
        .select(F.greatest("doc_id", "head").alias("u"), F.least("doc_id", "head").alias("v"))
        .distinct()
    )
    stars = settle(stars, "stars")
    star_links = _verified(stars, first, docs)
    after_stars = settle(connected_components(star_links), "components")

    open_rows = settle(_part_of(members, after_stars), "parts")
    split = open_rows.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
    apart = settle(open_rows.join(split.select("key"), "key", "left_semi"), "apart")
    small = apart.where(F.col("n") <= SMALL_BUCKET)
    pairs = (
        small.alias("a")
        .join(small.alias("b"), "key")
        .where("a.doc_id > b.doc_id and a.part <> b.part")
        .select(F.col("a.doc_id").alias("u"), F.col("b.doc_id").alias("v"))
        .distinct()
        .join(stars, ["u", "v"], "left_anti")
    )
    pair_links = _verified(pairs, first, docs)
    block_links = settle(_blockwise_links(apart.where(F.col("n") > SMALL_BUCKET), docs), "links")
    all_links = star_links.unionAll(pair_links).unionAll(block_links)
    components = settle(connected_components(all_links), "components")
    for frame in (members, stars, after_stars, open_rows, apart, star_links, pair_links, block_links, first):
        discard(frame)

    # Copies point at their first document, that one at its component.
    of_digest = (
        leaders.join(components.withColumnRenamed("node", "doc_id"), "doc_id")
        .select("digest", "component")
    )
    class_of = leaders.join(of_digest, "digest", "left").select(
        "digest", F.coalesce("component", "doc_id").alias("component")
    )
    found = signed.select("doc_id", "n_shingles", "digest").join(class_of, "digest", "left")
    component = F.coalesce("component", "doc_id")
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: that of its kept document, all columns as they are.

    Of repeated rows of a kept document one stays. A row with a null doc_id stands for itself
    and stays. ``docs`` must not have columns whose names begin with ``__``.
    """
    found = settle(classes(docs.where("doc_id is not null")), "classes")
    dropped = found.where("not kept").select("doc_id").distinct()
    repeated = found.where("kept").groupBy("doc_id").count().where("count > 1").select("doc_id")
    kept = without_ids(docs, dropped.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType)))
    once = repeated.select(F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    several = with_ids(kept, once).dropDuplicates(["doc_id"])
    return without_ids(kept, once).unionAll(several)
