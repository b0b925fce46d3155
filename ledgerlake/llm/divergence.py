"""How far the sources of a language are from each other in their words, exactly.

Terms are the runs of ASCII letters and characters beyond ASCII, A to Z in lower case. A language
keeps the V terms that stand in at least ``LEAST_DOCS`` of its documents (rows). A source of a
language, and the language as a whole, give a kept term the share
1 + floor(SCALE * (count + ADDED) / (N + ADDED * V)), N being its counts over all kept terms.

Part ``pair`` sums the differences of the shares of two sources over all kept terms. Shares are
long vectors that are mostly those of the count 0, so the sum is V times the difference of these
plus, for the terms that occur, what differs from it. The latter is added up in dense blocks of
sources and terms: cells are dealt by term, and beyond ``SOURCES`` sources by pairs of blocks of
sources, and each block is as small as that, whatever the term or the source.

Part ``term`` ranks the terms that a source uses more than its language does, by the difference.
A term is dominated by one with a count in the source that isn't lower, a count in the language
that isn't higher, and an earlier UTF-8 spelling: that one ranks before it whatever the totals
are. So of each partition only the skyband is retained, the terms that fewer than ``top`` others
of the partition dominate; the skybands are merged the same way, dealt by source and a hash of
the term, and what is left is ranked exactly.

Words are counted in a table per task that is handed on when it is full, summed by source and
term, and only then gathered by term: one row per source. All arithmetic is in whole numbers.
Null texts, languages and sources read as empty ones; repeated rows are documents of their own;
a group without terms has pairs like others and no terms; an empty table gives no row; other
columns are ignored. Texts have no greatest length.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import settle, small_batches

LEAST_DOCS, ADDED, SCALE, TOP = 30, 5, 1_000_000_000, 50
#: Entries of a task's table of counts before it is handed on.
MOST_COUNTS = 300_000
#: Sources and terms of a dense block, rows of a partition that are reduced at once.
SOURCES, TERMS, BAND_ROWS = 128, 4096, 1 << 16
#: Parts of a source in which skybands are merged.
PARTS = 16

#: Letters and bytes beyond ASCII stay, A to Z in lower case; all else ends a term.
_TERM_BYTES = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)).lower()
_SLICE = 1 << 20


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    spelled = text.translate(_TERM_BYTES)
    begin = 0
    while begin < len(spelled):
        end = begin + _SLICE
        if end < len(spelled):
            end = spelled.find(b" ", end)
            end = len(spelled) if end < 0 else end
        yield spelled[begin:end].split()
        begin = end


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents, summed over a part of a task each.

    ``docs`` needs text, lang and source.
    """
    small_batches(docs.sparkSession)
    fields = [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]

    def handed_on(tables: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, in_docs) in tables.items():
            if n:
                columns = [
                    pa.array([lang] * len(n), pa.string()),
                    pa.array([source] * len(n), pa.string()),
                    pa.array(list(n), pa.binary()).cast(pa.string()),
                    pa.array(list(n.values()), pa.int64()),
                    pa.array(list(map(in_docs.__getitem__, n)), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))
        tables.clear()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        entries = 0
        for batch in batches:
            for lang, source, text in zip(*(column.to_pylist() for column in batch.columns)):
                n, in_docs = tables.setdefault((lang, source), (Counter(), Counter()))
                before, seen = len(n), set()
                for terms in _terms(text):
                    n.update(terms)
                    seen.update(terms)
                in_docs.update(seen)
                entries += len(n) - before
                if entries > MOST_COUNTS:
                    yield from handed_on(tables)
                    entries = 0
        yield from handed_on(tables)

    read = docs.select(*_groups_of(), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return read.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _groups_of() -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term, n, lang_n, first: occurrences in the source and in its language of the
    terms that are kept; ``first`` marks one row of each term of a language."""
    summed = counted(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    return (
        summed.withColumns(
            {
                "lang_n": F.sum("n").over(whole),
                "lang_docs": F.sum("docs").over(whole),
                "first": F.row_number().over(whole.orderBy("source")) == 1,
            }
        )
        .where(F.col("lang_docs") >= least_docs)
        .select("lang", "source", "term", "n", "lang_n", "first")
    )


def share(count: str, total: str, terms: str) -> Column:
    """The share of a count, of any size, without rounding; null where no term is kept."""
    exact = f"cast({count} as decimal(20,0)) + {ADDED}"
    whole = f"cast({total} as decimal(20,0)) + {ADDED} * cast({terms} as decimal(20,0))"
    return F.expr(f"case when {terms} > 0 then 1 + (({exact}) * {SCALE}) div ({whole}) end")


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per source of a language: total and lang_total over the kept terms, their number
    ``terms``, the share ``zero`` of the count 0, and ``place`` among the ``sources`` of the language."""
    of_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    once = F.when(F.col("first"), F.col("lang_n"))
    of_lang = kept.groupBy("lang").agg(F.count_if("first").alias("terms"), F.sum(once).alias("lang_total"))
    sources = Window.partitionBy("lang")
    return (
        docs.select(*_groups_of()).distinct().join(of_source, ["lang", "source"], "left").join(of_lang, ["lang"], "left")
        .na.fill(0, ["total", "terms", "lang_total"])
        .withColumn("zero", share("0", "total", "terms"))
        .withColumn("place", F.row_number().over(sources.orderBy("source")).cast("long") - 1)
        .withColumn("sources", F.count(F.lit(1)).over(sources))
    )


# -- part term --


def skyband(count: np.ndarray, lang_count: np.ndarray, spelling: np.ndarray, k: int) -> np.ndarray:
    """The places of what fewer than k others dominate; ``spelling`` ranks the terms, all different.

    By falling count, rising count in the language and spelling, whatever dominates a term comes
    before it, and its first k dominators are in the band themselves: it is enough to look there.
    """
    order = np.lexsort((spelling, lang_count, -count))
    lang_count, spelling = lang_count[order], spelling[order]
    band = np.empty(0, np.int64)
    at = 0
    while at < len(order):
        some = np.arange(at, min(len(order), at + max(16, min(512, (1 << 22) // (len(band) + 1)))))
        at = int(some[-1]) + 1

        def dominators(of: np.ndarray, among: np.ndarray) -> np.ndarray:
            return (lang_count[among] <= lang_count[of][:, None]) & (spelling[among] < spelling[of][:, None])

        by_band = dominators(some, band).sum(1)
        some, by_band = some[by_band < k], by_band[by_band < k]
        # Those of the same lot: what stands before is counted, in the band or not; all are dominators.
        by_lot = np.tril(dominators(some, some), -1).sum(1)
        band = np.concatenate([band, some[by_band + by_lot < k]])
    return order[band]


def retained(terms: DataFrame, top: int) -> DataFrame:
    """The skybands of ``terms`` (lang, source, term, n, lang_n, value) within each partition."""

    def reduced(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches).combine_chunks()
        spelled = rows["term"].to_pylist()
        n, lang_n = rows["n"].to_numpy(), rows["lang_n"].to_numpy()
        places = defaultdict(list)
        for k, group in enumerate(zip(rows["lang"].to_pylist(), rows["source"].to_pylist())):
            places[group].append(k)
        kept = []
        for of_group in places.values():
            by_spelling = sorted(range(len(of_group)), key=lambda k: spelled[of_group[k]])
            spelling = np.empty(len(of_group), np.int64)
            spelling[by_spelling] = np.arange(len(of_group))
            of_group = np.array(of_group)
            kept.append(of_group[skyband(n[of_group], lang_n[of_group], spelling, k=top)])
        return rows.take(pa.array(np.sort(np.concatenate(kept)))).to_batches()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                rows += batch.num_rows
            if rows >= BAND_ROWS:
                yield from reduced(waiting)
                waiting, rows = [], 0
        if waiting:
            yield from reduced(waiting)

    return terms.mapInArrow(run, terms.schema)


def leading_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank: the ``top`` terms that a source uses more than its language."""
    totals = groups.select("lang", "source", "total", "terms", "lang_total")
    above = (
        kept.join(totals, ["lang", "source"])
        .withColumn("value", share("n", "total", "terms") - share("lang_n", "lang_total", "terms"))
        .where("value > 0")
        .select("lang", "source", "term", "n", "lang_n", "value")
    )
    part = F.pmod(F.xxhash64("term"), F.lit(PARTS))
    merged = retained(retained(above, top).repartition("lang", "source", part), top)
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    return (
        merged.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= top)
        .select("lang", "source", F.col("term").alias("item"), "value", "rank")
    )


# -- part pair --


def _block_differences(sources: int):
    names = ["lang", "one", "other", "difference"]
    kinds = pa.schema(list(zip(names, [pa.string(), pa.int64(), pa.int64(), pa.int64()])))

    def differences(key: tuple, rows: pa.Table) -> pa.Table:
        """For the sources of two blocks and some terms: the sums of the differences of their shares,
        less those of the shares of the count 0. Rows without a term list the sources."""
        lang, one, other, _ = (part.as_py() for part in key)
        place, share = rows["place"].to_numpy(), rows["share"].to_numpy()
        spelled = rows["term"].combine_chunks().dictionary_encode()
        spelled = spelled.combine_chunks() if isinstance(spelled, pa.ChunkedArray) else spelled
        is_cell = np.asarray(spelled.is_valid())
        code = np.asarray(spelled.indices.fill_null(0))[is_cell]
        order = np.argsort(place[~is_cell])
        places, zero = place[~is_cell][order], share[~is_cell][order]
        shares = np.repeat(zero[None, :], len(spelled.dictionary), axis=0)
        shares[code, np.searchsorted(places, place[is_cell])] = share[is_cell]
        second = np.flatnonzero(places // sources == other)
        pairs = [np.empty((3, 0), np.int64)]
        for k in np.flatnonzero(places // sources == one):
            beside = second[second > k]
            if len(beside):
                sums = np.abs(shares[:, beside] - shares[:, k : k + 1]).sum(0)
                sums -= len(shares) * np.abs(zero[beside] - zero[k])
                pairs.append(np.stack([np.full(len(beside), places[k]), places[beside], sums]))
        pairs = np.concatenate(pairs, axis=1)
        return pa.Table.from_arrays([pa.array([lang] * pairs.shape[1], pa.string()), *map(pa.array, pairs)], schema=kinds)

    return differences


def _with_blocks(rows: DataFrame, size: int, both_sides: bool) -> DataFrame:
    """Each row for every pair of blocks of sources, one <= other, that its source's block is in."""
    last = F.floor((F.col("sources") - 1) / size)
    block = F.floor(F.col("place") / size)
    if not both_sides:
        return rows.withColumn("one", block).withColumn("other", F.explode(F.sequence(block, last)))
    return rows.withColumn("__beside", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumns(
        {"one": F.least(block, "__beside"), "other": F.greatest(block, "__beside")}
    )


def source_pairs(kept: DataFrame, groups: DataFrame, block: int = SOURCES, block_terms: int = TERMS) -> DataFrame:
    """lang, source, item, value, rank: every other source of the language, the farthest first."""
    parts = F.greatest(F.ceil(F.col("terms") / block_terms), F.lit(1).cast("long"))
    columns = ["lang", "one", "other", "part", "place", "term", "share"]
    placed = groups.withColumn("parts", parts)
    cells = kept.join(placed.drop("zero"), ["lang", "source"]).withColumns(
        {"share": share("n", "total", "terms"), "part": F.pmod(F.xxhash64("term"), F.col("parts"))}
    )
    members = (
        placed.where("terms > 0")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        .withColumns({"term": F.lit(None).cast("string"), "share": F.col("zero")})
    )
    dealt = _with_blocks(cells, block, True).select(*columns).unionByName(
        _with_blocks(members, block, True).select(*columns)
    )
    sums = (
        dealt.groupBy("lang", "one", "other", "part")
        .applyInArrow(_block_differences(block), "lang string, one long, other long, difference long")
        .groupBy("lang", "one", "other")
        .agg(F.sum("difference").alias("difference"))
    )
    first = _with_blocks(groups, block, False).select(
        "lang", "one", "other", "terms", F.col("source").alias("a"), F.col("place").alias("a_place"), F.col("zero").alias("a_zero")
    )
    second = (
        groups.withColumn("other", F.floor(F.col("place") / block))
        .withColumn("one", F.explode(F.sequence(F.lit(0).cast("long"), F.col("other"))))
        .select("lang", "one", "other", F.col("source").alias("b"), F.col("place").alias("b_place"), F.col("zero").alias("b_zero"))
    )
    pairs = first.join(second, ["lang", "one", "other"]).where("a_place < b_place").drop("one", "other")
    pairs = pairs.withColumnsRenamed({"a_place": "one", "b_place": "other"}).join(sums, ["lang", "one", "other"], "left")
    value = F.coalesce(F.col("terms") * F.abs(F.col("a_zero") - F.col("b_zero")) + F.coalesce("difference", F.lit(0)), F.lit(0))
    sides = F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item")),
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return pairs.select("lang", value.alias("value"), F.inline(sides)).select(
        "lang", "source", "item", "value", F.row_number().over(ranked).alias("rank")
    )


def audited(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank over all of ``docs`` (text, lang, source)."""
    kept = settle(kept_terms(docs, least_docs), "divergence-terms")
    groups = settle(group_totals(docs, kept), "divergence-groups")
    pairs = source_pairs(kept, groups).withColumn("part", F.lit("pair"))
    terms = leading_terms(kept, groups, top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))
