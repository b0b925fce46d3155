"""Order MinHash fingerprints: sensitive to edits, as they hash k-mers together with their order.

A text's k-mers are its runs of ``WORDS`` words, a word being at most ``LONGEST`` characters
other than white space; a shorter text is one k-mer. Runs of more than ``LONG_RUN`` characters
without white space, as in Chinese, Japanese or Thai, are first cut where a hash of the four
characters around a place says so: what is inserted or deleted moves the cuts around it only.
Each k-mer is numbered by how often it
occurred before. Of the numbered k-mers' hashes the leading bits choose one of ``BINS`` bins, the
others rank them within it. In each bin the ``TUPLE`` least are selected, put back into their
order in the text, and hashed as a tuple: one entry of the fingerprint. Dealing one hash into
bins takes the place of many hash functions. The likeness of two fingerprints is the share of
equal entries among the bins that either has.

All of it is column expressions; a document is worked on within its row. Looking up the next
document deals the ids into slices by cut points of their distribution; only a slice's rows
meet in a task, and the first row of each slice is handed to the one before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlake.llm.common import whole_text

WORDS = 3
LONGEST = 16
LONG_RUN = 64
#: One place in so many of a long run is a cut.
CUT_EVERY = 8
BIN_BITS = 5
BINS = 1 << BIN_BITS
TUPLE = 2
#: Low bits that hold a k-mer's place in its text; the others hold its hash.
PLACE_BITS = 31
_PLACE = (1 << PLACE_BITS) - 1


def _hash_of(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def _place_of(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(_PLACE)).cast("int")


def _packed(hashed: Column, place: Column) -> Column:
    return hashed.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place.cast("long"))


def _bin_of(packed: Column) -> Column:
    return F.shiftright(packed, 64 - BIN_BITS)


def _with_cuts(run: Column) -> Column:
    """A run of characters with blanks at its cuts; none between equal characters."""

    def cut(chars: Column) -> Column:
        def put(char: Column, i: Column) -> Column:
            following = F.get(chars, i + 1)
            around = F.xxhash64(F.get(chars, i - 1), char, following, F.get(chars, i + 2))
            here = (char != following) & (F.pmod(around, F.lit(CUT_EVERY)) == 0)
            return F.when(here, F.concat(char, F.lit(" "))).otherwise(char)

        return F.array_join(F.transform(chars, put), "")

    # Within an array of one, so that the characters are taken apart once and not at each place.
    return F.get(F.transform(F.array(F.regexp_extract_all(run, F.lit("(?s)."), F.lit(0))), cut), F.lit(0))


def _cut_up(text: Column) -> Column:
    """``text`` with cuts in its long runs; other texts as they are."""
    runs = F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))
    cut = F.transform(runs, lambda run: F.when(F.length(run) > LONG_RUN, _with_cuts(run)).otherwise(run))
    return F.when(text.rlike(rf"(?<!\S)\S{{{LONG_RUN + 1}}}"), F.array_join(cut, " ")).otherwise(text)


def with_fingerprint(frame: DataFrame, text: str, into: str) -> DataFrame:
    """``frame`` with the fingerprint of ``text``: ``bin-hash`` entries joined by dots.

    Null texts and texts of white space alone have an empty fingerprint.
    """
    keep = frame.columns
    at = F.col

    frame = frame.withColumn("__words", F.regexp_extract_all(_cut_up(whole_text(text)), F.lit(rf"\S{{1,{LONGEST}}}"), F.lit(0)))
    count = F.size("__words")
    starts = F.slice("__words", 1, F.greatest(count - (WORDS - 1), F.least(count, F.lit(1))))
    frame = frame.withColumn(
        "__kmers",
        F.transform(starts, lambda word, i: F.xxhash64(word, *[F.get("__words", i + k) for k in range(1, WORDS)])),
    )
    # Sorted by hash, then place: equal k-mers stand together, in the order of the text.
    frame = frame.withColumn("__runs", F.sort_array(F.transform("__kmers", lambda h, i: _packed(h, i))))

    def same(i: Column, back: Column, packed: Column) -> Column:
        """Whether the entry ``back`` places before i is of the same k-mer."""
        return (i >= back) & (_hash_of(F.get("__runs", i - back)) == _hash_of(packed))

    def occurrence(packed: Column, i: Column) -> Column:
        """How many entries of the same k-mer stand before i, found by halving steps."""
        steps = F.array(*[F.lit(1 << bit) for bit in range(PLACE_BITS - 1, -1, -1)])
        found = F.aggregate(
            steps, F.lit(0), lambda seen, step: F.when(same(i, seen + step, packed), seen + step).otherwise(seen)
        )
        return F.when(same(i, F.lit(1), packed), found).otherwise(F.lit(0))

    numbered = F.transform(
        "__runs", lambda packed, i: _packed(F.xxhash64(_hash_of(packed), occurrence(packed, i)), _place_of(packed))
    )
    frame = frame.withColumn("__ranked", F.sort_array(numbered))
    least = F.filter(
        "__ranked", lambda packed, i: (i < TUPLE) | (_bin_of(F.get("__ranked", i - TUPLE)) != _bin_of(packed))
    )
    in_order = F.transform(
        least, lambda packed: _packed(F.shiftleft(_bin_of(packed), PLACE_BITS), _place_of(packed))
    )
    frame = frame.withColumn("__chosen", F.sort_array(in_order))

    def member(i: Column, packed: Column, k: int) -> Column:
        other = F.get("__chosen", i + k)
        return F.when(_hash_of(other) == _hash_of(packed), F.get("__kmers", _place_of(other)))

    def entry(packed: Column, i: Column) -> Column:
        first = (i == 0) | (_hash_of(F.get("__chosen", i - 1)) != _hash_of(packed))
        hashed = F.xxhash64(*[member(i, packed, k) for k in range(TUPLE)])
        name = F.lpad(F.hex(_hash_of(packed) + BINS // 2), 2, "0")
        return F.when(first, F.concat(name, F.lit("-"), F.lower(F.lpad(F.hex(hashed), 16, "0"))))

    entries = F.transform("__chosen", entry)
    frame = frame.withColumn(into, F.array_join(entries, "."))
    return frame.select(*keep, at(into))


def likeness(left: str, right: str) -> Column:
    """The share of equal entries of two fingerprints; two empty ones are alike."""
    a, b = (F.filter(F.split(side, r"\."), lambda entry: entry != "") for side in (left, right))
    bins = F.size(F.array_union(*[F.transform(side, lambda entry: F.substring(entry, 1, 2)) for side in (a, b)]))
    return F.when(F.col(left) == F.col(right), 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(bins, F.lit(1)))


def _sliced(frame: DataFrame, slices: int) -> DataFrame:
    """With a slice number that rises with doc_id; null ids come first."""
    share = [k / slices for k in range(1, slices)]
    cuts = frame.agg(F.percentile_approx("doc_id", share, 10 * slices)).first()[0] if share else None
    points = F.array(*[F.lit(c) for c in sorted(set(cuts or []))]).cast("array<bigint>")
    return frame.withColumn("__slice", F.coalesce(F.size(F.filter(points, lambda c: c <= F.col("doc_id"))), F.lit(0)))


def with_next(docs: DataFrame, derived: Callable[[DataFrame], DataFrame], columns: list[str], slices: int) -> DataFrame:
    """``derived(docs)`` with ``next_<column>`` of the row of the next doc_id.

    ``docs`` has doc_id and text. After the last row comes the first; repeated ids are ordered
    by a hash of their text. The rows of a slice meet in one task, in order of their ids.
    """
    sliced = _sliced(docs, slices).withColumn("__order", F.xxhash64("text"))
    heads = sliced.groupBy("__slice").agg(F.min(F.struct("doc_id", "__order")).alias("__head"))
    heads = heads.select(F.col("__slice").alias("__of"), F.col("__head.doc_id").alias("__id"), F.col("__head.__order").alias("__first"))
    # One row a slice: as many as there are cut points, whatever the table's size.
    is_head = (F.col("__slice") == F.col("__of")) & F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__order") == F.col("__first"))
    first_rows = sliced.join(F.broadcast(heads), is_head).dropDuplicates(["__slice"])
    first_rows = derived(first_rows).select("__slice", F.struct(*columns).alias("__values"))
    by_slice = W.orderBy("__slice")
    whole = by_slice.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    after = first_rows.select(
        "__slice", F.coalesce(F.lead("__values").over(by_slice), F.first("__values").over(whole)).alias("__after")
    )
    within = W.partitionBy("__slice").orderBy(F.asc_nulls_first("doc_id"), "__order")
    rows = derived(sliced)
    following = rows.withColumn("__next", F.lead(F.struct(*columns)).over(within)).join(after, "__slice", "left")
    values = F.coalesce("__next", "__after")
    kept = [name for name in rows.columns if name not in ("__slice", "__order")]
    return following.select(*kept, *[values[name].alias(f"next_{name}") for name in columns])


def compared(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    ``docs`` needs doc_id and text, other columns are ignored; null texts count as empty.
    The edited text has the last floor(n_chars / 4) code points replaced by the first as many,
    or all, of the next document. Repeated rows come back as often as they are given; a lone
    row is its own next. An empty table gives no row.
    """
    slices = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    paired = with_next(whole, lambda d: with_fingerprint(d, "text", "fingerprint"), ["text", "fingerprint"], slices)
    n_chars = F.length("text")
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = paired.withColumn("n_chars", n_chars.cast("long")).withColumn(
        "edited",
        F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")), F.substring("next_text", F.lit(1), cut)),
    )
    edited = with_fingerprint(edited, "edited", "edited_fingerprint")
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
