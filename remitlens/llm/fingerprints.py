"""Document fingerprints (operator 8): threshold-scaled sketches.

A text's sketch holds every 64-bit hash of its word shingles below a fixed
fraction of the range, so sketches of texts of very unequal length stay
comparable: the union of two sketches is the sketch of both texts together,
and likeness and containment are read off the common hashes. Built from
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS_PER_SHINGLE = 5
FRACTION = 0.25
ROWS_PER_RANGE, MOST_RANGES = 2_000, 10_000
_EMPTY = "cast(array() as array<bigint>)"


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingle_hashes(text: Column, k: int = WORDS_PER_SHINGLE) -> Column:
    """Hashes of all runs of k words; of the whole sequence if there are fewer words."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")

    def runs(hashed):
        n = F.size(hashed)
        each = F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.xxhash64(F.slice(hashed, i, k)))
        return F.when(n >= k, each).when(n > 0, F.array(F.xxhash64(hashed))).otherwise(F.expr(_EMPTY))

    return bound(F.transform(words, lambda w: F.xxhash64(w)), runs)


def sketch(shingles: Column, fraction: float = FRACTION) -> Column:
    """Sorted distinct hashes below ``fraction`` of the range; the smallest one
    where none is (so only a text without words has an empty sketch)."""
    limit = F.lit(min(int(-(2**63) + fraction * 2**64), 2**63 - 1))

    def kept(all_):
        return bound(F.filter(all_, lambda h: h <= limit), lambda below: F.when(
            (F.size(below) > 0) | (F.size(all_) == 0), below).otherwise(F.array(F.array_min(all_))))

    return F.array_sort(F.array_distinct(bound(shingles, kept)))


def merged(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together."""
    return F.array_sort(F.array_union(a, b))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard likeness of two sketches; 1 for two empty ones."""
    common = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - common
    return F.when(either == 0, F.lit(1.0)).otherwise(common / either)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b holds; 1 for an empty a."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def as_text(sketch_: Column) -> Column:
    """The sketch as hexadecimal text, 16 digits for each hash."""
    return F.array_join(F.transform(sketch_, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def fingerprint(docs: DataFrame, text: str = "text", k: int = WORDS_PER_SHINGLE,
                fraction: float = FRACTION, name: str = "sketch") -> DataFrame:
    """``docs`` with the sketch of each whole text in column ``name`` (an older
    column of that name is replaced). A null or empty text, or one without
    words, has the empty sketch; equal texts have equal sketches. Row by row:
    repeated rows, null keys, an empty table and very long texts need nothing more."""
    return docs.withColumn(name, sketch(shingle_hashes(F.col(text), k), fraction))


def dealt_by_range(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` dealt into key ranges (``__part``) so that a window inside a range
    sees every row's successor in descending ``key`` (null keys last; after the
    last row comes the first).

    A range has about ``ROWS_PER_RANGE`` rows. The rows with the largest key of
    a range are also sent, as guests (``__guest``), to the end of the range
    above it, so rows move once and no window runs over the whole table. Ranges
    come from approximate quantiles; they set the balance, not the result.
    """
    n = docs.agg(F.count(F.lit(1))).first()[0]
    parts = min(MOST_RANGES, max(1, n // ROWS_PER_RANGE))
    cuts = docs.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)] or [1.0], 10 * MOST_RANGES)) \
        .first()[0] or []
    cuts = sorted(set(cuts if parts > 1 else []))
    steps = [2**i for i in reversed(range(max(1, len(cuts)).bit_length()))]
    if cuts:  # number of cuts below the key, by halving steps
        bounds = F.lit(cuts)
        within = F.aggregate(F.lit(steps), F.lit(0), lambda at, step: F.when(
            F.get(bounds, at + step - 1) < F.col(key), at + step).otherwise(at))
    else:
        within = F.lit(0)
    ranged = docs.withColumn("__range", within)
    tops = {r[0]: r[1] for r in ranged.groupBy("__range").agg(F.max(key)).collect()}  # at most MOST_RANGES rows
    if not tops:
        tops = {0: None}
    order = sorted(tops)
    above = {r: order[i + 1] if i + 1 < len(order) else order[0] for i, r in enumerate(order)}
    full = range(order[-1] + 1)
    top = F.get(F.array(*[F.lit(tops.get(r)).cast("long") for r in full]), F.col("__range"))
    to = F.get(F.array(*[F.lit(above.get(r)).cast("int") for r in full]), F.col("__range"))
    home = F.struct(F.col("__range").alias("range"), F.lit(False).alias("guest"))
    guest = F.struct(to.alias("range"), F.lit(True).alias("guest"))
    return ranged.withColumn("__at", F.explode(
        F.when(F.col(key).eqNullSafe(top), F.array(home, guest)).otherwise(F.array(home)))) \
        .select("*", F.col("__at.range").alias("__part"), F.col("__at.guest").alias("__guest")) \
        .drop("__at", "__range").repartition("__part")


def edited_and_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document its sketch, the sketch of its edited text, and their
    likeness, and the likeness to the next document's sketch.

    The edited text is the text whose last floor(n/3) code points are replaced
    by the first as many (or all) of the next document in descending key.
    Columns: key, n_chars, edited, sketch, edited_sketch, near_edited, near_next.
    A null text is empty. Null keys come last in that order; rows equal in key
    are ordered by their texts' hash, and a repeated row follows itself.
    """
    base = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = dealt_by_range(base, key).withColumn("tie", F.xxhash64("text"))
    w = Window.partitionBy("__part").orderBy("__guest", F.col(key).desc_nulls_last(), "tie")
    rows = fingerprint(dealt).withColumns({"next_text": F.lead("text").over(w), "next_sketch": F.lead("sketch").over(w)})
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.where(~F.col("__guest")).withColumns({"n_chars": n.cast("long"), "edited": edited})
    rows = fingerprint(rows, "edited", name="edited_sketch")
    return rows.select(key, "n_chars", "edited", "sketch", "edited_sketch",
                       likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
