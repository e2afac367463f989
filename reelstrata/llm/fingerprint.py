"""Document fingerprints by one-permutation MinHash.

Every shingle of five words is hashed once; the hash names a bin and a value, and each bin keeps its least value. An
empty bin copies a full one, found by probing in an order that is fixed for the bin and independent of the text
(optimal densification): PROBES random probes, then the full bin first in the bin's own random ranking. The low bits
of the bins are packed into a hex string; the share of equal bins, corrected for chance equality, estimates likeness.

Defined results: a text with one to four words has them as its only shingle; a NULL, empty or blank text has none and
the empty string as fingerprint, which is like the empty one only (1) and like no other (0); equal texts have equal
fingerprints. Among rows with equal doc_id the text decides the order; a row after the last is the first.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelstrata.llm.common import words

BINS, BITS, SHINGLE, PROBES = 256, 8, 5, 6
DIGITS = BITS // 4
RNG = np.random.default_rng(2017)
#: For each bin the bins that it probes, and a multiplier and shift of its ranking of all bins.
PROBE_TABLE = RNG.integers(0, BINS, (BINS, PROBES)).tolist()
RANK_BY = (RNG.integers(0, 1 << 20, BINS) * 2 + 1).tolist()
RANK_ADD = RNG.integers(0, 1 << 20, BINS).tolist()


def once(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def fingerprint(text: Column) -> Column:
    """The packed bins of a text as hex digits."""

    def hashes(w):
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (SHINGLE - 1), F.lit(1)))
        many = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + (k - 1)) for k in range(SHINGLE)]))
        return F.when(F.size(w) > 0, F.array_sort(many))

    def bins(h):
        # sorted hashes: the first of each bin is its least; the bin is the top bits, the value the low ones
        shift = 64 - (BINS - 1).bit_length()
        number = lambda x: F.shiftrightunsigned(x, shift).cast("int")
        held = F.transform(
            F.filter(F.transform(h, lambda x, i: F.struct(x.alias("x"), number(x).alias("b"), number(F.get(h, i - 1)).alias("p"))),
                     lambda s: s["p"].isNull() | (s["p"] != s["b"])),
            lambda s: F.struct(s["b"].alias("b"), F.lpad(F.hex(s["x"].bitwiseAND((1 << BITS) - 1)), DIGITS, "0").alias("v")),
        )
        return F.array_sort(held)  # negative hashes have the upper bins

    def spread(held):
        gap = lambda s, i: F.concat(
            F.repeat(F.lit("." * DIGITS), F.coalesce(s["b"] - F.get(held, i - 1)["b"] - 1, s["b"])), s["v"]
        )
        packed = F.rpad(F.array_join(F.transform(held, gap), ""), BINS * DIGITS, ".")
        return once(F.regexp_extract_all(packed, F.lit(r"..{%d}" % (DIGITS - 1)), F.lit(0)), lambda slots: filled(slots, held))

    def filled(slots, held):
        empty = F.lit("." * DIGITS)
        probes = F.expr("array(%s)" % ",".join("array(%s)" % ",".join(map(str, row)) for row in PROBE_TABLE))
        by, add = (F.expr("array(%s)" % ",".join(map(str, numbers))) for numbers in (RANK_BY, RANK_ADD))

        def probe(i, k):
            found = F.get(slots, F.get(F.get(probes, i), F.lit(k)))
            return F.when(found != empty, found)

        def ranked(i):  # the full bin that comes first in the ranking of bin i
            place = lambda s: ((s["b"] + 1) * F.get(by, i) + F.get(add, i)) % 1048573
            return F.array_min(F.transform(held, lambda s: F.struct(place(s).alias("r"), s["b"].alias("b"), s["v"].alias("v"))))["v"]

        def slot(x, i):
            return F.when(x != empty, x).otherwise(F.coalesce(*[probe(i, k) for k in range(PROBES)], ranked(i)))

        return F.array_join(F.transform(slots, slot), "")

    made = once(words(text), lambda w: once(hashes(w), lambda h: F.when(h.isNull(), F.lit("")).otherwise(once(bins(h), spread))))
    return F.lower(F.coalesce(made, F.lit("")))


def likeness(a: Column, b: Column) -> Column:
    """Estimate of the Jaccard similarity: share of equal bins, freed of the 2^-BITS that are equal by chance."""
    chance = 2.0**-BITS
    same = F.aggregate(
        F.sequence(F.lit(0), F.lit(BINS - 1)),
        F.lit(0),
        lambda n, i: n + (F.substring(a, i * DIGITS + 1, F.lit(DIGITS)) == F.substring(b, i * DIGITS + 1, F.lit(DIGITS))).cast("int"),
    )
    corrected = F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(corrected)


#: Rows of a range of ids whose neighbours are found together, and the number of ranges, both about.
RANGE_ROWS, MOST_RANGES, QUANTILES = 2_000, 100_000, 64


def ranges(docs: DataFrame) -> Column:
    """A number for each range of ids, rising with the id: QUANTILES ranges of equal rows, each cut into equal widths."""
    seen = docs.agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("doc_id", [i / QUANTILES for i in range(QUANTILES + 1)], 1000).alias("q"),
    ).first()
    edges = sorted(set(seen.q or [0]))
    cuts = max(1, min(round(seen.n / RANGE_ROWS), MOST_RANGES) // QUANTILES)

    def cell(low: int, high: int) -> Column:
        if high - low == 1:
            width = max(1, (edges[high] - edges[low]) // cuts + 1) if high < len(edges) else 1
            step = F.greatest(F.lit(0), F.least(F.lit(cuts - 1), F.floor((F.col("doc_id") - edges[low]) / width)))
            return (F.lit(low * cuts) + step).cast("long")
        middle = (low + high) // 2
        return F.when(F.col("doc_id") < edges[middle], cell(low, middle)).otherwise(cell(middle, high))

    return F.coalesce(cell(0, len(edges)), F.lit(-1).cast("long"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and likenesses to the edited and to the next text.

    Texts are dealt out once, by ranges of ids. The last row of a range takes as its next one the first row of the next
    range below that has rows; below the lowest stands the highest."""
    text = F.coalesce("text", F.lit(""))
    part = ranges(docs)
    rows = docs.select("doc_id", text.alias("text"), part.alias("part"), fingerprint(text).alias("fingerprint"))
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").desc_nulls_last(), F.col("text"))
    follow = rows.select(
        "*",
        F.lead("text").over(inside).alias("after"),
        F.lead("fingerprint").over(inside).alias("after_print"),
    )
    # Spark keeps the first row of each range before its exchange, so few texts are moved and fingerprinted here
    plain = docs.select("doc_id", text.alias("text"), part.alias("part"))
    heads = plain.withColumn("place", F.row_number().over(inside)).where("place = 1").select(
        F.col("part").alias("h_part"), F.col("text").alias("head_text"), fingerprint(F.col("text")).alias("head_print")
    )
    parts = docs.select(part.alias("part")).distinct()
    order = Window.orderBy(F.col("part").desc())  # of at most about MOST_RANGES numbers
    below = parts.select("part", F.lead("part").over(order).alias("next")).select(
        "part", F.coalesce("next", parts.agg(F.max("part")).scalar()).alias("h_part")
    )
    edge = below.join(heads, "h_part").select("part", "head_text", "head_print")
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    after = F.coalesce("after", "head_text")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(after, F.lit(1), half))
    made = follow.join(edge, "part").select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        edited.alias("edited"),
        "fingerprint",
        F.coalesce("after_print", "head_print").alias("next_print"),
    )
    made = made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
        fingerprint(F.col("edited")).alias("edited_fingerprint"), "next_print",
    )
    return made.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
    )
