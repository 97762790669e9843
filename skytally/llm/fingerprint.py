"""Document fingerprints by a homomorphic multiset hash of paragraphs.

Each paragraph (a non-empty line) is hashed to a wide vector, and a text's fingerprint is the sum of
its paragraphs' vectors, lane by lane, modulo powers of two. The order of paragraphs does not matter,
and a paragraph is added or taken away by adding or subtracting its vector alone.

The vector has ``WIDE`` lanes modulo 2**62, which tell unequal multisets apart; ``SIGNS`` lanes that
each count, in two halves modulo 2**32, how many paragraphs have a certain bit of a hash set; and the
number of paragraphs. Bits are signs: with ``s`` set bits among ``n`` the lane's sum of signs is
``2 s - n``, and the cosine of two such sums estimates the cosine of the two multisets, so likeness
needs the fingerprints alone. Its error is about ``1 / sqrt(2 * SIGNS)``.

Everything is DataFrame functions. A null text is empty; an empty text has the fingerprint of zeros;
two fingerprints of zeros are alike with 1, one with another text's with 0. Equal keys are ordered by
text, null keys come last. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.store import saved

WIDE, SIGNS = 8, 64
_MODULUS = (1 << 62) - 1
_HALVES = (1 << 32) + 1
_LOW = (1 << 32) - 1
_LANES = WIDE + SIGNS + 1


def with_vector(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the fingerprint of ``text``, an array of ``WIDE + SIGNS + 1`` longs.

    The hashes are a column of their own, so that each paragraph is hashed once and not once a lane.
    """
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda p: p != "")
    hashes = F.transform(lines, lambda p: F.array(*[F.xxhash64(F.lit(i), p) for i in range(WIDE + SIGNS // 32)]))
    zero = F.lit(0).cast("long")

    def lane(j: Column) -> Column:
        at, bit = (WIDE + 1 + F.floor((j - WIDE) / 32)).cast("int"), (j - WIDE) % 32
        wide = F.aggregate("__hashes", zero, lambda s, h: (s + F.element_at(h, j + 1)).bitwiseAND(F.lit(_MODULUS)))
        signs = F.aggregate(
            "__hashes", zero, lambda s, h: s + F.call_function("shiftrightunsigned", F.element_at(h, at), bit).bitwiseAND(F.lit(_HALVES))
        )
        return F.when(j < WIDE, wide).when(j < WIDE + SIGNS, signs).otherwise(F.size("__hashes").cast("long"))

    cut = F.transform(
        F.col("__hashes"), lambda h: F.transform(h, lambda x, i: F.when(i < WIDE, x.bitwiseAND(F.lit(_MODULUS))).otherwise(x))
    )
    return (
        df.withColumn("__hashes", hashes).withColumn("__hashes", cut)
        .withColumn(out, F.transform(F.sequence(F.lit(0), F.lit(_LANES - 1)), lane)).drop("__hashes")
    )


def printed(vector: str) -> Column:
    return F.array_join(F.transform(vector, lambda x: F.lower(F.hex(x))), ".")


def with_likeness(df: DataFrame, out: str, a: str, b: str) -> DataFrame:
    """``df`` with the likeness of two fingerprints, from 0 to 1, in ``out``."""

    def signs(v: str) -> Column:
        halves = F.flatten(F.transform(F.slice(v, WIDE + 1, SIGNS), lambda x: F.array(F.shiftright(x, 32), x.bitwiseAND(F.lit(_LOW)))))
        return F.transform(halves, lambda x: (2 * x - F.element_at(v, _LANES)).cast("double"))

    def dot(x: str, y: str) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)

    norm = F.sqrt(dot("__a", "__a") * dot("__b", "__b"))
    cosine = F.when(norm > 0, dot("__a", "__b") / norm).otherwise(0.0)
    alike = F.when(F.col(a) == F.col(b), 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))
    return df.withColumn("__a", signs(a)).withColumn("__b", signs(b)).withColumn(out, alike).drop("__a", "__b")


def with_next(docs: DataFrame, key: str, columns: list[str], order: list[Column]) -> DataFrame:
    """Each row with the next one's ``columns`` as the struct ``next``; the first follows the last.

    Rows run by descending ``key``, nulls last, equal keys by ``order``. They are dealt to ranges of
    the key, cut at its quantiles, and each range is sorted by itself. The first row of a range is
    sent along to the range above as a guest behind its last row: a row a range, and the table of
    those has a row a range as well.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [2**i for i in reversed(range(ranges.bit_length()))]
    cuts = docs.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] or []
    cuts = sorted(set(cuts))
    top = (1 << 63) - 1
    bounds = F.array(*[F.lit(c).cast("long") for c in [*cuts, *[top] * (2 * steps[0] - len(cuts))]])
    # the number of cuts below the key, by halving
    place = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(F.element_at(bounds, at + s) < F.col(key), at + s).otherwise(at)
    )
    tie = F.xxhash64(*order)
    dealt = docs.withColumn("__range", F.when(F.col(key).isNull(), -1).otherwise(place)).withColumn("__tie", tie)
    tops = dealt.groupBy("__range").agg(F.max(F.struct(key, F.bitwise_not("__tie"))).alias("__top"))
    above = F.lag("__range").over(Window.orderBy(F.desc("__range")))
    lowest = F.min("__range").over(Window.partitionBy())
    guests = F.broadcast(saved(tops.withColumn("__above", F.coalesce(above, lowest)), "ranges"))  # a row a range
    first = F.struct(key, F.bitwise_not("__tie")).eqNullSafe(F.col("__top"))
    own, guest = F.struct("__range", F.lit(0).alias("__guest")), F.struct(F.col("__above").alias("__range"), F.lit(1).alias("__guest"))
    sent = dealt.join(guests, "__range").withColumn("__to", F.explode(F.when(first, F.array(own, guest)).otherwise(F.array(own))))
    by = Window.partitionBy("__to.__range").orderBy("__to.__guest", F.desc_nulls_last(key), "__tie", *order)
    return (
        sent.withColumn("next", F.lead(F.struct(*columns)).over(by)).filter("__to.__guest = 0")
        .drop("__range", "__tie", "__top", "__above", "__to")
    )


def op10(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they and the next are."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(with_vector(texts, "text", "own"), "doc_id", ["text", "own"], [F.col("text")])
    kept, taken = F.col("n_chars") - F.col("half"), F.col("half")
    rows = (
        rows.withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("half", F.floor(F.col("n_chars") / 2))
        .withColumn("edited", F.concat(F.substring("text", F.lit(1), kept.cast("int")), F.substring("next.text", F.lit(1), taken.cast("int"))))
        .select("doc_id", "n_chars", "own", F.col("next.own").alias("following"), "edited")
    )
    rows = with_vector(rows, "edited", "changed")
    rows = with_likeness(with_likeness(rows, "near_edited", "own", "changed"), "near_next", "own", "following")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), printed("own").alias("fingerprint"),
        printed("changed").alias("edited_fingerprint"), "near_edited", "near_next",
    )
