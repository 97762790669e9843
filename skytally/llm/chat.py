"""Chat formatting of logged conversations, after collapsing cumulative snapshots.

Logs often hold a conversation several times, once for each turn it had grown by. A running sum of
hashes of (place, role, text) over the turns identifies every prefix. A conversation goes when its
whole hash is a prefix of a longer one; of conversations equal in every turn the smallest id stays.
The maximal ones are rendered, each turn between markers.

Both rules are joins on distinct prefixes: copies are grouped first, with partial sums, so a
conversation logged a million times is one row in the joins. Everything is DataFrame functions.

Turns are ordered by ``turn`` (nulls last), then role and text, and counted by place, so gaps and
repeated numbers do not matter; repeated rows are turns of their own. A null role or text differs from
an empty one when prefixes are compared, and is rendered empty. Rows without a conversation id are one
conversation. Markers inside a text are escaped, so a text cannot end its turn. Other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytally.llm.store import saved

# The markers of a turn.
START, END = "<|im_start|>", "<|im_end|>"
#: Lanes of 31 bits: sums of up to 2 ** 32 turns stay within a long.
LANES = 4


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def rendered_turn(role: Column, text: Column) -> Column:
    role, text = (escaped(F.coalesce(c, F.lit(""))) for c in (role, text))
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END), F.lit("\n"))


def prefixes(turns: DataFrame) -> DataFrame:
    """Every turn with its place and the hash of all turns up to it."""
    by = Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("turn"), F.asc_nulls_last("role"), F.asc_nulls_last("text"))
    placed = turns.withColumn("place", F.row_number().over(by))
    nulls = F.col("role").isNull().cast("int") + 2 * F.col("text").isNull().cast("int")
    lanes = [
        F.xxhash64(F.lit(i), "place", nulls, F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit("")))
        .bitwiseAND(F.lit((1 << 31) - 1)).alias(f"h{i}")
        for i in range(LANES)
    ]
    so_far = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hashed = placed.select("*", *lanes)
    return hashed.select(
        "conv_id", "place", "role", "text", F.array(*[F.sum(f"h{i}").over(so_far) for i in range(LANES)]).alias("prefix")
    )


def maximal(marked: DataFrame) -> DataFrame:
    """Conversations that prefix no longer one: the least id of each text, its length, copies and snapshots under it."""
    lengths = marked.groupBy("conv_id").agg(
        F.max("place").alias("n_turns"), F.max_by("prefix", "place").alias("whole")
    )
    # conversations of one text are one row from here on
    texts = lengths.groupBy("n_turns", "whole").agg(
        F.min(F.struct(F.col("conv_id").isNull().alias("null"), F.col("conv_id").alias("id"))).alias("least"),
        F.count(F.lit(1)).alias("n_copies"),
    )
    turned = marked.join(lengths.select(F.col("conv_id").alias("__id"), "n_turns"), F.col("conv_id").eqNullSafe(F.col("__id")))
    reached = turned.filter("place < n_turns").groupBy(F.col("place").alias("n_turns"), F.col("prefix").alias("whole")).agg(F.lit(1).alias("__more"))
    return texts.join(reached, ["n_turns", "whole"], "left_anti").select(
        F.col("least.id").alias("conv_id"), "n_turns", "n_copies"
    )


def formatted(turns: DataFrame) -> DataFrame:
    """The maximal conversations as ``conv_id, n_turns, n_copies, chat``."""
    marked = saved(prefixes(turns.select("conv_id", "turn", "role", "text")), "turns")
    kept = maximal(marked).withColumnRenamed("conv_id", "__id")
    chosen = marked.join(kept, F.col("conv_id").eqNullSafe(F.col("__id")))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("place", "role", "text"))), lambda t: rendered_turn(t["role"], t["text"]))
    return chosen.groupBy("conv_id", "n_turns", "n_copies").agg(F.array_join(lines, "").alias("chat"))


SQL = """
WITH convs AS (
  SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY turn NULLS LAST, role NULLS LAST, text NULLS LAST) AS turns
  FROM conversations GROUP BY conv_id),
texts AS (SELECT turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM convs GROUP BY turns),
kept AS (
  SELECT * FROM texts a WHERE NOT EXISTS (
    SELECT 1 FROM texts b WHERE b.turns[1] IS NOT DISTINCT FROM a.turns[1] AND len(b.turns) > len(a.turns)
      AND b.turns[1:len(a.turns)] = a.turns)),
lines AS (SELECT conv_id, n_copies, len(turns) AS n_turns, unnest(turns) AS turn, generate_subscripts(turns, 1) AS i FROM kept)
SELECT conv_id, CAST(n_turns AS int) AS n_turns, n_copies,
  string_agg('<|im_start|>' || replace(replace(coalesce(turn.r, ''), '\\', '\\\\'), '<|', '<\\|') || chr(10)
    || replace(replace(coalesce(turn.t, ''), '\\', '\\\\'), '<|', '<\\|') || '<|im_end|>' || chr(10), '' ORDER BY i) AS chat
FROM lines GROUP BY conv_id, n_turns, n_copies
"""


def op4(turns: DataFrame) -> DataFrame:
    return formatted(turns)
