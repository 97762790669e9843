"""Quality rules: what a text consists of, and lines that too many documents of a host share.

Text rules count words, symbols, repeated lines and repeated stretches of words within a text. Across
documents each line is normalised (lower case, white space to one space), hashed to 64 bits, and
counted by the number of distinct documents of the host that hold it. Lines above both limits, more
than ``LINE_DOCS`` documents and more than ``LINE_SHARE`` of the host's, are boilerplate and removed; a
document left with fewer than ``LEAST_WORDS`` words or less than ``LEAST_SHARE`` of its own is depleted
and rejected. Copies are one document: documents of a host count by the hash of their text, so a text
stored a thousand times loses no line for that.

Everything is DataFrame functions. Lines travel as hashes, once to be counted: by host, line and text
first, so that neither a hot host nor a hot line is a hot task, then by host and line, already added up
in each task. Lines above the limits come back per host and text in a join that Spark broadcasts if
the written table of such lines is small and otherwise sorts, splitting skewed partitions. Windows of
words are 64-bit hashes, too, and only a text in which one recurs sorts its own: a text's cost is a
sort of its words. Unequal lines of a host or windows of a text have equal hashes with a chance of their
number squared / 2**65. A task holds a text's words and hashes, some hundred bytes a word.

A null text is empty, has no words and fails the base rules. A null host is a host of its own. Repeated
rows are one document and get the same result each. Ties at a limit keep the line and the document. An
empty table gives no rows. Other columns stay or are not read; ``without_boilerplate`` adds none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.store import saved

LINE_DOCS, LINE_SHARE = 10, 0.001
LEAST_WORDS, LEAST_SHARE = 20, 0.5
WINDOW, REPEATED_PERCENT = 8, 30
SYMBOLS = "#*$%&|<>"


def _blanks(text: Column) -> Column:
    """Spaces for the other separators of words, but for line ends."""
    for c in "\t\x0b\x0c\r":
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def words(line: Column) -> Column:
    return F.array_remove(F.split(F.replace(_blanks(line), F.lit("\n"), F.lit(" ")), " "), "")


def lines(text: str) -> Column:
    """Lines of a text; a null text has none."""
    return F.coalesce(F.split(F.col(text), "\n"), F.array().cast("array<string>"))


def normalised(line: Column) -> Column:
    """What lines are compared by: empty for a line without words."""
    return F.lower(F.array_join(words(line), " "))


def named(value: Column, function) -> Column:  # noqa: ANN001
    """``function`` of a value that is computed once, however often the function uses it."""
    return F.get(F.transform(F.array(value), function), 0)


def repeated_words(w: Column) -> Column:
    """How many words lie in windows that occur twice or more among the words ``w``."""
    n = F.size(w)
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW)]))

    def covered(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def places(o: Column) -> Column:
            same = lambda i, j: F.get(o, i)["h"].eqNullSafe(F.get(o, j)["h"])
            recurring = F.filter(o, lambda x, i: same(i, i - 1) | same(i, i + 1))
            return F.array_sort(F.transform(recurring, lambda x: x["i"]))

        def union(p: Column) -> Column:
            # each place covers its words up to the next place's
            own = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
            return F.aggregate(own, F.lit(0).cast("long"), lambda s, x: s + x)

        return named(named(ordered, places), union)

    recurs = lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long"))
    return F.when(n >= WINDOW, named(hashes, recurs)).otherwise(F.lit(0).cast("long"))


def with_counts(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with a struct of the text rules' counts."""
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = whole
    for c in SYMBOLS:
        bare = F.replace(bare, F.lit(c), F.lit(""))
    filled = F.filter(lines(text), lambda x: F.trim(_blanks(x)) != "")

    def count(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(bare)).cast("long").alias("n_symbols"),
            named(filled, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
        )

    return df.withColumn(out, named(words(whole), count))


def failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > REPEATED_PERCENT * n_words)


def document(host: str, text: str) -> list[Column]:
    """What a document is told by: hashes of its host and of its text."""
    return [F.xxhash64(F.col(host), F.lit(0)).alias("host"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("doc")]


def line_hashes(text: str) -> Column:
    """Hash and number of words of each line that has a word."""
    held = F.filter(F.transform(lines(text), words), lambda w: F.size(w) > 0)
    return F.transform(held, lambda w: F.struct(F.xxhash64(F.lower(F.array_join(w, " "))).alias("line"), F.size(w).alias("words")))


def boilerplate(hashed: DataFrame, docs: int = LINE_DOCS, share: float = LINE_SHARE) -> DataFrame:
    """``host, line``, written: lines of ``hashed`` (``host, doc, lines``) in more documents of a host than both limits."""
    held = hashed.select("host", "doc", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    counted = held.distinct().groupBy("host", "line").count().filter(F.col("count") > docs)
    sizes = hashed.select("host", "doc").distinct().groupBy("host").agg(F.count("*").alias("of"))
    return saved(counted.join(sizes, "host").filter(F.col("count") > share * F.col("of")).select("host", "line"), "boilerplate")


def removals(hashed: DataFrame, found: DataFrame) -> DataFrame:
    """``host, doc, removed, lines``: for each text with boilerplate the words in it, and its hashes; a row a host and text."""
    held = hashed.select("host", "doc", F.posexplode("lines").alias("at", "x")).select("host", "doc", "at", "x.line", "x.words")
    once = held.join(found, ["host", "line"]).dropDuplicates(["host", "doc", "at"])
    return once.groupBy("host", "doc").agg(F.sum("words").alias("removed"), F.collect_set("line").alias("lines"))


def depleted(n_words: Column, removed: Column) -> Column:
    left = n_words - removed
    return (removed > 0) & ((left < LEAST_WORDS) | (left < LEAST_SHARE * n_words))


def without_boilerplate(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """Documents that pass the rules, without the lines that too many documents of their host share.

    Same columns; texts without such a line stay as they are.
    """
    inner = [*document(host, text), line_hashes(text).alias("lines")]
    hashed = saved(docs.select(*inner), "lines")
    found = removals(hashed, boilerplate(hashed)).withColumnsRenamed({c: f"__{c}" for c in ("host", "doc", "removed", "lines")})
    host_hash, doc_hash = document(host, text)
    rows = docs.join(found, (host_hash == F.col("__host")) & (doc_hash == F.col("__doc")), "left")
    counts = with_counts(rows, text, "__counts")
    passes = ~failed(F.col("__counts.n_words"), F.col("__counts.n_repeat_words")) & ~depleted(
        F.col("__counts.n_words"), F.coalesce(F.col("__removed"), F.lit(0))
    )
    left = F.filter(lines(text), lambda x: ~F.array_contains("__lines", F.xxhash64(normalised(x))))
    kept = F.when(F.col("__removed").isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return counts.filter(passes).withColumn(text, kept).select(*docs.columns)


def op12(docs: DataFrame) -> DataFrame:
    """Counts and verdicts of all documents."""
    inner = [*document("source", "text"), line_hashes("text").alias("lines")]
    measured = with_counts(docs, "text", "__c").select("doc_id", *inner, "__c.*")
    measured = saved(measured, "measured")
    found = removals(measured, boilerplate(measured)).select("host", "doc", "removed")
    removed = F.coalesce(F.col("removed"), F.lit(0))
    base = failed(F.col("n_words"), F.col("n_repeat_words"))
    return measured.join(found, ["host", "doc"], "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (~base & ~depleted(F.col("n_words"), removed)).alias("kept"), removed.cast("long").alias("n_boilerplate_words"),
    )


_WORD = r"[^\x20\x09-\x0D]+"
SQL = f"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
split AS MATERIALIZED (
  SELECT *, regexp_extract_all(text, '{_WORD}') AS w, string_split(text, chr(10)) AS l FROM docs),
windows AS (
  SELECT r, unnest(range(len(w) - {WINDOW - 1})) AS i FROM split WHERE len(w) >= {WINDOW}),
texts AS (SELECT s.r, i, array_to_string(s.w[i + 1 : i + {WINDOW}], ' ') AS x FROM windows JOIN split s ON s.r = windows.r),
recurring AS (SELECT r, unnest(list(i)) AS i FROM texts GROUP BY r, x HAVING count(*) > 1),
covered AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS place FROM recurring) GROUP BY r),
held AS MATERIALIZED (
  SELECT r, source, text, line, lower(array_to_string(regexp_extract_all(line, '{_WORD}'), ' ')) AS norm, len(regexp_extract_all(line, '{_WORD}')) AS words
  FROM (SELECT r, source, text, unnest(l) AS line FROM split) WHERE regexp_matches(line, '{_WORD}')),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM held GROUP BY r),
sizes AS (SELECT source, count(DISTINCT text) AS of FROM docs GROUP BY source),
frequent AS (
  SELECT held.source, norm FROM held JOIN sizes ON held.source IS NOT DISTINCT FROM sizes.source
  GROUP BY held.source, norm, of HAVING count(DISTINCT text) > {LINE_DOCS} AND count(DISTINCT text) > {LINE_SHARE} * of),
removed AS (
  SELECT r, sum(words) AS n FROM held JOIN frequent ON held.norm = frequent.norm AND held.source IS NOT DISTINCT FROM frequent.source GROUP BY r),
counted AS (
  SELECT doc_id, CAST(len(w) AS bigint) AS n_words, CAST(length(array_to_string(w, '')) AS bigint) AS word_chars,
    CAST(length(text) - length(translate(text, '{SYMBOLS}', '')) AS bigint) AS n_symbols, CAST(coalesce(dups.n, 0) AS bigint) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS bigint) AS n_repeat_words, CAST(coalesce(removed.n, 0) AS bigint) AS n_boilerplate_words
  FROM split LEFT JOIN dups ON dups.r = split.r LEFT JOIN covered ON covered.r = split.r LEFT JOIN removed ON removed.r = split.r),
judged AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEATED_PERCENT} * n_words AS base_failed,
    n_boilerplate_words > 0 AND (n_words - n_boilerplate_words < {LEAST_WORDS} OR n_words - n_boilerplate_words < {LEAST_SHARE} * n_words) AS depleted
  FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT depleted AS kept, n_boilerplate_words
FROM judged
"""
