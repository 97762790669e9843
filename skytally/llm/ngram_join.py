"""Joins texts whose sets of word n-grams have a high Jaccard similarity, exactly, by signature trees.

A text's set holds hashes of its distinct runs of ``shingle`` words; texts with equal sets are one
node from the start, and sets are similar from a Jaccard similarity of ``percent`` hundredths. Two nodes can only be similar if they share one of the first tokens of their sets,
in any order of tokens common to all; the first ``n - ceil(t n) + 1`` will do. The order here puts
tokens that many texts share last (their counts are gathered from all texts, the most frequent
``HOT_TOKENS`` are kept, and what is not among them only costs time), so a passage in a third of all texts
brings those texts together only where they consist of it.

The texts that share a first token are a group, as far as sizes allow: of a pair, the smaller text must have the
token among fewer still, ``n - ceil(2 t n / (1 + t)) + 1``. A group's nodes form a tree by size: an inner node has
the OR of its members' token bitmaps and the ranges of their sizes and bits, and two subtrees are traversed
together until the greatest overlap that these allow is too small. Pairs that remain are verified on
the sets themselves. This happens twice: first each member's most promising partner, then, with what
that linked, only pairs that lie in different components so far. A group of thousands of near copies thus costs a
link for each, not all pairs. Groups beyond ``GROUP`` nodes are split, and the parts meet in pairs.

Nothing of all documents is collected or broadcast but the table of hot tokens, 16 bytes each, and a filter of
bits that spares texts without partners the last shuffle, both of bounded size. A null or empty text
has an empty set and is linked with nothing. Rows with equal or null keys are rows of their own; a
component's id is its least key that is not null. Sets are compared as 64-bit hashes of their tokens. Other
columns are not read, and kept by :func:`deduplicated`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.components import components
from skytally.llm.store import saved
from skytally.llm.tokens import as_bytes, combine, hashed_words, mix, parts_of, pieces_of, rows_of

#: What :func:`op6` and :func:`classes` go by, and what :func:`deduplicated` does.
SHINGLE, PERCENT = 4, 85
NEAR_SHINGLE, NEAR_PERCENT = 5, 80
HOT_TOKENS, HOT_IN_CHUNK, HOT = 1 << 20, 2, 4
CHUNK_WORDS = 1 << 20
#: Bits of a token bitmap: two for each token, within these bounds.
LEAST_BITS, MOST_BITS = 1 << 11, 1 << 15
BUCKET_ROWS = 1 << 18
GROUP, LEAF = 2048, 32
#: Tokens in so many texts are grouped by Spark's own aggregates, not a bucket at a time in one task.
WIDESPREAD = 1 << 16
#: Bytes of text worked on at a time.
SLICE = 1 << 19
#: Of the filter that keeps texts out of a shuffle that no pair needs: 16 MB.
FILTER_BITS = 1 << 27
_U = np.uint64


def sets(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all rows, sorted within each, and where each row's begin."""
    words, offsets = hashed_words(texts)
    row, counts = rows_of(offsets), np.diff(offsets)
    out = words
    for i in range(1, n):
        out = combine(out[: len(words) - i], words[i:]) if i < len(words) else out[:0]
    whole = np.flatnonzero((counts > 0) & (counts < n))
    short = [combine(np.array([len(w)], _U), mix(np.cumsum(mix(w + np.arange(len(w)).astype(_U))))[-1:]) for w in (words[offsets[i] : offsets[i + 1]] for i in whole)]
    last = len(out)
    inside = row[:last] == row[n - 1 : n - 1 + last] if last else np.zeros(0, bool)
    tokens, owner = np.concatenate([out[inside], *short]), np.concatenate([row[:last][inside], whole])
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    tokens, owner = tokens[fresh], owner[fresh]
    return tokens, np.searchsorted(owner, np.arange(len(texts) + 1))


def nodes_of(tokens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each row's set; 0 for empty ones."""
    sums = np.concatenate([[_U(0)], np.cumsum(mix(tokens ^ _U(0x5851F42D4C957F2D)), dtype=_U)])
    size = np.diff(starts)
    found = mix(sums[starts[1:]] - sums[starts[:-1]] + size.astype(_U))
    return np.where(size > 0, np.where(found == 0, _U(1), found), _U(0)).view(np.int64)


def bitmaps(tokens: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """A bitmap of the tokens of each row, as wide as their number asks for."""
    out = [b""] * (len(starts) - 1)
    size = np.diff(starts)
    width = np.clip(1 << np.ceil(np.log2(np.maximum(2 * size, 1))).astype(np.int64), LEAST_BITS, MOST_BITS)
    for w in np.unique(width).tolist():
        for some in np.array_split(np.flatnonzero(width == w), max(1, int((width == w).sum()) * w >> 25)):
            lengths = size[some]
            at = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(starts[some], lengths)
            bits = np.zeros((len(some), w), bool)
            bits[np.repeat(np.arange(len(some)), lengths), tokens[at] >> _U(64 - w.bit_length() + 1)] = True
            for i, row in zip(some.tolist(), np.packbits(bits, axis=1)):
                out[i] = row.tobytes()
    return out


def folded(bits: np.ndarray) -> np.ndarray:
    """Bitmaps of half the width: neighbouring bits are one."""
    wide = np.unpackbits(bits.view(np.uint8), axis=1)
    return np.packbits(wide.reshape(len(wide), -1, 2).any(2), axis=1).view(_U)


def prefix_length(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


def indexed_length(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """How many first tokens the smaller text of a pair can have the first common one among."""
    return np.where(n > 0, n - (2 * percent * n + 99 + percent) // (100 + percent) + 1, 0)


def _paired(token: np.ndarray, n: np.ndarray, early: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Rows, in order of token and size, that a row of their token may pair with by size and place."""
    if not len(token):
        return np.zeros(0, bool)
    at = np.arange(len(token))
    good = np.zeros(len(token), bool)
    good[:-1] = early[:-1] & (token[1:] == token[:-1]) & (percent * n[1:] <= 100 * n[:-1])
    # the nearest smaller row that has the token early
    last = np.maximum.accumulate(np.where(early, at, -1))
    before = np.concatenate([[-1], last[:-1]])
    some = before >= 0
    good[some] |= (token[before[some]] == token[some]) & (percent * n[some] <= 100 * n[before[some]])
    return good


def described(docs: DataFrame, key: str, text: str, shingle: int = SHINGLE) -> DataFrame:
    """A row for each text (its node, size, bitmap) and for each token several texts of a chunk share (``token``, ``df``)."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, node long, n long, bitmap binary, token long, df long"

    def describe(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()

        def shared() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            many = counts >= HOT_IN_CHUNK
            held.clear()
            seen.clear()
            size = int(many.sum())
            none = [pa.nulls(size, f.type) for f in (pa.field("k", key_type), pa.field("n", pa.int64()), pa.field("n", pa.int64()), pa.field("b", pa.binary()))]
            return pa.RecordBatch.from_arrays([*none, pa.array(tokens[many].view(np.int64)), pa.array(counts[many].astype(np.int64))], names)

        names = ["key", "node", "n", "bitmap", "token", "df"]
        key_type = pa.int64()
        for frame in parts_of(frames, 1, SLICE):
            key_type = frame.column(0).type
            tokens, starts = sets(frame.column(1), shingle)
            node = nodes_of(tokens, starts)
            maps = bitmaps(tokens, starts)
            size = frame.num_rows
            yield pa.RecordBatch.from_arrays(
                [frame.column(0), pa.array(node), pa.array(np.diff(starts).astype(np.int64)), pa.array(maps, pa.binary()),
                 pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64())], names,
            )
            for i in range(size):
                if starts[i] < starts[i + 1] and int(node[i]) not in seen:
                    seen.add(int(node[i]))
                    held.append(tokens[starts[i] : starts[i + 1]])
            if sum(map(len, held)) >= CHUNK_WORDS:
                yield shared()
        if held:
            yield shared()

    return saved(docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(describe, schema), "described")


def _most_frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens in order and their counts: those above the count that ``HOT_TOKENS`` of them reach at most."""
    shared = counts.groupBy("token").agg(F.sum("df").alias("df")).filter(F.col("df") >= HOT)
    shared = saved(shared.withColumn("grade", F.floor(8 * F.log2(F.col("df").cast("double"))).cast("int")), "shared")
    least, total = 0, 0
    for grade, n in sorted(shared.groupBy("grade").count().collect(), reverse=True):  # 8 * 63 rows at most
        if total + n > HOT_TOKENS:
            least = grade + 1
            break
        total += n
    found = shared.filter(F.col("grade") >= least).select("token", "df").toArrow()  # HOT_TOKENS rows at most, 16 bytes each
    tokens, df = found.column("token").to_numpy().view(_U), found.column("df").to_numpy()
    order = np.argsort(tokens)
    return tokens[order], df[order]


def _sharing(docs: DataFrame, text: str, hot: tuple[np.ndarray, np.ndarray], n_rows: int, shingle: int, percent: int) -> DataFrame:
    """``group, node``: groups of two nodes or more that share a first token. Tokens of the same nodes are one group."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    buckets = -(-n_rows // BUCKET_ROWS) or 1

    def first_tokens(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_tokens, hot_counts = shared.value
        for frame in parts_of(frames, 0, SLICE):
            tokens, starts = sets(frame.column(0), shingle)
            node = nodes_of(tokens, starts)
            count = np.zeros(len(tokens), np.int64)
            if len(hot_tokens) and len(tokens):
                at = np.minimum(np.searchsorted(hot_tokens, tokens), len(hot_tokens) - 1)
                count = np.where(hot_tokens[at] == tokens, hot_counts[at], 0)
            row = rows_of(starts)
            order = np.lexsort((tokens, count, row))
            length = prefix_length(np.diff(starts), percent)
            _, once = np.unique(node, return_index=True)
            wanted = np.zeros(len(node), np.int64)
            wanted[once] = length[once]
            inside = (np.arange(len(tokens)) - starts[row]) < wanted[row]
            chosen = order[inside]
            token, of = tokens[chosen], row[chosen]
            size = np.diff(starts)
            early = (np.arange(len(tokens)) - starts[row])[inside] < indexed_length(size, percent)[of]
            sized = 2 * size[of].astype(np.int64) + early
            bucket = (((token >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int32)
            bucket[count[chosen] >= WIDESPREAD] = -1
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket), pa.array(token.view(np.int64)), pa.array(node[of]), pa.array(sized)], ["bucket", "token", "node", "sized"]
            )

    def grouped(frame: pa.Table) -> pa.Table:
        token, owner, sized = (frame.column(c).to_numpy() for c in ("token", "node", "sized"))
        token = token.view(_U)
        order = np.lexsort((owner, sized >> 1, token))
        token, owner, sized = token[order], owner[order], sized[order]
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        token, owner, sized = token[fresh], owner[fresh], sized[fresh]
        near = _paired(token, sized >> 1, (sized & 1).astype(bool), percent)
        token, owner = token[near], owner[near]
        order = np.lexsort((owner, token))
        token, owner = token[order], owner[order]
        if not len(token):
            return pa.table({"group": pa.array([], pa.int64()), "node": pa.array([], pa.int64())})
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        size = np.diff(np.append(first, len(token)))
        name = mix(np.add.reduceat(mix(owner.view(_U)), first) + size.astype(_U))
        _, once = np.unique(name, return_index=True)
        good = np.zeros(len(first), bool)
        good[once] = True
        good &= size > 1
        member = np.repeat(good, size)
        return pa.table({"group": np.repeat(name, size)[member].view(np.int64), "node": owner[member]})

    sent = docs.select(text).mapInArrow(first_tokens, "bucket int, token long, node long, sized long")
    if not len(hot[1]) or hot[1].max() < WIDESPREAD:
        return saved(sent.groupBy("bucket").applyInArrow(grouped, "group long, node long").distinct(), "groups")
    sent = saved(sent, "first-tokens")
    few = sent.filter("bucket >= 0").groupBy("bucket").applyInArrow(grouped, "group long, node long")
    return saved(few.union(_widespread(sent.filter("bucket < 0").select("token", "node"))).distinct(), "groups")


def _widespread(rows: DataFrame) -> DataFrame:
    """``group, node`` of tokens that very many texts share, of tokens of the same nodes one group.

    Added up in each task first, so that no task sees all texts of a token.
    """
    rows = rows.distinct()
    named = rows.groupBy("token").agg(F.bit_xor(F.xxhash64("node")).alias("nodes"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    once = named.groupBy("nodes", "n").agg(F.min("token").alias("__token"))
    return rows.join(once, F.col("token") == F.col("__token")).select(F.xxhash64("nodes", "n").alias("group"), "node")


class Tree:
    """A signature tree over nodes in order of size: per level the OR of bitmaps, ranges of sizes and of bits, a common component."""

    def __init__(self, size: np.ndarray, bits: np.ndarray, component: np.ndarray, percent: int = PERCENT) -> None:
        self.size, self.bits, self.component, self.percent = size, bits, component, percent
        self.count = np.bitwise_count(bits).sum(1).astype(np.int64)
        edges = np.arange(0, len(size), LEAF)
        level = [np.bitwise_or.reduceat(bits, edges), np.minimum.reduceat(size, edges), np.maximum.reduceat(size, edges), np.minimum.reduceat(self.count, edges)]
        one = np.where(np.minimum.reduceat(component, edges) == np.maximum.reduceat(component, edges), component[edges], 0)
        self.levels = [(*level, one)]
        while len(self.levels[-1][0]) > 1:
            union, low, high, few, one = self.levels[-1]
            edges = np.arange(0, len(low), 2)
            same = np.minimum.reduceat(one, edges) == np.maximum.reduceat(one, edges)
            self.levels.append((
                np.bitwise_or.reduceat(union, edges), np.minimum.reduceat(low, edges), np.maximum.reduceat(high, edges),
                np.minimum.reduceat(few, edges), np.where(same, one[edges], 0),
            ))

    def pairs(self, other: Tree) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Members of both trees that may be similar and lie in different components, with their greatest possible overlap."""
        todo, percent = [(len(self.levels) - 1, 0, len(other.levels) - 1, 0)], self.percent
        while todo:
            la, a, lb, b = todo.pop()
            if self is other and la == lb and a > b:
                continue
            union_a, low_a, high_a, few_a, one_a = (x[a] for x in self.levels[la])
            union_b, low_b, high_b, few_b, one_b = (x[b] for x in other.levels[lb])
            if (one_a and one_a == one_b) or 100 * high_a < percent * low_b or 100 * high_b < percent * low_a:
                continue
            both = int(np.bitwise_count(union_a & union_b).sum())
            overlap = min(high_a - max(0, few_a - both), high_b - max(0, few_b - both))
            if (100 + percent) * overlap < percent * (low_a + low_b):
                continue
            if la == lb == 0:
                yield from self.leaves(other, a, b)
            elif la >= lb:
                todo += [(la - 1, i, lb, b) for i in range(2 * a, min(2 * a + 2, len(self.levels[la - 1][0])))]
            else:
                todo += [(la, a, lb - 1, i) for i in range(2 * b, min(2 * b + 2, len(other.levels[lb - 1][0])))]

    def leaves(self, other: Tree, a: int, b: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        i, j = (np.arange(x * LEAF, min((x + 1) * LEAF, len(t.size))) for t, x in ((self, a), (other, b)))
        both = np.bitwise_count(self.bits[i][:, None] & other.bits[j][None]).sum(2).astype(np.int64)
        size_a, size_b = self.size[i][:, None], other.size[j][None]
        overlap = np.minimum(size_a - (self.count[i][:, None] - both), size_b - (other.count[j][None] - both))
        good = ((100 + self.percent) * overlap >= self.percent * (size_a + size_b)) & (self.component[i][:, None] != other.component[j][None])
        if self is other and a == b:
            good &= i[:, None] < j[None]
        x, y = np.nonzero(good)
        if len(x):
            yield i[x], j[y], overlap[x, y]


class Side:
    """The members of a group's part, a tree for each width of bitmaps and, folded, for the width below."""

    def __init__(self, at: np.ndarray, size: np.ndarray, component: np.ndarray, maps: pa.Array, percent: int = PERCENT) -> None:
        self.size, self.component, self.percent = size, component, percent
        held = maps.take(pa.array(at)).to_pylist()
        width = np.array([len(m) for m in held])
        self.members = {w: at[width == w] for w in np.unique(width).tolist()}
        self.bits = {w: np.frombuffer(b"".join(m for m in held if len(m) == w), _U).reshape(-1, w // 8) for w in self.members}
        self.trees: dict[tuple[int, int], Tree] = {}

    def tree(self, width: int, as_width: int) -> Tree:
        if (width, as_width) not in self.trees:
            bits = self.bits[width] if width == as_width else folded(self.bits[width])
            at = self.members[width]
            self.trees[width, as_width] = Tree(self.size[at], bits, self.component[at], self.percent)
        return self.trees[width, as_width]

    def pairs(self, other: Side) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Sizes of similar sets lie within a factor of two, so widths that differ by more than one step never pair."""
        for a in self.members:
            for b in other.members:
                least = min(a, b)
                if max(a, b) > 2 * least or (self is other and a > b):
                    continue
                for x, y, overlap in self.tree(a, least).pairs(other.tree(b, least)):
                    yield self.members[a][x], other.members[b][y], overlap


def _candidates(members: DataFrame, best_only: bool, percent: int) -> DataFrame:
    """``a, b``: pairs of nodes that may be similar, of each group of ``members`` (group, node, n, bitmap, component).

    With ``best_only``, each member's most promising pair, and every member of any pair as a pair with itself.
    """
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("__size"))
    parts = F.ceil(F.col("__size") / GROUP).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("__parts")).cast("int")
    dealt = (
        members.join(sizes, "group").withColumn("__parts", parts).withColumn("__own", own)
        .withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
        .groupBy("group", F.least("__own", "__other").alias("i"), F.greatest("__own", "__other").alias("j"))
        .agg(F.collect_list(F.struct("node", "n", "bitmap", "component", F.col("__own").alias("part"))).alias("members"))
    )

    def search(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            lists = frame.column("members")
            ends = lists.offsets.to_numpy()
            flat = lists.values
            node, n, component, part = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("node", "n", "component", "part"))
            maps = flat.field("bitmap")
            left, right = [], []
            for k in range(len(lists)):
                at = np.arange(ends[k], ends[k + 1])
                at = at[np.lexsort((node[at], n[at]))]
                i, j = frame.column("i")[k].as_py(), frame.column("j")[k].as_py()
                sides = [Side(at[part[at] == p], n, component, maps, percent) for p in dict.fromkeys((i, j))]
                found = [(node[x], node[y], overlap) for x, y, overlap in sides[0].pairs(sides[-1])]
                if not found:
                    continue
                a, b, overlap = (np.concatenate(x) for x in zip(*found))
                if best_only:
                    any_pair = np.unique(np.concatenate([a, b]))
                    order = np.lexsort((a, -overlap, b))
                    a, b = a[order], b[order]
                    first = np.concatenate([[True], b[1:] != b[:-1]])
                    a, b = np.concatenate([a[first], any_pair]), np.concatenate([b[first], any_pair])
                left.append(np.minimum(a, b))
                right.append(np.maximum(a, b))
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])

    return dealt.mapInArrow(search, "a long, b long").distinct()


def _among(rows: DataFrame, column: str) -> Callable[[pa.Array], pa.Array]:
    """Whether keys' hashes may be among those of ``column``; never no for one that is. To be called in tasks.

    A Bloom filter of 16 bits a row, ``FILTER_BITS`` at most: beyond that it lets more rows pass, no fewer.
    """
    bits = 1 << min(FILTER_BITS.bit_length() - 1, max(10, (16 * rows.count()).bit_length()))
    place = F.explode(F.array(F.col("h").bitwiseAND(F.lit(bits - 1)), F.shiftright("h", 32).bitwiseAND(F.lit(bits - 1)))).alias("place")
    words = rows.select(F.xxhash64(column).alias("h")).select(place).groupBy(F.shiftright("place", 6).alias("word"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    found = words.agg(F.bit_or(one).alias("set")).toArrow()  # bits / 64 rows at most
    table = np.zeros(bits // 64, np.int64)
    table[found.column("word").to_numpy()] = found.column("set").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(table.view(_U))

    def among(hashes: pa.Array) -> pa.Array:
        h = hashes.to_numpy(zero_copy_only=False)
        out = np.ones(len(h), bool)
        for x in (h & (bits - 1), (h >> 32) & (bits - 1)):
            out &= (shared.value[x >> 6] >> (x & 63).astype(_U)) & _U(1) == 1
        return pa.array(out)

    return among


def _similar(percent: int) -> Callable[[Column, Column], Column]:
    @F.arrow_udf(T.BooleanType())
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left, right):
            a, b = (np.frombuffer(z.as_buffer(), _U) for z in (x, y))
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= percent * (len(a) + len(b) - both))
        return pa.array(out, pa.bool_())

    return similar


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``key, node, n, component, component_id`` of every row: its set's hash and size, the least node and least key it reaches.

    ``percent`` is 50 at least: bitmaps of sets that differ more in size are not compared.
    """
    if shingle < 1 or not 50 <= percent <= 100:
        raise ValueError(f"runs of {shingle} words, {percent} percent")
    rows = described(docs, key, text, shingle)
    hot = _most_frequent(rows.filter("token IS NOT NULL"))
    rows = rows.filter("token IS NULL").drop("token", "df")
    nodes = saved(
        rows.filter("n > 0").groupBy("node").agg(F.first("n").alias("n"), F.first("bitmap").alias("bitmap"), F.min("key").alias("least")), "nodes"
    )
    length = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1
    n_rows = nodes.agg(F.sum(length)).first()[0] or 0
    groups = _sharing(docs, text, hot, int(n_rows), shingle, percent)
    members = saved(groups.join(nodes.select("node", "n", "bitmap"), "node"), "members")
    pairs = saved(_candidates(members.withColumn("component", F.col("node")), True, percent), "pairs")
    # sets are needed of those only that the bitmaps leave a partner
    wanted = pairs.filter("a = b").join(nodes, F.col("a") == F.col("node")).select("node", "least")
    wanted = saved(wanted, "wanted")
    among = _among(wanted, "least")

    def whole(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Filter and sets in one pass: two Python operators in a task would hold two workers."""
        for frame in parts_of((f.filter(among(f.column(0))) for f in frames), 1, SLICE):
            tokens, starts = sets(frame.column(1), shingle)
            node = nodes_of(tokens, starts)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array([tokens[a:b].tobytes() for a, b in zip(starts, starts[1:])], pa.binary())], ["node", "tokens"])

    held = docs.select(F.xxhash64(key).alias("hash"), F.col(text).alias("text")).mapInArrow(whole, "node long, tokens binary")
    held = saved(held.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        a, b = (held.select(F.col("node").alias(c), F.col("tokens").alias(f"t{c}")) for c in "ab")
        return pairs.join(a, "a").join(b, "b").filter(_similar(percent)(F.col("ta"), F.col("tb"))).select("a", "b")

    links = saved(verified(pairs.filter("a < b")), "links")
    linked = saved(components(links), "components").withColumnRenamed("node", "__node").withColumnRenamed("component", "__component")
    known = members.join(linked, F.col("node") == F.col("__node"), "left").withColumn("component", F.coalesce("__component", "node"))
    # groups that are one component by now hold nothing new
    apart = known.groupBy("group").agg(F.min("component").alias("__low"), F.max("component").alias("__high")).filter("__low <> __high")
    known = known.join(apart.select("group"), "group", "left_semi").select("group", "node", "n", "bitmap", "component")
    more = saved(verified(_candidates(known, False, percent)), "links")
    linked = saved(components(links.union(more)), "components")
    named = nodes.select("node", "least").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = named.join(least, "component").select(F.col("node").alias("__node"), "component", "component_id")
    found = rows.select("key", "node", "n").join(by_node, F.col("node") == F.col("__node"), "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return found.select(F.col("key").alias(key), "node", "n", "component", own.alias("component_id"))


SQL = """
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM split),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT doc_id, len(s) AS n_shingles, (SELECT min(y) FROM reach WHERE x = doc_id) AS component_id FROM sets
"""


def op6(docs: DataFrame) -> DataFrame:
    """Size of set and component of all documents."""
    return classes(docs.select("doc_id", "text"), shingle=SHINGLE, percent=PERCENT).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _node(shingle: int) -> Callable[[Column], Column]:
    """The hash of a text's set. Not taken for deterministic, so that a filter on it does not work it out, in a worker more, again."""

    @F.arrow_udf(T.LongType())
    def node(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), np.int64)
        for a, b in pieces_of(as_bytes(texts)[1], SLICE):
            out[a:b] = nodes_of(*sets(texts.slice(a, b - a), shingle))
        return pa.array(out)

    return node.asNondeterministic()


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = NEAR_SHINGLE, percent: int = NEAR_PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the one whose key is its id. Rows without words all stay."""
    found = saved(classes(docs.select(key, text), key, text, shingle, percent).filter("n > 0"), "classes")
    # of texts with one key in one component, the one of the least node
    first = found.filter(F.col(key).eqNullSafe(F.col("component_id"))).groupBy("component").agg(F.min(F.struct("node", key)).alias("__first"))
    kept = first.select(F.col(f"__first.{key}").alias("__key"), F.col("__first.node").alias("__kept"))
    marked = docs.withColumn("__node", _node(shingle)(F.col(text)))
    own: Column = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__node") == F.col("__kept"))
    chosen = marked.filter("__node <> 0").join(kept, own, "left_semi").dropDuplicates([key, "__node"])
    return chosen.union(marked.filter("__node = 0")).drop("__node")
