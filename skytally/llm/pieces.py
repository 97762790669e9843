"""SentencePiece encoding with seeded merge-dropout, and decoding.

The vocabulary is a SentencePiece BPE model with byte fallback. A text is cut where no piece can span,
before runs of spaces and around line breaks, and each part is encoded by the usual agenda: of all neighbouring symbols
whose concatenation is a piece, the best is merged first, of equals the leftmost. With dropout, a candidate merge is skipped when a
hash of the seed, the row's key, the part's number, the candidate's place and its piece falls under the rate: each
occurrence of a word has draws of its own, and the same ones on a rerun.

Whatever is skipped, the pieces spell the text: decoding gives it back exactly. A text's own U+2581,
which the model writes for a space, is spelled in bytes.

How a part is cut depends only on which of the merges it considers are skipped. A table of ``CACHE`` entries, emptied when
full, holds parts cut lately: without skips, and from there by what was skipped. An entry lists the merges considered on its
way that were not skipped; an occurrence whose own draws skip none of them is cut alike. The other occurrences of
a batch are encoded together, a round of merges at a time, in numpy arrays.

A null text has null ids; an empty one none, and decodes as empty. Rows with a null key count as key
''. Repeated rows get equal ids. All columns are kept; a name for
a new one that is taken raises ValueError. A very long text is encoded by itself: its task holds its parts.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytally.llm.store import free
from skytally.llm.tokens import as_bytes, hash_spans, mix, parts_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 1
CACHE = 1 << 18
#: Parts looked up at a time, and merges of an entry: what is skipped of them is one number.
LOOK_UP, MOST = 1 << 17, 52
#: Marks of what was looked up in vain, and how often it must have been before it is entered.
SEEN, OFTEN = 1 << 22, 8
#: Bytes of text encoded at a time.
SLICE = 1 << 20
#: Parts of more symbols than this are encoded one by one.
WIDE = 48
_SPACE = "▁"
_PARTS = re.compile(r" *[^ \n]+|\n| +")
_NONE = np.iinfo(np.int32).max
_U = np.uint64


def vocabulary(model: str = MODEL) -> list[tuple[str, float, bool]]:
    """Piece, score and whether it stands for a byte, by id; control pieces are empty."""
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    apart = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(sp.get_piece_size())]
    return [("" if x else sp.id_to_piece(i), sp.get_score(i), sp.is_byte(i)) for i, x in enumerate(apart)]


def _inside(ends: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the merges of the entries given are, to which of them each belongs, and its place there."""
    many = ends[entry + 1] - ends[entry]
    place = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    return place + np.repeat(ends[entry], many), np.repeat(np.arange(len(entry)), many), place


class Lists:
    """Lists of merges one behind the other, in arrays that grow by doubling."""

    def __init__(self) -> None:
        self.merges, self.ends, self.size = np.zeros(1 << 10, _U), np.zeros(1 << 8, np.int64), 0

    def add(self, merges: np.ndarray, counts: np.ndarray) -> None:
        """Lists of ``counts`` merges each."""
        if not len(counts):
            return
        base, to = int(self.ends[self.size]), self.size + len(counts)
        self.merges, self.ends = self._room(self.merges, base + len(merges)), self._room(self.ends, to + 1)
        self.merges[base : base + len(merges)] = merges
        self.ends[self.size + 1 : to + 1] = base + np.cumsum(counts)
        self.size = to

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        wider = np.zeros(max(size, 2 * len(array)), array.dtype)
        wider[: len(array)] = array
        return wider


class Pieces:
    """An encoder and decoder. Holds the vocabulary's tables and the parts encoded lately."""

    def __init__(self, pieces: list[tuple[str, float, bool]], dropout: float = 0.0, seed: int = SEED) -> None:
        self.ids = {p: i for i, (p, _, byte) in enumerate(pieces) if p and not byte}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, byte) in enumerate(pieces) if byte}
        self.spelled = pa.array(
            [bytes([int(p[3:5], 16)]) if byte else p.replace(_SPACE, " ").encode() for p, _, byte in pieces], pa.large_binary()
        )
        order = sorted(range(len(pieces)), key=lambda i: -pieces[i][1])
        self.rank = np.zeros(len(pieces), np.int32)
        place, before = -1, None
        for i in order:  # equal scores, equal ranks
            place, before = (place, before) if pieces[i][1] == before else (place + 1, pieces[i][1])
            self.rank[i] = place
        pairs = {}
        for p, i in self.ids.items():
            for at in range(1, len(p)):
                if p[:at] in self.ids and p[at:] in self.ids:
                    pairs[self.ids[p[:at]] * len(pieces) + self.ids[p[at:]]] = i
        self._spread(np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64))
        self.size = len(pieces)
        self.of_char = np.full(0x110000, -1, np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        self.of_char[0x20], self.of_char[ord(_SPACE)] = self.ids.get(_SPACE, -1), -1
        self.rate = int(dropout * (1 << 24))
        self.seed = seed
        self._forget()

    def _spread(self, pair: np.ndarray, merged: np.ndarray) -> None:
        """A hash table of pairs; a pair whose slot is taken is in the next free one."""
        bits = max(4, (4 * len(pair)).bit_length())
        self.shift = _U(64 - bits)
        self.pair, self.merged = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        slot = self._slot(pair)
        while len(pair):
            _, first = np.unique(slot, return_index=True)
            first = first[self.pair[slot[first]] < 0]
            self.pair[slot[first]], self.merged[slot[first]] = pair[first], merged[first]
            left = np.ones(len(pair), bool)
            left[first] = False
            pair, merged, slot = pair[left], merged[left], (slot[left] + 1) & (len(self.pair) - 1)

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        return ((pair.astype(_U) * _U(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _of_pair(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece of each pair, and whether it has one."""
        slot = self._slot(pair)
        held = self.pair[slot]
        while True:
            taken = np.nonzero((held != pair) & (held >= 0))
            if not len(taken[0]):
                return self.merged[slot], held == pair
            slot[taken] = (slot[taken] + 1) & (len(self.pair) - 1)
            held[taken] = self.pair[slot[taken]]

    def _forget(self) -> None:
        """Empties the table: entries by part or by an entry and what is skipped of its merges; ids, kept and skipped merges of each."""
        self.entries: dict[str | tuple[int, int], int] = {}
        self.results: list[bytes] = []
        self.kept, self.skipped = Lists(), Lists()
        self.seen = np.zeros(SEEN, np.uint8)

    def symbols(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the characters of all parts, or of their bytes, and where each part's begin."""
        codes = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)
        ids, counts = self.of_char[codes].astype(np.int64), np.array([len(p) for p in parts], np.int64)
        strange = np.flatnonzero(ids < 0)
        if len(strange):
            spelled = [[self.bytes[b] for b in chr(c).encode()] for c in codes[strange].tolist()]
            sizes = np.array([len(x) for x in spelled])
            owner = np.searchsorted(np.cumsum(counts), strange, "right")
            many = np.ones(len(ids), np.int64)
            many[strange] = sizes
            ids = np.repeat(ids, many)
            ids[ids < 0] = np.concatenate([np.array(x, np.int64) for x in spelled])
            counts += np.bincount(owner, sizes - 1, len(counts)).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(counts)])

    def _skipped(self, key: np.ndarray, merge: np.ndarray) -> np.ndarray:
        return (mix(key ^ merge) >> _U(40)) < _U(self.rate)

    def _candidates(self, left: np.ndarray, right: np.ndarray, start: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rank and piece of each pair of neighbours, no rank for pairs that make no piece or are skipped.

        Then where there is a draw, and the merges drawn and whether they are skipped.
        """
        piece, good = self._of_pair(np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.size + right, self.size * self.size))
        drawn = np.nonzero(good) if self.rate else tuple(np.zeros(0, np.int64) for _ in good.shape)
        merge = start[drawn].astype(_U) * _U(0x9E3779B97F4A7C15) + piece[drawn].astype(_U) * _U(0xC2B2AE3D27D4EB4F)
        skipped = self._skipped(key[drawn[0]], merge)
        good[tuple(x[skipped] for x in drawn)] = False
        return np.where(good, self.rank[piece], np.int32(_NONE)), piece, drawn, merge, skipped

    def keys(self, parts: list[str], occurrences: np.ndarray | list[int]) -> np.ndarray:
        """What each part's draws go by; ``occurrences`` are numbers of 64 bits."""
        return mix(np.asarray(occurrences, _U) + (_U(self.seed) << _U(40)))

    def agenda(self, part: str, key: int) -> list[int]:
        """One part, by a heap of candidates."""
        symbols = self.symbols([part])[0].tolist()
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int, int]] = []
        boxed = np.array([key], _U)

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else n
            if j < n:
                rank, piece, *_ = self._candidates(*(np.array([x], np.int64) for x in (symbols[i], symbols[j], i)), boxed)
                if rank[0] != _NONE:
                    heapq.heappush(heap, (int(rank[0]), i, int(piece[0]), symbols[i], symbols[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, piece, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = piece, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [s for s in symbols if s >= 0]

    def _together(self, flat: np.ndarray, lengths: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        """Many parts of about one length: each round merges the best candidate of every part that has one.

        Gives the ids of all parts, and how many each has; then the part, merge and skip of each draw.
        """
        width = int(lengths.max())
        symbol = np.full((len(lengths), width + 1), -1, np.int32)
        symbol[:, :width][np.arange(width) < lengths[:, None]] = flat
        final = symbol.copy()
        start = np.broadcast_to(np.arange(width + 1, dtype=np.int32), symbol.shape).copy()
        name = np.arange(len(lengths))
        rank = np.full(symbol.shape, _NONE, np.int32)
        piece = np.zeros_like(symbol)
        rank[:, :-1], piece[:, :-1], drawn, merge, skipped = self._candidates(symbol[:, :-1], symbol[:, 1:], start[:, :-1], keys)
        draws = [(drawn[0], merge, skipped)]
        while True:
            best = rank.argmin(1)
            going = rank[np.arange(len(name)), best] != _NONE
            if not going.all():
                done = name[~going]
                final[done] = -1
                final[done, : symbol.shape[1]] = symbol[~going]
                symbol, start, rank, piece, name, keys, best = (x[going] for x in (symbol, start, rank, piece, name, keys, best))
            if not len(name):
                break
            row = np.arange(len(name))
            symbol[row, best] = piece[row, best]
            kept = np.arange(symbol.shape[1]) != (best + 1)[:, None]
            symbol, start, rank, piece = (x[kept].reshape(len(name), -1) for x in (symbol, start, rank, piece))
            for at in (best, best - 1):
                near = np.flatnonzero((at >= 0) & (at + 1 < symbol.shape[1]))
                i, j = row[near], at[near]
                rank[i, j], piece[i, j], drawn, merge, skipped = self._candidates(symbol[i, j], symbol[i, j + 1], start[i, j], keys[i])
                draws.append((name[i[drawn]], merge, skipped))
            # a pair that now ends in the last column has no right neighbour
            rank[:, -1] = _NONE
        full = final >= 0
        return final[full], full.sum(1), *(np.concatenate(x) for x in zip(*draws))

    def encode_parts(self, parts: list[str], occurrences: np.ndarray | list[int]) -> list[bytes]:
        """Ids of each part as 32-bit integers."""
        return self._encoded(parts, self.keys(parts, occurrences))[0]

    def _encoded(self, parts: list[str], keys: np.ndarray) -> tuple[list[bytes], np.ndarray, tuple[np.ndarray, ...]]:
        """Ids of each part, whether its draws are listed, and part, merge and skip of each draw listed."""
        flat, edges = self.symbols(parts)
        lengths = np.diff(edges)
        out = [b""] * len(parts)
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] <= WIDE]
        draws = [(np.zeros(0, np.int64), np.zeros(0, _U), np.zeros(0, bool))]
        for at in range(0, len(order), 8192):
            some = order[at : at + 8192]
            many = lengths[some]
            inside = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(edges[some], many)
            ids, counts, owner, merge, skipped = self._together(flat[inside], many, keys[some])
            draws.append((some[owner], merge, skipped))
            data, ends = ids.astype(np.int32).tobytes(), (4 * np.cumsum(counts)).tolist()
            for i, a, b in zip(some.tolist(), [0, *ends], ends):
                out[i] = data[a:b]
        for i in np.flatnonzero(lengths > WIDE).tolist():
            out[i] = np.array(self.agenda(parts[i], int(keys[i])), np.int32).tobytes()
        return out, lengths <= WIDE, tuple(np.concatenate(x) for x in zip(*draws))

    def _found(self, parts: list[str], keys: np.ndarray) -> list[bytes]:
        """Ids of each part, by the table as far as it goes."""
        if len(self.results) > CACHE:
            self._forget()
        get, merges, ends = self.entries.get, self.kept.merges, self.kept.ends
        entry = np.array([get(p, -1) for p in parts], np.int64)
        above, mask = np.full(len(parts), -1), np.zeros(len(parts), np.int64)
        todo = np.flatnonzero(entry >= 0)
        while len(todo):
            at, owner, place = _inside(ends, entry[todo])
            skipped = np.flatnonzero(self._skipped(keys[todo][owner], merges[at]))
            bits = np.bincount(owner[skipped], 2.0 ** place[skipped], len(todo)).astype(np.int64)
            todo, bits = todo[bits > 0], bits[bits > 0]
            above[todo], mask[todo] = entry[todo], bits
            entry[todo] = [get(x, -1) for x in zip(entry[todo].tolist(), bits.tolist())]
            todo = todo[entry[todo] >= 0]
        results = self.results
        out = [results[e] if e >= 0 else b"" for e in entry.tolist()]
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            new = [parts[i] for i in missing.tolist()]
            ids, listed, draws = self._encoded(new, keys[missing])
            for i, x in zip(missing.tolist(), ids):
                out[i] = x
            self._keep(new, above[missing], mask[missing], ids, listed, draws)
        return out

    def _keep(self, parts: list[str], above: np.ndarray, mask: np.ndarray, ids: list[bytes], listed: np.ndarray, draws: tuple[np.ndarray, ...]) -> None:
        """Enters the parts that skipped nothing but what led to their place in the table."""
        slot = mix((above << 32 ^ mask).astype(_U)).view(np.int64)
        top = np.flatnonzero(above < 0)
        slot[top] = [hash(parts[i]) for i in top.tolist()]
        slot &= SEEN - 1
        times = self.seen[slot]
        listed = listed & (times >= OFTEN)
        self.seen[slot] = np.minimum(times, OFTEN) + 1
        owner, merge, skipped = (x[listed[draws[0]]] for x in draws)
        below = np.flatnonzero((above >= 0) & listed)
        known = []
        for lists, chosen in ((self.skipped, False), (self.kept, True)):
            at, of, place = _inside(lists.ends, above[below])
            if chosen:
                led = (mask[below][of] >> place) & 1 == 1
                at, of = at[led], of[led]
            known.append(mix(below[of].astype(_U)) ^ lists.merges[at])
        good = listed & (np.bincount(owner[~skipped], minlength=len(parts)) <= MOST)
        good[owner[skipped][~np.isin(mix(owner[skipped].astype(_U)) ^ merge[skipped], np.concatenate(known))]] = False
        chosen, number = [], np.full(len(parts), -1)
        for i, a, m in zip(np.flatnonzero(good).tolist(), above[good].tolist(), mask[good].tolist()):
            if self.entries.setdefault(parts[i] if a < 0 else (a, m), len(self.results)) == len(self.results):
                self.results.append(ids[i])
                number[i] = len(chosen)
                chosen.append(i)
        entered = number[owner] >= 0
        owner, merge, skipped = number[owner[entered]], merge[entered], skipped[entered]
        for lists, those in ((self.kept, ~skipped), (self.skipped, skipped)):
            of, at = owner[those], merge[those]
            lists.add(at[np.argsort(of, kind="stable")], np.bincount(of, minlength=len(chosen)))

    def encode(self, texts: list[str | None], names: np.ndarray) -> list[np.ndarray | None]:
        """Ids of each text; ``names`` are hashes of the rows' keys."""
        cut = [_PARTS.findall(" " + t) if t else [] for t in texts]
        counts = [len(c) for c in cut]
        every = [p for parts in cut for p in parts]
        place = np.arange(len(every)) - np.repeat(np.cumsum(counts) - counts, counts).astype(np.int64)
        keys = self.keys(every, mix(np.repeat(names, counts) + place.astype(_U)))
        found: list[bytes] = []
        for at in range(0, len(every), LOOK_UP):
            found += self._found(every[at : at + LOOK_UP], keys[at : at + LOOK_UP])
        at, out = 0, []
        for t, n in zip(texts, counts):
            out.append(None if t is None else np.frombuffer(b"".join(found[at : at + n]), np.int32))
            at += n
        return out

    def decode(self, ids: np.ndarray | None) -> str | None:
        return None if ids is None else self.texts(np.asarray(ids, np.int32), np.array([0, len(ids)]))[0].decode()

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The text of each of many rows of ids; ``ends`` says where each begins, one more than rows."""
        spelled = self.spelled.take(pa.array(ids, pa.int32()))
        _, offsets, data = spelled.buffers()
        places = np.frombuffer(offsets, np.int64)[ends].tolist() if len(ids) else [0] * len(ends)
        whole = memoryview(data) if data else memoryview(b"")
        # every text was encoded behind a space
        return [bytes(whole[a + 1 : b]) for a, b in zip(places, places[1:])]


def _shared(spark: SparkSession, model: str, dropout: float, seed: int) -> Callable[[], Pieces]:
    """The encoder of a task's process, made once. The vocabulary is broadcast: some ten thousand pieces."""
    sent = spark.sparkContext.broadcast(vocabulary(model))
    name = uuid.uuid4().hex

    def get() -> Pieces:
        if _MADE.get("name") != name:
            _MADE.update(name=name, pieces=Pieces(sent.value, dropout, seed))
        return _MADE["pieces"]

    return get


_MADE: dict = {}


def encoded(docs: DataFrame, key: str = "doc_id", text: str = "text", out: str = "ids", model: str = MODEL,
            dropout: float = DROPOUT, seed: int = SEED, lossless: str | None = None) -> DataFrame:
    """``docs`` with the ids of ``text`` in ``out``, varied by ``key``; in ``lossless``, if named, whether they decode to it.

    A pass of its own over the rows: as an expression, each use of the ids could encode again.
    """
    free(docs, out, *([lossless] if lossless else []))
    get = _shared(docs.sparkSession, model, dropout, seed)
    fields = [T.StructField(out, T.ArrayType(T.IntegerType()))]
    schema = T.StructType([*docs.schema, *fields, *([T.StructField(lossless, T.BooleanType())] if lossless else [])])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, text, SLICE):
            data, offsets = as_bytes(batch.column(key).cast(pa.string()))
            full = np.flatnonzero(np.diff(offsets))
            names = np.zeros(batch.num_rows, _U)
            if len(full):
                names[full] = hash_spans(data, offsets[:-1][full], offsets[1:][full])
            pieces = get()
            ids = pieces.encode(batch.column(text).to_pylist(), names)
            ends = np.concatenate([[0], np.cumsum([0 if x is None else len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate([x for x in ids if x is not None] or [np.zeros(0, np.int32)])
            missing = pa.array([x is None for x in ids], pa.bool_())
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()), mask=missing if missing.true_count else None)
            same = []
            if lossless:
                texts = batch.column(text).cast(pa.binary()).to_pylist()
                same = [pa.array([x == (t or b"") for x, t in zip(pieces.texts(flat, ends), texts)], pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, *same], schema.names)

    return docs.mapInArrow(encode, schema)


def decoder(spark: SparkSession, model: str = MODEL) -> Callable[[Column], Column]:
    """The text of a column of ids."""
    get = _shared(spark, model, 0.0, 0)

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        starts, valid = ids.offsets.to_numpy(), ids.is_valid().to_pylist()
        texts = get().texts(ids.values.to_numpy()[: starts[-1]], starts)
        return pa.array([t.decode() if ok else None for t, ok in zip(texts, valid)], pa.string())

    return decode


def decoded(docs: DataFrame, ids: str = "ids", out: str = "decoded", **options) -> DataFrame:
    """``docs`` with the text of ``ids`` in ``out``."""
    free(docs, out)
    return docs.withColumn(out, decoder(docs.sparkSession, **options)(F.col(ids)))


def op2(docs: DataFrame) -> DataFrame:
    """Ids of all documents as a count and a digest, and whether they decode to the text."""
    found = encoded(docs.select("doc_id", "text"), lossless="lossless")
    tokens = F.coalesce(F.size("ids"), F.lit(0)).cast("long")
    return found.select("doc_id", tokens.alias("n_tokens"), F.hex(F.xxhash64("ids")).alias("ids_hash"), "lossless")
