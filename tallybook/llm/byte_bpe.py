"""Byte-level BPE encoding and decoding by the ranks of a public vocabulary.

Texts are cut into pieces without a regular expression. Each code point has a class; each
class, with what little follows it, is a function on the states of a small automaton. The
functions form a finite set closed under composition, so the state at every code point is
a scan with an associative table look-up, over many blocks at once. Distinct pieces are
merged pair by pair, all in step, and kept in a bounded cache; a text's ids are gathered
from it. Every id's byte offset is kept, so that decoding can place or pick ids freely.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import hashing as H
from tallybook.llm.vocabularies import vocabulary_path

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pieces that one Python worker holds. When they are more, the cache starts anew.
CACHE_PIECES = 300_000
#: Texts are encoded together up to about this many bytes; a longer one makes a run of its own.
RUN_BYTES = 1 << 20
#: Longer pieces are merged one by one with a heap, the others all in step.
STEP_BYTES = 64

# Classes of code points, and the symbols that the automaton reads.
OTHER, LETTER, NUMBER, SPACE = range(4)
# An apostrophe that can begin 's 't 'm 'd, or 're 've 'll; white space before white space or the
# end; a blank before something; other white space before something.
SHORT, LONG, INNER, BLANK, LAST = range(4, 9)
SYMBOLS = 9

# States: inside a run of other characters, letters, numbers or white space; after a blank that the
# next piece takes in; where a piece must begin; one or two letters before a contraction ends.
_OTHER, _LETTER, _NUMBER, _SPACE, _JOIN, _FRESH, _ONE, _TWO = range(8)
#: Added to a state after a code point that begins a piece.
BEGINS = 8


def _next(state: int, symbol: int) -> int:
    """The state after a code point, with BEGINS if a piece begins at it."""
    state %= BEGINS
    if state == _TWO:
        return _ONE
    if state == _ONE:
        return _FRESH
    if symbol in (SHORT, LONG):
        if state in (_OTHER, _JOIN):  # after a blank or inside a run an apostrophe is like the rest
            return _OTHER
        return (_ONE if symbol == SHORT else _TWO) + BEGINS
    if symbol in (OTHER, LETTER, NUMBER):
        kind = (_OTHER, _LETTER, _NUMBER)[symbol]
        return kind if state in (kind, _JOIN) else kind + BEGINS
    if symbol == INNER:
        return _SPACE if state == _SPACE else _SPACE + BEGINS
    return (_JOIN if symbol == BLANK else _FRESH) + BEGINS


@cache
def _automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Functions on states, closed under composition.

    Gives the number of each symbol's function (those of a text's first code point, which
    forget the state before, follow the others), the table of compositions (first, second)
    and the value of each function at the state where a text begins.
    """
    states = range(2 * BEGINS)
    symbols = [tuple(_next(s, x) for s in states) for x in range(SYMBOLS)]
    symbols += [(_next(_FRESH, x),) * len(states) for x in range(SYMBOLS)]
    known = {f: n for n, f in enumerate(dict.fromkeys(symbols))}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in symbols:
            made = tuple(g[x] for x in f)
            if made not in known:
                known[made] = len(known)
                todo.append(made)
    functions = list(known)
    table = np.array([[known[tuple(g[x] for x in f)] for g in functions] for f in functions], np.uint16)
    return np.array([known[f] for f in symbols], np.uint16), table, np.array([f[_FRESH] for f in functions], np.uint8)


def scan(functions: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Composition of each function with all before it.

    The array is laid out in blocks; a column of all blocks is composed at a time. Blocks'
    last values are scanned the same way and composed with the next block's values.
    """
    size = len(functions)
    if size <= 64:
        out = functions.copy()
        for n in range(1, size):
            out[n] = table[out[n - 1], functions[n]]
        return out
    width = min(256, max(16, int(size**0.5)))
    blocks = -(-size // width)
    # The last block is filled up; what is composed there is cut off again.
    columns = np.empty((width, blocks), np.uint16)
    padded = np.concatenate([functions, np.repeat(functions[-1:], blocks * width - size)])
    columns[:] = padded.reshape(blocks, width).T
    for n in range(1, width):
        columns[n] = table[columns[n - 1], columns[n]]
    before = scan(columns[-1, :-1].copy(), table)
    columns[:, 1:] = table[before, columns[:, 1:]]
    return columns.T.reshape(-1)[:size]


@cache
def code_point_classes() -> np.ndarray:
    """The class of every code point, as the public library's own patterns see it."""
    import tiktoken

    points = [chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000]
    single = {bytes([x]): x for x in range(256)}
    classes = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        probe = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        for low in range(0, len(points), 1 << 16):  # a probe drops whatever its pattern does not match
            ids = probe.encode_ordinary("".join(points[low : low + (1 << 16)]))
            classes[np.frombuffer(bytes(ids).decode().encode("utf-32-le"), np.uint32)] = kind
    return classes


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the byte at which each begins."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    return points, heads


def piece_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """First byte of every piece of the texts ``data[bounds[i] : bounds[i + 1]]``."""
    if not len(data):
        return np.zeros(0, np.int64)
    points, heads = code_points(data)
    classes = code_point_classes()[points]
    first = np.zeros(len(points) + 3, bool)
    first[np.searchsorted(heads, bounds[:-1][np.diff(bounds) > 0])] = True
    first[len(points) :] = True

    def ahead(array: np.ndarray, by: int, end: int) -> np.ndarray:
        out = np.full(len(array), end, array.dtype)
        out[:-by or None] = array[by:]
        return out

    symbols = classes.copy()
    blank = classes == SPACE
    inner = first[1 : len(points) + 1] | ahead(blank, 1, True)
    symbols[blank] = np.where(inner[blank], INNER, np.where(points[blank] == 0x20, BLANK, LAST))
    quotes = np.flatnonzero(points == ord("'"))
    if len(quotes):
        one, two = (ahead(points, n, 0)[quotes] for n in (1, 2))
        near, far = ~first[quotes + 1], ~first[quotes + 1] & ~first[quotes + 2]
        short = near & np.isin(one, [ord(x) for x in "stmd"])
        pair = one.astype(np.uint64) << np.uint64(32) | two
        long = far & np.isin(pair, np.array([ord(x) << 32 | ord(y) for x, y in ("re", "ve", "ll")], np.uint64))
        symbols[quotes[short]] = SHORT
        symbols[quotes[long]] = LONG
    numbers, table, values = _automaton()
    # A text's first code point has a function that forgets the texts before it.
    states = values[scan(numbers[symbols + SYMBOLS * first[: len(points)]], table)]
    return heads[states >= BEGINS]


def long_text_cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places that cut texts into parts of RUN_BYTES or little more.

    White space after a visible ASCII character begins a piece whatever comes before, and nothing
    before it depends on what follows, so the parts' ids laid end to end are the text's.
    """
    cuts = []
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        place = low + RUN_BYTES
        while place < high:
            some = data[place - 1 : min(place + RUN_BYTES, high)]
            fits = (some[1:] == 0x20) | (some[1:] == 0x0A)
            fits &= (some[:-1] > 0x20) & (some[:-1] < 0x7F)
            if fits.any():
                place += int(np.argmax(fits))
                cuts.append(place)
            place += RUN_BYTES
    return np.array(cuts, np.int64)


class Strings:
    """What decoding needs of a vocabulary: the strings end to end, in order of their ranks."""

    def __init__(self, path: str):
        rank = self._read(path)
        self.lengths = np.zeros(max(rank.values()) + 1, np.int64)
        for text, number in rank.items():
            self.lengths[number] = len(text)
        self.text_starts = np.cumsum(self.lengths) - self.lengths
        self.texts = np.frombuffer(b"".join(sorted(rank, key=rank.__getitem__)), np.uint8)

    @staticmethod
    def _read(path: str) -> dict[bytes, int]:
        with open(path, "rb") as file:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Ranks(Strings):
    """Pair merging by ranks, with a cache of pieces whose ids lie in one growing array."""

    def __init__(self, path: str):
        super().__init__(path)
        self.rank = self._read(path)
        self.size = len(self.lengths)
        self.single = np.array([self.rank[bytes([x])] for x in range(256)], np.int64)
        # All pairs of ranked strings whose concatenation is ranked.
        pairs = [
            (left << 32 | right, whole)
            for text, whole in self.rank.items()
            for cut in range(1, len(text))
            if (left := self.rank.get(text[:cut])) is not None and (right := self.rank.get(text[cut:])) is not None
        ]
        self.pairs = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.merged = dict(pairs)
        # The ranks that a merge may lower: their strings are also part of one ranked before them.
        left, right, whole = self.pairs[:, 0] >> 32, self.pairs[:, 0] & 0xFFFFFFFF, self.pairs[:, 1]
        self.careful = np.zeros(self.size, bool)
        self.careful[left[whole < left]] = True
        self.careful[right[whole < right]] = True
        self._slots()
        self.clear()

    def _slots(self) -> None:
        """An open hash table of the pairs, at most a quarter full, looked up by whole arrays."""
        bits = int(len(self.pairs)).bit_length() + 2
        self.shift = np.uint64(64 - bits)
        self.mask = np.int64((1 << bits) - 1)
        self.slot_pair = np.full(1 << bits, -1, np.int64)
        self.slot_rank = np.full(1 << bits, self.size, np.int64)
        todo, slot = np.arange(len(self.pairs)), self._slot(self.pairs[:, 0])
        self.probes = 0
        while len(todo):
            free = self.slot_pair[slot] < 0
            self.slot_pair[slot[free]] = self.pairs[todo[free], 0]  # of several, the last one stays
            settled = self.slot_pair[slot] == self.pairs[todo, 0]
            self.slot_rank[slot[settled]] = self.pairs[todo[settled], 1]
            todo, slot = todo[~settled], (slot[~settled] + 1) & self.mask
            self.probes += 1

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(H.BASE)) >> self.shift).astype(np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's concatenation, ``size`` where it has none."""
        pairs = left << 32 | right
        slot = self._slot(pairs)
        out = np.full(len(pairs), self.size, np.int64)
        open_rows = np.arange(len(pairs))
        for _ in range(self.probes):
            found = self.slot_pair[slot]
            hit = found == pairs[open_rows]
            out[open_rows[hit]] = self.slot_rank[slot[hit]]
            more = ~hit & (found >= 0)
            if not more.any():
                break
            open_rows, slot = open_rows[more], (slot[more] + 1) & self.mask
        return out

    def clear(self) -> None:
        self.entry: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.begin = np.zeros(1 << 12, np.int64)
        self.count = np.zeros(1 << 12, np.int64)
        self.used = 0

    def _keep(self, pieces: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        known, total = len(self.entry), self.used + len(ids)
        while total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while known + len(pieces) > len(self.begin):
            self.begin, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.count))
        self.ids[self.used : total] = ids
        self.count[known : known + len(pieces)] = counts
        self.begin[known : known + len(pieces)] = self.used + np.cumsum(counts) - counts
        self.used = total
        self.entry.update(zip(pieces, range(known, known + len(pieces)), strict=True))

    def entries(self, pieces: list[bytes]) -> np.ndarray:
        """Cache numbers of distinct pieces; missing ones are merged first."""
        missing = [x for x in pieces if x not in self.entry]
        if len(self.entry) + len(missing) > CACHE_PIECES:
            self.clear()
            missing = pieces
        short = [x for x in missing if len(x) <= STEP_BYTES]
        for low in range(0, len(short), 1 << 14):
            some = short[low : low + (1 << 14)]
            self._keep(some, *self.merge_in_step(some))
        for piece in missing:
            if len(piece) > STEP_BYTES:
                ids = self.merge_with_heap(piece)
                self._keep([piece], np.array(ids, np.int32), np.array([len(ids)]))
        return np.fromiter(map(self.entry.__getitem__, pieces), np.int64, len(pieces))

    def merge_in_step(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end and their counts.

        Each round merges, in every piece, its pair of least rank: all its places from the
        left that do not overlap, or the leftmost alone where a merge could make a pair
        of still smaller rank, so the order is that of one merge at a time.
        """
        tokens = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), np.fromiter(map(len, pieces), np.int64, len(pieces)))
        out_tokens, out_owner = [], []
        rank = self._pair_ranks(tokens, owner)
        while len(tokens):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            least = np.minimum.reduceat(rank, starts)
            run = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(owner)]))
            done = (least == self.size)[run]
            if done.any():  # pieces without a pair to merge leave
                out_tokens.append(tokens[done])
                out_owner.append(owner[done])
                left = ~done
                tokens, owner, rank, least = tokens[left], owner[left], rank[left], least[run][left]
                if not len(tokens):
                    break
            else:
                least = least[run]
            at = np.flatnonzero(rank == least)
            # Of places next to each other (a pair of equal tokens) every second one counts.
            fresh = np.r_[True, (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])]
            heads = np.flatnonzero(fresh)
            step = np.arange(len(at)) - np.repeat(heads, np.diff(np.r_[heads, len(at)]))
            first = np.r_[True, owner[at[1:]] != owner[at[:-1]]]
            at = at[np.where(self.careful[least[at]], first, step % 2 == 0)]
            tokens[at] = least[at]
            stay = np.ones(len(tokens), bool)
            stay[at + 1] = False
            before = np.cumsum(stay) - 1
            tokens, owner, rank = tokens[stay], owner[stay], rank[stay]
            now = before[at]
            # Only pairs at a merged token have another rank.
            touched = np.unique(np.concatenate([now, now[now > 0] - 1]))
            rank[touched] = self._pair_ranks(tokens, owner, touched)
        tokens, owner = np.concatenate(out_tokens), np.concatenate(out_owner)
        order = np.argsort(owner, kind="stable")
        return tokens[order].astype(np.int32), np.bincount(owner, minlength=len(pieces))

    def _pair_ranks(self, tokens: np.ndarray, owner: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The rank of each token (or those ``at``) with the next one of the same piece."""
        at = np.arange(len(tokens)) if at is None else at
        out = np.full(len(at), self.size, np.int64)
        inside = at + 1 < len(tokens)
        inside[inside] = owner[at[inside]] == owner[at[inside] + 1]
        where = at[inside]
        out[inside] = self.ranks_of(tokens[where], tokens[where + 1])
        return out

    def merge_with_heap(self, piece: bytes) -> list[int]:
        """Ids of one long piece, n log n in its length."""
        tokens = self.single[np.frombuffer(piece, np.uint8)].tolist()
        size = len(tokens)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        found = self.ranks_of(*(np.array(x, np.int64) for x in (tokens[:-1], tokens[1:]))).tolist()
        heap = [(rank, n, tokens[n], tokens[n + 1]) for n, rank in enumerate(found) if rank < self.size]
        heapify(heap)
        while heap:
            rank, n, left, right = heappop(heap)
            m = after[n]
            if tokens[n] != left or m >= size or tokens[m] != right:
                continue  # one of the two has been merged since
            tokens[n], tokens[m] = rank, -1
            after[n] = after[m]
            if after[m] < size:
                before[after[m]] = n
            for a, b in ((before[n], n), (n, after[n])):
                if a >= 0 and b < size and (new := self.merged.get(tokens[a] << 32 | tokens[b])) is not None:
                    heappush(heap, (new, a, tokens[a], tokens[b]))
        return [x for x in tokens if x >= 0]

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end, and each text's first place among them (one more at the end)."""
        cuts = np.union1d(bounds, long_text_cuts(data, bounds)) if len(data) > 2 * RUN_BYTES else bounds
        if len(cuts) == len(np.unique(bounds)) or cuts is bounds:
            return self._encode(data, bounds)
        found, places = [], [np.zeros(1, np.int64)]
        for i, j in H.chunks(cuts, RUN_BYTES):
            ids, firsts = self._encode(data[cuts[i] : cuts[j]], cuts[i : j + 1] - cuts[i])
            found.append(ids)
            places.append(firsts[1:] + places[-1][-1])
        return np.concatenate(found), np.concatenate(places)[np.searchsorted(cuts, bounds)]

    def _encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = piece_starts(data, bounds)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(bounds), np.int64)
        ends = np.r_[starts[1:], len(data)]
        numbers, heads = H.distinct_slices(data, starts, ends)
        whole = data.tobytes()
        entries = self.entries([whole[a:b] for a, b in zip(starts[heads].tolist(), ends[heads].tolist(), strict=True)])
        mine = entries[numbers]
        count = self.count[mine]
        ends = np.cumsum(count)
        place = np.arange(ends[-1]) + np.repeat(self.begin[mine] - (ends - count), count)
        firsts = np.r_[0, ends][np.searchsorted(starts, bounds)]
        return self.ids[place], firsts


@cache
def strings(name: str) -> Strings:
    return Strings(vocabulary_path(name))


@cache
def ranks(name: str) -> Ranks:
    """The merger of this Python process; it keeps its cache from task to task."""
    return Ranks(vocabulary_path(name))


def _encoder(name: str):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = ranks(name)
        for batch in batches:
            data, bounds = H.text_bytes(batch.column("text"))
            others = batch.drop_columns(["text"])
            for i, j in H.chunks(bounds, RUN_BYTES):
                ids, firsts = merger.encode(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                length = merger.lengths[ids]
                ends = np.cumsum(length)
                # An id's offset counts from its own text's first byte.
                base = np.repeat(bounds[i:j] - bounds[i], np.diff(firsts))
                offsets = (ends - length - base).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(x)) for x in (ids, offsets)]
                kept = others.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*kept.columns, *lists], names=[*kept.schema.names, "ids", "offsets"])

    return emit


def encoded(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """Per row of ``docs`` its doc_id, ``ids`` of its whole text, and ``offsets``, the byte at which each id begins.

    Ids are those of the tiktoken library under the ranks of file ``name`` and the public
    pattern, without special tokens, whose strings are text like any other. A null text is
    empty and has no ids; rows are never joined or dropped, so repeated rows, null or equal
    ids and empty tables need no care; other columns are not looked at. A text of any
    length is encoded whole, by one task, in parts of about RUN_BYTES that end where a
    piece surely does; a piece (a run of letters, say) is never cut and needs some 150 bytes
    of memory for each of its own beyond STEP_BYTES.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(_encoder(name), "doc_id long, ids array<int>, offsets array<int>")


def decoded_bytes(known: Strings, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bytes of ids that begin at ``offsets`` of one output, which has no gaps but may start late."""
    length = known.lengths[ids]
    if not len(ids):
        return np.zeros(0, np.uint8)
    low = int(offsets[0])
    out = np.empty(int(offsets[-1] + length[-1]) - low, np.uint8)
    within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(offsets - low, length) + within] = known.texts[np.repeat(known.text_starts[ids], length) + within]
    return out


def _decoded_runs(batch: pa.RecordBatch, known: Strings):
    """Rows i to j of a batch at a time: their ids, the first of each row, their bytes, and those' bounds."""
    column, places = batch.column("ids"), batch.column("offsets")
    ids, offsets = (x.flatten().to_numpy(zero_copy_only=False) for x in (column, places))
    at = column.offsets.to_numpy().astype(np.int64)
    at = at - at[0]
    for i, j in H.chunks(at * 4, RUN_BYTES):
        mine, first = ids[at[i] : at[j]], at[i : j + 1] - at[i]
        bounds = np.r_[0, np.cumsum(known.lengths[mine])][first]
        # Each text's own offsets, moved to where the text lies among those decoded together.
        row = np.repeat(np.arange(j - i), np.diff(first))
        yield i, j, mine, first, decoded_bytes(known, mine, offsets[at[i] : at[j]] + bounds[row]), bounds


def _decoder(name: str):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = strings(name)
        for batch in batches:
            others = batch.drop_columns(["ids", "offsets"])
            for i, j, _, _, data, bounds in _decoded_runs(batch, known):
                buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]
                column = pa.Array.from_buffers(pa.large_binary(), j - i, buffers).cast(pa.binary())
                kept = others.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([*kept.columns, column], names=[*kept.schema.names, "decoded"])

    return emit


def decoded(rows: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """``rows`` with the bytes of their ``ids`` in column ``decoded`` in place of ids and offsets."""
    others = [f for f in rows.schema.fields if f.name not in ("ids", "offsets", "decoded")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), "decoded binary"])
    return rows.select(*[f.name for f in others], "ids", "offsets").mapInArrow(_decoder(name), schema)


def _digests(name: str):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = strings(name)
        decimal = list(map(str, range(len(known.lengths))))
        for batch in batches:
            for i, j, ids, first, data, bounds in _decoded_runs(batch, known):
                said, back = [], []
                for n in range(j - i):
                    mine = ids[first[n] : first[n + 1]].tolist()
                    said.append(hashlib.sha256(" ".join(map(decimal.__getitem__, mine)).encode()).hexdigest())
                    back.append(hashlib.sha256(data[bounds[n] : bounds[n + 1]]).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array(np.diff(first)), pa.array(said), pa.array(back)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return emit


def round_trip(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """Per document: doc_id, n_tokens, the SHA-256 of its ids in decimal and of the decoded bytes."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encoded(docs, name).mapInArrow(_digests(name), schema)
