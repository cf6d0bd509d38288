"""Ids of whole texts under a public vocabulary, through a bounded cache of their parts.

A text is cut before white space, and where an ASCII letter meets a stop or comma: no
token and no rule of these vocabularies reaches across such a place, so the parts' ids
laid end to end are the text's ids. Vocabularies that take a run of letters for one word
are cut at more places. Parts are found and told apart by whole arrays, and each distinct
one is encoded once by the tokenizers library for as long as the cache holds it. A part
that is one word goes straight to the library's model; the library would find no other
word in it.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa

from tallybook.llm import hashing as H

#: Parts that one Python worker holds of each vocabulary in use (about 70 bytes each). When they
#: are too many, half stay: those met most often, of late more than long ago.
CACHE_PARTS = 500_000
#: Texts are looked at together up to about this many bytes; a longer one makes a run of its own.
RUN_BYTES = 1 << 19
#: Parts that the library encodes in one call; longer texts of more parts cost it more for each.
BATCH = 256
#: The last byte of white space outside ASCII, by the bytes before it (Unicode's White_Space).
_WIDE_SPACE = {
    (0xC2,): (0x85, 0xA0),
    (0xE1, 0x9A): (0x80,),
    (0xE2, 0x80): (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF),
    (0xE2, 0x81): (0x9F,),
    (0xE3, 0x80): (0x80,),
}
#: U+2581, which piece vocabularies take for a blank.
_BLANK_SIGN = {(0xE2, 0x96): (0x81,)}
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,")] = True
#: Signs of ASCII but the apostrophe, before which some letters are a word of their own ("'s").
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[x for x in range(0x21, 0x7F) if not chr(x).isalnum() and chr(x) != "'"]] = True
#: Line breaks and other white space of ASCII that no word begins with.
_BREAK = np.zeros(256, bool)
_BREAK[9:14] = True
#: First bytes of U+00C0 to U+023F, all letters but the signs of multiplication and division.
_WIDE_LEAD = np.zeros(256, bool)
_WIDE_LEAD[0xC3:0xC9] = True
#: A word that may have a blank before it: letters of ASCII and from U+00C0 to U+023F.
_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|[\xc4-\xc8][\x80-\xbf])+")
_WORD_LETTERS = "".join(x for x in map(chr, (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x240))) if x not in "\u00d7\u00f7")


def _space_ends(data: np.ndarray, kinds: dict[tuple[int, ...], tuple[int, ...]]) -> np.ndarray:
    """Bytes that end one of these characters."""
    space = np.zeros(len(data), bool)
    if len(data) and data.max() >= 0xC2:
        for before, last in kinds.items():
            n = len(before)
            hit = np.isin(data[n:], np.array(last, np.uint8))
            for k, byte in enumerate(before):
                hit &= data[k : len(data) - n + k] == byte
            space[n:] |= hit
    return space


#: How a vocabulary treats white space: it belongs to its tokens; it is dropped; blanks alone are
#: white space, and every text has one more before it.
SPACED, BARE, BLANKS = range(3)


def _letter_ends(data: np.ndarray) -> np.ndarray:
    """Bytes that end a letter of ``_WORD_LETTERS``."""
    found = _LETTER[data]
    if len(data) > 1 and data.max() >= 0xC3:
        lead, last = data[:-1], data[1:]
        found[1:] |= _WIDE_LEAD[lead] & ~((lead == 0xC3) & ((last == 0x97) | (last == 0xB7)))
    return found


def part_bounds(data: np.ndarray, bounds: np.ndarray, kind: int, signs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every part of the texts; ``BARE`` ones leave out the white space of ASCII.

    A part ends before white space (of ASCII, after any other character) and before a stop
    or comma after an ASCII letter. With a table of ``signs`` it also ends between a letter
    and one of those, and between a single line break and a letter.
    """
    size = len(data)
    if not size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = data == 0x20 if kind == BLANKS else H.GAP[data]
    space = _space_ends(data, _BLANK_SIGN) | gap if kind == BLANKS else H.GAP[data] | _space_ends(data, _WIDE_SPACE)
    cut = np.zeros(size + 1, bool)
    if signs is not None:
        cut[1:size] = (gap[1:] & ~space[:-1]) | (signs[data[1:]] & _letter_ends(data)[:-1])
    else:
        cut[1:size] = (gap[1:] & ~space[:-1]) | (_STOP[data[1:]] & _LETTER[data[:-1]])
    cut[bounds] = True
    if signs is not None:  # more white space before the line break would take it for its own
        cut[1:size] |= cut[: size - 1] & _BREAK[data[:-1]] & (_LETTER | _WIDE_LEAD)[data[1:]]
    if kind != BARE:
        places = np.flatnonzero(cut)
        return places[:-1], places[1:]
    first, last = cut[:size].copy(), cut[1:].copy()
    first[1:] |= gap[:-1]
    last[:-1] |= gap[1:]
    return np.flatnonzero(first & ~gap), np.flatnonzero(last & ~gap) + 1


_open: dict[str, Vocabulary] = {}


def vocabulary_path(name: str) -> str:
    """A file of the public tokenizers by its name; anything with a slash is a path already."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary_digest(name: str) -> str:
    """SHA-256 of the vocabulary file: what a stored count was made with."""
    import hashlib

    with open(vocabulary_path(name), "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


class Vocabulary:
    """Encoder of one vocabulary file, .json for tokenizers and .model for sentencepiece."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.room = CACHE_PARTS
        self.clear()
        self.word_model = self.signs = None
        if path.endswith(".model"):
            import sentencepiece

            self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
            self.size = self.pieces.vocab_size()
            self.kind = self._piece_kind()
            self.line_break = self.pieces.piece_to_id("<0x0A>")
            return
        from tokenizers import Tokenizer

        self.pieces = None
        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size()
        special = [t for t in self.library.get_added_tokens_decoder().items() if t[1].special and not t[1].normalized]
        self.mark_id, self.mark = (special[-1][0], special[-1][1].content) if special else (-1, "")
        probe = self.library.encode("a  b", add_special_tokens=False)
        self.kind = BARE if sum(end - start for start, end in probe.offsets) < 4 else SPACED
        self.word_model = self._find_word_model()

    def _find_word_model(self):
        """The library's model, if letters after a blank are one word to it, cut off by signs and line breaks; else None."""
        from tokenizers.pre_tokenizers import ByteLevel

        split = self.library.pre_tokenizer
        if self.kind != SPACED or self.library.normalizer is not None or not isinstance(split, ByteLevel):
            return None
        whole = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = {x: whole.pre_tokenize_str(x)[0][0] for x in " " + _WORD_LETTERS}
        self.byte_signs = str.maketrans({chr(b): sign for x, found in letters.items() for b, sign in zip(x.encode(), found, strict=True)})
        # The library cuts at added tokens first, so no cut may fall into one and none may lie in a word.
        added = [x.content.encode() for x in self.library.get_added_tokens_decoder().values()]
        signs = _SYMBOL.copy()
        signs[list(b"".join(added))] = False
        texts = [x + _WORD_LETTERS for x in ("", " ")]
        one = all([x for x, _ in split.pre_tokenize_str(text)] == ["".join(map(letters.get, text))] for text in texts)
        after = [chr(x) for x in np.flatnonzero(signs)]
        apart = all(len(split.pre_tokenize_str(x)) == 2 for x in ("\na", "\n\u00e9", *("a" + x for x in after), *("\u00e9" + x for x in after)))
        if not one or not apart or any(_WORD.fullmatch(x + b"a") or _BREAK[list(x)].any() for x in added):
            return None
        self.signs = signs
        return self.library.model

    def _piece_kind(self) -> int | None:
        """BLANKS if no piece reaches across a cut and a line break stands alone; else texts are encoded whole."""
        pieces = [self.pieces.id_to_piece(x) for x in range(self.size)]
        blank = "\u2581"
        reach = any(blank in x.lstrip(blank) or "\n" in x or re.search("[A-Za-z][.,]", x) for x in pieces)
        alone = [self.pieces.id_to_piece(x) for x in self.pieces.encode("\n a")] == [blank, "<0x0A>", blank + "a"]
        return BLANKS if alone and not reach else None

    def _word_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts that are one word each, end to end, and their counts."""
        signs = b"!".join(words).decode("latin-1").translate(self.byte_signs).split("!")
        tokenize = self.word_model.tokenize
        found = [[token.id for token in tokenize(x)] for x in signs]
        return np.fromiter(chain.from_iterable(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found))

    def clear(self) -> None:
        """The cache: bytes and ids of all parts, each end to end in a growing array, and the parts' hashes in order.

        Part ``n`` is ``text[text_begin[n] : text_begin[n + 1]]``, and its ids lie likewise.
        """
        self.known = 0
        self.text, self.ids = np.zeros(1 << 17, np.uint8), np.zeros(1 << 16, "<u4")
        self.text_begin, self.begin = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.met = np.zeros(1 << 14, np.int64)
        self.hashes, self.hashed = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    @property
    def numbers(self) -> dict[bytes, int]:
        """The parts in the cache and their numbers."""
        whole, bounds = self.text.tobytes(), self.text_begin[: self.known + 1].tolist()
        return {whole[a:b]: n for n, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))}

    def _library_ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts end to end, and their counts."""
        if self.pieces is not None:
            if self.kind == BLANKS and not any("\n" in x for x in parts):
                # A line break is one id, and keeps the blank that the library puts before a text off the parts.
                ids = np.array(self.pieces.encode("\n" + "\n".join(parts)), "<u4")
                at = np.flatnonzero(ids == self.line_break)
                return np.delete(ids, at)[1:], np.diff(at, append=len(ids)) - 1
            skip, lead = (2, "\n") if self.kind == BLANKS else (0, "")
            found = [x[skip:] for x in self.pieces.encode([lead + x for x in parts], num_threads=1)]
            return np.fromiter(chain.from_iterable(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found))
        joined = self.mark.join(parts)
        if self.mark and joined.count(self.mark) == len(parts) - 1:
            # The library cuts at a special token first, so the parts stay apart in one text.
            ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(ids == self.mark_id)
            return np.delete(ids, at), np.diff(at, prepend=-1, append=len(ids)) - 1
        found = [e.ids for e in self.library.encode_batch_fast(parts, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found))

    def fallback(self) -> np.ndarray:
        """Which ids stand for a single byte for want of a piece; white space of ASCII is not counted."""
        if not hasattr(self, "_fallback"):
            self._fallback = np.zeros(self.size, bool)
            if self.pieces is not None:
                spaces = {f"<0x{x:02X}>" for x in range(9, 14)}
                self._fallback[:] = [self.pieces.is_byte(x) and self.pieces.id_to_piece(x) not in spaces for x in range(self.size)]
        return self._fallback

    def _keep(self, text: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Add parts: their bytes end to end and sizes, their hashes, their ids end to end and counts."""

        def grown(array: np.ndarray, size: int) -> np.ndarray:
            return array if size <= len(array) else np.concatenate([array, np.zeros(max(size - len(array), len(array) // 2), array.dtype)])

        known, after = self.known, self.known + len(sizes)
        self.text_begin, self.begin, self.met = (grown(x, after + 1) for x in (self.text_begin, self.begin, self.met))
        self.met[known:after] = 0
        self.text_begin[known + 1 : after + 1] = self.text_begin[known] + np.cumsum(sizes)
        self.begin[known + 1 : after + 1] = self.begin[known] + np.cumsum(counts)
        self.text, self.ids = grown(self.text, int(self.text_begin[after])), grown(self.ids, int(self.begin[after]))
        self.text[self.text_begin[known] : self.text_begin[after]] = text
        self.ids[self.begin[known] : self.begin[after]] = ids
        order = np.argsort(hashes)
        places = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, places, hashes[order])
        self.hashed = np.insert(self.hashed, places, known + order)
        self.known = after

    def _halve(self) -> None:
        """Only half of the room stays: the parts met most often, the earlier of those met equally often."""
        stay = np.sort(np.argsort(-self.met[: self.known], kind="stable")[: self.room // 2])
        sizes = self.text_begin[stay + 1] - self.text_begin[stay]
        hashes = np.zeros(self.known, np.uint64)
        hashes[self.hashed] = self.hashes
        text = H.joined_slices(self.text, self.text_begin[stay], sizes)
        ids, counts, met = self.gathered(stay)[0], self.begin[stay + 1] - self.begin[stay], self.met[stay] // 2
        self.clear()
        self._keep(text, sizes, hashes[stay], ids, counts)
        self.met[: len(met)] = met

    def _held(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Cache numbers of parts, -1 for those that the cache lacks; bytes are compared, not hashes alone."""
        numbers = np.full(len(starts), -1, np.int64)
        place = np.searchsorted(self.hashes, hashes)
        like = np.flatnonzero(place < len(self.hashes))
        like = like[self.hashes[place[like]] == hashes[like]]
        found = self.hashed[place[like]].astype(np.int64)
        equal = self.text_begin[found + 1] - self.text_begin[found] == sizes[like]
        like, found = like[equal], found[equal]
        size = sizes[like]
        differs = H.joined_slices(data, starts[like], size) != H.joined_slices(self.text, self.text_begin[found], size)
        same = np.ones(len(like), bool)
        if differs.any():
            same[np.repeat(np.arange(len(like)), size)[differs]] = False
        numbers[like[same]] = found[same]
        return numbers

    def learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Cache numbers of distinct parts; the library encodes those that the cache lacks."""
        sizes = ends - starts
        numbers = self._held(data, starts, sizes, hashes)
        lacking = np.flatnonzero(numbers < 0)
        if len(lacking) + self.known > self.room:
            self._halve()
            numbers = self._held(data, starts, sizes, hashes)
            lacking = np.flatnonzero(numbers < 0)
        whole = data.tobytes() if len(lacking) else b""

        def bytes_of(some: np.ndarray) -> list[bytes]:
            return [whole[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True)]

        words, missing = 0, bytes_of(lacking)
        if self.word_model is not None:
            other = np.fromiter((x is None for x in map(_WORD.fullmatch, missing)), bool, len(missing))
            words = len(missing) - int(np.count_nonzero(other))
            lacking = lacking[np.argsort(other, kind="stable")]
        elif self.kind == BLANKS:  # those with a line break are encoded apart
            lacking = lacking[np.argsort([b"\n" in x for x in missing], kind="stable")]
        missing = bytes_of(lacking)
        numbers[lacking] = np.arange(self.known, self.known + len(lacking))
        found = [self._word_ids(missing[:words])] if words else []
        for low in range(words, len(missing), BATCH):
            found.append(self._library_ids([x.decode() for x in missing[low : low + BATCH]]))
        if found:
            ids, counts = map(np.concatenate, zip(*found, strict=True))
            size = sizes[lacking]
            self._keep(H.joined_slices(data, starts[lacking], size), size, hashes[lacking], ids, counts)
        return numbers

    def part_numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The cache number of every part ``data[starts[i] : ends[i]]``."""
        if not len(starts):
            return np.zeros(0, np.int64)
        numbers, heads, hashes = H.distinct_hashed(data, starts, ends)
        known = self.learn(data, starts[heads], ends[heads], hashes)
        self.met[known] += np.bincount(numbers, minlength=len(known))
        return known[numbers]

    def gathered(self, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the parts of these cache numbers end to end, and the ends of each part's."""
        count = self.begin[mine + 1] - self.begin[mine]
        return H.joined_slices(self.ids, self.begin[mine], count), np.cumsum(count)

    def encode_rows(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts ``data[bounds[i] : bounds[i + 1]]`` end to end, and each one's first place (one more at the end)."""
        if self.kind is None:
            whole = data.tobytes()
            texts = [whole[a:b].decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            ids, counts = self._library_ids(texts)
            return ids, np.r_[0, np.cumsum(counts)]
        if self.kind == BLANKS:
            filled = np.diff(bounds) > 0
            data = np.insert(data, bounds[:-1][filled], 0x20)
            bounds = bounds + np.r_[0, np.cumsum(filled)]
        starts, ends = part_bounds(data, bounds, self.kind, self.signs)
        ids, part_ends = self.gathered(self.part_numbers(data, starts, ends))
        return ids, np.r_[0, part_ends][np.searchsorted(starts, bounds)]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a column of texts without nulls end to end, and each text's first place (one more at the end)."""
        data, bounds = H.text_bytes(texts)
        found, firsts = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)]
        for i, j in H.chunks(bounds, RUN_BYTES):
            ids, first = self.encode_rows(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
            found.append(ids)
            firsts.append(first[1:] + firsts[-1][-1])
        return np.concatenate(found), np.concatenate(firsts)

    def encode_ended(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``encode_column``, with ``end_id`` after each text."""
        ids, firsts = self.encode_column(texts)
        return np.insert(ids, firsts[1:], end_id), firsts + np.arange(len(firsts))


def id_bytes(ids: np.ndarray, firsts: np.ndarray) -> pa.Array:
    """Rows ``ids[firsts[i] : firsts[i + 1]]`` as a binary column of little-endian unsigned 32-bit integers."""
    buffers = [None, pa.py_buffer((firsts * 4).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(ids, "<u4"))]
    return pa.Array.from_buffers(pa.large_binary(), len(firsts) - 1, buffers).cast(pa.binary())


def vocabulary(name: str) -> Vocabulary:
    """The encoder of this Python process; it keeps its cache from task to task."""
    if name not in _open:
        _open[name] = Vocabulary(vocabulary_path(name))
    return _open[name]


def in_use(*names: str) -> list[Vocabulary]:
    """The encoders of a task. Those of earlier tasks that it does not use give their memory back.

    Tasks without any that need much memory themselves call it with no name.
    """
    for other in _open.keys() - set(names):
        del _open[other]
    found = [vocabulary(name) for name in names]
    return found
