"""Token ids of whole texts, with a bounded cache of the words that texts are made of.

The ids are those of the tokenizers library on the whole text. A text is cut only where
the library's own rules always cut, so that the ids of the pieces, each made once by the
library and cached, joined are the ids of the text. A text for which that is not certain
is encoded whole; so is one that holds the string of an added token.

The texts of a part are cut at single spaces and line feeds into chunks, and each
distinct chunk is looked at once: a column at a time, without a Python string per word of
the texts. A chunk is cut on into a word of Latin letters and the marks after it; a word
that is not known goes to the library's model, anything else through the whole library.
Very long texts are cut like others, in memory in proportion to the text.
"""

import gc
import os
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pointstream.llm.frames import give_back

# Entries of each of the two generations of a cache of parts, and the longest part that
# is cached.
CACHED = 300_000
CACHED_CHARS = 48
# Bytes that each of the two generations of the cache of words may hold before it turns,
# and what an entry takes at most on average: words are short (``CACHED_CHARS`` at most).
CACHED_BYTES = 48 << 20
_ENTRY_BYTES = 200
# Bytes and rows of text that are encoded together, and pieces that go to the library
# together.
PART_BYTES = 8 << 20
PART_ROWS = 1 << 15
ENCODED = 2048

# Control characters, spaces other than the usual ones, and joiners.
_ODD = (
    r"[\x00-\x08\x0b-\x1f\x7f-\x{a0}\x{34f}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}"
    r"\x{205f}-\x{206f}\x{3000}\x{feff}]"
)
# White space that is not one space or one line feed between other characters.
_WIDE = r"[ \n][ \n]|\t|\A[ \n]|[ \n]\z"
# A word of Latin letters and the marks that end a chunk. The library always cuts between
# the two; an apostrophe is not among the marks, as it may begin a piece of its own.
_WORD = re.compile(r"(\n?)([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,;:!?|*%$#&]*)")


def _byte_characters() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others in order for those from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: 256 + i for i, b in enumerate(rest)}


_BYTES = _byte_characters()
_SPACE = chr(_BYTES[ord(" ")])
# Before the name of a word without its space, or of marks, in the cache; not in a chunk
# that is a word.
_BARE = "\x01"


class Generations:
    """A cache of bounded size: what was not used for a whole generation is forgotten."""

    def __init__(self, size: int = CACHED):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys: Iterable) -> list:
        """Keys that are not known; known ones become young."""
        out = []
        for key in keys:
            if key in self.young:
                continue
            if key in self.old:
                self.young[key] = self.old[key]
            else:
                out.append(key)
        return out

    def turn(self) -> None:
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young


class Words:
    """Ids of words, bounded in bytes: what was not used for a whole generation is forgotten."""

    def __init__(self, limit: int = CACHED_BYTES):
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def turn(self) -> None:
        """For the end of a part: an entry is taken for ``_ENTRY_BYTES``."""
        if len(self.young) * _ENTRY_BYTES > self.limit:
            self.young, self.old = {}, self.young


def _strings(column: pa.Array) -> list[str]:
    """Strings of a column without nulls, several times as fast as one by one."""
    return column.to_numpy(zero_copy_only=False).tolist()


_IS_LITTLE = sys.byteorder == "little"


def _little(ids: list[int]) -> bytes:
    body = array("I", ids)
    if not _IS_LITTLE:
        body.byteswap()
    return body.tobytes()


class Encoder:
    """Whole texts to little-endian 32-bit ids.

    ``special`` tells whether the string of a special token in a text is that token, as
    the library has it unless told otherwise, or ordinary text. ``cache_bytes`` and
    ``part_bytes`` bound what it holds (``CACHED_BYTES`` and ``PART_BYTES`` unless given):
    with less it makes more words anew, and the same ids.
    """

    #: Whether spaces belong to the words after them; else white space is dropped.
    spaced: bool
    #: Whether words are lower-cased.
    lower = False

    def __init__(
        self,
        path: str,
        special: bool = False,
        cache_bytes: int | None = None,
        part_bytes: int | None = None,
    ):
        # The tasks of an executor are its parallelism.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        added = self.tokenizer.get_added_tokens_decoder().values()
        added = [t for t in added if special or not t.special]
        self.added = [t.content for t in added]
        # Strings that the library looks for in the normalized text.
        self.normalized = any(t.normalized for t in added) and self.tokenizer.normalizer
        self.model = self.tokenizer.model
        self.words = Words(CACHED_BYTES if cache_bytes is None else cache_bytes)
        self.part_bytes = part_bytes

    def vocabulary_size(self) -> int:
        return self.tokenizer.get_vocab_size()

    def _whole(self, texts: list[str]) -> list[bytes]:
        """Texts through the whole library."""
        out = []
        for at in range(0, len(texts), ENCODED):
            found = self.tokenizer.encode_batch_fast(
                texts[at : at + ENCODED], add_special_tokens=False
            )
            out += [_little(f.ids) for f in found]
        return out

    def _word(self, word: str, spaced: bool) -> bytes:
        """A word of letters, with a space before it or not, through the model."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTES)
        ids = [token.id for token in self.model.tokenize(_SPACE + word if spaced else word)]
        return array("I", ids).tobytes() if _IS_LITTLE else _little(ids)

    def _cut(self, column: pa.Array) -> pa.ListArray:
        """Chunks of texts that can be cut."""
        raise NotImplementedError

    def _uncut(self, column: pa.Array) -> pa.Array:
        """Whether a text must be encoded whole, apart from added tokens."""
        raise NotImplementedError

    def _holds_added(self, text: str) -> bool:
        """Whether the string of an added token is in the text."""
        if any(a in text for a in self.added):
            return True
        if not self.normalized:
            return False
        plain, normal = self.normalized.normalize_str(text), self.normalized.normalize_str
        return any(normal(a) in plain for a in self.added)

    def _text_of(self, chunk: str) -> str:
        """What a chunk stands for in the text."""
        return chunk

    def _chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks."""
        words, other = self.words, self._other
        young, old = words.young, words.old
        out = list(map(young.get, chunks))
        missed = [at for at, ids in enumerate(out) if ids is None]
        whole, fullmatch, make = [], _WORD.fullmatch, self._word
        spaced, lower = self.spaced, self.lower
        for at in missed:
            chunk = chunks[at]
            size = len(chunk)
            if size <= CACHED_CHARS and chunk.isascii() and chunk.isalpha():
                feed, word, marks = "", chunk, ""
            else:
                found = fullmatch(chunk) if size <= CACHED_CHARS else None
                if found is None:
                    whole.append(at)
                    continue
                feed, word, marks = found.groups()
            if lower:
                word = word.lower()
            # A word alone is known as the chunk that it is; after a line feed it has no
            # space, and a name of its own.
            name = _BARE + word if feed else word
            ids = young.get(name)
            if ids is None:
                ids = young[name] = old.get(name) or make(word, spaced and not feed)
            if marks:
                ids += other(marks)
            out[at] = other(feed) + ids if feed else ids
        for at, ids in zip(whole, self._whole([self._text_of(chunks[at]) for at in whole])):
            out[at] = ids
        words.turn()
        return out

    def _other(self, piece: str) -> bytes:
        """A line feed or marks."""
        if not piece:
            return b""
        words, name = self.words, _BARE + piece
        ids = words.young.get(name)
        if ids is None:
            ids = words.young[name] = words.old.get(name) or self._whole([piece])[0]
        return ids

    def encode(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        """Ids of each text; a null one is empty."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        return [ids for _, found in self.encode_parts(column) for ids in found]

    def encode_parts(self, column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        """The same part by part: the first row of a part, and the ids of its texts."""
        column = pc.fill_null(column, "")
        begin, size, most = 0, 0, self.part_bytes or PART_BYTES
        for at, length in enumerate(pc.binary_length(column).to_pylist()):
            size += length
            if size >= most or at + 1 - begin >= PART_ROWS:
                yield begin, self._unswept(column.slice(begin, at + 1 - begin))
                begin, size = at + 1, 0
        if begin < len(column):
            yield begin, self._unswept(column.slice(begin))

    def _unswept(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of a part, without searching for cycles meanwhile: it makes many objects, and none."""
        swept = gc.isenabled()
        gc.disable()
        try:
            return self._encode(column)
        finally:
            if swept:
                gc.enable()

    def _encode(self, column: pa.Array) -> list[np.ndarray]:
        texts = _strings(column)
        uncut = self._uncut(column).to_numpy(zero_copy_only=False)
        uncut |= np.fromiter(map(self._holds_added, texts), bool, len(texts))
        cut = self._cut(pc.if_else(pa.array(uncut), "", column) if uncut.any() else column)
        first = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        words = pc.dictionary_encode(cut.flatten())
        bodies = self._chunk_ids(_strings(words.dictionary))
        known = np.frombuffer(b"".join(bodies), dtype="<u4")
        counts = np.fromiter(map(len, bodies), np.int64, len(bodies)) // 4
        begins = np.cumsum(counts) - counts
        # The ids of every chunk of the texts, one after the other.
        which = words.indices.to_numpy()
        each = counts[which]
        ends = np.cumsum(each)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, len(known)) < 1 << 31 else np.int64
        places = np.repeat((begins[which] - (ends - each)).astype(kind), each)
        places += np.arange(total, dtype=kind)
        ids = known[places]
        bounds = np.concatenate([[0], ends])[first]
        out = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        odd = np.flatnonzero(uncut).tolist()
        for at, body in zip(odd, self._whole([texts[at] for at in odd])):
            out[at] = np.frombuffer(body, dtype="<u4")
        return out


class ByteLevel(Encoder):
    """A token holds a space only as its first character, or is all white space.

    So a text is cut before each single space and around each single line feed. A chunk
    is a word without its space, or a line feed and the word after it.
    """

    spaced = True

    #: Marks the first chunk of a text, which has no space; not in a text that is cut.
    _FIRST = "\x00"

    def _uncut(self, column: pa.Array) -> pa.Array:
        return pc.match_substring_regex(column, f"{_ODD}|{_WIDE}")

    def _cut(self, column: pa.Array) -> pa.ListArray:
        feeds = pc.replace_substring(column, "\n", " \n")
        marked = pc.binary_join_element_wise(pa.scalar(self._FIRST), feeds, pa.scalar(""))
        return pc.split_pattern(marked, " ")

    def _text_of(self, chunk: str) -> str:
        if chunk[0] == self._FIRST:
            return chunk[1:]
        return chunk if chunk[0] == "\n" else " " + chunk


class WordLevel(Encoder):
    """White space is dropped and words end at it; Latin text is lower-cased."""

    spaced, lower = False, True

    def _uncut(self, column: pa.Array) -> pa.Array:
        return pc.match_substring_regex(column, _ODD)

    def _cut(self, column: pa.Array) -> pa.ListArray:
        return pc.ascii_split_whitespace(column)


@cache
def byte_level(path: str, special: bool = False, **memory: int | None) -> Encoder:
    return ByteLevel(path, special, **memory)


@cache
def word_level(path: str, special: bool = False, **memory: int | None) -> Encoder:
    return WordLevel(path, special, **memory)


def release() -> None:
    """Drop what this worker keeps for tokenizing, and hand the memory back.

    For the end of a task: a worker serves other stages after it.
    """
    byte_level.cache_clear()
    word_level.cache_clear()
    give_back()
