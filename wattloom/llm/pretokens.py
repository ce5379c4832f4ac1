"""Token ids of whole texts, exactly as the ``tokenizers`` library gives them.

A BPE tokenizer cuts a text into pre-tokens and encodes each by itself, so the ids
of a pre-token can be kept and used again.  :class:`TextEncoder` does that for every
text: blocks of Latin characters, whose classes it knows, are cut by an expression,
other blocks by the library's own normaliser and pre-tokeniser.  Only a tokenizer of
another kind than these takes texts whole.

Texts that come together share more: of a group of texts, each distinct word (a text is
cut before its spaces) is cut into pre-tokens and looked up once.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

# The pattern a byte-level pre-tokenizer splits by.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Letters, numbers, white space and all characters of the Latin blocks
# (below U+0180, without control characters and the no-break space).
LATIN_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
LATIN_NUMBERS = "0-9²³¹¼-¾"
LATIN_SPACES = " \\t-\\r"
LATIN = re.compile("[\t-\r -~¡-ſ]*")

# Segments longer than this many characters are cut at a space between two words.
BLOCK_CHARS = 1 << 20
_BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
# Texts that come together are worked on in groups of about so many bytes.
GROUP_BYTES = 8 << 20
# A character outside the Latin blocks, or a space that a byte-level pre-tokenizer may join
# to the white space before it.  Before any other space a pre-token ends.
_UNEVEN = "[^\t-\r -~¡-ſ]|[\t-\r ] "
# Pre-tokens in a generation of a cache; a Python worker keeps at most two generations.
CACHE_LIMIT = 200_000
# The same for words of texts that come together; a longer word is not kept.
WORD_LIMIT = 400_000
WORD_CHARS = 64


def _byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _latin_pattern(pattern: str) -> re.Pattern:
    """``pattern`` with its Unicode classes narrowed to the Latin blocks."""
    others = f"[^{LATIN_SPACES}{LATIN_LETTERS}{LATIN_NUMBERS}]"
    for name, narrow in (
        (r"[^\s\p{L}\p{N}]", others),
        (r"[\p{L}]", f"[{LATIN_LETTERS}]"),
        (r"[\p{N}]", f"[{LATIN_NUMBERS}]"),
        (r"\p{L}", f"[{LATIN_LETTERS}]"),
        (r"\p{N}", f"[{LATIN_NUMBERS}]"),
        (r"\s", f"[{LATIN_SPACES}]"),
    ):
        pattern = pattern.replace(name, narrow)
    return re.compile(pattern)


def _split_pattern(spec: dict) -> tuple[str | None, bool]:
    """The pre-token pattern of a tokenizer file and whether it lower-cases; None if unknown."""
    pre = spec["pre_tokenizer"] or {}
    if (
        pre.get("type") == "ByteLevel"
        and pre.get("use_regex")
        and not pre.get("add_prefix_space")
        and not spec["normalizer"]
    ):
        return BYTE_LEVEL_PATTERN, False
    steps = pre.get("pretokenizers") or []
    normalizers = (spec["normalizer"] or {}).get("normalizers") or []
    if (
        [s.get("type") for s in steps] == ["Split", "ByteLevel"]
        and steps[0]["behavior"] == "Removed"
        and steps[0]["invert"]
        and "Regex" in steps[0]["pattern"]
        and not steps[1]["use_regex"]
        and not steps[1]["add_prefix_space"]
        and [n.get("type") for n in normalizers] == ["NFC", "Replace", "Lowercase"]
        and normalizers[1]["pattern"] == {"Regex": r"\s+"}
        and normalizers[1]["content"] == " "
    ):
        return steps[0]["pattern"]["Regex"], True
    return None, False


class _Cache(dict):
    """Values by string; a missing one is made and kept.

    When a generation is full it becomes the older one, from which what is asked for
    again is taken over; ``first`` is in every generation.
    """

    def __init__(self, make: Callable[[str], object], limit: int, first: dict | None = None):
        super().__init__(first or {})
        self._make, self._first, self._older = make, first or {}, {}
        self._limit = limit + len(self._first)

    def __missing__(self, key: str):
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
        if len(self) >= self._limit:
            self._older = dict(self)
            self.clear()
            self.update(self._first)
        self[key] = value
        return value


class TextEncoder:
    """Ids of whole texts without begin, end or added special tokens.

    Special strings inside a text become their special ids, as the library does by
    default.  ``known_lengths`` are pre-token lengths worked out beforehand.
    """

    def __init__(
        self, path: str, known_lengths: dict[str, int] | None = None, cache: int | None = None
    ):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        pattern, self._lower = _split_pattern(spec)
        added = spec["added_tokens"]
        flags = ("single_word", "lstrip", "rstrip", "normalized")
        self._by_piece = pattern is not None and not any(t[f] for t in added for f in flags)
        self._pattern = _latin_pattern(pattern) if self._by_piece else None
        self._special = {t["content"]: t["id"] for t in added}
        names = sorted(self._special, key=len, reverse=True)
        self._special_pattern = re.compile("(" + "|".join(map(re.escape, names)) + ")")
        even = self._by_piece and pattern == BYTE_LEVEL_PATTERN
        self._uneven = "|".join([_UNEVEN, *map(re.escape, names)]) if even else None
        self._model = self.tokenizer.model
        self._bytes = _byte_chars()
        self._ids = _Cache(self.piece_ids, cache or CACHE_LIMIT)
        self._words = _Cache(self._word_ids, cache or WORD_LIMIT)
        self._lengths = _Cache(self._piece_length, cache or CACHE_LIMIT, known_lengths)

    def _piece_length(self, piece: str) -> int:
        return len(self._encoded(piece))

    def _encoded(self, piece: str) -> list:
        return self._model.tokenize(piece.encode().decode("latin-1").translate(self._bytes))

    def piece_ids(self, piece: str) -> bytes:
        """Ids of one pre-token, not kept."""
        return array("I", [t.id for t in self._encoded(piece)]).tobytes()

    def _word_ids(self, word: str) -> bytes:
        """Ids of a pre-token, or of several in one string of Latin characters."""
        pieces = self._pattern.findall(word)
        if len(pieces) == 1:
            return self.piece_ids(word)
        return b"".join(map(self._words.__getitem__, pieces))

    def _segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """Parts of a text and whether each is a special string; long parts in blocks."""
        parts = self._special_pattern.split(text) if self._special else [text]
        for number, part in enumerate(parts):
            if number % 2:
                yield part, True
                continue
            start = 0
            while len(part) - start > BLOCK_CHARS:
                cut = _BETWEEN_WORDS.search(part, start + BLOCK_CHARS)
                if cut is None:
                    break
                yield part[start : cut.start()], False
                start = cut.start()
            yield part[start:] if start else part, False

    def _pieces(self, segment: str) -> list[str]:
        if LATIN.fullmatch(segment):
            return self._pattern.findall(segment.lower() if self._lower else segment)
        if self.tokenizer.normalizer is not None:
            segment = self.tokenizer.normalizer.normalize_str(segment)
        cuts = self.tokenizer.pre_tokenizer.pre_tokenize_str(segment)
        return [segment[start:end] for _, (start, end) in cuts]

    def pretokens(self, text: str | None) -> Iterator[list[str]]:
        """The pre-tokens of a text in blocks; none if the tokenizer takes texts whole."""
        if text and self._by_piece:
            for segment, special in self._segments(text):
                if not special:
                    yield self._pieces(segment)

    def ids(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; none for null or empty text."""
        if not text:
            return b""
        if not self._by_piece:
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        found = self._ids.__getitem__
        return b"".join(
            array("I", [self._special[segment]]).tobytes()
            if special
            else b"".join(map(found, self._pieces(segment)))
            for segment, special in self._segments(text)
        )

    def batch_ids(self, texts: pa.Array) -> Iterator[bytes]:
        """:meth:`ids` of each text of an Arrow array, in its order."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
        first = 0
        while first < len(texts):
            most = GROUP_BYTES + (ends[first - 1] if first else 0)
            last = max(first + 1, int(np.searchsorted(ends, most, side="right")))
            yield from self._group_ids(texts.slice(first, last - first))
            first = last

    def _group_ids(self, texts: pa.Array) -> Iterator[bytes]:
        if self._uneven is None:
            yield from (self.ids(text.as_py()) for text in texts)
            return
        even = pc.and_(
            pc.invert(pc.match_substring_regex(texts, self._uneven)),
            pc.less_equal(pc.binary_length(texts), BLOCK_CHARS),
        ).fill_null(False)
        words = pc.split_pattern(texts.filter(even), " ")
        starts = words.offsets.to_numpy()
        coded = words.values.dictionary_encode()
        distinct = [" " + word for word in coded.dictionary.to_numpy(zero_copy_only=False)]
        # No space comes before the first word of a text.
        distinct += words.values.take(words.offsets[:-1]).to_pylist()
        codes = coded.indices.to_numpy().copy()
        codes[starts[:-1]] = np.arange(len(distinct) - len(starts) + 1, len(distinct))
        found = self._words.__getitem__
        ids = pa.array(
            [found(w) if len(w) <= WORD_CHARS else self._word_ids(w) for w in distinct], pa.binary()
        )
        ids = ids.take(pa.array(codes))
        _, offsets, data = ids.buffers()
        spans = np.frombuffer(offsets, np.int32, len(ids) + 1)[starts].tolist()
        text = 0
        for number, is_even in enumerate(even.to_pylist()):
            if is_even:
                yield data[spans[text] : spans[text + 1]].to_pybytes() if data else b""
                text += 1
            else:
                yield self.ids(texts[number].as_py())

    def count(self, text: str | None) -> int:
        """Number of ids."""
        if not text:
            return 0
        if not self._by_piece:
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        found = self._lengths.__getitem__
        return sum(
            1 if special else sum(map(found, self._pieces(segment)))
            for segment, special in self._segments(text)
        )


@lru_cache(maxsize=4)
def text_encoder(path: str, cache: int | None = None) -> TextEncoder:
    """The encoder of this Python worker, kept from task to task."""
    return TextEncoder(path, cache=cache)
