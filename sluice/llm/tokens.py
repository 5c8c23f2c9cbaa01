"""Token ids of whole texts with a tokenizer file, word by word through a bounded store.

A tokenizer whose pre-tokenizer never joins text across white space gives a text the ids
of its white-space separated pieces, one after the other. So each distinct word is encoded
once per worker and later ones are looked up; ``tests/llm`` holds this against encoding
whole texts. It is done for files with exactly the normaliser and split pattern named below;
texts are left to the library as a whole for any other file.

Texts of printable ASCII and the letters of Latin-1 are put in lower case and split as bytes, a
mark at the end of a word apart from it; the new words of many texts go to the model in one
call. Other texts are cut at blanks and line feeds only, and each piece is left to the
tokenizer; any other white space stays inside a piece.
"""

from __future__ import annotations

import gc
import json
import re
from functools import lru_cache

import numpy as np
import zstandard
from tokenizers import Tokenizer

#: The parts of a tokenizer file for which words are independent of each other.
_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
_SUFFIX = "</w>"
_LETTERS = bytes([*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)])  # Latin-1, lower case
_UPPER = bytes([*range(0x41, 0x5B), *range(0xC0, 0xD7), *range(0xD8, 0xDF)])
_DIGITS = b"0123456789"
_MARKS = b".,;:!?"
#: Line feed, printable ASCII and letters: normalisation changes these to lower case, no more.
_PLAIN = bytes([0x0A, *range(0x20, 0x7F)]) + _LETTERS + _UPPER
_LOWER = bytes(0x20 if c == 0x0A else c + 0x20 if c in _UPPER else c for c in range(256))
#: a: letter or digit, .: mark, #: other, blank.
_KINDS = bytes(ord("a") if c in _LETTERS + _DIGITS else ord(".") if c in _MARKS else c if c == 0x20 else ord("#") for c in range(256))
#: ``_PATTERN`` for plain characters in lower case.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class Cache(dict):
    """Values made on first use; of two generations of ``limit`` entries the older one goes."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def words_are_independent(path: str) -> bool:
    """Has the tokenizer file the normaliser and split pattern that this module knows?"""
    with open(path, encoding="utf-8") as f:
        parts = json.load(f)
    model = parts["model"]
    return (
        (parts["normalizer"], parts["pre_tokenizer"]) == (_NORMALIZER, _PRE_TOKENIZER)
        and not (parts.get("truncation") or parts.get("padding") or parts.get("post_processor"))
        and (model["type"], model["end_of_word_suffix"]) == ("BPE", _SUFFIX)
        and not (model.get("dropout") or model.get("ignore_merges"))
        and all(t["content"].startswith("<|") for t in parts["added_tokens"])
    )


class Encoder:
    """``encode_all(texts)``: the ids of each text; up to ``limit`` words are remembered."""

    def __init__(self, path: str, limit: int = 900_000):
        self._tokenizer = Tokenizer.from_file(path)
        self._by_words = words_are_independent(path)
        self._bare = Tokenizer(self._tokenizer.model)  # the model alone, for words as byte letters
        vocabulary = self._tokenizer.get_vocab()
        self._last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._last[[i for token, i in vocabulary.items() if token.endswith(_SUFFIX)]] = True
        letters = _byte_letters()
        self._letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}
        self._words: dict[str, bytes] = {"": b""}
        self._limit = limit
        self._odd = Cache(self._whole, limit // 10)

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    @staticmethod
    def _split(text: bytes) -> list[str] | None:
        """The words and other pieces of a plain text in lower case; ``None`` for other texts."""
        try:
            raw = text if text.isascii() else text.decode().encode("latin-1")
        except UnicodeError:
            return None
        if b"<|" in raw or raw.translate(None, _PLAIN):
            return None
        raw = raw.translate(_LOWER) + b" "
        kinds = raw.translate(_KINDS)
        if b".. " not in kinds and b"#. " not in kinds:  # marks then follow letters, digits or blanks
            for mark in _MARKS:
                raw = raw.replace(b"%c " % mark, b" %c " % mark)
        return raw.decode("latin-1").split(" ")

    def _learn(self, words: list[str]) -> None:
        """Remembers words that the split pattern leaves whole."""
        if not words:
            return
        letters = " ".join(words).translate(self._letters).split(" ")
        found = self._bare.encode_batch_fast([letters], is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found[0].ids, dtype="<u4")
        ends = (4 * np.flatnonzero(self._last[ids]) + 4).tolist()  # each word's last token, and no other, has the suffix
        raw = ids.tobytes()
        self._words.update(zip(words, [raw[s:e] for s, e in zip([0, *ends], ends)], strict=True))

    def _learn_all(self, pieces: set[str]) -> None:
        if len(self._words) + len(pieces) > self._limit:
            self._words.clear()
            self._words[""] = b""
        single = [p for p in pieces if p.isalpha()]
        self._learn(single)
        if len(single) < len(pieces):
            apart = [(p, _PARTS.findall(p)) for p in pieces if not p.isalpha()]
            self._learn(list({x for _, parts in apart for x in parts}.difference(self._words)))
            for p, parts in apart:
                if len(parts) != 1:
                    self._words[p] = b"".join([self._words[x] for x in parts])

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        split = list(map(self._split, texts))
        known = self._words.get
        found = [pieces and list(map(known, pieces)) for pieces in split]
        open_at = [values and [i for i, v in enumerate(values) if v is None] for values in found]
        self._learn_all({pieces[i] for pieces, at in zip(split, open_at) for i in at or ()})
        out = []
        for text, pieces, values, at in zip(texts, split, found, open_at):
            if pieces is None:
                values = map(self._odd.__getitem__, text.decode("utf-8", "replace").replace("\n", " ").split(" "))
            else:
                for i in at:
                    values[i] = self._words[pieces[i]]
            out.append(b"".join(values))
        return out

    def encode(self, text: bytes) -> bytes:
        """The ids of one text as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0].tobytes()

    def encode_all(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text. No cycles are made here, and collecting them costs a third of the time."""
        if not self._by_words:
            whole = self._tokenizer.encode_batch([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
            return [np.array(e.ids, dtype="<u4") for e in whole]
        was_enabled = gc.isenabled()
        gc.disable()
        try:
            return [np.frombuffer(ids, dtype="<u4") for ids in self._encode(texts)]
        finally:
            if was_enabled:
                gc.enable()

    def vocabulary_size(self) -> int:
        return self._tokenizer.get_vocab_size()


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The worker's encoder of a file: workers are reused, so its cache outlives a task."""
    return Encoder(path)


_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack_ids(ids: np.ndarray) -> bytes:
    """Ids compressed for shuffles and staging: first all lowest bytes, then the next ones."""
    width = 2 if len(ids) == 0 or int(ids.max()) < 1 << 16 else 4
    planes = np.ascontiguousarray(ids.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
    return bytes([width]) + _COMPRESSOR.compress(planes.tobytes())


def unpack_ids(packed: bytes) -> np.ndarray:
    width = packed[0]
    planes = np.frombuffer(_DECOMPRESSOR.decompress(packed[1:]), dtype=np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype("<u4")
