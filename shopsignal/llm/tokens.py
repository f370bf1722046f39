"""Token ids of whole texts, as the ``tokenizers`` library gives them, encoding each distinct unit once.

White space ends every pre-token of the two vocabularies used here, so a
text's ids are the ids of its units (a run without white space with the space
before it, or a run of white space) put together.  Texts repeat their units
often; each worker encodes a unit when it first meets it and keeps the ids in a
bounded cache.  Most units are a word of Latin-1 letters, perhaps with marks
behind it: for the two known kinds of vocabulary the word goes straight to the
library's model, as one pre-token.  All others go through the whole library.
A text that contains the string of a special token is encoded whole, and so is
every text where a vocabulary file's normaliser and pre-tokeniser are not, to
the last setting, those of one of the two known kinds.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

MAX_CACHED_UNITS = 500_000  # in each of two generations; about 200 MB together
MAX_UNIT_CHARS = 256  # longer ones are not kept
# Characters of \s in the vocabularies' own patterns.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
UNIT = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
# White space to str.split(), but not to the vocabularies.
_WIDE_SPACE = re.compile("[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CONTROLS = re.compile("[\x1c-\x1f]")
_LATIN_1 = "\u0100"  # the first character beyond it
# Marks that form one pre-token behind a word: not the apostrophe, which may begin a contraction.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# The normalisers and pre-tokenisers under which a word of Latin-1 letters is itself in lower case (white
# space dropped), or just itself (with the space before it).
_LOWERED = (
    {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
)
_SPACED = (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("\xa1"), ord("\xac") + 1), *range(ord("\xae"), ord("\xff") + 1)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


class UnitEncoder:
    """Encodes batches of texts to little-endian id bytes (``dtype`` says how wide)."""

    def __init__(self, path: str, max_units: int = MAX_CACHED_UNITS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        kind = (spec["normalizer"], spec["pre_tokenizer"])
        self.lowers, self.keeps_space = kind == _LOWERED, kind == _SPACED
        self.letters = dict(enumerate(byte_alphabet()))
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.id_bytes = [i.to_bytes(self.dtype.itemsize, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.plain, self.spaced = _Units(self, "", max_units), _Units(self, " ", max_units)
        self.line_end = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _text(self, text: str) -> bytes:
        if not (self.lowers or self.keeps_space) or any(s in text for s in self.special):
            return self.whole(text)
        if self.lowers and not _CONTROLS.search(text):  # white space is dropped: words alone are units
            return b"".join(map(self.plain.__getitem__, text.split()))
        plain, spaced = self.plain.__getitem__, self.spaced.__getitem__
        if _single_spaced(text):
            lines = []
            for line in text.split("\n"):
                first, *rest = line.split(" ")
                lines.append(plain(first) + b"".join(map(spaced, rest)))
            return self.line_end.join(lines)
        return b"".join([spaced(u[1:]) if u[0] == " " else plain(u) for u in UNIT.findall(text)])

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self._text(t) for t in texts]


class _Units(dict):
    """Ids by unit (given without the space that stands before it, if one does), encoded when first asked for.

    There are two generations of at most ``max_units``: what is still used comes along into the next.
    """

    def __init__(self, encoder: UnitEncoder, space: str, max_units: int):
        self.whole, self.space, self.max_units = encoder.whole, space, max_units
        self.lowers = encoder.lowers
        self.model, self.id_bytes, self.letters = encoder.tokenizer.model.tokenize, encoder.id_bytes, encoder.letters
        self.before = self.letters[ord(" ")] if space and encoder.keeps_space else ""
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        ids = self.older.get(unit)
        if ids is None:
            ids = self._encode(unit)
        if len(unit) > MAX_UNIT_CHARS:
            return ids
        if len(self) >= self.max_units:
            self.older = dict(self)
            self.clear()
        self[unit] = ids
        return ids

    def _encode(self, unit: str) -> bytes:
        if not unit.isalpha():
            word = unit.rstrip(_MARKS)
            if not word.isalpha():
                return self.whole(self.space + unit)
            marks = unit[len(word):]
            behind = self.marks.get(marks)
            if behind is None:
                if len(self.marks) > 10_000:
                    self.marks.clear()
                behind = self.marks[marks] = self.whole(marks)
            return self[word] + behind
        ascii_only = unit.isascii()
        if not ascii_only and max(unit) >= _LATIN_1:
            return self.whole(self.space + unit)
        if self.lowers and (small := unit.lower()) != unit:
            return self[small]
        word = unit if ascii_only else unit.encode().decode("latin-1").translate(self.letters)
        id_bytes = self.id_bytes
        return b"".join([id_bytes[t.id] for t in self.model(self.before + word)])


def _single_spaced(text: str) -> bool:
    """Whether single spaces and single line ends, never side by side, are all the white space there is."""
    if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] == " " or text[-1:] == " ":
        return False
    if "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text:
        return False
    if text.isascii():
        return True
    if "\x85" in text or "\xa0" in text:
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:  # beyond Latin-1 there is more white space
        return not _WIDE_SPACE.search(text)
    return True


_ENCODERS: dict[str, UnitEncoder] = {}


def encoder(path: str) -> UnitEncoder:
    """This worker's encoder for a vocabulary file (kept from task to task)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


def in_chunks(texts: list[str], max_chars: int = 2_000_000):
    """Index ranges of ``texts`` of at most ``max_chars`` characters (or one text)."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if i > begin and size + len(t) > max_chars:
            yield begin, i
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
