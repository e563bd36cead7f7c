"""Ids of the tokenizers library for whole texts, at the speed of a word table.

Both public BPE files treat the stretches between blanks independently of each other, and
the words within a stretch too, so a text's ids are those of its words, one after another.
Each worker keeps the stretches and words it has met; the library's model is asked for new
words only. Texts for which the cut could matter (a special token's text, unusual blanks)
go to the library whole, as does every text of a tokenizer that is not of these two forms.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from array import array
from collections.abc import Callable, Sequence
from pathlib import Path

import numpy as np
import regex

CACHED = 150_000
_HELD: dict[int, "Encoder"] = {}


def tokenizer_json(path: str) -> str:
    """The tokenizer file's text, read on the driver and sent with the tasks (a few MB)."""
    return Path(path).read_text(encoding="utf-8")


def vocabulary_size(source: str) -> int:
    config = json.loads(source)
    added = [t["id"] for t in config.get("added_tokens", [])]
    return max([*config["model"]["vocab"].values(), *added]) + 1


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def lower_by_letter(text: str) -> str:
    """Lower case of each letter by itself: a final sigma is not special."""
    return (text.replace("\u03a3", "\u03c3") if not text.isascii() else text).lower()


# Fixed value: the word pattern of byte-level BPE files that name none.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Runs of three blanks, and of two at the end, belong together; Python counts some more
# characters as blanks than the tokenizer does.
_SPACED_WHOLE = re.compile(r"\s\s(?:\s|\Z)|[\x1c-\x1f]")
_ODD = ("  ", "\n\n", " \n", "\n ", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x1d", "\x1e", "\x1f")
_ODD_BLANK = re.compile(r"[^\S\x00-\x7f]")
_STOPS = frozenset(",.;:!?")
_BLANK_WHOLE = re.compile(r"[\x1c-\x1f]")


class _Table(dict):
    """Values by key, made when first asked for.

    A table that has grown too large becomes the old one; what is asked for again comes
    back from it, the rest goes with the next change.
    """

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def trim(self) -> None:
        if len(self) > CACHED:
            self.old = dict(self)
            self.clear()


class Encoder:
    def __init__(self, source: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        config = json.loads(source)
        self.marks = [t["content"] for t in config.get("added_tokens", [])]
        self.letters = byte_letters()
        self.cut, self.uncut = None, None
        self.words, self.stretches = _Table(self._word), _Table(self._stretch)
        self._choose(config)

    def _choose(self, config: dict) -> None:
        """How to cut texts of this tokenizer; cut stays None if it is of another form."""
        normalizer, pre = config.get("normalizer"), config.get("pre_tokenizer") or {}
        if config["model"]["type"] != "BPE" or config["model"].get("dropout") or config.get("post_processor"):
            return
        steps = [x["type"] for x in pre.get("pretokenizers", [])]
        changes = [x["type"] for x in (normalizer or {}).get("normalizers", [])]
        if normalizer is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
            self.cut, self.uncut = self._by_spaces, _SPACED_WHOLE
            self.pattern = regex.compile(BYTE_LEVEL_PATTERN)
            self.line_end = self._word("\n")
            self.stretches = _Table(self._behind_blank)
        elif steps == ["Split", "ByteLevel"] and changes == ["NFC", "Replace", "Lowercase"]:
            split, letters = pre["pretokenizers"]
            pattern = split["pattern"].get("Regex", "")
            if split["behavior"] == "Removed" and split["invert"] and "[^\\s" in pattern and not letters["use_regex"]:
                self.cut, self.uncut = self._by_blanks, _BLANK_WHOLE
                self.pattern = regex.compile(pattern)

    @classmethod
    def held_by_worker(cls, source: str) -> "Encoder":
        key = hash(source)
        if key not in _HELD:
            _HELD[key] = cls(source)
            # The tables hold no cycles, so looking for some after every 2,000 objects is in vain.
            gc.set_threshold(200_000, 50, 100)
        return _HELD[key]

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():
            spelled = word.replace(" ", self.letters[32])
        else:
            spelled = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def _by_blanks(self, text: str) -> bytes:
        folded = text.lower() if text.isascii() else lower_by_letter(unicodedata.normalize("NFC", text))
        return b"".join(map(self.stretches.__getitem__, folded.split()))

    def _by_spaces(self, text: str) -> bytes:
        """A space goes with the word behind it, a line end stands alone.

        Each stretch is looked up without its space, or with the line end before it; the
        text begins as if a line end came first.
        """
        cut = ("\n" + text).replace("\n", " \n").split(" ")
        del cut[0]
        return b"".join(map(self.stretches.__getitem__, cut))[len(self.line_end) :]

    def _behind_blank(self, stretch: str) -> bytes:
        if stretch[:1] == "\n":
            return self.line_end + self._stretch(stretch[1:])
        if stretch.isalpha():
            return self._word(" " + stretch)
        if stretch[-1:] in _STOPS and stretch[:-1].isalpha():
            return self.stretches[stretch[:-1]] + self.words[stretch[-1]]
        return self._stretch(" " + stretch)

    def _stretch(self, stretch: str) -> bytes:
        if not stretch:
            return b""
        words = self.words
        if stretch.isalpha():
            return self._word(stretch)
        if stretch[-1:] in _STOPS and stretch[:-1].isalpha():
            return words[stretch[:-1]] + words[stretch[-1]]
        return b"".join([words[w] for w in self.pattern.findall(stretch)])

    def _whole(self, text: str) -> bool:
        if self.cut is None or any(m in text for m in self.marks):
            return True
        # Substrings are found much faster than patterns; most texts have none of these.
        odd = any(x in text for x in _ODD) or not text.isascii() and _ODD_BLANK.search(text)
        return bool(odd and self.uncut.search(text))

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers; null as empty."""
        self.words.trim()
        self.stretches.trim()
        out = []
        for text in texts:
            if text and self._whole(text):
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                out.append(np.asarray(ids, "<u4").tobytes())
            else:
                out.append(self.cut(text) if text else b"")
        return out
