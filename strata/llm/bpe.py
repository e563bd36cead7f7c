"""Byte-pair encoding without applying merges, and decoding by an offset table.

A token sequence is what merging gives exactly if each token is and each neighbouring pair
is compatible: no merge across their border would have come first. An Aho-Corasick
automaton lists the tokens at each position; the encoder takes the longest whose pair with
the token before is compatible, tries shorter ones else, and goes back when none is left,
never trying a dead position twice. So the time is linear in the text. Decoding gathers the
tokens' bytes from one blob by an offset table.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import words as W
from strata.llm.ship import ship
from strata.llm.tokens import byte_letters, lower_by_letter, tokenizer_json

CACHED = 400_000
_NEVER = 1 << 60
_HELD: dict[int, "Bpe"] = {}
_ODD_BLANK = re.compile(r"[\x1c-\x1f]")
_STRETCH = re.compile(r"[\S\x1c-\x1f]+")


class Bpe:
    """A BPE file of the tokenizers library whose words end in a suffix and whose blanks go.

    Only the form at hand is taken: NFC, one blank for many, lower case, a pattern that
    keeps words, then byte letters. Anything else raises ValueError.
    """

    def __init__(self, source: str):
        config = json.loads(source)
        model, pre = config["model"], config["pre_tokenizer"]
        changes = [x["type"] for x in (config["normalizer"] or {}).get("normalizers", [])]
        steps = [x["type"] for x in pre.get("pretokenizers", [])]
        if changes != ["NFC", "Replace", "Lowercase"] or steps != ["Split", "ByteLevel"] or model["type"] != "BPE":
            raise ValueError("not a BPE file of the supported form")
        if model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges") or not model["end_of_word_suffix"]:
            raise ValueError("not a BPE file of the supported form")
        self.pattern = regex.compile(pre["pretokenizers"][0]["pattern"]["Regex"])
        self.letters = {chr(b): letter for b, letter in byte_letters().items()}
        suffix = model["end_of_word_suffix"]
        # A word's last letter with the suffix is one symbol; it gets a letter of its own.
        self.last = {letter: chr(0xE000 + i) for i, letter in enumerate(byte_letters().values())}

        def spelled(token: str) -> str:
            body = token.removesuffix(suffix)
            return body if body == token or not body else body[:-1] + self.last[body[-1]]

        vocab = {spelled(t): i for t, i in model["vocab"].items()}
        self.merges: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for r, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made = vocab.get(spelled(left + right))
            pair = (vocab[spelled(left)], vocab[spelled(right)])
            if made in self.rank or made is None or max(self.rank.get(x, -1) for x in pair) > r:
                raise ValueError("merges are not in the order in which they build tokens")
            self.merges[pair], self.parts[made], self.rank[made] = r, pair, r
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            if len(token) == 1 or i in self.rank:
                self.automaton.add_word(token, (len(token), i))
        self.automaton.make_automaton()
        self.length = {i: len(t) for t, i in vocab.items()}
        self.fits: dict[tuple[int, int], bool] = {}
        self.words: dict[str, list[int]] = {}
        self.held: dict[str, bytes] = {}
        self.added = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        # The file names no decoder: tokens as written, with a blank between.
        if config["decoder"] is not None:
            raise ValueError("not a BPE file of the supported form")
        spelling = {i: t for t, i in (model["vocab"] | self.added).items()}
        pieces = [(spelling[i] + " ").encode() if i in spelling else b"" for i in range(max(spelling) + 1)]
        self.blob = np.frombuffer(b"".join(pieces), np.uint8)
        self.offsets = np.cumsum([0, *map(len, pieces)])

    @classmethod
    def held_by_worker(cls, source: str) -> "Bpe":
        key = hash(source)
        if key not in _HELD:
            _HELD[key] = cls(source)
        return _HELD[key]

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The symbols that stand at one edge of a token while it is built, each with the
        rank of the merge that ends its time there."""
        out, until = [], _NEVER
        while True:
            out.append((token, until))
            if token not in self.parts:
                return out
            token, until = self.parts[token][side], self.rank[token]

    def compatible(self, left: int, right: int) -> bool:
        """No merge takes the border between two tokens first. Of two equal merges the one
        further left comes first, so a tie goes to the left token's own merge."""
        pair = (left, right)
        known = self.fits.get(pair)
        if known is None:
            ends = self._edge(right, 0)
            known = not any(
                (r := self.merges.get((x, y), _NEVER)) < until_x and r <= until_y and r < _NEVER
                for x, until_x in self._edge(left, 1)
                for y, until_y in ends
            )
            if len(self.fits) > CACHED:
                self.fits.clear()
            self.fits[pair] = known
        return known

    def _tokens(self, word: str) -> list[int]:
        """Ids of one spelled word."""
        n = len(word)
        at: list[list[int]] = [[] for _ in range(n)]
        for end, (length, token) in self.automaton.iter(word):
            at[end - length + 1].append(token)  # shorter ones end, and so come, first
        out: list[int] = []
        tried = [len(x) - 1 for x in at]
        dead = [False] * (n + 1)
        place, length = 0, self.length
        while place < n:
            options, i = at[place], tried[place]
            while i >= 0:
                token = options[i]
                if not dead[place + length[token]] and (not out or self.compatible(out[-1], token)):
                    break
                i -= 1
            if i >= 0:
                tried[place] = i - 1
                out.append(token)
                place += length[token]
                if place < n:
                    tried[place] = len(at[place]) - 1
            else:
                if not out:
                    raise ValueError("a symbol is not in the vocabulary")
                dead[place] = True
                place -= length[out.pop()]
        return out

    def _word(self, word: str) -> list[int]:
        ids = self.words.get(word)
        if ids is None:
            letters = self.letters
            spelled = "".join([letters[c] for c in word.encode().decode("latin-1")])
            ids = self._tokens(spelled[:-1] + self.last[spelled[-1]])
            if len(self.words) > CACHED:
                self.words.clear()
            self.words[word] = ids
        return ids

    def _stretch(self, stretch: str) -> bytes:
        """Ids of text without blanks. Lower case letter by letter: no final sigma."""
        if not stretch.isascii():
            stretch = unicodedata.normalize("NFC", stretch)
        words = self.pattern.findall(lower_by_letter(stretch))
        return np.array([i for w in words for i in self._word(w)], "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        stretches = _STRETCH.findall(text) if _ODD_BLANK.search(text) else text.split()
        held = self.held
        if len(held) > CACHED:
            held.clear()
        for new in set(stretches).difference(held):
            held[new] = self._stretch(new)
        return b"".join([held[s] for s in stretches])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; special tokens' texts become their ids."""
        if self.added and self.marks.search(text):
            bits = self.marks.split(text)
            ids = b"".join(
                np.array([self.added[x]], "<u4").tobytes() if i % 2 else self._plain(x) for i, x in enumerate(bits)
            )
        else:
            ids = self._plain(text)
        return np.frombuffer(ids, "<u4")

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes and their bounds of several documents' ids, given with their bounds.

        Tokens come with a blank behind; the last of a document is dropped.
        """
        firsts = self.offsets[ids]
        lengths = self.offsets[ids.astype(np.int64) + 1] - firsts
        ends = np.cumsum(lengths)
        byte_bounds = np.r_[0, ends][bounds]
        places = np.arange(int(byte_bounds[-1])) + np.repeat(firsts - (ends - lengths), lengths)
        out = self.blob[places]
        full = np.diff(byte_bounds) > 0
        keep = np.ones(len(out), bool)
        keep[byte_bounds[1:][full] - 1] = False
        return out[keep], byte_bounds - np.r_[0, np.cumsum(full)]


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row: the ids of the whole text, and them decoded.

    Null texts count as empty: no ids, empty text. Rows with equal or null doc_ids are
    encoded each for itself. Columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    source = spark.sparkContext.broadcast(tokenizer_json(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.held_by_worker(source.value)
        for batch in batches:
            text, doc_ids = batch.column("text"), batch.column("doc_id")
            for a, b in W.parts(W.utf8(text)[1]):
                found = [bpe.encode(t or "") for t in text.slice(a, b - a).to_pylist()]
                bounds = np.cumsum([0, *map(len, found)])
                ids = np.concatenate(found) if found else np.zeros(0, np.uint32)
                data, ends = bpe.decode(ids, bounds)
                decoded = pa.Array.from_buffers(
                    pa.string(), b - a, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
                )
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([doc_ids.slice(a, b - a), lists, decoded], ["doc_id", "ids", "decoded"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return read.mapInArrow(run, "doc_id long, ids array<int>, decoded string")
