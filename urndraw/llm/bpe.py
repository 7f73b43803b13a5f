"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

In a BPE encoding any two neighbouring tokens are compatible: encoding just the two of them together gives them back.
A prefix of a word therefore has one possible last token: the one that ends there and is compatible with the
last token of the prefix in front of it. An automaton over all tokens lists the tokens that end at each place, the table
of last tokens is filled from left to right, and following it back from the end gives the ids.

Defined cases: null text counts as empty and gives no ids; special tokens written in a text become their ids, as the
library does by default; rows that repeat are encoded each on its own; null ids are kept.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urndraw.llm.common import text_or_empty

#: Stands for the end of a word inside the automaton; no byte letter of a vocabulary uses it.
END = ""
#: Distinct words whose ids a Python worker keeps; beyond it the worker starts afresh.
WORDS = 600_000
#: Pairs of tokens whose compatibility a Python worker keeps, likewise.
PAIRS = 1 << 20
#: Below this character nothing but the case changes in normalisation, and the library's classes are Python's.
PLAIN_BELOW = "\u0180"


class PrefixBpe:
    """Encodes one pre-tokenised word at a time with the vocabulary and merges of a ``tokenizers`` BPE model."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str | None) -> None:
        import ahocorasick

        def marked(token: str) -> str:
            return token.removesuffix(suffix) + END if suffix and token.endswith(suffix) else token

        self.suffix = suffix
        self.ids = {marked(token): i for token, i in vocabulary.items()}
        self.rank: dict[tuple[str, str], int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        for rank, pair in enumerate(merges):
            left, right = map(marked, pair if not isinstance(pair, str) else pair.split(" "))
            if left + right in self.parts:
                raise ValueError(f"two merges make {left + right!r}: a token needs one way to arise")
            self.rank[left, right] = rank
            self.parts[left + right] = (left, right)
        self.tokens = sorted(filter(self._reachable, self.ids))
        self.automaton = ahocorasick.Automaton()
        for i, token in enumerate(self.tokens):
            self.automaton.add_word(token, (i, len(token)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}

    def _edge(self, token: str, side: int) -> list[tuple[str, float, float]]:
        """The symbols that stand at one end of ``token`` while it is merged: (symbol, merge that made it, merge that ends it)."""
        out, ended = [], math.inf
        while True:
            parts = self.parts.get(token)
            made = self.rank[parts] if parts else -1
            out.append((token, made, ended))
            if not parts:
                return out
            token, ended = parts[side], made

    def _crosses(self, left: str, right: str, before: float) -> bool:
        """Whether a merge of lower rank than ``before`` joins ``left`` and ``right`` over their border."""
        for a, made, ended in self._edge(left, 1):
            for b, made_b, ended_b in self._edge(right, 0):
                rank = self.rank.get((a, b))
                # of equal merges the one further left comes first: that inside ``left`` before the border's, and
                # the border's before that inside ``right``
                if rank is not None and rank < before and made < rank < ended and made_b < rank <= ended_b:
                    return True
        return False

    def _reachable(self, token: str) -> bool:
        """Whether encoding the token's own text gives the token."""
        while True:
            parts = self.parts.get(token)
            if parts is None:
                return len(token.removesuffix(END)) == 1
            if self._crosses(*parts, self.rank[parts]):
                return False
            if not self._reachable(parts[0]):
                return False
            token = parts[1]

    def encode(self, word: str) -> list[int]:
        """Ids of a word in byte letters."""
        text = word + END if self.suffix else word
        inner = len(text) - 1 if self.suffix else -1  # the last letter and its mark are one symbol
        last = [-1] * (len(text) + 1)
        tokens, pairs, width = self.tokens, self.pairs, len(self.tokens)
        if len(pairs) > PAIRS:
            pairs.clear()
        for at, (token, length) in self.automaton.iter(text):
            stop = at + 1
            if last[stop] >= 0 or stop == inner:
                continue
            start = stop - length
            if start:
                before = last[start]
                if before < 0:
                    continue
                key = before * width + token
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = not self._crosses(tokens[before], tokens[token], math.inf)
                if not fits:
                    continue
            last[stop] = token
        ids, at = [], len(text)
        while at:
            token = tokens[last[at]]
            if last[at] < 0:
                raise ValueError(f"no tokens spell {word!r}")
            ids.append(self.ids[token])
            at -= len(token)
        return ids[::-1]


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else the next one from 256 up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class TextCodec:
    """Whole texts to ids and back, as the ``tokenizers`` library encodes with the same file and decodes.

    The file's own normaliser and split pattern make the words; each distinct word is encoded once. Texts with letters
    beyond ``PLAIN_BELOW`` are normalised and split by the library itself.
    """

    def __init__(self, path: str, limit: int = WORDS) -> None:
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        self.bpe = PrefixBpe(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.split = regex.compile(described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.pieces = np.empty(max([*model["vocab"].values(), *self.special.values()]) + 1, object)
        for token, i in (*model["vocab"].items(), *self.special.items()):
            self.pieces[i] = token
        self.letters = byte_letters()
        self.limit = limit
        self.words: dict[str, tuple[bytes, str]] = {}

    def _word(self, letters: str) -> tuple[bytes, str]:
        """Ids, and the tokens' texts with a space in front of each."""
        ids = self.bpe.encode(letters)
        return np.array(ids, np.uint32).tobytes(), "".join([" " + self.pieces[i] for i in ids])

    def _part(self, text: str) -> list[tuple[bytes, str]]:
        if text in self.special:
            return [(np.array([self.special[text]], np.uint32).tobytes(), " " + text)]
        if max(text, default="") < PLAIN_BELOW:
            words, known = self.split(text.lower()), self.words
            new = set(words).difference(known)
            if len(known) + len(new) > self.limit:
                known.clear()
                new = set(words)
            for word in new:
                known[word] = self._word("".join([self.letters[b] for b in word.encode()]))
            return list(map(known.__getitem__, words))
        return [self._word(w) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))]

    def encode(self, text: str) -> tuple[bytes, str]:
        """(little-endian unsigned 32-bit ids, decoded text)."""
        found = [f for part in self.specials.split(text) if part for f in self._part(part)]
        # without a decoder the library puts one space between the tokens as they stand in the vocabulary
        return b"".join([f[0] for f in found]), "".join([f[1] for f in found])[1:]

    def decode(self, ids: bytes) -> str:
        return " ".join(self.pieces[np.frombuffer(ids, "<u4")])


_CODECS: dict[str, TextCodec] = {}


def codec_of(path: str) -> TextCodec:
    """The one codec of ``path`` in this Python worker."""
    if path not in _CODECS:
        _CODECS[path] = TextCodec(path)
    return _CODECS[path]


def round_trip(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, ids, decoded): little-endian unsigned 32-bit ids of each whole text, and what they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, decoded = zip(*map(codec.encode, part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded string")
