"""Token counts with the whole-token shortcut.

Offline, on the driver, each vocabulary string is encoded alone by the merges; those that come out as one token need no
merging later. In a text, a pre-token among them counts 1 and only the rest is merged. Blanks end pre-tokens, so the
count of a blank-free piece depends on the piece alone and is remembered by the worker that met it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# For pieces of Latin-1 letters, digits and signs only, normal form and pre-tokens need no library call: such text is
# in normal form C, lower() is the plain mapping, and the classes of letters and numbers are these.
_PLAIN = re.compile(r"[\x21-\x7e\xa1-\xac\xae-\xff]+")
_LETTER, _NUMBER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_LETTER}{_NUMBER}]+")
_SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies use for each byte: itself if it prints, else one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(prints) else chr(next(others)) for b in range(256)]


_BYTE_LETTERS = _byte_letters()

#: Pieces remembered by a worker, and the longest of them; beyond that a piece is counted anew.
REMEMBERED, LONGEST = 400_000, 64


def whole_tokens(tokenizer: Tokenizer, suffix: str = "</w>") -> frozenset[str]:
    """Pre-tokens that are one token when encoded alone, proven by encoding each vocabulary string."""
    merge = tokenizer.model.tokenize
    words = (v.removesuffix(suffix) for v in tokenizer.get_vocab(with_added_tokens=False) if v.endswith(suffix))
    return frozenset(w for w in words if w and len(merge(w)) == 1)


class PieceCounter:
    """Counts tokens of whole texts: special strings first, then normal form, pre-tokens, shortcut or merges."""

    def __init__(self, definition: str, whole: frozenset[str]):
        self.tokenizer = Tokenizer.from_str(definition)
        self.whole = whole
        special = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.known: dict[bytes, int] = {}
        rules = json.loads(definition)
        self.plain = (
            _SPLIT in rules["pre_tokenizer"].get("pretokenizers", [])
            and {"type": "Lowercase"} in rules["normalizer"].get("normalizers", [])
            and all(t.content.startswith("<|") for t in self.tokenizer.get_added_tokens_decoder().values())
        )

    def _piece(self, text: str) -> int:
        if self.plain and _PLAIN.fullmatch(text) and "<|" not in text:
            n, merge, whole = 0, self.tokenizer.model.tokenize, self.whole
            for word in _WORDS.findall(text.lower()):
                word = word if word.isascii() else "".join([_BYTE_LETTERS[b] for b in word.encode()])
                n += 1 if word in whole else len(merge(word))
            return n
        parts = self.special.split(text) if self.special else [text]
        n = len(parts) // 2  # split with a group: every second part is a special string
        merge, whole = self.tokenizer.model.tokenize, self.whole
        for part in parts[::2]:
            if part:
                plain = self.tokenizer.normalizer.normalize_str(part)
                for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(plain):
                    n += 1 if word in whole else len(merge(word))
        return n

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        known, n = self.known, 0
        for piece in text.encode().split():
            got = known.get(piece)
            if got is None:
                got = self._piece(piece.decode())
                if len(piece) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = got
            n += got
        return n


_COUNTERS: dict[int, PieceCounter] = {}


def token_counter(spark: SparkSession, tokenizer_path: str):
    """A Spark function text -> number of tokens, for a JSON tokenizer whose pre-tokens end at blanks.

    The definition and the proven words are broadcast; their size is that of the vocabulary, whatever the input.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    shared = spark.sparkContext.broadcast((definition, whole_tokens(Tokenizer.from_str(definition))))

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _COUNTERS.get(hash(shared.value[0]))
        if counter is None:
            counter = _COUNTERS[hash(shared.value[0])] = PieceCounter(*shared.value)
        for batch in texts:
            yield pd.Series([counter.count(t) for t in batch], dtype="int64")

    return count


def count_tokens(docs: DataFrame, tokenizer_path: str | None = None, text: str = "text", limit: int = 2048) -> DataFrame:
    """All columns of docs with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    Null and empty texts count 0. Texts are whole; special strings inside them count as their special token. Columns of docs with
    these names are replaced; each row is counted by itself, so repeated rows and empty tables are nothing special.
    """
    counter = token_counter(docs.sparkSession, tokenizer_path or public_tokenizers.path("word_bpe_49k.json"))
    whole: Column = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.withColumn("n_bytes", F.octet_length(whole).cast("long"))
        .withColumn("n_tokens", counter(F.col(text)))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
