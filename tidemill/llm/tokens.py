"""Token ids of whole texts by a public tokenizer file, with a cache of white-space separated chunks."""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.broadcast import Broadcast
from pyspark.sql import SparkSession

from tidemill.llm.common import Once

WORD_BPE = "word_bpe_49k.json"
END_OF_TEXT = 49407

# The file's normaliser and word pattern, as the fast path below assumes them (fixed values).
_NORMALISERS = ["NFC", "Replace", "Lowercase"]
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Chunks that the fast path cuts: letters that composition leaves alone and that have one lower-case letter each, then marks
# that no contraction starts with. Everything else goes through the tokenizer as it stands.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
_ODD_SPACE = re.compile("[\x1c-\x1f]")
_END = "\x00"


def default_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _word_ranks(vocab: dict[str, int], suffix: str) -> dict[bytes, int]:
    """The vocabulary as bytes; the end of a word is the byte 0."""
    letters, ranks = _byte_letters(), {}
    for token, i in vocab.items():
        body = token[: -len(suffix)] if token.endswith(suffix) else token
        if all(c in letters for c in body) and not token.startswith("<|"):
            ranks[bytes(letters[c] for c in body) + b"\0" * (body != token)] = i
    return ranks


class WordTokenizer:
    """Ids as little-endian unsigned 32-bit bytes.

    Chunks between white space are encoded once and kept, at most ``limit`` of them. If the file is a BPE with word ends over
    lower-cased words, unseen plain words are encoded by rank merging, many in one call; the tests hold this against the
    tokenizer itself. Special tokens' strings in a text are ordinary text.
    """

    def __init__(self, path: str, limit: int = 100_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.limit, self.cache, self.fast = limit, {}, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if self._chunks_stand_alone(spec):
            import tiktoken

            suffix = spec["model"]["end_of_word_suffix"]
            ranks = _word_ranks(spec["model"]["vocab"], suffix)
            self.fast = tiktoken.Encoding("words", pat_str=f"[^{_END}]+{_END}", mergeable_ranks=ranks, special_tokens={})
            self.ends = np.zeros(max(spec["model"]["vocab"].values()) + 1, bool)
            self.ends[[i for token, i in spec["model"]["vocab"].items() if token.endswith(suffix)]] = True

    @staticmethod
    def _chunks_stand_alone(spec: dict) -> bool:
        try:
            kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
            pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
            return kinds == _NORMALISERS and pattern == _WORDS and bool(spec["model"]["end_of_word_suffix"])
        except (KeyError, TypeError, IndexError):
            return False

    def _slow(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[str]) -> None:
        """Put the ids of unseen chunks into the cache."""
        rest, words, pieces, counts = [], [], [], []
        for chunk in chunks:
            if m := _PLAIN(chunk):
                word, marks = m.groups()
                words.append(chunk)
                pieces.append(word.lower())
                counts.append(1)
                if marks:
                    pieces.append(marks)
                    counts[-1] = 2
            else:
                rest.append(chunk)
        if words:
            ids = np.array(self.fast.encode_ordinary(_END.join(pieces) + _END), "<u4")
            last = np.flatnonzero(self.ends[ids])[np.cumsum(counts) - 1] + 1
            raw, begin = ids.tobytes(), 0
            for word, end in zip(words, (last * 4).tolist(), strict=True):
                self.cache[word] = raw[begin:end]
                begin = end
        if rest:
            self.cache.update(zip(rest, self._slow(rest), strict=True))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.fast is None or _ODD_SPACE.search(text):
            return self._slow([text])[0]
        chunks = text.split()
        if len(self.cache) > self.limit:
            self.cache.clear()
        known = self.cache
        try:
            return b"".join(map(known.__getitem__, chunks))
        except KeyError:
            self._learn([c for c in dict.fromkeys(chunks) if c not in known])
            return b"".join(map(known.__getitem__, chunks))


def tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """A call of its value inside a task gives the file's tokenizer: one for each Python worker, as long as its tasks use it."""
    return spark.sparkContext.broadcast(Once(WordTokenizer, path))
