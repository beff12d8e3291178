"""Byte-pair encoding and decoding with a published vocabulary file (never trained here).

Encoding of one word: its symbols form a doubly linked list, every mergeable neighbour pair is an entry of a
priority queue keyed by (merge rank, position), the best entry is merged, the two new neighbour pairs are pushed,
and entries whose symbols have changed meanwhile are skipped as stale.  Decoding concatenates vocabulary strings.
Around the merges, the file's own normaliser, splitter, special tokens and decoder are followed, so ids and
decoded text equal those of the ``tokenizers`` library.

Spark side: one ``mapInArrow`` over the scan, no shuffle.  A worker keeps the merge table once and a cache of
white-space-separated chunks with a fixed number of entries, so memory does not grow with the vocabulary of the
corpus; a lost executor only repeats its own input partitions.

Defined results: a null text is an empty one (no ids, decoded text empty); texts are never cut; repeated rows are
encoded each; null ids of rows pass through; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from riskline.llm.common import stream

#: Bits of a symbol id inside a pair key; chunks kept by a worker; longest chunk kept (characters); words count as chunks.
ID_BITS = 20
CACHE_CHUNKS = 500_000
CACHE_CHARS = 64
#: Text inside these ranges is split and lower-cased alike by every Unicode version in use (without the separators
#: U+001C..1F, which Python alone takes for white space); other text goes through the library's own splitter.
UNUSUAL = regex.compile("[^\\x00-\\x1b\\x20-\\u052f\\u1e00-\\u1fff\\u2010-\\u2027\\u20a0-\\u20bf\\u3041-\\u3096\\u30a1-\\u30fa\\u4e00-\\u9fa5\\uac00-\\ud7a3]")
#: Fixed value: the word pattern of byte-level vocabularies.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


class Bpe:
    """One vocabulary file."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in [*self.vocab.items(), *self.special.items()]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.normalise = {n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])}
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        # a splitter that drops white space lets a text be cut at it first
        self.by_space = steps[0]["type"] == "Split"
        self.words = regex.compile(steps[0]["pattern"]["Regex"] if self.by_space else BYTE_PATTERN)
        self.byte_decoder = (spec["decoder"] or {}).get("type") == "ByteLevel"
        self.symbols = byte_symbols()
        self.byte_of = {s: b for b, s in enumerate(self.symbols)}
        #: pair key -> rank; by rank: left id, right id, merged id
        self.rank: dict[int, int] = {}
        self.merge: list[tuple[int, int, int]] = []
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            left, right = self.vocab[a], self.vocab[b]
            self.rank[left << ID_BITS | right] = r
            self.merge.append((left, right, self.vocab[a + b]))
        self.inner = [self.vocab[s] for s in self.symbols]
        self.final = [self.vocab[s + self.suffix] for s in self.symbols]
        self.cache: dict[str, tuple[bytes, str]] = {}
        self.library = None

    # -- one word -------------------------------------------------------------------------------------------
    def encode_word(self, word: str) -> list[int]:
        raw = word.encode("utf-8")
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.final[raw[-1]]
        n, rank, merge = len(ids), self.rank, self.merge
        if n == 1:
            return ids
        nxt, prv = [*range(1, n), -1], [*range(-1, n - 1)]
        # an entry is rank and position in one integer: the smallest is the best pair, leftmost first
        queue = [r << 40 | i for i in range(n - 1) if (r := rank.get(ids[i] << ID_BITS | ids[i + 1])) is not None]
        heapify(queue)
        while queue:
            top = heappop(queue)
            left, right, merged = merge[top >> 40]
            i = top & 0xFFFFFFFFFF
            j = nxt[i]
            if j < 0 or ids[i] != left or ids[j] != right:
                continue  # stale: a symbol of this pair has been merged away
            ids[i], ids[j] = merged, -1
            k = nxt[i] = nxt[j]
            if k >= 0:
                prv[k] = i
                if (r := rank.get(merged << ID_BITS | ids[k])) is not None:
                    heappush(queue, r << 40 | i)
            h = prv[i]
            if h >= 0 and (r := rank.get(ids[h] << ID_BITS | merged)) is not None:
                heappush(queue, r << 40 | h)
        return [x for x in ids if x >= 0]

    # -- whole texts ----------------------------------------------------------------------------------------
    def _keep(self, chunk: str, made: tuple[bytes, str]) -> tuple[bytes, str]:
        if len(chunk) <= CACHE_CHARS:
            if len(self.cache) >= CACHE_CHUNKS:
                self.cache.clear()
            self.cache[chunk] = made
        return made

    def _word(self, word: str) -> tuple[bytes, str]:
        ids = self.encode_word(word)
        return self._keep(word, (array("i", ids).tobytes(), " ".join([self.strings[i] for i in ids])))

    def _made(self, words: list[str]) -> tuple[bytes, str]:
        parts = [self.cache.get(w) or self._word(w) for w in words]
        return b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts])

    def _chunk(self, chunk: str) -> tuple[bytes, str]:
        words = self.words.findall(chunk)
        return self._word(chunk) if words == [chunk] else self._keep(chunk, self._made(words))

    def _library_words(self, text: str) -> list[str]:
        """The words of unusual text, split by the library."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        norm, split = self.library.normalizer, self.library.pre_tokenizer
        found = split.pre_tokenize_str(norm.normalize_str(text) if norm else text)
        return [bytes(self.byte_of[c] for c in w).decode("utf-8") for w, _ in found]

    def _chunks(self, text: str) -> list[str]:
        """Normalised text cut where no word can continue."""
        if "NFC" in self.normalise:
            text = unicodedata.normalize("NFC", text)
        if "Lowercase" in self.normalise:
            text = text.replace("Σ", "σ").lower()  # letter by letter: no final sigma
        return text.split() if self.by_space else self.words.findall(text)

    def _parts(self, text: str) -> list[tuple[bytes, str]]:
        parts, cache = [], self.cache
        for seg in self.special_split.split(text) if self.special_split else [text]:
            if seg in self.special:
                parts.append((np.array([self.special[seg]], "<i4").tobytes(), seg))
            elif UNUSUAL.search(seg):
                parts.append(self._made(self._library_words(seg)))
            else:
                parts += [cache.get(c) or self._chunk(c) for c in self._chunks(seg)]
        return parts

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(b"".join([p[0] for p in self._parts(text)]), "<i4").tolist()

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings in order: joined by spaces, or as the bytes they stand for."""
        found = [self.strings[i] for i in ids if i in self.strings]
        if not self.byte_decoder:
            return " ".join(found)
        raw = [s.encode("utf-8") if s in self.special else bytes(self.byte_of[c] for c in s) for s in found]
        return b"".join(raw).decode("utf-8", errors="replace")

    def encode_decode(self, text: str) -> tuple[bytes, str]:
        """Little-endian ids and, for vocabularies decoded by joining, the decoded text of the same ids."""
        parts = self._parts(text)
        ids = b"".join([p[0] for p in parts])
        if self.byte_decoder:
            return ids, self.decode(np.frombuffer(ids, "<i4").tolist())
        return ids, " ".join([p[1] for p in parts if p[0]])


@lru_cache(maxsize=4)
def load(path: str) -> Bpe:
    """Once per worker."""
    return Bpe(path)


def bpe_round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode ``text`` with the vocabulary file at ``path``: doc_id, ids, decoded."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        bpe = load(path)
        made = [bpe.encode_decode(t or "") for t in part.column("text").to_pylist()]
        ends = np.cumsum([0, *(len(m[0]) // 4 for m in made)]).astype(np.int32)
        ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join([m[0] for m in made]), "<i4")))
        return pa.RecordBatch.from_arrays([part.column("doc_id"), ids, pa.array([m[1] for m in made], pa.string())], ["doc_id", "ids", "decoded"])

    return stream(docs.select("doc_id", "text"), work, "doc_id long, ids array<int>, decoded string")
