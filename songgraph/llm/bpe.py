"""Byte-level BPE encoding and decoding.

A text is cut into pre-tokens by the vocabulary's pattern; the bytes of a pre-token
form a doubly linked list of symbols. All mergeable neighbours sit in a priority
queue ordered by (merge rank, position); the cheapest is merged, its two new
neighbour pairs are queued, and entries whose symbols have changed since are skipped
as stale when popped. A text of n symbols costs O(n log n), so one very long
pre-token is no worse than many short ones. Decoding concatenates the byte strings
of the vocabulary.

Pre-tokens repeat, so each Python worker keeps their ids in a bounded table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct

import numpy as np
import regex
from pyspark.sql import DataFrame

from songgraph.llm.common import map_rows

# The pre-token pattern of the byte-level vocabulary (white space is the
# Unicode property, which leaves out the control characters 1C to 1F).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
CACHE_WORDS = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the others for 256, 257, ..."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class ByteBpe:
    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        sign = byte_symbols()
        byte_of = {c: b for b, c in enumerate(sign)}
        self.first = [vocab[c] for c in sign]
        self.merge = {}
        for rank, pair in enumerate(merges):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merge.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or ()}
        self.split = (regex.compile("(" + "|".join(
            regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")")
            if self.special else None)
        self.words = regex.compile(PATTERN)
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.piece = [b""] * size
        for token, i in vocab.items():
            self.piece[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            self.piece[i] = token.encode()
        self.cache: dict[str, bytes] = {}
        self.cache_words = cache_words

    def merge_word(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        first, merge = self.first, self.merge
        sym = [first[b] for b in data]
        n = len(sym)
        if n == 1:
            return sym
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            hit = merge.get((sym[i], sym[i + 1]))
            if hit:
                queue.append((hit[0], i, hit[1]))
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        while queue:
            rank, i, new = pop(queue)
            j = after[i]
            if sym[i] < 0 or j >= n:
                continue
            hit = merge.get((sym[i], sym[j]))
            if hit is None or hit[0] != rank:       # stale: a neighbour has changed
                continue
            sym[i], sym[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                hit = merge.get((new, sym[k]))
                if hit:
                    push(queue, (hit[0], i, hit[1]))
            h = before[i]
            if h >= 0:
                hit = merge.get((sym[h], new))
                if hit:
                    push(queue, (hit[0], h, hit[1]))
        return [s for s in sym if s >= 0]

    def _plain(self, text: str) -> list[bytes]:
        words, cache = self.words.findall(text), self.cache
        found = list(map(cache.get, words))
        if None in found:
            if len(cache) > self.cache_words:
                cache.clear()
                found = [None] * len(words)
            for at, got in enumerate(found):
                if got is None:
                    w = words[at]
                    got = cache.get(w)
                    if got is None:
                        ids = self.merge_word(w.encode())
                        got = struct.pack(f"<{len(ids)}I", *ids)
                        if len(w) <= 64:
                            cache[w] = got
                    found[at] = got
        return found

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.split is None or not any(s in text for s in self.special):
            return b"".join(self._plain(text))
        out = []
        for part in self.split.split(text):
            if part in self.special:
                out.append(struct.pack("<I", self.special[part]))
            elif part:
                out += self._plain(part)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.piece.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[str, ByteBpe] = {}


def loaded(path: str) -> ByteBpe:
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns one row per input row: the key, n_tokens, ids_sha256, decoded_sha256, and
    with ``with_ids`` also ids and decoded. A null text counts as empty (no ids, the
    digests of the empty string); a null key stays null; repeated rows are encoded
    each on its own; other columns are ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded string"

    def run(cols):
        bpe = loaded(path)
        out = {key: cols[key], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        if with_ids:
            out |= {"ids": [], "decoded": []}
        for t in cols[text]:
            data = bpe.encode_bytes(t or "")
            ids = np.frombuffer(data, "<u4").tolist()
            back = bpe.decode(ids)
            out["n_tokens"].append(len(ids))
            out["ids_sha256"].append(hashlib.sha256(data).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(back.encode()).hexdigest())
            if with_ids:
                out["ids"].append(ids)
                out["decoded"].append(back)
        return out

    return map_rows(docs.select(key, text), run, schema)
