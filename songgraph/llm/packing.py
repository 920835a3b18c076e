"""Best-fit packing by linear grouping.

Documents become pieces of at most ``capacity`` tokens. The packing problem is solved
on the histogram of piece lengths alone (at most ``capacity`` numbers, whatever the
table holds), and every piece then looks up its own place:

1. Full-length pieces fill a sequence each.
2. Large lengths (over ``small_share`` of the capacity) are put, longest first, into
   groups of equal cardinality; each length is rounded up to the longest of its group.
3. The rounded instance has few sizes; its linear relaxation over configurations
   (multisets of sizes that fit) is solved by column generation: a small linear
   programme over the configurations found so far, and a knapsack that prices new
   ones. Multiplicities are rounded down, the rest goes to best fit.
4. Actual pieces replace the rounded ones, longest first; a slot of a group takes only
   pieces of that group or shorter ones.
5. The other pieces, longest first, go to the fullest sequence that still holds them;
   what fits nowhere opens new sequences.

Sequences with the same contents are handled as one class with a multiplicity, so the
plan's size depends on the capacity and the number of groups and not on the number of
documents. A piece finds its sequence from its length and its rank among the pieces of
that length; ranks are numbered inside hash salts, so a length shared by a third of all
pieces is still numbered by many tasks.
"""

from __future__ import annotations

import bisect
import json
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songgraph.llm.common import map_rows, materialize

# The pre-token pattern of the word vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"
ENDS = ".,;:!?*$%&#|"         # punctuation split off a chunk's end before it is looked up
CACHE_WORDS = 700_000
SALTS = 64


class WordIds:
    """Ids of whole texts by the tokenizers library. No pre-token spans white space, so
    the ids of a text are those of its chunks between white space in turn. Chunks already
    met come from a bounded table; the new ones of a text go through the library in one
    call, separated by blanks, and are told apart by their numbers of word ends."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.ends = np.zeros(max(vocab.values()) + 8, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.special = [t["content"] for t in spec.get("added_tokens") or ()]
        self.words = regex.compile(PATTERN)
        self.odd = regex.compile("[\x1c-\x1f]")      # split() takes these for white space
        self.cache: dict[str, bytes] = {}
        self.cache_words = cache_words

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4")

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special) or self.odd.search(text):
            return self._whole(text)
        given = text
        if text.isascii():
            text = text.lower()
        else:
            text = unicodedata.normalize("NFC", text)
            # lower-cased character by character: no special final sigma
            text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        chunks, cache = text.split(), self.cache
        found = list(map(cache.get, chunks))
        if None in found:
            if len(cache) > self.cache_words:
                cache.clear()
                found = [None] * len(chunks)
            # a chunk that ends in punctuation is its front and its end: letters and
            # digits never join punctuation that follows them
            parts, need = {}, {}
            for w, got in zip(chunks, found):
                if got is None and w not in parts:
                    front = w.rstrip(ENDS)
                    pair = (front, w[len(front):]) if front != w and front[-1:].isalnum() else (w,)
                    parts[w] = pair
                    for x in pair:
                        if x not in cache:
                            need[x] = None
            if need:
                new = list(need)
                ids = self._whole(" ".join(new))
                stops = np.flatnonzero(self.ends[ids]) + 1
                last = np.cumsum([len(self.words.findall(w)) for w in new])
                if last[-1] != len(stops):
                    return self._whole(given)
                at, data = 0, ids.tobytes()
                for w, stop in zip(new, stops[last - 1].tolist()):
                    need[w] = data[4 * at:4 * stop]
                    at = stop
                cache.update((w, x) for w, x in need.items() if len(w) <= 64)
            known = {w: b"".join([need.get(x) or cache[x] for x in pair]) for w, pair in parts.items()}
            found = [known[w] if got is None else got for w, got in zip(chunks, found)]
        return np.frombuffer(b"".join(found), "<u4")


_LOADED: dict[str, WordIds] = {}


def _loaded(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1,
           key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32 (and ids)."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""
    names = [key, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def run(cols):
        words, out = _loaded(path), {n: [] for n in names}
        for k, t in zip(cols[key], cols[text]):
            ids = np.append(words.ids(t or ""), np.uint32(end_id)).astype("<u4")
            for piece, at in enumerate(range(0, len(ids), capacity)):
                part = ids[at:at + capacity]
                row = [k, piece, at, len(part), zlib.crc32(part.tobytes())]
                for n, v in zip(names, row + [part.tolist()] * with_ids):
                    out[n].append(v)
        return out

    return map_rows(docs.select(key, text), run, schema)


# -- the plan ---------------------------------------------------------------

def _knapsack(sizes: np.ndarray, values: np.ndarray, most: np.ndarray, capacity: int):
    """The multiset of sizes within the capacity of largest value (unbounded up to what
    fits; ``most`` bounds each size)."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c], took[c] = best[c - 1], -1
        fit = np.flatnonzero(sizes <= c)
        if len(fit):
            v = best[c - sizes[fit]] + values[fit]
            j = int(np.argmax(v))
            if v[j] > best[c] + 1e-12:
                best[c], took[c] = v[j], fit[j]
    config, c = np.zeros(len(sizes), int), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            config[took[c]] += 1
            c -= sizes[took[c]]
    return config, best[capacity]


def _simplex(columns: list[np.ndarray], demand: np.ndarray, basis: list[int]):
    """Minimise the number of configurations covering ``demand``: revised simplex from
    a feasible basis over the given columns. Returns basis, amounts and prices."""
    A, m = np.array(columns, float).T, len(demand)
    for _ in range(60 * m):
        B = A[:, basis]
        x = np.linalg.solve(B, demand)
        price = np.linalg.solve(B.T, np.ones(m))
        gain = price @ A - 1
        j = int(np.argmax(gain))
        if gain[j] <= 1e-9:
            break
        way = np.linalg.solve(B, A[:, j])
        ratio = np.where(way > 1e-9, x / np.where(way > 1e-9, way, 1), np.inf)
        i = int(np.argmin(ratio))
        if not np.isfinite(ratio[i]):
            break
        basis[i] = j
    return basis, np.linalg.solve(A[:, basis], demand), price


def configurations(sizes: list[int], counts: list[int], capacity: int, rounds: int = 300):
    """Configurations and whole multiplicities for few sizes, by column generation."""
    size, need = np.array(sizes), np.array(counts, float)
    fits = np.minimum(capacity // size, np.array(counts))
    columns = [np.eye(len(size), dtype=int)[i] * max(1, f) for i, f in enumerate(fits)]
    basis = list(range(len(size)))
    for _ in range(rounds):
        basis, x, price = _simplex(columns, need, basis)
        config, value = _knapsack(size, np.maximum(price, 0), fits, capacity)
        if value <= 1 + 1e-7:
            break
        columns.append(config)
    out = [(columns[j], int(np.floor(v + 1e-9))) for j, v in zip(basis, x)]
    return [(c, n) for c, n in out if n > 0]


def plan(histogram: dict[int, int], capacity: int = 4096, groups: int = 48,
         small_share: float = 0.2):
    """The packing of a histogram {length: pieces}.

    Returns runs (length, first rank, last rank, first sequence, offset), ranks and
    sequences counting from 0, and the number of sequences. An empty histogram gives
    no runs."""
    left = {n: c for n, c in histogram.items() if c > 0}
    runs, sequences, given = [], 0, defaultdict(int)
    classes: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> [(first, many)]

    def put(length, first, many, offset):
        runs.append((length, given[length], given[length] + many - 1, first, offset))
        given[length] += many
        left[length] -= many

    if left.get(capacity):
        n = left[capacity]
        put(capacity, 0, n, 0)
        sequences = n
    large = sorted((n for n, c in left.items() if c > 0 and n > small_share * capacity),
                   reverse=True)
    total = sum(left[n] for n in large)
    if total:
        # Groups of equal cardinality; a length shared by many pieces can span several.
        each, group_of, group = max(1, -(-total // groups)), [], []
        for n in large:
            c = left[n]
            while c:
                take = min(c, each - sum(k for _, k in group))
                group.append((n, take))
                c -= take
                if sum(k for _, k in group) == each:
                    group_of.append(group)
                    group = []
        if group:
            group_of.append(group)
        merged: dict[int, list] = {}
        for g in group_of:
            merged.setdefault(g[0][0], []).extend(g)
        sizes = list(merged)
        stock = []
        for s in sizes:
            per: dict[int, int] = defaultdict(int)
            for n, k in merged[s]:
                per[n] += k
            stock.append([[n, k] for n, k in per.items()])
        for config, many in configurations(sizes, [sum(k for _, k in s) for s in stock],
                                           capacity):
            # Slots of a class take equal pieces as long as every slot's stock lasts.
            slots = [g for g, k in enumerate(config) for _ in range(k)]
            while many and all(stock[g] for g in slots):
                # A group's slots take from its longest length left, or wait for the
                # next one where too few pieces of it are left for all of them.
                same: dict[int, int] = defaultdict(int)
                for g in slots:
                    same[g] += 1
                chosen, run = {}, many
                for g, k in same.items():
                    if stock[g][0][1] >= k:
                        chosen[g] = [stock[g][0][0]] * k
                        run = min(run, stock[g][0][1] // k)
                    else:
                        mixed, i = [], 0
                        for length, c in stock[g]:
                            mixed += [length] * min(c, k - len(mixed))
                            i += 1
                            if len(mixed) == k:
                                break
                        chosen[g], run = mixed, min(run, 1)
                if any(len(chosen[g]) < k for g, k in same.items()):
                    break
                offset = 0
                for g, lengths in chosen.items():
                    for length in lengths:
                        put(length, sequences, run, offset)
                        offset += length
                        for entry in stock[g]:
                            if entry[0] == length:
                                entry[1] -= run
                                break
                    stock[g] = [e for e in stock[g] if e[1] > 0]
                classes[capacity - offset].append((sequences, run))
                sequences += run
                many -= run
    rooms = sorted(classes)

    def shelve(room, first, many):
        if room not in classes or not classes[room]:
            if room not in classes:
                classes[room] = []
            at = bisect.bisect_left(rooms, room)
            if at == len(rooms) or rooms[at] != room:
                rooms.insert(at, room)
        classes[room].append((first, many))

    for length in sorted((n for n, c in left.items() if c > 0), reverse=True):
        while left[length]:
            at = bisect.bisect_left(rooms, length)
            while at < len(rooms) and not classes[rooms[at]]:
                rooms.pop(at)
            if at < len(rooms):
                room = rooms[at]
                first, many = classes[room].pop()
                # The fullest sequences keep taking this length as long as it fits.
                deep = min(room // length, max(1, left[length] // many))
                run = min(many, left[length])
                if run < many:
                    classes[room].append((first + run, many - run))
                for _ in range(deep):
                    put(length, first, run, capacity - room)
                    room -= length
                shelve(room, first, run)
            else:
                fit = capacity // length
                run = left[length] // fit
                if run:
                    for k in range(fit):
                        put(length, sequences, run, k * length)
                    shelve(capacity - fit * length, sequences, run)
                    sequences += run
                else:
                    k = left[length]
                    for i in range(k):
                        put(length, sequences, 1, i * length)
                    shelve(capacity - k * length, sequences, 1)
                    sequences += 1
    return runs, sequences


# -- placing ----------------------------------------------------------------

def pack(parts: DataFrame, capacity: int = 4096, groups: int = 48, key: str = "doc_id") -> DataFrame:
    """Give every piece its sequence_id and offset.

    ``parts`` holds key, piece, length and ids_crc32 and must be a written table (it is
    read more than once). Ranks order pieces by key, so the result does not depend on
    the partitioning; equal rows (a document given twice) are separate pieces and may
    swap places. No rows give no rows."""
    histogram = {r[0]: r[1] for r in parts.groupBy("length").count().collect()}  # <= capacity rows
    runs, _ = plan(histogram, capacity, groups)
    salt = F.pmod(F.xxhash64(F.col(key), F.col("piece")), F.lit(SALTS)).cast("int")
    salted = parts.withColumn("_salt", salt)
    counts = salted.groupBy("length", "_salt").count()
    base = counts.withColumn("_base", F.sum("count").over(
        Window.partitionBy("length").orderBy("_salt")) - F.col("count")).drop("count")
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(
        key, "piece", "ids_crc32")) - 1
    placed = (salted.withColumn("_rank", rank)
              .join(base.hint("merge"), ["length", "_salt"])
              .withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_salt", "_base"))
    # The runs of each length, as sorted arrays (their number depends on the capacity).
    by = defaultdict(list)
    for length, lo, _, seq, offset in runs:
        by[length].append((lo, seq, offset))
    lookup = {n: tuple(np.array(x) for x in zip(*sorted(v))) for n, v in by.items()}
    names = [c for c in placed.columns if c != "_rank"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema
                       if f.name != "_rank") + ", sequence_id long, offset long"

    def run(cols):
        seq, off = [], []
        for n, r in zip(cols["length"], cols["_rank"]):
            lo, first, offset = lookup[n]
            i = int(np.searchsorted(lo, r, "right")) - 1
            seq.append(int(first[i] + r - lo[i]))
            off.append(int(offset[i]))
        return {c: cols[c] for c in names} | {"sequence_id": seq, "offset": off}

    return map_rows(placed, run, schema, rows=4096)


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, groups: int = 48,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise, cut and pack whole documents: one row per piece with its place.

    A null or empty text is the end token alone; a document longer than the capacity
    gives several pieces, each document at least one; null keys and repeated rows are
    packed like any other row; other columns are ignored; an empty table gives an empty
    result."""
    return pack(materialize(pieces(docs, path, capacity, key=key, text=text), "pieces"),
                capacity, groups, key)
