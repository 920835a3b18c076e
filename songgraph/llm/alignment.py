"""Alignment of the tokens of two tokenizers over one corpus.

A (byte-level BPE) and B (a sentencepiece model) cut the same bytes differently. Byte
offsets where tokens of both end cut a text into groups; two tokens are linked where
their byte ranges overlap. Between two neighbouring ends of either side lies exactly one
overlap of an A token with a B token, so the links of a block of texts are a merge of two
sorted arrays of ends.

Neither side has a token that goes on from a printing character into white space, so
every text falls into chunks (white space and what follows it) that both encode one by
one, and whose borders end tokens of both. Chunks repeat; each worker keeps what it found
for them in a bounded table. Texts that this does not hold for are aligned whole.

Most groups are one A token against the B token of the same bytes. For those a map from
A id to B id is computed once from the two vocabularies, and they are counted in vectors
of the length of A's vocabulary, one a task, added up by id. Only the links of other
groups travel as id pairs, once per document and pair, combined before the shuffle.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from songgraph.llm.bpe import byte_symbols
from songgraph.llm.common import materialize, ship_package
from songgraph.session import scratch

ROWS = 256                  # texts aligned at a time
CHUNKS, LETTERS = 300_000, 1 << 24      # chunks that a worker keeps, and their letters
SPACE = " \n\t"              # not the carriage return: B has pieces that end in one
_CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_OTHER_SPACE = re.compile(f"[^\\S{SPACE}]")       # white space at which texts are not cut


class Aligner:
    """The two tokenizers, the bytes of their ids, and the identity map."""

    def __init__(self, path_a: str, path_b: str):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True         # their strings in a text are plain text
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {c: n for n, c in enumerate(byte_symbols())}
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.size_a = max([*vocab.values(), *(t["id"] for t in spec.get("added_tokens") or ())]) + 1
        self.bytes_a = [b""] * self.size_a
        for token, i in vocab.items():
            if all(c in byte_of for c in token):
                self.bytes_a[i] = bytes(byte_of[c] for c in token)
        self.size_b = self.b.vocab_size()
        self.bytes_b = [self._piece(self.b.id_to_piece(i)) for i in range(self.size_b)]
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        first = {}
        for i, x in enumerate(self.bytes_b):
            first.setdefault(x, i)
        self.same = np.array([first.get(x, -1) if x else -1 for x in self.bytes_a], np.int64)
        # an id as text, followed by each mark that may come after it
        self.text_a = np.array([[f"{i},".encode() for i in range(self.size_a)],
                                [f"{i}|".encode() for i in range(self.size_a)]], object)
        self.text_b = np.array([[f"{i},".encode() for i in range(self.size_b)],
                                [f"{i};".encode() for i in range(self.size_b)]], object)
        # no piece goes on into white space, so a text may be cut before it
        inner = re.compile(f"[^{SPACE}▁][{SPACE}▁]|▁[\n\t]")
        self.cuts = not any(inner.search(self.b.id_to_piece(i)) for i in range(self.size_b))
        self.blank = self.b.piece_to_id("▁")
        self.forget()

    def forget(self) -> None:
        """Empty the table of chunks: numbers, group text and linked pairs of each."""
        self.known: dict[str, int] = {}
        self.letters = 0
        self.counts = np.zeros((0, 5), np.int64)        # n_a, n_b, groups, links, regular
        self.groups: list[bytes] = []
        self.first = np.zeros(0, np.int64)              # of each chunk's pairs
        self.pairs = np.zeros(0, np.int64)

    @staticmethod
    def _piece(piece: str) -> bytes:
        byte = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[list[list[int]]]:
        """The ids of A and of B for texts that begin with white space. B puts a blank of
        its own before a text: it stands for a leading space, and comes off elsewhere."""
        got_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        got_b = self.b.encode([t[t[0] == " ":] for t in texts], num_threads=1)
        for n in [n for n, t in enumerate(texts) if t[0] != " " or t == " "]:
            if texts[n] == " ":
                got_b[n] = [self.blank]
            else:                   # without that blank the bytes will not agree
                got_b[n] = got_b[n][1:] if got_b[n] and got_b[n][0] == self.blank else []
        return [got_a, got_b]

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of A and of B: the number of ids of each text, and all ids one after the other;
        none for a text that the joined bytes of either side do not give back."""
        sides, good = self.encode(texts), np.ones(len(texts), bool)
        want = [t.encode() for t in texts]
        out = []
        for ids, known, length in zip(sides, (self.bytes_a, self.bytes_b), (self.length_a, self.length_b)):
            many = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter(chain.from_iterable(ids), np.int64, int(many.sum()))
            out.append((many, flat))
            ends = np.cumsum(np.r_[0, length[flat]])[starts_of(many)]
            same = np.diff(ends) == np.fromiter(map(len, want), np.int64, len(want))
            if not (same.all() and b"".join(map(known.__getitem__, flat.tolist())) == b"".join(want)):
                good &= [b"".join(map(known.__getitem__, x)) == w for x, w in zip(ids, want)]
        if not good.all():
            out = [(many * good, flat[np.repeat(good, many)]) for many, flat in out]
        return out

    def chunks(self, texts: list[str]) -> list[np.ndarray | None]:
        """The numbers of each text's chunks in the table, None if it must be aligned whole."""
        if len(self.known) > CHUNKS or self.letters > LETTERS:
            self.forget()
        cut = [None if not self.cuts or _OTHER_SPACE.search(t) else _CHUNK.findall(t) for t in texts]
        known = self.known
        new = list({c for x in cut if x for c in x if c not in known})
        if new:
            self.letters += sum(map(len, new))
            known.update(zip(new, range(len(known), len(known) + len(new))))
            found = links_of(self, new, self.tokens(new))
            self.counts = np.concatenate([self.counts, found["counts"]])
            self.groups += found["text"]
            self.first = np.r_[self.first, len(self.pairs) + starts_of(found["counts"][:, 3])[:-1]]
            self.pairs = np.concatenate([self.pairs, found["pair"]])
        out = [None if x is None else np.fromiter(map(known.__getitem__, x), np.int64, len(x)) for x in cut]
        bad = self.counts[:, 0] == 0            # a chunk that is not given back byte for byte
        return [None if x is None or bad[x].any() else x for x in out]


_LOADED: dict[tuple[str, str], Aligner] = {}


def loaded(path_a: str, path_b: str) -> Aligner:
    at = (path_a, path_b)
    if at not in _LOADED:
        _LOADED[at] = Aligner(path_a, path_b)
    return _LOADED[at]


def starts_of(sizes) -> np.ndarray:
    return np.r_[0, np.cumsum(np.asarray(sizes, np.int64))]


def links_of(al: Aligner, texts: list[str], ids: list[tuple[np.ndarray, np.ndarray]]) -> dict:
    """Per text the numbers (counts) of tokens, groups, links and one-to-one groups of the same
    bytes and its groups as text; and all links as pairs (A id * size of B + B id), the
    texts' one after the other."""
    many = len(texts)
    (count_a, a), (count_b, b) = ids
    # the texts one after the other: each ends in an end of both sides
    end_a, end_b = np.cumsum(al.length_a[a]), np.cumsum(al.length_b[b])
    doc_a = np.repeat(np.arange(many), count_a)

    every = np.sort(np.concatenate([end_a, end_b]), kind="stable")          # of two sorted runs
    again = np.r_[every[1:] == every[:-1], False] if len(every) else np.zeros(0, bool)
    ends, cuts = every[again], every[~again]
    group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
    in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
    last_a, last_b = starts_of(in_a)[1:] - 1, starts_of(in_b)[1:] - 1       # of each group

    # one link ends at each end of either side
    link_a, link_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
    doc, ida, idb, group = doc_a[link_a], a[link_a], b[link_b], group_a[link_a]
    regular = (al.same[ida] == idb) & (in_a[group] == 1) & (in_b[group] == 1)

    text = np.empty(len(a) + len(b), object)
    text[np.arange(len(a)) + (starts_of(in_b)[:-1])[group_a]] = \
        al.text_a[(np.arange(len(a)) == last_a[group_a]).astype(np.int64), a]
    text[np.arange(len(b)) + (starts_of(in_a)[1:])[group_b]] = \
        al.text_b[(np.arange(len(b)) == last_b[group_b]).astype(np.int64), b]
    at = starts_of(count_a + count_b)
    counts = [count_a, count_b, *(np.bincount(x, minlength=many) for x in (doc_a[last_a], doc, doc[regular]))]
    bounds, flat = at.tolist(), text.tolist()
    return {"counts": np.stack(counts, 1), "pair": ida * al.size_b + idb,
            "text": [b"".join(flat[x:y]) for x, y in zip(bounds, bounds[1:])]}


def aligned(al: Aligner, texts: list[str | None]) -> dict[str, pa.Array]:
    """The columns of ``ALIGNED`` for a block of texts."""
    many = len(texts)
    counts, digests = np.zeros((many, 5), np.int64), [""] * many
    docs, pairs, weights = [], [], []
    real = [n for n, t in enumerate(texts) if t]
    cut = dict(zip(real, al.chunks([" " + texts[n] for n in real])))
    table = al.counts
    for n, x in cut.items():
        if x is not None:
            counts[n] = table[x].sum(0)
            digests[n] = hashlib.sha256(b"".join([al.groups[i] for i in x.tolist()])[:-1]).hexdigest()
            kinds, times = np.unique(x, return_counts=True)
            sizes = table[kinds, 3]
            at = np.arange(sizes.sum()) + np.repeat(al.first[kinds] - starts_of(sizes)[:-1], sizes)
            docs.append(np.full(len(at), n))
            pairs.append(al.pairs[at])
            weights.append(np.repeat(times, sizes))
    whole = [n for n, x in cut.items() if x is None]
    if whole:
        these = [" " + texts[n] for n in whole]
        found = links_of(al, these, al.tokens(these))
        for k, n in enumerate(whole):
            counts[n] = found["counts"][k]
            if found["text"][k]:
                digests[n] = hashlib.sha256(found["text"][k][:-1]).hexdigest()
        docs.append(np.repeat(np.array(whole), found["counts"][:, 3]))
        pairs.append(found["pair"])
        weights.append(np.ones(len(found["pair"]), np.int64))
    none = np.zeros(0, np.int64)
    doc, pair, weight = (np.concatenate([*x, none]) for x in (docs, pairs, weights))
    # same bytes: counted by A id, also where the two overlap in a larger group
    ida = pair // al.size_b
    plain = al.same[ida] == pair % al.size_b

    def lists(doc, value, weight, size, kind):
        """Per text its distinct values, and how often it has each."""
        keys, where = np.unique(doc * size + value, return_inverse=True)
        times = np.bincount(where, weight, minlength=len(keys)).astype(np.int64)
        offsets = pa.array(starts_of(np.bincount(keys // size, minlength=many)), pa.int32())
        return (pa.ListArray.from_arrays(offsets, pa.array(keys % size, kind)),
                pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())))

    fast = lists(doc[plain], ida[plain], weight[plain], al.size_a, pa.int32())
    rest = lists(doc[~plain], pair[~plain], weight[~plain], al.size_a * al.size_b, pa.int64())
    return {**{c: pa.array(counts[:, k]) for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links", "n_regular"))},
            "groups_sha256": pa.array(digests, pa.string()), "fast": fast[0], "fast_n": fast[1],
            "pair": rest[0], "pair_n": rest[1]}


ALIGNED = ("n_a long, n_b long, n_groups long, n_links long, n_regular long, groups_sha256 string, "
           "fast array<int>, fast_n array<int>, pair array<long>, pair_n array<int>")


def align(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the key and ``ALIGNED``: numbers of tokens, groups,
    links and one-to-one groups of the same bytes, the digest of the groups, and each
    linked id pair once with its number of links, ``fast`` by A id for pairs of the
    identity map, ``pair`` (A id * size of B + B id) for the others."""
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = loaded(path_a, path_b)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                cols = aligned(al, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), *cols.values()], names=["c0", *cols])

    return docs.select(F.col(f"`{key}`").alias("c0"), F.col(f"`{text}`").alias("c1")) \
        .mapInArrow(run, f"c0 {kind}, {ALIGNED}").withColumnRenamed("c0", key)


def _vectors(rows: DataFrame, size: int) -> DataFrame:
    """(a, n): in how many documents each A id is linked to the B id of its bytes. A task
    adds its documents up in one vector and returns the entries that are not zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["a", "n"])

    return rows.select("fast").mapInArrow(run, "a int, n long").groupBy("a").agg(F.sum("n").alias("n"))


def pair_counts(rows: DataFrame, size_a: int, size_b: int) -> tuple[DataFrame, DataFrame, np.ndarray, np.ndarray]:
    """From written ``align`` rows: (pair, n, best) of the pairs outside the identity map,
    (a, n) of those inside it, and for every A id its count inside and the highest of all
    its pairs. The two vectors have the length of A's vocabulary, whatever the corpus."""
    fast = materialize(_vectors(rows, size_a), "identity-counts")
    pairs = materialize(rows.select(F.explode("pair").alias("pair")).groupBy("pair")
                        .agg(F.count(F.lit(1)).alias("n")), "pair-counts")
    a = F.floor(F.col("pair") / size_b).cast("int")
    top = materialize(pairs.groupBy(a.alias("a")).agg(F.max("n").alias("n")).unionByName(fast)
                      .groupBy("a").agg(F.max("n").alias("most")), "highest-counts")
    counts, highest = np.zeros(size_a, np.int64), np.zeros(size_a, np.int64)
    for i, n in fast.collect():
        counts[i] = n
    for i, n in top.collect():
        highest[i] = n
    marked = pairs.join(top, a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    return marked, fast, counts, highest


def alignment(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the key, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256, n_regular.

    The count of an id pair is the number of rows of ``docs`` that hold it linked;
    n_best counts the links whose pair has the highest count of its A id (ties included),
    count_sum adds the counts over the links. Null and empty texts, and those that a
    tokenizer does not give back byte for byte, have no tokens: zeros and an empty digest.
    A null key stays null, repeated rows count each, an empty table gives no rows, other
    columns are ignored. The result is a written table."""
    al = loaded(path_a, path_b)
    with scratch(docs.sparkSession) as own:
        rows = materialize(align(docs, path_a, path_b, key, text)
                           .withColumn("row", F.monotonically_increasing_id()), "aligned")
        pairs, _, counts, highest = pair_counts(rows, al.size_a, al.size_b)
        best = (counts == highest) & (counts > 0)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, many = (batch.column(n).flatten().to_numpy(zero_copy_only=False) for n in (1, 2))
                doc = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(1).offsets.to_numpy()))
                total, good = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
                np.add.at(total, doc, counts[ids] * many)
                np.add.at(good, doc, many * best[ids])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(good), pa.array(total)],
                                                 names=["row", "good", "total"])

        inside = rows.select("row", "fast", "fast_n").mapInArrow(score, "row long, good long, total long")
        each = rows.select("row", F.explode(F.arrays_zip("pair", "pair_n")).alias("x")) \
            .select("row", F.col("x.pair").alias("pair"), F.col("x.pair_n").alias("many"))
        # a merge join at every size: the pairs of the corpus have no bound that fits a broadcast
        outside = each.join(materialize(pairs, "pair-marks").hint("merge"), "pair").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("many")).otherwise(0)).cast("long").alias("good"),
            F.sum(F.col("many") * F.col("n")).alias("total"))
        sums = inside.unionByName(outside).groupBy("row").agg(
            F.sum("good").alias("n_best"), F.sum("total").alias("count_sum"))
        return own.keep(rows.join(sums, "row").select(
            F.col(f"`{key}`"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
            "n_regular"), "alignment")
