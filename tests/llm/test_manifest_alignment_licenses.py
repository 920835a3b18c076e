"""Merkle manifest, cross-tokenizer alignment and license scan against brute force, and on
awkward tables: nulls, empty and very long texts, ties, repeated rows, empty tables, extra
columns with clashing names."""

import hashlib
import random
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from songgraph.llm import alignment, licenses, merkle
from songgraph.llm import queries as Q
from songgraph.llm.bpe import byte_symbols
from tests.llm.test_llm import SF, awkward, docs_of, empty
from tests.oracle_check import compare, duck

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", ["op11_merkle", "op13_licenses"])
def test_query_equals_oracle(spark, name):
    ok, _, _, msg = compare(spark, SF, name, Q.QUERIES[name], Q.ORACLE[name], duck(SF))
    assert ok, msg


# Merkle manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def leaf(row, fields):
    parts = []
    for f in fields:
        v = row[f]
        parts.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return h(*parts)


def plain_manifest(rows, fields, key, group):
    """(key, leaf, subroot, root, proof digest) of every row, the plain way."""
    held = defaultdict(list)
    for r in rows:
        held[r[group]].append((r[key] is not None, r[key] or 0, leaf(r, fields), r[key]))
    trees = {g: (sorted(x), levels([y[2] for y in sorted(x)])) for g, x in held.items()}
    order = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    top = levels([trees[g][1][-1][0] for g in order]) if order else []

    def path(tree, at):
        out = []
        for level in tree[:-1]:
            out += level[at ^ 1:(at ^ 1) + 1]
            at //= 2
        return out
    out = []
    for n, g in enumerate(order):
        leaves, tree = trees[g]
        out += [(x[3], x[2], tree[-1][0], top[-1][0], h(*path(tree, i), *path(top, n))) for i, x in enumerate(leaves)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(1,), (2, 1), (257, 3, 1, 64), (600,), (1, 1, 1, 1, 1)])
def test_manifest_equals_plain_trees(spark, sizes):
    r = random.Random(1)
    rows = [{"doc_id": i, "lang": [None, "b", "é", "", "a"][g], "text": r.choice([None, "", "x" * i, "ü"])}
            for g, n in enumerate(sizes) for i in range(n)]
    r.shuffle(rows)
    got = merkle.manifest(spark.createDataFrame([tuple(x.values()) for x in rows], "doc_id long, lang string, text string"),
                          fields=("doc_id", "lang", "text")).collect()
    assert all(x.verified and x.folded_root == x.root for x in got)
    assert sorted([(x.doc_id, x.leaf, x.subroot, x.root, x.proof_sha256) for x in got], key=repr) \
        == plain_manifest(rows, ("doc_id", "lang", "text"), "doc_id", "lang")


def test_manifest_finds_every_tampered_row(spark):
    docs = docs_of(spark)
    got = Q.QUERIES["op11_merkle"](spark, SF).collect()
    assert len(got) == docs.count() and len({x.root for x in got}) == 1
    for x in got:
        assert x.verified == (zlib.crc32(str(x.doc_id).encode()) % 7 != 0)
    # any other value of any field leads to another root, as does another row's proof
    other = merkle.manifest(docs, claimed={"text": F.concat("text", F.lit("."))}, with_proof=True)
    assert other.where("verified").isEmpty()
    row = other.first()
    acc = row.leaf
    for s in row.proof:
        acc = h(s.left, acc, s.right)
    assert acc == row.root


def test_manifest_awkward(spark):
    fields = ("doc_id", "text", "node")
    docs = awkward(spark)
    got = merkle.manifest(docs, fields, group="node").collect()
    rows = [x.asDict() for x in docs.collect()]
    assert sorted([(x.doc_id, x.leaf, x.subroot, x.root, x.proof_sha256) for x in got], key=repr) \
        == plain_manifest(rows, fields, "doc_id", "node")
    clash = docs.withColumns({c: F.lit(1) for c in ("g", "pos", "n", "leaf", "path", "root", "share", "key", "part")})
    assert len(merkle.manifest(clash, fields, group="text").collect()) == len(rows)
    assert merkle.manifest(empty(spark), ("doc_id", "text"), group="same").count() == 0
    counts = spark.createDataFrame([(1, 9223372036854775807), (7, None)], "doc_id long, n_chars long") \
        .select("doc_id", F.lit("s").alias("source"), F.lit(None).cast("string").alias("lang"), "n_chars",
                F.lit("t").alias("text"))
    assert merkle.manifest(counts).count() == 2


# alignment

def plain_alignment(texts):
    """What the contract says, token by token."""
    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    byte_of = {c: n for n, c in enumerate(byte_symbols())}
    links, out, held = [], [], Counter()
    for t in texts:
        here = Counter()
        row = (0, 0, 0, 0, "")
        if t:
            ta = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids]
            tb = [(i, bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" else p.replace("▁", " ").encode())
                  for i in b.encode(t) for p in [b.id_to_piece(i)]]
            want = (" " + t).encode()
            if b"".join(x for _, x in ta) == want == b"".join(x for _, x in tb):
                spans = []
                for side in (ta, tb):
                    at, got = 0, []
                    for i, x in side:
                        got.append((i, at, at + len(x)))
                        at += len(x)
                    spans.append(got)
                ends = sorted({z for _, _, z in spans[0]} & {z for _, _, z in spans[1]})
                groups = [([], []) for _ in ends]
                for side, got in enumerate(spans):
                    for i, _, z in got:
                        groups[bisect_left(ends, z)][side].append(i)
                here = Counter((i, j) for i, s, z in spans[0] for j, p, q in spans[1] if s < q and p < z)
                text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
                row = (len(ta), len(tb), len(groups), sum(here.values()), hashlib.sha256(text.encode()).hexdigest())
        links.append(here)
        out.append(row)
        held.update(here.keys())
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    return [(*row, sum(m for p, m in here.items() if held[p] == most[p[0]]), sum(m * held[p] for p, m in here.items()))
            for row, here in zip(out, links)]


def aligned_rows(df):
    return sorted([(x.doc_id, x.n_a, x.n_b, x.n_groups, x.n_links, x.groups_sha256, x.n_best, x.count_sum)
                   for x in df.collect()], key=repr)


def want_rows(keys, texts):
    return sorted([(k, *row) for k, row in zip(keys, plain_alignment(texts))], key=repr)


ODD = ["<|endoftext|> and <s> </s> <unk>", "a▁b", "nul\x00 byte\r\n\ttab", "  two  spaces ", "日本語 text émigré \U0001f600",
       "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "1234567890 12,345.67", " nbsp　wide", "don't we'll THEY'RE", " ", "\n"]


def test_alignment_equals_plain_alignment(spark):
    texts = [r.text[:1500] if r.text else r.text for r in docs_of(spark).orderBy("doc_id").limit(60).collect()] + ODD
    rows = list(enumerate(texts))
    got = alignment.alignment(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), BYTE, PIECE)
    assert aligned_rows(got) == want_rows(*zip(*rows))


def test_alignment_awkward(spark):
    short = awkward(spark).where("doc_id is null or doc_id <> 11 and doc_id <> 10")
    rows = [(r.doc_id, r.text) for r in short.collect()]
    got = alignment.alignment(short, BYTE, PIECE)
    assert aligned_rows(got) == want_rows(*zip(*rows))
    assert alignment.alignment(awkward(spark), BYTE, PIECE).count() == awkward(spark).count()
    assert alignment.alignment(empty(spark), BYTE, PIECE).count() == 0
    clash = short.withColumns({c: F.lit(2) for c in ("row", "pair", "fast", "n_a", "c0", "best")})
    assert aligned_rows(alignment.alignment(clash, BYTE, PIECE)) == want_rows(*zip(*rows))


def test_alignment_query(spark):
    got = {r.doc_id: r for r in Q.QUERIES["op12_alignment"](spark, SF).collect()}
    docs = {r.doc_id: r.text for r in docs_of(spark).collect()}
    assert got.keys() == docs.keys()
    share = sum(r.n_regular for r in got.values()) / sum(r.n_links for r in got.values())
    assert share > 0.5          # most links take the identity map
    for k, r in got.items():
        assert r.n_links == r.n_a + r.n_b - r.n_groups and r.n_best <= r.n_links <= r.count_sum


# licenses

def scanned(spark, texts, **kw):
    rows = [(i, t) for i, t in enumerate(texts)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), **kw).collect()
    return [r for _, r in sorted((r.doc_id, r) for r in got)]


def test_license_spans_survive_edits(spark):
    r = random.Random(3)
    mit = licenses.TEMPLATES[1][1].split()
    lost = [w for n, w in enumerate(mit) if n not in (12, 40, 90)]
    added = mit[:30] + ["really", "truly"] + mit[30:]
    changed = [w if n % 12 else "word" for n, w in enumerate(mit)]
    noise = [" ".join(r.choice("stone river bridge light water moves".split()) for _ in range(50)) for _ in range(2)]
    rest = [r.choice(mit) for _ in range(len(mit))]
    texts = [f"{noise[0]} {' '.join(x)} {noise[1]}" for x in (mit, lost, added, changed, mit + noise[0].split() + mit, rest)]
    got = scanned(spark, texts)
    assert [x.labels for x in got] == ["mit"] * 5 + [""]
    assert got[0].score == 1.0 and got[0].spans == f"mit:50:{50 + len(licenses.words(' '.join(mit)))}"
    assert all(0.7 <= x.score < 1 for x in got[1:4]) and got[4].spans.count("mit:") == 2
    assert all(x.base_labels == "" and x.n_base == 0 and x.first_word is None for x in got)


def test_license_base_places(spark):
    got = scanned(spark, ["MIT License, the mit  LICENSE; Apache-License gnu GENERAL public\nlicense", "mit licenses", None, "",
                          "éMIT license mité license", "Licensed under CC BY-NC 4.0.", "Kelvin general public license"])
    assert (got[0].n_words, got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels, got[0].score) \
        == (11, 4, 0, 8, "apache,gpl,mit", 1.0)
    assert [x.n_base for x in got[1:]] == [0, 0, 0, 0, 0, 1]
    assert got[5].labels == "cc-by-nc" and got[5].base_labels == ""
    assert [x.n_words for x in got[1:4]] == [2, 0, 0]


def test_licenses_awkward(spark):
    lines = [(30, "Licensed under CC BY-NC 4.0"), (30, "Licensed under CC BY-NC 4.0"), (31, "released under the mit license " * 2000),
             (32, "released under the " * 500)]
    docs = awkward(spark, lines)
    clash = docs.withColumns({c: F.lit(3) for c in ("th", "t", "key", "runs", "again", "labels")})
    for df in (docs, clash):
        got = licenses.scan(df).collect()
        assert len(got) == docs.count()
        for r in got:
            assert (r.labels == {30: "cc-by-nc", 31: "mit"}.get(r.doc_id, "")) and 0 <= r.score <= 1
            assert r.n_base == (2000 if r.doc_id == 31 else 0)
    assert licenses.scan(empty(spark)).count() == 0
