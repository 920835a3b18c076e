"""One registered query per operator, with production parameters, on whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songgraph.llm import (alignment, bpe, hamming, licenses, linededup, merkle, minhash, packing, page_text, pii,
                           quality, search, toxicity)
from songgraph.llm.common import fold, table
from songgraph.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run
    return keep


_BM25 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
q AS (SELECT item_id AS query_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS t
      FROM benchmark WHERE item_id % 20 = 0),
qt AS (SELECT query_id, t, count(*) AS many FROM q GROUP BY ALL),
s AS (SELECT count(*) AS n, sum(len(w)) / count(*) AS mean FROM d),
p AS (SELECT doc_id, t, count(*) AS c, any_value(size) AS size
      FROM (SELECT doc_id, len(w) AS size, unnest(w) AS t FROM d) GROUP BY doc_id, t),
f AS (SELECT t, count(*) AS df FROM p GROUP BY t),
r AS (SELECT query_id, doc_id,
        sum(many * ln(1 + (n - df + 0.5) / (df + 0.5)) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * size / mean))) AS score
      FROM qt JOIN p USING (t) JOIN f USING (t) CROSS JOIN s GROUP BY query_id, doc_id),
k AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS INT) AS rank,
        doc_id, round(score, 6) AS score FROM r)
SELECT query_id, rank, doc_id, score FROM k WHERE rank <= 10
"""


@query("op1_topk_search", _BM25)
def op1_topk_search(spark, sf_dir):
    """The 10 best documents for every benchmark passage whose id is divisible by 20."""
    asked = table(spark, sf_dir, "benchmark").where("item_id % 20 = 0") \
        .select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    found = search.top_k(table(spark, sf_dir, "documents"), asked, 10)
    return found.select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


@query("op2_quality")
def op2_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    chain = quality.train(docs, labels.where(fold("doc_id", 5) != 0))
    return quality.score(docs, chain).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query("op3_packing")
def op3_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op4_embedding_dedup")
def op4_embedding_dedup(spark, sf_dir):
    return hamming.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op5_pii")
def op5_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(fold("doc_id", 3) != 1))
    return toxicity.score(docs, model).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted", "passages")


@query("op7_minhash")
def op7_minhash(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op8_line_dedup")
def op8_line_dedup(spark, sf_dir):
    return linededup.mark(table(spark, sf_dir, "documents")).select("doc_id", "line", "group_id", "kept")


@query("op9_html")
def op9_html(spark, sf_dir):
    return page_text.extract(table(spark, sf_dir, "pages"))


@query("op10_bpe")
def op10_bpe(spark, sf_dir):
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


_CRC = ("xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),"
        " lambda s: ord(s)::UBIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), repeat([0::UBIGINT], 8)),"
        " lambda d, i: CASE WHEN d % 2 = 1 THEN xor(d // 2, 3988292384::UBIGINT) ELSE d // 2 END)), 4294967295::UBIGINT)")


def _leaf(n_chars: str = "n_chars") -> str:
    texts = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", n_chars, "text")]
    return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in texts) + ")"


def _tree(name: str, leaves: str) -> str:
    """The nodes (g, lvl, pos, h) of the trees over ``leaves`` (g, pos, h), bottom up."""
    return f"""{name} AS (
  SELECT g, 0 AS lvl, pos, h, count(*) OVER (PARTITION BY g) AS n FROM {leaves}
  UNION ALL
  SELECT g, lvl, pos, h, count(*) OVER (PARTITION BY g) AS n FROM (
    SELECT g, lvl + 1 AS lvl, pos // 2 AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h
    FROM {name} WHERE n > 1 GROUP BY g, lvl, pos // 2))"""


def _siblings(name: str, leaves: str) -> str:
    """Per leaf the siblings bottom up, each as its side (L, R, or N for none) and digest."""
    return f"""(SELECT l.g, l.pos, list(CASE WHEN s.h IS NULL THEN 'N' WHEN s.pos % 2 = 0 THEN 'L' || s.h
                       ELSE 'R' || s.h END ORDER BY a.lvl) AS path
    FROM {leaves} l JOIN {name} a ON a.g = l.g AND a.pos = l.pos >> a.lvl AND a.n > 1
    LEFT JOIN {name} s ON s.g = a.g AND s.lvl = a.lvl AND s.pos = xor(a.pos, 1) GROUP BY l.g, l.pos)"""


_MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf()} AS h,
         CASE WHEN doc_id IS NOT NULL AND {_CRC} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf()} END AS claimed
  FROM documents),
lv AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM d),
{_tree("t", "lv")},
sub AS (SELECT g AS name, h FROM t WHERE n = 1),
tl AS (SELECT '' AS g, name, row_number() OVER (ORDER BY name) - 1 AS pos, h FROM sub),
{_tree("u", "tl")},
lo AS {_siblings("t", "lv")},
hi AS {_siblings("u", "tl")},
w AS (SELECT lv.doc_id, lv.h AS leaf, lv.claimed, tl.h AS subroot, (SELECT h FROM u WHERE n = 1) AS root,
        list_concat(coalesce(lo.path, []), coalesce(hi.path, [])) AS path
      FROM lv JOIN tl ON tl.name = lv.g LEFT JOIN lo ON lo.g = lv.g AND lo.pos = lv.pos
      LEFT JOIN hi ON hi.pos = tl.pos),
f AS (SELECT *, list_reduce(list_prepend(claimed, path), lambda acc, x: sha256(
        CASE x[1] WHEN 'L' THEN x[2:] || acc WHEN 'R' THEN acc || x[2:] ELSE acc END)) AS folded_root FROM w)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_prepend('', list_transform(path, lambda x: x[2:])),
       'string_agg', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM f
"""


@query("op11_merkle", _MERKLE)
def op11_merkle(spark, sf_dir):
    """The manifest of all documents, checked against a copy in which every seventh count was tampered with."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars").cast("decimal(20,0)") + 1) \
        .otherwise(F.col("n_chars").cast("decimal(20,0)"))
    return merkle.manifest(table(spark, sf_dir, "documents"), claimed={"n_chars": tampered}, with_proof=False)


@query("op12_alignment")
def op12_alignment(spark, sf_dir):
    """Tokens of the byte-level vocabulary aligned with those of the sentencepiece model over all documents."""
    return alignment.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"))


def _licenses_sql() -> str:
    wanted = [(n, label, len(ws), licenses.drift(len(ws)), p, w.decode())
              for n, (label, t) in enumerate(licenses.TEMPLATES) for ws in [licenses.words(t)] for p, w in enumerate(ws)]
    rows = ", ".join(f"({n}, '{label}', {size}, {drift}, {p}, '{w}')" for n, label, size, drift, p, w in wanted)
    ahead = " || ' ' || ".join(["word"] + [f"lead(word, {k}) OVER o" for k in range(1, licenses.GRAM)])
    base = " UNION ALL ".join(
        f"SELECT r, i, '{label}' AS label FROM (SELECT r, i, "
        + " || ' ' || ".join(["word"] + [f"lead(word, {k}) OVER o" for k in range(1, len(phrase.split()))])
        + f" AS phrase FROM ws WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE phrase = '{phrase}'"
        for phrase, label in licenses.PHRASES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
ws AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM d),
tw(t, label, size, drift, p, word) AS (VALUES {rows}),
tg AS (SELECT t, size, drift, p, {ahead} AS gram FROM tw WINDOW o AS (PARTITION BY t ORDER BY p)),
g AS (SELECT r, i, {ahead} AS gram FROM ws WINDOW o AS (PARTITION BY r ORDER BY i)),
v AS (SELECT r, t, i - p AS diag, any_value(drift) AS drift, any_value(size) AS size, count(DISTINCT p) AS votes
      FROM g JOIN tg USING (gram) GROUP BY r, t, i - p),
n AS (SELECT *, CASE WHEN diag - lag(diag) OVER (PARTITION BY r, t ORDER BY diag) > drift THEN 1 ELSE 0 END AS new FROM v),
k AS (SELECT *, sum(new) OVER (PARTITION BY r, t ORDER BY diag) AS run FROM n),
c AS (SELECT r, t, run, min(diag) AS low, max(diag) AS high FROM k GROUP BY r, t, run
      HAVING sum(votes) >= ceil({licenses.SHARE} * (any_value(size) - {licenses.GRAM - 1}))),
y AS (SELECT c.r, c.t, c.run, any_value(label) AS label,
        count(DISTINCT p) * 1.0::DOUBLE / (any_value(size) + any_value(high) - any_value(low)) AS likeness
      FROM c JOIN tw ON tw.t = c.t JOIN ws ON ws.r = c.r AND ws.word = tw.word
       AND ws.i - tw.p BETWEEN c.low AND c.high GROUP BY c.r, c.t, c.run),
ok AS (SELECT * FROM y WHERE likeness >= {licenses.SIMILAR} - 1e-12),
b AS ({base}),
bs AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY r),
al AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
       FROM (SELECT r, label FROM b UNION ALL SELECT r, label FROM ok) GROUP BY r),
sc AS (SELECT r, max(likeness) AS likeness FROM ok GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(likeness, 0.0) END, 9) AS score
FROM d LEFT JOIN bs USING (r) LEFT JOIN al USING (r) LEFT JOIN sc USING (r)
"""


@query("op13_licenses", _licenses_sql())
def op13_licenses(spark, sf_dir):
    """License notices of all documents."""
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
        F.round("score", 9).alias("score"))
