"""Exact top-k search by BM25 with block-max WAND, run per shard and merged.

One pass over the documents gathers the global statistics that BM25 needs: the number
of documents, their mean length, and the document frequencies of the queries' terms.
Then every shard (a bounded number of documents) builds an inverted index of those
terms, its postings cut into blocks that know their largest score, and answers all
queries: WAND moves the terms' cursors to the first document whose summed upper bounds
can still enter the shard's top k, the blocks' own maxima are tried before anything is
scored, and whole blocks are skipped when they cannot. Scores use the global
statistics, so the best k of all shards' answers are the exact top k.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songgraph.llm.common import map_rows

K1, B = 1.2, 0.75
BLOCK = 64
_WORD = re.compile(r"[^\W_]+")


def terms(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Shard:
    """Inverted index of some documents over a vocabulary."""

    def __init__(self, docs: list[tuple[int, list[str]]], idf: dict[str, float], mean: float):
        self.ids = [i for i, _ in docs]
        posts: dict[str, tuple[list, list]] = defaultdict(lambda: ([], []))
        for n, (_, words) in enumerate(docs):
            norm = K1 * (1 - B + B * len(words) / mean) if mean else K1
            for t, c in Counter(w for w in words if w in idf).items():
                posts[t][0].append(n)
                posts[t][1].append(idf[t] * c * (K1 + 1) / (c + norm))
        self.docs = {t: p[0] for t, p in posts.items()}
        self.score = {t: p[1] for t, p in posts.items()}
        self.tops = {t: [max(s[i:i + BLOCK]) for i in range(0, len(s), BLOCK)] for t, s in self.score.items()}
        self.lasts = {t: [d[min(i + BLOCK, len(d)) - 1] for i in range(0, len(d), BLOCK)]
                      for t, d in self.docs.items()}

    def search(self, query: dict[str, int], k: int) -> list[tuple[float, int]]:
        """The k best (score, id), larger scores first and then smaller ids. ``query`` maps
        each term to its count."""
        lists = [(t, q) for t, q in query.items() if t in self.docs]
        docs = [self.docs[t] for t, _ in lists]
        score = [self.score[t] for t, _ in lists]
        many = [q for _, q in lists]
        tops, lasts = [self.tops[t] for t, _ in lists], [self.lasts[t] for t, _ in lists]
        most = [q * max(x) for q, x in zip(many, tops)]
        at = [0] * len(lists)
        heap: list[tuple[float, int]] = []      # (score, -id), the worst first
        live = sorted(range(len(lists)), key=lambda j: docs[j][0])
        while live:
            floor = heap[0][0] if len(heap) == k else -math.inf
            # the pivot: the first document whose terms' bounds reach the floor
            bound, p = 0.0, -1
            for n, j in enumerate(live):
                bound += most[j]
                if bound * (1 + 1e-12) >= floor:
                    p = n
                    break
            if p < 0:
                break
            pivot = docs[live[p]][at[live[p]]]
            while p + 1 < len(live) and docs[live[p + 1]][at[live[p + 1]]] == pivot:
                p += 1
            # the blocks that would hold the pivot
            block, end = 0.0, len(self.ids)
            for j in live[:p + 1]:
                b = at[j] // BLOCK
                while b < len(lasts[j]) and lasts[j][b] < pivot:
                    b += 1
                if b < len(lasts[j]):
                    block += many[j] * tops[j][b]
                    end = min(end, lasts[j][b] + 1)
            if block * (1 + 1e-12) >= floor:
                moved = live[:p + 1]
                if docs[moved[0]][at[moved[0]]] == pivot:
                    total = sum(many[j] * score[j][at[j]] for j in sorted(moved))
                    entry = (total, -self.ids[pivot])
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    elif entry > heap[0]:
                        heapq.heapreplace(heap, entry)
                    target = pivot + 1
                else:
                    target = pivot
                    moved = [j for j in moved if docs[j][at[j]] < pivot]
            else:           # none of these blocks' documents can enter
                moved = live[:p + 1]
                if p + 1 < len(live):
                    end = min(end, docs[live[p + 1]][at[live[p + 1]]])
                target = max(end, pivot + 1)
            for j in moved:
                at[j] = _advance(docs[j], at[j], target, lasts[j])
            live = sorted((j for j in live if at[j] < len(docs[j])), key=lambda j: docs[j][at[j]])
        return [(s, -i) for s, i in sorted(heap, reverse=True)]


def _advance(docs: list[int], at: int, target: int, lasts: list[int]) -> int:
    """The first position at or after ``at`` of a document >= target: whole blocks first."""
    b = at // BLOCK
    if b < len(lasts) and lasts[b] < target:
        while b < len(lasts) and lasts[b] < target:
            b += 1
        at = b * BLOCK
    while at < len(docs) and docs[at] < target:
        at += 1
    return at


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
          query_key: str = "query_id", query_text: str = "query", shard: int = 4096) -> DataFrame:
    """One row per query and rank: query_id, rank (from 1), the document's key, score.

    ``queries`` is a stated query set and goes to every shard; it must be small enough
    for that. Queries with a null id or without any known term have no rows; a document
    without any term of a query is no answer to it. Documents with a null id are counted
    in the statistics but not returned; repeated rows are separate answers. Equal scores
    are ranked by the smaller id. Other columns are ignored."""
    asked = [(r[0], Counter(terms(r[1]))) for r in
             queries.select(query_key, query_text).where(F.col(query_key).isNotNull()).collect()]
    vocabulary = sorted({t for _, q in asked for t in q})
    number = {t: n for n, t in enumerate(vocabulary)}

    def count(cols):
        df, size = np.zeros(len(vocabulary), np.int64), 0
        for t in cols[text]:
            words = terms(t)
            size += len(words)
            hit = {number[w] for w in set(words) & number.keys()}
            df[list(hit)] += 1
        return {"n": [len(cols[text])], "size": [size], "df": [df.tolist()]}

    got = map_rows(docs.select(text), count, "n long, size long, df array<long>", rows=4096)
    sums = got.select("n", "size", F.posexplode("df").alias("t", "c")).groupBy("t").agg(
        F.sum("c").alias("c"), F.sum("n").alias("n"), F.sum("size").alias("size")).collect()
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    qkind = queries.schema[query_key].dataType.simpleString()
    schema = f"`{query_key}` {qkind}, `{key}` {kinds[key]}, score double"
    if not sums:
        return docs.sparkSession.createDataFrame([], f"`{query_key}` {qkind}, rank int, `{key}` {kinds[key]}, score double")
    total, size = sums[0]["n"], sums[0]["size"]
    idf = {vocabulary[r["t"]]: math.log(1 + (total - r["c"] + .5) / (r["c"] + .5)) for r in sums if r["c"]}
    mean = size / max(total, 1)

    def search(cols):
        index = Shard([(i, terms(t)) for i, t in zip(cols[key], cols[text]) if i is not None], idf, mean)
        out = {query_key: [], key: [], "score": []}
        for q, words in asked:
            for s, i in index.search(words, k):
                out[query_key].append(q)
                out[key].append(i)
                out["score"].append(s)
        return out

    best = map_rows(docs.select(key, text), search, schema, rows=shard)
    rank = F.row_number().over(Window.partitionBy(query_key).orderBy(F.desc("score"), key))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select(query_key, "rank", key, "score")
