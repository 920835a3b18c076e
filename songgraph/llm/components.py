"""Connected components of an edge table, and of bucketed candidates. Components come by label propagation with pointer jumping.

Every round a node takes the least label among its neighbours and then the label of its
label; each round's labels are a written table. Minima are pre-aggregated before the
shuffle, and the joins have one label per node, so a hub splits over tasks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songgraph.llm.common import id_filter, materialize
from songgraph.session import scratch


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of ``edges`` (two columns of one type, not null), label being the
    least node of its component. ``edges`` must be a written table. Loops and repeated
    edges do no harm; without edges the result is empty."""
    with scratch(edges.sparkSession) as own:
        both = materialize(edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
                           .union(edges.select(F.col(b), F.col(a))).where("node <> other").distinct(), "links")
        labels = materialize(both.groupBy("node").agg(F.min("other").alias("other"))
                             .select("node", F.least("node", "other").alias("label")), "labels")
        while True:
            near = (both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("theirs")), "other")
                    .groupBy("node").agg(F.min("theirs").alias("theirs")))
            step = materialize(labels.join(near, "node").select(
                "node", F.col("label").alias("old"), F.least("label", "theirs").alias("label")), "labels")
            jump = step.select(F.col("node").alias("label"), F.col("label").alias("root"))
            last, labels = labels, materialize(step.join(jump, "label").select(
                "node", F.least("label", "root").alias("label"),
                ((F.col("old") != F.least("label", "root"))).alias("moved")), "labels")
            own.free(last, step)
            if labels.where("moved").isEmpty():
                return own.keep(labels).drop("moved")


def _identity(pairs: DataFrame) -> DataFrame:
    return pairs


def cluster(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame],
            prune: Callable[[DataFrame], DataFrame] = _identity,
            within: Callable[[DataFrame], DataFrame] | None = None,
            links: DataFrame | None = None, mark: str | None = None,
            near: Callable[[Column, Column], Column] | None = None,
            narrow: Callable[[np.ndarray], DataFrame] | None = None) -> DataFrame:
    """Components of the verified links between nodes that share a bucket.

    ``buckets`` has rows (band, node): candidates are the pairs of a band.
    ``prune`` and ``verify`` take a table of pairs (a, b) with a < b and return those that
    may be links and those that are. ``mark`` names a column of ``buckets`` and ``near`` a
    condition on two of its values that every link fulfils: other pairs are not proposed.
    ``links`` adds given links. ``narrow`` gives the rows of ``buckets`` whose bands pass
    a bit set, so that buckets of one node need not move again.

    No bucket emits all its pairs. First every member is proposed to the bucket's least
    node. Nodes joined by pairs that survive pruning are a crowd; ``within`` gets the
    members of the crowds that still hold several components (node, crowd, part) and
    returns the links between the components, comparing in blocks. Last, a bucket's members outside its least
    node's component are proposed to the members of other components and other crowds.
    So every pair of a bucket is checked or inside one component, and no two components
    have a link. Returns a written table (node, label) of the linked nodes."""
    with scratch(buckets.sparkSession) as own:
        value = F.col(mark) if mark else F.lit(0)
        alike = near if near else (lambda x, y: F.lit(True))

        def rows(df):
            return df.select("band", "node", value.alias("mark"))

        least = [F.min("node").alias("leader"), F.max("node").alias("last")]
        if narrow:      # the marks travel with the rows of crowded bands only
            ends = materialize(buckets.groupBy("band").agg(*least).where("leader < last")
                               .select("band", "leader"), "crowded-bands")
            own_rows = rows(narrow(id_filter(ends, "band"))).join(ends, "band")
            own_rows = materialize(own_rows, "bucket-rows")
            lead = own_rows.where("node = leader").groupBy("band").agg(F.min("mark").alias("lead_mark"))
            crowded = materialize(own_rows.join(lead, "band"), "buckets")
        else:
            ends = rows(buckets).groupBy("band").agg(*least, F.min_by("mark", "node").alias("lead_mark")) \
                .where("leader < last").select("band", "leader", "lead_mark")
            crowded = materialize(rows(buckets).join(ends, "band"), "buckets")
        star = (crowded.where("leader < node").where(alike(F.col("mark"), F.col("lead_mark")))
                .select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct())
        close = materialize(prune(star), "close-pairs")
        found = verify(close)
        if links is not None:
            found = found.union(links.select("a", "b"))
        found = materialize(found, "first-links")
        labels = components(found)
        mine = labels.select("node", F.col("label").alias("part"))
        leads = labels.select(F.col("node").alias("leader"), F.col("label").alias("main"))
        tagged = (crowded.join(mine, "node", "left").join(leads, "leader", "left")
                  .select("band", "node", "leader", "mark", F.coalesce("part", "node").alias("part"),
                          F.coalesce("main", "leader").alias("main")))
        inner = None
        if within:
            crowds = components(close).withColumnRenamed("label", "crowd")
            members = crowds.join(mine, "node", "left").withColumn("part", F.coalesce("part", "node"))
            inner = within(materialize(members, "crowds"))
            tagged = tagged.join(crowds, "node", "left")
        else:
            tagged = tagged.withColumn("crowd", F.lit(None).cast("long"))
        tagged = materialize(tagged, "bucket-parts")
        minor = tagged.where("part <> main").select(
            "band", F.col("node").alias("x"), F.col("part").alias("px"), F.col("mark").alias("mx"),
            F.col("crowd").alias("cx"))
        rest = tagged.where("node <> leader").select("band", "node", "part", "mark", "crowd",
                                                     (F.col("part") == F.col("main")).alias("large"))
        more = verify(materialize(prune(        # two minor members meet once
            minor.join(rest, (minor["band"] == rest["band"]) & (F.col("px") != F.col("part"))
                       & (F.col("large") | (F.col("x") < F.col("node")))
                       & ~F.coalesce(F.col("cx") == F.col("crowd"), F.lit(False))
                       & alike(F.col("mx"), F.col("mark")))
            .select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()), "late-pairs"))
        tree = labels.where("node <> label").select(F.col("label").alias("a"), F.col("node").alias("b"))
        if inner is not None:
            more = more.union(inner)
        return own.keep(components(materialize(tree.union(more), "all-links")))
