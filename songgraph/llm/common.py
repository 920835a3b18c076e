"""Small helpers shared by the operators: table reads, folds, Arrow mapping."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songgraph.session import materialize  # noqa: F401  (written tables in the shared folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: str, n: int):
    """crc32 of the id as text, modulo ``n``: the fold an id belongs to."""
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(n))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application (``addPyFile``), so a
    job also runs where the executors' PYTHONPATH does not have it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="songgraph-code-")
    sources = shutil.copytree(os.path.join(root, "songgraph"), os.path.join(folder, "src", "songgraph"),
                              ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(
        os.path.join(folder, "songgraph-code"), "zip", os.path.dirname(sources)))
    _SHIPPED.add(app)


def map_rows(df: DataFrame, fn: Callable[[list[dict]], dict[str, list]], schema: str,
             rows: int = 256, lists: bool = True) -> DataFrame:
    """Run ``fn`` over the rows of each partition in blocks of ``rows``: it gets the
    columns as lists (as Arrow arrays without ``lists``) and returns the output columns as
    lists or arrays. Blocks keep a task's Python memory bounded by a few hundred texts
    whatever the partition holds."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema
    ship_package(df.sparkSession)
    out = to_arrow_schema(_parse_datatype_string(schema))
    # columns travel by position: names may hold dots or repeat the output's
    given, made = df.columns, out.names
    plain = pa.schema([pa.field(f"c{n}", f.type) for n, f in enumerate(out)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                cols = fn({n: part.column(k).to_pylist() if lists else part.column(k) for k, n in enumerate(given)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[n], type=f.type) for n, f in zip(made, plain)], schema=plain)

    kinds = ", ".join(f"c{n} {f.dataType.simpleString()}" for n, f in enumerate(_parse_datatype_string(schema)))
    return df.toDF(*[f"c{n}" for n in range(len(given))]).mapInArrow(run, kinds).toDF(*made)


def map_runs(df: DataFrame, by: str, order: str, fn: Callable[[dict], Iterator[dict]], schema: str) -> DataFrame:
    """Bring the rows of each value of the integer column ``by`` together, in the order of
    ``order``, and run ``fn`` over them: it gets the columns as numpy arrays that hold whole
    values of ``by`` one after the other, and yields output columns."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema
    ship_package(df.sparkSession)
    out, names = to_arrow_schema(_parse_datatype_string(schema)), df.columns
    at = names.index(by)

    def made(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if held:
            rows = pa.Table.from_batches(held)
            for cols in fn({n: rows.column(k).to_numpy() for k, n in enumerate(names)}):
                yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in out], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None           # the rows of the last value, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(at).to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut or key[0] != last:
                yield from made([*held, *([batch.slice(0, cut)] if cut else [])])
                held = []
            held.append(batch.slice(cut))
            last = key[-1]
        yield from made(held)

    return df.repartition(by).sortWithinPartitions(by, order).mapInArrow(run, schema)


def thin(df: DataFrame, by, wanted: int) -> DataFrame:
    """About ``wanted`` rows (all, if there are fewer) with the smallest hashes of the
    column ``by``: a bounded share is cut off before any row moves."""
    share = int(min(1.0, 1.2 * wanted / max(1, df.count())) * (1 << 30))
    return df.where(F.pmod(F.xxhash64(by, F.lit(17)), F.lit(1 << 30)) < share)


def sample_ids(labels: DataFrame, key: str, limit: int) -> DataFrame:
    """At most ``limit`` rows of ``labels``, chosen by a hash of the id (stable under
    row order). The bound makes the result safe to broadcast."""
    return thin(labels, F.col(key), limit).orderBy(
        F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1 << 30)), F.col(key)).limit(limit)


MOST_BITS = 1 << 28         # of a bit set: 32 MB, collected as 8 million numbers in Arrow form


def id_filter(ids: DataFrame, key: str) -> np.ndarray:
    """A bit set that marks the remainders of the given integer ids (a written table);
    what it lets through still needs an exact join. It has eight bits or more for each
    row, from 2^16 up to MOST_BITS; beyond 30 million ids it lets more and more through,
    which costs shuffled rows only."""
    bits = 1 << min(max((8 * ids.count()).bit_length(), 16), MOST_BITS.bit_length() - 1)
    at = F.pmod(F.col(key), F.lit(bits))
    words = (ids.select((at / 32).cast("int").alias("w"), (at % 32).cast("int").alias("r"))
             .groupBy("w").agg(F.expr("bit_or(shiftleft(1L, r))").alias("v"))).toArrow()
    out = np.zeros(bits // 32, np.uint32)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy()
    return out


def may_hold(bits: np.ndarray, ids) -> np.ndarray:
    """Which of the ids (integers; in a list, None never) the bit set lets through."""
    if isinstance(ids, np.ndarray):
        at = ids % (32 * len(bits))
        return ((bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1) == 1
    at = np.array([0 if i is None else i for i in ids], np.int64) % (32 * len(bits))
    return (((bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1) == 1) \
        & np.array([i is not None for i in ids], bool)
