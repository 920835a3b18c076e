"""SQL text over tables given by path, by workspace, or as DataFrames (SRC4).

A ``Workspace`` names folders and says how files are read: the extension of a path
picks a format and its options, a folder may have a default format for paths without
a known extension, and a table may have a declared schema. ``query`` takes the
caller's own statement; nothing is registered globally, and Catalyst plans the text
like DataFrame code (filters and columns reach the scans).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from songgraph.sources.files import read_table

# extension -> (format, options)
FORMATS: dict[str, tuple[str, dict[str, str]]] = {
    "parquet": ("parquet", {}),
    "avro": ("avro", {}),
    "orc": ("orc", {}),
    "json": ("json", {}),
    "csv": ("csv", {"header": "true"}),
    "tsv": ("csv", {"header": "true", "sep": "\t"}),
}


@dataclass
class Workspace:
    """``folders``: name -> root path. ``defaults``: name -> extension whose format is
    taken for a path without a known one. ``formats``: extension -> (format, options).
    ``schemas``: table path as written in a query (``name:path``) -> DDL; without one
    a CSV's columns are strings (no second pass over the data to guess types)."""
    spark: SparkSession
    folders: dict[str, str]
    defaults: dict[str, str] = field(default_factory=dict)
    formats: dict[str, tuple[str, dict[str, str]]] = field(default_factory=lambda: dict(FORMATS))
    schemas: dict[str, str] = field(default_factory=dict)

    def resolve(self, table: str) -> tuple[str, str, dict[str, str]]:
        """The path, format and options of ``name:path``; a path without a known
        workspace name is taken as it is."""
        name, colon, rest = table.partition(":")
        known = bool(colon) and name in self.folders
        path = f"{self.folders[name].rstrip('/')}/{rest.lstrip('/')}" if known else table
        ext = path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2].lower()
        if ext not in self.formats:
            ext = self.defaults.get(name if known else "", "")
            if ext not in self.formats:
                raise ValueError(f"no format for {table!r}: give it an extension of {sorted(self.formats)} "
                                 "or its workspace a default")
        fmt, options = self.formats[ext]
        return path, fmt, options

    def table(self, table: str) -> DataFrame:
        path, fmt, options = self.resolve(table)
        return read_table(self.spark, path, fmt, self.schemas.get(table), options=options)

    def query(self, statement: str, **tables: DataFrame | str) -> DataFrame:
        """Run ``statement``, which names each table as ``{name}``."""
        frames = {k: self.table(t) if isinstance(t, str) else t for k, t in tables.items()}
        return self.spark.sql(statement, **frames)


def query(spark: SparkSession, statement: str, **tables: DataFrame | str) -> DataFrame:
    """``Workspace.query`` without named folders: a table given as a string is a path
    whose extension says how it is read."""
    return Workspace(spark, {}).query(statement, **tables)
