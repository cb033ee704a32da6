"""Parquet table sources (S1 for file sources, S7 table registry).

Tables are read lazily, so Catalyst prunes columns and pushes filters into the
parquet scan; nothing here reads data on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The TPC-H source tables the staging queries read, with the
# key each is read in ranges by (the jobs' partition keys, as source columns).
SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "partsupp", "orders", "lineitem")
SOURCE_PARTITION_KEYS = {
    "region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey",
    "supplier": "s_suppkey", "part": "p_partkey", "partsupp": "ps_partkey",
    "orders": "o_orderkey", "lineitem": "l_orderkey",
}

Loader = Callable[[str], DataFrame]
Maker = Callable[[SparkSession], DataFrame]


class MissingKeyColumn(ValueError):
    """A key column a job needs is absent from its source."""


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Lazily read ``{root}/{name}.parquet`` (a file or a folder of parts)."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


ARRIVAL = "_arrival"


def with_arrival(df: DataFrame, name: str = ARRIVAL) -> DataFrame:
    """A Parquet scan with the order in which its rows arrived: by file (time, then path) and row within it.

    From Spark's hidden ``_metadata``: no shuffle, no numbering of rows. Rows of
    one load file compare by place, those of a later file come after.
    """
    m = lambda field: F.col(f"_metadata.{field}")
    return df.select("*", F.struct(m("file_modification_time").alias("at"), m("file_path").alias("file"), m("row_index").alias("row")).alias(name))


class TableSet(Mapping[str, DataFrame]):
    """Name -> DataFrame view over source tables, loaded on first use.

    By default tables are parquet files under ``root``; ``loader`` replaces
    that (e.g. partitioned JDBC reads, see ``sources.jdbc.jdbc_loader``). An
    override is a DataFrame, or a function of the session that makes one: the
    latter follows the set into another session (``in_session``).
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        overrides: Mapping[str, DataFrame | Maker] | None = None,
        loader: Loader | None = None,
    ):
        self.spark = spark
        self.root = root
        self.loader = loader
        self._given = dict(overrides or {})
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames and name in self._given:
            given = self._given[name]
            self._frames[name] = given(self.spark) if callable(given) else given
        if name not in self._frames and name.startswith("staging."):
            raise KeyError(
                f"{name} is produced by job {name.split('.', 1)[1]!r} in the same run; "
                "run it first (run_jobs pulls dependencies in)"
            )
        if name not in self._frames:
            if self.loader is not None:
                self._frames[name] = self.loader(name)
            else:
                self._frames[name] = read_table(self.spark, self.root, name)
        return self._frames[name]

    def __iter__(self):
        return iter({**self._given, **self._frames})

    def __len__(self) -> int:
        return len({**self._given, **self._frames})

    def with_table(self, name: str, df: DataFrame | Maker) -> "TableSet":
        more = TableSet(self.spark, self.root, {**self._given, name: df}, self.loader)
        more._frames = {k: v for k, v in self._frames.items() if k != name}
        return more

    def in_session(self, spark: SparkSession) -> "TableSet":
        """The same tables read by another session, whose settings then hold for them."""
        return TableSet(spark, self.root, self._given, self.loader)


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The names that exist in ``df``, in the given order.

    Case-insensitive, like Spark's default column resolution: databases that
    upper-case unquoted identifiers still match.
    """
    have = {c.lower() for c in df.columns}
    return [n for n in names if n.lower() in have]


def require(df: DataFrame, names: Iterable[str], what: str = "source") -> None:
    have = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in have]
    if missing:
        raise MissingKeyColumn(f"{what} lacks key column(s) {missing}; has {df.columns}")
