"""JDBC sources (S1, S5, S6): partitioned reads of a query over a database.

The staging query runs *inside* the source database, wrapped as a derived
table; Spark reads it in key-range chunks, one task and one connection per
chunk. Column pruning and simple filters on the resulting DataFrame are still
pushed into the generated SQL by Spark's JDBC source.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .bounds import KeyBounds, chunk_predicates
from .tables import SOURCE_PARTITION_KEYS, Loader

# Driver classes by URL protocol.
DRIVERS = {
    "postgresql": "org.postgresql.Driver",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "derby": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
}


@dataclass(frozen=True)
class JdbcEndpoint:
    """Connection coordinates of one database. ``url`` overrides host/port/db."""

    protocol: str
    database: str = ""
    host: str = ""
    port: int | None = None
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    url: str | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def jdbc_url(self) -> str:
        if self.url:
            return self.url
        port = f":{self.port}" if self.port else ""
        return f"jdbc:{self.protocol}://{self.host}{port}/{self.database}"

    def properties(self) -> dict[str, str]:
        props = dict(self.extra)
        if self.user is not None:
            props["user"] = self.user
        if self.password is not None:
            props["password"] = self.password
        props["driver"] = self.driver or DRIVERS.get(self.protocol, "")
        return {k: v for k, v in props.items() if v}


def derived_table(query: str, alias: str = "src") -> str:
    return f"({query.strip().rstrip(';')}) {alias}"


def _probe(spark: SparkSession, endpoint: JdbcEndpoint, query: str, key: str):
    """One row computed by the database: MIN, MAX of ``key`` and the row count."""
    probe = f"SELECT MIN({key}) AS lo, MAX({key}) AS hi, COUNT(*) AS n FROM {derived_table(query, 'q')}"
    return (
        spark.read.format("jdbc")
        .option("url", endpoint.jdbc_url())
        .option("dbtable", derived_table(probe, "bounds"))
        .options(**endpoint.properties())
        .load()
        .first()
    )


def jdbc_bounds(spark: SparkSession, endpoint: JdbcEndpoint, query: str, key: str) -> KeyBounds | None:
    """S2 over JDBC: MIN/MAX of ``key`` over the query, computed by the database."""
    row = _probe(spark, endpoint, query, key)
    if row is None or row[0] is None:
        return None
    return KeyBounds(int(row[0]), int(row[1]))


def chunks_for_rows(rows: int, chunk_rows: int) -> int:
    """Number of key-range chunks so that each holds about ``chunk_rows`` rows."""
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be >= 1")
    return max(1, -(-rows // chunk_rows))


def read_jdbc_chunked(
    spark: SparkSession,
    endpoint: JdbcEndpoint,
    query: str,
    key: str,
    chunk_rows: int = 1_000_000,
    fetch_size: int | None = None,
) -> DataFrame:
    """S1 + S4 by chunk *size*: one probe returns bounds and row count, then
    ``ceil(rows / chunk_rows)`` key-range chunks are read, one task each, so a
    task holds about ``chunk_rows`` rows (evenly so when keys are dense)."""
    row = _probe(spark, endpoint, query, key)
    if row is None or row[0] is None:
        return read_jdbc_query(spark, endpoint, query, key, 1, bounds=None, fetch_size=fetch_size, probe=False)
    bounds = KeyBounds(int(row[0]), int(row[1]))
    return read_jdbc_query(
        spark, endpoint, query, key, chunks_for_rows(int(row[2]), chunk_rows), bounds, fetch_size
    )


def read_jdbc_query(
    spark: SparkSession,
    endpoint: JdbcEndpoint,
    query: str,
    key: str,
    partitions: int,
    bounds: KeyBounds | None = None,
    fetch_size: int | None = None,
    probe: bool = True,
) -> DataFrame:
    """Read ``query`` in ``partitions`` key-range chunks (the S4 rule).

    Bounds are probed when not given (``probe=False``: the source is known to
    be empty). An empty source yields an empty DataFrame with the query's
    schema instead of failing on NULL bounds.
    """
    if bounds is None and probe:
        bounds = jdbc_bounds(spark, endpoint, query, key)
    props = endpoint.properties()
    if fetch_size:
        props["fetchsize"] = str(fetch_size)
    return spark.read.jdbc(
        url=endpoint.jdbc_url(),
        table=derived_table(query),
        predicates=chunk_predicates(key, bounds, partitions),
        properties=props,
    )


def read_jdbc_table(spark: SparkSession, endpoint: JdbcEndpoint, table: str) -> DataFrame:
    """Whole table in one partition (small dimension tables, tests)."""
    return spark.read.jdbc(url=endpoint.jdbc_url(), table=table, properties=endpoint.properties())


def jdbc_loader(
    spark: SparkSession,
    endpoint: JdbcEndpoint,
    partitions: int,
    schema: str | None = None,
    keys: dict[str, str] | None = None,
    chunk_rows: int | None = None,
) -> Loader:
    """A ``TableSet`` loader reading each source table in key-range chunks.

    ``SELECT * FROM [schema.]table`` is read by its partition key in
    ``partitions`` chunks, or in chunks of about ``chunk_rows`` rows when that
    is given; Spark still prunes columns and pushes simple filters into each
    chunk's SQL.
    """
    keys = keys or SOURCE_PARTITION_KEYS

    def load(name: str) -> DataFrame:
        table = f"{schema}.{name}" if schema else name
        if name not in keys:
            raise KeyError(f"no partition key known for {name}: one connection would read all of it; name one in ``keys``")
        if chunk_rows:
            return read_jdbc_chunked(spark, endpoint, f"SELECT * FROM {table}", keys[name], chunk_rows)
        return read_jdbc_query(spark, endpoint, f"SELECT * FROM {table}", keys[name], partitions)

    return load
