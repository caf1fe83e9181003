"""JDBC source and sink settings, one table instead of one class per database."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from millrace.operators.filters import moment_text

FETCH_SIZE = 200_000
READ_PARTITIONS = 100


@dataclass(frozen=True)
class Dialect:
    """``query_as_table`` wraps a query as ``(q) t`` where ``query`` is unsupported."""

    url: str
    driver: str
    query_as_table: bool = False
    ssl: tuple[tuple[str, str], ...] = ()
    unverified: tuple[tuple[str, str], ...] = ()
    truncate: bool = False


# fixed values: URL shapes and driver classes of the supported databases
DIALECTS = {
    "oracle": Dialect("jdbc:oracle:thin:@{host}:{port}:{dbname}", "oracle.jdbc.driver.OracleDriver", query_as_table=True),
    "db2": Dialect("jdbc:db2://{host}:{port}/{dbname}", "com.ibm.db2.jcc.DB2Driver", query_as_table=True),
    "postgres": Dialect(
        "jdbc:postgresql://{host}:{port}/{dbname}",
        "org.postgresql.Driver",
        ssl=(("ssl", "true"), ("sslmode", "verify-full")),
        unverified=(("ssl", "true"), ("sslmode", "require"), ("sslfactory", "org.postgresql.ssl.NonValidatingFactory")),
        truncate=True,
    ),
    "sybase": Dialect("jdbc:sybase:Tds:{host}:{port}/{dbname}?", "com.sybase.jdbc4.jdbc.SybDriver"),
    "sqlserver": Dialect(
        "jdbc:sqlserver://{host}:{port};databaseName={dbname}",
        "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        ssl=(("encrypt", "true"), ("trustServerCertificate", "false")),
        unverified=(("encrypt", "true"), ("trustServerCertificate", "true")),
    ),
    "mysql": Dialect("jdbc:mysql://{host}:{port}/{dbname}", "com.mysql.jdbc.Driver"),
}


def connection_options(dialect: str, connection: Mapping[str, str]) -> dict[str, str]:
    """URL, driver and login.

    ``ssl`` in the connection asks for an encrypted and verified one; only
    ``ssl_unverified`` leaves the server's certificate unchecked.
    """
    kind = DIALECTS[dialect.lower()]
    options = {
        "url": connection.get("url") or kind.url.format(**connection),
        "driver": connection.get("driver") or kind.driver,
    }
    if "username" in connection:
        options["user"] = connection["username"]
    if "password" in connection:
        options["password"] = connection["password"]
    if connection.get("ssl_unverified"):
        options.update(kind.unverified)
    elif connection.get("ssl"):
        options.update(kind.ssl)
    return options


def read_options(
    dialect: str,
    connection: Mapping[str, str],
    query: str | None = None,
    table: str | None = None,
    partition_col: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    num_partitions: int = READ_PARTITIONS,
) -> dict[str, str]:
    if (query is None) == (table is None):
        raise ValueError("name a query or a table")
    options = {**connection_options(dialect, connection), "fetchsize": str(FETCH_SIZE)}
    # a range-partitioned read needs ``dbtable`` on every database
    if table is not None:
        options["dbtable"] = table
    elif DIALECTS[dialect.lower()].query_as_table or partition_col:
        options["dbtable"] = f"({query}) t"
    else:
        options["query"] = query
    if partition_col:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs both bounds")
        options.update(
            partitionColumn=partition_col, lowerBound=str(int(lower)), upperBound=str(int(upper)),
            numPartitions=str(num_partitions),
        )
    return options


def bounds_query(partition_col: str, query: str | None = None, table: str | None = None) -> str:
    """The statement that finds the range of the partition column."""
    origin = table if table is not None else f"({query}) t"
    return f"select min({partition_col}) as lower_bound, max({partition_col}) as upper_bound from {origin}"


def partition_bounds(df: DataFrame, partition_col: str, num_partitions: int = READ_PARTITIONS) -> DataFrame:
    """Range settings of a partitioned read: whole-number bounds and the stride."""
    ends = df.agg(
        F.min(partition_col).cast("bigint").alias("lower_bound"), F.max(partition_col).cast("bigint").alias("upper_bound")
    )
    return ends.select(
        F.lit(partition_col).alias("partition_column"), "lower_bound", "upper_bound", F.lit(num_partitions).alias("num_partitions")
    )


def literal(value) -> str:
    """A value as SQL text that every dialect here reads."""
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{moment_text(value)}'"
    if isinstance(value, dt.date):
        return f"DATE '{value}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def depth_query(partition_col: str, parts: int, query: str | None = None, table: str | None = None) -> str:
    """The statement that finds the first value of each of ``parts`` equally filled parts; the database keeps its rows."""
    origin = table if table is not None else f"({query}) t"
    tiles = f"select {partition_col} as v, ntile({parts}) over (order by {partition_col}) as part from {origin} where {partition_col} is not null"
    return f"select part, min(v) as low from ({tiles}) p group by part order by part"


def depth_points(df: DataFrame, partition_col: str, parts: int) -> list:
    """The same values of a frame's column, by a quantile sketch: one pass, no exchange of rows."""
    shares = F.array(*[F.lit(k / parts) for k in range(1, parts)])
    return df.agg(F.percentile_approx(f"`{partition_col}`", shares, F.lit(100 * parts))).first()[0] or []


def depth_predicates(partition_col: str, points: Iterable) -> list[str]:
    """Disjoint predicates, one per read, that together hold every row.

    ``points`` are where a part begins, in order; a value that begins several
    parts fills them alone and gets a read of its own.  Nulls do, too.
    """
    points = [p for p in points if p is not None]
    c, made, low = partition_col, [], None
    for value in sorted(set(points)):
        heavy = points.count(value) > 1
        bound = literal(value)
        made.append(f"{low[0]} AND {c} < {bound}" if low else f"{c} < {bound}")
        if heavy:
            made.append(f"{c} = {bound}")
        low = (f"{c} > {bound}" if heavy else f"{c} >= {bound}",)
    made.append(low[0] if low else f"{c} IS NOT NULL")
    return [*made, f"{c} IS NULL"]


def partition_depths(df: DataFrame, partition_col: str, predicates: Sequence[str]) -> DataFrame:
    """One row: reads, rows they hold together, rows of the largest, rows that not exactly one read holds, in one pass over ``df``."""
    hits = [F.coalesce(F.expr(p), F.lit(False)) for p in predicates]
    together = sum((h.cast("int") for h in hits[1:]), hits[0].cast("int"))
    one = df.agg(*[F.count_if(h).alias(f"n{k}") for k, h in enumerate(hits)], F.count_if(together != 1).alias("astray"))
    counts = [F.col(f"n{k}") for k in range(len(hits))]
    return one.select(
        F.lit(partition_col).alias("partition_column"), F.lit(len(hits)).alias("reads"), sum(counts[1:], counts[0]).alias("covered"),
        F.greatest(*counts[:-1]).alias("largest"), counts[-1].alias("null_rows"), "astray",
    )


def read_jdbc(
    spark: SparkSession,
    dialect: str,
    connection: Mapping[str, str],
    query: str | None = None,
    table: str | None = None,
    partition_col: str | None = None,
    num_partitions: int = READ_PARTITIONS,
    balanced: bool = False,
) -> DataFrame:
    """Read by query or table, in parallel ranges when a partition column is named.

    Ranges are of equal width; ``balanced`` ones hold about as many rows each,
    however the column is distributed.  An empty source (null bounds) falls back to
    a plain read.
    """

    def load(**chosen) -> DataFrame:
        reader: DataFrameReader = spark.read.format("jdbc")
        return reader.options(**read_options(dialect, connection, **chosen)).load()

    if partition_col and balanced:
        points = [r[1] for r in load(query=depth_query(partition_col, num_partitions, query, table)).collect()]
        options = read_options(dialect, connection, table=table if table is not None else f"({query}) t")
        url, origin = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, origin, predicates=depth_predicates(partition_col, points[1:]), properties=options)
    if partition_col:
        ends = load(query=bounds_query(partition_col, query, table)).first()
        if ends[0] is not None:
            return load(
                query=query, table=table, partition_col=partition_col, lower=int(ends[0]), upper=int(ends[1]),
                num_partitions=num_partitions,
            )
    return load(query=query, table=table)


def lookup_query(schema: str, table: str, natural_keys: list[str], surrogate: str) -> str:
    """The statement that reads a lookup table for ``surrogate_lookup``."""
    return f"select {', '.join([*natural_keys, surrogate])} from {schema}.{table}"


def write_options(dialect: str, connection: Mapping[str, str], table: str, truncate: bool | None = None) -> dict[str, str]:
    keep = DIALECTS[dialect.lower()].truncate if truncate is None else truncate
    options = {**connection_options(dialect, connection), "dbtable": table}
    if keep:
        options["truncate"] = "true"
    return options


def write_jdbc(
    df: DataFrame, dialect: str, connection: Mapping[str, str], table: str, truncate: bool | None = None
) -> None:
    """Overwrite a table; where the dialect says so it is emptied, not dropped."""
    df.write.format("jdbc").mode("overwrite").options(**write_options(dialect, connection, table, truncate)).save()
