"""Servers, tables and dictionaries by name, and the import of a folder's tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.dictionary import Dictionary
from quarry.operators.engines import Collapsing, final_replacing
from quarry.sources import settings as S
from quarry.sources.types import schema_of


@dataclass
class Server:
    """Where tables are, and with what options."""

    name: str
    options: dict[str, str] = field(default_factory=dict)
    users: dict[str, dict[str, str]] = field(default_factory=dict, repr=False)
    cloud_suffixes: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        self.options = S.validated(self.options, S.SERVER_KEYS, "server")
        self.options.setdefault("driver", "http")
        self.options.setdefault("host", "localhost")
        self.options.setdefault("port", str(S.default_port(self.options["driver"], self.options["host"], self.cloud_suffixes)))

    def user_mapping(self, name: str, **options: str) -> None:
        self.users[name] = S.validated(options, S.USER_KEYS, "user mapping")


@dataclass
class Table:
    """A table's files, its schema and the options that change how it is read."""

    name: str
    path: str
    schema: T.StructType
    options: dict[str, str] = field(default_factory=dict)
    renamed: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.options = S.validated(self.options, S.TABLE_KEYS, "table")

    @property
    def collapsing(self) -> Collapsing | None:
        engine = self.options.get("engine", "")
        return Collapsing.parse(engine) if engine.startswith("Collapsing") else None


class Catalog:
    """Named tables of a session; each is also a temporary view. Servers whose host ends in one of cloud_suffixes are reached over the encrypted port unless one is given."""

    def __init__(self, spark: SparkSession, cloud_suffixes: tuple[str, ...] = ()) -> None:
        self.spark, self.cloud_suffixes = spark, cloud_suffixes
        self.servers: dict[str, Server] = {}
        self.tables: dict[str, Table] = {}
        self.dictionaries: dict[str, Dictionary] = {}
        self.session = S.Session()
        self._clients: dict[tuple[str, str], object] = {}

    def create_server(self, name: str, **options: str) -> Server:
        self.servers[name] = Server(name, options, cloud_suffixes=self.cloud_suffixes)
        return self.servers[name]

    def alter_server(self, name: str, user: str | None = None, **options: str) -> None:
        """Change a server's options, or with user a user's; clients made before are forgotten."""
        server = self.servers[name]
        if user is None:
            server.options |= S.validated(options, S.SERVER_KEYS, "server")
        else:
            server.users[user] = server.users.get(user, {}) | S.validated(options, S.USER_KEYS, "user mapping")
        for key in [k for k in self._clients if k[0] == name]:
            del self._clients[key]

    def _remote_options(self, server: str, user: str) -> dict[str, str]:
        s = self.servers[server]
        scheme = "https" if s.options["port"] in ("8443", "443") else "http"
        mapping = s.users.get(user, {})
        settings = ", ".join(f"{k} '{v}'" for k, v in self.session.values.items())
        return {"url": f"{scheme}://{s.options['host']}:{s.options['port']}/", "settings": settings} | {k: v for k, v in mapping.items()}

    def connect(self, server: str, user: str = "default"):
        """The client of a server and user, made once until either changes."""
        from quarry.sources.http import Client

        if (server, user) not in self._clients:
            self._clients[server, user] = Client(self._remote_options(server, user))
        return self._clients[server, user]

    def remote_table(
        self, server: str, table: str, columns: list[tuple[str, str]] | T.StructType, user: str = "default", query: str | None = None,
        where: str | None = None, limit: int | None = None, split: tuple[str, int, int, int] | None = None,
    ) -> DataFrame:
        """A table, or a query, that a server answers over HTTP; the settings of the session go with it.

        The server selects the columns, applies `where` (a condition in its words) and cuts each task's answer to limit
        rows, of which limit remain in all; later filters, joins and aggregates are Spark's unless the query has them.
        split: (whole-number column, lower, upper, tasks).
        """
        from quarry.sources.http import HttpSql

        self.spark.dataSource.register(HttpSql)
        schema = columns if isinstance(columns, T.StructType) else schema_of(columns)
        nullable = T.StructType([T.StructField(c.name, c.dataType, True) for c in schema])
        options = {"table": table} | self._remote_options(server, user) | {k: v for k, v in (("query", query), ("where", where)) if v}
        if limit is not None:
            options["limit"] = str(int(limit))
        if split:
            options |= dict(zip(("partition_column", "lower", "upper", "partitions"), map(str, split)))
        found = self.spark.read.format("http_sql").schema(nullable).options(**options).load()
        return found if limit is None else found.limit(limit)

    def import_remote(self, server: str, database: str, user: str = "default", limit_to: list[str] | None = None, except_: list[str] | None = None, prefix: str = "") -> list[str]:
        """Make views of the tables of a server's database, their types read from its list of columns; those named `.inner*` are left out."""
        if limit_to is not None and except_ is not None:
            raise ValueError("limit_to and except_ exclude each other")
        from quarry.sources.http import _unescaped, quoted

        sql = f"select table, name, type from system.columns where database = {quoted(database)} order by table, position"
        with self.connect(server, user).open(sql) as answer:
            lines = [[_unescaped(x) for x in line.decode().rstrip("\n").split("\t")] for line in answer]
        columns: dict[str, list[tuple[str, str]]] = {}
        for table, name, kind in lines:
            if not table.startswith(".inner") and (limit_to is None or table in limit_to) and table not in (except_ or ()):
                columns.setdefault(table, []).append((name, kind))
        for table, listed in columns.items():
            self.remote_table(server, f"{database}.{table}", listed, user).createOrReplaceTempView(prefix + table)
        return [prefix + table for table in columns]

    def remote_insert(self, df: DataFrame, server: str, table: str, user: str = "default") -> None:
        """Append rows to a table of a server."""
        from quarry.sources.http import HttpSql

        self.spark.dataSource.register(HttpSql)
        df.write.format("http_sql").options(table=table, **self._remote_options(server, user)).mode("append").save()

    def create_table(self, name: str, path: str, columns: list[tuple[str, str]] | T.StructType, column_name: dict[str, str] | None = None, **options: str) -> DataFrame:
        """A table of Parquet files. columns: names and type texts, or a schema; column_name: what files call a column."""
        schema = columns if isinstance(columns, T.StructType) else schema_of(columns)
        self.tables[name] = Table(name, path, schema, options, column_name or {})
        df = self.table(name)
        df.createOrReplaceTempView(name)
        return df

    def table(self, name: str, final_by: tuple[list[str], list[str]] | None = None) -> DataFrame:
        """The table's rows; with final_by=(keys, version) and the setting `final`, only each key's last."""
        t = self.tables[name]
        stored = T.StructType([T.StructField(t.renamed.get(c.name, c.name), c.dataType, True) for c in t.schema])
        rows = self.spark.read.schema(stored).parquet(t.path)
        rows = rows.select(*[F.col(f"`{t.renamed.get(c.name, c.name)}`").alias(c.name, metadata=c.metadata) for c in t.schema])
        return final_replacing(rows, *final_by) if final_by and self.session.final else rows

    def create_dictionary(self, name: str, table: DataFrame, *keys: str) -> Dictionary:
        self.dictionaries[name] = Dictionary(table, keys)
        table.createOrReplaceTempView(name)
        return self.dictionaries[name]

    def import_schema(self, folder: str, limit_to: list[str] | None = None, except_: list[str] | None = None, prefix: str = "") -> list[str]:
        """Make tables of the Parquet files (`name.parquet`) in a folder, hidden ones and those named `.inner*` left out."""
        if limit_to is not None and except_ is not None:
            raise ValueError("limit_to and except_ exclude each other")
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(folder)
        found = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
        names = sorted(s.getPath().getName() for s in found)
        made = []
        for name in (n.removesuffix(".parquet") for n in names if n.endswith(".parquet") and not n.startswith((".", "_"))):
            if limit_to is not None and name not in limit_to or name in (except_ or ()):
                continue
            path = f"{folder}/{name}.parquet"
            self.create_table(prefix + name, path, self.spark.read.parquet(path).schema, database="default", table_name=name)
            made.append(prefix + name)
        return made

    def describe(self, name: str) -> DataFrame:
        """(column_name, type, nullable) of a table."""
        rows = [(c.name, c.dataType.simpleString(), c.nullable) for c in self.tables[name].schema]
        return self.spark.createDataFrame(rows, "column_name string, type string, nullable boolean")

    def sql(self, text: str) -> DataFrame:
        """A statement of the dialect; see quarry.functions.dialect. A collapsing table that is read alone counts by its signs."""
        from quarry.functions.dialect import translate

        return self.spark.sql(translate(text, self.tables, self.dictionaries))

    def raw_query(self, sql: str) -> str:
        """The result of a statement as tab-separated text. For results that fit the driver."""
        from quarry.sources import tsv

        return "\n".join(r.value for r in tsv.lines(self.spark.sql(sql)).collect())

    def drop(self, name: str) -> None:
        self.tables.pop(name, None)
        self.spark.catalog.dropTempView(name)

    def analyze(self, name: str) -> dict[str, int]:
        """Rows of a table, counted (of Parquet files from their footers), and bytes as the optimizer estimates them."""
        table = self.table(name)
        return {"rows": table.count(), "bytes": int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))}
