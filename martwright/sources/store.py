"""Published marts as catalog tables that other sessions and applications read by name.

A mart's build is a table ``<schema>.<name>_v<version>__<snapshot>``, where the snapshot names the state of
its sources; the state, the version and the contract's name are properties of the table. The view
``<schema>.<name>_v<version>`` shows the newest build. A changed source makes a new build beside the old
one, which stays readable under its own name until its owner drops it.

Builds lie below the warehouse folder, at a place that follows from their name. An application whose catalog
does not know a finished build registers the files it finds there, so it builds nothing again. One job at a
time may build a version; Spark's success marker tells a finished build from one that broke off.

While a build is written, rows and each column's NULLs, least and greatest value are observed in the same
pass, and kept as a table of a row per column.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from importlib.resources import files

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = "contracts"
SNAPSHOT, CONTRACT, VERSION = "martwright.snapshot", "martwright.contract", "martwright.version"
RESULTS = "column_name string, ordinal int, row_count long, null_count long, least string, greatest string"


def code_digest() -> str:
    """Names the state of the code that builds marts: changed models make new builds."""
    package = files("martwright")
    modules = [f for d in ("functions", "plans", "sources") for f in (package / d).iterdir()]
    sources = sorted((f.name, f.read_bytes()) for f in [*modules, package / "schemas.py"] if f.name.endswith(".py"))
    return hashlib.sha256(repr(sources).encode()).hexdigest()


def snapshot_id(*state: object) -> str:
    """Short name of a state of the sources."""
    return hashlib.sha256(repr(state).encode()).hexdigest()[:16]


def _text(column: str, kind: T.DataType, least: bool) -> Column:
    if not isinstance(kind, T.AtomicType) or isinstance(kind, (T.BinaryType, T.VariantType)):
        return F.lit(None).cast("string")
    return (F.min if least else F.max)(column).cast("string")


def _observed(df: DataFrame) -> list[Column]:
    """Rows, then NULLs, least and greatest value of each column."""
    out = [F.count(F.lit(1)).alias("rows")]
    for i, field in enumerate(df.schema):
        name = f"`{field.name}`"
        out += [
            F.count_if(F.col(name).isNull()).alias(f"nulls_{i}"),
            _text(name, field.dataType, True).alias(f"least_{i}"),
            _text(name, field.dataType, False).alias(f"greatest_{i}"),
        ]
    return out


class MartStore:
    """The builds of one snapshot of the sources, in one schema of the session's catalog."""

    def __init__(self, spark: SparkSession, snapshot: str, schema: str = SCHEMA):
        self.spark, self.snapshot, self.schema = spark, snapshot, schema

    def name_of(self, name: str, version: int | None) -> str:
        return name if version is None else f"{name}_v{version}"

    def table_of(self, name: str, version: int | None) -> str:
        return f"{self.schema}.{self.name_of(name, version)}__{self.snapshot}"

    def path_of(self, table: str) -> str:
        warehouse = self.spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        return f"{warehouse}/{table.replace('.', '.db/', 1)}"

    def _finished(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path_of(table)}/_SUCCESS")
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path)

    def _register(self, table: str) -> None:
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{self.path_of(table)}'")

    def _describe(self, name: str, version: int | None) -> None:
        """Properties of the build, and the view that shows it as the newest one."""
        table = self.table_of(name, version)
        about = {SNAPSHOT: self.snapshot, CONTRACT: name, VERSION: "" if version is None else version}
        properties = ", ".join(f"'{k}' = '{v}'" for k, v in about.items())
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({properties})")
        view = f"{self.schema}.{self.name_of(name, version)}"
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ({properties}) AS SELECT * FROM {table}")

    def known(self, name: str, version: int | None) -> bool:
        """Whether the build is there, in the catalog or, finished, at its place."""
        table = self.table_of(name, version)
        if self.spark.catalog.tableExists(f"{table}__results"):  # written last
            return True
        if not self._finished(f"{table}__results"):
            return False
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema}")
        self._register(table)
        self._register(f"{table}__results")
        self._describe(name, version)
        return True

    def publish(
        self, name: str, version: int | None, build: Callable[[], DataFrame], sort_by: str | None = None
    ) -> DataFrame:
        """The mart at this snapshot, built unless it is there."""
        table = self.table_of(name, version)
        if not self.known(name, version):
            df = build()
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema}")
            seen = Observation()
            observed = df.observe(seen, *_observed(df))
            if sort_by is not None:
                observed = observed.sortWithinPartitions(sort_by)
            self._save(observed, table)
            found = seen.get
            rows = [
                (f.name, i + 1, found["rows"], *(found[f"{k}_{i}"] for k in ("nulls", "least", "greatest")))
                for i, f in enumerate(df.schema)
            ]
            self._save(self.spark.createDataFrame(rows, RESULTS).coalesce(1), f"{table}__results")
            self._describe(name, version)
        return self.spark.table(table)

    def _save(self, df: DataFrame, table: str) -> None:
        writer = df.write.mode("overwrite").format("parquet").option("compression", "zstd")
        writer.option("path", self.path_of(table)).saveAsTable(table)

    def results(self, name: str, version: int | None) -> DataFrame:
        """What was observed while the build was written, a row per column."""
        return self.spark.table(f"{self.table_of(name, version)}__results")


def builds(spark: SparkSession, name: str, version: int, schema: str = SCHEMA) -> list[str]:
    """Tables of all builds of a mart that the catalog knows."""
    prefix = f"{name}_v{version}__"
    tables = [t.name for t in spark.catalog.listTables(schema)]
    return sorted(f"{schema}.{t}" for t in tables if t.startswith(prefix) and not t.endswith("__results"))


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    """Snapshot, contract and version that a build or view carries."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"]: r["value"] for r in rows if r["key"].startswith("martwright.")}
