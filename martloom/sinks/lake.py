"""Lake tables by layer and name, each a table with versions, optionally registered in the catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from martloom.sinks.versions import COMMIT, VersionedTable, value_of

BRONZE = "bronze"


class Lake:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def table(self, layer: str, table: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(layer, table))

    def _generation(self, table: str) -> str:
        """The full load that a bronze table goes back to; what is remembered about files starts with it."""
        version = self.table(BRONZE, table).version()
        return version.note.get("generation", "0") if version else "0"

    def checkpoint(self, table: str) -> str:
        return f"{self.root}/_ops/{table}/checkpoint-{self._generation(table)}"

    def schema_location(self, table: str) -> str:
        return f"{self.root}/_ops/{table}/schema"

    def ledger(self, table: str) -> str:
        """Landed files by the load that took them. Only loads that the table's version names count."""
        return f"{self.root}/_ops/{table}/ledger"

    def read(self, layer: str, table: str, version: int | None = None) -> DataFrame:
        """A stored table as of a version, by default the newest; later writes do not change the frame.

        Rows and columns that a table keeps for its own upkeep (``shown``, ``hidden`` in its note) are left out.
        """
        stored = self.table(layer, table)
        found = stored.version(version)
        if found is None:
            raise LookupError(f"{layer}.{table} is not stored")
        rows = stored.frame(found)
        if found.note.get("shown"):
            rows = rows.filter(found.note["shown"])
        return rows.drop(*found.note.get("hidden", ()))

    def exists(self, layer: str, table: str) -> bool:
        return self.table(layer, table).version() is not None

    def has_load_history(self, table: str) -> bool:
        """Whether it is known which landed files the table holds."""
        version = self.table(BRONZE, table).version()
        return version is not None and bool(version.note.get("loads"))

    def loads(self, table: str) -> tuple[str, ...]:
        """Names of the loads whose rows a bronze table holds, in order."""
        version = self.table(BRONZE, table).version()
        return tuple(p.removeprefix(f"{COMMIT}=") for p in version.parts) if version else ()

    def replace(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = (), range_of: str | None = None,
        note: dict | None = None,
    ) -> DataFrame:
        """Replace rows and schema, by a new version of the table. Rerunning gives the same table.

        A write that fails leaves the old version; readers of it keep their rows until it expires. A
        table is partitioned by one column at most.
        """
        (column,) = partition_by or (None,)
        stored = self.table(layer, table)
        return stored.frame(stored.replace(df, column, range_of, note))

    def named(self, layer: str, table: str) -> DataFrame:
        """A registered table by its name in the catalog."""
        return self.spark.table(f"{layer}.{table}")

    def register(self, layer: str, table: str, comment: str = "", tags: dict[str, str] | None = None) -> None:
        """Name the newest version of a stored table in the catalog, with its comment and tags.

        Its folders become the partitions of an external table, so filters on the partition column prune.
        """
        stored = self.table(layer, table)
        version = stored.version()
        name, by = f"{layer}.{table}", version.partition_by
        data = f"{stored.path}/data"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        properties = ", ".join(f"'{k}' = '{v}'" for k, v in sorted((tags or {}).items()))
        quoted = lambda text: "'" + text.replace("'", "\\'") + "'"
        about = lambda f: f" COMMENT {quoted(f.metadata['comment'])}" if f.metadata.get("comment") else ""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{about(f)}" for f in version.schema.fields)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet"
            + (f" PARTITIONED BY (`{by}`) LOCATION '{data}'" if by else f" LOCATION '{data}/{version.parts[0]}'")
            + (f" COMMENT {quoted(comment)}" if comment else "")
            + (f" TBLPROPERTIES ({properties})" if properties else "")
        )
        for part in version.parts if by else ():
            value = value_of(part)
            literal = "NULL" if value is None else quoted(value)
            self.spark.sql(f"ALTER TABLE {name} ADD PARTITION (`{by}` = {literal}) LOCATION '{data}/{part}'")
