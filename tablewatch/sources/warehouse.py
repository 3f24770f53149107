"""Catalog metadata of a warehouse folder as relations: a Spark data source written in Python.

A warehouse folder holds ``<schema>/<table>/`` folders of Parquet files. ``warehouse_view`` serves its
information schema -- a ``tables`` view and a ``columns`` view -- without a metastore. A filter on the schema
or table name is pushed into the source: only the listed schema's folder is opened. Every table is
one input partition, so tasks read the footers of different tables side by side; only footers are read.

Columns are upper-case, as databases name them: ``TABLE_CATALOG, TABLE_SCHEMA, TABLE_NAME`` with ``TABLE_TYPE,
ROW_COUNT, LAST_ALTERED`` or ``COLUMN_NAME, ORDINAL_POSITION, IS_NULLABLE, DATA_TYPE, CHARACTER_MAXIMUM_LENGTH``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

VIEWS = {
    "tables": "TABLE_CATALOG string, TABLE_SCHEMA string, TABLE_NAME string, TABLE_TYPE string, ROW_COUNT bigint, LAST_ALTERED timestamp",
    "columns": "TABLE_CATALOG string, TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, "
    "IS_NULLABLE string, DATA_TYPE string, CHARACTER_MAXIMUM_LENGTH int",
}
# Names of Parquet's column types as Spark's SQL calls them; others keep the name they have.
SQL_TYPES = {
    "int32": "int", "int64": "bigint", "float": "float", "double": "double", "bool": "boolean", "string": "string",
    "date32[day]": "date", "timestamp[us]": "timestamp_ntz", "timestamp[us, tz=UTC]": "timestamp",
}


class _Table(InputPartition):
    def __init__(self, schema: str, table: str):
        self.schema, self.table = schema, table


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.root, self.catalog, self.view = options["root"], options.get("catalog", ""), options["view"]
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters):
        """Equality with a name or a list of names; other filters stay with Spark."""
        for f in filters:
            column = f.attribute[-1].upper() if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column in ("TABLE_SCHEMA", "TABLE_NAME"):
                names = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, names) & names
            else:
                yield f

    def _folders(self, path: str, column: str) -> list[str]:
        """Subfolders that the pushed names allow. A list of names is not looked for by listing all."""
        from pyarrow import fs

        files, root = _filesystem(path)
        if column in self.wanted:
            infos = files.get_file_info([f"{root}/{n}" for n in sorted(x for x in self.wanted[column] if x)])
        else:
            infos = files.get_file_info(fs.FileSelector(root))
        return sorted(i.base_name for i in infos if i.type == fs.FileType.Directory and not i.base_name.startswith(("_", ".")))

    def partitions(self):
        found = [_Table(s, t) for s in self._folders(self.root, "TABLE_SCHEMA") for t in self._folders(f"{self.root}/{s}", "TABLE_NAME")]
        return found or [_Table("", "")]

    def read(self, partition):
        import datetime as dt

        import pyarrow.parquet as pq
        from pyarrow import fs

        if not partition.table:
            return
        files, root = _filesystem(f"{self.root}/{partition.schema}/{partition.table}")
        infos = [
            i for i in files.get_file_info(fs.FileSelector(root, recursive=True))
            if i.is_file and i.base_name.endswith(".parquet") and not i.base_name.startswith(("_", "."))
        ]
        key = (self.catalog, partition.schema, partition.table)
        if self.view == "tables":
            rows = 0
            for i in infos:
                with files.open_input_file(i.path) as f:
                    rows += pq.read_metadata(f).num_rows
            changed = max((i.mtime for i in infos), default=None)
            yield (*key, "BASE TABLE", rows, changed.astimezone(dt.timezone.utc) if changed else None)
        elif infos:
            with files.open_input_file(infos[0].path) as f:
                schema = pq.read_schema(f)
            for n, field in enumerate(schema, 1):
                yield (*key, field.name, n, "YES" if field.nullable else "NO", SQL_TYPES.get(str(field.type), str(field.type)), None)


class WarehouseCatalog(DataSource):
    """``format("tablewatch_catalog")`` with options ``root``, ``view`` (tables or columns) and ``catalog``."""

    @classmethod
    def name(cls):
        return "tablewatch_catalog"

    def schema(self):
        return VIEWS[self.options["view"]]

    def reader(self, schema):
        return _Reader(dict(self.options))


def _filesystem(path: str):
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri("file://" + path if path.startswith("/") else path)


def warehouse_view(spark: SparkSession, root: str, view: str, catalog: str = "") -> DataFrame:
    """A view of the warehouse folder's information schema. The folder must be one that executors can read;
    filters are pushed, in a session of the view's own (the setting is off by default)."""
    reader = spark.newSession()
    reader.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader.dataSource.register(WarehouseCatalog)
    options = {"root": root.rstrip("/"), "view": view, "catalog": catalog}
    view_rows = reader.read.format("tablewatch_catalog").options(**options).load()
    # Spark keeps what the last query pushed into a Python source for the next query on the same frame, unless
    # that pushes something itself. This filter, true for every row, makes each query push.
    return view_rows.where(F.col("TABLE_SCHEMA").isNotNull())
