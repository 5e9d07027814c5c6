"""Data model: the mutation log layout, type names and the JSON table catalog.

Log layout (one row per mutation)::

    rowkey STRING, family STRING, qualifier STRING,
    ts BIGINT, seq BIGINT, op STRING, value BINARY

``rowkey`` stays a string: Spark orders strings by their UTF-8 bytes, the
order of the store, and ``startswith`` / range predicates reach the Parquet
scan.  ``seq`` is the batch number and breaks ties between equal ``ts``.
``op`` is one of :data:`PUT`, :data:`DEL_ROW`, :data:`DEL_COLUMN`,
:data:`DEL_VERSION`.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

PUT = "put"
DEL_ROW = "del_row"            # hides every cell of the row with ts <= tombstone ts
DEL_COLUMN = "del_column"      # hides all versions of one cell with ts <= tombstone ts
DEL_VERSION = "del_version"    # hides exactly the version at the tombstone ts
OPS = (PUT, DEL_ROW, DEL_COLUMN, DEL_VERSION)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("rowkey", T.StringType(), False),
        T.StructField("family", T.StringType(), True),
        T.StructField("qualifier", T.StringType(), True),
        T.StructField("ts", T.LongType(), False),
        T.StructField("seq", T.LongType(), False),
        T.StructField("op", T.StringType(), False),
        T.StructField("value", T.BinaryType(), True),
    ]
)
LOG_COLUMNS = [f.name for f in LOG_SCHEMA.fields]

# Type names accepted by schema-on-read column lists and catalogs, and the
# Spark type each one decodes to.  "rowkey" is the pseudo type of the key.
SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "short": T.ShortType(),
    "rowkey": T.StringType(),
}
_ALIASES = {"integer": "int", "bigint": "long", "bool": "boolean", "smallint": "short", "str": "string"}


def normalize_type(name: str) -> str:
    """Canonical lower-case type name; unknown names fail at plan time."""
    t = name.strip().lower()
    t = _ALIASES.get(t, t)
    if t not in SPARK_TYPES:
        raise ValueError(f"unsupported cell type {name!r}; expected one of {sorted(SPARK_TYPES)}")
    return t


@dataclass(frozen=True)
class ColumnSpec:
    """One decoded column: output ``name``, source ``family``:``qualifier``, ``type``."""

    name: str
    family: str
    qualifier: str
    type: str

    @property
    def is_key(self) -> bool:
        return self.type == "rowkey"


def column_specs(columns, family: str | None = None) -> list[ColumnSpec]:
    """Build specs from ``[(name, type)]`` or ``[(family:qualifier, type)]`` pairs.

    Back-ticks are stripped from names.  A name without ``family:`` uses
    ``family``; the split happens at the first ``:`` only.
    """
    specs = []
    for name, typ in columns:
        t = normalize_type(typ)
        clean = name.replace("`", "")
        if t == "rowkey":
            specs.append(ColumnSpec(clean or "ROWKEY", "", "", t))
            continue
        if ":" in clean:
            fam, qual = clean.split(":", 1)
        else:
            if family is None:
                raise ValueError(f"column {name!r} has no family and no default family was given")
            fam, qual = family, clean
        specs.append(ColumnSpec(clean, fam, qual, t))
    return specs


@dataclass(frozen=True)
class Catalog:
    """A JSON table catalog: DataFrame column name -> (family, qualifier, type).

    The key column has family ``"rowkey"``.  Parsed once on the driver; it is
    table metadata, a handful of entries, never data.
    """

    namespace: str
    name: str
    key_name: str
    columns: tuple[ColumnSpec, ...]

    @staticmethod
    def from_json(text: str) -> "Catalog":
        doc = json.loads(text)
        table = doc["table"]
        key_qualifier = doc["rowkey"]
        cols = []
        key_name = None
        for df_name, c in doc["columns"].items():
            if c["cf"] == "rowkey":
                if c["col"] != key_qualifier:
                    raise ValueError("catalog key column does not match 'rowkey'")
                key_name = df_name
                cols.append(ColumnSpec(df_name, "rowkey", c["col"], normalize_type(c["type"])))
            else:
                cols.append(ColumnSpec(df_name, c["cf"], c["col"], normalize_type(c["type"])))
        if key_name is None:
            raise ValueError("catalog has no rowkey column")
        return Catalog(table.get("namespace", "default"), table["name"], key_name, tuple(cols))

    def to_json(self) -> str:
        return json.dumps(
            {
                "table": {"namespace": self.namespace, "name": self.name},
                "rowkey": next(c.qualifier for c in self.columns if c.family == "rowkey"),
                "columns": {c.name: {"cf": c.family, "col": c.qualifier, "type": c.type} for c in self.columns},
            }
        )

    @property
    def qualified_name(self) -> str:
        return f"{self.namespace}:{self.name}"

    @property
    def value_columns(self) -> list[ColumnSpec]:
        return [c for c in self.columns if c.family != "rowkey"]

    def schema(self) -> T.StructType:
        fields = []
        for c in self.columns:
            typ = T.StringType() if c.family == "rowkey" and c.type == "string" else SPARK_TYPES[c.type]
            fields.append(T.StructField(c.name, typ, c.family != "rowkey"))
        return T.StructType(fields)
