"""Row shaping over cell frames, written as DataFrame jobs.

Row-level shapes (maps, formatted lines, decoded columns) group the live
cells by ``rowkey`` -- one shuffle on the key, with map-side partial
aggregation where the aggregate allows it.  Nothing is collected to the
driver; maps never leave Spark (outputs for comparison are rendered as
sorted strings).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.codec import decode, decode_or_default, decode_sql, encode, encode_sql, text_literal, value_type_of
from tessera.model import PUT, SPARK_TYPES, ColumnSpec, column_specs, normalize_type


# ------------------------------------------------------------- melt / P5
def melt_to_cells(
    df: DataFrame,
    key: Column | str,
    specs: Sequence[ColumnSpec],
    *,
    ts: Column | int,
    seq: Column | int = 0,
    op: str = PUT,
) -> DataFrame:
    """Wide typed rows -> log rows, one per non-null column (a narrow ``Generate``).

    ``specs`` name the source column (``name``), target family/qualifier and
    the byte layout.  No shuffle: every output row stays in its input task.
    """
    key_col = F.col(key) if isinstance(key, str) else key
    cells = F.array(
        *[
            F.struct(
                F.lit(s.family).alias("family"),
                F.lit(s.qualifier).alias("qualifier"),
                encode(s.name, s.type).alias("value"),
            )
            for s in specs
        ]
    )
    ts_col = F.lit(ts).cast("bigint") if isinstance(ts, int) else ts.cast("bigint")
    seq_col = F.lit(seq).cast("bigint") if isinstance(seq, int) else seq.cast("bigint")
    return (
        df.select(key_col.cast("string").alias("rowkey"), ts_col.alias("ts"), seq_col.alias("seq"), F.inline(cells))
        .filter(F.col("value").isNotNull())
        .select("rowkey", "family", "qualifier", "ts", "seq", F.lit(op).alias("op"), "value")
    )


def encode_family(df: DataFrame, key: str, family: str, *, ts: Column | int, seq: Column | int = 0) -> DataFrame:
    """keyMap2Put: every non-key column to ``family:<column>``, layout from the column's Spark type."""
    specs = [ColumnSpec(f.name, family, f.name, value_type_of(f.dataType)) for f in df.schema.fields if f.name != key]
    quoted = {s.name: F.col("`" + s.name.replace("`", "``") + "`") for s in specs}
    prepared = df.select(key, *[quoted[s.name] if s.type != "string" or _is_string(df, s.name)
                                else quoted[s.name].cast("string").alias(s.name) for s in specs])
    return melt_to_cells(prepared, key, specs, ts=ts, seq=seq)


def encode_cf(df: DataFrame, key: str, *, ts: Column | int, seq: Column | int = 0) -> DataFrame:
    """cfkMap2Put: columns named ``family:qualifier`` (split at the first ``:``)."""
    specs = []
    for f in df.schema.fields:
        if f.name == key:
            continue
        if ":" not in f.name:
            raise ValueError(f"column {f.name!r} is not named family:qualifier")
        fam, qual = f.name.split(":", 1)
        specs.append(ColumnSpec(f.name, fam, qual, value_type_of(f.dataType)))
    renamed = df.select(F.col(key), *[F.col(f"`{s.name}`").alias(s.name) for s in specs])
    return melt_to_cells(renamed, key, specs, ts=ts, seq=seq)


def explode_map_batch(df: DataFrame, key: str, map_col: str, *, family: str | None = None,
                      type_name: str | None = None, types: dict[str, str] | None = None, ts: Column | int,
                      seq: Column | int = 0) -> DataFrame:
    """(key, map) batches -> log rows.  Map keys are ``family:qualifier`` unless ``family`` is given.

    Values are encoded by the map's value type.  For mixed types pass string
    values and ``types``: map key -> type name of the value written as text
    (keys not listed stay strings; text that is not of its type is an error).
    """
    vtype = normalize_type(type_name) if type_name else value_type_of(df.schema[map_col].dataType.valueType)
    exploded = df.select(F.col(key).cast("string").alias("rowkey"), F.explode(map_col).alias("k", "v"))
    if types:
        typed = [(k, normalize_type(t)) for k, t in types.items()]
        branches = " ".join(f"WHEN k = {text_literal(k)} THEN {encode_sql(f'CAST(v AS {SPARK_TYPES[t].simpleString()})', t)}"
                            for k, t in typed)
        value = F.expr(f"CASE {branches} ELSE {encode_sql('v', 'string')} END")
    else:
        value = encode("v", vtype)
    if family is None:
        has_sep = F.instr(F.col("k"), ":") > 0
        fam = F.when(has_sep, F.substring_index("k", ":", 1)).otherwise(
            F.raise_error(F.concat(F.lit("map key is not family:qualifier: "), F.col("k"))))
        qual = F.expr("substr(k, instr(k, ':') + 1)")
    else:
        fam, qual = F.lit(family), F.col("k")
    ts_col = F.lit(ts) if isinstance(ts, int) else ts
    seq_col = F.lit(seq) if isinstance(seq, int) else seq
    return exploded.select(
        "rowkey", fam.alias("family"), qual.alias("qualifier"), ts_col.cast("bigint").alias("ts"),
        seq_col.cast("bigint").alias("seq"), F.lit(PUT).alias("op"), value.alias("value"),
    ).filter(F.col("value").isNotNull())


def _is_string(df: DataFrame, name: str) -> bool:
    from pyspark.sql import types as T

    return isinstance(df.schema[name].dataType, T.StringType)


# ------------------------------------------------------- P4 decode columns
def decode_columns(cells: DataFrame, columns, *, family: str | None = None, with_key: bool = False,
                   defaults: bool = True, all_rows: bool = True) -> DataFrame:
    """getDF / getDFWithK: live cells -> one typed column per requested column.

    ``columns`` is ``[(name, type)]`` where a name may be ``family:qualifier``.
    A conditional aggregate per column pivots the cells of each row (one
    shuffle on ``rowkey``); missing cells take the type's default value.
    A row with none of the requested columns gives a row of defaults;
    ``all_rows=False`` leaves it out and reads the requested cells only.
    """
    all_specs = column_specs(columns, family)
    with_key = with_key or any(s.is_key for s in all_specs)  # a ROWKEY entry asks for the key column
    specs = [s for s in all_specs if not s.is_key]
    wanted = F.lit(False)
    for s in specs:
        wanted = wanted | ((F.col("family") == s.family) & (F.col("qualifier") == s.qualifier))
    aggs = [
        F.max(F.when((F.col("family") == s.family) & (F.col("qualifier") == s.qualifier), F.col("value"))).alias(
            f"__v{i}")
        for i, s in enumerate(specs)
    ]
    pivoted = (cells if all_rows else cells.filter(wanted)).groupBy("rowkey").agg(*aggs)
    out = []
    if with_key:
        out.append(F.col("rowkey").alias("ROWKEY"))
    for i, s in enumerate(specs):
        conv = decode_or_default(f"__v{i}", s.type) if defaults else decode(f"__v{i}", s.type)
        out.append(conv.cast(SPARK_TYPES[s.type]).alias(s.name))
    return pivoted.select(*out)


def decode_log(log: DataFrame, columns, *, family: str | None = None, with_key: bool = False,
               defaults: bool = True, all_rows: bool = True, version_deletes: bool = True,
               row_deletes: bool = True) -> DataFrame:
    """Version resolution + decode of a *log*, with row tombstones applied after the pivot.

    Cells are resolved without the row stage, pivoted to one row per key
    (partial aggregation: a row with millions of cells leaves each task as one
    row), and only then joined with the row tombstones -- a join of one row
    per key on each side, so neither a wide row nor a hot key concentrates
    work in one task.  Each column carries its cell's ts so that a row
    tombstone hides exactly the columns written at or before it.

    Every live row is kept, also rows without any requested column (their
    columns are NULL or the default): a row is live while its newest live cell
    is newer than its row tombstone.  Values of other columns are dropped
    before the first shuffle.  ``all_rows=False`` leaves such rows out.
    """
    from tessera.model import DEL_ROW, LOG_COLUMNS
    from tessera.operators.versions import latest_cells

    entries = log.select(*LOG_COLUMNS)
    all_specs = column_specs(columns, family)
    with_key = with_key or any(s.is_key for s in all_specs)
    specs = [s for s in all_specs if not s.is_key]
    match = [(F.col("family") == s.family) & (F.col("qualifier") == s.qualifier) for s in specs]
    wanted = F.lit(False)
    for m in match:
        wanted = wanted | m
    cells = latest_cells(entries.withColumn("value", F.when(wanted, F.col("value"))), version_deletes=version_deletes,
                         row_deletes=False)
    source = cells if all_rows else cells.filter(wanted)
    row_ts = [F.max("ts").alias("__rowts")] if all_rows else []
    pivoted = source.groupBy("rowkey").agg(
        *[F.max(F.when(m, F.struct("ts", "value"))).alias(f"__c{i}") for i, m in enumerate(match)], *row_ts)
    if row_deletes:
        marks = entries.filter(F.col("op") == DEL_ROW).groupBy("rowkey").agg(F.max("ts").alias("__tr"))
        pivoted = pivoted.join(marks, "rowkey", "left")
        live = [F.when(F.col("__tr").isNull() | (F.col(f"__c{i}.ts") > F.col("__tr")), F.col(f"__c{i}.value"))
                for i in range(len(specs))]
    else:
        live = [F.col(f"__c{i}.value") for i in range(len(specs))]
    staged = pivoted.select("rowkey", *[v.alias(f"__v{i}") for i, v in enumerate(live)],
                            *(["__rowts", "__tr"] if all_rows and row_deletes else []))
    if all_rows and row_deletes:
        staged = staged.filter(F.col("__tr").isNull() | (F.col("__rowts") > F.col("__tr")))
    elif row_deletes:
        any_live = F.lit(False)
        for i in range(len(specs)):
            any_live = any_live | F.col(f"__v{i}").isNotNull()
        staged = staged.filter(any_live)
    out = [F.col("rowkey").alias("ROWKEY")] if with_key else []
    for i, s in enumerate(specs):
        conv = decode_or_default(f"__v{i}", s.type) if defaults else decode(f"__v{i}", s.type)
        out.append(conv.cast(SPARK_TYPES[s.type]).alias(s.name))
    return staged.select(*out)


def typed_view(cells: DataFrame, types: dict[str, str], extra: Sequence[str] = ("ts",)) -> DataFrame:
    """Comparable projection of cells: text values in ``s_val``, numbers in ``n_val`` (as double).

    ``types`` maps qualifier -> type name; unlisted qualifiers decode as text.
    """
    numeric = {q: normalize_type(t) for q, t in types.items() if normalize_type(t) not in ("string", "rowkey", "boolean")}
    branches = " ".join(f"WHEN qualifier = {text_literal(q)} THEN CAST({decode_sql('value', t)} AS DOUBLE)" for q, t in numeric.items())
    n_val = F.expr(f"CASE {branches} END") if numeric else F.lit(None).cast("double")
    quoted = ", ".join(map(text_literal, numeric))
    s_val = F.expr(f"CASE WHEN qualifier NOT IN ({quoted}) THEN {decode_sql('value', 'string')} END") if numeric \
        else decode("value", "string")
    return cells.select("rowkey", "family", "qualifier", *extra, s_val.alias("s_val"), n_val.alias("n_val"))


# ------------------------------------------------------------ P1 / P2 maps
def _dedup_by_qualifier(cells: DataFrame) -> DataFrame:
    """Qualifier-keyed maps: when two families share a qualifier the highest family wins."""
    return cells.groupBy("rowkey", "qualifier").agg(F.max_by("value", "family").alias("value"))


def rows_to_map(cells: DataFrame, *, as_string: bool = False, with_key: bool = True) -> DataFrame:
    """res2Map / res2StrMap (+WithK): ``(rowkey, cells map<qualifier, value>)``."""
    d = _dedup_by_qualifier(cells)
    v = F.decode("value", "UTF-8") if as_string else F.col("value")
    out = d.groupBy("rowkey").agg(F.map_from_entries(F.collect_list(F.struct("qualifier", v))).alias("cells"))
    return out if with_key else out.select("cells")


def rows_to_cf_map(cells: DataFrame, *, with_key: bool = True) -> DataFrame:
    """res2MapWithCF / res2MapWithCFK: ``(rowkey, cells map<family:qualifier, value>)``."""
    k = F.concat_ws(":", "family", "qualifier")
    out = cells.groupBy("rowkey").agg(F.map_from_entries(F.collect_list(F.struct(k, F.col("value")))).alias("cells"))
    return out if with_key else out.select("cells")


def decode_map(rows: DataFrame, columns, *, key: str = "rowkey", map_col: str = "cells", with_key: bool = False,
               defaults: bool = True) -> DataFrame:
    """getDF over ``(rowkey, map<qualifier, bytes>)`` rows as :func:`rows_to_map` yields them: columns by qualifier alone."""
    specs = column_specs(columns, "")
    staged = rows.select(F.col(key).alias("ROWKEY"), *[
        F.element_at(F.col(map_col), F.lit(s.qualifier)).alias(f"__v{i}") for i, s in enumerate(specs)])
    out = [F.col("ROWKEY")] if with_key or any(s.is_key for s in specs) else []
    for i, s in enumerate(specs):
        if not s.is_key:
            conv = decode_or_default(f"__v{i}", s.type) if defaults else decode(f"__v{i}", s.type)
            out.append(conv.cast(SPARK_TYPES[s.type]).alias(s.name))
    return staged.select(*out)


def render_map(m: Column, value_render=F.hex) -> Column:
    """Sorted ``k=v;k=v`` text of a map, for comparison and display."""
    entries = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), value_render(e["value"]))), ";")


# --------------------------------------------------------- P3 / P6 / first
def _cell_order() -> Column:
    return F.struct("family", "qualifier")


def single_column_and_key(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """singleColumnAndRK: ``(value, rowkey)`` of the first cell of each row; ``""`` when it has none.

    ``rows`` lists the row keys of the scan (rows without cells included).
    """
    first = cells.groupBy("rowkey").agg(F.min_by(F.decode("value", "UTF-8"), _cell_order()).alias("value"))
    return rows.select("rowkey").join(first, "rowkey", "left").select(
        F.coalesce("value", F.lit("")).alias("value"), "rowkey")


def format_rows(cells: DataFrame, long_qualifiers: Sequence[str] = ("counter",)) -> DataFrame:
    """rowKeyAndResult: ``key:(q,v)(q,v)...`` in cell order; listed qualifiers print as Long."""
    as_long = F.col("qualifier").isin(*long_qualifiers) if long_qualifiers else F.lit(False)
    text = F.when(as_long, decode("value", "long").cast("string")).otherwise(F.decode("value", "UTF-8"))
    piece = F.concat(F.lit("("), F.col("qualifier"), F.lit(","), text, F.lit(")"))
    grouped = cells.groupBy("rowkey").agg(
        F.array_sort(F.collect_list(F.struct("family", "qualifier", piece.alias("p")))).alias("parts"))
    return grouped.select(
        "rowkey", F.concat(F.col("rowkey"), F.lit(":"), F.array_join(F.transform("parts", lambda s: s["p"]), "")).alias("line"))


# ----------------------------------------------------- opaque row mappers
def map_rows_arrow(cells: DataFrame, fn, schema) -> DataFrame:
    """Apply an opaque per-row mapper in Arrow batches (the getRDD ``Result => T`` form).

    Rows are assembled in Spark (``family:qualifier`` -> value map per key,
    one shuffle on ``rowkey``); ``fn`` receives an iterator of
    ``pyarrow.RecordBatch`` with columns ``rowkey`` and ``cells`` (a map) and
    yields batches matching ``schema``.  Use it only for logic that column
    expressions cannot state: Python runs here, batch by batch.
    """
    return rows_to_cf_map(cells).mapInArrow(fn, schema)
