"""JSON objects to typed columns: boolean, bigint, double or, for anything else, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _pairs(rows: DataFrame, column: str, order: Column | None) -> DataFrame:
    """One row per key of every object, with the kind of its value; a NULL key for rows without any.

    With `order`, also the row's order and the key's place in the object.
    """
    json, variant = F.col(column), F.try_parse_json(F.col(column))
    parsed = rows.select(
        variant.alias("_variant"),
        F.startswith(F.ltrim(json, F.lit(" \t\r\n")), F.lit("{")).alias("_braced"),
        *([] if order is None else [order.alias("_order"), F.json_object_keys(json).alias("_keys")]),
    )
    pairs = parsed.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.col("_variant").outer()))
    # Valid JSON that opens with a brace is an object; anything else counts once per row.
    broken = (F.coalesce("pos", F.lit(0)) == 0) & (F.col("_variant").isNull() | ~F.col("_braced"))
    kept = [
        "key",
        F.nullif(F.schema_of_variant("value"), F.lit("VOID")).alias("_kind"),
        broken.cast("int").alias("_broken"),
    ]
    if order is not None:
        kept += ["_order", F.array_position("_keys", F.col("key")).alias("_place")]
    return pairs.select(*kept)


#: Strings, structural characters and all text between them; together they are the whole document.
TOKEN = r'(?s)("[^"\\]*+(?:\\.[^"\\]*+)*+"|[{}\[\],:]|[^{}\[\],:"]++)'


def _members(json: str, tokens: str) -> Column:
    """Name literal, first character and length of every member of a JSON object, as they stand in its text."""
    state = "named_struct('depth', {depth}, 'at', s.at + length(t), 'key', {key}, 'start', {start}, 'out', {out})"
    member = f"named_struct('key', s.key, 'start', s.start, 'size', s.at - s.start)"
    between = "s.depth = 1 AND t IN (',', '}')"
    empty = "named_struct('depth', 0, 'at', 1, 'key', CAST(NULL AS STRING), 'start', 1, 'out', CAST(array() AS ARRAY<STRUCT<key: STRING, start: INT, size: INT>>))"
    ended = state.format(depth="if(t = '}', 0, 1)", key="CAST(NULL AS STRING)", start="s.at + 1", out=f"if(s.key IS NULL, s.out, array_append(s.out, {member}))")
    named = state.format(depth="1", key=f"trim(BOTH ' \\t\\r\\n' FROM substring({json}, s.start, s.at - s.start))", start="s.at + 1", out="s.out")
    depth = "s.depth + CASE WHEN t IN ('{', '[') THEN 1 WHEN t IN ('}', ']') THEN -1 ELSE 0 END"
    other = state.format(depth=depth, key="s.key", start="if(s.depth = 0, s.at + length(t), s.start)", out="s.out")
    step = f"(s, t) -> CASE WHEN {between} THEN {ended} WHEN s.depth = 1 AND t = ':' AND s.key IS NULL THEN {named} ELSE {other} END"
    return F.expr(f"aggregate({tokens}, {empty}, {step}, s -> s.out)")


def _raw(members: Column, json: Column, name: str) -> Column:
    """The text of a member's value; the last one counts."""
    plain = F.lit(f'"{name}"')
    spelled = lambda key: F.when(F.contains(key, F.lit("\\")), F.from_json(F.concat(F.lit("["), key, F.lit("]")), "array<string>")[0] == name).otherwise(key == plain)
    last = F.try_element_at(F.filter(members, lambda m: spelled(m["key"])), F.lit(-1))
    return F.btrim(F.substring(json, last["start"], last["size"]), F.lit(" \t\r\n"))


def _key_summary(rows: DataFrame, column: str, order: Column | None = None) -> DataFrame:
    """One row per key with its type; the NULL key counts rows that are no object."""
    pairs = _pairs(rows, column, order)

    def every(test: Column) -> Column:
        return F.bool_and(test)

    whole = F.col("_kind") == "BIGINT"
    real = whole | (F.col("_kind") == "DOUBLE") | F.startswith(F.col("_kind"), F.lit("DECIMAL"))
    kind = (
        F.when(F.count("_kind") == 0, F.lit("string"))
        .when(every(F.col("_kind") == "BOOLEAN"), F.lit("boolean"))
        .when(every(whole), F.lit("bigint"))
        .when(every(real), F.lit("double"))
        .otherwise(F.lit("string"))
    )
    other = F.bool_or(F.col("_kind") != "STRING")
    summary = [kind.alias("type"), F.sum("_broken").alias("broken"), F.coalesce(other, F.lit(False)).alias("raw")]
    if order is not None:
        summary += [F.min("_order").alias("first_row"), F.min_by("_place", "_order").alias("place")]
    return pairs.groupBy("key").agg(*summary)


def infer_json_types(rows: DataFrame, column: str) -> DataFrame:
    """Key and type of every column, over all rows."""
    summary = _key_summary(rows, column).filter(F.col("key").isNotNull())
    return summary.select(F.col("key").alias("column"), "type")


def json_schema(rows: DataFrame, column: str, order_by: str | None = None) -> T.StructType:
    """The inferred schema, columns in the order they are first seen; raises when no table can be made."""
    order = F.col(order_by) if order_by else F.monotonically_increasing_id()
    summary = _key_summary(rows, column, order).orderBy("first_row", "place").collect()
    if not summary:
        raise ValueError("At least one row is needed.")
    broken = sum(row["broken"] for row in summary if row["key"] is None)
    if broken:
        raise ValueError(f"{broken} rows are not JSON objects.")
    fields = [row for row in summary if row["key"] is not None]
    if not fields or any(not row["key"].strip() for row in fields):
        raise ValueError("Rows need at least one column, and no column name may be blank.")
    types = {"string": T.StringType(), "boolean": T.BooleanType(), "bigint": T.LongType(), "double": T.DoubleType()}
    # Text columns that hold other values too take these from the source text.
    return T.StructType([T.StructField(row["key"], types[row["type"]], metadata={"raw": row["raw"]}) for row in fields])


def json_rows_to_table(rows: DataFrame, column: str, order_by: str | None = None) -> DataFrame:
    """Typed table of JSON object rows; an omitted key is NULL, other values in text columns stay as they are written."""
    schema = json_schema(rows, column, order_by)
    mixed = [field.name for field in schema.fields if field.metadata["raw"] and isinstance(field.dataType, T.StringType)]
    plain = T.StructType([T.StructField(field.name, field.dataType) for field in schema.fields])
    json = F.col("_json")
    parsed = rows.select(F.col(column).alias("_json"), F.from_json(F.col(column), plain).alias("_row"))
    if mixed:
        parsed = parsed.withColumn("_tokens", F.regexp_extract_all("_json", F.lit(TOKEN), F.lit(1))).withColumn("_members", _members("_json", "_tokens"))
    # By place, as names may differ in case alone.
    kept = [name for name in ("_json", "_members") if name in parsed.columns]
    placed = parsed.select("_row.*", *kept).toDF(*[f"_{i}" for i in range(len(plain))], *kept)
    cells = []
    for i, name in enumerate(plain.names):
        cell = F.col(f"_{i}")
        if name in mixed:
            raw = _raw(F.col("_members"), json, name)
            cell = F.when(F.startswith(raw, F.lit('"')), cell).when(raw != "null", raw)
        cells.append(cell.alias(name))
    return placed.select(*cells)
