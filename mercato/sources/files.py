"""File landing zones.

``read_json_events`` reads JSON event files with a declared schema; malformed
lines are kept in ``_corrupt_record`` instead of failing the load or being
dropped silently.  ``read_variant_events`` reads each line as a VARIANT and
loses nothing: lines that are no event go to a rescue table with the reason, and
fields that the schema does not have, or whose value does not fit, stay with
their event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.schemas import PROPS_JSON, RAW_EVENT_JSON, RAW_EVENTS

# Fixed value: landed JSON timestamps keep microseconds.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_json_events(spark: SparkSession, path: str) -> DataFrame:
    df = (spark.read.schema(RAW_EVENT_JSON)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record")
          .option("timestampNTZFormat", TS_FORMAT)
          .json(path))
    return df.withColumn("props_k", F.from_json("props", PROPS_JSON).getField("k"))


def with_load_timestamp(df: DataFrame) -> DataFrame:
    """Staging load stamp (``DEFAULT CURRENT_TIMESTAMP()``)."""
    return df.withColumn("load_timestamp", F.current_timestamp().cast("timestamp_ntz"))


def land_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("timestampNTZFormat", TS_FORMAT).json(path)
    return path


def read_variant_events(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(events, rescue) of the JSON lines at ``path``.

    ``events`` has the columns of RAW_EVENTS and ``rescued``: a JSON object of the
    line's fields that have no column or whose value does not fit its column's
    type (null: none).  ``rescue`` has (line, reason): ``malformed`` (not JSON),
    ``not an object``, ``no event_id`` (absent, or not a whole number)."""
    types = {f.name: f.dataType.simpleString() for f in RAW_EVENTS.fields}
    lines = spark.read.text(path).selectExpr("value AS line", "try_parse_json(value) AS v")

    def typed(name: str, kind: str) -> str:
        if kind == "timestamp_ntz":  # JSON has no timestamps
            return f"TRY_CAST(try_variant_get(v, '$.{name}', 'string') AS {kind})"
        got = f"try_variant_get(v, '$.{name}', '{kind}')"
        if kind == "bigint":  # a cast would round fractions and read texts
            return f"IF(schema_of_variant(try_variant_get(v, '$.{name}', 'variant')) = 'BIGINT', {got}, NULL)"
        return got

    fits = ", ".join(f"named_struct('name', '{n}', 'ok', {n} IS NOT NULL)" for n in types)
    rows = lines.selectExpr("line", "v", "from_json(line, 'map<string,string>') AS fields", *[f"{typed(n, k)} AS {n}" for n, k in types.items()])
    rows = rows.selectExpr("*", f"""CASE WHEN v IS NULL THEN 'malformed' WHEN schema_of_variant(v) NOT LIKE 'OBJECT%' THEN 'not an object'
        WHEN event_id IS NULL THEN 'no event_id' END AS reason""",
                           f"map_filter(fields, (k, x) -> x IS NOT NULL AND NOT exists(array({fits}), f -> f.name = k AND f.ok)) AS other")
    events = rows.where("reason IS NULL").selectExpr(*types, "IF(size(other) > 0, to_json(map_from_entries(array_sort(map_entries(other)))), NULL) AS rescued")
    return events, rows.where("reason IS NOT NULL").select("line", "reason")
