"""Check flat topic records against their contract at the archive boundary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmarts.contracts import ERROR_EMPTY_PAYLOAD, EventType
from eventmarts.functions import json_fields as J
from eventmarts.functions import times


def _breaches(event: EventType) -> list[tuple[Column, Column]]:
    """Conditions that break the contract, each with its name: the field is ``missing:``, has
    the wrong ``type:``, or is an ``extra:`` one."""
    found: list[tuple[Column, Column]] = []
    for f in event.record.fields:
        value = F.col("_members")[f.name]
        if isinstance(f.dataType, T.TimestampType):
            fits = F.col("_created").isNotNull()
        elif isinstance(f.dataType, T.ArrayType):
            fits = J.is_optional_string_list(value)
        elif f.nullable:
            fits = value.isNull() | F.is_variant_null(value) | J.is_string(value)
        else:
            fits = J.is_string(value)
        if not f.nullable:
            found.append((value.isNull(), F.lit(f"missing:{f.name}")))
            fits = value.isNull() | fits
        found.append((~fits, F.lit(f"type:{f.name}")))
    declared = F.array(*[F.lit(n) for n in event.record.names])
    extra = F.array_except(F.map_keys("_members"), declared)
    names = F.concat(F.lit("extra:"), F.array_join(F.sort_array(extra), ",extra:"))
    found.append((F.size(extra) > 0, names))
    return found


def validate_flat(records: DataFrame, event: EventType, payload: str = "payload") -> DataFrame:
    """Decode each record; ``error`` and ``raw_payload`` are null on rows that keep the contract.

    ``payload`` is JSON text, or a struct as a schema-aware reader delivers it.  Rows are
    neither dropped nor raised on.  A null language list becomes an empty one.
    """
    source = F.col(payload)
    is_text = isinstance(records.schema[payload].dataType, T.StringType)
    value = J.parse(source) if is_text else F.to_variant_object(source)
    split = records.withColumn("_value", value).withColumn("_members", J.members("_value"))
    created = F.col("_members")["created_at"]
    timed = split.select(
        "*", J.kind(created).alias("_created_kind"), J.text(created).alias("_created_text")
    ).withColumn(
        "_created", times.value_to_timestamp(F.col("_created_kind"), F.col("_created_text"))
    )
    # A step for each breach, so that each is looked at once; one decision over all of them has to name them again.
    checked, found = timed, []
    for n, (bad, name) in enumerate(_breaches(event)):
        found.append(f"_breach{n}")
        checked = J.hold(checked, **{found[-1]: F.when(bad, name)})
    named = F.concat_ws(",", *found)
    error = (
        F.when(F.col("_value").isNull() | F.is_variant_null("_value"), F.lit(ERROR_EMPTY_PAYLOAD))
        .when(F.col("_members").isNull(), F.lit("type:record"))
        .when(named != "", named)
    )
    checked = J.hold(checked, error=error)

    def field(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.TimestampType):
            return F.col("_created").alias(f.name)
        value = F.col("_members")[f.name]
        if isinstance(f.dataType, T.ArrayType):
            return F.coalesce(J.string_list(value), F.array().cast("array<string>")).alias(f.name)
        return J.text(value).alias(f.name)

    as_text = source if is_text else F.to_json(source)
    raw_payload = F.coalesce(J.canonical_json("_value"), as_text, F.lit("null"))
    kept = [c for c in records.columns if c != payload and c not in event.record.names]
    return checked.select(
        *kept,
        "error",
        F.when(F.col("error").isNotNull(), raw_payload).alias("raw_payload"),
        *[field(f) for f in event.record.fields],
    )


def accepted(validated: DataFrame, event: EventType) -> DataFrame:
    """Rows that keep the contract, in bronze column order."""
    return validated.where(F.col("error").isNull()).select(*event.bronze.names)


def rejected(validated: DataFrame, event: EventType, received_at: Column) -> DataFrame:
    """Dead-letter envelopes of the rows that break the contract; the topic is named in full."""
    return validated.where(F.col("error").isNotNull()).select(
        "raw_payload",
        "error",
        F.lit(event.topic).alias("intended_topic"),
        received_at.alias("received_at"),
    )
