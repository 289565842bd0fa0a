"""Classification and repair of dead-letter and stream messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.intervals import Moment, moment
from tidemark.functions.jsontext import (
    add_fields,
    has_field,
    is_whole_object,
    last_value,
    object_fields,
)

# Fixed values of the replay contract.
REQUIRED_FIELDS = ("user_id", "event_type")
VALID_EVENT_TYPES = ("purchase", "view", "add_to_cart", "checkout", "refund")
MAX_LOGGED_CHARS = 2000

# Spelling of the stream producer for the same fields.
STREAM_ALIASES = {"user_id": "userId", "event_type": "eventType", "product_id": "productId"}


def classify_messages(
    raw: DataFrame,
    required: tuple[str, ...] = REQUIRED_FIELDS,
    allowed: tuple[str, ...] = VALID_EVENT_TYPES,
    as_of: Moment | Column | None = None,
    aliases: Mapping[str, str] | None = None,
    value_col: str = "value",
) -> DataFrame:
    """Add `reason` (NULL if the message is fixable), `event_type` and `fixed_value`.

    Checks run in this order: the text is one JSON object; every required key is
    present, where a JSON null counts as present; the event type is allowed,
    case-sensitively. A fixable message gets a null product_id and `as_of` as
    timestamp where the keys are absent, and otherwise keeps its text. The whole
    text is examined; of a repeated key the last value counts. `aliases` maps a field to a second accepted key.
    """
    aliases = dict(aliases or {})

    def names(field: str) -> list[str]:
        return [field] + ([aliases[field]] if field in aliases else [])

    def value_of(field: str) -> Column:
        return F.coalesce(*[last_value(F.col("_fields"), n) for n in names(field)])

    if as_of is None:
        stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    elif isinstance(as_of, Column):
        stamp = F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    else:
        stamp = F.lit(moment(as_of).isoformat())

    fields = F.col("_fields")
    # concat_ws skips the NULLs of the fields that are present.
    missing = F.concat_ws(
        ", ", *[F.when(~has_field(fields, *names(f)), F.lit(f)) for f in sorted(required)]
    )
    event_type = value_of("event_type")
    reason = (
        F.when(~is_whole_object(F.col(value_col), fields), F.lit("invalid_json"))
        .when(missing != "", F.concat(F.lit("missing_required: "), missing))
        .when(
            ~F.coalesce(event_type.isin(list(allowed)), F.lit(False)),
            F.concat(F.lit("invalid_event_type: "), F.coalesce(event_type, F.lit("None"))),
        )
    )
    product_key = aliases.get("product_id", "product_id")
    additions = F.concat(
        F.when(has_field(fields, *names("product_id")), F.lit("")).otherwise(
            F.lit(f', "{product_key}": null')
        ),
        F.when(has_field(fields, "timestamp"), F.lit("")).otherwise(
            F.concat(F.lit(', "timestamp": "'), stamp, F.lit('"'))
        ),
    )
    # A generated column is not inlined into filters, so a text is parsed once.
    parsed = F.explode(F.array(object_fields(F.col(value_col))))
    return (
        raw.withColumn("_fields", parsed)
        .withColumns({"reason": reason, "event_type": event_type})
        .withColumn(
            "fixed_value",
            F.when(F.col("reason").isNull(), add_fields(F.col(value_col), additions)),
        )
        .drop("_fields")
    )


def split_valid_dlq(classified: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(fixable, unrecoverable); every message lands in exactly one of them."""
    fixable = classified.filter(F.col("reason").isNull())
    unrecoverable = classified.filter(F.col("reason").isNotNull()).drop("fixed_value", "event_type")
    return fixable, unrecoverable


def unrecoverable_log(
    unrecoverable: DataFrame, max_chars: int | None = None
) -> DataFrame:
    """Audit rows with the whole text, or cut to `max_chars` where a column is that narrow."""
    raw = F.col("value") if max_chars is None else F.substring("value", 1, max_chars)
    return unrecoverable.select(
        F.col("offset").alias("kafka_offset"), "partition", raw.alias("raw_value"), "reason"
    )
