"""The readiness rule: is a raw message a usable observation?

A message is ``valid`` when it is a JSON object whose volume is above zero and
whose symbol is truthy. The other outcomes are ``invalid`` (the rule says no),
``error`` (the rule cannot be applied: the document is not an object or the
volume is not a number) and ``decode_error`` (not JSON). No outcome raises.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotemill.functions.once import with_computed

VALID = "valid"
INVALID = "invalid"
ERROR = "error"
DECODE_ERROR = "decode_error"


def _kind(value: str) -> Column:
    """Leading word of a variant's type: BIGINT, STRING, ARRAY, OBJECT, VOID..."""
    return F.substring_index(F.schema_of_variant(value), "<", 1)


def _truthy(value: str, kind: Column) -> Column:
    text = F.try_variant_get(value, "$", "string")
    number = F.try_variant_get(value, "$", "double")
    return (
        F.when(kind == "STRING", text != "")
        .when(kind == "VOID", False)
        .when(kind == "BOOLEAN", text == "true")
        .when(kind == "ARRAY", text != "[]")
        .when(kind == "OBJECT", text != "{}")
        .otherwise(number != 0)
    )


def with_outcome(
    messages: DataFrame, text: Column, symbol_key: str, volume_key: str, name: str = "outcome",
) -> DataFrame:
    """Adds the outcome of the rule for the message text.

    The steps are separate projections: each message is parsed once and every
    step stays in generated code.
    """
    above_zero = F.coalesce(F.try_variant_get("_volume", "$", "double") > 0, F.lit(False))
    outcome = (
        F.when(F.col("_document").isNull(), DECODE_ERROR)
        .when(~F.ltrim(F.col("_text"), F.lit(" \t\r\n")).startswith("{"), ERROR)
        .when(F.col("_volume").isNull(), INVALID)
        .when(F.col("_volume_kind").isin("VOID", "STRING", "ARRAY", "OBJECT"), ERROR)
        .when(~above_zero, INVALID)
        .when(F.col("_symbol").isNull(), INVALID)
        .when(_truthy("_symbol", F.col("_symbol_kind")), VALID)
        .otherwise(INVALID)
    )
    parsed = (
        messages.withColumn("_text", text)
        .withColumn("_document", F.try_parse_json("_text"))
        .withColumns({
            "_volume": F.try_variant_get("_document", f"$.{volume_key}", "variant"),
            "_symbol": F.try_variant_get("_document", f"$.{symbol_key}", "variant"),
        })
        .withColumns({"_volume_kind": _kind("_volume"), "_symbol_kind": _kind("_symbol")})
        .withColumn("_outcome", outcome)
        .select(*messages.columns, "_outcome")
    )
    return with_computed(parsed, name, F.col("_outcome")).drop("_outcome")
