"""Semantic checks of JSON records against the model's fields, row by row on VARIANT."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.values import is_finite, quoted
from riskframe.operators.features import FeatureSchema

NON_SCALAR = "non_scalar_feature"
INVALID_NUMERIC = "invalid_numeric"
INVALID_CATEGORICAL = "invalid_categorical"
NO_USABLE = "no_usable_features"
MALFORMED = "malformed_record"
CODES = (INVALID_CATEGORICAL, INVALID_NUMERIC, NO_USABLE, NON_SCALAR)
USABLE = "usable"

MESSAGES = {
    NON_SCALAR: "a model field must be a JSON scalar or null",
    INVALID_NUMERIC: "a numeric field must be a finite number or numeric text",
    INVALID_CATEGORICAL: "a categorical field must be non-blank text or null",
    NO_USABLE: "the record has no model field with a value",
    MALFORMED: "the record is not a JSON object",
}

# Text that reads as a finite decimal number, digit groups joined by single underscores.
FINITE_TEXT = (
    r"(?U)^\s*[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"
)


@dataclass(frozen=True)
class RecordContract:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]

    def __post_init__(self) -> None:
        names = self.numeric + self.categorical
        if not names:
            raise ValueError("the record contract names no fields")
        if any(not isinstance(n, str) or not n for n in names):
            raise ValueError("field names must be non-empty text")
        if len(set(names)) != len(names):
            raise ValueError("a field is listed twice or in two roles")

    @classmethod
    def of(cls, schema: FeatureSchema) -> RecordContract:
        return cls(tuple(schema.numeric), tuple(schema.categorical))


def field_path(name: str) -> str:
    quote = '"' if "'" in name else "'"
    return f"$[{quote}{name}{quote}]"


def _fields(contract: RecordContract) -> Column:
    """Model fields of the parsed record: name, role, VARIANT type name and text, read once each."""
    entries = []
    for names, numeric in ((contract.numeric, True), (contract.categorical, False)):
        for name in names:
            value = F.try_variant_get("_v", field_path(name), "variant")
            entries.append(
                F.struct(
                    F.lit(name).alias("field"),
                    F.lit(numeric).alias("numeric"),
                    F.schema_of_variant(value).alias("kind"),
                    F.try_variant_get("_v", field_path(name), "string").alias("text"),
                )
            )
    return F.array(*entries)


def _outcome(entry: Column) -> Column:
    """Issue code, ``usable``, or NULL when the field is absent or null."""
    kind, text = entry["kind"], entry["text"]
    is_text = kind == "STRING"
    is_number = ~kind.isin("STRING", "BOOLEAN")
    plain = F.regexp_replace(F.trim(text), "_", "").try_cast("double")
    numeric_good = F.when(is_text, text.rlike(FINITE_TEXT) & is_finite(plain)).otherwise(
        is_number & is_finite(text.try_cast("double"))
    )
    text_good = is_text & ~text.rlike(r"(?U)^\s*$")
    return (
        F.when(kind.isNull() | (kind == "VOID"), F.lit(None).cast("string"))
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.lit(NON_SCALAR))
        .when(
            entry["numeric"],
            F.when(F.coalesce(numeric_good, F.lit(False)), F.lit(USABLE)).otherwise(
                F.lit(INVALID_NUMERIC)
            ),
        )
        .when(F.coalesce(text_good, F.lit(False)), F.lit(USABLE))
        .otherwise(F.lit(INVALID_CATEGORICAL))
    )


def validate_records(
    df: DataFrame, contract: RecordContract, record_col: str = "record"
) -> DataFrame:
    """Add ``issues array<struct<field, code, message>>`` and ``accepted``.

    Unknown fields are ignored and NULL is allowed. ``no_usable_features`` is raised only for
    a record with nothing usable and nothing invalid. A record is parsed once and every model
    field is read once; the rest works on the small array of what was read.
    """
    parsed = df.withColumn("_v", F.try_parse_json(quoted(record_col)))
    is_object = F.col("_v").isNotNull() & F.ltrim(quoted(record_col)).startswith("{")
    outcomes = F.transform(
        F.when(is_object, _fields(contract)),
        lambda e: F.struct(e["field"].alias("field"), _outcome(e).alias("code")),
    )
    bad = F.filter("_outcomes", lambda o: o["code"] != USABLE)
    usable = F.exists("_outcomes", lambda o: F.coalesce(o["code"] == USABLE, F.lit(False)))

    def whole_record(code: str) -> Column:
        return F.array(
            F.struct(F.lit(None).cast("string").alias("field"), F.lit(code).alias("code"))
        )

    raised = (
        F.when(F.col("_outcomes").isNull(), whole_record(MALFORMED))
        .when(F.size(bad) > 0, bad)
        .when(~usable, whole_record(NO_USABLE))
        .otherwise(F.filter("_outcomes", lambda o: F.lit(False)))
    )
    message = F.create_map(*[F.lit(x) for pair in MESSAGES.items() for x in pair])
    issues = F.transform(
        F.col("_raised"),
        lambda i: F.struct(
            i["field"].alias("field"),
            i["code"].alias("code"),
            F.element_at(message, i["code"]).alias("message"),
        ),
    )
    # Filters are not pushed below a generator, so a later filter on ``accepted`` cannot make
    # Spark repeat the parsing and field access inside its own condition.
    return (
        parsed.select("*", F.explode(F.array(outcomes)).alias("_outcomes"))
        .withColumn("_raised", raised)
        .withColumn("issues", issues)
        .withColumn("accepted", F.size("issues") == 0)
        .drop("_v", "_outcomes", "_raised")
    )


def issue_table(validated: DataFrame, id_col: str = "record_id") -> DataFrame:
    """``id, field, code, message``, one row per issue."""
    exploded = validated.select(quoted(id_col).alias(id_col), F.explode_outer("issues").alias("i"))
    return exploded.filter(F.col("i").isNotNull()).select(
        id_col, "i.field", "i.code", "i.message"
    )


def code_label(code: Column) -> Column:
    """Bound the label set: unknown codes become ``other``."""
    return F.when(code.isin(*CODES), code).otherwise(F.lit("other"))


def reason_label(issues: Column) -> Column:
    """One bounded label per rejected record: its single code, else ``multiple``."""
    only = F.element_at(issues, 1)["code"]
    return F.when(F.size(issues) == 1, code_label(only)).otherwise(F.lit("multiple"))


def request_reasons(issues: DataFrame, request_col: str) -> DataFrame:
    """The same label per request of several records; counts only, nothing is collected."""
    return (
        issues.groupBy(request_col)
        .agg(F.count("*").alias("n"), F.min("code").alias("code"))
        .select(
            request_col,
            F.when(F.col("n") == 1, code_label(F.col("code")))
            .otherwise(F.lit("multiple"))
            .alias("reason"),
        )
    )


def split_records(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted records and quarantined ones."""
    return (
        validated.filter("accepted").drop("issues", "accepted"),
        validated.filter("NOT accepted").drop("accepted"),
    )


def record_fields(
    df: DataFrame, contract: RecordContract, keep: Sequence[str] = (), record_col: str = "record"
) -> DataFrame:
    """Model fields of accepted records as columns; numbers stay text for later coercion."""
    parsed = df.withColumn("_v", F.try_parse_json(quoted(record_col)))
    fields = [
        F.try_variant_get("_v", field_path(name), "string").alias(name)
        for name in contract.numeric + contract.categorical
    ]
    return parsed.select(*[quoted(c) for c in keep], *fields)
