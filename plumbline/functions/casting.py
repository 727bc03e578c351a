"""Safe casts to the characteristic types of a template.

The functions take and return SQL expression text. A template may have hundreds of characteristics; as text each of them
costs one call to the JVM when the plan is built. All casts are ``try_cast``, so the outcome (NULL for a value that does
not fit) never depends on ``spark.sql.ansi.enabled``.
"""

from __future__ import annotations

from pyspark.sql import types as T

from plumbline.functions.text import sql_text

# The type names a template may use.
TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "maindata": T.StringType(),
    "iotsignal": T.StringType(),
    "iotsynoptic": T.StringType(),
    "date": T.TimestampType(),
    "double": T.DoubleType(),
    "integer": T.IntegerType(),
    "boolean": T.BooleanType(),
}

# Texts a boolean default may be written as.
TRUE_WORDS = {"true", "1", "yes", "y"}
FALSE_WORDS = {"false", "0", "no", "n"}

# Text that Spark's non-ANSI cast reads as an integer: optional sign, digits, a fraction that is cut off, and
# white space or control characters around it. Group 1 is the sign, group 2 the integer part (may be empty: ".5" is 0).
_INTEGER_TEXT = r"r'^[\x00-\x20\x7f]*([+-]?)([0-9]*)(?:[.][0-9]*)?[\x00-\x20\x7f]*$'"
_PLAIN_INTEGER = r"r'^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*\z'"
# Every text that casts to a double looks like this, and hardly any other does: digits, hex digits, exponents and suffixes, NaN, Infinity.
_DOUBLE_TEXT = r"r'^[\x00-\x20\x7f]*[+-]?[0-9.niNI][0-9a-fA-FxXpPiInNtTyY.+\x00-\x20\x7f-]*\z'"


def spark_type(type_name: str | None) -> T.DataType:
    """Spark type of a template type name (any letter case); an unknown, empty or missing name is an error."""
    try:
        return TYPES[(type_name or "").lower()]
    except KeyError:
        raise ValueError(f"Unsupported characteristic type: {type_name}") from None


def can_cast(source: T.DataType, target: T.DataType) -> bool:
    """Whether ``try_cast`` from source to target passes analysis; other pairs are treated as never castable."""
    if isinstance(target, T.StringType) or isinstance(source, (T.StringType, T.NullType)):
        return True
    if isinstance(source, T.NumericType):
        return True
    if isinstance(source, T.BooleanType):
        return not isinstance(target, T.TimestampType)
    if isinstance(source, T.TimestampType):
        return not isinstance(target, T.BooleanType)
    if isinstance(source, (T.DateType, T.TimestampNTZType)):
        return isinstance(target, T.TimestampType)
    return False


def blank_to_null(value: str, source: T.DataType | None = None) -> str:
    """NULL for values whose text is empty or spaces only (tabs are not blank).

    A number, date or boolean never prints as blank, so for those source types the expression is returned as it is and
    no text conversion runs per row.
    """
    if isinstance(source, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value
    return f"CASE WHEN trim(CAST({value} AS string)) <> '' THEN {value} END"


def text_to_integer(text: str) -> str:
    """Integer from text as the non-ANSI cast reads it: '3.7' is 3, '.5' is 0, out of range or other text is NULL.

    Only text of plain digits is cast as it is: where a cast fails, an exception is made and caught, which costs far more than a pattern.
    """
    sign, whole = (f"regexp_extract({text}, {_INTEGER_TEXT}, {group})" for group in (1, 2))
    relaxed = f"try_cast(concat({sign}, coalesce(nullif({whole}, ''), '0')) AS int)"
    return (f"CASE WHEN {text} RLIKE {_PLAIN_INTEGER} THEN try_cast({text} AS int) "
            f"WHEN {text} RLIKE {_INTEGER_TEXT} AND {text} RLIKE '[0-9.]' THEN {relaxed} END")


def safe_cast(value: str, source: T.DataType, type_name: str) -> str:
    """Cast to a template type; whatever does not fit becomes NULL."""
    target = spark_type(type_name)
    if not can_cast(source, target):
        return typed_null(type_name)
    if source == target:
        return value
    if isinstance(target, T.IntegerType) and isinstance(source, T.StringType):
        return text_to_integer(value)
    if isinstance(target, T.DoubleType) and isinstance(source, T.StringType):
        return f"CASE WHEN {value} RLIKE {_DOUBLE_TEXT} THEN try_cast({value} AS double) END"
    return f"try_cast({value} AS {target.simpleString()})"


def typed_null(type_name: str) -> str:
    return f"CAST(NULL AS {spark_type(type_name).simpleString()})"


def cast_can_fail(source: T.DataType, type_name: str) -> bool:
    """False where a non-NULL source value always gives a non-NULL result, so no invalid-type test is needed."""
    target = spark_type(type_name)
    if isinstance(target, T.StringType) or source == target:
        return False
    widening = isinstance(source, (T.ByteType, T.ShortType, T.IntegerType))
    return not (widening and isinstance(target, (T.IntegerType, T.DoubleType)))


def default_literal(value, type_name: str) -> str:
    """A configured default as a typed literal."""
    target = spark_type(type_name)
    if value is None:
        return typed_null(type_name)
    if isinstance(target, T.TimestampType):
        return f"try_to_timestamp({sql_text(str(value))})"
    if isinstance(target, T.BooleanType):
        word = str(value).strip().lower()
        if word in TRUE_WORDS:
            return "true"
        if word in FALSE_WORDS:
            return "false"
        raise ValueError(f"Invalid boolean default value: {value}")
    text = sql_text(str(value))
    if isinstance(target, T.StringType):
        return text
    if isinstance(value, bool):
        return f"try_cast({str(value).lower()} AS {target.simpleString()})"
    return text_to_integer(text) if isinstance(target, T.IntegerType) and isinstance(value, str) \
        else f"try_cast(try_cast({text} AS double) AS {target.simpleString()})"
