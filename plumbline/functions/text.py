"""Text functions: pseudonyms, names, number and date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_name(name: str) -> str:
    """A column name inside SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A text literal inside SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str) -> Column:
    """Column by its exact name, also when the name holds dots."""
    return F.col(sql_name(name))


def is_usable(value: Column, floating: bool = False) -> Column:
    """Neither NULL nor, for floating-point columns, NaN."""
    return value.isNotNull() & ~F.isnan(value) if floating else value.isNotNull()


def pseudonym(value: Column, salt: str, prefix: str = "ANON") -> Column:
    """Prefix, underscore and the first 16 hex digits of SHA-256 over salt|lower(trim(value)); blanks stay as they are."""
    digest = F.sha2(F.concat(F.lit(salt), F.lit("|"), F.lower(F.trim(value))), 256)
    return F.when(F.trim(value) != "", F.concat(F.lit(f"{prefix}_"), F.substring(digest, 1, 16))).otherwise(value)


def characteristic_name(name: Column) -> Column:
    """Spaces become underscores, then '_-_' becomes '_'; a missing name is ''."""
    underscored = F.replace(name, F.lit(" "), F.lit("_"))
    return F.coalesce(F.replace(underscored, F.lit("_-_"), F.lit("_")), F.lit(""))


# Spark's own text of the double v. Where it has 17 digits or more the runtime may print more than needed, so 16 and
# 17 digits are tried.
_PRINTED = """
CASE WHEN length(translate(substring_index(CAST(v AS string), 'E', 1), '-.', '')) < 17 THEN CAST(v AS string)
     WHEN try_cast(format_string('%.15e', v) AS double) = v THEN upper(format_string('%.15e', v))
     WHEN try_cast(format_string('%.16e', v) AS double) = v THEN upper(format_string('%.16e', v))
     ELSE CAST(v AS string) END"""

# d.dddE[-]n taken apart, and written with plain digits for exponents -4 to 15, else as d.ddde-07.
_TAKEN_APART = """
struct(CASE WHEN startswith(p, '-') THEN '-' ELSE '' END AS sign, CAST(substring_index(p, 'E', -1) AS int) AS e,
       coalesce(nullif(rtrim('0', translate(substring_index(p, 'E', 1), '-.', '')), ''), '0') AS d)"""
_WRITTEN = """
concat(x.sign, CASE
  WHEN x.e BETWEEN 0 AND 15 AND length(x.d) <= x.e + 1 THEN concat(rpad(x.d, x.e + 1, '0'), '.0')
  WHEN x.e BETWEEN 0 AND 15 THEN concat(left(x.d, x.e + 1), '.', substr(x.d, x.e + 2))
  WHEN x.e BETWEEN -4 AND -1 THEN concat('0.', repeat('0', -x.e - 1), x.d)
  ELSE concat(left(x.d, 1), CASE WHEN length(x.d) > 1 THEN concat('.', substr(x.d, 2)) ELSE '' END,
              CASE WHEN x.e < 0 THEN 'e-' ELSE 'e+' END, CASE WHEN abs(x.e) < 10 THEN '0' ELSE '' END, abs(x.e)) END)"""


def double_text(value: str) -> str:
    """SQL for the shortest decimal text as Python and SQL engines print it: 10000000.0, 0.0001, 1e-05, 1e+16.

    Spark prints 1.0E7 instead; the common numbers that it prints without an exponent and with few digits pass straight
    through. In the rest, ``get(transform(array(x), name -> ...), 0)`` names an intermediate value.
    """
    scientific = f"get(transform(array({_TAKEN_APART}), x -> {_WRITTEN}), 0)"
    plain = f"({value} = 0 OR abs({value}) >= 1e-3D AND abs({value}) < 1e7D) AND length(CAST({value} AS string)) < 18"
    return f"""CASE WHEN {plain} THEN CAST({value} AS string) ELSE get(transform(transform(array({value}), v -> {_PRINTED}), p -> CASE WHEN p = 'NaN' THEN 'nan'
        WHEN endswith(p, 'Infinity') THEN replace(p, 'Infinity', 'inf') WHEN NOT contains(p, 'E') THEN p
        ELSE {scientific} END), 0) END"""


def timestamp_text(value: Column, separator: str = "T") -> Column:
    """ISO text of a timestamp in the session time zone; the fraction (six digits) only if it is not zero."""
    value = value.cast("timestamp")
    whole = F.date_format(value, f"yyyy-MM-dd'{separator}'HH:mm:ss")
    fraction = F.pmod(F.unix_micros(value), F.lit(1_000_000))
    return F.when(fraction == 0, whole).otherwise(F.concat(whole, F.date_format(value, ".SSSSSS")))
