"""Value checks. Each rule is a Column that is true where a value breaks it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# White space that Python's str.strip removes, as a Java character class.
_SPACE = r"[\s\x1c-\x1f]+"


def stripped(text: Column) -> Column:
    """Text without leading and trailing Unicode white space."""
    return F.regexp_replace(text, rf"(?U)^{_SPACE}|{_SPACE}\z", "")


def falsy(value: Column, kind: str) -> Column:
    """NULL, or empty (kind "text" or "list"), or zero (kind "number"), or false ("flag")."""
    empty = {
        "text": lambda c: c == "",
        "number": lambda c: c == 0,
        "list": lambda c: F.size(c) == 0,
        "flag": lambda c: ~c,
    }[kind](value)
    return value.isNull() | empty


def blank(text: Column) -> Column:
    return text.isNull() | (stripped(text) == "")


def below(number: Column, minimum: float = 1) -> Column:
    return number.isNull() | (number < minimum)


def control_position(text: Column, allowed: str = "") -> Column:
    """Position of the first control character (category C), -1 if there is none.

    Counted in code points, over the whole text; `allowed` holds characters to pass over.
    """
    if allowed:
        chars = "".join(f"\\x{{{ord(c):x}}}" for c in allowed)
        hit, clean = rf"[\p{{C}}&&[^{chars}]]", rf"[\P{{C}}{chars}]"
    else:
        hit, clean = r"\p{C}", r"\P{C}"
    prefix = F.regexp_extract(text, rf"^({clean}*+)", 1)
    return F.when(text.rlike(hit), F.length(prefix)).otherwise(F.lit(-1))


def zoneless(text: Column) -> Column:
    """Not a timestamp text that carries its zone."""
    return ~F.coalesce(
        text.rlike(r"T?\d{2}:\d{2}.*(Z|[+-]\d{2}:?\d{2})\z")
        & F.try_to_timestamp(text).isNotNull(),
        F.lit(False),
    )


def bad_topic_name(text: Column) -> Column:
    """Not 1 to 249 letters, digits or dashes, after stripping."""
    name = stripped(text)
    return ~F.coalesce(
        F.length(name).between(1, 249) & name.rlike(r"^[a-zA-Z0-9-]+\z"), F.lit(False)
    )


def bad_checksum(text: Column) -> Column:
    """Not exactly 12 characters."""
    return ~F.coalesce(F.length(text) == 12, F.lit(False))


def check(df: DataFrame, rules: dict[str, Column], into: str = "violations") -> DataFrame:
    """Add the names of the broken rules, in the order given."""
    hits = F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    return df.withColumn(into, F.array_except(hits, F.array(F.lit(None).cast("string"))))
