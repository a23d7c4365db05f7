"""JSON objects held as variants: strict parsing, field access and rewriting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

VARIANT_MAP = "map<string,variant>"


def with_object(df: DataFrame, data: Column, into: str) -> DataFrame:
    """Add UTF-8 JSON bytes as a variant object, NULL unless they are exactly one object.

    The parser ignores whatever follows the first value. The text is therefore parsed as the
    first item of a two-item array whose second item is a hash of the text: trailing text,
    a second value or an early bracket loses or displaces the hash. Built in steps, so that
    the text is parsed once.
    """
    text, mark, pair = (F.col(f"_{into}_{n}") for n in ("text", "mark", "pair"))
    opens = F.startswith(F.ltrim(text, F.lit(" \t\n\r")), F.lit("{"))
    return (
        df.withColumn(f"_{into}_text", F.try_validate_utf8(data.cast("string")))
        .withColumn(f"_{into}_mark", F.xxhash64(text).cast("string"))
        .withColumn(f"_{into}_pair", F.when(opens, F.try_parse_json(
            F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')))))
        .withColumn(into, F.when(
            F.try_variant_get(pair, "$[1]", "string") == mark,
            F.try_variant_get(pair, "$[0]", "variant")))
        .drop(*(f"_{into}_{n}" for n in ("text", "mark", "pair")))
    )


def field(obj: Column, name: str, type_: str = "string") -> Column:
    """A top-level field, NULL if absent, null or of another kind."""
    return F.try_variant_get(obj, f"$.{name}", type_)


def keys(obj: Column) -> Column:
    """The keys that are present, those with a null value included."""
    return F.map_keys(obj.cast(VARIANT_MAP))


def missing_keys(obj: Column, required: list[str]) -> Column:
    """The required keys that the object lacks; a key with a null value is present.

    Looks the keys up rather than listing all of them, and without a lambda, which would
    keep the whole operator out of code generation.
    """
    present = [F.when(field(obj, k, "variant").isNotNull(), F.lit(k)) for k in required]
    lacking = F.array_except(F.array(*[F.lit(k) for k in required]), F.array(*present))
    return F.when(obj.isNotNull(), lacking)


def without_keys(obj: Column, names: list[str]) -> Column:
    """The object as a map without some keys."""
    return F.map_filter(obj.cast(VARIANT_MAP), lambda k, _: ~k.isin(*names))


def with_strings(obj: Column, fields: dict[str, Column]) -> Column:
    """JSON text of the object with string fields set; a NULL string sets nothing."""
    new = F.map_filter(
        F.create_map(*[c for k, v in fields.items() for c in (F.lit(k), v)]),
        lambda _, v: v.isNotNull(),
    )
    old = F.map_filter(
        obj.cast(VARIANT_MAP), lambda k, _: ~F.array_contains(F.map_keys(new), k)
    )
    return F.to_json(F.map_concat(old, new.cast(VARIANT_MAP)))
