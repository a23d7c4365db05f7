"""Names, labels and image references."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def namespace_prefix(user: Column) -> Column:
    """Prefix of the namespaces that belong to a user."""
    return F.concat(F.lit("u_"), user, F.lit("__"))


def job_label(job_id: Column) -> Column:
    return F.concat(F.lit("job_id_"), job_id)


def run_label(prefix: Column, default: str = "integration_test") -> Column:
    """A label that is new for every row."""
    return F.concat(run_prefix(prefix, default), F.lit("_"), F.uuid())


def run_prefix(prefix: Column, default: str = "integration_test") -> Column:
    """The given prefix, or the default where it is NULL or empty."""
    return F.coalesce(F.nullif(prefix, F.lit("")), F.lit(default))


def identifier(name: Column) -> Column:
    """A name usable as a catalog identifier."""
    return F.replace(name, F.lit("-"), F.lit("_"))


def image_name(ref: Column) -> Column:
    """Image name without tag and digest; a registry port is not a tag."""
    return F.regexp_replace(F.split_part(ref, F.lit("@"), F.lit(1)), ":[^/:]*$", "")


def image_tag(ref: Column) -> Column:
    """The tag, or NULL."""
    tag = F.regexp_extract(F.split_part(ref, F.lit("@"), F.lit(1)), ":([^/:]*)$", 1)
    return F.nullif(tag, F.lit(""))


def image_digest(ref: Column) -> Column:
    """The digest, or NULL."""
    return F.nullif(F.split_part(ref, F.lit("@"), F.lit(2)), F.lit(""))


def compose_image(name: Column, digest: Column) -> Column:
    return F.concat_ws("@", name, digest)


def redact(df, safe: list[str], text: str = "REDACTED"):
    """Keep the safe columns and replace every other one by a constant."""
    return df.select(
        *[F.col(c) if c in safe else F.lit(text).alias(c) for c in df.columns]
    )


def audit_json(fields: dict[str, Column], at: Column) -> Column:
    """One JSON text per row: NULL fields dropped, time in milliseconds with zone."""
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSxxx")
    return F.to_json(
        F.struct(*[v.alias(k) for k, v in fields.items()], stamp.alias("asctime"))
    )
