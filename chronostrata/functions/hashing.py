"""Hashes as built-in expressions; they equal md5 over the same UTF-8 text in any engine."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from chronostrata.fixed_values import HASH_SEPARATOR


def _text(c: Column | str) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.trim(column.cast("string")), F.lit(""))


def hashdiff(*cols: Column | str) -> Column:
    """Change hash of descriptive attributes. Case, outer spaces and NULL against blank do not
    count as a change; a value holding the separator can collide with its neighbours."""
    return F.md5(F.concat_ws(HASH_SEPARATOR, *[F.lower(_text(c)) for c in cols]))


def hash_key(*cols: Column | str) -> Column:
    """Hash key of a business key (hubs, links)."""
    return F.md5(F.concat_ws(HASH_SEPARATOR, *[F.upper(_text(c)) for c in cols]))


def version_key(*cols: Column | str) -> Column:
    """Repeatable identifier of one version, used where a random uuid would change on a rerun."""
    return F.md5(F.concat_ws(HASH_SEPARATOR, *[_text(c) for c in cols]))


def register_hash_function(spark: SparkSession, name: str, arguments: list[str]) -> None:
    """The same change hash under a name SQL can call."""
    parameters = ", ".join(f"{a} STRING" for a in arguments)
    parts = ", ".join(f"lower(coalesce(trim({a}), ''))" for a in arguments)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS STRING "
        f"RETURN md5(concat_ws('{HASH_SEPARATOR}', {parts}))"
    )
