"""Record checksum."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEEP_NULLS = {"ignoreNullFields": "false"}


def record_json(fields: dict[str, Column]) -> Column:
    """JSON text of the fields in name order, NULLs included."""
    return F.to_json(F.struct(*[fields[name].alias(name) for name in sorted(fields)]), _KEEP_NULLS)


def record_checksum(fields: dict[str, Column], extras: Column | None = None) -> Column:
    """SHA-256 over the sorted-key JSON of a record, undeclared fields included.

    Equal records give equal hashes whatever their key order was; the text is Spark's JSON.
    """
    parts = [record_json(fields)]
    if extras is not None:
        parts.append(F.coalesce(F.to_json(extras), F.lit("{}")))
    return F.sha2(F.concat_ws("|", *parts), 256)
