"""Deterministic identifiers: name-based UUIDs (version 5) as a native expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The namespaces in which event and alert identifiers are derived.
EVENTS = "2f1b1a54-8f9a-4a9a-9b9e-6e8a2f6a9b30"
ALERTS = "7c3a9f1e-2b6d-4b8b-9b0a-0f7f2a6a5b40"


def uuid5(namespace: str, name: Column) -> Column:
    """The UUID of a name in a namespace: SHA-1 of both with version and variant set; null for a null name."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.substring(F.lit("89ab"), F.pmod(F.conv(F.substring(h, 17, 1), 16, 10).cast("int"), F.lit(4)) + 1, F.lit(1))
    parts = [F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12)]
    return F.when(name.isNotNull(), F.concat_ws("-", *parts))
