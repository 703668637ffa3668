"""Event identity: an event_id stands for the UUID it spells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def identity(event_id: Column) -> Column:
    """16 bytes of the UUID that event_id spells, in whatever case, with or without hyphens, braces, blanks or urn:uuid:.

    Null for a null, empty or blank event_id. A text that spells no UUID keeps an identity of its
    own (its trimmed text behind 17 zero bytes), so that no row is lost and none is merged by mistake.
    """
    text = F.lower(F.trim(event_id))
    bare = F.translate(F.replace(text, F.lit("urn:uuid:"), F.lit("")), "-{} \t", "")
    return (
        F.when(bare.rlike("^[0-9a-f]{32}$"), F.unhex(bare))
        .when(F.length(text) > 0, F.concat(F.unhex(F.lit("00" * 17)), F.encode(text, "UTF-8")))
    )


def spelled(identity: Column) -> Column:
    """The identity in lower case with hyphens (8-4-4-4-12); other texts as they are."""
    h = F.lower(F.hex(identity))
    cut = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(F.length(identity) == 16, F.concat_ws("-", *cut)).otherwise(
        F.decode(F.substring(identity, 18, 1 << 30), "UTF-8")
    )
