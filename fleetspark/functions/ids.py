"""Deterministic ids as JVM-side column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URL namespace of RFC 4122.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5_url(name: Column) -> Column:
    """Version-5 UUID of a name: the SHA-1 digest with version and variant bits set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def incident_id(event_id: Column, kind: Column) -> Column:
    """Id of the incident of one kind that a reading opens."""
    return uuid5_url(F.concat(event_id, F.lit(":"), kind))


def canonical_uuid(text: Column) -> Column:
    """Lower-case 8-4-4-4-12 form of a UUID, null when the text is not one."""
    low = F.lower(text)
    spelled = low.rlike(r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}\z")
    compact = low.rlike(r"^[0-9a-f]{32}\z")
    parts = F.regexp_replace(low, "^(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5")
    return F.when(spelled, low).when(compact, parts)
