"""Values for outgoing JSON: ids derived from content, ISO-8601 times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(text: Column) -> Column:
    """A lowercase UUID-shaped id derived from text, equal on every replay."""
    return F.regexp_replace(F.md5(text), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def iso_time(moment: Column) -> Column:
    """Round-trip ISO-8601 text in UTC, seven fraction digits and offset."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0+00:00'")
