"""Storage URIs: the absolute-URI check, container and blob, path keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_decode(text: Column) -> Column:
    """Decode %XX only; a plus sign is an ordinary character in a path."""
    return F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def is_absolute(uri: Column) -> Column:
    return F.coalesce(F.length(F.try_parse_url(uri, F.lit("HOST"))) > 0, F.lit(False))


def _path_segments(uri: Column) -> Column:
    path = F.regexp_replace(F.try_parse_url(uri, F.lit("PATH")), "^/", "")
    host = F.try_parse_url(uri, F.lit("HOST"))
    # Path-style endpoints (an IP address, localhost or a bare service name)
    # carry the account as the first segment.
    path_style = host.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") | ~host.contains(".")
    return F.when(path_style, F.regexp_replace(path, "^[^/]*/?", "")).otherwise(path)


def container(uri: Column) -> Column:
    return percent_decode(F.regexp_extract(_path_segments(uri), "^([^/]*)", 1))


def blob(uri: Column) -> Column:
    return percent_decode(F.regexp_extract(_path_segments(uri), "^[^/]*/(.*)$", 1))


def path_key(blob_name: Column, key: str) -> Column:
    """Value of one ``key=value`` folder of a decoded path; NULL when absent."""
    return F.nullif(F.regexp_extract(blob_name, rf"(?:^|/){key}=([^/]*)/", 1), F.lit(""))


def file_version(blob_name: Column) -> Column:
    """N of a file named ``<name>_v<N>.csv``; NULL when it has none."""
    return F.regexp_extract(blob_name, r"_v([0-9]+)\.csv$", 1).try_cast("int")


def storage_fields(uri: Column) -> dict[str, Column]:
    name = blob(uri)
    return {
        "container": container(uri),
        "blob": name,
        "path_source": path_key(name, "source"),
        "path_dataset": path_key(name, "dataset"),
        "path_ingestion_date": path_key(name, "ingestion_date"),
        "file_version": file_version(name),
    }
