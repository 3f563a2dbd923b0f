"""Which raw column holds which vendor field, names compared without case."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sunledger.operators.registry import LINEAGE, Mapping


# Names that the job gives to columns of its own, and to partitions.
WORK_COLUMNS = (
    "dataset_id", "file_path", "block_start", "scan_id", "failures", "row_index", "reason_code", "ingestion_date", "data_date",
    "event_schema_version", "event_site_id", "parse_id", "event_key", "checked_ms", "layout_no",
)


class RawLayout:
    """The header of a group of files, and the text column behind each name.

    ``column(i)`` gives the text column of header position ``i``. A name that is
    repeated exactly keeps its first position; names that differ only by case
    are one field, and the last spelling holds its value.
    """

    def __init__(self, header: Sequence[str], column: Callable[[int], Column]):
        self.header = list(header)
        self._column = column
        self._position: dict[str, int] = {}
        self._spelling: dict[str, str] = {}
        for name in dict.fromkeys(self.header):
            self._position[name.lower()] = self.header.index(name)
            self._spelling.setdefault(name.lower(), name)

    @staticmethod
    def of_columns(names: Sequence[str]) -> RawLayout:
        """Layout of a DataFrame whose text columns carry the vendor names."""
        return RawLayout(names, lambda i: F.col(f"`{names[i]}`"))

    def has(self, name: str) -> bool:
        return name.lower() in self._position

    def get(self, name: str) -> Column | None:
        """Text of a field; a short row reads as empty text, an absent field as None."""
        if not self.has(name):
            return None
        return F.coalesce(self._column(self._position[name.lower()]), F.lit(""))

    def missing(self, mapping: Mapping) -> list[str]:
        return [c.vendor_column for c in mapping.columns if not self.has(c.vendor_column)]

    def pass_through(self, mapping: Mapping) -> list[str]:
        """Names kept as raw text: neither mapped, nor canonical, nor lineage names."""
        if not mapping.pass_through:
            return []
        taken = {c.vendor_column.lower() for c in mapping.columns}
        taken |= {c.canonical_field.lower() for c in mapping.columns}
        taken |= set(LINEAGE)
        return [spelling for key, spelling in self._spelling.items() if key not in taken]

    def stored_names(self, mapping: Mapping) -> dict[str, str]:
        """How each name of :meth:`pass_through` is stored: as it is, or after ``vendor_`` where
        the job uses the name itself. An empty name is stored as ``vendor_``."""
        names = self.pass_through(mapping)
        used = {n.lower() for n in names} - set(WORK_COLUMNS)
        stored = {}
        for name in names:
            new = name
            if name.lower() in WORK_COLUMNS or not name.strip() or name.startswith("__"):
                new = f"vendor_{name}"
                while new.lower() in used:
                    new = f"vendor_{new}"
                used.add(new.lower())
            stored[name] = new
        return stored
