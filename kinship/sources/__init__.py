"""Sources and sinks: rating files, the personal list, the driver's tables, JSON reports."""

from kinship.sources.files import expect_ratings, ingest_personal, ingest_ratings, ratings_profile, read_personal, read_ratings
from kinship.sources.sinks import write_report
from kinship.sources.tables import (
    PERSONAL_USER,
    load_table,
    personal_from_parts,
    ratings_from_orders,
    split_holding_out_items,
    split_ratings,
)

__all__ = [
    "PERSONAL_USER",
    "expect_ratings",
    "ingest_personal",
    "ingest_ratings",
    "load_table",
    "personal_from_parts",
    "ratings_from_orders",
    "ratings_profile",
    "read_personal",
    "read_ratings",
    "split_holding_out_items",
    "split_ratings",
    "write_report",
]
