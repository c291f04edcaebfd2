"""Enumerated domains of the catalogue tables.

Comparison of an enumerated value is by its position in the declaration,
not by its text, so the order below is part of the semantics.
"""

from __future__ import annotations

from ledgerline.functions.enums import EnumType

# --- fixed values: enum domains of the catalogue schema, in declaration order ---
MEDIA_TYPE = EnumType("media_type", ("movie", "tv_show", "tv_season", "unknown"))
PIPELINE_STATUS = EnumType(
    "pipeline_status",
    (
        "ingested",
        "paused",
        "parsed",
        "rejected",
        "file_accepted",
        "metadata_collected",
        "media_accepted",
        "downloading",
        "downloaded",
        "transferred",
        "complete",
    ),
)
REJECTION_STATUS = EnumType("rejection_status", ("unfiltered", "accepted", "rejected", "override"))
RSS_SOURCE = EnumType("rss_source", ("yts.mx", "episodefeed.com"))
# The label domain is used by the sync but never declared with the others;
# its two values are the ones the sync produces.
LABEL_TYPE = EnumType("label_type", ("would_watch", "would_not_watch"))

# Statuses that make a title a positive example, and the one that means
# "not judged yet" (fixed values of the label rule).
POSITIVE_STATUSES = ("accepted", "override")
UNJUDGED_STATUS = "unfiltered"
POSITIVE_LABEL = "would_watch"
NEGATIVE_LABEL = "would_not_watch"
# --- end of fixed values ---

CATALOGUE_ENUMS = {e.name: e for e in (MEDIA_TYPE, PIPELINE_STATUS, REJECTION_STATUS, RSS_SOURCE, LABEL_TYPE)}
