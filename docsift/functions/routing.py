"""Decisions on drafts and extractions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# Fixed thresholds and labels.
FIELD_CONFIDENCE = 0.85
AUTO_CONFIDENCE = 0.95
REDACTED = "[REDACTED]"
FIELD_FLAGGED = "FLAGGED_FOR_REVIEW"
FIELD_PROCESSED = "PROCESSED"
DOCUMENT_REVIEW = "MANUAL_REVIEW_REQUIRED"
DOCUMENT_CLEARED = "CLEARED"


def approval(approved: Column | str) -> Column:
    """Struct ``status, action`` of a reviewer's decision."""
    yes = F.struct(F.lit("approved").alias("status"), F.lit("email_sent").alias("action"))
    no = F.struct(F.lit("rejected").alias("status"), F.lit("archived_for_review").alias("action"))
    return F.when(col(approved), yes).otherwise(no)


def confidence_route(score: Column | str) -> Column:
    """``auto`` above the threshold; at or below it, or unknown, ``review``."""
    return F.when(col(score) > AUTO_CONFIDENCE, "auto").otherwise("review")


def field_status(confidence: Column | str) -> Column:
    return F.when(col(confidence) < FIELD_CONFIDENCE, FIELD_FLAGGED).otherwise(FIELD_PROCESSED)


def document_status(needs_review: Column | str) -> Column:
    return F.when(col(needs_review), DOCUMENT_REVIEW).otherwise(DOCUMENT_CLEARED)
