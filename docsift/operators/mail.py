"""Mail: cleaning, customer lookup, privacy, review history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.privacy import PATTERNS, Span, has_pii, privacy_label, redaction, redaction_of_kinds, restored
from ..functions.prompts import mail_context
from ..functions.text import mail_body
from .order import best_per_group, first_rows


def clean_mail(
    df: DataFrame, order: list[str], max_samples: int | None = None, message: str = "message", min_chars: int = 50
) -> DataFrame:
    """The first ``max_samples`` messages (null: all), then the bodies longer than ``min_chars`` of those."""
    top = first_rows(df.where(F.col(message).isNotNull()), order, max_samples)
    return top.withColumn("email_text", mail_body(message)).where(F.length("email_text") > min_chars)


def scan_mail(mail: DataFrame, company: str | Column, text: str = "email_text") -> DataFrame:
    """Adds ``pii_found``, ``privacy_scan`` and ``contextual_text``.

    Only the mail is scanned. It is flagged, not changed: the prompt holds it in full.
    """
    return (
        mail.withColumn("pii_found", has_pii(text))
        .withColumn("privacy_scan", privacy_label("pii_found"))
        .withColumn("contextual_text", mail_context(company, text))
    )


def redact_mail(
    mail: DataFrame,
    text: str = "email_text",
    patterns: dict[str, str] | None = None,
    recogniser: Callable[[list[str]], list[list[Span]]] | None = None,
) -> DataFrame:
    """Adds ``redacted`` and ``placeholders`` (array of placeholder and value).

    E-mail addresses and phone numbers by column functions; with ``patterns`` (kind to pattern,
    such as ``privacy.PATTERNS``) or a ``recogniser`` any kinds, see ``redaction_of_kinds``.
    """
    if patterns is None and recogniser is None:
        found = redaction(text)
    else:
        found = redaction_of_kinds(text, PATTERNS if patterns is None else patterns, recogniser)
    return mail.withColumn("_r", found).select(*mail.columns, "_r.redacted", "_r.placeholders")


def rehydrate(drafts: DataFrame, placeholders: DataFrame, on: str = "mail_id", draft: str = "response") -> DataFrame:
    """The values put back into each draft, from the placeholder table of its mail.

    One row per draft. Where a mail has several rows of placeholders, all are put back; of two
    values for one placeholder the lesser wins.
    """
    listed = F.array_sort(F.array_distinct(F.flatten(F.collect_set("placeholders"))))
    table = placeholders.groupBy(on).agg(listed.alias("placeholders"))
    return drafts.join(table, on=on, how="left").select(
        *[c for c in drafts.columns if c != draft], restored(draft, "placeholders").alias(draft)
    )


def with_customer(
    mail: DataFrame, customers: DataFrame, on: str = "email", order: list[Column | str] | None = None
) -> DataFrame:
    """The first customer record of the mail's address, or nulls.

    Spark broadcasts the customers when its size estimate allows; otherwise the adaptive skew
    join splits an address that sent most of the mail.
    """
    others = [c for c in customers.columns if c != on]
    first = best_per_group(customers, [on], order or [F.asc(c) for c in others], 1, rank="_first").drop("_first")
    return mail.join(first, on=on, how="left")


def fold_reviews(events: DataFrame) -> DataFrame:
    """Current state per mail from its review events.

    Events are ``mail_id, seq, feedback, response, approved``. A row with a response is a
    draft: on non-empty feedback a revision, otherwise a first draft, which starts the
    count again. A row with ``approved`` is a decision. All roll-ups combine before the
    shuffle, so a mail with very many events stays cheap.
    """
    drafted = F.col("response").isNotNull()
    remark = F.coalesce("feedback", F.lit("")) != ""
    starts = (
        events.where(drafted & ~remark).groupBy("mail_id").agg(F.max("seq").alias("_start"))
    )
    marked = events.join(starts, on="mail_id", how="left")
    counted = drafted & remark & (F.col("_start").isNull() | (F.col("seq") > F.col("_start")))
    decision = F.max_by(F.col("approved"), F.when(F.col("approved").isNotNull(), F.col("seq")))
    return marked.groupBy("mail_id").agg(
        F.count_if(counted).alias("revision_count"),
        F.max_by(F.col("response"), F.when(drafted, F.col("seq"))).alias("response"),
        decision.alias("approved"),
    )
