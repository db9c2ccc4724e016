"""Prompt texts as columns, built by concatenation (texts may hold ``%`` and braces)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, truncate

# Label sets, and the character cuts a caller may ask for (none is made by default).
PRIORITIES = ("urgent", "normal", "low")
MAIL_TYPES = ("complaint", "request", "info")
CONTEXT_CHARS = 3000
ANSWER_CHARS = 1500
QA_TEXT_CHARS = 2000


def _join(*parts: Column | str) -> Column:
    """Texts are literals; Columns are slots, empty when null."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])


def answer_prompt(question: Column | str, context: Column | str) -> Column:
    return _join(
        "Answer from the numbered passages alone and cite them as [1], [2] and so on. "
        "Where they do not settle the question, say that.\n\nPassages:\n",
        col(context), "\n\nQuestion:\n", col(question), "\n\nCited answer:",
    )


def _judge(task: str, head: str, reference: Column, answer: Column, answer_chars: int | None) -> Column:
    return _join(
        task + f"\n\n{head}:\n", reference, "\n\nAnswer:\n", truncate(answer, answer_chars),
        "\n\nReply with one number between 0.0 and 1.0 and nothing else.\nScore:",
    )


def faithfulness_prompt(
    answer: Column | str, context: Column | str, answer_chars: int | None = None, context_chars: int | None = None
) -> Column:
    task = "Judge how far every claim of the answer is backed by the context (1.0: all of them)."
    return _judge(task, "Context", truncate(context, context_chars), col(answer), answer_chars)


def relevancy_prompt(answer: Column | str, question: Column | str, answer_chars: int | None = None) -> Column:
    task = "Judge how directly the answer settles the question, without filler (1.0: fully)."
    return _judge(task, "Question", col(question), col(answer), answer_chars)


def correctness_prompt(answer: Column | str, truth: Column | str, answer_chars: int | None = None) -> Column:
    task = "Judge whether the answer states the same facts as the verified answer (1.0: the same)."
    return _judge(task, "Verified answer", col(truth), col(answer), answer_chars)


def qa_prompt(text: Column | str, pairs: int = 3, text_chars: int | None = None) -> Column:
    return _join(
        f"Write {pairs} questions with their answers about the text below, as a JSON array of "
        'objects with the keys "question" and "answer". Reply with the array only.\n\nText:\n',
        truncate(text, text_chars),
    )


def classify_prompt(mail: Column | str) -> Column:
    return _join(
        "Sort the mail. Reply with a JSON object only, with the keys "
        f'"priority" (one of {", ".join(PRIORITIES)}) and "type" (one of {", ".join(MAIL_TYPES)}).'
        "\n\nMail:\n", col(mail),
    )


def reply_prompt(mail: Column | str, classification: Column | str) -> Column:
    return _join(
        "Draft a short and courteous reply to the mail.\n\nMail:\n", col(mail),
        "\n\nSorted as:\n", col(classification), "\n\nReply:",
    )


def revise_prompt(feedback: Column | str, draft: Column | str, mail: Column | str) -> Column:
    return _join(
        "Rework the draft to meet the reviewer's remarks.\n\nRemarks:\n", col(feedback),
        "\n\nDraft:\n", col(draft), "\n\nMail:\n", col(mail),
    )


def receipt_prompt(receipt: Column | str) -> Column:
    return _join(
        'Read the receipt and reply with a JSON object only, with the keys "company", "date", '
        '"address" and "total" (all texts).\n\nReceipt:\n', col(receipt),
    )


def mail_context(company: Column | str, mail: Column | str) -> Column:
    """Company notes ahead of the mail; only the mail itself is scanned for personal data."""
    notes = F.lit(company) if isinstance(company, str) else company
    return _join("Company notes:\n", notes, "\n\nMail to handle:\n", col(mail))
