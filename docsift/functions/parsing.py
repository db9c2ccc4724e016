"""JSON objects and arrays inside model replies, and JSON text out of structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scores import RECEIPT_FIELDS
from .text import col, strip

NO_LABEL = "—"


def object_text(reply: Column | str) -> Column:
    """From the first ``{`` to the last ``}``; null where there is no such span."""
    c = col(reply)
    start = F.instr(c, "{")
    end = F.length(c) - F.instr(F.reverse(c), "}") + 1
    return F.when((start > 0) & F.contains(c, F.lit("}")) & (end > start), F.substr(c, start, end - start + 1))


def strict_json(text: Column | str, schema: str) -> Column:
    """The whole text as one JSON value of ``schema``; null when anything precedes or follows it.

    A lone ``from_json`` stops after the first value, so the text is read as the only
    item of an array.
    """
    boxed = F.from_json(F.concat(F.lit("["), col(text), F.lit("]")), f"array<{schema}>")
    return F.when(F.size(boxed) == 1, boxed[0])


def json_fields(text: Column | str) -> Column:
    """A JSON object as a map of texts (null when it is no object)."""
    is_object = F.startswith(strip(text), F.lit("{"))
    return F.when(is_object, strict_json(text, "map<string,string>"))


def receipt_struct(fields: Column | str) -> Column:
    """Four receipt fields from a map: a missing key is empty, a JSON null the text ``None``."""
    m = col(fields)

    def one(name: str) -> Column:
        present = F.coalesce(F.map_contains_key(m, name), F.lit(False))
        return F.when(present, F.coalesce(m[name], F.lit("None"))).otherwise("").alias(name)

    return F.struct(*[one(f) for f in RECEIPT_FIELDS])


def question_answer_pairs(reply: Column | str) -> Column:
    """Array of question-answer structs; empty unless the whole reply is a JSON array."""
    schema = "array<struct<question:string,answer:string>>"
    is_array = F.startswith(strip(reply), F.lit("["))
    return F.coalesce(F.when(is_array, strict_json(reply, schema)), F.array().cast(schema))


def classification(reply: Column | str) -> Column:
    """Struct ``priority, type``; a dash where the reply is bad, the key missing or empty."""
    m = json_fields(reply)

    def one(name: str) -> Column:
        return F.coalesce(F.nullif(m[name], F.lit("")), F.lit(NO_LABEL)).alias(name)

    return F.struct(one("priority"), one("type"))


def labels_json(labels: Column | str) -> Column:
    return F.to_json(col(labels))
