"""Deterministic stand-ins for models, made from the prompt alone.

Each maker returns a nested function, which travels to the executors by value.
"""

from __future__ import annotations


def overlap_judge():
    """Share of the answer's distinct words that the reference holds, as a sentence."""

    def judge(prompts, temperature):
        out = []
        for p in prompts:
            head, _, tail = p.partition("\n\nAnswer:\n")
            reference = head.partition(":\n")[2]
            answer = tail.rpartition("\n\nReply with one number")[0]
            a, r = set(answer.split()), set(reference.split())
            out.append(f"Score: {len(a & r) / len(a) if a else 0.0:.4f}")
        return out

    return judge


def mail_model():
    """Sorts by the length of the mail (every 7th reply is no JSON) and drafts a line."""

    def reply(prompts, temperature):
        out = []
        for p in prompts:
            mail = p.partition("Mail to handle:\n")[2]
            if p.startswith("Sort the mail"):
                n = len(mail)
                priority = ("urgent", "normal", "low")[n % 3]
                kind = ("complaint", "request")[n % 2]
                out.append("cannot tell" if n % 7 == 0 else '{"priority": "%s", "type": "%s"}' % (priority, kind))
            else:
                body, _, rest = mail.rpartition("\n\nSorted as:\n")
                label = rest.rpartition("\n\nReply:")[0]
                out.append(f"Reply to {len(body)} characters, sorted as {label}")
        return out

    return reply


def qa_model():
    """Three pairs per text; texts of odd length get a reply that is no array."""

    def reply(prompts, temperature):
        out = []
        for p in prompts:
            n = len(p.partition("\n\nText:\n")[2])
            pairs = ", ".join('{"question": "q%d of %d", "answer": "a%d"}' % (i, n, i) for i in range(3))
            out.append(f"[{pairs}]" if n % 2 == 0 else f"Here you are: [{pairs}]")
        return out

    return reply


def receipt_model(whole: bool):
    """Fields from the length of the receipt. The first model fails on every third length and
    talks around its object; the second gives the bare object, or nonsense on every fifth."""

    def reply(prompts, temperature):
        out = []
        for p in prompts:
            n = len(p.partition("\n\nReceipt:\n")[2])
            fields = '{"company": "c%d", "total": "%d.00", "date": null}' % (n % 10, n)
            if whole:
                out.append("none" if n % 5 == 0 else fields)
            elif n % 3 == 0:
                out.append("{broken}")
            elif n % 3 == 1:
                out.append("no fields seen")
            else:
                out.append(f"Fields: {fields} as read")
        return out

    return reply


def length_model():
    def reply(prompts, temperature):
        return [f"{len(p)} characters" for p in prompts]

    return reply


def caller_recogniser():
    """Spans of numbers with a country code, as a recogniser would give them."""

    def spans(texts):
        import re

        return [[("CALLER", m.start(), m.end()) for m in re.finditer(r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}", t)] for t in texts]

    return spans
