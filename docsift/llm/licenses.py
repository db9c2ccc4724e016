"""License recognition by sentence rules.

A text is cut into pieces at sentence ends and line ends. A sentence is one piece or several that
only line ends part (wrapped notices; marks of comments fall away); a blank line always ends it.
Every sentence is normalised (letters and digits, lowered, single spaces) and mapped to the
identifier of a known licence sentence, of a name of a licence after a usual lead-in, or of a
pattern with variable parts; of several, the longest. Runs of neighbouring known sentences give identifier
sequences, matched against the rules in their order (longer texts first); a matched sentence
serves one rule only. A sentence that states its licence in full needs no rule (``=`` before the
identifier). Null, empty and sentence-free texts give no row; repeated rows give theirs again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from docsift.llm.common import map_frames

# Sentences of public licence notices.
SENTENCES = {
    "Licensed under the Apache License, Version 2.0": "apache-grant",
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License": "apache-header",
    "You may obtain a copy of the License at": "apache-copy",
    "Released under the MIT License": "mit-release",
    "Licensed under the MIT License": "mit-release",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software": "mit-notice",
    "This work is licensed under the GNU General Public License, version 2": "gpl2-grant",
    "This work is licensed under the GNU General Public License, version 3": "gpl3-grant",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License": "gpl-header",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:": "mit-grant",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
    "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
    "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so": "=MIT-0",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies": "=ISC",
    "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies": "=ISC",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "=0BSD",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": "bsd-grant",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer": "bsd-source",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution": "bsd-binary",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": "mpl2-form",
    "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/": "mpl2-copy",
    "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/": "mpl2-copy",
    "This is free and unencumbered software released into the public domain": "=Unlicense",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
    "and to alter it and redistribute it freely, subject to the following restrictions:": "=Zlib",
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation "
    "covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works "
    "of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:": "=BSL-1.0",
}
RULES = (
    ("Apache-2.0", ("apache-header", "apache-copy")), ("Apache-2.0", ("apache-header",)), ("Apache-2.0", ("apache-grant",)),
    ("MIT", ("mit-release", "mit-grant", "mit-notice")), ("MIT", ("mit-grant", "mit-notice")), ("MIT", ("mit-release", "mit-notice")),
    ("MIT", ("mit-release",)), ("MIT", ("mit-grant",)), ("MIT", ("mit-notice",)),
    ("GPL-3.0", ("gpl3-grant",)), ("GPL-2.0", ("gpl2-grant",)), ("GPL", ("gpl-header",)),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-endorse")), ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")), ("BSD", ("bsd-grant",)),
    ("MPL-2.0", ("mpl2-form", "mpl2-copy")), ("MPL-2.0", ("mpl2-form",)),
)
#: Names of licences, normalised; groups fill the identifier, see ``named``.
V = r"(?:version |v )?v?"
NAMES = [(re.compile(name), out) for name, out in (
    (r"(?:mit|expat|mit expat|mit x11) licen[cs]e|mit", "mit-release"),
    (rf"apache (?:software )?(?:public )?licen[cs]e {V}2(?: 0)?(?: the license)?|apache {V}2(?: 0)?(?: licen[cs]e)?|asl {V}2(?: 0)?", "apache-grant"),
    (r"(?:(?:2|two) clause bsd|bsd (?:2|two) clause|simplified bsd|freebsd)(?: style)?(?: licen[cs]e)?", "=BSD-2-Clause"),
    (r"(?:(?:3|three) clause bsd|bsd (?:3|three) clause|new bsd|modified bsd|revised bsd)(?: style)?(?: licen[cs]e)?", "=BSD-3-Clause"),
    (r"(?:(?:4|four) clause bsd|bsd (?:4|four) clause|original bsd)(?: licen[cs]e)?", "=BSD-4-Clause"),
    (r"bsd(?: licen[cs]e)?", "=BSD"), (r"isc(?: licen[cs]e)?", "=ISC"), (r"unlicense", "=Unlicense"), (r"zlib(?: libpng)? licen[cs]e|zlib", "=Zlib"),
    (rf"(?:mozilla public licen[cs]e|mpl) {V}(?P<v>1|2)(?: (?P<w>\d))?(?: the license)?", "=MPL-{v}.{w}"),
    (rf"(?:eclipse public licen[cs]e|epl) {V}(?P<v>1|2)(?: (?P<w>\d))?", "=EPL-{v}.{w}"),
    (rf"(?:european union public licen[cs]e|eupl) {V}(?P<v>1) (?P<w>\d)", "=EUPL-{v}.{w}"),
    (rf"boost software licen[cs]e(?: {V}1(?: 0)?)?", "=BSL-1.0"),
    (rf"(?:creative commons )?(?:cc0|cc zero)(?: {V}1(?: 0)?)?(?: universal)?(?: public domain dedication)?(?: licen[cs]e)?", "=CC0-1.0"),
    (r"(?:gnu )?(?P<kind>lesser |library |affero )?(?:general public licen[cs]e|gpl)(?: gpl| lgpl| agpl)?(?: ?version ?| ?v ?| )?(?P<v>[123])?(?: (?P<w>\d))?(?: of the licen[cs]e)?(?P<more> or(?: at your option)? any later(?: version)?| or (?:later|newer)(?: version)?| plus)?(?: only)?", "GNU"),
    (r"(?:gnu )?(?P<kind>l|a)gpl(?: licen[cs]e)?(?: ?version ?| ?v ?| )?(?P<v>[123])?(?: (?P<w>\d))?(?P<more> or(?: at your option)? any later(?: version)?| or (?:later|newer)(?: version)?| plus)?(?: only)?", "GNU"),
    (r"(?:cc|creative commons) (?:(?P<by>by|attribution))(?P<nc> nc| non ?commercial)?(?P<sa> sa| share ?alike)?(?P<nd> nd| no ?deriv(?:ative)?s)? (?:version |v )?v?(?P<v>\d) (?P<w>\d)(?: international| unported| generic)?(?: public)?(?: licen[cs]e)?(?: cc by(?: \w\w){0,2} \d \d)?", "CC"),
)]
#: What may stand before and after a name.
LEAD = re.compile(
    r"(?:(?:this|these|the|all|our|my) (?:\w+ ){1,6}?(?:is|are|may be) |\w+ (?:is|are) )?(?:both |free software |open source )?(?:re)?(?:licen[cs]ed|released|distributed|available|made available|provided|published|covered|governed|subject) "
    r"(?:to you )?(?:under|by|to) (?:the )?(?:terms (?:and(?: or)? conditions )?of )?(?:an? |the )?(?P<name>.{2,120})"
)
HEADED = re.compile(r"licen[cs]e (?P<name>.{2,60})")
TAIL = re.compile(r" (?:see .*|which accompanies this .*|that can be found in .*|which can be found in .*|you may not use this file except in compliance with the licen[cs]e|as published by the free software foundation)$")
GNU = re.compile(
    r"(?:.{1,80} )?(?:you can|you may) redistribute (?:it|this \w+|them) and or modify (?:it|this \w+|them) under the terms of (?:the )?(?P<before>(?:version [123](?: \d)? of )?)(?:the )?gnu (?P<kind>lesser |library |affero )?general public licen[cs]e"
    r"(?: [al]?gpl)?(?: version (?P<early>[123](?: \d)?)(?: only)?)?(?: as published by the free software foundation)?"
    r"(?: (?:either )?(?:version (?P<v>[123])(?: (?P<w>\d))?)(?: of the licen[cs]e)?(?P<more> or at your option any later version)?(?: only)?)?"
)
OTHER = [(re.compile(name), out) for name, out in (
    (r"neither the names? of .{1,100} (?:nor|or) the names? of (?:its|their|his|her|the|any)(?: \w+)? ?contributors may be used to endorse or promote products derived from this software without specific prior written permission", "bsd-endorse"),
    (r"neither the name of .{1,100} may be used to endorse or promote products derived from this software without specific prior written permission", "bsd-endorse"),
    (r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment(?: this product includes software developed by .{1,120})?", "bsd-advert"),
    (r"(?:to the extent possible under law .{1,120} (?:has|have) (?:waived|dedicated) all copyright(?: and related (?:or|and) neighbou?ring rights)? to .{1,120})", "=CC0-1.0"),
)]
LONGEST = 140
SENTENCE = re.compile(r"[^\n]+?(?:(?:(?<!\bv)\.|[!?])(?=\s|$)|(?=\n)|$)")
ENDS = re.compile(r"(?:(?<!\bv)\.|[!?])\s*$")
SPDX = re.compile(r"SPDX-License-Identifier:\s*\(?([\w.+-]+(?: (?:OR|AND|WITH) [\w.+-]+)*)")
#: Every known sentence, name with its lead-in and pattern has one of these.
HINT = re.compile(r"licen[cs]|\bunder\b|distribut|permission|unencumbered|copyright|endorse|advertising|governed|covered|subject", re.IGNORECASE)
#: These begin other notices too, so they count at a sentence end only.
ENDED = ("=MIT-0", "=0BSD")
MARK = re.compile(r"(?:\d{1,2}|[a-d]|i{1,3}) ")
RESULT = "doc_id long, license string, rule int, sentence int, n_sentences int, matched string"


def normal(sentence: str) -> str:
    return " ".join(re.findall(r"[^\W_]+", re.sub(r"(?<=\d)\+", " plus ", sentence.lower())))


def gnu(part: dict) -> str:
    kind = {"lesser": "L", "library": "L", "affero": "A", "l": "L", "a": "A"}.get((part.get("kind") or "").strip(), "")
    if not part.get("v"):
        return f"={kind}GPL"
    return f"={kind}GPL-{part['v']}.{part.get('w') or 0}" + "-or-later" * bool(part.get("more"))


def named(name: str) -> str | None:
    """The identifier of a normalised name of a licence."""
    for pattern, out in NAMES:
        if m := pattern.fullmatch(name):
            part = m.groupdict()
            if out == "GNU":
                return gnu(part)
            if out == "CC":
                return "=CC-BY" + "".join(f"-{k.upper()}" for k in ("nc", "sa", "nd") if part[k]) + f"-{part['v']}.{part['w']}"
            return out.format(v=part.get("v"), w=part.get("w") or 0)
    return None


def identifier(text: str, sentences: dict[str, str]) -> str | None:
    """The identifier of a normalised sentence."""
    if MARK.match(text):
        text = text if text in sentences else MARK.sub("", text, count=1)
    if text in sentences:
        return sentences[text]
    if "gnu" in text and (m := GNU.fullmatch(text)):
        part = m.groupdict()
        digits = (part["early"] or part["before"].removeprefix("version ").removesuffix("of ")).split()
        return gnu(part if part["v"] or not digits else part | {"v": digits[0], "w": (digits[1:] or [None])[0]})
    if m := LEAD.fullmatch(text) or HEADED.fullmatch(text):
        for name in (m["name"], TAIL.sub("", m["name"])):
            if found := named(name.removesuffix(" the license")) or named(name):
                return found
    return next((out for pattern, out in OTHER if pattern.fullmatch(text)), None)


def units(text: str, sentences: dict[str, str], longest: int, hint) -> list[tuple]:
    """Number, text and identifier of the sentences in their order; of pieces that only line ends part, the longest known run."""
    pieces = list(SENTENCE.finditer(text))
    said = [normal(p[0]) for p in pieces]
    soft = [not ENDS.search(a[0]) and "\n" in (gap := text[a.end() : b.start()]) and gap.count("\n") == 1 and "" not in (x, y) for a, b, x, y in zip(pieces, pieces[1:], said, said[1:])]
    out, at = [], 0
    while at < len(pieces):
        ends, joined = [], said[at]
        ends.append(joined)
        while at + len(ends) < len(pieces) and soft[at + len(ends) - 1] and joined.count(" ") < longest:
            joined = f"{joined} {said[at + len(ends)]}"
            ends.append(joined)
        tried = range(len(ends), 0, -1) if ends[0] and (not hint or hint.search(joined)) else ()
        found = next(((k, name) for k in tried if (name := identifier(ends[k - 1], sentences)) and (name not in ENDED or ENDS.search(pieces[at + k - 1][0]))), None)
        if not found and (m := SPDX.search(pieces[at][0])):
            found = (1, f"={m[1]}")
        count, name = found or (1, None)
        if said[at] and not re.fullmatch(r"\d{1,2}|[a-d]|i{1,3}", said[at]):
            out.append((at, " ".join(p[0].strip() for p in pieces[at : at + count]), name))
        at += count
    return out


def recognise(text: str | None, sentences: dict[str, str], rules=RULES, longest: int = LONGEST, hint=None) -> list[tuple]:
    if not text or (hint and not hint.search(text)):
        return []
    found = units(text, sentences, longest, hint)
    taken, out = set(), []
    for number, (license_, wanted) in enumerate(rules):
        for at in range(len(found) - len(wanted) + 1):
            span = range(at, at + len(wanted))
            if found[at][2] and tuple(found[i][2] for i in span) == wanted and not taken.intersection(span):
                taken.update(span)
                out.append((license_, number, found[at][0], len(wanted), " ".join(found[i][1] for i in span)))
    return out + [(name[1:], len(rules), at, 1, said) for at, said, name in found if name and name[0] == "="]


def scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules=RULES) -> DataFrame:
    """One row per recognised licence: doc_id, license, rule, sentence (its number), n_sentences, matched."""
    known = {normal(s): name for s, name in sentences.items()}
    longest, hint = max([LONGEST, *(s.count(" ") + 1 for s in known)]), HINT if sentences is SENTENCES else None

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(doc, *hit) for doc, text in zip(batch["doc_id"], batch["text"]) for hit in recognise(text, known, rules, longest, hint)]
            yield pd.DataFrame(found, columns=["doc_id", "license", "rule", "sentence", "n_sentences", "matched"], dtype=object)

    return map_frames(docs.select("doc_id", "text"), rows, RESULT)
