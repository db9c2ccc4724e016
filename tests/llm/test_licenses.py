"""Published licence notices, wrapped as in source files."""

import textwrap

import pytest

from docsift.llm import licenses

MIT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal '
    "in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
    "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.'
)
APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law, software is distributed."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution."
)
THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
GNU = (
    "This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation; "
    "either version {v} of the License, or (at your option) any later version."
)
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{}"
NOTICES = [
    (MIT, "MIT"), (MIT.split(", subject")[0] + ".", "MIT-0"), (APACHE, "Apache-2.0"), (BSD, "BSD-2-Clause"), (f"{BSD}\n\n{THIRD}", "BSD-3-Clause"),
    (f"{BSD}\n\n{THIRD.replace('the copyright holder', 'Foo, Inc')}", "BSD-3-Clause"),
    (GNU.format(what="program", mark=":", kind="General Public License", v=3), "GPL-3.0-or-later"), (GNU.format(what="program", mark=";", kind="General Public License", v=2), "GPL-2.0-or-later"),
    (GNU.format(what="library", mark=";", kind="Lesser General Public License", v=2.1), "LGPL-2.1-or-later"), (GNU.format(what="program", mark=":", kind="Affero General Public License", v=3), "AGPL-3.0-or-later"),
    (ISC.format(", provided that the above copyright notice and this permission notice appear in all copies."), "ISC"), (ISC.format("."), "0BSD"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", "MPL-2.0"),
    ('The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not use this file except in compliance with the License.', "MPL-1.1"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.", "CC0-1.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY 3.0.", "CC-BY-3.0"), ("Licensed under CC BY-NC 4.0", "CC-BY-NC-4.0"),
    ("This project is licensed under the MIT License - see the LICENSE file for details.", "MIT"), ("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)", "BSL-1.0"),
    ("The code is released under the terms of the GNU GPL v3 or later.", "GPL-3.0-or-later"), ("This file is licensed under the GPLv2+.", "GPL-2.0-or-later"), ("Licensed under the LGPLv3.", "LGPL-3.0"), ("SPDX-License-Identifier: MIT OR ISC", "MIT OR ISC"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"), ("This project is not licensed under the MIT License.", None), ("We walk under trees, subject to rain.", None),
]


def wrapped(notice, width, mark):
    lines = [line for part in notice.split("\n\n") for line in [*textwrap.wrap(part, width), ""]]
    return "\n".join(f"{mark}{line}".rstrip() if mark.strip() else line for line in ["Copyright (c) 2020 Someone", "", *lines, "The end"])


@pytest.mark.parametrize("width,mark", [(40, ""), (72, " * "), (72, "# "), (10_000, "")])
def test_published_notices(width, mark):
    known = {licenses.normal(s): name for s, name in licenses.SENTENCES.items()}
    for notice, want in NOTICES:
        hits = licenses.recognise(wrapped(notice, width, mark), known, hint=licenses.HINT)
        assert [h[0] for h in hits] == [want] * (want is not None), (notice, hits)
        assert hits == licenses.recognise(wrapped(notice, width, mark), known)


def test_lines_without_full_stop_stay_apart(spark):
    text = "A title\nReleased under the MIT License\nLicensed under CC BY 4.0\nmore text"
    got = licenses.scan(spark.createDataFrame([(1, text), (1, text), (2, None), (3, "")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license, r.sentence, r.n_sentences) for r in got) == [(1, "CC-BY-4.0", 2, 1)] * 2 + [(1, "MIT", 1, 1)] * 2
