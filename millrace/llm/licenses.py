"""License scans by sentence rules.

A text is cut into sentences at stops and blank lines, but not at single line breaks; each is normalised (lower case, letters
and digits only, single blanks, without lead-in markers) and looked up in a tree of known licence sentences, all words of
which must be there.  The identifiers, in order, are then matched against the
ordered rules: a rule is a sequence of identifiers which may have up to ``gap`` other sentences between them.  The first
rule that fits at a place takes its sentences, and the search goes on behind them.  A notice may go on behind the
licence's name ("..., see the file").  Lines with an SPDX expression give an identifier for each of its licences.

Defined results: null and empty texts have no licences; texts and sentences of any length are read whole; repeated rows
and null ids are scanned each; of rules that fit at one place the first in ``RULES`` counts; other columns, whatever their
names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches

#: Sentences of public licence texts and of notices that name a licence, by identifier.
SENTENCES = {
    "mit-title": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "mit-ref": ["Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License", "This software is released under the MIT License", "Distributed under the MIT License"],
    "mit-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"],
    "mit-notice": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "as-is": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"],
    "isc-title": ["ISC License"],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "isc-ref": ["Released under the ISC License", "Licensed under the ISC License"],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "bsd-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "bsd2-ref": ["Licensed under the BSD 2-Clause License", "Released under the BSD 2-Clause License"],
    "bsd3-ref": ["Licensed under the BSD 3-Clause License", "Released under the BSD 3-Clause License"],
    "apache-ref": ["Licensed under the Apache License, Version 2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")", "Released under the Apache License 2.0"],
    "apache-comply": ["you may not use this file except in compliance with the License"],
    "apache-copy": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "apache-law": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "gpl2-ref": ["This work is licensed under the GNU General Public License, version 2", "Licensed under the GNU General Public License v2.0", "Licensed under the GNU GPL version 2"],
    "gpl3-ref": ["This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License v3.0", "Licensed under the GNU GPL version 3"],
    "gpl-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "gpl2-free": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "lgpl-ref": ["This work is licensed under the GNU Lesser General Public License, version 3"],
    "agpl-ref": ["This work is licensed under the GNU Affero General Public License, version 3"],
    "mpl-ref": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License 2.0"],
    "mpl-copy": ["If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/", "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"],
    "mpl1-ref": ["The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\")", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1", "Licensed under the Mozilla Public License 1.1"],
    "mit-nowarranty": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"],
    "mit0-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"],
    "mit0-ref": ["MIT No Attribution"],
    "0bsd-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "0bsd-ref": ["Zero-Clause BSD", "BSD Zero Clause License"],
    "bsd-ads": ["All advertising materials mentioning features or use of this software must display the following acknowledgement"],
    "bsd-warranty": ["THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED"],
    "lgpl21-free": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version"],
    "lgpl3-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "agpl3-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "lgpl21-ref": ["This work is licensed under the GNU Lesser General Public License, version 2.1"],
    "gpl2-title": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "gpl3-title": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "lgpl21-title": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "lgpl3-title": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "agpl3-title": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "apache-title": ["Apache License Version 2.0, January 2004"],
    "mpl-title": ["Mozilla Public License Version 2.0"],
    "mpl1-title": ["Mozilla Public License Version 1.1"],
    "epl1-ref": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"],
    "epl2-ref": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0"],
    "bsl-title": ["Boost Software License - Version 1.0 - August 17th, 2003"],
    "bsl-ref": ["Distributed under the Boost Software License, Version 1.0"],
    "zlib-grant": ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"],
    "artistic-ref": ["Licensed under the Artistic License 2.0"],
    "wtfpl-title": ["DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"],
    "eupl-ref": ["Licensed under the EUPL, Version 1.2", "Licensed under the EUPL-1.2"],
    "cddl-ref": ["The contents of this file are subject to the terms of the Common Development and Distribution License"],
    "ofl-ref": ["This Font Software is licensed under the SIL Open Font License, Version 1.1"],
    "postgres-grant": ["Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies"],
    "sspl-ref": ["Licensed under the Server Side Public License, version 1"],
    "busl-ref": ["Licensed under the Business Source License 1.1"],
    "cc0-ref": ["Licensed under CC0 1.0", "This work is dedicated to the public domain under a CC0 1.0 license"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
    "rights": ["All rights reserved"],
}
#: How a notice begins, and the names that it gives a licence, by identifier.
LEADS = [
    f"{who}{how} under{the}"
    for who in ("", "This project is ", "This software is ", "This work is ", "This code is ", "This library is ", "This package is ", "This repository is ", "This program is ", "This file is ", "The code is ", "The source code is ")
    for how in ("licensed", "released", "distributed", "available", "made available") for the in ("", " the", " a", " the terms of the")
]
NAMES = {
    "mit-ref": ["MIT License", "MIT", "MIT/X11 License", "Expat License"], "isc-ref": ["ISC License", "ISC"], "0bsd-ref": ["Zero-Clause BSD License", "BSD Zero Clause License"],
    "bsd2-ref": ["BSD 2-Clause License", "BSD-2-Clause License", "2-Clause BSD License", "Simplified BSD License", "BSD-2-Clause"],
    "bsd3-ref": ["BSD 3-Clause License", "BSD-3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License", "BSD-3-Clause"],
    "apache-ref": ["Apache License, Version 2.0", "Apache License, Version 2.0 (the \"License\")", "Apache License 2.0", "Apache 2.0 License", "Apache License v2.0", "Apache-2.0", "Apache 2.0", "Apache-2.0 License"],
    "apache-mit-ref": ["either of Apache License, Version 2.0 or MIT license at your option", "either the MIT License or the Apache License, Version 2.0, at your option", "MIT or Apache-2.0", "MIT/Apache-2.0", "MIT License or the Apache License, Version 2.0"],
    "gpl2-ref": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL version 2", "GPL-2.0", "GPLv2", "GNU GPLv2", "GPL version 2"],
    "gpl3-ref": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL version 3", "GPL-3.0", "GPLv3", "GNU GPLv3", "GPL version 3"],
    "lgpl21-ref": ["GNU Lesser General Public License, version 2.1", "LGPL-2.1", "LGPLv2.1", "GNU LGPL version 2.1"], "lgpl-ref": ["GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3", "GNU LGPL version 3"],
    "agpl-ref": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPL-3.0", "AGPLv3", "GNU AGPLv3"],
    "mpl-ref": ["Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0", "MPL 2.0", "MPL-2.0"], "mpl1-ref": ["Mozilla Public License 1.1", "Mozilla Public License Version 1.1"],
    "epl1-ref": ["Eclipse Public License 1.0", "Eclipse Public License v1.0"], "epl2-ref": ["Eclipse Public License 2.0", "Eclipse Public License v2.0"], "bsl-ref": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "zlib-ref": ["zlib License", "zlib/libpng License"], "artistic-ref": ["Artistic License 2.0"], "eupl-ref": ["EUPL, Version 1.2", "EUPL-1.2"], "unlicense-ref": ["Unlicense"], "wtfpl-ref": ["WTFPL"],
    "sspl-ref": ["Server Side Public License, version 1"], "busl-ref": ["Business Source License 1.1"], "cc0-ref": ["CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal license", "CC0"],
}
#: A Creative Commons licence's parts and their names, its versions, and what may follow a version.
CC_PARTS = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
CC_KINDS, CC_VERSIONS, CC_PORTS = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"), ("1.0", "2.0", "2.5", "3.0", "4.0"), ("", " International", " Unported", " Generic")
for _kind in CC_KINDS:
    _said = "-".join(CC_PARTS[part] for part in _kind.split("-"))
    for _version in CC_VERSIONS:
        _long = [f"Creative Commons {_said} {_version}{_port}" for _port in CC_PORTS]
        NAMES[f"cc-{_kind}-{_version}-ref".lower()] = [f"CC {_kind} {_version}", f"CC-{_kind} {_version} License", *_long, *(f"{name} License" for name in _long)]
#: Words that may go on behind a notice, as in "under the MIT License, see the file".
TAILS = {"see", "please", "which", "available", "found", "as", "at", "for", "in", "by", "c", "copyright", "https", "http"}
#: Identifiers of expressions that stand for another, and what they stand for.
ALIASES = {f"{name}{old}": f"{name}{new}" for name in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0") for old, new in (("", "-only"), ("+", "-or-later"))}

#: Ordered rules: (licence, category, identifiers in order).  Longer and more specific ones come first.
RULES = [
    ("MIT", "permissive", ("mit-title", "mit-grant", "mit-notice", "as-is", "mit-nowarranty")),
    ("MIT", "permissive", ("mit-grant", "mit-notice", "as-is", "mit-nowarranty")),
    ("MIT", "permissive", ("mit-title", "mit-grant", "mit-notice", "as-is")),
    ("MIT", "permissive", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", "permissive", ("mit-grant", "mit-notice")),
    ("MIT-0", "permissive", ("mit0-ref", "mit0-grant", "as-is", "mit-nowarranty")),
    ("MIT-0", "permissive", ("mit0-grant", "as-is", "mit-nowarranty")),
    ("MIT-0", "permissive", ("mit0-grant",)),
    ("BSD-4-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-ads", "bsd-endorse", "bsd-warranty")),
    ("BSD-4-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-ads", "bsd-endorse")),
    ("BSD-3-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty")),
    ("BSD-2-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty")),
    ("BSD-3-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", "permissive", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", "permissive", ("isc-title", "isc-grant")),
    ("Apache-2.0", "permissive", ("apache-ref", "apache-comply", "apache-copy", "apache-law")),
    ("Apache-2.0", "permissive", ("apache-ref", "apache-comply")),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free", "gpl-hope")),
    ("GPL-2.0-or-later", "copyleft", ("gpl2-free", "gpl-hope")),
    ("GPL-3.0-or-later", "copyleft", ("gpl-free",)),
    ("GPL-2.0-or-later", "copyleft", ("gpl2-free",)),
    ("ISC", "permissive", ("isc-grant",)),
    ("MIT", "permissive", ("mit-ref",)),
    ("ISC", "permissive", ("isc-ref",)),
    ("BSD-2-Clause", "permissive", ("bsd2-ref",)),
    ("BSD-3-Clause", "permissive", ("bsd3-ref",)),
    ("Apache-2.0", "permissive", ("apache-ref",)),
    ("GPL-2.0-only", "copyleft", ("gpl2-ref",)),
    ("GPL-3.0-only", "copyleft", ("gpl3-ref",)),
    ("LGPL-3.0-only", "copyleft", ("lgpl-ref",)),
    ("AGPL-3.0-only", "copyleft", ("agpl-ref",)),
    ("MPL-2.0", "copyleft", ("mpl-ref", "mpl-copy")),
    ("MPL-2.0", "copyleft", ("mpl-ref",)),
    *((licence, category, (f"{name}-{kind}",)) for licence, category, name, kinds in (
        ("MPL-1.1", "copyleft", "mpl1", "ref title"), ("MPL-2.0", "copyleft", "mpl", "title"), ("MIT-0", "permissive", "mit0", "ref"), ("0BSD", "permissive", "0bsd", "ref grant"),
        ("LGPL-2.1-only", "copyleft", "lgpl21", "ref title"), ("LGPL-2.1-or-later", "copyleft", "lgpl21", "free"), ("LGPL-3.0-or-later", "copyleft", "lgpl3", "free"), ("AGPL-3.0-or-later", "copyleft", "agpl3", "free"),
       
        ("GPL-2.0-only", "copyleft", "gpl2", "title"), ("GPL-3.0-only", "copyleft", "gpl3", "title"), ("LGPL-3.0-only", "copyleft", "lgpl3", "title"), ("AGPL-3.0-only", "copyleft", "agpl3", "title"), ("Apache-2.0", "permissive", "apache", "title"),
        ("EPL-1.0", "copyleft", "epl1", "ref"), ("EPL-2.0", "copyleft", "epl2", "ref"), ("BSL-1.0", "permissive", "bsl", "title ref"), ("Zlib", "permissive", "zlib", "grant ref"), ("Artistic-2.0", "permissive", "artistic", "ref"),
        ("WTFPL", "permissive", "wtfpl", "title ref"), ("EUPL-1.2", "copyleft", "eupl", "ref"), ("CDDL-1.0", "copyleft", "cddl", "ref"), ("OFL-1.1", "permissive", "ofl", "ref"), ("PostgreSQL", "permissive", "postgres", "grant"),
        ("SSPL-1.0", "source-available", "sspl", "ref"), ("BUSL-1.1", "source-available", "busl", "ref"), ("Unlicense", "public-domain", "unlicense", "ref"),
    ) for kind in kinds.split()),
    ("Apache-2.0 OR MIT", "permissive", ("apache-mit-ref",)),
    ("CC0-1.0", "public-domain", ("cc0-ref",)),
    ("Unlicense", "public-domain", ("unlicense",)),
    *(
        (f"CC-{p}-{v}", "non-commercial" if "NC" in p else "no-derivatives" if "ND" in p else "copyleft" if "SA" in p else "permissive", (f"cc-{p}-{v}-ref".lower(),))
        for p in CC_KINDS for v in CC_VERSIONS
    ),
    ("proprietary", "proprietary", ("rights",)),
]
#: A licence named by an identifier in an expression is a rule of that one identifier.
RULES += [(licence, category, (f"spdx:{licence}",)) for licence, category in dict(r[:2] for r in RULES if " " not in r[0] and r[0] != "proprietary").items()]

#: A stop ends a sentence only before white space or the end, so versions and addresses stay whole.
SENTENCE = re.compile(r"[^\n.;:!?]+(?:[.;:!?](?!\s|$)[^\n.;:!?]*)*", re.M)
NOT_WORD = re.compile(r"[\W_]+")
WORD = re.compile(r"[^\W_]+")
BLANK_LINE = re.compile(r"\n[\W_]*\n")
#: A line with an expression of licence identifiers, and a term of one.
EXPRESSION = re.compile(r"SPDX-License-Identifier:[ \t]*([^\n]*)", re.I)
TERM = re.compile(r"[A-Za-z0-9.+-]*[A-Za-z0-9+]")
#: A mark before an item that isn't cut off by a stop.
LIST_MARK = re.compile(r"^[\W_]*?\(?(?:\d{1,2}|[A-Za-z])\)\s+")


def normalise(sentence: str) -> str:
    return NOT_WORD.sub(" ", sentence.lower()).strip()


def insert(root: dict, sentence: str, identifier: str | None = None) -> dict:
    """The node of the sentence's last word; with an identifier it is one of a known sentence, under an empty word."""
    for word in normalise(sentence).split():
        root = root.setdefault(word, {})
    if identifier:
        root[""] = identifier
    return root


def graft(node: dict, other: dict) -> None:
    """Puts a tree into another, as itself where there is nothing yet."""
    for word, below in other.items():
        if word not in node:
            node[word] = below
        elif word:
            graft(node[word], below)


@functools.cache
def known() -> dict:
    """The known sentences as a tree of their words; behind each way to begin a notice hangs the one tree of names."""
    root: dict = {}
    names: dict = {}
    for identifier, sentences in SENTENCES.items():
        for whole in sentences:
            insert(root, whole, identifier)
    for identifier, own in NAMES.items():
        for name in own:
            insert(names, name, identifier)
    for lead in LEADS:
        graft(insert(root, lead), names)
    return root


def pieces_of(text: str) -> list[tuple[int, int, bool, bool]]:
    """(start, end, stopped, parted): what lies between stops and line breaks and has words; a stop, or a blank line, comes before it."""
    out, last = [], 0
    for m in SENTENCE.finditer(text):
        if not WORD.search(m[0]):
            continue
        between = text[last : m.start()]
        out.append((m.start(), m.end(), any(c in ".;:!?" for c in between), BLANK_LINE.search(between) is not None))
        last = m.end()
    return out


@functools.cache
def licence_ids() -> dict[str, str]:
    """Lower-case identifiers of expressions to the licences that have a rule."""
    own = {r[0] for r in RULES if r[2][0].startswith("spdx:")}
    return {licence.lower(): licence for licence in own} | {old.lower(): new for old, new in ALIASES.items() if new in own}


def expression(text: str, start: int, end: int) -> list[tuple[int, int, str | None]]:
    """The terms of a licence expression: identifiers, AND and OR between them; what follows WITH is an exception and no licence."""
    out, skip = [], False
    for m in TERM.finditer(text, start, end):
        word = m[0].upper()
        if word not in ("AND", "OR", "WITH") and not skip:
            licence = licence_ids().get(m[0].lower())
            out.append((m.start(), m.end(), licence and f"spdx:{licence}"))
        skip = word == "WITH"
    return out


def sentences_of(text: str) -> list[tuple[int, int, str | None]]:
    """(start, end, identifier or None) of each sentence.

    A known sentence is a run of whole pieces of one paragraph that has all its words, however it is wrapped and whatever
    stops it has inside; the longest one counts.  Other pieces are put together to the next stop or blank line.
    """
    root, out, pieces = known(), [], pieces_of(text)
    at, open_ = 0, False
    expressions = {m.start(): m for m in EXPRESSION.finditer(text)} if "SPDX" in text or "spdx" in text.lower() else {}
    while at < len(pieces):
        if expressions and (line := next((m for k, m in expressions.items() if pieces[at][0] <= k < pieces[at][1]), None)):
            out += expression(text, line.start(1), line.end(1))
            del expressions[line.start()]
            while at < len(pieces) and pieces[at][0] < line.end():
                at += 1
            open_ = False
            continue
        node, best, end = root, None, at
        while end < len(pieces) and (end == at or not pieces[end][3]):
            piece = text[pieces[end][0] : pieces[end][1]]
            if end == at:
                piece = LIST_MARK.sub("", piece)
                if (first := WORD.search(piece)) is None or first[0].lower() not in root:
                    break
            tail = None
            for k, word in enumerate(normalise(piece).split()):
                if k and word in TAILS and node.get("", "").endswith("-ref"):
                    tail = end + 1, node[""]
                if (node := node.get(word)) is None:
                    break
            if node is None:
                best = tail or best
                break
            end += 1
            if "" in node:
                best = end, node[""]
        start, stop, stopped, parted = pieces[at]
        if best is not None:
            out.append((start, pieces[best[0] - 1][1], best[1]))
            at, open_ = best[0], False
            continue
        if open_ and not stopped and not parted:
            out[-1] = (out[-1][0], stop, None)
        else:
            out.append((start, stop, None))
        at, open_ = at + 1, True
    return out


def match_rules(identifiers: list[str | None], gap: int = 3) -> list[tuple[int, list[int]]]:
    """(rule number, positions) of the matches from left to right."""
    out, at = [], 0
    while at < len(identifiers):
        if identifiers[at] is None:
            at += 1
            continue
        for number, (_, _, sequence) in enumerate(RULES):
            if sequence[0] != identifiers[at]:
                continue
            places = [at]
            for wanted in sequence[1:]:
                nearby = range(places[-1] + 1, min(places[-1] + 2 + gap, len(identifiers)))
                place = next((i for i in nearby if identifiers[i] == wanted), None)
                if place is None:
                    break
                places.append(place)
            else:
                out.append((number, places))
                at = places[-1]
                break
        at += 1
    return out


def scan_text(text: str, gap: int = 3) -> list[tuple[str, str, int, int, tuple[str, ...]]]:
    """(licence, category, start, end, identifiers) of each match in a text.

    "All rights reserved" is a part of most licences' headers: it counts by itself only if no licence is within ``gap`` sentences.
    """
    found = sentences_of(text)
    matches = match_rules([i for _, _, i in found], gap)
    others = [x for r, places in matches if RULES[r][0] != "proprietary" for x in places]
    matches = [(r, p) for r, p in matches if RULES[r][0] != "proprietary" or not any(abs(x - p[0]) <= gap + 1 for x in others)]
    return [(RULES[r][0], RULES[r][1], found[p[0]][0], found[p[-1]][1], RULES[r][2]) for r, p in matches]


MATCH = pa.struct([("licence", pa.string()), ("category", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("identifiers", pa.list_(pa.string()))])


def scan(docs: DataFrame, gap: int = 3) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, matches (licence, category, span in codepoints, identifiers)."""

    def run(iterator):
        for part, texts in batches(iterator):
            rows = [[{"licence": a, "category": c, "start": s, "end": e, "identifiers": [*i]} for a, c, s, e, i in scan_text(t, gap)] for t in texts]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(MATCH))], names=["doc_id", "matches"])

    schema = "doc_id long, matches array<struct<licence: string, category: string, start: int, end: int, identifiers: array<string>>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def summary(docs: DataFrame, gap: int = 3) -> DataFrame:
    """Per row: doc_id, n_matches, licences and identifiers (comma-separated, in order), restricted (a match isn't permissive or public domain)."""
    found = scan(docs, gap)
    return found.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"), F.array_join("matches.licence", ",").alias("licences"),
        F.array_join(F.flatten("matches.identifiers"), ",").alias("identifiers"),
        F.exists("matches", lambda m: ~m["category"].isin("permissive", "public-domain")).alias("restricted"),
    )
