"""Results that need all of the input: no word, bigram, line or sentence is left out."""

import math
import random
import textwrap
from collections import Counter

from millrace.llm import licenses, line_dedup, lm_score, toxicity


def test_lm_score_counts_every_word_and_bigram(spark):
    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(50)}" if rng.random() < 0.5 else f"r{rng.randrange(200_000)}" for _ in range(4000)) for _ in range(50)]
    texts += [texts[0], "w1 w2", "once", "", None]
    single, pairs = [Counter(), Counter()], [Counter(), Counter()]
    for i, t in enumerate(texts):
        w = ["", *(t or "").split()]
        for model in (0, 1) if i < 20 else (1,):
            if len(w) > 1:
                single[model].update(w)
                pairs[model].update(zip(w, w[1:]))
    kinds = len(single[1]) - 1
    totals = [sum(n.values()) - n[""] for n in single]
    assert kinds > 65_536

    def loss(model, own, a, b):
        """Of a token, by the model's counts less those of its own text, if the model has seen that."""
        n = {x: single[model][x] - own[0][x] for x in (a, b)}
        floor = (n[b] + 0.5) / (totals[model] - own[2] + 0.5 * (kinds + 1))
        return -math.log2(0.6 * (pairs[model][a, b] - own[1][a, b]) / n[a] + 0.4 * floor if n[a] else floor)

    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3)
    targets = spark.createDataFrame([(i,) for i in range(20)], "doc_id long")
    for sizes in ({}, {"chunk": 150_000, "block": 70_000}):
        rows = {r["doc_id"]: r for r in lm_score.scores(docs, targets, **sizes).collect()}
        assert len(rows) == len(texts)
        for i, t in enumerate(texts):
            w = ["", *(t or "").split()]
            own, none = (Counter(w), Counter(zip(w, w[1:])), len(w) - 1), (Counter(), Counter(), 0)
            seen = [own if i < 20 else none, own]
            want = [sum(loss(m, seen[m], a, b) for a, b in zip(w, w[1:])) / (len(w) - 1) for m in (0, 1)] if len(w) > 1 else [None, None]
            assert rows[i]["n_tokens"] == len(w) - 1
            for got, v in zip((rows[i]["target_loss"], rows[i]["background_loss"]), want):
                assert got == v or abs(got - v) < 1e-9


def test_line_dedup_drops_short_repeats(spark):
    long = "one line that has more than six words"
    texts = ["All rights reserved.\nx\n\n" + long, "all rights reserved. \n\n  X\ny\nAll rights", long + " here\n" + long + "\n\ny", None]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    rows = {r["doc_id"]: (r["text"], r["n_equal"], r["n_near"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert rows == {0: (texts[0], 0, 0), 1: ("\ny\nAll rights", 2, 0), 2: ("", 2, 1), 3: (None, 0, 0)}


def test_licenses_find_every_notice_alone():
    alone = {sequence[0]: licence for licence, _, sequence in licenses.RULES if len(sequence) == 1}
    for identifier, licence in alone.items():
        for sentence in [*licenses.SENTENCES.get(identifier, []), *(f"Licensed under the {name}" for name in licenses.NAMES.get(identifier, []))]:
            assert [m[0] for m in licenses.scan_text(f"Prose.\n{sentence}.")] == [licence], sentence
    assert [m[0] for m in licenses.scan_text("All  rights\u00a0reserved.")] == ["proprietary"]


def test_licenses_find_wrapped_texts():
    said = lambda k, n=0: licenses.SENTENCES[k][n]
    holder = "Copyright (c) 2020 Some One and\nothers"
    bsd = [said("bsd-grant") + ":", "1. " + said("bsd-source") + ".", "2. " + said("bsd-binary") + "."]
    gpl2, gpl3 = ([said(k) + ".", said("gpl-hope") + ". See the GNU General Public License for more details."] for k in ("gpl2-free", "gpl-free"))
    lgpl, mpl = (said("lgpl21-free") + ".", said("mpl-ref") + ". " + said("mpl-copy") + ".")
    texts = {
        "LGPL-2.1-or-later": [lgpl], "AGPL-3.0-or-later": [said("agpl3-free") + "."], "MPL-2.0": [mpl], "MPL-1.1": [said("mpl1-ref", 1) + "."], "Zlib": [said("zlib-grant") + ":"],
        "0BSD": [holder, said("0bsd-grant") + "."], "MIT-0": [holder, said("mit0-grant") + ".", said("as-is") + "."],
        "BSD-4-Clause": [holder + ".", *bsd, "3. " + said("bsd-ads") + ": This product.", "4. " + said("bsd-endorse") + ".", said("bsd-warranty") + "."],
        "GPL-3.0-only": ["GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", holder],
        "MIT": ["MIT License", holder, said("mit-grant") + ":", said("mit-notice") + ".", said("as-is") + "."],
        "BSD-2-Clause": [holder + ".", *bsd],
        "BSD-3-Clause": [holder + ".", *bsd, "3. " + said("bsd-endorse") + "."],
        "ISC": ["ISC License", holder, said("isc-grant", 1) + "."],
        "GPL-2.0-or-later": gpl2,
        "GPL-3.0-or-later": gpl3,
    }
    for licence, parts in texts.items():
        for width in (50, 70, 80):
            wrapped = "\n\n".join(textwrap.fill(p, width) for p in parts)
            for text in (wrapped, "\n".join("# " + x for x in wrapped.split("\n")), "Unstopped words\n" + wrapped.replace("\n\n", "\n")):
                assert [m[0] for m in licenses.scan_text(text)] == [licence], (licence, width, text)
    assert [m[0] for m in licenses.scan_text("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.")] == ["MPL-1.1"]
    assert licenses.scan_text("This Source Code Form is subject to the terms of the Mozilla Public License, v. 3.0.") == []
    assert licenses.scan_text("We think this program is free software; it costs nothing. This program is free software.") == []
    assert [m[0] for m in licenses.scan_text("Some words\nReleased under the MIT\nLicense. (a) All rights reserved.")] == ["MIT"]


def test_toxicity_reads_whole_clauses():
    """Machines against windows, with clauses far over 2,000 characters: a scope holds to the clause's true end."""
    from .test_pipeline import plain_evidence

    rng = random.Random(11)
    lexicon = toxicity.Lexicon({"moron": 5.0}, {"idio": 6.0})
    found = lexicon.scanner()
    words = ["moron", "idiotic", "kill", "you", "not", "said", "will", "a", "word", "thing", "moronic", "it's"]
    texts = ["he said you moron " + "word " * 600 + "a moron", "moron", "nobody is a moron", "you moron"]
    for _ in range(300):
        stops = rng.choice([".", ".!?;\n", ""])
        texts.append(" ".join(rng.choice(words) + (rng.choice(stops) if stops and rng.random() < 0.1 else "") for _ in range(rng.randrange(1, 900))))
    for t in texts:
        assert abs(toxicity.evidence(t, lexicon, found) - plain_evidence(t, lexicon)) < 1e-6, t[:200]
    assert toxicity.evidence(texts[3], lexicon, found) > 2 * toxicity.evidence("moron", lexicon, found) - 1e-9


def test_toxicity_learns_long_forms(spark):
    """Forms of any length: a word of 60 letters, and a beginning of 30 that no shorter one tells apart."""
    stem, word = "x" * 12 + "y" * 18, "q" * 60
    rows = [(i, f"{stem}{'abcdefghij'[i % 10] * 3} some words", 1) for i in range(30)] + [(100 + i, word + " more words", 1) for i in range(30)]
    rows += [(1000 + i, f"{stem[:25]}{'klmnopqrst'[i % 10]} some more words here", 0) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    # Texts that repeat count once, so each row gets a word of its own.
    df = df.selectExpr("doc_id", "concat(text, ' w', translate(string(doc_id), '0123456789', 'abcdefghij')) as text", "toxic")
    lexicon = toxicity.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"), least_odds=3.0)
    assert word in lexicon.words
    assert [b for b in lexicon.beginnings if b.startswith("x")] and all(len(b) > 25 for b in lexicon.beginnings if b.startswith("x"))
    got = toxicity.score(df, lexicon).join(df.select("doc_id", "toxic"), "doc_id").selectExpr("sum(int(predicted <> toxic))").first()[0]
    assert got == 0


BSD = """Copyright (c) 2015, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
"""
ENDORSE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
ZLIB = """Copyright (c) 2020 Some Body. All rights reserved.

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented.
"""
ISC = """ISC License

Copyright (c) 2020, Some Body. All rights reserved.

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
"""


def test_whole_files_and_notices_by_hand():
    """Licence files and notices with what each is, written out by hand, plain, wrapped and as comments."""
    cases = [
        (BSD.format(third=ENDORSE), ["BSD-3-Clause"]), (BSD.format(third=""), ["BSD-2-Clause"]), (ZLIB, ["Zlib"]), (ISC, ["ISC"]),
        ("This project is licensed under the MIT License - see the LICENSE file for details", ["MIT"]),
        ("This project is licensed under the MIT License. See the file.", ["MIT"]),
        ("Licensed under the Apache License, Version 2.0, available at https://x.org", ["Apache-2.0"]),
        ("SPDX-License-Identifier: MIT OR Apache-2.0", ["MIT", "Apache-2.0"]), ("SPDX-License-Identifier: (MIT AND BSD-3-Clause)", ["MIT", "BSD-3-Clause"]),
        ("SPDX-License-Identifier: GPL-2.0", ["GPL-2.0-only"]), ("SPDX-License-Identifier: GPL-2.0+", ["GPL-2.0-or-later"]), ("SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0", ["GPL-2.0-or-later"]),
        ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", ["Apache-2.0 OR MIT"]),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ["CC-BY-4.0"]), ("Licensed under CC BY-NC 2.0", ["CC-BY-NC-2.0"]),
        ("Released under the Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License", ["CC-BY-NC-SA-3.0"]),
        ("Copyright 2020 Some Body. All rights reserved. Do not copy.", ["proprietary"]), ("We talked about the MIT License and licensed under nothing.", []), ("SPDX-License-Identifier: Nothing-1.0", []),
        ("Licensed under the GNU General Public License, version 4", []), ("", []),
    ]
    for text, want in cases:
        for form in (text, "\n".join(" * " + x for x in text.split("\n")), "\n\n".join(textwrap.fill(x, 60) for x in text.split("\n\n"))):
            if "SPDX" not in text or form.count("\n") == text.count("\n"):
                assert [m[0] for m in licenses.scan_text(form)] == want, form
    restricted = {r[0]: r[1] not in ("permissive", "public-domain") for r in licenses.RULES}
    assert not restricted["BSD-3-Clause"] and restricted["GPL-2.0-or-later"] and restricted["CC-BY-NC-2.0"] and not restricted["Apache-2.0 OR MIT"]


def plain_licences(text, gap=3):
    """Sentences word by word against every known one, and every rule against the places, without a tree."""
    known = [(licenses.normalise(x).split(), k) for k, xs in licenses.SENTENCES.items() for x in xs]
    leads = {tuple(licenses.normalise(x).split()) for x in licenses.LEADS}
    names = {tuple(licenses.normalise(x).split()): k for k, xs in licenses.NAMES.items() for x in xs}
    longest = max(map(len, leads)) + max(map(len, names))
    pieces = licenses.pieces_of(text)
    words = [licenses.normalise(text[a:b]).split() for a, b, _, _ in pieces]
    marked = [licenses.normalise(licenses.LIST_MARK.sub("", text[a:b])).split() for a, b, _, _ in pieces]
    units, at, open_ = [], 0, False
    while at < len(pieces):
        fits = []
        for sentence, k in known:
            end, have = at, []
            while end < len(pieces) and (end == at or not pieces[end][3]) and len(have) < len(sentence):
                have = have + (marked if end == at else words)[end]
                end += 1
            if have == sentence:
                fits.append((end, k))
        end, have = at, []
        while end < len(pieces) and (end == at or not pieces[end][3]) and len(have) < longest:
            have = have + (marked if end == at else words)[end]
            end += 1
            fits += [(end, names[tuple(have[i:])]) for i in range(len(have)) if tuple(have[:i]) in leads and tuple(have[i:]) in names]
        if fits:
            end = max(e for e, _ in fits)
            units.append([k for e, k in fits if e == end][-1])
            at, open_ = end, False
        else:
            if not (open_ and not pieces[at][2] and not pieces[at][3]):
                units.append(None)
            at, open_ = at + 1, True
    out, at = [], 0
    while at < len(units):
        for licence, _, sequence in licenses.RULES if units[at] else ():
            places = [at] if sequence[0] == units[at] else []
            for wanted in sequence[1:] if places else ():
                near = [i for i in range(places[-1] + 1, len(units)) if i <= places[-1] + 1 + gap and units[i] == wanted]
                if not near:
                    places = []
                    break
                places.append(near[0])
            if places:
                out.append((licence, places))
                at = places[-1]
                break
        at += 1
    near = [x for licence, places in out if licence != "proprietary" for x in places]
    return [licence for licence, places in out if licence != "proprietary" or all(abs(x - places[0]) > gap + 1 for x in near)]


def test_licenses_against_brute_force(spark, sf):
    rng = random.Random(8)
    said = [x for xs in licenses.SENTENCES.values() for x in xs]
    said += [f"{rng.choice(licenses.LEADS)} {name}" for names in licenses.NAMES.values() for name in names]
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for _ in range(400):
        parts = rng.choices(said, k=rng.randrange(1, 7)) + rng.choices(["Some prose here.", "More of it", "1.", "(a)", "and", "Version 2.0"], k=rng.randrange(0, 5))
        rng.shuffle(parts)
        text = rng.choice(["\n\n", "\n", ". ", ".\n", " "]).join(parts)
        texts.append(textwrap.fill(text, 70) if rng.random() < 0.3 else text)
    found = 0
    for t in texts:
        got = [m[0] for m in licenses.scan_text(t)]
        found += len(got)
        assert got == plain_licences(t), t
    assert found > 500
