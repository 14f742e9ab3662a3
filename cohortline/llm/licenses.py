"""License notices by conditional compression.

Around every word that hints at a license a block of text is compressed alone and
with each template as a raw zstandard dictionary. Templates are ranked by how much
smaller the block becomes, measured against what the template itself compresses
to; those that help enough are aligned with the block word by word, and of those with
few enough differences the one with most equal words, less its differences, is the
finding. Words that tell
licenses apart, names and version numbers, must be the same on both sides.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.inputs import batch, texts_of

# The wording of public license notices.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                  "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                  "CONDITIONS OF ANY KIND, either express or implied.",
    "MIT-line": "Released under the MIT License.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
           "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
           "Software, and to permit persons to whom the Software is furnished to do so.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
               "option) any later version.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
               "option) any later version.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
           "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
           "list of conditions and the following disclaimer.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "LGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version.",
    "LGPL-2.1": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
                "License, or (at your option) any later version.",
    "AGPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                "(at your option) any later version.",
    "GPL-2.0-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                    "General Public License version 2 as published by the Free Software Foundation.",
    "Apache-1.1": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                  "that the following conditions are met: The end-user documentation included with the redistribution, if "
                  "any, must include the following acknowledgment: \"This product includes software developed by the Apache "
                  "Software Foundation (http://www.apache.org/).\"",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public "
               "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
            "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
            "software for any purpose, including commercial applications, and to alter it and redistribute it freely",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
               "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
               "distribute, execute, and transmit the Software, and to prepare derivative works of the Software",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                 "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                 "binary, for any purpose, commercial or non-commercial, and by any means.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
               "this work, which is dedicated to the public domain.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    # the license, or licenses, in the place of * name the finding
    "SPDX": "SPDX-License-Identifier: *",
}
#: How a license is named in one line.
NAMES = {
    "MIT": ["the MIT License"], "ISC": ["the ISC License"], "Zlib": ["the zlib License"], "Unlicense": ["the Unlicense"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0"],
    "Apache-1.1": ["the Apache License, Version 1.1", "the Apache Software License, Version 1.1"],
    "GPL-3.0": ["the GNU General Public License, version 3", "the GNU GPL, version 3", "the GPLv3"],
    "GPL-2.0": ["the GNU General Public License, version 2", "the GNU GPL, version 2", "the GPLv2"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3", "the GNU LGPL, version 3", "the LGPLv3"],
    "LGPL-2.1": ["the GNU Lesser General Public License, version 2.1", "the GNU LGPL, version 2.1"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3", "the GNU AGPL, version 3", "the AGPLv3"],
    "MPL-2.0": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0"],
    "EPL-2.0": ["the Eclipse Public License, version 2.0", "the Eclipse Public License 2.0"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the 2-Clause BSD License"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License"],
    "BSL-1.0": ["the Boost Software License, Version 1.0"],
    "CC0-1.0": ["CC0 1.0", "the CC0 1.0 Universal License"],
}
#: The public parts of Creative Commons names: short form, words.
CC_PARTS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
            "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
            "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
LEADS = ["under", "under the terms of"]


def line_templates() -> dict[str, str]:
    """Every one-line reference, without its verb; what follows ``#`` is not part of the license's name."""
    names = {k: list(v) for k, v in NAMES.items()}
    for version in ("4.0", "3.0"):
        for short, words in CC_PARTS.items():
            region = "International" if version == "4.0" else "Unported"
            names[f"CC-{short}-{version}"] = [f"CC {short} {version}",
                                              f"a Creative Commons {words} {version} {region} License"]
    return {f"{license}-line#{n}": f"{lead} {name}" for license, forms in names.items()
            for n, (lead, name) in enumerate((a, b) for b in forms for a in LEADS)}


TEMPLATES |= line_templates()
HINT = r"(?i)licen[cs]|redistribut|hereby granted|permission to use|free software|public domain|(?<![a-z])(?:cc by|cc0|[al]?gpl)"
#: Least share of a template's own compressed size that it must save.
SAVED = 0.25
#: Most differing words, as a share of the template's.
DIFFERENT = 0.15
_WORD = re.compile(r"[^\s]+")
#: Words that tell licenses apart: names, and numbers that stand after a name or one of ``_BEFORE``.
_NAME = re.compile(r"(?:gnu|lesser|library|affero|general|public|mit|isc|zlib|unlicense|apache|mozilla|eclipse|boost|bsd"
                   r"|creative|commons|attribution\w*|cc0?|by(?:nc|nd|sa)+|[al]?gpl|mpl|epl"
                   r"|(?:[al]?gpl|apache|mpl|epl|bsd|cc)v?\d+\w*|\d+clause)")
_BEFORE = {"version", "v", "license", "by"}
_NUMBER = re.compile(r"v?(\d+(?:\.\d+)*?)(?:\.0)*")


def _bare(word: str) -> str:
    """Lower-case letters and digits of a word; a version number keeps its points and loses ending zeros."""
    word = word.lower()
    number = _NUMBER.fullmatch(word.strip(".,;:()\"'"))
    return number[1] if number else re.sub(r"[^\w]", "", word)


def _words(text: str) -> list[tuple[str, int, int]]:
    """(bare word, start, end) of every run of non-space characters that has a letter or digit."""
    found = ((_bare(m[0]), m.start(), m.end()) for m in _WORD.finditer(text))
    return [w for w in found if w[0]]


def _expression(block: str, words: list[tuple[str, int, int]], at: int) -> int:
    """End of the license at ``at`` and of what OR, AND and WITH tie to it."""
    at += 1
    while at + 1 < len(words) and block[words[at][1]:words[at][2]] in ("OR", "AND", "WITH"):
        at += 2
    return at


def _decides(words: list[str], at: int) -> bool:
    if not words[at][:1].isdigit() or not words[at].replace(".", "").isdigit():
        return bool(_NAME.fullmatch(words[at]))
    return at > 0 and (words[at - 1] in _BEFORE or bool(_NAME.fullmatch(words[at - 1])))


def _undecided(part: list[str], wanted: list[str], same) -> bool:
    """Whether no deciding word lies outside the matches, from the first to the last of them or missing anywhere."""
    here, there = set(), set()
    for m in same:
        here.update(range(m.a, m.a + m.size))
        there.update(range(m.b, m.b + m.size))
    return not (any(_decides(wanted, i) for i in range(len(wanted)) if i not in there)
                or any(_decides(part, i) for i in range(same[0].a, same[-1].a + same[-1].size) if i not in here))


class Templates:
    """Compressors that know one template each, for blocks of text."""

    def __init__(self, templates: dict[str, str]):
        self.plain = zstandard.ZstdCompressor(level=3)
        self.known = []
        self.open = {name for name, text in templates.items() if text.endswith("*")}
        #: Code points of a block on each side of a hint: the longest template with as many differences as allowed.
        self.reach = int(max(map(len, templates.values()), default=0) * (1 + DIFFERENT)) + 64
        for name, text in sorted(templates.items()):
            raw = text.removesuffix("*").encode()
            one = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.known.append((name, [w[0] for w in _words(text.removesuffix("*"))], len(self.plain.compress(raw)),
                               zstandard.ZstdCompressor(level=3, dict_data=one)))

    def ranked(self, block: str) -> list[tuple[float, int, str, list[str]]]:
        """(share saved, bytes saved, name, words) of the templates that help, best first."""
        raw = block.encode()
        alone = len(self.plain.compress(raw))
        saved = ((alone - len(c.compress(raw)), size, name, words) for name, words, size, c in self.known)
        return sorted(((s / size, s, name, words) for s, size, name, words in saved if s >= SAVED * size),
                      key=lambda r: (-r[0], r[2]))

    def find(self, block: str, at: int):
        """(name, start, end, words missing, words added, bytes saved) of the best confirmed template over ``at``, or None.

        Each template is aligned at its longest match. Where that lies beside
        ``at``, the words up to it are left out and the rest is aligned again.
        """
        best = None
        words = _words(block)
        there = [w[0] for w in words]
        hint = next((i for i, (_, start, end) in enumerate(words) if start <= at < end), None)
        for _, saved, name, wanted in self.ranked(block) if hint is not None else ():
            slack = len(wanted) // 8 + 1
            first, last = max(0, hint - len(wanted) - slack), min(len(there), hint + len(wanted) + slack)
            while last - first >= (1 - DIFFERENT) * len(wanted):
                seed = SequenceMatcher(None, there, wanted, autojunk=False).find_longest_match(first, last, 0, len(wanted))
                if not seed.size:
                    break
                low = max(first, seed.a - seed.b - slack)
                part = there[low:min(last, seed.a - seed.b + len(wanted) + slack)]
                same = [m for m in SequenceMatcher(None, part, wanted, autojunk=False).get_matching_blocks() if m.size]
                matched = sum(m.size for m in same)
                begin, end = low + same[0].a, low + same[-1].a + same[-1].size
                missing, added = len(wanted) - matched, end - begin - matched
                confirmed = missing + added <= DIFFERENT * len(wanted) and _undecided(part, wanted, same)
                if confirmed and begin <= hint < end:
                    rank = (missing + added - matched, name)
                    if name in self.open:
                        if end == len(words) or "\n" in block[words[end - 1][2]:words[end][1]]:
                            break
                        end = _expression(block, words, end)
                        name = block[words[begin + len(wanted)][1]:words[end - 1][2]].strip("\"'();,*/ ")
                    if best is None or rank < best[0]:
                        best = rank, (name.split("#")[0], words[begin][1], words[end - 1][2], missing, added, saved)
                    break
                if not confirmed:
                    begin, end = seed.a, seed.a + seed.size
                if hint < begin:
                    last = begin
                elif hint >= end:
                    first = end
                else:
                    break
        return best and best[1]


def findings_in(text: str, templates: Templates) -> list[tuple]:
    """All findings of a text from left to right; a hint inside a finding is part of it."""
    out, upto = [], 0
    for hint in re.finditer(HINT, text):
        if hint.start() < upto:
            continue
        low, high = max(upto, hint.start() - templates.reach), hint.end() + templates.reach
        found = templates.find(text[low:high], hint.start() - low)
        if found:
            name, start, end, missing, added, saved = found
            out.append((name, low + start, low + end, missing, added, saved))
            upto = low + end
    return out


def license_findings(docs: DataFrame, templates: dict[str, str] | None = None, key: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """(doc_id, license, start_at, end_at, words_missing, words_added, bytes_saved, exact) per finding.

    Positions are code points, ends exclusive. A text without a hint, or NULL or
    empty, gives no row; repeated rows give theirs each; a NULL doc_id stays NULL.
    Other columns are not read.
    """
    chosen = dict(TEMPLATES if templates is None else templates)
    schema = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("start_at", pa.int64()), ("end_at", pa.int64()),
                        ("words_missing", pa.int64()), ("words_added", pa.int64()), ("bytes_saved", pa.int64())])

    def run(batches):
        known = Templates(chosen)
        for rows in batches:
            out: list[list] = [[] for _ in schema]
            for doc_id, value in zip(rows.column(0).to_pylist(), rows.column(1)):
                for found in findings_in(value.as_py(), known):
                    for column, item in zip(out, (doc_id, *found)):
                        column.append(item)
            yield batch(schema.names, out, schema)
    hinted = texts_of(docs, key, text).filter(F.col("text").rlike(HINT))
    return hinted.mapInArrow(run, "doc_id long, license string, start_at long, end_at long, words_missing long, "
                                  "words_added long, bytes_saved long").withColumn(
        "exact", F.expr("words_missing + words_added = 0"))
