"""Licence scan: parts of a text compared with licence templates by the Dice coefficient over word bigrams.

Parts are sentences, lines, paragraphs, the whole text, and windows of words wherever enough bigrams of a template meet,
whatever line ends and comment marks lie between; all of them normalised (lower case, letters and digits only). A window starts and
ends with a bigram of its template and holds at most as many bigrams as the bounds below allow; of overlapping windows of a template
the best one counts, of equal ones the shortest. With
a and b distinct bigrams the coefficient is at most 2 min(a, b) / (a + b), so a part is compared only with templates
whose size lies within the bounds that this leaves. The same bounds give a least number of shared bigrams, by which most
templates, and most texts, are left before a text is split into parts.

Defined cases: a null text, an empty one and one without any match have a null licence, a coefficient of 0 and no
matched line. Ties go to the first licence in alphabetical order.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeworks.llm.text import map_texts

LEAST_DICE = 0.8
#: Usual wordings of licence notices, by SPDX identifier where there is one.
TEMPLATES = [
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
                 "your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
                   "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare "
                   "Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such "
                   "Derivative Works in Source or Object form."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
                   "with the License."),
    ("BSD-2-Clause", "Licensed under the 2-Clause BSD License."),
    *[("BSD-2-Clause", f"Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                       f"that the following conditions are met: {one} Redistributions of source code must retain the above copyright "
                       f"notice, this list of conditions and the following disclaimer. {two} Redistributions in binary form must "
                       f"reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
                       f"documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY")
      for one, two in (("1.", "2."), ("*", "*"))],
    ("BSD-3-Clause", "Licensed under the 3-Clause BSD License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met:"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
                "accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, "
                "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
                "Software is furnished to do so, all subject to the following:"),
    ("CC-BY-4.0", "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and "
                  "conditions of this Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and "
                  "conditions of this Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "By exercising the Licensed Rights (defined below), You accept and agree to be bound by the terms and "
                  "conditions of this Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                "which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
                "option) any later version."),
    *[("GPL-2.0-only", f"{begin} free software{stop} you can redistribute it and/or modify it under the terms of the GNU General "
                       "Public License version 2 as published by the Free Software Foundation.")
      for begin, stop in (("This program is", ";"), ("This software is", ","))],
    ("GPL-2.0-only", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                     "Public License as published by the Free Software Foundation; version 2 of the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    *[(f"LGPL-{number}", f"This library is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} "
                         f"General Public License as published by the Free Software Foundation; either version {number.removesuffix('.0')} "
                         f"of the License, or (at your option) any later version.")
      for number, kind in (("2.0", "Library"), ("2.1", "Lesser"), ("3.0", "Lesser"))],
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
                 "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
                 "your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
            "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Contributor means each individual or legal entity that creates, contributes to the creation of, or owns "
                "Covered Software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "Licensed under the zlib License."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
             "for any damages arising from the use of this software."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
             "redistribute it freely, subject to the following restrictions:"),
    ("all-rights-reserved", "All rights reserved."),
]
_TOKEN = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?:;])\s+")
_BLANK = re.compile(r"\n[^\S\n]*\n")


def bigrams(part: str) -> set:
    """Distinct word bigrams of a normalised part; a single word stands for itself."""
    words = _TOKEN.findall(part.lower())
    return set(zip(words, words[1:])) or {(w,) for w in words}


class Scanner:
    """The templates ordered by size, with the bounds that follow from the least coefficient."""

    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST_DICE):
        found = sorted(((len(b := bigrams(t)), name, b) for name, t in templates), key=lambda x: x[:2])
        self.templates, self.least, self.spread = found, least, (2 - least) / least
        self.length = {(name, frozenset(bigrams(t))): len(_TOKEN.findall(t)) - 1 for name, t in templates}
        self.any = {pair for _, _, b in found for pair in b}

    def candidates(self, text: str) -> list[tuple[int, str, set]]:
        """Templates that some part of the text could match: by the bounds a match shares at least ``size / spread`` bigrams
        with its template, and the bigrams of a part are bigrams of the text."""
        words = _TOKEN.findall(text.lower())
        shared = self.any.intersection(zip(words, words[1:]))
        single = set(words) if len(words) == 1 or not all(len(g) == 2 for _, _, b in self.templates for g in b) else set()
        return [t for t in self.templates
                if len(shared & t[2]) + sum(g[0] in single for g in t[2] if len(g) == 1) >= t[0] / self.spread - 1e-9]

    def best(self, part: str, among: list[tuple[int, str, set]]) -> tuple[float, str] | None:
        """Coefficient (negative, for ordering) and licence of the best matching template."""
        grams = bigrams(part)
        n, best = len(grams), None
        for m, name, gram in among:
            if n / self.spread - 1e-9 <= m <= n * self.spread + 1e-9:
                dice = 2 * len(grams & gram) / (n + m)
                if dice >= self.least and (best is None or (-dice, name) < best):
                    best = (-dice, name)
        return best

    def windows(self, lines: list[str], among: list[tuple[int, str, set]]) -> Iterator[tuple[float, str, int, int]]:
        """Coefficient (negative), licence, first and last line of the windows of words that match, best ones first."""
        words = [(w, i) for i, line in enumerate(lines) for w in _TOKEN.findall(line.lower())]
        grams = [(a, b) for (a, _), (b, _) in zip(words, words[1:])]
        for m, name, gram in among:
            most = int(self.length[name, frozenset(gram)] * self.spread + 1e-9)
            need = max(1, math.ceil(m / self.spread - 1e-9))
            places = [i for i, g in enumerate(grams) if g in gram]
            found = []
            for k, start in enumerate(places[:len(places) - need + 1]):
                if places[k + need - 1] - start >= most:
                    continue
                seen, shared, best = set(), 0, None
                for end in range(start, min(start + most, len(grams))):
                    g = grams[end]
                    if g in seen:
                        continue
                    seen.add(g)
                    if len(seen) > m * self.spread + 1e-9:
                        break
                    if g in gram:
                        shared += 1
                        dice = 2 * shared / (len(seen) + m)
                        if dice >= self.least and (best is None or dice > best[0]):
                            best = dice, end
                if best:
                    found.append((-best[0], best[1] - start, start, best[1]))
            taken = bytearray(len(words))
            for dice, _, start, end in sorted(found):
                if not any(taken[start:end + 2]):
                    taken[start:end + 2] = b"\1" * (end + 2 - start)
                    yield dice, name, words[start][1], words[end + 1][1]

    def scan(self, text: str | None) -> tuple[str | None, float, int]:
        """Best licence, its coefficient, and the number of lines inside any match."""
        if not text:
            return None, 0.0, 0
        among = self.candidates(text)
        if not among:
            return None, 0.0, 0
        best, marked, lines = None, set(), text.split("\n")

        def offer(part: str, first: int, last: int) -> None:
            nonlocal best
            hit = self.best(part, among)
            if hit:
                marked.update(range(first, last))
                best = hit if best is None else min(best, hit)

        for i, line in enumerate(lines):
            parts = _SENTENCE.split(line)
            for part in parts:
                offer(part, i, i + 1)
            if len(parts) > 1:
                offer(line, i, i + 1)
        for dice, name, first, last in self.windows(lines, among):
            marked.update(range(first, last + 1))
            best = min(best or (0.0, ""), (dice, name))
        if len(lines) > 1:
            at, blocks = 0, _BLANK.split(text)
            for block in blocks:
                n = block.count("\n") + 1
                if n > 1 and len(blocks) > 1:
                    offer(block, at, at + n)
                at += n + 1
            offer(text, 0, len(lines))
        return (best[1], round(-best[0], 9), len(marked)) if best else (None, 0.0, 0)


def scan_licenses(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                  templates: list[tuple[str, str]] = TEMPLATES, least: float = LEAST_DICE) -> DataFrame:
    """``keep`` and ``license string, dice double, license_lines long`` of every whole text."""
    scanner = Scanner(templates, least)

    def run(texts: list[bytes | None]) -> list[pa.Array]:
        found = [scanner.scan(t if t is None else t.decode("utf-8", "surrogatepass")) for t in texts]
        return [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.int64()))]

    return map_texts(docs, text, "license string, dice double, license_lines long", run, keep)
