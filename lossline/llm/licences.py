"""Licence notices found by a trained paragraph classifier.

Word 1- to 3-grams of the known notices are the features of a multinomial
logistic regression over licence families and an unknown class. It is trained on
the notices below, shortened, reworded and set in other text, against ordinary
paragraphs of the corpus, text about licences in another sense, and shuffled
notices. Temperature scaling on held-out examples calibrates it, and a threshold
on it turns doubtful families into unknown. A predicted family is confirmed if
the paragraph holds enough of one of that family's notices (by word trigrams).

A paragraph is a line, together with following lines while lines end within 120
bytes without a closing mark (wrapped text).

Defined cases: null and empty texts have no paragraphs; paragraphs without a
known word are unknown; ties go to the smaller family name; repeated rows give
repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hashed_below, slices

# Public notices of each licence family, as texts carry them: the line that
# names the licence and the paragraphs that only its own text has.
NOTICES = {
    "AFL": ["Licensed under the Academic Free License version 3.0."],
    "AGPL": ["This program is free software licensed under the GNU Affero General Public License, version 3.",
             "You can redistribute it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
             "Licensed under the AGPL version 3.", "Released under the GNU AGPL v3 or later."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND.",
                   "See the License for the specific language governing permissions and limitations under the License.",
                   "Released under the Apache 2.0 license."],
    "Artistic-2.0": ["This is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0.",
                     "Licensed under the Artistic License version 2.0."],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
            "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
            "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
            "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
            "Released under the BSD 3-Clause License.", "Licensed under the 2-clause BSD license."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0.",
                "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software."],
    "CC-BY": ["This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "Licensed under CC BY 4.0.", "Licensed under the Creative Commons Attribution 3.0 Unported License."],
    "CC-BY-NC": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
                 "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC-SA 4.0."],
    "CC-BY-ND": ["This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
                 "Licensed under CC BY-ND 4.0."],
    "CC-BY-SA": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                 "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
                 "Licensed under CC BY-SA 4.0."],
    "CC0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.",
            "This work is dedicated to the public domain under CC0 1.0 Universal."],
    "CDDL": ["The contents of this file are subject to the terms of the Common Development and Distribution License.",
             "Licensed under the CDDL, Version 1.0."],
    "ECL-2.0": ["Licensed under the Educational Community License, Version 2.0."],
    "EPL": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0.",
            "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0.",
            "Licensed under the EPL 2.0."],
    "EUPL": ["Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission, subsequent versions of the EUPL.",
             "Licensed under the European Union Public Licence, version 1.2."],
    "GFDL": ["Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation.",
             "Licensed under the GNU FDL 1.3."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
            "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
            "You should have received a copy of the GNU General Public License along with this program.",
            "Released under the GNU General Public License v2.", "Licensed under the GPL version 2 or later.", "Released under the GNU GPL v3."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
            "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
            "Released under the ISC License."],
    "LGPL": ["This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License.",
             "You should have received a copy of the GNU Lesser General Public License along with this library.",
             "Licensed under the LGPL version 2.1.", "Released under the GNU Lesser General Public License v3."],
    "LPPL": ["This work may be distributed and/or modified under the conditions of the LaTeX Project Public License, either version 1.3 of this license or any later version."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
            "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
            "Licensed under the Mozilla Public License, Version 2.0."],
    "MS-PL": ["Licensed under the Microsoft Public License."],
    "NCSA": ["Distributed under the University of Illinois Open Source License.",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files to deal with the Software without restriction under the NCSA License."],
    "ODbL": ["This database is made available under the Open Database License: http://opendatacommons.org/licenses/odbl/1.0/."],
    "OFL": ["This Font Software is licensed under the SIL Open Font License, Version 1.1."],
    "OSL": ["Licensed under the Open Software License version 3.0."],
    "PostgreSQL": ["Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.",
                   "Released under the PostgreSQL License."],
    "Proprietary": ["All rights reserved. No part of this publication may be reproduced without prior written permission.",
                    "Confidential and proprietary. Unauthorized copying of this file is strictly prohibited."],
    "PSF": ["Licensed under the Python Software Foundation License Version 2."],
    "Unlicense": ["This is free and unencumbered software released into the public domain.",
                  "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "UPL": ["Licensed under the Universal Permissive License v 1.0."],
    "WTFPL": ["This work is free. You can redistribute it and/or modify it under the terms of the Do What The Fuck You Want To Public License, Version 2."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
             "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions.",
             "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
             "Released under the zlib License."],
    "ZPL": ["This software is subject to the provisions of the Zope Public License, Version 2.1 (ZPL)."],
}
# Identifiers of the families in one-line tags.
IDENTIFIERS = {
    "AFL": ["AFL-3.0"], "AGPL": ["AGPL-3.0-only", "AGPL-3.0-or-later"], "Apache-2.0": ["Apache-2.0"], "Artistic-2.0": ["Artistic-2.0"],
    "BSD": ["BSD-2-Clause", "BSD-3-Clause"], "BSL-1.0": ["BSL-1.0"], "CC-BY": ["CC-BY-4.0"], "CC-BY-NC": ["CC-BY-NC-4.0"],
    "CC-BY-ND": ["CC-BY-ND-4.0"], "CC-BY-SA": ["CC-BY-SA-4.0"], "CC0": ["CC0-1.0"], "CDDL": ["CDDL-1.0"], "ECL-2.0": ["ECL-2.0"],
    "EPL": ["EPL-1.0", "EPL-2.0"], "EUPL": ["EUPL-1.2"], "GFDL": ["GFDL-1.3-or-later"], "GPL": ["GPL-2.0-only", "GPL-3.0-or-later"],
    "ISC": ["ISC"], "LGPL": ["LGPL-2.1-only", "LGPL-3.0-or-later"], "LPPL": ["LPPL-1.3c"], "MIT": ["MIT"], "MPL": ["MPL-2.0"],
    "MS-PL": ["MS-PL"], "NCSA": ["NCSA"], "ODbL": ["ODbL-1.0"], "OFL": ["OFL-1.1"], "OSL": ["OSL-3.0"], "PostgreSQL": ["PostgreSQL"],
    "PSF": ["PSF-2.0"], "Unlicense": ["Unlicense"], "UPL": ["UPL-1.0"], "WTFPL": ["WTFPL"], "Zlib": ["Zlib"], "ZPL": ["ZPL-2.1"],
}
TAG = "SPDX-License-Identifier: {}"
#: Notices of licences that are not among the families, as examples of the unknown class:
#: patterns that are filled with invented names.
NEAR_MISSES = ["Licensed under the {} License, Version {}.0.", "This software is subject to the provisions of the {} Public License, Version {}.1.",
               "Released under the {} License.", "This program is free software; you can redistribute it under the terms of the {} License.",
               TAG, "Distributed under the {} Software License, version {}.0.", "Licensed under the {} Community License v{}."]
# Sentences that use the same words in another sense.
OTHER_SENSES = [
    "Her driving license was issued in March and expires next year.", "The version of the story that the public heard was a free work of the author.",
    "The general made his work public under the terms of the new treaty.", "Software of this kind is used in the source of the river project.",
    "You can use the file in the library without a card.", "The MIT campus opened a new building for students.",
    "The Apache people lived in the region for a long time.", "A licensed doctor may not use this form of treatment.",
    "He was released under the terms of the law in April.", "The common creative work of the two authors was granted an international prize.",
    "The club asked for permission to use the hall free of charge.", "The public domain of the town was open to any person.",
]
UNKNOWN = "unknown"
_WORD = re.compile(r"[a-z0-9]+")


def grams(words: list[str], most: int = 3) -> set[str]:
    out = set(words)
    for n in range(2, most + 1):
        out.update(map(" ".join, zip(*(words[i:] for i in range(n)))))
    return out


def paragraphs(text: str) -> list[tuple[int, str]]:
    """(first character, paragraph) of a text."""
    out, at, held, begin = [], 0, [], 0
    for line in text.split("\n"):
        if not held:
            begin = at
        held.append(line)
        at += len(line) + 1
        s = line.rstrip()
        if not s or len(s) > 120 or s[-1] in ".!?:;|":
            if any(x.strip() for x in held):
                out.append((begin, "\n".join(held)))
            held = []
    if any(x.strip() for x in held):
        out.append((begin, "\n".join(held)))
    return out


def fit(docs: DataFrame, max_paragraphs: int = 1500, seed: int = 11) -> dict:
    """Model; reads about ``max_paragraphs`` hash-chosen texts of the corpus, one
    paragraph of each, as examples of the unknown class (copies count once)."""
    rng = random.Random(seed)
    n = docs.where(F.col("text").isNotNull()).count()
    lines = F.split(F.col("text"), "\n")
    some = (docs.where(F.col("text").isNotNull() & hashed_below(F.col("text"), min(1.0, max_paragraphs / max(n, 1))))
            .select(F.substring(F.element_at(lines, (F.pmod(F.xxhash64("text"), F.size(lines)) + 1).cast("int")), 1, 1500).alias("p"))
            .distinct().orderBy(F.xxhash64("p")).limit(2 * max_paragraphs).collect())
    corpus = [_WORD.findall(r["p"].lower()) for r in some]
    notices = {f: ts + [TAG.format(i) for i in IDENTIFIERS.get(f, [])] for f, ts in NOTICES.items()}
    templates = {f: [_WORD.findall(t.lower()) for t in ts] for f, ts in notices.items()}
    triples = {f: [grams(t) - grams(t, 1) or set(t) for t in ts] for f, ts in templates.items()}
    every = set().union(*(g for gs in triples.values() for g in gs))
    corpus = [w for w in corpus if w and len(grams(w) & every) < 3]
    filler = [w for ws in corpus[:200] for w in ws] or ["text"]
    vocabulary = {g: i for i, g in enumerate(sorted(set().union(*(grams(t) for ts in templates.values() for t in ts))))}
    labels = [UNKNOWN, *sorted(templates)]
    examples: list[tuple[list[str], int]] = [(w, 0) for w in corpus]
    examples += [(_WORD.findall(s.lower()), 0) for s in OTHER_SENSES for _ in range(12)]
    names = ["".join(rng.choice("bcdfglmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(160)]
    for i, name in enumerate(names):  # licences that nobody knows, and known words in their place
        miss = NEAR_MISSES[i % len(NEAR_MISSES)].format(name if i % 3 else f"{name} {rng.choice(filler)}", rng.randint(1, 4))
        examples += [(_WORD.findall(miss.lower()), 0)] * 3
    for f, ts in templates.items():
        for t in ts:
            for r in range(16):
                w = list(t)
                if r % 4 == 1 and len(w) > 6:
                    w = [x for x in w if rng.random() > 0.1]
                if r % 4 == 2:
                    around = [rng.choice(filler) for _ in range(rng.randint(1, 30))]
                    w = around[:len(around) // 2] + w + around[len(around) // 2:]
                if r % 4 == 3 and len(w) > 12:
                    w = w[:rng.randint(10, len(w))]
                examples.append((w, labels.index(f)))
            for _ in range(3 if len(t) > 5 else 0):  # the same words without their order
                w = t * 2
                rng.shuffle(w)
                examples.append((w[:len(t)], 0))
    rng.shuffle(examples)
    x = np.zeros((len(examples), len(vocabulary) + 1), np.float32)
    x[:, -1] = 1
    for i, (w, _) in enumerate(examples):
        for g in grams(w) & vocabulary.keys():
            x[i, vocabulary[g]] = 1
    y = np.array([k for _, k in examples])
    held = np.arange(len(y)) % 5 == 0
    weights = np.zeros((x.shape[1], len(labels)), np.float32)
    moment = np.zeros_like(weights)
    xt, onehot = x[~held], np.eye(len(labels), dtype=np.float32)[y[~held]]
    for _ in range(300):  # gradient steps with momentum, light shrinkage
        grad = xt.T @ (_softmax(xt @ weights) - onehot) / len(xt) + 1e-4 * weights
        moment = 0.9 * moment + grad
        weights -= 1.0 * moment
    logits = x[held] @ weights
    temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=lambda t: -float(
        np.log(_softmax(logits / t)[np.arange(held.sum()), y[held]] + 1e-9).sum()))
    p = _softmax(logits / temperature)
    family = p[:, 1:].max(axis=1)
    wrong = family[(y[held] == 0)]
    # a family must be likelier than all but a thousandth of held-out unknown paragraphs made it
    threshold = float(max(0.5, np.quantile(wrong, 0.999) if len(wrong) else 0.5))
    return {"vocabulary": vocabulary, "weights": weights / temperature, "labels": labels, "threshold": min(threshold, 0.95),
            "triples": triples}


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Scanner:
    def __init__(self, model: dict, confirm: float):
        self.model, self.confirm = model, confirm
        self.vocabulary, self.weights = model["vocabulary"], model["weights"].astype(np.float64)
        self.first = {g for g in self.vocabulary if " " not in g}

    def classify(self, paragraph: str) -> tuple[str, float, float]:
        """Family (or unknown), its probability, and how much of a notice is there."""
        words = _WORD.findall(paragraph.lower())
        found, vocabulary, first = set(), self.vocabulary, self.first
        # n-grams of known words only: others are not in the vocabulary
        for i, w in enumerate(words):
            if w in first:
                found.add(w)
                two = " ".join(words[i:i + 2])
                if two in vocabulary:
                    found.add(two)
                    three = " ".join(words[i:i + 3])
                    if three in vocabulary:
                        found.add(three)
        if not found:
            return UNKNOWN, 0.0, 0.0
        z = self.weights[[vocabulary[g] for g in sorted(found)]].sum(axis=0) + self.weights[-1]
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p[1:].argmax()) + 1
        if p[k] < self.model["threshold"] or p[0] >= p[k]:
            return UNKNOWN, float(p[k]), 0.0
        family = self.model["labels"][k]
        held = max(len(t & found) / len(t) for t in self.model["triples"][family])
        return family, float(p[k]), held


def scan(docs: DataFrame, model: dict, confirm: float = 0.6) -> DataFrame:
    """One row for each paragraph of a licence family: ``doc_id, paragraph`` (number
    from 0), ``begin`` (character), ``family, probability, similarity, confirmed, notice``."""
    schema = ("doc_id long, paragraph int, begin int, family string, probability double, similarity double, "
              "confirmed boolean, notice string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(model, confirm)
        for whole in batches:
            for batch in slices([whole], "text"):
                out: list[list] = [[] for _ in range(8)]
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    for no, (begin, p) in enumerate(paragraphs(text) if text else ()):
                        family, probability, held = scanner.classify(p)
                        if family != UNKNOWN:
                            for col, v in zip(out, (doc, no, begin, family, probability, held, held >= confirm, p)):
                                col.append(v)
                types = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.bool_(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                                 names=["doc_id", "paragraph", "begin", "family", "probability",
                                                        "similarity", "confirmed", "notice"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
