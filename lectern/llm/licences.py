"""Licence scan: a trained paragraph classifier, confirmed by template comparison.

A line, or a window of 16 or 64 words over a run of lines between blank ones, is a bag of hashed
word 1- and 2-grams.  A sparse multinomial logistic regression over licence families and ``none``
is trained in numpy on variants of the templates (parts of them, words dropped, swapped and embedded
between corpus words) and on a bounded sample of corpus lines, by hash order, that resemble no
template.  What has a low ``none`` probability is licence-like; neighbouring units are one region.
A family is taken where its probability reaches the bound calibrated on held-back variants (the 1 %
quantile) and where a template of it, a short notice, a file header or a text, stands in the region
or around it: ``CONFIRM`` of its words in order, names and versions among them.  A licence-like line
that no such text reaches is ``unknown``; so is a region without any.

Every line and window of every whole text is classified; ``n_paragraphs`` counts the lines and
``paragraph`` is the line in which a found text begins.  Null and empty texts have none; repeated
rows get equal results; without corpus lines the negatives are empty bags.
"""

from __future__ import annotations

from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import U64, byte_table, finish, keyed, mix, packs, share, shared, spans, utf8, words

_AS_IS = ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES '
          'OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE '
          'LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN '
          'CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.')
_MIT = ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files '
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        'publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so')
_MIT_KEEP = ('The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.')
_BSD = ('Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions '
        'are met:')
_BSD_1 = 'Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.'
_BSD_2 = ('Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in '
          'the documentation and/or other materials provided with the distribution.')
_BSD_3 = ('Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from '
          'this software without specific prior written permission.')
_BSD_END = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT '
            'NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL '
            'THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES '
            '(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS '
            'INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE '
            'OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.')
_ISC = 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted'
_ISC_END = ('THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
            'WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR '
            'CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, '
            'NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.')


def _gnu(name: str, version: str, title: str, head: str) -> list[str]:
    """The parts of a GNU licence's file header and the title of its full text."""
    return [f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free "
            f"Software Foundation, either version {version} of the License, or (at your option) any later version.",
            f"This program is free software; you can redistribute it and/or modify it under the terms of the {name} version {version} as "
            "published by the Free Software Foundation.",
            f"{title} {head} Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."]


def _cc(kind: str, version: str = "4.0 International") -> list[str]:
    return [f"This work is licensed under a Creative Commons {kind} {version} License.",
            f"This work is licensed under the Creative Commons {kind} {version} License. To view a copy of this license, visit",
            f"Creative Commons {kind} {version} Public License By exercising the Licensed Rights (defined below), You accept and agree to be bound "
            f"by the terms and conditions of this Creative Commons {kind} {version} Public License"]


_FSF = "Copyright (C) Free Software Foundation, Inc."
#: fixed values: notices, file headers and texts of the families, as the licences publish them.  Licences
#: of a few hundred words are whole; of the long ones, the header and the opening of the text.
TEXTS = {
    "0BSD": [f"{_ISC}. {_ISC_END}"],
    "AGPL-3.0": _gnu("GNU Affero General Public License", "3", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", _FSF),
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express '
        "or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"],
    "BSD-2-Clause": [f"{_BSD} 1. {_BSD_1} 2. {_BSD_2} {_BSD_END}", f"{_BSD} {_BSD_1} {_BSD_2} {_BSD_END}"],
    "BSD-3-Clause": ["Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
                     f"{_BSD} 1. {_BSD_1} 2. {_BSD_2} 3. {_BSD_3} {_BSD_END}", f"{_BSD} {_BSD_1} {_BSD_2} {_BSD_3} {_BSD_END}"],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
                "http://www.boost.org/LICENSE_1_0.txt)"],
    "CC-BY-4.0": _cc("Attribution"),
    "CC-BY-NC-4.0": _cc("Attribution-NonCommercial"),
    "CC-BY-NC-ND-4.0": _cc("Attribution-NonCommercial-NoDerivatives"),
    "CC-BY-NC-SA-4.0": _cc("Attribution-NonCommercial-ShareAlike"),
    "CC-BY-ND-4.0": _cc("Attribution-NoDerivatives"),
    "CC-BY-SA-4.0": _cc("Attribution-ShareAlike"),
    "CC-BY-SA-3.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."],
    "CC-BY-3.0": ["This work is licensed under a Creative Commons Attribution 3.0 Unported License."],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
                "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or "
                "neighboring rights to this work.",
                "CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT PROVIDE LEGAL SERVICES."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
                "available at https://www.eclipse.org/legal/epl-2.0/"],
    "GPL-2.0": _gnu("GNU General Public License", "2", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991", _FSF),
    "GPL-3.0": _gnu("GNU General Public License", "3", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007", _FSF),
    "ISC": [f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_END}"],
    "LGPL-2.1": _gnu("GNU Lesser General Public License", "2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999", _FSF),
    "LGPL-3.0": _gnu("GNU Lesser General Public License", "3", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007", _FSF)
    + ["This library is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [f"{_MIT}, subject to the following conditions: {_MIT_KEEP} {_AS_IS}", f"{_MIT}, subject to the following conditions: {_MIT_KEEP}",
            _MIT + ", subject to the following conditions:"],
    "MIT-0": [f"{_MIT}. {_AS_IS}", _MIT + "."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
                "this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
                'Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that creates, '
                "contributes to the creation of, or owns Covered Software."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
                  "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
                  "non-commercial, and by any means."],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
             "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
             "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
}
#: fixed values: names of the families in short notices
NAMES = {
    "0BSD": ["0BSD License", "BSD Zero Clause License"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU AGPL version 3", "AGPLv3", "AGPL-3.0"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 license", "Apache-2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "two-clause BSD license", "BSD-2-Clause"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "three-clause BSD license", "BSD-3-Clause"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "BSL-1.0"],
    **{f"CC-{k}": [f"CC {k.replace('-4.0', ' 4.0').replace('-3.0', ' 3.0')}", f"Creative Commons {k.replace('-4.0', ' 4.0').replace('-3.0', ' 3.0')} license"]
       for k in ("BY-4.0", "BY-NC-4.0", "BY-NC-ND-4.0", "BY-NC-SA-4.0", "BY-ND-4.0", "BY-SA-4.0", "BY-SA-3.0", "BY-3.0")},
    "CC0-1.0": ["CC0 1.0 Universal", "CC0", "CC0-1.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "EPL-2.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU GPL version 2", "GPLv2", "GPL-2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU GPL version 3", "GPLv3", "GPL-3.0"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU LGPL version 2.1", "LGPLv2.1", "LGPL-2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU LGPL version 3", "LGPLv3", "LGPL-3.0"],
    "MIT": ["MIT License", "MIT licence", "Expat License"],
    "MIT-0": ["MIT No Attribution License", "MIT-0"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["zlib License", "zlib/libpng License"],
}
FORMS = ["Licensed under the {}.", "Licensed under {}.", "Released under the {}.", "This work is licensed under the {}.", "Distributed under the {}.",
         "Available under the terms of the {}.", "This project is covered by the {}.", "License: {}", "SPDX-License-Identifier: {}"]
#: licence-like text of no family, for the classifier's sense of what a licence is about
OTHERS = ["Licensed under the terms of the agreement.", "Released under a proprietary license.", "All rights reserved under this license.",
          "This work is licensed under the following terms."]
BITS = 14
SAMPLE_PARAGRAPHS = 4000
CONFIRM = 0.8
PACK = 1 << 20
#: words of the windows that are scored besides the lines, half overlapping
WINDOWS = (16, 64)
#: units scored at a time
SCORED = 1 << 15
#: words around licence-like ones that are compared, as much as the longest template
AROUND = 256
#: a line of the sample is cut to a slice of so many characters, by hash
SAMPLE_CHARS = 2000
#: name words that may be lacking, and words of a text that may not, as digits may not
_LOOSE = {"the", "license", "licence", "version", "of", "and"}
_TELLING = {"lesser", "affero", "noncommercial", "sharealike", "noderivatives"}
#: a corpus line with two of these is not taken as a negative
_LEGAL = {"license", "licence", "licensed", "licenses", "sublicense", "copyright", "copyleft", "warranty", "warranties", "redistribution",
          "redistributions", "redistribute", "distributed", "released", "permission", "granted", "liable", "merchantability", "spdx", "gnu", "gpl",
          "lgpl", "agpl", "apache", "mit", "bsd", "mozilla", "cc", "creative", "commons", "public", "proprietary", "rights", "reserved"}
_WORD = byte_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)


@dataclass
class Model:
    weight: np.ndarray  # [bucket, class]; the last class is none, the one before other licence text
    bias: np.ndarray
    families: list[str]
    bound: float


def _grams(buf: np.ndarray, off: np.ndarray):
    """Word starts and ends, first word of each text, buckets of each word and of it with the next."""
    s, e, h, first = words(buf, _WORD, off)
    nxt = np.append(h[1:], U64(0)) if len(h) else h
    last = first[1:][np.diff(first) > 0] - 1
    nxt = nxt.copy()
    nxt[last] = U64(3)
    one = (finish(h + U64(17)) >> U64(64 - BITS)).astype(np.int32)
    two = (finish(mix(h, nxt)) >> U64(64 - BITS)).astype(np.int32)
    return s, e, first, one, two


def _sum(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros((len(first) - 1, rows.shape[1]))
    some = np.flatnonzero(np.diff(first) > 0)
    if len(some):
        out[some] = np.add.reduceat(rows, first[some], axis=0)
    return out


def _softmax(z):
    p = np.exp(z - z.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def _probabilities(m: Model, one, two, first):
    n = np.maximum(np.diff(first), 1)[:, None]
    return _softmax(_sum(m.weight[one] + m.weight[two], first) / np.sqrt(n) + m.bias)


def _units(first: np.ndarray, doc: np.ndarray):
    """Words of the lines and then of the windows to score, as starts and ends.

    A run is the lines of a document between blank ones; its windows are those of ``WINDOWS`` words
    that are not a line."""
    some = np.flatnonzero(np.diff(first) > 0)
    if not len(some):
        none = np.zeros(0, np.int64)
        return none, none
    new = np.r_[True, (np.diff(some) > 1) | (doc[some[1:]] != doc[some[:-1]])]
    run = np.cumsum(new) - 1
    start, end = first[some[new]], first[some[np.r_[np.flatnonzero(new)[1:], len(some)] - 1] + 1]
    lines = np.bincount(run)
    a, b = [first[some]], [first[some + 1]]
    for size in WINDOWS:
        k = np.flatnonzero((lines > 1) | (end - start > size))
        count = np.maximum(-(-(end[k] - start[k] - size) // (size // 2)), 0) + 1
        which = np.repeat(k, count)
        at = start[which] + spans(np.zeros(len(k), np.int64), count) * (size // 2)
        at = np.maximum(np.minimum(at, end[which] - size), start[which])
        a.append(at)
        b.append(np.minimum(at + size, end[which]))
    return np.concatenate(a), np.concatenate(b)


def _pack_texts(texts: list[str]):
    body = [t.encode() for t in texts]
    return np.frombuffer(b"".join(body), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in body])])


def _variants(rng, text: str, fill: list[str], n: int) -> list[str]:
    out = [text]
    base = text.split()
    while len(out) < n:
        part = base
        if len(base) > 24 and rng.random() < 0.5:  # as a line or window of it
            size = int(rng.integers(8, min(64, len(base))))
            i = int(rng.integers(len(base) - size + 1))
            part = base[i:i + size]
        w = [x for x in part if rng.random() > 0.08] or part
        if rng.random() < 0.3 and len(w) > 2:
            i = rng.integers(len(w) - 1)
            w[i], w[i + 1] = w[i + 1], w[i]
        if fill and rng.random() < 0.5:
            pick = [fill[i] for i in rng.integers(len(fill), size=rng.integers(1, 8))]
            w = pick + w if rng.random() < 0.5 else w + pick
        s = " ".join(w)
        out.append(s.upper() if rng.random() < 0.1 else s)
    return out


def _plain_words(text: str) -> list[str]:
    b = text.encode()
    s, e, _, _ = words(np.frombuffer(b, np.uint8), _WORD, np.array([0, len(b)]))
    return [b[x:y].decode("utf-8", "ignore").lower() for x, y in zip(s.tolist(), e.tolist())]


def _templates() -> list[tuple]:
    """(family, words, places of each word, words that must match) of all notices and texts."""
    rows = [(f, _plain_words(t), None) for f, ts in TEXTS.items() for t in ts]
    rows += [(f, _plain_words(form.format(n)), set(_plain_words(n)) - _LOOSE) for f, ns in NAMES.items() for n in ns for form in FORMS]
    out = []
    for f, v, must in rows:
        places: dict[str, list[int]] = {}
        for i, x in enumerate(v):
            places.setdefault(x, []).append(i)
        # numbers of list points come and go
        out.append((f, v, places, frozenset(must if must is not None else {x for x in v if x in _TELLING or x.isdigit() and len(v) < 150})))
    return out


def template_spans(w: list[str], eligible, templates: list[tuple]) -> list[tuple[str, int, int]]:
    """(family, first word, word after the last) where a template of an eligible family stands in ``w``.

    A template stands where ``CONFIRM`` of its words are in order, the telling ones among them, in a
    stretch of about its length.  Of overlapping ones, the one with most words more than it lacks."""
    have, found = set(w), []
    for f, v, places, must in templates:
        if f not in eligible or not must <= have or len(places.keys() - have) > (1 - CONFIRM) * len(v):
            continue
        # where the template would begin, by its words
        wide = max(4, len(v) // 8)
        begins: dict[int, int] = {}
        for i, x in enumerate(w):
            for j in places.get(x, ()):
                k = (i - j) // wide
                begins[k] = begins.get(k, 0) + 1
        slack, done = max(6, len(v) // 4), set()
        for k, _ in sorted(begins.items(), key=lambda kv: (-kv[1], kv[0])):
            # words in order lie in a few neighbouring bins
            if sum(begins.get(k + d, 0) for d in range(-3, 4)) < 0.5 * len(v) or done & {k - 1, k, k + 1}:
                continue
            done.add(k)
            a = max(0, k * wide - slack)
            part = w[a:max(0, k * wide) + wide + len(v) + slack]
            blocks = [b for b in SequenceMatcher(None, v, part, autojunk=False).get_matching_blocks() if b.size]
            same = sum(b.size for b in blocks)
            if same < CONFIRM * len(v) or not must <= {x for b in blocks for x in v[b.a:b.a + b.size]}:
                continue
            first, last = blocks[0].b, blocks[-1].b + blocks[-1].size
            if last - first <= 1.3 * len(v) + 3:
                found.append((3 * same - 2 * len(v), same, f, a + first, a + last))
    out: list[tuple[str, int, int]] = []
    for _, _, f, a, b in sorted(found, key=lambda x: (-x[0], -x[1], x[2:])):
        if all(b <= x or a >= y for _, x, y in out):
            out.append((f, a, b))
    return sorted(out, key=lambda x: x[1:])


def _resembles(w: list[str], quoted: set, templates: list[tuple]) -> bool:
    return (len(_LEGAL & set(w)) > 1 or any(tuple(w[i:i + 4]) in quoted for i in range(len(w) - 3))
            or bool(template_spans(w, set(TEXTS), templates)))


def fit(docs: DataFrame, sample: int = SAMPLE_PARAGRAPHS, variants: int = 60, epochs: int = 12, seed: int = 5) -> Model:
    rng = np.random.default_rng(seed)
    families = sorted(TEXTS)
    lines = keyed(docs).select(F.explode(F.split("text", "\n")).alias("p")).filter(F.length("p") > 0)
    at = F.pmod(F.xxhash64("p"), F.greatest(F.length("p") - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    lines = lines.select(F.when(F.length("p") <= SAMPLE_CHARS, F.col("p")).otherwise(F.substring("p", at, F.lit(SAMPLE_CHARS))).alias("p"))
    # the sample of least hash; a line that repeats is one line
    lines = lines.withColumn("k", F.xxhash64("p"))
    distinct = lines.agg(F.approx_count_distinct("k")).first()[0]
    # hashes are even over the distinct lines, so this bound leaves about twice the sample to sort
    bound = int(min(2**63 - 1, -(2**63) + 2**64 * 2 * sample // max(1, distinct)))
    plain = [r["p"] for r in lines.filter(F.col("k") <= bound).groupBy("k").agg(F.min("p").alias("p"))
             .orderBy("k").limit(sample).collect()]
    templates = _templates()
    quoted = {tuple(v[i:i + 4]) for f, v, _, _ in templates if len(v) > 12 for i in range(len(v) - 3)}
    plain = [p for p in plain if not _resembles(_plain_words(p), quoted, templates)]
    fill = [w for p in plain[:300] for w in p.split()]
    texts, y, back = [], [], []
    for k, f in enumerate([*families, None]):
        notices = [form.format(n) for n in NAMES[f] for form in FORMS] if f else []
        some = [v for t in (TEXTS[f] if f else OTHERS) for v in _variants(rng, t, fill, variants)]
        # each notice as it is and, over all of them, as many variants as of a text
        some += notices + [_variants(rng, notices[i], fill, 2)[1] for i in rng.integers(len(notices), size=variants if notices else 0)]
        for i, v in enumerate(some):
            texts.append(v)
            y.append(k)
            back.append(i % 5 == 4)
    none = len(families) + 1
    texts += plain or [""]
    y += [none] * max(1, len(plain))
    back += [False] * max(1, len(plain))
    y, back = np.array(y), np.array(back)
    grams = _pack_texts(texts)
    _, _, first, one, two = _grams(*grams)
    classes = none + 1
    weight, bias = np.zeros((1 << BITS, classes)), np.zeros(classes)
    g2, b2 = np.full((1 << BITS, classes), 1e-6), np.full(classes, 1e-6)
    use = np.flatnonzero(~back)
    for _ in range(epochs):
        for k in range(0, len(use), 32):
            pick = rng.permutation(use)[:32] if k == 0 else use[rng.integers(len(use), size=32)]
            for i in pick:
                a, b = first[i], first[i + 1]
                ids = np.concatenate([one[a:b], two[a:b]])
                scale = 1 / np.sqrt(max(1, b - a))
                z = weight[ids].sum(0) * scale + bias
                p = np.exp(z - z.max())
                p /= p.sum()
                p[y[i]] -= 1
                u, n = np.unique(ids, return_counts=True)
                g = np.outer(n * scale, p)
                g2[u] += g * g
                weight[u] -= 0.3 * g / np.sqrt(g2[u])
                b2 += p * p
                bias -= 0.3 * p / np.sqrt(b2)
    m = Model(weight.astype(np.float32), bias, families, 0.0)
    p = _probabilities(m, one, two, first)
    held = back & (y < len(families))
    if held.any():
        m.bound = float(np.quantile(p[held, y[held]], 0.01))
    return m


def _regions(a, b, doc):
    """Indices of the units of each region: units of a document that overlap or are near each other."""
    out, end, of = [], -1, -1
    for i in np.lexsort((b, a)).tolist():
        if doc[i] != of or a[i] > end + WINDOWS[0]:
            out.append([])
            end = -1
        of, end = doc[i], max(end, int(b[i]))
        out[-1].append(i)
    return out


def _apply(block):
    def apply(batches):
        m = shared(block)
        other, templates = len(m.families), _templates()
        for table in packs(batches, PACK):
            buf, off = utf8(table.column("text"))
            # lines as texts of their own
            breaks = np.flatnonzero(buf == 10) + 1
            cut = np.unique(np.concatenate([off, breaks]))
            s, e, first, one, two = _grams(buf, cut)
            found: list[list] = [[] for _ in range(table.num_rows)]
            count = np.zeros(table.num_rows, np.int64)
            if len(cut) > 1:
                doc = np.searchsorted(off, cut[:-1], "right") - 1
                count = np.bincount(doc[np.diff(first) > 0], minlength=table.num_rows)
                a, b = _units(first, doc)
                ends = first[np.searchsorted(cut, off)]  # words of the documents
                n_lines = int(count.sum())
                sums = np.zeros((len(one) + 1, other + 2))
                np.cumsum(m.weight[one] + m.weight[two], axis=0, out=sums[1:], dtype=np.float64)
                hits, probs = [], []
                for i in range(0, len(a), SCORED):
                    x, y = a[i:i + SCORED], b[i:i + SCORED]
                    p = _softmax((sums[y] - sums[x]) / np.sqrt(y - x)[:, None] + m.bias)
                    hit = np.flatnonzero(p[:, other + 1] < 0.5)
                    hits.append(hit + i)
                    probs.append(p[hit, :other])
                hits, probs = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (hits, probs))
                a, b, line = a[hits], b[hits], hits < n_lines
                of, seen = np.searchsorted(ends, a, "right") - 1, set()
                for units in _regions(a, b, of):
                    lo, hi, d = int(a[units].min()), int(b[units].max()), int(of[units[0]])
                    low, high = max(int(ends[d]), lo - AROUND), min(int(ends[d + 1]), hi + AROUND)
                    p = probs[units].max(0)
                    w = [buf[x:y].tobytes().decode("utf-8", "ignore").lower() for x, y in zip(s[low:high].tolist(), e[low:high].tolist())]
                    spans_ = [(f, x + low, y + low) for f, x, y in template_spans(w, {f for f, q in zip(m.families, p) if q >= m.bound}, templates)]
                    spans_ = [x for x in spans_ if x[1] < hi and x[2] > lo]
                    # a text may reach over several regions
                    rows = [(x, f, float(p[m.families.index(f)])) for f, x, _ in spans_ if (x, f) not in seen]
                    seen.update((x, f) for f, x, _ in spans_)
                    # licence-like lines that no confirmed text reaches, or the region if nothing in it is confirmed
                    rest = [i for i in units if line[i] and all(y <= a[i] or x >= b[i] for _, x, y in spans_)]
                    rows += [(int(a[i]), "unknown", float(probs[i].max())) for i in rest]
                    if not rows and not spans_:
                        rows = [(lo, "unknown", float(p.max()))]
                    for x, f, q in sorted(rows):
                        k = int(np.searchsorted(first, x, "right")) - 1
                        found[doc[k]].append({"family": f, "p": q, "paragraph": int(
                            np.searchsorted(breaks, cut[k], "right") - np.searchsorted(breaks, off[doc[k]], "right"))})
            yield from pa.table({
                "doc_id": table.column("doc_id"), "n_paragraphs": pa.array(count, pa.int64()),
                "found": pa.array(found, pa.list_(pa.struct([("family", pa.string()), ("p", pa.float64()), ("paragraph", pa.int32())])))}).to_batches()
    return apply


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_paragraphs, found (family or unknown, probability, paragraph)."""
    block = share(docs.sparkSession, model or fit(docs))  # 2^14 rows of a float per class
    return keyed(docs).mapInArrow(_apply(block), "doc_id long, n_paragraphs long, found array<struct<family:string,p:double,paragraph:int>>")


def licence_digest(docs: DataFrame) -> DataFrame:
    families = F.array_sort(F.array_distinct(F.filter(F.col("found.family"), lambda f: f != "unknown")))
    return scan(docs).select(
        "doc_id", "n_paragraphs", F.concat_ws(",", families).alias("licences"),
        F.size(F.filter(F.col("found.family"), lambda f: f == "unknown")).alias("n_unknown"),
        F.coalesce(F.array_max("found.p"), F.lit(0.0)).alias("score"))
