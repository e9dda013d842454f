"""Licence texts whose wording is in no given table."""

import textwrap

import pytest

from lectern.llm import licences

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD3 = BSD2.replace("THIS SOFTWARE IS", """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
THIS SOFTWARE IS""", 1)
GNU = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU {}General Public License as published by
the Free Software Foundation, either version {} of the License, or
(at your option) any later version."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
CASES = [("MIT", MIT), ("BSD-2-Clause", BSD2), ("BSD-3-Clause", BSD3), ("GPL-3.0", GNU.format("", 3)), ("GPL-2.0", GNU.format("", 2)),
         ("BSD-3-Clause", BSD3.replace("\n1.", "\n\n1.").replace("\n2.", "\n\n2.").replace("\n3.", "\n\n3.").replace("\nTHIS", "\n\nTHIS")),
         ("AGPL-3.0", GNU.format("Affero ", 3)), ("LGPL-3.0", GNU.format("Lesser ", 3)), ("ISC", ISC),
         ("CC0-1.0", "To the extent possible under law, Jane Roe has waived all copyright and related or neighboring rights to this work."),
         ("CC-BY-SA-4.0", "Text is available under CC BY-SA 4.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
         ("MIT", "The code is distributed under the terms of the MIT license.")]
PLAIN = ("the river was high in spring and the boats lay by the mill while the children of the village went down to the water to see "
         "how far it had come over the lower fields since the rain began").split()


@pytest.fixture(scope="module")
def got(spark):
    plain = [" ".join(PLAIN[(i * 7 + j * (1 + i % 5)) % len(PLAIN)] for j in range(12 + i % 60)) for i in range(300)]
    rows = [(i, t) for i, (_, t) in enumerate(CASES)]
    # in lines of another width, in one long line of other text, and among lines of other text
    rows += [(100 + i, "\n".join(textwrap.wrap(" ".join(t.split()), 50))) for i, (_, t) in enumerate(CASES)]
    rows += [(200 + i, " ".join([*plain[:9], *t.split(), *plain[9:18]])) for i, (_, t) in enumerate(CASES)]
    rows += [(300 + i, "\n".join([*plain[20:24], t, *plain[24:28]])) for i, (_, t) in enumerate(CASES)]
    rows += [(1000 + i, t) for i, t in enumerate(plain)]
    return {r["doc_id"]: r for r in licences.licence_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


@pytest.mark.parametrize("shape", [0, 100, 200, 300])
def test_texts(got, shape):
    assert [got[shape + i]["licences"] for i in range(len(CASES))] == [f for f, _ in CASES]


def test_plain_text_has_none(got):
    assert all(got[1000 + i]["licences"] == "" and got[1000 + i]["n_unknown"] == 0 for i in range(300))
