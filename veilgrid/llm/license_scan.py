"""License scans by template markup: optional and replaceable regions compiled into one token automaton.

A template is license wording with public template markup. Plain words are mandatory. ``<<beginOptional>>`` to
``<<endOptional>>`` may be left out. ``<<var;name="..";match="..">>`` is replaceable: ``.+`` stands for one word or
more (a state that loops, however long the region), ``.{0,N}`` for up to N words, and ``a b|c`` for one of the listed
phrases. All templates become one nondeterministic automaton over words. It reads a text once, with a new start at each
word, and is determinised while it reads, state by state. A text passes when some run of its words is accepted, that is,
every mandatory word stands in its place. ``.+`` inside a template may span other wording: the mandatory words must
still follow in order.

Cases: null and empty texts have no words, no labels and score 0. Repeated rows each get a row. Texts are read
whole; a template is only tried in texts that hold all its mandatory words. An empty table gives an empty one. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from . import common

#: The base phrases and their labels.
BASE = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))

#: Determinised steps that a worker remembers at once; beyond, it starts anew.
REMEMBERED = 100_000

#: The parts of whole license texts that several share, as published.
WARRANTY_MIT = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<var;name="holder";match=".+">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
GRANT_MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;name="what";match="this software|.{0,8}">> and <<beginOptional>>to any<<endOptional>> associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software.'
GRANT_ISC = 'Permission to use, copy, modify, <<var;name="and";match="and|and/or">> distribute this software for any purpose with or without fee is hereby granted'
NOTICE_ISC = ', provided that the above copyright notice and this permission notice appear in all copies.'
WARRANTY_ISC = 'THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name="holder";match=".{1,12}">> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL <<var;name="holder";match=".{1,12}">> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
GRANT_BSD = 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.'
NAMES_BSD = '<<beginOptional>>3.<<endOptional>> Neither the name of <<var;name="holder";match=".+">> nor the names of <<beginOptional>>its<<endOptional>> <<beginOptional>>the<<endOptional>> contributors may be used to endorse or promote products derived from this software without specific prior written permission.'
WARRANTY_BSD = 'THIS SOFTWARE IS PROVIDED BY <<var;name="holder";match=".{1,16}">> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL <<var;name="holder";match=".{1,16}">> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'

#: License wording as published, with the public template markup. ASCII only. Labels ending in
#: ``-text`` are whole license texts (``bsd-text``: the conditions that the family shares), the others the notices that stand in files and at the foot of documents.
TEMPLATES = {
    "mit-notice": '<<var;name="verb";match="released|licensed|distributed|available|provided">> under the <<beginOptional>>terms of the<<endOptional>> MIT License',
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this <<var;name="what";match="file|work|.{1,6}">> except in compliance with the License. You may obtain a copy of the License at <<var;name="where";match=".+">> Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "gpl-2.0": 'licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License, version 2',
    "gpl-3.0": 'licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License, version 3',
    "gpl-header": 'you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version <<var;name="version";match="1|2|3">> of the License, or <<beginOptional>>(at your option)<<endOptional>> any later version',
    "gpl-header-full": '<<var;name="what";match="This program|.{1,8}">> is free software<<var;name="sign";match="|: ">> you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation<<var;name="sign";match="|, ">> either version <<var;name="version";match="1|2|3">> of the License, or <<beginOptional>>(at your option)<<endOptional>> any later version. <<var;name="what";match="This program|.{1,8}">> is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.',
    "lgpl-notice": 'licensed under the <<beginOptional>>terms of the<<endOptional>> GNU <<var;name="kind";match="Lesser|Library">> General Public License',
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mpl-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "cc-by": 'licensed under <<beginOptional>>a<<endOptional>> <<var;name="who";match="CC|Creative Commons">> <<var;name="kind";match="BY|Attribution">> <<var;name="version";match="1.0|2.0|2.5|3.0|4.0">>',
    "cc-by-sa": 'licensed under <<beginOptional>>a<<endOptional>> <<var;name="who";match="CC|Creative Commons">> <<var;name="kind";match="BY-SA|Attribution ShareAlike">> <<var;name="version";match="1.0|2.0|2.5|3.0|4.0">>',
    "cc-by-nc": 'licensed under <<beginOptional>>a<<endOptional>> <<var;name="who";match="CC|Creative Commons">> <<var;name="kind";match="BY-NC|Attribution NonCommercial">> <<var;name="version";match="1.0|2.0|2.5|3.0|4.0">>',
    "spdx-tag": 'SPDX License Identifier <<var;name="id";match=".{1,1}">>',
    "mit-text": f"{GRANT_MIT} {WARRANTY_MIT}",
    "isc-text": f"{GRANT_ISC}{NOTICE_ISC} {WARRANTY_ISC}",
    "0bsd-text": f"{GRANT_ISC}. {WARRANTY_ISC}",
    "bsd-text": GRANT_BSD,
    "bsd-2-clause-text": f"{GRANT_BSD} {WARRANTY_BSD}",
    "bsd-3-clause-text": f"{GRANT_BSD} {NAMES_BSD} {WARRANTY_BSD}",
    "zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will <<var;name=\"holder\";match=\".{1,8}\">> be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: <<beginOptional>>1.<<endOptional>> The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. <<beginOptional>>2.<<endOptional>> Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. <<beginOptional>>3.<<endOptional>> This notice may not be removed or altered from any source distribution.",
    "boost-1.0-text": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "unlicense-text": f"This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. {WARRANTY_MIT}",
}

#: ASCII bytes that are no letters or digits become spaces, A-Z become a-z; bytes over 0x7F stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

PIECE = re.compile(r'<<beginOptional>>|<<endOptional>>|<<var;[^>]*?match="(?P<match>[^"]*)"[^>]*>>|(?P<words>(?:(?!<<).)+)', re.S)
GAP = re.compile(r"\.(?:\+|\{(?P<low>\d+),(?P<high>\d+)\})")
ANY = None


def words_of(body: bytes) -> list[bytes]:
    """Words of letters a-z, digits and bytes over 0x7F, A-Z lower-cased."""
    return body.translate(FOLD).split()


class Automaton:
    """Templates as one automaton: ``steps[state]`` has (word or ANY, next), ``free[state]`` next states without a word."""

    def __init__(self, templates: dict[str, str]):
        self.steps: list[list[tuple[bytes | None, int]]] = []
        self.free: list[list[int]] = []
        self.accepts: dict[int, str] = {}
        self.needs: dict[str, frozenset[bytes]] = {}
        self.starts: dict[str, int] = {}
        for label, text in templates.items():
            self.starts[label] = self.state()
            self.accepts[self.compile(label, text, self.starts[label])] = label
        self.known: dict[tuple, tuple] = {}
        self.letters = frozenset(w for s in self.steps for w, _ in s if w is not ANY)

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def chain(self, at: int, words: list[bytes | None]) -> int:
        for w in words:
            to = self.state()
            self.steps[at].append((w, to))
            at = to
        return at

    def compile(self, label: str, text: str, at: int) -> int:
        needs: set[bytes] = set()
        opened: list[int] = []
        for m in PIECE.finditer(text):
            if m["words"] is not None:
                words = words_of(m["words"].encode())
                at = self.chain(at, words)
                if not opened:
                    needs.update(words)
            elif m["match"] is not None:
                end = self.state()
                for choice in m["match"].split("|"):
                    gap = GAP.fullmatch(choice)
                    if gap is None:
                        self.free[self.chain(at, words_of(choice.encode()))].append(end)
                        continue
                    low, high = (1, None) if gap["low"] is None else (int(gap["low"]), int(gap["high"]))
                    last = self.chain(at, [ANY] * low)
                    self.free[last].append(end)
                    if high is None:
                        self.steps[last].append((ANY, last))
                    for _ in range(low, high or low):
                        last = self.chain(last, [ANY])
                        self.free[last].append(end)
                at = end
            elif m[0] == "<<beginOptional>>":
                opened.append(at)
            else:
                end = self.state()
                self.free[at].append(end)
                self.free[opened.pop()].append(end)
                at = end
        self.needs[label] = frozenset(needs)
        return at

    def closed(self, states: set[int]) -> frozenset[int]:
        """With all states reached without a word."""
        todo, seen = list(states), set(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)

    def step(self, states: frozenset[int], word: bytes) -> tuple[frozenset[int], frozenset[str]]:
        """The states after a word and the labels accepted there; each pair is worked out once."""
        key = (states, word if word in self.letters else ANY)
        got = self.known.get(key)
        if got is None:
            after = self.closed({to for s in states for w, to in self.steps[s] if w is ANY or w == word})
            got = after, frozenset(self.accepts[s] for s in after if s in self.accepts)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[key] = got
        return got

    def labels(self, words: list[bytes]) -> set[str]:
        """Templates that accept some run of the words: one pass, with a new start at each word."""
        there = set(words)
        todo = frozenset(x for x, need in self.needs.items() if need <= there)
        found: set[str] = set()
        if not todo:
            return found
        start = self.closed({self.starts[x] for x in todo})
        begin = frozenset(w for s in start for w, _ in self.steps[s])
        everywhere = ANY in begin
        states: frozenset[int] = frozenset()
        for w in words:
            if everywhere or w in begin:
                states = states | start
            if states:
                states, new = self.step(states, w)
                found |= new
                if len(found) == len(todo):
                    break
        return found


def places(words: list[bytes], phrase: tuple[bytes, ...]) -> list[int]:
    """Starts of a phrase, by looking for its last word only."""
    out, last, before = [], phrase[-1], len(phrase) - 1
    at = -1
    for _ in range(words.count(last)):
        at = words.index(last, at + 1)
        if at >= before and tuple(words[at - before : at]) == phrase[:-1]:
            out.append(at - before)
    return out


class Scan:
    """All columns after ``doc_id`` for one text; the automaton is compiled once in each worker."""

    def __init__(self, templates: dict[str, str]):
        self.templates, self.automaton = templates, None

    def __getstate__(self) -> dict:
        return {"templates": self.templates, "automaton": None}

    def __call__(self, body: bytes) -> tuple:
        if self.automaton is None:
            self.automaton = Automaton(self.templates)
        words = words_of(body)
        base, starts = set(), []
        for phrase, label in BASE:
            at = places(words, tuple(x.encode() for x in phrase))
            if at:
                base.add(label)
                starts += at
        own = self.automaton.labels(words)
        return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(base | own)), 1.0 if own else 0.5 if base else 0.0


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")[1:]]


def scan(df: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Labels for each document. ``score``: 1 where a whole template is accepted, 0.5 where only a base phrase stands, else 0."""
    return common.per_document(common.text_rows(df), Scan(templates or TEMPLATES), SCHEMA, NAMES)
