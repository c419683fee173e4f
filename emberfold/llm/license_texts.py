"""Licence wording as templates.

Fixed values: the published wording of licences and of their usual notices. Between the marks of an
optional region stands wording that may be missing; a replaceable region stands for any words, between
so many and so many, such as the name of a holder.
"""

from __future__ import annotations

from typing import NamedTuple


class Template(NamedTuple):
    name: str
    label: str
    text: str


# Phrases that give a label wherever they stand.
PHRASES = [
    Template("phrase gpl", "gpl", "gnu general public license"),
    Template("phrase apache", "apache", "apache license"),
    Template("phrase cc-by", "cc-by", "cc by"),
    Template("phrase mit", "mit", "mit license"),
]

_BSD_HEAD = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above
copyright notice, this list of conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>>
Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """
<<beginOptional>>3.<<endOptional>> Neither the name of <<var;name="organization";words="1-12">> nor the names of its
contributors may be used to endorse or promote products derived from this software without specific prior written
permission."""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY <<var;name="holder";words="1-12">> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL <<var;name="liable";words="1-12">> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


def _gpl(version: str) -> list[Template]:
    return [
        Template(f"gpl {version} notice", f"gpl-{version}.0", f"""
This <<var;name="work";words="1-4">> is free software<<beginOptional>>:<<endOptional>> you can redistribute it and/or
modify it under the terms of the GNU General Public License as published by the Free Software
Foundation<<beginOptional>>, either<<endOptional>> version {version} of the License<<beginOptional>>, or (at your
option) any later version<<endOptional>>. <<beginOptional>> <<var;name="program";words="1-4">> is distributed in the
hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS
FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.<<endOptional>>"""),
        Template(f"gpl {version} line", f"gpl-{version}.0", f"""
<<beginOptional>>This <<var;name="work";words="1-4">> is <<endOptional>>licensed under the <<beginOptional>>terms of
the <<endOptional>>GNU General Public License<<beginOptional>> (GPL)<<endOptional>>, version {version}
<<beginOptional>>.0<<endOptional>>"""),
    ]


def _creative_commons(name: str, words: str) -> list[Template]:
    return [Template(f"{name} line", name, f"""
<<beginOptional>>This <<var;name="work";words="1-4">> is <<endOptional>>licensed under <<beginOptional>>a
<<endOptional>><<beginOptional>>the <<endOptional>>{text} 4.0<<beginOptional>> International<<endOptional>>
<<beginOptional>> License<<endOptional>>""") for text in (
        name.rsplit("-", 1)[0], f"Creative Commons {words}")]


LICENSES = [
    Template("mit text", "mit", """
Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;name="software";words="1-8">>
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission
notice <<beginOptional>>(including the next paragraph) <<endOptional>>shall be included in all copies or substantial
portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL <<var;name="liable";words="1-12">> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""),
    Template("mit line", "mit", """
<<beginOptional>>This <<var;name="work";words="1-4">> is <<endOptional>>released under the <<beginOptional>>terms of the
<<endOptional>>MIT License"""),
    Template("isc text", "isc", """
Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND <<var;name="author";words="1-12">> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL
<<var;name="liable";words="1-12">> BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    Template("bsd 2 text", "bsd-2-clause", _BSD_HEAD + _BSD_TAIL),
    Template("bsd 3 text", "bsd-3-clause", _BSD_HEAD + _BSD_NAMES + _BSD_TAIL),
    Template("apache 2 notice", "apache-2.0", """
Licensed under the Apache License, Version 2.0<<beginOptional>> (the "License"); you may not use
<<var;name="file";words="1-6">> except in compliance with the License. You may obtain a copy of the License at
<<beginOptional>>http<<endOptional>><<beginOptional>>https<<endOptional>>://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License<<endOptional>>."""),
    *_gpl("2"), *_gpl("3"),
    *_creative_commons("cc-by-4.0", "Attribution"),
    *_creative_commons("cc-by-sa-4.0", "Attribution-ShareAlike"),
    *_creative_commons("cc-by-nc-4.0", "Attribution-NonCommercial"),
    *_creative_commons("cc-by-nd-4.0", "Attribution-NoDerivatives"),
    Template("zlib text", "zlib", """
This software is provided 'as-is', without any express or implied warranty. In no event will
<<var;name="authors";words="1-12">> be held liable for any damages arising from the use of this software. Permission is
granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions: <<beginOptional>>1.<<endOptional>> The origin of this
software must not be misrepresented; you must not claim that you wrote the original software. If you use this software
in a product, an acknowledgment in the product documentation would be appreciated but is not required.
<<beginOptional>>2.<<endOptional>> Altered source versions must be plainly marked as such, and must not be
misrepresented as being the original software. <<beginOptional>>3.<<endOptional>> This notice may not be removed or
altered from any source distribution."""),
    *[Template(f"identifier {name}", name, f"SPDX-License-Identifier: {name}") for name in (
        "mit", "isc", "bsd-2-clause", "bsd-3-clause", "apache-2.0", "zlib", "cc-by-4.0", "cc-by-sa-4.0",
        "cc-by-nc-4.0", "cc-by-nd-4.0")],
    *[Template(f"identifier gpl-{v}.0", f"gpl-{v}.0", f"""SPDX-License-Identifier: GPL-{v}.0<<beginOptional>>-only
<<endOptional>><<beginOptional>>-or-later<<endOptional>>""") for v in (2, 3)],
]
