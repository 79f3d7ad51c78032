"""Templates of licence texts and of multi-line headers, by SPDX id; long texts lie in ``licence_bodies``."""

from __future__ import annotations

from pathlib import Path

_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,
BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
_CLAUSES = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution.
"""
_NAMES = """
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission.
"""
_GRANT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do
so, subject to the following conditions:
"""
_MIT = f"""MIT License
Copyright (c)
{_GRANT}
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to"
    ' in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY'
    " KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
)


def _gnu(work: str, name: str, version: str) -> tuple[str, str]:
    """The first sentence and the whole of the header of a GNU licence."""
    first = (
        f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by"
        f" the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
    )
    rest = (
        f" This {work} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty"
        f" of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy"
        f" of the GNU {name} along with this {work}. If not, see <https://www.gnu.org/licenses/>."
    )
    return first, first + rest


_GPL, _LGPL = "General Public License", "Lesser General Public License"
TEXTS: dict[str, tuple[str, ...]] = {
    "AGPL-3.0": _gnu("program", "Affero General Public License", "3"),
    "Apache-2.0": (_APACHE[0], "".join(_APACHE)),
    "BSD-2-Clause": (_CLAUSES + _DISCLAIMER,),
    "BSD-3-Clause": (_CLAUSES + _NAMES + _DISCLAIMER, _NAMES),
    "GPL-2.0": (*_gnu("program", _GPL, "2"), "This work is licensed under the GNU General Public License, version 2."),
    "GPL-3.0": _gnu("program", _GPL, "3"),
    "LGPL-2.1": _gnu("library", _LGPL, "2.1"),
    "LGPL-3.0": (*_gnu("library", _LGPL, "3"), "This library is licensed under the GNU Lesser General Public License, version 3."),
    "MIT": (_MIT, _GRANT),
}


def all_templates(notices: dict[str, str]) -> list[tuple[str, str]]:
    """(SPDX id, text) of the one-line notices, the headers and the licence texts."""
    bodies = [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "licence_bodies").glob("*.txt"))]
    return [*notices.items(), *((name, text) for name, texts in TEXTS.items() for text in texts), *bodies]
