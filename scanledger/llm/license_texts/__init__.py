"""Texts, standard headers, names and titles of licences, read by the driver.

The long texts are files of this folder.  The full texts of EPL-2.0 and of the
three CC BY licences are not here: they are known by their notice and title.
"""

from __future__ import annotations

from pathlib import Path

_GNU = """This program is free software; you can redistribute it and/or modify it under the terms of the {name} as published
by the Free Software Foundation; {version}.
This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.
You should have received a copy of the {name} along with this program. If not, see <https://www.gnu.org/licenses/>."""
_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO
EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in
the documentation and/or other materials provided with the distribution.
"""
_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission.
"""
_ADVERTISING = """3. All advertising materials mentioning features or use of this software must display the following acknowledgement:
This product includes software developed by the copyright holder.
"""
_CC = """This work is licensed under a Creative Commons {kind} {version} License. To view a copy of this license, visit
http://creativecommons.org/licenses/{code}/{number}/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA."""


def _later(n: str) -> str:
    return f"either version {n} of the License, or (at your option) any later version"


#: Notices that stand at the head of files, and short licences as a whole.
NOTICES = [
    ("AGPL-3.0", _GNU.format(name="GNU Affero General Public License", version=_later("3"))),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed
to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    ),
    ("BSD-2-Clause", _BSD + _WARRANTY),
    ("BSD-3-Clause", _BSD + _NAMES + _WARRANTY),
    ("BSD-4-Clause", _BSD + _ADVERTISING + _NAMES.replace("3.", "4.") + _WARRANTY),
    (
        "CC0-1.0",
        """To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this
software to the public domain worldwide. This software is distributed without any warranty. You should have received a copy of the CC0
Public Domain Dedication along with this software. If not, see <http://creativecommons.org/publicdomain/zero/1.0/>.""",
    ),
    (
        "EPL-1.0",
        """This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which
accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html""",
    ),
    (
        "EPL-2.0",
        """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is
available at https://www.eclipse.org/legal/epl-2.0/""",
    ),
    ("GPL-2.0", _GNU.format(name="GNU General Public License", version=_later("2"))),
    ("GPL-2.0", _GNU.format(name="GNU General Public License", version="version 2 of the License")),
    ("GPL-3.0", _GNU.format(name="GNU General Public License", version=_later("3"))),
    ("GPL-3.0", _GNU.format(name="GNU General Public License", version="version 3 of the License")),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    ("LGPL-2.0", _GNU.format(name="GNU Library General Public License", version=_later("2"))),
    ("LGPL-2.1", _GNU.format(name="GNU Lesser General Public License", version=_later("2.1"))),
    ("LGPL-3.0", _GNU.format(name="GNU Lesser General Public License", version=_later("3"))),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
]
#: Neighbours that are not in TEMPLATES are here so that they are not taken for one that is.
_KINDS = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nd": "Attribution-NoDerivatives", "by-nc": "Attribution-NonCommercial", "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
NOTICES += [(f"CC-{code.upper()}-{number}", _CC.format(kind=kind, code=code, number=number, version=version)) for code, kind in _KINDS.items() for number, version in (("3.0", "3.0 Unported"), ("4.0", "4.0 International"))]
FILES = ("Apache-2.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")
#: Titles in a line of their own, for licence files whose text is not here.
TITLES = {
    "CC-BY-4.0": r"(creative commons )?attribution 4\.0 international( public license)?",
    "CC-BY-NC-4.0": r"(creative commons )?attribution-noncommercial 4\.0 international( public license)?",
    "CC-BY-SA-4.0": r"(creative commons )?attribution-sharealike 4\.0 international( public license)?",
    "EPL-2.0": r"eclipse public license *-? *(v|version) ?\.? ?2\.0",
}


def licence_texts() -> list[tuple[str, str]]:
    """Name and text of every template; a licence has one for each of its forms."""
    full = {name: (Path(__file__).parent / f"{name}.txt").read_text(encoding="utf-8") for name in FILES}
    # The Affero licence has the words of GPL-3.0 but for its name and a section.
    affero = full["GPL-3.0"].replace("GENERAL PUBLIC", "AFFERO GENERAL PUBLIC").replace("GNU General Public", "GNU Affero General Public")
    return sorted([*NOTICES, *full.items(), ("AGPL-3.0", affero)])
