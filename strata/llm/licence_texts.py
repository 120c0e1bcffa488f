"""Texts of public licences, notices that name one, and equivalent spellings.

Long texts lie unchanged in the folder ``known_texts``, one file a licence.
"""

from __future__ import annotations

import os

#: The long texts: <licence>.txt or <licence>#<variant>.txt.
FOLDER = os.path.join(os.path.dirname(os.path.abspath(__file__)), "known_texts")
#: Behind it stand only hints for those who use the licence, which copies often leave out.
END_OF_TERMS = "END OF TERMS AND CONDITIONS"

#: Spellings that count as one word (left side becomes the right side).
EQUIVALENT_WORDS = {
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "sublicence": "sublicense",
    "organisation": "organization",
    "organisations": "organizations",
    "acknowledgement": "acknowledgment",
    "judgement": "judgment",
    "favour": "favor",
    "honour": "honor",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "wilful": "willful",
    "whilst": "while",
    "centre": "center",
    "noncommercial": "non commercial",
    "noninfringement": "non infringement",
    "owner": "holder",
    "owners": "holders",
    "https": "http",
}

_MIT_BODY = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING
BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""

_ISC_BODY = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without
fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.
"""

_ISC_DISCLAIMER = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE
OF THIS SOFTWARE.
"""

_BSD_CONDITIONS = """
Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution.
"""

_BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY
WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""

_BSD_ENDORSEMENT = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission.
"""

_APACHE_NOTICE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License
is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express
or implied. See the License for the specific language governing permissions and limitations
under the License.
"""

#: Headings that stand above the short texts.
_HEADINGS = {
    "MIT": ["The MIT License (MIT)", "MIT License (MIT)", "The MIT License (Expat)"],
    "ISC": ["The ISC License", "ISC License (ISC)", "The ISC License (ISC)"],
    "0BSD": ["BSD Zero Clause License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'],
    "BSD-3-Clause": [
        "BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License'
    ],
}

_VERBS = [
    "Licensed under", "Released under", "Distributed under", "Available under", "Published under",
    *(
        f"This {what} is {how} under"
        for what in ("work", "software", "project", "file", "code")
        for how in ("licensed", "released", "distributed")
    ),
]

#: Licence -> how notices name it; without a version only the family is known.
_NAMES = {
    "MIT": ["the MIT License"],
    "ISC": ["the ISC License"],
    "BSD-2-Clause": ["the BSD 2-Clause License"],
    "BSD-3-Clause": ["the BSD 3-Clause License"],
    "Apache": ["the Apache License"],
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License"],
    "CC0-1.0": ["CC0 1.0", "the CC0 1.0 Universal license"],
    "Unlicense": ["the Unlicense"],
    **{
        f"MPL-{v}": [f"the Mozilla Public License, version {v}", f"the Mozilla Public License {v}", f"the MPL {v}"]
        for v in ("1.1", "2.0")
    },
    **{
        f"{short}-{v}": [
            f"the GNU {name}, version {v.removesuffix('.0')}",
            f"the GNU {name} version {v.removesuffix('.0')}",
            f"the GNU {name} v{v.removesuffix('.0')}",
            f"the GNU {name} v{v}",
            f"the GNU {short} v{v.removesuffix('.0')}",
            f"the {short} v{v.removesuffix('.0')}",
            f"the GNU {name}, version {v}",
        ]
        for short, name, versions in (
            ("GPL", "General Public License", ("1.0", "2.0", "3.0")),
            ("LGPL", "Lesser General Public License", ("2.1", "3.0")),
            ("AGPL", "Affero General Public License", ("3.0",)),
        )
        for v in versions
    },
    **{f"CC-{k}-{v}": [f"CC {k} {v}", f"a CC {k} {v} license"] for k in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("3.0", "4.0")},
}


def texts_in(folder: str) -> dict[str, str]:
    """The texts of ``folder``, whole and up to the end of their terms, as ``KNOWN_TEXTS`` has them."""
    found = {}
    for file in sorted(os.listdir(folder)):
        if not file.endswith(".txt"):
            continue
        with open(os.path.join(folder, file), encoding="utf-8") as f:
            text = f.read()
        name = file.removesuffix(".txt")
        name = name if "#" in name else f"{name}#whole"
        found[name] = text
        if END_OF_TERMS in text:
            terms = text.split(END_OF_TERMS)[0]
            found[f"{name}_terms"], found[f"{name}_terms_end"] = terms, terms + END_OF_TERMS
    return found


#: Licence (before any #) -> a text that stands for it as a whole.
KNOWN_TEXTS = {
    "MIT": _MIT_BODY,
    "MIT#titled": "MIT License\n" + _MIT_BODY,
    "MIT#titled_the": "The MIT License\n" + _MIT_BODY,
    "MIT#notice": "Released under the MIT License.",
    "MIT#notice_licensed": "Licensed under the MIT License.",
    "ISC": _ISC_BODY + _ISC_DISCLAIMER,
    "ISC#titled": "ISC License\n" + _ISC_BODY + _ISC_DISCLAIMER,
    "0BSD": _ISC_BODY.split(", provided")[0] + "." + _ISC_DISCLAIMER,
    "BSD-2-Clause": _BSD_CONDITIONS + _BSD_DISCLAIMER,
    "BSD-3-Clause": _BSD_CONDITIONS + _BSD_ENDORSEMENT + _BSD_DISCLAIMER,
    "Apache-2.0": _APACHE_NOTICE,
    "Apache-2.0#notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0#notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0#notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0#notice": "Licensed under CC BY 4.0.",
    "MIT#spdx": "SPDX-License-Identifier: MIT",
    "Apache-2.0#spdx": "SPDX-License-Identifier: Apache-2.0",
    "BSD-3-Clause#spdx": "SPDX-License-Identifier: BSD-3-Clause",
    "GPL-3.0#spdx": "SPDX-License-Identifier: GPL-3.0-only",
}
for _licence, _headings in _HEADINGS.items():
    for _i, _heading in enumerate(["", *_headings]):
        # Some holders reserve all rights on a line of its own.
        for _j, _rights in enumerate(["", "All rights reserved.\n"]):
            if _heading or _rights:
                KNOWN_TEXTS[f"{_licence}#headed{_i}{_j}"] = f"{_heading}\n{_rights}" + KNOWN_TEXTS[_licence]
for _licence, _names in _NAMES.items():
    for _i, _name in enumerate(_names):
        for _j, _verb in enumerate(_VERBS):
            KNOWN_TEXTS[f"{_licence}#named{_i}_{_j}"] = f"{_verb} {_name}."
KNOWN_TEXTS.update(texts_in(FOLDER))
