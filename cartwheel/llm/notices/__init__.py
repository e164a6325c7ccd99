"""Public licence notices: whole texts (the files beside this one, and the
short ones below), usual statements, and one statement per Creative Commons
variant, version and spelling. ``notices()`` gives ``(label, text, own)``; ``own``
marks passages that set a licence apart from a longer one that it repeats."""

from __future__ import annotations

from pathlib import Path

_FILES = {"Apache-2.0": "apache", "BSD": "bsd", "CC0-1.0": "cc0", "GPL-2": "gpl", "GPL-3": "gpl", "LGPL-2.1": "lgpl",
          "LGPL-3": "lgpl", "MPL-2.0": "mpl"}

_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
          "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
          "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
          "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
          "OF THIS SOFTWARE.")
_NO_LIABILITY = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
                 "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
                 "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
                 "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
                 "IN THE SOFTWARE.")
_BSD_1 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
          "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
          "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
          "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_2 = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
          "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
          "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
          "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
          "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
          "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
          "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
              "derived from this software without specific prior written permission. ")
_FREE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"

_TEXTS = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
            "this permission notice shall be included in all copies or substantial portions of the Software. " + _NO_LIABILITY),
    ("bsd", _BSD_1 + _BSD_2),
    ("bsd", _BSD_1 + _BSD_NAMES + _BSD_2),
    ("isc", _FREE + ", provided that the above copyright notice and this permission notice appear in all copies. " + _AS_IS),
    ("0bsd", _FREE + ". " + _AS_IS),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
                  "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
                  "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
                  "author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
                  "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
                  "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
                  "this software under copyright law. " + _NO_LIABILITY),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("isc", _FREE + ", provided that the above copyright notice and this permission notice appear in all copies"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
            "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
               "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
               "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
               "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
               "governing permissions and limitations under the License."),
]
for _label, _what, _name in (("gpl", "program", "GNU General Public License"), ("lgpl", "library", "GNU Lesser General Public License"),
                             ("lgpl", "program", "GNU Lesser General Public License"), ("agpl", "program", "GNU Affero General Public License")):
    _head = f"This {_what} is free software: you can redistribute it and/or modify it under the terms of the {_name} as published by the Free Software Foundation"
    _TEXTS.append((_label, _head))
    _TEXTS.append((_label, f"{_head}, either version 3 of the License, or (at your option) any later version. This {_what} is distributed in "
                           "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                           f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {_name} for more details."))
    _TEXTS.append((_label, f"licensed under the {_name} version 3"))

#: what the AGPL says beside the GPL's text
_OWN = [
    ("agpl", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically "
             "designed to ensure cooperation with the community in the case of network server software"),
    ("agpl", "if you modify the Program, your modified version must prominently offer all users interacting with it remotely through a "
             "computer network (if your version supports such interaction) an opportunity to receive the Corresponding Source of your "
             "version"),
]

_CC = {"by": ["Attribution"], "by-sa": ["Attribution-ShareAlike", "Attribution-Share Alike"],
       "by-nc": ["Attribution-NonCommercial", "Attribution-Non-Commercial"],
       "by-nd": ["Attribution-NoDerivatives", "Attribution-NoDerivs", "Attribution-No Derivative Works"],
       "by-nc-sa": ["Attribution-NonCommercial-ShareAlike", "Attribution-Non-Commercial-Share Alike"],
       "by-nc-nd": ["Attribution-NonCommercial-NoDerivatives", "Attribution-NonCommercial-NoDerivs", "Attribution-Non-Commercial-No Derivative Works"]}
_KINDS = {"4.0": "International", "3.0": "Unported", "2.5": "Generic", "2.0": "Generic", "1.0": "Generic"}


def _creative_commons():
    for code, names in _CC.items():
        for version, kind in _KINDS.items():
            yield f"cc-{code}", f"licensed under CC {code.upper()} {version}"
            for name in names:
                yield f"cc-{code}", f"licensed under a Creative Commons {name} {version} {kind} License"
                yield f"cc-{code}", f"Creative Commons {name} {version} {kind}"


def notices() -> list[tuple[str, str, int]]:
    here = Path(__file__).parent
    files = [(label, (here / f"{name}.txt").read_text(encoding="utf-8")) for name, label in _FILES.items()]
    return [(label, text, 0) for label, text in [*files, *_TEXTS, *_creative_commons()]] + [(label, text, 1) for label, text in _OWN]
