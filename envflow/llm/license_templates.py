"""License texts and notices to look for. Fixed values, quoted as they are published: ``...-text`` are whole
licenses, ``...-notice`` whole notices with their version; names without either are openings and one-line forms."""

from envflow.llm.license_texts import TEXTS

TEMPLATES: dict[str, str] = {
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MIT-short": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "Apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "BSD-clauses": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "BSD-short": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "GPL-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation"
    ),
    "GPL-2.0-short": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0-short": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0-short": "Licensed under CC BY 4.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All-rights-reserved": "All rights reserved.",
}

_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
)
_DEALINGS = "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_ISC_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_MIT_GRANT = TEMPLATES["MIT"].partition(", subject to")[0]
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
    "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. "
)
_BSD_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
    "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_ADVERTISING = (
    "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
    "product includes software developed by the organization. "
)

TEMPLATES |= {
    **TEXTS,
    "MIT-text": f"{TEMPLATES['MIT']} {_AS_IS}AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    f"ACTION OF CONTRACT, TORT OR OTHERWISE, {_DEALINGS}",
    "MIT-0-text": f"{_MIT_GRANT}. {_AS_IS}AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    f"ACTION OF CONTRACT, TORT OR OTHERWISE, {_DEALINGS}",
    "BSD-2-Clause-text": _BSD_TWO + _BSD_AS_IS,
    "BSD-3-Clause-text": f"{_BSD_TWO}3. {_BSD_NAMES}{_BSD_AS_IS}",
    "BSD-4-Clause-text": f"{_BSD_TWO}{_BSD_ADVERTISING}4. {_BSD_NAMES}{_BSD_AS_IS}",
    "ISC-text": f"{TEMPLATES['ISC']} {_ISC_AS_IS}",
    "0BSD-text": f"{TEMPLATES['ISC'].partition(', provided')[0]}. {_ISC_AS_IS}",
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but "
        "is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
        "original software. 3. This notice may not be removed or altered from any source distribution."
    ),
    "BSL-1.0-text": (
        "Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, to any person or "
        "organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") "
        "to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the "
        "Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The "
        "copyright notices in the Software and this entire statement, including the above license grant, this restriction and the "
        "following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of "
        "the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated "
        "by a source language processor. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND "
        "NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES "
        f"OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, {_DEALINGS}"
    ),
    "BSL-1.0-notice": (
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "https://www.boost.org/LICENSE_1_0.txt)"
    ),
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of "
        "this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for "
        "the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an "
        "overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
        f"{_AS_IS}AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        f"OTHERWISE, {_DEALINGS} For more information, please refer to <http://unlicense.org/>"
    ),
    "Apache-2.0-notice": (
        f"{TEMPLATES['Apache-2.0']} Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "CC0-1.0-notice": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."
    ),
    "EPL-1.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
        "accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"
    ),
    "EPL-2.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
        "available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "AGPL-notice": TEMPLATES["GPL-notice"].replace("GNU General", "GNU Affero General"),
    "LGPL-2.0-short": "This work is licensed under the GNU Library General Public License, version 2.",
    "LGPL-2.1-short": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0-short": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-short": "This work is licensed under the GNU Affero General Public License, version 3.",
}

#: Words in a row that a match must have to be of its template and not of a relative. Where a template has none,
#: the one with more matched words decides.
DECIDING: dict[str, str] = {
    "Apache-2.0-short": "apache license version 2 0",
    "MIT-short": "the mit license",
    "MIT-licensed": "the mit license",
    "BSD-3-Clause-text": "endorse or promote products",
    "BSD-4-Clause-text": "all advertising materials",
    "EPL-1.0-notice": "eclipse public license v1 0",
    "EPL-2.0-notice": "eclipse public license 2 0",
    "ISC-text": "provided that the above",
    "MIT-text": "subject to the following conditions",
    "GPL-notice": "gnu general public license",
    "LGPL-notice": "gnu lesser general public license",
    "AGPL-notice": "gnu affero general public license",
    "GPL-2.0-short": "gnu general public license version 2",
    "GPL-3.0-short": "gnu general public license version 3",
    "LGPL-2.0-short": "gnu library general public license version 2",
    "LGPL-2.1-short": "gnu lesser general public license version 2 1",
    "LGPL-3.0-short": "gnu lesser general public license version 3",
    "AGPL-3.0-short": "gnu affero general public license version 3",
    "GPL-1.0-text": "gnu general public license",
    "GPL-2.0-text": "gnu general public license",
    "GPL-3.0-text": "refers to version 3 of the gnu general public license",
    "AGPL-3.0-text": "refers to version 3 of the gnu affero general public license",
    "LGPL-2.0-text": "gnu library general public license",
    "LGPL-2.1-text": "gnu lesser general public license",
    "LGPL-3.0-text": "refers to version 3 of the gnu lesser general public license",
}

# the notices of the GNU licenses, for a version and later ones, and for one version only
for _name, _what, _kind, _versions in (
    ("GPL", "program", "General", ("1", "2", "3")),
    ("LGPL", "library", "Library General", ("2",)),
    ("LGPL", "library", "Lesser General", ("2.1", "3")),
    ("AGPL", "program", "Affero General", ("3",)),
):
    for _v in _versions:
        _of = f"{_name}-{_v if '.' in _v else _v + '.0'}"
        _end = (
            f"This {_what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
            f"warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {_kind} Public License for more details. "
            f"You should have received a copy of the GNU {_kind} Public License along with this {_what}"
        )
        _end += (
            ". If not, see <https://www.gnu.org/licenses/>."
            if _v == "3"
            else "; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."
        )
        _begin = f"This {_what} is free software; you can redistribute it and/or modify it under the terms of the GNU {_kind} Public License"
        _short = f"{_begin} as published by the Free Software Foundation; either version {_v} of the License, or (at your option) any later version."
        TEMPLATES |= {
            f"{_of}-or-later": _short,
            f"{_of}-or-later-notice": f"{_short} {_end}",
            f"{_of}-only": f"{_begin} version {_v} as published by the Free Software Foundation.",
            f"{_of}-only-notice": f"{_begin} version {_v} as published by the Free Software Foundation. {_end}",
        }
        _words, _number = f"gnu {_kind} public license".lower(), _v.replace(".", " ")
        DECIDING |= {f"{_of}-or-later{x}": f"either version {_number} of the license|{_words} as published" for x in ("", "-notice")}
        DECIDING |= {f"{_of}-only{x}": f"{_words} version {_number}" for x in ("", "-notice")}

for _name, _kind in (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
):
    TEMPLATES |= {
        f"CC-{_name}-4.0": f"This work is licensed under a Creative Commons {_kind} 4.0 International License.",
        f"CC-{_name}-4.0-short": f"Licensed under CC {_name} 4.0.",
    }
    DECIDING |= {
        f"CC-{_name}-4.0": f"creative commons {_kind} 4 0".lower().replace("-", " "),
        f"CC-{_name}-4.0-short": f"cc {_name} 4 0".lower().replace("-", " "),
    }
