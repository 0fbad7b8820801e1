"""Known licences: fixed values, whole texts and the notices that stand for a licence in one line."""

from __future__ import annotations

# Short public licence texts, by their SPDX identifiers. Copyright lines are left out of the digest.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "FSFAP": """Copying and distribution of this file, with or without modification, are permitted in any medium without royalty provided the copyright notice and this notice are preserved. This file is offered as-is, without any warranty.""",
}

# Names under which licences are cited in notices.
NAMES = {
    "MIT": ("MIT License",),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2",),
    "GPL-3.0": ("GNU General Public License, version 3",),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3",),
    "MPL-2.0": ("Mozilla Public License, version 2.0",),
    "BSD-3-Clause": ("BSD 3-Clause License",),
    "ISC": ("ISC License",),
    "CC0-1.0": ("CC0 1.0",),
    "CC-BY-4.0": ("CC BY 4.0",),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0",),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0",),
}
PHRASES = ("Licensed under {}.", "Licensed under the {}.", "Released under {}.", "Released under the {}.",
           "This work is licensed under {}.", "This work is licensed under the {}.")

# Spellings that count as the same word.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("artefact", "artifact"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("cancelled", "canceled"), ("centre", "center"), ("copyright holder", "copyright owner"),
    ("favour", "favor"), ("fulfil", "fulfill"), ("initialise", "initialize"), ("labelling", "labeling"),
    ("licence", "license"), ("modelled", "modeled"), ("noncommercial", "non commercial"),
    ("organisation", "organization"), ("organise", "organize"), ("practise", "practice"), ("programme", "program"),
    ("recognise", "recognize"), ("sub license", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
)


def notices() -> list[tuple[str, str]]:
    """(licence, notice line) of every phrase with every name."""
    return [(licence, phrase.format(name)) for licence, names in NAMES.items() for name in names for phrase in PHRASES]
