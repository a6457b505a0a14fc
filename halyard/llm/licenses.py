"""License scans, in DataFrame operations only.

Units of a whole text are compared with templates (notices, headers, licence texts) by the cosine of sparse TF-IDF
vectors, a join of a unit's terms with the templates' postings. Units are lines or sentences, blocks of adjacent lines, and
runs of adjacent blocks that speak of licensing: a wrapped header, or a whole licence file. What a unit is called is decided by the words that tell licences apart: each licence
has an identity, a pattern that the unit's terms must have and one that they mustn't, of name, version and clauses. So a
header of version 2 is never called version 3 for all that the two share, and a notice without a version gets the family's name
alone. Where a text has both the more exact name and the less exact one, as of a grant by itself, the exact one counts. An SPDX tag is read as an expression and outranks what resembles; a bare reservation of rights counts only where
nothing else is found. A file whose words are mostly licence, or whose name says so, is a licence file of its
directory. A file without a header of its own takes the licence of the nearest directory above it, by a join on paths.

A unit is what has one of a few stems (ANCHORS), which notices and licences have: texts, blocks and lines without any are passed over by
a search for them. An abbreviation by itself, without a word of licensing beside it, is no notice. Only units with an identity leave the scan, with the templates' terms among theirs; all other terms have one
weight, so the sum of their squared counts, made where the text is, completes a unit's length. Ancestors are
made for distinct directories, not for files, so a directory with most files costs one row. The templates are
a short list of the caller's, and only they are broadcast.

Defined results: a null or empty text has no licence of its own; a null path has no directory, so nothing is
inherited; among equal scores the first licence name wins; each row is scanned for itself, also where its
doc_id is null or repeats; of several SPDX tags the first counts, up to where it stops being an expression.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from halyard.llm.shared import skewed_join, written


class License(NamedTuple):
    name: str
    must: str  # patterns over a unit's terms with spaces between them
    never: str
    titles: tuple[str, ...]  # as notices call it
    texts: tuple[str, ...] = ()  # headers and texts
    over: tuple[str, ...] = ()  # less exact names, which don't count beside it

    def templates(self) -> list[str]:
        return [f"{start} {title}." for title in self.titles for start in ("Licensed under the", "Released under the", "This work is licensed under the")] + list(self.texts)


def _gnu(name: str, short: str, title: str, version: str, date: str, subject: str = "program", never: str = "") -> License:
    number = version.replace(".", r"\.") + (r"(\.0)?" if "." not in version else "")
    said = rf"(version|v) ?{number}( |$)"
    title_terms = title.lower()
    must = rf"{title_terms}.{{0,200}} {said}|(^| ){said}.{{0,200}}{title_terms}|(^| ){short}(v| v| |-| version )?{number}(-only|-or-later)?( |$)"
    titles = (f"{title}, version {version}", f"{title} v{version}", f"{short.upper()}v{version}", f"{short.upper()} v{version}", f"{short.upper()} version {version}", name, f"{name}-only", f"{name}-or-later")
    return License(name, must, never, titles, (
        f"This {subject} is free software; you can redistribute it and/or modify it under the terms of the {title} as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version.",
        f"This {subject} is free software: you can redistribute it and/or modify it under the terms of the {title} as published by the Free Software Foundation, version {version} of the License.",
        f"This {subject} is free software; you can redistribute it and/or modify it under the terms of the {title} as published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version. This {subject} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {title} for more details. You should have received a copy of the {title} along with this {subject}. If not, see http://www.gnu.org/licenses/.",
        f"{title} Version {version}, {date}",
        f"{title} Version {version}, {date} Copyright (C) Free Software Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
        f"{title} Version {version}",
    ), (short.upper(),))


def _family(name: str, short: str, title: str, others: str) -> License:
    """The notice that names no version."""
    return License(name, rf"{title.lower()}|(under|the) {short}( licen[cs]e)?( |$)", rf"{others}(version|(^| )v) ?[0-9]|(^| )v[0-9]|(^| ){short}(v| v| |-)[0-9]", (title,), (f"This program is free software; you can redistribute it and/or modify it under the terms of the {title} as published by the Free Software Foundation.",))


def _cc(code: str, words: str, version: str) -> License:
    number = version.replace(".", r"\.")
    name = f"CC-{code.upper()}-{version}"
    must = rf"creative commons {words} {number}( |$)|creative commons {words}( international| unported)?( public)? licen[cs]e( version)? {number}|(^| )cc {code} {number}( |$)|(^| )cc-{code}-{number}( |$)|creativecommons.org licenses {code} {number}( |$)"
    kind = "International" if version == "4.0" else "Unported"
    return License(name, must, "", (f"Creative Commons {words.title()} {version} {kind} License", name), (f"Licensed under CC {code.upper()} {version}.", f"This work is licensed under a Creative Commons {words.title()} {version} {kind} License.", f"Creative Commons {words.title()} {version} {kind} Public License"))


_OTHER_GNU = "lesser general public license|library general public license|affero general public license|"
_MIT_GRANT = "permission (is hereby )?granted free of charge to any person obtaining a copy of this software"
_MIT_TEXT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
_MIT_REST = ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD_GRANT = "redistribution and use in source and binary forms with or without modification are permitted"
_BSD_TEXT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TWO = " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAME = " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_AD = " All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization."
_BSD_REST = " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_NAMED = "neither the name|endorse or promote"
_ISC_GRANT = "permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted"
_ISC_TEXT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_REST = " THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_EXCEPT = "except as contained in this notice"

FALLBACK = "Proprietary"
#: Licences by their published notices, headers and texts: fixed values, in the order of their names.
LICENSES = (
    License("0BSD", rf"{_ISC_GRANT}|(^| )0bsd( |$)|zero-clause bsd|bsd zero-clause", "provided that the above copyright", ("BSD Zero-Clause License", "0BSD"), (f"{_ISC_TEXT}.", f"{_ISC_TEXT}.{_ISC_REST}")),
    _gnu("AGPL-3.0", "agpl", "GNU Affero General Public License", "3", "19 November 2007"),
    License("Apache-1.1", r"apache (software )?license (version |v)1\.1", "", ("Apache Software License, Version 1.1",)),
    License("Apache-2.0", r"apache (software )?license( version| v)? ?2(\.0)?( |$)|apache-2\.0|licenses license-2\.0", "", ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0"), ("Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION")),
    License("Artistic-2.0", r"artistic license (version )?2\.0|artistic-2\.0", "", ("Artistic License 2.0",), ("The Artistic License 2.0 Copyright (c) 2000-2006, The Perl Foundation. Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",)),
    License("BSD", rf"{_BSD_GRANT}|(^| )bsd licen[cs]e", rf"{_NAMED}|advertising materials|redistributions (of source code must retain|in binary form)|[0-9]-clause|(two|three|four|new|simplified|modified|zero)[ -](clause )?bsd|clause license|zero-clause", ("BSD License",), (_BSD_TEXT, "Redistribution and use in source and binary forms, with or without modification, are permitted.")),
    License("BSD-2-Clause", rf"{_BSD_GRANT}.{{0,200}}redistributions (of source code|in binary form)|(2-clause|simplified) bsd|bsd (2-clause|simplified)|bsd-2-clause", rf"{_NAMED}|advertising materials", ("BSD 2-Clause License", "Simplified BSD License", "BSD-2-Clause"), (_BSD_TEXT + _BSD_TWO, _BSD_TEXT + _BSD_TWO + _BSD_REST), over=("BSD",)),
    License("BSD-3-Clause", rf"{_BSD_GRANT}.{{0,900}}({_NAMED})|(3-clause|new|modified) bsd|bsd (3-clause|new)|bsd-3-clause", "advertising materials", ("BSD 3-Clause License", "New BSD License", "BSD-3-Clause"), (_BSD_TEXT + _BSD_TWO + " 3." + _BSD_NAME, _BSD_TEXT + _BSD_TWO + " 3." + _BSD_NAME + _BSD_REST), over=("BSD", "BSD-2-Clause")),
    License("BSD-4-Clause", rf"{_BSD_GRANT}.{{0,900}}advertising materials|(4-clause|original) bsd|bsd 4-clause|bsd-4-clause", "", ("BSD 4-Clause License", "BSD-4-Clause"), (_BSD_TEXT + _BSD_TWO + " 3." + _BSD_AD + " 4." + _BSD_NAME, _BSD_TEXT + _BSD_TWO + " 3." + _BSD_AD + " 4." + _BSD_NAME + _BSD_REST), over=("BSD", "BSD-2-Clause", "BSD-3-Clause")),
    License("BSL-1.0", r"boost software license|person or organization obtaining a copy of the software and accompanying documentation covered by this license|bsl-1\.0", "", ("Boost Software License, Version 1.0", "BSL-1.0"), ("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so")),
    *(_cc(code, words, version) for code, words in (("by", "attribution"), ("by-nc", "attribution-noncommercial"), ("by-nc-nd", "attribution-noncommercial-noderivatives"), ("by-nc-sa", "attribution-noncommercial-sharealike"), ("by-nd", "attribution-noderivatives"), ("by-sa", "attribution-sharealike")) for version in ("3.0", "4.0")),
    License("CC0-1.0", r"(^| )cc0( |$|-1\.0)|waived all copyright and related|publicdomain zero 1\.0", "", ("CC0 1.0 Universal Public Domain Dedication", "CC0-1.0"), ("To the extent possible under law, the author has waived all copyright and related rights to this work.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "Creative Commons Legal Code CC0 1.0 Universal")),
    License("CDDL-1.0", "common development and distribution license|(^| )cddl( |-|$)", r"version 1\.1|cddl-1\.1", ("Common Development and Distribution License, Version 1.0", "CDDL-1.0"), ("The contents of this file are subject to the terms of the Common Development and Distribution License (the License). You may not use this file except in compliance with the License.",)),
    License("EPL-1.0", r"eclipse public license.{0,60} (version |v ?)?1\.0( |$)|epl-1\.0|epl-v10", "", ("Eclipse Public License v1.0", "EPL-1.0"), ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",)),
    License("EPL-2.0", r"eclipse public license.{0,60} (version |v ?)?2\.0( |$)|epl-2\.0|epl-v20", "", ("Eclipse Public License v2.0", "EPL-2.0"), ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",)),
    License("EUPL-1.2", r"european union public licen[cs]e.{0,60}1\.2|eupl-1\.2|eupl (v|version )?1\.2", "", ("European Union Public Licence, Version 1.2", "EUPL-1.2"), ("Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission - subsequent versions of the EUPL (the Licence); You may not use this work except in compliance with the Licence.",)),
    _family("GPL", "gpl", "GNU General Public License", _OTHER_GNU),
    _gnu("GPL-1.0", "gpl", "GNU General Public License", "1", "February 1989", never=_OTHER_GNU[:-1]),
    _gnu("GPL-2.0", "gpl", "GNU General Public License", "2", "June 1991", never=_OTHER_GNU[:-1]),
    _gnu("GPL-3.0", "gpl", "GNU General Public License", "3", "29 June 2007", never=_OTHER_GNU[:-1]),
    License("ISC", rf"{_ISC_GRANT} provided that the above copyright notice|(^| )isc licen[cs]e", "", ("ISC License",), (f"{_ISC_TEXT}, provided that the above copyright notice and this permission notice appear in all copies.", f"{_ISC_TEXT}, provided that the above copyright notice and this permission notice appear in all copies.{_ISC_REST}")),
    _family("LGPL", "lgpl", "GNU Lesser General Public License", ""),
    _gnu("LGPL-2.0", "lgpl", "GNU Library General Public License", "2", "June 1991", "library"),
    _gnu("LGPL-2.1", "lgpl", "GNU Lesser General Public License", "2.1", "February 1999", "library"),
    _gnu("LGPL-3.0", "lgpl", "GNU Lesser General Public License", "3", "29 June 2007", "library"),
    License("MIT", rf"{_MIT_GRANT}|(^| )mit licen[cs]e|(under|the) mit( |$)", rf"{_EXCEPT}|to deal with the software|furnished to do so the software is provided", ("MIT License", "MIT"), ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software.", _MIT_TEXT + ", subject to the following conditions:", _MIT_TEXT + _MIT_REST)),
    License("MIT-0", "furnished to do so the software is provided|mit no attribution|(^| )mit-0( |$)", "", ("MIT No Attribution License", "MIT-0"), (_MIT_TEXT + "." + _MIT_REST[_MIT_REST.index(" THE SOFTWARE") :],), over=("MIT",)),
    License("MPL-1.1", r"mozilla public license.{0,60} (version |v ?)?1\.1( |$)|mpl-1\.1|(^| )mpl 1\.1( |$)", "", ("Mozilla Public License Version 1.1", "MPL-1.1"), ("The contents of this file are subject to the Mozilla Public License Version 1.1 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/",)),
    License("MPL-2.0", r"mozilla public license.{0,60} (version |v ?)?2\.0( |$)|mpl-2\.0|(^| )mpl 2\.0( |$)", "", ("Mozilla Public License, v. 2.0", "Mozilla Public License Version 2.0", "MPL-2.0"), ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.")),
    License("NCSA", "to deal with the software without restriction|illinois ncsa|(^| )ncsa( |$)", "", ("University of Illinois/NCSA Open Source License", "NCSA"), (_MIT_TEXT.replace("deal in", "deal with") + ", subject to the following conditions: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimers.",), over=("MIT", "BSD-2-Clause")),
    License("OFL-1.1", r"sil open font license|(^| )ofl-1\.1", "", ("SIL Open Font License, Version 1.1", "OFL-1.1"), ("This Font Software is licensed under the SIL Open Font License, Version 1.1. This license is copied below, and is also available with a FAQ at: http://scripts.sil.org/OFL",)),
    License(FALLBACK, "all rights reserved", "", (), ("All rights reserved.",)),
    License("PSF-2.0", r"python software foundation license|(^| )psf-2\.0", "", ("Python Software Foundation License Version 2", "PSF-2.0")),
    License("Unlicense", "free and unencumbered software released into the public domain|(^| )(the )?unlicense( |$)", "", ("Unlicense",), ("This is free and unencumbered software released into the public domain.", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.")),
    License("WTFPL", "do what the fuck you want to public license|(^| )wtfpl", "", ("Do What The Fuck You Want To Public License", "WTFPL"), ("DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO.",)),
    License("X11", rf"{_EXCEPT} the name of|(^| )x11 licen[cs]e", "", ("X11 License",), (_MIT_TEXT + _MIT_REST + " Except as contained in this notice, the name of the copyright holder shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the copyright holder.",), over=("MIT",)),
    License("Zlib", "altered source versions must be plainly marked|the origin of this software must not be misrepresented|(^| )zlib licen[cs]e", "", ("zlib License",), ("This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered from any source distribution.",)),
)
#: Stems of what notices, headers and licence texts say; a unit has one of them, in small letters.
ANCHORS = ("licen", "released", "permission", "redistribution", "reserved", "copyright", "publicdomain", "unencumbered", "commons", "warrant", "advertising", "endorse", "misrepresented", "altered")
SPDX = r"(?i)SPDX-License-Identifier:[\x20\t]*([^\r\n]*)"
EXPRESSION = r"[()]|[A-Za-z][A-Za-z0-9.+-]*"
NAMES = r"(?i)(^|/)(licen[cs]e|copying|notice)[^/]*$"
SEGMENT = r"\n|(?<=[.!?|])\x20"
#: Between blocks of adjacent lines: a line without terms of its own, as comment marks are.
BLOCK = r"\n[^a-z0-9\n]*\n"
TERM = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
LEAST = 0.6
MOSTLY = 0.5
_RUN = 2


def _weights(licenses: tuple[License, ...]) -> tuple[list[tuple[int, str, str, float, float]], float]:
    """(template, licence, term, weight of the unit vector, idf), and the idf of a term that no template has."""
    templates = [(x.name, t) for x in licenses for t in x.templates()]
    bags = [Counter(re.findall(TERM, text.lower())) for _, text in templates]
    df = Counter(t for bag in bags for t in bag)
    idf = {t: math.log((1 + len(bags)) / (1 + n)) + 1 for t, n in df.items()}
    rows = []
    for k, bag in enumerate(bags):
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in bag.items()))
        rows += [(k, templates[k][0], t, n * idf[t] / norm, idf[t]) for t, n in sorted(bag.items())]
    return rows, math.log(1 + len(bags)) + 1


def _inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table from one literal."""
    names = [x.split()[0] for x in schema.split(", ")]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    fields = ",".join(x.replace(" ", ":", 1) for x in schema.split(", "))
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{fields}>>")))


def _squares(terms: Column) -> Column:
    """The sum of the squared counts of an array's distinct elements."""
    zero = F.struct(F.lit("").alias("last"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("sum"))

    def step(acc, t):
        run = F.when(acc["last"] == t, acc["run"]).otherwise(F.lit(0).cast("long"))
        return F.struct(t.alias("last"), (run + 1).alias("run"), (acc["sum"] + 2 * run + 1).alias("sum"))

    return F.aggregate(F.array_sort(terms), zero, step, lambda acc: acc["sum"])


def _anchored(text: Column) -> Column:
    out = F.contains(text, F.lit(ANCHORS[0]))
    for stem in ANCHORS[1:]:
        out = out | F.contains(text, F.lit(stem))
    return out


def identities(terms: Column, licenses: tuple[License, ...] = LICENSES) -> Column:
    """The names of the licences that a unit can be, by its terms with spaces between them."""

    def fits(x: License) -> Column:
        must = F.rlike(terms, F.lit(x.must))
        return must & ~F.rlike(terms, F.lit(x.never)) if x.never else must

    return F.array_compact(F.array(*[F.when(fits(x), F.lit(x.name)) for x in licenses]))


def expression(tag: Column, licenses: tuple[License, ...] = LICENSES) -> Column:
    """The licence expression at the beginning of a text, with the names of licenses; null without any.

    Names and operators take turns; where they don't, the expression ends."""
    known = F.create_map(*[F.lit(v) for x in licenses for v in (x.name.lower(), x.name)])
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("turn"), F.lit(False).alias("end"), F.lit(0).alias("kept"))

    def is_operator(token):
        return F.lower(token).isin("and", "or", "with")

    def step(acc, token):
        side = token.isin("(", ")")
        end = acc["end"] | (~side & (is_operator(token) != (acc["turn"] % 2 == 1)))
        at = acc["at"] + 1
        return F.struct(at.alias("at"), (acc["turn"] + F.when(side | end, 0).otherwise(1)).alias("turn"), end.alias("end"), F.when(end | is_operator(token) | (token == "("), acc["kept"]).otherwise(at).alias("kept"))

    def named(token):
        plain = F.regexp_replace(F.lower(token), r"(-only|-or-later|\+)$", "")
        return F.when(is_operator(token), F.upper(token)).otherwise(F.coalesce(F.try_element_at(known, plain), token))

    def read(tokens):
        return F.transform(F.slice(tokens, F.lit(1), F.aggregate(tokens, zero, step)["kept"]), named)

    found = F.flatten(F.transform(F.array(F.regexp_extract_all(tag, F.lit(EXPRESSION), 0)), read))
    return F.nullif(F.regexp_replace(F.regexp_replace(F.array_join(found, " "), r"\(\x20", "("), r"\x20\)", ")"), F.lit(""))


def _runs(blocks: Column) -> Column:
    """Adjacent anchored blocks as one text, where there are several of them.

    The marks between blocks and between runs are characters that no term has."""
    whole = F.array_join(F.transform(blocks, lambda b: F.when(_anchored(b), F.concat(F.lit("\x02"), F.translate(b, "\x01\x02", "  "))).otherwise(F.lit("\x01"))), "")
    return F.filter(F.split(whole, "\x01"), lambda r: F.regexp_count(r, F.lit("\x02")) >= _RUN)


_UNITS = "array<struct<kind:int,words:int,squares:bigint,names:array<string>,terms:array<string>>>"


def _units(docs: DataFrame, path: Column, licenses: tuple[License, ...], doc_id: str, text: str) -> DataFrame:
    """key, doc_id, path, _size (terms of a text with units), spdx (its expression) and units (kind, words, squares, names, terms) of each row, as a table."""
    vocabulary = sorted({t for *_, t, _, _ in _weights(licenses)[0]})

    def units(low: Column) -> Column:
        """Of a text that's bound as a variable: made lower case and cut once."""

        def of(blocks: Column) -> Column:
            def each(kind: int, texts: Column) -> Column:
                return F.transform(texts, lambda u: F.struct(F.lit(kind).alias("kind"), u.alias("text")))

            some = F.filter(blocks, _anchored)
            lines = F.filter(F.flatten(F.transform(some, lambda b: F.split(b, SEGMENT))), _anchored)
            return F.concat(each(0, lines), each(1, some), each(2, _runs(blocks)))

        every = F.flatten(F.transform(F.array(F.split(low, BLOCK)), of))
        cut = F.transform(every, lambda u: F.struct(u["kind"].alias("kind"), F.regexp_extract_all(u["text"], F.lit(TERM), 0).alias("terms")))
        named = F.filter(F.transform(cut, lambda u: F.struct(u["kind"].alias("kind"), u["terms"].alias("terms"), identities(F.array_join(u["terms"], " "), licenses).alias("names"))), lambda u: F.size(u["names"]) > 0)
        return F.transform(named, lambda u: F.struct(u["kind"].alias("kind"), F.size(u["terms"]).alias("words"), _squares(u["terms"]).alias("squares"), u["names"].alias("names"), F.filter(u["terms"], lambda t: t.isin(vocabulary)).alias("terms")))

    def described(low: Column) -> Column:
        none = F.struct(F.lit(0).alias("size"), F.array().cast(_UNITS).alias("units"), F.lit(False).alias("tag"))
        some = F.struct(F.regexp_count(low, F.lit(TERM)).alias("size"), units(low).alias("units"), F.contains(low, F.lit("spdx-license-identifier:")).alias("tag"))
        return F.when(_anchored(low), some).otherwise(none)

    whole = F.coalesce(F.col(text), F.lit(""))
    x = F.get(F.transform(F.array(F.lower(whole)), described), F.lit(0))
    rows = docs.select(F.col(doc_id).alias("doc_id"), path.alias("path"), whole.alias("whole"), x.alias("x"))
    rows = rows.withColumn("tag", F.when(F.col("x.tag"), F.regexp_extract("whole", SPDX, 1)))
    rows = rows.withColumn("spdx", F.when(F.col("tag").isNotNull(), F.struct(expression(F.col("tag"), licenses).alias("license"), (F.regexp_count(F.lower("tag"), F.lit(TERM)) + 1).alias("words"))))
    return written(rows.select(F.monotonically_increasing_id().alias("key"), "doc_id", "path", F.col("x.size").alias("_size"), F.when(F.col("spdx.license").isNotNull(), F.col("spdx")).alias("spdx"), F.col("x.units").alias("units")))


def headers(units: DataFrame, licenses: tuple[License, ...] = LICENSES, least: float = LEAST) -> DataFrame:
    """key, seg, kind, license, score and words of each unit that resembles a template of a licence that it can be, from rows (key, units)."""
    postings, unknown = _weights(licenses)
    spark = units.sparkSession
    own = ["key", "seg", "kind", "words", "squares", "names"]
    lines = units.where(F.size("units") > 0).select("key", F.posexplode("units").alias("seg", "u")).select("key", "seg", "u.*")
    terms = lines.select(*own, F.explode("terms").alias("term")).groupBy(*own, "term").agg(F.count("*").alias("tf"))
    vocabulary = _inline(spark, sorted({(t, i) for *_, t, _, i in postings}), "term string, idf double")
    weights = _inline(spark, [(k, name, t, w) for k, name, t, w, _ in postings], "template int, license string, term string, w double")
    valued = written(terms.join(F.broadcast(vocabulary), "term").withColumn("v", F.col("tf") * F.col("idf")))
    rest = (F.col("squares") - F.sum(F.col("tf") * F.col("tf"))) * F.lit(unknown * unknown)
    norms = valued.groupBy("key", "seg", "kind", "words", "squares").agg(F.sqrt(F.sum(F.col("v") * F.col("v")) + rest).alias("norm")).drop("squares")
    can = F.array_contains(F.col("names"), F.col("license"))
    dots = valued.join(F.broadcast(weights), "term").where(can).groupBy("key", "seg", "template", "license").agg(F.sum(F.col("v") * F.col("w")).alias("dot"))
    close = dots.join(norms, ["key", "seg"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("score") >= least)
    best = F.min(F.struct((F.col("license") == FALLBACK).alias("last"), (-F.col("score")).alias("low"), "license", "words"))
    return close.groupBy("key", "seg", "kind").agg(best.alias("best")).select("key", "seg", "kind", F.col("best.license").alias("license"), (-F.col("best.low")).alias("score"), F.col("best.words").alias("words"))


def _parent(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), F.regexp_replace(path, r"/[^/]*$", "")).when(path.isNotNull(), F.lit(""))


def scanned(docs: DataFrame, path: Column, licenses: tuple[License, ...] = LICENSES, least: float = LEAST, mostly: float = MOSTLY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, path, license, origin ("own", "inherited" or null), score and licensed_by, the directory it comes from."""
    units = _units(docs, path, licenses, doc_id, text)
    tags = units.where("spdx is not null").select("key", F.lit(3).alias("kind"), "spdx.license", F.lit(1.0).alias("score"), "spdx.words")
    each = headers(units, licenses, least).drop("seg").unionByName(tags)
    order = F.when(F.col("kind") == 3, 0).when(F.col("license") == FALLBACK, 2).otherwise(1)
    # one row a licence, so what a row of the next step gathers is bounded by the licences
    words = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("words"))), F.lit(0)).alias(f"w{k}") for k in range(4)]
    per = each.groupBy("key", "license").agg(F.min(F.struct(order.alias("order"), (-F.col("score")).alias("low"), F.col("license").alias("name"))).alias("found"), *words)
    less = F.create_map(*[x for one in licenses if one.over for x in (F.lit(one.name), F.array(*[F.lit(n) for n in one.over]))])
    exact = F.filter("all", lambda x: (x["order"] == 0) | ~F.exists("all", lambda y: F.coalesce(F.array_contains(F.try_element_at(less, y["name"]), x["name"]), F.lit(False))))
    own = per.groupBy("key").agg(F.collect_list("found").alias("all"), F.greatest(*[F.sum(f"w{k}") for k in range(4)]).alias("covered"))
    own = own.withColumn("best", F.array_min(exact)).select("key", F.col("best.name").alias("_license"), (-F.col("best.low")).alias("_score"), "covered")
    files = written(units.select("key", "doc_id", "path", "_size").withColumn("_dir", _parent(F.col("path"))).join(own, "key", "left"))
    rules = files.where(F.col("_license").isNotNull() & (F.rlike("path", F.lit(NAMES)) | (F.col("covered") >= F.col("_size") * mostly))).groupBy("_dir").agg(F.min(F.struct((-F.col("_score")).alias("low"), F.col("_license").alias("license"))).alias("rule")).where("_dir is not null")
    steps = F.split(F.col("_dir"), "/")
    above = files.select("_dir").where("_dir is not null").distinct()
    above = above.select(F.col("_dir").alias("of"), F.explode(F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/")))).alias("_dir")).distinct()
    nearest = above.join(rules, "_dir").groupBy("of").agg(F.max(F.struct(F.length("_dir").alias("deep"), F.col("_dir").alias("by"), F.col("rule.license").alias("license"))).alias("near"))
    near = nearest.select(F.col("of").alias("_dir"), "near")
    # a directory may hold most files: such ones meet their licence by a bounded broadcast
    found = skewed_join(files, near, ["_dir"]).select(*files.columns, "near").unionByName(files.join(near.select("_dir"), "_dir", "left_anti").select(*files.columns, F.lit(None).cast(near.schema["near"].dataType).alias("near")))
    mine = F.col("_license").isNotNull()
    return found.select(
        "doc_id",
        "path",
        F.coalesce("_license", "near.license").alias("license"),
        F.when(mine, "own").when(F.col("near").isNotNull(), "inherited").alias("origin"),
        F.col("_score").alias("score"),
        F.when(~mine, F.col("near.by")).alias("licensed_by"),
    )


def document_path() -> Column:
    """Documents as files of one tree: source/language/document."""
    return F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))


def _sql() -> str:
    postings, unknown = _weights(LICENSES)
    q = lambda s: "'" + s.replace("'", "''") + "'"
    weights = ", ".join(f"({k}, {q(n)}, {q(t)}, {w!r}::DOUBLE)" for k, n, t, w, _ in postings)
    idf = ", ".join(f"({q(t)}, {i!r}::DOUBLE)" for t, i in sorted({(t, i) for *_, t, _, i in postings}))
    names = " UNION ALL ".join(f"SELECT seg, {q(x.name)} AS license FROM joined WHERE regexp_matches(j, {q(x.must)})" + (f" AND NOT regexp_matches(j, {q(x.never)})" if x.never else "") for x in LICENSES)
    over = ", ".join(f"({q(x.name)}, {q(n)})" for x in LICENSES for n in x.over)
    anchored = lambda c: "(" + " OR ".join(f"contains({c}, '{a}')" for a in ANCHORS) + ")"
    known = "MAP {" + ", ".join(f"{q(x.name.lower())}: {q(x.name)}" for x in LICENSES) + "}"
    return f"""
WITH w(template, license, term, w) AS (VALUES {weights}), idf(term, idf) AS (VALUES {idf}),
d AS (SELECT row_number() OVER () AS key, doc_id, coalesce(text, '') AS whole, lower(coalesce(text, '')) AS t, coalesce(source, '-') || '/' || coalesce(lang, '-') AS dir, coalesce(doc_id::VARCHAR, '-') AS name FROM documents),
parts AS (SELECT key, generate_subscripts(b, 1) AS n, unnest(b) AS part FROM (SELECT key, string_split_regex(t, '\\n[^a-z0-9\\n]*\\n') AS b FROM d WHERE {anchored('t')})),
anchored AS (SELECT *, n - row_number() OVER (PARTITION BY key ORDER BY n) AS run FROM parts WHERE {anchored('part')}),
runs AS (SELECT key, string_agg(part, chr(10) || chr(10) ORDER BY n) AS part FROM anchored GROUP BY key, run HAVING count(*) >= {_RUN}),
lines AS (SELECT key, 0 AS kind, unnest(string_split_regex(regexp_replace(part, '([.!?|]) ', '\\1' || chr(10), 'g'), chr(10))) AS line FROM anchored
  UNION ALL SELECT key, 1, part FROM anchored UNION ALL SELECT key, 2, part FROM runs),
num AS (SELECT key, kind, row_number() OVER () AS seg, regexp_extract_all(line, '{TERM}') AS terms FROM lines WHERE {anchored('line')}),
joined AS (SELECT seg, array_to_string(terms, ' ') AS j FROM num),
named AS ({names}),
held AS (SELECT * FROM num WHERE seg IN (SELECT seg FROM named)),
counts AS (SELECT key, kind, seg, term, count(*) AS tf FROM (SELECT key, kind, seg, unnest(terms) AS term FROM held) GROUP BY ALL),
val AS (SELECT key, kind, seg, counts.term, tf, tf * coalesce(idf, {unknown!r}::DOUBLE) AS v FROM counts LEFT JOIN idf ON counts.term = idf.term),
norms AS (SELECT seg, sqrt(sum(v * v)) AS norm, sum(tf) AS words FROM val GROUP BY seg),
dots AS (SELECT key, kind, val.seg, template, w.license, sum(v * w) AS dot FROM val JOIN w ON val.term = w.term JOIN named ON named.seg = val.seg AND named.license = w.license GROUP BY ALL),
sc AS (SELECT key, kind, dots.seg, license, words, round(dot / norm, 6) AS score FROM dots JOIN norms ON dots.seg = norms.seg WHERE round(dot / norm, 6) >= {LEAST}),
seg AS (SELECT key, kind, license, words, score FROM sc QUALIFY row_number() OVER (PARTITION BY seg ORDER BY license = '{FALLBACK}', score DESC, license) = 1),
tagged AS (SELECT key, regexp_extract(whole, {q(SPDX)}, 1) AS tag FROM d WHERE contains(t, 'spdx-license-identifier:')),
tokens AS (SELECT key, tag, generate_subscripts(k, 1) AS n, unnest(k) AS token FROM (SELECT key, tag, regexp_extract_all(tag, {q(EXPRESSION)}) AS k FROM tagged)),
turns AS (SELECT *, lower(token) IN ('and', 'or', 'with') AS op, token IN ('(', ')') AS side, count(*) FILTER (token NOT IN ('(', ')')) OVER (PARTITION BY key ORDER BY n) AS turn FROM tokens),
good AS (SELECT *, coalesce(min(n) FILTER (NOT side AND op <> (turn % 2 = 0)) OVER (PARTITION BY key), 1000000000) AS stop FROM turns),
ends AS (SELECT *, max(n) FILTER (n < stop AND NOT op AND token <> '(') OVER (PARTITION BY key) AS last FROM good),
spdx AS (SELECT key, 3 AS kind, replace(replace(string_agg(CASE WHEN op THEN upper(token) ELSE coalesce({known}[regexp_replace(lower(token), '(-only|-or-later|\\+)$', '')], token) END, ' ' ORDER BY n), '( ', '('), ' )', ')') AS license,
  len(regexp_extract_all(lower(any_value(tag)), '{TERM}')) + 1 AS words, 1.0::DOUBLE AS score FROM ends WHERE n <= last GROUP BY key),
found AS (SELECT * FROM seg UNION ALL BY NAME SELECT * FROM spdx),
beside AS (SELECT DISTINCT key, less FROM found JOIN (VALUES {over}) o(exact, less) ON license = exact),
covers AS (SELECT key, greatest({", ".join(f"sum(words) FILTER (kind = {k})" for k in range(4))}) AS covered FROM found GROUP BY key),
own AS (SELECT found.key, license, score, covered FROM found JOIN covers ON covers.key = found.key WHERE kind = 3 OR NOT EXISTS (SELECT 1 FROM beside b WHERE b.key = found.key AND b.less = license)
  QUALIFY row_number() OVER (PARTITION BY found.key ORDER BY CASE WHEN kind = 3 THEN 0 WHEN license = '{FALLBACK}' THEN 2 ELSE 1 END, score DESC, license) = 1),
files AS (SELECT d.doc_id, dir, dir || '/' || name AS path, len(regexp_extract_all(t, '{TERM}')) AS size, license, score, covered FROM d LEFT JOIN own ON d.key = own.key),
rules AS (SELECT dir, license FROM files WHERE license IS NOT NULL AND covered >= size * {MOSTLY} QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1),
near AS (SELECT f.dir, r.license, r.dir AS by_dir FROM (SELECT DISTINCT dir FROM files) f JOIN rules r ON f.dir = r.dir OR starts_with(f.dir, r.dir || '/') QUALIFY row_number() OVER (PARTITION BY f.dir ORDER BY length(r.dir) DESC) = 1)
SELECT files.doc_id, path, coalesce(files.license, near.license) AS license,
       CASE WHEN files.license IS NOT NULL THEN 'own' WHEN near.license IS NOT NULL THEN 'inherited' END AS origin,
       score, CASE WHEN files.license IS NULL THEN by_dir END AS licensed_by
FROM files LEFT JOIN near ON files.dir = near.dir
"""


OP7_SQL = _sql()
