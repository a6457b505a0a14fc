"""License scans: the right name for published headers and texts, expressions, inheritance."""

from collections import Counter

from pyspark.sql import functions as F

from halyard.llm import licenses

from .conftest import odd_rows

def scan(spark, cases):
    rows = [(k, f"d{k}/x", t) for k, (_, t) in enumerate(cases)]
    return {r.doc_id: r.license for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, path string, text string"), F.col("path")).collect()}


def test_licences_come_from_the_nearest_directory(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    body = "Some words of a file that say nothing of the sort at all. " * 3
    rows = [
        (1, "a/LICENSE", mit + " " + body), (2, "a/x.txt", body), (3, "a/b/y.txt", body), (4, "a/b/c/COPYING", gpl), (5, "a/b/c/z.txt", body), (6, "a/b/c/d/e.txt", body + "\nLicensed under CC BY-NC 4.0.\n" + body),
        (7, "q/x.txt", body), (8, None, body), (9, None, gpl), (10, "a/b/y.txt", None), (11, "LICENSE", ""), (12, "ab/x.txt", body),
    ]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.license, r.origin, r.licensed_by) for r in licenses.scanned(df, F.col("path")).collect()}
    assert got == {
        1: ("MIT", "own", None), 2: ("MIT", "inherited", "a"), 3: ("MIT", "inherited", "a"), 4: ("GPL-3.0", "own", None), 5: ("GPL-3.0", "inherited", "a/b/c"), 6: ("CC-BY-NC-4.0", "own", None),
        7: (None, None, None), 8: (None, None, None), 9: ("GPL-3.0", "own", None), 10: ("MIT", "inherited", "a"), 11: (None, None, None), 12: (None, None, None),
    }


def test_each_row_is_scanned_for_itself(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    body = " ".join(f"word{k}" for k in range(12))
    rows = [(1, "a/x", mit), (1, "b/x", gpl), (None, "c/x", mit), (None, "d/x", gpl), *[(5, "e/f/x", f"{mit}\n{body}")] * 4, (6, "e/f/y", body)]
    got = Counter((r.doc_id, r.path, r.license, r.score, r.origin) for r in licenses.scanned(spark.createDataFrame(rows, "doc_id long, path string, text string").repartition(3), F.col("path")).collect())
    assert got == Counter([(1, "a/x", "MIT", 1.0, "own"), (1, "b/x", "GPL-3.0", 1.0, "own"), (None, "c/x", "MIT", 1.0, "own"), (None, "d/x", "GPL-3.0", 1.0, "own"), *[(5, "e/f/x", "MIT", 1.0, "own")] * 4, (6, "e/f/y", None, None, None)])


def test_wrapped_headers_tags_and_reworded_notices(spark):
    cases = [
        ("GPL-3.0", " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n *\n * More words that follow."),
        ("MPL-2.0", "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy of the MPL was not distributed with this\n# file, You can obtain one at http://mozilla.org/MPL/2.0/.\n\nimport x"),
        ("MIT", "// SPDX-License-Identifier: MIT\nint main() {}"), ("Apache-2.0", "# SPDX-License-Identifier: Apache-2.0"),
        ("MIT", "Permission granted, free of charge, to any person obtaining a copy of this software."), (None, "The terms of this work and the version of the public form of it."),
    ]
    got = {r.doc_id: r.license for r in licenses.scanned(spark.createDataFrame([(k, f"d{k}/x", t) for k, (_, t) in enumerate(cases)], "doc_id long, path string, text string"), F.col("path")).collect()}
    assert got == {k: name for k, (name, _) in enumerate(cases)}


MIT_BODY = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so"""
MIT_END = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
MIT = f"""Copyright (c) 2021 Someone

{MIT_BODY}, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

{MIT_END}
"""
BSD = """Copyright (c) 2020, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD_NAME = """
{n}. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
BSD_AD = """
3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement: This product includes software
   developed by the organization.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.
"""
ISC = """Copyright (c) 2019 Someone

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted{}.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE.
"""


def gnu(title, version, subject="program", later=True, mark=" * "):
    end = ", or\n(at your option) any later version." if later else "."
    text = f"This {subject} is free software; you can redistribute it and/or\nmodify it under the terms of the {title}\nas published by the Free Software Foundation; {'either ' if later else ''}version {version}\nof the License{end}\n\nThis {subject} is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n{title} for more details.\n\nYou should have received a copy of the {title}\nalong with this {subject}; if not, write to the Free Software\nFoundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA  02110-1301  USA"
    return "/*\n" + "\n".join(mark + x for x in text.split("\n")) + "\n */\n#include <stdio.h>\nint main(void) { return 0; }\n"


GPL, LGPL, AGPL = "GNU General Public License", "GNU Lesser General Public License", "GNU Affero General Public License"
#: Headers and texts as they are published and wrapped, with code around.
PUBLISHED = [
    ("GPL-1.0", gnu(GPL, "1")), ("GPL-2.0", gnu(GPL, "2")), ("GPL-2.0", gnu(GPL, "2", later=False)), ("GPL-3.0", gnu(GPL, "3", mark="# ")), ("GPL-3.0", gnu(GPL, "3", later=False)),
    ("LGPL-2.0", gnu("GNU Library General Public License", "2", "library")), ("LGPL-2.1", gnu(LGPL, "2.1", "library")), ("LGPL-3.0", gnu(LGPL, "3", "library")), ("LGPL-3.0", gnu(LGPL, "3")),
    ("AGPL-3.0", gnu(AGPL, "3", mark="")), ("GPL-2.0", "Licensed under GPLv2."), ("GPL-3.0", "Licensed under the GPL-3.0-or-later."), ("LGPL-2.1", "Released under the LGPL v2.1."), ("GPL", "This work is licensed under the GNU General Public License."),
    ("GPL-2.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989, 1991 Free Software Foundation, Inc.,\n 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n\n                            Preamble\n\n  The licenses for most software are designed to take away your\nfreedom to share and change it."),
    ("GPL-3.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <http://fsf.org/>\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n\n                            Preamble\n\n  The GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works."),
    ("LGPL-3.0", "                   GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <http://fsf.org/>\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n\n\n  This version of the GNU Lesser General Public License incorporates\nthe terms and conditions of version 3 of the GNU General Public\nLicense, supplemented by the additional permissions listed below."),
    ("MIT", MIT), ("MIT", "The MIT License (MIT)\n\n" + MIT), ("MIT-0", f"Copyright 2021\n\n{MIT_BODY}.\n\n{MIT_END}"), ("X11", MIT + "\nExcept as contained in this notice, the name of the copyright holder shall not be\nused in advertising or otherwise to promote the sale, use or other dealings in\nthis Software without prior written authorization from the copyright holder.\n"),
    ("NCSA", MIT_BODY.replace("to deal\nin the", "to deal with\nthe") + ", subject to the following conditions:\n\n  * Redistributions of source code must retain the above copyright notice,\n    this list of conditions and the following disclaimers.\n"),
    ("BSD-2-Clause", BSD + BSD_END), ("BSD-3-Clause", BSD + BSD_NAME.format(n=3) + BSD_END), ("BSD-4-Clause", BSD + BSD_AD + BSD_NAME.format(n=4) + BSD_END), ("BSD-2-Clause", BSD.replace("\n\n", "\n") + BSD_END), ("BSD-3-Clause", (BSD + BSD_NAME.format(n=3)).replace("\n\n", "\n")),
    ("BSD", "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"), ("BSD-3-Clause", "Released under the 3-Clause BSD License."),
    ("ISC", ISC.format(", provided that the above\ncopyright notice and this permission notice appear in all copies")), ("0BSD", ISC.format("")), ("ISC", "Released under the ISC License."),
    ("Apache-2.0", "# Copyright 2020 Someone\n#\n# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.\n# You may obtain a copy of the License at\n#\n#     http://www.apache.org/licenses/LICENSE-2.0\n#\n# Unless required by applicable law or agreed to in writing, software\n# distributed under the License is distributed on an \"AS IS\" BASIS,\n# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n# See the License for the specific language governing permissions and\n# limitations under the License.\nimport os\n"),
    ("Apache-1.1", "Licensed under the Apache Software License, Version 1.1."), ("MPL-2.0", "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at http://mozilla.org/MPL/2.0/. */\nint x;"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1\n(the \"License\"); you may not use this file except in compliance with the\nLicense. You may obtain a copy of the License at http://www.mozilla.org/MPL/"),
    ("EPL-1.0", "All rights reserved. This program and the accompanying materials\nare made available under the terms of the Eclipse Public License v1.0\nwhich accompanies this distribution, and is available at\nhttp://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0", "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("BSL-1.0", "// Distributed under the Boost Software License, Version 1.0.\n// (See accompanying file LICENSE_1_0.txt or copy at\n//  http://www.boost.org/LICENSE_1_0.txt)"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."), ("CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."), ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright\nand related or neighboring rights to this work."), ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or\ndistribute this software, either in source code form or as a compiled\nbinary, for any purpose, commercial or non-commercial, and by any\nmeans."),
    ("Zlib", "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable for any damages\narising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not\n   claim that you wrote the original software.\n2. Altered source versions must be plainly marked as such, and must not be\n   misrepresented as being the original software."),
    ("WTFPL", "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE"), ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1.\nThis license is copied below, and is also available with a FAQ at:\nhttp://scripts.sil.org/OFL"),
    ("EUPL-1.2", "Licensed under the European Union Public Licence, Version 1.2."), ("CDDL-1.0", "The contents of this file are subject to the terms of the\nCommon Development and Distribution License (the \"License\").\nYou may not use this file except in compliance with the License."), ("Artistic-2.0", "Released under the Artistic License 2.0."), ("PSF-2.0", "Licensed under the Python Software Foundation License Version 2."),
    ("Proprietary", "Copyright 2020 Someone. All rights reserved."), ("Proprietary", "All rights\nreserved."),
    (None, "The licence of this work and the version of the public form of it."), (None, "You need a license to drive. The GNU is an animal."), (None, "We deal with permission slips and reserved seats under clause 3."),
]


TAGS = [
    ("MIT", "MIT"), ("Apache-2.0 OR MIT", "Apache-2.0 OR MIT"), ("GPL-2.0-only", "GPL-2.0"), ("gpl-3.0-or-later", "GPL-3.0"), ("LGPL-2.1+", "LGPL-2.1"), ("(mit or Apache-2.0) and BSD-3-Clause */", "(MIT OR Apache-2.0) AND BSD-3-Clause"),
    ("GPL-2.0-only WITH Classpath-exception-2.0", "GPL-2.0 WITH Classpath-exception-2.0"), ("MIT This file is free", "MIT"), ("MIT OR", "MIT"), ("-->", None), ("", None), ("LicenseRef-Own", "LicenseRef-Own"), ("or MIT", None),
]


TAGGED = [case for tag, want in TAGS for text in [f"# SPDX-License-Identifier: {tag}\ncode here\n"] for case in ((want, text), (want or "ISC", "Released under the ISC License.\n" + text))]
TEMPLATES = [(x.name, t) for x in licenses.LICENSES for t in x.templates()]
LONG = "SPDX-License-Identifier: MIT" + " OR ISC" * 20_000


def test_published_headers_templates_and_tags_have_their_own_names(spark):
    cases = [*PUBLISHED, *TEMPLATES, *TAGGED]
    got = scan(spark, [*cases, (None, LONG)])
    assert got.pop(len(cases)).startswith("MIT OR ISC OR")
    assert {k: (got[k], want, t) for k, (want, t) in enumerate(cases) if got[k] != want} == {}
    assert len({name for name, _ in PUBLISHED}) > 38


def test_licences_on_odd_tables(odd, none):
    assert licenses.scanned(odd, licenses.document_path()).count() == len(odd_rows())
    assert licenses.scanned(none, licenses.document_path()).count() == 0


