from layerkit.llm import license_rules as lr

from .small import ODD_ROWS, empty, odd

MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files, to deal in the Software.
The above copyright notice and this permission notice shall be included in all
copies. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND. IN NO EVENT SHALL THE
authors be liable."""
GPL = """This program is distributed in the hope that it will be useful. See the GNU General Public License for more details."""


def scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r for r in sorted(lr.scan(df, ["doc_id"]).collect(), key=lambda r: r["doc_id"])]


def test_notices(spark):
    got = scan(spark, [
        MIT, "Licensed under the Apache License, Version 2.0.", "Text.\nReleased under the MIT License.\nLicensed under CC BY-NC 4.0.",
        "This work is licensed under the GNU General Public License, version 3.", "# SPDX-License-Identifier: MIT", GPL,
        "All about driving licences and nothing else.", "Copyright 2020 X. All rights reserved.", "Licensed under CC BY 4.0. Licensed under CC BY 4.0."])
    assert [r["licenses"] for r in got] == [["MIT"], ["Apache-2.0"], ["CC-BY-NC-4.0", "MIT"], ["GPL-3.0"], ["MIT"], [], [], ["Proprietary"], ["CC-BY-4.0"]]
    assert got[0]["sentence_ids"] == ["copyright", "mit-grant", "mit-notice", "as-is", "no-liability"] and got[0]["n_unmatched"] == 1
    assert got[5]["n_unmatched"] == 2 and got[6]["n_unknown"] == 1 and got[8]["n_unmatched"] == 0


def test_longer_notices_come_first(spark):
    bsd3 = ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "as-is", "no-liability"]
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(bsd3,), (bsd3[:3],), (["gpl-3", "gpl-hope"],), ([],)], "ids array<string>")
    got = [r["m"] for r in rows.select(lr.match_rules(F.col("ids")).alias("m")).collect()]
    assert [m["found"] for m in got] == [["BSD-3-Clause"], ["BSD-2-Clause"], ["GPL-3.0"], []]
    assert [m["left"] for m in got] == ["", "", "<gpl-hope>", ""]


def test_odd_rows(spark):
    got = lr.scan(odd(spark), ["doc_id"]).collect()
    assert len(got) == len(ODD_ROWS) and all(r["licenses"] == [] and r["n_unknown"] == 0 for r in got)
    assert lr.scan(empty(spark), ["doc_id"]).count() == 0


def test_no_sentence_is_passed_over(spark):
    """One text for each pattern, holding nothing else."""
    texts = {
        "apache-2": "Licensed under the Apache License, Version 2.0",
        "apache-compliance": "You may not use this file except in compliance with the License", "apache-obtain": "You may obtain a copy of the License at",
        "apache-as-is": "Unless required by applicable\nlaw or agreed to in writing", "apache-see": "See the License for the specific language governing permissions",
        "lgpl-3": "GNU Lesser General Public License v3", "lgpl-2": "GNU Library General Public Licence, version 2", "agpl-3": "GNU Affero General Public License",
        "gpl-3-or-later": "GNU General Public License version 3, or (at your option) any later version",
        "gpl-2-or-later": "GNU General Public License version 2, or (at your option) any later version",
        "gpl-3": "GNU General Public License v3", "gpl-2": "GNU General Public License v2", "gpl-hope": "distributed in the HOPE that it will be useful",
        "gpl-received": "You should have received a copy of the GNU", "gpl-see": "See the GNU General Public License for more details",
        "cc-by-nc-sa-4": "CC BY-NC-SA 4.0", "cc-by-nc-nd-4": "Attribution-NonCommercial-NoDerivatives 4.0", "cc-by-nc-4": "CC BY-NC 4.0", "cc-by-nd-4": "CC BY-ND 4.0",
        "cc-by-sa-4": "CC_BY_SA 4.0", "cc-by-sa-3": "Attribution-ShareAlike 3.0", "cc-by-4": "Creative Commons Attribution 4.0", "cc0": "Released under CC0.",
        "mit": "released under the MIT licence", "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy",
        "mit-notice": "The above copyright notice and this permission notice shall be included", "as-is": 'THE SOFTWARE IS PROVIDED "AS IS"',
        "no-liability": "IN NO EVENT SHALL THE AUTHORS", "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose",
        "isc": "Distributed under the ISC License.",
        "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "bsd-source": "Redistributions of source code must retain the above copyright notice",
        "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice",
        "bsd-endorse": "Neither the name of X may be used to endorse or promote", "bsd-3": "licensed under the BSD 3-Clause License",
        "bsd-2": "Simplified BSD License", "mpl-2": "Mozilla Public License, version 2.0", "epl-2": "Eclipse Public License - v 2.0",
        "bsl-1": "Boost Software License", "zlib": "zlib/libpng license", "artistic-2": "Artistic License 2.0",
        "unlicense": "free and unencumbered software released into the public\ndomain", "copyright": "Copyright X", "all-rights": "All  rights  reserved.",
    }
    assert list(texts) == [name for name, _ in lr.SENTENCES]
    got = scan(spark, [*texts.values(), "sha 4acc0f19 and cc0ffee", "Creative Commons Zero"])
    assert [r["sentence_ids"] for r in got] == [*([name] for name in texts), [], ["cc0"]]
    assert [r["licenses"] for r in got][list(texts).index("cc-by-sa-4")] == ["CC-BY-SA-4.0"]


def gnu(name, version):
    return f"""This program is free software; you can redistribute it and/or modify
it under the terms of the {name} as published by
the Free Software Foundation; either version {version} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
{name} for more details.

You should have received a copy of the {name}
along with this program; if not, see <https://www.gnu.org/licenses/>."""


LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details.

You should have received a copy of the GNU Lesser General Public
License along with this library; if not, write to the Free Software
Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA  02110-1301  USA"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
"AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DAMAGES."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_standard_notices_plain_and_in_comments(spark):
    notices = {
        "GPL-2.0-or-later": gnu("GNU General Public License", 2), "GPL-3.0-or-later": gnu("GNU General Public License", 3), "LGPL-2.1": LGPL,
        "BSD-3-Clause": BSD, "Apache-2.0": APACHE}
    texts, want = [], []
    for name, notice in notices.items():
        for prefix, before, after in [("", "", ""), ("# ", "", ""), ("// ", "", ""), ("-- ", "", ""), (" * ", "/*\n", "\n */")]:
            body = "\n".join((prefix + line).rstrip() for line in notice.split("\n"))
            texts.append(f"{before}{body}{after}\nx = 1;\n")
            want.append((name, [name], 0))
    got = scan(spark, texts)
    assert [(n, r["licenses"], r["n_unmatched"]) for (n, _, _), r in zip(want, got)] == want


def test_sentences_stay_apart(spark):
    got = scan(spark, ["Code is released under the MIT License; documentation is CC BY 4.0.", "* released under the MIT License\n* cc by 4.0",
                       "# SPDX-License-Identifier: MIT\n# Copyright 2020 X\n# All rights reserved.", "licensed under the Apache License; version 2"])
    assert [r["licenses"] for r in got] == [["CC-BY-4.0", "MIT"], ["CC-BY-4.0", "MIT"], ["MIT", "Proprietary"], ["Apache-2.0"]]


def test_spdx_lines(spark):
    lines = {
        "SPDX-License-Identifier: GPL-2.0-or-later": ["GPL-2.0-or-later"], "SPDX-License-Identifier: GPL-2.0-only": ["GPL-2.0-only"], "SPDX-License-Identifier: GPL-2.0": ["GPL-2.0"],
        "// SPDX-License-Identifier: LGPL-2.1": ["LGPL-2.1"], "# SPDX-License-Identifier: AGPL-3.0-only": ["AGPL-3.0-only"], "/* SPDX-License-Identifier: ISC */": ["ISC"],
        "SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause": ["Apache-2.0", "BSD-3-Clause", "MIT"], "spdx-license-identifier: gpl-3.0+": ["GPL-3.0+"],
        "SPDX-License-Identifier: LicenseRef-Own": [], "-- SPDX-License-Identifier: CC-BY-ND-4.0": ["CC-BY-ND-4.0"],
    }
    got = scan(spark, list(lines))
    assert [r["licenses"] for r in got] == list(lines.values())
    assert [r["n_unknown"] for r in got] == [int(not x) for x in lines.values()]
    assert all(len(scan(spark, [f"SPDX-License-Identifier: {n}" for n in lr.SPDX])[i]["licenses"]) == 1 for i in (0, 5, -1))


def test_names_in_prose(spark):
    texts = {"Code: BSD-3-Clause.": "BSD-3-Clause", "under the LGPLv2.1": "LGPL-2.1", "Licensed under the AGPL v3 or so": "AGPL-3.0", "GPLv3 code": "GPL-3.0",
             "available under the ISC licence": "ISC", "Apache License 2.0": "Apache-2.0", "All rights are mine; the GNU General Public License,\nversion 2, holds": "GPL-2.0"}
    assert [r["licenses"] for r in scan(spark, list(texts))] == [[x] for x in texts.values()]


def test_a_long_text(spark):
    lines = ["some words of no meaning at all"] * 40_000 + ["Licensed under CC BY 4.0."] + ["and so on"] * 40_000
    assert [r["licenses"] for r in scan(spark, ["\n".join(lines), " ".join(lines)])] == [["CC-BY-4.0"]] * 2
