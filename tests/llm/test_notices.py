"""Licence headers, identifiers and passages, and templates of a caller."""

import pytest

from tabloom.llm import licenses

NOTICES = {
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "gpl-3",
    "you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.": "lgpl-2",
    "// SPDX-License-Identifier: MIT": "mit",
    "License: GPL-3.0-or-later": "gpl-3",
    "# SPDX-License-Identifier: GPL-2.0-only": "gpl-2",
    "Images are CC-BY-SA 4.0.": "cc-by-sa",
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.': "mit",
    "SPDX-License-Identifier: BSD-3-Clause": "bsd",
    "either version 3 of the license of another kind, gpl and mit are words here; cc by the way": "",
    "You can redistribute it under the GNU General Public License": "",
}


def test_headers_identifiers_and_passages_have_their_labels(spark):
    rows = list(enumerate(NOTICES))
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: NOTICES[t] for i, t in rows}


@pytest.mark.parametrize("label", ["own", "it's \\ own"])
def test_a_callers_template_may_have_any_characters(spark, label):
    own = (licenses.Template(label, "Don't use O'Neill's \\ work, for \"profit\"!", ("O'Neill's \\ work",)),)
    rows = [(1, "Please: don't use o'neill's work for profit."), (2, "don t use o neill s toys for profit"), (3, None)]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), own).collect()}
    assert got == {1: label, 2: "", 3: ""}
