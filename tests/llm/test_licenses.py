from __future__ import annotations

import re
from pathlib import Path

import pytest

from delaylab.llm import licenses

from .helpers import awkward_rows, table

MIT = licenses.KNOWN[0][1]
VARIANT = "Copyright (c) 2021 Someone\n\n" + MIT.upper().replace('"', "“").replace(
    "\n", "\n\n   ").replace("SUBLICENSE", "SUB-LICENSE")


@pytest.mark.parametrize("limit", [licenses.MAX_BROADCAST_BYTES, 0])
def test_known_texts_and_notices(spark, limit):
    rows = [(1, MIT, None, None), (2, VARIANT, None, None), (3, MIT + " more", None, None),
            (4, "Prose.\nReleased under the MIT Licence\nLicensed under CC BY-NC 4.0.\n"
                "licensed under  cc by nc 4.0", None, None),
            (5, "our own terms", None, None), (5, "our own terms", None, None)]
    extra = spark.createDataFrame([("own", "Our OWN terms!")], "license_id string, text string")
    got = sorted(tuple(r)[:1] + tuple(r)[2:] for r in licenses.scan_licenses(
        table(spark, rows), extra, max_broadcast_bytes=limit).collect())
    assert got == [(1, "MIT", 0, ""), (2, "MIT", 0, ""), (3, None, 0, ""),
                   (4, None, 3, "CC-BY-NC-4.0,MIT"), (5, "own", 1, "own"), (5, "own", 1, "own")]


def test_awkward_rows_and_empty_table(spark):
    rows = awkward_rows()
    got = licenses.scan_licenses(table(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert all(r.license_id is None and r.n_notices == 0 and r.notice_ids == "" for r in got)
    blank = {r.text_digest for r in got if r.doc_id in (41, 42, 43)}
    assert len(blank) == 1
    assert licenses.scan_licenses(table(spark, [])).collect() == []


def test_licences_as_they_are_distributed(spark):
    bsd = next(t for i, t in licenses.KNOWN if i == "BSD-2-Clause")
    own = "Copyright (c) 2020 X\n"
    rows = [("MIT", "MIT License\n\n" + own + "\n" + MIT),
            ("MIT", "The MIT License (MIT)\n" + own + MIT),
            ("BSD-2-Clause", own + "All rights reserved.\n\n" + bsd),
            ("BSD-2-Clause", "BSD 2-Clause License\n\n" + own + "All rights reserved.\n\n"
             + bsd.replace("1. ", "* ").replace("2. ", "* "))]
    for name, license_id in (("Apache-2.0", "Apache-2.0"), ("GPL-2", "GPL-2.0"),
                             ("GPL-3", "GPL-3.0"), ("LGPL-3", "LGPL-3.0"), ("CC0-1.0", "CC0-1.0"),
                             ("LGPL-2.1", "LGPL-2.1"), ("MPL-2.0", "MPL-2.0"),
                             ("BSD", "BSD-3-Clause")):
        text = Path(f"/usr/share/common-licenses/{name}").read_text(encoding="utf-8")
        rows += [(license_id, text), (license_id, " ".join(text.split("\n\n")[:1])
                                      + "\n\n" + "\n\n".join(text.split("\n\n")[1:]) + "\n")]
    got = licenses.scan_licenses(table(spark, [(i, t, None, None)
                                               for i, (_, t) in enumerate(rows)])).collect()
    assert {r.doc_id: r.license_id for r in got} == {i: x for i, (x, _) in enumerate(rows)}


def test_main_path_is_native(spark):
    plan = licenses.scan_licenses(table(spark, awkward_rows()))
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop",
                         plan._jdf.queryExecution().toString())
