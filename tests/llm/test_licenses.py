import re

import pytest

from tabwarden.llm import licenses


def found(make_docs, rows, **options):
    docs = make_docs(list(enumerate(rows)), extra=["digest", "license", "lines"])
    return {r.doc_id: r for r in licenses.find_licenses(docs, **options).collect()}


def test_entire_texts(make_docs):
    mit, isc = licenses.LICENSES["MIT"], licenses.LICENSES["ISC"]
    texts = [
        mit, "Copyright (c) 2019 A. Name\n\n" + mit.upper(), re.sub(r"\s+", "\n * ", mit), mit.replace("sublicense", "sub-license"),
        mit.partition("\n\n")[2], mit + " and more", isc, "© 2020 X\nAll rights reserved.\n" + isc, None, "", mit.replace("Software", "Program"),
        "(c) 1999 Y\n" + licenses.LICENSES["Zlib"],
    ]
    got = found(make_docs, texts)
    assert [got[i].license for i in range(len(texts))] == ["MIT"] * 5 + [None, "ISC", "ISC", None, None, None, "Zlib"]
    assert len({got[i].digest for i in (0, 1, 2, 3)}) == 1


def test_long_texts_and_their_forms(make_docs):
    apache, gpl, bsd = (licenses.LICENSES[n] for n in ("Apache-2.0", "GPL-2.0-only", "BSD-3-Clause"))
    ends = apache.partition("END OF TERMS AND CONDITIONS")
    texts = [
        apache, apache.replace("[yyyy] [name of copyright owner]", "2021 A. Name"), ends[0] + ends[1], ends[0], apache.replace("http://", "https://"),
        gpl, re.sub(licenses.FSF_ADDRESS, "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA", gpl), bsd,
        "BSD 3-Clause License\n\nCopyright (c) 2020, A\nAll rights reserved.\n\n" + re.sub(r"\n\d\. ", "\n* ", bsd),
        apache.replace("perpetual", "temporary"), gpl[: len(gpl) // 2],
    ]
    want = ["Apache-2.0"] * 5 + ["GPL-2.0-only"] * 2 + ["BSD-3-Clause"] * 2 + [None] * 2
    for name in ("GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0", "BSL-1.0", "OFL-1.1"):
        texts.append(licenses.LICENSES[name])
        want.append(name)
    got = found(make_docs, texts)
    assert [got[i].license for i in range(len(texts))] == want


@pytest.mark.parametrize(
    "name,title",
    [
        ("BSD-2-Clause", "BSD 2-Clause License"), ("MIT", "The MIT License (MIT)"), ("Zlib", "zlib License"), ("ISC", "The ISC License"),
        ("0BSD", "BSD Zero Clause License"), ("Unlicense", "The Unlicense"),
    ],
)
def test_titles(make_docs, name, title):
    text = licenses.LICENSES[name].removeprefix(f"{name} License\n\n")
    assert found(make_docs, [f"{title}\n\nCopyright (c) 2014 B. Name\n\n{text}\n"])[0].license == name


def test_notices(make_docs):
    texts = [
        "Some text.\nLicensed under the Apache License, Version 2.0.\nMore.", "  released under the mit licence", "Licensed under CC BY-NC 4.0!",
        "Licensed under CC BY 4.0.\nReleased under the MIT License.\nReleased under the MIT License.", "text Licensed under CC BY 4.0.",
        "// SPDX-License-Identifier: MIT", None,
    ]
    got = found(make_docs, texts)
    assert [got[i].notices for i in range(len(texts))] == [
        ["Apache-2.0"], ["MIT"], ["CC-BY-NC-4.0"], ["CC-BY-4.0", "MIT"], [], ["MIT"], [],
    ]
    assert got[3].n_notices == 3


def test_other_tables_of_licenses(make_docs):
    got = found(make_docs, ["My own terms."], texts={"own": "my OWN terms"}, notices={})
    assert got[0].license == "own" and got[0].notices == []
    with pytest.raises(ValueError):
        found(make_docs, ["x"], notices={"own": ["no such word"]})


def test_long_texts_repeated_rows_and_empty_table(make_docs, prose):
    rows = [(1, prose(1, 50_000)), (1, prose(1, 50_000)), (None, licenses.LICENSES["MIT"])]
    got = licenses.find_licenses(make_docs(rows)).collect()
    assert sorted(str(r.license) for r in got) == ["MIT", "None", "None"]
    assert licenses.find_licenses(make_docs([])).count() == 0


def test_main_path_is_native(make_docs):
    plan = licenses.find_licenses(make_docs([(1, "x")]))._jdf.queryExecution().toString()
    assert not re.search("Python|ArrowEval|Pandas|MapIn", plan)
    assert "BroadcastHashJoin" in plan


def test_known_digests_are_of_different_licenses(spark):
    rows = licenses.known_licenses(spark).collect()
    assert {r.license for r in rows} == set(licenses.LICENSES)
