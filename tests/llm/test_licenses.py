import os

import pytest

from tidemark.llm import licenses as op
from tidemark.llm.license_texts import BSD_HEAD, BSD_NAME, BSD_TAIL, MIT, UNLICENSE

INSTALLED = "/usr/share/common-licenses"


def test_sql(same_as_sql):
    same_as_sql("op1_license_digest")


def test_texts_match_whatever_their_form(docs_of):
    mit = "The MIT License (MIT)\n\nCopyright (c) 2019 Someone\nAll rights reserved.\n\n" + MIT.upper().replace(" ", "  ")
    bsd = "Copyright 2001, A. N. Other\n" + (BSD_HEAD + BSD_NAME + BSD_TAIL).replace("\n\n", "\n\n * ").replace("copyright holder", "copyright owner")
    rows = [(1, mit), (2, bsd), (3, MIT + " extra"), (4, "Some text.\nReleased under the mit licence!\nLicensed under CC BY-NC 4.0."), (5, MIT[:-20])]
    got = {r["doc_id"]: r for r in op.scan(docs_of(rows)).collect()}
    assert [got[i]["license_id"] for i in range(1, 6)] == ["MIT", "BSD-3-Clause", None, None, None]
    assert got[4]["notices"] == "CC-BY-NC-4.0,MIT" and got[4]["n_notices"] == 2 and got[3]["n_notices"] == 0


def test_copyright_word_inside_a_text_stays(docs_of):
    a, b = op.scan(docs_of([(1, "copyright notice and this"), (2, "copyright notice and that")])).collect()
    assert a["digest"] != b["digest"]


def test_odd_rows(odd_docs, no_docs):
    got = op.scan(odd_docs).collect()
    assert len(got) == 11 and all(r["license_id"] is None and r["n_notices"] == 0 for r in got)
    assert len({r["digest"] for r in got if r["doc_id"] in (1, 2, 3)}) == 1
    assert op.scan(no_docs).count() == 0


@pytest.mark.parametrize("head", ["Copyright The Frobnicator Authors", "Copyright [yyyy] [name of the owner]", "Copyright <year> <name>", "© 2020 A. N. Other",
                                  "Copyright Someone Else, 2019-2021", "(c) 2011 Someone\nCopyright 2012 Another\nAll rights reserved."])
def test_copyright_statements_and_headings(docs_of, head):
    docs = docs_of([(k, f"{title}{head}\n\n{MIT}") for k, title in enumerate(["", "MIT License\n\n", "The MIT License\n\n", "The MIT License (MIT)\n\n"])])
    assert {r["license_id"] for r in op.scan(docs).collect()} == {"MIT"}


def test_wrapped_lines_that_begin_with_copyright_stay(docs_of):
    wrapped = MIT.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS OR\nCOPYRIGHT HOLDERS").replace("The above copyright notice", "The above\ncopyright notice")
    assert wrapped.count("\n") == MIT.count("\n") + 2 and [r["license_id"] for r in op.scan(docs_of([(1, wrapped)])).collect()] == ["MIT"]


def test_versions_only_where_a_number_follows_the_word(docs_of):
    same = [("Version 2.0 of it", "v2.0 of it"), ("see v. 2", "see version 2"), ("75 per cent", "75 percent")]
    other = [("conversion 3 of it", "conv3 of it"), ("Foo v. Bar", "Foo vBar"), ("version two", "vtwo")]
    digest = {r["doc_id"]: r["digest"] for r in op.scan(docs_of([(10 * k + i, t) for k, pair in enumerate(same + other) for i, t in enumerate(pair)])).collect()}
    assert [digest[10 * k] == digest[10 * k + 1] for k in range(6)] == [True] * 3 + [False] * 3


def test_unlicense_and_a_long_text(docs_of):
    got = {r["doc_id"]: r["license_id"] for r in op.scan(docs_of([(1, "The Unlicense\n\n" + UNLICENSE.replace("https://unlicense.org", "http://unlicense.org/")),
                                                                  (2, (MIT + "\n") * 2000)])).collect()}
    assert got == {1: "Unlicense", 2: None}


@pytest.mark.skipif(not os.path.isdir(INSTALLED), reason="no licence files are installed")
@pytest.mark.parametrize("name,wanted", [("Apache-2.0", "Apache-2.0"), ("GPL-2", "GPL-2.0"), ("GPL-3", "GPL-3.0"), ("LGPL-2.1", "LGPL-2.1"), ("LGPL-3", "LGPL-3.0"),
                                         ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0")])
def test_long_licences(docs_of, name, wanted):
    with open(f"{INSTALLED}/{name}", encoding="utf-8") as f:
        text = f.read()
    end = "END OF TERMS AND CONDITIONS"
    terms = text[: text.index(end) + len(end)] if end in text else text
    rows = [(1, text), (2, " ".join(text.upper().split(" "))), (3, terms), (4, text.replace(",", " ,").replace("version 2", "v2")), (5, text[:-200])]
    assert {r["doc_id"]: r["license_id"] for r in op.scan(docs_of(rows)).collect()} == {1: wanted, 2: wanted, 3: wanted, 4: wanted, 5: None}
