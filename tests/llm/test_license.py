import re

from llm_cases import ROWS, frame

from kassa.llm import license_scan as L


def test_markup():
    t = (("x", "a [[b c]] d {{2}} e"),)
    yes = ["a d q e", "a b c d q e", "a d q r e", "z a d e e", "a b a d q e z"]
    no = ["a d e", "a b d q e", "a c d q e", "a d q r s e", "d q e", "a d q", "a b c q e"]
    assert all(L.find_notices(w.encode().split(), t) == {"x"} for w in yes)
    assert not any(L.find_notices(w.encode().split(), t) for w in no)
    assert L.find_notices(b"b".split(), (("y", "[[a]] b [[c]]"),)) == {"y"}


def test_labels_and_places(spark):
    gpl = "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "x. Released under the MIT License."),
        (2, "Licensed under the Apache License, Version 2.0. apache-license"),
        (3, gpl + "\nMIT\nlicense " + gpl),
        (4, "the MIT x License and general public"),
        (5, "Licensed under CC BY-NC 4.0."),
    ]
    got = {r.doc_id: r for r in L.scan_licenses(frame(spark, rows)).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].labels) == (1, 4, 4, "mit,mit-notice")
    assert (got[2].n_base, got[2].first_word, got[2].last_word) == (2, 3, 8)
    assert (got[2].base_labels, got[2].labels, got[2].score) == ("apache", "apache,apache-2.0-notice", 1.0)
    assert (got[3].n_base, got[3].first_word, got[3].last_word, got[3].base_labels) == (3, 7, 21, "gpl,mit")
    assert (got[4].n_base, got[4].first_word, got[4].labels, got[4].score) == (0, None, "", 0.0)
    assert (got[5].base_labels, got[5].labels) == ("", "cc-by-nc-notice")


MIT = """Copyright (c) 2020 Some Holder

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""


def _written_out(wording, regions, holder):
    """A licence text of a template, with or without its optional regions."""
    wording = re.sub(r"\[\[([^\]]*)\]\]", r"\1" if regions else "", wording)
    return re.sub(r"\{\{\d+\}\}", holder, wording)


def test_whole_texts(spark):
    changed = MIT.replace("including without limitation", "except that nobody may sell it, including without limitation")
    cut = MIT[: MIT.index("THE SOFTWARE IS")]
    rows = [(1, "Words before. " + MIT + " Words after."), (2, changed), (3, cut), (4, MIT.replace("ANY CLAIM", "A CLAIM"))]
    wording = {label: w for label, w in L.TEMPLATES if label.endswith("-text")}
    assert set(wording) == {"mit-text", "isc-text", "bsd-2-clause-text", "bsd-3-clause-text"}
    want = {1: ("mit-opening,mit-text", 1.0), 2: ("mit-opening", 0.75), 3: ("mit-opening", 0.75), 4: ("mit-opening", 0.75)}
    for k, (label, w) in enumerate(sorted(wording.items())):
        for regions in (False, True):
            text = _written_out(w, regions, "the copyright holder and contributors")
            at = 100 + 10 * k + 2 * regions
            words = text.split()
            rows += [(at, text), (at + 1, " ".join(words[:-3] + ["never"] + words[-3:]))]
            opening = [] if label == "isc-text" else [label.split("-")[0] + "-opening"]
            want[at] = (",".join(sorted([*opening, label])), 1.0)
            want[at + 1] = (",".join(opening), 0.75 if opening else 0.0)
    got = {r.doc_id: (r.labels, r.score) for r in L.scan_licenses(frame(spark, rows)).collect()}
    assert got == want


def test_a_holder_of_too_many_words_is_no_match():
    wording = dict(L.TEMPLATES)["isc-text"]
    for holder, found in (("abcdefgh", {"isc-text"}), ("abcdefghi", set())):
        text = _written_out(wording, True, " ".join(holder))
        assert L.find_notices(text.encode().split()) == found


def test_edge_rows(spark):
    got = L.scan_licenses(frame(spark)).collect()
    assert len(got) == len(ROWS)
    for r in got:
        text = next((t or "") for d, t in ROWS if d == r.doc_id)
        assert r.n_words == len(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)))
        assert (r.n_base, r.labels, r.score) == (0, "", 0.0)
    assert L.scan_licenses(frame(spark, [])).collect() == []
