"""Licence scans against a comparison of every part with every template."""

import re
from collections import Counter

from hypothesis import given, settings, strategies as st
import pyarrow as pa

from ontime.llm import licenses, textblocks
from ontime.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", low)


def plain(text, limit=licenses.LIMIT):
    """{(start, end): (licence, coefficient)} of every part that matches."""
    text = text or ""
    lines = [(m.start(), m.end()) for m in re.finditer(r"[^\n]+", text)]
    strip = lambda a, b: text[a:b].strip(" \t\n\r\x0b\x0c")
    paragraphs, begin = [], None
    for a, b in [(m.start(), m.end()) for m in re.finditer(r"[^\n]*(?:\n|$)", text)] + [(len(text), len(text))]:
        b -= text[a:b].endswith("\n")
        if strip(a, b):
            begin, end = (a if begin is None else begin), b
        elif begin is not None:
            paragraphs.append((begin, end))
            begin = None
    out = {}
    for a, b in {(0, len(text)), *paragraphs, *lines}:
        words = plain_words(text[a:b])
        mine = Counter(zip(words, words[1:]))
        found = []
        for name, template in licenses.TEMPLATES.items():
            other = plain_words(template)
            other = Counter(zip(other, other[1:]))
            share = 2 * (mine & other).total() / (mine.total() + other.total())
            if share >= limit:
                found.append((-share, name))
        if found:
            out[a, b] = (min(found)[1], -min(found)[0])
    return out


def scan(text):
    known = licenses.Templates(licenses.TEMPLATES, licenses.LIMIT)
    found = [m for block in textblocks.blocks(pa.array([text], pa.string())) for m in licenses._scan_block(block, known)][0]
    return {(m["start"], m["end"]): (m["license"], m["dice"]) for m in found}


SOME = list(licenses.TEMPLATES.values())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(SOME), st.sampled_from(["\n", "\n\n", " ", "é word", "Licensed under", "the MIT License", "ÜBER", "\t\n"])), max_size=8).map("".join))
def test_matches_the_full_comparison(text):
    assert scan(text) == plain(text)


def test_query_on_the_test_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op7_license_dice"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        want = plain(texts[r.doc_id])
        assert (r.n_matches, r.licenses) == (len(want), ",".join(sorted({k for k, _ in want.values()})))
        assert r.best_dice == max((d for _, d in want.values()), default=None)
    assert sum(r.n_matches > 0 for r in got) > 10


def test_changed_wording_still_matches():
    changed = licenses.TEMPLATES["MIT text"].replace("Software", "Work", 1).replace("free of charge", "without charge")
    assert scan("intro\n\n" + changed + "\n\nend")[7, 7 + len(changed)][0] == "MIT text"
    assert scan("the license of the library is not named here at all") == {}


def test_cases(spark):
    mit = licenses.TEMPLATES["MIT"]
    rows = [(1, None), (2, ""), (3, mit), (3, mit), (None, mit), (4, "x " * 100_000 + "\n" + mit)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS m", "2 AS licenses")
    out = df.select("doc_id", licenses.scan("text").alias("found"))
    assert sorted((r.doc_id or 0, [m.license for m in r.found]) for r in out.collect()) == [(0, ["MIT"]), (1, []), (2, []), (3, ["MIT"]), (3, ["MIT"]), (4, ["MIT"])]
    assert df.limit(0).select(licenses.scan("text")).count() == 0


def with_windows(text, templates=licenses.TEMPLATES | licenses.WHOLE):
    known = licenses.Templates(templates, licenses.LIMIT)
    found = [m for b in textblocks.blocks(pa.array(["", text, None], pa.string())) for m in licenses._windows(b, known, licenses._scan_block(b, known))][1]
    return {text[m["start"] : m["end"]]: (m["license"], m["dice"]) for m in found}


def test_notices_in_the_middle_of_a_line():
    assert with_windows("Copyright é (c) 2020 Foo Inc. Released under the MIT License. " + "More words follow here. " * 5) == {"Released under the MIT License": ("MIT", 1.0)}
    apache = "Licensed under the Apache License, Version 2.0"
    assert with_windows(f"Some prose here. {apache}. More prose. And {apache}, too, with some more words") == {apache: ("Apache-2.0", 1.0)}
    assert with_windows("the license of the library is not named here at all, nor is the version of the software") == {}


def test_whole_licences():
    for name in licenses.WHOLE:
        text = "A title and some words of an author\n" + licenses.WHOLE[name] + "\n" + "an end of other words that goes on " * 3
        assert name in {k for k, _ in with_windows(text).values()}, name
    mit = "MIT License Copyright (c) 2020 Foo " + licenses.WHOLE["MIT whole"]
    assert {k for k, _ in with_windows(mit).values()} == {"MIT whole"}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("a b c d e f g".split()), min_size=2, max_size=40), st.lists(st.sampled_from("a b c d e f g".split()), min_size=4, max_size=12))
def test_windows_match_every_window_compared(text, template):
    mine, known = list(zip(text, text[1:])), Counter(zip(template, template[1:]))
    for length in licenses._lengths(known.total(), 0.8):
        want = []
        for i in range(len(mine)):
            ends = [k for k in range(i, min(i + length, len(mine))) if mine[k] in known]
            part = Counter(mine[i : ends[-1] + 1]) if ends else Counter()
            share = 2 * (part & known).total() / (part.total() + known.total())
            if mine[i] in known and share >= 0.8:
                want.append((share, i, ends[-1]))
        assert list(licenses._slide(mine, range(len(mine)), length, known, 0.8)) == want
