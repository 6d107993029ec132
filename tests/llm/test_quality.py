"""Quality rules against a plain count, and the cases their docstring names."""

import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
import pyarrow as pa
import pyarrow.parquet as pq

from ontime.llm import quality
from ontime.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def windows(words, n):
    seen = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return {j for i in range(len(words) - n + 1) if seen[tuple(words[i : i + n])] > 1 for j in range(i, i + n)}


def later(words, n):
    seen, out = set(), set()
    for i in range(len(words) - n + 1):
        window = tuple(words[i : i + n])
        if window in seen:
            out.update(range(i, i + n))
        seen.add(window)
    return out


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    chars = sum(map(len, words))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    again = [x for i, x in enumerate(lines) if x in lines[:i]]
    symbols, three = sum(c in "#*$%&|<>" for c in text), len(windows(words, 3))
    failed = len(words) < 50 or 100 * three > 50 * len(words)
    shares = {n: sum(len(words[i]) for i in later(words, n)) / max(chars, 1) for n in quality.LENGTHS}
    line_chars = sum(map(len, again)) / max(sum(map(len, lines)), 1)
    limits = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
    repetitive = any(shares[n] > limits[n] for n in limits)
    headed = len(again) < 2 or len(again) <= 0.3 * len(lines)
    kept = not failed and not repetitive and headed and line_chars <= 0.2 and symbols <= 0.1 * len(words)
    counts = [len(words), chars, symbols, len(again), three]
    return counts + [failed, kept], shares | {"lines": line_chars}


def same(row, text):
    want, shares = plain(text)
    assert [row[c] for c in [*quality.COUNTS, "base_failed", "kept"]] == want
    assert row["dup_line_chars"] == pytest.approx(shares["lines"])
    for n in quality.LENGTHS:
        assert row[f"dup_{n}_chars"] == pytest.approx(shares[n])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab é\n\t|\x0b", max_size=120), st.lists(st.sampled_from(["x", "yy", "é", "\n"]), max_size=90).map(" ".join)), max_size=6))
def test_matches_a_plain_count(texts):
    for row, text in zip(quality.score_texts(pa.array(texts, pa.string())).to_pylist(), texts, strict=True):
        same(row, text)


def test_query_on_the_test_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op1_quality_repetition"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        same(r, texts[r.doc_id])


def test_nulls_empty_long_repeated_and_extra_columns(spark):
    good = " ".join(f"w{i}" for i in range(200))
    rows = [(1, None), (2, ""), (3, good), (3, good), (4, good + " " + "z" * 300_000), (None, good), (5, "a b c " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS kept", "1 AS Quality")
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 3, 3, 4]
    assert quality.keep_good(df.limit(0)).count() == 0


def test_a_lone_repeated_line_does_not_reject_a_good_text():
    line = "one line that is set twice in this text as a heading"
    text = line + "\n" + " ".join(f"word{i}" for i in range(60)) + "\n" + line
    assert quality.score_texts(pa.array([text])).to_pylist()[0]["kept"]


def verdict(text):
    same(row := quality.score_texts(pa.array([text])).to_pylist()[0], text)
    assert not row["base_failed"]
    return row["kept"]


def test_a_text_that_passes_the_base_is_rejected_for_its_sequences():
    words = [f"word{i:03}" for i in range(150)]
    assert verdict(" ".join(words))
    # 30 of 180 words are a passage given again: 0.17 of the characters, 0.33 with its first occurrence.
    assert not verdict(" ".join(words + words[40:70]))
    # 12 of 162 are not too much.
    assert verdict(" ".join(words + words[40:52]))


def test_a_text_that_passes_the_base_is_rejected_for_its_lines():
    body = [" ".join(f"w{line}x{i}" for i in range(40)) for line in range(4)]
    two, three = "short line", "other one"
    # Lines of two words never make a sequence of five; 4 of 10 lines are given again.
    text = "\n".join([two, body[0], two, body[1], three, body[2], two, body[3], three, two])
    row = quality.score_texts(pa.array([text])).to_pylist()[0]
    assert max(row[f"dup_{n}_chars"] for n in quality.LENGTHS) == 0
    assert not verdict(text)
    assert verdict("\n".join([two, *body, two]))


def test_both_rules_reject_texts_of_the_test_table():
    """What the base rule lets pass, the sequences and the lines do not always."""
    texts = pq.read_table("/root/testdata/sf0.1/documents.parquet", columns=["text"]).column(0).combine_chunks()
    rows = [r for r in quality.score_texts(texts).to_pylist() if not r["base_failed"]]
    assert sum(any(r[f"dup_{n}_chars"] > quality.MOST_REPEATED[n] for n in quality.LENGTHS) for r in rows) > 0
    assert sum(r["n_dup_lines"] > 1 and r["dup_line_share"] > quality.MOST_LINES for r in rows) > 0
    assert sum(not r["kept"] for r in rows) < 0.1 * len(rows)
