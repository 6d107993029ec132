"""Personal data: the fixed patterns against the regular expressions themselves, and the field's consistency."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from ontime.llm import pii
from ontime.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(text):
    """The patterns as they are written, one search each."""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = digits(m)
        total = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m)) <= 15]


PIECES = st.sampled_from(["a@b.c", "x.y@", "@", ".", "-", "+1 (23) 456-78", "+", " ", "256", "1.2.3.4", "0001", "4111 1111 1111 1111", "4111-1111-1111-1112", "é", "\n", "١", "(", "9"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=14).map("".join))
def test_patterns(text):
    assert pii.pattern_spans(text) == plain(text)


MODEL = None


def model(spark):
    global MODEL
    MODEL = MODEL or pii.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 5000"))
    return MODEL


def test_query_on_the_test_table(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op2_pii_skip_chain"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        want = plain(texts[r.doc_id])
        listed = [f"{k}:{a}:{b}" for k, a, b in want]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in want) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(","))


def test_field_learns_the_patterns_on_other_texts(spark):
    """Held out: nodes of texts that were not in the sample."""
    right = total = 0
    for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id >= 5000").collect():
        found = pii.graph(r.text or "")
        if len(found.spans):
            want = pii._labels(found, pii.pattern_spans(r.text))
            got = pii._sum_product(found.features @ model(spark).unary, found.edges, model(spark).potentials)
            right, total = right + int((want == got).sum()), total + len(want)
    assert total > 300 and right / total > 0.95


def test_distant_alike_tokens_agree():
    """A strong node pulls an undecided one of the same text over, and nothing else."""
    unary = np.array([[2.0, 0, 0, 0, 0], [0, 0, 0, 3.0, 0], [0.3, 0, 0, 0.2, 0], [0.3, 0, 0, 0.2, 0]])
    potentials = np.zeros((3, 5, 5))
    potentials[pii.REPEATED] = np.eye(5) * 2
    edges = np.array([[1, 2, pii.REPEATED]])
    assert pii._sum_product(unary, edges, potentials).tolist() == [0, 3, 3, 0]


def test_alike_tokens_are_linked_however_far_apart():
    text = "call 555-0199 now " + "word " * 30_000 + "again 555-0199, or 555-0100"
    edges = pii.graph(text).edges.tolist()
    assert edges == [[0, 1, pii.REPEATED], [1, 2, pii.SIMILAR]]


def test_field_adds_spans_without_touching_the_patterns(spark):
    text = "call +1 (755) 555-9729 or (755) 555-9729, not 12 times"
    base, spans = pii.find(text, model(spark))
    assert base == [("phone", 5, 22)]
    assert spans == [("phone", 5, 22), ("phone", 26, 40)]


def test_mask_and_cases(spark):
    rows = [(1, None), (2, ""), (3, "write a.b@c.de now"), (3, "write a.b@c.de now"), (None, "no data"), (4, "1" * 200_000 + " a" * 100_000 + "@" * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS found", "'y' AS spans")
    out = pii.mask(df, model(spark))
    assert out.columns == df.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert got[:5] == [(1, None), (2, ""), (3, "write <EMAIL> now"), (3, "write <EMAIL> now"), (None, "no data")]
    empty = df.limit(0)
    assert pii.mask(empty, pii.fit(empty)).count() == 0
    assert pii.masked("abcdef", [("card", 1, 3), ("phone", 2, 5)]) == "a<CARD>f"


def test_sample_is_bounded_and_copies_count_once(spark):
    from pyspark.sql import functions as F

    from ontime.llm.tables import hash_sample

    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    got = [r.k for r in hash_sample(df, F.col("k"), 1000).collect()]
    assert 400 < len(got) <= 1000 and len(set(got)) == len(got)
    assert hash_sample(df.limit(0), F.col("k"), 10).count() == 0
    assert hash_sample(spark.range(5), F.col("id"), 10).count() == 5
