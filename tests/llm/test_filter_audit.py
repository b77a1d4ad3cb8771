"""The byte transducer, the verified span table and the audit, against plain Python."""
import re
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sitewise.llm import filter_audit as fa

from .conftest import LABELS

TEXTS = [None, "", "  \n\t", "Aa Bb $ aa Aa", "é " * 300, "WORD " * 250, "x|y & z", "a" * 90 + " " + "a" * 90 + " " + "a" * 89 + "b", "tab\tsep\x0bvt\x0cff\rcr", "AÉÀ àÀ 漢字 漢字"]


def _said(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    return (len(ws), len(set(ws)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB é漢$|\n\t", max_size=40), max_size=6))
def test_transducer_and_table_on_any_texts(texts):
    raw = [t.encode() for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), np.uint8)
    starts, ends, out = fa.transduce(data, offs)
    row = np.repeat(np.arange(len(raw)), np.diff(np.searchsorted(starts, offs)))
    table = fa.SpanTable(data, starts, ends, row)
    for i, t in enumerate(texts):
        want = _said(t)
        assert (int((row == i).sum()), int((row[table.entries] == i).sum())) == want[:2]
        own = out[offs[i]:offs[i + 1]]
        assert tuple(int(((own & flag) != 0).sum()) for flag in (fa.CAPITAL, fa.POINT, fa.SYMBOL)) == want[2:]


def test_equal_hashes_are_told_apart_by_their_bytes():
    class Colliding(fa.SpanTable):
        def _hashes(self):
            return np.zeros(len(self.starts), np.uint64)

    ws = [b"one", b"two", b"one", b"x" * 70, b"x" * 70, b"x" * 69 + b"y", b"eightlet", b"eightletters", b"eightletterz"]
    data = np.frombuffer(b" ".join(ws), np.uint8)
    starts, ends, _ = fa.transduce(data, np.array([0, len(data)]))
    assert len(Colliding(data, starts, ends, np.zeros(len(starts), np.int64)).entries) == len(set(ws))


def _brute(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    failed = []
    for i, t, lang, *_ in rows:
        n, distinct, caps, points, symbols = _said(t)
        f = {"A": n < 200, "B": 100 * distinct < 50 * n, "C": 100 * caps > 3 * points, "D": symbols > 0, "E": i is not None and i > least[t or ""]}
        failed.append((lang or "", {k for k in f if f[k]}, i in good, i in toxic))
    out = {}
    for part in {f[0] for f in failed}:
        mine = [f for f in failed if f[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, own in enumerate(order, 1):
                gone = [x for x in left if own in x[1]]
                out[part, "".join(order), step] = [len(left) - len(gone), len(gone), sum(own in x[1] for x in mine) - len(gone),
                                                   sum(x[1] == {own} for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone)]
                left = [x for x in left if own not in x[1]]
        for own in "ABCDE":
            of = [k for k in out if k[0] == part and k[1][k[2] - 1] == own]
            total = sum(out[k][1] for k in of)
            for k in of:
                out[k].append(total)
    return {k: tuple(v) for k, v in out.items()}


def _audited(docs, labels):
    sets = fa.failure_sets(fa.signals(docs), labels, fa.text_filters())
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in fa.audit(sets, "ABCDE").collect()}


@pytest.fixture(scope="module")
def rows():
    langs = ["en", "de", None, ""]
    out = [(i, t, langs[i % 4], None) for i, t in enumerate(TEXTS * 3)]
    return [*out, (3, TEXTS[3], "en", None), (3, TEXTS[3], "en", None), (None, TEXTS[3], "en", None), (-5, "Aa Bb $ aa Aa", "fr", None), (2, "another text of id 2", "en", None)]


def test_audit_equals_brute_force(spark, docs_of, rows):
    labels = [(0, 1, 0), (3, 1, 1), (3, 0, 0), (4, None, 1), (None, 1, 1), (13, 0, None), (99, 1, 1)]
    docs = docs_of(rows).withColumn("n", F.lit("x")).withColumn("digest", F.lit("x")).withColumn("part", F.lit("x"))
    got = _audited(docs, spark.createDataFrame(labels, LABELS))
    assert got == _brute(rows, labels)
    assert len(got) == 4 * 600


def test_messy_and_empty_tables(messy, empty, no_labels):
    from .conftest import MESSY
    assert _audited(messy, no_labels) == _brute(MESSY, [])
    assert _audited(empty, no_labels) == {}
