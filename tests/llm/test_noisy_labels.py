"""The toxicity classifier where insults also stand in documents labelled clean."""
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitewise.llm import toxicity

WORDS = "the and of this river stone table house garden window mountain silver".split()


def _bags(rng, n):
    return [" ".join(rng.choice(WORDS) for _ in range(30)) for _ in range(n)]


def test_an_insult_in_clean_documents_stays_a_witness():
    rng = random.Random(3)
    good, bad = _bags(rng, 90), [f"{g} {('nincompoop', 'scoundrel')[i % 2]} {g}" for i, g in enumerate(_bags(rng, 60))]
    quoted = [f"{g} {w}" for g, w in zip(_bags(rng, 6), ("nincompoop", "scoundrel") * 3, strict=True)]
    texts, labels = good + quoted + bad, np.array([0.0] * 96 + [1.0] * 60)
    mix = rng.sample(range(len(texts)), len(texts))
    model = toxicity.train([texts[i] for i in mix], labels[mix])
    assert not model.get("floor")
    assert (toxicity.document_scores(pa.array(bad), model) >= toxicity.THRESHOLD).mean() >= 0.9
    assert (toxicity.document_scores(pa.array(good), model) < toxicity.THRESHOLD).mean() >= 0.95


def test_no_witness_is_told():
    bags = _bags(random.Random(4), 40)
    with pytest.warns(RuntimeWarning, match="no word tells"):
        model = toxicity.train(bags + bags, np.array([0.0, 1.0] * 40))
    assert model["floor"]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no driver tables")
def test_recall_of_toxic_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    rows = toxicity.op9_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out and toxic = 1")
    assert rows.agg(F.avg("predicted")).first()[0] >= 0.88
