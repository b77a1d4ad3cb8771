"""Nulls, empty and long texts, repeated rows, empty tables and extra columns."""
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from sitewise.llm import cap_filters, jaccard_groups, license_join, mixing, packing, quality_rules, suffix_dedup, token_counts, toxicity

from .conftest import MESSY

CLASHING = ["rk", "n", "row", "spans", "key", "token", "cid", "lo", "hi", "position", "copies", "bucket", "s_id", "k_id", "id", "__row", "score"]


def _digest(df):
    return df.select("doc_id", "text", "spans").mapInArrow(suffix_dedup._digest_rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _operators(no_labels):
    return {
        "packing": packing.pack,
        "suffix": lambda d: _digest(suffix_dedup.with_spans(suffix_dedup.keyed(d))),
        "tokens": token_counts.section_tokens,
        "rules": lambda d: quality_rules.rules(d, no_labels),
        "mixing": mixing.mix,
        "licence": license_join.scan,
        "jaccard": lambda d: jaccard_groups.join(jaccard_groups.keyed(d)),
        "toxic": lambda d: toxicity.keep_clean(d, no_labels),
    }


def test_every_operator_keeps_every_messy_row(messy, no_labels):
    for name, f in _operators(no_labels).items():
        got = Counter(r["doc_id"] for r in f(messy).select("doc_id").distinct().collect())
        assert set(got) == {r[0] for r in MESSY}, name
        if name != "tokens":
            assert f(messy).count() == len(MESSY), name


def test_every_operator_takes_an_empty_table(empty, no_labels):
    for name, f in _operators(no_labels).items():
        assert f(empty).count() == 0, name


def test_stages_keep_columns_and_take_clashing_ones(spark, messy, empty, no_labels, tmp_path):
    no_labels.write.parquet(f"{tmp_path}/labels.parquet")
    wide = messy
    for c in CLASHING:
        wide = wide.withColumn(c, F.lit("x"))
    for docs in (wide, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            if docs is wide:
                assert out.count() > 0, name
                assert {r[0] for r in out.select("score").collect()} == {"x"}
            else:
                assert out.count() == 0, name
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count()


def test_messy_values(messy, no_labels):
    rows = [tuple(r) for r in jaccard_groups.join(jaccard_groups.keyed(messy)).select("doc_id", "n_shingles", "component_id").collect()]
    assert rows.count((4, 5, 4)) == 2 and (5, 5, 4) in rows
    assert (1, 0, 1) in rows and (2, 0, 2) in rows and (3, 0, 3) in rows
    lic = {r["doc_id"]: r for r in license_join.scan(messy).collect()}
    assert lic[11]["base_labels"] == "cc-by,mit" and (lic[11]["first_word"], lic[11]["last_word"], lic[11]["n_base"]) == (3, 6, 2)
    assert lic[1]["n_words"] == 0 and lic[1]["labels"] == "" and lic[1]["first_word"] is None
    tok = token_counts.section_tokens(messy).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in tok}[2] == 0
    cut = {r["doc_id"]: r for r in _digest(suffix_dedup.with_spans(suffix_dedup.keyed(messy))).collect()}
    assert cut[7]["n_removed"] == cut[8]["n_removed"] == 1800 and cut[1]["n_bytes"] == 0
    assert cut[6]["n_removed"] == 300_000 and cut[10]["n_spans"] == 1


def test_vectors(spark):
    v = [0.6, 0.8, 0.0]
    rows = [(1, v), (2, [0.61, 0.79, 0.01]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 0.0]), (6, [float("nan"), 1.0, 0.0]),
            (7, [0.0, 0.0, 1.0]), (8, []), (9, v), (9, v), (10, [6.0, 8.0, 0.0]), (11, [float("inf"), 1.0, 0.0]), (None, [0.0, -0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("point", F.lit(1))
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in cap_filters.link(df).collect()), key=str)
    want = [(1, 4, 1, True), (2, 4, 1, False), (9, 4, 1, False), (9, 4, 1, False), (10, 4, 1, False), (7, 1, 7, True), (None, 1, 7, False)]
    want += [(k, 0, k, True) for k in (3, 4, 5, 6, 8, 11)]
    assert got == sorted(want, key=str)
    assert cap_filters.link(df.limit(0)).count() == 0
