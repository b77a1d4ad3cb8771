"""Licence notices over line ends and next to their relatives."""
import random
import re

from sitewise.llm import license_join
from sitewise.llm.license_join import CONTAINMENT, FAMILIES, MARKS, TEMPLATES, _words


def _wrap(text, width, lead=""):
    lines, line = [], ""
    for w in text.split():
        if line and len(line) + len(w) >= width:
            lines.append(line)
            line = ""
        line += " " + w
    return "\n".join(f"{lead}{x.strip()}" for x in [*lines, line])


def _labels(docs):
    return {r["doc_id"]: set(r["labels"].split(",")) - {""} for r in license_join.scan(docs).collect()}


def test_wrapped_notices_of_each_template(docs_of):
    texts = [_wrap(t, width, lead) for _, t in TEMPLATES for width, lead in ((12, ""), (40, "# "), (72, " * "))]
    got = _labels(docs_of(texts))
    for i in range(len(texts)):
        assert TEMPLATES[i // 3][0] in got[i], texts[i]
    far = "word " * 2000
    assert "bsd" in _labels(docs_of([far + _wrap(TEMPLATES[7][1], 40) + far]))[0]


def test_relatives_are_told_apart(docs_of):
    text = dict(enumerate(t for _, t in TEMPLATES))
    scattered = "It was released last May " + "and then " * 30 + "under a bridge " + "of stone " * 30 + "the licence and license of MIT"
    boost = "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"
    agpl = text[1].replace("GNU General", "GNU Affero General")
    cases = [
        ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc"}), ("Licensed under CC BY-SA 4.0.", {"cc-by", "cc-by-sa"}),
        ("Licensed under CC BY 4.0", {"cc-by"}), (text[1], {"gpl"}), (text[2], {"lgpl"}), (text[2] + " as published by the Free Software Foundation", {"lgpl"}),
        (text[10].replace("Attribution", "Attribution-NonCommercial"), {"cc-like"}), (text[10].replace("Attribution", "Attribution-ShareAlike"), {"cc-like"}),
        (text[7].replace("source and binary", "source or binary"), {"bsd-like"}), (scattered, set()), (boost, {"mit-like"}), (agpl, {"gpl-like"}), (None, set())]
    got = _labels(docs_of([t for t, _ in cases]))
    assert [got[i] for i in range(len(cases))] == [want for _, want in cases]


def test_every_window_by_brute_force(docs_of):
    rng = random.Random(5)
    texts = []
    for k in range(150):
        w = _words(TEMPLATES[k % len(TEMPLATES)][1])
        for _ in range(rng.randint(0, len(w) // 4)):  # around the threshold
            w[rng.randrange(len(w))] = rng.choice(["stone", "the", "of"])
        for _ in range(rng.randint(0, len(w) // 3)):
            w.insert(rng.randrange(len(w)), rng.choice(["river", "license", "under"]))
        sea = [[rng.choice(["table", "the", "license", "of", "under", "to"]) for _ in range(rng.randint(0, 130))] for _ in range(2)]
        texts.append("\n".join(" ".join(x) for x in (sea[0], w, sea[1])))
    found = 0
    for r in license_join.scan(docs_of(texts)).collect():
        words = _words(texts[r["doc_id"]])
        base, best = set(r["base_labels"].split(",")) - {""}, 0.0
        named, met = set(base), set()
        for (label, t), mark in zip(TEMPLATES, MARKS, strict=True):
            size, need = -(-len(_words(t)) * 100 // CONTAINMENT), set(_words(t))
            for i in range(max(1, len(words) - size + 1)):
                share = len(need & set(words[i:i + size]))
                if 100 * share >= CONTAINMENT * len(need):
                    best = max(best, share / len(need))
                    met.add(FAMILIES.get(label, label))
                    if re.search(f" (?:{mark}) ", f" {' '.join(words[i:i + size])} "):
                        named.add(label)
        like = met - {FAMILIES.get(x, x) for x in named}
        assert set(r["labels"].split(",")) - {""} == named | {f"{f}-like" for f in like}, texts[r["doc_id"]]
        assert r["score"] == (1.0 if r["n_base"] else best)
        found += bool(met)
    assert found > 60
