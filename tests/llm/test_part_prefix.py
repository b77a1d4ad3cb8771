"""Parts on which classes of the Jaccard join meet, and the count of all of them."""

import numpy as np
import pyarrow as pa

from sitewise.llm import jaccard_groups as jg


def test_linked_sets_share_parts_of_each_size_class():
    """Of each size class that two linked sets are both dealt by, at least ``equal_parts`` are equal."""
    rng, linked = np.random.default_rng(7), 0
    for percent in (80, 85):
        for _ in range(400):
            x = np.unique(rng.integers(0, 2**63, int(rng.integers(4, 400)), dtype=np.uint64))
            n = int(rng.integers(0, jg.most_apart(len(x), len(x), percent) + 1))
            y = np.unique(np.concatenate([x[n // 2:], rng.integers(0, 2**63, n - n // 2, dtype=np.uint64)]))
            both = len(np.intersect1d(x, y))
            if 100 * both < percent * (len(x) + len(y) - both) or np.array_equal(x, y):
                continue
            linked += 1
            (a, top_a), (b, top_b) = (jg.parts_of(s, percent) for s in (x, y))
            equal, k = np.intersect1d(a, b), jg.size_class(max(len(x), len(y)), percent)[0]
            assert np.count_nonzero(equal & np.uint64(1) == np.uint64(k & 1)) >= jg.equal_parts(max(top_a, top_b), percent)
    assert linked > 300
    assert jg.equal_parts(jg.size_class(150, 85)[1], 85) > jg.NEED


def test_no_meeting_on_the_parts_of_a_common_passage(spark):
    """Classes that share a few frequent parts, fewer than a link needs, do not
    meet on them; two that share enough meet on their rarest."""
    top = jg.size_class(150, 85)[1]
    after = jg.next_size(top, 85)
    need = min(jg.equal_parts(top, 85), jg.equal_parts(after, 85))
    rows = [(c, 2 * p, 150, 1, top) for c in range(40) for p in range(need - 1)]
    rows += [(c, 1000 + 2 * (c // 2) * need + 2 * p, 150, 1, top) for c in range(40) for p in range(3)]
    shared = spark.createDataFrame(rows, "cid long, key long, n long, w long, top long")
    met = {(r["cid"], r["key"]) for r in jg.meeting(shared, 85).where("met").collect()}
    assert met == {(c, k) for c, k, *_ in rows if k >= 1000}
    asked = spark.createDataFrame([(c, c, c) for c in range(40)], "m long, gid long, component long")
    assert jg.queries_of(shared, asked, 85).count() <= 20
    python = [jg.equal_parts(h, 85) for h in range(1, 900)]
    sql = spark.range(1, 900).select(jg.least_parts(jg.F.col("id"), 85)).collect()
    assert python == [r[0] for r in sql]


def test_counts_of_equal_parts():
    rng = np.random.default_rng(3)
    rows, members, queries = [], [], []
    for role, n_rows in ((0, 30), (1, 20)):
        for i in range(n_rows):
            keys = rng.choice(60, int(rng.integers(1, 25)), replace=False).astype(np.int64) * 2
            row = (9, 0, role, 100 * role + i, i, int(rng.integers(80, 130)), int(rng.integers(80, 130)), keys, rng.integers(1, 4, len(keys)))
            rows.append(row)
            (queries if role else members).append(row)
    cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(7)] + [pa.array([r[k].tolist() for r in rows], pa.list_(pa.int64())) for k in (7, 8)]
    batch = pa.RecordBatch.from_arrays(cols, names=["gid", "chunk", "role", "cid", "component", "n", "top", "keys", "ws"])
    got = {r["q"]: r for b in jg._counts(85)([batch.slice(0, 13), batch.slice(13, 25), batch.slice(38)]) for r in b.to_pylist()}
    for _, _, _, q, _, n, top, keys, ws in queries:
        c, seen = 0, []
        for key, w in zip(keys, ws, strict=True):
            held = [(m[5], m[6], int(m[8][list(m[7]).index(key)])) for m in members if key in m[7]]
            if held and n * 85 <= 100 * max(h[0] for h in held) and 85 * min(h[0] for h in held) <= 100 * n:
                c += min(int(w), max(h[2] for h in held))
                seen += held
        assert (q in got) == bool(seen)
        if seen:
            r = got[q]
            assert (r["c"], r["most"], r["low"], r["high"]) == (c, max(s[0] for s in seen), min(s[1] for s in seen), max(s[1] for s in seen))


def test_keys_of_the_same_groups_meet_once(spark):
    """Keys that nearly all of 40 groups hold bring each two together a few
    times, not once a key; no two groups that share a key are lost."""
    rng, F = np.random.default_rng(5), jg.F
    rows = [(k, g) for k in range(200) for g in range(40) if (k, g) not in {(0, 3), (1, 7), (2, 3)}]
    rows += [(1000 + i, 100 + g) for i in range(60) for g in rng.choice(30, int(rng.integers(1, 25)), replace=False).tolist()]
    cells = spark.createDataFrame([(k, g, 9, g, g + 1000, 100, 100) for k, g in rows], "key long, gid long, size long, c1 long, c2 long, least long, most long")
    joints = jg.joint_keys(cells)
    pairs = jg.group_pairs(cells, joints, 85)
    got = {(r["ga"], r["gb"]): r["joints"] for r in pairs.collect()}
    of = {r["k"]: r["joint"] for r in joints.collect()}
    held = {}
    for k, g in rows:
        held.setdefault(k, []).append(g)
    for k, groups in held.items():
        assert all(of[k] in got[a, b] for a in groups for b in groups if a < b)
    assert sum(len(j) for (a, b), j in got.items() if b < 40) <= 4 * (40 * 39 // 2)


def test_only_classes_of_the_met_parts_ask(spark):
    """Of the classes of a group those ask another one that hold a part on which the two meet."""
    top, n = jg.size_class(30, 85)[1], 30
    rows = [(c, 2 * (100 * (c % 20) + p), n, 1, top) for c in range(40) for p in range(30)]
    shared = spark.createDataFrame(rows, "cid long, key long, n long, w long, top long")
    member = spark.createDataFrame([(c, c // 20, c) for c in range(40)], "m long, gid long, component long")
    # classes c and c + 20 have all parts in common; 5 classes of group 0 lose theirs
    shared = shared.where(~jg.F.col("cid").isin(0, 1, 2, 3, 4))
    asked = {(r["q"], r["gid"]) for r in jg.queries_of(shared, member, 85).collect()}
    assert asked == {(c, 1) for c in range(5, 20)}
