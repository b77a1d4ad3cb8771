"""Exact n-gram Jaccard join with a token-group matrix.

Documents are sets of distinct SHINGLE-word shingles; two link at a Jaccard
similarity of THRESHOLD percent or more.  Identical sets are one class from
the start.  A class's tokens are dealt by hash into parts, a few more than
tokens that two linked sets of its size can differ in, so that at least
``equal_parts`` of two linked classes are equal, token for token.

1. Classes are partitioned into groups of some GROUP_SIZE similar ones: the
   classes of each part, in order of set size, are offered the first of
   fitting size as a pivot, a class joins the pivot it shares most parts with,
   pivots of few classes gather by their most frequent part, and what has
   gathered is dealt out to groups.
2. Each group is opened against itself and its pivot's group, which connects
   what is alike.
3. The token-group matrix holds the union of each group's parts.  A class
   queries the groups, not of its own component alone, whose union shares as
   many parts with it as a link needs, given its size and theirs.  Of two
   groups the smaller one's classes ask.  Classes and groups meet on all but
   the most frequent parts of a class, one fewer than a link needs (prefix
   filter): two classes that link share another one, and a passage that many
   unlike texts share need not bring all of them together.  Parts that nearly
   the same groups hold are joined to one, on which these groups meet once;
   then only the classes that hold one of the parts met on ask.
4. The queries run in two rounds: first one for each pair of components (or
   component and mixed group), the one that shares most parts, after which
   components are contracted; then all those left.  A link inside a component
   would change nothing, so nothing is lost.

To open a group is to bring its texts together once for all its queries (for
many queries, once for every QUERIES of them); there a query is compared with
the members only if its overlap with their token union reaches what any link
needs.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, documents, in_small_batches, materialize
from .textnp import LOWER, mix, shingles, text_chunks, word_hashes, words

SHINGLE = 4
THRESHOLD = 85
NEED = 2  # equal parts that a link has at least; most sets are dealt into more parts
GROUP_SIZE = 64
QUERIES = 256  # to a group that is opened once
LISTED = 1 << 14  # classes of a posting list that is held to be named by them
FEW = 16  # groups that hold a key, which only keys of the same groups are joined with

_SETS = "doc_id long, rk long, n int, d1 long, d2 long"
_PARTS = "n int, d1 long, d2 long, tokens array<long>, top long"
_COUNTS = "q long, own long, gid long, c long, n long, top long, most long, low long, high long"


def shingle_sets(data: np.ndarray, offs: np.ndarray, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row of a chunk."""
    low = LOWER[data]
    starts, ends, first = words(low, offs)
    tok, at = shingles(word_hashes(low, starts, ends), first, shingle)
    for lo, hi in zip(at[:-1], at[1:], strict=True):
        yield np.unique(tok[lo:hi])


def least_overlap(n, percent: int = THRESHOLD):
    """Shingles that a set of n shares with any set it links with."""
    return -(-n * percent // 100)


def most_apart(n: int, m: int, percent: int) -> int:
    """Shingles that stand in one only of two sets of n and m that link, at most."""
    return (n + m) * (100 - percent) // (100 + percent)


def next_size(hi: int, percent: int) -> int:
    """The largest size of the next size class."""
    return max(hi + 1, 100 * hi // percent)


def size_class(n: int, percent: int) -> tuple[int, int]:
    """(number, largest size) of the size class of n: sets that link are of
    one class or of neighbours."""
    k, hi = 0, 1
    while n > hi:
        k, hi = k + 1, next_size(hi, percent)
    return k, hi


def smallest(hi: int, percent: int) -> int:
    """Least size of the sets that are dealt by the size class up to ``hi``."""
    return max(1, hi * percent * percent // 10_000)


def equal_parts(hi: int, percent: int) -> int:
    """Parts of the size class up to ``hi``, at least, that two linked sets
    have equal: the more, the more frequent parts a class need not be met on.
    A part is to hold two tokens of the smallest sets."""
    differ = most_apart(hi, hi, percent)
    return max(NEED, min(6 + differ // 4, smallest(hi, percent) // 2 - differ))


def dealt_parts(lo: int, hi: int, percent: int) -> tuple[int, int]:
    """(parts, empty parts allowed for) into which sets of lo to hi shingles
    are dealt: of two that link all but ``most_apart`` parts are equal."""
    need = most_apart(hi, hi, percent) + equal_parts(hi, percent)
    empty = need * math.exp(-lo / need)
    spare = math.ceil(empty + 3 * math.sqrt(empty))
    return need + spare, spare


def parts_of(tokens: np.ndarray, percent: int = THRESHOLD) -> tuple[np.ndarray, int]:
    """Hashes of the parts of a set, and the largest size of its size class.

    The tokens are dealt by hash into the parts of the set's own size class and
    of the next, where larger partners are.  Sets that link differ in few
    tokens, so ``equal_parts`` at least that are not empty are equal.  A set
    with more empty parts than allowed for shows them too.  The last bit of a
    part's hash tells its size class from the neighbours.
    """
    out = []
    k, top = size_class(len(tokens), percent)
    for k, hi in ((k, top), (k + 1, next_size(top, percent))):
        if not most_apart(hi, hi, percent):
            continue  # only equal sets link, and they are one class
        parts, spare = dealt_parts(smallest(hi, percent), hi, percent)
        salt = mix(np.array([2 * k + 1], np.uint64))[0]
        part = (mix(tokens ^ salt) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        at = part[order]
        head = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        got = np.zeros(parts, np.uint64)
        got[at[head]] = np.add.reduceat(mix(tokens[order] + salt), head)
        held = np.zeros(parts, bool)
        held[at[head]] = True
        if parts - len(head) > spare:
            held[:] = True
        own = np.flatnonzero(held)
        out.append(mix(got[own] ^ mix(own.astype(np.uint64) + salt)) >> np.uint64(1) << np.uint64(1) | np.uint64(k & 1))
    return np.concatenate([*out, np.zeros(0, np.uint64)]), top


def _digests(sets: list[np.ndarray]) -> list[pa.Array]:
    """Size and two digests of each set, alike for equal sets only."""
    d1 = [np.add.reduce(mix(s + np.uint64(0x51ED270B))) for s in sets]
    d2 = [np.bitwise_xor.reduce(mix(s ^ np.uint64(0xB5297A4D3F84D5A7))) if len(s) else np.uint64(0) for s in sets]
    return [pa.array([len(s) for s in sets], pa.int32()), *(pa.array(np.array(d, np.uint64).view(np.int64)) for d in (d1, d2))]


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in text_chunks(batch.column(1)):
                own = [batch.column(k).slice(lo, hi - lo) for k in (0, 2)]
                yield pa.RecordBatch.from_arrays([*own, *_digests(list(shingle_sets(data, offs, shingle)))], names=["doc_id", "rk", "n", "d1", "d2"])
    return run


def _parts(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offs in text_chunks(batch.column(0)):
                sets = [s for s in shingle_sets(data, offs, shingle) if len(s)]
                if not sets:
                    continue
                parts, tops = zip(*(parts_of(s, percent) for s in sets), strict=True)
                tokens = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(p) for p in parts]), pa.int32()), pa.array(np.concatenate(parts).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*_digests(sets), tokens, pa.array(tops, pa.int64())], names=["n", "d1", "d2", "tokens", "top"])
    return run


def _postings(percent: int):
    """Rows sorted by (part, n, cid) with the class's largest size, a stream
    of posting lists.  Lists of one class are dropped.  Kind 0: (pivot, class,
    their largest sizes); kind 1: (class, n, key, largest size).

    Parts of one list (those of a passage that some classes share) get one
    key, a hash of its classes with the parts' last bit, so that they are met
    once and not each by itself.  A list longer than LISTED is passed on as it comes, under a key
    of its own; which parts share a key changes only how they are counted.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = base = own = None
        held: list[tuple[int, int, int]] = []  # (class, n, largest size) of the list at hand
        out: list[tuple] = []

        def close() -> None:
            """The list at hand has ended, or is too long to be held."""
            if own is None and len(held) > 1:
                key = int(mix(np.add.reduce(mix(np.array([h[0] for h in held], np.int64).view(np.uint64) + np.uint64(1)))[None]).view(np.int64)[0]) & ~1 | token & 1
                out.extend((1, c, n, key, at) for c, n, at in held)
            held.clear()

        for batch in batches:
            cols = [batch.column(k).to_numpy() for k in range(4)]
            t = cols[0]
            # only rows that share their token with a neighbour need a look; batch ends always do
            near = np.ones(len(t), bool)
            if len(t) > 2:
                near[1:-1] = (t[1:-1] == t[:-2]) | (t[1:-1] == t[2:])
            for tok, n, c, at in zip(*(x[near].tolist() for x in cols), strict=True):
                if tok != token:
                    close()
                    token, base, own = tok, (n, c, at), None
                    held.append((c, n, at))
                    continue
                if own is None:
                    held.append((c, n, at))
                    if len(held) > LISTED:
                        out.extend((1, hc, hn, tok, hat) for hc, hn, hat in held)
                        own = tok
                else:
                    out.append((1, c, n, own, at))
                if n * percent > 100 * base[0]:
                    base = (n, c, at)
                else:
                    out.append((0, base[1], c, base[2], at))
            if len(out) > 100_000:
                yield _rows(out)
                out = []
        close()
        if out:
            yield _rows(out)
    return run


def _rows(out):
    a = np.array(out, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(a[:, k]) for k in range(5)], names=["kind", "x", "y", "t", "u"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray], percent: int = THRESHOLD) -> Iterator[tuple[int, int, int]]:
    """(i, j, shared tokens) of the pairs that link.  The right sets' token
    union bounds each left set's overlap; only those that can reach what a
    link needs are counted member by member."""
    tokens, owner = np.concatenate(right), np.repeat(np.arange(len(right)), [len(r) for r in right])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    size = np.array([len(r) for r in right])
    for i, x in enumerate(left):
        lo, hi = np.searchsorted(tokens, x, "left"), np.searchsorted(tokens, x, "right")
        held = hi > lo
        if np.count_nonzero(held) < least_overlap(len(x), percent):
            continue
        lo, n = lo[held], (hi - lo)[held]
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        both = np.bincount(owner[at], minlength=len(right))
        for j in np.flatnonzero(100 * both >= percent * (len(x) + size - both)):
            yield i, int(j), int(both[j])


def _texts_of(packed: list[bytes], shingle: int) -> list[np.ndarray]:
    sets: list[np.ndarray] = []
    for _, _, data, offs in text_chunks(pa.array([zlib.decompress(p) for p in packed], pa.large_binary())):
        sets += shingle_sets(data, offs, shingle)
    return sets


def _open(shingle: int, percent: int):
    """Rows sorted by pair of groups (a, b), with the group that a row's class
    is of: at most two groups at a time, their links as a spanning forest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bytes]]] = {}
        last = None
        for batch in batches:
            out: list[tuple[int, int]] = []
            for a, b, g, cid, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, b) != last:
                    out += _links(held, shingle, percent)
                    held, last = {}, (a, b)
                held.setdefault(g, []).append((cid, packed))
            pa.default_memory_pool().release_unused()
            yield _link_rows(out)
        yield _link_rows(_links(held, shingle, percent))
    return run


def _link_rows(out: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _links(held: dict[int, list[tuple[int, bytes]]], shingle: int, percent: int) -> list[tuple[int, int]]:
    groups = [([c for c, _ in members], _texts_of([p for _, p in members], shingle)) for members in held.values()]
    if not groups:
        return []
    (ca, sa), (cb, sb) = groups[0], groups[-1]
    root = {c: c for c in ca + cb}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, j, _ in overlaps(sa, sb, percent):
        p, q = find(ca[i]), find(cb[j])
        if p != q:
            root[max(p, q)] = min(p, q)
    return [(c, find(c)) for c in root if find(c) != c]


def _answer(shingle: int, percent: int):
    """Rows sorted by (group, chunk, role): a group's members, then its
    queries, a few at a time; a query gets one link to each component of the
    group that it links with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, members, sets, asked = None, [], None, []

        def ask() -> list[tuple[int, int]]:
            nonlocal sets, asked
            if not asked or not members:
                return []
            sets = _texts_of([m[2] for m in members], shingle) if sets is None else sets
            found: dict[tuple[int, int], int] = {}
            for i, j, _ in overlaps(_texts_of([p for _, p in asked], shingle), sets, percent):
                found.setdefault((asked[i][0], members[j][1]), members[j][0])
            asked = []
            return [(q, m) for (q, _), m in found.items()]

        for batch in batches:
            out: list[tuple[int, int]] = []
            for g, chunk, role, cid, component, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (g, chunk) != last:
                    out += ask()
                    last, members, sets, asked = (g, chunk), [], None, []
                if role:
                    asked.append((cid, packed))
                else:
                    members.append((cid, component, packed))
                if len(asked) >= GROUP_SIZE:
                    out += ask()
            pa.default_memory_pool().release_unused()
            yield _link_rows(out)
        yield _link_rows(ask())
    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        zipped = [zlib.compress((t.as_py() or "").encode(), 1) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("cid"), pa.array(zipped, pa.binary())], names=["cid", "packed"])
        pa.default_memory_pool().release_unused()


def packed_texts(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(cid, packed): the compressed text of each class's first document.
    Texts move once, after repeated rows have collapsed."""
    def key(i: "F.Column", rk: "F.Column") -> list:  # a null id is an id; no null in the join's keys
        return [F.coalesce(i, F.lit(0)).alias("k1"), i.isNull().alias("k2"), rk.alias("k3")]

    texts = docs.select(*key(F.col("doc_id"), F.col("rk")), "text").groupBy("k1", "k2", "k3").agg(F.first("text").alias("text"))
    wanted = classes.select("cid", *key(F.col("rep.doc_id"), F.col("rep.rk")))
    return materialize(texts.join(wanted, ["k1", "k2", "k3"]).select("cid", "text").mapInArrow(_pack, "cid long, packed binary"))


def opened(pairs: DataFrame, groups: DataFrame, packed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between the classes of each pair of groups (ga, gb)."""
    each = pairs.select("ga", "gb", F.explode(F.array_distinct(F.array("ga", "gb"))).alias("g"))
    rows = each.join(groups.select("cid", "gid"), F.col("g") == F.col("gid")).join(packed, "cid").select("ga", "gb", "g", "cid", "packed")
    return rows.repartition("ga", "gb").sortWithinPartitions("ga", "gb", "g").mapInArrow(_open(shingle, percent), "a long, b long")


def answered(queries: DataFrame, member: DataFrame, packed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) of the classes ``q`` with the groups ``gid`` that they query."""
    load = queries.groupBy("gid").agg(F.ceil(F.count("*") / QUERIES).cast("long").alias("chunks"))
    ask = queries.join(load, "gid").select("gid", F.pmod(F.xxhash64("q"), "chunks").alias("chunk"), F.lit(1).alias("role"), F.col("q").alias("cid"), F.lit(0).cast("long").alias("component"))
    held = member.join(load, "gid").select("gid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("role"), F.col("m").alias("cid"), "component")
    rows = ask.unionByName(held).join(packed, "cid").select("gid", "chunk", "role", "cid", "component", "packed")
    return rows.repartition("gid", "chunk").sortWithinPartitions("gid", "chunk", "role").mapInArrow(_answer(shingle, percent), "a long, b long")


def relabelled(rows: DataFrame, comp: DataFrame, col: str) -> DataFrame:
    """``rows`` with the component column brought up to date; a component is named by one of its classes."""
    now = comp.select(F.col("node").alias("__n"), F.col("component").alias("__c"))
    return rows.join(now, F.col(col) == F.col("__n"), "left").withColumn(col, F.coalesce("__c", col)).drop("__n", "__c")


def group_sizes(member: DataFrame) -> DataFrame:
    """(gid, size, c1, c2): classes and least and greatest component of each group."""
    return member.groupBy("gid").agg(F.count("*").alias("size"), F.min("component").alias("c1"), F.max("component").alias("c2"))


def meeting(shared: DataFrame, percent: int) -> DataFrame:
    """``shared`` with the flag ``met``: of each class and size class all but
    the most frequent parts, one fewer than a link needs.  The order of parts
    is the same for all classes, so the rarest part that two linked classes
    share is flagged for both."""
    count = shared.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("l"))
    after = F.greatest(F.col("top") + 1, F.floor(100 * F.col("top") / percent + 1e-9))
    need = F.least(least_parts(F.col("top"), percent), least_parts(after, percent))
    often = Window.partitionBy("cid", F.col("key").bitwiseAND(1)).orderBy(F.desc("l"), F.desc("key")).rowsBetween(Window.unboundedPreceding, 0)
    rows = shared.join(count, F.col("key") == F.col("k"))
    return rows.withColumn("met", F.sum("w").over(often) >= need).drop("k", "l")


def _union(held: list[tuple]) -> tuple[np.ndarray, ...]:
    """(key, weight, least n, most n, least top, most top) of the parts of a group's classes."""
    keys, order = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
    order = np.argsort(order, kind="stable")
    at = np.searchsorted(np.concatenate([h[0] for h in held])[order], keys)
    w = np.concatenate([h[1] for h in held])[order]
    n, top = (np.repeat([h[k] for h in held], [len(h[0]) for h in held])[order] for k in (2, 3))
    return keys, np.maximum.reduceat(w, at), np.minimum.reduceat(n, at), np.maximum.reduceat(n, at), np.minimum.reduceat(top, at), np.maximum.reduceat(top, at)


def _counts(percent: int):
    """Rows sorted by (group, chunk, role): a group's members with their
    parts, then those of its queries.  Counts the parts of a query that the
    members' union holds for a size that it may link with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, union = None, [], None
        for batch in batches:
            out: list[tuple[int, ...]] = []
            keys, ws = batch.column(7), batch.column(8)
            ends, keys, ws = keys.offsets.to_numpy(), keys.values.to_numpy(), ws.values.to_numpy()
            for i, (g, chunk, role, cid, component, n, top) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True)):
                if (g, chunk) != last:
                    last, held, union = (g, chunk), [], None
                k, w = keys[ends[i]:ends[i + 1]], ws[ends[i]:ends[i + 1]]
                if not role:
                    held.append((k.copy(), w.copy(), n, top))
                    continue
                union = _union(held) if union is None else union
                at = np.minimum(np.searchsorted(union[0], k), len(union[0]) - 1)
                met = (union[0][at] == k) & (n * percent <= 100 * union[3][at]) & (union[2][at] * percent <= 100 * n)
                if met.any():
                    at = at[met]
                    out.append((cid, component, g, int(np.minimum(w[met], union[1][at]).sum()), n, top, int(union[3][at].max()), int(union[4][at].min()), int(union[5][at].max())))
            names = [c.split()[0] for c in _COUNTS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in range(len(names))], names=names)
    return run


def joint_keys(cells: DataFrame) -> DataFrame:
    """(k, joint) of the keys that several groups hold: keys held by the same
    groups have one joint key, of those held by more than FEW groups also keys
    that agree in two min-hashes of them.  Where a joint key stands for lists
    that differ, groups that share none of its keys are compared in vain."""
    least = (lambda seed: F.min(F.xxhash64(F.lit(seed), "gid")))
    keys = cells.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("held"), least(1).alias("h1"), least(2).alias("h2"), F.bit_xor(F.xxhash64("gid")).alias("all"))
    return keys.where("held > 1").select("k", F.when(F.col("held") > FEW, F.xxhash64("h1", "h2")).otherwise(F.xxhash64("held", "all")).alias("joint"))


def group_pairs(cells: DataFrame, joints: DataFrame, percent: int) -> DataFrame:
    """(ga, gb, a_size, b_c1, b_c2, joints): the pairs of groups, the smaller
    one first, that meet, with the joint keys that they meet on."""
    cells = cells.join(joints, F.col("key") == F.col("k")).groupBy("joint", "gid", "size", "c1", "c2").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    a, b = (cells.select("joint", *[F.col(c).alias(f"{side}_{c}") for c in cells.columns[1:]]) for side in "ab")
    smaller = F.struct(F.col("a_size").alias("s"), F.col("a_gid").alias("g")) < F.struct(F.col("b_size").alias("s"), F.col("b_gid").alias("g"))
    fits = (F.col("a_least") * percent <= 100 * F.col("b_most")) & (F.col("b_least") * percent <= 100 * F.col("a_most"))
    # two groups of one component alone tell it nothing; a group was opened against itself
    other = (F.col("a_c1") != F.col("b_c1")) | (F.col("a_c1") != F.col("a_c2")) | (F.col("b_c1") != F.col("b_c2"))
    met = a.join(b, "joint").where(smaller & fits & other)
    return met.groupBy(F.col("a_gid").alias("ga"), F.col("b_gid").alias("gb"), "a_size", "b_c1", "b_c2").agg(F.collect_set("joint").alias("joints"))


def counted(pairs: DataFrame, known: DataFrame, joints: DataFrame, percent: int) -> DataFrame:
    """(q, own, gid, c, ...): the equal parts of the classes of group ``ga``
    that hold a joint key on which it meets group ``gb``, and the union of
    ``gb``, for each pair of groups.  A group's classes move in one row."""
    lists = known.join(joints, F.col("key") == F.col("k"), "left").repartition("gid").groupBy("gid", "cid", "component", "n", "top").agg(
        F.collect_list(F.struct("key", "w")).alias("l"), F.collect_set(F.when(F.col("met"), F.col("joint"))).alias("on"))
    one = F.struct("cid", "component", "n", "top", F.col("l.key").alias("keys"), F.col("l.w").alias("ws"), "on")
    lists = materialize(lists.groupBy("gid").agg(F.collect_list(one).alias("classes")))
    load = pairs.groupBy(F.col("gb").alias("g")).agg(F.ceil(F.sum("a_size") / LISTED).cast("long").alias("chunks"))
    ask = pairs.join(load, F.col("gb") == F.col("g")).join(lists, F.col("ga") == F.col("gid"))
    asks = F.filter("classes", lambda c: F.arrays_overlap(c["on"], "joints") & ((c["component"] != F.col("b_c1")) | (c["component"] != F.col("b_c2"))))
    ask = ask.select(F.col("gb").alias("gid"), F.pmod(F.xxhash64("ga"), "chunks").alias("chunk"), F.lit(1).alias("role"), F.transform(asks, lambda c: c.dropFields("on")).alias("classes"))
    held = lists.join(load, F.col("gid") == F.col("g")).select("gid", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("role"), F.transform("classes", lambda c: c.dropFields("on")).alias("classes"))
    rows = ask.where(F.size("classes") > 0).unionByName(held).repartition("gid", "chunk").sortWithinPartitions("gid", "chunk", "role")
    return rows.select("gid", "chunk", "role", F.inline("classes")).mapInArrow(_counts(percent), _COUNTS)


def queries_of(shared: DataFrame, member: DataFrame, percent: int) -> DataFrame:
    """(q, own, gid, c1, c2, c): the classes and the groups, not of their own
    component alone, that they may link with, with the number of equal parts.
    Groups meet first, each joint key once a group; then the classes of the
    smaller one of two that hold what they met on are counted."""
    sizes = materialize(group_sizes(member))
    known = meeting(shared, percent).join(member.join(sizes, "gid"), F.col("cid") == F.col("m")).select("key", "cid", "n", "w", "top", "met", "gid", "component", "size", "c1", "c2")
    useful = known.groupBy("key").agg(F.min("component").alias("k1"), F.max("component").alias("k2")).where("k1 < k2").select(F.col("key").alias("uk"))
    known = materialize(known.join(useful, F.col("key") == F.col("uk"), "left_semi"))
    cells = materialize(known.where("met").groupBy("key", "gid", "size", "c1", "c2").agg(F.min("n").alias("least"), F.max("n").alias("most")))
    joints = materialize(joint_keys(cells))
    pairs = materialize(group_pairs(cells, joints, percent))
    met = counted(pairs, known, joints, percent).join(sizes.select("gid", "c1", "c2"), "gid")
    most = F.least("most", F.floor(100 * F.col("n") / percent + 1e-9))
    return met.where(F.col("c") >= least_equal(F.col("n"), F.col("top"), most, F.col("low"), F.col("high"), percent)).select("q", "own", "gid", "c1", "c2", "c")


def apart(n: "F.Column", m: "F.Column", percent: int) -> "F.Column":
    """``most_apart`` of columns."""
    return F.floor((n + m) * (100 - percent) / (100 + percent) + 1e-9)


def least_equal(n: "F.Column", top: "F.Column", most: "F.Column", low: "F.Column", high: "F.Column", percent: int) -> "F.Column":
    """Equal parts of a set of n, in the size class up to ``top``, and any that
    it links with among sets up to ``most``, in size classes up to ``low`` to
    ``high``: sets of one class also meet in the next."""
    hi, differ = F.greatest(top, low), apart(n, most, percent)
    after = F.greatest(hi + 1, F.floor(100 * hi / percent + 1e-9))
    again = F.when((top == low) & (top == high), apart(after, after, percent) + least_parts(after, percent) - differ).otherwise(0)
    return F.greatest(F.lit(NEED), apart(hi, hi, percent) + least_parts(hi, percent) - differ + again)


def least_parts(hi: "F.Column", percent: int) -> "F.Column":
    """``equal_parts`` of a column."""
    differ = apart(hi, hi, percent)
    smallest = F.greatest(F.lit(1), F.floor(hi * percent * percent / 10_000 + 1e-9))
    return F.greatest(F.lit(NEED), F.least(6 + F.floor(differ / 4), F.floor(smallest / 2) - differ))


def join(docs: DataFrame, shingle: int = SHINGLE, percent: int = THRESHOLD) -> DataFrame:
    """(doc_id, rk, n_shingles, component_id, first) for ``keyed`` documents;
    first: the row is the one of its component that stays when one does (with
    repeated rows, each copy of that row).

    Null, empty and blank texts have no shingles and form a component each.
    Rows with one id but different texts are documents of their own; a null id
    never names a component that has another id.  An empty table gives an
    empty result.
    """
    sets = materialize(docs.select("doc_id", "text", "rk").mapInArrow(_sets(shingle), _SETS))
    key = ["n", "d1", "d2"]
    classes = sets.where("n > 0").groupBy(*key).agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "rk")).alias("rep"))
    classes = materialize(classes.withColumn("cid", F.monotonically_increasing_id()))
    lists = docs.select("text").mapInArrow(_parts(shingle, percent), _PARTS).groupBy(*key).agg(F.first("tokens").alias("tokens"), F.first("top").alias("top"))
    lists = lists.join(classes.select(*key, "cid"), key).select(F.explode("tokens").alias("token"), F.col("n").cast("long").alias("n"), "cid", "top")
    lists = lists.repartition("token").sortWithinPartitions("token", "n", "cid")
    scan = materialize(lists.mapInArrow(_postings(percent), "kind long, x long, y long, t long, u long"))

    # 1. groups
    shared = scan.where("kind = 1").groupBy(F.col("x").alias("cid"), F.col("t").alias("key")).agg(F.first("y").alias("n"), F.count("*").alias("w"), F.first("u").alias("top"))
    shared = materialize(shared)
    near = scan.where("kind = 0").groupBy("x", "y").agg(F.count("*").alias("c"), F.max("t").alias("px"), F.max("u").alias("py"))
    # a quarter of the parts is taken as alike; groups of any make-up are exact, those of similar classes are few
    larger = F.greatest("px", "py")
    near = near.where(4 * F.col("c") >= apart(larger, larger, percent) + least_parts(larger, percent))
    best = near.groupBy("y").agg(F.max(F.struct("c", (-F.col("x")).alias("p"))).alias("best"))
    best = materialize(best.select(F.col("y").alias("cid"), (-F.col("best.p")).alias("pivot")))
    pivots = best.select(F.col("pivot").alias("cid")).distinct()
    pivoted = best.join(pivots, "cid", "left_anti").unionByName(pivots.withColumn("pivot", F.col("cid")))
    pivoted = shared.select("cid").distinct().join(pivoted, "cid", "left").select("cid", F.coalesce("pivot", "cid").alias("pivot"))
    # a pivot of few classes goes with the others that hold its most frequent part
    count = shared.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("l"))
    common = shared.join(count, F.col("key") == F.col("k")).groupBy(F.col("cid").alias("p")).agg(F.max(F.struct("l", "key"))["key"].alias("common"))
    few = F.col("members") < GROUP_SIZE
    sized = pivoted.groupBy(F.col("pivot").alias("p")).agg(F.count("*").alias("members")).join(common, "p").select("p", few.alias("few"), F.when(few, F.col("common")).otherwise(F.col("p")).alias("base"), "members")
    dealt = sized.groupBy("few", "base").agg(F.ceil(F.sum("members") / GROUP_SIZE).alias("k"))
    sized = sized.join(dealt, ["few", "base"])
    of = (lambda c: F.xxhash64("few", "base", F.pmod(F.xxhash64(c), "k")))
    groups = materialize(pivoted.join(sized, F.col("pivot") == F.col("p")).select("cid", of(F.when(F.col("few"), F.col("pivot")).otherwise(F.col("cid"))).alias("gid"), of("pivot").alias("home")))
    # 2. each group with itself and with its pivot's
    own = groups.join(groups.groupBy(F.col("gid").alias("g")).agg(F.count("*").alias("size")).where("size > 1"), F.col("gid") == F.col("g")).select(F.explode(F.array(F.struct(F.col("gid").alias("ga"), F.col("gid").alias("gb")), F.struct(F.least("gid", "home").alias("ga"), F.greatest("gid", "home").alias("gb")))).alias("s")).select("s.*").distinct()
    packed = packed_texts(docs, classes.join(shared.select("cid").distinct(), "cid", "left_semi"))
    links = materialize(opened(own, groups, packed, shingle, percent))
    comp = materialize(components(links))
    # 3. queries by the matrix
    member = materialize(groups.join(comp, F.col("cid") == F.col("node"), "left").select(F.col("cid").alias("m"), "gid", F.coalesce("component", "cid").alias("component")))
    asked = materialize(queries_of(shared, member, percent))
    # 4. the best query of each component to another, or to a mixed group; then what is left between different ones
    whom = F.when(F.col("c1") == F.col("c2"), F.struct(F.least("own", "c1").alias("s1"), F.greatest("own", "c1").alias("s2"), F.lit(False).alias("mixed"))).otherwise(
        F.struct(F.col("own").alias("s1"), F.col("gid").alias("s2"), F.lit(True).alias("mixed")))
    best = materialize(asked.groupBy(whom.alias("whom")).agg(F.max_by(F.struct("q", "gid"), "c").alias("b")).select("b.*"))
    first = materialize(answered(best, member, packed, shingle, percent))
    comp = materialize(components(links.unionByName(first)))
    member = materialize(relabelled(member, comp, "component"))
    now = group_sizes(member).select(F.col("gid").alias("g"), F.col("c1").alias("n1"), F.col("c2").alias("n2"))
    left = relabelled(asked, comp, "own").join(now, F.col("gid") == F.col("g")).where("own <> n1 or own <> n2").select("q", "gid")
    left = materialize(left.join(best, ["q", "gid"], "left_anti"))
    more = answered(left, member, packed, shingle, percent)
    comp = components(links.unionByName(first).unionByName(more))

    # components named by their least document
    named = classes.select("cid", *key, "rep").join(comp, F.col("cid") == F.col("node"), "left")
    named = materialize(named.select(F.coalesce("component", "cid").alias("root"), "rep", *[F.col(k).alias(f"c_{k}") for k in key]))
    least = named.groupBy("root").agg(F.min("rep").alias("head")).withColumnRenamed("root", "r")
    named = named.join(least, F.col("root") == F.col("r")).select("head", *[f"c_{k}" for k in key])
    rows = sets.select("doc_id", "rk", *key).join(named, (F.col("n") == F.col("c_n")) & (F.col("d1") == F.col("c_d1")) & (F.col("d2") == F.col("c_d2")), "left")
    linked = F.col("head").isNotNull()
    return rows.select(
        "doc_id", "rk", F.col("n").cast("long").alias("n_shingles"),
        F.when(linked, F.coalesce(F.col("head.doc_id"), F.col("doc_id"))).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(linked, F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("rk") == F.col("head.rk"))).otherwise(True).alias("first"))


def keyed(docs: DataFrame) -> DataFrame:
    return in_small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("rk"))


def op8_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(keyed(documents(spark, sf_dir))).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = THRESHOLD) -> DataFrame:
    """The documents, all columns, one of each component; of repeated rows that
    agree in id and text one stays, with the first of their other columns."""
    def key(i: str, rk: "F.Column") -> list:  # a null id is an id; no null in the join's keys
        return [F.coalesce(F.col(i).cast("long"), F.lit(0)).alias("k1"), F.col(i).isNull().alias("k2"), rk.alias("k3")]

    keep = join(keyed(docs), shingle, percent).where("first").select(*key("doc_id", F.col("rk"))).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # texts move once: repeated rows collapse and the join finds them dealt out by its keys
    rows = rows.select("row", *key("row.doc_id", F.xxhash64("row.text"))).groupBy("k1", "k2", "k3").agg(F.first("row").alias("row"))
    return rows.join(keep, ["k1", "k2", "k3"], "left_semi").select("row.*")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x0b\x0c\r]', ' ', 'g'), '[^ \x09\n]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS root FROM documents UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(r.root) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.x = d.doc_id GROUP BY ALL
"""
