"""Exact substring dedup with suffix arrays built shard by shard.

Every byte covered by a ``MIN_MATCH``-byte string that also starts anywhere
else in the corpus is removed.  The work is dealt out by content:

1. Each window of MIN_MATCH bytes has a key, the least hash of the GRAM-byte
   strings inside it.  Equal windows have equal keys wherever they stand, and
   neighbouring windows mostly share theirs, so a document becomes a few runs
   of windows; a run's context is all the bytes its windows cover.
2. A run whose key occurs nowhere else holds no match and is dropped.  Runs
   with identical contexts are matches throughout; they count as one.
3. The distinct contexts of a key form a shard (small ones share a task, a
   large one is split).  A shard's suffixes are sorted by Larsson-Sadakane
   refinement, common prefixes come from Kasai's recurrence, and a window
   whose neighbour shares MIN_MATCH bytes is a match.
4. The shards of a split key are merged by binary search of each one's sorted
   window classes in the others'.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import documents, in_small_batches, materialize
from .textnp import CHUNK_BYTES, _BASE2, _powers, mix, prefix_hash, sliding_min, span_hash, text_chunks

MIN_MATCH = 400
GRAM = 200
SHARD_BYTES = 1 << 20
MERGE_WINDOWS = 1 << 18

_RUNS = "doc_id long, rk long, key long, dig long, s0 int, n int, inner boolean"
_FOUND = "doc_id long, rk long, lo int, hi int, key long, part int, sub int, windows binary"


# -- 1. runs of windows with one key ----------------------------------------------------------

def window_runs(data: np.ndarray, offs: np.ndarray, match: int = MIN_MATCH, gram: int = GRAM):
    """(row, start, windows, key, context digest, inner) of each run in a chunk;
    inner: the key's string stands in the context more than once."""
    n, w = len(data), match - gram + 1
    if n < match:
        return None
    prefix = prefix_hash(data)
    inverse = _powers(n + 1, np.uint64(0x9E3779B97F4A7C15 | 1))[1]
    grams = mix((prefix[gram:] - prefix[:-gram]) * inverse[:n - gram + 1])
    least = sliding_min(grams, w)
    edge = np.zeros(len(least) + 1, np.int32)
    long_enough = np.diff(offs) >= match
    np.add.at(edge, offs[:-1][long_enough], 1)
    np.add.at(edge, offs[1:][long_enough] - match + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1])
    heads = offs[:-1]
    new[heads[heads < len(least)]] = True
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(least))
    start, stop = start[valid[start]], stop[valid[start]]
    if not len(start):
        return None
    prefix2 = prefix_hash(data, _BASE2)
    digest = span_hash(prefix2, start, stop - 1 + match, _BASE2)
    key = least[start]
    # places of keys: grams that are the least of some window over them
    rim = np.zeros(w - 1, np.uint64)
    spots = np.flatnonzero(grams == ~sliding_min(~np.concatenate([rim, least, rim]), w))
    values, ids = np.unique(grams[spots], return_inverse=True)
    places = np.sort(ids * np.int64(n + 1) + spots)
    own = np.searchsorted(values, key) * np.int64(n + 1)
    inner = np.searchsorted(places, own + stop - 1 + w) - np.searchsorted(places, own + start) > 1
    row = np.searchsorted(offs, start, "right") - 1
    return row, start - offs[row], stop - start, key, digest, inner


def _runs(match: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rks = batch.column(0), batch.column(2)
            for lo, _, data, offs in text_chunks(batch.column(1)):
                found = window_runs(data, offs, match, gram)
                if found is None:
                    continue
                row, start, n, key, digest, inner = found
                take = pa.array(row + lo)
                yield pa.RecordBatch.from_arrays([
                    ids.take(take), rks.take(take), pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)),
                    pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(inner)],
                    names=["doc_id", "rk", "key", "dig", "s0", "n", "inner"])
    return run


# -- 3. suffix arrays -------------------------------------------------------------------------

def suffix_array(data: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Suffixes in order, equal ones by place, by Larsson and
    Sadakane's refinement: suffixes that share a prefix of h bytes are ordered
    by the group h bytes further on, and only groups that are still open are
    sorted again.  ``left``: bytes to the end of each suffix's own text, where
    the suffix ends; a shorter one comes first."""
    n = len(data)
    head = np.zeros(n, np.uint64)
    for k in range(7):
        byte = np.zeros(n, np.uint64)
        byte[:max(0, n - k)] = data[k:]
        byte[left <= k] = 0
        head = (head << np.uint64(8)) | byte
    head = (head << np.uint64(8)) | np.minimum(left, 7).astype(np.uint64)
    sa = np.argsort(head, kind="stable")
    head = head[sa]
    new = np.ones(n, bool)
    new[1:] = head[1:] != head[:-1]
    rank = np.empty(n, np.int64)
    rank[sa] = np.flatnonzero(new)[np.cumsum(new) - 1]
    alone = new & np.append(new[1:], True)
    open_ = np.flatnonzero(~alone)
    h = 7
    while len(open_):
        at = sa[open_]
        going = left[at] > h
        second = np.zeros(len(at), np.int64)
        second[going] = rank[at[going] + h] + 1
        both = rank[at] * (n + 1) + second
        order = np.argsort(both, kind="stable")
        at, both, going = at[order], both[order], going[order]
        sa[open_] = at
        new = np.ones(len(at), bool)
        new[1:] = both[1:] != both[:-1]
        first = np.flatnonzero(new)
        rank[at] = open_[first[np.cumsum(new) - 1]]
        alone = new & np.append(new[1:], True)
        open_ = open_[~alone & going]  # suffixes that ended are equal, nothing is left to order
        h *= 2
    return sa


def common_prefixes(data: np.ndarray, left: np.ndarray, sa: np.ndarray, starts: np.ndarray, cap: int = MIN_MATCH, block: int = 128) -> np.ndarray:
    """Common prefix (up to ``cap``) of each position in ``starts`` (ascending)
    with its predecessor in the suffix array, by Kasai's recurrence: the next
    position's prefix is at least this one's less one.  Runs of consecutive
    positions are cut into blocks that advance in step."""
    before = np.full(len(data), -1, np.int64)
    before[sa[1:]] = sa[:-1]
    if not len(starts):
        return np.zeros(0, np.int64)
    fence = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.lib.stride_tricks.sliding_window_view(fence, 8)[:len(data) + 1].copy().view(np.uint64).ravel()
    out = np.zeros(len(starts), np.int64)
    head = np.ones(len(starts), bool)
    head[1:] = starts[1:] != starts[:-1] + 1
    first = np.flatnonzero(head)
    size = np.diff(np.append(first, len(starts)))
    lanes = np.concatenate([np.arange(f, f + s, block) for f, s in zip(first, size, strict=True)]) if len(first) else first
    ends = np.minimum(lanes + block, (first + size)[np.searchsorted(first, lanes, "right") - 1])
    known = np.zeros(len(lanes), np.int64)
    for step in range(block):
        live = np.flatnonzero(lanes + step < ends)
        if not len(live):
            break
        i = lanes[live] + step
        p = starts[i]
        q = before[p]
        limit = np.where(q < 0, 0, np.minimum(np.minimum(left[p], left[q]), cap))
        got = np.minimum(np.maximum(known[live] - 1, 0), limit)
        grow = np.flatnonzero(got < limit)
        while len(grow):
            x = word[p[grow] + got[grow]] ^ word[q[grow] + got[grow]]
            same = np.where(x == 0, 8, 0)
            diff = x != 0
            if diff.any():
                low = x[diff] & (~x[diff] + np.uint64(1))  # lowest set bit: its byte is the first difference
                same[diff] = np.log2(low.astype(np.float64)).astype(np.int64) >> 3
            got[grow] = np.minimum(got[grow] + same, limit[grow])
            grow = grow[(same == 8) & (got[grow] < limit[grow])]
        out[i] = got
        known[live] = got
    return out


def repeated_windows(contexts: list[bytes], match: int = MIN_MATCH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, start, repeated) for every window of ``match`` bytes in the
    contexts; repeated: the same bytes start at another place in them."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    left = ends[owner] - np.arange(len(data))
    starts = np.flatnonzero(left >= match)
    sa = suffix_array(data, left)
    lcp = common_prefixes(data, left, sa, starts, match)
    hit = np.zeros(len(data), bool)
    found = starts[lcp >= match]
    place = np.empty(len(data), np.int64)
    place[sa] = np.arange(len(sa))
    hit[found] = True
    hit[sa[place[found] - 1]] = True
    return owner[starts], starts - (ends - sizes)[owner[starts]], hit[starts]


def _intervals(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    step = np.diff(np.concatenate([[0], flag.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _digests(ctx: bytes, starts: np.ndarray, match: int) -> np.ndarray:
    data = np.frombuffer(ctx, np.uint8)
    one = span_hash(prefix_hash(data), starts, starts + match)
    two = span_hash(prefix_hash(data, _BASE2), starts, starts + match, _BASE2)
    out = np.empty(len(starts), [("a", "<u8"), ("b", "<u8"), ("ref", "<i8"), ("start", "<i8")])
    out["a"], out["b"], out["start"] = one, two, starts
    return out


def _sort_shards(match: int):
    """Rows sorted by (key, sub); whole groups are gathered up to SHARD_BYTES
    and share one suffix array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size, last = 0, None
        for batch in batches:
            for r in batch.to_pylist():
                k = (r["key"], r["sub"])
                if k != last and size >= SHARD_BYTES:
                    yield from _sort_shard(held, match)
                    held, size = [], 0
                last = k
                held.append(r)
                size += len(r["ctx"])
        if held:
            yield from _sort_shard(held, match)
    return run


def _sort_shard(rows: list[dict], match: int = MIN_MATCH) -> Iterator[pa.RecordBatch]:
    owner, start, hit = repeated_windows([r["ctx"] for r in rows], match)
    bound = np.searchsorted(owner, np.arange(len(rows) + 1))
    out: list[tuple] = []
    split: dict[tuple, list] = {}
    for i, r in enumerate(rows):
        flags = hit[bound[i]:bound[i + 1]]
        if r["c"] == 1:
            for lo, hi in zip(*_intervals(flags), strict=True):
                out.append((r["doc_id"], r["rk"], r["s0"] + int(lo), r["s0"] + int(hi) - 1 + match, r["key"], 0, -1, None))
        if r["nsub"] > 1:  # what other shards of this key must know
            d = _digests(r["ctx"], np.arange(len(flags)), match)
            d["ref"] = np.where(flags | (r["c"] > 1), -1, i)
            parts = max(1, -(-r["windows"] // MERGE_WINDOWS))
            part = (d["a"] % np.uint64(parts)).astype(int)
            for p in np.unique(part):
                split.setdefault((r["key"], r["sub"], int(p)), []).append(d[part == p])
    for (key, sub, p), many in split.items():
        d = np.concatenate(many)
        d = d[np.lexsort((d["ref"], d["b"], d["a"]))]
        keep = np.ones(len(d), bool)
        keep[1:] = (d["a"][1:] != d["a"][:-1]) | (d["b"][1:] != d["b"][:-1])  # one row a class: a class met twice has only -1
        d = d[keep]
        refs = np.unique(d["ref"][d["ref"] >= 0])
        table = [(rows[i]["doc_id"], rows[i]["rk"], rows[i]["s0"]) for i in refs]
        d["ref"] = np.where(d["ref"] >= 0, np.searchsorted(refs, d["ref"]), -1)
        out.append((None, 0, 0, 0, key, p, sub, _pack(d, table)))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate(
            (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
            names=["doc_id", "rk", "lo", "hi", "key", "part", "sub", "windows"])


# -- 4. merging the shards of a split key -----------------------------------------------------

_REF = np.dtype([("null", "<i8"), ("doc_id", "<i8"), ("rk", "<i8"), ("s0", "<i8")])


def _pack(d: np.ndarray, table: list[tuple]) -> bytes:
    refs = np.array([(t[0] is None, t[0] or 0, t[1], t[2]) for t in table], _REF)
    return np.int64(len(refs)).tobytes() + refs.tobytes() + d.tobytes()


def _unpack(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(b[:8], np.int64)[0])
    cut = 8 + n * _REF.itemsize
    return np.frombuffer(b[8:cut], _REF), np.frombuffer(b[cut:], [("a", "<u8"), ("b", "<u8"), ("ref", "<i8"), ("start", "<i8")])


def shared_classes(shards: list[np.ndarray]) -> list[np.ndarray]:
    """For shards of distinct sorted window classes: which classes of each
    stand in another one too, by binary search in the merged order."""
    every = np.sort(np.concatenate([s[["a", "b"]] for s in shards]), order=("a", "b"))
    out = []
    for s in shards:
        lo = np.searchsorted(every["a"], s["a"], "left")
        hi = np.searchsorted(every["a"], s["a"], "right")
        n = hi - lo
        for i in np.flatnonzero(n > 1):  # ties of the first half: compare the second
            n[i] = np.count_nonzero(every["b"][lo[i]:hi[i]] == s["b"][i])
        out.append(n > 1)
    return out


def _merge(match: int):
    """Finished spans pass; the shards of one (key, part) are merged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        last = None
        for batch in batches:
            subs = np.array(batch.column("sub").to_pylist())
            done = batch.filter(pa.array(subs < 0))
            if done.num_rows:
                yield done.select(["doc_id", "rk", "lo", "hi"])
            for r in batch.filter(pa.array(subs >= 0)).to_pylist():
                if (r["key"], r["part"]) != last:
                    yield from _merge_key(held, match)
                    held, last = [], (r["key"], r["part"])
                held.append(r["windows"])
        yield from _merge_key(held, match)
    return run


def _merge_key(packed: list[bytes], match: int = MIN_MATCH) -> Iterator[pa.RecordBatch]:
    if len(packed) < 2:
        return
    refs, shards = zip(*map(_unpack, packed), strict=True)
    out: list[tuple] = []
    for table, s, hit in zip(refs, shards, shared_classes(list(shards)), strict=True):
        s = s[hit & (s["ref"] >= 0)]
        for r in np.unique(s["ref"]):
            t, at = table[r], np.sort(s["start"][s["ref"] == r])
            cut = np.flatnonzero(np.diff(at) > 1)
            for lo, hi in zip(at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)], strict=True):
                out.append((None if t["null"] else int(t["doc_id"]), int(t["rk"]), int(t["s0"] + lo), int(t["s0"] + hi + match)))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([o[j] for o in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["doc_id", "rk", "lo", "hi"])


# -- the operator -----------------------------------------------------------------------------

def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text, rk): rows with one id and one text are the same document twice."""
    return in_small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.xxhash64(text).alias("rk"))


def repeated_spans(docs: DataFrame, match: int = MIN_MATCH, gram: int = GRAM) -> DataFrame:
    """(doc_id, rk, lo, hi) byte ranges to remove from ``keyed`` documents,
    ranges may overlap: all that is covered by ``match``-byte strings that
    stand twice.  ``gram``, at most ``match``, is the length of the strings
    whose hashes key the windows; any length gives the same ranges."""
    runs = materialize(docs.mapInArrow(_runs(match, gram), _RUNS))
    keys = runs.groupBy("key").agg(F.count("*").alias("n_key"), F.min("dig").alias("least"), F.max("dig").alias("most"), F.max("inner").alias("any_inner"))
    keys = keys.where("n_key > 1 or any_inner").select(F.col("key").alias("k"), (F.col("least") != F.col("most")).alias("mixed"), F.col("n_key"))
    met = materialize(runs.join(keys, F.col("key") == F.col("k")).drop("k"))
    whole = met.where("not mixed and n_key > 1")
    unsure = met.where("mixed or n_key = 1")
    contexts = unsure.groupBy("key", "dig").agg(F.count("*").alias("c"), F.min(F.struct("s0", "n", "rk", "doc_id")).alias("ref"))
    sizes = contexts.groupBy("key").agg(F.sum(F.col("ref.n") + match).alias("bytes"), F.sum(F.col("ref.n").cast("long")).alias("windows"), F.min("c").alias("rarest"))
    sizes = sizes.where("rarest = 1").select(F.col("key").alias("k"), "windows", F.ceil(F.col("bytes") / SHARD_BYTES).cast("int").alias("nsub"))
    again = contexts.where("c > 1").select(F.col("key").alias("k"), F.col("dig").alias("g"))
    whole = whole.select("doc_id", "rk", "s0", "n").unionByName(unsure.join(again, (F.col("key") == F.col("k")) & (F.col("dig") == F.col("g"))).select("doc_id", "rk", "s0", "n"))
    whole = whole.select("doc_id", "rk", F.col("s0").alias("lo"), (F.col("s0") + F.col("n") + F.lit(match - 1)).alias("hi"))
    shard = contexts.join(sizes, F.col("key") == F.col("k")).select("key", F.pmod("dig", "nsub").cast("int").alias("sub"), "nsub", "windows", "c", F.col("ref.doc_id").alias("r_id"), F.col("ref.rk").alias("r_rk"), F.col("ref.s0").alias("s0"), F.col("ref.n").alias("n"))
    shard = docs.join(shard, F.col("doc_id").eqNullSafe(F.col("r_id")) & F.col("rk").eqNullSafe(F.col("r_rk")))
    ctx = F.substring(F.col("text").cast("binary"), F.col("s0") + 1, F.col("n") + F.lit(match - 1))
    # repeated rows of one document bring its contexts again: once is enough
    shard = shard.select("key", "sub", "nsub", "windows", "c", "doc_id", "rk", "s0", ctx.alias("ctx")).dropDuplicates(["key", "sub", "doc_id", "rk", "s0"])
    found = shard.repartition("key", "sub").sortWithinPartitions("key", "sub").mapInArrow(_sort_shards(match), _FOUND)
    found = found.repartition("key", "part", F.when(F.col("sub") < 0, F.col("rk")).otherwise(0)).sortWithinPartitions("key", "part", "sub").mapInArrow(_merge(match), "doc_id long, rk long, lo int, hi int")
    return whole.unionByName(found)


def merged_spans(spans: DataFrame) -> DataFrame:
    """One row per document: its ranges as a list (bounded by its length)."""
    return spans.distinct().groupBy("doc_id", "rk").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")).select(F.col("doc_id").alias("s_id"), F.col("rk").alias("s_rk"), "spans")


def with_spans(docs: DataFrame) -> DataFrame:
    """``keyed`` documents with their list of ranges, null where nothing repeats."""
    spans = merged_spans(repeated_spans(docs))
    return docs.join(spans, F.col("doc_id").eqNullSafe(F.col("s_id")) & F.col("rk").eqNullSafe(F.col("s_rk")), "left").drop("s_id", "s_rk")


def cut(raw: bytes, spans: list[dict] | None) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes outside all ranges, and the maximal removed ranges."""
    if not spans:
        return raw, []
    merged: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    kept, at = [], 0
    for lo, hi in merged:
        kept.append(raw[at:lo])
        at = hi
    kept.append(raw[at:])
    return b"".join(kept), [(lo, hi) for lo, hi in merged]


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text")
        spans = batch.column("spans").to_pylist()
        n_bytes, n_removed, n_spans, sha = [], [], [], []
        for i, s in enumerate(spans):
            raw = texts[i].as_buffer()
            raw = b"" if raw is None else raw.to_pybytes()
            kept, gone = cut(raw, s)
            n_bytes.append(len(raw))
            n_removed.append(len(raw) - len(kept))
            n_spans.append(len(gone))
            sha.append(hashlib.sha256(kept).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and empty texts have 0 bytes, nothing removed and the digest of no
    bytes; texts under MIN_MATCH bytes are kept whole; repeated rows count as
    repeats of each other."""
    rows = with_spans(keyed(documents(spark, sf_dir)))
    return rows.select("doc_id", "text", "spans").mapInArrow(_digest_rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def long_ranges(raw: bytes, spans: list[dict] | None, min_words: int) -> list[dict]:
    """The maximal ranges of ``spans`` that hold at least ``min_words`` words,
    a word cut by an end counting as one."""
    return [{"lo": lo, "hi": hi} for lo, hi in cut(raw, spans)[1] if len(raw[lo:hi].split()) >= min_words]


def _cut_text(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, spans = batch.column(0), batch.column(1).to_pylist()
            names = [f.name for f in row.type]
            cols = dict(zip(names, row.flatten(), strict=True))
            old = cols["text"].to_pylist()
            spans = [s if t is None or not s else long_ranges(t.encode(), s, min_words) for t, s in zip(old, spans, strict=True)]
            # a range may begin or end inside a character; what is left of it goes too
            new = [t if t is None or not s else cut(t.encode(), s)[0].decode("utf-8", "ignore") for t, s in zip(old, spans, strict=True)]
            cols["text"] = pa.array(new, row.type.field("text").type)
            if "n_chars" in cols:
                sizes = [len(t) if s and t is not None else n for t, s, n in zip(new, spans, cols["n_chars"].to_pylist(), strict=True)]
                cols["n_chars"] = pa.array(sizes, row.type.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([cols[n] for n in names], fields=list(row.type))], names=["row"])
    return run


def remove_repeats(docs: DataFrame, match: int = MIN_MATCH, gram: int = GRAM, min_words: int = 0) -> DataFrame:
    """The documents, all columns, with repeated byte ranges cut from ``text``
    (and ``n_chars``, where there is one, brought up to date).  Ranges under
    ``min_words`` words stay."""
    spans = merged_spans(repeated_spans(keyed(docs), match, gram))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("s_id")) & F.xxhash64("row.text").eqNullSafe(F.col("s_rk"))
    rows = rows.join(spans, same, "left").select("row", "spans")
    return rows.mapInArrow(_cut_text(min_words), StructType([rows.schema["row"]])).select("row.*")


__all__ = ["CHUNK_BYTES", "op2_suffix_dedup", "remove_repeats", "repeated_windows", "suffix_array", "with_spans"]
