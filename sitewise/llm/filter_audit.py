"""How filters on documents overlap, in every order of applying them.

One pass of a byte transducer over the UTF-8 text counts words, code points,
capitals and symbols, and puts the span of every word into a hash table that
compares bytes, so that distinct words are counted exactly.  The transducer
is two tables over all 256 byte values: ``AFTER``, the state after a byte,
and ``EMIT``, what the byte says in the state it is met in.  The state after
a byte does not depend on the state before it (a separator always ends a
word, any other byte is always inside one), so the run over a text is two
table look-ups for all its bytes at once.

From there on rows are counts: documents collapse to (part, set of failed
filters, labels), and an order of filters matters only through the set of
filters that come before each one.

Null texts are empty texts; a null part is the part ``''``; a null id never
fails the copy filter and makes no other row fail it; rows that repeat an id
and a text fail it only if a smaller id has the text.  Labels of an id that
disagree count if any row has the value.  An empty table has no parts and so
no rows.  Only the named columns are read, others may have any name.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, load, materialize
from .textnp import SPACE, mix, text_chunks

SYMBOLS = b"#$%&*|"
GAP, INSIDE = 0, 1
BEGIN, POINT, CAPITAL, SYMBOL = 1, 2, 4, 8

AFTER = np.where(SPACE, GAP, INSIDE).astype(np.uint8)
_values = np.arange(256)
_said = np.where((_values & 0xC0) != 0x80, POINT, 0) | np.where((_values >= 65) & (_values <= 90), CAPITAL, 0) | np.where(np.isin(_values, list(SYMBOLS)), SYMBOL, 0)
#: by state before the byte, then by byte
EMIT = np.stack([_said | np.where(SPACE, 0, BEGIN), _said]).astype(np.uint8).ravel()

LANES = 8
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def transduce(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and what each byte said, of texts laid end to end."""
    state = AFTER[data]
    before = np.empty(len(data), np.uint16)
    follow = np.empty(len(data), np.uint8)
    if len(data):
        before[0], follow[-1] = GAP, GAP
        before[1:], follow[:-1] = state[:-1], state[1:]
        before[offs[:-1][offs[:-1] < len(data)]] = GAP
        follow[offs[1:][offs[1:] > 0] - 1] = GAP
    out = EMIT[(before << 8) | data]
    return np.flatnonzero(out & BEGIN), np.flatnonzero(state & (follow == GAP)) + 1, out


class SpanTable:
    """Open-addressing table of (text, word) spans with verified entries.

    All spans probe at once: the spans whose slot is free write themselves
    there, then every span compares itself, bytes included, with the entry of
    its slot; those that differ go on to the next slot.  The first eight
    lanes of eight bytes are compared as integers, longer words as bytes.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray):
        self.starts, self.size, self.text = starts, ends - starts, text
        self.data = np.concatenate([data, np.zeros(8, np.uint8)])
        self.lanes = np.ndarray(len(data) + 1, "<u8", self.data, strides=(1,))
        self.entries = self._insert()

    def lane(self, at: np.ndarray, k: int) -> np.ndarray:
        return self.lanes[self.starts[at] + 8 * k] & _MASK[np.clip(self.size[at] - 8 * k, 0, 8)]

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.starts[i] + self.size[i]].tobytes()

    def _hashes(self) -> np.ndarray:
        every = np.arange(len(self.starts))
        h = mix(self.lane(every, 0) + (self.text.astype(np.uint64) << np.uint64(40)) + self.size.astype(np.uint64))
        for k in range(1, LANES):
            at = np.flatnonzero(self.size > 8 * k)
            if not len(at):
                break
            h[at] = mix(h[at] + self.lane(at, k))
        for i in np.flatnonzero(self.size > 8 * LANES).tolist():
            h[i] ^= np.uint64(hash(self.word(i)) & 0xFFFFFFFFFFFFFFFF)
        return mix(h)

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether span a[i] and span b[i] are one word of one text."""
        ok = (self.text[a] == self.text[b]) & (self.size[a] == self.size[b])
        ok &= self.lane(a, 0) == self.lane(b, 0)
        for k in range(1, LANES):
            at = np.flatnonzero(ok & (self.size[a] > 8 * k))
            if not len(at):
                return ok
            ok[at] = self.lane(a[at], k) == self.lane(b[at], k)
        for i in np.flatnonzero(ok & (self.size[a] > 8 * LANES) & (a != b)).tolist():
            ok[i] = self.word(a[i]) == self.word(b[i])
        return ok

    def _insert(self) -> np.ndarray:
        n = len(self.starts)
        room = 1 << max(4, (2 * n).bit_length())
        table = np.full(room, -1, np.int64)
        left, slot = np.arange(n), (self._hashes() & np.uint64(room - 1)).astype(np.int64)
        while len(left):
            free = table[slot] < 0
            table[slot[free]] = left[free]
            go = ~self.same(left, table[slot])
            left, slot = left[go], (slot[go] + 1) & (room - 1)
        return table[table >= 0]


SIGNALS = "n_words long, n_distinct long, n_capitals long, n_points long, n_symbols long"


def _scan(batches):
    """Appends the signals and the SHA-256 of the text to (…, text)."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        for lo, hi, data, offs in text_chunks(batch.column(at)):
            n = hi - lo
            starts, ends, out = transduce(data, offs)
            text = np.repeat(np.arange(n), np.diff(np.searchsorted(starts, offs)))
            table = SpanTable(data, starts, ends, text)
            row_of = lambda flag: np.bincount(np.searchsorted(offs, np.flatnonzero(out & flag), "right") - 1, minlength=n)  # noqa: E731, B023
            points = np.concatenate([[0], np.cumsum((out & POINT) != 0)])
            counts = [np.bincount(text, minlength=n), np.bincount(text[table.entries], minlength=n), row_of(CAPITAL), np.diff(points[offs]), row_of(SYMBOL)]
            raw = data.tobytes()
            digest = [hashlib.sha256(raw[offs[i]:offs[i + 1]]).digest() for i in range(n)]
            rest = [c.slice(lo, n) for i, c in enumerate(batch.columns) if i != at]
            names = [f for i, f in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*rest, *[pa.array(c.astype(np.int64)) for c in counts], pa.array(digest, pa.binary())],
                                             names=[*names, "n_words", "n_distinct", "n_capitals", "n_points", "n_symbols", "digest"])


def signals(docs: DataFrame, part: str = "lang", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, part, the five counts and the digest of the text."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_scan, f"doc_id long, part string, {SIGNALS}, digest binary")


def text_filters() -> dict[str, Column]:
    """Failure conditions of the filters A to D over the columns of :func:`signals`."""
    c = F.col
    return {"A": c("n_words") < 200, "B": 100 * c("n_distinct") < 50 * c("n_words"),
            "C": 100 * c("n_capitals") > 3 * c("n_points"), "D": c("n_symbols") > 0}


def failure_sets(found: DataFrame, labels: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """(part, failed, good, toxic, n): documents by the set of filters that
    they fail, bit i for the i-th of ``filters``, the last bit for the copy
    filter (the text stands under a smaller id too).

    Rows collapse before every shuffle, the copies of one text too: a text has
    one row for each part and pair of labels, whose smallest id is enough to
    say which of its documents fails the copy filter.
    """
    failed = sum((F.when(cond, 1 << i).otherwise(0) for i, cond in enumerate(filters.values())), F.lit(0))
    docs = found.groupBy("doc_id", "digest", "part", failed.alias("failed")).agg(F.count(F.lit(1)).alias("n"))
    lab = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("l_id")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    lab = lab.where("good or toxic")
    docs = docs.join(lab, F.col("doc_id") == F.col("l_id"), "left").fillna(False, ["good", "toxic"])
    texts = docs.groupBy("digest", "failed", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"))
    # what stands once in the table is a text of its own here
    first = texts.groupBy(F.col("digest").alias("t_digest")).agg(F.min("least.doc_id").alias("first_id"))
    texts = texts.join(first, F.col("digest") == F.col("t_digest"))
    firsts = F.col("no_id") + F.when(F.col("least.doc_id") == F.col("first_id"), F.col("least.n")).otherwise(0)
    copy = 1 << len(filters)
    both = F.array(F.struct(F.col("failed"), firsts.alias("n")), F.struct((F.col("failed") + copy).alias("failed"), (F.col("n") - firsts).alias("n")))
    texts = texts.select("part", "good", "toxic", F.explode(both).alias("s"))
    return texts.groupBy("part", "s.failed", "good", "toxic").agg(F.sum("s.n").alias("n"))


def audit(sets: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from ``failure_sets``.

    Counts depend on a filter and on the set of filters before it, so they are
    made once for each such pair (80 for five filters) and looked up by the
    orders, a table whose size the number of letters fixes.
    """
    k = len(letters)
    pairs = F.explode(F.expr(f"sequence(0, {k * 2 ** k - 1})"))
    rows = sets.withColumn("pair", pairs).withColumn("at", F.expr(f"cast(pair div {2 ** k} as int)")).withColumn("earlier", (F.col("pair") % 2 ** k).cast("int"))
    rows = rows.withColumn("bit", F.expr("shiftleft(1, at)")).where("(earlier & bit) = 0")
    fails, gone = F.expr("(failed & bit) <> 0"), F.expr("(failed & earlier) <> 0")

    def count(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("long")

    by = rows.groupBy("part", "at", "earlier").agg(
        count(~fails & ~gone).alias("kept"), count(fails & ~gone).alias("removed"), count(fails & gone).alias("redundant"),
        count(F.col("failed") == F.col("bit")).alias("unique_fails"),
        count(fails & ~gone & F.col("good")).alias("good_lost"), count(fails & ~gone & F.col("toxic")).alias("toxic_lost"))
    before = F.bit_count("earlier")
    orders_so = F.factorial(before) * F.factorial(F.lit(k - 1) - before)  # orders that put just these before it
    by = by.withColumn("shapley", F.sum(F.col("removed") * orders_so).over(Window.partitionBy("part", "at")).cast("long"))
    steps = [("".join(p), i + 1, letters.index(p[i]), sum(1 << letters.index(x) for x in p[:i])) for p in permutations(letters) for i in range(k)]
    orders = sets.sparkSession.createDataFrame(steps, "filter_order string, step int, o_at int, o_earlier int")
    out = by.join(F.broadcast(orders), (F.col("at") == F.col("o_at")) & (F.col("earlier") == F.col("o_earlier")))
    return out.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = materialize(signals(documents(spark, sf_dir)), batch_rows=1000)
    return audit(failure_sets(found, load(spark, sf_dir, "labels"), text_filters()), "ABCDE")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^ \x09-\x0D]+') AS ws FROM d),
l AS (SELECT doc_id AS l_id, coalesce(max(CASE WHEN quality = 1 THEN 1 END), 0) AS good, coalesce(max(CASE WHEN toxic = 1 THEN 1 END), 0) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, concat(
    CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END,
    CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END,
    CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 3 * length(text) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM w LEFT JOIN l ON doc_id = l_id),
g AS (SELECT part, good, toxic, fails, count(*) AS n FROM m GROUP BY ALL),
f(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS own, filter_order[1:step - 1] AS earlier FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT *, contains(fails, own) AS hit, length(translate(fails, earlier, '')) < length(fails) AS gone FROM g, s),
c AS (SELECT part, filter_order, step, own,
    sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN hit AND NOT gone AND good = 1 THEN n ELSE 0 END) AS good_lost,
    sum(CASE WHEN hit AND NOT gone AND toxic = 1 THEN n ELSE 0 END) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM c
"""
