"""Token counts per section by offset-mapped attribution.

A document is encoded once, whole, so its tokens are those a model sees.
Byte-level tokens spell out their bytes, so their lengths, summed up, are
their spans; an interval join (two binary searches) maps spans to sections,
and a token across a boundary goes to one section by a stated rule.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, in_small_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the published split pattern that the vocabulary was made with
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("start", "majority")
PASSAGE_CHARS = 500
_SCHEMA = "doc_id long, section int, start_char long, n_chars long, n_tokens long, n_crossing long"
_built: dict[int, tuple] = {}


def encoder(vocabulary: bytes, pattern: str = PATTERN):
    """(encoding, bytes of each token id), built once a worker."""
    key = hash((vocabulary, pattern))
    if key not in _built:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, k in ranks.items():
            size[k] = len(token)
        _built[key] = (tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), size)
    return _built[key]


def token_ends(text: str, vocabulary: bytes) -> np.ndarray:
    """End byte of each token of the whole text."""
    encoding, size = encoder(vocabulary)
    return np.cumsum(size[np.array(encoding.encode_ordinary(text), np.int64)])


def attribute(ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens given to each section, tokens that touch it and another one) for
    token ends and section bounds (ascending bytes, first 0, last the length).
    start: the section of the token's first byte; majority: the one with most
    of its bytes, the earliest of equals."""
    n = len(bounds) - 1
    starts = np.concatenate([[0], ends[:-1]])
    first = np.searchsorted(bounds, starts, "right") - 1
    last = np.searchsorted(bounds, ends, "left") - 1
    owner = first.copy()
    wide = np.flatnonzero(last > first)
    touched = np.zeros(n + 1, np.int64)
    np.add.at(touched, first[wide], 1)
    np.add.at(touched, last[wide] + 1, -1)
    if rule == "majority":
        for i in wide:  # few, and each spans a few sections
            cut = np.clip(bounds[first[i]:last[i] + 2], starts[i], ends[i])
            owner[i] = first[i] + int(np.argmax(np.diff(cut)))
    return np.bincount(owner, minlength=n), np.cumsum(touched)[:n]


def passage_bounds(raw: np.ndarray, limit: int = PASSAGE_CHARS) -> np.ndarray:
    """The default sections: lines with their newline, those of more than
    ``limit`` characters cut every ``limit`` characters."""
    lines = np.unique(np.concatenate([[0], np.flatnonzero(raw == 10) + 1, [len(raw)]]))
    char = np.flatnonzero((raw & 0xC0) != 0x80)  # first byte of each character
    at = np.searchsorted(char, lines)
    long_ = np.flatnonzero(np.diff(at) > limit)
    cuts = [char[np.arange(at[i] + limit, at[i + 1], limit)] for i in long_]
    return np.sort(np.concatenate([lines, *cuts]))


def _sections(vocabulary: bytes, rule: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = []
            held = 0
            for i, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                raw = np.frombuffer(text.encode(), np.uint8)
                bounds = passage_bounds(raw) if len(raw) else np.array([0, 0])
                given, crossing = attribute(token_ends(text, vocabulary), bounds, rule) if len(raw) else (np.zeros(1, int), np.zeros(1, int))
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[bounds]
                parts.append((np.full(len(given), i), np.arange(len(given)), chars[:-1], np.diff(chars), given, crossing))
                held += len(given)
                if held > 50_000:
                    yield _rows(batch, parts)
                    parts, held = [], 0
            if parts:
                yield _rows(batch, parts)
    return run


def _rows(batch: pa.RecordBatch, parts: list[tuple]) -> pa.RecordBatch:
    cols = [np.concatenate([p[k] for p in parts]) for k in range(6)]
    return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(cols[0])), pa.array(cols[1].astype(np.int32)), *(pa.array(c.astype(np.int64)) for c in cols[2:])],
                                      names=["doc_id", "section", "start_char", "n_chars", "n_tokens", "n_crossing"])


def section_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, rule: str = "majority", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document and section (see passage_bounds): its characters, the tokens
    given to it and how many of those that touch it cross a boundary.  The
    tokens of a document's sections sum to its token count.

    Null and empty texts have one section without tokens; repeated rows repeat
    theirs.  The driver reads the vocabulary file and ships it with the task.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    with open(vocabulary, "rb") as f:
        raw = f.read()
    return in_small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(_sections(raw, rule), _SCHEMA)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_tokens(documents(spark, sf_dir))
