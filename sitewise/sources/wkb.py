"""Columnar WKB decoding: all blobs of an Arrow batch together.

The blobs lie end to end in one byte buffer with offsets.  WKB is a prefix
code: a header says what follows and how many, so a blob is read with a
cursor and two counters (geometries and rings still to come) and no stack.
All blobs' cursors advance in lockstep, one header each a step, with numpy;
what comes out are part descriptors (where a run of points starts, how many,
which byte order and stride).  Then the points of all parts are gathered at
once.  Handles ISO and EWKB Z/M flags, SRIDs, both byte orders, GeoPackage
headers with any envelope, multi geometries and collections.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of the formats: bytes of a GeoPackage envelope by its indicator, and the geometry types.
GPKG_ENVELOPE_BYTES = np.array([0, 32, 48, 48, 64, 0, 0, 0])
TYPE_NAMES = ["Unknown", "Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon", "GeometryCollection"]


class BadGeometry(ValueError):
    """A blob that is no WKB: an unknown type, or cut short."""


@dataclass
class Decoded:
    """Parts in the order of the blobs: blob number, the polygon (or other
    geometry) and ring inside the blob, points; then the points of all parts
    one after another.  ``kind``: the outermost type of each blob, 0 where
    there is no blob."""

    blob: np.ndarray
    geom: np.ndarray
    ring: np.ndarray
    size: np.ndarray
    x: np.ndarray
    y: np.ndarray
    kind: np.ndarray


def _u32(data: np.ndarray, at: np.ndarray, little: np.ndarray) -> np.ndarray:
    b = [data[at + k].astype(np.int64) for k in range(4)]
    return np.where(little, b[0] | b[1] << 8 | b[2] << 16 | b[3] << 24, b[3] | b[2] << 8 | b[1] << 16 | b[0] << 24)


def decode(data: np.ndarray, offs: np.ndarray) -> Decoded:
    """The geometries of blobs laid end to end; an empty blob has none."""
    n = len(offs) - 1
    end = offs[1:].astype(np.int64)
    at = offs[:-1].astype(np.int64).copy()
    data = np.concatenate([data, np.zeros(16, np.uint8)])
    gpkg = (end - at >= 8) & (data[at] == 0x47) & (data[at + 1] == 0x50)
    at[gpkg] += 8 + GPKG_ENVELOPE_BYTES[(data[at[gpkg] + 3] >> 1) & 7]
    pending = (at < end).astype(np.int64)  # geometries still to come
    rings = np.zeros(n, np.int64)  # rings still to come of the polygon at hand
    little, step = np.zeros(n, bool), np.zeros(n, np.int64)
    geom, ring, kind = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    found: list[tuple[np.ndarray, ...]] = []

    def need(rows: np.ndarray, size) -> None:
        if (at[rows] + size > end[rows]).any():
            raise BadGeometry("geometry is cut short")

    def emit(rows: np.ndarray, count: np.ndarray) -> None:
        full = count > 0
        r = rows[full]
        found.append((r, geom[r], ring[r], count[full], at[r].copy(), step[r], little[r]))

    live = np.flatnonzero(pending)
    while len(live):
        inside = live[rings[live] > 0]
        heads = live[rings[live] == 0]
        if len(inside):
            need(inside, 4)
            count = _u32(data, at[inside], little[inside])
            at[inside] += 4
            need(inside, count * step[inside])
            emit(inside, count)
            at[inside] += count * step[inside]
            rings[inside] -= 1
            ring[inside] += 1
            pending[inside[rings[inside] == 0]] -= 1
        if len(heads):
            need(heads, 5)
            little[heads] = data[at[heads]] == 1
            code = _u32(data, at[heads] + 1, little[heads])
            at[heads] += 5 + 4 * ((code >> 29) & 1)  # an SRID follows
            plain = code & 0x0FFFFFFF
            base, iso = plain % 1000, plain // 1000
            if ((base < 1) | (base > 7) | (iso > 3)).any():
                raise BadGeometry(f"unknown WKB type {int(code[(base < 1) | (base > 7) | (iso > 3)][0])}")
            has_z = ((code >> 31) & 1).astype(bool) | (iso == 1) | (iso == 3)
            has_m = ((code >> 30) & 1).astype(bool) | (iso >= 2)
            step[heads] = 8 * (2 + has_z + has_m)
            kind[heads] = np.where(kind[heads] == 0, base, kind[heads])
            geom[heads] += base < 4
            ring[heads] = 0
            points = heads[base == 1]
            need(points, step[points])
            if len(points):
                xy = _coordinates(data, at[points], little[points])
                emit(points, (~np.isnan(xy[0]) & ~np.isnan(xy[1])).astype(np.int64))  # NaN: an empty point
                at[points] += step[points]
                pending[points] -= 1
            many = heads[base > 1]
            if len(many):
                need(many, 4)
                count, what = _u32(data, at[many], little[many]), base[base > 1]
                at[many] += 4
                lines, polygons, several = many[what == 2], many[what == 3], many[what > 3]
                size = count[what == 2]
                need(lines, size * step[lines])
                emit(lines, size)
                at[lines] += size * step[lines]
                pending[lines] -= 1
                rings[polygons] = count[what == 3]
                pending[polygons[rings[polygons] == 0]] -= 1
                pending[several] += count[what > 3] - 1
        live = live[pending[live] > 0]

    parts = [np.concatenate(c) if found else np.zeros(0, np.int64) for c in (zip(*found, strict=True) if found else [[]] * 7)]
    order = np.argsort(parts[0], kind="stable")  # a blob's parts were found in its own order
    blob, geom, ring, size, start, step, little = (p[order] for p in parts)
    first = np.cumsum(size) - size
    within = np.arange(int(size.sum())) - np.repeat(first, size)
    x, y = _coordinates(data, np.repeat(start, size) + within * np.repeat(step, size), np.repeat(little, size).astype(bool))
    return Decoded(blob, geom, ring, size, x, y, kind)


def _coordinates(data: np.ndarray, at: np.ndarray, little: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    views = [np.ndarray(len(data) - 8, order, data, strides=(1,)) for order in ("<f8", ">f8")]
    return tuple(np.where(little, views[0][at + k], views[1][at + k]).astype(np.float64) for k in (0, 8))


def _binary(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column; NULL is empty."""
    col = col.cast(pa.large_binary()).fill_null(b"")
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def _segments(batches):
    for batch in batches:
        d = decode(*_binary(batch.column(1)))
        segs = np.maximum(d.size - 1, 1)  # a part of one point is a segment without length
        first = np.cumsum(d.size) - d.size
        seq = np.arange(int(segs.sum())) - np.repeat(np.cumsum(segs) - segs, segs)
        a = np.repeat(first, segs) + seq
        b = a + np.repeat(d.size > 1, segs)
        number = np.arange(len(d.blob)) - np.searchsorted(d.blob, d.blob)
        cols = [pa.array(np.repeat(c, segs).astype(np.int32)) for c in (number, d.geom, d.ring)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(np.repeat(d.blob, segs))), *cols, pa.array(seq.astype(np.int32)), *[pa.array(v) for v in (d.x[a], d.y[a], d.x[b], d.y[b])]],
            names=["id", "part", "geom", "ring", "seq", "x1", "y1", "x2", "y2"])


def _infos(batches):
    for batch in batches:
        d = decode(*_binary(batch.column(1)))
        n = batch.num_rows
        points = np.bincount(d.blob, weights=d.size, minlength=n).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([TYPE_NAMES[k] if k else None for k in d.kind.tolist()], pa.string()),
             pa.array(np.bincount(d.blob, minlength=n).astype(np.int64)), pa.array(points), pa.array(points == 0)],
            names=["id", "geometry_type", "n_parts", "n_points", "is_empty"])


def segments(df: DataFrame, id_col: str, wkb_col: str) -> DataFrame:
    """(id, part, geom, ring, seq, x1, y1, x2, y2) of every segment: ``part``
    numbers the runs of points of a blob, ``geom`` its single geometries,
    ``ring`` the rings of a polygon (0: the outer one)."""
    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, wkb_col).mapInArrow(_segments, f"id {kind}, part int, geom int, ring int, seq int, x1 double, y1 double, x2 double, y2 double")


def infos(df: DataFrame, id_col: str, wkb_col: str) -> DataFrame:
    """(id, geometry_type, n_parts, n_points, is_empty) of every blob; no type where there is no blob."""
    kind = dict(df.dtypes)[id_col]
    return df.select(id_col, wkb_col).mapInArrow(_infos, f"id {kind}, geometry_type string, n_parts long, n_points long, is_empty boolean")
