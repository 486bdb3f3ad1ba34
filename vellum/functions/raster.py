"""Masks, contours, polygons and images on numpy: what column expressions can't state."""

from __future__ import annotations

import struct
import zlib

import numpy as np


# ------------------------------------------------------------------ masks
def runs_of(mask: np.ndarray) -> list[tuple[int, int, int]]:
    """(y, x0, x1) of each horizontal run, x1 past the end."""
    m = np.pad(mask.astype(np.int8), ((0, 0), (1, 1)))
    d = np.diff(m, axis=1)
    ys, starts = np.nonzero(d == 1)
    _, stops = np.nonzero(d == -1)
    return list(zip(ys.tolist(), starts.tolist(), stops.tolist()))


def mask_of(runs, h: int, w: int) -> np.ndarray:
    out = np.zeros((h, w), dtype=bool)
    for y, a, b in runs:
        out[y, a:b] = True
    return out


def runs_overlap(a, b) -> int:
    """Common pixels of two run-length masks."""
    rows: dict[int, list[tuple[int, int]]] = {}
    for y, x0, x1 in b:
        rows.setdefault(y, []).append((x0, x1))
    return sum(max(0, min(x1, q1) - max(x0, q0)) for y, x0, x1 in a for q0, q1 in rows.get(y, ()))


def mask_iou(a, b) -> float:
    i = runs_overlap(a, b)
    u = sum(x1 - x0 for _, x0, x1 in a) + sum(x1 - x0 for _, x0, x1 in b) - i
    return i / u if u else 0.0


# ------------------------------------------------------------------ contours
_STEPS = ((1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1))


def contours(mask: np.ndarray, scale: tuple[float, float] = (1.0, 1.0)) -> list[list[tuple[int, int]]]:
    """Outer boundaries of the 8-connected parts of a mask, as polygons through pixel centres, runs of collinear points
    drawn together, scaled (x, y) and rounded half to even; those of under three vertices are dropped."""
    m = np.pad(mask.astype(bool), 1)
    seen = np.zeros_like(m)
    out = []
    for y, x in zip(*np.nonzero(m)):
        if seen[y, x]:
            continue
        part, stack = [], [(int(y), int(x))]
        seen[y, x] = True
        while stack:
            cy, cx = stack.pop()
            part.append((cy, cx))
            for dx, dy in _STEPS:
                if m[cy + dy, cx + dx] and not seen[cy + dy, cx + dx]:
                    seen[cy + dy, cx + dx] = True
                    stack.append((cy + dy, cx + dx))
        ring = _straight(_trace(m, min(part)))
        if len(ring) >= 3:
            out.append([(int(np.rint((px - 1) * scale[0])), int(np.rint((py - 1) * scale[1]))) for px, py in ring])
    return out


def _trace(m: np.ndarray, start: tuple[int, int]) -> list[tuple[int, int]]:
    """Border following from the topmost-leftmost pixel, clockwise, until it leaves it the same way again."""
    y, x = start
    ring, heading, first = [], 6, None
    while True:
        for k in range(8):
            d = (heading + 6 + k) % 8 if ring else (0 + k) % 8
            dx, dy = _STEPS[d]
            if m[y + dy, x + dx]:
                break
        else:
            return [(x, y)]
        if (y, x) == start:
            if first is None:
                first = d
            elif d == first:
                return ring
        ring.append((x, y))
        x, y, heading = x + dx, y + dy, d


def _straight(ring: list[tuple[int, int]]) -> list[tuple[int, int]]:
    n = len(ring)
    keep = [ring[i] for i in range(n) if (ring[i][0] - ring[i - 1][0], ring[i][1] - ring[i - 1][1]) != (ring[(i + 1) % n][0] - ring[i][0], ring[(i + 1) % n][1] - ring[i][1])]
    return list(dict.fromkeys(keep))


# ------------------------------------------------------------------ polygons
def area(ring) -> float:
    """Shoelace area, 0 with under three points."""
    if len(ring) < 3:
        return 0.0
    a = np.asarray(ring, dtype=np.float64)
    b = np.roll(a, -1, axis=0)
    return float(abs((a[:, 0] * b[:, 1] - b[:, 0] * a[:, 1]).sum()) / 2)


def _cover(ring, y: np.ndarray) -> list[np.ndarray]:
    """x of the ring's crossings at each y, sorted: the even-odd rule, which also repairs self-crossing rings."""
    a = np.asarray(ring, dtype=np.float64)
    b = np.roll(a, -1, axis=0)
    out = []
    for v in y:
        hit = (a[:, 1] <= v) != (b[:, 1] <= v)
        p, q = a[hit], b[hit]
        out.append(np.sort(p[:, 0] + (v - p[:, 1]) / (q[:, 1] - p[:, 1]) * (q[:, 0] - p[:, 0])))
    return out


def intersection_area(p, q) -> float:
    """Common area of two polygons, exact: between neighbouring vertex or crossing heights all edges are straight, so
    the common width is linear but for crossings, which are heights as well."""
    if len(p) < 3 or len(q) < 3:
        return 0.0
    ys = sorted({float(y) for _, y in [*p, *q]} | set(_crossings(p, q)) | set(_crossings(p, p)) | set(_crossings(q, q)))
    total = 0.0
    for lo, hi in zip(ys, ys[1:]):
        if hi > lo:
            mid = np.array([(lo + hi) / 2])
            total += (hi - lo) * _common(_cover(p, mid)[0], _cover(q, mid)[0])
    return total


def _common(a: np.ndarray, b: np.ndarray) -> float:
    return sum(max(0.0, min(a[i + 1], b[j + 1]) - max(a[i], b[j])) for i in range(0, len(a) - 1, 2) for j in range(0, len(b) - 1, 2))


def _edges(ring):
    a = np.asarray(ring, dtype=np.float64)
    return a, np.roll(a, -1, axis=0)


def _crossings(p, q) -> list[float]:
    """Heights at which edges of the two rings cross."""
    (a, b), (c, d) = _edges(p), _edges(q)
    r, s = b - a, d - c
    den = r[:, None, 0] * s[None, :, 1] - r[:, None, 1] * s[None, :, 0]
    diff = c[None] - a[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (diff[..., 0] * s[None, :, 1] - diff[..., 1] * s[None, :, 0]) / den
        u = (diff[..., 0] * r[:, None, 1] - diff[..., 1] * r[:, None, 0]) / den
    i, j = np.nonzero((den != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1))
    return (a[i, 1] + t[i, j] * r[i, 1]).tolist()


def polygon_iou(p, q) -> float:
    i = intersection_area(p, q)
    u = even_odd_area(p) + even_odd_area(q) - i
    return i / u if u > 0 else 0.0


def even_odd_area(ring) -> float:
    """Area by the even-odd rule: that of the ring after repair of self-crossings."""
    return intersection_area(ring, ring)


#: Numbers in an array of the measures over many polygons, about
CELLS = 1 << 17


def polygon_ious(p, n, q, m) -> np.ndarray:
    """``polygon_iou`` of many pairs of polygons, NaN where a coordinate is.  p, q: points of all rings, one after the
    other; n, m: points of each ring.  Rings are measured together by size, short ones filled up by their last point: an
    edge without length has no part in any measure."""
    at, to = np.cumsum(n) - n, np.cumsum(m) - m
    sizes = np.stack([_size(n), _size(m)], axis=1)
    out = np.zeros(len(n))
    shapes, which = np.unique(sizes, axis=0, return_inverse=True)
    for k, (a, b) in enumerate(shapes.tolist()):
        rows = np.flatnonzero((which.ravel() == k) & (n >= 3) & (m >= 3))
        step = max(1, CELLS // (a + b) ** 2)
        for i in (rows[x : x + step] for x in range(0, len(rows), step)):
            out[i] = _ious(*(r[x[i, None] + np.minimum(np.arange(c), k[i, None] - 1)].astype(np.float64) for r, x, k, c in ((p, at, n, a), (q, to, m, b))))
    return out


def _size(n: np.ndarray) -> np.ndarray:
    """The next power of two, 4 at least."""
    return 1 << np.ceil(np.log2(np.maximum(n, 4))).astype(np.int64)


def _ious(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """IoU of each pair of rings; p, q: (pairs, points, 2)."""
    pp, qq = _crossed(p, p), _crossed(q, q)
    low, high = np.maximum(p[..., 1].min(axis=1), q[..., 1].min(axis=1)), np.minimum(p[..., 1].max(axis=1), q[..., 1].max(axis=1))
    i = _swept([p, q], [_crossed(p, q), pp, qq], low, high)
    u = _swept([p], [pp], p[..., 1].min(axis=1), p[..., 1].max(axis=1)) + _swept([q], [qq], q[..., 1].min(axis=1), q[..., 1].max(axis=1)) - i
    out = np.divide(i, u, out=np.zeros(len(i)), where=u > 0)
    out[np.isnan(p).any(axis=(1, 2)) | np.isnan(q).any(axis=(1, 2))] = np.nan
    return out


def _crossed(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, height) of each crossing of an edge of p with one of q; of neighbouring edges, which have none, and of an edge
    with one before it none if p is q."""
    (_, n, _), (_, m, _) = p.shape, q.shape
    step, found = max(1, CELLS // (len(p) * m)), []
    for x in range(0, n, step):
        at = np.arange(x, min(x + step, n))[:, None]
        i, j = np.nonzero(np.arange(m) >= (at + 2 if p is q else 0 * at))
        i += x
        a, c = p[:, i], q[:, j]
        r, s, diff = p[:, (i + 1) % n] - a, q[:, (j + 1) % m] - c, c - a
        with np.errstate(divide="ignore", invalid="ignore"):
            den = r[..., 0] * s[..., 1] - r[..., 1] * s[..., 0]
            t = (diff[..., 0] * s[..., 1] - diff[..., 1] * s[..., 0]) / den
            u = (diff[..., 0] * r[..., 1] - diff[..., 1] * r[..., 0]) / den
        row, k = np.nonzero((den != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1))
        found.append((row, a[row, k, 1] + t[row, k] * r[row, k, 1]))
    return tuple(map(np.concatenate, zip(*found)))


def _swept(rings: list[np.ndarray], crossed: list[tuple], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Area common to the rings of each row from low to high, as ``intersection_area`` sums it up."""
    row = np.concatenate([*(np.repeat(np.arange(len(r)), r.shape[1]) for r in rings), *(k for k, _ in crossed)])
    h = np.concatenate([*(r[..., 1].ravel() for r in rings), *(y for _, y in crossed)])
    h = np.clip(h, low[row], high[row])
    by = np.lexsort((h, row))
    row, h = row[by], h[by]
    k = np.flatnonzero((row[1:] == row[:-1]) & (h[1:] > h[:-1]))
    row, lo, hi = row[k], h[k], h[k + 1]
    edges = [(r, np.roll(r, -1, axis=1)) for r in rings]
    width = np.empty(len(row))
    step = max(1, CELLS // sum(r.shape[1] for r in rings))
    for x in range(0, len(row), step):
        s = slice(x, x + step)
        y = ((lo[s] + hi[s]) / 2)[:, None]
        width[s] = _inside([_at_height(a[row[s]], b[row[s]], y) for a, b in edges])
    return np.bincount(row, (hi - lo) * width, len(low))


def _at_height(a: np.ndarray, b: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x at which each edge a to b meets the height of its row, infinite where it doesn't."""
    with np.errstate(divide="ignore", invalid="ignore"):
        x = a[..., 0] + (y - a[..., 1]) / (b[..., 1] - a[..., 1]) * (b[..., 0] - a[..., 0])
    return np.where((a[..., 1] <= y) != (b[..., 1] <= y), x, np.inf)


def _inside(crossed: list[np.ndarray]) -> np.ndarray:
    """Width of each row that is inside all rings, by the even-odd rule."""
    x = np.concatenate(crossed, axis=1)
    by = np.argsort(x, axis=1)
    x = np.take_along_axis(x, by, axis=1)
    inside, start = np.isfinite(x[:, 1:]), 0
    for c in crossed:
        own = (by >= start) & (by < start + c.shape[1])
        inside &= np.logical_xor.accumulate(own, axis=1)[:, :-1]
        start += c.shape[1]
    with np.errstate(invalid="ignore"):
        return np.where(inside, x[:, 1:] - x[:, :-1], 0).sum(axis=1)


def distance(p, q) -> float:
    """Least distance of two polygons, 0 if they meet."""
    if intersection_area(p, q) > 0 or _crossings(p, q):
        return 0.0
    return min(_to_edges(p, q), _to_edges(q, p))


def _to_edges(points, ring) -> float:
    a, b = _edges(ring)
    x = np.asarray(points, dtype=np.float64)[:, None]
    d = b - a
    n = np.maximum((d * d).sum(axis=1), 1e-12)
    t = np.clip(((x - a) * d).sum(axis=2) / n, 0, 1)
    return float(np.sqrt((((a + t[..., None] * d) - x) ** 2).sum(axis=2)).min())


def union_of_boxes(boxes) -> list[tuple[list[tuple[int, int]], float]]:
    """(outer ring, its area) of each part of the union of boxes (x0, y0, x1, y1); holes dropped, rings closed by their
    first point if boxes were joined, plain corners for a single box."""
    boxes = [b for b in boxes if b[2] > b[0] and b[3] > b[1]] or boxes[:1]
    if len(boxes) == 1:
        x0, y0, x1, y1 = boxes[0]
        ring = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
        return [(ring, area(ring))]
    xs, ys = (sorted({b[k] for b in boxes} | {b[k + 2] for b in boxes}) for k in (0, 1))
    ix, iy = {x: i for i, x in enumerate(xs)}, {y: i for i, y in enumerate(ys)}
    cells = np.zeros((len(ys) + 1, len(xs) + 1), dtype=bool)
    for x0, y0, x1, y1 in boxes:
        cells[iy[y0] + 1 : iy[y1] + 1, ix[x0] + 1 : ix[x1] + 1] = True
    # directed cell borders with the inside on the right; each corner's ways out
    out: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for r in range(1, len(ys)):
        for c in range(1, len(xs)):
            if cells[r, c]:
                a, b, d, e = (c - 1, r - 1), (c, r - 1), (c, r), (c - 1, r)
                for inside, p, q in ((cells[r - 1, c], a, b), (cells[r, c + 1] if c + 1 < cells.shape[1] else False, b, d), (cells[r + 1, c] if r + 1 < cells.shape[0] else False, d, e), (cells[r, c - 1], e, a)):
                    if not inside:
                        out.setdefault(p, []).append(q)
    rings = []
    while out:
        start = min(out)
        ring, at, came = [], start, None
        while True:
            ways = out[at]
            # at a corner where two parts touch, turn right first and stay on this part
            k = 0 if len(ways) == 1 or came is None else min(range(len(ways)), key=lambda i: _turn(came, at, ways[i]))
            nxt = ways.pop(k)
            if not ways:
                del out[at]
            ring.append(at)
            came, at = at, nxt
            if at == start:
                break
        n = len(ring)
        ring = [ring[i] for i in range(n) if not (ring[i - 1][0] == ring[i][0] == ring[(i + 1) % n][0] or ring[i - 1][1] == ring[i][1] == ring[(i + 1) % n][1])]
        pts = [(xs[x], ys[y]) for x, y in ring]
        signed = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(pts, [*pts[1:], pts[0]]))
        if signed > 0:  # the other way round is a hole
            rings.append(([*pts, pts[0]], area(pts)))
    return rings


def _turn(a, b, c) -> int:
    cross = (b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0])
    return -cross


# ------------------------------------------------------------------ images
def decode(content: bytes) -> np.ndarray:
    """(height, width, 3) of a PNG (8 bits, not interlaced) or binary PNM file; ValueError for any other."""
    if content[:8] == b"\x89PNG\r\n\x1a\n":
        return _png(content)
    if content[:2] in (b"P5", b"P6"):
        parts, at = [], 2
        while len(parts) < 3:
            while content[at : at + 1].isspace():
                at += 1
            if content[at : at + 1] == b"#":
                at = content.index(b"\n", at)
                continue
            end = at
            while not content[end : end + 1].isspace():
                end += 1
            parts.append(int(content[at:end]))
            at = end
        w, h, _ = parts
        planes = 3 if content[:2] == b"P6" else 1
        px = np.frombuffer(content, dtype=np.uint8, count=w * h * planes, offset=at + 1).reshape(h, w, planes)
        return np.repeat(px, 3, axis=2) if planes == 1 else px.copy()
    raise ValueError("no decoder for this image format")


def _png(content: bytes) -> np.ndarray:
    at, data, palette = 8, b"", None
    while at < len(content):
        n, kind = struct.unpack(">I4s", content[at : at + 8])
        body = content[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            w, h, depth, color, _, _, interlace = struct.unpack(">IIBBBBB", body)
            if depth != 8 or interlace:
                raise ValueError("only 8-bit PNG without interlacing")
        elif kind == b"PLTE":
            palette = np.frombuffer(body, dtype=np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data += body
        at += 12 + n
    planes = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color]
    raw = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(h, 1 + w * planes)
    out, above = np.zeros((h, w * planes), dtype=np.int64), np.zeros(w * planes, dtype=np.int64)
    for y in range(h):
        kind, line = raw[y, 0], raw[y, 1:].astype(np.int64)
        if kind == 2:
            line = line + above
        elif kind:
            for i in range(len(line)):
                left = line[i - planes] & 255 if i >= planes else 0
                corner = above[i - planes] if i >= planes else 0
                if kind == 1:
                    line[i] += left
                elif kind == 3:
                    line[i] += (left + above[i]) // 2
                else:
                    p = left + above[i] - corner
                    d = (abs(p - left), abs(p - above[i]), abs(p - corner))
                    line[i] += (left, above[i], corner)[d.index(min(d))]
        above = out[y] = line & 255
    px = out.astype(np.uint8).reshape(h, w, planes)
    if color == 3:
        return palette[px[:, :, 0]]
    return np.repeat(px[:, :, :1], 3, axis=2) if planes < 3 else px[:, :, :3].copy()


def resize(image: np.ndarray, h: int, w: int) -> np.ndarray:
    """Bilinear resize, as floats in [0, 1]."""
    y, x = (np.clip((np.arange(n) + 0.5) * image.shape[k] / n - 0.5, 0, image.shape[k] - 1) for k, n in ((0, h), (1, w)))
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, image.shape[0] - 1), np.minimum(x0 + 1, image.shape[1] - 1)
    fy, fx = (y - y0)[:, None, None], (x - x0)[None, :, None]
    im = image.astype(np.float32) / 255
    return (im[y0][:, x0] * (1 - fy) + im[y1][:, x0] * fy) * (1 - fx) + (im[y0][:, x1] * (1 - fy) + im[y1][:, x1] * fy) * fx


def crop_polygon(image: np.ndarray, ring) -> np.ndarray:
    """The polygon's bounding rectangle (both ends included), white outside the polygon."""
    a = np.asarray(ring)
    x0, y0 = np.maximum(a.min(axis=0), 0)
    x1, y1 = np.minimum(a.max(axis=0) + 1, (image.shape[1], image.shape[0]))
    out = np.full((max(0, y1 - y0), max(0, x1 - x0), 3), 255, dtype=np.uint8)
    for y in range(y0, y1):
        for v in (y, y - 1e-6):  # the border counts as inside
            xs = _cover(ring, np.array([float(v)]))[0]
            for p, q in zip(xs[::2], xs[1::2]):
                p_, q_ = max(x0, int(np.ceil(p))), min(x1, int(np.floor(q)) + 1)
                if q_ > p_:
                    out[y - y0, p_ - x0 : q_ - x0] = image[y, p_:q_]
    return out


def mean_chord(ring, step: float = 0.5) -> float:
    """Thickness of a polygon: the mean length of its chords on a grid, along x or y, whichever is less."""
    out = []
    for turn in (ring, [(y, x) for x, y in ring]):
        ys = [y for _, y in turn]
        grid = np.arange(min(ys) + step / 2, max(ys), step)
        chords = [float(x[i + 1] - x[i]) for x in _cover(turn, grid) for i in range(0, len(x) - 1, 2)]
        out.append(sum(chords) / len(chords) if chords else 0.0)
    return min(out)
