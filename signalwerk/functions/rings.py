"""Shapes of one row in numpy: cells they cover, distances, overlay of polygons, nodes of lines.

A shape is a list of parts; a part is a list of lines: the rings of a polygon (first = last), the one line of a line, or a line of one
point. A place is inside a polygon if a ray from it meets the rings an odd number of times, so holes need no order or direction.
"""

from __future__ import annotations

import numpy as np

from . import overlay as overlay_kernel

POINT, LINE, AREA = 0, 1, 2
BLOCK = 2_000_000
SNAP = 2.0**-20  # a thousandth of a millimetre


def edges(shape: list) -> np.ndarray:
    """All segments as rows ax, ay, bx, by; a line of one point is a segment without length."""
    out = []
    for part in shape:
        for line in part:
            xy = np.asarray(line, float).reshape(-1, 2)
            xy = np.concatenate((xy, xy)) if len(xy) == 1 else xy
            out.append(np.hstack((xy[:-1], xy[1:])))
    return np.concatenate(out) if out else np.zeros((0, 4))


def edges_by_row(column) -> list[np.ndarray]:
    """edges() of each row of an Arrow column of shapes; null shapes have none."""
    import pyarrow.compute as pc

    n_parts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    parts = column.flatten()
    n_lines = pc.list_value_length(parts).to_numpy(zero_copy_only=False)
    lines = parts.flatten()
    n_points = pc.list_value_length(lines).to_numpy(zero_copy_only=False)
    points = lines.flatten()
    xy = np.stack([points.field(c).to_numpy(zero_copy_only=False) for c in "xy"], 1).astype(float) if len(points) else np.zeros((0, 2))
    line = np.repeat(np.arange(len(n_points)), n_points)
    row_of_line = np.repeat(np.repeat(np.arange(len(n_parts)), n_parts), n_lines)
    onward = np.flatnonzero(line[1:] == line[:-1])
    alone = np.flatnonzero(np.repeat(n_points, n_points) == 1)
    start, end = np.concatenate((onward, alone)), np.concatenate((onward + 1, alone))
    row = row_of_line[line[start]] if len(start) else start
    order = np.argsort(row, kind="stable")
    both = np.hstack((xy[start], xy[end]))[order]
    return np.split(both, np.searchsorted(row[order], np.arange(1, len(n_parts)))) if len(n_parts) else []


def ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i all whole numbers from low[i] to high[i]: the i's and the numbers."""
    n = np.maximum(high - low + 1, 0)
    owner = np.repeat(np.arange(len(low)), n)
    return owner, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[owner]


def cells(e: np.ndarray, dimension: int, size: float, margin: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """cells_by_row() of one shape."""
    return cells_by_row([e], [dimension], size, margin)[1:]


def cells_by_row(each: list[np.ndarray], dimensions: list[int], size: float, margin: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Square cells within a margin of shapes, all at once: number of the shape, cx, cy, and whether a cell lies inside an area with the margin to its edges.

    Edges mark what they touch row by row; the other cells of a row are inside between an odd crossing of the row's middle and the next."""
    of = np.repeat(np.arange(len(each)), [len(e) for e in each])
    e = np.concatenate(each) if each else np.zeros((0, 4))
    low, high = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    first, last = (np.floor(y / size).astype(np.int64) for y in (low[:, 1] - margin, high[:, 1] + margin))
    i, row = ranges(first, last)
    # the part of an edge in the row, wider by the margin
    dy = e[i, 3] - e[i, 1]
    slope = np.divide(e[i, 2] - e[i, 0], dy, out=np.zeros(len(i)), where=dy != 0)
    at = lambda y: e[i, 0] + (np.clip(y, low[i, 1], high[i, 1]) - e[i, 1]) * slope
    x0, x1 = at(row * size - margin), at((row + 1) * size + margin)
    left, right = np.where(dy != 0, np.minimum(x0, x1), low[i, 0]) - margin, np.where(dy != 0, np.maximum(x0, x1), high[i, 0]) + margin
    # a little more, against rounding
    k, cx = ranges(np.floor((left - 1e-9 * size) / size).astype(np.int64), np.floor((right + 1e-9 * size) / size).astype(np.int64))
    edge = np.stack((of[i[k]], row[k], cx), 1)
    wide = np.array([d == AREA for d in dimensions], bool)[of] if len(of) else np.zeros(0, bool)
    area, own = e[wide], of[wide]
    first, last = np.ceil(low[wide, 1] / size - 0.5).astype(np.int64), np.ceil(high[wide, 1] / size - 0.5).astype(np.int64) - 1
    i, row = ranges(first, last)
    x = area[i, 0] + ((row + 0.5) * size - area[i, 1]) * (area[i, 2] - area[i, 0]) / np.where(area[i, 3] != area[i, 1], area[i, 3] - area[i, 1], 1)
    order = np.lexsort((x, row, own[i]))
    row, owner, x = row[order][::2], own[i][order][::2], x[order]
    k, cx = ranges(np.ceil(x[::2] / size - 0.5).astype(np.int64), np.floor(x[1::2] / size - 0.5).astype(np.int64))
    full = np.stack((owner[k], row[k], cx), 1)
    found = np.concatenate((edge, full))
    order = np.lexsort(found.T[::-1])  # stable, so what an edge touches comes before what is inside
    found = found[order]
    first = np.append(True, (found[1:] != found[:-1]).any(1)) if len(found) else np.zeros(0, bool)
    return found[first, 0], found[first, 2], found[first, 1], order[first] >= len(edge)


def contains(e: np.ndarray, xy: np.ndarray) -> np.ndarray:
    """Whether places lie inside rings."""
    out = np.zeros(len(xy), bool)
    step = max(1, BLOCK // max(len(e), 1))
    for i in range(0, len(xy), step):
        x, y = xy[i : i + step, :1], xy[i : i + step, 1:]
        over = (e[:, 1] > y) != (e[:, 3] > y)
        with np.errstate(divide="ignore", invalid="ignore"):
            right = x < e[:, 0] + (y - e[:, 1]) * (e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1])
        out[i : i + step] = ((over & right).sum(1) % 2).astype(bool)
    return out


def to_edges(xy: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Distance of each place to the nearest segment."""
    out = np.full(len(xy), np.inf)
    d = e[:, 2:] - e[:, :2]
    square = np.maximum((d * d).sum(1), 1e-300)
    step = max(1, BLOCK // max(len(e), 1))
    for i in range(0, len(xy), step):
        p = xy[i : i + step, None, :] - e[None, :, :2]
        t = np.clip((p * d).sum(2) / square, 0, 1)
        out[i : i + step] = np.sqrt(((p - t[..., None] * d) ** 2).sum(2)).min(1)
    return out


def cross(a, b):
    return a[..., 0] * b[..., 1] - a[..., 1] * b[..., 0]


def meet(e: np.ndarray, f: np.ndarray) -> bool:
    """Whether any segments of both cross."""
    step = max(1, BLOCK // max(len(f), 1))
    for i in range(0, len(e), step):
        a, r = e[i : i + step, None, :2], (e[i : i + step, 2:] - e[i : i + step, :2])[:, None]
        c, s = f[None, :, :2], (f[:, 2:] - f[:, :2])[None]
        den = cross(r, s)
        with np.errstate(divide="ignore", invalid="ignore"):
            t, u = cross(c - a, s) / den, cross(c - a, r) / den
        if ((den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)).any():
            return True
    return False


def distance(e: np.ndarray, e_dimension: int, f: np.ndarray, f_dimension: int) -> float:
    """Distance of two shapes, 0 where they meet or one lies in the other."""
    if not len(e) or not len(f):
        return float("inf")
    e_ends, f_ends = (np.concatenate((x[:, :2], x[:, 2:])) for x in (e, f))
    if (f_dimension == AREA and contains(f, e_ends).any()) or (e_dimension == AREA and contains(e, f_ends).any()) or meet(e, f):
        return 0.0
    return float(min(to_edges(e_ends, f).min(), to_edges(f_ends, e).min()))


def pieces(a: np.ndarray, b: np.ndarray, e: np.ndarray) -> list[tuple[float, float]]:
    """Which stretches of segment ab lie inside rings, as shares of its length."""
    d, s, to = b - a, e[:, 2:] - e[:, :2], e[:, :2] - a
    den = cross(d, s)
    with np.errstate(divide="ignore", invalid="ignore"):
        t, u = cross(to, s) / den, cross(to, d) / den
    cut = np.unique(np.concatenate(([0.0, 1.0], t[(den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)])))
    held = contains(e, a + ((cut[:-1] + cut[1:]) / 2)[:, None] * d)
    return [(x, y) for x, y, h in zip(cut[:-1].tolist(), cut[1:].tolist(), held, strict=True) if h]


def pieces_of_all(a: np.ndarray, b: np.ndarray, e: np.ndarray) -> list[list[tuple[float, float]]]:
    """pieces() of many segments: those that no edge cuts are told together, by their middles."""
    d, s = (b - a)[:, None], (e[:, 2:] - e[:, :2])[None]
    to, den = e[None, :, :2] - a[:, None], cross(d, s)
    with np.errstate(divide="ignore", invalid="ignore"):
        t, u = cross(to, s) / den, cross(to, d) / den
    cut = ((den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)).any(1)
    whole = contains(e, (a + b) / 2)
    return [pieces(x, y, e) if c else [(0.0, 1.0)] if w else [] for x, y, c, w in zip(a, b, cut.tolist(), whole.tolist(), strict=True)]


def overlay(shapes: list[list], operation: str, snap: float = SNAP) -> list:
    """Polygons of the union, intersection or symmetric difference of areas, or the difference of the first and all others; overlay.overlaid() of one row."""
    return overlays([shapes], operation, snap)[0]


def overlays(rows: list[list[list]], operation: str, snap: float = SNAP) -> list[list]:
    """overlay() of many rows at once."""
    owner, shape, line, points = [], [], [], []
    n = 0
    for r, shapes in enumerate(rows):
        for k, s in enumerate(shapes):
            for part in s or ():
                for ring in part:
                    owner += [r] * len(ring)
                    shape += [k] * len(ring)
                    line += [n] * len(ring)
                    points += ring
                    n += 1
    found = overlay_kernel.overlaid(np.array(owner, np.int64), np.array(shape, np.int64), np.array(line, np.int64), np.asarray(points, float).reshape(-1, 2), np.array([len(s) for s in rows], np.int64), operation, snap)
    out: list[list] = [[] for _ in rows]
    at = 0
    for r, k, count in zip(*(x.tolist() for x in found[:3]), strict=True):
        if k == len(out[r]):
            out[r].append([])
        out[r][k].append([tuple(p) for p in found[3][at : at + count].tolist()])
        at += count
    return out


def signed_area(xy: np.ndarray) -> float:
    x, y = (xy - xy[0]).T
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def area_of(polygons: list) -> float:
    return sum(abs(signed_area(np.asarray(p[0], float))) - sum(abs(signed_area(np.asarray(h, float))) for h in p[1:]) for p in polygons)


def noded(lines: list, snap: float = SNAP) -> list:
    """Lines cut wherever they meet, pieces that several have once, and joined again where just two pieces meet."""
    return noded_each([lines], snap)[0]


def noded_each(rows: list[list], snap: float = SNAP) -> list[list]:
    """noded() of many rows, which are cut at once."""
    each = [edges([lines]) for lines in rows]
    row = np.repeat(np.arange(len(rows)), [len(e) for e in each])
    if not len(row):
        return [[] for _ in rows]
    base = np.array([np.floor(e.reshape(-1, 2).min(0)) if len(e) else (0.0, 0.0) for e in each])
    grid = np.rint((np.concatenate(each) - np.tile(base, 2)[row]) / snap).astype(np.int64)
    row, grid, _ = overlay_kernel.noded(row, grid, np.ones((len(row), 1), np.uint64), False)
    parts = np.split(grid, np.searchsorted(row, np.arange(1, len(rows))))
    return [[[(float(x), float(y)) for x, y in np.array(p) * snap + at] for p in chains_of(g)] for g, at in zip(parts, base, strict=True)]


def chains_of(grid: np.ndarray) -> list[list[tuple]]:
    """Pieces joined where just two meet."""
    ends: dict[tuple, list[int]] = {}
    for i, (a, b, c, d) in enumerate(grid.tolist()):
        ends.setdefault((a, b), []).append(i)
        ends.setdefault((c, d), []).append(i)
    used, out = np.zeros(len(grid), bool), []

    def walk(node: tuple, i: int) -> list[tuple]:
        path = [node]
        while True:
            used[i] = True
            a, b = tuple(grid[i, :2].tolist()), tuple(grid[i, 2:].tolist())
            node = b if node == a else a
            path.append(node)
            more = [k for k in ends[node] if not used[k]]
            if len(ends[node]) != 2 or not more:
                return path
            i = more[0]

    for node in sorted(ends):  # from where chains begin, then rings
        if len(ends[node]) != 2:
            out += [walk(node, i) for i in ends[node] if not used[i]]
    out += [walk(tuple(grid[i, :2].tolist()), i) for i in range(len(grid)) if not used[i]]
    return out


def capsule(segment: np.ndarray, radius: float, steps: int = 32) -> list:
    """What lies within a radius of a segment, as a ring with half circles of so many steps."""
    a, b = segment[:2], segment[2:]
    turn = np.arctan2(*(b - a)[::-1]) if (a != b).any() else 0.0
    arc = np.pi * np.arange(steps + 1) / steps
    half = lambda center, first: center + radius * np.stack((np.cos(first + arc), np.sin(first + arc)), 1)
    ring = np.concatenate((half(b, turn - np.pi / 2), half(a, turn + np.pi / 2)))
    return [[[*map(tuple, ring.tolist()), tuple(ring[0].tolist())]]]


def inner_place(shape: list) -> np.ndarray:
    """A place inside polygons: the middle of the widest stretch of a level line at mid-height of the largest one."""
    e = edges([max(shape, key=lambda p: abs(signed_area(np.asarray(p[0], float))))])
    ys = np.unique(e[:, 1])
    k = max(1, len(ys) // 2)
    y = (ys[k - 1] + ys[k]) / 2
    over = (e[:, 1] > y) != (e[:, 3] > y)
    f = e[over]
    xs = np.sort(f[:, 0] + (y - f[:, 1]) * (f[:, 2] - f[:, 0]) / (f[:, 3] - f[:, 1]))
    i = int(np.argmax(xs[1::2] - xs[::2])) * 2
    return np.array([(xs[i] + xs[i + 1]) / 2, y])


def common_junction(roads: list, reach: float = 10.0, most: float = 75.0, off: float = 20.0) -> tuple[tuple[float, float], float] | None:
    """The place where all roads (lists of lines) meet and how wide it is, or None; roads.common_junctions() tells the rules."""
    return common_junction_of_each([roads], reach, most, off)[0]


def common_junction_of_each(asks: list[list], reach: float = 10.0, most: float = 75.0, off: float = 20.0) -> list[tuple[tuple[float, float], float] | None]:
    """common_junction() of many asks: what lies within reach of their roads is put together for all of them at once."""
    span = lambda xy: float((xy.max(0) - xy.min(0)).max())
    out: list = [None] * len(asks)
    open_ = []
    for n, roads in enumerate(asks):
        each = [edges([road]) for road in roads]
        if len(each) < 2 or not all(map(len, each)):
            continue
        exact = met_exactly(each)
        if len(exact) and span(exact) <= most:
            out[n] = tuple(exact[np.argmin(((exact - exact.mean(0)) ** 2).sum(1))].tolist()), span(exact)
            continue
        # only segments near all other roads can matter
        close = [near_all(e, [f for j, f in enumerate(each) if j != k], 2 * reach) for k, e in enumerate(each)]
        if all(m.any() for m in close):
            open_.append((n, each, [[capsule(x, reach) for x in e[m]] for e, m in zip(each, close, strict=True)]))
    if not open_:
        return out
    wide = iter(overlays([shapes for _, _, roads in open_ for shapes in roads], "union"))
    areas = overlays([[next(wide) for _ in roads] for _, _, roads in open_], "intersection")
    for (n, each, _), area in zip(open_, areas, strict=True):
        if not area or span(edges(area).reshape(-1, 2)) > most:
            continue
        inside, first = inner_place(area), each[0]
        d = first[:, 2:] - first[:, :2]
        at = np.clip(((inside - first[:, :2]) * d).sum(1) / np.maximum((d * d).sum(1), 1e-300), 0, 1)
        feet = first[:, :2] + at[:, None] * d
        point = feet[np.argmin(((feet - inside) ** 2).sum(1))]
        if not any(to_edges(point[None], e)[0] > off for e in each[1:]):
            out[n] = tuple(point.tolist()), span(edges(area).reshape(-1, 2))
    return out


def met_exactly(each: list[np.ndarray]) -> np.ndarray:
    """Places that all roads share."""
    a, r = each[0][:, None, :2], (each[0][:, 2:] - each[0][:, :2])[:, None]
    c, s = each[1][None, :, :2], (each[1][:, 2:] - each[1][:, :2])[None]
    den = cross(r, s)
    with np.errstate(divide="ignore", invalid="ignore"):
        t, u = cross(c - a, s) / den, cross(c - a, r) / den
    i, k = np.nonzero((den != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1))
    exact = np.unique(np.round(each[0][i, :2] + t[i, k][:, None] * (each[0][i, 2:] - each[0][i, :2]), 9), axis=0) if len(i) else np.zeros((0, 2))
    for e in each[2:]:
        exact = exact[to_edges(exact, e) <= 1e-6] if len(exact) else exact
    return exact


def near_all(e: np.ndarray, others: list[np.ndarray], most: float) -> np.ndarray:
    """Which segments come within a distance of each of other roads."""
    near = np.ones(len(e), bool)
    for f in others:
        d = np.minimum(to_edges(e[:, :2], f), to_edges(e[:, 2:], f)) <= most
        for i in np.flatnonzero(near & ~d).tolist():
            d[i] = distance(e[i][None], LINE, f, LINE) <= most
        near &= d
    return near
