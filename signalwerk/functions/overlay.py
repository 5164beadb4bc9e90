"""Union, intersection and difference of areas, and unions of lines, for many rows at once in numpy.

Places are whole numbers on a grid of a thousandth of a millimetre from a row's own corner. Where two segments cross is one place for both, and cutting
goes on until nothing is left to cut, so pieces meet at their ends only. What lies beside a piece is told by a ray over the other pieces, each of
which is wholly to one side; so every ring closes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK = 1_000_000
SNAP = 2.0**-20
ROUNDS = 12


def sweep(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each pair of one row whose stretches from low to high overlap, once, in blocks."""
    n = len(row)
    order = np.lexsort((np.repeat([0, 1], n), np.concatenate((low, high)), np.concatenate((row, row))))
    begins = order < n
    count = np.cumsum(begins)
    by = order[begins]
    end = np.empty(n, np.int64)
    end[order[~begins] - n] = count[~begins]
    more = end[by] - np.arange(1, n + 1)
    total = np.cumsum(more)
    i = 0
    while i < n:
        k = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + BLOCK, "right")))
        m = more[i:k]
        own = np.repeat(np.arange(i, k), m)
        other = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + own + 1
        yield by[own], by[other]
        i = k


def numbered(*columns: np.ndarray) -> np.ndarray:
    """A number for each row of columns, equal for equal rows, in their order."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), np.int64)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def cross(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a[:, 0] * b[:, 1] - a[:, 1] * b[:, 0]


def cut(row: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Segments cut where they cross and where ends of others lie on them: the segment of each piece, and the pieces."""
    n = len(e)
    low, high = np.minimum(e[:, :2], e[:, 2:]) - 1, np.maximum(e[:, :2], e[:, 2:]) + 1
    owner, place = [np.repeat(np.arange(n), 2)], [e.reshape(-1, 2)]
    for i, j in sweep(row, low[:, 1], high[:, 1]):
        near = (low[i, 0] <= high[j, 0]) & (low[j, 0] <= high[i, 0])
        i, j = i[near], j[near]
        a, b = e[i], e[j]
        d, s, to = (a[:, 2:] - a[:, :2]).astype(float), (b[:, 2:] - b[:, :2]).astype(float), (b[:, :2] - a[:, :2]).astype(float)
        den, size, other = cross(d, s), np.hypot(*d.T), np.hypot(*s.T)
        with np.errstate(divide="ignore", invalid="ignore"):
            t, u = cross(to, s) / den, cross(to, d) / den
        hit = (np.abs(den) > 1e-12 * size * other) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        p = a[hit, :2] + np.rint(t[hit, None] * d[hit]).astype(np.int64)
        owner += [i[hit], j[hit]]
        place += [p, p]
        for k, f, way, length, ends in ((i, a, d, size, b), (j, b, s, other, a)):
            for end in (ends[:, :2], ends[:, 2:]):
                off = (end - f[:, :2]).astype(float)
                along = (off * way).sum(1)
                on = (np.abs(cross(off, way)) <= length) & (along > 0) & (along < length * length)
                owner.append(k[on])
                place.append(end[on])
    owner, place = np.concatenate(owner), np.concatenate(place)
    along = ((place - e[owner, :2]).astype(float) * (e[owner, 2:] - e[owner, :2])).sum(1)
    order = np.lexsort((along, owner))
    owner, place = owner[order], place[order]
    piece = (owner[1:] == owner[:-1]) & (place[1:] != place[:-1]).any(1)
    return owner[1:][piece], np.hstack((place[:-1], place[1:]))[piece]


def distinct(row: np.ndarray, e: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments from left to right (or upwards), each once: of equal ones masks are combined by exclusive or; none without length."""
    back = (e[:, 0] > e[:, 2]) | ((e[:, 0] == e[:, 2]) & (e[:, 1] > e[:, 3]))
    e = np.where(back[:, None], e[:, [2, 3, 0, 1]], e)
    long = (e[:, :2] != e[:, 2:]).any(1)
    row, e, mask = row[long], e[long], mask[long]
    if not len(e):
        return row, e, mask
    order = np.lexsort((*e.T[::-1], row))
    row, e, mask = row[order], e[order], mask[order]
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (e[1:] != e[:-1]).any(1)))
    return row[first], e[first], np.bitwise_xor.reduceat(mask, first, axis=0)


def noded(row: np.ndarray, e: np.ndarray, mask: np.ndarray, areas: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pieces that meet at their ends only. Of areas those go that a shape has twice, as they bound nothing."""
    row, e, mask = distinct(row, e, mask)
    done, todo = [], np.ones(len(row), bool)
    for _ in range(ROUNDS):
        if not len(row):
            break
        of, pieces = cut(row, e)
        new = distinct(row[of], pieces, mask[of])
        if areas:
            some = new[2].any(1)
            new = tuple(x[some] for x in new)
        # rows in which nothing was cut are done
        n = int(max(row.max(), new[0].max() if len(new[0]) else 0)) + 1
        changed = np.bincount(row, minlength=n) != np.bincount(new[0], minlength=n)
        if len(new[0]) == len(row):
            at = np.flatnonzero((new[1] != e).any(1) | (new[0] != row))
            changed[row[at]] = True
            changed[new[0][at]] = True
        else:
            both = np.concatenate((row, new[0]))
            alike = numbered(both, *np.concatenate((e, new[1])).T)
            changed[both[np.bincount(alike)[alike] == 1]] = True
        todo = changed[new[0]]
        done.append(tuple(x[~todo] for x in new))
        row, e, mask = (x[todo] for x in new)
    done.append((row, e, mask))
    row, e, mask = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(row, kind="stable")
    return row[order], e[order], mask[order]


def sides(row: np.ndarray, p: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which shapes lie left and right of each piece, as bits."""
    plus, steep = np.zeros_like(mask), p[:, 1] != p[:, 3]
    for mine, q in ((steep, p), (~steep, p[:, [1, 0, 3, 2]])):
        if not mine.any():
            continue
        # a ray from the middle; the others' middles, too, so only rows with such pieces matter
        some = np.isin(row, row[mine])
        k = np.flatnonzero(some)
        low, high = np.minimum(q[:, 1], q[:, 3]), np.maximum(q[:, 1], q[:, 3])
        level, x = low + high, (q[:, 0] + q[:, 2]) / 2
        for i, j in sweep(row[k], low[k], high[k]):
            for a, b in ((k[i], k[j]), (k[j], k[i])):
                over = mine[a] & (2 * low[b] <= level[a]) & (level[a] < 2 * high[b])
                a, b = a[over], b[over]
                f = q[b]
                at = f[:, 0] + (level[a] / 2 - f[:, 1]) * (f[:, 2] - f[:, 0]) / (f[:, 3] - f[:, 1])
                beyond = at > x[a]
                for w in range(mask.shape[1]):
                    np.bitwise_xor.at(plus[:, w], a[beyond], mask[b[beyond], w])
    up = (p[:, 3] > p[:, 1])[:, None]
    return np.where(up, plus ^ mask, plus), np.where(up, plus, plus ^ mask)


def within(mask: np.ndarray, full: np.ndarray, operation: str) -> np.ndarray:
    """Whether what lies in these shapes of a row lies in the result."""
    if operation == "union":
        return mask.any(1)
    if operation == "intersection":
        return (mask == full).all(1) & full.any(1)
    if operation == "difference":
        first = mask.copy()
        first[:, 0] ^= np.uint64(1)
        return ~first.any(1)
    parity = np.bitwise_xor.reduce(mask, axis=1)
    for shift in (32, 16, 8, 4, 2, 1):
        parity ^= parity >> np.uint64(shift)
    return (parity & np.uint64(1)).astype(bool)


def traced(row: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directed pieces in the order of their rings, and where rings begin. Of several ways on the sharpest turn to the left is taken, so rings touch and do not cross."""
    n = len(row)
    node = numbered(np.concatenate((row, row)), *np.concatenate((d[:, :2], d[:, 2:])).T)
    start, end = node[:n], node[n:]
    order = np.argsort(start, kind="stable")
    first = np.searchsorted(start[order], end)
    leaving = np.bincount(start, minlength=int(node.max()) + 1)
    onward = order[first]
    angle = None
    for at in np.flatnonzero(leaving > 1).tolist():
        if angle is None:
            angle = np.arctan2((d[:, 3] - d[:, 1]).astype(float), (d[:, 2] - d[:, 0]).astype(float))
            comes = np.argsort(end, kind="stable")
        out = order[slice(*np.searchsorted(start[order], [at, at + 1]))].tolist()
        for i in comes[slice(*np.searchsorted(end[comes], [at, at + 1]))].tolist():
            onward[i] = max(out, key=lambda k: (angle[k] - angle[i] - np.pi) % (2 * np.pi))  # noqa: B023
            out.remove(int(onward[i]))
    follow, seen, walk, begin = onward.tolist(), bytearray(n), [], []
    for i in range(n):
        if not seen[i]:
            begin.append(len(walk))
            while not seen[i]:
                seen[i] = 1
                walk.append(i)
                i = follow[i]
    return np.array(walk, np.int64), np.array(begin, np.int64)


def segments(xy: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of lines as pairs of point numbers."""
    on = np.flatnonzero(line[1:] == line[:-1])
    return on, on + 1


def overlaid(row: np.ndarray, shape: np.ndarray, line: np.ndarray, xy: np.ndarray, n_shapes: np.ndarray, operation: str, snap: float = SNAP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows' areas combined: row, shape (number in the row) and line of each point xy; n_shapes by row. Gives for each ring its row, polygon (numbers from 0 in
    each row), and length, and all points: outer rings counter-clockwise, then their holes; polygons from small to large."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2))
    a, b = segments(xy, line)
    if not len(a):
        return none
    n = len(n_shapes)
    base = np.full((n, 2), np.inf)
    np.minimum.at(base, row, xy)
    base = np.floor(np.where(np.isfinite(base), base, 0))
    grid = np.rint((xy - base[row]) / snap).astype(np.int64)
    words = max(1, -(-int(n_shapes.max()) // 64))
    mask = np.zeros((len(a), words), np.uint64)
    mask[np.arange(len(a)), shape[a] // 64] = np.left_shift(np.uint64(1), (shape[a] % 64).astype(np.uint64))
    r, p, mask = noded(row[a], np.hstack((grid[a], grid[b])), mask, True)
    if not len(r):
        return none
    full = np.zeros((n, words), np.uint64)
    for w in range(words):
        left = np.clip(n_shapes - 64 * w, 0, 64).astype(np.uint64)
        full[:, w] = np.where(left == 64, ~np.uint64(0), np.left_shift(np.uint64(1), left % np.uint64(64)) - np.uint64(1))
    left, right = (within(x, full[r], operation) for x in sides(r, p, mask))
    fore, back = left & ~right, right & ~left
    r, d = np.concatenate((r[fore], r[back])), np.concatenate((p[fore], p[back][:, [2, 3, 0, 1]]))
    if not len(r):
        return none
    walk, begin = traced(r, d)
    r, q = r[walk], d[walk, :2]
    ring = np.zeros(len(walk), np.int64)
    ring[begin[1:]] = 1
    ring = np.cumsum(ring)
    # places on a straight line between their neighbours go, where three are left
    for _ in range(2):
        begin = np.flatnonzero(np.append(True, ring[1:] != ring[:-1]))
        size = np.diff(np.append(begin, len(ring)))
        nth = np.arange(len(ring)) - np.repeat(begin, size)
        first = np.repeat(begin, size)
        before, after = first + (nth - 1) % np.repeat(size, size), first + (nth + 1) % np.repeat(size, size)
        bend = cross((q - q[before]).astype(float), (q[after] - q).astype(float)) != 0
        enough = np.add.reduceat(bend.astype(np.int64), begin) >= 3
        keep = bend | ~enough[ring]
        r, q, ring = r[keep], q[keep], ring[keep]
    begin = np.flatnonzero(np.append(True, ring[1:] != ring[:-1]))
    size = np.diff(np.append(begin, len(ring)))
    # the leftmost corner first, so equal rings are equal
    corner = np.lexsort((q[:, 1], q[:, 0], ring))[begin] - begin
    nth = np.arange(len(ring)) - np.repeat(begin, size)
    q = q[np.repeat(begin, size) + (nth + np.repeat(corner, size)) % np.repeat(size, size)]
    own = r[begin]
    real = q * snap + base[np.repeat(own, size)]
    near = (q - q[np.repeat(begin, size)]).astype(float)
    step = near[np.repeat(begin, size) + (nth + 1) % np.repeat(size, size)]
    area = np.add.reduceat(cross(near, step), begin) / 2
    outer = np.flatnonzero(area > 0)
    outer = outer[np.lexsort((*real[begin[outer]].T[::-1], area[outer], own[outer]))]
    start = np.searchsorted(own[outer], np.arange(n + 1))
    points = [q[x : x + y] for x, y in zip(begin[outer].tolist(), size[outer].tolist(), strict=True)] if (area < 0).any() else []
    of = np.full(len(own), -1)
    of[outer] = np.arange(len(outer))
    for h in sorted(np.flatnonzero(area < 0).tolist(), key=lambda h: -area[h]):
        hole = q[begin[h] : begin[h] + size[h]]
        spot = (hole[0] + hole[1]) / 2
        for k in range(start[own[h]], start[own[h] + 1]):
            if area[outer[k]] > -area[h] and around(points[k], spot):
                of[h] = k
                break
    order = np.flatnonzero(of >= 0)
    order = order[np.lexsort((np.abs(area[order]), area[order] < 0, of[order]))]
    count = size[order] + 1
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    take = np.repeat(begin[order], count) + nth % np.repeat(size[order], count)
    return own[order], of[order] - start[own[order]], count, real[take]


def around(ring: np.ndarray, spot: np.ndarray) -> bool:
    """Whether a place, beside no edge but those that end at it, lies in a ring."""
    a, b = ring, np.roll(ring, -1, 0)
    over = (a[:, 1] > spot[1]) != (b[:, 1] > spot[1])
    a, b = a[over], b[over]
    return bool((spot[0] < a[:, 0] + (spot[1] - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1])).sum() % 2)


def flat(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An Arrow column of arrays of shapes: row, shape in the row and line of each point, all points, and how many shapes a row has; nulls are empty."""
    import pyarrow.compute as pc

    size = lambda c: pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    n_shapes = size(column)
    shapes = column.flatten()
    parts = shapes.flatten()
    lines = parts.flatten()
    points = lines.flatten()
    a, b, c = size(shapes), size(parts), size(lines)
    shape = np.repeat(np.repeat(np.repeat(np.arange(len(a)), a), b), c)
    row = np.repeat(np.arange(len(n_shapes)), n_shapes)[shape] if len(shape) else shape
    xy = np.stack([points.field(k).to_numpy(zero_copy_only=False) for k in "xy"], 1).astype(float) if len(points) else np.zeros((0, 2))
    return row, shape - (np.cumsum(n_shapes) - n_shapes)[row], np.repeat(np.arange(len(c)), c), xy, n_shapes


def nested(n: int, row: np.ndarray, polygon: np.ndarray, count: np.ndarray, xy: np.ndarray):
    """Rings of overlaid() as an Arrow column of shapes, a row for each of n."""
    import pyarrow as pa

    at = lambda sizes: pa.array(np.append(0, np.cumsum(sizes)), pa.int32())
    points = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(xy[:, 0])), pa.array(np.ascontiguousarray(xy[:, 1]))], names=["x", "y"])
    rings = pa.ListArray.from_arrays(at(count), points)
    new = np.append(True, (row[1:] != row[:-1]) | (polygon[1:] != polygon[:-1])) if len(row) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    parts = pa.ListArray.from_arrays(at(np.diff(np.append(first, len(row)))), rings)
    return pa.ListArray.from_arrays(at(np.bincount(row[first], minlength=n)), parts)
