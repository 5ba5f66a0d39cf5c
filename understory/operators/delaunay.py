"""Delaunay triangulation and linear interpolation in numpy, for one chunk of points."""

from __future__ import annotations

import numpy as np


#: Points that are triangulated as they are.
WHOLE = 20_000


def _insertion_order(p: np.ndarray) -> list[int]:
    """Points in rounds of doubling size, each along a snake of cells: cavities stay small and walks short."""
    n = len(p)
    turn = np.random.default_rng(n).permutation(n)
    rank = np.empty(n, np.int64)
    rank[turn] = np.floor(np.log2(np.arange(n) + 1)).astype(np.int64)
    cells = np.maximum(1, np.sqrt(2.0 ** rank / 2)).astype(np.int64)
    place = np.floor((p - p.min(axis=0)) / max(np.ptp(p, axis=0).max(), 1e-12) * (cells[:, None] - 1e-9)).astype(np.int64)
    along = np.where(place[:, 1] % 2 == 0, p[:, 0], -p[:, 0])
    return np.lexsort((along, place[:, 1], rank)).tolist()


def triangulate(points: np.ndarray) -> np.ndarray:
    """Triangles (rows of three indices, counter-clockwise) of distinct points; none if all are on one line.

    Points are put in one by one within a great triangle: a walk over neighbours finds the
    triangle that holds a point, the triangles around it whose circumcircles hold it make
    way, and their rim is joined to it.
    """
    points = np.asarray(points, float)
    none = np.zeros((0, 3), np.int64)
    if len(points) < 3:
        return none
    shift, scale = points.mean(axis=0), max(np.ptp(points, axis=0).max(), 1e-12)
    p = (points - shift) / scale
    order = np.lexsort((p[:, 1], p[:, 0]))
    keep = np.ones(len(order), bool)
    keep[1:] = (np.abs(np.diff(p[order], axis=0)) > 1e-12).any(axis=1)
    order = order[keep]
    if len(order) < 3 or np.linalg.svd(p[order] - p[order].mean(axis=0), compute_uv=False)[1] < 1e-9:
        return none
    order = order[_insertion_order(p[order])].tolist()
    n = len(p)
    xs, ys = [*p[:, 0].tolist(), -1e3, 1e3, 0.0], [*p[:, 1].tolist(), -1e3, -1e3, 1e3]
    corners, beside, circles = [(n, n + 1, n + 2)], [[-1, -1, -1]], [(0.0, 0.0, 1e9)]
    t = 0
    for i in order:
        x, y = xs[i], ys[i]
        came = -1
        while True:
            a, b, c = corners[t]
            ax, ay, bx, by, cx, cy = xs[a], ys[a], xs[b], ys[b], xs[c], ys[c]
            near = beside[t]
            if (cx - bx) * (y - by) < (cy - by) * (x - bx) and near[0] != came and near[0] >= 0:
                came, t = t, near[0]
            elif (ax - cx) * (y - cy) < (ay - cy) * (x - cx) and near[1] != came and near[1] >= 0:
                came, t = t, near[1]
            elif (bx - ax) * (y - ay) < (by - ay) * (x - ax) and near[2] != came and near[2] >= 0:
                came, t = t, near[2]
            else:
                break
        gone, at, rim = [t], 0, []
        held = {t}
        while at < len(gone):
            t = gone[at]
            at += 1
            v, near = corners[t], beside[t]
            for k in (0, 1, 2):
                o = near[k]
                if o in held:
                    continue
                if o >= 0:
                    ox, oy, r = circles[o]
                    if (ox - x) * (ox - x) + (oy - y) * (oy - y) < r:
                        held.add(o)
                        gone.append(o)
                        continue
                rim.append((v[k - 2], v[k - 1], o, t))
        first, last = {}, {}
        for k, (a, b, o, old) in enumerate(rim):
            if k < len(gone):
                t = gone[k]
            else:
                t = len(corners)
                corners.append(None)
                beside.append(None)
                circles.append(None)
            first[a], last[b] = t, t
            ux, uy, vx, vy = xs[a] - x, ys[a] - y, xs[b] - x, ys[b] - y
            d = 2 * (ux * vy - uy * vx) or 1e-300
            u2, v2 = ux * ux + uy * uy, vx * vx + vy * vy
            px, py = (vy * u2 - uy * v2) / d, (ux * v2 - vx * u2) / d
            rim[k] = (a, b, o, old, t, (x + px, y + py, (px * px + py * py) * (1 - 1e-12)))
        links = [(o, [k for k in (0, 1, 2) if beside[o][k] == old][0], t) for _, _, o, old, t, _ in rim if o >= 0]
        for a, b, o, _, t, circle in rim:
            corners[t], beside[t], circles[t] = (a, b, i), [first[b], last[a], o], circle
        for o, k, t in links:
            beside[o][k] = t
    triangles = np.array(corners, np.int64)
    triangles = triangles[(triangles < n).all(axis=1)]
    a, b, c = (p[triangles[:, i]] for i in range(3))
    area = (b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])
    triangles, area = triangles[np.abs(area) > 1e-14], area[np.abs(area) > 1e-14]
    triangles[area < 0] = triangles[area < 0][:, [0, 2, 1]]
    return triangles


def interpolate(xyz: np.ndarray, triangles: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, triangle) at places: linear within triangles, NaN and -1 outside all.

    Triangles are listed by the cells of a lattice that their boxes touch, so a place
    is tested against the few triangles of its cell.
    """
    value, found = np.full(len(at), np.nan), np.full(len(at), -1)
    if not len(triangles) or not len(at):
        return value, found
    corners = xyz[triangles][:, :, :2]
    low, high = corners.min(axis=1), corners.max(axis=1)
    origin = low.min(axis=0)
    span = max(np.ptp(np.vstack([low, high]), axis=0).max(), 1e-9)
    side = max(1, int(np.sqrt(len(triangles))))
    size = span / side + 1e-12
    first, last = np.floor((low - origin) / size).astype(np.int64), np.floor((high - origin) / size).astype(np.int64)
    wide = last - first + 1
    n = wide.prod(axis=1)
    owner = np.repeat(np.arange(len(triangles)), n)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    cell = (first[owner, 0] + step % wide[owner, 0]) * (side + 2) + first[owner, 1] + step // wide[owner, 0]
    order = np.argsort(cell, kind="stable")
    cell, owner = cell[order], owner[order]
    mine = np.floor((at - origin) / size).astype(np.int64)
    inside = ((mine >= 0) & (mine <= side + 1)).all(axis=1)
    key = np.where(inside, mine[:, 0] * (side + 2) + mine[:, 1], -1)
    begin, end = np.searchsorted(cell, key, "left"), np.searchsorted(cell, key, "right")
    a, b, c = (xyz[triangles[:, i]] for i in range(3))
    for k in range(int((end - begin).max(initial=0))):
        rows = np.flatnonzero((begin + k < end) & (found < 0))
        t = owner[begin[rows] + k]
        x, y = at[rows, 0], at[rows, 1]
        det = (b[t, 1] - c[t, 1]) * (a[t, 0] - c[t, 0]) + (c[t, 0] - b[t, 0]) * (a[t, 1] - c[t, 1])
        u = ((b[t, 1] - c[t, 1]) * (x - c[t, 0]) + (c[t, 0] - b[t, 0]) * (y - c[t, 1])) / det
        v = ((c[t, 1] - a[t, 1]) * (x - c[t, 0]) + (a[t, 0] - c[t, 0]) * (y - c[t, 1])) / det
        w = 1 - u - v
        hit = (u >= -1e-9) & (v >= -1e-9) & (w >= -1e-9)
        r, t = rows[hit], t[hit]
        value[r] = u[hit] * a[t, 2] + v[hit] * b[t, 2] + w[hit] * c[t, 2]
        found[r] = t
    return value, found


def interpolated(xyz: np.ndarray, at: np.ndarray, whole: int = WHOLE) -> tuple[np.ndarray, np.ndarray]:
    """(values, found) at places: linear in the Delaunay triangles of distinct points, NaN and False outside all.

    Of more than `whole` points only those are triangulated that the places' triangles need:
    the hull, one of each cell of a lattice, and what the circles of the places' triangles
    hold, until those circles are empty.  A triangle with an empty circle is one of all points'.
    """
    if len(xyz) <= whole:
        value, t = interpolate(xyz, triangulate(xyz[:, :2]), at)
        return value, t >= 0
    p = xyz[:, :2] - xyz[:, :2].mean(axis=0)
    places = at - xyz[:, :2].mean(axis=0)
    chosen = np.zeros(len(p), bool)
    chosen[_hull(p)] = True
    chosen[np.unique(_lattice(p, int(np.sqrt(4 * len(at))) + 1)[0], return_index=True)[1]] = True
    side = int(np.sqrt(len(p) / 4)) + 1
    cell, size, low = _lattice(p, side)
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    while True:  # every round chooses a point
        some = np.flatnonzero(chosen)
        triangles = triangulate(p[some])
        value, t = interpolate(xyz[some], triangles, at)
        asked = np.flatnonzero(t >= 0)
        x, y, r2 = _circles(p[some][triangles[t[asked]]])
        more = False
        for circle, point in _within(p, order, cell, side, size, low, x, y, r2):
            point, circle = point[~chosen[point]], circle[~chosen[point]]
            if not len(point):
                continue
            more = True
            dx, dy = (p[point] - places[asked[circle]]).T
            eighth = (dx > 0) * 4 + (dy > 0) * 2 + (np.abs(dx) > np.abs(dy))
            near = np.lexsort((dx * dx + dy * dy, eighth, circle))
            key = circle[near] * 8 + eighth[near]
            chosen[point[near[np.concatenate([[True], key[1:] != key[:-1]])]]] = True
        if not more:
            return value, t >= 0


def _lattice(p: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell of each point, widths of a cell, corner) of side by side cells."""
    low = p.min(axis=0)
    size = np.maximum(np.ptp(p, axis=0), 1e-9) / side * (1 + 1e-12)
    place = np.minimum(np.floor((p - low) / size).astype(np.int64), side - 1)
    return place[:, 0] * side + place[:, 1], size, low


def _circles(corners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, squared radius), a billionth less, of the circles through three corners each."""
    a, b, c = corners[:, 0], corners[:, 1] - corners[:, 0], corners[:, 2] - corners[:, 0]
    d = 2 * (b[:, 0] * c[:, 1] - b[:, 1] * c[:, 0])
    b2, c2 = (b * b).sum(axis=1), (c * c).sum(axis=1)
    x, y = (c[:, 1] * b2 - b[:, 1] * c2) / d, (b[:, 0] * c2 - c[:, 0] * b2) / d
    return a[:, 0] + x, a[:, 1] + y, (x * x + y * y) * (1 - 1e-9)


def _within(p, order, cell, side, size, low, x, y, r2, most: int = 1 << 20):
    """(circle, point) pairs of the points inside circles, in parts; order and cell: the points by cells of a lattice."""
    r = np.sqrt(r2)
    lo = [np.clip(np.floor((v - r - low[k]) / size[k]), 0, side - 1).astype(np.int64) for k, v in enumerate((x, y))]
    hi = [np.clip(np.floor((v + r - low[k]) / size[k]), 0, side - 1).astype(np.int64) for k, v in enumerate((x, y))]
    wide = hi[0] - lo[0] + 1
    circle = np.repeat(np.arange(len(x)), wide)
    column = lo[0][circle] + np.arange(len(circle)) - np.repeat(np.cumsum(wide) - wide, wide)
    begin = np.searchsorted(cell, column * side + lo[1][circle], "left")
    n = np.searchsorted(cell, column * side + hi[1][circle], "right") - begin
    total = np.concatenate([[0], np.cumsum(n)])
    first = 0
    while first < len(circle):
        last = max(first + 1, int(np.searchsorted(total, total[first] + most, "right")) - 1)
        owner = np.repeat(np.arange(first, last), n[first:last])
        point = order[begin[owner] + np.arange(len(owner)) - (total[owner] - total[first])]
        mine = circle[owner]
        inside = (p[point, 0] - x[mine]) ** 2 + (p[point, 1] - y[mine]) ** 2 < r2[mine]
        yield mine[inside], point[inside]
        first = last


def _hull(p: np.ndarray) -> np.ndarray:
    """Indices of the corners of the convex hull; points inside the polygon of 32 directions' extremes are left out first."""
    turn = np.arange(32) * (np.pi / 16)
    extreme = np.array([(p[:, 0] * np.cos(a) + p[:, 1] * np.sin(a)).argmax() for a in turn])
    inside = np.ones(len(p), bool)
    for a, b in zip(extreme, np.roll(extreme, -1), strict=True):
        if a != b:
            inside &= (p[b, 0] - p[a, 0]) * (p[:, 1] - p[a, 1]) - (p[b, 1] - p[a, 1]) * (p[:, 0] - p[a, 0]) > 0
    rest = np.flatnonzero(~inside) if len(set(extreme.tolist())) > 2 else np.arange(len(p))
    rest = rest[np.lexsort((p[rest, 1], p[rest, 0]))].tolist()
    xs, ys = p[:, 0], p[:, 1]

    def chain(indices: list[int]) -> list[int]:
        kept: list[int] = []
        for i in indices:
            while len(kept) > 1 and (xs[kept[-1]] - xs[kept[-2]]) * (ys[i] - ys[kept[-2]]) <= (ys[kept[-1]] - ys[kept[-2]]) * (xs[i] - xs[kept[-2]]):
                kept.pop()
            kept.append(i)
        return kept

    return np.unique(chain(rest) + chain(rest[::-1]))
