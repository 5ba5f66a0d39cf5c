"""Plane geometry of footprints: small polygons, held and tested on the driver.

A multi-polygon is a list of polygons, a polygon a list of rings (the outer one first),
a ring a list of (x, y).
"""

from __future__ import annotations

Point = tuple[float, float]
Ring = list[Point]
MultiPolygon = list[list[Ring]]
Box = tuple[float, float, float, float]


def _open(ring: Ring) -> Ring:
    return ring[:-1] if len(ring) > 1 and ring[0] == ring[-1] else ring


def ring_area(ring: Ring) -> float:
    """Signed area: positive counter-clockwise."""
    r = _open(ring)
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1], strict=True)) / 2


def clean(polygons: MultiPolygon) -> MultiPolygon:
    """Polygons with closed rings, without repeated vertices and without empty ones."""
    out = []
    for rings in polygons:
        kept = []
        for ring in rings:
            r = [p for i, p in enumerate(_open(ring)) if i == 0 or p != ring[i - 1]]
            if len(r) >= 3 and abs(ring_area(r)) > 0:
                kept.append(r + r[:1])
            elif not kept:
                break
        if kept:
            out.append(kept)
    return out


def area(polygons: MultiPolygon) -> float:
    return sum(abs(ring_area(rings[0])) - sum(abs(ring_area(h)) for h in rings[1:]) for rings in polygons)


def box_of(polygons: MultiPolygon) -> Box:
    xs = [x for rings in polygons for x, _ in rings[0]]
    ys = [y for rings in polygons for _, y in rings[0]]
    return min(xs), min(ys), max(xs), max(ys)


def rectangle(box: Box) -> list[Ring]:
    x0, y0, x1, y1 = box
    return [[(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]


def _slabs(edges: list[tuple[float, float, float, float]], low: float, high: float) -> list[float]:
    """Heights between which no two edges meet, from low to high."""
    cuts = {low, high} | {y for e in edges for y in (e[1], e[3]) if low < y < high}
    for i, (ax, ay, bx, by) in enumerate(edges):
        for cx, cy, dx, dy in edges[:i]:
            if max(min(ay, by), min(cy, dy)) < min(max(ay, by), max(cy, dy)) and max(min(ax, bx), min(cx, dx)) <= min(max(ax, bx), max(cx, dx)):
                d = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
                if d:
                    t = ((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx)) / d
                    y = ay + t * (by - ay)
                    if 0 <= t <= 1 and low < y < high:
                        cuts.add(y)
    return sorted(cuts)


def _lengths(polygons: list[list[tuple[float, float, float, float]]], y: float) -> list[tuple[float, float]]:
    """The union of polygons (edge lists, even-odd each) along a height, as ordered intervals."""
    parts = []
    for edges in polygons:
        xs = sorted(ax + (y - ay) / (by - ay) * (bx - ax) for ax, ay, bx, by in edges if (ay <= y) != (by <= y))
        parts += list(zip(xs[::2], xs[1::2], strict=False))
    out: list[tuple[float, float]] = []
    for a, b in sorted(parts):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def usable_area(inclusions: MultiPolygon, exclusions: MultiPolygon = (), box: Box | None = None) -> float:
    """Area of the union of the inclusions less that of the exclusions, within a box.

    Exact for polygons that touch, overlap or cross themselves: between the heights of
    vertices and crossings, a shape's area is its length along the middle times the height.
    """
    if not inclusions:
        return 0.0
    x0, y0, x1, y1 = box or box_of(inclusions)

    def edges(polygons: MultiPolygon) -> list:
        near = [r for r in polygons if (b := box_of([r]))[0] < x1 and b[2] > x0 and b[1] < y1 and b[3] > y0]
        return [[(*a, *b) for ring in rings for r in [_open(ring)] for a, b in zip(r, r[1:] + r[:1], strict=True)] for rings in near]

    use, bar = edges(inclusions), edges(exclusions)
    every = [e for part in (*use, *bar) for e in part if max(e[1], e[3]) > y0 and min(e[1], e[3]) < y1]
    cuts, total = _slabs([*every, (x0, y0, x0, y1), (x1, y0, x1, y1)], y0, y1), 0.0  # and where edges leave the box
    for low, high in zip(cuts, cuts[1:], strict=False):
        middle = (low + high) / 2
        barred = _lengths(bar, middle)
        for a, b in _lengths(use, middle):
            a, b = max(a, x0), min(b, x1)
            length = max(0.0, b - a) - sum(max(0.0, min(b, d) - max(a, c)) for c, d in barred if b > a)
            total += length * (high - low)
    return total


def complete(box: Box, inclusions: MultiPolygon, exclusions: MultiPolygon = (), slack: float = 1e-9) -> bool:
    """Whether a box lies in the united inclusions and shares no area with an exclusion; boundary contact is allowed."""
    return usable_area(inclusions, exclusions, box) >= (box[2] - box[0]) * (box[3] - box[1]) * (1 - slack)


def is_rectangle(rings: list[Ring]) -> bool:
    return len(rings) == 1 and abs(abs(ring_area(rings[0])) - (b := box_of([rings]), (b[2] - b[0]) * (b[3] - b[1]))[1]) < 1e-9


def rectangles_apart(polygons: MultiPolygon) -> bool:
    """Whether all polygons are rectangles of which no two touch."""
    boxes = [box_of([r]) for r in polygons]
    apart = all(a[2] < b[0] or b[2] < a[0] or a[3] < b[1] or b[3] < a[1] for i, a in enumerate(boxes) for b in boxes[:i])
    return apart and all(is_rectangle(r) for r in polygons)


def usable(inclusions: MultiPolygon, exclusions: MultiPolygon) -> None:
    """An error where nothing is left of the inclusions."""
    if not inclusions or area(inclusions) <= 0:
        raise ValueError("the AOI's inclusion geometry is empty")
    if usable_area(inclusions, exclusions) <= area(inclusions) * 1e-12:
        raise ValueError("the AOI is empty without its exclusions")


def assert_overlap(inclusions: MultiPolygon, extent: Box) -> None:
    if usable_area(inclusions, (), extent) <= 0:
        raise ValueError("the AOI does not overlap the point-cloud XY extent")
