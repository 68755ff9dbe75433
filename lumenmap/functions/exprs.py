"""Column expressions: statistics, scores, geometry and identities. All stay in the JVM."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Z_95 = 1.959963984540054


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: str | Column) -> Column:
    """The value if it is a finite number, else null."""
    c = col(c).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def first_finite(*cols: str | Column) -> Column:
    """The first finite value among aliases."""
    return F.coalesce(*[finite(c) for c in cols])


def clip(c: str | Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(col(c), F.lit(low)), F.lit(high))


def parse_bool(c: str | Column) -> Column:
    """Words for true and false; any other word is an error, null stays null."""
    v = F.lower(F.trim(col(c).cast("string")))
    # The accepted words.
    return F.when(v.isin("1", "true", "yes", "pass", "success"), True).when(v.isin("0", "false", "no", "fail", "failure"), False).when(v.isNotNull(), F.raise_error(F.concat(F.lit("not a boolean: "), v)).cast("boolean"))


# statistics


def wilson(failures: str | Column, n: str | Column, z: float = Z_95) -> tuple[Column, Column]:
    """Lower and upper bound of the Wilson score interval; 0 and 1 for no trials."""
    f, n = col(failures).cast("double"), col(n).cast("double")
    p, z2 = f / n, z * z
    centre = (p + z2 / (2 * n)) / (1 + z2 / n)
    half = z * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n)) / (1 + z2 / n)
    return F.when(n > 0, F.greatest(F.lit(0.0), centre - half)).otherwise(0.0), F.when(n > 0, F.least(F.lit(1.0), centre + half)).otherwise(1.0)


def beta_prior(failures: str | Column, n: str | Column, strength: float = 8.0) -> tuple[Column, Column]:
    """Alpha and beta of a prior around the smoothed rate of all trials."""
    rate = (col(failures) + 0.5) / (col(n) + 1.0)
    return strength * rate, strength * (1 - rate)


def beta_posterior_mean(failures, n, alpha, beta) -> Column:
    return (col(failures) + col(alpha)) / (col(n) + col(alpha) + col(beta))


def region_status(n, failures, lower, upper, weak: float = 0.30, healthy: float = 0.10, least: int = 8, least_failures: int = 2) -> Column:
    """WEAK, UNCERTAIN, INSUFFICIENT_EVIDENCE or HEALTHY by the bounds of the failure rate."""
    n, failures, lower, upper = map(col, (n, failures, lower, upper))
    return F.when(n < least, "INSUFFICIENT_EVIDENCE").when((failures >= least_failures) & (lower >= weak), "WEAK").when(upper <= healthy, "HEALTHY").otherwise("UNCERTAIN")


def rate_exceeds(part, whole, numerator: int, denominator: int) -> Column:
    """Whether part / whole > numerator / denominator, in whole numbers."""
    return col(part).cast("decimal(30,0)") * denominator > col(whole).cast("decimal(30,0)") * numerator


def robust_badness(value, median, mad, p10, p90, scale: float = 2.5, higher_is_worse: bool = True) -> Column:
    """Robust z over scale in [0, 1]; where the MAD is 0 the spread of the deciles stands in."""
    value, median, mad, p10, p90 = map(col, (value, median, mad, p10, p90))
    sigma = F.when(mad * 1.4826 > 1e-12, mad * 1.4826).when((p90 - p10) / 2.563 > 1e-12, (p90 - p10) / 2.563)
    diff = value - median if higher_is_worse else median - value
    return F.when(value.isNull(), None).when(sigma.isNull(), F.when(diff > 0, 1.0).otherwise(0.0)).otherwise(clip(diff / sigma / scale))


def weighted_observed(terms: Sequence[tuple[str | Column, float]]) -> tuple[Column, Column]:
    """Weighted mean over the terms that are not null, and the share of the weight that they have."""
    total = sum(w for _, w in terms)
    weight = reduce(lambda a, b: a + b, [F.when(col(c).isNotNull(), w).otherwise(0.0) for c, w in terms])
    value = reduce(lambda a, b: a + b, [F.coalesce(col(c).cast("double"), F.lit(0.0)) * w for c, w in terms])
    return F.when(weight > 0, value / weight), weight / total


def min_units_without_failure(target: float, confidence: float = 0.95) -> int:
    """The least number of trials without failure whose upper bound is within target."""
    return max(1, math.ceil(math.log(1 - confidence) / math.log(1 - target) - 1e-12))


def score_lower_better(value, target: float) -> Column:
    return F.when(col(value).isNotNull(), F.when(col(value) <= 0, 1.0).otherwise(clip(F.lit(target) / col(value))))


def score_higher_better(value, target: float) -> Column:
    return F.when(col(value).isNotNull(), clip(col(value) / F.lit(target)))


def grade(score) -> Column:
    """A to D; fixed cuts at 90, 75 and 60."""
    return F.when(col(score) >= 90, "A").when(col(score) >= 75, "B").when(col(score) >= 60, "C").otherwise("D")


def motion_distance(a: Sequence[str | Column], b: Sequence[str | Column]) -> Column:
    """Total variation between two histograms of shares."""
    return 0.5 * reduce(lambda x, y: x + y, [F.abs(col(p) - col(q)) for p, q in zip(a, b)])


# vectors


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Null where the lengths differ or a norm is about 0."""
    size = norm(a) * norm(b)
    return F.when((F.size(col(a)) == F.size(col(b))) & (size > 1e-12), dot(a, b) / size)


def l2(a, b) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(col(a), col(b), lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2)), F.lit(0.0), lambda s, v: s + v))


def hamming(a, b) -> Column:
    return F.bit_count(col(a).bitwiseXOR(col(b)))


def jaccard(a, b) -> Column:
    """Of two sets as arrays; 1 where both are empty."""
    union = F.size(F.array_union(col(a), col(b)))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(col(a), col(b))) / union)


# geometry; rotations are row-major arrays of 9


def at(r, i: int, j: int) -> Column:
    return F.element_at(col(r), 3 * i + j + 1)


def rotation_angle_deg(a, b) -> Column:
    """The angle between two rotations, from the trace of one's transpose times the other."""
    trace = reduce(lambda x, y: x + y, [at(a, i, j) * at(b, i, j) for i in range(3) for j in range(3)])
    return F.degrees(F.acos(clip((trace - 1) / 2, -1.0, 1.0)))


def angle_between_deg(a, b) -> Column:
    return F.degrees(F.acos(clip(dot(a, b) / (norm(a) * norm(b)), -1.0, 1.0)))


def rotation_of_quaternion(w, x, y, z) -> Column:
    """World-to-camera rotation of a quaternion of any length but 0."""
    w, x, y, z = map(col, (w, x, y, z))
    n = w * w + x * x + y * y + z * z
    s = F.lit(2.0) / n
    return F.array(1 - s * (y * y + z * z), s * (x * y - w * z), s * (x * z + w * y), s * (x * y + w * z), 1 - s * (x * x + z * z), s * (y * z - w * x), s * (x * z - w * y), s * (y * z + w * x), 1 - s * (x * x + y * y))


def camera_centre(r, t) -> Column:
    """-R'T of a world-to-camera pose."""
    return F.array(*[-reduce(lambda x, y: x + y, [at(r, j, i) * F.element_at(col(t), j + 1) for j in range(3)]) for i in range(3)])


def view_direction(r) -> Column:
    """The camera's z axis in the world."""
    return F.array(*[at(r, 2, i) for i in range(3)])


def yaw_pitch_rotation(yaw_deg, pitch_deg) -> Column:
    """Camera-to-world rotation (x right, y down, z ahead) for a heading about the vertical and an elevation."""
    cy, sy = F.cos(F.radians(col(yaw_deg))), F.sin(F.radians(col(yaw_deg)))
    cp, sp = F.cos(F.radians(col(pitch_deg))), F.sin(F.radians(col(pitch_deg)))
    return F.array(sy, -cy * sp * -1, cy * cp, -cy, sy * sp, sy * cp, F.lit(0.0) * cy, -cp, sp)


def direction_of_azimuth(az_deg, el_deg) -> Column:
    """The way light travels from a sun at an azimuth (clockwise from north, y) and an elevation."""
    az, el = F.radians(col(az_deg)), F.radians(col(el_deg))
    return F.array(-F.sin(az) * F.cos(el), -F.cos(az) * F.cos(el), -F.sin(el))


def project_pinhole(point: Sequence[Column], r, t, fx, fy, cx, cy, k1=None, k2=None) -> tuple[Column, Column, Column]:
    """Pixel and depth of a point by a world-to-camera pose; radial distortion where k1 (and k2) are given."""
    c = [reduce(lambda x, y: x + y, [at(r, i, j) * col(point[j]) for j in range(3)]) + F.element_at(col(t), i + 1) for i in range(3)]
    x, y = c[0] / c[2], c[1] / c[2]
    if k1 is not None:
        r2 = x * x + y * y
        d = 1 + col(k1) * r2 + (col(k2) * r2 * r2 if k2 is not None else 0)
        x, y = x * d, y * d
    return col(fx) * x + col(cx), col(fy) * y + col(cy), c[2]


def sampson_error(f: Sequence[float], x0, y0, x1, y1) -> Column:
    """Sampson distance of a correspondence under a fundamental matrix of 9 numbers."""
    x0, y0, x1, y1 = map(col, (x0, y0, x1, y1))
    a = [f[3 * i] * x0 + f[3 * i + 1] * y0 + f[3 * i + 2] for i in range(3)]
    b = [f[i] * x1 + f[3 + i] * y1 + f[6 + i] for i in range(3)]
    top = x1 * a[0] + y1 * a[1] + a[2]
    return F.sqrt(top * top / (a[0] * a[0] + a[1] * a[1] + b[0] * b[0] + b[1] * b[1]))


# cells and identities


def grid_cell(x, y, width, height, rows: int = 4, cols: int = 4) -> Column:
    """Cell of an image grid for points within the closed image, else null."""
    x, y, w, h = map(col, (x, y, width, height))
    inside = (x >= 0) & (x <= w) & (y >= 0) & (y <= h) & ~F.isnan(x) & ~F.isnan(y)
    return F.when(inside, F.least(F.lit(rows - 1), F.floor(y / h * rows)) * cols + F.least(F.lit(cols - 1), F.floor(x / w * cols)))


def cell_of(size: float, *coords) -> Column:
    """The cell of a lattice as a string."""
    return F.concat_ws(":", *[F.floor(col(c) / size).cast("string") for c in coords])


def rounded_cell(c, size: float = 8.0) -> Column:
    """Half-even rounding of a coordinate over the cell size."""
    return F.rint(col(c) / size).cast("long")


def spatial_block(x, y, z, size: float) -> Column:
    return F.concat(F.lit("spatial:"), cell_of(size, x, y, z))


def tile_key(x, y, width, height, rows: int = 4, cols: int = 4) -> Column:
    r = F.least(F.lit(rows - 1), F.greatest(F.lit(0), F.floor(col(y) / col(height) * rows)))
    c = F.least(F.lit(cols - 1), F.greatest(F.lit(0), F.floor(col(x) / col(width) * cols)))
    return F.concat_ws("_", r.cast("string"), c.cast("string"))


def pair_ids(pair_id, modulus: int = 2147483647) -> tuple[Column, Column]:
    """The two image ids of a database pair id."""
    second = F.pmod(col(pair_id), F.lit(modulus))
    return ((col(pair_id) - second) / modulus).cast("long"), second.cast("long")


def undirected(a, b) -> tuple[Column, Column]:
    return F.least(col(a), col(b)), F.greatest(col(a), col(b))


def route_cell_weight(success, n) -> Column:
    return 1 + 4 * (1 - col(success)) + 0.25 * F.log1p(col(n))


def decay(age, half_life: float) -> Column:
    return F.pow(F.lit(0.5), col(age) / half_life)


def harmonic_value(components: str | Column, mean, t, low: float = 0.0, high: float = 1.0) -> Column:
    """Clipped value at time t of an array of structs (omega, cos, sin) around a mean."""
    t = col(t)
    return clip(col(mean) + F.aggregate(col(components), F.lit(0.0), lambda s, c: s + c["cos"] * F.cos(c["omega"] * t) + c["sin"] * F.sin(c["omega"] * t)), low, high)


def reasons(rules: dict[str, Column] | Sequence[tuple[str, Column]]) -> Column:
    """The names of the conditions that hold, in order; a condition that is null does not hold."""
    items = rules.items() if isinstance(rules, dict) else rules
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in items]))


def first_by_priority(found: str | Column, priority: Sequence[str]) -> Column:
    """The first name of a fixed order that an array holds."""
    return F.try_element_at(F.array_intersect(F.array(*[F.lit(p) for p in priority]), col(found)), F.lit(1))
