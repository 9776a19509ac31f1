"""Numeric column helpers (F12, X9, X12-X15) and deterministic hashing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: compass points for wind direction (degrees), in order
COMPASS_EDGES = (22.5, 67.5, 112.5, 157.5, 202.5, 247.5, 292.5, 337.5)
COMPASS_LABELS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
CALM_VALUES = (0, 360)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucketize(c, edges: Sequence[float], labels: Sequence[str], *, wrap: bool = True,
              null_label: str | None = "Calm", null_values: Sequence[float] = CALM_VALUES,
              other: str = "OTHER") -> Column:
    """label ranges ``[edges[i-1], edges[i])``; with ``wrap`` the first label also
    covers ``>= edges[-1]`` and ``< edges[0]`` (compass north).  NULL and
    ``null_values`` map to ``null_label``; values in no range map to ``other``."""
    x = _col(c)
    e = None
    if null_label is not None:
        cond = x.isNull()
        for v in null_values:
            cond = cond | (x == v)
        e = F.when(cond, null_label)

    def add(cond, lab):
        nonlocal e
        e = F.when(cond, lab) if e is None else e.when(cond, lab)

    if wrap:
        add((x >= edges[-1]) | (x < edges[0]), labels[0])
        for i in range(1, len(edges)):
            add((x >= edges[i - 1]) & (x < edges[i]), labels[i])
    else:
        for i in range(1, len(edges)):
            add((x >= edges[i - 1]) & (x < edges[i]), labels[i - 1])
    return e.otherwise(other)


def compass(c) -> Column:
    return bucketize(c, COMPASS_EDGES, COMPASS_LABELS)


def signed_log(c) -> Column:
    """sign(x) * log1p(|x|)."""
    x = _col(c)
    return F.signum(x) * F.log1p(F.abs(x))


def flag_double(c) -> Column:
    """NULL -> 0.0, cast double."""
    return F.coalesce(_col(c).cast("double"), F.lit(0.0))


def impute_label(y, actual, scheduled, threshold: float = 15) -> Column:
    """Missing label <- 1 if actual - scheduled >= threshold else 0."""
    y = _col(y)
    return (F.when(y.isNull() & ((_col(actual) - _col(scheduled)) >= threshold), F.lit(1))
            .when(y.isNull(), F.lit(0)).otherwise(y))


def classify(p, threshold: float = 0.5, inclusive: bool = True) -> Column:
    """Probability -> class (``>=`` by default, ``>`` if not inclusive)."""
    p = _col(p)
    return F.when(p >= threshold if inclusive else p > threshold, F.lit(1)).otherwise(F.lit(0))


def focal_loss(p=None, y=None, alpha: float = 0.75, gamma: float = 2.0, logit=None) -> Column:
    """Per-row focal loss  alpha_t * (1 - p_t)^gamma * BCE.

    Give probabilities ``p`` or raw ``logit``; BCE from logits uses the stable form
    max(z,0) - z*y + log1p(exp(-|z|)).  ``alpha=None`` disables class weighting."""
    yy = _col(y).cast("double")
    if logit is not None:
        z = _col(logit).cast("double")
        bce = F.greatest(z, F.lit(0.0)) - z * yy + F.log1p(F.exp(-F.abs(z)))
        prob = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    else:
        prob = _col(p).cast("double")
        eps = 1e-12
        pc = F.least(F.greatest(prob, F.lit(eps)), F.lit(1 - eps))
        bce = -(yy * F.log(pc) + (1 - yy) * F.log(1 - pc))
    p_t = prob * yy + (1 - prob) * (1 - yy)
    a_t = (F.lit(alpha) * yy + F.lit(1 - alpha) * (1 - yy)) if alpha is not None else F.lit(1.0)
    return a_t * F.pow(1 - p_t, F.lit(float(gamma))) * bce


def hash_unit(key, seed: int | str = 42) -> Column:
    """Deterministic uniform value in [0,1) from ``md5("seed:key")``: first 8 hex
    digits / 2^32.  Same rows on any partitioning, and reproducible in SQL."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), _col(key).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def balance_alpha(pos_rate, lo: float = 0.5, hi: float = 0.85) -> Column:
    """Class-balance weight alpha = min(hi, max(lo, 1 - p))."""
    return F.least(F.lit(hi), F.greatest(F.lit(lo), 1 - _col(pos_rate)))
