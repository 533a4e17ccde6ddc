"""Column expressions of the harmonization rules; all of them stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataloom.model import ID_SENTINELS, LOD_FLAGS

#: Fixed value: the public accession pattern.
ACCESSION = r"[OPQ][0-9][A-Z0-9]{3}[0-9]|[A-NR-Z][0-9](?:[A-Z][A-Z0-9]{2}[0-9]){1,2}"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c) -> Column:
    """The value where it is a finite number, else null: NaN and infinities never pass a boundary."""
    c = _c(c).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def numeric(c) -> Column:
    """Number in a string, null if there is none."""
    return finite(_c(c).try_cast("double"))


def safe_log2(c) -> Column:
    c = finite(c)
    return F.when(c > 0, F.log2(c))


def blank(c) -> Column:
    return F.coalesce(F.trim(_c(c)), F.lit("")) == ""


def source_id(c) -> Column:
    """Identifier as its source writes it: trimmed, absent-value words null, ``1005.0`` repaired."""
    s = F.trim(_c(c).cast("string"))
    return F.when(~F.lower(s).isin(*ID_SENTINELS), F.regexp_replace(s, r"^(\d+)\.0+$", "$1"))


def global_key(namespace, person) -> Column:
    """namespace:id, null without an id."""
    return F.when(_c(person).isNotNull(), F.concat_ws(":", _c(namespace), _c(person)))


def accession(c) -> Column:
    """First accession in a string, null if none."""
    return F.nullif(F.regexp_extract(_c(c), f"({ACCESSION})", 1), F.lit(""))


def accessions(c) -> Column:
    return F.regexp_extract_all(_c(c), F.lit(f"({ACCESSION})"), F.lit(1))


def before_first(c, mark: str) -> Column:
    return F.substring_index(_c(c), mark, 1)


def after_first(c, mark: str) -> Column:
    """What follows the first mark; empty if there is none."""
    c = _c(c)
    at = F.locate(mark, c)
    return F.when(at > 0, F.substring(c, at + len(mark), F.length(c))).otherwise(F.lit(""))


def plex_channel_key(c) -> Column:
    """Matrix label to specimen key: plex, channel, batch reordered; ``b7r2`` becomes ``r2b7``."""
    parts = F.split(_c(c), "_")
    head = F.regexp_replace(F.element_at(parts, 1), r"^b(\d+)r(\d+)$", r"r$2b$1")
    return F.when(F.size(parts) == 3, F.concat_ws("_", head, F.element_at(parts, 3), F.element_at(parts, 2))).otherwise(_c(c))


def prefixed_key(c) -> Column:
    """``site_b1_001_11`` becomes ``b1_001``."""
    parts = F.split(_c(c), "_")
    return F.when(F.size(parts) >= 3, F.concat_ws("_", F.get(parts, F.lit(1)), F.get(parts, F.lit(2)))).otherwise(_c(c))


def below_lod(value, lod) -> Column:
    """Tri-state: null without a value, false without a limit."""
    v, limit = _c(value), _c(lod)
    return F.when(v.isNotNull(), F.coalesce(v < limit, F.lit(False)))


def lod_flag(fraction) -> Column:
    f = _c(fraction)
    out = F.when(f >= LOD_FLAGS[0][0], LOD_FLAGS[0][1])
    for limit, name in LOD_FLAGS[1:]:
        out = out.when(f >= limit, name)
    return out.otherwise(F.lit("ok"))


def average_rank(value, *partition) -> Column:
    """Rank with ties averaged."""
    order = W.partitionBy(*partition).orderBy(_c(value))
    same = W.partitionBy(*partition, _c(value))
    return F.rank().over(order) + (F.count(F.lit(1)).over(same) - 1) / 2


def _poly(x: Column, coefficients: tuple[float, ...]) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


# Rational approximations of the normal quantile function (Wichura 1988, AS 241).
_A = (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3)
_B = (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3, 2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3)
_C = (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4)
_D = (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1, 1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9)
_E = (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7)
_F = (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2, 7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15)


def _quantile(p: Column, q: Column, small: Column, r: Column) -> Column:
    centre = q * _poly(small, _A) / _poly(small, _B)
    near, far = r - 1.6, r - 5.0
    tail = F.when(r <= 5.0, _poly(near, _C) / _poly(near, _D)).otherwise(_poly(far, _E) / _poly(far, _F))
    sign = F.when(q < 0, -1.0).otherwise(1.0)  # the tail stands once in the generated code
    out = F.when(F.abs(q) <= 0.425, centre).otherwise(sign * tail)
    return F.when((p > 0) & (p < 1), out)


def _parts(p: Column, q: Column) -> tuple[Column, Column]:
    return F.lit(0.180625) - q * q, F.sqrt(-F.log(F.when(q < 0, p).otherwise(F.lit(1.0) - p)))


def norm_ppf(p) -> Column:
    """Normal quantile of a probability, null outside of (0, 1)."""
    p = _c(p)
    q = p - 0.5
    return _quantile(p, q, *_parts(p, q))


def with_norm_ppf(df: DataFrame, p: str, name: str) -> DataFrame:
    """df with the normal quantile of column p. Its parts are columns first: written out, each would stand some
    dozens of times in one expression, beyond what one compiled method may hold."""
    staged = df.withColumn("_q", F.col(p) - 0.5)
    small, r = _parts(F.col(p), F.col("_q"))
    staged = staged.withColumns({"_s": small, "_r": r})
    return staged.withColumn(name, _quantile(F.col(p), F.col("_q"), F.col("_s"), F.col("_r"))).drop("_q", "_s", "_r")


def norm_ppf_sql(p: str) -> str:
    """The same formula as SQL text."""

    def poly(x: str, cs: tuple[float, ...]) -> str:
        out = repr(cs[-1]) + "::DOUBLE"
        for c in reversed(cs[:-1]):
            out = f"({out} * {x} + {c!r}::DOUBLE)"
        return out

    q, s = f"(({p}) - 0.5)", f"(0.180625::DOUBLE - (({p}) - 0.5) * (({p}) - 0.5))"
    r = f"sqrt(-ln(CASE WHEN {q} < 0 THEN {p} ELSE 1 - ({p}) END))"
    n, f = f"({r} - 1.6)", f"({r} - 5.0)"
    tail = f"CASE WHEN {r} <= 5 THEN {poly(n, _C)} / {poly(n, _D)} ELSE {poly(f, _E)} / {poly(f, _F)} END"
    return f"CASE WHEN abs{q} <= 0.425 THEN {q} * {poly(s, _A)} / {poly(s, _B)} WHEN {q} < 0 THEN -({tail}) ELSE {tail} END"


def sample_skew(value) -> Column:
    """mean(((v - mean) / sd)^3) with the n-1 standard deviation."""
    v = _c(value)
    n = F.count(v)
    return F.when(n > 1, F.skewness(v) * F.pow((n - 1) / n, F.lit(1.5)))


def correlation(a, b) -> Column:
    """Pearson correlation, null where a side does not vary."""
    a, b = _c(a), _c(b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def first_by(value, ordinal) -> Column:
    """First non-null value in source order, as an aggregate."""
    v = _c(value)
    return F.min_by(v, F.when(v.isNotNull(), _c(ordinal)))
