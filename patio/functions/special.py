"""Tail probabilities and normal quantiles as column expressions (for already reduced rows)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

BETA_STEPS = 300

# AS 241 coefficients of the normal quantile (numerator, denominator per region).
CENTRAL = (
    [3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3,
     1.3731693765509461125e4, 4.5921953931549871457e4, 6.7265770927008700853e4,
     3.3430575583588128105e4, 2.5090809287301226727e3],
    [1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4,
     5.2264952788528545610e3],
)
MIDDLE = (
    [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
     3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
     2.27238449892691845833e-2, 7.74545014278341407640e-4],
    [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
     1.05075007164441684324e-9],
)
TAIL = (
    [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
     2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
     2.71155556874348757815e-5, 2.01033439929228813265e-7],
    [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
     2.04426310338993978564e-15],
)


def _horner(coefficients: list[float], x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(c)
    return out


def _rational(table: tuple[list[float], list[float]], x: Column) -> Column:
    return _horner(table[0], x) / _horner(table[1], x)


def normal_ppf(p: Column) -> Column:
    """Standard normal quantile, about 16 digits."""
    q = p - F.lit(0.5)
    r = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    far = F.when(r <= 5.0, _rational(MIDDLE, r - F.lit(1.6))).otherwise(
        _rational(TAIL, r - F.lit(5.0)))
    near = q * _rational(CENTRAL, F.lit(0.180625) - q * q)
    return F.when(F.abs(q) <= 0.425, near).otherwise(F.signum(q) * far)


def _let(binding: str, name: str, body: str) -> str:
    """Bind a struct expression to a name, so that the body may use it many times."""
    return f"element_at(transform(array({binding}), {name} -> {body}), 1)"


def _gamma_tail(x: str) -> str:
    """Stirling remainder of ln gamma, accurate from about 10 on."""
    return f"(1/{x}) * (1/12D - (1/{x}/{x}) * (1/360D - (1/{x}/{x}) * (1/1260D - 1/{x}/{x}/1680)))"


def _gamma_ratio(x: str, a: str) -> str:
    """ln gamma(x + a) - ln gamma(x) without cancellation for large x."""
    big = f"({x} + 10)"
    low = " + ".join(f"ln(({x} + {k}) / ({x} + {a} + {k}))" for k in range(10))
    return (f"({a} * ln({big}) + ({big} + {a} - 0.5D) * log1p({a} / {big}) - {a}"
            f" + {_gamma_tail(f'({big} + {a})')} - {_gamma_tail(big)} + {low})")


def _beta_fraction(a: str, b: str, x: str) -> str:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    def guard(v: str) -> str:
        return f"if(abs({v}) < 1e-300D, 1e-300D, {v})"

    m = "floor(i / 2)"
    even = f"{m} * ({b} - {m}) * {x} / (({a} + 2 * {m} - 1) * ({a} + 2 * {m}))"
    odd = f"-({a} + {m}) * ({a} + {b} + {m}) * {x} / (({a} + 2 * {m}) * ({a} + 2 * {m} + 1))"
    d = guard("1 + t * s.d")
    c = guard("1 + t / s.c")
    step = _let(f"if(i % 2 = 0, {even}, {odd})", "t", _let(
        f"named_struct('d', 1 / {d}, 'c', {c})", "n",
        "named_struct('c', n.c, 'd', n.d, 'h', s.h * n.d * n.c)"))
    first = guard(f"1 - ({a} + {b}) * {x} / ({a} + 1)")
    start = f"named_struct('c', 1D, 'd', 1 / {first}, 'h', 1 / {first})"
    return f"aggregate(sequence(2, {BETA_STEPS}), {start}, (s, i) -> {step}).h"


def f_sf(f: str, d1: str, d2: str) -> Column:
    """P(F > f) with d1 and d2 degrees of freedom; arguments are column names or SQL numbers.

    Regularised incomplete beta function at d2 / (d2 + d1 f), from whichever end converges fast.
    """
    odds = f"(double({d1}) * double({f}) / double({d2}))"
    args = (f"named_struct('a', double({d2}) / 2, 'b', double({d1}) / 2, 'y', 1 / (1 + {odds}), "
            f"'z', {odds} / (1 + {odds}), 'ly', -log1p({odds}), 'lz', ln({odds}) - log1p({odds}))")
    log_beta = f"({_gamma_ratio('1D', '(p.b - 1)')} - {_gamma_ratio('p.a', 'p.b')})"
    front = "exp(p.a * p.ly + p.b * p.lz - q)"
    upper = f"{front} / p.a * {_beta_fraction('p.a', 'p.b', 'p.y')}"
    lower = f"1 - {front} / p.b * {_beta_fraction('p.b', 'p.a', 'p.z')}"
    tail = _let(log_beta, "q", f"if(p.y < (p.a + 1) / (p.a + p.b + 2), {upper}, {lower})")
    return F.expr(f"if({f} <= 0, 1D, {_let(args, 'p', tail)})")


def t_two_sided(t: str, df: str) -> Column:
    return f_sf(f"({t} * {t})", "1", df)
