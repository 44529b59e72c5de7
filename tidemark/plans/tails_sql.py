"""Distribution tails written out in SQL, for the SQL that agreement reports must agree with.

They use other formulas than `functions.tails`: finite sums for t with whole degrees of freedom and for the binomial, power
series for beta and gamma, and a recursive common table expression that bisects for quantiles. Arguments are column names.
"""

from __future__ import annotations


def t_inside(t: str, nu: str) -> str:
    """P(|T| < t) for t >= 0 and whole degrees of freedom."""
    c2, s = f"({nu} / ({nu} + {t} * {t}))", f"({t} / sqrt({nu} + {t} * {t}))"
    even = f"list_sum(list_transform(range(0, CAST({nu} // 2 AS BIGINT)), lambda j: exp(lgamma(j + 0.5) - lgamma(j + 1.0) + j * ln({c2})))) / sqrt(pi())"
    odd = f"list_sum(list_transform(range(0, CAST(({nu} - 1) // 2 AS BIGINT)), lambda j: exp(lgamma(j + 1.0) - lgamma(j + 1.5) + (j + 0.5) * ln({c2})))) * sqrt(pi()) / 2"
    return f"(CASE WHEN {nu} % 2 = 0 THEN {s} * COALESCE({even}, 0) ELSE 2 / pi() * (atan({t} / sqrt({nu})) + {s} * COALESCE({odd}, 0)) END)"


def t_above(t: str, nu: str) -> str:
    """P(T > t)."""
    return f"(CASE WHEN {t} >= 0 THEN (1 - {t_inside(f'abs({t})', nu)}) / 2 ELSE (1 + {t_inside(f'abs({t})', nu)}) / 2 END)"


def binomial_upto(k: str, n: str, p: str) -> str:
    """P(X <= k)."""
    term = f"exp(lgamma({n} + 1.0) - lgamma(i + 1.0) - lgamma({n} - i + 1.0) + i * ln({p}) + ({n} - i) * ln(1 - {p}))"
    return f"(CASE WHEN {k} >= {n} THEN 1.0 ELSE list_sum(list_transform(range(0, CAST({k} AS BIGINT) + 1), lambda i: {term})) END)"


def gamma_below(x: str, a: str, terms: int = 3000) -> str:
    """Regularised lower incomplete gamma."""
    return (
        f"(exp({a} * ln({x}) - {x} - lgamma({a} + 1.0)) * (1 + list_sum(list_transform(range(1, {terms}), "
        f"lambda j: exp(j * ln({x}) + lgamma({a} + 1.0) - lgamma({a} + j + 1.0))))))"
    )


def beta_below(x: str, a: str, b: str, terms: int = 3000) -> str:
    """Regularised incomplete beta by its power series, in the half where that converges quickly."""

    def series(x: str, a: str, b: str) -> str:
        front = f"exp({a} * ln({x}) + {b} * ln(1 - {x}) - ln({a}) - lgamma({a}) - lgamma({b}) + lgamma({a} + {b}))"
        term = f"exp(lgamma({a} + 1.0) + lgamma({a} + {b} + j + 1.0) - lgamma({a} + j + 2.0) - lgamma({a} + {b}) + (j + 1) * ln({x}))"
        return f"{front} * (1 + list_sum(list_transform(range(0, {terms}), lambda j: {term})))"

    return f"(CASE WHEN {x} > ({a} + 1) / ({a} + {b} + 2) THEN 1 - {series(f'(1 - {x})', b, a)} ELSE {series(x, a, b)} END)"


def solved(name: str, source: str, columns: str, value: str, target: str, low: str, high: str, steps: int = 90) -> str:
    """Common table expressions `name` (`columns`, x): where `value`, an increasing expression of `mid`, reaches `target`."""
    return f"""
    {name}_steps AS (
      SELECT {columns}, 0 AS step, CAST({low} AS DOUBLE) AS lo, CAST({high} AS DOUBLE) AS hi FROM {source}
      UNION ALL
      SELECT {columns}, step + 1, CASE WHEN below THEN mid ELSE lo END, CASE WHEN below THEN hi ELSE mid END
      FROM (SELECT *, {value} < {target} AS below FROM (SELECT *, (lo + hi) / 2 AS mid FROM {name}_steps WHERE step < {steps}))),
    {name} AS (SELECT {columns}, (lo + hi) / 2 AS x FROM {name}_steps WHERE step = {steps})"""


def t_quantiles(name: str, source: str, p: float) -> str:
    """`name` (nu, x): the p-quantile, p above a half, for the distinct `nu` of `source`."""
    distinct = f"(SELECT DISTINCT CAST(nu AS BIGINT) AS nu FROM {source})"
    return solved(name, distinct, "nu", t_inside("mid", "nu"), repr(2 * p - 1), "0", "1000", 110)
