"""Margin-driven analysis and sizes: refused inputs, published sizes, exact search and decisions on small hand-made studies."""

import math

import numpy as np
import pytest

from tidemark.functions import tails
from tidemark.operators import study as S

VALUES = "endpoint string, session string, value double, arm_a double, arm_b double"


def study(frame, margins, rows):
    return frame(rows, VALUES), frame(margins, S.MARGINS)


RATIO = ("ratio", 1, "tost", "log_ratio", 0.2, 0.0, True)
EXACT = ("exact", 2, "tost", "identity", 0.0, 0.0, False)
CORR = ("corr", 1, "non_inferiority", "fisher_z", 0.5, 0.0, False)
RARE = ("rare", 1, "binomial_ceiling", "identity", 0.5, 0.0, False)


def ratios(n=12, shift=0.0):
    return [("ratio", f"s{i}", math.log((10 + i + shift) / (10 + i * 1.01)), 10.0 + i + shift, 10 + i * 1.01) for i in range(n)]


def test_values_that_do_not_fit_are_refused(frame):
    good = ratios()
    flags = [("rare", f"s{i}", float(i < 2), None, None) for i in range(12)]
    cases = [
        ([RATIO, RARE], good, "no session values"),
        ([RATIO], good + [good[0]], "more than once"),
        ([RATIO], [*good[:-1], ("ratio", "s11", math.inf, 1.0, 1.0)], "not finite"),
        ([RATIO], [*good[:-1], ("ratio", "s11", 0.1, None, 1.0)], "lacks an arm"),
        ([RATIO, RARE], good + [*flags[:-1], ("rare", "s11", 0.5, None, None)], "0 or 1"),
        ([RATIO, RARE], good + flags[:-1], "not all of the 12"),
        ([RATIO, RARE], good + [*flags[:-1], ("rare", "other", 0.0, None, None)], "not all of the 13"),
        ([RATIO, RATIO], good, "declared more than once"),
        ([("x", 1, "tost", "identity", 0.1, 0.0, False)], good, "no analysis"),
        ([], good, "no endpoints"),
    ]
    for margins, rows, why in cases:
        values, table = study(frame, margins, rows)
        with pytest.raises(S.StudyInputError, match=why):
            S.analyse_endpoints(values, table)
    values, table = study(frame, [RATIO], good)
    with pytest.raises(S.StudyInputError, match="12 sessions"):
        S.analyse_endpoints(values, table, expected_n=13)


def test_each_endpoint_has_its_own_test(frame):
    n = 12
    rows = ratios(n) + [("exact", f"s{i}", 0.0, None, None) for i in range(n)] + [("rare", f"s{i}", float(i == 0), None, None) for i in range(n)]
    rows += [("corr", f"s{i}", math.atanh(0.8) + 0.01 * (i % 3 - 1), None, None) for i in range(n)] + [("undeclared", "s0", math.nan, None, None)]
    values, margins = study(frame, [EXACT, RARE, RATIO, CORR], rows)
    out = S.analyse_endpoints(values, margins, expected_n=n).collect()
    assert [r["endpoint"] for r in out] == ["corr", "rare", "ratio", "exact"]  # by tier, then name
    got = {r["endpoint"]: r for r in out}
    assert got["exact"]["verdict"] == S.IDENTICAL and got["exact"]["p_value"] is None
    assert got["rare"]["p_value"] == pytest.approx(13 / 2**12) and got["rare"]["verdict"] == "below the ceiling"
    assert got["corr"]["estimate"] == pytest.approx(0.8) and got["corr"]["verdict"] == "non-inferior"
    ratio, x = got["ratio"], np.array([r[2] for r in ratios(n)])
    assert ratio["verdict"] == "equivalent" and ratio["estimate"] == pytest.approx(math.exp(x.mean()))
    half = 1.7958848187 * x.std(ddof=1) / math.sqrt(n)  # t at 0.95 with 11 degrees of freedom
    assert ratio["ci_high"] == pytest.approx(math.exp(x.mean() + half))
    kept = np.sort(x)[2:10]
    assert ratio["robust_estimate"] == pytest.approx(math.exp(kept.mean()))
    assert ratio["geomean_a"] == pytest.approx(math.exp(np.mean([math.log(10 + i) for i in range(n)])))


def test_one_sided_sizes_of_published_tables():
    """One-sample t test, one-sided, alpha 0.05, power 0.8."""
    for effect, n in ((0.2, 156), (0.5, 27), (0.8, 12)):
        assert tails.smallest_n(lambda k, e=effect: float(np.ravel(tails.one_sided_power(float(k), e, 1.0))[0]), 0.8) == n


def test_a_true_difference_raises_the_size():
    sizes = [tails.smallest_n(lambda k, d=d: float(np.ravel(tails.tost_power(float(k), 0.5, 1.0, d))[0]), 0.8) for d in (0.0, 0.1, 0.2, -0.2)]
    assert sizes[0] < sizes[1] < sizes[2] == sizes[3]


@pytest.mark.parametrize(("ceiling", "share"), [(0.2, 0.05), (0.5, 0.3), (0.1, 0.02)])
def test_ceiling_size_by_exact_search(ceiling, share):
    def upto(k, n, p):
        return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))

    want = next(n for n in range(2, 500) if any(upto(k, n, ceiling) <= 0.05 and upto(k, n, share) >= 0.8 for k in range(n + 1)))
    assert tails.ceiling_size(ceiling, share, 0.8, 0.05, 500) == want
    assert tails.ceiling_size(ceiling, share, 0.8, 0.05, want - 1) == want  # none found: one more than was searched


def test_the_largest_need_sizes_the_study(frame):
    rng = np.random.default_rng(2)
    rows = [("ratio", f"s{i}", float(x), 1.0, 1.0) for i, x in enumerate(rng.normal(0, 0.3, 20))]
    rows += [("corr", f"s{i}", float(x), None, None) for i, x in enumerate(rng.normal(1, 0.2, 20))]
    values, margins = study(frame, [RATIO, CORR, RARE, EXACT], rows)

    def plan(floor=5, cap=1000, **assumed):
        table = frame(sorted({"ratio": 1.0, "corr": 0.7, "rare": 0.2, **assumed}.items()), "endpoint string, assumed double")
        return {r["endpoint"]: r for r in S.planned_sizes(values, margins, table, floor, cap).collect()}

    base = plan()
    assert set(base) == {"ratio", "corr", "rare"} and sum(r["binding"] for r in base.values()) == 1
    assert base["ratio"]["sd_upper"] > base["ratio"]["sd"] and base["rare"]["sd"] is None
    largest = max(r["required"] for r in base.values())
    assert {r["final_n"] for r in base.values()} == {largest}
    assert plan(ratio=1.1)["ratio"]["required"] > base["ratio"]["required"]
    assert {(r["final_n"], r["capped"]) for r in plan(cap=8).values()} == {(8, True)}
    assert {r["final_n"] for r in plan(floor=900).values()} == {900}
    for bad, why in (({"ratio": 1.5}, "not inside"), ({"corr": 0.4}, "not above"), ({"rare": None}, "no assumed")):
        with pytest.raises(Exception, match=why):
            plan(**bad)
    few = frame(rows[:5], VALUES)
    with pytest.raises(Exception, match="at least 10"):
        S.planned_sizes(few, frame([RATIO], S.MARGINS), frame([("ratio", 1.0)], "endpoint string, assumed double"), 5, 100).collect()
