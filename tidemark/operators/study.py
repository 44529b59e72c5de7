"""A study driven by its margin table: input checks, every endpoint's own test in one aggregation, and sample sizes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import tails
from tidemark.functions.columns import finite
from tidemark.operators import agreement as A
from tidemark.operators.quantiles import trimmed_sums
from tidemark.session import measured

# ---- fixed values: names of tests and scales, verdict texts -----------------------------------------------------
TOST = "tost"
NON_INFERIORITY = "non_inferiority"
BINOMIAL_CEILING = "binomial_ceiling"
LOG_RATIO = "log_ratio"
FISHER_Z = "fisher_z"
IDENTITY = "identity"
IDENTICAL = "identical in every session"
DEFECT = "differs between the arms: a defect to investigate"
#: Fewer interim sessions than this give no standard deviation to plan on.
MIN_SESSIONS = 10
# ---- end of fixed values ----------------------------------------------------------------------------------------

#: Columns of a margin table: one row per endpoint.
MARGINS = "endpoint string, tier int, test string, scale string, margin double, floor_offset double, robust boolean"
_SHAPES = {(TOST, LOG_RATIO), (TOST, IDENTITY), (NON_INFERIORITY, FISHER_Z), (NON_INFERIORITY, IDENTITY), (BINOMIAL_CEILING, IDENTITY)}


class StudyInputError(ValueError):
    """The values or the margin table do not fit the study that was declared."""


def _is_exact():
    return (F.col("test") == TOST) & (F.col("margin") == 0)


def check_margins(margins: DataFrame) -> None:
    """Raise unless endpoints are declared once and each has a test that exists on its scale."""
    shape = F.lit(False)
    for test, scale in sorted(_SHAPES):
        shape = shape | ((F.col("test") == test) & (F.col("scale") == scale))
    # a difference on its own scale is only ever tested for being none
    shape = shape & ((F.col("test") != TOST) | (F.col("scale") == LOG_RATIO) | (F.col("margin") == 0)) & (F.col("margin") >= 0)
    per = margins.groupBy("endpoint").agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(shape, F.lit(False))).alias("fits"))
    bad = per.agg(
        F.count(F.lit(1)).alias("all"), F.sort_array(F.collect_list(F.when(F.col("n") > 1, F.col("endpoint")))).alias("twice"),
        F.sort_array(F.collect_list(F.when(~F.col("fits"), F.col("endpoint")))).alias("odd"),
    ).first()
    if not bad["all"]:
        raise StudyInputError("no endpoints declared")
    if bad["twice"]:
        raise StudyInputError(f"declared more than once: {bad['twice']}")
    if bad["odd"]:
        raise StudyInputError(f"no analysis for the test, scale and margin of {bad['odd']}")


def check_sessions(values: DataFrame, margins: DataFrame, expected_n: int | None = None) -> None:
    """Raise unless every declared endpoint has one finite value in each of the same sessions, `expected_n` of them.

    One row per endpoint reaches the driver. With one value per session and endpoint, all endpoints have the same
    sessions just if each has as many as there are in all."""
    check_margins(margins)
    declared = measured(margins.select("endpoint", "test", "scale", "margin"))
    known = declared.join(values, "endpoint", "left")
    held = known.groupBy("endpoint", "test", "scale", "margin", "session").agg(
        F.count("session").alias("rows"), F.count(finite("value")).alias("finite"), F.count("arm_a").alias("a"), F.count("arm_b").alias("b"),
        F.bool_and(F.col("value").isin(0.0, 1.0)).alias("flag"),
    )
    per = held.groupBy("endpoint", "test", "scale", "margin").agg(
        F.count("session").alias("sessions"), F.max("rows").alias("most"), F.sum("rows").alias("rows"), F.sum("finite").alias("finite"),
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.bool_and("flag").alias("flags"),
    )
    total = held.filter("rows > 0").agg(F.count_distinct("session")).first()[0]
    report = sorted(per.collect(), key=lambda r: r["endpoint"])  # declared endpoints only

    def named(test) -> list[str]:
        return [r["endpoint"] for r in report if test(r)]

    for names, why in (
        (named(lambda r: not r["rows"]), "no session values for declared endpoints"),
        (named(lambda r: r["rows"] and r["most"] > 1), "a session stands more than once for"),
        (named(lambda r: r["rows"] != r["finite"]), "a session value is not finite for"),
        (named(lambda r: r["scale"] == LOG_RATIO and min(r["a"], r["b"]) < r["rows"]), "a session lacks an arm's value for"),
        (named(lambda r: r["test"] == BINOMIAL_CEILING and not r["flags"]), "indicators must be 0 or 1 for"),
        (named(lambda r: r["sessions"] != total), f"not all of the {total} sessions have a value for"),
    ):
        if names:
            raise StudyInputError(f"{why} {names}")
    if expected_n is not None and total != expected_n:
        raise StudyInputError(f"{total} sessions, but the final number recorded is {expected_n}")


def endpoint_moments(values: DataFrame, margins: DataFrame) -> DataFrame:
    """One row per declared endpoint with the sums that every test needs: one aggregation, and a second pass for the endpoints
    whose margin asks for the trimmed sensitivity test."""
    rows = values.select("endpoint", "value", "arm_a", "arm_b").join(measured(margins), "endpoint")
    a, b = finite("arm_a"), finite("arm_b")
    both = a.isNotNull() & b.isNotNull()
    la, lb = (F.when(both, F.log(x + F.col("floor_offset"))) for x in (a, b))
    diff, mean = F.when(both, a - b), F.when(both, (a + b) / 2)
    keys = ["endpoint", "tier", "test", "scale", "margin", "floor_offset", "robust"]
    x = finite("value")
    sums = rows.groupBy(*keys).agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("sd"), F.count_if(x != 0).alias("differing"), F.sum(x).alias("total"),
        F.count(F.when(both, 1)).alias("n_arms"), F.count(a).alias("_na"), F.count(b).alias("_nb"), F.avg(a).alias("_ma"), F.avg(b).alias("_mb"),
        F.avg(la).alias("_ga"), F.avg(lb).alias("_gb"), F.avg(diff).alias("absolute_mean"), F.stddev_samp(diff).alias("absolute_sd"),
        *[
            f(y, z).alias(f"{name}_{part}")
            for name, (y, z) in {"log": (la - lb, (la + lb) / 2), "abs": (diff, mean)}.items()
            for part, f in {"slope": F.regr_slope, "sxx": F.regr_sxx, "syy": F.regr_syy, "sxy": F.regr_sxy}.items()
        ],
    )
    for arm in "ab":
        sums = sums.withColumn(f"mean_{arm}", F.when(F.col(f"_n{arm}") == F.col("n"), F.col(f"_m{arm}")))
        sums = sums.withColumn(f"geomean_{arm}", F.when(F.col("scale") == LOG_RATIO, F.exp(f"_g{arm}") - F.col("floor_offset")))
    cut = trimmed_sums(rows.filter("robust"), ["endpoint"], "value", A.TRIM)
    cut = cut.select("endpoint", F.struct(F.col("cut").alias("k"), "low", "high", "s1", "s2").alias("trimmed"))
    return sums.drop("_na", "_nb", "_ma", "_mb", "_ga", "_gb").join(measured(cut), "endpoint", "left")


_ANSWERS = (
    "estimate ci_low ci_high p_value log_slope_low log_slope_high abs_slope_low abs_slope_high absolute_low absolute_high robust_estimate robust_low "
    "robust_high upper_bound"
).split()


def analyse_endpoints(values: DataFrame, margins: DataFrame, alpha: float = A.ALPHA, expected_n: int | None = None, confidence: float = 0.95) -> DataFrame:
    """Every declared endpoint by the test its margin row names, in order of tier and name.

    `values`: endpoint, session, value (on the tested scale), arm_a, arm_b. `margins`: the columns of :data:`MARGINS`; margin 0 of a TOST
    asks for identity. A log ratio is tested as ±margin and reported as a ratio with geometric means, the regressions
    that tell proportional from absolute differences, and where asked the trimmed test; Fisher z is tested on z and reported on r.
    Values of endpoints that are not declared are left out. Raises :class:`StudyInputError` first where the inputs do not fit."""
    check_sessions(values, margins, expected_n)

    def decide(p: pd.DataFrame) -> dict:
        out = {name: np.full(len(p), np.nan) for name in _ANSWERS}
        verdict, departure, proportional = (np.full(len(p), None, object) for _ in range(3))
        for i, r in enumerate(p.to_dict("records")):
            if r["test"] == TOST and r["margin"] == 0:
                verdict[i] = IDENTICAL if r["differing"] == 0 else DEFECT
            elif r["test"] == TOST:
                found = _ratio(r, alpha, confidence)
                verdict[i], departure[i], proportional[i] = found.pop("verdict"), found.pop("departure"), found.pop("proportional")
                for name, x in found.items():
                    out[name][i] = x
            elif r["test"] == NON_INFERIORITY:
                verdict[i] = _non_inferior(r, out, i, alpha)
            else:
                n, k = r["n"], r["total"]
                out["estimate"][i], out["p_value"][i] = k / n, tails.binomial_cdf(k, n, r["margin"])
                out["upper_bound"][i] = 1.0 if k >= n else tails.beta_ppf(1 - alpha, k + 1, n - k)
                verdict[i] = A.CEILING_MET if out["p_value"][i] <= alpha else A.CEILING_NOT_ESTABLISHED
        return {**out, "verdict": verdict, "departure": departure, "proportional": proportional}

    added = {**dict.fromkeys(_ANSWERS, "double"), "verdict": "string", "departure": "string", "proportional": "boolean"}
    told = A.on_rows(endpoint_moments(values, margins), added, decide)
    missing = [F.when(~F.isnan(c), F.col(c)).alias(c) for c in _ANSWERS]
    kept = ["endpoint", "tier", "test", "scale", "margin", "n", "differing", "mean_a", "mean_b", "geomean_a", "geomean_b", "log_slope", "abs_slope", "absolute_mean"]
    ratio_only = {c: F.when((F.col("scale") == LOG_RATIO), F.col(c)).alias(c) for c in ("log_slope", "abs_slope", "absolute_mean")}
    return told.select(*[ratio_only.get(c, F.col(c)) for c in kept], *missing, "verdict", "departure", "proportional").orderBy("tier", "endpoint")


def _paired(mean: float, se: float, df: float, margin: float, alpha: float) -> dict:
    row = pd.DataFrame({"estimate": [mean], "se": [se]})
    return {k: v[0] for k, v in A._decide(row, np.array([df]), np.array([margin]), alpha).items()}


def _ratio(r: dict, alpha: float, confidence: float) -> dict:
    n = r["n"]
    test = _paired(r["mean"], r["sd"] / np.sqrt(n), n - 1, r["margin"], alpha)
    out = {
        "estimate": np.exp(r["mean"]), "ci_low": np.exp(test["ci_low"]), "ci_high": np.exp(test["ci_high"]), "p_value": test["p_value"],
        "verdict": test["verdict"], "departure": test["departure"], "proportional": None,
    }
    if n >= 3:
        excludes = {}
        t = float(tails.t_ppf(1 - (1 - confidence) / 2, n - 2))
        for name in ("log", "abs"):
            sxx, syy, sxy = (r[f"{name}_{s}"] for s in ("sxx", "syy", "sxy"))
            half = t * np.sqrt(max(syy - sxy * sxy / sxx, 0.0) / (n - 2) / sxx)
            low, high = r[f"{name}_slope"] - half, r[f"{name}_slope"] + half
            out[f"{name}_slope_low"], out[f"{name}_slope_high"] = low, high
            excludes[name] = low > 0 or high < 0
        out["proportional"] = not (excludes["log"] and not excludes["abs"])
        half = float(tails.t_ppf(1 - alpha, n - 1)) * r["absolute_sd"] / np.sqrt(n)
        out["absolute_low"], out["absolute_high"] = r["absolute_mean"] - half, r["absolute_mean"] + half
    cut = r["trimmed"]
    if cut is not None and n - 2 * cut["k"] >= 3:
        k = cut["k"]
        mean_w = (cut["s1"] + k * (cut["low"] + cut["high"])) / n
        var_w = max(cut["s2"] + k * (cut["low"] ** 2 + cut["high"] ** 2) - n * mean_w**2, 0.0) / (n - 1)
        robust = _paired(cut["s1"] / (n - 2 * k), np.sqrt(var_w) / ((1 - 2 * k / n) * np.sqrt(n)), n - 2 * k - 1, r["margin"], alpha)
        out |= {"robust_estimate": np.exp(cut["s1"] / (n - 2 * k)), "robust_low": np.exp(robust["ci_low"]), "robust_high": np.exp(robust["ci_high"])}
    return out


def _non_inferior(r: dict, out: dict, i: int, alpha: float) -> str:
    fisher = r["scale"] == FISHER_Z
    bound = np.arctanh(np.clip(r["margin"], -A.R_CLIP, A.R_CLIP)) if fisher else r["margin"]
    mean, n = r["mean"], r["n"]
    se = r["sd"] / np.sqrt(n)
    lower = mean - float(tails.t_ppf(1 - alpha, n - 1)) * se if se > 0 else mean
    out["estimate"][i], out["ci_low"][i] = (np.tanh(mean), np.tanh(lower)) if fisher else (mean, lower)
    out["p_value"][i] = float(tails.t_sf((mean - bound) / se, n - 1)) if se > 0 else float(lower <= bound)
    return A.NON_INFERIOR if lower > bound else A.NI_NOT_ESTABLISHED


def interim_spread(values: DataFrame, margins: DataFrame, confidence: float = 0.8) -> DataFrame:
    """(endpoint, n, sd, sd_upper) of the interim session values; sd_upper is the upper confidence limit of a normal sd.

    Endpoints tested exactly or by counting have none. No mean, interval or verdict is looked at."""
    planned = margins.filter(~_is_exact() & (F.col("test") != BINOMIAL_CEILING)).select("endpoint")
    x = finite("value")
    spread = values.join(measured(planned), "endpoint").groupBy("endpoint").agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"))
    return A.sd_upper_limit(spread, confidence=confidence)


def planned_sizes(
    values: DataFrame, margins: DataFrame, assumed: DataFrame, floor: int, cap: int, power: float = 0.8, alpha: float = A.ALPHA, confidence: float = 0.8
) -> DataFrame:
    """(endpoint, test, n, sd, sd_upper, required, binding, final_n, capped): the size each endpoint needs and the study's.

    `assumed` (endpoint, assumed) holds the true values planned under, on the endpoint's own scale: a ratio, a correlation, a
    difference or a share. A log ratio is sized for a true difference that is not zero, a ceiling by exact search, as its power is
    no monotone function of n. The study's size is min(cap, max(floor, largest)). Raises :class:`StudyInputError` where an endpoint
    lacks interim values or an assumed value, or where no size can reach the power."""
    check_margins(margins)
    sized = margins.filter(~_is_exact()).join(assumed, "endpoint", "left").join(interim_spread(values, margins, confidence), "endpoint", "left")

    def solve(p: pd.DataFrame) -> dict:
        return {"required": pd.array([_required(r, cap, power, alpha) for r in p.to_dict("records")], dtype="Int64")}

    needs = A.on_rows(sized.select("endpoint", "test", "scale", "margin", "assumed", "n", "sd", "sd_upper"), {"required": "bigint"}, solve)
    largest = needs.groupBy(F.lit(1).alias("one")).agg(F.max("required").alias("largest")).select("largest")
    first = needs.groupBy(F.lit(1).alias("one")).agg(F.min_by("endpoint", F.struct(-F.col("required"), "endpoint")).alias("first")).select("first")
    top = largest.scalar()
    return needs.withColumn("largest", top).select(
        "endpoint", "test", "n", "sd", "sd_upper", "required", (F.col("endpoint") == first.scalar()).alias("binding"),
        F.least(F.lit(cap), F.greatest(F.lit(floor), "largest")).alias("final_n"), (F.col("largest") > cap).alias("capped"),
    )


def _required(r: dict, cap: int, power: float, alpha: float) -> int:
    name, margin, assumed = r["endpoint"], r["margin"], r["assumed"]
    if assumed is None or np.isnan(assumed):
        raise StudyInputError(f"no assumed value for {name}")
    if r["test"] == BINOMIAL_CEILING:
        return tails.ceiling_size(margin, assumed, power, alpha, 10 * cap)
    if pd.isna(r["n"]) or r["n"] < MIN_SESSIONS:
        raise StudyInputError(f"{name}: {0 if pd.isna(r['n']) else int(r['n'])} interim session values; at least {MIN_SESSIONS} are needed")
    sd = r["sd_upper"]
    if not sd > 0:
        raise StudyInputError(f"{name}: the sd must be positive, got {sd}")
    if r["test"] == TOST:
        true = np.log(assumed) if r["scale"] == LOG_RATIO else assumed
        if abs(true) >= margin:
            raise StudyInputError(f"{name}: an assumed difference of {true:g} is not inside ±{margin:g}; no size establishes equivalence")
        return tails.smallest_n(lambda n: float(np.ravel(tails.tost_power(float(n), margin, sd, true, alpha))[0]), power)
    if r["scale"] == FISHER_Z:
        gap = np.arctanh(np.clip(assumed, -A.R_CLIP, A.R_CLIP)) - np.arctanh(np.clip(margin, -A.R_CLIP, A.R_CLIP))
    else:
        gap = assumed - margin
    if not gap > 0:
        raise StudyInputError(f"{name}: the assumed value is not above the threshold; no size establishes non-inferiority")
    return tails.smallest_n(lambda n: float(np.ravel(tails.one_sided_power(float(n), gap, sd, alpha))[0]), power)
