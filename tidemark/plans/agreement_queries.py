"""Paired agreement over events: two event types are the arms, a (user, day) pair is a run, the user its cluster."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import day
from tidemark.operators import agreement as A
from tidemark.operators import study as ST
from tidemark.plans.registry import query, rounded
from tidemark.plans.tails_sql import beta_below, binomial_upto, gamma_below, solved, t_above, t_quantiles

_ARMS = """
    WITH arms AS (SELECT user_id AS cluster, strftime(ts, '%Y-%m-%d') AS d, user_id % 4 AS endpoint, AVG(CASE WHEN event_type IN ('click', 'view') THEN value END) AS a,
                         AVG(CASE WHEN event_type IN ('purchase', 'signup', 'error') THEN value END) AS b FROM events GROUP BY ALL),
    p AS (SELECT * FROM arms WHERE a IS NOT NULL AND b IS NOT NULL)"""


_RECURSIVE = _ARMS.replace("WITH", "WITH RECURSIVE", 1)


def _decided(moments: str, df: str, margin: str) -> str:
    """Common table expressions from `moments` (estimate, se, n, ...) to `decided`: interval, p-value, verdict and departure of a TOST."""
    return f"""
    dof AS (SELECT *, CAST({df} AS BIGINT) AS nu, {margin} AS margin FROM {moments}),
    {t_quantiles("crit", "dof", 0.95)},
    bounds AS (SELECT dof.*, estimate - crit.x * se AS ci_low, estimate + crit.x * se AS ci_high, (estimate + margin) / se AS t_low, (margin - estimate) / se AS t_high FROM dof JOIN crit USING (nu)),
    decided AS (SELECT *, GREATEST({t_above("t_low", "nu")}, {t_above("t_high", "nu")}) AS p_value, CASE WHEN ci_low > -margin AND ci_high < margin THEN 'equivalent' ELSE 'equivalence not established' END AS verdict,
                       CASE WHEN ci_low > -margin AND ci_high < margin THEN 'none' WHEN ci_low > margin THEN 'arm a higher' WHEN ci_high < -margin THEN 'arm b higher' ELSE 'unresolved' END AS departure FROM bounds)"""


def _arms(t):
    kind = F.col("event_type")
    return (
        t.events.groupBy(F.col("user_id").alias("cluster"), day("ts").alias("d"), (F.col("user_id") % 4).alias("endpoint"))
        .agg(
            F.avg(F.when(kind.isin("click", "view"), F.col("value"))).alias("a"),
            F.avg(F.when(kind.isin("purchase", "signup", "error"), F.col("value"))).alias("b"),
        )
        .filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    )


@query("e1_cluster_means", _ARMS + " SELECT endpoint, cluster, ROUND(AVG(a), 9) AS a, ROUND(AVG(b), 9) AS b FROM p GROUP BY endpoint, cluster")
def cluster_means(t):
    return rounded(A.cluster_means(_arms(t), ["endpoint"], ["cluster"], ["a", "b"]), 9)


@query(
    "e2_difference_moments",
    _ARMS + " SELECT endpoint, COUNT(*) AS n, ROUND(AVG(a - b), 8) AS estimate, ROUND(STDDEV_SAMP(a - b) / sqrt(COUNT(*)), 8) AS se FROM p GROUP BY endpoint",
)
def difference_moments(t):
    return rounded(A.difference_moments(_arms(t), ["endpoint"], F.col("a") - F.col("b")), 8)


@query(
    "e2_tost",
    _RECURSIVE
    + f""",
    moments AS (SELECT endpoint, COUNT(*) AS n, AVG(a - b) AS estimate, STDDEV_SAMP(a - b) / sqrt(COUNT(*)) AS se FROM p GROUP BY endpoint),{_decided("moments", "n - 1", "5.0")}
    SELECT endpoint, n, ROUND(estimate, 6) AS estimate, ROUND(se, 6) AS se, margin, ROUND(ci_low, 6) AS ci_low, ROUND(ci_high, 6) AS ci_high, ROUND(p_value, 6) AS p_value, verdict, departure FROM decided""",
)
def tost(t):
    return rounded(A.tost(_arms(t), ["endpoint"], F.col("a") - F.col("b"), 5.0), 6)


_TRIMMED = """,
    r AS (SELECT endpoint, a - b AS d, ROW_NUMBER() OVER (PARTITION BY endpoint ORDER BY a - b) AS rk, COUNT(*) OVER (PARTITION BY endpoint) AS n FROM p),
    k AS (SELECT *, CAST(floor(0.2 * n) AS BIGINT) AS k FROM r), w AS (SELECT *, MIN(d) FILTER (rk > k) OVER (PARTITION BY endpoint) AS lo, MAX(d) FILTER (rk <= n - k) OVER (PARTITION BY endpoint) AS hi FROM k),
    trimmed AS (SELECT endpoint, MAX(n) AS n, MAX(k) AS k, AVG(d) FILTER (rk > k AND rk <= n - k) AS estimate,
                       STDDEV_SAMP(GREATEST(LEAST(d, hi), lo)) / ((1 - 2 * MAX(k) / MAX(n)) * sqrt(MAX(n))) AS se FROM w GROUP BY endpoint)"""


@query("e3_trimmed_moments", _ARMS + _TRIMMED + " SELECT endpoint, n, k, ROUND(estimate, 8) AS estimate, ROUND(se, 8) AS se FROM trimmed")
def trimmed_moments(t):
    return rounded(A.trimmed_moments(_arms(t), ["endpoint"], F.col("a") - F.col("b")), 8)


@query(
    "e3_trimmed_tost",
    _RECURSIVE
    + _TRIMMED
    + f""",{_decided("trimmed", "n - 2 * k - 1", "5.0")}
    SELECT endpoint, n, k, ROUND(estimate, 6) AS estimate, ROUND(se, 6) AS se, margin, ROUND(ci_low, 6) AS ci_low, ROUND(ci_high, 6) AS ci_high, ROUND(p_value, 6) AS p_value, verdict, departure FROM decided""",
)
def trimmed_tost(t):
    return rounded(A.trimmed_tost(_arms(t), ["endpoint"], F.col("a") - F.col("b"), 5.0), 6)


@query(
    "e4_non_inferiority",
    _RECURSIVE
    + f""",
    f AS (SELECT endpoint, atanh(LEAST(GREATEST(a / (a + b), -(1 - 1e-7)), 1 - 1e-7)) AS z FROM p),
    m AS (SELECT endpoint, COUNT(*) AS n, CAST(COUNT(*) - 1 AS BIGINT) AS nu, AVG(z) AS mean, STDDEV_SAMP(z) / sqrt(COUNT(*)) AS se FROM f GROUP BY endpoint),
    {t_quantiles("crit", "m", 0.95)},
    l AS (SELECT m.*, mean - x * se AS low, (mean - atanh(0.45)) / se AS t FROM m JOIN crit USING (nu))
    SELECT endpoint, n, ROUND(tanh(mean), 6) AS estimate, ROUND(se, 6) AS se, ROUND(tanh(low), 6) AS lower_bound, 0.45 AS threshold, ROUND({t_above("t", "nu")}, 6) AS p_value,
           CASE WHEN low > atanh(0.45) THEN 'non-inferior' ELSE 'non-inferiority not established' END AS verdict FROM l""",
)
def non_inferiority(t):
    return rounded(A.non_inferiority(_arms(t), ["endpoint"], F.col("a") / (F.col("a") + F.col("b")), 0.45, fisher=True), 6)


@query(
    "e5_binomial_ceiling",
    _RECURSIVE
    + f""",
    c AS (SELECT endpoint, COUNT(*) AS n, COUNT(*) FILTER (a < 10) AS k FROM p GROUP BY endpoint),
    {solved("top", "(SELECT DISTINCT n, k FROM c)", "n, k", f"1 - {binomial_upto('k', 'n', 'mid')}", "0.95", "0", "1")}
    SELECT endpoint, n, k AS below, ROUND(k / n, 6) AS share, ROUND(CASE WHEN k = n THEN 1.0 ELSE x END, 6) AS upper_bound, ROUND({binomial_upto("k", "n", "0.25")}, 6) AS p_value,
           CASE WHEN {binomial_upto("k", "n", "0.25")} <= 0.05 THEN 'below the ceiling' ELSE 'ceiling not established' END AS verdict FROM c JOIN top USING (n, k)""",
)
def binomial_ceiling(t):
    below = F.when(F.col("a") < 10, 1.0).otherwise(0.0)
    return rounded(A.binomial_ceiling(_arms(t), ["endpoint"], below, 0.25), 6)


@query(
    "e6_icc_agreement",
    _ARMS
    + """,
    m AS (SELECT endpoint, COUNT(*) AS n, VAR_SAMP(a + b) / 2 AS r, VAR_SAMP(a - b) / 2 AS e, COUNT(*) * AVG(a - b) * AVG(a - b) / 2 AS c FROM p GROUP BY endpoint)
    SELECT endpoint, n, ROUND(r, 6) AS ms_rows, ROUND(c, 6) AS ms_columns, ROUND(e, 6) AS ms_error, ROUND((r - e) / (r + e + 2 * (c - e) / n), 8) AS icc FROM m""",
)
def icc_agreement(t):
    return rounded(A.icc_agreement(_arms(t), ["endpoint"], "a", "b"), 6, icc=8)


@query(
    "e6_icc_interval",
    _RECURSIVE
    + f""",
    m AS (SELECT endpoint, COUNT(*) AS n, VAR_SAMP(a + b) / 2 AS r, VAR_SAMP(a - b) / 2 AS e, COUNT(*) * AVG(a - b) * AVG(a - b) / 2 AS c FROM p GROUP BY endpoint),
    i AS (SELECT *, (r - e) / (r + e + 2 * (c - e) / n) AS icc FROM m), uw AS (SELECT *, 2 * icc / (n * (1 - icc)) AS u, 1 + 2 * icc * (n - 1) / (n * (1 - icc)) AS w FROM i),
    v AS (SELECT *, power(u * c + w * e, 2) / (power(u * c, 2) + power(w * e, 2) / (n - 1)) AS v FROM uw),
    {solved("one", "(SELECT endpoint, (n - 1) / 2.0 AS da, v / 2 AS db FROM v)", "endpoint, da, db", beta_below("mid", "da", "db"), "0.975", "0", "1")},
    {solved("two", "(SELECT endpoint, v / 2 AS da, (n - 1) / 2.0 AS db FROM v)", "endpoint, da, db", beta_below("mid", "da", "db"), "0.975", "0", "1")},
    f AS (SELECT v.*, one.db * one.x / (one.da * (1 - one.x)) AS f1, two.db * two.x / (two.da * (1 - two.x)) AS f2, 2 * c + (n - 2) * e AS shared FROM v JOIN one USING (endpoint) JOIN two USING (endpoint)),
    g AS (SELECT *, n * (r - f1 * e) / (f1 * shared + n * r) AS g1, n * (f2 * r - e) / (shared + n * f2 * r) AS g2 FROM f)
    SELECT endpoint, n, ROUND(r, 6) AS ms_rows, ROUND(c, 6) AS ms_columns, ROUND(e, 6) AS ms_error, ROUND(icc, 6) AS icc, ROUND(LEAST(g1, g2), 6) AS icc_low, ROUND(GREATEST(g1, g2), 6) AS icc_high FROM g""",
)
def icc_interval(t):
    return rounded(A.icc_interval(A.icc_agreement(_arms(t), ["endpoint"], "a", "b")), 6)


@query(
    "e7_icc_one_way",
    _ARMS
    + """,
    g AS (SELECT endpoint, AVG(a) AS g FROM p GROUP BY endpoint), c AS (SELECT endpoint, cluster, COUNT(*) AS m, AVG(a) AS mean, VAR_POP(a) AS v FROM p GROUP BY ALL),
    s AS (SELECT endpoint, COUNT(*) AS k, SUM(m) AS n, SUM(m * m) AS m2, SUM(m * (mean - g) * (mean - g)) AS ssb, SUM(m * v) AS ssw FROM c JOIN g USING (endpoint) GROUP BY endpoint),
    f AS (SELECT endpoint, k, n, (n - m2 / n) / (k - 1) AS size, ssb / (k - 1) AS msb, ssw / (n - k) AS msw FROM s),
    i AS (SELECT *, GREATEST(0.0, LEAST(1.0, (msb - msw) / (msb + (size - 1) * msw))) AS icc FROM f)
    SELECT endpoint, k AS n_clusters, CAST(n AS BIGINT) AS n, ROUND(size, 8) AS mean_cluster_size, ROUND(icc, 8) AS icc1, ROUND(1 + (n / k - 1) * icc, 8) AS design_effect, ROUND(n / (1 + (n / k - 1) * icc), 6) AS effective_n FROM i""",
)
def icc_one_way(t):
    return rounded(A.with_design_effect(A.icc_one_way(_arms(t), ["endpoint"], ["cluster"], "a")), 8, effective_n=6)


@query(
    "e8_bland_altman",
    _ARMS
    + """ SELECT endpoint, COUNT(*) AS n, ROUND(AVG(a - b), 8) AS bias, ROUND(STDDEV_SAMP(a - b), 8) AS sd, ROUND(AVG(a - b) - 1.96 * STDDEV_SAMP(a - b), 8) AS loa_low, ROUND(AVG(a - b) + 1.96 * STDDEV_SAMP(a - b), 8) AS loa_high FROM p GROUP BY endpoint""",
)
def bland_altman(t):
    return rounded(A.bland_altman(_arms(t), ["endpoint"], "a", "b"), 8)


@query(
    "e8_bland_altman_intervals",
    _RECURSIVE
    + f""",
    m AS (SELECT endpoint, COUNT(*) AS n, CAST(COUNT(*) - 1 AS BIGINT) AS nu, AVG(a - b) AS bias, STDDEV_SAMP(a - b) AS sd FROM p GROUP BY endpoint),
    {t_quantiles("crit", "m", 0.975)},
    h AS (SELECT m.*, bias - 1.96 * sd AS lo, bias + 1.96 * sd AS hi, x * sd / sqrt(n) AS hb, x * sd * sqrt(3.0 / n) AS hl FROM m JOIN crit USING (nu))
    SELECT endpoint, n, ROUND(bias, 6) AS bias, ROUND(sd, 6) AS sd, ROUND(lo, 6) AS loa_low, ROUND(hi, 6) AS loa_high, ROUND(bias - hb, 6) AS bias_ci_low, ROUND(bias + hb, 6) AS bias_ci_high,
           ROUND(lo - hl, 6) AS loa_low_ci_low, ROUND(lo + hl, 6) AS loa_low_ci_high, ROUND(hi - hl, 6) AS loa_high_ci_low, ROUND(hi + hl, 6) AS loa_high_ci_high FROM h""",
)
def bland_altman_intervals(t):
    return rounded(A.bland_altman_intervals(A.bland_altman(_arms(t), ["endpoint"], "a", "b")), 6)


_SLOPES = """,
    q AS (SELECT endpoint, (ln(a + 1) + ln(b + 1)) / 2 AS lm, ln(a + 1) - ln(b + 1) AS ld, (a + b) / 2 AS m, a - b AS d FROM p),
    s AS (SELECT endpoint, COUNT(*) AS n, AVG(d) AS ad, STDDEV_SAMP(d) AS sd, REGR_SLOPE(ld, lm) AS ls, REGR_SLOPE(d, m) AS s, REGR_SXX(ld, lm) AS lxx, REGR_SYY(ld, lm) AS lyy, REGR_SXY(ld, lm) AS lxy, REGR_SXX(d, m) AS xx, REGR_SYY(d, m) AS yy, REGR_SXY(d, m) AS xy FROM q GROUP BY endpoint),
    e AS (SELECT *, sqrt((lyy - lxy * lxy / lxx) / (n - 2) / lxx) AS le, sqrt((yy - xy * xy / xx) / (n - 2) / xx) AS se FROM s)"""


@query(
    "e9_proportionality_slopes",
    _ARMS
    + _SLOPES
    + """ SELECT endpoint, n, ROUND(ad, 7) AS absolute_mean, ROUND(sd, 7) AS absolute_sd, ROUND(ls, 7) AS log_slope, ROUND(s, 7) AS abs_slope, ROUND(le, 7) AS log_stderr, ROUND(se, 7) AS abs_stderr FROM e""",
)
def proportionality_slopes(t):
    return rounded(A.proportionality_moments(_arms(t), ["endpoint"], "a", "b", 1.0), 7)


@query(
    "e9_proportionality",
    _RECURSIVE
    + _SLOPES
    + f""",
    {t_quantiles("slope_t", "(SELECT n - 2 AS nu FROM e)", 0.975)},
    {t_quantiles("mean_t", "(SELECT n - 1 AS nu FROM e)", 0.95)},
    i AS (SELECT e.*, ls - slope_t.x * le AS ll, ls + slope_t.x * le AS lh, s - slope_t.x * se AS sl, s + slope_t.x * se AS sh, mean_t.x * sd / sqrt(n) AS half FROM e JOIN slope_t ON slope_t.nu = n - 2 JOIN mean_t ON mean_t.nu = n - 1)
    SELECT endpoint, n, ROUND(ad, 6) AS absolute_mean, ROUND(sd, 6) AS absolute_sd, ROUND(ls, 6) AS log_slope, ROUND(s, 6) AS abs_slope, ROUND(le, 6) AS log_stderr, ROUND(se, 6) AS abs_stderr, ROUND(ll, 6) AS log_low, ROUND(lh, 6) AS log_high,
           ROUND(sl, 6) AS abs_low, ROUND(sh, 6) AS abs_high, ROUND(ad - half, 6) AS absolute_low, ROUND(ad + half, 6) AS absolute_high, NOT ((ll > 0 OR lh < 0) AND NOT (sl > 0 OR sh < 0)) AS proportional FROM i""",
)
def proportionality(t):
    return rounded(A.proportionality(_arms(t), ["endpoint"], "a", "b", 1.0), 6)


@query("e10_required_sessions")
def required_sessions(t):
    sessions = A.cluster_means(_arms(t), ["endpoint"], ["cluster"], ["a", "b"])
    sd = sessions.groupBy("endpoint").agg(F.stddev_samp(F.col("a") - F.col("b")).alias("sd"))
    sized = sd.select("endpoint", F.lit(8.0).alias("gap"), "sd", (F.col("endpoint") % 2 == 0).alias("one_sided"))
    return rounded(A.required_sessions(sized), 6)


_SD_UPPER = solved("chi", "(SELECT DISTINCT n FROM m)", "n", gamma_below("(mid / 2)", "((n - 1) / 2.0)"), "0.2", "0", "10 * n + 100")


@query(
    "e10_sd_upper_limit",
    _RECURSIVE
    + f""",
    m AS (SELECT endpoint, COUNT(*) AS n, STDDEV_SAMP(a - b) AS sd FROM p GROUP BY endpoint),{_SD_UPPER}
    SELECT endpoint, n, ROUND(sd, 6) AS sd, ROUND(sd * sqrt((n - 1) / x), 6) AS sd_upper FROM m JOIN chi USING (n)""",
)
def sd_upper_limit(t):
    return rounded(A.sd_upper_limit(A.bland_altman(_arms(t), ["endpoint"], "a", "b")).select("endpoint", "n", "sd", "sd_upper"), 6)


#: endpoint, tier, test, scale, margin, floor offset, trimmed sensitivity test
_MARGINS = [
    ("ratio", 1, "tost", "log_ratio", 0.3, 1.0, True), ("tight", 2, "tost", "log_ratio", 0.01, 1.0, False), ("identical", 1, "tost", "identity", 0.0, 0.0, False),
    ("defect", 2, "tost", "identity", 0.0, 0.0, False), ("corr", 1, "non_inferiority", "fisher_z", 0.45, 0.0, False),
    ("share", 2, "non_inferiority", "identity", 0.55, 0.0, False), ("rare", 2, "binomial_ceiling", "identity", 0.5, 0.0, False),
]
_MARGIN_ROWS = ", ".join(f"('{e}', {t}, '{k}', '{s}', {m}, {o}, {str(r).lower()})" for e, t, k, s, m, o, r in _MARGINS)
_STUDY = (
    _RECURSIVE
    + f""",
    ses AS (SELECT cluster, AVG(a) AS a, AVG(b) AS b FROM p GROUP BY cluster), mar(endpoint, tier, test, scale, margin, off, robust) AS (VALUES {_MARGIN_ROWS}),
    v AS (SELECT e AS endpoint, cluster, CASE WHEN e IN ('ratio', 'tight', 'defect', 'share') THEN a END AS a, CASE WHEN e IN ('ratio', 'tight', 'defect') THEN b END AS b,
                 CASE e WHEN 'ratio' THEN ln(a + 1) - ln(b + 1) WHEN 'tight' THEN ln(a + 1) - ln(b + 1) WHEN 'identical' THEN 0 WHEN 'defect' THEN floor(a) - floor(b)
                        WHEN 'corr' THEN atanh(LEAST(GREATEST(a / (a + b), -(1 - 1e-7)), 1 - 1e-7)) WHEN 'share' THEN a / (a + b) ELSE CASE WHEN a < 18 THEN 1 ELSE 0 END END AS x
          FROM ses, (SELECT endpoint AS e FROM mar)),
    z AS (SELECT mar.*, COUNT(x) AS n, AVG(x) AS mean, STDDEV_SAMP(x) AS sd, STDDEV_SAMP(x) / sqrt(COUNT(x)) AS se, COUNT(*) FILTER (x <> 0) AS differing, CAST(SUM(x) AS DOUBLE) AS total, AVG(a) AS ma, AVG(b) AS mb,
                 exp(AVG(ln(a + off))) - MAX(off) AS ga, exp(AVG(ln(b + off))) - MAX(off) AS gb, AVG(a - b) AS ad, STDDEV_SAMP(a - b) AS asd,
                 REGR_SLOPE(ln(a + off) - ln(b + off), (ln(a + off) + ln(b + off)) / 2) AS ls, REGR_SXX(ln(a + off) - ln(b + off), (ln(a + off) + ln(b + off)) / 2) AS lxx, REGR_SYY(ln(a + off) - ln(b + off), (ln(a + off) + ln(b + off)) / 2) AS lyy,
                 REGR_SXY(ln(a + off) - ln(b + off), (ln(a + off) + ln(b + off)) / 2) AS lxy, REGR_SLOPE(a - b, (a + b) / 2) AS s, REGR_SXX(a - b, (a + b) / 2) AS sxx, REGR_SYY(a - b, (a + b) / 2) AS syy, REGR_SXY(a - b, (a + b) / 2) AS sxy
          FROM v JOIN mar USING (endpoint) GROUP BY ALL)"""
)


def _sessions(t):
    """(values, margins) of a made-up study: a user is a session, and each endpoint a function of its two arms."""
    ses = _arms(t).groupBy("cluster").agg(F.avg("a").alias("a"), F.avg("b").alias("b"))
    a, b, none = F.col("a"), F.col("b"), F.lit(None).cast("double")
    ratio, share = F.log(a + 1) - F.log(b + 1), a / (a + b)
    cells = {
        "ratio": (ratio, a, b), "tight": (ratio, a, b), "identical": (F.lit(0.0), none, none), "defect": ((F.floor(a) - F.floor(b)).cast("double"), a, b),
        "corr": (A.fisher_z(share), none, none), "share": (share, a, none), "rare": (F.when(a < 18, 1.0).otherwise(0.0), none, none), "undeclared": (a, a, none),
    }
    long = F.array(*[F.struct(F.lit(e).alias("endpoint"), x.alias("value"), p.alias("arm_a"), q.alias("arm_b")) for e, (x, p, q) in cells.items()])
    values = ses.select(F.col("cluster").alias("session"), F.inline(long))
    return values, t.spark.createDataFrame(_MARGINS, ST.MARGINS)


@query(
    "e10_interim_spread",
    _STUDY
    + f""",
    m AS (SELECT endpoint, n, sd FROM z WHERE test <> 'binomial_ceiling' AND (test <> 'tost' OR margin > 0)),{_SD_UPPER}
    SELECT endpoint, n, ROUND(sd, 7) AS sd, ROUND(sd * sqrt((n - 1) / x), 7) AS sd_upper FROM m JOIN chi USING (n)""",
)
def interim_spread(t):
    values, margins = _sessions(t)
    return rounded(ST.interim_spread(values, margins), 7)


@query("e10_planned_sizes")
def planned_sizes(t):
    """Sizes under true differences that are not zero, and by exact search for the ceiling; its spreads are `e10_interim_spread`."""
    values, margins = _sessions(t)
    assumed = t.spark.createDataFrame([("ratio", 1.05), ("tight", 0.999), ("corr", 0.5), ("share", 0.6), ("rare", 0.4)], "endpoint string, assumed double")
    return rounded(ST.planned_sizes(values, margins, assumed, floor=50, cap=2000), 6)


@query(
    "e11_endpoint_analysis",
    _STUDY
    + f""",
    dof AS (SELECT CAST(n - 1 AS BIGINT) AS nu FROM z UNION SELECT CAST(n - 2 * floor(0.2 * n) - 1 AS BIGINT) FROM z),
    {t_quantiles("crit", "dof", 0.95)},
    {t_quantiles("slope_t", "(SELECT n - 2 AS nu FROM z)", 0.975)},
    {solved("top", "(SELECT DISTINCT n, total AS k FROM z WHERE test = 'binomial_ceiling')", "n, k", f"1 - {binomial_upto('k', 'n', 'mid')}", "0.95", "0", "1")},
    rk AS (SELECT x, row_number() OVER (ORDER BY x) AS r, COUNT(*) OVER () AS n, CAST(floor(0.2 * COUNT(*) OVER ()) AS BIGINT) AS k FROM v WHERE endpoint = 'ratio'),
    wi AS (SELECT *, MIN(x) FILTER (r > k) OVER () AS lo, MAX(x) FILTER (r <= n - k) OVER () AS hi FROM rk),
    tr AS (SELECT 'ratio' AS endpoint, CAST(MAX(n) - 2 * MAX(k) - 1 AS BIGINT) AS nu, AVG(x) FILTER (r > k AND r <= n - k) AS est, STDDEV_SAMP(GREATEST(LEAST(x, hi), lo)) / ((1 - 2 * MAX(k) / MAX(n)) * sqrt(MAX(n))) AS se FROM wi),
    rob AS (SELECT endpoint, exp(est) AS robust_estimate, exp(est - x * se) AS robust_low, exp(est + x * se) AS robust_high FROM tr JOIN crit USING (nu)),
    y AS (SELECT z.*, CAST(n - 1 AS BIGINT) AS nu, mean - crit.x * se AS lo, mean + crit.x * se AS hi, CASE WHEN scale = 'log_ratio' THEN 'r' WHEN test = 'non_inferiority' THEN 'n' WHEN test = 'binomial_ceiling' THEN 'c' ELSE 'e' END AS how,
                 CASE WHEN scale = 'fisher_z' THEN atanh(margin) ELSE margin END AS bound, crit.x * asd / sqrt(n) AS half, slope_t.x * sqrt((lyy - lxy * lxy / lxx) / (n - 2) / lxx) AS lh, slope_t.x * sqrt((syy - sxy * sxy / sxx) / (n - 2) / sxx) AS sh
          FROM z JOIN crit ON crit.nu = n - 1 JOIN slope_t ON slope_t.nu = n - 2),
    t AS (SELECT *, CASE WHEN se > 0 THEN (mean + margin) / se END AS t_low, CASE WHEN se > 0 THEN (margin - mean) / se END AS t_high, CASE WHEN se > 0 THEN (mean - bound) / se END AS t_one FROM y)
    SELECT endpoint, tier, test, scale, margin, t.n, differing, ROUND(ma, 6) AS mean_a, ROUND(mb, 6) AS mean_b, CASE WHEN how = 'r' THEN ROUND(ga, 6) END AS geomean_a, CASE WHEN how = 'r' THEN ROUND(gb, 6) END AS geomean_b,
           CASE WHEN how = 'r' THEN ROUND(ls, 6) END AS log_slope, CASE WHEN how = 'r' THEN ROUND(s, 6) END AS abs_slope, CASE WHEN how = 'r' THEN ROUND(ad, 6) END AS absolute_mean,
           ROUND(CASE how WHEN 'r' THEN exp(mean) WHEN 'n' THEN CASE WHEN scale = 'fisher_z' THEN tanh(mean) ELSE mean END WHEN 'c' THEN total / t.n END, 6) AS estimate,
           ROUND(CASE how WHEN 'r' THEN exp(lo) WHEN 'n' THEN CASE WHEN scale = 'fisher_z' THEN tanh(lo) ELSE lo END END, 6) AS ci_low, ROUND(CASE how WHEN 'r' THEN exp(hi) END, 6) AS ci_high,
           ROUND(CASE how WHEN 'r' THEN GREATEST({t_above("t_low", "nu")}, {t_above("t_high", "nu")}) WHEN 'n' THEN {t_above("t_one", "nu")} WHEN 'c' THEN {binomial_upto("total", "t.n", "margin")} END, 6) AS p_value,
           CASE WHEN how = 'r' THEN ROUND(ls - lh, 6) END AS log_slope_low, CASE WHEN how = 'r' THEN ROUND(ls + lh, 6) END AS log_slope_high, CASE WHEN how = 'r' THEN ROUND(s - sh, 6) END AS abs_slope_low, CASE WHEN how = 'r' THEN ROUND(s + sh, 6) END AS abs_slope_high,
           CASE WHEN how = 'r' THEN ROUND(ad - half, 6) END AS absolute_low, CASE WHEN how = 'r' THEN ROUND(ad + half, 6) END AS absolute_high,
           ROUND(robust_estimate, 6) AS robust_estimate, ROUND(robust_low, 6) AS robust_low, ROUND(robust_high, 6) AS robust_high, CASE WHEN how = 'c' THEN ROUND(CASE WHEN total = t.n THEN 1.0 ELSE top.x END, 6) END AS upper_bound,
           CASE how WHEN 'e' THEN CASE WHEN differing = 0 THEN 'identical in every session' ELSE 'differs between the arms: a defect to investigate' END WHEN 'r' THEN CASE WHEN lo > -margin AND hi < margin THEN 'equivalent' ELSE 'equivalence not established' END
                    WHEN 'n' THEN CASE WHEN lo > bound THEN 'non-inferior' ELSE 'non-inferiority not established' END ELSE CASE WHEN {binomial_upto("total", "t.n", "margin")} <= 0.05 THEN 'below the ceiling' ELSE 'ceiling not established' END END AS verdict,
           CASE WHEN how = 'r' THEN CASE WHEN lo > -margin AND hi < margin THEN 'none' WHEN lo > margin THEN 'arm a higher' WHEN hi < -margin THEN 'arm b higher' ELSE 'unresolved' END END AS departure,
           CASE WHEN how = 'r' THEN NOT ((ls - lh > 0 OR ls + lh < 0) AND NOT (s - sh > 0 OR s + sh < 0)) END AS proportional
    FROM t LEFT JOIN rob USING (endpoint) LEFT JOIN top ON how = 'c' AND top.n = t.n AND top.k = total""",
)
def endpoint_analysis(t):
    """Every declared endpoint by the test of its margin row, all moments in one aggregation; the users with both arms are the sessions."""
    values, margins = _sessions(t)
    return rounded(ST.analyse_endpoints(values, margins, expected_n=values.select("session").distinct().count()), 6)


@query(
    "e12_session_values",
    _ARMS
    + """,
    r AS (SELECT cluster, a / (a + b) AS r, a FROM p)
    SELECT cluster, COUNT(*) AS n_runs, ROUND(tanh(AVG(atanh(LEAST(GREATEST(r, -(1 - 1e-7)), 1 - 1e-7)))), 8) AS fisher_value, ROUND(AVG(ln(a + 1)), 8) AS log_value FROM r GROUP BY cluster""",
)
def session_values(t):
    r = _arms(t).withColumn("r", F.col("a") / (F.col("a") + F.col("b")))
    fisher = A.session_values(r, ["cluster"], "r", "fisher").withColumnRenamed("session_value", "fisher_value")
    log = A.session_values(r, ["cluster"], "a", "log", 1.0).select("cluster", F.col("session_value").alias("log_value"))
    return rounded(fisher.join(log, "cluster"), 8)


@query(
    "e13_agreement_description",
    _ARMS
    + """,
    m AS (SELECT endpoint, COUNT(*) AS n, VAR_SAMP(a + b) / 2 AS r, VAR_SAMP(a - b) / 2 AS e, COUNT(*) * AVG(a - b) * AVG(a - b) / 2 AS c FROM p GROUP BY endpoint)
    SELECT p.endpoint, COUNT(*) AS n, ROUND(AVG(a - b), 7) AS bias, ROUND(STDDEV_SAMP(a - b), 7) AS sd, ROUND(AVG(a - b) - 1.96 * STDDEV_SAMP(a - b), 7) AS loa_low, ROUND(AVG(a - b) + 1.96 * STDDEV_SAMP(a - b), 7) AS loa_high,
           ROUND(MAX((r - e) / (r + e + 2 * (c - e) / m.n)), 7) AS icc, """
    + ", ".join(f"ROUND(QUANTILE_CONT(a - b, 0.{p}), 7) AS p{p}" for p in ("05", "25", "50", "75", "95")).replace("0.50)", "0.5)")
    + " FROM p JOIN m ON m.endpoint = p.endpoint GROUP BY p.endpoint",
)
def agreement_description(t):
    return rounded(A.agreement_description(_arms(t), ["endpoint"], "a", "b"), 7)


@query(
    "e14_common_scale_means",
    """
    WITH c AS (SELECT l_orderkey AS run, l_linenumber AS frame, AVG(l_quantity) AS dv, AVG(l_extendedprice) AS gs FROM lineitem GROUP BY ALL), g AS (SELECT run, AVG(gs) AS m FROM c GROUP BY run)
    SELECT run, ROUND(AVG(dv * 1000 / m) FILTER (dv * 1000 / m > 0.5), 8) AS dvars_common FROM c JOIN g USING (run) GROUP BY run""",
)
def common_scale_means(t):
    from tidemark.operators.signal import dvars_common_scale

    c = t.lineitem.groupBy(F.col("l_orderkey").alias("run"), F.col("l_linenumber").alias("frame")).agg(
        F.avg("l_quantity").alias("dvars"), F.avg("l_extendedprice").alias("global_signal")
    )
    scaled = dvars_common_scale(c, ["run"])
    v = F.col("dvars_mean1000")
    return rounded(scaled.groupBy("run").agg(F.avg(F.when(v > 0.5, v)).alias("dvars_common")), 8)


@query(
    "e15_calibration_mismatches",
    """
    WITH r AS (SELECT l_orderkey, SUM(l_extendedprice) AS price, SUM(l_quantity) AS qty FROM lineitem GROUP BY 1), c AS (SELECT l_orderkey, CASE WHEN l_orderkey % 7 = 0 THEN ROUND(price + 1, 1) ELSE ROUND(price, 1) END AS price, CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE qty END AS qty FROM r)
    SELECT l_orderkey, 'price' AS "column" FROM r JOIN c USING (l_orderkey) WHERE l_orderkey % 7 = 0 UNION ALL SELECT l_orderkey, 'qty' FROM r WHERE l_orderkey % 11 = 0""",
)
def calibration_mismatches(t):
    r = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("price"), F.sum("l_quantity").alias("qty"))
    k = F.col("l_orderkey")
    recorded = r.select(
        "l_orderkey", F.when(k % 7 == 0, F.round(F.col("price") + 1, 1)).otherwise(F.round("price", 1)).alias("price"),
        F.when(k % 11 != 0, F.col("qty")).alias("qty"),
    )
    return A.calibration_mismatches(r, recorded, ["l_orderkey"], {"price": 1, "qty": 1}).select("l_orderkey", "column")


@query(
    "e16_canonical_columns",
    "SELECT c_custkey AS unit, c_acctbal AS balance, c_nationkey AS nation FROM customer",
)
def canonical_columns(t):
    df = t.customer.withColumnRenamed("c_custkey", "unit")
    return A.canonical_columns(df, {"c_acctbal": "balance", "c_nationkey": "nation"}, ["unit"])[0]


@query(
    "e17_within_session_spread",
    _ARMS
    + """,
    c AS (SELECT endpoint, cluster, COUNT(*) AS m, AVG(a) AS mean, VAR_POP(a) * COUNT(*) AS ss FROM p GROUP BY ALL),
    s AS (SELECT endpoint, COUNT(*) FILTER (m >= 2) AS k, SUM(m) FILTER (m >= 2) AS n, SUM(ss) FILTER (m >= 2) AS ss, STDDEV_SAMP(mean) AS sdm FROM c GROUP BY endpoint)
    SELECT endpoint, k AS n_sessions, ROUND(sqrt(ss / (n - k)), 7) AS sd_within, ROUND(sqrt(ss / (n - k)) * sqrt(2), 7) AS sd_pair_difference, ROUND(sdm, 7) AS sd_session_means FROM s""",
)
def within_session_spread(t):
    return rounded(A.within_session_spread(_arms(t), ["endpoint"], ["cluster"], "a"), 7)


@query(
    "e18_merge_measurements",
    """
    WITH m AS (SELECT o_custkey, MIN(o_orderstatus) AS tag, COUNT(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
    SELECT c_custkey AS o_custkey, tag, n, CASE WHEN n IS NULL THEN 'missing' WHEN tag <> 'F' THEN 'stale' ELSE 'ok' END AS state FROM customer LEFT JOIN m ON c_custkey = o_custkey""",
)
def merge_measurements(t):
    measured = t.orders.filter(F.col("o_orderpriority") == "1-URGENT").groupBy("o_custkey").agg(
        F.min("o_orderstatus").alias("tag"), F.count(F.lit(1)).alias("n")
    )
    draw = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    return A.merge_measurements(draw, measured, ["o_custkey"], "tag", "F")


@query(
    "e19_run_and_session_gate",
    """
    WITH r AS (SELECT l_orderkey, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS q, l_tax FROM lineitem), g AS (SELECT l_orderkey, COUNT(*) AS n_runs, COUNT(*) FILTER (NOT (COALESCE(q >= 5, FALSE) AND l_tax >= 0.01)) AS n_failed FROM r GROUP BY 1)
    SELECT o_orderkey AS l_orderkey, COALESCE(n_runs, 0) AS n_runs, COALESCE(n_failed, 0) AS n_failed, COALESCE(n_failed = 0, FALSE) AS passed FROM orders LEFT JOIN g ON l_orderkey = o_orderkey""",
)
def run_and_session_gate(t):
    runs = t.lineitem.select("l_orderkey", F.when(F.col("l_linenumber") != 7, F.col("l_quantity")).alias("q"), "l_tax")
    sessions = t.orders.select(F.col("o_orderkey").alias("l_orderkey"))
    return A.session_gate(sessions, A.run_gate(runs, {"q": 5.0, "l_tax": 0.01}), ["l_orderkey"])


@query(
    "e20_descriptive_measures",
    _ARMS
    + """ SELECT cluster, COUNT(*) AS n_runs, ROUND(tanh(AVG(atanh(LEAST(GREATEST(a / (a + b), -(1 - 1e-7)), 1 - 1e-7)))), 8) AS session_value,
                 CASE WHEN COUNT(CASE WHEN b < 100 THEN b END) = COUNT(*) THEN ROUND(SUM(CASE WHEN b < 100 THEN b END), 6) END AS total_b FROM p GROUP BY cluster""",
)
def descriptive_measures(t):
    from tidemark.functions.columns import strict_sum

    r = _arms(t).withColumn("r", F.col("a") / (F.col("a") + F.col("b"))).withColumn("_b", F.when(F.col("b") < 100, F.col("b")))
    means = A.session_values(r, ["cluster"], "r", "fisher")
    totals = r.groupBy("cluster").agg(F.round(strict_sum("_b"), 6).alias("total_b"))
    return rounded(means.join(totals, "cluster"), 8)


_METRICS = """,
    l AS (SELECT metric, CASE metric WHEN 'value' THEN a WHEN 'log_value' THEN ln(a + 1) ELSE floor(a) END AS x, CASE metric WHEN 'value' THEN b WHEN 'log_value' THEN ln(b + 1) ELSE floor(b) END AS y FROM p, (VALUES ('value'), ('log_value'), ('whole_value')) AS k(metric)),
    m AS (SELECT metric, COUNT(*) AS n, AVG(x - y) AS estimate, STDDEV_SAMP(x - y) AS sd, STDDEV_SAMP(x - y) / sqrt(COUNT(*)) AS se, VAR_SAMP(x + y) / 2 AS r, VAR_SAMP(x - y) / 2 AS e, COUNT(*) * AVG(x - y) * AVG(x - y) / 2 AS c, AVG(CASE WHEN x = y THEN 1.0 ELSE 0 END) AS same, """ + ", ".join(
    f"QUANTILE_CONT(x - y, {q}) AS p{name}" for name, q in (("05", 0.05), ("25", 0.25), ("50", 0.5), ("75", 0.75), ("95", 0.95))
) + " FROM l GROUP BY metric)"


@query(
    "e21_metric_table",
    _RECURSIVE
    + _METRICS
    + f""",{_decided("m", "n - 1", "5.0")}
    SELECT metric, n, ROUND(estimate, 6) AS bias, ROUND(sd, 6) AS sd, ROUND(estimate - 1.96 * sd, 6) AS loa_low, ROUND(estimate + 1.96 * sd, 6) AS loa_high, ROUND((r - e) / (r + e + 2 * (c - e) / n), 6) AS icc,
           ROUND(p05, 6) AS p05, ROUND(p25, 6) AS p25, ROUND(p50, 6) AS p50, ROUND(p75, 6) AS p75, ROUND(p95, 6) AS p95, ROUND(same, 6) AS share_equal, ROUND(ci_low, 6) AS ci_low, ROUND(ci_high, 6) AS ci_high, verdict FROM decided""",
)
def metric_table(t):
    """ICC, Bland–Altman and TOST of several metrics at once: the metrics are unpivoted to endpoints first."""
    arms = _arms(t)
    cells = F.array(
        F.struct(F.lit("value").alias("metric"), F.col("a").alias("x"), F.col("b").alias("y")),
        F.struct(F.lit("log_value").alias("metric"), F.log(F.col("a") + 1).alias("x"), F.log(F.col("b") + 1).alias("y")),
        F.struct(F.lit("whole_value").alias("metric"), F.floor("a").cast("double").alias("x"), F.floor("b").cast("double").alias("y")),
    )
    long = arms.select("cluster", "d", F.inline(cells))
    table = A.agreement_description(long, ["metric"], "x", "y")
    share = long.groupBy("metric").agg(F.avg((F.col("x") == F.col("y")).cast("double")).alias("share_equal"))
    verdicts = A.tost(long, ["metric"], F.col("x") - F.col("y"), 5.0).select("metric", "ci_low", "ci_high", "verdict")
    return rounded(table.join(share, "metric").join(verdicts, "metric"), 6)
