"""The monitoring queries as plain SQL over the same tables, for checks with a second engine."""

from __future__ import annotations

from stayscope.functions import fixed
from stayscope.operators import monitor
from stayscope.plans.monitoring import PROMISED_PR_AUC
from stayscope.plans.oracles import ACCOUNTS, SMOOTH, TIED, _curve, i, r

P_ORDER = "round(1 / (1 + exp(1.5 - o_totalprice / 200000.0)), 6)"


def _stability() -> str:
    ranks = ", ".join(f"{k / 10}" for k in range(1, 10))
    parts, edges = [], []
    for c in fixed.NUMERIC:
        edges.append(f'(SELECT list_distinct(quantile_cont(CAST("{c}" AS DOUBLE), [{ranks}])) FROM acc WHERE "PaperlessBilling" = \'No\') AS "e_{c}"')
        place = f"CASE WHEN \"{c}\" IS NULL THEN 'missing' ELSE 'bin ' || len(list_filter(\"e_{c}\", lambda e: e <= CAST(\"{c}\" AS DOUBLE))) END"
        parts.append(f"SELECT \"PaperlessBilling\" AS side, '{c}' AS feature, {place} AS bin FROM acc, edges")
    for c in ("Contract", "InternetService", "PaymentMethod"):
        parts.append(f"SELECT \"PaperlessBilling\", '{c}', coalesce('level ' || \"{c}\", 'missing') FROM acc")
    status = "'stable'"
    for name, limit in monitor.PSI_LIMITS.items():
        status = f"CASE WHEN psi > {limit} THEN '{name}' ELSE {status} END"
    floor = monitor.FLOOR
    return f"""WITH {ACCOUNTS}, edges AS (SELECT {", ".join(edges)}),
    placed AS ({" UNION ALL ".join(parts)}),
    counted AS (SELECT side, feature, bin, count(*) AS n FROM placed GROUP BY 1, 2, 3),
    shared AS (SELECT *, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY side, feature) AS s FROM counted),
    met AS (SELECT coalesce(a.feature, b.feature) AS feature, greatest(coalesce(a.s, 0), {floor}) AS e, greatest(coalesce(b.s, 0), {floor}) AS x
      FROM (SELECT * FROM shared WHERE side = 'No') a FULL JOIN (SELECT * FROM shared WHERE side = 'Yes') b ON a.feature = b.feature AND a.bin = b.bin),
    found AS (SELECT feature, sum((x - e) * ln(x / e)) AS psi, count(*) AS n_bins FROM met GROUP BY 1)
    SELECT feature, {r("psi")} AS psi, n_bins, {status} AS status FROM found"""


def _daily() -> str:
    deciles = ", ".join(f"min(p) FILTER (cn * 10 >= tot * {k}) AS d{k}" for k in range(1, 10))
    shown = ", ".join(r(f"d{k}") + f" AS d{k}" for k in range(1, 10))
    return f"""WITH s AS (SELECT CAST(o_orderdate AS DATE) AS day, {P_ORDER} AS p FROM orders),
    c AS (SELECT day, p, count(*) AS n FROM s GROUP BY 1, 2),
    t AS (SELECT *, sum(n) OVER (PARTITION BY day ORDER BY p) AS cn, sum(n) OVER (PARTITION BY day) AS tot FROM c),
    d AS (SELECT day, sum(n) AS n, sum(CAST(round(p * 1000000) AS BIGINT) * n) AS m, {deciles} FROM t GROUP BY 1),
    w AS (SELECT *, CAST(m AS DOUBLE) / (n * 1000000) AS mean,
      CAST(sum(m) OVER k AS DOUBLE) / (sum(n) OVER k * 1000000) AS week_mean FROM d
      WINDOW k AS (ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAY PRECEDING))
    SELECT CAST(day AS VARCHAR) AS day, {i("n")} AS n, {r("mean")} AS mean, {shown}, {r("week_mean")} AS week_mean,
      coalesce(abs(mean - week_mean) > {monitor.DAILY_SHIFT_MAX}, false) AS shifted FROM w"""


def _retrospective() -> str:
    ap = "coalesce(sum(tp / nullif(pos, 0) * ct / cn), 0)"
    brier = "sum(tp * (1 - p) * (1 - p) + (n - tp) * p * p) / sum(n)"
    return f"""WITH pred AS (SELECT o_custkey AS k, o_orderdate AS t, max({P_ORDER}) AS p FROM orders GROUP BY 1, 2),
    out AS (SELECT o_custkey AS k, l_shipdate AS t, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    met AS (SELECT CAST(date_trunc('month', out.t) AS DATE) AS month, y, p
      FROM out ASOF LEFT JOIN pred ON out.k = pred.k AND out.t > pred.t),
    sizes AS (SELECT month, count(*) AS n_outcomes, count(p) AS n_judged FROM met GROUP BY 1),
    s AS (SELECT month, y, p FROM met WHERE p IS NOT NULL), {_curve("month")},
    judged AS (SELECT month, {ap} AS pr_auc, {brier} AS brier FROM c GROUP BY 1)
    SELECT CAST(month AS VARCHAR) AS month, n_outcomes, n_judged, {r("pr_auc")} AS pr_auc, {r("brier")} AS brier,
      {r(f"1 - pr_auc / {PROMISED_PR_AUC}")} AS pr_auc_drop,
      coalesce(1 - pr_auc / {PROMISED_PR_AUC} > {monitor.RANKING_DROP_MAX}, false) AS ranking_alert,
      coalesce(brier > {monitor.BRIER_MAX}, false) AS calibration_alert
    FROM sizes LEFT JOIN judged USING (month)"""


def _isotonic() -> str:
    """Greatest of the least means over runs around each probability."""
    return f"""WITH {TIED},
    h AS (SELECT round(p, 6) AS p, sum(y) AS tp, count(*) AS n FROM s GROUP BY 1),
    c AS (SELECT *, row_number() OVER (ORDER BY p) AS k, sum(tp) OVER (ORDER BY p) AS ct, sum(n) OVER (ORDER BY p) AS cn FROM h),
    least AS (SELECT m.k, a.k AS first, min((z.ct - a.ct + a.tp) / CAST(z.cn - a.cn + a.n AS DOUBLE)) AS v
      FROM c m JOIN c a ON a.k <= m.k JOIN c z ON z.k >= m.k GROUP BY 1, 2),
    fit AS (SELECT k, max(v) AS v FROM least GROUP BY 1)
    SELECT {r("min(p)")} AS low, {r("max(p)")} AS high, {i("sum(tp)")} AS tp, {i("sum(n)")} AS n, {r("sum(tp) / CAST(sum(n) AS DOUBLE)")} AS rate
    FROM c JOIN fit USING (k) GROUP BY round(v, 12)"""


def _digest() -> str:
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    parts = " || ".join(f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)
    lanes = ", ".join(f"coalesce(sum(CAST('0x' || substr(h, {4 * k + 1}, 4) AS BIGINT)), 0) AS l{k}" for k in range(8))
    carried, carry = [], "0"
    for k in range(7, -1, -1):
        carried.insert(0, f"lpad(lower(to_hex(CAST((l{k} + {carry}) % 65536 AS BIGINT))), 4, '0')")
        carry = f"((l{k} + {carry}) // 65536)"
    size = " + ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)), 0)" for c in columns)
    return f"""WITH d AS (SELECT sha256({parts}) AS h, {size} AS size, lang, n_chars FROM documents),
    t AS (SELECT count(*) AS n_rows, avg(CASE WHEN lang = 'en' THEN 1 ELSE 0 END) AS rate, count(*) FILTER (n_chars IS NULL) AS missing,
      coalesce(sum(size), 0) AS n_bytes, {lanes} FROM d)
    SELECT n_rows, {i("5")} AS n_cols, {r("rate", 4)} AS target_pos_rate, missing AS n_missing_total, {i("n_bytes")} AS n_bytes,
      {" || ".join(carried)} AS digest FROM t"""


def _top() -> str:
    size = "greatest(round_even(tot * 0.1, 0), 1)"
    return f"max({size})", f"sum(tp * greatest(0, least({size} - (cn - n), n)) / n)"


def _outliers() -> str:
    parts = [
        f"""SELECT '{c}' AS "column", q[1] - (q[2] - q[1]) * 1.5 AS low, q[2] + (q[2] - q[1]) * 1.5 AS high, x
        FROM (SELECT quantile_cont(CAST("{c}" AS DOUBLE), [0.25, 0.75]) AS q FROM acc), (SELECT CAST("{c}" AS DOUBLE) AS x FROM acc)"""
        for c in ("MonthlyCharges", "TotalCharges")
    ]
    return f"""WITH {ACCOUNTS}, b AS ({" UNION ALL ".join(parts)})
    SELECT "column", {r("low", 4)} AS low, {r("high", 4)} AS high, count(*) FILTER (x < low OR x > high) AS n_outside FROM b GROUP BY "column", low, high"""


def _build() -> dict[str, str]:
    size, hits = _top()
    kept = f"({hits} * {monitor.UPLIFT})"
    value, spent = f"({kept} * {monitor.MONTHLY_REVENUE * monitor.MONTHS_KEPT})", f"({size} * {monitor.CONTACT_COST})"
    share = f"min(cn / CAST(tot AS DOUBLE)) FILTER (pos > 0 AND ct >= pos * {monitor.CAPTURE})"
    daily = _daily()
    return {
        "feature_stability": _stability(),
        "daily_scores": daily,
        "streamed_daily_scores": daily,
        "retrospective_quality": _retrospective(),
        "isotonic_blocks": _isotonic(),
        "capture_base": f"""WITH {SMOOTH}, {_curve("region")} SELECT region, {r(share)} AS base_share,
          coalesce({share} <= {monitor.CAPTURE_BASE_MAX}, false) AS within_limit FROM c GROUP BY 1""",
        "campaign_value": f"""WITH {SMOOTH}, {_curve("region")} SELECT region, {r(size, 4)} AS n_contacted, {r(hits, 4)} AS n_captured,
          {r(kept, 4)} AS n_kept, {r(value, 4)} AS revenue_kept, {r(spent, 4)} AS campaign_cost, {r(f"{value} - {spent}", 4)} AS net_saving,
          {r(f"({value} - {spent}) / {spent}", 4)} AS roi FROM c GROUP BY 1""",
        "outlier_violations": _outliers(),
        "missing_flags": f"""WITH {ACCOUNTS} SELECT "Contract", {i('CASE WHEN "TotalCharges" IS NULL THEN 1 ELSE 0 END')} AS "was_TotalCharges_missing",
          {i('CASE WHEN "Partner" IS NULL THEN 1 ELSE 0 END')} AS "was_Partner_missing", count(*) AS n FROM acc GROUP BY 1, 2, 3""",
        "data_digest": _digest(),
    }


ORACLES = _build()
