"""The registered queries again as plain SQL over the same tables.

Used only to check results with a second engine.
"""

from __future__ import annotations

from stayscope.functions import fixed
from stayscope.plans.registered import LINEAR_SCORE, SNAPSHOT_FEATURES, THRESHOLD

CUT = "TIMESTAMP '2000-09-01'"

FACTS = f"""facts AS (
  SELECT o_custkey,
         count(*) FILTER (o_orderdate < {CUT}) AS n_orders,
         CAST(coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT))
              FILTER (o_orderdate < {CUT}), 0) AS BIGINT) AS cents,
         min(o_orderdate) FILTER (o_orderdate < {CUT}) AS first_order,
         count(*) FILTER (NOT o_orderdate < {CUT}) AS n_after,
         count(*) FILTER (o_orderdate < {CUT} AND o_orderpriority = '1-URGENT') AS n_urgent,
         count(*) FILTER (o_orderdate < {CUT} AND o_orderpriority = '2-HIGH') AS n_high,
         count(*) FILTER (o_orderdate < {CUT} AND o_orderpriority = '3-MEDIUM') AS n_medium,
         count(*) FILTER (o_orderdate < {CUT} AND o_orderpriority = '4-NOT SPECIFIED')
           AS n_unspecified,
         count(*) FILTER (o_orderdate < {CUT} AND o_orderpriority = '5-LOW') AS n_low,
         count(*) FILTER (o_orderdate < {CUT} AND o_orderstatus = 'O') AS n_open
  FROM orders GROUP BY o_custkey)"""

SNAPSHOT = f"""{FACTS}, snap AS (
  SELECT c_custkey, c_mktsegment, n_name AS nation, r_name AS region, c_acctbal,
         date_diff('day', CAST(first_order AS DATE), DATE '2000-09-01') AS tenure_days,
         n_orders, CAST(cents AS DOUBLE) / 100.0 AS total_spend,
         CAST(cents // n_orders AS DOUBLE) / 100.0 AS avg_spend,
         n_urgent > 0 AS has_urgent, n_urgent,
         CASE WHEN n_after = 0 THEN 1 ELSE 0 END AS churned
  FROM customer JOIN facts ON c_custkey = o_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  WHERE n_orders > 0)"""


def _addon(column: str, least: int) -> str:
    return (
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'No internet service' "
        f"WHEN coalesce({column}, 0) >= {least} THEN 'Yes' ELSE 'No' END"
    )


_LETTERS = " || ".join(
    f"chr(CAST(65 + (c_custkey // {10_000 * 26 ** i}) % 26 AS INTEGER))" for i in range(4, -1, -1)
)

RAW = f"""{FACTS}, base AS (
  SELECT customer.*, facts.*, coalesce(cents, 0) // 1000 AS paid,
         CAST(least(72, coalesce(date_diff('day', CAST(first_order AS DATE), DATE '2000-09-01')
              // 30, 0)) AS INTEGER) AS months
  FROM customer LEFT JOIN facts ON c_custkey = o_custkey),
raw AS (
  SELECT lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || '-' || {_LETTERS} AS "customerID",
    CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CASE WHEN c_custkey % 20 < 3 THEN '1' ELSE '0' END AS "SeniorCitizen",
    CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS "Partner",
    CASE WHEN c_nationkey % 3 = 0 THEN 'Yes' ELSE 'No' END AS "Dependents",
    CAST(months AS VARCHAR) AS tenure,
    CASE WHEN c_custkey % 10 = 0 THEN 'No' ELSE 'Yes' END AS "PhoneService",
    CASE WHEN c_custkey % 10 = 0 THEN 'No phone service'
         WHEN coalesce(n_orders, 0) >= 10 THEN 'Yes' ELSE 'No' END AS "MultipleLines",
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'No'
         WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'DSL'
         ELSE 'Fiber optic' END AS "InternetService",
    {_addon("n_urgent", 2)} AS "OnlineSecurity",
    {_addon("n_high", 2)} AS "OnlineBackup",
    {_addon("n_medium", 2)} AS "DeviceProtection",
    {_addon("n_low", 2)} AS "TechSupport",
    {_addon("n_unspecified", 2)} AS "StreamingTV",
    {_addon("n_open", 3)} AS "StreamingMovies",
    CASE WHEN coalesce(n_orders, 0) <= 8 THEN 'Month-to-month'
         WHEN coalesce(n_orders, 0) <= 11 THEN 'One year' ELSE 'Two year' END AS "Contract",
    CASE WHEN c_acctbal >= 4000 THEN 'Yes' ELSE 'No' END AS "PaperlessBilling",
    CASE c_nationkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
         WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END
      AS "PaymentMethod",
    CAST(CAST((paid // greatest(months, 1) + (c_custkey % 7) * 100) / 100.0 AS DECIMAL(18, 2))
      AS VARCHAR) AS "MonthlyCharges",
    CASE WHEN months = 0 THEN ' '
         ELSE CAST(CAST(paid / 100.0 AS DECIMAL(18, 2)) AS VARCHAR) END AS "TotalCharges",
    CASE WHEN coalesce(n_after, 0) = 0 THEN 'Yes' ELSE 'No' END AS "Churn"
  FROM base)"""

_NUMBERS = {
    "SeniorCitizen": "TINYINT", "tenure": "SMALLINT", "MonthlyCharges": "FLOAT",
    "TotalCharges": "FLOAT",
}
_TYPED = ", ".join(
    f"CAST(nullif(trim(\"{c}\"), '') AS {_NUMBERS[c]}) AS \"{c}\"" if c in _NUMBERS else f'"{c}"'
    for c in fixed.RAW_COLUMNS
)
ACCOUNTS = f"{RAW}, acc AS (SELECT {_TYPED} FROM raw)"

_COUNTED = " + ".join(f"CASE WHEN \"{c}\" = 'Yes' THEN 1 ELSE 0 END" for c in fixed.SERVICES)


def _derive(source: str, out: str) -> str:
    """CTE ``out``: the derived columns added to ``source``."""
    return f"""{out}0 AS (
  SELECT *, CASE WHEN tenure < -1 THEN NULL WHEN tenure <= 12 THEN '0-12m'
              WHEN tenure <= 24 THEN '13-24m' WHEN tenure <= 48 THEN '25-48m'
              WHEN tenure <= 72 THEN '49-72m' END AS tenure_bucket,
    {_COUNTED} AS services_count,
    "InternetService" <> 'No' AS has_internet, "PhoneService" = 'Yes' AS has_phone,
    "PaymentMethod" IN ('Bank transfer (automatic)', 'Credit card (automatic)') AS auto_payment,
    CAST(coalesce(CAST("TotalCharges" AS DOUBLE), 0.0) / greatest(CAST(tenure AS DOUBLE), 1.0)
      AS FLOAT) AS avg_monthly_spend
  FROM {source}),
{out} AS (SELECT *, CAST(CAST("MonthlyCharges" AS DOUBLE) - CAST(avg_monthly_spend AS DOUBLE)
          AS FLOAT) AS monthly_spend_gap FROM {out}0)"""


DERIVED = f"{ACCOUNTS}, {_derive('acc', 'der')}"

SPLIT = f"""{DERIVED}, cls AS (
  SELECT "Churn" AS c, count(*) AS n_c FROM der GROUP BY 1),
sizes AS (
  SELECT c, n_c, sum(n_c) OVER () AS n,
         sum(n_c) OVER () - ceil(sum(n_c) OVER () * 0.15) AS n_kept FROM cls),
kept0 AS (
  SELECT *, CAST(n_c AS DOUBLE) / n * n_kept AS exact,
         floor(CAST(n_c AS DOUBLE) / n * n_kept) AS low FROM sizes),
kept AS (
  SELECT *, low + CASE WHEN row_number() OVER (ORDER BY low - exact, c)
                       <= n_kept - sum(low) OVER () THEN 1 ELSE 0 END AS keep FROM kept0),
train0 AS (
  SELECT *, n_kept - ceil(n_kept * (0.15 / (1.0 - 0.15))) AS n_train FROM kept),
train1 AS (
  SELECT *, CAST(keep AS DOUBLE) / n_kept * n_train AS exact_t,
         floor(CAST(keep AS DOUBLE) / n_kept * n_train) AS low_t FROM train0),
cuts AS (
  SELECT c, n_c - keep AS test_end,
         n_c - (low_t + CASE WHEN row_number() OVER (ORDER BY low_t - exact_t, c)
                        <= n_train - sum(low_t) OVER () THEN 1 ELSE 0 END) AS val_end
  FROM train1),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY "Churn"
              ORDER BY md5('42:' || "customerID"), "customerID") AS pos FROM der),
spl AS (
  SELECT placed.*, CASE WHEN pos <= test_end THEN 'test' WHEN pos <= val_end THEN 'val'
                   ELSE 'train' END AS split
  FROM placed JOIN cuts ON "Churn" = c)"""


def _encoded(derived: bool) -> tuple[str, list[str], str]:
    """(fit columns, output names, output expressions) of the encoder."""
    numeric = [*fixed.NUMERIC, *(fixed.DERIVED_NUMERIC if derived else [])]
    ordinal = {**fixed.ORDINAL, **(fixed.DERIVED_ORDINAL if derived else {})}
    fit = ", ".join(f'median(CAST("{c}" AS DOUBLE)) AS "med_{c}"' for c in numeric)
    moments = ", ".join(
        f'avg(coalesce(CAST("{c}" AS DOUBLE), "med_{c}")) AS "avg_{c}", '
        f'stddev_pop(coalesce(CAST("{c}" AS DOUBLE), "med_{c}")) AS "dev_{c}"'
        for c in numeric
    )
    out, names = [], []
    for c in numeric:
        names.append(c)
        out.append(
            f'CAST((coalesce(CAST("{c}" AS DOUBLE), "med_{c}") - "avg_{c}")'
            f' / CASE WHEN "dev_{c}" = 0 THEN 1 ELSE "dev_{c}" END AS FLOAT)'
        )
    for c, levels in {**ordinal, **fixed.BINARY}.items():
        names.append(c)
        cases = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(levels))
        out.append(f'CAST(CASE "{c}" {cases} ELSE -1 END AS FLOAT)')
    for c in fixed.DERIVED_FLAGS if derived else []:
        names.append(c)
        out.append(f'CAST(CASE WHEN "{c}" THEN 1 ELSE 0 END AS FLOAT)')
    for c, levels in fixed.NOMINAL.items():
        for v in levels[1:]:
            names.append(f"{c}_{v}")
            out.append(f"CAST(CASE WHEN \"{c}\" = '{v}' THEN 1 ELSE 0 END AS FLOAT)")
    columns = ", ".join(f'{e} AS "{n}"' for e, n in zip(out, names, strict=True))
    ctes = (
        f"med AS (SELECT {fit} FROM spl WHERE split = 'train'), "
        f"mom AS (SELECT {moments} FROM spl, med WHERE split = 'train')"
    )
    return ctes, names, columns


def _matrix(derived: bool = True) -> str:
    ctes, _, columns = _encoded(derived)
    return (
        f'{SPLIT}, {ctes}, enc AS (SELECT "customerID" AS kid, "Churn" AS cls_label, '
        f'split AS part, {columns} FROM spl, med, mom)'
    )


def r(expression: str, digits: int = 6) -> str:
    """Rounded double without negative zero."""
    return f"round(CAST({expression} AS DOUBLE), {digits}) + 0.0"


def i(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


P_TIED = "round(1 / (1 + exp(-(1.0 - 0.25 * n_orders))), 4)"
P_SMOOTH = (
    "round(1 / (1 + exp(-(0.4 - total_spend / 2000000.0 + CAST(tenure_days AS DOUBLE) / 4000.0))), 6)"
)
TIED = (
    f"{SNAPSHOT}, s AS (SELECT c_custkey, region, c_mktsegment, has_urgent, churned AS y, "
    f"CAST({P_TIED} AS DOUBLE) AS p FROM snap)"
)
SMOOTH = (
    f"{SNAPSHOT}, s AS (SELECT c_custkey, region, churned AS y, "
    f"CAST({P_SMOOTH} AS DOUBLE) AS p FROM snap)"
)


def _curve(keys: str = "") -> str:
    """CTEs h and c: distinct scores with running and total sums."""
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    return (
        f"h AS (SELECT {k}p, sum(y) AS tp, count(*) AS n FROM s GROUP BY {k}p), "
        f"c AS (SELECT *, sum(tp) OVER ({part} ORDER BY p DESC) AS ct, "
        f"sum(n) OVER ({part} ORDER BY p DESC) AS cn, "
        f"sum(tp) OVER ({part}) AS pos, sum(n) OVER ({part}) AS tot FROM h)"
    )


def _metrics(threshold: str, keys: str = "", digits: int = 6) -> str:
    """SELECT of the metric bundle over CTE c."""
    k = f"{keys}, " if keys else ""
    group = f" GROUP BY {keys}" if keys else ""
    hit = f"CASE WHEN p >= {threshold} THEN tp ELSE 0 END"
    flag = f"CASE WHEN p >= {threshold} THEN n ELSE 0 END"
    size = "greatest(round_even(tot * 0.1, 0), 1)"
    taken = f"greatest(0, least({size} - (cn - n), n))"
    return f"""SELECT {k}
      {r("coalesce(sum(tp / nullif(pos, 0) * ct / cn), 0)", digits)} AS pr_auc,
      {r("sum((n - tp) * (ct - tp / 2.0) / nullif(CAST(pos AS DOUBLE) * (tot - pos), 0))", digits)}
        AS roc_auc,
      {r("sum(tp * (1 - p) * (1 - p) + (n - tp) * p * p) / sum(n)", digits)} AS brier,
      {r(f"coalesce(2.0 * sum({hit}) / nullif(sum({flag}) + sum(tp), 0), 0)", digits)} AS f1,
      {r(f"coalesce(sum({hit}) / nullif(sum({flag}), 0), 0)", digits)} AS precision,
      {r(f"coalesce(sum({hit}) / nullif(sum(tp), 0), 0)", digits)} AS recall,
      {r(f"(sum(n) - sum(tp) - sum({flag}) + 2 * sum({hit})) / sum(n)", digits)} AS accuracy,
      {r(f"sum({flag}) / sum(n)", digits)} AS positive_rate,
      {r("sum(tp) / sum(n)", digits)} AS base_rate,
      {r(f"coalesce(sum(tp * {taken} / n) / max({size}) / nullif(sum(tp) / sum(n), 0), 0)",
         digits)} AS lift_at_10,
      {r(threshold, digits)} AS threshold
    FROM c{group}"""


def _numeric_summary(source: str, columns: list[str], digits: int) -> str:
    parts = []
    for c in columns:
        v = f'TRY_CAST("{c}" AS DOUBLE)'
        quantiles = ", ".join(
            f"{r(f'quantile_cont({v}, {q})', digits)} AS {name}"
            for name, q in (("p05", 0.05), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95))
        )
        parts.append(
            f"SELECT '{c}' AS variable, {i(f'count({v})')} AS count, "
            f"{i(f'count(*) - count({v})')} AS missing, {r(f'avg({v})', digits)} AS mean, "
            f"{r(f'stddev_samp({v})', digits)} AS std, {r(f'min({v})', digits)} AS min, "
            f"{r(f'max({v})', digits)} AS max, {r(f'skewness({v})', digits)} AS skew, "
            f"{r(f'kurtosis({v})', digits)} AS kurtosis, {quantiles} FROM {source}"
        )
    return " UNION ALL ".join(parts)


def _categorical_summary(source: str, columns: list[str]) -> str:
    parts = []
    for c in columns:
        counts = (
            f'(SELECT CAST("{c}" AS VARCHAR) AS v, count(*) AS n FROM {source} GROUP BY 1)'
        )
        parts.append(
            f"SELECT '{c}' AS variable, {i('count(v)')} AS n_unique, "
            f"{i('coalesce(sum(n) FILTER (v IS NULL), 0)')} AS missing, "
            f"(SELECT v FROM {counts} WHERE v IS NOT NULL ORDER BY n DESC, v LIMIT 1) AS top, "
            f"{r('max(n) FILTER (v IS NOT NULL) / sum(n)')} AS top_freq FROM {counts}"
        )
    return " UNION ALL ".join(parts)


def _square(columns: list[str], cell) -> str:
    """All (i, j) cells of a correlation matrix."""
    return " UNION ALL ".join(
        f"SELECT '{a}' AS variable_a, '{b}' AS variable_b, {i(str(x))} AS i, {i(str(y))} AS j, "
        + cell(a, b)
        for x, a in enumerate(columns)
        for y, b in enumerate(columns)
    )


def _pearson(source: str, columns: list[str], lower: bool = False) -> str:
    body = _square(
        columns,
        lambda a, b: r(f'corr(CAST("{a}" AS DOUBLE), CAST("{b}" AS DOUBLE))')
        + f" AS correlation FROM {source}",
    )
    return f"SELECT * FROM ({body})" + (" WHERE i >= j" if lower else "")


def _spearman(source: str, columns: list[str]) -> str:
    def cell(a: str, b: str) -> str:
        ranks = ", ".join(
            f"rank() OVER (ORDER BY {v}) + (count(*) OVER (PARTITION BY {v}) - 1) / 2.0 AS r{v}"
            for v in ("x", "y")
        )
        return (
            f"{r('corr(rx, ry)')} AS correlation FROM (SELECT {ranks} FROM (SELECT "
            f'CAST("{a}" AS DOUBLE) AS x, CAST("{b}" AS DOUBLE) AS y FROM {source}) '
            "WHERE x IS NOT NULL AND y IS NOT NULL)"
        )

    return _square(columns, cell)


def _kendall(source: str, columns: list[str]) -> str:
    """Tau-b from sign products of all pairs of distinct value cells."""

    def cell(a: str, b: str) -> str:
        cells = (
            f'SELECT CAST("{a}" AS DOUBLE) AS x, CAST("{b}" AS DOUBLE) AS y, count(*) AS n '
            f"FROM {source} GROUP BY 1, 2"
        )
        weight = "CAST(u.n AS DOUBLE) * v.n"
        return (
            r(
                f"sum({weight} * sign(u.x - v.x) * sign(u.y - v.y)) / "
                f"(sqrt(sum({weight} * abs(sign(u.x - v.x)))) * "
                f"sqrt(sum({weight} * abs(sign(u.y - v.y)))))"
            )
            + f" AS correlation FROM ({cells}) u CROSS JOIN ({cells}) v"
        )

    return _square(columns, cell)


def _long(source: str, columns: list[str], target: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST(\"{c}\" AS VARCHAR) AS value, "
        f'CAST("{target}" AS VARCHAR) AS class FROM {source} '
        f'WHERE "{c}" IS NOT NULL AND "{target}" IS NOT NULL'
        for c in columns
    )


def _chi(source: str, columns: list[str], target: str) -> str:
    """CTEs lng, cells, chi (variable, total, n_values, n_classes, chi2)."""
    return f"""lng AS ({_long(source, columns, target)}),
    cells AS (SELECT variable, value, class, count(*) AS n FROM lng GROUP BY 1, 2, 3),
    rws AS (SELECT variable, value, sum(n) AS rn FROM cells GROUP BY 1, 2),
    cls2 AS (SELECT variable, class, sum(n) AS cn FROM cells GROUP BY 1, 2),
    tots AS (SELECT variable, sum(n) AS total FROM cells GROUP BY 1),
    grid AS (SELECT rws.variable, rws.value, cls2.class, rn, cn, total,
               CAST(rn AS DOUBLE) * cn / total AS e
             FROM rws JOIN cls2 ON rws.variable = cls2.variable
             JOIN tots ON rws.variable = tots.variable),
    chi AS (SELECT grid.variable, max(total) AS total, count(DISTINCT grid.value) AS n_values,
              count(DISTINCT grid.class) AS n_classes,
              sum((coalesce(n, 0) - e) * (coalesce(n, 0) - e) / e) AS chi2
            FROM grid LEFT JOIN cells ON grid.variable = cells.variable
             AND grid.value = cells.value AND grid.class = cells.class
            GROUP BY 1)"""


SLOT = "CAST('0x' || substr(md5(\"customerID\"), 1, 4) AS INTEGER)"
_BROKEN = {
    "gender": "CASE WHEN slot % 7 = 0 THEN 'Unknown' ELSE gender END",
    "tenure": "CASE WHEN slot % 11 = 0 THEN 99 ELSE tenure END",
    "MultipleLines": "CASE WHEN slot % 5 = 0 THEN 'Yes' ELSE \"MultipleLines\" END",
    "TechSupport": "CASE WHEN slot % 6 = 0 THEN 'No internet service' ELSE \"TechSupport\" END",
    "Partner": "CASE WHEN slot % 13 = 0 THEN NULL ELSE \"Partner\" END",
    "customerID": "CASE WHEN slot % 17 = 0 THEN 'bad' ELSE \"customerID\" END",
    "SeniorCitizen": 'CASE WHEN slot % 23 = 0 THEN 2 ELSE "SeniorCitizen" END',
    "StreamingTV": "CASE WHEN slot % 29 = 0 THEN 'Maybe' ELSE \"StreamingTV\" END",
    "MonthlyCharges": 'CASE WHEN slot % 19 = 0 THEN -"MonthlyCharges" - 1 ELSE "MonthlyCharges" END',
    "TotalCharges": 'CASE WHEN slot % 31 = 0 THEN -"TotalCharges" - 1 ELSE "TotalCharges" END',
}
_broken_columns = ", ".join(
    f'{_BROKEN[c]} AS "{c}"' if c in _BROKEN else f'"{c}"' for c in fixed.RAW_COLUMNS
)
_BREAK = (
    f"slotted AS (SELECT *, {SLOT} AS slot FROM acc), "
    f"brk AS (SELECT {_broken_columns} FROM slotted)"
)
BROKEN = f"{ACCOUNTS}, {_BREAK}"

_DOMAINS = {
    "gender": fixed.GENDERS, **{c: v for c, v in fixed.BINARY.items() if c != "gender"},
    **fixed.NOMINAL, **fixed.ORDINAL,
}


def _in(column: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f'"{column}" IN ({listed})'


_ALL_OFF = " AND ".join(f"\"{a}\" IS NOT DISTINCT FROM 'No internet service'" for a in fixed.ADDONS)
_SOME_OFF = " OR ".join(f"\"{a}\" = 'No internet service'" for a in fixed.ADDONS)


def _rules(scoring: bool) -> list[tuple[str, str, str]]:
    """(rule, column, condition of a bad row)."""
    rules = [("domain", c, f"NOT ({_in(c, v)})") for c, v in _DOMAINS.items()]
    rules.append(("domain", "SeniorCitizen", '"SeniorCitizen" NOT IN (0, 1)'))
    if not scoring:
        rules.append(("domain", "Churn", f"NOT ({_in('Churn', fixed.YES_NO)})"))
        rules.append(
            ("pattern", "customerID", "NOT regexp_matches(\"customerID\", '^\\d{4}-[A-Z]{5}$')")
        )
    rules.append(("range", "tenure", "tenure NOT BETWEEN 0 AND 72"))
    rules += [("minimum", c, f'"{c}" < 0') for c in ("MonthlyCharges", "TotalCharges")]
    left_out = ("TotalCharges", "customerID", "Churn") if scoring else ("TotalCharges",)
    rules += [("not_null", c, f'"{c}" IS NULL') for c in fixed.RAW_COLUMNS if c not in left_out]
    lines = "\"MultipleLines\" IS DISTINCT FROM 'No phone service'"
    rules.append(("phone_lines", "MultipleLines", f"\"PhoneService\" = 'No' AND {lines}"))
    rules.append(
        ("internet_addons", "InternetService", f"\"InternetService\" = 'No' AND NOT ({_ALL_OFF})")
    )
    if scoring:
        rules.append(
            ("phone_lines_reverse", "MultipleLines",
             "\"PhoneService\" = 'Yes' AND \"MultipleLines\" = 'No phone service'")
        )
        rules.append(
            ("internet_addons_reverse", "InternetService",
             f"\"InternetService\" <> 'No' AND ({_SOME_OFF})")
        )
    return rules


_GOOD = " AND ".join(f"NOT coalesce({bad}, false)" for _, _, bad in _rules(True))

_MATRIX6 = (
    f"{SNAPSHOT}, mx AS (SELECT c_custkey, churned, CAST(n_orders AS DOUBLE) AS n_orders, "
    "total_spend, CAST(tenure_days AS DOUBLE) AS tenure_days, CAST(n_urgent AS DOUBLE) AS n_urgent, "
    "CAST(CAST(has_urgent AS INTEGER) AS DOUBLE) AS has_urgent, "
    "avg_spend - 250000.0 AS centred_spend FROM snap)"
)


def _mi() -> str:
    """CTE mi (feature, score)."""
    parts = []
    for f in SNAPSHOT_FEATURES:
        if f in ("n_urgent", "has_urgent"):
            parts.append(f"SELECT '{f}' AS feature, {f} AS bin, churned AS y FROM mx")
        else:
            edges = " + ".join(
                f"CAST((SELECT quantile_cont({f}, {k / 10}) FROM mx) < {f} AS INTEGER)"
                for k in range(1, 10)
            )
            parts.append(
                f"SELECT '{f}' AS feature, CAST({edges} AS DOUBLE) AS bin, churned AS y FROM mx"
            )
    return f"""bn AS ({" UNION ALL ".join(parts)}),
    jc AS (SELECT feature, bin, y, count(*) AS n FROM bn GROUP BY 1, 2, 3),
    tc AS (SELECT *, sum(n) OVER (PARTITION BY feature, bin) AS nb,
             sum(n) OVER (PARTITION BY feature, y) AS ny,
             sum(n) OVER (PARTITION BY feature) AS na FROM jc),
    mi AS (SELECT feature,
             greatest(sum(n / na * ln(n / (CAST(nb AS DOUBLE) * ny / na))), 0) AS score
           FROM tc GROUP BY 1)"""


def _chi2f() -> str:
    """CTE c2 (feature, score)."""
    parts = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, churned AS y, sum({f}) AS seen, count(*) AS rws, "
        f"min({f}) AS low FROM mx GROUP BY churned"
        for f in SNAPSHOT_FEATURES
    )
    return f"""cs AS ({parts}),
    ct2 AS (SELECT *, rws / sum(rws) OVER (PARTITION BY feature)
              * sum(seen) OVER (PARTITION BY feature) AS e,
              min(low) OVER (PARTITION BY feature) AS lowest FROM cs),
    c2 AS (SELECT feature, CASE WHEN min(lowest) >= 0
             THEN sum((seen - e) * (seen - e) / nullif(e, 0)) END AS score
           FROM ct2 GROUP BY 1)"""


_ORDER_CASE = (
    "CASE feature " + " ".join(f"WHEN '{f}' THEN {n}" for n, f in enumerate(SNAPSHOT_FEATURES))
    + " END"
)
RANKS = f"""{_MATRIX6}, {_mi()}, {_chi2f()},
  sc AS (SELECT 'mutual_info' AS method, feature, round(score, 4) AS score FROM mi
         UNION ALL SELECT 'chi2', feature, round(score, 4) FROM c2),
  rk AS (SELECT *, rank() OVER (PARTITION BY method ORDER BY score DESC NULLS LAST) AS rnk,
           CASE WHEN max(score) OVER (PARTITION BY method) = min(score) OVER (PARTITION BY method)
                THEN score * 0.0 ELSE (score - min(score) OVER (PARTITION BY method))
                / (max(score) OVER (PARTITION BY method) - min(score) OVER (PARTITION BY method))
           END AS norm FROM sc),
  cons AS (SELECT feature, sum(CASE WHEN rnk <= 3 THEN 1 ELSE 0 END) AS votes,
             avg(norm) AS mean_norm_score FROM rk GROUP BY 1)"""

UNIFORM = "CAST('0x' || substr(md5('42:' || CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0"
FOLDS = f"""{SNAPSHOT}, fp AS (
  SELECT c_custkey, churned, row_number() OVER (PARTITION BY churned
           ORDER BY md5('42:' || CAST(c_custkey AS VARCHAR)), c_custkey) AS pos,
         count(*) OVER (PARTITION BY churned) AS n FROM snap),
fold AS (
  SELECT c_custkey, churned,
         CAST((SELECT min(k) FROM range(5) t(k)
               WHERE pos <= (k + 1) * (n // 5) + least(k + 1, n % 5)) AS INTEGER) AS f
  FROM fp)"""


def _sweep(keys: str = "") -> str:
    """CTE sw: the metrics at every threshold, one pass per threshold."""
    k = f"{keys}, " if keys else ""
    group = f"{keys}, t" if keys else "t"
    return f"""grid AS (SELECT CAST(x AS DOUBLE) / 100 AS t FROM range(5, 96) g(x)),
    cnt AS (SELECT {k}t, sum(y) FILTER (p >= t) AS hit, count(*) FILTER (p >= t) AS flag,
              sum(y) AS pos, count(*) AS n FROM s, grid GROUP BY {group}),
    sw AS (SELECT {k}t AS threshold,
        coalesce(coalesce(hit, 0) / nullif(flag, 0), 0) AS precision,
        coalesce(coalesce(hit, 0) / nullif(pos, 0), 0) AS recall,
        coalesce(2.0 * coalesce(hit, 0) / nullif(flag + pos, 0), 0) AS f1,
        (n - pos - flag + 2 * coalesce(hit, 0)) / n AS accuracy,
        flag / n AS positive_rate FROM cnt)"""


_SWEEP_OUT = ", ".join(
    f"{r(c)} AS {c}"
    for c in ("threshold", "precision", "recall", "f1", "accuracy", "positive_rate")
)


def _groups(attributes: list[str], source: str = "s", threshold: float = THRESHOLD) -> str:
    """CTE gm: group metrics of several attributes."""
    long = " UNION ALL ".join(
        f"SELECT '{a}' AS attribute, coalesce(CAST(\"{a}\" AS VARCHAR), 'missing') AS grp, y, p "
        f"FROM {source}"
        for a in attributes
    )
    edges = " + ".join(f"CAST(p >= CAST({k} * 0.1::DOUBLE AS DOUBLE) AS INTEGER)" for k in range(1, 10))
    hat = f"CASE WHEN p >= {threshold} THEN 1 ELSE 0 END"
    return f"""lg AS ({long}),
    bins AS (SELECT attribute, grp, {edges} AS b, count(*) AS n, avg(y) AS my, avg(p) AS mp
             FROM lg GROUP BY 1, 2, 3),
    ec AS (SELECT attribute, grp, sum(n * abs(my - mp)) / sum(n) AS ece FROM bins GROUP BY 1, 2),
    gb AS (SELECT attribute, grp, count(*) AS n, avg(y) AS prevalence,
             avg({hat}) AS selection_rate, avg({hat}) FILTER (y = 1) AS tpr,
             avg({hat}) FILTER (y = 0) AS fpr, avg(y) FILTER (p >= {threshold}) AS precision
           FROM lg GROUP BY 1, 2),
    gm AS (SELECT gb.*, ece FROM gb JOIN ec ON gb.attribute = ec.attribute AND gb.grp = ec.grp)"""


_GROUP_OUT = (
    f'attribute, grp AS "group", {i("n")} AS n, '
    + ", ".join(
        f"{r(c)} AS {c}"
        for c in ("prevalence", "selection_rate", "tpr", "fpr", "precision", "ece")
    )
)
_SUMMARY = """SELECT attribute, count(*) AS n_groups, min(n) AS n_smallest, max(n) AS n_largest,
  CASE WHEN max(selection_rate) > 0 THEN min(selection_rate) / max(selection_rate) END AS di,
  max(selection_rate) - min(selection_rate) AS dpd,
  greatest(max(tpr) - min(tpr), max(fpr) - min(fpr)) AS eod, max(ece) AS me
  FROM gm GROUP BY 1"""

_LINEAR_SQL = LINEAR_SCORE.replace("`", '"')
LINEAR = f'{_matrix()}, lin AS (SELECT kid, 1 / (1 + exp(-({_LINEAR_SQL}))) AS p FROM enc)'

DUPLICATES = '"l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_linenumber"'


def _quality(source: str, columns: str, n_cols: int, hit: str) -> str:
    return f"""SELECT {i("count(*)")} AS n_rows, {i(str(n_cols))} AS n_cols,
      {i(f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source}))")}
        AS n_duplicates,
      {r(f"avg(CASE WHEN {hit} THEN 1 ELSE 0 END)")} AS target_positive_rate,
      {r(f"(1 - avg(CASE WHEN {hit} THEN 1 ELSE 0 END)) / avg(CASE WHEN {hit} THEN 1 ELSE 0 END)")}
        AS imbalance_ratio
    FROM {source}"""


def _tidy(names: list[str], source: str, rounded: dict[str, int], whole: list[str]) -> str:
    out = []
    for n in names:
        if n in rounded:
            out.append(f'{r(f"{chr(34)}{n}{chr(34)}", rounded[n])} AS "{n}"')
        elif n in whole:
            out.append(f'{i(f"{chr(34)}{n}{chr(34)}")} AS "{n}"')
        else:
            out.append(f'"{n}"')
    return f"SELECT {', '.join(out)} FROM {source}"


_NULL_RATE = (
    "SELECT {c} AS category, {n} AS count, {rate} AS churn_rate, count(*) >= {least} AS is_reliable "
    "FROM {source} GROUP BY 1"
)


def _rate(source: str, column: str, y: str, least: int) -> str:
    return _NULL_RATE.format(
        c=f'CAST("{column}" AS VARCHAR)', n=i("count(*)"), rate=r(f"avg({y})"), least=least,
        source=source,
    )


def _build() -> dict[str, str]:
    q: dict[str, str] = {}
    snap_cols = ["tenure_days", "n_orders", "total_spend", "avg_spend", "c_acctbal"]
    money = {"MonthlyCharges": 6, "TotalCharges": 6}
    small = ["SeniorCitizen", "tenure"]

    q["raw_csv"] = f"WITH {RAW} SELECT * FROM raw"
    q["cast_columns"] = f"WITH {ACCOUNTS} {_tidy(fixed.RAW_COLUMNS, 'acc', money, small)}"
    q["interim_table"] = q["cast_columns"]
    names = _encoded(True)[1]
    encoded = ", ".join(f'{r(chr(34) + n + chr(34), 4)} AS "{n}"' for n in names)
    bit = "CAST(CASE WHEN cls_label = 'Yes' THEN 1 ELSE 0 END AS BIGINT) AS \"Churn\""
    q["encoded_matrix"] = (
        f'WITH {_matrix()} SELECT kid AS "customerID", {bit}, part AS split, {encoded} FROM enc'
    )
    q["stored_validation_split"] = (
        f'WITH {_matrix()} SELECT kid AS "customerID", {bit}, {encoded} FROM enc WHERE part = \'val\''
    )
    basic = ", ".join(
        f'{r(f"sum(CAST({chr(34)}{n}{chr(34)} AS DOUBLE))", 2)} AS "{n}"' for n in _encoded(False)[1]
    )
    q["encoded_matrix_basic"] = f"WITH {_matrix(False)} SELECT part AS split, {basic} FROM enc GROUP BY 1"
    q["content_checksums"] = (
        "SELECT doc_id AS name, md5(text) AS md5, sha256(text) AS sha256, "
        f"{i('octet_length(encode(text))')} AS bytes FROM documents"
    )
    q["checksum_verification"] = (
        "SELECT doc_id AS name, CASE WHEN doc_id % 3 = 0 THEN md5(text) WHEN doc_id % 3 = 1 THEN '' "
        "ELSE md5(source) END AS expected, md5(text) AS actual, "
        "doc_id % 3 <> 2 OR md5(source) = md5(text) AS ok FROM documents"
    )
    both = (
        f"{SNAPSHOT}, s AS (SELECT 'by_orders' AS name, churned AS y, CAST({P_TIED} AS DOUBLE) AS p "
        f"FROM snap UNION ALL SELECT 'by_spend', churned, CAST({P_SMOOTH} AS DOUBLE) FROM snap), "
        f"{_curve('name')}, bundle AS ({_metrics(str(THRESHOLD), 'name')})"
    )
    q["model_listing"] = (
        f"WITH {both} SELECT name, 'ClosedForm' AS algorithm, pr_auc FROM bundle"
    )
    q["best_model"] = (
        f"WITH {both} SELECT name, pr_auc AS value FROM bundle ORDER BY pr_auc DESC, name LIMIT 1"
    )
    q["model_facts"] = (
        f"WITH {both}, best AS (SELECT name FROM bundle ORDER BY pr_auc DESC, name LIMIT 1), "
        f"sc AS (SELECT CAST({P_TIED} AS DOUBLE) AS p FROM snap) "
        f"SELECT (SELECT name FROM best) AS model, {r(str(THRESHOLD))} AS threshold, "
        f"CASE WHEN p >= {THRESHOLD} THEN 'high' WHEN p >= {THRESHOLD} / 2.0 THEN 'medium' "
        f"ELSE 'low' END AS risk_band, {i('count(*)')} AS n FROM sc GROUP BY 3"
    )

    q["snapshot"] = f"WITH {SNAPSHOT} " + _tidy(
        ["c_custkey", "c_mktsegment", "nation", "region", "c_acctbal", "tenure_days", "n_orders",
         "total_spend", "avg_spend", "has_urgent", "n_urgent", "churned"],
        "snap", {"c_acctbal": 6, "total_spend": 6, "avg_spend": 6},
        ["tenure_days", "n_orders", "n_urgent", "churned"],
    )
    q["derived_features"] = f"WITH {DERIVED} " + _tidy(
        ["customerID", "tenure_bucket", "services_count", "has_internet", "has_phone",
         "auto_payment", "avg_monthly_spend", "monthly_spend_gap"],
        "der", {"avg_monthly_spend": 4, "monthly_spend_gap": 4}, ["services_count"],
    )
    q["target_bits"] = (
        f'WITH {RAW} SELECT "customerID", '
        "CAST(CASE \"Churn\" WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS BIGINT) AS churned FROM raw"
    )
    q["scoring_input"] = (
        f'WITH {ACCOUNTS} SELECT CAST(0 AS BIGINT) AS "SeniorCitizen", "Contract", '
        f'{i("count(*)")} AS n, {i("count(" + chr(34) + "TotalCharges" + chr(34) + ")")} AS n_total, '
        f'CAST(0 AS BIGINT) AS n_keys FROM acc GROUP BY "Contract"'
    )

    row_rules = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{column}' AS \"column\", \"customerID\" AS key, "
        f"CAST(\"{column}\" AS VARCHAR) AS value, CAST(1 AS BIGINT) AS n_rows FROM brk WHERE {bad}"
        for rule, column, bad in _rules(False)
    )
    q["contract_violations"] = (
        f"WITH {BROKEN} {row_rules} UNION ALL SELECT 'unique', 'customerID', \"customerID\", "
        '"customerID", count(*) FROM brk GROUP BY "customerID" HAVING count(*) > 1'
    )
    q["contract_holds"] = f'WITH {ACCOUNTS} SELECT "customerID" FROM acc'
    q["scoring_quarantine"] = f"WITH {BROKEN} " + " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{column}' AS \"column\", {i('count(*)')} AS n, "
        f"{i('sum(tenure)')} AS months FROM brk WHERE {bad} HAVING count(*) > 0"
        for rule, column, bad in _rules(True)
    )
    q["scoring_valid_rows"] = (
        f'WITH {BROKEN} SELECT gender, "Contract", {i("count(*)")} AS n, {i("sum(tenure)")} AS months '
        f"FROM brk WHERE {_GOOD} GROUP BY 1, 2"
    )
    q["repeated_keys"] = (
        "SELECT 'unique' AS rule, 'l_orderkey,l_linenumber' AS \"column\", "
        "l_orderkey || '|' || l_linenumber AS key, count(*) AS n_rows FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"
    )

    q["dataset_summary"] = (
        f"WITH {ACCOUNTS} SELECT {i('count(*)')} AS n_rows, CAST(21 AS BIGINT) AS n_cols, "
        "round(avg(CASE WHEN \"Churn\" = 'Yes' THEN 1 ELSE 0 END), 4) AS target_pos_rate, "
        f'{i("count(*) - count(" + chr(34) + "TotalCharges" + chr(34) + ")")} AS n_missing_total FROM acc'
    )
    q["quality_report"] = f"WITH {ACCOUNTS} " + _quality("acc", "*", 21, "\"Churn\" = 'Yes'")
    q["duplicate_rows"] = _quality("lineitem", DUPLICATES, 5, "l_returnflag = 'R'")
    q["column_quality"] = f"WITH {ACCOUNTS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {i(f'count(*) - count({chr(34)}{c}{chr(34)})')} AS missing, "
        f'count(DISTINCT "{c}") + CASE WHEN count("{c}") < count(*) THEN 1 ELSE 0 END <= 1 '
        "AS is_constant FROM acc"
        for c in fixed.RAW_COLUMNS
    )
    q["missing_counts"] = f"WITH {ACCOUNTS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {i(f'count(*) - count({chr(34)}{c}{chr(34)})')} AS missing "
        f'FROM acc HAVING count("{c}") < count(*)'
        for c in fixed.RAW_COLUMNS
    )
    q["numeric_summary"] = f"WITH {SNAPSHOT} " + _numeric_summary("snap", snap_cols, 4)
    q["numeric_summary_text"] = f"WITH {RAW} " + _numeric_summary("raw", fixed.NUMERIC, 4)
    q["numeric_summary_lines"] = _numeric_summary(
        "lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 4
    )
    q["categorical_summary"] = f"WITH {SNAPSHOT} " + _categorical_summary(
        "snap", ["c_mktsegment", "nation", "region", "has_urgent"]
    )
    q["categorical_summary_lines"] = _categorical_summary(
        "lineitem", ["l_returnflag", "l_linestatus", "l_suppkey"]
    )
    q["target_distribution"] = (
        f'WITH {ACCOUNTS} SELECT "Churn", count(*) AS count, '
        f"{r('count(*) / sum(count(*)) OVER ()')} AS pct FROM acc GROUP BY 1"
    )
    q["rate_by_category"] = f"WITH {SNAPSHOT} " + _rate("snap", "nation", "churned", 50)
    q["rate_by_category_documents"] = (
        "WITH d AS (SELECT CASE WHEN n_chars >= 500 THEN source END AS place, quality "
        "FROM documents JOIN labels USING (doc_id)) " + _rate("d", "place", "quality", 30)
    )
    q["rate_chart"] = (
        f"WITH {ACCOUNTS}, yy AS (SELECT *, CASE WHEN \"Churn\" = 'Yes' THEN 1 ELSE 0 END AS y FROM acc) "
        f'SELECT "PaymentMethod" AS category, count(*) AS count, {r("avg(y)")} AS churn_rate, '
        f'{r("(SELECT avg(y) FROM yy)")} AS base_rate FROM yy GROUP BY 1'
    )
    width = "(CAST(hi - lo AS DOUBLE) / 30)"
    q["histogram"] = f"""WITH {SNAPSHOT},
      ends AS (SELECT CAST(min(tenure_days) AS DOUBLE) AS lo, CAST(max(tenure_days) AS DOUBLE) AS hi
               FROM snap),
      cl AS (SELECT CAST(churned AS VARCHAR) AS class, count(*) AS n_class FROM snap GROUP BY 1),
      fnd AS (SELECT CAST(churned AS VARCHAR) AS class,
                least(floor((tenure_days - lo) / {width}), 29) AS b, count(*) AS n
              FROM snap, ends GROUP BY 1, 2)
      SELECT cl.class, {i("g.b")} AS bin, {r(f"lo + g.b * {width}", 8)} AS bin_start,
        {r(f"lo + (g.b + 1) * {width}", 8)} AS bin_end, {i("coalesce(n, 0)")} AS count,
        {r(f"coalesce(n, 0) / (n_class * {width})", 8)} AS density
      FROM cl CROSS JOIN range(30) g(b) CROSS JOIN ends
      LEFT JOIN fnd ON fnd.class = cl.class AND fnd.b = g.b"""
    q["box_plot"] = f"""WITH {SNAPSHOT},
      qs AS (SELECT churned, quantile_cont(total_spend, 0.25) AS q1,
               quantile_cont(total_spend, 0.5) AS q2, quantile_cont(total_spend, 0.75) AS q3
             FROM snap GROUP BY 1),
      ins AS (SELECT snap.churned, q1, q2, q3, total_spend AS v,
                total_spend BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS ok
              FROM snap JOIN qs ON snap.churned = qs.churned)
      SELECT CAST(churned AS VARCHAR) AS class, {r("q1", 4)} AS q1, {r("q2", 4)} AS median,
        {r("q3", 4)} AS q3, {i("count(*)")} AS n,
        {r("least(min(v) FILTER (ok), q1)", 4)} AS whisker_low,
        {r("greatest(max(v) FILTER (ok), q3)", 4)} AS whisker_high,
        {i("count(*) FILTER (NOT ok)")} AS n_outliers
      FROM ins GROUP BY churned, q1, q2, q3"""
    q["correlation_pearson"] = f"WITH {SNAPSHOT} " + _pearson(
        "snap", ["tenure_days", "n_orders", "total_spend", "c_acctbal"]
    )
    q["correlation_spearman"] = f"WITH {SNAPSHOT} " + _spearman(
        "snap", ["tenure_days", "n_orders", "total_spend"]
    )
    q["correlation_spearman_missing"] = f"WITH {ACCOUNTS} " + _spearman("acc", fixed.NUMERIC)
    q["correlation_kendall"] = f"WITH {SNAPSHOT} " + _kendall(
        "snap", ["tenure_days", "n_orders", "churned"]
    )
    q["correlation_heatmap"] = f"WITH {DERIVED} " + _pearson(
        "der", [*fixed.NUMERIC, *fixed.DERIVED_NUMERIC], lower=True
    )
    q["target_correlation"] = (
        f"WITH {ACCOUNTS}, yy AS (SELECT *, CASE WHEN \"Churn\" = 'Yes' THEN 1 ELSE 0 END AS churn_bit "
        "FROM acc) " + _pearson("yy", [*fixed.NUMERIC, "churn_bit"])
    )
    q["contingency"] = (
        f"WITH {ACCOUNTS}, lng AS ({_long('acc', ['Contract', 'PaymentMethod'], 'Churn')}) "
        "SELECT variable, value, class, count(*) AS n FROM lng GROUP BY 1, 2, 3"
    )
    q["crosstab"] = (
        f'WITH {ACCOUNTS} SELECT "Contract" AS value, '
        "count(*) FILTER (\"Churn\" = 'No') AS \"No\", "
        "count(*) FILTER (\"Churn\" = 'Yes') AS \"Yes\" FROM acc GROUP BY 1"
    )
    q["chi_square"] = (
        f"WITH {SNAPSHOT}, {_chi('snap', ['c_mktsegment', 'nation', 'region'], 'churned')} "
        f"SELECT variable, {i('total')} AS total, n_values, n_classes, {r('chi2')} AS chi2 FROM chi"
    )
    q["cramers_v"] = f"""WITH {ACCOUNTS},
      {_chi("acc", [*fixed.BINARY, *fixed.ORDINAL, *fixed.NOMINAL], "Churn")},
      cor AS (SELECT variable,
          greatest(0, chi2 / total - (n_classes - 1) * (n_values - 1) / (total - 1)) AS phi,
          least(n_classes - (n_classes - 1) * (n_classes - 1) / (total - 1),
                n_values - (n_values - 1) * (n_values - 1) / (total - 1)) - 1 AS room FROM chi)
      SELECT variable,
        {r("CASE WHEN room <= 0 THEN 0 ELSE sqrt(phi / room) END")} AS cramers_v FROM cor"""
    fixed_sizes = {
        "numeric_summary": 3, "categorical_summary": 17, "target_distribution": 2, "cramers_v": 16,
        "target_chart": 2, "tenure_histogram": 60,
        "monthly_charges_histogram": 60, "total_charges_box": 2, "correlation_heatmap": 21,
    }
    varying = {
        "churn_by_contract": "Contract", "churn_by_payment_method": "PaymentMethod",
        "churn_by_tenure_bucket": "tenure_bucket",
    }
    q["exploration_tables"] = f"WITH {DERIVED} " + " UNION ALL ".join(
        [f"SELECT '{n}' AS report, CAST({c} AS BIGINT) AS n_rows" for n, c in fixed_sizes.items()]
        + [
            "SELECT 'missing_values', CASE WHEN count(\"TotalCharges\") < count(*) THEN 1 ELSE 0 END "
            "FROM der"
        ]
        + [
            f"SELECT '{n}', (SELECT count(*) FROM (SELECT DISTINCT \"{c}\" FROM der))"
            for n, c in varying.items()
        ]
    )

    q["split_assignment"] = f'WITH {SPLIT} SELECT "customerID", "Churn", split FROM spl'
    q["split_rates"] = (
        f"WITH {SPLIT} SELECT split, {i('count(*)')} AS n_rows, "
        + r("avg(CASE WHEN \"Churn\" = 'Yes' THEN 1 ELSE 0 END)")
        + " AS positive_rate FROM spl GROUP BY 1"
    )
    q["fold_assignment"] = (
        f"WITH {FOLDS} SELECT c_custkey, {i('churned')} AS churned, CAST(f AS VARCHAR) AS fold FROM fold"
    )
    q["encoder_parameters"] = f"WITH {SPLIT}, {_encoded(True)[0]} " + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {r(chr(34) + 'med_' + c + chr(34), 4)} AS median, "
        f"{r(chr(34) + 'avg_' + c + chr(34), 4)} AS mean, "
        f"{r(chr(34) + 'dev_' + c + chr(34), 4)} AS deviation FROM med, mom"
        for c in [*fixed.NUMERIC, *fixed.DERIVED_NUMERIC]
    )

    q["mutual_information"] = (
        f"WITH {_MATRIX6}, {_mi()} SELECT 'mutual_info' AS method, feature, {r('score')} AS score FROM mi"
    )
    q["chi2_scores"] = (
        f"WITH {_MATRIX6}, {_chi2f()} SELECT 'chi2' AS method, feature, {r('score', 4)} AS score FROM c2"
    )
    q["score_ranks"] = (
        f"WITH {RANKS} SELECT method, feature, {i('rnk')} AS rank, "
        f"{i('CASE WHEN rnk <= 3 THEN 1 ELSE 0 END')} AS vote, {r('norm', 4)} AS norm_score FROM rk"
    )
    q["consensus_features"] = (
        f"WITH {RANKS} SELECT feature, {i('votes')} AS votes, {r('mean_norm_score', 4)} AS mean_norm_score "
        f"FROM cons ORDER BY cons.votes DESC, cons.mean_norm_score DESC NULLS LAST, {_ORDER_CASE} LIMIT 3"
    )
    q["top_importance"] = (
        f"WITH {_MATRIX6}, {_chi2f()} SELECT feature, {r('score', 4)} AS importance FROM c2 "
        "WHERE score IS NOT NULL ORDER BY score DESC, feature LIMIT 3"
    )

    q["class_weights"] = (
        f"WITH {SNAPSHOT} SELECT {i('churned')} AS label, count(*) AS n, "
        f"{r('(SELECT count(*) FROM snap) / (2.0 * count(*))')} AS weight FROM snap GROUP BY churned"
    )
    q["constant_models"] = f"""WITH {SNAPSHOT},
      rate AS (SELECT avg(churned) AS b FROM snap)
      SELECT 'dummy_stratified' AS model, c_custkey, {i("churned")} AS y,
        CASE WHEN {UNIFORM} < b THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p FROM snap, rate
      UNION ALL SELECT 'dummy_most_frequent', c_custkey, {i("churned")},
        CASE WHEN b > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM snap, rate
      UNION ALL SELECT 'dummy_prior', c_custkey, {i("churned")}, {r("b")} FROM snap, rate"""
    q["cross_validation"] = f"""WITH {FOLDS},
      rates AS (SELECT k AS held, avg(churned) AS b FROM fold, range(5) t(k) WHERE f <> k GROUP BY 1),
      s AS (SELECT 'dummy_stratified' AS model, f, churned AS y,
              CASE WHEN {UNIFORM} < b THEN 1.0 ELSE 0.0 END AS p FROM fold JOIN rates ON f = held
            UNION ALL SELECT 'dummy_most_frequent', f, churned,
              CASE WHEN b > 0.5 THEN 1.0 ELSE 0.0 END FROM fold JOIN rates ON f = held
            UNION ALL SELECT 'dummy_prior', f, churned, b FROM fold JOIN rates ON f = held),
      {_curve("model, f")},
      pf AS (SELECT model, f, coalesce(sum(tp / nullif(pos, 0) * ct / cn), 0) AS ap,
               sum((n - tp) * (ct - tp / 2.0) / (CAST(pos AS DOUBLE) * (tot - pos))) AS auc
             FROM c GROUP BY 1, 2)
      SELECT model, {r("avg(ap)")} AS cv_pr_auc_mean, {r("stddev_pop(ap)")} AS cv_pr_auc_std,
        {r("avg(auc)")} AS cv_roc_auc_mean, {r("stddev_pop(auc)")} AS cv_roc_auc_std,
        {i("count(*)")} AS cv_folds FROM pf GROUP BY 1"""

    q["metric_bundle"] = f"WITH {TIED}, {_curve()} {_metrics(str(THRESHOLD))}"
    q["metric_bundle_by_region"] = (
        f"WITH {SMOOTH}, {_curve('region')} {_metrics(str(THRESHOLD), 'region')}"
    )
    q["metric_bundle_documents"] = (
        "WITH s AS (SELECT doc_id, lang, quality AS y, "
        "CAST(least(n_chars / 8192.0, 1.0) AS DOUBLE) AS p FROM documents JOIN labels USING (doc_id)), "
        f"{_curve('lang')} {_metrics('0.5', 'lang')}"
    )
    lines = (
        "s AS (SELECT l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, "
        "CAST(round(1 / (1 + exp(-(l_discount * 8 - l_quantity / 40.0 - 0.5))), 6) AS DOUBLE) AS p "
        "FROM lineitem)"
    )
    q["metric_bundle_lines"] = (
        f"WITH {lines}, {_curve('l_linestatus')} {_metrics('0.35', 'l_linestatus')}"
    )
    q["group_metrics_lines"] = (
        f"WITH {lines}, {_groups(['l_linestatus'], threshold=0.35)} SELECT {_GROUP_OUT} FROM gm"
    )
    q["band_counts_lines"] = (
        f"WITH {lines} SELECT CASE WHEN p >= 0.35 THEN 'high' WHEN p >= 0.35 / 2.0 THEN 'medium' "
        "ELSE 'low' END AS risk_band, CASE WHEN p >= 0.35 THEN 'churn' ELSE 'no_churn' END AS label, "
        f"count(*) AS n, {r('sum(p)', 3)} AS probability FROM s GROUP BY 1, 2"
    )
    q["threshold_sweep"] = f"WITH {TIED}, {_sweep()} SELECT {_SWEEP_OUT} FROM sw"
    q["threshold_sweep_by_region"] = (
        f"WITH {SMOOTH}, {_sweep('region')} SELECT region, {_SWEEP_OUT} FROM sw"
    )
    q["best_threshold"] = (
        f"WITH {SMOOTH}, {_sweep('region')}, o AS (SELECT *, row_number() OVER (PARTITION BY region "
        "ORDER BY f1 DESC, threshold) AS rn FROM sw) SELECT region, 'f1' AS metric, "
        f"{r('threshold')} AS threshold, {r('f1')} AS score FROM o WHERE rn = 1"
    )
    q["confusion_matrix"] = f"""WITH {TIED} SELECT {i("a.v")} AS y, {i("b.v")} AS predicted,
      (SELECT count(*) FROM s WHERE y = a.v AND (CASE WHEN p >= {THRESHOLD} THEN 1 ELSE 0 END) = b.v)
        AS n FROM range(2) a(v) CROSS JOIN range(2) b(v)"""
    edges = " + ".join(
        f"CAST((SELECT quantile_cont(p, {k / 10}) FROM s) < p AS INTEGER)" for k in range(1, 10)
    )
    q["calibration_curve"] = (
        f"WITH {SMOOTH} SELECT {i(edges)} AS bin, count(*) AS n, {r('avg(p)')} AS mean_predicted, "
        f"{r('avg(y)')} AS observed_rate FROM s GROUP BY 1"
    )
    q["pr_points"] = (
        f"WITH {TIED}, {_curve()} SELECT {r('p')} AS threshold, {r('ct / cn')} AS precision, "
        f"{r('ct / pos')} AS recall, {r('pos / tot')} AS base_rate FROM c UNION ALL "
        f"SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE, {r('max(pos) / max(tot)')} FROM c"
    )
    q["roc_points"] = (
        f"WITH {TIED}, {_curve('region')} SELECT region, {r('p')} AS threshold, "
        f"{r('(cn - ct) / (tot - pos)')} AS fpr, {r('ct / pos')} AS tpr FROM c UNION ALL "
        "SELECT DISTINCT region, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM c"
    )
    q["evaluation_report"] = f"""WITH {SPLIT}, rate AS (
        SELECT avg(CASE WHEN "Churn" = 'Yes' THEN 1 ELSE 0 END) AS b FROM spl WHERE split = 'train'),
      s AS (SELECT split, CASE WHEN "Churn" = 'Yes' THEN 1 ELSE 0 END AS y, b AS p
            FROM spl, rate WHERE split <> 'train'),
      {_curve("split")} {_metrics("0.05", "split")}"""

    ece_edges = " + ".join(
        f"CAST(p >= CAST({k} * 0.1::DOUBLE AS DOUBLE) AS INTEGER)" for k in range(1, 10)
    )
    q["calibration_error"] = f"""WITH {TIED},
      bins AS (SELECT region, {ece_edges} AS b, count(*) AS n, avg(y) AS my, avg(p) AS mp
               FROM s GROUP BY 1, 2)
      SELECT region, {i("sum(n)")} AS n, {r("sum(n * abs(my - mp)) / sum(n)")} AS ece
      FROM bins GROUP BY 1"""
    three = ["region", "c_mktsegment", "has_urgent"]
    q["group_metrics"] = f"WITH {TIED}, {_groups(three)} SELECT {_GROUP_OUT} FROM gm"
    q["fairness_summary"] = f"""WITH {TIED}, {_groups(three)}, fs AS ({_SUMMARY})
      SELECT attribute, n_groups, {i("n_smallest")} AS n_smallest, {i("n_largest")} AS n_largest, {r("di")} AS disparate_impact,
        {r("dpd")} AS demographic_parity_diff, {r("eod")} AS equalized_odds_diff,
        {r("me")} AS max_ece, coalesce(di >= 0.8, false) AS disparate_impact_ok,
        dpd < 0.1 AS demographic_parity_ok, coalesce(eod < 0.1, false) AS equalized_odds_ok,
        me < 0.05 AS max_ece_ok,
        coalesce(di >= 0.8, false) AND dpd < 0.1 AND coalesce(eod < 0.1, false) AND me < 0.05
          AS within_thresholds FROM fs"""
    q["fairness_chart"] = f"WITH {TIED}, {_groups(three[:2])} " + " UNION ALL ".join(
        f"SELECT attribute, grp AS \"group\", '{m}' AS metric, {r(m)} AS value FROM gm"
        for m in ("selection_rate", "tpr", "fpr", "precision")
    )
    q["sensitive_columns"] = (
        f'WITH {LINEAR} SELECT kid AS "customerID", '
        "CAST(CASE WHEN \"Churn\" = 'Yes' THEN 1 ELSE 0 END AS BIGINT) AS y, "
        f'{r("p", 3)} AS p, gender, {i(chr(34) + "SeniorCitizen" + chr(34))} AS "SeniorCitizen", '
        '"Partner", "Dependents" FROM lin JOIN acc ON kid = "customerID"'
    )
    uniform = "CAST('0x' || substr(md5('42:' || \"customerID\"), 1, 8) AS BIGINT) / 4294967296.0"
    # Scores are 0 or 1, so every threshold of the grid selects the same rows.
    q["fairness_audit"] = f"""WITH {SPLIT}, rate AS (
        SELECT avg(CASE WHEN "Churn" = 'Yes' THEN 1 ELSE 0 END) AS b FROM spl WHERE split = 'train'),
      s AS (SELECT gender, "SeniorCitizen", "Partner", "Dependents",
              CASE WHEN "Churn" = 'Yes' THEN 1 ELSE 0 END AS y,
              CASE WHEN {uniform} < b THEN 1.0 ELSE 0.0 END AS p
            FROM spl, rate WHERE split = 'test'),
      {_groups(fixed.SENSITIVE, threshold=0.05)} SELECT {_GROUP_OUT} FROM gm"""

    q["account_scores"] = f'WITH {LINEAR} SELECT kid AS "customerID", {r("p", 3)} AS p FROM lin'
    q["predictions"] = (
        f"WITH {TIED} SELECT c_custkey, {r('p')} AS probability, "
        f"{i(f'CASE WHEN p >= {THRESHOLD} THEN 1 ELSE 0 END')} AS prediction, "
        f"CASE WHEN p >= {THRESHOLD} THEN 'churn' ELSE 'no_churn' END AS label, "
        f"CASE WHEN p >= {THRESHOLD} THEN 'high' WHEN p >= {THRESHOLD} / 2.0 THEN 'medium' "
        "ELSE 'low' END AS risk_band FROM s"
    )
    q["batch_summary"] = (
        f"WITH {SMOOTH} SELECT count(*) AS n_customers, "
        f"{i(f'count(*) FILTER (p >= {THRESHOLD})')} AS n_predicted_churn, "
        f"{r(f'avg(CASE WHEN p >= {THRESHOLD} THEN 1 ELSE 0 END)')} AS churn_rate_predicted, "
        f"{r('avg(round(p, 6))')} AS mean_probability FROM s"
    )
    fit, _, columns = _encoded(True)
    q["streamed_predictions"] = (
        f"WITH {SPLIT}, {fit}, {_BREAK}, good AS (SELECT * FROM brk WHERE {_GOOD}), "
        f"{_derive('good', 'gd')}, "
        f'enc AS (SELECT "customerID" AS kid, {columns} FROM gd, med, mom), '
        f"sc AS (SELECT kid, 1 / (1 + exp(-({_LINEAR_SQL}))) AS p FROM enc) "
        f'SELECT kid AS "customerID", {r("p", 3)} AS probability, '
        f"{i('CASE WHEN p >= 0.4 THEN 1 ELSE 0 END')} AS prediction, "
        "CASE WHEN p >= 0.4 THEN 'churn' ELSE 'no_churn' END AS label, "
        "CASE WHEN p >= 0.4 THEN 'high' WHEN p >= 0.2 THEN 'medium' ELSE 'low' END AS risk_band FROM sc"
    )
    q["streamed_quarantine"] = f'SELECT rule, "column", n FROM ({q["scoring_quarantine"]}) s'
    return q


ORACLES = _build()
