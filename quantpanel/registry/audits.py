"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantpanel.operators import asset_features as af
from quantpanel.operators import audit
from quantpanel.operators import cross_features as cf
from quantpanel.operators import market_features as mf
from quantpanel.operators import point_in_time as pit
from quantpanel.operators import splits as sp
from quantpanel.operators import teacher
from quantpanel.operators.grid import calendar_of
from quantpanel.registry.backtests import STATIC, WALK, WALK_SQL
from quantpanel.registry.base import MACRO, P2, cal, query, r, rounded
from quantpanel.registry.features import ALL_SQL, FEATURES_CTE, p2
from quantpanel.registry.fixtures import LABEL_CTE, SCORES, LabelInputs
from quantpanel.registry.labels import _ranked
from quantpanel.registry.market import CUTS, VIX, cutoff_calendar
from quantpanel.registry.primitives import RAW, _raw
from quantpanel.sources import panels


def _checks(section: str, source: str, rows: list[tuple[str, str, str | None]]) -> str:
    """One SELECT per check: (name, value SQL, failure status)."""
    parts = []
    for name, value, failure in rows:
        status = "'INFO'" if failure is None else f"CASE WHEN {value} = 0 THEN 'PASS' ELSE '{failure}' END"
        parts.append(
            f"""SELECT '{section}' AS section, '{name}' AS "check", {status} AS status, {r(f'CAST({value} AS DOUBLE)', 'value')} FROM {source}"""
        )
    return " UNION ALL ".join(parts)


@query(
    "U01_price_audit",
    f"""WITH {RAW}, k AS (SELECT date, ticker, count(*) AS n FROM raw GROUP BY 1, 2),
    t AS (SELECT (SELECT count(*) FROM raw) AS rows, (SELECT count(DISTINCT ticker) FROM raw) AS tickers,
      (SELECT min(date) - DATE '1970-01-01' FROM raw) AS lo, (SELECT max(date) - DATE '1970-01-01' FROM raw) AS hi,
      (SELECT count(*) FROM k WHERE n > 1) AS dup, (SELECT count(*) FROM raw WHERE close IS NULL) AS nulls)
    {_checks('prices', 't', [('rows', 'rows', None), ('tickers', 'tickers', None), ('first_date', 'lo', None),
      ('last_date', 'hi', None), ('duplicate_keys', 'dup', 'FAIL'), ('null_adj_close', 'nulls', 'WARN')])}""",
)
def _u01(spark, sf):
    """The raw rows, which have repeated keys and missing prices."""
    raw = _raw(spark, sf)
    rows = raw.withColumn("adj_close", F.when(~F.isnan("close"), F.col("close"))).withColumn(
        "date", F.col("date").cast("date")
    )
    return rounded(audit.price_audit(rows))


@query(
    "U02_block_coverage",
    f"""WITH {P2}, {MACRO}, {VIX} SELECT 'asset' AS block, count(*) AS n_rows, 6::BIGINT AS n_columns, min(date) AS first_date, max(date) AS last_date FROM p2
    UNION ALL SELECT 'market', count(*), 6, min(asof_date), max(asof_date) FROM vix
    UNION ALL SELECT 'cross_asset', count(DISTINCT date), 2, min(date), max(date) FROM p2""",
)
def _u02(spark, sf):
    prices = p2(spark, sf)
    vix = mf.vix_features(panels.vix_series(spark, sf))
    return audit.block_coverage(
        {"asset": prices, "market": vix, "cross_asset": cf.universe_return(prices), "absent": None}
    )


_MISS = " UNION ALL ".join(
    f"SELECT '{n}' AS \"column\", count(*) FILTER ({n} IS NULL) AS nulls, {r(f'count(*) FILTER ({n} IS NULL) / count(*)', 'share')} FROM feats"
    for n in ALL_SQL
)


@query("U03_missingness", f"WITH {FEATURES_CTE} {_MISS}")
def _u03(spark, sf):
    table = af.asset_features(p2(spark, sf)).select(*ALL_SQL)
    return rounded(audit.missingness(table))


@query(
    "U03_top_missing",
    f'WITH {FEATURES_CTE}, m AS ({_MISS}) SELECT "column", nulls, share FROM m WHERE nulls > 0 ORDER BY nulls DESC, "column" LIMIT 10',
)
def _u03_top(spark, sf):
    table = af.asset_features(p2(spark, sf)).select(*ALL_SQL)
    return rounded(audit.top_missing(table))


@query(
    "U03_total_missing",
    f"WITH {FEATURES_CTE}, m AS ({_MISS.replace('round(', '(').replace(', 6) + 0.0', ')')}) SELECT {r('avg(share) * 100', 'missing_percent')} FROM m",
)
def _u03_total(spark, sf):
    table = af.asset_features(p2(spark, sf)).select(*ALL_SQL)
    return rounded(audit.total_missing(table))


_LABELS = f"""{LABEL_CTE}, {SCORES}, s AS (SELECT b.date, horizon_h, ticker, sum(p * w) AS soft,
    sum(CASE WHEN rank = 0 THEN w ELSE 0 END) AS hard FROM blend b JOIN cand c USING (date, cand_id) GROUP BY 1, 2, 3),
  d AS (SELECT date, horizon_h, sum(hard) AS hs, sum(soft) AS ss, min(least(hard, soft)) AS lo, count(*) FILTER (soft > 0.01) AS active,
    max(soft) AS mx, sum(CASE WHEN ticker = 'CASH' THEN soft ELSE 0 END) AS cash FROM s GROUP BY 1, 2),
  c AS (SELECT date, horizon_h, max(objective_total) - min(objective_total) AS conf FROM topk GROUP BY 1, 2)"""


@query(
    "U04_label_audit",
    f"""WITH {_LABELS}, t AS (SELECT count(*) AS rows, count(*) FILTER (abs(hs - 1) > 1e-6 OR abs(ss - 1) > 1e-6) AS off,
      count(*) FILTER (lo < -1e-8) AS neg, avg(active) AS am, median(active) AS amd, avg(mx) AS mx, avg(cash) AS cash FROM d),
    k AS (SELECT avg(conf) AS cm, median(conf) AS cmd, min(conf) AS clo, max(conf) AS chi FROM c), tk AS (SELECT * FROM t, k)
    {_checks('labels', 'tk', [('rows', 'rows', None), ('sum_violations', 'off', 'FAIL'), ('negative_vectors', 'neg', 'FAIL'),
      ('confidence_mean', 'cm', None), ('confidence_median', 'cmd', None), ('confidence_min', 'clo', None), ('confidence_max', 'chi', None),
      ('active_mean', 'am', None), ('active_median', 'amd', None), ('max_weight_mean', 'mx', None), ('cash_weight_mean', 'cash', None)])}""",
)
def _u04(spark, sf):
    inputs = LabelInputs(spark, sf)
    weights, labels = teacher.distill(_ranked(inputs), inputs.candidates)
    return rounded(audit.label_audit(weights, labels))


@query(
    "U05_candidate_audit",
    f"""WITH {LABEL_CTE}, {SCORES}, k AS (SELECT *, CASE WHEN cand_id < 6 THEN 'deterministic' WHEN cand_id < 13 THEN 'random' ELSE 'perturbation' END AS cand_type FROM ranked WHERE rank < 10)
    SELECT cand_type, count(*) AS n_candidates, count(*) FILTER (rank = 0) AS n_wins, {r('avg(objective_total)', 'mean_objective')},
      {r('median(objective_total)', 'median_objective')} FROM k GROUP BY 1""",
)
def _u05(spark, sf):
    number = F.col("cand_id")
    kind = F.when(number < 6, "deterministic").when(number < 13, "random").otherwise("perturbation")
    return rounded(audit.candidate_audit(_ranked(LabelInputs(spark, sf)).withColumn("cand_type", kind)))


_WALK_PART = WALK_SQL.replace("n AS (SELECT count(*) AS n FROM cal),", "").replace("idx AS", "widx AS").replace("FROM idx", "FROM widx").replace("splits AS MATERIALIZED", "wsplits AS")


@query(
    "U06_split_audit",
    f"""WITH {P2}, {cal('p2')}, {STATIC}, {_WALK_PART}
    SELECT 'static' AS kind, split_name AS fold, split_name, start_date, end_date, end_date - start_date + 1 AS n_calendar_days FROM splits
    UNION ALL SELECT 'walkforward', regexp_extract(split_name, '^(walkforward_\\d+)_', 1), split_name, start_date, end_date, end_date - start_date + 1 FROM wsplits""",
)
def _u06(spark, sf):
    days = calendar_of(p2(spark, sf))
    return audit.split_audit(sp.static_splits(days).unionByName(sp.walkforward_splits(days, WALK)))


@query(
    "U07_leakage_audit",
    f"""WITH {LABEL_CTE}, {SCORES}, s AS (SELECT b.date, horizon_h, ticker, sum(CASE WHEN rank = 0 THEN w ELSE 0 END) AS hard FROM blend b JOIN cand c USING (date, cand_id) GROUP BY 1, 2, 3),
    v AS (SELECT 0 AS late, (SELECT count(*) FROM s WHERE hard > CASE WHEN ticker = 'CASH' THEN 1.0 ELSE 0.25 END + 1e-6) AS cap, 0 AS uns, 0 AS neg)
    {_checks('leakage', 'v', [('fact_after_cutoff', 'late', 'FAIL'), ('weight_above_cap', 'cap', 'FAIL'), ('unsorted_top_k', 'uns', 'FAIL'), ('negative_confidence', 'neg', 'FAIL')])}""",
)
def _u07(spark, sf):
    inputs = LabelInputs(spark, sf)
    ranked = _ranked(inputs)
    weights, labels = teacher.distill(ranked, inputs.candidates)
    days = cutoff_calendar(spark, sf)
    facts = panels.event_facts(spark, sf).withColumn("known_ts", F.col("accepted_ts"))
    known = pit.point_in_time(facts, days, "key", "accepted_ts", ["known_ts"], "seq")
    known = known.join(days.select("date", "cutoff"), "date")
    return rounded(audit.leakage_audit(known, weights, ranked, labels, inputs.universe))


@query(
    "U07_leakage_violations",
    f"""WITH {LABEL_CTE}, {SCORES}, {CUTS.replace("cuts AS", "cuts AS MATERIALIZED")},
    sw AS (SELECT date, horizon_h, rank + 1 - 2 * (rank % 2) AS rk, objective_total FROM ranked WHERE rank < 10),
    lab AS (SELECT date, horizon_h, max(objective_total) - min(objective_total) - 0.05 AS conf FROM topk GROUP BY 1, 2),
    s AS (SELECT b.date, horizon_h, ticker, sum(CASE WHEN rank = 0 THEN w ELSE 0 END) AS hard FROM blend b JOIN cand c USING (date, cand_id) GROUP BY 1, 2, 3),
    v AS (SELECT (SELECT count(*) FROM events e JOIN cuts ON CAST(e.ts AS DATE) = cuts.date WHERE e.ts > cuts.cutoff) AS late,
      (SELECT count(*) FROM s WHERE 2 * hard > CASE WHEN ticker = 'CASH' THEN 1.0 ELSE 0.25 END + 1e-6) AS cap,
      (SELECT count(*) FROM sw a JOIN sw b ON a.date = b.date AND a.horizon_h = b.horizon_h AND b.rk = a.rk + 1
        WHERE b.objective_total > a.objective_total) AS uns,
      (SELECT count(*) FROM lab WHERE conf < 0) AS neg,
      (SELECT count(*) FROM events e JOIN cuts ON CAST(e.ts AS DATE) = cuts.date WHERE CAST(e.ts AS DATE) + 1 > CAST(cuts.cutoff AS DATE)) AS vint)
    {_checks('leakage', 'v', [('fact_after_cutoff', 'late', 'FAIL'), ('weight_above_cap', 'cap', 'FAIL'), ('unsorted_top_k', 'uns', 'FAIL'), ('negative_confidence', 'neg', 'FAIL'), ('vintage_after_cutoff', 'vint', 'FAIL')])}""",
)
def _u07_violations(spark, sf):
    """Every rule broken on purpose: facts used on their own day whatever the hour, doubled
    weights, neighbouring ranks exchanged, confidence lowered, vintages of the next day."""
    inputs = LabelInputs(spark, sf)
    ranked = _ranked(inputs)
    weights, labels = teacher.distill(ranked, inputs.candidates)
    days = cutoff_calendar(spark, sf).select("date", "cutoff")
    facts = panels.event_facts(spark, sf)
    naive = facts.withColumn("date", F.to_date("accepted_ts")).join(days, "date")
    exchanged = ranked.withColumn("rank", F.expr("rank + 1 - 2 * (rank % 2)"))
    return rounded(
        audit.leakage_audit(
            naive.withColumn("known_ts", F.col("accepted_ts")),
            weights.withColumn("hard", 2 * F.col("hard")),
            exchanged,
            labels.withColumn("teacher_confidence", F.col("teacher_confidence") - 0.05),
            inputs.universe,
            vintages=naive.withColumn("vintage_date", F.date_add("date", 1)),
        )
    )
