"""The same questions in DuckDB SQL, written from the definitions.

``SQL[name]`` answers the query of that name. Shared relations are CTEs listed
in ``RELATIONS``; only those a query needs are put in front of it.
"""

from __future__ import annotations

import re

from ..functions import business as B
from ..operators.scoring import NUMERIC_FEATURES
from ..operators.whatif import SCENARIOS

HORIZON = 30
# Fixed values, written out here so that the code under test cannot change both sides.
RULES = [
    ("count_429_onboarding >= 3", "High rate limit frequency", "Increase RPM quota — escalate to Solutions Engineering", "AE + SE"),
    ("avg_ttft_ms_onboarding >= 400", "High TTFT (latency)", "Route to lower-latency deployment or regional endpoint", "Infra + AE"),
    ("max_context_saturation_onboarding >= 0.90", "Context window saturation", "Recommend upgrade to larger context model", "AE"),
    ("count_500_onboarding + count_503_onboarding >= 3", "Elevated server error rate", "Flag for infrastructure investigation", "Engineering"),
    ("avg_cache_ratio_onboarding < 0.10", "Low prompt cache utilisation", "Proactive prompt caching workshop", "Customer Success"),
]
DEFAULT_RULE = ("Declining velocity", "Proactive check-in call — use-case review", "AE")
LEVELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def rnd(expression: str, digits: int = 6) -> str:
    """Rounding without a negative zero."""
    return f"(ROUND(CAST({expression} AS DOUBLE), {digits}) + 0.0)"


def mean(column: str, digits: int, condition: str = "TRUE") -> str:
    """Mean of a column with a fixed number of decimals, summed in whole units."""
    unit = 10**digits
    return (
        f"(CAST(SUM(CAST(ROUND({column} * {unit}) AS BIGINT)) FILTER (WHERE {condition}) AS DOUBLE)"
        f" / NULLIF(CAST(COUNT({column}) FILTER (WHERE {condition}) AS DOUBLE) * {unit}, 0))"
    )


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def case(branches: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in branches) + f" ELSE {otherwise} END"


def tier_value(column: str = "contract_tier", enterprise: int = 120000, growth: int = 24000) -> str:
    return f"CASE {column} WHEN 'Enterprise' THEN {enterprise} ELSE {growth} END"


def risk(ttft: str, n429: str) -> str:
    return (
        f"LEAST(CAST(1 AS DOUBLE), ({ttft}) / CAST(800 AS DOUBLE)"
        f" + LEAST(CAST({n429} AS DOUBLE), CAST(5 AS DOUBLE)) * CAST(0.1 AS DOUBLE))"
    )


def rule_case(field: str) -> str:
    place = ("trigger", "action", "owner").index(field)
    rules = [(f"COALESCE({when}, FALSE)", quote(texts[place])) for when, *texts in RULES]
    return case(rules, quote(DEFAULT_RULE[place]))


CODES = (429, 500, 503, 400)
CODE_COUNTS = ", ".join(
    f"CAST(COALESCE(SUM(error_count) FILTER (WHERE error_code = {c}), 0) AS BIGINT) AS count_{c}_onboarding"
    for c in CODES
)
DAY_BIN = case(
    [(f"day_since_signup >= {lo} AND day_since_signup < {hi}", quote(label)) for label, lo, hi in B.DAY_BINS], "NULL"
)
BIN_NAMES = [label.lower().replace(" ", "_").replace("-", "_") for label in B.DAY_BIN_LABELS]

RELATIONS: dict[str, str] = {
    "ev": """
        SELECT event_id, user_id, ts, CAST(ts AS DATE) AS dt, event_type,
               CAST(ROUND(value * 100) AS BIGINT) AS cents,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
        FROM events""",
    "companies": """
        SELECT c_custkey AS company_id, c_name AS company_name, c_mktsegment AS industry,
               CASE WHEN c_acctbal >= 5000 THEN 'Enterprise' ELSE 'Growth' END AS contract_tier,
               CAST(DATE '2024-01-01' + CAST(c_custkey % 10 AS INTEGER) AS DATE) AS signup_date,
               CAST(0.3 AS DOUBLE) + CAST(c_custkey % 10 AS DOUBLE) * CAST(0.09 AS DOUBLE) AS growth_rate,
               CAST((c_custkey * 37) % 100 AS DOUBLE) / 100 AS infra_risk_score
        FROM customer WHERE c_custkey IN (SELECT user_id FROM events)""",
    "daily_usage": """
        SELECT MIN(event_id) AS log_id, dt AS "date", user_id AS company_id,
               CAST(SUM(cents) AS BIGINT) AS input_tokens,
               CAST(COALESCE(SUM(cents) FILTER (WHERE event_type IN ('view', 'click')), 0) AS BIGINT) AS output_tokens,
               CAST(COALESCE(SUM(cents) FILTER (WHERE event_type = 'view'), 0) AS BIGINT) AS prompt_cached_tokens,
               CAST(SUM(k) * 8 AS DOUBLE) / COUNT(*) AS avg_ttft_ms,
               CAST(MAX(k) AS DOUBLE) / 100 AS max_context_saturation_pct
        FROM ev GROUP BY dt, user_id""",
    "api_errors": """
        SELECT event_id AS error_id, ts AS "timestamp", user_id AS company_id,
               CASE k % 4 WHEN 0 THEN 429 WHEN 1 THEN 500 WHEN 2 THEN 503 ELSE 400 END AS error_code,
               CASE WHEN k < 50 THEN '/v1/messages' ELSE '/v1/embeddings' END AS endpoint
        FROM ev WHERE event_type = 'error'""",
    "staged": f"""
        SELECT log_id, "date" AS usage_date, company_id, company_name, industry, contract_tier, signup_date,
               growth_rate, infra_risk_score,
               CAST(input_tokens AS INTEGER) AS input_tokens, CAST(output_tokens AS INTEGER) AS output_tokens,
               CAST(prompt_cached_tokens AS INTEGER) AS prompt_cached_tokens,
               input_tokens + output_tokens AS total_tokens,
               {rnd('CAST(prompt_cached_tokens AS DOUBLE) / NULLIF(input_tokens, 0)', 4)} AS prompt_cache_ratio,
               {rnd('avg_ttft_ms', 2)} AS avg_ttft_ms,
               {rnd('max_context_saturation_pct', 4)} AS max_context_saturation_pct,
               date_diff('day', signup_date, "date") < 14 AS is_onboarding_window,
               CAST(date_diff('day', signup_date, "date") AS INTEGER) AS day_since_signup
        FROM daily_usage JOIN companies USING (company_id)""",
    "lagged": """
        SELECT *, AVG(total_tokens) OVER (by_day ROWS 6 PRECEDING) AS mean7,
               LAG(total_tokens) OVER by_day AS prev_day_tokens,
               LAG(total_tokens, 7) OVER by_day AS tokens_7d_ago
        FROM staged WINDOW by_day AS (PARTITION BY company_id ORDER BY usage_date)""",
    "velocity": f"""
        SELECT * EXCLUDE (mean7, prev_day_tokens, tokens_7d_ago), {rnd('mean7', 0)} AS rolling_7d_avg_tokens,
               total_tokens - prev_day_tokens AS dod_token_delta,
               {rnd('CAST(total_tokens - prev_day_tokens AS DOUBLE) / NULLIF(prev_day_tokens, 0) * 100', 2)}
                   AS dod_pct_change,
               {rnd('CAST(total_tokens - tokens_7d_ago AS DOUBLE) / NULLIF(tokens_7d_ago, 0) * 100', 2)}
                   AS wow_pct_change
        FROM lagged""",
    "ob_usage": f"""
        SELECT company_id, company_name, industry, contract_tier, infra_risk_score, growth_rate, signup_date,
               COUNT(*) AS onboarding_days_active, AVG(total_tokens) AS avg_daily_tokens_onboarding,
               MAX(total_tokens) AS max_daily_tokens_onboarding,
               {mean('avg_ttft_ms', 2)} AS avg_ttft_ms_onboarding, MAX(avg_ttft_ms) AS max_ttft_ms_onboarding,
               {mean('max_context_saturation_pct', 4)} AS avg_context_saturation_onboarding,
               MAX(max_context_saturation_pct) AS max_context_saturation_onboarding,
               {mean('prompt_cache_ratio', 4)} AS avg_cache_ratio_onboarding,
               MIN(usage_date) AS first_usage_date, MAX(usage_date) AS last_onboarding_date
        FROM staged WHERE is_onboarding_window GROUP BY ALL""",
    "ob_errors": """
        SELECT e.company_id, CAST(e."timestamp" AS DATE) AS error_date, e.error_code, COUNT(*) AS error_count
        FROM api_errors e JOIN companies c USING (company_id)
        WHERE date_diff('day', c.signup_date, CAST(e."timestamp" AS DATE)) <= 13 GROUP BY ALL""",
    "ob_codes": f"""
        SELECT company_id, {CODE_COUNTS}, CAST(SUM(error_count) AS BIGINT) AS total_errors_onboarding
        FROM ob_errors GROUP BY company_id""",
    "friction": f"""
        SELECT u.*, {', '.join(f'COALESCE(count_{c}_onboarding, 0) AS count_{c}_onboarding' for c in CODES)},
               COALESCE(total_errors_onboarding, 0) AS total_errors_onboarding,
               infra_risk_score >= 0.55 AS is_treatment,
               CASE WHEN infra_risk_score < 0.55 THEN 'None'
                    WHEN avg_ttft_ms_onboarding >= 400 THEN 'Severe' ELSE 'Mild' END AS friction_bucket
        FROM ob_usage u LEFT JOIN ob_codes USING (company_id)""",
    "weeks": """
        SELECT company_id, CAST(FLOOR(day_since_signup / 7.0) AS INTEGER) AS week_num,
               AVG(rolling_7d_avg_tokens) AS avg_weekly_tokens, MIN(usage_date) AS week_start_date
        FROM velocity GROUP BY ALL""",
    "weeks2": """
        SELECT *, MAX(avg_weekly_tokens) OVER (PARTITION BY company_id) AS peak_weekly_tokens,
               LAG(avg_weekly_tokens) OVER (PARTITION BY company_id ORDER BY week_num) AS prev_week_tokens
        FROM weeks""",
    "cohort": f"""
        SELECT company_id, week_num, week_start_date, {rnd('avg_weekly_tokens', 0)} AS avg_weekly_tokens,
               {rnd('peak_weekly_tokens', 0)} AS peak_weekly_tokens,
               {rnd('avg_weekly_tokens / NULLIF(peak_weekly_tokens, 0)', 4)} AS retention_vs_peak,
               {rnd('avg_weekly_tokens / NULLIF(prev_week_tokens, 0)', 4)} AS wow_retention_rate,
               COALESCE(avg_weekly_tokens = peak_weekly_tokens, FALSE) AS is_peak_week
        FROM weeks2""",
    "peaks": """
        SELECT company_id, MAX(rolling_7d_avg_tokens) AS peak_rolling_avg,
               arg_max(usage_date, (rolling_7d_avg_tokens, -epoch(usage_date))) AS peak_date
        FROM velocity GROUP BY company_id""",
    "after_peak": """
        SELECT v.company_id, v.usage_date, v.rolling_7d_avg_tokens, p.peak_rolling_avg, p.peak_date
        FROM velocity v JOIN peaks p ON p.company_id = v.company_id AND v.usage_date > p.peak_date""",
    "onsets": """
        SELECT company_id, MAX(peak_rolling_avg) AS peak_rolling_avg,
               MIN(usage_date) FILTER (WHERE peak_rolling_avg > 0
                   AND rolling_7d_avg_tokens <= peak_rolling_avg * CAST(0.2 AS DOUBLE)) AS hard_churn_date,
               MIN(usage_date) FILTER (WHERE peak_rolling_avg > 0
                   AND rolling_7d_avg_tokens <= peak_rolling_avg * CAST(0.6 AS DOUBLE)) AS soft_decay_date
        FROM after_peak GROUP BY company_id""",
    "churn_wide": f"""
        SELECT f.*, NOT is_treatment AS is_control, {rnd('p.peak_rolling_avg', 0)} AS peak_rolling_avg_tokens,
               p.peak_date,
               hard_churn_date IS NOT NULL AS hard_churn_label, soft_decay_date IS NOT NULL AS soft_decay_label,
               CAST(COALESCE(date_diff('day', signup_date, hard_churn_date), {HORIZON}) AS INTEGER)
                   AS days_to_hard_churn,
               CAST(COALESCE(date_diff('day', signup_date, soft_decay_date), {HORIZON}) AS INTEGER)
                   AS days_to_soft_decay,
               CAST(hard_churn_date IS NOT NULL AS INTEGER) AS hard_churn_observed,
               CAST(soft_decay_date IS NOT NULL AS INTEGER) AS soft_decay_observed
        FROM friction f LEFT JOIN peaks p USING (company_id) LEFT JOIN onsets o USING (company_id)""",
    "churn": """
        SELECT company_id, company_name, industry, contract_tier, signup_date, infra_risk_score, growth_rate,
               friction_bucket, avg_daily_tokens_onboarding, avg_ttft_ms_onboarding, max_ttft_ms_onboarding,
               avg_context_saturation_onboarding, max_context_saturation_onboarding, avg_cache_ratio_onboarding,
               count_429_onboarding, count_500_onboarding, count_503_onboarding, total_errors_onboarding,
               is_treatment, is_control, peak_rolling_avg_tokens, peak_date, hard_churn_label, soft_decay_label,
               days_to_hard_churn, days_to_soft_decay, hard_churn_observed, soft_decay_observed
        FROM churn_wide""",
    "trends_raw": f"""
        SELECT company_id,
               AVG(total_tokens) FILTER (WHERE day_since_signup BETWEEN 0 AND 13) AS t1,
               AVG(total_tokens) FILTER (WHERE day_since_signup BETWEEN 14 AND 29) AS t2,
               AVG(total_tokens) FILTER (WHERE day_since_signup BETWEEN 30 AND 59) AS t3,
               {mean('avg_ttft_ms', 2, 'day_since_signup BETWEEN 0 AND 13')} AS ttft_mean,
               MAX(avg_ttft_ms) FILTER (WHERE day_since_signup BETWEEN 0 AND 13) AS ttft_max,
               {mean('prompt_cache_ratio', 4, 'day_since_signup BETWEEN 0 AND 13')} AS cache1,
               {mean('prompt_cache_ratio', 4, 'day_since_signup BETWEEN 14 AND 29')} AS cache2,
               {mean('max_context_saturation_pct', 4, 'day_since_signup BETWEEN 0 AND 13')} AS ctx_mean,
               MAX(max_context_saturation_pct) FILTER (WHERE day_since_signup BETWEEN 0 AND 13) AS ctx_max,
               {mean('wow_pct_change', 2, 'day_since_signup BETWEEN 7 AND 13')} AS wow2
        FROM velocity GROUP BY company_id""",
    "trends": f"""
        SELECT company_id, {rnd('t1', 0)} AS avg_tokens_days_0_14, {rnd('t2', 0)} AS avg_tokens_days_15_30,
               {rnd('t3', 0)} AS avg_tokens_days_31_60, {rnd('ttft_mean', 2)} AS avg_ttft_days_0_14,
               {rnd('ttft_max', 2)} AS max_ttft_days_0_14, {rnd('cache1', 4)} AS avg_cache_ratio_0_14,
               {rnd('cache2', 4)} AS avg_cache_ratio_15_30, {rnd('ctx_mean', 4)} AS avg_ctx_sat_0_14,
               {rnd('ctx_max', 4)} AS max_ctx_sat_0_14, {rnd('wow2', 2)} AS avg_wow_pct_change_week2
        FROM trends_raw""",
    "slope_sums": """
        SELECT company_id, COUNT(*) AS n, SUM(day_since_signup) AS sx, SUM(total_tokens) AS sy,
               SUM(day_since_signup * total_tokens) AS sxy, SUM(day_since_signup * day_since_signup) AS sxx
        FROM staged WHERE day_since_signup BETWEEN 0 AND 13 GROUP BY company_id""",
    "slopes": """
        SELECT company_id, CAST(n * sxy - sx * sy AS DOUBLE) / NULLIF(CAST(n * sxx - sx * sx AS DOUBLE), 0) AS slope
        FROM slope_sums""",
    "features": f"""
        SELECT company_id, company_name, industry, contract_tier, signup_date, infra_risk_score, growth_rate,
               friction_bucket, is_treatment, hard_churn_label, soft_decay_label, days_to_hard_churn,
               days_to_soft_decay, hard_churn_observed, soft_decay_observed, peak_rolling_avg_tokens,
               count_429_onboarding, count_500_onboarding, count_503_onboarding, total_errors_onboarding,
               avg_ttft_ms_onboarding, max_ttft_ms_onboarding, avg_context_saturation_onboarding,
               max_context_saturation_onboarding, avg_cache_ratio_onboarding,
               t.* EXCLUDE (company_id), {rnd('slope', 2)} AS token_growth_slope_onboarding,
               {rnd('t2 / NULLIF(t1, 0)', 4)} AS token_momentum_w2_vs_w1
        FROM churn_wide LEFT JOIN trends t USING (company_id) LEFT JOIN trends_raw USING (company_id)
             LEFT JOIN slopes USING (company_id)""",
    "matrix": "SELECT * REPLACE ("
    + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in NUMERIC_FEATURES)
    + ") FROM features",
    "scored": f"""
        SELECT company_id, company_name, industry, contract_tier, friction_bucket,
               CAST((company_id * 7919) % 100 AS DOUBLE) / 100 AS churn_probability,
               CASE WHEN (company_id * 7919) % 100 <= 50 THEN 'Low' WHEN (company_id * 7919) % 100 <= 75 THEN 'Medium'
                    WHEN (company_id * 7919) % 100 <= 85 THEN 'High' ELSE 'Critical' END AS risk_tier,
               {rule_case('trigger')} AS top_friction_trigger, {rule_case('action')} AS recommended_action,
               {rule_case('owner')} AS action_owner, CAST(hard_churn_label AS INTEGER) AS hard_churn_label,
               days_to_hard_churn, count_429_onboarding, avg_ttft_ms_onboarding, avg_cache_ratio_onboarding,
               max_context_saturation_onboarding, avg_tokens_days_0_14, token_growth_slope_onboarding
        FROM features""",
    "bucketed": f"""
        SELECT s.company_id, s.usage_date, c.friction_bucket, s.total_tokens, s.day_since_signup, {DAY_BIN} AS day_bin
        FROM staged s JOIN churn c USING (company_id)""",
    "buckets": "SELECT * FROM (VALUES (0, 'Severe'), (1, 'Mild'), (2, 'None')) b(row_no, friction_bucket)",
    "heat": "SELECT row_no, friction_bucket, "
    + ", ".join(
        f"AVG(total_tokens) FILTER (WHERE day_bin = {quote(label)}) AS {name}"
        for label, name in zip(B.DAY_BIN_LABELS, BIN_NAMES)
    )
    + " FROM buckets LEFT JOIN bucketed USING (friction_bucket) GROUP BY row_no, friction_bucket",
    "relative_days": """
        SELECT s.company_id, s.usage_date, s.total_tokens,
               CAST(s.signup_date + c.days_to_hard_churn AS DATE) AS churn_onset_date,
               CAST(date_diff('day', CAST(s.signup_date + c.days_to_hard_churn AS DATE), s.usage_date) AS INTEGER)
                   AS days_to_onset
        FROM staged s JOIN churn c USING (company_id) WHERE c.hard_churn_label""",
    "units": """
        SELECT company_id, is_treatment, CAST((company_id * 7919) % 1000 AS DOUBLE) / 1000 AS ps FROM churn""",
    "queue": """
        SELECT ROW_NUMBER() OVER (ORDER BY ps, company_id) AS turn, company_id, ps FROM units WHERE is_treatment""",
    "pool": """
        SELECT list({'id': company_id, 'ps': ps}) FILTER (WHERE NOT is_treatment) AS members,
               CAST(0.05 AS DOUBLE) * stddev_samp(ps) AS caliper FROM units""",
    "greedy": """
        SELECT CAST(0 AS BIGINT) AS turn, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS t_id,
               CAST(NULL AS DOUBLE) AS t_ps,
               CAST(NULL AS STRUCT(gap DOUBLE, id BIGINT, ps DOUBLE)) AS pick
        UNION ALL
        SELECT turn, CASE WHEN pick IS NULL THEN used ELSE list_append(used, pick.id) END, t_id, t_ps, pick
        FROM (SELECT q.turn, g.used, q.company_id AS t_id, q.ps AS t_ps,
                     list_min(list_filter(list_transform(list_filter(p.members, lambda m: NOT list_contains(g.used, m.id)),
                         lambda m: {'gap': abs(m.ps - q.ps), 'id': m.id, 'ps': m.ps}),
                         lambda m: m.gap <= p.caliper)) AS pick
              FROM greedy g JOIN queue q ON q.turn = g.turn + 1 CROSS JOIN pool p)""",
    "pairs": """
        SELECT t_id AS treatment_company_id, pick.id AS control_company_id, t_ps AS treatment_ps,
               pick.ps AS control_ps, pick.gap AS ps_diff
        FROM greedy WHERE pick IS NOT NULL""",
    "matched": """
        SELECT company_id, days_to_hard_churn, hard_churn_observed, days_to_soft_decay, soft_decay_observed,
               is_treatment
        FROM churn WHERE company_id IN (SELECT treatment_company_id FROM pairs UNION ALL
                                        SELECT control_company_id FROM pairs)""",
    "covariates": "SELECT company_id, is_treatment, CAST(contract_tier = 'Enterprise' AS INTEGER)::DOUBLE AS is_enterprise,"
    " ln(1 + COALESCE(avg_tokens_days_0_14, 0)) AS log_avg_tokens_onboarding, growth_rate, "
    + ", ".join(f"CAST(industry = '{v}' AS INTEGER)::DOUBLE AS ind_{v.lower()}" for v in LEVELS)
    + " FROM features",
    "stressed": f"""
        SELECT *, {risk('avg_ttft_ms_onboarding', 'count_429_onboarding')} AS baseline_risk FROM matrix""",
    "scenario_list": "SELECT * FROM (VALUES "
    + ", ".join(
        f"({n}, {quote(s.name)}, CAST({s.ttft_mult} AS DOUBLE), CAST({s.rl_red} AS DOUBLE))"
        for n, s in enumerate(SCENARIOS)
    )
    + ") s(scenario_no, scenario, ttft_mult, rl_red)",
    "outcomes": f"""
        SELECT *, {risk('avg_ttft_ms_onboarding * ttft_mult', 'count_429_onboarding * (1 - rl_red)')} AS new_risk
        FROM stressed, scenario_list""",
    "halved": f"""
        SELECT *, {risk('avg_ttft_ms_onboarding * CAST(0.5 AS DOUBLE)', 'count_429_onboarding')} AS new_risk
        FROM stressed""",
    "by_score": """
        SELECT churn_probability AS threshold, SUM(hard_churn_label) AS pos, SUM(1 - hard_churn_label) AS neg
        FROM scored GROUP BY 1""",
    "ladder": """
        SELECT threshold, pos, neg, SUM(pos) OVER down AS tp, SUM(neg) OVER down AS fp,
               SUM(neg) OVER up - neg AS neg_below, SUM(pos) OVER () AS all_pos, SUM(neg) OVER () AS all_neg
        FROM by_score WINDOW down AS (ORDER BY threshold DESC), up AS (ORDER BY threshold)""",
}


def survival_relations(kind: str, source: str = "churn") -> dict[str, str]:
    days, seen = {
        "hard": ("days_to_hard_churn", "hard_churn_observed"),
        "soft": ("days_to_soft_decay", "soft_decay_observed"),
    }[kind.removeprefix("matched_")]
    return {
        f"times_{kind}": f"SELECT is_treatment AS grp, {days} AS t, {seen} AS seen FROM {source}",
        f"points_{kind}": f"SELECT grp, t FROM times_{kind} UNION SELECT grp, 0 FROM times_{kind}",
        # Counted straight from the accounts for every time point.
        f"risk_{kind}": f"""
            SELECT p.grp, p.t, COUNT(*) FILTER (WHERE x.t >= p.t) AS at_risk,
                   COUNT(*) FILTER (WHERE x.t = p.t AND x.seen = 1) AS events,
                   COUNT(*) FILTER (WHERE x.t = p.t AND x.seen = 0) AS censored
            FROM points_{kind} p JOIN times_{kind} x USING (grp) GROUP BY ALL""",
        f"curve_{kind}": f"""
            SELECT *, product(1 - CAST(events AS DOUBLE) / at_risk) OVER (PARTITION BY grp ORDER BY t) AS survival,
                   SUM(CASE WHEN at_risk > events THEN CAST(events AS DOUBLE) / (CAST(at_risk AS DOUBLE) * (at_risk - events))
                       ELSE 0 END) OVER (PARTITION BY grp ORDER BY t) AS spread
            FROM risk_{kind}""",
        f"moments_{kind}": f"""
            SELECT e.t, COUNT(*) FILTER (WHERE x.t >= e.t)::DOUBLE AS n,
                   COUNT(*) FILTER (WHERE x.t >= e.t AND x.grp)::DOUBLE AS n1,
                   COUNT(*) FILTER (WHERE x.t = e.t AND x.seen = 1)::DOUBLE AS d,
                   COUNT(*) FILTER (WHERE x.t = e.t AND x.seen = 1 AND x.grp)::DOUBLE AS d1
            FROM (SELECT DISTINCT t FROM times_{kind} WHERE seen = 1) e, times_{kind} x GROUP BY e.t""",
        f"test_{kind}": f"""
            SELECT CAST(SUM(d1) AS BIGINT) AS observed, SUM(d * n1 / n) AS expected,
                   SUM(CASE WHEN n > 1 THEN d * (n1 / n) * (1 - n1 / n) * (n - d) / (n - 1) ELSE 0 END) AS variance
            FROM moments_{kind}""",
        f"chi_{kind}": f"SELECT *, (observed - expected) ** 2 / NULLIF(variance, 0) AS chi2 FROM test_{kind}",
    }


RELATIONS.update(survival_relations("hard"))
RELATIONS.update(survival_relations("soft"))
RELATIONS.update(survival_relations("matched_hard", "matched"))
RELATIONS.update(survival_relations("matched_soft", "matched"))
RELATIONS["loudest"] = "SELECT company_id FROM api_errors GROUP BY company_id ORDER BY COUNT(*) DESC, company_id LIMIT 1"
# Three months of usage: a third of the events one month later, a third two.
LATER = {
    "ev": RELATIONS["ev"].replace("ts, CAST(ts AS DATE) AS dt", "later AS ts, CAST(later AS DATE) AS dt").replace(
        "FROM events", "FROM (SELECT *, ts + to_days(CAST(event_id % 3 * 30 AS INTEGER)) AS later FROM events)"
    ),
    "churn_wide": RELATIONS["churn_wide"].replace(f", {HORIZON}) AS INTEGER)", ", 90) AS INTEGER)"),
}
RECURSIVE = {"greedy"}
WORDS = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def with_relations(body: str, instead: dict[str, str] | None = None) -> str:
    """Put the relations that ``body`` uses, directly or not, in front of it; those in ``instead`` differ."""
    relations = RELATIONS | (instead or {})
    wanted: set[str] = set()
    pending = [body]
    while pending:
        for word in set(WORDS.findall(pending.pop())) & set(relations) - wanted:
            wanted.add(word)
            pending.append(relations[word])
    if not wanted:
        return body
    ctes = ",\n".join(f"{name} AS ({relations[name]})" for name in relations if name in wanted)
    return f"WITH {'RECURSIVE ' if wanted & RECURSIVE else ''}{ctes}\n{body}"


def histogram(source: str, value: str, bins: int) -> str:
    return f"""
        SELECT CAST(b AS INTEGER) AS bin, COUNT(v) AS n
        FROM range(0, {bins}) r(b) LEFT JOIN (
            SELECT {value} AS v, LEAST(FLOOR({value} / (CAST(1 AS DOUBLE) / {bins})), {bins - 1}) AS place FROM {source}) x
            ON x.place = r.b GROUP BY b"""


def check(name: str, expression: str, source: str) -> str:
    return f"SELECT {quote(name)} AS name, CAST({expression} AS BIGINT) AS violations FROM {source}"


CHECKS = {
    "check_unique_company": check(
        "No duplicate company_id in fct_cohort_churn", "COUNT(*) - COUNT(DISTINCT company_id)", "churn"
    ),
    "check_exclusive_groups": check(
        "Treatment/control mutually exclusive", "COUNT(*) FILTER (WHERE is_treatment AND is_control)", "churn"
    ),
    "check_rowcount": check(
        "fct_account_features row count matches companies",
        "ABS(COUNT(*) - (SELECT COUNT(*) FROM companies))",
        "features",
    ),
    "check_not_null": check(
        "No nulls in hard_churn_label", "COUNT(*) FILTER (WHERE hard_churn_label IS NULL)", "churn"
    ),
    "check_unique_company_day": check(
        "daily_usage company x date uniqueness", 'COUNT(*) - COUNT(DISTINCT (company_id, "date"))', "daily_usage"
    ),
    "orphan_check": check(
        "daily_usage orphan company_ids",
        "COUNT(DISTINCT company_id) FILTER (WHERE company_id NOT IN (SELECT company_id FROM companies))",
        "daily_usage",
    ),
}

COVARIATES = ["is_enterprise", "log_avg_tokens_onboarding", "growth_rate", *[f"ind_{v.lower()}" for v in LEVELS]]
COVARIATE_LABELS = [*COVARIATES[:3], *[f"ind_{v}" for v in LEVELS]]


def smd_sql(column: str, source: str = "covariates") -> str:
    return f"""(SELECT CASE WHEN pooled > 0 THEN abs(m1 - m0) / pooled ELSE 0 END FROM (
        SELECT AVG({column}) FILTER (WHERE is_treatment) AS m1, AVG({column}) FILTER (WHERE NOT is_treatment) AS m0,
               sqrt((var_samp({column}) FILTER (WHERE is_treatment)
                     + var_samp({column}) FILTER (WHERE NOT is_treatment)) / 2) AS pooled FROM {source}))"""


MATCHED_COVARIATES = "(SELECT * FROM covariates WHERE company_id IN (SELECT company_id FROM matched))"


def percent(part: str, whole: str = "COUNT(*)", digits: int = 1) -> str:
    return rnd(f"CAST({part} AS DOUBLE) / NULLIF({whole}, 0) * 100", digits)


def chi_tail(kind: str) -> str:
    """Upper tail of chi-square with one degree of freedom by an all-positive series."""
    x = "sqrt(chi2 / 2)"
    term = f"exp(2 * n * ln(2) + (2 * n + 1) * ln({x}) + lgamma(n + 1) - lgamma(2 * n + 2))"
    series = f"list_sum(list_transform(range(0, 400), lambda n: {term}))"
    p = f"CASE WHEN chi2 = 0 THEN 1 ELSE 1 - 2 / sqrt(pi()) * exp(-chi2 / 2) * {series} END"
    return f"""
        SELECT observed, {rnd('expected')} AS expected, {rnd('variance')} AS variance, {rnd('chi2')} AS chi2,
               {rnd(p)} AS p_value, ({p}) < 0.05 AS is_significant FROM chi_{kind}"""


def survival_queries(kind: str) -> dict[str, str]:
    z = "CAST(1.959963984540054 AS DOUBLE)"

    def bound(sign: str) -> str:
        inner = f"exp(-exp(ln(-ln(survival)) {sign} {z} * sqrt(spread) / -ln(survival)))"
        return f"CASE WHEN survival >= 1 THEN 1 WHEN survival > 0 THEN {rnd(inner)} END"

    return {
        f"km_curve_{kind}": f"SELECT grp, t, at_risk, events, censored, {rnd('survival')} AS survival FROM curve_{kind}",
        f"km_confidence_{kind}": f"SELECT grp, t, {rnd('survival')} AS survival, {bound('+')} AS lower_95,"
        f" {bound('-')} AS upper_95 FROM curve_{kind}",
        f"km_median_{kind}": "SELECT grp, MIN(t) FILTER (WHERE survival <= 0.5 + 1e-12) AS median_days"
        f" FROM curve_{kind} GROUP BY grp",
        f"logrank_test_{kind}": chi_tail(kind),
    }


def class_line(name: str, hit: str, wrong: str, missed: str) -> str:
    return f"""SELECT {quote(name)} AS class, COALESCE({hit} / NULLIF({hit} + {wrong}, 0), 0) AS p,
        COALESCE({hit} / NULLIF({hit} + {missed}, 0), 0) AS r,
        COALESCE(2 * {hit} / NULLIF(2 * {hit} + {wrong} + {missed}, 0), 0) AS f, {hit} + {missed} AS support FROM cm"""


RELATIONS["cm"] = """
    SELECT COUNT(*) FILTER (WHERE hard_churn_label = 0 AND churn_probability < 0.5)::DOUBLE AS tn,
           COUNT(*) FILTER (WHERE hard_churn_label = 0 AND churn_probability >= 0.5)::DOUBLE AS fp,
           COUNT(*) FILTER (WHERE hard_churn_label = 1 AND churn_probability < 0.5)::DOUBLE AS fn,
           COUNT(*) FILTER (WHERE hard_churn_label = 1 AND churn_probability >= 0.5)::DOUBLE AS tp FROM scored"""
RELATIONS["per_class"] = f"{class_line('No Churn', 'tn', 'fn', 'fp')} UNION ALL {class_line('Churn', 'tp', 'fp', 'fn')}"
REPORT = f"""
    SELECT class, {rnd('p')} AS precision, {rnd('r')} AS recall, {rnd('f')} AS f1, CAST(support AS BIGINT) AS support
    FROM (SELECT * FROM per_class
          UNION ALL SELECT 'accuracy', a, a, a, n
          FROM (SELECT (tn + tp) / (tn + fp + fn + tp) AS a, tn + fp + fn + tp AS n FROM cm)
          UNION ALL SELECT 'macro avg', AVG(p), AVG(r), AVG(f), SUM(support) FROM per_class
          UNION ALL SELECT 'weighted avg', SUM(p * support) / SUM(support), SUM(r * support) / SUM(support),
                           SUM(f * support) / SUM(support), SUM(support) FROM per_class)"""


SAVED = "baseline_risk >= 0.75 AND new_risk < 0.75"
MODEL_NAMES = {
    "stg_daily_usage": "staged",
    "int_usage_velocity": "velocity",
    "int_friction_flags": "friction",
    "int_cohort_health": "cohort",
    "fct_cohort_churn": "churn",
    "fct_account_features": "features",
}

BODIES: dict[str, str] = {
    "read_source": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "read_dated": "SELECT company_id, signup_date, peak_date, friction_bucket, is_treatment, days_to_hard_churn FROM churn",
    "require_sources": "SELECT 'customer' AS source, COUNT(*) AS row_count FROM customer"
    " UNION ALL SELECT 'events', COUNT(*) FROM events",
    "register_model": "SELECT industry, COUNT(*) AS n, CAST(SUM(total_tokens) AS BIGINT) AS tokens FROM staged GROUP BY industry",
    "persist_model": " UNION ALL ".join(
        f"SELECT '{name}' AS model, {name not in ('int_usage_velocity', 'int_friction_flags')} AS persisted,"
        f" COUNT(*) AS row_count FROM {relation}"
        for name, relation in MODEL_NAMES.items()
    ),
    "write_results": "SELECT 'psm_matched_cohort' AS result, COUNT(*) AS row_count FROM matched"
    " UNION ALL SELECT 'scored_accounts', COUNT(*) FROM scored"
    " UNION ALL SELECT 'counterfactual_scenarios', COUNT(*) FROM scenario_list",
    "cache_model": "SELECT contract_tier, COUNT(*) AS n FROM features GROUP BY contract_tier",
    "cache_ratio": f"SELECT log_id, {rnd('CAST(prompt_cached_tokens AS DOUBLE) / NULLIF(input_tokens, 0)', 4)} AS r FROM daily_usage",
    "onboarding_flag": "SELECT log_id, is_onboarding_window FROM staged",
    "day_since_signup": "SELECT log_id, day_since_signup FROM staged",
    "pct_change": "SELECT log_id, dod_token_delta, dod_pct_change, wow_pct_change FROM velocity",
    "treatment_flag": "SELECT company_id, infra_risk_score >= 0.55 AS is_treatment FROM companies",
    "friction_bucket": "SELECT company_id, friction_bucket FROM friction",
    "control_flag": "SELECT company_id, is_control FROM churn",
    "retention_ratios": "SELECT company_id, week_num, retention_vs_peak, wow_retention_rate FROM cohort",
    "peak_week_flag": "SELECT company_id, week_num, is_peak_week FROM cohort",
    "churn_labels": "SELECT company_id, hard_churn_label, soft_decay_label, days_to_hard_churn, days_to_soft_decay,"
    " hard_churn_observed, soft_decay_observed FROM churn",
    "momentum_ratio": "SELECT company_id, token_momentum_w2_vs_w1 FROM features",
    "null_to_zero": f"SELECT company_id, {', '.join(NUMERIC_FEATURES)} FROM matrix",
    "day_bin": f"SELECT log_id, {DAY_BIN} AS day_bin FROM staged",
    "risk_tier": "SELECT company_id, risk_tier FROM scored",
    "prescribe": "SELECT company_id, top_friction_trigger, recommended_action, action_owner FROM scored",
    "arr_value": f"SELECT company_id, CAST({tier_value()} AS BIGINT) AS arr_value FROM companies",
    "perturb_features": "SELECT company_id, "
    + ", ".join(
        f"{rnd(c + ' * CAST(0.75 AS DOUBLE)')} AS {c}"
        for c in ("avg_ttft_ms_onboarding", "max_ttft_ms_onboarding", "avg_ttft_days_0_14", "max_ttft_days_0_14")
    )
    + ", count_429_onboarding * CAST(0.5 AS DOUBLE) AS count_429_onboarding, count_500_onboarding FROM matrix",
    "alert_feed": "SELECT company_id, company_name, contract_tier, industry, churn_probability, top_friction_trigger,"
    " recommended_action, action_owner, count_429_onboarding, avg_ttft_ms_onboarding FROM scored"
    " WHERE churn_probability >= 0.75",
    "format_display": """
        SELECT company_id, company_name, contract_tier, industry,
               CASE WHEN churn_probability >= 0.85 THEN '🔴' WHEN churn_probability >= 0.75 THEN '🟠' ELSE '🟡' END
                   || ' ' || printf('%.2f', churn_probability) AS risk_score,
               top_friction_trigger, recommended_action, action_owner, count_429_onboarding AS count_429,
               CAST(round_even(avg_ttft_ms_onboarding, 0) AS BIGINT)::VARCHAR || ' ms' AS avg_ttft,
               CASE contract_tier WHEN 'Enterprise' THEN '$120,000' WHEN 'Growth' THEN '$24,000' END AS arr
        FROM scored""",
    "account_usage": "SELECT company_id, usage_date, day_since_signup, total_tokens, avg_ttft_ms FROM staged",
    "account_errors": 'SELECT error_id, "timestamp", company_id, error_code, endpoint FROM api_errors',
    "account_card": """
        SELECT s.company_id, s.company_name, s.contract_tier, s.industry,
               printf('%.2f', churn_probability) AS churn_risk,
               CASE WHEN churn_probability >= 0.85 THEN 'Critical' WHEN churn_probability >= 0.75 THEN 'High'
                    ELSE 'Medium' END AS risk_level,
               s.friction_bucket, top_friction_trigger, recommended_action, action_owner,
               f.count_429_onboarding AS signal_429,
               CAST(round_even(f.avg_ttft_ms_onboarding, 0) AS BIGINT)::VARCHAR || ' ms' AS signal_ttft,
               CAST(round_even(f.max_context_saturation_onboarding * 100, 0) AS BIGINT)::VARCHAR || '%' AS signal_context,
               CAST(round_even(f.avg_cache_ratio_onboarding * 100, 0) AS BIGINT)::VARCHAR || '%' AS signal_cache,
               CASE WHEN f.token_growth_slope_onboarding < 0 THEN '-' ELSE '+' END
                   || CAST(abs(round_even(f.token_growth_slope_onboarding, 0)) AS BIGINT)::VARCHAR AS signal_slope
        FROM scored s LEFT JOIN features f USING (company_id)""",
    "account_directory": "SELECT company_id, churn_probability, company_name || '  (' || printf('%.2f', churn_probability)"
    " || ' risk · ' || contract_tier || ')' AS label FROM scored",
    "usage_join_company": "SELECT log_id, company_id, company_name, industry, contract_tier FROM staged",
    "errors_join_signup": """
        SELECT e.error_id, e.company_id, CAST(e."timestamp" AS DATE) AS error_date, e.error_code, c.signup_date
        FROM api_errors e JOIN companies c USING (company_id)
        WHERE CAST(e."timestamp" AS DATE) <= c.signup_date + 13""",
    "friction_join_errors": "SELECT company_id, onboarding_days_active, "
    + ", ".join(f"count_{c}_onboarding" for c in CODES)
    + ", total_errors_onboarding FROM friction",
    "first_peak_date": "SELECT company_id, peak_rolling_avg, peak_date FROM peaks",
    "post_peak_scan": "SELECT company_id, usage_date, rolling_7d_avg_tokens, peak_rolling_avg, peak_date FROM after_peak",
    "usage_join_onset": "SELECT company_id, usage_date, total_tokens, churn_onset_date, days_to_onset FROM relative_days",
    "usage_join_bucket": "SELECT company_id, usage_date, friction_bucket, total_tokens, day_since_signup, day_bin FROM bucketed",
    "errors_join_signup_day": """
        SELECT error_id, e.company_id, error_code,
               CAST(date_diff('day', signup_date, CAST("timestamp" AS DATE)) AS INTEGER) AS day_since_signup
        FROM api_errors e JOIN (SELECT DISTINCT company_id, signup_date FROM staged) USING (company_id)""",
    "group_semi_join": "SELECT log_id, company_id FROM staged"
    " WHERE company_id IN (SELECT company_id FROM churn WHERE is_treatment)",
    "caliper_match": "SELECT * FROM pairs",
    "scenario_cross": f"""
        SELECT company_id, scenario, {rnd('avg_ttft_ms_onboarding * ttft_mult')} AS avg_ttft_ms_onboarding,
               {rnd('max_ttft_days_0_14 * ttft_mult')} AS max_ttft_days_0_14,
               count_429_onboarding * (1 - rl_red) AS count_429_onboarding
        FROM matrix, scenario_list""",
    "onboarding_usage": "SELECT * FROM ob_usage",
    "onboarding_errors": "SELECT * FROM ob_errors",
    "error_pivot": "SELECT * FROM ob_codes",
    "weekly_tokens": f"SELECT * REPLACE ({rnd('avg_weekly_tokens')} AS avg_weekly_tokens) FROM weeks",
    "peak_per_company": "SELECT company_id, MAX(rolling_7d_avg_tokens) AS peak_rolling_avg FROM velocity GROUP BY company_id",
    "churn_onset": "SELECT * FROM onsets",
    "velocity_trends": "SELECT * FROM trends",
    "growth_slope": f"""
        SELECT company_id, CASE WHEN COUNT(*) > 1 THEN {rnd('REGR_SLOPE(total_tokens, day_since_signup)')} END
                   AS token_growth_slope_onboarding
        FROM velocity WHERE day_since_signup BETWEEN 0 AND 13 GROUP BY company_id""",
    "churn_by_group": f"""
        SELECT CASE WHEN is_treatment THEN 'Treatment' ELSE 'Control' END AS grp, COUNT(*) AS n,
               COUNT(*) FILTER (WHERE hard_churn_label) AS churned,
               {percent('COUNT(*) FILTER (WHERE hard_churn_label)')} AS churn_pct
        FROM churn GROUP BY 1""",
    "cohort_overview": f"""
        SELECT COUNT(*) AS n_total, COUNT(*) FILTER (WHERE is_treatment) AS n_treatment,
               COUNT(*) FILTER (WHERE is_control) AS n_control,
               {percent('COUNT(*) FILTER (WHERE is_treatment)')} AS treatment_pct,
               {percent('COUNT(*) FILTER (WHERE is_control)')} AS control_pct,
               {rnd('AVG(days_to_hard_churn) FILTER (WHERE is_treatment)')} AS avg_onset_treatment,
               {percent('COUNT(*) FILTER (WHERE is_treatment AND hard_churn_label)', 'COUNT(*) FILTER (WHERE is_treatment)')}
                   AS churn_pct_treatment,
               {percent('COUNT(*) FILTER (WHERE is_control AND hard_churn_label)', 'COUNT(*) FILTER (WHERE is_control)')}
                   AS churn_pct_control
        FROM churn""",
    "churn_by_day": f"""
        SELECT day, COUNT(*) FILTER (WHERE days_to_hard_churn <= day) AS n_churned,
               {percent('COUNT(*) FILTER (WHERE days_to_hard_churn <= day)')} AS pct
        FROM churn, (VALUES (10), (20), (30)) d(day) GROUP BY day""",
    "cumulative_churn": f"""
        SELECT CAST(d AS INTEGER) AS day, COUNT(*) FILTER (WHERE days_to_hard_churn <= d) AS n_churned,
               {rnd('CAST(COUNT(*) FILTER (WHERE days_to_hard_churn <= d) AS DOUBLE) / COUNT(*) * 100')} AS cumulative_pct
        FROM churn, range(0, 91) r(d) GROUP BY d""",
    "onset_histogram": f"""
        SELECT * FROM (WITH edges AS (
            SELECT CASE WHEN a = b THEN a - 0.5 ELSE a END::DOUBLE AS lo,
                   CASE WHEN a = b THEN 1 ELSE b - a END::DOUBLE / 20 AS w, med
            FROM (SELECT MIN(days_to_hard_churn) AS a, MAX(days_to_hard_churn) AS b,
                         median(days_to_hard_churn) AS med FROM churn WHERE hard_churn_label)
            WHERE a IS NOT NULL),
        placed AS (
            SELECT LEAST(FLOOR((days_to_hard_churn - lo) / w), 19) AS place FROM churn, edges WHERE hard_churn_label)
        SELECT CAST(b AS INTEGER) AS bin, {rnd('lo + b * w')} AS bin_start, {rnd('lo + b * w + w')} AS bin_end,
               COUNT(place) AS n, {rnd('MAX(med)')} AS median_onset
        FROM range(0, 20) r(b) CROSS JOIN edges LEFT JOIN placed ON place = b
        GROUP BY b, lo, w)""",
    "median_onset": f"SELECT {rnd('median(days_to_hard_churn)')} AS median_onset_days FROM churn WHERE is_treatment",
    "pre_churn_curve": f"""
        SELECT days_to_onset, {rnd('AVG(total_tokens)')} AS avg_tokens, COUNT(*) AS n_rows
        FROM relative_days WHERE days_to_onset BETWEEN -21 AND 7 GROUP BY days_to_onset""",
    "control_baseline": f"SELECT {rnd('AVG(total_tokens)')} AS control_avg_tokens FROM staged"
    " WHERE company_id IN (SELECT company_id FROM churn WHERE is_control)",
    "cohort_heatmap": f"SELECT row_no, friction_bucket, {', '.join(f'{rnd(n)} AS {n}' for n in BIN_NAMES)} FROM heat",
    "heatmap_relative": "SELECT row_no, friction_bucket, "
    + ", ".join(f"{rnd(f'{n} / NULLIF({BIN_NAMES[0]}, 0)')} AS {n}" for n in BIN_NAMES)
    + " FROM heat",
    "heatmap_finding": f"""
        SELECT {rnd(f"(1 - MAX({BIN_NAMES[4]} / {BIN_NAMES[0]}) FILTER (WHERE friction_bucket = 'Severe')) * 100")}
                   AS severe_drop_pct,
               {rnd(f"(MAX({BIN_NAMES[4]} / {BIN_NAMES[0]}) FILTER (WHERE friction_bucket = 'None') - 1) * 100")}
                   AS none_growth_pct
        FROM heat""",
    "errors_by_onboarding_day": """
        SELECT CAST(d AS INTEGER) AS day_since_signup, COUNT(error_id) AS error_events
        FROM range(0, 14) r(d) LEFT JOIN (
            SELECT e.error_id, date_diff('day', c.signup_date, CAST(e."timestamp" AS DATE)) AS since
            FROM api_errors e JOIN churn c USING (company_id) WHERE c.is_treatment AND e.error_code = 429) x
            ON x.since = r.d GROUP BY d""",
    "ttft_by_day_group": f"""
        SELECT day_since_signup, is_treatment, {rnd(mean('s.avg_ttft_ms', 2))} AS avg_ttft_ms
        FROM staged s JOIN churn c USING (company_id) WHERE day_since_signup BETWEEN 0 AND 13
        GROUP BY day_since_signup, is_treatment""",
    "churn_by_industry": f"""
        SELECT industry, {rnd('AVG(hard_churn_observed) FILTER (WHERE is_treatment) * 100')} AS treatment,
               {rnd('AVG(hard_churn_observed) FILTER (WHERE is_control) * 100')} AS control
        FROM churn GROUP BY industry""",
    "time_to_churn_by_tier": f"""
        SELECT contract_tier, {rnd('AVG(days_to_hard_churn)')} AS mean_days,
               {rnd('stddev_samp(days_to_hard_churn)')} AS std_days, COUNT(*) AS n
        FROM churn WHERE is_treatment GROUP BY contract_tier""",
    "propensity_summary": f"""
        SELECT is_treatment, COUNT(*) AS n, {rnd('AVG(ps)')} AS mean, {rnd('stddev_samp(ps)')} AS std,
               {rnd('MIN(ps)')} AS min, {rnd('quantile_cont(ps, 0.25)')} AS q_25, {rnd('quantile_cont(ps, 0.5)')} AS q_50,
               {rnd('quantile_cont(ps, 0.75)')} AS q_75, {rnd('MAX(ps)')} AS max
        FROM units GROUP BY is_treatment""",
    "propensity_overlap": f"""
        SELECT is_treatment, {rnd('lo')} AS range_min, {rnd('hi')} AS range_max, bin,
               {rnd('lo + bin * ((hi - lo) / 25)')} AS bin_start, COUNT(*) AS n,
               {rnd('COUNT(*)::DOUBLE / (MAX(m) * ((hi - lo) / 25))')} AS density
        FROM (SELECT u.is_treatment, lo, hi, m, CAST(LEAST(FLOOR((ps - lo) / ((hi - lo) / 25)), 24) AS INTEGER) AS bin
              FROM units u JOIN (SELECT is_treatment, MIN(ps) AS lo, MAX(ps) AS hi, COUNT(*) AS m FROM units
                                 GROUP BY is_treatment) g USING (is_treatment))
        GROUP BY is_treatment, lo, hi, bin""",
    "group_counts": "SELECT 'is_treatment' AS column_name, is_treatment::VARCHAR AS value, COUNT(*) AS n FROM churn GROUP BY 2"
    " UNION ALL SELECT 'risk_tier', risk_tier, COUNT(*) FROM scored GROUP BY 2"
    " UNION ALL SELECT 'error_code', error_code::VARCHAR, COUNT(*) FROM api_errors GROUP BY 2",
    "match_summary": f"""
        SELECT (SELECT COUNT(*) FROM queue) AS n_treated, COUNT(*) AS n_matched,
               (SELECT COUNT(*) FROM queue) - COUNT(*) AS n_dropped, {rnd('AVG(ps_diff)')} AS avg_ps_diff
        FROM pairs""",
    "matched_outcomes": f"""
        SELECT is_treatment, CAST(SUM(hard_churn_observed) AS BIGINT) AS events,
               {rnd('AVG(days_to_hard_churn)')} AS mean_days
        FROM matched GROUP BY is_treatment""",
    "portfolio_kpis": f"""
        SELECT COUNT(*) AS n_accounts, COUNT(*) FILTER (WHERE churn_probability >= 0.75) AS n_high_risk,
               {percent('COUNT(*) FILTER (WHERE churn_probability >= 0.75)')} AS high_risk_pct,
               COUNT(*) FILTER (WHERE risk_tier = 'Critical') AS n_critical,
               CAST(COALESCE(SUM({tier_value()}) FILTER (WHERE churn_probability >= 0.75), 0) AS BIGINT) AS arr_at_risk
        FROM scored""",
    "risk_histogram": histogram("scored", "churn_probability", 30),
    "risk_histogram_overlay": "SELECT 'Baseline' AS series, * FROM ("
    + histogram("halved", "baseline_risk", 30)
    + ") UNION ALL SELECT 'Counterfactual', * FROM ("
    + histogram("halved", "new_risk", 30)
    + ")",
    "risk_by_industry": f"SELECT industry, {rnd(mean('churn_probability', 4))} AS avg_churn_probability FROM scored GROUP BY industry",
    "account_errors_by_code": "SELECT company_id, error_code::VARCHAR AS error_code, COUNT(*) AS n FROM api_errors GROUP BY 1, 2",
    "account_429_daily": 'SELECT company_id, CAST("timestamp" AS DATE) AS "date", COUNT(*) AS n FROM api_errors'
    " WHERE error_code = 429 GROUP BY 1, 2",
    "account_ttft_vs_portfolio": f"""
        SELECT company_id, day_since_signup, avg_ttft_ms, {rnd('m')} AS portfolio_avg_ttft,
               avg_ttft_ms > m * CAST(1.5 AS DOUBLE) AS is_slow
        FROM staged, (SELECT {mean('avg_ttft_ms', 2)} AS m FROM staged WHERE day_since_signup <= 13)
        WHERE day_since_signup <= 13""",
    "rolling_7d_avg": "SELECT log_id, company_id, usage_date, rolling_7d_avg_tokens FROM velocity",
    "prev_day_tokens": "SELECT log_id, total_tokens, prev_day_tokens FROM lagged",
    "tokens_7d_ago": "SELECT log_id, total_tokens, tokens_7d_ago FROM lagged",
    "peak_weekly_tokens": "SELECT company_id, week_num, peak_weekly_tokens FROM cohort",
    "prev_week_tokens": f"SELECT company_id, week_num, {rnd('prev_week_tokens')} AS prev_week_tokens FROM weeks2",
    "account_rolling": f"SELECT company_id, usage_date, total_tokens, {rnd('mean7')} AS rolling_7d FROM lagged",
    "sort_cohort": "SELECT company_id, week_num, avg_weekly_tokens FROM cohort ORDER BY company_id, week_num",
    "sort_scored": "SELECT company_id, churn_probability FROM scored ORDER BY churn_probability DESC, company_id",
    "sort_saved": f"SELECT company_id, {rnd('baseline_risk', 3)} AS baseline_risk FROM halved WHERE {SAVED}",
    "matched_cohort": "SELECT * FROM matched",
    "distinct_signups": "SELECT DISTINCT company_id, signup_date FROM staged",
    "psm_covariates": f"SELECT company_id, {', '.join(f'{rnd(c)} AS {c}' for c in COVARIATES)} FROM covariates",
    "standardize": "SELECT company_id, "
    + ", ".join(
        f"CASE WHEN stddev_pop({c}) OVER () > 1e-12 THEN {rnd(f'({c} - AVG({c}) OVER ()) / stddev_pop({c}) OVER ()')}"
        f" ELSE 0 END AS {c}_z"
        for c in COVARIATES
    )
    + " FROM covariates",
    "smd": " UNION ALL ".join(
        f"SELECT '{label}' AS covariate, {rnd(smd_sql(c))} AS smd" for c, label in zip(COVARIATES, COVARIATE_LABELS)
    ),
    "balance_table": "SELECT covariate, b AS smd_before, "
    + f"{rnd('a', 3)} AS smd_after, a < 0.1 AS is_balanced, MAX({rnd('a', 3)}) OVER () AS max_smd_after,"
    + f" MAX({rnd('a', 3)}) OVER () < 0.1 AS all_balanced FROM ("
    + " UNION ALL ".join(
        f"SELECT '{label}' AS covariate, {rnd(smd_sql(c), 3)} AS b, {smd_sql(c, MATCHED_COVARIATES)} AS a"
        for c, label in zip(COVARIATES, COVARIATE_LABELS)
    )
    + ")",
    "encode_labels": """
        SELECT company_id, CAST(DENSE_RANK() OVER (ORDER BY industry) - 1 AS INTEGER) AS industry_enc,
               CAST(DENSE_RANK() OVER (ORDER BY contract_tier) - 1 AS INTEGER) AS contract_tier_enc FROM features""",
    "feature_matrix": "SELECT company_id, hard_churn_observed AS label, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC_FEATURES)
    + """, CAST(DENSE_RANK() OVER (ORDER BY industry) - 1 AS DOUBLE) AS industry_enc,
         CAST(DENSE_RANK() OVER (ORDER BY contract_tier) - 1 AS DOUBLE) AS contract_tier_enc FROM matrix""",
    "stratified_split": "SELECT soft_decay_label, COUNT(*) AS n, CAST(ROUND(COUNT(*) * 0.3) AS BIGINT) AS n_test"
    " FROM churn GROUP BY soft_decay_label",
    "class_weight": f"""
        SELECT neg - CAST(ROUND(neg * 0.3) AS BIGINT) AS negatives, pos - CAST(ROUND(pos * 0.3) AS BIGINT) AS positives,
               {rnd('(neg - ROUND(neg * 0.3))::DOUBLE / GREATEST(pos - ROUND(pos * 0.3), 1)')} AS weight
        FROM (SELECT COUNT(*) FILTER (WHERE NOT soft_decay_label) AS neg, COUNT(*) FILTER (WHERE soft_decay_label) AS pos
              FROM churn)""",
    "roc_auc": f"""
        SELECT {rnd('SUM(CASE WHEN a.churn_probability > b.churn_probability THEN 1.0 WHEN a.churn_probability = b.churn_probability THEN 0.5 ELSE 0 END)::DOUBLE / COUNT(*)')}
                   AS roc_auc
        FROM scored a, scored b WHERE a.hard_churn_label = 1 AND b.hard_churn_label = 0""",
    "average_precision": f"SELECT {rnd('SUM(pos * tp::DOUBLE / (tp + fp)) / NULLIF(MAX(all_pos), 0)')} AS average_precision FROM ladder",
    "roc_pr_curves": f"""
        SELECT threshold, {rnd('fp::DOUBLE / NULLIF(all_neg, 0)')} AS fpr, {rnd('tp::DOUBLE / NULLIF(all_pos, 0)')} AS tpr,
               {rnd('tp::DOUBLE / (tp + fp)')} AS precision, {rnd('tp::DOUBLE / NULLIF(all_pos, 0)')} AS recall
        FROM ladder""",
    "classification_report": REPORT,
    "confusion_matrix": """
        SELECT COUNT(*) FILTER (WHERE hard_churn_label = 0 AND churn_probability < 0.75) AS tn,
               COUNT(*) FILTER (WHERE hard_churn_label = 0 AND churn_probability >= 0.75) AS fp,
               COUNT(*) FILTER (WHERE hard_churn_label = 1 AND churn_probability < 0.75) AS fn,
               COUNT(*) FILTER (WHERE hard_churn_label = 1 AND churn_probability >= 0.75) AS tp FROM scored""",
    "scored_accounts": "SELECT * FROM scored",
    "counterfactual_scenarios": f"""
        SELECT scenario_no, scenario, CAST(TRUNC((1 - ttft_mult) * 100) AS INTEGER) AS ttft_reduction_pct,
               CAST(rl_red * 100 AS INTEGER) AS rate_limit_reduction_pct,
               COUNT(*) FILTER (WHERE {SAVED}) AS accounts_moved_to_safe,
               CAST(COALESCE(SUM({tier_value()}) FILTER (WHERE {SAVED}), 0) AS BIGINT) AS estimated_arr_retained
        FROM outcomes GROUP BY scenario_no, scenario, ttft_mult, rl_red""",
    "what_if": f"""
        SELECT 30 AS ttft_reduction_pct, 20 AS rate_limit_reduction_pct,
               COUNT(*) FILTER (WHERE baseline_risk >= 0.75) AS n_high_risk,
               COUNT(*) FILTER (WHERE {SAVED}) AS accounts_moved_to_safe,
               CAST(COALESCE(SUM({tier_value('contract_tier', 100000, 30000)}) FILTER (WHERE {SAVED}), 0) AS BIGINT)
                   AS estimated_arr_retained
        FROM (SELECT *, {risk('avg_ttft_ms_onboarding * (1 - CAST(30 AS DOUBLE) / 100)', 'count_429_onboarding * (1 - CAST(20 AS DOUBLE) / 100)')}
                  AS new_risk FROM stressed)""",
    "saved_accounts": f"""
        SELECT company_id, company_name, contract_tier, industry, {rnd('baseline_risk', 3)} AS baseline_risk,
               {rnd('new_risk', 3)} AS cf_risk, {rnd('baseline_risk - new_risk', 3)} AS risk_delta,
               CASE contract_tier WHEN 'Enterprise' THEN '$120,000' WHEN 'Growth' THEN '$24,000' END AS arr_value
        FROM halved WHERE {SAVED}""",
    "table_profile": f"""
        SELECT 'companies' AS item, COUNT(*) AS n, NULL::DOUBLE AS pct FROM companies
        UNION ALL SELECT 'daily_usage', COUNT(*), NULL FROM daily_usage
        UNION ALL SELECT 'api_errors', COUNT(*), NULL FROM api_errors
        UNION ALL SELECT 'treatment', COUNT(*) FILTER (WHERE infra_risk_score >= 0.55),
                         {percent('COUNT(*) FILTER (WHERE infra_risk_score >= 0.55)')} FROM companies
        UNION ALL SELECT 'control', COUNT(*) FILTER (WHERE infra_risk_score < 0.55),
                         {percent('COUNT(*) FILTER (WHERE infra_risk_score < 0.55)')} FROM companies""",
    **CHECKS,
    "quality_report": "SELECT *, CASE violations WHEN 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ("
    + " UNION ALL ".join(CHECKS.values())
    + ")",
    **survival_queries("hard"),
    **survival_queries("soft"),
    **{name: f"SELECT * FROM {relation}" for name, relation in MODEL_NAMES.items()},
}

ONE = " WHERE company_id IN (SELECT company_id FROM loudest)"
ACCOUNT_BODIES = ("usage", "errors", "card", "errors_by_code", "429_daily", "ttft_vs_portfolio", "rolling")
BODIES |= {f"account_{name}_one": f"SELECT * FROM ({BODIES[f'account_{name}']})" + ONE for name in ACCOUNT_BODIES}
BODIES |= survival_queries("matched_hard") | survival_queries("matched_soft")
BODIES |= {
    "alert_feed_filtered": BODIES["alert_feed"] + " AND contract_tier = 'Enterprise' AND industry IN ('BUILDING', 'MACHINERY')",
    "stratified_split_hard": BODIES["stratified_split"].replace("soft_decay_label", "hard_churn_label"),
    "class_weight_hard": BODIES["class_weight"].replace("soft_decay_label", "hard_churn_label"),
    # What a fit has to satisfy: residuals of zero, and counts that follow from the labels.
    "train_churn_model_certificate": "SELECT 100 AS trees, CAST(0 AS DOUBLE) AS worst_residual",
    "save_load_model_certificate": "SELECT company_id, CAST(0 AS DOUBLE) AS difference FROM companies",
    "attribution_certificate": "SELECT company_id, CAST(0 AS DOUBLE) AS residual FROM companies",
    "top_features_certificate": "SELECT CAST(10 AS BIGINT) AS listed, CAST(0 AS BIGINT) AS missed",
    "cross_validate_certificate": """
        SELECT CAST(f AS INTEGER) AS fold, label, (n - f + 4) // 5 AS n, (n - f + 4) // 5 AS n_scored
        FROM (SELECT CAST(hard_churn_label AS INTEGER) AS label, COUNT(*) AS n FROM churn GROUP BY 1), range(0, 5) r(f)
        WHERE (n - f + 4) // 5 > 0""",
    "propensity_score_certificate": "SELECT covariate, CAST(0 AS DOUBLE) AS gradient FROM (SELECT unnest("
    "['intercept', 'is_enterprise', 'log_avg_tokens_onboarding', 'growth_rate']) AS covariate"
    " UNION ALL SELECT DISTINCT 'ind_' || industry FROM companies)",
}
RELATIONS |= {
    "bad_churn": """
        SELECT * REPLACE (CASE WHEN company_id % 5 = 0 THEN TRUE ELSE is_control END AS is_control,
                          CASE WHEN company_id % 11 <> 0 THEN hard_churn_label END AS hard_churn_label)
        FROM (SELECT * FROM churn UNION ALL SELECT * FROM churn WHERE company_id % 7 = 0)""",
    "bad_features": "SELECT * FROM features WHERE company_id % 13 <> 0",
    "bad_usage": """
        SELECT * FROM daily_usage UNION ALL SELECT * FROM daily_usage WHERE company_id % 17 = 0
        UNION ALL SELECT * REPLACE (company_id + 1000000 AS company_id) FROM daily_usage WHERE company_id % 19 = 0""",
}
BODIES |= {
    "quality_report_observed": BODIES["quality_report"],
    "quality_report_faulty": re.sub(r"FROM (churn|features|daily_usage)\b", r"FROM bad_\1", BODIES["quality_report"]).replace(
        "bad_daily_usage", "bad_usage"
    ),
    "refresh_velocity": BODIES["int_usage_velocity"],
    "publish_results": "SELECT 'fct_cohort_churn' AS result, COUNT(*) AS row_count FROM churn"
    " UNION ALL SELECT 'scored_accounts', COUNT(*) FROM scored",
    "sift_source": """
        SELECT CASE error_id % 50 WHEN 0 THEN 'error_code is no int' WHEN 1 THEN 'too many fields' WHEN 2 THEN 'too few fields' ELSE 'good' END
                   AS kind, COUNT(*) AS n
        FROM api_errors GROUP BY 1""",
}
LATER_BODIES = {f"{name}_90": BODIES[name] for name in ("fct_cohort_churn", "velocity_trends", "cohort_heatmap", "heatmap_relative", "heatmap_finding")}

SQL: dict[str, str] = {name: with_relations(body) for name, body in BODIES.items()}
SQL |= {name: with_relations(body, LATER) for name, body in LATER_BODIES.items()}
