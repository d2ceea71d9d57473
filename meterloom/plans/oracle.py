"""The SQL each query is checked against, for DuckDB over the supplied tables. Written on its own, from the rules the
operators follow: straight joins and windows, with no thought of scale."""

import re

_PLAN = "CASE WHEN {t} >= 1705708800 THEN 'large' WHEN {t} >= 1704844800 THEN 'middle' ELSE 'small' END"
_LO = "CASE plan WHEN 'large' THEN 1705708800 WHEN 'middle' THEN 1704844800 ELSE 0 END"
_HI = "CASE plan WHEN 'middle' THEN 1705708800 WHEN 'small' THEN 1704844800 END"
_END = 1706572500 // 300 * 300


def _snap(x):
    return f"({x} // 600 + CASE WHEN {x} % 600 > 300 THEN 1 WHEN {x} % 600 = 300 THEN ({x} // 600) % 2 ELSE 0 END) * 600"


def _iso(x):
    return f"strftime(make_timestamp(({x}) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


def _win(reset, span, src):
    cut = f"greatest(reset - {span}, {_LO})", f"CASE WHEN {_HI} IS NULL THEN reset ELSE least(reset, {_HI}) END"
    return f"""SELECT plan, reset, {cut[0]} AS start, {cut[1]} AS "end",
        ({cut[0]} <> reset - {span} OR {cut[1]} <> reset) AS cut, peak
        FROM (SELECT plan, end_{src} AS reset, max(pct_{src}) AS peak FROM rd
              WHERE end_{src} IS NOT NULL AND pct_{src} IS NOT NULL GROUP BY 1, 2)"""


def _steps(src):
    return f"""SELECT * FROM (SELECT plan, end_{src} AS reset, ts, pct_{src} AS pct,
        max(pct_{src}) OVER (PARTITION BY plan, end_{src} ORDER BY ts, pct_{src}, ingest_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
        FROM rd WHERE end_{src} IS NOT NULL AND pct_{src} IS NOT NULL) WHERE top IS NULL OR pct > top"""


def _fit(src, span):
    """Per window the sums of the line through the origin, from every step of 5 % or more."""
    return f"""SELECT w.*, n_steps, n5, sxy, sxx, mean5, spent5, usd, tokens,
          CASE WHEN tokens <> 0 THEN unpriced_tokens / tokens ELSE 0.0 END AS unpriced,
          CASE WHEN tokens <> 0 THEN read_tokens / tokens ELSE 0.0 END AS cache_read
        FROM w{src} w JOIN (
          SELECT plan, reset, count(*) AS n_steps, count(*) FILTER (pct >= 5) AS n5,
            coalesce(sum(x * pct) FILTER (pct >= 5), 0) AS sxy, coalesce(sum(x * x) FILTER (pct >= 5), 0) AS sxx,
            avg(pct) FILTER (pct >= 5) AS mean5, count(*) FILTER (pct >= 5 AND x <> 0) AS spent5,
            arg_max(x, ts * 1000 + pct) AS usd, arg_max(x_tokens, ts * 1000 + pct) AS tokens,
            arg_max(x_unpriced, ts * 1000 + pct) AS unpriced_tokens, arg_max(x_read, ts * 1000 + pct) AS read_tokens
          FROM x{src} GROUP BY 1, 2) USING (plan, reset)"""


def _xy(src):
    return f"""SELECT s.plan, s.reset, s.ts, s.pct, coalesce(sum(tl.usd), 0) AS x, coalesce(sum(tl.tokens), 0) AS x_tokens,
        coalesce(sum(tl.unpriced), 0) AS x_unpriced, coalesce(sum(tl.cache_read_tokens), 0) AS x_read
        FROM st{src} s JOIN w{src} w USING (plan, reset)
        LEFT JOIN tl ON tl.ts + 150 >= w.start AND tl.ts + 150 < s.ts GROUP BY 1, 2, 3, 4"""


def _b(src):
    why = ("CASE WHEN unpriced > 0.05 THEN round_even(unpriced * 100, 0)::INT || '% of tokens without $' "
           "WHEN n5 < 3 OR spent5 = 0 THEN 'fewer than 3 readings at 5%+' END")
    return f"""SELECT f.*, {why} AS why, CASE WHEN ({why}) IS NULL AND sxx <> 0 AND sxy <> 0 THEN 100 * sxx / sxy END AS b,
        CASE WHEN ({why}) IS NULL AND sxx <> 0 AND sxy <> 0 AND sst <> 0 THEN 1 - sse / sst END AS r2
        FROM f{src} f LEFT JOIN (
          SELECT x.plan, x.reset, sum((x.pct - f.mean5) * (x.pct - f.mean5)) AS sst,
                 sum((x.pct - x.x * f.sxy / nullif(f.sxx, 0)) * (x.pct - x.x * f.sxy / nullif(f.sxx, 0))) AS sse
          FROM x{src} x JOIN f{src} f USING (plan, reset) WHERE x.pct >= 5 GROUP BY 1, 2) USING (plan, reset)"""


_TOKENS = ["input_tokens", "output_tokens", "cache_read_tokens", "cache_write_5m_tokens", "cache_write_1h_tokens", "cache_write_unknown_tokens"]
_ALL = " + ".join(_TOKENS)
_RQ = _TOKENS[:5]


def _sums(columns, prefix=""):
    return ", ".join(f"CAST(sum({prefix}{c}) AS BIGINT) AS {c}" for c in columns)


_PRICE = ("(input_tokens * {i} + output_tokens * {o} + cache_read_tokens * {i} * {r} + cache_write_5m_tokens * {i} * 1.25 "
          "+ cache_write_1h_tokens * {i} * 2.0) / 1e6")


def _usd(model="model"):
    rows = (("model-0", 5.0, 25.0, 0.1), ("model-1", 4.0, 20.0, 0.05), ("model-2", 2.0, 10.0, 0.1))
    return f"CASE {model} " + " ".join(f"WHEN '{m}' THEN " + _PRICE.format(i=f"{i}::DOUBLE", o=f"{o}::DOUBLE", r=f"{r}::DOUBLE") for m, i, o, r in rows) + " END"


_PROJECT = r"""CASE WHEN coalesce({f}, '') = '' THEN '?'
    WHEN regexp_extract({f}, '^/(Users|home)/[^/]+/(dev|opt)/([^/]+)', 3) <> '' THEN regexp_extract({f}, '^/(Users|home)/[^/]+/(dev|opt)/([^/]+)', 3)
    WHEN regexp_matches({f}, '^/(Users|home)/[^/]+(/.*)?$') THEN '~' || regexp_extract({f}, '^/(Users|home)/[^/]+(/.*)?$', 2)
    WHEN regexp_extract({f}, '^/private/tmp/claude-[0-9]+/-(Users|home)-[^/]*?-(dev|opt)-([^/]+)', 3) <> ''
      THEN regexp_extract({f}, '^/private/tmp/claude-[0-9]+/-(Users|home)-[^/]*?-(dev|opt)-([^/]+)', 3)
    ELSE {f} END"""
_KIND = r"""CASE WHEN coalesce(entrypoint, '') = '' THEN '?' WHEN entrypoint NOT LIKE 'sdk%' THEN 'development'
    WHEN regexp_matches(folder, '^/(Users|home)/[^/]+/opt/') THEN 'scheduled run' ELSE 'test run' END"""

_CTE = {
    "e": "SELECT event_id, epoch_us(ts) // 1000000 AS t, user_id, event_type, value, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k, props FROM events",
    "aq": f"""SELECT event_id AS ingest_id, t AS ts, CASE WHEN event_id % 2 = 0 THEN 'claude_api' ELSE 'claude_statusline' END AS source,
        CASE WHEN (t // 18000) % 4 = 3 OR k % 10 = 9 THEN 0.0 ELSE CAST((t % 18000) * 90 // 18000 + k % 5 AS DOUBLE) END AS p5,
        CASE WHEN (t // 18000) % 4 <> 3 THEN t - t % 18000 + 18000 + event_id % 3 - 1 END AS r5,
        CAST((t % 604800) * 80 // 604800 + k % 3 AS DOUBLE) AS p7, CASE WHEN k < 97 THEN t - t % 604800 + 604800 + event_id % 2 END AS r7,
        t + event_id % 7 AS written_ts, props AS raw, sha1(chr(10) || event_id || '|' || props) AS row_hash, 'm' || user_id % 3 AS machine, k FROM e""",
    "er": "SELECT event_id AS ingest_id, t AS ts, props FROM e WHERE event_type = 'error'",
    "rd": f"""SELECT ingest_id, ts, source, {_PLAN.format(t='ts')} AS plan, p5 AS pct_5h, p7 AS pct_7d, {_snap('r5')} AS end_5h, {_snap('r7')} AS end_7d FROM aq""",
    "w5h": _win("end_5h", 18000, "5h"), "w7d": _win("end_7d", 604800, "7d"), "st5h": _steps("5h"), "st7d": _steps("7d"),
    "sl": f"""SELECT t // 300 * 300 AS ts, 'm' || user_id % 3 AS machine,
        CASE k % 7 WHEN 0 THEN '' WHEN 1 THEN '/home/u' || user_id % 9 || '/opt/job' || k % 3 WHEN 2 THEN '/private/tmp/claude-5/-Users-x-dev-q' || k % 4 || '/s'
          WHEN 3 THEN '/Users/u' || user_id % 9 WHEN 4 THEN '/srv/w' || k % 2 ELSE '/home/u' || user_id % 9 || '/dev/p' || k % 5 || '/sub' END AS folder,
        CASE k % 3 WHEN 0 THEN 'cli' WHEN 1 THEN 'sdk-py' ELSE '' END AS entrypoint,
        CASE WHEN event_type = 'error' THEN '<synthetic>' ELSE 'model-' || user_id % 4 END AS model,
        count(*) AS requests, CAST(sum(k) AS BIGINT) AS input_tokens, CAST(sum(event_id % 1000) AS BIGINT) AS output_tokens,
        CAST(sum(k * 10) AS BIGINT) AS cache_read_tokens, CAST(sum(k % 20) AS BIGINT) AS cache_write_5m_tokens,
        CAST(sum(k % 11) AS BIGINT) AS cache_write_1h_tokens, CAST(0 AS BIGINT) AS cache_write_unknown_tokens,
        sum(CASE WHEN k % 40 <> 7 THEN value / 100 END) AS usd,
        CAST(coalesce(sum(CASE WHEN k % 40 = 7 THEN k + event_id % 1000 + k * 10 + k % 20 + k % 11 END), 0) AS BIGINT) AS tokens_without_usd
        FROM e GROUP BY 1, 2, 3, 4, 5""",
    "slc": f"SELECT *, {_ALL} AS tokens FROM sl WHERE model <> '<synthetic>'",
    "act": "SELECT DISTINCT ts FROM slc WHERE requests > 0",
    "tl": f"SELECT ts, coalesce(sum(usd), 0) AS usd, sum(tokens_without_usd) AS unpriced, sum(requests) AS requests, {', '.join(f'sum({c}) AS {c}' for c in _TOKENS)}, sum(tokens) AS tokens FROM slc GROUP BY 1",
    "x5h": _xy("5h"), "x7d": _xy("7d"), "f5h": _fit("5h", 18000), "f7d": _fit("7d", 604800), "b5h": _b("5h"), "b7d": _b("7d"),
    "ln": """SELECT 'f' || event_id % 20 AS path, event_id AS line, t AS ts, 'r' || (user_id * 10 + k // 10) AS request_id, 's' || user_id AS session_id,
        CASE WHEN k % 9 <> 0 THEN '/home/u' || user_id % 7 || '/dev/p' || user_id % 5 END AS folder,
        CASE WHEN k % 8 <> 0 THEN CASE WHEN user_id % 2 = 0 THEN 'cli' ELSE 'sdk-py' END END AS entrypoint, 'model-' || user_id % 4 AS model,
        k AS input_tokens, event_id % 1000 AS output_tokens, k * 10 AS cache_read_tokens, k % 20 AS cache_write_5m_tokens, k % 11 AS cache_write_1h_tokens
        FROM e""",
    "rq": """SELECT * EXCLUDE (rn, path, line, ts, first_ts), first_ts AS ts, CAST(substr(request_id, 2) AS BIGINT) AS ingest_id FROM (
        SELECT *, min(ts) OVER (PARTITION BY request_id) AS first_ts,
          row_number() OVER (PARTITION BY request_id ORDER BY output_tokens DESC, ts, path, line) AS rn FROM ln) WHERE rn = 1""",
    "tm": """SELECT event_id AS ingest_id, t AS ts, CASE WHEN k % 25 <> 0 THEN 'api_request' ELSE 'api_error' END AS event,
        's' || CASE WHEN event_type <> 'signup' THEN user_id ELSE user_id * 2 END AS session_id,
        CASE WHEN event_type <> 'signup' THEN 'r' || (user_id * 10 + k // 10) ELSE 't' || event_id // 4 END AS request_id,
        'model-' || user_id % 4 AS model, 'q' || k % 4 AS query_source, k AS input_tokens, event_id % 1000 AS output_tokens, k * 10 AS cache_read_tokens,
        k % 31 AS cache_creation_tokens, CASE WHEN k % 6 <> 0 THEN value / 100 END AS cost_usd, t + event_id % 1000 AS received_ts
        FROM e""",
    "tq": "SELECT * FROM tm WHERE ingest_id IN (SELECT min(ingest_id) FROM tm WHERE event = 'api_request' GROUP BY request_id)",
    "pl": """SELECT session_id, arg_min(folder, ingest_id) FILTER (folder IS NOT NULL) AS folder,
        arg_min(entrypoint, ingest_id) FILTER (entrypoint IS NOT NULL) AS entrypoint FROM rq GROUP BY 1""",
    "rows": f"""SELECT r.ts, coalesce(r.folder, '') AS folder, coalesce(r.entrypoint, '') AS entrypoint, r.model, r.input_tokens, r.output_tokens,
        r.cache_read_tokens, r.cache_write_5m_tokens, r.cache_write_1h_tokens, 0 AS cache_write_unknown_tokens, t.cost_usd
        FROM rq r LEFT JOIN tq t USING (request_id)
        UNION ALL SELECT t.ts, coalesce(p.folder, ''), coalesce(p.entrypoint, ''), t.model, t.input_tokens, t.output_tokens, t.cache_read_tokens, 0, 0,
        t.cache_creation_tokens, t.cost_usd FROM tq t LEFT JOIN pl p USING (session_id) WHERE t.request_id NOT IN (SELECT request_id FROM rq)""",
    "rp": f"SELECT *, {_usd()} AS usd, 'm' || ingest_id % 3 AS machine FROM rq",
    "ur": f"""SELECT r.ts, {_iso('r.ts')} AS dt, r.request_id, r.machine, r.session_id, r.folder, r.entrypoint, r.model, r.input_tokens, r.output_tokens,
        r.cache_read_tokens, r.cache_write_5m_tokens + r.cache_write_1h_tokens AS cache_write_tokens, coalesce(t.cost_usd, r.usd) AS usd,
        CASE WHEN t.cost_usd IS NOT NULL THEN 'telemetry' WHEN r.usd IS NOT NULL THEN 'price_table' END AS usd_from, 'transcript' AS seen_in
        FROM rp r LEFT JOIN tq t USING (request_id)
        UNION ALL SELECT t.ts, {_iso('t.ts')}, t.request_id, p.machine, t.session_id, p.folder, p.entrypoint, t.model, t.input_tokens, t.output_tokens,
        t.cache_read_tokens, t.cache_creation_tokens, t.cost_usd, 'telemetry', 'telemetry'
        FROM tq t LEFT JOIN (SELECT * FROM rp WHERE ingest_id IN (SELECT min(ingest_id) FROM rp GROUP BY session_id)) p USING (session_id)
        WHERE t.request_id NOT IN (SELECT request_id FROM rp)""",
    "sn": "SELECT event_id AS ingest_id, t AS ts, 's' || user_id % 40 AS session_id, (k // 25) / 4.0::DOUBLE AS session_cost_usd FROM e WHERE event_type = 'purchase'",
    "gp": """SELECT *, start - prev_end AS gap FROM (SELECT plan, start, "end", lag(plan) OVER o AS prev_plan, lag("end") OVER o AS prev_end
        FROM w5h WINDOW o AS (ORDER BY "end", start)) WHERE plan = prev_plan""",
    "gc": """SELECT g.*, (SELECT count(*) FROM rd WHERE ts >= prev_end AND ts < start) AS readings,
        (SELECT count(*) FROM rd WHERE ts >= prev_end AND ts < start AND source = 'claude_api' AND end_5h IS NULL) AS nulls,
        (SELECT count(*) FROM act WHERE ts >= prev_end AND ts <= start - 300) AS active,
        CAST(round_even(((SELECT min(ts) FROM act WHERE ts >= prev_end) - start) / 60.0::DOUBLE, 0) AS BIGINT) AS lag_min FROM gp g""",
    "sa": "SELECT * FROM aq WHERE ingest_id % 10 < 7", "sb": "SELECT * FROM aq WHERE ingest_id % 10 >= 4",
    "per5": """SELECT DISTINCT ON (s.ts) s.ts, w.start, w."end", w.plan, w.peak FROM (SELECT DISTINCT ts FROM slc) s JOIN w5h w ON w."end" > s.ts + 150 ORDER BY s.ts, w."end", w.start""",
    "per7": """SELECT DISTINCT ON (s.ts) s.ts, w.start, w."end", w.plan, w.peak FROM (SELECT DISTINCT ts FROM slc) s JOIN w7d w ON w."end" > s.ts + 150 ORDER BY s.ts, w."end", w.start""",
    "per5s": """SELECT DISTINCT ON (s.ts) s.ts, w.start, w."end", w.plan, w.peak FROM (SELECT DISTINCT ts FROM slc) s JOIN w5h w ON w."end" > s.ts + 150 AND w."end" > 1705104000 ORDER BY s.ts, w."end", w.start""",
    "wk": """SELECT plan, reset, start, gain_5h, q1 - q0 AS gain_7d, gain_5h / (q1 - q0) AS ratio FROM (
        SELECT a.plan, a.reset, a.start, a.p1 - a.p0 AS gain_5h,
          (SELECT greatest(coalesce(max(s.pct), 0), 0) FROM st7d s WHERE s.plan = w0.plan AND s.reset = w0.reset AND s.ts <= a.t0) AS q0,
          (SELECT greatest(coalesce(max(s.pct), 0), 0) FROM st7d s WHERE s.plan = w1.plan AND s.reset = w1.reset AND s.ts <= a.t1) AS q1
        FROM (SELECT plan, reset, min(ts) AS t0, max(ts) AS t1, arg_min(pct, ts * 1000 + pct) AS p0, arg_max(pct, ts * 1000 + pct) AS p1, any_value(start) AS start
              FROM st5h JOIN w5h USING (plan, reset) GROUP BY 1, 2 HAVING count(*) >= 2) a
        JOIN w7d w0 ON w0.plan = a.plan AND w0.start <= a.t0 AND a.t0 < w0."end"
        JOIN w7d w1 ON w1.plan = a.plan AND w1.start <= a.t1 AND a.t1 < w1."end") WHERE gain_5h >= 10 AND q1 > q0""",
    "mt": """SELECT r.*, t.input_tokens AS ti, t.output_tokens AS tout, t.cache_read_tokens AS tr, t.cache_creation_tokens AS tc, t.cost_usd FROM rq r JOIN tq t USING (request_id)""",
    "sx": """SELECT event_id, user_id, t, k, event_type, event_id // 4096 AS block FROM e""",
    "ctx": """SELECT *, last_value(CASE WHEN event_type = 'signup' THEN 'thr-' || user_id END IGNORE NULLS) OVER o AS thread,
        last_value(CASE WHEN event_type = 'signup' THEN CASE WHEN k % 2 = 0 THEN 'cli' ELSE 'exec' END END IGNORE NULLS) OVER o AS entrypoint,
        last_value(CASE WHEN event_type = 'signup' THEN '/w' || k % 3 WHEN event_type = 'error' AND k % 2 = 1 THEN '/ctx' END IGNORE NULLS) OVER o AS folder,
        last_value(CASE WHEN event_type = 'error' THEN 'model-' || k % 4 END IGNORE NULLS) OVER o AS model
        FROM e WINDOW o AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "rl": """SELECT event_id AS ingest_id, t, k, user_id, event_id % 29 AS fault, event_id % 2 AS odd,
        CASE WHEN event_id % 29 IN (7, 8) THEN 'not an object with a numeric ts' WHEN event_id % 29 = 4 THEN 'per-session field in an account row'
          WHEN event_id % 29 = 3 THEN 'unknown source' WHEN event_id % 29 = 6 THEN NULL WHEN event_id % 29 IN (1, 2) THEN 'percent is not a number'
          WHEN event_id % 29 = 5 THEN 'not a machine name' END AS reason FROM e""",
}
_CTE["rc"] = "SELECT *, row_number() OVER (ORDER BY ts, request_id) AS nth FROM rq WHERE ts <= 1706572500"
_CTE["pc"] = """SELECT session_id, arg_min(folder, nth) FILTER (folder IS NOT NULL) AS folder,
    arg_min(entrypoint, nth) FILTER (entrypoint IS NOT NULL) AS entrypoint FROM rc GROUP BY 1"""
_CTE["placed"] = re.sub(r"\bpl\b", "pc", re.sub(r"\brq\b", "rc", _CTE["rows"]))
_RUN = "{i} * 3 // (SELECT max(event_id) + 1 FROM e)"
_CTE["ctg"] = _CTE["ctx"].replace("PARTITION BY user_id", f"PARTITION BY user_id, CASE user_id % 4 WHEN 0 THEN {_RUN.format(i='event_id')} >= 1 "
                                  f"WHEN 1 THEN {_RUN.format(i='event_id')} >= 2 ELSE FALSE END")
_CTE["cut"] = f"SELECT {_RUN.format(i='event_id')} AS run, max(t) AS now FROM e GROUP BY 1"
_CTE["rr"] = """SELECT *, reason IS NULL AND fault <> 6 AND odd = 1 AND coalesce((day, k % 2) = (lag(day) OVER o, lag(k % 2) OVER o), FALSE) AS redundant
    FROM (SELECT *, t - t % 86400 AS day FROM rl) WINDOW o AS (PARTITION BY user_id % 50, reason IS NULL AND fault <> 6 AND odd = 1 ORDER BY ingest_id)"""


def _sql(body, *first):
    """The body behind the CTEs it names, each after those it names itself."""
    order = []

    def need(text):
        for name in _CTE:
            if name not in order and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                need(_CTE[name])
                if name not in order:
                    order.append(name)
    need(body)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({_CTE[n]})" for n in order) + "\n" + body


def _r(*columns):
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


_SLOT_SUMS = f"""count(*) AS requests, {_sums(_TOKENS)}, round(sum(cost_usd), 6) AS usd,
    CAST(coalesce(sum(CASE WHEN cost_usd IS NULL THEN {_ALL} END), 0) AS BIGINT) AS tokens_without_usd"""


def _split(place, group, top, where="TRUE", peak=True):
    """Groups per period with the ones past the top added up."""
    return f"""SELECT plan, start, "end"{', peak' if peak else ''}, coalesce(shown, '(' || count(*) || ' others)') AS g, round(sum(usd), 6) AS usd,
        CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(unpriced) AS BIGINT) AS unpriced, CAST(sum(requests) AS BIGINT) AS requests,
        CASE WHEN any_value(total) <> 0 THEN round(sum(usd) / any_value(total), 6) END AS share
      FROM (SELECT *, CASE WHEN rk <= {top} THEN g END AS shown FROM (
        SELECT *, row_number() OVER (PARTITION BY start, "end" ORDER BY usd DESC, tokens DESC, g) AS rk, sum(usd) OVER (PARTITION BY start, "end") AS total
        FROM (SELECT p.plan, p.start, p."end", p.peak, {group} AS g, coalesce(sum(s.usd), 0) AS usd, sum(s.tokens) AS tokens, sum(s.tokens_without_usd) AS unpriced,
              sum(s.requests) AS requests FROM slc s JOIN {place} p USING (ts) WHERE p.start <= s.ts + 150 AND {where} GROUP BY 1, 2, 3, 4, 5)))
      GROUP BY plan, start, "end", peak, shown"""


_CTE["days"] = f"""SELECT DISTINCT ts, ts // 86400 * 86400 AS start, ts // 86400 * 86400 + 86400 AS "end", {_PLAN.format(t='(ts // 86400 * 86400)')} AS plan, NULL::DOUBLE AS peak FROM slc"""

ORACLE = {
    "slots_of_events": _sql(f"SELECT * EXCLUDE (usd), {_iso('ts')} AS dt, round(usd, 6) AS usd FROM sl"),
    "slots_final": _sql(f"""SELECT ts // 300 * 300 AS ts, {_iso('ts // 300 * 300')} AS dt, 'm1' AS machine, folder, entrypoint, model, {_SLOT_SUMS},
        CAST(1706745600 AS BIGINT) AS written_ts FROM rows WHERE ts < {_END} GROUP BY ts // 300 * 300, folder, entrypoint, model"""),
    "slots_in_three_runs": _sql(f"""SELECT ts // 300 * 300 AS ts, {_iso('ts // 300 * 300')} AS dt, 'm1' AS machine, folder, entrypoint, model, {_SLOT_SUMS}
        FROM placed WHERE ts < {_END} GROUP BY ts // 300 * 300, folder, entrypoint, model"""),
    "stores_rebuilt": _sql(f"""SELECT 'requests' AS what, count(*) AS old_rows, 0 AS missing, 0 AS different FROM rq WHERE ts <= 1706572500
        UNION ALL SELECT what, count(*), differs, differs FROM (SELECT DISTINCT ts // 300 * 300, folder, entrypoint, model FROM placed WHERE ts < {_END}),
          (VALUES ('slots', 0), ('spoiled slots', 1)) v(what, differs) GROUP BY what, differs"""),
    "slots_without_telemetry": _sql(f"""SELECT ts // 300 * 300 AS ts, {_iso('ts // 300 * 300')} AS dt, 'm1' AS machine, coalesce(folder, '') AS folder,
        coalesce(entrypoint, '') AS entrypoint, model, count(*) AS requests, {_sums(_RQ)}, CAST(0 AS BIGINT) AS cache_write_unknown_tokens,
        CAST(sum({' + '.join(_RQ)}) AS BIGINT) AS tokens_without_usd, CAST(1706745600 AS BIGINT) AS written_ts FROM rq WHERE ts < {_END}
        GROUP BY ts // 300 * 300, coalesce(folder, ''), coalesce(entrypoint, ''), model"""),
    "requests_of_lines": _sql("SELECT * EXCLUDE (ingest_id) FROM rq"),
    "telemetry_once": _sql("SELECT * EXCLUDE (cost_usd), round(cost_usd, 6) AS cost_usd FROM tq"),
    "requests_with_costs": _sql("SELECT * EXCLUDE (usd), round(usd, 9) AS usd FROM ur"),
    "repeats_dropped": _sql("""SELECT event_id, user_id, event_type, half FROM (SELECT *, lag(event_type) OVER o AS pt, lag(half) OVER o AS ph
        FROM (SELECT *, k // 50 AS half FROM e) WINDOW o AS (PARTITION BY user_id ORDER BY event_id)) WHERE pt IS NULL OR pt <> event_type OR ph <> half"""),
    "exact_copies_dropped": _sql("""SELECT min(event_id) AS event_id, raw, sha1(chr(10) || raw) AS row_hash
        FROM (SELECT event_id, user_id || '|' || event_type || '|' || props AS raw FROM e) GROUP BY raw"""),
    "last_purchase_carried": _sql("""SELECT event_id, user_id, event_type, value, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS)
        OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_purchase FROM e"""),
    "turns_of_sessions": _sql(f"""SELECT * EXCLUDE (rn, usd), round(usd, 9) AS usd FROM (SELECT *, {_usd()} AS usd FROM (
        SELECT t AS ts, {_iso('t')} AS dt, thread || ':' || k * 7 AS request_id, 'm1' AS machine, thread AS session_id, folder, entrypoint, model,
          greatest(k + event_id % 10 - k % 50, 0) AS input_tokens, event_id % 100 AS output_tokens, k % 50 AS cache_read_tokens, k % 6 AS cache_write_5m_tokens,
          CAST(0 AS BIGINT) AS cache_write_1h_tokens, row_number() OVER (PARTITION BY thread || ':' || k * 7 ORDER BY event_id) AS rn
        FROM ctx WHERE event_type NOT IN ('signup', 'error') AND thread IS NOT NULL) WHERE rn = 1)"""),
    "counter_usage": _sql("""SELECT strftime(make_timestamp(t * 1000000), '%Y-%m') AS month, model, count(*) AS events,
        CAST(sum(CASE WHEN pk IS NULL THEN k * 3 WHEN k < pk THEN k + event_id % 10 - k % 50 ELSE (k - pk) * 3 END) AS BIGINT) AS input_tokens,
        CAST(sum(CASE WHEN pk IS NULL THEN k WHEN k < pk THEN event_id % 100 ELSE k - pk END) AS BIGINT) AS output_tokens,
        CAST(sum(CASE WHEN pk IS NULL THEN k * 2 WHEN k < pk THEN k % 50 ELSE (k - pk) * 2 END) AS BIGINT) AS cache_read_tokens
        FROM (SELECT *, lag(k) OVER (PARTITION BY user_id ORDER BY event_id) AS pk FROM ctx WHERE event_type NOT IN ('signup', 'error'))
        WHERE pk IS NULL OR pk <> k GROUP BY 1, 2"""),
    "requests_of_transcripts": _sql(f"""SELECT * EXCLUDE (ingest_id), {_iso('ts')} AS dt FROM rq WHERE ts <= 1706572500"""),
    "requests_of_growing_files": _sql(f"""SELECT first_ts AS ts, {_iso('first_ts')} AS dt, * EXCLUDE (rn, path, line, ts, first_ts, run_at, done_at) FROM (
        SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY output_tokens DESC, ts, path, line) AS rn FROM (
          SELECT l.*, f.first_ts,
            (SELECT min(run) FROM cut WHERE cut.now - 900 >= f.first_ts) AS done_at, {_RUN.format(i='l.line')} AS run_at
          FROM ln l JOIN (SELECT request_id, min(ts) AS first_ts FROM ln GROUP BY 1) f USING (request_id)) WHERE run_at <= done_at) WHERE rn = 1"""),
    "turns_of_growing_files": _sql(f"""SELECT * EXCLUDE (rn, usd), round(usd, 9) AS usd FROM (SELECT *, {_usd()} AS usd FROM (
        SELECT t AS ts, {_iso('t')} AS dt, thread || ':' || k * 7 AS request_id, 'm1' AS machine, thread AS session_id, folder, entrypoint, model,
          greatest(k + event_id % 10 - k % 50, 0) AS input_tokens, event_id % 100 AS output_tokens, k % 50 AS cache_read_tokens, k % 6 AS cache_write_5m_tokens,
          CAST(0 AS BIGINT) AS cache_write_1h_tokens, row_number() OVER (PARTITION BY thread || ':' || k * 7 ORDER BY {_RUN.format(i='event_id')}, user_id, event_id) AS rn
        FROM ctg WHERE event_type NOT IN ('signup', 'error') AND thread IS NOT NULL) WHERE rn = 1)"""),
    "telemetry_of_batches": _sql(f"""SELECT ts, {_iso('ts')} AS dt, event, CASE WHEN ingest_id % 11 <> 0 THEN session_id END AS session_id, request_id, model, query_source,
        input_tokens, output_tokens, cache_read_tokens, cache_creation_tokens, round(cost_usd, 6) AS cost_usd, received_ts,
        '{{"source":"claude_otel","observed_at":' || ts || ',"received_at":' || received_ts || ',"event":"' || event || '","time_unix_nano":' || ts || '123000000,"attributes":{{'
        || CASE WHEN ingest_id % 2 = 0 THEN '"event.name":"' || event || '",' ELSE '' END || '"session.id":"' || CASE WHEN ingest_id % 11 = 0 THEN '../x' ELSE session_id END
        || '","request_id":"' || request_id || '","model":"' || model || '","query_source":"' || query_source || '","input_tokens":' || input_tokens || ',"output_tokens":'
        || output_tokens || ',"cache_read_tokens":' || cache_read_tokens || ',"cache_creation_tokens":' || cache_creation_tokens
        || CASE WHEN ingest_id % 7 = 0 THEN ',"deep":[[[[{{"q":"' || query_source || '"}}]]]]' ELSE '' END
        || CASE WHEN cost_usd IS NOT NULL THEN ',"cost_usd":?' ELSE '' END || '}},"resource":{{"os.type":"x"}}}}' AS raw FROM tm"""),
    "readings_classified": _sql("""SELECT ingest_id, CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN redundant THEN 'redundant' ELSE 'inserted' END AS outcome, reason,
        CASE WHEN fault = 8 THEN 0 ELSE CAST(fault = 6 AS BIGINT) END AS is_error,
        CASE WHEN fault IN (7, 8) AND odd = 0 THEN NULL WHEN fault = 8 THEN NULL WHEN fault IN (3, 6) THEN t WHEN odd = 1 THEN day WHEN fault = 7 THEN NULL ELSE t END AS ts,
        CASE WHEN fault = 8 THEN 'claude_api' WHEN fault = 3 THEN 'other' WHEN odd = 0 THEN 'claude_api' ELSE 'claude_statusline' END AS source,
        CASE WHEN fault IN (1, 2, 3, 8) THEN NULL WHEN odd = 0 THEN k + 0.5::DOUBLE ELSE (k % 2)::DOUBLE END AS five_hour_pct,
        CASE WHEN fault IN (3, 8) OR odd = 1 THEN NULL ELSE t + 60 END AS five_hour_resets_ts,
        CASE WHEN fault IN (3, 8) OR odd = 0 THEN NULL ELSE 's-' || user_id % 50 END AS observed_by_session,
        CASE WHEN fault IN (4, 6, 8) THEN NULL WHEN fault = 5 THEN 'a b' ELSE 'm-1' END AS machine, CAST(CASE WHEN fault = 6 THEN 429 END AS BIGINT) AS status FROM rr"""),
    "readings_stored_twice": _sql("""SELECT CASE WHEN odd = 0 THEN 'claude_api' ELSE 'claude_statusline' END AS source, CASE WHEN fault <> 4 THEN 'm-1' END AS machine,
        count(*) AS rows, count(*) AS hashes, CAST(sum(t) AS BIGINT) AS written FROM rl WHERE reason IS NULL AND fault <> 6 GROUP BY 1, 2"""),
    "readings_in_batches": _sql("""SELECT ingest_id, CASE WHEN odd = 1 THEN day ELSE t END AS ts, CASE WHEN odd = 0 THEN 'claude_api' ELSE 'claude_statusline' END AS source,
        CASE WHEN odd = 0 THEN k + 0.5::DOUBLE ELSE (k % 2)::DOUBLE END AS five_hour_pct, CASE WHEN odd = 1 THEN 's-' || user_id % 50 END AS observed_by_session
        FROM rr WHERE reason IS NULL AND fault <> 6 AND NOT redundant"""),
    "snapshots_in_batches": _sql("""SELECT ingest_id, ts, 's' || sess AS session_id, session_cost_usd
        FROM (SELECT *, coalesce((session_cost_usd, note) = (lag(session_cost_usd) OVER o, lag(note) OVER o), FALSE) AS same
          FROM (SELECT event_id AS ingest_id, t // 86400 * 86400 AS ts, (k // 50)::DOUBLE AS session_cost_usd, event_id % 17 = 2 AS note,
              user_id % 30 AS sess FROM e WHERE event_id % 17 NOT IN (1, 3, 4, 5)) WINDOW o AS (PARTITION BY sess ORDER BY ingest_id)) WHERE NOT same"""),
    "finished_windows": _sql("""SELECT window_minutes, start, start + 3600 AS "end", k * 1.5::DOUBLE / 100 AS pct, CAST(1 AS BIGINT) AS accounting_complete, event_id AS fetched_ts
        FROM (SELECT *, t // 3600 * 3600 AS start, CASE WHEN k % 2 = 0 THEN 300 ELSE 10080 END AS window_minutes,
          row_number() OVER (PARTITION BY t // 3600, k % 2 ORDER BY event_id DESC) AS rn FROM e) WHERE rn = 1"""),
    "daily_tokens": _sql("""SELECT strftime(make_timestamp(t * 1000000), '%Y-%m-%d') AS day, arg_max(k, event_id) AS tokens, max(event_id) AS fetched_ts FROM e GROUP BY 1"""),
    "product_breakdown": _sql("""SELECT product, t // 86400 * 86400 AS day, count(*) AS rows, CAST(sum(k + i) AS DOUBLE) AS pct
        FROM e, (VALUES ('chat', 0), ('other', 1)) p(product, i) GROUP BY 1, 2"""),
    "costs_and_refusals": _sql("""SELECT c.*, r.refused, r.resets_ts FROM (SELECT 's' || user_id AS session_id, arg_max(t + 5, event_id) AS ts, arg_max(k / 4.0::DOUBLE, event_id) AS usd
        FROM e WHERE event_type <> 'error' GROUP BY 1) c LEFT JOIN (SELECT 's' || user_id AS session_id, count(*) AS refused, max(t + k) AS resets_ts
        FROM e WHERE event_type = 'error' AND k % 2 = 0 GROUP BY 1) r USING (session_id)"""),
    "payloads_to_lines": _sql("""SELECT e.event_id, a.t AS observed_at, CASE WHEN k % 3 <> 0 THEN k::DOUBLE ELSE 0.0 END AS pct, CASE WHEN k % 2 <> 0 THEN '2026-01-01T00:00:00Z' END AS resets_at,
        CASE WHEN k % 4 <> 0 THEN 's' || user_id END AS session_id, CASE WHEN k % 4 <> 0 THEN k / 4.0::DOUBLE END AS cost
        FROM e JOIN (SELECT user_id % 50 AS tr, arg_max(t, event_id) AS t, arg_max(user_id, event_id) AS u FROM e WHERE event_type = 'view' GROUP BY 1) a ON e.user_id % 60 = a.tr
        WHERE k % 5 <> 0 AND a.u % 10 <> 0"""),
    "session_lines_classified": _sql("""SELECT ingest_id, CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN same THEN 'redundant' ELSE 'inserted' END AS outcome, reason, ts, session_cost_usd
        FROM (SELECT *, coalesce((session_cost_usd, note) = (lag(session_cost_usd) OVER o, lag(note) OVER o), FALSE) AS same
          FROM (SELECT event_id AS ingest_id, t // 86400 * 86400 AS ts, CASE WHEN event_id % 17 <> 3 THEN (k // 50)::DOUBLE END AS session_cost_usd, event_id % 17 = 2 AS note,
              user_id % 30 AS sess, CASE event_id % 17 WHEN 4 THEN 'not a plain session id' WHEN 5 THEN 'not a plain session id' WHEN 1 THEN 'percent-like key in session data'
              WHEN 3 THEN 'session_cost_usd is not a number' END AS reason FROM e) WINDOW o AS (PARTITION BY sess, reason IS NULL ORDER BY ingest_id))"""),
    "snapshots_stored_twice": _sql("""SELECT session_id, count(*) AS rows, max(day) AS ts FROM (
        SELECT DISTINCT 's' || user_id % 30 AS session_id, t, k // 50 AS cost, k % 2 AS odd, event_id % 17 = 2 AS note, t // 86400 * 86400 AS day
        FROM e WHERE event_id % 17 NOT IN (1, 3, 4, 5)) GROUP BY 1"""),
    "telemetry_stored_twice": _sql("""SELECT event, count(*) AS rows, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, 1 AS scans FROM (
        SELECT DISTINCT event, ts, received_ts, session_id, request_id, model, input_tokens, output_tokens, cost_usd, ingest_id % 2, ingest_id % 7 = 0, ingest_id % 11 = 0 FROM tm) GROUP BY 1"""),
    "requests_in_batches": _sql("SELECT row_number() OVER (ORDER BY ts, request_id) AS place, request_id, ts, output_tokens FROM rq"),
    "slots_received": _sql("SELECT machine, count(*) AS slots, CAST(sum(requests) AS BIGINT) AS requests, round(sum(usd), 6) AS usd FROM sl WHERE machine = 'm1' GROUP BY 1"),
    "requests_rebuilt": _sql("SELECT count(*) AS old_rows, 0 AS missing, 0 AS different FROM rq WHERE ts <= 1706572500"),
    "slots_moved": _sql("SELECT machine, count(*) AS slots, CAST(sum(requests) AS BIGINT) AS requests FROM sl GROUP BY 1"),
    "slots_in_order": _sql("""SELECT ts, folder, entrypoint, model, machine, row_number() OVER (ORDER BY ts, folder, entrypoint, model, machine) AS place FROM sl"""),
    "slot_faults": _sql("""SELECT CASE input_tokens % 13 WHEN 1 THEN 'requests is not a count' WHEN 2 THEN 'dt is not ts' WHEN 3 THEN 'not a machine name' WHEN 4 THEN 'model is not text'
        ELSE 'good' END AS fault, count(*) AS rows FROM sl GROUP BY 1"""),
    "windows_5h": _sql('SELECT plan, reset, start, "end", CAST(cut AS BIGINT) AS cut, peak FROM w5h'),
    "windows_7d": _sql('SELECT plan, reset, start, "end", CAST(cut AS BIGINT) AS cut, peak FROM w7d'),
    "steps_5h": _sql("SELECT plan, reset, ts, pct FROM st5h"),
    "steps_7d": _sql("SELECT plan, reset, ts, pct FROM st7d"),
    "gaps_between_windows": _sql("SELECT plan, prev_end, start, gap, readings, nulls, active, lag_min FROM gc"),
    "gap_statistics": _sql("""SELECT count(*) AS pairs, count(*) FILTER (abs(gap) < 60) AS back_to_back, count(*) FILTER (gap BETWEEN 60 AND 1200) AS within_20_min,
        count(*) FILTER (gap > 1200) AS idle, count(*) FILTER (gap < -1200) AS overlaps, round(median(gap / 3600.0::DOUBLE) FILTER (gap > 1200), 6) AS median_idle_h,
        round(max(gap / 3600.0::DOUBLE) FILTER (gap > 1200), 6) AS max_idle_h, count(*) FILTER (gap > 1200 AND nulls > 0) AS idle_with_null,
        count(*) FILTER (gap > 1200 AND readings = 0) AS idle_without_reading FROM gc"""),
    "gap_anomalies": _sql("""SELECT plan, prev_end, start, CASE WHEN active > 0 THEN 'activity inside the gap' ELSE 'opened with no activity seen' END AS anomaly
        FROM gc WHERE active > 0 OR lag_min NOT BETWEEN -10 AND 15"""),
    "activity_outside_windows": _sql("""SELECT count(*) AS active_slots, count(*) FILTER (ts >= last_end) AS outside FROM (
        SELECT a.ts, (SELECT w."end" FROM w5h w WHERE w.start <= a.ts + 299 ORDER BY w.start DESC, w."end" DESC LIMIT 1) AS last_end
        FROM act a WHERE a.ts >= (SELECT min(start) FROM w5h))"""),
    "window_coverage": _sql("""SELECT count(*) AS windows, CAST(sum("end" - start) AS BIGINT) AS covered_s, max("end") - min(start) AS elapsed_s,
        round(sum("end" - start) / (max("end") - min(start)), 6) AS share FROM w5h"""),
    "window_ledger": _sql("""SELECT plan, start, "end", strftime(make_timestamp("end" * 1000000), '%a') AS weekday, round(("end" - prev) / 86400.0::DOUBLE, 6) AS step_days, peak,
        (SELECT min(ts) FROM act WHERE ts >= prev) AS first_active, (SELECT min(ts) FROM act WHERE ts >= prev) + 604800 AS end_if_opened_then
        FROM (SELECT *, lag("end") OVER (ORDER BY "end", start) AS prev FROM w7d)"""),
    "no_window_runs": _sql("""SELECT first, coalesce(nxt, first) AS "end", n AS readings, CAST(n < 2 AS BIGINT) AS blip, (SELECT min(ts) FROM act WHERE ts >= first) AS first_active
        FROM (SELECT run, min(ts) FILTER (end_7d IS NULL) AS first, count(*) FILTER (end_7d IS NULL) AS n,
            lead(min(ts) FILTER (end_7d IS NOT NULL)) OVER (ORDER BY run) AS nxt
          FROM (SELECT *, count(end_7d) OVER (ORDER BY ts, ingest_id) AS run FROM rd WHERE source = 'claude_api') GROUP BY run) WHERE n > 0"""),
    "readings_across_resets": _sql("""SELECT w.plan, w."end", b.ts AS before_ts, b.pct_5h AS before_pct_5h, b.end_5h AS before_end_5h, b.pct_7d AS before_pct_7d,
        a.ts AS after_ts, a.pct_5h AS after_pct_5h, a.end_5h AS after_end_5h, a.pct_7d AS after_pct_7d
        FROM (SELECT DISTINCT plan, "end" FROM w7d WHERE peak > 0 AND NOT cut AND "end" <= (SELECT max(ts) FROM rd WHERE source = 'claude_api')) w
        JOIN LATERAL (SELECT * FROM (SELECT * FROM rd WHERE source = 'claude_api' AND ts < w."end" ORDER BY ts DESC, ingest_id DESC LIMIT 20)
          WHERE ts >= w."end" - 2400 AND end_5h > w."end" AND pct_5h <> 0 ORDER BY ts DESC, ingest_id DESC LIMIT 1) b ON TRUE
        JOIN LATERAL (SELECT * FROM rd WHERE source = 'claude_api' AND ts >= w."end" AND ts <= w."end" + 2400 ORDER BY ts, ingest_id LIMIT 1) a ON TRUE"""),
    "saturated_windows": _sql("""SELECT s.plan, s.reset, min(s.ts) AS ts, any_value(w."end") - min(s.ts) AS capped_s FROM st5h s JOIN w5h w USING (plan, reset)
        WHERE s.pct + 8 >= 100 GROUP BY 1, 2"""),
    "meter_jumps": _sql("""SELECT plan, reset, prev_ts, prev_pct, ts, pct FROM (SELECT *, lag(ts) OVER o AS prev_ts, lag(pct) OVER o AS prev_pct FROM st5h
        WINDOW o AS (PARTITION BY plan, reset ORDER BY ts, pct)) WHERE pct - prev_pct >= 5 AND ts - prev_ts <= 1800"""),
    "reading_compression": _sql("SELECT (SELECT count(*) FROM rd WHERE pct_5h IS NOT NULL AND end_5h IS NOT NULL) AS readings, count(*) AS steps FROM st5h"),
    "spent_in_windows": _sql(f"""SELECT w.plan, w.reset, round(coalesce(sum(usd), 0), 6) AS usd, CAST(coalesce(sum(unpriced), 0) AS BIGINT) AS unpriced,
        CAST(coalesce(sum(requests), 0) AS BIGINT) AS requests, {', '.join(f'CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}' for c in [*_TOKENS, 'tokens'])}
        FROM w5h w LEFT JOIN tl ON tl.ts + 150 >= w.start AND tl.ts + 150 < w."end" GROUP BY 1, 2"""),
    "budgets_5h": _sql(f"""SELECT plan, reset, start, "end", peak, n_steps AS steps, {_r('usd')}, CAST(tokens AS BIGINT) AS tokens, {_r('unpriced', 'cache_read')}, why, {_r('b', 'r2')}
        FROM b5h WHERE peak >= 5 AND NOT (tokens <> 0 AND unpriced = 1)"""),
    "budgets_7d": _sql(f"""SELECT plan, reset, start, "end", peak, n_steps AS steps, {_r('usd')}, CAST(tokens AS BIGINT) AS tokens, {_r('unpriced', 'cache_read')}, why, {_r('b', 'r2')} FROM b7d"""),
    "windows_per_week": _sql(f"SELECT plan, reset, start, gain_5h, gain_7d, {_r('ratio')} FROM wk"),
    "one_percent_mix": _sql(f"""SELECT plan, {', '.join(f'CASE WHEN m.usd <> 0 THEN round(m.{c} / m.usd * o.b / 100, 6) END AS {c}' for c in _TOKENS)}
        FROM (SELECT w.plan, sum(tl.usd) AS usd, {', '.join(f'sum(tl.{c}) AS {c}' for c in _TOKENS)} FROM b5h w JOIN tl ON tl.ts + 150 >= w.start AND tl.ts + 150 < w."end"
          WHERE w.b <> 0 AND w.peak >= 30 GROUP BY 1) m
        JOIN (SELECT plan, list_sort(list(b))[count(*) // 2 + 1] AS b FROM b5h WHERE b <> 0 AND peak >= 30 GROUP BY 1) o USING (plan)"""),
    "split_week_by_project": _sql(_split("per7", _PROJECT.format(f="s.folder"), 4)),
    "split_5h_by_kind": _sql(_split("per5s", _KIND.replace("entrypoint", "s.entrypoint").replace("folder", "s.folder"), 8)),
    "split_day_by_machine": _sql(_split("days", "s.machine", 8, "s.ts >= 1704499200", peak=False)),
    "split_totals": _sql("""SELECT CASE WHEN grouping(start) = 0 THEN 'period' WHEN grouping(g) = 0 THEN 'group' ELSE 'all' END AS level, start, "end", plan, g,
        round(sum(usd), 6) AS usd, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens_without_usd) AS BIGINT) AS unpriced, CAST(sum(requests) AS BIGINT) AS requests
        FROM (SELECT d.start, d."end", d.plan, s.model AS g, coalesce(s.usd, 0) AS usd, s.tokens, s.tokens_without_usd, s.requests FROM slc s JOIN days d USING (ts))
        GROUP BY GROUPING SETS ((start, "end", plan), (g), ())"""),
    "groups_over_all_periods": _sql(f"""SELECT *, CASE WHEN sum(usd) OVER () <> 0 THEN round(usd / sum(usd) OVER (), 6) END AS share FROM (
        SELECT {_PROJECT.format(f='s.folder')} AS g, round(coalesce(sum(s.usd), 0), 6) AS usd, CAST(sum(s.tokens) AS BIGINT) AS tokens,
        CAST(sum(s.tokens_without_usd) AS BIGINT) AS unpriced, CAST(sum(s.requests) AS BIGINT) AS requests FROM slc s JOIN per5 p USING (ts) WHERE p.start <= s.ts + 150 GROUP BY 1)"""),
    "slots_outside_periods": _sql("""SELECT count(*) AS slots_outside FROM slc s LEFT JOIN per5 p USING (ts) WHERE (p.start IS NULL OR p.start > s.ts + 150)
        AND s.ts + 150 >= (SELECT start FROM w5h ORDER BY "end", start LIMIT 1)"""),
    "page_projects": f"""SELECT {_PROJECT.format(f='f')} AS project, count(*) AS pages FROM (SELECT '/home/' || regexp_extract(url, '^https?://([^/]+)', 1)
        || CASE WHEN page_id % 3 = 0 THEN '/dev' ELSE '' END || regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1) AS f FROM pages) GROUP BY 1""",
    "revenue_by_month_and_segment": """SELECT strftime(o_orderdate, '%Y-%m') AS month, c_mktsegment, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, count(*) AS lines
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY ROLLUP (strftime(o_orderdate, '%Y-%m'), c_mktsegment)""",
    "latest_reading": _sql(f"""SELECT ts, {_iso('ts')} AS dt, source, machine, CASE WHEN r5 <= 1706563000 THEN 0.0 ELSE p5 END AS five_hour_pct,
        CASE WHEN r5 <= 1706563000 THEN NULL ELSE r5 END AS five_hour_resets_ts, CASE WHEN r7 <= 1706563000 THEN 0.0 ELSE p7 END AS seven_day_pct,
        CASE WHEN r7 <= 1706563000 THEN NULL ELSE r7 END AS seven_day_resets_ts FROM aq ORDER BY ts DESC, ingest_id DESC LIMIT 1"""),
    "newest_age": _sql("SELECT 1706745600 - max(ts) AS age_s FROM aq"),
    "last_attempt": _sql("""SELECT ts, error FROM (SELECT max(written_ts) AS ts, NULL AS error, 0 AS f FROM aq WHERE source = 'claude_api'
        UNION ALL SELECT * FROM (SELECT ts, replace(props, ' ', ''), 1 FROM er ORDER BY ts DESC, ingest_id DESC LIMIT 1)) ORDER BY ts DESC, f DESC LIMIT 1"""),
    "stale_source": _sql("SELECT max(t) AS last_ok_ts, CAST(1706745600 - max(t) >= 1800 AS BIGINT) AS stale FROM e"),
    "key_sets": _sql("SELECT CASE WHEN k % 3 = 0 THEN 'a,' ELSE '' END || CASE WHEN k % 2 = 0 THEN 'b,' ELSE '' END || 'c' AS keys, count(*) AS rows FROM e GROUP BY 1"),
    "rows_per_machine": _sql("SELECT machine, source, count(*) AS rows FROM aq GROUP BY 1, 2"),
    "failure_rates": _sql("""SELECT source, count(*) AS attempts, CAST(sum(f) AS BIGINT) AS failures, round(avg(f), 6) AS failure_rate
        FROM (SELECT source, 0 AS f FROM aq UNION ALL SELECT 'claude_api', 1 FROM er) GROUP BY 1"""),
    "fractional_percents": _sql("""SELECT count(*) AS rows, count(*) FILTER (ingest_id % 2 = 1) AS five_hour_fractional, CAST(0 AS BIGINT) AS seven_day_fractional FROM aq"""),
    "telemetry_lateness": _sql("""SELECT count(*) AS rows, count(*) FILTER (received_ts - ts <= 60) AS within_60_s, count(*) FILTER (received_ts - ts > 900) AS over_15_min,
        max(received_ts - ts) AS max_late_s FROM tm"""),
    "lines_per_request": _sql("""SELECT count(*) AS requests, CAST(sum(n) AS BIGINT) AS lines, round(sum(n) / count(*), 6) AS lines_per_request, max(span) AS max_span_s
        FROM (SELECT request_id, count(*) AS n, max(ts) - min(ts) AS span FROM ln GROUP BY 1)"""),
    "shipping_lateness": """SELECT count(*) AS rows, count(*) FILTER (d <= 60) AS within_60_s, count(*) FILTER (d > 900) AS over_15_min, max(d) AS max_late_s
        FROM (SELECT epoch_us(l_shipdate) // 1000000 - epoch_us(o_orderdate) // 1000000 AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "shared_hashes": _sql("SELECT row_hash FROM sa INTERSECT SELECT row_hash FROM sb"),
    "shared_by_source": _sql("SELECT source, count(DISTINCT row_hash) AS shared FROM sa WHERE row_hash IN (SELECT row_hash FROM sb) GROUP BY 1"),
    "missing_readings": _sql("SELECT ingest_id, row_hash FROM sa WHERE row_hash NOT IN (SELECT row_hash FROM sb)"),
    "machine_labels": _sql("""SELECT CASE WHEN ingest_id % 3 = 0 THEN machine WHEN ingest_id % 10 < 4 THEN 'mac' END AS machine, count(*) AS rows FROM sa GROUP BY 1"""),
    "merged_stores": _sql("""SELECT 'to b' AS way, ingest_id FROM sa WHERE machine = 'm0' AND ingest_id % 10 < 4 UNION ALL
        SELECT 'to a', ingest_id FROM sb WHERE machine = 'm1' AND ingest_id % 10 >= 7"""),
    "compared_facts": _sql("""SELECT count(*) AS old_rows, count(*) FILTER (ingest_id % 11 = 0) AS missing, count(*) FILTER (ingest_id % 11 <> 0 AND ingest_id % 13 = 0) AS different FROM rq"""),
    "compared_by_digests": _sql("""SELECT count(*) AS old_rows, count(*) FILTER (ingest_id % 11 = 0) AS missing, count(*) FILTER (ingest_id % 11 <> 0 AND ingest_id % 13 = 0) AS different FROM rq"""),
    "one_changed_fact": _sql("SELECT count(*) AS old_rows, 0 AS missing, 1 AS different FROM rq"),
    "missing_by_digests": _sql("SELECT ingest_id, row_hash FROM sa WHERE row_hash NOT IN (SELECT row_hash FROM sb)"),
    "slots_recounted": _sql(f"""SELECT counted, count(*) AS requests, CAST(sum({_ALL}) AS BIGINT) AS tokens, round(coalesce(sum(cost_usd), 0), 6) AS usd,
        CAST(coalesce(sum(CASE WHEN cost_usd IS NULL THEN {_ALL} END), 0) AS BIGINT) AS tokens_without_usd
        FROM rows, (VALUES ('slots'), ('requests')) c(counted) WHERE ts < {_END} GROUP BY 1"""),
    "token_mismatches": _sql("""SELECT count(*) AS matched, count(*) FILTER (input_tokens <> ti OR output_tokens <> tout OR cache_read_tokens <> tr
        OR cache_write_5m_tokens + cache_write_1h_tokens <> tc) AS mismatches FROM mt"""),
    "price_errors": _sql(f"""SELECT model, round(median(abs(ours - cost_usd) / cost_usd), 6) AS median_err, count(*) AS n, count(*) FILTER (abs(ours - cost_usd) / cost_usd > 0.01) AS off_by_1_percent,
        round(sum(ours) / sum(cost_usd) - 1, 6) AS total_err FROM (SELECT *, {_usd()} AS ours FROM mt) WHERE ours IS NOT NULL AND cost_usd > 0 GROUP BY 1"""),
    "telemetry_only_cost": _sql("""SELECT query_source, round(coalesce(sum(cost_usd), 0), 6) AS usd, count(*) AS requests,
        round(coalesce(sum(cost_usd), 0) / greatest((SELECT sum(cost_usd) FROM tq), 1e-9), 6) AS share FROM tq WHERE request_id NOT IN (SELECT request_id FROM rq) GROUP BY 1"""),
    "monthly_differences": _sql(f"""SELECT o.month, o.model, {', '.join('o.' + c for c in _RQ)}, round({_usd('o.model')}, 6) AS usd,
        {', '.join(f'CAST(o.{a} = r.{b} AS BIGINT) AS {n}_is_equal, o.{a} - r.{b} AS {n}_abs_diff, CASE WHEN r.{b} <> 0 THEN round((o.{a} - r.{b}) / r.{b}::DOUBLE, 6) END AS {n}_rel_diff'
                   for n, a, b in (('in', 'input_tokens', 'ref_input'), ('out', 'output_tokens', 'ref_output'), ('read', 'cache_read_tokens', 'ref_read')))}
        FROM (SELECT strftime(make_timestamp(ts * 1000000), '%Y-%m') AS month, model, {_sums(_RQ)} FROM rq GROUP BY 1, 2) o
        JOIN (SELECT strftime(make_timestamp(ts * 1000000), '%Y-%m') AS month, model, CAST(sum(input_tokens) AS BIGINT) AS ref_input, CAST(sum(output_tokens) AS BIGINT) AS ref_output,
          CAST(sum(cache_read_tokens) AS BIGINT) AS ref_read FROM rq WHERE ingest_id % 7 <> 0 GROUP BY 1, 2) r USING (month, model)"""),
    "orders_reconciled": """SELECT o_orderstatus, count(*) AS orders, count(*) FILTER (s IS NULL) AS without_lines, count(*) FILTER (o_totalprice = s) AS equal,
        round(sum(o_totalprice - s), 2) AS total_diff, count(*) FILTER (abs((o_totalprice - s) / s) > 0.01) AS off_by_1_percent
        FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1""",
    "median_price_per_flag": "SELECT l_returnflag, round(median(l_extendedprice), 6) AS median, count(*) AS n FROM lineitem GROUP BY 1",
    "priced_lines": """SELECT p_brand AS brand, round(sum((q * p + n * p * 5 + q * p * 0.1::DOUBLE + n * p * 1.25::DOUBLE + q * p * 2.0::DOUBLE) / 1e6), 6) AS usd, CAST(sum(q) AS BIGINT) AS quantity
        FROM (SELECT l_partkey, sum(CAST(l_quantity AS BIGINT)) AS q, sum(l_linenumber) AS n FROM lineitem GROUP BY 1) JOIN (SELECT p_partkey, p_brand, p_retailprice AS p FROM part) ON p_partkey = l_partkey GROUP BY 1""",
    "time_expressions": _sql(f"""SELECT event_id, t AS from_iso, t AS from_text, CAST(NULL AS BIGINT) AS from_blank, strftime(make_timestamp(t * 1000000), '%Y-%m') AS month,
        strftime(make_timestamp(t * 1000000), '%m-%d %H:%M') AS minute, t // 300 * 300 AS slot, k + 1 AS rounded, {_snap('(k * 100)')} AS snapped FROM e WHERE t >= 1704153600 AND t < 1705968000"""),
    "canonical_properties": _sql("SELECT CAST(k % 5 <> 0 AS BIGINT) AS same, count(*) AS rows FROM e GROUP BY 1"),
    "idle_countdown_dropped": _sql("""SELECT * FROM (SELECT event_id, t AS ts, (k % 2)::DOUBLE AS pct, t + 18000 + event_id % 200 - 100 AS resets FROM e)
        WHERE NOT (pct = 0 AND abs(resets - ts - 18000) <= 60)"""),
    "shifted_times": _sql("SELECT event_id, CASE WHEN event_type = 'view' AND t < 1705276800 THEN t - 3600 ELSE t END AS ts FROM e"),
    "one_page": _sql("SELECT ingest_id, machine FROM aq WHERE ingest_id > 500 AND machine = 'm1' ORDER BY ingest_id LIMIT 1000"),
    "slots_by_machine": _sql("SELECT machine, count(*) AS slots, CAST(sum(tokens) AS BIGINT) AS tokens, round(sum(usd), 6) AS usd FROM slc GROUP BY 1"),
    "backed_up": "SELECT 'account_quotas' AS \"table\", count(*) AS copied, count(*) AS rows FROM events",
    "seeded_store": _sql("""SELECT machine, count(*) AS rows FROM (SELECT machine FROM sb UNION ALL SELECT 'mac' FROM sa WHERE ingest_id % 10 < 4) GROUP BY 1"""),
    "slots_from_stream": _sql(f"""SELECT t // 300 * 300 AS ts, {_iso('t // 300 * 300')} AS dt, 'm' || user_id % 3 AS machine, '' AS folder, event_type AS entrypoint, 'm' AS model, count(*) AS requests,
        CAST(sum(k) AS BIGINT) AS input_tokens, CAST(sum(k % 7) AS BIGINT) AS output_tokens, {', '.join(f'CAST(0 AS BIGINT) AS {c}' for c in _TOKENS[2:])},
        round(sum(CASE WHEN k % 3 <> 0 THEN value END), 6) AS usd, CAST(coalesce(sum(CASE WHEN k % 3 = 0 THEN k + k % 7 END), 0) AS BIGINT) AS tokens_without_usd
        FROM e GROUP BY t // 300 * 300, user_id % 3, event_type"""),
    "slots_replicated": _sql("SELECT machine, count(*) AS slots, CAST(sum(requests) AS BIGINT) AS requests FROM sl WHERE machine = 'm1' GROUP BY 1"),
    "costs_from_two_streams": _sql("""SELECT 'm' || user_id % 3 AS machine, count(*) AS requests, count(*) FILTER (k % 3 <> 0) AS with_cost,
        round(sum(value) FILTER (k % 3 <> 0), 6) AS usd FROM e GROUP BY 1"""),
}
ORACLE["repeats_dropped_in_stream"] = ORACLE["repeats_dropped"]


def _marks(table, value, name, where="TRUE"):
    pick = lambda f: f"list_sort(list({value}))[CAST(round_even({f} * (count(*) - 1), 0) AS BIGINT) + 1]"
    return f"""SELECT plan, count(*) AS n_{name}, {', '.join(f'round({pick(f)}, 6) AS {name}_p{p}' for f, p in ((0.5, 50), (0.1, 10), (0.9, 90)))} FROM {table} WHERE {where} GROUP BY 1"""


ORACLE["plan_summary"] = _sql(f"""SELECT plan, coalesce(n_b_5h, 0) AS n_5h, b_5h_p50, b_5h_p10, b_5h_p90, coalesce(n_b_7d, 0) AS n_7d, b_7d_p50, b_7d_p10, b_7d_p90,
    coalesce(n_per_week, 0) AS n_ratio, per_week_p50, per_week_p10, per_week_p90, per_week_summed
    FROM (SELECT DISTINCT plan FROM w5h) LEFT JOIN ({_marks('b5h', 'b', 'b_5h', 'b <> 0 AND peak >= 30')}) USING (plan)
    LEFT JOIN ({_marks('b7d', 'b', 'b_7d', 'b <> 0 AND peak >= 30')}) USING (plan) LEFT JOIN ({_marks('wk', 'ratio', 'per_week')}) USING (plan)
    LEFT JOIN (SELECT plan, round(sum(gain_5h) / sum(gain_7d), 6) AS per_week_summed FROM wk GROUP BY 1) USING (plan)""")

# The same analyses over every event, where those above take a range or some kinds of events.
ORACLE |= {
    "totals_5m_of_all_scans": _sql(f"""SELECT ts // 300 * 300 AS slot_ts, {_iso('ts // 300 * 300')} AS slot_dt, folder, CAST(entrypoint = 'cli' AS BIGINT) AS interactive,
        count(*) AS requests, round(sum(usd), 9) AS usd, {_sums(['input_tokens', 'output_tokens', 'cache_read_tokens', 'cache_write_tokens'])},
        CAST(ts // 300 * 300 + 300 <= (SELECT max(t) - 900 FROM e) AS BIGINT) AS final
        FROM ur GROUP BY ts // 300 * 300, folder, entrypoint = 'cli'"""),
    "spend_per_interval_of_all": _sql("""SELECT ingest_id, session_id, ts, session_cost_usd, prev_cost,
        CASE WHEN session_cost_usd < coalesce(prev_cost, 0) THEN session_cost_usd ELSE session_cost_usd - coalesce(prev_cost, 0) END AS spent_usd
        FROM (SELECT *, lag(session_cost_usd) OVER (PARTITION BY session_id ORDER BY ts, ingest_id) AS prev_cost
          FROM (SELECT event_id AS ingest_id, 's' || user_id % 40 AS session_id, t AS ts, (k // 25) / 4.0::DOUBLE AS session_cost_usd FROM e))"""),
    "payloads_of_all_dated": _sql("""SELECT event_id, user_id AS session, t, (SELECT max(a.t + a.k + 1) FROM e a WHERE a.user_id = p.user_id AND a.t + a.k + 1 <= p.t) AS observed_at FROM e p"""),
    "payloads_dated_on_arrival": _sql("""SELECT event_id, user_id AS session, t, (SELECT max(a.t + a.k + 1) FROM e a WHERE a.user_id = p.user_id AND a.t + a.k + 1 <= p.t) AS observed_at FROM e p"""),
    "time_expressions_of_all": _sql(f"""SELECT event_id, t AS from_iso, t AS from_text, CAST(NULL AS BIGINT) AS from_blank, strftime(make_timestamp(t * 1000000), '%Y-%m') AS month,
        strftime(make_timestamp(t * 1000000), '%m-%d %H:%M') AS minute, t // 300 * 300 AS slot, k + 1 AS rounded, {_snap('(k * 100)')} AS snapped FROM e"""),
}
