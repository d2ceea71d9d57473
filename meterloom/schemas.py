"""Declared table schemas (DDL). Readers never infer; a column a file lacks comes back NULL."""

ACCOUNT_QUOTAS = """ingest_id LONG, ts LONG, dt STRING, source STRING, five_hour_pct DOUBLE, five_hour_resets_ts LONG,
    seven_day_pct DOUBLE, seven_day_resets_ts LONG, observed_by_session STRING, written_ts LONG, raw STRING,
    row_hash STRING, machine STRING"""
POLL_ERRORS = """ingest_id LONG, ts LONG, dt STRING, source STRING, stage STRING, type STRING, status INT,
    retry_after_s INT, raw STRING, row_hash STRING"""
SESSION_SNAPSHOTS = """ingest_id LONG, ts LONG, dt STRING, session_id STRING, model_id STRING, session_cost_usd DOUBLE,
    prompt_cache STRING, written_ts LONG, raw STRING, row_hash STRING"""
TELEMETRY = """ingest_id LONG, ts LONG, dt STRING, event STRING, session_id STRING, request_id STRING, model STRING,
    query_source STRING, input_tokens LONG, output_tokens LONG, cache_read_tokens LONG, cache_creation_tokens LONG,
    cost_usd DOUBLE, received_ts LONG, raw STRING, row_hash STRING"""
REQUESTS = """ingest_id LONG, ts LONG, dt STRING, request_id STRING, session_id STRING, folder STRING,
    entrypoint STRING, model STRING, input_tokens LONG, output_tokens LONG, cache_read_tokens LONG,
    cache_write_5m_tokens LONG, cache_write_1h_tokens LONG"""
TURNS = """ingest_id LONG, ts LONG, dt STRING, request_id STRING, machine STRING, session_id STRING, folder STRING,
    entrypoint STRING, model STRING, input_tokens LONG, output_tokens LONG, cache_read_tokens LONG,
    cache_write_5m_tokens LONG, cache_write_1h_tokens LONG, usd DOUBLE"""
SCANS = "ts LONG, dt STRING, complete_through_ts LONG, requests_added LONG"
SLOTS = """ts LONG, dt STRING, machine STRING, folder STRING, entrypoint STRING, model STRING, requests LONG,
    input_tokens LONG, output_tokens LONG, cache_read_tokens LONG, cache_write_5m_tokens LONG,
    cache_write_1h_tokens LONG, cache_write_unknown_tokens LONG, usd DOUBLE, tokens_without_usd LONG, written_ts LONG"""
SLOT_KEY = ["ts", "machine", "folder", "entrypoint", "model"]

# JSON shapes of the landed logs: only the fields a job reads, so the parser skips the rest.
TRANSCRIPT_LINE = """type STRING, timestamp STRING, requestId STRING, sessionId STRING, cwd STRING, entrypoint STRING,
    message STRUCT<id: STRING, model: STRING, usage: STRUCT<input_tokens: LONG, output_tokens: LONG,
        cache_read_input_tokens: LONG, cache_creation_input_tokens: LONG,
        cache_creation: STRUCT<ephemeral_5m_input_tokens: LONG, ephemeral_1h_input_tokens: LONG>>>"""
TURN_LINE = """timestamp STRING, type STRING, payload STRUCT<id: STRING, cwd: STRING, source: STRING, model: STRING,
    type: STRING, info: STRUCT<
        total_token_usage: STRUCT<total_tokens: LONG, input_tokens: LONG, cached_input_tokens: LONG, output_tokens: LONG>,
        last_token_usage: STRUCT<input_tokens: LONG, cached_input_tokens: LONG, cache_write_input_tokens: LONG,
            output_tokens: LONG>>>"""
COST_STATE_LINE = """type STRING, sessionId STRING, totalCostUSD DOUBLE, totalDuration LONG, startTime LONG,
    modelUsage MAP<STRING, STRUCT<inputTokens: LONG, outputTokens: LONG, cacheReadInputTokens: LONG,
        cacheCreationInputTokens: LONG, costUSD: DOUBLE>>"""
REFUSAL_LINE = """type STRING, timestamp STRING, sessionId STRING,
    quotaLimits STRUCT<status: STRING, rateLimitType: STRING, resetsAt: STRING>"""
_WRAPPED = """STRUCT<stringValue: STRING, intValue: STRING, doubleValue: DOUBLE, boolValue: BOOLEAN, arrayValue: VARIANT,
    kvlistValue: VARIANT>"""
_ATTRIBUTES = f"ARRAY<STRUCT<key: STRING, value: {_WRAPPED}>>"
OTLP_BATCH = f"""resourceLogs ARRAY<STRUCT<resource: STRUCT<attributes: {_ATTRIBUTES}>, scopeLogs: ARRAY<STRUCT<logRecords:
    ARRAY<STRUCT<timeUnixNano: STRING, body: STRUCT<stringValue: STRING>, attributes: {_ATTRIBUTES}>>>>>>"""
PLAN_HISTORY = """ts LONG, source STRING, plan_limit_history STRUCT<data_as_of: STRING, periods: ARRAY<STRUCT<
    window_minutes: INT, starts_at: STRING, ends_at: STRING, used_basis_points: DOUBLE, accounting_complete: BOOLEAN>>>"""
DAILY_BUCKETS = "ts LONG, source STRING, codex_usage STRUCT<dailyUsageBuckets: ARRAY<STRUCT<startDate: STRING, tokens: LONG>>>"
BREAKDOWN = """ts LONG, source STRING, api STRUCT<seven_day_breakdown: STRUCT<as_of: STRING, window_started_at: STRING,
    `rows`: ARRAY<STRUCT<key: STRING, display_name: STRING, percent: DOUBLE>>>>"""
SNAPSHOT_LINE = """ts VARIANT, observed_at VARIANT, model_id STRING, session_cost_usd VARIANT, prompt_cache VARIANT"""
TELEMETRY_LINE = """source STRING, observed_at VARIANT, received_at VARIANT, event STRING, attributes STRUCT<`session.id`: STRING,
    request_id: STRING, model: STRING, query_source: STRING, input_tokens: VARIANT, output_tokens: VARIANT,
    cache_read_tokens: VARIANT, cache_creation_tokens: VARIANT, cost_usd: VARIANT>"""
READING_LINE = """ts VARIANT, source STRING, observed_at VARIANT, five_hour_pct VARIANT, five_hour_resets_at VARIANT,
    seven_day_pct VARIANT, seven_day_resets_at VARIANT, observed_by_session STRING, machine STRING,
    api STRUCT<five_hour: STRUCT<utilization: VARIANT, resets_at: VARIANT>,
        seven_day: STRUCT<utilization: VARIANT, resets_at: VARIANT>>,
    codex_rate_limits STRUCT<rateLimits: STRUCT<
        primary: STRUCT<windowDurationMins: INT, usedPercent: VARIANT, resetsAt: VARIANT>,
        secondary: STRUCT<windowDurationMins: INT, usedPercent: VARIANT, resetsAt: VARIANT>>>,
    error VARIANT, session_cost_usd VARIANT, prompt_cache VARIANT, session_id VARIANT"""
PAYLOAD = """transcript_path STRING, session_id STRING, model STRUCT<id: STRING>, cost STRUCT<total_cost_usd: STRING>,
    prompt_cache VARIANT, rate_limits STRUCT<
        five_hour: STRUCT<used_percentage: DOUBLE, resets_at: STRING>,
        seven_day: STRUCT<used_percentage: DOUBLE, resets_at: STRING>>"""
