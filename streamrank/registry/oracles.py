"""DuckDB SQL that gives what each registered query gives."""

from __future__ import annotations

from .batch import MARKER, UPDATE_DATE

PAGE = "json_extract_string(props, '$.k')"
INDUSTRY = "'i' || (user_id % 5)"
PROJECT = "'p' || (user_id % 5)"
CHANNEL = "case when user_id % 3 <> 0 then 'H5' end"
EVENT = "case event_type when 'view' then 'viewProduct' when 'click' then 'searchProduct' end"
# What separates words: anything but letters, letter-like numbers, marks, digits,
# connector punctuation and the two join controls.
NOT_WORD = r"[^\p{L}\p{Nl}\p{M}\p{Nd}\p{Pc}\x{200C}\x{200D}]+"


def bucket(width: str, ts: str = "ts") -> str:
    return f"time_bucket(interval '{width}', {ts})"


def message(event: str, field: str) -> str:
    return f"""
        '{{"data":{{"project":"' || {PROJECT} || '","event":"{event}","properties":{{'
        || case when user_id % 3 <> 0 then '"channel":"H5",' else '' end
        || '"{field}":"' || {PAGE} || '"}}}},"ip":"127.0.0.1"}}'"""


MESSAGES = f"""
    select event_id, case event_type
        when 'view' then {message('viewProduct', 'product_id')}
        when 'click' then {message('searchProduct', 'search_word')}
        when 'purchase' then {message('buy', 'product_id')}
        when 'signup' then '{{"ip":"127.0.0.1"}}'
        else 'not json ' || {PAGE} end as value
    from events"""

VIEWS = f"""
    select user_id::varchar as "user", {PAGE} as page, {INDUSTRY} as industry,
        event_type as flags, epoch_us(ts) as ts_us
    from events"""

PAGE_COUNTS = f"""
    select {PAGE} as page, {INDUSTRY} as industry, {bucket('1 hour')} as hour, count(*) as n
    from events where contains(event_type, '{MARKER}') group by all"""

TOP_PAGES = f"""
    select industry, epoch_ms(hour) as window_start,
        string_agg(page, chr(10) order by position) || chr(10) as pages
    from (select *, row_number() over (partition by industry, hour order by n desc, page) as position
          from ({PAGE_COUNTS}))
    where position <= 100 group by industry, hour"""

RANKS = f"""
    select event_id, {EVENT} as rank_type, {PAGE} as rank_id, {PROJECT} as user_project,
        {CHANNEL} as rank_channel, ts
    from events where event_type in ('view', 'click')"""

RANK_COUNTS = f"""
    select rank_type, rank_id, user_project, rank_channel, {bucket('1 minute')} as minute, count(*) as n
    from ({RANKS}) group by all"""

RANK_STREAM = f"""
    select rank_type, rank_id, user_project, rank_channel, n as rank_value,
        epoch_ms(minute) as window_start, epoch_ms(minute) + 60000 as window_end,
        '{{' || fields || '}}' as "key", '{{' || fields || ',"rank_value":' || n || '}}' as value
    from (select *, '"rank_type":"' || rank_type || '","rank_id":"' || rank_id
            || '","user_project":"' || user_project || '"'
            || coalesce(',"rank_channel":"' || rank_channel || '"', '') as fields
          from ({RANK_COUNTS}))"""

SEARCH_WORDS = f"""
    select project, search_word, n as "count", epoch_ms(slot) as window_start,
        epoch_ms(slot) + 30000 as window_end,
        '{{"project":"' || project || '","search_word":"' || search_word || '"}}' as "key",
        '{{"project":"' || project || '","search_word":"' || search_word || '","count":' || n || '}}' as value
    from (select {PROJECT} as project, {PAGE} as search_word, {bucket('30 seconds')} as slot, count(*) as n
          from events where event_type = 'click' group by all)"""

HOPPING = f"""
    select event_type || '@' || epoch_ms(start) || '->' || (epoch_ms(start) + 300000) as label,
        count(*) as "count"
    from (select event_type, unnest([{bucket('1 minute')} - i * interval '1 minute' for i in range(5)]) as start
          from events)
    group by event_type, start"""

SESSIONS = """
    select user_id || '@' || (epoch_us(min(ts)) // 1000) || '->' || (epoch_us(max(ts)) // 1000) as label,
        count(*) as "count"
    from (select user_id, ts, sum(opens) over (partition by user_id order by ts
              rows between unbounded preceding and current row) as session
          from (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts)
                    <= interval '30 minutes' then 0 else 1 end as opens from events))
    group by user_id, session"""

WORDS = f"""
    select unnest(case when len(pieces) > 1 and pieces[-1] = ''
        then case when len(pieces) = 2 and pieces[1] = '' then [] else pieces[:-2] end
        else pieces end) as word
    from (select regexp_split_to_array(lower(line), '{NOT_WORD}') as pieces
          from (select unnest(string_split(text, chr(10))) as line from documents))"""

RANK_TABLE = f"""
    select user_project, rank_type, rank_id, coalesce(rank_channel, '') as rank_channel,
        null::varchar as rank_name, sum(n)::bigint as rank_value, {{update_date}} as update_date
    from ({RANK_COUNTS}) group by user_project, rank_type, rank_id, coalesce(rank_channel, '')"""

NAMED_RANK_TABLE = """
    select user_project, rank_type, rank_id, coalesce(rank_channel, '') as rank_channel,
        max(case when {half} then null else 'name of ' || rank_id end) as rank_name,
        sum(n)::bigint as rank_value, max(case when {half} then {later} else {earlier} end)::bigint as update_date
    from ({counts}) group by user_project, rank_type, rank_id, coalesce(rank_channel, '')"""

HALF = "minute >= timestamp '2024-01-16 12:00:00'"
TWO_DELIVERIES = RANK_TABLE.format(
    update_date=f"max(case when {HALF} then {UPDATE_DATE + 1} else {UPDATE_DATE} end)::bigint"
)

LANDED = """
    select strftime(ts, '%Y%m%d') as day, strftime(ts, '%H') as hour, event_type as topic, props as value
    from events"""

CHANGES = f"""
    select page, industry, epoch_ms(hour) as window_start, epoch_ms(slot) + 10000 as committed,
        nullif(total - n, 0)::bigint as old_count, total::bigint as new_count
    from (select *, sum(n) over (partition by page, industry, hour order by slot
              rows between unbounded preceding and current row) as total
          from (select {PAGE} as page, {INDUSTRY} as industry, {bucket('1 hour')} as hour,
                    {bucket('10 seconds')} as slot, count(*) as n
                from events where contains(event_type, '{MARKER}') group by all))"""


def tumbling(width: str, milliseconds: int) -> str:
    return f"""
        select event_type, epoch_ms(w) as window_start, epoch_ms(w) + {milliseconds} as window_end,
            count(*) as "count"
        from (select event_type, {bucket(width)} as w from events) group by event_type, w"""


def long_hex(value: str) -> str:
    return f"lpad(to_hex({value}), 16, '0')"


SNAPSHOT = "select event_type as \"key\", count(*)::varchar as value from events group by event_type"
SNAPSHOT_REPORTS = """
    select event_type as "key", epoch_ms(second) + 1000 as tick_ms,
        (sum(n) over (partition by event_type order by second))::bigint::varchar as value
    from (select event_type, date_trunc('second', ts) as second, count(*) as n from events group by all)"""
HEARTBEATS = """
    with slots as (
        select user_id, epoch_ms(time_bucket(interval '1 hour', ts)) + 3600000 as tick, count(*) as n
        from events group by all),
    lives as (
        select *, sum(opens) over (partition by user_id order by tick) as life
        from (select *, case when tick - lag(tick) over (partition by user_id order by tick) <= 21600000
                  then 0 else 1 end as opens from slots)),
    ticks as (
        select user_id, life, unnest(range(min(tick), max(tick) + 21600001, 3600000)) as tick_ms
        from lives group by user_id, life)
    select t.user_id::varchar as "key", t.tick_ms, sum(l.n)::bigint::varchar as value
    from ticks t join lives l on l.user_id = t.user_id and l.life = t.life and l.tick <= t.tick_ms
    group by t.user_id, t.life, t.tick_ms"""
REGROUPED = """
    select grp, string_agg(item, ',' order by n desc, item) as users,
        string_agg(n::varchar, ',' order by n desc, item) as amounts
    from (select *, row_number() over (partition by grp order by n desc, item) as place
          from (select user_id::varchar as item, arg_max(event_type, (ts, event_id)) as grp, count(*) as n
                from events group by user_id))
    where place <= 20 group by grp"""
WORD_COUNT = f'select word, count(*) as "count" from ({WORDS}) group by word'

ORACLES = {
    "source_typed_kv": 'select event_type as "key", event_id - 5000 as value from events',
    "source_pageviews": VIEWS,
    "multi_topic_scan": """
        select event_type as topic, (user_id % 8)::integer as "partition", event_id as "offset",
            user_id::varchar as "key", props as value, epoch_us(ts) as ts_us from events
        where event_type in ('click', 'purchase', 'view')""",
    "next_offset_per_partition": """
        select event_type as topic, (user_id % 8)::integer as "partition", max(event_id) + 1 as next_offset
        from events group by all""",
    "filter_article_views": f"select * from ({VIEWS}) where contains(flags, '{MARKER}')",
    "rekey_article_views": f"""
        select 'user' as "user", page, industry, null::varchar as flags
        from ({VIEWS}) where contains(flags, '{MARKER}')""",
    "json_shape_guard": f"select * from ({MESSAGES}) where not starts_with(value, 'not json')",
    "json_event_search_only": "select event_id, 'searchProduct' as event from events where event_type = 'click'",
    "json_event_rank_types": f"select event_id, {EVENT} as event from events where event_type in ('view', 'click')",
    "search_word_projection": f"""
        select event_id, {PROJECT} as project, {PAGE} as search_word from events where event_type = 'click'""",
    "rank_record_projection": f"select * exclude (ts) from ({RANKS})",
    "table_filter_not_null": f"select * exclude (ts) from ({RANKS}) where rank_channel is not null",
    "tumbling_count_1h": tumbling("1 hour", 3_600_000),
    "tumbling_count_1m": tumbling("1 minute", 60_000),
    "tumbling_count_30s": tumbling("30 seconds", 30_000),
    "hopping_count_labelled": HOPPING,
    "session_count_labelled": SESSIONS,
    "windowed_key_print": f"""
        select event_type || '>' || window_start || '=' || "count" as line
        from ({tumbling('1 hour', 3_600_000)})""",
    "stats_selector": f"""
        select industry as group_key, epoch_ms(hour) as window_start, 'user' as "user", page, industry,
            n as "count" from ({PAGE_COUNTS})""",
    "count_changelog_10s": CHANGES,
    "retractable_collect": f"""
        select industry, epoch_ms(hour) as window_start, page, n as "count",
            rank() over (partition by industry, hour order by n desc) as rank from ({PAGE_COUNTS})""",
    "take_first_per_group": f"""
        select industry, epoch_ms(hour) as window_start, page, n as "count" from ({PAGE_COUNTS})
        qualify row_number() over (partition by industry, hour order by n desc, page) = 1""",
    "top_pages_per_industry_hour": TOP_PAGES,
    "topic_windowed_text": f"""
        select hex(industry) || {long_hex('window_start')} as key_hex, industry, window_start, pages
        from ({TOP_PAGES})""",
    "topic_keyed_longs": f'select label as "key", {long_hex(chr(34) + "count" + chr(34))} as value_hex from ({SESSIONS})',
    "rank_stream_1m": RANK_STREAM,
    "search_word_rank_30s": SEARCH_WORDS,
    "tokenize_lines": WORDS,
    "word_count": WORD_COUNT,
    "state_snapshot": SNAPSHOT,
    "common_rank_rows": f"""
        select user_project, rank_type, rank_id, coalesce(rank_channel, '') as rank_channel,
            null::varchar as rank_name, n as rank_value, {UPDATE_DATE}::bigint as update_date
        from ({RANK_COUNTS})""",
    "upsert_accumulate_common_rank": NAMED_RANK_TABLE.format(
        half=HALF, later=UPDATE_DATE + 1, earlier=UPDATE_DATE, counts=RANK_COUNTS),
    "uuid_header": "select count(*) as records, count(*) as ids, 36 as shortest, 36 as longest from events",
    "landing_rows": LANDED,
    "landing_written": LANDED,
    "landing_replayed": f"select day, '00' as hour, topic, value from ({LANDED})",
    "resumed_scan": """
        select event_type as topic, (user_id % 8)::integer as "partition", event_id as "offset", props as value
        from events""",
    "stored_window_counts": tumbling("1 hour", 3_600_000),
    "landing_with_uuid": "select count(*) as records, count(*) as ids, count(*) as distinct_ids from events",
    "idempotent_batch_write": MESSAGES,
    "rank_table_replayed": TWO_DELIVERIES,
    "batched_commit_scan": MESSAGES,
    "stream_tumbling_count_1h": tumbling("1 hour", 3_600_000),
    "stream_top_pages_per_industry_hour": TOP_PAGES,
    "stream_rank_1m": RANK_STREAM,
    "stream_search_word_rank_30s": SEARCH_WORDS,
    "stream_hopping_count_labelled": HOPPING,
    "stream_session_count_labelled": SESSIONS,
    "stream_word_count": WORD_COUNT,
    "stream_state_snapshot": SNAPSHOT_REPORTS,
    "stream_top_pages_live": TOP_PAGES,
    "stream_sessions_live": SESSIONS,
    "stream_hopping_live": HOPPING,
    "stream_heartbeat": HEARTBEATS,
    "stream_regrouped_lists": REGROUPED,
    "stream_rank_table": RANK_TABLE.format(update_date=f"{UPDATE_DATE}::bigint"),
}
