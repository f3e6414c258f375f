"""The registered queries as plain SQL over the given tables."""

from __future__ import annotations

from ladderlake.schemas import MATCH_COLUMNS, MATCH_COUNT_FIELDS

_STANDINGS = """
standings as (
  select p.p_partkey as player_id, p.p_name as player_name, p.p_type as tier,
         p.p_brand as division, p.p_retailprice as points,
         cast(sum(case when l_returnflag = 'N' then 1 else 0 end) as bigint) as wins,
         cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as losses
  from part p left join lineitem l on l.l_partkey = p.p_partkey
  group by all)
"""

_RANKED = """
ranked as (
  select *, row_number() over (
      partition by tier, division
      order by points desc nulls last, rate desc nulls last, player_id) as rn
  from (select *, case when wins + losses = 0 then null else wins / (wins + losses) end as rate
        from standings where wins + losses >= {min_games}))
"""

_TOP = f"with {_STANDINGS}, {_RANKED.format(min_games=20)}, top as (select * from ranked where rn <= 2) "
_ALL = f"with {_STANDINGS} "

_FACTS = """
facts as (
  select l_orderkey as match_id, l_partkey as player_id, l_linenumber as slot,
         l_linestatus as team, l_returnflag = 'N' as win, l_quantity as gold,
         l_extendedprice as damage
  from lineitem)
"""

_OUTER = """
outer_facts as (
  select cast(match_id as varchar) as "matchId", player_id, slot, team, win, gold, damage from facts
  union all
  select cast(o_orderkey as varchar), null, null, null, null, null, null
  from orders where o_orderkey not in (select l_orderkey from lineitem))
"""

_FIGURES = """count({c}) as n, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as stddev,
  cast(min({c}) as double) as min_value, cast(max({c}) as double) as max_value"""

_STANDINGS_ROWS = _ALL + "select * from standings"


def _history(player: str) -> str:
    return f"""
history as (
  select distinct l.{player} as player_id, o.o_orderkey as match_id, o.o_orderdate as ts,
         o.o_orderpriority as match_type
  from lineitem l join orders o on o.o_orderkey = l.l_orderkey)
"""


_PERIOD = """match_type = '1-URGENT' and ts between timestamp '1996-01-01 00:00:00'
  and timestamp '1998-12-31 23:59:59'"""


def _null_profile(source: str, columns: dict[str, str]) -> str:
    parts = [
        f"""select '{name}' as column_name, count(*) filter (where {test}) as null_count,
  round(count(*) filter (where {test}) * 100.0 / count(*), 6) as null_pct from {source}"""
        for name, test in columns.items()
    ]
    return " union all ".join(parts)


_LANDED = {
    "matchId": "cast(l_orderkey as varchar)",
    "puuid": "'p' || l_partkey",
    "summonerId": "'s' || l_suppkey",
    "championName": "l_returnflag || '-' || l_linestatus",
    "role": "l_linestatus",
    "goldEarned": "cast(l_quantity as bigint)",
    "totalDamageDealt": "cast(floor(l_extendedprice) as bigint)",
    "teamId": "cast(l_linenumber as bigint)",
    "win": "l_returnflag = 'N'",
}


def _landed_columns(names) -> str:
    def expression(name):
        if name in _LANDED:
            return _LANDED[name]
        return "cast(-1 as bigint)"

    return ", ".join(f'{expression(n)} as "{n}"' for n in names)


def _full_columns() -> str:
    counts = {
        name: f"cast(l_quantity as bigint) * {k} + l_linenumber"
        for k, name in enumerate(MATCH_COUNT_FIELDS, start=1)
    }
    return ", ".join(f'{counts.get(n) or _LANDED[n]} as "{n}"' for n in MATCH_COLUMNS)


_LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}

_TABLE_TYPES = {
    "customer": {
        "custkey": "bigint",
        "name": "string",
        "nationkey": "int",
        "acctbal": "double",
        "mktsegment": "string",
    },
    "nation": {"nationkey": "int", "name": "string", "regionkey": "int"},
    "part": {
        "partkey": "bigint",
        "name": "string",
        "brand": "string",
        "type": "string",
        "size": "int",
        "retailprice": "double",
    },
    "region": {"regionkey": "int", "name": "string"},
    "supplier": {"suppkey": "bigint", "name": "string", "nationkey": "int", "acctbal": "double"},
}


def _schema_drift() -> str:
    listing = " union all ".join(
        f"select '{t}' as t, '{c}' as column_name, '{k}' as k, (select count(*) from {t}) as n"
        for t, columns in _TABLE_TYPES.items()
        for c, k in columns.items()
    )
    return f"""
with listing as ({listing})
select column_name, string_agg(distinct t, ',' order by t) as tables,
  string_agg(distinct k, ',' order by k) as data_types, count(*) as table_count,
  cast(sum(n) as bigint) as row_count,
  count(*) < {len(_TABLE_TYPES)} or count(distinct k) > 1 as drifts
from listing group by column_name"""


def _top_events(n: int) -> str:
    return f"""
    select event_type, value, event_id, rn from (select *, row_number() over (
      partition by event_type order by value desc nulls last, event_id) as rn from events)
    where rn <= {n}"""


_ORDER_MATCHES = """select upper(o_orderstatus) as tier, cast(o_orderkey as varchar) as "matchId",
    'p' || k || '-' || o_custkey as puuid, cast(floor(o_totalprice) + k as bigint) as "goldEarned"
    from orders, (values (0), (1)) v(k) """

# Page 4 lands two records for each player, one of which does not fit.
_FLAWED = """with landed as (
  select p_size as page, case p_size when 1 then 'broken' when 2 then 'empty' when 3 then 'misfit'
    else 'kept' end as reason from part
  union all select p_size, 'misfit' from part where p_size = 4) """

_RESUME = """
    select case p_type when 'STANDARD' then 'platinum' else lower(p_type) end as folder,
      cast(max(p_size // 10) + 1 as int) as next_page,
      count(distinct p_size // 10) as page_count,
      cast(max(p_size // 10) - min(p_size // 10) + 1 - count(distinct p_size // 10) as bigint)
        as absent_pages
    from part group by 1
    union all select 'none', 1, 0, 0"""

_DRIFT = """with pages as (
  select p_type as tier, p_size, cast(date '2024-01-01' + cast(p_size as int) as varchar) as day from part),
fields as (
  select tier, day, 'season' as field, if(tier = 'PROMO', 'STRING', 'BIGINT') as kind from pages
  union all select tier, day, 'rate', if(p_size % 2 = 0, 'BIGINT', 'DECIMAL') from pages
  union all select tier, day, 'mini', 'OBJECT' from pages where p_size > 10
  union all select tier, day, 'mini.size', 'BIGINT' from pages where p_size > 10),
types as (
  select tier, field, kind, count(*) as n, min(day) as first_day, max(day) as last_day
  from fields group by 1, 2, 3) """

SQL: dict[str, str] = {
    "top_n_players": _TOP
    + "select tier, division, player_id, points, round(rate, 6) as win_percentage, rn from top",
    "rank_players": f"with {_STANDINGS}, {_RANKED.format(min_games=0)} "
    "select tier, division, player_id, points, round(rate, 6) as win_percentage, rn from ranked",
    "top_n_hundred": _top_events(100),
    "top_n_large": _top_events(1500),
    "win_rate": _ALL
    + """select player_id, wins, losses, round(case when wins + losses = 0 then null
    else wins / (wins + losses) end, 6) as win_percentage from standings""",
    "min_games_filter": _ALL + "select * from standings where wins + losses >= 20",
    "player_lookup": _ALL + "select * from standings where player_name = 'red widget'",
    "names_to_players": """select p_partkey as player_id, p_name as player_name from part
    where p_name in (select p_name from part where p_size = 50)""",
    "project_cols": "select l_orderkey as match_id, l_extendedprice as damage from lineitem",
    "tier_slice": _ALL + "select * from standings where tier = 'PROMO'",
    "count_by_tier": "select p_type as tier, count(*) as player_count from part group by 1",
    "distinct_players": "select count(distinct l_partkey) as player_count from lineitem",
    "distinct_tiers": "select distinct p_type as tier from part",
    "row_count": "select count(*) as row_count from lineitem",
    "describe_metric": "select 'damage' as column_name, "
    + _FIGURES.format(c="l_extendedprice")
    + " from lineitem",
    "describe_strings": " union all ".join(
        f"""select '{name}' as summary, round(cast({f.format('l_quantity')} as double), 4) as gold,
        round(cast({f.format('l_extendedprice')} as double), 4) as damage from lineitem"""
        for name, f in (
            ("count", "count({})"),
            ("mean", "avg({})"),
            ("stddev", "stddev_samp({})"),
            ("min", "min({})"),
            ("max", "max({})"),
        )
    ),
    "describe_by_tier": "select l_returnflag || l_linestatus as tier, "
    + _FIGURES.format(c="l_extendedprice")
    + " from lineitem group by 1",
    "numeric_columns_profile": " union all ".join(
        f"select '{c}' as column_name, {_FIGURES.format(c=c)} from lineitem"
        for c, k in _LINEITEM_TYPES.items()
        if k in ("bigint", "double")
    ),
    "null_percentages": f"with {_FACTS}, {_OUTER} "
    + _null_profile(
        "outer_facts",
        {
            c: f'"{c}" is null'
            for c in ("matchId", "player_id", "slot", "team", "win", "gold", "damage")
        },
    ),
    "null_or_nan_count": """with e as (select event_id, ts, user_id, event_type,
    case when event_type = 'error' then cast('nan' as double) else value end as value, props
    from events) """
    + _null_profile(
        "e",
        {
            "event_id": "event_id is null",
            "ts": "ts is null",
            "user_id": "user_id is null",
            "event_type": "event_type is null",
            "value": "value is null or isnan(value)",
            "props": "props is null",
        },
    ),
    "union_tiers": _STANDINGS_ROWS,
    "union_with_drift": """
    select c_name as name, c_nationkey as nationkey, c_acctbal as acctbal, c_mktsegment as segment
    from customer union all select s_name, s_nationkey, s_acctbal, null from supplier""",
    "union_same_layout": """select c_name as name, c_acctbal as acctbal from customer
    union all select s_name, s_acctbal from supplier""",
    "explode_participants": f"with {_FACTS} "
    + """select cast(match_id as varchar) as "matchId", player_id, slot, team, win, gold, damage
    from facts""",
    "explode_outer_participants": f"with {_FACTS}, {_OUTER} "
    + """select "matchId", coalesce(player_id, -1) as player_id, coalesce(slot, -1) as slot,
    coalesce(cast(win as int), -1) as win, team, gold, damage from outer_facts""",
    "match_facts": f"select {_full_columns()} from lineitem",
    "match_facts_stored": f"select {_full_columns()} from lineitem",
    "explode_stored_docs": """select cast(l_orderkey as varchar) as "matchId",
    l_partkey as player_id, l_extendedprice as damage from lineitem""",
    "json_scan_standings": _STANDINGS_ROWS,
    "json_scan_inferred": _STANDINGS_ROWS,
    "json_roundtrip": """select event_id, coalesce(k, -1) as k,
    '{"event_id":' || event_id || ',"k":' || coalesce(cast(k as varchar), 'null') || '}' as doc
    from (select event_id, case when event_id % 10 > 0
      then cast(json_extract(props, '$.k') as bigint) end as k from events)""",
    "json_text_roundtrip": "select doc_id, text from documents",
    "table_scan": "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'",
    "overwrite_roundtrip": _STANDINGS_ROWS,
    "partition_overwrite": _ALL
    + """select player_id, player_name, tier, division,
    round(points + case when tier = 'PROMO' then 1 else 0 end, 6) as points, wins, losses
    from standings""",
    "csv_roundtrip": _STANDINGS_ROWS,
    "csv_documents": "select doc_id, text, lang, source, n_chars from documents",
    "table_layout": "select l_orderkey, l_linenumber, l_returnflag, l_extendedprice from lineitem",
    "republish_shrunk": _ALL + "select * from standings where tier <> 'PROMO'",
    "partition_new_field": _ALL
    + """select player_id, tier, case when tier = 'PROMO' then wins + 1 else -1 end as season
    from standings""",
    "bronze_all_fields": _ALL
    + "select player_id, tier, points, p_size from standings join part on p_partkey = player_id",
    "published_versions": _ALL
    + """select player_id, player_name, tier, division,
      round(points + case when tier = 'PROMO' then 1 else 0 end, 6) as points, wins, losses
    from standings where tier <> 'ECONOMY' or tier is null""",
    "publish_changed": _ALL
    + """select tier, case tier when 'PROMO' then 'written' when 'ECONOMY' then 'written'
        when 'STANDARD' then 'deleted' else 'kept' end as action,
      cast(case when tier = 'STANDARD' then 0 else count(*) end as bigint) as row_count,
      cast(case tier when 'STANDARD' then 0 when 'PROMO' then sum(wins + 1) else sum(wins) end as bigint)
        as wins
    from standings group by tier""",
    "rejected_pages": _FLAWED + "select reason, count(*) as row_count from landed group by 1",
    "load_accounting": _FLAWED
    + """select count(*) as landed, count(*) filter (reason = 'kept') as kept,
      count(*) filter (reason = 'misfit') as misfit, count(*) filter (reason = 'broken') as broken,
      count(*) filter (reason = 'empty') as empty, cast(min(page) as int) as first_page,
      cast(max(page) as int) as last_page, count(*) filter (reason = 'kept') as stored,
      count(*) filter (reason <> 'kept') as rejected
    from landed""",
    # A stream rejects an array whole in which one value does not fit.
    "incremental_rejects": _FLAWED
    + """select case page when 4 then 'misfit' else reason end as reason,
      count(*) as row_count, count(*) as observed from landed group by 1""",
    "scan_prefix": "select doc_id, text, source from documents where source like 'src1%'",
    "scan_path_regex": _ALL + "select * from standings where tier in ('ECONOMY', 'SMALL')",
    "path_normalize": """select p_partkey, lower(p_type) as tier_key,
    lower(p_type) || '_' || p_brand || '/' || p_size || '.json' as page_path,
    'matchs/' || lower(p_type) || '_' || p_partkey || '.json' as match_path,
    cast(regexp_replace(p_brand, '[^0-9]', '', 'g') as bigint) as brand_digits from part""",
    "next_page": r"""
    select regexp_extract(url, '^https?://([^/]+)', 1) as host,
      cast(coalesce(max(try_cast(regexp_extract(url, '[?&]page=(\d+)', 1) as int)) + 1, 1) as int)
        as next_page
    from pages group by 1""",
    "landing_report": r"""
    with p as (select regexp_extract(url, '^https?://([^/]+)', 1) as host,
      try_cast(regexp_extract(url, '[?&]page=(\d+)', 1) as int) as page from pages)
    select host, min(page) as first_page, max(page) as last_page,
      count(distinct page) as page_count, count(*) as file_count,
      cast(max(page) - min(page) + 1 - count(distinct page) as bigint) as absent_pages
    from p where page is not null group by 1""",
    "landing_status": _RESUME,
    "landing_status_by_tasks": _RESUME,
    "resume_points": _RESUME,
    "landing_dedup": """
    select event_type, user_id, event_id, value from (select *, row_number() over (
      partition by event_type, user_id order by ts desc, event_id desc) as rn from events)
    where rn = 1""",
    "incremental_pages": "select event_id, ts, user_id, event_type, value, props from events",
    "late_files": "select event_id, ts, user_id, event_type, value, props from events",
    "incremental_ledger": """select event_id, event_type, user_id from events e
    where not exists (select 1 from events l where l.value > 50
      and l.event_type = e.event_type and l.user_id = e.user_id)""",
    "lookup_chain": _TOP
    + """select tier, division, t.player_id, rn, 'acc-' || t.player_id as account_id, l.match_id,
      o_orderpriority as match_type, o_totalprice as total
    from top t
    join (select distinct l_partkey as player_id, l_orderkey as match_id from lineitem) l
      on l.player_id = t.player_id
    join orders on o_orderkey = l.match_id""",
    "lookup_chain_bucketed": _TOP
    + """select tier, division, t.player_id, rn, 'acc-' || t.player_id as account_id, l.match_id,
      o_orderpriority as match_type, o_totalprice as total
    from top t
    join (select distinct l_partkey as player_id, l_orderkey as match_id from lineitem) l
      on l.player_id = t.player_id
    join orders on o_orderkey = l.match_id""",
    "clustered_box": """
    select l_orderkey, l_linenumber, 'n' || l_partkey as name, l_extendedprice from lineitem
    where (l_shipdate between date '1996-03-01' and date '1996-06-30'
      and l_extendedprice between 20000 and 30000) or l_partkey in (7, 77)""",
    "profile_states": " union all ".join(
        f"""select event_type, '{c}' as column_name, count(*) as row_count, count({c}) as n,
        {f'round(avg({c}), 4)' if number else 'null'} as mean,
        {f'round(stddev_samp({c}), 4)' if number else 'null'} as stddev,
        {f'cast(min({c}) as double)' if number else 'null'} as min_value,
        {f'cast(max({c}) as double)' if number else 'null'} as max_value,
        count(*) - count({c}) as null_count, true as distinct_close from events group by 1"""
        for c, number in (("value", True), ("user_id", True), ("props", False))
    ),
    "recent_matches_per_player": f"with {_history('l_suppkey')} "
    + f"""select player_id, match_id, rn from (select *, row_number() over (
      partition by player_id order by ts desc, match_id) as rn from history where {_PERIOD})
    where rn <= 20""",
    "matches_of_top_players": _TOP
    + """select o_orderkey as match_id, o_orderpriority as match_type, o_totalprice as total
    from orders where o_orderkey in (select l_orderkey from lineitem
      where l_partkey in (select player_id from top where rn = 1))""",
    "schema_report": " union all ".join(
        f"""select cast({i} as int) as position, '{c}' as column_name, '{k}' as data_type,
        count({c}) as value_count from lineitem"""
        for i, (c, k) in enumerate(_LINEITEM_TYPES.items())
    ),
    "schema_drift": _schema_drift(),
    "variant_drift": _DRIFT
    + """select tier, field, string_agg(kind || ':' || n, '|' order by kind || ':' || n) as types,
      cast(sum(n) as bigint) as row_count, cast(0 as bigint) as null_count,
      min(first_day) as first_day, max(last_day) as last_day,
      case when count(*) = 1 then min(kind) when max(kind) = 'STRING' then 'VARIANT'
        else max(kind) end as widened, count(*) > 1 and max(kind) = 'STRING' as clashes
    from types group by 1, 2""",
    "variant_drift_across": _DRIFT
    + """select field, string_agg(distinct tier, ',' order by tier) as groups,
      count(distinct tier) as group_count, cast(sum(n) as bigint) as row_count,
      case when count(distinct kind) = 1 then min(kind) when max(kind) = 'STRING' then 'VARIANT'
        else max(kind) end as widened,
      count(distinct tier) < 5 or (count(distinct kind) > 1 and max(kind) = 'STRING') as drifts
    from types group by 1""",
    "variant_schemas": """select p_type as tier, count(*) as row_count,
      case when p_type = 'PROMO' then 'STRING' else 'BIGINT' end as season, false as clashes
    from part group by 1""",
    "union_widened": """
    select cast(c_custkey as varchar) as key, c_nationkey as nation, round(c_acctbal, 4) as amount,
      null as kind from customer
    union all select s_name, s_nationkey, null, 's' from supplier
    union all select cast(o_orderkey as varchar), null, cast(o_orderkey as double), o_orderstatus
    from orders""",
    "preview": _STANDINGS_ROWS + " order by tier, division, player_id limit 20",
    "job_standings_gold": _STANDINGS_ROWS,
    "job_all_tiers": _STANDINGS_ROWS,
    "job_match_gold": f"select {_landed_columns(MATCH_COLUMNS)} from lineitem",
    "matches_by_tier": _ORDER_MATCHES + "where k = 0 or o_orderstatus = 'F'",
    "matches_relanded": _ORDER_MATCHES + "where k = 0 or o_orderkey % 2 = 0",
    "matches_merged": _ORDER_MATCHES + "where k = 0 or o_orderkey % 2 = 0",
    "incremental_matches": f"select {_landed_columns(_LANDED)} from lineitem",
    "rejected_matches": """
    select 'kept' as status, count(distinct l_orderkey) as row_count from lineitem
    union all select 'rejected', count(*) from orders
    where o_orderkey not in (select l_orderkey from lineitem)""",
    "job_top_matches": f"with {_STANDINGS}, {_RANKED.format(min_games=20)}, {_history('l_partkey')}"
    + f""", recent as (select *, row_number() over (
      partition by player_id order by ts desc, match_id) as rn from history where {_PERIOD}),
    wanted as (select distinct tier, match_id from recent
      join (select tier, player_id from ranked where rn <= 2) using (player_id)
      where recent.rn <= 20)
    select tier, {_landed_columns(_LANDED)} from wanted join lineitem on l_orderkey = match_id""",
    "job_passthrough": "select conv_id, turn, role, text from conversations",
    "job_passthrough_variant": "select conv_id, turn, role, text from conversations",
}
