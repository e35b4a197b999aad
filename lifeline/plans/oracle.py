"""DuckDB restatements of every registered query, for the SQL oracle.

The bindings of ``lifeline.sources.bindings`` and each stage are written
again as CTEs over the raw ``orders`` and ``events`` views, from the same
``SyncConfig``.  Independent SQL, not generated from the Spark plans: the
first-touch identity uses ordered ``first``, batching uses DuckDB's own
``ntile``.  Unreferenced CTEs are never evaluated.
"""

from __future__ import annotations

from lifeline import config as C
from lifeline.config import EVENT_NAMES, UNMAPPED_EVENT_NAME, SyncConfig
from lifeline.operators.state import lookback_start
from lifeline.sources import bindings as B


def _d(day) -> str:
    return f"DATE '{day.isoformat()}'"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _route_case(cfg: SyncConfig, value, app: str = "app_id") -> str:
    arms = " ".join(
        f"WHEN contains({app}, {_q(r.match)}) THEN {value(r)}" for r in cfg.routes[:-1]
    )
    return f"CASE {arms} ELSE {value(cfg.routes[-1])} END"


def route_sql(cfg: SyncConfig, app: str = "app_id") -> dict[str, str]:
    endpoint = _route_case(
        cfg, lambda r: f"{_q(f'{cfg.endpoint_base}?{r.id_param}=')} || {app}", app
    )
    secret = _route_case(cfg, lambda r: _q(r.secret_name), app)
    return {
        "route": _route_case(cfg, lambda r: _q(r.name), app),
        "app_secret": secret,
        "endpoint": endpoint,
        "mp_url": f"({endpoint}) || '&api_secret=' || ({secret})",
    }


def _name_case(col: str) -> str:
    arms = " ".join(f"WHEN {col} = {_q(raw)} THEN {_q(name)}" for raw, name in EVENT_NAMES)
    return f"CASE {arms} ELSE {_q(UNMAPPED_EVENT_NAME)} END"


def _hash(col: str, cfg: SyncConfig) -> str:
    return f"sha256({_q(cfg.user_key_prefix)} || {col})"


def _ident_cte(name: str, where: str, cfg: SyncConfig) -> str:
    """First-touch identity per analytics user over the filtered shards:
    ordered ``first`` (nulls first, as in Spark's struct order)."""
    order = "ORDER BY event_timestamp NULLS FIRST, event_id NULLS FIRST"
    return f"""{name} AS (
  SELECT user_id,
    first(user_pseudo_id {order}) FILTER (WHERE user_pseudo_id IS NOT NULL) AS client_id,
    COALESCE(first(firebase_app_id {order}), {_q(cfg.default_app_id)}) AS app_id
  FROM analytics {where} GROUP BY user_id)"""


def ctes(cfg: SyncConfig) -> str:
    utc, local = _d(cfg.today_utc), _d(cfg.today_local)
    yday = _d(cfg.yesterday_local)
    s_lo, s_hi = cfg.state_shard_range
    ev_lo, ev_hi = cfg.events_shard_range
    ev_scope = f"WHERE suffix BETWEEN '{ev_lo or ''}' AND '{ev_hi}'"
    types = " ".join(f"WHEN {i} THEN {_q(t)}" for i, t in enumerate(B.SUBSCRIPTION_EVENT_TYPES))
    groups = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in B.BASE_GROUPS)
    rs = route_sql(cfg)
    status = f"""CASE
        WHEN churn_type = 'voluntary' AND churn_end_date < {utc} THEN {_q(C.STATUS_CHURN_VOLUNTARY)}
        WHEN churn_type = 'involuntary' AND churn_end_date < {utc} THEN {_q(C.STATUS_CHURN_INVOLUNTARY)}
        WHEN calendar_date < {yday} THEN {_q(C.STATUS_CHURN_UNKNOWN)}
        WHEN CAST(subscription_cancel_dts AS DATE) < {local}
             AND {utc} < COALESCE(churn_end_date, {_d(C.FAR_FUTURE)}) THEN {_q(C.STATUS_IN_CANCELATION)}
        WHEN churn_end_date IS NULL OR churn_end_date >= {local} THEN {_q(C.STATUS_ACTIVE)}
        ELSE {_q(C.STATUS_UNKNOWN)} END"""
    state_event = (
        f"[{{'name': {_q(cfg.state_event_name)}, 'params': {{'offline_event': 'true'}}}}]"
    )
    props = ", ".join(
        f"'{p}': {{'value': {p}}}"
        for p in (
            "subscription_status",
            "subscription_start_date",
            "subscription_end_date",
            "subscription_cancel_date",
            "subscription_renewal_date",
        )
    )
    return f"""WITH
snapshot AS (
  SELECT
    CASE WHEN o.o_custkey % 50 = 7 THEN 'dummy' ELSE '' END || CAST(o.o_custkey AS VARCHAR) AS user_id,
    {_d(B.SNAPSHOT_ANCHOR)} - CAST(o.o_custkey % 7 + o.o_orderkey % 3 AS INTEGER) AS calendar_date,
    CASE o.o_orderstatus {groups} END AS base_group,
    {_d(B.START_BASE)} + CAST(o.o_custkey % 60 + o.o_orderkey % 2 AS INTEGER) AS subscription_start_date,
    CASE WHEN o.o_orderkey % 3 = 0
         THEN CAST({_d(B.CANCEL_BASE)} + CAST(o.o_orderkey % 15 AS INTEGER) AS TIMESTAMP) + INTERVAL 12 HOUR
    END AS subscription_cancel_dts,
    CASE WHEN o.o_orderkey % 13 <> 0
         THEN {_d(B.CYCLE_START_BASE)} + CAST((o.o_custkey * 7) % 15 AS INTEGER) END AS billing_cycle_start_date,
    {_d(B.CYCLE_END_BASE)} + CAST((o.o_custkey * 7) % 15 + (o.o_orderkey % 2) * 2 AS INTEGER) AS billing_cycle_end_date,
    CASE WHEN o.o_orderstatus <> 'F' OR o.o_custkey % 5 = 0 THEN NULL
         WHEN o.o_custkey % 5 < 3 THEN 'voluntary' ELSE 'involuntary' END AS churn_type,
    CAST(o.o_orderkey % 24 + 1 AS BIGINT) AS subscription_month,
    CASE WHEN o.o_orderkey % 20 = 0 THEN 'GC' || CAST(o.o_orderkey AS VARCHAR) END AS gift_card_code,
    CASE WHEN o.o_orderkey % 4 <> 0 THEN o.o_orderpriority END AS payment_vendor
  FROM orders o),
sub_events AS (
  SELECT e.event_id,
    CAST(e.user_id AS VARCHAR) AS user_id,
    CASE e.event_id % 11 {types} END AS event_type,
    e.ts AS event_ts,
    'S' || CAST(e.user_id * 10 + e.event_id % 3 AS VARCHAR) AS subscription_id,
    e.event_type AS offer_type
  FROM events e),
analytics AS (
  SELECT e.event_id,
    {_hash("CAST(e.user_id AS VARCHAR)", cfg)} AS user_id,
    CASE WHEN e.user_id % 17 <> 0 AND e.event_id % 3 <> 0
         THEN upper(md5(CAST(e.user_id AS VARCHAR) || '-' || CAST(e.event_id % 2 AS VARCHAR))) END AS user_pseudo_id,
    e.ts AS event_timestamp,
    CASE WHEN e.user_id % 4 = 0 OR e.event_id % 5 = 0 THEN NULL
         WHEN e.user_id % 4 = 1 THEN {_q(B.IOS_APP)}
         WHEN e.user_id % 4 = 2 THEN {_q(B.ANDROID_APP)}
         ELSE {_q(B.WEB_APP)} END AS firebase_app_id,
    strftime(e.ts, '%Y%m%d') AS suffix
  FROM events e),
paying_all AS (
  SELECT * FROM snapshot WHERE base_group <> 'churn' AND calendar_date BETWEEN {_d(lookback_start(cfg))} AND {local}),
latest_all AS (
  SELECT p.* FROM paying_all p
  JOIN (SELECT user_id, max(calendar_date) AS md FROM paying_all GROUP BY user_id) m
    ON p.user_id = m.user_id AND p.calendar_date = m.md),
churn_all AS (
  SELECT user_id, subscription_start_date,
         max(billing_cycle_end_date) AS billing_cycle_end_date,
         max(churn_type) AS churn_type,
         max(CASE WHEN churn_type = 'involuntary' THEN calendar_date ELSE billing_cycle_end_date END) AS subscription_end_date
  FROM snapshot WHERE base_group = 'churn' AND calendar_date <= {local} GROUP BY user_id, subscription_start_date),
snap AS (SELECT * FROM snapshot WHERE NOT (user_id LIKE {_q(cfg.test_user_prefix + '%')})),
paying AS (SELECT * FROM snap WHERE base_group <> 'churn' AND calendar_date BETWEEN {_d(lookback_start(cfg))} AND {local}),
latest AS (
  SELECT p.* FROM paying p
  JOIN (SELECT user_id, max(calendar_date) AS md FROM paying GROUP BY user_id) m
    ON p.user_id = m.user_id AND p.calendar_date = m.md),
churn AS (
  SELECT user_id, subscription_start_date,
         max(billing_cycle_end_date) AS billing_cycle_end_date,
         max(churn_type) AS churn_type,
         max(CASE WHEN churn_type = 'involuntary' THEN calendar_date ELSE billing_cycle_end_date END) AS subscription_end_date
  FROM snap WHERE base_group = 'churn' AND calendar_date <= {local} GROUP BY user_id, subscription_start_date),
swc AS (
  SELECT l.* EXCLUDE (churn_type), c.churn_type, c.subscription_end_date AS churn_end_date
  FROM latest l LEFT JOIN churn c
    ON l.user_id = c.user_id
   AND c.subscription_end_date >= l.subscription_start_date
   AND c.billing_cycle_end_date = l.billing_cycle_end_date
  WHERE l.calendar_date <= COALESCE(c.subscription_end_date, {_d(C.FAR_FUTURE)})
     OR l.subscription_start_date > c.subscription_end_date),
state AS (
  SELECT DISTINCT user_id, subscription_start_date,
    CAST(subscription_cancel_dts AS DATE) AS subscription_cancel_date,
    COALESCE(billing_cycle_start_date, {_d(C.NO_DATE)}) AS subscription_next_renewal_date,
    COALESCE(churn_end_date, billing_cycle_end_date, {_d(C.NO_DATE)}) AS subscription_end_date,
    {status} AS subscription_status
  FROM swc),
state_attrs AS (
  SELECT DISTINCT user_id, subscription_start_date,
    CAST(subscription_cancel_dts AS DATE) AS subscription_cancel_date,
    COALESCE(billing_cycle_start_date, {_d(C.NO_DATE)}) AS subscription_next_renewal_date,
    COALESCE(churn_end_date, billing_cycle_end_date, {_d(C.NO_DATE)}) AS subscription_end_date,
    {status} AS subscription_status,
    subscription_month, gift_card_code,
    COALESCE(payment_vendor, 'unknown') AS subscription_payment_vendor
  FROM swc),
{_ident_cte("ident_all", f"WHERE suffix <= '{ev_hi}'", cfg)},
{_ident_cte("ident_state", f"WHERE suffix BETWEEN '{s_lo}' AND '{s_hi}'", cfg)},
{_ident_cte("ident_events", ev_scope, cfg)},
state_ident AS (
  SELECT s.subscription_cancel_date,
         s.subscription_next_renewal_date AS subscription_renewal_date,
         s.subscription_start_date, s.subscription_end_date, s.subscription_status,
         s.user_id AS raw_user_id, i.user_id AS hashed_user_id, i.client_id, i.app_id
  FROM state s JOIN ident_state i ON {_hash("s.user_id", cfg)} = i.user_id),
state_proj AS (
  SELECT COALESCE(strftime(subscription_cancel_date, '%Y-%m-%d'), '') AS subscription_cancel_date,
         COALESCE(client_id, '') AS client_id,
         strftime(subscription_renewal_date, '%Y-%m-%d') AS subscription_renewal_date,
         strftime(subscription_start_date, '%Y-%m-%d') AS subscription_start_date,
         strftime(subscription_end_date, '%Y-%m-%d') AS subscription_end_date,
         hashed_user_id, app_id, subscription_status,
         {rs['route']} AS route, {rs['app_secret']} AS app_secret, {rs['mp_url']} AS mp_url
  FROM state_ident),
payload_state AS (
  SELECT app_id, hashed_user_id AS user_id,
    CAST(to_json({{'URL': mp_url, 'app_id': app_id, 'client_id': client_id, 'user_id': hashed_user_id,
              'user_properties': {{{props}}}, 'events': {state_event}}}) AS VARCHAR) AS payload_json,
    CAST(to_json({{'user_id': hashed_user_id, 'user_properties': {{{props}}}, 'events': {state_event}}}) AS VARCHAR)
      AS rest_json,
    client_id, mp_url
  FROM state_proj),
day_events AS (
  SELECT DISTINCT {_hash("user_id", cfg)} AS user_id, event_type, {yday} AS date_of_change,
         subscription_id, offer_type
  FROM sub_events
  WHERE CAST(timezone({_q(cfg.zone)}, event_ts AT TIME ZONE 'UTC') AS DATE) = {yday}),
events_ident AS (
  SELECT d.user_id, {_name_case("d.event_type")} AS event_custom_type, d.date_of_change,
         i.client_id, i.app_id, {route_sql(cfg, "i.app_id")['mp_url']} AS mp_url,
         d.subscription_id, d.offer_type, d.event_type
  FROM day_events d JOIN ident_events i ON d.user_id = i.user_id),
ev_numbered AS (
  SELECT *,
    row_number() OVER (
      PARTITION BY user_id
      ORDER BY event_custom_type NULLS FIRST, subscription_id NULLS FIRST,
               offer_type NULLS FIRST, event_type NULLS FIRST) AS rn
  FROM events_ident),
ev_lists AS (
  SELECT user_id, app_id, client_id, mp_url, (rn - 1) // {cfg.max_events_per_payload} AS chunk,
    list({{'name': event_custom_type,
           'params': {{'offline_event': 'true', 'offer_type': offer_type, 'subscription_id': subscription_id}}}}
         ORDER BY rn) AS events
  FROM ev_numbered GROUP BY ALL),
payload_events AS (
  SELECT app_id, user_id, chunk, CAST(len(events) AS BIGINT) AS n_events,
    replace(CAST(to_json({{'URL': mp_url, 'app_id': app_id, 'client_id': client_id, 'user_id': user_id,
                           'events': events}}) AS VARCHAR),
            '"client_id":null,', '') AS payload_json,
    CAST(to_json({{'user_id': user_id, 'events': events}}) AS VARCHAR) AS rest_json,
    client_id, mp_url
  FROM ev_lists),
bucketed_state AS (
  SELECT app_id, user_id, payload_json, rest_json, client_id, mp_url,
    ntile((SELECT greatest(1, CAST(round_even(count(*) / {cfg.target_batch_size}, 0) AS BIGINT)) FROM payload_state))
      OVER (PARTITION BY app_id ORDER BY user_id, payload_json) AS bucket
  FROM payload_state),
bucketed_events AS (
  SELECT app_id, user_id, payload_json, rest_json, client_id, mp_url,
    ntile((SELECT greatest(1, CAST(round_even(count(*) / {cfg.target_batch_size}, 0) AS BIGINT)) FROM payload_events))
      OVER (PARTITION BY app_id ORDER BY user_id, payload_json) AS bucket
  FROM payload_events),
batch_state AS (
  SELECT app_id, bucket, count(*) AS n_payloads,
         '[' || string_agg(payload_json, ',' ORDER BY user_id, payload_json) || ']' AS payload_array
  FROM bucketed_state GROUP BY app_id, bucket),
batch_events AS (
  SELECT app_id, bucket, count(*) AS n_payloads,
         '[' || string_agg(payload_json, ',' ORDER BY user_id, payload_json) || ']' AS payload_array
  FROM bucketed_events GROUP BY app_id, bucket)
"""


def wire_sql(source: str, cfg: SyncConfig) -> str:
    """Wire rows of a bucketed payload CTE: the body is the payload minus
    URL and app_id, the client id first (web) or last as app_instance_id
    (mobile), a null one left out."""
    mobile = (
        "(contains(split_part(mp_url, '&api_secret=', 1), 'ios') "
        "OR contains(split_part(mp_url, '&api_secret=', 1), 'android'))"
    )
    inner = "substr(rest_json, 2, length(rest_json) - 2)"
    body = f"""CASE
        WHEN client_id IS NULL THEN rest_json
        WHEN {mobile} THEN '{{' || {inner} || ',\"app_instance_id\":' || CAST(to_json(client_id) AS VARCHAR) || '}}'
        ELSE '{{\"client_id\":' || CAST(to_json(client_id) AS VARCHAR) || ',' || {inner} || '}}' END"""
    rs = route_sql(cfg)
    return f"""wire_{source} AS (
  SELECT w.*, {_hash_free(_q(str(cfg.today_local)), "w.url", "w.body")} AS payload_id,
         CAST(strlen(w.body) AS BIGINT) AS content_length,
         (w.client_id IS NOT NULL AND trim(w.client_id) <> '') AS deliverable
  FROM (
    SELECT app_id, user_id, mp_url AS url, client_id,
           app_id || ':' || CAST(bucket AS VARCHAR) AS batch_id,
           CAST(row_number() OVER (PARTITION BY app_id, bucket ORDER BY user_id, payload_json) - 1 AS INTEGER)
             AS payload_index,
           {rs['route']} AS route,
           {body} AS body
    FROM bucketed_{source}) w)"""


def _hash_free(*cols: str) -> str:
    return "sha256(concat_ws('|', " + ", ".join(cols) + "))"
