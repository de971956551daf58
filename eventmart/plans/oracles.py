"""Each query as plain SQL for an independent engine, over the same tables.

The SQL takes its own way wherever there is one: the credit check walks row by row in a recursive query, the
sagas number runs and look partners up, visibility joins on the whole policy.
"""

from __future__ import annotations

import re

# Named views; a statement gets the ones it mentions, and those they mention.
VIEWS: dict[str, str] = {}
ORACLES: dict[str, str] = {}

VIEWS["ev"] = """
  SELECT event_id, ts, 'u' || user_id AS user_id, event_type, value, k,
         'user' || user_id || '@example.com' AS email,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS time, 'req-' || event_id AS request_id,
         'f' || k || '.png' AS file_name,
         ['image/jpeg','image/png','image/gif','image/webp','video/mp4','video/webm','audio/mpeg','audio/wav',
          'audio/ogg','application/pdf','text/plain','image/bmp'][k % 12 + 1] AS media_type,
         CAST(round(value * 1000) AS BIGINT) AS file_size,
         'files/u' || user_id || '/' || (k // 10) || '/f.png' AS path,
         epoch_us(ts) AS us
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""
VIEWS["logins"] = """
  SELECT user_id, email, time AS login_time, CASE WHEN value < 50 THEN 'device-' || k END AS device_id,
         'agent/' || k AS user_agent, '10.0.0.' || k AS ip_address, ts FROM ev WHERE event_type = 'view'"""
VIEWS["signups"] = "SELECT user_id, email, time AS signup_time, us FROM ev WHERE event_type = 'signup'"
VIEWS["signouts"] = """
  SELECT user_id, CASE WHEN value < 100 THEN email END AS email, time AS signout_time,
         CAST(NULL AS VARCHAR) AS device_id, 'agent/' || k AS user_agent, '10.0.0.' || k AS ip_address
  FROM ev WHERE event_type = 'error'"""
VIEWS["messages"] = """
  SELECT 'u' || conv_id AS user_id, 'user' || conv_id || '@example.com' AS email, text AS message,
         strftime(make_timestamp(1704067200000000 + conv_id * 60000000 + turn * 1000000),
                  '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp,
         CASE role WHEN 'assistant' THEN 'direct' ELSE 'broadcast' END AS visibility,
         CASE role WHEN 'assistant' THEN 'u' || (conv_id + 1) END AS recipient_id
  FROM conversations"""
VIEWS["clicks"] = "SELECT * FROM ev WHERE event_type = 'click'"
VIEWS["purchases"] = "SELECT * FROM ev WHERE event_type = 'purchase'"
VIEWS["views"] = "SELECT * FROM ev WHERE event_type = 'view'"
VIEWS["errors"] = "SELECT * FROM ev WHERE event_type = 'error'"
VIEWS["signed"] = """
  SELECT user_id, 'uploads/' || user_id || '/' || (k // 50) || '/f.png' AS file_path, file_name, request_id,
         1704067200000000 + (us - 1704067200000000) // 300 AS t FROM clicks"""
VIEWS["received"] = """
  SELECT 'uploads/' || user_id || '/' || (k // 50) || '/f.png' AS file_path,
         1704067200000000 + (us - 1704067200000000) // 300 AS t FROM purchases"""
VIEWS["files"] = """
  SELECT p.user_id, p.file_name, p.path AS file_path, p.file_size, p.media_type, p.time AS upload_time,
         EXISTS (SELECT 1 FROM errors d WHERE d.user_id = p.user_id AND d.path = p.path AND d.time >= p.time)
           AS gone
  FROM purchases p"""
VIEWS["active"] = "SELECT * FROM files WHERE NOT gone"
VIEWS["newest_active"] = """
  SELECT * FROM active QUALIFY row_number() OVER (PARTITION BY user_id, file_path ORDER BY upload_time DESC) = 1"""
VIEWS["unified"] = """
  SELECT user_id || '_' || login_time AS event_id, login_time AS event_time, 'LOGIN' AS event_type, user_id, email,
         device_id, user_agent, ip_address FROM logins
  UNION ALL SELECT user_id || '_' || signup_time, signup_time, 'SIGNUP', user_id, email, NULL, NULL, NULL FROM signups
  UNION ALL SELECT user_id || '_' || signout_time, signout_time, 'SIGNOUT', user_id, email, NULL, NULL, NULL
  FROM signouts"""


def _iso(us: str) -> str:
    return f"strftime(make_timestamp({us}), '%Y-%m-%dT%H:%M:%S.%fZ')"


def _json(**fields: str) -> str:
    return "CAST(json_object(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ") AS VARCHAR)"


def oracle(name: str, body: str) -> None:
    ORACLES[name] = body


# Whole numbers with gaps, compared as text.
GAPPED = {"download_outcomes": ["expires_in"], "media_outcomes": ["file_size", "retry_count"], "delete_outcomes": ["file_size", "retry_count"],
          "frame_check": ["schema_id"], "json_contract": ["file_size"], "validate_intents": ["file_size"]}


def statement(name: str) -> str:
    """The SQL of one query with the views it needs in front."""
    body, needed = ORACLES[name], []
    if name in GAPPED:
        texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in GAPPED[name])
        body = f"SELECT * REPLACE ({texts}) FROM ({body})"

    def visit(sql: str) -> None:
        for view, text in VIEWS.items():
            if view not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{view}\b", sql):
                visit(text)
                if view not in needed:
                    needed.append(view)

    visit(body)
    views = ", ".join(f"{view} AS ({VIEWS[view]})" for view in needed)
    recursive = "RECURSIVE " if "walk AS" in body else ""
    lead = body.lstrip()
    if lead.startswith("WITH "):
        return f"WITH {recursive}{views}, {lead[5:]}"
    return f"WITH {views} {lead}" if views else lead


# identity ---------------------------------------------------------------------------------------

_FIRST_EMAIL = "arg_min(email, login_time) AS email"
oracle("daily_login_aggregates", f"""
  SELECT l.user_id, l.login_count, s.signup_date, l.email, '2024-01-15' AS dt
  FROM (SELECT user_id, CAST(count(*) AS INTEGER) AS login_count, {_FIRST_EMAIL} FROM logins
        WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY user_id) l
  LEFT JOIN (SELECT user_id, min(substr(signup_time, 1, 10)) AS signup_date FROM signups GROUP BY user_id) s
    USING (user_id)""")
oracle("daily_login_aggregates_all_signups", f"""
  SELECT l.user_id, l.login_count, substr(s.signup_time, 1, 10) AS signup_date, l.email, '2024-01-15' AS dt
  FROM (SELECT user_id, CAST(count(*) AS INTEGER) AS login_count, {_FIRST_EMAIL} FROM logins
        WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY user_id) l
  LEFT JOIN signups s USING (user_id)""")
oracle("login_aggregates_backfill", f"""
  SELECT l.user_id, l.login_count, s.signup_date, l.email, l.dt
  FROM (SELECT user_id, substr(login_time, 1, 10) AS dt, CAST(count(*) AS INTEGER) AS login_count, {_FIRST_EMAIL}
        FROM logins GROUP BY ALL) l
  LEFT JOIN (SELECT user_id, min(substr(signup_time, 1, 10)) AS signup_date FROM signups GROUP BY user_id) s
    USING (user_id)""")
oracle("unified_events", "SELECT * FROM unified")
oracle("login_echo", "SELECT user_id, email, login_time, device_id, user_agent, ip_address FROM logins")

# notifications ----------------------------------------------------------------------------------


def _notification(kind: str, time: str, source: str, **fields: str) -> str:
    return f"SELECT user_id, '{kind}' AS event_type, {_json(**fields)} AS payload, {time} AS event_time FROM {source}"


_DEVICE = {"email": "email", "device_id": "device_id", "user_agent": "user_agent", "ip_address": "ip_address"}
oracle("notif_login", _notification("identity.login", "login_time", "logins", **_DEVICE))
oracle("notif_signup", _notification("identity.signup", "signup_time", "signups", email="email"))
oracle("notif_signout", _notification("identity.signout", "signout_time", "signouts", **_DEVICE))
oracle("notif_credit_bonus", _notification("credit.balance_changed", "signup_time", "signups", amount="2",
                                           reason="'signup_bonus'"))
oracle("notif_credit_refund", _notification("credit.balance_changed", "time", "clicks", amount="1",
                                            reason="'upload_expired'", file_name="file_name"))
oracle("notif_upload_ready", _notification("media.upload_ready", _iso("t"), "signed",
                                           upload_url="'https://store/' || file_path", file_path="file_path",
                                           expires_in="900", request_id="request_id"))
oracle("notif_upload_rejected", _notification("media.upload_rejected", "time", "clicks",
                                              reason="'insufficient_credits'", request_id="request_id",
                                              file_name="file_name"))
oracle("notif_upload_completed", _notification("media.upload_completed", "time", "purchases", file_path="path",
                                               file_name="file_name", file_size="file_size", media_type="media_type"))
oracle("notif_upload_expired", _notification("media.upload_expired", "time", "clicks", file_path="path",
                                             file_name="file_name", amount_refunded="1", request_id="request_id"))
oracle("notif_upload_failed", _notification("media.upload_failed", "time", "errors", file_name="file_name",
                                            failure_reason="'max retries exceeded'", retry_count="3"))
oracle("notif_download_ready", _notification("media.download_ready", "time", "views",
                                             download_url="'https://store/' || path", file_path="path",
                                             expires_in="3600", request_id="request_id"))
_REJECTED = {"file_path": "path", "reason": "'not_found'", "request_id": "request_id"}
oracle("notif_download_rejected", _notification("media.download_rejected", "time", "views", **_REJECTED))
oracle("notif_file_deleted", _notification("media.file_deleted", "time", "errors", file_path="path",
                                           file_name="file_name"))
oracle("notif_delete_rejected", _notification("media.delete_rejected", "time", "views", **_REJECTED))
oracle("notif_message", _notification("user.message", "timestamp", "messages", email="email", message="message")
       .replace(" FROM", ", visibility, recipient_id FROM"))
VIEWS["log"] = " UNION ALL ".join(
    f"SELECT user_id, event_type, payload, event_time, 'broadcast' AS visibility, CAST(NULL AS VARCHAR) AS recipient_id "
    f"FROM ({ORACLES[n]})" for n in ("notif_login", "notif_signup", "notif_signout")
) + f" UNION ALL {ORACLES['notif_message']}"

# credits ----------------------------------------------------------------------------------------

oracle("ledger_signup_bonus", """
  SELECT user_id, 2 AS amount, 'credit.signup_bonus' AS event_type, 'Welcome bonus: 2 credits' AS description,
         signup_time AS event_time FROM signups""")
oracle("ledger_refund", """
  SELECT user_id, 1 AS amount, 'credit.upload_refunded' AS event_type,
         'Refund: upload expired for ' || file_name AS description, time AS event_time FROM clicks""")
VIEWS["turns"] = """
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, kind, request_id) AS n FROM (
    SELECT user_id, us, 0 AS kind, '' AS request_id, NULL AS file_name, NULL AS media_type, NULL AS file_size,
           NULL AS request_time FROM signups
    UNION ALL SELECT user_id, us, 1, request_id, file_name, media_type, file_size, time FROM clicks)"""
_WALK = """WITH walk AS (
    SELECT user_id, n, CASE kind WHEN 0 THEN 2 ELSE 0 END AS balance, false AS approved FROM turns WHERE n = 1
    UNION ALL
    SELECT t.user_id, t.n,
           CASE WHEN t.kind = 0 THEN w.balance + 2 WHEN w.balance >= 1 THEN w.balance - 1 ELSE w.balance END,
           t.kind = 1 AND w.balance >= 1
    FROM walk w JOIN turns t ON t.user_id = w.user_id AND t.n = w.n + 1),
  decided AS (SELECT t.*, w.approved FROM turns t JOIN walk w USING (user_id, n) WHERE t.kind = 1)"""
oracle("credit_check", _WALK + """
  SELECT CASE WHEN approved THEN 'approved' ELSE 'rejected' END AS outcome, user_id, file_name, media_type, file_size,
         request_id, CASE WHEN approved THEN request_time ELSE '' END AS request_time,
         CASE WHEN approved THEN '' ELSE 'insufficient_credits' END AS reason,
         CASE WHEN approved THEN '' ELSE request_time END AS rejected_time,
         CASE WHEN approved THEN -1 ELSE 0 END AS ledger_delta FROM decided""")
oracle("upload_approved", _WALK + """
  SELECT user_id, file_name, media_type, file_size, request_id, request_time FROM decided WHERE approved""")
oracle("credit_balances", _WALK + """
  SELECT user_id, CAST(sum(amount) AS BIGINT) AS balance FROM (
    SELECT user_id, 2 AS amount FROM signups UNION ALL SELECT user_id, -1 FROM decided WHERE approved)
  GROUP BY user_id""")
oracle("credit_affordable", _WALK + """,
  rich AS (SELECT user_id FROM (SELECT user_id, 2 AS amount FROM signups
             UNION ALL SELECT user_id, -1 FROM decided WHERE approved) GROUP BY user_id HAVING sum(amount) >= 1)
  SELECT request_id, user_id FROM clicks SEMI JOIN rich USING (user_id)""")
oracle("credit_balance_lookup", """
  SELECT u.user_id, CAST(count(s.user_id) * 2 AS BIGINT) AS balance, count(s.user_id) = 0 AS blocked
  FROM (SELECT user_id FROM ev UNION SELECT user_id FROM messages) u LEFT JOIN signups s USING (user_id)
  GROUP BY u.user_id""")

oracle("credit_check_incremental", ORACLES["credit_check"] + " WHERE us >= epoch_us(TIMESTAMP '2024-01-15')")

# media ------------------------------------------------------------------------------------------

oracle("media_files_insert", """
  SELECT user_id, file_name, path AS file_path, file_size, media_type, 'active' AS status, time AS upload_time
  FROM purchases""")
oracle("upload_signed", """
  SELECT user_id, 'uploads/' || user_id || '/' || request_id || '/' || file_name AS file_path, file_name,
         CAST(NULL AS VARCHAR) AS upload_url, 900 AS expires_in, request_id, time AS signed_time FROM clicks""")
oracle("soft_delete", """
  SELECT user_id, file_name, file_path, file_size, media_type, CASE WHEN gone THEN 'deleted' ELSE 'active' END AS status,
         upload_time, gone AS changed FROM files""")
oracle("active_files", """
  SELECT user_id, file_name, file_path, file_size, media_type, 'active' AS status, upload_time FROM active""")
oracle("ownership_exists", """
  SELECT request_id, user_id, path AS file_path FROM clicks c
  WHERE EXISTS (SELECT 1 FROM active a WHERE a.user_id = c.user_id AND a.file_path = c.path)""")
oracle("download_outcomes", """
  SELECT CASE WHEN ok THEN 'signed' ELSE 'rejected' END AS outcome, user_id, path AS file_path, request_id,
         CASE WHEN ok THEN 'https://store/' || path END AS download_url, CASE WHEN ok THEN 3600 END AS expires_in,
         CASE WHEN NOT found THEN 'not_found' WHEN NOT ok THEN 'internal_error' END AS reason, time AS outcome_time
  FROM (SELECT *, found AND value < 100 AS ok FROM (SELECT c.*, EXISTS (
    SELECT 1 FROM active a WHERE a.user_id = c.user_id AND a.file_path = c.path) AS found FROM clicks c))""")
oracle("download_events", """
  SELECT c.user_id, c.path AS file_path, a.file_name, a.media_type, c.time AS download_time
  FROM clicks c JOIN newest_active a ON a.user_id = c.user_id AND a.file_path = c.path""")
oracle("delete_outcomes", """
  WITH judged AS (
    SELECT v.user_id, v.path, v.request_id, v.time, v.value, a.file_name, a.media_type, a.file_size,
           a.file_path IS NOT NULL AS found
    FROM views v LEFT JOIN newest_active a ON a.user_id = v.user_id AND a.file_path = v.path)
  SELECT 'rejected' AS outcome, user_id, path AS file_path, request_id, NULL AS file_name, NULL AS media_type,
         NULL AS file_size, CASE WHEN found THEN 'internal_error' ELSE 'not_found' END AS reason,
         NULL AS retry_count, time AS outcome_time FROM judged WHERE NOT found OR value >= 120
  UNION ALL SELECT 'deleted', user_id, path, request_id, file_name, media_type, file_size, NULL, NULL, time
  FROM judged WHERE found AND value < 120
  UNION ALL SELECT 'retry', user_id, path, request_id, file_name, media_type, file_size, NULL, 0, time
  FROM judged WHERE found AND value < 120 AND value >= 40""")

# Each intent looks for the last change of its file before it: a confirmation, or a delete that could mark it.
VIEWS["file_changes"] = """
  SELECT user_id, path, us, 0 AS kind, '' AS id, true AS active, file_name, media_type, file_size FROM purchases
  UNION ALL SELECT user_id, path, us, 1, request_id, false, NULL, NULL, NULL FROM views WHERE event_id % 10 <> 4"""
VIEWS["judged_intents"] = """
  SELECT i.*, coalesce(c.active, false) AS found, c.file_name AS f_name, c.media_type AS f_type, c.file_size AS f_size
  FROM (SELECT *, 1 AS kind FROM views UNION ALL SELECT *, 2 FROM clicks) i
  LEFT JOIN file_changes c ON c.user_id = i.user_id AND c.path = i.path
    AND (c.us < i.us OR c.us = i.us AND (c.kind < i.kind OR c.kind = i.kind AND c.id < i.request_id))
  QUALIFY row_number() OVER (PARTITION BY i.event_id ORDER BY c.us DESC NULLS LAST, c.kind DESC, c.id DESC, c.file_name DESC,
                             c.media_type DESC, c.file_size DESC) = 1"""
VIEWS["media_judged"] = """
  SELECT CASE WHEN kind = 2 AND found AND event_id % 10 <> 3 THEN 'signed' WHEN kind = 2 THEN 'download_rejected'
              WHEN found AND event_id % 10 <> 4 THEN 'deleted' ELSE 'delete_rejected' END AS outcome, * FROM judged_intents"""
oracle("media_outcomes", """
  SELECT outcome, user_id, path AS file_path, request_id,
         CASE WHEN outcome IN ('signed', 'deleted') THEN f_name END AS file_name,
         CASE WHEN outcome IN ('signed', 'deleted') THEN f_type END AS media_type,
         CASE WHEN outcome IN ('signed', 'deleted') THEN f_size END AS file_size,
         CASE WHEN outcome = 'signed' THEN 'https://store/' || path END AS download_url,
         CASE WHEN outcome NOT IN ('signed', 'deleted') THEN CASE WHEN found THEN 'internal_error' ELSE 'not_found' END END AS reason,
         NULL AS retry_count, time AS outcome_time
  FROM media_judged
  UNION ALL SELECT 'retry', user_id, path, request_id, f_name, f_type, f_size, NULL, NULL, 0, time
  FROM media_judged WHERE outcome = 'deleted' AND event_id % 3 <> 0""")

# sagas ------------------------------------------------------------------------------------------

oracle("ttl_expired", f"""
  WITH linked AS (SELECT *, lag(t) OVER w AS prev FROM signed WINDOW w AS (PARTITION BY file_path ORDER BY t, request_id)),
  numbered AS (SELECT *, sum(CASE WHEN prev IS NULL OR t - prev > 900000000 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY file_path ORDER BY t, request_id) AS chain FROM linked),
  chains AS (SELECT file_path, chain, min(t) AS first_t, max(t) + 900000000 AS deadline,
               arg_max(struct_pack(user_id, file_name, request_id, t), struct_pack(t, request_id)) AS last
             FROM numbered GROUP BY ALL),
  bounded AS (SELECT *, lag(deadline) OVER (PARTITION BY file_path ORDER BY chain) AS before FROM chains)
  SELECT last.user_id AS user_id, file_path, last.file_name AS file_name, CAST(0 AS BIGINT) AS file_size,
         '' AS media_type, last.request_id AS request_id, {_iso("last.t")} AS request_time,
         {_iso("deadline")} AS expired_time
  FROM bounded b WHERE NOT EXISTS (
    SELECT 1 FROM received r WHERE r.file_path = b.file_path AND r.t <= b.deadline
      AND r.t >= b.first_t - 900000000 AND (b.before IS NULL OR r.t > b.before))""")
_MOVES = f"""
  WITH line AS (
    SELECT 0 AS kind, 1704067200000000 + (us - 1704067200000000) // 3000 AS t,
           'files/' || user_id || '/' || (k // 50) || '/f.png' AS permanent_path, user_id, email,
           'uploads/' || user_id || '/' || (k // 50) || '/f.png' AS file_path, file_name, file_size, media_type,
           k // 20 AS retry_count FROM purchases
    UNION ALL
    SELECT 1, 1704067200000000 + (us - 1704067200000000) // 3000,
           'files/' || user_id || '/' || (k // 50) || '/f.png', NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM views),
  near AS (SELECT *, lag(t) OVER w AS pt, lag(kind) OVER w AS pk, lead(t) OVER w AS nt, lead(kind) OVER w AS nk
           FROM line WINDOW w AS (PARTITION BY permanent_path ORDER BY t, kind, retry_count)),
  runs AS (SELECT *, sum(CASE WHEN pt IS NULL OR t - pt > 120000000 OR pk = kind THEN 1 ELSE 0 END) OVER (
             PARTITION BY permanent_path ORDER BY t, kind, retry_count) AS run FROM near),
  pairs AS (SELECT *, (row_number() OVER (PARTITION BY permanent_path, run ORDER BY t, kind, retry_count) - 1) // 2
              AS pair FROM runs),
  sized AS (SELECT *, count(*) OVER p AS members, max(t) OVER p AS done FROM pairs
            WINDOW p AS (PARTITION BY permanent_path, run, pair)),
  moves AS (SELECT CASE WHEN members = 2 THEN 'confirmed' WHEN retry_count < 3 THEN 'retry' ELSE 'dead_letter' END
              AS _type, user_id, email, file_path, file_name, file_size, media_type, {_iso("t")} AS upload_time,
              permanent_path, CAST(retry_count AS INTEGER) AS retry_count,
              {_iso("CASE WHEN members = 2 THEN done ELSE t + 120000000 END")} AS outcome_time
            FROM sized WHERE kind = 0 AND (members = 2 OR nt IS NULL OR nk <> 0 OR nt - t > 120000000))"""
oracle("move_saga", _MOVES + " SELECT * FROM moves")
oracle("move_confirmed", _MOVES + """
  SELECT user_id, email, permanent_path AS file_path, file_name, file_size, media_type, upload_time
  FROM moves WHERE _type = 'confirmed'""")
_RETRY = """user_id, email, replace(path, 'files/', 'uploads/') AS file_path, file_name, file_size, media_type,
         time AS upload_time, path AS permanent_path"""
oracle("upload_retry_reentry", f"""
  SELECT {_RETRY}, CAST(k // 20 + 1 AS INTEGER) AS retry_count FROM clicks WHERE value < 50""")
oracle("upload_retry_step", f"""
  SELECT CASE WHEN value < 50 THEN 'received' WHEN k // 20 >= 3 THEN 'dead_letter' ELSE 'retry' END AS outcome, {_RETRY},
         CAST(CASE WHEN value >= 50 AND k // 20 >= 3 THEN k // 20 ELSE k // 20 + 1 END AS INTEGER) AS retry_count,
         CASE WHEN value >= 50 AND k // 20 >= 3 THEN 'max retries exceeded' END AS failure_reason,
         CASE WHEN value >= 50 THEN time END AS outcome_time FROM clicks""")
oracle("delete_retry_route", """
  SELECT CASE WHEN k >= 60 THEN 'dead_letter' ELSE 'retry' END AS outcome, user_id, path AS file_path, file_name,
         media_type, file_size, request_id,
         CAST(CASE WHEN k >= 60 THEN k // 20 ELSE k // 20 + 1 END AS INTEGER) AS retry_count,
         CASE WHEN k >= 60 THEN 'remove failed' END AS failure_reason, time AS outcome_time
  FROM errors WHERE value >= 30""")
oracle("orphan_dead_letters", """
  SELECT user_id, path AS permanent_path, time AS dead_letter_time FROM errors e
  WHERE NOT EXISTS (SELECT 1 FROM purchases p WHERE p.path = e.path AND p.time > e.time)""")

# OLAP and serving -------------------------------------------------------------------------------

oracle("olap_unified_dedup", """
  SELECT event_id, strftime(date_trunc('millisecond', CAST(rtrim(event_time, 'Z') AS TIMESTAMP)),
                            '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time, event_type, user_id, upper(email) AS email,
         device_id, user_agent, ip_address, 2 AS version
  FROM (SELECT DISTINCT * FROM unified)""")
VIEWS["viewers"] = "SELECT DISTINCT user_id AS viewer FROM signups"
oracle("visible_notifications", """
  SELECT v.viewer, n.* FROM viewers v JOIN log n
    ON n.user_id = v.viewer OR (n.event_type = 'user.message' AND n.recipient_id = v.viewer)
  WHERE NOT (n.event_type = 'user.message' AND n.visibility = 'broadcast')
  UNION ALL SELECT '*', n.* FROM log n WHERE n.event_type = 'user.message' AND n.visibility = 'broadcast'""")
oracle("viewer_notifications", """
  SELECT * FROM log WHERE user_id = 'u5'
    OR (event_type = 'user.message' AND (visibility = 'broadcast' OR recipient_id = 'u5'))""")
oracle("own_credits", f"""
  SELECT * FROM ({ORACLES['ledger_signup_bonus']}) WHERE user_id IN (SELECT user_id FROM messages)""")
oracle("history_top20", """
  WITH seen AS (
    SELECT v.viewer, n.event_type, n.payload, n.event_time, n.user_id,
           row_number() OVER (PARTITION BY v.viewer ORDER BY n.event_time DESC, n.event_type DESC, n.payload DESC,
                              n.user_id DESC) AS r
    FROM viewers v JOIN log n ON n.user_id = v.viewer
      OR (n.event_type = 'user.message' AND (n.visibility = 'broadcast' OR n.recipient_id = v.viewer)))
  SELECT viewer, event_type, payload, event_time, user_id,
         CAST(count(*) OVER (PARTITION BY viewer) - r + 1 AS INTEGER) AS position FROM seen WHERE r <= 20""")
oracle("latest_notification", """
  SELECT user_id, event_type, event_time, payload FROM log QUALIFY row_number() OVER (
    PARTITION BY user_id, event_type ORDER BY event_time DESC, payload DESC) = 1""")
oracle("request_outcomes", """
  WITH answers AS (
    SELECT 'media.delete_rejected' AS event_type, NULL AS request_id, path, us AS t, '2' AS src FROM views
    UNION ALL SELECT 'media.file_deleted', NULL, path, us, '1' FROM errors
    UNION ALL SELECT 'media.file_deleted', request_id, path, us + CAST(k AS BIGINT) * 120000000, '0' FROM clicks WHERE value < 20),
  hits AS (
    SELECT c.request_id, 0 AS how, a.t, a.event_type FROM clicks c JOIN answers a ON a.request_id = c.request_id
    WHERE a.t >= c.us AND a.t - c.us <= 3600000000
    UNION ALL
    SELECT c.request_id, 1, a.t, a.event_type FROM clicks c JOIN answers a ON a.path = c.path
    WHERE a.t >= c.us AND a.t - c.us <= 3600000000),
  best AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY how, t, event_type) = 1)
  SELECT c.request_id, c.time AS request_time, coalesce(b.event_type, 'timeout') AS outcome,
         strftime(make_timestamp(b.t), '%Y-%m-%dT%H:%M:%S.%fZ') AS outcome_time,
         CASE b.how WHEN 0 THEN 'request_id' WHEN 1 THEN 'file_path' END AS matched_by,
         (b.t - c.us) / 1000000 AS latency_s
  FROM clicks c LEFT JOIN best b USING (request_id)""")

oracle("olap_job", "SELECT * EXCLUDE (version) FROM (" + ORACLES["olap_unified_dedup"] + ")")

# ingest -----------------------------------------------------------------------------------------

oracle("frame_check", """
  SELECT event_type AS topic, CASE WHEN event_type NOT IN ('purchase', 'error') THEN CAST(k AS BIGINT) END AS schema_id,
         CASE WHEN event_type NOT IN ('purchase', 'error') THEN 'b' || event_id END AS body,
         CASE event_type WHEN 'purchase' THEN 'too_short' WHEN 'error' THEN 'bad_magic_byte' END AS reason FROM ev""")
oracle("json_contract", """
  WITH shaped AS (
    SELECT *, event_type IN ('click', 'signup') AS ok,
           '{"user_id":"' || user_id || '","file_name":"' || file_name || '","media_type":"' || media_type
             || '","request_id":"' || request_id AS head FROM ev)
  SELECT CAST(event_id AS VARCHAR) AS record_id, CASE WHEN ok THEN user_id END AS user_id,
         CASE WHEN ok THEN file_name END AS file_name, CASE WHEN ok THEN media_type END AS media_type,
         CASE WHEN ok THEN file_size END AS file_size, CASE WHEN ok THEN request_id END AS request_id,
         CASE WHEN ok THEN time END AS request_time,
         CASE event_type WHEN 'error' THEN '{"user_id":"' || user_id
           WHEN 'view' THEN head || '","request_time":"' || time || '","file_size":"' || file_size || '"}'
           WHEN 'purchase' THEN head || '","file_size":' || file_size || '}' END AS value,
         CASE event_type WHEN 'error' THEN 'invalid_json' WHEN 'view' THEN 'schema_violation'
           WHEN 'purchase' THEN 'schema_violation' END AS reason FROM shaped""")
oracle("route_events", """
  SELECT CASE event_type WHEN 'view' THEN 'Login' WHEN 'error' THEN 'SIGNOUT' WHEN 'purchase' THEN '../admin'
           ELSE event_type END AS route_key, request_id AS value,
         CASE event_type WHEN 'view' THEN 'public.identity.login.events' WHEN 'signup' THEN 'public.identity.signup.events'
           WHEN 'error' THEN 'public.identity.signout.events' END AS topic,
         CASE WHEN event_type IN ('click', 'purchase') THEN 'forbidden' END AS reason FROM ev""")
oracle("dispatch_topics", """
  SELECT event_type AS topic, CASE WHEN event_type IN ('error', 'signup') THEN 'unknown_topic' END AS reason FROM ev""")
oracle("require_fields", """
  SELECT request_id, CASE WHEN value >= 5 THEN file_name ELSE '' END AS file_name,
         CASE WHEN value >= 10 THEN media_type END AS media_type,
         CASE WHEN value < 5 THEN 'missing file_name' WHEN value < 10 THEN 'missing media_type' END AS reason
  FROM clicks""")
oracle("validate_intents", """
  WITH judged AS (SELECT *, CASE WHEN value < 5 THEN 'invalid file_name' WHEN value < 10 THEN 'invalid media_type'
      WHEN value < 15 THEN 'invalid file_size'
      WHEN media_type IN ('application/pdf', 'text/plain', 'image/bmp') THEN 'media_type not allowed' END AS reason
    FROM clicks)
  SELECT CASE WHEN reason IS NULL THEN 'internal.media.upload.intent' END AS topic,
         CASE WHEN reason IS NULL THEN user_id END AS user_id, CASE WHEN reason IS NULL THEN file_name END AS file_name,
         CASE WHEN reason IS NULL THEN media_type END AS media_type,
         CASE WHEN reason IS NULL THEN file_size END AS file_size, request_id,
         CASE WHEN reason IS NULL THEN time END AS request_time, reason FROM judged""")
oracle("received_from_objects", """
  SELECT user_id, email, 'uploads/' || user_id || '/' || event_id || '/a b+' || file_name AS file_path,
         'a b+' || file_name AS file_name, file_size,
         CASE WHEN value < 20 THEN 'application/octet-stream' ELSE media_type END AS media_type, time AS upload_time,
         'files/' || user_id || '/' || event_id || '/a b+' || file_name AS permanent_path, 0 AS retry_count
  FROM purchases""")
oracle("ready_from_objects", """
  SELECT 'files/' || user_id || '/' || event_id || '/a b+' || file_name AS file_path, file_size, time AS upload_time
  FROM views""")
oracle("cdc_login", """
  SELECT user_id, email, time AS login_time, 'device-' || k AS device_id, 'agent/' || k AS user_agent,
         CAST(NULL AS VARCHAR) AS ip_address FROM views WHERE value < 100""")
oracle("cdc_signup", "SELECT user_id, email, signup_time FROM signups")
oracle("cdc_signout", """
  SELECT e.user_id, s.email, e.time AS signout_time, CAST(NULL AS VARCHAR) AS device_id, 'agent/' || k AS user_agent,
         '10.0.0.' || k AS ip_address
  FROM errors e LEFT JOIN (SELECT DISTINCT user_id, email FROM signups) s USING (user_id)""")

# scalar functions -------------------------------------------------------------------------------

oracle("file_size_text", """
  WITH sized AS (SELECT event_id, file_size * (k + 1) * (k + 1) AS size FROM ev),
  scaled AS (SELECT *, CASE WHEN size <= 0 THEN 0 ELSE least(4, CAST(floor(ln(size) / ln(1024)) AS INTEGER)) END AS p
             FROM sized)
  SELECT event_id, CAST(size AS BIGINT) AS size, CASE WHEN size <= 0 THEN '0 B' ELSE
    regexp_replace(CAST(CAST(round(size / power(1024, p), 1) AS DECIMAL(20,1)) AS VARCHAR), '\\.0$', '') || ' '
      || ['B', 'KB', 'MB', 'GB', 'TB'][p + 1] END AS size_text FROM scaled""")
oracle("media_category", """
  SELECT event_id, media_type, CASE WHEN regexp_matches(media_type, '^(image|video|audio)/')
           THEN regexp_extract(media_type, '^[a-z]+') ELSE 'unknown' END AS category,
         media_type NOT IN ('application/pdf', 'text/plain', 'image/bmp') AS allowed FROM ev""")
oracle("notification_text", f"""
  SELECT user_id, 'identity.login' AS event_type, login_time AS event_time,
         '🚀 Flink mapped Login: ' || login_time AS text FROM logins
  UNION ALL SELECT user_id, 'identity.signup', signup_time, '🎉 Flink mapped Signup: ' || signup_time FROM signups
  UNION ALL SELECT user_id, 'identity.signout', signout_time, '👋 Flink mapped Signout: ' || signout_time FROM signouts
  UNION ALL SELECT user_id, 'user.message', timestamp, '💬 ' || split_part(email, '@', 1) || ': ' || message FROM messages
  UNION ALL SELECT user_id, 'credit.balance_changed', signup_time, '📌 credit.balance_changed: ' || signup_time FROM signups
  UNION ALL SELECT user_id, 'media.upload_ready', {_iso("t")}, '📤 Upload ready: ' || file_path FROM signed
  UNION ALL SELECT user_id, 'media.upload_rejected', time, '❌ Upload rejected: insufficient_credits' FROM clicks
  UNION ALL SELECT user_id, 'media.upload_completed', time, '✅ Upload complete: ' || file_name FROM purchases
  UNION ALL SELECT user_id, 'media.upload_expired', time, '⏰ Upload expired: ' || path FROM clicks
  UNION ALL SELECT user_id, 'media.upload_failed', time, '❌ Upload failed: max retries exceeded' FROM errors
  UNION ALL SELECT user_id, 'media.download_ready', time, '📥 Download ready: ' || path FROM views
  UNION ALL SELECT user_id, 'media.download_rejected', time, '❌ Download rejected: not_found' FROM views
  UNION ALL SELECT user_id, 'media.file_deleted', time, '🗑️ File deleted: ' || file_name FROM errors
  UNION ALL SELECT user_id, 'media.delete_rejected', time, '❌ Delete rejected: not_found' FROM views""")
oracle("retry_count_int", "SELECT event_id, CASE WHEN value < 10 THEN 0 ELSE k END AS retry_count FROM ev")

# metrics ----------------------------------------------------------------------------------------

VIEWS["minutes"] = """
  SELECT event_type, CASE WHEN value >= 100 THEN '503' ELSE '200' END AS status, date_trunc('minute', ts) AS m,
         count(*) AS n FROM ev GROUP BY ALL"""
VIEWS["counter"] = """
  SELECT event_type, status, m, sum(n) OVER (PARTITION BY event_type, status, CAST(m AS DATE) ORDER BY m) AS total
  FROM minutes"""


def _rates(source: str, keys: str) -> str:
    """Increase per second at each minute: pairs of neighbouring samples that both lie in the five minutes before it."""
    same = " AND ".join(f"a.{k.strip()} = b.{k.strip()}" for k in keys.split(","))
    return f"""
  SELECT {keys}, t AS m, sum(step) / (epoch(max(upto)) - epoch(min(since))) AS rate FROM (
    SELECT {", ".join("a." + k.strip() for k in keys.split(","))}, g.t, a.m AS since, b.m AS upto,
           CASE WHEN b.total >= a.total THEN b.total - a.total ELSE b.total END AS step
    FROM (SELECT *, lead(m) OVER (PARTITION BY {keys} ORDER BY m) AS next FROM {source}) a
    JOIN {source} b ON {same} AND b.m = a.next
    JOIN every_minute g ON a.m > g.t - INTERVAL 5 MINUTES AND b.m <= g.t) GROUP BY {keys}, t"""


VIEWS["every_minute"] = """
  SELECT unnest(range(min(m), max(m) + INTERVAL 6 MINUTES, INTERVAL 1 MINUTE)) AS t FROM minutes"""
VIEWS["disk_minutes"] = """
  SELECT event_type, date_trunc('minute', ts) AS m, greatest(0, 100 - floor(sum(value) / count(*))) AS free FROM ev GROUP BY ALL"""
VIEWS["disk_seen"] = """
  SELECT event_type, t AS m, arg_max(free, d.m) AS free
  FROM disk_minutes d JOIN every_minute ON d.m <= t AND d.m > t - INTERVAL 5 MINUTES GROUP BY event_type, t"""
_M = "strftime(m, '%Y-%m-%dT%H:%M:%S.%fZ')"
VIEWS["rates"] = _rates("counter", "event_type, status")
oracle("topic_status_counts", """
  SELECT event_type AS topic, CASE WHEN event_type IN ('purchase', 'error') THEN 'error' ELSE 'success' END AS status,
         count(*) AS n FROM ev GROUP BY ALL""")
oracle("topic_errors", """
  SELECT event_type AS topic, count(*) AS n FROM ev WHERE event_type IN ('purchase', 'error') GROUP BY ALL""")
oracle("metric_rollup_10s", """
  SELECT 'event_value' AS metric, '{"kind":"' || event_type || '"}' AS series,
         strftime(time_bucket(INTERVAL 10 SECONDS, ts), '%Y-%m-%dT%H:%M:%S.%fZ') AS bucket, count(*) AS n,
         round(sum(value), 6) AS total, arg_max(value, ts) AS last FROM ev GROUP BY ALL""")
oracle("metric_rate", f"""
  SELECT '{{"http_response_status_code":"' || status || '","otel_scope_name":"' || event_type || '"}}' AS series,
         {_M} AS ts, round(rate, 6) AS rate FROM rates""")
oracle("metric_rate_by", f"""
  SELECT event_type AS otel_scope_name, {_M} AS ts, round(sum(rate), 6) AS rate FROM rates GROUP BY ALL""")
oracle("error_ratio", f"""
  SELECT event_type AS otel_scope_name, {_M} AS ts,
         round(sum(CASE WHEN status = '503' THEN rate ELSE 0 END) / nullif(sum(rate), 0), 6) AS ratio
  FROM rates GROUP BY event_type, m""")
VIEWS["edges"] = """
  SELECT unnest([10.0, 25.0, 50.0, 100.0, 250.0, 'infinity'::DOUBLE]) AS upto,
         unnest(['1', '2.5', '5', '10', '25', '+Inf']) AS le"""
VIEWS["buckets"] = """
  SELECT event_type, le, m, sum(n) OVER (PARTITION BY event_type, le, CAST(m AS DATE) ORDER BY m) AS total
  FROM (SELECT event_type, le, date_trunc('minute', ts) AS m, count(*) FILTER (WHERE value <= upto) AS n
        FROM ev CROSS JOIN edges GROUP BY ALL)"""
VIEWS["bucket_rates"] = _rates("buckets", "event_type, le")
oracle("histogram_quantile", f"""
  WITH q AS (SELECT unnest([0.5, 0.95, 0.99])::DOUBLE AS q),
  cum AS (SELECT event_type, m, round(rate, 9) AS rate,
                 CASE le WHEN '+Inf' THEN 'infinity'::DOUBLE ELSE le::DOUBLE END AS edge FROM bucket_rates),
  shaped AS (SELECT *, max(rate) OVER g AS total, coalesce(lag(rate) OVER e, 0) AS below, coalesce(lag(edge) OVER e, 0) AS lower
             FROM cum WINDOW g AS (PARTITION BY event_type, m), e AS (PARTITION BY event_type, m ORDER BY edge)),
  hit AS (SELECT * FROM shaped, q WHERE total > 0 AND rate >= q * total
          QUALIFY row_number() OVER (PARTITION BY event_type, m, q ORDER BY edge) = 1)
  SELECT event_type AS otel_scope_name, {_M} AS ts, q,
         round(CASE WHEN isinf(edge) THEN lower WHEN rate > below
           THEN lower + (edge - lower) * (q * total - below) / (rate - below) ELSE edge END, 6) AS quantile FROM hit""")


def _lasting(source: str, key: str, condition: str, seconds: int) -> str:
    """Runs of true points by the difference of numberings, cut at gaps over five minutes."""
    return f"""
  WITH flagged AS (SELECT *, {condition} AS ok, lag(m) OVER (PARTITION BY {key} ORDER BY m) AS pm FROM {source}),
  marked AS (SELECT *, sum(CASE WHEN NOT ok OR pm IS NULL OR m - pm > INTERVAL 300 SECONDS THEN 1 ELSE 0 END)
               OVER (PARTITION BY {key} ORDER BY m) AS run FROM flagged),
  held AS (SELECT *, CASE WHEN ok THEN min(m) FILTER (WHERE ok) OVER (PARTITION BY {key}, run) END AS since FROM marked),
  judged AS (SELECT *, ok AND m - since >= INTERVAL {seconds} SECONDS AS firing FROM held)"""


_SINCE = "strftime(since, '%Y-%m-%dT%H:%M:%S.%fZ') AS since"
VIEWS["service_rates"] = "SELECT event_type, m, sum(rate) AS rate FROM rates GROUP BY ALL"
oracle("alert_for", _lasting("service_rates", "event_type", "rate > 0", 300) + f"""
  SELECT event_type AS otel_scope_name, {_M} AS ts, {_SINCE}, firing FROM judged""")
VIEWS["spine"] = """
  SELECT unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 00:01:00', INTERVAL 1 MINUTE)) AS m"""
oracle("metric_absent", f"""
  SELECT {_M} AS ts, 1.0::DOUBLE AS value FROM spine s WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT DISTINCT m AS t FROM minutes WHERE event_type = 'error')
    WHERE t <= s.m AND t > s.m - INTERVAL 5 MINUTES)""")
oracle("disk_ratio", f"SELECT event_type AS disk, {_M} AS ts, free / 100 AS ratio FROM disk_seen")
oracle("metric_latest", """
  SELECT event_type AS otel_scope_name, CAST(sum(total) AS DOUBLE) AS value FROM (
    SELECT event_type, status, arg_max(total, m) AS total FROM counter GROUP BY ALL) GROUP BY event_type""")
oracle("saga_funnel", """
  SELECT strftime(time_bucket(INTERVAL 300 SECONDS, ts), '%Y-%m-%dT%H:%M:%S.%fZ') AS bucket,
         count(*) FILTER (WHERE k // 13 = 0) AS intents, count(*) FILTER (WHERE k // 13 = 1) AS approved,
         count(*) FILTER (WHERE k // 13 = 2) AS confirmed, count(*) FILTER (WHERE k // 13 = 3) AS retry,
         count(*) FILTER (WHERE k // 13 = 4) AS expired, count(*) FILTER (WHERE k // 13 = 5) AS dead_letter,
         count(*) FILTER (WHERE k // 13 = 6) AS delete_retry
  FROM ev WHERE k < 91 GROUP BY bucket""")
oracle("consumer_lag", """
  SELECT 'indexer' AS "group", 'events' AS topic, CAST(sum(greatest(e.o - c.o, 0)) AS BIGINT) AS lag
  FROM (SELECT k // 10 AS p, arg_max(event_id, ts) AS o FROM ev GROUP BY ALL) e
  JOIN (SELECT k // 10 AS p, arg_max(event_id, ts) AS o FROM clicks GROUP BY ALL) c USING (p)""")
VIEWS["topic_counter"] = """
  SELECT topic, m, sum(n) OVER (PARTITION BY topic, CAST(m AS DATE) ORDER BY m) AS total FROM (
    SELECT CASE event_type WHEN 'error' THEN 'internal.media.upload.dead-letter' ELSE 'public.media.' || event_type END
             AS topic, date_trunc('minute', ts) AS m, count(*) AS n FROM ev GROUP BY ALL)"""
VIEWS["topic_rates"] = f"SELECT * FROM ({_rates('topic_counter', 'topic')}) WHERE topic LIKE 'internal%'"
_DLQ = _lasting("topic_rates", "topic", "rate > 0", 120)
oracle("dlq_growth", _DLQ + f"""
  SELECT '{{"topic":"' || topic || '"}}' AS series, {_M} AS ts, {_SINCE}, round(rate, 6) AS rate FROM judged WHERE firing""")
VIEWS["all_ratio"] = """
  SELECT '{}' AS key, m, sum(CASE WHEN status = '503' THEN rate ELSE 0 END) / nullif(sum(rate), 0) AS v
  FROM rates GROUP BY m"""
VIEWS["all_buckets"] = """
  SELECT m, CASE le WHEN '+Inf' THEN 'infinity'::DOUBLE ELSE le::DOUBLE END AS edge, sum(rate) AS rate
  FROM bucket_rates GROUP BY ALL"""
VIEWS["all_disk"] = "SELECT event_type, m, 1 - free / 100 AS used FROM disk_seen"


def _fired(name: str, source: str, key: str, series: str, value: str, condition: str, seconds: int) -> str:
    return f"""SELECT * FROM ({_lasting(source, key, condition, seconds)}
      SELECT '{name}' AS alert, {series} AS series, {_M} AS ts, {_SINCE}, round({value}, 6) AS value
      FROM judged WHERE firing)"""


oracle("alert_rules", " UNION ALL ".join([
    _fired("Go Service High Error Rate", "all_ratio", "key", "key", "v", "coalesce(v > 0.05, false)", 300),
    _fired("Media Saga Dead-Letter Queue Growing", "topic_rates", "topic", "'{\"topic\":\"' || topic || '\"}'", "rate",
           "rate > 0", 120),
    _fired("Redpanda Disk Usage High", "all_disk", "event_type", "'{\"disk\":\"' || event_type || '\"}'", "used",
           "used > 0.8", 300)]))

# governance -------------------------------------------------------------------------------------

oracle("masked_logins", """
  SELECT user_id, sha256(email) AS email, login_time, device_id, user_agent, sha256(ip_address) AS ip_address
  FROM logins""")
oracle("contract_violations", """
  SELECT 'email is null' AS rule, count(*) AS n FROM unified WHERE email IS NULL HAVING count(*) > 0
  UNION ALL SELECT 'type is known', count(*) FROM unified WHERE event_type = 'SIGNOUT' HAVING count(*) > 0""")
oracle("resolved_payloads", """
  WITH judged AS (
    SELECT *, CAST(k AS BIGINT) % 4 + 1 AS version,
           CASE CAST(k AS BIGINT) % 4 + 1 WHEN 3 THEN 'size: string is no bigint' WHEN 4 THEN 'unknown version'
                WHEN 2 THEN CASE WHEN value < 80 THEN NULL ELSE 'user_id is null' END END AS why FROM ev)
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(version AS VARCHAR) AS version,
         CASE WHEN why IS NULL THEN user_id END AS user_id, CASE WHEN why IS NULL THEN CAST(CAST(k AS BIGINT) AS VARCHAR) END AS size,
         CASE WHEN why IS NULL THEN CASE version WHEN 1 THEN '' ELSE time END END AS time, CAST(NULL AS VARCHAR) AS device,
         why AS reason FROM judged""")
oracle("access_patterns", """
  SELECT event_type, count(*) AS n, 'by_owner' AS target FROM log GROUP BY ALL
  UNION ALL SELECT event_type, count(*), 'by_recipient' FROM log
  WHERE event_type = 'user.message' AND recipient_id IS NOT NULL GROUP BY event_type
  UNION ALL SELECT event_type, count(*), 'broadcast' FROM log
  WHERE event_type = 'user.message' AND visibility = 'broadcast' GROUP BY event_type""")


# streams ----------------------------------------------------------------------------------------

for _stream, _batch in [("stream_ttl_expired", "ttl_expired"), ("stream_move_saga", "move_saga"),
                        ("stream_credit_check", "credit_check"), ("stream_dedup", "unified_events"), ("stream_dedup_replays", "unified_events"),
                        ("partition_rewrite", "login_aggregates_backfill"), ("stream_credit_balances", "credit_balances"),
                        ("stream_history_top20", "history_top20"), ("olap_delta_job", "olap_job"),
                        ("stream_metric_rollup_10s", "metric_rollup_10s"), ("stream_saga_funnel", "saga_funnel"),
                        ("stream_request_outcomes", "request_outcomes"), ("stream_alert_for", "alert_for"),
                        ("stream_metric_absent", "metric_absent")]:
    oracle(_stream, ORACLES[_batch])
oracle("stream_ledger", f"{ORACLES['ledger_signup_bonus']} UNION ALL {ORACLES['ledger_refund']}")

oracle("stream_download_outcomes", """
  SELECT outcome, user_id, path AS file_path, request_id, CASE WHEN outcome = 'signed' THEN 'https://store/' || path END AS download_url,
         CASE WHEN outcome <> 'signed' THEN CASE WHEN found THEN 'internal_error' ELSE 'not_found' END END AS reason, time AS outcome_time
  FROM media_judged WHERE kind = 2""")
oracle("stream_delete_outcomes", """
  SELECT outcome, user_id, path AS file_path, CASE WHEN outcome <> 'deleted' THEN request_id END AS request_id,
         CASE WHEN outcome = 'deleted' THEN f_name END AS file_name, CASE WHEN outcome = 'deleted' THEN f_type END AS media_type,
         CASE WHEN outcome <> 'deleted' THEN CASE WHEN found THEN 'internal_error' ELSE 'not_found' END END AS reason, time AS outcome_time
  FROM media_judged WHERE kind = 1
  UNION ALL SELECT 'retry', user_id, path, request_id, f_name, f_type, NULL, time
  FROM media_judged WHERE outcome = 'deleted' AND event_id % 3 <> 0""")

# Chains of retries, attempt by attempt: `walk` is a chain's row in the loop's topic before each attempt.
oracle("stream_delete_retry_loop", """
  WITH walk AS (
    SELECT request_id, path AS file_path, event_id, k // 20 AS c FROM errors
    UNION ALL SELECT request_id, file_path, event_id, c + 1 FROM walk WHERE (event_id + c) % 4 <> 0 AND c < 3)
  SELECT 'internal.media.delete.retry' AS topic, request_id, file_path, CAST(c AS VARCHAR) AS retry_count FROM walk
  UNION SELECT 'internal.media.delete.dead-letter', request_id, file_path, CAST(c AS VARCHAR) FROM walk
  WHERE (event_id + c) % 4 <> 0 AND c >= 3""")
oracle("stream_upload_retry_loop", """
  WITH walk AS (
    SELECT user_id, path AS permanent_path, time AS upload_time, file_size, k // 20 AS c FROM clicks
    UNION ALL SELECT user_id, permanent_path, upload_time, file_size, c + 1 FROM walk WHERE (file_size + c) % 3 <> 0 AND c < 3)
  SELECT 'internal.media.upload.retry' AS topic, user_id, permanent_path, upload_time, CAST(c AS VARCHAR) AS retry_count FROM walk
  UNION SELECT 'internal.media.upload.received', user_id, permanent_path, upload_time, CAST(c + 1 AS VARCHAR) FROM walk
  WHERE (file_size + c) % 3 = 0
  UNION SELECT 'internal.media.upload.dead-letter', user_id, permanent_path, upload_time, CAST(c AS VARCHAR) FROM walk
  WHERE (file_size + c) % 3 <> 0 AND c >= 3""")


def oracle_statements() -> dict[str, str]:
    return {name: statement(name) for name in ORACLES}
