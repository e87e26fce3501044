"""FIXTURES.md mappings as DuckDB CTEs over the raw TESTDATA views.

Only the raw tables are registered in the oracle, so each oracle query starts
with these CTEs.  They restate the mapping independently of the Spark code.
"""

FIXTURE_CTES: list[tuple[str, str]] = [
    ("params", """
        SELECT date_trunc('day', max(ts)) AS as_of,
               date_trunc('day', max(ts)) - INTERVAL 28 DAY AS cutoff,
               timezone('America/Denver', timezone('UTC', date_trunc('day', max(ts)))) AS local_now,
               CAST(epoch(date_trunc('day', max(ts))) AS BIGINT) AS as_of_epoch
        FROM events"""),
    ("order_params", """
        SELECT date_trunc('day', max(o_orderdate)) - INTERVAL 28 DAY AS cutoff FROM orders"""),
    ("fx_alias_type", """
        SELECT * FROM (VALUES (1, 'anonymous_id'), (2, 'email_address'), (3, 'subscriber_id'))
               t(alias_type_id, alias_type)"""),
    ("fx_alias", """
        SELECT CAST(a.uid AS VARCHAR) AS cim_id, 'anon-' || CAST(a.uid AS VARCHAR) AS alias_value,
               1 AS alias_type_id, s.first_ts AS first_used_datetime, s.last_ts AS last_used_datetime
        FROM (SELECT c_custkey AS uid FROM customer UNION SELECT user_id FROM events) a
        LEFT JOIN (SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY user_id) s
               ON s.user_id = a.uid
        UNION ALL
        SELECT CAST(c_custkey AS VARCHAR), 'user' || CAST(c_custkey AS VARCHAR)
                   || CASE WHEN c_custkey % 29 = 0 THEN '@Staff.example.com ' ELSE '@example.com' END,
               2, CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP)
        FROM customer
        UNION ALL
        SELECT CAST(c_custkey AS VARCHAR), 'S-' || CAST(c_custkey AS VARCHAR) || '-' || CAST(n AS VARCHAR), 3,
               CAST(NULL AS TIMESTAMP),
               CASE WHEN (c_custkey + n) % 5 = 0 THEN CAST(NULL AS TIMESTAMP)
                    ELSE TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_custkey % 40 + n * (c_custkey % 3) AS INTEGER))
               END
        FROM customer, (VALUES (1), (2)) t(n)"""),
    ("fx_email_engagement", """
        SELECT lower(trim('user' || CAST(c_custkey AS VARCHAR)
                   || CASE WHEN c_custkey % 29 = 0 THEN '@Staff.example.com ' ELSE '@example.com' END))
                   AS lower_email_address,
               CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS cim_id,
               CASE WHEN c_custkey % 29 = 0 THEN 1 ELSE 0 END AS is_employee,
               CASE WHEN c_custkey % 3 <> 1 THEN 'Most Likely' ELSE 'Unlikely' END AS email_click_likelihood,
               CAST(CAST((SELECT as_of FROM params) AS DATE) - back AS DATE) AS file_name_date,
               CAST(CAST((SELECT as_of FROM params) AS DATE) - back AS TIMESTAMP) + INTERVAL 6 HOUR AS extract_timestamp
        FROM customer, (VALUES (0), (1)) t(back)"""),
    ("fx_subscribers", """
        SELECT CASE WHEN n = 1 THEN e ELSE '  ' || upper(e) || ' ' END AS email_address,
               'S-' || CAST(c_custkey AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS subscriber_id,
               TIMESTAMP '2023-01-01 00:00:00' + to_days(CAST(c_custkey % 300 + n AS INTEGER)) AS date_created,
               CASE WHEN (c_custkey + n) % 4 <> 0 THEN 'Active' ELSE 'Unsubscribed' END AS status
        FROM (SELECT c_custkey, lower(trim('user' || CAST(c_custkey AS VARCHAR)
                     || CASE WHEN c_custkey % 29 = 0 THEN '@Staff.example.com ' ELSE '@example.com' END)) AS e
              FROM customer) c, (VALUES (1), (2)) t(n)"""),
    ("fx_events", """
        SELECT event_id, event_type, ts, 'anon-' || CAST(user_id AS VARCHAR) AS anonymous_id,
               CASE WHEN event_id % 211 = 0 THEN NULL ELSE json_extract_string(props, '$.k') END AS post_id
        FROM events"""),
    ("fx_views", """
        SELECT anonymous_id, post_id, ts AS received_at FROM fx_events WHERE event_type = 'view'"""),
    ("fx_clicks", """
        SELECT anonymous_id, post_id, ts AS received_at FROM fx_events WHERE event_type = 'click'"""),
    ("fx_commission", """
        SELECT anonymous_id, post_id, CAST(1 AS BIGINT) AS order_count, ts AS commission_date
        FROM fx_events WHERE event_type = 'purchase'"""),
    ("fx_sessions", """
        SELECT 'anon-' || CAST(o_custkey // 10 AS VARCHAR) AS anonymous_id, o_totalprice * 0.04 AS total_commission,
               o_orderdate AS session_start_at
        FROM orders"""),
    ("fx_posts", """
        SELECT doc_id AS id,
               CASE WHEN doc_id % 11 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'tip' ELSE 'brag' END ELSE 'post' END
                   AS post_type,
               CASE WHEN doc_id % 17 = 0 THEN 'draft' ELSE 'publish' END AS post_status,
               text AS post_content,
               TIMESTAMP '2023-06-01 00:00:00' + to_days(CAST(doc_id % 240 AS INTEGER)) AS post_date,
               TIMESTAMP '2023-06-01 00:00:00' + to_days(CAST(doc_id % 240 + doc_id % 5 AS INTEGER)) AS post_modified,
               'item-' || CAST(doc_id AS VARCHAR) AS post_name,
               'Item ' || CAST(doc_id AS VARCHAR) AS post_title,
               'http://origin.example.com/x/wp-content/' || CAST(doc_id AS VARCHAR) || '.png' AS guid
        FROM documents"""),
    ("fx_post_versions", """
        SELECT * FROM fx_posts
        UNION ALL
        SELECT id, post_type, post_status, post_content || ' updated', post_date + INTERVAL 1 DAY,
               post_modified + INTERVAL 1 DAY, post_name, post_title, guid
        FROM fx_posts WHERE id % 9 = 0
        UNION ALL
        SELECT * FROM fx_posts WHERE id % 9 = 1"""),
    ("fx_postmeta", """
        SELECT doc_id AS post_id, doc_id * 10 + n AS meta_id, 'expiry_date' AS meta_key,
               CASE WHEN (doc_id + n) % 23 = 0 THEN ''
                    WHEN (doc_id + n) % 19 = 0 THEN NULL
                    ELSE CAST((SELECT as_of_epoch FROM params) + 86400 * ((doc_id * 37) % 61 - 20 + n) AS VARCHAR)
               END AS meta_value
        FROM documents, (VALUES (1), (2)) t(n) WHERE doc_id % 7 <> 0
        UNION ALL
        SELECT doc_id, doc_id * 10 + 3, '_thumbnail_id',
               CASE WHEN doc_id % 13 = 0 THEN 'none' ELSE CAST((doc_id * 3) % 200 AS VARCHAR) END
        FROM documents WHERE doc_id % 4 <> 0
        UNION ALL
        SELECT doc_id, doc_id * 10 + 4, 'published_permalink',
               'http://posts.example.com/tips/item-' || CAST(doc_id AS VARCHAR) || '/'
        FROM documents WHERE doc_id % 11 = 0"""),
    ("fx_options", """
        SELECT * FROM (VALUES ('siteurl', 'https://posts.example.com'),
                              ('permalink_structure', '/%year%/%monthnum%/%day%/%postname%/'))
               t(option_name, option_value)"""),
    ("fx_categories", """
        SELECT doc_id AS post_id, taxonomy, slug,
               TIMESTAMP '2023-06-01 00:00:00' + to_days(CAST(doc_id % 240 - age AS INTEGER)) AS post_date
        FROM (
            SELECT doc_id, 'category' AS taxonomy, lang AS slug, 0 AS age FROM documents
            UNION ALL SELECT doc_id, 'category', source, 0 FROM documents
            UNION ALL SELECT doc_id, 'store', 'store-' || CAST(doc_id % 7 AS VARCHAR), 0 FROM documents
            UNION ALL SELECT doc_id, 'category', 'online-deals', 0 FROM documents WHERE doc_id % 5 = 0
            UNION ALL SELECT doc_id, 'category', 'stale', 30 FROM documents WHERE doc_id % 6 = 0
        ) s"""),
    ("fx_seed_log", """
        SELECT CAST(user_id AS VARCHAR) AS cim_id, '1111111' AS post_id FROM (SELECT DISTINCT user_id FROM events) u
        UNION ALL
        SELECT CAST(user_id AS VARCHAR), CAST((10 - user_id % 10) % 10 + j * 10 AS VARCHAR)
        FROM (SELECT DISTINCT user_id FROM events) u, range(0, 10) r(j)"""),
]
