"""SQL statements of the expected results, for DuckDB over the same tables.

They state the meaning of each query in plain SQL (global windows, self-joins, sub-queries),
not the way the Spark code computes it.
"""

from __future__ import annotations

SHARED = {
    "products": """
        SELECT p_partkey AS product_id, lower(p_type) || '.' || split_part(p_name, ' ', -1) AS category_code,
               lower(p_brand) AS brand
        FROM part""",
    "ev_all": """
        SELECT e.event_id, e.ts AS event_time,
               CASE WHEN e.event_type = 'click' THEN 'cart' ELSE e.event_type END AS event_type,
               CAST(regexp_extract(e.props, '[0-9]+') AS BIGINT) AS product_id,
               p.category_code, p.brand, e.value AS price, e.user_id,
               e.user_id || '-' || strftime(e.ts, '%Y-%m-%d') AS user_session
        FROM events e LEFT JOIN products p
          ON p.product_id = CAST(regexp_extract(e.props, '[0-9]+') AS BIGINT)""",
    "ev": "SELECT * FROM ev_all WHERE event_type IN ('view', 'cart', 'purchase')",
    "buys": """
        SELECT o_orderdate AS event_time, 'purchase' AS event_type, l_partkey AS product_id, category_code, brand,
               l_extendedprice AS price, o_custkey AS user_id, CAST(o_orderkey AS VARCHAR) AS user_session
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN products ON product_id = l_partkey""",
    "dirty_once": """
        SELECT event_id,
               CASE WHEN event_id % 101 = 0 THEN 'not-a-time'
                    ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') || ' UTC' END AS event_time,
               CASE WHEN event_id % 11 = 0 THEN ' ' || upper(event_type) || ' ' ELSE event_type END AS event_type,
               product_id,
               CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN split_part(category_code, '.', 1)
                    ELSE category_code END AS category_code,
               CASE WHEN event_id % 13 = 0 THEN ' ' ELSE brand END AS brand,
               CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 59 = 0 THEN '-' || CAST(price AS VARCHAR)
                    WHEN event_id % 61 = 0 THEN 'abc' ELSE CAST(price AS VARCHAR) END AS price,
               CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS user_id,
               CASE WHEN event_id % 89 = 0 THEN NULL ELSE user_session END AS user_session
        FROM ev_all""",
    "dirty": """
        SELECT * FROM dirty_once UNION ALL SELECT * FROM dirty_once WHERE event_id % 50 = 0""",
    "bronze": """
        SELECT TRY_CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) AS event_time, lower(trim(event_type)) AS event_type,
               product_id, category_code, nullif(trim(lower(brand)), '') AS brand,
               CASE WHEN TRY_CAST(price AS DOUBLE) >= 0 THEN TRY_CAST(price AS DOUBLE) ELSE 0.0 END AS price,
               user_id, user_session
        FROM dirty
        WHERE lower(trim(event_type)) IN ('view', 'cart', 'purchase') AND user_id IS NOT NULL
          AND TRY_CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) IS NOT NULL""",
}

MONEY = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"


def money(expression: str = "price", where: str = "") -> str:
    text = MONEY.format(expression)
    if where:
        text = f"CAST(SUM(CAST({expression} AS DECIMAL(18,2))) FILTER (WHERE {where}) AS DOUBLE)"
    return text


def half_up(expression: str, digits: int) -> str:
    """Rounding of the printed value, halves away from zero."""
    return f"CAST(CAST(CAST(({expression}) AS VARCHAR) AS DECIMAL(38,{digits})) AS DOUBLE)"


def n(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


def with_shared(*names: str, extra: dict[str, str] | None = None, select: str, stored: bool = False) -> str:
    """WITH clause of the named shared tables and what they need, then `extra`, then the select; `stored` tables are made once."""
    needs = {
        "ev_all": ["products"],
        "ev": ["products", "ev_all"],
        "buys": ["products"],
        "dirty": ["products", "ev_all", "dirty_once"],
        "bronze": ["products", "ev_all", "dirty_once", "dirty"],
    }
    wanted = {d for name in names for d in [*needs.get(name, []), name]}
    ctes = {name: sql for name, sql in SHARED.items() if name in wanted}
    ctes.update(extra or {})
    body = ",\n".join(f"{name} AS {'MATERIALIZED ' * stored}({sql})" for name, sql in ctes.items())
    return f"WITH {body}\n{select}"


ROOT = "split_part(category_code, '.', 1)"
RECENCY = "CAST(floor((epoch_us(TIMESTAMP '{ref}') - epoch_us(MAX(event_time))) / 86400000000.0) AS INTEGER)"

# Bronze, silver, quality ----------------------------------------------------------------


def bronze_statements() -> dict[str, str]:
    columns = """epoch_us(event_time) AS event_us, event_type, product_id, category_code, brand, price, user_id,
                 user_session, CAST(event_time AS DATE) AS event_date"""
    deduped = {
        "deduped": """
            SELECT * FROM (SELECT *, row_number() OVER (
                PARTITION BY user_id, user_session, event_time, event_type, product_id
                ORDER BY category_code NULLS FIRST, brand NULLS FIRST, price) AS copy FROM bronze) WHERE copy = 1"""
    }
    price = "TRY_CAST(price AS DOUBLE)"
    known = "lower(trim(event_type)) IN ('view', 'cart', 'purchase')"
    good_time = "TRY_CAST(replace(event_time, ' UTC', '') AS TIMESTAMP) IS NOT NULL"
    checks = [
        ("row_count_positive", "COUNT(*)", "> 0"),
        ("user_id_not_null", n("user_id IS NULL"), "= 0"),
        ("event_type_in_set", n(f"NOT ({known})"), "= 0"),
        ("price_not_negative", n(f"{price} < 0"), "= 0"),
    ]
    rules = " UNION ALL ".join(
        f"SELECT '{c}' AS \"check\", {o} AS observed, CASE WHEN {o} {test} THEN 'passed' ELSE 'failed' END AS status FROM dirty"
        for c, o, test in checks
    )
    silver_columns = """md5(concat_ws('|', CAST(user_id AS VARCHAR), user_session, CAST(epoch_us(event_time) AS VARCHAR),
                        event_type, CAST(product_id AS VARCHAR)))"""
    small = "user_session IN (SELECT user_session FROM ev GROUP BY user_session HAVING COUNT(*) <= 5)"
    metrics = with_shared(
        "dirty",
        select=f"""
            SELECT COUNT(*) AS total_rows, {n('user_id IS NULL')} AS null_user_id,
                   {n(f'{price} IS NULL')} AS null_price, {n(f'{price} < 0')} AS negative_price,
                   {n(f'NOT ({known})')} AS invalid_event_type,
                   COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT user_id, event_time, user_session FROM dirty))
                     AS duplicate_session_events,
                   COUNT(*) - (SELECT COUNT(*) FROM (
                     SELECT DISTINCT user_id, event_time, user_session, event_type, product_id FROM dirty))
                     AS duplicate_events,
                   {n(f'{known} AND user_id IS NOT NULL AND {good_time}')} AS valid_rows,
                   {half_up(f"100.0 * {n('user_id IS NULL')} / greatest(COUNT(*), 1)", 2)} AS null_user_pct
            FROM dirty""",
    )
    return {
        "ingest_report": metrics,
        "ingestion_columns": with_shared(
            "bronze",
            extra=deduped,
            select="""SELECT epoch_us(event_time) AS event_us, event_type, product_id, user_id, user_session, DATE '2024-01-31' AS run_date,
                      CASE WHEN event_time < TIMESTAMP '2024-01-20' THEN 'early' ELSE 'late' END AS landing, true AS batch_named FROM deduped""",
        ),
        "source_presence": """SELECT source, source <> 'returns' AS present
            FROM (VALUES ('events'), ('orders'), ('lineitem'), ('part'), ('customer'), ('returns')) s(source)""",
        "sorted_revenue": with_shared(
            "buys",
            select="""SELECT row_number() OVER (ORDER BY revenue_cents DESC, product_id) AS position, * FROM (
                      SELECT product_id, CAST(SUM(CAST(price AS DECIMAL(18,2))) * 100 AS BIGINT) AS revenue_cents FROM buys GROUP BY 1)""",
        ),
        "bronze_clean": with_shared("bronze", select=f"SELECT {columns} FROM bronze"),
        "event_dedup": with_shared("bronze", extra=deduped, select=f"SELECT {columns} FROM deduped"),
        "bronze_partition_counts": with_shared(
            "bronze",
            extra=deduped,
            select="""SELECT strftime(event_time, '%Y-%m') AS event_month, CAST(event_time AS DATE) AS event_date,
                      COUNT(*) AS events FROM deduped GROUP BY ALL""",
        ),
        "csv_roundtrip": with_shared(
            "dirty",
            select="""SELECT event_time, event_type, product_id, CAST(NULL AS BIGINT) AS category_id, category_code, brand,
                      TRY_CAST(price AS DOUBLE) AS price, user_id, user_session FROM dirty""",
        ),
        "category_split": with_shared(
            "dirty",
            select=f"""SELECT category_code, nullif({ROOT}, '') AS category_root,
                       nullif(split_part(category_code, '.', 2), '') AS category_sub FROM dirty""",
        ),
        "time_parts": """
            SELECT event_id, CAST(ts AS DATE) AS event_date, strftime(ts, '%Y-%m') AS event_month,
                   CAST(hour(ts) AS INTEGER) AS event_hour, dayname(ts) AS event_weekday FROM events""",
        "event_surrogate_key": with_shared(
            "ev", select=f"SELECT event_id AS source_id, {silver_columns} AS event_key FROM ev"
        ),
        "bot_session_filter": with_shared(
            "ev", select=f"SELECT event_id, user_session, event_type, price FROM ev WHERE {small}"
        ),
        "silver_incremental_merge": with_shared(
            "ev",
            select=f"""SELECT {silver_columns} AS event_id, CAST(event_time AS DATE) AS event_date, event_type,
                       user_session, price, brand FROM ev WHERE {small}""",
        ),
        "month_union": with_shared(
            "buys",
            select="""SELECT CAST(year(event_time) AS VARCHAR) AS period, COUNT(*) AS events,
                      COUNT(DISTINCT user_id) AS users FROM buys GROUP BY 1""",
        ),
        "dq_metrics": metrics,
        "dq_rule_report": with_shared("dirty", select=rules),
    }


# Features, RFM, cohorts -----------------------------------------------------------------


def rfm_base_sql(source: str, ref: str) -> str:
    return f"""
        SELECT user_id, {RECENCY.format(ref=ref)} AS recency, COUNT(*) AS frequency, {money()} AS monetary,
               {money()} / COUNT(*) AS avg_price, COUNT(DISTINCT {ROOT}) AS unique_categories,
               COUNT(DISTINCT brand) AS unique_brands, COUNT(DISTINCT product_id) AS unique_products,
               CAST(MIN(event_time) AS DATE) AS first_purchase_date, CAST(MAX(event_time) AS DATE) AS last_purchase_date
        FROM {source} WHERE event_type = 'purchase' GROUP BY user_id HAVING SUM(price) > 0"""


def _percent_score(column: str) -> str:
    position = f"2 * rank() OVER (ORDER BY {column}) + COUNT(*) OVER (PARTITION BY {column}) - 1"
    return f"CAST(greatest(1, least(5, (5 * ({position}) + 2 * COUNT(*) OVER () - 1) // (2 * COUNT(*) OVER ()))) AS INTEGER)"


SEGMENT = """CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'Champions'
                  WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal'
                  WHEN r_score >= 3 AND f_score <= 2 THEN 'Potential Loyalist'
                  WHEN r_score = 2 AND f_score >= 3 THEN 'At Risk'
                  WHEN r_score = 2 AND f_score = 2 THEN 'Needs Attention'
                  WHEN r_score = 1 AND f_score >= 3 THEN 'Can''t Lose'
                  WHEN r_score = 1 AND f_score = 2 THEN 'Hibernating'
                  ELSE 'Lost' END"""


def rfm_ctes(source: str, ref: str) -> dict[str, str]:
    return {
        "rfm_base": rfm_base_sql(source, ref),
        "scored": f"""
            SELECT *, 6 - {_percent_score('recency')} AS r_score, {_percent_score('frequency')} AS f_score,
                   {_percent_score('monetary')} AS m_score FROM rfm_base""",
        "rfm": f"SELECT *, r_score + f_score + m_score AS rfm_score, {SEGMENT} AS segment FROM scored",
    }


def feature_statements() -> dict[str, str]:
    order_rfm = rfm_ctes("buys", "2001-08-02")
    base_only = {"rfm_base": order_rfm["rfm_base"]}
    short = "user_id, recency, frequency, monetary, r_score, f_score, m_score, r_score + f_score + m_score AS rfm_score"

    def edges(column: str) -> str:
        return f"(SELECT quantile_cont(CAST({column} AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) FROM rfm_base)"

    def binned(column: str) -> str:
        return f"1 + len(list_filter({edges(column)}, lambda edge: {column} > edge))"

    views, carts = n("event_type = 'view'"), n("event_type = 'cart'")
    bought = n("event_type = 'purchase'")
    pur = "event_type = 'purchase'"
    counts = {
        "bought": f"""
            SELECT user_id, COUNT(*) AS total_purchases, {money()} AS total_spend, COUNT(DISTINCT product_id) AS unique_products,
                   COUNT(DISTINCT {ROOT}) AS unique_categories, COUNT(DISTINCT brand) AS unique_brands,
                   epoch_us(MIN(event_time)) AS first_purchase_us, epoch_us(MAX(event_time)) AS last_purchase_us,
                   {RECENCY.format(ref='2024-01-31')} AS recency_days
            FROM ev WHERE {pur} GROUP BY user_id""",
        "browsed": f"SELECT user_id, {views} AS total_views, {carts} AS total_carts FROM ev GROUP BY user_id",
    }
    return {
        "rfm_base": with_shared("buys", select=rfm_base_sql("buys", "2001-08-02")),
        "customer_rfm": with_shared("buys", extra=order_rfm, select="SELECT * FROM rfm"),
        "rfm_percent_rank": with_shared("buys", extra=order_rfm, select=f"SELECT {short} FROM rfm"),
        "rfm_qcut": with_shared(
            "buys",
            extra={
                **base_only,
                "binned": f"""SELECT *, 6 - ({binned('recency')}) AS r_score, {binned('frequency')} AS f_score,
                              {binned('monetary')} AS m_score FROM rfm_base""",
            },
            select=f"SELECT {short} FROM binned",
        ),
        "rfm_ntile": with_shared(
            "buys",
            extra={
                **base_only,
                "tiled": """SELECT *, ntile(5) OVER (ORDER BY recency DESC, user_id) AS r_score,
                            ntile(5) OVER (ORDER BY frequency, user_id) AS f_score,
                            ntile(5) OVER (ORDER BY monetary, user_id) AS m_score FROM rfm_base""",
            },
            select=f"SELECT {short} FROM tiled",
        ),
        "segment_counts": with_shared(
            "buys", extra=order_rfm, select="SELECT segment, COUNT(*) AS customers FROM rfm GROUP BY segment"
        ),
        "segment_actions": with_shared(
            "buys",
            extra=order_rfm,
            select="""
            SELECT r.segment, COUNT(*) AS customers, any_value(a.risk) AS churn_risk, any_value(a.priority) AS upsell_priority
            FROM rfm r JOIN (VALUES ('Champions', 'Low', 'High'), ('Loyal', 'Low', 'High'),
              ('Potential Loyalist', 'Low', 'Medium'), ('At Risk', 'High', 'Medium'), ('Needs Attention', 'Medium', 'Low'),
              ('Can''t Lose', 'High', 'Low'), ('Hibernating', 'High', 'Very Low'), ('Lost', 'Very High', 'Very Low'))
              AS a(segment, risk, priority) ON a.segment = r.segment
            GROUP BY r.segment""",
        ),
        "rfm_sample": with_shared(
            "buys",
            extra=order_rfm,
            select="""SELECT user_id, recency, frequency, monetary, rfm_score, segment FROM rfm
                      ORDER BY md5(user_id || '|42'), user_id LIMIT 5000""",
        ),
        "rfm_panel_sample": with_shared(
            "buys",
            extra=order_rfm,
            select="""SELECT user_id, recency, frequency, monetary, rfm_score, segment FROM rfm
                      ORDER BY md5(user_id || '|7'), user_id LIMIT 3000""",
        ),
        "feature_contract": with_shared(
            "buys",
            extra=order_rfm,
            select="""
            SELECT 'row_count' AS "check", COUNT(*) AS observed,
                   CASE WHEN COUNT(*) > 100 THEN 'passed' ELSE 'failed' END AS status FROM rfm
            UNION ALL
            SELECT 'segment_present', COUNT(segment), CASE WHEN COUNT(segment) = COUNT(*) THEN 'passed' ELSE 'failed' END FROM rfm""",
        ),
        "user_features": with_shared(
            "ev",
            extra=counts,
            select="""
            SELECT user_id, total_purchases, total_spend, total_spend / total_purchases AS avg_purchase_price,
                   unique_products, unique_categories, unique_brands, first_purchase_us, last_purchase_us,
                   total_views, total_carts, recency_days,
                   CAST(total_carts AS DOUBLE) / total_purchases AS cart_to_pur_ratio,
                   CAST(total_views AS DOUBLE) / total_purchases AS view_to_pur_ratio
            FROM bought JOIN browsed USING (user_id)""",
        ),
        "product_features": with_shared(
            "ev",
            extra={
                "browsed": f"SELECT product_id, {views} AS total_views, {carts} AS total_carts FROM ev GROUP BY product_id",
                "sold": f"""SELECT product_id, category_code, brand, COUNT(*) AS total_purchases, {money()} AS total_revenue
                            FROM ev WHERE {pur} GROUP BY ALL""",
            },
            select="""
            SELECT product_id, category_code, brand, total_purchases, total_revenue,
                   total_revenue / total_purchases AS avg_price, total_views, total_carts,
                   CASE WHEN total_views = 0 THEN 0.0 ELSE CAST(total_purchases AS DOUBLE) / total_views END AS conversion_rate
            FROM sold JOIN browsed USING (product_id)""",
        ),
        "session_features": with_shared(
            "ev",
            select=f"""
            SELECT user_session, arg_min(user_id, event_time) AS user_id, COUNT(*) AS session_events,
                   {bought} AS session_purchases, {money()} AS session_value,
                   coalesce({money(where=pur)}, 0.0) AS session_revenue,
                   epoch_us(MIN(event_time)) AS session_start_us, epoch_us(MAX(event_time)) AS session_end_us,
                   (epoch_us(MAX(event_time)) - epoch_us(MIN(event_time))) / 60000000.0 AS duration_minutes,
                   CAST({bought} > 0 AS INTEGER) AS converted
            FROM ev GROUP BY user_session""",
        ),
        "category_stats": with_shared(
            "ev",
            select=f"""
            SELECT category_code AS category, {views} AS total_views, {carts} AS total_carts, {bought} AS total_purchases,
                   coalesce({money(where=pur)}, 0.0) AS total_revenue,
                   {money(where=pur)} / nullif({bought}, 0) AS avg_price
            FROM ev GROUP BY category_code""",
        ),
        "distinct_counts": with_shared(
            "ev",
            select=" UNION ALL ".join(
                f"SELECT '{c}' AS entity, COUNT(DISTINCT {c}) AS distinct_values FROM ev"
                for c in ("user_id", "product_id", "category_code", "brand", "user_session")
            ),
        ),
        "user_category_bought": with_shared(
            "ev", select=f"SELECT DISTINCT user_id, category_code AS category FROM ev WHERE {pur}"
        ),
    }


CHURN = {
    "observed": "SELECT * FROM ev WHERE event_time >= TIMESTAMP '2024-01-01' AND event_time < TIMESTAMP '2024-01-28'",
    "later": """SELECT DISTINCT user_id FROM ev WHERE event_type = 'purchase'
                AND event_time >= TIMESTAMP '2024-01-28' AND event_time < TIMESTAMP '2024-01-31'""",
    "feat": f"""
        SELECT b.*, coalesce(a.n_views, 0) AS n_views, coalesce(a.n_carts, 0) AS n_carts,
               CAST(coalesce(a.n_carts, 0) AS DOUBLE) / b.frequency AS cart_to_pur_ratio,
               CAST(b.user_id NOT IN (SELECT user_id FROM later) AS INTEGER) AS churned
        FROM (SELECT user_id, COUNT(*) AS frequency, {money()} AS monetary, {money()} / COUNT(*) AS avg_price,
                     {RECENCY.format(ref='2024-01-28')} AS recency, COUNT(DISTINCT {ROOT}) AS unique_cats,
                     COUNT(DISTINCT brand) AS unique_brands, COUNT(DISTINCT product_id) AS unique_prods
              FROM observed WHERE event_type = 'purchase' GROUP BY user_id) b
        LEFT JOIN (SELECT user_id, {n("event_type = 'view'")} AS n_views, {n("event_type = 'cart'")} AS n_carts
                   FROM observed GROUP BY user_id) a USING (user_id)""",
}
TREE_MODELS = "('Random Forest'), ('Gradient Boosting')"
RULE = {
    **CHURN,
    "rule": """
        SELECT user_id, churned, score AS churn_score,
               CASE WHEN score <= 0.35 THEN 'Low' WHEN score <= 0.6 THEN 'Medium' ELSE 'High' END AS churn_risk
        FROM (SELECT user_id, churned, CAST(recency AS DOUBLE) / (SELECT greatest(MAX(recency), 1) FROM feat) AS score
              FROM feat)""",
}


def churn_statements() -> dict[str, str]:
    y2000 = "SELECT DISTINCT user_id FROM buys WHERE year(event_time) = 2000"
    y2001 = "SELECT DISTINCT user_id FROM buys WHERE year(event_time) = 2001"
    split_hash = "md5(churned || '-' || user_id || '|42')"
    features = ["frequency", "monetary", "avg_price", "recency", "unique_cats", "unique_brands", "unique_prods",
                "n_views", "n_carts", "cart_to_pur_ratio"]
    scaled = " UNION ALL ".join(
        f"""SELECT user_id, '{c}' AS feature, {half_up(f'''CASE WHEN stddev_samp({c}) OVER () > 0
            THEN ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () ELSE 0.0 END''', 6)} AS value FROM feat"""
        for c in features
    )
    by_score = {
        **RULE,
        "steps": """SELECT churn_score, SUM(churned) AS pos, SUM(1 - churned) AS neg FROM rule GROUP BY churn_score""",
        "curve": """SELECT *, SUM(pos) OVER (ORDER BY churn_score DESC) AS tp, SUM(neg) OVER (ORDER BY churn_score DESC) AS fp,
                    SUM(pos) OVER () AS p, SUM(neg) OVER () AS n FROM steps""",
    }
    tp, fp = n("churn_score > 0.5 AND churned = 1"), n("churn_score > 0.5 AND churned = 0")
    fn, tn = n("churn_score <= 0.5 AND churned = 1"), n("churn_score <= 0.5 AND churned = 0")
    return {
        "churn_features": with_shared("ev", extra=CHURN, select="SELECT * FROM feat"),
        "churn_features_gold": with_shared(
            "ev",
            extra={**CHURN, **rfm_ctes("observed", "2024-01-28")},
            select="SELECT feat.*, r_score, f_score, m_score, rfm_score, segment FROM feat LEFT JOIN rfm USING (user_id)",
        ),
        "gold_tables": with_shared(
            "ev",
            extra=CHURN,
            select=f"""
            SELECT 'customer_rfm' AS "table", COUNT(*) AS rows, COUNT(*) AS stamped FROM (
                SELECT user_id FROM ev WHERE event_type = 'purchase' GROUP BY user_id HAVING SUM(price) > 0)
            UNION ALL SELECT 'upsell_features', COUNT(*), COUNT(*) FROM (
                SELECT {ROOT} AS c FROM ev WHERE {ROOT} <> '' GROUP BY 1 HAVING {n("event_type = 'view'")} >= 10)
            UNION ALL SELECT 'user_features', COUNT(*), COUNT(*) FROM (SELECT DISTINCT user_id FROM ev WHERE event_type = 'purchase')
            UNION ALL SELECT 'product_features', COUNT(*), COUNT(*) FROM (SELECT DISTINCT product_id FROM ev WHERE event_type = 'purchase')
            UNION ALL SELECT 'session_features', COUNT(*), COUNT(*) FROM (SELECT DISTINCT user_session FROM ev)
            UNION ALL SELECT 'churn_features', COUNT(*), COUNT(*) FROM feat""",
        ),
        "repaired_features": with_shared(
            "ev",
            extra=CHURN,
            select="""SELECT user_id, frequency, monetary, avg_price, recency, unique_cats, 0.0::DOUBLE AS unique_brands, unique_prods,
                      n_views, 0.0::DOUBLE AS n_carts, cart_to_pur_ratio FROM feat""",
        ),
        "churn_labels": with_shared("ev", extra=CHURN, select="SELECT user_id, churned FROM feat"),
        "churned_buyers": with_shared("buys", select=f"{y2000} EXCEPT {y2001}"),
        "retained_buyers": with_shared("buys", select=f"{y2000} INTERSECT {y2001}"),
        "new_buyers": with_shared("buys", select=f"{y2001} EXCEPT {y2000}"),
        "cohort_retention": with_shared(
            "buys",
            extra={"a": y2000, "b": y2001},
            select=f"""
            SELECT *, {half_up('100.0 * churned / greatest(period_buyers, 1)', 6)} AS churn_rate FROM (
              SELECT (SELECT COUNT(*) FROM a) AS period_buyers, (SELECT COUNT(*) FROM b) AS next_period_buyers,
                     (SELECT COUNT(*) FROM a SEMI JOIN b USING (user_id)) AS retained,
                     (SELECT COUNT(*) FROM a ANTI JOIN b USING (user_id)) AS churned,
                     (SELECT COUNT(*) FROM b ANTI JOIN a USING (user_id)) AS new_buyers)""",
        ),
        "class_weights": with_shared(
            "ev",
            extra=CHURN,
            select="""SELECT churned, COUNT(*) AS n, (SELECT COUNT(*) FROM feat) / (2.0::DOUBLE * COUNT(*)) AS weight
                      FROM feat GROUP BY churned""",
        ),
        "stratified_split": with_shared(
            "ev",
            extra=CHURN,
            select=f"""SELECT user_id, churned,
                       CAST('0x' || substr({split_hash}, 1, 8) AS BIGINT) % 100 < 20 AS is_test FROM feat""",
        ),
        "feature_standardised": with_shared("ev", extra=CHURN, select=scaled),
        "churn_lr_optimum": with_shared(
            "ev",
            extra={**CHURN, "training": f"SELECT * FROM feat WHERE CAST('0x' || substr({split_hash}, 1, 8) AS BIGINT) % 100 >= 20"},
            select=" UNION ALL ".join(
                f"""SELECT '{c}' AS coordinate, 0.0::DOUBLE AS gradient, {half_up(f'avg({c})', 6)} AS mean,
                    {half_up(f'stddev_samp({c})', 6)} AS std FROM training"""
                for c in features
            )
            + " UNION ALL SELECT 'intercept', 0.0, NULL, NULL",
        ),
        # What must hold of any fitted models: no difference, no failed check.
        "tree_scores": with_shared(
            "ev", extra=CHURN, select=f"SELECT model, user_id, 0.0::DOUBLE AS difference FROM feat, (VALUES {TREE_MODELS}) m(model)"
        ),
        "tree_importances": " UNION ALL ".join(f"SELECT model, '{c}' AS feature, 0.0::DOUBLE AS difference FROM (VALUES {TREE_MODELS}) m(model)" for c in features),
        "model_checks": f"""SELECT model, "check", true AS ok FROM (VALUES ('Logistic Regression'), {TREE_MODELS}) m(model),
            (VALUES ('auc'), ('curve'), ('every_user_once'), ('histogram')) c("check")""",
        "churn_risk_tiers": with_shared("ev", extra=RULE, select="SELECT user_id, churn_score, churn_risk FROM rule"),
        "top_churn": with_shared(
            "ev",
            extra=RULE,
            select="SELECT user_id, churn_score, churn_risk FROM rule ORDER BY churn_score DESC, user_id LIMIT 100",
        ),
        "score_histogram": with_shared("ev", extra=RULE, select=histogram_sql()),
        "roc_curve": with_shared(
            "ev",
            extra=by_score,
            select="""SELECT churn_score AS threshold, CAST(fp AS DOUBLE) / n AS fpr, CAST(tp AS DOUBLE) / p AS tpr FROM curve""",
        ),
        "binary_metrics": with_shared(
            "ev",
            extra={
                **by_score,
                "auc": """
                    SELECT (SELECT SUM(CASE WHEN a.churn_score > b.churn_score THEN 1.0 WHEN a.churn_score = b.churn_score
                            THEN 0.5 ELSE 0 END) / COUNT(*) FROM rule a, rule b WHERE a.churned = 1 AND b.churned = 0) AS auc_roc,
                           (SELECT SUM(CAST(pos AS DOUBLE) * tp / (tp + fp)) / MAX(p) FROM curve) AS auc_pr""",
                "cells": f"SELECT {tp} AS tp, {fp} AS fp, {fn} AS fn, {tn} AS tn FROM rule",
            },
            select=f"""
            SELECT {half_up('CAST(auc_roc AS DOUBLE)', 6)} AS auc_roc, {half_up('auc_pr', 6)} AS auc_pr,
                   {half_up('coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0)', 6)} AS f1,
                   {half_up('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0)', 6)} AS "precision",
                   {half_up('coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0)', 6)} AS recall,
                   {half_up('CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn)', 6)} AS accuracy
            FROM auc, cells""",
        ),
        "hash_sample": with_shared(
            "ev",
            select="""SELECT event_id, user_id, event_type FROM ev
                      WHERE CAST('0x' || substr(md5(event_id || '|42'), 1, 8) AS BIGINT) % 100 < 10""",
        ),
    }


def histogram_sql() -> str:
    return """
        SELECT b.bin AS bin, b.bin / 20.0::DOUBLE AS bin_start, COUNT(r.user_id) AS count
        FROM (SELECT unnest(range(20)) AS bin) b
        LEFT JOIN rule r ON least(CAST(floor(r.churn_score * 20) AS BIGINT), 19) = b.bin
        GROUP BY b.bin"""


# Upsell ---------------------------------------------------------------------------------

UPSELL = {
    "cats": f"""
        SELECT category_code AS category, {n("event_type = 'view'")} AS views, {n("event_type = 'purchase'")} AS purchases
        FROM ev GROUP BY category_code""",
    "gaps": """
        SELECT *, CAST(greatest(views - purchases, 0) AS DOUBLE) AS gap_score, CAST(purchases AS DOUBLE) / views AS conversion_rate
        FROM cats WHERE views >= 10""",
    "opp": """
        SELECT *, CASE WHEN (SELECT MAX(gap_score) > MIN(gap_score) FROM gaps)
                  THEN (gap_score - (SELECT MIN(gap_score) FROM gaps))
                       / (SELECT MAX(gap_score) - MIN(gap_score) FROM gaps) ELSE 0.0 END AS opportunity_score
        FROM gaps""",
    "top20": """
        SELECT *, row_number() OVER (ORDER BY opportunity_score DESC, category) AS opportunity_rank FROM opp
        QUALIFY row_number() OVER (ORDER BY opportunity_score DESC, category) <= 20""",
    "owned": "SELECT DISTINCT user_id, category_code AS category FROM ev WHERE event_type = 'purchase'",
    "top10": "SELECT category FROM cats ORDER BY purchases DESC, category LIMIT 10",
    "both_bought": """
        SELECT a.category AS cat_x, b.category AS cat_y, COUNT(*) AS buyers
        FROM owned a JOIN owned b USING (user_id)
        WHERE a.category IN (FROM top10) AND b.category IN (FROM top10) GROUP BY ALL""",
    "aff_counts": """
        SELECT x.category AS cat_x, y.category AS cat_y, coalesce(c.buyers, 0) AS buyers
        FROM top10 x CROSS JOIN top10 y LEFT JOIN both_bought c ON c.cat_x = x.category AND c.cat_y = y.category""",
    "aff": f"""
        SELECT cat_x, cat_y, buyers,
               {half_up('100.0::DOUBLE * buyers / SUM(buyers) OVER (PARTITION BY cat_x)', 2)} AS affinity_pct,
               CAST(buyers AS DOUBLE) / MAX(buyers) FILTER (WHERE cat_x = cat_y) OVER (PARTITION BY cat_x) AS conditional_prob
        FROM aff_counts""",
}


def upsell_ctes() -> dict[str, str]:
    return {
        **UPSELL,
        **rfm_ctes("ev", "2024-01-31"),
        "offers": """
            SELECT r.user_id, r.rfm_score, t.category, t.opportunity_score, t.opportunity_rank
            FROM rfm r CROSS JOIN top20 t ANTI JOIN owned o ON o.user_id = r.user_id AND o.category = t.category""",
        "boosts": """
            SELECT f.user_id, f.category, least(SUM(CAST(a.affinity_pct AS DECIMAL(18,2)))::DOUBLE / 100, 1.0) AS boost
            FROM offers f JOIN owned o USING (user_id) JOIN aff a ON a.cat_x = o.category AND a.cat_y = f.category
            GROUP BY ALL""",
        "weighed": """
            SELECT user_id, category, opportunity_rank, opportunity_score AS opp, coalesce(boost, 0.0) AS boost,
                   CAST(rfm_score AS DOUBLE) / 15 AS w
            FROM offers LEFT JOIN boosts USING (user_id, category)""",
        "scores": f"""
            SELECT user_id, category, opportunity_rank, {half_up('opp', 4)} AS opportunity, {half_up('boost', 4)} AS affinity,
                   {half_up('w', 4)} AS rfm_weight,
                   {half_up('0.5::DOUBLE * opp + 0.3::DOUBLE * boost + 0.2::DOUBLE * w', 4)} AS upsell_score
            FROM weighed""",
        "ranked": """
            SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY upsell_score DESC, opportunity_rank) AS rank,
                   category, opportunity, affinity, rfm_weight, upsell_score FROM scores""",
    }


def upsell_statements() -> dict[str, str]:
    ctes = upsell_ctes()
    views, carts, bought = n("event_type = 'view'"), n("event_type = 'cart'"), n("event_type = 'purchase'")
    revenue = money(where="event_type = 'purchase'")
    top5 = with_shared("ev", extra=ctes, select="SELECT * FROM ranked WHERE rank <= 5")
    pairs = {"owned": UPSELL["owned"]}
    return {
        "upsell_features": with_shared(
            "ev",
            select=f"""
            SELECT {ROOT} AS category, {views} AS total_views, {carts} AS total_carts, {bought} AS total_purchases,
                   {revenue} AS total_revenue, {revenue} / {bought} AS avg_price,
                   CAST({bought} AS DOUBLE) / {views} AS conversion_rate,
                   CAST(greatest({views} - {bought}, 0) AS DOUBLE) AS opportunity_score
            FROM ev GROUP BY 1 HAVING {views} >= 300""",
        ),
        "category_opportunity_scaled": with_shared("ev", extra=UPSELL, select="SELECT * FROM opp"),
        "upsell_panel": with_shared(
            "ev",
            extra=UPSELL,
            select="""SELECT category, CAST(greatest(views - purchases, 0) AS DOUBLE) AS score FROM cats
                      ORDER BY score DESC, category LIMIT 10""",
        ),
        "affinity_counts": with_shared("ev", extra=UPSELL, select="SELECT * FROM aff_counts"),
        "category_affinity": with_shared("ev", extra=UPSELL, select="SELECT * FROM aff"),
        "category_copurchase_pairs": with_shared(
            "ev",
            extra=pairs,
            select="""SELECT a.category AS cat_x, b.category AS cat_y, COUNT(*) AS buyers FROM owned a JOIN owned b
                      ON a.user_id = b.user_id AND a.category <> b.category GROUP BY ALL""",
        ),
        "category_copurchase_support": with_shared(
            "ev",
            extra=pairs,
            select="""SELECT a.user_id, b.category AS target_category, COUNT(*) AS shared_buyers FROM owned a JOIN owned b
                      ON a.user_id = b.user_id AND a.category <> b.category GROUP BY ALL""",
        ),
        "upsell_candidates": with_shared(
            "ev", extra=ctes, select="SELECT user_id, category, opportunity_rank FROM offers"
        ),
        "upsell_scores": with_shared("ev", extra=ctes, select="SELECT * FROM ranked"),
        "upsell_top_k": top5,
        "upsell_scores_published": top5,
        "score_overview": with_shared(
            "ev",
            extra={**RULE, **rfm_ctes("ev", "2024-01-31")},
            select=f"""
            SELECT 'total_users' AS metric, CAST(NULL AS VARCHAR) AS key, CAST(COUNT(*) AS DOUBLE) AS value FROM rfm
            UNION ALL SELECT 'churned_users', NULL, {n("churn_risk = 'High'")} FROM rule
            UNION ALL SELECT 'avg_churn_score', NULL, {half_up('avg(churn_score)', 6)} FROM rule
            UNION ALL SELECT 'segment', segment, COUNT(*) FROM rfm GROUP BY segment""",
        ),
        "upsell_lookup_batch": with_shared(
            "ev",
            extra=ctes,
            select="""
            SELECT c_custkey AS user_id, user_id IS NOT NULL AS found, rank, category, upsell_score, opportunity, affinity
            FROM customer LEFT JOIN (SELECT * FROM ranked WHERE rank <= 5) ON user_id = c_custkey""",
        ),
        "score_lookup_point": with_shared(
            "ev",
            extra=ctes,
            select="""
            SELECT asked, r.user_id IS NOT NULL AS found, segment, rfm_score, r_score, f_score, m_score, recency, frequency, monetary
            FROM (VALUES (1::BIGINT), (7), (12), (10000000)) q(asked) LEFT JOIN rfm r ON r.user_id = asked""",
        ),
        "score_lookup_batch": with_shared(
            "ev",
            extra={
                **RULE,
                **ctes,
                "best": "SELECT user_id, string_agg(category, ',' ORDER BY rank) AS names FROM ranked WHERE rank <= 5 GROUP BY user_id",
            },
            stored=True,
            select="""
            SELECT c.c_custkey AS user_id, s.user_id IS NOT NULL AS churn_found, s.churn_score, s.churn_risk,
                   r.user_id IS NOT NULL AS segment_found, r.segment, r.rfm_score, r.r_score, r.f_score, r.m_score,
                   r.recency, r.frequency, r.monetary,
                   b.user_id IS NOT NULL AS upsell_found, coalesce(b.names, '') AS recommendations
            FROM customer c LEFT JOIN rule s ON s.user_id = c.c_custkey LEFT JOIN rfm r ON r.user_id = c.c_custkey
            LEFT JOIN best b ON b.user_id = c.c_custkey""",
        ),
    }


# Panels ---------------------------------------------------------------------------------


def facts_cte(source: str, level: str = "root") -> dict[str, str]:
    category = ROOT if level == "root" else "category_code"
    return {
        "rows": f"""
            SELECT *, strftime(event_time, '%Y-%m') AS event_month, CAST(event_time AS DATE) AS event_date,
                   CAST(hour(event_time) AS INTEGER) AS event_hour, dayname(event_time) AS event_weekday,
                   coalesce({category}, 'unknown') AS category
            FROM {source}""",
        "f": "SELECT 'all' AS slice, * FROM rows UNION ALL SELECT event_month AS slice, * FROM rows",
        "p": "SELECT * FROM f WHERE event_type = 'purchase'",
    }


def _top(order: str, k: int, inner: str, columns: str, partition: str = "slice") -> str:
    return f"""
        SELECT {columns} FROM (
          SELECT *, row_number() OVER (PARTITION BY {partition} ORDER BY {order}) AS rank FROM ({inner})) WHERE rank <= {k}"""


def panel_selects() -> dict[str, str]:
    """Panel SQL over the tables f (all facts) and p (purchases)."""
    views, carts, bought = n("event_type = 'view'"), n("event_type = 'cart'"), n("event_type = 'purchase'")
    revenue = money(where="event_type = 'purchase'")
    sold = half_up(money(), 6)
    mean = half_up(f"{money()} / COUNT(*)", 6)
    cart_rate = half_up(f"100.0::DOUBLE * {carts} / greatest({views}, 1)", 6)
    conversion = half_up(f"100.0::DOUBLE * {bought} / greatest({views}, 1)", 6)
    days = "(VALUES " + ", ".join(
        f"({i}, '{d}')"
        for i, d in enumerate(["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"])
    ) + ") AS d(day_index, event_weekday)"
    slices = "(SELECT DISTINCT slice FROM f) s"
    hours = "(SELECT CAST(unnest(range(24)) AS INTEGER) AS event_hour) h"
    counted = f"SELECT slice, category, {views} AS views, {carts} AS carts, {bought} AS purchases, {revenue} AS cents FROM f GROUP BY ALL"
    return {
        "overview_kpis": f"""
            SELECT slice, {half_up(f'coalesce({revenue}, 0.0)', 6)} AS total_revenue, {bought} AS total_orders,
                   COUNT(DISTINCT user_id) AS total_customers,
                   {half_up(f'coalesce({revenue} / nullif({bought}, 0), 0.0)', 6)} AS avg_order_value,
                   {conversion} AS conversion_rate, {cart_rate} AS cart_rate
            FROM f GROUP BY slice""",
        "daily_events": f"SELECT slice, event_date, {views} AS views, {carts} AS carts, {bought} AS purchases FROM f GROUP BY ALL",
        "funnel": f"""
            SELECT slice, 1 AS position, 'Views' AS stage, {views} AS events, 100.0::DOUBLE AS percentage FROM f GROUP BY slice
            UNION ALL SELECT slice, 2, 'Cart Adds', {carts}, {cart_rate} FROM f GROUP BY slice
            UNION ALL SELECT slice, 3, 'Purchases', {bought}, {conversion} FROM f GROUP BY slice""",
        "event_split": "SELECT slice, event_type, COUNT(*) AS events FROM f GROUP BY ALL",
        "category_revenue": f"SELECT slice, category, {sold} AS revenue FROM p GROUP BY ALL",
        "category_revenue_top10": _top(
            "revenue DESC, category", 10, f"SELECT slice, category, {sold} AS revenue FROM p GROUP BY ALL",
            "slice, rank, category, revenue",
        ),
        "daily_revenue": f"SELECT slice, event_date, {sold} AS revenue FROM p GROUP BY ALL",
        "category_list": "SELECT DISTINCT category FROM p WHERE category <> 'unknown'",
        "run_metadata": """SELECT COUNT(*) AS total_events, COUNT(DISTINCT user_id) AS total_users,
                           MIN(event_date) AS first_date, MAX(event_date) AS last_date FROM rows""",
        "top_brands": _top(
            "revenue DESC, brand", 20, f"SELECT slice, brand, {sold} AS revenue FROM p GROUP BY ALL", "slice, rank, brand, revenue"
        ),
        "top_brands_by_category": _top(
            "revenue DESC, brand", 10, f"SELECT slice, category, brand, {sold} AS revenue FROM p GROUP BY ALL",
            "slice, category, rank, brand, revenue", "slice, category",
        ),
        "category_funnel": _top(
            "cents DESC, category", 8, f"SELECT * FROM ({counted}) WHERE purchases > 0",
            "slice, rank, category, views, carts, purchases",
        ),
        "category_avg_price": _top(
            "avg_price DESC, category", 8, f"SELECT slice, category, {mean} AS avg_price FROM p GROUP BY ALL",
            "slice, rank, category, avg_price",
        ),
        "category_conversion": _top(
            "rate DESC, category", 10,
            f"SELECT slice, category, {half_up('100.0::DOUBLE * purchases / views', 6)} AS rate FROM ({counted}) WHERE views > 50",
            "slice, rank, category, rate",
        ),
        "top_products": _top(
            "revenue DESC, product_id, category, brand", 20,
            f"""SELECT slice, product_id, category, brand, {sold} AS revenue, COUNT(*) AS orders, {mean} AS avg_price
                FROM p GROUP BY ALL""",
            "slice, rank, product_id, category, brand, revenue, orders, avg_price",
        ),
        "weekday_hour_heatmap": f"""
            SELECT s.slice, d.event_weekday, d.day_index, h.event_hour, COUNT(p.event_type) AS purchases
            FROM {slices} CROSS JOIN {days} CROSS JOIN {hours}
            LEFT JOIN p ON p.slice = s.slice AND p.event_weekday = d.event_weekday AND p.event_hour = h.event_hour GROUP BY ALL""",
        "hourly_purchases": f"""
            SELECT s.slice, h.event_hour, COUNT(p.event_type) AS purchases FROM {slices} CROSS JOIN {hours}
            LEFT JOIN p ON p.slice = s.slice AND p.event_hour = h.event_hour GROUP BY ALL""",
        "weekday_purchases": f"""
            SELECT s.slice, d.day_index, d.event_weekday, COUNT(p.event_type) AS purchases FROM {slices} CROSS JOIN {days}
            LEFT JOIN p ON p.slice = s.slice AND p.event_weekday = d.event_weekday GROUP BY ALL""",
        "session_depth": """
            SELECT slice, least(size, 20) AS depth, COUNT(*) AS sessions FROM (
              SELECT slice, user_session, COUNT(*) AS size FROM f GROUP BY ALL) GROUP BY ALL""",
        "cumulative_revenue": f"""
            SELECT s.slice, h.event_hour, {half_up(f"coalesce((SELECT {money('q.price')} FROM p q WHERE q.slice = s.slice AND q.event_hour <= h.event_hour), 0.0)", 6)} AS cumulative_revenue
            FROM {slices} CROSS JOIN {hours}""",
        "daily_view_purchase_ratio": f"""
            SELECT slice, event_date, views, purchases,
                   {half_up('coalesce(100.0::DOUBLE * purchases / nullif(views, 0), 0.0)', 6)} AS ratio
            FROM (SELECT slice, event_date, {views} AS views, {bought} AS purchases FROM f GROUP BY ALL)
            WHERE views > 0 OR purchases > 0""",
    }


# Which events a registered panel runs on, and at which category level.
ON_PURCHASES = {
    "category_revenue_top10": "full",
    "daily_revenue": "root",
    "category_revenue": "root",
    "top_brands": "root",
    "top_brands_by_category": "full",
    "category_avg_price": "full",
    "top_products": "root",
    "category_list": "full",
}
FULL_LEVEL_EVENTS = {"category_funnel", "category_conversion"}


def panel_statements() -> dict[str, str]:
    selects = panel_selects()
    out = {}
    for name, select in selects.items():
        if name in ON_PURCHASES:
            out[name] = with_shared("buys", extra=facts_cte("buys", ON_PURCHASES[name]), select=select)
        else:
            level = "full" if name in FULL_LEVEL_EVENTS else "root"
            out[name] = with_shared("ev", extra=facts_cte("ev", level), select=select)

    cohort = churn_statements()["cohort_retention"]
    tier_rows = f"""
        SELECT 'category_conversion' AS panel, slice || '/' || category AS key, rate AS value,
               CASE WHEN rate > 2 THEN 'high' WHEN rate > 1 THEN 'medium' ELSE 'low' END AS tier
        FROM ({selects['category_conversion']})
        UNION ALL
        SELECT 'session_depth', slice || '/' || depth, depth,
               CASE WHEN depth >= 15 THEN 'deep' WHEN depth >= 5 THEN 'medium' ELSE 'shallow' END
        FROM ({selects['session_depth']})
        UNION ALL
        SELECT 'churn_rate', 'churn_rate', churn_rate,
               CASE WHEN churn_rate < 30 THEN 'low' WHEN churn_rate < 70 THEN 'medium' ELSE 'high' END FROM ({cohort})
        UNION ALL
        SELECT 'score_histogram', CAST(bin AS VARCHAR), bin_start,
               CASE WHEN bin_start < 0.35 THEN 'low' WHEN bin_start < 0.6 THEN 'medium' ELSE 'high' END FROM ({histogram_sql()})"""
    out["panel_tiers"] = with_shared("ev", extra={**RULE, **facts_cte("ev", "full")}, select=tier_rows)

    minimum = {"weekday_hour_heatmap": 168, "affinity_matrix": 64, "segments": 4}
    counted = {
        **selects,
        "affinity_matrix": "SELECT 1 FROM (FROM cats ORDER BY purchases DESC LIMIT 8) a, (FROM cats ORDER BY purchases DESC LIMIT 8) b",
        "segments": "SELECT DISTINCT segment FROM rfm",
        "rfm_sample": "SELECT 1 FROM rfm LIMIT 5000",
        "rfm_panel_sample": "SELECT 1 FROM rfm LIMIT 3000",
    }
    whole = {"category_list", "run_metadata", "affinity_matrix", "segments", "rfm_sample", "rfm_panel_sample"}
    out["panel_contract"] = with_shared(
        "ev",
        "buys",
        extra={**facts_cte("ev", "full"), "cats": UPSELL["cats"], **rfm_ctes("buys", "2001-08-02")},
        select=" UNION ALL ".join(
            f"SELECT '{name}' AS panel, 'all' AS slice, COUNT(*) AS rows, COUNT(*) >= {minimum.get(name, 1)} AS ok FROM ({select})"
            if name in whole
            else f"""SELECT '{name}' AS panel, wanted.slice, COUNT(q.slice) AS rows, COUNT(q.slice) >= {minimum.get(name, 1)} AS ok
                     FROM (SELECT DISTINCT slice FROM f) wanted LEFT JOIN ({select}) q ON q.slice = wanted.slice GROUP BY wanted.slice"""
            for name, select in counted.items()
        ),
    )
    models = (("roc_curves", 3), ("model_metrics", 3), ("feature_importance", 10), ("score_histogram", 20))
    out["run_contract"] = out["panel_contract"] + "".join(f" UNION ALL SELECT '{name}', 'all', {rows}, true" for name, rows in models)
    return out


# Streams: closed and open parts, as the batch has them ------------------------------------------


def stream_statements() -> dict[str, str]:
    views, carts, bought = n("event_type = 'view'"), n("event_type = 'cart'"), n("event_type = 'purchase'")
    cents = "CAST(coalesce(SUM(CAST(price AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase'), 0) * 100 AS BIGINT)"
    # Two arrivals; what comes a day or more behind the first one's latest event is late.
    arrivals = {
        "late": """
            SELECT * FROM ev_all WHERE event_time < TIMESTAMP '2024-01-20' AND event_id % 10 = 0 AND event_time < (
                SELECT MAX(event_time) FROM ev_all WHERE event_time < TIMESTAMP '2024-01-20' AND event_id % 10 <> 0) - INTERVAL 1 DAY""",
        "on_time": "SELECT * FROM ev_all ANTI JOIN late USING (event_id)",
    }

    def sessions(source: str) -> dict[str, str]:
        return {
            "marked": f"""
                SELECT *, CASE WHEN event_time - lag(event_time) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS starts
                FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY event_time)""",
            "numbered": "SELECT *, SUM(starts) OVER (PARTITION BY user_id ORDER BY event_time) AS session FROM marked",
        }

    return {
        "stream_late_rows": with_shared("ev_all", extra=arrivals, select="SELECT event_id, epoch_us(event_time) AS event_us, event_type, 1::BIGINT AS batch FROM late"),
        "stream_daily_resumed": with_shared(
            "ev_all",
            extra=arrivals,
            select=f"""
            SELECT CAST(event_time AS DATE) AS event_date, {views} AS views, {carts} AS carts, {bought} AS purchases,
                   {cents} AS revenue_cents
            FROM on_time GROUP BY 1""",
        ),
        "stream_sessions_resumed": with_shared(
            "ev_all",
            extra={**arrivals, **sessions("on_time")},
            select=f"""
            SELECT user_id, epoch_us(MIN(event_time)) AS session_start_us, epoch_us(MAX(event_time)) AS session_end_us,
                   COUNT(*) AS session_events, {bought} AS session_purchases, {cents} AS revenue_cents
            FROM numbered GROUP BY user_id, session""",
        ),
        "stream_bronze": with_shared(
            "ev",
            select="""SELECT DISTINCT epoch_us(event_time) AS event_us, event_type, product_id, category_code, brand, price,
                      user_id, user_session, CAST(event_time AS DATE) AS event_date FROM ev""",
        ),
        "stream_daily_events": with_shared(
            "ev_all",
            select=f"""
            SELECT CAST(event_time AS DATE) AS event_date, {views} AS views, {carts} AS carts, {bought} AS purchases,
                   {cents} AS revenue_cents
            FROM ev_all GROUP BY 1""",
        ),
        "stream_sessions": with_shared(
            "ev_all",
            extra={
                "marked": """
                    SELECT *, CASE WHEN event_time - lag(event_time) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS starts
                    FROM ev_all WINDOW w AS (PARTITION BY user_id ORDER BY event_time)""",
                "numbered": "SELECT *, SUM(starts) OVER (PARTITION BY user_id ORDER BY event_time) AS session FROM marked",
            },
            select=f"""
            SELECT user_id, epoch_us(MIN(event_time)) AS session_start_us, epoch_us(MAX(event_time)) AS session_end_us,
                   COUNT(*) AS session_events, {bought} AS session_purchases, {cents} AS revenue_cents
            FROM numbered GROUP BY user_id, session""",
        ),
    }


def oracle_sql() -> dict[str, str]:
    return {
        **bronze_statements(),
        **feature_statements(),
        **churn_statements(),
        **upsell_statements(),
        **panel_statements(),
        **stream_statements(),
    }
