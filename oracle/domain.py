"""The domain tables over the test tables, as named SQL sources."""

AS_OF = "DATE '2001-08-02'"

DOMAIN = {
    "pt": "SELECT p_partkey AS p, p_partkey // 2 + 1 AS pid, p_type, p_size, p_brand FROM part",
    "pnl_main": """
        SELECT p AS mid, pid, p_size * 10 AS maxdist, p_type AS pnlsubtype,
               CASE WHEN p % 5 = 0 THEN 'D' WHEN p % 17 = 0 THEN NULL ELSE 'S' END AS pnlmotion,
               CASE WHEN p % 11 = 0 THEN '24q4' ELSE '25q1' END AS navteqver
        FROM pt""",
    "pnl_geom": """
        SELECT p AS mid, CAST((p // 2000) * 50000 + (p * 7919) % 40000 AS DOUBLE) AS x,
               CAST((p * 104729) % 40000 AS DOUBLE) AS y
        FROM pt""",
    "panel_state": f"""
        SELECT p AS mid, pid, CAST({AS_OF} - CAST(p % 10 AS INTEGER) AS TIMESTAMP) + INTERVAL 12 HOUR AS stamp,
               CASE WHEN p % 7 <> 0 THEN 3 ELSE 1 + (p // 7) % 4 END AS status,
               CASE WHEN p % 13 = 0 THEN 1 ELSE 0 END AS timeattid, p_size + 2 AS ownid
        FROM pt""",
    "pnl_timeatts": f"""
        SELECT pid, CAST({AS_OF} - CAST(p % 4 AS INTEGER) AS TIMESTAMP) + INTERVAL 12 HOUR AS stamp,
               p % 2 AS timeattid
        FROM pt WHERE p_size BETWEEN 40 AND 42""",
    "pnl_facemid": """
        SELECT p AS mid, p * 2 + pos AS faceid, pid * 2 + pos AS facepid, 'F' || (p * 2 + pos) AS face_userid
        FROM pt CROSS JOIN (VALUES (1), (2)) AS v(pos)""",
    "pnl_faces": """
        SELECT DISTINCT pid * 2 + pos AS facepid, pid, pos FROM pt CROSS JOIN (VALUES (1), (2)) AS v(pos)""",
    "code_pnlsubtype": """
        SELECT DISTINCT p_type AS pnlsubtype,
               CASE p_type WHEN 'ECONOMY' THEN 'EA' WHEN 'STANDARD' THEN 'EA' WHEN 'SMALL' THEN 'EB' ELSE 'EC' END
                   AS pnlvaienv
        FROM pt""",
    "vai_vac_res": """
        SELECT o_orderkey AS vacid, (o_orderkey * 31) % n AS mid,
               (o_orderkey * 31) % n * 2 + 1 + (o_orderkey // 3) % 2 AS faceid,
               CASE WHEN o_orderstatus = 'P' AND o_orderkey % 6 = 0 THEN 'E1' END AS err_vac_res
        FROM orders, (SELECT count(*) AS n FROM part)""",
    "output_round": """
        SELECT vacid, periodid, transptype, max(vac) AS vac, max(rots) AS rots FROM (
            SELECT o_orderkey AS vacid, 1 AS periodid, 'ALL' AS transptype, CAST(o_orderkey % 51 AS DOUBLE) AS vac,
                   CASE WHEN o_orderkey % 97 = 0 THEN 0.0::DOUBLE ELSE floor(o_totalprice) END AS rots
            FROM orders WHERE month(o_orderdate) <> 7
            UNION ALL
            SELECT * FROM (
                SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 200 ELSE 2 END AS per,
                       CASE l_linenumber WHEN 2 THEN 'VEH' WHEN 3 THEN 'PUB' WHEN 4 THEN 'PED' WHEN 5 THEN 'BIC'
                            ELSE 'ALL' END AS kind,
                       l_quantity - 1, floor(l_extendedprice)
                FROM lineitem)
            WHERE NOT (per = 1 AND kind = 'ALL')
            UNION ALL
            SELECT l_orderkey, 10 + l_linenumber % 2, CASE l_linenumber WHEN 2 THEN 'VEH' WHEN 3 THEN 'PUB' WHEN 4 THEN 'PED'
                   WHEN 5 THEN 'BIC' ELSE 'ALL' END, l_quantity, floor(l_extendedprice)
            FROM lineitem)
        GROUP BY ALL""",
    "vai_seg": """
        SELECT l_partkey AS mid, l_suppkey AS navteqid, '25q1' AS navteqver,
               CASE WHEN l_linenumber % 2 = 0 THEN 'F' ELSE 'T' END AS orient,
               l_suppkey % (3 + l_partkey % 9) + (l_linenumber % 2) * 0.0000002::DOUBLE AS x1, l_suppkey % 2 AS y1,
               (l_suppkey + 1) % (3 + l_partkey % 9) + l_linenumber // 4 AS x2, l_suppkey % 2 AS y2
        FROM lineitem""",
    "topo_streets": """
        SELECT s_suppkey AS link_id, '25q1' AS navteqver, CAST(65 + s_suppkey % 8 AS VARCHAR) AS linetype
        FROM supplier""",
    "trip_routes": """
        SELECT event_id AS sid, upper(left(c_mktsegment, 3)) || c_custkey AS respondent_id, event_type AS routingmode,
               dayname(ts) AS week_day_name,
               CASE WHEN dayname(ts) IN ('Saturday', 'Sunday') THEN 'WE' ELSE 'WD' END AS week_day_type,
               value AS trip_freq,
               CAST((event_id // 10000) * 50000 + (event_id * 6151) % 24000 AS DOUBLE) AS x,
               CAST((event_id * 3079) % 40000 AS DOUBLE) AS y
        FROM events JOIN customer ON user_id = c_custkey""",
    "trip_routes_older": "SELECT * REPLACE (x + 150 AS x, y - 100 AS y) FROM trip_routes",
    "resp_weight_input": """
        SELECT upper(left(c_mktsegment, 3)) || c_custkey AS respondent_id,
               CAST(floor(c_acctbal) AS DECIMAL(13,3)) * 0.001 AS benchwgt_pp
        FROM customer WHERE c_acctbal > 0""",
    "freq_trips_vector": """
        SELECT kind AS weekdaytype, day AS weekdayname, lo AS freq_from, hi AS freq_to, prob
        FROM (VALUES ('WD', 'Monday'), ('WD', 'Tuesday'), ('WD', 'Wednesday'), ('WD', 'Thursday'), ('WD', 'Friday'),
                     ('WE', 'Saturday'), ('WE', 'Sunday')) AS d(kind, day)
        CROSS JOIN (VALUES (0, 50, 0.25), (50, 200, 0.50), (200, 1000, 1.00)) AS b(lo, hi, prob)""",
    "panel_inbox": "SELECT DISTINCT pid FROM pt WHERE p_brand = 'Brand#13' AND p_size <= 12",
    "no_calc": "SELECT pid, 'E0' AS err_vac_res FROM pt WHERE p_brand = 'Brand#21' AND p_size <= 20",
    "no_calc_inc": """
        SELECT pid, p AS mid, CASE WHEN p % 2 = 1 THEN 'E1' END AS err_vac_res, p % 5 < 3 AS in_queue,
               p % 5 = 0 AS calculated, p % 5 = 0 AND (p // 5) % 2 = 1 AS processed, p % 7 = 1 AS ignore
        FROM pt WHERE p_size BETWEEN 5 AND 8""",
    "vac_queue": f"""
        SELECT p AS mid, 'init_continous_release' AS usrn, CASE WHEN p % 2 = 0 THEN 50820 ELSE 50020 END AS temp_table,
               CAST({AS_OF} - CAST(p % 8 AS INTEGER) AS TIMESTAMP) AS stamp_in_queue, p % 5 <> 2 AS ended
        FROM pt WHERE p_size BETWEEN 5 AND 16""",
    "bad_navteq": """
        SELECT p AS mid, pid, '24q4' AS navteqver, CASE WHEN p % 3 = 0 THEN 1 ELSE 0 END AS processed
        FROM pt WHERE p_size IN (21, 22)""",
    "pnl_to_revise": """
        SELECT pid, p AS mid, CASE WHEN p % 2 = 0 THEN 1 END AS load_id FROM pt WHERE p_size = 33""",
    "all_panel": """
        SELECT m.mid, m.pid, x, y, m.maxdist + 200.0 AS radius, CAST(1 + m.mid % 40 AS DOUBLE) AS vac_all_1, m.maxdist,
               CASE WHEN x % 50000 < 24000 THEN 'ORIGINAL' ELSE 'SUBSTITUTE' END AS intersection_type,
               m.mid AS last_vacid, CAST(NULL AS VARCHAR) AS err_vac_res
        FROM pnl_main m JOIN pnl_geom USING (mid) JOIN panel_state s USING (mid)
        WHERE s.status = 3 AND s.timeattid = 0 AND m.pnlsubtype IN ('ECONOMY', 'SMALL')""",
    "release_publish": """
        SELECT CASE WHEN o.periodid = 1 THEN 100 WHEN o.periodid = 200 THEN 101 WHEN o.periodid IN (10, 11) THEN 105
                    WHEN o.transptype <> 'BIC' THEN 104 ELSE 99 END AS rvloadid, f.facepid, o.vacid, o.periodid,
               o.transptype, o.vac, o.rots, q.pid, v.mid, v.faceid
        FROM output_round o JOIN vai_vac_res v USING (vacid) JOIN pnl_facemid f ON f.faceid = v.faceid
        JOIN pt q ON q.p = v.mid
        WHERE q.p_type IN ('LARGE', 'PROMO', 'SMALL')""",
    "loads": "SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS load_id FROM orders",
}
