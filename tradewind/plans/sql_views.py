"""The derived trade tables in plain SQL, as common table expressions for the check queries."""

SQL_VIEWS = """
flow_base AS (
  SELECT lpad(cast(p_partkey % 24 + 1 AS varchar),2,'0') || lpad(cast(p_size AS varchar),2,'0') ||
         lpad(cast(p_partkey % 7 AS varchar),2,'0') || lpad(cast(p_partkey % 100 AS varchar),2,'0') AS comcode,
         lpad(cast(sn.n_nationkey AS varchar),2,'0') AS s_code, sn.n_regionkey AS s_reg,
         lpad(cast(cn.n_nationkey AS varchar),2,'0') AS c_code, cn.n_regionkey AS c_reg,
         c_custkey, l_orderkey, l_suppkey, l_linenumber, l_linestatus, l_shipdate,
         cast(round(l_extendedprice) AS bigint) AS value, cast(l_quantity - 1 AS bigint) AS quantity_1
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
       JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN nation cn ON c_nationkey = cn.n_nationkey),
import_rows AS (SELECT l_orderkey, l_linenumber, comcode, CASE WHEN l_linenumber = 6 THEN NULL ELSE s_code END AS coo_alpha,
    CASE WHEN l_linenumber = 7 THEN '' ELSE 'P' || lpad(cast(c_custkey % 40 AS varchar),2,'0') END AS port_alpha,
    strftime(l_shipdate,'%m/%Y') AS account_date, value, quantity_1
  FROM flow_base WHERE l_linestatus = 'O' AND s_reg <> 3),
imports AS (SELECT comcode, coo_alpha, port_alpha, account_date, value, quantity_1 FROM import_rows),
exports AS (SELECT comcode, c_code AS cod_alpha,
    CASE WHEN l_linenumber = 7 THEN '' ELSE 'P' || lpad(cast(l_suppkey % 40 AS varchar),2,'0') END AS port_alpha,
    strftime(l_shipdate,'%m/%Y') AS account_date, value, quantity_1
  FROM flow_base WHERE l_linestatus = 'F' AND c_reg <> 3),
arrivals AS (SELECT comcode AS smk_comcode, s_code AS smk_cod_alpha, '0' || strftime(l_shipdate,'%Y%m') AS smk_period_reference,
    cast(l_linenumber AS bigint) AS smk_no_of_consignments, value AS smk_stat_value, quantity_1 AS smk_nett_mass
  FROM flow_base WHERE l_linestatus = 'O' AND s_reg = 3),
dispatches AS (SELECT comcode AS smk_comcode, c_code AS smk_cod_alpha, '0' || strftime(l_shipdate,'%Y%m') AS smk_period_reference,
    cast(l_linenumber AS bigint) AS smk_no_of_consignments, value AS smk_stat_value, quantity_1 AS smk_nett_mass
  FROM flow_base WHERE l_linestatus = 'F' AND c_reg = 3),
country AS (SELECT lpad(cast(n_nationkey AS varchar),2,'0') AS countrycode, n_name AS countryname FROM nation),
port_raw AS (SELECT 'P' || lpad(cast(s_suppkey % 40 AS varchar),2,'0') AS portcode,
    CASE WHEN s_suppkey % 3 = 0 THEN upper('Port ' || s_name) ELSE 'Port ' || s_name END AS portname,
    CASE WHEN s_suppkey % 2 = 0 THEN 'Airport' ELSE 'Seaport' END AS type FROM supplier),
port AS (SELECT DISTINCT 'P' || lpad(cast(c_custkey % 40 AS varchar),2,'0') AS portcode,
    'Port ' || lpad(cast(c_custkey % 40 AS varchar),2,'0') AS portname,
    CASE WHEN c_custkey % 2 = 0 THEN 'Airport' ELSE 'Seaport' END AS type FROM customer),
leaf AS (SELECT lpad(cast(p_partkey % 24 + 1 AS varchar),2,'0') || lpad(cast(p_size AS varchar),2,'0') ||
    lpad(cast(p_partkey % 7 AS varchar),2,'0') || lpad(cast(p_partkey % 100 AS varchar),2,'0') AS commoditycode,
    min(p_name) AS description FROM part GROUP BY 1),
codes AS MATERIALIZED (
  SELECT commoditycode, description FROM leaf
  UNION ALL SELECT DISTINCT commoditycode[1:2], 'Heading ' || commoditycode[1:2] FROM leaf
  UNION ALL SELECT DISTINCT commoditycode[1:4], 'Heading ' || commoditycode[1:4] FROM leaf WHERE commoditycode[4:4] <> '0'
  UNION ALL SELECT DISTINCT commoditycode[1:6], 'Heading ' || commoditycode[1:6] FROM leaf WHERE commoditycode[5:6] <> '03'),
map_points AS (SELECT lpad(cast(n_nationkey AS varchar),2,'0') AS region, n_nationkey AS grp, k AS ord,
    n_nationkey + CASE WHEN k IN (2,3) THEN 0.5::double ELSE 0.0::double END AS lng,
    n_regionkey + CASE WHEN k IN (3,4) THEN 0.5::double ELSE 0.0::double END AS lat
  FROM nation CROSS JOIN (VALUES (1),(2),(3),(4)) c(k)),
nomen_raw AS (
  SELECT cast(rpad(commoditycode,8,'0') AS bigint) * 10 + length(commoditycode) // 2 AS line_no,
    commoditycode[1:4] || CASE WHEN length(commoditycode) >= 6 THEN ' ' || commoditycode[5:6] ELSE '' END
      || CASE WHEN length(commoditycode) >= 8 THEN ' ' || commoditycode[7:8] ELSE '' END AS code_1,
    CASE WHEN length(commoditycode) = 2 THEN ['I','II','III','IV','V'][(cast(commoditycode AS int) - 1) // 5 + 1]
         WHEN length(commoditycode) = 8 AND right(commoditycode,1) IN ('0','2','4') THEN commoditycode[1:6] END AS parent_1,
    description
  FROM codes WHERE length(commoditycode) < 8 OR right(commoditycode,1) <> '7'
  UNION ALL
  SELECT cast(rpad(min(commoditycode),8,'0') AS bigint) * 10,
    ['I','II','III','IV','V'][(cast(commoditycode AS int) - 1) // 5 + 1] AS s, NULL, 'Section ' || s
  FROM codes WHERE length(commoditycode) = 2 GROUP BY s
  UNION ALL SELECT -cast(r_regionkey AS bigint) - 1, NULL, NULL, r_name FROM region),
nomen AS (SELECT line_no, replace(code_1,' ','') AS commoditycode, replace(parent_1,' ','') AS parent, description
  FROM nomen_raw WHERE code_1 IS NOT NULL),
control AS (SELECT commoditycode, 'Control ' || description AS description FROM leaf WHERE right(commoditycode,1) <> '3'),
locode_raw AS (SELECT CASE WHEN s_suppkey % 4 = 3 THEN 'FR' ELSE 'GB' END AS x2,
    'P' || lpad(cast(s_suppkey % 40 AS varchar),2,'0') AS x3, 'Port ' || s_name AS x5,
    CASE WHEN s_suppkey % 9 <> 0 THEN
      cast(50 + s_suppkey % 10 AS varchar) || lpad(cast(s_suppkey * 7 % 60 AS varchar),2,'0')
      || CASE WHEN s_suppkey % 11 = 0 THEN 'S' ELSE 'N' END || ' ' || lpad(cast(s_suppkey % 6 AS varchar),3,'0')
      || lpad(cast(s_suppkey * 13 % 60 AS varchar),2,'0') || CASE WHEN s_suppkey % 2 = 0 THEN 'W' ELSE 'E' END END AS x11,
    s_suppkey
  FROM supplier),
locode AS (SELECT x3 AS portcode, x5 AS portname,
    (50 + s_suppkey % 10 + (s_suppkey * 7 % 60) / 60.0::double) * CASE WHEN s_suppkey % 11 = 0 THEN -1 ELSE 1 END AS lat,
    (s_suppkey % 6 + (s_suppkey * 13 % 60) / 60.0::double) * CASE WHEN s_suppkey % 2 = 0 THEN -1 ELSE 1 END + 0.0::double AS long
  FROM locode_raw WHERE x2 = 'GB' AND x11 IS NOT NULL),
extra_ports AS (
  SELECT 'Port ' || s_name AS portname_x, 'P' || lpad(cast(s_suppkey % 40 AS varchar),2,'0') AS portcode,
    51.0::double + s_suppkey % 7 / 8.0::double AS lat,
    CASE WHEN s_suppkey % 5 <> 0 THEN -1.0::double + s_suppkey % 3 / 4.0::double END AS long FROM supplier
  UNION ALL SELECT 'Harbour ' || c_name, 'P' || lpad(cast(c_custkey % 40 AS varchar),2,'0'),
    52.0::double + c_custkey % 7 / 8.0::double, c_custkey % 3 / 4.0::double FROM customer),
coords AS (SELECT upper(coalesce(l.portname, e.portname_x)) AS portname, coalesce(l.portcode, e.portcode) AS portcode,
    coalesce(l.lat, e.lat) AS lat, coalesce(l.long, e.long) AS long
  FROM locode l FULL OUTER JOIN extra_ports e ON l.portname = e.portname_x),
lookup AS (SELECT key_name, value FROM (
    SELECT key_name, value, row_number() OVER (PARTITION BY key_name ORDER BY rank, value) AS rn FROM (
      SELECT portcode AS key_name, portname AS value, 0 AS rank FROM port
      UNION ALL SELECT countrycode, countryname, 1 FROM country) b WHERE value IS NOT NULL AND value <> '') r
  WHERE rn = 1),
imp_cube AS (SELECT coo_alpha AS country, comcode, port_alpha AS port, account_date[4:7] || '-' || account_date[1:2] AS month,
    cast(sum(value) AS bigint) AS price, cast(sum(quantity_1) AS bigint) AS weight FROM imports
  WHERE coo_alpha IN (SELECT countrycode FROM country) AND port_alpha IN (SELECT portcode FROM port) GROUP BY ALL),
exp_cube AS (SELECT cod_alpha AS country, comcode, port_alpha AS port, account_date[4:7] || '-' || account_date[1:2] AS month,
    cast(sum(value) AS bigint) AS price, cast(sum(quantity_1) AS bigint) AS weight FROM exports
  WHERE cod_alpha IN (SELECT countrycode FROM country) AND port_alpha IN (SELECT portcode FROM port) GROUP BY ALL),
arr_cube AS (SELECT smk_cod_alpha AS country, smk_comcode AS comcode, smk_period_reference[2:5] || '-' || smk_period_reference[6:7] AS month,
    cast(sum(smk_no_of_consignments) AS bigint) AS consignments, cast(sum(smk_stat_value) AS bigint) AS price,
    cast(sum(smk_nett_mass) AS bigint) AS weight FROM arrivals
  WHERE smk_cod_alpha IN (SELECT countrycode FROM country) GROUP BY ALL),
disp_cube AS (SELECT smk_cod_alpha AS country, smk_comcode AS comcode, smk_period_reference[2:5] || '-' || smk_period_reference[6:7] AS month,
    cast(sum(smk_no_of_consignments) AS bigint) AS consignments, cast(sum(smk_stat_value) AS bigint) AS price,
    cast(sum(smk_nett_mass) AS bigint) AS weight FROM dispatches
  WHERE smk_cod_alpha IN (SELECT countrycode FROM country) GROUP BY ALL)
""".strip()
