"""DuckDB oracle SQL for every query key with an SQL equivalent.

Written independently of the Spark code: the fixture views are the SQL
text of FIXTURES.md section 3, the reports are plain GROUP BY / CASE SQL.
DuckDB notes: ``sum`` of BIGINT is HUGEINT and ``date_diff`` is BIGINT, so
both are cast back; Spark's ``datediff(end, start)`` is
``date_diff('day', start, end)``.
"""

from __future__ import annotations

# Literal load timestamps used by queries that stamp rows (a query with an
# oracle never returns current_timestamp()).
TS1 = "2024-01-01 00:00:00"
TS2 = "2024-02-01 00:00:00"
TS3 = "2024-03-01 00:00:00"

CLIENTS = """
SELECT CAST(c_custkey + 9950 AS VARCHAR) AS client_id, c_name AS name,
       CONCAT('c', CAST(c_custkey AS VARCHAR), '@example.com') AS email,
       CAST(CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE 16 + (c_custkey * 7) % 50 END AS INT) AS age,
       n_name AS state
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey % 17 <> 0
"""

FUNNEL_EVENTS = """
SELECT CAST(o_custkey + 9950 AS VARCHAR) AS client_id,
       CASE WHEN o_custkey % 2 = 0 THEN 'ios' ELSE 'android' END AS app,
       CASE o_orderkey % 7 WHEN 0 THEN 'Introduccion' WHEN 1 THEN 'Solicitud de datos'
         WHEN 2 THEN 'Validacion de datos' WHEN 3 THEN 'Reconocimiento facial'
         WHEN 4 THEN 'Firma' WHEN 5 THEN 'Confirmacion de datos' ELSE 'Otro' END AS stage,
       CAST(o_orderdate AS DATE) AS register_date,
       CAST(CASE WHEN o_custkey % 31 = 0 THEN 2
                 WHEN o_custkey % 6 = 5 AND o_custkey % 5 <> 0 THEN 1 ELSE 0 END AS INT) AS complete_process,
       o_orderdate
FROM orders
WHERE o_orderkey % 7 = 6 OR o_orderkey % 7 <= o_custkey % 6
"""

STAGE_CASE = """CASE stage WHEN 'Introduccion' THEN 'introduction' WHEN 'Solicitud de datos' THEN 'data_request'
  WHEN 'Validacion de datos' THEN 'data_validation' WHEN 'Reconocimiento facial' THEN 'facial_recognition'
  WHEN 'Firma' THEN 'signature' WHEN 'Confirmacion de datos' THEN 'data_confirmation' END"""


def _pivot_select(src: str, keys: str) -> str:
    return f"""
SELECT {keys},
  MIN(CASE WHEN stage = 'Introduccion' THEN register_date END) AS introduction,
  MIN(CASE WHEN stage = 'Solicitud de datos' THEN register_date END) AS data_request,
  MIN(CASE WHEN stage = 'Validacion de datos' THEN register_date END) AS data_validation,
  MIN(CASE WHEN stage = 'Reconocimiento facial' THEN register_date END) AS facial_recognition,
  MIN(CASE WHEN stage = 'Firma' THEN register_date END) AS signature,
  MIN(CASE WHEN stage = 'Confirmacion de datos' THEN register_date END) AS data_confirmation
FROM {src} GROUP BY {keys}"""


BASE = f"""
WITH clients AS ({CLIENTS}),
funnel_ev AS ({FUNNEL_EVENTS}),
funnel AS (SELECT client_id, app, stage, register_date, complete_process FROM funnel_ev),
joined AS (
  SELECT f.client_id, c.name, c.age, c.state, c.email, f.app, f.stage, f.register_date, f.complete_process,
         CASE WHEN length(f.client_id) = 5 AND f.complete_process IN (0, 1) THEN 'Passed' ELSE 'Not Passed' END
           AS quality_check
  FROM funnel f JOIN clients c ON f.client_id = c.client_id),
pv AS ({_pivot_select('joined', 'client_id, complete_process, name, age, state, email, app')})
"""

REACHED = """
  COUNT(*) AS TI,
  COUNT(CASE WHEN COALESCE(data_request, data_validation, facial_recognition, signature, data_confirmation) IS NOT NULL THEN 1 END) AS TSD,
  COUNT(CASE WHEN COALESCE(data_validation, facial_recognition, signature, data_confirmation) IS NOT NULL THEN 1 END) AS TVD,
  COUNT(CASE WHEN COALESCE(facial_recognition, signature, data_confirmation) IS NOT NULL THEN 1 END) AS TRF,
  COUNT(CASE WHEN COALESCE(signature, data_confirmation) IS NOT NULL THEN 1 END) AS TF,
  COUNT(CASE WHEN data_confirmation IS NOT NULL THEN 1 END) AS TCD"""

AGE_GROUP = """CASE WHEN age >= 18 AND age <= 25 THEN '18-25' WHEN age >= 26 AND age <= 35 THEN '26-35'
  WHEN age >= 36 AND age <= 50 THEN '36-50' ELSE '50+' END"""

# One row per (stage code, position) for unpivoting in SQL.
CODES = """(VALUES ('TI', 1), ('TSD', 2), ('TVD', 3), ('TRF', 4), ('TF', 5), ('TCD', 6)) AS codes(code, pos)"""


def _unpivot(src: str, ids: str, value: str = "Total_users") -> str:
    ids_sel = f"{ids}, " if ids else ""
    return f"""SELECT {ids_sel}code AS stage,
  CAST(CASE code WHEN 'TI' THEN TI WHEN 'TSD' THEN TSD WHEN 'TVD' THEN TVD WHEN 'TRF' THEN TRF
       WHEN 'TF' THEN TF ELSE TCD END AS BIGINT) AS {value}
FROM {src} CROSS JOIN {CODES}"""


SQL: dict[str, str] = {}

SQL["funnel_enriched"] = BASE + "SELECT client_id, name, age, state, email, app, stage, register_date, complete_process, quality_check FROM joined"
SQL["quality_check"] = BASE + """SELECT client_id, app, stage, register_date, complete_process,
  CASE WHEN length(client_id) = 5 AND complete_process IN (0, 1) THEN 'Passed' ELSE 'Not Passed' END AS quality_check
FROM funnel"""
SQL["map_stage"] = BASE + f"SELECT client_id, app, {STAGE_CASE} AS stage, register_date, complete_process FROM funnel"
SQL["pivot_stages"] = BASE + "SELECT * FROM pv"
SQL["age_group"] = BASE + f"SELECT client_id, name, email, age, state, {AGE_GROUP} AS Age_group FROM clients"
SQL["finished_all"] = BASE + "SELECT COUNT(*) AS finished_all FROM pv WHERE complete_process = 1"
SQL["didnt_finish_all"] = BASE + "SELECT COUNT(*) AS didnt_finish_all FROM pv WHERE complete_process = 0"
SQL["total_time"] = BASE + """SELECT client_id, complete_process, MAX(data_confirmation) AS max, MIN(introduction) AS min,
  CAST(date_diff('day', MIN(introduction), MAX(data_confirmation)) AS INT) AS total_time_days
FROM pv WHERE complete_process = 1 GROUP BY client_id, complete_process"""
SQL["abandonment"] = BASE + """SELECT
  COUNT(CASE WHEN data_request IS NULL AND data_validation IS NULL AND facial_recognition IS NULL AND signature IS NULL AND data_confirmation IS NULL THEN 1 END) AS TI,
  COUNT(CASE WHEN data_request IS NOT NULL AND data_validation IS NULL AND facial_recognition IS NULL AND signature IS NULL AND data_confirmation IS NULL THEN 1 END) AS TSD,
  COUNT(CASE WHEN data_validation IS NOT NULL AND facial_recognition IS NULL AND signature IS NULL AND data_confirmation IS NULL THEN 1 END) AS TVD,
  COUNT(CASE WHEN facial_recognition IS NOT NULL AND signature IS NULL AND data_confirmation IS NULL THEN 1 END) AS TRF,
  COUNT(CASE WHEN signature IS NOT NULL AND data_confirmation IS NULL THEN 1 END) AS TF,
  COUNT(CASE WHEN data_confirmation IS NOT NULL THEN 1 END) AS TCD
FROM pv WHERE complete_process = 0"""
SQL["state_completed"] = BASE + "SELECT state, COUNT(*) AS Total_per_country FROM pv WHERE complete_process = 1 GROUP BY state"
SQL["state_open"] = BASE + "SELECT state, COUNT(*) AS Total_per_country FROM pv WHERE complete_process = 0 GROUP BY state"
SQL["confirmed_not_complete"] = BASE + """SELECT state, COUNT(*) AS Total_per_country FROM pv
WHERE complete_process = 0 AND data_confirmation IS NOT NULL GROUP BY state"""
SQL["avg_days_state"] = BASE + """SELECT state, AVG(date_diff('day', introduction, data_confirmation)) AS AV
FROM pv WHERE complete_process = 1 GROUP BY state"""
SQL["state_clients"] = BASE + "SELECT state, COUNT(*) AS Total_per_country FROM pv GROUP BY state"
SQL["funnel_global"] = BASE + f"SELECT {REACHED} FROM pv"
SQL["funnel_state"] = BASE + f"SELECT state, {REACHED} FROM pv GROUP BY state"
SQL["funnel_state_age"] = BASE + f"""SELECT state, Age_group, {REACHED}
FROM (SELECT *, {AGE_GROUP} AS Age_group FROM pv) GROUP BY state, Age_group"""
SQL["funnel_unpivot"] = BASE + f"""{_unpivot(f'(SELECT state, {REACHED} FROM pv GROUP BY state)', 'state')}"""
SQL["conversion_global"] = BASE + f"""SELECT stage, Total_by_stage,
  ROUND(CAST(Total_by_stage AS DOUBLE) * 100.0 / ti, 2) AS Percentage_conversion
FROM ({_unpivot(f'(SELECT {REACHED} FROM pv)', '', 'Total_by_stage')}) u
CROSS JOIN (SELECT COUNT(*) AS ti FROM pv) t"""
SQL["conversion_per_state"] = BASE + f"""SELECT a.state, a.stage, a.Total_users,
  ROUND(CAST(a.Total_users AS DOUBLE) * 100.0 / b.Total_users, 2) AS Percentage_conversion
FROM ({_unpivot(f'(SELECT state, {REACHED} FROM pv GROUP BY state)', 'state')}) a
JOIN ({_unpivot(f'(SELECT state, {REACHED} FROM pv GROUP BY state)', 'state')}) b
  ON a.state = b.state AND b.stage = 'TI'"""
SQL["conversion_tcd_state"] = SQL["conversion_per_state"].replace(
    "AND b.stage = 'TI'", "AND b.stage = 'TI' WHERE a.stage = 'TCD'")
SQL["conversion_by_age"] = BASE + f""", per_age AS (
  {_unpivot(f"(SELECT state, Age_group, {REACHED} FROM (SELECT *, {AGE_GROUP} AS Age_group FROM pv) GROUP BY state, Age_group)", 'state, Age_group')}),
ti AS (SELECT state, CAST(SUM(Total_users) AS BIGINT) AS Total_TI FROM per_age WHERE stage = 'TI' GROUP BY state)
SELECT p.state, p.Age_group, p.stage, p.Total_users, ti.Total_TI,
  ROUND(CAST(p.Total_users AS DOUBLE) * 100.0 / ti.Total_TI, 2) AS Percentage_conversion
FROM per_age p JOIN ti ON p.state = ti.state"""
SQL["dropoff"] = BASE + """, r AS (SELECT """ + REACHED + """ FROM pv),
pairs AS (
  SELECT 'TI' AS from_stage, 'TSD' AS to_stage, TI AS reached_from, TSD AS reached_to FROM r UNION ALL
  SELECT 'TSD', 'TVD', TSD, TVD FROM r UNION ALL
  SELECT 'TVD', 'TRF', TVD, TRF FROM r UNION ALL
  SELECT 'TRF', 'TF', TRF, TF FROM r UNION ALL
  SELECT 'TF', 'TCD', TF, TCD FROM r)
SELECT from_stage, to_stage, CAST(reached_from AS BIGINT) AS reached_from, CAST(reached_to AS BIGINT) AS reached_to,
  CAST(reached_from - reached_to AS BIGINT) AS lost,
  ROUND(CAST(reached_from - reached_to AS DOUBLE) * 100.0 / NULLIF(reached_from, 0), 2) AS pct_lost
FROM pairs"""
SQL["avg_days_per_stage"] = BASE + """, pairs AS (
  SELECT 'TI' AS from_stage, 'TSD' AS to_stage, introduction AS a, data_request AS b FROM pv UNION ALL
  SELECT 'TSD', 'TVD', data_request, data_validation FROM pv UNION ALL
  SELECT 'TVD', 'TRF', data_validation, facial_recognition FROM pv UNION ALL
  SELECT 'TRF', 'TF', facial_recognition, signature FROM pv UNION ALL
  SELECT 'TF', 'TCD', signature, data_confirmation FROM pv)
SELECT from_stage, to_stage,
  CAST(COUNT(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 1 END) AS BIGINT) AS n_clients,
  AVG(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN date_diff('day', a, b) END) AS avg_days
FROM pairs GROUP BY from_stage, to_stage"""
SQL["top_abandoned_stage"] = BASE + f""", ab AS ({SQL['abandonment'].split(BASE, 1)[1]})
SELECT u.stage, u.Total_users FROM ({_unpivot('ab', '')}) u
JOIN {CODES} ON u.stage = codes.code
ORDER BY u.Total_users DESC, codes.pos LIMIT 1"""
SQL["pivot_stages_reference_order"] = SQL["pivot_stages"]

# --- landing, stamps, parsing ----------------------------------------------

FUNNEL_TEXT = """SELECT client_id AS ID_cliente, app AS App, stage, strftime(register_date, '%Y-%m-%d') AS date,
  CAST(complete_process AS VARCHAR) AS Proceso_completo FROM funnel"""

SQL["landing_csv"] = BASE + FUNNEL_TEXT
SQL["load_stamp"] = BASE + f"SELECT *, TIMESTAMP '{TS1}' AS fecha_ingesta FROM ({FUNNEL_TEXT})"
SQL["conform_funnel"] = BASE + f"""SELECT client_id, app, stage, register_date, complete_process,
  TIMESTAMP '{TS1}' AS ingestion_date FROM funnel"""
SQL["conform_clients"] = BASE + f"""SELECT client_id, name, email, age, state,
  TIMESTAMP '{TS1}' AS ingestion_date FROM clients"""
SQL["parse_date"] = """SELECT o_orderkey,
  CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d')
       ELSE 'not-a-date' END AS txt,
  CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed
FROM orders"""
SQL["parse_timestamp"] = """SELECT o_orderkey,
  CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
       WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d %H:%M:%S') ELSE 'not-a-date' END AS txt,
  CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END AS parsed
FROM orders"""
SQL["parse_rejects"] = """SELECT COUNT(*) AS rows,
  COUNT(CASE WHEN o_orderkey % 3 = 2 THEN 1 END) AS rejected_register_date FROM orders"""

# --- MERGE ------------------------------------------------------------------

BATCHES = BASE + """,
b1 AS (SELECT client_id, app, stage, MIN(register_date) AS register_date, complete_process FROM funnel_ev
       WHERE o_orderdate < TIMESTAMP '1996-01-01 00:00:00' GROUP BY client_id, app, stage, complete_process),
b2 AS (SELECT client_id, app, stage, MIN(register_date) AS register_date, complete_process FROM funnel_ev
       WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' GROUP BY client_id, app, stage, complete_process),
c1 AS (SELECT * FROM clients WHERE (CAST(client_id AS BIGINT) - 9950) % 4 <> 3),
c2 AS (SELECT client_id, name,
         CASE WHEN (CAST(client_id AS BIGINT) - 9950) % 5 = 0 THEN CONCAT('new.', email) ELSE email END AS email,
         CAST(CASE WHEN (CAST(client_id AS BIGINT) - 9950) % 11 = 0
                   THEN CASE WHEN age IS NULL THEN 40 ELSE NULL END ELSE age END AS INT) AS age,
         state
       FROM clients WHERE (CAST(client_id AS BIGINT) - 9950) % 4 <> 0)
"""

_F = "client_id, app, stage, register_date, complete_process"

SQL["merge_upsert_all"] = BATCHES + f"""
SELECT {_F}, TIMESTAMP '{TS2}' AS ingestion_date FROM b2
UNION ALL
SELECT {_F}, TIMESTAMP '{TS1}' FROM b1
WHERE NOT EXISTS (SELECT 1 FROM b2 WHERE b2.client_id = b1.client_id AND b2.stage = b1.stage)"""

SQL["merge_insert_only"] = BATCHES + f"""
SELECT {_F}, TIMESTAMP '{TS1}' AS ingestion_date FROM b1
UNION ALL
SELECT {_F}, TIMESTAMP '{TS2}' FROM b2
WHERE NOT EXISTS (SELECT 1 FROM b1 WHERE b1.client_id = b2.client_id AND b1.stage = b2.stage)"""


def _catalog_merge_sql(cmp: str) -> str:
    cond = f" OR ".join(f"t.{c} {cmp} s.{c}" for c in ("name", "email", "age", "state"))
    return BATCHES + f""",
t AS (SELECT client_id, name, email, age, state, TIMESTAMP '{TS1}' AS ingestion_date,
             CAST(NULL AS TIMESTAMP) AS update_date FROM c1),
s AS (SELECT client_id, name, email, age, state, TIMESTAMP '{TS2}' AS ingestion_date FROM c2)
SELECT t.client_id, s.name, s.email, s.age, s.state, s.ingestion_date, TIMESTAMP '{TS3}' AS update_date
FROM t JOIN s ON t.client_id = s.client_id WHERE COALESCE({cond}, FALSE)
UNION ALL
SELECT t.* FROM t JOIN s ON t.client_id = s.client_id WHERE NOT COALESCE({cond}, FALSE)
UNION ALL
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.client_id = t.client_id)
UNION ALL
SELECT s.client_id, s.name, s.email, s.age, s.state, s.ingestion_date, CAST(NULL AS TIMESTAMP)
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.client_id = s.client_id)"""


SQL["merge_scd1_catalog"] = _catalog_merge_sql("<>")
SQL["merge_scd1_catalog_null_safe"] = _catalog_merge_sql("IS DISTINCT FROM")

_E = "client_id, name, age, state, email, app, stage, register_date, complete_process, quality_check"
ENRICHED_BATCHES = BATCHES + f""",
e1 AS (SELECT j.* FROM (SELECT f.client_id, c.name, c.age, c.state, c.email, f.app, f.stage, f.register_date,
         f.complete_process,
         CASE WHEN length(f.client_id) = 5 AND f.complete_process IN (0, 1) THEN 'Passed' ELSE 'Not Passed' END
           AS quality_check
       FROM b1 f JOIN clients c ON f.client_id = c.client_id) j),
e2 AS (SELECT j.* FROM (SELECT f.client_id, c.name, c.age, c.state, c.email, f.app, f.stage, f.register_date,
         f.complete_process,
         CASE WHEN length(f.client_id) = 5 AND f.complete_process IN (0, 1) THEN 'Passed' ELSE 'Not Passed' END
           AS quality_check
       FROM b2 f JOIN clients c ON f.client_id = c.client_id) j),
cf AS (SELECT {_E}, TIMESTAMP '{TS1}' AS ingestion_date FROM e1
       UNION ALL
       SELECT {_E}, TIMESTAMP '{TS2}' FROM e2
       WHERE NOT EXISTS (SELECT 1 FROM e1 WHERE e1.client_id = e2.client_id AND e1.stage = e2.stage))
"""
SQL["merge_clients_funnel"] = ENRICHED_BATCHES + "SELECT * FROM cf"

_PVK = "client_id, complete_process, name, age, state, email, app"
_STG = "introduction, data_request, data_validation, facial_recognition, signature, data_confirmation"
_CMP = ["name", "email", "age", "state", "complete_process", *_STG.split(", ")]


def _pivot_merge_sql(cmp: str) -> str:
    cond = " OR ".join(f"t.{c} {cmp} s.{c}" for c in _CMP)
    sets = ", ".join(f"s.{c}" for c in _CMP)
    return ENRICHED_BATCHES + f""",
t AS (SELECT *, TIMESTAMP '{TS1}' AS ingestion_time, CAST(NULL AS TIMESTAMP) AS update_date
      FROM ({_pivot_select('e1', _PVK)})),
s AS ({_pivot_select('cf', _PVK)})
SELECT t.client_id, t.app, t.ingestion_time, {sets}, TIMESTAMP '{TS3}' AS update_date
FROM t JOIN s ON t.client_id = s.client_id WHERE COALESCE({cond}, FALSE)
UNION ALL
SELECT t.client_id, t.app, t.ingestion_time, {", ".join("t." + c for c in _CMP)}, t.update_date
FROM t JOIN s ON t.client_id = s.client_id WHERE NOT COALESCE({cond}, FALSE)
UNION ALL
SELECT t.client_id, t.app, t.ingestion_time, {", ".join("t." + c for c in _CMP)}, t.update_date
FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.client_id = t.client_id)
UNION ALL
SELECT s.client_id, s.app, TIMESTAMP '{TS2}', {sets}, CAST(NULL AS TIMESTAMP)
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.client_id = s.client_id)"""


SQL["merge_pivot_scd1"] = _pivot_merge_sql("<>")
SQL["merge_pivot_scd1_null_safe"] = _pivot_merge_sql("IS DISTINCT FROM")

SQL["create_or_merge"] = BATCHES + f"""
SELECT client_id AS ID_cliente, app AS App, stage, strftime(register_date, '%Y-%m-%d') AS date,
  CAST(complete_process AS VARCHAR) AS Proceso_completo, TIMESTAMP '{TS2}' AS fecha_ingesta FROM b2
UNION ALL
SELECT client_id, app, stage, strftime(register_date, '%Y-%m-%d'), CAST(complete_process AS VARCHAR),
  TIMESTAMP '{TS1}' FROM b1
WHERE NOT EXISTS (SELECT 1 FROM b2 WHERE b2.client_id = b1.client_id AND b2.stage = b1.stage)"""

# --- X6 / streaming -----------------------------------------------------------

SQL["landing_stream"] = SQL["create_or_merge"]
SQL["incremental_two_batches"] = BATCHES + """,
f AS (SELECT * FROM b2 UNION ALL
      SELECT * FROM b1 WHERE NOT EXISTS (SELECT 1 FROM b2 WHERE b2.client_id = b1.client_id AND b2.stage = b1.stage)),
c AS (SELECT * FROM c2 UNION ALL
      SELECT * FROM c1 WHERE NOT EXISTS (SELECT 1 FROM c2 WHERE c2.client_id = c1.client_id)),
p AS (SELECT client_id,
  COALESCE(MAX(complete_process) FILTER (WHERE complete_process IN (0, 1)), MAX(complete_process)) AS complete_process,
  FIRST(app ORDER BY register_date NULLS LAST, app) FILTER (WHERE app IS NOT NULL) AS app,
  MIN(CASE WHEN stage = 'Introduccion' THEN register_date END) AS introduction,
  MIN(CASE WHEN stage = 'Solicitud de datos' THEN register_date END) AS data_request,
  MIN(CASE WHEN stage = 'Validacion de datos' THEN register_date END) AS data_validation,
  MIN(CASE WHEN stage = 'Reconocimiento facial' THEN register_date END) AS facial_recognition,
  MIN(CASE WHEN stage = 'Firma' THEN register_date END) AS signature,
  MIN(CASE WHEN stage = 'Confirmacion de datos' THEN register_date END) AS data_confirmation
  FROM f GROUP BY client_id)
SELECT p.client_id, p.complete_process, c.name, c.age, c.state, c.email, p.app, p.introduction, p.data_request,
  p.data_validation, p.facial_recognition, p.signature, p.data_confirmation
FROM p JOIN c ON p.client_id = c.client_id"""
SQL["load_rejects"] = BASE + """
SELECT 'usuarios_banco_con_funnel' AS file, 'register_date' AS "column", COUNT(*) AS rows,
       COUNT(CASE WHEN day(register_date) = 13 THEN 1 END) AS rejected FROM funnel
UNION ALL SELECT 'usuarios_banco_con_funnel', 'complete_process', COUNT(*), 0 FROM funnel
UNION ALL SELECT 'usuarios_banco_con_funnel', '(line)', COUNT(*), 0 FROM funnel
UNION ALL SELECT 'clientes', 'age', COUNT(*), COUNT(CASE WHEN age IS NULL THEN 1 END) FROM clients
UNION ALL SELECT 'clientes', '(line)', COUNT(*), 0 FROM clients"""
SQL["top_open_states"] = BASE + """SELECT state, COUNT(*) AS Total_per_country FROM pv WHERE complete_process = 0
GROUP BY state ORDER BY Total_per_country DESC, state LIMIT 5"""
SQL["merge_text_condition"] = BATCHES + f"""
SELECT t.client_id, t.app, t.stage, s.register_date, t.complete_process
FROM b1 t JOIN b2 s ON t.client_id = s.client_id AND t.stage = s.stage AND s.register_date > t.register_date
UNION ALL
SELECT {_F} FROM b1 t WHERE NOT EXISTS (SELECT 1 FROM b2 s
  WHERE t.client_id = s.client_id AND t.stage = s.stage AND s.register_date > t.register_date)
UNION ALL
SELECT {_F} FROM b2 s WHERE NOT EXISTS (SELECT 1 FROM b1 t
  WHERE t.client_id = s.client_id AND t.stage = s.stage AND s.register_date > t.register_date)"""
SQL["incremental_two_batches_bucketed"] = SQL["incremental_two_batches"]
SQL["incremental_same_stamp"] = SQL["incremental_two_batches"]
SQL["funnel_rollup_state"] = SQL["funnel_state"]
SQL["funnel_rollup_conversion_by_age"] = SQL["conversion_by_age"]
SQL["empty_table_first_merge"] = BASE + f"""SELECT client_id, app, stage, register_date, complete_process,
  TIMESTAMP '{TS1}' AS ingestion_date FROM funnel"""

# --- Operators over time -------------------------------------------------------

SQL["dedupe_latest"] = BASE + f""", ev AS (SELECT client_id, app, {STAGE_CASE} AS stage,
  CASE WHEN day(register_date) <> 13 THEN register_date END AS register_date, complete_process FROM funnel),
r AS (SELECT *, row_number() OVER (PARTITION BY client_id, stage
  ORDER BY register_date DESC NULLS LAST, app DESC, complete_process DESC) AS n FROM ev WHERE stage IS NOT NULL)
SELECT client_id, app, stage, register_date, complete_process FROM r WHERE n = 1
UNION ALL SELECT client_id, app, stage, register_date, complete_process FROM ev WHERE stage IS NULL"""

POSITION = """CASE stage WHEN 'Introduccion' THEN 0 WHEN 'Solicitud de datos' THEN 1 WHEN 'Validacion de datos' THEN 2
  WHEN 'Reconocimiento facial' THEN 3 WHEN 'Firma' THEN 4 WHEN 'Confirmacion de datos' THEN 5 END"""


def _ordered_funnel_sql(src: str, by: str, within: int | None) -> str:
    """Depth of every start (each day of the first stage), earliest next stage each; a client's depth is the best of them."""
    limit = "" if within is None else f" AND e.day <= s.d0 + {within}"
    keys = f"{by}, client_id" if by else "client_id"
    steps = [f"s0 AS (SELECT DISTINCT {keys}, day AS d0, day AS at, 1 AS depth FROM ev WHERE pos = 0)"]
    on = " AND ".join(f"e.{k.strip()} IS NOT DISTINCT FROM s.{k.strip()}" for k in keys.split(","))
    for i in range(1, 6):
        cols = ", ".join(f"s.{k.strip()}" for k in keys.split(","))
        steps.append(f"s{i} AS (SELECT {cols}, s.d0, MIN(e.day) AS at, {i + 1} AS depth FROM s{i - 1} s JOIN ev e ON {on} "
                     f"AND e.pos = {i} AND e.day >= s.at{limit} GROUP BY {cols}, s.d0)")
    every = " UNION ALL ".join(f"SELECT {keys}, depth FROM s{i}" for i in range(6))
    counts = ", ".join(f"COUNT(CASE WHEN depth > {i} THEN 1 END) AS {c}" for i, c in enumerate(("TI", "TSD", "TVD", "TRF", "TF", "TCD")))
    return BASE + f""", ev AS (SELECT DISTINCT {keys}, register_date AS day, {POSITION} AS pos FROM {src}
  WHERE register_date IS NOT NULL AND {POSITION} IS NOT NULL),
{", ".join(steps)},
best AS (SELECT {keys}, MAX(depth) AS depth FROM (SELECT DISTINCT {keys}, 0 AS depth FROM ev UNION ALL {every}) GROUP BY {keys})
SELECT {by + ", " if by else ""}{counts} FROM best {"GROUP BY " + by if by else ""}"""


SQL["ordered_funnel_state"] = _ordered_funnel_sql("joined", "state", 365)
SQL["ordered_funnel_global"] = _ordered_funnel_sql("funnel", "", None)

_GROW = """l{n} AS (SELECT l.client_id, l.path || '>' || s.code AS path, MIN(s.k) AS k FROM l{m} l
  JOIN seq s ON s.client_id = l.client_id AND s.k > l.k GROUP BY 1, 2)"""
SQL["frequent_paths"] = BASE + f""", ev AS (SELECT DISTINCT client_id, register_date AS day, {POSITION} AS pos FROM funnel
  WHERE register_date IS NOT NULL AND {POSITION} IS NOT NULL),
seq AS (SELECT client_id, code, row_number() OVER (PARTITION BY client_id ORDER BY day, ev.pos) AS k
  FROM ev JOIN {CODES} ON codes.pos = ev.pos + 1),
total AS (SELECT COUNT(DISTINCT client_id) AS n FROM ev),
l1 AS (SELECT client_id, code AS path, MIN(k) AS k FROM seq GROUP BY 1, 2),
{_GROW.format(n=2, m=1)}, {_GROW.format(n=3, m=2)}, {_GROW.format(n=4, m=3)},
found AS (SELECT 1 AS length, * FROM l1 UNION ALL SELECT 2, * FROM l2 UNION ALL SELECT 3, * FROM l3 UNION ALL SELECT 4, * FROM l4)
SELECT path, CAST(length AS INT) AS length, COUNT(*) AS clients, COUNT(*) / CAST(MAX(n) AS DOUBLE) AS support
FROM found, total GROUP BY path, length HAVING COUNT(*) >= MAX(n) * CAST(0.1 AS DOUBLE)"""

HISTORY = BASE + """, changes AS (
  SELECT CAST(o_custkey + 9950 AS VARCHAR) AS client_id, CAST(o_orderdate AS DATE) AS changed_on,
    CASE WHEN o_orderkey % 10 <> 0 THEN CONCAT('c', CAST(o_custkey AS VARCHAR), '.', CAST(o_orderkey % 3 AS VARCHAR), '@example.com') END AS email,
    n_name AS state, o_orderkey AS load_no
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = (c_nationkey + (o_orderkey // 5) % 4) % 25
  WHERE o_orderkey % 5 = 0),
h AS (SELECT client_id, email, state, load_no, changed_on AS valid_from,
    LEAD(changed_on) OVER (PARTITION BY client_id ORDER BY changed_on) AS valid_to
  FROM (SELECT *, row_number() OVER (PARTITION BY client_id, changed_on ORDER BY load_no DESC) AS n FROM changes) WHERE n = 1)
"""
SQL["catalog_history"] = HISTORY + "SELECT * FROM h"
SQL["catalog_history_collapsed"] = HISTORY + """, e AS (SELECT client_id, state, valid_from FROM (
    SELECT *, LAG(state) OVER (PARTITION BY client_id ORDER BY valid_from) AS before FROM h) WHERE before IS DISTINCT FROM state),
s AS (SELECT client_id, state, valid_from, LEAD(valid_from) OVER (PARTITION BY client_id ORDER BY valid_from) AS valid_to FROM e)
SELECT *, valid_to IS NULL AS is_current FROM s"""
SQL["events_as_of"] = HISTORY + """SELECT f.*, h.email, h.state FROM funnel f LEFT JOIN h
  ON h.client_id = f.client_id AND h.valid_from <= f.register_date AND (h.valid_to IS NULL OR f.register_date < h.valid_to)"""

# --- Reports kept up from changes: recomputed from all drops so far ----------------

def _report_sums(drop: int) -> str:
    rows = " UNION ALL ".join(f"SELECT *, {d} AS d FROM fd WHERE part = {d - 1}" for d in range(1, drop + 1))
    cat = " UNION ALL ".join(
        f"""SELECT CAST(c_custkey + 9950 AS VARCHAR) AS client_id, n_name AS state, {d} AS d,
          CAST(CASE WHEN c_custkey % 23 <> 0 THEN 16 + (c_custkey * 7) % 50 + CASE WHEN c_custkey % 3 = 0 THEN {d} ELSE 0 END END AS INT) AS age
        FROM customer JOIN nation ON n_nationkey = (c_nationkey + CASE WHEN c_custkey % 3 = 0 THEN {d} ELSE 0 END) % 25
        WHERE c_custkey % 17 <> 0 AND ({d} = 1 OR (c_custkey + {d}) % 2 = 0)""" for d in range(1, drop + 1))
    stages = ("introduction", "data_request", "data_validation", "facial_recognition", "signature", "data_confirmation")
    codes = ("TI", "TSD", "TVD", "TRF", "TF", "TCD")
    left = ", ".join(
        "COUNT(CASE WHEN " + " AND ".join(([f"{s} IS NOT NULL"] if i else []) + [f"{x} IS NULL" for x in stages[i + 1:]]) + f" THEN 1 END) AS left_{c}"
        for i, (s, c) in enumerate(zip(stages, codes)))
    gaps = ", ".join(
        f"COUNT({e} - {b}) AS {n}_n, CAST(COALESCE(SUM(date_diff('day', {b}, {e})), 0) AS BIGINT) AS {n}_sum"
        for n, b, e in [("days", stages[0], stages[-1]), *[(f"gap{i}", stages[i], stages[i + 1]) for i in range(5)]])
    return f"""SELECT * FROM (WITH f AS (SELECT * FROM ({rows}) r QUALIFY row_number() OVER (PARTITION BY client_id, stage ORDER BY d DESC) = 1),
  c AS (SELECT * FROM ({cat}) r QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY d DESC) = 1),
  p AS (SELECT client_id, COALESCE(MAX(complete_process) FILTER (WHERE complete_process IN (0, 1)), MAX(complete_process)) AS complete_process,
    {", ".join(f"MIN(CASE WHEN {POSITION} = {i} THEN register_date END) AS {s}" for i, s in enumerate(stages))} FROM f GROUP BY client_id)
  SELECT {drop} AS "drop", state, {AGE_GROUP} AS Age_group, complete_process, {REACHED}, {left}, {gaps}
  FROM p JOIN c ON p.client_id = c.client_id GROUP BY state, Age_group, complete_process)"""


SQL["reports_kept_up"] = f"""WITH ev AS (SELECT *, (o_orderkey // 7) % 4 AS part FROM ({FUNNEL_EVENTS.replace("o_orderdate" + chr(10) + "FROM", "o_orderkey" + chr(10) + "FROM")})),
fd AS (SELECT client_id, app, stage, complete_process, part, MIN(register_date) AS register_date FROM ev
       GROUP BY client_id, app, stage, complete_process, part)
""" + " UNION ALL ".join(_report_sums(d) for d in range(1, 5))

# --- Survival, quantiles, overlaps ---------------------------------------------

SURVIVAL = BASE + """, t AS (SELECT state, COALESCE(data_confirmation <= DATE '2000-06-30', FALSE) AS seen,
    CASE WHEN data_confirmation <= DATE '2000-06-30' THEN data_confirmation ELSE DATE '2000-06-30' END - introduction AS day FROM pv),
g AS (SELECT state, CAST(day AS INT) AS day, COUNT(*) FILTER (WHERE seen) AS events, COUNT(*) FILTER (WHERE NOT seen) AS censored
  FROM t WHERE day >= 0 GROUP BY ALL),
r AS (SELECT *, CAST(SUM(events + censored) OVER (PARTITION BY state ORDER BY day DESC) AS BIGINT) AS at_risk FROM g),
curve AS (SELECT state, day, at_risk, events, censored,
    PRODUCT(1 - events / CAST(at_risk AS DOUBLE)) OVER w AS survival,
    CASE WHEN PRODUCT(1 - events / CAST(at_risk AS DOUBLE)) OVER w > 0 THEN PRODUCT(1 - events / CAST(at_risk AS DOUBLE)) OVER w * SQRT(SUM(
      CASE WHEN events < at_risk THEN events / CAST(at_risk * (at_risk - events) AS DOUBLE) ELSE 0 END) OVER w) END AS std_error
  FROM r WINDOW w AS (PARTITION BY state ORDER BY day))
"""
SQL["survival_state"] = SURVIVAL + "SELECT * FROM curve"
SQL["survival_medians"] = SURVIVAL + "SELECT state, MIN(day) FILTER (WHERE survival <= 0.75 + 1e-12) AS days FROM curve GROUP BY state"

_PV1, _PV2 = (_pivot_select(f"(SELECT b.*, c.name, c.age, c.state, c.email FROM {b} b JOIN clients c ON b.client_id = c.client_id)",
                            "client_id, complete_process, name, age, state, email, app") for b in ("b1", "b2"))
SQL["time_quantiles"] = BATCHES + f""", both_loads AS ({_PV1} UNION ALL {_PV2}),
gaps AS (""" + " UNION ALL ".join(
    f"SELECT state, '{a}' AS from_stage, '{b}' AS to_stage, date_diff('day', {x}, {y}) AS days FROM both_loads" for a, b, x, y in (
        ("TI", "TSD", "introduction", "data_request"), ("TSD", "TVD", "data_request", "data_validation"),
        ("TVD", "TRF", "data_validation", "facial_recognition"), ("TRF", "TF", "facial_recognition", "signature"),
        ("TF", "TCD", "signature", "data_confirmation"))) + """)
SELECT state, from_stage, to_stage, COUNT(days) AS n, quantile_disc(days, 0.5) AS p50, quantile_disc(days, 0.9) AS p90,
  quantile_disc(days, 0.95) AS p95 FROM gaps WHERE days IS NOT NULL GROUP BY state, from_stage, to_stage"""
SQL["time_quantiles_sketched"] = SQL["time_quantiles"]
SQL["stage_overlap"] = BASE + f""", cs AS (SELECT DISTINCT client_id, {POSITION} + 1 AS pos FROM funnel WHERE {POSITION} IS NOT NULL)
SELECT a.code AS first_stage, b.code AS second_stage,
  (SELECT COUNT(*) FROM cs WHERE pos = a.pos) AS in_first, (SELECT COUNT(*) FROM cs WHERE pos = b.pos) AS in_second,
  (SELECT COUNT(*) FROM cs x JOIN cs y ON x.client_id = y.client_id WHERE x.pos = a.pos AND y.pos = b.pos) AS in_both,
  (SELECT COUNT(DISTINCT client_id) FROM cs WHERE pos = a.pos OR pos = b.pos) AS in_either,
  (SELECT COUNT(*) FROM cs x WHERE x.pos = a.pos AND NOT EXISTS (SELECT 1 FROM cs y WHERE y.client_id = x.client_id AND y.pos = b.pos)) AS first_only
FROM {CODES.replace("codes(", "a(")} JOIN {CODES.replace("codes(", "b(")} ON a.pos < b.pos"""
SQL["stage_overlap_sketched"] = SQL["stage_overlap"]

# --- Unknown labels --------------------------------------------------------------

LABELS = f"""WITH ev AS ({FUNNEL_EVENTS.replace("o_orderdate" + chr(10) + "FROM", "o_orderkey" + chr(10) + "FROM")}),
bad AS (SELECT client_id, app, register_date, complete_process, CASE o_orderkey % 11
    WHEN 0 THEN replace(stage, 'cion', 'ción')
    WHEN 1 THEN substr(stage, 1, o_orderkey % 5 + 2) || substr(stage, o_orderkey % 5 + 4)
    WHEN 2 THEN substr(stage, 1, o_orderkey % 5 + 2) || substr(stage, o_orderkey % 5 + 2)
    WHEN 3 THEN substr(stage, 1, o_orderkey % 5 + 1) || 'x' || substr(stage, o_orderkey % 5 + 3)
    WHEN 4 THEN '  ' || upper(stage)
    WHEN 5 THEN 'yz' || substr(stage, 1, o_orderkey % 5 + 1) || 'xxxx' || substr(stage, o_orderkey % 5 + 6)
    ELSE stage END AS stage FROM ev),
canon AS (SELECT unnest(['Introduccion', 'Solicitud de datos', 'Validacion de datos', 'Reconocimiento facial', 'Firma', 'Confirmacion de datos']) AS c),
unk AS (SELECT stage AS label, COUNT(*) AS rows FROM bad WHERE stage NOT IN (SELECT c FROM canon) GROUP BY stage),
dist AS (SELECT label, c, levenshtein(trim(regexp_replace(strip_accents(lower(label)), '\\s+', ' ', 'g')), lower(c)) AS d FROM unk, canon),
near AS (SELECT label, c, d FROM dist WHERE d <= 2 QUALIFY d = MIN(d) OVER (PARTITION BY label)),
best AS (SELECT label, MIN(d) AS distance, COUNT(*) AS n, MIN(c) AS one, string_agg(c, '|' ORDER BY c) AS nearest FROM near GROUP BY label)
"""
SQL["propose_labels"] = LABELS + """SELECT u.label, u.rows, CASE WHEN n = 1 THEN one END AS proposal, CAST(distance AS INT) AS distance, nearest
FROM unk u LEFT JOIN best b ON u.label = b.label"""
SQL["map_stage_tolerant"] = LABELS + f""", fixed AS (SELECT client_id, app, COALESCE(CASE WHEN n = 1 THEN one END, stage) AS stage, register_date, complete_process
  FROM bad LEFT JOIN best ON stage = label)
SELECT client_id, app, {STAGE_CASE} AS stage, register_date, complete_process FROM fixed"""

# --- Groups that differ, functional dependencies -------------------------------------

def _differing_sql(groups: str, by: str) -> str:
    """Tails as plain sums over the binomial distribution, ranks and the step-up rule as windows."""
    term = "exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(p) + (n - i) * ln(1 - p))"
    return f"""{groups}, t AS (SELECT *, SUM(k) OVER () / CAST(SUM(n) OVER () AS DOUBLE) AS p FROM g),
tails AS (SELECT {by}, n, k, SUM(CASE WHEN i >= k THEN {term} ELSE 0 END) AS up, SUM(CASE WHEN i <= k THEN {term} ELSE 0 END) AS down
  FROM (SELECT *, unnest(range(0, n + 1)) AS i FROM t) GROUP BY {by}, n, k),
pv_ AS (SELECT {by}, n, k, k / CAST(n AS DOUBLE) AS rate, LEAST(1.0, 2 * LEAST(up, down)) AS p_value FROM tails),
r AS (SELECT *, COUNT(*) OVER (ORDER BY p_value) AS rank, COUNT(*) OVER () AS m FROM pv_)
SELECT {by}, n, k, rate, p_value, rank, COALESCE(BOOL_OR(p_value <= CAST(0.05 AS DOUBLE) * rank / m) OVER (ORDER BY p_value DESC), FALSE) AS flagged FROM r"""


SQL["differing_states"] = _differing_sql(BASE + f", g AS (SELECT state, TI AS n, TCD AS k FROM (SELECT state, {REACHED} FROM pv GROUP BY state))", "state")
SQL["differing_ages"] = _differing_sql(BASE + f""", g AS (SELECT state, Age_group, TI AS n, TSD AS k FROM
  (SELECT state, Age_group, {REACHED} FROM (SELECT *, {AGE_GROUP} AS Age_group FROM pv) GROUP BY state, Age_group))""", "state, Age_group")


def _rules_sql() -> str:
    from itertools import combinations

    columns = ("client_id", "app", "state", "age", "stage", "complete_process")
    parts = []
    for size in (1, 2):
        for rhs in columns:
            for lhs in combinations([c for c in columns if c != rhs], size):
                x = ", ".join(lhs)
                parts.append(f"SELECT {list(lhs)} AS x, '{','.join(lhs)}' AS lhs, '{rhs}' AS rhs, CAST(SUM(n - m) AS BIGINT) AS violations FROM ("
                             f"SELECT SUM(c) AS n, MAX(c) AS m FROM (SELECT {x}, {rhs}, COUNT(*) AS c FROM joined GROUP BY {x}, {rhs}) GROUP BY {x})")
    return BASE + f""", v AS ({" UNION ALL ".join(parts)}), total AS (SELECT COUNT(*) AS n FROM joined),
good AS (SELECT v.*, violations / CAST(n AS DOUBLE) AS error FROM v, total WHERE violations <= CAST(0.02 AS DOUBLE) * n)
SELECT lhs, rhs, violations, error FROM good a
WHERE NOT EXISTS (SELECT 1 FROM good b WHERE b.rhs = a.rhs AND len(b.x) < len(a.x) AND list_has_all(a.x, b.x))"""


SQL["attribute_rules"] = _rules_sql()
SQL["moved_clients"] = HISTORY + """SELECT client_id, COUNT(*) AS "values", CAST(SUM(n) AS BIGINT) AS rows, CAST(SUM(n) - MAX(n) AS BIGINT) AS violations
FROM (SELECT client_id, state, COUNT(*) AS n FROM changes GROUP BY client_id, state) GROUP BY client_id HAVING COUNT(*) > 1"""
