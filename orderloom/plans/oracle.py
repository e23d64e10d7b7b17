"""The queries of the catalog in SQL over the plain tables, written without the library's own rules."""

from __future__ import annotations

from orderloom.plans.inputs import byte_escaped
from orderloom.schema import LEDGER_COLUMNS

ORACLE: dict[str, str] = {}

_LINES = """lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS line_no,
    'P' || lpad(l_partkey::VARCHAR, 6, '0') AS product_code, 'Part ' || l_partkey AS product_name
  FROM lineitem), items AS (
  SELECT *, CASE WHEN l_partkey % 7 = 0 THEN '' WHEN l_partkey % 11 = 0 THEN NULL ELSE 'IM' || line_no END AS imei
  FROM lines)"""
_ORD = """ord AS (
  SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 'BL/' || c_mktsegment || '/' || o_orderkey
    ELSE 'DH-' || o_orderkey END AS order_no,
    o_orderkey % 97 = 0 AS corrupt, o_orderkey % 97 <> 0 AND o_orderkey % 101 <> 0 AS good
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

_MISSING = "'Mã hàng ' || {} || ' không tồn tại trong hệ thống'"


def _text(kind: str, c1: str, c2: str, doc: str) -> str:
    one, two = _MISSING.format(c1), _MISSING.format(c2)
    head, tail = byte_escaped("Mã hàng "), byte_escaped(" không tồn tại trong hệ thống")
    return (f"CASE {kind} WHEN 1 THEN {one} WHEN 2 THEN {one} || '; ' || {two} "
            f"WHEN 3 THEN 'Chứng từ ' || {doc} || ' đã nhập.' WHEN 4 THEN 'Lỗi khác' WHEN 7 THEN '7' "
            f"WHEN 9 THEN '{head}' || {c1} || '{tail}' END")


_ATT = f"""ev AS (
  SELECT event_id AS attempt_no, 'T' || user_id AS task_id, ts AS attempt_at,
    CASE event_type WHEN 'purchase' THEN 200 WHEN 'signup' THEN 429 WHEN 'view' THEN 404 WHEN 'click' THEN 400 ELSE 500 END AS status_code,
    event_id % 10 AS kind, 'P' || lpad((event_id % 2000)::VARCHAR, 6, '0') AS c1,
    'P' || lpad((event_id * 7 % 2000)::VARCHAR, 6, '0') AS c2 FROM events), att0 AS (
  SELECT *, {_text('kind', 'c1', 'c2', "attempt_no")} AS msg, kind IN (5, 6) AS lost,
    status_code NOT IN (200, 429) AS bad FROM ev), att AS (
  SELECT *, CASE WHEN kind = 9 THEN {_MISSING.format('c1')} ELSE msg END AS clean, lost OR bad AS failed,
    CASE kind WHEN 0 THEN '{{}}' WHEN 7 THEN '{{"errorCode":7}}' WHEN 8 THEN '{{"errorCode":null}}'
      ELSE '{{"errorCode":"' || replace(msg, '\\', '\\\\') || '"}}' END AS doc,
    CASE WHEN lost THEN 0 ELSE status_code END AS status,
    CASE WHEN lost THEN 'reply is not a JSON object' WHEN bad THEN 'HTTP ' || status_code || ' error' END AS err
  FROM att0)"""
_CODES = r"regexp_extract_all({}, 'Mã hàng\s+(\S[\s\S]*?)\s+không tồn tại trong hệ thống', 1)"
_SORTED_CODES = "coalesce(array_to_string(list_sort(list_distinct(" + _CODES + ")), ','), '')"
_DUP = r"regexp_matches({}, 'Chứng từ\s+.+?\s+đã nhập\.')"
_V2 = f"""v2 AS (
  SELECT *, failed AND NOT lost AND kind NOT IN (0, 7, 8) AS said FROM att), v3 AS (
  SELECT *, CASE WHEN said THEN clean END AS error_text, said AND {_DUP.format('clean')} AS dup,
    CASE WHEN said AND NOT {_DUP.format('clean')} THEN {_SORTED_CODES.format('clean')} ELSE '' END AS missing_codes FROM v2),
  v4 AS (SELECT *, CASE WHEN NOT failed THEN 'completed' WHEN lost OR kind IN (0, 8) THEN 'completed_unconfirmed'
    WHEN kind = 7 THEN 'retry_malformed' WHEN dup THEN 'duplicate_success' WHEN missing_codes <> '' THEN 'retry_missing_code'
    WHEN status IN (400, 404) THEN 'terminal' ELSE 'retry_server' END AS outcome FROM v3)"""
_SEEN = f"""seen AS (
  SELECT unnest({_CODES.format('msg')}) AS product_code, task_id AS order_id, attempt_at, attempt_no
  FROM att WHERE bad AND NOT lost AND kind NOT IN (0, 7, 8))"""


def add(name: str, *ctes: str, final: str, recursive: bool = False) -> None:
    head = ("WITH RECURSIVE " if recursive else "WITH ") + ", ".join(ctes) + "\n" if ctes else ""
    ORACLE[name] = head + final


# --- sources, sinks, checks -------------------------------------------------------------------

add("parse_payloads", _ORD, _LINES, """agg AS (SELECT l_orderkey, count(*) AS n,
  max(CASE WHEN line_no = 1 THEN l_quantity::VARCHAR END) AS q FROM lines GROUP BY 1)""", final="""
  SELECT o_orderkey AS seq, corrupt, CASE WHEN NOT corrupt THEN 'test' END AS apikey,
    CASE WHEN NOT corrupt THEN 'CT' || o_orderkey END AS document_number,
    CASE WHEN NOT corrupt THEN c_name END AS customer_name,
    CASE WHEN NOT corrupt THEN coalesce(n, 0) END AS n_details,
    CASE WHEN NOT corrupt THEN q END AS first_quantity
  FROM ord LEFT JOIN agg ON o_orderkey = l_orderkey""")
add("read_string_table", final="""SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type,
  p_size::VARCHAR AS p_size, p_retailprice::VARCHAR AS p_retailprice FROM part""")
add("read_inferred_table", final="SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer")

_SIDES = """lt AS (SELECT CASE WHEN c_custkey % 31 <> 0 THEN c_custkey END AS ID, c_name, c_acctbal, c_mktsegment,
  c_nationkey FROM customer), rt AS (
  SELECT CASE WHEN c_custkey % 19 = 0 THEN c_custkey + 1000000 ELSE c_custkey END AS ID, c_name,
    CASE WHEN c_custkey % 17 = 0 THEN -c_acctbal ELSE c_acctbal END AS c_acctbal,
    CASE WHEN c_custkey % 23 <> 0 THEN c_mktsegment END AS c_mktsegment, 'copy ' || copy AS note
  FROM customer, (VALUES (1), (2)) AS copies(copy) WHERE c_custkey % 13 <> 0 AND (copy = 1 OR c_custkey % 29 = 0)),
  lk AS (SELECT ID::VARCHAR AS key, count(*) AS n FROM lt WHERE ID IS NOT NULL GROUP BY 1),
  rk AS (SELECT ID::VARCHAR AS key, count(*) AS n FROM rt WHERE ID IS NOT NULL GROUP BY 1),
  fj AS (SELECT coalesce(lk.key, rk.key) AS key, coalesce(lk.n, 0) AS left_count, coalesce(rk.n, 0) AS right_count
    FROM lk FULL JOIN rk ON lk.key = rk.key)"""
_DIFFS = "diffs AS (" + " UNION ALL ".join(f"""
  SELECT l.ID::VARCHAR AS "Key", '{c}' AS "Column", l.{c}::VARCHAR AS "left_Value", r.{c}::VARCHAR AS "right_Value"
  FROM lt l JOIN rt r ON l.ID = r.ID
  WHERE l.ID::VARCHAR IN (SELECT key FROM fj WHERE left_count = 1 AND right_count = 1)
    AND l.{c}::VARCHAR IS DISTINCT FROM r.{c}::VARCHAR""" for c in ("c_name", "c_acctbal", "c_mktsegment")) + ")"
_ONLY_LEFT = "SELECT * FROM lt WHERE ID IS NOT NULL AND ID::VARCHAR NOT IN (SELECT key FROM rk)"
_ONLY_RIGHT = "SELECT * FROM rt WHERE ID IS NOT NULL AND ID::VARCHAR NOT IN (SELECT key FROM lk)"
add("write_diffs", _SIDES, _DIFFS, f"ol AS ({_ONLY_LEFT})", f"orr AS ({_ONLY_RIGHT})", final="""
  SELECT 'only_left' AS part, ID::VARCHAR AS key, c_name AS text FROM ol
  UNION ALL SELECT 'only_right', ID::VARCHAR, c_name FROM orr
  UNION ALL SELECT 'value_differences', "Key", "Column" FROM diffs""")

_MAP = """pm AS (SELECT p_partkey AS row_no, 'P' || lpad(p_partkey::VARCHAR, 6, '0') AS old_code, p_name AS old_name,
    CASE WHEN p_partkey % 50 = 0 THEN '' ELSE 'N' || lpad((p_partkey * 37 % 1000003)::VARCHAR, 7, '0') END AS new_code,
    p_name || ' v2' AS new_name FROM part), raw AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey,
    'N' || lpad((l_partkey * 37 % 1000003)::VARCHAR, 7, '0') AS nc FROM lineitem), dt AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, CASE l_partkey % 4
    WHEN 0 THEN 'P' || lpad(l_partkey::VARCHAR, 6, '0') WHEN 1 THEN nc
    WHEN 2 THEN nc[1:7] || ((nc[8]::INT + 1) % 10) ELSE CASE WHEN l_suppkey % 2 = 0 THEN 'X' || nc[2:8]
      ELSE '??' || l_linenumber END END AS code, 'Part ' || l_partkey AS name FROM raw),
  fwd AS (SELECT old_code, arg_max(new_code, row_no) AS to_code, arg_max(new_name, row_no) AS to_name FROM pm GROUP BY 1),
  rev AS (SELECT new_code, arg_max(old_code, row_no) AS back FROM pm WHERE new_code <> '' GROUP BY 1),
  rv AS (SELECT new_code, to_code AS r_code, to_name AS r_name FROM rev JOIN fwd ON back = old_code),
  step2 AS (SELECT code, n, to_code, to_name, r_code, r_name, coalesce(to_code, '') = '' AND r_code IS NOT NULL AND code <> '' AS rhit
    FROM (SELECT code, count(*) AS n FROM dt GROUP BY 1) LEFT JOIN fwd ON code = old_code LEFT JOIN rv ON code = rv.new_code),
  step3 AS (SELECT *, CASE WHEN rhit THEN r_code ELSE to_code END AS m_code, CASE WHEN rhit THEN r_name ELSE to_name END AS m_name FROM step2)"""


def _fuzzy(codes: str) -> str:
    return f"""tg AS (SELECT new_code, min(row_no) AS row_no, arg_min(old_code, row_no) AS old_code FROM pm WHERE new_code <> '' GROUP BY 1),
  cd AS ({codes}), pf AS (SELECT DISTINCT new_code[1:k] AS prefix FROM tg, (VALUES (1), (2), (3)) AS v(k)),
  ck AS (SELECT code, code[1:3] IN (SELECT prefix FROM pf) AS has FROM cd),
  pairs AS (SELECT code, old_code, row_no, levenshtein(code, new_code) AS d, greatest(length(code), length(new_code)) AS m
    FROM ck JOIN tg ON NOT has OR starts_with(new_code, code[1:3])),
  best AS (SELECT code, old_code AS best_old, 1 - d::DOUBLE / m AS similarity FROM pairs WHERE 10 * (m - d) >= 7 * m
    QUALIFY row_number() OVER (PARTITION BY code ORDER BY 1 - d::DOUBLE / m DESC, row_no) = 1),
  bm AS (SELECT * FROM best WHERE best_old <> '')"""


_EXACT = """SELECT l_orderkey, l_linenumber, l_extendedprice, code AS "Mã hàng", name AS "Tên hàng",
  to_code AS mapped_code, to_name AS mapped_name FROM dt LEFT JOIN fwd ON code = old_code"""
add("write_mapped", _MAP, final=_EXACT)
add("ledger_violations", _ORD, _LINES, """rl AS (
  SELECT CASE WHEN o_orderkey % 101 <> 0 THEN order_no END AS order_id, product_code, imei,
    CASE o_orderkey % 3 WHEN 0 THEN 'online' WHEN 1 THEN 'offline' ELSE 'store' END AS source_type,
    CASE l_returnflag WHEN 'A' THEN 'needs_retry' WHEN 'N' THEN 'completed' ELSE 'cancelled' END AS status
  FROM items JOIN ord ON l_orderkey = o_orderkey)""", final="""
  SELECT rule, order_id, product_code, imei, count(*) AS n FROM (
    SELECT 'order_id_missing' AS rule, * FROM rl WHERE order_id IS NULL
    UNION ALL SELECT 'source_type_unknown', * FROM rl WHERE source_type = 'store'
    UNION ALL SELECT 'status_unknown', * FROM rl WHERE status = 'cancelled') GROUP BY 1, 2, 3, 4
  UNION ALL SELECT 'line_repeated', order_id, product_code, imei, count(*) FROM rl
  WHERE order_id IS NOT NULL AND product_code IS NOT NULL AND imei IS NOT NULL GROUP BY 2, 3, 4 HAVING count(*) > 1""")
_V2_CODES = "codes AS (SELECT DISTINCT unnest(string_split(missing_codes, ',')) AS product_code FROM v4 WHERE missing_codes <> '')"
add("missing_code_report", _ATT, _V2, _V2_CODES, final="""
  SELECT product_code AS "Product Code", 'Not Found' AS "Status", '1998-06-01 00:00:00' AS "Detected At",
    'Verify & Add to System' AS "Action Required" FROM codes""")

# --- projections ------------------------------------------------------------------------------

add("task_ids", _ORD, final="""SELECT 'B' || strftime(o_orderdate, '%Y-%m-%d') AS batch_id, o_orderkey AS seq,
  CASE WHEN good THEN order_no END AS task_id FROM ord""")
add("rejected_requests", _ORD, final="""SELECT 'B' || strftime(o_orderdate, '%Y-%m-%d') AS batch_id, o_orderkey AS seq,
  corrupt FROM ord WHERE NOT good""")
for _name in ("explode_details", "stream_requests"):
    add(_name, _ORD, _LINES, final="""SELECT order_no AS task_id, line_no - 1 AS pos, c_name AS customer_name,
  product_code, imei, l_quantity AS quantity FROM items JOIN ord ON l_orderkey = o_orderkey WHERE good""")
add("first_detail", _ORD, _LINES, final="""SELECT order_no AS task_id, CASE WHEN line_no = 1 THEN c_name END AS customer_name,
  product_code, imei, l_quantity AS quantity FROM ord LEFT JOIN (SELECT * FROM items WHERE line_no = 1) f ON l_orderkey = o_orderkey WHERE good""")

_ORDER_TEXT = _text("o_orderkey % 5", "'P' || lpad((o_orderkey % 2000)::VARCHAR, 6, '0')",
                    "'P' || lpad((o_orderkey * 7 % 2000)::VARCHAR, 6, '0')", "o_orderkey")
_STATUS = "CASE o_orderstatus WHEN 'P' THEN 200 WHEN 'O' THEN 404 ELSE 503 END"


def _ledger_values(error: str, first: str, last: str, line: str = "", order: str = "") -> dict[str, str]:
    return {
        "order_id": "order_no", "customer_name": "c_name", "phone_number": "'0' || lpad(c_custkey::VARCHAR, 9, '0')",
        "document_type": "o_orderstatus", "document_number": "'CT' || o_orderkey", "department_code": "o_orderpriority",
        "order_date": "strftime(o_orderdate, '%Y-%m-%d')", "province": "'N' || c_nationkey", "district": "c_mktsegment",
        "ward": "NULL::VARCHAR", "address": "NULL::VARCHAR", "product_code": "product_code", "product_name": "product_name",
        "imei": "imei", "quantity": "l_quantity", "revenue": "l_extendedprice::DECIMAL(15,2)::DOUBLE",
        "source_type": "CASE WHEN contains(order_no, '/') THEN 'offline' ELSE 'online' END", "status": "'needs_retry'",
        "error_code": error, "first_failure_time": first, "updated_at": last,
    }


def _cols(values: dict[str, str]) -> str:
    return ", ".join(f"{v} AS {c}" for c, v in values.items())


_FLAT = _ledger_values(f"coalesce({_ORDER_TEXT}, 'HTTP ' || {_STATUS} || ' error')",
                       "o_orderdate + INTERVAL 1 DAY", "o_orderdate + INTERVAL 1 DAY")
_ALL = f"flat AS (SELECT {_cols(_FLAT)}, line_no - 1 AS pos FROM items JOIN ord ON l_orderkey = o_orderkey WHERE good)"
_FAIL = f"""fl AS (SELECT {_cols(_FLAT)}, line_no - 1 AS pos FROM items JOIN ord ON l_orderkey = o_orderkey
  WHERE good AND o_orderstatus <> 'P'), fd AS (SELECT * FROM fl QUALIFY imei IS NULL OR
  row_number() OVER (PARTITION BY order_id, product_code, imei ORDER BY pos DESC) = 1)"""
_BASE0 = {
    **{c: "NULL::VARCHAR" for c in LEDGER_COLUMNS}, "order_id": "order_no", "customer_name": "c_name",
    "product_code": "product_code", "product_name": "product_name", "imei": "imei", "quantity": "0.0::DOUBLE",
    "revenue": "0.0::DOUBLE", "source_type": "'online'",
    "status": "CASE l_linestatus WHEN 'F' THEN 'needs_retry' ELSE 'pending' END", "error_code": "'old'",
    "first_failure_time": "l_shipdate", "updated_at": "CASE WHEN l_tax > 0 THEN l_shipdate END",
}
_LEDGER = f"led AS (SELECT {_cols(_BASE0)} FROM items JOIN ord ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')"
_UNIQUE = """ul AS (SELECT * FROM led QUALIFY imei IS NULL OR row_number() OVER (PARTITION BY order_id, product_code, imei
  ORDER BY first_failure_time DESC, status DESC, updated_at DESC NULLS LAST) = 1)"""
_SAME = "{0}.order_id = {1}.order_id AND {0}.product_code = {1}.product_code AND {0}.imei = {1}.imei"


def _shown(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return ", ".join(f"{p}{c}::VARCHAR AS {c}" if c in ("first_failure_time", "updated_at") else f"{p}{c} AS {c}"
                     for c in LEDGER_COLUMNS)


add("flatten_order_lines", _ORD, _LINES, _ALL, final=f"SELECT {_shown()} FROM flat")
add("source_type_by_slash", _ORD, final="""SELECT o_orderkey AS seq, CASE WHEN good AND contains(order_no, '/')
  THEN 'offline' ELSE 'online' END AS source_type FROM ord""")
add("source_type_declared", _ORD, final="""SELECT o_orderkey AS seq,
  CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 3 = 1 THEN 'offline' ELSE 'online' END AS checked,
  CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 THEN 'online' WHEN o_orderkey % 3 = 1 THEN 'offline' ELSE 'store' END AS as_declared
  FROM ord WHERE NOT corrupt""")
add("error_code_or_error", _ATT, final="""SELECT attempt_no,
  CASE WHEN lost OR kind = 0 THEN err WHEN kind = 8 THEN NULL ELSE msg END AS error_code FROM att""")
add("column_profile", _SIDES, final="""
  SELECT 'shape' AS kind, 'left' AS name, count(*) AS n_rows, 5::BIGINT AS n_cols FROM lt
  UNION ALL SELECT 'shape', 'right', count(*), 5 FROM rt
  UNION ALL SELECT k, n, NULL, NULL FROM (VALUES ('shared', 'ID'), ('shared', 'c_name'), ('shared', 'c_acctbal'),
    ('shared', 'c_mktsegment'), ('left_only', 'c_nationkey'), ('right_only', 'note')) AS v(k, n)""")
add("summary", _SIDES, final="""SELECT (SELECT count(*) FROM lt) AS left_rows, 5::BIGINT AS left_cols,
  (SELECT count(*) FROM rt) AS right_rows, 5::BIGINT AS right_cols, 2::BIGINT AS column_differences,
  (SELECT count(*) FROM fj WHERE left_count = 0 OR right_count = 0) AS key_differences""")

# --- scalars ----------------------------------------------------------------------------------

add("repair_escapes", _ATT, final="SELECT attempt_no, CASE WHEN NOT lost THEN clean END AS text FROM att")
add("extract_missing_codes", _ATT, final=f"""SELECT attempt_no,
  CASE WHEN msg IS NOT NULL THEN {_SORTED_CODES.format('msg')} END AS codes FROM att""")
add("is_duplicate_document", _ATT, final=f"SELECT attempt_no, {_DUP.format('msg')} AS duplicate FROM att")
add("normalize_header", final="""SELECT p_partkey, 'mahanggoc' || regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g')
  || 'donvi' || regexp_replace(lower(p_type), '[^a-z0-9]', '', 'g') AS header FROM part""")
_PAIRS = "pr AS (SELECT code, new_code FROM (SELECT DISTINCT l_partkey, code FROM dt) JOIN pm ON l_partkey = row_no)"
add("edit_distance", _MAP, _PAIRS, final="SELECT code, new_code, levenshtein(code, new_code) AS distance FROM pr")
add("similarity", _MAP, _PAIRS, final="""SELECT code, new_code,
  1 - levenshtein(code, new_code)::DOUBLE / greatest(length(code), length(new_code)) AS similarity FROM pr""")

_DEC = """dec AS (SELECT 'T' || user_id AS task_id, event_id AS attempt_no, ts AS attempt_at,
  event_type IN ('purchase', 'signup') AS success FROM events), seg AS (
  SELECT *, count(CASE WHEN success THEN 1 END) OVER (PARTITION BY task_id ORDER BY attempt_at, attempt_no) AS s FROM dec),
  cnt AS (SELECT *, count(CASE WHEN NOT success THEN 1 END) OVER (PARTITION BY task_id, s ORDER BY attempt_at, attempt_no) AS retry_count FROM seg)"""
_EXP = "CASE WHEN retry_count >= 6 THEN 300 ELSE least(300, (5 * pow(2, retry_count))::BIGINT) END"
add("backoff_seconds", _DEC, final=f"""SELECT attempt_no, retry_count, {_EXP}::BIGINT AS exponential, 300::BIGINT AS "constant"
  FROM cnt WHERE NOT success""")
add("retry_schedule", "firsts AS (SELECT 'T' || user_id AS task_id, min(ts) AS f FROM events WHERE event_type NOT IN ('purchase', 'signup') GROUP BY 1)",
    "gaps AS (SELECT n AS attempt, CASE WHEN n = 1 THEN 0 ELSE least(1440, 15 * pow(2, least(n - 2, 10))::BIGINT) END AS gap FROM range(1, 101) AS r(n))",
    "offs AS (SELECT attempt, sum(gap) OVER (ORDER BY attempt)::BIGINT AS off FROM gaps)", final="""
  SELECT task_id, f::VARCHAR AS first_failure_time, off AS offset_minutes, attempt::BIGINT AS attempt,
    (f + to_minutes(off))::VARCHAR AS attempt_at, CASE WHEN attempt = 100 THEN 'paused' ELSE 'retry' END AS next_state
  FROM firsts, offs""")
_NOW = "TIMESTAMP '1998-06-01 00:00:00'"
_AGE = f"(epoch_us({_NOW}) - epoch_us(min(first_failure_time)))::DOUBLE / 86400000000.0::DOUBLE"
add("retry_expired", _ORD, _LINES, _LEDGER, final=f"""SELECT order_id, {_AGE} AS age_days, {_AGE} >= 2 AS expired
  FROM led WHERE status = 'needs_retry' GROUP BY 1""")

# --- replies ----------------------------------------------------------------------------------

add("classify_http", _ATT, final="SELECT attempt_no, status_code::BIGINT AS status_code, bad AS failed FROM att")
add("normalize_reply", _ATT, final="""SELECT attempt_no, status::BIGINT AS status,
  CASE WHEN lost THEN '{}' ELSE doc END AS reply, err AS error FROM att""")
add("outcome_v2", _ATT, _V2, final="""SELECT attempt_no, status::BIGINT AS status, outcome,
  outcome IN ('completed', 'duplicate_success') AS success, starts_with(outcome, 'retry_') AS retry,
  CASE WHEN dup THEN 'Duplicate document detected: ' || error_text ELSE err END AS error, error_text, missing_codes FROM v4""")
_FIRST_SEEN = f"""CASE WHEN NOT failed OR lost OR kind IN (0, 7, 8) THEN '' ELSE
  CASE WHEN length(codes) = 2 AND codes[1] <> codes[2] THEN codes[1] || ',' || codes[2] ELSE coalesce(codes[1], '') END END"""
add("outcome_simple", _ATT, f"ac AS (SELECT *, {_CODES.format('msg')} AS codes FROM att)", final=f"""
  SELECT attempt_no, status::BIGINT AS status, CASE WHEN failed THEN 'needs_retry' ELSE 'success' END AS outcome,
    NOT failed AS success, err AS error, CASE WHEN failed AND NOT lost THEN clean END AS error_text,
    {_FIRST_SEEN} AS missing_codes FROM ac""")

# --- joins ------------------------------------------------------------------------------------

add("map_exact", _MAP, final=_EXACT)
add("map_reverse", _MAP, final="""SELECT l_orderkey, l_linenumber, l_extendedprice, dt.code AS "Mã hàng", name AS "Tên hàng",
  m_code AS mapped_code, m_name AS mapped_name, rhit AS reverse_hit FROM dt JOIN step3 ON dt.code = step3.code""")
add("map_fuzzy", _MAP, _fuzzy("SELECT DISTINCT code FROM dt WHERE code <> ''"), final="SELECT code, best_old, similarity FROM bm")
_OPEN = _fuzzy("SELECT code FROM step3 WHERE coalesce(m_code, '') = '' AND code <> ''")
_FULL = """fin AS (SELECT step3.code, n, to_code IS NOT NULL AS e, rhit AS r, best_old IS NOT NULL AS f,
  CASE WHEN best_old IS NOT NULL THEN fwd.to_code ELSE m_code END AS c,
  CASE WHEN best_old IS NOT NULL THEN fwd.to_name ELSE m_name END AS nm
  FROM step3 LEFT JOIN bm ON step3.code = bm.code LEFT JOIN fwd ON best_old = fwd.old_code)""".replace("to_code IS NOT NULL AS e", "step3.to_code IS NOT NULL AS e")
add("apply_mapping", _MAP, _OPEN, _FULL, final="""SELECT l_orderkey, l_linenumber, l_extendedprice,
  CASE WHEN coalesce(c, '') <> '' THEN c ELSE dt.code END AS "Mã hàng",
  CASE WHEN coalesce(nm, '') <> '' THEN nm ELSE name END AS "Tên hàng" FROM dt JOIN fin ON dt.code = fin.code""")
add("mapping_stats", _MAP, _OPEN, _FULL, "s AS (SELECT sum(n)::BIGINT AS t, coalesce(sum(n) FILTER (e), 0)::BIGINT AS x, coalesce(sum(n) FILTER (r), 0)::BIGINT AS y, coalesce(sum(n) FILTER (f), 0)::BIGINT AS z FROM fin)",
    final="""SELECT t AS total_count, x AS exact_matched_count, y AS reverse_matched_count, z AS fuzzy_matched_count,
  x + y + z AS matched_count FROM s""")
add("keys_only_left", _SIDES, final="SELECT ID, c_name, c_acctbal, c_mktsegment, c_nationkey::BIGINT AS c_nationkey FROM (" + _ONLY_LEFT + ")")
add("keys_only_right", _SIDES, final=_ONLY_RIGHT)
add("common_keys", _SIDES, final="SELECT key FROM fj WHERE left_count > 0 AND right_count > 0")
add("value_differences", _SIDES, _DIFFS, final="SELECT * FROM diffs")
add("frequency_differences", _SIDES, final="""SELECT key, left_count, right_count, left_count - right_count AS difference
  FROM fj WHERE left_count <> right_count""")
add("existing_lines", _ORD, _LINES, _FAIL, _LEDGER, final=f"""SELECT order_id, count(*) AS n_lines,
  count(CASE WHEN EXISTS (SELECT 1 FROM led WHERE {_SAME.format('led', 'fl')}) THEN 1 END) AS n_existing FROM fl GROUP BY 1""")

# --- aggregations -----------------------------------------------------------------------------

add("value_counts", _SIDES, final="SELECT key, n FROM rk")
add("distinct_key_count", _SIDES, final="SELECT count(*) AS n_keys FROM rk")
add("distinct_keys_by_day", final="""SELECT strftime(ts, '%Y-%m-%d') AS day, count(DISTINCT user_id) AS n_exact, true AS within_error
  FROM events GROUP BY 1""")
add("null_profile", _SIDES, final="""SELECT count(CASE WHEN ID IS NULL AND c_name IS NULL AND c_acctbal IS NULL AND
  c_mktsegment IS NULL AND c_nationkey IS NULL THEN 1 END) AS empty_rows, count(*) - count(ID) AS null_keys FROM lt""")
_STATS = """SELECT strftime(attempt_at, '%Y-%m-%d') AS stat_date, count(CASE WHEN success THEN 1 END) AS completed_tasks,
  count(CASE WHEN NOT success THEN 1 END) AS failed_tasks, max(attempt_at)::VARCHAR AS last_updated FROM dec GROUP BY 1"""
add("daily_stats", _DEC, final=_STATS)
add("distinct_codes", _ATT, _V2, _V2_CODES, final="SELECT product_code FROM codes")
add("batch_summary", _ORD, """ids AS (SELECT 'B' || strftime(o_orderdate, '%Y-%m-%d') AS batch_id, o_orderkey AS seq, order_no,
  row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) - 1 AS i,
  count(*) OVER (PARTITION BY o_orderdate) AS n FROM ord WHERE good)""", final="""
  SELECT batch_id, i // 1000 AS page, max(n) AS n_tasks, string_agg(order_no, ',' ORDER BY seq) AS task_ids FROM ids GROUP BY 1, 2""")
_EXPIRED = "(status = 'needs_retry' AND coalesce(updated_at < {} - INTERVAL 2 DAY, false))"
add("expired_count", _ORD, _LINES, _LEDGER, final=f"SELECT count(*) AS n_expired FROM led WHERE {_EXPIRED.format(_NOW)}")

# --- windows, duplicates, order, sets ---------------------------------------------------------

add("last_wins", _MAP, final="""SELECT old_name, old_code, new_code FROM pm
  QUALIFY row_number() OVER (PARTITION BY old_name ORDER BY row_no DESC) = 1""")
add("replace_duplicates", _ORD, _LINES, _FAIL, final=f"SELECT {_shown()}, pos FROM fd")
_PICK = """SELECT product_code, attempt_at::VARCHAR AS detected_at, order_id FROM {}
  QUALIFY row_number() OVER (PARTITION BY product_code ORDER BY attempt_at {}, attempt_no {}, order_id {}) = 1"""
add("code_registry", _ATT, _SEEN, """clr AS (SELECT 'P' || lpad((attempt_no * 13 % 2000)::VARCHAR, 6, '0') AS product_code,
  max(attempt_at) AS cleared FROM att WHERE NOT bad GROUP BY 1)""",
    "live AS (SELECT seen.* FROM seen LEFT JOIN clr USING (product_code) WHERE cleared IS NULL OR attempt_at > cleared)",
    final=_PICK.format("live", "", "", ""))
add("code_registry_last", _ATT, _SEEN, final=_PICK.format("seen", "DESC", "DESC", "DESC"))
add("retry_count", _DEC, final="SELECT task_id, attempt_no, success, retry_count FROM cnt")
add("task_status", _DEC, _ATT, final="""SELECT cnt.task_id, 'needs_retry' AS detail, retry_count, cnt.attempt_at::VARCHAR AS last_attempt_at,
    att.status_code::BIGINT AS status_code, CASE kind WHEN 5 THEN '[1]' WHEN 6 THEN 'gateway timeout' ELSE doc END AS body, NULL::VARCHAR AS error
  FROM cnt JOIN att USING (attempt_no)
  WHERE NOT success QUALIFY row_number() OVER (PARTITION BY cnt.task_id ORDER BY cnt.attempt_at DESC, attempt_no DESC) = 1
    AND attempt_no = (SELECT arg_max(c.attempt_no, (c.attempt_at, c.attempt_no)) FROM cnt c WHERE c.task_id = cnt.task_id)""")


def _throttle(partition: str, gap: int) -> str:
    over = f"OVER ({partition} ORDER BY ts, event_id)"
    return f"""SELECT event_id AS seq, 'T' || user_id AS task_id, ts::VARCHAR AS submitted_at,
    make_timestamp(({gap} * (n + 1) + max(a - {gap} * n) {over})::BIGINT)::VARCHAR AS dispatch_at
    FROM (SELECT *, epoch_us(ts) AS a, row_number() {over} - 1 AS n FROM events)"""


add("throttle_schedule", final=_throttle("PARTITION BY user_id", 6 * 3600 * 1_000_000))
add("throttle_schedule_global", final=_throttle("", 300 * 1_000_000))
_KEPT = """kept AS (SELECT user_id, min(ts) AS ts FROM events GROUP BY 1
  UNION ALL SELECT k.user_id, min(e.ts) FROM kept k JOIN events e ON e.user_id = k.user_id AND e.ts >= k.ts + INTERVAL 2 DAY GROUP BY 1)"""
_IDEM = "SELECT min(event_id) AS seq, 'T' || user_id AS task_id, ts::VARCHAR AS submitted_at FROM events JOIN kept USING (user_id, ts) GROUP BY user_id, ts"
add("idempotent_requests", _KEPT, recursive=True, final=_IDEM)
add("frequency_top", _SIDES, final="""SELECT key, left_count, right_count, left_count - right_count AS difference
  FROM fj WHERE left_count <> right_count ORDER BY abs(left_count - right_count) DESC, key LIMIT 20""")
add("sample_keys", _SIDES, final="""SELECT * FROM (SELECT 'left' AS side, key FROM fj WHERE right_count = 0 ORDER BY key LIMIT 5)
  UNION ALL SELECT * FROM (SELECT 'right', key FROM fj WHERE left_count = 0 ORDER BY key LIMIT 5)""")
add("preview", _SIDES, final="""
  (SELECT 'left' AS side, ID, c_name, c_acctbal, c_mktsegment, c_nationkey::BIGINT AS c_nationkey, NULL::VARCHAR AS note
   FROM lt ORDER BY ID NULLS LAST, c_name LIMIT 3)
  UNION ALL (SELECT 'right', ID, c_name, c_acctbal, c_mktsegment, NULL, note FROM rt ORDER BY ID NULLS LAST, c_name LIMIT 3)""")
add("key_set_ops", _SIDES, final="""SELECT 'union' AS op, key FROM fj
  UNION ALL SELECT 'left_minus_right', key FROM fj WHERE right_count = 0
  UNION ALL SELECT 'right_minus_left', key FROM fj WHERE left_count = 0
  UNION ALL SELECT 'intersect', key FROM fj WHERE left_count > 0 AND right_count > 0""")

# --- table changes ----------------------------------------------------------------------------

_KEEP = ("order_id", "product_code", "imei", "first_failure_time")


def _updated(base: str, new: str) -> str:
    return ", ".join(f"{base}.{c} AS {c}" if c in _KEEP else
                     f"CASE WHEN {new}.order_id IS NOT NULL THEN {new}.{c} ELSE {base}.{c} END AS {c}" for c in LEDGER_COLUMNS)


_COLS = ", ".join(LEDGER_COLUMNS)
add("insert_lines", _ORD, _LINES, _FAIL, _LEDGER, _UNIQUE, f"""res AS (
  SELECT {_COLS} FROM ul WHERE NOT EXISTS (SELECT 1 FROM fd WHERE {_SAME.format('ul', 'fd')}) UNION ALL SELECT {_COLS} FROM fd)""",
    final=f"SELECT {_shown()} FROM res")
add("update_lines", _ORD, _LINES, _FAIL, _LEDGER, _UNIQUE,
    f"res AS (SELECT {_updated('ul', 'fd')} FROM ul LEFT JOIN fd ON {_SAME.format('ul', 'fd')})", final=f"SELECT {_shown()} FROM res")
_HIT = f"hit AS (SELECT DISTINCT fl.order_id FROM fl JOIN ul ON {_SAME.format('fl', 'ul')})"
add("upsert_order", _ORD, _LINES, _FAIL, _LEDGER, _UNIQUE, _HIT,
    f"""res AS (SELECT {_updated('ul', 'fd')} FROM ul LEFT JOIN fd ON {_SAME.format('ul', 'fd')}
  UNION ALL SELECT {_COLS} FROM fd WHERE order_id NOT IN (SELECT order_id FROM hit))""", final=f"SELECT {_shown()} FROM res")
add("delete_delivered", _ORD, _LINES, _LEDGER, final=f"""SELECT {_shown()} FROM led
  WHERE order_id NOT IN (SELECT order_no FROM ord WHERE o_orderstatus = 'P')""")
add("registry_clear", _ORD, _LINES, _ATT, _SEEN, "reg AS (SELECT * FROM (" + _PICK.format("seen", "", "", "") + "))", final="""
  SELECT product_code, detected_at, order_id FROM reg WHERE product_code NOT IN (
    SELECT product_code FROM items JOIN ord ON l_orderkey = o_orderkey WHERE line_no = 1 AND good AND o_orderstatus = 'P')""")
add("cleanup_expired", _ORD, _LINES, _LEDGER, final=f"SELECT {_shown()} FROM led WHERE NOT {_EXPIRED.format(_NOW)}")

# All attempts of an order carry one payload, so its log folds to first and last failure after the
# last delivery; only an order without any full key appends again on every failure.
_LOG_TEXT = _text("event_id % 5", "'P' || lpad((event_id % 2000)::VARCHAR, 6, '0')",
                  "'P' || lpad((event_id * 7 % 2000)::VARCHAR, 6, '0')", "event_id")
_LOG_STATUS = "CASE event_type WHEN 'view' THEN 404 WHEN 'click' THEN 400 ELSE 500 END"
_REPLAY = ["""log AS (SELECT *, event_type IN ('purchase', 'signup') AS ok, """
           f"coalesce({_LOG_TEXT}, 'HTTP ' || {_LOG_STATUS} || ' error') AS err"
           """ FROM events JOIN ord ON event_id // 3 = o_orderkey)""",
           "done AS (SELECT order_no, max((ts, event_id)) AS last_ok FROM log WHERE ok GROUP BY 1)",
           """live AS (SELECT log.* FROM log LEFT JOIN done USING (order_no)
             WHERE NOT ok AND good AND (last_ok IS NULL OR (ts, event_id) > last_ok))""",
           """span AS (SELECT order_no, arg_min(ts, (ts, event_id)) AS f_ts, arg_min(err, (ts, event_id)) AS f_err,
             arg_max(ts, (ts, event_id)) AS l_ts, arg_max(err, (ts, event_id)) AS l_err FROM live GROUP BY 1)""",
           "base AS (SELECT * FROM ul WHERE order_id NOT IN (SELECT order_no FROM done))",
           f"""pl AS (SELECT {_cols({**_ledger_values('l_err', 'f_ts', 'l_ts')})}, f_err, line_no - 1 AS pos
             FROM items JOIN ord ON l_orderkey = o_orderkey JOIN span USING (order_no))""",
           """pd AS (SELECT * FROM pl WHERE imei IS NOT NULL
             QUALIFY row_number() OVER (PARTITION BY order_id, product_code, imei ORDER BY pos DESC) = 1)""",
           f"hits AS (SELECT DISTINCT pd.order_id FROM pd JOIN base ON {_SAME.format('pd', 'base')})",
           "whole AS (SELECT DISTINCT order_id FROM pd)",
           f"""res AS (SELECT {_updated('base', 'pd')} FROM base LEFT JOIN pd ON {_SAME.format('base', 'pd')}
             UNION ALL SELECT {_COLS} FROM pd WHERE order_id NOT IN (SELECT order_id FROM hits)
             UNION ALL SELECT {', '.join('f_err' if c == 'error_code' else 'first_failure_time' if c == 'updated_at' else c
                                         for c in LEDGER_COLUMNS)} FROM pl
               WHERE imei IS NULL AND order_id IN (SELECT order_id FROM whole) AND order_id NOT IN (SELECT order_id FROM hits)
             UNION ALL SELECT {_cols(_ledger_values('live.err', 'live.ts', 'live.ts'))} FROM items
               JOIN live ON l_orderkey = live.o_orderkey WHERE order_no NOT IN (SELECT order_id FROM whole))"""]
for _name in ("ledger_replay", "stream_ledger"):
    add(_name, _ORD, _LINES, _LEDGER, _UNIQUE, *_REPLAY, final=f"SELECT {_shown()} FROM res")

# --- streams and digests ----------------------------------------------------------------------

add("stream_idempotent", _KEPT, recursive=True, final=_IDEM)
add("stream_retry_state", _DEC, final=f"""SELECT task_id, attempt_no, CASE WHEN success THEN 'cleared' ELSE 'needs_retry' END AS state,
  attempt_at::VARCHAR AS at, retry_count,
  CASE WHEN NOT success THEN (attempt_at + to_seconds({_EXP}))::VARCHAR END AS next_retry_at FROM cnt
  UNION ALL SELECT task_id, NULL, 'retry_due', due::VARCHAR, retry_count, NULL
  FROM (SELECT *, attempt_at + to_seconds({_EXP}) AS due, lead(attempt_at) OVER (PARTITION BY task_id ORDER BY attempt_at, attempt_no) AS answered FROM cnt)
  WHERE NOT success AND CASE WHEN answered IS NULL THEN due < (SELECT max(attempt_at) FROM cnt) ELSE due < answered END""")
_CE = """ce AS (SELECT 'K' || user_id % 5 AS key, ts, event_id, CASE WHEN event_id % 10 = 0 THEN [] WHEN event_id % 3 = 0
  THEN ['P' || lpad((event_id % 200)::VARCHAR, 6, '0'), 'P' || lpad((event_id * 3 % 200)::VARCHAR, 6, '0')]
  ELSE ['P' || lpad((event_id % 200)::VARCHAR, 6, '0')] END AS codes, ts::DATE AS d FROM events),
  opened AS (SELECT key, d, min(ts) AS t0 FROM ce WHERE len(codes) > 0 GROUP BY 1, 2)"""
add("daily_digest", _CE, "dd AS (SELECT DISTINCT key, d, t0, unnest(codes) AS code FROM ce JOIN opened USING (key, d) WHERE ts < t0 + INTERVAL 20 MINUTE)",
    final="""SELECT key, strftime(d, '%Y-%m-%d') AS digest_date, (t0 + INTERVAL 20 MINUTE)::VARCHAR AS send_at,
  count(*) OVER (PARTITION BY key, d) AS n_codes, code FROM dd""")
add("digest_event_status", _CE, """ph AS (SELECT ce.*, t0, ts >= t0 + INTERVAL 20 MINUTE AS late FROM ce JOIN opened USING (key, d) WHERE len(codes) > 0)""",
    """uc AS (SELECT key, d, late, ts, event_id, unnest(codes) AS code FROM ph)""",
    """fs AS (SELECT key, d, late, code, min((ts, event_id)) AS f FROM uc GROUP BY 1, 2, 3, 4)""",
    final="""SELECT key, ts::VARCHAR AS ts, event_id,
    CASE WHEN late THEN 'accumulated_no_email' WHEN ts = t0 THEN 'scheduled' ELSE 'accumulating' END AS status,
    (SELECT count(*) FROM fs WHERE fs.key = ph.key AND fs.d = ph.d AND fs.late = ph.late AND fs.f <= (ph.ts, ph.event_id)) AS accumulated_count FROM ph
  UNION ALL SELECT key, ts::VARCHAR, event_id, 'no_codes', 0 FROM ce WHERE len(codes) = 0""")
add("debounced_digest", _CE, """op AS (SELECT key, min(ts) AS ts FROM ce GROUP BY 1
  UNION ALL SELECT k.key, min(e.ts) FROM op k JOIN ce e ON e.key = k.key AND e.ts >= k.ts + INTERVAL 10 MINUTE GROUP BY 1)""",
    "ends AS (SELECT key, ts + INTERVAL 10 MINUTE AS end_ts FROM op)",
    "cs AS (SELECT key, ts, event_id, unnest(codes) AS code FROM ce)",
    "sent AS (SELECT cs.*, ends.end_ts FROM cs ASOF JOIN ends ON cs.key = ends.key AND cs.ts < ends.end_ts)",
    "fsn AS (SELECT key, end_ts, code, min((ts, event_id)) AS f, min(ts) AS first_ts FROM sent GROUP BY 1, 2, 3)", recursive=True, final="""
  SELECT key, end_ts::VARCHAR AS send_at, row_number() OVER (PARTITION BY key, end_ts ORDER BY f, code) AS position, code,
    first_ts::VARCHAR AS first_seen FROM fsn""")
# As streamed, a window may run past midnight: the new day's first code then drops what the old day held, the old timer sends
# what the new day has so far, and the new day's own timer sends what came after. A window that the input doesn't outlast stays open.
add("stream_daily_digest", _CE, """day AS (SELECT key, d, t0, t0 + INTERVAL 20 MINUTE AS own, lead(t0) OVER w AS next_t0,
    lag(t0 + INTERVAL 20 MINUTE) OVER w AS old FROM opened WINDOW w AS (PARTITION BY key ORDER BY d))""",
    """timer AS (SELECT key, d, t0 AS since, own AS send_at FROM day WHERE coalesce(old <= t0, true) AND coalesce(next_t0 >= own, true)
    UNION ALL SELECT key, d, t0, old FROM day WHERE old > t0 UNION ALL SELECT key, d, old, own FROM day WHERE old > t0)""",
    """held AS (SELECT DISTINCT key, d, send_at, unnest(codes) AS code FROM ce JOIN timer USING (key, d)
    WHERE ts >= since AND ts < send_at AND send_at < (SELECT max(ts) FROM ce WHERE len(codes) > 0))""",
    final="""SELECT key, strftime(d, '%Y-%m-%d') AS digest_date, send_at::VARCHAR AS send_at,
  count(*) OVER (PARTITION BY key, d, send_at) AS n_codes, code FROM held""")
add("stream_debounced_digest", """sd AS (SELECT 'K' || user_id % 5 AS key, ts, event_id,
    CASE WHEN event_id % 2 = 0 THEN 'P' || lpad((event_id % 200)::VARCHAR, 6, '0') END AS code FROM events)""",
    """op AS (SELECT key, min(ts) AS ts FROM sd WHERE code IS NULL GROUP BY 1
  UNION ALL SELECT k.key, min(e.ts) FROM op k JOIN sd e ON e.key = k.key AND e.code IS NULL AND e.ts >= k.ts + INTERVAL 10 MINUTE GROUP BY 1)""",
    "ends AS (SELECT key, ts + INTERVAL 10 MINUTE AS end_ts FROM op WHERE ts + INTERVAL 10 MINUTE < (SELECT max(ts) FROM events))",
    "sent AS (SELECT sd.*, ends.end_ts FROM sd ASOF JOIN ends ON sd.key = ends.key AND sd.ts < ends.end_ts WHERE code IS NOT NULL)",
    "fsn AS (SELECT key, end_ts, code, min((ts, event_id)) AS f FROM sent GROUP BY 1, 2, 3)", recursive=True, final="""
  SELECT key, end_ts::VARCHAR AS send_at, row_number() OVER (PARTITION BY key, end_ts ORDER BY f) AS position, code FROM fsn""")
add("stream_daily_stats", _DEC, final=_STATS)
for _name in ("stream_cleanup", "stream_retention"):
    add(_name, _ORD, _LINES, _LEDGER, final=f"""SELECT {_shown()} FROM led
  WHERE NOT {_EXPIRED.format("(SELECT max(o_orderdate) FROM orders)")}""")
