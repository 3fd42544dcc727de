"""DuckDB SQL for the expected results, assembled from named table expressions."""

from __future__ import annotations

import re

from orefold.registry.lake import AS_OF

LITERAL_AS_OF = f"DATE '{AS_OF.isoformat()}'"


def _int(expression: str) -> str:
    return f"CAST({expression} AS INTEGER)"


def _padded(number: str, width: int) -> str:
    return f"lpad(CAST({number} AS VARCHAR), greatest({width}, CAST(length(CAST({number} AS VARCHAR)) AS INTEGER)), '0')"


def _ymd(moment: str) -> str:
    return f"(year({moment}) * 10000 + month({moment}) * 100 + day({moment}))"


def label(code: str, pairs: dict[str, str], otherwise: str = "'n/a'") -> str:
    """Look ``code`` up in an inline map; ``otherwise`` when it is not there."""
    entries = ", ".join(f"'{k}': '{v}'" for k, v in pairs.items())
    return f"coalesce(MAP {{{entries}}}[{code}], {otherwise})"


def marital(text: str) -> str:
    return label(f"upper(trim({text}))", {"S": "Single", "M": "Married"})


def crm_gender(text: str) -> str:
    return label(f"upper(trim({text}))", {"F": "Female", "M": "Male"})


def erp_gender(text: str) -> str:
    return label(f"upper(trim({text}))", {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"})


def line(text: str) -> str:
    pairs = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
    return label(f"upper(trim({text}))", pairs)


def country(text: str) -> str:
    pairs = {"DE": "Germany", "US": "United States", "USA": "United States"}
    return label(f"trim({text})", pairs, f"nullif(trim({text}), ''), 'n/a'")


def day(key: str) -> str:
    text = f"CAST({key} AS VARCHAR)"
    return f"if(length({text}) = 8, CAST(try_strptime({text}, '%Y%m%d') AS DATE), NULL)"


def suspect(key: str) -> str:
    """Complement of a well-shaped key in the business range; NULL is not suspect."""
    return f"NOT ({key} BETWEEN 19000101 AND 20500101 AND length(CAST({key} AS VARCHAR)) = 8)"


PREFIXLESS = "regexp_replace(cid, '^NAS', '')"
PAST_BIRTH = f"if(bdate <= {LITERAL_AS_OF}, bdate, NULL)"
CAT_ID = "translate(left(prd_key, 5), '-', '_')"
PRD_NUM = "substr(prd_key, 7)"
GOOD_SALES = "if(sls_sales > 0 AND coalesce(sls_sales = sls_quantity * abs(sls_price), true), sls_sales, sls_quantity * abs(sls_price))"
GOOD_PRICE = f"if(sls_price > 0, sls_price, {_int('sls_sales // nullif(sls_quantity, 0)')})"
# NULL-safe form of "all three positive and amount = quantity * price", negated.
DISAGREE = "coalesce(least(sls_sales, sls_quantity, sls_price) <= 0, false) OR sls_sales IS NULL OR sls_quantity IS NULL OR sls_price IS NULL OR sls_sales <> sls_quantity * sls_price"
CUST_TIES = "cst_create_date DESC NULLS LAST, cst_key NULLS FIRST, cst_firstname NULLS FIRST, cst_lastname NULLS FIRST, cst_marital_status NULLS FIRST, cst_gndr NULLS FIRST"
NEXT_START = "lead(prd_start_dt) OVER (PARTITION BY prd_key ORDER BY prd_start_dt NULLS FIRST, prd_id NULLS FIRST)"
REBUILT_END = f"CAST({NEXT_START} AS DATE) - 1"

# Raw feeds: the formulas of orefold.sources.feeds once more, in DuckDB's words.
EXPRESSIONS = {
    "raw_cust": f"""
        SELECT if(c_custkey % 97 = 0, NULL, {_int('c_custkey')}) AS cst_id,
               'AW' || {_padded('c_custkey', 8)} AS cst_key,
               if(c_custkey % 7 = 0, ' ', '') || c_name AS cst_firstname,
               c_mktsegment || if(c_custkey % 11 = 0, ' ', '') AS cst_lastname,
               ['S', 'm ', NULL, 'X'][c_custkey % 4 + 1] AS cst_marital_status,
               [' F', 'M', 'f', NULL, ''][c_custkey % 5 + 1] AS cst_gndr,
               DATE '2025-10-06' + {_int('c_custkey % 100 + version')} AS cst_create_date
        FROM customer, unnest(if(c_custkey % 10 = 0, [0, 1], [0])) AS u(version)""",
    "raw_prd": f"""
        SELECT if(p_partkey % 83 = 0, NULL, {_int('p_partkey')}) AS prd_id,
               ['AC-BR', 'AC-HE', 'BI-MB', 'CL-CA', 'CO-RF', 'CO-PE', 'CO-WH'][(p_partkey // 3 + again) % 7 + 1]
                   || '-P' || {_padded('p_partkey // 3', 6)} AS prd_key,
               p_name AS prd_nm,
               if(p_partkey % 50 = 0, NULL, {_int('floor(p_retailprice)')}) AS prd_cost,
               ['M ', 'r ', 'S ', 'T ', NULL][p_partkey % 5 + 1] AS prd_line,
               CAST(DATE '2011-07-01' + {_int('p_partkey % 3 * 365')} AS TIMESTAMP) AS prd_start_dt,
               if(p_partkey % 3 = 2, NULL,
                  CAST(DATE '2011-07-01' + {_int('p_partkey % 3 * 365 - 1000')} AS TIMESTAMP)) AS prd_end_dt
        FROM part, unnest(if(p_partkey % 101 = 0, [0, 1], [0])) AS u(again)""",
    "lines": f"""
        SELECT *, l_orderkey % 20 AS kind, l_partkey % 100 AS spot, {_int('l_quantity')} AS units,
               CAST(l_shipdate AS DATE) + {_int('l_orderkey % 15 - 5')} AS due,
               {_int('floor(l_extendedprice)')} AS whole, {_int('floor(l_extendedprice / l_quantity)')} AS each
        FROM lineitem""",
    "raw_sales": f"""
        SELECT 'SO' || CAST(o_orderkey AS VARCHAR) AS sls_ord_num,
               if(spot = 17, 'P-UNKNOWN', 'P' || {_padded('l_partkey // 3', 6)}) AS sls_prd_key,
               {_int('o_custkey')} AS sls_cust_id,
               {_int(f'''CASE 0 WHEN o_orderkey % 50 THEN 0 WHEN o_orderkey % 53 THEN 5489
                    WHEN o_orderkey % 59 THEN 20130229 ELSE {_ymd('o_orderdate')} END''')} AS sls_order_dt,
               {_int(f"CASE spot WHEN 23 THEN 0 WHEN 29 THEN 20999 ELSE {_ymd('l_shipdate')} END")} AS sls_ship_dt,
               {_int(f"CASE spot WHEN 31 THEN 21001231 WHEN 37 THEN NULL ELSE {_ymd('due')} END")} AS sls_due_dt,
               CASE kind WHEN 1 THEN NULL WHEN 2 THEN 0 WHEN 3 THEN -whole WHEN 8 THEN -whole
                    WHEN 4 THEN whole + 1 ELSE units * each END AS sls_sales,
               CASE spot WHEN 41 THEN 0 WHEN 43 THEN NULL ELSE units END AS sls_quantity,
               CASE kind WHEN 5 THEN NULL WHEN 6 THEN 0 WHEN 7 THEN -each WHEN 8 THEN -each ELSE each END AS sls_price
        FROM lines JOIN orders ON o_orderkey = l_orderkey""",
    "raw_az12": f"""
        SELECT if(c_custkey % 3 = 0, 'NAS', '') || 'AW' || {_padded('c_custkey', 8)} AS cid,
               DATE '1920-01-01' + {_int('c_custkey * 527 % 40000')} AS bdate,
               ['F', 'Female', ' male', 'M', '', NULL][c_custkey % 6 + 1] AS gen
        FROM customer, unnest(if(c_custkey % 79 = 0, [0, 1], [0])) AS u(again) WHERE c_custkey % 13 <> 0""",
    "raw_loc": f"""
        SELECT 'AW-' || {_padded('c_custkey', 8)} AS cid,
               CASE c_nationkey WHEN 0 THEN 'DE' WHEN 1 THEN 'US ' WHEN 2 THEN 'USA' WHEN 3 THEN ''
                    WHEN 4 THEN NULL ELSE n_name END AS cntry
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "raw_cat": """
        SELECT v.* EXCLUDE (family)
        FROM (VALUES (0, 'AC_BR', 'Accessories', 'Bike Racks', 'Yes'), (1, 'AC_HE', 'Accessories', 'Helmets', 'Yes'),
                     (2, 'BI_MB', 'Bikes', 'Mountain Bikes', 'Yes'), (3, 'CL_CA', 'Clothing', 'Caps', 'No'),
                     (4, 'CO_RF', 'Components', 'Road Frames', 'Yes'), (5, 'CO_PD', 'Components', 'Pedals', 'No'),
                     (6, 'CO_WH', 'Components', 'Wheels', 'Yes')) AS v(family, id, cat, subcat, maintenance)
        WHERE family IN (SELECT p_partkey // 3 % 7 FROM part)
        UNION ALL
        SELECT if(p_size % 50 = 7, NULL, 'X' || replace(p_brand, 'Brand#', '') || '_' || p_size),
               p_brand || if(p_size % 9 = 0, ' ', ''), 'Size ' || p_size, if(p_size % 2 = 0, 'Yes', 'No')
        FROM (SELECT DISTINCT p_brand, p_size FROM part)""",
    "newest_cust": f"SELECT DISTINCT ON (cst_id) * FROM raw_cust WHERE cst_id IS NOT NULL ORDER BY cst_id, {CUST_TIES}",
    "cln_cust": f"""
        SELECT * REPLACE (trim(cst_firstname) AS cst_firstname, trim(cst_lastname) AS cst_lastname,
                          {marital('cst_marital_status')} AS cst_marital_status, {crm_gender('cst_gndr')} AS cst_gndr)
        FROM newest_cust""",
    "cln_prd": f"""
        SELECT prd_id, {CAT_ID} AS cat_id, {PRD_NUM} AS prd_key, prd_nm, coalesce(prd_cost, 0) AS prd_cost,
               {line('prd_line')} AS prd_line, CAST(prd_start_dt AS DATE) AS prd_start_dt, {REBUILT_END} AS prd_end_dt
        FROM raw_prd""",
    "cln_sales": f"""
        SELECT * REPLACE ({day('sls_order_dt')} AS sls_order_dt, {day('sls_ship_dt')} AS sls_ship_dt,
                          {day('sls_due_dt')} AS sls_due_dt, {GOOD_SALES} AS sls_sales, {GOOD_PRICE} AS sls_price)
        FROM raw_sales""",
    "cln_az12": f"SELECT {PREFIXLESS} AS cid, {PAST_BIRTH} AS bdate, {erp_gender('gen')} AS gen FROM raw_az12",
    "cln_loc": f"SELECT translate(cid, '-', '') AS cid, {country('cntry')} AS cntry FROM raw_loc",
    "dim_cust": f"""
        SELECT {_int('row_number() OVER (ORDER BY cst_id NULLS FIRST, cst_key NULLS FIRST)')} AS customer_key,
               cst_id AS customer_id, cst_key AS customer_number, cst_firstname AS first_name, cst_lastname AS last_name,
               l.cntry AS country, cst_marital_status AS marital_status,
               if(cst_gndr IN ('Female', 'Male'), cst_gndr, coalesce(a.gen, 'n/a')) AS gender,
               a.bdate AS birthdate, cst_create_date AS create_date
        FROM cln_cust LEFT JOIN cln_az12 a ON a.cid = cst_key LEFT JOIN cln_loc l ON l.cid = cst_key""",
    "dim_prd": f"""
        SELECT {_int('row_number() OVER (ORDER BY prd_start_dt NULLS FIRST, prd_key NULLS FIRST, prd_id NULLS FIRST, prd_nm NULLS FIRST, cat_id NULLS FIRST)')} AS product_key,
               prd_id AS product_id, prd_key AS product_number, prd_nm AS product_name, cat_id AS category_id,
               cat AS category, subcat AS subcategory, maintenance, prd_cost AS cost, prd_line AS product_line,
               prd_start_dt AS start_date
        FROM cln_prd LEFT JOIN raw_cat ON id = cat_id WHERE prd_end_dt IS NULL""",
    "fact": """
        SELECT sls_ord_num AS order_number, product_key, customer_key, sls_order_dt AS order_date,
               sls_ship_dt AS shipping_date, sls_due_dt AS due_date, sls_sales AS sales_amount,
               sls_quantity AS quantity, sls_price AS price
        FROM cln_sales LEFT JOIN dim_prd ON product_number = sls_prd_key LEFT JOIN dim_cust ON customer_id = sls_cust_id""",
}


def _needed(text: str, found: list[str]) -> list[str]:
    for name, body in EXPRESSIONS.items():
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(body, found)
            if name not in found:
                found.append(name)
    return found


def statement(body: str) -> str:
    """``body`` with the table expressions it uses in front."""
    parts = [f"{name} AS ({EXPRESSIONS[name].strip()})" for name in _needed(body, [])]
    return f"WITH {', '.join(parts)} {body}" if parts else body
