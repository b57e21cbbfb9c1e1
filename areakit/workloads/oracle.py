"""The registered queries as SQL over the same tables, for a second engine."""

from __future__ import annotations

from areakit.functions.names import ACCENTED, PLAIN
from areakit.sources.portal import PORTAL
from areakit.workloads import landing, modelling, roles


def mean2(total: str, n: str) -> str:
    """The two-decimal mean of a sum of millionths; ``format`` rounds the binary value."""
    return f"CAST(format('{{:.2f}}', CAST({total} AS DOUBLE) / 1000000e0 / ({n})) AS DOUBLE) + 0e0"


def cents(amount: str) -> str:
    return f"CAST(round({amount} * 100) AS BIGINT)"


def units(amount: str) -> str:
    return f"CAST(round({amount} * 1000000) AS BIGINT)"


def normalized(name: str) -> str:
    return (
        f"trim(regexp_replace(translate(lower({name}), '{ACCENTED}', '{PLAIN}'), "
        "'[^a-z0-9]+', ' ', 'g'))"
    )


def part(key: str) -> str:
    return f"CAST(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % {roles.PARTS} AS INTEGER)"


RECONCILED = "('Nation ' || substr(n_name, 8))"
CURRENT, PREVIOUS = roles.CURRENT_YEAR, roles.PREVIOUS_YEAR

LISTINGS = f"""
listings AS (
  SELECT CAST(o_custkey AS VARCHAR) AS "propertyCode", CAST(o_orderdate AS DATE) AS date,
         o_orderstatus AS province,
         CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '{roles.UNSTATED}'
              ELSE replace(n_name, '_', '-') END AS raw_name,
         o_totalprice AS price, c_acctbal AS size,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rooms, n_regionkey AS bathrooms,
         CAST(n_nationkey AS DOUBLE) AS latitude, CAST(n_regionkey AS DOUBLE) AS longitude,
         o_orderstatus AS operation, c_mktsegment AS "propertyType", o_orderpriority AS floor,
         o_orderkey AS listing_id
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""
SCOPED = f"""{LISTINGS},
scoped AS (
  SELECT l.*, {RECONCILED} AS neighborhood
  FROM listings l JOIN nation ON l.raw_name = replace(n_name, '_', '-')
  WHERE province = '{roles.PROVINCE}'
)"""
NEWEST = f"""{SCOPED},
newest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY "propertyCode" ORDER BY date DESC, listing_id DESC) AS place
    FROM scoped)
  WHERE place = 1
)"""
LISTING_FIELDS = (
    '"propertyCode", date, price, size, rooms, bathrooms, latitude, longitude, operation, '
    '"propertyType", floor'
)

RENT_ROWS = f"""
rent_rows AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS "Any",
         CASE l_returnflag WHEN 'A' THEN '{roles.SURFACE_KIND}'
              ELSE '{roles.MONTHLY_KIND}' END AS "Lloguer_mitja",
         l_extendedprice * l_discount AS price
  FROM lineitem WHERE l_returnflag IN ('A', 'R') AND year(l_shipdate) >= {PREVIOUS}
)"""
AREA = (
    'n_name AS "Nom_Barri", "Any", r_name AS "Nom_Districte", n_nationkey AS "Codi_Barri", '
    'r_regionkey AS "Codi_Districte"'
)


def _kind_mean(kind: str) -> str:
    where = f"FILTER (WHERE \"Lloguer_mitja\" = '{kind}')"
    return mean2(f"sum({units('price')}) {where}", f"count(*) {where}")


RENT_MEANS = f"""{RENT_ROWS},
means AS (
  SELECT {AREA}, {_kind_mean(roles.SURFACE_KIND)} AS surface_price,
         {_kind_mean(roles.MONTHLY_KIND)} AS monthly_price
  FROM rent_rows JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL
  HAVING count(DISTINCT "Lloguer_mitja") = 2
)"""
TWO_YEAR = f"""{RENT_MEANS},
two_year AS (
  SELECT * FROM means WHERE "Any" = {CURRENT}
  AND "Nom_Barri" IN (SELECT "Nom_Barri" FROM means WHERE "Any" = {PREVIOUS})
)"""
RENT_PROFILE = f"""{TWO_YEAR},
rent_profile AS (
  SELECT {RECONCILED} AS neighborhood, "Codi_Barri" AS neighborhood_code,
         "Nom_Districte" AS rent_district, "Codi_Districte" AS district_code,
         surface_price, monthly_price
  FROM two_year JOIN nation ON "Nom_Barri" = n_name
)"""

INCOME = f"""
income AS (
  SELECT n_name AS name, r_name AS district_name, n_nationkey,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         {mean2(f"sum({units('c_acctbal')})", "count(*)")} AS rfd, count(*) AS pop
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL
),
recent AS (
  SELECT name, district_name, n_nationkey, rfd, CAST(pop AS DOUBLE) AS pop
  FROM income i WHERE year = (SELECT max(year) FROM income j WHERE j.name = i.name)
),
income_profile AS (
  SELECT 'Nation ' || substr(name, 8) AS neighborhood,
         'Q' || CAST(n_nationkey AS VARCHAR) AS neighborhood_id, district_name, rfd, pop
  FROM recent
)"""
PROFILE = f"""{INCOME},
{RENT_PROFILE.strip()},
profile AS (
  SELECT neighborhood, neighborhood_id, neighborhood_code, district_name, district_code,
         rfd, pop, surface_price, monthly_price
  FROM income_profile JOIN rent_profile USING (neighborhood)
)"""
INTEGRATED = f"""{PROFILE},
{NEWEST.strip()},
flat AS (SELECT n.*, p.* EXCLUDE (neighborhood) FROM newest n JOIN profile p USING (neighborhood))"""
KPI1_COLUMNS = f"""neighborhood, {mean2(f"sum({units('price')})", "count(price)")} AS average_price,
         count(*) AS n_listings"""

YEARLY = f"""
yearly AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS "Any", o_orderkey AS "Codi",
         o_custkey AS "Propietat", {cents('o_totalprice')} AS "Població",
         o_orderpriority AS "Prioritat"
  FROM orders
)"""
REPORT = f"CAST(\"Any\" AS VARCHAR) || '_{landing.TOPIC}_bcn'"
SEEN = """
  CAST(date_trunc('month', date) AS DATE) AS date, "propertyCode", price, rooms,
  raw_name AS neighborhood, floor, "propertyType" AS typology, operation AS sub_typology"""

LINKS = r"""
scope AS (SELECT page_id, html FROM pages),
anchors AS (
  SELECT page_id, i - 1 AS pos, a[i] AS anchor
  FROM (SELECT page_id, a, unnest(range(1, len(a) + 1)) AS i FROM (
    SELECT page_id, regexp_extract_all(html, '(?is)<a\s[^>]*>.*?</a>', 0) AS a FROM scope))
),
found AS (
  SELECT page_id, CAST(pos AS INTEGER) AS pos,
         trim(regexp_extract(anchor, '(?is)^<a\s[^>]*?href="([^"]*)"', 1)) AS href,
         trim(regexp_replace(anchor, '(?s)<[^>]*>', '', 'g')) AS text
  FROM anchors WHERE regexp_matches(anchor, '(?is)^<a\s[^>]*?href="([^"]*)"')
),
links AS (
  SELECT *, lower(substr(text, 1, greatest(length(text) - 3, 0))) AS title FROM found
)"""
# The same for links inside the pages' navigation alone.
NAVIGATION = r"""scope AS (SELECT page_id, regexp_extract(html, '(?s)<nav><ul>(.*?)</ul></nav>', 1) AS html FROM pages)"""
LISTED_LINKS = LINKS.replace("scope AS (SELECT page_id, html FROM pages)", NAVIGATION)

MESSAGES = f"""
messages AS (
  SELECT event_id, event_type, fault, CAST({cents('value')} AS VARCHAR) AS price,
         CAST(event_id AS VARCHAR) || ',' || CASE fault WHEN 'blank' THEN ' ' ELSE event_type END ||
         CASE event_type WHEN 'error' THEN '' WHEN 'signup' THEN ',n/a'
           ELSE ',' || CASE fault WHEN 'nan' THEN 'NaN' ELSE CAST({cents('value')} AS VARCHAR) END
         END AS value
  FROM (SELECT *, CASE WHEN event_type IN ('error', 'signup') THEN event_type
    WHEN event_id % {roles.BLANK_EVERY} = 0 THEN 'blank'
    WHEN event_id % {roles.NAN_EVERY} = 0 THEN 'nan' ELSE 'none' END AS fault FROM events)
)"""
PARSED = f"""WITH {MESSAGES}
SELECT event_type AS "Neighborhood_ID", CAST(price AS DOUBLE) AS "Price"
FROM messages WHERE fault = 'none'"""


def _index(column: str) -> str:
    return f"""(
  SELECT CAST({column} AS VARCHAR) AS value, count(*) AS n_rows,
         row_number() OVER (ORDER BY count(*) DESC, CAST({column} AS VARCHAR)) - 1 AS label_index
  FROM part GROUP BY 1)"""


TEST_SIDE = "CAST('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 >= 70"
DEDUPED = f"WITH {NEWEST} SELECT neighborhood, {LISTING_FIELDS} FROM newest"
KPI1 = f"WITH {NEWEST} SELECT {KPI1_COLUMNS} FROM newest GROUP BY neighborhood"
CORR = "round(corr({x}, {y}), 3)"
MATRIX_COLUMNS = ["rfd", "pop", "surface_price", "monthly_price"]

ORACLE = {
    "kpi1": KPI1,
    "select_rename_cast": """
SELECT o_orderkey AS listing_id, CAST(o_custkey AS VARCHAR) AS property_code, o_totalprice AS price,
       CAST(o_orderdate AS DATE) AS date, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rooms
FROM orders""",
    "filter_clean": f"""
WITH {RENT_ROWS} SELECT l_orderkey, l_linenumber, "Any", "Lloguer_mitja", price FROM rent_rows""",
    "filter_scope": f"""
WITH {LISTINGS} SELECT listing_id, "propertyCode", raw_name AS neighborhood, price
FROM listings WHERE province = '{roles.PROVINCE}'""",
    "distinct_rows": """
SELECT DISTINCT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag FROM lineitem""",
    "normalize_names": f"SELECT doc_id, {normalized('text')} AS normalized FROM documents",
    "lookup_districts": f"""
SELECT 'Q' || CAST(n_nationkey AS VARCHAR) AS _id, n_name AS district,
       {normalized('n_name')} AS district_name, {RECONCILED} AS district_reconciled,
       string_agg('S' || CAST(s_suppkey AS VARCHAR), ','
                  ORDER BY 'S' || CAST(s_suppkey AS VARCHAR)) AS neighborhood_id,
       {part("'S' || CAST(s_suppkey AS VARCHAR)")} AS part
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_nationkey, n_name, part""",
    "reconcile_listings": f"""
WITH {SCOPED} SELECT listing_id, neighborhood, {LISTING_FIELDS} FROM scoped""",
    "reconcile_unmatched": f"""
WITH {LISTINGS} SELECT raw_name, count(*) AS n_rows FROM listings
WHERE raw_name NOT IN (SELECT replace(n_name, '_', '-') FROM nation) GROUP BY raw_name""",
    "dedupe_latest": DEDUPED,
    "dedupe_latest_window": DEDUPED,
    "income_nest": f"""
WITH {INCOME} SELECT name AS neigh_name, district_name,
  string_agg(CAST(year AS VARCHAR) || ':' || CAST({cents('rfd')} AS VARCHAR) || ':' ||
             CAST(pop AS VARCHAR), ';' ORDER BY year) AS info
FROM income GROUP BY name, district_name""",
    "most_recent": f"WITH {INCOME} SELECT name, district_name, rfd, pop FROM recent",
    "income_profile": f"WITH {INCOME} SELECT * FROM income_profile",
    "rent_means": f"WITH {RENT_MEANS} SELECT * FROM means",
    "rent_two_year": f"WITH {TWO_YEAR} SELECT * FROM two_year",
    "rent_yoy": f"""
WITH {RENT_MEANS} SELECT "Nom_Barri", n."Nom_Districte", "Codi_Barri", "Codi_Districte",
  n.surface_price, n.monthly_price,
  round(n.surface_price - b.surface_price, 2) AS surface_increase,
  round(n.monthly_price - b.monthly_price, 2) AS monthly_increase
FROM means n JOIN means b USING ("Nom_Barri", "Codi_Barri", "Codi_Districte") WHERE n."Any" = {CURRENT} AND b."Any" = {PREVIOUS}""",
    "rent_profile": f"WITH {RENT_PROFILE} SELECT * FROM rent_profile",
    "area_profile": f"WITH {PROFILE} SELECT * FROM profile",
    "integrated_flat": f"""
WITH {INTEGRATED} SELECT neighborhood AS "Neighborhood", neighborhood_id AS "Neighborhood Id",
  neighborhood_code AS "Neighborhood Code", district_name AS "District Name",
  district_code AS "District Code", "propertyCode" AS "Property Code", date AS "Date",
  price AS "Price", size AS "Size", rooms AS "Rooms", bathrooms AS "Bathrooms",
  latitude AS "Latitude", longitude AS "Longitude", operation AS "Operation",
  "propertyType" AS "PropertyType", floor AS "Floor", rfd AS "RFD", pop AS "POP",
  surface_price AS "Surface Price (€/m2)", monthly_price AS "Monthly Price (€/month)"
FROM flat""",
    "nested_listings": f"""
WITH {INTEGRATED} SELECT neighborhood AS "Neighborhood", neighborhood_id AS "Neighborhood Id",
  neighborhood_code AS "Neighborhood Code", district_name AS "District",
  district_code AS "District Code", rfd AS "RFD most recent", pop AS "Population recent",
  surface_price AS "Surface Price (€/m2)", monthly_price AS "Monthly Price (€/month)",
  string_agg("propertyCode" || '|' || CAST(date AS VARCHAR) || '|' ||
             CAST({cents('price')} AS VARCHAR) || '|' || CAST(rooms AS VARCHAR) || '|' || floor,
             ';' ORDER BY "propertyCode") AS "Info Idealista",
  {part('"propertyCode"')} AS "Info Part"
FROM flat GROUP BY ALL""",
    "integration_counts": f"""
WITH {INTEGRATED} SELECT count(*) AS flat_rows, count(*) AS nested_listings,
  count(DISTINCT neighborhood || '|' || {part('"propertyCode"')}) AS nested_rows FROM flat""",
    "published_indicators": f"""
WITH {INTEGRATED}, kpi1 AS (SELECT {KPI1_COLUMNS} FROM flat GROUP BY neighborhood),
rents AS (SELECT DISTINCT ON (neighborhood) monthly_price FROM flat)
SELECT kpi1.*, (SELECT count(*) FROM rents) AS n_pairs, (SELECT max(monthly_price) FROM rents) AS highest_rent
FROM kpi1""",
    "kpi1_nested": f"WITH {INTEGRATED} SELECT {KPI1_COLUMNS} FROM flat GROUP BY neighborhood",
    "kpi1_ranked": f"""
WITH k AS ({KPI1})
SELECT neighborhood, average_price, n_listings, average_price / 1000 AS scaled_price,
       row_number() OVER (ORDER BY average_price, neighborhood) AS price_rank,
       row_number() OVER (ORDER BY n_listings DESC, neighborhood) AS listings_rank
FROM k""",
    "kpi2_pairs": f"""
WITH {INTEGRATED} SELECT DISTINCT ON (neighborhood) monthly_price AS "Monthly Price (€/month)",
  rfd AS "RFD most recent" FROM flat""",
    "kpi2_corr": f"""
WITH {INTEGRATED}, pairs AS (SELECT DISTINCT ON (neighborhood) monthly_price, rfd FROM flat)
SELECT {CORR.format(x='monthly_price', y='rfd')} AS correlation FROM pairs""",
    "kpi2_corr_matrix": f"WITH {PROFILE} "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, {CORR.format(x=x, y=y)} AS correlation FROM profile"
        for x in MATRIX_COLUMNS
        for y in MATRIX_COLUMNS
    ),
    "scan_table": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "sink_overwrite": f"""
SELECT o_orderkey, o_orderstatus,
  CASE WHEN o_orderstatus = '{roles.PROVINCE}' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice
FROM orders WHERE o_orderstatus <> 'O'""",
    "csv_roundtrip": f"WITH {YEARLY} SELECT *, {REPORT} AS report FROM yearly",
    "csv_yearly_union": f"""
WITH {YEARLY} SELECT "Any" AS year, * REPLACE (
  CASE WHEN "Any" < {landing.NEW_FORMAT_YEAR} THEN NULL WHEN "Any" % 2 = 1 THEN '3" ' || "Prioritat"
    WHEN "Codi" % {landing.TWO_LINES_EVERY} = 0 THEN "Prioritat" || chr(10) || 'urgent'
    ELSE "Prioritat" END AS "Prioritat") FROM yearly""",
    "csv_rejects": f"""
WITH {YEARLY}, marked AS (
  SELECT "Any" AS year, "Any" = {landing.STRAY_YEAR} AND "Codi" % {landing.STRAY_EVERY} = 0 AS stray FROM yearly)
SELECT year, count(*) FILTER (NOT stray) AS n_rows, count(*) FILTER (stray) AS n_lines FROM marked GROUP BY year""",
    "csv_dialects": f"""
WITH {YEARLY} SELECT * REPLACE ('Àrea; ' || "Prioritat" || ', "ü"' ||
  CASE WHEN "Any" > {landing.LAST_SEMICOLON_YEAR} AND "Any" < {landing.NEW_FORMAT_YEAR} THEN chr(10) || 'ç'
    ELSE '' END AS "Prioritat") FROM yearly""",
    "json_indexed": f"""
WITH {YEARLY} SELECT *, {REPORT} AS report,
  row_number() OVER (ORDER BY {REPORT}, "Codi") - 1 AS row_index FROM yearly""",
    "missing_years": f"""
SELECT CAST(y AS INTEGER) AS year FROM range({landing.FIRST_YEAR}, {landing.END_YEAR}) t(y)
WHERE y NOT IN (SELECT year(o_orderdate) FROM orders)""",
    "lookup_load": f"""
SELECT CAST(s_suppkey AS VARCHAR) AS _id, s_name AS neighborhood,
       {normalized('s_name')} AS neighborhood_name, s_name AS neighborhood_reconciled
FROM supplier""",
    "snapshot_scan": f"""
WITH {LISTINGS}, seen AS (SELECT {SEEN} FROM listings WHERE year(date) >= 1996)
SELECT * REPLACE (CASE WHEN year(date) = {landing.WHOLE_YEAR} THEN trunc(price) ELSE price END AS price) FROM seen""",
    "snapshot_gate": f"""
WITH {LISTINGS} SELECT CAST(date_trunc('month', date) AS DATE) AS date, count(*) AS n_rows
FROM listings WHERE year(date) < 1996 GROUP BY 1""",
    "snapshot_month": f"""
WITH {LISTINGS} SELECT listing_id, "propertyCode", price, CAST(date_trunc('month', date) AS DATE) AS date
FROM listings WHERE date_trunc('month', date) = DATE '{landing.MONTH}'""",
    "snapshot_dates": f"""
WITH {LISTINGS}, months AS (
  SELECT DISTINCT CAST(date_trunc('quarter', l_shipdate) AS DATE) AS date FROM lineitem
  WHERE l_returnflag = 'R' AND l_quantity = {landing.LARGEST_QUANTITY})
SELECT CAST(date_trunc('month', l.date) AS DATE) AS date, count(*) AS n_listings
FROM listings l JOIN months m ON date_trunc('month', l.date) = m.date GROUP BY 1""",
    "listing_json": f"WITH {LISTINGS} SELECT {SEEN} FROM listings",
    "page_links": f"""
WITH {LINKS} SELECT page_id, pos, '{PORTAL}' || href AS url, text, title FROM links""",
    "report_links": f"""
WITH {LISTED_LINKS}, wanted AS (
  SELECT DISTINCT substr(lower(w), 1, 4) AS year
  FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark))
SELECT year, arg_max('{PORTAL}' || href, page_id * 100000 + pos) AS url
FROM (SELECT *, substr(title, 1, 4) AS year FROM links WHERE NOT ends_with(title, 'xml'))
WHERE year IN (SELECT year FROM wanted) GROUP BY year""",
    "label_index": f"SELECT * FROM {_index('p_size')}",
    "ml_features": f"""
SELECT p_partkey, CAST(s.label_index AS INTEGER) AS label_index,
       CAST(b.label_index AS INTEGER) AS category_index,
       CAST(b.label_index AS INTEGER) AS hot_slot,
       CAST((SELECT count(DISTINCT p_brand) + 1 FROM part) AS INTEGER) AS n_features,
       p_retailprice AS price
FROM part JOIN {_index('p_size')} s ON s.value = CAST(p_size AS VARCHAR)
     JOIN {_index('p_brand')} b ON b.value = p_brand""",
    "train_test_split": """
SELECT p_partkey, p_brand AS "Neighborhood_ID", p_retailprice AS "Price", p_size AS "Rooms",
       CASE WHEN CAST('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 70
            THEN 'train' ELSE 'test' END AS side
FROM part""",
    "parse_messages": PARSED,
    "stream_parse": PARSED,
    "stream_restart": PARSED,
    "stream_rejects": f"""
WITH {MESSAGES} SELECT value, CASE WHEN fault <> 'blank' THEN event_type END AS "Neighborhood_ID",
  CASE WHEN fault IN ('none', 'blank') THEN CAST(price AS DOUBLE) END AS "Price",
  CASE fault WHEN 'error' THEN 'no price' WHEN 'blank' THEN 'no area' WHEN 'none' THEN NULL
    ELSE 'price is no number' END AS reason,
  CASE WHEN fault = 'none' THEN 'accepted' ELSE 'rejected' END AS route
FROM messages""",
    "model_predict": f"""
SELECT p_partkey, p_brand AS "Neighborhood_ID", p_retailprice AS "Price", true AS label_is_named
FROM part WHERE {TEST_SIDE}""",
    "model_accuracy": f"""
SELECT count(*) AS n_rows, true AS equals_evaluator FROM part WHERE {TEST_SIDE}""",
    "model_roundtrip": f"SELECT p_partkey, true AS same_prediction FROM part WHERE {TEST_SIDE}",
    "stream_batches": f"""
WITH {MESSAGES} SELECT value, CASE WHEN fault <> 'blank' THEN event_type END AS "Neighborhood_ID",
  CASE WHEN fault IN ('none', 'blank') THEN CAST(price AS DOUBLE) END AS "Price",
  CASE fault WHEN 'error' THEN 'no price' WHEN 'blank' THEN 'no area' WHEN 'none' THEN NULL
    ELSE 'price is no number' END AS reason,
  CASE WHEN fault = 'none' THEN 'accepted' ELSE 'rejected' END AS route
FROM messages""",
    "stream_offsets": f"""
WITH files AS (SELECT DISTINCT event_id // {modelling.EVENTS_A_FILE} AS part FROM events),
runs AS (
  SELECT part % 2 AS run, ceil(count(*) / {modelling.FILES_A_BATCH})::BIGINT AS n FROM files GROUP BY run)
SELECT b AS batch, CASE WHEN b > 0 THEN b - 1 END AS start_offset, b AS end_offset, true AS committed,
  (SELECT count(*) FROM events) AS n_events, (SELECT count(*) FROM events) AS n_rows
FROM range((SELECT sum(n) FROM runs)::BIGINT) AS t(b)""",
    "latest_upkeep": DEDUPED,
    "latest_upkeep_runs": f"""
WITH {SCOPED}, runs AS (
  SELECT *, CASE WHEN year(date) < {modelling.LANDINGS[1]} THEN 0 WHEN year(date) < {modelling.LANDINGS[2]} THEN 1
    ELSE 2 END AS run FROM scoped)
SELECT CAST(run AS INTEGER) AS run, count(*) AS n_rows, min(date) AS first, max(date) AS last FROM runs GROUP BY run""",
    "model_from_zone": f"""
WITH {INTEGRATED} SELECT neighborhood_id AS "Neighborhood_ID", count(*) AS n_rows, count(*) AS n_named FROM flat
WHERE CAST('0x' || substr(md5("propertyCode"), 1, 8) AS BIGINT) % 100 >= 70 GROUP BY neighborhood_id""",
    "model_summary": f"""
SELECT CAST(stage AS INTEGER) AS stage, kind,
  CAST(CASE WHEN forest THEN 3 END AS INTEGER) AS num_trees,
  CAST(CASE WHEN forest THEN (SELECT count(DISTINCT p_brand) + 1 FROM part WHERE NOT {TEST_SIDE}) END AS INTEGER)
    AS num_features,
  CAST(CASE WHEN forest THEN (SELECT count(DISTINCT p_size) + 1 FROM part WHERE NOT {TEST_SIDE}) END AS INTEGER)
    AS num_classes,
  CASE WHEN forest THEN true END AS adds_up
FROM (SELECT *, kind = 'RandomForestClassificationModel' AS forest FROM (VALUES
  (0, 'StringIndexerModel'), (1, 'StringIndexerModel'), (2, 'OneHotEncoderModel'), (3, 'VectorAssembler'),
  (4, 'RandomForestClassificationModel'), (5, 'IndexToString')) AS v(stage, kind))""",
    "stream_predict": """
SELECT p_brand AS "Neighborhood_ID", p_retailprice AS "Price", true AS equals_batch FROM part""",
    "integration_rejects": f"""
WITH {LISTINGS}
SELECT 'listing name' AS kind, raw_name AS value, count(*) AS n_rows FROM listings
WHERE province = '{roles.PROVINCE}' AND raw_name NOT IN (SELECT replace(n_name, '_', '-') FROM nation)
GROUP BY raw_name
UNION ALL
SELECT 'rent price', '{roles.UNREADABLE}', count(*) FROM lineitem
WHERE l_linenumber = {roles.UNREADABLE_LINE} AND year(l_shipdate) >= {PREVIOUS} HAVING count(*) > 0
UNION ALL
SELECT 'income lookup name', n_name, CAST(2 AS BIGINT) FROM nation WHERE n_nationkey = {roles.REPEATED}""",
}
