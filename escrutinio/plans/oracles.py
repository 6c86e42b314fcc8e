"""The same queries as plain SQL over the given tables."""

from escrutinio.operators.reference import POLITICAL_PARTIES
from escrutinio.plans.queries import CHUNK_SIZE

_BASE = """
base AS (
  SELECT k, cast(k AS varchar) AS id, k % 41 = 0 AS blank_vote,
         CASE WHEN k % 41 <> 0 THEN concat('PARTY_', cast(cast(floor(sqrt(k % 100)) AS int) AS varchar)) END
           AS political_party,
         n_name AS province_name, concat('ES-', n_nationkey) AS province_iso_code, n_nationkey,
         r_name AS autonomic_region_name, concat('ES-R', r_regionkey) AS autonomic_region_iso_code,
         CASE WHEN k % 53 = 0 THEN 'unknown' WHEN k % 59 = 0 THEN concat('136.5,', lon)
              ELSE concat(lat, ',', lon) END AS location,
         lat, lon,
         voted_at + to_microseconds((k % 86400) * 1000000 + (k % 1000) * 1000) AS voted_at
  FROM (SELECT o_orderkey AS k, o_custkey, cast(o_orderdate AS timestamp) AS voted_at,
               cast(36000 + o_orderkey % 7000 AS double) / 1000 AS lat,
               cast((o_orderkey * 7) % 12000 - 9000 AS double) / 1000 AS lon
        FROM orders) o
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

_RAW = f"""{_BASE}, raw AS (
  SELECT *, strftime(voted_at, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp" FROM base
  UNION ALL
  SELECT *, strftime(voted_at, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp" FROM base WHERE k % 10 = 0
), once AS (
  SELECT *, strftime(voted_at, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp",
         CASE WHEN blank_vote THEN 'BLANK' ELSE political_party END AS political_party_norm
  FROM base
)"""

_FIELDS = (
    "id, blank_vote, political_party, province_name, province_iso_code, autonomic_region_name,"
    ' autonomic_region_iso_code, location, "timestamp"'
)

_PARSED = f"""
SELECT {_FIELDS}, cast(NULL AS varchar) AS raw FROM raw WHERE k % 97 <> 0
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       substr(concat('{{"id":"', id, '","blank_vote":'), 1, 20) FROM raw WHERE k % 97 = 0"""

_CLEAN = f"SELECT {_FIELDS}, political_party_norm FROM once WHERE k % 97 <> 0"

_DOC_ID = "sha256(concat_ws('||', political_party, province_name, autonomic_region_name))"

_MESSAGES = f"""
SELECT doc_id AS "key",
       concat('{{"doc_id":"', doc_id, '","id":"', id,
              CASE WHEN political_party IS NULL THEN '"' ELSE concat('","political_party":"', political_party, '"') END,
              ',"location":"', location,
              '","timestamp":"', strftime(voted_at, '%Y-%m-%dT%H:%M:%S.%fZ'),
              '","province_iso_code":"', province_iso_code, '","province_name":"', province_name,
              '","blank_vote":', cast(blank_vote AS varchar),
              ',"autonomic_region_iso_code":"', autonomic_region_iso_code,
              '","autonomic_region_name":"', autonomic_region_name, '"}}') AS "value"
FROM (SELECT *, {_DOC_ID} AS doc_id FROM once WHERE k % 97 <> 0) m"""


def _seats_ctes(votes: str = "once", threshold: str = "0.03") -> str:
    """Every quotient ranked, the plain way."""
    return f"""
counts AS (
  SELECT autonomic_region_name, province_name, political_party_norm, count(*) AS votes_per_party
  FROM {votes} GROUP BY 1, 2, 3
), totals AS (
  SELECT *, cast(sum(votes_per_party) OVER (PARTITION BY province_name) AS bigint) AS total_votes_province FROM counts
), valid AS (
  SELECT * FROM totals WHERE political_party_norm <> 'BLANK'
    AND cast(votes_per_party AS double) / total_votes_province >= cast({threshold} AS double)
), seats_ref AS (
  SELECT n_name AS province_name,
         cast(CASE WHEN n_nationkey = 23 THEN 0 ELSE 1 + n_nationkey % 12 END AS bigint) AS total_seats
  FROM nation WHERE n_nationkey <> 24
), joined AS (
  SELECT valid.*, total_seats FROM valid JOIN seats_ref USING (province_name)
), quotients AS (
  SELECT joined.*, divisor, cast(votes_per_party AS double) / divisor AS quotient
  FROM joined JOIN (SELECT unnest(generate_series(1, 100)) AS divisor) d ON divisor <= total_seats
), ranked AS (
  SELECT * FROM (
    SELECT *, cast(row_number() OVER (PARTITION BY province_name ORDER BY quotient DESC, votes_per_party DESC,
                                 political_party_norm, autonomic_region_name) AS int) AS ranking FROM quotients) r
  WHERE ranking <= total_seats
), winners AS (
  SELECT autonomic_region_name, province_name, political_party_norm, count(*) AS seats FROM ranked GROUP BY 1, 2, 3
), seats AS (
  SELECT v.autonomic_region_name, v.province_name, v.political_party_norm, coalesce(w.seats, 0) AS seats
  FROM valid v LEFT JOIN winners w
    ON v.autonomic_region_name IS NOT DISTINCT FROM w.autonomic_region_name
   AND v.province_name IS NOT DISTINCT FROM w.province_name
   AND v.political_party_norm IS NOT DISTINCT FROM w.political_party_norm
)"""


def _seats(select: str, votes: str = "once", threshold: str = "0.03") -> str:
    return f"WITH {_RAW}, {_seats_ctes(votes, threshold)} {select}"


_KEY = "autonomic_region_name, province_name, political_party_norm"
_STREAMED = "(SELECT * FROM once WHERE k % 97 <> 0) s"
_PUBLISHED = "2026-01-02T03:04:05.678901Z"
_PUBLISHED_TEXT = "2026-01-02 03:04:05.678901"
_DOCUMENTS = f"""
SELECT concat_ws('_', province_name, political_party_norm) AS doc_id, province_name,
       political_party_norm AS political_party, autonomic_region_name, seats, '{_PUBLISHED_TEXT}' AS updated_at
FROM seats"""

_REFERENCE = """
provinces AS (
  SELECT cast(n_nationkey AS bigint) AS id, lpad(cast(n_nationkey AS varchar), 2, '0') AS province_code,
         n_name AS province_name, lower(n_name) AS province_alternative_name,
         CASE WHEN n_nationkey = 24 THEN '99' ELSE cast(n_regionkey AS varchar) END AS region_code,
         cast(CASE WHEN n_nationkey = 23 THEN 0 ELSE 1 + n_nationkey % 12 END AS bigint) AS total_seats,
         36 + cast(n_nationkey AS double) / 4 AS latitude, cast(n_nationkey AS double) / 4 - 9 AS longitude,
         (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS population,
         concat('ES-', n_nationkey) AS province_iso_code
  FROM nation
), regions AS (
  SELECT cast(r_regionkey AS varchar) AS region_code, r_name AS region_name,
         lower(r_name) AS region_alternative_name, cast(4 + r_regionkey AS bigint) AS senators,
         concat('ES-R', r_regionkey) AS region_iso_code
  FROM (SELECT r_regionkey, r_name FROM region UNION ALL SELECT max(r_regionkey) + 1, 'NO PROVINCES' FROM region) r
), weights AS (
  SELECT province_name, population,
         greatest(1, cast(trunc(cast(population AS double) / (SELECT sum(population) FROM provinces) * 1000) AS bigint))
           AS weight
  FROM provinces
)"""


def _points(values: str) -> str:
    """Text of point j of record k, for (m, j) pairs."""
    return f"(VALUES {values}) AS t(m, j)"


_COORDINATE = """concat(cast(3600 + (k * 11 + j * 17) % 700 AS double) / 100, ',',
                        cast((k * 7 + j * 13) % 2001 - 1000 AS double) / 100000)"""

_MUNICIPAL_POINTS = f"""
municipalities AS (
  SELECT c_custkey AS k, lpad(cast(n_nationkey AS varchar), 2, '0') AS prov_code, n_nationkey
  FROM customer JOIN nation ON c_nationkey = n_nationkey
), points AS (
  SELECT prov_code, {_COORDINATE} AS coordinate FROM municipalities, (SELECT 0 AS j) z WHERE k % 7 <> 0
  UNION ALL
  SELECT prov_code, {_COORDINATE} FROM municipalities JOIN {_points(
      "(0,0),(0,1),(0,2),(0,0),(1,0),(1,1),(1,2),(1,0),(1,1),(1,2),(1,3),(1,1),(1,3),(1,0),(1,3),"
      "(4,0),(4,2),(4,3),(4,0),(4,1),(4,2),(4,1)")} ON k % 5 = m
"""

_COORDINATES = f"""{_MUNICIPAL_POINTS}
  UNION ALL
  SELECT lpad(cast(nation AS varchar), 2, '0'), {_COORDINATE}
  FROM (SELECT s_suppkey AS k, s_nationkey AS nation FROM supplier) s
  JOIN {_points("(0,0),(0,1),(0,2),(1,0),(1,1),(1,2),(1,3)")} ON k % 3 = m
  WHERE nation % 3 <> 0
), numbered AS (
  SELECT prov_code, coordinate,
         row_number() OVER (PARTITION BY prov_code ORDER BY md5(coordinate), coordinate) - 1 AS position,
         count(*) OVER (PARTITION BY prov_code) AS total
  FROM points
)"""


def _uniform(id_column: str, purpose: str) -> str:
    digest = f"md5(concat_ws('|', cast({id_column} AS varchar), '{purpose}', '0'))"
    return f"(cast(concat('0x', substr({digest}, 1, 13)) AS bigint) / cast(4503599627370496 AS double))"


def _ranges(item: str, weight: str, table: str) -> str:
    return f"""(SELECT {item} AS item, hi - w AS lo, hi, total FROM (
      SELECT {item}, w, sum(w) OVER (ORDER BY md5({item}), {item}) AS hi, sum(w) OVER () AS total
      FROM (SELECT {item}, sum({weight}) AS w FROM {table} GROUP BY 1) a) b)"""


def _draw(source: str, purpose: str, ranges: str, name: str = "") -> str:
    return f"""SELECT s.*, r.item AS {name or purpose}
    FROM (SELECT *, {_uniform("id", purpose)} AS u FROM {source}) s
    JOIN {ranges} r ON u * total >= lo AND u * total < hi"""


_PARTY_VALUES = ", ".join(f"('{name}', {popularity})" for name, popularity in POLITICAL_PARTIES)
_IDS = "ids AS (SELECT o_orderkey AS id FROM orders)"


_UPSERT_LATEST = """
    SELECT doc_id, seats, strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f') AS updated_at FROM (
      SELECT *, row_number() OVER (PARTITION BY doc_id
                                   ORDER BY updated_at DESC, change DESC, seats IS NULL DESC, seats DESC) AS rn
      FROM (SELECT c_custkey AS doc_id, c_custkey % 100 AS seats, timestamp '1996-01-01 00:00:00' AS updated_at,
                   0 AS change FROM customer
            UNION ALL
            SELECT o_custkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END,
                   cast(o_orderdate AS timestamp), 1 FROM orders) u) n
    WHERE rn = 1 AND seats IS NOT NULL"""


def oracle_sql() -> dict[str, str]:
    return {
        "parse_votes": f"WITH {_RAW} {_PARSED}",
        "dedup_votes": f"WITH {_RAW} SELECT {_FIELDS} FROM once",
        "normalize_blank": f"""WITH {_RAW} SELECT id, blank_vote,
            CASE WHEN blank_vote THEN 'BLANK' ELSE political_party END AS political_party_norm FROM raw""",
        "clean_votes": f"WITH {_RAW} {_CLEAN}",
        "doc_id_hash": f"WITH {_RAW} SELECT id, {_DOC_ID} AS doc_id FROM raw",
        "votes_messages": f"WITH {_RAW} {_MESSAGES}",
        "votes_per_party": _seats("SELECT * FROM counts"),
        "province_totals": _seats("SELECT * FROM totals"),
        "party_share": _seats(
            "SELECT *, cast(votes_per_party AS double) / total_votes_province AS share FROM totals"
        ),
        "threshold_filter": _seats("SELECT * FROM valid"),
        "seats_join": _seats("SELECT * FROM joined"),
        "dhondt_quotients": _seats(f"SELECT {_KEY}, votes_per_party, total_seats, divisor, quotient FROM quotients"),
        "seat_ranking": _seats(f"SELECT {_KEY}, votes_per_party, divisor, quotient, ranking FROM ranked"),
        "dhondt_winners": _seats("SELECT * FROM winners"),
        "candidates": _seats(f"SELECT DISTINCT {_KEY} FROM valid"),
        "seats_with_zero": _seats("SELECT * FROM seats"),
        "dhondt_seats": _seats("SELECT * FROM seats"),
        "dhondt_seats_no_threshold": _seats("SELECT * FROM seats", threshold="0"),
        "seats_messages": _seats(f"""SELECT concat_ws('_', province_name, political_party_norm) AS "key",
            concat('{{"doc_id":"', province_name, '_', political_party_norm, '","province_name":"', province_name,
                   '","political_party":"', political_party_norm, '","autonomic_region_name":"', autonomic_region_name,
                   '","seats":', seats, ',"updated_at":"{_PUBLISHED}"}}') AS "value" FROM seats"""),
        "upsert_latest": _UPSERT_LATEST,
        "upsert_buckets": _UPSERT_LATEST,
        "served_lookup": """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
            WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 7)""",
        "upsert_delete": _seats(_DOCUMENTS),
        "geo_point_parse": f"""WITH {_BASE}
            SELECT id, CASE WHEN k % 53 <> 0 AND k % 59 <> 0 THEN lat END AS lat,
                   CASE WHEN k % 53 <> 0 AND k % 59 <> 0 THEN lon END AS lon FROM base""",
        "timestamp_parse": f"""WITH {_BASE}
            SELECT id, CASE k % 4 WHEN 0 THEN strftime(voted_at, '%Y-%m-%d %H:%M:%S.%f')
                                  WHEN 1 THEN strftime(voted_at, '%Y-%m-%dT%H:%M:%S.%f')
                                  WHEN 2 THEN cast(epoch_ms(voted_at) AS varchar) ELSE 'yesterday' END AS "text",
                   CASE WHEN k % 4 <> 3 THEN strftime(voted_at, '%Y-%m-%d %H:%M:%S.%f') END AS "timestamp" FROM base""",
        "keyword_field": """SELECT doc_id, CASE WHEN length("text") <= 256 THEN "text" END AS text_keyword
            FROM documents""",
        "seats_rows": f"""WITH {_RAW}, {_seats_ctes()}
            SELECT province_name, total_seats, count(id) AS votes FROM seats_ref LEFT JOIN once USING (province_name)
            GROUP BY ALL""",
        "load_reference": f"WITH {_REFERENCE} SELECT * FROM provinces JOIN regions USING (region_code)",
        "seats_reference": f"""WITH {_REFERENCE}
            SELECT province_name, total_seats FROM provinces JOIN regions USING (region_code)""",
        "region_seats": f"""WITH {_REFERENCE}
            SELECT r.*, coalesce(cast(sum(p.total_seats) AS bigint), 0) AS total_seats, count(p.id) AS province_count
            FROM regions r LEFT JOIN provinces p USING (region_code) GROUP BY ALL""",
        "region_tree": f"""WITH {_REFERENCE}
            SELECT region_code, region_name, coalesce(cast(sum(p.total_seats) AS bigint), 0) AS total_seats,
                   cast(0 AS bigint) AS chunk,
                   coalesce(string_agg(concat(p.id, ':', p.province_name, ':', p.total_seats), ';' ORDER BY p.id)
                            FILTER (p.id IS NOT NULL), '') AS provinces
            FROM regions r LEFT JOIN provinces p USING (region_code) GROUP BY ALL""",
        "region_tree_chunks": f"""WITH {_REFERENCE}, placed AS (
              SELECT region_code, id, (row_number() OVER (PARTITION BY region_code ORDER BY id) - 1) // 2 AS chunk
              FROM provinces)
            SELECT region_code, coalesce(chunk, 0) AS chunk, coalesce(string_agg(cast(id AS varchar), ';' ORDER BY id), '') AS ids
            FROM regions LEFT JOIN placed USING (region_code) GROUP BY 1, 2""",
        "province_lookup": f"""WITH {_BASE}, {_REFERENCE}
            SELECT b.id, b.province_name, r.region_name AS autonomic_region_name,
                   r.region_iso_code AS autonomic_region_iso_code
            FROM base b LEFT JOIN (SELECT * FROM provinces JOIN regions USING (region_code)) r
              ON b.province_name = r.province_name""",
        "population_weights": f"WITH {_REFERENCE} SELECT province_name, population, weight FROM weights",
        "weight_expansion": f"""WITH {_REFERENCE}
            SELECT province_name, unnest(generate_series(1, weight)) AS slot FROM weights""",
        "party_weights": f"""WITH {_IDS}, parties(name, popularity) AS (VALUES {_PARTY_VALUES}),
            drawn AS (SELECT party, count(*) AS drawn FROM ({_draw("ids", "party", _ranges("name", "popularity", "parties"))})
                      GROUP BY 1)
            SELECT name, cast(popularity AS bigint) AS popularity, coalesce(drawn, 0) AS drawn
            FROM parties LEFT JOIN drawn ON name = party""",
        "geometry_flatten": f"WITH {_COORDINATES} SELECT prov_code, coordinate FROM points",
        "geometry_array": f"WITH {_MUNICIPAL_POINTS}) SELECT prov_code, coordinate FROM points",
        "coordinates_by_province": f"""WITH {_COORDINATES}
            SELECT prov_code, position // {CHUNK_SIZE} AS chunk, count(*) AS n,
                   string_agg(coordinate, ';' ORDER BY position) AS coordinates FROM numbered GROUP BY 1, 2""",
        "coordinates_load": f"WITH {_COORDINATES} SELECT prov_code, coordinate FROM points",
        "coordinates_load_chunks": f"WITH {_COORDINATES} SELECT prov_code, coordinate FROM points",
        "coordinate_pick": f"""WITH {_BASE}, {_COORDINATES},
            sizes AS (SELECT DISTINCT prov_code, total FROM numbered),
            ids AS (SELECT id, lpad(cast(n_nationkey AS varchar), 2, '0') AS prov_code FROM base),
            placed AS (SELECT id, ids.prov_code, cast(floor({_uniform("id", "location")} * total) AS bigint) AS position
                       FROM ids LEFT JOIN sizes ON ids.prov_code = sizes.prov_code)
            SELECT id, placed.prov_code, coordinate AS location FROM placed LEFT JOIN numbered
              ON placed.prov_code = numbered.prov_code AND placed.position = numbered.position""",
        "weighted_draw": f"""WITH {_IDS}, {_REFERENCE}, brands AS (SELECT p_brand, 1 AS parts FROM part),
            first_draw AS (SELECT id, party FROM ({_draw("ids", "party", _ranges("p_brand", "parts", "brands"))}) d)
            SELECT id, party, province FROM
              ({_draw("first_draw", "province", _ranges("province_name", "weight", "weights"))}) d""",
        "weighted_draw_fractions": """
            WITH parts AS (SELECT CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS brand,
                CASE p_partkey % 3 WHEN 0 THEN cast('0.0000000001' AS decimal(28,10)) WHEN 1 THEN 5000000000 ELSE 0.25 END AS w
              FROM part),
            items AS (SELECT brand, cast(sum(w) AS decimal(38,10)) AS w FROM parts WHERE brand IS NOT NULL GROUP BY 1),
            placed AS (SELECT brand, w, cast(sum(w) OVER (ORDER BY md5(brand), brand) AS decimal(38,10)) AS hi,
                              cast(sum(w) OVER () AS decimal(38,10)) AS total, count(*) OVER () AS items FROM items)
            SELECT brand, cast(cast(hi - w AS decimal(38,10)) AS varchar) AS lo, cast(hi AS varchar) AS hi,
                   cast(total AS varchar) AS total, items FROM placed""",
        "coordinate_pick_nulls": f"""WITH {_BASE},
            known AS (SELECT province_iso_code AS prov_code, location,
                row_number() OVER (PARTITION BY province_iso_code ORDER BY md5(location), location) - 1 AS position,
                count(*) OVER (PARTITION BY province_iso_code) AS total FROM base WHERE k % 3 <> 0),
            sizes AS (SELECT DISTINCT prov_code, total FROM known),
            placed AS (SELECT id, prov_code, cast(floor({_uniform("id", "location")} * total) AS bigint) AS position
                       FROM base JOIN sizes ON province_iso_code = prov_code)
            SELECT id, placed.prov_code, location FROM placed JOIN known USING (prov_code, position)""",
        "dedup_payloads": f"""WITH {_RAW}
            SELECT {_FIELDS} FROM once
            UNION ALL SELECT concat('x', id), blank_vote, political_party, province_name, province_iso_code,
              autonomic_region_name, autonomic_region_iso_code, location, NULL FROM once WHERE k % 5 = 0""",
        "bernoulli_flag": f"""WITH {_IDS}
            SELECT id, {_uniform("id", "blank_vote")} < cast(0.01 AS double) AS blank_vote FROM ids""",
        "stream_bronze": f"WITH {_RAW} {_PARSED}",
        "stream_silver": f"WITH {_RAW} {_CLEAN}",
        "stream_clean": f"WITH {_RAW} {_MESSAGES}",
        "stream_seats": _seats("SELECT * FROM seats", _STREAMED),
        "stream_served": _seats(_DOCUMENTS, _STREAMED),
        "stream_seats_changes": _seats("SELECT * FROM seats", _STREAMED),
        "stream_served_changes": _seats(_DOCUMENTS, _STREAMED),
        "stream_together": _seats("SELECT * FROM seats", _STREAMED),
        "stream_dates": f"""WITH {_RAW}
            SELECT {_FIELDS}, political_party_norm, year(voted_at) AS "year" FROM once
            WHERE k % 97 <> 0 AND voted_at >= '1993-06-01' AND voted_at < '1997-03-01'""",
        "stream_enriched": f"""WITH {_BASE}, {_REFERENCE},
            known AS (SELECT p.province_name, region_name, region_iso_code, p.id % 2 = 0 AS early
                      FROM provinces p JOIN regions USING (region_code))
            SELECT b.id, b.province_name, region_name AS autonomic_region_name, region_iso_code AS autonomic_region_iso_code
            FROM base b LEFT JOIN known ON b.province_name = known.province_name AND (early OR k % 2 = 1)
            WHERE k % 97 <> 0""",
        "stream_measures": f"""WITH {_RAW}, counts AS (
              SELECT count(*) AS raw_rows, count(*) FILTER (k % 97 = 0) AS rejected,
                     count(DISTINCT k) FILTER (k % 97 <> 0) AS kept FROM raw)
            SELECT 'bronze' AS layer, 'read' AS measure, raw_rows AS n FROM counts
            UNION ALL SELECT 'bronze', 'rejected', rejected FROM counts
            UNION ALL SELECT 'votes', 'read', raw_rows - rejected FROM counts
            UNION ALL SELECT 'silver', 'kept', kept FROM counts
            UNION ALL SELECT 'out_of_time', unnest(['undated', 'late', 'early']), 0""",
        "stream_rebuilt": _seats("SELECT *, 0 AS other_silver, 0 AS other_clean, 0 AS other_seats FROM seats", _STREAMED),
        "stream_event_time": f"""WITH {_RAW}, reasons AS (
              SELECT id, CASE WHEN k % 23 = 0 THEN 'undated' WHEN k % 19 = 0 THEN 'early' WHEN k % 5 >= 3 THEN 'late' END AS reason
              FROM raw WHERE k % 97 <> 0)
            SELECT DISTINCT id, 'kept' AS reason FROM reasons WHERE reason IS NULL
            UNION ALL SELECT id, reason FROM reasons WHERE reason IS NOT NULL""",
    }
