"""The registered queries in SQL, on the same tables."""

from __future__ import annotations

from . import bindings as b

_LEVEL = "CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN '_L2' ELSE '_L4' END"

_GRANULES = f"""
g0 AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         'C' || substr(o_orderpriority, 1, 1) || {_LEVEL} AS collection
  FROM orders),
g AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS granule_id, CAST(o_orderkey AS BIGINT) AS search_rank,
         collection, collection || '_' || o_orderkey || '_' || lower(o_orderstatus) || '.nc' AS name,
         lower(o_orderstatus) AS st, o_orderdate AS b, o_orderdate + INTERVAL 6 HOUR AS e,
         CAST(epoch(o_orderdate) AS BIGINT) AS begin_s, CAST(o_custkey AS BIGINT) AS cycle,
         CAST(dayofyear(o_orderdate) AS BIGINT) AS ppass, o_totalprice
  FROM g0),
gl AS (SELECT *, 's3://b-' || st || '/' || name AS url FROM g)"""

_PROVIDER = ("CASE WHEN contains(url, 'b-f') THEN 'FIRST' WHEN contains(url, 'b-o') THEN 'OTHER' "
             "ELSE 'REST' END")

_CHUNKS = """
c AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS granule_id, 'v_' || l_linestatus AS var,
         CAST(l_linenumber AS BIGINT) - 1 AS idx, CAST(min(l_partkey) AS BIGINT) AS "offset",
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS length
  FROM lineitem GROUP BY l_orderkey, l_linestatus, l_linenumber),
o AS (
  SELECT granule_id, cycle AS "offset", CAST(floor(o_totalprice) AS BIGINT) AS length FROM g)"""


def _numbered(order: str, where: str = "true") -> str:
    """Granules with their ordinal, the length of their time axis and its offset."""
    return f"""
s AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS granule_id, CAST(max(l_linenumber) AS BIGINT) AS n
  FROM lineitem GROUP BY l_orderkey),
a0 AS (
  SELECT g.*, coalesce(n, 0) AS n FROM g LEFT JOIN s USING (granule_id) WHERE {where}),
a AS (
  SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS ord,
         CAST(coalesce(sum(n) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING
                                    AND 1 PRECEDING), 0) AS BIGINT) AS off0
  FROM a0)"""


def _existing(order: str = "search_rank") -> str:
    return f"""WITH {_GRANULES}, {_CHUNKS}, {_numbered(order)}
SELECT var || '/' || (idx + off0) AS key, 's3://b/' || granule_id || '.nc' AS url, "offset", length
FROM c JOIN a USING (granule_id)
UNION ALL
SELECT 'm_total/' || (off0 + i) || '.0', 's3://b/' || granule_id || '.nc', "offset", length
FROM (SELECT granule_id, off0, unnest(range(n)) AS i FROM a) JOIN o USING (granule_id)
UNION ALL
SELECT 'lat/0', 's3://b/' || granule_id || '.nc', "offset", length
FROM a JOIN o USING (granule_id) WHERE ord = 0"""


def _new_axis(order: str = "search_rank", more: str = "", where: str = "true") -> str:
    return f"""WITH {_GRANULES}, {_CHUNKS}, {_numbered(order)}
SELECT var || '/' || ord || '.' || idx AS key, 's3://b/' || granule_id || '.nc' AS url,
       "offset", length {more}
FROM c JOIN a USING (granule_id) WHERE {where}
UNION ALL
SELECT 'lat/' || ord || '.0', 's3://b/' || granule_id || '.nc', "offset", length {more}
FROM a JOIN o USING (granule_id) WHERE {where}
UNION ALL
SELECT 'crs/0', 's3://b/' || granule_id || '.nc', "offset", length {more}
FROM a JOIN o USING (granule_id) WHERE ord = 0"""


def _https(url: str) -> str:
    raw = f"replace({url}, 's3://', '')"
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in b.HOSTS.items())
    return (f"CASE WHEN starts_with({url}, 's3://') THEN 'https://' || CASE split_part({raw}, '/', 1) "
            f"{cases} ELSE '{b.DEFAULT_HOST}' END || '/' || {raw} ELSE {url} END")


def _rewritten(source: str, column: str) -> str:
    """CTE chain that rewrites a text column, one step per bucket."""
    steps = [f"t0 AS (SELECT *, replace({column}, 'S3FileSystem', 'HTTPFileSystem') AS t FROM {source})"]
    for i, bucket in enumerate(b.BUCKETS):
        target = f"https://{b.HOSTS.get(bucket, b.DEFAULT_HOST)}/{bucket}"
        steps.append(f"p{i} AS (SELECT * REPLACE (replace(t, 's3://{bucket}/', '{target}/') AS t) "
                     f"FROM t{i})")
        steps.append(f"t{i + 1} AS (SELECT * REPLACE (CASE WHEN contains(t, '{bucket}') AND NOT "
                     f"contains(t, 'https://') THEN replace(t, '{bucket}', '{target}') ELSE t END "
                     f"AS t) FROM p{i})")
    return ", ".join(steps)


_URLS = """u AS (SELECT 's3://b-' || source || '/' || doc_id AS url FROM documents
                 UNION ALL SELECT url FROM pages)"""

_TEXTS = """x AS (
  SELECT 'd' || doc_id AS key,
         'fsspec.S3FileSystem s3://b-' || source || '/' || doc_id || ' ' || text AS text
  FROM documents
  UNION ALL SELECT 'p' || page_id, 'b-src2/' || page_id || ' b-src3 ' || html FROM pages)"""

_REFS = f"""WITH x AS (SELECT 'page/' || page_id AS key,
                 's3://b-src1/' || page_id || ' ' || html AS text FROM pages),
{_rewritten("x", "text")},
d AS (SELECT 'doc/' || doc_id AS key, 's3://b-' || source || '/' || doc_id AS url,
             '[' || doc_id || ',' || n_chars || ']' AS tail_json FROM documents)
SELECT key, 'ref' AS kind, {_https("url")} AS url, tail_json, CAST(NULL AS VARCHAR) AS inline_md5,
       CAST(NULL AS VARCHAR) AS other_json FROM d
UNION ALL SELECT key, 'inline', NULL, NULL, md5(t), NULL FROM t{len(b.BUCKETS)}
UNION ALL SELECT 'part/' || p_partkey, 'other', NULL, NULL, NULL, '{{"size":' || p_size || '}}' FROM part"""

_OBJECTS = """
src AS (
  SELECT 'pre/' || c_mktsegment || '/' || c_custkey AS key, CAST(c_nationkey AS BIGINT) AS size,
         md5(c_name) AS etag, c_nationkey AS n, c_acctbal FROM customer),
dst AS (
  SELECT key, CASE WHEN n = 3 THEN size + 1 ELSE size END AS size,
         CASE WHEN n IN (4, 5) THEN 'other' ELSE etag END AS etag,
         CASE WHEN n = 5 THEN etag WHEN n = 6 THEN 'x' END AS stamp
  FROM src WHERE c_acctbal >= 0
  UNION ALL
  SELECT 'pre/SUP/' || s_suppkey, CAST(s_nationkey AS BIGINT), md5(s_name), NULL FROM supplier)"""

_SAME = """src.size = dst.size AND src.etag IS NOT DISTINCT FROM
           (CASE WHEN coalesce(stamp, '') <> '' THEN stamp ELSE dst.etag END)"""

_COPIES = f"""SELECT src.key AS key,
       CASE WHEN dst.key IS NULL THEN 'copy' WHEN {_SAME} THEN 'skip' ELSE 'copy' END AS action,
       CASE WHEN dst.key IS NULL THEN 'absent' WHEN {_SAME} THEN 'same' ELSE 'changed' END AS reason
FROM src LEFT JOIN dst ON src.key = dst.key"""

_DELETES = """SELECT dst.key AS key, 'delete' AS action, 'not in source' AS reason
FROM dst LEFT JOIN src ON src.key = dst.key WHERE src.key IS NULL"""

_V = """
v AS (SELECT p_size, p_brand, min(p_type) AS dtype, count(*) AS n FROM part GROUP BY 1, 2),
r AS (SELECT * FROM v WHERE p_size = (SELECT min(p_size) FROM part)),
q AS (SELECT v.p_size, v.p_brand, v.dtype, v.n, r.dtype AS rd, r.n AS rn, r.p_brand AS rb
      FROM v LEFT JOIN r ON v.p_brand = r.p_brand)"""

_PLACES = """
p0 AS (SELECT p_size FROM part GROUP BY 1),
p AS (SELECT p_size, 0 AS spec_no FROM p0 WHERE p_size > 25 UNION ALL SELECT p_size, 1 FROM p0),
z AS (SELECT p_size AS first FROM p ORDER BY spec_no, p_size LIMIT 1),
v AS (SELECT p_size, p_brand, min(p_type) AS dtype, count(*) AS n FROM part GROUP BY 1, 2),
r AS (SELECT v.* FROM v JOIN z ON p_size = first)"""

_FROM_NAME = f"""
n AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS granule_id, o_orderpriority AS coll,
         CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'O' THEN NULL
              ELSE strftime(o_orderdate, '%-m-%-d-%Y') END AS s,
         CASE WHEN o_totalprice > 200000 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS e
  FROM orders),
m AS (
  SELECT granule_id, coll || '_' || CASE WHEN s IS NULL AND e IS NULL THEN '' ELSE
         coalesce(s, 'beginning') || '_to_' || coalesce(e, 'present') || '_' END AS stem FROM n)"""

ORACLES = {
    "catalog_search": f"""WITH {_GRANULES}
SELECT granule_id, name, begin_s FROM g
WHERE collection = 'C1_L2' AND b < TIMESTAMP '1999-01-01' AND e >= TIMESTAMP '1997-01-15'""",

    "catalog_search_specs": f"""WITH {_GRANULES},
f AS (
  SELECT granule_id, 0 AS spec_no, search_rank FROM g WHERE collection = 'C1_L2'
     AND name GLOB 'C1_L2_*_f.nc' AND b < TIMESTAMP '1998-01-01' AND e >= TIMESTAMP '1995-01-01'
  UNION ALL
  SELECT granule_id, 1, search_rank FROM g WHERE collection = 'C1_L2'
     AND name GLOB 'C1*.nc' AND b < TIMESTAMP '2000-01-01' AND e >= TIMESTAMP '1997-01-01'
  UNION ALL
  SELECT granule_id, 2, search_rank FROM g WHERE collection = 'C2_L2' AND name GLOB '*_o.nc')
SELECT granule_id, CAST(spec_no AS BIGINT) AS spec_no,
       row_number() OVER (ORDER BY spec_no, search_rank) - 1 AS ordinal FROM f""",

    "catalog_search_many": f"""WITH {_GRANULES},
k AS (SELECT c_custkey AS spec_no, c_nationkey AS n,
             CASE WHEN c_custkey % 3 = 0 THEN 'C1_L2' ELSE 'C' || (c_custkey % 3 + 2) || '_L4' END AS coll,
             DATE '1992-01-01' + CAST(c_custkey % 2400 AS INTEGER) AS low FROM customer),
s AS (SELECT spec_no, coll, CASE WHEN spec_no % 5 = 0 THEN 'C*' || (spec_no % 100) || '_?.nc'
             ELSE coll || '_' || (spec_no % 50) || '*' END AS pattern,
             CASE WHEN n > 1 THEN low END AS low,
             CASE WHEN n < 23 THEN low + CAST(spec_no % 400 AS INTEGER) END AS high FROM k)
SELECT granule_id, CAST(spec_no AS BIGINT) AS spec_no FROM g JOIN s ON collection = coll
WHERE name GLOB pattern AND (high IS NULL OR CAST(b AS DATE) <= high)
  AND (low IS NULL OR CAST(b AS DATE) + CAST(cycle % 40 AS INTEGER) >= low)""",

    "granule_fields": f"""WITH {_GRANULES}
SELECT granule_id, begin_s, cycle, ppass, url, name AS filename, {_PROVIDER} AS provider FROM gl""",

    "coord_vars": f"""WITH {_GRANULES}
SELECT granule_id, CASE WHEN collection = 'C2_L2' THEN 'line|pixel'
       WHEN contains(collection, 'L2') THEN '' ELSE 'lat|lon|' || st END AS coords FROM g""",

    "epoch_axis": f"""WITH {_GRANULES}
SELECT granule_id, row_number() OVER (ORDER BY search_rank) - 1 AS ordinal, begin_s AS start,
       'seconds since 1970-01-01T00:00:00' AS units, 'gregorian' AS calendar FROM g""",

    "batches": f"""WITH {_GRANULES},
n AS (SELECT granule_id, url, row_number() OVER (ORDER BY search_rank) - 1 AS i FROM gl),
p AS (SELECT granule_id, i, i // 48 + 1 AS batch_no, {_PROVIDER} AS provider FROM n)
SELECT granule_id, CAST(batch_no AS BIGINT) AS batch_no,
       (SELECT CAST(ceil(count(*) / 48.0) AS BIGINT) FROM n) AS batch_total, provider,
       first_value(provider) OVER (PARTITION BY batch_no ORDER BY i) AS batch_provider FROM p""",

    "orbit_sort": f"""WITH {_GRANULES}
SELECT granule_id, row_number() OVER (ORDER BY b, search_rank) - 1 AS ordinal FROM g""",

    "sample_links": f"""WITH {_GRANULES}
SELECT 'collection' AS sample, collection, url FROM (
  SELECT *, row_number() OVER (PARTITION BY collection ORDER BY search_rank) AS k FROM gl) WHERE k <= 5
UNION ALL
SELECT 'all', collection, url FROM (
  SELECT *, row_number() OVER (ORDER BY search_rank) AS k FROM gl) WHERE k <= 3""",

    "output_names": f"""WITH {_FROM_NAME}
SELECT granule_id, stem || 'virtual_s3.json' AS s3_name, stem || 'virtual_https.json' AS https_name,
       stem || 'virtual_https.json' AS direct FROM m""",

    "dim_conflicts": """WITH d AS (
  SELECT p_partkey, p_type AS dim, CAST(CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 100
         ELSE p_size END AS BIGINT) AS size FROM part),
k AS (SELECT *, row_number() OVER (PARTITION BY dim, size ORDER BY p_partkey) AS i FROM d),
t AS (SELECT dim, size, count(*) AS n_granules,
             string_agg('s3://b-parts/' || p_partkey, ' ' ORDER BY i) FILTER (WHERE i <= 5)
             AS sample_links FROM k GROUP BY 1, 2)
SELECT dim, size, n_granules, sample_links, CAST(n_granules > 5 AS BIGINT) AS more FROM t
WHERE dim IN (SELECT dim FROM t GROUP BY dim HAVING count(*) > 1)""",

    "var_mismatch": f"""WITH {_V}
SELECT CAST(p_size AS VARCHAR) AS granule_id, p_brand AS var, 'dtype' AS kind FROM q
WHERE rb IS NOT NULL AND dtype <> rd
UNION ALL SELECT CAST(p_size AS VARCHAR), p_brand, 'shape' FROM q WHERE rb IS NOT NULL AND n <> rn
UNION ALL SELECT CAST(s.p_size AS VARCHAR), r.p_brand, 'missing'
FROM (SELECT DISTINCT p_size FROM part) s, r
WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.p_size = s.p_size AND v.p_brand = r.p_brand)""",

    "compat_gate": f"""WITH {_V},
k AS (SELECT p_size, count(rb) AS n_known, count(*) - count(rb) AS n_extra,
             count(*) FILTER (WHERE rb IS NOT NULL AND (dtype <> rd OR n <> rn)) AS n_different
      FROM q GROUP BY p_size)
SELECT CAST(p_size AS VARCHAR) AS granule_id, (SELECT count(*) FROM r) - n_known AS n_missing, n_extra,
       n_different, CAST(0 AS BIGINT) AS n_ragged FROM k
WHERE (SELECT count(*) FROM r) - n_known + n_extra + n_different > 0""",

    "dim_conflicts_places": """WITH d AS (
  SELECT p_partkey, p_type AS dim, CASE WHEN p_size > 25 THEN 0 ELSE 1 END AS spec,
         CAST(CASE WHEN p_type IN ('SMALL', 'LARGE') THEN 100 ELSE p_size END AS BIGINT) AS size FROM part),
k AS (SELECT *, row_number() OVER (PARTITION BY dim, size ORDER BY spec, p_partkey) AS i FROM d),
t AS (SELECT dim, size, count(*) AS n_granules,
             string_agg('s3://b-parts/' || p_partkey || '.nc', ' ' ORDER BY i) FILTER (WHERE i <= 3)
             AS sample_links FROM k GROUP BY 1, 2)
SELECT dim, size, n_granules, sample_links, CAST(n_granules > 3 AS BIGINT) AS more FROM t
WHERE dim IN (SELECT dim FROM t GROUP BY dim HAVING count(*) > 1)""",

    "mismatch_values": f"""WITH {_PLACES},
q AS (SELECT v.p_size, v.p_brand, v.dtype, v.n, r.dtype AS rd, r.n AS rn, r.p_brand AS rb
      FROM v LEFT JOIN r ON v.p_brand = r.p_brand),
m AS (
  SELECT p_size, p_brand, 'dtype' AS kind, '"' || rd || '"' AS expected, '"' || dtype || '"' AS found
  FROM q WHERE rb IS NOT NULL AND dtype <> rd
  UNION ALL SELECT p_size, p_brand, unnest(['shape', 'chunks']), '[' || rn || ']', '[' || n || ']'
  FROM q WHERE rb IS NOT NULL AND n <> rn
  UNION ALL SELECT p_size, p_brand, 'extra', NULL, '"' || dtype || '" [' || n || ']' FROM q WHERE rb IS NULL
  UNION ALL SELECT p0.p_size, r.p_brand, 'missing', '"' || r.dtype || '" [' || r.n || ']', NULL
  FROM p0, r WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.p_size = p0.p_size AND v.p_brand = r.p_brand))
SELECT CAST(p_size AS VARCHAR) AS granule_id, CAST(spec_no AS BIGINT) AS spec_no,
       CAST(p_size AS BIGINT) AS search_rank, p_brand AS var, kind, expected, found,
       's3://b-parts/' || p_size || '.nc' AS url, 's3://b-parts/' || first || '.nc' AS first_url
FROM m JOIN p USING (p_size), z""",

    "compat_places": f"""WITH {_PLACES},
q AS (SELECT v.p_size, v.n, r.p_brand AS rb, v.dtype <> r.dtype AS other
      FROM v LEFT JOIN r ON v.p_brand = r.p_brand),
k AS (SELECT p_size, count(rb) AS n_known, count(*) - count(rb) AS n_extra,
             count(*) FILTER (WHERE other) AS n_different, count(*) FILTER (WHERE n % 2 = 1) AS odd
      FROM q GROUP BY p_size),
w AS (SELECT *, row_number() OVER (ORDER BY spec_no DESC, p_size DESC) AS back FROM p),
t AS (SELECT CAST(p_size AS VARCHAR) AS granule_id, CAST(spec_no AS BIGINT) AS spec_no,
             CAST(p_size AS BIGINT) AS search_rank, (SELECT count(*) FROM r) - n_known AS n_missing,
             n_extra, n_different, CASE WHEN back = 1 THEN 0 ELSE odd END AS n_ragged
      FROM w JOIN k USING (p_size))
SELECT * FROM t WHERE n_missing + n_extra + n_different + n_ragged > 0""",

    "attrs_merge": """WITH m AS (
  SELECT 'a' || p_size AS key,
         CASE WHEN p_size % 2 = 0 THEN '"const"' ELSE '"' || p_type || '"' END AS v FROM part)
SELECT '' AS scope, key, CASE WHEN count(DISTINCT v) = 1 THEN min(v) END AS value_json,
       CAST(count(DISTINCT v) > 1 AS BIGINT) AS dropped FROM m GROUP BY key""",

    "combine_existing": _existing(),
    "combine_coords": f"""{_existing()}
UNION ALL SELECT unnest(['aux/0', 'lat2/0.0']), 's3://b/' || granule_id || '.nc', "offset", length
FROM a JOIN o USING (granule_id) WHERE ord = 0""",
    "combine_shapes": """WITH s AS (
  SELECT max(l_linenumber) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey),
t AS (SELECT CAST(CAST(sum(n) AS BIGINT) AS VARCHAR) AS n FROM s)
SELECT 'var' AS kind, unnest(['v_F', 'v_O']) AS name, 'time' AS dims, n AS sizes, CAST(0 AS BIGINT) AS is_coord FROM t
UNION ALL SELECT 'var', 'm_total', 'time|y', n || '|4', 0 FROM t
UNION ALL SELECT 'var', unnest(['lat', 'aux']), 'y', '4', 1
UNION ALL SELECT 'var', 'lat2', 'y|x', '4|3', 1
UNION ALL SELECT 'dim', 'time', NULL, n, NULL FROM t""",
    "combine_attrs": """SELECT '' AS scope, 'title' AS key, '"orders"' AS value_json FROM orders
HAVING count(*) > 0
UNION ALL SELECT '', 'status', '["' || min(o_orderstatus) || '"]' FROM orders
HAVING count(DISTINCT o_orderstatus) = 1
UNION ALL SELECT 'orbit_segment_start_time', 'units', '"seconds since 1970-01-01T00:00:00"'
UNION ALL SELECT 'orbit_segment_start_time', 'calendar', '"gregorian"'""",
    "combine_seconds": _new_axis(),
    "combine_sorted": _new_axis("b, search_rank"),
    "combine_granule": _new_axis(
        more=", begin_s AS orbit_s, cycle, ppass, name AS filename"),
    "subset_by_start": f"""SELECT key, url, "offset", length FROM (
{_new_axis(more=', begin_s, collection, b, e')}) AS t
WHERE key = 'crs/0' OR begin_s IN (
  SELECT CAST(epoch(o_orderdate) AS BIGINT) FROM orders
  WHERE substr(o_orderpriority, 1, 1) = '1' AND o_orderdate < TIMESTAMP '1997-07-01'
    AND o_orderdate + INTERVAL 6 HOUR >= TIMESTAMP '1997-01-01')""",

    "url_translate": f"""WITH {_URLS}
SELECT url, {_https("url")} AS by_table, {_https("url")} AS by_map FROM u""",
    "text_rewrite": f"""WITH {_TEXTS}, {_rewritten("x", "text")}
SELECT key, md5(t) AS rewritten FROM t{len(b.BUCKETS)}""",
    "refs_rewrite": _REFS,
    "refs_json_roundtrip": _REFS,
    "refs_parquet_roundtrip": _existing(),
    "refs_records_roundtrip": _existing(),

    "array_read": """SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(i AS BIGINT) AS at,
       CAST(embedding[i + 1] AS DOUBLE) AS value
FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS i FROM embeddings)""",

    "array_slice": """SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(i AS BIGINT) AS at,
       CAST(embedding[i + 1] AS DOUBLE) AS value
FROM (SELECT vec_id, embedding, unnest(range(len(embedding))) AS i FROM embeddings WHERE vec_id >= 100)
WHERE i BETWEEN 3 AND 17""",

    "refs_json_foreign": r"""SELECT 'd"{\/' || doc_id AS key, 'inline' AS kind, NULL AS url, NULL AS tail_json,
       text AS inline_text, NULL AS other_json FROM documents
UNION ALL SELECT 'p/' || page_id, 'ref', url, '[0,' || length(html) || ']', NULL, NULL FROM pages
UNION ALL SELECT 'z', 'other', NULL, NULL, NULL, '{"a":[]}'""",
    "zarr_manifest": """SELECT CAST(vec_id // 256 AS VARCHAR) AS granule_id,
       'emb/' || CAST(vec_id % 256 // 128 AS VARCHAR) || '.0' AS key, CAST(0 AS BIGINT) AS "offset",
       CAST(128 * 4 * max(len(embedding)) AS BIGINT) AS length
FROM embeddings GROUP BY vec_id // 256, vec_id % 256 // 128""",

    "top_folders": f"""WITH {_OBJECTS}
SELECT DISTINCT split_part(key, '/', 2) AS collection FROM dst""",
    "inventory": f"""WITH {_OBJECTS},
f AS (SELECT split_part(key, '/', 2) AS collection, 1 AS one, 0 AS two FROM src
      UNION ALL SELECT split_part(key, '/', 2), 0, 1 FROM dst)
SELECT collection, CASE WHEN sum(one) > 0 THEN 'Yes' ELSE 'No' END AS one,
       CASE WHEN sum(two) > 0 THEN 'Yes' ELSE 'No' END AS two FROM f GROUP BY collection""",

    "sync_plan_copy": f"WITH {_OBJECTS} {_COPIES}",
    "sync_plan_sync": f"WITH {_OBJECTS} {_COPIES} UNION ALL {_DELETES}",
    "sync_plan_upload": f"WITH {_OBJECTS} SELECT * FROM ({_COPIES}) "
                        "WHERE starts_with(key, 'pre/BUILDING/')",
    "sync_plan_delete": f"WITH {_OBJECTS} SELECT key, 'delete' AS action, 'in folder' AS reason "
                        "FROM dst WHERE starts_with(key, 'pre/SUP/')",
    "sync_summary": f"""WITH {_OBJECTS},
p AS ({_COPIES} UNION ALL {_DELETES}),
d AS (SELECT count(*) AS n FROM p WHERE action = 'delete')
SELECT CAST(200 AS BIGINT) AS status, CAST(NULL AS VARCHAR) AS message,
       count(*) FILTER (WHERE action = 'copy') AS copied,
       count(*) FILTER (WHERE action = 'skip') AS skipped,
       count(*) FILTER (WHERE action = 'delete') AS deleted, 'sync' AS mode,
       (SELECT CAST(ceil(n / 50.0) AS BIGINT) FROM d) AS batches,
       (SELECT least(n, 50) FROM d) AS largest FROM p
UNION ALL
SELECT 400, 'Missing ''folder'' for upload_folder mode', 0, 0, 0, 'upload_folder',
       (SELECT CAST(ceil(n / 50.0) AS BIGINT) FROM d), (SELECT least(n, 50) FROM d)""",

    "sync_run": """WITH o AS (
  SELECT doc_id // 20 AS k, CAST(sum(strlen(text)) + count(*) - 1 AS BIGINT) AS size FROM documents GROUP BY 1)
SELECT 'first' AS run, 'out/' || (k // 100) || '/' || k || '.txt' AS key, 'copy' AS action, size FROM o
UNION ALL SELECT 'first', 'out/' || (k // 100) || '/gone-' || k || '.txt', 'delete', NULL FROM o WHERE k % 5 = 0
UNION ALL SELECT 'second', 'out/' || (k // 100) || '/' || k || '.txt', 'skip', size FROM o""",

    "guard_status": f"""WITH {_GRANULES},
w AS (SELECT unnest(['C1_L2', 'C3_L4', 'absent']) AS collection),
k AS (SELECT w.collection, count(g.granule_id) AS n FROM w LEFT JOIN g USING (collection) GROUP BY 1)
SELECT collection, CASE WHEN n = 0 THEN 'empty' ELSE 'ok' END AS status,
       CASE WHEN n = 0 THEN 'no granules found' END AS reason, n AS granules, n AS links FROM k""",

    "append_batch": _existing(f"b >= TIMESTAMP '{b.SPLIT_DAY}', search_rank"),
    "append_many": _existing("search_rank % 5, search_rank"),
    "append_stream": _new_axis(f"b >= TIMESTAMP '{b.SPLIT_DAY}', search_rank"),
}
