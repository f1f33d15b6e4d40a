"""The registered queries in plain SQL, by other means than the Spark jobs where there are any."""

from __future__ import annotations

OBS = """obs AS (
  SELECT event_id, user_id, ts, event_type, 'h' || user_id || '.' || event_type || '.' || public_suffix AS fqdn,
         event_type || '.' || public_suffix AS apex, public_suffix, tld
  FROM (SELECT *, CASE event_id % 3 WHEN 0 THEN 'co.uk' WHEN 1 THEN 'com' ELSE 'org' END AS public_suffix,
               CASE event_id % 3 WHEN 0 THEN 'uk' WHEN 1 THEN 'com' ELSE 'org' END AS tld FROM events))"""

SNAPROWS = """snaprows AS (
  SELECT *, 'd' || user_id || '.' || tld AS domain
  FROM (SELECT event_id, user_id, event_type, ts, CAST(ts AS DATE) AS snapshot_date,
               CASE event_id % 3 WHEN 0 THEN 'com' WHEN 1 THEN 'net' ELSE 'org' END AS tld FROM events))"""

SNAP = SNAPROWS + """, snap AS (SELECT DISTINCT tld, snapshot_date, domain FROM snaprows)"""

HOST = """host AS (SELECT page_id, url, split_part(url, '/', 3) AS host FROM pages)"""

CERT = """cert AS (
  SELECT text AS raw, sha256(text) AS sha256_fingerprint, doc_id AS index, source AS log_url, 'log ' || source AS description,
         doc_id % 2 = 0 AS is_precert, TIMESTAMP '2024-01-01' + doc_id * INTERVAL 1 MINUTE AS ts,
         's' || doc_id % 50 || '.' || lang || '.com' AS site,
         -- de.com is a suffix on the list's private part, the others are plain names
         CASE lang WHEN 'de' THEN 'de.com' ELSE 'com' END AS suffix,
         CASE lang WHEN 'de' THEN 's' || doc_id % 50 || '.de.com' ELSE lang || '.com' END AS apex FROM documents),
  certname AS (SELECT *, unnest([site, 'www.' || site]) AS dns_name FROM cert)"""

# every pair of neighbouring snapshots, compared by set difference
EVENTS = SNAP + """,
  cal AS (SELECT tld, snapshot_date, lead(snapshot_date) OVER (PARTITION BY tld ORDER BY snapshot_date) AS next_date,
                 min(snapshot_date) OVER (PARTITION BY tld) AS first_date
          FROM (SELECT DISTINCT tld, snapshot_date FROM snap)),
  cur AS (SELECT s.tld, s.domain, c.next_date AS d FROM snap s JOIN cal c USING (tld, snapshot_date) WHERE c.next_date IS NOT NULL),
  nxt AS (SELECT s.tld, s.domain, s.snapshot_date AS d FROM snap s JOIN cal c USING (tld, snapshot_date)
          WHERE s.snapshot_date > c.first_date),
  diff AS (
    SELECT s.tld, s.domain, 'FIRST_SEEN' AS event_type, s.snapshot_date FROM snap s JOIN cal c USING (tld, snapshot_date)
    WHERE s.snapshot_date = c.first_date
    UNION ALL SELECT tld, domain, 'REGISTRATION', d FROM (SELECT * FROM nxt EXCEPT SELECT * FROM cur)
    UNION ALL SELECT tld, domain, 'EXPIRATION', d FROM (SELECT * FROM cur EXCEPT SELECT * FROM nxt))"""


def numbered(name: str, rows: str, first: str = "1") -> str:
    """Ids in order of hash bucket, then name."""
    return (
        f"SELECT *, CAST({first} - 1 + row_number() OVER (ORDER BY substr(md5({name}), 1, 4), {name}) AS BIGINT) AS id "
        f"FROM ({rows})"
    )


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


SPELLED_PARTS = f"""WITH {OBS}, {HOST}, parts AS (
  SELECT 'events' AS origin, event_id AS id,
         CASE WHEN event_id % 6 = 3 THEN '' ELSE tld END AS tld,
         CASE WHEN event_id % 6 = 3 THEN '' ELSE public_suffix END AS public_suffix,
         CASE WHEN event_id % 6 = 3 THEN tld || '.' ELSE apex END AS apex,
         CASE WHEN event_id % 6 = 3 THEN '.' || fqdn || '.' ELSE fqdn END AS fqdn FROM obs
  UNION ALL
  SELECT 'pages', page_id, regexp_extract(host, '[a-z]+$'), regexp_extract(host, '[a-z]+$'),
         regexp_extract(host, 'example[.][a-z]+$'), host FROM host)"""

ADDRESSES = OBS + """, addressed AS (
  SELECT *, CASE event_id % 4 WHEN 0 THEN fqdn WHEN 1 THEN '10.' || user_id % 300 || '.' || event_id % 256 || '.1'
                 WHEN 2 THEN '2001:db8::' || user_id % 10000 ELSE '1.2.3.' || fqdn END AS name,
         CASE event_id % 4 WHEN 1 THEN user_id % 300 <= 255 WHEN 2 THEN true ELSE false END AS is_ip FROM obs)"""

FLAGGED = "SELECT *, event_type = 'error' AS anonymous FROM obs"


def _batch(level: str) -> str:
    return (
        f"WITH {OBS} SELECT {level}, bool_or(NOT anonymous) AS create_plain, bool_or(anonymous) AS create_anon "
        f"FROM ({FLAGGED}) GROUP BY {level}"
    )


def _stored(name: str) -> str:
    source = "obs" if name != "fqdn_anon" else "(SELECT *, sha256(fqdn || '4') AS fqdn_anon FROM obs)"
    old = f"SELECT DISTINCT {name} FROM {source} WHERE ts < TIMESTAMP '2024-01-15'"
    new = f"SELECT DISTINCT {name} FROM {source} WHERE ts >= TIMESTAMP '2024-01-15'"
    return f"WITH {OBS}, stored AS ({numbered(name, old)}), batch AS ({new})"


def _lookup(name: str) -> str:
    return f"{_stored(name)} SELECT b.{name}, coalesce(s.id, 0) AS found_id FROM batch b LEFT JOIN stored s USING ({name})"


def _new(name: str) -> str:
    fresh = f"SELECT {name} FROM batch b WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.{name} = b.{name})"
    return f"{_stored(name)} SELECT {name}, id FROM ({numbered(name, fresh, '1 + (SELECT coalesce(max(id), 0) FROM stored)')})"


def _ids(alias: str, name: str, rows: str) -> str:
    return f"{alias} AS ({numbered(name, rows)})"


LEVEL_IDS = ", ".join([
    _ids("tlds", "tld", "SELECT DISTINCT tld FROM obs"),
    _ids("public_suffixes", "public_suffix", "SELECT DISTINCT public_suffix FROM obs"),
    _ids("apexes", "apex", "SELECT DISTINCT apex FROM obs"),
    _ids("fqdns", "fqdn", "SELECT DISTINCT fqdn, tld, public_suffix, apex FROM obs"),
])

STORED_LOG = "SELECT * FROM cert WHERE ts < TIMESTAMP '2024-01-01 03:00:00'"
HEADS = "heads AS (SELECT log_url, max(index) + 1 AS tree_size FROM cert GROUP BY log_url)"


def _first_after(time: str, log: str) -> str:
    return (
        f"coalesce((SELECT min(c.index) FROM cert c WHERE c.log_url = {log}.log_url AND c.ts > TIMESTAMP '{time}'), "
        f"{log}.tree_size)"
    )


WINDOW = f"""{HEADS}, found AS (SELECT log_url, tree_size, {_first_after('2024-01-01 01:00:00', 'heads')} AS from_index,
  {_first_after('2024-01-01 06:00:00', 'heads')} AS to_index FROM heads)"""

STAGES = """numbered AS (SELECT o_custkey AS measurement_id, o_orderkey AS seq, o_orderdate AS start_time,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS stage FROM orders)"""

# what the four sources bring into the store
ALL_NAMES = f"""{OBS}, {CERT}, {EVENTS},
  plain AS (
    SELECT tld, public_suffix, apex, fqdn FROM obs
    UNION SELECT tld, tld, domain, domain FROM diff
    UNION SELECT 'com', suffix, apex, dns_name FROM certname),
  hidden AS (SELECT DISTINCT tld, public_suffix, apex, fqdn FROM obs)"""


def _table_counts() -> str:
    rows = []
    tables = {"tlds": "tld", "public_suffixes": "public_suffix", "apexes": "apex", "fqdns": "fqdn"}
    for table, level in tables.items():
        rows += [
            f"SELECT '{table}' AS table_name, count(DISTINCT {level}) AS n FROM plain",
            f"SELECT '{table}_anon', count(DISTINCT {level}) FROM hidden",
            f"SELECT '{table}_anon_links', count(DISTINCT {level}) FROM hidden WHERE {level} IN (SELECT {level} FROM plain)",
        ]
    rows += [
        "SELECT 'certificates', count(DISTINCT sha256_fingerprint) FROM cert",
        "SELECT 'certificate_to_fqdns', count(*) FROM (SELECT DISTINCT sha256_fingerprint, dns_name FROM certname)",
        "SELECT 'log_entries', count(*) FROM cert",
        "SELECT 'logs', count(DISTINCT log_url) FROM cert",
        "SELECT 'zonefile_entries', count(*) FROM diff",
        "SELECT 'passive_entries', count(*) FROM obs",
        "SELECT 'entrada_entries', count(DISTINCT fqdn) FROM obs",
    ]
    return f"WITH {ALL_NAMES} " + " UNION ALL ".join(rows)


def _hits() -> str:
    levels = [
        f"SELECT '{kind}' AS type, {level} AS name, date_trunc('hour', ts) AS hour FROM obs"
        for level, kind in (("tld", "tld"), ("public_suffix", "public-suffix"), ("apex", "apex"), ("fqdn", "fqdn"))
    ]
    return f"""WITH {OBS}, seen AS (SELECT DISTINCT * FROM ({' UNION ALL '.join(levels)})),
      firsts AS (SELECT type, name, min(hour) AS first FROM seen GROUP BY type, name)
      SELECT (epoch_us(s.hour) // 1000) AS interval_ms, CASE WHEN s.hour = f.first THEN 'db-insert' ELSE 'db-hit' END AS status,
             s.type, CAST(count(*) AS BIGINT) AS n
      FROM seen s JOIN firsts f USING (type, name) GROUP BY ALL"""


def _batch_points() -> str:
    levels = ("tld", "public_suffix", "apex", "fqdn")
    suffixes = {"tld": "'com'", "public_suffix": "suffix", "apex": "apex", "fqdn": "dns_name"}
    zoned = {"tld": "tld", "public_suffix": "tld", "apex": "domain", "fqdn": "domain"}
    plain = " UNION ALL ".join(
        f"SELECT '{x.replace('_', '-')}' AS type, {x} AS name, ts >= TIMESTAMP '2024-01-15' AS late FROM obs "
        f"UNION ALL SELECT '{x.replace('_', '-')}', {suffixes[x]}, true FROM certname "
        f"UNION ALL SELECT '{x.replace('_', '-')}', {zoned[x]}, true FROM diff" for x in levels)
    anon = " UNION ALL ".join(f"SELECT '{x.replace('_', '-')}-anon' AS type, count(DISTINCT {x}) AS n FROM obs" for x in levels)
    return f"""WITH {OBS}, {CERT}, {EVENTS}, names AS (
      SELECT type, name, bool_or(late) AS late, bool_or(NOT late) AS early FROM ({plain}) GROUP BY type, name),
      hits AS (
        SELECT 'db-insert' AS status, type, count(*) AS n FROM names GROUP BY type
        UNION ALL SELECT 'db-hit', type, count(*) FROM names WHERE late AND early GROUP BY type
        UNION ALL SELECT 'db-insert', type, n FROM ({anon})
        UNION ALL SELECT 'db-insert', 'passive-entry', count(*) FROM obs
        UNION ALL SELECT 'db-insert', 'entrada-entry', count(DISTINCT fqdn) FROM obs
        UNION ALL SELECT 'db-insert', 'zone-entry', count(*) FROM diff
        UNION ALL SELECT 'db-insert', 'cert', count(DISTINCT sha256_fingerprint) FROM cert
        UNION ALL SELECT 'db-insert', 'log', count(DISTINCT log_url) FROM cert)
      SELECT 'store-hits' AS name, status, type, '-' AS key, n FROM hits
      UNION ALL SELECT 'log-entries', '-', '-', log_url, count(*) FROM cert GROUP BY log_url
      UNION ALL SELECT 'zone-entries', '-', '-', tld, count(*) FROM diff GROUP BY tld"""


SIGHTINGS = f"""{CERT}, {SNAPROWS}, sightings AS (
  SELECT CASE event_type WHEN 'signup' THEN 'zone' WHEN 'view' THEN 'zone' WHEN 'click' THEN 'passive'
              WHEN 'purchase' THEN 'ct' ELSE 'entrada' END AS source, domain AS apex, ts FROM snaprows
  UNION ALL SELECT 'ct', apex, ts FROM certname)"""

ORACLES: dict[str, str] = {
    "normalize_fqdn": f"{SPELLED_PARTS} SELECT origin, id, fqdn FROM parts",
    "domain_parts": f"{SPELLED_PARTS} SELECT origin, id, tld, public_suffix, apex, fqdn FROM parts",
    "ip_reject": f"WITH {ADDRESSES} SELECT event_id, name, is_ip FROM addressed",
    "url_regex_extract": f"""WITH {HOST} SELECT page_id, CASE WHEN page_id % 2 = 0 THEN split_part(host, '.', -1)
        ELSE 'none' END AS tld FROM host""",
    "anonymize_levels": f"""WITH {OBS} SELECT event_id, sha256(tld || '1') AS tld_anon, sha256(public_suffix || '2') AS
        public_suffix_anon, sha256(apex || '3') AS apex_anon, sha256(fqdn || '4') AS fqdn_anon FROM obs""",
    "anonymize_identity": f"""WITH {OBS} SELECT event_id, tld AS tld_anon, public_suffix AS public_suffix_anon,
        apex AS apex_anon, fqdn AS fqdn_anon FROM obs""",
    "unix_ms_to_ts": "SELECT event_id, strftime(date_trunc('milliseconds', ts), '%Y-%m-%d %H:%M:%S.%g') AS ts FROM events",
    "ts_to_unix_ms": "SELECT event_id, (epoch_us(ts) // 1000) AS unix_ms FROM events",
    "passive_shift": "SELECT event_id, (epoch_us(ts + INTERVAL 24 HOUR) // 1000) AS shifted_ms FROM events",
    "passive_scan": f"""WITH {OBS} SELECT event_id, unnest(CASE WHEN event_id % 6 IN (0, 3) THEN [fqdn]
        WHEN event_id % 6 IN (1, 4) THEN [fqdn, apex] ELSE [] END) AS query, (epoch_us(ts) // 1000) AS ts_ms FROM obs""",
    "zone_rr_domains": f"""WITH {SNAPROWS} SELECT DISTINCT tld, {_day('snapshot_date')} AS snapshot_date, domain
        FROM snaprows WHERE user_id % 4 <> 3 AND event_id % 50 <> 0""",
    "snapshot_date_filter": f"""WITH {SNAP} SELECT tld, {_day('snapshot_date')} AS snapshot_date, domain FROM snap
        WHERE snapshot_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-15'""",
    "snapshot_distinct": f"WITH {SNAP} SELECT tld, {_day('snapshot_date')} AS snapshot_date, domain FROM snap",
    "snapshot_counts": f"""WITH {SNAP}, files AS (SELECT tld, snapshot_date, count(*) AS n FROM snap GROUP BY ALL)
        SELECT tld, count(DISTINCT snapshot_date) AS n_snapshots, CAST(sum(n) AS BIGINT) AS n_entries,
               max(n) AS largest_snapshot FROM files GROUP BY tld""",
    "zone_diff_events": f"WITH {EVENTS} SELECT tld, domain, event_type, {_day('snapshot_date')} AS snapshot_date FROM diff",
    "zone_diff_counts": f"""WITH {EVENTS} SELECT tld, {_day('snapshot_date')} AS snapshot_date, event_type, count(*) AS n
        FROM diff GROUP BY ALL""",
    "snapshot_compare": f"""WITH {SNAP}, a AS (SELECT domain FROM snap WHERE snapshot_date = DATE '2024-01-10'),
        b AS (SELECT domain FROM snap WHERE snapshot_date = DATE '2024-01-20')
        SELECT domain, 'only_a' AS side FROM (FROM a EXCEPT FROM b)
        UNION ALL SELECT domain, 'only_b' FROM (FROM b EXCEPT FROM a)""",
    "zone_event_columns": f"""WITH {EVENTS} SELECT tld, domain, event_type,
        CASE event_type WHEN 'REGISTRATION' THEN {_day('snapshot_date')} ELSE 'none' END AS registered,
        CASE event_type WHEN 'EXPIRATION' THEN {_day('snapshot_date')} ELSE 'none' END AS expired FROM diff""",
    "zone_fact": f"""WITH {EVENTS}, {_ids('apexes', 'apex', 'SELECT DISTINCT domain AS apex FROM snap')}
        SELECT a.id AS apex_id,
        CASE event_type WHEN 'REGISTRATION' THEN {_day('snapshot_date')} ELSE 'none' END AS registered,
        CASE event_type WHEN 'EXPIRATION' THEN {_day('snapshot_date')} ELSE 'none' END AS expired
        FROM diff JOIN apexes a ON a.apex = diff.domain""",
    "domain_lifetime": f"""WITH {EVENTS} SELECT s.tld, s.domain, {_day('s.snapshot_date')} AS start_date,
        coalesce((SELECT {_day('min(e.snapshot_date)')} FROM diff e WHERE e.tld = s.tld AND e.domain = s.domain
                  AND e.event_type = 'EXPIRATION' AND e.snapshot_date > s.snapshot_date), 'none') AS end_date,
        s.event_type = 'REGISTRATION' AS known_start FROM diff s WHERE s.event_type <> 'EXPIRATION'""",
    "tld_selection": f"""WITH {OBS}, {SNAP}, {HOST} SELECT tld FROM (SELECT tld FROM snap UNION SELECT tld FROM obs)
        WHERE tld NOT IN (SELECT split_part(host, '.', -1) FROM host WHERE host LIKE '%.net')""",
    "resume_anti": f"""WITH {SNAP}, {HOST} SELECT tld, {_day('snapshot_date')} AS snapshot_date, domain FROM snap
        WHERE tld NOT IN (SELECT split_part(host, '.', -1) FROM host WHERE host NOT LIKE '%.com')""",
    "batch_distinct_fqdn": _batch("fqdn"),
    "batch_distinct_apex": _batch("apex"),
    "batch_distinct_suffix": _batch("public_suffix"),
    "batch_distinct_tld": _batch("tld"),
    "dim_lookup_fqdn": _lookup("fqdn"),
    "dim_lookup_apex": _lookup("apex"),
    "dim_lookup_suffix": _lookup("public_suffix"),
    "dim_lookup_tld": _lookup("tld"),
    "dim_lookup_anon": _lookup("fqdn_anon"),
    "dim_new_rows": _new("fqdn"),
    "dim_new_rows_anon": _new("fqdn_anon"),
    "dim_hierarchy": f"""WITH {OBS}, {LEVEL_IDS} SELECT f.id, f.fqdn, t.id AS tld_id, p.id AS public_suffix_id,
        a.id AS apex_id FROM fqdns f JOIN tlds t USING (tld) JOIN public_suffixes p USING (public_suffix)
        JOIN apexes a USING (apex)""",
    "next_ids": f"WITH {OBS} " + " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(DISTINCT {level}) + 1 AS next_id FROM obs"
        for table, level in (("tlds", "tld"), ("public_suffixes", "public_suffix"), ("apexes", "apex"), ("fqdns", "fqdn"))
    ),
    "dim_first_n": f"WITH {OBS}, {LEVEL_IDS} SELECT id, fqdn FROM fqdns ORDER BY id LIMIT 100",
    "anon_links": f"""WITH {OBS}, {_ids('fqdns', 'fqdn', 'SELECT DISTINCT fqdn FROM obs WHERE event_id % 4 <> 0')},
        pseudonyms AS (SELECT DISTINCT fqdn FROM obs WHERE event_id % 4 = 0)
        SELECT sha256(p.fqdn || '4') AS fqdn, coalesce(f.id, 0) AS plain_fqdn_id FROM pseudonyms p LEFT JOIN fqdns f USING (fqdn)""",
    "passive_fact": f"WITH {OBS}, {LEVEL_IDS} SELECT f.id AS fqdn_id, (epoch_us(o.ts) // 1000) AS ts_ms FROM obs o JOIN fqdns f USING (fqdn)",
    "qname_first_last": f"""WITH {OBS} SELECT fqdn AS qname, min(epoch_us(ts) // 1000000) AS min_unixtime,
        max(epoch_us(ts) // 1000000) AS max_unixtime FROM obs GROUP BY fqdn""",
    "entrada_window": f"""WITH {OBS} SELECT fqdn AS qname, min(epoch_us(ts) // 1000000) AS min_unixtime,
        max(epoch_us(ts) // 1000000) AS max_unixtime FROM obs
        WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY fqdn""",
    "entrada_page": f"""WITH {OBS} SELECT fqdn AS qname, min(epoch_us(ts) // 1000000) AS min_unixtime,
        max(epoch_us(ts) // 1000000) AS max_unixtime FROM obs GROUP BY fqdn ORDER BY qname LIMIT 500 OFFSET 200""",
    "entrada_fact": f"""WITH {OBS}, anon AS (SELECT sha256(fqdn || '4') AS fqdn_anon,
          1000 * min(epoch_us(ts) // 1000000) AS first_ms, 1000 * max(epoch_us(ts) // 1000000) AS last_ms FROM obs GROUP BY fqdn)
        SELECT id AS fqdn_id, first_ms, last_ms FROM ({numbered('fqdn_anon', 'SELECT * FROM anon')})""",
    "entrada_offset": f"WITH {OBS} SELECT count(DISTINCT fqdn) AS resume_offset FROM obs",
    "cert_dedup": f"""WITH {CERT} SELECT sha256_fingerprint, CAST(max(octet_length(encode(raw))) AS BIGINT) AS n_bytes FROM cert
        GROUP BY sha256_fingerprint""",
    "cert_names": f"WITH {CERT} SELECT index, dns_name FROM certname",
    "cert_to_fqdn": f"""WITH {CERT}, {_ids('fqdns', 'dns_name', 'SELECT DISTINCT dns_name FROM certname')},
        {_ids('certs', 'sha256_fingerprint', 'SELECT DISTINCT sha256_fingerprint FROM cert')}
        SELECT DISTINCT f.id AS fqdn_id, c.id AS certificate_id FROM certname n JOIN fqdns f USING (dns_name)
        JOIN certs c USING (sha256_fingerprint)""",
    "log_dim": f"WITH {CERT} SELECT id, url, description FROM ({numbered('url', 'SELECT DISTINCT log_url AS url, description FROM cert')})",
    "log_entry_fact": f"""WITH {CERT}, {_ids('logs', 'log_url', 'SELECT DISTINCT log_url FROM cert')},
        {_ids('certs', 'sha256_fingerprint', 'SELECT DISTINCT sha256_fingerprint FROM cert')}
        SELECT e.index, (epoch_us(e.ts) // 1000) AS ts_ms, e.is_precert, c.id AS certificate_id, l.id AS log_id
        FROM cert e JOIN certs c USING (sha256_fingerprint) JOIN logs l USING (log_url)""",
    "ct_resume_index": f"""WITH {CERT} SELECT l.log_url, coalesce(max(s.index) + 1, 0) AS resume_index
        FROM (SELECT DISTINCT log_url FROM cert) l LEFT JOIN ({STORED_LOG}) s USING (log_url) GROUP BY l.log_url""",
    "ct_index_by_date": f"WITH {CERT}, {WINDOW} SELECT log_url, from_index, to_index FROM found",
    "ct_index_range": f"""WITH {CERT}, {WINDOW}, stored AS ({STORED_LOG}) SELECT c.log_url, c.index FROM cert c JOIN found f USING (log_url)
        WHERE c.index >= f.from_index AND c.index < f.to_index AND c.index < f.tree_size
          AND c.index >= coalesce((SELECT max(s.index) + 1 FROM stored s WHERE s.log_url = c.log_url), 0)""",
    "ct_scan_from_time": f"""WITH {CERT}, {HEADS}, start AS (SELECT log_url, {_first_after('2024-01-01 02:00:00', 'heads')}
        AS start_index FROM heads) SELECT c.log_url, c.index FROM cert c JOIN start USING (log_url) WHERE c.index >= start_index""",
    "log_list_filter": """SELECT DISTINCT 'all' AS mode, source AS url FROM documents WHERE source NOT IN ('src1', 'src2', 'src3')
        UNION ALL SELECT DISTINCT 'some', source FROM documents WHERE source IN ('src1', 'src2', 'src3')""",
    "stage_numbers": f"WITH {STAGES} SELECT measurement_id, seq, stage FROM numbered",
    "stage_intervals": f"""WITH {STAGES} SELECT measurement_id, stage, (epoch_us(start_time) // 1000) AS start_ms,
        coalesce((epoch_us(lead(start_time) OVER (PARTITION BY measurement_id ORDER BY stage)) // 1000), 0) AS stop_ms FROM numbered""",
    "stage_lookup": """SELECT CAST(c_custkey AS VARCHAR) AS customer, count(o_orderkey) AS stage_id
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
    "ingest_rejects": f"""WITH {ADDRESSES} SELECT 'passive' AS source, reason, name AS payload, count(*) AS n FROM (
          SELECT name, CASE WHEN event_id % 7 IN (0, 1) THEN 'missing run id' WHEN event_id % 7 = 2 THEN 'no active stage'
                            WHEN is_ip THEN 'name is an IP address' END AS reason FROM addressed)
        WHERE reason IS NOT NULL GROUP BY reason, name""",
    "ingest_table_counts": _table_counts(),
    "ingest_metrics": _batch_points(),
    "zone_rounds": f"""WITH {OBS} SELECT DISTINCT CAST(CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 1 ELSE 2 END AS BIGINT) AS stage, apex,
        CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 1 ELSE 2 END AS stop_hour FROM obs""",
    "metrics_store_hits": _hits(),
    "metrics_log_entries": f"""WITH {CERT} SELECT (epoch_us(date_trunc('hour', ts)) // 1000) AS interval_ms, log_url, count(*) AS n
        FROM cert GROUP BY ALL""",
    "metrics_zone_entries": f"""WITH {EVENTS} SELECT (epoch_us(CAST(snapshot_date AS TIMESTAMP)) // 1000) AS interval_ms, tld, count(*) AS n
        FROM diff GROUP BY ALL""",
    "stream_zone_ingest": f"""WITH {OBS} SELECT apex, count(*) AS n,
        count(*) FILTER ((event_id + user_id) % 3 = 1) AS n_registered, count(*) FILTER ((event_id + user_id) % 3 = 2) AS n_expired,
        coalesce(max(epoch_us(ts) // 1000) FILTER ((event_id + user_id) % 3 = 2), 0) AS last_expired_ms FROM obs GROUP BY apex""",
    "stream_passive_ingest": f"""WITH {OBS} SELECT fqdn, count(*) AS n, min(epoch_us(ts) // 1000) AS first_ms, max(epoch_us(ts) // 1000) AS last_ms
        FROM obs GROUP BY fqdn""",
    "stream_entrada_ingest": f"""WITH {OBS} SELECT sha256(fqdn || '4') AS fqdn, count(*) AS n, count(*) FILTER (event_type = 'click') AS n_linked,
        max(epoch_us(ts) // 1000) AS last_ms FROM obs GROUP BY obs.fqdn""",
    "stream_ct_tail": f"""WITH {CERT} SELECT log_url, count(*) AS n_entries, count(DISTINCT sha256_fingerprint) AS n_certificates,
        max(index) + 1 AS resume_index FROM cert GROUP BY log_url""",
    "stream_metrics": f"""WITH {OBS} SELECT (epoch_us(date_trunc('hour', ts)) // 1000) AS interval_ms, tld, count(*) AS n
        FROM obs GROUP BY ALL""",
    "stream_dedup": f"WITH {OBS} SELECT DISTINCT fqdn FROM obs",
    "stream_zone_diff": f"WITH {EVENTS} SELECT tld, domain, event_type, {_day('snapshot_date')} AS snapshot_date FROM diff",
    "vantage_overlap": f"""WITH {SIGHTINGS}, per_apex AS (SELECT apex, string_agg(DISTINCT source, '+' ORDER BY source) AS sources
        FROM sightings GROUP BY apex) SELECT sources, count(*) AS n_apexes FROM per_apex GROUP BY sources""",
    "vantage_first_seen": f"""WITH {SIGHTINGS}, firsts AS (SELECT apex, source, min(ts) AS ts FROM sightings GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY apex ORDER BY ts, source) AS r FROM firsts)
        SELECT apex, {', '.join(f"coalesce((epoch_us(max(ts) FILTER (source = '{s}')) // 1000), 0) AS first_{s}_ms"
                                for s in ('zone', 'ct', 'passive', 'entrada'))},
               max(source) FILTER (r = 1) AS leading_source,
               coalesce((epoch_us(max(ts) FILTER (r = 2)) // 1000) - (epoch_us(max(ts) FILTER (r = 1)) // 1000), 0) AS lead_ms
        FROM ranked GROUP BY apex""",
}
