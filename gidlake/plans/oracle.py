"""The same results in DuckDB SQL: the bindings as common table expressions and one SELECT per query."""

from __future__ import annotations

import re

# One moment for every run stamp, as in bindings.RUN_TS.
STAMP = "2025-01-31T12:00:00.000000"
PREFIX = "https://portal.example/company-profile?gid="

LAT, LON = "(n * 53 % 18000) / 1e2 - 90", "(n * 37 % 36000) / 1e2 - 180"
EDGE_ORDER = "kind_ord, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_shipdate"


def truthy(c: str) -> str:
    return f"coalesce({c} <> '', false)"


def synthetic(c: str) -> str:
    return f"'operator_' || (('0x' || substr(md5({c}), 1, 7))::BIGINT % 100000)"


def rev_key(lat: str, lon: str) -> str:
    return f"'rev:' || printf('%.8f', {lat}) || ',' || printf('%.8f', {lon})"


VIEWS = {
    "v_part": "SELECT p_partkey AS n, p_partkey::VARCHAR AS gid, * FROM part",
    "v_supp": """SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey
                 JOIN region ON n_regionkey = r_regionkey""",
    "v_feed": f"""
      SELECT n_name AS country, n_nationkey AS country_ord, s_suppkey AS row_ord, gid, n, p_name AS project_name,
        CASE WHEN n % 13 = 0 THEN NULL WHEN n % 11 = 0 THEN r_name ELSE n_name || ', ' || r_name END AS location,
        CASE WHEN n % 9 <> 0 THEN {LAT} END AS latitude, CASE WHEN n % 9 <> 0 THEN {LON} END AS longitude,
        CASE WHEN n % 5 = 0 THEN '' WHEN n % 5 = 1 THEN NULL ELSE p_brand END AS mineral_district_camp,
        'District ' || p_size AS mineral_district, (p_size * 1000) || '.500000000000' AS area_m2,
        p_type AS stage, replace(p_name, ' ', ',') AS commodities,
        CASE WHEN n % 3 = 0 THEN NULL ELSE s_name END AS operator,
        s_acctbal AS marketcap, p_retailprice AS outstandingshares, p_size AS project_size
      FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_partkey % 17 <> 0)
      JOIN v_part ON l_partkey = n JOIN v_supp ON l_suppkey = s_suppkey""",
    "v_last": """
      SELECT *, CASE WHEN location <> '' THEN split_part(location, ', ', -1) END AS loc_country,
        CASE WHEN contains(location, ', ') THEN split_part(location, ', ', 1) END AS loc_state,
        CASE WHEN mineral_district_camp <> '' THEN mineral_district_camp ELSE mineral_district END AS district
      FROM (SELECT *, row_number() OVER (PARTITION BY gid ORDER BY country_ord DESC, row_ord DESC) AS rn FROM v_feed)
      WHERE rn = 1""",
    "v_items": """
      SELECT *, l_partkey::VARCHAR AS gid,
        CASE l_returnflag WHEN 'N' THEN 'jv' WHEN 'A' THEN 'nsr' ELSE 'option' END AS kind,
        CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 1 ELSE 2 END AS kind_ord
      FROM lineitem WHERE l_partkey % 10 <> 0 AND NOT (l_returnflag = 'N' AND l_partkey % 7 = 0)""",
    "v_edges": """
      SELECT i.*, s_suppkey::VARCHAR AS company_id, s_name AS company_name, kind AS relationship_type,
        CASE WHEN kind = 'option' OR l_quantity < 3 THEN NULL ELSE l_quantity * 2 END AS percentage,
        l_orderkey * 10 + l_linenumber AS ownership_id, CASE WHEN kind = 'option' THEN s_suppkey END AS optionee_id,
        CASE WHEN kind = 'option' THEN 'status ' || l_linestatus END AS comments,
        'T' || s_suppkey AS ticker, CASE WHEN s_nationkey % 2 = 0 THEN 'EVEN' ELSE 'ODD' END AS exchange,
        n_name AS headquarters, 'Industry ' || (s_suppkey % 7) AS industry, r_name AS sector
      FROM v_items i JOIN v_supp ON l_suppkey = s_suppkey""",
    "v_ranked": f"""
      SELECT *, row_number() OVER (PARTITION BY gid ORDER BY CASE WHEN kind = 'jv' THEN 0 ELSE 1 END,
          CASE WHEN kind = 'jv' THEN -coalesce(percentage, 0) ELSE 0 END, {EDGE_ORDER}) AS rn_primary,
        row_number() OVER (PARTITION BY gid ORDER BY {EDGE_ORDER}) AS rn_first,
        count(*) OVER (PARTITION BY gid) AS rel_count,
        count(*) FILTER (kind = 'jv') OVER (PARTITION BY gid) AS jv_count
      FROM v_edges""",
    "v_primary": "SELECT * FROM v_ranked WHERE rn_primary = 1",
    "v_first": "SELECT * FROM v_ranked WHERE rn_first = 1",
    "v_rec": """
      SELECT gid, n, rec_ord,
        CASE WHEN rec_ord = 1 THEN 'second' WHEN n % 20 = 0 THEN NULL ELSE 'Page ' || p_name END AS project_name,
        CASE WHEN n % 100 = 0 THEN '' ELSE (n % 100)::VARCHAR END AS company_id,
        CASE WHEN n % 16 = 0 THEN NULL ELSE 'Company ' || (n % 100) END AS company_name,
        CASE WHEN n % 12 = 0 THEN NULL ELSE 'Operator ' || (n % 50) END AS operator,
        p_type AS stage, p_brand AS commodities
      FROM v_part JOIN (SELECT unnest([0, 1]) AS rec_ord) ON rec_ord = 0 OR n % 8 = 0 WHERE n % 4 = 0""",
    "v_scraped": f"""
      SELECT *, coalesce(nullif(company_id, ''), {synthetic('any_name')}) AS comp_id,
        coalesce(any_name, 'Unknown Company') AS comp_name, company_id <> '' OR any_name IS NOT NULL AS has_comp
      FROM (SELECT *, nullif(CASE WHEN company_name <> '' THEN company_name ELSE operator END, '') AS any_name
            FROM v_rec)""",
    "v_rec1": "SELECT * FROM v_scraped WHERE rec_ord = 0",
    "v_urls": """
      SELECT gid, arg_max(url, row_ord) AS project_url FROM (
        SELECT gid, 'https://portal.example/project-profile?gid=' || gid AS url, 0 AS row_ord
        FROM v_part WHERE n % 3 = 0 OR n % 17 = 0
        UNION ALL SELECT (page_id + 1000000)::VARCHAR, url, 1 FROM pages) GROUP BY gid""",
    "v_gids": "SELECT gid FROM v_feed UNION SELECT gid FROM v_urls",
    "v_centers": """SELECT gid, (n * 29 % 18000) / 1e2 - 90 AS lat, (n * 31 % 36000) / 1e2 - 180 AS lon
                    FROM v_part WHERE n % 2 = 0""",
    "v_cache": f"""
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY entry_ord) AS rn FROM (
          SELECT {rev_key(LAT, LON)} AS cache_key, n % 8 = 0 AS negative, 'State of ' || n_name AS state,
            n_name AS country, 'P' || (n % 1000) AS postcode, 'XX-' || (n % 25) AS iso, NULL AS county,
            1.5 AS lat, 2.5 AS lon, n AS entry_ord
          FROM v_part JOIN nation ON n % 25 = n_nationkey WHERE n % 6 <> 0
          UNION ALL
          SELECT 'fwd:' || lower(r_name), false, 'Region ' || r_regionkey, r_name, NULL, NULL, 'C' || r_regionkey,
            r_regionkey * 10 + 0.25, r_regionkey * 20 + 0.75, r_regionkey
          FROM region WHERE r_regionkey < 4)) WHERE rn = 1""",
    "v_base": f"""
      SELECT g.gid, f.gid IS NOT NULL AS has_feed, c.gid IS NOT NULL AS has_page,
        CASE WHEN e.gid IS NOT NULL THEN 1 WHEN c.has_comp THEN 2 WHEN {truthy('f.operator')} THEN 3 ELSE 0 END AS tier,
        CASE WHEN f.gid IS NOT NULL THEN f.project_name ELSE coalesce(c.project_name, '') END AS name,
        CASE WHEN f.gid IS NOT NULL THEN f.stage ELSE c.stage END AS stage,
        CASE WHEN f.gid IS NOT NULL THEN f.commodities ELSE c.commodities END AS commodities,
        CASE WHEN f.gid IS NOT NULL THEN f.operator ELSE c.operator END AS own_operator,
        f.operator AS feed_operator, c.comp_id, c.comp_name, e.company_id AS first_id, e.company_name AS first_name,
        p.company_id AS primary_id, p.company_name AS primary_name, e.rel_count, e.jv_count,
        f.location, f.latitude, f.longitude, f.loc_country, f.loc_state, f.district, f.area_m2, u.project_url
      FROM v_gids g LEFT JOIN v_last f USING (gid) LEFT JOIN v_rec1 c USING (gid) LEFT JOIN v_first e USING (gid)
        LEFT JOIN v_primary p USING (gid) LEFT JOIN v_urls u USING (gid)""",
    "v_res": f"""
      SELECT *, CASE tier WHEN 1 THEN CASE WHEN has_feed THEN primary_id ELSE first_id END WHEN 2 THEN comp_id
            WHEN 3 THEN {synthetic('feed_operator')} END AS company_id,
        CASE tier WHEN 1 THEN CASE WHEN has_feed THEN primary_name ELSE first_name END WHEN 2 THEN comp_name
            WHEN 3 THEN feed_operator END AS company_name,
        CASE tier WHEN 1 THEN 'relationships' WHEN 2 THEN 'scraper' WHEN 3 THEN 'api' END AS company_source,
        CASE WHEN tier = 1 THEN rel_count WHEN tier > 0 THEN 1 ELSE 0 END AS relationship_count
      FROM v_base WHERE has_feed OR has_page""",
    "v_moved": """
      SELECT r.* EXCLUDE (latitude, longitude),
        CASE WHEN need AND m.gid IS NOT NULL THEN m.lat ELSE r.latitude END AS latitude,
        CASE WHEN need AND m.gid IS NOT NULL THEN m.lon ELSE r.longitude END AS longitude,
        CASE WHEN has_feed THEN 'api' WHEN need AND m.gid IS NOT NULL THEN 'scraper_map' END AS source0
      FROM (SELECT *, latitude IS NULL OR longitude IS NULL AS need FROM v_res) r LEFT JOIN v_centers m USING (gid)""",
    "v_keyed": f"""
      SELECT *, CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL AND NOT {truthy('loc_state')}
            THEN {rev_key('latitude', 'longitude')}
          WHEN (latitude IS NULL OR longitude IS NULL) AND {truthy('location')} AND NOT {truthy('loc_state')}
            THEN 'fwd:' || lower(location) END AS cache_key FROM v_moved""",
    "v_proj": f"""
      SELECT k.gid, k.name, k.stage, k.commodities, k.tier, k.has_feed, k.has_page, k.company_id, k.company_name,
        k.company_source, k.relationship_count, coalesce(k.jv_count, 0) AS jv_count, k.project_url, k.location,
        k.district, k.area_m2, k.cache_key, hit,
        CASE WHEN {truthy('own_operator')} THEN own_operator
          ELSE coalesce(k.company_name, CASE WHEN tier = 1 THEN first_name END, own_operator) END AS operator,
        CASE WHEN hit AND k.cache_key LIKE 'fwd:%' THEN c.lat ELSE k.latitude END AS latitude,
        CASE WHEN hit AND k.cache_key LIKE 'fwd:%' THEN c.lon ELSE k.longitude END AS longitude,
        CASE WHEN hit THEN c.country ELSE k.loc_country END AS country,
        CASE WHEN hit THEN c.state ELSE k.loc_state END AS state,
        CASE WHEN hit THEN c.postcode END AS postcode, CASE WHEN hit THEN c.iso END AS iso3166_2,
        CASE WHEN hit THEN c.county END AS county, CASE WHEN hit THEN true END AS geocoded,
        coalesce(source0, CASE WHEN hit THEN 'geocode' END) AS location_source,
        list_aggregate(list_sort(list_distinct([s FOR s IN
          [CASE WHEN has_feed THEN 'api' ELSE 'scraper' END, company_source] IF s IS NOT NULL])),
          'string_agg', ', ') AS data_sources
      FROM (SELECT k.*, coalesce(NOT c.negative, false) AS hit FROM v_keyed k LEFT JOIN v_cache c USING (cache_key)) k
        LEFT JOIN v_cache c USING (cache_key)""",
    "v_fail": "SELECT gid FROM v_base WHERE NOT has_feed AND NOT has_page",
    "v_pedges": """
      SELECT e.gid, p.name, e.company_id FROM v_edges e JOIN v_proj p USING (gid)
      UNION ALL SELECT gid, name, company_id FROM v_proj WHERE tier IN (2, 3)""",
    "v_comp": f"""
      SELECT p.company_id, count(*) AS project_count, arg_min(p.company_name, n) AS company_name,
        arg_min(p.company_source, n) AS data_source,
        coalesce(string_agg(DISTINCT p.country, ', ' ORDER BY p.country) FILTER (p.country <> ''), '') AS countries,
        sum(p.relationship_count)::BIGINT AS relationships, arg_min(p.gid, n) AS first_gid
      FROM (SELECT *, gid::BIGINT AS n FROM v_proj) p WHERE tier > 0 GROUP BY p.company_id""",
    "v_summary": """
      WITH c AS (SELECT count(*) AS t, count(*) FILTER (tier > 0) AS w, count(*) FILTER (tier = 1) AS r FROM v_proj)
      SELECT 'Total Projects' AS metric, t::VARCHAR AS value FROM c UNION ALL
      SELECT 'Completed Projects', t::VARCHAR FROM c UNION ALL SELECT 'Failed Projects', '0' UNION ALL
      SELECT 'Projects with Companies', w::VARCHAR FROM c UNION ALL
      SELECT 'Companies from Relationships API', r::VARCHAR FROM c UNION ALL
      SELECT 'Company Resolution Rate', ((2000 * w + t) // (2 * t) // 10) || '.' || ((2000 * w + t) // (2 * t) % 10) || '%'
      FROM c UNION ALL
      SELECT 'Relationships API Success Rate',
        ((2000 * r + t) // (2 * t) // 10) || '.' || ((2000 * r + t) // (2 * t) % 10) || '%' FROM c""",
    "v_marts": f"""
      SELECT 'Projects' AS output, gid AS key, concat_ws('|', coalesce(name, '-'), coalesce(stage, '-'), coalesce(commodities, '-'), coalesce(operator, '-'),
        coalesce(project_url, '-'), coalesce(country, '-'), coalesce(state, '-'), data_sources, 'completed', 'false') AS said FROM v_proj
      UNION ALL SELECT 'Companies', company_id, concat_ws('|', coalesce(company_name, '-'), coalesce('{PREFIX}' || company_id, '-'), project_count, countries,
        data_source) FROM v_comp
      UNION ALL SELECT 'Relationships', gid, concat_ws('|', coalesce(name, '-'), coalesce(company_id, '-')) FROM v_pedges
      UNION ALL SELECT 'Data_Sources', s, count(*)::VARCHAR FROM (SELECT unnest(string_split(data_sources, ', ')) AS s FROM v_proj) GROUP BY s
      UNION ALL SELECT 'Processing_Summary', metric, value FROM v_summary""",
    "v_batches": """SELECT gid, ((row_number() OVER (ORDER BY md5(gid), gid) - 1) // 100)::BIGINT AS batch_id
                    FROM v_gids""",
    "v_pages": "SELECT *, n % 10 = 9 AS in_block, n % 7 = 3 AS nested FROM v_part",
    # Property blocks of a page: tables inside a cell take numbers too.
    "v_blocks": """
      SELECT *, 0::BIGINT AS table_no, false AS wide FROM v_kv
      UNION ALL SELECT *, CASE WHEN nested THEN 2 ELSE 1 END, false FROM v_kv WHERE NOT in_block
      UNION ALL SELECT *, CASE WHEN nested THEN 4 ELSE 2 END, true FROM v_kv WHERE NOT in_block""",
    "v_kv": """
      SELECT *, CASE WHEN n % 12 <> 0 THEN p_name END AS title, 'KV ' || p_name AS kv_project,
        CASE WHEN n % 6 <> 0 THEN 'Operator ' || (n % 7) END AS kv_operator,
        CASE WHEN n % 8 <> 0 THEN 'Cu,' || (n % 9) END AS kv_commodities,
        CASE WHEN n % 12 = 0 THEN 'Drill' WHEN nested THEN 'Inner ' || (n % 5) END AS kv_stage, 'T' || (n % 11) AS kv_ticker,
        CASE WHEN n % 3 = 1 THEN 'company  of ' || (n % 100) END AS heading,
        CASE WHEN n % 8 = 4 THEN CASE WHEN n % 6 = 0 THEN (n % 90)::VARCHAR ELSE (n % 80)::VARCHAR END END AS own_id,
        CASE WHEN n % 8 = 4 THEN CASE WHEN n % 6 = 0 THEN 'Alpha' || (n % 7)
             ELSE 'The Operator ' || (n % 7) || ' Co' END END AS own_name,
        CASE n % 5 WHEN 0 THEN (n % 100)::VARCHAR WHEN 2 THEN (n % 60)::VARCHAR WHEN 3 THEN (n % 50)::VARCHAR
             ELSE CASE WHEN n % 8 = 4 THEN '1' END END AS fast_id
      FROM v_pages""",
    "v_rec2": """
      SELECT *, coalesce(title, kv_project) AS f_project,
        coalesce(kv_commodities, CASE WHEN in_block THEN NULL WHEN n % 16 = 0 THEN 'Au, ' || (n % 9) WHEN n % 12 = 0 THEN 'Nothing' END)
          AS f_commodities,
        coalesce(kv_stage, CASE WHEN in_block THEN NULL WHEN n % 16 = 0 THEN 'by gid' ELSE 'by name' END) AS f_stage
      FROM v_kv""",
    "v_html": """
      SELECT gid, in_block, '<tr><td>Project Name</td><td>KV ' || p_name ||
          '</td></tr><tr><td>Operator</td><td>' || coalesce(kv_operator, '-') ||
          '</td></tr><tr><td>Main <b>Commodities</b></td><td>' || coalesce(kv_commodities, '-') || '</td></tr>' ||
          CASE WHEN n % 12 = 0 THEN '<tr><td>Stage<td>Drill' ELSE '' END || '<tr><td>Ticker<td>' || kv_ticker ||
          CASE WHEN n % 8 = 4 THEN '<tr><td>Ownership</td><td><a onclick="go(''?gid=' || (n % 90) || ''')">Alpha <b>' ||
            (n % 7) || '</b></a>, <a href="/company-profile?gid=1"> </a><a href="/company-profile?gid=' || (n % 80) ||
            '">The Operator ' || (n % 7) || ' Co</a></td></tr>' ELSE '' END ||
          CASE WHEN nested THEN '<tr><td>Details</td><td><table><tr><td>Stage<td>Inner ' || (n % 5) || '</table></td></tr>' ELSE '' END ||
          '</table>' AS kv,
        '<tr><th>Project</th><th>Project Operator</th>' ||
          '<th>Commodities</th><th>Stage</th></tr><tr><td>decoy</td><td>x</td><td>Nothing</td><td>None</td></tr><tr><td>' ||
          upper(p_name) || '</td><td>x</td><td>-</td><td>by name</td></tr>' ||
          CASE WHEN n % 16 = 0 THEN '<tr><td><a href="/project-profile?gid=' || n || '">x</a></td><td>x</td><td>Au, ' ||
            (n % 9) || '</td><td>by gid</td></tr>' ELSE '' END || '</table>' AS projects FROM v_kv""",
    "v_match": """
      SELECT gid, n, CASE WHEN n % 16 = 0 THEN 'Au ' || (n % 9) WHEN n % 8 <> 0 THEN 'last' ELSE 'first' END AS commodities,
        CASE WHEN n % 16 = 0 THEN 'gid stage' WHEN n % 8 <> 0 THEN NULL ELSE 's1' END AS stage,
        CASE WHEN n % 16 = 0 THEN '/project-profile?gid=' || n || '&y=2'
             WHEN n % 8 <> 0 THEN '/project-profile?gid=999999999999' END AS project_summary_href,
        CASE WHEN n % 16 = 0 THEN 'gid' ELSE 'name' END AS matched_by FROM v_pages""",
}

COMPANY_COLUMNS = f"""c.company_id, c.company_name, '{PREFIX}' || c.company_id AS company_url"""

WORDS = "string_split_regex(trim(x, ' \t'), '[ \t]+')"

# Character references of the test pages; HTML reads `&amp` as '&' with or without its semicolon.
DECODE = ("regexp_replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;?', '&', 'g')")

SELECTS = {
    "s01_countries": "SELECT n_name AS country, n_nationkey AS country_ord FROM nation",
    "s02_project_feed": """
      SELECT n_name AS country, n_nationkey AS country_ord, 0::BIGINT AS row_ord, gid, p_name AS project_name,
        n_name AS location, p_size || '.000' AS area_m2, p_type AS stage, (n % 180) + 0.5::DOUBLE AS longitude,
        (n % 90) + 0.25::DOUBLE AS latitude
      FROM v_part JOIN nation ON n % 25 = n_nationkey WHERE n % 7 <> 0""",
    "s02_feed_arrays": """
      SELECT n_name AS country, n_nationkey AS country_ord, gid, p_name AS project_name, n_name AS location, p_size || '.000' AS area_m2,
        p_type AS stage, (n % 180) + 0.5::DOUBLE AS longitude, true AS in_order
      FROM v_part JOIN nation ON n % 25 = n_nationkey WHERE n % 7 <> 0""",
    "s03_relationship_bodies": """
      SELECT gid, count(*) AS bodies, count(*) FILTER (kind = 'jv') AS jv_entries,
        2 * count(*) FILTER (kind = 'nsr') AS nsr_entries, 3 * count(*) FILTER (kind = 'option') AS option_entries
      FROM v_items GROUP BY gid""",
    "s04_url_index": """
      SELECT gid, CASE WHEN gid::BIGINT % 2 = 0 THEN '' ELSE 'old:' END || url AS url FROM (
        SELECT gid, 'https://portal.example/project-profile?gid=' || gid AS url FROM v_part
        WHERE (n % 3 = 0 OR n % 17 = 0) AND n % 51 <> 0
        UNION ALL SELECT (page_id + 1000000)::VARCHAR, url FROM pages WHERE (page_id + 1000000) % 51 <> 0)""",
    "s05_pages": "SELECT page_id, url, length(html) AS html_chars FROM pages",
    "s06_geocode_cache": """SELECT cache_key, negative AS is_negative, CASE WHEN NOT negative THEN country END AS country
                            FROM v_cache""",
    "s07_company_links": """
      SELECT CASE WHEN s_suppkey % 3 <> 2 THEN s_suppkey::VARCHAR END AS company_id, s_name AS company_name,
        CASE WHEN l THEN s_suppkey * 2 END AS link_id, CASE WHEN l THEN s_suppkey END AS link_company_id,
        CASE WHEN l THEN 't' || (s_suppkey % 4) END AS link_file_title, NULL::VARCHAR AS link_file_name,
        CASE WHEN l THEN 'd' END AS link_file_data, CASE WHEN l THEN '2025-01-01' END AS link_date_created
      FROM (SELECT *, s_suppkey % 5 <> 0 AS l FROM supplier)""",
    "s08_read_export": f"""SELECT gid, name, 'completed' AS processing_stage, area_m2, company_name,
                            '{STAMP}' AS created_at FROM v_proj""",
    "s08_company_array": """SELECT company_id, company_name, project_count AS total_projects, project_count AS listed, countries
                            FROM v_comp WHERE company_id <> ''""",
    "s09_metrics_history": """
      SELECT count(*) AS total_projects, count(*) FILTER (event_type = 'error') AS failed_projects,
        count(*) FILTER (event_type = 'error') AS failed_errors,
        round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS seconds
      FROM events GROUP BY date_trunc('day', ts)""",
    "k01_write_projects": """
      SELECT gid, name, 0 AS part, relationship_count AS relationships, data_sources,
        (SELECT count(*) FROM v_proj) AS total_projects, '2.0' AS version FROM v_proj""",
    "k02_write_companies": f"""SELECT company_id, '{PREFIX}' || company_id AS company_url, project_count AS total_projects,
                               0 AS part, project_count AS listed FROM v_comp""",
    "k03_export_marts": "SELECT output, key, said FROM v_marts",
    "k04_write_metrics": """
      SELECT p.n + f.n AS total_projects, p.n AS completed_projects, f.n AS failed_projects, api AS api_projects,
        scraped AS scraped_projects, enriched AS relationships_enriched, 10::DOUBLE AS duration_seconds,
        round(p.n / (p.n + f.n) * 100, 6) AS success_rate, error_types
      FROM (SELECT count(*) AS n, count(*) FILTER (contains(data_sources, 'api')) AS api,
              count(*) FILTER (contains(data_sources, 'scraper')) AS scraped,
              count(*) FILTER (company_source = 'relationships') AS enriched FROM v_proj) p,
        (SELECT count(*) AS n FROM v_fail) f,
        (SELECT count(DISTINCT json_extract_string(props, '$.k')) AS error_types FROM events
         WHERE event_type = 'error') e""",
    "k05_export_all": """
      SELECT 'projects_json' AS output, gid AS key, coalesce(name, '-') || '|' || relationship_count || '|' || data_sources AS said FROM v_proj
      UNION ALL SELECT 'companies_json', company_id, company_name || '|' || project_count || '|' || project_count FROM v_comp
      UNION ALL SELECT output, key, said FROM v_marts""",
    "k06_upsert_geocode_cache": f"""
      WITH fetched AS (SELECT {rev_key(LAT, LON)} AS cache_key, min(CASE WHEN n % 4 = 0 THEN NULL
          ELSE '{{"fetched":' || (n % 36000) || '}}' END) AS payload FROM v_part GROUP BY 1),
        points AS (SELECT *, row_number() OVER (PARTITION BY cache_key ORDER BY n) AS rn FROM (
          SELECT n, {rev_key(LAT, LON)} AS cache_key, CASE WHEN n % 8 = 0 THEN NULL ELSE
            '{{"lat":"1.5","lon":"2.5","address":{{"' || CASE WHEN n % 4 = 1 THEN 'province' ELSE 'state' END ||
            '":"State of ' || n_name || '","country":"' || n_name || '","postcode":"P' || (n % 1000) ||
            '","ISO3166-2-lvl' || CASE WHEN n % 2 = 0 THEN '4' ELSE '6' END || '":"XX-' || (n % 25) || '"}}}}' END
            AS payload FROM v_part JOIN nation ON n % 25 = n_nationkey WHERE n % 6 <> 0)),
        kept AS (SELECT cache_key, payload FROM points WHERE rn = 1 UNION ALL
          SELECT 'fwd:' || lower(r_name), '{{"lat":"' || (r_regionkey * 10) || '.25","lon":"' || (r_regionkey * 20) ||
            '.75","address":{{"region":"Region ' || r_regionkey || '","country":"' || r_name || '","county":"C' ||
            r_regionkey || '"}}}}' FROM region WHERE r_regionkey < 4)
      SELECT cache_key, payload, payload IS NULL AS is_negative FROM kept UNION ALL
      SELECT cache_key, payload, payload IS NULL FROM fetched WHERE cache_key NOT IN (SELECT cache_key FROM kept)""",
    "k07_run_names": "SELECT gid, '20250131_120000' AS run_id, '/out/Marts_20250131_120000' AS folder FROM v_part",
    "p01_filter_projects": """
      SELECT gid, country, row_ord, commodities, marketcap, project_size FROM v_feed
      WHERE country = 'NATION_3' AND marketcap BETWEEN 0 AND 10000 AND outstandingshares BETWEEN 900 AND 5000
        AND project_size >= 10 AND list_has_any(string_split(commodities, ','), ['red', 'bolt'])""",
    "p02_normalize_gid": "SELECT gid FROM v_part WHERE n % 6 > 1",
    "p03_safe_project": """
      SELECT gid, project_name AS name, stage, commodities, operator, 'discovered' AS processing_stage,
        location AS location_string, district AS mineral_district, area_m2, 'api' AS location_source,
        'api' AS data_sources FROM v_last""",
    "p04_centroid": """SELECT gid, CASE WHEN n % 4 >= 2 THEN n * 1.5::DOUBLE END AS longitude,
                       CASE WHEN n % 4 = 3 THEN n * 0.25::DOUBLE END AS latitude FROM v_part""",
    "p05_split_location": """
      SELECT gid, row_ord, CASE WHEN location <> '' THEN split_part(location, ', ', -1) END AS country,
        CASE WHEN contains(location, ', ') THEN split_part(location, ', ', 1) END AS state
      FROM (SELECT gid, row_ord, CASE WHEN row_ord % 7 = 0 THEN '' WHEN row_ord % 7 = 1 THEN 'Inner, ' || location
            ELSE location END AS location FROM v_feed)""",
    "p06_coalesce_truthy": """SELECT gid, row_ord, coalesce(nullif(mineral_district_camp, ''), nullif(operator, ''),
                              mineral_district) AS picked FROM v_feed""",
    "p07_flatten_projects": f"""
      SELECT gid, name AS project_name, stage, commodities, operator, project_url, location AS location_string, latitude,
        longitude, country, state, district AS mineral_district, area_m2, location_source, iso3166_2, postcode, county,
        NULL::VARCHAR AS territory, data_sources, 'completed' AS processing_stage, '{STAMP}' AS created_at,
        '{STAMP}' AS updated_at, false AS has_errors, 0::BIGINT AS error_count FROM v_proj""",
    "p08_relationship_company": """
      SELECT gid, ownership_id, company_id AS id, company_name AS name, ticker, exchange, NULL::VARCHAR AS website,
        headquarters, industry, sector, 'relationships' AS data_source FROM v_edges""",
    "p09_company_url": f"SELECT gid, rec_ord, '{PREFIX}' || nullif(company_id, '') AS company_url FROM v_rec",
    "p10_has_company": """SELECT gid, 'documents' AS used_for FROM v_part WHERE n % 3 <> 0 AND n % 5 <> 0
                          UNION ALL SELECT gid, 'mart' FROM v_part WHERE n % 3 <> 0""",
    "p11_country_scope": "SELECT country, gid, row_ord FROM v_feed WHERE country IN ('NATION_1', 'NATION_7')",
    "p12_updates": f"""SELECT gid, 'assembled' AS processing_stage, '{STAMP}' AS updated_at,
                       'api, scraper' AS data_sources, stage || '; late' AS errors FROM v_last""",
    "p13_operator_company": f"""
      SELECT gid, {synthetic('operator')} AS id, operator AS name,
        CASE WHEN operator IS NOT NULL THEN 'operator' END AS relationship_type,
        CASE WHEN operator IS NOT NULL THEN 'api' END AS data_source FROM v_last""",
    "p14_scraped_company": """
      SELECT gid, rec_ord, CASE WHEN has_comp THEN comp_id END AS id, CASE WHEN has_comp THEN comp_name END AS name,
        CASE WHEN has_comp THEN 'scraper' END AS data_source FROM v_scraped""",
    "p15_validate_enum": """
      SELECT kind, coalesce(kind IN ('jv', 'option', 'nsr', 'operator'), false) AS accepted, count(*) AS edges
      FROM (SELECT CASE WHEN l_linenumber = 7 THEN 'lease' WHEN l_linenumber = 6 THEN NULL ELSE kind END AS kind
            FROM v_items) GROUP BY ALL""",
    "p16_address_fields": """
      SELECT cache_key, CASE WHEN NOT negative THEN state END AS state, CASE WHEN NOT negative THEN iso END AS iso3166_2,
        CASE WHEN NOT negative THEN postcode END AS postcode, county, NULL::VARCHAR AS territory,
        CASE WHEN negative THEN 'old' ELSE country END AS country FROM v_cache""",
    "p17_fill_operator": """SELECT f.gid, coalesce(f.operator, p.company_name) AS operator
                            FROM v_last f JOIN v_primary p USING (gid)""",
    "p18_needs": f"""
      SELECT gid, latitude IS NULL AS needs_map, latitude IS NOT NULL AND NOT {truthy('loc_state')} AS needs_reverse,
        latitude IS NULL AND {truthy('location')} AND NOT {truthy('loc_state')} AS needs_forward FROM v_last""",
    "j01_gid_to_feed": "SELECT gid, project_name, country, row_ord FROM v_gids LEFT JOIN v_last USING (gid)",
    "j02_gid_to_url": "SELECT gid, project_url FROM v_gids LEFT JOIN v_urls USING (gid)",
    "j03_gid_to_relationships": """SELECT gid, company_id, relationship_type, percentage, ownership_id, optionee_id
                                   FROM v_edges WHERE gid IN (SELECT gid FROM v_gids)""",
    "j04_resolve_companies": """
      SELECT gid, company_id, company_name, relationship_type, percentage, ownership_id, 'relationships' AS data_source
      FROM v_edges WHERE gid IN (SELECT gid FROM v_gids)
      UNION ALL SELECT gid, company_id, company_name, 'operator', CASE WHEN tier = 3 THEN 100::DOUBLE END, NULL,
        company_source FROM v_res WHERE tier IN (2, 3)""",
    "j05_minimal_projects": """
      SELECT gid, coalesce(project_name, '') AS name, stage, commodities, operator, 'scraper' AS data_sources
      FROM v_rec1 WHERE gid IN (SELECT gid FROM v_gids) AND gid NOT IN (SELECT gid FROM v_feed)""",
    "j06_map_backfill": "SELECT gid, latitude, longitude, source0 AS location_source FROM v_moved",
    "j07_reverse_geocode": """
      SELECT gid, CASE WHEN hit THEN c.country ELSE loc_country END AS country,
        CASE WHEN hit THEN c.state ELSE loc_state END AS state, CASE WHEN hit THEN c.postcode END AS postcode,
        CASE WHEN hit THEN c.iso END AS iso3166_2, CASE WHEN hit THEN true END AS geocoded, 'api' AS location_source
      FROM (SELECT *, coalesce(NOT negative, false) AS hit FROM v_fkeyed LEFT JOIN v_cache c USING (cache_key)) f
        LEFT JOIN v_cache c USING (cache_key)""",
    "j08_forward_geocode": """
      SELECT gid, CASE WHEN hit AND cache_key LIKE 'fwd:%' THEN c.lat ELSE latitude END AS latitude,
        CASE WHEN hit AND cache_key LIKE 'fwd:%' THEN c.lon ELSE longitude END AS longitude,
        CASE WHEN hit THEN c.country ELSE loc_country END AS country, CASE WHEN hit THEN c.state ELSE loc_state END AS state,
        CASE WHEN hit THEN c.county END AS county, CASE WHEN hit THEN true END AS geocoded
      FROM (SELECT gid, cache_key, latitude, longitude, loc_country, loc_state, coalesce(NOT negative, false) AS hit
            FROM v_fkeyed LEFT JOIN v_cache USING (cache_key)) f LEFT JOIN v_cache c USING (cache_key)""",
    "j09_geocode_work_list": """SELECT DISTINCT cache_key FROM v_fkeyed WHERE cache_key IS NOT NULL
                                AND cache_key NOT IN (SELECT cache_key FROM v_cache)""",
    "j10_failed_gids": "SELECT gid FROM v_fail",
    "j11_row_match": """
      SELECT gid, CASE WHEN in_block THEN NULL WHEN n % 16 = 0 THEN 'x' WHEN title IS NULL THEN 'decoy' ELSE upper(p_name) END AS row_name,
        CASE WHEN in_block THEN NULL WHEN n % 16 = 0 THEN 'Au, ' || (n % 9) WHEN title IS NULL THEN 'Nothing' END AS commodities,
        CASE WHEN in_block THEN NULL WHEN n % 16 = 0 THEN 'by gid' WHEN title IS NULL THEN 'None' ELSE 'by name' END AS stage FROM v_kv""",
    "a01_discovery_counts": """SELECT (SELECT count(*) FROM v_gids) AS total_gids, (SELECT count(DISTINCT gid) FROM v_gids)
                               AS unique_gids, (SELECT count(DISTINCT gid) FROM v_feed) AS api_gids""",
    "a02_gids_per_country": "SELECT country, count(DISTINCT gid) AS gids FROM v_feed GROUP BY country",
    "a03_companies_with_projects": f"""
      WITH listed AS (SELECT gid, string_agg(company_id, ',' ORDER BY {EDGE_ORDER}) AS ids FROM v_edges GROUP BY gid),
        ranked AS (SELECT company_id, gid, gid::BIGINT AS n, relationship_count,
          gid || ':' || CASE WHEN tier = 1 THEN listed.ids ELSE company_id END AS member,
          ((row_number() OVER (PARTITION BY company_id ORDER BY gid::BIGINT) - 1) // 10)::INTEGER AS part
        FROM v_proj LEFT JOIN listed USING (gid) WHERE tier > 0),
        pages AS (SELECT company_id, part, count(*) AS listed, sum(relationship_count)::BIGINT AS relationships,
          arg_min(gid, n) AS first_gid, md5(string_agg(member, ';' ORDER BY n)) AS members_md5 FROM ranked GROUP BY company_id, part)
      SELECT {COMPANY_COLUMNS}, project_count AS total_projects, part, ceil(project_count / 10)::INTEGER AS parts, listed,
        countries, pages.relationships, pages.first_gid, members_md5, data_source
      FROM v_comp c JOIN pages USING (company_id)""",
    "a04_companies_mart": f"""
      SELECT {COMPANY_COLUMNS}, CASE WHEN rel THEN 'T' || s_suppkey END AS ticker,
        CASE WHEN rel THEN CASE WHEN s_nationkey % 2 = 0 THEN 'EVEN' ELSE 'ODD' END END AS exchange,
        NULL::VARCHAR AS website, NULL::VARCHAR AS ceo, CASE WHEN rel THEN n_name END AS headquarters,
        CASE WHEN rel THEN 'Industry ' || (s_suppkey % 7) END AS industry, project_count, countries, data_source
      FROM (SELECT *, data_source = 'relationships' AS rel FROM v_comp) c
        LEFT JOIN v_supp ON company_id = s_suppkey::VARCHAR""",
    "a05_data_sources": """SELECT s AS data_source, count(*) AS project_count FROM
                           (SELECT unnest(string_split(data_sources, ', ')) AS s FROM v_proj) GROUP BY s""",
    "a06_processing_summary": "SELECT metric, value FROM v_summary",
    "a07_source_set": """SELECT string_agg(DISTINCT s, ', ' ORDER BY s) AS data_sources FROM
                         (SELECT unnest(string_split(data_sources, ', ')) AS s FROM v_proj)""",
    "a08_run_counters": """
      SELECT p.n + f.n AS total_projects, p.n AS completed_projects, f.n AS failed_projects, api AS api_projects,
        scraped AS scraped_projects, enriched AS relationships_enriched
      FROM (SELECT count(*) AS n, count(*) FILTER (contains(data_sources, 'api')) AS api,
              count(*) FILTER (contains(data_sources, 'scraper')) AS scraped,
              count(*) FILTER (company_source = 'relationships') AS enriched FROM v_proj) p,
        (SELECT count(*) AS n FROM v_fail) f""",
    "a09_error_summary": """SELECT 'k_' || json_extract_string(props, '$.k') AS error_type, count(*) AS errors FROM events
                            WHERE event_type = 'error' GROUP BY 1""",
    "a10_success_rate": """
      SELECT user_id, CASE WHEN t = 0 THEN 0 ELSE round(c / t * 100, 6) END::DOUBLE AS success_rate FROM (
        SELECT user_id, count(*) FILTER (event_type <> 'view') AS t, count(*) FILTER (event_type = 'click') AS c
        FROM events GROUP BY user_id)""",
    "a11_duration": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey * 1.5::DOUBLE END AS seconds
                       FROM orders""",
    "a12_batch_totals": """
      SELECT batch_id, count(*) FILTER (f.gid IS NULL) AS completed, count(*) FILTER (f.gid IS NOT NULL) AS failed
      FROM v_batches b LEFT JOIN v_fail f USING (gid) GROUP BY ROLLUP (batch_id)""",
    "a13_relationship_digest": f"""
      WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY gid ORDER BY {EDGE_ORDER}) AS rn,
        count(*) OVER (PARTITION BY gid) AS n_edges FROM v_edges)
      SELECT gid, ((rn - 1) // 10)::INTEGER AS part, ceil(any_value(n_edges) / 10)::INTEGER AS parts,
        string_agg(kind || ':' || company_name || CASE WHEN coalesce(percentage, 0) <> 0
        THEN ' (' || percentage || '%)' ELSE '' END, ', ' ORDER BY rn) AS digest FROM ranked GROUP BY gid, (rn - 1) // 10""",
    "a14_lineage_union": """
      SELECT f.gid, CASE WHEN f.gid IN (SELECT gid FROM v_edges) THEN 'api, relationships'
        WHEN r.has_comp THEN 'api, scraper' ELSE 'api' END AS data_sources
      FROM v_last f LEFT JOIN v_rec1 r USING (gid)""",
    "a15_relationship_presence": """SELECT gid, count(*) AS relationship_count, bool_or(kind = 'jv') AS has_jv
                                    FROM v_items GROUP BY gid""",
    "w01_primary_company": "SELECT gid, company_id, company_name, relationship_type, percentage FROM v_primary",
    "w02_last_write_wins": "SELECT gid, country, row_ord, location FROM v_last",
    "w03_batches": "SELECT gid, batch_id FROM v_batches",
    "w03_stable_batches": """
      SELECT gid, ((row_number() OVER (ORDER BY late, md5(gid), gid) - 1) // 100)::BIGINT AS batch_id
      FROM (SELECT gid, gid NOT IN (SELECT gid FROM v_last) AS late FROM v_gids)""",
    "w04_state_by_delivery": """
      SELECT gid, p.company_id AS primary_id, f.company_name AS first_name, p.rel_count AS relationship_count, p.jv_count, l.row_ord,
        l.location, u.project_url
      FROM (SELECT gid FROM v_last UNION SELECT gid FROM v_edges) LEFT JOIN v_last l USING (gid) LEFT JOIN v_primary p USING (gid)
        LEFT JOIN v_first f USING (gid) LEFT JOIN v_urls u USING (gid)""",
    "w04_first_seen": """SELECT company_id, company_name, CASE WHEN data_source = 'relationships' THEN 'T' || company_id END
                         AS ticker, data_source FROM v_comp""",
    "w05_value_on_next_line": """
      WITH lines AS (SELECT doc_id, source, [l FOR l IN [trim(x) FOR x IN string_split(text, chr(10))] IF l <> ''] AS ls
                     FROM documents)
      SELECT doc_id, 'stage' AS field, md5(coalesce(ls[1], 'Commodities:')) AS value_md5 FROM lines
      UNION ALL SELECT doc_id, 'commodities', md5(source) FROM lines""",
    "w06_priority_pick": """
      SELECT gid, title, CASE WHEN n % 5 >= 3 AND n % 8 = 4 THEN '1' WHEN n % 5 = 1 THEN (n % 70)::VARCHAR ELSE fast_id END
        AS company_id FROM v_kv""",
    "w07_last_name_match": "SELECT gid, matched_by, commodities FROM v_match",
    "o01_companies_by_size": "SELECT company_id, project_count FROM v_comp ORDER BY project_count DESC, company_id",
    "o02_sources_by_size": """SELECT s AS data_source, count(*) AS project_count FROM
      (SELECT unnest(string_split(data_sources, ', ')) AS s FROM v_proj) GROUP BY s ORDER BY 2 DESC, 1""",
    "o03_limit_gids": """SELECT gid FROM (SELECT DISTINCT gid FROM v_feed ORDER BY gid LIMIT 25)
                         WHERE (SELECT count(*) FROM v_gids) > 25
                         UNION ALL SELECT gid FROM v_gids WHERE (SELECT count(*) FROM v_gids) <= 25""",
    "o04_first_record": "SELECT gid, project_name, company_id, company_name FROM v_rec1",
    "o05_sorted_countries": "SELECT company_id, countries FROM v_comp",
    "u01_union_gids": "SELECT gid FROM v_gids",
    "u02_union_sources": """
      SELECT gid, CASE WHEN n % 6 = 0 THEN 'api, relationships, scraper' WHEN n % 3 = 0 THEN 'api, relationships'
        WHEN n % 2 = 0 THEN 'scraper' ELSE 'api, scraper' END AS data_sources FROM v_part""",
    "u03_concat_edges": """
      SELECT gid, l_orderkey AS body, 0::BIGINT AS ord, l_suppkey::VARCHAR AS company_id,
        'Company ' || l_suppkey AS company_name, kind AS relationship_type,
        CASE WHEN kind = 'jv' THEN (l_quantity * 2)::INT::DOUBLE END AS percentage,
        CASE WHEN kind = 'nsr' THEN l_linenumber ELSE l_orderkey END AS ownership_id,
        CASE WHEN kind = 'option' THEN l_suppkey END AS optionee_id, CASE WHEN kind = 'option' THEN 'first' END AS comments,
        CASE WHEN kind = 'jv' THEN 'T' || l_suppkey END AS ticker FROM v_items
      UNION ALL SELECT gid, l_orderkey, 1, '', 'Partner ' || l_linenumber, 'option', NULL, l_orderkey, NULL, NULL, NULL
      FROM v_items WHERE kind = 'option'""",
    "u04_append_batches": """SELECT gid, batch_id, f.gid IS NULL AS completed FROM v_batches LEFT JOIN v_fail f USING (gid)""",
    "u05_table_fragments": """
      SELECT gid, length(f) AS chars, md5(f) AS html_md5 FROM (
        SELECT gid, '<table class="properties-wrapper-table">' || kv AS f FROM v_html WHERE NOT in_block
        UNION ALL SELECT gid, '<table class="wide properties-wrapper-table">' || projects FROM v_html WHERE NOT in_block
        UNION ALL SELECT gid, '<div class="wide properties-wrapper-table"><table>' || kv || '<table>' || kv || '<table>' || projects || '</div>'
        FROM v_html WHERE in_block)""",
    "f01_normalize_text": r"""SELECT doc_id, md5(lower(trim(regexp_replace(text, '[\s\x{A0}\x{2000}-\x{200A}]+', ' ', 'g'))))
                              AS text_md5 FROM documents""",
    "f02_proper_case": f"""
      SELECT c_custkey, array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN {WORDS}], ' ') AS name
      FROM (SELECT c_custkey, '  the ' || c_mktsegment || '  SHOP of' || chr(9) || c_name || ' ' AS x FROM customer)""",
    "f03_slug": r"""SELECT gid, regexp_replace(replace(regexp_replace(lower(p_name || ' (No.' || p_brand ||
      ') & Co., "Ltd"/o''' || p_type), '[ /]', '-', 'g'), '&', 'and'), '[.,()''"]', '', 'g') AS slug FROM v_part""",
    "f04_gid_from_link": """
      SELECT gid, CASE WHEN n % 5 IN (0, 1) THEN gid WHEN n % 5 = 3 THEN '1' END AS strict,
        CASE WHEN n % 5 IN (0, 1, 2) THEN gid WHEN n % 5 = 3 THEN '1' END AS loose,
        CASE WHEN n % 5 = 3 THEN gid END AS company, CASE WHEN n % 5 = 0 THEN gid END AS after FROM v_part""",
    "f05_absolute_url": r"""
      WITH p AS (SELECT page_id, url, regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
          regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS origin, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path
          FROM pages),
        q AS (SELECT *, coalesce(nullif(regexp_extract(path, '^(.*/)', 1), ''), '/') AS dir FROM p)
      SELECT page_id, pos, CASE pos WHEN 0 THEN origin || '/a/b' WHEN 1 THEN origin || dir || 'c/d?x=1'
        WHEN 2 THEN scheme || '://h.example/x' WHEN 3 THEN 'https://z.example/q' WHEN 4 THEN 'mailto:a@b'
        WHEN 5 THEN regexp_extract(url, '^[^#]*') || '#f' WHEN 6 THEN origin || path || '?q=1' WHEN 7 THEN url
        WHEN 8 THEN origin || regexp_replace(dir, '[^/]*/$', '') || 'up' WHEN 9 THEN origin || dir || 'same' END AS absolute
      FROM q, (SELECT unnest(range(10)) AS pos)""",
    "f06_dash_to_null": "SELECT gid, CASE WHEN n % 4 = 3 THEN p_name END AS value FROM v_part",
    "f07_label_field": """SELECT gid, (['project_name', 'operator', 'commodities', 'stage', 'ticker_exchange',
      'project_name', NULL, 'operator'])[n % 8 + 1] AS field FROM v_part""",
    "f08_list_to_string": """SELECT gid, array_to_string(list_sort(list_append(string_split(p_name, ' '), p_type)), ', ')
                             AS listed FROM v_part""",
    "f09_pct_string": """
      SELECT o_orderkey, CASE WHEN w = 0 THEN '0.0%' ELSE ((2000 * p + w) // (2 * w) // 10) || '.' ||
        ((2000 * p + w) // (2 * w) % 10) || '%' END AS rate
      FROM (SELECT o_orderkey, o_orderkey % 97 AS p, o_orderkey % 89 + o_orderkey % 97 AS w FROM orders)""",
    "f10_coordinate_key": f"""SELECT gid, CASE WHEN n % 9 <> 0 THEN {rev_key('(n * 53 % 18000) / 7e0 - 90', 'n / 3e0')} END
                              AS cache_key FROM v_part""",
    "f11_to_double": "SELECT gid, CASE n % 4 WHEN 2 THEN n + 0.25::DOUBLE WHEN 3 THEN n::DOUBLE END AS number FROM v_part",
    "f12_iso_time": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso,
                       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS again FROM events""",
    "f13_run_clock": f"SELECT gid, '{STAMP}' AS stamped_at FROM v_part",
    "f14_stable_bucket": f"""SELECT c_custkey, ('0x' || substr(md5(c_name), 1, 7))::BIGINT % 100000 AS bucket,
                             {synthetic('c_name')} AS id FROM customer""",
    "f15_flags": "SELECT gid, n % 2 = 1 AS has_items, n % 3 = 2 AS has_state FROM v_part",
    "f16_split_list": "SELECT gid, unnest(list_append(string_split(p_name, ' '), p_type)) AS item FROM v_part",
    "f17_json_rows": """SELECT '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '","nation":' ||
      CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey::VARCHAR ELSE 'null' END || '}' AS value FROM supplier""",
    "f18_map_default": """SELECT gid, CASE n % 3 WHEN 0 THEN p_name WHEN 2 THEN 'none' END AS from_map,
                          CASE WHEN n % 3 = 0 THEN n ELSE -1 END AS from_json FROM v_part""",
    "h01_html_nodes": f"""SELECT page_id, {DECODE.format('h')} AS href, {DECODE.format('t')} AS text FROM (
      SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS h,
        unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS t FROM pages)""",
    "h01_html_cells": """
      WITH t AS (SELECT gid, p_name, n, nested, in_block::INT::BIGINT AS ahead, CASE WHEN nested THEN 2 ELSE 1 END AS step FROM v_pages),
        k AS (SELECT *, ahead + copy * step AS no FROM t, (SELECT unnest([0, 1]) AS copy))
      SELECT gid, no AS table_no, 0::BIGINT AS col_no, 'td' AS tag, 'Project Name' AS text FROM k
      UNION ALL SELECT gid, no, 1, 'td', 'KV ' || p_name FROM k
      UNION ALL SELECT gid, no + 1, 0, 'td', 'Stage' FROM k WHERE nested
      UNION ALL SELECT gid, no + 1, 1, 'td', 'Inner ' || (n % 5) FROM k WHERE nested
      UNION ALL SELECT gid, ahead + 2 * step, c, 'th', ['Project', 'Project Operator', 'Commodities', 'Stage'][c + 1]
      FROM t, (SELECT unnest([0, 1, 2, 3])::BIGINT AS c)""",
    "h02_page_title": f"""SELECT page_id, {DECODE.format("trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1))")} AS title
                          FROM pages""",
    "h03_page_links": f"""SELECT page_id, href, regexp_extract(url, '^([a-z]+://[^/]*)', 1) || href AS url,
        nullif(regexp_extract(href, '[?&]gid=([0-9]+)', 1), '') AS gid FROM (
      SELECT page_id, url, {DECODE.format('h')} AS href FROM (
        SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)">', 1)) AS h FROM pages))""",
    "h04_company_link": f"""
      SELECT gid, CASE n % 5 WHEN 0 THEN '{PREFIX}' || (n % 100) || '&x=1' WHEN 1 THEN '{PREFIX}' || (n % 70)
          WHEN 2 THEN '{PREFIX}' || (n % 60) ELSE CASE WHEN n % 8 = 4 THEN '{PREFIX}1'
          WHEN n % 5 = 3 THEN 'https://portal.example/other/' || n END END AS company_url,
        CASE n % 5 WHEN 0 THEN n % 100 WHEN 1 THEN n % 70 WHEN 2 THEN n % 60
          ELSE CASE WHEN n % 8 = 4 THEN 1 END END::VARCHAR AS company_id,
        n % 5 <> 4 OR n % 8 = 4 AS found FROM v_pages""",
    "h05_company_heading": "SELECT gid, heading AS anywhere, heading AS in_sider, NULL::VARCHAR AS in_nav FROM v_kv",
    "h06_fast_company_id": "SELECT gid, fast_id AS company_id FROM v_kv",
    "h07_table_kind": "SELECT gid, table_no, wide AS is_header FROM v_blocks",
    "h08_column_index": """SELECT gid, table_no, 0::BIGINT AS project_name, 1::BIGINT AS operator, 2::BIGINT AS commodities,
                           3::BIGINT AS stage, NULL::BIGINT AS ticker_exchange FROM v_blocks WHERE wide""",
    "h09_target_row_fill": """
      SELECT gid, CASE WHEN in_block THEN title ELSE coalesce(title, CASE WHEN n % 16 = 0 THEN 'x' ELSE 'decoy' END) END AS project_name,
        CASE WHEN in_block THEN NULL WHEN n % 16 = 0 THEN 'Au, ' || (n % 9) WHEN title IS NULL THEN 'Nothing' END AS commodities,
        CASE WHEN in_block THEN NULL WHEN n % 16 = 0 THEN 'by gid' WHEN title IS NULL THEN 'None' ELSE 'by name' END AS stage FROM v_kv""",
    "h10_key_values": """SELECT gid, table_no, kv_project AS project_name, kv_operator AS operator, kv_commodities AS commodities,
                         kv_stage AS stage, kv_ticker AS ticker_exchange FROM v_blocks WHERE NOT wide""",
    "h11_ownership_links": """
      SELECT gid, table_no, CASE WHEN o % 2 = 0 THEN n % 90 ELSE n % 80 END::VARCHAR AS id,
        CASE WHEN o % 2 = 0 THEN 'Alpha' || (n % 7) ELSE 'The Operator ' || (n % 7) || ' Co' END AS name
      FROM v_blocks, (SELECT unnest([0, 1, 2, 3]) AS o) WHERE NOT wide AND n % 8 = 4 AND (o < 2 OR in_block)""",
    "h12_primary_page_company": "SELECT gid, table_no, own_id AS id, own_name AS name FROM v_blocks WHERE NOT wide",
    "h13_company_projects": "SELECT gid, commodities, stage, project_summary_href, matched_by FROM v_match",
    "h14_label_lines": """SELECT gid, 'stage' AS field, p_type || ' line' AS value FROM v_pages
                          UNION ALL SELECT gid, 'commodities', p_brand || ' line' FROM v_pages""",
    "h15_two_pass_merge": """
      SELECT gid, f_project AS project_name, kv_operator AS operator, f_commodities AS commodities, f_stage AS stage,
        kv_ticker AS ticker_exchange, own_id AS company_id,
        CASE WHEN own_id IS NOT NULL THEN coalesce(kv_operator, own_name) END AS company_name FROM v_rec2""",
    "h16_page_records": f"""
      WITH r AS (SELECT *, coalesce(own_id, fast_id) AS cid, coalesce(heading, CASE WHEN own_id IS NOT NULL THEN
          coalesce(kv_operator, own_name) END, kv_operator) AS raw_name FROM v_rec2),
        named AS (SELECT *, array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN string_split_regex(raw_name, ' +')], ' ')
          AS cname FROM r)
      SELECT gid, f_project AS project_name, coalesce(kv_operator, cname) AS operator,
        coalesce(f_commodities, p_brand || ' line') AS commodities, coalesce(f_stage, p_type || ' line') AS stage, kv_ticker AS ticker_exchange,
        cid AS company_id, cname AS company_name, '{PREFIX}' || cid AS company_url, n % 5 = 0 AS company_profile_link_found
      FROM named""",
    "h17_page_map": f"""
      SELECT gid, project_name, CASE WHEN ok THEN mlat END AS latitude, CASE WHEN ok THEN mlon END AS longitude,
        CASE WHEN ok THEN 10::DOUBLE END AS map_zoom, CASE WHEN ok THEN 'Leaflet' END AS map_lib,
        CASE WHEN ok THEN 'scraper_map' END AS location_source, CASE WHEN hit THEN country END AS country,
        CASE WHEN hit THEN state END AS state, CASE WHEN hit THEN postcode END AS postcode,
        CASE WHEN hit THEN iso END AS iso3166_2, NULL::VARCHAR AS county, NULL::VARCHAR AS territory
      FROM (SELECT r.*, c.country, c.state, c.postcode, c.iso, coalesce(ok AND NOT c.negative, false) AS hit
            FROM (SELECT gid, project_name, n % 3 <> 0 AS ok, {LAT} AS mlat, {LON} AS mlon FROM v_rec1) r
            LEFT JOIN v_cache c ON c.cache_key = {rev_key('mlat', 'mlon')})""",
    "t01_incremental_assembly": """SELECT gid, name, operator, 'completed' AS processing_stage, company_id, state,
                                   relationship_count FROM v_proj""",
    "t01_waiting_gids": "SELECT gid, name, company_id, relationship_count FROM v_proj WHERE has_feed",
    "t02_dedup_within": "SELECT DISTINCT gid, '2025-01-01' AS day FROM v_feed",
    "t02_stream_dedup": "SELECT DISTINCT gid FROM v_feed",
    "t03_stream_errors": """
      WITH days AS (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, count(*) AS errors, max(ts) AS latest
                    FROM events WHERE event_type = 'error' GROUP BY 1)
      SELECT window_start, errors FROM days
      WHERE window_start + INTERVAL 1 DAY <= (SELECT max(latest) FROM days) - INTERVAL 1 HOUR""",
}

VIEWS["v_fkeyed"] = f"""
  SELECT *, CASE WHEN latitude IS NOT NULL AND NOT {truthy('loc_state')} THEN {rev_key('latitude', 'longitude')}
    WHEN latitude IS NULL AND {truthy('location')} AND NOT {truthy('loc_state')} THEN 'fwd:' || lower(location) END
    AS cache_key FROM v_last"""


def _needed(sql: str, seen: list[str]) -> list[str]:
    for name in re.findall(r"\bv_\w+", sql):
        if name in VIEWS and name not in seen:
            _needed(VIEWS[name], seen)
            if name not in seen:
                seen.append(name)
    return seen


def oracle_sql() -> dict[str, str]:
    """Self-contained SQL per query: the views it reads, in order, then its SELECT."""
    result = {}
    for name, select in SELECTS.items():
        ctes = ", ".join(f"{v} AS ({VIEWS[v]})" for v in _needed(select, []))
        body = select.strip()
        if body.startswith("WITH "):
            body = body[5:]
            result[name] = f"WITH {ctes}, {body}" if ctes else f"WITH {body}"
        else:
            result[name] = f"WITH {ctes} {body}" if ctes else body
    return result
