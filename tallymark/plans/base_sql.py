"""Common table expressions of the SQL oracles."""

SOURCE = "CASE regexp_replace(lower({c}), '[^a-z]', '', 'g') WHEN 'googlescholar' THEN 'google_scholar' WHEN '' THEN NULL ELSE regexp_replace(lower({c}), '[^a-z]', '', 'g') END"
DAY = "CASE WHEN substr(trim({c}), 5, 1) = '-' THEN substr(trim({c}), 1, 10) ELSE substr(trim({c}), 1, 4) || '-' || substr(trim({c}), 5, 2) || '-' || substr(trim({c}), 7, 2) END"
TIME = "rpad(regexp_replace(CASE WHEN substr(trim({c}), 5, 1) = '-' THEN substr(trim({c}), 11) ELSE substr(trim({c}), 9) END, '[^0-9]', '', 'g'), 9, '0')"
FLEX = "try_cast(CASE length(trim({c})) WHEN 4 THEN trim({c}) || '-01-01' WHEN 7 THEN trim({c}) || '-01' ELSE substr(trim({c}), 1, 10) END AS DATE)"
RANK = """CASE WHEN {c} IS NULL OR trim({c}) = '' THEN NULL
  ELSE CASE regexp_replace(regexp_replace(lower({c}), '[^a-z]', '', 'g'), '(professor|prof)$', '')
    WHEN 'assistant' THEN 'assistant' WHEN 'associate' THEN 'associate' WHEN 'full' THEN 'full' WHEN '' THEN 'full' ELSE 'other' END END"""
TRUST = "CASE source WHEN 'google_scholar' THEN 4 WHEN 'openalex' THEN 3 WHEN 'pop' THEN 2 WHEN 'manual' THEN 1 ELSE 0 END"

BASE = f"""WITH rd AS (
  SELECT snapshot_id, run_id, person_id, {SOURCE.format(c='source')} AS source, {DAY.format(c='collected_at')} || 'T' || {TIME.format(c='collected_at')} AS moment,
    {DAY.format(c='collected_at')} AS day, total_citations, h_index, i10_index, citations_5yr, h_index_5yr, works_count, raw_json FROM metric_snapshot),
ap AS (
  SELECT affiliation_id, person_id, department_id, {RANK.format(c='"rank"')} AS rank_name, appointment_type, is_primary,
    {FLEX.format(c='start_date')} AS start_day, {FLEX.format(c='end_date')} AS end_day, end_date IS NULL AS is_open, source FROM affiliation),
cur AS (SELECT ap.*, department.kind FROM ap, department WHERE department.department_id = ap.department_id AND is_open AND is_primary = 1 AND appointment_type = 'regular'),
latest AS (
  SELECT * EXCLUDE (top) FROM (SELECT *, max(moment) OVER (PARTITION BY person_id, source) AS top FROM rd WHERE source IS NOT NULL) WHERE moment = top),
pool AS (
  SELECT l.*, {TRUST} AS trust FROM latest l LEFT JOIN person p ON p.person_id = l.person_id
  WHERE CASE source WHEN 'google_scholar' THEN coalesce(p.google_scholar_id, '') <> '' WHEN 'openalex' THEN coalesce(p.openalex_author_id, '') <> '' ELSE true END),
heads AS (
  SELECT * EXCLUDE (place, trust), CASE WHEN source = 'google_scholar' THEN 0 ELSE 1 END AS is_fallback FROM (
    SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY trust DESC, moment DESC, snapshot_id DESC) AS place FROM pool) WHERE place = 1),
members AS (
  SELECT p.person_id, p.display_name, c.department_id, d.short_name AS department, c.rank_name, h.source, h.is_fallback, h.day, h.total_citations, h.h_index,
    try_cast(left(h.day, 4) AS BIGINT) - p.phd_year AS years_since_phd,
    CASE WHEN try_cast(left(h.day, 4) AS BIGINT) > p.phd_year THEN h.total_citations / (try_cast(left(h.day, 4) AS BIGINT) - p.phd_year) END AS citations_per_year
  FROM cur c, person p, department d, heads h
  WHERE c.kind = 'planning' AND p.person_id = c.person_id AND d.department_id = c.department_id AND h.person_id = c.person_id)
"""
