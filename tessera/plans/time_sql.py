"""SQL that reads timestamps independently of the operators: fragments for the SQL of queries that need them.

The rules are those of TESTDATA.md; daylight saving is computed from the law's Sundays. Years 1987 and later.
"""

from __future__ import annotations

_FORMATS = [
    "%Y%m%d", "%Y-%m-%d", "%m/%d/%y", "%m/%d/%Y", "%d-%b-%Y", "%Y/%m/%d", "%d %b %Y", "%B %d, %Y", "%b %d, %Y", "%Y%m%d%H%M%S", "%Y%m%d%H%M", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S",
    "%m/%d/%Y %I:%M:%S %p", "%m/%d/%Y %I:%M %p", "%d-%b-%Y %H:%M:%S", "%d %b %Y %H:%M:%S",
]
_ZONE = "(Z|[+-][0-9]{2}:?[0-9]{2}|[A-Z]{3})$"


def _sunday(year: str, month: int, n: int) -> str:
    first = f"make_date({year}, {month}, 1)"
    return f"({first} + ((7 - dayofweek({first})) % 7 + {7 * (n - 1)})::INTEGER)"


def _dst(moment: str, from_hours: int, to_hours: int) -> str:
    y = f"year({moment})"
    start = f"(CASE WHEN {y} >= 2007 THEN {_sunday(y, 3, 2)} ELSE {_sunday(y, 4, 1)} END)::TIMESTAMP + INTERVAL {from_hours} HOUR"
    last = f"(make_date({y}, 10, 31) - dayofweek(make_date({y}, 10, 31))::INTEGER)"
    end = f"(CASE WHEN {y} >= 2007 THEN {_sunday(y, 11, 1)} ELSE {last} END)::TIMESTAMP + INTERVAL {to_hours} HOUR"
    return f"({moment} >= {start} AND {moment} < {end})"


def read_times(source: str, keys: str, value: str, name: str) -> str:
    """CTEs of which ``name`` has ``keys``, utc (of instants) and day (of dates), nulls where there is none."""
    formats = "[" + ", ".join(f"'{f}'" for f in _FORMATS) + "]"
    wall = f"regexp_replace(regexp_replace(CASE WHEN z <> '' THEN regexp_replace(x, '(\\.[0-9]+)? ?{_ZONE}', '') ELSE x END, '^[A-Z][a-z]{{2}}, ', ''), ' ET$', '')"
    return f"""
  {name}_a AS (SELECT {keys}, trim(regexp_replace({value}, '^<[^>]*>', '')) AS x FROM {source}),
  {name}_b AS (SELECT *, regexp_extract(x, ':[0-9]{{2}}(?:\\.[0-9]+)? ?{_ZONE}', 1) AS z FROM {name}_a),
  {name}_c AS (SELECT *, CASE WHEN regexp_matches(x, '^([0-9]{{10}}|[0-9]{{13}})$') THEN make_timestamp((x::BIGINT // CASE length(x) WHEN 13 THEN 1000 ELSE 1 END) * 1000000) ELSE try_strptime({wall}, {formats}) END AS w,
    CASE WHEN regexp_matches(x, '^([0-9]{{10}}|[0-9]{{13}})$') OR z IN ('Z', 'UTC', 'GMT') THEN 0 WHEN z = 'EST' OR z = 'CDT' THEN -300 WHEN z = 'EDT' THEN -240 WHEN z = 'CST' OR z = 'MDT' THEN -360
      WHEN z = 'MST' OR z = 'PDT' THEN -420 WHEN z = 'PST' THEN -480 WHEN z <> '' THEN CASE WHEN z[1] = '-' THEN -1 ELSE 1 END * (z[2:3]::INTEGER * 60 + right(z, 2)::INTEGER) END AS o,
    regexp_matches(x, ':|^[0-9]{{10}}$|^[0-9]{{12,14}}$') AS timed FROM {name}_b),
  {name}_d AS (SELECT *, CASE WHEN o IS NOT NULL THEN w - o * INTERVAL 1 MINUTE WHEN {_dst('w', 3, 2)} THEN w + INTERVAL 4 HOUR ELSE w + INTERVAL 5 HOUR END AS u FROM {name}_c),
  {name} AS (SELECT {keys}, CASE WHEN timed THEN u END AS utc, CASE WHEN o IS NULL THEN w::DATE ELSE (u - INTERVAL 5 HOUR + CASE WHEN {_dst('u', 7, 6)} THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END)::DATE END AS day FROM {name}_d)"""


P3 = f"""WITH {read_times("(SELECT filing_id, processed_at_utc, 'acceptance_datetime' AS field_name, acceptance_datetime AS v FROM filings UNION ALL SELECT filing_id, processed_at_utc, 'filed_as_of_date', filed_as_of_date FROM filings UNION ALL SELECT filing_id, processed_at_utc, 'period_of_report', period_of_report FROM filings)", 'filing_id, processed_at_utc, field_name', 'v', 't')},
  n AS (SELECT filing_id, field_name, processed_at_utc, CASE WHEN field_name = 'acceptance_datetime' THEN strftime(utc, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime(day, '%Y-%m-%d') END AS v FROM t)
  SELECT filing_id, field_name, arg_max(v, (processed_at_utc, v)) AS normal_value FROM n WHERE v IS NOT NULL AND filing_id IS NOT NULL GROUP BY 1, 2"""

CIK = "nullif(ltrim(regexp_extract({}, '^[^0-9]*([0-9]+)[^0-9]*$', 1), '0'), '')"
FILED = f"""{read_times('filings', 'filing_id', 'filed_as_of_date', 'ft')}, filed AS (SELECT filing_id, max(day) AS day FROM ft WHERE filing_id IS NOT NULL GROUP BY 1)"""


def month_day(column: str) -> str:
    """``mmdd`` of a fiscal year end however written, null where it is none."""
    x = f"trim(regexp_replace(upper({column}), '\\s+', ' ', 'g'))"
    month = f"(position(left({x}, 3) IN 'JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC') + 2) // 3"
    md = f"CASE WHEN regexp_matches({x}, '^[A-Z]{{3}}[A-Z]* [0-9]{{1,2}}$') THEN lpad(({month})::VARCHAR, 2, '0') || lpad(regexp_extract({x}, '[0-9]+$'), 2, '0') WHEN regexp_matches({x}, '^-{{0,2}}[0-9]{{1,2}}[-/]?[0-9]{{2}}$') THEN lpad(regexp_replace({x}, '[-/]', '', 'g'), 4, '0') END"
    return f"CASE WHEN try_strptime('2000' || ({md}), '%Y%m%d') IS NOT NULL THEN {md} END"


def _history(states: dict[str, str], placeholders: tuple[str, ...]) -> str:
    """CTEs: l (snapshots in order with the value before), nm (dated former names), lastname."""
    names = ", ".join(f"('{name}', '{code}')" for code, name in states.items())
    squeezed = "trim(regexp_replace(upper({}), '\\s+', ' ', 'g'))"
    name = squeezed.format("conformed_name")
    nothing = ", ".join(f"'{x}'" for x in placeholders)
    code = "nullif(ltrim(coalesce(nullif(regexp_extract(sic, '\\[\\s*([0-9]+)\\s*\\]', 1), ''), regexp_extract(sic, '^\\s*([0-9]+)\\s*$', 1)), '0'), '')"
    return f"""{FILED}, s(name, code) AS (VALUES {names}),
  c AS (SELECT filing_id, {CIK.format('cik')} AS cik, {code} AS sic, coalesce(s1.code, s2.code) AS state, {month_day('fiscal_year_end')} AS fy,
      CASE WHEN regexp_matches({name}, '[[:alnum:]_]') AND {name} NOT IN ({nothing}) THEN {name} END AS name
    FROM company_data LEFT JOIN s s1 ON s1.name = {squeezed.format('state_of_incorporation')} LEFT JOIN s s2 ON s2.code = {squeezed.format('state_of_incorporation')}),
  g AS (SELECT filing_id, max(cik) AS cik, max(sic) AS sic, max(state) AS state, max(fy) AS fy, max(name) AS name FROM c WHERE filing_id IS NOT NULL GROUP BY 1),
  v AS (SELECT cik, filing_id, day, unnest(['sic', 'state_of_incorporation', 'fiscal_year_end']) AS attribute, unnest([sic, state, fy]) AS value FROM g JOIN filed USING (filing_id) WHERE cik IS NOT NULL AND day IS NOT NULL),
  l AS (SELECT *, lag(value) OVER (PARTITION BY cik, attribute ORDER BY day, filing_id) AS before FROM v WHERE value IS NOT NULL), {read_times('former_names', 'filing_id, former_name', 'date_of_name_change', 'nt')},
  nm AS (SELECT cik, day AS ended, min(coalesce({squeezed.format('former_name')}, '')) AS value FROM nt JOIN g USING (filing_id) WHERE day IS NOT NULL AND cik IS NOT NULL GROUP BY 1, 2),
  lastname AS (SELECT cik, arg_max(name, (day, filing_id)) AS name FROM g JOIN filed USING (filing_id) WHERE cik IS NOT NULL AND day IS NOT NULL AND name IS NOT NULL GROUP BY 1)"""


def p1(states: dict[str, str], placeholders: tuple[str, ...]) -> str:
    return f"""WITH {_history(states, placeholders)} SELECT DISTINCT cik, attribute, strftime(day, '%Y-%m-%d') AS valid_from FROM l WHERE before <> value
  UNION SELECT cik, 'conformed_name', strftime(ended, '%Y-%m-%d') FROM nm"""


def p1_history(states: dict[str, str], placeholders: tuple[str, ...]) -> str:
    return f"""WITH {_history(states, placeholders)}, r AS (SELECT *, row_number() OVER w AS k, lead(day) OVER w AS until FROM l WHERE before IS NULL OR before <> value WINDOW w AS (PARTITION BY cik, attribute ORDER BY day, filing_id)),
  d AS (SELECT *, row_number() OVER w AS k, lag(ended) OVER w AS since, lead(ended) OVER w AS following FROM nm WINDOW w AS (PARTITION BY cik ORDER BY ended)),
  a AS (SELECT cik, attribute, k, day AS valid_from, until AS valid_to, CASE WHEN attribute = 'sic' AND length(value) < 4 THEN lpad(value, 4, '0') ELSE value END AS value FROM r
    UNION ALL SELECT cik, 'conformed_name', k, since, ended, nullif(value, '') FROM d
    UNION ALL SELECT cik, 'conformed_name', k + 1, ended, NULL, name FROM d LEFT JOIN lastname USING (cik) WHERE following IS NULL
    UNION ALL SELECT cik, 'conformed_name', 1, NULL, NULL, name FROM lastname WHERE cik NOT IN (SELECT cik FROM nm))
  SELECT cik, attribute, k::INTEGER AS version, valid_from, valid_to, value FROM a"""
