"""The registered queries in plain SQL, over the same whole tables.

Means are taken from the numbers, not from the packed lines, and keys from the
names, so that packing, splitting and parsing are checked and not repeated.
"""

from __future__ import annotations

from lakemark.constants import (
    DEFENSE_CODE,
    ENERGY_CODE,
    FIRST_SERIES_TOKEN,
    TOKENS_PER_LINE,
)

_PART_SIZE = 50

_EVENTS = """
events_in AS (
  SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
              THEN NULL ELSE n_name END AS country_txt,
         CAST(year(o_orderdate) AS INTEGER) AS iyear,
         CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'Unknown' WHEN '5-LOW' THEN ''
              WHEN '2-HIGH' THEN NULL ELSE c_name END AS gname,
         o_orderstatus AS outcome
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
)"""

_COUNTS = _EVENTS + """,
counts AS (SELECT {key} AS k, count(*) AS n FROM events_in GROUP BY 1)"""

_CLAIMS = _EVENTS + """,
counts AS (
  SELECT CASE WHEN gname IS NULL OR gname IN ('', 'Unknown') THEN '' ELSE gname END AS k,
         CAST(sum(CASE WHEN gname IS NULL OR gname IN ('', 'Unknown') THEN 0 ELSE 1 END)
              AS BIGINT) AS n
  FROM events_in GROUP BY 1
)"""

_LISTED = """
SELECT n AS "NumOfAttacks",
       '[' || string_agg(coalesce(CAST(k AS VARCHAR), 'null'), ', '
                         ORDER BY k NULLS FIRST) || ']' AS "{field}"
FROM counts GROUP BY n"""

_PART_OF = """
CAST(CAST('0x' || substr(md5(coalesce({item}, '')), 1, 8) AS BIGINT)
     % CAST(ceil({total} / CAST({size} AS DOUBLE)) AS BIGINT) AS BIGINT)"""

# Two indicators of every nation in long form, whole table, one row per cell.
_CELLS = """
cells AS (
  SELECT s_nationkey AS nk, (year(l_shipdate) - 1995) * 4 + quarter(l_shipdate) - 1 AS cell,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
         CAST(sum(CASE WHEN l_returnflag = 'R' AND l_quantity = 50 THEN 1 END)
              AS BIGINT) AS returned
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2
),
nations AS (
  SELECT n_nationkey AS nk, n_name AS plain, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
-- spelling, country it is cut to, and how often the line is there
spellings AS (
  SELECT nk, plain, plain || ', The' AS name, 1 AS copies FROM nations WHERE region = 'AFRICA'
  UNION ALL
  SELECT nk, plain, plain, CASE region WHEN 'ASIA' THEN 2 ELSE 1 END
  FROM nations WHERE region <> 'AFRICA'
  UNION ALL
  SELECT nk, plain, plain || ', North', 1 FROM nations WHERE region = 'EUROPE'
)"""

_MEANS = _CELLS + """,
means AS (
  SELECT plain, name, copies, coalesce(avg({measure}), 0) AS mean
  FROM spellings LEFT JOIN cells USING (nk) GROUP BY plain, name, copies
)"""

# The packed line of every spelling and indicator.
_LINES = _CELLS + f""",
numbered AS (
  SELECT nk, plain, name, copies, cell
  FROM spellings, generate_series(0, {TOKENS_PER_LINE - FIRST_SERIES_TOKEN - 1}) AS g(cell)
),
packed AS (
  SELECT plain, name, copies, numbered.nk,
         string_agg('"' || coalesce(CAST(quantity AS VARCHAR), '') || '"', ','
                    ORDER BY numbered.cell) AS energy_cells,
         string_agg('"' || coalesce(CAST(returned AS VARCHAR), '') || '"', ','
                    ORDER BY numbered.cell) AS defense_cells
  FROM numbered LEFT JOIN cells ON cells.nk = numbered.nk AND cells.cell = numbered.cell
  GROUP BY 1, 2, 3, 4
),
lines AS (
  SELECT plain, name, copies, '{ENERGY_CODE}' AS code,
         '"' || name || '","N' || nk || '","Power from oil","{ENERGY_CODE}",' || energy_cells AS line
  FROM packed
  UNION ALL
  SELECT plain, name, copies, '{DEFENSE_CODE}',
         '"' || name || '","N' || nk || '","Defense spending","{DEFENSE_CODE}",' || defense_cells
  FROM packed
),
all_lines AS (SELECT lines.* FROM lines, generate_series(1, 2) AS g(i) WHERE i <= copies)"""

_TOTALS = """
totals AS (
  SELECT n_nationkey AS nation, n_name AS plain,
         CASE r_name WHEN 'AFRICA' THEN '"' || n_name || '"' ELSE n_name END AS country,
         coalesce(suppliers, 0) AS suppliers, coalesce(quantity, 0) AS quantity
  FROM nation JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY 1) AS s
    ON s.s_nationkey = n_nationkey
  LEFT JOIN (SELECT s_nationkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
             FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1) AS q
    ON q.s_nationkey = n_nationkey
),
total_lines AS (
  SELECT *, nation || ';' || country || ';' || suppliers || ';' || quantity AS line FROM totals
)"""

_EVENT_TEXT = """'[' || coalesce(country_txt, 'null') || ', ' || coalesce(CAST(iyear AS VARCHAR), 'null')
  || ', ' || coalesce(gname, 'null') || ', ' || coalesce(outcome, 'null') || ']'"""

# Finished events lack what is null, the others say so and have a nested field.
_DOCUMENT_TEXT = """CASE WHEN outcome = 'F' THEN '[' || concat_ws(', ', country_txt, iyear, gname, outcome) || ']'
  ELSE '[' || concat_ws(', ', outcome, coalesce(gname, 'null'), '{"a":[' || iyear || ',1],"z":"' || outcome || '"}',
                        coalesce(country_txt, 'null'), iyear) || ']' END"""

_TOTALS_JOIN = f"""
WITH {_EVENTS}, {_TOTALS}
SELECT country_txt, iyear, gname, outcome, line
FROM events_in JOIN total_lines ON country_txt = country"""


def _report(measure: str, condition: str = "plain") -> str:
    return f"""
WITH {_COUNTS.format(key="country_txt")}, {_MEANS.format(measure=measure)}
SELECT n, k AS country_txt, mean FROM counts JOIN means ON k = {condition}"""


# Text columns of the profiled tables with their positions.
_TEXT_COLUMNS = {
    "part": {1: "p_name", 2: "p_brand", 3: "p_type"},
    "customer": {1: "c_name", 4: "c_mktsegment"},
    "orders": {2: "o_orderstatus", 5: "o_orderpriority"},
    "documents": {1: "text", 2: "lang", 3: "source"},
    "pages": {1: "url", 2: "html"},
    "conversations": {2: "role", 3: "text"},
    "lineitem": {8: "l_returnflag", 9: "l_linestatus"},
}


def _column_profile(table: str, columns: dict[int, str]) -> str:
    return "\nUNION ALL".join(
        f"""
SELECT CAST({at} AS INTEGER) AS column_index, '{name}' AS column_name,
       count(*) AS different_values,
       CAST(sum(CASE WHEN v IS NULL OR v IN ('null', '0') THEN 1 ELSE 0 END)
            AS BIGINT) AS sentinel_groups
FROM (SELECT DISTINCT {name} AS v FROM {table})"""
        for at, name in columns.items()
    )


def _candidates(table: str, columns: dict[int, str]) -> str:
    return f"""
candidates AS (
  SELECT * FROM ({_column_profile(table, columns)})
  WHERE sentinel_groups <= 1 AND different_values >= 5
)"""


_FIRST_BEST = """(SELECT column_index FROM candidates
                  ORDER BY different_values, column_index LIMIT 1)"""


def _key_column(table: str) -> str:
    return f"""
WITH {_candidates(table, _TEXT_COLUMNS[table])}
SELECT CAST(coalesce({_FIRST_BEST}, 0) AS INTEGER) AS key_column,
       EXISTS (SELECT 1 FROM candidates) AS has_candidates"""


_PART_VALUES = "\nUNION ALL".join(
    f"""
SELECT CAST({at} AS INTEGER) AS column_index, '{name}' AS column_name, {name} AS value,
       count(*) AS n
FROM part GROUP BY {name}"""
    for at, name in _TEXT_COLUMNS["part"].items()
)

ORACLES: dict[str, str] = {
    "events_by_country": f"WITH {_COUNTS.format(key='country_txt')} "
    "SELECT k AS country_txt, n FROM counts",
    "events_by_country_named_apart": f"WITH {_COUNTS.format(key='country_txt')} "
    "SELECT k AS country_txt, n FROM counts",
    "events_by_year": f"WITH {_COUNTS.format(key='iyear')} SELECT k AS iyear, n FROM counts",
    "events_by_claimant": f"WITH {_CLAIMS} SELECT k AS gname, n FROM counts",
    "most_attacked_countries": f"WITH {_COUNTS.format(key='country_txt')}"
    + _LISTED.format(field="Countries"),
    "attacks_per_year": f"WITH {_COUNTS.format(key='iyear')}" + _LISTED.format(field="Years"),
    "claimed_attacks": f"WITH {_CLAIMS}" + _LISTED.format(field="GroupName"),
    "claimed_attacks_parts": f"""
WITH {_CLAIMS},
placed AS (
  SELECT n, k, (row_number() OVER (PARTITION BY n ORDER BY k) - 1) // {_PART_SIZE} AS part
  FROM counts
)
SELECT n, part, '[' || string_agg(k, ', ' ORDER BY k) || ']' AS keys
FROM placed GROUP BY n, part""",
    "claimed_attacks_long": f"WITH {_CLAIMS} SELECT n, k AS key FROM counts",
    "claimed_attacks_fixed_parts": f"""
WITH {_CLAIMS},
placed AS (
  SELECT n, k, {_PART_OF.format(item="k", total="3.0", size="1.0")} AS part FROM counts
)
SELECT n AS "NumOfAttacks", part AS "Part",
       '[' || string_agg(k, ', ' ORDER BY k) || ']' AS "GroupName"
FROM placed GROUP BY n, part""",
    "top5_countries": f"""
WITH {_COUNTS.format(key="country_txt")}
SELECT k AS country_txt, n FROM counts ORDER BY n DESC, k NULLS FIRST LIMIT 5""",
    "saved_documents": f"WITH {_COUNTS.format(key='country_txt')}"
    + _LISTED.format(field="Countries"),
    "ingested_events": f"""
WITH {_EVENTS}
SELECT coalesce(gname, '') AS gname, count(*) AS n FROM events_in GROUP BY 1""",
    "ingested_events_multiline": """
SELECT lang AS country_txt, CAST(doc_id % 50 AS INTEGER) AS iyear, count(*) AS n,
       CAST(sum(length(text)) AS BIGINT) AS chars,
       CAST(sum(length(text) - length(replace(text, chr(10), ''))) AS BIGINT) AS breaks,
       min(md5(text)) AS least_digest
FROM documents GROUP BY 1, 2""",
    "replaced_collection": f"""
WITH {_EVENTS}
SELECT 'current' AS version, iyear, count(*) AS n FROM events_in WHERE outcome = 'F' GROUP BY ALL
UNION ALL SELECT 'first', iyear, count(*) FROM events_in GROUP BY ALL""",
    "row_text_documents": f"""
WITH {_EVENTS}
SELECT country_txt, iyear, gname, {_DOCUMENT_TEXT} AS event FROM events_in""",
    "indicator_matches_documents": f"""
WITH {_EVENTS}, {_LINES}
SELECT country_txt, line, {_DOCUMENT_TEXT} AS event, CAST(copies AS BIGINT) AS copies
FROM events_in JOIN lines ON country_txt = plain WHERE code = '{ENERGY_CODE}'""",
    "lake_lines_latin1": r"""
SELECT value, count(*) AS n FROM (
  SELECT unnest(string_split(regexp_replace(replace(text, chr(13), ''), '[^\x{0}-\x{FF}]', '?', 'g'), chr(10))) AS value FROM documents
) GROUP BY 1""",
    "row_text": f"""
WITH {_EVENTS}
SELECT country_txt, {_EVENT_TEXT} AS event FROM events_in""",
    "lake_lines_no_header": f"WITH {_LINES} SELECT line AS value FROM all_lines",
    "lake_keys": f"""
WITH {_LINES}, {_TOTALS}
SELECT ',' AS sep, plain AS first_comma, name AS by_index, code AS field_3 FROM all_lines
UNION ALL
SELECT ';', nation || ';' || plain || ';' || suppliers || ';' || quantity, country,
       CAST(quantity AS VARCHAR)
FROM totals""",
    "lake_table": f"WITH {_TOTALS} SELECT nation, plain AS country, suppliers, quantity FROM totals",
    "indicator_series_mean": f"""
WITH {_MEANS.format(measure="quantity")}
SELECT plain AS country_txt, mean FROM means""",
    "attacks_energy": _report("quantity"),
    "attacks_defense": _report("returned"),
    "attacks_energy_quoted": _report("quantity", "name"),
    "attacks_energy_documents": f"""
SELECT n AS "NumOfAttacks", country_txt AS "Country",
       CAST(mean AS VARCHAR) AS "Average Production of Energy"
FROM ({_report("quantity")})""",
    "attacks_energy_file": f"""
SELECT '(' || n || ',(' || country_txt || ',' || CAST(mean AS VARCHAR) || '))' AS value
FROM ({_report("quantity")})""",
    "attacks_energy_file_nulls": f"""
SELECT '(' || n || ',(' || country_txt || ',' || coalesce(CAST(mean AS VARCHAR), 'null') || '))' AS value
FROM (
WITH {_COUNTS.format(key="country_txt")}, {_CELLS},
means AS (
  SELECT plain, name, copies, avg(CASE WHEN name NOT LIKE '%, The' THEN quantity END) AS mean
  FROM spellings LEFT JOIN cells USING (nk) GROUP BY plain, name, copies
)
SELECT n, k AS country_txt, mean FROM counts JOIN means ON k = plain)""",
    "attacks_defense_documents": f"""
SELECT n AS "NumOfAttacks", country_txt AS "Country",
       CAST(mean AS VARCHAR) AS "Average expenditure for Defense"
FROM ({_report("returned")})""",
    "preview": f"WITH {_EVENTS} SELECT least(count(*), 5) AS rows FROM events_in",
    "indicator_matches": f"""
WITH {_EVENTS}, {_LINES}
SELECT country_txt, line, {_EVENT_TEXT} AS event, CAST(copies AS BIGINT) AS copies
FROM events_in JOIN lines ON country_txt = plain WHERE code = '{ENERGY_CODE}'""",
    "indicator_match_lists": f"""
WITH {_EVENTS}, {_LINES},
texts AS (
  SELECT country_txt, {_EVENT_TEXT} AS event, count(*) AS times
  FROM events_in WHERE country_txt IS NOT NULL GROUP BY 1, 2
),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY country_txt ORDER BY event) - 1) // {_PART_SIZE} AS part
  FROM texts
)
SELECT country_txt, line, CAST(copies AS BIGINT) AS copies, part,
       string_agg(event || ' x' || times, '; ' ORDER BY event) AS events
FROM placed JOIN lines ON country_txt = plain WHERE code = '{ENERGY_CODE}'
GROUP BY country_txt, line, copies, part""",
    "parametric_join_comma": f"""
WITH {_EVENTS}, {_LINES}
SELECT country_txt, {_EVENT_TEXT} AS event, line
FROM events_in JOIN all_lines ON country_txt = name""",
    "parametric_join_semicolon": _TOTALS_JOIN,
    "parametric_join_salted": _TOTALS_JOIN,
    "join_profiled": _TOTALS_JOIN,
    **{
        f"column_profile_{table}": _column_profile(table, columns)
        for table, columns in _TEXT_COLUMNS.items()
        if table != "lineitem"
    },
    **{f"key_column_{table}": _key_column(table) for table in _TEXT_COLUMNS},
    "candidate_columns": f"""
WITH {_EVENTS}, {_candidates("events_in", {0: "country_txt", 2: "gname", 3: "outcome"})}
SELECT * FROM candidates""",
    "stored_profile": f"""
WITH {_candidates("part", _TEXT_COLUMNS["part"])}
SELECT 'part' AS dataset, column_index AS column_number, different_values,
       CAST(NULL AS INTEGER) AS key_column
FROM candidates
UNION ALL
SELECT 'part', NULL, NULL, CAST(coalesce({_FIRST_BEST}, 0) AS INTEGER)""",
    "profile_documents": f"""
WITH {_candidates("orders", _TEXT_COLUMNS["orders"])}
SELECT column_index AS "Column Number", different_values AS "Different Values",
       CAST(NULL AS INTEGER) AS "Key Column"
FROM candidates
UNION ALL
SELECT NULL, NULL, CAST(coalesce({_FIRST_BEST}, 0) AS INTEGER)""",
    "distinct_groups": f"""
WITH {_EVENTS}
SELECT count(*) AS different_values FROM (SELECT DISTINCT gname FROM events_in)""",
    "column_values": _PART_VALUES,
    "saved_column_values": f'SELECT column_index AS "column", value FROM ({_PART_VALUES})',
}
