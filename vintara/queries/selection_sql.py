"""What the SQL twins of as-of selection and effective events have in common.

The policy is a relation, every row gets its origin once, and a choice is the greatest row by a
tuple (``arg_max``). Rows that a tuple compares hold no nulls.
"""

from .fixture import REGISTRY, RULES, SAFE_SERIES, SIDECAR, V

# Origins with their priority, and which of them are dated revisions.
_POLICY = """
    policy(origin, prio, dated) AS (VALUES
        ('PIT_A', 3, false), ('PIT_B', 2, false), ('WIND', 1, false), ('SAFE_ESTIMATED_D', 1, false), ('ESTIMATED_D', 1, false),
        ('EASTMONEY_D', 0, false), ('SINA_D', -1, false), ('WIND_REVISION', 1, true), ('OBSERVED_WEB_REVISION', 1, true))"""

# Which origin ends which other one's say, from its first visible moment.
YIELDS = """
    yields(weaker, stronger) AS (VALUES
        ('PIT_B', 'PIT_A'), ('WIND', 'PIT_A'), ('WIND', 'PIT_B'), ('SAFE_ESTIMATED_D', 'PIT_A'), ('SAFE_ESTIMATED_D', 'PIT_B'),
        ('ESTIMATED_D', 'PIT_A'), ('ESTIMATED_D', 'PIT_B'), ('EASTMONEY_D', 'PIT_A'), ('EASTMONEY_D', 'PIT_B'), ('EASTMONEY_D', 'WIND'),
        ('EASTMONEY_D', 'SAFE_ESTIMATED_D'), ('SINA_D', 'PIT_A'), ('SINA_D', 'PIT_B'), ('SINA_D', 'WIND'), ('SINA_D', 'SAFE_ESTIMATED_D'),
        ('SINA_D', 'EASTMONEY_D'))"""

_ORIGIN = """CASE pit_grade WHEN 'A' THEN 'PIT_A' WHEN 'B' THEN 'PIT_B' WHEN 'D' THEN CASE
        WHEN release_date_source = 'official_web_revision_first_seen' THEN
            CASE WHEN country = 'CN' OR (country, source) = ('GLB', 'IMF') THEN 'OBSERVED_WEB_REVISION' END
        WHEN (country, source) = ('GLB', 'IMF') AND release_date_source ^@ 'imf_current_history_snapshot_' THEN 'ESTIMATED_D'
        WHEN (country, source) = ('CN', 'WIND') AND release_date_source ^@ 'wind_revision_snapshot_' THEN 'WIND_REVISION'
        WHEN (country, release_date_source) = ('CN', 'third_party_current_history_first_seen_only') THEN
            map {'EASTMONEY_MACRO': 'EASTMONEY_D', 'SINA_MACRO': 'SINA_D'}[source] END END"""

LATEST_STATED = "ROW(o.vintage_no, coalesce(o.retrieved_at, '0001-01-01'::TIMESTAMP), o.source, coalesce(o.raw_sha256, ''), o.value)"

#: Facts with their origin; the sidecar rows that fill a gap; rule-estimated rows with the moment they count from.
TABLES = f"""
    {V}, {SIDECAR}, {RULES}, {REGISTRY}, {_POLICY},
    tagged AS (SELECT v.*, {_ORIGIN} AS origin, available_at AS moment FROM v),
    proven AS (SELECT DISTINCT canonical_series_id, period FROM tagged WHERE country = 'CN' AND origin IN ('PIT_A', 'PIT_B')),
    gaps AS (SELECT e.*, CASE WHEN e.source = 'SAFE' THEN 'SAFE_ESTIMATED_D' ELSE 'WIND' END AS origin
             FROM side e ANTI JOIN proven p USING (canonical_series_id, period)
             WHERE (e.source = 'SAFE') = (e.canonical_series_id = '{SAFE_SERIES}')),
    ruled AS (SELECT unnest(o) FROM (SELECT arg_max(o, {LATEST_STATED}) AS o FROM tagged o
                                     WHERE origin = 'ESTIMATED_D' GROUP BY canonical_series_id, period)),
    estimated AS (SELECT q.* REPLACE (CAST(q.period_end + (r.lag_days + 1) AS TIMESTAMP) - to_hours(8) AS moment)
                  FROM ruled q JOIN rules r ON r.canonical_series_id = q.canonical_series_id AND r.eligible),
    retired AS (SELECT canonical_series_id FROM registry WHERE NOT active)"""

SCOPE_SQL = {"CN": "country = 'CN'", "US": "country = 'US'", "GLB": "country NOT IN ('CN', 'US')", "ALL": "TRUE"}


def selection_steps(scope: str, cutoff: str, start: str, end: str) -> str:
    """Common tables after ``TABLES``, ending in ``sel``, the rows in force at the cutoff."""
    shown = "country, canonical_series_id, series_name, source, frequency, unit, period, period_end, value"
    return f"""
        named AS (SELECT unnest(o) FROM (
            SELECT arg_max(o, ROW(o.retrieved_at, o.vintage_no, o.raw_sha256, o.series_name)) AS o FROM tagged o
            WHERE country = 'CN' GROUP BY canonical_series_id, source)),
        offers AS (
            SELECT {shown}, origin AS selection_origin, moment AS available_at, vintage_no, pit_grade, release_date_source, retrieved_at, raw_sha256
            FROM (SELECT * FROM tagged WHERE origin <> 'ESTIMATED_D' UNION ALL BY NAME FROM estimated)
            UNION ALL BY NAME
            SELECT n.country, g.canonical_series_id, n.series_name, g.source, n.frequency, n.unit, g.period, g.period_end, g.value,
                   g.origin AS selection_origin, g.estimated_available_at AS available_at, 0 AS vintage_no, 'D' AS pit_grade,
                   'estimated_availability_sidecar' AS release_date_source
            FROM gaps g JOIN named n ON (n.canonical_series_id, n.source) = (g.canonical_series_id, g.source)),
        weighed AS (SELECT o, p.dated, ROW(p.prio, o.available_at, {LATEST_STATED}) AS merit,
                           ROW(o.available_at, p.prio, {LATEST_STATED}) AS recency
                    FROM offers o JOIN policy p ON p.origin = o.selection_origin
                    WHERE {SCOPE_SQL[scope]} AND o.available_at <= '{cutoff}'::TIMESTAMP
                      AND o.period_end BETWEEN '{start}'::DATE AND '{end}'::DATE),
        rivals AS (SELECT arg_max(o, merit) FILTER (NOT dated) AS standing, arg_max(recency, merit) FILTER (NOT dated) AS standing_since,
                          arg_max(o, recency) FILTER (dated) AS revision, arg_max(recency, recency) FILTER (dated) AS revised_at
                   FROM weighed GROUP BY o.country, o.canonical_series_id, o.period),
        sel AS (SELECT * EXCLUDE (retrieved_at, raw_sha256) FROM (
                    SELECT unnest(CASE WHEN standing IS NULL OR revised_at > standing_since THEN revision ELSE standing END) FROM rivals)
                WHERE canonical_series_id NOT IN (FROM retired))"""


def selected_sql(scope: str, cutoff: str, start: str, end: str) -> str:
    return f"{TABLES}, {selection_steps(scope, cutoff, start, end)}"


def work_tables(cuts: str) -> str:
    """Common tables of the work view at the moments of ``cuts``, a relation (as_of, cut), ending in ``latest``."""
    return f"""
        {V}, {SIDECAR}, {REGISTRY}, cuts AS ({cuts}),
        spoken AS (SELECT c.as_of, o.canonical_series_id, o.period,
                          arg_max(o, recency) FILTER (o.pit_grade IN ('A', 'B')) AS firm,
                          arg_max(o, recency) FILTER (o.pit_grade = 'D' AND (o.release_date_source = 'official_web_revision_first_seen'
                              OR (o.source = 'WIND' AND o.release_date_source ^@ 'wind_revision_snapshot_'))) AS revised
                   FROM cuts c JOIN (SELECT o, ROW(o.available_at, {LATEST_STATED}) AS recency FROM v o) ON o.available_at <= c.cut
                   GROUP BY ALL),
        described AS (SELECT unnest(o) FROM (
            SELECT arg_max(o, ROW(o.available_at, o.vintage_no, o.retrieved_at, o.raw_sha256, o.series_name)) AS o FROM v o
            GROUP BY canonical_series_id, source, period)),
        voices AS (
            SELECT as_of, unnest([{{'o': firm, 'prio': CASE firm.pit_grade WHEN 'A' THEN 3 ELSE 2 END, 'work_origin': 'work_' || firm.pit_grade}},
                                  {{'o': revised, 'prio': 1, 'work_origin': CASE revised.source WHEN 'WIND' THEN 'work_wind_revision' ELSE 'work_web_revision' END}}]) AS x
            FROM spoken),
        guesses AS (
            SELECT c.as_of, e.canonical_series_id, d.series_name, e.source, d.frequency, d.unit, d.seasonal_adjustment, e.period, e.period_end, e.value,
                   CASE e.source WHEN 'WIND' THEN 'work_wind' ELSE 'work_safe_d' END AS work_origin,
                   e.estimated_available_at AS available_at, 0 AS vintage_no, 0 AS prio
            FROM cuts c JOIN side e ON e.estimated_available_at <= c.cut
            ANTI JOIN (FROM spoken WHERE firm IS NOT NULL OR revised IS NOT NULL) s
                ON (s.as_of, s.canonical_series_id, s.period) = (c.as_of, e.canonical_series_id, e.period)
            LEFT JOIN described d ON (d.canonical_series_id, d.source, d.period) = (e.canonical_series_id, e.source, e.period)),
        heard AS (
            SELECT as_of, x.o.canonical_series_id, x.o.series_name, x.o.source, x.o.frequency, x.o.unit, x.o.seasonal_adjustment, x.o.period,
                   x.o.period_end, x.o.value, x.work_origin, x.o.available_at, x.o.vintage_no, x.prio
            FROM voices WHERE x.o IS NOT NULL
            UNION ALL BY NAME FROM guesses),
        latest AS (SELECT * EXCLUDE (prio) FROM (SELECT unnest(h) FROM (
            SELECT arg_max(h, ROW(h.period_end, h.available_at, h.prio, h.vintage_no, h.source, h.value)) AS h FROM heard h
            GROUP BY as_of, canonical_series_id)))"""


EVENT_START = "1995-01-01"
#: Common tables after ``TABLES``, ending in ``events``.
EVENT_STEPS = f"""
    carried AS (SELECT unnest(o) FROM (
        SELECT arg_max(o, ROW(o.retrieved_at, o.vintage_no, o.raw_sha256, o.value)) AS o FROM tagged o
        WHERE country = 'CN' AND pit_grade = 'D' AND source IN ('WIND', 'SAFE') AND origin IS DISTINCT FROM 'WIND_REVISION'
        GROUP BY canonical_series_id, period, source)),
    recorded AS (SELECT * EXCLUDE (origin, moment, frequency, available_at, ingest_seq, priority),
                        frequency AS source_frequency, origin AS selection_origin, moment AS visible_from
                 FROM (SELECT * FROM tagged WHERE origin <> 'ESTIMATED_D' UNION ALL BY NAME FROM estimated)),
    supplied AS (SELECT 'CN' AS country, g.canonical_series_id, g.source, g.period, g.period_end, g.value, g.origin AS selection_origin,
                        g.estimated_available_at AS visible_from, 'D' AS pit_grade, 'estimated_availability_sidecar' AS release_date_source,
                        coalesce(c.source_series_id, g.canonical_series_id) AS source_series_id,
                        coalesce(c.series_name, g.canonical_series_id) AS series_name, coalesce(c.frequency, 'M') AS source_frequency,
                        coalesce(c.unit, '') AS unit, coalesce(c.period_start, g.period_end) AS period_start,
                        coalesce(c.vintage_no, 0) AS vintage_no, coalesce(c.revision_type, 'initial') AS revision_type,
                        coalesce(c.parser_version, 'estimated_availability_v1') AS parser_version,
                        c.seasonal_adjustment, c.first_seen_at, c.revision_delta, c.source_url, c.raw_file, c.raw_sha256, c.retrieved_at
                 FROM gaps g LEFT JOIN carried c
                 ON (c.canonical_series_id, c.period, c.source) = (g.canonical_series_id, g.period, g.source)),
    cand AS (SELECT x.*, p.prio AS source_priority, CASE WHEN p.dated THEN 'DATED_REVISION' ELSE 'BASE_PRIORITY' END AS event_role
             FROM (FROM recorded UNION ALL BY NAME FROM supplied) x JOIN policy p ON p.origin = x.selection_origin),
    pool AS (FROM cand WHERE period_end >= '{EVENT_START}'::DATE AND canonical_series_id NOT IN (FROM retired)),
    voiced AS (SELECT unnest(o) FROM (
        SELECT arg_max(o, {LATEST_STATED}) AS o FROM pool o WHERE event_role = 'BASE_PRIORITY'
        GROUP BY country, canonical_series_id, period, selection_origin, visible_from)),
    {YIELDS},
    effective AS (FROM voiced e WHERE NOT EXISTS (
        FROM voiced s JOIN yields y ON y.stronger = s.selection_origin
        WHERE y.weaker = e.selection_origin AND s.visible_from <= e.visible_from
          AND (s.country, s.canonical_series_id, s.period) = (e.country, e.canonical_series_id, e.period))),
    resolved AS (SELECT unnest(o) FROM (
        SELECT arg_max(o, ROW(o.source_priority, {LATEST_STATED})) AS o
        FROM (FROM effective UNION ALL BY NAME FROM pool WHERE event_role = 'DATED_REVISION') o
        GROUP BY country, canonical_series_id, period, visible_from)),
    events AS (SELECT * EXCLUDE (visible_from), visible_from AS valid_from,
                      min(visible_from) OVER (k ROWS BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS valid_to,
                      CAST(count(*) OVER (k ROWS UNBOUNDED PRECEDING) AS INTEGER) AS event_no
               FROM resolved WINDOW k AS (PARTITION BY country, canonical_series_id, period ORDER BY visible_from))"""
