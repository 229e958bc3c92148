"""DuckDB twins of the reference queries, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from concordia import texts
from concordia.config import CODED_COUNTRIES, EU, EXTERNAL, MODE_LABELS, POSITION_WORDS, RELATION_LABELS, STATUS_LABELS, TOPIC_KEYWORDS, TOPIC_LABELS, TOPICS, TREND_LABELS, VOTE_TOPIC_KEYWORDS


#: Names for the test's invented world: words its texts have, for countries.
NAMES = {"AT": ["council"], "DE": ["regional court", "tribunal"], "FR": ["committee"], "PL": ["border authority"], "US": ["grid operator"], "TR": ["spokesperson"]}


def _list(words) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


_EU = _list(EU)
_NOW = "TIMESTAMPTZ '2026-04-15 00:00:00+00'"
_R = lambda x, n: f"CAST(round(CAST({x} AS DECIMAL(28, 12)), {n}) AS DOUBLE)"

_E = f"""
e AS (SELECT row_id, CAST(collected_at AS TIMESTAMPTZ) AS ts, countries, topics, country_pairs,
  greatest(1, 0.4 * coalesce(TRY_CAST(nullif(trim(metadata['NumMentions']), '') AS DECIMAL(18, 4)), 1)
    + 0.3 * coalesce(TRY_CAST(nullif(trim(metadata['NumArticles']), '') AS DECIMAL(18, 4)), 1)
    + 0.3 * abs(coalesce(TRY_CAST(nullif(trim(metadata['GoldsteinScale']), '') AS DECIMAL(18, 4)), 0))) AS w FROM coded_messages),
win(window_days) AS (VALUES (7), (30), (90)),
ew AS (SELECT e.*, window_days FROM e, win WHERE ts >= {_NOW} - to_days(window_days)),
kinds AS (SELECT *, CASE WHEN a IN {_EU} AND b IN {_EU} THEN 'internal' WHEN a IN {_EU} OR b IN {_EU} THEN 'external' ELSE 'other' END AS kind FROM
  (SELECT row_id, window_days, w, p[1] AS a, p[2] AS b FROM (SELECT row_id, window_days, w, unnest(country_pairs) AS p FROM ew) WHERE len(p) = 2 AND p[1] <> p[2] AND p[1] <> '' AND p[2] <> '')),
pm AS (SELECT *, 'all' AS mode FROM kinds WHERE kind <> 'other' UNION ALL SELECT *, kind FROM kinds WHERE kind <> 'other')"""

_CELLS = f"""
ec AS (SELECT row_id, window_days, w, unnest(list_distinct(countries)) AS country FROM ew),
mc AS (SELECT *, 'all' AS mode FROM ec UNION ALL SELECT *, 'internal' FROM ec WHERE country IN {_EU}
  UNION ALL SELECT DISTINCT row_id, window_days, w, unnest([a, b]) AS country, 'external' FROM kinds WHERE kind = 'external'),
et AS (SELECT row_id, unnest(topics) AS topic FROM e),
cell AS (SELECT window_days, mode, country, topic, sum(w) AS v FROM mc JOIN et USING (row_id) WHERE topic IN {_list(TOPICS)} GROUP BY ALL)"""

_HEAT = f"heat AS (SELECT window_days, mode, country, {', '.join(f'''CAST(round(coalesce(sum(v) FILTER (topic = '{t}'), 0), 3) AS DOUBLE) AS {t}''' for t in TOPICS)}, CAST(round(sum(v), 3) AS DOUBLE) AS total FROM cell GROUP BY ALL)"
_SUM = "(" + " + ".join(f"abs({t})" for t in TOPICS) + ")"
_NORM = f"norm AS (SELECT window_days, mode, country, {', '.join(f'CASE WHEN {_SUM} > 0 THEN {_R(f"{t} / {_SUM}", 6)} ELSE 0 END AS {t}' for t in TOPICS)}, {_R(_SUM, 6)} AS total FROM heat)"


def _dot(a: str, b: str) -> str:
    return "(" + " + ".join(f"{a}.{t} * {b}.{t}" for t in TOPICS) + ")"


_COS = f"{_dot('a', 'b')} / (sqrt({_dot('a', 'a')}) * sqrt({_dot('b', 'b')}))"
_SIM = f"sim AS (SELECT a.window_days, a.mode, a.country AS source, b.country AS target, {_R(_COS, 3)} AS weight FROM norm a JOIN norm b ON a.window_days = b.window_days AND a.mode = b.mode AND a.country < b.country WHERE {_dot('a', 'a')} > 0 AND {_dot('b', 'b')} > 0 AND {_COS} >= 0.2)"
_EDGES = "edges AS (SELECT window_days, mode, least(a, b) AS source, greatest(a, b) AS target, CAST(round(sum(w), 2) AS DOUBLE) AS weight FROM pm GROUP BY ALL)"


def _closeness(a: str, b: str) -> str:
    size = lambda x: "(" + " + ".join(f"abs({x}.{t})" for t in TOPICS) + ")"
    share = lambda x, t: f"CASE WHEN {size(x)} > 0 THEN abs({x}.{t}) / {size(x)} ELSE 0 END"
    gap = " + ".join(f"abs({share(a, t)} - {share(b, t)})" for t in TOPICS)
    return f"CASE WHEN {a}.country IS NULL OR {b}.country IS NULL OR ({size(a)} = 0 AND {size(b)} = 0) THEN 0 ELSE greatest(0, 1 - ({gap}) / 2) END"


def _index(wd: float, ws: float, wt: float, scope: str) -> str:
    keys = scope.split(", ")
    on = lambda x, y: " AND ".join(f"{x}.{k} = {y}.{k}" for k in keys)
    mode = f"(u.country IN {_EU} OR v.country IN {_EU})"
    if "mode" in keys:
        mode += f" AND (u.mode = 'all' OR (u.mode = 'internal') = (u.country IN {_EU} AND v.country IN {_EU}))"
    pick = ", ".join(f"u.{k}" for k in keys)
    return f"""
uni AS (SELECT DISTINCT {scope}, country FROM (SELECT {scope}, unnest([source, target]) AS country FROM edges UNION ALL SELECT {scope}, unnest([source, target]) FROM sim UNION ALL SELECT {scope}, country FROM norm)),
dm AS (SELECT {scope}, max(weight) AS m FROM edges GROUP BY ALL), sm AS (SELECT {scope}, max(weight) AS m FROM sim GROUP BY ALL),
raw AS (SELECT {pick}, u.country AS source, v.country AS target, coalesce(d.weight, 0) AS dw, coalesce(s.weight, 0) AS sw,
  least(100, greatest(0, coalesce(d.weight, 0) / coalesce(nullif(dm.m, 0), 1) * 100)) AS ds, least(100, greatest(0, coalesce(s.weight, 0) / coalesce(nullif(sm.m, 0), 1) * 100)) AS ss,
  least(100, greatest(0, ({_closeness('na', 'nb')}) * 100)) AS ts
  FROM uni u JOIN uni v ON {on('u', 'v')} AND u.country < v.country
  LEFT JOIN edges d ON {on('d', 'u')} AND d.source = u.country AND d.target = v.country LEFT JOIN sim s ON {on('s', 'u')} AND s.source = u.country AND s.target = v.country
  LEFT JOIN dm ON {on('dm', 'u')} LEFT JOIN sm ON {on('sm', 'u')}
  LEFT JOIN norm na ON {on('na', 'u')} AND na.country = u.country LEFT JOIN norm nb ON {on('nb', 'u')} AND nb.country = v.country WHERE {mode}),
idx AS (SELECT {scope}, source, target, {_R(f'least(100, greatest(0, ds * {wd} + ss * {ws} + ts * {wt}))', 2)} AS score, {_R('ds', 2)} AS direct_score, {_R('ss', 2)} AS similarity_score, {_R('ts', 2)} AS topic_score,
  {_R('dw', 6)} AS direct_weight, {_R('sw', 6)} AS similarity_weight FROM raw),
rel AS (SELECT *, CASE WHEN score >= 80 THEN 'very_high' WHEN score >= 60 THEN 'high' WHEN score >= 40 THEN 'medium' WHEN score >= 20 THEN 'low' ELSE 'very_low' END AS band FROM idx WHERE score >= 5)"""


_BASE = "WITH " + _E
_ALL = f"{_BASE}, {_EDGES}, {_CELLS}, {_HEAT}, {_NORM}, {_SIM}, {_index(0.5, 0.3, 0.2, 'window_days, mode')}"

# two periods of 30 days in one go: the window column holds 1 for the current and 2 for the previous one
_PERIODS = _ALL.replace(
    "win(window_days) AS (VALUES (7), (30), (90))", "win(window_days) AS (VALUES (1), (2))"
).replace(f"ts >= {_NOW} - to_days(window_days)", f"CASE WHEN ts >= {_NOW} - to_days(30) THEN 1 WHEN ts >= {_NOW} - to_days(60) THEN 2 END = window_days")
_CHANGE = _PERIODS + f"""
, chg AS (SELECT 60 AS window_days, coalesce(c.mode, p.mode) AS mode, coalesce(c.source, p.source) AS source, coalesce(c.target, p.target) AS target,
  coalesce(c.score, 0) AS current_score, coalesce(p.score, 0) AS previous_score, {_R('coalesce(c.score, 0) - coalesce(p.score, 0)', 2)} AS delta, c.score AS cs, p.score AS ps, c.band AS current_band, p.band AS previous_band
  FROM (SELECT * FROM rel WHERE window_days = 1) c FULL JOIN (SELECT * FROM rel WHERE window_days = 2) p ON c.mode = p.mode AND c.source = p.source AND c.target = p.target),
ch AS (SELECT window_days, mode, source, target, current_score, previous_score, delta, current_band, previous_band,
  CASE WHEN ps IS NULL THEN 'gained' WHEN cs IS NULL THEN 'lost' WHEN delta > 0 THEN 'improved' WHEN delta < 0 THEN 'declined' ELSE 'stable' END AS status,
  CAST(row_number() OVER (PARTITION BY mode ORDER BY abs(delta) DESC, source, target) AS INTEGER) AS ordinal FROM chg)"""
_BOTH = "ends AS (SELECT window_days, mode, source AS country, target AS partner, score FROM rel UNION ALL SELECT window_days, mode, target, source, score FROM rel)"
_AVG = f"""per AS (SELECT u.window_days, u.mode, u.country, CAST(count(score) AS INTEGER) AS n, CASE WHEN count(score) > 0 THEN {_R('CAST(sum(CAST(score AS DECIMAL(18, 2))) AS DOUBLE) / count(score)', 2)} ELSE 0 END AS average
  FROM uni u LEFT JOIN ends e ON u.window_days = e.window_days AND u.mode = e.mode AND u.country = e.country GROUP BY ALL)"""

_VB = f"""WITH m AS (SELECT l_partkey AS vote_id, {'[' + _list(EU)[1:-1] + ']'}[s_nationkey + 1] AS country, 'G' || l_linenumber AS grp,
  CASE WHEN l_returnflag = 'A' AND l_linenumber % 3 = 0 THEN 'abstain' WHEN (l_partkey % 2 = s_nationkey % 2) <> (l_returnflag = 'A') THEN 'for' ELSE 'against' END AS position FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
cp AS (SELECT vote_id, country, position, row_number() OVER (PARTITION BY vote_id, country ORDER BY count(*) DESC, position) AS rn FROM m GROUP BY vote_id, country, position),
vp AS (SELECT vote_id, {'[' + _list(TOPICS)[1:-1] + ']'}[vote_id % 8 + 1] AS topic, country, position, DATE '2026-04-15' - CAST(vote_id % 100 AS INTEGER) AS day FROM cp WHERE rn = 1),
cf0 AS (SELECT vote_id, count(*) AS n, count(DISTINCT position) AS kinds, greatest(count(*) FILTER (position = 'for'), count(*) FILTER (position = 'against'), count(*) FILTER (position = 'abstain')) AS most FROM vp GROUP BY vote_id),
cf AS (SELECT *, round(CAST(1 - most::DOUBLE / n AS DECIMAL(18, 12)), 6)::DECIMAL(9, 6) AS cw, n >= 2 AND kinds >= 2 AS divisive FROM cf0),
ok0 AS (SELECT vp.*, cw FROM vp JOIN cf USING (vote_id) WHERE divisive AND cw >= 0.15)"""
#: The votes that count, by period and by window; the window's days stand in the same column.
_V = _VB + ", ok AS (SELECT *, CASE WHEN day >= DATE '2026-04-15' - 30 THEN 'current' ELSE 'previous' END AS period FROM ok0 WHERE day >= DATE '2026-04-15' - 60)"
_VW = _VB + ", ok AS (SELECT ok0.*, w.d AS period FROM ok0, (VALUES (7), (30), (90)) w(d) WHERE day >= DATE '2026-04-15' - w.d)"
_VG = """
, vpair AS (SELECT a.period, a.vote_id, a.topic, a.cw, a.country AS source, b.country AS target,
  CASE WHEN a.position = b.position THEN CASE a.position WHEN 'abstain' THEN 0.75 ELSE 1 END WHEN 'abstain' IN (a.position, b.position) THEN 0.25 ELSE 0 END AS score, CASE WHEN a.position = b.position THEN a.cw ELSE -a.cw END AS sv
  FROM ok a JOIN ok b ON a.vote_id = b.vote_id AND a.period = b.period AND a.country < b.country),
vt AS (SELECT period, source, target, topic, CAST(round(sum(sv), 3) AS DOUBLE) AS value FROM vpair GROUP BY ALL),
ve AS (SELECT period, source, target, CAST(sum(score * cw) AS DOUBLE) / CAST(sum(cw) AS DOUBLE) AS raw, count(*) AS n FROM vpair GROUP BY ALL),
vedge AS (SELECT period, source, target, """ + _R("raw", 3) + """ AS weight, n, raw FROM ve WHERE n >= 5 AND raw >= 0.6)"""
_VH = f""", vh AS (SELECT period, country, {', '.join(f'''CAST(round(coalesce(sum(sv) FILTER (topic = '{t}'), 0), 3) AS DOUBLE) AS {t}''' for t in TOPICS)},
  CAST(round({' + '.join(f"abs(coalesce(sum(sv) FILTER (topic = '{t}'), 0))" for t in TOPICS)}, 3) AS DOUBLE) AS total
  FROM (SELECT *, CASE position WHEN 'for' THEN 1 WHEN 'abstain' THEN 0.25 ELSE -1 END * cw AS sv FROM ok) GROUP BY ALL)"""
_VN = _VH + ", " + _NORM.replace("window_days, mode", "period").replace("FROM heat", "FROM vh")
_VS = _VN + ", " + _SIM.replace("a.window_days, a.mode", "a.period").replace("a.window_days = b.window_days AND a.mode = b.mode", "a.period = b.period")


def _any(col: str, words) -> str:
    return "(" + " OR ".join(f"contains({col}, '{w.replace(chr(39), chr(39) * 2)}')" for w in dict.fromkeys(words)) + ")"


_CLEAN = r"""trim(regexp_replace(translate(coalesce({x}, ''), '‘’“”–—""" + "\u00a0" + r"""', '''''""-- '), '\s+', ' ', 'g'))"""



def _text(*parts: str) -> str:
    """The searchable text of columns; no-break blanks are the only references of the data."""
    joined = "replace(concat_ws(' ', " + ", ".join(f"nullif({p}, '')" for p in parts) + "), '&nbsp;', ' ')"
    bare = r"regexp_replace(regexp_replace(" + joined + r", 'https?://\S+|www\.\S+', ' ', 'gi'), '[\pL\pN_.-]+@[\pL\pN_.-]+\.[\pL\pN_]+', ' ', 'g')"
    return f"lower({_CLEAN.format(x=bare)})"


def _named(names: dict[str, list[str]]) -> str:
    cases = ", ".join("CASE WHEN regexp_matches(t, '\\b(?:" + "|".join(w.replace(" ", "\\s+") for w in words) + f")\\b') THEN '{code}' END" for code, words in sorted(names.items()))
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def _detected(names: dict[str, list[str]], source: str) -> str:
    """Country names, topics, scores and the primary topic of the text ``t`` of a table."""
    score = {t: "(" + " + ".join(f"CAST(contains(t, '{w.replace(chr(39), chr(39) * 2)}') AS INTEGER)" for w in dict.fromkeys(words)) + ")" for t, words in TOPIC_KEYWORDS.items()}
    best = "greatest(" + ", ".join(f"s_{t}" for t in TOPICS) + ")"
    return f"""d0 AS (SELECT *, {_named(names)} AS found, {', '.join(f'{x} AS s_{t}' for t, x in score.items())} FROM {source}),
det AS (SELECT *, list_filter([{', '.join(f"CASE WHEN s_{t} > 0 THEN '{t}' END" for t in TOPIC_KEYWORDS)}], lambda x: x IS NOT NULL) AS tops, {' + '.join(f's_{t}' for t in TOPICS)} AS keywords,
CASE WHEN {best} = 0 THEN NULL {' '.join(f"WHEN s_{t} = {best} THEN '{t}'" for t in TOPICS)} END AS main FROM d0)"""


_signed = lambda x, n=2: f"(CASE WHEN {x} > 0 THEN '+' ELSE '' END || printf('%.{n}f', {x}))"
_way = lambda x, words: f"(CASE WHEN {x} > 0 THEN '{words['up']}' WHEN {x} < 0 THEN '{words['down']}' ELSE '{words['flat']}' END)"
_printf = lambda fmt, *args: f"printf('{fmt.replace(chr(39), chr(39) * 2)}', {', '.join(args)})"
_labels = lambda labels, x: f"(CASE {x} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items()) + f" ELSE {x} END)"

_TITLE_KEY = r"sha256(lower(regexp_replace(coalesce(title, ''), '^\s+|\s+$', '', 'g')))"

_DAILY = "WITH s AS (SELECT event_type, CAST(ts AS DATE) AS day, " + _R("avg(CAST(value AS DECIMAL(28, 12)))", 2) + " AS value FROM events GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day) AS i FROM s)"
_FIT = ", f AS (SELECT event_type, count(*) AS n, coalesce(regr_slope(value, i - 1), 0) AS k, coalesce(regr_intercept(value, i - 1), max(value)) AS c, max(day) AS last FROM n GROUP BY ALL)"

_TC = f"""{_V} {_VH}, l AS (UNPIVOT vh ON {', '.join(TOPICS)} INTO NAME topic VALUE v),
x AS (SELECT country, topic, coalesce(max(v) FILTER (period = 'current'), 0) AS current, coalesce(max(v) FILTER (period = 'previous'), 0) AS previous FROM l GROUP BY ALL), tc AS (SELECT *, {_R('current - previous', 3)} AS delta FROM x)"""
_CODES = ", ".join(f"('{c}', '{iso}')" for c, iso in [*CODED_COUNTRIES.items(), *[(x, x) for x in EU + EXTERNAL if x not in CODED_COUNTRIES]])
_CODED = f"""WITH k(code, iso) AS (VALUES {_CODES}),
x AS (SELECT m.*, k1.iso AS a, k2.iso AS b, k3.iso AS c, list_sort(list_distinct(list_filter([k1.iso, k2.iso, k3.iso], lambda t: t IS NOT NULL))) AS cs FROM coded_messages m
  LEFT JOIN k k1 ON k1.code = upper(trim(metadata['Actor1CountryCode_raw'])) LEFT JOIN k k2 ON k2.code = upper(trim(metadata['Actor2CountryCode_raw'])) LEFT JOIN k k3 ON k3.code = upper(trim(metadata['ActionGeo_CountryCode_raw'])))"""
_NORMAL_PAIRS = f"SELECT least(p[1], p[2]) AS source, greatest(p[1], p[2]) AS target, topics FROM (SELECT unnest(country_pairs) AS p, coalesce(topics, []) AS topics FROM nw) WHERE len(p) = 2 AND p[1] <> p[2] AND p[1] IN {_EU} AND p[2] IN {_EU}"
_NW = f"WITH nw AS (SELECT * FROM news_items WHERE len(list_distinct(list_filter(countries, lambda c: c IN {_EU}))) >= 2)"
_EUNEWS = f"SELECT coalesce(topics, []) AS topics, unnest(list_distinct(list_filter(countries, lambda c: c IN {_EU}))) AS country FROM news_items"

_CC = f"""{_CHANGE}, {_BOTH}, {_AVG},
w AS (SELECT mode, source AS country, target AS partner, current_score, previous_score, delta, status FROM ch UNION ALL SELECT mode, target, source, current_score, previous_score, delta, status FROM ch),
l AS (SELECT *, row_number() OVER (PARTITION BY mode, country, status ORDER BY CASE status WHEN 'gained' THEN -current_score WHEN 'lost' THEN -previous_score WHEN 'improved' THEN -delta ELSE delta END, partner) AS rn,
  row_number() OVER (PARTITION BY mode, country ORDER BY abs(delta) DESC, partner) AS ra FROM w),
g AS (SELECT mode, country, {', '.join(f"coalesce(string_agg(partner, ',' ORDER BY rn) FILTER (status = '{x}' AND rn <= 10), '') AS {x}" for x in ('gained', 'lost', 'improved', 'declined'))},
  string_agg(partner, ',' ORDER BY ra) FILTER (ra <= 12) AS top_changes FROM l GROUP BY ALL),
every AS (SELECT DISTINCT mode, country FROM (SELECT mode, country FROM w UNION ALL SELECT mode, unnest([source, target]) FROM edges)),
cc AS (SELECT e.mode, e.country, g.gained, g.lost, g.improved, g.declined, g.top_changes, coalesce(a.n, 0) AS count_current, coalesce(b.n, 0) AS count_previous, coalesce(a.n, 0) - coalesce(b.n, 0) AS count_delta,
  coalesce(a.average, 0) AS average_current, coalesce(b.average, 0) AS average_previous, {_R('coalesce(a.average, 0) - coalesce(b.average, 0)', 2)} AS average_delta
  FROM every e LEFT JOIN g USING (mode, country) LEFT JOIN per a ON a.window_days = 1 AND a.mode = e.mode AND a.country = e.country LEFT JOIN per b ON b.window_days = 2 AND b.mode = e.mode AND b.country = e.country),
mv AS (SELECT 'score' AS kind, *, row_number() OVER (PARTITION BY mode ORDER BY abs(average_delta) DESC, country) AS place FROM cc
  UNION ALL SELECT 'network', *, row_number() OVER (PARTITION BY mode ORDER BY abs(count_delta) DESC, abs(average_delta) DESC, country) FROM cc
  UNION ALL SELECT 'improving', *, row_number() OVER (PARTITION BY mode ORDER BY average_delta DESC, country) FROM cc WHERE average_delta > 0
  UNION ALL SELECT 'declining', *, row_number() OVER (PARTITION BY mode ORDER BY average_delta, country) FROM cc WHERE average_delta < 0),
items AS (SELECT * FROM mv WHERE place <= 8)"""
_VP = f""", w AS (SELECT period, unnest([source, target]) AS country, unnest([target, source]) AS partner FROM vedge),
j AS (SELECT country, partner, bool_or(period = 'current') AS now, bool_or(period = 'previous') AS before FROM w GROUP BY ALL),
pc AS (SELECT country, coalesce(string_agg(partner, ',' ORDER BY partner) FILTER (now AND NOT before), '') AS gained, coalesce(string_agg(partner, ',' ORDER BY partner) FILTER (before AND NOT now), '') AS lost,
coalesce(string_agg(partner, ',' ORDER BY partner) FILTER (now AND before), '') AS kept, count(*) FILTER (now) AS partners_current, count(*) FILTER (before) AS partners_previous, count(*) FILTER (now) - count(*) FILTER (before) AS partner_delta FROM j GROUP BY ALL)"""
_BUILT = f"""WITH x AS (SELECT news_id, trim(coalesce(url, '')) AS url, trim(coalesce(title, '')) AS title, {_text("trim(title)", "trim(summary)", "trim(body)")} AS t FROM news_items),
{_detected(NAMES, 'x')}, rel AS (SELECT * FROM det WHERE len(found) > 0 AND len(tops) > 0),
u AS (SELECT * FROM rel QUALIFY url = '' OR row_number() OVER (PARTITION BY url ORDER BY news_id) = 1), k AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY {_TITLE_KEY} ORDER BY news_id) = 1),
c AS (SELECT news_id, unnest(found) AS c FROM k), p AS (SELECT a.news_id, string_agg(a.c || '-' || b.c, ',' ORDER BY a.c, b.c) AS pairs FROM c a JOIN c b ON a.news_id = b.news_id AND a.c < b.c GROUP BY a.news_id)"""
_TITLES = f"t AS (SELECT p_partkey, trim(p_name) || ' — ' || trim(p_type) AS title, regexp_replace(translate(lower(trim(p_name) || ' — ' || trim(p_type)), '’–—_/', '''    '), '\\s+', ' ', 'g') AS k FROM part)"
_vote_topic = lambda t: "CASE " + " ".join(f"WHEN {_any(t, w)} THEN '{k}'" for k, w in VOTE_TOPIC_KEYWORDS.items()) + " ELSE 'trade' END"
_CHART = _DAILY.replace("FROM events GROUP", "FROM events WHERE event_type = 'click' GROUP").replace("n AS (SELECT *,", "h AS (SELECT event_type, day, CASE WHEN day = (SELECT max(day) FROM s) THEN 50.0 ELSE value END AS value FROM s), n AS (SELECT *,").replace("FROM s)", "FROM h)", 3).replace("(SELECT max(day) FROM h)", "(SELECT max(day) FROM s)").replace("END AS value FROM h)", "END AS value FROM s)") + _FIT

ORACLE = {
    "relationship_countries": f"""{_ALL}, {_BOTH}, {_AVG}, r AS (SELECT *, row_number() OVER (PARTITION BY window_days, mode, country ORDER BY score DESC, partner) AS rn FROM ends),
t AS (SELECT window_days, mode, country, arg_min(partner, rn) AS partner, arg_min(score, rn) AS score, string_agg(partner, ',' ORDER BY rn) FILTER (rn <= 10) AS top FROM r GROUP BY ALL)
SELECT p.window_days, p.mode, p.country, p.n AS relationship_count, p.average AS average_score, t.partner AS strongest_partner, t.score AS strongest_score, coalesce(t.top, '') AS top_partners FROM per p
LEFT JOIN t ON p.window_days = t.window_days AND p.mode = t.mode AND p.country = t.country""",
    "country_change": f"{_CC} SELECT 60 AS window_days, mode, country, count_current, count_previous, count_delta, average_current, average_previous, average_delta, gained, lost, improved, declined, top_changes FROM cc",
    "report_countries": f"{_CC} SELECT mode, kind, country, average_delta, count_delta FROM items",
    "report_lines": f"""{_CC} SELECT 'country' AS kind, mode, place, {_printf(texts.COUNTRY, 'country', _way('average_delta', texts.COUNTRY_DIRECTION), 'average_previous', 'average_current', _signed('average_delta'), _way('count_delta', texts.COUNTRY_NETWORK))} AS line FROM items WHERE kind = 'score' AND place <= 5
UNION ALL SELECT 'pair', mode, ordinal, {_printf(texts.PAIR, 'source', 'target', _labels(STATUS_LABELS, 'status'), 'previous_score', 'current_score', _signed('delta'))} FROM ch WHERE ordinal <= 5
UNION ALL SELECT 'lead', c.mode, 1, {_printf(texts.LEAD, "'GDELT'", "'30d'", _labels(MODE_LABELS, 'c.mode'))} || ' ' || {_printf(texts.LEAD_COUNTRY, 'c.country', _signed('c.average_delta'), _way('c.average_delta', texts.DIRECTION))}
  || ' ' || {_printf(texts.LEAD_PAIR, 'p.source', 'p.target', _signed('p.delta'))} FROM items c JOIN ch p ON c.mode = p.mode AND p.ordinal = 1 WHERE c.kind = 'score' AND c.place = 1""",
    "report_documents": f"""{_CC}, o AS (SELECT *, row_number() OVER (PARTITION BY mode, status ORDER BY ordinal) AS rs FROM ch),
pr AS (SELECT mode, string_agg(source || '-' || target, ',' ORDER BY ordinal) FILTER (ordinal <= 8) AS pair_items, coalesce(string_agg(source || '-' || target, ',' ORDER BY ordinal) FILTER (status = 'gained' AND rs <= 8), '') AS gained_pairs,
  coalesce(string_agg(source || '-' || target, ',' ORDER BY ordinal) FILTER (status = 'lost' AND rs <= 8), '') AS lost_pairs, least(count(*), 5) AS n_pair_lines FROM o GROUP BY mode),
cr AS (SELECT mode, string_agg(country, ',' ORDER BY place) AS country_items, least(count(*), 5) AS n_country_lines FROM items WHERE kind = 'score' GROUP BY mode)
SELECT 'GDELT' AS layer_label, '30d' AS "window", mode, {_labels(MODE_LABELS, 'mode')} AS mode_label, {len(texts.METHOD_EVENTS)} AS note_length, n_country_lines, n_pair_lines, country_items, pair_items, gained_pairs, lost_pairs FROM pr JOIN cr USING (mode)""",
    "focus_partners": f"""{_CC}, pmap AS (SELECT partner, current_score AS current, delta, status FROM l WHERE mode = 'all' AND country = 'HU' AND (ra <= 12 OR status <> 'stable' AND rn <= 10)),
f AS (SELECT v.partner, v.place, pmap.current, pmap.delta, coalesce(pmap.status, 'missing') AS status FROM (VALUES ('PL', 0), ('CZ', 1), ('SK', 2)) v(partner, place) LEFT JOIN pmap USING (partner))
SELECT *, (SELECT {_R('avg(current)', 2)} FROM f) AS average_current, (SELECT {_R('avg(delta)', 2)} FROM f) AS average_delta FROM f""",
    "history_row": f"""{_CC}, own AS (SELECT average_current AS s, average_delta AS d FROM items WHERE mode = 'all' AND kind = 'score' AND country = 'HU'),
mine AS (SELECT CASE WHEN source = 'HU' THEN target ELSE source END AS partner, current_score, delta, ordinal FROM ch WHERE mode = 'all' AND ordinal <= 8 AND 'HU' IN (source, target)),
one AS (SELECT (SELECT s FROM own) AS s, (SELECT d FROM own) AS d, (SELECT partner FROM mine ORDER BY current_score DESC, ordinal LIMIT 1) AS mp, (SELECT current_score FROM mine ORDER BY current_score DESC, ordinal LIMIT 1) AS ms,
  (SELECT partner FROM mine ORDER BY abs(delta) DESC, ordinal LIMIT 1) AS dp, (SELECT delta FROM mine ORDER BY abs(delta) DESC, ordinal LIMIT 1) AS dd),
v AS (SELECT *, {_R('coalesce(s, ms, 0)', 2)} AS score, {_R('coalesce(d, dd, 0)', 2)} AS delta FROM one)
SELECT '2026-04-15' AS date, 'votes_30d_weekly_report.json' AS source_report, score, delta, CASE WHEN score >= 70 THEN '{RELATION_LABELS['strong']}' WHEN score >= 40 THEN '{RELATION_LABELS['medium']}' ELSE '{RELATION_LABELS['weak']}' END AS relation_label,
CASE WHEN delta > 5 THEN '{TREND_LABELS['up']}' WHEN delta < -5 THEN '{TREND_LABELS['down']}' ELSE '{TREND_LABELS['flat']}' END AS trend_label, mp AS main_partner, ms AS main_partner_score, dp AS dynamic_partner, dd AS dynamic_partner_delta, '{texts.NOTHING}' AS method_note FROM v""",
    "history_chart": f"""{_CHART} SELECT 'series' AS what, strftime(day, '%Y-%m-%d') AS day, value AS score, {_R('avg(value) OVER (ORDER BY day ROWS 6 PRECEDING)', 2)} AS average, {_R('c + k * (i - 1)', 2)} AS line FROM n, f
UNION ALL SELECT 'forecast', strftime(last + CAST(j AS INTEGER), '%Y-%m-%d'), NULL, NULL, {_R('c + k * (n + j - 1)', 2)} FROM f, range(1, 4) r(j)
UNION ALL SELECT 'latest', strftime(day, '%Y-%m-%d'), value, a, b FROM (SELECT day, value, {_R('avg(value) OVER (ORDER BY day ROWS 6 PRECEDING)', 2)} AS a, {_R('CASE WHEN i = 1 THEN 0 ELSE regr_slope(value, i) OVER (ORDER BY day ROWS 13 PRECEDING) END', 4)} AS b FROM n) WHERE day = (SELECT max(day) FROM n)""",
    "graph_documents": f"""{_BASE}, {_EDGES}, nd AS (SELECT window_days, mode, string_agg(DISTINCT c, ',' ORDER BY c) AS nodes_order FROM (SELECT window_days, mode, unnest([a, b]) AS c FROM pm) GROUP BY ALL),
ed AS (SELECT window_days, mode, string_agg(source || '-' || target, ',' ORDER BY source, target) AS edges_order FROM edges GROUP BY ALL), ct AS (SELECT window_days, count(*) AS event_count FROM ew GROUP BY ALL)
SELECT window_days, mode, event_count, coalesce(nodes_order, '') AS nodes_order, coalesce(edges_order, '') AS edges_order FROM ct CROSS JOIN (VALUES ('all'), ('internal'), ('external')) m(mode) LEFT JOIN nd USING (window_days, mode) LEFT JOIN ed USING (window_days, mode)""",
    "relationship_documents": f"""{_ALL}, {_BOTH}, {_AVG}, a AS (SELECT window_days, mode, string_agg(source || '-' || target, ',' ORDER BY score DESC, source, target) AS pairs_order FROM rel GROUP BY ALL)
SELECT window_days, mode, coalesce(any_value(pairs_order), '') AS pairs_order, string_agg(country, ',' ORDER BY average DESC, country) AS by_country_order FROM per LEFT JOIN a USING (window_days, mode) GROUP BY window_days, mode""",
    "change_documents": f"""{_CC}, a AS (SELECT mode, string_agg(source || '-' || target, ',' ORDER BY ordinal) AS pair_changes_order FROM ch GROUP BY mode)
SELECT mode, any_value(pair_changes_order) AS pair_changes_order, string_agg(country, ',' ORDER BY abs(average_delta) DESC, country) AS by_country_order FROM cc LEFT JOIN a USING (mode) GROUP BY mode""",
    "policy_snapshot": f"""WITH n AS (SELECT country FROM ({_EUNEWS}) GROUP BY ALL), s AS (SELECT DISTINCT unnest(topics) AS topic, country FROM ({_EUNEWS})), e AS (SELECT DISTINCT a.country AS x, b.country AS y FROM s a JOIN s b ON a.topic = b.topic AND a.country < b.country)
SELECT (SELECT count(*) FROM news_items) AS event_count, (SELECT string_agg(country, ',' ORDER BY country) FROM n) AS nodes_order, (SELECT string_agg(x || '-' || y, ',' ORDER BY x, y) FROM e) AS edges_order""",
    "day_snapshot": f"""{_NW}, p AS (SELECT DISTINCT source, target FROM ({_NORMAL_PAIRS})), n AS (SELECT DISTINCT country FROM (SELECT unnest(countries) AS country FROM nw) WHERE country IN {_EU})
SELECT (SELECT count(*) FROM nw) AS event_count, (SELECT string_agg(country, ',' ORDER BY country) FROM n) AS nodes_order, (SELECT string_agg(source || '-' || target, ',' ORDER BY source, target) FROM p) AS edges_order""",
    "news_detect": f"""WITH x AS (SELECT news_id, {_text("title", "summary")} AS t FROM news_items), {_detected(NAMES, 'x')}
SELECT news_id AS ingest_seq, array_to_string(found, ',') AS countries, array_to_string(tops, ',') AS topics, main AS primary_topic, keywords FROM det""",
    "position_labels": "SELECT news_id AS ingest_seq, CASE " + " ".join(f"WHEN {_any('lower(title)', w)} THEN '{k}'" for k, w in POSITION_WORDS.items()) + " END AS label FROM news_items",
    "text_events": f"""{_BUILT} SELECT k.news_id AS ingest_seq, 'rss' AS layer, array_to_string(tops, ',') AS topics, main AS primary_topic, array_to_string(found, ',') AS countries, array_to_string(list_filter(found, lambda c: c IN {_EU}), ',') AS eu,
array_to_string(list_filter(found, lambda c: c NOT IN {_EU}), ',') AS external, coalesce(pairs, '') AS pairs FROM k LEFT JOIN p USING (news_id)""",
    "vote_edges": f"""{_VW} {_VG}, tt AS (SELECT period, source, target, string_agg(topic || ':' || printf('%.3f', value), ',' ORDER BY rn) AS topics FROM (SELECT *, row_number() OVER (PARTITION BY period, source, target ORDER BY abs(value) DESC, topic) AS rn FROM vt) WHERE rn <= 3 GROUP BY ALL)
SELECT e.period AS window_days, e.source, e.target, e.weight, e.n AS count, CASE WHEN raw >= 0.75 THEN 'cooperative' WHEN raw <= 0.35 THEN 'conflict' ELSE 'neutral' END AS relation, topics FROM vedge e JOIN tt USING (period, source, target)""",
    "vote_nodes": f"""{_VW} {_VG} SELECT k.period AS window_days, k.country, coalesce(CAST(w AS DOUBLE), 0) AS weight, n AS count FROM
(SELECT period, country, count(*) AS n FROM ok WHERE vote_id IN (SELECT vote_id FROM ok0 GROUP BY vote_id HAVING count(*) >= 2) GROUP BY ALL) k
LEFT JOIN (SELECT period, c AS country, sum(CAST(weight AS DECIMAL(18, 3))) AS w FROM (SELECT period, weight, unnest([source, target]) AS c FROM vedge) GROUP BY ALL) s USING (period, country)""",
    "vote_window_counts": f"{_VB} SELECT w.d AS window_days, count(DISTINCT vote_id) AS event_count FROM vp, (VALUES (7), (30), (90)) w(d) WHERE day >= DATE '2026-04-15' - w.d GROUP BY ALL",
    "vote_heatmap": f"{_VW} {_VH} SELECT period AS window_days, mode, vh.* EXCLUDE (period) FROM vh, (VALUES ('all'), ('internal')) m(mode)",
    "vote_summary": f"""{_VW}, g AS (SELECT period, CASE WHEN grouping(country) = 1 AND grouping(topic) = 1 THEN 'all' WHEN grouping(topic) = 1 THEN 'country' WHEN grouping(country) = 1 THEN 'topic' ELSE 'country_topic' END AS level, country, topic,
  round(coalesce(sum(cw) FILTER (position = 'for'), 0), 3) AS f, round(coalesce(sum(cw) FILTER (position = 'against'), 0), 3) AS a, round(coalesce(sum(cw) FILTER (position = 'abstain'), 0), 3) AS b, count(DISTINCT vote_id) AS votes
  FROM ok GROUP BY GROUPING SETS ((period), (period, country), (period, topic), (period, country, topic)))
SELECT period AS window_days, level, country, topic, CAST(f AS DOUBLE) AS for_weight, CAST(a AS DOUBLE) AS against_weight, CAST(b AS DOUBLE) AS abstain_weight, CAST(f + a + b AS DOUBLE) AS total, votes FROM g""",
    "vote_summary_documents": f"""{_VW}, t AS (SELECT period, count(DISTINCT vote_id) AS event_count FROM ok GROUP BY ALL),
c AS (SELECT period, string_agg(country, ',' ORDER BY w DESC, country) AS o FROM (SELECT period, country, {' + '.join(f"round(coalesce(sum(cw) FILTER (position = '{x}'), 0), 3)" for x in ('for', 'against', 'abstain'))} AS w FROM ok GROUP BY ALL) GROUP BY ALL),
k AS (SELECT period, string_agg(topic, ',' ORDER BY w DESC, topic) AS o FROM (SELECT period, topic, {' + '.join(f"round(coalesce(sum(cw) FILTER (position = '{x}'), 0), 3)" for x in ('for', 'against', 'abstain'))} AS w FROM ok GROUP BY ALL) GROUP BY ALL),
b AS (SELECT period, string_agg(country || '-' || topic, ',' ORDER BY w DESC, country, topic) AS o FROM (SELECT period, country, topic, {' + '.join(f"round(coalesce(sum(cw) FILTER (position = '{x}'), 0), 3)" for x in ('for', 'against', 'abstain'))} AS w FROM ok GROUP BY ALL) GROUP BY ALL)
SELECT period AS window_days, mode, event_count, c.o AS by_country_order, k.o AS by_topic_order, b.o AS by_country_topic_order FROM t JOIN c USING (period) JOIN k USING (period) JOIN b USING (period), (VALUES ('all'), ('internal')) m(mode)""",
    "vote_partner_change": f"{_V} {_VG} {_VP} SELECT * FROM pc",
    "vote_change": f"""{_TC} {_VG} {_VP}, r AS (SELECT country, topic || ':' || printf('%.3f', delta) AS t, row_number() OVER (PARTITION BY country ORDER BY abs(delta) DESC, topic) AS rn FROM tc),
tl AS (SELECT country, string_agg(t, ',' ORDER BY rn) AS every_topic, string_agg(t, ',' ORDER BY rn) FILTER (rn <= 5) AS top_topics FROM r GROUP BY country),
z AS (SELECT coalesce(pc.country, tl.country) AS country, coalesce(gained, '') AS gained, coalesce(lost, '') AS lost, coalesce(kept, '') AS kept, coalesce(partners_current, 0) AS partners_current, coalesce(partners_previous, 0) AS partners_previous, coalesce(partner_delta, 0) AS partner_delta, every_topic, top_topics
  FROM pc FULL JOIN tl ON pc.country = tl.country)
SELECT CAST(row_number() OVER (ORDER BY abs(partner_delta) DESC, country) AS INTEGER) AS ordinal, country, gained, lost, kept, partners_current, partners_previous, partner_delta, every_topic AS all_topic_changes, top_topics AS top_topic_changes FROM z""",
    "report_topics": f"""{_TC}, q AS (SELECT topic, CAST(sum(CAST(abs(delta) AS DECIMAL(18, 3))) AS DOUBLE) AS absolute_delta_total, string_agg(country, ',' ORDER BY rn) FILTER (rn <= 5) AS countries
FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY abs(delta) DESC, country) AS rn FROM tc) GROUP BY topic)
SELECT topic, {_labels(TOPIC_LABELS, 'topic')} AS topic_label, absolute_delta_total, CAST(row_number() OVER (ORDER BY absolute_delta_total DESC, topic) AS INTEGER) AS place, countries FROM q QUALIFY place <= 8""",
    "vote_record_rows": f"""{_VB}, {_TITLES}, n AS (SELECT vote_id, count(DISTINCT country) AS n_countries, count(DISTINCT grp) AS n_groups FROM m GROUP BY vote_id), de AS (SELECT vote_id, position FROM vp WHERE country = 'DE')
SELECT 'vote_' || p_partkey AS id, title, {_vote_topic('k')} AS topic, n_countries, n_groups, de.position AS de FROM t JOIN n ON n.vote_id = p_partkey LEFT JOIN de ON de.vote_id = p_partkey""",
    "vote_run_summary": f"""{_VB}, r AS (SELECT p_partkey, strftime(DATE '2024-01-01' + CAST(p_partkey % 400 AS INTEGER), '%Y-%m-%d') AS date, {_vote_topic("translate(lower(p_name), '’–—_/', '''    ')")} AS topic, n FROM part JOIN (SELECT vote_id, count(DISTINCT country) AS n FROM m GROUP BY vote_id) c ON c.vote_id = p_partkey)
SELECT count(*) AS new_records, min(date) AS min_date, max(date) AS max_date, {_R('CAST(sum(n) AS DOUBLE) / count(*)', 2)} AS average_countries_per_record, count(*) AS total_saved_records,
(SELECT string_agg(topic || ':' || c, ',' ORDER BY topic) FROM (SELECT topic, count(*) AS c FROM r GROUP BY topic)) AS topic_counts FROM r""",
    "upsert_customers": "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 2, o_orderkey DESC) = 1",
    "graph_edges": f"{_BASE}, {_EDGES} SELECT * FROM edges",
    "graph_nodes": f"{_BASE} SELECT window_days, mode, c AS country, CAST(round(sum(w), 2) AS DOUBLE) AS weight FROM (SELECT window_days, mode, w, unnest([a, b]) AS c FROM pm) GROUP BY ALL",
    "event_counts": f"{_BASE} SELECT window_days, count(*) AS event_count FROM ew GROUP BY ALL",
    "heatmap": f"{_BASE}, {_CELLS}, {_HEAT} SELECT * FROM heat",
    "heatmap_norm": f"{_BASE}, {_CELLS}, {_HEAT}, {_NORM} SELECT * FROM norm",
    "similarity": f"{_BASE}, {_CELLS}, {_HEAT}, {_NORM}, {_SIM} SELECT * FROM sim",
    "relationship_pairs": f"{_ALL} SELECT window_days, mode, source, target, score, band, direct_score, similarity_score, topic_score, direct_weight, similarity_weight FROM rel",
    "relationship_change": f"{_CHANGE} SELECT window_days, mode, source, target, current_score, previous_score, delta, status, current_band, previous_band, ordinal FROM ch",
    "report_pairs": f"""{_CHANGE} SELECT mode, 'strongest' AS kind, source, target, delta, status FROM ch WHERE ordinal <= 8
UNION ALL SELECT mode, status, source, target, delta, status FROM (SELECT * FROM ch WHERE status IN ('gained', 'lost') QUALIFY row_number() OVER (PARTITION BY mode, status ORDER BY ordinal) <= 8)
UNION ALL SELECT mode, status, source, target, delta, status FROM (SELECT * FROM ch WHERE status IN ('improved', 'declined') QUALIFY row_number() OVER (PARTITION BY mode, status ORDER BY abs(delta) DESC, ordinal) <= 8)""",
    "news_text": f"""SELECT news_id AS ingest_seq, {_text("title", "summary")} AS text,
{_TITLE_KEY} AS title_hash, trim(regexp_replace(translate(lower(coalesce(title, '')), '’–—_/', '''    '), '\\s+', ' ', 'g')) AS topic_text FROM news_items""",
    "vote_topics": "SELECT news_id AS ingest_seq, CASE " + " ".join(f"WHEN {_any('t', w)} THEN '{k}'" for k, w in VOTE_TOPIC_KEYWORDS.items()) + " ELSE 'trade' END AS vote_topic FROM (SELECT news_id, translate(lower(coalesce(title, '')), '’–—_/', '''    ') AS t FROM news_items)",
    "dedup_news": f"""WITH u AS (SELECT * FROM news_items QUALIFY coalesce(url, '') = '' OR row_number() OVER (PARTITION BY url ORDER BY news_id) = 1)
SELECT news_id AS ingest_seq FROM u QUALIFY row_number() OVER (PARTITION BY {_TITLE_KEY} ORDER BY news_id) = 1""",
    "dedup_coded": "SELECT row_id FROM coded_messages QUALIFY row_number() OVER (PARTITION BY coalesce(nullif(metadata['GlobalEventID'], ''), coalesce(title, '') || chr(124) || coalesce(url, '')) ORDER BY row_id) = 1",
    "country_edges": f"""{_NW}, p AS ({_NORMAL_PAIRS}), c AS (SELECT source, target, count(*) AS weight FROM p GROUP BY ALL), t AS (SELECT source, target, unnest(topics) AS topic FROM p)
SELECT source, target, any_value(weight) AS weight, {', '.join(f"count(*) FILTER (topic = '{t}') AS {t}" for t in TOPICS)} FROM c LEFT JOIN t USING (source, target) GROUP BY source, target""",
    "country_nodes": f"{_NW} SELECT country, count(*) AS weight FROM (SELECT unnest(countries) AS country FROM nw) WHERE country IN {_EU} GROUP BY ALL",
    "policy_edges": f"WITH s AS (SELECT DISTINCT unnest(topics) AS topic, country FROM ({_EUNEWS})) SELECT a.country AS source, b.country AS target, count(*) AS weight FROM s a JOIN s b ON a.topic = b.topic AND a.country < b.country GROUP BY ALL",
    "policy_nodes": f"SELECT country, CAST(sum(len(topics)) AS BIGINT) AS weight FROM ({_EUNEWS}) GROUP BY ALL",
    "debug_counters": """WITH f AS (SELECT coalesce(len(topics), 0) > 0 AS t, coalesce(len(countries), 0) > 0 AS c FROM news_items)
SELECT 'events' AS what, 'events' AS value, count(*) AS n FROM f UNION ALL SELECT 'events', 'with_topics', count(*) FILTER (t) FROM f UNION ALL SELECT 'events', 'with_countries', count(*) FILTER (c) FROM f UNION ALL SELECT 'events', 'relevant', count(*) FILTER (t AND c) FROM f
UNION ALL (SELECT 'source', coalesce(source_name, '') AS v, count(*) AS k FROM news_items GROUP BY v ORDER BY k DESC, v LIMIT 10)
UNION ALL (SELECT 'topic', v, count(*) AS k FROM (SELECT unnest(topics) AS v FROM news_items) WHERE v IS NOT NULL GROUP BY v ORDER BY k DESC, v LIMIT 10)
UNION ALL (SELECT 'country', v, count(*) AS k FROM (SELECT unnest(countries) AS v FROM news_items) WHERE v IS NOT NULL GROUP BY v ORDER BY k DESC, v LIMIT 15)""",
    "storage_days": "SELECT strftime(CAST(CAST(collected_at AS TIMESTAMPTZ) AS DATE), '%Y-%m-%d') AS day, count(*) AS n FROM coded_messages GROUP BY ALL",
    "vote_fold": f"""{_V} SELECT vote_id, level, key, count(*) FILTER (position = 'for') AS n_for, count(*) FILTER (position = 'against') AS n_against, count(*) FILTER (position = 'abstain') AS n_abstain
FROM (SELECT vote_id, 'country' AS level, country AS key, position FROM m UNION ALL SELECT vote_id, 'group', grp, position FROM m UNION ALL SELECT vote_id, 'vote', NULL, position FROM m) GROUP BY ALL""",
    "vote_majority": f"{_V} SELECT vote_id, country, position FROM vp",
    "vote_conflicts": f"{_V} SELECT vote_id, n AS n_valid, divisive, CAST(cw AS DOUBLE) AS conflict FROM cf",
    "vote_similarity": f"{_V} {_VS} SELECT period, source, target, weight FROM sim",
    "vote_similarity_nodes": f"{_V} {_VN} SELECT period, country, {_R('sqrt(' + ' + '.join(f'{t} * {t}' for t in TOPICS) + ')', 3)} AS weight FROM norm",
    "vote_relationship": f"{_V} {_VG}, edges AS (SELECT period, source, target, weight FROM vedge) {_VS}, {_index(0.45, 0.35, 0.2, 'period')} SELECT period, source, target, score, band, direct_score, similarity_score, topic_score, direct_weight, similarity_weight FROM rel",
    "vote_topic_change": f"""{_V} {_VH}, l AS (UNPIVOT vh ON {', '.join(TOPICS)} INTO NAME topic VALUE v),
x AS (SELECT country, topic, coalesce(max(v) FILTER (period = 'current'), 0) AS current, coalesce(max(v) FILTER (period = 'previous'), 0) AS previous FROM l GROUP BY ALL) SELECT country, topic, current, previous, {_R('current - previous', 3)} AS delta FROM x""",
    "series_metrics": f"""{_DAILY} SELECT event_type, strftime(day, '%Y-%m-%d') AS day, value, {_R('avg(value) OVER (PARTITION BY event_type ORDER BY day ROWS 6 PRECEDING)', 2)} AS value_ma,
{_R('CASE WHEN i = 1 THEN 0 ELSE regr_slope(value, i) OVER (PARTITION BY event_type ORDER BY day ROWS 13 PRECEDING) END', 4)} AS trend_slope FROM n""",
    "series_trend": f"{_DAILY} {_FIT} SELECT event_type, strftime(day, '%Y-%m-%d') AS day, {_R('c + k * (i - 1)', 2)} AS trend FROM n JOIN f USING (event_type)",
    "series_forecast": f"{_DAILY} {_FIT} SELECT event_type, strftime(last + CAST(j AS INTEGER), '%Y-%m-%d') AS day, {_R('c + k * (n + j - 1)', 2)} AS forecast FROM f, range(1, 4) r(j)",
    "report_topic_shifts": f"""{_TC} SELECT country, topic, current, previous, delta FROM (SELECT * FROM tc QUALIFY row_number() OVER (PARTITION BY country ORDER BY abs(delta) DESC, topic) = 1) ORDER BY abs(delta) DESC, country LIMIT 12""",
    "coded_counters": f"""{_CODED} SELECT count(*) AS rows_total, count(a) AS actor1_mapped, count(b) AS actor2_mapped, count(c) AS place_mapped, count(*) FILTER (len(cs) > 0) AS with_country,
count(*) FILTER (len(cs) >= 2) AS with_pair, count(*) FILTER (len(cs) >= 2 AND list_has_any(cs, [{_EU[1:-1]}])) AS relevant, count(*) FILTER (len(cs) >= 2 AND list_has_any(cs, [{_EU[1:-1]}])) AS events_built FROM x""",
    "coded_built": f"""{_CODED}, y AS (SELECT *, trim(coalesce(metadata['EventRootCode'], '')) AS root, trim(coalesce(metadata['EventCode'], '')) AS code FROM x WHERE len(cs) >= 2 AND list_has_any(cs, [{_EU[1:-1]}])),
z AS (SELECT *, list_sort(list_distinct(list_filter([CASE WHEN root IN ('19', '20') THEN 'defence' END, CASE WHEN root IN ('19', '20') THEN 'ukraine_russia' END, CASE WHEN root IN ('13', '14', '17') THEN 'rule_of_law' END,
  CASE WHEN root IN ('05', '06', '07', '08') OR left(code, 3) IN ('112', '113', '120', '121', '122', '123') THEN 'trade' END, CASE WHEN left(code, 3) IN ('112', '113', '120', '121', '122', '123') THEN 'fiscal' END], lambda t: t IS NOT NULL))) AS ts FROM y),
w AS (SELECT *, CASE WHEN len(ts) = 0 THEN ['defence'] ELSE ts END AS t FROM z)
SELECT row_id, 'GDELT event ' || coalesce(nullif(metadata['Actor1Name'], ''), cs[1]) || ' - ' || coalesce(nullif(metadata['Actor2Name'], ''), cs[2]) || ' code ' || code AS title, t[1] AS primary_topic,
array_to_string(t, ',') AS topics, array_to_string(cs, ',') AS countries,
array_to_string(list_concat([cs[1] || '-' || cs[2]], CASE WHEN len(cs) = 3 THEN [cs[1] || '-' || cs[3], cs[2] || '-' || cs[3]] ELSE [] END), ',') AS pairs FROM w""",
    "upsert_orders": "SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 2 = 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders",
    "newest_orders": "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) <= 2",
}
