"""DuckDB SQL for the linkage queries, written from the operators' definitions.

Functions here make SQL text for expressions that several queries need.
"""

from __future__ import annotations

from linkloom.functions.text import LEGAL_SUFFIXES, STOPWORDS


def _in(words: list[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


LEGAL, STOP, DROPPED = _in(LEGAL_SUFFIXES), _in(STOPWORDS), _in(LEGAL_SUFFIXES + STOPWORDS)


def rounded(x: str, digits: int) -> str:
    """To so many decimals by the exact binary value, a half to the even side: the doubled scaled number, as a double and the rest, against 2k + 1."""
    scale, twice = 10**digits, 2 * 10**digits
    k, high = f"floor(v * {scale}::DOUBLE)", "(v * 134217729::DOUBLE - (v * 134217729::DOUBLE - v))"
    rest = f"(({high} * {twice}::DOUBLE - v * {twice}::DOUBLE) + (v - {high}) * {twice}::DOUBLE)"
    beyond = f"((v * {twice}::DOUBLE - (2::DOUBLE * {k} + 1::DOUBLE)) + {rest})"
    return f"list_transform([({x})::DOUBLE], lambda v: ({k} + CASE WHEN {beyond} > 0 OR ({beyond} = 0 AND {k} % 2 <> 0) THEN 1 ELSE 0 END)::DOUBLE / {scale}::DOUBLE)[1]"


def r2(x: str) -> str:
    return rounded(x, 2)


def fold(x: str) -> str:
    return rf"regexp_replace(strip_accents({x}), '[^\x00-\x7F]', '', 'g')"


def words(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda q: q <> '')"


def norm(x: str) -> str:
    low = rf"regexp_replace(lower({fold(x)}), '\([^)]*\)', ' ', 'g')"
    undotted = rf"list_reduce(list_prepend({low}, regexp_extract_all({low}, '\b(?:[a-z]\.){{2,}}')), lambda s, m: replace(s, m, replace(m, '.', '')))"
    plain = rf"regexp_replace(replace({undotted}, '/', ' '), '[^\w\s&+]', ' ', 'g')"
    return f"array_to_string(list_transform({words(plain)}, lambda q: CASE q WHEN '4' THEN 'for' WHEN 'u' THEN 'you' WHEN '&' THEN 'and' WHEN '+' THEN 'and' ELSE q END), ' ')"


def less(x: str, dropped: str) -> str:
    return f"array_to_string(list_filter({words(x)}, lambda q: q NOT IN {dropped}), ' ')"


def decorated(name: str, key: str) -> str:
    return f"CASE {key} % 5 WHEN 0 THEN {name} || ', L.L.C.' WHEN 1 THEN 'The ' || {name} || ' Co' WHEN 2 THEN upper({name}) || ' (main)' WHEN 3 THEN {name} || ' & Partners dba ' || {name} ELSE {name} END"


def parts(x: str) -> str:
    """Parts of a name around the trading mark; the test names have no other mark."""
    bare = rf"regexp_replace({x}, '\([^)]*\)', ' ', 'g')"
    left = rf"regexp_split_to_array({bare}, '(?i)\bdba\b')[1]"
    sides = f"[trim({left}, ' ,-/'), trim(substr({bare}, length({left}) + 4), ' ,-/')]"
    return rf"list_filter([{bare}] || CASE WHEN regexp_matches({bare}, '(?i)\bdba\b') THEN {sides} ELSE [] END, lambda p: p <> '')"


def variants(x: str) -> str:
    """Ordered distinct variants: the place of the first occurrence decides."""
    each = f"flatten(list_transform({parts(x)}, lambda p: list_transform([0, 1, 2], lambda k: CASE k WHEN 0 THEN {norm('p')} WHEN 1 THEN {less(norm('p'), LEGAL)} ELSE {less(norm('p'), DROPPED)} END)))"
    return ordered(each)


def ordered(each: str) -> str:
    return f"list_reduce(list_prepend([]::VARCHAR[], list_transform({each}, lambda v: [v])), lambda s, v: CASE WHEN v[1] = '' OR list_contains(s, v[1]) THEN s ELSE s || v END)"


def _masks(short: str, long: str) -> str:
    return f"list_transform(string_split({long}, ''), lambda c: list_sum(list_transform(range(length({short})), lambda i: CASE WHEN substr({short}, i + 1, 1) = c THEN 1::BIGINT << i ELSE 0 END))::BIGINT)"


def _ones(short: str) -> str:
    return f"((1::BIGINT << length({short})) - 1)"


def _run(short: str, masks: str) -> str:
    return f"(length({short}) - bit_count(list_reduce(list_prepend({_ones(short)}, {masks}), lambda v, m: ((v + (v & m)) | (v & ~m)) & {_ones(short)})))"


def lcs(a: str, b: str) -> str:
    return f"(CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE {_run(a, _masks(a, b))} END)"


def ratio(a: str, b: str) -> str:
    return f"(CASE WHEN {a} = '' AND {b} = '' THEN 100::DOUBLE ELSE 200::DOUBLE * {lcs(a, b)} / (length({a}) + length({b})) END)"


def _slide(s: str, t: str) -> str:
    n = f"length({s})"
    window = f"(least(i + {n}, length({t})) - greatest(i, 0))"
    hit = _run(s, f"list_slice({_masks(s, t)}, greatest(i, 0) + 1, least(i + {n}, length({t})))")
    return f"list_max(list_transform(range(1 - {n}, length({t})), lambda i: 200::DOUBLE * {hit} / ({n} + {window})))"


def partial(a: str, b: str) -> str:
    return f"""(CASE WHEN {a} = '' OR {b} = '' THEN (CASE WHEN {a} = {b} THEN 100 ELSE 0 END)::DOUBLE WHEN contains({a}, {b}) OR contains({b}, {a}) THEN 100::DOUBLE
      WHEN length({a}) = length({b}) THEN greatest({_slide(a, b)}, {_slide(b, a)}) WHEN length({a}) < length({b}) THEN {_slide(a, b)} ELSE {_slide(b, a)} END)"""


def sorted_words(x: str) -> str:
    return f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"


def token_set(a: str, b: str) -> str:
    """Over columns that `_compared` made: i, oa, ob are the joined sets, lo the common subsequence of oa and ob."""
    g = "(CASE WHEN length(i) > 0 THEN 1 ELSE 0 END)"
    sa, sb = f"(length(i) + {g} + length(oa))", f"(length(i) + {g} + length(ob))"
    main = f"(100::DOUBLE - 100::DOUBLE * (length(oa) + length(ob) - 2 * lo) / ({sa} + {sb}))"
    sides = f"greatest({main}, 100::DOUBLE - 100::DOUBLE * ({g} + length(oa)) / (length(i) + {sa}), 100::DOUBLE - 100::DOUBLE * ({g} + length(ob)) / (length(i) + {sb}))"
    return f"(CASE WHEN {a} = '' OR {b} = '' THEN 0::DOUBLE WHEN length(i) > 0 AND (oa = '' OR ob = '') THEN 100::DOUBLE WHEN length(i) > 0 THEN {sides} ELSE {main} END)"


def compared(pairs: str) -> str:
    """CTEs over `pairs` (a, b): cmp has what comparisons need, scored the score of variants and the guard."""
    return f"""
cmp0 AS (
  SELECT a, b, string_split(a, ' ') AS wa, string_split(b, ' ') AS wb, {less('a', DROPPED)} AS ca, {less('b', DROPPED)} AS cb FROM (SELECT DISTINCT a, b FROM {pairs})
), cmp1 AS (
  SELECT *, array_to_string(list_sort(list_distinct(list_filter(wa, lambda q: list_contains(wb, q)))), ' ') AS i,
    array_to_string(list_sort(list_distinct(list_filter(wa, lambda q: NOT list_contains(wb, q)))), ' ') AS oa,
    array_to_string(list_sort(list_distinct(list_filter(wb, lambda q: NOT list_contains(wa, q)))), ' ') AS ob,
    list_distinct(list_filter(wa, lambda q: q NOT IN {DROPPED})) AS ta, list_distinct(list_filter(wb, lambda q: q NOT IN {DROPPED})) AS tb
  FROM cmp0
), cmp AS (
  SELECT *, {lcs('oa', 'ob')} AS lo, {ratio('a', 'b')} AS rab, {ratio(sorted_words('a'), sorted_words('b'))} AS tsort, {ratio('ca', 'cb')} AS rc,
    len(list_filter(ta, lambda q: list_contains(tb, q))) AS both_n, len(ta) + len(tb) - len(list_filter(ta, lambda q: list_contains(tb, q))) AS any_n
  FROM cmp1
), cmp2 AS (
  SELECT *, {token_set('a', 'b')} AS tset, CASE WHEN any_n > 0 THEN 100::DOUBLE * both_n / any_n ELSE 0::DOUBLE END AS overlap,
    len(ta) > 0 AND len(tb) > 0 AND (both_n = len(ta) OR both_n = len(tb)) AS contained FROM cmp
), cmp3 AS (
  SELECT *, greatest(CASE WHEN a = b THEN 100::DOUBLE ELSE 0::DOUBLE END, rab, 0.45::DOUBLE * tset + 0.20::DOUBLE * tsort + 0.35::DOUBLE * overlap) AS s0,
    CASE WHEN overlap >= 50 OR contained OR a = b THEN {partial('a', 'b')} END AS part FROM cmp2
), scored AS (
  SELECT *, CASE WHEN overlap = 0 AND NOT contained AND a <> b THEN least(s0, CASE WHEN ca <> '' OR cb <> '' THEN rc ELSE rab END)
    WHEN part IS NOT NULL THEN greatest(s0, 0.92::DOUBLE * part) ELSE s0 END AS score FROM cmp3
)"""


def guard(score: str) -> str:
    """Over `scored`."""
    tight = "(contains(replace(ca, ' ', ''), replace(cb, ' ', '')) OR contains(replace(cb, ' ', ''), replace(ca, ' ', '')))"
    pc = partial("ca", "cb")
    return f"(both_n > 0 OR CASE WHEN ca = '' OR cb = '' THEN rab >= 90 ELSE {tight} OR rc >= 85 OR {pc} >= 92 OR ({score} >= 80 AND greatest(rc, {pc}) >= 80) END)"


LIVE = f"""
live AS (
  SELECT 'export-' || (p_partkey % 3) || '.csv' AS source_file, 'Origination Detail' AS source_sheet, p_partkey AS source_row_number, p_brand AS source_code, p_type AS state,
    {decorated('p_name', 'p_partkey')} AS name, DATE '2024-01-01' + (p_partkey % 120)::INTEGER AS day, p_retailprice AS amount, lpad((p_partkey % 50)::VARCHAR, 5, '0') AS zip
  FROM part WHERE p_partkey % 2 = 1
)"""
ITEMS = f"""{LIVE}, prep AS (
  SELECT *, {variants('name')} AS vs FROM live
), keyed AS (SELECT *, coalesce(vs[1], '') AS dedupe_name_key FROM prep
), items AS (
  SELECT source_code, state, dedupe_name_key, arg_min(vs, (source_file, source_row_number)) AS vs, min(day) AS day, sum(amount) AS amount, count(*) AS n,
    coalesce(string_agg(DISTINCT zip, '; '), '') AS zips
  FROM keyed GROUP BY ALL
)"""
CANDIDATES = f"""
cand AS (
  SELECT p_partkey AS application_id, p_brand AS source_code,
    CASE WHEN p_partkey % 6 = 0 THEN p_type ELSE upper(p_type) END AS state,
    {ordered(f"{variants(decorated('p_name', 'p_partkey'))} || CASE WHEN p_partkey % 8 = 0 THEN {variants("'Ann ' || p_name")} ELSE [] END")} AS vs,
    {variants(decorated('p_name', 'p_partkey'))} AS bvs,
    lpad((p_partkey % 50)::VARCHAR, 5, '0') AS zip, floor(p_retailprice * 0.8::DOUBLE) AS low, floor(p_retailprice * 1.2::DOUBLE) AS high,
    DATE '2024-02-01' + (p_partkey % 90)::INTEGER AS lead
  FROM part WHERE p_partkey % 2 = 0
)"""
BLOCKED = f"""{ITEMS}, {CANDIDATES}, blocked AS (
  SELECT i.*, application_id, cand.vs AS cvs, cand.zip, low, high, lead, lead - i.day > 30 AS late FROM items i JOIN cand USING (source_code, state)
)"""
CORROBORATED = f"""{BLOCKED}, corr AS (
  SELECT *, contains(zips, zip) AS z, amount BETWEEN low AND high AS inside, amount BETWEEN 0.5::DOUBLE * low AND 1.5::DOUBLE * high AS near FROM blocked
), adj AS (
  SELECT *, (CASE WHEN z THEN 4 ELSE 0 END + CASE WHEN inside THEN 3 WHEN near THEN 1 ELSE 0 END)::DOUBLE AS adjustment,
    concat_ws('; ', 'source matched', 'state matched', CASE WHEN z THEN 'zip matched' END, CASE WHEN inside THEN 'amount within loan range' WHEN near THEN 'amount roughly aligned with loan range' END,
      CASE WHEN day >= lead THEN 'origination after lead created' ELSE 'origination slightly before lead date' END) AS supporting_signals FROM corr
)"""
LINKED = f"""{CORROBORATED}, vp AS (
  SELECT source_code, state, dedupe_name_key, application_id, adjustment, a, x, b, y FROM (
    SELECT source_code, state, dedupe_name_key, application_id, adjustment, unnest(vs) AS a, generate_subscripts(vs, 1) AS x, cvs FROM adj WHERE NOT late)
    , LATERAL (SELECT unnest(cvs) AS b, generate_subscripts(cvs, 1) AS y)
), {compared('vp')}, best AS (
  SELECT source_code, state, dedupe_name_key, application_id, any_value(adjustment) AS adjustment, arg_min((a, b), (-score, x, y)) AS won, max(score) AS top
  FROM vp JOIN scored USING (a, b) GROUP BY ALL
), named AS (
  SELECT best.*, {r2('top')} AS name_score, scored.* EXCLUDE (score) FROM best JOIN scored ON scored.a = won[1] AND scored.b = won[2]
), fine AS (
  SELECT *, {r2('least(100::DOUBLE, name_score + adjustment)')} AS overall FROM named WHERE name_score >= 55 AND {guard('name_score')}
), ranked AS (
  SELECT *, row_number() OVER w AS nth, lead(overall) OVER w AS runner FROM fine WHERE overall >= 58
  WINDOW w AS (PARTITION BY source_code, state, dedupe_name_key ORDER BY overall DESC, application_id)
), banded AS (
  SELECT *, {r2('overall - coalesce(runner, 0)')} AS gap FROM ranked WHERE nth = 1
), matches AS (
  SELECT *, CASE WHEN overall >= 94 AND name_score >= 92 AND gap >= 5 THEN 'auto_accept' WHEN overall >= 60 THEN 'review' WHEN overall >= 58 THEN 'possible_match' ELSE 'discard' END AS band FROM banded
)"""
PAIRS = f"{BLOCKED}, p AS (SELECT DISTINCT a, b FROM (SELECT unnest(vs) AS a, cvs FROM blocked), LATERAL (SELECT unnest(cvs) AS b))"
FAR = "far_cand AS (SELECT * REPLACE (CASE WHEN state LIKE 'S%' THEN 'ELSEWHERE' ELSE state END AS state) FROM cand)"
HISTORY = """
hist AS (
  SELECT sha1(user_id || '||' || event_type) AS match_key, CASE e % 4 WHEN 0 THEN 'auto_accept' WHEN 1 THEN 'review' ELSE 'possible_match' END AS decision_band,
    CASE WHEN e % 5 = 0 THEN 'confirmed' ELSE 'new' END AS status, '' AS status_note, CASE e % 3 WHEN 0 THEN 'Approved' WHEN 1 THEN 'OPEN' ELSE 'Denied' END AS candidate_status,
    v AS match_score, '2024-01-' || lpad((e % 28 + 1)::VARCHAR, 2, '0') AS first_seen_at, '2024-02-01' AS last_seen_at, '' AS status_updated_at, '2024Q1' AS quarter_first_seen,
    'run-1' AS first_run_label, 'run-1' AS last_run_label, e % 7 + 1 AS times_seen
  FROM (SELECT user_id, event_type, min(event_id) AS e, arg_min(value, event_id) AS v FROM events WHERE user_id % 3 <> 0 GROUP BY ALL)
), new AS (
  SELECT sha1(user_id || '||' || event_type) AS match_key, CASE WHEN e % 2 = 0 THEN 'auto_accept' ELSE 'review' END AS decision_band, 'InProgress' AS candidate_status, v AS match_score
  FROM (SELECT user_id, event_type, max(event_id) AS e, arg_max(value, event_id) AS v FROM events WHERE user_id % 2 = 0 GROUP BY ALL)
)"""
TRUTH = """
truth AS (SELECT doc_id AS key, CASE WHEN quality = 1 THEN doc_id % 7 END AS expected, 'case_' || (doc_id % 4) AS kase FROM labels),
pred AS (SELECT doc_id AS key, CASE WHEN doc_id % 10 = 0 THEN (doc_id + 1) % 7 ELSE doc_id % 7 END AS app, CASE WHEN doc_id % 3 = 0 THEN 'review' WHEN doc_id % 11 = 0 THEN 'possible_match' ELSE 'auto_accept' END AS band FROM documents WHERE doc_id % 9 <> 0)"""
LABEL = """CASE WHEN expected IS NULL THEN CASE WHEN band IS NULL THEN 'correctly_abstained' WHEN band = 'auto_accept' THEN 'false_resolution' ELSE 'deferred_trap' END
  WHEN band IS NULL THEN 'missed' WHEN band = 'auto_accept' THEN CASE WHEN app = expected THEN 'resolved_correct' ELSE 'resolved_wrong' END
  WHEN app = expected THEN 'deferred_correct' ELSE 'deferred_wrong' END"""
OUT = f"{TRUTH}, o AS (SELECT truth.key, expected, kase, {LABEL} AS label FROM truth LEFT JOIN pred USING (key))"
_LABELS = ["resolved_correct", "resolved_wrong", "false_resolution", "deferred_correct", "deferred_wrong", "deferred_trap", "missed", "correctly_abstained"]


def _pct(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0::DOUBLE ELSE {rounded(f'({a}) * 100::DOUBLE / ({b})', 1)} END"


def _metrics(out: str) -> str:
    counts = ", ".join(f"count(*) FILTER (label = '{x}') AS {x}" for x in _LABELS)
    return f"""WITH {out}, c AS (SELECT count(*) AS records, count(expected) AS expecting_a_match, count(*) FILTER (expected IS NULL) AS traps, {counts} FROM o),
d AS (SELECT *, resolved_correct + resolved_wrong + false_resolution AS automated, deferred_correct + deferred_wrong + deferred_trap AS human_queue FROM c)
SELECT *, {_pct('resolved_correct', 'automated')} AS automation_precision, {_pct('resolved_correct', '(records - traps)')} AS automation_rate,
  {_pct('resolved_wrong + false_resolution', 'greatest(automated, 1)')} AS error_rate, {_pct('deferred_trap + correctly_abstained', 'greatest(traps, 1)')} AS trap_survival FROM d"""


OFFERED = f"""{ITEMS}, {CANDIDATES}, near AS (SELECT i.source_code, i.state, dedupe_name_key, i.vs, application_id, c.bvs FROM items i JOIN cand c ON c.source_code = i.source_code AND c.state = i.state),
pool AS (FROM near UNION ALL SELECT i.source_code, i.state, dedupe_name_key, i.vs, application_id, c.bvs FROM items i JOIN cand c ON c.source_code = i.source_code WHERE (i.source_code, i.state) NOT IN (SELECT (source_code, state) FROM cand)),
vp AS (SELECT source_code, state, dedupe_name_key, application_id, a, b FROM (SELECT *, unnest(vs) AS a FROM pool), LATERAL (SELECT unnest(bvs) AS b)),
{compared('vp')}, s AS (SELECT source_code, state, dedupe_name_key, application_id, {r2('max(tset)')} AS m FROM vp JOIN scored USING (a, b) GROUP BY ALL)"""
PART = f"(SELECT p_partkey, {decorated('p_name', 'p_partkey')} AS name FROM part)"
_ANSWER = """
ans AS (
  SELECT o_orderkey, o_orderkey % 14 AS k FROM orders
), dec AS (
  SELECT o_orderkey, CASE WHEN k IN (4, 5, 12, 13) THEN 'low' WHEN k = 6 THEN 'medium' ELSE 'high' END AS confidence,
    CASE WHEN k = 0 THEN 'response omitted matched_candidate_id' WHEN k = 12 THEN 'model returned no tool call'
      WHEN k IN (1, 7, 10, 13) THEN 'matched_candidate_id was not an integer: ' || CASE k WHEN 1 THEN chr(39) || 'x1' || chr(39) WHEN 7 THEN 'None' WHEN 10 THEN chr(39) || '2.0' || chr(39) ELSE '"it' || chr(39) || 's"' END END AS error,
    CASE k WHEN 2 THEN 'model found no matching candidate' WHEN 3 THEN 'id 99 was not among the candidates offered' WHEN 4 THEN 'confidence too low to resolve' WHEN 5 THEN 'confidence too low to resolve' END AS refused_reason,
    k IN (6, 8, 9, 11) AS resolved, CASE WHEN k IN (4, 5, 8) THEN 2 WHEN k IN (6, 9, 11) THEN 1 END::BIGINT AS chosen, CASE k WHEN 6 THEN 'same name' ELSE '' END AS reasoning
  FROM ans
)"""
_REJECTS = """
r AS (SELECT o_orderkey AS n, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END AS name, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderstatus END AS st FROM orders),
x AS (SELECT CASE WHEN st = '' THEN 'missing_state' WHEN name = '' THEN 'missing_business_name' END AS exception_type, * FROM r)"""


def _simple(expression: str) -> str:
    return f"WITH {PAIRS}, {compared('p')} SELECT a, b, {r2(expression)} AS score FROM scored"


ORACLES = {
    "q_ascii_fold": f"SELECT doc_id, {fold('text')} || ['XI', '15', 'dz', 'Rs', 'ffi', 'e', 'ms', '0.', ''][doc_id % 9 + 1] AS folded FROM documents",
    "q_normalize_text": f"SELECT doc_id, {norm('text')} AS normalized FROM documents",
    "q_legal_suffix_strip": f"SELECT p_partkey, {less(norm('name'), LEGAL)} AS stripped FROM {PART}",
    "q_stopword_strip": f"SELECT p_partkey, {less(norm('name'), DROPPED)} AS core FROM {PART}",
    "q_dba_split": f"SELECT p_partkey, array_to_string({parts('name')}, '|') AS parts FROM {PART}",
    "q_name_variants": f"SELECT p_partkey, array_to_string({variants('name')}, '|') AS variants FROM {PART}",
    "q_identifier_flag": "SELECT c_custkey, regexp_full_match(trim(lower(replace(c_name, '#', ' '))), '[a-z]?[0-9]{3,}') AS whole, regexp_full_match(right(c_name, 6), '[0-9]{3,}') AS digits FROM customer",
    "q_stable_hash": "SELECT c_custkey, sha1(c_name || '||' || c_nationkey || '||' || CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END) AS h FROM customer",
    "q_size_band_parse": """WITH b AS (SELECT p_partkey, p_partkey % 5 AS k, floor(p_retailprice)::DOUBLE AS p FROM part)
SELECT p_partkey, CASE k WHEN 0 THEN p WHEN 1 THEN p * 1000 WHEN 2 THEN p * 1000000 WHEN 4 THEN least(p * 1000, 2500000) END::DOUBLE AS low,
  CASE k WHEN 0 THEN p * 3 WHEN 1 THEN -1 WHEN 2 THEN p * 1000000 WHEN 4 THEN greatest(p * 1000, 2500000) END::DOUBLE AS high FROM b""",
    "q_quarter_label": "SELECT year(o_orderdate) || 'Q' || quarter(o_orderdate) AS quarter, count(*) AS n FROM orders GROUP BY 1",
    "q_quarter_filter": "SELECT o_orderkey, o_orderdate::DATE AS day FROM orders WHERE o_orderdate BETWEEN '1998-04-01' AND '1998-06-30'",
    "q_quarter_discovery": "SELECT DISTINCT year(o_orderdate) || 'Q' || quarter(o_orderdate) AS quarter FROM orders WHERE year(o_orderdate) <= 1998",
    "q_source_mapping_first_match": """SELECT f AS source_file, CASE WHEN contains(f, 'src1') THEN 'FIRST' WHEN contains(f, '-en') THEN 'ENGLISH' WHEN contains(f, 'src2') THEN 'SECOND' END AS source_code
FROM (SELECT DISTINCT source || '-' || lang || '.csv' AS f FROM documents)""",
    "q_row_rejects": f"""WITH {_REJECTS} SELECT exception_type, 'orders.csv' AS source_file, n AS source_row_number, name AS live_business_name,
  CASE exception_type WHEN 'missing_state' THEN 'State is required for matching.' ELSE 'Business name is blank.' END AS detail FROM x WHERE exception_type IS NOT NULL""",
    "q_collapse_duplicates": f"""WITH {LIVE}, again AS (FROM live UNION ALL SELECT * REPLACE (source_row_number + 1000000 AS source_row_number) FROM live WHERE source_row_number % 10 = 1),
k AS (SELECT *, coalesce({variants('name')}[1], '') AS dedupe_name_key FROM again)
SELECT source_code, state, dedupe_name_key, arg_min(name, (source_file, source_row_number)) AS live_business_name,
  arg_min(sha1(concat(source_code, '||', state, '||', dedupe_name_key, '||', strftime(day, '%Y-%m-%d'), '||', format('{{:.2f}}', amount))), (source_file, source_row_number)) AS live_record_key,
  string_agg(DISTINCT source_file, '; ' ORDER BY source_file) AS source_files, string_agg(DISTINCT source_sheet, '; ') AS source_sheets,
  string_agg(source_row_number::VARCHAR, ', ' ORDER BY source_file, source_row_number) AS source_row_numbers, string_agg(strftime(day, '%Y-%m-%d'), '; ' ORDER BY day) AS origination_dates,
  min(day) AS primary_origination_date, array_to_string(list_transform(list_sort(list(DISTINCT amount)), lambda v: format('{{:,.2f}}', v)), '; ') AS origination_amounts,
  sum(amount) AS primary_origination_amount, string_agg(DISTINCT zip, '; ' ORDER BY zip) AS live_zip_codes, count(*) AS duplicate_count
FROM k GROUP BY ALL""",
    "q_duplicates": f"WITH {ITEMS} SELECT source_code, state, dedupe_name_key, n AS duplicate_count, amount AS primary_origination_amount FROM items WHERE n > 1",
    "q_token_jaccard": f"WITH {PAIRS} SELECT a, b, len(list_intersect(x, y)) * 100::DOUBLE / len(list_distinct(x || y)) AS jaccard FROM (SELECT *, string_split(a, ' ') AS x, string_split(b, ' ') AS y FROM p)",
    "q_indel_ratio": _simple("rab"),
    "q_indel_ratio_native": _simple("rab"),
    "q_token_sort_ratio": _simple("tsort"),
    "q_token_set_ratio": _simple("tset"),
    "q_partial_ratio": f"WITH {PAIRS} SELECT a, b, {r2(partial('a', 'b'))} AS score FROM p",
    "q_name_score": _simple("score"),
    "q_name_signal_guard": f"WITH {PAIRS}, {compared('p')}, s AS (SELECT *, {r2('score')} AS shown FROM scored) SELECT a, b, {guard('shown')} AS signal FROM s",
    "q_corroboration": f"WITH {CORROBORATED} SELECT source_code, state, dedupe_name_key, application_id, adjustment, supporting_signals FROM adj",
    "q_date_guard": f"WITH {BLOCKED} SELECT source_code, state, dedupe_name_key, count(*) AS n, count(*) FILTER (late) AS excluded_for_date FROM blocked GROUP BY ALL",
    "q_block_join_counts": f"WITH {BLOCKED} SELECT source_code, state, count(*) AS pairs FROM blocked GROUP BY ALL",
    "q_no_block_anti": f"""WITH {ITEMS}, {CANDIDATES}, {FAR} SELECT source_code, state, dedupe_name_key, 'No candidates for this source/state.' AS reason FROM items i
WHERE NOT EXISTS (SELECT 1 FROM far_cand c WHERE c.source_code = i.source_code AND c.state = i.state)""",
    "q_no_survivor_reason": f"""WITH {LINKED}, t AS (SELECT source_code, state, dedupe_name_key, count(*) AS n, count(*) FILTER (late) AS l FROM blocked GROUP BY ALL), j AS (
  SELECT items.source_code, items.state, items.dedupe_name_key, CASE WHEN t.n IS NULL THEN 'No candidates for this source/state.'
    WHEN band IS NULL THEN 'No candidate cleared the score threshold.' || CASE WHEN l > 0 THEN ' (' || l || ' candidate(s) excluded because the record predates the lead.)' ELSE '' END
    WHEN band = 'discard' THEN 'Top candidate still fell below review threshold.' END AS reason
  FROM items LEFT JOIN t USING (source_code, state, dedupe_name_key) LEFT JOIN matches USING (source_code, state, dedupe_name_key))
SELECT * FROM j WHERE reason IS NOT NULL""",
    "q_top2_gap_band": f"""WITH {LINKED} SELECT source_code, state, dedupe_name_key, application_id, overall AS match_score, name_score, gap AS score_gap, band AS decision_band,
  won[1] AS matched_live_variant, won[2] AS matched_candidate_variant, runner AS alternative_candidate_score FROM matches WHERE band <> 'discard'""",
    "q_distinct_on_latest": "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_custkey, o_orderdate DESC NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey",
    "q_annotate_history": f"""WITH {HISTORY} SELECT match_key, coalesce(first_seen_at, '') AS first_seen_at, coalesce(last_seen_at, '') AS last_seen_at, coalesce(times_seen, 0) AS times_seen,
  coalesce(status, 'new') AS status, h.match_key IS NULL AS is_new_match FROM new LEFT JOIN (SELECT *, match_key AS k FROM hist) h USING (match_key)""".replace("h.match_key IS NULL", "h.k IS NULL"),
    "q_upsert_history": f"""WITH {HISTORY}
SELECT h.match_key, coalesce(n.decision_band, h.decision_band) AS decision_band, status, status_note, coalesce(n.candidate_status, h.candidate_status) AS candidate_status, coalesce(n.match_score, h.match_score) AS match_score,
  first_seen_at, CASE WHEN n.match_key IS NULL THEN last_seen_at ELSE '2024-03-01' END AS last_seen_at, status_updated_at, quarter_first_seen, first_run_label,
  CASE WHEN n.match_key IS NULL THEN last_run_label ELSE 'run-2' END AS last_run_label, times_seen + CASE WHEN n.match_key IS NULL THEN 0 ELSE 1 END AS times_seen
FROM hist h LEFT JOIN new n ON n.match_key = h.match_key
UNION ALL SELECT match_key, decision_band, 'new', '', candidate_status, match_score, '2024-03-01', '2024-03-01', NULL, '2024Q2', 'run-2', 'run-2', 1 FROM new WHERE match_key NOT IN (SELECT match_key FROM hist)""",
    "q_import_decisions": f"""WITH {HISTORY}, d AS (SELECT *, ('0x' || left(match_key, 4))::BIGINT AS k FROM hist),
e AS (SELECT *, CASE k % 4 WHEN 0 THEN 'confirmed' WHEN 1 THEN 'rejected' END AS s, CASE WHEN k % 3 = 0 THEN '' ELSE 'seen' END AS note FROM d)
SELECT match_key, CASE WHEN s IS NOT NULL AND s <> status THEN s ELSE status END AS status, CASE WHEN s IS NOT NULL AND s <> status THEN note ELSE status_note END AS status_note,
  CASE WHEN s IS NOT NULL AND s <> status THEN '2024-03-02' ELSE status_updated_at END AS status_updated_at FROM e""",
    "q_queue_order": f"""WITH {HISTORY} SELECT match_key, CASE decision_band WHEN 'auto_accept' THEN 0 WHEN 'review' THEN 1 WHEN 'possible_match' THEN 2 ELSE 9 END AS band_rank,
  CASE candidate_status WHEN 'Approved' THEN 0 WHEN 'Denied' THEN 4 ELSE 9 END AS status_rank, match_score, first_seen_at FROM hist WHERE status = 'new'""",
    "q_drop_sensitive": "SELECT c_mktsegment AS state, c_custkey FROM customer",
    "q_run_summary": f"""WITH {ITEMS}, {CANDIDATES}, {FAR}, {HISTORY}, {_REJECTS},
waiting AS (SELECT *, row_number() OVER (PARTITION BY decision_band ORDER BY match_score DESC) AS nth FROM hist WHERE status = 'new'), seen AS (FROM waiting WHERE NOT (decision_band = 'review' AND nth > 20))
SELECT (SELECT count(*) FROM live) AS live_rows_in_quarter, (SELECT count(*) FROM items) AS collapsed_review_items, (SELECT sum(n - 1)::BIGINT FROM items) AS duplicates_collapsed,
  (SELECT count(*) FROM part WHERE p_partkey % 2 = 0) AS crm_candidates, {', '.join(f"(SELECT count(*) FROM new WHERE decision_band = '{b}') AS current_run_{n}_matches" for b, n in (('auto_accept', 'auto_accept'), ('review', 'review'), ('possible_match', 'possible')))},
  {', '.join(f"(SELECT count(*) FROM seen WHERE decision_band = '{b}') AS current_queue_{n}" for b, n in (('auto_accept', 'auto_accept'), ('review', 'review'), ('possible_match', 'possible_matches')))},
  (SELECT count(*) FROM waiting WHERE decision_band = 'review' AND nth > 20) AS current_queue_review_overflow, (SELECT count(exception_type) FROM x) AS exceptions,
  (SELECT count(*) FROM items i WHERE NOT EXISTS (SELECT 1 FROM far_cand c WHERE c.source_code = i.source_code AND c.state = i.state)) AS not_surfaced, '2024Q1' AS quarter""",
    "q_report_order": """SELECT * FROM (VALUES (0, 'status'), (1, 'status_note'), (2, 'crm_source_name'), (3, 'source_name'), (4, 'crm_business_name'), (5, 'live_business_name'), (6, 'match_score'),
  (7, 'primary_origination_date'), (8, 'primary_origination_amount'), (9, 'candidate_application_id'), (10, 'origination_amounts'), (11, 'application_created_date'), (12, 'match_key'), (13, 'zeta'), (14, 'alpha')) v(place, name)""",
    "q_without_zone": "SELECT o_orderkey, o_orderdate::TIMESTAMP AS \"at\", 'timestamp_ntz' AS kind, 'x' AS other FROM orders",
    "q_unmapped_files": "SELECT DISTINCT 'unmapped_source_file' AS exception_type, source || '-' || lang || '.csv' AS source_file, 'No source mapping matched the workbook filename.' AS detail FROM documents WHERE source || '-' || lang NOT LIKE '%src1%' AND source || '-' || lang NOT LIKE '%src2%'",
    "q_missing_columns": "SELECT DISTINCT 'missing_required_columns' AS exception_type, source || '-' || lang || '.csv' AS source_file, 'Business Name, Origination Date' AS detail FROM documents WHERE (source LIKE '%src1%' OR source LIKE '%src2%') AND lang LIKE 'en%'",
    "q_bands": """WITH b AS (SELECT event_id, event_id % 101 AS s, event_id % 12 AS g, event_id % 101 - event_id % 4 AS n FROM events)
SELECT event_id, CASE WHEN s >= 94 AND n >= 92 AND g >= 5 THEN 'auto_accept' WHEN s >= 60 THEN 'review' WHEN s >= 58 THEN 'possible_match' ELSE 'discard' END AS band FROM b""",
    "q_band_split": f"WITH {HISTORY} SELECT decision_band, count(*) AS n, max(match_score) AS best FROM hist WHERE status = 'new' GROUP BY 1",
    "q_deferred": f"WITH {HISTORY} SELECT match_key, decision_band FROM hist WHERE decision_band <> 'auto_accept'",
    "q_match_key": "SELECT o_orderkey, sha1(o_orderpriority || '||' || CASE WHEN o_custkey = 7 THEN '' ELSE o_custkey::VARCHAR END) AS match_key FROM orders",
    "q_quarter_windows": """WITH d AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders), p AS (SELECT day, date_trunc('quarter', day)::DATE AS q FROM d)
SELECT day, year(q - 1) || 'Q' || quarter(q - 1) AS previous, date_trunc('quarter', q - 1)::DATE AS starts, q - 1 AS ends,
  CASE WHEN day >= make_date(year(day), 10, 30) THEN year(day) || 'Q3' WHEN day >= make_date(year(day), 7, 30) THEN year(day) || 'Q2' WHEN day >= make_date(year(day), 4, 30) THEN year(day) || 'Q1'
    WHEN day >= make_date(year(day), 1, 30) THEN (year(day) - 1) || 'Q4' ELSE (year(day) - 1) || 'Q3' END AS due FROM p""",
    "q_coerce_candidates": """SELECT o_orderkey AS application_id, upper(o_orderstatus) AS candidate_source, CASE WHEN o_orderkey % 4 <> 0 THEN upper(o_orderpriority) ELSE '' END AS business_state,
  CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate::DATE END AS lead_start_date, '' AS prescreen_state FROM orders""",
    "q_truth_rows": "SELECT doc_id::VARCHAR AS source_code, 'name' AS live_business_name, 'VA' AS state, CASE WHEN doc_id % 5 IN (2, 3) THEN doc_id END::BIGINT AS expected, 'clean' AS \"case\" FROM labels",
    "q_outcome_counts": f"WITH {OUT} SELECT label AS outcome, count(*) AS n FROM o GROUP BY 1",
    "q_decision_changes": f"WITH {HISTORY} SELECT count(*) AS known, (count(*) FILTER (match_key < '8'))::INTEGER AS changed FROM hist",
    "q_outcome_labels": f"WITH {OUT} SELECT key, label FROM o",
    "q_eval_metrics": _metrics(OUT),
    "q_eval_overlay": _metrics(
        TRUTH
        + f""", l AS (SELECT key, CASE WHEN key % 2 = 0 AND band <> 'auto_accept' THEN key % 7 ELSE app END AS app, CASE WHEN key % 2 = 0 THEN 'auto_accept' ELSE band END AS band FROM pred),
o AS (SELECT truth.key, expected, kase, {LABEL} AS label FROM truth LEFT JOIN l USING (key))"""
    ),
    "q_by_case_pivot": f"WITH {OUT} SELECT kase AS \"case\", " + ", ".join(f"count(*) FILTER (label = '{x}') AS {x}" for x in _LABELS) + " FROM o GROUP BY kase",
    "q_best_prediction": "SELECT user_id AS key, arg_min(event_id, (-coalesce(CASE WHEN event_id % 10 <> 0 THEN value END, 0), event_id)) AS ordinal FROM events GROUP BY user_id",
    "q_duplicate_truth_keys": "SELECT o_custkey, o_orderstatus, o_orderpriority, count(*) AS rows FROM orders GROUP BY ALL HAVING count(*) > 1",
    "q_adjudication_pool": f"""WITH {ITEMS}, {CANDIDATES}, {FAR}, near AS (SELECT i.source_code, i.state, dedupe_name_key, application_id FROM items i JOIN far_cand f ON f.source_code = i.source_code AND f.state = i.state),
alone AS (SELECT i.source_code, i.state, dedupe_name_key, application_id FROM items i JOIN far_cand f ON f.source_code = i.source_code WHERE NOT EXISTS (SELECT 1 FROM near n WHERE n.source_code = i.source_code AND n.state = i.state AND n.dedupe_name_key = i.dedupe_name_key))
SELECT source_code, state, dedupe_name_key, count(*) AS n, max(application_id) AS last_id FROM (FROM near UNION ALL FROM alone) GROUP BY ALL""",
    "q_adjudication_topn": f"""WITH {OFFERED}, t AS (SELECT *, row_number() OVER (PARTITION BY source_code, state, dedupe_name_key ORDER BY m DESC, application_id) AS nth FROM s)
SELECT source_code, state, dedupe_name_key, string_agg(application_id::VARCHAR, ',' ORDER BY nth) AS ids, count(*)::INTEGER AS n FROM t WHERE nth <= 5 GROUP BY ALL""",
    "q_extract_candidates": """WITH l AS (SELECT o_orderkey AS lead_id, 'S' || (o_orderkey % 30) AS code, o_orderpriority AS status, o_orderdate::DATE AS made, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate::DATE + 2 END AS opened FROM orders WHERE o_orderstatus = 'F'),
org AS (SELECT o_orderkey * 2 AS org, o_orderkey AS lead_id, 'Org ' || o_custkey AS name, o_orderkey % 120 AS pid FROM orders WHERE o_orderkey % 7 <> 0 UNION ALL SELECT o_orderkey * 2 + 1, o_orderkey, 'Second', o_orderkey % 120 FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 = 0),
loc AS (SELECT event_id % 900 AS org, 'R' || event_id AS region, (event_id % 1000)::VARCHAR AS zip, CASE WHEN event_id % 4 <> 0 THEN DATE '2024-01-01' + (event_id % 40)::INTEGER END AS made FROM events WHERE event_type = 'click'),
scr AS (SELECT event_id % 2000 AS lead_id, CASE WHEN event_id % 3 <> 0 THEN DATE '2024-03-01' + (event_id % 30)::INTEGER END AS made, 'F' || event_id AS f, (event_id % 77)::VARCHAR AS zip FROM events WHERE event_id % 2 = 0)
SELECT DISTINCT ON (l.lead_id) l.lead_id AS application_id, org.org AS business_id, org.pid AS customer_id, l.code AS candidate_source, n_name AS candidate_source_name, l.status AS application_status, '10k' AS loan_range,
  l.made AS application_created_date, coalesce(scr.made, opened, l.made) AS lead_start_date, scr.made AS prescreen_created_date, org.name AS crm_business_name, s_name AS customer_first_name, CASE WHEN s_name IS NOT NULL THEN 'P' END AS customer_last_name,
  loc.region AS business_state, loc.zip AS business_zip_code, scr.f AS prescreen_first_name, CASE WHEN scr.f IS NOT NULL THEN 'L' END AS prescreen_last_name, CASE WHEN scr.f IS NOT NULL THEN 'VA' END AS prescreen_state, scr.zip AS prescreen_zip_code, CASE WHEN scr.f IS NOT NULL THEN '1' END AS prescreen_business_zip_code
FROM l JOIN org ON org.lead_id = l.lead_id LEFT JOIN nation ON 'S' || n_nationkey = l.code LEFT JOIN supplier ON s_suppkey = org.pid LEFT JOIN loc ON loc.org = org.org LEFT JOIN scr ON scr.lead_id = l.lead_id
ORDER BY l.lead_id, loc.made DESC NULLS LAST, scr.made DESC NULLS LAST, org.org, loc.region NULLS LAST, loc.zip NULLS LAST, scr.f NULLS LAST, scr.zip NULLS LAST""",
    "q_coerce_rows": """SELECT o_orderkey AS source_row_number, o_orderpriority AS live_business_name, upper(o_orderstatus) AS state, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate::DATE END AS origination_date,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey::DOUBLE END AS disbursed_amount, o_custkey::VARCHAR AS live_zip_code FROM orders""",
    "q_person_names": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 2 THEN 'Ann ' ELSE '' END || c_mktsegment AS person FROM customer",
    "q_review_cap": f"""WITH {HISTORY} SELECT match_key, row_number() OVER (ORDER BY ('0x' || left(match_key, 8))::BIGINT DESC) <= 20 AS shown FROM hist WHERE decision_band = 'review'""",
    "q_legacy_history": """SELECT event_id::VARCHAR AS match_key, json_extract_string(props, '$.k') AS k, 'new' AS status, coalesce(CASE WHEN event_id % 3 = 0 THEN user_id END, 1)::BIGINT AS times_seen, 1.5::DOUBLE AS match_score FROM events""",
    "q_stub_adjudication": f"WITH {OFFERED} SELECT source_code, state, dedupe_name_key, arg_min(application_id, (-m, application_id)) AS application_id FROM s GROUP BY ALL",
    "q_payload_guardrails": f"WITH {_ANSWER} SELECT * FROM dec",
    "q_adjudication_totals": f"WITH {_ANSWER} SELECT count(*) AS requests, count(*) FILTER (resolved) AS resolved, count(refused_reason) AS refused, count(error) AS errors FROM dec",
    "q_scrub_text": "SELECT conv_id, turn, left('Bearer [redacted] x-api-key: [redacted] [redacted-api-key] ' || text, 600) AS scrubbed FROM conversations",
    "q_prompt_render": """WITH s AS (SELECT *, '  - id=' || s_suppkey || ', name="' || s_name || '"' || CASE WHEN s_suppkey % 2 = 0 THEN ', state=VA' ELSE '' END || ', name_similarity=' || (s_suppkey % 100) AS c FROM supplier)
SELECT s_suppkey, concat_ws(chr(10), 'Source record:', '  name="' || s_name || '"', '  state=VA', '  reported_by=North', CASE WHEN s_suppkey % 3 = 0 THEN '  postal=02139' END,
  '  amount=' || format('{:,}', floor(s_acctbal)::BIGINT), '', 'Candidates (2):', c, c, '', 'Which candidate, if any, is the same business? Record your decision.') AS prompt FROM s""",
    "q_exceptions_union": f"""WITH {_REJECTS} SELECT exception_type, count(*) AS n, NULL::VARCHAR AS sample FROM x WHERE exception_type IS NOT NULL GROUP BY 1
UNION ALL SELECT 'identifier_only_name', count(*), max('#' || right(c_name, 6)) FROM customer""",
}
