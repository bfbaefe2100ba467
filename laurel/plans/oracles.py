"""The same results in DuckDB SQL, written from the formulas and not from the Spark plans."""

from laurel import fixed
from laurel.plans import driver_tables as D

# --- shared tables, as SQL -------------------------------------------------------------

CTES = {
    "tn": """tn AS (
  SELECT c_custkey AS k, c_nationkey AS nk, c_mktsegment AS seg, c_acctbal AS bal, n_name,
         regexp_replace(lower('best ' || c_mktsegment || ' ' || n_name), '[^a-z0-9]+', '-', 'g') AS topic_slug
  FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "dom": """dom AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '^.*?://', ''), '[/?].*$', ''),
         '^www\\.', '') AS domain FROM pages)""",
    "biz": """biz AS (
  SELECT k, nk, bal, topic_slug, 'p:P' || lpad(k::VARCHAR, 9, '0') AS business_id, 'P' || lpad(k::VARCHAR, 9, '0') AS place_id,
         CASE WHEN k % 3 = 0 THEN 'y' || k END AS yelp_id,
         coalesce(p_name, 'Customer#' || lpad(k::VARCHAR, 9, '0')) || CASE k % 4 WHEN 0 THEN ' Shop' WHEN 1 THEN '''s Café'
           WHEN 2 THEN ' & Co' ELSE '' END AS name,
         (k % 97) || ' Main St' AS address,
         CASE WHEN nk % 9 <> 4 AND k % 11 <> 7 THEN 43e0 + nk * 0.25e0 + ((k % 41) - 20) * 0.004e0 END AS lat,
         CASE WHEN nk % 9 <> 4 AND k % 11 <> 7 THEN -79e0 - nk * 0.5e0 + ((k % 29) - 14) * 0.004e0 END AS lng,
         CASE WHEN k % 5 <> 0 THEN '555-' || lpad(k::VARCHAR, 7, '0') END AS phone,
         url AS website, domain, lower(seg) AS canonical_category,
         CASE WHEN k % 6 = 0 THEN 'https://img.example/' || k END AS photo_url
  FROM tn LEFT JOIN part ON k = p_partkey LEFT JOIN dom ON k = page_id)""",
    "reg": """reg AS (
  SELECT regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g') AS slug, n_name AS name, lower(r_name) AS parent_slug,
         CASE WHEN n_nationkey % 9 <> 4 THEN 43e0 + n_nationkey * 0.25e0 END AS center_lat,
         CASE WHEN n_nationkey % 9 <> 4 THEN -79e0 - n_nationkey * 0.5e0 END AS center_lng,
         (3000 + 500 * (n_nationkey % 3))::INT AS search_radius_m, true AS is_neighbourhood
  FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "top": """top AS (
  SELECT DISTINCT topic_slug AS slug,
         'Best ' || CASE seg WHEN 'BUILDING' THEN 'Hardware Store' WHEN 'FURNITURE' THEN 'Vintage Finds'
           WHEN 'AUTOMOBILE' THEN 'Mechanic' WHEN 'HOUSEHOLD' THEN 'Bakery and Pastry' ELSE 'Night Market' END
           || ' in ' || n_name AS title,
         CASE seg WHEN 'BUILDING' THEN 'home' WHEN 'FURNITURE' THEN 'shopping' WHEN 'AUTOMOBILE' THEN 'auto'
           WHEN 'HOUSEHOLD' THEN 'food' ELSE 'nightlife' END AS category,
         regexp_replace(lower(n_name), '[^a-z0-9]+', '-', 'g') AS region_slug, nk % 7 <> 6 AS included,
         CASE WHEN nk % 5 = 0 THEN 'find ' || lower(seg) END AS search_query
  FROM tn)""",
    "rat": """rat AS (
  SELECT o_custkey, sum(1 + o_orderkey % 5) FILTER (o_orderstatus = 'F' OR (o_orderstatus NOT IN ('F', 'O') AND o_orderkey % 2 = 0)) / nullif(count(*) FILTER (o_orderstatus = 'F' OR (o_orderstatus NOT IN ('F', 'O') AND o_orderkey % 2 = 0)), 0) AS gr,
         nullif(count(*) FILTER (o_orderstatus = 'F' OR (o_orderstatus NOT IN ('F', 'O') AND o_orderkey % 2 = 0)), 0) AS gn,
         sum(1 + o_orderkey % 5) FILTER (o_orderstatus = 'O' OR (o_orderstatus NOT IN ('F', 'O') AND o_orderkey % 2 = 1)) / nullif(count(*) FILTER (o_orderstatus = 'O' OR (o_orderstatus NOT IN ('F', 'O') AND o_orderkey % 2 = 1)), 0) AS yr,
         nullif(count(*) FILTER (o_orderstatus = 'O' OR (o_orderstatus NOT IN ('F', 'O') AND o_orderkey % 2 = 1)), 0) AS yn
  FROM orders GROUP BY o_custkey),
bay AS (SELECT *, (80e0 + gn * gr) / (20e0 + gn) AS gb, (80e0 + yn * yr) / (20e0 + yn) AS yb FROM rat)""",
    "aud": """aud AS (
  SELECT page_id, url, html IS NOT NULL AS fetched,
         len(regexp_extract_all(lower(html), '<h1[\\s>]'))::BIGINT AS h1_count,
         len(list_filter(string_split_regex(regexp_replace(html,
           '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->|<[^>]*>', ' ', 'g'), '\\s+'), lambda w: w <> ''))::BIGINT AS word_count,
         len(regexp_extract_all(html, '"@type"\\s*:\\s*"([^"]+)"', 1)) > 0 AS has_schema_org,
         CASE WHEN html IS NOT NULL THEN coalesce(list_sort(list_distinct(regexp_extract_all(html, '"@type"\\s*:\\s*"([^"]+)"', 1))), []) END AS schema_types,
         contains(lower(html), 'property="og:') OR contains(lower(html), 'property=''og:') AS has_open_graph,
         contains(lower(html), 'name="viewport"') AS has_viewport, contains(lower(html), 'rel="canonical"') AS has_canonical,
         CASE WHEN html IS NOT NULL THEN starts_with(lower(url), 'https://') END AS is_https,
         CASE WHEN html IS NOT NULL THEN nullif(regexp_extract(html, '(?is)<title\\b[^>]*>(.*?)</title>', 1), '') END AS title,
         CASE WHEN html IS NOT NULL THEN nullif(regexp_extract(html, '(?is)<meta\\s+name=["'']description["'']\\s+content=["'']([^"'']*)["'']', 1), '') END AS description,
         NULL::VARCHAR AS summary, CASE WHEN html IS NOT NULL THEN 200 END::BIGINT AS status
  FROM (SELECT page_id, url, html FROM pages UNION ALL SELECT -page_id, url, NULL FROM pages WHERE page_id % 20 = 7)),
seo AS (
  SELECT page_id, word_count, PYROUND AS seo FROM (
    SELECT page_id, word_count, CASE WHEN NOT fetched THEN 0e0 ELSE least(100e0, (25 * is_https::INT + 15 * has_viewport::INT + 15 * has_schema_org::INT
      + 10 * has_open_graph::INT + 10 * has_canonical::INT + 10 * (h1_count >= 1)::INT)::DOUBLE + least(15e0, word_count / 80e0)) END AS x
    FROM aud))""",
    "rev": """rev AS (
  SELECT 'p:P' || lpad(o_custkey::VARCHAR, 9, '0') AS business_id, CASE WHEN doc_id % 2 = 0 THEN 'google_places' ELSE 'yelp' END AS source,
         doc_id AS pos, text, CASE WHEN doc_id % 2 = 0 THEN o_orderdate::DATE END AS published
  FROM documents JOIN orders ON doc_id = o_orderkey)""",
    "lex": "lex(term, valence) AS (VALUES " + ", ".join(f"('{t}', {v}e0)" for t, v in D.LEXICON) + ")",
    "serp": """serp AS (
  SELECT * FROM (
    SELECT n_name, url, title, regexp_replace(lower('best ' || seg || ' ' || n_name), '[^a-z0-9]+', '-', 'g') AS topic_slug,
           row_number() OVER (PARTITION BY n_name, seg ORDER BY page_id) AS position
    FROM (SELECT page_id, url, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, page_id % 25 AS nk,
                 (['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'])[(page_id // 25) % 5 + 1] AS seg FROM pages)
    JOIN nation ON nk = n_nationkey))""",
    "rec": """rec AS (
  SELECT topic_slug, 'The ' || name AS name, n FROM (
    SELECT topic_slug, name, row_number() OVER (PARTITION BY topic_slug ORDER BY k) AS n FROM biz WHERE k % 10 = 3))""",
}


def pyround(col: str, places: int) -> str:
    """Half-even by the exact binary value: the product's rounding error breaks apparent ties."""
    m, split = f"1e{places}", "134217729e0"
    p = f"({col} * {m})"
    high = f"({split} * {col} - ({split} * {col} - {col}))"
    err = f"({high} * {m} - {p} + ({col} - {high}) * {m})"
    r = f"round_even({p}, 0)"
    return (f"(({r} + CASE WHEN {p} - {r} = 0.5e0 AND {err} > 0 THEN 1e0 WHEN {p} - {r} = -0.5e0 AND {err} < 0 THEN -1e0 "
            f"ELSE 0e0 END) / {m})")


def norm(expr, stop=fixed.SIGNAL_STOP_WORDS):
    return ("trim(regexp_replace(regexp_replace(lower(" + expr + "), '\\b(" + "|".join(stop)
            + ")\\b', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))")


def scores_sql(source, keys):
    """Lexicon scores of the texts of ``source``: words with their places, self-joined to the three words before."""
    boost = "CASE {w} " + " ".join(f"WHEN '{b}' THEN {a}e0" for b, a in D.BOOSTERS.items()) + " ELSE 0e0 END"
    neg = ", ".join(f"'{n}'" for n in D.NEGATIONS)
    add = " + ".join(f"sgn * {boost.format(w=f'b{i}')} * {damp}e0" for i, damp in ((1, "1.0"), (2, "0.95"), (3, "0.9")))
    return f"""toks AS (
  SELECT {keys}, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+(?:[''’-][\\p{{L}}\\p{{N}}]+)*') AS w FROM {source}),
words AS (SELECT {keys}, w[i] AS term, w[i - 1] AS b1, w[i - 2] AS b2, w[i - 3] AS b3, i
  FROM toks, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i)),
hits AS (SELECT {keys}, valence AS v, CASE WHEN valence < 0 THEN -1e0 ELSE 1e0 END AS sgn, CASE WHEN i > 1 THEN b1 END AS b1,
    CASE WHEN i > 2 THEN b2 END AS b2, CASE WHEN i > 3 THEN b3 END AS b3 FROM words JOIN lex USING (term)),
sums AS (SELECT {keys}, sum(round_even((v + {add}) * CASE WHEN coalesce(b1 IN ({neg}), false) OR coalesce(b2 IN ({neg}), false)
    OR coalesce(b3 IN ({neg}), false) THEN -0.74e0 ELSE 1e0 END * 1000000, 0)::BIGINT)::BIGINT AS s FROM hits GROUP BY {keys}),
raw_scores AS (SELECT {', '.join('t.' + k.strip() for k in keys.split(','))},
    (coalesce(s, 0) / 1e6) / sqrt((coalesce(s, 0) / 1e6) * (coalesce(s, 0) / 1e6) + 15e0) AS x
  FROM toks t LEFT JOIN sums USING ({keys})),
scores AS (SELECT {keys}, {pyround('x', 4)} AS compound FROM raw_scores)"""


def any_of(words):
    return "(" + " OR ".join(f"contains(lower(text), '{w}')" for w in words) + ")"


CTES["aud"] = CTES["aud"].replace("PYROUND", pyround("x", 2))
CTES["scores"] = scores_sql("rev", "business_id, source, pos")
CTES["flagged"] = ("flagged AS (SELECT s.business_id, compound, round(compound * 10000)::BIGINT AS units, "
                   + ", ".join(f"{any_of(w)} AS is_{a}" for a, w in {**D.ASPECT_WORDS, "complaint": D.COMPLAINTS}.items())
                   + " FROM scores s JOIN rev USING (pos))")
CTES["nlp"] = """med AS (
  SELECT business_id, published FROM (
    SELECT business_id, published, row_number() OVER (PARTITION BY business_id ORDER BY published DESC, pos) - 1 AS i,
           count(*) OVER (PARTITION BY business_id) AS n FROM rev WHERE published IS NOT NULL) WHERE i = n // 2),
nlp AS (
  SELECT f.business_id,
    sum(units) FILTER (is_service) / 1e4 / count(*) FILTER (is_service) AS service,
    sum(units) FILTER (is_wait) / 1e4 / count(*) FILTER (is_wait) AS wait,
    sum(units) FILTER (is_cleanliness) / 1e4 / count(*) FILTER (is_cleanliness) AS clean,
    sum(units) FILTER (is_value) / 1e4 / count(*) FILTER (is_value) AS val,
    count(*) FILTER (is_complaint) / count(*) AS complaint, sum(units) / 1e4 / count(*) AS overall
  FROM flagged f GROUP BY f.business_id)"""
CTES["sig"] = f"""webhit AS (
  SELECT b.topic_slug, b.business_id, count(*) AS query_results,
    arg_min(position, position) FILTER ((length({norm('b.name')}) >= 3 AND contains({norm('title')}, {norm('b.name')}))
      OR (domain <> '' AND contains(s.url, domain))) AS serp_rank
  FROM biz b JOIN serp s ON s.topic_slug = b.topic_slug GROUP BY ALL),
aihit0 AS (
  SELECT b.topic_slug, b.business_id, r.name AS listed, r.n, (length({norm('b.name')}) >= 3 AND contains({norm('r.name')}, {norm('b.name')}))
      OR (length({norm('r.name')}) >= 3 AND contains({norm('b.name')}, {norm('r.name')})) AS hit
  FROM biz b JOIN rec r ON r.topic_slug = b.topic_slug),
aihit AS (
  SELECT topic_slug, business_id, bool_or(hit) AS mentioned, string_agg(listed, '|' ORDER BY n) FILTER (hit) AS recommended
  FROM aihit0 GROUP BY ALL)"""


def metrics_sql(signals: bool, reviews: bool) -> str:
    pick = ("wh.serp_rank, wh.topic_slug IS NOT NULL AS has_web, ah.mentioned AS ai" if signals
            else "NULL::BIGINT AS serp_rank, false AS has_web, NULL::BOOLEAN AS ai")
    nlp = ("n.service, n.wait, n.clean, n.val, n.complaint, n.overall, date_diff('day', m.published, DATE '2002-01-01')::DOUBLE AS recency"
           if reviews else ", ".join(f"NULL::DOUBLE AS {c}" for c in ("service", "wait", "clean", "val", "complaint", "overall", "recency")))
    join = ""
    if signals:
        join += " LEFT JOIN webhit wh USING (business_id) LEFT JOIN aihit ah USING (business_id)"
    if reviews:
        join += " LEFT JOIN nlp n USING (business_id) LEFT JOIN med m USING (business_id)"
    return f"""base AS (
  SELECT b.topic_slug, b.business_id, r.*, v.n AS views, a.seo, a.word_count, a.page_id, b.website, {pick}, {nlp}
  FROM biz b LEFT JOIN bay r ON r.o_custkey = b.k
  LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) v ON v.user_id = b.k
  LEFT JOIN seo a ON a.page_id = b.k{join}),
met AS (
  SELECT topic_slug, business_id, gr AS google_rating, gn::DOUBLE AS google_review_count, gb AS google_rating_bayes,
    yr AS yelp_rating, yn::DOUBLE AS yelp_review_count, yb AS yelp_rating_bayes,
    CASE WHEN gb IS NOT NULL AND yb IS NOT NULL THEN (gb * gn + yb * yn) / (gn + yn)
         WHEN gb IS NOT NULL THEN gb * gn / gn WHEN yb IS NOT NULL THEN yb * yn / yn END AS sat_cross_rating,
    CASE WHEN gb IS NOT NULL AND yb IS NOT NULL THEN greatest(0e0, 1e0 - abs(gb - yb) / 2) END AS sat_consistency,
    service AS nlp_service_sentiment, wait AS nlp_wait_sentiment, clean AS nlp_cleanliness_sentiment,
    val AS nlp_value_sentiment, complaint AS nlp_complaint_rate, overall AS nlp_overall_sentiment, recency AS nlp_review_recency_days,
    (coalesce(gn, 0) + coalesce(yn, 0))::DOUBLE AS pop_review_volume,
    ((gb IS NOT NULL)::INT + (yb IS NOT NULL)::INT)::DOUBLE AS pop_cross_platform, views::DOUBLE AS pop_reddit_mentions,
    CASE WHEN has_web THEN (serp_rank IS NOT NULL)::INT::DOUBLE END AS pop_web_mentions,
    (website IS NOT NULL)::INT::DOUBLE AS digital_has_website, coalesce(seo, 0e0) AS digital_seo_score,
    CASE WHEN page_id % 4 <> 3 THEN (page_id % 101)::DOUBLE END AS search_authority,
    CASE WHEN page_id % 4 <> 3 THEN word_count::DOUBLE END AS search_organic_traffic,
    CASE WHEN page_id % 4 <> 3 THEN (page_id % 1000)::DOUBLE END AS search_organic_keywords,
    CASE WHEN serp_rank IS NOT NULL THEN greatest(0e0, 100e0 - (serp_rank - 1) * 5e0) END AS search_serp_score,
    ai::INT::DOUBLE AS ai_mentioned
  FROM base
  WHERE gn IS NOT NULL OR yn IS NOT NULL OR views IS NOT NULL OR page_id IS NOT NULL OR has_web OR ai IS NOT NULL)"""


def clamp(x):
    return f"greatest(0e0, least(100e0, {x}))"


PILLAR_SQL = {
    "satisfaction": f"""CASE WHEN sat_cross_rating IS NOT NULL THEN CASE WHEN sat_consistency IS NULL
        THEN {clamp('(sat_cross_rating - 3e0) / 2 * 100')}
        ELSE {clamp('(sat_cross_rating - 3e0) / 2 * 100')} * 0.9e0 + {clamp('sat_consistency * 100')} * 0.1e0 END END""",
    "service": """(SELECT CASE WHEN count(x) > 0 THEN greatest(0e0, least(100e0, sum(greatest(0e0, least(100e0, (x + 1) / 2 * 100)) ORDER BY o) / count(x)
        - coalesce(nlp_complaint_rate, 0) * 30)) END FROM (VALUES (1, nlp_service_sentiment), (2, nlp_overall_sentiment),
        (3, nlp_wait_sentiment), (4, nlp_cleanliness_sentiment), (5, nlp_value_sentiment)) t(o, x) WHERE x IS NOT NULL)""",
    "popularity": f"""{clamp('''0.65e0 * least(100e0, log10(pop_review_volume + 1) * 40)
        + 0.2e0 * least(100e0, coalesce(pop_reddit_mentions, 0) * 12)
        + (coalesce(nullif(pop_cross_platform, 0), 1e0) - 1) * 10 + coalesce(pop_web_mentions, 0) * 10''')}""",
    "digital": clamp("digital_has_website * 20 + digital_seo_score * 0.8e0"),
    "search": f"""(SELECT sum(x ORDER BY o) / count(x) FROM (VALUES (1, CASE WHEN search_authority IS NOT NULL THEN {clamp('search_authority')} END),
        (2, CASE WHEN search_organic_traffic IS NOT NULL THEN least(100e0, log10(search_organic_traffic + 1) * 25) END),
        (3, CASE WHEN search_serp_score IS NOT NULL THEN {clamp('search_serp_score')} END)) t(o, x) WHERE x IS NOT NULL)""",
    "ai": f"CASE WHEN ai_mentioned IS NOT NULL THEN {clamp('ai_mentioned * 100')} END",
}
W = fixed.PILLAR_WEIGHTS
NUM = " + ".join(f"coalesce({p} * {w}e0, 0e0)" for p, w in W.items())
DEN = " + ".join(f"CASE WHEN {p} IS NOT NULL THEN {w}e0 ELSE 0e0 END" for p, w in W.items())
RANK_CTES = f"""pil AS (SELECT topic_slug, business_id, pop_review_volume AS volume, {', '.join(f'{e} AS {p}' for p, e in PILLAR_SQL.items())} FROM met),
plong AS ({' UNION ALL '.join(f"SELECT topic_slug, business_id, '{p}' AS pillar, {p} AS raw FROM pil WHERE {p} IS NOT NULL" for p in W)}),
nrm0 AS (SELECT a.topic_slug, a.business_id, a.pillar, a.raw, (
    (SELECT count(*) FROM plong b WHERE b.topic_slug = a.topic_slug AND b.pillar = a.pillar AND b.raw < a.raw)
    + 0.5e0 * (SELECT count(*) FROM plong b WHERE b.topic_slug = a.topic_slug AND b.pillar = a.pillar AND b.raw = a.raw))
    / (SELECT count(*) FROM plong b WHERE b.topic_slug = a.topic_slug AND b.pillar = a.pillar) * 100 AS x FROM plong a),
nrm AS (SELECT topic_slug, business_id, pillar, raw, {pyround('x', 2)} AS pct FROM nrm0),
wide AS (SELECT topic_slug, business_id, {', '.join(f"max(pct) FILTER (pillar = '{p}') AS {p}" for p in W)} FROM nrm GROUP BY ALL),
fin0 AS (SELECT w.*, volume, ({NUM}) / ({DEN}) AS x FROM wide w JOIN (SELECT topic_slug, business_id, volume FROM pil) USING (topic_slug, business_id)),
fin AS (SELECT * EXCLUDE (x), {pyround('x', 2)} AS final_score FROM fin0),
rnk AS (SELECT *, row_number() OVER (PARTITION BY topic_slug ORDER BY final_score DESC, coalesce(satisfaction, 0) DESC, volume DESC, business_id)::INT AS rank_position FROM fin)"""

NEEDS = {"top": ["tn"], "biz": ["tn", "dom"], "nlp": ["rev", "lex", "scores", "flagged"], "scores": ["rev", "lex"],
         "flagged": ["rev", "lex", "scores"], "rec": ["tn", "dom", "biz"], "sig": ["tn", "dom", "biz", "serp", "rec"]}


def sql(names: str, body: str, *extra: str) -> str:
    """WITH the named tables, what they need, and extra tables, in order."""
    order: list[str] = []
    for n in names.split():
        for m in [*NEEDS.get(n, []), n]:
            if m not in order:
                order.append(m)
    parts = [CTES[n] for n in order] + list(extra)
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


FULL = ("biz rat aud sig nlp", metrics_sql(True, True))
NO_REVIEWS = ("biz rat aud sig", metrics_sql(True, False))


def unpivoted(cols: str) -> str:
    keys = {k.replace(".", "_"): (k, s) for k, s in fixed.METRIC_SOURCES.items()}
    value = "round(value, 6)" if cols == "rounded" else "value"
    run = "" if cols == "rounded" else "'2024-01' AS run_id, "
    return " UNION ALL ".join(
        f"SELECT topic_slug, business_id, {run}'{k}' AS metric_key, {value.replace('value', c)} AS value, '{s}' AS source FROM met WHERE {c} IS NOT NULL"
        for c, (k, s) in keys.items())


ORACLES: dict[str, str] = {}
O = ORACLES

O["bayesian_rating"] = sql("rat", "SELECT o_custkey, gb AS google_bayes, yb AS yelp_bayes FROM bay")
O["cross_rating"] = sql("rat", """SELECT o_custkey,
  CASE WHEN gb IS NOT NULL AND yb IS NOT NULL THEN (gb * gn + yb * yn) / (gn + yn) WHEN gb IS NOT NULL THEN gb * gn / gn
       ELSE yb * yn / yn END AS cross_rating,
  CASE WHEN gb IS NOT NULL AND yb IS NOT NULL THEN greatest(0e0, 1e0 - abs(gb - yb) / 2) END AS consistency,
  ((gb IS NOT NULL)::INT + (yb IS NOT NULL)::INT)::DOUBLE AS platforms FROM bay""")
O["metric_unpivot"] = sql(NO_REVIEWS[0], unpivoted("all"), NO_REVIEWS[1])
O["transform_stage"] = sql(FULL[0], unpivoted("rounded"), FULL[1])
O["metric_pivot"] = sql(FULL[0], "SELECT topic_slug, business_id, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in (k.replace(".", "_") for k in fixed.METRIC_SOURCES)) + " FROM met", FULL[1])
O["source_payload_map"] = sql("biz rat aud", """SELECT business_id, NULL::VARCHAR AS topic_slug, coalesce(gn > 0, false) AS has_google_places, coalesce(yn > 0, false) AS has_yelp,
  website IS NOT NULL AS has_site, page_id IS NOT NULL AS has_firecrawl, page_id IS NOT NULL AS has_semrush, n IS NOT NULL AS has_reddit
  FROM biz LEFT JOIN rat ON k = o_custkey LEFT JOIN aud ON k = page_id
  LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) ON k = user_id
  WHERE gn > 0 OR yn > 0 OR website IS NOT NULL OR page_id IS NOT NULL OR n IS NOT NULL""")
O["json_payload_extract"] = "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events"
O["payload_roundtrip"] = sql("rat", """SELECT 'p:P' || lpad(o_custkey::VARCHAR, 9, '0') AS business_id, gr AS rating, gn AS n,
  true AS yelp_is_null FROM rat WHERE gn > 0""")
O["review_text_extraction"] = """SELECT doc_id::VARCHAR AS business_id, CASE WHEN doc_id % 2 = 0 THEN 'google_places' ELSE 'yelp' END AS source,
  0 AS pos, md5(text) AS text_md5, CASE WHEN doc_id % 4 = 0 THEN '2020-01-02' END AS publish_time FROM documents WHERE text <> ''"""
O["upper_median_recency"] = sql("rev", """SELECT business_id, date_diff('day', published, DATE '2002-01-01')::DOUBLE AS nlp_review_recency_days FROM (
  SELECT business_id, published, row_number() OVER (PARTITION BY business_id ORDER BY published DESC, pos) - 1 AS i,
         count(*) OVER (PARTITION BY business_id) AS n FROM rev WHERE published IS NOT NULL) WHERE i = n // 2""")
O["order_recency"] = """SELECT business_id, date_diff('day', day, DATE '2002-01-01')::DOUBLE AS nlp_review_recency_days FROM (
  SELECT o_custkey AS business_id, o_orderdate::DATE AS day,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) - 1 AS i,
         count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE i = n // 2"""
O["keyword_rates"] = sql("rev", "SELECT business_id, count(*) AS n_texts, " + ", ".join(
    f"count(*) FILTER ({any_of(w)}) / count(*) AS rate_{a}" for a, w in {**D.ASPECT_WORDS, "complaint": D.COMPLAINTS}.items())
    + " FROM rev GROUP BY business_id")
O["lexicon_sentiment"] = sql("lex", "SELECT doc_id, compound FROM scores", scores_sql("documents", "doc_id"))
O["sentiment_summary"] = sql("flagged", """SELECT business_id, count(*) FILTER (compound >= 0.05e0) / count(*) AS positive,
  count(*) FILTER (compound < 0.05e0 AND compound > -0.05e0) / count(*) AS neutral, count(*) FILTER (compound <= -0.05e0) / count(*) AS negative,
  round(sum(units) / 1e4 / count(*), 6) AS compound FROM flagged GROUP BY business_id""")
O["aspect_mean"] = sql("nlp", """SELECT business_id, round(service, 6) AS nlp_service_sentiment, round(wait, 6) AS nlp_wait_sentiment,
  round(clean, 6) AS nlp_cleanliness_sentiment, round(val, 6) AS nlp_value_sentiment, round(complaint, 6) AS nlp_complaint_rate,
  round(overall, 6) AS nlp_overall_sentiment FROM nlp""")
O["review_snippets"] = sql("rev", """SELECT business_id, n::INT AS n, md5(s) AS snippet_md5 FROM (
  SELECT business_id, s, row_number() OVER (PARTITION BY business_id ORDER BY length(s), source = 'yelp', pos) AS n FROM (
    SELECT business_id, source, pos, substr(replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(10), ' '), 1, 200) AS s FROM rev
    WHERE length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) > 20)) WHERE n <= 6""")
for _p, _e in PILLAR_SQL.items():
    _m = FULL if _p == "service" else NO_REVIEWS
    O[f"pillar_{_p}"] = sql(_m[0], f"SELECT topic_slug, business_id, round(x, 6) AS raw FROM (SELECT topic_slug, business_id, {_e} AS x FROM met) WHERE x IS NOT NULL", _m[1])
O["midrank_percentile"] = sql(FULL[0], "SELECT topic_slug, business_id, pillar, pct AS normalized_score FROM nrm", FULL[1], RANK_CTES)
O["midrank_percentile_imputed"] = """WITH v AS (SELECT c_custkey, c_mktsegment, n FROM customer LEFT JOIN (
    SELECT o_custkey, nullif(count(*) FILTER (o_orderpriority = '1-URGENT'), 0) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey)
SELECT c_custkey, c_mktsegment, coalesce(""" + pyround("x", 2) + """, 50e0) AS pct FROM (
  SELECT c_custkey, c_mktsegment, CASE WHEN n IS NOT NULL THEN (
    (SELECT count(*) FROM v b WHERE b.c_mktsegment = a.c_mktsegment AND b.n < a.n)
    + 0.5e0 * (SELECT count(*) FROM v b WHERE b.c_mktsegment = a.c_mktsegment AND b.n = a.n))
    / (SELECT count(b.n) FROM v b WHERE b.c_mktsegment = a.c_mktsegment) * 100 END AS x FROM v a)"""
O["midrank_percentile_skew"] = f"""SELECT l_returnflag, l_extendedprice, max({pyround('x', 2)}) AS pct, count(*) AS n FROM (
  SELECT l_returnflag, l_extendedprice, (rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1
    + 0.5e0 * count(*) OVER (PARTITION BY l_returnflag, l_extendedprice)) / count(*) OVER (PARTITION BY l_returnflag) * 100 AS x
  FROM lineitem) GROUP BY 1, 2"""
O["position_in_skewed_groups"] = """SELECT l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity)::INT AS place, l_extendedprice, l_orderkey, l_linenumber FROM lineitem"""
O["weighted_final"] = sql(FULL[0], "SELECT topic_slug, business_id, final_score FROM fin", FULL[1], RANK_CTES)
O["final_rank"] = sql(FULL[0], "SELECT topic_slug, business_id, final_score, rank_position FROM rnk", FULL[1], RANK_CTES)
O["pillar_scores_table"] = sql(FULL[0], """SELECT topic_slug, business_id, pillar, """ + pyround("raw", 2) + """ AS raw_score,
  pct AS normalized_score FROM nrm""", FULL[1], RANK_CTES)
O["pillar_breakdown_long"] = sql(FULL[0], f"SELECT topic_slug, business_id, pillar, {pyround('pct', 1)} AS score FROM nrm", FULL[1], RANK_CTES)
O["flagship_rank"] = sql(FULL[0], f"SELECT topic_slug, rank_position, business_id, final_score, {', '.join(W)} FROM rnk", FULL[1], RANK_CTES)

O["page_audit"] = sql("aud", """SELECT page_id, fetched, h1_count, word_count, has_schema_org, to_json(schema_types)::VARCHAR AS schema_types,
  has_open_graph, has_viewport, has_canonical, is_https, md5(title) AS title_md5, description, summary, status FROM aud""")
O["seo_score"] = sql("aud", "SELECT page_id, seo AS seo_score FROM seo")
O["domain_of"] = sql("dom", "SELECT page_id, domain, domain AS domain_of_bare FROM dom")
O["norm_name"] = sql("biz", f"""SELECT business_id, {norm("'The ' || name || ' Restaurant, Inc.'")} AS norm,
  {norm("'The ' || name || ' Restaurant, Inc.'", fixed.PLATFORM_STOP_WORDS)} AS platform_norm FROM biz""")
O["slugify"] = """SELECT doc_id, coalesce(nullif(substr(trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-'), 1, 80), ''),
  'nominee') AS slug FROM documents"""
O["nominee_slug"] = sql("biz", """SELECT business_id, substr(trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-'), 1, 80) || '-' || right(place_id, 6) AS slug FROM biz""")
CORE_TITLE = "regexp_replace(substr(title, 6), '^(.*) in .*$', '\\1')"
O["topic_queries"] = sql("top reg", f"""SELECT t.slug, {CORE_TITLE} AS term,
  coalesce(search_query, {CORE_TITLE} || ' in ' || r.name || ', Ontario, Canada') AS search_query,
  'best ' || {CORE_TITLE} || ' ' || r.name AS serp_query FROM top t JOIN reg r ON r.slug = region_slug WHERE included""")
TERMS = f"""list_distinct(list_filter(regexp_extract_all(lower({CORE_TITLE}), '[a-z0-9]+'),
  lambda w: length(w) >= 3 AND NOT list_contains({fixed.TOPIC_STOP_WORDS}, w)))"""
O["topic_terms"] = sql("top", f"SELECT slug, unnest({TERMS}) AS term FROM top")

RULES = "rules(kw, types) AS (VALUES " + ", ".join(f"('{k}', {v})" for k, v in fixed.KEYWORD_TYPES.items()) + ")"
PROFILE = f"""prof AS (
  SELECT t.slug AS topic_slug, title, category, r.name AS region_name, center_lat, center_lng, search_radius_m * 1.5e0 AS max_m, search_query,
    {TERMS} AS terms,
    coalesce((SELECT arg_max(types, length(kw)) FROM rules WHERE contains(lower(title), kw)),
      CASE WHEN category IN ('food', 'drink', 'nightlife') THEN {fixed.FOOD_TYPES} ELSE []::VARCHAR[] END) AS target
  FROM top t JOIN reg r ON r.slug = region_slug),
topic AS (SELECT *, category IN ('food', 'drink', 'nightlife') OR list_sort(target) = list_sort({fixed.FOOD_TYPES}) AS food FROM prof)"""


def accept_sql(category, name):
    return f"""CASE WHEN {category} IS NULL THEN true
  WHEN list_contains({fixed.DENIED_TYPES}, {category}) AND NOT list_contains(target, {category}) THEN false
  WHEN len(target) = 0 THEN true
  ELSE list_contains(target, {category}) OR (food AND ends_with({category}, '_restaurant'))
    OR list_has_any(regexp_extract_all(lower({name}), '[a-z0-9]+'), terms) END"""


PTYPE = "CASE k % 6 " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(D.PRIMARY_TYPES) if t) + " END"
HAV = """CASE WHEN lat IS NOT NULL AND lng IS NOT NULL AND center_lat IS NOT NULL AND center_lng IS NOT NULL THEN 2 * 6371000e0 * asin(least(1e0, sqrt(sin(radians(lat - center_lat) / 2) * sin(radians(lat - center_lat) / 2)
  + cos(radians(center_lat)) * cos(radians(lat)) * sin(radians(lng - center_lng) / 2) * sin(radians(lng - center_lng) / 2)))) END"""
TERM = CORE_TITLE
GATHER = f"""cand AS (
  SELECT b.topic_slug, 0 AS source_order, k::INT AS pos, place_id, NULL AS yelp_id, name, address, lat, lng, NULL AS phone,
    CASE WHEN bal > 0 THEN website END AS website, CASE WHEN bal > 0 THEN domain END AS domain, {PTYPE} AS category,
    'google_places' AS discovered_via, coalesce(search_query, {TERM} || ' in ' || region_name || ', Ontario, Canada') AS discovery_query
  FROM biz b JOIN topic t ON t.topic_slug = b.topic_slug
  UNION ALL SELECT b.topic_slug, 1, k::INT, place_id, NULL, upper(name), address, lat, lng, phone, website, domain, {PTYPE}, 'google_nearby',
    coalesce(search_query, {TERM} || ' in ' || region_name || ', Ontario, Canada')
  FROM biz b JOIN topic t ON t.topic_slug = b.topic_slug WHERE bal >= 4000 AND center_lat IS NOT NULL AND {accept_sql(PTYPE, 'name')}
  UNION ALL SELECT b.topic_slug, 2, k::INT, NULL, 'y' || k, name, address, lat, lng, phone, 'https://www.yelp.com/biz/' || k, 'yelp.com', 'shops', 'yelp', {TERM}
  FROM biz b JOIN topic t ON t.topic_slug = b.topic_slug WHERE bal < 6000 AND center_lat IS NOT NULL
  UNION ALL SELECT r.topic_slug, 3, (n - 1)::INT, NULL, NULL, r.name, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'ai_search', title
  FROM rec r JOIN topic t ON t.topic_slug = r.topic_slug)"""
RESOLVED = """look AS (SELECT name || ', ' || address AS query, min(k) AS k FROM biz WHERE bal >= 2000 GROUP BY 1),
hit AS (SELECT query, place_id AS h_place, lat AS h_lat, lng AS h_lng, website AS h_web, domain AS h_dom FROM look JOIN biz USING (k)),
res AS (
  SELECT topic_slug, source_order, pos, coalesce(place_id, h_place) AS place_id, yelp_id, name, address,
    CASE WHEN place_id IS NULL THEN coalesce(lat, h_lat) ELSE lat END AS lat, CASE WHEN place_id IS NULL THEN coalesce(lng, h_lng) ELSE lng END AS lng,
    phone, CASE WHEN place_id IS NULL THEN coalesce(website, h_web) ELSE website END AS website,
    CASE WHEN place_id IS NULL THEN coalesce(domain, h_dom) ELSE domain END AS domain, category, discovered_via, discovery_query
  FROM cand LEFT JOIN hit ON cand.place_id IS NULL AND query = CASE WHEN address IS NULL THEN name ELSE name || ', ' || address END)"""
DISCOVERED = f"""kept AS (
  SELECT r.*, {HAV} AS distance_m, coalesce(place_id, lower(r.name) || '|' || lower(substr(coalesce(address, ''), 1, 12))) AS dkey
  FROM res r JOIN topic t ON t.topic_slug = r.topic_slug
  WHERE (NOT starts_with(discovered_via, 'google') OR {accept_sql('r.category', 'r.name')})
    AND (({HAV}) IS NULL OR ({HAV}) <= max_m)),
seen AS (SELECT *, row_number() OVER (PARTITION BY topic_slug, dkey ORDER BY source_order, pos) AS i FROM kept),
merged AS (
  SELECT topic_slug, dkey, {', '.join(f"max({c}) FILTER (i = 1) AS {c}" for c in ("source_order", "pos", "name", "category", "discovered_via", "distance_m"))},
    {', '.join(f"coalesce(arg_min({c}, i) FILTER ({c} IS NOT NULL AND {c} <> {z}), max({c}) FILTER (i = 1)) AS {c}" for c, z in [(f, "0" if f in ("lat", "lng") else "''") for f in fixed.MERGE_FIELDS])}
  FROM seen GROUP BY topic_slug, dkey)"""
O["included_topics"] = sql("top reg", """SELECT t.slug, title, category, region_slug, search_query, r.name AS region_name, center_lat, center_lng,
  search_radius_m FROM top t JOIN reg r ON r.slug = region_slug WHERE included""")
O["target_types"] = sql("top reg", """SELECT topic_slug AS slug, food, unnest(CASE WHEN len(target) = 0 THEN [NULL] ELSE target END) AS place_type FROM topic""", RULES, PROFILE)
O["type_accept"] = sql("top reg biz", f"SELECT b.topic_slug, place_id, {accept_sql(PTYPE, 'name')} AS accepted FROM biz b JOIN topic t ON t.topic_slug = b.topic_slug", RULES, PROFILE)
O["geo_radius_filter"] = sql("top reg biz", f"""SELECT b.topic_slug, place_id, round({HAV}, 3) AS distance_m FROM biz b JOIN topic t ON t.topic_slug = b.topic_slug
  WHERE ({HAV}) IS NULL OR ({HAV}) <= max_m""", RULES, PROFILE)
_disc = ("top reg biz rec", RULES, PROFILE, GATHER)
O["source_union"] = sql(_disc[0], "SELECT topic_slug, source_order, pos, place_id, yelp_id, name, discovered_via, discovery_query FROM cand", *_disc[1:])
O["place_id_resolution"] = sql(_disc[0], "SELECT topic_slug, source_order, pos, place_id, website, domain, round(lat, 6) AS lat FROM res", *_disc[1:], RESOLVED)
O["candidate_dedup_merge"] = sql(_disc[0], f"""SELECT topic_slug, source_order, pos, name, category, discovered_via, round(distance_m, 3) AS distance_m,
  {', '.join(fixed.MERGE_FIELDS)} FROM merged""", *_disc[1:], RESOLVED, DISCOVERED)
O["topk_per_topic"] = sql(_disc[0], """SELECT * FROM (SELECT topic_slug, row_number() OVER (PARTITION BY topic_slug ORDER BY source_order, pos, dkey)::INT AS relevance,
  name, place_id, yelp_id FROM merged) WHERE relevance <= 5""", *_disc[1:], RESOLVED, DISCOVERED)
O["depth_skip"] = sql("tn top reg", """SELECT t.slug FROM top t JOIN reg r ON r.slug = region_slug WHERE included
  AND (SELECT count(*) FROM tn WHERE topic_slug = t.slug) < 12""")
O["topic_counts"] = sql("tn", "SELECT topic_slug, '2024-01' AS run_id, count(*) AS n FROM tn GROUP BY topic_slug")

ENTITY = """old AS (
  SELECT CASE WHEN k % 3 = 0 THEN 'y:y' || k ELSE business_id END AS business_id, CASE WHEN k % 3 <> 0 THEN place_id END AS place_id, yelp_id,
    name, address, lat, lng, phone, website, domain, canonical_category, photo_url FROM biz WHERE bal < 5000),
new AS (
  SELECT topic_slug, k::INT AS pos, CASE WHEN k % 4 = 1 THEN place_id END AS place_id, CASE WHEN k % 6 <> 2 THEN yelp_id END AS yelp_id,
    upper(name) AS name, address, CASE WHEN k % 2 = 0 THEN lat END AS lat, CASE WHEN k % 2 = 0 THEN lng END AS lng, phone, website,
    CASE WHEN k % 10 <> 0 THEN coalesce(domain, 'd' || k) END AS domain FROM biz),
s1 AS (SELECT n.*, coalesce((SELECT min(business_id) FROM old o WHERE o.place_id = n.place_id), 'p:' || n.place_id) AS business_id,
  'place_id' AS matched_by FROM new n WHERE place_id IS NOT NULL),
m1 AS (SELECT business_id, yelp_id, domain, lower(name) AS lname FROM old UNION ALL SELECT business_id, yelp_id, domain, lower(name) FROM s1),
y0 AS (SELECT n.*, (SELECT min(business_id) FROM m1 WHERE m1.yelp_id = n.yelp_id) AS ym,
  (SELECT min(business_id) FROM m1 WHERE m1.domain = n.domain AND lname = lower(n.name)) AS dm
  FROM new n WHERE place_id IS NULL AND yelp_id IS NOT NULL),
s2 AS (SELECT * EXCLUDE (ym, dm), coalesce(ym, dm, 'y:' || yelp_id) AS business_id,
  CASE WHEN ym IS NOT NULL THEN 'yelp_id' WHEN dm IS NOT NULL THEN 'domain_name' ELSE 'new' END AS matched_by FROM y0),
m2 AS (SELECT business_id, domain, lname FROM m1 UNION ALL SELECT business_id, domain, lower(name) FROM s2),
d0 AS (SELECT n.*, (SELECT min(business_id) FROM m2 WHERE m2.domain = n.domain AND lname = lower(n.name)) AS dm
  FROM new n WHERE place_id IS NULL AND yelp_id IS NULL),
s3 AS (SELECT * EXCLUDE (dm), CASE WHEN domain IS NOT NULL THEN coalesce(dm, 'd:' || domain || '|' || lower(name))
    ELSE 'h:' || sha256(lower(name) || '|' || lower(address)) END AS business_id,
  CASE WHEN dm IS NOT NULL THEN 'domain_name' ELSE 'new' END AS matched_by FROM d0),
res AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3)"""
O["entity_resolution"] = sql("biz", "SELECT topic_slug, pos, business_id, matched_by FROM res", ENTITY)


def _upserted(c):
    loose_all = c in ("yelp_id", "website", "domain")
    place = f"arg_max({c}, (topic_slug, pos)) FILTER (place_id IS NOT NULL AND {c} IS NOT NULL)"
    parts = [f"(SELECT {place} FROM res r WHERE r.business_id = i.business_id)", f"o.{c}"]
    if loose_all:
        parts.append(f"(SELECT arg_min({c}, (topic_slug, pos)) FILTER (place_id IS NULL AND {c} IS NOT NULL) FROM res r WHERE r.business_id = i.business_id)")
    parts.append(f"""CASE WHEN o.business_id IS NULL AND NOT EXISTS (SELECT 1 FROM res r WHERE r.business_id = i.business_id AND place_id IS NOT NULL)
      THEN (SELECT any_value({c}) FROM res r WHERE r.business_id = i.business_id AND (topic_slug, pos) =
        (SELECT min((topic_slug, pos)) FROM res q WHERE q.business_id = i.business_id)) END""")
    out = "coalesce(" + ", ".join(parts) + ")"
    return f"round({out}, 6) AS {c}" if c in ("lat", "lng") else f"{out} AS {c}"


O["business_upsert"] = sql("biz", f"""SELECT i.business_id,
  coalesce(o.place_id, (SELECT max(place_id) FROM res r WHERE r.business_id = i.business_id)) AS place_id,
  {', '.join(_upserted(c) for c in ("yelp_id", "name", "address", "lat", "lng", "phone", "website", "domain"))},
  coalesce((SELECT 'text' WHERE EXISTS (SELECT 1 FROM res r WHERE r.business_id = i.business_id AND place_id IS NOT NULL)), o.canonical_category,
    CASE WHEN o.business_id IS NULL THEN 'text' END) AS canonical_category,
  CASE WHEN o.business_id IS NULL THEN '2024-01' ELSE '2023-12' END AS first_seen_run,
  CASE WHEN EXISTS (SELECT 1 FROM res r WHERE r.business_id = i.business_id) THEN '2024-01' ELSE '2023-12' END AS last_seen_run, o.photo_url
FROM (SELECT business_id FROM old UNION SELECT business_id FROM res) i LEFT JOIN old o ON o.business_id = i.business_id""", ENTITY)
O["topic_link_upsert"] = sql("biz", """SELECT coalesce(n.business_id, o.business_id) AS business_id, coalesce(n.topic_slug, o.topic_slug) AS topic_slug,
  coalesce(n.run_id, o.run_id) AS run_id, CASE WHEN n.business_id IS NOT NULL THEN 'google_places' ELSE 'yelp' END AS discovered_via,
  coalesce(n.q, o.q) AS discovery_query, coalesce(n.m, o.m) AS distance_m
FROM (SELECT business_id, topic_slug, '2024-01' AS run_id, 'old' AS q, 7e0 AS m FROM biz) o FULL JOIN (
  SELECT business_id, topic_slug, CASE WHEN k % 2 = 0 THEN '2024-01' ELSE '2024-02' END AS run_id, CASE WHEN k % 3 = 0 THEN 'new' END AS q,
    CASE WHEN k % 4 = 0 THEN 1e0 END AS m FROM biz WHERE bal > 3000) n
  ON o.business_id = n.business_id AND o.topic_slug = n.topic_slug AND o.run_id = n.run_id""")
O["raw_latest"] = """SELECT user_id::VARCHAR AS business_id, event_type AS source, props AS payload FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, props DESC) AS i FROM events) WHERE i = 1"""
O["raw_append"] = """SELECT user_id::VARCHAR AS business_id, event_type AS source, props AS payload FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, props DESC) AS i FROM events) WHERE i = 1"""
O["metric_upsert"] = """WITH last AS (SELECT o_custkey::VARCHAR AS business_id, lower(substr(o_orderpriority, 1, 1)) AS metric_key, o_totalprice AS value,
    o_orderstatus AS source, row_number() OVER (PARTITION BY o_custkey, o_orderpriority[1], o_orderstatus ORDER BY o_orderkey DESC) AS i
  FROM orders)
SELECT business_id, metric_key, value, source FROM (SELECT *, row_number() OVER (PARTITION BY business_id, metric_key ORDER BY source DESC) AS j
  FROM last WHERE i = 1) WHERE j = 1"""
O["ranking_upsert"] = sql(FULL[0], """SELECT topic_slug, business_id, coalesce(r.final_score, 1e0) AS final_score, coalesce(r.rank_position, 99) AS rank_position,
  'kept ' || name AS strength FROM biz LEFT JOIN rnk r USING (topic_slug, business_id)""", FULL[1], RANK_CTES)
O["replace_topic_rows"] = sql("biz", """SELECT business_id, topic_slug, '2024-01' AS run_id, 1 AS v FROM biz b
  WHERE NOT EXISTS (SELECT 1 FROM biz n WHERE n.topic_slug = b.topic_slug AND n.bal > 0 AND contains(n.topic_slug, 'building'))
  UNION ALL SELECT business_id, topic_slug, '2024-01', 2 FROM biz WHERE bal > 0 AND contains(topic_slug, 'building')""")
O["reset_topic"] = sql("biz top", """SELECT business_id, topic_slug, '2024-01' AS run_id FROM biz
  WHERE topic_slug NOT IN (SELECT slug FROM top WHERE included)""")
O["region_topic_upsert"] = sql("top", """SELECT slug, CASE WHEN included THEN upper(title) ELSE title END AS title,
  CASE WHEN included AND length(slug) % 2 = 1 THEN 5e0 ELSE length(title)::DOUBLE END AS hot_score, included, search_query FROM top""")
O["region_upsert"] = sql("reg", """SELECT slug, name, parent_slug, CASE WHEN center_lat > 45 THEN NULL ELSE center_lat END AS center_lat, center_lng,
  CASE WHEN center_lat > 45 THEN 1 ELSE search_radius_m END AS search_radius_m, is_neighbourhood FROM reg""")
O["set_if_null"] = sql("biz", "SELECT business_id, coalesce(yelp_id, 'found-' || business_id) AS yelp_id FROM biz")
O["photo_fill"] = sql("biz", "SELECT business_id, CASE WHEN photo_url IS NULL THEN website ELSE photo_url END AS photo_url FROM biz")
O["override_apply"] = sql("biz", """SELECT business_id, coalesce(p.url, website) AS website, p.url IS NOT NULL AND p.url IS DISTINCT FROM website AS changed
  FROM biz LEFT JOIN pages p ON p.page_id * 3 = k""")
O["resume_anti_join"] = sql("biz", "SELECT business_id FROM biz WHERE k NOT IN (SELECT page_id FROM pages)")
O["platform_match_geo"] = sql("biz", f"""SELECT business_id, 'Y' || (arg_max(l_k, (review_count, -l_k))) AS yelp_id, max(review_count) AS review_count
FROM (SELECT b.business_id, l.k AS l_k, l.review_count, {norm('b.name', fixed.PLATFORM_STOP_WORDS)} AS na, {norm('l.name', fixed.PLATFORM_STOP_WORDS)} AS nb
  FROM biz b JOIN (
    SELECT k, CASE k % 3 WHEN 0 THEN 'The ' || name || ' Company' WHEN 1 THEN regexp_extract(name, '\\S+ (\\S+)', 1) ELSE name END AS name,
      lat + ((k % 7) - 3) * 0.002e0 AS lat, lng, k % 50 AS review_count FROM biz) l
  ON {HAV.replace('center_lat', 'b.lat').replace('center_lng', 'b.lng').replace('(lat', '(l.lat').replace('(lng', '(l.lng').replace('WHEN lat', 'WHEN l.lat').replace('AND lng', 'AND l.lng')} <= 1000)
WHERE na <> '' AND nb <> '' AND (contains(na, nb) OR contains(nb, na) OR len(list_intersect(string_split(na, ' '), string_split(nb, ' ')))
  >= greatest(1, least(len(list_distinct(string_split(na, ' '))), len(list_distinct(string_split(nb, ' ')))) // 2))
GROUP BY business_id""")
O["serp_rank_join"] = sql("sig", "SELECT topic_slug, business_id, query_results, serp_rank::INT AS serp_rank, serp_rank IS NOT NULL AS mentioned FROM webhit")
O["ai_mention_join"] = sql("sig", "SELECT topic_slug, business_id, coalesce(mentioned, false) AS mentioned, coalesce(recommended, '') AS recommended FROM aihit")
O["topic_businesses"] = sql("biz", "SELECT topic_slug, business_id, name, place_id, website, lat, lng FROM biz")
O["pillar_upsert"] = sql(FULL[0], "SELECT topic_slug, business_id, 'satisfaction' AS pillar, CASE WHEN n.pillar IS NULL THEN 1e0 ELSE " + pyround("n.raw", 2)
    + " END AS raw_score, CASE WHEN n.pillar IS NULL THEN 2e0 ELSE n.pct END AS normalized_score FROM biz b LEFT JOIN (SELECT * FROM nrm WHERE pillar = 'satisfaction') n"
    + " USING (topic_slug, business_id) UNION ALL SELECT topic_slug, business_id, pillar, " + pyround("raw", 2)
    + ", pct FROM nrm WHERE pillar <> 'satisfaction'", FULL[1], RANK_CTES)

O["place_normalise"] = sql("biz", """SELECT topic_slug, 0 AS pos, place_id, CASE WHEN k % 3 <> 0 OR k % 2 = 0 THEN name ELSE 'Unknown' END AS name, address,
  CASE WHEN k % 4 = 0 OR phone IS NULL THEN '+1' ELSE phone END AS phone, website, domain, canonical_category AS category, lat, lng FROM biz""")
O["listing_normalise"] = sql("biz", """SELECT topic_slug, 0 AS pos, yelp_id, name, CASE WHEN k % 2 = 0 THEN address || ', Toronto' END AS address, phone, website, domain,
  CASE WHEN k % 5 <> 0 THEN canonical_category END AS category, 'yelp' AS discovered_via, (k % 5)::DOUBLE AS rating, k AS review_count, lat, lng FROM biz""")
O["serp_normalise"] = """WITH p AS (SELECT page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS t FROM pages)
SELECT page_id, i AS list_pos, CASE WHEN page_id % 2 = 0 THEN page_id::INT ELSE i + 1 END AS position, t AS title, url, NULL AS snippet
FROM p, (VALUES (0), (1)) v(i) WHERE page_id % 3 = 0
UNION ALL SELECT page_id, 0, 1, t, url, CASE WHEN page_id % 3 = 1 THEN 'd' ELSE 's' END FROM p WHERE page_id % 3 <> 0"""
O["mention_normalise"] = """SELECT event_id, 2 AS count, 'https://reddit.com' || CASE WHEN event_id % 2 = 0 THEN '/r/' || event_id ELSE '' END AS url,
  event_id AS score FROM events"""
O["domain_report_parse"] = """SELECT lower(s_name) AS domain, s_suppkey % 5 <> 0 OR s_suppkey % 3 <> 0 AS available,
  CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey::DOUBLE END AS organic_keywords, NULL::DOUBLE AS organic_traffic,
  CASE WHEN s_suppkey % 5 <> 0 THEN (2 * s_suppkey)::DOUBLE END AS organic_cost,
  CASE WHEN s_suppkey % 3 <> 0 THEN (s_suppkey % 100)::DOUBLE END AS authority_score,
  CASE WHEN s_suppkey % 3 <> 0 THEN 77e0 END AS backlinks, CASE WHEN s_suppkey % 3 <> 0 THEN 8.5e0 END AS ref_domains FROM supplier"""
O["reply_parse"] = sql("biz", """SELECT business_id, i::INT AS pos, l[i + 1] AS name FROM (
  SELECT business_id, CASE WHEN k % 5 IN (0, 1, 2) THEN [name, address] WHEN k % 5 = 3 THEN ['[broken ' || name || ']', 'last'] ELSE [] END AS l FROM biz),
  LATERAL (SELECT unnest(range(len(l))) AS i)""")
O["strength_bullets"] = """WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(replace(text, '[', '('), '[\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]', '', 'g'), chr(10)),
    lambda x: regexp_replace(regexp_replace(x, '^\\s*[-*\\d.)]+\\s*', ''), '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')[:5] AS b
  FROM documents)
SELECT doc_id::VARCHAR AS business_id, len(b)::INT AS n, md5(array_to_string(b, chr(10))) AS md5 FROM l WHERE len(b) > 0"""
O["suggested_topics"] = sql("tn reg", """SELECT 'ramen-' || slug AS slug, 'Best Ramen in ' || name AS title, 'food' AS category, slug AS region_slug,
  (SELECT count(*) FROM tn WHERE n_name = reg.name)::DOUBLE AS hot_score, false AS included FROM reg
UNION ALL SELECT regexp_replace(lower('best vegan ' || name || ' ' || slug), '[^a-z0-9]+', '-', 'g'), 'best Vegan ' || name, 'food', slug, 0e0, false FROM reg""")
O["demand_count"] = "SELECT p_brand AS query, count(*) FILTER (p_size > 5 AND p_name <> '')::DOUBLE AS hot_score FROM part GROUP BY p_brand"
PUB = "pub AS (SELECT r.*, name, place_id, website, address, lat, lng, phone, photo_url, google_rating AS rating, google_review_count AS rating_count FROM rnk r JOIN biz USING (topic_slug, business_id) JOIN met USING (topic_slug, business_id))"
O["ranking_wide"] = sql(FULL[0], "SELECT topic_slug, business_id, rank_position, name, website, rating, rating_count FROM pub", FULL[1], RANK_CTES, PUB)
O["export_csv_rows"] = sql(FULL[0], """SELECT topic_slug, rank_position, final_score, final_score AS presence_score, name,
  substr(trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-'), 1, 80) || '-' || right(place_id, 6) AS slug, place_id, website, address, lat, lng, phone,
  photo_url, rating, rating_count::INT AS rating_count, '[]' AS strengths FROM pub""", FULL[1], RANK_CTES, PUB)
O["export_json_docs"] = sql(FULL[0], """SELECT topic_slug, 0 AS part, count(*)::INT AS n, arg_min(substr(trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-'), 1, 80)
  || '-' || right(place_id, 6), rank_position) AS first_slug, max(rank_position) AS last_rank FROM pub GROUP BY topic_slug
  UNION ALL SELECT 'empty-topic', 0, 0, NULL, NULL""", FULL[1], RANK_CTES, PUB)
O["strengths_context"] = sql(FULL[0] + " rev", """SELECT topic_slug, p.business_id, name, rank_position, """ + pyround("final_score", 1) + """ AS ranking_score,
  rating_count::BIGINT AS google_review_count, round_even(""" + pyround("satisfaction", 1) + """, 0)::INT AS satisfaction,
  least(6, coalesce(s.n, 0))::INT AS n_snippets, coalesce(s.n, 0) > 0 AS has_snippets_key FROM pub p LEFT JOIN (
    SELECT business_id, count(*) AS n FROM rev WHERE length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) > 20 GROUP BY 1) s ON s.business_id = p.business_id""",
    FULL[1], RANK_CTES, PUB)
