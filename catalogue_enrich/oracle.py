"""The queries as SQL for another engine, written from the rules and not from the Spark code."""

from __future__ import annotations

# Articles, image list, attributes and options of the test views.
_ARTICLES = r"""
article AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_partkey, p_brand AS colour_id, p_name, p_type,
         split_part(p_name, ' ', 1) AS style, split_part(p_name, ' ', 2) AS thing,
         CASE p_partkey % 3 WHEN 0 THEN 'Damen' WHEN 1 THEN 'Herren' ELSE 'Kinder' END AS target_group,
         CASE WHEN p_size % 5 = 0 THEN '' ELSE 'http://img/' || p_partkey || '/main.jpg' END AS img1,
         CASE WHEN p_size % 3 <> 0 THEN 'http://img/' || p_brand || '/back.jpg' END AS img2,
         CASE WHEN p_size % 2 = 0 THEN 'http://img/' || p_type || '/model.jpg' END AS img3,
         p_type || ' / ' || p_name AS category,
         CASE WHEN p_size % 2 = 1 THEN 'Bildmitte' END AS thing_orientation
  FROM part),
slot AS (
  SELECT product_id, 1 AS k, img1 AS url FROM article UNION ALL
  SELECT product_id, 2, img2 FROM article UNION ALL
  SELECT product_id, 3, img3 FROM article),
image AS (
  SELECT product_id, url, CAST(row_number() OVER (PARTITION BY product_id ORDER BY k) - 1 AS INTEGER) AS pos,
         NOT ((url LIKE '%/main.jpg' AND CAST(product_id AS BIGINT) % 7 = 0)
              OR url LIKE '%3/back.jpg') AS ok
  FROM slot WHERE url IS NOT NULL AND url <> ''),
counted AS (
  SELECT a.*, coalesce(i.n, 0) AS n_images, coalesce(i.n_ok, 0) AS n_ok,
         CASE WHEN coalesce(i.n, 0) = 0 THEN 'kept' WHEN i.n_ok = 0 THEN 'nulled' ELSE 'inferred' END AS branch
  FROM article a LEFT JOIN (
    SELECT product_id, count(*) AS n, count(*) FILTER (WHERE ok) AS n_ok FROM image GROUP BY 1) i
  USING (product_id)),
attribute AS (
  SELECT product_id, 0 AS pos, 'farbe' AS attribute_id, 'Farbe' AS label, 'gesamtes Produkt' AS orientation FROM article
  UNION ALL SELECT product_id, 1, 'objekt', 'Objekt', thing_orientation FROM article
  UNION ALL SELECT product_id, 2, 'stil', 'Stil', '{product_category}' FROM article
  UNION ALL SELECT product_id, 3, 'farbHex', 'Farbe Hex', 'Hauptbild' FROM article)"""

_OPTIONS = r"""
listed AS (
  SELECT product_id, 1 AS pos, 0 AS n, thing AS id, thing AS label FROM article UNION ALL
  SELECT product_id, 1, 1, lower(p_type), p_type FROM article UNION ALL
  SELECT product_id, 1, 2, colour_id, colour_id || '''s "' || style || '"' FROM article UNION ALL
  SELECT product_id, 1, 3, thing, p_name FROM article UNION ALL
  SELECT product_id, 2, 0, style, style || '''s' FROM article UNION ALL
  SELECT product_id, 2, 1, p_type, p_type || chr(10) || '{target_group}' FROM article UNION ALL
  SELECT product_id, 2, 2, 'a\b', 'Größe' FROM article),
options AS (
  SELECT product_id, pos, id, label,
         CAST(row_number() OVER (PARTITION BY product_id, pos ORDER BY first_n) - 1 AS INTEGER) AS option_pos
  FROM (SELECT product_id, pos, id, min(n) AS first_n, arg_max(label, n) AS label FROM listed GROUP BY 1, 2, 3))"""

# Name of the n-th file of several articles, by its ending.
_NAME = "n || CASE n % 3 WHEN 0 THEN '.json' WHEN 1 THEN '.txt' ELSE '' END"

_QUOTED = r"""CASE WHEN contains({0}, '''') AND NOT contains({0}, '"')
    THEN '"' || replace(replace({0}, '\', '\\'), chr(10), '\n') || '"'
    ELSE '''' || replace(replace(replace({0}, '\', '\\'), chr(10), '\n'), '''', '\''') || '''' END"""

_PROMPTS = (
    r"""
choices AS (
  SELECT product_id, pos, '{' || string_agg("""
    + _QUOTED.format("id")
    + r""" || ': ' || """
    + _QUOTED.format("label")
    + r""", ', ' ORDER BY option_pos) || '}' AS choice
  FROM options GROUP BY 1, 2),
prompts AS (
  SELECT t.product_id, t.pos, t.attribute_id, c.branch,
    CASE WHEN t.attribute_id = 'farbe' THEN 'You name the colours of a product from its images as hex codes.'
         ELSE 'You pick the value of one product attribute from its images.' END AS system,
    CASE WHEN t.attribute_id = 'farbe' THEN 'Name the main colours of this product for ' || c.target_group || '.'
         ELSE 'Attribute ' || t.attribute_id || ': ' || t.label || '. Look at: ' || coalesce(t.orientation, 'None') || '.'
           || chr(10) || 'Category: ' || c.category || '. Target group: ' || c.target_group || '.'
           || chr(10) || 'Answer with one id of ' || coalesce(o.choice, 'None') || '.' END AS prompt
  FROM attribute t JOIN counted c USING (product_id) LEFT JOIN choices o USING (product_id, pos))"""
)

_RESULTS = r"""
named AS (
  SELECT o.product_id, o.pos, min(o.id) AS id
  FROM options o JOIN article a USING (product_id) WHERE contains(a.category, o.id) GROUP BY 1, 2),
results AS (
  SELECT t.product_id, t.pos, t.attribute_id, c.branch, c.target_group,
    CASE c.branch WHEN 'kept' THEN 'alt' WHEN 'nulled' THEN NULL
      ELSE CASE WHEN c.p_partkey % 11 = 0 THEN 'None'
                WHEN t.attribute_id = 'farbe' THEN lower(c.colour_id)
                WHEN t.attribute_id = 'farbHex' THEN '#' || lpad(printf('%X', c.p_partkey), 6, '0')
                ELSE coalesce(n.id, 'None') END END AS result,
    c.branch = 'inferred' AND t.attribute_id = 'farbe' AND c.p_partkey % 11 <> 0 AS is_list
  FROM attribute t JOIN counted c USING (product_id) LEFT JOIN named n USING (product_id, pos)),
ledger AS (
  SELECT DISTINCT product_id, CASE WHEN k = 1 THEN colour_id END AS supplier_colour, url
  FROM image JOIN article USING (product_id) CROSS JOIN (VALUES (1), (2)) AS kinds(k) WHERE NOT ok
  UNION SELECT product_id, colour_id, '[]' FROM counted WHERE n_images = 0)"""

# What the test client says to each request.
_ANSWERED = r"""
answered AS (
  SELECT p.product_id, p.pos, p.attribute_id, p.branch, length(p.prompt) % 7 = 0 AS is_raw,
    length(p.prompt) || ' characters, ' || i.n || ' images, ' || i.size || ' bytes' AS said
  FROM prompts p LEFT JOIN (
    SELECT product_id, count(*) AS n, sum(length('data:image/jpeg;base64,' || to_base64(encode(url)))) AS size
    FROM image WHERE ok GROUP BY 1) i USING (product_id))"""

# A result as it stands in a document: JSON text, and the text a reader gets for it.
_JSON_RESULT = "CASE WHEN result IS NULL THEN 'null' WHEN is_list THEN '[' || to_json(result) || ']' ELSE to_json(result) END"
_READ_RESULT = "CASE WHEN is_list THEN '[' || to_json(result) || ']' ELSE result END"


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


_VALUE_TEXT = r"""CASE event_id % 8
    WHEN 0 THEN '{"response": "' || event_type || '"}' WHEN 1 THEN 'not json ' || event_type
    WHEN 2 THEN props WHEN 3 THEN '{"response": null}'
    WHEN 4 THEN '{"response": ["' || event_type || '", "#ff0000"]}' WHEN 5 THEN '["' || event_type || '"]'
    WHEN 6 THEN NULL ELSE '{"response": "' || event_type || '"} and more' END"""

ORACLE: dict[str, str] = {
    "q01_article_scan": _with(
        _ARTICLES,
        select="SELECT product_id, colour_id, target_group, CAST(NULL AS VARCHAR) AS reject_reason FROM article",
    ),
    "q02_image_list": _with(_ARTICLES, select="SELECT product_id, pos, url FROM image"),
    "q03_primary_category": _with(
        _ARTICLES, select="SELECT product_id, category AS product_category FROM article"
    ),
    "q04_attribute_explode": _with(
        _ARTICLES, select="SELECT product_id, pos, attribute_id, label, orientation FROM attribute"
    ),
    "q05_option_map": _with(
        _ARTICLES,
        _OPTIONS,
        select="""SELECT t.product_id, t.attribute_id, o.option_pos, o.id AS option_id, o.label AS option_label
FROM attribute t LEFT JOIN options o USING (product_id, pos)""",
    ),
    "q06_prompt_render": _with(
        _ARTICLES, _OPTIONS, _PROMPTS, select="SELECT product_id, attribute_id, system, prompt FROM prompts"
    ),
    "q07_distinct_fetch": _with(
        _ARTICLES,
        select="""SELECT url, count(*) AS n_uses, bool_and(ok) AS ok,
  CASE WHEN bool_and(ok) THEN CAST(strlen(url) AS INTEGER) END AS n_bytes FROM image GROUP BY url""",
    ),
    "q08_image_join": _with(
        _ARTICLES,
        select="""SELECT t.product_id, t.pos, CAST(c.n_ok AS BIGINT) AS n_ok, CAST(c.n_images - c.n_ok AS BIGINT) AS n_failed
FROM attribute t JOIN counted c USING (product_id)""",
    ),
    "q09_data_url": "SELECT page_id, 'data:image/jpeg;base64,' || to_base64(encode(html)) AS data_url FROM pages",
    "q10_message_assembly": _with(
        _ARTICLES,
        _OPTIONS,
        _PROMPTS,
        select="""SELECT p.product_id, p.pos, '[{"role":"system","content":' || to_json(p.system)
  || '},{"role":"user","content":[{"type":"text","text":' || to_json(p.prompt) || '}' || i.parts || ']}]' AS messages
FROM prompts p JOIN (
  SELECT product_id, string_agg(',{"type":"image_url","image_url":{"url":"data:image/jpeg;base64,' || to_base64(encode(url)) || '"}}', '' ORDER BY pos) AS parts
  FROM image WHERE ok GROUP BY 1) i USING (product_id)
WHERE p.branch = 'inferred'""",
    ),
    "q11_response_parse": f"""WITH answers AS (SELECT event_id, {_VALUE_TEXT} AS answer FROM events),
kinds AS (
  SELECT event_id, answer, CASE WHEN answer IS NULL THEN 'error' WHEN NOT json_valid(answer) THEN 'raw'
    WHEN json_type(answer) <> 'OBJECT' THEN 'error'
    WHEN NOT list_contains(json_keys(answer), 'response') THEN 'raw' ELSE 'value' END AS kind FROM answers),
found AS (SELECT event_id, answer, kind, CASE WHEN kind = 'value' THEN answer::JSON->'response' END AS v FROM kinds)
SELECT event_id, kind,
  CASE kind WHEN 'value' THEN CAST(v AS VARCHAR) WHEN 'raw' THEN CAST(to_json(answer) AS VARCHAR) END AS result_json,
  CASE WHEN kind = 'raw' THEN answer WHEN kind = 'value' AND json_type(v) <> 'ARRAY' THEN v->>'$' END AS result,
  CASE WHEN kind = 'value' AND json_type(v) = 'ARRAY' THEN array_to_string(CAST(v AS VARCHAR[]), ',') END AS result_list
FROM found""",
    "q12_infer": _with(
        _ARTICLES, _OPTIONS, _RESULTS, select="SELECT product_id, pos, attribute_id, result FROM results"
    ),
    "q13_write_back": _with(
        _ARTICLES,
        _OPTIONS,
        _RESULTS,
        select=f"""SELECT product_id, pos, attribute_id, {_READ_RESULT} AS result,
  'Beschreibt ' || label AS description, '{{"z":' || product_id || ',"a":[null,"ä"]}}' AS unknown
FROM results JOIN attribute USING (product_id, pos, attribute_id)""",
    ),
    "q14_branch": _with(
        _ARTICLES, _OPTIONS, _RESULTS, select="SELECT product_id, attribute_id, branch FROM results"
    ),
    "q15_failed_ledger": _with(_ARTICLES, _OPTIONS, _RESULTS, select="SELECT * FROM ledger"),
    "q16_ledger_append": _with(
        _ARTICLES, _OPTIONS, _RESULTS, select="SELECT * FROM ledger WHERE CAST(product_id AS BIGINT) % 2 <> 0"
    ),
    "q17_unresolved": _with(
        _ARTICLES,
        _OPTIONS,
        _RESULTS,
        select="""SELECT attribute_id, count(*) FILTER (WHERE result IS NULL OR result = 'None') AS n_unresolved, count(*) AS n
FROM results GROUP BY 1""",
    ),
    "q18_no_images": _with(
        _ARTICLES, select="SELECT target_group, count(*) AS n FROM counted WHERE n_images = 0 GROUP BY 1"
    ),
    "q19_name_filter": """SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS name FROM pages
WHERE regexp_extract(url, '([^/]*)$', 1) LIKE '%=feed' AND page_id IN (SELECT doc_id FROM labels)""",
    "q20_batch_assign": """SELECT batch, count(*) AS n, count(*) = 100 AS more_available
FROM (SELECT CAST((row_number() OVER (ORDER BY doc_id) - 1) // 100 AS BIGINT) AS batch FROM documents) GROUP BY 1""",
    "q21_archive_last_wins": """SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value
FROM events GROUP BY 1, 2""",
    "q22_run_metrics": _with(
        _ARTICLES,
        select="""SELECT metric, CAST(value AS BIGINT) AS value FROM (
  SELECT 'articles' AS metric, count(*) AS value FROM counted
  UNION ALL SELECT 'attributes', count(*) FROM attribute
  UNION ALL SELECT 'model_calls', count(*) FROM attribute JOIN counted USING (product_id) WHERE branch = 'inferred'
  UNION ALL SELECT 'inferred', count(*) FROM counted WHERE branch = 'inferred'
  UNION ALL SELECT 'kept', count(*) FROM counted WHERE branch = 'kept'
  UNION ALL SELECT 'nulled', count(*) FROM counted WHERE branch = 'nulled'
  UNION ALL SELECT 'failed', 0)""",
    ),
    "q23_nested_rebuild": """SELECT l_orderkey AS o_orderkey, l_linenumber AS pos, count(*) AS n_writes,
  max(l_extendedprice) AS value, any_value(o_orderpriority) AS o_orderpriority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""",
    "q24_stream_batches": "SELECT event_id, event_type, value FROM events",
    "q25_stream_dedupe": """SELECT DISTINCT CAST(user_id AS VARCHAR) AS product_id,
  CASE WHEN event_type <> 'error' THEN event_type END AS supplier_colour, event_type AS url FROM events""",
    "q26_thumbnail_geometry": """WITH s AS (
  SELECT p_partkey, CAST(p_size * 40 AS DOUBLE) AS w, floor(p_retailprice) AS h FROM part),
e AS (SELECT *, w / h AS aspect, 500 * w / h AS sw, 500 * h / w AS sh FROM s)
SELECT p_partkey,
  CAST(CASE WHEN w <= 500 AND h <= 500 THEN w WHEN aspect > 1 THEN 500
    ELSE greatest(1, CASE WHEN abs(aspect - floor(500 * aspect) / 500) <= abs(aspect - ceil(500 * aspect) / 500)
      THEN floor(500 * aspect) ELSE ceil(500 * aspect) END) END AS INTEGER) AS out_w,
  CAST(CASE WHEN w <= 500 AND h <= 500 THEN h WHEN aspect <= 1 THEN 500
    WHEN floor(500 / aspect) < 1 THEN 1
    ELSE CASE WHEN abs(aspect - 500 / floor(500 / aspect)) <= abs(aspect - 500 / ceil(500 / aspect))
      THEN floor(500 / aspect) ELSE ceil(500 / aspect) END END AS INTEGER) AS out_h
FROM e""",
    "q27_corrupt_quarantine": """SELECT count(*) FILTER (WHERE json_valid(t)) AS n_good, count(*) FILTER (WHERE NOT json_valid(t)) AS n_bad
FROM (SELECT CASE event_id % 10 WHEN 0 THEN split_part(props, '}', 1) WHEN 1 THEN props || ' x' ELSE props END AS t FROM events)""",
    "q28_enriched_documents": _with(
        _ARTICLES,
        _OPTIONS,
        _RESULTS,
        f"""
values_of AS (
  SELECT product_id, pos, string_agg('{{"Identifier":' || to_json(id) || ',"Bezeichner":' || to_json(label)
    || ',"Beschreibung":"Wert"}}', ',' ORDER BY n) AS items FROM listed GROUP BY 1, 2),
written AS (
  SELECT r.product_id, string_agg('{{"Identifier":"' || r.attribute_id || '","Bezeichner":"' || t.label
    || '","Typ":"Auswahl","Ausgewaehlter Attributwert (Result)":' || {_JSON_RESULT}
    || ',"Beschreibung":"Beschreibt ' || t.label || '","Orientierung":' || coalesce(to_json(t.orientation), 'null')
    || ',"Attributwerte":' || CASE WHEN r.attribute_id = 'farbHex' THEN 'null' ELSE '[' || coalesce(v.items, '') || ']' END
    || '}}', ',' ORDER BY r.pos) AS items
  FROM results r JOIN attribute t USING (product_id, pos) LEFT JOIN values_of v USING (product_id, pos) GROUP BY 1)""",
        select="""SELECT product_id, '{"Unbekannt":{"z":' || product_id || ',"a":[null,"ä"]},"ProduktID":"' || product_id
  || '","FarbID":' || to_json(colour_id) || ',"LiefArtNrBer":' || to_json(p_name) || ',"Geschlecht":"' || target_group
  || '","Hauptbild":' || to_json(img1) || ',"Freisteller Back":' || coalesce(to_json(img2), 'null')
  || ',"Modellbild":' || coalesce(to_json(img3), 'null') || ',"Klassifikation":[{"Identifier":' || to_json(p_type)
  || ',"Bezeichnung":' || to_json(category) || '}],"Klassifikations-Attribute":[' || items || ']}' AS enriched
FROM article JOIN written USING (product_id)""",
    ),
    "q29_model_calls": _with(
        _ARTICLES,
        _OPTIONS,
        _PROMPTS,
        _ANSWERED,
        select="""SELECT product_id, pos,
  CASE WHEN branch <> 'inferred' THEN branch WHEN is_raw THEN 'raw' ELSE 'value' END AS kind,
  CASE branch WHEN 'kept' THEN 'alt' WHEN 'inferred' THEN said END AS result, branch = 'nulled' AS unresolved
FROM answered""",
    ),
    "q30_folder_run": _with(
        _ARTICLES,
        _OPTIONS,
        _PROMPTS,
        _ANSWERED,
        select="""SELECT product_id, pos, attribute_id, true AS archived,
  CASE WHEN branch = 'kept' THEN 'alt' WHEN branch = 'nulled' THEN NULL
    WHEN attribute_id = 'farbe' AND NOT is_raw THEN '["' || said || '"]' ELSE said END AS result,
  'Beschreibt ' || label AS description, '{"z":' || product_id || ',"a":[null,"ä"]}' AS unknown
FROM answered JOIN attribute USING (product_id, pos, attribute_id)""",
    ),
    "q31_array_documents": """SELECT (p_partkey // 50) || '.json' AS source_file,
  row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) - 1 AS doc_pos,
  CAST(p_partkey AS VARCHAR) AS product_id, CAST(4 AS BIGINT) AS n_attributes,
  CAST(NULL AS VARCHAR) AS reject_reason FROM part""",
    "q46_large_array_files": _with(
        _ARTICLES,
        select="""SELECT product_id, colour_id, CAST(4 AS BIGINT) AS n_attributes, true AS in_array,
  CAST(NULL AS VARCHAR) AS reject_reason FROM article""",
    ),
    "q32_folder_state": """SELECT CASE n % 4 WHEN 1 THEN '_' WHEN 2 THEN '.' ELSE '' END || n || '.json' AS source_file,
  CASE WHEN n % 4 = 3 THEN 0 ELSE count(*) END AS n_articles,
  CASE WHEN n % 4 = 3 THEN 'invalid_json' END AS reason
FROM (SELECT p_partkey // 50 AS n FROM part) GROUP BY n""",
    "q33_image_validation": _with(
        _ARTICLES,
        """
picture AS (
  SELECT DISTINCT url, split_part(url, '/', 4) AS owner, url LIKE '%3/back.jpg'
  OR url LIKE '%4/main.jpg' OR url LIKE '%5/main.jpg' OR url LIKE '%6/main.jpg' AS junk FROM image),
s AS (
  SELECT *, CAST(97 * length(owner) + coalesce(TRY_CAST(owner AS BIGINT) % 900, 0) AS DOUBLE) AS w,
    CAST(7 * length(url) AS DOUBLE) AS h FROM picture),
e AS (SELECT *, w / h AS aspect, 500 * w / h AS sw, 500 * h / w AS sh FROM s),
t AS (SELECT *,
  CAST(CASE WHEN w <= 500 AND h <= 500 THEN w WHEN aspect > 1 THEN 500
    ELSE greatest(1, CASE WHEN abs(aspect - floor(500 * aspect) / 500) <= abs(aspect - ceil(500 * aspect) / 500)
      THEN floor(500 * aspect) ELSE ceil(500 * aspect) END) END AS INTEGER) AS out_w,
  CAST(CASE WHEN w <= 500 AND h <= 500 THEN h WHEN aspect <= 1 THEN 500
    WHEN floor(500 / aspect) < 1 THEN 1
    ELSE CASE WHEN abs(aspect - 500 / floor(500 / aspect)) <= abs(aspect - 500 / ceil(500 / aspect))
      THEN floor(500 / aspect) ELSE ceil(500 / aspect) END END AS INTEGER) AS out_h
FROM e)""",
        select="""SELECT url, NOT junk AS ok, CASE WHEN NOT junk THEN 'image/png' END AS media_type,
  CASE WHEN NOT junk THEN CAST(w AS INTEGER) END AS width,
  CASE WHEN NOT junk THEN CAST(h AS INTEGER) END AS height,
  CASE WHEN NOT junk THEN url LIKE '%/model.jpg' END AS needs_rgb,
  CASE WHEN NOT junk THEN out_w END AS out_w, CASE WHEN NOT junk THEN out_h END AS out_h FROM t""",
    ),
    "q34_model_retries": _with(
        _ARTICLES,
        _OPTIONS,
        _PROMPTS,
        select="""SELECT product_id, CAST(pos AS INTEGER) AS pos,
  CAST(CASE WHEN length(prompt) % 7 = 0 THEN 1 WHEN length(prompt) % 5 = 0 THEN 3 ELSE 1 END AS INTEGER) AS tries,
  CASE WHEN length(prompt) % 7 = 0 THEN 'KeyError: ''no answer''' END AS error
FROM prompts WHERE branch = 'inferred'""",
    ),
    "q35_reject_reasons": """SELECT p_partkey || '.json' AS source_file,
  CASE WHEN p_partkey % 10 = 5 THEN 'invalid_utf8' ELSE CASE p_partkey % 5 WHEN 1 THEN 'category_missing' WHEN 2 THEN 'attributes_invalid'
    WHEN 3 THEN 'options_missing' WHEN 4 THEN 'invalid_json' END END AS reject_reason FROM part""",
    "q37_folder_stream": """SELECT CASE n % 4 WHEN 1 THEN '_' WHEN 2 THEN '.' ELSE '' END || n || '.json' AS source_file,
  CASE WHEN n % 4 = 0 THEN 2 ELSE 1 END AS n_reads,
  CASE WHEN n % 4 = 3 THEN 0 ELSE count(*) END AS n_articles,
  CASE n % 4 WHEN 0 THEN 'invalid_json' WHEN 3 THEN 'invalid_utf8' END AS reason
FROM (SELECT p_partkey // 50 AS n FROM part) GROUP BY n""",
    "q39_any_extension": f"""SELECT {_NAME} AS source_file, count(*) AS n_articles
FROM (SELECT p_partkey // 50 AS n FROM part) GROUP BY n""",
    "q40_delete_inputs": f"""WITH f AS (SELECT DISTINCT p_partkey // 50 AS n FROM part)
SELECT {_NAME} AS source_file, CASE WHEN n % 2 = 0 THEN true END AS deleted, n % 2 <> 0 AS is_there FROM f
UNION ALL SELECT {_NAME} || '.absent', false, false FROM f WHERE n % 2 = 0""",
    "q41_hard_failure": _with(
        _ARTICLES,
        _OPTIONS,
        _PROMPTS,
        select="""SELECT product_id || '.json' AS source_file,
  CASE WHEN bool_or(branch = 'inferred' AND length(prompt) % 7 = 0) THEN 'KeyError: ''no answer''' END AS reason
FROM prompts GROUP BY product_id""",
    ),
    "q42_url_retries": _with(
        _ARTICLES,
        select="""SELECT DISTINCT url, url NOT LIKE '%/model.jpg' AND length(url) % 4 < 3 AS ok,
  CASE WHEN url LIKE '%/model.jpg' THEN 'ValueError: no URL'
    WHEN length(url) % 4 = 3 THEN 'OSError: failure 3' END AS error FROM image""",
    ),
    "q45_kept_images": _with(
        _ARTICLES,
        select="""SELECT url, count(*) AS n_uses, bool_and(ok) AS ok,
  CASE WHEN bool_and(ok) THEN CASE WHEN bool_or(CAST(product_id AS BIGINT) % 2 = 0) THEN 0 ELSE 1 END END AS fetched_in
FROM image GROUP BY url""",
    ),
    "q43_idle_exit": """WITH f AS (SELECT count(DISTINCT p_partkey // 50) AS n FROM part)
SELECT 0 AS call, CAST(ceil(n / 25) AS INTEGER) AS batches, CAST(n AS INTEGER) AS files, 0 AS "left" FROM f
UNION ALL SELECT 1, 0, 0, 0""",
    "q44_replayed_batch": """SELECT p_partkey || '.json' AS source_file, CAST(p_partkey AS VARCHAR) AS product_id FROM part""",
    "q38_ledger_stream": """SELECT DISTINCT CAST(user_id AS VARCHAR) AS product_id,
  CASE WHEN event_type <> 'error' THEN event_type END AS supplier_colour, event_type AS url FROM events""",
    "q36_ledger_text": _with(
        _ARTICLES,
        _OPTIONS,
        _RESULTS,
        select="SELECT product_id || ',' || coalesce(supplier_colour, 'None') || ',' || url AS value FROM ledger",
    ),
}
