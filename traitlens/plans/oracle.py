"""DuckDB SQL twins of ``plans/queries.py``.

The tables of the test data are registered as views by the caller.  Vectors
are cast to DOUBLE[] so that DuckDB computes cosine in double precision like
the Spark side.
"""

from __future__ import annotations

ENTITIES = """
entities AS (
    SELECT vec_id AS id,
           CAST(vec_id // 5 AS VARCHAR) AS prd_id,
           CASE WHEN vec_id % 5 = 0 THEN 'product_name'
                WHEN vec_id % 5 <= 2 THEN 'product_text'
                ELSE 'product_image' END AS prd_tag,
           CAST(embedding AS DOUBLE[]) AS v
    FROM embeddings
)"""

PAIRS = ENTITIES + """,
first_ids AS (
    SELECT prd_id, prd_tag, min(id) AS id
    FROM entities
    WHERE prd_tag IN ('product_name', 'product_text')
    GROUP BY prd_id, prd_tag
),
query_vectors AS (
    SELECT f.prd_id, f.prd_tag, e.v
    FROM first_ids f JOIN entities e ON e.id = f.id
),
pairs AS (
    SELECT e.prd_id, s.search, e.id, e.prd_tag,
           list_cosine_similarity(q.v, e.v) AS similarity
    FROM entities e
    JOIN (VALUES ('name_text', 'product_name', 'product_text'),
                 ('name_image', 'product_name', 'product_image'),
                 ('text_image', 'product_text', 'product_image')) AS s(search, qtag, ctag)
      ON e.prd_tag = s.ctag
    JOIN query_vectors q ON q.prd_id = e.prd_id AND q.prd_tag = s.qtag
)"""

SIMILARITY_SCORES = "WITH " + PAIRS + """
SELECT prd_id,
       round(max(similarity) FILTER (WHERE search = 'name_text'), 6) AS similarity_name_text,
       round(max(similarity) FILTER (WHERE search = 'name_image'), 6) AS similarity_name_image,
       round(max(similarity) FILTER (WHERE search = 'text_image'), 6) AS similarity_text_image
FROM pairs
GROUP BY prd_id
HAVING max(similarity) FILTER (WHERE search = 'name_text') IS NOT NULL
   AND max(similarity) FILTER (WHERE search = 'name_image') IS NOT NULL
   AND max(similarity) FILTER (WHERE search = 'text_image') IS NOT NULL
"""

VECTOR_TOPK_FILTERED = "WITH " + PAIRS + """,
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY prd_id, search ORDER BY similarity DESC, id ASC) AS rank
    FROM pairs
    WHERE similarity IS NOT NULL
)
SELECT prd_id, search, CAST(rank AS INTEGER) AS rank, id, prd_tag, round(similarity, 6) AS similarity
FROM ranked
WHERE rank <= 10
"""

ENTITIES_BY_LABEL = """
entities AS (
    SELECT vec_id AS id,
           CAST(vec_id // 5 AS VARCHAR) AS prd_id,
           CASE WHEN label <= 1 THEN 'product_name'
                WHEN label <= 5 THEN 'product_text'
                ELSE 'product_image' END AS prd_tag,
           CAST(embedding AS DOUBLE[]) AS v
    FROM embeddings
)"""

SIMILARITY_SCORES_BY_LABEL = SIMILARITY_SCORES.replace(ENTITIES, ENTITIES_BY_LABEL)

ENTITIES_SKEWED = ENTITIES_BY_LABEL.replace(
    "CAST(vec_id // 5 AS VARCHAR) AS prd_id", "CASE WHEN vec_id % 3 = 0 THEN 'hot' ELSE CAST(vec_id // 5 AS VARCHAR) END AS prd_id"
)

SIMILARITY_SCORES_SKEWED = SIMILARITY_SCORES.replace(ENTITIES, ENTITIES_SKEWED)

SIMILARITY_REJECTS = "WITH " + PAIRS.replace(ENTITIES, ENTITIES_BY_LABEL) + """,
scored AS (
    SELECT prd_id FROM pairs GROUP BY prd_id
    HAVING max(similarity) FILTER (WHERE search = 'name_text') IS NOT NULL
       AND max(similarity) FILTER (WHERE search = 'name_image') IS NOT NULL
       AND max(similarity) FILTER (WHERE search = 'text_image') IS NOT NULL
)
SELECT DISTINCT 'similarity' AS stage, prd_id, 'missing_tag' AS rule, 'prd_tag' AS column_name
FROM entities
WHERE prd_id NOT IN (SELECT prd_id FROM scored)
"""

VECTOR_TOP1_FILTERED = VECTOR_TOPK_FILTERED.replace("WHERE rank <= 10", "WHERE rank <= 1")

VECTOR_LOOKUP = "WITH " + ENTITIES + """
SELECT prd_id, prd_tag, id, CAST(len(v) AS BIGINT) AS dim,
       round(sqrt(list_dot_product(v, v)), 6) AS norm
FROM entities
WHERE prd_tag IN ('product_name', 'product_text')
"""

ORACLE_SQL: dict[str, str] = {
    "similarity_scores": SIMILARITY_SCORES,
    "vector_topk_filtered": VECTOR_TOPK_FILTERED,
    "vector_top1_filtered": VECTOR_TOP1_FILTERED,
    "similarity_scores_by_label": SIMILARITY_SCORES_BY_LABEL,
    "similarity_scores_skewed": SIMILARITY_SCORES_SKEWED,
    "similarity_rejects": SIMILARITY_REJECTS,
    "vector_lookup": VECTOR_LOOKUP,
}


# --- model replies derived from part (twin of fixtures.replies) ---------------

def _q(expr: str) -> str:
    return f"'\"' || {expr} || '\"'"


def replies_cte(side: str) -> str:
    w1, w2 = "split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2)"
    if side == "text":
        cat1, cat2, style = w2, "p_type", w1
    else:
        cat1, cat2, style = "lower(p_type)", w2, f"{w1} || ' look'"
    nl = "chr(10)"
    obj1 = (
        f"""'{{"category1": ' || {_q(cat1)} || ', "category2": ' ||
        CASE WHEN p_size % 7 = 0 THEN '"unknown"' ELSE {_q(cat2)} END ||
        ', "color": ' || {_q(w1)} ||
        CASE WHEN p_size % 5 = 0 THEN '' ELSE ', "style": ' || {_q(style)} END ||
        ', "material": ' ||
        CASE WHEN p_size > 45 THEN {_q(f"repeat({w1} || '-', 12)")} ELSE {_q('p_brand')} END ||
        ', "occasion": ' || CASE WHEN p_size % 7 = 0 THEN '"unknown"' ELSE '"daily"' END || '}}'"""
    )
    obj2 = f"""'{{"category1": ' || {_q(w2)} || ', "color": ' || {_q('p_brand')} || ', "size": ' || CAST(p_size AS VARCHAR) || '}}'"""
    nested = """'{"category1": {"inner": "x"}, "color": "red"}'"""
    body = (
        f"'[' || {nl} || '  ' || {obj1} ||"
        f" CASE WHEN p_size % 2 = 0 THEN ',' || {nl} || '  ' || {obj2} ELSE '' END ||"
        f" CASE WHEN p_type = 'MEDIUM' THEN ',' || {nl} || '  ' || {nested} ELSE '' END ||"
        f" {nl} || ']'"
    )
    content = f"'Here is what I see in the {side}:' || {nl} || {body} || {nl} || 'Hope this helps.'"
    if side == "image":
        content = f"CASE WHEN p_type = 'PROMO' THEN 'I cannot tell anything about it.' ELSE {content} END"
    return f"""replies_{side} AS (
    SELECT CAST(p_partkey AS VARCHAR) AS prd_id,
           p_brand <> 'Brand#13' AS status,
           CASE WHEN p_brand = 'Brand#13' THEN NULL ELSE {content} END AS content,
           CASE WHEN p_brand = 'Brand#13' THEN 'model endpoint timed out' END AS error
    FROM part
)"""


OBJECT_PATTERN_SQL = r"'(?s)\{.*?\}'"
TRAIT_KEYS_SQL = ("category1", "category2", "color", "style", "material", "occasion")
TRAIT_WIDTHS_SQL = {"category1": 30, "category2": 30, "color": 50, "style": 50, "material": 50, "occasion": 50}


def trait_rows_cte(side: str) -> str:
    """All parsed trait rows of one side (before width checks)."""
    fields = ",\n           ".join(f"json_extract_string(frag, '$.{k}') AS {k}" for k in TRAIT_KEYS_SQL)
    return f"""frags_{side} AS (
    SELECT prd_id, unnest(regexp_extract_all(content, {OBJECT_PATTERN_SQL})) AS frag
    FROM replies_{side}
    WHERE status
),
parsed_{side} AS (
    SELECT {fields},
           prd_id
    FROM frags_{side}
    WHERE json_valid(frag)
)"""


def _width_ok(cols: dict[str, int]) -> str:
    return " AND ".join(f"coalesce(length({c}) <= {n}, true)" for c, n in cols.items())


def traits_cte(side: str) -> str:
    """Valid trait rows of one side (twin of traits.extract_traits)."""
    return f"""{replies_cte(side)},
{trait_rows_cte(side)},
traits_{side} AS (
    SELECT * FROM parsed_{side}
    WHERE prd_id IS NOT NULL AND {_width_ok({**TRAIT_WIDTHS_SQL, 'prd_id': 30})}
)"""


TRAIT_EXTRACT = "WITH " + traits_cte("text") + "\nSELECT * FROM traits_text\n"

EXTRACT_JSON_ARRAY = "WITH " + replies_cte("text") + f"""
SELECT prd_id,
       CAST(len(list_filter(regexp_extract_all(content, {OBJECT_PATTERN_SQL}), lambda f: json_valid(f))) AS INTEGER) AS n_objects
FROM replies_text
WHERE status
"""

JSON_PROPS_EXTRACT = f"""
WITH frags AS (
    SELECT event_id, unnest(regexp_extract_all(props, {OBJECT_PATTERN_SQL})) AS frag FROM events
)
SELECT event_id, json_extract_string(frag, '$.k') AS k
FROM frags
WHERE json_valid(frag)
"""

REPLIES_SPLIT = "WITH " + replies_cte("text") + ",\n" + replies_cte("image") + """
SELECT prd_id, 'traits_text' AS stage, CASE WHEN status THEN 'parse' ELSE 'reject' END AS route, error AS detail
FROM replies_text
UNION ALL
SELECT prd_id, 'traits_image' AS stage, CASE WHEN status THEN 'parse' ELSE 'reject' END AS route, error AS detail
FROM replies_image
"""


# --- catalog derived from part (twin of fixtures.raw_catalog + clean_catalog) ---

NA_TOKENS_SQL = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)
CATEGORY_VALUES_SQL = (
    "('https://shop.example/c/ECONOMY', '이코노미'), ('https://shop.example/c/LARGE', '라지'), "
    "('https://shop.example/c/MEDIUM', '미디엄'), ('https://shop.example/c/SMALL', '스몰'), "
    "('https://shop.example/c/STANDARD', '스탠다드')"
)


def _na(c: str) -> str:
    return f"CASE WHEN {c} IN ({NA_TOKENS_SQL}) THEN NULL ELSE {c} END"


def raw_catalog_select(source: str = "part", name_expr: str = "p_name") -> str:
    return f"""SELECT CAST(p_partkey AS VARCHAR) AS order_key,
           'https://shop.example/c/' || p_type AS category_link,
           {name_expr} AS name,
           format('{{:,}}', p_partkey * 137 + 9000) || '원' AS price3,
           CASE WHEN p_size % 7 = 0 THEN 'N/A' ELSE '(' || format('{{:,}}', p_size * 40) || ')' END AS rating,
           CASE WHEN p_size % 11 = 0 THEN '' ELSE printf('%d.%d', p_size % 5, p_size % 10) END AS rating_value
    FROM {source}"""


def cleaned_select(raw: str, extra: str = "") -> str:
    """Twin of clean_catalog over the relation ``raw`` (``extra``: carried columns)."""
    return f"""SELECT {extra}nullif({_na('r.order_key')}, '') AS prd_id,
           m.category AS category,
           nullif({_na('r.name')}, '') AS prd_name,
           TRY_CAST(nullif(replace(replace({_na('r.price3')}, '원', ''), ',', ''), '') AS DECIMAL(20,4)) AS price,
           TRY_CAST(nullif(replace(replace({_na('r.rating')}, '(', ''), ')', ''), '') AS DECIMAL(20,4)) AS review,
           TRY_CAST(nullif({_na('r.rating_value')}, '') AS DECIMAL(20,4)) AS review_rating,
           '/data/catalog/prd_img/' || nullif({_na('r.order_key')}, '') || '.jpg' AS prd_img
    FROM {raw} r
    LEFT JOIN (VALUES {CATEGORY_VALUES_SQL}) AS m(link, category)
      ON m.link = {_na('r.category_link')}"""


CATALOG_CLEAN = f"""
WITH raw AS ({raw_catalog_select()}),
cleaned AS ({cleaned_select('raw')})
SELECT prd_id, category, prd_name,
       CAST(price AS DOUBLE) AS price, CAST(review AS DOUBLE) AS review,
       CAST(review_rating AS DOUBLE) AS review_rating, prd_img
FROM cleaned
WHERE prd_id IS NOT NULL AND {_width_ok({'prd_id': 30, 'category': 20})}
"""

INSERT_IGNORE = f"""
WITH raw AS (
    SELECT r.*, p.p_partkey * 3 + 1 AS ord
    FROM ({raw_catalog_select()}) r
    JOIN part p ON CAST(p.p_partkey AS VARCHAR) = r.order_key
    UNION ALL
    SELECT r.*, p.p_partkey * 3 + CASE WHEN p.p_size % 2 = 0 THEN 0 ELSE 2 END AS ord
    FROM ({raw_catalog_select("part", "p_name || ' v2'")} WHERE p_size > 40) r
    JOIN part p ON CAST(p.p_partkey AS VARCHAR) = r.order_key
),
cleaned AS ({cleaned_select('raw', 'r.ord AS ord, ')}),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY prd_id ORDER BY ord) AS rn
    FROM cleaned
    WHERE prd_id IS NOT NULL AND {_width_ok({'prd_id': 30, 'category': 20})}
)
SELECT prd_id, prd_name, CAST(price AS DOUBLE) AS price
FROM ranked
WHERE rn = 1
  AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_type = 'SMALL' AND CAST(p.p_partkey AS VARCHAR) = ranked.prd_id)
"""

ORACLE_SQL.update(
    {
        "trait_extract": TRAIT_EXTRACT,
        "extract_json_array": EXTRACT_JSON_ARRAY,
        "json_props_extract": JSON_PROPS_EXTRACT,
        "replies_split": REPLIES_SPLIT,
        "catalog_clean": CATALOG_CLEAN,
        "insert_ignore": INSERT_IGNORE,
    }
)


# --- integration, documents, rejects ------------------------------------------

_TRAIT_RULES = [("max_len", c, n) for c, n in TRAIT_WIDTHS_SQL.items()]
# Widths and NOT NULL columns of the target tables, stated here on their own.
RULES_SQL = {
    "product_raw": [("not_null", "prd_id", None), ("max_len", "prd_id", 30), ("max_len", "category", 20)],
    "products_trait_text": [*_TRAIT_RULES, ("not_null", "prd_id", None), ("max_len", "prd_id", 30)],
    "products_trait_image": [*_TRAIT_RULES, ("not_null", "prd_id", None), ("max_len", "prd_id", 30)],
    "products_trait_information": [
        ("not_null", "prd_id", None), ("max_len", "prd_id", 30), ("not_null", "category", None), ("max_len", "category", 20),
        ("not_null", "prd_name", None), *_TRAIT_RULES,
    ],
}


def _rule_rejects(relation: str, stage: str, rules) -> str:
    parts = []
    for kind, column, arg in rules:
        if kind == "max_len":
            cond = f"length({column}) > {arg}"
            detail = f"'length ' || length({column}) || ' > {arg}'"
        else:
            cond, detail = f"{column} IS NULL", "'null'"
        parts.append(
            f"SELECT '{stage}' AS stage, CAST(prd_id AS VARCHAR) AS prd_id, '{kind}' AS rule, "
            f"'{column}' AS column_name, {detail} AS detail FROM {relation} WHERE {cond}"
        )
    return "\nUNION ALL\n".join(parts)


def _rules_ok(rules) -> str:
    conds = []
    for kind, column, arg in rules:
        conds.append(f"coalesce(length({column}) <= {arg}, true)" if kind == "max_len" else f"{column} IS NOT NULL")
    return " AND ".join(conds)


_TRAIT_COLS = ", ".join(f"r.{k}" for k in TRAIT_KEYS_SQL)

PIPELINE_CTES = f"""{traits_cte('text')},
{traits_cte('image')},
raw AS ({raw_catalog_select()}),
cleaned AS ({cleaned_select('raw', "replace(replace(" + _na('r.price3') + ", '원', ''), ',', '') AS price_text, replace(replace(" + _na('r.rating') + ", '(', ''), ')', '') AS review_text, " + _na('r.rating_value') + " AS review_rating_text, ")}),
product_raw AS (SELECT * FROM cleaned WHERE {_rules_ok(RULES_SQL['product_raw'])}),
both_sides AS (SELECT DISTINCT prd_id FROM traits_text INTERSECT SELECT DISTINCT prd_id FROM traits_image),
base AS (SELECT p.prd_id, p.category, p.prd_name FROM product_raw p JOIN both_sides b ON b.prd_id = p.prd_id),
trait_rows AS (
    SELECT *, 'text' AS trait_side FROM traits_text
    UNION ALL
    SELECT *, 'image' AS trait_side FROM traits_image
),
joined AS (
    SELECT b.prd_id, b.category, b.prd_name, r.trait_side, {_TRAIT_COLS}
    FROM trait_rows r JOIN base b ON b.prd_id = r.prd_id
),
integrated AS (SELECT * FROM joined WHERE {_rules_ok(RULES_SQL['products_trait_information'])})"""

INTEGRATE_TRAITS = "WITH " + PIPELINE_CTES + "\nSELECT * FROM integrated\n"


def _masked(prefix: str = "") -> str:
    parts = [f"CASE WHEN {prefix}{k} = 'unknown' THEN '' ELSE {prefix}{k} END" for k in ("category1", "category2", "style", "occasion")]
    return "concat_ws(' ', " + ", ".join(parts) + ")"


MASKED_CONCAT = "WITH " + PIPELINE_CTES + f"""
SELECT prd_id, trait_side, {_masked()} AS trait_doc FROM integrated
"""

ENTITY_DOCUMENTS = "WITH " + PIPELINE_CTES + f""",
docs AS (
    SELECT prd_id, 'product_name' AS prd_tag, min(prd_name) AS prd_text FROM integrated GROUP BY prd_id
    UNION
    SELECT DISTINCT prd_id, CASE WHEN trait_side = 'text' THEN 'product_text' ELSE 'product_image' END AS prd_tag,
           {_masked()} AS prd_text
    FROM integrated
)
SELECT prd_id, prd_tag, prd_text,
       'Instruct: Compare product descriptions' || chr(10) || 'Query: ' || prd_text AS prompt
FROM docs
"""

DISTINCT_PRODUCTS = "WITH " + PIPELINE_CTES + """
SELECT prd_id,
       count(*) FILTER (WHERE trait_side = 'text') AS n_text,
       count(*) FILTER (WHERE trait_side = 'image') AS n_image,
       count(*) FILTER (WHERE trait_side = 'text') * count(*) FILTER (WHERE trait_side = 'image') AS n_pairs
FROM integrated
GROUP BY prd_id
"""

_CAST_REJECTS = "\nUNION ALL\n".join(
    f"SELECT 'catalog' AS stage, prd_id, 'cast_decimal' AS rule, '{c}' AS column_name, nullif({c}_text, '') AS detail "
    f"FROM cleaned WHERE nullif({c}_text, '') IS NOT NULL AND {c} IS NULL"
    for c in ("price", "review", "review_rating")
)

QUALITY_REJECTS = "WITH " + PIPELINE_CTES + f"""
{_CAST_REJECTS}
UNION ALL
{_rule_rejects('cleaned', 'catalog', RULES_SQL['product_raw'])}
UNION ALL
SELECT 'traits_text', prd_id, 'model_error', NULL, error FROM replies_text WHERE NOT status
UNION ALL
{_rule_rejects('parsed_text', 'traits_text', RULES_SQL['products_trait_text'])}
UNION ALL
SELECT 'traits_image', prd_id, 'model_error', NULL, error FROM replies_image WHERE NOT status
UNION ALL
{_rule_rejects('parsed_image', 'traits_image', RULES_SQL['products_trait_image'])}
UNION ALL
{_rule_rejects('joined', 'integrate', RULES_SQL['products_trait_information'])}
"""

REQUESTS_TEXT = "WITH " + PIPELINE_CTES + """
SELECT prd_id,
       'trait-model' AS model,
       'What can you tell me about "' || prd_name || '" ?' AS user_text,
       CAST(2 AS INTEGER) AS n_messages
FROM product_raw
WHERE prd_img IS NOT NULL AND length(prd_name) % 5 <> 0 AND length(prd_name) % 7 <> 0
"""

DATA_URL = "'data:image/jpeg;base64,' || to_base64(encode(text))"

DATA_URL_DOCUMENTS = f"""
SELECT doc_id, CAST(length({DATA_URL}) AS INTEGER) AS url_chars, sha256({DATA_URL}) AS url_sha256 FROM documents
"""

REQUESTS_IMAGE = f"""
SELECT CAST(doc_id AS VARCHAR) AS prd_id,
       CASE WHEN length(text) % 3 <> 0 THEN 'What can you tell me about this image?' END AS question,
       CASE WHEN length(text) % 3 <> 0 THEN sha256({DATA_URL}) END AS url_sha256,
       CASE WHEN length(text) % 3 = 0 THEN 'missing_image' END AS reject
FROM documents
"""

CATALOG_CSV_SCAN = f"""
SELECT r.order_key AS prd_id,
       CASE length(r.name) % 3 WHEN 0 THEN replace(r.name, ' ', chr(10)) WHEN 1 THEN '"' || r.name || '",' || chr(10) ELSE r.name END AS name,
       r.price3 AS price, r.rating, nullif(r.rating_value, '') AS rating_value, 'https://img.example/d/' || p.p_brand AS image2
FROM ({raw_catalog_select()}) r JOIN part p ON CAST(p.p_partkey AS VARCHAR) = r.order_key
"""

ORACLE_SQL.update(
    {
        "integrate_traits": INTEGRATE_TRAITS,
        "masked_concat": MASKED_CONCAT,
        "entity_documents": ENTITY_DOCUMENTS,
        "distinct_products": DISTINCT_PRODUCTS,
        "quality_rejects": QUALITY_REJECTS,
        "requests_text": REQUESTS_TEXT,
        "data_url_documents": DATA_URL_DOCUMENTS,
        "requests_image": REQUESTS_IMAGE,
        "catalog_csv_scan": CATALOG_CSV_SCAN,
    }
)


# --- model jobs with the deterministic doubles ---------------------------------

INFER_TRAITS = "WITH " + PIPELINE_CTES + """,
echoed AS (
    SELECT prd_id, prd_name, string_split(prd_name, ' ') AS words
    FROM product_raw
    WHERE prd_img IS NOT NULL
)
SELECT words[-1] AS category1, CAST(NULL AS VARCHAR) AS category2, words[1] AS color,
       prd_name AS style, CAST(NULL AS VARCHAR) AS material, 'unknown' AS occasion, prd_id
FROM echoed
WHERE words[1] <> 'hot'
  AND coalesce(length(words[-1]) <= 30, true) AND coalesce(length(words[1]) <= 50, true)
  AND coalesce(length(prd_name) <= 50, true) AND length(prd_id) <= 30
"""

LETTER_VECTOR = (
    "list_concat([CAST(length(prd_text) AS DOUBLE)], [CAST(length(prd_text) - length(replace(lower(prd_text), c, '')) AS DOUBLE) "
    "for c in string_split('a b c d e f g h i j k l m n o p q r s t u v w x y z', ' ')])"
)

ENCODED = "WITH " + PIPELINE_CTES + f""",
docs AS (
    SELECT prd_id, 'product_name' AS prd_tag, min(prd_name) AS prd_text FROM integrated GROUP BY prd_id
    UNION
    SELECT DISTINCT prd_id, CASE WHEN trait_side = 'text' THEN 'product_text' ELSE 'product_image' END AS prd_tag,
           {_masked()} AS prd_text
    FROM integrated
),
encoded AS (
    SELECT CAST('0x' || substr(md5(concat_ws(chr(31), prd_tag, prd_id, prd_text)), 1, 15) AS BIGINT) AS id, prd_id, prd_tag, prd_text,
           {LETTER_VECTOR} AS v
    FROM docs
)"""

ENCODE_ENTITIES = ENCODED + """
SELECT id, prd_id, prd_tag, prd_text, list_sum(v) AS vector_sum, round(sqrt(list_dot_product(v, v)), 6) AS norm, NULL AS reject
FROM encoded
WHERE length(prd_id) <= 50 AND length(prd_text) <= 500 AND length(prd_text) % 11 <> 0
UNION ALL
SELECT NULL, prd_id, NULL, NULL, NULL, NULL, 'max_len length ' || length(prd_text) || ' > 500' FROM encoded WHERE length(prd_text) > 500
UNION ALL
SELECT NULL, prd_id, NULL, NULL, NULL, NULL, 'max_len length ' || length(prd_id) || ' > 50' FROM encoded WHERE length(prd_id) > 50
UNION ALL
SELECT NULL, prd_id, NULL, NULL, NULL, NULL, 'dim dim 26 != 27' FROM encoded WHERE length(prd_text) % 11 = 0
"""

END_TO_END_SCORES = ENCODED + SIMILARITY_SCORES.replace("WITH " + ENTITIES, """,
entities AS (
    SELECT id, prd_id, prd_tag, v FROM encoded
    WHERE length(prd_id) <= 50 AND length(prd_text) <= 500 AND length(prd_text) % 11 <> 0
)""").replace(
    "list_cosine_similarity(q.v, e.v)",
    "CASE WHEN list_dot_product(q.v, q.v) > 0 AND list_dot_product(e.v, e.v) > 0 THEN list_cosine_similarity(q.v, e.v) END",
)

INFER_IMAGE_TRAITS = """
SELECT substr(md5(text), 1, 12) AS category1, CAST(NULL AS VARCHAR) AS category2, CAST(strlen(text) AS VARCHAR) AS color,
       CAST(NULL AS VARCHAR) AS style, CAST(NULL AS VARCHAR) AS material, 'unknown' AS occasion, CAST(doc_id AS VARCHAR) AS prd_id
FROM documents WHERE length(text) % 3 <> 0 AND strlen(text) % 13 <> 0
"""

ORACLE_SQL.update({"infer_image_traits": INFER_IMAGE_TRAITS, "infer_traits": INFER_TRAITS, "encode_entities": ENCODE_ENTITIES, "end_to_end_scores": END_TO_END_SCORES})

# --- tables written in two runs: what is read back is what was written last ------------

STORED_TRAITS = "WITH " + traits_cte("text") + "," + traits_cte("image") + """
SELECT *, 'text' AS side FROM traits_text UNION ALL SELECT *, 'image' AS side FROM traits_image
"""

ORACLE_SQL.update({"stored_traits": STORED_TRAITS, "stored_information": INTEGRATE_TRAITS, "stored_scores": SIMILARITY_SCORES})
