"""The wired queries once more, in SQL over the driver's tables."""

from __future__ import annotations

import re

from kindred.functions.stop_words import ENGLISH
from kindred_checks.wiring import CONTENT_ID, KIND, KINDS, TEXT, USER

ORACLES: dict[str, str] = {}


def oracle(name: str, body: str, *ctes: str) -> None:
    ORACLES[name] = (f"WITH {', '.join(ctes)} " if ctes else "") + body


CONTENT = """content AS (
    SELECT CAST(p_partkey AS VARCHAR) AS content_id, p_brand || ' ' || p_name AS description,
           CAST(p_size + 1970 AS INTEGER) AS release_year, lower(p_type) AS type, p_name AS title
    FROM part)"""
DOCS = """docs AS (
    SELECT CAST(doc_id AS VARCHAR) AS content_id, text AS description,
           CAST(NULL AS INTEGER) AS release_year, lang AS type, source AS title
    FROM documents)"""
PLAYS = """plays AS (
    SELECT CAST(o_custkey AS VARCHAR) AS user_id, lower(p_type) AS type,
           CAST(l_partkey AS VARCHAR) AS content_id, l_quantity AS playtime, o_orderdate AS rating_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
RATINGS = """ratings AS (
    SELECT user_id, type, content_id,
           CAST(ceil(playtime / max(playtime) OVER (PARTITION BY user_id) * 10) AS DOUBLE) AS rating,
           rating_date
    FROM plays WHERE playtime > 0)"""
MERGED = """merged AS (
    SELECT trim(lower(user_id)) AS user_id, lower(type) AS type, content_id, rating, rating_date
    FROM ratings
    UNION ALL
    SELECT trim(lower(' User-' || user_id)), lower(event_type), json_extract_string(props, '$.k'),
           value, ts
    FROM events)"""
MERGED_CONTENT = """merged_content AS (SELECT * FROM content UNION ALL SELECT * FROM docs)"""
ALL_RATINGS = (PLAYS, RATINGS, MERGED)
RATING_EDGES = """rating_edges AS (
    SELECT DISTINCT r.content_id AS src_id, r.type AS src_type,
           CASE WHEN rating >= 8 THEN 'like' ELSE 'dislike' END AS rel,
           user_id AS dst_id, r.type AS dst_type
    FROM ratings r JOIN content c ON r.content_id = c.content_id AND r.type = c.type
    WHERE rating >= 1)"""
KEYWORD_EDGES = """keyword_edges AS (
    SELECT DISTINCT content_id AS src_id, type AS src_type, 'has_keyword' AS rel,
           unnest(string_split(title, ' ')) AS dst_id, CAST(NULL AS VARCHAR) AS dst_type
    FROM content)"""
EDGES = (CONTENT, PLAYS, RATINGS, RATING_EDGES, KEYWORD_EDGES)
PAIRS = """pairs AS (
    SELECT 'content|' || src_type || '|' || src_id AS a, 'users|' || dst_type || '|' || dst_id AS b
    FROM rating_edges WHERE rel = 'like'
    UNION ALL
    SELECT 'content|' || src_type || '|' || src_id, 'keyword||' || dst_id FROM keyword_edges)"""
GRAPH = """graph AS MATERIALIZED (
    SELECT a AS src, b AS dst FROM pairs UNION ALL SELECT b, a FROM pairs)"""
VECTORS = """vectors AS (
    SELECT content.*, CAST(embedding AS DOUBLE[]) AS embedding
    FROM content JOIN embeddings ON content_id = CAST(vec_id AS VARCHAR))"""
NODES = """nodes AS MATERIALIZED (
    SELECT 'content|' || type || '|' || content_id AS node FROM content
    UNION SELECT 'users|' || r.type || '|' || user_id FROM ratings r JOIN content c
      ON r.content_id = c.content_id AND r.type = c.type
    UNION SELECT 'keyword||' || dst_id FROM keyword_edges)"""
LIKERS = """likers AS (
    SELECT src_id AS content_id, src_type AS type, count(DISTINCT dst_id) AS total_users
    FROM rating_edges WHERE rel = 'like' GROUP BY ALL)"""
KIND_LIST = ", ".join(f"'{k}'" for k in KINDS)


def counted(table: str, column: str) -> str:
    return f'SELECT {column}, count(*) AS "count" FROM {table} GROUP BY {column}'


# --- ratings -----------------------------------------------------------------------------------

oracle("playtime_rating", "SELECT * FROM ratings", PLAYS, RATINGS)
oracle("merged_ratings", "SELECT * FROM merged", *ALL_RATINGS)
oracle("merged_content", "SELECT * FROM merged_content", CONTENT, DOCS, MERGED_CONTENT)
oracle(
    "merged_content_capped",
    """SELECT * FROM (
         SELECT *, CAST(row_number() OVER (PARTITION BY type ORDER BY content_id, title) AS INTEGER) AS rank
         FROM merged_content)
       WHERE rank <= 5""",
    CONTENT, DOCS, MERGED_CONTENT,
)
oracle("unique_content", "SELECT * FROM content", CONTENT)
oracle("count_ratings_by_type", counted("merged", "type"), *ALL_RATINGS)
oracle("count_content_by_type", counted("merged_content", "type"), CONTENT, DOCS, MERGED_CONTENT)
oracle("count_by_user", counted("merged", "user_id"), *ALL_RATINGS)
oracle(
    "domains_per_user",
    """SELECT user_id, count(DISTINCT type) AS "count" FROM (
         SELECT regexp_replace(lower(user_id), '[^a-zA-Z0-9]', '', 'g') AS user_id, type FROM merged)
       GROUP BY user_id""",
    *ALL_RATINGS,
)
oracle("user_by_type", counted(f"(SELECT * FROM merged WHERE user_id = '{USER}')", "type"), *ALL_RATINGS)
oracle(
    "titles_in_order",
    f"""SELECT content_id, title, CAST(row_number() OVER (ORDER BY title, content_id) AS INTEGER) AS place
        FROM content WHERE type = '{KIND}' ORDER BY title, content_id LIMIT 20""",
    CONTENT,
)
oracle("first_ids", "SELECT p_partkey FROM part ORDER BY p_partkey LIMIT 150")
oracle(
    "sample_rows",
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE left(md5(l_orderkey || ':' || l_linenumber), 2) = '07'",
)

_SALES = """sales AS (
    SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag,
           ('0x' || left(md5('{seed}:' || l_orderkey || ':' || l_linenumber || ':' || l_partkey), 13))::BIGINT AS draw
    FROM lineitem)"""
_SOLD = "SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM sales "
_DRAWN = "ORDER BY draw, l_orderkey, l_linenumber, l_partkey"
oracle("sample_exactly", f"{_SOLD} {_DRAWN} LIMIT 1000", _SALES.format(seed="rows"))
oracle(
    "sample_per_flag", f"{_SOLD} QUALIFY row_number() OVER (PARTITION BY l_returnflag {_DRAWN}) <= 50",
    _SALES.format(seed="flags"),
)
oracle("sample_fraction", f"{_SOLD} WHERE draw / pow(16, 13) < 0.05", _SALES.format(seed="5"))

# --- scalar functions ----------------------------------------------------------------------------

oracle(
    "parse_props",
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
              CASE WHEN json_exists(props, '$.personaname')
                   THEN json_extract_string(props, '$.personaname') ELSE 'Unknown' END AS name
       FROM events WHERE length(props) > 2""",
)
oracle(
    "dates_and_years",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS first_year,
              CAST(year(o_orderdate) AS INTEGER) AS last_year, CAST(o_orderdate AS DATE) AS iso_date,
              date_trunc('second', o_orderdate) AS epoch_date
       FROM orders""",
)
_HTML = "html"
for _entity, _char in (
    ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&"), ("&amp", "&"),
):
    _HTML = f"replace({_HTML}, '{_entity}', '{_char}')"
oracle("unescape_html", f"SELECT page_id, {_HTML} AS html FROM pages")
oracle(
    "embedding_sums",
    """SELECT sum, count(*) AS "count" FROM (
         SELECT round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS sum FROM embeddings)
       GROUP BY sum""",
)
oracle(
    "cosine_to_next",
    """SELECT a.vec_id, printf('%.2f', a.vec_id / 8) AS shown,
              round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6)
                AS similarity
       FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)

# --- domains -------------------------------------------------------------------------------------

oracle(
    "movie_ratings",
    """SELECT 'Doe, J. ' || user_id AS user_id, 'movie' AS type, content_id, playtime AS rating,
              date_trunc('day', rating_date) AS rating_date
       FROM plays WHERE playtime > 1""",
    PLAYS,
)
oracle(
    "movie_content",
    """SELECT CAST(p_partkey AS VARCHAR) AS content_id, p_brand AS description,
              TRY_CAST(left(p_size || '85-01-31', 4) AS INTEGER) AS release_year, 'movie' AS type,
              p_name AS title
       FROM part""",
)
oracle(
    "anime_ratings",
    """SELECT CAST(user_id AS VARCHAR) AS user_id, 'anime' AS type,
              CAST(event_id AS VARCHAR) AS content_id, CAST(floor(value) AS DOUBLE) AS rating,
              date_trunc('second', ts) AS rating_date
       FROM events""",
)
oracle(
    "anime_content",
    """SELECT CAST(p_partkey AS VARCHAR) AS content_id, p_brand AS description,
              CAST(p_size + 1970 AS INTEGER) AS release_year, 'anime' AS type, p_name AS title
       FROM part WHERE p_size > 9""",
)
oracle(
    "videogame_ratings",
    """SELECT user_id, 'videogame' AS type, CAST(l_partkey AS VARCHAR) AS content_id,
              CAST(ceil(playtime / max(playtime) OVER (PARTITION BY user_id) * 10) AS DOUBLE) AS rating,
              CAST(NULL AS TIMESTAMP) AS rating_date
       FROM (SELECT CASE WHEN c_nationkey < 10 THEN 'Unknown' ELSE c_name END AS user_id, l_partkey,
                    CAST(l_quantity AS BIGINT) - 1 AS playtime
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             WHERE c_nationkey >= 5)
       WHERE playtime > 0""",
)
oracle(
    "videogame_content",
    """SELECT CAST(p_partkey AS VARCHAR) AS content_id,
              CASE WHEN p_size > 20 THEN p_brand ELSE '' END AS description,
              CASE WHEN p_size >= 10 THEN CAST(1900 + p_size AS INTEGER) END AS release_year,
              'videogame' AS type, p_name AS title
       FROM part""",
)
oracle(
    "boardgame_ratings",
    """SELECT user_id, 'boardgame' AS type, content_id,
              CASE WHEN playtime <= 40 THEN playtime END AS rating,
              date_trunc('second', rating_date) AS rating_date
       FROM plays""",
    PLAYS,
)
oracle(
    "boardgame_content",
    """SELECT CAST(p_partkey AS VARCHAR) AS content_id, p_brand || ' & more' AS description,
              p_size AS release_year, 'boardgame' AS type, p_name AS title
       FROM part""",
)

oracle(
    "boardgame_reviews",
    """SELECT content_id AS game_id, user_id AS username, CASE WHEN playtime <= 40 THEN playtime END AS rating
       FROM plays""",
    PLAYS,
)
oracle("anime_reviews", "SELECT content_id AS anime_id, user_id AS username FROM plays", PLAYS)
oracle("id_export", "SELECT p_partkey AS id FROM part")
oracle("latest_snapshot", "SELECT p_partkey AS id FROM part")

# --- edges and nodes -----------------------------------------------------------------------------

oracle(
    "user_content",
    """SELECT user_id, m.type, m.content_id, rating
       FROM merged m JOIN content c ON m.type = c.type AND m.content_id = c.content_id""",
    CONTENT, *ALL_RATINGS,
)
oracle(
    "user_content_right",
    f"""SELECT r.user_id, r.type, r.content_id, r.rating
        FROM (SELECT 'user-' || user_id AS user_id, '{KIND}' AS type,
                     json_extract_string(props, '$.k') AS content_id, value AS rating FROM events) r
        RIGHT JOIN content c ON r.type = c.type AND r.content_id = c.content_id""",
    CONTENT,
)
oracle("rating_edges", "SELECT * FROM rating_edges", *EDGES)
oracle("keyword_edges", "SELECT * FROM keyword_edges", CONTENT, KEYWORD_EDGES)
oracle(
    "keyword_edges_of_incomplete_rows",
    """SELECT 'content' AS label, type, content_id AS key, 'keyword||' || keyword AS dst FROM links
       UNION ALL SELECT 'keyword', NULL, keyword, 'content|' || type || '|' || content_id FROM links""",
    CONTENT,
    """links AS (
        SELECT DISTINCT content_id, type, keyword
        FROM (SELECT content_id, type, unnest(string_split(title, ' ')) AS keyword FROM content)
        WHERE content_id::INT % 5 <> 0 AND content_id::INT % 7 <> 0 AND length(keyword) > 4)""",
)
oracle("undirected_graph", "SELECT src, dst FROM graph", *EDGES, PAIRS, GRAPH)
oracle(
    "node_tables",
    """SELECT 'content' AS label, content_id AS key, type, title FROM content
       UNION ALL SELECT DISTINCT 'users', user_id, NULL, NULL FROM ratings
       UNION ALL SELECT DISTINCT 'keyword', dst_id, NULL, NULL FROM keyword_edges""",
    CONTENT, PLAYS, RATINGS, KEYWORD_EDGES,
)
oracle(
    "upsert_nodes",
    """SELECT coalesce(p.p_partkey, n.p_partkey) AS p_partkey, coalesce(n.p_size, p.p_size) AS p_size,
              p_retailprice
       FROM part p FULL JOIN (
         SELECT l_partkey AS p_partkey,
                CASE WHEN max(l_quantity) < 50 THEN CAST(max(l_quantity) AS INTEGER) END AS p_size
         FROM lineitem GROUP BY l_partkey) n ON p.p_partkey = n.p_partkey""",
)
oracle(
    "upsert_last_row",
    """SELECT p.p_partkey, coalesce(n.p_size, p.p_size) AS p_size, p_retailprice, coalesce(n.sale, 0) AS sale, discount
       FROM part p LEFT JOIN (
         SELECT l_partkey, l_orderkey * 10 + l_linenumber AS sale, l_discount AS discount,
                CASE WHEN l_quantity < 30 THEN CAST(l_quantity AS INTEGER) END AS p_size
         FROM lineitem
         QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey * 10 + l_linenumber DESC) = 1) n
       ON p.p_partkey = n.l_partkey""",
)
ORACLES["upsert_bucketed"] = ORACLES["upsert_nodes"]
oracle("frontier_stored", "SELECT DISTINCT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
oracle("frontier", "SELECT DISTINCT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
oracle("high_water_mark", "SELECT max(o_orderkey) AS o_orderkey FROM orders")
oracle("distinct_raters", "SELECT DISTINCT content_id, user_id FROM plays", PLAYS)
oracle(
    "page_count",
    "SELECT l_suppkey, CAST(ceil(count(*) / 100) AS BIGINT) AS pages FROM lineitem GROUP BY l_suppkey",
)

# --- charts and recommendation -------------------------------------------------------------------

oracle(
    "liker_count",
    f"""SELECT count(DISTINCT dst_id) AS total_users FROM rating_edges
        WHERE rel = 'like' AND src_id = '{CONTENT_ID}' AND src_type = '{KIND}'""",
    *EDGES,
)
oracle("content_likers", "SELECT * FROM likers", *EDGES, LIKERS)
oracle(
    "top_by_popularity",
    """SELECT * FROM (
         SELECT content.*, total_users, CAST(row_number() OVER (
                  PARTITION BY type ORDER BY total_users DESC, content_id) AS INTEGER) AS rank
         FROM likers JOIN content USING (content_id, type))
       WHERE rank <= 5""",
    *EDGES, LIKERS,
)
_FOUND = """SELECT * FROM {table} WHERE contains(lower(title), '{text}') {kind}
            ORDER BY length(title), title, content_id, type LIMIT 1"""
oracle("find_content", _FOUND.format(table="content", text=TEXT, kind=f"AND type = '{KIND}'"), CONTENT)
oracle("find_content_any_kind", _FOUND.format(table="content", text=TEXT, kind=""), CONTENT)
oracle(
    "find_contents",
    """SELECT p_partkey, text, kind, content_id, type, title FROM texts JOIN content
         ON contains(lower(title), lower(text)) AND (kind IS NULL OR kind = type)
       QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY length(title), title, content_id, type) = 1""",
    CONTENT,
    """texts AS (
        SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN lower(p_type) END AS kind,
               CASE WHEN p_partkey % 11 = 0 THEN 'no ' || p_name WHEN p_partkey % 7 = 0 THEN upper(substr(p_name, 2, 2))
                    WHEN p_partkey % 13 = 0 THEN left(p_name, 1) WHEN p_partkey % 17 = 0 THEN ''
                    ELSE substr(p_name, 3, 6) END AS text
        FROM part)""",
)
ORIGIN = f"""origin AS ({_FOUND.format(table='vectors', text=TEXT, kind=f"AND type = '{KIND}'")})"""


def similar(origins: str, candidates: str, k: int) -> str:
    return f"""matches AS (
        SELECT * FROM (
          SELECT *, CAST(row_number() OVER (
                   PARTITION BY origin_id, origin_type, type
                   ORDER BY similarity DESC, title, content_id) AS INTEGER) AS rank
          FROM (
            SELECT o.content_id AS origin_id, o.type AS origin_type, c.content_id, c.type, c.title,
                   round(list_cosine_similarity(o.embedding, c.embedding), 6) AS similarity
            FROM {origins} o JOIN {candidates} c
              ON (o.content_id, o.type) <> (c.content_id, c.type) AND c.type IN ({KIND_LIST})))
        WHERE rank <= {k})"""


KEYWORD_LIST = """keyword_list AS (
    SELECT src_id AS content_id, src_type AS type,
           array_to_string(list_transform(list_sort(list(DISTINCT dst_id)),
             lambda k: upper(left(k, 1)) || lower(substr(k, 2))), ', ') AS keywords
    FROM keyword_edges GROUP BY ALL)"""
oracle("similar_content", "SELECT * FROM matches", CONTENT, VECTORS, ORIGIN, similar("origin", "vectors", 8))
oracle(
    "similar_content_batch", "SELECT * FROM matches", CONTENT, VECTORS,
    similar("(SELECT * FROM vectors WHERE content_id::BIGINT % 50 = 0)", "vectors", 2),
)
ORACLES["similar_content_all_lists"] = ORACLES["similar_content_batch"]
oracle(
    "similar_content_recall",
    "SELECT count(DISTINCT (origin_id, origin_type)) AS origins, count(*) AS wanted, true AS enough FROM matches",
    CONTENT, VECTORS, similar("(SELECT * FROM vectors WHERE content_id::BIGINT % 50 = 0)", "vectors", 2),
)
_WITH_KEYWORDS = (
    CONTENT, VECTORS, KEYWORD_EDGES, KEYWORD_LIST, ORIGIN,
    "tagged AS (SELECT vectors.* FROM vectors SEMI JOIN keyword_list USING (content_id, type))",
    similar("origin", "tagged", 2),
)
oracle(
    "similar_with_keywords",
    """SELECT matches.*, content.description, keywords
       FROM matches JOIN content USING (content_id, type) JOIN keyword_list USING (content_id, type)""",
    *_WITH_KEYWORDS,
)
oracle(
    "recommendations",
    f"""SELECT CAST(list_position([{KIND_LIST}], type) AS INTEGER) AS kind_rank, rank, content_id, type,
               title, similarity
        FROM matches""",
    *_WITH_KEYWORDS,
)
oracle(
    "content_profile",
    f"""SELECT content_id, type, title, description, keywords
        FROM content JOIN keyword_list USING (content_id, type)
        WHERE content_id = '{CONTENT_ID}' AND type = '{KIND}'""",
    CONTENT, KEYWORD_EDGES, KEYWORD_LIST,
)

# --- keywords ------------------------------------------------------------------------------------


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def singular(w: str) -> str:
    return f"CASE WHEN length({w}) > 3 AND {w} LIKE '%s' THEN left({w}, length({w}) - 1) ELSE {w} END"


# As the texts are cut: sentences, tokens, words.
SENTENCE_END = '[.!?\\n]+'
TOKEN = "[\\p{L}\\p{N}]+(?:['’-][\\p{L}\\p{N}]+)*|[^\\p{L}\\p{N}\\s]+"
WORD = '[\\p{L}\\p{N}]'
_STOP = ", ".join(map(quoted, ENGLISH))
_SENTENCES = SENTENCE_END.replace("\\n", "\n")
KEYWORDS = (
    f"""texts AS (
        SELECT doc_id, list_filter(regexp_split_to_array(text, {quoted(_SENTENCES)}),
                                   lambda s: regexp_matches(s, {quoted(WORD)})) AS sents
        FROM documents)""",
    """split AS (
        SELECT doc_id, len(sents) AS n_sentences, unnest(sents) AS sent,
               unnest(range(len(sents))) AS sentence FROM texts)""",
    f"""tokens AS (
        SELECT * EXCLUDE (sent), regexp_extract_all(sent, {quoted(TOKEN)}) AS tk FROM split)""",
    f"""termed AS (
        SELECT *, list_transform(tk, lambda t: CASE WHEN regexp_matches(t, {quoted(WORD)})
                  AND NOT regexp_matches(t, '\\p{{N}}') THEN {singular('lower(t)')} END) AS tm
        FROM tokens)""",
    """spread AS (
        SELECT doc_id, n_sentences, sentence, tm, unnest(tk) AS w, unnest(range(len(tk))) AS i
        FROM termed)""",
    f"""words AS (
        SELECT doc_id, n_sentences, sentence, lower(w) AS low, {singular('lower(w)')} AS term,
               tm[i + 1] IS NOT NULL AS plain,
               CASE WHEN tm[i + 1] IS NOT NULL AND i > 0 THEN tm[i] END AS l,
               CASE WHEN tm[i + 1] IS NOT NULL THEN tm[i + 2] END AS r,
               w = upper(w) AS acronym,
               i > 0 AND w <> lower(w) AND length(w) > 1
                 AND lower(left(w, 1)) || substr(w, 2) = lower(w) AS capital
        FROM spread WHERE regexp_matches(w, {quoted(WORD)}))""",
    f"""terms AS (
        SELECT doc_id, term, any_value(n_sentences) AS n_sentences, count(*) AS tf,
               count(*) FILTER (plain) AS plain,
               count(*) FILTER (plain AND low = term) AS tf_singular,
               count(*) FILTER (plain AND acronym) AS acronyms,
               count(*) FILTER (plain AND capital AND NOT acronym) AS capitals,
               median(DISTINCT sentence) AS middle, count(DISTINCT sentence) AS spread,
               coalesce(count(DISTINCT l) / nullif(count(l), 0), 0)
                 + coalesce(count(DISTINCT r) / nullif(count(r), 0), 0) AS sides,
               bool_or(low IN ({_STOP}) OR term IN ({_STOP}) OR length(term) < 3) AS stop
        FROM words GROUP BY doc_id, term)""",
    """per_doc AS (
        SELECT doc_id, max(tf) AS max_tf,
               avg(tf) FILTER (NOT stop) + stddev_pop(tf) FILTER (NOT stop) AS usual_tf
        FROM terms GROUP BY doc_id)""",
    """features AS (
        SELECT doc_id, term, tf_singular, plain, 1 + sides * tf / max_tf AS rel,
               ln(ln(3 + middle)) AS pos, greatest(acronyms, capitals) / (1 + ln(tf)) AS casing,
               tf / usual_tf AS freq, spread / n_sentences AS disp
        FROM terms JOIN per_doc USING (doc_id) WHERE NOT stop AND plain > 0)""",
    """scored AS (
        SELECT *, rel * pos / (casing + freq / rel + disp / rel) AS s FROM features)""",
    """candidates AS (
        SELECT doc_id, keyword, round(s / (n * (1 + s)), 6) AS score FROM (
          SELECT doc_id, s, term AS keyword, tf_singular AS n FROM scored
          UNION ALL SELECT doc_id, s, term || 's', plain - tf_singular FROM scored)
        WHERE n > 0)""",
)
oracle(
    "top_keywords_all_spellings",
    """SELECT * FROM (
         SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score, keyword) AS INTEGER) AS rank
         FROM candidates)
       WHERE rank <= 15""",
    *KEYWORDS,
)
# levenshtein() counts bytes here: spell the accented letters of the texts with one byte each.
_ACCENTED, _BYTES = "éèêßçäóñíüö", "0123456789#"


def one_byte(w: str) -> str:
    return f"translate({w}, '{_ACCENTED}', '{_BYTES}')"


DISTINCT_KEYWORDS = (
    *KEYWORDS,
    f"""listed AS (
        SELECT doc_id, list({{'score': score, 'keyword': keyword}} ORDER BY score, keyword) AS found
        FROM candidates GROUP BY doc_id)""",
    f"""best AS (
        SELECT doc_id, list_reduce(found, lambda kept, c: CASE
                 WHEN len(kept) < 15 AND len(list_filter(kept, lambda k:
                   1 - levenshtein({one_byte('k.keyword')}, {one_byte('c.keyword')})
                     / greatest(length(k.keyword), length(c.keyword)) > 0.9)) = 0
                 THEN list_append(kept, c) ELSE kept END,
                 CAST([] AS STRUCT(score DOUBLE, keyword VARCHAR)[])) AS kept
        FROM listed)""",
    """distinct_keywords AS (
        SELECT doc_id, k.keyword AS keyword, k.score AS score, CAST(n AS INTEGER) AS rank
        FROM (SELECT doc_id, unnest(kept) AS k, unnest(range(1, len(kept) + 1)) AS n FROM best))""",
)
oracle("top_keywords", "SELECT * FROM distinct_keywords", *DISTINCT_KEYWORDS)
oracle(
    "keyword_columns",
    "SELECT doc_id, "
    + ", ".join(f"max(keyword) FILTER (rank = {i}) AS keyword_{i}" for i in range(1, 6))
    + " FROM distinct_keywords GROUP BY doc_id",
    *DISTINCT_KEYWORDS,
)

# --- graph scores --------------------------------------------------------------------------------


def rank_rounds(extra: str, rounds: int = 20) -> tuple[str, ...]:
    """One CTE per round; r0 holds the start value."""
    ctes = [
        "degree AS MATERIALIZED (SELECT src AS node, count(*) AS deg FROM graph GROUP BY src)",
        "average AS MATERIALIZED (SELECT (SELECT count(*) FROM graph) / (SELECT count(*) FROM nodes) AS avg_deg)",
        f"""hops AS MATERIALIZED (
            SELECT src, dst, 0.85 / (deg + {extra}) AS share FROM graph
            JOIN degree ON src = node CROSS JOIN average)""",
        "r0 AS MATERIALIZED (SELECT node, CAST(0.15 AS DOUBLE) AS score FROM nodes)",
    ]
    ctes += [
        f"""r{i} AS MATERIALIZED (
            SELECT n.node, 0.15 + coalesce(got, 0) AS score
            FROM nodes n LEFT JOIN (
              SELECT dst, sum(CAST(share AS DOUBLE) * score) AS got
              FROM hops JOIN r{i - 1} ON src = node GROUP BY dst) ON dst = n.node)"""
        for i in range(1, rounds + 1)
    ]
    return tuple(ctes)


def article_rounds() -> tuple[str, ...]:
    """The rounds of ArticleRank beside those of PageRank."""
    tables = rank_rounds("avg_deg")[2:]
    return tuple(re.sub(r"\br(\d+)\b", r"a\1", t).replace("hops", "article_hops") for t in tables)


PAGE_RANK = (*EDGES, PAIRS, GRAPH, NODES, *rank_rounds("0"))
RANKED = """ranked AS (
    SELECT c.content_id, c.type, c.title, round(score, 6) AS pagerank
    FROM content c LEFT JOIN r20 ON node = 'content|' || c.type || '|' || c.content_id)"""
oracle("page_rank", "SELECT node, round(score, 6) AS pagerank FROM r20", *PAGE_RANK)
oracle(
    "article_rank",
    "SELECT node, round(score, 6) AS centrality FROM r20",
    *EDGES, PAIRS, GRAPH, NODES, *rank_rounds("avg_deg"),
)
oracle(
    "both_ranks",
    "SELECT node, round(r.score, 6) AS pagerank, round(a20.score, 6) AS centrality FROM r20 r JOIN a20 USING (node)",
    *PAGE_RANK, *article_rounds(),
)


def settled_rounds(extra: str, name: str, tolerance: float, most: int = 60) -> tuple[str, ...]:
    """More rounds than it takes: those after the last one that moves change nothing."""
    rounds = [f"{name}0 AS MATERIALIZED (SELECT node, 0.15::DOUBLE AS score, 0.15::DOUBLE AS moved FROM nodes)"]
    for i in range(1, most + 1):
        rounds.append(f"""{name}{i} AS MATERIALIZED (
            SELECT s.node, score + coalesce(came, 0) AS score, coalesce(came, 0) AS moved
            FROM {name}{i - 1} s LEFT JOIN (
              SELECT dst AS node, sum(0.85::DOUBLE * moved / (deg + {extra})) AS came
              FROM {name}{i - 1} p JOIN graph ON src = p.node JOIN deg ON deg.src = p.node, mean
              WHERE abs(moved) > {tolerance} GROUP BY dst) m USING (node))""")
    return tuple(rounds)


oracle(
    "both_ranks_settled",
    "SELECT node, round(p.score, 6) AS pagerank, round(c.score, 6) AS centrality FROM p60 p JOIN c60 c USING (node)",
    *EDGES, PAIRS, GRAPH, NODES,
    "deg AS MATERIALIZED (SELECT src, count(*) AS deg FROM graph GROUP BY src)",
    "mean AS MATERIALIZED (SELECT (SELECT count(*) FROM graph) / greatest((SELECT count(*) FROM nodes), 1) AS avg_deg)",
    *settled_rounds("0", "p", 0.02), *settled_rounds("avg_deg", "c", 0.02),
)
oracle("node_property", "SELECT content_id, type, pagerank FROM ranked", *PAGE_RANK, RANKED)
oracle(
    "top_by_pagerank",
    """SELECT * FROM (
         SELECT *, CAST(row_number() OVER (PARTITION BY type ORDER BY pagerank DESC, content_id) AS INTEGER)
                  AS rank
         FROM ranked WHERE pagerank IS NOT NULL)
       WHERE rank <= 5""",
    *PAGE_RANK, RANKED,
)


def rp_round(i: int) -> tuple[str, ...]:
    return (
        f"""sum{i} AS MATERIALIZED (
            SELECT dst AS node, d, sum(v) AS v FROM graph JOIN v{i - 1} ON src = node GROUP BY dst, d)""",
        f"""norm{i} AS MATERIALIZED (SELECT node, sqrt(sum(v * v)) AS n FROM sum{i} GROUP BY node)""",
        f"""v{i} AS MATERIALIZED (
            SELECT node, d, CASE WHEN n > 0 THEN v / n ELSE 0 END AS v
            FROM sum{i} JOIN norm{i} USING (node))""",
    )


def random_projection(dim: int) -> tuple[str, ...]:
    return (
        f"digest AS (SELECT DISTINCT src AS node, b FROM graph CROSS JOIN range({dim // 8}) t(b))",
        """hashed AS (SELECT node, b, md5('7474:' || node || ':' || b) AS h FROM digest)""",
        """sides AS (
            SELECT node, b * 8 + i AS d,
                   CAST('0x' || substr(h, CAST(i * 4 + 1 AS INTEGER), 4) AS INTEGER) % 6 AS side
            FROM hashed CROSS JOIN range(8) t(i))""",
        """v0 AS MATERIALIZED (
            SELECT node, d, CASE side WHEN 0 THEN CAST(1 AS DOUBLE) WHEN 1 THEN -1 ELSE 0 END AS v
            FROM sides)""",
        *rp_round(1), *rp_round(2), *rp_round(3),
    )


oracle(
    "fast_rp",
    f"""SELECT node, coalesce(embedding, {quoted(" ".join(["0"] * 256))}) AS embedding
       FROM nodes LEFT JOIN (
         SELECT node, string_agg(CAST(CAST(round((a.v + b.v) * 1e6) AS BIGINT) AS VARCHAR), ' ' ORDER BY d) AS embedding
         FROM v2 a JOIN v3 b USING (node, d) GROUP BY node) USING (node)""",
    *EDGES, PAIRS, GRAPH, NODES, *random_projection(256),
)
oracle(
    "users_with_embedding",
    """SELECT DISTINCT r.user_id, r.type, 8 AS width, CAST(r.user_id || '|' || r.type NOT IN (
         SELECT dst_id || '|' || dst_type FROM rating_edges WHERE rel = 'like') AS INTEGER) AS zero
       FROM ratings r JOIN content c ON r.content_id = c.content_id AND r.type = c.type
       UNION ALL SELECT content_id, 'none', NULL, NULL FROM content""",
    *EDGES,
)

# --- sinks and streaming -------------------------------------------------------------------------

oracle("zone_roundtrip", "SELECT * FROM content", CONTENT)
oracle(
    "ingest_events",
    "SELECT user_id, max(event_id) AS event_id, count(*) AS events FROM events GROUP BY user_id",
)
oracle(
    "ingest_two_batches",
    """SELECT user_id, coalesce(b.event_id, a.event_id) AS event_id, coalesce(b.value, a.value) AS value
       FROM (SELECT * FROM halves WHERE half = 0) a FULL JOIN (SELECT * FROM halves WHERE half = 1) b USING (user_id)""",
    """halves AS (
        SELECT user_id, event_id % 2 AS half, event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value
        FROM events WHERE event_id % 2 = 0 OR user_id % 3 <> 0
        QUALIFY row_number() OVER (PARTITION BY user_id, event_id % 2 ORDER BY event_id DESC) = 1)""",
)
oracle(
    "ingest_compacted",
    """SELECT user_id, max_by(event_id, part) AS event_id, max_by(value, part) FILTER (value IS NOT NULL) AS value,
              max_by(event_type, part) FILTER (event_type IS NOT NULL) AS event_type
       FROM parts GROUP BY user_id""",
    """parts AS (
        SELECT user_id, event_id % 4 AS part, event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value,
               CASE WHEN event_id % 3 = 0 THEN event_type END AS event_type
        FROM events WHERE user_id % (event_id % 4 + 2) <> 0
        QUALIFY row_number() OVER (PARTITION BY user_id, event_id % 4 ORDER BY event_id DESC) = 1)""",
)
oracle(
    "zone_variants",
    """SELECT CASE p_partkey % 2 WHEN 0 THEN 'a' ELSE 'b' END AS folder, count(*) AS n,
              CAST(sum(p_partkey) AS BIGINT) AS keys, true AS one_file, true AS refused
       FROM part GROUP BY folder""",
)

# --- files of other systems ----------------------------------------------------------------------

oracle(
    "collections_files",
    """SELECT 'nr +%' || l_suppkey AS user_id, 'boardgame' AS type, CAST(l_partkey AS VARCHAR) AS content_id,
              CASE WHEN l_quantity <= 40 THEN l_quantity END AS rating, TIMESTAMP '2020-01-02 03:04:05' AS rating_date
       FROM lineitem WHERE l_suppkey <> 1""",
)
ORACLES["collections_checked"] = ORACLES["collections_files"]
oracle(
    "collections_rejects",
    """SELECT 'nr +%1' AS key, 'ends too early' AS reason, count(DISTINCT l_suppkey) - 1 AS n_good, 1::BIGINT AS n_bad
       FROM lineitem""",
)
oracle(
    "catalogue_files",
    """SELECT 'nr +%' || p_brand AS content_id, p_brand || ' & more' AS description, p_size AS release_year,
              'boardgame' AS type, p_name AS title
       FROM part""",
)
oracle(
    "review_page_files",
    """SELECT CAST(l_suppkey AS VARCHAR) AS game_id, CAST(l_orderkey AS VARCHAR) AS username,
              CASE WHEN l_quantity <= 40 THEN l_quantity END AS rating
       FROM lineitem""",
)
oracle(
    "review_json_files",
    "SELECT CAST(l_suppkey AS VARCHAR) AS anime_id, CAST(l_orderkey AS VARCHAR) AS username FROM lineitem",
)
oracle(
    "anime_list_files",
    """SELECT CAST(user_id AS VARCHAR) AS user_id, 'anime' AS type, CAST(event_id AS VARCHAR) AS content_id,
              CAST(floor(value) AS DOUBLE) AS rating, date_trunc('second', ts) AS rating_date
       FROM events WHERE user_id <> 1""",
)
ORACLES["anime_list_checked"] = ORACLES["anime_list_files"]
oracle(
    "anime_list_rejects",
    """SELECT '1' AS key, 'does not begin as expected' AS reason, count(*) FILTER (user_id <> 1) AS n_good, 1::BIGINT AS n_bad
       FROM events""",
)
oracle(
    "anime_info_files",
    """SELECT CAST(p_partkey AS VARCHAR) AS content_id, p_brand AS description,
              CAST(p_size + 1970 AS INTEGER) AS release_year, 'anime' AS type, p_name AS title
       FROM part""",
)
FIRST_PROFILES = """SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_nationkey < 10 THEN 'Unknown' ELSE c_name END AS user_id
       FROM customer WHERE c_nationkey >= 5"""
oracle("first_profiles", FIRST_PROFILES)
oracle("first_profiles_of_an_array", FIRST_PROFILES)
oracle(
    "keyed_json_lines",
    """SELECT CAST(p_partkey AS VARCHAR) AS content_id, p_brand AS description, CAST(1999 AS INTEGER) AS release_year,
              'videogame' AS type, p_name AS title
       FROM part""",
)
oracle(
    "keyed_json_objects",
    """SELECT CAST(p_partkey AS VARCHAR) AS content_id, p_brand AS description, CAST(1999 AS INTEGER) AS release_year,
              'videogame' AS type, 'a, "b" }] \\' || p_name AS title
       FROM part""",
)
oracle(
    "review_totals",
    """SELECT CAST(l_suppkey AS VARCHAR) AS game_id, count(*) AS total, CAST(ceil(count(*) / 100) AS BIGINT) AS pages
       FROM lineitem GROUP BY l_suppkey""",
)
oracle(
    "consolidated_documents",
    """SELECT '{"brand":"' || p_brand || '","n":' || count(*) || '}' AS json, true AS named FROM part GROUP BY p_brand""",
)
oracle(
    "videogame_variants",
    """SELECT CASE WHEN c_nationkey < 10 THEN 'Unknown' ELSE c_name END AS user_id, CAST(l_partkey AS VARCHAR) AS content_id,
              CAST(ceil(playtime / max(playtime) OVER (PARTITION BY o_custkey) * 10) AS DOUBLE) AS rating,
              'Steam' AS type_label, 'a, "b" }] \\' || p_name AS content_title
       FROM (SELECT c_nationkey, c_name, o_custkey, l_partkey, p_name, CAST(l_quantity AS BIGINT) - 1 AS playtime
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
             JOIN part ON l_partkey = p_partkey
             WHERE c_nationkey >= 5)
       WHERE playtime > 0""",
)

# --- the whole build -----------------------------------------------------------------------------

_BUILD_EDGES = """keyword_edges AS (
    SELECT DISTINCT split_part(doc_id, '|', 1) AS src_id, split_part(doc_id, '|', 2) AS src_type, 'has_keyword' AS rel,
           keyword AS dst_id, CAST(NULL AS VARCHAR) AS dst_type
    FROM distinct_keywords)"""
_BUILD_VECTORS = """vectors AS (
    SELECT c.content_id, c.type, c.title, embedding
    FROM content c JOIN (
      SELECT node, list(a.v + b.v ORDER BY d) AS embedding FROM v2 a JOIN v3 b USING (node, d) GROUP BY node)
    ON node = 'content|' || c.type || '|' || c.content_id)"""
oracle(
    "recommendations_end_to_end",
    f"""SELECT CAST(list_position([{KIND_LIST}], type) AS INTEGER) AS kind_rank, rank, content_id, type, title, similarity,
               keywords, round(r20.score, 6) AS pagerank, round(a20.score, 6) AS centrality
        FROM matches JOIN keyword_list USING (content_id, type)
        JOIN r20 ON r20.node = 'content|' || type || '|' || content_id
        JOIN a20 ON a20.node = r20.node""",
    CONTENT, "documents AS (SELECT content_id || '|' || type AS doc_id, description AS text FROM content)",
    *DISTINCT_KEYWORDS, PLAYS, RATINGS, RATING_EDGES, _BUILD_EDGES, PAIRS, GRAPH, NODES, KEYWORD_LIST,
    *random_projection(16), _BUILD_VECTORS,
    ORIGIN, "tagged AS (SELECT vectors.* FROM vectors SEMI JOIN keyword_list USING (content_id, type))",
    similar("origin", "tagged", 2), *rank_rounds("0"), *article_rounds(),
)
