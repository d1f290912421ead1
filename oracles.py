"""SQL twins of the queries, for DuckDB over the same tables."""

from __future__ import annotations

# White space as stripped from line ends, as a character class.
WS = (
    r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def empty_line(x: str) -> str:
    words = rf"regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+')"
    return (
        f"({strip(x)} = '' OR len(list_filter({words}, lambda w: length(w) > 2)) = 0"
        rf" OR (length({strip(x)}) < 5 AND NOT regexp_matches({x}, '\p{{L}}')))"
    )


def table_row(x: str) -> str:
    return f"(len(string_split({x}, '|')) >= 3)"


def sentence_list(x: str) -> str:
    marked = rf"""regexp_replace({x}, '([.!?]["'')\]]*)\s+', '\1' || chr(10), 'g')"""
    return f"string_split({marked}, chr(10))"


INDEX = """idx AS (
  SELECT CAST(o_custkey AS VARCHAR) AS cik,
    'Customer ' || o_custkey AS company_name,
    o_orderpriority AS form_type,
    CAST(o_orderdate AS DATE) AS date_filed,
    'edgar/data/' || o_custkey || '/' || o_orderkey || '.txt' AS idx_filename,
    CAST(o_orderkey AS VARCHAR) AS accession_number,
    o_orderstatus AS tag
  FROM orders)"""

RESULTS = """results AS (
  SELECT CAST(o_custkey AS VARCHAR) AS cik, CAST(o_orderkey AS VARCHAR) AS accession_number,
    o_orderstatus AS tag, n_trustee, selected_chunks, selected_text, response
  FROM orders JOIN (
    SELECT l_orderkey, CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS INTEGER) AS n_trustee,
      array_to_string(list_sort(list(DISTINCT l_linenumber)), ',') AS selected_chunks,
      CAST(max(l_partkey) AS VARCHAR) AS selected_text,
      CAST(min(l_suppkey) AS VARCHAR) AS response
    FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)"""

DRAWN = f"""WITH {INDEX},
companies AS (
  SELECT DISTINCT cik FROM idx
  WHERE date_filed BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
    AND cik IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer
                WHERE c_mktsegment = 'MACHINERY')),
drawn AS (
  SELECT cik FROM (
    SELECT cik, row_number() OVER (ORDER BY md5(cik || '7')) AS r, count(*) OVER () AS n
    FROM companies)
  WHERE r <= (n + 9) // 10)"""

LINES = f"""raw_lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents),
kept AS (
  SELECT doc_id, pos, {strip("line")} AS s, {table_row("line")} AS tbl
  FROM raw_lines WHERE line = '' OR NOT {empty_line("line")}),
flagged AS (
  SELECT *, tbl AND coalesce(lag(tbl) OVER (PARTITION BY doc_id ORDER BY pos), false) AS goes_on
  FROM kept),
grouped AS (
  SELECT *, sum(CASE WHEN goes_on THEN 0 ELSE 1 END)
    OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS grp
  FROM flagged),
table_pieces AS (
  SELECT doc_id, grp, 0 AS sub, string_agg(s, chr(10) ORDER BY pos) AS piece
  FROM grouped WHERE tbl GROUP BY doc_id, grp),
prose_pieces AS (
  SELECT doc_id, grp, unnest(range(len({sentence_list("s")}))) AS sub,
    unnest({sentence_list("s")}) AS piece
  FROM grouped WHERE NOT tbl AND s <> ''),
pieces AS (
  SELECT doc_id, piece,
    row_number() OVER (PARTITION BY doc_id ORDER BY grp, sub) - 1 AS chunk_num
  FROM (SELECT * FROM table_pieces UNION ALL SELECT * FROM prose_pieces))"""

# One row per filing and chunk; phrases are the first vector of each label.
PAIRS = """vecs AS (
  SELECT CAST(vec_id // 10 AS VARCHAR) AS cik, CAST(vec_id // 10 AS VARCHAR) AS accession_number,
    CAST(vec_id % 10 AS INTEGER) AS chunk_num, embedding::DOUBLE[] AS v FROM embeddings),
phrases AS (
  SELECT CAST(label AS VARCHAR) AS phrase, arg_min(embedding, vec_id)::DOUBLE[] AS q
  FROM embeddings GROUP BY label),
scored AS (
  SELECT cik, accession_number, phrase, chunk_num,
    list_cosine_distance(v, q) AS distance FROM vecs CROSS JOIN phrases),
pairs AS (
  SELECT cik, accession_number, phrase, chunk_num, distance FROM (
    SELECT *, row_number() OVER (PARTITION BY cik, accession_number
      ORDER BY round(distance, 12), chunk_num, phrase) AS r FROM scored)
  WHERE r <= 20)"""

SCORES = f"""{PAIRS},
rated AS (
  SELECT cik, accession_number, chunk_num, count(*) AS frequency, avg(distance) AS avg_distance,
    min(distance) AS min_distance, 1 / (1 + avg(distance)) AS distance_score,
    count(*) / (1 + avg(distance)) AS appearance_score
  FROM pairs GROUP BY cik, accession_number, chunk_num),
scores AS (
  SELECT *,
    row_number() OVER (PARTITION BY cik, accession_number
      ORDER BY round(distance_score, 12) DESC, round(min_distance, 12), chunk_num) AS distance_rank,
    row_number() OVER (PARTITION BY cik, accession_number
      ORDER BY round(appearance_score, 12) DESC, round(min_distance, 12), chunk_num)
      AS appearance_rank
  FROM rated)"""


def _picks(rank: str, near: bool) -> str:
    kept = "(r = 1 OR abs(chunk_num - best) = 1)" if near else "true"
    return f"""SELECT cik, accession_number,
      array_to_string(list_sort(list(chunk_num)), ',') AS selected_chunks
    FROM (SELECT cik, accession_number, chunk_num, {rank} AS r,
            first_value(chunk_num) OVER (PARTITION BY cik, accession_number ORDER BY {rank}) AS best
          FROM scores)
    WHERE r <= 3 AND {kept} GROUP BY cik, accession_number"""


CHOICES = f"""{SCORES},
listed AS (
  SELECT 0 AS ordinal, 'distance' AS method, * FROM ({_picks("distance_rank", True)})
  UNION ALL
  SELECT 1, 'appearance', * FROM ({_picks("appearance_rank", True)})
  UNION ALL
  SELECT 2, 'distance-any3', * FROM ({_picks("distance_rank", False)})
  UNION ALL
  SELECT 3, 'appearance-any3', * FROM ({_picks("appearance_rank", False)})),
choices AS (
  SELECT cik, accession_number, CAST(ordinal AS INTEGER) AS ordinal, method,
    selected_chunks AS chunks
  FROM (SELECT *, row_number() OVER (PARTITION BY cik, accession_number, selected_chunks
          ORDER BY ordinal) AS r FROM listed)
  WHERE r = 1)"""

CANDIDATES = f"""{CHOICES},
chunk_table AS (
  SELECT CAST(doc_id // 10 AS VARCHAR) AS cik, CAST(doc_id % 10 AS INTEGER) AS chunk_num,
    text AS chunk_text FROM documents),
candidates AS (
  SELECT * FROM (
    SELECT c.cik, c.accession_number, c.ordinal, c.method, c.chunks,
      string_agg(t.chunk_text, chr(10) ORDER BY t.chunk_num) AS text, count(*) AS found
    FROM (SELECT *, unnest(string_split(chunks, ',')) AS num FROM choices) c
    JOIN chunk_table t ON t.cik = c.cik AND CAST(t.chunk_num AS VARCHAR) = c.num
    GROUP BY ALL)
  WHERE found = len(string_split(chunks, ',')) AND length(text) >= 100)"""

RESPONSES = """responses AS (
  SELECT accession_number, CASE o_orderpriority
      WHEN '1-URGENT' THEN body
      WHEN '2-HIGH' THEN '```json' || chr(10) || body || chr(10) || '```'
      WHEN '3-MEDIUM' THEN 'As asked: ```json' || body || '```' || chr(10) || 'Regards'
      WHEN '4-NOT SPECIFIED' THEN '```json' || body[1:40] || '```'
      ELSE '  {"notes": "none x"}  ' END AS response
  FROM (
    SELECT CAST(o_orderkey AS VARCHAR) AS accession_number, o_orderpriority,
      '{"compensation_info_present":true,"trustees":[' ||
      array_to_string(list_transform(range(1, coalesce(n, 0) + 1),
        lambda i: '{"name":"T' || i || '"}'), ',') ||
      '],"notes":"' || o_orderpriority || '"}' AS body
    FROM orders LEFT JOIN (
      SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'A') AS n
      FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)),
fenced AS (
  SELECT accession_number, response, strpos(response, '```json') AS a,
    length(response) - strpos(reverse(response), '```') - 1 AS b FROM responses),
inner_text AS (
  SELECT accession_number, response,
    CASE WHEN a > 0 THEN response[a + 7 : b - 1] ELSE trim(response) END AS inside
  FROM fenced),
unwrapped AS (
  SELECT accession_number,
    CASE WHEN length(response) > 20 AND json_valid(inside) THEN inside ELSE response END AS response
  FROM inner_text)"""


def greedy_chunks(size: int) -> str:
    return f"""WITH {LINES},
        listed AS (
          SELECT doc_id, list(piece ORDER BY chunk_num) AS p,
            list({{'filled': length(piece), 'at': 0::BIGINT, 'starts': []::BIGINT[]}}
                 ORDER BY chunk_num) AS states
          FROM pieces GROUP BY doc_id),
        folded AS (
          SELECT doc_id, p, list_concat([0::BIGINT], list_reduce(states, lambda s, x:
            {{'filled': CASE WHEN s.filled + x.filled > {size} THEN x.filled
                            ELSE s.filled + x.filled END,
              'at': s.at + 1,
              'starts': CASE WHEN s.filled + x.filled > {size}
                            THEN list_append(s.starts, s.at + 1) ELSE s.starts END}}).starts) AS b
          FROM listed),
        cut AS (
          SELECT doc_id, unnest(range(len(b))) AS k,
            unnest(list_transform(range(1, len(b) + 1), lambda i: array_to_string(
              p[b[i] + 1 : coalesce(b[i + 1], len(p))], chr(10) || chr(10)))) AS chunk_text
          FROM folded)
        SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INTEGER)
            AS chunk_num, chunk_text
        FROM cut WHERE length({strip("chunk_text")}) > 100"""


def token_batches(factor: int, used: int, most: int) -> str:
    return f"""
        WITH sized AS (
          SELECT CAST(doc_id // 10 AS VARCHAR) AS f, CAST(doc_id % 10 AS INTEGER) AS chunk_num,
            {factor} * len(string_split(text, ' ')) AS tokens FROM documents),
        folded AS (
          SELECT f, list(chunk_num ORDER BY chunk_num) AS c, list(tokens ORDER BY chunk_num) AS t,
            list_reduce(list({{'used': tokens, 'count': 1::BIGINT, 'ids': [0::BIGINT]}}
              ORDER BY chunk_num), lambda s, x: CASE
                WHEN s.count >= {most} OR s.used + x.used > {used}
                THEN {{'used': x.used, 'count': 1::BIGINT,
                      'ids': list_append(s.ids, s.ids[-1] + 1)}}
                ELSE {{'used': s.used + x.used, 'count': s.count + 1,
                      'ids': list_append(s.ids, s.ids[-1])}} END).ids AS b
          FROM sized GROUP BY f)
        SELECT f AS cik, f AS accession_number, unnest(c) AS chunk_num,
          CAST(unnest(t) AS INTEGER) AS tokens, CAST(unnest(b) AS INTEGER) AS batch_id
        FROM folded"""


HTML_TEXT = r"""
        WITH plain AS (
          SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            regexp_replace(html, '(?s)<!--.*?(-->|\z)', '', 'g'),
            '(?is)<head\b.*?(</head\s*>|\z)', '', 'g'),
            '(?is)<script\b.*?(</script\s*>|\z)', '', 'g'),
            '(?is)<style\b.*?(</style\s*>|\z)', '', 'g'),
            '[ \t\r\n\f]+', ' ', 'g') AS h FROM pages),
        links AS (
          SELECT page_id, regexp_replace(h,
            '(?i)<a\b[^>]*?\bhref\s*=\s*"([^"]*)"[^>]*>(.*?)</a\s*>', '[\2](\1)', 'g') AS h
          FROM plain),
        blocks AS (
          SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            regexp_replace(h, '(?i)<br\b[^>]*>', chr(10), 'g'),
            '(?i)<h1\b[^>]*>', chr(10) || chr(10) || '# ', 'g'),
            '(?i)<li\b[^>]*>', chr(10) || '* ', 'g'),
            '(?i)</?(p|div|h1|ul|article|footer|nav|body)\b[^>]*>', chr(10) || chr(10), 'g'),
            '</?[a-zA-Z!][^>]*(>|\z)', '', 'g') AS h FROM links),
        decoded AS (
          SELECT page_id, replace(replace(replace(replace(h, '&copy;', '©'), '&middot;', '·'),
            '&quot;', '"'), '&amp;', '&') AS h FROM blocks)
        SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(h,
            ' *\n *', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' {2,}', ' ', 'g'),
            ' ' || chr(10)) AS text
        FROM decoded"""

# The text of pages takes the place of the documents' text.
PAGE_CHUNKS = f"""WITH documents AS (SELECT page_id AS doc_id, text FROM ({HTML_TEXT})),
page_chunks AS (
  SELECT doc_id AS page_id, chunk_num, chunk_text FROM ({greedy_chunks(300)})
  QUALIFY count(*) OVER (PARTITION BY doc_id) > 1)"""

# Words that belong together with their period, by the log-likelihood of both.
ABBREVIATIONS = r"""said AS (
  SELECT unnest(regexp_extract_all(lower(text), '\p{L}+\.?')) AS w FROM documents),
counted AS (
  SELECT rtrim(w, '.') AS word, count(*) FILTER (WHERE w LIKE '%.') AS dotted,
    count(*) FILTER (WHERE w NOT LIKE '%.') AS bare FROM said GROUP BY 1),
rate AS (SELECT sum(dotted) / sum(dotted + bare) AS p FROM counted),
abbreviations AS (
  SELECT word, dotted, bare,
    2 * (dotted * ln(0.99) + bare * ln(1 - 0.99) - dotted * ln(p) - bare * ln(1 - p))
      * exp(-length(word)) * pow(length(word), -bare) AS score
  FROM counted, rate WHERE dotted > 0 AND p < 1)"""

ORACLES: dict[str, str] = {
    "index_quarter_counts": f"""WITH {INDEX}
        SELECT CAST(year(date_filed) AS INTEGER) AS year,
          CAST(quarter(date_filed) AS INTEGER) AS quarter, count(*) AS n
        FROM idx GROUP BY 1, 2""",
    "form_type_filter": f"""WITH {INDEX}
        SELECT cik, accession_number, form_type FROM idx
        WHERE form_type <> '' AND upper(form_type) = upper('1-urgent')""",
    "tag_filter": f"WITH {INDEX} SELECT cik, accession_number, tag AS tags FROM idx WHERE tag = 'F'",
    "date_range_filter": f"""WITH {INDEX}
        SELECT cik, accession_number, strftime(date_filed, '%Y-%m-%d') AS date_filed FROM idx
        WHERE date_filed BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""",
    "assign_tags": f"WITH {INDEX} SELECT cik, accession_number, '10pct' AS tags FROM idx",
    "delete_exact_tag": f"""WITH {INDEX}
        SELECT cik, accession_number, tag AS tags FROM idx WHERE [tag] <> ['F']""",
    "distinct_filings": f"""WITH {INDEX}
        SELECT DISTINCT cik, accession_number FROM idx WHERE tag = 'O'""",
    "batch_limit": f"""WITH {INDEX}
        SELECT DISTINCT cik, accession_number FROM idx WHERE tag = 'O'
        ORDER BY cik, accession_number LIMIT 100""",
    "distinct_rows": f"""WITH {INDEX}
        SELECT cik, accession_number, form_type, idx_filename, tag AS tags FROM
          (SELECT * FROM idx UNION SELECT * FROM idx)""",
    "sample_semi_join": f"""WITH {INDEX}
        SELECT cik, accession_number FROM idx
        WHERE cik IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer
                      WHERE c_mktsegment = 'MACHINERY')""",
    "sample_ten_percent": f"{DRAWN} SELECT cik FROM drawn",
    "sample_index": f"""{DRAWN}
        SELECT DISTINCT cik, accession_number, strftime(date_filed, '%Y-%m-%d') AS date_filed,
          '10pct' AS tags
        FROM idx WHERE date_filed BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'
          AND cik IN (SELECT cik FROM drawn)""",
    "skip_processed_anti_join": f"""WITH {INDEX}
        SELECT cik, accession_number FROM idx
        WHERE accession_number NOT IN (SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem)""",
    "single_document_of_type": """
        SELECT l_orderkey AS filing,
          CASE WHEN n = 1 THEN f END AS filename,
          CASE WHEN n = 1 THEN 'ok' WHEN n = 0 THEN 'missing' ELSE 'ambiguous' END AS status
        FROM (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'A') AS n,
                max(CAST(l_partkey AS VARCHAR)) FILTER (WHERE l_returnflag = 'A') AS f
              FROM lineitem GROUP BY l_orderkey)""",
    "filing_manifest": """
        SELECT CAST(l_suppkey AS VARCHAR) AS cik, CAST(l_orderkey AS VARCHAR) AS accession_number,
          strftime(l_shipdate, '%Y-%m-%d') AS date_filed, l_returnflag AS type,
          l_linenumber AS sequence, l_partkey || '.htm' AS filename,
          'edgar/data/' || l_suppkey || '/' || l_orderkey || '/' || l_partkey || '.htm' AS path
        FROM lineitem""",
    "accession_from_path": f"WITH {INDEX} SELECT idx_filename, accession_number FROM idx",
    "parse_path": rf"""WITH {INDEX},
        names AS (SELECT idx_filename AS name FROM idx UNION ALL SELECT url FROM pages)
        SELECT name,
          CASE WHEN ok THEN regexp_extract(name, 'edgar/data/(\d+)/(.+)\.txt', 1) END AS cik,
          CASE WHEN ok THEN regexp_extract(name, 'edgar/data/(\d+)/(.+)\.txt', 2) END
            AS accession_number,
          CASE WHEN ok THEN 'ok' ELSE 'invalid_path' END AS status
        FROM (SELECT name, regexp_matches(name, 'edgar/data/(\d+)/(.+)\.txt') AS ok FROM names)""",
    "index_page_path": f"""WITH {INDEX}
        SELECT cik, accession_number,
          'edgar/data/' || cik || '/00024' || accession_number || '/000-24-' || accession_number
            || '-index.html' AS index_page,
          'edgar/data/' || cik || '/00024' || accession_number || '/000-24-' || accession_number
            || '-index-headers.html' AS headers_page
        FROM idx""",
    "export_left_join": f"""WITH {INDEX}, {RESULTS}
        SELECT DISTINCT i.cik, i.accession_number, company_name, form_type,
          strftime(date_filed, '%Y-%m-%d') AS date_filed, idx_filename AS filename,
          selected_chunks AS chunks_used, selected_text AS relevant_text,
          n_trustee AS num_trustees, response AS trustees_comp
        FROM idx i LEFT JOIN results r
          ON r.cik = i.cik AND r.accession_number = i.accession_number AND r.tag = 'O'
        WHERE i.tag = 'O'""",
    "table_stats": """
        SELECT 'filing_text_chunks' AS name, count(DISTINCT doc_id // 10) AS cik,
          count(DISTINCT doc_id // 10) AS filings, count(*) AS total FROM documents
        UNION ALL
        SELECT 'filing_chunks_embeddings', count(DISTINCT vec_id // 10),
          count(DISTINCT vec_id // 10), count(*) FROM embeddings""",
    "outcome_by_filing": f"""WITH {RESULTS}
        SELECT count(*) AS total,
          count(*) FILTER (WHERE n_trustee >= 2) AS accepted,
          count(*) FILTER (WHERE n_trustee < 2) AS not_accepted
        FROM results WHERE tag = 'F'""",
    "outcome_by_company": f"""WITH {RESULTS},
        best AS (
          SELECT cik, max(n_trustee) AS most FROM results WHERE tag = 'F' GROUP BY cik),
        split AS (
          SELECT least(most, 1) AS found, count(*) AS n FROM best GROUP BY found)
        SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS total,
          CAST(coalesce(sum(n) FILTER (WHERE found = 1), 0) AS BIGINT) AS extracted,
          CAST(coalesce(sum(n) FILTER (WHERE found = 0), 0) AS BIGINT) AS failed FROM split""",
    "ticker_lookup": """
        WITH asked AS (
          SELECT DISTINCT upper(trim(t)) AS ticker FROM (
            SELECT lower(p_type) || ' ' AS t FROM part
            UNION ALL SELECT c_mktsegment FROM customer
            UNION ALL SELECT c_mktsegment[1:3] FROM customer)),
        known AS (
          SELECT upper(trim(p_type)) AS ticker, CAST(max(p_partkey) AS VARCHAR) AS cik
          FROM part GROUP BY 1)
        SELECT ticker, coalesce(cik, 'XXXX') AS cik FROM asked LEFT JOIN known USING (ticker)
        WHERE cik IS NOT NULL OR length(ticker) > 3""",
    "columnar_json_rows": """
        SELECT 0 AS ordinal, p_brand AS symbol, CAST(p_partkey AS VARCHAR) AS cik FROM part
        UNION ALL
        SELECT 1, p_type, CAST(p_size AS VARCHAR) FROM part""",
    "chunk_number": """
        SELECT doc_id, CAST(unnest(range(len(l))) AS INTEGER) AS chunk_num, unnest(l) AS chunk_text
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)""",
    "empty_line_flags": f"""
        SELECT doc_id, CAST(count(*) AS INTEGER) AS n_lines,
          CAST(count(*) FILTER (WHERE {empty_line("line")}) AS INTEGER) AS n_empty
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
        GROUP BY doc_id""",
    "table_row_flags": f"""
        SELECT doc_id, CAST(count(*) FILTER (WHERE {table_row("line")}) AS INTEGER) AS n_table_rows
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
        GROUP BY doc_id""",
    "sentences": f"""
        SELECT doc_id, line_num, CAST(unnest(range(len(l))) AS INTEGER) AS n, unnest(l) AS sentence
        FROM (
          SELECT doc_id, CAST(line_num AS INTEGER) AS line_num, {sentence_list("line")} AS l
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                  unnest(range(len(string_split(text, chr(10))))) AS line_num FROM documents))""",
    "abbreviation_scores": f"""WITH {ABBREVIATIONS}
        SELECT word, dotted, bare, round(score, 6) AS score FROM abbreviations WHERE score >= 0.3""",
    "learned_sentences": rf"""WITH {ABBREVIATIONS},
        cut AS (
          SELECT doc_id, CAST(line_num AS INTEGER) AS line_num,
            unnest(range(len(l))) AS i, unnest(l) AS part
          FROM (
            SELECT doc_id, line_num, {sentence_list("line")} AS l
            FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                    unnest(range(len(string_split(text, chr(10))))) AS line_num FROM documents))),
        followed AS (
          SELECT *, lag(part) OVER (PARTITION BY doc_id, line_num ORDER BY i) AS before FROM cut),
        judged AS (
          SELECT *, before IS NULL OR NOT (
            lower(regexp_extract(before, '(\p{{L}}+)\.$', 1)) IN (
              SELECT word FROM abbreviations WHERE score >= 0.3)
            OR regexp_matches(before, '(?:^|[^\p{{L}}])\p{{Lu}}\.$')
            OR (before LIKE '%.' AND regexp_matches(part, '^\p{{Ll}}'))) AS begins
          FROM followed),
        grouped AS (
          SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END)
            OVER (PARTITION BY doc_id, line_num ORDER BY i) - 1 AS n FROM judged)
        SELECT doc_id, line_num, CAST(n AS INTEGER) AS n, string_agg(part, ' ' ORDER BY i) AS sentence
        FROM grouped GROUP BY doc_id, line_num, n""",
    "text_pieces": f"""WITH {LINES}
        SELECT doc_id, CAST(chunk_num AS INTEGER) AS chunk_num, piece FROM pieces""",
    "greedy_chunks": greedy_chunks(500),
    "html_to_text": HTML_TEXT,
    "page_structure": f"""
        WITH pages_given AS (SELECT * FROM pages),
        marked AS (
          SELECT page_id, replace(html, '<article>', '<article><p>@@STRUCTURE@@</p>') AS html
          FROM pages_given),
        texts AS (SELECT * FROM ({HTML_TEXT.replace("FROM pages)", "FROM marked)")}))
        SELECT page_id, replace(text, '@@STRUCTURE@@', CASE page_id % 4
          WHEN 0 THEN '1. one' || chr(10) || '2. two' || chr(10) || '  * deep' || chr(10)
            || '  * para' || chr(10) || '3. three'
          WHEN 1 THEN '> quoted' || chr(10) || chr(10) || '> again [link](/u)'
          WHEN 2 THEN 'h1 | h2' || chr(10) || '---|---' || chr(10) || 'a | b'
          ELSE '[across](/q)' || chr(10) || chr(10) || '[blocks](/q)' END) AS text
        FROM texts""",
    "chunk_pages": f"{PAGE_CHUNKS} SELECT page_id, chunk_num, chunk_text FROM page_chunks",
    "hidden_div": """
        SELECT page_id, replace(html, '<article>', CASE page_id % 4
          WHEN 2 THEN '<div style=''display:none''>second</div>'
          WHEN 3 THEN '<div data-style="display:none">kept</div>' ELSE '' END || '<article>') AS html
        FROM pages""",
    "get_chunks": """
        SELECT CAST(doc_id // 10 AS VARCHAR) AS cik, CAST(doc_id // 10 AS VARCHAR)
            AS accession_number, CAST(doc_id % 10 AS INTEGER) AS chunk_num, text AS chunk_text
        FROM documents
        WHERE (doc_id // 10, doc_id % 10) IN (SELECT (vec_id // 10, label) FROM embeddings)""",
    "multi_chunk_filings": """
        SELECT CAST(l_orderkey AS VARCHAR) AS cik, CAST(l_orderkey AS VARCHAR) AS accession_number,
          l_linenumber AS chunk_num
        FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) WHERE n > 1""",
    "cosine_distance": f"""WITH {PAIRS}
        SELECT vec_id, phrase, round(list_cosine_distance(embedding::DOUBLE[], q), 6) AS distance
        FROM embeddings JOIN phrases ON phrase = CAST(label AS VARCHAR)""",
    "vector_topk": f"""WITH {PAIRS}
        SELECT cik, accession_number, phrase, chunk_num, round(distance, 6) AS distance
        FROM pairs""",
    "relevance_by_distance": f"""WITH {SCORES}
        SELECT cik, accession_number, chunk_num, round(distance_score, 6) AS score,
          round(avg_distance, 6) AS avg_distance, round(min_distance, 6) AS min_distance,
          CAST(distance_rank AS INTEGER) AS rank FROM scores""",
    "relevance_by_appearance": f"""WITH {SCORES}
        SELECT cik, accession_number, chunk_num, frequency,
          round(avg_distance, 6) AS avg_distance, round(appearance_score, 6) AS score,
          CAST(appearance_rank AS INTEGER) AS rank FROM scores""",
    "top3_chunks": f"WITH {SCORES} {_picks('distance_rank', False)}",
    "top3_chunks_by_appearance": f"WITH {SCORES} {_picks('appearance_rank', False)}",
    "top_adjacent_chunks": f"WITH {SCORES} {_picks('distance_rank', True)}",
    "top_adjacent_chunks_by_appearance": f"WITH {SCORES} {_picks('appearance_rank', True)}",
    "cascade_candidates": f"WITH {CHOICES} SELECT * FROM choices",
    "selected_text": f"""WITH {CANDIDATES}
        SELECT cik, accession_number, ordinal, method, chunks, text FROM candidates""",
    "cascade_result": f"""WITH {CANDIDATES},
        tried AS (SELECT *, CAST(length(text) % 4 AS INTEGER) AS n,
            row_number() OVER (PARTITION BY cik, accession_number ORDER BY
              CASE WHEN length(text) % 4 > 1 THEN ordinal ELSE 10 - ordinal END) AS pick
          FROM candidates)
        SELECT cik, accession_number, chunks AS selected_chunks, text AS selected_text,
          CASE WHEN n > 1 THEN '{{"trustees":[' || array_to_string(list_transform(range(1, n + 1),
            lambda i: '{{"name":"T' || i || '"}}'), ',') || ']}}' ELSE '' END AS response,
          CASE WHEN n > 1 THEN n ELSE 0 END AS n_trustee
        FROM tried WHERE pick = 1""",
    "dummy_extract": f"""WITH {CANDIDATES}
        SELECT cik, accession_number, chunks AS selected_chunks, text AS selected_text,
          '' AS response, 0 AS n_trustee
        FROM (SELECT *, row_number() OVER (PARTITION BY cik, accession_number
                ORDER BY ordinal DESC) AS r FROM candidates) WHERE r = 1""",
    "unwrap_json": f"WITH {RESPONSES} SELECT accession_number, response FROM unwrapped",
    "trustee_count": f"""WITH {RESPONSES}
        SELECT accession_number, CAST(CASE WHEN json_valid(response)
          AND json_type(response, '$.trustees') = 'ARRAY'
          THEN json_array_length(response, '$.trustees') END AS INTEGER) AS n_trustee
        FROM unwrapped""",
    "trustee_rows": f"""WITH {RESPONSES},
        parsed AS (SELECT accession_number,
            CASE WHEN json_valid(response) THEN response END AS j FROM unwrapped),
        people AS (SELECT accession_number, j,
            CAST(coalesce(json_array_length(j, '$.trustees'), 0) AS BIGINT) AS n FROM parsed)
        SELECT accession_number, j ->> '$.notes' AS notes,
          json_extract_string(j, '$.trustees[' || i || '].name') AS name
        FROM people, LATERAL (SELECT unnest(range(greatest(n, 1))) AS i)""",
    "prompts": """
        SELECT doc_id, 'Read: ' || text || chr(10) || 'Answer.' AS prompt FROM documents""",
    # CRC-32 of the UTF-8 bytes, worked out once for each distinct word.
    "hash_embedding": r"""
        WITH words AS (
          SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS w
          FROM documents),
        counted AS (SELECT doc_id, w, count(*) AS n FROM words GROUP BY 1, 2),
        crc_table AS (
          SELECT list(c ORDER BY i) AS t FROM (
            SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k:
              CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
            FROM range(256) r(i))),
        vocabulary AS (
          SELECT w, xor(list_reduce(
            list_concat([4294967295::BIGINT], list_transform(range(1, length(hex(w)), 2),
              lambda k: CAST('0x' || substr(hex(w), k, 2) AS BIGINT))),
            lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295::BIGINT) % 64 AS bucket
          FROM (SELECT DISTINCT w FROM counted), crc_table),
        buckets AS (
          SELECT doc_id, bucket, sum(n) AS n FROM counted JOIN vocabulary USING (w) GROUP BY 1, 2)
        SELECT doc_id, CAST(bucket AS INTEGER) AS bucket,
          round(CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)) AS FLOAT) AS DOUBLE), 5)
            AS x
        FROM buckets""",
    "token_batches": token_batches(1, 1500, 4),
    "token_batches_token_limited": token_batches(20, 8191, 99999),
    "token_batches_count_limited": token_batches(20, 12000, 250),
    "chunk_outcomes": f"""{PAGE_CHUNKS},
        filed AS (
          SELECT l_orderkey AS filing, count(*) FILTER (WHERE l_returnflag = 'A') AS n,
            max(CAST(l_partkey AS VARCHAR)) FILTER (WHERE l_returnflag = 'A') AS name
          FROM lineitem GROUP BY l_orderkey),
        counts AS (SELECT page_id, count(*) AS chunks FROM page_chunks GROUP BY page_id),
        judged AS (
          SELECT filing, chunks, CASE
            WHEN n = 0 THEN 'missing' WHEN n > 1 THEN 'ambiguous'
            WHEN CAST(name AS BIGINT) % 5 = 0 THEN 'not_html'
            WHEN p.page_id IS NULL THEN 'no_content'
            WHEN chunks IS NULL THEN 'single' ELSE 'ok' END AS status
          FROM filed LEFT JOIN pages p ON n = 1 AND CAST(p.page_id AS VARCHAR) = name
          LEFT JOIN counts c ON c.page_id = p.page_id)
        SELECT filing, status, CASE WHEN status = 'ok' THEN chunks ELSE 0 END AS n_chunks
        FROM judged""",
    "html_paths": """
        SELECT page_id, CAST(n AS INTEGER) AS n, name FROM (
          SELECT page_id, unnest([0, 1, 2, 3, 4]) AS n,
            unnest([url, url || '.htm', url || '.HTML', url || '.txt', url || '.html.gz']) AS name
          FROM pages)
        WHERE name LIKE '%.htm' OR name LIKE '%.html'""",
    "get_chunks_all": """
        WITH asked AS (
          SELECT vec_id // 10 AS f, max(label) AS top FROM embeddings GROUP BY f)
        SELECT CAST(f AS VARCHAR) AS cik, CAST(f AS VARCHAR) AS accession_number,
          CAST(doc_id % 10 AS INTEGER) AS chunk_num, text AS chunk_text
        FROM documents JOIN asked ON doc_id // 10 = f WHERE f % 3 = 0 OR doc_id % 10 = top""",
    "ordered_lookup": """
        SELECT CAST(doc_id // 10 AS VARCHAR) AS cik, CAST(doc_id // 10 AS VARCHAR)
            AS accession_number,
          CAST(row_number() OVER (PARTITION BY doc_id // 10 ORDER BY doc_id) - 1 AS INTEGER)
            AS place,
          CAST(doc_id % 10 AS INTEGER) AS chunk_num, text AS chunk_text
        FROM documents""",
    "sketched_stats": """
        SELECT CAST(version AS INTEGER) AS version, count(*) AS total, true AS cik_near,
          true AS filings_near
        FROM embeddings, (SELECT unnest([1, 2, 3]) AS version)
        WHERE vec_id % 10 < CASE version WHEN 1 THEN 3 WHEN 2 THEN 6 ELSE 10 END
        GROUP BY 1""",
    "pages_by_key": """
        WITH named AS (
          SELECT max(l_partkey) AS page_id FROM lineitem WHERE l_returnflag = 'A'
          GROUP BY l_orderkey HAVING count(*) = 1)
        SELECT page_id, length(html) AS n_chars, md5(html) AS content
        FROM pages WHERE page_id IN (SELECT page_id FROM named)""",
    "committed_loads": """
        SELECT CAST(version AS INTEGER) AS version, CAST(vec_id % 10 AS INTEGER) AS chunk_num,
          count(*) AS n
        FROM embeddings, (SELECT unnest([1, 2, 3]) AS version)
        WHERE vec_id % 10 < CASE version WHEN 1 THEN 3 WHEN 2 THEN 6 ELSE 10 END
        GROUP BY 1, 2""",
    "tags_null_and_two": f"""WITH {INDEX},
        marked AS (SELECT *, tag <> 'F' AND CAST(cik AS BIGINT) % 2 = 0 AS two_tags FROM idx)
        SELECT cik, accession_number, two_tags, CASE WHEN tag = 'O' THEN 'O' END AS found
        FROM marked WHERE two_tags OR tag <> 'P'""",
    "vector_topk_many_phrases": """
        WITH vecs AS (
          SELECT vec_id, embedding::DOUBLE[] AS v, lpad(CAST(vec_id AS VARCHAR), 9, '0') AS phrase
          FROM embeddings),
        scored AS (
          SELECT a.vec_id // 10 AS f, CAST(a.vec_id % 10 AS INTEGER) AS chunk_num, b.phrase,
            list_cosine_distance(a.v, b.v) AS distance FROM vecs a CROSS JOIN vecs b)
        SELECT CAST(f AS VARCHAR) AS cik, CAST(f AS VARCHAR) AS accession_number, phrase,
          chunk_num, round(distance, 6) AS distance
        FROM scored QUALIFY row_number() OVER (
          PARTITION BY f ORDER BY round(distance, 12), chunk_num, phrase) <= 20""",
    "phrase_vectors": """
        SELECT phrase, CAST(unnest(range(len(q))) AS INTEGER) AS i,
          round(CAST(unnest(q) AS DOUBLE), 6) AS x
        FROM (SELECT CAST(label AS VARCHAR) AS phrase, arg_min(embedding, vec_id) AS q
              FROM embeddings GROUP BY label)""",
    "embedded_user_function": """
        SELECT CAST(doc_id // 10 AS VARCHAR) AS cik, CAST(doc_id // 10 AS VARCHAR)
            AS accession_number, CAST(doc_id % 10 AS INTEGER) AS chunk_num,
          length(text) || ',' || len(string_split(text, 'e')) - 1 || ','
            || len(string_split(text, ' ')) - 1 AS embedding
        FROM documents""",
}
ORACLES["skip_by_key_filter"] = ORACLES["skip_processed_anti_join"]
ORACLES["pivot_topk"] = ORACLES["vector_topk"]
ORACLES["recorded_answers"] = f"""
    SELECT *, CAST(NULL AS VARCHAR) AS error FROM ({ORACLES["cascade_result"]})"""
ORACLES["export_limited"] = (
    ORACLES["export_left_join"] + " ORDER BY i.cik, i.accession_number LIMIT 1000"
)
