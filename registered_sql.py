"""SQL (DuckDB dialect) that gives the same rows as the registered queries."""

from __future__ import annotations

BLANK = r"[\s\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xff]"
STRIP = r"'^\s+|\s+$', '', 'g'"
NEWLINE = "chr(10)"
TAB = "chr(9)"


def _bracket_quotes(x: str) -> str:
    return f"""replace(replace({x}, '[“', '["'), '”]', '"]')"""


def clean_page(x: str) -> str:
    x = f"replace({_bracket_quotes(x)}, '|', '')"
    x = f"translate({x}, {NEWLINE} || {TAB}, '  ')"
    return f"regexp_replace(regexp_replace({x}, '{CONTROL}', '', 'g'), '{BLANK}{{2,}}', ' ', 'g')"


def clean_qa(x: str) -> str:
    x = f"replace(translate({_bracket_quotes(x)}, '“”', ''), {NEWLINE}, ' ')"
    x = f"regexp_replace(regexp_replace({x}, '{CONTROL}', '', 'g'), '{BLANK}{{2,}}', ' ', 'g')"
    x = f"lower(translate({x}, '()^+*$|\\?[]{{}}', ''))"
    return f"regexp_replace({x}, '\\.{{2,}}', '', 'g')"


def clean_relevance(x: str) -> str:
    x = f"translate(coalesce({x}, ''), '“”' || {NEWLINE} || {TAB}, '\"\"  ')"
    x = rf"regexp_replace({x}, '[^\x20-\x7e\n\r\t]', '', 'g')"
    x = rf"regexp_replace({x}, '\s{{2,}}', ' ', 'g')"
    return f"replace(replace({x}, 'BOE', ''), '\\', '')"


def starts(answer: str, par: str) -> str:
    """Offsets of the answer as a list."""
    pieces = f"string_split({par}, {answer})"
    literal = (
        f"list_transform(range(1, len({pieces})), lambda k: "
        f"list_sum(list_transform({pieces}[1:k], lambda p: length(p))) + (k - 1) * length({answer}))"
    )
    at = f"substr({par}, i + 1, length({answer})) = {answer}"
    before = f"i > 0 AND regexp_matches(substr({par}, i, 1), '[^0-9]')"
    after = (
        f"i + length({answer}) < length({par}) AND "
        f"regexp_matches(substr({par}, i + length({answer}) + 1, 1), '[^0-9]')"
    )
    numeric = (
        f"list_filter(range(0, length({par}) - length({answer}) + 1), "
        f"lambda i: {at} AND (({before}) OR ({after})))"
    )
    return f"""CASE WHEN {answer} IS NULL OR {par} IS NULL THEN NULL
        WHEN {answer} = '' THEN range(0, length({par}) + 1)
        WHEN NOT contains({par}, {answer}) THEN []::BIGINT[]
        WHEN regexp_full_match({answer}, '\\p{{N}}+') THEN {numeric}
        ELSE {literal} END"""


def shifted(x: str, s: str) -> str:
    return f"CASE WHEN list_contains({s}, 0) THEN ' ' || {x} ELSE {x} END"


def shifted_starts(s: str) -> str:
    return f"CASE WHEN list_contains({s}, 0) THEN list_transform({s}, lambda j: j + 1) ELSE {s} END"


def joined(s: str) -> str:
    return f"coalesce(array_to_string(list_transform({s}, lambda j: j::VARCHAR), ','), '')"


def in_year(question: str, add_year: str, year: str) -> str:
    whole = f"coalesce(trunc(TRY_CAST({year} AS DOUBLE))::BIGINT::VARCHAR, {year})"
    return (
        f"CASE WHEN {add_year} THEN string_split({question}, '?')[1] || ' in year ' || {whole} || '?' "
        f"ELSE {question} END"
    )


PAGES = f"""
lines AS (
    SELECT doc_id, i - 1 AS line_no, ls[i] AS line
    FROM (SELECT doc_id, string_split(text, {NEWLINE}) AS ls FROM documents), unnest(range(1, len(ls) + 1)) t(i)
)"""

PARAGRAPHS = (
    PAGES
    + rf""",
kept AS (
    SELECT * FROM (SELECT doc_id, line_no, (line_no // 8)::INT AS page, {clean_page('line')} AS paragraph FROM lines)
    WHERE length(regexp_replace(paragraph, '[^\p{{L}}\p{{N}}]', '', 'g')) > 20
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS id FROM kept
),
paragraphs AS (
    SELECT doc_id, 'doc_' || doc_id || '.pdf' AS pdf_name, page, page::VARCHAR AS page_key,
        id AS unique_paragraph_id, paragraph,
        min(id) OVER (PARTITION BY doc_id, page) AS start_index_page,
        max(id) OVER (PARTITION BY doc_id, page) AS last_index_page
    FROM numbered
)"""
)

MAPPING = """,
mapping AS (
    SELECT item_id::DOUBLE AS kpi_id,
        'What about ' || text || ' no. ' || item_id || '?' AS question,
        'OG, CM, CU' AS sectors, item_id % 3 = 0 AS add_year,
        CASE WHEN item_id % 4 = 1 THEN ['TEXT'] ELSE ['TEXT', 'TABLE'] END AS kpi_category
    FROM benchmark
)"""

ANNOTATIONS = (
    PARAGRAPHS
    + MAPPING
    + r""",
words AS (
    SELECT *, doc_id + unique_paragraph_id AS v, string_split(plain, ' ') AS w
    FROM (SELECT *, translate(paragraph, '"[]{}\', '') AS plain FROM paragraphs)
),
inners AS (
    SELECT *, 'doc_' || doc_id AS stem, (page + 1)::VARCHAR AS p1,
        CASE WHEN v % 19 = 0 THEN coalesce(nullif(regexp_extract(plain, '[0-9]+'), ''), plain)
             WHEN v % 6 = 0 THEN replace(plain, 'an', 'na')
             WHEN v % 6 = 1 THEN 'no such passage ' || md5(paragraph)
             ELSE array_to_string(list_slice(w, 2, 1 + greatest(len(w) - 2, 1)), ' ') END AS inner_text
    FROM words
),
annotations AS (
    SELECT
        CASE WHEN v % 50 = 7 THEN 'CEZ' ELSE 'company_' || doc_id % 7 END AS company,
        CASE WHEN v % 11 = 0 THEN stem WHEN v % 11 = 1 THEN stem || ',pdf'
             WHEN v % 11 = 2 THEN stem || ' .pdf' ELSE pdf_name END AS source_file,
        CASE WHEN v % 23 = 0 THEN p1 WHEN v % 29 = 0 THEN '[' || p1 || ', x]'
             WHEN v % 13 = 0 THEN '[' || p1 || ', ' || p1 || ']' ELSE '[' || p1 || ']' END AS source_page,
        CASE WHEN v % 31 = 0 THEN 'n/a' WHEN v % 31 = 1 THEN '999' ELSE (v % 25)::VARCHAR END AS kpi_id,
        CASE WHEN v % 41 = 0 THEN NULL WHEN v % 37 = 0 THEN 'FY20'
             WHEN v % 4 = 0 THEN (2015 + v % 8) || '.0' ELSE (2015 + v % 8)::VARCHAR END AS year,
        CASE WHEN v % 43 = 0 THEN NULL
             WHEN v % 4 = 0 THEN coalesce(w[2], 'none') || ' ' || coalesce(w[3], 'none')
             WHEN v % 4 = 1 THEN coalesce(nullif(regexp_extract(plain, '[0-9]+'), ''), w[4], 'none')
             WHEN v % 4 = 2 THEN coalesce(w[3], 'none') || chr(10) || coalesce(w[4], 'none') || chr(10) || coalesce(w[5], 'none')
             ELSE coalesce(w[2], 'none') END AS answer,
        CASE WHEN v % 10 = 0 THEN 'TABLE' WHEN v % 10 = 1 THEN ' TEXT ' ELSE 'TEXT' END AS data_type,
        CASE WHEN v % 47 = 0 THEN NULL
             WHEN v % 17 = 0 THEN '{"' || inner_text || '"]'
             WHEN v % 13 = 0 THEN '["' || inner_text || '", "' || plain || '"]'
             WHEN v % 13 = 1 THEN '["' || inner_text || '","' || plain || '"]'
             ELSE '["' || inner_text || '"]' END AS relevant_paragraphs,
        'annotator_' || doc_id % 3 AS annotator,
        CASE WHEN doc_id % 2 = 0 THEN 'OG' END AS sector,
        'annotation_' || doc_id || '.csv' AS annotation_file_name,
        unique_paragraph_id AS annotation_row
    FROM inners
)"""
)

PAGE_LIST = """CASE WHEN starts_with(source_page, '[') AND ends_with(source_page, ']') AND length(source_page) >= 2
    AND len(list_filter(string_split(substr(source_page, 2, length(source_page) - 2), ','),
        lambda p: TRY_CAST(trim(p) AS INT) IS NULL)) = 0
    THEN list_transform(string_split(substr(source_page, 2, length(source_page) - 2), ','),
        lambda p: TRY_CAST(trim(p) AS INT)::VARCHAR) END"""

CLEAN_ANNOTATIONS = (
    ANNOTATIONS
    + f""",
prepared AS (
    SELECT company,
        trim(CASE WHEN ends_with(source_file, '.pdf') THEN string_split(source_file, '.pdf')[1]
            WHEN ends_with(source_file, ',pdf') THEN string_split(source_file, ',pdf')[1]
            ELSE source_file END) || '.pdf' AS source_file,
        {PAGE_LIST} AS source_page,
        TRY_CAST(kpi_id AS DOUBLE) AS kpi_id, year, answer, trim(data_type) AS data_type,
        relevant_paragraphs, annotator, sector, annotation_file_name, annotation_row
    FROM annotations
    WHERE company IS NOT NULL AND source_file IS NOT NULL AND source_page IS NOT NULL
        AND kpi_id IS NOT NULL AND year IS NOT NULL AND company <> 'CEZ'
),
clean_annotations AS (
    SELECT * FROM prepared p WHERE source_page IS NOT NULL
        AND EXISTS (SELECT 1 FROM mapping m WHERE m.kpi_id = p.kpi_id AND list_contains(m.kpi_category, p.data_type))
)"""
)

CLEAN = (
    CLEAN_ANNOTATIONS
    + rf""",
questioned AS (
    SELECT c.* EXCLUDE (answer, relevant_paragraphs),
        regexp_replace(replace(c.answer, {NEWLINE}, ' '), {STRIP}) AS answer,
        regexp_replace(c.relevant_paragraphs, {STRIP}) AS listed,
        {in_year('m.question', 'm.add_year', 'c.year')} AS question
    FROM clean_annotations c JOIN mapping m ON m.kpi_id = c.kpi_id
    WHERE c.data_type = 'TEXT' AND c.relevant_paragraphs IS NOT NULL AND c.answer IS NOT NULL
),
mended AS (
    SELECT *, CASE WHEN regexp_matches(listed, '^[{{\]]') THEN '[' || substr(listed, 2)
        WHEN regexp_matches(listed, '[}}\[]$') THEN substr(listed, 1, length(listed) - 1) || ']'
        ELSE listed END AS bracketed
    FROM questioned
),
passages AS (
    SELECT *, string_split_regex(substr(bracketed, 3, greatest(length(bracketed) - 4, 0)), '", ?"') AS ps
    FROM mended WHERE starts_with(bracketed, '[') AND ends_with(bracketed, ']')
),
clean AS (
    SELECT company, source_file, source_page[i + 1] AS source_page, kpi_id, year, answer, data_type,
        ps[i + 1] AS relevant_paragraphs, annotator, sector, annotation_file_name, annotation_row,
        question, len(ps) > 1 AS several, i::INT AS item
    FROM passages, unnest(range(0, CASE WHEN len(ps) = 1 THEN 1 ELSE least(len(ps), len(source_page)) END)) t(i)
)"""
)

FULL = (
    CLEAN
    + f""",
qa_paragraphs AS (
    SELECT pdf_name AS source_file, page_key, unique_paragraph_id, {clean_qa('paragraph')} AS text FROM paragraphs
),
qa_rows AS (
    SELECT * EXCLUDE (answer, relevant_paragraphs), {clean_qa('answer')} AS answer,
        {clean_qa('relevant_paragraphs')} AS passage,
        (TRY_CAST(source_page AS INT) - 1)::VARCHAR AS page_key
    FROM clean
),
passage_pairs AS (
    SELECT r.source_file, r.page_key, r.passage, t.unique_paragraph_id, t.text,
        contains(t.text, r.passage) AND len({starts('r.passage', 't.text')}) > 0 AS contained
    FROM (SELECT DISTINCT source_file, page_key, passage FROM qa_rows) r
    JOIN qa_paragraphs t USING (source_file, page_key)
),
first_containing AS (
    SELECT source_file, page_key, passage, arg_min(text, unique_paragraph_id) AS text, true AS contained
    FROM passage_pairs WHERE contained GROUP BY ALL
),
nearest AS (
    SELECT source_file, page_key, passage, text, false AS contained FROM (
        SELECT *, row_number() OVER (PARTITION BY source_file, page_key, passage
            ORDER BY levenshtein(passage, text), unique_paragraph_id) AS rn
        FROM passage_pairs p
        WHERE NOT EXISTS (SELECT 1 FROM first_containing f WHERE f.source_file = p.source_file
            AND f.page_key = p.page_key AND f.passage = p.passage))
    WHERE rn = 1
),
chosen AS (SELECT * FROM first_containing UNION ALL SELECT * FROM nearest),
replaced AS (
    SELECT r.*, CASE WHEN c.contained OR len({starts('r.answer', 'c.text')}) > 0 THEN c.text ELSE r.passage END AS par
    FROM qa_rows r LEFT JOIN chosen c USING (source_file, page_key, passage)
),
located AS (SELECT *, {starts('answer', 'par')} AS s FROM replaced),
full_rows AS MATERIALIZED (
    SELECT company, source_file, source_page, kpi_id, year, answer, data_type,
        {shifted('par', 's')} AS relevant_paragraphs, annotator, sector, annotation_file_name, annotation_row,
        question, several, item, {shifted_starts('s')} AS answer_start
    FROM located
)"""
)

EXTRA = (
    FULL
    + f""",
searched AS (
    SELECT *, (TRY_CAST(source_page AS INT) - 1)::VARCHAR AS own_page, {clean_qa('answer')} AS again
    FROM full_rows WHERE kpi_id NOT IN (0, 1, 9, 11)
),
elsewhere AS (
    SELECT r.*, t.page_key, t.unique_paragraph_id, t.text, {starts('r.again', 't.text')} AS s
    FROM searched r JOIN qa_paragraphs t ON t.source_file = r.source_file AND t.page_key <> r.own_page
        AND contains(t.text, r.again)
),
extra AS (
    SELECT company, source_file, page_key AS source_page, kpi_id, year, again AS answer, data_type,
        {shifted('text', 's')} AS relevant_paragraphs, '1QBit' AS annotator, sector, annotation_file_name,
        annotation_row, question, several, item, {shifted_starts('s')} AS answer_start, unique_paragraph_id
    FROM elsewhere WHERE len(s) > 0
)"""
)

ANSWERABLE = (
    EXTRA
    + """,
both_kinds AS (
    SELECT source_file, relevant_paragraphs AS paragraph, question, answer, answer_start, 0 AS rank, several,
        annotation_file_name, annotation_row, item, NULL::BIGINT AS place FROM full_rows
    UNION ALL
    SELECT source_file, relevant_paragraphs, question, answer, answer_start, 1, several,
        annotation_file_name, annotation_row, item, unique_paragraph_id FROM extra
),
answerable AS (
    SELECT source_file, paragraph, question, answer, answer_start FROM (
        SELECT *, row_number() OVER (PARTITION BY answer, paragraph, question
            ORDER BY rank, several, annotation_file_name, annotation_row, item, place NULLS FIRST) AS rn
        FROM both_kinds)
    WHERE rn = 1 AND len(answer_start) > 0
)"""
)

SCORES = f""",
relevance AS (
    SELECT p.page, p.pdf_name, p.unique_paragraph_id, {clean_qa('p.paragraph')} AS paragraph, m.kpi_id,
        CASE WHEN v % 2 = 0 THEN {in_year('m.question', 'm.add_year', '(2015 + v % 8)::VARCHAR')}
            ELSE m.question END AS question,
        coalesce(l.quality, (p.unique_paragraph_id % 2)::INT) AS paragraph_relevance_flag
    FROM (SELECT *, doc_id + unique_paragraph_id AS v FROM paragraphs) p
    JOIN mapping m ON m.kpi_id = (p.v % 25)::DOUBLE
    LEFT JOIN labels l ON l.doc_id = p.doc_id
),
relevant AS (SELECT * FROM relevance WHERE paragraph_relevance_flag = 1),
relevance_joined AS (
    SELECT r.*, f.answer FROM relevant r
    JOIN full_rows f ON f.kpi_id = r.kpi_id AND f.relevant_paragraphs = r.paragraph
)"""


def _unanswerable(kept: str) -> str:
    return f""",
kept_relevant AS ({kept}),
unanswerable AS (
    SELECT source_file, paragraph, question, '' AS answer, [-1]::BIGINT[] AS answer_start FROM (
        SELECT pdf_name AS source_file, paragraph, question, row_number() OVER (
            PARTITION BY paragraph, question ORDER BY pdf_name, unique_paragraph_id) AS rn
        FROM kept_relevant)
    WHERE rn = 1
)"""


BY_ANSWER = _unanswerable(
    f"""SELECT * FROM relevance_joined r
    WHERE pdf_name IN (SELECT source_file FROM full_rows)
    AND NOT EXISTS (SELECT 1 FROM full_rows f WHERE f.source_file = r.pdf_name AND f.question = r.question
        AND contains(r.answer, {clean_qa('f.answer')}))"""
)
BY_PAGE = _unanswerable(
    """SELECT * FROM relevant r WHERE NOT EXISTS (SELECT 1 FROM full_rows f WHERE f.source_file = r.pdf_name
        AND f.question = r.question AND TRY_CAST(f.source_page AS INT) - 1 = r.page)"""
)

SENTENCES = (
    ANNOTATIONS
    + f""",
first_pages AS (
    SELECT annotation_file_name, annotation_row, replace(source_file, '.pdf', '') AS document,
        coalesce(answer, 'nan') AS answer,
        (TRY_CAST(string_split(substr(source_page, 2, length(source_page) - 2), ',')[1] AS INT) - 1)::VARCHAR AS page_key,
        {clean_relevance('relevant_paragraphs')} AS listed
    FROM annotations
    WHERE data_type = 'TEXT' AND regexp_full_match(source_page, '\\[ *[0-9]+ *(, *[0-9]+ *)*\\]')
),
sentences AS (
    SELECT annotation_file_name, annotation_row, document, page_key, answer, len(ss) AS m,
        i::INT AS sentence_no, ss[i + 1] AS sentence
    FROM (SELECT *, string_split_regex(substr(listed, 3, length(listed) - 4), '", ?"') AS ss
        FROM first_pages WHERE starts_with(listed, '["') AND ends_with(listed, '"]')), unnest(range(0, len(ss))) t(i)
),
documented AS (SELECT *, replace(pdf_name, '.pdf', '') AS document FROM paragraphs),
matched AS (
    SELECT DISTINCT s.annotation_file_name, s.annotation_row, s.document, p.unique_paragraph_id, p.paragraph AS context
    FROM sentences s JOIN documented p USING (document, page_key) WHERE contains(p.paragraph, s.sentence)
)"""
)

COSINE = (
    SENTENCES
    + r""",
probes AS (SELECT annotation_file_name AS f, annotation_row AS r, * FROM sentences),
texts AS (
    SELECT f, r, sentence_no AS no, document, page_key, NULL::BIGINT AS text_id, sentence AS text FROM probes
    UNION ALL
    SELECT DISTINCT q.f, q.r, -1, q.document, q.page_key, p.unique_paragraph_id, p.paragraph
    FROM probes q JOIN documented p USING (document, page_key)
),
sizes AS (SELECT f, r, count(*) AS n FROM texts GROUP BY ALL),
tokens AS (
    SELECT f, r, no, text_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS term FROM texts
),
counts AS (SELECT f, r, no, text_id, term, count(*) AS tf FROM tokens GROUP BY ALL),
frequencies AS (SELECT f, r, term, count(*) AS df FROM counts GROUP BY ALL),
weights AS (
    SELECT c.f, c.r, c.no, c.text_id, c.term, c.tf * (ln((1 + s.n) / (1 + q.df)) + 1) AS w
    FROM counts c JOIN frequencies q USING (f, r, term) JOIN sizes s USING (f, r)
),
unit AS (
    SELECT *, w / sqrt(sum(w * w) OVER (PARTITION BY f, r, no, text_id)) AS u FROM weights
),
cosine_pairs AS (
    SELECT a.f, a.r, a.no, b.text_id, sum(a.u * b.u) AS cosine
    FROM unit a JOIN unit b USING (f, r, term) WHERE a.no >= 0 AND b.no = -1 GROUP BY ALL
)"""
)


def with_fuzzy(pairs: str) -> str:
    """CTE `<pairs>_fuzzy`: `pairs` with its columns a and b compared, as `fuzzy`.

    The longest common subsequence by rows of bits: a row has a bit per character of b, in words of
    60 bits, and the length is the number of zero bits at the end. An outer fold runs over the
    characters of a, an inner one over the words, passing the carry of the addition.
    """
    words = "range(0, (length(b) + 59) // 60)"
    word = "{'v': 0::BIGINT, 'm': 0::BIGINT, 'f': 0::BIGINT, 'carry': 0::BIGINT, 'done': []::BIGINT[]}"
    total = "(y.v + (y.v & y.m) + s.carry)"
    common = f"""length(b) - list_sum(list_transform(list_reduce(
        list_transform(list_filter(string_split(a, ''), lambda c: map_contains(masks, c)),
            lambda c: {{'c': c, 'v': []::BIGINT[]}}),
        lambda acc, x: {{'c': '', 'v': list_reduce(
            list_transform(range(1, len(acc.v) + 1), lambda i: {{'v': acc.v[i], 'm': masks[x.c][i],
                'f': full_words[i], 'carry': 0::BIGINT, 'done': []::BIGINT[]}}),
            lambda s, y: {{'v': 0::BIGINT, 'm': 0::BIGINT, 'f': 0::BIGINT, 'carry': {total} >> 60,
                'done': list_append(s.done, ({total} | (y.v & ~y.m)) & y.f)}},
            {word}).done}},
        {{'c': '', 'v': full_words}}).v, lambda w: bit_count(w)))"""
    return f""",
{pairs}_places AS (
    SELECT b, substr(b, i::INT + 1, 1) AS c, list(i) AS ps
    FROM (SELECT DISTINCT b FROM {pairs}), unnest(range(0, length(b))) t(i) GROUP BY ALL
),
{pairs}_coded AS (
    SELECT b, map_from_entries(list({{'k': c, 'v': list_transform({words}, lambda w: coalesce(list_sum(
            list_transform(list_filter(ps, lambda p: p // 60 = w), lambda p: 1::BIGINT << (p % 60)::INT))::BIGINT, 0))}})) AS masks,
        list_transform({words}, lambda w: (1::BIGINT << least(60, length(b) - w * 60)::INT) - 1) AS full_words
    FROM {pairs}_places GROUP BY b
),
{pairs}_common AS (
    SELECT a, b, {common} AS n FROM (SELECT DISTINCT a, b FROM {pairs}) JOIN {pairs}_coded USING (b)
),
{pairs}_fuzzy AS (
    SELECT p.*, 2.0::DOUBLE * c.n / (length(a) + length(b)) AS fuzzy FROM {pairs} p JOIN {pairs}_common c USING (a, b)
)"""


BOUND = "2.0::DOUBLE * least(length(a), length(b)) / (length(a) + length(b))"

CLOSEST = (
    COSINE
    + f""",
page_pairs AS (
    SELECT s.annotation_file_name, s.annotation_row, s.document, s.sentence_no, s.answer, s.sentence AS a,
        p.paragraph AS b, p.unique_paragraph_id, coalesce(c.cosine, 0) AS cosine
    FROM sentences s JOIN documented p USING (document, page_key)
    LEFT JOIN cosine_pairs c ON c.f = s.annotation_file_name AND c.r = s.annotation_row AND c.no = s.sentence_no
        AND c.text_id = p.unique_paragraph_id
),
open_pairs AS (
    SELECT * FROM (SELECT *, max(cosine) OVER (PARTITION BY annotation_file_name, annotation_row) AS best FROM page_pairs)
    WHERE 0.7 * cosine + 0.3 * {BOUND} >= 0.7 * best - 1e-9
)"""
    + with_fuzzy("open_pairs")
    + """,
closest AS (
    SELECT annotation_file_name, annotation_row, document,
        CASE WHEN contains(b, answer) THEN unique_paragraph_id END AS unique_paragraph_id,
        CASE WHEN contains(b, answer) THEN b ELSE a END AS context,
        contains(b, answer) AS in_extraction_data_flag, score
    FROM (SELECT *, row_number() OVER (PARTITION BY annotation_file_name, annotation_row
            ORDER BY score DESC, unique_paragraph_id, sentence_no) AS rn
        FROM (SELECT *, round(0.7 * cosine + 0.3 * fuzzy, 9) AS score FROM open_pairs_fuzzy))
    WHERE rn = 1
)"""
)

SIMILAR = (
    r""",
wanted AS (
    SELECT annotation_file_name, annotation_row, replace(source_file, '.pdf', '') AS document, relevant_paragraphs AS a
    FROM annotations WHERE data_type = 'TEXT' AND relevant_paragraphs IS NOT NULL
),
first_wanted AS (
    SELECT document, a, min({'f': annotation_file_name, 'r': annotation_row}) AS k FROM wanted GROUP BY ALL
),
own_texts AS (
    SELECT document, paragraph AS b, count(*) AS copies, min(unique_paragraph_id) AS text_id
    FROM (SELECT *, replace(pdf_name, '.pdf', '') AS document FROM paragraphs)
    WHERE document IN (SELECT document FROM wanted) GROUP BY ALL
),
text_terms AS (
    SELECT document, text_id, copies, term, count(*) AS tf
    FROM (SELECT *, unnest(regexp_extract_all(lower(b), '[\p{L}\p{N}_]{2,}')) AS term FROM own_texts) GROUP BY ALL
),
wanted_terms AS (
    SELECT document, k, term, count(*) AS tf
    FROM (SELECT *, unnest(regexp_extract_all(lower(a), '[\p{L}\p{N}_]{2,}')) AS term FROM first_wanted) GROUP BY ALL
),
term_counts AS (SELECT document, term, sum(copies) AS df FROM text_terms GROUP BY ALL),
text_counts AS (SELECT document, sum(copies) AS n FROM own_texts GROUP BY ALL),
wanted_weights AS (
    SELECT w.document, w.k, w.term, w.tf, ln((2 + n) / (2 + coalesce(df, 0))) + 1 AS idf
    FROM wanted_terms w JOIN text_counts USING (document) LEFT JOIN term_counts USING (document, term)
),
text_weights AS (
    SELECT t.*, w.k, t.tf * coalesce(w.idf, ln((2 + n) / (1 + df)) + 1) AS weight, w.tf * w.idf AS other
    FROM (SELECT f.k, t.* FROM first_wanted f JOIN text_terms t USING (document)) t
    JOIN text_counts USING (document) JOIN term_counts USING (document, term)
    LEFT JOIN wanted_weights w USING (document, k, term)
),
wanted_lengths AS (SELECT document, k, sqrt(sum((tf * idf) ** 2)) AS norm FROM wanted_weights GROUP BY ALL),
near_texts AS (
    SELECT t.document, t.k, t.text_id, t.copies, sum(weight * other) / sqrt(sum(weight ** 2)) / any_value(norm) AS cosine
    FROM text_weights t JOIN wanted_lengths l ON l.document = t.document AND l.k = t.k
    GROUP BY t.document, t.k, t.text_id, t.copies
    HAVING sum(weight * other) IS NOT NULL
),
near_pairs AS (
    SELECT n.*, a, b FROM near_texts n JOIN first_wanted USING (document, k) JOIN own_texts USING (document, text_id)
    WHERE 0.7 * cosine + 0.3 * """
    + BOUND
    + """ >= 0.7 - 1e-9
)"""
    + with_fuzzy("near_pairs")
    + """,
alike AS (
    SELECT document, k, text_id, copies, 0.7 * cosine + 0.3 * fuzzy AS score FROM near_pairs_fuzzy
    WHERE 0.7 * cosine + 0.3 * fuzzy >= 0.7
),
candidate_counts AS (
    SELECT w.annotation_file_name, w.annotation_row, document, k.f AS first_annotation_file_name,
        k.r AS first_annotation_row, n_paragraphs, coalesce(s.n, 0)::BIGINT AS n_similar,
        (n_paragraphs - coalesce(s.n, 0))::BIGINT AS n_candidates
    FROM wanted w JOIN first_wanted f USING (document, a)
    JOIN (SELECT document, sum(copies)::BIGINT AS n_paragraphs FROM own_texts GROUP BY ALL) USING (document)
    LEFT JOIN (SELECT document, k, sum(copies) AS n FROM alike GROUP BY ALL) s USING (document, k)
)"""
)


def draws(rate: int) -> str:
    """CTE `drawn`: negatives, `rate` for each annotation."""
    return f""",
candidate_texts AS (
    SELECT f.document, f.k, t.b, t.copies,
        sum(t.copies) OVER (PARTITION BY f.document, f.k ORDER BY t.text_id) - t.copies AS start
    FROM first_wanted f JOIN own_texts t USING (document)
    WHERE NOT EXISTS (SELECT 1 FROM alike s WHERE s.document = f.document AND s.k = f.k AND s.text_id = t.text_id)
),
draw_places AS (
    SELECT *, ('0x' || substr(md5('42|' || annotation_file_name || '|' || annotation_row || '|' || draw), 1, 15))::BIGINT
        % n_candidates AS place
    FROM candidate_counts, unnest(range(0, {rate})) t(draw) WHERE n_candidates > 0
),
drawn AS (
    SELECT annotation_file_name, annotation_row, d.document, draw::INT AS draw, c.b AS context
    FROM draw_places d JOIN candidate_texts c ON c.document = d.document
        AND c.k.f = d.first_annotation_file_name AND c.k.r = d.first_annotation_row
        AND d.place >= c.start AND d.place < c.start + c.copies
)"""


FULL_RELEVANCE = (
    CLOSEST
    + SIMILAR
    + draws(1)
    + """,
positive AS (
    SELECT annotation_file_name, annotation_row, context, true AS flag, unique_paragraph_id FROM matched
    UNION ALL
    SELECT annotation_file_name, annotation_row, context, in_extraction_data_flag, unique_paragraph_id FROM closest c
    WHERE NOT EXISTS (SELECT 1 FROM matched m WHERE m.annotation_file_name = c.annotation_file_name
        AND m.annotation_row = c.annotation_row)
),
examples AS (
    SELECT *, 1 AS label FROM positive
    UNION ALL
    SELECT annotation_file_name, annotation_row, context, coalesce(flag, false), NULL, 0
    FROM drawn LEFT JOIN (SELECT annotation_file_name, annotation_row, bool_or(flag) AS flag FROM positive GROUP BY ALL)
        USING (annotation_file_name, annotation_row)
)
SELECT a.company, a.year, a.source_file,
    CASE WHEN regexp_full_match(a.source_page, '\\[ *[0-9]+ *(, *[0-9]+ *)*\\]') THEN
        array_to_string(list_transform(string_split(substr(a.source_page, 2, length(a.source_page) - 2), ','),
            lambda p: (TRY_CAST(trim(p) AS INT) - 1)::VARCHAR), ',') END AS source_page,
    x.context, m.question, TRY_CAST(a.kpi_id AS DOUBLE) AS kpi_id, x.label, x.flag AS in_extraction_data_flag,
    CASE WHEN x.flag THEN x.unique_paragraph_id END AS unique_paragraph_id, a.annotation_file_name,
    a.annotation_row + 2 AS annotation_file_row, a.answer AS annotation_answer
FROM examples x JOIN annotations a USING (annotation_file_name, annotation_row)
LEFT JOIN mapping m ON m.kpi_id = TRY_CAST(a.kpi_id AS DOUBLE)
WHERE x.context <> ''"""
)

QA_OUT = f"source_file, paragraph, question, answer, {joined('answer_start')} AS answer_start"
STORED = "* EXCLUDE (answer_start), " + joined("answer_start") + " AS answer_start"
FILES = """,
files AS (
    SELECT doc_id, 'doc_' || doc_id || CASE doc_id % 10 WHEN 3 THEN '.docx' WHEN 4 THEN '.PDF' ELSE '.pdf' END AS pdf_name,
        doc_id % 10 <> 3 AS supported FROM documents
),
report AS (
    SELECT pdf_name, supported, n_paragraphs, supported AND n_paragraphs > 0 AS extracted FROM (
        SELECT f.pdf_name, f.supported, CASE WHEN f.supported THEN coalesce(n, 0) ELSE 0 END AS n_paragraphs
        FROM files f LEFT JOIN (SELECT doc_id, count(*) AS n FROM paragraphs GROUP BY ALL) USING (doc_id))
)"""
PAGE_ROWS = f""",
page_rows AS (
    SELECT 'doc_' || doc_id || '.pdf' AS pdf_name, (line_no // 8)::INT AS page,
        string_agg(line, {NEWLINE} ORDER BY line_no) AS text, doc_id
    FROM lines GROUP BY doc_id, line_no // 8
)"""


def oracle_sql() -> dict[str, str]:
    paragraph_columns = "pdf_name, page, page_key, unique_paragraph_id, paragraph, start_index_page, last_index_page"
    train = "round_even(count(*) OVER () * 0.8::DOUBLE, 0)"
    exact = f"""WITH {SENTENCES} SELECT a.company, a.year, a.source_file,
            array_to_string(list_transform(string_split(substr(a.source_page, 2, length(a.source_page) - 2), ','),
                lambda p: (trim(p)::INT - 1)::VARCHAR), ',') AS source_page,
            x.context, m.question, TRY_CAST(a.kpi_id AS DOUBLE) AS kpi_id, 1 AS label, true AS in_extraction_data_flag,
            x.unique_paragraph_id, a.annotation_file_name, a.annotation_row + 2 AS annotation_file_row,
            a.answer AS annotation_answer
            FROM matched x JOIN annotations a USING (annotation_file_name, annotation_row)
            LEFT JOIN mapping m ON m.kpi_id = TRY_CAST(a.kpi_id AS DOUBLE)"""
    mapping = f"""WITH {MAPPING.lstrip(',')} SELECT kpi_id, question, sectors, add_year,
            array_to_string(kpi_category, ',') AS kpi_category FROM mapping"""
    return {
        "extract_paragraphs": f"WITH {PARAGRAPHS} SELECT {paragraph_columns} FROM paragraphs",
        "nested_roundtrip": f"WITH {PARAGRAPHS} SELECT {paragraph_columns} FROM paragraphs",
        "extraction_report_files": f"WITH {PARAGRAPHS}{FILES} SELECT * FROM report",
        "extraction_report_totals": f"""WITH {PARAGRAPHS}{FILES} SELECT count(*) AS n_files,
            count(*) FILTER (extracted) AS n_extracted, count(*) FILTER (NOT extracted) AS n_not_extracted,
            round(100 * count(*) FILTER (extracted) / count(*), 2) AS percent_extracted,
            round(100 * count(*) FILTER (NOT extracted) / count(*), 2) AS percent_not_extracted FROM report""",
        "crowded_containment": f"""WITH {PARAGRAPHS},
            placed AS (SELECT d.lang, p.pdf_name, p.unique_paragraph_id, p.paragraph
                FROM paragraphs p JOIN documents d USING (doc_id)),
            strings AS (SELECT DISTINCT lang, substr(paragraph, 11, 24) AS piece FROM placed)
            SELECT pdf_name, unique_paragraph_id, count(*) AS n_pieces
            FROM placed JOIN strings ON placed.lang = strings.lang AND contains(paragraph, piece)
            GROUP BY pdf_name, unique_paragraph_id""",
        "short_containment": f"""WITH {PARAGRAPHS},
            strings AS (SELECT DISTINCT pdf_name, substr(paragraph, 4, 1) AS piece FROM paragraphs
                UNION SELECT DISTINCT pdf_name, substr(paragraph, 9, 2) FROM paragraphs)
            SELECT pdf_name, piece, count(*) AS n_paragraphs, min(unique_paragraph_id) AS first_paragraph
            FROM paragraphs JOIN strings USING (pdf_name) WHERE contains(paragraph, piece)
            GROUP BY pdf_name, piece""",
        "skip_extracted_documents": f"""WITH {PAGES}{PAGE_ROWS} SELECT pdf_name, page, text FROM page_rows
            WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "annotated_documents_only": f"""WITH {PAGES}{PAGE_ROWS} SELECT pdf_name, page, text FROM page_rows
            WHERE doc_id IN (SELECT doc_id FROM labels)""",
        "clean_text_qa": f"""WITH first_pass AS (SELECT doc_id, {clean_qa('text')} AS once FROM documents)
            SELECT doc_id, once, {clean_qa('once')} AS twice FROM first_pass""",
        "clean_text_relevance": f"SELECT doc_id, {clean_relevance('text')} AS cleaned FROM documents",
        "kpi_mapping": mapping,
        "kpi_mapping_file": mapping,
        "nested_files": f"WITH {PARAGRAPHS} SELECT {paragraph_columns} FROM paragraphs",
        "relevance_score_files": f"""WITH {PARAGRAPHS}{MAPPING}{SCORES.partition("relevant AS")[0].rstrip().rstrip(",")}
            SELECT * FROM relevance""",
        "annotation_files": f"""WITH {ANNOTATIONS} SELECT * EXCLUDE (annotation_file_name, annotation_row) REPLACE (
            CASE WHEN annotation_row % 2 = 0 THEN annotator END AS annotator,
            CASE WHEN annotation_row % 2 = 0 THEN sector END AS sector), true AS dense FROM annotations""",
        "saved_aggregate": f"""WITH {CLEAN_ANNOTATIONS} SELECT * EXCLUDE (annotation_file_name, annotation_row) REPLACE (
            array_to_string(source_page, ',') AS source_page) FROM clean_annotations""",
        "train_val_export": f"""WITH {ANSWERABLE} SELECT source_file, paragraph AS context, question,
            answer AS annotation_answer, {joined('answer_start')} AS answer_start,
            CASE WHEN row_number() OVER (ORDER BY md5('42|' || answer || '|' || paragraph || '|' || question)) <= {train}
                THEN 'train' ELSE 'val' END AS split FROM answerable""",
        "aggregate_annotations": f"""WITH {ANNOTATIONS} SELECT * REPLACE (
            CASE WHEN annotation_row % 2 = 0 THEN annotator ELSE annotation_file_name END AS annotator,
            CASE WHEN annotation_row % 2 = 0 THEN sector END AS sector) FROM annotations""",
        "clean_annotations": f"""WITH {CLEAN_ANNOTATIONS} SELECT * REPLACE (
            array_to_string(source_page, ',') AS source_page) FROM clean_annotations""",
        "annotation_rejects": f"""WITH {ANNOTATIONS} SELECT reason, count(*) AS n_rows FROM (
            SELECT CASE WHEN a.company IS NULL OR source_file IS NULL OR source_page IS NULL OR a.kpi_id IS NULL
                    OR year IS NULL THEN 'missing value'
                WHEN company = 'CEZ' THEN 'excluded company'
                WHEN {PAGE_LIST} IS NULL THEN 'invalid page'
                WHEN m.kpi_id IS NULL THEN 'unknown question'
                WHEN NOT list_contains(kpi_category, trim(data_type)) THEN 'data type not allowed' END AS reason
            FROM annotations a LEFT JOIN mapping m ON m.kpi_id = TRY_CAST(a.kpi_id AS DOUBLE))
            WHERE reason IS NOT NULL GROUP BY reason""",
        "invalid_pages": f"""WITH {ANNOTATIONS} SELECT DISTINCT source_page FROM annotations
            WHERE source_page IS NOT NULL AND ({PAGE_LIST}) IS NULL""",
        "clean": f"WITH {CLEAN} SELECT * FROM clean",
        "answer_positions": f"""WITH {ANNOTATIONS},
            answered AS (SELECT a.annotation_file_name, a.annotation_row, {clean_qa('p.paragraph')} AS paragraph,
                {clean_qa(f"replace(a.answer, {NEWLINE}, ' ')")} AS answer
                FROM annotations a JOIN paragraphs p ON a.annotation_file_name = 'annotation_' || p.doc_id || '.csv'
                AND a.annotation_row = p.unique_paragraph_id WHERE a.answer IS NOT NULL),
            found AS (SELECT *, {starts('answer', 'paragraph')} AS s FROM answered)
            SELECT annotation_file_name, annotation_row, answer, length({shifted('paragraph', 's')})::INT AS length,
                {joined(shifted_starts('s'))} AS answer_start FROM found""",
        "full_paragraph": f"WITH {FULL} SELECT {STORED} FROM full_rows",
        "extra_answerable": f"WITH {EXTRA} SELECT {STORED} FROM extra",
        "create_answerable": f"WITH {ANSWERABLE} SELECT {QA_OUT} FROM answerable",
        "relevance_join": f"WITH {FULL}{SCORES} SELECT * FROM relevance_joined",
        "create_unanswerable": f"WITH {FULL}{SCORES}{BY_ANSWER} SELECT {QA_OUT} FROM unanswerable",
        "unanswerable_pages": f"WITH {FULL}{SCORES}{BY_PAGE} SELECT {QA_OUT} FROM unanswerable",
        "train_val_parts": f"""WITH {PARAGRAPHS} SELECT pdf_name, unique_paragraph_id, md5(paragraph) AS paragraph_md5,
            CASE WHEN row_number() OVER (ORDER BY md5('42|' || pdf_name || '|' || unique_paragraph_id)) <= {train}
                THEN 'train' ELSE 'val' END AS split FROM paragraphs""",
        "match_paragraphs": f"WITH {SENTENCES} SELECT * FROM matched",
        "tfidf_cosine": f"""WITH {COSINE} SELECT s.document, s.page_key, s.annotation_file_name, s.annotation_row,
            s.sentence_no, c.text_id, round(c.cosine, 6) AS cosine
            FROM cosine_pairs c JOIN sentences s ON s.annotation_file_name = c.f AND s.annotation_row = c.r
                AND s.sentence_no = c.no""",
        "passage_rejects": f"""WITH {CLEAN},
            lost AS (
                SELECT 'missing passage' AS reason, 1 AS n FROM clean_annotations
                WHERE data_type = 'TEXT' AND relevant_paragraphs IS NULL
                UNION ALL
                SELECT 'missing answer', 1 FROM clean_annotations
                WHERE data_type = 'TEXT' AND relevant_paragraphs IS NOT NULL AND answer IS NULL
                UNION ALL
                SELECT 'unreadable passage list', 1 FROM mended
                WHERE NOT (starts_with(bracketed, '[') AND ends_with(bracketed, ']'))
                UNION ALL
                SELECT CASE WHEN len(ps) > len(source_page) THEN 'passage without page' ELSE 'page without passage' END,
                    abs(len(ps) - len(source_page)) FROM passages WHERE len(ps) > 1 AND len(ps) <> len(source_page)
            )
            SELECT reason, sum(n)::BIGINT AS n_rows FROM lost GROUP BY reason""",
        "closest_paragraph": f"""WITH {CLOSEST} SELECT * REPLACE (round(score, 6) AS score) FROM closest""",
        "similar_paragraphs": f"""WITH {ANNOTATIONS}{SIMILAR} SELECT document, k.f AS annotation_file_name,
            k.r AS annotation_row, text_id, copies, round(score, 8) AS score FROM alike""",
        "negative_candidates": f"WITH {ANNOTATIONS}{SIMILAR} SELECT * FROM candidate_counts",
        "negative_sample": f"WITH {ANNOTATIONS}{SIMILAR}{draws(2)} SELECT * FROM drawn",
        "curate_relevance_full": f"WITH {FULL_RELEVANCE}",
        "curate_relevance_exact": exact,
        "relevance_export": exact,
        "curate_question_answering": f"""WITH {ANSWERABLE}{SCORES}{BY_ANSWER},
            all_examples AS (SELECT *, 0 AS rank FROM answerable UNION ALL SELECT *, 1 FROM unanswerable),
            distinct_examples AS (SELECT * FROM (SELECT *, row_number() OVER (
                PARTITION BY answer, paragraph, question ORDER BY rank) AS rn FROM all_examples) WHERE rn = 1)
            SELECT {QA_OUT}, CASE WHEN row_number() OVER (ORDER BY md5(
                '42|' || answer || '|' || paragraph || '|' || question)) <= {train}
                THEN 'train' ELSE 'val' END AS split FROM distinct_examples""",
    }
