"""Oracle SQL of the document core: pages, fragments, markdown."""

from __future__ import annotations

from docspark.operators import fragments as G
from docspark.operators.pages import PAGE_CHARS

BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"

PAGES = f"""pg AS (
  SELECT doc_id, lang, source, CAST(i AS INTEGER) AS page_number, CAST((i - 1) * {PAGE_CHARS} AS INTEGER) AS "start",
         CAST(least(i * {PAGE_CHARS}, length(text)) AS INTEGER) AS "end",
         substr(text, (i - 1) * {PAGE_CHARS} + 1, {PAGE_CHARS}) AS text, CAST(n AS INTEGER) AS total_pages
  FROM (SELECT doc_id, lang, source, text, n, unnest(generate_series(1, n)) AS i
        FROM (SELECT *, greatest(1, CAST(ceil(length(text) / {PAGE_CHARS}.0) AS BIGINT)) AS n FROM documents)))"""


def line_type(line: str, first: str) -> str:
    return f"""CASE WHEN regexp_matches({line}, '{G.SIGNATURE_LINE}') OR lower({line}) LIKE '{G.SIGNATURE_MARK}%'
            OR contains({line}, '{G.SIGNATURE_RULE}') THEN 'signature'
       WHEN regexp_matches({line}, '{G.PAGE_NUMBER_LINE}') THEN 'page_number'
       WHEN regexp_matches({line}, '{G.STRUCK_LINE}') THEN 'strikethrough'
       WHEN contains({line}, '|') THEN 'table'
       WHEN regexp_matches({line}, '{G.LIST_LINE}') THEN 'list_item'
       WHEN regexp_matches({line}, '{G.HASH_LINE}') THEN 'section_header'
       WHEN {first} AND length({line}) <= {G.TITLE_CHARS} THEN 'title'
       WHEN length({line}) <= {G.HEADER_CHARS} THEN 'section_header' ELSE 'text' END"""


def fragments(pages: str = "pg", out: str = "fr") -> str:
    """Fragments of a page relation ``(doc_id, lang, source, page_number, text)``."""
    return f"""{out}_lines AS (
  SELECT doc_id, lang, source, page_number, unnest(ls) AS line, unnest(range(len(ls))) AS ro
  FROM (SELECT doc_id, lang, source, page_number,
               list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, {BLANKS})), lambda x: x <> '') AS ls
        FROM {pages})),
{out}_typed AS (
  SELECT *, {line_type("line", "page_number = 1 AND ro = 0")} AS fragment_type FROM {out}_lines),
{out} AS (
  SELECT doc_id, lang, source, page_number, CAST(ro AS INTEGER) AS reading_order, fragment_type,
         CAST(CASE WHEN fragment_type = 'title' THEN 0
              WHEN fragment_type = 'section_header'
              THEN greatest(length(regexp_extract(line, '^(#{{1,6}})[ \\t]+', 1)), 1) END AS INTEGER) AS level,
         CASE WHEN fragment_type = 'section_header' THEN regexp_replace(line, '{G.HASH_LINE}', '')
                   WHEN fragment_type = 'list_item' THEN regexp_replace(line, '{G.LIST_LINE}', '')
                   ELSE line END AS text
  FROM {out}_typed)"""


def marked(frags: str = "fr", out: str = "md") -> str:
    """Markdown of each fragment, its position, section and header flag."""
    return f"""{out}_pos AS (
  SELECT *, fragment_type IN ('title', 'section_header') AS is_header,
         row_number() OVER (PARTITION BY doc_id ORDER BY page_number, reading_order) AS pos,
         CASE WHEN fragment_type = 'title' THEN '# ' || text
              WHEN fragment_type = 'section_header' THEN repeat('#', level + 1) || ' ' || text
              WHEN fragment_type = 'list_item' THEN '- ' || text
              WHEN fragment_type = 'strikethrough' THEN '~~' || regexp_replace(text, '~~|</?(s|del)>', '', 'g') || '~~'
              ELSE text END AS md
  FROM {frags}),
{out} AS (
  SELECT *, CAST(sum(CAST(is_header AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY pos) AS INTEGER) AS section_id
  FROM {out}_pos)"""


CORE = f"{PAGES},\n{fragments()}"
MARKED = f"{CORE},\n{marked()}"
