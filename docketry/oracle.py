"""The registered queries once more, in ANSI SQL for DuckDB.

Written against the given tables alone and by other means than the Spark side
where there is a choice (splitting instead of replacing, joins instead of
row-wise work), so that agreement says something.
"""

from __future__ import annotations

from docketry.functions import fixed_values as fixed

WS = r"\t-\r\x1c-\x1f\x{85}\p{Z}"
S = f"[{WS}]"
NL = "chr(10)"
NAMES = "Background|Order|Conclusion|Disposition|Pretrial Proceedings|Trial|Analysis"
HEADING = rf"(?im)^¶{S}*\d+{S}+(?:[IVX]+\.{S}+)?(?:{NAMES})$|^(?:{NAMES})$"

LISTING = """
 listing AS (
  SELECT doc_id, lang,
   concat('cases/doc_', doc_id, CASE lang WHEN 'en' THEN '.pdf' WHEN 'fr' THEN '.PDF'
          WHEN 'de' THEN '' ELSE '.tar.gz' END) AS file_name,
   n_chars AS size_bytes,
   TIMESTAMP '2020-01-01' + to_minutes(n_chars) AS last_modified
  FROM documents),
 flagged AS (
  SELECT l.*, coalesce(b.quality = 1, false) AS ingested
  FROM listing l LEFT JOIN labels b USING (doc_id))
"""

EVENT_LOG = """
 log AS (
  SELECT concat('cases/doc_', user_id, '.pdf') AS file_name,
   event_type IN ('purchase', 'signup', 'view') AS ingested, ts, event_id
  FROM events),
 state AS (
  SELECT file_name, arg_max(ingested, (ts, event_id)) AS ingested,
   max(ts) FILTER (ingested) AS ingested_at, max(ts) FILTER (NOT ingested) AS reset_at
  FROM log GROUP BY file_name)
"""

OPINIONS = f"""
 header AS (
  SELECT d.doc_id, d.text AS body, o_orderstatus AS st, c_mktsegment AS seg,
   coalesce(n_name, 'NOWHERE') AS name, coalesce(o_custkey, 0) AS cust,
   coalesce(strftime(o_orderdate, '%Y-%m-%d'), '1999-12-31') AS iso,
   coalesce(strftime(o_orderdate, '%B %-d, %Y'), 'December 31, 1999') AS long
  FROM documents d LEFT JOIN orders ON o_orderkey = d.doc_id
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey),
 opinions AS (
  SELECT doc_id, concat('data/', iso, '_', lower(name), '_v._doc_', doc_id, '.pdf') AS source,
   concat_ws({NL}, '[DO NOT PUBLISH]', 'IN THE',
    concat('SUPREME COURT OF ', CASE st WHEN 'F' THEN 'ILLINOIS' WHEN 'O' THEN 'OHIO' ELSE 'TEXAS' END),
    'SECOND JUDICIAL DISTRICT', '________________',
    concat('Docket No. ', doc_id, '-', cust),
    CASE WHEN seg = 'BUILDING' THEN 'Non-Argument Calendar' ELSE 'Argued' END,
    concat('Filed: ', long),
    concat('Appeal from the Circuit Court of ', name, ' (No. 7)'),
    '1', 'Background', 'The record holds evi-', 'dence on   the claim.', 'Case: 7 Page 2 of 10',
    concat('See USSG §3B1.', cust, ' and Roe v. Wade, 410 U.S. 113 (1973). Under Ill. Stat. § 12.4. ',
           'Doe v. Roe, 12 Cal. 345, 350 (Cal. ', substring(iso, 1, 4), ').'),
    '', '  ', '¶ 2 II. Analysis', body,
    'We hold that the claim must fail. It is well settled that costs follow.',
    CASE WHEN seg IN ('BUILDING', 'MACHINERY') THEN concat('CONCLUSION', {NL},
      CASE st WHEN 'F' THEN 'AFFIRMED.' WHEN 'O' THEN concat('REVERSED AND', {NL}, 'REMANDED.')
      ELSE 'DENIED.' END) ELSE '' END) AS text
  FROM header)
"""


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{S}+|{S}+$', '', 'g')"


PAGE_LINE = (
    rf"(?im)^({S}*(?:case:{S}*[^\n]*?)?(?:{S}*date{S}*filed:{S}*[^\n]*?)?[^\n]*?"
    rf"\b(?:page|pg|p){S}*[:#-]?{S}*\d+{S}*(?:of|/){S}*\d+\b[^\n]*"
    rf"|{S}*\[DO NOT PUBLISH\]{S}*)$"
)


def clean(x: str) -> str:
    steps = [
        (r"(?m)^[ _]{3,}\n", ""),
        (rf"(?m)^{S}*\d+{S}*$", ""),
        (PAGE_LINE, ""),
        (r"([\p{L}\p{N}_]+)-\n([\p{L}\p{N}_]+)", r"\1\2"),
    ]
    for pattern, put in steps:
        x = f"regexp_replace({x}, '{pattern}', '{put}', 'g')"
    one = strip(f"regexp_replace(p, '{S}+', ' ', 'g')")
    return (
        f"array_to_string(list_transform(regexp_split_to_array({x}, '\\n{S}*\\n'), "
        f"lambda p: {one}), {NL} || {NL})"
    )


def words(x: str) -> str:
    return f"len(regexp_extract_all({x}, '[^{WS}]+'))"


SECTIONS = f"""
 cut AS (
  SELECT doc_id, source, text, regexp_split_to_array(text, '{HEADING}') AS parts,
   regexp_extract_all(text, '{HEADING}') AS heads
  FROM opinions),
 part AS (
  SELECT doc_id, source, heads, parts, unnest(range(len(parts))) AS section_ix FROM cut),
 sections AS (
  SELECT doc_id, source, section_ix,
   CASE WHEN section_ix > 0 THEN regexp_extract(heads[section_ix], '(?i)(?:^|{S})({NAMES})$', 1) END AS section,
   CASE WHEN len(heads) = 0 THEN parts[1] ELSE {strip('parts[section_ix + 1]')} END AS text
  FROM part
  WHERE len(heads) = 0 OR {strip('parts[section_ix + 1]')} <> '')
"""

CLEANED = f"""
 cleaned AS (SELECT doc_id, source, section_ix, section, {clean('text')} AS text FROM sections)
"""

COURT = (
    rf"(?i)(?:IN{S}+THE{S}+)?((?:[A-Z][A-Za-z&,''{WS}]+?COURT[A-Za-z{WS},'']*)"
    rf"(?:\r?\n[A-Z][A-Za-z&,''{WS}]*?COURT[A-Za-z{WS},'']*)?)\r?\n"
)
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
DATE = rf"(?i)\b({MONTHS}){S}+(\d{{1,2}}),{S}*(\d{{4}})\b"
LABELS = [
    ("AFFIRMED", "Affirmed"),
    (f"REVERSED{S}+AND{S}+REMANDED", "Reversed and Remanded"),
    (f"AFFIRMED{S}+IN{S}+PART", "Affirmed in Part"),
    (f"REVERSED{S}+IN{S}+PART", "Reversed in Part"),
    ("REVERSED", "Reversed"),
    ("VACATED", "Vacated"),
    ("REMANDED", "Remanded"),
    ("DISMISSED", "Dismissed"),
    ("GRANTED", "Granted"),
    ("DENIED", "Denied"),
]
DISPOSITION = (
    "CASE "
    + " ".join(rf"WHEN regexp_matches(text, '(?i)\b{p}\b') THEN '{label}'" for p, label in LABELS)
    + " END"
)
METADATA = f"""
 metadata AS (
  SELECT *, {DISPOSITION} AS disposition,
   nullif({strip(f"regexp_extract(text, '{COURT}', 1)")}, '') AS court_name,
   nullif(regexp_extract(text, '(?i)(?:Docket{S}*No\\.?|No\\.){S}*([A-Za-z0-9\\-\\.:/]+)', 1), '') AS docket_number,
   CASE WHEN regexp_matches(text, '{DATE}') THEN
    concat(regexp_extract(text, '{DATE}', 1), ' ', regexp_extract(text, '{DATE}', 2), ', ',
           regexp_extract(text, '{DATE}', 3)) END AS case_date,
   regexp_replace(regexp_replace(string_split(source, '/')[-1], '(.)\\.[^.]+$', '\\1'),
                  '^\\d{{4}}-\\d{{2}}-\\d{{2}}_', '') AS case_name
  FROM opinions)
"""

POSTURE = rf"(?i)\b(Appeal from [^\n\r]+?)(?:{S}*_{{5,}}|{S}*\(|{S}*Before)"
POSTURE_SQL = "nullif(" + strip(f"regexp_extract(text, '{POSTURE}', 1)") + ", '')"
CALENDAR_SQL = r"CASE WHEN regexp_matches(text, '(?i)\bNon-Argument Calendar\b') THEN 'Non-Argument Calendar' END"
STATUTE_LIST = (
    "list_sort(list_distinct(list_transform(list_concat("
    rf"regexp_extract_all(text, '(?:USSG{S}*)?§+{S}*[\dA-Za-z\.\-\(\)]+'), "
    rf"regexp_extract_all(text, '\b[A-Z][a-z]+\.{S}*Stat\.{S}*§{S}*[\dA-Za-z\.\-\(\)]+')), "
    "lambda s: trim(replace(rtrim(s, '.'), '  ', ' ')))))"
)
HOLDING_PATTERNS = [
    rf"We (?:hold|conclude|determine|find|rule){S}+that{S}+([^\.]+\.)",
    r"It is (?:well )?(?:established|settled) that [^\.]+\.",
    r"The (?:rule|law|precedent) (?:is|requires|mandates) [^\.]+\.",
    r"(?:Under|Pursuant to) [^,]+?,? [^\.]* must [^\.]+\.",
    r"[A-Z][^\.]* (?:must|cannot) [^\.]+\.",
]
HOLDING_LIST = (
    "list_filter(flatten(["
    + ", ".join(f"regexp_extract_all(text, '(?i){p}')" for p in HOLDING_PATTERNS)
    + "]), lambda h: length(h) > 10 AND h LIKE '%.')"
)
CITE = (
    r"([A-Z][A-Za-z\.''& ]+ v\. [A-Z][A-Za-z\.''& ]+),"
    rf"{S}*(\d{{1,4}} [A-Za-z\.]+ \d+)(?:{S}*\(\d{{4}}\))?(?:,{S}*(\d+))?{S}*\(([^\)]+)\)"
)


def cite(group: int) -> str:
    return f"regexp_extract_all(text, '{CITE}', {group})"


CITES = f"""
 hits AS (
  SELECT doc_id, section_ix, unnest({cite(1)}) AS a, unnest({cite(2)}) AS b,
   unnest({cite(3)}) AS c, unnest({cite(4)}) AS d, generate_subscripts({cite(1)}, 1) AS n
  FROM cleaned),
 cites AS (
  SELECT doc_id, section_ix, n, {strip('a')} AS case_title, {strip('b')} AS reporter,
   nullif({strip('c')}, '') AS pin, {strip('d')} AS court_year FROM hits)
"""

TOKENS = """
 tok AS (
  SELECT doc_id, list_transform(regexp_extract_all(text, '[\\p{L}\\p{N}_]+'), lambda t: lower(t)) AS tokens
  FROM documents)
"""
BM25 = f"""{TOKENS},
 doc_len AS MATERIALIZED (SELECT doc_id, len(tokens) AS dl FROM tok),
 corpus AS MATERIALIZED (SELECT count(*) AS n, avg(dl) AS avgdl FROM doc_len),
 postings AS MATERIALIZED (
  SELECT term, doc_id, count(*) AS tf, any_value(dl) AS dl
  FROM (SELECT doc_id, len(tokens) AS dl, unnest(tokens) AS term FROM tok) GROUP BY term, doc_id),
 raw AS MATERIALIZED (
  SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS v
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term) CROSS JOIN corpus),
 term_stats AS MATERIALIZED (
  SELECT term, df, CASE WHEN v < 0 THEN 0.25 * m ELSE v END AS idf
  FROM raw CROSS JOIN (SELECT avg(v) AS m FROM raw))
"""
HASHED = """
 slot AS (
  SELECT doc_id, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 128 AS s
  FROM (SELECT doc_id, unnest(tokens) AS term FROM tok)),
 part AS (
  SELECT doc_id, s // 2 AS i, sum(CASE WHEN s % 2 = 0 THEN 1 ELSE -1 END)::INT AS v
  FROM slot GROUP BY ALL),
 vec AS (
  SELECT doc_id, list(coalesce(v, 0) ORDER BY g.i) AS vector
  FROM (SELECT doc_id, unnest(range(64)) AS i FROM tok) g LEFT JOIN part USING (doc_id, i)
  GROUP BY doc_id)
"""
CENTROIDS = """
 comp AS (
  SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
 mean AS (SELECT label, i, round(avg(x), 6) AS x FROM comp GROUP BY label, i),
 q AS (SELECT label::BIGINT AS query_id, list(x ORDER BY i) AS qv FROM mean GROUP BY label)
"""


def dense(score: str, order: str) -> str:
    return f"""WITH {CENTROIDS},
 pair AS (
  SELECT query_id, vec_id AS point_id, CAST({score} AS FLOAT) AS s
  FROM q CROSS JOIN (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)),
 ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s {order}, point_id) AS rank FROM pair)
 SELECT query_id, point_id, round(s::DOUBLE, 4) AS score, rank FROM ranked WHERE rank <= 10"""


FOLDERS = "SELECT lang, sum(strlen(text) + 1)::BIGINT AS size_bytes FROM documents GROUP BY lang"
INGESTED = """
 SELECT count(*) AS files_processed, count(*) AS total_pages, 64::BIGINT AS embedding_dimension,
  count(*) AS files_marked, true AS ids_without_gaps, count(*) AS sources_indexed FROM documents"""
# The default limit of the limited ingest and the scan limit of the reset tool.
PENDING = 500

JSON_CITES = """
 cite_json AS (
  SELECT doc_id, section_ix, concat('[', string_agg(
    concat('{"case":', to_json(case_title), ',"reporter":', to_json(reporter),
           CASE WHEN pin IS NULL THEN '' ELSE concat(',"pin":', to_json(pin)) END,
           ',"court_year":', to_json(court_year), '}'), ',' ORDER BY n), ']') AS cj
  FROM cites GROUP BY doc_id, section_ix)
"""


def field(name: str, value: str) -> str:
    return f"CASE WHEN {value} IS NOT NULL THEN concat('\"{name}\":', to_json({value})) END"


def listed(name: str, value: str) -> str:
    return f"CASE WHEN len({value}) > 0 THEN concat('\"{name}\":', to_json({value})) END"


def recursive_chunks(texts: str) -> str:
    """``chunks(source, section_ix, chunk_ix, content)`` of the CTE ``texts(source, section_ix, text)``.

    ``nodes`` cuts at the first separator that occurs, and pieces that are too long at finer ones.
    Neighbours among the others, up to the next piece that is too long, are a run; ``ends`` are its
    piece ends.  From a chunk's last piece follows where the next one begins.
    """
    key = "source, section_ix, parent, run"
    size, overlap = fixed.CHUNK_SIZE, fixed.CHUNK_OVERLAP
    reach = f"len(list_filter(ends, lambda x: x <= ends[s + 1] + {size})) - 1"
    return f"""nodes AS (
  SELECT source, section_ix, []::BIGINT[] AS path, 0 AS used, text FROM {texts} WHERE text <> ''
  UNION ALL
  SELECT source, section_ix, list_append(path, i), sep, piece FROM (
   SELECT source, section_ix, path, sep, unnest(pieces) AS piece, unnest(range(1, len(pieces) + 1)) AS i FROM (
    SELECT source, section_ix, path, sep, CASE WHEN sep = 4 THEN regexp_extract_all(text, '(?s).') ELSE list_filter(
      list_transform(string_split(text, mark), lambda p, i: CASE WHEN i = 1 THEN p ELSE mark || p END),
      lambda p: p <> '') END AS pieces
    FROM (
     SELECT *, CASE sep WHEN 1 THEN {NL} || {NL} WHEN 2 THEN {NL} ELSE ' ' END AS mark FROM (
      SELECT *, CASE WHEN used < 1 AND contains(text, {NL} || {NL}) THEN 1 WHEN used < 2 AND contains(text, {NL}) THEN 2
       WHEN used < 3 AND contains(text, ' ') THEN 3 ELSE 4 END AS sep
      FROM nodes WHERE len(path) = 0 OR length(text) >= {size}))))),
 siblings AS (
  SELECT source, section_ix, path[:-2] AS parent, path[-1] AS i, text, length(text) AS n,
   sum((length(text) >= {size})::BIGINT) OVER (PARTITION BY source, section_ix, path[:-2] ORDER BY path[-1]) AS run
  FROM nodes WHERE len(path) > 0),
 small AS (SELECT *, sum(n) OVER (PARTITION BY {key} ORDER BY i)::BIGINT AS upto FROM siblings WHERE n < {size}),
 runs AS (
  SELECT {key}, list_append(parent, min(i)) AS place, string_agg(text, '' ORDER BY i) AS text,
   list_prepend(0, list(upto ORDER BY i)) AS ends
  FROM small GROUP BY {key}),
 cuts AS (
  SELECT {key}, s, {reach} AS e FROM (SELECT *, 0::BIGINT AS s FROM runs)
  UNION ALL
  SELECT {key}, s, {reach} FROM (
   SELECT {key}, ends, len(list_filter(ends, lambda x: x < ends[e + 1] - least({overlap}, {size} - (ends[e + 2] - ends[e + 1])))) AS s
   FROM cuts JOIN runs USING ({key}) WHERE e < len(ends) - 1)),
 stripped AS (
  SELECT source, section_ix, place, s, {strip('substr(text, ends[s + 1] + 1, ends[e + 1] - ends[s + 1])')} AS content
  FROM cuts JOIN runs USING ({key})),
 chunks AS (
  SELECT source, section_ix, row_number() OVER (PARTITION BY source, section_ix ORDER BY place, s) - 1 AS chunk_ix, content
  FROM stripped WHERE content <> '')"""


CHUNK_ID = "sha256(concat_ws(chr(1), source, section_ix, chunk_ix)) AS chunk_id"

NOTED = f"""{OPINIONS}, {SECTIONS}, {CLEANED}, {CITES}, {JSON_CITES}, {METADATA},
 noted AS (
  SELECT c.doc_id, c.section_ix, c.source, c.section, m.docket_number, m.case_name, m.court_name,
   m.disposition, cj, {POSTURE_SQL.replace('(text', '(c.text')} AS posture,
   {CALENDAR_SQL.replace('(text', '(c.text')} AS calendar,
   {STATUTE_LIST.replace('(text', '(c.text')} AS statutes, {HOLDING_LIST.replace('(text', '(c.text')} AS holdings
  FROM cleaned c JOIN metadata m USING (doc_id) LEFT JOIN cite_json j
   ON j.doc_id = c.doc_id AND j.section_ix = c.section_ix)"""

NOTED_JSON = f"""concat('{{', concat_ws(',',
  {field('source', 'source')}, {field('section', 'section')}, {field('docket_number', 'docket_number')},
  {field('case_name', 'case_name')}, {field('court_name', 'court_name')},
  {field('procedural_posture', 'posture')}, {listed('statutes_guidelines', 'statutes')},
  CASE WHEN cj IS NOT NULL THEN concat('"precedents":', cj) END, {listed('holdings', 'holdings')},
  {field('disposition', 'disposition')}, {field('calendar_status', 'calendar')}), '}}')"""


ORACLE: dict[str, str] = {
    "list_stats": f"""WITH {LISTING}
 SELECT count(*) AS total_files, sum(size_bytes)::BIGINT AS total_size_bytes,
  round(sum(size_bytes) / 1048576.0::DOUBLE, 2) AS total_size_mb FROM listing""",
    "list_types": f"""WITH {LISTING}
 SELECT CASE WHEN contains(file_name, '.') THEN string_split(file_name, '.')[-1] ELSE 'unknown' END AS file_type,
  count(*) AS n_files FROM listing GROUP BY 1""",
    "discover": f"""WITH {LISTING}
 SELECT count(*) AS total_files, count(*) FILTER (ingested) AS ingested_files,
  count(*) FILTER (NOT ingested) AS not_ingested_files, sum(size_bytes)::BIGINT AS total_size_bytes,
  round(sum(size_bytes) / 1048576.0::DOUBLE, 2) AS total_size_mb,
  arg_max(file_name, (last_modified, file_name)) AS latest_file,
  arg_min(file_name, (last_modified, file_name)) AS oldest_file,
  round(count(*) FILTER (ingested) * 100.0::DOUBLE / count(*), 2) AS ingestion_rate FROM flagged""",
    "discover_by_type": f"""WITH {LISTING}
 SELECT CASE lang WHEN 'en' THEN '.pdf' WHEN 'fr' THEN '.pdf' ELSE '.gz' END AS file_type, count(*) AS n_files
 FROM listing WHERE lang <> 'de' GROUP BY 1""",
    "discover_detailed": f"""WITH {LISTING}
 SELECT file_name, size_bytes, round(size_bytes / 1048576.0::DOUBLE, 6) AS size_mb,
  strftime(last_modified, '%Y-%m-%d %H:%M:%S') AS last_modified, ingested FROM flagged""",
    "pending_files": f"""WITH {LISTING}
 SELECT file_name FROM flagged WHERE NOT ingested AND file_name LIKE '%.pdf'""",
    "pending_files_first": f"""WITH {LISTING}
 SELECT file_name FROM flagged WHERE NOT ingested AND file_name LIKE '%.pdf' ORDER BY file_name LIMIT {PENDING}""",
    "route_by_suffix": f"""WITH {LISTING}
 SELECT file_name, CASE WHEN lang IN ('en', 'fr') THEN NULL WHEN lang = 'de' THEN 'Unsupported file type: '
  ELSE 'Unsupported file type: .gz' END AS error FROM listing""",
    "list_files": FOLDERS,
    "scan_files": FOLDERS,
    "stream_files": FOLDERS,
    "scan_glob": FOLDERS,
    "extract_pages": """SELECT concat('pages/', page_id, '.html') AS source,
 1::BIGINT AS page_no, html AS text FROM pages""",
    "quarantine": f"""SELECT outcome, count(*) AS n_files FROM (
  SELECT CASE WHEN regexp_matches(html, '</html>{S}*$') THEN 'good' ELSE 'ValueError: no closing tag' END AS outcome
  FROM pages) GROUP BY outcome""",
    "assemble_documents": """SELECT concat('conv/', conv_id) AS source, count(*) AS pages,
 string_agg(coalesce(text, ''), '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id""",
    "statute_sections": """SELECT
 concat('title-', l_orderkey, '-chapter-', l_returnflag, '-section-', l_linenumber) AS id,
 l_orderkey::VARCHAR AS title_num, l_returnflag AS chapter_num, l_linenumber::VARCHAR AS section_num,
 concat('Part ', l_partkey) AS heading,
 concat_ws(chr(10), concat('Part ', l_partkey), 'Supplier', l_suppkey, 'shall & must.') AS content,
 concat('title=', l_orderkey, '/chapter=', l_returnflag, '/section=', l_linenumber) AS path,
 concat('usc/', l_orderkey, '.xml') AS source_file FROM lineitem""",
    "run_stats": """SELECT count(*) AS total_ingestions,
 count(*) FILTER (event_type <> 'error') AS successful_ingestions,
 count(*) FILTER (event_type = 'error') AS failed_ingestions,
 strftime(max(ts) FILTER (event_type <> 'error'), '%Y-%m-%d %H:%M:%S.%f') AS last_ingestion,
 arg_max(props, (ts, event_id)) FILTER (event_type = 'error') AS last_error FROM events""",
    "metrics": f"""WITH {LISTING}
 SELECT (SELECT count(*) FROM events) AS total_ingestions,
  (SELECT count(*) FROM events WHERE event_type = 'error') AS failed_ingestions,
  (SELECT round(count(*) FILTER (event_type <> 'error') * 100.0::DOUBLE / count(*), 6) FROM events) AS success_rate,
  count(*) AS total_files, round(count(*) FILTER (ingested) * 100.0::DOUBLE / count(*), 2) AS ingestion_rate,
  round(sum(size_bytes) / 1048576.0::DOUBLE, 2) AS total_size_mb,
  round(sum(size_bytes) / 1048576.0::DOUBLE / count(*), 2) AS average_file_size_mb FROM flagged""",
    "ledger_state": f"""WITH {EVENT_LOG}
 SELECT file_name, ingested, strftime(ingested_at, '%Y-%m-%d %H:%M:%S.%f') AS ingested_at,
  strftime(reset_at, '%Y-%m-%d %H:%M:%S.%f') AS reset_at FROM state""",
    "ledger_snapshot": f"""WITH {EVENT_LOG}
 SELECT file_name, strftime(ingested_at, '%Y-%m-%d %H:%M:%S.%f') AS ingested_at,
  strftime(reset_at, '%Y-%m-%d %H:%M:%S.%f') AS reset_at FROM state""",
    "reset_ingested": f"""WITH {LISTING}, {EVENT_LOG}
 SELECT file_name, false AS ingested FROM listing
 WHERE file_name LIKE '%.pdf' AND file_name IN (SELECT file_name FROM state WHERE ingested)""",
    "case_metadata": f"""WITH {OPINIONS}, {METADATA}
 SELECT doc_id, court_name, docket_number, case_date, case_name, disposition,
  strftime(try_strptime(case_date, '%B %d, %Y'), '%Y-%m-%d') AS decided_on FROM metadata""",
    "split_sections": f"WITH {OPINIONS}, {SECTIONS} SELECT doc_id, section_ix, section, text FROM sections",
    "clean_text": f"""WITH {OPINIONS}, done AS (SELECT doc_id, {clean('text')} AS text FROM opinions)
 SELECT doc_id, text, {words('text')} AS length FROM done""",
    "clean_documents": f"""WITH done AS (SELECT doc_id, {clean('text')} AS text FROM documents)
 SELECT doc_id, text, {words('text')} AS length FROM done""",
    "annotate_posture": f"""WITH {OPINIONS}, {SECTIONS}, {CLEANED}
 SELECT doc_id, section_ix, {POSTURE_SQL} AS procedural_posture FROM cleaned""",
    "annotate_calendar": f"""WITH {OPINIONS}, {SECTIONS}, {CLEANED}
 SELECT doc_id, section_ix, {CALENDAR_SQL} AS calendar_status FROM cleaned""",
    "annotate_statutes": f"""WITH {OPINIONS}, {SECTIONS}, {CLEANED}
 SELECT doc_id, section_ix, coalesce(array_to_string({STATUTE_LIST}, '|'), '') AS statutes_guidelines FROM cleaned""",
    "annotate_holdings": f"""WITH {OPINIONS}, {SECTIONS}, {CLEANED}
 SELECT doc_id, section_ix, coalesce(array_to_string({HOLDING_LIST}, '|'), '') AS holdings FROM cleaned""",
    "annotate_precedents": f"""WITH {OPINIONS}, {SECTIONS}, {CLEANED}, {CITES}
 SELECT doc_id, section_ix, case_title, reporter, pin, court_year FROM cites""",
    "chunk_metadata": f"""WITH {NOTED}
 SELECT doc_id, section_ix, {NOTED_JSON} AS metadata FROM noted""",
    "chunk_recursive": f"""WITH RECURSIVE texts AS (SELECT doc_id::VARCHAR AS source, 0 AS section_ix, text FROM documents),
 {recursive_chunks('texts')}
 SELECT source, chunk_ix, {CHUNK_ID}, content FROM chunks""",
    "chunk_opinions": f"""WITH RECURSIVE {NOTED}, {recursive_chunks('cleaned')},
 carried AS (SELECT source, section_ix, {NOTED_JSON} AS metadata FROM noted)
 SELECT source, section_ix, chunk_ix, {CHUNK_ID}, content, metadata FROM chunks JOIN carried USING (source, section_ix)""",
    "to_json_rows": """SELECT concat('{"c_custkey":', c_custkey, ',"c_name":"', c_name, '","c_nationkey":', c_nationkey,
  ',"tags":["', c_mktsegment, '","', c_name, '"]}') AS json FROM customer
 UNION ALL SELECT concat('{"c_custkey":"', c_custkey, '","c_name":"', c_name, '","c_nationkey":"', c_nationkey,
  '"}') FROM customer""",
    "chunk_tokens": f"""WITH toks AS (
  SELECT doc_id::VARCHAR AS source,
   regexp_extract_all(text, '{S}*(?:[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_{WS}]+)') AS t FROM documents),
 starts AS (
  SELECT source, t, unnest(range(0, len(t), 112)) AS s FROM toks),
 windows AS (
  SELECT source, s // 112 AS chunk_ix, array_to_string(t[s + 1 : s + 128], '') AS content
  FROM starts WHERE s = 0 OR s + 16 < len(t))
 SELECT source, chunk_ix, sha256(concat_ws(chr(1), source, '0', chunk_ix)) AS chunk_id, content FROM windows""",
    "chunk_words": """WITH toks AS (
  SELECT doc_id::VARCHAR AS source, list_filter(regexp_extract_all(text, '[^ ]* *'), lambda w: w <> '') AS t FROM documents),
 starts AS (SELECT source, t, unnest(range(0, len(t), 40)) AS s FROM toks)
 SELECT source, s // 40 AS chunk_ix, array_to_string(t[s + 1 : s + 50], '') AS content
 FROM starts WHERE s = 0 OR s + 10 < len(t)""",
    "embed_with_model": """SELECT doc_id AS chunk_id, length(text) AS n_chars,
 length(text) - length(replace(text, 'a', '')) AS n_a, length(text) - length(replace(text, 'e', '')) AS n_e FROM documents""",
    "check_dimension_misfits": """SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN 63 ELSE -1 END::BIGINT AS n FROM embeddings
 WHERE vec_id % 7 = 0 OR vec_id % 11 = 0""",
    "update_points": f"""WITH {TOKENS}, {HASHED}
 SELECT doc_id AS point_id, array_to_string(vector, ',') AS vector FROM vec JOIN documents USING (doc_id) WHERE lang = 'fr'""",
    "drop_index": """SELECT count(*) AS n_points, count(*) AS indexed, true AS dropped, false AS dropped_again,
 false AS "left" FROM embeddings""",
    "reset_ingested_first": f"""WITH {LISTING}, {EVENT_LOG}
 SELECT file_name, false AS ingested FROM (SELECT file_name FROM listing ORDER BY file_name LIMIT 500)
 WHERE file_name IN (SELECT file_name FROM state WHERE ingested)""",
    "tokenize_documents": f"""WITH {TOKENS}
 SELECT doc_id, coalesce(array_to_string(tokens, ' '), '') AS tokens FROM tok""",
    "embed_documents": f"""WITH {TOKENS}, {HASHED}
 SELECT doc_id AS chunk_id, array_to_string(vector, ',') AS vector FROM vec""",
    "check_dimension": """SELECT count(*) FILTER (len(embedding) = 64) AS good,
 count(*) FILTER (len(embedding) IS DISTINCT FROM 64) AS bad FROM embeddings""",
    "lexical_stats": f"WITH {BM25} SELECT term, df, round(idf, 6) AS idf FROM term_stats",
    "lexical_append": f"WITH {BM25} SELECT term, df, round(idf, 6) AS idf FROM term_stats",
    "lexical_postings": f"WITH {BM25} SELECT term, doc_id AS chunk_id, tf, dl FROM postings",
    "lexical_corpus": f"""WITH {BM25}
 SELECT n AS chunks_count, 1.2::DOUBLE AS k1, 0.75::DOUBLE AS b, true AS index_exists, round(avgdl, 6) AS avgdl
 FROM corpus""",
    "search_lexical": f"""WITH {BM25},
 asked AS (
  SELECT item_id AS query_id, lower(unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'))) AS term FROM benchmark),
 scored AS (
  SELECT query_id, doc_id AS chunk_id,
   round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / (SELECT avgdl FROM corpus)))::DOUBLE), 9) AS score
  FROM asked JOIN term_stats USING (term) JOIN postings USING (term) GROUP BY query_id, doc_id),
 ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id) AS rank FROM scored)
 SELECT query_id, chunk_id, round(score, 6) AS score, rank FROM ranked WHERE rank <= 10""",
    "search_dense_cosine": dense("list_cosine_similarity(qv, v)", "DESC"),
    "search_dense_dot": dense("list_inner_product(qv, v)", "DESC"),
    "search_dense_euclid": dense("list_distance(qv, v)", "ASC"),
    "search_dense_text": f"""WITH {TOKENS}, {HASHED},
 qtok AS (
  SELECT item_id, unnest(list_transform(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), lambda t: lower(t))) AS term
  FROM benchmark),
 qpart AS (
  SELECT item_id, s // 2 AS i, sum(CASE WHEN s % 2 = 0 THEN 1 ELSE -1 END) AS v FROM (
   SELECT item_id, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 128 AS s FROM qtok) GROUP BY ALL),
 qvec AS (
  SELECT item_id, list(coalesce(v, 0)::DOUBLE ORDER BY g.i) AS qv
  FROM (SELECT item_id, unnest(range(64)) AS i FROM benchmark) g LEFT JOIN qpart USING (item_id, i)
  GROUP BY item_id),
 pair AS (
  SELECT item_id AS query_id, doc_id AS point_id,
   CAST(CASE WHEN list_inner_product(v, v) = 0 OR list_inner_product(qv, qv) = 0 THEN 0
        ELSE list_inner_product(qv, v) / (sqrt(list_inner_product(qv, qv)) * sqrt(list_inner_product(v, v))) END
        AS FLOAT) AS s
  FROM qvec CROSS JOIN (SELECT doc_id, vector::DOUBLE[] AS v FROM vec)),
 ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, point_id) AS rank FROM pair)
 SELECT query_id, point_id, round(s::DOUBLE, 4) AS score, rank FROM ranked WHERE rank <= 10""",
    "upsert_vectors": """SELECT vec_id AS point_id, label::BIGINT AS label FROM embeddings
 WHERE vec_id NOT IN (SELECT doc_id FROM labels)
 UNION ALL SELECT doc_id, arg_max(toxic + 100, quality)::BIGINT FROM labels GROUP BY doc_id""",
    "upsert_points": """SELECT id AS point_id, arg_max(content, place) AS content FROM (
  SELECT vec_id AS id, label::VARCHAR AS content, 0 AS place FROM embeddings
  UNION ALL SELECT vec_id % 100, concat('new ', vec_id), vec_id + 1 FROM embeddings WHERE vec_id < 300) GROUP BY id""",
    "delete_vectors": """SELECT vec_id AS point_id, label::BIGINT AS label FROM embeddings
 WHERE vec_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "point_ids": """SELECT source, doc_id, row_number() OVER (ORDER BY source, doc_id) - 1 AS point_id
 FROM documents""",
    "vector_table": """SELECT CASE label WHEN 7 THEN 'seven' ELSE label::VARCHAR END AS content,
 count(*) AS n_points, count(*) AS n_ids, sum(vec_id)::BIGINT AS sum_chunk, 64::BIGINT AS dimension
 FROM embeddings WHERE label <> 0 GROUP BY label""",
    "index_stats": """SELECT count(*) AS chunks_count, max(len(embedding)) AS dimension,
 'cosine' AS metric, 'ready' AS status FROM embeddings""",
    "ingest_batch": INGESTED,
    "ingest_stream": INGESTED,
    "ingest_folder": f"""
 SELECT run_id, 'success' AS status, method, n AS files_processed, 1::BIGINT AS batches_processed, n AS total_pages,
  (SELECT count(DISTINCT conv_id) FROM conversations) AS files_marked
 FROM (
  SELECT 'run-0' AS run_id, '{fixed.METHOD_FULL}' AS method, count(DISTINCT conv_id) AS n FROM conversations WHERE conv_id % 3 = 0
  UNION ALL SELECT 'run-1', '{fixed.METHOD_LIMITED}', count(DISTINCT conv_id) FROM conversations WHERE conv_id % 3 > 0
  UNION ALL SELECT 'run-2', '{fixed.METHOD_LIMITED}', 0)""",
}

# A stored index is searched another way, with the same hits.
ORACLE["search_lexical_stored"] = ORACLE["search_lexical"]
