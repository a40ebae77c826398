"""DuckDB SQL for each registered query, written from the definitions, not from the Spark plans."""

from __future__ import annotations

from millrace.functions.phones import AREA_CODES_3, AREA_CODES_4
from workload.tables import REGIONS, ROOT, SLIDE, WINDOW

ORACLES: dict[str, str] = {}

CRLF = "chr(13)||chr(10)||chr(13)||chr(10)"


def _with(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes) + "\n"


# Text

LINES = "a1 AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents)"
SEGMENTS = r"""segs AS (SELECT unnest(regexp_split_to_array(lower(line), '[^\w'' *]+')) AS seg FROM a1),
ws AS (SELECT list_filter(list_transform(regexp_split_to_array(seg, '[^\w'']+'),
    lambda w: regexp_replace(w, '^[^a-z0-9]*([\w'']*?)[^a-z0-9]*$', '\1')), lambda w: w <> '') AS w FROM segs)"""
COUNTS = "counts AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM ws) GROUP BY word)"
BIGRAMS = """bigrams AS (SELECT word, pred, count(*) AS n FROM (
    SELECT unnest(w[2:]) AS word, unnest(w[:-2]) AS pred FROM ws WHERE len(w) > 1) GROUP BY word, pred)"""

ORACLES["lines"] = _with(LINES) + "SELECT doc_id, lang, line FROM a1"
ORACLES["segments"] = _with(LINES, SEGMENTS) + (
    "SELECT array_to_string(w, ' ') AS segment, CAST(len(w) AS BIGINT) AS n_words FROM ws WHERE len(w) > 0"
)
ORACLES["word_counts"] = _with(LINES, SEGMENTS, COUNTS) + "SELECT word, n FROM counts"
ORACLES["bigram_counts"] = _with(LINES, SEGMENTS, BIGRAMS) + "SELECT word, pred, n FROM bigrams"
ORACLES["word_freq"] = _with(LINES, SEGMENTS, COUNTS, BIGRAMS) + (
    "SELECT c.word, c.n, b.pred, b.n AS pred_n FROM counts c LEFT JOIN bigrams b ON b.word = c.word"
)
ORACLES["predecessor_lists"] = _with(LINES, SEGMENTS, COUNTS, BIGRAMS) + (
    "SELECT c.word, b.pred, b.n FROM counts c LEFT JOIN bigrams b ON b.word = c.word"
)
ORACLES["clean_status"] = _with(LINES) + r"""SELECT doc_id,
    regexp_replace(regexp_replace(regexp_replace(line, 'RT', ''), '@\p{L}+', '', 'g'), 'https?://\S+\s?', '', 'g') AS cleaned
FROM a1"""
ORACLES["lang_names"] = (
    "SELECT lang, CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' WHEN 'es' THEN 'Spanish'"
    " ELSE lang END AS lang_name, count(*) AS n FROM documents GROUP BY lang"
)
GRAMS = r"""grams AS (SELECT doc_id, lang, unnest(list_transform(range(1, length(f) - 1), lambda i: substr(f, i, 3))) AS trigram
    FROM (SELECT doc_id, lang, '_' || unnest(regexp_extract_all(lower({text}), '\p{{L}}+')) || '_' AS f FROM documents))"""
PROFILES = "profiles AS (SELECT lang, trigram, count(*) AS n FROM grams GROUP BY lang, trigram)"
ORACLES["lang_profiles"] = _with(GRAMS.format(text="text"), PROFILES) + "SELECT lang, trigram, n FROM profiles"
ORACLES["detect_lang"] = _with(
    GRAMS.format(text="text"),
    PROFILES,
    "seen AS ("
    + _with(
        GRAMS.format(
            text=r"regexp_replace(regexp_replace(regexp_replace(text, 'RT', ''), '@\p{{L}}+', '', 'g'), 'https?://\S+\s?', '', 'g')".replace("{{", "{").replace("}}", "}")
        )
    )
    + "SELECT doc_id, trigram, count(*) AS times FROM grams GROUP BY doc_id, trigram)",
    "sizes AS (SELECT lang, sum(n) + (SELECT count(DISTINCT trigram) FROM profiles) AS size FROM profiles GROUP BY lang)",
    """scored AS (SELECT s.doc_id, z.lang, round(sum(s.times * ln((coalesce(p.n, 0) + 1) / z.size)), 6) AS score
    FROM seen s CROSS JOIN sizes z LEFT JOIN profiles p ON p.lang = z.lang AND p.trigram = s.trigram GROUP BY s.doc_id, z.lang
    HAVING count(p.n) > 0)""",
    "best AS (SELECT doc_id, lang FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) = 1)",
) + "SELECT d.doc_id, coalesce(b.lang, 'unknown') AS detected FROM documents d LEFT JOIN best b ON b.doc_id = d.doc_id"

# Statuses

STATUSES = """a2 AS (SELECT event_id AS id, epoch_us(ts) AS us, 'user_' || user_id AS "user", event_type AS text,
    CASE user_id % 4 WHEN 0 THEN 'de' WHEN 1 THEN 'no' ELSE 'en' END AS lang,
    CASE k % 4 WHEN 0 THEN [] WHEN 1 THEN ['t' || k % 20] ELSE ['t' || k % 20, 't' || (k * 7) % 20] END AS hashtags,
    CASE WHEN event_type = 'view' THEN event_id - 1 - user_id % 3 END AS retweet_of
    FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INT) AS k FROM events)),
a2w AS (SELECT *, CAST((us // {step} - unnest(range(0, {n}))) * {slide} AS BIGINT) AS window_start FROM a2)""".format(
    step=SLIDE * 1_000_000, n=WINDOW // SLIDE, slide=SLIDE
)
WINDOWED = STATUSES + """,
kept AS (SELECT * FROM a2w WHERE lang IN ('en', 'no')),
rc AS (SELECT window_start, retweet_of AS id, count(*) AS n FROM kept WHERE retweet_of IS NOT NULL GROUP BY ALL),
orig AS (SELECT * FROM kept WHERE retweet_of IS NULL),
hc AS (SELECT window_start, tag, count(*) AS n FROM (SELECT window_start, unnest(hashtags) AS tag FROM orig) GROUP BY ALL)"""
BOARD = WINDOWED + f""",
board AS (SELECT * FROM (SELECT o.window_start, o.window_start + {WINDOW} AS window_end, coalesce(hc.n, 0) AS hashtagcount,
    coalesce(o.hashtags[1], 'None') AS hashtag, o.id, o."user", coalesce(rc.n, 0) + 1 AS retweets, o.text
    FROM orig o LEFT JOIN rc ON rc.window_start = o.window_start AND rc.id = o.id
    LEFT JOIN hc ON hc.window_start = o.window_start AND hc.tag = o.hashtags[1])
    WHERE hashtagcount <> 1 OR retweets > 1)"""
SHOWN = """SELECT window_start, window_end, hashtagcount, hashtag, {place}CASE WHEN over THEN NULL ELSE id END AS id,
    CASE WHEN over THEN NULL ELSE "user" END AS "user", CASE WHEN over THEN NULL ELSE retweets END AS retweets,
    CASE WHEN over THEN NULL ELSE text END AS text, rank, over AS overflow FROM """
TOP3 = BOARD + """,
top3 AS (SELECT *, coalesce(rank > 3, false) AS over FROM (SELECT *, CASE WHEN hashtag <> 'None' THEN
    CAST(row_number() OVER (PARTITION BY window_start, hashtag ORDER BY id) AS INT) END AS rank FROM board)
    WHERE rank IS NULL OR rank <= 4)"""

ORACLES["tweet_windows"] = _with(STATUSES) + f"SELECT id, window_start, window_start + {WINDOW} AS window_end FROM a2w"
ORACLES["retweet_counts"] = _with(WINDOWED) + f"SELECT window_start, window_start + {WINDOW} AS window_end, id, n FROM rc"
ORACLES["hashtag_counts"] = _with(WINDOWED) + f"SELECT window_start, window_start + {WINDOW} AS window_end, tag, n FROM hc"
ORACLES["tag_popularity"] = _with(WINDOWED) + (
    "SELECT o.window_start, o.id, o.hashtags[1] AS tag, hc.n AS hashtagcount FROM orig o"
    " JOIN hc ON hc.window_start = o.window_start AND hc.tag = o.hashtags[1]"
)
ORACLES["tweet_board"] = _with(BOARD) + "SELECT * FROM board"
ORACLES["board_top3"] = _with(TOP3) + SHOWN.format(place="") + "top3"
ORACLES["board_numbered"] = _with(TOP3) + (
    "SELECT row_number() OVER (ORDER BY window_end, hashtagcount DESC, hashtag, id) AS row_no,"
    " window_end, hashtagcount, hashtag, id, retweets FROM top3 WHERE NOT over"
)
ORACLES["board_top10"] = _with(
    BOARD,
    """firsts AS (SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY hashtagcount DESC, hashtag, id) AS INT) AS place,
    CASE WHEN hashtag <> 'None' THEN CAST(row_number() OVER (PARTITION BY window_start, hashtag ORDER BY id) AS INT) END AS rank
    FROM board)""",
) + SHOWN.format(place="").replace("text, rank, over", "text, place, rank, over") + (
    "(SELECT *, coalesce(rank > 3, false) AS over FROM firsts WHERE place <= 10 AND (rank IS NULL OR rank <= 4))"
)

# Phone numbers

RECORDS = """a3 AS (SELECT doc_id, 'http://' || source || '.example.com/' || doc_id AS url,
    text || ' tel +31 (0)20-' || lpad(CAST(doc_id % 400 AS VARCHAR), 7, '0')
    || '. mob 0031 6 1' || lpad(CAST(doc_id % 300 AS VARCHAR), 7, '0') || ', fax +31 99 1234567. free +31 800 '
    || lpad(CAST(doc_id % 50 AS VARCHAR), 4, '0') || '.' AS content FROM documents)"""
_codes = lambda codes: ", ".join(f"'{c}'" for c in codes)
HITS = rf"""runs AS (SELECT url, unnest(regexp_extract_all(content,
    '(?s)(?:0031|\+31|\+.31|\+..31)([0-9+() -]*)[^0-9+() -]', 1)) AS run FROM a3),
digits AS (SELECT url, run, '0' || regexp_replace(regexp_replace(run, '[^0-9]', '', 'g'), '^0', '') AS num FROM runs),
hits AS (SELECT num, url FROM digits WHERE NOT starts_with(num, '00') AND (length(num) = 10
    OR (length(num) = 8 AND substr(num, 1, 4) IN ('0800', '0900'))
    OR (length(num) = 11 AND substr(num, 1, 4) IN ('0800', '0900') AND regexp_matches(run, '[0-9]$')))
    AND (substr(num, 1, 3) IN ({_codes(AREA_CODES_3)}) OR substr(num, 1, 4) IN ({_codes(AREA_CODES_4)})))"""
MANIFEST = """uris AS (SELECT CASE WHEN doc_id % 7 = 0 THEN 'ftp://x' WHEN doc_id % 11 = 0 THEN 'file:/d/' || doc_id
    WHEN doc_id % 13 = 0 THEN 's3:/bucket' ELSE 's3://bucket/' || doc_id END AS uri FROM documents),
entries AS (SELECT uri, CASE WHEN starts_with(uri, 'file:') THEN 'file'
    WHEN regexp_matches(uri, '^s3://([^/]+)/(.+)') THEN 's3' WHEN starts_with(uri, 's3:/') THEN 'invalid' ELSE 'unknown' END AS status
    FROM uris)"""
OLD = r"(?:\D00[()\- ]*3[()\- ]*1|\+[()\- ]*3[()\- ]*1)(?:[()\- ]*\( *?0 *?\))?(?:[()\- ]*[0-9]){9}"

ORACLES["wet_records"] = _with(
    RECORDS, f"raw AS (SELECT 'WARC-Target-URI: ' || url || {CRLF} || content AS value FROM a3)"
) + rf"""SELECT regexp_extract(value, 'WARC-Target-URI: *([^\r\n]*)', 1) AS url,
    substr(value, strpos(value, {CRLF}) + 4) AS content FROM raw"""
ORACLES["manifest_split"] = _with(MANIFEST) + (
    "SELECT uri, status, CASE status WHEN 'file' THEN uri WHEN 's3' THEN 's3a:' || substr(uri, 4) END AS path FROM entries"
)
ORACLES["phone_hits"] = _with(RECORDS, HITS) + "SELECT num, url FROM hits"
ORACLES["phone_index"] = _with(RECORDS, HITS) + (
    "SELECT num, url, count(*) AS times FROM hits GROUP BY num, url"
)
ORACLES["phone_legacy"] = _with(
    RECORDS, f"found AS (SELECT doc_id, url, unnest(regexp_extract_all(content, '{OLD}')) AS m FROM a3)"
) + r"""SELECT DISTINCT ON (doc_id, num) num, url FROM (SELECT doc_id, url, regexp_replace(regexp_replace(regexp_replace(
    CASE WHEN starts_with(m, '+') THEN m ELSE substr(m, 2) END, '[()\- ]*\( *?0 *?\)', '', 'g'), '[()\- ]*', '', 'g'), '^00', '+')
    AS num FROM found)"""
ORACLES["phone_stats"] = _with(RECORDS, HITS, MANIFEST) + """SELECT
    (SELECT count(DISTINCT num) FROM hits) AS unique_numbers, CAST((SELECT count(*) FROM hits) AS BIGINT) AS hits, count(*) AS segments,
    count(*) FILTER (status IN ('file', 's3')) AS processed_segments,
    count(*) FILTER (status NOT IN ('file', 's3')) AS failed_segments FROM entries"""

# People and titles

FILMS = """a9 AS (SELECT s_name AS name, s_suppkey % 2 = 0 AS is_male, list_transform(range(0, 5), lambda i:
    CASE WHEN i = 3 THEN '"' ELSE '' END || 'Film' || i || ' (' || CASE WHEN i = 4 AND s_suppkey % 7 = 0 THEN '????'
    ELSE CAST(2005 + (s_suppkey + i) % 16 AS VARCHAR) END || ') [x]') AS titles FROM supplier)"""
CLEAN = r"""cleaned AS (SELECT name, is_male, list_filter(list_transform(list_filter(titles, lambda x: NOT starts_with(x, '"')),
    lambda x: substr(x, 1, strpos(x, ')'))), lambda x:
    coalesce(TRY_CAST(substr(regexp_extract(x, '\(([^)]*)\)', 1), 1, 4) AS INT) >= 2011, false)) AS titles FROM a9)"""
EDGES = """e AS MATERIALIZED (SELECT DISTINCT l_partkey AS actor_id,
    l_orderkey * 64 + CAST(floor((l_quantity - 1) / 2) AS BIGINT) AS movie FROM lineitem)"""
ACTORS = """people AS (SELECT p_partkey AS actor_id, p_name AS name, p_partkey % 2 = 0 AS is_male FROM part
    WHERE p_partkey IN (SELECT actor_id FROM e))"""


def _bfs() -> str:
    hops = [f"f0 AS MATERIALIZED (SELECT CAST({ROOT} AS BIGINT) AS actor_id)"]
    for hop in range(1, 7):
        seen = " UNION ALL ".join(f"SELECT actor_id FROM f{i}" for i in range(hop))
        hops.append(
            f"f{hop} AS MATERIALIZED (SELECT DISTINCT b.actor_id FROM f{hop - 1} f JOIN e a ON a.actor_id = f.actor_id"
            f" JOIN e b ON b.movie = a.movie WHERE b.actor_id NOT IN ({seen}))"
        )
    near = " UNION ALL ".join(f"SELECT actor_id, {i} AS distance FROM f{i}" for i in range(7))
    hops.append(
        f"dist AS MATERIALIZED (SELECT p.actor_id, CAST(coalesce(n.distance, 100) AS INT) AS distance"
        f" FROM (SELECT DISTINCT actor_id FROM e) p LEFT JOIN ({near}) n ON n.actor_id = p.actor_id)"
    )
    return ",\n".join(hops)


BFS = _bfs()
HISTOGRAM = """histogram AS (SELECT CAST(h.range AS INT) AS distance, count(*) FILTER (p.is_male) AS males,
    count(*) FILTER (NOT p.is_male) AS females FROM range(1, 7) h LEFT JOIN dist d ON d.distance = h.range
    LEFT JOIN people p ON p.actor_id = d.actor_id GROUP BY h.range)"""

ORACLES["list_trim"] = """WITH a9 AS (SELECT s_suppkey + 1 AS line_no, CASE WHEN s_suppkey = 2 THEN 'Name  Titles'
    WHEN s_suppkey = 3 THEN '----  ------' WHEN s_suppkey = (SELECT max(s_suppkey) FROM supplier) - 2 THEN '-----'
    ELSE s_name || chr(9) || 'Film (2012)' END AS value FROM supplier),
h AS (SELECT min(line_no) AS header FROM a9 WHERE regexp_replace(value, '\\s', '', 'g') = 'NameTitles'),
f AS (SELECT coalesce(min(line_no), 9223372036854775807) AS footer FROM a9, h WHERE line_no > header + 1 AND starts_with(value, '---'))
SELECT line_no, value FROM a9, h, f WHERE line_no > header + 1 AND line_no < footer""".replace("\\\\", "\\")
ORACLES["titles_clean"] = _with(FILMS, CLEAN) + (
    "SELECT name, is_male, array_to_string(titles, '|') AS titles FROM cleaned WHERE len(titles) > 0"
)
ORACLES["people_union"] = _with(FILMS) + "SELECT name, is_male, array_to_string(titles, '|') AS titles FROM a9"
ORACLES["people_ids"] = _with(FILMS, CLEAN) + (
    "SELECT row_number() OVER (ORDER BY is_male DESC, name) - 1 AS actor_id, name, is_male FROM cleaned WHERE len(titles) > 0"
)
ORACLES["bipartite_edges"] = _with(EDGES) + "SELECT actor_id, movie FROM e"
ORACLES["costar_pairs"] = _with(EDGES) + (
    "SELECT a.actor_id, b.actor_id AS costar_id, a.movie FROM e a JOIN e b ON b.movie = a.movie"
    " WHERE a.actor_id <> b.actor_id AND a.actor_id IN (SELECT p_partkey FROM part WHERE p_size = 1)"
)
ORACLES["costar_counts"] = _with(EDGES) + (
    "SELECT a.actor_id, count(DISTINCT a.movie) AS titles, count(*) - count(DISTINCT a.movie) AS shared"
    " FROM e a JOIN e b ON b.movie = a.movie GROUP BY a.actor_id"
)
ORACLES["bfs_distance"] = _with(EDGES, BFS) + "SELECT actor_id, distance FROM dist"
ORACLES["distance_histogram"] = _with(EDGES, ACTORS, BFS, HISTOGRAM) + "SELECT distance, males, females FROM histogram"
ORACLES["separation_summary"] = _with(
    EDGES,
    ACTORS,
    BFS,
    HISTOGRAM,
    "t AS (SELECT count(*) AS people, count(*) FILTER (is_male) AS males, count(*) FILTER (NOT is_male) AS females FROM people)",
    "n AS (SELECT CAST(sum(males) AS BIGINT) AS near_males, CAST(sum(females) AS BIGINT) AS near_females FROM histogram)",
) + """SELECT people, males, males * 100 // people AS males_percent, females, females * 100 // people AS females_percent,
    (SELECT count(DISTINCT movie) FROM e) AS movies, near_males + near_females AS near, near_males, near_females,
    round((near_males + near_females) / people, 6) AS near_ratio, round(near_males / males, 6) AS near_males_ratio,
    round(near_females / females, 6) AS near_females_ratio FROM t, n"""
ORACLES["people_at_distance"] = _with(EDGES, ACTORS, BFS) + (
    "SELECT is_male, row_number() OVER (PARTITION BY is_male ORDER BY name, actor_id) AS place, name, actor_id"
    " FROM people WHERE actor_id IN (SELECT actor_id FROM dist WHERE distance = 6)"
)

# Variants

VARIANTS = """v AS (SELECT CASE WHEN l_orderkey % 113 = 0 THEN 'chrUn' ELSE 'chr' || (l_suppkey % 22 + 1) END AS chrom, l_partkey * 50000 + l_linenumber AS pos,
    l_returnflag AS ref, l_linestatus AS alt, l_quantity, l_discount FROM lineitem)"""
CONTIGS = """contigs AS (SELECT idx, CASE idx WHEN 0 THEN 'chrM' WHEN 23 THEN 'chrUn_gl1' ELSE 'chr' || idx END AS name,
    (SELECT (max(l_partkey) + 1) * 50000 FROM lineitem) + idx AS length
    FROM (SELECT DISTINCT CAST(l_suppkey % 24 AS INT) AS idx FROM lineitem)),
ci AS (SELECT CAST(row_number() OVER (ORDER BY idx) - 1 AS INT) AS contig_no, name, length FROM contigs
    WHERE regexp_full_match(name, 'chr([0-9]+|[MXY])'))"""
DENSITY = """density AS (SELECT v.chrom, ci.contig_no AS idx, CAST(pos // 1000000 + 1 AS INT) AS region, count(*) AS n
    FROM v JOIN ci ON ci.name = v.chrom GROUP BY ALL)"""
OFFSETS = """present AS (SELECT DISTINCT idx, chrom FROM density),
offsets AS (SELECT p.idx, p.chrom, CAST(coalesce(sum(c.length) OVER (ORDER BY p.idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    AS BIGINT) AS "offset" FROM present p JOIN contigs c ON c.name = p.chrom)"""
PER_REGION = f"""per AS MATERIALIZED (SELECT CAST(sum(n) AS BIGINT) AS variants, CAST(ceil(sum(n) / {REGIONS}) AS BIGINT) AS per_region FROM density)"""
PACK = """bins AS MATERIALIZED (SELECT row_number() OVER (ORDER BY idx, region) AS rn, n FROM density),
walk AS (SELECT CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS size, CAST(0 AS BIGINT) AS parts, CAST(0 AS DOUBLE) AS at,
        CAST(-1 AS INT) AS closed, CAST(NULL AS DOUBLE) AS start, CAST(NULL AS DOUBLE) AS "end"
    UNION ALL SELECT b.rn,
        CASE WHEN w.size > p.per_region THEN b.n ELSE w.size + b.n END,
        CASE WHEN w.size > p.per_region THEN 1 ELSE w.parts + 1 END,
        CASE WHEN w.size > p.per_region THEN w.at + w.parts * 1e6 ELSE w.at END,
        CASE WHEN w.size > p.per_region THEN w.closed + 1 ELSE w.closed END,
        CASE WHEN w.size > p.per_region THEN w.at END,
        CASE WHEN w.size > p.per_region THEN w.at + w.parts * 1e6 END
    FROM walk w JOIN bins b ON b.rn = w.rn + 1 CROSS JOIN per p),
regions AS MATERIALIZED (SELECT closed AS region, start, "end" FROM walk WHERE start IS NOT NULL)"""
ASSIGNED = f"""placed AS (SELECT l_orderkey || '_' || l_linenumber AS name, CAST(l_suppkey % 22 + 1 AS INT) AS ref_index,
    l_partkey * 50000 + l_linenumber AS pos FROM lineitem),
assigned AS (SELECT p.name, p.ref_index, p.pos, CAST(coalesce(r.region, {REGIONS} - 1) AS INT) AS region
    FROM placed p LEFT JOIN offsets o ON o.idx = p.ref_index
    LEFT JOIN regions r ON p.pos + o."offset" > r.start AND p.pos + o."offset" < r."end")"""
CALLS = """ra AS (SELECT DISTINCT chrom, pos, ref, alt FROM v WHERE l_quantity <= 30),
rb AS (SELECT DISTINCT chrom, pos, ref, alt FROM v WHERE l_discount >= 0.03)"""
CHROM = "chrom, pos, ref, alt"

ORACLES["variants_scan"] = """WITH v AS (SELECT CASE WHEN l_linenumber = 7 THEN '#order ' || l_orderkey ELSE
    'chr' || (l_suppkey % 22 + 1) || chr(9) || (l_partkey * 50000 + l_linenumber) || chr(9) || 'rs' || l_orderkey || chr(9)
    || l_returnflag || chr(9) || l_linestatus END AS line FROM lineitem),
f AS (SELECT string_split(line, chr(9)) AS f, line FROM v WHERE NOT starts_with(line, '#'))
SELECT f[1] AS chrom, CAST(f[2] AS BIGINT) AS pos, f[3] AS id, f[4] AS ref, f[5] AS alt, line FROM f"""
ORACLES["contig_index"] = _with(CONTIGS) + "SELECT contig_no, name, length FROM ci"
ORACLES["variant_density"] = _with(VARIANTS, CONTIGS, DENSITY) + "SELECT chrom, idx, region, n FROM density"
ORACLES["variant_density_chunks"] = _with(
    VARIANTS,
    CONTIGS,
    "sites AS (SELECT chrom, pos, count(*) AS n FROM v GROUP BY chrom, pos)",
    "ranked AS (SELECT chrom, n, CAST((row_number() OVER (PARTITION BY chrom ORDER BY pos) - 1) // 1000 AS INT) AS chunk FROM sites)",
) + (
    "SELECT r.chrom, ci.contig_no AS idx, r.chunk, CAST(sum(r.n) AS BIGINT) AS n"
    " FROM ranked r JOIN ci ON ci.name = r.chrom GROUP BY r.chrom, ci.contig_no, r.chunk"
)
ORACLES["contig_offsets"] = _with(VARIANTS, CONTIGS, DENSITY, OFFSETS) + 'SELECT idx, chrom, "offset" FROM offsets'
ORACLES["variants_per_region"] = _with(VARIANTS, CONTIGS, DENSITY, PER_REGION) + "SELECT variants, per_region FROM per"
ORACLES["region_pack"] = _with(VARIANTS, CONTIGS, DENSITY, PER_REGION, PACK, recursive=True) + 'SELECT region, start, "end" FROM regions'
ORACLES["variant_order"] = _with(VARIANTS) + (
    "SELECT CAST(substr(chrom, 4) AS INT) AS chrom_no, chrom, pos, ref, alt FROM v WHERE chrom <> 'chrUn'"
)
ORACLES["order_rejects"] = _with(VARIANTS) + "SELECT chrom, count(*) AS n FROM v WHERE chrom = 'chrUn' GROUP BY chrom"
ORACLES["density_rejects"] = _with(VARIANTS, CONTIGS) + (
    "SELECT chrom, count(*) AS n FROM v WHERE chrom NOT IN (SELECT name FROM ci) GROUP BY chrom"
)
ORACLES["variant_concordance"] = _with(VARIANTS, CALLS) + f"""SELECT (SELECT count(*) FROM ra) AS total,
    (SELECT count(*) FROM (SELECT {CHROM} FROM ra INTERSECT SELECT {CHROM} FROM rb)) AS matches,
    (SELECT count(*) FROM (SELECT {CHROM} FROM ra EXCEPT SELECT {CHROM} FROM rb)) AS diff"""
ORACLES["variant_common"] = _with(VARIANTS, CALLS) + f"SELECT {CHROM} FROM ra INTERSECT SELECT {CHROM} FROM rb"
ORACLES["variant_missing"] = _with(VARIANTS, CALLS) + f"SELECT {CHROM} FROM ra EXCEPT SELECT {CHROM} FROM rb"

# Reads and intervals

READS = """r AS (SELECT l_orderkey || '_' || l_linenumber AS name,
    CASE WHEN l_orderkey % 101 <> 0 THEN l_suppkey % 27 END AS ref_index, l_partkey * 50 + l_linenumber AS start,
    l_partkey * 50 + l_linenumber + CAST(l_quantity AS BIGINT) AS "end", l_returnflag = 'R' AS unmapped,
    CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand, CAST(l_quantity AS BIGINT) AS score FROM lineitem)"""
MAPPED = "m AS (SELECT * FROM r WHERE NOT unmapped AND ref_index > 0 AND ref_index <= 24)"


def _islands(source: str, key: str, opens: str) -> str:
    return f"""marked AS (SELECT *, max("end") OVER (PARTITION BY {key} ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    AS seen FROM {source}),
grouped AS (SELECT *, sum(CASE WHEN seen IS NULL OR {opens} THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY start, "end"
    ROWS UNBOUNDED PRECEDING) AS island FROM marked),
islands AS (SELECT {key}, min(start) AS start, max("end") AS "end" FROM grouped GROUP BY {key}, island)"""


COVERED = _islands("m", "ref_index", "start > seen + 51")

ORACLES["reads_filtered"] = _with(READS, MAPPED) + 'SELECT name, ref_index, start, "end" FROM m'
ORACLES["region_assign"] = _with(VARIANTS, CONTIGS, DENSITY, OFFSETS, PER_REGION, PACK, ASSIGNED, recursive=True) + (
    "SELECT name, ref_index, pos, region FROM assigned"
)
ORACLES["reads_per_region"] = _with(VARIANTS, CONTIGS, DENSITY, OFFSETS, PER_REGION, PACK, ASSIGNED, recursive=True) + (
    "SELECT region, count(*) AS n FROM assigned GROUP BY region"
)
ORACLES["covered_intervals"] = _with(READS, MAPPED, COVERED) + 'SELECT ref_index, start, "end" FROM islands'
ORACLES["merge_overlap"] = _with(
    READS,
    "named AS (SELECT 'chr' || ref_index AS chrom, start, \"end\" FROM r WHERE ref_index IS NOT NULL)",
    _islands("named", "chrom", "NOT (start - 20 < seen)"),
) + 'SELECT chrom, CAST(greatest(start - 20, 1) AS BIGINT) AS start, "end" FROM islands'
ORACLES["interval_intersect"] = _with(
    READS, MAPPED, COVERED, 'tg AS (SELECT p_partkey % 27 AS ref_index, p_partkey * 50 AS start, p_partkey * 50 + p_size * 10 AS "end" FROM part)'
) + """SELECT t.ref_index, greatest(t.start, i.start - 1) AS start, least(t."end", i."end") AS "end"
    FROM tg t JOIN islands i ON i.ref_index = t.ref_index AND t.start < i."end" AND i.start - 1 < t."end" """
ORACLES["quality_encoding"] = """WITH q AS (SELECT o_orderkey AS pair, CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey % 40 END AS grp,
    list_transform(string_split(repeat(chr(CAST(64 + o_custkey % 40 AS INT)), 5), ''), lambda c: ascii(c) - 33) AS raw FROM orders),
g AS (SELECT grp, max(list_max(raw)) > 60 AS illumina FROM q GROUP BY grp),
s AS (SELECT q.pair, q.grp, g.illumina, CASE WHEN g.illumina THEN list_transform(raw, lambda x: x - 31) ELSE raw END AS quals
    FROM q JOIN g ON g.grp IS NOT DISTINCT FROM q.grp)
SELECT pair, grp, illumina, array_to_string(quals, ',') AS quals, list_min(quals) < 0 AS bad FROM s"""
ORACLES["read_groups"] = _with(READS) + (
    "SELECT name, ref_index, 'GROUP1' AS rgid, 'LIB1' AS rglb, 'ILLUMINA' AS rgpl, 'UNIT1' AS rgpu, 'SAMPLE1' AS rgsm FROM r"
)
ORACLES["mark_duplicates"] = _with(READS) + (
    "SELECT name, ref_index, start, strand, score, ref_index IS NOT NULL AND name <> first_value(name) OVER"
    " (PARTITION BY ref_index, start, strand ORDER BY score DESC, name) AS duplicate FROM r"
)
ORACLES["interleave_chunks"] = """WITH mates AS (SELECT o_orderkey AS pair, unnest([0, 1]) AS mate, 'r' || o_orderkey AS name,
    o_orderpriority AS seq, repeat(chr(CAST(64 + o_custkey % 40 AS INT)), 5) AS qual FROM orders)
SELECT CAST((pair * 2 + mate) // 16384 AS INT) AS chunk, CAST((pair * 2 + mate) % 16384 AS INT) AS slot, pair, mate,
    name || CASE mate WHEN 1 THEN '/2' ELSE '' END AS name, CASE mate WHEN 1 THEN reverse(seq) ELSE seq END AS seq, qual FROM mates"""

# Lines as the writers put them, and the parsers of single lines

ORACLES["multiword_segments"] = _with(LINES, SEGMENTS) + "SELECT array_to_string(w, ' ') AS segment FROM ws WHERE len(w) > 1"
ORACLES["script_tests"] = _with(LINES) + r"""SELECT doc_id, regexp_matches(line, '[\x{3040}-\x{309F}]') OR length(line) % 5 = 0 AS hiragana,
    regexp_matches(line, '\p{Hangul}') OR length(line) % 5 = 1 AS hangul FROM a1"""
ORACLES["word_freq_lines"] = _with(LINES, SEGMENTS, COUNTS, BIGRAMS) + (
    "SELECT word || ':' || n AS value FROM counts UNION ALL SELECT chr(9) || b.pred || ':' || b.n FROM counts c JOIN bigrams b ON b.word = c.word"
)
ORACLES["density_text"] = _with(VARIANTS, CONTIGS, DENSITY) + "SELECT concat_ws(chr(9), chrom, idx, region, n) AS value FROM density"
ORACLES["bed_lines"] = _with(READS, MAPPED, COVERED) + 'SELECT concat_ws(chr(9), ref_index, start - 1, "end") AS value FROM islands'
ORACLES["bed_lines_compatible"] = _with(READS, MAPPED, COVERED) + 'SELECT concat_ws(chr(9), ref_index, start - 1, "end" - 1) AS value FROM islands'
ORACLES["region_strings"] = _with(READS, MAPPED, COVERED) + "SELECT ref_index || ':' || start || '-' || \"end\" AS value FROM islands"
ORACLES["sam_reads"] = _with(CONTIGS) + """SELECT l_orderkey || '_' || l_linenumber AS qname,
    CAST(CASE WHEN l_returnflag = 'R' THEN 4 ELSE 0 END + CASE WHEN l_linestatus = 'F' THEN 16 ELSE 0 END AS INT) AS flag,
    'chr' || (l_suppkey % 27) AS rname, l_partkey * 50 + l_linenumber AS pos, 60 AS mapq,
    CAST(l_quantity AS BIGINT) || 'M2I' || l_linenumber || 'D3S' AS cigar, '=' AS rnext, l_partkey * 50 + l_linenumber AS pnext, 0 AS tlen,
    'ACGT' AS seq, repeat(l_returnflag, 4) AS qual,
    CAST(l_partkey * 50 + l_linenumber + CAST(l_quantity AS BIGINT) + l_linenumber - 1 AS BIGINT) AS align_end,
    l_returnflag = 'R' AS unmapped, CASE WHEN l_linestatus = 'F' THEN '-' ELSE '+' END AS strand, c.idx AS ref_index
FROM lineitem LEFT JOIN contigs c ON c.name = 'chr' || (l_suppkey % 27) WHERE l_linenumber NOT IN (6, 7)"""
ORACLES["people_records"] = """SELECT s_name AS name, true AS is_male,
    'Film (' || (2000 + s_suppkey % 20) || ')' || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE '|Two' END AS titles FROM supplier WHERE s_suppkey % 11 <> 0"""
ORACLES["chunk_ids"] = """SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'done.txt' ELSE printf('fastq_%06d.fq', o_orderkey) END AS value,
    CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey AS INT) END AS chunk FROM orders"""
ORACLES["separation_lines"] = _with(
    EDGES, ACTORS, BFS, HISTOGRAM,
    "sums AS (SELECT count(*) AS p, count(*) FILTER (is_male) AS m, count(*) FILTER (NOT is_male) AS f FROM people)",
    "last6 AS (SELECT p.is_male, row_number() OVER (PARTITION BY p.is_male ORDER BY p.name, p.actor_id) AS place, p.name"
    " FROM people p JOIN dist d USING (actor_id) WHERE d.distance = 6)",
) + """SELECT printf('Total number of actors = %d, out of which %d (%d%%) are males while %d (%d%%) are females.', p, m, m * 100 // p, f, f * 100 // p) AS line FROM sums
UNION ALL SELECT 'Total number of movies = ' || count(DISTINCT movie) FROM e
UNION ALL SELECT unnest(['', '', '', 'List of male actors at distance 6:', 'List of female actors (actresses) at distance 6:'])
UNION ALL SELECT printf('There are %d (%.1f%%) actors and %d (%.1f%%) actresses at distance %d', males, males * 100.0::DOUBLE / m, females, females * 100.0::DOUBLE / f, distance)
    FROM histogram, sums
UNION ALL SELECT place || '. ' || name FROM last6"""
