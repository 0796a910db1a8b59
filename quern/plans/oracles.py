"""DuckDB SQL for the registered queries, built from the same fixed patterns."""

from __future__ import annotations

from functools import reduce

from quern.config import CharGramConfig
from quern.functions import patterns as P
from quern.functions import text as T
from quern.functions.wordlists import english_stop_words
from quern.operators import manifest as M
from quern.operators.features import LOGGED
from quern.plans.samples import PATHS, PHRASES, SHEET_TYPES


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(items) -> str:
    return "(" + ", ".join(map(lit, items)) + ")"


FAMILY = "CASE lang WHEN 'en' THEN 'text' WHEN 'de' THEN 'pdf' WHEN 'fr' THEN 'image' ELSE 'binary' END"
KIND = "CASE lang WHEN 'en' THEN 'email_prose' WHEN 'de' THEN 'chat_ichat_prose' ELSE lang END"
TOPIC = "CASE WHEN source < 'src13' THEN 0 WHEN source < 'src17' THEN 1 ELSE -1 END"
FORM = "CASE lang WHEN 'en' THEN 'c0001' WHEN 'de' THEN 'c0000' WHEN 'es' THEN 'c0002' ELSE 'noise' END"
PREVIEW = r"replace(substring(text, 1, 800), chr(13), '\r')"


def strip(x: str) -> str:
    return f"trim({x}, {lit(P.BLANKS)})"


def sub(x: str, pattern: str, by: str, fold: bool = True) -> str:
    return f"regexp_replace({x}, {lit(P.re2(pattern, fold))}, {lit(by)}, 'g')"


def found(x: str, pattern: str, fold: bool = True) -> str:
    return f"regexp_matches({x}, {lit(P.re2(pattern, fold))})"


def collapse(x: str) -> str:
    return strip(sub(x, P.BLANK + "+", " ", False))


def lines(x: str) -> str:
    parts = f"regexp_split_to_array({x}, {lit(P.LINE_BREAK)})"
    return f"CASE WHEN {x} = '' THEN [] ELSE list_filter({parts}, lambda p, i: p <> '' OR i < len({parts})) END"


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {lit(P.BLANK + '+')}), lambda w: w <> '')"


def matches(x: str, pattern: str, fold: bool = False) -> str:
    return f"len(regexp_extract_all({x}, {lit(P.re2(pattern, fold))}))::BIGINT"


def _left(x: str, pattern: str) -> str:
    return f"length(regexp_replace({x}, {lit(pattern + '+')}, '', 'g'))"


def stats(table: str, key: str, text: str = "text", more: str = "") -> str:
    """A query of the 13 statistics, with ``key`` and further columns."""
    share = lambda p: f"CASE WHEN t = '' THEN 0.0 ELSE {_left('t', p)} / length(t) END"
    return f"""SELECT {key}{more}, length(t)::BIGINT AS n_chars, len(ls)::BIGINT AS n_lines, len({tokens('t')})::BIGINT AS n_tokens,
    len(list_filter(ls, lambda x: {strip('x')} = ''))::BIGINT AS blank_lines,
    coalesce(list_sum(list_transform(ls, lambda x: length(x))), 0) / greatest(1, len(ls)) AS avg_line_len,
    coalesce(list_max(list_transform(ls, lambda x: length(x))), 0)::BIGINT AS max_line_len,
    {share(r'[^0-9]')} AS digit_ratio, {share(r'[^\p{Lu}]')} AS upper_ratio, {share(r'[\x00-\x7f]')} AS non_ascii_ratio,
    {matches('t', P.EMAIL)} AS email_count, {matches('t', P.PHONE)} AS phone_like_count, {matches('t', P.DATE)} AS date_like_count, {matches('t', P.MONEY, True)} AS money_like_count
    FROM (SELECT *, {lines('t')} AS ls FROM (SELECT *, coalesce({text}, '') AS t FROM {table}))"""


def _rounded(columns, of) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c in of else c for c in columns)


RATIOS = ("avg_line_len", "digit_ratio", "upper_ratio", "non_ascii_ratio")


def _text_stats(table: str, key: str, text: str = "text") -> str:
    return f"SELECT {key}, {_rounded(M.COUNTS, RATIOS)} FROM ({stats(table, key, text)})"


def _flags() -> str:
    return f"""SELECT doc_id, doc_family, n_chars >= 50 AS has_text, doc_family IN ('pdf', 'image') AND n_chars < 50 AS text_missing, doc_family IN ('text', 'pdf') AND n_chars >= 50 AS text_usable_now,
    email_count > 0 AS has_emails, phone_like_count > 0 AS has_phones, date_like_count > 0 AS has_dates, money_like_count > 0 AS has_money
    FROM ({stats('documents', 'doc_id', more=f', {FAMILY} AS doc_family')})"""


MANIFEST = f"""SELECT doc_id::VARCHAR AS doc_id, sha256(text) AS sha256, source AS source_root, source || '/' || doc_id AS rel_path, {FAMILY} AS doc_family, {KIND} AS human_doc_type, lang,
    {PREVIEW} AS preview, length(text)::BIGINT AS n_chars, ({FAMILY}) IN ('text', 'pdf') AND length(text) >= 50 AS usable FROM documents"""


def _family_classify() -> str:
    values = ", ".join(f"({lit(p)})" for p in PATHS)
    return f"""WITH p AS (SELECT rel_path, regexp_extract(rel_path, '[^/]*$') AS name FROM (VALUES {values}) AS v(rel_path)),
    e AS (SELECT *, lower(regexp_extract(name, '^.+(\\.[^.]+)$', 1)) AS ext FROM p)
    SELECT rel_path, ext, CASE WHEN ext IN {listed(M.TEXT_EXTENSIONS)} THEN 'text' WHEN ext IN {listed(M.PDF_EXTENSIONS)} THEN 'pdf' WHEN ext IN {listed(M.IMAGE_EXTENSIONS)} THEN 'image' WHEN ext IN {listed(M.BINARY_EXTENSIONS)} THEN 'binary' ELSE 'other' END AS doc_family,
    name = '.DS_Store' OR starts_with(name, '._') OR list_contains(string_split(rel_path, '/'), '__MACOSX') AS skipped FROM e"""


EXTRACTION = f"""WITH d AS (SELECT doc_id, {FAMILY} AS f, CASE WHEN source < 'src15' THEN substring(text, 1, 40) ELSE '' END AS a, CASE WHEN source > 'src13' THEN substring(text, 41, 40) ELSE '' END AS b FROM documents)
SELECT doc_id, CASE WHEN f = 'text' THEN 'textlike' WHEN f = 'pdf' AND length({strip('a')}) >= 30 THEN 'pdf_text_only'
    WHEN f = 'pdf' AND a <> '' AND b <> '' THEN 'pdf_text+pdf_ocr_first_page' WHEN f = 'pdf' AND b <> '' THEN 'pdf_ocr_only_first_page' WHEN f = 'pdf' AND a <> '' THEN 'pdf_text_only' WHEN f = 'pdf' THEN 'pdf_no_text'
    WHEN f = 'image' THEN 'image_meta_only' ELSE 'binary_interesting' END AS extraction_method,
    {strip("concat_ws(chr(10) || chr(10), nullif(a, ''), nullif(b, ''))")} AS merged FROM d"""

DUP_MAP = f"""WITH m AS ({MANIFEST}), p AS (SELECT sha256, rel_path, row_number() OVER (PARTITION BY sha256 ORDER BY source_root, rel_path) AS k FROM m),
f AS (SELECT sha256, string_agg(rel_path, '|' ORDER BY k) AS dup_paths_sample FROM p WHERE k <= 5 GROUP BY sha256)
SELECT sha256, count(*) AS dup_count, string_agg(DISTINCT source_root, '|' ORDER BY source_root) AS source_roots, string_agg(DISTINCT doc_family, '|' ORDER BY doc_family) AS doc_families,
any_value(dup_paths_sample) AS dup_paths_sample, count(DISTINCT source_root) AS source_root_count FROM m JOIN f USING (sha256) GROUP BY sha256"""

CANONICAL = f"""WITH m AS ({MANIFEST}), r AS (SELECT *, count(*) OVER (PARTITION BY sha256) AS dup_count, row_number() OVER (PARTITION BY sha256 ORDER BY usable DESC,
CASE doc_family WHEN 'text' THEN 0 WHEN 'pdf' THEN 1 WHEN 'image' THEN 2 ELSE 3 END, n_chars DESC, rel_path) AS k FROM m)
SELECT sha256, doc_id, rel_path, doc_family, n_chars, dup_count FROM r WHERE k = 1"""


def _without_redactions(x: str) -> str:
    return reduce(lambda t, p: sub(t, p, " "), P.REDACTED, f"replace(coalesce({x}, ''), chr(13), chr(10))")


def _chat_meta(x: str) -> str:
    return "(" + " OR ".join([*[f"starts_with(lower({x}), {lit(p)})" for p in P.CHAT_PREFIXES], found(x, P.TIMESTAMP_LINE)]) + ")"


def normalized(kind: str, text: str) -> str:
    """An expression over a row with the columns named."""
    cut = f"list_transform({lines(_without_redactions(text))}, lambda x: {strip('x')})"
    join = lambda xs: f"coalesce(array_to_string({xs}, chr(10)), '')"
    mail = sub(join(f"list_filter({cut}, lambda x: NOT {found('x', P.HEADER_LINE)})"), P.QUOTED_PRINTABLE, " ")
    return f"CASE WHEN starts_with({kind}, 'chat_ichat') THEN {collapse(join(f'list_filter({cut}, lambda x: NOT {_chat_meta("x")})'))} WHEN starts_with({kind}, 'email_') THEN {collapse(mail)} ELSE {collapse(join(cut))} END"


NORMALIZED = f"SELECT doc_id, {normalized('kind', 'text')} AS norm FROM (SELECT doc_id, text, {KIND} AS kind FROM documents)"

_BITS = ", ".join(f"sum(CASE WHEN (h >> {i}) & 1 = 1 THEN 1 ELSE -1 END) AS b{i}" for i in range(64))
_WHOLE = " + ".join(f"CASE WHEN b{i} > 0 THEN {1 << i}::HUGEINT ELSE 0 END" for i in range(64))
HASHED = f"""n AS MATERIALIZED (SELECT doc_id, kind, {normalized('kind', 'preview')} AS norm FROM (SELECT doc_id, {KIND} AS kind, {PREVIEW} AS preview FROM documents)),
t AS (SELECT doc_id, unnest(regexp_extract_all(lower(norm), '[a-z0-9]+')) AS w FROM n), g AS (SELECT doc_id, ('0x' || substr(md5(w), 1, 16))::UBIGINT AS h FROM t),
s AS (SELECT doc_id, {_BITS} FROM g GROUP BY doc_id), u AS (SELECT doc_id, {_WHOLE} AS u FROM s),
hashed AS MATERIALIZED (SELECT doc_id, kind AS human_doc_type, length(norm)::BIGINT AS norm_len, coalesce(u, 0) AS u, (CASE WHEN coalesce(u, 0) >= 9223372036854775808 THEN u - 18446744073709551616 ELSE coalesce(u, 0) END)::BIGINT AS simhash64,
(coalesce(u, 0)::UBIGINT >> 48)::BIGINT AS bucket FROM n LEFT JOIN u USING (doc_id))"""
PAIRS = """classes AS MATERIALIZED (SELECT simhash64, u::UBIGINT AS u, bucket, norm_len, min(doc_id) AS rep FROM hashed WHERE norm_len > 0 GROUP BY ALL),
pairs AS MATERIALIZED (SELECT x.rep AS a, y.rep AS b, bit_count(xor(x.u, y.u))::BIGINT AS distance FROM classes x JOIN classes y ON x.bucket = y.bucket AND x.rep < y.rep
WHERE greatest(x.norm_len, y.norm_len) <= 2.5 * least(x.norm_len, y.norm_len) AND bit_count(xor(x.u, y.u)) <= 3)"""
GROUPS = """walk AS (SELECT rep AS node, rep AS seen FROM classes UNION SELECT w.node, CASE WHEN p.a = w.seen THEN p.b ELSE p.a END FROM walk w JOIN pairs p ON w.seen IN (p.a, p.b)),
comp AS (SELECT node, min(seen) AS head FROM walk GROUP BY node), heads AS (SELECT simhash64, norm_len, head FROM classes JOIN comp ON rep = node),
headed AS (SELECT h.doc_id, h.human_doc_type, h.norm_len, coalesce(x.head, h.doc_id) AS head FROM hashed h LEFT JOIN heads x ON h.simhash64 = x.simhash64 AND h.norm_len = x.norm_len AND h.norm_len > 0),
groups AS MATERIALIZED (SELECT *, 'g' || lpad((dense_rank() OVER (ORDER BY head) - 1)::VARCHAR, 6, '0') AS near_dup_group FROM headed)"""
_NEAR = f"WITH RECURSIVE {HASHED}, {PAIRS}, {GROUPS}"

CLUSTERED = f"m AS ({MANIFEST}), c AS (SELECT m.* EXCLUDE (human_doc_type), {FORM} AS docform_cluster, l.quality::DOUBLE AS docform_cluster_prob FROM m LEFT JOIN labels l ON m.doc_id = l.doc_id::VARCHAR)"
SAMPLES = f"""{CLUSTERED}, s AS (SELECT *, row_number() OVER (PARTITION BY docform_cluster ORDER BY coalesce(docform_cluster_prob, 0) DESC, length(preview) DESC, rel_path) AS place,
substring(regexp_replace(preview, '[\\r\\n]', ' ', 'g'), 1, 240) AS preview_snip FROM c)"""
_BLANK = ", ".join(f"'' AS {c}" for c in ("human_doc_type", "human_doc_type_confidence", "human_notes", "keep_in_corpus", "priority"))
SHEET = f"""{SAMPLES}, e AS (SELECT docform_cluster, string_agg(rel_path, ' | ' ORDER BY place) AS example_rel_paths, string_agg(preview_snip, ' || ' ORDER BY place) AS example_previews FROM s WHERE place <= 5 GROUP BY 1)"""
_TYPES = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in SHEET_TYPES.items())


def _features() -> str:
    scaled = ", ".join(f"ln(1 + {c}) AS {c}" if c in LOGGED else f"{c} AS {c}" for c in M.COUNTS)
    out = ", ".join(f"round(({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1), 6) AS {c}" for c in M.COUNTS)
    return f"SELECT doc_id, {out} FROM (SELECT doc_id, {scaled} FROM ({stats('documents', 'doc_id')}))"


def cleaned(kind: str, text: str, phrases=PHRASES) -> str:
    t = _without_redactions(text)
    for pattern, name in ((P.TIME, "TIME"), (P.NUMERIC_DATE, "DATE"), (P.MONTH_DATE, "DATE"), (P.YEAR, "YEAR")):
        t = sub(t, pattern, f" __{name}__ ")
    inner = strip("replace(x, chr(65279), '')")
    cut = f"list_transform({lines(t)}, lambda x: {strip(sub(inner, P.NO_BREAK_SPACES, ' ', False))})"
    for_lines, for_text = T.phrase_patterns(phrases)
    unwanted = [P.LOOSE_HEADER_LINE, P.FORWARD_LINE, P.BEGIN_FORWARD_LINE, P.SENT_FROM_LINE, P.ON_BEHALF_LINE, for_lines]
    kept = f"list_filter({cut}, lambda x: x <> '' AND NOT ({' OR '.join(found('x', p) for p in unwanted)}))"
    join = lambda xs: f"coalesce(array_to_string({xs}, ' '), '')"
    chat = f"starts_with({kind}, 'chat_') OR contains({kind}, 'ichat')"
    mail = f"starts_with({kind}, 'email_') OR contains({kind}, 'email')"
    whole = f"CASE WHEN {chat} THEN {join(f'list_filter({kept}, lambda x: NOT {_chat_meta("x")})')} WHEN {mail} THEN {sub(join(kept), P.QUOTED_PRINTABLE, ' ')} ELSE {join(kept)} END"
    return collapse(sub(collapse(whole), "(?m)" + for_text, " "))


CLEAN = f"SELECT doc_id, lang, kind, topic, text, preview, {cleaned('kind', 'preview')} AS clean FROM (SELECT doc_id, lang, text, {KIND} AS kind, {TOPIC} AS topic, {PREVIEW} AS preview FROM documents)"
_WORDS = f"list_filter(regexp_extract_all(strip_accents(lower(clean)), '[\\p{{L}}\\p{{N}}_]+'), lambda w: regexp_matches(w, '^[a-z_]{{2,}}$') AND w NOT IN {listed(english_stop_words())})"
TFIDF = f"""cl AS MATERIALIZED ({CLEAN}), w AS (SELECT kind, doc_id, {_WORDS} AS w FROM cl),
tm AS (SELECT kind, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w),
tf AS MATERIALIZED (SELECT kind, doc_id, term, count(*) AS tf FROM tm GROUP BY ALL), n AS (SELECT kind, count(*) AS n FROM cl GROUP BY kind),
df AS (SELECT kind, term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY ALL), vx AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY total DESC, term) AS place FROM df JOIN n USING (kind) WHERE df >= 2 AND df <= 0.85 * n),
vocab AS MATERIALIZED (SELECT *, ln((1 + n) / (1 + df)) + 1 AS idf FROM vx WHERE place <= 60000),
x AS (SELECT kind, doc_id, term, (1 + ln(tf)) * idf AS x FROM tf JOIN vocab USING (kind, term)),
vec AS MATERIALIZED (SELECT kind, doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY kind, doc_id)) AS weight FROM x)"""

KEYWORDS = f"""WITH {TFIDF}, lb AS (SELECT kind, doc_id, topic FROM cl), sz AS (SELECT kind, topic, count(*) AS topic_size FROM lb WHERE topic <> -1 GROUP BY ALL HAVING count(*) >= 5),
mean AS (SELECT kind, topic, topic_size, term, round(sum(weight) / topic_size, 9) AS mean FROM vec JOIN lb USING (kind, doc_id) JOIN sz USING (kind, topic) GROUP BY kind, topic, topic_size, term),
top AS (SELECT *, row_number() OVER (PARTITION BY kind, topic ORDER BY mean DESC, term DESC) AS place FROM mean WHERE mean > 0)
SELECT kind, topic, topic_size, string_agg(term, ', ' ORDER BY place) AS keywords FROM top WHERE place <= 15 GROUP BY kind, topic, topic_size"""

TYPE_STATS = f"""WITH {TFIDF}, v AS (SELECT kind, count(*) AS vocab_size FROM vocab GROUP BY kind), z AS (SELECT kind, count(*) AS tfidf_nnz FROM vec GROUP BY kind)
SELECT kind, n AS n_docs, coalesce(vocab_size, 0) AS vocab_size, coalesce(tfidf_nnz, 0) AS tfidf_nnz, round(coalesce(tfidf_nnz, 0) / (n * greatest(coalesce(vocab_size, 0), 1)), 6) AS tfidf_density
FROM n LEFT JOIN v USING (kind) LEFT JOIN z USING (kind)"""


def _norm_line(x: str) -> str:
    x = collapse(x)
    for pattern, name in ((P.SLASHED_DATE, "DATE"), (P.TIME, "TIME"), (P.YEAR, "YEAR")):
        x = sub(x, pattern, f"__{name}__", False)
    return x


def _boilerplate(items: str, name: str, least: int, top: int) -> str:
    return f"""WITH d AS (SELECT lang, {TOPIC} AS topic, coalesce(text, '') AS text, {tokens("coalesce(text, '')")} AS w FROM documents), i AS (SELECT lang, topic, unnest(list_distinct({items})) AS {name} FROM d WHERE topic <> -1),
c AS (SELECT lang, topic, {name}, count(*) AS n_in FROM i GROUP BY ALL), a AS (SELECT lang, {name}, sum(n_in)::BIGINT AS n_all FROM c GROUP BY ALL),
r AS (SELECT lang, topic, (n_in + 1) / (n_all - n_in + 1) AS ratio, n_in, n_all - n_in AS n_out, {name} FROM c JOIN a USING (lang, {name}) WHERE n_in >= {least}),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, topic ORDER BY ratio DESC, n_in DESC, n_out DESC, {name} DESC) AS place FROM r)
SELECT lang, topic, round(ratio, 6) AS ratio, n_in, n_out, {name} FROM k WHERE place <= {top}"""


_LINES = f"list_transform(list_filter({lines('text')}, lambda x: {strip('x')} <> ''), lambda x: {_norm_line('x')})"
_SHINGLES = "list_transform(range(1, len(w) - 6), lambda i: lower(array_to_string(w[i:i + 7], ' ')))"

_SHOWN = "substring(preview || chr(10) || clean, 1, 4000)"
FAMILY_REVIEW = f"""SELECT doc_id, CASE WHEN {found('t', P.ANY_HEADER)} THEN 'email_like'
WHEN {_left('t', r'[^\p{L}]')} / greatest(length(t), 1) < 0.55 AND {_left('t', r'[\x00-\x7f]')} / greatest(length(t), 1) > 0.08 THEN 'ocr_noise'
WHEN length(clean) - length(replace(clean, ' ', '')) > 120 AND NOT {found('t', P.UNDERSCORES, False)} THEN 'article_like' ELSE 'other' END AS family FROM (SELECT *, {_SHOWN} AS t FROM ({CLEAN}))"""

_GRAMS = CharGramConfig()
_EACH = ", ".join(f"list_transform(range(1, length(p) - {n - 2}), lambda i: substring(p, i, {n}))" for n in range(_GRAMS.ngram_min, _GRAMS.ngram_max + 1))
CHAR_GRAMS = f"""WITH d AS (SELECT doc_id, regexp_replace({PREVIEW}, {lit(P.BLANK + '{2,}')}, ' ', 'g') AS p FROM documents), g AS (SELECT doc_id, unnest(flatten([{_EACH}])) AS term FROM d),
c AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY ALL), f AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS total FROM c GROUP BY term HAVING count(*) >= {_GRAMS.min_df})
SELECT term, df, total FROM f ORDER BY total DESC, encode(term) LIMIT {_GRAMS.max_features}"""

ORACLES = {
    "text_stats": _text_stats("documents", "doc_id"),
    "text_stats_stream": _text_stats("documents", "doc_id"),
    "html_stats": _text_stats("pages", "page_id", "html"),
    "triage_flags": _flags(),
    "preview": f"SELECT doc_id, {PREVIEW} AS preview FROM documents",
    "preview_join": f"SELECT doc_id::VARCHAR AS doc_id, {PREVIEW} AS preview FROM documents",
    "family_classify": _family_classify(),
    "extraction_methods": EXTRACTION,
    "exact_dup_map": DUP_MAP,
    "exact_canonical": CANONICAL,
    "top_duplicated": f"SELECT sha256, dup_count, rel_path, doc_family, n_chars FROM ({CANONICAL}) ORDER BY dup_count DESC, sha256 LIMIT 15",
    "normalize_text": NORMALIZED,
    "simhash64": f"WITH {HASHED} SELECT doc_id, simhash64, bucket, norm_len FROM hashed",
    "neardup_pairs": f"WITH {HASHED}, {PAIRS} SELECT a, b, distance FROM pairs",
    "neardup_groups": f"{_NEAR} SELECT doc_id, human_doc_type, near_dup_group FROM groups",
    "neardup_group_stats": f"{_NEAR} SELECT near_dup_group, count(*) AS group_size, arg_min(human_doc_type, doc_id) AS doc_type FROM groups GROUP BY near_dup_group",
    "neardup_canonical": f"{_NEAR}, best AS (SELECT doc_id, near_dup_group, row_number() OVER (PARTITION BY near_dup_group ORDER BY norm_len DESC, doc_id) AS k FROM groups) SELECT doc_id, source, near_dup_group FROM best JOIN documents USING (doc_id) WHERE k = 1",
    "cluster_samples": f"WITH {SAMPLES} SELECT docform_cluster, place, doc_id, rel_path, preview_snip FROM s WHERE place <= 12",
    "label_sheet": f"WITH {SHEET} SELECT {_BLANK}, docform_cluster, count(*) AS n_docs, any_value(example_rel_paths) AS example_rel_paths, any_value(example_previews) AS example_previews FROM c JOIN e USING (docform_cluster) GROUP BY docform_cluster",
    "label_join": f"WITH {CLUSTERED}, k AS (SELECT doc_id, docform_cluster, CASE docform_cluster {_TYPES} ELSE '' END AS human_doc_type FROM c) SELECT doc_id, docform_cluster, human_doc_type, CASE WHEN human_doc_type = 'web_notes' THEN 'maybe' WHEN human_doc_type <> '' THEN 'yes' ELSE '' END AS keep_in_corpus, '' AS priority FROM k",
    "seeded_sample": f"SELECT topic, doc_id FROM (SELECT topic, doc_id, row_number() OVER (PARTITION BY topic ORDER BY md5('42:' || doc_id), doc_id) AS k FROM (SELECT doc_id, {TOPIC} AS topic FROM documents) WHERE topic <> -1) WHERE k <= 10",
    "docform_features": _features(),
    "docform_feature_means": f"SELECT lang, count(*) AS n_docs, {', '.join(f'round(avg({c}), 6) AS {c}' for c in M.COUNTS)} FROM ({stats('documents', 'doc_id', more=', lang')}) GROUP BY lang",
    "char_ngram_df": CHAR_GRAMS,
    "clean_text": f"SELECT doc_id, clean, len({tokens('clean')})::BIGINT AS clean_tok_len FROM ({CLEAN})",
    "tfidf_word": f"WITH {TFIDF} SELECT kind, doc_id, term, round(weight, 6) AS weight FROM vec",
    "topic_keywords": KEYWORDS,
    "type_stats": TYPE_STATS,
    "boilerplate_lines": _boilerplate(_LINES, "line", 3, 40),
    "boilerplate_shingles": _boilerplate(_SHINGLES, "shingle", 3, 30),
    "topic_sizes": f"SELECT lang, topic, count(*) AS n, round(avg(n_chars::DOUBLE), 6) AS avg_prob FROM (SELECT lang, {TOPIC} AS topic, n_chars FROM documents) WHERE topic <> -1 GROUP BY ALL ORDER BY n DESC, lang, topic LIMIT 30",
    "doc_family_review": FAMILY_REVIEW,
    "value_counts": "SELECT lang, source, count(*) AS n FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL GROUP BY ALL ORDER BY n DESC, lang, source LIMIT 25",
}
