"""The same results in DuckDB SQL."""

from __future__ import annotations

from checks.queries import (
    ARCHIVES,
    BATCH,
    CONTEXT,
    HASH_INDEX,
    NGRAMS,
    NUM_BANDS,
    NUM_HASHES,
    PARTS,
    RECORDS,
    SAMPLE,
    SEED,
    SHARD_FILES,
    SHARD_START,
    THRESHOLD,
)
from corpusmill.operators.language import MOST_GRAMS, UNIT
from corpusmill.operators.linear import MOST_TEXTS
from corpusmill.operators.minhash import PRIME, hash_family
from corpusmill.operators.tokens import VOCABULARY

SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
BREAK = r"\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}"
WORD = r"\p{L}\p{M}\p{N}_"
TOKEN = rf"[{WORD}]+(?:[.''’-][{WORD}]+)*|\.{{2,}}|[^{WORD}{SPACE}]"
# The patterns that are masked.
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
IP = r"\b(?:[0-9]{1,3}\.){3}[0-9]{1,3}\b"
PHONE = r"(^|[^0-9])(\+?[0-9]{1,3}[- ]?)?\(?[0-9]{3}\)?[- ]?[0-9]{3}[- ]?[0-9]{4}($|[^0-9])"


def all_of(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, '{pattern}')"


def count_of(text: str, pattern: str) -> str:
    return f"len({all_of(text, pattern)})::bigint"


def sub(text: str, pattern: str, by: str = "''") -> str:
    return f"regexp_replace({text}, '{pattern}', {by}, 'g')"


def masked(text: str, kind: str) -> str:
    # The marks that take the place of what is masked.
    return {
        "email": sub(text, EMAIL, "'|||EMAIL_ADDRESS|||'"),
        "ip": sub(text, IP, "'|||IP_ADDRESS|||'"),
        "phone": sub(text, PHONE, r"'\1|||PHONE_NUMBER|||\3'"),
    }[kind]


LONG_LINES = (
    "coalesce(array_to_string([x for x in string_split(text, chr(10)) if length(x) > 50], chr(10)), '')"
)


def mask_chain(source: str) -> str:
    """``source`` is a table with ``doc_id, text``."""
    return f"""
    m1 AS (SELECT doc_id, {masked("text", "email")} AS t, {count_of("text", EMAIL)} AS n1 FROM {source}),
    m2 AS (SELECT doc_id, {masked("t", "ip")} AS t, n1, {count_of("t", IP)} AS n2 FROM m1),
    pii AS (SELECT doc_id, {masked("t", "phone")} AS text, n1 + n2 + {count_of("t", PHONE)} AS n_pii FROM m2)
    """


GOPHER = f"""
    counted AS (
      SELECT *, {all_of("text", TOKEN)} AS tok,
             [x for x in string_split_regex(text, '\\r\\n|[{BREAK}]') if regexp_matches(x, '[^{SPACE}]')] AS lin
      FROM documents),
    stats AS (
      SELECT * EXCLUDE (tok, lin), len(tok)::bigint AS n_tokens,
             CASE WHEN len(tok) = 0 THEN 0 ELSE length(array_to_string(tok, '')) / len(tok) END::double AS mean_token_chars,
             CASE WHEN len(lin) = 0 THEN 1 ELSE len([x for x in lin if ends_with(x, '...')]) / len(lin) END::double
               AS ellipsis_share,
             CASE WHEN len(tok) = 0 THEN 0 ELSE len([x for x in tok if regexp_matches(x, '\\p{{L}}')]) / len(tok)
               END::double AS alphabetic_share
      FROM counted),
    judged AS (
      SELECT *, (n_tokens BETWEEN 50 AND 100000 AND mean_token_chars BETWEEN 3 AND 10
                 AND ellipsis_share < 0.3 AND alphabetic_share > 0.8) AS ok
      FROM stats)
"""

VERDICTS = """
    verdicts AS (
      SELECT doc_id, CASE WHEN quality = 1 THEN 'wiki' ELSE 'cc' END AS quality,
             CASE WHEN toxic = 1 THEN 'toxic' ELSE 'non-toxic' END AS toxicity
      FROM labels)
"""

LINES = """
    pieces AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents),
    cut AS (SELECT doc_id, unnest(range(len(p))) AS pos, p FROM pieces),
    lines AS (
      SELECT doc_id, pos, p[pos + 1] || CASE WHEN pos + 1 < len(p) THEN chr(10) ELSE '' END AS line
      FROM cut WHERE pos + 1 < len(p) OR p[pos + 1] <> '')
"""

NORMAL = sub(sub("strip_accents(lower(text))", rf"[^\p{{L}}\p{{N}}_{SPACE}]"), f"[{SPACE}]+", "' '")

GRAMS = f"""
    words AS (SELECT doc_id, string_split(trim({NORMAL}), ' ') AS w FROM documents),
    grams AS (
      SELECT doc_id, [array_to_string(w[i : i + {NGRAMS - 1}], ' ') for i in range(1, len(w) - {NGRAMS - 2})] AS g
      FROM words)
"""

FAMILY = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(hash_family(NUM_HASHES)))
BASE_HASH = f"(('0x' || substr(md5(gram), 1, 8))::bigint % {PRIME})"
WIDTH = NUM_HASHES // NUM_BANDS

SIGNATURES = f"""
    {GRAMS},
    hashed AS (SELECT doc_id, {BASE_HASH} AS h FROM (SELECT doc_id, unnest(g) AS gram FROM grams)),
    family(i, a, b) AS (VALUES {FAMILY}),
    minima AS (
      SELECT doc_id, i, min((a::bigint * h + b::bigint) % {PRIME}) AS v FROM hashed CROSS JOIN family GROUP BY ALL),
    sigs AS (SELECT doc_id, list(v ORDER BY i) AS sig FROM minima GROUP BY doc_id)
"""


def buckets(source: str, name: str) -> str:
    rendered = f"array_to_string(sig[band * {WIDTH} + 1 : (band + 1) * {WIDTH}], ',')"
    return f"""
    {name} AS (
      SELECT doc_id, band, ('0x' || substr(md5(band || ',' || {rendered}), 1, 15))::bigint AS key
      FROM {source}, (SELECT unnest(range({NUM_BANDS})) AS band))
    """


def estimate(pairs: str, name: str) -> str:
    return f"""
    {name} AS (
      SELECT src, dst,
             round(len([i for i in range(1, {NUM_HASHES + 1}) if a.sig[i] = b.sig[i]]) / {NUM_HASHES}, 6)::double AS jaccard
      FROM {pairs} JOIN sigs a ON a.doc_id = src JOIN sigs b ON b.doc_id = dst)
    """


REPS = f"""
    {SIGNATURES},
    reps AS (SELECT min(doc_id) AS doc_id, sig FROM sigs GROUP BY sig),
    {buckets("reps", "buckets")}
"""

FIRSTS = f"""
    {REPS},
    least AS (SELECT band, key, min(doc_id) AS src FROM buckets GROUP BY ALL),
    firsts AS (SELECT DISTINCT src, doc_id AS dst FROM buckets JOIN least USING (band, key) WHERE src <> doc_id)
"""

PAIRS = f"""
    {REPS},
    candidates AS (
      SELECT DISTINCT l.doc_id AS src, r.doc_id AS dst
      FROM buckets l JOIN buckets r ON l.band = r.band AND l.key = r.key AND l.doc_id < r.doc_id),
    {estimate("candidates", "rated")},
    links AS (
      SELECT src, dst FROM rated WHERE jaccard > {THRESHOLD}
      UNION ALL
      SELECT r.doc_id, s.doc_id FROM sigs s JOIN reps r ON r.sig = s.sig AND r.doc_id < s.doc_id)
"""

CLUSTERS = f"""
    {PAIRS},
    arcs AS (SELECT src AS a, dst AS c FROM links UNION SELECT dst, src FROM links),
    reach(n, m) AS (SELECT a, a FROM arcs UNION SELECT arcs.c, reach.m FROM reach JOIN arcs ON arcs.a = reach.n),
    clusters AS (SELECT n AS doc_id, min(m) AS component FROM reach GROUP BY n)
"""


def shuffled(key: str) -> str:
    return f"md5('{SEED}:' || {key})"


def part(key: str) -> str:
    return f"CASE WHEN ('0x' || substr({shuffled(key)}, 1, 8))::bigint % 4 < 3 THEN 'train' ELSE 'valid' END"


#: Naive Bayes over runs of three characters, in sums of whole numbers.
LANGUAGE = f"""
    numbered AS (SELECT doc_id, lang, translate(text, chr(10), ' ') AS flat, count(*) OVER (PARTITION BY lang) AS n FROM documents),
    runs AS (SELECT doc_id, unnest([flat[i : i + 2] for i in range(1, length(flat) - 1)]) AS gram FROM numbered),
    found AS (SELECT doc_id, gram, count(*) AS n FROM runs GROUP BY ALL),
    drawn AS (
      SELECT doc_id, lang FROM numbered
      WHERE lang IS NOT NULL AND (n <= {MOST_TEXTS} OR ('0x' || substr(md5('0:' || doc_id), 1, 8))::bigint / 4294967296 < {MOST_TEXTS} / n)),
    counts AS (SELECT lang, gram, sum(n) AS n FROM found JOIN drawn USING (doc_id) GROUP BY ALL),
    kept AS (SELECT gram FROM counts GROUP BY gram ORDER BY sum(n) DESC, gram LIMIT {MOST_GRAMS}),
    totals AS (SELECT lang, sum(n) AS total FROM counts JOIN kept USING (gram) GROUP BY lang),
    weights AS (
      SELECT gram, lang, round(ln((coalesce(n, 0) + 1) / (total + (SELECT count(*) FROM kept))) * {UNIT})::bigint AS w
      FROM kept CROSS JOIN totals LEFT JOIN counts USING (gram, lang)),
    sums AS (
      SELECT d.doc_id, t.lang, coalesce(s.total, 0) AS s
      FROM documents d CROSS JOIN totals t
      LEFT JOIN (SELECT doc_id, lang, sum(n * w) AS total FROM found JOIN weights USING (gram) GROUP BY ALL) s
        ON d.doc_id = s.doc_id AND t.lang = s.lang),
    best AS (SELECT *, max(s) OVER (PARTITION BY doc_id) AS top FROM sums),
    languages AS (
      SELECT doc_id, min(lang) FILTER (s = top) AS language, round(1 / sum(exp((s - top) / {UNIT})), 6) AS confidence
      FROM best GROUP BY doc_id)
"""


def floors(label: str) -> str:
    return f"""
      WITH {VERDICTS}, known AS (
        SELECT doc_id, {label} AS label FROM documents LEFT JOIN verdicts USING (doc_id))
      SELECT label, count(*) FILTER (label IS NOT NULL AND {part("doc_id")} = 'valid') AS n_held_out, count(*) AS n_sound,
        CASE WHEN label IS NOT NULL THEN true END AS floor_reached
      FROM known GROUP BY label"""


def training(tail: str) -> str:
    flat = "translate(text, chr(10) || chr(13), ' ')"
    return f"""
    WITH {GOPHER}, {VERDICTS},
    pool AS (SELECT doc_id, text, quality FROM judged JOIN verdicts USING (doc_id) WHERE ok AND lang = 'en'),
    good AS (SELECT * FROM pool WHERE quality = 'wiki'),
    bad AS (
      SELECT doc_id, text FROM pool WHERE quality = 'cc'
      QUALIFY row_number() OVER (ORDER BY {shuffled("doc_id")}) <= (SELECT count(*) FROM good)),
    examples AS (
      SELECT doc_id, '__label__wiki' AS label, {flat} AS text FROM good
      UNION ALL SELECT doc_id, '__label__cc', {flat} FROM bad)
    {tail}
    """


VOCAB = f"""
    toks AS (SELECT doc_id, {all_of("text", TOKEN)} AS t FROM documents),
    flat AS (SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS i FROM toks),
    counts AS (SELECT token, count(*) AS n FROM flat GROUP BY token),
    vocab AS (
      SELECT token, n, row_number() OVER (ORDER BY n DESC, token) + 1 AS id FROM counts
      QUALIFY id < {VOCABULARY}),
    ids AS (
      SELECT doc_id, i, coalesce(id, 0) AS id FROM flat LEFT JOIN vocab USING (token)
      UNION ALL SELECT doc_id, len(t), 1 FROM toks)
"""

HTML_STRIP = "html"
HTML_STRIP = sub(HTML_STRIP, "(?s)<!--.*?-->")
for _name in ("script", "style", "head", "title"):
    HTML_STRIP = sub(HTML_STRIP, rf"(?is)<{_name}\b[^>]*>.*?</{_name}>")
HTML_STRIP = sub(HTML_STRIP, r"(?i)</?(p|div|h[1-6]|ul|ol|li|br|tr|article|nav|footer)\b[^>]*>", "chr(10)")
HTML_STRIP = sub(HTML_STRIP, "<[^>]+>")
for _entity, _char in (
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
    ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"),
):
    HTML_STRIP = f"replace({HTML_STRIP}, '{_entity}', '{_char}')"
HTML_STRIP = f"trim({sub(sub(HTML_STRIP, '[ \\t]+', chr(39) + ' ' + chr(39)), ' ?\\n[ \\n]*', 'chr(10)')})"


def html_text() -> str:
    """Enough for well-formed tags without ``>`` in attributes, as the pages have."""
    item, line, paragraph = r"\x02", r"\x03", r"\x04"
    tags = (
        ("p|h[1-6]|ul|ol|dl|blockquote|pre|table|figure|hr|article|section|form|fieldset", "chr(4)"),
        (
            "div|header|footer|nav|aside|main|address|li|dt|dd|tr|caption|thead|tbody|tfoot|"
            "figcaption|details|summary|center|body|html|head",
            "chr(3)",
        ),
        ("td|th", "' '"),
    )
    out = sub("html", "(?s)<!--.*?-->")
    for name in ("script", "style", "title"):
        out = sub(out, rf"(?is)<{name}(?:[\s/][^>]*)?>.*?</{name}>", "' '")
    out = sub(out, r"[ \t\n\f\r]+", "' '")
    out = sub(out, r"(?i)</?br(?:[\s/][^>]*)?>", "chr(10)")
    out = sub(out, r"(?i)<li(?:[\s/][^>]*)?>", "chr(3) || chr(2)")
    for names, by in tags:
        out = sub(out, rf"(?i)</?(?:{names})(?:[\s/][^>]*)?>", by)
    out = sub(out, "<[/!?a-zA-Z][^<>]*>")
    out = sub(out, " {2,}", "' '")
    out = sub(out, rf" ?([\n{item}{line}{paragraph}]) ?", r"'\1'")
    out = sub(out, rf"{item}[{line}{paragraph}{item}\n]*", "chr(2)")
    out = sub(out, rf"[{line}]*{paragraph}[{line}{paragraph}]*", "chr(10) || chr(10)")
    out = sub(sub(out, f"{line}+", "chr(10)"), r"\n{3,}", "chr(10) || chr(10)")
    out = sub(out, r"\A[\n ]+|[\n ]+\z")
    out = f"replace({out}, chr(2), '  • ')"
    for entity, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{char}')"
    return out


DEDUP_LINES = f"""
    WITH {LINES},
    once AS (SELECT md5(line) AS h FROM lines GROUP BY 1 HAVING count(*) = 1),
    kept AS (SELECT doc_id, string_agg(line, '' ORDER BY pos) AS text FROM lines JOIN once ON h = md5(line) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(kept.text, '') AS text FROM documents d LEFT JOIN kept USING (doc_id)
"""

def warc_bytes(kind: str, length: str) -> str:
    """The bytes of a record and the blank line after it."""
    head = f"WARC/1.0..WARC-Type: {kind}..WARC-Record-ID: <urn:page:>..WARC-Target-URI: ..Content-Type: application/http; msgtype={kind}..Content-Length: ...."
    return f"{len(head) + 4} + length(page_id::varchar) + octet_length(encode(url)) + length(({length})::varchar) + {length}"


#: Bytes of the status line and headers of a page in an archive, and of a request for one.
RESPONSE_HEAD = len("HTTP/1.1 200 OK..Content-Type: text/html; charset=utf-8....")
REQUEST = len("GET / HTTP/1.1....")

ORACLES = {
    "scan_archives": f"""
      SELECT page_id % {ARCHIVES} AS part,
        sum({warc_bytes("request", str(REQUEST))} + {warc_bytes("response", f"({RESPONSE_HEAD} + octet_length(encode(html)))")})::bigint AS n_bytes
      FROM pages GROUP BY page_id % {ARCHIVES}""",
    "index_records": f"""
      SELECT url, 'request' AS warc_type, {REQUEST} AS length, 0 AS missing FROM pages
      UNION ALL SELECT url, 'response', {RESPONSE_HEAD} + octet_length(encode(html)), 0 FROM pages""",
    "scan_records": "SELECT page_id, url, html FROM pages",
    "shard_files": f"""
      SELECT source, position FROM (
        SELECT source, row_number() OVER (ORDER BY source) - 1 AS position FROM (SELECT DISTINCT source FROM documents))
      WHERE position BETWEEN {SHARD_START} AND {SHARD_START + SHARD_FILES - 1}""",
    "scan_documents": "SELECT doc_id, text FROM documents",
    "scan_url_lines": "SELECT url FROM pages",
    "sink_corpus": "SELECT text || chr(10) || '<|endoftext|>' AS record FROM documents",
    "sink_documents": DEDUP_LINES,
    "sink_named_documents": "SELECT doc_id, regexp_replace(text, chr(13) || chr(10) || '?', chr(10), 'g') AS text FROM documents",
    "sink_labelled_lines": training("SELECT label, text FROM examples"),
    "sink_tokens": f"SELECT sum({count_of('text', TOKEN)} + 1)::bigint AS total_tokens FROM documents",
    "html_to_text": f"SELECT page_id, {html_text()} AS text FROM pages",
    "html_strip": f"SELECT page_id, {HTML_STRIP} AS text FROM pages",
    "mask_emails": f"SELECT doc_id, {masked('text', 'email')} AS text, {count_of('text', EMAIL)} AS n FROM documents",
    "mask_phones": f"SELECT doc_id, {masked('text', 'phone')} AS text, {count_of('text', PHONE)} AS n FROM documents",
    "mask_ips": f"SELECT doc_id, {masked('text', 'ip')} AS text, {count_of('text', IP)} AS n FROM documents",
    "mask_pii": f"WITH {mask_chain('documents')} SELECT doc_id, text, n_pii FROM pii",
    "drop_short_lines": f"SELECT doc_id, {LONG_LINES} AS text FROM documents",
    "flatten_text": "SELECT doc_id, translate(text, chr(10) || chr(13), ' ') AS text FROM documents",
    "normalize_text": f"SELECT doc_id, trim({NORMAL}) AS text FROM documents",
    "word_tokens": f"""
      SELECT doc_id, len(t)::bigint AS n, array_to_string(t, ' ') AS tokens
      FROM (SELECT doc_id, {all_of("text", TOKEN)} AS t FROM documents)""",
    "nonblank_lines": f"""
      SELECT doc_id, len(lin)::bigint AS n, array_to_string(lin, chr(10)) AS lines FROM (
        SELECT doc_id, [x for x in string_split_regex(text, '\\r\\n|[{BREAK}]') if regexp_matches(x, '[^{SPACE}]')] AS lin
        FROM documents)""",
    "line_hash": f"WITH {LINES} SELECT doc_id, pos, md5(line) AS line_hash FROM lines",
    "word_ngrams": f"""
      WITH {GRAMS} SELECT doc_id, len(g)::bigint AS n, md5(coalesce(array_to_string(g, '|'), '')) AS grams_md5 FROM grams""",
    "ngram_hash": f"""
      WITH {GRAMS}, hashed AS (
        SELECT doc_id, ({BASE_HASH} * {hash_family(NUM_HASHES)[HASH_INDEX][0]}::bigint
                        + {hash_family(NUM_HASHES)[HASH_INDEX][1]}::bigint) % {PRIME} AS h
        FROM (SELECT doc_id, unnest(g) AS gram FROM grams))
      SELECT doc_id, count(*) AS n, sum(h)::bigint AS total, min(h) AS least, max(h) AS most FROM hashed GROUP BY doc_id""",
    "gopher_stats": f"""
      WITH {GOPHER} SELECT doc_id, n_tokens, round(mean_token_chars, 6) AS mean_token_chars,
        round(ellipsis_share, 6) AS ellipsis_share, round(alphabetic_share, 6) AS alphabetic_share FROM stats""",
    "gopher_filter": f"WITH {GOPHER} SELECT doc_id, text FROM judged WHERE ok",
    "classify_language": f"WITH {LANGUAGE} SELECT * FROM languages",
    "model_io": f"WITH {LANGUAGE} SELECT doc_id, language FROM languages",
    "classify_quality": floors("quality"),
    "classify_toxic": floors("toxicity"),
    "classify_nsfw": floors("CASE toxicity WHEN 'toxic' THEN 'nsfw' WHEN 'non-toxic' THEN 'non-nsfw' END"),
    "train_classifier": f"""
      WITH {VERDICTS} SELECT quality AS label, count(*) FILTER ({part("doc_id")} = 'train') AS n_train,
        count(*) FILTER ({part("doc_id")} = 'valid') AS n_held_out, true AS beats_guess
      FROM documents JOIN verdicts USING (doc_id) WHERE quality IS NOT NULL GROUP BY quality""",
    "pii_limit": f"WITH {mask_chain('documents')} SELECT doc_id, text, n_pii FROM pii WHERE n_pii <= 50",
    "curate": f"""
      WITH {GOPHER}, {VERDICTS},
      passed AS (
        SELECT doc_id, {LONG_LINES} AS text FROM judged LEFT JOIN verdicts USING (doc_id)
        WHERE ok AND lang = 'en' AND coalesce(quality, 'wiki') = 'wiki' AND coalesce(toxicity, 'non-toxic') = 'non-toxic'),
      {mask_chain('passed')}
      SELECT doc_id, text, text || chr(10) || '<|endoftext|>' AS record FROM pii WHERE n_pii <= 50""",
    "curation_funnel": f"""
      WITH {GOPHER}, {VERDICTS},
      short AS (SELECT doc_id, {LONG_LINES} AS text FROM documents),
      {mask_chain('short')},
      reasons AS (
        SELECT source, CASE WHEN quality <> 'wiki' THEN 'quality' WHEN lang <> 'en' THEN 'language'
          WHEN toxicity <> 'non-toxic' THEN 'toxic' WHEN NOT ok THEN 'gopher' WHEN n_pii > 50 THEN 'pii' END AS reason
        FROM judged JOIN pii USING (doc_id) LEFT JOIN verdicts USING (doc_id))
      SELECT source, count(*) AS total, count(*) FILTER (reason = 'quality') AS quality,
        count(*) FILTER (reason = 'language') AS language, count(*) FILTER (reason = 'toxic') AS toxic,
        count(*) FILTER (reason = 'gopher') AS gopher, count(*) FILTER (reason = 'pii') AS pii,
        count(*) FILTER (reason IS NULL) AS passed
      FROM reasons GROUP BY source""",
    "english_gopher_docs": f"WITH {GOPHER} SELECT doc_id, text FROM judged WHERE ok AND lang = 'en'",
    "english_gopher_rejects": f"""
      WITH {GOPHER} SELECT count(*) FILTER (ok AND lang = 'en') AS accepted,
        count(*) FILTER (NOT (ok AND lang = 'en')) AS rejected FROM judged""",
    "line_counts": f"WITH {LINES} SELECT md5(line) AS line_hash, count(*) AS n FROM lines GROUP BY 1",
    "exact_line_dedup": DEDUP_LINES,
    "minhash_signature": f"WITH {SIGNATURES} SELECT doc_id, array_to_string(sig, ',') AS sig FROM sigs",
    "lsh_buckets": f"WITH {SIGNATURES}, {buckets('sigs', 'found')} SELECT doc_id, band, key FROM found",
    "candidate_pairs": f"WITH {FIRSTS} SELECT src, dst FROM firsts",
    "signature_jaccard": f"WITH {FIRSTS}, {estimate('firsts', 'rated')} SELECT src, dst, jaccard FROM rated",
    "duplicate_pairs": f"""
      WITH RECURSIVE {PAIRS},
      edges AS (
        SELECT src, dst, jaccard, row_number() OVER (ORDER BY jaccard DESC, src, dst) AS r FROM rated WHERE jaccard > {THRESHOLD}),
      arcs AS (SELECT src AS a, dst AS c, r FROM edges UNION ALL SELECT dst, src, r FROM edges),
      -- What better links than an edge connect its first end with.
      better(e, n) AS (SELECT r, src FROM edges UNION SELECT e, c FROM better JOIN arcs ON a = n AND r < e)
      SELECT src, dst, jaccard FROM edges WHERE NOT EXISTS (SELECT 1 FROM better WHERE e = edges.r AND n = edges.dst)
      UNION ALL
      SELECT r.doc_id, s.doc_id, 1.0 FROM sigs s JOIN reps r ON r.sig = s.sig AND r.doc_id < s.doc_id""",
    "duplicate_clusters": f"WITH RECURSIVE {CLUSTERS} SELECT doc_id, component FROM clusters",
    "fuzzy_dedup": f"""
      WITH RECURSIVE {CLUSTERS} SELECT d.doc_id, d.text FROM documents d LEFT JOIN clusters c USING (doc_id)
      WHERE c.component IS NULL OR c.component = d.doc_id""",
    "sample_k": f"""
      SELECT page_id, url, row_number() OVER (ORDER BY {shuffled("page_id")}) AS rank FROM pages QUALIFY rank <= {SAMPLE}""",
    "split_even": f"""
      WITH s AS (
        SELECT page_id, url, row_number() OVER (ORDER BY {shuffled("page_id")}) AS rank FROM pages QUALIFY rank <= {SAMPLE}),
      p AS (SELECT count(*) // {PARTS} AS size FROM s)
      SELECT page_id, url, (rank - 1) // size AS part FROM s, p WHERE (rank - 1) // size < {PARTS}""",
    "sample_records": f"""
      SELECT page_id, html FROM (
        SELECT page_id, html, row_number() OVER (ORDER BY {shuffled("page_id")}) AS rank FROM pages)
      WHERE rank <= {RECORDS} AND length(html) > 0""",
    "balanced_training_set": training(f"""
      SELECT doc_id, label, text,
        {part("doc_id")} AS part
      FROM examples"""),
    "interleave_classes": training(f"""
      , rendered AS (SELECT doc_id, label || ' ' || text AS line FROM examples),
      one AS (SELECT line, row_number() OVER (ORDER BY {shuffled("doc_id")}) AS r FROM rendered WHERE contains(line, '__label__cc')),
      two AS (SELECT line, row_number() OVER (ORDER BY {shuffled("doc_id")}) AS r FROM rendered WHERE contains(line, '__label__wiki'))
      SELECT 2 * (one.r - 1) AS position, one.line FROM one JOIN two USING (r)
      UNION ALL SELECT 2 * (two.r - 1) + 1, two.line FROM one JOIN two USING (r)"""),
    "random_file_order": f"""
      SELECT source, row_number() OVER (ORDER BY {shuffled("source")}) AS position
      FROM (SELECT DISTINCT source FROM documents)""",
    "evaluate_classifier": f"""
      WITH {GOPHER}, {VERDICTS}, r AS (
        SELECT count(*) AS n, round(count(*) FILTER (ok = (quality = 'wiki')) / count(*), 6) AS hit
        FROM judged JOIN verdicts USING (doc_id))
      SELECT n, hit AS precision_at_1, hit AS recall_at_1 FROM r""",
    "build_vocab": f"WITH {VOCAB} SELECT token, n, id FROM vocab",
    "encode_tokens": f"WITH {VOCAB} SELECT doc_id, string_agg(id::varchar, ' ' ORDER BY i) AS tokens FROM ids GROUP BY doc_id",
    "token_totals": f"SELECT sum({count_of('text', TOKEN)} + 1)::bigint AS total_tokens FROM documents",
    "token_windows": f"""
      WITH {VOCAB},
      placed AS (
        SELECT id, row_number() OVER (ORDER BY doc_id, i) - 1 AS pos, lead(id) OVER (ORDER BY doc_id, i) AS next FROM ids)
      SELECT pos // {CONTEXT} AS window_id, string_agg(id::varchar, ' ' ORDER BY pos) AS x,
             string_agg(next::varchar, ' ' ORDER BY pos) AS y
      FROM placed WHERE next IS NOT NULL GROUP BY 1 HAVING count(*) = {CONTEXT}""",
    "random_windows": f"""
      WITH {VOCAB},
      placed AS (
        SELECT id, row_number() OVER (ORDER BY doc_id, i) - 1 AS pos, lead(id) OVER (ORDER BY doc_id, i) AS next FROM ids),
      starts AS (
        SELECT w AS window_id, ('0x' || substr(md5('{SEED}:' || w), 1, 15))::bigint % ((SELECT count(*) FROM ids) - {CONTEXT}) AS start
        FROM range({BATCH}) t(w))
      SELECT window_id, start, string_agg(id::varchar, ' ' ORDER BY pos) AS x, string_agg(next::varchar, ' ' ORDER BY pos) AS y
      FROM starts JOIN placed ON pos >= start AND pos < start + {CONTEXT} GROUP BY ALL""",
}
