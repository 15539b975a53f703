"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

import math

from ..config import (
    ALPHA,
    BOOTSTRAP_FRACTION,
    BOOTSTRAP_REPLICATES,
    BOOTSTRAP_SEED,
    N_TOPICS,
    SPLIT_SEED,
    TOPICS,
)
from ..operators.features import ENGLISH_STOP_WORDS
from ..operators.quality import ISO_TIMESTAMP, WITHOUT_SECONDS
from ..schema import DATE_FIELDS, REQUIRED_FIELDS, SOURCE_FIELDS
from .queries import ALERT_RATE, CHANGE_QUIET, CHANGE_RATE, METRICS, TOP_TERMS
from .standins import BROKEN_EVERY, COPY_ID, EVENT_TYPES, EXPORT_NAME, FAULTY_DATES, FUNCTION_WORDS, LANGS

ORACLE: dict[str, str] = {}

PUNCT = r"[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x{85}\p{Z}]"
NUMERIC = r"[\p{L}\p{N}_]*\p{Nd}[\p{L}\p{N}_]*"
SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
TEXT = "complaint_what_happened"


def literals(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def strip_punct(c: str) -> str:
    return f"regexp_replace({c}, '{PUNCT}', '', 'g')"


def strip_numeric(c: str) -> str:
    return f"regexp_replace({c}, '{NUMERIC}', '', 'g')"


def clean(c: str) -> str:
    return strip_numeric(strip_punct(f"lower({c})"))


def case_index(c: str, labels) -> str:
    whens = " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(labels))
    return f"CASE {c} {whens} END"


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


DOCS = "docs AS (SELECT doc_id AS id, text, lang, source FROM documents)"
CLEANED = f"cleaned AS (SELECT doc_id AS id, lang, {clean('text')} AS complaint_final FROM documents)"
N_DOCS = "(SELECT count(*) FROM documents)"
STOPS = literals(ENGLISH_STOP_WORDS)


def ws_tokens(c: str) -> str:
    body = f"rtrim(lower({c}), E' \\t\\n\\x0b\\f\\r')"
    return (
        f"CASE WHEN {c} = '' THEN [''] WHEN {body} = '' THEN [] "
        f"ELSE regexp_split_to_array({body}, '[\\s\\x0b]') END"
    )


def ticket_tokens(c: str) -> str:
    return f"list_filter({ws_tokens(c)}, lambda w: w NOT IN ({STOPS}))"


def words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{SPACES}'), lambda w: w <> '')"


def pairs_words(c: str) -> str:
    return f"regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"


# --- raw complaints ----------------------------------------------------------

_DAY = "lpad(CAST(d.n_chars % 28 + 1 AS VARCHAR), 2, '0')"
_FORMS = "[" + literals(FAULTY_DATES) + "]"
_DATE = f"CASE WHEN d.copy = 1 THEN {_FORMS}[d.doc_id % {len(FAULTY_DATES)} + 1] WHEN d.lang = 'es' THEN {_DAY} || '/02/2024' ELSE '2024-02-' || {_DAY} || 'T12:00:00-05:00' END"
_NUMBER = f"(d.doc_id + d.copy * {COPY_ID})"
_ID = f"CASE WHEN d.lang = 'de' AND d.quality IS NULL THEN 'doc-' || {_NUMBER} ELSE CAST({_NUMBER} AS VARCHAR) END"
_VALUES = {
    "tags": "CASE WHEN d.lang = 'fr' THEN 'Older American' END",
    "zip_code": "CASE WHEN d.quality IS NOT NULL THEN CASE WHEN length(CAST(d.doc_id AS VARCHAR)) > 5 THEN left(CAST(d.doc_id AS VARCHAR), 5) ELSE lpad(CAST(d.doc_id AS VARCHAR), 5, '0') END END",
    "complaint_id": _ID,
    "issue": "d.lang || ' / ' || d.source",
    "date_received": _DATE,
    "state": "CASE WHEN d.toxic = 1 THEN upper(d.source) ELSE upper(d.lang) END",
    "consumer_disputed": "'N/A'",
    "product": "d.source",
    "company_response": "CASE WHEN d.quality IS NULL OR NOT (d.quality = 0 AND d.toxic = 1) THEN 'Closed with explanation' END",
    "company": "'Bank ' || d.source",
    "submitted_via": "'Web'",
    "date_sent_to_company": _DATE,
    "sub_product": "d.lang",
    "timely": "CASE WHEN d.quality = 0 THEN 'No' WHEN d.quality IS NULL AND d.source = 'src7' THEN 'Maybe' ELSE 'Yes' END",
    TEXT: "CASE WHEN d.copy = 0 THEN d.text WHEN d.toxic = 1 THEN '' END",
    "consumer_consent_provided": "CASE WHEN d.toxic = 1 THEN 'Consent not provided' ELSE 'Consent provided' END",
}
_FIELDS = ", ".join(
    f"{_VALUES.get(f, 'CAST(NULL AS VARCHAR)')} AS {f}" for f in SOURCE_FIELDS
)
FLAT = (
    "labelled AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id), "
    "copies AS (SELECT *, 0 AS copy FROM labelled UNION ALL "
    "SELECT *, 1 AS copy FROM labelled WHERE toxic = 1 OR quality = 0), "
    f"flat AS (SELECT {_ID} AS id, '{EXPORT_NAME}' AS index, "
    "CAST(coalesce(d.quality, 0) AS DOUBLE) AS score, 'complaint' AS type, "
    f"{_FIELDS} FROM copies d)"
)
PRESENT = f"present AS (SELECT * FROM flat WHERE {TEXT} IS NOT NULL AND {TEXT} <> '')"
FLAT_COLUMNS = ", ".join(("id", "index", "score", "type", *SOURCE_FIELDS))

for key in ("read_nested_json", "read_json_array", "flatten_complaints", "parquet_roundtrip"):
    ORACLE[key] = with_([FLAT], f"SELECT {FLAT_COLUMNS} FROM flat")

ORACLE["csv_roundtrip"] = with_(
    [FLAT], f"SELECT * REPLACE (coalesce({TEXT}, '') AS {TEXT}) FROM flat"
)
ORACLE["scan_parquet"] = "SELECT doc_id, lang, source, n_chars FROM documents"
ORACLE["stage_lineage"] = "SELECT 'documents' AS stage_stem, count(*) AS n_rows FROM documents"
ORACLE["blank_to_null"] = with_([FLAT], f"SELECT id, nullif({TEXT}, '') AS {TEXT} FROM flat")
ORACLE["drop_null_text"] = with_([FLAT, PRESENT], f"SELECT id, {TEXT} FROM present")
ORACLE["fill_null_text"] = with_([FLAT], f"SELECT id, coalesce({TEXT}, '') AS {TEXT} FROM flat")
ORACLE["request_texts"] = with_([FLAT], f"SELECT id, {TEXT} FROM flat")
ORACLE["project_columns"] = (
    f"SELECT doc_id AS id, text AS {TEXT}, {case_index('lang', LANGS)} AS topic FROM documents"
)
ORACLE["profile_counts"] = with_(
    [FLAT],
    f"SELECT count(*) AS n_rows, count(*) FILTER ({TEXT} IS NULL) AS n_null, "
    f"count(*) FILTER ({TEXT} = '') AS n_blank, "
    f"CAST(sum(length({TEXT})) AS BIGINT) AS n_chars FROM flat",
)
ORACLE["head_rows"] = "SELECT doc_id AS id, text FROM documents ORDER BY doc_id LIMIT 5"
ORACLE["renumber_rows"] = with_(
    [FLAT, PRESENT], "SELECT row_number() OVER (ORDER BY id) - 1 AS row_id, id FROM present"
)

# --- text --------------------------------------------------------------------

ORACLE["text_lower"] = "SELECT doc_id AS id, lower(text) AS lowered FROM documents"
ORACLE["strip_punct"] = f"SELECT doc_id AS id, {strip_punct('text')} AS stripped FROM documents"
ORACLE["strip_numeric_words"] = (
    f"SELECT doc_id AS id, {strip_numeric('text')} AS stripped FROM documents"
)
for key in ("clean_text", "incremental_ingest"):
    ORACLE[key] = f"SELECT doc_id AS id, {clean('text')} AS complaint_cleaned FROM documents"
ORACLE["mask_cleanup"] = (
    "SELECT doc_id AS id, replace(replace(translate(text, '0123456789', 'xxxxxxxxxx'), "
    "'-PRON-', ''), 'xxxx', '') AS unmasked FROM documents"
)
ORACLE["snake_case"] = (
    r"SELECT page_id, trim(regexp_replace(lower(url), '[^\p{L}\p{N}]+', '_', 'g'), '_') "
    "AS label FROM pages"
)
ORACLE["word_tokens"] = (
    f"SELECT id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens "
    f"FROM (SELECT doc_id AS id, {pairs_words('text')} AS t FROM documents)"
)

LEXICON = [
    f"tokens AS (SELECT lang, unnest({words(clean('text'))}) AS form FROM documents)",
    "counted AS (SELECT form, lang, count(*) AS n FROM tokens GROUP BY ALL)",
    "tagged AS (SELECT form, CASE WHEN ('0x' || substr(md5('tag:' || form || ':' || lang), 1, 8))::BIGINT % 100 < 40 "
    "THEN 'NN' ELSE 'XX' END AS tag, regexp_replace(form, 's$', '') AS lemma, n FROM counted)",
    "tag_counts AS (SELECT form, tag, lemma, sum(n) AS n FROM tagged GROUP BY ALL)",
    "lexicon AS (SELECT form, tag, lemma FROM tag_counts "
    "QUALIFY row_number() OVER (PARTITION BY form ORDER BY n DESC, tag, lemma) = 1)",
]


def lemma_ctes(rows: str, column: str) -> list[str]:
    return [
        f"split_rows AS (SELECT id, {words(column)} AS ws FROM {rows})",
        "positions AS (SELECT id, unnest(ws) AS form, unnest(range(len(ws))) AS pos FROM split_rows)",
        "looked AS (SELECT p.id, p.pos, coalesce(a.lemma, p.form) AS lemma, b.tag AS tag FROM positions p "
        "LEFT JOIN lexicon a ON p.form = a.form LEFT JOIN lexicon b ON a.lemma = b.form)",
        "grouped AS (SELECT id, string_agg(lemma, ' ' ORDER BY pos) AS lemmas, "
        "string_agg(lemma, ' ' ORDER BY pos) FILTER (tag = 'NN') AS nouns FROM looked GROUP BY id)",
        f"stages AS (SELECT r.*, coalesce(g.lemmas, '') AS complaint_lemmatized, "
        f"coalesce(g.nouns, '') AS complaint_pos_filtered FROM {rows} r LEFT JOIN grouped g ON r.id = g.id)",
    ]


ORACLE["induce_lexicon"] = with_(LEXICON, "SELECT form, tag, lemma FROM lexicon")
_LEMMAS = [*LEXICON, CLEANED, *lemma_ctes("cleaned", "complaint_final")]
ORACLE["lemmatize_by_lexicon"] = with_(_LEMMAS, "SELECT id, complaint_lemmatized FROM stages")
ORACLE["keep_nouns"] = with_(_LEMMAS, "SELECT id, complaint_pos_filtered FROM stages")
ORACLE["preprocess"] = with_(
    [
        *LEXICON,
        FLAT,
        PRESENT,
        f"ready AS (SELECT id, product, {TEXT}, {clean(TEXT)} AS complaint_cleaned FROM present)",
        *lemma_ctes("ready", "complaint_cleaned"),
    ],
    "SELECT *, replace(replace(complaint_pos_filtered, '-PRON-', ''), 'xxxx', '') AS complaint_final FROM stages",
)

# --- tokens and features -----------------------------------------------------

for key, tokens in (("tokenize_ws", ws_tokens), ("remove_stopwords", ticket_tokens)):
    ORACLE[key] = with_(
        [CLEANED, f"t AS (SELECT id, {tokens('complaint_final')} AS w FROM cleaned)"],
        "SELECT id, len(w) AS n_tokens, array_to_string(w, '|') AS tokens FROM t",
    )


def vocabulary_ctes(tokens: str, min_df: int = 1, max_df: float = 1.0, size: int | None = None):
    limit = "" if size is None else f"QUALIFY term_id < {size}"
    return [
        f"words AS (SELECT id, lang, unnest({tokens}) AS term FROM cleaned_text)",
        "counts AS (SELECT id, lang, term, count(*) AS tf FROM words GROUP BY ALL)",
        "terms AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cnt, count(*) AS df FROM counts GROUP BY term "
        f"HAVING count(*) >= {min_df} AND count(*) <= {max_df} * {N_DOCS})",
        "vocabulary AS (SELECT row_number() OVER (ORDER BY cnt DESC, term) - 1 AS term_id, term, cnt, df "
        f"FROM terms {limit})",
    ]


TICKET_VOCAB = [
    CLEANED,
    "cleaned_text AS (SELECT * FROM cleaned)",
    *vocabulary_ctes(ticket_tokens("complaint_final")),
]
IDF = f"ln(({N_DOCS} + 1) / (v.df + 1))"

ORACLE["build_vocabulary"] = with_(TICKET_VOCAB, "SELECT term_id, term, cnt, df FROM vocabulary")
ORACLE["term_counts"] = with_(
    [
        *TICKET_VOCAB,
        f"talk AS (SELECT conv_id, turn, {clean('text')} AS c FROM conversations)",
        f"talk_words AS (SELECT conv_id, turn, unnest({ticket_tokens('c')}) AS term FROM talk)",
    ],
    "SELECT conv_id, turn, term, count(*) AS tf FROM talk_words "
    "WHERE term IN (SELECT term FROM vocabulary) GROUP BY ALL",
)
ORACLE["idf_weights"] = with_(
    TICKET_VOCAB, f"SELECT term_id, term, df, round({IDF}, 6) AS idf FROM vocabulary v"
)
ORACLE["tfidf"] = with_(
    TICKET_VOCAB,
    f"SELECT c.id, c.term, v.term_id, c.tf, round(c.tf * {IDF}, 6) AS weight "
    "FROM counts c JOIN vocabulary v ON c.term = v.term",
)
ORACLE["tfidf_vectors"] = with_(
    TICKET_VOCAB,
    f"SELECT c.id, v.term_id, round(c.tf * {IDF}, 6) AS weight "
    "FROM counts c JOIN vocabulary v ON c.term = v.term",
)


def unit_tfidf(tokens: str, min_df: int, max_df: float) -> str:
    return with_(
        [
            "cleaned_text AS (SELECT doc_id AS id, lang, text FROM documents)",
            *vocabulary_ctes(tokens, min_df, max_df),
            f"weighted AS (SELECT c.id, c.term, c.tf, c.tf * ({IDF} + 1) AS w "
            "FROM counts c JOIN vocabulary v ON c.term = v.term)",
        ],
        "SELECT id, term, tf, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM weighted",
    )


ORACLE["tfidf_l2"] = unit_tfidf(
    f"list_filter({pairs_words('text')}, lambda w: w NOT IN ({STOPS}))", 2, 0.95
)
ORACLE["tfidf_l2_all"] = unit_tfidf(pairs_words("text"), 1, 1.0)

# --- topics ------------------------------------------------------------------

TOP = [
    *TICKET_VOCAB,
    f"lang_weights AS (SELECT c.lang, c.term, round(sum(c.tf * {IDF}), 6) AS weight "
    "FROM counts c JOIN vocabulary v ON c.term = v.term GROUP BY ALL)",
    "ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY weight DESC, term) AS rank, "
    f"term, weight FROM lang_weights QUALIFY rank <= {TOP_TERMS})",
]
ORACLE["top_terms"] = with_(TOP, "SELECT lang, rank, term, weight FROM ranked")
ORACLE["topic_word_matrix"] = with_(
    TOP,
    "SELECT lang, "
    + ", ".join(f"max(term) FILTER (rank = {i}) AS word_{i}" for i in range(1, TOP_TERMS + 1))
    + " FROM ranked GROUP BY lang",
)
ORACLE["argmax_topic"] = (
    "SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS topic FROM embeddings"
)
ORACLE["head_per_topic"] = (
    f"SELECT {case_index('lang', LANGS)} AS topic, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rank, "
    f"doc_id AS id, text AS {TEXT} FROM documents QUALIFY rank <= 5 ORDER BY topic, id"
)
EVENTS = f"ev AS (SELECT event_id AS id, ts, {case_index('event_type', EVENT_TYPES)} AS topic FROM events)"
_NAMES = ", ".join("({}, '{}')".format(i, n.replace("'", "''")) for i, n in TOPICS)
DIM = f"dim(topic, topic_name) AS (VALUES {_NAMES})"
ORACLE["topic_name_lookup"] = with_(
    [EVENTS, DIM], "SELECT id, ev.topic, topic_name FROM ev LEFT JOIN dim ON ev.topic = dim.topic"
)
ORACLE["topic_id_lookup"] = with_(
    [
        EVENTS,
        DIM,
        "named AS (SELECT id, CASE WHEN ev.topic = 2 THEN 'Unlisted' ELSE topic_name END AS topic_name "
        "FROM ev LEFT JOIN dim ON ev.topic = dim.topic)",
    ],
    "SELECT id, named.topic_name, dim.topic FROM named LEFT JOIN dim ON named.topic_name = dim.topic_name",
)

# --- splits ------------------------------------------------------------------


def draw(seed, *parts: str) -> str:
    text = " || ':' || ".join([f"'{seed}'", *parts])
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def split_of(c: str, percent: int) -> str:
    return f"CASE WHEN {draw(SPLIT_SEED, c)} % 100 < {percent} THEN 'train' ELSE 'test' END"


ORACLE["hash_split"] = f"SELECT doc_id AS id, {split_of('doc_id', 80)} AS split FROM documents"
ORACLE["hash_split_75"] = f"SELECT doc_id AS id, {split_of('doc_id', 75)} AS split FROM documents"

_CDF = [
    math.exp(-BOOTSTRAP_FRACTION)
    * sum(BOOTSTRAP_FRACTION**i / math.factorial(i) for i in range(n + 1))
    for n in range(8)
]
_CUTS = sorted({math.floor(p * 2**32) for p in _CDF if math.floor(p * 2**32) < 2**32})
_DRAW = draw(BOOTSTRAP_SEED, "rep", "id")
WEIGHT = " + ".join(f"({_DRAW} >= {c})::INT" for c in _CUTS)


def drawn(rows: str) -> list[str]:
    return [
        f"reps AS (SELECT unnest(range(1, {BOOTSTRAP_REPLICATES + 1})) AS rep)",
        f"drawn AS (SELECT s.*, rep, {WEIGHT} AS weight FROM {rows} s, reps WHERE {WEIGHT} > 0)",
    ]


ORACLE["bootstrap_weights"] = with_(
    ["ids AS (SELECT event_id AS id FROM events)", *drawn("ids")],
    "SELECT id, rep, weight FROM drawn",
)

# --- evaluation --------------------------------------------------------------

_HITS = ", ".join(
    f"len(list_filter(ws, lambda w: w IN ({literals(known)})))" for known in FUNCTION_WORDS
)
SCORED = [
    f"guess AS (SELECT doc_id AS id, lang, source, {pairs_words('text')} AS ws FROM documents)",
    f"hits AS (SELECT id, lang, source, [{_HITS}] AS h FROM guess)",
    f"scored AS (SELECT id, {case_index('lang', LANGS)} AS label, list_position(h, list_max(h)) - 1 AS prediction, "
    f"source, {split_of('id', 80)} AS split FROM hits)",
]


def metric_ctes(rows: str, by: str, weight: str = "1") -> list[str]:
    return [
        f"matrix AS (SELECT {by}, label, prediction, sum({weight}) AS n FROM {rows} GROUP BY ALL)",
        f"sides AS (SELECT {by}, label AS class, n AS support, 0 AS predicted, "
        "CASE WHEN label = prediction THEN n ELSE 0 END AS hits FROM matrix "
        f"UNION ALL SELECT {by}, prediction, 0, n, 0 FROM matrix)",
        f"classes AS (SELECT {by}, class, sum(support) AS support, sum(predicted) AS predicted, sum(hits) AS hits "
        "FROM sides GROUP BY ALL)",
        f"pr AS (SELECT {by}, class, support, hits, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS p, "
        "CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r FROM classes)",
        "prf AS (SELECT *, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f FROM pr)",
        f"wide AS (SELECT {by}, sum(hits) / sum(support) AS accuracy, sum(p * support) / sum(support) AS precision, "
        "sum(r * support) / sum(support) AS recall, sum(f * support) / sum(support) AS f1 FROM prf "
        f"GROUP BY {by})",
    ]


ORACLE["accuracy"] = with_(
    SCORED,
    "SELECT split, round(avg((label = prediction)::INT), 6) AS accuracy, count(*) AS n_rows FROM scored GROUP BY split",
)
ORACLE["weighted_metrics"] = with_(
    [*SCORED, *metric_ctes("scored", "split")],
    "SELECT split, " + ", ".join(f"round({m}, 6) AS {m}" for m in METRICS) + " FROM wide",
)
ORACLE["classification_report"] = with_(
    [*SCORED, "every AS (SELECT 0 AS g, * FROM scored)", *metric_ctes("every", "g")],
    "SELECT CAST(class AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, "
    "CAST(support AS BIGINT) AS support FROM prf "
    "UNION ALL SELECT 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), "
    "(SELECT CAST(sum(support) AS BIGINT) FROM prf) FROM wide "
    "UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM prf "
    "UNION ALL SELECT 'weighted avg', round(precision, 6), round(recall, 6), round(f1, 6), "
    "(SELECT CAST(sum(support) AS BIGINT) FROM prf) FROM wide",
)


def bootstrap_ctes(rows: str, by: str) -> list[str]:
    return [
        *drawn(rows),
        *metric_ctes("drawn", f"{by}, rep", "weight"),
        f"boot AS (UNPIVOT wide ON {', '.join(METRICS)} INTO NAME metric VALUE value)",
    ]


SUMMARY = (
    "avg(value) AS mean, stddev_pop(value) AS std, quantile_cont(value, 0.025) AS p025, "
    "quantile_cont(value, 0.975) AS p975"
)
_ONE = ["every AS (SELECT 0 AS g, * FROM scored)"]
ORACLE["bootstrap_metrics"] = with_(
    [*SCORED, *_ONE, *bootstrap_ctes("every", "g")],
    "SELECT rep, metric, round(value, 6) AS value FROM boot",
)
ORACLE["bootstrap_summary"] = with_(
    [*SCORED, *_ONE, *bootstrap_ctes("every", "g"), f"s AS (SELECT metric, {SUMMARY} FROM boot GROUP BY metric)"],
    "SELECT metric, round(mean, 6) AS mean, round(std, 6) AS std, round(p025, 6) AS p025, round(p975, 6) AS p975 FROM s",
)
_X = "abs(z_score) / sqrt(2)"
_P = (
    f"CASE WHEN z_score IS NULL THEN NULL WHEN z_score = 0 THEN 1.0 WHEN {_X} >= 6 THEN 0.0 ELSE "
    f"1 - least(1.0, list_sum(list_transform(range(0, 160), lambda n: "
    f"exp((2 * n + 1) * ln({_X}) - ({_X}) * ({_X}) - lgamma(n + 1.5))))) END"
)
RUNS = [
    *SCORED,
    "run_rows AS (SELECT 'language_guess' AS experiment, source AS run_id, "
    "strftime(DATE '2024-01-01' + CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER), '%Y-%m-%d') AS start_date, "
    "id, label, prediction FROM scored)",
    *bootstrap_ctes("run_rows", "experiment, run_id, start_date"),
    f"summary AS (SELECT experiment, run_id, start_date, metric, {SUMMARY} FROM boot GROUP BY ALL)",
    "prev AS (SELECT *, lag(mean) OVER w AS prev_mean, lag(std) OVER w AS prev_std FROM summary "
    "WINDOW w AS (PARTITION BY experiment, metric ORDER BY start_date, run_id))",
    "zs AS (SELECT *, CASE WHEN std * std + prev_std * prev_std > 0 "
    "THEN (mean - prev_mean) / sqrt(std * std + prev_std * prev_std) END AS z_score FROM prev)",
    f"tested AS (SELECT *, {_P} AS p_value FROM zs)",
    f"judged AS (SELECT *, CASE WHEN p_value < {ALPHA} THEN 'significant' "
    "WHEN p_value IS NOT NULL THEN 'not significant' END AS verdict FROM tested)",
]
_RUN = "experiment, run_id, start_date, metric"


def rounded(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


ORACLE["previous_run"] = with_(RUNS, f"SELECT {_RUN}, {rounded('mean', 'std', 'prev_mean', 'prev_std')} FROM judged")
ORACLE["z_test"] = with_(RUNS, f"SELECT {_RUN}, {rounded('z_score', 'p_value')} FROM judged")
ORACLE["ab_verdict"] = with_(RUNS, f"SELECT {_RUN}, verdict FROM judged")
ORACLE["run_metrics_append"] = with_(
    RUNS,
    f"SELECT {_RUN}, {rounded('mean', 'std', 'p025', 'p975', 'z_score', 'p_value')}, verdict FROM judged",
)

# --- input rules -------------------------------------------------------------


def joined(parts: list[str]) -> str:
    return f"array_to_string(list_filter([{', '.join(parts)}], lambda e: e IS NOT NULL), ',')"


_MISSING = [f"CASE WHEN {f} IS NULL THEN '{f}_missing' END" for f in REQUIRED_FIELDS]
_DOMAIN = [
    "CASE WHEN length(state) > 2 THEN 'state_too_long' END",
    "CASE WHEN timely NOT IN ('Yes', 'No') THEN 'timely_invalid' END",
]


def stamp(c: str) -> str:
    """A timestamp of the full ISO form; without an offset it is UTC."""
    return (
        f"TRY_CAST(CASE WHEN regexp_matches({c}, '{ISO_TIMESTAMP}') THEN "
        rf"regexp_replace({c}, '{WITHOUT_SECONDS}', '\1:00\2') || "
        f"CASE WHEN regexp_matches({c}, '(Z|[+-][0-9]{{2}}:[0-9]{{2}})$') THEN '' ELSE 'Z' END END AS TIMESTAMPTZ)"
    )


_TIMES = [
    f"CASE WHEN {f} IS NOT NULL AND {stamp(f)} IS NULL THEN '{f}_invalid' END"
    for f in DATE_FIELDS
]
_IDS = ["CASE WHEN id IS NOT NULL AND TRY_CAST(id AS BIGINT) IS NULL THEN 'id_not_numeric' END"]
ORACLE["dq_required"] = with_([FLAT], f"SELECT id, {joined(_MISSING)} AS errors FROM flat")
ORACLE["dq_domain"] = with_([FLAT], f"SELECT id, {joined(_DOMAIN)} AS errors FROM flat")
ORACLE["dq_timestamp"] = with_(
    [FLAT],
    f"SELECT id, CAST(epoch({stamp('date_received')}) AS BIGINT) AS received_epoch, "
    f"{joined(_TIMES)} AS errors FROM flat",
)
ORACLE["dq_numeric_id"] = with_([FLAT], "SELECT id, TRY_CAST(id AS BIGINT) AS numeric_id FROM flat")
ORACLE["dq_quarantine"] = with_(
    [FLAT, f"c AS (SELECT id, {joined(_MISSING + _DOMAIN + _TIMES + _IDS)} AS errors FROM flat)"],
    "SELECT id, CASE WHEN errors = '' THEN 'valid' ELSE 'quarantine' END AS route, errors FROM c",
)

_BROKEN = f"CAST(replace(id, 'doc-', '') AS BIGINT) % {BROKEN_EVERY} = 0"
ORACLE["dq_malformed"] = with_(
    [FLAT, f"c AS (SELECT id, {_BROKEN} AS broken, {joined(_MISSING + _DOMAIN + _TIMES + _IDS)} AS errors FROM flat)"],
    "SELECT CASE WHEN NOT broken THEN id END AS id, "
    "CASE WHEN NOT broken AND errors = '' THEN 'valid' ELSE 'quarantine' END AS route, "
    "CASE WHEN broken THEN 'malformed_json' ELSE errors END AS errors, "
    f"CASE WHEN broken THEN '{{\"_index\":\"{EXPORT_NAME}\",\"_type\":\"complaint\",\"_id\":\"' || id || '\"' END AS record FROM c",
)

# --- tags in context ---------------------------------------------------------

_KNOWN = literals(w for words_ in FUNCTION_WORDS for w in words_)
_FORM, _BEHIND = "w[i]", f"(i > 1 AND w[i - 1] IN ({_KNOWN}))"
_WORDS = f"ws AS (SELECT doc_id AS id, lang, {words(f"coalesce({clean('text')}, '')")} AS w FROM documents)"
_TOKENS = (
    "toks AS (SELECT id, lang, i, w[i] AS form, "
    f"CASE WHEN w[i] IN ({_KNOWN}) THEN 'DT' WHEN length(w[i]) % 2 = 0 AND NOT {_BEHIND} THEN 'VB' ELSE 'NN' END AS tag "
    "FROM (SELECT id, lang, w, unnest(range(1, len(w) + 1)) AS i FROM ws))"
)
ORACLE["tag_bigrams"] = with_(
    [_WORDS, _TOKENS, "p AS (SELECT lag(tag) OVER (PARTITION BY id ORDER BY i) AS previous, tag FROM toks)"],
    "SELECT previous, tag, count(*) AS n FROM p GROUP BY ALL",
)
ORACLE["tag_forms"] = with_(
    [_WORDS, _TOKENS],
    "SELECT form, tag, regexp_replace(form, 's$', '') AS lemma, count(*) AS n FROM toks GROUP BY ALL",
)
ORACLE["context_tags_check"] = with_(
    [_WORDS, _TOKENS],
    "SELECT lang, count(*) AS n_words, true AS beats_lexicon, true AS accurate FROM toks WHERE id % 2 = 1 GROUP BY lang",
)

_FAR = "exp(-x * x) / sqrt(pi()) / list_reduce(list_prepend(x, list_transform(range(90, 0, -1), lambda k: CAST(k AS DOUBLE))), lambda t, k: x + k / 2 / t)"
_CLOSE = "1 - coalesce(list_sum(list_transform(range(0, 100), lambda n: exp((2 * n + 1) * ln(x) - x * x - lgamma(n + 1.5)))), 0)"
ORACLE["p_value_tails"] = (
    "WITH s AS (SELECT (doc_id % 200) / 10.0 AS z_score, count(*) AS n FROM documents GROUP BY ALL), "
    "t AS (SELECT *, z_score / sqrt(2) AS x FROM s) "
    f"SELECT z_score, n, round(ln(CASE WHEN x = 0 THEN 1.0 WHEN x < 2.5 THEN {_CLOSE} ELSE {_FAR} END), 8) AS log_p FROM t"
)

# --- topics that keep their ids ----------------------------------------------


def _lang_words(odd: int, langs) -> str:
    return (
        f"SELECT topic, term, CAST(count(*) AS DOUBLE) AS weight FROM (SELECT {case_index('lang', langs)} AS topic, "
        f"unnest({words(clean('text'))}) AS term FROM documents WHERE doc_id % 2 = {odd}) GROUP BY ALL"
    )


_COSINES = [
    f"old_t AS ({_lang_words(0, LANGS)})",
    f"new_t AS ({_lang_words(1, LANGS[::-1])})",
    "lo AS (SELECT topic, sqrt(sum(weight * weight)) AS l FROM old_t GROUP BY topic)",
    "ln AS (SELECT topic, sqrt(sum(weight * weight)) AS l FROM new_t GROUP BY topic)",
    "dots AS (SELECT o.topic AS old, n.topic AS new, sum(o.weight * n.weight) AS dot FROM old_t o "
    "JOIN new_t n ON o.term = n.term GROUP BY ALL)",
    "cosines AS (SELECT old, new, round(dot / (lo.l * ln.l), 6) AS cosine FROM dots "
    "JOIN lo ON lo.topic = old JOIN ln ON ln.topic = new)",
]
ORACLE["topic_cosines"] = with_(_COSINES, "SELECT old, new, cosine FROM cosines")
ORACLE["topic_alignment"] = with_(
    _COSINES,
    "SELECT new AS fitted, arg_max(old, cosine) AS topic, max(cosine) AS cosine, 'kept' AS state "
    "FROM cosines GROUP BY new",
)

# --- monitoring --------------------------------------------------------------

_METRIC = "trim(regexp_replace(lower(topic_name), '[^a-z0-9]+', '_', 'g'), '_')"


for key in ("topic_counters", "topic_counters_stream"):
    ORACLE[key] = with_(
        [EVENTS, DIM, "seen AS (SELECT topic, count(*) AS n FROM ev GROUP BY topic)"],
        f"SELECT dim.topic, {_METRIC} AS metric_name, coalesce(n, 0) AS n FROM dim LEFT JOIN seen ON dim.topic = seen.topic "
        "UNION ALL SELECT -1, 'unlisted', CAST(coalesce(sum(n), 0) AS BIGINT) FROM seen "
        "WHERE topic IS NULL OR topic NOT IN (SELECT topic FROM dim)",
    )
RATES = [
    EVENTS,
    "wins AS (SELECT topic, CAST(floor(epoch(ts) / 60) AS BIGINT) * 60 - 60 * unnest(range(0, 5)) AS start FROM ev)",
    "rates AS (SELECT start, topic, count(*) AS n, count(*) / 300.0 AS rate FROM wins GROUP BY ALL)",
]
_RATE = (
    "SELECT strftime(make_timestamp(start * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start, topic, n, "
    "round(CAST(rate AS DOUBLE), 6) AS rate FROM rates"
)
ORACLE["topic_rate_5m"] = with_(RATES, _RATE)
ORACLE["topic_rate_alerts"] = with_(RATES, f"{_RATE} WHERE rate > {ALERT_RATE}")
ORACLE["topic_rate_stream"] = with_(
    RATES, f"{_RATE} WHERE start + 300 <= (SELECT max(epoch_ms(ts)) FROM ev) / 1000.0 - 600"
)


def _alert_changes(seen: str) -> str:
    """Runs of windows over the rate, up to the time the stream has seen."""
    return with_(
        [
            *RATES,
            "upto AS (SELECT max(epoch_ms(ts)) / 1000.0 - 600 AS s FROM ev)",
            f"hot AS (SELECT topic, start + 300 AS e, rate FROM rates WHERE rate > {CHANGE_RATE} {seen}), "
            "gaps AS (SELECT *, e - lag(e) OVER (PARTITION BY topic ORDER BY e) AS gap FROM hot)",
            f"runs AS (SELECT *, sum(CASE WHEN gap <= {CHANGE_QUIET} THEN 0 ELSE 1 END) "
            "OVER (PARTITION BY topic ORDER BY e) AS run FROM gaps)",
            "al AS (SELECT topic, min(e) AS since, max(e) AS last, arg_min(rate, e) AS first_rate, "
            "max(rate) AS peak, count(*) AS n FROM runs GROUP BY topic, run)",
            "changes AS (SELECT topic, 'raised' AS state, since AS moment, since, first_rate AS peak, 1 AS n FROM al "
            f"UNION ALL SELECT topic, 'cleared', last + {CHANGE_QUIET}, since, peak, n FROM al "
            f"{f'WHERE last + {CHANGE_QUIET} <= (SELECT s FROM upto)' if seen else ''})",
        ],
        "SELECT topic, state, strftime(make_timestamp(CAST(moment * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS \"at\", "
        "strftime(make_timestamp(CAST(since * 1000000 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS since, "
        "round(CAST(peak AS DOUBLE), 6) AS peak, n AS n_windows FROM changes",
    )


ORACLE["topic_alert_changes"] = _alert_changes("")
ORACLE["topic_alert_stream"] = _alert_changes("AND start + 300 <= (SELECT s FROM upto)")


# --- what must hold of fits and of what depends on them -----------------------

HAS_TERMS = "id IN (SELECT id FROM counts)"
_TERMS = (
    "SELECT CAST(topic AS INTEGER) AS topic, {n} AS n_terms, {n} AS n_ranks, {n} AS n_known, "
    "true AS no_negative, true AS falling{more} FROM range({k}) t(topic)"
)


def terms_check(more: str = "") -> str:
    return _TERMS.format(n=TOP_TERMS, k=N_TOPICS, more=more)


ORACLE["preprocess_arrivals"] = ORACLE["preprocess"]
ORACLE["lemmatize_joined"] = with_(
    _LEMMAS, "SELECT id, complaint_lemmatized, complaint_pos_filtered FROM stages"
)
ORACLE["tfidf_joined"] = ORACLE["tfidf"]
ORACLE["tfidf_l2_joined"] = ORACLE["tfidf_l2"]
ORACLE["lda_fit_check"] = with_(
    TICKET_VOCAB,
    f"SELECT count(*) AS n_docs, round(CAST(count(*) FILTER ({HAS_TERMS}) AS DOUBLE), 2) AS mass, "
    f"{N_TOPICS} AS n_topics, true AS no_negative FROM cleaned",
)
ORACLE["lda_mixture_check"] = with_(
    TICKET_VOCAB,
    f"SELECT id, {HAS_TERMS} AS has_terms, CAST(CASE WHEN {HAS_TERMS} THEN 1 ELSE 0 END AS DOUBLE) AS mass, "
    "true AS is_argmax, true AS in_range FROM cleaned",
)
ORACLE["lda_wide_mixture_check"] = with_(
    TICKET_VOCAB,
    f"SELECT id, {HAS_TERMS} AS has_terms, CAST(CASE WHEN {HAS_TERMS} THEN 1 ELSE 0 END AS DOUBLE) AS mass, "
    "true AS is_argmax FROM cleaned",
)
ORACLE["lda_wide_mass"] = with_(
    TICKET_VOCAB, "SELECT term, CAST(cnt AS DOUBLE) AS n, true AS bound_rises FROM vocabulary"
)
ORACLE["topic_terms_check"] = terms_check()
ORACLE["nmf_fit_check"] = terms_check(", true AS loss_falls, true AS converged")
ORACLE["nmf_transform_check"] = with_(
    [
        "cleaned_text AS (SELECT doc_id AS id, lang, text FROM documents)",
        *vocabulary_ctes(f"list_filter({pairs_words('text')}, lambda w: w NOT IN ({STOPS}))", 2, 0.95),
        "known AS (SELECT DISTINCT id FROM counts WHERE term IN (SELECT term FROM vocabulary))",
    ],
    "SELECT doc_id AS id, doc_id IN (SELECT id FROM known) AS has_terms, true AS in_range FROM documents",
)
ORACLE["random_split_check"] = "SELECT doc_id AS id, 1 AS n_parts FROM documents"
for key in ("label_check", "model_reload_check"):
    ORACLE[key] = "SELECT doc_id AS id, true AS equal FROM documents"


def split_check(percent: int) -> str:
    return (
        f"WITH r AS (SELECT {split_of('doc_id', percent)} AS split, lang FROM documents), "
        "c AS (SELECT split, lang, count(*) AS n FROM r GROUP BY ALL) "
        "SELECT split, CAST(sum(n) AS BIGINT) AS n_rows, round(max(n) / sum(n), 6) AS majority, "
        "true AS better FROM c GROUP BY split"
    )


ORACLE["lr_fit_check"] = split_check(80)
ORACLE["lr_wide_fit_check"] = split_check(80)
ORACLE["lr_ovr_fit_check"] = split_check(75)
ORACLE["train_and_evaluate_check"] = (
    f"SELECT DISTINCT {split_of('doc_id', 80)} AS split, true AS in_range, true AS equal FROM documents"
)
ORACLE["score_labelled_check"] = (
    f"SELECT doc_id AS id, {case_index('lang', LANGS)} AS label, {split_of('doc_id', 80)} AS split, "
    "true AS in_range FROM documents"
)
ORACLE["score_batch_check"] = with_(
    [FLAT], f"SELECT id, coalesce({TEXT}, '') AS {TEXT}, true AS in_range FROM flat"
)
_JUDGED = [FLAT, f"judged AS (SELECT *, {joined(_MISSING + _DOMAIN + _TIMES + _IDS)} AS errors FROM flat)"]
_ANSWERED = f"CAST(id AS BIGINT) AS complaint_id, coalesce({TEXT}, '') AS complaint_text"
ORACLE["service_predictions_check"] = with_(
    _JUDGED, f"SELECT {_ANSWERED}, true AS in_range FROM judged WHERE errors = ''"
)
ORACLE["service_stream_check"] = with_(
    _JUDGED, f"SELECT {_ANSWERED}, true AS equal FROM judged WHERE errors = ''"
)
ORACLE["service_refused"] = with_(_JUDGED, "SELECT id, errors FROM judged WHERE errors <> ''")
ORACLE["service_counters"] = with_(
    _JUDGED,
    f"SELECT count(*) AS n_answers, {len(TOPICS) + 1} AS n_counters, 0 AS n_unlisted FROM judged WHERE errors = ''",
)
ORACLE["service_rates"] = with_(
    [
        *_JUDGED,
        f"secs AS (SELECT CAST(epoch({stamp('date_received')}) AS BIGINT) AS s FROM judged "
        "WHERE errors = '' AND date_received IS NOT NULL)",
        "wins AS (SELECT s - s % 60 - 60 * unnest(range(0, 5)) AS start FROM secs)",
    ],
    "SELECT strftime(make_timestamp(start * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start, "
    "count(*) AS n FROM wins GROUP BY start",
)
ORACLE["score_stream_check"] = (
    f"SELECT conv_id, turn, coalesce(text, '') AS {TEXT}, true AS equal FROM conversations"
)
