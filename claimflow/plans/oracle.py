"""DuckDB SQL twins of the registered queries (same names, same columns).

Patterns and rule lists are rendered from the same constants the Spark
side uses, so the check compares two engines on one specification.
DuckDB lambdas are written ``lambda x: ...``.
"""

from __future__ import annotations

from claimflow.functions.text import (
    clean_text_sql, html_title_sql, html_to_text_sql, q, tokenize_sql, url_authority_sql,
)
from claimflow.functions.text import decode_entities_sql
from claimflow.operators.pages import (
    HOST_PATTERN, HREF_PATTERN, HREF_QUOTES, PLAIN_NO_LINKS_PATTERN, SCHEME_PATTERN, SKIP_URL_PATTERN,
)
from claimflow.plans import inputs as I

ORACLE: dict[str, str] = {}


def _list(xs) -> str:
    return "[" + ", ".join(q(x) for x in xs) + "]::VARCHAR[]"


def doc_input_sql() -> str:
    return (f"SELECT doc_id, text, source, CASE doc_id % 3 WHEN 0 THEN 'positive' "
            f"WHEN 1 THEN 'negative' ELSE 'unknown' END AS domain_type, "
            f"{q(I.DOC_NICHE)} AS niche FROM documents")


def page_text_sql() -> str:
    return (f"SELECT page_id, url, {html_title_sql('html')} AS title, {html_to_text_sql('html')} AS text, "
            f"{url_authority_sql('url')} AS source FROM pages")


def page_input_sql() -> str:
    rs = I.page_rule_set()
    return (f"SELECT page_id, url, title, text, source, "
            f"CASE WHEN len(list_filter({_list(rs.positive_domains)}, lambda d: contains(lower(source), d))) > 0 THEN 'positive' "
            f"WHEN len(list_filter({_list(rs.negative_domains)}, lambda d: contains(lower(source), d))) > 0 THEN 'negative' "
            f"ELSE 'unknown' END AS domain_type, {q(rs.niche)} AS niche "
            f"FROM ({page_text_sql()}) WHERE length(text) > 50")


def scored_sql(input_sql: str, rs) -> str:
    """L1-L4 over an input with text, source, domain_type."""
    hits = (f"SELECT *, "
            f"len(list_filter({_list(rs.positive_domains)}, lambda d: contains(lower(coalesce(source, '')), d))) > 0 AS pos_domain, "
            f"len(list_filter({_list(rs.negative_domains)}, lambda d: contains(lower(coalesce(source, '')), d))) > 0 AS neg_domain, "
            f"list_filter({_list(rs.positive_phrases)}, lambda p: contains(lower(coalesce(text, '')), p)) AS pos_hits, "
            f"list_filter({_list(rs.negative_phrases)}, lambda p: contains(lower(coalesce(text, '')), p)) AS neg_hits "
            f"FROM ({input_sql})")
    scores = (f"SELECT *, CAST((CASE WHEN pos_domain THEN 2 ELSE 0 END) + len(pos_hits) AS INTEGER) AS positive_score, "
              f"CAST((CASE WHEN neg_domain THEN 2 ELSE 0 END) + len(neg_hits) AS INTEGER) AS negative_score "
              f"FROM ({hits})")
    pl, nl = q(rs.positive_label), q(rs.negative_label)
    return (f"SELECT *, positive_score = negative_score AS tie, "
            f"CASE WHEN positive_score > negative_score THEN {pl} WHEN negative_score > positive_score THEN {nl} "
            f"WHEN domain_type = 'positive' THEN {pl} WHEN domain_type = 'negative' THEN {nl} "
            f"ELSE 'unlabeled' END AS label, "
            f"concat_ws('|', CASE WHEN pos_domain THEN 'positive_domain:' || source END, "
            f"CASE WHEN neg_domain THEN 'negative_domain:' || source END, "
            f"CASE WHEN len(pos_hits) > 0 THEN 'positive_phrases:' || array_to_string(pos_hits, ',') END, "
            f"CASE WHEN len(neg_hits) > 0 THEN 'negative_phrases:' || array_to_string(neg_hits, ',') END, "
            f"CASE WHEN positive_score = negative_score THEN (CASE domain_type WHEN 'positive' THEN 'domain_type_fallback:positive' "
            f"WHEN 'negative' THEN 'domain_type_fallback:negative' ELSE 'no_heuristics_match' END) END) AS heuristics, "
            f"{pl} AS positive_label, {nl} AS negative_label "
            f"FROM ({scores})")


def doc_scored_sql() -> str:
    return scored_sql(doc_input_sql(), I.doc_rule_set())


def page_scored_sql() -> str:
    return scored_sql(page_input_sql(), I.page_rule_set())


def stats_sql(scored: str) -> str:
    return (f"SELECT niche, count(*) AS total_samples, "
            f"count(*) FILTER (WHERE label = positive_label) AS positive_labeled, "
            f"count(*) FILTER (WHERE label = negative_label) AS negative_labeled, "
            f"count(*) FILTER (WHERE label = 'unlabeled') AS unlabeled, "
            f"count(*) FILTER (WHERE pos_domain AND neg_domain) AS conflicts, "
            f"count(*) FILTER (WHERE pos_domain OR neg_domain) AS domain_matches, "
            f"count(*) FILTER (WHERE len(pos_hits) + len(neg_hits) > 0) AS phrase_matches "
            f"FROM ({scored}) GROUP BY niche")


def pct_sql(part: str, total: str) -> str:
    return (f"CASE WHEN {total} > 0 THEN CAST(floor(({part} * 2000 + {total}) / ({total} * 2)) AS DOUBLE) / 10.0 END")


def _build():
    o = ORACLE
    o["page_label_counts"] = (
        f"SELECT label, tie, count(*) AS rows, count(*) FILTER (WHERE pos_domain AND neg_domain) AS conflicts "
        f"FROM ({page_scored_sql()}) GROUP BY label, tie")
    o["document_labels"] = (
        f"SELECT niche || '_' || CAST(doc_id AS VARCHAR) AS id, doc_id, label, heuristics, positive_score, negative_score "
        f"FROM ({doc_scored_sql()})")
    o["document_label_counts"] = f"SELECT label, tie, count(*) AS rows FROM ({doc_scored_sql()}) GROUP BY label, tie"
    o["labeling_stats"] = f"{stats_sql(doc_scored_sql())} UNION ALL {stats_sql(page_scored_sql())}"
    rs = I.doc_rule_set()
    cols = ["positive_labeled", "negative_labeled", "unlabeled", "domain_matches", "phrase_matches", "conflicts"]
    heads = ", ".join(f"{q(', '.join(getattr(rs, c)[:5]))} AS {c}_head"
                      for c in ("positive_phrases", "negative_phrases", "positive_domains", "negative_domains"))
    o["label_quality_report"] = (
        f"SELECT s.*, {heads}, " + ", ".join(f"{pct_sql(c, 'total_samples')} AS {c}_pct" for c in cols)
        + f" FROM ({stats_sql(doc_scored_sql())}) s")
    o["label_preview"] = (
        f"SELECT niche || '_' || CAST(doc_id AS VARCHAR) AS id, label, source, heuristics, "
        f"substring(coalesce(text, ''), 1, 100) || '...' AS text_preview "
        f"FROM ({doc_scored_sql()}) ORDER BY id LIMIT 10")
    gate = ("SELECT niche, count(*) FILTER (WHERE label = positive_label) AS positive_count, "
            "count(*) FILTER (WHERE label = negative_label) AS negative_count, {m} AS min_samples_per_class, "
            "count(*) FILTER (WHERE label = positive_label) >= {m} AND count(*) FILTER (WHERE label = negative_label) >= {m} AS passed "
            "FROM ({s}) GROUP BY niche")
    o["min_sample_gate"] = (
        gate.format(m=f"CAST({I.doc_rule_set().min_samples_per_class} AS INTEGER)", s=doc_scored_sql())
        + " UNION ALL "
        + gate.format(m=f"CAST({I.page_rule_set().min_samples_per_class} AS INTEGER)", s=page_scored_sql()))
    o["binary_labels"] = (
        f"SELECT niche || '_' || CAST(doc_id AS VARCHAR) AS id, label, "
        f"CAST(CASE WHEN label = positive_label THEN 1 WHEN label = negative_label THEN 0 END AS INTEGER) AS label_binary "
        f"FROM ({doc_scored_sql()}) WHERE label IN (positive_label, negative_label)")
    o["clean_text"] = f"SELECT doc_id, {clean_text_sql('text')} AS text_clean FROM documents"
    o["preprocessed_documents"] = (
        f"SELECT doc_id, array_to_string(tokens, ' ') AS text_processed, CAST(len(tokens) AS INTEGER) AS n_tokens "
        f"FROM (SELECT doc_id, {tokenize_sql(clean_text_sql('text'))} AS tokens FROM documents) WHERE len(tokens) > 0")
    o["page_text"] = (
        f"SELECT page_id, title, text, source, length(text) > 50 AS success, "
        f"CASE WHEN NOT (length(text) > 50) THEN 'No content found' END AS error FROM ({page_text_sql()})")
    markup = f"regexp_replace(coalesce(html, ''), {q(PLAIN_NO_LINKS_PATTERN)}, '', 'g')"
    raw = (f"SELECT page_id, domain, unnest(h) AS raw, unnest(generate_series(0, len(h) - 1)) AS pos FROM ("
           f"SELECT page_id, {url_authority_sql('url')} AS domain, regexp_extract_all({markup}, {q(HREF_PATTERN)}, 1) AS h FROM pages)")
    bare = f"SELECT page_id, domain, pos, regexp_replace(raw, {q(HREF_QUOTES)}, '', 'g') AS bare FROM ({raw})"
    links = f"SELECT page_id, domain, pos, trim({decode_entities_sql('bare', legacy=False)}) AS href FROM ({bare})"
    resolved = (f"SELECT page_id, domain, pos, CASE WHEN regexp_matches(href, {q(SCHEME_PATTERN)}) THEN href "
                f"WHEN starts_with(href, '//') THEN 'https:' || href "
                f"WHEN starts_with(href, '/') OR starts_with(href, '?') OR starts_with(href, '#') THEN 'https://' || domain || href "
                f"WHEN href = '' THEN 'https://' || domain ELSE 'https://' || domain || '/' || href END AS url "
                f"FROM ({links})")
    kept = (f"SELECT * FROM ({resolved}) WHERE ({url_authority_sql('url')} = domain "
            f"OR ends_with({url_authority_sql('url')}, '.' || domain)) AND NOT regexp_matches(url, {q(SKIP_URL_PATTERN)})")
    first = (f"SELECT domain, url, arg_min(page_id, (page_id, pos)) AS page_id, arg_min(pos, (page_id, pos)) AS pos "
             f"FROM ({kept}) GROUP BY domain, url")
    o["article_urls"] = (
        f"SELECT * FROM (SELECT domain, url, page_id, CAST(pos AS INTEGER) AS pos, "
        f"CAST(row_number() OVER (PARTITION BY domain ORDER BY page_id, pos, url) AS INTEGER) AS rank FROM ({first})) WHERE rank <= {I.page_rule_set().max_per_source}")
    o["feed_entries"] = (
        "SELECT feed, entry_pos, link, published, summary FROM (SELECT source AS feed, doc_id AS entry_pos, "
        "'doc:' || CAST(doc_id AS VARCHAR) AS link, CASE WHEN doc_id % 7 <> 0 THEN TIMESTAMP '2024-06-01 00:00:00' - "
        "to_days(CAST(CASE WHEN doc_id % 5 = 0 THEN 365 ELSE (doc_id * 37) % 730 END AS INTEGER)) END AS published, "
        "substring(coalesce(text, ''), 1, 200) AS summary, "
        "row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) "
        "WHERE n <= 30 AND (published IS NULL OR published >= TIMESTAMP '2023-06-02 00:00:00')")
    o["page_domain_tags"] = _tags_sql([I.page_rule_set(), I.doc_rule_set()], success_only=False)
    o["length_gate"] = (
        f"SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents "
        f"WHERE length(coalesce(text, '')) BETWEEN {I.doc_rule_set().min_text_length} AND {I.doc_rule_set().max_text_length}")
    tagged = _tags_sql([I.page_rule_set()], success_only=True)
    o["collection_summary"] = (
        f"WITH t AS ({tagged}), c AS (SELECT domain_type, count(*) AS rows FROM t GROUP BY domain_type), "
        f"f AS (SELECT domain_type, source, min(page_id) AS first FROM t GROUP BY domain_type, source), "
        f"r AS (SELECT *, row_number() OVER (PARTITION BY domain_type ORDER BY first, source) AS rn FROM f), "
        f"s AS (SELECT domain_type, string_agg(source, ', ' ORDER BY rn) AS sample_sources FROM r WHERE rn <= 5 GROUP BY domain_type) "
        f"SELECT c.domain_type, c.rows, s.sample_sources FROM c LEFT JOIN s USING (domain_type)")


def _tags_sql(rule_sets, success_only: bool) -> str:
    doms = " UNION ".join(
        f"SELECT {q(rs.niche)} AS niche, unnest({_list(rs.positive_domains)}) AS domain, 'positive' AS domain_type "
        f"UNION SELECT {q(rs.niche)}, unnest({_list(rs.negative_domains)}), 'negative'" for rs in rule_sets)
    where = "WHERE length(text) > 50" if success_only else ""
    host = f"lower(regexp_extract(source, {q(HOST_PATTERN)}, 1))"
    sfx = (f"SELECT page_id, source, unnest(list_transform(generate_series(1, len(string_split({host}, '.'))), "
           f"lambda i: array_to_string(string_split({host}, '.')[i:], '.'))) AS suffix "
           f"FROM ({page_text_sql()}) {where}")
    return (f"SELECT s.page_id, s.source, d.niche, d.domain AS matched_domain, d.domain_type "
            f"FROM ({sfx}) s JOIN ({doms}) d ON s.suffix = d.domain")


_build()


# ----------------------------- splits and features --------------------------

def split_sql(input_sql: str, strata: str, key: str, n_folds: int = 5) -> str:
    """Plain per-stratum window: the definition the bucketed plan must equal."""
    held = "CAST(ceil(n * CAST(0.3 AS DOUBLE)) AS BIGINT)"
    return (f"SELECT * EXCLUDE (n, n_train, n_val), "
            f"CASE WHEN rank <= n_train THEN 'train' WHEN rank <= n_train + n_val THEN 'validation' ELSE 'test' END AS split, "
            f"CASE WHEN rank <= n_train THEN CAST((rank - 1) % {n_folds} AS INTEGER) END AS fold "
            f"FROM (SELECT *, n - {held} AS n_train, {held} - CAST(ceil({held} * CAST(0.5 AS DOUBLE)) AS BIGINT) AS n_val "
            f"FROM (SELECT *, row_number() OVER (PARTITION BY {strata} ORDER BY md5(CAST({key} AS VARCHAR) || ':42'), {key}) AS rank, "
            f"count(*) OVER (PARTITION BY {strata}) AS n FROM ({input_sql})))")


def doc_split_sql() -> str:
    return split_sql("SELECT d.doc_id, l.quality AS label FROM documents d JOIN labels l USING (doc_id)",
                     "label", "doc_id")


def preprocessed_sql() -> str:
    return (f"SELECT doc_id, array_to_string(tokens, ' ') AS text_processed "
            f"FROM (SELECT doc_id, {tokenize_sql(clean_text_sql('text'))} AS tokens FROM documents) WHERE len(tokens) > 0")


def tfidf_ctes(min_df=3, max_df=0.95, max_features=10_000) -> str:
    from claimflow.functions.stopwords import ENGLISH_STOP_WORDS
    from claimflow.operators.features import MODEL_TOKEN_PATTERN
    stops = _list(ENGLISH_STOP_WORDS)
    return (
        f"pre AS ({preprocessed_sql()}), "
        f"mt AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text_processed), {q(MODEL_TOKEN_PATTERN)}, 0), "
        f"lambda t: NOT list_contains({stops}, t)) AS t FROM pre), "
        f"tm AS (SELECT doc_id, list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS terms FROM mt), "
        f"tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM tm) GROUP BY doc_id, term), "
        f"nd AS (SELECT count(*) AS n FROM pre), "
        f"st AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf GROUP BY term), "
        f"kept AS (SELECT st.*, nd.n FROM st, nd WHERE df >= {min_df} AND df <= {max_df} * n "
        f"ORDER BY cf DESC, term LIMIT {max_features}), "
        f"vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, cf, "
        f"ln(CAST(1 + n AS DOUBLE) / CAST(1 + df AS DOUBLE)) + 1 AS idf FROM kept), "
        f"w AS (SELECT doc_id, term, idx, (1 + ln(CAST(tf AS DOUBLE))) * idf AS w FROM tf JOIN vocab USING (term))")


def _build_more():
    o = ORACLE
    o["stratified_split"] = f"SELECT doc_id, label, split, fold, CAST(rank AS BIGINT) AS rank FROM ({doc_split_sql()})"
    o["split_class_counts"] = f"SELECT split, label, count(*) AS n FROM ({doc_split_sql()}) GROUP BY split, label"
    unified = (f"SELECT niche || '_' || CAST(doc_id AS VARCHAR) AS id, niche, label, "
               f"CAST(CASE WHEN label = positive_label THEN 1 ELSE 0 END AS INTEGER) AS label_binary "
               f"FROM ({doc_scored_sql()}) WHERE label IN (positive_label, negative_label) UNION ALL "
               f"SELECT niche || '_' || CAST(page_id AS VARCHAR), niche, label, "
               f"CAST(CASE WHEN label = positive_label THEN 1 ELSE 0 END AS INTEGER) "
               f"FROM ({page_scored_sql()}) WHERE label IN (positive_label, negative_label)")
    o["unified_split_counts"] = (
        f"SELECT coalesce(split, '(all)') AS split, coalesce(niche, '(all)') AS niche, count(*) AS n "
        f"FROM ({split_sql(unified, 'label_binary, niche', 'id')}) GROUP BY ROLLUP (split, niche)")
    o["class_weights"] = (
        f"SELECT label, n_c, round(CAST(sum(n_c) OVER () AS DOUBLE) / (count(*) OVER () * n_c), 6) AS weight "
        f"FROM (SELECT label, count(*) AS n_c FROM ({doc_split_sql()}) WHERE split = 'train' GROUP BY label)")
    o["tfidf_vocabulary"] = f"WITH {tfidf_ctes()} SELECT term, idx, df, cf, round(idf, 6) AS idf FROM vocab"
    o["tfidf_weights"] = (f"WITH {tfidf_ctes()} SELECT doc_id, term, idx, "
                          f"round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w")


_build_more()


# ----------------------------- evaluation -----------------------------------

def rule_pred_sql() -> str:
    return (f"SELECT d.doc_id, l.quality AS actual, CAST(CASE WHEN d.label = d.positive_label THEN 1 ELSE 0 END AS INTEGER) AS predicted, "
            f"CAST(d.positive_score - d.negative_score AS DOUBLE) AS score FROM ({doc_scored_sql()}) d JOIN labels l USING (doc_id)")


def curve_sql() -> str:
    st = (f"SELECT score, count(*) FILTER (WHERE actual = 1) AS pos_n, count(*) FILTER (WHERE actual <> 1) AS neg_n "
          f"FROM ({rule_pred_sql()}) WHERE score IS NOT NULL GROUP BY score")
    return (f"SELECT *, sum(pos_n) OVER (ORDER BY score DESC) AS cp, sum(neg_n) OVER (ORDER BY score DESC) AS cn, "
            f"sum(pos_n) OVER () AS P, sum(neg_n) OVER () AS N FROM ({st})")


def confusion_sql() -> str:
    return (f"WITH p AS ({rule_pred_sql()}), c AS (SELECT actual AS c FROM p UNION SELECT predicted FROM p), "
            f"k AS (SELECT actual, predicted, count(*) AS count FROM p GROUP BY actual, predicted) "
            f"SELECT a.c AS actual, b.c AS predicted, coalesce(k.count, 0) AS count FROM c a CROSS JOIN c b "
            f"LEFT JOIN k ON k.actual = a.c AND k.predicted = b.c")


def report_sql() -> str:
    cm = confusion_sql()
    x = (f"SELECT t.actual AS class, t.count AS tp, (SELECT sum(count) FROM ({cm}) z WHERE z.predicted = t.actual) AS pred_n, "
         f"(SELECT sum(count) FROM ({cm}) z WHERE z.actual = t.actual) AS support FROM ({cm}) t WHERE t.actual = t.predicted")
    r = (f"SELECT class, CASE WHEN pred_n = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / pred_n END AS precision, "
         f"CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / support END AS recall, CAST(support AS BIGINT) AS support FROM ({x})")
    return (f"SELECT class, precision, recall, CASE WHEN precision + recall = 0 THEN 0.0 "
            f"ELSE 2 * precision * recall / (precision + recall) END AS f1, support FROM ({r})")


def _build_eval():
    o = ORACLE
    o["eval_accuracy"] = (f"SELECT round(avg(CAST(actual = predicted AS DOUBLE)), 6) AS accuracy, count(*) AS n "
                          f"FROM ({rule_pred_sql()})")
    o["eval_confusion"] = confusion_sql()
    o["eval_class_report"] = (f"SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, "
                              f"round(f1, 6) AS f1, support FROM ({report_sql()})")
    summ = (f"SELECT avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1, "
            f"sum(precision * support) / sum(support) AS weighted_precision, sum(recall * support) / sum(support) AS weighted_recall, "
            f"sum(f1 * support) / sum(support) AS weighted_f1 FROM ({report_sql()})")
    auc = (f"SELECT sum(CAST(neg_n AS DOUBLE) * (2 * (cp - pos_n) + pos_n) / 2.0) / (CAST(max(P) AS DOUBLE) * max(N)) AS roc_auc "
           f"FROM ({curve_sql()})")
    ap = (f"SELECT sum((CASE WHEN P = 0 THEN 0.0 ELSE CAST(pos_n AS DOUBLE) / P END) * "
          f"(CASE WHEN cp + cn = 0 THEN 0.0 ELSE CAST(cp AS DOUBLE) / (cp + cn) END)) AS average_precision FROM ({curve_sql()})")
    o["eval_summary"] = (f"SELECT metric, round(CAST(value AS DOUBLE), 6) AS value FROM ("
                         f"UNPIVOT ({summ}) ON COLUMNS(*) INTO NAME metric VALUE value "
                         f"UNION ALL UNPIVOT ({auc}) ON COLUMNS(*) INTO NAME metric VALUE value "
                         f"UNION ALL UNPIVOT ({ap}) ON COLUMNS(*) INTO NAME metric VALUE value)")
    o["eval_roc_curve"] = (f"SELECT 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL "
                           f"SELECT score, round(CASE WHEN N = 0 THEN 0.0 ELSE CAST(cn AS DOUBLE) / N END, 6), "
                           f"round(CASE WHEN P = 0 THEN 0.0 ELSE CAST(cp AS DOUBLE) / P END, 6) FROM ({curve_sql()})")
    o["eval_pr_curve"] = (f"SELECT score AS threshold, round(CASE WHEN cp + cn = 0 THEN 0.0 ELSE CAST(cp AS DOUBLE) / (cp + cn) END, 6) AS precision, "
                          f"round(CASE WHEN P = 0 THEN 0.0 ELSE CAST(cp AS DOUBLE) / P END, 6) AS recall FROM ({curve_sql()}) "
                          f"UNION ALL SELECT 'inf'::DOUBLE, 1.0, 0.0")
    o["prediction_summary"] = (
        f"SELECT predicted, n, round(mean_confidence, 6) AS mean_confidence, round(CAST(n AS DOUBLE) / sum(n) OVER (), 6) AS share "
        f"FROM (SELECT predicted, count(*) AS n, avg(abs(score) / (abs(score) + 1.0)) AS mean_confidence "
        f"FROM ({rule_pred_sql()}) GROUP BY predicted)")


_build_eval()

ORACLE["csv_round_trip"] = "SELECT doc_id, source, text FROM documents"


def split_features_sql() -> str:
    from claimflow.functions.stopwords import ENGLISH_STOP_WORDS
    from claimflow.operators.features import MODEL_TOKEN_PATTERN
    stops = _list(ENGLISH_STOP_WORDS)
    pre = (f"SELECT doc_id, label, array_to_string(tokens, ' ') AS text_processed FROM (SELECT d.doc_id, l.quality AS label, "
           f"{tokenize_sql(clean_text_sql('d.text'))} AS tokens FROM documents d JOIN labels l USING (doc_id)) WHERE len(tokens) > 0")
    sp = split_sql(pre, "label", "doc_id")
    return (
        f"WITH sp AS ({sp}), "
        f"mt AS (SELECT doc_id, split, list_filter(regexp_extract_all(lower(text_processed), {q(MODEL_TOKEN_PATTERN)}, 0), "
        f"lambda t: NOT list_contains({stops}, t)) AS t FROM sp), "
        f"tm AS (SELECT doc_id, split, list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS terms FROM mt), "
        f"tf AS (SELECT doc_id, split, term, count(*) AS tf FROM (SELECT doc_id, split, unnest(terms) AS term FROM tm) GROUP BY doc_id, split, term), "
        f"nd AS (SELECT count(*) AS n FROM sp WHERE split = 'train'), "
        f"st AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM tf WHERE split = 'train' GROUP BY term), "
        f"kept AS (SELECT st.*, nd.n FROM st, nd WHERE df >= 2 AND df <= 0.95 * n ORDER BY cf DESC, term LIMIT 10000), "
        f"vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, "
        f"ln(CAST(1 + n AS DOUBLE) / CAST(1 + df AS DOUBLE)) + 1 AS idf FROM kept), "
        f"w AS (SELECT doc_id, split, term, idx, (1 + ln(CAST(tf AS DOUBLE))) * idf AS w FROM tf JOIN vocab USING (term)) "
        f"SELECT doc_id, split, term, idx, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w")


ORACLE["distinct_sources"] = "SELECT DISTINCT source FROM documents"
ORACLE["split_features"] = split_features_sql()
ORACLE["eval_by_language"] = (
    f"SELECT d.lang, round(avg(CAST(p.actual = p.predicted AS DOUBLE)), 6) AS accuracy, count(*) AS n "
    f"FROM ({rule_pred_sql()}) p JOIN documents d USING (doc_id) GROUP BY d.lang")

ORACLE["conversation_tokens"] = (
    f"SELECT conv_id, turn, role, text_clean, array_to_string(tokens, ' ') AS text_processed, "
    f"CAST(len(tokens) AS INTEGER) AS n_tokens FROM (SELECT conv_id, turn, role, text_clean, "
    f"{tokenize_sql('text_clean')} AS tokens FROM (SELECT conv_id, turn, role, {clean_text_sql('text')} AS text_clean "
    f"FROM conversations))")


def collected_page_labels_sql() -> str:
    rs = I.page_rule_set()
    tags = _tags_sql([rs], success_only=True)
    inp = (f"SELECT t.page_id, p.text, t.source, t.domain_type, t.niche FROM ({tags}) t "
           f"JOIN ({page_text_sql()}) p USING (page_id)")
    return (f"SELECT niche, domain_type, label, count(*) AS rows, CAST(sum(positive_score) AS BIGINT) AS positive_score_sum, "
            f"CAST(sum(negative_score) AS BIGINT) AS negative_score_sum FROM ({scored_sql(inp, rs)}) "
            f"GROUP BY niche, domain_type, label")


ORACLE["collected_page_labels"] = collected_page_labels_sql()


# ----------------------------- operators on derived tables -------------------

_VERDICT = "['true', 'mostly-true', 'half-true', 'barely-true', 'false', 'pants-fire', 'unknown'][doc_id % 7 + 1]"
_SPLIT = "['train', 'valid', 'test'][doc_id % 3 + 1]"


def length_curve_sql() -> str:
    st = ("SELECT CAST(n_chars AS DOUBLE) AS score, count(*) FILTER (WHERE toxic = 1) AS pos_n, count(*) FILTER (WHERE toxic <> 1) AS neg_n "
          "FROM documents JOIN labels USING (doc_id) WHERE n_chars IS NOT NULL GROUP BY n_chars")
    return (f"SELECT *, sum(pos_n) OVER (ORDER BY score DESC) AS cp, sum(neg_n) OVER (ORDER BY score DESC) AS cn, "
            f"sum(pos_n) OVER () AS P, sum(neg_n) OVER () AS N FROM ({st})")


ORACLE["statement_round_trip"] = (
    f"SELECT CAST(doc_id AS VARCHAR) AS id, {_VERDICT} AS label, nullif({clean_text_sql('text')}, '') AS statement, lang AS subject, "
    f"source AS speaker, CAST(NULL AS VARCHAR) AS job_title, CAST(n_chars AS DOUBLE) AS false_count, {_SPLIT} AS split FROM documents")
ORACLE["verdict_binary"] = (
    f"SELECT * FROM (SELECT doc_id, {_VERDICT} AS label, CAST(CASE WHEN doc_id % 7 < 3 THEN 0 WHEN doc_id % 7 < 6 THEN 1 END AS INTEGER) "
    f"AS label_binary FROM documents) WHERE label_binary IS NOT NULL")
ORACLE["given_split"] = "SELECT doc_id, ['train', 'validation', 'test'][doc_id % 3 + 1] AS split FROM documents"
ORACLE["drop_null_rows"] = ("SELECT doc_id, source, CASE WHEN doc_id % 3 <> 0 THEN lang END AS lang FROM documents "
                            "WHERE doc_id % 5 <> 0 AND source IS NOT NULL")
ORACLE["label_codes"] = ("SELECT doc_id, lang AS label, CAST(CASE WHEN lang IS NOT NULL THEN dense_rank() OVER (ORDER BY lang NULLS LAST) - 1 END AS DOUBLE) "
                         "AS code, lang AS decoded FROM documents")
ORACLE["fold_stats"] = (
    "SELECT model, round(avg(f1), 6) AS cv_mean, round(stddev_pop(f1), 6) AS cv_std FROM (SELECT source AS model, doc_id % 5 AS fold, "
    "avg(n_chars % 1000) / 1000 AS f1 FROM documents GROUP BY 1, 2) GROUP BY model")
ORACLE["model_selection"] = (
    "SELECT niche, model, cv_mean FROM (SELECT *, row_number() OVER (PARTITION BY niche ORDER BY cv_mean DESC, k) AS r FROM ("
    "SELECT lang AS niche, doc_id % 4 AS k, 'm' || CAST(doc_id % 4 AS VARCHAR) AS model, floor(avg(n_chars % 100) / 10) / 10 AS cv_mean "
    "FROM documents GROUP BY lang, doc_id % 4)) WHERE r = 1")
_COEFS = f"WITH {tfidf_ctes()}, c AS (SELECT term, CAST((cf * 31 + df * 17) % 1001 - 500 AS DOUBLE) / 500 AS coef FROM vocab)"
ORACLE["top_terms_given"] = (
    f"{_COEFS} SELECT side, CAST(row_number() OVER (PARTITION BY side ORDER BY abs(coef) DESC, term) AS INTEGER) AS rank, term, round(coef, 6) AS coef "
    f"FROM ((SELECT 'class_1' AS side, term, coef FROM c ORDER BY coef DESC, term LIMIT 20) "
    f"UNION ALL (SELECT 'class_0', term, coef FROM c ORDER BY coef, term LIMIT 20))")
ORACLE["features_store"] = (f"SELECT split, count(*) AS n, count(DISTINCT term) AS terms, round(sum(weight), 3) AS weight "
                            f"FROM ({split_features_sql()}) GROUP BY split")
_SUMMARY = ("SELECT lang AS niche, round(avg(n_chars % 100) / 100, 6) AS macro_f1, CAST(0.5 AS DOUBLE) AS accuracy, "
            "count(*) FILTER (WHERE quality = 1) AS positive, count(*) FILTER (WHERE quality = 0) AS negative "
            "FROM documents JOIN labels USING (doc_id) GROUP BY lang")
ORACLE["results_table"] = (
    f"SELECT niche, macro_f1, accuracy, positive, negative, positive + negative AS total FROM ({_SUMMARY}) UNION ALL "
    f"SELECT 'TOTAL', NULL, NULL, CAST(sum(positive) AS BIGINT), CAST(sum(negative) AS BIGINT), CAST(sum(positive + negative) AS BIGINT) FROM ({_SUMMARY})")
_EMPTY = (f"CASE doc_id % 10 WHEN 0 THEN true WHEN 1 THEN true ELSE len({tokenize_sql(clean_text_sql('text'))}) = 0 END")
ORACLE["score_empty_texts"] = (
    f"SELECT doc_id, CASE WHEN e THEN 'Unknown' END AS prediction, CASE WHEN e THEN CAST(0 AS DOUBLE) END AS confidence, "
    f"CASE WHEN e THEN CAST(0.5 AS DOUBLE) END AS prob_0, CASE WHEN e THEN CAST(0.5 AS DOUBLE) END AS prob_1, "
    f"CASE WHEN e THEN 'Empty text after preprocessing' END AS error FROM (SELECT doc_id, {_EMPTY} AS e FROM documents)")
ORACLE["eval_report_by_language"] = (
    f"WITH p AS (SELECT p.*, d.lang FROM ({rule_pred_sql()}) p JOIN documents d USING (doc_id)), "
    f"c AS (SELECT lang, actual AS class FROM p UNION SELECT lang, predicted FROM p), "
    f"x AS (SELECT c.lang, c.class, count(*) FILTER (WHERE actual = class AND predicted = class) AS tp, "
    f"count(*) FILTER (WHERE predicted = class) AS pre, count(*) FILTER (WHERE actual = class) AS support FROM c JOIN p USING (lang) GROUP BY 1, 2), "
    f"y AS (SELECT lang, class, support, CASE WHEN pre = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / pre END AS p, "
    f"CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / support END AS r FROM x) "
    f"SELECT lang, class, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END, 6) AS f1, support FROM y")
ORACLE["eval_length_roc_curve"] = (
    f"SELECT 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL "
    f"SELECT score, round(CAST(cn AS DOUBLE) / N, 6), round(CAST(cp AS DOUBLE) / P, 6) FROM ({length_curve_sql()})")
ORACLE["eval_length_summary"] = (
    f"SELECT round(sum(CAST(neg_n AS DOUBLE) * (2 * (cp - pos_n) + pos_n) / 2.0) / (CAST(max(P) AS DOUBLE) * max(N)), 6) AS roc_auc, "
    f"round(sum(CAST(pos_n AS DOUBLE) / P * CAST(cp AS DOUBLE) / (cp + cn)), 6) AS average_precision FROM ({length_curve_sql()})")


# ----------------------------- many phrases, models, feeds --------------------

def _phrase_list_sql(k: int) -> str:
    return (f"(SELECT list(p ORDER BY p) FROM (SELECT DISTINCT array_to_string(w[i:i + n - 1], ' ') AS p FROM "
            f"(SELECT w, n, unnest(range(1, greatest(len(w) - n + 1, 1) + 1)) AS i FROM "
            f"(SELECT string_split(lower(coalesce(text, '')), ' ') AS w, unnest([1, 2, 3]) AS n FROM benchmark WHERE item_id % 2 = {k}))) WHERE p <> '')")


_PHRASE_INPUT = doc_input_sql()
ORACLE["phrase_index_labels"] = (
    f"WITH l AS (SELECT {_phrase_list_sql(0)} AS pos, {_phrase_list_sql(1)} AS neg), "
    f"h AS (SELECT doc_id, source, domain_type, contains(lower(coalesce(source, '')), 'src1') AS pd, contains(lower(coalesce(source, '')), 'src2') AS nd, "
    f"list_filter(l.pos, lambda p: contains(lower(coalesce(text, '')), p)) AS ph, list_filter(l.neg, lambda p: contains(lower(coalesce(text, '')), p)) AS nh "
    f"FROM ({_PHRASE_INPUT}), l), "
    f"s AS (SELECT *, CAST((CASE WHEN pd THEN 2 ELSE 0 END) + len(ph) AS INTEGER) AS positive_score, CAST((CASE WHEN nd THEN 2 ELSE 0 END) + len(nh) AS INTEGER) AS negative_score FROM h) "
    f"SELECT doc_id, CASE WHEN positive_score > negative_score THEN 'even' WHEN negative_score > positive_score THEN 'odd' WHEN domain_type = 'positive' THEN 'even' "
    f"WHEN domain_type = 'negative' THEN 'odd' ELSE 'unlabeled' END AS label, positive_score, negative_score, "
    f"md5(concat_ws('|', CASE WHEN pd THEN 'positive_domain:' || source END, CASE WHEN nd THEN 'negative_domain:' || source END, "
    f"CASE WHEN len(ph) > 0 THEN 'positive_phrases:' || array_to_string(ph, ',') END, CASE WHEN len(nh) > 0 THEN 'negative_phrases:' || array_to_string(nh, ',') END, "
    f"CASE WHEN positive_score = negative_score THEN (CASE domain_type WHEN 'positive' THEN 'domain_type_fallback:positive' "
    f"WHEN 'negative' THEN 'domain_type_fallback:negative' ELSE 'no_heuristics_match' END) END)) AS evidence FROM s")

_GIVEN = (f"WITH {tfidf_ctes()}, c AS (SELECT term, idx, df, cf FROM vocab), "
          f"x AS (SELECT w.doc_id, w.w, CASE w.doc_id % 3 WHEN 0 THEN CAST((cf * 31 + df * 17) % 1001 - 500 AS DOUBLE) / 500 "
          f"ELSE CAST((cf * 13 + df * 7) % 1001 - 500 AS DOUBLE) / 500 END AS coef FROM w JOIN c USING (term) WHERE @where), "
          f"m AS (SELECT doc_id, sum(w * coef) / sqrt(sum(w * w)) AS m FROM x GROUP BY doc_id), "
          f"d AS (SELECT doc_id, ['first', 'second', 'other'][doc_id % 3 + 1] AS niche, len({tokenize_sql(clean_text_sql('text'))}) = 0 AS empty FROM documents)")
ORACLE["score_niches"] = (
    _GIVEN.replace("@where", "w.doc_id % 3 = 1 OR (w.doc_id % 3 = 0 AND c.idx % 2 = 0)")
    + ", r AS (SELECT d.*, (CASE niche WHEN 'first' THEN 0.1::DOUBLE ELSE -0.2::DOUBLE END) + coalesce(m, 0) AS m FROM d LEFT JOIN m USING (doc_id)), "
    "p AS (SELECT *, 1 / (1 + exp(-m)) AS p FROM r) "
    "SELECT doc_id, niche, CASE WHEN niche = 'other' OR empty THEN 'Unknown' WHEN niche = 'first' THEN (CASE WHEN m > 0 THEN 'yes' ELSE 'no' END) "
    "WHEN m > 0 THEN 'good' ELSE 'bad' END AS prediction, round(CASE WHEN niche = 'other' OR empty THEN CAST(0 AS DOUBLE) ELSE greatest(p, 1 - p) END, 6) AS confidence, "
    "round(CASE WHEN niche = 'other' THEN NULL WHEN empty THEN CAST(0.5 AS DOUBLE) ELSE p END, 6) AS positive, "
    "CASE WHEN niche = 'other' THEN 'no trained model for niche other' WHEN empty THEN 'Empty text after preprocessing' END AS error FROM p")
ORACLE["score_file_summary"] = (
    f"WITH {tfidf_ctes()}, x AS (SELECT w.doc_id, w.w, CAST((cf * 13 + df * 7) % 1001 - 500 AS DOUBLE) / 500 AS coef FROM w JOIN vocab USING (term)), "
    f"m AS (SELECT doc_id, sum(w * coef) / sqrt(sum(w * w)) AS m FROM x GROUP BY doc_id), "
    f"d AS (SELECT doc_id, len({tokenize_sql(clean_text_sql('text'))}) = 0 AS empty FROM documents), "
    f"p AS (SELECT empty, 1 / (1 + exp(-(coalesce(m, 0) - 0.2))) AS p FROM d LEFT JOIN m USING (doc_id)), "
    f"r AS (SELECT CASE WHEN empty THEN 'Unknown' WHEN p > 0.5 THEN 'good' ELSE 'bad' END AS prediction, CASE WHEN empty THEN CAST(0 AS DOUBLE) ELSE greatest(p, 1 - p) END AS c FROM p) "
    f"SELECT prediction, count(*) AS n, round(avg(c), 6) AS mean_confidence, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM r), 6) AS share FROM r GROUP BY prediction")
ORACLE["feed_documents"] = (
    f"WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS t, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS i FROM documents), "
    f"e AS (SELECT doc_id, i, {clean_text_sql('t')} AS t, CASE WHEN i % 5 <> 0 THEN TIMESTAMP '2024-06-01 00:00:00' - to_days(CAST((i * 37) % 730 AS INTEGER)) END AS published "
    f"FROM l WHERE doc_id % 7 <> 0 AND i < 100) "
    f"SELECT doc_id AS feed, CAST(i AS INTEGER) AS entry_pos, 't' || CAST(i AS VARCHAR) AS title, 'https://h.org/' || CAST(doc_id AS VARCHAR) || '/' || CAST(i AS VARCHAR) AS link, "
    f"published, substring(t, 1, 200) AS summary FROM e WHERE published IS NULL OR published >= TIMESTAMP '2023-06-02 00:00:00'")
