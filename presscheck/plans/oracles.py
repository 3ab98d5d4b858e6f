"""DuckDB SQL for the registered queries, written apart from the Spark code.

RE2 has no lookaround and DuckDB neither decodes entities nor normalises, so the
e-mail pattern keeps the character before the address and the few entities of the
tables are replaced one by one. NFKC changes none of the tables. Messages, names and
patterns are fixed values of the contract.
"""

from __future__ import annotations


def _clean(text: str) -> str:
    c = f"regexp_replace({text}, '<[^>]+>', ' ', 'g')"
    c = rf"regexp_replace({c}, '(?i)https?://\S+|www\.\S+', ' ', 'g')"
    c = (
        rf"regexp_replace({c}, '(^|[^\pL\pN_.+-])[\pL\pN_][\pL\pN_.+-]*@[\pL\pN_.-]+\.[A-Za-z]{{2,}}',"
        r" '\1 ', 'g')"
    )
    c = rf"regexp_replace({c}, '(?i)^\s*(?:REUTERS|AP|AFP)\s*[-–—:]\s*', ' ')"
    c = rf"regexp_replace({c}, '(?is)\b(?:reporting by|additional reporting by|editing by)\b.*$', ' ')"
    c = rf"regexp_replace({c}, '[\x00-\x1f\x7f]', ' ', 'g')"
    return rf"trim(regexp_replace(lower({c}), '\s+', ' ', 'g'))"


def _strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def _join(headline: str, article: str) -> str:
    return f"concat_ws(' ', nullif({_strip(headline)}, ''), nullif({_strip(article)}, ''))"


def _decode_page(text: str) -> str:
    # The semicolon of these names is optional. The ampersand comes last, as one
    # pass decodes "&amp;copy;" to "&copy;" and no further.
    for entity, character in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{entity};?', '{character}', 'g')"
    return text


_TITLE = "regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"
_PAGE = _clean(_decode_page(_join(_TITLE, "html")))
_WORDS = "CASE WHEN clean_text = '' THEN 0 ELSE len(string_split(clean_text, ' ')) END"
_SHORT = (
    "'News contains only ' || word_count || ' words. Please enter at least 20 words. "
    "A complete article is recommended.'"
)
_CODE = "CASE WHEN too_long THEN 422 WHEN word_count < 20 THEN 400 END"
_REASON = (
    "CASE WHEN too_long THEN 'String should have at most 100000 characters' "
    f"WHEN clean_text = '' THEN 'News text cannot be empty.' WHEN word_count < 20 THEN {_SHORT} END"
)
_ACCEPTED = "NOT too_long AND word_count >= 20"


def _counted(keys: str, article: str, text: str, table: str) -> str:
    """Common tables ``cleaned`` and ``counted``: key, clean_text, too_long, word_count."""
    return (
        f"WITH cleaned AS (SELECT {keys}, {text} AS clean_text, length({article}) > 100000 AS too_long "
        f"FROM {table}), counted AS (SELECT *, ({_WORDS})::INT AS word_count FROM cleaned) "
    )


_DOCUMENTS = _counted("doc_id", "text", _clean("text"), "documents")
_TURNS = _counted("conv_id, turn", "text", _clean("text"), "conversations")
_PAGES = _counted("page_id", "html", _PAGE, "pages")


def _vocabulary(name: str, texts: str, key: str) -> str:
    """Common tables for the terms of ``texts``: counts and vocabulary."""
    return (
        rf"{name}_tokens AS (SELECT {key}, unnest(regexp_extract_all(clean_text, '[\pL\pN_]{{2,}}')) AS term FROM {texts}), "
        f"{name}_counts AS (SELECT {key}, term, count(*) AS tf FROM {name}_tokens GROUP BY ALL), "
        f"{name}_vocabulary AS (SELECT term, count(*) AS df, "
        f"ln((1.0 + (SELECT count(*) FROM {texts})) / (1.0 + count(*))) + 1.0 AS idf "
        f"FROM {name}_counts GROUP BY term HAVING count(*) >= 2), "
        f"{name}_index AS (SELECT row_number() OVER (ORDER BY term) - 1 AS index, term FROM {name}_vocabulary)"
    )


_DOC_TERMS = f"{_DOCUMENTS}, {_vocabulary('doc', 'cleaned', 'doc_id')}"
_WEIGHTS = (
    ", weighed AS (SELECT doc_id, term, tf * idf AS raw, "
    "sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)) AS norm "
    "FROM doc_counts JOIN doc_vocabulary USING (term)) "
)

# Verdicts of a whole run of the two scorers that count.
_LOGITS = r"""(word_count % 7) / 2.0::DOUBLE AS a0,
  (len(regexp_extract_all(clean_text, '[\pL\pN_]{2,}')) % 5) / 2.0::DOUBLE AS a1"""
_FIRST_WORDS = "string_split(clean_text, ' ')[1:256]"


def _run(keys: str, condition: str) -> str:
    """Common tables ``pairs`` to ``cards`` over the accepted rows of ``counted``."""
    return f"""
, logits AS (
  SELECT {keys}, word_count, {_LOGITS}, (len({_FIRST_WORDS}) % 5)::DOUBLE AS b0,
    (length(array_to_string({_FIRST_WORDS}, ' ')) % 7)::DOUBLE AS b1,
    length(array_to_string({_FIRST_WORDS}, ' ')) % 11 <> 0 AS usable FROM counted WHERE {condition}),
pairs AS (
  SELECT *, CASE WHEN a0 > a1 THEN 0 ELSE 1 END AS a_label, CASE WHEN NOT usable OR b0 > b1 THEN 0 ELSE 1 END AS b_label,
    1 / (1 + exp(-abs(a0 - a1))) AS a_conf,
    CASE WHEN usable THEN 1 / (1 + exp(-abs(b0 - b1))) ELSE 0.5 END AS b_conf FROM logits),
sided AS (
  SELECT *, a_label = b_label AS agreement, b_conf >= a_conf AS b_wins,
         1 - a_conf AS a_rest, 1 - b_conf AS b_rest FROM pairs),
{_DECIDED}"""


_DECIDED = """decided AS (
  SELECT *, CASE WHEN agreement OR NOT b_wins THEN a_label ELSE b_label END AS label,
         CASE WHEN agreement THEN (a_conf + b_conf) / 2 WHEN b_wins THEN b_conf ELSE a_conf END AS confidence,
         CASE WHEN agreement THEN 'Random Forest + BERT' WHEN b_wins THEN 'BERT' ELSE 'Random Forest' END AS selected_model,
         CASE WHEN agreement THEN 'Both models agree'
              ELSE 'Models disagree - higher-confidence prediction selected' END AS decision_method
  FROM sided),
models AS (
  SELECT *, 0 AS position, 'Random Forest' AS model, a_label AS own_label, a_conf AS own_confidence, a_rest AS rest FROM decided
  UNION ALL
  SELECT *, 1, 'BERT', b_label, b_conf, b_rest FROM decided),
cards AS (
  SELECT * EXCLUDE (label, confidence), own_label AS label, CASE WHEN own_label = 0 THEN 'Fake' ELSE 'Real' END AS prediction,
         own_confidence AS confidence,
         CASE WHEN own_label = 0 THEN own_confidence ELSE rest END AS fake_probability,
         CASE WHEN own_label = 0 THEN rest ELSE own_confidence END AS real_probability
  FROM models)
"""
_RUN = _DOCUMENTS + _run("doc_id", "NOT too_long AND word_count >= 20")

# Verdicts on derived scores.
_DERIVED = """
WITH pairs AS (
  SELECT doc_id, n_chars::INT AS word_count, (doc_id % 2)::INT AS a_label,
         ((doc_id // 2) % 2)::INT AS b_label,
         (doc_id * 37 % 501 + 500) / 1000.0::DOUBLE AS a_conf,
         CASE WHEN doc_id % 5 = 0 THEN (doc_id * 37 % 501 + 500) / 1000.0::DOUBLE
              ELSE (doc_id * 91 % 501 + 500) / 1000.0::DOUBLE END AS b_conf
  FROM documents),
sided AS (
  SELECT *, a_label = b_label AS agreement, b_conf >= a_conf AS b_wins,
         round(1 - a_conf, 3) AS a_rest, round(1 - b_conf, 3) AS b_rest FROM pairs),
decided AS (
  SELECT *, CASE WHEN agreement OR NOT b_wins THEN a_label ELSE b_label END AS label,
         CASE WHEN agreement THEN (a_conf + b_conf) / 2 WHEN b_wins THEN b_conf ELSE a_conf END AS confidence,
         CASE WHEN agreement THEN 'Random Forest + BERT' WHEN b_wins THEN 'BERT' ELSE 'Random Forest' END AS selected_model,
         CASE WHEN agreement THEN 'Both models agree'
              ELSE 'Models disagree - higher-confidence prediction selected' END AS decision_method
  FROM sided),
models AS (
  SELECT doc_id, 0 AS position, 'Random Forest' AS model, a_label AS label, a_conf AS confidence, a_rest AS rest FROM decided
  UNION ALL
  SELECT doc_id, 1, 'BERT', b_label, b_conf, b_rest FROM decided),
cards AS (
  SELECT doc_id, position, model, label, CASE WHEN label = 0 THEN 'Fake' ELSE 'Real' END AS prediction, confidence,
         CASE WHEN label = 0 THEN confidence ELSE rest END AS fake_probability,
         CASE WHEN label = 0 THEN rest ELSE confidence END AS real_probability
  FROM models)
"""
# Softmax over ``logits`` with the fallback for unusable rows.
_ANSWERS = """
  , answers AS (
    SELECT doc_id, CASE WHEN NOT usable OR z0 > z1 THEN 0 ELSE 1 END AS label,
      CASE WHEN usable THEN 1 / (1 + exp(z1 - z0)) ELSE 0.5 END AS p0,
      CASE WHEN usable THEN 1 / (1 + exp(z0 - z1)) ELSE 0.5 END AS p1 FROM logits)
  SELECT doc_id, 'BERT' AS model, label, CASE WHEN label = 0 THEN 'Fake' ELSE 'Real' END AS prediction,
    round(greatest(p0, p1), 9) AS confidence, round(p0, 9) AS fake_probability,
    round(p1, 9) AS real_probability FROM answers"""
_NAME = "CASE WHEN label = 0 THEN 'Fake' ELSE 'Real' END"


def _percent(value: str) -> str:
    return f"printf('%.2f%%', round({value} * 100, 2))"


def _duration(thousandths: str) -> str:
    # An exact tie, an odd multiple of 1/8 second, is shown rounded up.
    tie = f"CASE WHEN ({thousandths}) % 250 = 125 THEN 1 ELSE 0 END"
    return (
        f"CASE WHEN {thousandths} < 1000 THEN ({thousandths}) || ' ms' "
        f"ELSE printf('%.2f s', ({thousandths} + {tie}) / 1000.0::DOUBLE) END"
    )


def _model_json(label: str, name: str, confidence: str, rest: str) -> str:
    verdict = f"CASE WHEN {label} = 0 THEN 'Fake' ELSE 'Real' END"
    fake = f"CASE WHEN {label} = 0 THEN {confidence} ELSE {rest} END"
    real = f"CASE WHEN {label} = 0 THEN {rest} ELSE {confidence} END"
    return (
        f"""'{{"model":"{name}","label":' || {label} || ',"prediction":"' || {verdict} || """
        f"""'","confidence":' || {confidence} || ',"fake_probability":' || {fake} || """
        f"""',"real_probability":' || {real} || '}}'"""
    )


_RAW_WORDS = r"len(list_filter(string_split_regex(role || ' ' || text, '\s+'), lambda w: w <> ''))"

_MALFORMED = "(doc_id % 7 = 0 OR (doc_id % 17 = 0 AND doc_id % 11 <> 0 AND doc_id % 13 <> 0))"
_NO_LANG = "(doc_id % 13 = 0 AND doc_id % 11 <> 0)"
_OVER = "length(text) > 1000"
_BODY = "repeat(text, 5)"
_BODY_OVER = "length(text) * 5 > 100000"

# Lines that cannot be read; some hold no key that can be.
_UNREAD = " OR ".join(f"doc_id % {n} = 0" for n in (7, 11, 13, 17, 19, 23))
_FILES = _counted(
    "doc_id, text", "text", _clean(_join("CASE WHEN doc_id % 29 = 0 THEN '' ELSE lang END", "text")), "documents"
)
_NO_KEY = "doc_id % 7 = 0 OR (doc_id % 11 <> 0 AND doc_id % 13 <> 0 AND doc_id % 17 <> 0 AND (doc_id % 19 = 0 OR doc_id % 23 = 0))"
_FILE_KEYS = f"""CASE WHEN NOT ({_NO_KEY}) THEN doc_id END AS id, CASE WHEN {_UNREAD} THEN doc_id END AS raw_id,
    CASE WHEN {_UNREAD} THEN 422 ELSE {_CODE} END AS code,
    CASE WHEN {_UNREAD} THEN 'Invalid request' ELSE {_REASON} END AS reason"""

ORACLES = {
    "clean_documents": f"{_DOCUMENTS} SELECT doc_id, clean_text, word_count FROM counted",
    "clean_pages": f"SELECT page_id, {_clean(_decode_page('html'))} AS clean_text FROM pages",
    "clean_conversations": f"SELECT conv_id, turn, {_clean('text')} AS clean_text FROM conversations",
    "page_articles": f"SELECT page_id, {_PAGE} AS clean_text FROM pages",
    "wire_documents": "SELECT doc_id, "
    + _clean("('REUTERS - ' || text || chr(10) || 'Reporting by A. Writer;' || chr(10) || 'Editing by B')")
    + " AS clean_text FROM documents",
    "escaped_documents": "SELECT doc_id, "
    + _clean("""('<p class="x">' || text || '</p> end.')""")
    + " AS clean_text FROM documents",
    "accepted_documents": f"{_DOCUMENTS} SELECT doc_id, word_count FROM counted WHERE {_ACCEPTED}",
    "rejected_documents": f"{_DOCUMENTS} SELECT doc_id, {_CODE} AS code, {_REASON} AS reason "
    f"FROM counted WHERE NOT ({_ACCEPTED})",
    "rejected_conversations": f"{_TURNS} SELECT conv_id, turn, {_CODE} AS code, {_REASON} AS reason "
    f"FROM counted WHERE NOT ({_ACCEPTED})",
    "oversized_documents": _counted(
        "doc_id, text", _BODY, _clean(_join("text", f"CASE WHEN {_BODY_OVER} THEN '' ELSE {_BODY} END")), "documents"
    )
    + f"""SELECT doc_id, CASE WHEN {_OVER} THEN 422 ELSE {_CODE} END AS code,
      CASE WHEN {_OVER} AND too_long
             THEN 'String should have at most 1000 characters, String should have at most 100000 characters'
           WHEN {_OVER} THEN 'String should have at most 1000 characters' ELSE {_REASON} END AS reason FROM counted""",
    "raw_precheck_conversations": f"""
      WITH counted AS (SELECT conv_id, turn, {_RAW_WORDS} AS n FROM conversations)
      SELECT conv_id, turn, CASE WHEN n = 0 THEN 'Please enter a news article.'
        WHEN n < 20 THEN 'Please enter at least 20 words. Current input contains ' || n || ' words.' END AS message,
        n || CASE WHEN n = 1 THEN ' word' ELSE ' words' END AS label FROM counted""",
    "error_messages": """
      SELECT conv_id, turn, CASE WHEN role = 'system' THEN role WHEN turn % 3 = 0 THEN 'Prediction failed.'
        WHEN turn % 2 = 0 THEN 'Invalid request, ' || role ELSE role || ', ' || role END AS message
      FROM conversations""",
    "request_bodies": _counted(
        "doc_id, text, lang", "text", _clean(_join(f"CASE WHEN {_NO_LANG} THEN '' ELSE lang END", "text")), "documents"
    )
    + f"""SELECT doc_id, {_MALFORMED} AS malformed,
        CASE WHEN {_MALFORMED} OR {_NO_LANG} THEN '' ELSE lang END AS headline,
        (CASE WHEN {_MALFORMED} THEN 0 ELSE length(text) END)::INT AS article_chars,
        CASE WHEN {_MALFORMED} THEN 422 ELSE {_CODE} END AS code,
        CASE WHEN {_MALFORMED} THEN 'Invalid request' ELSE {_REASON} END AS reason FROM counted""",
    "request_files": f"""{_FILES} SELECT {_FILE_KEYS}, ({_UNREAD}) AS malformed,
        (CASE WHEN {_UNREAD} THEN 0 ELSE length(text) END)::INT AS article_chars FROM counted""",
    "request_stream": f"""{_FILES} SELECT {_FILE_KEYS},
        CASE WHEN NOT ({_UNREAD}) AND {_ACCEPTED} THEN 'scored' ELSE 'rejected' END AS outcome,
        CASE WHEN NOT ({_UNREAD}) AND {_ACCEPTED} THEN word_count END AS word_count FROM counted""",
    "document_vocabulary": f"{_DOC_TERMS} SELECT term, df, round(idf, 6) AS idf FROM doc_vocabulary",
    "tfidf_documents": f"{_DOC_TERMS}{_WEIGHTS} SELECT doc_id, term, round(raw / norm, 6) AS weight FROM weighed",
    "indexed_terms": f"{_DOC_TERMS} SELECT index, term FROM doc_index",
    "aligned_documents": f"{_DOC_TERMS}{_WEIGHTS} SELECT doc_id, index, round(raw / norm, 6) AS weight "
    "FROM weighed JOIN doc_index USING (term)",
    "feature_mismatches": f"{_DOC_TERMS}, pages_cleaned AS (SELECT page_id, {_PAGE} AS clean_text FROM pages), "
    + _vocabulary("page", "pages_cleaned", "page_id")
    + " SELECT index, d.term AS saved_term, p.term AS current_term FROM doc_index d "
    "FULL JOIN page_index p USING (index) WHERE d.term IS DISTINCT FROM p.term",
    "planted_forest": f"""{_DOC_TERMS}, planted AS (
        SELECT term FROM doc_vocabulary, (SELECT count(*) AS n FROM documents)
        WHERE 4 * df BETWEEN n AND 3 * n ORDER BY abs(2 * df - n), term LIMIT 1),
      has AS (SELECT doc_id FROM doc_counts JOIN planted USING (term))
      SELECT doc_id, (has.doc_id IS NOT NULL)::INT AS label, (has.doc_id IS NULL)::INT::DOUBLE AS fake_probability,
        (has.doc_id IS NOT NULL)::INT::DOUBLE AS real_probability
      FROM documents LEFT JOIN has USING (doc_id)""",
    "scorer_b_postprocess": f"""
      WITH logits AS (
        SELECT doc_id, (doc_id * 37 % 2001 - 1000) / 250.0::DOUBLE AS z0,
          CASE WHEN doc_id % 10 = 0 THEN (doc_id * 37 % 2001 - 1000) / 250.0::DOUBLE
               ELSE (doc_id * 91 % 2001 - 1000) / 250.0::DOUBLE END AS z1,
          doc_id % 11 <> 0 AND doc_id % 13 <> 0 AS usable FROM documents) {_ANSWERS}""",
    "batch_model_scores": f"""{_DOCUMENTS}, logits AS (
        SELECT doc_id, (word_count % 7)::DOUBLE AS z0, (word_count % 5)::DOUBLE AS z1,
          word_count % 11 <> 0 AS usable FROM counted WHERE {_ACCEPTED}) {_ANSWERS}""",
    "forest_features": _DOCUMENTS.replace(
        "FROM documents)", "FROM documents JOIN labels USING (doc_id) WHERE quality IN (0, 1))"
    )
    + f", accepted AS (SELECT * FROM counted WHERE {_ACCEPTED}), "
    + _vocabulary("doc", "accepted", "doc_id")
    + f"{_WEIGHTS} SELECT doc_id, index, round(raw / norm, 6) AS weight FROM weighed JOIN doc_index USING (term)",
    "decide_documents": f"{_RUN} SELECT doc_id, label, {_NAME} AS prediction, round(confidence, 9) AS confidence, "
    "agreement, selected_model, decision_method FROM decided",
    "scored_once": f"{_RUN} SELECT doc_id, label, {_NAME} AS prediction, round(confidence, 9) AS confidence, "
    "agreement, selected_model, decision_method FROM decided",
    "verdict_quality": f"""{_RUN}, said AS (
        SELECT model, doc_id, label AS predicted FROM cards UNION ALL SELECT 'final', doc_id, label FROM decided),
      sums AS (
        SELECT model, count(*) AS n, count(*) FILTER (WHERE predicted = quality) AS ok,
          count(*) FILTER (WHERE predicted = 0 AND quality = 0) AS hit, count(*) FILTER (WHERE predicted = 0) AS said,
          count(*) FILTER (WHERE quality = 0) AS was
        FROM said JOIN labels USING (doc_id) WHERE quality IN (0, 1) GROUP BY model)
      SELECT model, n, round(ok / n, 9) AS accuracy, round(hit / said, 9) AS fake_precision,
        round(hit / was, 9) AS fake_recall, round(2 * hit / (said + was), 9) AS fake_f1 FROM sums""",
    "edge_articles": """SELECT conv_id, turn,
        CASE turn % 5 WHEN 0 THEN 'five 1⁄2 ful' WHEN 4 THEN 'one two' WHEN 3 THEN NULL ELSE '' END AS start,
        CASE turn % 5 WHEN 0 THEN 23 + len(list_filter(string_split(cleaned, ' '), lambda w: w <> ''))
          WHEN 4 THEN 2 WHEN 3 THEN NULL ELSE 0 END AS word_count,
        CASE turn % 5 WHEN 0 THEN NULL WHEN 3 THEN 422 ELSE 400 END AS code,
        CASE turn % 5 WHEN 0 THEN NULL WHEN 3 THEN 'String should have at most 100000 characters'
          WHEN 4 THEN 'News contains only 2 words. Please enter at least 20 words. A complete article is recommended.'
          ELSE 'News text cannot be empty.' END AS reason
      FROM (SELECT conv_id, turn, """
    + _clean("text")
    + """ AS cleaned FROM conversations)""",
    "edge_prechecks": """SELECT conv_id, turn,
        CASE turn % 3 WHEN 0 THEN 'Please enter a news article.'
          WHEN 1 THEN 'Please enter at least 20 words. Current input contains 1 words.' END AS message,
        CASE turn % 3 WHEN 0 THEN '0 words' WHEN 1 THEN '1 word' ELSE '25 words' END AS label FROM conversations""",
    "response_flat": f"{_RUN} SELECT doc_id, position, model, label, prediction, round(confidence, 9) AS confidence, "
    "round(fake_probability, 9) AS fake_probability, round(real_probability, 9) AS real_probability FROM cards",
    "response_json": f"""{_DERIVED} SELECT doc_id, '{{"input":{{"word_count":' || word_count || '}},"models":[' ||
      {_model_json('a_label', 'Random Forest', 'a_conf', 'a_rest')} || ',' ||
      {_model_json('b_label', 'BERT', 'b_conf', 'b_rest')} || '],"final":{{"label":' || label ||
      ',"prediction":"' || {_NAME} || '","confidence":' || confidence || ',"agreement":' || agreement ||
      ',"selected_model":"' || selected_model || '","decision_method":"' || decision_method || '"}}}}' AS response
      FROM decided""",
    "report_columns": f"""{_RUN} SELECT doc_id, upper({_NAME}) AS verdict,
      CASE WHEN label = 1 THEN 'real-result' ELSE 'fake-result' END AS card_class,
      {_percent('confidence')} AS confidence_text, selected_model,
      CASE WHEN agreement THEN 'Yes' ELSE 'No' END AS agreement_text, decision_method, word_count,
      {_duration('doc_id * 7 % 2500')} AS time_text FROM decided""",
    "report_cards": f"""{_RUN} SELECT doc_id, position, lower(prediction) AS badge,
      {_percent('confidence')} AS confidence_text, {_percent('fake_probability')} AS fake_text,
      {_percent('real_probability')} AS real_text, {_duration('doc_id * 11 % 2500')} AS time_text,
      round(least(greatest(confidence * 100, 0), 100), 6) AS confidence_width,
      round(least(greatest(fake_probability * 100, 0), 100), 6) AS fake_width,
      round(least(greatest(real_probability * 100, 0), 100), 6) AS real_width FROM cards""",
    "contract_violations": f"""{_RUN}
      SELECT doc_id, false AS contract_ok FROM decided
      WHERE doc_id % 17 = 0 OR doc_id % 19 = 0 OR doc_id % 23 = 0 OR doc_id % 29 = 0 OR doc_id % 31 = 0""",
    "distinct_texts": rf"{_DOCUMENTS} SELECT doc_id, word_count, "
    r"len(regexp_extract_all(clean_text, '[\pL\pN_]{2,}'))::INT AS tokens FROM counted",
    "fallback_results": f"""{_TURNS}, logits AS (
        SELECT conv_id, turn, word_count, {_LOGITS} FROM counted WHERE {_ACCEPTED}),
      pairs AS (SELECT *, a0 > a1 AS agreement, 1 / (1 + exp(-abs(a0 - a1))) AS a_conf FROM logits)
      SELECT conv_id, turn, {_CODE} AS code, {_REASON} AS reason, NULL AS word_count, NULL AS label,
        NULL AS confidence, NULL AS agreement, NULL AS selected_model FROM counted WHERE NOT ({_ACCEPTED})
      UNION ALL
      SELECT conv_id, turn, NULL, NULL, word_count, CASE WHEN agreement OR a_conf <= 0.5 THEN 0 ELSE 1 END,
        round(CASE WHEN agreement THEN (a_conf + 0.5) / 2 ELSE a_conf END, 9), agreement,
        CASE WHEN agreement THEN 'Random Forest + BERT' WHEN a_conf <= 0.5 THEN 'BERT' ELSE 'Random Forest' END FROM pairs""",
    "run_metrics": f"""{_PAGES} SELECT count(*) AS rows_in, count(*) FILTER (WHERE NOT ({_ACCEPTED})) AS rows_rejected,
      count(*) FILTER (WHERE {_ACCEPTED}) AS rows_scored, 0::BIGINT AS contract_violations,
      count(*) FILTER (WHERE {_ACCEPTED}) AS rows_fallback FROM counted""",
    "stream_metrics": f"""{_DOCUMENTS} SELECT count(*) AS rows_in, count(*) FILTER (WHERE NOT ({_ACCEPTED})) AS rows_rejected,
      count(*) FILTER (WHERE {_ACCEPTED}) AS rows_scored, 0::BIGINT AS contract_violations,
      count(*) FILTER (WHERE {_ACCEPTED}) AS rows_fallback FROM counted""",
    "end_to_end_checks": f"{_DOCUMENTS} SELECT doc_id, word_count, true AS models_coherent, true AS forest_first, "
    f"true AS agreement_right, true AS label_right FROM counted WHERE {_ACCEPTED}",
    "stream_scores": f"""{_RUN} SELECT doc_id,
      CASE WHEN {_ACCEPTED} THEN 'scored' ELSE 'rejected' END AS outcome, {_CODE} AS code, {_REASON} AS reason,
      CASE WHEN {_ACCEPTED} THEN word_count END AS word_count, d.label, round(d.confidence, 9) AS confidence, d.selected_model
      FROM counted LEFT JOIN (SELECT doc_id, label, confidence, selected_model FROM decided) d USING (doc_id)""",
    "stream_scores_once": f"""{_RUN}, results AS (SELECT doc_id,
        CASE WHEN {_ACCEPTED} THEN 'scored' ELSE 'rejected' END AS outcome, {_CODE} AS code,
        CASE WHEN {_ACCEPTED} THEN word_count END AS word_count, d.label, round(d.confidence, 9) AS confidence, d.selected_model
        FROM counted LEFT JOIN (SELECT doc_id, label, confidence, selected_model FROM decided) d USING (doc_id))
      FROM results UNION ALL SELECT -1 - doc_id, * EXCLUDE (doc_id) FROM results""",
}
