"""DuckDB SQL of the queries in ``registry_tables``."""

from __future__ import annotations

import re

from daybook.oracle import CTE, DEPS, ORACLE, _focus_case, cte, register

_V = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate"
cte("late", f"SELECT {_V} FROM v2 WHERE year(o_orderdate) >= 2000", ["v2"])
_YEAR = "CAST(year(o_orderdate) AS INTEGER) AS order_year"
_RUN = [f"TIMESTAMP '2024-01-0{d} 01:00:00'" for d in (1, 2, 3)]

register("partition_upsert", f"""
SELECT {_V}, {_YEAR}, {_RUN[0]} AS created_at, {_RUN[0]} AS last_modified_at, 0 AS overwrite_count
FROM v1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM late)
UNION ALL
SELECT {_V}, {_YEAR}, CASE WHEN known THEN {_RUN[0]} ELSE {_RUN[1]} END, {_RUN[2]}, CASE WHEN known THEN 2 ELSE 1 END
FROM (SELECT *, o_orderkey IN (SELECT o_orderkey FROM v1) AS known FROM late)""", ["v1", "late"], ["o_totalprice"])

register("partition_recompute", f"""
SELECT {_V}, {_YEAR}, {_RUN[0]} AS created_at, {_RUN[0]} AS last_modified_at, 0 AS overwrite_count
FROM v1 WHERE year(o_orderdate) NOT IN (SELECT year(o_orderdate) FROM late)
UNION ALL
SELECT {_V}, {_YEAR}, CASE WHEN known THEN {_RUN[0]} ELSE {_RUN[1]} END, {_RUN[2]}, CASE WHEN known THEN 2 ELSE 1 END
FROM (SELECT *, o_orderkey IN (SELECT o_orderkey FROM v1) AS known FROM late)""", ["v1", "late"], ["o_totalprice"])

register("evolved_partitions", f"""
SELECT order_year, price_band, count(*) AS n FROM (
  SELECT {_YEAR}, CAST(NULL AS VARCHAR) AS price_band FROM v1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM late)
  UNION ALL
  SELECT {_YEAR}, CASE WHEN o_totalprice > 100000 THEN 'high' ELSE 'normal' END FROM late)
GROUP BY order_year, price_band""", ["v1", "late"])

register("point_lookup", """
SELECT id, day, score, rating FROM rating WHERE day = DATE '2024-01-20' AND id IN (7, 42, 99)""", ["rating"])
ORACLE["bucketed_change_set"] = ORACLE["change_set"]
register("footer_counts", f"""
SELECT {_YEAR}, o_orderstatus, count(*) AS n_rows FROM orders GROUP BY ALL""", [])
register("two_date_prune", """
SELECT o_custkey AS id, max(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS has_active_program,
  max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS has_completed_program,
  count(*) FILTER (WHERE o_orderstatus = 'O') AS active_program_count, count(*) AS total_programs
FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS modified FROM lineitem GROUP BY l_orderkey) l
  ON o.o_orderkey = l.l_orderkey
WHERE o_orderdate >= TIMESTAMP '2000-07-01 00:00:00' OR modified >= TIMESTAMP '2000-07-01 00:00:00'
GROUP BY o_custkey""", [])

# Nested comparison of every distinct raw label with every label
_THREE = r"lower(regexp_extract(text, '^\s*(\S+\s+\S+\s+\S+)', 1))"
cte("raw_labels", f"""
SELECT doc_id, f AS known, CASE doc_id % 4 WHEN 0 THEN f WHEN 1 THEN translate(f || ' and more', 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') WHEN 2 THEN left(f, 6)
                                   ELSE '?' || source END AS raw_label
FROM (SELECT doc_id, source, concat_ws(' ', lang, {_THREE}) AS f FROM documents)""")
cte("known_labels", """
SELECT known AS label, min(doc_id) AS pos, lower(left(known, 20)) AS cut FROM raw_labels GROUP BY known""", ["raw_labels"])
cte("label_of", """
SELECT raw_label, arg_min(label, CASE WHEN label = raw_label THEN -1 ELSE pos END) AS label
FROM (SELECT DISTINCT raw_label, lower(left(raw_label, 20)) AS rcut FROM raw_labels) r
JOIN known_labels k ON k.label = r.raw_label OR starts_with(k.cut, r.rcut) OR starts_with(r.rcut, k.cut)
GROUP BY raw_label""", ["raw_labels", "known_labels"])
register("label_table_normalise", """
SELECT r.doc_id, r.raw_label, COALESCE(l.label, 'Other') AS label
FROM raw_labels r LEFT JOIN label_of l ON r.raw_label = l.raw_label""", ["raw_labels", "label_of"])

_LEVELS = {"overall": [], "criterion": ["criterion"], "category": ["category"], "case": ["doc_id"], "route": ["source"],
           "user": ["lang"], "user_route": ["lang", "source"]}
_KEYS = {"criterion": "VARCHAR", "category": "VARCHAR", "doc_id": "BIGINT", "source": "VARCHAR", "lang": "VARCHAR"}
register("rate_levels", "\nUNION ALL\n".join(
    f"SELECT '{level}' AS level, "
    + ", ".join(f"{k} AS {k}" if k in by else f"CAST(NULL AS {t}) AS {k}" for k, t in _KEYS.items())
    + ", count(*) AS total, count(*) FILTER (WHERE passed) AS passed, count(DISTINCT doc_id) AS cases,"
      " CAST(count(*) FILTER (WHERE passed) AS DOUBLE) / count(*) AS pass_rate FROM verd"
    + (f" GROUP BY {', '.join(by)}" if by else "") for level, by in _LEVELS.items()), ["verd"], ["pass_rate"])
register("weak_criteria", """
SELECT CAST(row_number() OVER (ORDER BY rate, criterion) AS INTEGER) AS place, criterion, category, rate AS pass_rate
FROM (SELECT criterion, category, avg(CAST(passed AS INTEGER)) AS rate FROM verd GROUP BY criterion, category)
WHERE rate < 0.8""", ["verd"], ["pass_rate"])


_CHANGE = "(?i)\\b(?:went up|went down|rose|fell|increased|decreased|improved|dropped|up|down)\\b"
_NUM = "[0-9]+(?:\\.[0-9]+)?"
_FOUND = "list_distinct(regexp_extract_all(replace({t}, ',', ''), '[0-9]+(\\.[0-9]+)?'))"
_NAMES = "['Committed', 'Strong', 'Consistent', 'Building', 'Ready']"
register("message_checks", f"""
SELECT id, day, rating, changes, unpaired_changes, n_numbers, n_missing, labels_named, label_fits,
  unpaired_changes = 0 AND n_missing = 0 AND label_fits AS accurate
FROM (SELECT id, day, rating, CAST(len(told) AS INTEGER) AS changes,
        CAST(len(list_filter(told, lambda s: NOT regexp_matches(s, '{_CHANGE}[^0-9]*\\bfrom {_NUM}%? to {_NUM}'))) AS INTEGER) AS unpaired_changes,
        CAST(len(found) AS INTEGER) AS n_numbers,
        CAST(len(list_filter(found, lambda x: NOT list_contains(given, x))) AS INTEGER) AS n_missing,
        array_to_string(named, ',') AS labels_named, len(list_filter(named, lambda x: x IS DISTINCT FROM due)) = 0 AS label_fits
      FROM (SELECT id, day, rating,
              list_filter(regexp_split_to_array(sent, '[.!?]+(?:\\s+|$)'), lambda s: regexp_matches(s, '{_CHANGE}.*[0-9]')) AS told,
              {_FOUND.format(t='sent')} AS found, {_FOUND.format(t='facts')} AS given,
              list_filter({_NAMES}, lambda x: regexp_matches(sent, '\\b' || x || '\\b')) AS named,
              CASE WHEN percentage >= 81 THEN 'Committed' WHEN percentage >= 61 THEN 'Strong' WHEN percentage >= 41 THEN 'Consistent'
                   WHEN percentage >= 21 THEN 'Building' WHEN percentage >= 1 THEN 'Ready' END AS due
            FROM (SELECT res.id, res.day, res.rating, r.percentage,
                    concat_ws(' ', array_to_string(action_texts, ' '), opportunity_text) AS facts,
                    CASE (res.id + day(res.day)) % 5
                      WHEN 1 THEN regexp_replace(message_text, '([0-9])([0-9])', '\\2\\1', 'g')
                      WHEN 2 THEN regexp_replace(message_text, 'from [0-9.]+% to', 'to', 'g')
                      WHEN 3 THEN message_text || '. You are Strong today!'
                      WHEN 4 THEN message_text || '. Your rating is ' || res.rating || '.'
                      ELSE message_text END AS sent
                  FROM result res JOIN rating r ON res.id = r.id AND res.day = r.day)))""", ["result", "rating"])


# ---------------------------------------------------------------------------
# The CTEs that follow from history or focus, once for each replayed day
# ---------------------------------------------------------------------------
def _followers(roots: list[str]) -> list[str]:
    out = set(roots)
    while more := {n for n, deps in DEPS.items() if n not in out and out & set(deps)}:
        out |= more
    return [n for n in CTE if n in out]


_DAILY = [n for n in _followers(["focus", "hist"]) if n not in ("weekly",)]
_DAY = "(SELECT CAST(max(ts) AS DATE) - {back} FROM events)"


def _of_day(text: str, s: int) -> str:
    return re.sub(rf"\b(FROM|JOIN)(\s+)({'|'.join(_DAILY)})\b(?!\()", rf"\1\2\3_{s}", text)


for _s in (1, 2, 3):
    _d = _DAY.format(back=3 - _s)
    for _n in _DAILY:
        _body = _of_day(CTE[_n], _s)
        _deps = [f"{x}_{_s}" if x in _DAILY else x for x in DEPS[_n]]
        if _n == "focus":  # what events up to the end of the window say
            _body = f"""
SELECT id, list_sort(list(DISTINCT focus)) AS focus_list, array_to_string(list_sort(list(DISTINCT focus)), ',') AS user_focus
FROM (SELECT id, CASE k % 14 {_focus_case} END AS focus
      FROM evd WHERE event_type = 'signup' AND k % 2 = 1 AND CAST(ts AS DATE) < {_d} + 2)
WHERE focus IS NOT NULL GROUP BY id"""
        elif _n == "ctx":
            _body = f"SELECT * FROM ({_body}) WHERE day = {_d}"
        elif _n == "hist" and _s == 1:
            _body, _deps = f"SELECT * FROM hist WHERE message_date BETWEEN {_d} - 7 AND {_d} - 1", ["hist"]
        elif _n == "hist":
            _p = _s - 1
            _body = f"""
SELECT * FROM hist_{_p}
UNION ALL
SELECT id, category, message_date, positive_actions_used, opportunity_used FROM sent_{_p}"""
            _deps = [f"hist_{_p}", f"sent_{_p}"]
        cte(f"{_n}_{_s}", _body, _deps)
    cte(f"sent_{_s}", f"""
SELECT id, category, day AS message_date, COALESCE(list_sort(list(key) FILTER (WHERE is_action)), CAST([] AS VARCHAR[])) AS positive_actions_used,
  max(key) FILTER (WHERE NOT is_action) AS opportunity_used, max(rating) AS rating, max(message_text) AS message_text
FROM (SELECT t.id, t.day, t.key, t.category, TRUE AS is_action, r.rating, r.message_text
      FROM top_acts_{_s} t JOIN result_{_s} r ON t.id = r.id AND t.day = r.day
      UNION ALL
      SELECT id, day, opportunity_key, opportunity_category, FALSE, rating, message_text FROM result_{_s})
GROUP BY id, category, day""", [f"top_acts_{_s}", f"result_{_s}"])

_SQUEEZED = "trim(regexp_replace(message_text, '\\s+', ' ', 'g'))"
register("replay_3_days", "\nUNION ALL\n".join(f"""
SELECT id, category, message_date, array_to_string(positive_actions_used, ',') AS keys, opportunity_used, rating,
  CAST(length(message_text) AS INTEGER) AS character_count,
  CASE WHEN {_SQUEEZED} = '' THEN 0 ELSE CAST(len(string_split({_SQUEEZED}, ' ')) AS INTEGER) END AS word_count,
  CAST(message_date AS TIMESTAMP) + INTERVAL 25 HOUR AS created_at, 0 AS overwrite_count
FROM sent_{s}""" for s in (1, 2, 3)), ["sent_1", "sent_2", "sent_3"])
