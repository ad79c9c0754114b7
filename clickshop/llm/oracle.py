"""DuckDB SQL for the queries that SQL can express, written from the rules' text."""

from __future__ import annotations

from clickshop.llm import collocations, quality
from clickshop.llm.queries import CONTROL_TEXT, LISTED_HOSTS, URL_RULES

_SPACE = r"[\x20\x09-\x0D]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def quality_sql() -> str:
    stop = sorted({w for words in quality.STOP_WORDS.values() for w in words.split()})
    bounds = []
    for rule in quality.RULES:
        checks = []
        if rule.low is not None:
            checks.append(f"100 * {rule.part} < {rule.low} * {rule.whole}")
        if rule.high is not None:
            checks.append(f"100 * {rule.part} > {rule.high} * {rule.whole}")
        bounds.append(f"({rule.whole} >= {rule.least} AND ({' OR '.join(checks)}))")
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT row_id, doc_id, text,
    list_filter(string_split_regex(text, '{_SPACE}+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
    string_split_regex(lower(text), {_quoted(quality.PLAIN_END)}) AS plain
  FROM texts
), windows AS (
  SELECT row_id, i, array_to_string(words[i : i + 4], ' ') AS w
  FROM (SELECT row_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM cut)
), twice AS (
  SELECT row_id, i FROM windows
  WHERE (row_id, w) IN (SELECT (row_id, w) FROM windows GROUP BY row_id, w HAVING count(*) > 1)
), repeats AS (
  SELECT row_id, count(DISTINCT i + k) AS n
  FROM twice, (SELECT unnest(generate_series(0, 4)) AS k) GROUP BY row_id
), figures AS (
  SELECT doc_id,
    len(words)::BIGINT AS n_words,
    length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(list_filter(plain, lambda w: w IN ({', '.join(map(_quoted, stop))}))) AS n_stop_words,
    len(lines) AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '^{_SPACE}*[-*•]'))) AS n_bullet_lines,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…){_SPACE}*$'))) AS n_ellipsis_lines,
    coalesce(repeats.n, 0)::BIGINT AS n_repeat_words
  FROM cut LEFT JOIN repeats USING (row_id)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM figures
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR {' OR '.join(bounds)}) AS kept
FROM judged"""


def chat_sql() -> str:
    control = r"([<\[])(\\*)(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|<ROLE>>|</ROLE>>)"
    escaped = f"regexp_replace({{}}, {_quoted(control)}, '\\1\\\\\\2\\3', 'g')"
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL
  SELECT -1, 0, 'user', {_quoted(CONTROL_TEXT)}
  UNION ALL
  SELECT -1, 1, 'assistant', {_quoted(CONTROL_TEXT)}
), marked AS (
  SELECT *,
    length({escaped.format('text')}) + CASE role
      WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
      ELSE length({escaped.format('role')}) + 21 END AS chars
  FROM rows
), whole AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars)::BIGINT AS formatted_chars,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss
  FROM marked GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, formatted_chars
FROM whole"""


def url_sql() -> str:
    ordered = sorted(URL_RULES, key=lambda r: (-len(r.text), r.text))

    def fits(r) -> str:
        host, path = _quoted(r.host), _quoted(r.path)
        return (
            f"(host = {host} OR ends_with(host, '.' || {host})) AND starts_with(path, {path})"
        )

    rule = " ".join(f"WHEN {fits(r)} THEN {_quoted(r.text)}" for r in ordered)
    verdict = " ".join(f"WHEN {fits(r)} THEN {_quoted(r.verdict)}" for r in ordered)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH rests AS (
  SELECT page_id, url, CASE WHEN contains(url, '://')
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), cut AS (
  SELECT page_id, url,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), '{upper}', '{upper.lower()}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_replace(regexp_replace(
      regexp_extract(url, '^[^?#]*\\?([^#]*)', 1),
      '(^|&)(utm_[^=&]*|ref|fbclid|gclid|sessionid)=[^&]*', '', 'g'), '^&', '') AS query
  FROM rests
), named AS (
  SELECT *, CASE WHEN contains(url, '://') THEN
    regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\\.', '')
    || regexp_replace(path, '/+$', '')
    || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS page
  FROM cut
)
SELECT page_id, host, path,
  CASE {rule} END AS rule,
  CASE {verdict}
    WHEN page IN (SELECT page FROM named WHERE page IS NOT NULL
                  AND regexp_matches(host, {_quoted(LISTED_HOSTS)})) THEN 'block'
    ELSE 'allow' END AS verdict
FROM named"""


def phrase_sql() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), cut AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces
), parts AS (
  SELECT lang, size, unnest([words[i : i + size - 1] for i in range(1, len(words) - size + 2)]) AS part
  FROM cut, (SELECT unnest(generate_series(1, {collocations.LONGEST})) AS size)
  WHERE len(words) >= size
), counts AS (
  SELECT lang, size, array_to_string(part, ' ') AS phrase, any_value(part) AS words, count(*) AS f
  FROM parts GROUP BY lang, size, phrase
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT * FROM counts WHERE size >= 2 AND f >= {collocations.LEAST}
), kept AS (
  SELECT * FROM candidates AS c WHERE NOT EXISTS (
    SELECT 1 FROM candidates AS d
    WHERE d.lang = c.lang AND d.size > c.size AND 100 * d.f >= 100 * c.f
      AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT lang, phrase, f, size, words, unnest(generate_series(1, size - 1)) AS k FROM kept
), scored AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r, t.n,
    ((1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts AS c
  JOIN counts AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1 : c.k], ' ')
  JOIN counts AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.k + 1 :], ' ')
  JOIN totals AS t ON t.lang = c.lang
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {collocations.TOP}"""


def runs_sql() -> str:
    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c), 0, 0, 0, 0, 0, 0, 0]))"
    # CRC-32 with its reversed polynomial, a bit at a time.
    step = "xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))"
    return f"""
WITH given AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}+'), lambda w: w <> '') AS words,
    CASE WHEN doc_id IS NOT NULL THEN
      xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {bits}::BIGINT[]), lambda c, x: {step})) END AS h
  FROM documents
), drawn AS (
  SELECT *, len(words) AS n, (h // 10) % nullif(len(words), 0) AS a, h // 10 AS g FROM given
), texts AS (
  SELECT row_id, doc_id, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(generate_series(0, n - 1), lambda i: CASE WHEN i < a THEN words[i + 1]
      ELSE words[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END)
    ELSE words END AS words
  FROM drawn
), places AS (
  SELECT row_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i FROM texts
), pairs AS (
  SELECT x.row_id, y.i - x.i AS p, x.i FROM places AS x JOIN places AS y
  ON x.row_id = y.row_id AND x.word = y.word AND y.i > x.i
), stretches AS (
  SELECT row_id, p, min(i) AS start, count(*) + p AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY row_id, p ORDER BY i) AS island FROM pairs)
  GROUP BY row_id, p, island HAVING count(*) + p >= greatest(6, 4 * p)
), runs AS (
  SELECT row_id, start, length, min(p) AS period FROM stretches GROUP BY row_id, start, length
), covered AS (
  SELECT DISTINCT row_id, unnest(generate_series(start + period, start + length - 1)) AS i FROM runs
), listed AS (
  SELECT row_id, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY row_id
), best AS (
  SELECT r.* FROM runs AS r WHERE NOT EXISTS (
    SELECT 1 FROM runs AS o WHERE o.row_id = r.row_id AND (o.length * r.period > r.length * o.period
      OR o.length * r.period = r.length * o.period AND (o.start, o.period) < (r.start, r.period)))
), left_over AS (
  SELECT t.row_id, string_agg(p.word, ' ' ORDER BY p.i) AS kept
  FROM texts AS t JOIN places AS p USING (row_id)
  WHERE NOT EXISTS (SELECT 1 FROM covered AS c WHERE c.row_id = p.row_id AND c.i = p.i)
  GROUP BY t.row_id
)
SELECT t.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length,
  b.period::BIGINT AS period, ((1000 * b.length) // b.period)::BIGINT AS exponent_milli,
  sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(k.kept, '')) AS collapsed_sha256
FROM texts AS t LEFT JOIN listed AS l USING (row_id) LEFT JOIN best AS b USING (row_id)
LEFT JOIN left_over AS k USING (row_id)"""


def statements() -> dict[str, str]:
    return {
        "op13_periodic_runs": runs_sql(),
        "op11_collocations": phrase_sql(),
        "op3_quality_rules": quality_sql(),
        "op5_chat_format": chat_sql(),
        "op10_url_filter": url_sql(),
    }
