"""DuckDB SQL that gives the rows of the queries it can express."""

from __future__ import annotations

from stayscope.llm import hosts, quality

WORD_CHAR = r"[^\x20\x09-\x0D]"


def _broken(rule: quality.Threshold) -> str:
    part, whole = rule.part, rule.whole
    tests = []
    if rule.least is not None:
        tests.append(f"{part} < {rule.least}" if whole is None else f"100 * {part} < {rule.least} * {whole}")
    if rule.most is not None:
        tests.append(f"{part} > {rule.most}" if whole is None else f"100 * {part} > {rule.most} * {whole}")
    test = f"({' OR '.join(tests)})"
    test = test if whole is None else f"({whole} > 0 AND {test})"
    names = ", ".join(f"'{x}'" for x in rule.languages)
    return f"(coalesce(lang IN ({names}), false) AND {test})" if names else test


def measured_sql(source: str) -> str:
    """Common tables ``measured`` (one row per row of ``source``) with all measures."""
    stops = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))
    return f"""
numbered AS (SELECT *, row_number() OVER () AS rid, coalesce(text, '') AS body FROM {source}),
parts AS (
  SELECT *, [w for w in regexp_split_to_array(body, '[\\x20\\x09-\\x0D]+') if w <> ''] AS words,
    [l for l in string_split(body, chr(10)) if regexp_matches(l, '{WORD_CHAR}')] AS lines
  FROM numbered),
word AS (SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM parts),
win AS (
  SELECT rid, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM word WINDOW o AS (PARTITION BY rid ORDER BY i)),
twice AS (
  SELECT rid, i, CASE WHEN w3 IS NOT NULL AND count(*) OVER (PARTITION BY rid, w, w2, w3) > 1 THEN 1 ELSE 0 END AS two
  FROM win),
covered AS (
  SELECT rid, max(two) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c FROM twice),
repeated AS (SELECT rid, sum(c) AS n FROM covered GROUP BY rid),
measured AS (
  SELECT p.* EXCLUDE (words, lines), CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(body, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(body) - length(translate(body, '{quality.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len([w for w in words if lower(w) IN ({stops})]) AS n_stop_words,
    len(regexp_extract_all(body, '\\b\\p{{Lu}}{{2,}}\\b')) AS n_shouted,
    length(body) - length(replace(body, '!', '')) AS n_exclamations
  FROM parts p LEFT JOIN repeated r ON p.rid = r.rid)"""


def _quality() -> str:
    names = ", ".join(f"CASE WHEN {_broken(r)} THEN '{r.name}' END" for r in (*quality.BASE, *quality.RULES))
    base = " OR ".join(_broken(r) for r in quality.BASE)
    return f"""WITH {measured_sql('documents')},
judged AS (
  SELECT *, ({base}) AS base_failed, coalesce(array_to_string([x for x in [{names}] if x IS NOT NULL], ','), '') AS broken_rules
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, broken_rules = '' AS kept, broken_rules
FROM judged"""


def _hosts() -> str:
    rule, verdict = "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)"
    for says, text in sorted(hosts.RULES, key=lambda r: (len(r[1]), r[1])):
        name, slash, prefix = text.partition("/")
        fits = f"((host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash + prefix}'))"
        rule, verdict = f"CASE WHEN {fits} THEN '{text}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{says}' ELSE {verdict} END"
    two = ", ".join(f"'{s}'" for s in hosts.TWO_LABEL_SUFFIXES)

    def strength(table: str, rate: str) -> str:
        p = f"{rate} * (1 - {rate})"
        return f"""(SELECT 1 / least({hosts.MOST_RHO}, greatest({hosts.LEAST_RHO}, coalesce(
      (sum(n * power(bad / n - {rate}, 2)) - sum({p})) / nullif(sum({p} * (n - 1)), 0), {hosts.LEAST_RHO}))) - 1
    FROM {table} WHERE n > 0)"""

    return f"""WITH cut AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{hosts.UPPER}', '{hosts.LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
outcome AS (SELECT doc_id, max(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
counted AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM named LEFT JOIN outcome ON page_id = doc_id GROUP BY host),
bare AS (SELECT *, regexp_replace(host, '^.*@|:[0-9]*$', '', 'g') AS b FROM counted),
labels_of AS (SELECT *, string_split(b, '.') AS l FROM bare),
two AS (SELECT *, array_to_string(l[-2:], '.') AS t2, array_to_string(l[-3:], '.') AS t3 FROM labels_of),
hosted AS (
  SELECT host, CAST(n AS DOUBLE) AS n, CAST(bad AS DOUBLE) AS bad,
    CASE WHEN regexp_matches(b, '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$') THEN b WHEN t2 IN ({two}) THEN t3 ELSE t2 END AS domain,
    CASE WHEN regexp_matches(b, '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$') THEN 'ip' WHEN t2 IN ({two}) THEN t2 ELSE l[-1] END AS suffix
  FROM two),
s0 AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM hosted) AS overall FROM hosted GROUP BY suffix),
s1 AS (SELECT *, {strength('s0', 'overall')} AS s FROM s0),
s2 AS (SELECT suffix, (bad + s * overall) / (n + s) AS of_suffix FROM s1),
d0 AS (SELECT * FROM (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosted GROUP BY suffix, domain) JOIN s2 USING (suffix)),
d1 AS (SELECT *, {strength('d0', 'of_suffix')} AS s FROM d0),
d2 AS (SELECT suffix, domain, (bad + s * of_suffix) / (n + s) AS of_domain FROM d1),
h0 AS (SELECT * FROM hosted JOIN d2 USING (suffix, domain)),
h1 AS (SELECT *, {strength('h0', 'of_domain')} AS s FROM h0),
h2 AS (SELECT host, n + s AS size, (bad + s * of_domain) / (n + s) AS mean FROM h1),
h3 AS (SELECT host, mean, mean - {hosts.Z} * sqrt(mean * size * (size - mean * size) / (size * size * (size + 1))) AS low FROM h2)
SELECT page_id, host, path, {rule} AS rule,
  coalesce({verdict}, CASE WHEN low > {hosts.BAD_SHARE} THEN 'block' ELSE 'allow' END) AS verdict,
  round(mean, 6) AS bad_mean, round(low, 6) AS bad_low
FROM named LEFT JOIN h3 USING (host)"""


def _infill() -> str:
    return r"""WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
drawn AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS x,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS y, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS z
  FROM cut),
parts AS (
  SELECT doc_id, t, n,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
      WHEN z < 50 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
    array_to_string(u[greatest(x, y) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""


def _trie() -> str:
    return r"""WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
crc_step AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS s FROM turns GROUP BY conv_id),
table_of AS (
  SELECT list(v ORDER BY k) AS t FROM (
    SELECT k, list_reduce([CAST(k AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS v
    FROM range(256) r(k))),
convs AS (
  SELECT conv_id, xor(list_reduce(list_concat([4294967295], list_transform(string_split(s, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: xor(a // 256, t[CAST(xor(a % 256, b) AS BIGINT) + 1])), 4294967295) % 4 AS h
  FROM crc_step, table_of),
opening AS (
  SELECT c.conv_id, t.i AS k, 0 AS part, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.i <= c.h),
own AS (
  SELECT c.conv_id, t.i AS k, 1 AS part, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.i > c.h),
rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, k) AS d, md5(length(role) || ':' || role || text) AS code,
    CAST(len([w for w in regexp_split_to_array(text, '[\x20\x09-\x0D]+') if w <> '']) AS BIGINT) AS words
  FROM (SELECT * FROM opening UNION ALL SELECT * FROM own)),
prefixes AS (
  SELECT conv_id, d, words, list(code) OVER (PARTITION BY conv_id ORDER BY d) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, CAST([] AS VARCHAR[]) FROM convs),
sized AS (SELECT *, max(d) OVER (PARTITION BY conv_id) = d AS ends FROM prefixes),
nodes AS (
  SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM sized GROUP BY path, d),
families AS (
  SELECT p.path, count(c.path) AS n_children, any_value(p.conv_id) AS conv_id
  FROM nodes p LEFT JOIN nodes c ON c.depth = p.depth + 1 AND c.path[1:p.depth] = p.path AND c.depth > 0 GROUP BY p.path),
described AS (SELECT n.*, f.n_children FROM nodes n JOIN families f USING (path)),
above AS (SELECT path[1:k] AS path, n_children = 0 AS leaf, (n_convs - 1) * words AS saving FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM described)),
sums AS (SELECT path, CAST(count_if(leaf) AS BIGINT) AS n_leaves, CAST(sum(saving) AS BIGINT) AS saved_tokens FROM above GROUP BY path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM described n JOIN sums s USING (path) LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]"""


def _repeats() -> str:
    return """WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS b FROM documents),
windows AS (
  SELECT doc_id, s, md5(substr(b, 2 * s + 1, 200)) AS w
  FROM (SELECT doc_id, b, unnest(range(0, greatest(length(b) // 2 - 99, 0))) AS s FROM docs)),
numbered AS (SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id NULLS FIRST, s) AS n FROM windows),
fresh AS (
  SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS f
  FROM numbered WHERE n > 1),
runs AS (SELECT doc_id, s, sum(f) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM fresh),
spans AS (SELECT doc_id, run, min(s) AS a, max(s) + 100 AS z FROM runs GROUP BY doc_id, run),
counted AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last FROM spans GROUP BY doc_id),
before AS (SELECT doc_id, a, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM spans),
joined AS (
  SELECT doc_id, string_agg(substr(b, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS start
  FROM before JOIN docs USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(b) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(start, '') || substr(b, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN counted USING (doc_id) LEFT JOIN joined USING (doc_id)"""


ORACLES: dict[str, str] = {
    "op9_quality_rules": _quality(),
    "op10_host_reputation": _hosts(),
    "op11_merged_bwt_repeats": _repeats(),
    "op12_parenthesis_trie": _trie(),
    "op13_secondary_sort_infill": _infill(),
}
