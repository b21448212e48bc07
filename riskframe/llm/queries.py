"""Registered queries of the corpus operators with their SQL counterparts."""

from __future__ import annotations

import public_tokenizers

from riskframe.llm import (
    byte_bpe,
    class_lm,
    collocations,
    conversations,
    exact_dedup,
    line_crf,
    mixing,
    quality_rules,
    secrets,
    simhash,
    substring_dedup,
    trie_tokens,
    warc,
)
from riskframe.llm.common import fresh_folder, read_table


def op1_exact_dedup(spark, folder):
    return exact_dedup.decisions(read_table(spark, folder, "documents"))


def op2_source_mix(spark, folder):
    return mixing.mixing_plan(read_table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op3_quality_rules(spark, folder):
    return quality_rules.apply_rules(read_table(spark, folder, "documents")).drop("rule")


def op4_secret_scan(spark, folder):
    return secrets.report(read_table(spark, folder, "documents"))


def ranks() -> bytes:
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op5_byte_bpe(spark, folder):
    documents = read_table(spark, folder, "documents")
    return byte_bpe.digests(documents, ranks(), public_tokenizers.PATTERN)


def op6_line_crf(spark, folder):
    documents = read_table(spark, folder, "documents")
    field = line_crf.train(documents, read_table(spark, folder, "labels"))
    return line_crf.judge(documents, field)


def op7_warc(spark, folder):
    archives = fresh_folder(spark, "warc")
    warc.write_archives(read_table(spark, folder, "pages"), archives)
    return warc.read_archives(spark, archives)


def op8_simhash(spark, folder):
    return simhash.report(read_table(spark, folder, "documents"))


def op9_trie_tokens(spark, folder):
    pieces = trie_tokens.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return trie_tokens.count_tokens(read_table(spark, folder, "documents"), pieces)


def op10_class_lm(spark, folder):
    return class_lm.report(read_table(spark, folder, "documents"))


def op11_collocations(spark, folder):
    return collocations.report(read_table(spark, folder, "documents"))


def op12_conversation_repair(spark, folder):
    return conversations.report(read_table(spark, folder, "conversations"))


def op13_substring_dedup(spark, folder):
    return substring_dedup.report(read_table(spark, folder, "documents"))


OP1_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
shares AS (
  SELECT *, length(translate(t, '#*$%&|<>!', '')) / greatest(length(t), 1) AS clean FROM sized),
drawn AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT
              + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
         / greatest(clean * clean * clean * clean, 0.01::DOUBLE) AS draw
  FROM shares),
weighed AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS s,
         [5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS w
  FROM drawn GROUP BY source),
placed AS (
  SELECT *, 3 * s AS cap, sum(s) OVER () AS total,
         sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY s / w, w, source ASC NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(w) OVER (ORDER BY s / w, w, source ASC NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM weighed),
capped AS (SELECT *, rest * w > cap * open AS over FROM placed),
targets AS (
  SELECT source, CAST(s AS BIGINT) AS source_size,
         CASE WHEN over THEN CAST(cap AS DOUBLE)
              ELSE w * CAST(total - coalesce(sum(cap) FILTER (over) OVER (), 0) AS DOUBLE)
                   / CAST(sum(w) FILTER (NOT over) OVER () AS DOUBLE) END AS target
  FROM capped),
ranked AS (
  SELECT d.doc_id, d.size, source_size, target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY draw, doc_id, size
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before,
         coalesce(floor(target / nullif(source_size, 0)), 0) AS epochs
  FROM drawn d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CAST(before + size / 2 <= target - epochs * source_size AS INTEGER))
            AS BIGINT) AS taken
FROM ranked
"""

OP3_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, string_split(t, chr(10)) AS l,
         length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars
  FROM texts),
places AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i,
         unnest(list_transform(range(1, len(w) - 1),
           lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) AS g FROM split),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM places),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM windows, range(0, 3) AS o(k) WHERE n > 1 GROUP BY r),
lines AS (
  SELECT r, count(x) AS m, count(x) - count(DISTINCT x) AS n
  FROM (SELECT r, unnest(l) AS x FROM split) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
base AS (
  SELECT doc_id, t, coalesce(lines.m, 0) AS n_lines, CAST(len(w) AS BIGINT) AS n_words,
         CAST(word_chars AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         100 * n_symbols > 20 * word_chars
         OR n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines
         OR 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 60 * word_chars
         OR word_chars > 20 * n_words
         OR 100 * len(regexp_extract_all(t, '[!|#*$%&]+(?:[ \n]|$)')) > 30 * n_words AS failed
  FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR failed) AS kept
FROM judged
"""


OP7_SQL = """
WITH digits AS (
  SELECT page_id, url, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
coded AS (
  SELECT page_id, url, h,
         list_aggregate(list_transform(range(0, 8), lambda g: list_aggregate(list_transform(
           [32768, 1024, 32, 1],
           lambda q: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             (('0x' || substr(x, 1 + 5 * g, 5))::BIGINT // q) % 32 + 1, 1)), 'string_agg', '')),
           'string_agg', '') AS payload_digest
  FROM digits),
ranked AS (
  SELECT *, max(page_id) OVER (PARTITION BY h) AS first,
         row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST, url DESC) AS r
  FROM coded)
SELECT page_id, strlen(h) AS payload_bytes, payload_digest,
       CASE WHEN r = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN r > 1 THEN first END AS refers_to
FROM ranked
"""


def _spans_sql(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    own = pattern.replace("'", "''")
    pieces = f"regexp_split_to_array(t, '{own}')"
    whole = f"regexp_extract_all(t, '{own}')"
    return f"""
  SELECT r, {order} AS o, '{kind}' AS kind, stop - length(m) AS s, stop AS e
  FROM (SELECT r, m, g, sum(length(p) + length(m)) OVER (PARTITION BY r ORDER BY i) AS stop
        FROM (SELECT r, unnest(range(len(a))) AS i, unnest(a) AS m, unnest(g) AS g,
                     unnest(p[:len(a)]) AS p
              FROM (SELECT r, {whole} AS a, regexp_extract_all(t, '{own}', {group}) AS g,
                           {pieces} AS p FROM texts)))
  WHERE length(g) >= {least}"""


def _any_case(pattern: str) -> str:
    """Letters of the leading ``(?i:...)`` group spelled out, where only A-Z may change case."""
    head, _, tail = pattern.removeprefix("(?i:").partition("))")
    both = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in head)
    return both + ")" + tail


def _op4_sql() -> str:
    each = [
        _spans_sql(
            rule.kind,
            order,
            _any_case(rule.pattern) if rule.pattern.startswith("(?i:") else rule.pattern,
            rule.group,
            rule.least,
        )
        for order, rule in enumerate(secrets.RULES)
    ]
    counts = ", ".join(
        f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in secrets.BASE_RULES
    )
    listed = "string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, o)"
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(each)})
SELECT any_value(doc_id) AS doc_id, {counts},
       sha256(coalesce({listed} FILTER (o < {len(secrets.BASE_RULES)}), '')) AS base_sha256,
       coalesce({listed}, '') AS spans
FROM texts LEFT JOIN spans USING (r) GROUP BY r
"""


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM words GROUP BY lang),
counts AS (
  SELECT lang, k, g, count(*) AS f
  FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2),
                 lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g
        FROM words, range(1, 6) AS sizes(k))
  GROUP BY lang, k, g HAVING count(*) >= 100),
candidates AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS w FROM counts WHERE k > 1),
cuts AS (
  SELECT c.lang, c.g, c.k, c.a, cut, x.f AS l, y.f AS r, n,
         (1000 * CAST(a AS HUGEINT) * n) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN counts x ON x.lang = c.lang AND x.g = array_to_string(c.w[1:cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.g = array_to_string(c.w[cut + 1:c.k], ' ')
  JOIN totals t ON t.lang = c.lang),
scored AS (
  SELECT * FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
held AS (
  SELECT lang, g, max(a) AS held
  FROM (SELECT lang, a, unnest(list_transform(range(1, k - size + 2),
                 lambda i: array_to_string(w[i:i + size - 1], ' '))) AS g
        FROM candidates, range(2, 5) AS sizes(size) WHERE size < k)
  GROUP BY lang, g),
kept AS (
  SELECT s.* FROM scored s LEFT JOIN held h ON h.lang = s.lang AND h.g = s.g
  WHERE held IS NULL OR 100 * held < 100 * a)
SELECT lang, row_number() OVER best AS rank, g AS phrase, a, l, r, CAST(n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM kept
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, g)
QUALIFY rank <= 2000
"""

OP13_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x,
         unnest(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN i <= len(w) - 19
           THEN array_to_string(w[i:i + 19], ' ') END)) AS g
  FROM texts),
repeated AS (
  SELECT doc_id, i, x,
         g IS NOT NULL AND row_number() OVER (PARTITION BY g ORDER BY doc_id, i) > 1 AS again
  FROM words),
covered AS (
  SELECT doc_id, i, x, coalesce(i - max(CASE WHEN again THEN i END) OVER (
           PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) < 20, false) AS gone
  FROM repeated)
SELECT t.doc_id, CAST(len(t.w) AS BIGINT) AS n_words,
       count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(x, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM texts t LEFT JOIN covered c USING (doc_id) GROUP BY t.doc_id, t.w
"""


QUERIES = {
    "op1_exact_dedup": (op1_exact_dedup, OP1_SQL),
    "op2_source_mix": (op2_source_mix, OP2_SQL),
    "op3_quality_rules": (op3_quality_rules, OP3_SQL),
    "op4_secret_scan": (op4_secret_scan, _op4_sql()),
    "op5_byte_bpe": (op5_byte_bpe, None),
    "op6_line_crf": (op6_line_crf, None),
    "op7_warc": (op7_warc, OP7_SQL),
    "op8_simhash": (op8_simhash, None),
    "op9_trie_tokens": (op9_trie_tokens, None),
    "op10_class_lm": (op10_class_lm, None),
    "op11_collocations": (op11_collocations, OP11_SQL),
    "op12_conversation_repair": (op12_conversation_repair, None),
    "op13_substring_dedup": (op13_substring_dedup, OP13_SQL),
}
