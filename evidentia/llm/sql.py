"""SQL for DuckDB that gives the rows of those queries that SQL can express.

Fingerprints, shard orders, tokens, models and revealing terms rest on hashes, merges or statistics that SQL lacks; tests
hold their queries against brute force instead.
"""

from __future__ import annotations

from .decontaminate import LOWER, UPPER

GAPS = r"[^\x20\x09-\x0D]+"
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{ITEM_WORD}')"


DECONTAMINATE = f"""WITH item AS (SELECT item_id, {_words('text')} AS w FROM benchmark), window_ AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS key FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
  doc AS (SELECT doc_id, {_words('text')} AS w FROM documents), sizes AS (SELECT DISTINCT n FROM window_),
  part AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS key FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, sizes)),
  found AS (SELECT doc_id, i, p.n, item_id FROM part p JOIN window_ USING (n, key)),
  hit AS (SELECT doc_id, count(DISTINCT at_) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS at_ FROM found) GROUP BY doc_id),
  ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
  SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)"""

GAMMA, SPREAD, PRIOR, SURPRISE = 1.01 / 0.99, 6.0, 100.0, 20.72326583694641
_shares = {"symbol_share": ("n_symbols", "word_chars"), "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words")}
_lengths = {"word_length": ("word_chars", "n_words"), "line_length": ("n_words", "n_lines")}
_values = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS measure, {a}::DOUBLE AS n, {b}::DOUBLE AS d FROM base WHERE NOT base_failed AND {b} > 0" for k, (a, b) in (_shares | _lengths).items())
_of = lambda table, k, c: f"(SELECT {c} FROM {table} f WHERE f.measure = '{k}' AND f.lang IS NOT DISTINCT FROM base.lang AND f.source IS NOT DISTINCT FROM base.source)"
_beyond = [f"CASE WHEN {a} > {_of('rate', k, 'rate')} * {b} AND {a} * ln({a} / ({_of('rate', k, 'rate')} * {b})) - {a} + {_of('rate', k, 'rate')} * {b} > {SURPRISE} * {_of('rate', k, 'dispersion')} THEN '{k}' END" for k, (a, b) in _shares.items()]
_beyond += [f"CASE WHEN {a}::DOUBLE / nullif({b}, 0) > {_of('fence', k, 'high')} OR {a}::DOUBLE / nullif({b}, 0) < {_of('fence', k, 'low')} THEN '{k}' END" for k, (a, b) in _lengths.items()]
_beyond = ", ".join(_beyond)


def _fences(by: str) -> str:
    width = f"{SPREAD}::DOUBLE * greatest(q3 - q1, 0.05::DOUBLE * q3)"
    return f"""SELECT {by}, measure, n_rows, q1 - {width} AS low, q3 + {width} AS high FROM
      (SELECT {by}, measure, max(whole)::DOUBLE AS n_rows, min(value) FILTER (upto >= ceil(whole * 0.25)) AS q1, min(value) FILTER (upto >= ceil(whole * 0.75)) AS q3 FROM
        (SELECT {by}, measure, CASE WHEN bucket IS NULL THEN 0.0::DOUBLE ELSE pow({GAMMA}::DOUBLE, bucket) * {2 / (GAMMA + 1)}::DOUBLE END AS value, sum(k) OVER (PARTITION BY {by}, measure ORDER BY bucket ASC NULLS FIRST) AS upto, sum(k) OVER (PARTITION BY {by}, measure) AS whole
          FROM (SELECT {by}, measure, bucket, sum(k) AS k FROM sketch WHERE measure LIKE '%length' GROUP BY ALL)) GROUP BY {by}, measure)"""


QUALITY = f"""WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{GAPS}') AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
  g AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS key FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
  r AS (SELECT doc_id, count(DISTINCT at_) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS at_ FROM (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, key) > 1)) GROUP BY doc_id),
  m AS (SELECT doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines FROM t LEFT JOIN r USING (doc_id)),
  base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
  sketch AS (SELECT lang, source, measure, CASE WHEN n > 0 THEN ceil(ln(n / d) / ln({GAMMA}::DOUBLE))::INT END AS bucket, count(*) AS k, sum(n) AS n, sum(d) AS d, sum(n * n / d) AS squares FROM ({_values}) GROUP BY ALL),
  ranked AS (SELECT *, sum(k) OVER (w ORDER BY bucket ASC NULLS FIRST) - k AS before, sum(k) OVER w AS whole FROM sketch WHERE measure NOT LIKE '%length' WINDOW w AS (PARTITION BY lang, source, measure)),
  bulk AS (SELECT lang, source, measure, sum(k) FILTER (before < ceil(whole * 0.95::DOUBLE)) AS k, sum(n) FILTER (before < ceil(whole * 0.95::DOUBLE)) AS n, sum(d) FILTER (before < ceil(whole * 0.95::DOUBLE)) AS d,
      sum(k) FILTER (before < ceil(whole * 0.9::DOUBLE)) AS ck, sum(n) FILTER (before < ceil(whole * 0.9::DOUBLE)) AS cn, sum(d) FILTER (before < ceil(whole * 0.9::DOUBLE)) AS cd, sum(squares) FILTER (before < ceil(whole * 0.9::DOUBLE)) AS cs FROM ranked GROUP BY ALL),
  calm AS (SELECT *, (cs / ((cn + 0.5::DOUBLE) / cd) - 2 * cn + (cn + 0.5::DOUBLE) / cd * cd) / ck AS own FROM bulk),
  spoken AS (SELECT lang, measure, (sum(n) + 0.5::DOUBLE) / sum(d) AS rate, greatest(quantile_cont(own, 0.5), 1) AS dispersion FROM calm GROUP BY ALL),
  rate AS (SELECT b.lang, b.source, b.measure, (b.n + {PRIOR}::DOUBLE * b.d / b.k * s.rate) / (b.d + {PRIOR}::DOUBLE * b.d / b.k) AS rate, s.dispersion FROM bulk b JOIN spoken s ON s.measure = b.measure AND s.lang IS NOT DISTINCT FROM b.lang),
  own AS ({_fences('lang, source')}), common AS ({_fences('lang')}),
  fence AS (SELECT own.lang, own.source, own.measure, (own.n_rows * own.low + {PRIOR}::DOUBLE * common.low) / (own.n_rows + {PRIOR}::DOUBLE) AS low, (own.n_rows * own.high + {PRIOR}::DOUBLE * common.high) / (own.n_rows + {PRIOR}::DOUBLE) AS high
    FROM own JOIN common ON own.measure = common.measure AND own.lang IS NOT DISTINCT FROM common.lang),
  judged AS (SELECT *, CASE WHEN base_failed THEN '' ELSE array_to_string(list_filter([{_beyond}], lambda x: x IS NOT NULL), ',') END AS failed FROM base)
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed = '' AS kept, failed FROM judged"""

WARC = """WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
  k AS (SELECT digest, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY digest)
  SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN keeper IS NULL OR keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN keeper <> page_id THEN keeper END AS refers_to FROM p LEFT JOIN k USING (digest)"""

SUBSTRINGS = f"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{GAPS}') AS w FROM documents),
  g AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) AS key FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
  often AS (SELECT key FROM g GROUP BY key HAVING count(*) > 1),
  gone AS (SELECT doc_id, list(DISTINCT at_) AS gone FROM (SELECT doc_id, unnest(range(i, i + 35)) AS at_ FROM g SEMI JOIN often USING (key)) GROUP BY doc_id),
  each AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS at_ FROM d),
  kept AS (SELECT doc_id, string_agg(w[at_], ' ' ORDER BY at_) AS kept FROM each ANTI JOIN (SELECT doc_id, unnest(gone) AS at_ FROM gone) USING (doc_id, at_) GROUP BY doc_id)
  SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""

CRC_TABLE = """crc_table AS (SELECT list(list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) ORDER BY i) AS crc_of FROM range(256) r(i))"""


def _crc(bytes_: str) -> str:
    """CRC-32 of a list of bytes, with the table of CRC_TABLE in scope."""
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"


INTERVALS = f"""WITH {CRC_TABLE},
  click AS (SELECT client_id, epoch_us(ts) AS us, kind FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL),
  marked AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY client_id ORDER BY us) <= 300000000 THEN 0 ELSE 1 END AS begins FROM click),
  numbered AS (SELECT *, sum(begins) OVER (PARTITION BY client_id ORDER BY us) AS n FROM marked),
  ended AS (SELECT *, max(us) OVER (PARTITION BY client_id, n) AS last_us FROM numbered),
  session_ AS (SELECT client_id, min(us) AS first_us, last_us, coalesce(bool_or(kind = 'click') FILTER (us = last_us), false) AS open FROM ended GROUP BY client_id, n, last_us),
  b AS (SELECT client_id, first_us // 86400000000 AS t, CASE WHEN open THEN 'inf'::DOUBLE ELSE last_us // 86400000000 END AS u, {_crc("list_transform(string_split(first_us::VARCHAR, ''), lambda c: ascii(c)::BIGINT)")} AS crc FROM session_, crc_table),
  shipped AS (SELECT sale_id, max(shipped_at) AS shipped_at FROM sale_lines GROUP BY sale_id),
  a AS (SELECT s.sale_id, client_id, epoch_us(sold_at) // 86400000000 AS s, CASE WHEN status = 'held' THEN 'inf'::DOUBLE ELSE epoch_us(greatest(sold_at, coalesce(shipped_at, sold_at))) // 86400000000 END AS e FROM sales s LEFT JOIN shipped l ON s.sale_id = l.sale_id WHERE client_id IS NOT NULL AND sold_at IS NOT NULL),
  p AS (SELECT sale_id, crc, CASE WHEN isinf(least(e, u)) THEN NULL ELSE (least(e, u) - greatest(s, t) + 1)::BIGINT END AS shared, CASE WHEN s < t THEN 0 WHEN s = t THEN 3 ELSE 6 END + CASE WHEN e < u THEN 1 WHEN e = u THEN 2 ELSE 3 END AS r FROM a JOIN b USING (client_id) WHERE s <= u AND t <= e)
  SELECT sale_id, ['overlaps', 'finished_by', 'contains', 'starts', 'equals', 'started_by', 'during', 'finishes', 'overlapped_by'][r] AS relation, count(*) AS n_pairs, sum(shared)::BIGINT AS overlap_slots, sum(crc)::BIGINT AS sessions_crc FROM p GROUP BY ALL"""

_bytes = "list_transform(range(1, len(hexes), 2), lambda k: ('0x' || hexes[k:k + 1])::BIGINT)"
SPELLING = f"""WITH RECURSIVE {CRC_TABLE},
  run AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY ALL),
  hashed AS (SELECT run, n, coalesce({_crc(_bytes)}, 1) AS h FROM (SELECT run, n, hex(encode(doc_id || ':' || run)) AS hexes FROM run), crc_table),
  word AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
  cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS key FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)),
  near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.key = b.key AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM cut a JOIN word b ON a.key = b.word UNION SELECT b.word, a.word, a.n FROM cut a JOIN word b ON a.key = b.word),
  best AS (SELECT word, count(*) AS n_near, arg_max(other, (other_n, other_rank)) AS other, max(other_n) AS other_n FROM (SELECT *, -row_number() OVER (ORDER BY other) AS other_rank FROM near) GROUP BY word),
  formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * n THEN other END AS form, CASE WHEN other_n >= 2 * n THEN other_n END AS form_n FROM word LEFT JOIN best USING (word)),
  up AS (SELECT word, word AS reached, form AS further FROM formed UNION ALL SELECT up.word, f.word, f.form FROM up JOIN formed f ON f.word = up.further)
  SELECT word, form, reached AS root, n, n_near, form_n FROM formed JOIN up USING (word) WHERE further IS NULL"""

JACCARD = f"""WITH RECURSIVE t AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{GAPS}') AS w FROM documents),
  shingle AS (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS key FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
  size_ AS (SELECT r, count(*) AS n, md5(string_agg(key, chr(10) ORDER BY key)) AS digest FROM shingle GROUP BY r),
  first_ AS (SELECT digest, min(r) AS r, any_value(n) AS n FROM size_ GROUP BY digest),
  one AS (SELECT r, key FROM shingle SEMI JOIN first_ USING (r)),
  overlap_ AS (SELECT a.r AS a, b.r AS b, count(*) AS shared FROM one a JOIN one b ON a.key = b.key AND a.r < b.r GROUP BY ALL),
  link AS (SELECT a, b FROM overlap_ JOIN first_ x ON x.r = a JOIN first_ y ON y.r = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
  edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
  reach AS (SELECT r AS a, r AS b FROM first_ UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b),
  least_ AS (SELECT digest, min(doc_id) AS doc_id FROM size_ JOIN t USING (r) GROUP BY digest),
  component AS (SELECT f.digest, min(l.doc_id) AS component_id FROM first_ f JOIN reach ON reach.a = f.r JOIN first_ g ON g.r = reach.b JOIN least_ l ON l.digest = g.digest GROUP BY f.digest)
  SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id FROM t LEFT JOIN size_ USING (r) LEFT JOIN component USING (digest)"""

ORACLE_SQL = {"op1_decontaminate": DECONTAMINATE, "op4_quality": QUALITY, "op6_warc": WARC, "op8_substrings": SUBSTRINGS, "op11_spelling": SPELLING, "op12_jaccard": JACCARD, "op13_intervals": INTERVALS}
