"""One query per operator over its whole table, with its SQL check where SQL can state it."""

from leakwatch.llm import decontaminate, langid, lines, mixing, packing, periods, phrases, quality, rnnlm, simhash, toxicity, urls, wrappers

QUERIES = {}
CHECKS = {}


def query(check=None):
    def keep(function):
        QUERIES[function.__name__] = function
        if check is not None:
            CHECKS[function.__name__] = check
        return function

    return keep


def read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 15))::BIGINT AS place
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM src),
ranked AS (
  SELECT *, coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         sum(source_size) OVER () AS total
  FROM weighed WINDOW o AS (ORDER BY source_size::DOUBLE / w, encode(source) NULLS LAST)),
marked AS (SELECT *, 2 * source_size * rest * 2 <= (total * 3 - below * 2) * w AS is_full FROM ranked),
budget AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN (2 * source_size)::DOUBLE
              ELSE w::DOUBLE * (total::DOUBLE * 3 / 2 - coalesce(sum(CASE WHEN is_full THEN 2 * source_size END) OVER (), 0)::DOUBLE)
                   / (sum(CASE WHEN NOT is_full THEN w END) OVER ())::DOUBLE END AS target
  FROM marked),
summed AS (
  SELECT s.doc_id, s.size, b.source_size, b.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.place, s.doc_id, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
         CASE WHEN b.source_size > 0 THEN floor(b.target / b.source_size) ELSE 0 END::BIGINT AS turns
  FROM sized s JOIN budget b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (turns * size + least(greatest(floor(target)::BIGINT - turns * source_size - before, 0), size))::BIGINT AS taken
FROM summed
"""


@query(MIX_SQL)
def op1_source_mixing(spark, sf_dir):
    """Words taken of every document by the mix at weights 5, 2, 1."""
    return mixing.mix_plan(read(spark, sf_dir, "documents"))


QUALITY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
grams AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS pos, w FROM d WHERE len(w) > 2),
keyed AS (SELECT r, pos, w[pos:pos + 2] AS g FROM grams),
twice AS (SELECT r, pos, count(*) OVER (PARTITION BY r, g) AS n FROM keyed),
covered AS (
  SELECT r, count(DISTINCT pos + k) AS n
  FROM (SELECT r, pos, unnest([0, 1, 2]) AS k FROM twice WHERE n > 1) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
counted AS (
  SELECT d.r, doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         length(regexp_replace(text, '[^\p{L}]+', '', 'g')) AS n_letters,
         len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN lines USING (r) LEFT JOIN covered c ON c.r = d.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols * 10 > n_words
            OR n_dup_lines * 2 > n_lines OR word_chars < 2 * n_words OR word_chars > 14 * n_words
            OR n_letters * 10 < word_chars * 3) AS kept
FROM counted
"""


@query(QUALITY_SQL)
def op3_quality_rules(spark, sf_dir):
    """Base counts and the cascade's verdict for every document."""
    return quality.measure(read(spark, sf_dir, "documents"))


CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+'), []) AS w FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[pos:pos + k - 1], ' ') AS g
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS pos
        FROM (SELECT item_id, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0))),
places AS (
  SELECT r, k, pos, array_to_string(w[pos:pos + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
found AS (SELECT r, p.k, pos, item_id FROM places p JOIN win USING (k, g)),
hit AS (SELECT r, count(DISTINCT pos + j) AS n FROM (SELECT r, pos, unnest(range(0, k)) AS j FROM found) GROUP BY r),
names AS (
  SELECT r, count(*) AS n, string_agg(i, ',' ORDER BY encode(i)) AS ids
  FROM (SELECT DISTINCT r, coalesce(item_id::VARCHAR, '') AS i FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(names.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN names USING (r)
"""


@query(CONTAMINATION_SQL)
def op4_decontamination(spark, sf_dir):
    """Words of every document that lie in benchmark windows."""
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("matches")


@query()
def op6_simhash_dedup(spark, sf_dir):
    """Fingerprint and near-duplicate class of every document."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query()
def op2_token_packing(spark, sf_dir):
    """Packed rows of token ids of every document."""
    return packing.packed_rows(read(spark, sf_dir, "documents"))


@query()
def op7_line_dedup(spark, sf_dir):
    """Repeated lines and sentences to remove, with their places."""
    return lines.removals(read(spark, sf_dir, "documents"))


@query()
def op5_language_id(spark, sf_dir):
    """Language of every document."""
    return langid.identify(read(spark, sf_dir, "documents"))


@query()
def op9_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    found = toxicity.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.drop("passages")


@query()
def op8_url_filter(spark, sf_dir):
    """Verdict on the URL of every page."""
    return urls.judge(read(spark, sf_dir, "pages"))


@query()
def op10_rnn_scoring(spark, sf_dir):
    """Base and network log10 probability of every document."""
    return rnnlm.language_scores(read(spark, sf_dir, "documents"))


# crc32 of a number written as text, bit by bit.
CRC_SQL = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda z: 0::BIGINT)),
                             lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))))"""

# Sequences of L words get a name by doubling; where the last earlier one lies d words back, L / 2 < d <= L, over a
# stretch of places, that stretch and the d words before it are one with smallest period d.
RUNS_SQL = r"""
WITH RECURSIVE hashed AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w,
         %(crc)s AS h FROM documents),
shaped AS (
  SELECT r, doc_id, w, len(w) AS n, coalesce(h %% 10 = 0 AND len(w) > 0, false) AS turned, (h // 10) %% greatest(len(w), 1) AS a, 3 + (h // 10) %% 8 AS b
  FROM hashed),
texts AS (
  SELECT r, doc_id, CASE WHEN turned THEN [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) %% (1 + (n - a) // b) END] FOR i IN range(n)] ELSE w END AS w
  FROM shaped),
named AS (
  SELECT r, pos, L, name, CASE WHEN pos - before > L // 2 AND pos - before <= L THEN pos - before END AS d
  FROM (SELECT r, pos, 1 AS L, hash(word) AS name, lag(pos) OVER (PARTITION BY r, word ORDER BY pos) AS before
        FROM (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS pos FROM texts))
  UNION ALL
  SELECT r, pos, L, name, CASE WHEN pos - before > L // 2 AND pos - before <= L THEN pos - before END
  FROM (SELECT r, pos, L, name, lag(pos) OVER (PARTITION BY r, name ORDER BY pos) AS before
        FROM (SELECT r, pos, 2 * L AS L, hash(name, lead(name, L) OVER (PARTITION BY r ORDER BY pos)) AS name,
                     lead(name, L) OVER (PARTITION BY r ORDER BY pos) AS other FROM named) WHERE other IS NOT NULL)),
islands AS (
  SELECT r, min(pos) - d AS start, count(*) + L + d - 1 AS length, d AS period
  FROM (SELECT *, pos - row_number() OVER (PARTITION BY r, L, d ORDER BY pos) AS g FROM named WHERE d IS NOT NULL)
  GROUP BY r, L, d, g),
runs AS (SELECT * FROM islands WHERE length >= greatest(6, 4 * period)),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS pos FROM runs),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY pos) AS collapsed
  FROM (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS pos FROM texts) ANTI JOIN gone USING (r, pos) GROUP BY r),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         max({'length': length, 's': -start, 'p': -period}) AS best
  FROM runs GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, (-best.s)::BIGINT AS start, best.length::BIGINT AS length,
       (-best.p)::BIGINT AS period, (1000 * best.length // -best.p)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
""" % {"crc": CRC_SQL}


@query(RUNS_SQL)
def op12_periodic_runs(spark, sf_dir):
    """Periodic runs of every document after every tenth was made to repeat a part."""
    return periods.run_digests(periods.periodic_runs(periods.with_planted_runs(read(spark, sf_dir, "documents"))))


PHRASES_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, sum(len(w))::BIGINT AS n FROM listed GROUP BY lang HAVING sum(len(w)) > 0),
grams AS (
  SELECT lang, k, array_to_string(w[pos:pos + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM listed, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM cand),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
              JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ AS (
  SELECT lang, array_to_string(w[pos:pos + k - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, k, unnest(range(1, size - k + 2)) AS pos FROM cand, (SELECT unnest([2, 3]) AS k) WHERE size > k)
  GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank, b.phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score
FROM best b JOIN words USING (lang) LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY rank <= 2000
"""


@query(PHRASES_SQL)
def op13_phrase_collocation(spark, sf_dir):
    """The 2 000 best collocations of each language."""
    return phrases.collocations(read(spark, sf_dir, "documents")).drop("pointer")


@query()
def op11_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return wrappers.main_texts(read(spark, sf_dir, "pages"))
