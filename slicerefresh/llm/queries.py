"""The operators' queries and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

import public_tokenizers

from slicerefresh.llm import bpe, decontam, exact_dedup, fim, jaccard, langid, lm, mixing, phrases, suffix, toxicity, urlgraph, warc
from slicerefresh.llm.shared import table


def op1_toxicity(spark, sf):
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_suffix_dedup(spark, sf):
    return suffix.remove_repeats(table(spark, sf, "documents")).drop("spans")


def op3_language_id(spark, sf):
    return langid.identify(table(spark, sf, "documents")).drop("rejected")


def op4_decontamination(spark, sf):
    return decontam.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op5_lm_scoring(spark, sf):
    return lm.pseudo_likelihood(table(spark, sf, "documents"))


def op6_jaccard_join(spark, sf):
    return jaccard.link_components(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_exact_dedup(spark, sf):
    return exact_dedup.exact_dedup(table(spark, sf, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_warc(spark, sf):
    return warc.archive_pages(table(spark, sf, "pages"))


def op10_url_filter(spark, sf):
    return urlgraph.judge(table(spark, sf, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op11_bpe_tokens(spark, sf):
    return bpe.digests(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_phrases(spark, sf):
    return phrases.collocations(table(spark, sf, "documents"))


def op13_fill_in_middle(spark, sf):
    return fim.fill_in_middle(table(spark, sf, "documents"))


def queries():
    return {
        "op1_toxicity": op1_toxicity,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_language_id": op3_language_id,
        "op4_decontamination": op4_decontamination,
        "op5_lm_scoring": op5_lm_scoring,
        "op6_jaccard_join": op6_jaccard_join,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_warc": op8_warc,
        "op9_mixing": op9_mixing,
        "op10_url_filter": op10_url_filter,
        "op11_bpe_tokens": op11_bpe_tokens,
        "op12_phrases": op12_phrases,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_UNITS = r"regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+')"

ORACLE = {
    "op12_phrases": rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
w AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS ws FROM t),
sizes AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, ws[i:i + d - 1] AS p, count(*) AS f
  FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w), (SELECT unnest(range(1, 6)) AS d)
  WHERE i + d - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1),
k AS (SELECT c.*, unnest(range(1, len(p))) AS k FROM c),
s AS (SELECT k.lang, k.p, k.a, k.k, x.f AS l, y.f AS r, n, (1000::HUGEINT * k.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.p = k.p[:k.k] JOIN f y ON y.lang = k.lang AND y.p = k.p[k.k + 1:] JOIN sizes z ON z.lang = k.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
i AS (SELECT DISTINCT lang, p[x.i:x.i + y.d - 1] AS p, a FROM c, (SELECT unnest(range(1, 5)) AS i) x, (SELECT unnest(range(2, 5)) AS d) y
  WHERE y.d < len(p) AND x.i + y.d - 1 <= len(p)),
m AS (SELECT lang, p, max(a) AS longer FROM i GROUP BY ALL),
r AS (SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM b LEFT JOIN m ON m.lang = b.lang AND m.p = b.p WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase::BLOB) AS rank FROM r) WHERE rank <= 2000""",
    "op13_fill_in_middle": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_UNITS} AS units, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
e AS (SELECT *, len(units)::BIGINT AS n, list_transform(range(4), lambda k: ('0x' || substr(h, 8 * k + 1, 8))::BIGINT) AS hs FROM d),
c AS (SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS low, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS high,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR hs[3] % 100 >= 50 THEN 'plain'
    WHEN hs[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM e),
p AS (SELECT *, array_to_string(units[:low], '') AS pre, array_to_string(units[low + 1:high], '') AS mid, array_to_string(units[high + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p""",
    "op7_exact_dedup": f"""
WITH t AS (SELECT doc_id, {_LOWER} AS low FROM documents),
g AS (SELECT low, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY low)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(low) AS text_sha256
FROM t JOIN g USING (low)""",
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
f AS (SELECT payload, min(page_id) AS first_page FROM p GROUP BY payload),
h AS (SELECT page_id, first_page, octet_length(encode(payload))::BIGINT AS payload_bytes,
  list_transform(range(8), lambda k: ('0x' || substr(sha1(payload), 5 * k + 1, 5))::BIGINT) AS groups FROM p JOIN f USING (payload))
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((groups[1 + i // 4] >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM h""",
    "op9_mixing": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source::BLOB) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS weight, 2 * source_size AS cap FROM s0),
s2 AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS step
  FROM s1 WINDOW w AS (ORDER BY cap / weight, weight, cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, max(CASE WHEN weight * step < cap THEN step END) OVER () AS level FROM s2),
s AS (SELECT source, source_size, least(cap::DOUBLE, weight * level) AS target FROM s3),
c0 AS (SELECT source, length(bin(size)) AS bits, sum(size)::BIGINT AS class_size FROM d GROUP BY ALL),
c1 AS (SELECT c0.*, source_size, target, 64 - bits AS level_weight, (64 - bits) * class_size AS weight, 2 * class_size AS cap
  FROM c0 JOIN s ON c0.source IS NOT DISTINCT FROM s.source WHERE class_size > 0),
c2 AS (SELECT *, (target - coalesce(sum(cap) OVER w, 0)) / (sum(weight) OVER (PARTITION BY source) - coalesce(sum(weight) OVER w, 0)) AS step
  FROM c1 WINDOW w AS (PARTITION BY source ORDER BY cap / weight, weight, cap ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c3 AS (SELECT *, max(CASE WHEN weight * step < cap THEN step END) OVER (PARTITION BY source) AS level FROM c2),
c4 AS (SELECT *, least(2.0::DOUBLE, coalesce(level_weight * level, 2.0::DOUBLE)) AS expected FROM c3),
c AS (SELECT *, floor(expected)::BIGINT AS certain, target - sum(floor(expected)::BIGINT * class_size) OVER (PARTITION BY source) AS quota FROM c4),
r0 AS (SELECT d.*, s.source_size, s.target, coalesce(c.certain, 0) AS certain, c.quota, c.expected - c.certain AS part,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM d LEFT JOIN c ON d.source IS NOT DISTINCT FROM c.source AND length(bin(d.size)) = c.bits AND d.size > 0
  LEFT JOIN s ON d.source IS NOT DISTINCT FROM s.source),
r AS (SELECT *, CASE WHEN part > 0 THEN (u / (1 - u)) / (part / (1 - part)) END AS rank FROM r0),
p AS (SELECT *, sum(CASE WHEN rank IS NULL THEN 0 ELSE size END) OVER (PARTITION BY source, rank IS NULL ORDER BY rank, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM r)
SELECT doc_id, size, source_size, target, (size * (certain + CASE WHEN rank IS NOT NULL AND upto - size / 2 <= quota THEN 1 ELSE 0 END))::BIGINT AS taken FROM p""",
}


def oracle_sql():
    return dict(ORACLE)
