"""Registered queries of the subpackage and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barsmith.llm import backoff_lm, dac_output, debruijn_dedup, entropy_mix, line_quality, merkle_manifest, minhash_bayes, minhash_forest, periodic_runs, piece_dropout, splitter_shards, suffix_dedup, trie_dedup
from barsmith.llm.runtime import read_documents


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary lies; every executor has the same installation."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge-dropout pieces of all ``documents``, stored and decoded from there."""
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    return piece_dropout.report(docs, tokenizer_path("piece_bpe_32k.model"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patricia-trie owners over all of ``documents``."""
    return trie_dedup.report(read_documents(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled splitters (law ``bytes``) over all of ``documents``."""
    return splitter_shards.report(read_documents(spark, sf_dir))


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directly addressable token files of all ``documents``, read back."""
    return dac_output.report(read_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and cross-document line frequency over all of ``documents``."""
    return line_quality.report(read_documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entropy balancing of all ``documents`` to the source targets."""
    return entropy_mix.report(read_documents(spark, sf_dir))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backoff-automaton scores of all ``documents``."""
    return backoff_lm.score(read_documents(spark, sf_dir))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LPF substring dedup of all documents' bytes."""
    return suffix_dedup.report(read_documents(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """De Bruijn substring dedup of all documents' words."""
    return debruijn_dedup.report(read_documents(spark, sf_dir))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jaccard links of all documents at 0.8, by MinHash prefixes of fixed depth."""
    return minhash_forest.report(read_documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of all ``documents``, some rows tampered with."""
    return merkle_manifest.report(read_documents(spark, sf_dir))


def op12_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents``, by banded MinHash and Bayesian verification."""
    return minhash_bayes.report(read_documents(spark, sf_dir))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all ``documents`` (some made periodic), found in a Re-Pair grammar."""
    return periodic_runs.report(read_documents(spark, sf_dir))


QUERIES = {
    "op8_jaccard_join": op8_jaccard_join,
    "op6_substring_dedup": op6_substring_dedup,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op1_sentencepiece": op1_sentencepiece,
    "op7_token_output": op7_token_output,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_sharding": op5_sharding,
    "op9_quality_rules": op9_quality_rules,
    "op10_mixing": op10_mixing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_minhash_dedup": op12_minhash_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

def _crc32(x: str) -> str:
    """SQL of the crc32 of ``x``, text of ASCII digits: eight shifts a byte."""
    codes = f"list_transform(string_split({x}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    byte = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {codes}), lambda a, b: {byte}))"


ORACLES: dict[str, str] = {
    "op11_merkle_manifest": r"""
WITH RECURSIVE d AS (SELECT *, coalesce('=' || lang, '-') AS tree FROM documents),
f AS (
  SELECT doc_id, tree, n_chars,
         list_transform([CAST(doc_id AS VARCHAR), source, lang], lambda x: coalesce(octet_length(encode(x)) || ':' || x, '-')) AS head,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail, """ + _crc32("CAST(doc_id AS VARCHAR)") + r""" % 7 = 0 AS hit
  FROM d),
l AS (
  SELECT doc_id, tree, hit,
         sha256(array_to_string(head, '') || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(array_to_string(head, '') || coalesce(length(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS changed
  FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM l),
low AS (
  SELECT tree, 0 AS h, rank, leaf AS node, count(*) OVER (PARTITION BY tree) AS n FROM r
  UNION ALL
  SELECT tree, h + 1, rank // 2, sha256(string_agg(node, '' ORDER BY rank)), CAST(ceil(any_value(n) / 2) AS BIGINT)
  FROM low WHERE n > 1 GROUP BY tree, h, rank // 2),
subs AS (SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS rank FROM low WHERE n = 1),
high AS (
  SELECT 0 AS h, rank, node, count(*) OVER () AS n FROM subs
  UNION ALL
  SELECT h + 1, rank // 2, sha256(string_agg(node, '' ORDER BY rank)), CAST(ceil(any_value(n) / 2) AS BIGINT)
  FROM high WHERE n > 1 GROUP BY h, rank // 2),
climb AS (
  SELECT r.doc_id, r.tree, r.leaf, r.rank AS at, 0 AS h, false AS top, s.node AS subroot, s.rank AS sub_rank,
         '' AS proof, CASE WHEN hit THEN changed ELSE leaf END AS node
  FROM r JOIN subs s ON r.tree = s.tree
  UNION ALL
  SELECT c.doc_id, c.tree, c.leaf,
         CASE WHEN NOT c.top AND low_n = 1 THEN c.sub_rank ELSE c.at // 2 END,
         CASE WHEN NOT c.top AND low_n = 1 THEN 0 ELSE c.h + 1 END, c.top OR low_n = 1, c.subroot, c.sub_rank,
         c.proof || CASE WHEN NOT c.top AND low_n = 1 THEN '' ELSE coalesce(other, '') END,
         CASE WHEN NOT c.top AND low_n = 1 THEN c.node
              WHEN c.at % 2 = 1 THEN sha256(coalesce(other, '') || c.node) ELSE sha256(c.node || coalesce(other, '')) END
  FROM (
    SELECT c.*, CASE WHEN c.top THEN hn.n ELSE ln.n END AS low_n, CASE WHEN c.top THEN ho.node ELSE lo.node END AS other
    FROM climb c
    LEFT JOIN low ln ON NOT c.top AND ln.tree = c.tree AND ln.h = c.h AND ln.rank = c.at
    LEFT JOIN low lo ON NOT c.top AND lo.tree = c.tree AND lo.h = c.h AND lo.rank = xor(c.at, 1)
    LEFT JOIN high hn ON c.top AND hn.h = c.h AND hn.rank = c.at
    LEFT JOIN high ho ON c.top AND ho.h = c.h AND ho.rank = xor(c.at, 1)) c
  WHERE NOT (c.top AND low_n = 1)),
done AS (SELECT * FROM climb WHERE top AND h = (SELECT max(h) FROM high)),
root AS (SELECT node FROM high WHERE n = 1)
SELECT doc_id, leaf, subroot, (SELECT node FROM root) AS root, sha256(proof) AS proof_sha256, node AS folded_root,
       node = (SELECT node FROM root) AS verified
FROM done""",
    "op4_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body,
         length(coalesce(text, '')) AS chars
  FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g""",
    "op12_minhash_dedup": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, hash(list_slice(ws, i, i + 1)) AS g
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2))) AS i FROM d WHERE len(ws) > 0))),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN sizes ON d.doc_id = sizes.doc_id
JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) r ON r.x = d.doc_id""",
    "op9_quality_rules": r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (
  SELECT doc_id, i, list_slice(ws, i, i + 4) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win),
spots AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice WHERE c > 1) GROUP BY doc_id),
ln AS (
  SELECT doc_id, host, pos, line, len(lw) AS words, lower(array_to_string(lw, ' ')) AS norm
  FROM (SELECT doc_id, host, pos, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw
        FROM (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d))
  WHERE len(lw) > 0),
keyed AS (SELECT doc_id, string_agg(norm, ' ' ORDER BY pos) AS k FROM ln GROUP BY doc_id),
hosts AS (
  SELECT host, count(DISTINCT coalesce(k, '')) AS docs FROM d LEFT JOIN keyed USING (doc_id) GROUP BY host),
freq AS (SELECT host, norm, count(DISTINCT k) AS n FROM ln JOIN keyed USING (doc_id) GROUP BY host, norm),
over AS (SELECT host, norm FROM freq JOIN hosts USING (host) WHERE n > 20 AND n > 0.02 * docs),
gone AS (SELECT doc_id, sum(words) AS gone FROM ln JOIN over USING (host, norm) GROUP BY doc_id),
dups AS (SELECT doc_id, CAST(sum(words) AS BIGINT) AS n_words, count(*) - count(DISTINCT line) AS n_dup_lines
         FROM ln GROUP BY doc_id),
base AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         gone, coalesce(n_words, 0) - coalesce(gone, 0) AS words_left
  FROM d LEFT JOIN dups USING (doc_id) LEFT JOIN spots USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND NOT (gone IS NOT NULL AND (words_left < 10 OR words_left < 0.3 * n_words)) AS kept,
       CAST(words_left AS BIGINT) AS words_left
FROM base""",
    "op3_suffix_dedup": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
win AS (
  SELECT doc_id, i, substr(hx, 2 * i - 1, 100) AS g
  FROM (SELECT doc_id, hx, unnest(range(1, length(hx) // 2 - 48)) AS i FROM d WHERE length(hx) >= 100)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first_doc FROM win)
  WHERE first_doc < doc_id),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM later)),
runs AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (gap) AS n_spans
  FROM (SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <> 1, true) AS gap FROM gone)
  GROUP BY doc_id),
kept AS (
  SELECT b.doc_id, string_agg(b.x, '' ORDER BY b.p) AS hx
  FROM (SELECT doc_id, p, substr(hx, 2 * p - 1, 2) AS x
        FROM (SELECT d.doc_id, hx, unnest(range(1, length(hx) // 2 + 1)) AS p FROM d JOIN runs ON d.doc_id = runs.doc_id)) b
  ANTI JOIN gone ON b.doc_id = gone.doc_id AND b.p = gone.p
  GROUP BY b.doc_id)
SELECT d.doc_id, length(d.hx) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN n_removed IS NULL THEN d.hx ELSE coalesce(kept.hx, '') END)) AS kept_sha256
FROM d LEFT JOIN runs ON d.doc_id = runs.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op6_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, list_slice(ws, i, i + 34) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d WHERE len(ws) >= 35)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS c FROM win) WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM twice)),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
kept AS (
  SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.p) AS t
  FROM words w ANTI JOIN gone ON w.doc_id = gone.doc_id AND w.p = gone.p GROUP BY w.doc_id),
counts AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN counts ON d.doc_id = counts.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id""",
    "op8_jaccard_join": r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, list_slice(ws, i, i + 4) AS g
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM d WHERE len(ws) > 0))),
sizes AS (SELECT doc_id, count(*) AS n, md5(string_agg(CAST(g AS VARCHAR), '|' ORDER BY g)) AS k FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y, p.k AS kx, q.k AS ky FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE c >= 0.8 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
classes AS (SELECT x AS doc_id, min(y) AS class_id FROM reach GROUP BY x),
counts AS (SELECT x AS doc_id, count(*) AS n_links, count(DISTINCT CASE WHEN kx <> ky THEN ky END) AS n_texts FROM links GROUP BY x)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links, coalesce(n_texts, 0) AS n_linked_texts
FROM classes LEFT JOIN counts USING (doc_id)""",
}
