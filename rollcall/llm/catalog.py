"""The registered query of each operator, over whole tables with the parameters of production,
and SQL where it can say the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (
    bpe,
    chat_format,
    exact_dedup,
    fingerprint,
    hard_negatives,
    language,
    line_dedup,
    near_dedup,
    packing,
    prefix_trie,
    quality,
    toxicity,
    warc,
)
from rollcall.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The conversation that holds the template's own control strings.
CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def sites() -> dict[str, Column]:
    """Documents have no address: the source is the host, source and language are the path."""
    return {"host": F.col("source"), "path": F.concat_ws("/", "source", "lang")}


@_query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    judged = quality.classify(read(spark, sf_dir, "documents"), labels, **sites())
    # Rounded here, and only here, so that they compare equal with the SQL.
    return judged.withColumns({n: F.round(n, 6) for n in ("evidence", "site", "score")})


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file is installed, on the driver and every executor alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")
    )


@_query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


@_query
def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edits(read(spark, sf_dir, "documents"))


@_query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = tokenizer_path("byte_bpe_50k.json")
    encoded = bpe.encode(read(spark, sf_dir, "documents"), tokenizer)
    return bpe.digest(bpe.decode(encoded, tokenizer))


@_query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.new_archive(read(spark, sf_dir, "pages"))
    return warc.read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@_query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


@_query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_repeated_lines(read(spark, sf_dir, "documents"))


@_query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.mark_duplicates(read(spark, sf_dir, "documents"))


@_query
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digest(chat_format.expand(turns.unionByName(added)))


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


@_query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


@_query
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


ORACLES["op6_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
         max(page_id) OVER (PARTITION BY payload) AS latest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> latest THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> latest THEN latest END AS refers_to
FROM d
"""

ORACLES["op8_line_dedup"] = r"""
WITH d AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d
), w AS (
  SELECT doc_id, pos, line, line || chr(10) || lead(line, 1) OVER o || chr(10)
           || lead(line, 2) OVER o AS passage
  FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), f AS (
  SELECT doc_id, pos,
         row_number() OVER (PARTITION BY passage ORDER BY doc_id, pos) > 1 AS later
  FROM w WHERE passage IS NOT NULL AND trim(replace(passage, chr(10), '')) <> ''
), c AS (
  SELECT l.doc_id, l.pos, l.line, coalesce(bool_or(f.later), false) AS covered
  FROM l LEFT JOIN f ON f.doc_id = l.doc_id AND f.pos BETWEEN l.pos - 2 AND l.pos
  GROUP BY ALL
), k AS (
  SELECT doc_id, count(*) FILTER (covered) AS removed_lines,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT covered), '') AS kept
  FROM c GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(d.lines), 0) AS n_lines,
       coalesce(k.removed_lines, 0) AS removed_lines,
       CASE WHEN k.removed_lines > 0 THEN k.kept ELSE d.text END AS text
FROM d LEFT JOIN k USING (doc_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op9_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(plain) AS text_sha256
FROM (SELECT doc_id, {_LOWER} AS plain FROM documents)
WINDOW same AS (PARTITION BY plain)
"""

ORACLES["op10_chat_format"] = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')
), e AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place,
         count(*) OVER (PARTITION BY conv_id) AS turns,
         22 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'),
                                    '<(\\*)\|', '<\1\\|', 'g')) + 2
           + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) AS chars
  FROM t
), c AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY place) AS upto FROM e
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       sum(upto) FILTER (role = 'assistant' OR place = turns)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

ORACLES["op7_near_dedup"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(
           CASE WHEN len(words) >= 5
                THEN list_transform(range(1, len(words) - 3), lambda i: words[i:i + 4])
                WHEN len(words) > 0 THEN [words] ELSE [] END) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT one, two FROM p JOIN n x ON x.doc_id = one JOIN n y ON y.doc_id = two
  WHERE 100 * shared >= 75 * (x.size + y.size - shared)
), e AS (
  SELECT one, two FROM l UNION ALL SELECT two, one FROM l
), r AS (
  SELECT doc_id, doc_id AS reached FROM documents
  UNION
  SELECT r.doc_id, e.two FROM r JOIN e ON e.one = r.reached
)
SELECT doc_id, coalesce(any_value(size), 0) AS n_shingles, min(reached) AS component_id,
       doc_id = min(reached) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

_SITE_STRENGTH = """
  CASE WHEN sum(rows * (good / rows - mean) ** 2) > sum(mean * (1 - mean))
       THEN least(greatest(sum(rows * mean * (1 - mean))
              / (sum(rows * (good / rows - mean) ** 2) - sum(mean * (1 - mean))) - 1, 1.0), 1e6)
       ELSE 1e6 END"""


def _counted(signs: str) -> str:
    return f"length(text) - length(regexp_replace(text, '[{signs}]', '', 'g'))"


_FIGURES = [
    (_counted("A-Z"), "strlen(text)"),
    (_counted(r"#$%&*+/<=>@\[\\\]^_`{}~"), "strlen(text)"),
    (_counted("|"), "strlen(text)"),
    (_counted("!?"), "strlen(text)"),
    (_counted("0-9"), "strlen(text)"),
    ("len(list_filter(range(1, len(words)), lambda i: words[i] = words[i + 1]))", "len(words) - 1"),
]
_BINNED = " UNION ALL ".join(
    f"""SELECT doc_id, source, lang, {k} AS figure, CASE WHEN {part} <= 0 THEN 0 ELSE
      least(greatest(ceil(2 * log2(({part})::DOUBLE / greatest({whole}, 1))) + 31, 1), 31) END AS bin
  FROM w"""
    for k, (part, whole) in enumerate(_FIGURES)
)
ORACLES["op1_quality"] = rf"""
WITH w AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), b AS ({_BINNED}
), y AS (
  SELECT doc_id, avg(quality) AS good, count(*) AS times, sum(quality) AS total
  FROM labels WHERE quality IN (0, 1) GROUP BY doc_id
), k AS (
  SELECT figure, bin, sum(total) AS good, sum(times - total) AS bad
  FROM b JOIN y USING (doc_id) GROUP BY ALL
), g AS (
  SELECT sum(good) / sum(good + bad) AS share, ln(sum(good) / sum(bad)) AS prior
  FROM k WHERE figure = 0
), t AS (
  SELECT figure, bin, ln((good + 2 * share) / (bad + 2 * (1 - share))) - prior AS ratio FROM k, g
), e AS (
  SELECT b.doc_id, any_value(source) AS source, any_value(lang) AS lang,
         sum(coalesce(ratio, 0)) AS evidence
  FROM b LEFT JOIN t USING (figure, bin) GROUP BY b.doc_id
), p AS (
  SELECT source, concat_ws('/', source, lang) AS path, count(*) AS rows,
         sum(coalesce(good, 1 / (1 + exp(-(evidence + prior))))) AS good
  FROM e LEFT JOIN y USING (doc_id), g GROUP BY ALL
), h AS (
  SELECT source, sum(good) AS good, sum(rows) AS rows, any_value(share) AS mean
  FROM p, g GROUP BY source
), hs AS (SELECT {_SITE_STRENGTH} AS strength FROM h
), m AS (
  SELECT source, (good + strength * mean) / (rows + strength) AS mean FROM h, hs
), n AS (SELECT p.*, mean FROM p JOIN m USING (source)
), ps AS (SELECT {_SITE_STRENGTH} AS strength FROM n
), o AS (
  SELECT source, path,
         least(greatest((good + strength * mean) / (rows + strength), 1e-6), 1 - 1e-6) AS share
  FROM n, ps
), f AS (
  SELECT e.doc_id, evidence, ln(o.share / (1 - o.share)) AS site
  FROM e JOIN o ON o.path = concat_ws('/', e.source, e.lang)
)
SELECT doc_id, round(evidence, 6) AS evidence, round(site, 6) AS site,
       round(1 / (1 + exp(-(evidence + site))), 6) AS score,
       1 / (1 + exp(-(evidence + site))) >= 0.5 AS kept
FROM f
"""

ORACLES["op12_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
         list_inner_product(a.vec, o.vec)::BIGINT AS score
  FROM v a JOIN v o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INT
         AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

# The unsigned CRC-32 of the decimal conv_id, bit by bit.
_CRC = """
  xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
    lambda crc, byte: list_reduce(range(8),
      lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
      xor(crc, byte)), 4294967295), 4294967295)"""
ORACLES["op11_prefix_trie"] = f"""
WITH c AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
           ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT *, {_CRC} % 6 AS h FROM c
), r AS (
  SELECT h.conv_id, list_concat(coalesce(c.turns[1:h], []), h.turns[h + 1:]) AS turns
  FROM h LEFT JOIN c ON c.conv_id = h.conv_id - h.conv_id % 100
), m AS (
  SELECT conv_id, len(turns) AS n, turns, unnest(range(len(turns) + 1)) AS depth FROM r
), n AS (
  SELECT turns[1:depth] AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')
           AS ends,
         coalesce(any_value(length(turns[depth].text)), 0) AS chars
  FROM m GROUP BY 1, 2
), l AS (
  SELECT n.*, NOT EXISTS (
           FROM n k WHERE k.depth = n.depth + 1 AND k.prefix[1:n.depth] = n.prefix) AS leaf
  FROM n
), s AS (
  SELECT a.prefix, a.depth, count(*) FILTER (b.depth = a.depth + 1) AS n_children,
         sum((b.n_convs - 1) * b.chars)::BIGINT AS saved_tokens,
         count(*) FILTER (b.leaf) AS n_leaves
  FROM n a JOIN l b ON b.depth >= a.depth AND b.prefix[1:a.depth] = a.prefix
  GROUP BY 1, 2
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves,
       s.saved_tokens, sha256(n.ends) AS ends_sha256,
       CASE WHEN n.depth > 0 THEN sha256(concat_ws(':', length(n.prefix[n.depth].role)::VARCHAR,
         n.prefix[n.depth].role, n.prefix[n.depth].text)) END AS turn_sha256
FROM n JOIN s ON s.depth = n.depth AND s.prefix = n.prefix
LEFT JOIN n p ON p.depth = n.depth - 1 AND p.prefix = n.prefix[1:n.depth - 1]
"""
