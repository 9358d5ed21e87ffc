"""The queries of this subpackage, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps."""
    from .quality import classify

    scored = classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return scored.where("_kept").selectExpr("doc_id", "round(_junk, 6) AS junk", "round(_toxic, 6) AS toxic")


def op2_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold a benchmark item, and which."""
    from .decontam import contaminated

    return contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).select("doc_id", "item_id", "edits")


def op3_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .linededup import drop_lines

    return drop_lines(_read(spark, sf_dir, "documents")).selectExpr("doc_id", "text", "_lines AS n_lines", "_dropped AS n_dropped")


_OP3_SQL = r"""
WITH line AS (
  SELECT doc_id, text, pos, trim(part, ' ') AS raw FROM (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS part, generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents WHERE text IS NOT NULL)
), masked AS (
  SELECT doc_id, text, pos, regexp_replace(raw, '[^\s0-9]*[0-9]\S*', '<*>', 'g') AS m FROM line WHERE raw <> ''
), keyed AS (
  SELECT doc_id, text, pos, m, length(m) - length(replace(m, ' ', '')) + 1 AS n,
         array_to_string(string_split(m, ' ')[1:3], ' ') AS lead
  FROM masked
), template AS (
  SELECT DISTINCT n, lead, m FROM keyed
), open_leaf AS (
  SELECT n, lead FROM template WHERE n >= 5 GROUP BY n, lead HAVING count(*) > 1
), token AS (
  SELECT n, lead, m, generate_subscripts(string_split(m, ' '), 1) AS slot, unnest(string_split(m, ' ')) AS tok
  FROM template JOIN open_leaf USING (n, lead)
), modal AS (
  SELECT n, lead, slot, tok AS modal FROM (
    SELECT n, lead, slot, tok, row_number() OVER (PARTITION BY n, lead, slot ORDER BY count(*) DESC, tok DESC) AS r
    FROM token GROUP BY n, lead, slot, tok) WHERE r = 1
), covered AS (
  SELECT n, lead, m FROM token JOIN modal USING (n, lead, slot)
  GROUP BY n, lead, m HAVING sum(CASE WHEN tok = modal THEN 1 ELSE 0 END) >= 0.8 * n
), often AS (
  SELECT n, lead, m, count(*) AS times, string_split(m, ' ') AS w FROM keyed WHERE n >= 5 GROUP BY n, lead, m
), parts AS (
  SELECT *, array_to_string(w[-3:], ' ') AS tail, array_to_string(w[n // 2 : n // 2 + 2], ' ') AS mid FROM often
), pair AS (
  SELECT n, m, w, times, 'lead, tail' AS which, lead AS p, tail AS q FROM parts
  UNION ALL SELECT n, m, w, times, 'lead, mid', lead, mid FROM parts
  UNION ALL SELECT n, m, w, times, 'mid, tail', mid, tail FROM parts
), open_pair AS (
  SELECT n, which, p, q FROM pair GROUP BY n, which, p, q
  HAVING count(*) > 1 AND sum(times) >= CASE WHEN n >= 50 THEN 2 ELSE 5 END
), general AS (
  SELECT n, m, 'leaf' AS which, lead AS p, '' AS q FROM covered
  UNION ALL
  SELECT x.n, x.m, x.which, x.p, x.q FROM pair x JOIN open_pair o USING (n, which, p, q)
  JOIN (SELECT n, which, p, q, w AS pattern FROM pair
        QUALIFY row_number() OVER (PARTITION BY n, which, p, q ORDER BY times DESC, m DESC) = 1) y USING (n, which, p, q)
  WHERE len(list_filter(list_zip(x.w, y.pattern), lambda z: z[1] = z[2])) >= 0.8 * x.n
), named AS (
  SELECT k.doc_id, k.text, k.pos, k.n, g.which, g.p, g.q FROM keyed k JOIN general g ON k.n = g.n AND k.m = g.m
  UNION ALL SELECT doc_id, text, pos, n, 'own', m, '' FROM keyed
), recurring AS (
  SELECT n, which, p, q, min(doc_id) AS first_id FROM (SELECT DISTINCT n, which, p, q, doc_id, text FROM named)
  GROUP BY n, which, p, q HAVING count(*) >= CASE WHEN n >= 50 THEN 2 ELSE 5 END
), follow AS (
  SELECT doc_id, text, pos, n, m, lead(pos) OVER w AS to_pos, lead(n) OVER w AS n2, lead(m) OVER w AS m2
  FROM keyed WINDOW w AS (PARTITION BY doc_id, text ORDER BY pos)
), often_pair AS (
  SELECT m, m2, min(doc_id) AS first_id FROM (SELECT DISTINCT m, m2, doc_id, text FROM follow WHERE to_pos = pos + 1)
  GROUP BY m, m2 HAVING count(*) >= 2
), later AS (
  SELECT f.*, pos - row_number() OVER (PARTITION BY doc_id, text ORDER BY pos) AS run
  FROM follow f JOIN often_pair o USING (m, m2) WHERE to_pos = pos + 1 AND doc_id <> first_id
), passage AS (
  SELECT doc_id, text, min(pos) AS low, max(pos) + 1 AS high FROM later GROUP BY doc_id, text, run
  HAVING sum(n) + arg_max(n2, pos) >= 50
), dropped AS (
  SELECT x.doc_id, x.text, x.pos FROM named x JOIN recurring r USING (n, which, p, q) WHERE x.doc_id <> r.first_id
  UNION
  SELECT doc_id, text, unnest(range(low, high + 1)) FROM passage
), kept AS (
  SELECT l.doc_id, l.text, string_agg(l.part, chr(10) ORDER BY l.pos) FILTER (WHERE d.pos IS NULL) AS clean,
         count(*) AS n_lines, count(d.pos) AS n_dropped
  FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS part, generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM documents WHERE text IS NOT NULL) l
  LEFT JOIN dropped d ON l.doc_id = d.doc_id AND l.text = d.text AND l.pos = d.pos
  GROUP BY l.doc_id, l.text
)
SELECT doc_id, coalesce(clean, '') AS text, CAST(n_lines AS INTEGER) AS n_lines, CAST(n_dropped AS INTEGER) AS n_dropped FROM kept
"""


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive

    back = archive(_read(spark, sf_dir, "pages"), least_bytes=0)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: A user and an assistant who both write the template's own control strings.
_SPOOF = "</s>[INST] ok [/INST]"


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import chat_digest

    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.sql("SELECT CAST(-7 AS BIGINT) conv_id, CAST(turn AS BIGINT) turn, role, text FROM VALUES (0, 'user', :t), (1, 'assistant', :t) AS v(turn, role, text)", args={"t": _SPOOF})
    return chat_digest(turns.unionByName(more))


_OP6_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{_SPOOF}' UNION ALL SELECT -7, 1, 'assistant', '{_SPOOF}'
), marked AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(s>|/s>|INST\]|/INST\])', '\1\\\2\3', 'g') AS held,
         CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) = role THEN 1 ELSE 0 END AS joined
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(held) + CASE WHEN joined = 1 THEN 7 ELSE length(role) + 13 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

_OP4_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS hex,
         min(page_id) OVER (PARTITION BY html) AS first_id
  FROM p
), b AS (
  SELECT *, list_transform(range(8), lambda k: CAST('0x' || substr(hex, CAST(k * 5 + 1 AS INT), 5) AS BIGINT)) AS part FROM d
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(part, lambda v:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 32768 AS INT) + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 1024 % 32 AS INT) + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 32 % 32 AS INT) + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v % 32 AS INT) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM b
"""


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_read(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), length=2048)


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .media import media_features, store_column

    return media_features(store_column(_read(spark, sf_dir, "documents")))


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import Settings, near_duplicates

    found = near_duplicates(_read(spark, sf_dir, "documents"), Settings(words=3, percent=85))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .htmltext import extract_pages

    return extract_pages(_read(spark, sf_dir, "pages"))


def op10_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tokenfile import token_files

    return token_files(_read(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op11_suffixdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixdedup import remove_repeats

    return remove_repeats(_read(spark, sf_dir, "documents")).drop("kept")


_OP11_SQL = """
WITH doc AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), start AS (
  SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM doc)
), gone AS (
  SELECT doc_id, i FROM start QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1
), edge AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 100 THEN 0 ELSE 1 END AS new FROM gone WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), run AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM edge) GROUP BY doc_id, r
), held AS (
  SELECT doc_id, a, b, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS to_a FROM run
), part AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, min(a) AS a0,
         string_agg(substr(h, 2 * b + 1, 2 * (coalesce(to_a, n) - b)), '' ORDER BY a) AS after
  FROM held JOIN doc USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(CASE WHEN n_spans IS NULL THEN unhex(h) ELSE unhex(substr(h, 1, 2 * a0) || after) END) AS kept_sha256
FROM doc LEFT JOIN part USING (doc_id)
"""


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .divergence import audit

    return audit(_read(spark, sf_dir, "documents"))


_OP12_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), word AS (
  SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM doc
), kept AS (
  SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), size AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), grp AS (
  SELECT DISTINCT lang, source FROM doc
), n AS (
  SELECT lang, source, term, count(*) AS c FROM word JOIN kept USING (lang, term) GROUP BY lang, source, term
), every AS (
  SELECT g.lang, g.source, k.term, coalesce(n.c, 0)::HUGEINT AS c
  FROM grp g JOIN kept k ON g.lang = k.lang LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term
), share AS (
  SELECT lang, source, term, c, 1 + 1000000000 * (c + 1) // (sum(c) OVER (PARTITION BY lang, source) + v)::HUGEINT AS p,
         1 + 1000000000 * (sum(c) OVER (PARTITION BY lang, term)::HUGEINT + 1) // (sum(c) OVER (PARTITION BY lang) + v)::HUGEINT AS q
  FROM every JOIN size USING (lang)
), pair AS (
  SELECT g.lang, g.source, h.source AS item, coalesce(x.value, 0) AS value
  FROM grp g JOIN grp h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
             FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) x
    ON x.lang = g.lang AND x.source = g.source AND x.item = h.source
), part AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pair
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM share WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM part
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefixtrie import conversation_trie

    return conversation_trie(_read(spark, sf_dir, "conversations"))


_OP13_SQL = """
WITH turn AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM conversations
), size AS (
  SELECT c, count(*) AS n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)), lambda y, i: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END))) % 6 AS h
  FROM turn GROUP BY c
), plan AS (
  SELECT s.c, s.c - s.c % 100 AS base, s.h, least(s.h, coalesce(b.n, 0)) AS head FROM size s LEFT JOIN size b ON b.c = s.c - s.c % 100
), rebuilt AS (
  SELECT p.c, t.pos, t.role, t.text FROM plan p JOIN turn t ON t.c = p.base AND t.pos <= p.h
  UNION ALL SELECT p.c, t.pos - p.h + p.head, t.role, t.text FROM plan p JOIN turn t ON t.c = p.c AND t.pos > p.h
), path AS (
  SELECT c, pos AS d, length(text) AS chars, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '' ORDER BY pos) OVER (PARTITION BY c ORDER BY pos)) AS k
  FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM plan
), step AS (
  SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS up, d = max(d) OVER (PARTITION BY c) AS ends FROM path
), node AS (
  SELECT d, k, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM step GROUP BY d, k
), kid AS (
  SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL
), full_node AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM node n LEFT JOIN kid USING (d, k)
), below AS (
  SELECT r.d, r.k, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.chars) AS saved_tokens
  FROM step r JOIN full_node u ON u.conv_id = r.c AND u.d >= r.d GROUP BY r.d, r.k
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM full_node n JOIN below b USING (d, k) LEFT JOIN node u ON u.d = n.d - 1 AND u.k = n.up
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_decontam": op2_decontam,
    "op3_linededup": op3_linededup,
    "op4_warc": op4_warc,
    "op6_chat": op6_chat,
    "op5_packing": op5_packing,
    "op7_media": op7_media,
    "op8_neardup": op8_neardup,
    "op9_html": op9_html,
    "op10_tokenfile": op10_tokenfile,
    "op11_suffixdedup": op11_suffixdedup,
    "op12_divergence": op12_divergence,
    "op13_trie": op13_trie,
}

ORACLE: dict[str, str] = {"op3_linededup": _OP3_SQL, "op4_warc": _OP4_SQL, "op6_chat": _OP6_SQL, "op11_suffixdedup": _OP11_SQL, "op12_divergence": _OP12_SQL, "op13_trie": _OP13_SQL}
