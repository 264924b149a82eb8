"""Registered queries of the corpus operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


@register("op5_quality")
def op5_quality(spark, sf_dir):
    from .quality import quality
    q = table(spark, sf_dir, "documents").select("doc_id", quality(F.col("text")).alias("q"))
    return q.select("doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines", "q.n_repeat_words",
                    "q.base_failed", "q.kept", F.round("q.ratio", 6).alias("ratio"), "q.verdict")


OP6_SQL = """
WITH sized AS (
  SELECT doc_id, source, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
  FROM sized GROUP BY source),
steps AS (
  SELECT *, 1.5e0 * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER before, 0) AS open_words,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open_w
  FROM src
  WINDOW before AS (ORDER BY 2e0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT open_words, open_w FROM steps
  WHERE w * open_words / open_w <= 2e0 * source_size ORDER BY 2e0 * source_size / w, source NULLS LAST LIMIT 1),
tgt AS (
  SELECT s.source, s.source_size,
         CAST(CASE WHEN s.w * l.open_words / l.open_w > 2 * s.source_size THEN 2 * s.source_size
              ELSE s.w * l.open_words / l.open_w END AS DOUBLE) AS target
  FROM src s LEFT JOIN level l ON true),
runs AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN tgt t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN before + size / 2e0 <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM runs
"""


@register("op6_mixing", OP6_SQL)
def op6_mixing(spark, sf_dir):
    from .mixing import mix
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


@register("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    import public_tokenizers

    from .token_counts import token_counts
    out = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.withColumn("over_limit", F.col("n_tokens") > 1024)


@register("op7_language")
def op7_language(spark, sf_dir):
    from .language import held_out, language, train
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), language(F.col("text"), model).alias("l"))
    return out.select("doc_id", "held_out", F.col("l.lang").alias("lang_pred"), "l.score", "l.languages")


@register("op9_token_files")
def op9_token_files(spark, sf_dir):
    import public_tokenizers

    from .token_files import token_files
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), by_words=True)


@register("op3_minhash")
def op3_minhash(spark, sf_dir):
    from .minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


@register("op4_pieces")
def op4_pieces(spark, sf_dir):
    import public_tokenizers

    from .pieces import digest
    path = public_tokenizers.path("piece_bpe_32k.model")
    return table(spark, sf_dir, "documents").select("doc_id", digest(F.col("text"), path).alias("d")).select("doc_id", "d.*")


@register("op1_vectors", """
WITH e AS (
  SELECT vec_id, label, embedding, len(embedding) AS d,
         embedding IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
         AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
         AND len([x FOR x IN embedding IF x <> 0]) > 0 AS ok
  FROM embeddings),
u AS (
  SELECT vec_id, label, d, [CAST(x AS DOUBLE) FOR x IN embedding] AS u FROM e WHERE ok),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
  ON a.label = b.label AND a.d = b.d AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.u, b.u) >= 0.98e0),
reach AS (
  WITH RECURSIVE r(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a)
  SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM e JOIN reach r ON r.a = e.vec_id
""")
def op1_vectors(spark, sf_dir):
    from .vectors import near_vectors
    return near_vectors(table(spark, sf_dir, "embeddings"))


@register("op8_html_text")
def op8_html_text(spark, sf_dir):
    from .html_text import main_text, train
    pages = table(spark, sf_dir, "pages")
    out = pages.select("page_id", "url", main_text(F.col("html"), train(pages)).alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


#: Tools that the turns of ``conversations`` call: a user turn asks for an answer.
CHAT_SCHEMAS = {"answer": {"text": {"type": "string", "required": True, "longest": 400},
                           "turn": {"type": "integer", "required": True, "least": 0},
                           "words": {"type": "integer", "required": True, "least": 1}}}


def chat_events(conversations: DataFrame) -> DataFrame:
    """The turns as events: a user turn is a call of the tool ``answer`` that
    refers to the answer before it, an assistant turn the result of the call
    of the turn before it, a system turn a message."""
    from .mixing import n_words
    kind = F.when(F.col("role") == "user", "call").when(F.col("role") == "assistant", "result").otherwise("message")
    call = F.col("role") == "user"
    name = lambda back: F.concat(F.lit("call-"), (F.col("turn") - back).cast("string"))
    args = F.to_json(F.struct(n_words(F.col("text")).alias("words"), "turn", "text"), {"ignoreNullFields": "false"})
    return conversations.select(
        F.col("conv_id").alias("conv"), "turn", "role", kind.alias("kind"),
        F.when(call, name(0)).when(F.col("role") == "assistant", name(1)).alias("id"),
        F.when(call, F.lit("answer")).alias("tool"), F.when(call, args).alias("arguments"),
        F.when(call, F.array(name(2))).alias("refs"), "text")


@register("op10_tool_calls", """
WITH e AS (
  SELECT conv_id AS conv, turn, role, text,
         CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
         CASE role WHEN 'user' THEN 'call-' || turn WHEN 'assistant' THEN 'call-' || (turn - 1) END AS id,
         len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM conversations),
c AS (SELECT conv, turn FROM e WHERE kind = 'call'),
r AS (SELECT conv, turn FROM e WHERE kind = 'result'),
f AS (
  SELECT e.*, c.conv IS NOT NULL AS has_call, r.conv IS NOT NULL AS has_result,
         CASE WHEN e.kind = 'call' THEN concat_ws('; ', CASE WHEN text IS NULL THEN 'text: not string' WHEN length(text) > 400 THEN 'text: too long' END,
              CASE WHEN e.turn < 0 THEN 'turn: out of range' END, CASE WHEN coalesce(words, 0) < 1 THEN 'words: out of range' END) END AS faults
  FROM e LEFT JOIN c ON c.conv = e.conv AND c.turn = e.turn - 1 LEFT JOIN r ON r.conv = e.conv AND r.turn = e.turn + 1)
SELECT conv, turn, kind, id, status, turn AS place_turn, CAST(0 AS BIGINT) AS place_depth, false AS cyclic,
       CASE WHEN kind = 'call' THEN faults = '' END AS valid, faults,
       CASE kind WHEN 'call' THEN '{"arguments":{"text":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"turn":' || turn || ',"words":' || coalesce(words, 0)
              || '},"id":"' || id || '","kind":"call","role":"user","tool":"answer","valid":' || CASE WHEN faults = '' THEN 'true' ELSE 'false' END || '}'
            WHEN 'result' THEN '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"id":"' || id || '","kind":"result","role":"assistant","status":"' || status || '"}'
            ELSE '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"kind":"message","role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || '}' END AS line
FROM (SELECT *, CASE kind WHEN 'message' THEN 'message' WHEN 'call' THEN CASE WHEN has_result THEN 'answered' ELSE 'unanswered' END
                ELSE CASE WHEN has_call THEN 'linked' ELSE 'orphan' END END AS status FROM f)
""")
def op10_tool_calls(spark, sf_dir):
    from .tool_calls import format_chat
    return format_chat(chat_events(table(spark, sf_dir, "conversations")), CHAT_SCHEMAS)


@register("op13_merkle", """
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, n_chars, text,
         list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
           lambda s, b: list_reduce([xor(s, b)] || list_transform(range(8), lambda i: CAST(0 AS BIGINT)),
             lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) & 1 AS odd_state
  FROM documents),
l AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, row_number() OVER () AS row,
         sha256(head || coalesce(CAST(strlen(text) AS VARCHAR) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(CAST(strlen(seen) AS VARCHAR) || ':' || seen, '-')) AS found
  FROM (SELECT *, CASE WHEN odd_state = 1 THEN replace(text, chr(10), '') ELSE text END AS seen,
               coalesce(CAST(strlen(CAST(doc_id AS VARCHAR)) AS VARCHAR) || ':' || doc_id, '-')
               || coalesce(CAST(strlen(source) AS VARCHAR) || ':' || source, '-')
               || coalesce(CAST(strlen(lang) AS VARCHAR) || ':' || lang, '-')
               || coalesce(CAST(strlen(CAST(n_chars AS VARCHAR)) AS VARCHAR) || ':' || n_chars, '-') AS head
        FROM d)),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, row) - 1 AS pos FROM l),
up AS (
  SELECT tree, 0 AS level, pos, leaf AS h FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM up) WHERE n > 1 GROUP BY tree, level, pos // 3),
depth AS (SELECT tree, max(level) AS depth FROM up GROUP BY tree),
sub AS (SELECT up.tree, h, depth, row_number() OVER (ORDER BY up.tree) - 1 AS pos FROM up JOIN depth ON up.tree = depth.tree AND level = depth),
top AS (
  SELECT 0 AS level, pos, h FROM sub
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY level, pos // 3),
root AS (SELECT level AS depth, h AS root FROM top ORDER BY level DESC LIMIT 1),
steps AS (
  SELECT row, k.step, leaves.tree, CAST(NULL AS BIGINT) AS sub_pos, leaves.pos // CAST(pow(3, k.step) AS BIGINT) AS pos, k.step AS level
  FROM leaves JOIN depth USING (tree), range(64) AS k(step) WHERE k.step < depth.depth
  UNION ALL
  SELECT row, sub.depth + k.step, NULL, sub.pos, sub.pos // CAST(pow(3, k.step) AS BIGINT), k.step
  FROM leaves JOIN sub USING (tree), root, range(64) AS k(step) WHERE k.step < root.depth),
sides AS (
  SELECT s.row, s.step, coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (WHERE n.pos < s.pos), '') AS lefts,
         coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (WHERE n.pos > s.pos), '') AS rights
  FROM steps s JOIN (SELECT tree, level, pos, h FROM up UNION ALL SELECT NULL, level, pos, h FROM top) n
  ON n.tree IS NOT DISTINCT FROM s.tree AND n.level = s.level AND n.pos // 3 = s.pos // 3
  GROUP BY s.row, s.step, s.pos),
fold AS (
  SELECT row, 0 AS step, found AS h FROM leaves
  UNION ALL
  SELECT f.row, f.step + 1, sha256(lefts || h || rights) FROM fold f JOIN sides s ON s.row = f.row AND s.step = f.step),
folded AS (SELECT row, arg_max(h, step) AS h FROM fold GROUP BY row),
proof AS (SELECT row, string_agg(lefts || rights, '' ORDER BY step) AS p FROM sides GROUP BY row)
SELECT leaves.doc_id, leaves.leaf, sub.h AS subroot, root.root, sha256(coalesce(p, '')) AS proof_sha256, folded.h AS folded_root,
       folded.h = root.root AS verified
FROM leaves JOIN sub USING (tree) JOIN folded ON folded.row = leaves.row LEFT JOIN proof ON proof.row = leaves.row, root
""")
def op13_merkle(spark, sf_dir):
    from .merkle import dataset_manifest, tampered
    docs = table(spark, sf_dir, "documents")
    out = dataset_manifest(docs, tampered(F.col("text"), F.col("doc_id")))
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@register("op12_compression")
def op12_compression(spark, sf_dir):
    from .compression_classifier import THRESHOLD, held_out, score, train
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    out = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(F.col("text"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


@register("op11_collocations", """
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^ \\t]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents WHERE text IS NOT NULL)),
grams AS (
  SELECT lang, size, phrase, count(*) AS f
  FROM (SELECT lang, 1 AS size, unnest(w) AS phrase FROM pieces
        UNION ALL SELECT lang, 2, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM pieces
        UNION ALL SELECT lang, 3, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) FROM pieces)
  GROUP BY lang, size, phrase),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS w, f AS a FROM grams WHERE size > 1 AND f >= 10),
split AS (
  SELECT lang, size, phrase, a, k.k, array_to_string(w[1:k.k], ' ') AS head, array_to_string(w[k.k + 1:], ' ') AS tail
  FROM cand, range(1, 3) AS k(k) WHERE k.k < size),
cuts AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.k, h.f AS l, t.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
  FROM split c JOIN grams h ON h.lang = c.lang AND h.phrase = c.head AND h.size = c.k
  JOIN grams t ON t.lang = c.lang AND t.phrase = c.tail AND t.size = c.size - c.k),
worst AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase, size ORDER BY score, k) AS o FROM cuts),
inner_pairs AS (
  SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cand WHERE size = 3
  UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE size = 3),
longer AS (SELECT lang, phrase, max(a) AS longer FROM inner_pairs GROUP BY lang, phrase),
kept AS (
  SELECT w.* FROM worst w LEFT JOIN longer x ON x.lang = w.lang AND x.phrase = w.phrase AND w.size = 2
  WHERE w.o = 1 AND (x.longer IS NULL OR 100 * x.longer < 50 * w.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
""")
def op11_collocations(spark, sf_dir):
    from .collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))
