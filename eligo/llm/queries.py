"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eligo.llm.chat import format_conversations, read_loss_text, read_turns
from eligo.llm.common import read_table
from eligo.llm.decontaminate import contamination
from eligo.llm.exact_dedup import exact_dedup
from eligo.llm.fim import fill_in_middle, restored
from eligo.llm.langid import held_out, predict_language, train_language_model
from eligo.llm.license_scan import license_scan
from eligo.llm.line_dedup import line_dedup
from eligo.llm.packing import pack
from eligo.llm.secret_scan import BASE_RULES, of_kinds, scan_history, span_text
from eligo.llm.shard import assign_shards, grow, layout
from eligo.llm.simhash import simhash_dedup
from eligo.llm.vector_codes import code_text, codebooks_digest, compress, with_label_error
from eligo.llm.warc import read_warc, write_warc


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(read_table(spark, sf_dir, "documents"), shingle_words=3, max_distance=3)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), window=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["length"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("spans") > 0).alias("contaminated"))


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = layout(24)
    return assign_shards(read_table(spark, sf_dir, "documents"), tree, grow(tree))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = train_language_model(docs.where(~held_out(F.col("doc_id"))))
    return predict_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(read_table(spark, sf_dir, "documents"))
    return found.withColumn("licenses", F.array_join("licenses", ","))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")],
                                  "conv_id bigint, turn bigint, role string, text string")
    out = format_conversations(turns.unionByName(extra)).select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
        read_loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"),
                      F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                      F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                      F.length("formatted").cast("bigint").alias("formatted_chars"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_warc(read_table(spark, sf_dir, "pages"), min_bytes=0)
    return read_warc(index).select(F.col("page_id").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest",
                                   "record_type", F.col("refers_to").cast("bigint").alias("refers_to"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read_table(spark, sf_dir, "documents"), min_sites=10).select(
        "doc_id", "text", "n_lines", "n_removed")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), tokenizer_path(), capacity=4096, end_id=1)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(read_table(spark, sf_dir, "embeddings"))
    return with_label_error(codes).select("vec_id", code_text(F.col("codes")).alias("code"), "error", "label_error",
                                          F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_history(read_table(spark, sf_dir, "documents"))
    def number(kind):
        return F.size(of_kinds(F.col("findings"), [kind])).cast("bigint").alias(f"n_{kind}")
    base = [r.kind for r in BASE_RULES]
    return found.select("doc_id", *map(number, base),
                        F.sha2(span_text(of_kinds(F.col("findings"), base)), 256).alias("base_sha256"),
                        span_text(F.col("findings")).alias("spans"))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_decontaminate, op3_shard, op4_language_id, op5_license_scan, op6_chat_format, op7_warc,
    op8_line_dedup, op9_exact_dedup, op10_packing, op11_fill_in_middle, op12_vector_codes, op13_secret_scan)}

# ---- DuckDB SQL, written from the contracts, not from the plans ---------------

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')," \
         r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP2 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s, least(10, len(w)) AS m
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS s
  FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
        FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
hit AS (SELECT doc_id, i, dw.m, item_id FROM dw JOIN win USING (s, m)),
per AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + m - 1)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _escaped(column: str) -> str:
    sql = f"replace({column}, chr(92), chr(92) || chr(92))"
    for c in ("<s>", "</s>", "[ROLE]", "[/ROLE]", "[NEXT]", "[INST]", "[/INST]"):
        sql = f"replace({sql}, '{c}', '{c[0]}' || chr(92) || '{c[1:]}')"
    return sql


_OP6 = f"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
p AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(length({_escaped('text')})
             + CASE WHEN before IS NOT DISTINCT FROM role THEN 6 ELSE 13 + 4 + length({_escaped('role')}) END)
        )::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""

_OP8 = """
WITH l AS (SELECT doc_id, source, pos, line, length(trim(line, ' ')) >= 16 AS counts
           FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                        generate_subscripts(string_split(text, chr(10)), 1) AS pos
                 FROM documents)),
bad AS (SELECT line, min(doc_id) AS first FROM l WHERE counts GROUP BY line HAVING count(DISTINCT source) >= 10),
f AS (SELECT l.*, bad.line IS NOT NULL AND l.doc_id <> bad.first AS gone
      FROM l LEFT JOIN bad ON l.counts AND l.line = bad.line)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text,
       count(*) AS n_lines, count(*) FILTER (gone) AS n_removed
FROM f GROUP BY doc_id
"""

_OP9 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(text) AS text_sha256
FROM d WINDOW g AS (PARTITION BY text)
"""

_OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t
  FROM documents),
u AS (
  SELECT *, len(t) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(t) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (len(t) + 1) AS y,
         CASE WHEN text = '' OR text LIKE '%<P>%' OR text LIKE '%<S>%' OR text LIKE '%<M>%'
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
c AS (
  SELECT doc_id, n, form, text, array_to_string(t[1:least(x, y)], '') AS p,
         array_to_string(t[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(t[greatest(x, y) + 1:], '') AS s
  FROM u)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""


def _op12() -> str:
    """Codebooks by rounds of plain SQL: parts joined to the entries of their position, nearest by (distance, index)."""
    def nearest(books: str) -> str:
        away = "list_sum(list_transform(range(1, len(p.a) + 1), lambda k: (p.a[k] - b.c[k]) * (p.a[k] - b.c[k])))"
        return (f"SELECT p.vec_id, p.part, p.a, min(struct_pack(away := CAST({away} AS BIGINT), entry := b.entry)) AS best "
                f"FROM parts p JOIN {books} b USING (part) GROUP BY p.vec_id, p.part, p.a")

    def update(books: str) -> str:
        return f"""SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM {books} b LEFT JOIN (
  SELECT part, entry, list(CAST(floor_mean AS BIGINT) ORDER BY k) AS c FROM (
    SELECT part, best.entry AS entry, k, (sum(a[k]) - ((sum(a[k]) % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean
    FROM (SELECT *, unnest(range(1, len(a) + 1)) AS k FROM ({nearest(books)})) GROUP BY part, best.entry, k)
  GROUP BY part, entry) m USING (part, entry)"""
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, part, v[part * len(v) // 16 + 1:(part + 1) * len(v) // 16] AS a
  FROM (SELECT *, unnest(range(16)) AS part FROM kept)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 64),
b0 AS MATERIALIZED (SELECT part, entry, a AS c FROM parts JOIN first USING (vec_id)),
b1 AS MATERIALIZED ({update('b0')}),
b2 AS MATERIALIZED ({update('b1')}),
coded AS MATERIALIZED (
  SELECT vec_id, string_agg(lower(printf('%02x', CAST(best.entry AS INTEGER))), '' ORDER BY part) AS code,
         CAST(sum(best.away) AS BIGINT) AS error
  FROM ({nearest('b2')}) GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b2) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


def _op13() -> str:
    """Matches and the texts between them, by RE2; positions are running sums of their lengths."""
    def either(words):
        return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)
    assign = (f"({either('password')}|{either('passwd')}|{either('secret')}|{either('token')}|{either('api')}_?{either('key')})"
              r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")
    rules = [("assign", assign, 2, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32),
             ("pem", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 1), ("host_token", "gh[opsru]_[A-Za-z0-9]{36,}", 0, 1),
             ("chat_token", "xox[abprs]-[A-Za-z0-9-]{19,}", 0, 1),
             ("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", 0, 1)]
    found = "\nUNION ALL\n".join(f"""SELECT text, '{kind}' AS kind, {i} AS num, stop - length(whole) AS start, stop
FROM (SELECT text, whole, held, sum(length(before) + length(whole)) OVER (PARTITION BY text ORDER BY i) AS stop FROM (
        SELECT text, generate_subscripts(w, 1) AS i, unnest(w) AS whole, unnest(g) AS held, unnest(b[1:len(w)]) AS before FROM (
          SELECT text, regexp_extract_all(text, '{p}', 0) AS w, regexp_extract_all(text, '{p}', {g}) AS g,
                 string_split_regex(text, '{p}') AS b
          FROM t WHERE regexp_matches(text, '{p}'))))
WHERE length(held) >= {least}""" for i, (kind, p, g, least) in enumerate(rules))
    return f"""
WITH t AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
f AS MATERIALIZED ({found}),
s AS (SELECT text, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             coalesce(string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, num) FILTER (num < 3), '') AS base,
             string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, num) AS spans
      FROM f GROUP BY text)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN s ON coalesce(d.text, '') = s.text
"""


ORACLE_SQL = {"op2_decontaminate": _OP2, "op6_chat_format": _OP6, "op8_line_dedup": _OP8, "op9_exact_dedup": _OP9,
              "op11_fill_in_middle": _OP11, "op12_vector_codes": _op12(), "op13_secret_scan": _op13()}
