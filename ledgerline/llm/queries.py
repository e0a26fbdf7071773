"""The registered queries of the training-data operators and their SQL.

Each query applies its operator, with production parameters, to the whole of
its table and derives the result columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bestfit, chat, decontaminate, divergence, langid, licenses, near_dup, packing, quality, secrets, sharding, spelling, token_files
from ledgerline.llm.common import Scratch, table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(spark, table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random")


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.compression_bands(table(spark, sf_dir, "documents"))


def op3_permutation_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = [f"shard-{k:05d}" for k in range(sharding.SHARDS)]
    placed = sharding.place(spark, table(spark, sf_dir, "documents"), ["doc_id"], shards)
    return placed.select("doc_id", "slot", "shard")


def op4_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), with_ids=False)


def op5_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(spark, table(spark, sf_dir, "documents"))


def op7_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    quoted = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", quoted), (-1, 1, "assistant", quoted)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = chat.format_conversations(turns)
    read = chat.read_turns(F.col("formatted"))
    said = F.array_join(F.transform(read, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = chat.learned_text(F.col("formatted"), F.col("loss_spans"))
    return out.select(
        "conv_id", F.size(read).cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(spark, table(spark, sf_dir, "documents"), percent=85)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs)
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = langid.predict(held, model)
    return named.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Scratch(spark, 'token-files').root}/tokens"
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    return token_files.read_token_files(spark, path)


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(spark, table(spark, sf_dir, "documents"), with_ids=False)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark, table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spark, table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_compression_bands": op2_compression_bands,
    "op3_permutation_sharding": op3_permutation_sharding,
    "op4_bounded_packing": op4_bounded_packing,
    "op5_simhash_decontamination": op5_simhash_decontamination,
    "op6_license_diagonals": op6_license_diagonals,
    "op7_chat_parts": op7_chat_parts,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_language_id": op9_language_id,
    "op10_token_files": op10_token_files,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_source_divergence": op12_source_divergence,
    "op13_spelling_variants": op13_spelling_variants,
}


def _escaped_length(value: str) -> str:
    return f"length(replace(replace(replace(coalesce({value}, ''), '&', '&amp;'), '<', '&lt;'), '[', '&#91;'))"


# What SQL can say; the other operators are tested against brute force, exact
# round trips and held-out accuracy (tests/llm).
SQL: dict[str, str] = {
    "op7_chat_parts": f"""
WITH said AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST({len(chat.BEGIN) + len(chat.END)} + sum({len(chat.TURN) + len(chat.SAYS) + len(chat.STOP)} + {_escaped_length("role")} + {_escaped_length("text")}) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id""",
    "op8_minhash_near_dedup": r"""
WITH RECURSIVE split AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                      ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS shingle FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a, b FROM edges
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m.low, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) m ON m.a = d.doc_id""",
    "op12_source_divergence": r"""
WITH rows AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
said AS (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM rows),
counts AS (SELECT lang, source, term, count(*) AS n FROM said GROUP BY ALL),
kept AS (SELECT lang, term, count(*) AS lang_n FROM said GROUP BY ALL HAVING count(DISTINCT r) >= 3),
sizes AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(lang_n) AS HUGEINT) AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM rows),
every AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.lang_n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
totals AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM every GROUP BY ALL),
share AS (
  SELECT lang, source, term, n, CAST(1 + (1000000000::HUGEINT * (n + 1)) // (total + v) AS BIGINT) AS p,
         CAST(1 + (1000000000::HUGEINT * (lang_n + 1)) // (lang_total + v) AS BIGINT) AS in_lang
  FROM every JOIN totals USING (lang, source) JOIN sizes USING (lang)),
priced AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN priced x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - in_lang) * (p - in_lang) // in_lang AS BIGINT) FROM share WHERE n > 0 AND p > in_lang),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
}
