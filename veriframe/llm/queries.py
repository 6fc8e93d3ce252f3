"""One registered query per operator, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veriframe.llm import chat, conversation_repair, masked_lm, near_duplicates, packing, pii, runs, secrets, urls, warc
from veriframe.llm.common import table
from veriframe.llm.decontaminate import contamination
from veriframe.llm.quality import STOP_WORDS, judge
from veriframe.llm.sentencepiece_bpe import digests, model_path


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in the chat template, read back from it."""
    records = chat.conversations_with_hostile(table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_records(records, "record", order_col="turn"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of the quality rules for all documents."""
    judged = judge(table(spark, sf_dir, "documents"))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(*names, "base_failed", "kept")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate secrets of all documents and the forest's verdict; values only as digests."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "ordinal", F.length("value").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"),
        F.round("probability", 6).alias("probability"), "secret",
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return near_duplicates.classes(table(spark, sf_dir, "documents"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents and the texts decoded from them, as digests."""
    return digests(table(spark, sf_dir, "documents"), model_path())


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for the URL of every page."""
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), urls.rules_frame(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every document under a network trained on all of them."""
    return masked_lm.score(table(spark, sf_dir, "documents"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.digests(table(spark, sf_dir, "documents"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs in all documents, a run planted into some of them."""
    return runs.digests(table(spark, sf_dir, "documents"), change=runs.planted)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut and packed into sequences of 2048 tokens."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), packing.tokenizer_path()))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and put in order again."""
    return conversation_repair.audit(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_quality": op2_quality,
    "op3_secrets": op3_secrets,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_urls": op6_urls,
    "op7_masked_lm": op7_masked_lm,
    "op8_pii": op8_pii,
    "op9_chat": op9_chat,
    "op10_decontaminate": op10_decontaminate,
    "op11_runs": op11_runs,
    "op12_packing": op12_packing,
    "op13_repair": op13_repair,
}

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS10 = f"regexp_extract_all({LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLES: dict[str, str] = {
    "op1_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
k AS (SELECT payload_bytes, payload_digest, max(page_id) AS keeper FROM d WHERE payload_bytes >= 1000
      GROUP BY ALL HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM d LEFT JOIN k USING (payload_bytes, payload_digest)""",
    "op2_quality": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
t AS (SELECT r, i, list_slice(w, i, i + 2) AS win FROM w, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT r, win FROM t GROUP BY r, win HAVING count(*) > 1),
rep AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT t.r, unnest([i, i + 1, i + 2]) AS k FROM t JOIN twice ON t.r = twice.r AND t.win = twice.win) GROUP BY r),
m AS (SELECT w.r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
  coalesce(rep.n, 0) AS n_repeat_words, len(l) AS n_lines,
  len(list_distinct(list_filter(w, lambda x: list_contains({list(STOP_WORDS)!r}, x)))) AS stops,
  len(list_filter(w, lambda x: NOT regexp_matches(x, '\\p{{L}}'))) AS letterless,
  len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|\u2026)[\\x20\\x09-\\x0D]*$'))) AS ellipsis,
  len(list_filter(l, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*\u2022]'))) AS bullets
  FROM w LEFT JOIN rep ON w.r = rep.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
  AND word_chars BETWEEN 2 * n_words AND 20 * n_words AND 100 * n_symbols <= 10 * n_words AND stops >= 2
  AND 100 * n_dup_lines <= 50 * n_lines AND 100 * ellipsis <= 30 * n_lines AND 100 * bullets <= 90 * n_lines
  AND 100 * letterless <= 30 * n_words AS kept
FROM m""",
    "op6_urls": """
WITH p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT * FROM (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                            ('allow', 'com', '/fr/'), ('block', 'com', '/de/')) AS t(action, rh, rp)),
u AS (SELECT row_number() OVER () AS k, * FROM h),
m AS (SELECT k, arg_max(rh || rp, length(rh) + length(rp)) AS rule, arg_max(action, length(rh) + length(rp)) AS action
      FROM u JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM u LEFT JOIN m USING (k)""",
    "op9_chat": f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{chat.HOSTILE}' UNION ALL SELECT -1, 1, 'assistant', '{chat.HOSTILE}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(chat.START) + len(chat.END) + 2} + length(role) + length(text) + length(text) - length(replace(text, '\\', ''))
       + (length(text) - length(replace(text, '<|', ''))) // 2) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""",
    "op10_decontaminate": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce({WORDS10}, []) AS w FROM documents),
b AS (SELECT item_id, coalesce({WORDS10}, []) AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS m, list_slice(w, i, i + least(len(w), 10) - 1) AS win
      FROM b, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS u(i)),
lengths AS (SELECT DISTINCT m FROM p),
t AS (SELECT r, m, i, list_slice(w, i, i + m - 1) AS win
      FROM d, lengths, unnest(range(1, len(w) - m + 2)) AS u(i)),
o AS (SELECT r, i, t.m, item_id FROM t JOIN p ON t.win = p.win),
hits AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS k FROM o) GROUP BY r),
names AS (SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM o WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN names USING (r)""",
}
