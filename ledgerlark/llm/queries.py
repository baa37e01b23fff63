"""The queries of the corpus operators and, where SQL can say the same, their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import bpe, chat, divergence, licenses, minhash, mixing, packing, quality, repair, secrets, topk, urls, warc
from ledgerlark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    spans = F.col("spans")
    kinds = [r.kind for r in secrets.BASE_RULES]
    base = F.filter(spans, lambda s: s["kind"].isin(kinds))

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    return secrets.scan_secrets(docs).select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(secrets.rendered(base), 256).alias("base_sha256"),
        secrets.rendered(spans).alias("spans"),
    )


@query
def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = tokenizer_path()
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.encode_documents(docs, path, packed=True).select("doc_id", "ids")
    return bpe.decode_documents(coded, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    cutoffs = quality.select_cutoffs(docs, table(spark, folder, "labels"))
    return quality.judge(docs, cutoffs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.archive_folder(spark)
    manifest = warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.read_archives(manifest, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified"
    )


ORACLES["op5_warc"] = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
repeated AS (
    SELECT body, max(page_id) AS holder FROM payloads WHERE strlen(body) >= 1000 GROUP BY body HAVING count(*) > 1
)
SELECT p.page_id, strlen(p.body)::BIGINT AS payload_bytes, sha1(p.body) AS payload_digest,
       CASE WHEN r.holder <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN r.holder <> p.page_id THEN r.holder END AS refers_to,
       true AS verified
FROM payloads p LEFT JOIN repeated r ON p.body = r.body
"""


@query
def op9_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return mixing.mix(docs)


ORACLES["op9_mix"] = """
WITH sizes AS (
    SELECT source, sum(length(coalesce(text, ''))) AS size FROM documents GROUP BY source
),
rates AS (
    SELECT source, 1.0::DOUBLE / count(*) OVER () * sum(size) OVER () / size AS rate FROM sizes WHERE size > 0
),
steps AS (
    SELECT source, rate, unnest(range(0, (ceil(rate + 12 * sqrt(rate) + 40))::BIGINT + 1)) AS k FROM rates
),
logs AS (
    SELECT *, sum(ln(greatest(k, 1)::DOUBLE)) OVER (PARTITION BY source ORDER BY k) AS log_factorial FROM steps
),
cumulated AS (
    SELECT source, k, sum(exp(k * ln(rate) - rate - log_factorial)) OVER (PARTITION BY source ORDER BY k) AS upto
    FROM logs
),
drawn AS (
    SELECT *, ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
    FROM documents
),
counted AS (
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars,
           (SELECT count(*) FROM cumulated c WHERE c.source IS NOT DISTINCT FROM d.source AND c.upto <= d.u) AS n
    FROM drawn d
    WHERE EXISTS (SELECT 1 FROM rates r WHERE r.source IS NOT DISTINCT FROM d.source)
),
copies AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(1, n + 1)) AS copy FROM counted)
SELECT *, md5('mix-1:order:' || coalesce(doc_id::VARCHAR, '') || ':' || copy) AS shuffle_key FROM copies
"""


@query
def op6_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLES["op6_topk"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
    FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 20 = 0
),
ranked AS (
    SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op8_minhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, size=3, percent=85)


ORACLES["op8_minhash"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
    FROM words
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)
),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reach.a, edges.b FROM reach JOIN edges ON edges.a = reach.b
),
named AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN named USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""


@query
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", F.array_join("mined", " ").alias("mined"), "confidence"
    )


@query
def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = chat.canonical_turns(table(spark, folder, "conversations"), F.col("conv_id"))
    said = "</s>[INST] ok [/INST]"
    record = F.to_json(
        F.struct(
            F.array(*[F.struct(F.lit(r).alias("role"), F.lit(said).alias("content")) for r in ("user", "assistant")]).alias(
                "messages"
            )
        )
    )
    extra = chat.canonical_turns(spark.range(1).select(F.lit(-7).alias("conv_id"), record.alias("record")), F.col("conv_id"), F.col("record"))
    out = chat.render(rows.unionByName(extra))
    turns, loss = chat.read_back(F.col("formatted")), chat.trained_text(F.col("segments"))
    out = out.select("conv_id", F.length("formatted").cast("bigint").alias("formatted_chars"), turns.alias("turns"), loss.alias("loss"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


# Rendered turns have 25 characters besides role and text, and one for every control string inside.
ORACLES["op3_chat_format"] = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
counted AS (
    SELECT *, len(regexp_extract_all(text, '(<\||</?|\[/?)\\*((im_start|im_end|system|user|assistant|endoftext|begin_of_text|end_of_text|eot_id)\|>|s>|(INST|SYS)\]|SYS>)')) AS n
    FROM said
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + length(text) + n + 24)::BIGINT AS formatted_chars
FROM counted GROUP BY conv_id
"""


@query
def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    fixed = repair.Repair(repair.damage(rows))
    hashes = repair.digests(fixed.turns).withColumnRenamed("conv_id", "h")
    reports = fixed.conversations.withColumnRenamed("conv_id", "c")
    every = rows.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    out = every.join(reports, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    out = out.join(hashes, F.col("conv_id").eqNullSafe(F.col("h")), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


# crc32 byte by byte; costs backwards and choices forwards, one row of every conversation at a time.
# States: 0 nothing said, 1 system, 2 user, 3 assistant.
ORACLES["op11_repair"] = r"""
WITH RECURSIVE remainders AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i::UBIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t
),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           list_reduce([4294967295::UBIGINT] || list_transform(
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::UBIGINT),
               lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])) AS crc
    FROM conversations, remainders
),
drawn AS (SELECT *, xor(crc, 4294967295::UBIGINT) % 20 AS d FROM keyed),
damaged AS (
    SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
           CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN d = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM drawn WHERE d <> 0
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS said
    FROM damaged
),
faulty AS (
    SELECT *, left(role, 1) AS initial,
           CASE WHEN said = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM placed
),
counted AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faulty GROUP BY conv_id
),
priced AS (
    SELECT conv_id, i, role, text, fault IN ('none', 'truncated') AS stays, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more,
           CASE WHEN fault IN ('none', 'truncated') THEN initial ELSE '' END AS initial
    FROM faulty
),
costs(conv_id, i, v0, v1, v2, v3) AS (
    SELECT conv_id, n + 1, 0::BIGINT, 6::BIGINT, 3::BIGINT, 0::BIGINT FROM counted
    UNION ALL
    SELECT conv_id, i, least(r0, 3 + r2, 6 + r3), least(r1, 3 + r2, 6 + r3), least(r2, 3 + r3), least(r3, 3 + r2) FROM (
        SELECT p.conv_id, p.i,
               least(4 + v0, CASE WHEN stays THEN 3 + more + v2 END, CASE initial WHEN 's' THEN more + v1 WHEN 'u' THEN more + v2 END) AS r0,
               least(4 + v1, CASE WHEN stays THEN 3 + more + v2 END, CASE initial WHEN 'u' THEN more + v2 END) AS r1,
               least(4 + v2, CASE WHEN stays THEN 3 + more + v3 END, CASE initial WHEN 'a' THEN more + v3 END) AS r2,
               least(4 + v3, CASE WHEN stays THEN 3 + more + v2 END, CASE initial WHEN 'u' THEN more + v2 END) AS r3
        FROM costs c JOIN priced p ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.i = c.i - 1
    )
),
vectors AS (SELECT conv_id, i, [v0, v1, v2, v3] AS v FROM costs),
walk(conv_id, i, s, audit, said) AS (
    SELECT conv_id, 1::BIGINT, 1, '', []::VARCHAR[] FROM counted
    UNION ALL
    SELECT conv_id, CASE WHEN edit = 'I' THEN i ELSE i + 1 END,
           CASE edit WHEN 'D' THEN s WHEN 'K' THEN kept ELSE made END, audit || edit,
           CASE edit WHEN 'D' THEN said WHEN 'K' THEN said || [role || ':' || text]
                     WHEN 'I' THEN said || [CASE made WHEN 3 THEN 'user:' ELSE 'assistant:' END]
                     ELSE said || [CASE made WHEN 3 THEN 'user:' ELSE 'assistant:' END || text] END
    FROM (
        SELECT *, CASE WHEN p_i IS NOT NULL AND 4 + after[s] = v[s] THEN 'D'
                       WHEN 3 + v[made] = v[s] THEN 'I'
                       WHEN kept IS NOT NULL AND more + after[kept] = v[s] THEN 'K'
                       WHEN p_i IS NOT NULL THEN 'R' END AS edit
        FROM (
            SELECT w.*, c.v, a.v AS after, p.i AS p_i, p.role, p.text, p.more,
                   CASE w.s WHEN 3 THEN 4 ELSE 3 END AS made,
                   CASE WHEN p.initial = 's' AND w.s = 1 THEN 2 WHEN p.initial = 'u' AND w.s <> 3 THEN 3
                        WHEN p.initial = 'a' AND w.s = 3 THEN 4 END AS kept
            FROM walk w
            JOIN vectors c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.i = w.i
            LEFT JOIN vectors a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.i = w.i + 1
            LEFT JOIN priced p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.i = w.i
        )
    ) WHERE edit IS NOT NULL
),
finished AS (SELECT conv_id, max_by(audit, length(audit)) AS audit, max_by(said, length(audit)) AS said FROM walk GROUP BY conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v.v[1], 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM every e
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN vectors v ON v.conv_id IS NOT DISTINCT FROM e.conv_id AND v.i = 1
LEFT JOIN finished f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@query
def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents").select("lang", "source", "text"))


ORACLES["op12_divergence"] = r"""
WITH words AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
),
sources AS (SELECT DISTINCT lang, source FROM words),
kept AS (
    SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM words) GROUP BY ALL HAVING count(*) >= 10
),
found AS (SELECT lang, source, unnest(w) AS term FROM words),
counts AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL),
vocabulary AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grid AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n
    FROM sources s JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
),
p AS (
    SELECT lang, source, term, n,
           1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
    FROM grid JOIN vocabulary USING (lang)
),
whole AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
    FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL) JOIN vocabulary USING (lang)
),
apart AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(apart.value, 0) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
),
own AS (
    SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p JOIN whole USING (lang, term)
    WHERE n > 0 AND p > q
),
ranked AS (
    SELECT 'pair' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
    UNION ALL
    SELECT * FROM (
        SELECT 'term' AS part, *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM own
    ) WHERE rank <= 10
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
"""


@query
def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
