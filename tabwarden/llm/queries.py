"""The queries of this folder and, where SQL can say the same, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, codes, contamination, divergence, neardup, packing, passages, pii, quality, toxicity, urls, warc

#: The rules of the query on URLs: (verdict, host, path).
URL_RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def _read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format all conversations and one that holds control strings; digests are taken from what was read back."""
    rows = _read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    records = rows.unionByName(extra).select("conv_id", F.to_json(F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    made = chat.format_chats(chat.canonical_turns(records, "conv_id", "record"))
    made = made.select("id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("learnt"))
    return made.select(
        F.col("id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _escaped_sql(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for s in chat.CONTROL:
        out = f"replace({out}, '{s}', '{s[0]}\\{s[1:]}')"
    return out


OP1_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, length({_escaped_sql("role")}) + length({_escaped_sql("text")}) + {len(chat.START + chat.SEP + chat.END) + 1} AS size FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(size)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove the words of 13-word windows that earlier documents have."""
    made = passages.repeated_passages(_read(spark, sf_dir, "documents", "doc_id", "text"), window=13)
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return made.select(F.col("id").alias("doc_id"), "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), g AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)
), late AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM g) WHERE least < doc_id
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM late, (SELECT unnest(range(0, 13)) AS k)
), each AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page's URL by the five rules."""
    return urls.judge_urls(_read(spark, sf_dir, "pages", "page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


OP3_SQL = f"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(verdict, rhost, rpath) AS (VALUES {", ".join(str(r) for r in URL_RULES)}
), hits AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(r.verdict, length(rhost || rpath)) AS verdict
  FROM split JOIN rules r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN hits USING (page_id)
"""


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a test item that it contains by 0.8 or more of its 5-word shingles."""
    docs, items = _read(spark, sf_dir, "documents", "doc_id", "text"), _read(spark, sf_dir, "benchmark", "item_id", "text")
    return contamination.contained_items(docs, items).select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_shared", "n_item")


def _shingles_sql(table: str, key: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"list_filter(string_split_regex({lower}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    return f"SELECT DISTINCT {key}, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM (SELECT {key}, {words} AS w FROM {table}) WHERE len(w) > 0)"


OP4_SQL = f"""
WITH d AS ({_shingles_sql("documents", "doc_id")}), b AS ({_shingles_sql("benchmark", "item_id")}), n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item FROM d JOIN b USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id HAVING 10 * count(*) >= 8 * any_value(n_item)
"""


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group all documents whose sets of 2-word shingles are similar by 0.8 or more."""
    made = neardup.near_duplicates(_read(spark, sf_dir, "documents", "doc_id", "text"), shingle=2)
    return made.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP5_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER_SQL}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(words[i:i + 1], ' ')) AS h, array_to_string(words[i:i + 1], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 1) + 1)) AS i FROM w WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.s = b.s AND a.doc_id > b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach(x, y) AS (
  SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x
), least AS (
  SELECT x, min(y) AS y FROM reach GROUP BY 1
)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(y, w.doc_id)) AS component_id, w.doc_id <= coalesce(y, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least ON x = w.doc_id
"""


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 4096 tokens."""
    made = packing.packed(_read(spark, sf_dir, "documents", "doc_id", "text"), word_tokenizer(), window=4096, end=2)
    return made.select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC records, read the archives back, and merge their index: position is a record's place in it."""
    index = warc.positioned(warc.archive_pages(_read(spark, sf_dir, "pages", "page_id", "url", "html")))
    return index.select(F.col("id").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("kind").alias("record_type"), "refers_to", "position")


OP7_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages
), u AS (
  SELECT *, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM p
), h AS (
  SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(split_part(url, '#', 1), '\?.*$') AS tail FROM u
), k AS (
  SELECT *, CASE WHEN host = '' THEN url ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || path || tail END AS url_key,
    min(page_id) OVER (PARTITION BY html) AS first, CAST(unhex(sha) AS BIT)::VARCHAR AS bits FROM h
)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(0, 5), lambda b: CAST(substr(bits, CAST(5 * i + b + 1 AS BIGINT), 1) AS INT) * (16 >> b)))::BIGINT, 1)), '') AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first < page_id THEN first END AS refers_to,
  row_number() OVER (ORDER BY url_key, page_id) - 1 AS position FROM k
"""


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents; the base spans' digest, and all spans."""
    made = pii.find_spans(_read(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"])
    base = F.filter("spans", lambda c: c["base"])
    count = lambda kind: F.size(F.filter(base, lambda c: c["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return made.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.written_out(base), 256).alias("base_sha256"), pii.written_out(F.col("spans")).alias("spans"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document by models of the labelled ones that are not held out."""
    docs, labels = _read(spark, sf_dir, "documents", "doc_id", "text"), _read(spark, sf_dir, "labels", "doc_id", "toxic")
    made = toxicity.toxicity_scores(docs, labels)
    return made.select(F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every document, and whether the base rules and the outlier test of its language and source keep it."""
    made = quality.judge_quality(_read(spark, sf_dir, "documents", "doc_id", "lang", "source", "text"))
    return made.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "pool", "settled", "distance")


def byte_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, and decode the ids that came out."""
    made = bpe.encoded(_read(spark, sf_dir, "documents", "doc_id", "text"), byte_tokenizer())
    told = made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "ids",
    )
    return bpe.decoded(told, byte_tokenizer()).select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of encoding and decoding that SQL can say: texts come back as they were."""
    return op11_bpe(spark, sf_dir).select("doc_id", "decoded_sha256")


ROUND_TRIP_SQL = "SELECT doc_id, sha256(coalesce(text, '')) AS decoded_sha256 FROM documents"


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, their errors, and the errors of their labels."""
    vectors = _read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    made, books = codes.compressed(vectors, keep=("label",))
    labels = made.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    digits = F.array_join(F.transform("near", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return made.join(labels, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("id").alias("vec_id"), digits.alias("code"), "error", "label_error", F.sha2(F.lit(books.written_out()), 256).alias("codebooks_sha256")
    )


def _codes_sql(rounds: int = 4) -> str:
    """The rounds one after another; products of these whole numbers are exact as doubles."""
    near = (
        "SELECT vec_id, part, any_value(x) AS x, min(CAST(list_inner_product(x, x) - 2 * list_inner_product(x, c)"
        " + list_inner_product(c, c) AS BIGINT) * 256 + i) AS best FROM p JOIN c{k} USING (part) GROUP BY vec_id, part"
    )
    steps = []
    for k in range(rounds):
        steps.append(f"a{k} AS MATERIALIZED ({near.format(k=k)})")
        steps.append(f"""m{k} AS MATERIALIZED (
  SELECT part, i, list(mean ORDER BY pos) AS c FROM (
    SELECT part, best % 256 AS i, pos, floor(sum(x[pos]) / count(*)) AS mean FROM a{k}, (SELECT unnest(range(1, w + 1)) AS pos FROM width) GROUP BY ALL
  ) GROUP BY part, i)""")
        steps.append(f"c{k + 1} AS MATERIALIZED (SELECT part, i, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} USING (part, i))")
    return f"""
WITH k AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), width AS (SELECT CAST(len(v) // 4 AS BIGINT) AS w FROM k LIMIT 1
), p AS MATERIALIZED (
  SELECT vec_id, part, v[part * w + 1:(part + 1) * w] AS x FROM k, width, (SELECT unnest(range(0, 4)) AS part)
), c0 AS MATERIALIZED (
  SELECT part, i, x AS c FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM k ORDER BY vec_id LIMIT 256) USING (vec_id)
), {", ".join(steps)}, last AS MATERIALIZED ({near.format(k=rounds)}
), book AS (
  SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, i, pos)) AS codebooks_sha256
  FROM (SELECT part, i, unnest(c) AS x, unnest(range(1, len(c) + 1)) AS pos FROM c{rounds})
), coded AS (
  SELECT vec_id, string_agg(printf('%02x', best % 256), '' ORDER BY part) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM last GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded JOIN k USING (vec_id), book
"""


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each source is from the others of its language, and the terms that set it apart."""
    return divergence.source_divergences(_read(spark, sf_dir, "documents", "text", "lang", "source"))


OP13_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), x AS MATERIALIZED (
  SELECT doc, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), l AS MATERIALIZED (
  SELECT lang, term, count(*) AS n FROM x GROUP BY ALL HAVING count(DISTINCT doc) >= 10
), v AS (
  SELECT lang, count(*) AS v, sum(n) AS n FROM l GROUP BY lang
), c AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM x SEMI JOIN l USING (lang, term) GROUP BY ALL
), g AS MATERIALIZED (
  SELECT d.lang, d.source, coalesce(any_value(s.n), 0) AS n FROM d LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) s USING (lang, source) GROUP BY ALL
), p AS MATERIALIZED (
  SELECT g.lang, g.source, l.term, coalesce(c.n, 0) AS n,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (g.n + 2 * v.v) AS BIGINT) AS p,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (l.n + 2) // (v.n + 2 * v.v) AS BIGINT) AS q
  FROM g JOIN l USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = l.term
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), u AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INT) AS rank FROM u
) WHERE part = 'pair' OR rank <= 10
"""


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the quality rules that SQL can say: base counts and the base verdict of every document."""
    made = quality.with_counts(_read(spark, sf_dir, "documents", "doc_id", "text"))
    return made.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", quality.base_failed().alias("base_failed"))


BASE_COUNTS_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n
  FROM (SELECT doc_id, i, array_to_string(words[i:i + 2], ' ') AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w))
), r AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM g, (SELECT unnest(range(0, 3)) AS k) WHERE n > 1 GROUP BY 1
), l AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1
), c AS (
  SELECT doc_id, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
"""


def pii_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the search for personal data that SQL can say: the base spans of every document."""
    return op8_pii(spark, sf_dir).drop("spans")


def _base_spans_sql() -> str:
    """Matches and the texts between them, from which places follow; patterns as the contract has them."""
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    double = f"CAST(substr(reverse({digits}), i, 1) AS INT) * (2 - i % 2)"
    luhn = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda i: {double} - CASE WHEN {double} > 9 THEN 9 ELSE 0 END)) % 10 = 0"
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
        "ip": (r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "list_max(list_transform(string_split(m, '.'), lambda x: coalesce(try_cast(x AS BIGINT), 999))) <= 255"),
        "card": (r"[0-9](?:[\x20-]?[0-9])+", f"length({digits}) BETWEEN 12 AND 19 AND {luhn}"),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({digits}) BETWEEN 9 AND 15"),
    }
    total = lambda part: f"coalesce(list_sum(list_transform({part}, lambda x: length(x))), 0)"
    each = [
        f"SELECT doc_id, {k} AS number, '{kind}' AS kind, m, {total('gaps[1:i]')} + {total('found[1:i - 1]')} AS start FROM (SELECT doc_id, found, gaps, unnest(found) AS m, unnest(range(1, len(found) + 1)) AS i FROM"
        f" (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS found, string_split_regex(text, '{pattern}') AS gaps FROM t WHERE regexp_matches(text, '{pattern}'))) WHERE {check}"
        for k, (kind, (pattern, check)) in enumerate(kinds.items())
    ]
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in kinds)
    said = "kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(m) AS BIGINT)"
    return f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), s AS ({" UNION ALL ".join(each)}),
a AS (SELECT doc_id, {counts}, sha256(string_agg({said}, ',' ORDER BY start, number)) AS base_sha256 FROM s GROUP BY 1)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in kinds)}, coalesce(base_sha256, sha256('')) AS base_sha256 FROM t LEFT JOIN a USING (doc_id)"""


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_url_filters": op3_url_filters,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_packing": op6_packing,
    "op7_warc": op7_warc,
    "op8_pii": op8_pii,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_bpe": op11_bpe,
    "op12_vector_codes": op12_vector_codes,
    "op13_source_divergence": op13_source_divergence,
    "quality_base_counts": quality_base_counts,
    "pii_base_spans": pii_base_spans,
    "bpe_round_trip": bpe_round_trip,
}
ORACLES = {
    "op1_chat_formatting": OP1_SQL,
    "op2_substring_dedup": OP2_SQL,
    "op3_url_filters": OP3_SQL,
    "op4_benchmark_decontamination": OP4_SQL,
    "op5_minhash_near_dedup": OP5_SQL,
    "op7_warc": OP7_SQL,
    "op12_vector_codes": _codes_sql(),
    "op13_source_divergence": OP13_SQL,
    "quality_base_counts": BASE_COUNTS_SQL,
    "pii_base_spans": _base_spans_sql(),
    "bpe_round_trip": ROUND_TRIP_SQL,
}
