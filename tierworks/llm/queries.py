"""Registered queries of this package, and the SQL that gives the same rows where SQL can say it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierworks.llm import bpe, conv_trie, decontaminate, katz, langid, lexical, minhash, pii, quality_rules, suffix_dedup, token_files, url_filter, weak_labels

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Words of the shortest passage that op10 tells as repeated beside strings of 400 bytes; most such passages are shorter than these.
PASSAGE_WORDS = 51

#: The domain rules of op8.
DOMAIN_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def inline_rows(spark: SparkSession, rows, names) -> DataFrame:
    """A few fixed rows as a table that the JVM makes by itself."""
    cells = [F.struct(*(F.lit(x).alias(n) for n, x in zip(names, row, strict=True))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*cells)))


def remainder(by: int) -> Column:
    """crc32 of the document's id as text, modulo ``by``; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % by


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.filter((remainder(5) != 0) & F.col("text").isNotNull()))
    found = langid.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.judge(docs, table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.STATISTICS, "base_failed", "kept", "rejected_by")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, size=4).withColumnRenamed("id", "doc_id")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    heads = weak_labels.fit(docs, table(spark, sf_dir, "labels"))
    return weak_labels.classify(docs, heads).select("doc_id", "p_quality_bad", "p_toxic", "kept")


def op6_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (remainder(10) == 0).alias("held"))
    return katz.score_texts(docs, "doc_id", "text", "held").withColumnRenamed("key", "doc_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.with_ids(docs, tokenizer_path(), decoded=True)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = token_files.round_trip(docs, tokenizer_path(), END_ID)
    return back.select(
        "doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    domains = inline_rows(spark, DOMAIN_RULES, ("host", "path", "verdict"))
    rules = [(k, *rule) for k, rule in enumerate(url_filter.PATTERN_RULES)]
    patterns = inline_rows(spark, rules, ("rule_id", "verdict", "pattern"))
    return url_filter.filter_urls(pages, domains, patterns).select("page_id", "host", "path", "rule", "verdict")


def op10_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    cut = suffix_dedup.without_repeats(docs, words=PASSAGE_WORDS, cut_words=False)
    passage_bytes = F.aggregate("passages", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.size("passages").cast("long").alias("n_passages"),
        passage_bytes.alias("n_passage_bytes"),
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"), k=10)


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
OP11_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT r, doc_id, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
counts AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY ALL),
holding AS (SELECT term, floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, corpus GROUP BY term),
items AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark)),
scores AS (
  SELECT item_id, r, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM items JOIN holding USING (term) JOIN counts USING (term) JOIN lengths USING (r), corpus GROUP BY item_id, r
),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10"""


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: ~s["added"])
    numbers = [pii.count_of(base, kind).alias(f"n_{kind}") for kind in pii.KINDS]
    digest = F.sha2(pii.listed_spans(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *numbers, digest, pii.listed_spans(F.col("pii")).alias("spans"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conv_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("last_conv_id", "last_place")


OP13_SQL = """
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, turn FROM conversations WHERE conv_id IS NOT NULL
),
bits AS (
  SELECT c, list_transform(range(0, 8 * length(c::VARCHAR)), lambda i: (ascii((c::VARCHAR)[i // 8 + 1]) >> (i % 8)) & 1) AS b
  FROM (SELECT DISTINCT c FROM turns)
),
convs AS (
  SELECT c, c - c % 100 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT, b::BIGINT[]), lambda a, bit: xor(a >> 1, (xor(a, bit) & 1) * 3988292384)), 4294967295) % 6 AS h
  FROM bits
),
own AS (SELECT c, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, r, x) AS seq FROM turns GROUP BY c),
rebuilt AS (
  SELECT k.c, list_concat(coalesce(b.seq[1:k.h], []), o.seq[k.h + 1:]) AS seq
  FROM convs k JOIN own o ON o.c = k.c LEFT JOIN own b ON b.c = k.base
),
prefixes AS (
  SELECT c, d, len(seq) AS whole, sha256(to_json(seq[1:d])::VARCHAR) AS id, sha256(to_json(seq[1:d - 1])::VARCHAR) AS up,
         CASE WHEN d > 0 THEN length(seq[d].x) ELSE 0 END AS n_chars, seq
  FROM rebuilt, unnest(range(0, len(seq) + 1)) AS u(d)
),
nodes AS (
  SELECT id, d, min(c) AS conv_id, count(*) AS n_convs, any_value(CASE WHEN d > 0 THEN up END) AS up, any_value(n_chars) AS n_chars,
         any_value(seq) AS seq, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE whole = d), '')) AS ends
  FROM prefixes GROUP BY id, d
),
children AS (SELECT up AS id, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
counted AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN children k ON k.id = n.id AND k.d = n.d),
below AS (
  SELECT sha256(to_json(seq[1:a])::VARCHAR) AS id, a AS d, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * n_chars) AS saved_tokens
  FROM counted, unnest(range(0, d + 1)) AS u(a) GROUP BY ALL
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children::BIGINT AS n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM counted n JOIN below b ON b.id = n.id AND b.d = n.d LEFT JOIN nodes p ON p.id = n.up AND p.d = n.d - 1"""


_SEP = "(?:[^a-z0-9]|^|$)"
OP8_SQL = f"""
WITH cut AS (
  SELECT page_id, lower(url) AS low,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1) ELSE '' END AS raw_host,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
),
hosts AS (
  SELECT *, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM cut
),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
  END AS rule
  FROM hosts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(low, '{_SEP}casino{_SEP}history{_SEP}') THEN 'allow'
    WHEN regexp_matches(low, '{_SEP}wp-login\\.php{_SEP}|{_SEP}xmlrpc\\.php{_SEP}|{_SEP}casino{_SEP}|{_SEP}porn{_SEP}')
      OR regexp_matches(low, '(?s){_SEP}adserver{_SEP}.*{_SEP}click{_SEP}|{_SEP}cart{_SEP}checkout{_SEP}')
      OR regexp_matches(low, '(?s){_SEP}calendar{_SEP}.*date=|sessionid=') THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "op1_language_id": op1_language_id,
        "op2_decontamination": op2_decontamination,
        "op3_quality_rules": op3_quality_rules,
        "op4_near_duplicates": op4_near_duplicates,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_katz_scores": op6_katz_scores,
        "op7_bpe": op7_bpe,
        "op8_url_filters": op8_url_filters,
        "op9_token_files": op9_token_files,
        "op10_repeated_strings": op10_repeated_strings,
        "op11_lexical_search": op11_lexical_search,
        "op12_pii": op12_pii,
        "op13_conversation_trie": op13_conversation_trie,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_url_filters": OP8_SQL, "op11_lexical_search": OP11_SQL, "op13_conversation_trie": OP13_SQL}
