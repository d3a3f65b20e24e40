"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cambio.llm import langid, toxicity
from cambio.llm.bpe import token_digests
from cambio.llm.common import id_remainder, read_table
from cambio.llm.covertree import top_inner_products
from cambio.llm.importance import resample
from cambio.llm.itq import near_duplicate_vectors
from cambio.llm.licenses import scan_licences
from cambio.llm.minhash import near_duplicates
from cambio.llm.packing import pack_documents
from cambio.llm.pii import KINDS, find_personal_data, span_texts
from cambio.llm.url_rules import ALLOW, BLOCK, UrlRule, judge_urls
from cambio.llm.warc import assemble, classify_pages, read_archives, write_archives
from cambio.llm.whitening import whiten
from cambio.session import work_dir

#: The vocabulary file of the queries; a parameter of the operators.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences, a row per piece."""
    return pack_documents(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    documents = read_table(spark, sf_dir, "documents")
    net = langid.learn(documents.where(id_remainder("doc_id", 5) != 0))
    answers = langid.identify(documents, net)
    return answers.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from the labelled documents that are not held out."""
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.learn(
        documents.where(id_remainder("doc_id", 4) != 2),
        labels.where(id_remainder("doc_id", 4) != 2),
        calibration=id_remainder("doc_id", 4) == 3,
    )
    answers = toxicity.score_documents(documents, model)
    return answers.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives, read back and assembled, a row per page."""
    path = work_dir(spark, "archives")
    write_archives(classify_pages(read_table(spark, sf_dir, "pages")), path)
    captures = assemble(read_archives(spark, path, with_payload=False))
    digest = F.coalesce("answer.payload_sha256", F.substring_index("answer.header_digest", ":", -1))
    refers_to = F.regexp_extract("answer.refers_to", "^<urn:x-page:([0-9-]+):[0-9a-f]+:capture>$", 1)
    page_id = F.element_at(F.element_at("metadata", 1)["fields"], "page-id")
    return captures.select(
        page_id.try_cast("bigint").alias("page_id"),
        F.col("answer.payload_bytes").alias("payload_bytes"),
        digest.alias("payload_digest"),
        "record_type",
        refers_to.try_cast("bigint").alias("refers_to"),
    )


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence phrases, tags and labels of every document."""
    found = scan_licences(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of every document: counts, digests and spans."""
    found = find_personal_data(read_table(spark, sf_dir, "documents"))
    terms = F.transform("terms", lambda t: F.concat(t["kind"], F.lit(":"), t["start"], F.lit(":"), t["end"]))
    every = F.concat(span_texts(KINDS), F.array_sort(terms, _by_kind_and_start))
    return found.select(
        "doc_id",
        *[F.size(f"_{kind}").cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.array_join(span_texts(KINDS), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(every, ",").alias("spans"),
    )


def _by_kind_and_start(a: Column, b: Column) -> Column:
    place = lambda t: F.split(t, ":")
    one = F.struct(place(a)[0], place(a)[1].cast("int"))
    other = F.struct(place(b)[0], place(b)[1].cast("int"))
    return F.when(one < other, -1).when(one > other, 1).otherwise(0)


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    return token_digests(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op9_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best matches of every fiftieth vector among all others."""
    return top_inner_products(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every vector, and its number of links."""
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op11_feast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the sixteen leading principal components, a row per vector and component."""
    rows = whiten(read_table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("bigint"))


#: The rules that hold whatever is mined.
URL_RULES = (
    UrlRule(ALLOW, "com", "/"),
    UrlRule(BLOCK, "example.com", "/en/"),
    UrlRule(ALLOW, "www.example.com", "/en/"),
    UrlRule(BLOCK, "net", "/es/"),
    UrlRule(BLOCK, "net", "/fr/"),
)


def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on the url of every page, by the given rules and by those mined from what they decide."""
    return judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank in the draw of every document, towards the benchmark's texts."""
    rows = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_language": op2_language,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_licences": op5_licences,
    "op6_pii": op6_pii,
    "op7_minhash": op7_minhash,
    "op8_bpe": op8_bpe,
    "op9_covertree": op9_covertree,
    "op10_itq": op10_itq,
    "op11_feast": op11_feast,
    "op12_url_rules": op12_url_rules,
    "op13_importance": op13_importance,
}

ORACLE_SQL: dict[str, str] = {
    "op4_warc": """
        WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS n FROM pages),
        firsts AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
               CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM p LEFT JOIN firsts ON p.digest = firsts.digest AND n >= 100
    """,
    "op7_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
            FROM words),
        shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        reach AS (
            SELECT doc_id AS id, doc_id AS least FROM sets
            UNION
            SELECT links.b, reach.least FROM reach JOIN links ON links.a = reach.id AND reach.least < links.b)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(least) AS component_id, doc_id = min(least) AS kept
        FROM sets JOIN reach ON id = doc_id GROUP BY doc_id, len(s)
    """,
    "op9_covertree": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
            FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scores)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op10_itq": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
        reach AS (
            SELECT vec_id AS id, vec_id AS least FROM embeddings
            UNION
            SELECT links.b, reach.least FROM reach JOIN links ON links.a = reach.id AND reach.least < links.b),
        least AS (SELECT id, min(least) AS component_id FROM reach GROUP BY id),
        degree AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
        SELECT id AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, id = component_id AS kept
        FROM least LEFT JOIN degree USING (id)
    """,
    "op12_url_rules": r"""
        WITH parts AS (
            SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        named AS (
            SELECT page_id, url, rest, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
                   translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   translate(rest, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
            FROM parts),
        split AS (
            SELECT *, string_split(host, '.') AS labels,
                   list_filter(string_split(regexp_extract(low, '^[^/?#]*([^?#]*)', 1), '/'), lambda s: s <> '') AS segments,
                   list_transform(
                       list_filter(string_split(regexp_extract(low, '^[^?#]*\?([^#]*)', 1), '&'), lambda s: s <> ''),
                       lambda s: regexp_replace(split_part(s, '=', 1), '[0-9]+', '#', 'g')) AS keys
            FROM named),
        slots AS (
            SELECT page_id, host, path, CASE WHEN host = '' THEN [] ELSE list_filter([
                'scheme=' || translate(
                    split_part(url, '://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                CASE WHEN len(labels) > 1 THEN 'tld=' || labels[-1] END,
                CASE WHEN len(labels) > 1 THEN 'site=' || labels[-2] || '.' || labels[-1] END,
                CASE WHEN len(labels) > 2 THEN 'sub=' || regexp_replace(labels[1], '[0-9]+', '#', 'g') END,
                CASE WHEN len(segments) > 0 THEN 'dir=' || regexp_replace(segments[1], '[0-9]+', '#', 'g') END,
                CASE WHEN len(segments) > 1
                     THEN 'page=' || regexp_replace(regexp_replace(segments[-1], '\.[^.]*$', ''), '[0-9]+', '#', 'g') END,
                CASE WHEN regexp_matches(segments[-1], '[^.]\.[a-z0-9]+$')
                     THEN 'ext=' || regexp_replace(regexp_extract(segments[-1], '\.([a-z0-9]+)$', 1), '[0-9]+', '#', 'g') END,
                CASE WHEN len(keys) > 0 THEN 'query=' || array_to_string(list_sort(list_distinct(keys)), '&') END,
                CASE WHEN contains(low, '#') THEN 'fragment=yes' END], lambda x: x IS NOT NULL) END AS tokens
            FROM split),
        judged AS (
            SELECT *, CASE
                WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
            FROM slots),
        decided AS (
            SELECT tokens, count(*) FILTER (rule IN ('com/', 'www.example.com/en/')) AS a,
                   count(*) FILTER (rule NOT IN ('com/', 'www.example.com/en/')) AS b
            FROM judged WHERE rule IS NOT NULL GROUP BY tokens),
        total AS (SELECT CAST(sum(a + b) AS DOUBLE) AS n FROM decided),
        masks AS (SELECT *, unnest(range(1, 1 << len(tokens))) AS m FROM decided),
        sums AS (
            SELECT list_sort(list_filter(tokens, lambda x, i: (m >> (i - 1)) % 2 = 1)) AS needed, sum(a) AS a, sum(b) AS b
            FROM masks GROUP BY needed),
        mined AS (
            SELECT needed, v AS verdict, c / CAST(a + b AS DOUBLE) AS confidence, c / n AS support
            FROM (SELECT *, 'allow' AS v, CAST(a AS DOUBLE) AS c FROM sums
                  UNION ALL SELECT *, 'block' AS v, CAST(b AS DOUBLE) AS c FROM sums), total
            WHERE c >= ceil(0.01 * n) AND c > 0 AND c / CAST(a + b AS DOUBLE) >= 0.8),
        open AS (SELECT DISTINCT tokens FROM judged WHERE rule IS NULL),
        tried AS (SELECT tokens, unnest(range(1, 1 << len(tokens))) AS m FROM open),
        ranked AS (
            SELECT tokens, verdict, array_to_string(needed, ' ') AS mined, confidence,
                   row_number() OVER (PARTITION BY tokens ORDER BY confidence DESC, support DESC, len(needed),
                                      array_to_string(needed, ' '), verdict <> 'block') AS place
            FROM tried JOIN mined ON needed = list_sort(list_filter(tokens, lambda x, i: (m >> (i - 1)) % 2 = 1)))
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                    ELSE coalesce(verdict, 'allow') END AS verdict,
               CASE WHEN rule IS NULL THEN mined END AS mined, CASE WHEN rule IS NULL THEN confidence END AS confidence
        FROM judged LEFT JOIN (SELECT * FROM ranked WHERE place = 1) AS best ON judged.tokens = best.tokens
    """,
    "op13_importance": r"""
        WITH crc AS (
            SELECT list_transform(range(16), lambda i: list_reduce(
                range(4), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS half),
        texts AS (
            SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1 AS side, NULL AS doc_id, text FROM benchmark),
        words AS (
            SELECT side, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM texts),
        runs AS (
            SELECT side, doc_id, unnest(list_concat(
                w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
            FROM words),
        counted AS (SELECT side, doc_id, f, count(*) AS n FROM runs GROUP BY ALL),
        hexed AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM counted)),
        -- a byte's low half first
        nibbles AS (
            SELECT f, list_transform(range(len(h)), lambda i: strpos('0123456789ABCDEF', h[xor(i, 1) + 1]) - 1) AS x FROM hexed),
        buckets AS (
            SELECT f, xor(list_reduce(x, lambda c, d: xor(c // 16, half[xor(c, d) % 16 + 1]), 4294967295), 4294967295) % 10000 AS bucket
            FROM nibbles, crc),
        placed AS (SELECT side, doc_id, bucket, n FROM counted JOIN buckets USING (f)),
        sums AS (
            SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS of_corpus, coalesce(sum(n) FILTER (side = 1), 0) AS of_target
            FROM placed GROUP BY bucket),
        totals AS (
            SELECT CAST(sum(of_corpus) AS DOUBLE) AS corpus, CAST(sum(of_target) AS DOUBLE) AS target FROM sums),
        gains AS (
            SELECT bucket, CAST(floor(1000 * ln((CAST(of_target AS DOUBLE) + 1) * (corpus + 10000)
                                                / ((CAST(of_corpus AS DOUBLE) + 1) * (target + 10000)))) AS BIGINT) AS gain
            FROM sums, totals),
        weights AS (
            SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS weight
            FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id),
        scored AS (
            SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
                   CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                   CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(
                       (CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
            FROM words LEFT JOIN weights USING (doc_id) WHERE side = 0),
        drawn AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
            FROM scored WHERE n_words >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank
        FROM scored LEFT JOIN drawn USING (doc_id)
    """,
}
