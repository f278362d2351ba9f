"""The registered queries of the training-data operators, and SQL where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from pitlane.llm.bpe import token_digests
from pitlane.llm.common import documents, find_on_executors
from pitlane.llm.exact_dedup import exact_duplicates
from pitlane.llm.lexical import rank_documents
from pitlane.llm.mtree import top_products
from pitlane.llm.packing import pack
from pitlane.llm.pii import personal_data
from pitlane.llm.prefix_trie import conversation_trie
from pitlane.llm.quality import quality_scores
from pitlane.llm.secret_scan import KINDS, SCOPE, scan
from pitlane.llm.sharding import shard_documents
from pitlane.llm.simhash import near_duplicate_components
from pitlane.llm.toxicity import toxicity_scores
from pitlane.llm.warc import archive_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def registered(sql: str | None = None):
    def keep(function: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            find_on_executors(spark)
            return function(spark, folder)

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return keep


@registered("""
    WITH one_byte AS (
      SELECT list(v ORDER BY b) AS t FROM (
        SELECT b, list_reduce(list_concat([b::BIGINT], range(8)),
          lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) r(b))),
    as_bytes AS (
      SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
        list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
          lambda h: ('0x' || h)::BIGINT) AS b
      FROM documents),
    records AS (
      SELECT row_number() OVER () AS n, doc_id, size,
        xor(list_reduce(list_concat([4294967295::BIGINT], b),
          lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) AS text_crc32
      FROM as_bytes, one_byte),
    costs AS (
      SELECT n, s::INTEGER AS s, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || s),
        1, 13))::BIGINT + 0.5) / 4503599627370496) AS cost
      FROM records, range(41) r(s)),
    won AS (
      SELECT n, arg_min(s, cost) FILTER (WHERE s < 40) AS shard, arg_min(s, cost) AS grown_shard
      FROM costs GROUP BY n)
    SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
      row_number() OVER (PARTITION BY shard ORDER BY
        ('0x' || substr(md5(concat_ws('|', doc_id, size, text_crc32)), 1, 4))::INTEGER % 256,
        doc_id NULLS FIRST, size, text_crc32) - 1 AS slot
    FROM records JOIN won USING (n)""")
def op1_rendezvous_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents over 40 shards by rendezvous hashing of doc_id."""
    return shard_documents(documents(spark, folder))


@registered()
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """All documents encoded and decoded again, as digests."""
    return token_digests(documents(spark, folder))


@registered("""
    WITH normal AS (
      SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS text
      FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS keep_id,
      count(*) OVER (PARTITION BY text) AS group_size,
      row_number() OVER (PARTITION BY text ORDER BY doc_id NULLS LAST) = 1 AS kept,
      sha256(text) AS text_sha256
    FROM normal""")
def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the group of equal texts that they are in."""
    return exact_duplicates(documents(spark, folder))


@registered()
def op8_sum_of_squares_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return pack(documents(spark, folder))


@registered("""
    WITH sized AS (
      SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest
      FROM pages),
    ranked AS (
      SELECT *, first_value(page_id) OVER same AS original, row_number() OVER same AS place
      FROM sized WINDOW same AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST))
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes < 100 OR place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN payload_bytes >= 100 AND place > 1 THEN original END AS refers_to
    FROM ranked""")
def op3_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to an archive, equal payloads once, and read back."""
    return archive_pages(spark.read.parquet(f"{folder}/pages.parquet"))


@registered()
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their fingerprint and component."""
    return near_duplicate_components(documents(spark, folder))


@registered()
def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored for quality."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return quality_scores(documents(spark, folder), labels)


@registered()
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored for toxicity."""
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return toxicity_scores(documents(spark, folder), labels)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _near(role: str) -> str:
    return f"""EXISTS (SELECT 1 FROM spans p WHERE p.n = w.n AND p.role = '{role}'
            AND p.start - {SCOPE} <= w.finish AND w.start <= p.finish + {SCOPE})"""


_KIND_ROWS = ",\n".join(
    f"({n}, {_quoted(k.name)}, {_quoted(k.role)}, {_quoted(k.pattern)})" for n, k in enumerate(KINDS))


@registered(f"""
    WITH texts AS (
      SELECT row_number() OVER () AS n, doc_id,
        replace(coalesce(text, ''), chr(57344), chr(57345)) AS t
      FROM documents),
    kinds(kind, name, role, pattern) AS (VALUES {_KIND_ROWS}),
    parts AS (
      SELECT n, kind, name, role, string_split(regexp_replace(t, '(' || pattern || ')',
        chr(57344) || '\\1' || chr(57344), 'g'), chr(57344)) AS p
      FROM texts, kinds),
    found AS (
      SELECT n, kind, name, role, unnest(list_transform(range(2, len(p) + 1, 2), lambda i: {{
        'start': list_sum(list_transform(p[1:i - 1], lambda x: length(x))), 'match': p[i]}})) AS f
      FROM parts),
    spans AS (
      SELECT n, kind, name, role, f.start::INTEGER AS start,
        (f.start + length(f.match))::INTEGER AS finish
      FROM found
      WHERE CASE kind WHEN 0 THEN regexp_matches(f.match, {_quoted(KINDS[0].keep)})
        WHEN 1 THEN length(f.match) >= 18
        WHEN 5 THEN regexp_matches(f.match, '[a-z]') AND regexp_matches(f.match, '[A-Z]')
          AND regexp_matches(f.match, '[0-9]')
        ELSE TRUE END),
    kept AS (
      SELECT * FROM spans w WHERE kind < 3
        OR CASE role WHEN 'secret' THEN {_near('identifier')}
          WHEN 'identifier' THEN {_near('secret')}
          ELSE {_near('identifier')} AND {_near('secret')} END),
    written AS (
      SELECT n, count(*) FILTER (WHERE kind = 0) AS n_assign,
        count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
        string_agg(name || ':' || start || ':' || finish, ',' ORDER BY start, kind)
          FILTER (WHERE kind < 3) AS base,
        string_agg(name || ':' || start || ':' || finish, ',' ORDER BY start, kind) AS spans
      FROM kept GROUP BY n)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
      coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
      coalesce(spans, '') AS spans
    FROM texts LEFT JOIN written USING (n)""")
def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the secrets in them."""
    return scan(documents(spark, folder))


@registered("""
    WITH numbered AS (SELECT row_number() OVER () AS n, vec_id, embedding FROM embeddings
      WHERE embedding IS NOT NULL),
    sound AS (
      SELECT n, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
      FROM numbered
      WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
    scored AS (
      SELECT q.n, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score,
        row_number() OVER (PARTITION BY q.n
          ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id NULLS LAST, c.n) AS rank
      FROM sound q JOIN sound c ON q.n <> c.n WHERE q.vec_id % 50 = 0)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM scored WHERE rank <= 5""")
def op5_mtree_search(spark: SparkSession, folder: str) -> DataFrame:
    """The five largest inner products of every fiftieth vector."""
    return top_products(spark.read.parquet(f"{folder}/embeddings.parquet"))


@registered("""
    WITH found AS (
      SELECT doc_id, row_number() OVER () AS d, regexp_extract_all(translate(text,
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
      FROM documents WHERE text IS NOT NULL),
    sized AS (SELECT doc_id, d, t, len(t) AS n FROM found WHERE len(t) > 0),
    corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM sized),
    asked AS (
      SELECT i, item_id, term, count(*) AS times FROM (
        SELECT item_id, row_number() OVER () AS i, unnest(regexp_extract_all(translate(text,
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
        FROM benchmark)
      GROUP BY ALL),
    postings AS (
      SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(t) AS term FROM sized)
      WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
    weights AS (
      SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
      FROM postings, corpus GROUP BY term, docs),
    scored AS (
      SELECT i, item_id, doc_id, d, sum(times * w * ((1000000000 * tf)
        // (1000 * tf + 12 * (75 + (25 * n * docs) // length))))::BIGINT AS score
      FROM postings JOIN weights USING (term) JOIN asked USING (term) JOIN sized USING (d), corpus
      GROUP BY ALL)
    SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, d) AS rank
      FROM scored WHERE score > 0) WHERE rank <= 20""")
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty best documents of every item of the benchmark."""
    return rank_documents(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


@registered("""
    WITH one_byte AS (
      SELECT list(v ORDER BY b) AS t FROM (
        SELECT b, list_reduce(list_concat([b::BIGINT], range(8)),
          lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) r(b))),
    turns AS (
      SELECT conv_id AS c, turn,
        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
      FROM conversations WHERE conv_id IS NOT NULL),
    own AS (
      SELECT c, list({'x': x, 'words': words} ORDER BY turn NULLS FIRST, x) AS s
      FROM turns GROUP BY c),
    heads AS (
      SELECT c, s, xor(list_reduce(list_concat([4294967295::BIGINT],
          list_transform(regexp_extract_all(hex(encode(c::VARCHAR)), '..'),
            lambda h: ('0x' || h)::BIGINT)),
        lambda v, b: xor(t[(xor(v, b) & 255) + 1], v >> 8)), 4294967295) % 4 AS h
      FROM own, one_byte),
    rebuilt AS (
      SELECT a.c, list_concat(coalesce(b.s, [])[1:h], a.s[h + 1:]) AS s
      FROM heads a LEFT JOIN own b ON b.c = a.c - a.c % 20),
    members AS (
      SELECT c, d, sha256(array_to_string(list_transform(s[1:d], lambda e: e.x), ',')) AS node,
        CASE WHEN d > 0 THEN sha256(array_to_string(list_transform(s[1:d - 1], lambda e: e.x), ','))
          END AS above,
        CASE WHEN d > 0 THEN s[d].words ELSE 0 END AS words, d = len(s) AS ends
      FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
    nodes AS (
      SELECT node, any_value(above) AS above, any_value(d) AS depth, min(c) AS conv_id,
        count(*) AS n_convs, (count(*) - 1) * any_value(words) AS saved,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), ''))
          AS ends_sha256
      FROM members GROUP BY node),
    families AS (SELECT above AS node, count(*) AS n_children FROM nodes GROUP BY above),
    sums AS (
      SELECT m.node, sum(saved)::BIGINT AS saved_tokens,
        count(*) FILTER (WHERE n_children IS NULL) AS n_leaves
      FROM nodes n JOIN members m ON m.c = n.conv_id AND m.d <= n.depth
        LEFT JOIN families f ON f.node = n.node
      GROUP BY m.node)
    SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs,
      coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
    FROM nodes n JOIN sums s ON s.node = n.node LEFT JOIN families f ON f.node = n.node
      LEFT JOIN nodes p ON p.node = n.above""")
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every distinct sequence of first turns of the rebuilt conversations."""
    return conversation_trie(spark.read.parquet(f"{folder}/conversations.parquet"))


@registered()
def op13_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the personal data in them."""
    return personal_data(documents(spark, folder))


@registered(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All stages of the pipeline over all documents."""
    return corpus_pipeline.run(spark, folder)
