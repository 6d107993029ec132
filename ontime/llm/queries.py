"""One query for each operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ontime.llm import bpe, jaccard, licenses, mixing, neardup, packing, pii, quality, resample, suffix, urls, warc, whitening
from ontime.session import fresh_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Smallest id that links reach, from ``vertices`` (id) and ``links`` (a, b).
_REACHED = (
    "ways AS (SELECT a AS x, b AS y FROM links UNION ALL SELECT b, a FROM links), "
    "reached AS (SELECT id, id AS other FROM vertices UNION SELECT ways.y, reached.other FROM reached JOIN ways ON ways.x = reached.id), "
    "component AS (SELECT id, min(other) AS component_id FROM reached GROUP BY id)"
)


@query()
def op1_quality_repetition(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", quality.score("text").alias("q"))
    return docs.select("doc_id", "q.*")


@query()
def op2_pii_skip_chain(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", pii.annotate("text", pii.fit(docs)).alias("found")).select("doc_id", "found.*")
    listed = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    of_kind = lambda k: F.filter("base", lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SHINGLES = (
    "CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(words) < 4 THEN [array_to_string(words, ' ')] "
    "ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' ')) END"
)


@query(
    "WITH RECURSIVE cut AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), "
    f"'{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents), "
    f"shingles AS (SELECT DISTINCT doc_id, unnest({_SHINGLES}) AS shingle FROM cut), "
    "sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id), "
    "met AS (SELECT s.doc_id AS a, t.doc_id AS b, count(*) AS c FROM shingles s JOIN shingles t ON s.shingle = t.shingle AND s.doc_id < t.doc_id GROUP BY ALL), "
    "links AS (SELECT a, b FROM met JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)), "
    f"vertices AS (SELECT doc_id AS id FROM documents), {_REACHED} "
    "SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents d LEFT JOIN sizes USING (doc_id) JOIN component ON id = d.doc_id"
)
def op3_jaccard_count_tree(spark, sf_dir):
    return jaccard.classes(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query()
def op4_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").alias("chars"))
    parts = mixing.tempered_weights(docs, "source", F.col("chars"))
    return mixing.interleave(docs, parts, "source", F.col("chars"), ["doc_id"])


@query(
    "WITH RECURSIVE ok AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL "
    "AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0), "
    "links AS (SELECT s.vec_id AS a, t.vec_id AS b FROM ok s JOIN ok t ON s.label = t.label AND s.vec_id < t.vec_id AND len(s.v) = len(t.v) "
    "WHERE list_dot_product(s.v, t.v) / sqrt(list_dot_product(s.v, s.v) * list_dot_product(t.v, t.v)) >= 0.98), "
    f"vertices AS (SELECT vec_id AS id FROM embeddings), {_REACHED}, "
    "degrees AS (SELECT x AS id, count(*) AS n FROM ways GROUP BY x) "
    "SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept "
    "FROM embeddings e JOIN component c ON c.id = e.vec_id LEFT JOIN degrees g ON g.id = e.vec_id"
)
def op5_collision_counting(spark, sf_dir):
    found = neardup.classes(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
    return found.withColumn("kept", F.col("vec_id") == F.col("component_id"))


@query()
def op6_suffix_induced(spark, sf_dir):
    return suffix.remove_repeats(table(spark, sf_dir, "documents")).drop("spans").withColumnRenamed("id", "doc_id")


@query()
def op7_license_dice(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select("doc_id", licenses.scan("text").alias("m"))
    names = F.array_sort(F.array_distinct("m.license"))
    return found.select("doc_id", F.size("m").cast("long").alias("n_matches"), F.concat_ws(",", names).alias("licenses"), F.array_max("m.dice").alias("best_dice"))


def pack_documents(docs: DataFrame, source: str | None = None, place: Column | None = None) -> DataFrame:
    """With the public byte-level vocabulary, in both of its forms."""
    import public_tokenizers as public

    packed = packing.pack(docs, public.path("byte_bpe_50k.json"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN, source=source, place=place)
    return packed.withColumnRenamed("id", "doc_id")


@query()
def op8_pack_islands(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))


#: Host, path and verdict of the written rules.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def url_rules(spark: SparkSession) -> DataFrame:
    """As an inline table, whose size Spark knows."""
    return spark.sql("SELECT * FROM VALUES " + ", ".join(str(r) for r in URL_RULES) + " AS t(host, path, verdict)")


@query()
def op9_url_trees(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    ruled = urls.with_rules(pages, url_rules(spark))
    return urls.judge(ruled, urls.fit(ruled)).select("page_id", "host", "path", "rule", "verdict")


_FIVE_BITS = "(CAST('0x' || substr(hex, 1 + 10 * (i // 8), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31"


@query(
    "SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: "
    f"substr('{warc.BASE32}', CAST(1 + ({_FIVE_BITS}) AS BIGINT), 1)), '') AS payload_digest, "
    "CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to "
    "FROM (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first "
    "FROM (SELECT page_id, coalesce(html, '') AS payload FROM pages))"
)
def op10_warc_addressed(spark, sf_dir):
    archive = fresh_dir(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), archive, "page_id", "url", "html")
    records = warc.read(spark, archive)
    return records.select(F.col("id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")


@query()
def op11_bpe_monoid(spark, sf_dir):
    import public_tokenizers as public

    ranks = public.path("byte_bpe_multi_50k.tiktoken")
    both = table(spark, sf_dir, "documents").select("doc_id", bpe.round_trip("text", ranks, public.PATTERN).alias("both")).select("doc_id", "both.*")
    n_tokens = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return both.select("doc_id", n_tokens, F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), '" + _UPPER + "', '" + _LOWER + "'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
#: One step of a CRC-32 register, and the table of all 256, worked out by rule.
_EIGHT_BITS = "list_reduce(list_prepend(r, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)"
_BYTES = "list_transform(range(1, CAST(len(h) AS BIGINT), 2), lambda i: CAST('0x' || h[i : i + 1] AS BIGINT))"
_NOISE = "(CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5) / 4294967296"


@query(
    f"WITH crc AS (SELECT list({_EIGHT_BITS} ORDER BY r) AS step FROM range(256) t(r)), "
    f"d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS words FROM documents), b AS (SELECT {_WORDS} AS words FROM benchmark), "
    "uses AS (SELECT row, unnest(words) AS word FROM d), aims AS (SELECT unnest(words) AS word FROM b), "
    f"hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM uses UNION SELECT word FROM aims)), "
    f"hashed AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, {_BYTES}), "
    "lambda c, x: xor(step[1 + (xor(c, x) & 255)], c >> 8))) % 10000 AS bucket FROM hexed, crc), "
    "s AS (SELECT bucket, count(*) AS s FROM uses JOIN hashed USING (word) GROUP BY bucket), "
    "t AS (SELECT bucket, count(*) AS t FROM aims JOIN hashed USING (word) GROUP BY bucket), "
    "gains AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM uses) + 10000.0::DOUBLE) "
    "/ ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM aims) + 10000.0::DOUBLE)))) AS BIGINT) AS gain "
    "FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)), "
    "weights AS (SELECT row, CAST(sum(gain) AS BIGINT) AS weight FROM uses JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row), "
    "scored AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, "
    f"coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln({_NOISE}))) AS BIGINT) AS score FROM d LEFT JOIN weights USING (row)), "
    "placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place FROM scored) "
    "SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank "
    "FROM placed"
)
def op12_resample_crc(spark, sf_dir):
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resample.resample(docs, target).drop("n_words").withColumnRenamed("id", "doc_id")


@query()
def op13_whiten_polar(spark, sf_dir):
    found = whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
    # A long by its contract: null where 64 bits do not hold it, with all digits beside it.
    return found.withColumn("deviation_exact", F.col("deviation")).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
