"""The registered queries of the operators and, where SQL can express them, the DuckDB statements with equal results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            CHECKS[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents),
g AS (SELECT plain, count(*) AS group_size, first(doc_id ORDER BY length(text) DESC, doc_id) AS keep_id FROM d GROUP BY plain)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.plain) AS text_sha256 FROM d JOIN g USING (plain)
""")
def op9_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchloom.llm.stream_dedup import exact_copies

    return exact_copies(table(spark, sf_dir, "documents")).drop("__at")


SHARDS = 40
# CRC-32 of UTF-8 texts in DuckDB: a table from the polynomial, then a fold over the bytes.
CRC_SQL = r"""
t AS (SELECT list(list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc FROM range(256) r(i)),
texts AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
crcs AS (SELECT text, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(octet_length(encode(text))), lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT),
  lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]))) AS crc FROM texts, t)
"""


@query(rf"""
WITH {CRC_SQL},
d AS (SELECT doc_id, coalesce(octet_length(encode(documents.text)), 0) + 16 AS size, crc AS text_crc32, coalesce(doc_id::VARCHAR, '\N') AS k FROM documents JOIN crcs ON crcs.text = coalesce(documents.text, '')),
k AS (SELECT DISTINCT k FROM d),
draws AS (SELECT k, s, -ln((('0x' || substr(md5(k || ':' || (s // 2)), (1 + 16 * (s % 2))::INT, 13))::BIGINT + 1) / 4503599627370496.0::DOUBLE) AS draw FROM k, range({SHARDS + 1}) r(s)),
chosen AS (SELECT k, arg_min(s, draw) FILTER (WHERE s < {SHARDS}) AS shard, arg_min(s, draw) AS grown_shard FROM draws GROUP BY k)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard, grown_shard::INTEGER AS grown_shard,
  row_number() OVER (PARTITION BY shard ORDER BY md5(concat_ws(chr(31), k, size, text_crc32))) - 1 AS slot FROM d JOIN chosen USING (k)
""")
def op2_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchloom.llm.sharding import assign

    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return assign(rows, "doc_id", [1.0] * SHARDS, [1.0] * (SHARDS + 1)).withColumn("law", F.lit("key"))


# Relative weights of nodes of the tree domain / language / source; others weigh 1.
MIX_WEIGHTS = {("web",): 5, ("books",): 3, ("code",): 2, ("web", "en"): 6, ("web", "de"): 3, ("books", "es"): 4, ("web", "en", "src0"): 2, ("code", "fr", "src11"): 3}
MIX_PERCENT, MIX_EPOCHS, MIX_SEED = 120, 4, 17


def mix_levels(domain_of: str = "source") -> dict:
    """The domain stands for groups of sources: web, books, code by the number in the source's name."""
    number = F.try_to_number(F.regexp_extract(domain_of, "([0-9]+)$", 1), F.lit("999999999")).cast("long") % 3
    domain = F.when(number == 1, "books").when(number == 2, "code").otherwise("web")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def _case(depth: int) -> str:
    names = ("domain", "lang", "source")[:depth]
    whens = [f"WHEN {' AND '.join(f'{n} = {chr(39)}{v}{chr(39)}' for n, v in zip(names, path))} THEN {w}" for path, w in MIX_WEIGHTS.items() if len(path) == depth]
    return f"CASE {' '.join(whens)} ELSE 1 END" if whens else "1"


def _divide_sql(depth: int) -> str:
    path = ["domain", "lang", "source"][:depth]
    parent = path[:-1]
    keys, by = ", ".join(path), f"PARTITION BY {', '.join(parent)}" if parent else ""
    order = f"{by} ORDER BY cap / weight, {path[-1]}"
    source = f"JOIN b{depth - 1} USING ({', '.join(parent)})" if parent else ", b0"
    return f"""
c{depth} AS (SELECT {keys}, cap, {_case(depth)} AS weight FROM (SELECT {keys}, sum(supply * {MIX_EPOCHS}) AS cap FROM leaves GROUP BY {keys})),
d{depth} AS (SELECT c{depth}.*, budget, coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
  sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM c{depth} {source}),
e{depth} AS (SELECT *, bool_and(cap::HUGEINT * weights <= weight::HUGEINT * (budget - spent)) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS short FROM d{depth}),
f{depth} AS (SELECT *, budget - sum(CASE WHEN short THEN cap ELSE 0 END) OVER ({by}) AS rest, sum(CASE WHEN short THEN 0 ELSE weight END) OVER ({by}) AS alls,
  sum(CASE WHEN short THEN 0 ELSE weight END) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sofar FROM e{depth}),
b{depth} AS (SELECT {keys}, CASE WHEN short THEN cap ELSE (sofar::HUGEINT * rest) // alls - ((sofar - weight)::HUGEINT * rest) // alls END::BIGINT AS budget FROM f{depth})"""


@query(rf"""
WITH t AS (SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS tokens,
  CASE coalesce(TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 3, 0) WHEN 1 THEN 'books' WHEN 2 THEN 'code' ELSE 'web' END AS domain FROM documents),
tagged AS (SELECT * FROM t WHERE tokens > 0),
leaves AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS supply FROM tagged GROUP BY ALL),
b0 AS (SELECT least(sum(supply) * {MIX_PERCENT} // 100, sum(supply) * {MIX_EPOCHS}) AS budget FROM leaves),
{_divide_sql(1)}, {_divide_sql(2)}, {_divide_sql(3)},
plan AS (SELECT *, budget // supply AS full_, budget % supply AS rest FROM leaves JOIN b3 USING (domain, lang, source)),
x AS (SELECT *, unnest(range(full_ + 1)) AS epoch FROM tagged JOIN plan USING (domain, lang, source)),
y AS (SELECT *, md5(concat_ws(':', '{MIX_SEED}', epoch, doc_id, tokens)) AS place FROM x),
z AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY domain, lang, source, epoch ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM y),
r AS (SELECT doc_id, domain, lang, source, epoch, tokens, CASE WHEN epoch < full_ THEN tokens ELSE greatest(0, least(tokens, rest - before)) END::BIGINT AS taken FROM z)
SELECT * FROM r WHERE taken > 0
""")
def op4_mix_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchloom.llm.mixing import mix

    mixed = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), mix_levels(), MIX_WEIGHTS, MIX_PERCENT, MIX_EPOCHS, MIX_SEED)
    return mixed.select("doc_id", F.col("__domain").alias("domain"), F.col("__lang").alias("lang"), F.col("__source").alias("source"), F.col("__epoch").alias("epoch"), F.col("__tokens").alias("tokens"), F.col("__taken").alias("taken"))


MIN_SITES = 6


@query(rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '\N') AS site FROM documents),
l AS (SELECT r, site, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
b AS (SELECT trim(regexp_replace(line, '[\t\r]', ' ', 'g'), ' ') AS bare, count(DISTINCT site) AS sites FROM l GROUP BY bare HAVING bare <> '' AND sites >= {MIN_SITES}),
m AS (SELECT l.*, b.bare IS NOT NULL AS gone FROM l LEFT JOIN b ON trim(regexp_replace(line, '[\t\r]', ' ', 'g'), ' ') = b.bare)
SELECT doc_id, n_lines, n_removed, text_md5 FROM (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
  md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS text_md5 FROM m JOIN d USING (r, site) GROUP BY r)
""".replace("any_value(doc_id)", "any_value(d.doc_id)"))
def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchloom.llm.line_spread import clean_lines

    return clean_lines(table(spark, sf_dir, "documents"), MIN_SITES).select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def secret_columns() -> list:
    """What the query returns of a row's spans."""
    from matchloom.llm.secret_scan import KINDS, joined

    base = F.filter("spans", lambda s: s["kind"] != "owned")
    counts = [F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    by_status = [F.size(F.filter("spans", lambda s: s["status"] == status)).cast("long").alias(f"n_{status}") for status in ("live", "shared", "example")]
    return ["doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), *by_status]


@query()
def op10_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchloom.llm.secret_scan import find_secrets

    found = find_secrets(table(spark, sf_dir, "documents"), owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"))
    return found.select(*secret_columns())


@query()
def op1_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from matchloom.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, payload_bytes, max(page_id) AS top FROM p WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN top > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN top > page_id THEN top END AS refers_to FROM p LEFT JOIN g USING (payload_digest, payload_bytes)
""")
def op5_warc_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchloom.llm.warc import normalise, read_records, resolve, write_monolithic

    archives = normalise(write_monolithic(resolve(table(spark, sf_dir, "pages"))))
    return read_records(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("""
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM v a, v b WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
c(u, w) AS (SELECT u, w FROM l UNION SELECT c.u, l.w FROM c JOIN l ON c.w = l.u),
n AS (SELECT u, count(*) AS n FROM l GROUP BY u), m AS (SELECT u, min(w) AS low FROM c GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, low) AS component_id, vec_id <= coalesce(low, vec_id) AS kept FROM embeddings LEFT JOIN n ON n.u = vec_id LEFT JOIN m ON m.u = vec_id
""")
def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchloom.llm.vector_index import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


@query(r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 75 * (a.n + b.n - c)),
c(u, v) AS (SELECT u, v FROM l UNION SELECT c.u, l.v FROM c JOIN l ON c.v = l.u),
m AS (SELECT u, min(v) AS low FROM c GROUP BY u)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, low) AS component_id, d.doc_id = least(d.doc_id, low) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.u = d.doc_id
""")
def op6_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchloom.llm.set_join import near_copies

    return near_copies(table(spark, sf_dir, "documents"))


@query()
def op3_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchloom.llm.language import held_out, learn, predictor

    docs = table(spark, sf_dir, "documents")
    predict = predictor(learn(docs))
    read = docs.select("doc_id", predict(F.col("text")).alias("found"))
    return read.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


@query()
def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchloom.llm.order_minhash import compare_next

    return compare_next(table(spark, sf_dir, "documents"))


LLOYD_CLUSTERS, LLOYD_ROUNDS = 8, 10


def _lloyd_sql() -> str:
    """Each round is a pair of tables: a, the assignment, and c, the centroids it moves."""
    distance = "list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    steps = []
    for r in range(LLOYD_ROUNDS + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT row_, x, arg_min(j, d * {LLOYD_CLUSTERS} + j) AS j, min(d) AS d FROM (SELECT row_, x, j, {distance} AS d FROM v, c{r}) GROUP BY row_, x)")
        if r < LLOYD_ROUNDS:
            steps.append(
                f"m{r} AS (SELECT j, k, sum(e) AS s, count(*) AS n FROM (SELECT j, unnest(x) AS e, generate_subscripts(x, 1) AS k FROM a{r}) GROUP BY j, k), "
                f"n{r} AS (SELECT j, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY k) AS moved FROM m{r} GROUP BY j), "
                f"c{r + 1} AS MATERIALIZED (SELECT j, coalesce(moved, c) AS c FROM c{r} LEFT JOIN n{r} USING (j))"
            )
    return ",\n".join(steps)


@query(f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row_, vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), x) - 1 AS j, x AS c FROM v QUALIFY j < {LLOYD_CLUSTERS}),
{_lloyd_sql()},
s AS (SELECT j, sum(d)::BIGINT AS cluster_inertia FROM a{LLOYD_ROUNDS} GROUP BY j)
SELECT vec_id, a.j::INTEGER AS cluster, d AS distance, cluster_inertia, (SELECT sum(d)::BIGINT FROM a{LLOYD_ROUNDS}) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{LLOYD_ROUNDS} a JOIN v USING (row_) JOIN s USING (j) JOIN c{LLOYD_ROUNDS} c ON c.j = a.j
""")
def op12_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd_columns(table(spark, sf_dir, "embeddings"))


def lloyd_columns(vectors: DataFrame) -> DataFrame:
    """What the query returns of a table of vectors."""
    from matchloom.llm.sharded_lloyd import cluster
    from matchloom.storage import materialize

    order = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    found, centroids = cluster(vectors, order, LLOYD_CLUSTERS, LLOYD_ROUNDS)
    found = materialize(found, "clustered")
    schema = "cluster int, centroid string"
    named = vectors.sparkSession.createDataFrame([(j, ",".join(map(str, c))) for j, c in enumerate(centroids)], schema)  # a row per cluster
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = found.agg(F.sum("distance").alias("inertia"))
    sums = sums.join(named, "cluster").select("cluster", "cluster_inertia", F.sha2("centroid", 256).alias("centroid_sha256"))
    return found.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(whole.first()["inertia"]).cast("long").alias("inertia"), "centroid_sha256")


@query()
def op13_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchloom.llm.spectrum_whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"))
