"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampType

from matchloom.operators.aggregates import profile_columns
from matchloom.operators.clean import first_per_key
from matchloom.plans import views as V
from matchloom.plans.registry import query
from matchloom.sources import describe, readers, writers
from matchloom.storage import materialize, new_path

T = V.table


@query("s1_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal, NULL::VARCHAR AS _corrupt_record FROM customer")
def csv_scan(spark, sf):
    path = new_path(spark, "customer-csv")
    customers = T(spark, sf, "customer")
    customers.write.option("header", True).csv(path)
    return readers.read_csv(spark, path, customers.schema)


@query(
    "s1_bad_lines",
    """SELECT CASE c_custkey % 40 WHEN 1 THEN 'columns' WHEN 2 THEN 'columns' WHEN 3 THEN 'cast c_custkey' WHEN 4 THEN 'cast c_acctbal' ELSE 'good' END AS reason,
      count(*) AS lines, sum(CASE WHEN c_custkey % 40 IN (1, 2, 3, 4) THEN 0 ELSE c_custkey END)::BIGINT AS keys FROM customer GROUP BY 1""",
)
def bad_lines(spark, sf):
    """Customers as lines, some of them damaged; every line is a good row or a bad line."""
    path, part = new_path(spark, "customer-lines"), F.col("c_custkey") % 40
    fields = [F.when(part == 3, F.concat(F.lit("k"), F.col("c_custkey"))).otherwise(F.col("c_custkey").cast("string")), F.col("c_name"), F.when(part == 4, "much").otherwise(F.col("c_acctbal").cast("string"))]
    line = F.when(part == 1, F.concat_ws(",", *fields[:2])).when(part == 2, F.concat_ws(",", *fields, F.lit("more"))).otherwise(F.concat_ws(",", *fields))
    # One column under another separator, so that every file gets the header and lines stay as they are.
    T(spark, sf, "customer").select(line.alias("c_custkey,c_name,c_acctbal")).write.option("header", True).option("sep", "\x01").csv(path)
    good, bad = readers.read_checked(spark, path, {"c_custkey": "bigint", "c_acctbal": "double"})
    both = good.select(F.lit("good").alias("reason"), "c_custkey").union(bad.select("reason", F.lit(0)))
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("lines"), F.sum("c_custkey").alias("keys"))


@query("s2_optional_source", "SELECT 'orders' AS source, count(*) AS n FROM orders UNION ALL SELECT 'returns', 0")
def optional_source(spark, sf):
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_orderdate", TimestampType())])
    count = lambda name: readers.read_optional(spark, f"{sf}/{name}.parquet", schema).agg(F.lit(name).alias("source"), F.count(F.lit(1)).alias("n"))
    return count("orders").unionByName(count("returns"))


@query("s3_fallback_source", "SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier")
def fallback_source(spark, sf):
    schema = StructType([StructField("key", LongType()), StructField("label", StringType()), StructField("amount", DoubleType())])
    missing = readers.read_optional(spark, f"{sf}/partner.parquet", schema)
    nobody = T(spark, sf, "customer").filter(F.col("c_acctbal").isNull()).select("c_custkey", "c_name", "c_acctbal")
    suppliers = T(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return readers.first_non_empty(
        [
            (missing, {"key": "id", "label": "name", "amount": "balance"}),
            (nobody, {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance"}),
            (suppliers, {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"}),
        ]
    )


@query(
    "s4_json_matrix",
    """SELECT event_type AS model_name, a.c AS actual, p.c AS predicted, count(k) AS n FROM (SELECT DISTINCT event_type FROM events) e,
    (SELECT unnest([0, 1, 2]) AS c) a, (SELECT unnest([0, 1, 2]) AS c) p
    LEFT JOIN (SELECT event_type AS t, (user_id % 3)::INTEGER AS u, ((props ->> '$.k')::BIGINT % 3)::INTEGER AS k FROM events) x ON x.t = event_type AND x.u = a.c AND x.k = p.c
    GROUP BY 1, 2, 3""",
)
def json_matrix(spark, sf):
    events = T(spark, sf, "events").select("event_type", (F.col("user_id") % 3).alias("u"), (F.from_json("props", "k bigint")["k"] % 3).alias("k"))
    cell = lambda u, k: F.count(F.when((F.col("u") == u) & (F.col("k") == k), 1))
    matrix = F.array(*[F.array(*[cell(u, k) for k in range(3)]) for u in range(3)]).alias("confusion_matrix")
    path = new_path(spark, "reports")
    writers.write_json(events.groupBy(F.col("event_type").alias("model_name")).agg(matrix), path)
    return readers.read_reports(spark, path, multi_line=False)


@query("s5_csv_sink", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_sink(spark, sf):
    path = new_path(spark, "export-csv")
    suppliers = T(spark, sf, "supplier")
    writers.write_csv(suppliers, path)
    return readers.read_csv(spark, path, suppliers.schema).drop(readers.CORRUPT)


@query(
    "s6_nested_summary",
    """WITH r AS (SELECT *, CAST(row_number() OVER (ORDER BY champion_count DESC, team) AS INTEGER) AS place, (SELECT sum(champion_count) FROM title_odds)::BIGINT AS n_simulations FROM title_odds)
    SELECT 'all' AS part, n_simulations, place, team, champion_count, championship_probability FROM r UNION ALL SELECT 'top', n_simulations, place, team, champion_count, championship_probability FROM r WHERE place <= 10""",
)
def nested_summary(spark, sf):
    odds = V.title_odds(spark, sf)
    path = new_path(spark, "summary")
    document = writers.nested_summary(odds, odds.agg(F.sum("champion_count")).scalar(), "team", "champion_count", "championship_probability")
    writers.write_json(document, path)
    back = spark.read.schema(document.schema).json(path)
    part = lambda name, c: back.select(F.lit(name).alias("part"), "n_simulations", F.posexplode(c).alias("p", "r"))
    rows = part("all", "all_results").unionByName(part("top", "top_10"))
    return rows.select("part", "n_simulations", (F.col("p") + 1).alias("place"), "r.*")


@query("s7_feature_store", "SELECT pool, seq, d, home, away FROM contest WHERE pool = 'BUILDING'")
def feature_store(spark, sf):
    path = new_path(spark, "store")
    writers.write_feature_store(V.contest(spark, sf).select("pool", "seq", "d", "home", "away"), path, "pool")
    schema = "seq bigint, d date, home string, away string, pool string"
    return spark.read.schema(schema).parquet(path).filter(F.col("pool") == "BUILDING")


CONTEST = ["pool", "d", "home", "away", "home_score", "away_score", "tournament", "neutral", "stage", "attendance", "seq"]


@query("s7_rewrite_partition", "SELECT pool, count(*) AS n, sum(seq)::BIGINT AS places FROM contest WHERE pool <> (SELECT min(pool) FROM contest) OR seq % 2 = 0 GROUP BY pool")
def rewrite_partition(spark, sf):
    """A feature store of which one pool is written anew; read through a join with the pools wanted."""
    path, games = new_path(spark, "store"), V.contest(spark, sf)
    writers.write_feature_store(games, path, "pool")
    first = games.agg(F.min("pool")).first()[0]
    writers.rewrite_partitions(games.where((F.col("pool") == first) & (F.col("seq") % 2 == 0)), path, "pool")
    return spark.read.schema(games.schema).parquet(path).groupBy("pool").agg(F.count(F.lit(1)).alias("n"), F.sum("seq").alias("places"))


@query("f5_indexed_lookup", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders)")
def indexed_lookup(spark, sf):
    def build():
        path = new_path(spark, "lookup")
        writers.write_lookup(T(spark, sf, "orders"), path, "o_orderkey")
        return spark.read.parquet(path)

    key = T(spark, sf, "orders").agg(F.max("o_orderkey")).first()[0]
    return build().where(F.col("o_orderkey") == key).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "s8_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS non_null, count(DISTINCT {c}) AS distinct_values, min({c})::VARCHAR AS min_value, max({c})::VARCHAR AS max_value FROM contest"
        for c in CONTEST
    ),
)
def profile(spark, sf):
    return profile_columns(V.contest(spark, sf), CONTEST)


TEXTS = {
    "team": "Name of the team.",
    "champion_count": "Finals won.",
    "championship_probability": "Finals won, percent of all.",
    "feature": "Name of the feature.",
    "actor": "Name of the team.",
    "elo_rating": "Rating after the last contest.",
}
# Stored tables and the kinds of their columns.
TABLES = {
    "title_odds": {"team": "string", "champion_count": "numeric", "championship_probability": "numeric"},
    "contest": {c: "string" for c in ("pool", "home", "away", "tournament", "stage")} | {"d": "date", "neutral": "boolean"} | {c: "numeric" for c in ("home_score", "away_score", "attendance", "seq")},
    "profile": {"actor": "string"} | {c: "numeric" for c in ("elo_rating", "form_score", "goals_scored_avg", "goals_conceded_avg", "win_pct", "total_matches", "rank", "rank_points", "avg_overall", "avg_attack", "avg_defense", "team_strength_score")},
    "rank_hist": {"actor": "string", "ts": "date", "rank": "numeric", "points": "numeric"},
}


@query(
    "s9_dictionary",
    " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, '{c}' AS column_name, '{kind}' AS data_type, '{TEXTS.get(c, '')}' AS description, count({c}) AS filled FROM {t}" for t, columns in TABLES.items() for c, kind in columns.items()
    ),
)
def dictionary(spark, sf):
    return describe.data_dictionary({t: describe.described(getattr(V, t)(spark, sf).select(*columns), TEXTS) for t, columns in TABLES.items()})


@query("s10_class_distribution", "SELECT CASE WHEN home_score > away_score THEN 2 WHEN home_score < away_score THEN 0 ELSE 1 END AS label, count(*) AS n FROM contest GROUP BY 1")
def class_distribution(spark, sf):
    from matchloom.functions.outcomes import outcome_label

    games, _ = describe.counted(V.contest(spark, sf), "contest rows")
    return games.groupBy(outcome_label(F.col("home_score"), F.col("away_score")).alias("label")).agg(F.count(F.lit(1)).alias("n"))


_STEPS = """WITH a AS (SELECT * FROM documents), b AS (SELECT * FROM a WHERE text IS NOT NULL AND trim(text) <> ''), c AS (SELECT * FROM b WHERE n_chars >= 200),
n AS (SELECT (SELECT count(*) FROM a) AS a, (SELECT count(*) FROM b) AS b, (SELECT count(*) FROM c) AS c, (SELECT count(DISTINCT text) FROM c) AS d)
SELECT 'documents' AS dataset, unnest(range(5))::INTEGER AS step, unnest(['read', 'blank', 'short', 'duplicate', 'kept']) AS rule, unnest([a, a - b, b - c, c - d, d]) AS n FROM n"""


@query("s10_rows_by_rule", _STEPS)
def rows_by_rule(spark, sf):
    """Rows read, dropped by each rule and kept, counted while the kept ones are written."""
    steps = describe.Steps("documents")
    rows = steps(T(spark, sf, "documents"), "read")
    rows = steps(rows.where("text IS NOT NULL AND trim(text) <> ''"), "blank")
    rows = steps(rows.where("n_chars >= 200"), "short")
    materialize(steps(first_per_key(rows, ["text"], [F.col("doc_id")]), "duplicate"), "kept")
    return steps.report(spark)
