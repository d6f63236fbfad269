"""Secrets in texts, told apart by who owns copies of them.

Base patterns give spans by kind. The value of every span, and of every further long token that looks random, is hashed;
hashes are counted over distinct owners and repositories in the whole corpus. A value with few owners looks live; one
that many owners have is a copied example. Live tokens add spans of kind ``owned`` to the base ones.

All is SQL: a pattern's matches are marked, the text is split at the marks, and lengths add up to positions. Hashes are
counted in three steps (hash with owner and repository, hash with owner, hash), each with sums before its shuffle.

Defined results. A null text counts as empty. Null owners and repositories are one owner and one repository. Repeated
rows are scanned each, but count once. Columns besides those named are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.storage import materialize

# The base kinds in their order. Pattern, group with the value, least length of the value.
KINDS = {
    "assign": ("""(?i)(password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
}
# Filters that are cheap and never miss a match that counts.
FIRST = {"assign": "(?i)(password|passwd|secret|token|api_?key)", "access": "AKIA[A-Z0-9]{16}", "hex": "[0-9a-f]{24}"}
# Tokens that look random: long, with a digit and letters of both cases.
TOKEN = "[A-Za-z0-9+/_-]+"
TOKEN_FIRST = "[A-Za-z0-9+/_-]{20}"
# Stands between the pieces of a text; a text's own is replaced by a character of the same length that no pattern has.
MARK, OWN = "\x01", "\x02"


def spans(text: Column, pattern: str, group: int, least: int) -> Column:
    """array<struct<start, end, value>> in code points: leftmost matches, those with a long enough value."""
    pieces = F.split(F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(OWN)), pattern, f"{MARK}$0{MARK}"), MARK)
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(False).alias("inside"), empty.alias("found"))

    def step(state: Column, piece: Column) -> Column:
        end = state["at"] + F.length(piece)
        value = F.regexp_extract(piece, pattern, group)
        one = F.array(F.struct(state["at"].alias("start"), end.alias("end"), value.alias("value")))
        found = F.when(state["inside"] & (F.length(value) >= least), F.concat(state["found"], one)).otherwise(state["found"])
        return F.struct(end.alias("at"), (~state["inside"]).alias("inside"), found.alias("found"))

    return F.aggregate(pieces, start, step, lambda state: state["found"])


def _found(text: Column, pattern: str, group: int, least: int, first: str, kind: str, rank: int) -> Column:
    found = F.when(text.rlike(first), spans(text, pattern, group, least))
    return F.transform(
        F.coalesce(found, F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")),
        lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash"), s["value"].alias("value")),
    )


def scan(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc_id, spans: (start, rank, kind, end, hash) sorted, candidates of kind ``owned`` last among equals."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    kinds = [_found(text, pattern, group, least, FIRST[kind], kind, rank) for rank, (kind, (pattern, group, least)) in enumerate(KINDS.items())]
    base = F.concat(*kinds)
    tokens = _found(text, TOKEN, 0, 20, TOKEN_FIRST, "owned", len(KINDS))
    random = F.filter(tokens, lambda t: t["value"].rlike("[0-9]") & t["value"].rlike("[a-z]") & t["value"].rlike("[A-Z]"))
    out = docs.select(F.col(id_column).alias("doc_id"), "owner", "repository", base.alias("base"), random.alias("random"))
    fresh = F.filter("random", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return out.select("doc_id", "owner", "repository", F.array_sort(F.concat("base", fresh)).alias("spans"))


def ownership(found: DataFrame) -> DataFrame:
    """hash -> owners, repositories: in how many distinct ones it is."""
    each = found.select("owner", "repository", F.explode(F.array_distinct(F.transform("spans", lambda s: s["hash"]))).alias("hash"))
    by_repository = each.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count("one").alias("repositories"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"))


def find_secrets(docs: DataFrame, owner: Column, repository: Column, id_column: str = "doc_id", text_column: str = "text", live_owners: int = 2, example_owners: int = 5) -> DataFrame:
    """doc_id, spans (start, rank, kind, end, hash, owners, repositories, status) of each row of ``docs``.

    Status: ``live`` up to ``live_owners`` owners, ``example`` from ``example_owners`` on, else ``shared``. A candidate
    of kind ``owned`` is only returned if it is live.
    """
    tagged = docs.withColumns({"owner": F.coalesce(owner.cast("string"), F.lit("\\N")), "repository": F.coalesce(repository.cast("string"), F.lit("\\N"))})
    found = scan(tagged.select(id_column, text_column, "owner", "repository"), id_column, text_column)
    found = found.withColumn("spans", F.transform("spans", lambda s: F.struct(*[s[c].alias(c) for c in ("start", "rank", "kind", "end", "hash")])))
    found = materialize(found.withColumn("row", F.monotonically_increasing_id()), "spans")
    with_some = found.where(F.size("spans") > 0)
    counts = ownership(with_some)
    each = with_some.select("row", F.explode("spans").alias("s")).withColumn("hash", F.col("s.hash")).join(counts, "hash")
    status = F.when(F.col("owners") <= live_owners, "live").when(F.col("owners") >= example_owners, "example").otherwise("shared")
    each = each.withColumn("status", status).where("s.kind <> 'owned' OR status = 'live'")
    whole = F.struct("s.start", "s.rank", "s.kind", "s.end", "s.hash", "owners", "repositories", "status")
    gathered = each.groupBy("row").agg(F.array_sort(F.collect_list(whole)).alias("spans"))
    return found.select("row", "doc_id").join(gathered, "row", "left").select("doc_id", F.coalesce("spans", F.array().cast(gathered.schema["spans"].dataType)).alias("spans"))


def joined(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
