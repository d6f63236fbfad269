"""A corpus pipeline of five operators: language, exact copies, near copies, mixture, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet below the checkpoint folder
and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.llm import language, mixing, packing, set_join, stream_dedup
from matchloom.llm.common import free_prefix, located, place_of
from matchloom.llm.queries import MIX_SEED, MIX_WEIGHTS, mix_levels, table
from matchloom.storage import materialize

# Share of the tokens that reach the mixture which the budget takes; every document is used once at most.
MIX_PERCENT = 90
# Languages that stay, as the network names them; none given: all that it learned.
LANGUAGES: tuple[str, ...] = ()


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of ``LANGUAGES``; those whose ``lang`` is null get the predicted one, which the mixture then reads.

    A text without letters has no language and goes, as does a null one. No score is too low, since short clean texts, and
    clean ones in several languages, have low ones. Repeated rows are judged each and alike. Columns stay as they are,
    whatever their names. An empty table gives an empty result.
    """
    predict = language.predictor(language.learn(docs))
    found = f"{free_prefix(docs.columns)}language"
    marked = docs.withColumn(found, predict(F.col("text")))
    lang = F.col(found)["lang"]
    wanted = (lang != language.UNKNOWN) & (lang.isin(*LANGUAGES) if LANGUAGES else F.lit(True))
    filled = {"lang": F.coalesce("lang", lang)} if "lang" in docs.columns else {}
    return marked.where(wanted).withColumns(filled).select(*docs.columns)


def _without(rows: DataFrame, gone: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose place isn't among the places of ``gone``."""
    place = place_of(rows)
    return rows.join(gone.select(F.col("__at").alias(place)), place, "left_anti").select(*columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the longest original, then the smallest id.

    Null, empty and blank texts are equal; of rows repeated in full one stays. Columns stay as they are, whatever their
    names. An empty table gives an empty result.
    """
    rows = located(docs)
    gone = stream_dedup.exact_copies(rows).where("NOT kept")
    return _without(rows, gone, docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies, and those without near copies.

    Row by row: another text that shares the id of a copy stays, and so does every row that is repeated in full, as its
    rows share an id. Null and blank texts have no copies. Columns stay as they are, whatever their names. An empty table
    gives an empty result.
    """
    rows = located(docs)
    gone = set_join.near_copies(rows).where("NOT kept")
    return _without(rows, gone, docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each leaf of the tree up to its budget; the last one of a leaf is cut to a prefix of its words.

    Texts without words go. Repeated rows share a place in the order: if a leaf's cut falls there, each is cut to an equal
    part. Columns stay as they are, whatever their names, but for n_chars of a text that is cut. An empty table gives an
    empty result.
    """
    prefix = free_prefix(docs.columns)
    mixed = mixing.mix(docs, mix_levels(), MIX_WEIGHTS, MIX_PERCENT, epochs=1, seed=MIX_SEED, prefix=prefix)
    taken, tokens = F.col(f"{prefix}taken"), F.col(f"{prefix}tokens")
    text = mixing.cut_text(F.col("text"), taken, tokens)
    changed = {"text": text} | ({"n_chars": F.when(taken < tokens, F.length(text).cast("long")).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {})
    return mixed.withColumns(changed).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with the CRC-32 of their token ids.

    A null text is the end id alone. Repeated rows are packed each. Columns besides id and text are not read. An empty
    table gives an empty result.
    """
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language", keep_known_languages),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A trained network and a space-filling curve have no SQL; tests/llm/test_pipeline.py holds each stage and the whole
# against plain versions (language: which texts stay, under an untrained network).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what the last one returns."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
