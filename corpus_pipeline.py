"""The corpus pipeline: documents in, packed training sequences out.

Each stage is a function of ``(spark, docs, sf_dir)``; its result is written as Parquet and
read again as the next stage's documents.
"""

from laurel.llm import digest_index, hamming_dedup, language_id, mixing, packing
from laurel.llm.common import free_name, held_out, ship, stage, table

#: Texts whose letter sequences fit no learned language at all lie below this score.
MIN_LANGUAGE_SCORE = 0.1
BUDGET, EPOCHS, SEED = 0.8, 1, 1

ORACLE_SQL = None


def language(spark, docs, sf_dir):
    """Keep documents of a known language; those without letters or like none of them go."""
    ship(spark)
    profiles = language_id.learn_profiles(docs.where(~held_out("doc_id", 4, 2)))
    own = free_name(docs, "language")
    predicted = language_id.language_of(docs["text"], profiles)
    found = docs.withColumn(own, predicted)
    return found.where(f"{own}.lang <> '{language_id.UNKNOWN}' AND {own}.score >= {MIN_LANGUAGE_SCORE}").select(docs.columns)


def exact(spark, docs, sf_dir):
    """Keep the smallest id of equal texts."""
    ship(spark)
    return digest_index.exact_dedup(docs)


def near(spark, docs, sf_dir):
    """Keep one document of each group of near copies."""
    ship(spark)
    return hamming_dedup.drop_near_duplicates(docs)


def mix(spark, docs, sf_dir):
    """Keep each leaf's share of the token budget; no document comes twice."""
    ship(spark)
    return mixing.mix(docs, BUDGET, EPOCHS, SEED)


def pack(spark, docs, sf_dir):
    """Place every document's tokens in sequences."""
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark, sf_dir):
    """Apply all stages to the documents."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stage(docs, name)
    return docs
