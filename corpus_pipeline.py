"""From raw documents to training rows in five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of docs. Stages are written to the shared work folder and read again.

Nulls: a null text is empty, a null source is a source of its own, and a null doc_id is below every
other where the smallest or largest counts. Texts of any length are read whole. Rows that repeat a
doc_id with its text go through the first stages as copies, of which one stays. Columns of any name
come along, those that an operator uses itself included. Empty tables give empty tables.
"""

import public_tokenizers

from freightflow.llm import exact_dedup, pfair, piece_viterbi, simhash_dedup, toxicity
from freightflow.llm.common import stored, text_batches

PIECES = "piece_bpe_32k.model"
#: Near copies: shingles of so many words, and their least Jaccard similarity.
NEAR_WORDS, NEAR_SIMILARITY = 5, 0.8


def drop_toxic(spark, docs, sf_dir):
    """Documents that score as toxic go; the model is learned from the labels of `docs`."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark, docs, sf_dir):
    """Of identical texts the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of each group of texts linked by their five-word shingles the smallest doc_id stays. Candidates come
    from the SimHash index of op2_simhash_dedup and from minima of the shingles."""
    return simhash_dedup.keep_one(docs, NEAR_WORDS, NEAR_SIMILARITY)


def mix_sources(spark, docs, sf_dir):
    """All documents, in files that hold the sources interleaved by their target weights."""
    return pfair.in_mixed_order(docs)


def to_pieces(spark, docs, sf_dir):
    """doc_id, ids, n_pieces, slot and place of every document in the order of the mixture, by slot
    and place; each text is decoded again and compared. Texts are encoded first, so that their ids
    are exchanged instead of them."""
    coded = piece_viterbi.training_rows(docs, public_tokenizers.path(PIECES), ("source",))
    with text_batches(docs.sparkSession):
        coded = stored(coded, "pipeline-ids")
    return pfair.placed(coded).select("doc.doc_id", "doc.ids", "doc.n_pieces", "slot", "place")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("sentencepiece", to_pieces),
]

#: The stages learn, link and search, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The training rows of `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *stages, (_, last) = STAGES
    for name, stage in stages:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
