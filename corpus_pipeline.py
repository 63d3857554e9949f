"""A corpus pipeline: quality rules, near copies, benchmark passages, personal data, pieces.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written and read again as the next one's docs.
All but the last return the columns of documents. Rows with nulls, empty texts or repeated ids are handled as the
operators say; an empty table passes through.
"""

from chatterscope.llm.common import keep, table
from chatterscope.llm.decontamination import drop_contaminated
from chatterscope.llm.jaccard import drop_near_copies
from chatterscope.llm.pii import mask_documents
from chatterscope.llm.quality import drop_low_quality
from chatterscope.llm.sentencepiece import encoded, load_vocabulary

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def quality_rules(spark, docs, sf_dir):
    """Documents that fail the base rules or have too little content go."""
    return drop_low_quality(docs, table(spark, sf_dir, "labels"))


def jaccard_join(spark, docs, sf_dir):
    """One document of each group of near copies stays, that of the least doc_id."""
    return drop_near_copies(docs)


def decontamination(spark, docs, sf_dir):
    """Documents with a window of a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark, docs, sf_dir):
    """Personal data in texts is replaced by its kind in angle brackets; n_chars follows the new text."""
    masked = mask_documents(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.selectExpr(*[
        "CAST(char_length(text) AS BIGINT) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns
    ])


def pieces(spark, docs, sf_dir, vocabulary=VOCABULARY):
    """The columns of documents and the ids of the text's pieces, which decode to the very text."""
    return encoded(docs, load_vocabulary(vocabulary))


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("sentencepiece", pieces),
]

# The first stage is a trained model; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
