"""Corpus pipeline: documents through the stages in order, each on what the one before kept.

Every stage reads whole texts and keeps the columns of documents; an empty table
stays empty, other columns are carried along, and rows without an id are judged
like others.
"""

from __future__ import annotations

from lakeviews.llm import decontamination, jaccard_join, mixing, quality_model, secrets
from lakeviews.llm.common import save, table
from lakeviews.llm.training import labelled


def quality(spark, docs, sf_dir):
    """Documents that the classifier, fitted on labelled documents that aren't held out, doesn't reject.

    Null and empty texts have a score of their own and are kept or go by it;
    equal texts go together; without a label nothing is rejected.
    """
    net = quality_model.fit(labelled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality"))
    return quality_model.accepted(docs, net)


def near_duplicates(spark, docs, sf_dir):
    """One document, of the least id, of each group of copies and near copies.

    Null texts and texts without a word are like no other and stay; of rows with
    one id and one text, one stays; a null id is least.
    """
    return jaccard_join.one_of_each(docs)


def decontaminate(spark, docs, sf_dir):
    """Documents that hold no test item.

    Null and empty texts hold none; repeated rows go together; items without a
    word, of one word, or so short and common that they say nothing drop no
    document (see ``decontamination.clean``).
    """
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark, docs, sf_dir):
    """All documents, with secrets in their texts replaced by a mark.

    Null texts stay null; spans that overlap become one mark; what the automata
    learn, they learn from the documents of this stage.
    """
    return secrets.redact(docs)


def mix_sources(spark, docs, sf_dir):
    """The mix: documents that it takes, with the number of copies taken.

    Texts without a word have size 0 and are taken as often as their source; a
    null source is one of its own, the last; ties of the hash go together.
    """
    return mixing.taken_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", mask_secrets),
    ("mixing sources", mix_sources),
]
ORACLE_SQL = None  # the model stages can't be expressed in SQL


def run(spark, sf_dir: str):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
