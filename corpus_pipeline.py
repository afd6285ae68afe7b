"""A training-data pipeline of five stages, each of which reads what the one before it has written.

toxicity -> SimHash near-dedup -> benchmark decontamination -> mixing to target weights -> token ids
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm import decontam, mixing, nearcopies, tokens, toxicity
from loomtext.llm.common import durable, fresh, new_folder, remove_folder, swept, table, text_key
from loomtext.llm.queries import tokenizer_path

#: The mix takes so many of a thousand of the tokens that come in; each document once at most.
MIX_PER_MILLE, MIX_SEED = 900, 21
#: Distinct pieces that a worker of the last stage remembers, text that it works on at a time and rows of its batches: a part of what is fastest, as executors still hold
#: the stages before.
REMEMBER, STEP_BYTES, TOKEN_ROWS = 50_000, 1 << 19, 256


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject, with all their columns as they came.

    A null or empty text holds no words and stays. Long texts are scored whole. Rows of equal text have equal scores, so repeated
    rows go or stay together; a score at the threshold is toxic. An empty table stays empty.
    """
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    text = F.col("text").cast("string")
    keyed = docs.select(*[k.alias(n) for n, k in zip(("k0", "k1"), text_key(text), strict=True)], text.alias("text"))
    # the scores are laid down by the texts' keys, in batches of bounded size, and no other column passes through Python
    bad = durable(toxicity.score_toxicity(keyed, model, keep=["k0", "k1"]).where("toxic = 1").select("k0", "k1").distinct())
    bad = F.broadcast(bad) if bad.count() <= nearcopies.BROADCAST_ROWS else bad
    a, b = fresh(docs, "key a", "key b")
    out = docs.withColumns(dict(zip((a, b), text_key(text), strict=True))).join(bad.withColumnsRenamed({"k0": a, "k1": b}), [a, b], "left_anti")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies (five-word shingles, similarity 0.8 or more), with all its columns as they came.

    The smallest doc_id of a group stays, null last; of repeated rows one stays. Texts without words, null ones too, are no one's copies
    and stay. Long texts are compared whole. An empty table stays empty.
    """
    return nearcopies.without_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, with all their columns as they came.

    A document goes whole if its best window is as similar to an item as the threshold or more. Null, empty and very short texts hold no item and stay;
    repeated rows go or stay together; a null doc_id is an id like any other. Long texts are searched whole. An empty table stays empty.
    """
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"))
    hit, mark = fresh(docs, "hit", "mark")
    hits = durable(found.select(F.col("doc_id").alias(hit), F.col("mark").alias(mark)).distinct())
    hits = F.broadcast(hits) if hits.count() <= decontam.BROADCAST_DOCS else hits
    return docs.join(hits, docs["doc_id"].eqNullSafe(F.col(hit)) & (F.xxhash64(docs["text"].cast("string")) == F.col(mark)), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed by equal weights of languages and, in a language, of sources: large sources give way. All columns stay as they came.

    A null language or source is a node like any other. A null or empty text has no tokens and stays if its place in its source's order lies in what is
    taken; a source without a token has no share, and its rows go.
    Rows of one doc_id go or stay together. A long text that doesn't fit what is left of its source's share ends it. An empty table stays empty.
    """
    levels = [
        mixing.Level("domain", F.lit("text"), F.lit(1)),
        mixing.Level("lang", F.col("lang"), F.lit(1)),
        mixing.Level("source", F.col("source"), F.lit(1)),
    ]
    return mixing.mix(docs, levels, F.expr(f"total * {MIX_PER_MILLE} div 1000"), seed=MIX_SEED, max_epochs=1, describe=False)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the corpus, read back: doc_id, start, n_tokens, ids_crc32.

    Every row gets one, in ascending doc_id order, a null id first; null and empty texts have the end id alone. Long texts are encoded whole. Rows of one
    doc_id, and repeated rows, keep the input's order. Other columns are not read. An empty table gives an empty result.
    """
    folder = new_folder(spark, "corpus")
    tokens.write_token_files(docs, folder, tokenizer_path(), end_id=1, remember=REMEMBER, step_bytes=STEP_BYTES, batch_rows=TOKEN_ROWS)
    out = durable(tokens.read_token_files(spark, folder))
    remove_folder(spark, folder)
    return out


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix),
    ("token ids", to_tokens),
]

#: SQL has neither the models' hashes nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again.

    What a stage has laid down on its way goes when its rows are written, and those when the next stage's are.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        folder = new_folder(spark, f"stage{k}")
        with swept():
            stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            remove_folder(spark, before)
        before = folder
    return docs
