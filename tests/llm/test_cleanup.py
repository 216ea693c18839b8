"""Intermediate tables go when they are old, and nothing else does."""

import random

from loamstack.llm import byte_bpe, pretokenize
from loamstack.llm.cleanup import remove_intermediate
from loamstack.llm.queries import new_index, tokenizer_path
from loamstack.llm.store import materialise


def test_old_tables_are_removed(spark):
    rng = random.Random(0)
    docs = spark.createDataFrame([(i, "".join(rng.choices("ab ", k=50))) for i in range(5)], "doc_id long, text string")
    byte_bpe.encode(docs, tokenizer_path("byte_bpe_50k.tiktoken"), pretokenize.BYTE_LEVEL_PATTERN).count()
    index = new_index(spark)
    index.add(docs).count()
    kept = materialise(docs, "own")
    docs.write.saveAsTable("a_users_table")
    assert remove_intermediate(spark, hours=1) == [] and kept.count() == 5
    gone = remove_intermediate(spark, hours=-1)
    assert any(n.startswith("bpe_chunks_") for n in gone) and any(n.startswith("own-") for n in gone) and not any(n.startswith("digest_index") for n in gone)
    assert spark.table("a_users_table").count() == 5 and index.read().count() == 5
    assert remove_intermediate(spark, hours=-1, indexes=True) == [index.table]
    spark.sql("DROP TABLE a_users_table")
