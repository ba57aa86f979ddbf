"""Token counts with a word in all blocks, whose blocks meet in groups."""

import pytest
from tokenizers import Tokenizer

from tallymill.llm import queries, token_count


@pytest.mark.parametrize("together, block_bytes", [(4096, 24 << 20), (4096, 60), (2, 60), (1, 1)])
def test_groups_of_blocks(spark, together, block_bytes):
    texts = [f"the common word and own{i} {'the ' * (i % 7)}" for i in range(40)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    tokenizer = Tokenizer.from_file(queries.BYTE_BPE)
    found = token_count.token_counts(df, queries.BYTE_BPE, together=together, block_bytes=block_bytes)
    assert {r.doc_id: r.n_tokens for r in found.collect()} == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
