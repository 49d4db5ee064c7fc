"""The language model's tasks hold few blocks, and cut many texts at once as they would one by one."""

import re
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from matchlake.llm import attention_lm, common


def test_few_blocks_meet_in_a_task_and_row_groups_are_small(make_docs, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(k, " ".join(f"w{n}" for n in rng.integers(0, 300, 2_000)), "a") for k in range(120)]
    plans, kept = {}, {}
    # As in score, with smaller row groups.
    staged = partial(common.staged, **{k: 1 << 17 for k in attention_lm.staged.keywords})

    def spy(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        kept[name] = staged(df, name)
        return kept[name]

    monkeypatch.setattr(attention_lm, "staged", spy)
    monkeypatch.setattr(attention_lm, "train", lambda model, found, total, steps: model)
    assert attention_lm.score(make_docs(rows).coalesce(1), block_bytes=20_000).count() == len(rows)
    blocks = kept["cut-texts"].select("block").distinct().count()
    dealt = re.findall(r"hashpartitioning\(block#\d+L, (\d+)\)", plans["coded-texts"])
    assert blocks > 20 and dealt and min(map(int, dealt)) >= 2 * blocks
    files = [pq.ParquetFile(re.sub("^file:/+", "/", path)).metadata for path in kept["cut-texts"].inputFiles()]
    assert max(f.num_row_groups for f in files) > 1


def test_texts_are_cut_together_as_one_by_one():
    texts = ["a  b\n", "", None, " \t\n\x0b ", "x\x1cy \x85É É", "A", "\x00 a b c"]
    words, sizes = attention_lm.parted(pa.array(texts))
    each = [attention_lm.words_of(text) for text in texts]
    assert attention_lm.listed(words) == [word for text in each for word in text]
    assert sizes.tolist() == [len(text) for text in each]
    words, sizes = attention_lm.parted(pa.array([None, " "], pa.string()))
    assert len(words) == 0 and sizes.tolist() == [0, 0]
