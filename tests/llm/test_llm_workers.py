"""Workers that cannot import this package run the operators all the same."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
sys.path.insert(0, {root!r} + "/tests/llm")
from pyspark.sql import functions as F
from tarmac.session import local_session
spark = local_session(2, 2)
spark.sparkContext.setCheckpointDir({folder!r})

@F.udf("boolean")
def importable(_):
    import importlib.util
    return importlib.util.find_spec("tarmac") is not None

assert not any(r[0] for r in spark.range(4, numPartitions=2).select(importable("id")).collect())

from llm_cases import edge_docs, label_rows
from tarmac.llm import conversations, imatch, langid, packing, quality, repeats, simhash, spelling, token_store
from tarmac.llm.common import tokenizer_path

docs = edge_docs(spark)
talks = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Yes?"), (2, 0, "tool", "")], "conv_id long, turn long, role string, text string")
made = dict(
    quality=quality.quality_table(docs, label_rows(spark, [(1, 1, 0), (11, 0, 0)])), language=langid.language_table(docs),
    simhash=simhash.component_table(docs), packing=packing.pack_documents(docs, tokenizer_path()), imatch=imatch.fingerprint_table(docs),
    repeats=repeats.repeat_table(docs), conversations=conversations.repair_table(talks, True), spelling=spelling.variant_table(docs),
    tokens=token_store.token_table(docs, tokenizer_path("word_bpe_49k.json"), 1))
for name, df in made.items():
    assert df.collect() is not None, name
    print("RAN", name)
"""


def test_operators_need_no_package_on_the_workers(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" or ROOT not in v}
    script = tmp_path / "job.py"
    script.write_text(SCRIPT.format(root=ROOT, folder=str(tmp_path / "ckpt")))
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    assert out.stdout.count("RAN") == 9
