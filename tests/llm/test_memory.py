"""How much memory a worker process takes on top of its vocabulary while it encodes a batch of whole texts."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

CODE = """
import random, resource, sys
import numpy as np, pyarrow as pa
import public_tokenizers
from forerate.llm import common, pieces, token_files

draw = random.Random(5)
letters = [chr(97 + i) for i in range(26)]
known = ["".join(draw.choices(letters, k=draw.randrange(2, 11))) for _ in range(60_000)]
texts = [" ".join(draw.choices(known, k=500)) + "." for _ in range(3_000)]
batch = pa.RecordBatch.from_pydict({"doc_id": list(range(3_000)), "text": texts, "part": pa.array(np.zeros(3_000, np.int32))})
few = batch.slice(0, 2)
if sys.argv[1] == "tokens":
    work = token_files.encoder(public_tokenizers.path("word_bpe_49k.json"), 1)
else:
    vocabulary = pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    work = lambda b: (pieces.piece_lists(x.column("text"), vocabulary) for x in common.blocks(b, pieces.ENCODE_BLOCK))
rows = sum(len(x) if isinstance(x, pa.Array) else x.num_rows for x in work(iter([few])))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
rows += sum(len(x) if isinstance(x, pa.Array) else x.num_rows for x in work(iter([batch])))
print(rows, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


@pytest.mark.parametrize("what, most", [("tokens", 90), ("pieces", 70)])
def test_a_worker_stays_small(what, most):
    done = subprocess.run([sys.executable, "-c", CODE, what], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2])
    rows, grown = map(int, done.stdout.split())
    assert rows == 3_002
    assert grown < most, grown
