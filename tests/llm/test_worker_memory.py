"""What a worker that has tokenized holds on to, beside the work of the tasks it gets next."""

import subprocess
import sys
from pathlib import Path

TASK = """
import random, re, sys
import pyarrow as pa, public_tokenizers
from topicflow.llm.token_files import place_documents
from topicflow.llm.tokens import encoder

def held():
    rows = open("/proc/self/smaps_rollup").read()
    return sum(map(int, re.findall(r"\\nPss_(?:Anon|Shmem):\\s+(\\d+)", rows))) / 1024

path, rng = public_tokenizers.path("byte_bpe_50k.json"), random.Random(4)
encoder(path).encode(["warm up."])
before = held()
words = ["".join(rng.choices("abcdefghijklmno", k=rng.randrange(3, 9))) for _ in range(300_000)]
texts = [" ".join(rng.choices(words, k=400)) for _ in range(4_000)]
batch = pa.RecordBatch.from_arrays([pa.array(range(4_000)), pa.array(texts)], ["doc_id", "text"])
del words, texts
assert sum(x.num_rows for x in place_documents(path, 0, [])([batch])) == 4_000
print(held() - before - batch.nbytes / 2**20)
"""


def test_a_worker_gives_back_what_a_batch_took():
    root = Path(__file__).resolve().parents[2]
    out = subprocess.run([sys.executable, "-c", TASK], cwd=root, capture_output=True, text=True, check=True)
    assert float(out.stdout) < 64
