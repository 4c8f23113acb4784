"""One giant text in each Python operator: the memory of a worker stays within bounds."""

import subprocess
import sys
from pathlib import Path

import pytest

MB = 32
CODE = """
import resource, sys
import numpy as np, pyarrow as pa
from voltarc.llm import _text as X
words = np.array([b"the", b"house", b"water", b"Gr\\xc3\\xb6\\xc3\\x9fe", b"thing", b"under", b"x12", b"end."])
rng = np.random.default_rng(1)
unit = b" ".join(words[rng.integers(0, words.size, 200_000)].tolist())
text = (unit + b" ") * (MB * 1_000_000 // len(unit))
texts = pa.LargeStringArray.from_buffers(1, pa.py_buffer(np.array([0, len(text)], np.int64)), pa.py_buffer(text))
data, off = X.raw(texts)
import voltarc.llm.OPERATOR as O
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
CALL
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1000, len(text) // 1_000_000)
"""
CALLS = {
    "quality": "O.statistics(texts)",
    "langid": "O.Filter.build({'en': np.arange(9, dtype=np.uint32)}, 'en').known(data, off)",
    "setjoin": "O.shingle_sets(data, off, 4)",
    "spotsigs": "O.signatures(texts)",
    "tokens": "O.word_encoder(O.vocabulary(O.WORD_VOCABULARY)).ids(data, off)",
    "bpe": "e = O.encoder(O.vocabulary(O.BYTE_VOCABULARY)); ids = e.ids(data, off)[0]; O._sha256(e.written(ids)); O._sha256(e.decoded(ids))",
}


@pytest.mark.parametrize("operator", sorted(CALLS))
def test_memory(operator):
    code = CODE.replace("OPERATOR", operator).replace("CALL", CALLS[operator]).replace("MB", str(MB))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).resolve().parents[2], timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    grown, size = map(int, out.stdout.split()[-2:])
    assert size >= MB - 2 and grown < 25 * MB, (grown, size)
