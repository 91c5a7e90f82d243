"""What one worker holds while it encodes stays small beside its texts."""

import tracemalloc

import pyarrow as pa

from bidlens.llm import packing
from bidlens.llm.tokens import encoder
from bidlens.llm.words import slices


def test_encoding_takes_little_memory():
    texts = pa.array([f"word{i % 97} and some more text, no. {i}. " * 60 for i in range(4000)])  # about 8 MB
    coder = encoder(None)
    for piece in slices(texts.slice(0, 10), packing.TEXT_BYTES):
        coder.encode(piece)
    tracemalloc.start()
    try:
        for piece in slices(texts, packing.TEXT_BYTES):
            coder.encode(piece)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 80e6, peak
