"""Memory of the Python workers of the pipeline: pack went beyond that of an executor."""

from __future__ import annotations

import subprocess
import sys
from types import SimpleNamespace

import pytest

from assetlake.llm import packing


def own_process(code: str) -> str:
    return subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=120).stdout.split()[-1]


def test_new_pretokens_are_encoded_in_portions(monkeypatch):
    seen = []

    def encode(texts, add_special_tokens):
        seen.append(len(texts))
        return [SimpleNamespace(ids=[len(t)]) for t in texts]

    monkeypatch.setattr(packing, "PORTION", 10)
    monkeypatch.setattr(packing, "tokenizer_of", lambda path: SimpleNamespace(encode_batch_fast=encode))
    known = packing.store.__wrapped__("none")
    assert known.encode([b"x" * i for i in range(1, 36)], None) == [[i] for i in range(1, 36)]
    assert seen == [10, 10, 10, 5]


def test_the_tokenizer_starts_no_threads_of_its_own():
    pytest.importorskip("public_tokenizers")
    code = """
import os
from assetlake.llm import packing
from assetlake.llm.queries import vocabulary
known = packing.store(vocabulary("byte_bpe_50k.json"))
before = len(os.listdir("/proc/self/task"))
known.encode([b"word%d" % i for i in range(20_000)], None)
print(len(os.listdir("/proc/self/task")) - before)
"""
    assert own_process(code) == "0"


def test_freed_memory_of_earlier_tasks_is_given_back():
    code = """
import re
from assetlake.llm.common import slices
rss = lambda: int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) >> 10
held = [b"x" * 100_000 for _ in range(2000)]
del held[:-1]
full = rss()
list(slices(iter([]), 0))
print(full - rss())
"""
    assert int(own_process(code)) > 100
