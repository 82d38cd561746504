"""Shared helpers: memory that the driver gives back."""

import os
import re

import pytest

from tidemark.llm import textmap


def resident(pid):
    """MB of a process that are no mapped files."""
    with open(f"/proc/{pid}/status") as f:
        return int(re.search(r"RssAnon:\s+(\d+)", f.read())[1]) / 1024


@pytest.mark.skipif(not os.path.exists("/proc/self/status"), reason="needs /proc")
def test_driver_gives_back_freed_native_memory(spark):
    jvm = spark.sparkContext._jvm
    pid = jvm.java.lang.ProcessHandle.current().pid()
    textmap.give_back_driver_memory(spark)
    before = resident(pid)
    deflaters = [jvm.java.util.zip.Deflater() for _ in range(600)]  # zlib's buffers of each
    full = resident(pid)
    assert full - before > 25
    for k, d in enumerate(deflaters):
        if k % 20 != 19:  # those that stay keep the C library from shrinking its heap by itself
            d.end()
    textmap.give_back_driver_memory(spark)
    left = resident(pid)
    for d in deflaters[19::20]:
        d.end()
    assert left - before < (full - before) / 2


def test_stored_gives_back_memory(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(textmap, "give_back_driver_memory", calls.append)
    assert textmap.stored(spark, spark.range(3), "numbers").count() == 3
    assert calls == [spark]
