"""Many spans in one text: what meets what is taken, in time that grows with the text."""

from __future__ import annotations

import random
import time

import numpy as np

from daylake.llm import pii, secrets, warc
from daylake.llm.common import Taken


def test_taken_places_equal_a_search_of_all():
    rng = random.Random(3)
    for _ in range(300):
        spans = [(a, a + rng.randint(1, 9)) for a in (rng.randrange(80) for _ in range(rng.randint(0, 12)))]
        taken = Taken(spans)
        for _ in range(30):
            start = rng.randrange(90)
            end = start + rng.randint(1, 9)
            meets = any(a < end and start < b for a, b in spans)
            assert taken.meets(start, end) is meets
            if not meets:
                taken.add(start, end)
                spans.append((start, end))


def test_a_text_of_many_secrets_takes_linear_time():
    rng = random.Random(4)
    text = " ".join(f"token={rng.getrandbits(64):016x}" if n % 2 else f"{rng.getrandbits(200):x}" for n in range(40_000))
    base = secrets.base_matches(text)
    assert len(text) > 1_000_000 and len(base) >= 20_000
    start = time.perf_counter()
    secrets.added_spans(text, [span for span, _ in base], np.zeros(secrets.STATES * secrets.STATES))
    assert time.perf_counter() - start < 2


def test_a_text_of_many_numbers_takes_linear_time():
    rng = random.Random(5)
    text = " ".join(f"call +49 {rng.randrange(10**9, 10**10)} or 10.0.{n % 250}.{n % 7}," for n in range(30_000))
    start = time.perf_counter()
    spans = pii.all_spans(text)
    assert len(text) > 900_000 and len(spans) >= 20_000 and time.perf_counter() - start < 6


def test_archives_are_read_by_a_task_each(spark, tmp_path):
    pages = spark.createDataFrame([(n, "u", f"<p>{n}</p>" * 50) for n in range(64)], "page_id long, url string, html string")
    manifest = warc.write_archives(pages.repartition(8), f"file://{tmp_path}", file_bytes=1)
    found = warc.read_archives(manifest)
    assert manifest.count() == 64 and found.rdd.getNumPartitions() == 64
    tasks = found.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(tasks) == 64 and max(tasks) <= 3
