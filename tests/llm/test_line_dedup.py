"""Line dedup against a plain program, with planted passages."""

import hashlib
import random
import re

from presscheck.llm import line_dedup
from presscheck.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def without_repeats(docs, words=50, long=200, run=3):
    """By document, the lines that stay: every repeated stretch of ``run`` lines, or of fewer with enough bytes or words, goes."""
    seen, out = set(), {}
    for d, text in sorted(docs.items()):
        lines = text.split("\n")
        gone = set()
        for n in range(1, run + 1):
            for i in range(len(lines) - n + 1):
                window = tuple(lines[i : i + n])
                enough = n == run or sum(len(re.findall(r"[^ \t-\r]+", x)) for x in window) >= words
                if enough or n == 1 and len(window[0].encode()) >= long:
                    if window in seen:
                        gone.update(range(i, i + n))
                    seen.add(window)
        out[d] = [x for i, x in enumerate(lines) if i not in gone]
    return out


def test_repeated_passages_of_one_and_two_lines_go(spark):
    rng = random.Random(9)

    def line(words, length=4):
        return " ".join("".join(rng.choices("abcdefgh", k=length)) for _ in range(words))

    two, uneven, one, short, long = [line(34), line(34)], [line(60), line(8)], [line(60, 2)], [line(20), line(20)], [line(24, 9)]
    assert all(len(x) < 200 for x in two + one + short) and len(uneven[0]) >= 200 and len(long[0]) >= 200
    passages = [two, uneven, one, short, long]
    docs = {}
    for i in range(12):
        parts = rng.sample(passages, 3) if i else passages
        docs[i] = "\n".join(x for p in parts for x in [line(6), *p, line(7)])
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.text.split("\n") for r in line_dedup.remove_repeats(frame).collect()}
    assert got == without_repeats(docs)
    later = [x for d in range(1, 12) for x in got[d]]
    assert not set(later) & {*two, *uneven, *one, *long} and set(later) & set(short)


def test_query_leaves_no_repeated_passage(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    kept = {d: hashlib.sha256("\n".join(x).encode()).hexdigest() for d, x in without_repeats(docs).items()}
    assert {r.doc_id: r.kept_sha256 for r in QUERIES["op4_line_dedup"](spark, SMALL).collect()} == kept
