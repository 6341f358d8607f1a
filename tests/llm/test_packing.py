"""Both packers: every id is placed once, nothing overlaps, and the search finds the optimum of small cases."""

import subprocess
import sys
import zlib

import numpy as np
from pyspark.sql import functions as F

from slotloom.llm import matrices, packing, tokens


def optimum(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in {bins[b]: b for b in range(len(bins)) if bins[b] + items[i] <= capacity}.values():
            bins[b] += items[i]
            go(i + 1, bins)
            bins[b] -= items[i]
        go(i + 1, bins + [items[i]])

    go(0, [])
    return best[0]


def test_search_against_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(150):
        items = rng.integers(1, 41, rng.integers(0, 13))
        counts = np.bincount(items, minlength=41)[:41]
        found, seen = packing.complete(counts), np.zeros(41, int)
        for n, fill in found:
            assert sum(fill) <= 40
            for size in fill:
                seen[size] += n
        assert (seen == counts).all()
        best = optimum(items.tolist(), 40)
        assert packing.lower_bound(counts) <= best == sum(n for n, _ in found)


def test_segment_tree_against_scan():
    rng = np.random.default_rng(6)
    for _ in range(50):
        sizes, rooms, want = rng.integers(1, 65, 40), [], []
        for i in np.argsort(-sizes, kind="stable"):
            fits = [r for r in rooms if r >= sizes[i]]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - sizes[i])
            else:
                rooms.append(64 - sizes[i])
            want.append(len(rooms))
        held = matrices.best_fit_decreasing(sizes, 64)
        assert len(held) == want[-1] and sorted(i for x in held for i in x) == list(range(40))
        assert sorted(64 - sizes[x].sum() for x in held) == sorted(rooms)


def texts(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "Hello, World! it's 1234"), (5, "word " * 5000), (6, "a b"), (6, "a b"), (None, "ÀÉ ŉ x́ <|endoftext|> z")]
    rows += [(i, "lorem ipsum dolor " * (i % 37)) for i in range(10, 120)]
    return rows, spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, piece string, length int")


def ids_of(text, end):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_path()).encode(text or "", add_special_tokens=False).ids + [end]


def check(rows, got, end):
    by = {}
    for d, t in rows:
        by.setdefault((d, len(ids_of(t, end))), []).append(ids_of(t, end))
    spans = {}
    for r in got:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in spans.values():
        held.sort()
        assert [a for a, _ in held] == [0] + [a + n for a, n in held][:-1] and sum(n for _, n in held) <= 2048
    want = sorted(
        (-1 if d is None else d, k, 2048 * k, len(ids[2048 * k:2048 * (k + 1)]), zlib.crc32(np.array(ids[2048 * k:2048 * (k + 1)], "<u4").tobytes()))
        for (d, _), many in by.items() for ids in many for k in range(-(-len(ids) // 2048)))
    assert want == sorted((-1 if r.doc_id is None else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got)
    return len(spans), sum(w[3] for w in want)


def test_pack(spark):
    rows, df = texts(spark)
    got = packing.pack(df.repartition(3)).select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()
    sequences, total = check(rows, got, 0)
    assert sequences == -(-total // 2048)
    assert packing.pack(df.where(F.lit(False))).count() == 0


def test_matrices(spark):
    rows, df = texts(spark)
    written = matrices.write_matrices(df.repartition(3), matrices.matrices_folder(spark))
    got = matrices.segments(written).withColumnRenamed("doc", "doc_id").collect()
    check(rows, got, 49407)
    assert all(r.reset == r.offset for r in got) and all(len(r.ids) == 4096 for r in written.collect())
    assert matrices.segments(matrices.write_matrices(df.where(F.lit(False)), matrices.matrices_folder(spark))).count() == 0


def test_dominance_is_counted_and_not_scanned():
    rng = np.random.default_rng(5)
    for _ in range(300):
        left = rng.integers(0, 3, 60)
        left[0] = 0
        fill = [x for x in rng.integers(1, 12, 3).tolist() if left[x]]
        used = {x: min(fill.count(x), int(left[x])) for x in fill}
        slack = int(rng.integers(0, 8))
        sums = set(fill) | {a + b for i, a in enumerate(fill) for b in fill[i + 1:]}
        plain = any(left[x] > used.get(x, 0) for s in sums for x in range(s + 1, s + slack + 1))
        counted = packing._dominated(fill, slack, left.tolist(), np.cumsum(left > 0).tolist(), used)
        assert counted == bool(slack and plain)


def test_workers_give_memory_back_behind_a_batch():
    script = """
import ctypes, random, re
import pyarrow as pa
from slotloom.llm import tokens

def held():
    return int(re.search(r"Pss_Anon: *([0-9]+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

draw = random.Random(3)
texts = pa.array([" ".join("%x" % draw.getrandbits(20) for _ in range(1500)) for _ in range(3000)])
encoder, n = tokens.encoder("word_bpe_49k.json"), 0
for _ in range(2):
    for *_, ids, offsets in tokens.encode_texts(encoder, texts):
        n += len(ids)
del ids, offsets
left = held()
pa.default_memory_pool().release_unused()
ctypes.CDLL(None).malloc_trim(0)
print(n, left - held())
"""
    n, kept = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True).stdout.split()
    assert int(n) > 0 and float(kept) < 24
