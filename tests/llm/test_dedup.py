"""Substring, line and near-duplicate operators against brute force."""

import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import lines, simhash, suffixes
from millrace.llm.components import components

SCHEMA = "doc_id long, text string"
EDGES = [(None, "without an id " * 9), (90, None), (91, ""), (92, "\n\n"), (93, "long " * 30_000), (94, "é" * 80), (94, "é" * 80), (95, "é" * 79)]


def words(rng, n, alphabet="abcdefgh "):
    return "".join(rng.choice(list(alphabet), n))


def overlapping_documents(seed, count):
    """Documents cut together from shared passages, periodic runs and noise."""
    rng = np.random.default_rng(seed)
    passages = [words(rng, int(n)) for n in rng.integers(30, 200, 20)]
    docs = []
    for i in range(count):
        text = ""
        for _ in range(rng.integers(0, 8)):
            kind = rng.random()
            if kind < 0.5:
                passage = passages[rng.integers(0, len(passages))]
                cut = rng.integers(0, len(passage))
                text += passage[cut:] if kind < 0.25 else passage[: cut + 40]
            elif kind < 0.7:
                text += ("ab" if kind < 0.6 else "x") * int(rng.integers(1, 120))
            else:
                text += words(rng, int(rng.integers(1, 120)), "abcdefghijklmnop é\n")
        docs.append((i, text))
    return docs


def removed_bytes(docs):
    first, result = {}, {}
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        raw = (text or "").encode()
        rank = float("inf") if doc_id is None else doc_id
        mask = np.zeros(len(raw), bool)
        for j in range(len(raw) - 49):
            if first.setdefault(raw[j : j + 50], rank) < rank:
                mask[j : j + 50] = True
        runs = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
        kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
        result.setdefault((doc_id, text), []).append((len(raw), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
    return result


@pytest.mark.parametrize("partitions", [1, 13])
def test_substrings_match_brute_force(spark, partitions):
    docs = overlapping_documents(1, 80) + EDGES
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame = spark.createDataFrame(docs, SCHEMA).withColumns({"k1": F.lit(1), "place": F.lit("x"), "sig": F.lit(0)}).repartition(4)
        got = sorted((r.doc_id is None, r.doc_id, *r[1:5], bytes(r.kept)) for r in suffixes.dedup_substrings(frame).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    want = sorted((i is None, i, *row) for (i, _), rows in removed_bytes(docs).items() for row in rows)
    assert got == want


def test_substrings_of_a_long_text_are_cut_into_buffers_without_loss(spark):
    rng = np.random.default_rng(3)
    long = words(rng, 2 * suffixes.BUFFER + 1000, "abcdefghijklmnopqrstuvwxyz")
    cut = suffixes.BUFFER - 30
    docs = [(1, long), (2, "." * 60 + long[cut : cut + 90])]
    rows = {r.doc_id: r for r in suffixes.dedup_substrings(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert (rows[1].n_removed, rows[2].n_removed, rows[2].n_spans) == (0, 90, 1)
    assert bytes(rows[2].kept) == b"." * 60


def plain_lines(docs):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})

    rank = lambda d: float("inf") if d is None else d
    holders = {}
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(rank(doc_id))
    result = []
    for doc_id, text in docs:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if len(key(x)) < 10 or min(holders[key(x)]) == rank(doc_id)]
        result.append((doc_id, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(result, key=repr)


@pytest.mark.parametrize("partitions", [1, 13])
def test_lines_match_brute_force(spark, partitions):
    rng = np.random.default_rng(2)
    pool = [words(rng, int(n), "abCDé \t") for n in rng.integers(0, 25, 60)] + ["the hot line of all"]
    docs = [(i, "\n".join(["The Hot line OF all "] * (i % 3) + [pool[j] for j in rng.integers(0, 61, rng.integers(0, 30))])) for i in range(120)]
    docs += EDGES
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame = spark.createDataFrame(docs, SCHEMA).withColumn("pos", F.lit(7)).repartition(5)
        done = lines.dedup_lines(frame).select("doc_id", "__lines", "__dropped", "__text").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert sorted((tuple(r) for r in done), key=repr) == plain_lines(docs)


def test_bitmaps_keep_lines_beyond_their_end():
    row = lines._bitmap_batch(__import__("pyarrow").RecordBatch.from_pydict({"id": [1], "sig": [2], "gone": [[0, 9, 9]]}))
    assert row.column("n_dropped").to_pylist() == [2]
    text = "\n".join(str(i) for i in range(20))
    kept, n = lines.kept_text(text, row.column("keep")[0].as_py())
    assert n == 20 and kept.split("\n") == [str(i) for i in range(20) if i not in (0, 9)]


def plain_print(text):
    found = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    shingles = [b" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", ["", " \n", "One", "one TWO", "a b c", "a b c d a b c d", "é ü\x0bß x\x85y z", "w " * 70_000])
def test_print_matches_its_definition(text):
    import pyarrow as pa
    import pyarrow.compute as pc

    lowered = pc.ascii_lower(pa.array([text]))[0].as_py()
    assert simhash.fingerprint(lowered) % (1 << 64) == plain_print(text)


def near_prints(seed):
    """Prints in chains and clouds around some centres."""
    rng = np.random.default_rng(seed)
    prints = set()
    for centre in rng.integers(0, 1 << 63, 150).tolist():
        prints.add(centre)
        at = centre
        for _ in range(rng.integers(0, 40)):
            near = at
            for bit in rng.integers(0, 64, rng.integers(1, 4)).tolist():
                near ^= 1 << bit
            prints.add(near)
            at = near if rng.random() < 0.5 else at
    return sorted(p - (1 << 64) if p >> 63 else p for p in prints)


def plain_roots(prints):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {p: root(p) for p in prints}


def test_links_reach_every_pair_within_two_bits(spark):
    prints = near_prints(4)
    found = simhash.links(spark.createDataFrame([(p,) for p in prints], "print long"))
    rows = found.collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 2 for r in rows)
    roots = {r.node: r.root for r in components(found).collect()}
    assert {p: roots.get(p, p) for p in prints} == plain_roots(prints)


def test_a_crowd_of_prints_makes_no_pairs_of_all_its_members(spark):
    crowd = [(1 << 40) * i for i in range(1, 400)]
    found = simhash.links(spark.createDataFrame([(p,) for p in crowd], "print long")).count()
    assert found < 65 * len(crowd)


def test_near_duplicates_name_the_smallest_id(spark):
    text = " ".join(f"w{i}" for i in range(300))
    docs = [(7, text), (5, text.upper()), (None, text), (8, None), (3, ""), (4, " \n"), (9, "another text of its own"), (9, "another text of its own"), (None, "alone")]
    got = sorted((tuple(r) for r in simhash.near_duplicates(spark.createDataFrame(docs, SCHEMA)).select("doc_id", "component_id").collect()), key=repr)
    assert got == sorted([(7, 5), (5, 5), (None, 5), (8, 3), (3, 3), (4, 3), (9, 9), (9, 9), (None, None)], key=repr)


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(1, i) for i in range(2, 60)]
    rows = components(spark.createDataFrame(chain + hub + [(500, 500)], "a long, b long")).collect()
    want = {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 60)} | {500: 500}
    assert {r.node: r.root for r in rows} == want


@pytest.mark.parametrize("operator", [suffixes.dedup_substrings, lines.dedup_lines, simhash.near_duplicates])
def test_an_empty_table_gives_no_rows(spark, operator):
    assert operator(spark.createDataFrame([], SCHEMA)).count() == 0
