"""Quality, mixing, packing and the pipeline."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import lines, mixing, packing, quality, simhash
from tests.llm.test_dedup import plain_lines, plain_print

SCHEMA = "doc_id long, text string"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the man of the house and the dog was in the garden with a friend for the day as it is on that road by the river"


# quality


def plain_counts(text):
    text = text or ""
    found = text.encode().split()
    found = [w.decode() for w in found]
    runs = Counter(tuple(found[i : i + 5]) for i in range(len(found) - 4))
    inside = set()
    for i in range(len(found) - 4):
        if runs[tuple(found[i : i + 5])] > 1:
            inside.update(range(i, i + 5))
    split, repeats = text.split("\n"), 0
    for i, line in enumerate(split):
        repeats += bool(line.encode().split()) and line in split[:i]
    return [len(found), sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"), repeats, len(inside)]


@settings(deadline=None)
@given(st.text(alphabet="ab é\n\t\x0b\x85#<|A", max_size=120))
def test_counts_match_their_definition(text):
    assert quality.measure(text)[0] == plain_counts(text)


def test_distance_is_zero_for_equal_and_one_for_disjoint_histograms():
    rows = np.array([[2.0, 0, 2], [0, 5, 0], [0, 0, 0]])
    assert quality.distance(rows, np.array([1.0, 0, 1])).tolist() == [0, 1, 1]


def quality_documents():
    rng = np.random.default_rng(5)
    common, own = "the of and to in is that for on with".split(), ["".join(rng.choice(list("aeioulrstnm"), 7)) for _ in range(300)]
    good = [(i, " ".join(rng.choice(common if k % 2 else own) for k in range(90)) + ".") for i in range(30)]
    shouted = (100, " ".join(f"WORD{w.upper()}!!" for w in PROSE.split() * 1) + " " + " ".join(f"LOUD{i}!!" for i in range(60)))
    marked = (101, " ".join(f"{w}###{i}" for i, w in enumerate(PROSE.split() * 3)))
    repeated = (102, "same words again and again " * 20)
    return good + [shouted, marked, repeated, (103, None), (104, ""), (105, "too short"), (None, PROSE), (1, good[1][1])]


def test_quality_keeps_prose_and_rejects_junk(spark):
    frame = spark.createDataFrame(quality_documents(), SCHEMA).withColumns({"kept": F.lit(1), "classes": F.lit("x")})
    rows = quality.judge(frame).collect()
    assert {r.doc_id for r in rows if r.kept} == set(range(30)) | {None}
    assert {r.doc_id for r in rows if r.base_failed} == {102, 103, 104, 105}
    assert len(rows) == len(quality_documents())
    assert sorted(quality.keep_good(frame).select("doc_id").collect(), key=repr) == sorted([(r.doc_id,) for r in rows if r.kept], key=repr)


def test_quality_separates_the_labelled_documents(spark, small):
    root = small.replace("0.001", "0.01")
    rows = quality.judge(spark.read.parquet(f"{root}/documents.parquet")).where("not base_failed").select("doc_id", "kept")
    found = rows.join(spark.read.parquet(f"{root}/labels.parquet"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")))
    share = {r[0]: r[1] for r in found.collect()}
    assert share[1] > 0.97 and share.get(0, 0) < 0.1


# mixing


def plain_targets(sizes, cycle=3, ceiling=3):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: i % cycle + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(ceiling * sizes[s] for s in capped)
        spread = sum(weights[s] for s in order if s not in capped)
        targets = {s: ceiling * sizes[s] if s in capped else left * weights[s] / spread for s in order}
        above = {s for s in order if targets[s] > ceiling * sizes[s] + 1e-9}
        if not above:
            return targets
        capped |= above


def mixed_documents():
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.integers(1, 200)), f"s{rng.choice([0] * 30 + list(range(1, 9)))}") for i in range(900)]
    tiny = [(1000 + i, "a b", "tiny") for i in range(3)] + [(1100, "x", None), (1101, None, None), (1102, "", "empty"), (None, "no id here", "s1")]
    return rows + tiny + [rows[0], rows[0]]


def test_mix_meets_its_targets(spark):
    docs = mixed_documents()
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({"level": F.lit(1), "n": F.lit(2), "target": F.lit(3)})
    rows = mixing.mix(frame).collect()
    assert len(rows) == len(docs)
    sizes, largest = Counter(), Counter()
    for _, text, source in docs:
        n = len((text or "").split())
        sizes[source] += n
        largest[source] = max(largest[source], n)
    targets = plain_targets(sizes)
    source_of = {d: s for d, _, s in docs}
    taken = Counter()
    for r in rows:
        source = source_of[r.doc_id]
        assert r.target == pytest.approx(targets[source]) and r.source_size == sizes[source]
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[source] += r.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1e-6
    again = mixing.mix(frame.repartition(3)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_longer_documents_are_likelier(spark):
    docs = [(i, "w " * (10 if i % 2 else 160), "a") for i in range(600)] + [(1000 + i, "w " * 300, "b") for i in range(300)]
    rows = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")).where("doc_id < 1000").collect()
    copies = lambda size: np.mean([r.copies for r in rows if r.size == size])
    # expected copies grow with the root of the size
    assert copies(160) / copies(10) == pytest.approx(4, rel=0.35) or copies(160) > 2.9


def test_mix_of_an_empty_table_and_of_wordless_documents(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    rows = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, " ", None)], schema)).collect()
    assert [(r.size, r.taken) for r in rows] == [(0, 0), (0, 0)]


# packing

RANKS = public_tokenizers.path(packing.RANKS)
REFERENCE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="ab '’\n\t 1é|<endofx>", max_size=80))
def test_tokens_match_the_tokenizer_file(text):
    assert packing.tokens(text, RANKS).tolist() == REFERENCE.encode(text, add_special_tokens=False).ids + [0]


def test_tokens_of_the_special_string_match_too():
    text = "a<|endoftext|> b"
    assert packing.tokens(text, RANKS).tolist() == REFERENCE.encode(text, add_special_tokens=False).ids + [0]


def check_pieces(rows, docs, tasks):
    """Every id once, windows without gaps, next to no padding."""
    by_doc, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    expected = Counter()
    for doc_id, text in docs:
        ids = np.append(REFERENCE.encode(text or "", add_special_tokens=False).ids, 0).astype("<u4")
        expected[doc_id] += len(ids)
        for r in by_doc[doc_id]:
            if r.doc_tokens == len(ids) and sum(1 for d, _ in docs if d == doc_id) == 1:
                assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    assert {d: sum(r.length for r in found) for d, found in by_doc.items()} == dict(expected)
    padded = 0
    for found in windows.values():
        found.sort(key=lambda r: r.offset)
        assert [r.offset for r in found] == np.cumsum([0] + [r.length for r in found])[:-1].tolist()
        length = sum(r.length for r in found)
        assert length <= found[0].context and len({r.step_group for r in found}) == 1
        padded += length < found[0].context
    assert padded <= tasks


def test_pieces_cover_all_documents_without_gaps(spark):
    rng = np.random.default_rng(8)
    docs = [(i, " ".join(f"word{rng.integers(0, 9999)}" for _ in range(int(rng.integers(0, 700))))) for i in range(150)]
    docs += [(500, "long " * 9000), (501, None), (502, ""), (None, "no id")]
    frame = spark.createDataFrame(docs, SCHEMA).withColumns({"start": F.lit(0), "ids": F.lit("x")}).repartition(3)
    rows = packing.pack_documents(frame).collect()
    check_pieces(rows, docs, 3)
    for r in rows:
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
    assert {r.context for r in rows} <= set(packing.CONTEXTS)


def test_pack_carries_less_than_one_window():
    rng = np.random.default_rng(9)
    for case in range(60):
        lengths = rng.integers(1, 1200 if case % 2 else 130, int(rng.integers(1, 40)))
        pieces = [packing.Piece(i, 0, np.full(n, i, "<u4"), n) for i, n in enumerate(lengths)]
        full, left = packing.pack(pieces)
        assert all(sum(len(p.ids) for p in window) == context for context, window in full)
        assert sum(len(p.ids) for p in left) < packing.CONTEXTS[0]
        seen = Counter()
        for p in [p for _, window in full for p in window] + left:
            seen.update(p.ids.tolist())
        assert [seen[i] for i in range(len(lengths))] == lengths.tolist()


def test_step_groups_are_balanced():
    lengths = [1024] * 300 + [512] * 100 + [128] * 64
    groups = packing.step_groups(lengths)
    totals = Counter()
    for group, length in zip(groups, lengths):
        totals[group] += length
    assert max(totals.values()) - min(totals.values()) <= 2048


def test_packing_an_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


# pipeline


def test_each_stage_matches_a_plain_version(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    extra = spark.createDataFrame([(None, PROSE + " without an id", "en", None, 5), (70_000, None, None, "src0", None)], DOCUMENTS)
    docs = docs.unionByName(extra).withColumn("__id", F.lit(3)).drop("__id").cache()
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near-dedup", "mixing", "packing"]

    kept = stages["quality rules"](spark, docs, small).cache()
    verdicts = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=repr) == sorted((r for r in docs.collect() if verdicts[r.doc_id]), key=repr)

    lined = stages["line dedup"](spark, kept, small).cache()
    want = plain_lines([(r.doc_id, r.text) for r in kept.collect()])
    assert sorted(((r.doc_id, r.text) for r in lined.collect()), key=repr) == sorted(((w[0], w[3]) for w in want), key=repr)
    assert all(r.n_chars == len(r.text) for r in lined.collect())

    single = stages["near-dedup"](spark, lined, small).cache()
    rows = [r for r in lined.collect() if r.doc_id is not None]
    prints = {r.doc_id: plain_print(r.text) for r in rows}
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    assert {r.doc_id for r in single.collect() if r.doc_id is not None} == {i for i in ids if root(i) == i}

    mixed = stages["mixing"](spark, single, small).cache()
    copies = {r.doc_id: r.copies for r in mixing.mix(single).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == {d: n for d, n in copies.items() if n}
    assert mixed.columns == docs.columns

    pieces = stages["packing"](spark, mixed, small)
    check_pieces(pieces.collect(), [(r.doc_id, r.text) for r in mixed.collect()], mixed.rdd.getNumPartitions())


def test_the_last_stage_returns_the_packed_tokens_and_op6_drops_them(spark, small):
    import __spark_entry__ as contract

    docs = spark.read.parquet(f"{small}/documents.parquet")
    pieces = dict(corpus_pipeline.STAGES)["packing"](spark, docs, small)
    names = pieces.columns
    assert names[-1] == "ids"
    rows = pieces.collect()
    assert rows and all(len(r.ids) == r[2] and zlib.crc32(np.array(r.ids, np.uint32).tobytes()) == r[3] for r in rows)
    digest = contract.queries()["op6_tier_packing"](spark, small)
    assert digest.columns == names[:-1]
    # pieces of packed documents, whatever order the tasks ran in
    assert sorted(digest.collect(), key=repr) == sorted(pieces.drop("ids").collect(), key=repr)


def test_the_pipeline_runs_on_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize(
    "text", [" " * 2_000_000, "\n" * 2_000_000, "a" * 2_000_000, " " * 150_000 + "word", "word" + " \n" * 100_000 + "<|endoftext|> x", " " * 99_999 + "é"]
)
def test_ids_of_very_long_runs_are_those_of_the_tokenizer_file(text):
    expected = packing.whole_tokenizer().encode(text, add_special_tokens=False).ids
    assert packing.tokens(text, public_tokenizers.path(packing.RANKS)).tolist() == expected + [packing.END]


def test_a_document_of_spaces_is_packed(spark):
    docs = spark.createDataFrame([(1, " " * 1_000_000), (2, "two words")], "doc_id long, text string")
    pieces = packing.pack_documents(docs).select("doc_id", "length", "doc_tokens").collect()
    assert sum(r["length"] for r in pieces if r["doc_id"] == 1) == 1_000_001
