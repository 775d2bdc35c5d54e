"""Phrases, archives and ranked search against brute force."""

import base64
import hashlib
import math
import re
import uuid
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from millrace.llm import phrases, ranked, warc
from millrace.sources.storage import scratch_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# phrases


def plain_collocations(docs, support, top):
    """Every phrase of every piece counted one by one."""
    totals, found = Counter(), {}
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            counts = found.setdefault(lang, Counter())
            for n in range(1, 5):
                counts.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    rows = []
    for lang, counts in found.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        held = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for s in range(len(p) - m + 1):
                    held[p[s : s + m]] = max(held[p[s : s + m]], a)
        kept = []
        for p, a in candidates.items():
            if 100 * held[p] >= 80 * a:
                continue
            cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            rows.append((lang, rank, p.decode(), -a, l, r, totals[lang], -score))
    return sorted(rows)


def phrase_documents():
    rng = np.random.default_rng(5)
    words = ["Alpha", "beta", "gamma", "Östra", "é", "x'y", "delta", "it", "of", "the"]
    draw = lambda n: "".join(w + str(rng.choice([" ", "  ", "\t", ". ", ",", "\n", " "])) for w in rng.choice(words, n))
    docs = [(draw(60), str(rng.choice(["en", "fr"]))) for _ in range(60)]
    docs += [("one two three four five six. seven", "en")] * 9  # copies
    docs += [(None, "en"), ("", "fr"), ("....", None), (draw(40), None), (draw(40), "und"), ("solo", "xx")]
    docs += [("same " * 300, "aa"), (draw(5000), "en"), ("no pieces at all in a long run of words " * 200, "en")]
    return docs


@pytest.mark.parametrize("spacing", [1, 4, 32])
def test_collocations_against_brute_force(spark, spacing, monkeypatch):
    docs = phrase_documents()
    frame = spark.createDataFrame([(t, l, 1, "x", 2) for t, l in docs], "text string, lang string, size int, phrase string, chunk int").repartition(5)
    for top, support in ((2000, 5), (7, 3)):
        got = phrases.collocations(frame, support=support, top=top, spacing=spacing)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(tuple(r) for r in got.collect()) == plain_collocations(docs, support, top)


def test_a_full_map_only_leaves_out_less(spark, monkeypatch):
    docs = phrase_documents()
    monkeypatch.setattr(phrases, "_in_map", lambda bits, hashes: np.ones(len(hashes), bool))
    got = phrases.collocations(spark.createDataFrame(docs, "text string, lang string"), support=5)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(docs, 5, 2000)


def test_long_texts_are_cut_behind_separators(monkeypatch):
    monkeypatch.setattr(phrases, "GROUP_BYTES", 64)
    text = b"a b c d e f. g h i j, " * 40 + b"z " * 200
    parts = list(phrases._sections(text))
    assert b"".join(parts) == text and len(parts) > 5
    assert all(p.rstrip()[-1:] in (b".", b",") for p in parts[:-1])


def test_chunks_hold_every_word_once_as_a_beginning():
    text = " ".join(str(n % 7) for n in range(500)).encode()
    chunks = [(c, last) for _, last, c in phrases._chunks_of([text, b"", b"a b", text], 5)]
    begun = sum(len(c.split()) - (0 if last else phrases.OVERLAP) for c, last in chunks)
    assert begun == 500 + 2 + 500
    assert len({c for c, _ in chunks}) < len(chunks) / 2  # equal passages give equal chunks


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**14, 2 * 10**14, 10**14)], "a long, l long, r long")
    score = row.select(F.expr("cast(a as decimal(20,0)) * 2000000BD div (cast(l as decimal(38,0)) + r)")).scalar()
    assert row.select(score.cast("long")).first()[0] == 2_000_000 * 10**14 // (3 * 10**14)


def test_no_documents_no_phrases(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0


# archives


def page_rows():
    big = "<p>" + "lorem ipsum é " * 50_000
    same = "<html>copy</html>"
    rows = [(5, "http://a/é\r\nX: y", same), (3, "http://b", same), (9, None, same), (None, "http://c", same)]
    rows += [(20 + i, f"http://d/{i}", f"<p>page {i}</p>" * (i % 5 + 1)) for i in range(60)]
    rows += [(100, "http://big", big), (101, "http://big2", big), (7, "http://e", ""), (8, "http://f", None)]
    rows += [(None, None, "only without id"), (None, "http://g", "only without id"), (3, "http://b", same)]
    rows += [(200 + i, "http://hot", "hot page") for i in range(400)]
    return rows


def plain_records(rows, least=0):
    first = {}
    for page, _, html in rows:
        key = html or ""
        known = first.get(key, ())
        if known == () or (page is not None and (known is None or page < known)):
            first[key] = page
    done = []
    for page, _, html in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        again = page != first[html or ""] and len(payload) >= least
        done.append((page, len(payload), digest, "revisit" if again else "response", first[html or ""] if again else None))
    return sorted(done, key=repr)


@pytest.fixture(scope="module")
def archived(spark):
    path = scratch_path(spark, "warc-test")
    frame = spark.createDataFrame([(*r, 1, "x") for r in page_rows()], "page_id long, url string, html string, digest int, key string").repartition(3)
    warc.write_bundles(warc.records_of(frame), path, frame_bytes=2000, bundle_bytes=5000)
    return path


def summary(df):
    return sorted((tuple(r) for r in df.drop("record_id").collect()), key=repr)


@pytest.mark.parametrize("least", [0, 100])
def test_archive_round_trip(spark, least):
    frame = spark.createDataFrame(page_rows(), "page_id long, url string, html string").repartition(4)
    done = warc.archive(frame, scratch_path(spark, "warc-test"), revisit_bytes=least)
    assert summary(done) == plain_records(page_rows(), least)


def test_records_come_back_whole(spark, archived):
    rows = page_rows()
    found = warc.read_bundles(spark, archived).collect()
    assert Counter((r["page_id"], r["url"]) for r in found) == Counter((p, u) for p, u, _ in rows)
    texts = {html or "" for _, _, html in rows}
    assert {bytes(r["payload"]).decode() for r in found if r["record_type"] == "response"} == texts
    assert all(r["payload"] is None for r in found if r["record_type"] == "revisit")


def test_bundles_are_plain_zstandard_and_seekable(spark, archived):
    names = warc.manifest(archived)["bundles"]
    assert len(names) > 3
    files, root = warc._store(archived)
    for name in names:
        with files.open_input_file(f"{root}/data/{name}") as source:
            data = source.readall()
        plain = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        with files.open_input_file(f"{root}/data/{name}") as source:
            reader = warc.BundleReader(source)
            assert b"".join(reader.frame(k) for k in range(len(reader.frames))) == plain
    index = warc.read_index(spark, archived)
    assert index.count() == len(page_rows())
    assert index.groupBy("bundle", "frame").agg(F.max("offset").alias("o")).where("o > 2000").count() == 0


def test_fetch_reads_single_records(spark, archived):
    wanted = warc.read_index(spark, archived).where("page_id in (5, 101, 33) or page_id is null").select("record_id")
    found = warc.fetch(spark, archived, wanted).collect()
    assert sorted((r["page_id"] or 0, r["record_type"]) for r in found) == sorted(
        [(5, "revisit"), (101, "revisit"), (33, "response"), (0, "revisit"), (0, "response"), (0, "response")]
    )
    assert {r["record_id"] for r in found} == {r["record_id"] for r in wanted.collect()}


def test_files_outside_the_manifest_are_not_read(spark):
    path = scratch_path(spark, "warc-test")
    frame = spark.createDataFrame(page_rows()[:8], "page_id long, url string, html string")
    warc.write_bundles(warc.records_of(frame), path)
    files, root = warc._store(path)
    with files.open_output_stream(f"{root}/data/{uuid.uuid4().hex}.warc.zst", compression=None) as sink:
        sink.write(b"half a bundle of a lost task")
    assert warc.read_bundles(spark, path).count() == 8
    warc.write_bundles(warc.records_of(frame), path)  # appends
    assert warc.read_bundles(spark, path).count() == warc.read_index(spark, path).count() == 16


def test_damaged_payloads_are_noticed():
    row = {"page_id": 1, "url": "u", "payload": b"payload", "record_type": "response", "record_id": "urn:x", "refers_id": None, "refers_to": None}
    record = warc.spell_record(row)
    assert warc.parse_record(record)[0]["payload"] == b"payload"
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record.replace(b"payload\r\n\r\n", b"payl0ad\r\n\r\n"))
    with pytest.raises(ValueError, match="cut short"):
        warc.parse_record(record[:-3])


def test_a_revisit_needs_its_response(spark, archived):
    alone = warc.read_bundles(spark, archived).where("record_type = 'revisit'")
    with pytest.raises(Exception, match="no matching response"):
        warc.resolve(alone).collect()


def test_an_empty_archive(spark):
    done = warc.archive(spark.createDataFrame([], "page_id long, url string, html string"), scratch_path(spark, "warc-test"))
    assert done.count() == 0


# ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_ranking(docs, items, k):
    terms = lambda t: TERM.findall((t or "").translate(LOWER))
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n = [sum(bag.values()) for _, bag in bags]
    documents, occurrences = sum(x > 0 for x in n), sum(n)
    df = Counter(term for _, bag in bags for term in bag)
    rows = []
    for item, text in items:
        query = terms(text)
        scored = []
        for (doc, bag), length in zip(bags, n):
            if length:
                m = 75 + 25 * length * documents // occurrences
                score = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m)) for t in query if t in bag)
                if score > 0:
                    scored.append((-score, doc is None, doc or 0))
        rows += [(item, rank, None if none else doc, -score) for rank, (score, none, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(rows, key=repr)


def ranked_documents():
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(300)] + ["Über", "naïve", "日本語", "A1b2"]
    odds = 1 / np.arange(1, len(words) + 1)
    draw = lambda n: " ".join(rng.choice(words, n, p=odds / odds.sum()))
    docs = [(int(i), draw(int(rng.integers(0, 80)))) for i in rng.permutation(700)]
    docs += [(1000 + i, docs[3][1]) for i in range(60)] + [(None, docs[3][1]), (None, draw(20)), (5, docs[5][1])]
    docs += [(2000, None), (2001, ""), (2002, "-- !!"), (2003, draw(20_000)), (2004, "W1-w2_W3\x00w4")]
    items = [(i, draw(int(rng.integers(1, 40)))) for i in range(25)] + [(50, docs[3][1]), (51, None), (52, ""), (53, "zzz unknown"), (54, "w1 w1 w1 w250")]
    return docs, items


@pytest.mark.parametrize("dense", [True, False])
@pytest.mark.parametrize("rows", [16, 2048])
def test_ranked_search_against_brute_force(spark, rows, dense, monkeypatch):
    docs, items = ranked_documents()
    monkeypatch.setattr(ranked, "SHARD_ROWS", rows)
    if not dense:
        monkeypatch.setattr(ranked, "DENSE", 0)
        monkeypatch.setattr(ranked, "BLOCK_ITEMS", 7)
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, rank int, terms string").repartition(3)
    queries = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, doc_id int")
    got = ranked.top_documents(frame, queries, k=10)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_ranking(docs, items, 10)


def opened(n=400, rows=3000):
    """One shard in which rare terms lie in few documents."""
    rng = np.random.default_rng(2)
    texts = [" ".join(f"t{int(x)}" for x in rng.zipf(1.4, 30) if x < n).encode() for _ in range(rows)]
    names, term, text = ranked.terms_of(texts)
    row = ranked._shard(list(range(rows)), texts, dict.fromkeys(names, 0))
    keys = [part.split()[0] for part in ranked.SHARD.split(", ")]
    shard = ranked.open_shard(dict(zip(keys, row)), rows, len(term))
    df = Counter(int(t) for t in np.unique(term.astype(np.int64) * rows + text) // rows)
    return shard, names, {names[t]: ranked.term_weight(rows, c) for t, c in df.items()}


def test_range_maxima():
    shard, _, _ = opened(rows=200)
    rng = np.random.default_rng(4)
    for _ in range(300):
        k = int(rng.integers(len(shard.terms)))
        low, high = sorted(rng.integers(shard.starts[k], shard.starts[k + 1] + 1, 2).tolist())
        got = shard.largest(np.array([low]), np.array([high]))[0]
        assert got == (-1 if low == high else low + int(np.argmax(shard.impacts[low:high])))


def test_bounds_leave_documents_unscored():
    shard, names, weights = opened()
    rare = sorted(names, key=lambda t: -weights[t])[:3]
    common = sorted(names, key=lambda t: weights[t])[:5]
    best = ranked.Best(5)
    scored = ranked.search(shard, [(t, weights[t]) for t in rare + common if weights[t]], best)
    assert 5 <= scored < len(shard.docs) / 4


def test_length_terms_beyond_64_bits():
    lengths = np.array([0, 5, 10**9], np.int64)
    assert ranked.length_terms(lengths, 10**12, 10**13).tolist() == [75 + 25 * n * 10**12 // 10**13 for n in lengths.tolist()]


def test_no_documents_or_no_items(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert ranked.top_documents(docs, items).count() == 0
    assert ranked.top_documents(items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).count() == 0
